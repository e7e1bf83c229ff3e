"""Operators that compare documents with each other or with the benchmark, and the pipeline, against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

pytest.importorskip("terrane.llm")

import corpus_pipeline  # noqa: E402
from terrane.llm import decontaminate, jaccard, packing, pii, quality, queries  # noqa: E402
from terrane.llm.common import Scratch  # noqa: E402

SMOKE = "/root/testdata/sf0.001"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(rows):
    """{id: (n_shingles, component)} of (id, text) rows with unique ids."""
    sets = {i: shingle_set(t) for i, t in rows}
    holders = {}
    for i, s in sets.items():
        for g in s:
            holders.setdefault(g, []).append(i)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in sets.items():
        shared = Counter(j for g in s for j in holders[g] if j < i)
        for j, c in shared.items():
            if 100 * c >= 80 * (len(s) + len(sets[j]) - c):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


def components(spark, rows):
    table = spark.createDataFrame(rows, "doc_id long, text string")
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similar_components(table).collect()}


def test_shingle_hashes_follow_the_words():
    texts = ["One two THREE four five six", "one\ttwo three\nfour  five six", None, "", " ", "a b", "A b", "b a", "a", "é É x y z w", "x" * 9000, "aa", "a a"]
    with np.errstate(over="ignore"):
        tokens, sizes = jaccard.shingles(pa.array(texts))
    ends = np.cumsum(sizes)
    sets = [frozenset(tokens[e - n:e].tolist()) for e, n in zip(ends, sizes, strict=True)]
    brute = [frozenset(shingle_set(t)) for t in texts]
    assert [len(s) for s in sets] == [len(b) for b in brute]
    for i in range(len(texts)):
        for j in range(len(texts)):
            assert len(sets[i] & sets[j]) == len(brute[i] & brute[j]), (texts[i], texts[j])
    # a slice of a column and a chunk boundary change nothing
    with np.errstate(over="ignore"):
        again, sizes = jaccard.shingles(pa.array(["zz zz zz zz zz zz", *texts]).slice(1))
    assert again.tolist() == tokens.tolist()


def test_random_near_copies_equal_brute_force(spark):
    rng = random.Random(11)
    rows = []
    for base in range(25):
        words = [f"w{rng.randint(0, 4000)}" for _ in range(rng.choice([3, 6, 30, 80]))]
        for _ in range(rng.randint(1, 8)):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = f"x{rng.randint(0, 9)}"
            rows.append((len(rows) * 3, " ".join(copy)))
    passage = " ".join(f"p{k}" for k in range(60))
    rows += [(10_000 + k, passage + " " + " ".join(f"u{k}_{i}" for i in range(rng.randint(4, 30)))) for k in range(60)]
    rows += [(20_000, None), (20_001, ""), (20_002, "a b"), (20_003, "A  b"), (20_004, "b a")]
    assert components(spark, rows) == brute_components(rows)


def test_exact_threshold(spark):
    def text(n, changed):
        return " ".join(f"q{changed}_{i}" if i >= n - changed else f"q{i}" for i in range(n))

    rows = [(k, text(49, k)) for k in range(12)]  # 45 shingles: 5 changed words at the end give 40/50 = 0.8
    assert components(spark, rows) == brute_components(rows)
    assert components(spark, [(0, text(49, 0)), (1, text(49, 5))])[1][1] == 0
    assert components(spark, [(0, text(49, 0)), (1, text(49, 6))])[1][1] == 1


def test_large_group_of_near_copies_and_chains(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK", 7)
    monkeypatch.setattr(jaccard, "SHARD_PAIRS", 20)
    monkeypatch.setattr(jaccard, "BUCKET_NGRAMS", 500)
    monkeypatch.setattr(jaccard, "HOT_HOLDERS", 4)
    base = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join([*base, f"t{k}", f"s{k}"])) for k in range(150)]
    # a chain: neighbours link, ends do not
    rows += [(1000 + k, " ".join(f"c{j}" for j in range(3 * k, 3 * k + 60))) for k in range(40)]
    got = components(spark, rows)
    assert got == brute_components(rows)
    assert got[149][1] == 0 and got[1039][1] == 1000


def test_leaders_alone_never_decide(spark, monkeypatch):
    """Without leader rounds every pair comes from the last, exhaustive turn; the result is the same."""
    rng = random.Random(3)
    rows = []
    for k in range(60):
        words = [f"w{i}" for i in range(40)]
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(40)] = f"z{rng.randint(0, 2)}"
        rows.append((k, " ".join(words)))
    want = brute_components(rows)
    assert components(spark, rows) == want
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scratch = Scratch(spark, "test")
    members = scratch.write(jaccard.set_signatures(docs), "members")
    sets = scratch.write(jaccard.linkable_sets(docs, members, 3), "sets")
    labels = jaccard.link_classes(spark, scratch, sets, rounds=0)
    per_label = {}
    for r in members.join(labels, "sig", "left").collect():
        per_label.setdefault(r["label"] or r["sig"], set()).add(r["doc_id"])
    brute = {}
    for i, (_, c) in want.items():
        brute.setdefault(c, set()).add(i)
    assert sorted(map(sorted, per_label.values())) == sorted(map(sorted, brute.values()))


def test_prefix_tree_walk_equals_counting():
    rng = random.Random(4)
    for _ in range(400):
        universe = sorted(rng.sample(range(10**6), 30))
        draw = lambda: sorted(rng.sample(universe, rng.randint(1, 30)))
        base = draw()
        sets = [sorted(set(base) ^ set(rng.sample(universe, rng.randint(0, 4)))) or [universe[0]] for _ in range(rng.randint(0, 9))] + [draw()]
        alone = [rng.randint(0, 3) for _ in sets]  # n-grams that no other set has
        own = rng.randint(0, 3)
        got = jaccard.overlaps_enough(np.array(base), len(base) + own, [len(s) + a for s, a in zip(sets, alone, strict=True)], [np.array(s) for s in sets])
        want = [k for k, s in enumerate(sets)
                if 100 * (c := len(set(s) & set(base))) >= 80 * (len(s) + alone[k] + len(base) + own - c)]
        assert sorted(got) == want


def test_components_on_the_table_and_edges(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.op5_jaccard(spark, SMOKE).collect()}
    assert got == brute_components([(r["doc_id"], r["text"]) for r in docs.collect()])
    odd = spark.createDataFrame([(None, "same text here ok yes no", 1), (5, "same text here ok yes no", 2), (5, "same text here ok yes no", 3), (7, None, 4), (3, "same text here OK yes no", 5)],
                                "doc_id long, text string, sig long")
    rows = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.similar_components(odd).collect())
    assert rows == Counter({(5, 2, 3): 2, (None, 2, None): 1, (7, 0, 7): 1, (3, 2, 3): 1})
    assert jaccard.similar_components(odd.where("false")).count() == 0


def brute_hits(docs, items, window):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {}
    for item, text in items:
        w = word.findall(lower(text or ""))
        for a in range(max(1, len(w) - window + 1)) if w else ():
            windows.setdefault(tuple(w[a:a + window]), set()).add("" if item is None else str(item))
    lengths = {len(w) for w in windows}
    out = []
    for text in docs:
        w = word.findall(lower(text or ""))
        hit, found = set(), set()
        for n in lengths:
            for a in range(len(w) - n + 1):
                own = windows.get(tuple(w[a:a + n]))
                if own:
                    hit |= {*range(a, a + n)}
                    found |= own
        out.append((len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


COLUMNS = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def test_decontamination_equals_brute_force(spark):
    docs, bench = (spark.read.parquet(f"{SMOKE}/{t}.parquet") for t in ("documents", "benchmark"))
    rows = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in queries.op9_decontamination(spark, SMOKE).collect()}
    given = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = brute_hits([t for _, t in given], [(r["item_id"], r["text"]) for r in bench.collect()], 10)
    assert rows == {i: w for (i, _), w in zip(given, want, strict=True)}
    assert any(w[4] for w in want) and not all(w[4] for w in want)


@pytest.mark.parametrize("block_chars", [10**6, 40])
def test_decontamination_of_random_texts_in_blocks(spark, block_chars):
    rng = random.Random(9)
    text = lambda n, al="abcd": " ".join(rng.choice(al) for _ in range(n))
    items = [(i, text(rng.randint(0, 14), rng.choice(["ab", "abcdefgh"]))) for i in range(12)] + [(None, "one, Two THREE"), (3, "zz"), (99, None), (100, "")]
    docs = [" ".join([text(rng.randint(0, 60)), rng.choice([t for _, t in items if t]), text(3)]) for _ in range(40)]
    docs += [None, "", "zz", docs[0], docs[0], "one two\nthree"]
    table = spark.createDataFrame([(i // 2, t, 1) for i, t in enumerate(docs)], "doc_id long, text string, items int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_contamination(table, bench, window=5, block_chars=block_chars).collect()
    want = brute_hits(docs, items, 5)
    assert Counter((r["doc_id"], *(r[c] for c in COLUMNS)) for r in got) == Counter((i // 2, *w) for i, w in enumerate(want))
    assert decontaminate.find_contamination(table.where("false"), bench).count() == 0
    assert not any(r["contaminated"] for r in decontaminate.find_contamination(table, bench.where("false")).collect())


def test_fm_index_finds_all_places():
    rng = random.Random(6)
    for _ in range(100):
        sequence = np.array([rng.randint(1, rng.choice([2, 5, 40])) for _ in range(rng.randint(1, 120))])
        index = decontaminate.FMIndex(sequence)
        for length in (1, 2, 4):
            patterns = np.array([[rng.randint(1, 41) for _ in range(length)] if rng.random() < 0.3 or len(sequence) < length else
                                 sequence[(a := rng.randrange(len(sequence) - length + 1)):a + length].tolist() for _ in range(8)])
            low, high = index.search(patterns)
            for p, a, b in zip(patterns, low, high, strict=True):
                want = [k for k in range(len(sequence) - length + 1) if (sequence[k:k + length] == p).all()]
                assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_cut_words():
    assert decontaminate.cut_words("Keep this. Drop that-now! And keep", [{"start": 2, "end": 5}]) == "Keep this. ! And keep"


def test_pipeline_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMOKE}/benchmark.parquet").collect()]
    scratch = Scratch(spark, "test-stages")
    given, results = docs, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        given = scratch.write(stage(spark, given, SMOKE), f"s{k}")
        results.append(given)
    rows = [{r["doc_id"]: r for r in d.collect()} for d in (docs, *results[:4])]
    assert all(d.columns == docs.columns for d in results[:4])
    # quality: the operator's decisions take effect, every other column is as it was
    kept = {r["row"]["doc_id"] for r in quality.score_quality(docs, quality.references(docs)).where("kept").collect()}
    assert set(rows[1]) == kept and all(rows[1][i] == rows[0][i] for i in kept) and 0 < len(kept) < len(rows[0])
    # near copies: the least id of each component stays
    found = brute_components([(i, r["text"]) for i, r in rows[1].items()])
    assert set(rows[2]) == {c for _, c in found.values()} and all(rows[2][i] == rows[1][i] for i in rows[2])
    # benchmark: no window is left of the old hits, clean documents stay as they are
    for (i, r), w in zip(rows[2].items(), brute_hits([r["text"] for r in rows[2].values()], bench, 10), strict=True):
        if not w[4]:
            assert rows[3][i] == r
        elif i in rows[3]:
            new = rows[3][i]
            assert len(decontaminate.WORD.findall(lower(new["text"]))) == w[0] - w[1] and new["n_chars"] == len(new["text"])
        else:
            assert w[0] == w[1]
    # personal data: no base match is left, documents without any are as they were
    spans = {r["row"]["id"]: r for r in pii.find_pii(results[2]).collect()}
    assert set(rows[4]) == set(rows[3])
    for i, r in rows[4].items():
        if not spans[i]["base"]:
            assert r == rows[3][i]
        else:
            assert all(s["found"] not in r["text"] for s in spans[i]["base"]) and r["n_chars"] == len(r["text"])
    # packing: every token of every document, once
    whole = packing.WordEncoder(queries.tokenizer_path("word_bpe_49k.json")).whole
    lengths = Counter()
    for r in results[4].collect():
        lengths[r["doc_id"]] += r["length"]
    assert lengths == {i: len(whole.encode(r["text"], add_special_tokens=False).ids) + 1 for i, r in rows[4].items()}
    key = lambda d: Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in d.collect())
    assert key(corpus_pipeline.run(spark, SMOKE)) == key(results[4])


def test_pipeline_stages_on_edge_rows(spark):
    long = " ".join(f"word{i} and the of" for i in range(30))
    rows = [(1, long, "en", "x", None, 1), (1, long, "en", "x", None, 1), (None, long, None, None, None, 2), (None, None, None, None, None, 3),
            (2, long + " mail me at a.b@c.de now", "en", "y", 5, 4), (3, "", "en", None, 0, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept int")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMOKE)
        got = out.collect()
        if name != "best-fit packing":
            assert out.columns == docs.columns
        assert stage(spark, docs.where("false"), SMOKE).count() == 0
        if name == "n-gram Jaccard join":
            assert sorted((r["doc_id"] or -1, r["kept"]) for r in got) == [(-1, 2), (-1, 3), (1, 1), (3, 5)]
        if name == "PII":
            assert len(got) == 6 and next(r for r in got if r["doc_id"] == 2)["text"] == long + " mail me at [EMAIL] now"
        if name == "benchmark decontamination":
            assert len(got) == 6
        if name == "best-fit packing":
            assert len(got) == 6


def test_a_task_of_decontamination_takes_one_python_worker(spark):
    """Workers stay beside the executor's heap after their task, so a second Python step of a task costs the next stages."""
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k l"), (2, "x"), (None, None)], "doc_id long, text string")
    benchmark = spark.createDataFrame([("q", "b c d e f g h i j k")], "item_id string, text string")
    found = decontaminate.find_contamination(docs, benchmark)
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    blocks = decontaminate.find_contamination(docs, benchmark.unionByName(benchmark.selectExpr("'r' AS item_id", "'x' AS text")),
                                              block_chars=4)
    want = {1: (12, 10, ["q"]), 2: (1, 0, []), None: (0, 0, [])}
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in found.collect()} == want
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in blocks.collect()} == want | {2: (1, 1, ["r"])}


def test_packing_leaves_the_sessions_settings(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert packing.pack_documents(docs, queries.tokenizer_path("word_bpe_49k.json")).count() == 2
    assert spark.conf.get(name, None) == before
