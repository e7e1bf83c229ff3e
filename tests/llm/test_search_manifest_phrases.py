"""Exact top-k search, the Merkle manifest and phrase collocations against brute force; edges."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("terrane.llm")

from terrane.llm import collocation, maxscore, merkle  # noqa: E402


# --- top-k search ---

def brute_matches(rows, top):
    """Counter of (query_id, rank, vec_id, score); queries are ids divisible by 3."""
    own = [(i, [math.floor(256 * np.float64(x)) if abs(x) < 1e300 else math.floor(x) * 256 for x in v]) for i, v in rows
           if i is not None and v is not None and not any(x is None or not math.isfinite(x) for x in v)]
    out = Counter()
    for a, (i, q) in enumerate(own):
        if i % 3 == 0:
            found = sorted((-sum(x * y for x, y in zip(q, v)), j) for b, (j, v) in enumerate(own) if b != a)[:top]
            out.update((i, r, j, max(-2**63, min(2**63 - 1, -s))) for r, (s, j) in enumerate(found, 1))
    return out


def matches(spark, rows, top=5):
    table = spark.createDataFrame([(i, v, 7) for i, v in rows], "vec_id long, embedding array<double>, score int")
    got = maxscore.top_matches(table, F.col("id") % 3 == 0, top)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return Counter(tuple(r) for r in got.collect())


@pytest.mark.parametrize("least", [4, 4096])
def test_search_equals_brute_force(spark, monkeypatch, least):
    monkeypatch.setattr(maxscore, "LEAST_SHARD_ROWS", least)
    monkeypatch.setattr(maxscore, "LEAST_BLOCK_QUERIES", least)
    rng = np.random.default_rng(5)
    rows = [(int(k), (rng.normal(size=12) * 0.3).tolist()) for k in rng.permutation(160)]
    rows += [(3, rows[0][1]), (3, rows[0][1]), (600, [0.0] * 12), (603, []), (606, [0.5]), (609, [-1.0] * 12)]
    rows += [(None, [1.0] * 12), (12, None), (15, [1.0, None]), (18, [math.nan] * 12), (21, [math.inf])]
    assert matches(spark, rows) == brute_matches(rows, 5)


def test_search_with_ties_few_rows_and_large_numbers(spark):
    same = [(k, [0.25, -0.5]) for k in range(9)]
    assert matches(spark, same, 3) == brute_matches(same, 3)
    few = [(0, [0.5]), (1, [-0.5]), (2, [0.1])]
    assert matches(spark, few) == brute_matches(few, 5) and sum(matches(spark, few).values()) == 2
    large = [(0, [1e9, 1.0]), (1, [1e9, 0.5]), (2, [1e9, 0.25]), (3, [-1e308, 3.0]), (4, [0.001, 2e7])]
    assert matches(spark, large) == brute_matches(large, 5)
    assert matches(spark, [(1, [1.0])]) == Counter()
    table = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert maxscore.top_matches(table, F.col("id") % 3 == 0).count() == 0


def test_search_prunes_without_losing(monkeypatch):
    """Non-essential lists are left out and candidates go early; the best stay."""
    rng = np.random.default_rng(1)
    values = np.floor(rng.normal(size=(500, 40)) * rng.exponential(30, 40))
    shard = maxscore.Shard(np.arange(500), np.arange(500), values)
    for _ in range(30):
        q = np.floor(rng.normal(size=40) * 50)
        got = shard.search(q, 3, 5)
        scores = values @ q
        want = sorted((-s, k) for k, s in enumerate(scores.tolist()) if k != 3)[:5]
        assert got[:5] == [(k, int(-s)) for s, k in want]


# --- Merkle manifest ---

def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_tree(leaves, arity=8):
    """Root, and for each leaf the list of (before, after) up to it."""
    level, paths, at = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        runs = [level[k:k + arity] for k in range(0, len(level), arity)]
        for p, k in zip(paths, at):
            run, slot = runs[k // arity], k % arity
            p.append(("".join(run[:slot]), "".join(run[slot + 1:])))
        level, at = [sha(*r) for r in runs], [k // arity for k in at]
    return level[0], paths


def brute_manifest(rows):
    def leaf(r):
        return sha(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in r))

    groups = {}
    for r in rows:  # doc_id, source, lang, n_chars, text
        groups.setdefault(r[2], []).append(r)
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in langs:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = brute_tree([leaf(r) for r in groups[g]])
    root, upper = brute_tree([trees[g][0] for g in langs]) if langs else (None, [])
    out = Counter()
    for g, above in zip(langs, upper):
        for r, path in zip(groups[g], trees[g][1]):
            other, text = leaf(r), r[4]
            if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                other = leaf((*r[:4], re.sub("[A-Z]", lambda m: m[0].lower(), text)))
            for before, after in path + above:
                other = sha(before, other, after)
            out[(r[0], leaf(r), trees[g][0], root, sha(*(b + a for b, a in path + above)), other, other == root)] += 1
    return out


MANIFEST = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
DOCS = "doc_id long, source string, lang string, n_chars long, text string, h string, size int"


def manifest(spark, rows):
    got = merkle.tampering_trial(spark.createDataFrame([(*r, "x", 1) for r in rows], DOCS))
    assert set(got.columns) == set(MANIFEST)
    return Counter(tuple(r) for r in got.select(*MANIFEST).collect())


@pytest.mark.parametrize("size", [0, 1, 8, 9, 600])
def test_manifest_equals_brute_force(spark, size):
    rng = random.Random(size)
    langs = ["en"] * 6 + ["fr", "DE", "é", None, ""]
    rows = [(k * 7, rng.choice(["s", None]), rng.choice(langs), rng.choice([k, None]), rng.choice(["Ab c", "abc", "", "ÄB", None, "X" * 3000])) for k in range(size)]
    if size > 1:
        rows += [rows[0], (None, "s", "en", 1, "Ab"), (None, "s", "en", 1, "Ac"), (2**53 + 1, "s", "en", 2, "Z"), (2**53 + 2, "s", "zz", 2, "Z")]
    rng.shuffle(rows)
    assert manifest(spark, rows) == brute_manifest(rows)


def test_manifest_of_one_group_over_many_partitions(spark):
    """All rows in one group, more groups than an arity has, and a binary tree."""
    rows = [(k, "s", "en", 1, f"T{k}") for k in range(700)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 40)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        assert manifest(spark, rows) == brute_manifest(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)
    many = [(k, "s", f"l{k % 70}", 1, f"t{k}") for k in range(200)]
    assert manifest(spark, many) == brute_manifest(many)
    table = spark.createDataFrame([(k, "g") for k in range(5)], "doc_id long, lang string")
    got = merkle.build_manifest(table, fields=("doc_id",), arity=2).orderBy("doc_id").collect()
    root, paths = brute_tree([sha(f"1:{k}") for k in range(5)], 2)
    assert {r["root"].hex() for r in got} == {root} and [[(s["before"].hex(), s["after"].hex()) for s in r["path"]] for r in got] == paths


# --- phrase collocations ---

def brute_phrases(rows, least, longest, top, cover):
    counts, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                for k in range(len(words) - size + 1):
                    key = (lang, tuple(words[k:k + size]))
                    counts[key] = counts.get(key, 0) + 1
    found = {}
    for (lang, p), a in counts.items():
        if len(p) > 1 and a >= least:
            cuts = [(2_000_000 * a // (counts[lang, p[:k]] + counts[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found[lang, p] = (a, counts[lang, p[:k]], counts[lang, p[k:]], score)
    covered = {(lang, p[b:e]) for (lang, p), (a, *_) in found.items() for b in range(len(p)) for e in range(b + 2, len(p) + 1)
               if e - b < len(p) and (lang, p[b:e]) in found and 100 * a >= cover * found[lang, p[b:e]][0]}
    out = []
    for lang in n:
        own = sorted((-s, -a, " ".join(p).encode(), l, r) for (g, p), (a, l, r, s) in found.items() if g == lang and (g, p) not in covered)[:top]
        out += [(lang, k, w.decode(), -a, l, r, n[lang], -s) for k, (s, a, w, l, r) in enumerate(own, 1)]
    return Counter(out)


def phrases(spark, rows, least=3, longest=4, top=50, cover=80):
    table = spark.createDataFrame([(1, lang, text, "x", 5) for lang, text in rows], "doc_id long, lang string, text string, phrase string, n int")
    got = collocation.collocations(table, least, longest, top, cover)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return Counter(tuple(r) for r in got.collect())


def random_texts(seed, n):
    rng = random.Random(seed)
    words = ["the", "The", "new", "york", "city", "é", "ÉT", "a-b", "x", "y", " ", "n\u0000ul"]
    text = lambda: "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n", "!? ", "\x0b"]) for _ in range(rng.randint(0, 60)))
    rows = [(rng.choice(["en", "en", "en", "fr", None, "und"]), text()) for _ in range(n)]
    return rows + [("en", None), ("fr", ""), ("zz", " . "), ("en", rows[0][1]), ("en", rows[0][1])]


@pytest.mark.parametrize("slice_bytes", [50, 8 << 20])
def test_phrases_equal_brute_force(spark, monkeypatch, slice_bytes):
    monkeypatch.setattr(collocation, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(collocation, "BUCKET_ROWS", 40)
    rows = random_texts(slice_bytes, 120)
    got = phrases(spark, rows)
    assert got == brute_phrases(rows, 3, 4, 50, 80) and any(" " in r[2] for r in got)
    assert phrases(spark, rows, 2, 3, 7, 60) == brute_phrases(rows, 2, 3, 7, 60)


def test_phrases_of_repeated_words_a_long_text_and_no_text(spark, monkeypatch):
    monkeypatch.setattr(collocation, "SLICE_BYTES", 2000)
    rows = [("en", "la " * 500), ("en", ("tra la la, " * 3000) + "end" + " w" * 5000), ("fr", "solo")]
    assert phrases(spark, rows) == brute_phrases(rows, 3, 4, 50, 80)
    assert phrases(spark, [("en", None)]) == phrases(spark, []) == Counter()


def test_scores_are_exact_beyond_64_bits(spark):
    big = 3 * 10**18
    table = spark.createDataFrame([(1, "en", "a b", big, [big, big], [big - 1, big])], "id long, lang string, phrase string, f long, heads array<long>, tails array<long>")
    assert collocation.scored(table, 2).first()["score"] == 2_000_000 * big // (2 * big - 1)
