"""Registered queries of the operators: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.llm import (collocation, counting, decontaminate, extraction, jaccard, licenses, maxscore, merkle, packing,
                         pii, quality, secrets, spans, urls)
from terrane.llm.common import hex_sha256
from terrane.sources.tables import read_table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


def op2_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts before and after the edit that replaces every base PII span by its placeholder."""
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents")
    found = spans.merged(pii.base_spans(F.coalesce("text", F.lit(""))))
    edits = F.transform(found, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"),
        F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("replacement")))
    return counting.count_with_edits(docs, edits, tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents")).drop("detections")


def op4_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return extraction.extract_main_text(pages, extraction.learn_weights(pages))


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_components(read_table(spark, sf_dir, "documents")).drop("class_sig")


def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.filter_urls(read_table(spark, sf_dir, "pages"))
    return judged.withColumn("mined_rule", F.array_join("mined_rule", " "))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(read_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("row.id").alias("doc_id"), *(spans.count_of(F.col("base"), k).alias(f"n_{k}") for k in pii.KINDS),
        hex_sha256(spans.listed(F.col("base"))).alias("base_sha256"),
        spans.listed(spans.in_order(F.col("base"), F.col("terms"))).alias("spans"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    judged = quality.score_quality(docs, quality.references(docs))
    return judged.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", F.round("char_distance", 4).alias("char_distance"),
                         F.round("word_distance", 4).alias("word_distance"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.drop("word_spans", "items", "text_hash")


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *(spans.count_of(F.col("base"), k).alias(f"n_{k}") for k in secrets.KINDS),
        hex_sha256(spans.listed(F.col("base"))).alias("base_sha256"),
        spans.listed(spans.in_order(F.col("base"), F.col("entropy"))).alias("spans"))


def op11_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = maxscore.top_matches(read_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)
    return found.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tampering_trial(read_table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocation.collocations(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_packing, op2_counts, op3_licenses, op4_extraction, op5_jaccard, op6_urls, op7_pii,
                            op8_quality, op9_decontamination, op10_secrets, op11_topk, op12_merkle, op13_collocations)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _merkle_levels(prefix: str, levels: int) -> str:
    """Levels of hash trees of arity 8: nodes (g, i, h, n), and siblings of all nodes that are not the last of a group."""
    out = []
    for k in range(levels):
        out.append(f"""{prefix}{k + 1} AS (SELECT g, i // 8 AS i, CASE WHEN max(n) = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h,
    max((n + 7) // 8) AS n FROM {prefix}{k} GROUP BY g, i // 8)""")
        out.append(f"""{prefix}s{k} AS (SELECT a.g, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS before,
    coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS after
    FROM {prefix}{k} a JOIN {prefix}{k} b ON a.g = b.g AND a.i // 8 = b.i // 8 WHERE a.n > 1 GROUP BY a.g, a.i)""")
    return ",\n".join(out)


def _merkle_fold(table: str, prefix: str, levels: int, g: str, i: str) -> str:
    """``table`` with ``folded`` and ``proof`` carried through the levels."""
    out = []
    for k in range(levels):
        out.append(f"""{prefix}f{k + 1} AS (SELECT d.* EXCLUDE (folded, proof), CASE WHEN s.i IS NULL THEN folded ELSE sha256(before || folded || after) END AS folded,
    proof || coalesce(before || after, '') AS proof FROM {table if k == 0 else f"{prefix}f{k}"} d LEFT JOIN {prefix}s{k} s ON s.g = d.{g} AND s.i = d.{i} // {8 ** k})""")
    return ",\n".join(out)


def _merkle_leaf(text: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _phrase_tables() -> str:
    """c1 to c4: counts of all phrases of 1 to 4 words by language."""
    return ",\n".join(f"c{k} AS MATERIALIZED (SELECT lang, {', '.join(f'w{j}' for j in range(1, k + 1))}, count(*) AS f FROM q WHERE w{k} IS NOT NULL GROUP BY ALL)" for k in range(1, 5))


def _phrase_cuts(k: int) -> str:
    """Every cut of the candidates of k words. One key per phrase: joins on the language alone would be tried first."""
    def key(table: str, first: int, last: int) -> str:
        return " || ".join([f"{table}.lang || chr(10)", *(f"{table}.w{j} || ' '" for j in range(first, last + 1))])
    return " UNION ALL ".join(
        f"SELECT c.lang, {" || ' ' || ".join(f'c.w{j}' for j in range(1, k + 1))} AS phrase, {k} AS size, {cut} AS cut, c.f AS a, x.f AS l, y.f AS r "
        f"FROM (FROM c{k} WHERE f >= 30) c JOIN c{cut} x ON {key('x', 1, cut)} = {key('c', 1, cut)} JOIN c{k - cut} y ON {key('y', 1, k - cut)} = {key('c', cut + 1, k)}"
        for cut in range(1, k))


ORACLE_SQL: dict[str, str] = {
    "op5_jaccard": rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN []
                          WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                          ELSE list_distinct([array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)]) END AS gs FROM w),
n AS (SELECT doc_id, len(gs)::BIGINT AS n_shingles FROM g),
s AS (SELECT doc_id, hash(unnest(gs)) AS gram FROM g),
o AS (SELECT gram FROM s GROUP BY gram HAVING count(*) > 1),
f AS (SELECT s.* FROM s SEMI JOIN o USING (gram)),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM f a JOIN f b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL),
h AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
      WHERE 100 * c >= 80 * (x.n_shingles + y.n_shingles - c)),
l AS (SELECT a, b FROM h UNION ALL SELECT b, a FROM h),
r AS (SELECT doc_id, doc_id AS reached FROM n UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.reached)
SELECT doc_id, n_shingles, component_id FROM n JOIN (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY 1) AS m USING (doc_id)""",
    "op9_decontamination": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(ws), 10) AS k, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS win
       FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') AS win
       FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM d, ks WHERE len(ws) >= k)),
o AS (SELECT doc_id, item, i, dw.k FROM dw JOIN bw ON bw.win = dw.win AND bw.k = dw.k),
h AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS x FROM o) GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM o) GROUP BY 1)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)""",
    "op11_topk": """
WITH e AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::HUGEINT) AS q FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r, a.vec_id AS query_id, b.vec_id, coalesce(list_sum(list_transform(range(1, 1 + least(len(a.q), len(b.q))), lambda i: a.q[i] * b.q[i])), 0)::BIGINT AS score
      FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.r <> b.r)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s) AS t WHERE rank <= 5""",
    "op12_merkle": f"""
WITH tab AS (SELECT list(c ORDER BY b) AS t FROM (SELECT b, list_reduce([b] || range(8), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
             FROM (SELECT unnest(range(256)) AS b))),
crc AS (SELECT *, xor(4294967295, list_reduce([4294967295] || list_transform(regexp_extract_all(doc_id::VARCHAR, '.'), lambda c: ascii(c)::BIGINT),
               lambda a, c: xor(a >> 8, t[1 + (xor(a, c) & 255)]))) AS crc32 FROM documents, tab),
doc AS (SELECT doc_id, coalesce('=' || lang, '') AS g, {_merkle_leaf("text")} AS leaf,
               CASE WHEN crc32 % 3 = 0 THEN {_merkle_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS other FROM crc),
d AS (SELECT doc_id, g, leaf, coalesce(other, leaf) AS folded, '' AS proof, row_number() OVER (PARTITION BY g ORDER BY doc_id, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM doc),
a0 AS (SELECT g, i, leaf AS h, n FROM d),
{_merkle_levels("a", 8)},
b0 AS (SELECT 0 AS g, row_number() OVER (ORDER BY g) - 1 AS i, h, count(*) OVER () AS n, g AS lang FROM a8),
{_merkle_levels("b", 4)},
{_merkle_fold("d", "a", 8, "g", "i")},
u AS (SELECT f.*, b0.i AS place, b0.g AS one, b0.h AS subroot FROM af8 f JOIN b0 ON b0.lang = f.g),
{_merkle_fold("u", "b", 4, "one", "place")}
SELECT doc_id, leaf, subroot, b4.h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = b4.h AS verified FROM bf4, b4""",
    "op13_collocations": rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
v AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
q AS MATERIALIZED (SELECT lang, unnest(ws) AS w1, unnest(ws[2:]) AS w2, unnest(ws[3:]) AS w3, unnest(ws[4:]) AS w4 FROM v),
{_phrase_tables()},
n AS (SELECT lang, count(*) AS n FROM q GROUP BY 1),
x AS ({" UNION ALL ".join(map(_phrase_cuts, (2, 3, 4)))}),
s AS MATERIALIZED (SELECT *, ((2000000::HUGEINT * a) // (l + r))::BIGINT AS score FROM x),
m AS MATERIALIZED (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
i AS MATERIALIZED (SELECT lang, list_aggregate(string_split(phrase, ' ')[b:e], 'string_agg', ' ') AS phrase, max(a) AS longer
      FROM (SELECT lang, phrase, a, size, b, unnest(range(b + 1, size + 1)) AS e FROM (SELECT *, unnest(range(1, size)) AS b FROM m)) WHERE e - b + 1 < size GROUP BY 1, 2),
o AS (SELECT m.* FROM m LEFT JOIN i USING (lang, phrase) WHERE 100 * coalesce(longer, 0) < 80 * a)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score FROM o) AS t JOIN n USING (lang) WHERE rank <= 2000""",
}
