"""Corpus pipeline: quality rules, n-gram Jaccard join, benchmark decontamination, PII, best-fit packing.

Each stage is a function (spark, docs, sf_dir) -> DataFrame over the rows that the stage before kept; the first four
return the columns of the documents they were given. ``run`` writes every stage's result as Parquet in the shared
checkpoint folder and reads it again as the next one's input.

Defined results: documents of null or empty text fail the quality rules; rows with a null id are never duplicates of
others; ``n_chars`` follows the text where the table has that column; other columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.llm import decontaminate, jaccard, packing, pii, quality
from terrane.llm.common import Scratch, by_value, row_id, texts
from terrane.llm.queries import tokenizer_path
from terrane.sources.tables import read_table

by_value(__name__)


def _whole_row(docs: DataFrame) -> Column:
    """All columns as one struct, so that no column of a stage can clash with them."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc")


def _with_text(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """The columns of ``docs`` from (_doc, new_text); n_chars is counted again where the text is new."""
    out = []
    for c in docs.columns:
        own = F.col(f"_doc.`{c}`")
        if c == "text":
            own = F.coalesce(F.col("new_text"), own)
        elif c == "n_chars":
            own = F.when(F.col("new_text").isNotNull(), F.length("new_text").cast(docs.schema[c].dataType)).otherwise(own)
        out.append(own.alias(c))
    return changed.select(*out)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    judged = quality.score_quality(docs, quality.references(docs), carry=tuple(c for c in docs.columns if c != "doc_id"))
    return judged.where("kept").select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: the one with the least id (one of equal rows)."""
    found = jaccard.similar_components(docs.select("doc_id", "text"))
    heads = (found.where("doc_id = component_id").groupBy("doc_id").agg(F.min("class_sig").alias("sig"))
             .withColumnRenamed("doc_id", "head"))
    named = docs.where("doc_id IS NOT NULL")
    kept = named.select(_whole_row(docs)).join(heads, F.col("_doc.doc_id") == F.col("head"), "left_semi")
    kept = kept.select("_doc.*").dropDuplicates(["doc_id"])
    return kept.unionByName(docs.where("doc_id IS NULL"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words that benchmark windows hit; a document with no other word goes."""
    found = decontaminate.find_contamination(docs, read_table(spark, sf_dir, "benchmark"))
    hit = (found.where("contaminated").select(F.struct(F.col("doc_id").alias("id"), F.col("text_hash").alias("h")).alias("own"), "word_spans")
           .dropDuplicates(["own"]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = [decontaminate.cut_words(t, s) for t, s in zip(texts(batch.column(0)), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()), batch.column(2)], names=["new_text", "_doc"])

    rows = docs.select(row_id("doc_id", "text").alias("row"), _whole_row(docs))
    joined = rows.join(hit, F.col("row").eqNullSafe(F.col("own")), "left")
    doc_type = rows.schema["_doc"].dataType.simpleString()
    changed = (joined.where("own IS NOT NULL").select("_doc.text", "word_spans", "_doc")
               .mapInArrow(cut, f"new_text string, _doc {doc_type}").where(F.col("new_text").rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")))
    same = joined.where("own IS NULL").select(F.lit(None).cast("string").alias("new_text"), "_doc")
    return _with_text(docs, same.unionByName(changed))


def pii_sanitisation(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced, disclosing terms removed or generalised."""
    found = pii.find_pii(docs, extra={"_doc": _whole_row(docs)})
    touched = (F.size("base") > 0) | (F.size("terms") > 0)
    new = F.when(touched, pii.sanitised(F.col("text"), F.col("base"), F.col("terms")))
    return _with_text(docs, found.select("_doc", new.alias("new_text")))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' pieces in sequences of 2048 tokens."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules), ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination), ("PII", pii_sanitisation),
    ("best-fit packing", best_fit_packing)]

#: The stages' tokenizer, references and mined terms have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, sf_dir), f"stage-{k}")
        if k:
            scratch.drop(f"stage-{k - 1}")
    return docs
