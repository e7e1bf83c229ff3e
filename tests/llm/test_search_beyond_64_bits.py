"""Top-k search where scores pass 64 bits: the ranks follow the exact scores."""

import pytest
from pyspark.sql import functions as F

pytest.importorskip("terrane.llm")

from terrane.llm import maxscore  # noqa: E402


def test_scores_beyond_64_bits_rank_exactly(spark):
    rows = [(0, [1e12]), *[(k, [k * 1e11]) for k in range(1, 9)], *[(104 - k, [-k * 1e11]) for k in range(1, 4)]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = maxscore.top_matches(table, F.col("id") == 0).collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"])] == [(n + 1, 8 - n, 2**63 - 1) for n in range(5)]
    few = maxscore.top_matches(table.where("vec_id = 0 OR vec_id > 100"), F.col("id") == 0).collect()
    assert [(r["vec_id"], r["score"]) for r in sorted(few, key=lambda r: r["rank"])] == [(103, -2**63), (102, -2**63), (101, -2**63)]
