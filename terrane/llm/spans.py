"""Spans of pattern matches as native array expressions (no Python in the plan).

A span is struct(start, end, rank, kind, found): code points, end exclusive; ``rank`` orders kinds at equal starts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<start: bigint, end: bigint, rank: int, kind: string, found: string>"
NO_SPANS = f"array<{SPAN}>"


def no_spans() -> Column:
    return F.array().cast(NO_SPANS)


def pattern_spans(text: Column, pattern: str | Column, kind: str, rank: int, gate: Column,
                  passes: Callable[[Column], Column] | None = None) -> Column:
    """All leftmost non-overlapping matches, in order; ``passes`` drops matches without trying others there.

    Each match is taken together with the text between it and the one before (\\G holds it there, so the search is
    linear), and starts are running sums of lengths. ``pattern`` has no capturing groups. ``gate`` must hold for
    every text with a match; other texts are not searched.
    """
    whole = F.concat(F.lit(r"(?s)\G(.*?)("), pattern, F.lit(")")) if isinstance(pattern, Column) else F.lit(rf"(?s)\G(.*?)({pattern})")
    pairs = F.arrays_zip(F.regexp_extract_all(text, whole, 1).alias("gap"),
                         F.regexp_extract_all(text, whole, 2).alias("found"))

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["gap"])
        end = start + F.length(pair["found"])
        span = F.struct(start.alias("start"), end.alias("end"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"),
                        pair["found"].alias("found"))
        kept = F.array_append(state["spans"], span)
        if passes:
            kept = F.when(passes(pair["found"]), kept).otherwise(state["spans"])
        return F.struct(end.alias("at"), kept.cast(NO_SPANS).alias("spans"))

    first = F.struct(F.lit(0).cast("bigint").alias("at"), no_spans().alias("spans"))
    return F.when(gate, F.aggregate(pairs, first, step, lambda s: s["spans"])).otherwise(no_spans())


def in_order(*spans: Column) -> Column:
    """All spans by start, then rank, then end."""
    sortable = F.transform(F.concat(*spans), lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"], s["found"]))
    return F.transform(F.array_sort(sortable), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["rank"].alias("rank"), s["kind"].alias("kind"),
        s["found"].alias("found")))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined in the order given."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def merged(spans: Column) -> Column:
    """Unions of overlapping spans, ordered by start: struct(start, end, kind of the first one)."""
    kinds = "array<struct<start: bigint, end: bigint, kind: string>>"

    def step(state: Column, s: Column) -> Column:
        last = F.element_at(state, -1)
        joined = F.array_append(F.slice(state, 1, F.size(state) - 1), F.struct(
            last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind")))
        fresh = F.array_append(state, F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
        return F.when((F.size(state) > 0) & (s["start"] < F.get(state, F.size(state) - 1)["end"]), joined).otherwise(fresh).cast(kinds)

    return F.aggregate(spans, F.array().cast(kinds), step)


def replaced(text: Column, pieces: Column, replacement: Callable[[Column], Column]) -> Column:
    """The text with each merged span replaced."""
    state = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(s: Column, p: Column) -> Column:
        before = text.substr((s["at"] + 1).cast("int"), (p["start"] - s["at"]).cast("int"))
        return F.struct(p["end"].alias("at"), F.concat(s["parts"], F.array(before, replacement(p))).alias("parts"))

    def finish(s: Column) -> Column:
        rest = text.substr((s["at"] + 1).cast("int"), F.length(text))
        return F.array_join(F.array_append(s["parts"], rest), "")

    return F.when(F.size(pieces) == 0, text).otherwise(F.aggregate(pieces, state, step, finish))
