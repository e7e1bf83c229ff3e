"""Secret scans (operator 10): base patterns, and sliding-window entropy per character class. Native plans only.

Candidate strings are runs of at least ``WINDOW`` characters of the widest class. For each class (hexadecimal digits,
base-64 characters) the runs of its characters inside a candidate are read with a sliding window. The window keeps the
counts of its characters and the sum S of c * log2(c) over them; one character entering or leaving changes one count
and S by a difference, and the Shannon entropy is log2(w) - S / w. Windows whose entropy reaches the class's limit and
that mix letters and digits mark their characters; marked stretches become ``entropy`` spans.

The allow list suppresses what it matches and no more: windows that touch a UUID or a placeholder word, windows that lie
in a path of plain words or in groups of digits, and stretches inside a base span (already reported). What stands
before or behind is judged as ever.

Defined results: a null text is empty (no spans); equal rows give equal results; extra columns are ignored; an empty
table gives an empty result. Texts are scanned whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrane.llm.spans import in_order, merged, no_spans, pattern_spans

KINDS = ("assign", "access", "hex")
ENTROPY = "entropy"
WINDOW = 24

ASSIGN = r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_VALUE = r"""^(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
#: Class: pattern of its characters, least entropy of a window (bits per character).
CLASSES = {"hex": ("[0-9A-Fa-f]", 3.0), "base64": ("[A-Za-z0-9+/_=-]", 3.9)}
CANDIDATE = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{WINDOW},}}+"
#: Windows that touch one of these are no secret.
ALLOW_TOUCHED = r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}|(?i:example|placeholder|changeme|dummy|xxxx|0123456789|abcdefgh)"
#: Windows that lie in one of these are no secret.
ALLOW_AROUND = r"(?:[A-Za-z][a-z]{1,19}(?:[_-][a-z]{1,19})*/){2,}[A-Za-z0-9]{0,8}|[0-9]+(?:-[0-9]+)*"


def base_spans(text: Column) -> Column:
    """Base spans of a text, by start, then kind; matches that fail their check are dropped."""
    keyed = text.rlike("(?i)password|passwd|secret|token|api_?key")
    return in_order(
        pattern_spans(text, ASSIGN, "assign", 0, keyed, lambda f: F.length(F.regexp_extract(f, ASSIGN_VALUE, 1)) >= 6),
        pattern_spans(text, "AKIA[A-Z0-9]{16,}+", "access", 1, F.contains(text, F.lit("AKIA"))),
        pattern_spans(text, "[0-9a-f]{24,}+", "hex", 2, text.rlike("[0-9a-f]{24}")))


def _c_log_c(c: Column) -> Column:
    return F.when(c > 1, c * F.log2(c.cast("double"))).otherwise(F.lit(0.0))


def window_marks(run: Column, window: int, limit: float) -> Column:
    """Starts of the windows of a run of characters whose entropy reaches the limit, by incremental counts."""
    chars = F.split(run, "")
    kinds = "map<string, int>"
    state = F.struct(F.map_from_arrays(F.array(), F.array()).cast(kinds).alias("counts"), F.lit(0.0).alias("s"),
                     F.array().cast("array<int>").alias("marks"))

    def count(counts: Column, ch: Column) -> Column:
        return F.coalesce(F.try_element_at(counts, ch), F.lit(0))

    def put(counts: Column, ch: Column, n: Column) -> Column:
        others = F.map_filter(counts, lambda k, _: k != ch)
        return F.map_concat(others, F.map_from_arrays(F.array(ch), F.array(n))).cast(kinds)

    def enter(st: Column, ch: Column) -> Column:
        n = count(st["counts"], ch)
        return F.struct(put(st["counts"], ch, n + 1).alias("counts"), (st["s"] + _c_log_c(n + 1) - _c_log_c(n)).alias("s"),
                        st["marks"].alias("marks"))

    def leave(st: Column, ch: Column) -> Column:
        n = count(st["counts"], ch)
        return F.struct(put(st["counts"], ch, n - 1).alias("counts"), (st["s"] + _c_log_c(n - 1) - _c_log_c(n)).alias("s"),
                        st["marks"].alias("marks"))

    def step(st: Column, i: Column) -> Column:
        # one aggregate step per character: enter it, let the one before the window go, judge the full window
        entered = F.aggregate(F.array(F.get(chars, i)), st, enter)
        gone = F.when(i >= window, F.array(F.get(chars, i - window))).otherwise(F.array().cast("array<string>"))
        moved = F.aggregate(gone, entered, leave)
        high = (i >= window - 1) & (F.lit(math.log2(window)) - moved["s"] / window >= limit)
        marks = F.when(high, F.array_append(moved["marks"], (i - window + 1).cast("int"))).otherwise(moved["marks"])
        return F.struct(moved["counts"].alias("counts"), moved["s"].alias("s"), marks.alias("marks"))

    places = F.sequence(F.lit(0), F.length(run) - 1)
    return F.when(F.length(run) >= window, F.aggregate(places, state, step, lambda st: st["marks"])).otherwise(F.array().cast("array<int>"))


def _runs(candidate: Column, chars: str) -> Column:
    return pattern_spans(candidate, f"{chars}{{{WINDOW},}}+", ENTROPY, 3, F.lit(True))


def entropy_spans(text: Column, base: Column) -> Column:
    """Stretches of high entropy, merged, that no base span holds."""
    candidates = F.filter(pattern_spans(text, CANDIDATE, ENTROPY, 3, text.rlike(f"[A-Za-z0-9+/_=-]{{{WINDOW}}}")),
                          lambda c: _may_be_secret(c["found"]) & ~_inside(c, base))

    def marked(chars: str, limit: float) -> Column:
        def in_run(c: Column, r: Column) -> Column:
            touched = pattern_spans(c["found"], ALLOW_TOUCHED, ENTROPY, 3, F.lit(True))
            around = pattern_spans(c["found"], ALLOW_AROUND, ENTROPY, 3, F.lit(True))
            marks = F.transform(window_marks(r["found"], WINDOW, limit), lambda at: r["start"] + at)
            marks = F.filter(marks, lambda at: ~F.exists(touched, lambda a: (a["start"] < at + WINDOW) & (at < a["end"]))
                             & ~F.exists(around, lambda a: (a["start"] <= at) & (at + WINDOW <= a["end"])))
            return F.transform(marks, lambda at: F.struct(
                (c["start"] + at).alias("start"), (c["start"] + at + WINDOW).alias("end"), F.lit(3).alias("rank"),
                F.lit(ENTROPY).alias("kind"), F.lit("").alias("found")))
        return F.flatten(F.transform(candidates, lambda c: F.flatten(
            F.transform(_runs(c["found"], chars), lambda r: in_run(c, r)))))

    found = [marked(chars, limit) for chars, limit in CLASSES.values()]
    stretches = F.transform(merged(in_order(*found)), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.lit(3).alias("rank"), s["kind"].alias("kind"), F.lit("").alias("found")))
    return F.when(F.size(candidates) == 0, no_spans()).otherwise(F.filter(stretches, lambda s: ~_inside(s, base)))


def _may_be_secret(found: Column) -> Column:
    return found.rlike("[0-9]") & found.rlike("[A-Za-z]")


def _inside(span: Column, base: Column) -> Column:
    return F.exists(base, lambda b: (b["start"] <= span["start"]) & (span["end"] <= b["end"]))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document row: id, base (base spans), entropy (further spans of high entropy)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (docs.select(F.col(id_col).alias(id_col), text.alias("text"))
            .withColumn("base", base_spans(F.col("text")))
            .select(id_col, "base", entropy_spans(F.col("text"), F.col("base")).alias("entropy")))
