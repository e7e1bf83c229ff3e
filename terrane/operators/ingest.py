"""Parcel-table schema and conformance (the validated ``raw_records`` table)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_RECORDS_SCHEMA = T.StructType([
    T.StructField("schno", T.StringType()),
    T.StructField("recdate1", T.DateType()), T.StructField("docfee1", T.DoubleType()),
    T.StructField("recdate2", T.DateType()), T.StructField("docfee2", T.DoubleType()),
    T.StructField("recdate3", T.DateType()), T.StructField("docfee3", T.DoubleType()),
    T.StructField("recdate4", T.DateType()), T.StructField("docfee4", T.DoubleType()),
    T.StructField("sfla", T.DoubleType()),
    T.StructField("year_blt", T.IntegerType()),
    T.StructField("adj_year_blt", T.IntegerType()),
    T.StructField("units", T.IntegerType()),
    T.StructField("address", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("zip_code", T.StringType()),
    T.StructField("town", T.StringType()),
    T.StructField("abst1", T.StringType()),
    T.StructField("abst2", T.StringType()),
    T.StructField("beds", T.DoubleType()),
    T.StructField("bath_tot", T.DoubleType()),
    T.StructField("garage_size", T.DoubleType()),
    T.StructField("lot_size", T.DoubleType()),
    T.StructField("grade", T.StringType()),
    T.StructField("cond", T.StringType()),
    T.StructField("scenic_view", T.IntegerType()),
])


def conform_records(df: DataFrame, schema: T.StructType = RAW_RECORDS_SCHEMA) -> DataFrame:
    """Project onto the parcel schema: present columns are cast, absent ones are
    typed NULLs, extra columns are dropped (a pure projection, no shuffle)."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields])


# --- S1-S7: text scan, validation, dead-letter split, keyed upsert ------------

from ..functions import clean  # noqa: E402
from ..functions.codes import NA_TOKENS  # noqa: E402

# Input column aliases and defaults for an *absent* column.
ALIASES = {"zip": "zip_code", "acres": "lot_size"}
ABSENT_DEFAULTS = {"units": 1, "sfla": 0.0, "beds": 0.0, "bath_tot": 0.0, "garage_size": 0.0, "lot_size": 0.0}
DATE_FIELDS = ["recdate1", "recdate2", "recdate3", "recdate4"]
LENIENT_FLOATS = ["docfee1", "docfee2", "docfee3", "docfee4", "sfla"]   # bad text -> NULL
STRICT_FLOATS = ["beds", "bath_tot", "garage_size", "lot_size"]          # bad text -> reject
LENIENT_INTS = ["units", "year_blt"]     # bad text -> NULL, fractional/infinite -> reject
STRICT_INTS = ["adj_year_blt"]           # anything but an integer -> reject


def _na_expr(c: str, tokens: list[str]) -> str:
    quoted = ", ".join("'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'" for t in tokens)
    return f"CASE WHEN `{c}` IN ({quoted}) THEN CAST(NULL AS STRING) ELSE `{c}` END AS `{c}`"


def null_na_tokens(df: DataFrame, tokens: list[str] = NA_TOKENS, keep: tuple[str, ...] = ()) -> DataFrame:
    """The all-text scan's missing-value tokens become NULL (every column
    but ``keep``); one SQL expression per column."""
    return df.selectExpr(*[_na_expr(c, tokens) if c not in keep else f"`{c}`" for c in df.columns])


def _text(df: DataFrame, name: str):
    """The raw text of a field (by name or alias), or None if the column is absent."""
    for src, dst in ALIASES.items():
        if dst == name and src in df.columns:
            return F.col(src).cast("string")
    return F.col(name).cast("string") if name in df.columns else None


def validate_records(df: DataFrame, as_of_year: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """S2-S6 in one projection: typed fields plus ``errors`` (array of reasons).

    ``as_of_year`` bounds build years (1800 .. as_of_year + 5); it replaces the
    wall clock. Dates never reject (bad -> NULL); see the field lists above
    for which fields null out and which reject. ``keep`` columns (an input
    position, say) pass through untouched and are not part of ``raw_data``.
    """
    keep = tuple(keep)
    src = [c for c in df.columns if c not in keep]
    out, errors, cleaned = {}, [], {}

    def number(n: str, raw):
        """The field's number, cleaned once in a projection of its own; value and error refer to it."""
        cleaned[f"_n_{n}"] = clean.clean_numeric(raw)
        return F.col(f"_n_{n}")

    for f in RAW_RECORDS_SCHEMA.fields:
        n = f.name
        raw = _text(df, n)
        if raw is None:
            default = ABSENT_DEFAULTS.get(n)
            out[n] = F.lit(default).cast(f.dataType) if default is not None else F.lit(None).cast(f.dataType)
            continue
        if n == "schno":
            out[n] = raw
            errors.append(F.when(raw.isNull(), F.lit("schno: field required")))
        elif n in DATE_FIELDS:
            out[n] = clean.standardize_date(raw)
        elif n in LENIENT_FLOATS:
            out[n] = clean.clean_numeric(raw)
        elif n in STRICT_FLOATS:
            v = number(n, raw)
            out[n] = v
            errors.append(F.when(raw.isNotNull() & v.isNull(), F.lit(f"{n}: not a valid number")))
        elif n in LENIENT_INTS:
            v = number(n, raw)
            bad = v.isNotNull() & ~clean.is_integral(v)
            errors.append(F.when(bad, F.lit(f"{n}: not a valid integer")))
            iv = F.when(~bad, v).try_cast("bigint")
            out[n] = (clean.valid_year(iv, as_of_year) if n == "year_blt" else iv).try_cast(f.dataType)
        elif n in STRICT_INTS:
            v = number(n, raw)
            bad = raw.isNotNull() & (v.isNull() | ~clean.is_integral(v))
            errors.append(F.when(bad, F.lit(f"{n}: not a valid integer")))
            out[n] = F.when(~bad, v).try_cast(f.dataType)
        elif n == "scenic_view":
            out[n] = clean.clean_numeric(raw).try_cast("int")
        else:
            out[n] = raw
    errs = F.filter(F.array(*errors), lambda e: e.isNotNull())
    raw_json = F.to_json(F.struct(*[F.col(c) for c in src]), {"ignoreNullFields": "false"})
    df = df.withColumns(cleaned) if cleaned else df
    return df.select(*[v.alias(k) for k, v in out.items()], *keep, errs.alias("errors"), raw_json.alias("raw_data"))


def accepted(validated: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows without a validation error, in the parcel schema."""
    return validated.where(F.size("errors") == 0).select(*[f.name for f in RAW_RECORDS_SCHEMA.fields], *keep)


def rejected(validated: DataFrame) -> DataFrame:
    """The dead-letter rows ``schno, error_message, raw_data`` (a NULL id
    stays NULL)."""
    return validated.where(F.size("errors") > 0).select(
        "schno", F.array_join("errors", "; ").alias("error_message"), "raw_data")


def upsert_last_wins(rows: DataFrame, key: str = "schno", pos: str = "pos") -> DataFrame:
    """One row per key, the one with the greatest input position.

    ``max_by`` over a struct is a hash aggregate with map-side partial
    aggregation, so a key repeated many times is reduced before the shuffle
    (a window would sort all of that key's rows in one task).
    """
    cols = [c for c in rows.columns if c not in (key, pos)]
    return (rows.groupBy(key).agg(F.max_by(F.struct(*cols), F.col(pos)).alias("_r"))
            .select(key, "_r.*"))


def ingest_counters(validated: DataFrame) -> DataFrame:
    """S7 counters in one aggregate: processed, inserted (accepted rows, counted
    before key replacement, as the reference does) and rejected."""
    ok = F.size("errors") == 0
    return validated.agg(F.count(F.lit(1)).alias("processed"),
                         F.sum(F.when(ok, 1).otherwise(0)).cast("bigint").alias("inserted"),
                         F.sum(F.when(ok, 0).otherwise(1)).cast("bigint").alias("rejected"))


def ingest(df: DataFrame, as_of_year: int, pos: str = "pos") -> tuple[DataFrame, DataFrame]:
    """Text rows with an input position -> (parcel table with one row
    per key, last position winning; dead-letter rows)."""
    text = null_na_tokens(df, keep=(pos,))
    v = validate_records(text, as_of_year, keep=(pos,))
    return upsert_last_wins(accepted(v, keep=(pos,)), "schno", pos), rejected(v)
