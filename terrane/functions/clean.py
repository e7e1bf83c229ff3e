"""Text-cleaning column functions for the raw parcel text (S3, S4, S5, id clean).

Every cast is a ``try_`` form: under ANSI mode a plain cast of dirty text
would fail the job instead of nulling one field.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted date layouts, tried in order (US month-first before day-first).
DATE_FORMATS = [
    "M/d/yyyy", "M/d/yyyy h:mm:ss a", "M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss", "yyyy/M/d", "yyyyMMdd", "MMM d yyyy", "MMM d, yyyy", "MMMM d yyyy", "MMMM d, yyyy",
    "d MMM yyyy", "M-d-yyyy", "M/d/yy", "yyyy", "d/M/yyyy",
]
# The nanosecond-timestamp range of the reference's date parser.
MIN_DATE, MAX_DATE = "1677-09-22", "2262-04-11"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: What a letter of a layout stands for, as a pattern; longer ones first.
_PARTS = [("MMMM", "[A-Za-z]+"), ("MMM", "[A-Za-z]+"), ("MM", "[0-9]{2}"), ("M", "[0-9]{1,2}"), ("dd", "[0-9]{2}"), ("d", "[0-9]{1,2}"),
          ("yyyy", "[0-9]{4}"), ("yy", "[0-9]{2}"), ("HH", "[0-9]{2}"), ("H", "[0-9]{1,2}"), ("h", "[0-9]{1,2}"), ("mm", "[0-9]{2}"),
          ("ss", "[0-9]{2}"), ("a", "[AaPp][Mm]"), ("'T'", "T")]


def _shape(layout: str) -> str:
    """Pattern of the texts that a layout can read, between the years of four digits."""
    out, at = "", 0
    while at < len(layout):
        part, pattern = next(((p, r) for p, r in _PARTS if layout.startswith(p, at)), (layout[at], layout[at]))
        out, at = out + pattern, at + len(part)
    return f"^{out}$"


def standardize_date(c) -> Column:
    """S3: text date in any accepted layout -> date; anything else -> NULL.

    The text's shape picks its layouts (a few share one), so a value is read once or twice instead of being tried
    against all layouts, each failure of which costs an exception.
    """
    t = F.trim(_c(c).cast("string"))
    shapes: dict[str, list[str]] = {}
    for layout in DATE_FORMATS:
        shapes.setdefault(_shape(layout), []).append(layout)
    parsed = None
    for shape, layouts in shapes.items():
        read = F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in layouts])
        parsed = F.when(t.rlike(shape), read) if parsed is None else parsed.when(t.rlike(shape), read)
    parsed = parsed.cast("date")
    return F.when(parsed.between(F.lit(MIN_DATE).cast("date"), F.lit(MAX_DATE).cast("date")), parsed)


#: Decimal numbers as text; digits may be grouped by single underscores.
_DIGITS = "[0-9]+(?:_[0-9]+)*"
NUMBER = rf"^[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?|(?i:inf|infinity|nan))$"


def number(t: Column) -> Column:
    """Text -> double where it is a number as a whole; a cast alone would also
    take type suffixes ('12d') and hexadecimal forms."""
    return F.when(t.rlike(NUMBER), F.replace(t, F.lit("_"), F.lit("")).try_cast("double"))


def clean_numeric(c) -> Column:
    """Trimmed text -> double; bad text -> NULL."""
    return number(F.trim(_c(c).cast("string")))


def is_integral(v) -> Column:
    """True for a finite whole number (so '2005.0' passes, '2005.5' and inf do not)."""
    v = _c(v)
    return (v % 1 == 0) & ~F.isnan(v)


def valid_year(y, as_of_year: int, lo: int = 1800, ahead: int = 5) -> Column:
    """A build year within [lo, as_of_year + ahead], else NULL."""
    y = _c(y)
    return F.when(y.between(lo, as_of_year + ahead), y)


def clean_id(c) -> Column:
    """Id clean: '12.0' -> '12' when the text is a whole number, else the text."""
    t = _c(c).cast("string")
    d = number(F.trim(t))
    whole = F.when(is_integral(d), d.try_cast("bigint").cast("string"))
    return F.coalesce(whole, t)
