"""Column expressions for the derived attributes (Q2, Q3a-Q3l).

All of them are native Catalyst expressions, so they stay inside whole-stage
codegen; none is a Python UDF.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import codes


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_map(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def decode(c, mapping: dict, default) -> Column:
    """Literal lookup with a default (NULL key goes to the default, as a CASE does)."""
    return F.coalesce(literal_map(mapping)[_col(c)], F.lit(default))


# Q2 ------------------------------------------------------------------------

def estimated_price(fee) -> Column:
    """Truncated price: a fee under 10,000 is 0.01% of the price."""
    fee = _col(fee)
    return F.when(fee < 10000, fee * 10000).otherwise(fee).cast("bigint")


def estimated_value(fee) -> Column:
    """Untruncated double form of the same rule (inventory and buyer queries)."""
    fee = _col(fee)
    return F.when(fee < 10000, fee * 10000).otherwise(fee)


# Q3a / Q3b ---------------------------------------------------------------------

def town_city(town="town") -> Column:
    return decode(town, codes.TOWN_CITY, codes.TOWN_CITY_DEFAULT)


def town_city_ml(town="town") -> Column:
    return decode(town, codes.TOWN_CITY_ML, codes.TOWN_CITY_ML_DEFAULT)


# Q3c ---------------------------------------------------------------------------

def _either(a: Column, b: Column, values) -> Column:
    return a.isin(values) | b.isin(values)


def property_type(abst1="abst1", abst2="abst2", vacant_land: bool = False) -> Column:
    """First match wins; a NULL comparison falls through as in SQL."""
    a, b = _col(abst1), _col(abst2)
    expr = (F.when(_either(a, b, codes.SINGLE_FAMILY_CODES), "Single Family")
            .when(_either(a, b, codes.CONDO_CODES), "Condo")
            .when(_either(a, b, codes.TOWNHOUSE_CODES), "Townhouse"))
    if vacant_land:
        expr = expr.when(a.isin(codes.VACANT_LAND_CODES) & (b.isNull() | (b == "0")), "Vacant Land")
    return expr.otherwise("Other")


def property_type_dashboard(abst1="abst1", description=None) -> Column:
    """The browser's variant (kept as a named variant): codes and description
    words in its own order; anything else is Single Family."""
    a = F.trim(_col(abst1).cast("string"))
    d = _col(description) if description is not None else F.lit(" ")
    expr = None
    for label, code_list, words in codes.DASHBOARD_TYPE_RULES:
        cond = a.isin(code_list)
        for w in words:
            cond = cond | d.contains(w)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(codes.DASHBOARD_TYPE_DEFAULT)


# Q3d ---------------------------------------------------------------------------

def owner_location(city="city", state="state") -> Column:
    c, s = _col(city), _col(state)
    return (F.when(c.isin(codes.LOCAL_TOWNS), codes.LOCATION_LOCAL)
            .when(s == codes.HOME_STATE, codes.LOCATION_IN_STATE)
            .otherwise(codes.LOCATION_OUT_OF_STATE))


def owner_location_label(city="city", state="state") -> Column:
    local, in_state, out = codes.OWNER_LOCATION_LABELS
    c, s = _col(city), _col(state)
    return F.when(c.isin(codes.LOCAL_TOWNS), local).when(s == codes.HOME_STATE, in_state).otherwise(out)


# Q3e / Q3f ---------------------------------------------------------------------

def is_renovated(adj="adj_year_blt", built="year_blt") -> Column:
    return F.when(_col(adj) > _col(built), 1).otherwise(0)


def guarded_ppsf(price, sfla="sfla") -> Column:
    s = _col(sfla)
    return F.when(s > 100, _col(price) / s)


# Q3g / Q3h ---------------------------------------------------------------------

def building_class(description) -> Column:
    d = F.lower(F.coalesce(_col(description).cast("string"), F.lit("nan")))
    expr = None
    for label, words in codes.BUILDING_CLASS_KEYWORDS:
        cond = reduce(lambda x, y: x | y, [d.contains(w) for w in words])
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(codes.BUILDING_CLASS_DEFAULT)


def owner_type(name, word_boundary: bool = False) -> Column:
    """Entity type from the owner name. Default mode matches substrings, as the
    reference does (so PATRICK is a Trust); ``word_boundary`` matches whole words."""
    n = F.upper(_col(name))
    expr = F.when(n.isNull(), codes.OWNER_TYPE_UNKNOWN)
    for label, words in codes.OWNER_TYPE_KEYWORDS:
        if word_boundary:
            cond = n.rlike(r"\b(" + "|".join(words) + r")\b")
        else:
            cond = reduce(lambda x, y: x | y, [n.contains(w) for w in words])
        expr = expr.when(cond, label)
    return expr.otherwise(codes.OWNER_TYPE_DEFAULT)


# Q3i ---------------------------------------------------------------------------

def ownership_category(n_properties) -> Column:
    n = _col(n_properties)
    return F.when(n == 1, "1 Property").when(n == 2, "2 Properties").otherwise("3+ Properties")


# Q3j ---------------------------------------------------------------------------

def physical_address(num="num", pdir="pdir", name="name", suff="suff", sdir="sdir", unit="unit") -> Column:
    """Upper-cased street address; nulls and a zero house number are skipped."""
    n = _col(num)
    n_txt = F.when(n.isNotNull() & (F.trim(n.cast("string")) != "0")
                   & (F.trim(n.cast("string")) != "0.0"),
                   F.regexp_replace(F.trim(n.cast("string")), r"\.0$", ""))
    u = _col(unit)
    parts = [n_txt, _col(pdir), _col(name), _col(suff), _col(sdir),
             F.when(u.isNotNull() & (F.trim(u) != ""), F.concat(F.lit("#"), F.trim(u)))]
    parts = [F.when(F.trim(p.cast("string")) != "", F.trim(p.cast("string"))) for p in parts]
    return F.upper(F.concat_ws(" ", *parts))


# Q3l ---------------------------------------------------------------------------

def quality_ordinal(c) -> Column:
    return decode(c, codes.QUALITY_ORDINAL, codes.QUALITY_DEFAULT)


# Text -> integer with SQLite's prefix rule ('12ab' -> 12, 'abc' -> 0) --------

def sqlite_int(c) -> Column:
    x = _col(c)
    digits = F.regexp_extract(x.cast("string"), r"^\s*([+-]?\d+)", 1)
    return F.when(x.isNotNull(), F.coalesce(digits.try_cast("bigint"), F.lit(0).cast("bigint")))


# Month name (A11) -------------------------------------------------------------

def month_abbr(d) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in codes.MONTH_ABBR]), F.month(_col(d)))
