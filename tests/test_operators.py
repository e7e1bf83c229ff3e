"""Operator invariants and brute-force checks on small inputs."""

import datetime as dt
import math
import random

import numpy as np
from pyspark.sql import functions as F

from terrane.functions import geo as g
from terrane.functions.stats import pearson_p_value
from terrane.operators import asof
from terrane.operators.ordering import global_rank
from terrane.operators.quantile import exact_quantiles


def test_exact_quantiles_match_numpy_on_skewed_groups(spark):
    rnd = random.Random(7)
    rows = [("hot", float(rnd.randint(0, 5000))) for _ in range(20000)]
    rows += [(f"k{i % 7}", rnd.random() * 100) for i in range(700)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: (r.q1, r.med) for r in exact_quantiles(df, ["k"], "v", {"q1": 0.25, "med": 0.5}, accuracy=100).collect()}
    for k in {r[0] for r in rows}:
        vals = np.array([v for kk, v in rows if kk == k])
        assert math.isclose(got[k][0], np.quantile(vals, 0.25), rel_tol=1e-12, abs_tol=1e-9)
        assert math.isclose(got[k][1], np.quantile(vals, 0.5), rel_tol=1e-12, abs_tol=1e-9)


def test_global_rank_is_a_permutation_in_order(spark):
    df = spark.range(0, 5000).withColumn("d", (F.col("id") % 13).cast("int"))
    r = global_rank(df, ["d", "id"], "rank", partitions=7).collect()
    assert sorted(x["rank"] for x in r) == list(range(5000))
    by_rank = [(x["d"], x["id"]) for x in sorted(r, key=lambda x: x["rank"])]
    assert by_rank == sorted(by_rank)


def _asof_brute(left, right):
    out = []
    for d in left:
        prior = [(rd, v) for rd, v in right if rd <= d]
        out.append((d, max(prior)[1] if prior else None))
    return sorted(out, key=lambda x: (x[0], -1 if x[1] is None else x[1]))


def test_asof_matches_brute_force(spark):
    rnd = random.Random(3)
    base = dt.date(2000, 1, 1)
    right = sorted({(base + dt.timedelta(days=rnd.randint(0, 3000)), float(i)) for i in range(40)})
    right = list({d: (d, v) for d, v in right}.values())
    left = [base + dt.timedelta(days=rnd.randint(-100, 3300)) for _ in range(500)]
    L = spark.createDataFrame([(d,) for d in left], "d date")
    R = spark.createDataFrame(right, "rd date, v double")
    want = _asof_brute(left, right)
    got = sorted(((r.d, r.v) for r in asof.asof_join(L, R, "d", "rd", ["v"]).collect()),
                 key=lambda x: (x[0], -1 if x[1] is None else x[1]))
    assert got == want


def test_asof_with_repeated_and_missing_dates(spark):
    day = dt.date(2020, 2, 1)
    L = spark.createDataFrame([(1, day), (2, day - dt.timedelta(days=1)), (3, None), (4, day)], "i int, d date")
    R = spark.createDataFrame([(day, 1, 5.0), (day, 2, 3.0), (None, 9, 7.0)], "rd date, pos int, v double")
    got = sorted((r.i, r.v) for r in asof.asof_join(L, R, "d", "rd", ["v"], right_order="pos").collect())
    assert got == [(1, 3.0), (2, None), (3, None), (4, 3.0)]


def test_global_fill_matches_pandas(spark):
    import pandas as pd

    rnd = random.Random(5)
    rows = [(i, rnd.choice([None, float(i)]) if i > 3 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "k long, v double")
    got = {r.k: r.v for r in asof.global_fill(df, ["k"], ["v"]).collect()}
    want = pd.Series([v for _, v in rows]).ffill().bfill().tolist()
    assert [got[k] for k in range(400)] == want


def test_utm_distance_agrees_with_haversine_nearby():
    lat, lon = 39.48, -106.06
    x1, y1 = g.utm_forward(lat, lon, g.PY_MATH)
    x2, y2 = g.utm_forward(lat + 0.01, lon + 0.01, g.PY_MATH)
    planar_miles = math.hypot(x2 - x1, y2 - y1) * 0.000621371
    sphere_miles = g.haversine_miles(lat, lon, lat + 0.01, lon + 0.01, g.PY_MATH)
    assert abs(planar_miles - sphere_miles) / sphere_miles < 0.005


def _segment_metres(px, py, x1, y1, x2, y2):
    dx, dy = x2 - x1, y2 - y1
    t = max(0.0, min(1.0, ((px - x1) * dx + (py - y1) * dy) / (dx * dx + dy * dy))) if dx or dy else 0.0
    return math.hypot(px - (x1 + t * dx), py - (y1 + t * dy))


def test_nearest_segments_equal_brute_force(spark):
    """Near and far points, long lines, single points as lines, a resort without lines, and points that repeat."""
    from terrane.functions import codes
    from terrane.operators import geo

    rng = random.Random(2)
    words = {"Peak 8 A": "dist_breck", "the BEAVER RUN": "dist_breck", "River Run": "dist_keystone", "x zuma y": "dist_abasin"}
    lines = []
    for _ in range(60):
        lon, lat = -106.2 + rng.random() * 0.4, 39.4 + rng.random() * 0.3
        size = rng.choice([0.0, 0.001, 0.01, 0.3])
        lines.append((rng.choice([*words, "Gondola", None]), lon, lat, lon + rng.uniform(-size, size), lat + rng.uniform(-size, size)))
    points = [(39.4 + rng.random() * 0.3, -106.2 + rng.random() * 0.4) for _ in range(150)] + [(41.0, -101.0), (35.5, -109.9), (39.5, -106.0)]
    points += points[:5] + [(None, -106.0), (39.5, None)]
    segs = spark.createDataFrame(lines, "name string, x1 double, y1 double, x2 double, y2 double")
    table = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "k int, latitude double, longitude double")
    got = {r.k: r for r in geo.lift_line_distances(table, segs).collect()}
    assert len(got) == len(points)
    flat = [(words.get(n), *g.utm_forward(b, a, g.PY_MATH), *g.utm_forward(d, c, g.PY_MATH)) for n, a, b, c, d in lines]
    for i, (lat, lon) in enumerate(points):
        for resort in codes.RESORT_POINTS:
            own = [q[1:] for q in flat if q[0] == resort]
            if lat is None or lon is None:
                want = None
            elif own:
                x, y = g.utm_forward(lat, lon, g.PY_MATH)
                want = min(_segment_metres(x, y, *q) for q in own) * codes.METRES_TO_MILES
            else:
                want = min(g.haversine_miles(lat, lon, *p, g.PY_MATH) for p in codes.RESORT_POINTS[resort])
            assert (got[i][resort] is None) == (want is None)
            assert want is None or math.isclose(got[i][resort], want, rel_tol=1e-9, abs_tol=1e-9)
    no_lines = geo.lift_line_distances(table, segs.where("false")).where("k = 0").first()
    assert no_lines.dist_breck == geo.resort_point_distances(table).where("k = 0").first().dist_breck


def test_macro_series_join_once(spark):
    """Several series by one as-of join: each keeps its own dates, nulls on a date count, missing series are skipped."""
    from terrane.plans import features

    sales = spark.createDataFrame([(1, "2000-01-15"), (2, "2000-03-01"), (3, None), (4, "1999-01-01")], "k int, tx_date string").withColumn("tx_date", F.col("tx_date").cast("date"))
    rate = spark.createDataFrame([("2000-01-01", 1.0), ("2000-02-01", None)], "date string, value double")
    pop = spark.createDataFrame([("1998-01-01", 5.0), ("1998-01-01", 7.0)], "date string, value double")
    wide = features.combined_series({"rate": rate, "pop": pop, "none": None})
    got = {r.k: (r.rate, r.pop) for r in features.asof_macro(sales, wide).collect()}
    assert got == {1: (1.0, 7.0), 2: (None, 7.0), 3: (None, None), 4: (None, 7.0)}
    assert features.combined_series({"none": None}) is None


def test_pearson_p_value_known_values(spark):
    # two-sided Student t: closed forms for 1 and 2 degrees of freedom, tabulated values else
    rows = [(0.5, 10, 0.14111), (-0.9, 5, 0.03739), (0.5, 3, 1 - 2 / math.pi * math.asin(0.5)), (0.3, 4, 0.7), (1.0, 9, 0.0), (0.0, 12, 1.0)]
    df = spark.createDataFrame(rows, "r double, n int, want double")
    for r in df.select("want", pearson_p_value(F.col("r"), F.col("n")).alias("p")).collect():
        assert abs(r.p - r.want) < 1e-4
    bad = spark.createDataFrame([(0.5, 2), (None, 9), (float("nan"), 9)], "r double, n int")
    assert all(math.isnan(r.p) for r in bad.select(pearson_p_value(F.col("r"), F.col("n")).alias("p")).collect())


def test_numbers_as_text(spark):
    from terrane.functions.clean import clean_id, clean_numeric

    cases = {"12": 12.0, " 12.50 ": 12.5, "1_000": 1000.0, "-.5e1": -5.0, "3.": 3.0, "inf": float("inf"), "12d": None, "12f": None,
             "0x1p3": None, "1__0": None, "_1": None, "": None, "n/a": None, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.v for r in df.select("t", clean_numeric("t").alias("v")).collect()} == cases
    ids = spark.createDataFrame([("12.0",), ("12d",), ("R13",), ("12.5",)], "t string")
    assert [r.v for r in ids.select(clean_id("t").alias("v")).collect()] == ["12", "12d", "R13", "12.5"]


def test_exact_quantiles_with_a_dominant_value(spark):
    rows = [("g", 100.0)] * 9000 + [("g", float(v)) for v in range(18000)] + [("h", 7.0)] * 5
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: (r.med, r.p9) for r in exact_quantiles(df, ["k"], "v", {"med": 0.5, "p9": 0.9}).collect()}
    vals = np.array([v for k, v in rows if k == "g"])
    assert math.isclose(got["g"][0], np.quantile(vals, 0.5)) and math.isclose(got["g"][1], np.quantile(vals, 0.9))
    assert got["h"] == (7.0, 7.0)


def test_global_rank_after_shuffle_with_wide_rows(spark):
    # input from a shuffle (non-deterministic arrival order) with extra columns,
    # so the counting branch and the numbering branch prune differently
    base = spark.range(0, 6000).withColumn("k", F.col("id") % 97)
    agg = base.groupBy("k", (F.col("id") % 61).alias("j")).agg(F.count("*").alias("n"), F.max("id").alias("m"))
    wide = agg.withColumn("pad", F.concat(F.lit("x"), F.col("m").cast("string")))
    rows = global_rank(wide, ["k", "j"], "rank", partitions=5).collect()
    ranks = sorted(r["rank"] for r in rows)
    assert ranks == list(range(len(rows)))
    by_rank = [(r["k"], r["j"]) for r in sorted(rows, key=lambda r: r["rank"])]
    assert by_rank == sorted(by_rank)


def test_fill_keeps_types_over_many_partitions(spark):
    rng = random.Random(8)
    rows = [(k, rng.choice([None, None, None, k * 2**40]), rng.choice([None, f"s{k}"]) if k > 50 else None, None, dt.date(2000, 1, 1) if k == 70 else None) for k in range(100)]
    shuffled = rng.sample(rows, len(rows))
    df = spark.createDataFrame(shuffled, "k int, a long, b string, c double, d date")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        filled = asof.global_fill(df, ["k"], ["a", "b", "c", "d"])
        got = sorted(tuple(r) for r in filled.select("k", "a", "b", "c", "d").collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert filled.schema == df.schema
    want, last = [], [next((r[j] for r in rows if r[j] is not None), None) for j in range(5)]
    for r in rows:
        last = [r[j] if r[j] is not None else last[j] for j in range(5)]
        want.append(tuple(last))
    assert [g[:4] for g in got] == [w[:4] for w in want] and {g[4] for g in got} == {dt.date(2000, 1, 1)}


def test_chronological_split_selects_by_rank(spark):
    from terrane.plans import features

    rng = random.Random(3)
    rows = [(rng.choice([None, dt.date(2000, 1, 1), dt.date(2000, 1, 2), dt.date(2001, 5, 5)]), f"p{k}", rng.choice([None, 1.5, 2.5])) for k in range(60)]
    df = spark.createDataFrame(rows, "d date, s string, p double")
    key = lambda r: tuple((x is not None, x) if x is not None else (False, 0) for x in r)
    ordered = sorted(rows, key=key)
    for share in (0.0, 0.1, 0.5, 0.8, 1.0):
        got = {(r.d, r.s, r.p): r.role for r in features.chronological_split(df, ["d", "s", "p"], share).collect()}
        cut = int(len(rows) * share)
        assert got == {r: "train" if i < cut else "test" for i, r in enumerate(ordered)}, share
    assert features.chronological_split(df.where("false"), ["d", "s", "p"]).count() == 0


def test_similar_properties_equal_brute_force(spark):
    """Crowded and sparse towns, a town too small, missing values, ties, and subjects that are candidates themselves."""
    from terrane.plans import whatif

    rng = random.Random(4)
    records = [(str(k), rng.choice(["B", "B", "B", "F", "TINY" if k < 3 else "F", None]), rng.choice([500.0, 800.0, 801.0, 5000.0, 60000.0, None]),
                rng.choice([1950, 1990, 1991, None]), rng.choice([None, 0.0, 2.0, 3.0]), rng.choice([0.0, 1.5]), rng.choice(["1230", "1112", "100", None]),
                rng.choice(["FRISCO", "DENVER"]), rng.choice([0.0, 20.0, 90000.0])) for k in range(150)]
    df = spark.createDataFrame(records, "schno string, town string, sfla double, year_blt int, beds double, bath_tot double, abst1 string, city string, docfee1 double")
    subjects = whatif.parcel_profiles(df).withColumnRenamed("schno", "subject_id")
    subj = [r.asDict() for r in subjects.collect()]
    price = {r[0]: r[8] * 10000 if r[8] < 10000 else r[8] for r in records}
    cand = [s for s in subj if price[s["subject_id"]] > 10000]
    for leave in (False, True):
        got = sorted((r.subject_id, r["rank"], r.schno, r.distance, r.similarity) for r in whatif.similar_properties(df, subjects, leave_out_self=leave).collect())
        want = []
        for s in subj:
            own = [c for c in cand if c["town"] == s["town"] and s["town"] is not None]
            own = own if len(own) >= 5 else cand
            rows = []
            for c in own:
                if leave and c["subject_id"] == s["subject_id"]:
                    continue
                parts = [(c[n], s[n], u) for n, u in (("sfla", 500.0), ("yb", 10.0), ("bd", 1.0), ("ba", 1.0), ("dl", 1.0))]
                dist = None if any(a is None or b is None for a, b, _ in parts) else (50.0 if c["rtype"] != s["rtype"] else 0.0) + sum(abs(a - b) / u for a, b, u in parts)
                rows.append((-max(0.0, 100.0 - dist * 10) if dist is not None else 0.0, int(c["subject_id"]), dist))
            want += [(s["subject_id"], k, str(i), dist, -sim) for k, (sim, i, dist) in enumerate(sorted(rows, key=lambda x: x[:2])[:3], 1)]
        assert [g[:3] for g in got] == [w[:3] for w in sorted(want, key=lambda w: w[:2])]
        for g, w in zip(got, sorted(want, key=lambda w: w[:2]), strict=True):
            assert (g[3] is None) == (w[3] is None) and abs(g[4] - w[4]) < 1e-9


def test_comparable_sales_of_a_table_of_subjects(spark):
    """The band join against one subject at a time."""
    from terrane.plans import market
    from terrane.sources import fixtures as fx

    p = fx.parcels(spark, "/root/testdata/sf0.001")
    asked = [("a", "BRECKENRIDGE", "Condo", 2000.0), ("b", "FRISCO", "Single Family", 1500.0), ("c", "NOWHERE", "Any", 2500.0), ("d", "KEYSTONE", None, 3.0),
             ("e", None, "Townhouse", 400.0), ("f", "DILLON", "Condo", None), ("g", "NOWHERE", "Any", 0.0)]
    subjects = spark.createDataFrame(asked, "subject_id string, city string, prop_type string, sfla double")
    got = {}
    for r in market.comparable_sales_many(p, subjects, "2001-08-01", k=4).orderBy("subject_id", "rank").collect():
        got.setdefault(r.subject_id, []).append((r.tx_date, r.price, r.sfla, r.address))
    for i, city, kind, size in asked:
        one = [] if size is None else market.comparable_sales(p, city, kind, size, "2001-08-01", k=4).collect()
        assert got.get(i, []) == [(r.tx_date, r.price, r.sfla, r.address) for r in one], i


def test_dates_by_shape_equal_trying_every_layout(spark):
    from terrane.functions import clean

    rng = random.Random(6)
    texts = ["8/10/2012", "08/10/2012", "13/10/2012", "31/12/99", "8/10/12", "8/10/2012 9:13:25 AM", "8/10/2012 09:13:25 pm", "8/10/2012 21:13:25", "8/10/2012 21:13",
             "2012-08-10", "2012-8-10", "2012-08-10 01:02:03", "2012-08-10T01:02:03", "2012/8/1", "20120810", "2012", "Aug 10 2012", "aug 10, 2012", "August 10 2012",
             "AUGUST 10, 2012", "10 Aug 2012", "8-10-2012", "1600-01-01", "2300-01-01", "2/30/2012", "", "  8/10/2012 ", "NOT A DATE", "8/10/20123", "99/99/9999", None, "+2012", "May 1 2012"]
    texts += ["".join(rng.choice("0123456789/- :AMPJun") for _ in range(rng.randint(1, 12))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.trim("t")
    tried = F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in clean.DATE_FORMATS]).cast("date")
    tried = F.when((t != "") & tried.between(F.lit(clean.MIN_DATE).cast("date"), F.lit(clean.MAX_DATE).cast("date")), tried)
    bad = df.select("t", clean.standardize_date("t").alias("got"), tried.alias("want")).where("NOT got <=> want").collect()
    assert not bad, bad[:5]
