"""File sources, sinks, streaming replay and the run log."""

import csv
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMOKE


def test_geojson_lines_and_segments(spark):
    from terrane.operators import geo
    from terrane.sources import files as fl
    from terrane.sources import fixtures as fx

    root = fl.scratch_path(spark, "lifts")
    local = root[len("file:"):] if root.startswith("file:") else root   # a local session's folder
    path = os.path.join(local, "ski_lifts.geojson")
    fl.write_geojson_lines(path, fx.lift_lines())
    lines = fl.read_lift_lines(spark, path)
    assert lines.count() == len(fx.lift_lines())
    segs = fl.lift_segments(lines)
    assert segs.count() == len(fx.lift_lines())           # two points per line -> one segment
    pts = spark.createDataFrame([(39.4805, -106.0666), (39.60, -105.94)], "latitude double, longitude double")
    d = geo.lift_line_distances(pts, segs).orderBy("longitude").collect()
    assert all(r.dist_breck is not None and r.dist_breck >= 0 for r in d)
    assert d[0].dist_breck < 0.5                           # at the Breckenridge point, a lift is close


def test_json_and_csv_sinks_round_trip(spark):
    from terrane.sources import files as fl
    from terrane.sources import sinks

    df = spark.createDataFrame([(1, float("nan")), (2, float("inf")), (3, 1.5)], "k int, v double")
    root = fl.scratch_path(spark, "sinks")
    sinks.write_json(df, f"{root}/a", f"{root}/b")
    back = {r.k: r.v for r in spark.read.json(f"{root}/b").collect()}
    assert back == {1: None, 2: None, 3: 1.5}
    sinks.write_csv(df.where("k = 3"), f"{root}/c")
    assert spark.read.option("header", "true").csv(f"{root}/c").first()["v"] == "1.5"


def test_text_csv_keeps_every_value_as_text(spark):
    from terrane.operators import ingest as ing
    from terrane.sources import files as fl

    root = fl.scratch_path(spark, "text")
    df = spark.createDataFrame([("1", "  25.50  ", "n/a"), ("2", "007", "")], "schno string, docfee1 string, beds string")
    df.write.options(**fl.CSV_TEXT_OPTIONS).csv(root)
    back = {r.schno: r for r in ing.null_na_tokens(fl.read_text_csv(spark, root, df.columns)).collect()}
    assert back["1"].docfee1 == "  25.50  " and back["1"].beds is None and back["2"].docfee1 == "007"


@pytest.fixture
def small_splits(spark):
    """A function that sets the size of file splits; restored afterwards."""
    names = {"spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum"}
    old = {n: spark.conf.get(n, None) for n in names}

    def splits_of(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
        spark.conf.set("spark.sql.files.minPartitionNum", 1)

    yield splits_of
    for n, v in old.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def _local_folder(spark, name):
    from terrane.sources import files as fl

    root = fl.scratch_path(spark, name)
    root = root[len("file:"):] if root.startswith("file:") else root
    os.makedirs(root)
    return root


@pytest.mark.parametrize("size", [64, 300, 4000, 1 << 20])
def test_csv_records_with_line_breaks_split_anywhere(spark, small_splits, size):
    from terrane.sources import files as fl

    rng = random.Random(size)
    values = [lambda i: f"plain{i}", lambda i: f'a "q" b\nline two, {i}\n\n', lambda i: '"', lambda i: ',,"\n"',
              lambda i: "x\n" * rng.randint(1, 80), lambda i: f"z{i % 7}", lambda i: ' "not a quoted field" ']
    rows = [tuple(rng.choice(values)(i) for _ in range(3)) for i in range(150)]
    root = _local_folder(spark, "csv-splits")
    for name, end, part in (("a.csv", "\n", rows), ("b.csv", "\r\n", rows[:40])):
        with open(f"{root}/{name}", "w", newline="") as fh:
            writer = csv.writer(fh, lineterminator=end)
            writer.writerow(["c1", "c2\nsecond line", "c3"])
            writer.writerows(part)
    small_splits(size)
    got = fl.read_text_csv(spark, root, position="pos")
    assert got.columns == ["pos", "c1", "c2\nsecond line", "c3"]
    assert [tuple(r)[1:] for r in got.orderBy("pos").collect()] == rows + rows[:40]
    if size < 1000:
        assert got.rdd.getNumPartitions() > 10


def test_csv_stray_quotes_unclosed_quotes_and_blank_lines(spark, small_splits):
    from terrane.sources import files as fl

    root = _local_folder(spark, "csv-quotes")
    with open(f"{root}/a.csv", "w") as fh:
        fh.write('a,b\n5" pipe,1\n\n   \n"x ""y""",2\nshort\n"never closed,3\nlast,4\n')
    small_splits(16)
    got = [tuple(r)[1:] for r in fl.read_text_csv(spark, root, position="pos").orderBy("pos").collect()]
    assert got[:3] == [('5" pipe', "1"), ('x "y"', "2"), ("short", None)]
    assert len(got) == 4 and got[3][0].startswith("never closed,3\nlast,4")
    empty = _local_folder(spark, "csv-empty")
    open(f"{empty}/a.csv", "w").close()
    assert fl.read_text_csv(spark, empty, ["a", "b"]).count() == 0


def test_line_states_follow_a_plain_scan():
    from terrane.sources import csv_records as cr

    rng = np.random.default_rng(0)
    for _ in range(200):
        actions = rng.integers(0, 4, rng.integers(1, 30))
        for before in (0, 1):
            state, want = before, []
            for a in actions:
                state = {cr.KEEP: state, cr.FLIP: 1 - state, cr.TO_OUTSIDE: 0, cr.TO_INSIDE: 1}[int(a)]
                want.append(state)
            assert cr.states_after(actions, before).tolist() == want


def test_stream_ingest_replay_is_idempotent(spark):
    from terrane.plans import registry as R
    from terrane.streaming import ingest as st

    root = R._r2_root(spark, SMOKE)
    before = st.current_table(spark, root).count()
    log_rows = spark.read.parquet(os.path.join(root, "log")).count()
    # replay batch 0 as a retried micro-batch would: same batch id, same rows
    batch0 = spark.read.parquet(os.path.join(root, "landing"))
    st._write_batch(batch0, 0, root, R.INGEST_AS_OF_YEAR, "pos")
    assert spark.read.parquet(os.path.join(root, "log")).count() == log_rows
    assert st.current_table(spark, root).count() == before


def test_page_stream_drops_relanded_pages(spark):
    from terrane.plans import registry as R

    assert R.REGISTRY["R1"](spark, SMOKE).count() == R.REGISTRY["S16"](spark, SMOKE).count()


def test_page_stream_loses_and_repeats_no_page(spark):
    from terrane.sources import files as fl
    from terrane.streaming import ingest as st

    root = fl.scratch_path(spark, "late-pages")
    page = "<html><body>No record found for Account</body></html>"
    schema = "id string, html string, landed_at timestamp"

    def land(*ids, at):
        rows = spark.createDataFrame([(i, page) for i in ids], "id string, html string")
        rows.withColumn("landed_at", F.lit(at).cast("timestamp")).write.parquet(f"{root}/landing", mode="append")
        st.stream_page_rows(spark, f"{root}/landing", schema, f"{root}/_checkpoint", f"{root}/out")

    land("a", "b", "a", at="2024-01-02 00:00:00")
    land("c", "b", at="2024-01-01 00:00:00")  # a page that lands a day late, and one landed again
    land("a", "d", at="2024-01-09 00:00:00")
    got = st.page_rows(spark, f"{root}/out")
    assert sorted(r[0] for r in got.select(got.columns[0]).collect()) == ["a", "b", "c", "d"]


def test_page_stream_costs_its_own_pages(spark):
    """Ids that have been taken are state of the stream; no table of them is read."""
    import inspect

    from terrane.streaming import ingest as st

    assert "dropDuplicates" in inspect.getsource(st.stream_page_rows) and "RocksDB" in str(st.STATE_STORE)


def _land_batches(spark, root, n, start=0):
    for k in range(start, start + n):
        rows = [(str(i), str(100 * k + i), k * 10 + i) for i in range(k, k + 4)] + [(None, "1", 999)]
        spark.createDataFrame(rows, "schno string, docfee1 string, pos long").coalesce(1).write.parquet(f"{root}/landing", mode="append")


def _current(spark, root):
    from terrane.streaming import ingest as st

    return {r.schno: r.docfee1 for r in st.current_table(spark, root).collect()}


def test_log_is_compacted_and_reads_stay_the_same(spark):
    from terrane.sources import files as fl
    from terrane.streaming import ingest as st

    root = fl.scratch_path(spark, "compact")
    schema = "schno string, docfee1 string, pos long"
    for k in range(7):
        _land_batches(spark, root, 1, k)
        st.stream_validated_ingest(spark, f"{root}/landing", schema, root, 2025, every=3)
        want = {}
        for b in range(k + 1):
            want |= {str(i): float(100 * b + i) for i in range(b, b + 4)}
        assert _current(spark, root) == want
        assert len(st._folders(spark, f"{root}/log", "batch_id=")) <= 6  # behind the base before the last
    assert st._bases(spark, root) and max(st._bases(spark, root)) == 5
    assert st.dead_letters(spark, root).count() == 7


@pytest.mark.parametrize("step", ["half", "delete", "replay"])
def test_a_crash_between_the_steps_of_compaction_loses_nothing(spark, monkeypatch, step):
    from terrane.sources import files as fl
    from terrane.streaming import ingest as st

    root = fl.scratch_path(spark, f"crash-{step}")
    schema = "schno string, docfee1 string, pos long"
    for k in range(5):
        _land_batches(spark, root, 1, k)
        st.stream_validated_ingest(spark, f"{root}/landing", schema, root, 2025, every=2)
    before = _current(spark, root)
    assert st._bases(spark, root) == [1, 3]
    if step == "half":  # the next base is half written: files, no _SUCCESS
        spark.createDataFrame([("junk", 1.0)], "schno string, docfee1 double").write.parquet(st._base(root, 5))
        st._delete(spark, f"{st._base(root, 5)}/_SUCCESS")
        assert _current(spark, root) == before
    elif step == "delete":
        def broken(*_):
            raise OSError("lost")
        monkeypatch.setattr(st, "_delete", broken)
        _land_batches(spark, root, 1, 5)
        with pytest.raises(Exception, match="lost"):
            st.stream_validated_ingest(spark, f"{root}/landing", schema, root, 2025, every=2)
        monkeypatch.undo()
    else:  # the last batch runs again after its base was made
        rows = spark.read.parquet(f"{root}/landing").where("pos DIV 10 = 4 OR pos = 999")
        st._write_batch(rows.where("pos < 50"), 4, root, 2025, "pos")
        st.compact(spark, root, 4, every=1)
        st._write_batch(rows.where("pos < 50"), 4, root, 2025, "pos")
        assert not st.compact(spark, root, 4, every=1)
        assert _current(spark, root) == before
    if step != "replay":
        if step == "half":
            _land_batches(spark, root, 1, 5)
        st.stream_validated_ingest(spark, f"{root}/landing", schema, root, 2025, every=2)
        assert _current(spark, root) == before | {str(i): float(500 + i) for i in range(5, 9)}


def test_append_run_numbers_after_max(spark):
    from terrane.plans import evaluate

    runs = spark.createDataFrame([(1, "gbm", 5.0), (4, "nn", 3.0)], "run_id int, model_name string, mae double")
    new = spark.createDataFrame([(2, "gbm", 4.0), (1, "nn", 2.0)], "seq long, model_name string, mae double")
    out = {(r.model_name, r.mae): r.run_id for r in evaluate.append_run(runs, new).collect()}
    assert out[("nn", 2.0)] == 5 and out[("gbm", 4.0)] == 6 and out[("gbm", 5.0)] == 1


def test_ingest_job_writes_table_dead_letters_and_counters(spark):
    from terrane import jobs
    from terrane.plans import registry as R
    from terrane.sources import files as fl
    from terrane.sources import fixtures as fx

    root = fl.scratch_path(spark, "ingest-job")
    raw = fx.raw_text(fx.parcels(spark, SMOKE))
    raw.write.options(**fl.CSV_TEXT_OPTIONS).csv(f"{root}/in")
    counters = jobs.ingest_job(spark, f"{root}/in", f"{root}/table", f"{root}/dlq", R.INGEST_AS_OF_YEAR, raw.columns)
    table = spark.read.parquet(f"{root}/table")
    dlq = spark.read.option("header", "true").option("multiLine", "true").csv(f"{root}/dlq")
    assert counters["processed"] == raw.count()
    assert counters["inserted"] + counters["rejected"] == counters["processed"]
    assert table.count() == R.REGISTRY["S2"](spark, SMOKE).count()
    assert dlq.count() == counters["rejected"] == R.REGISTRY["S6"](spark, SMOKE).count()


def test_export_job_writes_every_output(spark):
    from terrane import jobs
    from terrane.sources import files as fl
    from terrane.sources import fixtures as fx

    root = fl.scratch_path(spark, "export-job")
    written = jobs.export_job(spark, fx.parcels(spark, SMOKE), root, macro=fx.macro(spark, SMOKE))
    assert len(written) == 6
    trends = spark.read.json(f"{root}/market_trends")
    assert trends.count() > 0 and "avg_price_3yr_ma" in trends.columns
