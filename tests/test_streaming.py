from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.operators.rollup import last_record, nested_usage, time_bins, trailing_window
from tidemark.queries import streams
from tidemark.sources.state import merge_endpoints
from tidemark.streaming.detection import run_partial_bins, write_batch
from tidemark.streaming.endpoints import changed_endpoints, state_store
from tidemark.streaming.native import deduplicated, stream_files, windowed_bins

I, W = timedelta(minutes=15), timedelta(hours=1)
SCHEMA = (
    "timestamp timestamp, mac string, appName string, side string, uuid string, logicalClass string, "
    "clientBytesSent long, serverBytesSent long"
)


def at(minute):
    return datetime(2024, 1, 1) + timedelta(minutes=minute)


def flows(spark, minutes):
    rows = [(at(m), f"m{m % 2}", "web", "client", "u", "cam", m, 1) for m in minutes]
    return spark.createDataFrame(rows, SCHEMA).coalesce(1)


FILES = [[1, 5, 16], [7, 20, 33], [40, 52, 61, 2], [75, 80, 91]]


def start(spark, tmp_path):
    def on_window(windowed, batch_id):
        write_batch(nested_usage(windowed), str(tmp_path / "usage"), batch_id)

    query = run_partial_bins(
        stream_files(spark, str(tmp_path / "in"), SCHEMA, max_files=1),
        lambda batch: time_bins(batch, I),
        str(tmp_path / "bins"), str(tmp_path / "checkpoint"),
        interval=I, window=W, on_window=on_window,
    )
    query.awaitTermination()


def test_stream_equals_batch(spark, tmp_path, rows):
    for n, minutes in enumerate(FILES):
        flows(spark, minutes).write.mode("append").parquet(str(tmp_path / "in"))
        start(spark, tmp_path)
        seen = flows(spark, [m for part in FILES[: n + 1] for m in part])
        whole = time_bins(seen, I)
        # The window of a batch ends with the latest flow of that batch.
        last = last_record(time_bins(flows(spark, minutes), I))
        want = nested_usage(trailing_window(whole, I, W, last))
        got = spark.read.parquet(str(tmp_path / "usage")).where(F.col("batchId") == n).drop("batchId")
        assert rows(got.select(*want.columns)) == rows(want)
    assert spark.read.parquet(str(tmp_path / "bins")).agg(F.sum("numFlowsInterval")).first()[0] == 13


def test_a_repeated_batch_replaces_its_rows(spark, tmp_path):
    flows(spark, FILES[0]).write.mode("append").parquet(str(tmp_path / "in"))
    start(spark, tmp_path)
    # Without the commit of its last batch, the stream runs that batch again.
    for path in (tmp_path / "checkpoint" / "commits").glob("*0"):
        path.unlink()
    for path in (tmp_path / "checkpoint" / "commits").glob(".0*"):
        path.unlink()
    start(spark, tmp_path)
    assert spark.read.parquet(str(tmp_path / "bins")).agg(F.sum("numFlowsInterval")).first()[0] == 3


def test_native_bins_drop_repeats_and_wait_for_the_watermark(spark, tmp_path, rows):
    data = [(1, at(1)), (1, at(1)), (2, at(14)), (3, at(20)), (4, at(47))]
    spark.createDataFrame(data, "id long, timestamp timestamp").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = stream_files(spark, str(tmp_path / "in"), "id long, timestamp timestamp")
    unique = deduplicated(stream, ["id"], "timestamp", timedelta(minutes=10))
    bins = windowed_bins(unique, [], [F.count("*").alias("n")], interval=I)
    query = (
        bins.writeStream.format("memory").queryName("native_bins").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    # The watermark is 00:37, so the bin of 00:30 is still open.
    assert rows(spark.table("native_bins")) == [(at(0), at(15), 2), (at(15), at(30), 1)]


def test_sliding_windows(spark, tmp_path, rows):
    data = [(1, at(7)), (2, at(60))]
    spark.createDataFrame(data, "id long, timestamp timestamp").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = stream_files(spark, str(tmp_path / "in"), "id long, timestamp timestamp")
    windows = windowed_bins(
        stream, [], [F.count("*").alias("n")], interval=I, slide=timedelta(minutes=5), delay=timedelta(0)
    )
    query = (
        windows.writeStream.format("memory").queryName("sliding").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert [r["timeBin"] for r in sorted(spark.table("sliding").collect())] == [at(-5), at(0), at(5)]


RECORDS = "macAddress string, timestamp timestamp, n long, s string"
ARRIVALS = [
    [("a", 1, 1, "x"), ("b", 5, -2, None), ("a", 1, 10, "w"), ("d", 2, None, None)],
    [("a", 0, 7, "q"), ("b", 5, -2, "z"), (None, 3, 1, ""), ("d", None, 3, "t"), ("a", 1, 10, "w")],
    [("a", 30, 0, "y"), ("a", 20, 9, "z"), ("c", 31, 1, "c")],
    [("d", 3, 1, "late"), ("c", 31, 1, "c"), ("b", 5, 4, "")],
]


def records(spark, rows):
    return spark.createDataFrame([(k, None if m is None else at(m), n, s) for k, m, n, s in rows], RECORDS).coalesce(1)


def run_endpoints(spark, tmp_path, keep):
    stream = stream_files(spark, str(tmp_path / "records"), RECORDS, max_files=1)
    with state_store(spark):
        query = (
            changed_endpoints(stream, keep=keep).writeStream.outputMode("update")
            .foreachBatch(lambda df, n: write_batch(df, str(tmp_path / "changes"), n))
            .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        )
        query.awaitTermination()


def test_endpoints_in_state_equal_the_merge(spark, tmp_path, rows):
    """After every batch, the changes so far are the merge of all records so far: late and repeated ones too."""
    known, seen = spark.createDataFrame([], RECORDS), {}
    for batch in ARRIVALS:
        records(spark, batch).write.mode("append").parquet(str(tmp_path / "records"))
        run_endpoints(spark, tmp_path, timedelta(days=1))
        arrived = records(spark, [r for r in batch if r[0] is not None and r[1] is not None])
        known = spark.createDataFrame(merge_endpoints(arrived, known).collect(), RECORDS)
        changes = spark.read.parquet(str(tmp_path / "changes")).orderBy("batchId").collect()
        newest = {r["macAddress"]: tuple(r)[:4] for r in changes}
        assert sorted(newest.values(), key=repr) == rows(known)
        seen[len(seen)] = [r["change"] for r in changes]
    assert seen[0] == ["new"] * 3 and sorted(seen[3]) == ["new"] * 4 + ["updated"] * 4


def test_old_endpoints_are_retired(spark, tmp_path):
    for n, batch in enumerate([[("a", 1, 1, "x"), ("b", 50, 1, "y")], [("b", 130, 2, "y")], [("b", 131, 3, "y"), ("a", 2, 5, "late")]]):
        records(spark, batch).write.mode("append").parquet(str(tmp_path / "records"))
        run_endpoints(spark, tmp_path, timedelta(minutes=60))
    changes = spark.read.parquet(str(tmp_path / "changes")).orderBy("batchId", "n").collect()
    assert [(r["macAddress"], r["n"], r["change"]) for r in changes if r["macAddress"] == "a"] == [("a", 1, "new"), ("a", 1, "retired")]
    assert [r["change"] for r in changes if r["macAddress"] == "b"] == ["new", "updated", "updated"]


def test_state_is_kept_by_bucket_not_by_device(spark, tmp_path):
    """A device costs no calls to the state store of its own; each is updated and retired on its own."""
    first = [(f"d{n}", n % 3, n, "x") for n in range(300)]
    for batch in [first, [("d0", 1, 1, "y"), ("d9", 121, 1, "z")], [("d9", 122, 1, "z")]]:
        records(spark, batch).write.mode("append").parquet(str(tmp_path / "records"))
    stream = stream_files(spark, str(tmp_path / "records"), RECORDS, max_files=1)
    with state_store(spark):
        query = (
            changed_endpoints(stream, keep=timedelta(hours=1), buckets=4).writeStream.outputMode("update")
            .foreachBatch(lambda df, n: write_batch(df, str(tmp_path / "changes"), n))
            .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) <= 4
    changes = [tuple(r) for r in spark.read.parquet(str(tmp_path / "changes")).select("macAddress", "n", "change").collect()]
    assert sorted(c for c in changes if c[2] == "new") == sorted((f"d{n}", n, "new") for n in range(300))
    assert sorted(c for c in changes if c[2] == "updated") == [("d0", 1, "updated"), ("d9", 1, "updated"), ("d9", 1, "updated")]
    # The watermark is 01:02, which passes minutes 0 and 1 by an hour, but not 2.
    gone = [(f"d{n}", n or 1, "retired") for n in range(300) if n % 3 < 2 and n != 9]
    assert sorted(c for c in changes if c[2] == "retired") == sorted(gone)


def test_batches_of_several_files_end_where_arrivals_do(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "_FILE_ROWS", 10)
    sizes = [45, 60, 52, 80]
    rows = [(100 * n + k, n) for n, size in enumerate(sizes) for k in range(size)]
    arrivals = spark.createDataFrame(rows, "id long, arrival long")
    stream = streams._arriving(spark, arrivals, str(tmp_path / "in"), "id long")
    query = (
        stream.writeStream.foreachBatch(lambda df, n: write_batch(df, str(tmp_path / "out"), n))
        .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("id", "batchId").collect()
    assert sorted((r["id"], r["batchId"]) for r in got) == sorted(rows)
    assert len(list((tmp_path / "in").glob("*.parquet"))) == 16
