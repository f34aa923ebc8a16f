import time
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.session import cut_lineage, shared_dir, stored
from tidemark.sources.listing import exists, list_keys, list_objects
from tidemark.sources.raw import discover, minute_prefixes, new_watermark, read_raw
from tidemark.sources.state import (
    append_metrics,
    archive,
    archive_all,
    latest_partition,
    merge_endpoints,
    read_state,
    read_watermark,
    write_state,
    write_watermark,
)

T1, T2 = datetime(2024, 1, 1, 10, 0), datetime(2024, 1, 1, 10, 15)


def put(root, *keys):
    for key in keys:
        path = root / key
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("dummy")


def names(df, col="key"):
    return sorted(r[col] for r in df.collect())


KEYS = ["prefix/02/file.ppt", "prefix/03/file.ppt", "prefix/03/file.xml.gz"]


def test_listing(spark, tmp_path):
    root = str(tmp_path)
    put(tmp_path, *KEYS)
    assert names(list_keys(spark, root, "prefix")) == KEYS
    assert names(list_keys(spark, root, ["prefix/03", "prefix/02"])) == KEYS
    assert names(list_keys(spark, root, "prefix/0")) == KEYS
    assert names(list_keys(spark, root, "prefix/03")) == KEYS[1:]
    assert names(list_keys(spark, f"file:{root}/", "/prefix/02")) == KEYS[:1]
    urls = names(list_keys(spark, root, "prefix", full_urls=True))
    assert len(urls) == 3 and all(u.startswith("file:") and u.endswith(k) for u, k in zip(urls, KEYS))
    assert names(list_keys(spark, root, "prefix", glob="*.gz")) == KEYS[2:]
    assert list_keys(spark, root, "xxx").count() == 0
    objects = list_objects(spark, root, "prefix")
    assert objects.columns == ["path", "modificationTime", "length"]
    assert [r["length"] for r in objects.collect()] == [5] * 3
    assert list_objects(spark, root, where=F.lit(False)).count() == 0


def test_exists(spark, tmp_path):
    put(tmp_path, *[f"hello/world/I/have/3/objects/obj{n}" for n in (1, 2, 3)])
    assert exists(spark, str(tmp_path), "hello/world/I/have/3/objects")
    assert exists(spark, str(tmp_path), "hello/wor")
    assert not exists(spark, str(tmp_path), "no/data/here")


def test_discovery(spark, tmp_path):
    def key(stamp, entity, name="part.json"):
        return f"c1/data/{stamp}/{entity}/{name}"

    put(
        tmp_path,
        key("2024-01-01T10-00-05.000Z", "netflowpacket"),
        key("2024-01-01T10-01-05.250Z", "netflowpacket"),
        key("2024-01-01T10-02-05.000Z", "endpointclassification"),
        key("2024-01-01T10-02-05.000Z", "other"),
        key("2024-01-01T10-02-05.000Z", "netflowpacket", "part.txt"),
        key("2024-01-01T10-09-05.000Z", "netflowpacket"),
    )
    window = (T1, T1 + timedelta(minutes=5))
    assert minute_prefixes("c1", *window)[1] == "c1/data/2024-01-01T10-01" and len(minute_prefixes("c1", *window)) == 5
    files = discover(spark, str(tmp_path), "c1", *window, T1 + timedelta(seconds=5), "json")
    assert sorted((r["entity"], r["ts"]) for r in files.collect()) == [
        ("endpointclassification", datetime(2024, 1, 1, 10, 2, 5)),
        ("netflowpacket", datetime(2024, 1, 1, 10, 1, 5, 250_000)),
    ]
    assert new_watermark(files, T1).first()["timestamp"] == datetime(2024, 1, 1, 10, 2, 5)
    assert new_watermark(files.limit(0), T1).first()["timestamp"] == T1


def test_raw_read_prunes_by_watermark(spark, tmp_path, rows):
    for minute, n in ((0, 1), (1, 2), (7, 3)):
        spark.createDataFrame([(n,)], "n long").write.json(
            str(tmp_path / f"c1/data/2024-01-01T10-0{minute}-30.000Z/netflowpacket")
        )
    args = (spark, str(tmp_path), "c1", "netflowpacket", "n long", T1, T1 + timedelta(minutes=5))
    assert rows(read_raw(*args, T1, fmt="json")) == [(1,), (2,)]
    late = read_raw(*args, T1 + timedelta(seconds=30), fmt="json")
    assert rows(late) == [(2,)]
    nothing = read_raw(*args[:3], "endpointclassification", *args[4:], T1, fmt="json")
    assert nothing.count() == 0 and nothing.columns == ["n"]


def test_state_tables(spark, tmp_path, rows):
    root = str(tmp_path / "state")
    table = lambda n: spark.range(n)
    assert read_state(spark, root, "bins", "c1", "id long").count() == 0
    write_state(table(2), root, "bins", "c1", T1)
    write_state(table(3), root, "bins", "c1", T2)
    write_state(table(9), root, "bins", "c2", T2)
    write_state(table(4), root, "bins", "c1", T1)
    assert read_state(spark, root, "bins", "c1", "id long").count() == 7
    latest = read_state(spark, root, "bins", "c1", "id long", latest_only=True)
    assert latest.count() == 3 and latest.columns == ["id", "customer", "refTs"]
    assert latest_partition(spark.range(5), "id").first()["id"] == 4


def test_watermark(spark, tmp_path):
    root = str(tmp_path / "state")
    quarter = timedelta(minutes=15)
    assert read_watermark(spark, root, "c1", T2, quarter) == T1
    write_watermark(spark, root, "c1", T2)
    write_watermark(spark, root, "c1", T1)
    assert read_watermark(spark, root, "c1", T2, quarter) == T2


def test_retention(spark, tmp_path):
    root, history = str(tmp_path / "state"), str(tmp_path / "history")
    for entity in ("endpoint", "etlBins"):
        for ts in (T1, T2):
            write_state(spark.range(3), root, entity, "c1", ts)
    tables = {e: read_state(spark, root, e, "c1", "id long") for e in ("endpoint", "etlBins")}
    live = archive_all(tables, T2, history, timedelta(0), timedelta(hours=1))
    assert live["etlBins"].count() == 3 and live["endpoint"].count() == 6
    assert read_state(spark, history, "etlBins", "c1", "id long").count() == 3
    again = archive(tables["etlBins"], T2, history, "etlBins")
    assert again.count() == 3 and read_state(spark, history, "etlBins", "c1", "id long").count() == 3


def test_latest_state_reads_one_partition(spark, tmp_path, plan):
    root = str(tmp_path / "state")
    write_state(spark.range(3), root, "bins", "c1", T1)
    latest = read_state(spark, root, "bins", "c1", "id long", latest_only=True)
    text = plan(latest)
    assert "PartitionFilters: [isnotnull(customer" in text and "refTs" in text.split("PartitionFilters")[1]


def test_metrics_sink_is_best_effort(spark, tmp_path):
    df = spark.range(2)
    path = str(tmp_path / "metrics")
    assert append_metrics(df, path) is None and append_metrics(df, path) is None
    assert spark.read.json(path).count() == 4
    assert isinstance(append_metrics(df, path, fmt="nosuchformat"), Exception)


def test_endpoint_merge(spark, rows):
    schema = "macAddress string, timestamp int, kind string"
    stored = spark.createDataFrame([("a", 1, "old"), ("b", 5, "kept")], schema)
    new = spark.createDataFrame([("a", 2, "new"), ("b", 4, "stale"), ("c", 1, "first")], schema)
    assert rows(merge_endpoints(new, stored)) == [("a", 2, "new"), ("b", 5, "kept"), ("c", 1, "first")]


def test_checkpoints_go_to_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert named in shared_dir(spark)


def test_written_tables_leave_no_shuffle_files(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return {name for name in disk.getAllBlocks().mkString(" ").split() if name.startswith("shuffle_")}

    for write in (stored, cut_lineage):
        held = shuffles()
        written = write(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("n")))
        until = time.time() + 20
        while shuffles() - held and time.time() < until:
            time.sleep(0.2)
        assert not shuffles() - held
        assert written.count() == 7
    assert spark.conf.get(setting) == before


def test_files_that_land_after_the_listing_wait(spark, tmp_path):
    from datetime import datetime, timedelta

    from tidemark.sources.raw import read_raw

    start = datetime(2024, 1, 1, 10)
    for minute in (1, 2, 3):
        folder = tmp_path / "c[1]" / "data" / f"2024-01-01T10-0{minute}-00.000Z" / "flows"
        folder.mkdir(parents=True)
        (folder / "part.json").write_text(f'{{"n": {minute}}}')
    args = (spark, str(tmp_path), "c[1]", "flows", "n int", start, start + timedelta(minutes=9), start)
    assert {r["n"] for r in read_raw(*args, fmt="json").collect()} == {1, 2, 3}
    assert {r["n"] for r in read_raw(*args, start + timedelta(minutes=2), fmt="json").collect()} == {1, 2}


def test_keys_are_cut_at_the_root_only(spark):
    from tidemark.sources.listing import key_of

    df = spark.createDataFrame([("s3://bucket/a/bucket/b.avro",), ("s3://other/bucket/b",), ("file:///t/x/y",)], "path string")
    assert [r[0] for r in df.select(key_of("path", "s3://bucket/")).collect()] == ["a/bucket/b.avro", None, None]
    assert [r[0] for r in df.select(key_of("path", "/t/x")).collect()] == [None, None, "y"]
    assert [r[0] for r in df.select(key_of("path", "file:/t")).collect()] == [None, None, "x/y"]
