import pytest
from pyspark.sql import functions as F

from tidemark.functions.names import resolved_app_name
from tidemark.operators.dedupe import collapse_quasi_duplicates, earliest_per_key, first_per_key
from tidemark.operators.enrich import (
    assign_class,
    attach_endpoints,
    byte_threshold_filter,
    fill_from,
    flatten_records,
    flatten_struct,
    lookup_flag,
    lookup_overwrite,
    port_based_apps,
    resolve_app_names,
    unpivot_sides,
)

TCP, UDP = 6, 17


@pytest.mark.parametrize(
    "app, proto, port, known, want",
    [
        ("foo.example.com", TCP, 443, False, "https"),
        ("foo.example.com", TCP, 443, True, "https"),
        ("foo.example.com", TCP, 80, False, "http"),
        ("x:8080", TCP, 443, False, "https"),
        ("x:53_UDP", TCP, 80, False, "http"),
        ("x:8080", TCP, 99, False, "unknown"),
        ("x:8080", TCP, 99, True, "x:8080"),
        ("http-x-over-http", TCP, 99, False, "httpover-http"),
        ("ssl-x-over-http", TCP, 99, False, "sslover-http"),
        ("a-over-http-tail", TCP, 99, False, "a-over-http"),
        ("a-over-http", UDP, 99, True, "unknown"),
        ("ssl-foo", TCP, 99, False, "ssl"),
        ("ssl-foo", UDP, 99, False, "unknown"),
        ("ssl-foo", UDP, 99, True, "ssl-foo"),
        ("http-foo", TCP, 99, False, "http"),
        ("foo.com", TCP, 99, False, "ssl"),
        ("foo.com", UDP, 99, False, "unknown"),
        ("dns", UDP, 53, True, "dns"),
        ("mystery", TCP, 99, False, "unknown"),
        ("foo.com", None, 443, False, "unknown"),
        # A port of the web decides for server names and generated names, over TCP alone.
        ("ssl-shop.org", TCP, 443, True, "https"),
        ("http-shop.org", TCP, 80, True, "http"),
        ("shop.org", UDP, 80, True, "shop.org"),
        ("10.1.2.3:9_TCP", TCP, 80, True, "http"),
        ("host:9_SCTP", TCP, 443, True, "host:9_SCTP"),
        # Tunnels keep what they carry, cut after the mark; a prefix names the protocol.
        ("mail-over-http:9", TCP, 5, False, "mail-over-http"),
        ("mail.org-over-http", TCP, 443, False, "https"),
        ("mail-over-http", None, 5, True, "unknown"),
        ("ssl-over-http", TCP, 5, True, "sslover-http"),
        # Prefixes beat the taxonomy over TCP; elsewhere the taxonomy decides.
        ("http-mail", TCP, 5, True, "http"),
        ("http-mail", UDP, 5, True, "http-mail"),
        ("ssl-mail.org", TCP, 5, False, "ssl"),
        # What is left: known names stay, server names over TCP are ssl, others unknown.
        ("mail.org:7", TCP, 5, False, "unknown"),
        ("mail.org", TCP, 5, True, "mail.org"),
        ("mail", TCP, 443, True, "mail"),
        ("mail", TCP, 443, None, "unknown"),
    ],
)
def test_app_names(spark, app, proto, port, known, want):
    df = spark.createDataFrame([(app, proto, port, known)], "a string, p int, s long, k boolean")
    name = resolved_app_name(F.col("a"), F.col("p"), F.col("s"), F.col("k"))
    assert df.select(name).first()[0] == want


def test_resolve_and_name_by_port(spark, rows):
    flows = spark.createDataFrame(
        [(1, "dns", UDP, 53), (2, "odd", TCP, 22), (3, "odd", TCP, 23), (4, "odd", TCP, 8005), (5, "x.com", TCP, 443)],
        "n int, appName string, ipProto int, serverPort long",
    )
    taxonomy = spark.createDataFrame([("dns", True), ("dns", False), ("odd", False)], "appName string, isInTaxonomy boolean")
    registry = spark.createDataFrame(
        [(TCP, "22", "ssh"), (TCP, "22", "zsh"), (TCP, "8000-8010", "range"), (UDP, "23", "no")],
        "ipProto int, port string, appName string",
    )
    df = port_based_apps(resolve_app_names(flows, taxonomy), registry)
    assert rows(df.select("n", "appName")) == [(1, "dns"), (2, "ssh"), (5, "https")]


def test_dedupe_is_deterministic_and_keeps_null_keys(spark, rows):
    data = [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), (None, 5, "p"), (None, 4, None), ("b", None, "q")]
    df = spark.createDataFrame(data, "k string, timestamp int, v string").repartition(4)
    assert rows(earliest_per_key(df, ["k"])) == sorted(
        [("a", 1, "y"), (None, 4, None), ("b", None, "q")], key=repr
    )
    assert rows(first_per_key(df, ["k"], ["v"]).select("k", "v")) == sorted(
        [("a", "x"), (None, None), ("b", "q")], key=repr
    )
    assert first_per_key(df.select("k"), ["k"], []).count() == 3


def test_dedupe_reduces_before_the_shuffle(spark, plan):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), F.col("id").alias("timestamp"))
    text = plan(earliest_per_key(df, ["k"]))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_quasi_duplicates(spark, rows):
    data = [("a", 1, 5, None, "late"), ("a", 2, 3, "m2", None), ("a", 3, 1, "m3", None), (None, 1, 1, None, None)]
    df = spark.createDataFrame(data, "k string, timestamp int, bytes int, mac string, other string")
    got = collapse_quasi_duplicates(
        df.repartition(3), ["k"], max_cols=["bytes", "timestamp"], first_cols=["mac", "other"]
    )
    assert rows(got) == sorted([("a", 5, 3, "m2", "late"), (None, 1, 1, None, None)], key=repr)


def test_flatten(spark, rows):
    raw = spark.createDataFrame(
        [(1, [("a", 5), ("b", 6)]), (2, [("c", 7)]), (3, [])], "ts int, records array<struct<appName:string,n:int>>"
    )
    assert rows(flatten_records(raw)) == [(1, "a", 5), (2, "c", 7), (3, None, None)]
    endpoints = spark.createDataFrame(
        [(1, ("m", ["x"], "gone")), (2, ("n", None, None))],
        "ts int, classificationData struct<macAddress:string,groups:array<string>,matchedRules:string>",
    )
    assert rows(flatten_struct(endpoints)) == [(1, "m", ["x"]), (2, "n", [])]


def test_fill_and_unpivot(spark, rows, plan):
    df = spark.createDataFrame(
        [(1, "c1", None, "x", "s9"), (2, None, None, None, None), (3, None, "s3", "d3", None)],
        "n int, clientMac string, serverMac string, clientMacDCS string, serverMacDCS string",
    )
    filled = fill_from(df, {"clientMac": "clientMacDCS", "serverMac": "serverMacDCS"})
    assert filled.columns == ["n", "clientMac", "serverMac"]
    sides = unpivot_sides(filled, ["n"], {"server": "serverMac", "client": "clientMac"})
    assert rows(sides) == [
        (1, "c1", "client"), (1, "s9", "server"), (3, "d3", "client"), (3, "s3", "server"),
    ]
    assert "Union" not in plan(sides) and "Exchange" not in plan(sides)


def test_byte_thresholds(spark, rows):
    flows = [
        ("web", 10, 5), ("web", 10, 4), ("Unknown", 1, 1), ("unknown", 0, 9),
        ("x", 100, 20), ("x", 20, 100), ("x", 99, 99), ("x", 100, 19), (None, 100, 20),
    ]
    df = spark.createDataFrame(flows, "appName string, clientBytesSent long, serverBytesSent long")
    limits = spark.createDataFrame(
        [("web", 10, 5), ("unknown", 1, 1)], "app string, minFlowClientBytes long, minFlowServerBytes long"
    )
    got = byte_threshold_filter(df, limits, 100, 20)
    assert rows(got) == sorted(
        [("web", 10, 5), ("Unknown", 1, 1), ("x", 100, 20), ("x", 20, 100), (None, 100, 20)], key=repr
    )


def test_lookups_do_not_fan_out(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "n int, k string")
    table = spark.createDataFrame([("a", True), ("a", False), (None, True)], "k string, f boolean")
    assert rows(lookup_flag(df, table, "k", "f")) == sorted(
        [(1, "a", True), (2, "b", False), (3, None, False)], key=repr
    )
    names = spark.createDataFrame([("a", "z"), ("a", "y")], "k string, v string")
    over = lookup_overwrite(df.withColumn("c", F.lit("old")), names, ["k"], "c", "v", F.col("n") < 3)
    assert rows(over) == sorted([(1, "a", "y"), (3, None, "old")], key=repr)


def test_classes_and_endpoints(spark, rows):
    endpoints = spark.createDataFrame(
        [("m1", "u1", "cam"), ("m2", "u2", "tv"), ("m3", "u3", "?")], "macAddress string, uuid string, kind string"
    )
    classed = assign_class(endpoints, [("camera", F.col("kind") == "cam"), ("screen", F.col("kind").isin("cam", "tv"))])
    assert rows(classed.select("macAddress", "logicalClass")) == [("m1", "camera"), ("m2", "screen")]
    flows = spark.createDataFrame([("m1", 1), ("m2", 2), ("m9", 3)], "mac string, n int")
    assert rows(attach_endpoints(flows, classed, ["camera"])) == [("m1", 1, "camera", "u1")]
    assert attach_endpoints(flows, classed).count() == 2


def test_small_lookup_is_broadcast_and_filters_reach_the_scan(spark, plan, tmp_path):
    path = str(tmp_path / "flows")
    spark.range(100).selectExpr("id n", "cast(id as string) k", "id other").write.parquet(path)
    table = spark.range(3).selectExpr("cast(id as string) k", "true f")
    df = lookup_flag(spark.read.parquet(path).where("n > 5").select("n", "k"), table, "k", "f")
    text = plan(df)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "GreaterThan(n,5)" in text and "other" not in text
