from datetime import datetime, timedelta

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.functions.times import start_time, time_bin
from tidemark.operators.features import OUT_OF_VOCAB, device_words, multi_hot, vocabulary_words
from tidemark.operators.metrics import out_of_vocab_metrics
from tidemark.operators.rollup import last_record, nested_usage, time_bins, trailing_window
from tidemark.plans.dataset import UsageParams, device_usage

I, W = timedelta(minutes=15), timedelta(hours=1)
SCHEMA = (
    "timestamp timestamp, mac string, appName string, side string, uuid string, logicalClass string, "
    "clientBytesSent long, serverBytesSent long"
)


def at(minute, hour=0):
    return datetime(2024, 1, 1, hour, minute)


def flow(when, mac="m", app="web", side="client", sent=10, got=1):
    return (when, mac, app, side, "u-" + mac, "cam", sent, got)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def window_of(bins, window=W):
    return trailing_window(bins, I, window, last_record(bins))


def test_bins_are_complete_up_to_the_last_record(spark, rows):
    bins = time_bins(frame(spark, [flow(at(5)), flow(at(20)), flow(at(31))]), I)
    got = window_of(bins).select("appName", "windowStart", "windowEnd", "clientBytesWindow", "totalBytesWindow", "numFlowsWindow")
    assert rows(got) == [("client-web", at(0), at(30), 20, 22, 2)]


def test_no_complete_bin_gives_no_usage(spark):
    bins = time_bins(frame(spark, [flow(at(5)), flow(at(14))]), I)
    assert window_of(bins).count() == 0 and bins.count() == 1


def test_bin_ends_exactly_at_the_last_record(spark):
    bins = time_bins(frame(spark, [flow(at(5)), flow(at(15))]), I)
    assert window_of(bins).first()["windowEnd"] == at(15)


def test_late_rows_are_summed_into_their_bin(spark, rows):
    first = time_bins(frame(spark, [flow(at(5)), flow(at(16))]), I)
    second = time_bins(frame(spark, [flow(at(10), sent=100), flow(at(31))]), I)
    both = first.unionByName(second)
    assert both.where(F.col("timeBin") == at(0)).count() == 2
    got = trailing_window(both, I, W, last_record(second))
    assert rows(got.select("clientBytesWindow", "numFlowsWindow")) == [(120, 3)]


def test_window_is_limited_and_any_split_merges_to_the_whole(spark, rows):
    data = [flow(at(m, h), mac=f"m{(m + h) % 3}", sent=m, got=h) for h in range(3) for m in range(0, 60, 7)]
    whole = time_bins(frame(spark, data), I)
    for parts in ((data[::2], data[1::2]), (data[:5], data[5:]), (data[-3:], data[:-3])):
        merged = time_bins(frame(spark, parts[0]), I).unionByName(time_bins(frame(spark, parts[1]), I))
        assert rows(window_of(merged)) == rows(window_of(whole))
    bounds = window_of(whole).select("windowStart", "windowEnd").distinct().collect()
    assert [tuple(b) for b in bounds] == [(at(45, 1), at(45, 2))]


def test_null_measures_count_as_zero_and_null_keys_group(spark, rows):
    bins = time_bins(
        frame(spark, [(at(1), "m", "web", "client", None, "cam", None, 3), (at(2), "m", "web", "client", None, "cam", None, 4)]), I
    )
    assert rows(bins.select("uuid", "clientBytesInterval", "totalBytesInterval", "numFlowsInterval")) == [(None, 0, 7, 2)]


def test_time_bin_is_epoch_aligned(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 10:44:59.999' a, timestamp'1969-12-31 23:59:00' b")
    got = df.select(time_bin("a", I), time_bin("b", I)).first()
    assert tuple(got) == (at(30, 10), datetime(1969, 12, 31, 23, 45))


def test_start_time():
    end = at(0, 12)
    assert start_time(at(50, 11), end, I) == at(45, 11)
    assert start_time(at(30, 11), end, I) == at(30, 11)
    assert start_time(at(0, 5), end, I) == at(0, 11)


def usage_frame(spark):
    app = "struct<appName:string,totalClientBytes:long,totalServerBytes:long,totalBytes:long,numFlows:long>"
    data = [
        ("m1", [("client-web", 1, 1, 2, 3), ("client-odd", 1, 1, 2, 1), ("server-off", 0, 0, 0, 0)]),
        ("m2", [("server-odd", 1, 1, 2, 1), ("other", 1, 1, 2, 5), ("client-ssh", 1, 1, 2, 0)]),
        ("m3", []),
        ("m4", None),
        ("m5", [("client-web", 1, 1, 2, 1), ("client-web", 1, 1, 2, 1)]),
    ]
    return spark.createDataFrame(data, f"mac string, apps array<{app}>")


def test_multi_hot(spark):
    vocabulary = ["client-ssh", "client-web", *OUT_OF_VOCAB.values()]
    got = multi_hot(usage_frame(spark), vocabulary, ["mac"])
    bits = {r["mac"]: list(r["f"]) for r in got.select("mac", vector_to_array("features").alias("f")).collect()}
    assert bits == {
        "m1": [0, 1, 1, 0], "m2": [0, 0, 0, 1], "m3": [0, 0, 0, 0], "m4": [0, 0, 0, 0], "m5": [0, 1, 0, 0],
    }


def test_multi_hot_rejects_other_features(spark):
    with pytest.raises(ValueError, match="binary"):
        multi_hot(usage_frame(spark), list(OUT_OF_VOCAB.values()), ["mac"], feature_type="total-bytes")
    with pytest.raises(ValueError, match="vocabulary"):
        multi_hot(usage_frame(spark), ["client-web"], ["mac"])


def test_words_from_the_window_equal_words_from_nested_usage(spark, rows):
    data = [flow(at(m), mac=f"m{m % 4}", app=f"app{m % 5}", side="server" if m % 2 else "client") for m in range(50)]
    windowed = window_of(time_bins(frame(spark, data), I))
    table = spark.createDataFrame([("cam", "client-app0"), ("cam", "server-app1"), ("tv", "client-app2")], "label string, word string")
    direct = device_words(windowed, table)
    nested = nested_usage(windowed)
    by_nested = vocabulary_words(nested, table)
    assert rows(direct.select("mac", "words")) == rows(by_nested.select("mac", "words"))
    assert rows(direct.select("mac", "apps")) == rows(nested.select("mac", "apps"))
    counts = out_of_vocab_metrics(direct).first()
    assert (counts["numDevices"], counts["numOutOfVocab"]) == (4, 4)


def test_device_usage_from_raw_flows(spark, rows):
    columns = (
        "timestamp timestamp, ipProto int, serverPort long, appName string, clientBytesSent long, serverBytesSent long, "
        "clientPacketsSent long, serverPacketsSent long, clientMac string, serverMac string, clientMacDCS string, serverMacDCS string"
    )

    def raw(when, app="web", port=443, sent=5, mac="m1", dcs=None, server=None):
        return (when, 6, port, app, sent, 1, 1, 1, mac, server, dcs, None)

    flows = spark.createDataFrame(
        [
            raw(at(1)), raw(at(2), sent=9), raw(at(3), app="x.com"), raw(at(4), app="odd", port=22),
            raw(at(5), app="odd", port=1), raw(at(6), mac=None, dcs="m2"), raw(at(7), mac="stranger"),
            raw(at(8), app="web", mac="idle"), raw(at(40), app="web", mac="m2", server="m1"),
        ],
        columns,
    )
    endpoints = spark.createDataFrame(
        [("m1", "cam", "u1"), ("m2", "cam", "u2"), ("idle", "other", "u3")], "macAddress string, logicalClass string, uuid string"
    )
    taxonomy = spark.createDataFrame([("web", True)], "appName string, isInTaxonomy boolean")
    registry = spark.createDataFrame([(6, "22", "ssh")], "ipProto int, port string, appName string")
    params = UsageParams(interval=I, window=W, active_classes=("cam",))
    usage, bins = device_usage(flows, endpoints, taxonomy, registry, None, params)
    apps = {
        r["mac"]: [(a["appName"], a["totalClientBytes"], a["numFlows"]) for a in r["apps"]] for r in usage.collect()
    }
    # The first two flows are quasi-duplicates, and so are those of m2 (one by its fallback).
    assert apps == {
        "m1": [("client-https", 5, 1), ("client-ssh", 5, 1), ("client-web", 9, 1)],
        "m2": [("client-web", 5, 1)],
    }
    assert bins.where(F.col("timeBin") == at(30)).count() == 2
