import json
from datetime import datetime, timedelta

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tidemark.operators.features import OUT_OF_VOCAB
from tidemark.plans.dataset import UsageParams
from tidemark.plans.detection import BINS_SCHEMA, ClassModel, DetectionJob, run_detection
from tidemark.sources.state import read_state, read_watermark

WORDS = ["client-evil", "client-web", *OUT_OF_VOCAB.values()]
FLOW = (
    "timestamp timestamp, records array<struct<appName:string,clientBytesSent:long,serverBytesSent:long,"
    "clientPacketsSent:long,serverPacketsSent:long,ipProto:int,serverPort:long,clientMac:string,"
    "serverMac:string,clientMacDCS:string,serverMacDCS:string>>"
)
ENDPOINT = "timestamp timestamp, classificationData struct<macAddress:string,uuid:string,kind:string,matchedRules:string>"


def model(spark):
    rows = [(Vectors.dense(1, x, 0, 0), 1.0) for x in (0, 1)] + [(Vectors.dense(0, x, 0, 0), 0.0) for x in (0, 1)]
    return LogisticRegression().fit(spark.createDataFrame(rows * 5, ["features", "label"]))


def put(root, stamp, entity, rows):
    path = root / "c1" / "data" / f"{stamp:%Y-%m-%dT%H-%M-%S}.000Z" / entity / "part.json"
    path.parent.mkdir(parents=True)
    path.write_text("\n".join(json.dumps(r) for r in rows))


def flow(when, mac, app, sent=100):
    record = dict(
        appName=app, clientBytesSent=sent, serverBytesSent=50, clientPacketsSent=1, serverPacketsSent=1,
        ipProto=6, serverPort=99, clientMac=mac, serverMac=None, clientMacDCS=None, serverMacDCS=None,
    )
    return {"timestamp": f"{when:%Y-%m-%d %H:%M:%S}", "records": [record]}


def endpoint(when, mac, kind):
    return {
        "timestamp": f"{when:%Y-%m-%d %H:%M:%S}",
        "classificationData": {"macAddress": mac, "uuid": "u-" + mac, "kind": kind, "matchedRules": "x"},
    }


def at(minute, hour=10):
    return datetime(2024, 1, 1, hour) + timedelta(minutes=minute)


@pytest.fixture
def job(spark, tmp_path):
    return DetectionJob(
        raw_root=str(tmp_path / "raw"),
        state_root=str(tmp_path / "state"),
        flow_schema=FLOW,
        endpoint_schema=ENDPOINT,
        endpoint_keys=["macAddress"],
        class_rules=[("camera", F.col("kind") == "cam"), ("screen", F.col("kind") == "tv")],
        models={name: ClassModel(WORDS, model(spark)) for name in ("camera", "screen")},
        thresholds=spark.createDataFrame([("web", 1, 1)], "app string, minFlowClientBytes long, minFlowServerBytes long"),
        taxonomy=spark.createDataFrame([("web", True), ("evil", True)], "appName string, isInTaxonomy boolean"),
        registry=spark.createDataFrame([(6, "22", "ssh")], "ipProto int, port string, appName string"),
        default_client_bytes=60,
        default_server_bytes=50,
        fmt="json",
        params=UsageParams(window=timedelta(hours=1)),
        metrics_path=str(tmp_path / "metrics"),
    )


def test_two_runs(spark, job, tmp_path):
    raw = tmp_path / "raw"
    put(raw, at(3), "endpointclassification", [endpoint(at(2), "m1", "cam"), endpoint(at(1), "m1", "tv"), endpoint(at(1), "m2", "cam"), endpoint(at(1), "m3", "??")])
    put(raw, at(4), "netflowpacket", [flow(at(1), "m2", "web"), flow(at(1), "m1", "evil"), flow(at(1), "m1", "evil", sent=10), flow(at(2), "m3", "evil")])
    put(raw, at(14), "netflowpacket", [flow(at(15), "m2", "zzz.com"), flow(at(15), "m9", "evil")])

    detections, metrics = run_detection(spark, job, "c1", at(15))
    assert [(r["mac"], r["label"], r["windowStart"], r["windowEnd"]) for r in detections.collect()] == [
        ("m1", "screen", at(0), at(15))
    ]
    assert [a["appName"] for a in detections.first()["apps"]] == ["client-evil"]
    assert {(r["label"], r["numDevices"], r["numOutOfVocab"], r["numDetections"]) for r in metrics.collect()} == {
        ("camera", 1, 0, None), ("screen", 1, 0, 1)
    }
    assert read_watermark(spark, job.state_root, "c1", at(15), timedelta(minutes=15)) == at(14)
    assert run_detection(spark, job, "c1", at(15)) is None

    # The second run sees one late flow and a new one; endpoints come from the stored snapshot.
    put(raw, at(20), "netflowpacket", [flow(at(5), "m2", "evil"), flow(at(31), "m2", "web")])
    detections, _ = run_detection(spark, job, "c1", at(30))
    got = {r["mac"]: ([a["appName"] for a in r["apps"]], r["windowStart"], r["windowEnd"]) for r in detections.collect()}
    assert got == {
        "m1": (["client-evil"], at(0), at(30)),
        "m2": (["client-evil", "client-ssl", "client-web"], at(0), at(30)),
    }
    bins = read_state(spark, job.state_root, "etlBins", "c1", BINS_SCHEMA)
    assert bins.where(F.col("timeBin") == at(0)).select("refTs").distinct().count() == 2
    assert spark.read.json(job.metrics_path).count() == 4


def test_a_failed_run_is_repeated(spark, job, tmp_path, monkeypatch):
    import tidemark.plans.detection as detection

    raw = tmp_path / "raw"
    put(raw, at(3), "endpointclassification", [endpoint(at(2), "m1", "cam")])
    put(raw, at(4), "netflowpacket", [flow(at(1), "m1", "evil"), flow(at(15), "m1", "web")])

    def broken(*_):
        raise OSError("sink is down")

    with monkeypatch.context() as patch:
        patch.setattr(detection, "score_usage", broken)
        with pytest.raises(OSError):
            run_detection(spark, job, "c1", at(15))
    detections, _ = run_detection(spark, job, "c1", at(15))
    assert [(a["appName"], a["numFlows"]) for a in detections.first()["apps"]] == [("client-evil", 1)]


def test_a_run_without_detections_finds_none(spark, job, tmp_path):
    raw = tmp_path / "raw"
    put(raw, at(3), "endpointclassification", [endpoint(at(2), "m1", "cam")])
    put(raw, at(4), "netflowpacket", [flow(at(1), "m1", "evil"), flow(at(15), "m1", "web")])
    first, _ = run_detection(spark, job, "c1", at(15))
    assert first.count() == 1
    put(raw, at(4, hour=14), "netflowpacket", [flow(at(1, hour=14), "m1", "web"), flow(at(15, hour=14), "m1", "zzz.com")])
    second, metrics = run_detection(spark, job, "c1", at(15, hour=14))
    assert second.count() == 0
    assert [r["numDetections"] for r in metrics.collect()] == [None]
    # The newest snapshot is the empty one; the older one is still there.
    stored = first.schema
    assert read_state(spark, job.state_root, "detections", "c1", stored, latest_only=True).count() == 0
    assert read_state(spark, job.state_root, "detections", "c1", stored).count() == 1


def test_a_device_can_lose_its_class(spark, job, tmp_path):
    raw = tmp_path / "raw"
    put(raw, at(3), "endpointclassification", [endpoint(at(2), "m1", "cam")])
    put(raw, at(4), "netflowpacket", [flow(at(1), "m1", "evil"), flow(at(15), "m1", "web")])
    assert run_detection(spark, job, "c1", at(15))[0].count() == 1
    put(raw, at(18), "endpointclassification", [endpoint(at(17), "m1", "??")])
    put(raw, at(19), "netflowpacket", [flow(at(16), "m1", "evil"), flow(at(31), "m1", "web")])
    detections, metrics = run_detection(spark, job, "c1", at(30))
    bins = read_state(spark, job.state_root, "etlBins", "c1", BINS_SCHEMA)
    # The flows of the second run belong to no class any more.
    assert bins.where(F.col("refTs") > "2024-01-01T10-04-00.000").count() == 0
    assert detections.count() == 0


def test_old_snapshots_are_retired(spark, job, tmp_path):
    from dataclasses import replace

    job = replace(job, history_root=str(tmp_path / "history"), keep=timedelta(minutes=5))
    raw = tmp_path / "raw"
    put(raw, at(3), "endpointclassification", [endpoint(at(2), "m1", "cam")])
    put(raw, at(4), "netflowpacket", [flow(at(1), "m1", "evil"), flow(at(15), "m1", "web")])
    run_detection(spark, job, "c1", at(15))
    put(raw, at(20), "netflowpacket", [flow(at(31), "m1", "web")])
    run_detection(spark, job, "c1", at(30))
    old = spark.read.parquet(str(tmp_path / "history" / "etlBins"))
    assert old.select("refTs").distinct().count() == 1
    assert spark.read.parquet(str(tmp_path / "history" / "detections")).count() == 1
