import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.asof import asof_join, in_range_parts, interval_join

# Doors opened, and what a thermometer and a meter at the site said around then.
OPENED = [(1, "north", "in", 100), (2, "north", "out", 160), (3, "south", "in", 95), (4, "east", "in", 30), (5, "north", "in", 400)]
READ = [
    ("north", "in", 40, 7, None), ("north", "out", 90, None, 21), ("north", "in", 100, 9, None),
    ("north", "in", 155, None, 30), ("north", "out", 405, 2, 2), ("south", "in", 96, 5, 5), ("west", "in", 30, 1, 1),
]
NAMES = {"left_map": {"site": "site", "n": "n"}, "right_map": {"site": "site", "heat": "heat", "load": "load"}}
STRATEGIES = [{"strategy": "window"}, {"strategy": "bucketed"}, {"strategy": "bucketed", "bucket_ms": 3}, {"strategy": "scan"}]


@pytest.fixture
def left(spark):
    return spark.createDataFrame(OPENED, "n int, site string, way string, ts long")


@pytest.fixture
def right(spark):
    return spark.createDataFrame(READ, "site string, way string, ts long, heat int, load int")


def values(df):
    return {r["n"]: (r["heat"], r["load"]) for r in df.collect()}


@pytest.mark.parametrize("options", STRATEGIES)
@pytest.mark.parametrize(
    "lookback, match, want",
    [
        (60, "previous", {1: (9, 21), 2: (9, 30), 3: (None, None), 4: (None, None), 5: (None, None)}),
        (None, "previous", {1: (9, 21), 2: (9, 30), 3: (None, None), 4: (None, None), 5: (9, 30)}),
        (60, "next", {1: (9, 30), 2: (None, None), 3: (5, 5), 4: (None, None), 5: (2, 2)}),
    ],
)
def test_each_column_has_its_own_match(left, right, lookback, match, want, options):
    df = asof_join(left, right, ["site"], lookback_ms=lookback, match=match, **NAMES, **options)
    assert df.columns == ["site", "n", "ts", "heat", "load"]
    assert values(df) == want


@pytest.mark.parametrize("options", STRATEGIES)
def test_further_key_renamed(left, right, options):
    maps = {
        "left_map": {"site": "site", "way": "side", "n": "n"},
        "right_map": {"site": "site", "way": "side", "heat": "heat", "load": "load"},
    }
    df = asof_join(left, right, ["site", "side"], lookback_ms=80, **maps, **options)
    assert set(df.columns) == {"site", "side", "ts", "n", "heat", "load"}
    assert values(df) == {1: (9, None), 2: (None, 21), 3: (None, None), 4: (None, None), 5: (None, None)}


@pytest.mark.parametrize("options", STRATEGIES)
def test_timestamp_and_columns_by_choice(left, right, options):
    df = asof_join(
        left.withColumnRenamed("ts", "at"), right.withColumnRenamed("ts", "at"),
        ["site"], ts="at", lookback_ms=None, right_cols=["load"], **NAMES, **options,
    )
    assert df.columns == ["site", "n", "at", "load"]
    assert {r["n"]: r["load"] for r in df.collect()} == {1: 21, 2: 30, 3: None, 4: None, 5: 30}


@pytest.mark.parametrize("options", STRATEGIES)
def test_plan_has_no_nested_loop(left, right, plan, options):
    df = asof_join(left, right, ["site"], lookback_ms=10, **NAMES, **options)
    text = plan(df)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_bucketed_plan_partitions_by_key_and_bucket(left, right, plan):
    text = plan(asof_join(left, right, ["site"], lookback_ms=10, **NAMES))
    assert "partial_max" in text
    windows = [line for line in text.splitlines() if "Window [" in line and "ts" in line.split("],")[-1]]
    assert windows and all("__bucket" in line.split("], [")[1] for line in windows)


def brute(left, right, lookback, ahead):
    out = []
    for n, key, ts in left:
        found = []
        for c in (0, 1):
            hits = [
                (abs(ts - t), -v[c]) for k, t, *v in right
                if key is not None and k == key and v[c] is not None
                and (t >= ts if ahead else t <= ts) and (lookback is None or abs(ts - t) <= lookback)
            ]
            found.append(-min(hits)[1] if hits else None)
        out.append((n, key, ts, *found))
    return sorted(out)


@pytest.mark.parametrize("match", ["previous", "next"])
@pytest.mark.parametrize("lookback", [0, 7, 1500, None])
def test_against_brute_force_with_a_hot_key(spark, match, lookback):
    rnd = random.Random(lookback)
    key = lambda: rnd.choice(["hot", "hot", "hot", "a", "b", None])
    scale = 40 if lookback in (0, 7) else 9000
    left = [(n, key(), rnd.randrange(scale)) for n in range(150)]
    right = [
        (key(), rnd.randrange(scale), *(rnd.choice([None, rnd.randrange(100)]) for _ in range(2)))
        for _ in range(150)
    ]
    l = spark.createDataFrame(left, "n int, key string, ts long")
    r = spark.createDataFrame(right, "key string, ts long, x int, y int")
    want = brute(left, right, lookback, match == "next")
    for options in ({"strategy": "window"}, {"strategy": "scan"}, {}, {"bucket_ms": 5}, {"bucket_ms": 700}):
        df = asof_join(l, r, ["key"], lookback_ms=lookback, match=match, **options)
        assert sorted(map(tuple, df.select("n", "key", "ts", "x", "y").collect()), key=lambda t: t[0]) == want


@pytest.mark.parametrize("options", STRATEGIES)
def test_null_keys_and_timestamps(spark, options):
    left = spark.createDataFrame([(1, None, 5), (2, "a", 5), (3, "a", None)], "n int, key string, ts long")
    right = spark.createDataFrame([(None, 4, 7), ("a", 4, 8), ("a", None, 9)], "key string, ts long, v int")
    plain = asof_join(left, right, ["key"], **options)
    assert {r["n"]: r["v"] for r in plain.collect()} == {1: None, 2: 8}
    safe = asof_join(left, right, ["key"], null_safe_keys=True, **options)
    assert {r["n"]: r["v"] for r in safe.collect()} == {1: 7, 2: 8}


@pytest.mark.parametrize("options", STRATEGIES)
def test_tie_break_and_left_copies(spark, options):
    left = spark.createDataFrame([("a", 5, "p"), ("a", 5, "q"), ("a", 5, "q")], "key string, ts long, tag string")
    right = spark.createDataFrame([("a", 5, "low", 2), ("a", 5, "zz", 1)], "key string, ts long, v string, rank int")
    by_rank = asof_join(left, right, ["key"], right_cols=["v"], tie_break=["rank"], **options)
    assert [r["v"] for r in by_rank.collect()] == ["low"] * 3
    by_value = asof_join(left, right, ["key"], right_cols=["v"], **options)
    assert [r["v"] for r in by_value.collect()] == ["zz"] * 3
    single = asof_join(left, right, ["key"], right_cols=["v"], collapse_left=True, **options)
    assert [(r["tag"], r["v"]) for r in single.collect()] == [("p", "zz")]


@pytest.mark.parametrize("options", STRATEGIES)
def test_skip_empty(left, right, options):
    right = right.withColumn("none", F.lit(None).cast("int"))
    maps = {**NAMES, "right_map": {**NAMES["right_map"], "none": "none"}}
    plain = asof_join(left, right, ["site"], lookback_ms=60, right_cols=["heat", "load"], **NAMES, **options)
    df = asof_join(left, right, ["site"], lookback_ms=60, right_cols=["none", "heat", "load"], skip_empty=True, **maps, **options)
    assert df.columns == ["site", "n", "ts", "none", "heat", "load"]
    assert values(df) == values(plain) and df.where("none is not null").count() == 0
    only = asof_join(left, right, ["site"], right_cols=["none"], skip_empty=True, **maps, **options)
    assert only.count() == len(OPENED) and only.columns[-1] == "none"


def test_errors(left, right):
    with pytest.raises(ValueError, match="both sides"):
        asof_join(left, right.withColumnRenamed("heat", "n"), ["site"], right_cols=["n"])
    with pytest.raises(ValueError, match="no columns"):
        asof_join(left, right, ["room"], right_cols=["heat"])
    with pytest.raises(ValueError, match="timestamp"):
        asof_join(left, right, ["site"], ts="at")
    with pytest.raises(ValueError, match="match"):
        asof_join(left, right, ["site"], right_cols=["heat"], match="nearest")


def test_interval_join_at_the_same_time(spark):
    left = spark.createDataFrame([(1, "a", 7), (2, "a", -3), (3, "b", 0)], "i int, key string, ts long")
    right = spark.createDataFrame([(1, "a", 7), (2, "a", 6), (3, "b", 0), (4, "a", -3)], "j int, key string, ts long")
    df = interval_join(left, right, ["key"], lookback_ms=0)
    assert sorted((r["i"], r["j"]) for r in df.collect()) == [(1, 1), (2, 4), (3, 3)]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_interval_join_against_brute_force(spark, how):
    rnd = random.Random(1)
    left = [(n, rnd.choice("ab"), rnd.randrange(5000)) for n in range(60)]
    right = [(n, rnd.choice("ab"), rnd.randrange(5000)) for n in range(60)]
    df = interval_join(
        spark.createDataFrame(left, "i int, key string, ts long"),
        spark.createDataFrame(right, "j int, key string, ts long"),
        ["key"], lookback_ms=1500, how=how,
    )
    want = [(i, j) for i, k, t in left for j, q, u in right if k == q and 0 <= t - u <= 1500]
    if how == "left":
        want += [(i, None) for i, _, _ in left if i not in {a for a, _ in want}]
    assert sorted(map(tuple, df.select("i", "j").collect()), key=repr) == sorted(want, key=repr)
    assert df.columns == ["i", "key", "ts", "j", "right_ts"]


def test_adaptive_execution_splits_a_hot_timestamp(spark):
    """Copies of one (key, timestamp) are spread over several tasks of the join."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(0, 60_000, 1, 8).select(
            "id", F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("key"), F.lit(5).cast("long").alias("ts")
        )
        right = spark.range(1000).select(F.col("id").alias("key"), F.lit(4).cast("long").alias("ts"), F.lit(1).alias("v"))
        df = asof_join(left, right, ["key"])
        assert df.agg(F.count("*"), F.count("v")).first() == (60_000, 40_000 + 334)
        rows = df.collect()
        assert len(rows) == 60_000
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_scan_bounds_the_largest_task(spark, plan):
    """One key and one hour hold nine tenths of the rows, and still no part is large."""
    rnd = random.Random(12)
    hot = [("hot", 5_000_000 + k) for k in rnd.sample(range(3_600_000), 9_000)]
    rows = hot + [(f"k{k % 40}", rnd.randrange(10**9)) for k in range(1_000)]
    left = [(n, k, t) for n, (k, t) in enumerate(rows) if n % 2]
    right = [(k, t, n if n % 3 else None, -n if n % 5 else None) for n, (k, t) in enumerate(rows) if not n % 2]
    schema = "key string, ts long, up int, down int"
    probes, values = spark.createDataFrame(left, "n int, key string, ts long"), spark.createDataFrame(right, schema)
    parts = in_range_parts(probes.select("key", "ts"), ["key", "ts"], "part", 20).groupBy("part").count().collect()
    assert len(parts) == 20 and max(r["count"] for r in parts) < 2 * len(left) / 20
    for match in ("previous", "next"):
        got, want = (
            {r["n"]: (r["up"], r["down"]) for r in asof_join(probes, values, ["key"], match=match, lookback_ms=90_000, strategy=s).collect()}
            for s in ("scan", "window")
        )
        assert got == want and len(got) == len(left)


def test_scan_with_null_keys_and_without_rows(spark, rows):
    left = spark.createDataFrame([(1, None, 5), (2, "a", 5), (3, "a", None)], "n int, key string, ts long")
    right = spark.createDataFrame([(None, 4, 7), ("a", 5, 8), ("a", None, 9)], "key string, ts long, v int")
    scan = {"strategy": "scan"}
    assert rows(asof_join(left, right, ["key"], **scan).select("n", "v")) == [(1, None), (2, 8)]
    assert rows(asof_join(left, right, ["key"], null_safe_keys=True, **scan).select("n", "v")) == [(1, 7), (2, 8)]
    assert rows(asof_join(left, right.limit(0), ["key"], **scan).select("n", "v")) == [(1, None), (2, None)]
    assert asof_join(left.limit(0), right, ["key"], **scan).count() == 0
