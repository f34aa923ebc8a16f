"""The newest record of every device, in Spark's state store.

Devices are dealt to buckets by hash. The state of a bucket is the newest record of each of its
devices, so that a bucket, not a device, costs calls to the state store; a batch costs its own rows
and the buckets they fall into. Rows may come late, twice or out of order: the order of records
decides, not that of batches. A timer retires devices whose newest record has become too old.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: What a change row says of its device.
NEW, UPDATED, RETIRED = "new", "updated", "retired"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Buckets of devices: 10 million devices make about 2,500 a bucket.
BUCKETS = 4096


@contextmanager
def state_store(spark) -> Iterator[None]:
    """Streams that start in this context keep their state in RocksDB, as that of devices has to be."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, PROVIDER)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def changed_endpoints(
    stream: DataFrame, *, key: str = "macAddress", ts: str = "timestamp", keep: timedelta = timedelta(days=90),
    buckets: int = BUCKETS,
) -> DataFrame:
    """Change rows of devices: all columns of ``stream``, and ``change``.

    ``ts`` is a timestamp. A row is written when a device gets a newer record (``new`` or
    ``updated``), of records at one time the one whose other columns are greatest, as in
    ``merge_endpoints``. When the stream has passed a newest record by ``keep`` the device is
    ``retired``, with that record; records later than that are dropped. Rows without a
    device or a time are left out. Start it in update mode, in a ``state_store``; a checkpoint
    keeps the number of ``buckets`` it began with.
    """
    rest = [f for f in stream.schema.fields if f.name not in (key, ts)]
    known = stream.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).withWatermark(ts, f"{keep // timedelta(milliseconds=1)} milliseconds")
    packed = F.to_json(F.struct(*[f.name for f in rest]), {"ignoreNullFields": "false"})
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).alias("__bucket")
    rows = known.select(bucket, key, ts, F.unix_micros(ts).alias("micros"), packed.alias("packed"))
    schema = T.StructType([stream.schema[key], T.StructField("micros", T.LongType()), T.StructField("packed", T.StringType()), T.StructField("change", T.StringType())])
    changes = rows.groupBy("__bucket").transformWithStateInPandas(
        _Newest(stream.schema[key], keep), outputStructType=schema, outputMode="Update", timeMode="EventTime"
    )
    record = F.from_json("packed", T.StructType(rest))
    columns = {f.name: record[f.name] for f in rest}
    columns[ts] = F.timestamp_micros("micros").cast(stream.schema[ts].dataType)
    return changes.select(*[columns.get(c, F.col(c)).alias(c) for c in stream.columns], "change")


def _order(record: tuple[int, str]) -> tuple:
    """Records by time, then by their columns one after the other; nulls are least."""
    at, rest = record
    values = [(v is not None, json.dumps(v) if isinstance(v, dict) else v) for v in json.loads(rest).values()]
    return at, [v if v[0] else (False,) for v in values]


class _Newest(StatefulProcessor):
    """Keeps the newest records of the devices of a bucket, and a timer for the oldest of them."""

    def __init__(self, key: T.StructField, keep: timedelta) -> None:
        self.key, self.keep = key, keep // timedelta(microseconds=1)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        arrays = [("keys", self.key.dataType), ("at", T.LongType()), ("rest", T.StringType())]
        fields = [T.StructField(name, T.ArrayType(kind)) for name, kind in arrays]
        self.devices = handle.getValueState("devices", T.StructType([*fields, T.StructField("timer", T.LongType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        newest, timer = self._stored()
        before = set(newest)
        changed = {}
        for pdf in rows:
            for device, at, rest in zip(pdf[self.key.name], pdf["micros"], pdf["packed"]):
                record, best = (int(at), rest), newest.get(device)
                if best is None or record != best and (record[0] > best[0] or record[0] == best[0] and _order(record) > _order(best)):
                    newest[device] = changed[device] = record
        if changed:
            self._store(newest, timer)
            yield self._rows(changed, [UPDATED if device in before else NEW for device in changed])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        newest, _ = self._stored()
        passed = timerValues.getCurrentWatermarkInMs()
        retired = {device: record for device, record in newest.items() if self._expiry(record) <= passed}
        self._store({device: record for device, record in newest.items() if device not in retired}, None)
        if retired:
            yield self._rows(retired, [RETIRED] * len(retired))

    def _stored(self) -> tuple[dict, int | None]:
        """The newest record of every device, and the time of the timer."""
        stored = self.devices.get()
        if stored is None:
            return {}, None
        keys, at, rest, timer = stored
        return dict(zip(keys, zip(at, rest))), timer

    def _store(self, newest: dict, timer: int | None) -> None:
        if not newest:
            self.devices.clear()
            return
        first = min(map(self._expiry, newest.values()))
        if first != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(first)
        at, rest = zip(*newest.values())
        self.devices.update((list(newest), list(at), list(rest), first))

    def _expiry(self, record: tuple[int, str]) -> int:
        return (record[0] + self.keep) // 1000 + 1

    def _rows(self, records: dict, changes: list[str]) -> pd.DataFrame:
        at, rest = zip(*records.values())
        return pd.DataFrame({self.key.name: list(records), "micros": at, "packed": rest, "change": changes})

    def close(self) -> None:
        pass
