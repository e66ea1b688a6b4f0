"""The store as a table that a stream keeps up to date: the latest row of each key, forgotten once it has lived its time."""

from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from chunklake.functions.fields import is_live
from chunklake.functions.options import check_ttl
from chunklake.operators.store import latest_per_key
from chunklake.schemas import STORE, STORE_FIELDS

#: State with a time to live needs this provider. What a micro-batch changes is kept in its checkpoint, not the files it changes.
_STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
#: Parts of the state are opened, committed and kept by themselves in every micro-batch: there are no more than tasks can use.
_PARTITIONS, _PARTS, _PARTS_A_CORE = "spark.sql.shuffle.partitions", 32, 3
_FLAT = "key string, value string, expire_at bigint, run bigint, source string, major bigint, minor bigint"
_UPDATE = Row(*[part.split()[0] for part in _FLAT.split(", ")])
_STATE = "value string, expire_at bigint, run bigint, source string, major bigint, minor bigint"

#: Keys are dealt to so many lots, each of which is one key of the state; a checkpoint keeps the number it began with.
LOTS = 1 << 12
#: Rows of a lot go to and from its state as pickled dicts, `{key: (order, value, expire_at)}`.
_PACKED = "lot int, rows binary"
_PACKED_ARROW = pa.schema([("lot", pa.int32()), ("rows", pa.binary())])
_FLAT_ARROW = pa.schema([(part.split()[0], pa.string() if part.endswith("string") else pa.int64()) for part in _FLAT.split(", ")])
#: Bytes of rows that are packed at once, and rows that are unpacked at once.
_PACK_BYTES, _UNPACK_ROWS = 16 << 20, 10_000
#: So many entries of a lot's state are put together to one.
_ENTRIES = 8


class LatestRow(StatefulProcessor):
    """Of each key the row written last. One that expires is kept in state that is dropped after ``ttl_ms``, others for good."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.lasting = handle.getValueState("lasting", _STATE)
        self.mortal = handle.getValueState("mortal", _STATE, self.ttl_ms) if self.ttl_ms else self.lasting
        self.states = [self.lasting, self.mortal] if self.ttl_ms else [self.lasting]

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # every call on a state is a message to the JVM and back: one read of each, one write
        last = None
        for row in rows:
            fresh = tuple(row)[1:]
            if last is None or fresh[2:] >= last[2:]:
                last = fresh
        held = [(state, tuple(value)) for state in self.states if (value := state.get()) is not None]
        if held and max(value[2:] for _, value in held) > last[2:]:
            return
        kept = self.mortal if last[1] else self.lasting
        for state, _ in held:
            if state is not kept:
                state.clear()
        kept.update(last)
        yield _UPDATE(key[0], *last)

    def close(self) -> None:
        pass


class LatestRows(StatefulProcessor):
    """What `LatestRow` does, for all keys of a lot together: a few messages to the JVM for a lot, not for each of its keys.

    A lot's states are logs: a micro-batch adds an entry of its winning rows to the log of those that expire, with its time, and
    to that of those that last, where ``None`` stands for a key whose row there was followed by one that expires. Of a key in both
    logs the lasting row counts: it came later. A few entries become one, in which each row keeps the time it was added at.
    """

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.lasting = handle.getListState("lasting", "parts binary")
        self.mortal = handle.getListState("mortal", "parts binary", self.ttl_ms) if self.ttl_ms else None

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        fresh: dict = {}
        for packed in rows:
            for name, row in pickle.loads(packed.rows).items():
                if (last := fresh.get(name)) is None or row[0] >= last[0]:
                    fresh[name] = row
        lasting, mortal = _entries(self.lasting), _entries(self.mortal)
        # an entry of several parts lives on as a whole, its parts go by their own times
        mortal = [[(at, part) for at, part in entry if now < at + self.ttl_ms] for entry in mortal]
        stay, held = _last_rows(lasting), _last_rows(mortal)
        held |= {name: row for name, row in stay.items() if row is not None}
        won = {name: row for name, row in fresh.items() if (last := held.get(name)) is None or not last[0] > row[0]}
        if not won:
            return
        dying = {name: row for name, row in won.items() if row[2]} if self.ttl_ms else {}
        staying = {name: row for name, row in won.items() if name not in dying}
        staying |= {name: None for name in dying if stay.get(name) is not None}
        _add(self.lasting, lasting, 0, staying)
        _add(self.mortal, mortal, now, dying)
        yield Row("lot", "rows")(key[0], pickle.dumps(won))

    def close(self) -> None:
        pass


def _entries(state) -> list:
    return [pickle.loads(entry[0]) for entry in state.get()] if state else []


def _last_rows(entries: list) -> dict:
    return {key: row for entry in entries for _, part in entry for key, row in part.items()}


def _add(state, entries: list, now: int, rows: dict) -> None:
    """Adds an entry; of many, one is made that has the last row of each key only."""
    if not rows:
        return
    if len(entries) + 1 < _ENTRIES:
        state.appendValue((pickle.dumps([(now, rows)]),))
        return
    last = {key: (at, row) for entry in [*entries, [(now, rows)]] for at, part in entry for key, row in part.items()}
    parts: dict[int, dict] = {}
    for key, (at, row) in last.items():
        if row is not None:
            parts.setdefault(at, {})[key] = row
    if parts:
        state.put([(pickle.dumps([*parts.items()]),)])
    else:
        state.clear()


def _listed(column: pa.Array) -> list:
    """The values of a column; by numpy, which takes a fraction of the time, where none is missing."""
    return column.to_pylist() if column.null_count else column.to_numpy(zero_copy_only=False).tolist()


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each lot the latest rows in one value; several where a task has many rows."""
    lots: dict[int, dict] = defaultdict(dict)
    size = 0

    def packed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(lots, pa.int32()), pa.array(map(pickle.dumps, lots.values()), pa.binary())], schema=_PACKED_ARROW)

    for batch in batches:
        lot, key, value, expire_at, *order = map(_listed, batch.columns)
        rows = zip(zip(*order, strict=True), value, expire_at, strict=True)
        for number, name, row in zip(lot, key, rows, strict=True):
            latest = lots[number]
            last = latest.get(name)
            if last is None or row[0] >= last[0]:
                latest[name] = row
        size += batch.nbytes
        if size >= _PACK_BYTES:
            yield packed()
            lots, size = defaultdict(dict), 0
    if lots:
        yield packed()


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []

    def unpacked() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*rows, strict=True), _FLAT_ARROW, strict=True)], schema=_FLAT_ARROW)

    for batch in batches:
        for value in batch.column("rows"):
            rows += [(key, value, expire_at, *order) for key, (order, value, expire_at) in pickle.loads(value.as_py()).items()]
            if len(rows) >= _UNPACK_ROWS:
                yield unpacked()
                rows = []
    if rows:
        yield unpacked()


def latest_rows_stream(rows: DataFrame, ttl: int | str, lots: int = LOTS) -> DataFrame:
    """Updates of the table: for each micro-batch the new latest row of each key that has one.

    ``rows`` are store rows with the ``ttl`` they were made with. A key's row is compared with what came before it, in order
    of writing; what has lived ``ttl`` seconds by the clock of the machines is forgotten. Keys share their state by ``lots``: a
    micro-batch reads that of each lot it has a row of, and what a lot costs is shared by its rows. With 0 lots each key has a
    state of its own, for few rows at a time in a table of many.
    """
    flat = rows.select("key", "value", "expire_at", "write_seq.*")
    ttl_ms = check_ttl(ttl) * 1000
    if lots:
        dealt = flat.select(F.pmod(F.xxhash64("key"), F.lit(lots)).cast("int").alias("lot"), "*")
        # a file is often one task's; put together where each lot's rows are
        packed = dealt.repartition("lot").mapInArrow(_pack, _PACKED)
        won = packed.groupBy("lot").transformWithState(LatestRows(ttl_ms), _PACKED, "Update", "ProcessingTime")
        updates = won.mapInArrow(_unpack, _FLAT)
    else:
        updates = flat.groupBy("key").transformWithState(LatestRow(ttl_ms), _FLAT, "Update", "ProcessingTime")
    return updates.select("key", "value", "expire_at", F.struct("run", "source", "major", "minor").alias("write_seq"))


def write_table_stream(updates: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keeps the updates, a folder for each micro-batch, replaced where one is tried again. Runs until it is stopped.

    The state has as many parts as the session's shuffles, but 32 or three a core at most, by those there are when it begins.
    """

    def put(batch: DataFrame, batch_id: int) -> None:
        batch.select(*STORE_FIELDS).write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")

    writer = updates.writeStream.foreachBatch(put).outputMode("update").option("checkpointLocation", checkpoint)
    spark = updates.sparkSession
    parts = min(int(spark.conf.get(_PARTITIONS)), max(_PARTS, _PARTS_A_CORE * spark.sparkContext.defaultParallelism))
    settings = {**_STATE_SETTINGS, _PARTITIONS: str(parts)}
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():  # a query keeps the settings it was started with
            spark.conf.set(name, value)
        return writer.trigger(processingTime="0 seconds").start()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def read_table(spark, path: str, now: int) -> DataFrame:
    """The live rows of the table as of ``now``."""
    updates = spark.read.schema(STORE).option("recursiveFileLookup", "true").parquet(path)
    return latest_per_key(updates).where(is_live("expire_at", now)).select(*STORE_FIELDS)
