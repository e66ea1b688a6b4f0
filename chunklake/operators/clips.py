"""Cutting sessions into clips, for sessions of any length.

Chunks are spread by ``(session, block)``, a block being a bounded run of consecutive lines, so a session that holds a
third of all rows fills many tasks. A session of one block is cut there and then. For the others, two things cross
block borders:

* continuity: the first chunk of a block is compared with the last chunk of the block before. Both come from a hash
  aggregate, without sorting (`_borders`);
* the start of the clip that is open at the border, where the two chunks are continuous. A block that begins or
  contains a break has the same exit whatever enters it, so it settles the block behind it (`_tails`). For a block that
  an unbroken run passes through, the start that leaves is a step function of the one that enters. Only starts less
  than one span before the block can enter, so the function has at most one step per distinct time of that first span
  (`_steps`). The functions of 64 blocks at a time are composed to one (`_compose`); following those, and then the
  blocks within, settles the rest (`_entries`).

With the entries known every block is cut on its own, and clips that cross a border are summed from their pieces. The
chunks are shuffled once: all passes over them read that one exchange, for which they ask for the same columns. Where
no session has a second block, the middle passes have no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunklake.functions.fields import CLIP_TYPE, clip_path, clip_ts, session_folder, session_key, session_name
from chunklake.functions.options import DEFAULT_CLIP_MS, check_span_ms
from chunklake.operators.cutting import LATEST, cut_points, highest_so_far, last_starts, runs_of
from chunklake.schemas import CLIP_FIELDS

#: Lines per block where the order is one integer column: what one task sorts and cuts as a unit.
BLOCK_LINES = 1 << 22

#: Blocks of a stretch whose step functions one task follows; longer stretches are followed part by part.
STRETCH_BLOCKS = 64

#: Sessions of no more blocks have their stretches followed by one task each: so many step functions fit it.
SHORT_BLOCKS = 256

_KEYS = ["session_id", "block"]
_NUMBERS = ["sequence", "offset", "length", "ts_ms"]


@dataclass(frozen=True)
class Order:
    """How lines of a session are ordered: by block, then by line.

    A block is a bounded run of lines, and the next block's number is greater by no less than the lines it holds. Both
    hold for the byte at which a line's input split begins, and for line numbers rounded down. Where all lines are known to
    lie in one block, or in a few (``most_blocks``), less is planned for what crosses blocks.
    """

    line: str = "line_id"
    block: str | None = "block"
    block_lines: int = BLOCK_LINES
    most_blocks: int | None = None

    def block_expr(self) -> str:
        if self.block is not None:
            return f"cast({self.block} AS bigint)"
        # the line numbers of a session differ, so a block of so many numbers holds no more lines than that
        return f"cast({self.line} AS bigint) - pmod(cast({self.line} AS bigint), {self.block_lines})"


def by_number(line: str = "line_no", block_lines: int = BLOCK_LINES) -> Order:
    """Sessions numbered line by line in one integer column."""
    return Order(line=line, block=None, block_lines=block_lines)


def order_of(rows: DataFrame, line: str = "line_no", block_lines: int = BLOCK_LINES) -> Order:
    """The order of sessions numbered in one integer column, after a look at its least and greatest number.

    The look reads that column only, of a table or of lines that are not parsed yet. No session has more blocks than the numbers
    lie in.
    """
    order = by_number(line, block_lines)
    ends = rows.selectExpr(f"{order.block_expr()} AS block").agg(F.min("block").alias("first"), F.max("block").alias("last")).first()
    return replace(order, most_blocks=1 if ends["first"] is None else (ends["last"] - ends["first"]) // block_lines + 1)


def _spread(chunks: DataFrame, order: Order, arrival_col: str | None = None) -> DataFrame:
    """The chunks, spread by session and block. A record without one of its numbers is no chunk.

    Where there is a ``folder`` it is part of the session's key.
    """
    if "folder" in chunks.columns:
        chunks = chunks.withColumn("session_id", F.when(F.col("session_id").isNotNull(), session_key("folder", "session_id")))
    numbers = [f"cast({name} AS bigint) AS {name}" for name in _NUMBERS]
    if arrival_col:
        numbers.append(f"cast({arrival_col} AS bigint) AS arrival")
    place = ["cast(session_id AS string) AS session_id", f"{order.block_expr()} AS block"]
    spread = chunks.selectExpr(*place, f"cast({order.line} AS bigint) AS line", *numbers).repartition(*_KEYS)
    # that the keys are there is said here, and not left to be inferred from some of the joins, so that the exchange is
    # the same for all of them
    return spread.where(" AND ".join(f"{name} IS NOT NULL" for name in spread.columns))


def _follows(last: str, sequence: str, offset: str) -> str:
    """Whether a chunk continues the last one. A sum beyond 64 bits equals no chunk's number."""
    return f"({sequence} <=> try_add({last}.sequence, 1L) AND {offset} <=> try_add({last}.offset, {last}.length))"


def _borders(spread: DataFrame, idle_ms: int | None) -> DataFrame:
    """Of sessions with several blocks, the blocks with a linked block before or any block behind.

    ``linked`` and ``next_linked`` say whether an unbroken run crosses the block's borders.
    """
    ends = ["min_by({0}, line) AS first_{0}", "max_by({0}, line) AS {0}"]
    named = ("sequence", "offset", "arrival") if idle_ms is not None else ("sequence", "offset")
    ends = [end.format(name) for name in named for end in ends] + ["max_by(length, line) AS length"]
    blocks = spread.groupBy(*_KEYS).agg(*map(F.expr, ends), F.max("ts_ms").alias("top"))
    names = [name for name in blocks.columns if name not in _KEYS]
    # as one struct, so that every reader of the borders asks for the same columns and finds the same exchange
    blocks = blocks.selectExpr(*_KEYS, f"struct({', '.join(names)}) AS here")
    session = "OVER (PARTITION BY session_id ORDER BY block)"
    blocks = blocks.selectExpr(
        *_KEYS,
        "here",
        f"lag(here) {session} AS before",
        f"lead(here) {session} AS after",
        f"lead(block) {session} AS next_block",
    )

    def link(last: str, first: str) -> str:
        pause = f" AND {first}.first_arrival - {last}.arrival < {idle_ms}" if idle_ms is not None else ""
        follows = _follows(last, f"{first}.first_sequence", f"{first}.first_offset")
        return f"{last} IS NOT NULL AND {first} IS NOT NULL AND {follows}{pause}"

    borders = blocks.selectExpr(
        *_KEYS,
        "next_block",
        "here.top AS top",
        f"coalesce({link('before', 'here')}, false) AS linked",
        f"coalesce({link('here', 'after')}, false) AS next_linked",
    )
    return borders.where("linked OR next_block IS NOT NULL")


def _emit(schema: pa.Schema, *columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


_TAILS_DDL = "session_id string, block bigint, last_run bigint, tail_time bigint, tail_start bigint"
_TAILS = pa.schema(
    [
        ("session_id", pa.string()),
        ("block", pa.int64()),
        ("last_run", pa.int64()),
        ("tail_time", pa.int64()),
        ("tail_start", pa.int64()),
    ]
)


def _summarize(clip_ms: int, idle_ms: int | None):
    """One row per block: its breaks, and its last run's highest time and last start.

    The start is the one reached if the last run begins afresh, which holds wherever it does not go back to the
    block before.
    """

    def summarize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict | None = None
        for runs in runs_of(batches, idle_ms):
            col, heads = runs.columns, runs.heads
            times = col["ts_ms"]
            anchors = times[heads]
            if runs.same_run:
                anchors[0] = held["tail_start"]
            ends = np.append(heads[1:], len(times))
            high = highest_so_far(np.maximum(times, np.repeat(anchors, ends - heads)), heads)
            cuts = cut_points(high, heads, anchors, clip_ms)
            starts = anchors.copy()
            starts[np.searchsorted(heads, cuts, side="right") - 1] = high[cuts]
            if runs.same_run:
                part = slice(0, ends[0])
                high[part] = np.maximum(high[part], held["tail_time"])
            firsts = runs.block_heads
            lasts = np.append(firsts[1:], len(times)) - 1
            tails = np.searchsorted(heads, lasts, side="right") - 1
            out = {
                "session_id": runs.batch.column("session_id").take(pa.array(firsts)),
                "block": col["block"][firsts],
                "last_run": runs.number[tails],
                "tail_time": high[lasts],
                "tail_start": starts[tails],
            }
            if held is not None and not runs.same_block:
                yield _emit(_TAILS, *[[held[name]] for name in _TAILS.names])
            held = {name: int(out[name][-1]) for name in _TAILS.names[1:]}
            held["session_id"] = out["session_id"][-1].as_py()
            if len(firsts) > 1:
                yield _emit(_TAILS, *[out[name][:-1] for name in _TAILS.names])
        if held is not None:
            yield _emit(_TAILS, *[[held[name]] for name in _TAILS.names])

    return summarize


def _ordered(rows: DataFrame) -> DataFrame:
    return rows.sortWithinPartitions(*_KEYS, "line").drop("line")


def _tails(spread: DataFrame, borders: DataFrame, clip_ms: int, idle_ms: int | None) -> DataFrame:
    """The last runs of the blocks that an unbroken run leaves."""
    rows = _at_blocks(spread, borders.where("next_linked").select(*_KEYS))
    tails = _ordered(rows).mapInArrow(_summarize(clip_ms, idle_ms), _TAILS_DDL)
    return tails.selectExpr(*_KEYS, "struct(last_run, tail_time, tail_start) AS tail")


def _at_blocks(spread: DataFrame, blocks: DataFrame, how: str = "inner") -> DataFrame:
    """The chunks with what is known of their blocks. The one row per block is hashed, so the chunks need no sort."""
    return spread.join(blocks.hint("shuffle_hash"), _KEYS, how)


def _blocks(borders: DataFrame, tails: DataFrame) -> DataFrame:
    """What enters and leaves each block.

    ``chain`` numbers stretches of blocks: one that is settled, and those behind it that its last run passes through.
    ``origin`` is the run's number that comes in: that of the block it began in, plus the breaks before it there.
    """
    session = "OVER (PARTITION BY session_id ORDER BY block)"
    chain = "OVER (PARTITION BY session_id, chain ORDER BY block)"
    blocks = borders.join(tails, _KEYS, "left")
    blocks = blocks.selectExpr("*", "coalesce(NOT linked OR tail.last_run > 0, true) AS settled")
    blocks = blocks.selectExpr(
        "*", f"sum(cast(settled AS bigint)) {session} AS chain", f"lag(tail) {session} AS tail_before"
    )
    blocks = blocks.selectExpr(
        "*",
        f"max(if(tail.last_run = 0, top, tail.tail_time)) {chain} AS exit_time",
        f"first_value(block + tail.last_run) {chain} AS exit_run",
        f"row_number() {chain} AS nth",
    )
    return blocks.selectExpr(
        *_KEYS,
        "next_block",
        "linked",
        "next_linked",
        "NOT settled AND next_linked AS passing",
        "chain",
        f"nth div {STRETCH_BLOCKS} AS part",
        f"if(linked AND lag(settled) {session}, tail_before.tail_start, null) AS entry",
        f"if(linked, lag(exit_time) {session}, null) AS entry_time",
        f"if(linked, lag(exit_run) {session}, null) AS origin",
    )


_STEPS_DDL = (
    "session_id string, chain bigint, part bigint, block bigint, next_block bigint, entry bigint, "
    "bounds array<bigint>, exits array<bigint>"
)
_STEPS = pa.schema(
    [
        ("session_id", pa.string()),
        ("chain", pa.int64()),
        ("part", pa.int64()),
        ("block", pa.int64()),
        ("next_block", pa.int64()),
        ("entry", pa.int64()),
        ("bounds", pa.list_(pa.int64())),
        ("exits", pa.list_(pa.int64())),
    ]
)
_STEP_PLACE = _STEPS.names[:-2]


def _steps(clip_ms: int):
    """Per block, as sorted bounds on ``entering start + clip_ms`` and exits: which start leaves it.

    Above the last bound the clip that enters also leaves. Rows must be sorted; of a block its distinct times count.
    """

    def settle(block: dict) -> pa.RecordBatch:
        times = np.concatenate(block["times"])
        starts = last_starts(times, clip_ms)
        reachable = np.searchsorted(times, min(block["entry_time"], LATEST - clip_ms) + clip_ms, side="left") + 1
        bounds, exits = times[:reachable], starts[:reachable]
        last_of_step = np.append(exits[1:] != exits[:-1], True)[: len(exits)]
        row = [[block[name]] for name in _STEP_PLACE]
        return _emit(_STEPS, *row, [bounds[last_of_step]], [exits[last_of_step]])

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict | None = None
        for runs in runs_of(batches, None):
            ends = np.append(runs.block_heads[1:], runs.batch.num_rows)
            for i, (a, b) in enumerate(zip(runs.block_heads.tolist(), ends.tolist(), strict=True)):
                if held is not None and not (i == 0 and runs.same_block):
                    yield settle(held)
                    held = None
                if held is None:
                    first = runs.batch.slice(a, 1).to_pylist()[0]
                    held = {name: first[name] for name in _STEP_PLACE}
                    held |= {"entry_time": first["entry_time"], "top": first["entry_time"], "times": []}
                high = np.maximum.accumulate(np.maximum(runs.columns["ts_ms"][a:b], held["top"]))
                held["times"].append(high[np.append(high[0] > held["top"], high[1:] > high[:-1])])
                held["top"] = int(high[-1])
        if held is not None:
            yield settle(held)

    return steps


def _through(starts: np.ndarray, bounds: np.ndarray, exits: np.ndarray, clip_ms: int) -> np.ndarray:
    """The starts that leave when these enter."""
    step = np.searchsorted(bounds, np.minimum(starts, LATEST - clip_ms) + clip_ms, side="left")
    inside = step < len(bounds)
    return np.where(inside, np.append(exits, 0)[np.where(inside, step, 0)], starts)


def _compose(clip_ms: int):
    """One row per part of a stretch: the step function of its blocks one after another, and what enters the first.

    Rows must be sorted; one is held. A part has no more steps than one span has distinct times from its first block on.
    """

    def settle(part: dict) -> pa.RecordBatch:
        bounds, exits = part["bounds"], part["exits"]
        last_of_step = np.append(exits[1:] != exits[:-1], True)[: len(exits)]
        return _emit(_STEPS, *[[part[name]] for name in _STEP_PLACE], [bounds[last_of_step]], [exits[last_of_step]])

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict | None = None
        for batch in batches:
            places = batch.select(_STEP_PLACE).to_pylist()
            columns = batch.column("bounds"), batch.column("exits")
            for i, place in enumerate(places):
                bounds, exits = (column[i].values.to_numpy() for column in columns)
                if held is not None and all(held[name] == place[name] for name in ("session_id", "chain", "part")):
                    # what none of the earlier blocks cuts comes to this one as it entered the first
                    beyond = bounds > held["bounds"][-1] if len(held["bounds"]) else np.ones(len(bounds), bool)
                    held["exits"] = np.append(_through(held["exits"], bounds, exits, clip_ms), exits[beyond])
                    held["bounds"] = np.append(held["bounds"], bounds[beyond])
                    continue
                if held is not None:
                    yield settle(held)
                held = place | {"bounds": bounds, "exits": exits}
        if held is not None:
            yield settle(held)

    return compose


_ENTERED_DDL = "session_id string, chain bigint, part bigint, entered bigint"
_ENTERED = pa.schema([("session_id", pa.string()), ("chain", pa.int64()), ("part", pa.int64()), ("entered", pa.int64())])
_PASSED_DDL = "session_id string, block bigint, passed bigint"
_PASSED = pa.schema([("session_id", pa.string()), ("block", pa.int64()), ("passed", pa.int64())])


def _follow(clip_ms: int, key: tuple[str, ...], entry: str, passes: bool, schema: pa.Schema):
    """Follows step functions one at a time, row by row of each ``key``, from the ``entry`` of its first row.

    Gives the start that leaves each row, as it ``passes`` on to the block behind, or the one that enters it.
    """

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stretch, start = None, 0
        for batch in batches:
            heres = list(zip(*(batch.column(name).to_pylist() for name in key), strict=True))
            entries = batch.column(entry).to_pylist()
            bounds, exits = batch.column("bounds"), batch.column("exits")
            found = []
            for i, here in enumerate(heres):
                if here != stretch:
                    stretch, start = here, entries[i]
                entered = start
                start = int(_through(np.array([start]), bounds[i].values.to_numpy(), exits[i].values.to_numpy(), clip_ms)[0])
                found.append(start if passes else entered)
            names = ("session_id", "next_block") if passes else (*key, "part")
            yield _emit(schema, *[batch.column(name) for name in names], found)

    return follow


def _entries(spread: DataFrame, blocks: DataFrame, clip_ms: int, short: bool = False) -> DataFrame:
    """``(session_id, block, passed)``: the start that enters a block behind one that a run passes through.

    Step functions are composed part by part, the parts of a stretch followed, and then the blocks within each part. Only
    the parts of a stretch, one row for 64 blocks, come to one task. Where no session has more than a few blocks, the blocks
    of a stretch are followed at once.
    """
    passing = blocks.where("passing").select(*_KEYS, "next_block", "chain", "part", "entry", "entry_time")
    stretch, part = ("session_id", "chain"), ["session_id", "chain", "part"]
    steps = _ordered(_at_blocks(spread, passing)).mapInArrow(_steps(clip_ms), _STEPS_DDL)
    if short:
        steps = steps.repartition(*stretch).sortWithinPartitions(*stretch, "block")
        return steps.mapInArrow(_follow(clip_ms, stretch, "entry", True, _PASSED), _PASSED_DDL)
    steps = steps.repartition(*part)
    parts = steps.sortWithinPartitions(*part, "block").mapInArrow(_compose(clip_ms), _STEPS_DDL)
    parts = parts.repartition(*stretch).sortWithinPartitions(*part)
    entered = parts.mapInArrow(_follow(clip_ms, stretch, "entry", False, _ENTERED), _ENTERED_DDL)
    within = steps.join(entered.hint("shuffle_hash"), part).sortWithinPartitions(*part, "block")
    return within.mapInArrow(_follow(clip_ms, (*stretch, "part"), "entered", True, _PASSED), _PASSED_DDL)


_PIECES_DDL = "session_id string, island bigint, start_ts_ms bigint, offset bigint, length bigint, complete boolean"
_PIECES = pa.schema(
    [
        ("session_id", pa.string()),
        ("island", pa.int64()),
        ("start_ts_ms", pa.int64()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
        ("complete", pa.bool_()),
    ]
)


def _pieces(session, island, start, offset, length, ending) -> pa.RecordBatch:
    ending = np.asarray(ending)
    return _emit(_PIECES, session, island, start, offset, length, pa.array(ending == 1, mask=ending == -1))


#: Stands for the origin of a block that no run enters.
_NO_RUN = -(1 << 63)


def _cut(clip_ms: int, idle_ms: int | None):
    """Cuts sorted chunks into the pieces of clips that lie in one block.

    The piece that ends a batch is held back, since the next batch may go on with it.
    """
    parts = ("session_id", "island", "start_ts_ms", "offset", "length")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict | None = None
        for runs in runs_of(batches, idle_ms):
            col, heads = runs.columns, runs.heads
            rows = runs.batch.num_rows
            entered = (runs.number == 0) & (col["origin"][heads] != _NO_RUN)
            times = col["ts_ms"]
            anchors = np.where(entered, col["entry"][heads], times[heads])
            if runs.same_run:
                anchors[0] = held["start_ts_ms"]
            sizes = np.diff(np.append(heads, rows))
            high = highest_so_far(np.maximum(times, np.repeat(anchors, sizes)), heads)
            cuts = cut_points(high, heads, anchors, clip_ms)
            firsts = np.union1d(heads, cuts)
            run = np.searchsorted(heads, firsts, side="right") - 1
            is_cut = np.isin(firsts, cuts, assume_unique=True)
            is_head = np.append(True, run[1:] != run[:-1])
            # 1 complete, 0 broken off, -1 goes on in the next block: a piece ends by a span if a cut follows it, by
            # a break if another run does, and as its block ends if none does
            block_ending = col["block_ending"][heads]
            ends_block = np.append(np.isin(heads[1:], runs.block_heads, assume_unique=True), True)
            ending = np.where(ends_block, block_ending, 0)[run]
            ending[:-1][is_cut[1:] & ~is_head[1:]] = 1
            session = runs.batch.column("session_id").take(pa.array(firsts))
            island = np.where(entered, col["origin"][heads], col["block"][heads] + runs.number)[run]
            start = np.where(is_cut, high[firsts], anchors[run])
            offset, length = col["offset"][firsts], np.add.reduceat(col["length"], firsts)

            closed = is_cut & is_head & entered[run]
            if held is not None:
                if runs.same_run and not is_cut[0]:
                    offset[0], length[0] = held["offset"], length[0] + held["length"]
                else:
                    last = 1 if runs.same_run else 0 if runs.same_block else held["block_ending"]
                    yield _pieces(*[[held[name]] for name in parts], [last])
                closed[0] &= not runs.same_run
            if closed.any():
                # clips that came in from the block before and end at its border
                size = int(closed.sum())
                behind = session.filter(pa.array(closed)), island[closed], anchors[run[closed]]
                yield _pieces(*behind, pa.nulls(size, pa.int64()), np.zeros(size, np.int64), np.ones(size, np.int64))
            held = dict(zip(parts[1:], (int(p[-1]) for p in (island, start, offset, length)), strict=True))
            held |= {"session_id": session[-1].as_py(), "block_ending": int(block_ending[-1])}
            if len(firsts) > 1:
                yield _pieces(session[:-1], island[:-1], start[:-1], offset[:-1], length[:-1], ending[:-1])
        if held is not None:
            yield _pieces(*[[held[name]] for name in parts], [held["block_ending"]])

    return cut


def cut_clips(
    chunks: DataFrame,
    src: str = "",
    clip_ms: int = DEFAULT_CLIP_MS,
    idle_ms: int | None = None,
    arrival_col: str | None = None,
    order: Order = Order(),
    keep_order: bool = False,
) -> DataFrame:
    """Clips of all sessions in ``chunks`` (data records with ``session_id`` and the columns of ``order``).

    A clip ends incomplete at a break in sequence or offset, and, with ``idle_ms`` and ``arrival_col`` (milliseconds),
    at a pause in arrival; it ends complete at the first chunk ``clip_ms`` or more after its start, and at the end of
    the session. ``keep_order`` adds ``island`` and ``start_ts_ms``, by which the clips of a session are in order.
    """
    clips = cut_by_key(chunks, clip_ms, idle_ms, arrival_col, order)
    return finish_clips(clips, src, keep_order)


def cut_by_key(
    chunks: DataFrame, clip_ms: int, idle_ms: int | None = None, arrival_col: str | None = None, order: Order = Order()
) -> DataFrame:
    """The same clips by the session's whole key: ``session_id``, ``island``, ``start_ts_ms``, ``offset``, ``length``, ``complete``."""
    check_span_ms("clip_ms", clip_ms)
    if (idle_ms is None) != (arrival_col is None):
        raise ValueError("idle_ms and arrival_col go together")
    if idle_ms is not None:
        check_span_ms("idle_ms", idle_ms)
    spread = _spread(chunks, order, arrival_col)
    if order.most_blocks == 1:
        alone = {"origin": F.lit(_NO_RUN).cast("bigint"), "entry": F.lit(0).cast("bigint"), "block_ending": F.lit(1).cast("bigint")}
        return _clips_of(spread.withColumns(alone), clip_ms, idle_ms)
    borders = _borders(spread, idle_ms)
    blocks = _blocks(borders, _tails(spread, borders, clip_ms, idle_ms))
    short = order.most_blocks is not None and order.most_blocks <= SHORT_BLOCKS
    facts = blocks.join(_entries(spread, blocks, clip_ms, short), _KEYS, "left").selectExpr(
        *_KEYS,
        "origin",
        "coalesce(entry, passed) AS entry",
        "CASE WHEN next_block IS NULL THEN 1L WHEN next_linked THEN -1L ELSE 0L END AS block_ending",
    )
    rows = _at_blocks(spread, facts, "left").na.fill({"origin": _NO_RUN, "entry": 0, "block_ending": 1})
    return _clips_of(rows, clip_ms, idle_ms)


def _clips_of(rows: DataFrame, clip_ms: int, idle_ms: int | None) -> DataFrame:
    """Clips of chunks that know what enters and ends their block."""
    pieces = _ordered(rows).mapInArrow(_cut(clip_ms, idle_ms), _PIECES_DDL)
    return pieces.groupBy("session_id", "island", "start_ts_ms").agg(
        F.min("offset").alias("offset"), F.sum("length").alias("length"), F.max("complete").alias("complete")
    )


def finish_clips(clips: DataFrame, src: str, keep_order: bool, keep_folder: bool = False) -> DataFrame:
    """The clip record of each cut, with its order and the session's folder if asked for."""
    if keep_folder:
        clips = clips.withColumn("folder", session_folder("session_id"))
    clips = clips.withColumn("session_id", session_name("session_id"))
    ts = clip_ts(F.col("start_ts_ms"))
    made = {"type": F.lit(CLIP_TYPE), "ts": ts, "path": clip_path(src, F.col("session_id"), ts)}
    fields = [made[name].alias(name) if name in made else name for name in CLIP_FIELDS]
    return clips.select(*fields, *(["island", "start_ts_ms"] if keep_order else []), *(["folder"] if keep_folder else []))


def continuity_breaks(chunks: DataFrame, order: Order = Order()) -> DataFrame:
    """Every break: the chunk that caused it, and what sequence and offset were expected instead.

    Breaks inside a block come from the chunks, breaks between blocks from the two chunks at its ends.
    """
    numbers = ("line", "sequence", "offset", "length")
    spread = _spread(chunks, order).selectExpr(*_KEYS, *numbers)
    session = "PARTITION BY session_id, block ORDER BY line"
    before = [f"lag({name}) OVER ({session}) AS last_{name}" for name in numbers]
    inside = spread.selectExpr(*_KEYS, *numbers, *before)
    # number by number, for which Spark has hash aggregates, and none for structs
    ends = spread.groupBy(*_KEYS).agg(
        *[F.min_by(name, "line").alias(name) for name in numbers], *[F.max_by(name, "line").alias(f"end_{name}") for name in numbers]
    )
    before = [f"lag(end_{name}) OVER (PARTITION BY session_id ORDER BY block) AS last_{name}" for name in numbers]
    between = ends.selectExpr(*_KEYS, *numbers, *before)
    follows = "sequence <=> try_add(last_sequence, 1L) AND offset <=> try_add(last_offset, last_length)"
    return inside.unionByName(between).where(f"last_line IS NOT NULL AND NOT ({follows})").select(
        session_name("session_id").alias("session_id"),
        "block",
        "line",
        "sequence",
        F.expr("try_add(last_sequence, 1L)").alias("expected_sequence"),
        "offset",
        F.expr("try_add(last_offset, last_length)").alias("expected_offset"),
    )
