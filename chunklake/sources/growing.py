"""A stream of lines from files that grow while they are read.

A streaming source of its own: an offset is the number of bytes taken of each file, always up to a line feed, so what is being
written is taken once it ends in one. A batch's bytes are cut into ranges that tasks read apart, as splits of a large file are:
a range holds the lines that begin in it. Ranges of small files are put together, so that tasks grow in number with the bytes
and not with the files. Offsets stand in the query's checkpoint, so no line is lost or seen twice when the
query starts anew. Folders' end markers, which Spark's own readers pass over, come as rows: they are listed before the files
are measured, so that all lines written before a marker are in the marker's batch or an earlier one.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from fnmatch import fnmatch

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from chunklake.functions.fields import END_MARKER_NAME, SIDECAR_SUFFIX
from chunklake.sources.files import located

_SCHEMA = "source string, position bigint, line string, marker boolean"
#: Bytes of a range, and bytes read at once to find the last line feed of a file.
RANGE_BYTES, _LOOK_BACK = 32 << 20, 1 << 16
#: What opening a file counts for, in bytes, where small ranges are put together to one task's.
_OPEN_COST = 1 << 16


@dataclass
class ByteRange:
    """The lines of a file that begin from ``begin`` on and before ``end``; ``whole`` if a line begins right there."""

    path: str
    begin: int
    end: int
    stop: int
    whole: bool


@dataclass
class Marker:
    path: str


@dataclass
class Pack(InputPartition):
    """What one task reads: a range of a large file, or those of many small files, and end markers."""

    parts: list[ByteRange | Marker]


def _packed(parts: list[ByteRange | Marker], most: int, tasks: int) -> list[InputPartition]:
    """Parts in their order, so many together that ``tasks`` have some and none has more than ``most`` bytes of several."""
    costs = [_OPEN_COST + (part.end - part.begin if isinstance(part, ByteRange) else 0) for part in parts]
    bound = min(most, max(sum(costs) // max(tasks, 1), _OPEN_COST))
    packs: list[Pack] = []
    room = 0
    for part, cost in zip(parts, costs, strict=True):
        if cost > room:
            packs.append(Pack([]))
            room = bound
        packs[-1].parts.append(part)
        room -= cost
    return packs


class GrowingLines(DataSource):
    """Options: ``path``, ``glob`` of file names, ``rangeBytes``, ``tasks`` that small files are dealt to at least."""

    @classmethod
    def name(cls) -> str:
        return "growing_lines"

    def schema(self) -> str:
        return _SCHEMA

    def streamReader(self, schema) -> GrowingReader:
        range_bytes, tasks = int(self.options.get("rangebytes", RANGE_BYTES)), int(self.options.get("tasks", 1))
        return GrowingReader(self.options["path"], self.options.get("glob", "*"), range_bytes, tasks)


class GrowingReader(DataSourceStreamReader):
    def __init__(self, path: str, glob: str, range_bytes: int, tasks: int = 1):
        self.path, self.glob, self.range_bytes, self.tasks = path, glob, range_bytes, tasks
        self._measured: dict[str, tuple[int, int]] = {}  # of each file its size when it was looked into, and what was found

    def _files(self) -> tuple[fs.FileSystem, list[fs.FileInfo]]:
        system, root = located(self.path)
        return system, system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))

    def initialOffset(self) -> dict:
        return {"files": {}, "markers": []}

    def latestOffset(self) -> dict:
        system, found = self._files()
        markers = sorted(f.path for f in found if f.base_name == END_MARKER_NAME)
        # listed anew: what was written before a marker was seen is measured after it
        _, found = self._files()
        asked = [f for f in found if f.is_file and fnmatch(f.base_name, self.glob)]
        # files only grow, so those of the size they had end where they did
        grown = [f for f in asked if self._measured.get(f.path, (-1, 0))[0] != f.size]
        with ThreadPoolExecutor(16) as pool:
            ends = pool.map(lambda f: self._whole_lines(system, f), grown)
            self._measured |= {f.path: (f.size, end) for f, end in zip(grown, ends, strict=True)}
        files = {f.path: self._measured[f.path][1] for f in asked}
        return {"files": {path: size for path, size in sorted(files.items()) if size}, "markers": markers}

    @staticmethod
    def _whole_lines(system: fs.FileSystem, info: fs.FileInfo) -> int:
        """The bytes of a file up to its last line feed."""
        with system.open_input_file(info.path) as file:
            end = file.size()
            while end > 0:
                begin = max(end - _LOOK_BACK, 0)
                file.seek(begin)
                feed = file.read(end - begin).rfind(b"\n")
                if feed >= 0:
                    return begin + feed + 1
                end = begin
        return 0

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        ranges: list[ByteRange | Marker] = []
        for path, stop in end["files"].items():
            begin = first = start["files"].get(path, 0)
            while begin < stop:
                upto = min(begin + self.range_bytes, stop)
                ranges.append(ByteRange(path, begin, upto, stop, begin == first))
                begin = upto
        known = set(start["markers"])
        markers = [Marker(path) for path in end["markers"] if path not in known]
        return _packed(ranges + markers, self.range_bytes, self.tasks)

    def commit(self, end: dict) -> None:
        """Files are left where they are."""

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        system, _ = located(self.path)
        for part in partition.parts:
            yield from self._read(system, part)

    @staticmethod
    def _read(system: fs.FileSystem, partition: ByteRange | Marker) -> Iterator[pa.RecordBatch]:
        if isinstance(partition, Marker):
            yield _rows(partition.path, [None], [None], True)
            return
        with system.open_input_file(partition.path) as file:
            # from the byte before, so that a line that begins at the border is seen to begin there
            at = partition.begin - (not partition.whole)
            file.seek(at)
            head, position, skipping = b"", partition.begin, not partition.whole
            while at < partition.stop:
                block = file.read(min(_LOOK_BACK * 16, partition.stop - at))
                at += len(block)
                if skipping:
                    feed = block.find(b"\n")
                    if feed < 0:
                        continue
                    block, skipping = block[feed + 1 :], False
                    position = at - len(block)
                lines = (head + block).split(b"\n")
                head = lines.pop()
                positions = []
                for n, line in enumerate(lines):
                    if position >= partition.end:
                        lines = lines[:n]
                        break
                    positions.append(position)
                    position += len(line) + 1
                if lines:
                    yield _rows(partition.path, positions, [line.decode(errors="replace") for line in lines], False)
                if position >= partition.end:
                    return


def _rows(path: str, positions: list, lines: list, marker: bool) -> pa.RecordBatch:
    columns = [pa.array([path] * len(lines), pa.string()), pa.array(positions, pa.int64()), pa.array(lines, pa.string()), pa.array([marker] * len(lines))]
    return pa.RecordBatch.from_arrays(columns, ["source", "position", "line", "marker"])


def read_growing_lines(spark: SparkSession, path: str, glob: str = "*", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``source``, ``position`` (the byte a line begins at), ``line`` and ``marker`` of every line as it comes, and of every end marker.

    ``path`` is a folder on a file system that pyarrow reads, the same for the driver and all executors.
    """
    spark.dataSource.register(GrowingLines)
    reader = spark.readStream.format("growing_lines").option("glob", glob).option("rangeBytes", str(range_bytes))
    return reader.option("tasks", str(spark.sparkContext.defaultParallelism)).option("path", path).load()


def read_growing_sidecars(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Sidecar lines of growing ``{session}.meta.jsonl`` files, shaped like those of `read_sidecar_stream`, with ``folder_mark``.

    A line's number is the byte it begins at. Arrival is the time its batch was first tried.
    """
    rows = read_growing_lines(spark, path, f"*{SIDECAR_SUFFIX}", range_bytes)
    name, folder = F.substring_index("source", "/", -1), F.regexp_extract("source", "^(.*)/", 1)
    lines = rows.select(
        folder.alias("folder"),
        F.when(~F.col("marker"), F.substr(name, F.lit(1), F.length(name) - F.lit(len(SIDECAR_SUFFIX)))).alias("session_id"),
        F.lit(0).cast("bigint").alias("block"),
        "source",
        F.unix_millis(F.current_timestamp()).alias("arrival_ms"),
        F.col("position").alias("line_id"),
        "line",
        F.when(F.col("marker"), folder).alias("folder_mark"),
    )
    return lines.where("folder_mark IS NOT NULL OR line <> ''")
