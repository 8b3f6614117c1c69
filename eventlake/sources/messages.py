"""Arrival files as a stream of single messages, with pulls of at most n of them.

The text file source counts files: its smallest pull is a file. Here an offset
is the number of bytes taken from every file (as a log has an offset for every
partition), so a micro-batch ends after any message, and a run with
``availableNow`` is one pull of at most ``max_messages``. The engine's
checkpoint holds the offsets; a failed pull is replayed with the same messages.

The driver's source process looks for the line ends of a pull (its messages
and no more); the messages themselves are read by the tasks, a range of a file
each. Files are listed and read through ``pyarrow.fs``: local and mounted
paths, HDFS, object stores. A file must not change once it is there, but may
grow by whole lines. For pulls of many files use ``maxFilesPerTrigger``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

NAME = "arrival_messages"
STEP = 1 << 20  # bytes looked at or read at once
RANGE = 64 << 20  # bytes of one file that a task reads, about
POSITION = "position.json"


class _Range(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri.removeprefix("file:"))


def _after_lines(stream, start: int, size: int, budget: int) -> tuple[int, int, list[int]]:
    """The byte after at most ``budget`` lines from ``start``, the lines up to there, and line ends to cut ranges at."""
    at, lines, cuts, next_cut = start, 0, [], start + RANGE
    end = start
    while at < size and lines < budget:
        block = stream.read_at(min(STEP, size - at), at)
        found = block.find(b"\n")
        while found >= 0 and lines < budget:
            lines, end = lines + 1, at + found + 1
            if end >= next_cut:
                cuts.append(end)
                next_cut = end + RANGE
            found = block.find(b"\n", found + 1)
        at += len(block)
    if lines < budget and end < size:  # a last line without an end
        lines, end = lines + 1, size
    return end, lines, [c for c in cuts if c < end]


class MessageReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.folder, self.limit = options["path"], int(options.get("max_messages", 10))
        self.keeps = options["position"].rstrip("/")
        self.position: dict | None = None

    def initialOffset(self) -> dict:
        return {}

    def _load(self) -> dict:
        # the end of the last pull that the engine planned; it replays that one itself where it did not end
        if self.position is None:
            system, path = _open(f"{self.keeps}/{POSITION}")
            try:
                with system.open_input_stream(path) as f:
                    self.position = json.loads(f.read())
            except FileNotFoundError:
                self.position = self.initialOffset()
        return self.position

    def _files(self) -> list[tuple[str, int]]:
        system, path = _open(self.folder)
        found = system.get_file_info(pafs.FileSelector(path, recursive=True))
        shown = [f for f in found if f.is_file and not any(p[:1] in ("_", ".") for p in f.path[len(path) :].strip("/").split("/"))]
        return [(f.path, f.size) for f in sorted(shown, key=lambda f: (f.mtime_ns or 0, f.path))]

    def latestOffset(self) -> dict:
        taken, budget = dict(self._load()), self.limit
        system, _ = _open(self.folder)
        for path, size in self._files():
            start = taken.get(path, 0)
            if not budget:
                break
            if size > start:
                with system.open_input_file(path) as stream:
                    end, lines, _ = _after_lines(stream, start, size, budget)
                taken[path], budget = end, budget - lines
        return taken

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        out = []
        system, _ = _open(self.folder)
        for path, stop in end.items():
            at = start.get(path, 0)
            if stop > at:
                cuts = []
                if stop - at > 2 * RANGE:
                    with system.open_input_file(path) as stream:
                        _, _, cuts = _after_lines(stream, at, stop, 1 << 62)
                edges = [at, *cuts, stop]
                out += [_Range(path, a, b) for a, b in zip(edges, edges[1:])]
        self.position = dict(end)
        system, path = _open(f"{self.keeps}/{POSITION}")
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        with system.open_output_stream(f"{path}.new") as f:
            f.write(json.dumps(self.position).encode())
        system.move(f"{path}.new", path)
        return out

    def read(self, partition: _Range) -> Iterator[tuple]:
        system, _ = _open(self.folder)
        with system.open_input_file(partition.path) as stream:
            at, rest = partition.start, b""
            while at < partition.end:
                block = stream.read_at(min(STEP, partition.end - at), at)
                at += len(block)
                *lines, rest = (rest + block).split(b"\n")
                for line in lines:
                    yield (line.removesuffix(b"\r"),)
            if rest:
                yield (rest.removesuffix(b"\r"),)

    def commit(self, end: dict) -> None:
        pass


class MessageSource(DataSource):
    """``format("arrival_messages")``: options ``path``, ``max_messages`` (10) and ``position`` (a folder of the stream)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "value binary"

    def streamReader(self, schema) -> MessageReader:
        return MessageReader(dict(self.options))


def stream_messages(spark: SparkSession, folder: str, max_messages: int, position: str) -> DataFrame:
    """Arrival folder as a stream (``value: binary``, a line each) whose micro-batches have at most ``max_messages``.

    ``position`` is a folder that belongs to the stream, like its checkpoint (not the checkpoint folder itself).
    """
    spark.dataSource.register(MessageSource)
    reader = spark.readStream.format(NAME).option("path", folder).option("max_messages", str(max_messages))
    return reader.option("position", position).load()
