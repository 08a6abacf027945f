"""Lines of log files as a data source: in batches by byte ranges, and as a stream that follows files while they grow."""

from __future__ import annotations

import io
import json
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyarrow import fs as files
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

NAME = "casemill_lines"
SCHEMA = "file string, at long, line_no long, raw string"
#: Bytes of a split of a file, rows of an Arrow batch, and the step in which a file's end is searched for a line's end.
SPLIT, ROWS, STEP = 2**25, 2**13, 2**16
#: Small splits are dealt to about this many tasks, of SPLIT bytes at most, however many they are.
TASKS = 64


@dataclass
class LineRange(InputPartition):
    """The lines of ``file`` that start at ``low`` or later and before ``high``, the first with the number ``first_line``."""

    file: str
    low: int
    high: int
    first_line: int | None = None


@dataclass
class LineRanges(InputPartition):
    """The splits that one task reads, one after the other."""

    parts: list[LineRange]


def file_system(path: str) -> tuple[files.FileSystem, str]:
    """The file system of a path or URI and the path in it."""
    if "://" in path and not path.startswith("file:"):
        return files.FileSystem.from_uri(path)
    return files.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")


def log_files(path: str) -> dict[str, int]:
    """Every file at a path, which may be a file or a folder at any depth, with its size. Hidden and unfinished files don't count."""
    system, inside = file_system(path)
    info = system.get_file_info(inside)
    if info.type == files.FileType.File:
        return {inside: info.size}
    if info.type == files.FileType.NotFound:
        return {}
    found = system.get_file_info(files.FileSelector(inside, recursive=True))
    own = lambda f: f.path[len(inside) :].strip("/").split("/")
    return {f.path: f.size for f in found if f.type == files.FileType.File and not any(p[:1] in "._" for p in own(f))}


def kind_files(root: str, kind: str) -> dict[str, int]:
    """Files of one kind of log, in both places it may be in: ``<root>/<run>/<kind>.jsonl`` and ``<root>/<kind>/run_id=<run>/``."""
    system, inside = file_system(root)
    found = log_files(f"{root}/{kind}")
    for run in system.get_file_info(files.FileSelector(inside, allow_not_found=True)):
        if run.type == files.FileType.Directory and run.base_name != kind:
            found |= log_files(f"{root}/{run.base_name}/{kind}.jsonl")
    return found


def _read_lines(system: files.FileSystem, part: LineRange) -> Iterator[tuple[int, bytes]]:
    with system.open_input_file(part.file) as raw:
        start = max(0, part.low - 1)
        raw.seek(start)
        lines = io.BufferedReader(raw, 2**20)
        at = start + len(lines.readline()) if part.low else 0  # up to the end of the line that began before
        while at < part.high:
            line = lines.readline()
            if not line:
                break
            yield at, line
            at += len(line)


def _batches(root: str, parts: list[LineRange]) -> Iterator[pa.RecordBatch]:
    system, _ = file_system(root)
    names = ["file", "at", "line_no", "raw"]
    rows: list[tuple[str, int, int | None, str]] = []

    def batch() -> pa.RecordBatch:
        file, at, number, raw = zip(*rows)
        columns = [pa.array(file, pa.string()), pa.array(at, pa.int64()), pa.array(number, pa.int64()), pa.array(raw, pa.string())]
        return pa.RecordBatch.from_arrays(columns, names)

    for part in parts:
        for n, (at, line) in enumerate(_read_lines(system, part) if part.file else ()):
            number = None if part.first_line is None else part.first_line + n
            rows.append((part.file, at, number, line.rstrip(b"\r\n").decode("utf-8", "replace")))
            if len(rows) == ROWS:
                yield batch()
                rows.clear()
    if rows:
        yield batch()


def _ranges(file: str, low: int, high: int, split: int) -> list[LineRange]:
    return [LineRange(file, at, min(high, at + split)) for at in range(low, high, split)]


def _dealt(parts: list[LineRange], split: int) -> list[LineRanges]:
    """The splits, in order, as the tasks that read them."""
    size = max(split, min(SPLIT, sum(p.high - p.low for p in parts) // TASKS))
    tasks, held = [LineRanges([])], 0
    for part in parts:
        if held and held + part.high - part.low > size:
            tasks.append(LineRanges([]))
            held = 0
        tasks[-1].parts.append(part)
        held += part.high - part.low
    return tasks


class LineReader(DataSourceReader):
    """Batch read. ``numbers``: the number of every split's first line, as ``line_numbers`` counts them."""

    def __init__(self, options: dict):
        self.path, self.split = options["path"], int(options.get("split", SPLIT))
        self.numbers = json.loads(options.get("numbers", "null"))

    def partitions(self) -> list[LineRanges]:
        parts = [r for file, size in sorted(log_files(self.path).items()) for r in _ranges(file, 0, size, self.split)]
        for part in parts if self.numbers is not None else ():
            part.first_line = self.numbers[part.file][part.low // self.split]
        return _dealt(parts, self.split)

    def read(self, partition: LineRanges) -> Iterator[pa.RecordBatch]:
        return _batches(self.path, partition.parts)


class LineStream(DataSourceStreamReader):
    """Streaming read. The offset says up to which byte every file was read, always the start of a line.

    A batch ends at the last line that is whole when it is planned: a torn line waits for the next one. Offsets alone
    say what a batch holds, so a batch that is run again holds the same lines. A file that shrank was not appended to,
    which stops the stream.
    """

    def __init__(self, options: dict):
        self.root, self.kind, self.split = options["path"], options["kind"], int(options.get("split", SPLIT))
        self.known: dict[str, tuple[int, int]] = {}

    def initialOffset(self) -> dict:
        return {}

    def _whole(self, file: str, size: int) -> int:
        """The end of the last whole line, looked for from the end of the file."""
        seen, whole = self.known.get(file, (0, 0))
        if size == seen:
            return whole
        system, _ = file_system(self.root)
        with system.open_input_file(file) as raw:
            high = size
            while high > whole:
                low = max(whole, high - STEP)
                at = raw.read_at(high - low, low).rfind(b"\n")
                if at >= 0:
                    whole = low + at + 1
                    break
                high = low
        self.known[file] = (size, whole)
        return whole

    def latestOffset(self) -> dict:
        ends = {file: self._whole(file, size) for file, size in kind_files(self.root, self.kind).items()}
        return {file: end for file, end in sorted(ends.items()) if end}

    def partitions(self, start: dict, end: dict) -> list[LineRange]:
        parts = []
        for file, high in end.items():
            low = start.get(file, 0)
            if high < low:
                raise ValueError(f"log file shrank from {low} to {high} bytes: {file}")
            parts += _ranges(file, low, high, self.split)
        return parts or [LineRange("", 0, 0)]

    def read(self, partition: LineRange) -> Iterator[pa.RecordBatch]:
        return _batches(self.root, [partition])


class LineSource(DataSource):
    """Rows (file, at, line_no, raw): a line without its end, the byte it starts at and, where asked for, its number."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LineReader:
        return LineReader(self.options)

    def streamReader(self, schema) -> LineStream:
        return LineStream(self.options)


def read_lines(spark: SparkSession, path: str, split: int = SPLIT, numbers: dict[str, list[int]] | None = None) -> DataFrame:
    """(file, at, line_no, raw) of every line of the files at ``path``; a missing path is an empty table."""
    spark.dataSource.register(LineSource)
    return spark.read.format(NAME).options(split=split, numbers=json.dumps(numbers)).load(path)


def line_numbers(spark: SparkSession, path: str, split: int = SPLIT) -> dict[str, list[int]]:
    """The 1-based number of the first line of every split, by file.

    Tasks count the lines that start in their split; one number a split reaches the driver, which holds the list of
    splits anyway.
    """
    part = F.floor(F.col("at") / split).cast("int").alias("part")
    counts = read_lines(spark, path, split).groupBy("file", part).agg(F.count("*").alias("n")).collect()
    found = {file: [0] * -(-size // split) for file, size in log_files(path).items()}
    for row in counts:
        found[row["file"]][row["part"]] = row["n"]
    return {file: list(accumulate(ns[:-1], initial=1)) for file, ns in found.items()}


def stream_lines(spark: SparkSession, root: str, kind: str, split: int = SPLIT) -> DataFrame:
    """A stream of the lines of one kind of log, whole ones as they are appended, of known and of new files."""
    spark.dataSource.register(LineSource)
    return spark.readStream.format(NAME).options(kind=kind, split=split).load(root).drop("line_no")
