"""Archive scan: compressed run archives to rows of lines, a few lines in memory at a time."""

from __future__ import annotations

import heapq
import io
import lzma
import math
import os
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import LOG_LINES
from .csvfiles import spooled

#: Lines of a batch, and bytes of it, whichever comes first.
BATCH_LINES, BATCH_BYTES = 5000, 4 << 20
#: Bytes of a CSV record at most: a longer one, as a stray quote makes, is a fault of its file.
RECORD_BYTES = 16 << 20
#: Compressed bytes of archives that a task scans, and archives that are packed together: a bound of what one task holds of their sizes.
TASK_BYTES, PACKED_TOGETHER = 32 << 20, 200_000

_NAMES = ("id", "ord", "name", "line_no", "line", "is_last", "error", "fault", "last_text")
_KINDS = (pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.binary(), pa.bool_(), pa.string(), pa.string(), pa.int64())
#: Endings of CSV members, whose records may run over lines.
CSV_ENDINGS = (".csv", ".sadf", ".time")


class TooLong(ValueError):
    """A CSV record of more than ``RECORD_BYTES``; ``args`` hold the number of the record."""


def _is_text(line: bytes) -> bool:
    if line.isascii():
        return True
    try:
        line.decode()
    except UnicodeDecodeError:
        return False
    return True


def _records(member: Iterator[bytes]) -> Iterator[bytes]:
    """The lines of a CSV member, those that a quoted cell runs over as one.

    Whether a quote is open is carried from line to line, so each byte is looked at once.
    """
    held: list[bytes] = []
    size, open_, n = 0, False, 0
    for line in member:
        open_ ^= line.count(b'"') % 2 == 1
        if not held and not open_:
            yield line
            n += 1
            continue
        held.append(line)
        size += len(line)
        if size > RECORD_BYTES:
            raise TooLong(n)
        if not open_:
            yield b"".join(held)
            n += 1
            held, size = [], 0
    if held:
        yield b"".join(held)


class _Rows:
    """Columns of lines that are gathered into batches."""

    def __init__(self):
        self.columns: list[list] = [[] for _ in _NAMES]
        self.held = 0

    def add(self, *row) -> None:
        for column, value in zip(self.columns, row):
            column.append(value)
        self.held += len(row[4] or b"")

    def full(self) -> bool:
        return len(self.columns[0]) >= BATCH_LINES or self.held >= BATCH_BYTES

    def taken(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(self.columns, _KINDS, strict=True)], names=list(_NAMES))
        self.__init__()
        return out


def _members(rows: _Rows, id_: int, file, wanted: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """Batches of the lines of an open archive; only members whose name has a wanted ending are read.

    A member's last row tells what is wrong with all of it, if anything, and which line is the last that isn't blank.
    """
    with lzma.open(file) as plain, tarfile.open(fileobj=plain, mode="r|") as archive:
        ord_ = 0
        for member in archive:
            if not member.isfile():
                continue
            name = member.name
            if not wanted or name.endswith(wanted):
                last, n, fault, text = None, 0, None, None
                content = archive.extractfile(member)
                try:
                    for line in _records(content) if name.endswith(CSV_ENDINGS) else content:
                        if last is not None:
                            rows.add(id_, ord_, name, n, last, False, None, None, None)
                            n += 1
                            if rows.full():
                                yield rows.taken()
                        last = line.removesuffix(b"\n")
                        if fault is None and not _is_text(last):
                            fault = f"invalid UTF-8 in line {n}"
                        if last.strip(b" "):
                            text = n
                except TooLong as long:
                    last, fault = None, fault or f"a record of more than {RECORD_BYTES} bytes from record {long.args[0]} on"
                rows.add(id_, ord_, name, n, last or b"", True, None, fault, text)
            ord_ += 1
        while plain.read(1 << 20):  # a stream that was cut off after the last member is found out here
            pass


def _scanned(open_: callable, wanted: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _Rows()
        for batch in batches:
            for id_, source in zip(batch["id"].to_pylist(), batch["source"], strict=True):
                try:
                    with open_(source.as_py()) as file:
                        yield from _members(rows, id_, file, wanted)
                except (OSError, EOFError, tarfile.TarError, lzma.LZMAError) as wrong:
                    rows.add(id_, None, None, None, None, None, f"cannot read archive: {type(wrong).__name__}", None, None)
        if rows.held or rows.columns[0]:
            yield rows.taken()

    return run


def _local(path: str) -> str:
    return path.removeprefix("file:")


def with_sizes(paths: DataFrame) -> DataFrame:
    """(id, path, size) of archives at ``paths`` (id, path), which executors can open; 0 for one that isn't there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = []
            for path in batch["path"].to_pylist():
                try:
                    sizes.append(os.path.getsize(_local(path)))
                except OSError:
                    sizes.append(0)
            yield batch.append_column("size", pa.array(sizes, pa.int64()))

    cores = paths.sparkSession.sparkContext.defaultParallelism
    return paths.select(F.col("id").cast("long").alias("id"), "path").repartition(cores, "id").mapInArrow(run, "id long, path string, size long")


def lightest_first(sizes: list[int], tasks: int) -> list[int]:
    """A task for each size: from the largest on, each goes to the task that has least so far; of equal tasks to the first."""
    heap = [(0, 0, t) for t in range(tasks)]
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=sizes.__getitem__, reverse=True):
        total, n, task = heap[0]
        out[i] = task
        heapq.heapreplace(heap, (total + sizes[i], n + 1, task))
    return out


def tasks_for(total: int, n: int, cores: int) -> int:
    """How many tasks scan ``n`` archives of ``total`` bytes: enough for their bytes and for all cores, but no empty one."""
    return max(1, min(n, max(cores, math.ceil(total / TASK_BYTES))))


def _dealt(key: str, name: str, first_and_after):
    """For ``applyInArrow`` over ``key``: each group's archives dealt by size over the numbers that ``first_and_after`` gives the group."""

    def run(rows: pa.Table) -> pa.Table:
        first, after = first_and_after(rows[key][0].as_py())
        rows = rows.sort_by([("size", "descending"), *((c, "ascending") for c in rows.column_names if c not in ("size", key))])
        return rows.append_column(name, pa.array([first + t for t in lightest_first(rows["size"].to_pylist(), after - first)], pa.int32()))

    return run


def packed(sized: DataFrame, tasks: int, n: int) -> DataFrame:
    """``sized`` (id, path, size) with a ``task`` for each of ``n`` archives, under ``tasks``.

    No more than ``PACKED_TOGETHER`` are looked at together. More archives are dealt at random into groups of that number; each
    group packs its own into bundles, of which there are as many in all, and the bundles are packed over the tasks: a task then
    has its share, a bundle's average and the largest archive at most. A very large archive so has a bundle, and a task, of its own.
    Where tasks are too many for that, each group packs its own archives over its share of the tasks.
    """
    groups = max(1, math.ceil(n / PACKED_TOGETHER))
    bundled = groups > 1 and tasks <= PACKED_TOGETHER // 8
    groups, bins = (groups, max(1, PACKED_TOGETHER // groups)) if bundled else (min(groups, tasks), 0)
    grouped = sized.select("id", "path", "size", F.pmod(F.xxhash64("id", "path"), F.lit(groups)).cast("int").alias("group")).groupBy("group")
    if not bundled:
        share = lambda group: (group * tasks // groups, (group + 1) * tasks // groups)
        return grouped.applyInArrow(_dealt("group", "task", share), "id long, path string, size long, group int, task int").drop("group")
    own = lambda group: (group * bins, (group + 1) * bins)
    bundles = spooled(grouped.applyInArrow(_dealt("group", "bundle", own), "id long, path string, size long, group int, bundle int").drop("group"))
    sizes = bundles.groupBy("bundle").agg(F.sum("size").alias("size")).withColumn("all", F.lit(0))
    tasks_of = sizes.groupBy("all").applyInArrow(_dealt("all", "task", lambda _: (0, tasks)), "bundle int, size long, all int, task int")
    return bundles.join(tasks_of.select("bundle", "task"), "bundle").drop("bundle")


def scan_archives(paths: DataFrame, wanted: tuple[str, ...] = (), tasks: int | None = None) -> DataFrame:
    """Lines of all archives at ``paths`` (id, path, perhaps size), which executors can open.

    Archives are dealt to tasks by their sizes; as many tasks as ``tasks`` says, or as the bytes and the cores ask for.
    Partitions stand for tasks one by one, so adaptive execution doesn't merge them, few bytes as their rows are. An archive that is missing
    or broken gives one row with an error after whatever lines came before; ``withhold`` removes the latter. Each
    task streams its archives one after another.
    """
    sized = paths if "size" in paths.columns else with_sizes(paths)
    found = sized.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("total")).first()
    tasks = tasks or tasks_for(found["total"], found["n"], paths.sparkSession.sparkContext.defaultParallelism)
    dealt = packed(sized, tasks, found["n"]).repartitionById(tasks, "task").select("id", F.col("path").alias("source"))
    return dealt.mapInArrow(_scanned(lambda path: open(_local(path), "rb"), wanted), LOG_LINES)


def scan_stored(archives: DataFrame, wanted: tuple[str, ...] = ()) -> DataFrame:
    """Lines of archives given as (id, content): for stores that only Spark's readers open."""
    return archives.select("id", F.col("content").alias("source")).mapInArrow(_scanned(io.BytesIO, wanted), LOG_LINES)


def as_text(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lines as text, and the files (id, ord, name) that hold invalid UTF-8, whose lines are left out."""
    read = lines.filter("error is null").withColumn("text", F.expr("try_validate_utf8(cast(line as string))"))
    bad = read.filter("text is null").select("id", "ord", "name").distinct()
    return read.join(bad, ["id", "ord", "name"], "left_anti").withColumn("line", F.col("text")).drop("text"), bad
