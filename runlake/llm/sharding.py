"""Sharding by size-tiered compaction under a versioned manifest.

Arrivals are appended as small immutable shards. Shards of like size form a tier; when a tier has enough
of them they are merged into files of the target size, whole shards to a task, without a shuffle. A version is a
short list of segments, each of which lists some shards; a change writes only the segments that it touches
and publishes the next version in a way that fails if another writer has it already. So a reader sees one version
whole, a writer that comes second tries again on top of the first, and a job that dies leaves only files that no
version names. Merged shards stay for the readers of earlier versions until ``vacuum`` gives those versions up.
"""

from __future__ import annotations

import json
import math
import uuid
from collections import Counter

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_dir

#: Bytes of a finished shard, shards of like size that make a merge, and the ratio between tiers.
TARGET, FANOUT, RATIO = 64 << 20, 4, 4.0
#: Shards that one merge job reads at most (more of a tier make further jobs), and those of one segment.
JOB_SHARDS, SEGMENT_SHARDS = 2000, 10_000
#: Times that a writer tries to publish on top of others.
TRIES = 50
#: Arrivals that the registered query appends.
ARRIVALS = 4
#: File systems whose rename onto an existing file fails; on others a file is created on condition that it isn't there.
RENAMING = ("hdfs", "viewfs", "file")

Shard = dict[str, str | int]


class Conflict(Exception):
    """Another writer has published this version."""


def tier(size: int) -> int:
    return int(math.log(max(size, 1), RATIO))


def finished(shard: Shard, target: int) -> bool:
    """Whether a shard is near enough to the target to be left alone."""
    return 2 * int(shard["bytes"]) > target


class Shards:
    """A set of shards under ``root``, which must be a folder that all executors share.

    The driver holds the segments' names and the shards of those segments that a change touches. Reading a whole
    version needs the path of every shard on the driver, as any table of files does in Spark.
    """

    def __init__(self, spark: SparkSession, root: str, target: int = TARGET):
        self.spark, self.root, self.target = spark, root.rstrip("/"), target
        self._jvm = spark.sparkContext._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(self.root).getFileSystem(self._conf)

    def _version_file(self, version: int):
        return self._path(f"{self.root}/manifest/{version:010d}.json")

    def _get(self, path) -> str:
        stream = self._fs.open(path)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _put(self, path, text: str) -> None:
        out = self._fs.create(path, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def version(self) -> int:
        """The latest committed version; 0 before the first."""
        folder = self._path(f"{self.root}/manifest")
        if not self._fs.exists(folder):
            return 0
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return max((int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith(".")), default=0)

    def segments(self, version: int) -> list[dict]:
        """A version's segments: name, number of shards, and how many of them wait in each tier."""
        return json.loads(self._get(self._version_file(version)))["segments"] if version else []

    def _listed(self, segment: dict) -> list[Shard]:
        return [json.loads(line) for line in self._get(self._path(f"{self.root}/segments/{segment['name']}")).splitlines()]

    def shards(self, version: int | None = None) -> list[Shard]:
        """The shards of a version by path: path and bytes of each."""
        version = self.version() if version is None else version
        return sorted((s for segment in self.segments(version) for s in self._listed(segment)), key=lambda s: s["path"])

    def _segmented(self, shards: list[Shard]) -> list[dict]:
        """Write segments that list these shards; finished ones apart, for their segments never change again."""
        out = []
        for done in (True, False):
            own = sorted((s for s in shards if finished(s, self.target) == done), key=lambda s: s["path"])
            for at in range(0, len(own), SEGMENT_SHARDS):
                part = own[at : at + SEGMENT_SHARDS]
                name = f"{uuid.uuid4().hex}.jsonl"
                self._put(self._path(f"{self.root}/segments/{name}"), "\n".join(map(json.dumps, part)))
                out.append({"name": name, "n": len(part), "tiers": {} if done else dict(Counter(str(tier(s["bytes"])) for s in part))})
        return out

    def _publish(self, after: int, segments: list[dict]) -> int:
        """Make version ``after`` + 1 of these segments; ``Conflict`` if another writer has that version."""
        text, to = json.dumps({"version": after + 1, "segments": segments}), self._version_file(after + 1)
        try:
            if self._fs.getUri().getScheme() not in RENAMING:
                self._put(to, text)
                return after + 1
            draft = self._path(f"{self.root}/manifest/.draft-{uuid.uuid4().hex}")
            self._put(draft, text)
            context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(self.root).toUri(), self._conf)
            context.rename(draft, to, self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Py4JJavaError as wrong:
            if "FileAlreadyExistsException" in str(wrong.java_exception) or self._fs.exists(to):
                raise Conflict(f"version {after + 1} is there already") from wrong
            raise
        return after + 1

    def _written(self, df: DataFrame) -> list[Shard]:
        """New shards of these rows. Their folder's name starts with the version it was made for, so paths sort by age."""
        folder = f"{self.root}/data/{self.version() + 1:010d}-{uuid.uuid4().hex}"
        df.write.parquet(folder)
        return [{"path": s.getPath().toString(), "bytes": s.getLen()} for s in self._fs.listStatus(self._path(folder)) if s.getPath().getName().endswith(".parquet")]

    def _change(self, gone: list[Shard], new: list[Shard]) -> int | None:
        """Publish a version without ``gone`` and with ``new``, on top of whatever is there; None if some of ``gone`` aren't."""
        added, paths = self._segmented(new), {s["path"] for s in gone}
        tiers = {str(tier(s["bytes"])) for s in gone}
        for _ in range(TRIES):
            version = self.version()
            kept, found = [], 0
            for segment in self.segments(version):
                own = self._listed(segment) if tiers & segment["tiers"].keys() and found < len(paths) else []
                left = [s for s in own if s["path"] not in paths]
                found += len(own) - len(left)
                kept += self._segmented(left) if len(left) < len(own) else [segment]
            if found < len(paths):
                return None
            try:
                return self._publish(version, kept + added)
            except Conflict:
                continue
        raise Conflict(f"{TRIES} tries to publish have failed")

    def append(self, df: DataFrame) -> int:
        """Add the rows of ``df`` as new small shards."""
        return self._change([], self._written(df))

    def due(self, segments: list[dict], but: set[int] = frozenset()) -> list[Shard]:
        """The oldest shards, JOB_SHARDS at most, of the lowest tier that has enough; ``but`` names tiers to pass over."""
        waiting = Counter()
        for segment in segments:
            waiting.update({int(t): n for t, n in segment["tiers"].items()})
        full = [t for t, n in sorted(waiting.items()) if n >= FANOUT and t not in but]
        if not full:
            return []
        own = [s for segment in segments if str(full[0]) in segment["tiers"] for s in self._listed(segment) if tier(s["bytes"]) == full[0]]
        return sorted(own, key=lambda s: s["path"])[:JOB_SHARDS]

    def compact(self) -> int:
        """Merge tiers until none has enough shards; returns the version reached."""
        stuck: set[int] = set()
        while own := self.due(self.segments(self.version()), stuck):
            files = max(1, math.ceil(sum(s["bytes"] for s in own) / self.target))
            merged = self._written(self.spark.read.parquet(*(s["path"] for s in own)).coalesce(files))
            if self._change(own, merged) is None:  # another writer has merged some of these
                for s in merged:
                    self._fs.delete(self._path(s["path"]), False)
            elif len(merged) >= len(own):
                stuck.add(tier(own[0]["bytes"]))  # Spark's reader cut the files finer than the merge could join them
        return self.version()

    def vacuum(self, keep: int = 1) -> int:
        """Give up all but the last ``keep`` versions, and delete the shards that only those name; returns their number.

        Files that no version names are left alone: another writer may be about to commit them.
        """
        last = self.version()
        first = last - max(keep, 1) + 1
        given_up = [v for v in range(1, first) if self._fs.exists(self._version_file(v))]
        old = {s["name"]: s for v in given_up for s in self.segments(v)}
        kept = {s["name"]: s for v in range(max(1, first), last + 1) for s in self.segments(v)}
        gone = {s["path"] for name in old.keys() - kept.keys() for s in self._listed(old[name])}
        for segment in kept.values() if gone else ():  # a segment that changed leaves its other shards to a new one
            gone.difference_update(s["path"] for s in self._listed(segment))
        for path in sorted(gone):
            self._fs.delete(self._path(path), False)
        for v in given_up:  # after the shards, so that a vacuum that dies can be done again
            self._fs.delete(self._version_file(v), False)
        for name in sorted(old.keys() - kept.keys()):
            self._fs.delete(self._path(f"{self.root}/segments/{name}"), False)
        return len(gone)

    def read(self, version: int | None = None) -> DataFrame | None:
        """The rows of a version with the path of each one's shard in the column ``shard``; None before the first append."""
        shards = self.shards(version)
        if not shards:
            return None
        return self.spark.read.parquet(*(s["path"] for s in shards)).withColumn("shard", F.col("_metadata.file_path"))


def shard_documents(docs: DataFrame, arrivals: int = ARRIVALS, target: int = TARGET) -> DataFrame:
    """Append ``docs`` in arrivals, compact after each, and read the last version: a row per row of ``docs``.

    Columns: doc_id, text_sha256 (of the text's UTF-8 as read back, null for a null text), arrival, shard
    (version:part, the change that wrote the shard and its number there), shard_rows, version. The same table gives
    the same shards. Whatever other columns the rows have are stored with them. Repeated rows are stored again; null
    ids are an arrival like any other; an empty table gives an empty one.
    """
    store = Shards(docs.sparkSession, shared_dir(docs.sparkSession, "shards"), target)
    arrival = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(arrivals)).cast("int")
    for k in range(arrivals):
        store.append(docs.filter(arrival == k))
        version = store.compact()
    store.vacuum()
    shard = F.concat_ws(":", *(F.regexp_extract("shard", r"/0*([0-9]+)-[0-9a-f]+/part-0*([0-9]+)[^/]*$", i) for i in (1, 2)))
    rows = store.read(version).select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(F.col("text").cast("string"), 256).alias("text_sha256"), arrival.alias("arrival"), shard.alias("shard"))
    sizes = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("shard_rows"))  # a row for each file of about the target size
    return rows.join(sizes, "shard").select("doc_id", "text_sha256", "arrival", "shard", "shard_rows", F.lit(version).alias("version"))
