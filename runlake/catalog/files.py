"""Queries of archives, file names, bytes and the lake."""

from __future__ import annotations

import functools
import itertools
import lzma
import os
import tarfile
import uuid

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import selection as S
from ..plans import collect, sink
from ..session import shared_folder
from ..sources import archives, manifest
from ..sources.csvfiles import spooled
from ..sources.routing import route_files
from .registry import events, lines, query, table
from .selections import runs


#: Events of one archive at most.
PACKED = 20_000
#: Bytes of archives that are handed on together.
_TOGETHER = 4 << 20


#: How the archives are compressed: with a small window, since setting up a large one takes longer than a small archive itself.
_XZ = [{"id": lzma.FILTER_LZMA2, "preset": 0, "dict_size": 1 << 16}]


@functools.lru_cache(maxsize=4096)
def _header(name: str, size: int) -> bytes:
    """A member's header; small archives have many alike."""
    member = tarfile.TarInfo(name)
    member.size = size
    return member.tobuf(tarfile.GNU_FORMAT)


def _archive(members: dict[str, list[str]]) -> bytes:
    """An archive with a member of each name and lines: headers and contents in whole blocks, and two empty blocks at the end."""
    out = []
    for name, texts in members.items():
        data = "".join(f"{t}\n" for t in texts).encode()
        out += [_header(name, len(data)), data, bytes(-len(data) % tarfile.BLOCKSIZE)]
    return lzma.compress(b"".join([*out, bytes(2 * tarfile.BLOCKSIZE)]), filters=_XZ)


def _gathered(rows: DataFrame, *keys: str) -> DataFrame:
    """A row for each archive, with its ``events`` by number: archives reach Python by the batch, not each as a group of its own."""
    values = F.struct("event_id", *(c for c in rows.columns if c not in (*keys, "event_id")))
    return rows.groupBy(*keys).agg(F.array_sort(F.collect_list(values)).alias("events"))


def _parts(rows: DataFrame) -> DataFrame:
    """Rows with their archive's number in the run, ``part``: 0, but for runs of more than ``PACKED`` events, which are cut by ranges of numbers."""
    many = rows.groupBy("id").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > PACKED).select("id", F.lit(True).alias("__many"))
    return rows.join(many, "id", "left").withColumn("part", F.when(F.col("__many"), F.expr(f"event_id div {PACKED}")).otherwise(0)).drop("__many")


def _packed(batches):
    """For ``mapInArrow``: archives of gathered events, a member for each kind of event, a line for each event; cut off in the middle for each tenth run."""
    schema = pa.schema([("id", pa.int64()), ("content", pa.binary())])
    ids, contents, held = [], [], 0
    for batch in batches:
        for id_, events in zip(batch["id"].to_pylist(), batch["events"], strict=True):
            members: dict[str, list[str]] = {}
            for e in sorted(events.as_py(), key=lambda e: e["event_type"]):
                members.setdefault(f"{e['event_type']}.log", []).append(e["text"])
            content = _archive(members)
            ids.append(id_)
            contents.append(content[: len(content) // 2] if id_ % 10 == 0 else content)
            held += len(contents[-1])
            if held >= _TOGETHER:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(contents, pa.binary())], schema=schema)
                ids, contents, held = [], [], 0
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(contents, pa.binary())], schema=schema)


@query("archive_scan", """
SELECT user_id AS id, event_type || '.log' AS name, event_id || ' ' || event_type AS line, NULL AS error FROM events WHERE user_id % 10 <> 0
UNION ALL SELECT DISTINCT user_id, NULL, NULL, 'cannot read archive' FROM events WHERE user_id % 10 = 0""")
def archive_scan(spark: SparkSession, d: str) -> DataFrame:
    """Events packed as archives of a bounded size and scanned again; those of every tenth run are cut off in the middle."""
    rows = table(spark, d, "events").select(F.col("user_id").alias("id"), "event_id", "event_type", F.concat_ws(" ", "event_id", "event_type").alias("text"))
    packed = _gathered(_parts(rows), "id", "part").mapInArrow(_packed, "id long, content binary")
    scanned = spooled(archives.scan_stored(packed))  # lines and failures are told apart after one scan
    failed = scanned.filter("error is not null").select("id").distinct()
    read = scanned.filter("error is null").join(failed, "id", "left_anti").select("id", "name", F.col("line").cast("string").alias("line"), "error")
    return read.unionByName(failed.select("id", F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("line"), F.lit("cannot read archive").alias("error")))


def _stored(folder: str):
    """For ``mapInArrow``: packs gathered log lines as archives of their runs in ``folder``; a second attempt puts the same files there."""

    def run(batches):
        own = f"{folder}/parts-{uuid.uuid4().hex}"  # tasks that make files in one folder wait for one another
        os.makedirs(own)
        for batch in batches:
            texts = batch["events"].flatten().field("line").to_pylist()
            ends = list(itertools.accumulate(pc.list_value_length(batch["events"]).to_pylist()))
            for id_, first, end in zip(batch["id"].to_pylist(), [0, *ends], ends):
                with open(f"{own}/part", "wb") as file:
                    file.write(_archive({"gc.javalog": texts[first:end], "status.txt": ["success"]}))
                os.replace(f"{own}/part", f"{folder}/{id_:016X}.tar.xz")
            yield batch.select(["id"])
        os.rmdir(own)

    return run


@query("collect_lake", """
SELECT user_id AS id, event_id AS gc_number, event_id % 16 AS num_workers, 'o' AS age, NULL AS status FROM events
UNION ALL SELECT DISTINCT user_id * 1048576 + event_id // 20000, NULL, NULL, NULL, 'success' FROM events""")
def collect_lake(spark: SparkSession, d: str) -> DataFrame:
    """The whole job: events packed as archives of runs in the shared folder, collected into a lake, and two of its tables read."""
    base = shared_folder(spark, "collected")
    line = F.concat(F.lit("[gc,task ] GC("), "event_id", F.lit(") Using "), F.col("event_id") % 16, F.lit(" Workers for Old Generation"))
    rows = table(spark, d, "events").select(F.expr(f"user_id * 1048576 + event_id div {PACKED}").alias("id"), "event_id", line.alias("line"))
    ids = _gathered(rows, "id").mapInArrow(_stored(f"{base.removeprefix('file:')}/runs"), "id long")
    ids.write.parquet(f"{base}/ids")
    runs_ = spark.read.schema("id long").parquet(f"{base}/ids").select("id", F.lit("mark_abuse").alias("benchmark"), F.lit("t").alias("tar_file"), F.lit(1).cast("bigint").alias("iteration"), F.lit("ZGC").alias("gc"))
    collect.collect(spark, manifest.Task(base, {"all": {"gc": ["ZGC"]}}, tuple(t for t in collect.COLLECTOR if t not in ("zgc_task_workers", "status"))), runs_, f"{base}/lake")
    read = lambda name: spark.read.parquet(f"{base}/lake/{name}")
    workers = read("zgc_task_workers").select(F.expr("cast(id as bigint) div 1048576").alias("id"), F.col("gc_number").cast("bigint").alias("gc_number"), F.col("num_workers").cast("bigint").alias("num_workers"), "age", F.lit(None).cast("string").alias("status"))
    return workers.unionByName(read("status").select(F.col("id").cast("bigint").alias("id"), *(F.lit(None).cast(k).alias(n) for n, k in (("gc_number", "bigint"), ("num_workers", "bigint"), ("age", "string"))), "status"))


#: Tasks of the query that follows.
_TASKS = 12


@query("archive_packing", f"SELECT count(*) AS archives, CAST(sum(CAST(l_partkey * l_quantity AS BIGINT)) AS BIGINT) AS bytes, {_TASKS}::BIGINT AS tasks, TRUE AS balanced FROM lineitem")
def archive_packing(spark: SparkSession, d: str) -> DataFrame:
    """Archives of uneven sizes dealt to tasks: all of them, and no task has more than its share and the largest archive, but for what groups differ by."""
    rows = table(spark, d, "lineitem").select(F.expr("l_orderkey * 8 + l_linenumber").alias("id"), F.lit("").alias("path"), F.expr("cast(l_partkey * l_quantity as bigint)").alias("size"))
    tasks = archives.packed(rows, _TASKS, rows.count()).groupBy("task").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"), F.max("size").alias("largest"))
    fair = F.sum("size") / _TASKS * 1.05 + F.max("largest")
    return tasks.agg(F.sum("n").alias("archives"), F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("tasks"), (F.max("size") <= fair).alias("balanced"))


@query("utf8_decode", """
SELECT user_id AS id, event_id AS line_no, event_type || ' é' AS line, NULL AS bad FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_id % 97 = 0)
UNION ALL SELECT DISTINCT user_id, NULL::BIGINT, NULL, 'os.javalog' FROM events WHERE event_id % 97 = 0""")
def utf8_decode(spark: SparkSession, d: str) -> DataFrame:
    """Bytes of lines, some of which aren't UTF-8: their files give no lines."""
    text = "concat(encode(event_type || ' é', 'utf-8'), if(event_id % 97 = 0, unhex('FF'), unhex('')))"
    raw = lines(events(spark, d), text, "'os.javalog'").withColumn("error", F.lit(None).cast("string"))
    rows, bad = archives.as_text(raw)
    told = bad.select("id", F.lit(None).cast("bigint").alias("line_no"), F.lit(None).cast("string").alias("line"), F.col("name").alias("bad"))
    return rows.select("id", "line_no", "line", F.lit(None).cast("string").alias("bad")).unionByName(told)


_NAMES = ("gc.javalog", "jvm0.txt", "jvm0.stdout", "runner12.exit", "dacapo-latency-usec-simple-b-3.csv", "mark_abuse7.csv", "disk/io.sadf", "run.raw", "x-Controller.log", "./gc.javalog", "other.bin")
_FEEDS = {
    "gc.javalog": ["zgc_phases", "zgc_gc_summary", "zgc_stats", "zgc_task_workers", "g1_phases"],
    "jvm0.txt": ["zgc_phases", "zgc_gc_summary", "zgc_stats", "zgc_task_workers", "g1_phases", "java_threads", "os_log", "dacapo_iteration"],
    "jvm0.stdout": ["dacapo_iteration"],
    "runner12.exit": ["runner_exit:12"],
    "dacapo-latency-usec-simple-b-3.csv": ["dacapo_latency:simple-b/3"],
    "mark_abuse7.csv": ["mark_abuse:7"],
    "disk/io.sadf": ["sadf:disk/io"],
    "run.raw": ["specjbb_summary"],
    "x-Controller.log": ["specjbb_profile"],
}


@query("file_routing", "SELECT o_orderkey AS id, unnest(CASE o_custkey % 11 " + " ".join(f"WHEN {_NAMES.index(n)} THEN {f}" for n, f in _FEEDS.items()) + " ELSE [] END) AS feeds FROM orders")
def file_routing(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.element_at(F.array(*map(F.lit, _NAMES)), (F.col("o_custkey") % 11 + 1).cast("int")).alias("name"))
    captured = F.concat_ws("/", "runner", "latency_type", "iteration", "process", "stem")
    return route_files(rows).select("id", F.concat("table", F.when(captured != "", F.concat(F.lit(":"), captured)).otherwise("")).alias("feeds"))


def _lake_task(base: str) -> manifest.Task:
    return manifest.Task(base, {"fast": {"benchmark": ["dacapo_samples2"]}, "slow": {"timeout": [3]}}, ("secret",))


_COLLECTED = "(SELECT *, unnest(['fast', 'slow']) AS collection FROM orders) WHERE (collection = 'fast' AND o_orderstatus = 'F') OR (collection = 'slow' AND o_custkey % 7 = 3)"


def _prices(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer"), F.col("o_totalprice").alias("price"))


@query("sink_roundtrip", f"SELECT collection, o_orderkey AS id, o_custkey AS customer, o_totalprice AS price FROM {_COLLECTED}")
def sink_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Orders written to a lake of two collections, over an older one, and read again."""
    base = shared_folder(spark, "lake")
    rows, task = _prices(spark, d), _lake_task(base)
    selected = S.select_runs(runs(spark, d), task)
    sink.write_tables({"prices": rows.withColumn("price", F.lit(0.0))}, selected, base)
    sink.reset_collections(spark, base, sorted(task.collect))
    sink.write_tables({"prices": rows, "secret": rows}, selected, base, task.drop_tables, narrow=True)
    return spark.read.parquet(f"{base}/prices").select("collection", F.col("id").cast("bigint").alias("id"), F.col("customer").cast("bigint").alias("customer"), "price")


@query("drop_tables", f"SELECT 'prices' AS table_name, collection, count(*) AS n FROM {_COLLECTED} GROUP BY collection")
def drop_tables(spark: SparkSession, d: str) -> DataFrame:
    """The tables that a lake holds after two were to be written, one of which the task drops."""
    base = shared_folder(spark, "lake")
    rows, task = _prices(spark, d), _lake_task(base)
    sink.write_tables({"prices": rows, "secret": rows}, S.select_runs(runs(spark, d), task), base, task.drop_tables)
    there = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(base).select("path")
    place = [F.regexp_extract("path", r"/([^/]+)/collection=([^/]+)/", i) for i in (1, 2)]
    n = spark.read.parquet(f"{base}/*").groupBy(F.col("collection")).agg(F.count(F.lit(1)).alias("n"))
    return there.select(place[0].alias("table_name"), place[1].alias("collection")).distinct().join(n, "collection").select("table_name", "collection", "n")


#: Bytes in memory of a file of the query that follows.
_SMALL_FILE = 400_000


def _footers(batches):
    for batch in batches:
        rows = []
        for content in batch["content"]:
            meta = pq.ParquetFile(pa.BufferReader(content.as_buffer())).metadata
            groups = [meta.row_group(k) for k in range(meta.num_row_groups)]
            columns = [g.column(i) for g in groups for i in range(meta.num_columns)]
            rows.append((meta.num_rows, max((g.num_rows for g in groups), default=0), all(c.compression == "ZSTD" for c in columns), all(c.is_stats_set for c in columns)))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.bool_(), pa.bool_()))], names=["n", "most", "zstd", "stats"])


@query("sink_options", f"SELECT count(*) AS n, TRUE AS zstd, TRUE AS has_statistics, TRUE AS groups_bounded, TRUE AS files_bounded, TRUE AS rolled_over FROM {_COLLECTED}")
def sink_options(spark: SparkSession, d: str) -> DataFrame:
    """What a lake's files tell, whose rows have 10 to 10,000 bytes: compression, statistics, rows of groups, that no file exceeds its bytes, and that files roll over."""
    base = shared_folder(spark, "lake")
    prices = _prices(spark, d).withColumn("note", F.when(F.col("id") % 50 == 0, F.repeat(F.lit("n"), (F.col("customer") % 10_000).cast("int"))))
    rows = S.fan_out(prices, S.select_runs(runs(spark, d), _lake_task(base)))
    sink.write_table(rows, "prices", base, narrow=True, file_bytes=_SMALL_FILE)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(f"{base}/prices").select("content")
    found = files.mapInArrow(_footers, "n long, most long, zstd boolean, stats boolean")
    written = spark.read.parquet(f"{base}/prices")
    sizes = written.groupBy("collection", F.col("_metadata.file_path").alias("file")).agg(F.sum(sink.width(rows)).alias("bytes"))
    # all files but each collection's last are more than half full
    full = sizes.agg(F.max("bytes").alias("largest"), F.count_if(F.col("bytes") < _SMALL_FILE / 2).alias("small"), F.count_distinct("collection").alias("collections"))
    told = found.agg(F.sum("n").alias("n"), F.bool_and("zstd").alias("zstd"), F.bool_and("stats").alias("has_statistics"), (F.max("most") <= sink.GROUP_ROWS).alias("groups_bounded"))
    both = told.join(F.broadcast(full))  # a row each
    return both.select("n", "zstd", "has_statistics", "groups_bounded", (F.col("largest") <= _SMALL_FILE).alias("files_bounded"), (F.col("small") <= F.col("collections")).alias("rolled_over"))


@query("task_read", """
SELECT o_orderkey AS id, concat_ws(',', CASE WHEN o_custkey % 7 = (SELECT max(o_custkey % 7) FROM orders) THEN 'late' END, CASE WHEN o_orderstatus = (SELECT min(o_orderstatus) FROM orders) THEN 'first' END) AS collections, 'secret' AS dropped
FROM orders WHERE o_custkey % 7 = (SELECT max(o_custkey % 7) FROM orders) OR o_orderstatus = (SELECT min(o_orderstatus) FROM orders)""")
def task_read(spark: SparkSession, d: str) -> DataFrame:
    """A task file whose filters come from the runs, written, read again and applied."""
    path = shared_folder(spark, "task")
    first = F.min_by("benchmark", F.when(F.col("benchmark") == "dacapo_samples2", 0).when(F.col("benchmark") == "specjbb", 1).otherwise(2))  # by the order's status
    filters = runs(spark, d).agg(F.max("timeout").alias("timeout"), first.alias("benchmark"))
    made = F.struct(F.lit(path).alias("location"), F.struct(F.struct(F.array("timeout").alias("timeout")).alias("late"), F.struct(F.array("benchmark").alias("benchmark")).alias("first")).alias("collect"), F.array(F.lit("secret")).alias("drop_tables"))
    filters.select(F.to_json(made)).coalesce(1).write.text(path)
    task = manifest.load_task(spark, path)
    return S.select_runs(runs(spark, d), task).select("id", F.concat_ws(",", F.sort_array("collections", asc=False)).alias("collections"), F.lit(",".join(task.drop_tables)).alias("dropped"))
