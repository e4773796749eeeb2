"""Archives packed by hand, collected into a lake, and read back."""

import io
import os
import tarfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from runlake.catalog import QUERIES, files
from runlake.operators.selection import config_table
from runlake.plans import extractors, sink
from runlake.plans.collect import WANTED, Corpus, Staging, collect
from runlake.plans.extractors import Extractor, register_extractor
from runlake.session import joined_by_rows
from runlake.operators.extract import Grammar, text
from runlake.sources import archives, csvfiles
from runlake.sources.manifest import Task, archive_path, parse_runs
from runlake.sources.routing import Rule

DATA = "/root/testdata/sf0.001"
ZGC = {
    "gc.javalog": "[2031-03-05T08:15:20.125-0400][info   ][gc          ] GC(2) Minor Collection (Timer) 640M(8%)->80M(1%) 0.125s\n[2031-03-05T08:15:20.125-0400][info][gc,phases   ] GC(2) y: Pause Mark End 0.75ms",
    "status.txt": "success\n",
    "runner1.exit": "0\n",
    "dacapo-latency-usec-metered-full-0.csv": "10,30,1\n20,25,2\n",
    "dacapo-latency-usec-metered-full-1.csv": "1,2,3\n",
    "cpu_all_cores.sadf": "# hostname;interval;timestamp;CPU;%user;%idle[...]\nh;1;2031-03-05 08:15:20 UTC;-1;5.5;9\nh;1;2031-03-05 08:15:20 UTC;0;6.5;9\n",
    "cpu_data.csv": "hostname,interval,timestamp,CPU,%user,%idle\nh,1,2031-03-05 08:15:20,0,7.5,9\n",
    "jvm0.time": "elapsed,cpu_percent\n12,97%\n",
    "own.txt": "mine=1\nmine=2\n",
    "threadstat-event.csv": "read_id,count,event_id\n1,5,2\n2,-1,2\n",
}


def pack(folder, id_, files, cut=None):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w:xz") as archive:
        for name, content in files.items():
            data = content if isinstance(content, bytes) else content.encode()
            member = tarfile.TarInfo(name)
            member.size = len(data)
            archive.addfile(member, io.BytesIO(data))
    (folder / "runs").mkdir(exist_ok=True)
    (folder / "runs" / f"{id_:016X}.tar.xz").write_bytes(out.getvalue()[:cut])


@pytest.fixture
def scans(spark, monkeypatch):
    """How many scans of the staged lines each staged table takes, and whether all of them prune by kind of file."""
    plans, put = {}, Staging.put

    def watched(self, df, name, by=None):
        found = [x for x in df._jdf.queryExecution().sparkPlan().toString().split("\n") if "FileScan" in x and "line:string" in x]
        plans[name] = len(found), all("PartitionFilters: [" in x and "arrays_overlap(split(file_kind" in x for x in found)
        return put(self, df, name, by)

    monkeypatch.setattr(Staging, "put", watched)
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    yield plans
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_from_archives_to_the_lake(spark, tmp_path, scans):
    pack(tmp_path, 1, ZGC)
    pack(tmp_path, 2, ZGC | {"gc.javalog": b"\xff\xfe broken", "status.txt": "failed"})
    pack(tmp_path, 3, ZGC, cut=-40)
    run = '{{"benchmark": "{}", "tar_file": "t", "iteration": 1, "gc": "{}"}}'
    runs = ", ".join(f'"{i}": {run.format(b, g)}' for i, b, g in ((1, "dacapo_samples2", "ZGC"), (2, "dacapo_samples2", "zgc"), (3, "dacapo_samples2", "zgc"), (4, "dacapo_samples2", "G1"), (5, "nope", "zgc"), (6, "specjbb", "G1")))
    runs = parse_runs(spark.createDataFrame([(f'{{"bench_index": 1.0, "benchmark_runs": {{{runs}}}}}',)], "value string"))
    register_extractor(Extractor("own", (Rule("own", r"^own\.txt$"),), Grammar("mine=", r"mine=(\d+)", {"mine": text}), endings=("own.txt",)))
    task = Task(str(tmp_path), {"all": {"benchmark": ["dacapo_samples2", "nope"]}, "z": {"gc": ["ZGC"]}}, ("threadstat_event",))
    lake = f"{tmp_path}/lake"
    stale = spark.createDataFrame([("old", 99, "z"), ("other", 98, "kept")], "message string, id long, collection string")
    stale.write.partitionBy("collection").parquet(f"{lake}/parse_status")
    written = collect(spark, task, runs, lake, narrow=False)
    read = lambda t: spark.read.parquet(f"{lake}/{t}")
    assert "threadstat_event" not in written and not (tmp_path / "lake" / "threadstat_event").exists() and not [p for p in (tmp_path / "lake").glob("_*") if any(p.rglob("*.parquet"))]
    assert sorted((r.id, r.collection, r.time_us) for r in read("zgc_gc_summary").collect()) == [(1, "all", 125000), (1, "z", 125000)]
    assert sorted((r.id, r.status) for r in read("status").filter("collection = 'all'").collect()) == [(1, "success"), (2, "failed")]
    assert sorted((r.duration_ns, r.iteration) for r in read("dacapo_latency_metered_full").filter("collection = 'z'").collect()) == [(1, 1), (5, 0), (20, 0)]
    assert [(r.CPU, r["%user"]) for r in read("cpu_all_cores_sadf").filter("collection = 'z'").collect()] == [(0, 6.5)]
    assert "hostname" not in read("cpu_sadf").columns and read("time").first().cpu_percent == 97
    assert read("own").filter("collection = 'z'").count() == 2
    told = {(r.id, r.message) for r in read("parse_status").filter("collection = 'all'").collect()}
    assert {r.id for r in read("parse_status").filter("collection = 'z'").collect()} <= {1, 2} and read("parse_status").filter("id = 98").count() == 1
    assert {(3, "cannot read archive: EOFError"), (4, "cannot read archive: FileNotFoundError"), (5, "no collectors for benchmark nope"), (2, "gc.javalog: invalid UTF-8 for zgc_phases: line 1")} <= told
    assert read("g1_phases").count() == 0 and "gc_type" in read("g1_phases").columns  # empty, not absent
    assert {r.id for r in read("config").collect()} == {1, 2}
    assert config_table(runs).columns[0] == "benchmark" and len(config_table(runs).columns) == 60
    captured = {n: p for n, p in scans.items() if n.startswith("captured/")}  # each table reads its own lines, once
    assert len(captured) > 12 and {n: p for n, p in captured.items() if p != (1, True)} == {}


HEAD = "# hostname;interval;timestamp;CPU;%user;%idle[...]\n"
BAD = {
    1: {"jvm0.time": "elapsed,cpu_percent\n12,97%\n13\n", "git_info.csv": "repository,commit\nours,abc\n"},
    2: {"jvm0.time": "elapsed,cpu_percent\r\n12,97%\r\n13,?\r\n", "git_info.csv": 'repository,note,note\nours,"a, b","two\nlines"\n'},
    3: {"disk.sadf": HEAD + "h;1;yesterday;0;1.5;9\n", "cpu_all_cores.sadf": HEAD + "h;1;2031-03-05 08:15:20 UTC;0;1.5;9\n"},
    4: {"cpu.sadf": HEAD + "h;1;2031-03-05 08:15:20 UTC;0;1.5;9\n", "cpu_data.csv": "hostname,interval,timestamp,CPU,%user,%idle\nh,1,2031-03-05 08:15:20,0,7.5,9\n"},
    6: {"twice.txt": "mine=1\n", "twice.sadf": HEAD + "h;1;2031-03-05 08:15:20 UTC;0;1.5;9\n", "status.txt": "success"},
    7: {"twice.txt": "mine=2\n", "status.txt": "success"},
    5: {"threadstat-event.csv": "read_id,count,event_id\r\n1,5,2\r\n", "threadstat-read.csv": "read_id,timestamp,time_running,time_enabled\n1,x,2,3\n"},
}


def runs_of(spark, ids, benchmark="dacapo_samples2"):
    runs = ", ".join(f'"{i}": {{"benchmark": "{benchmark}", "tar_file": "t", "iteration": 1, "gc": "ZGC"}}' for i in ids)
    return parse_runs(spark.createDataFrame([(f'{{"bench_index": 1.0, "benchmark_runs": {{{runs}}}}}',)], "value string"))


def test_files_that_do_not_parse_are_issues_of_their_own(spark, tmp_path):
    for id_, files in BAD.items():
        pack(tmp_path, id_, files)
    lake, kept = f"{tmp_path}/lake", dict(extractors._OWN)
    extractors._OWN.clear()
    register_extractor(Extractor("twice_sadf", (Rule("twice_sadf", r"^twice\.txt$"),), Grammar("mine=", r"mine=(\d+)", {"mine": text}), endings=("twice.txt",)))
    try:
        collect(spark, Task(str(tmp_path), {"all": {}}), runs_of(spark, BAD), lake)
    finally:
        extractors._OWN.clear()
        extractors._OWN.update(kept)
    read = lambda t: spark.read.parquet(f"{lake}/{t}")
    assert sorted((r.id, r.elapsed, r.cpu_percent) for r in read("time").collect()) == [(2, 12, 97), (2, 13, None)]
    assert {r.id: (r.repository, r.note, r.note_duplicated_0, r.commit) for r in read("git_info").collect()} == {1: ("ours", None, None, "abc"), 2: ("ours", "a, b", "two\nlines", None)}
    assert [(r.id, r["%user"]) for r in read("cpu_all_cores_sadf").collect()] == [(3, 1.5)] and read("disk_sadf").count() == 0
    assert [(r.id, r.count) for r in read("threadstat_event").select("id", F.col("count").alias("count_")).toDF("id", "count_").collect()][0][0] == 5 and read("threadstat_read").count() == 0
    told = sorted((r.id, r.message) for r in read("parse_status").collect())
    assert told == [
        (1, "jvm0.time: failed to parse for time: line 3, value '1 cells under 2 names'"),
        (3, "disk.sadf: failed to parse for disk_sadf: line 2, field timestamp, value 'yesterday'"),
        (4, "cpu.sadf: Duplicate file for cpu_sadf"),
        (5, "threadstat-read.csv: failed to parse for threadstat_read: line 2, field timestamp, value 'x'"),
        (6, "table made twice: twice_sadf"),
    ]  # that run has no rows but this one
    assert {r.id for r in read("status").collect()} == {1, 2, 3, 4, 5, 7} and [(r.id, r.mine) for r in read("twice_sadf").collect()] == [(7, "2")]
    assert [(r.id, r["%user"]) for r in read("cpu_sadf").collect()] == [(4, 7.5)]
    assert dict(read("config").dtypes)["iteration"] == "tinyint"


def test_many_archives_are_scanned_by_many_tasks(spark, tmp_path):
    """A thousand small archives, which adaptive execution would take for one task's work, are staged by as many tasks as there are cores."""
    pack(tmp_path, 0, {"status.txt": "success", "runner1.exit": "0"})
    small = (tmp_path / "runs" / f"{0:016X}.tar.xz").read_bytes()
    for k in range(1, 1000):
        (tmp_path / "runs" / f"{k:016X}.tar.xz").write_bytes(small)
    paths = spark.range(1000).select("id", archive_path(F.col("id"), str(tmp_path)).alias("path"))
    corpus = Corpus(Staging(spark, str(tmp_path)), archives.scan_archives(paths, WANTED), [])
    by = corpus.lines.groupBy(F.regexp_extract(F.col("_metadata.file_name"), "part-([0-9]+)", 1).alias("task")).agg(F.count_distinct("id").alias("n")).collect()
    assert len(by) == 4 and all(r.n == 250 for r in by)
    assert corpus.files.count() == 2000 and corpus.files.filter("fault is not null").count() == 0


def test_files_of_the_lake(spark, tmp_path):
    rows = spark.range(50_000).selectExpr("id", "concat('text ', id) AS t", "if(id < 40000, 'a', 'b') AS collection")
    schema, names = sink.write_table(rows, "wide", str(tmp_path), narrow=True, file_bytes=400_000)
    found = {p: pq.ParquetFile(p).metadata for p in tmp_path.glob("wide/*/*.parquet")}
    assert len(found) >= 4 and all(m.num_rows * 27 <= 450_000 for m in found.values()) and sum(m.num_rows for m in found.values()) == 50_000
    meta = next(iter(found.values())).row_group(0).column(0)
    assert meta.compression == "ZSTD" and meta.is_stats_set and str(meta.physical_type) == "INT32"
    assert not list(tmp_path.glob("_wide/*/*.parquet")) and names == ["a", "b"] and dict((f.name, f.dataType.simpleString()) for f in schema)["id"] == "int"


def test_files_keep_to_their_bytes(spark, tmp_path):
    """Rows of 10 to 10,000 bytes, each once, in files that never exceed the limit, and as few as that allows."""
    rows = spark.range(3000).selectExpr("id", "repeat('x', cast(pow(10, 1 + id % 4) AS int)) AS t", "if(id % 3 = 0, 'a', 'b') AS collection").repartition(5)
    sink.write_table(rows, "uneven", str(tmp_path), narrow=True, file_bytes=200_000)
    read = spark.read.parquet(f"{tmp_path}/uneven")
    sizes = read.groupBy("collection", F.col("_metadata.file_path").alias("f")).agg(F.sum(F.length("t") + 17).alias("b")).collect()
    total = sum(r.b for r in sizes)
    assert read.count() == read.select("id").distinct().count() == 3000 and max(r.b for r in sizes) <= 200_000
    assert len(sizes) <= total / 180_000 + 4 and sum(r.b < 150_000 for r in sizes) <= 2  # the last of each collection
    sink.write_table(rows.filter("id % 4 = 3").limit(9), "uneven", str(tmp_path), narrow=True, file_bytes=3000)  # each row is more than a file
    assert spark.read.parquet(f"{tmp_path}/uneven").filter("collection = 'a'").count() <= 9


def test_a_table_is_measured_while_it_is_written(spark, tmp_path, monkeypatch):
    """What makes a table runs once, and a small one of which nothing narrows is written once."""
    ran, writes = spark.sparkContext.accumulator(0), []

    def run(batches):
        for batch in batches:
            ran.add(batch.num_rows)
            yield batch

    rows = spark.range(1000).selectExpr("cast(id AS string) AS t", "if(id % 2 = 0, 'a', 'b') AS collection").mapInArrow(run, "t string, collection string")
    real = sink._as_files
    monkeypatch.setattr(sink, "_as_files", lambda df: writes.append(df) or real(df))
    schema, names = sink.write_table(rows, "once", str(tmp_path), narrow=True)
    assert ran.value == 1000 and len(writes) == 1 and sorted(names) == ["a", "b"] and spark.read.parquet(f"{tmp_path}/once").count() == 1000
    assert len(list(tmp_path.glob("once/*/*.parquet"))) == 2
    longer = rows.selectExpr("length(t) + 0L AS n", "*")
    sink.write_table(longer, "twice", str(tmp_path), narrow=True)
    assert ran.value == 2000 and len(writes) == 2 and dict(spark.read.parquet(f"{tmp_path}/twice").dtypes)["n"] == "tinyint"


def test_tables_side_by_side(spark, tmp_path):
    selected = spark.createDataFrame([(k, ["a", "b"] if k % 2 else ["a"]) for k in range(10)], "id long, collections array<string>")
    tables = {f"t{k}": spark.range(10).selectExpr("id * 1000 AS big", "id") for k in range(9)}
    tables["none"] = tables["t0"].filter("id < 0")
    assert sink.write_tables(tables, selected, str(tmp_path), ("t8",), True, ["a", "b", "c"]) == ["none", *(f"t{k}" for k in range(8))]
    for name in ("t0", "t7"):
        read = spark.read.parquet(f"{tmp_path}/{name}")
        assert read.columns == ["big", "id", "collection"] and sorted((r.collection, r.id) for r in read.collect()) == sorted([("a", k) for k in range(10)] + [("b", k) for k in range(1, 10, 2)])
        assert {p.name for p in (tmp_path / name).glob("collection=*")} == {"collection=a", "collection=b", "collection=c"}
    assert spark.read.parquet(f"{tmp_path}/none").count() == 0
    sink.write_tables({"t0": tables["t0"].filter("id % 2 = 0")}, selected, str(tmp_path), (), True, ["a", "b"])  # b has no rows any more
    assert {r.collection for r in spark.read.parquet(f"{tmp_path}/t0").collect()} == {"a"}
    bad = {"bad": spark.range(1).selectExpr("id", "raise_error('no such') AS x"), **{f"z{k}": tables["t0"] for k in range(20)}}
    with pytest.raises(Exception, match="no such"):
        sink.write_tables(bad, selected, str(tmp_path), at_once=2)
    assert not (tmp_path / "z19").exists()


def test_row_groups_have_their_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sink, "GROUP_ROWS", 7000)
    sink.write_table(spark.range(20_000).selectExpr("id", "'a' AS collection").coalesce(1), "rows", str(tmp_path))
    sizes = [m.row_group(k).num_rows for p in tmp_path.glob("rows/*/*.parquet") for m in [pq.ParquetFile(p).metadata] for k in range(m.num_row_groups)]
    assert max(sizes) <= 7000 and sum(sizes) == 20_000 and len(sizes) >= 3


def test_lines_of_members(spark, tmp_path):
    pack(tmp_path, 7, {"a.raw": "one\ntwo\n  \n", "b.raw": "", "c.bin": "no", "d.raw": b"\xff"})
    paths = spark.createDataFrame([(7, f"{tmp_path}/runs/{7:016X}.tar.xz"), (8, f"{tmp_path}/runs/none")], "id long, path string")
    rows = archives.scan_archives(paths, (".raw",)).orderBy("id", "ord", "line_no").collect()
    assert [(r.id, r.ord, r.name, r.line_no, bytes(r.line), r.is_last) for r in rows if r.error is None] == [(7, 0, "a.raw", 0, b"one", False), (7, 0, "a.raw", 1, b"two", False), (7, 0, "a.raw", 2, b"  ", True), (7, 1, "b.raw", 0, b"", True), (7, 3, "d.raw", 0, b"\xff", True)]
    assert [(r.name, r.fault, r.last_text) for r in rows if r.is_last] == [("a.raw", None, 1), ("b.raw", None, None), ("d.raw", "invalid UTF-8 in line 0", 0)]
    assert [(r.id, r.error) for r in rows if r.error] == [(8, "cannot read archive: FileNotFoundError")]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_archives_are_packed_and_scanned_once(spark, monkeypatch):
    """What the query gives is read from one scan's lines; a run's events are one archive, but for a long run's."""
    assert "Arrow" not in QUERIES["archive_scan"](spark, DATA)._jdf.queryExecution().toString()
    monkeypatch.setattr(files, "PACKED", 10)
    rows = spark.range(0, 90, 10).selectExpr("1L AS id", "id AS event_id").unionByName(spark.range(25).selectExpr("2L AS id", "id AS event_id"))
    parts = files._parts(rows).groupBy("id", "part").count().collect()
    assert sorted(tuple(r) for r in parts) == [(1, 0, 9), (2, 0, 10), (2, 1, 10), (2, 2, 5)]


def test_archives_are_stored_by_the_batch(tmp_path):
    batch = pa.RecordBatch.from_pydict({"id": [1, 2], "events": [[{"event_id": 0, "line": "a"}, {"event_id": 1, "line": "b"}], [{"event_id": 2, "line": "c"}]]})
    assert [b.to_pydict() for b in files._stored(f"{tmp_path}/runs")(iter([batch]))] == [{"id": [1, 2]}]
    with tarfile.open(tmp_path / "runs" / f"{1:016X}.tar.xz") as archive:
        assert [(m.name, archive.extractfile(m).read()) for m in archive] == [("gc.javalog", b"a\nb\n"), ("status.txt", b"success\n")]
    assert len(list((tmp_path / "runs").iterdir())) == 2


def test_pages_end_by_their_bytes(spark, tmp_path):
    """Each 25,000 numbers are repeated: within a page that costs next to nothing, in pages of 20,000 rows each costs its two bytes."""
    rows = spark.range(0, 100_000, 1, 1).selectExpr("xxhash64(id % 25000) AS n", "'a' AS collection")
    sink.write_table(rows, "paged", str(tmp_path))
    (file,) = tmp_path.glob("paged/*/*.parquet")
    assert pq.ParquetFile(file).metadata.row_group(0).column(0).total_compressed_size < 300_000


def test_stored_archives(tmp_path):
    """Archives that the collect query packs hold their members, whichever batch they come in, and nothing else is left beside them."""
    kind = pa.list_(pa.struct([("event_id", pa.int64()), ("line", pa.string())]))
    made = [[{"event_id": k, "line": f"é {n} {k}"} for k in range(n)] for n in (1, 0, 600)]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 255]), pa.array(made, kind)], names=["id", "events"])
    told = list(files._stored(str(tmp_path / "runs"))(iter([batch.slice(0, 1), batch.slice(1)])))
    assert [b["id"].to_pylist() for b in told] == [[1], [2, 255]]
    assert sorted(p.name for p in (tmp_path / "runs").iterdir()) == [f"{k:016X}.tar.xz" for k in (1, 2, 255)]
    for k, events in zip((1, 2, 255), made):
        with tarfile.open(tmp_path / "runs" / f"{k:016X}.tar.xz") as archive:
            assert {m.name: archive.extractfile(m).read().decode() for m in archive} == {"gc.javalog": "".join(f"{e['line']}\n" for e in events), "status.txt": "success\n"}


def test_no_table_is_sent_to_all_tasks_for_its_files_bytes(spark, tmp_path, monkeypatch):
    """Staged tables hold many rows in few bytes; the collect job's joins send those alone that were counted. Settings of the session come back."""
    pack(tmp_path, 1, ZGC)
    pack(tmp_path, 2, ZGC | {"jvm0.time": "elapsed,cpu_percent\n12\n"})
    sent, marked, write = [], [], DataFrameWriter.parquet

    def watched(self, *args, **how):
        made = self._df._jdf.queryExecution()
        sent.append(made.sparkPlan().toString().count("BroadcastHashJoin"))
        marked.append(made.optimizedPlan().toString().count("strategy=broadcast"))
        return write(self, *args, **how)

    monkeypatch.setattr(DataFrameWriter, "parquet", watched)
    keys = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before = [spark.conf.get(k, None) for k in keys], spark.conf.get(keys[0])
    collect(spark, Task(str(tmp_path), {"all": {}}), runs_of(spark, (1, 2)), f"{tmp_path}/lake")
    assert len(sent) > 40 and sum(marked) > 5 and sent == marked
    assert spark.conf.get(keys[0]) == before[1] and spark.conf.get(keys[1], None) == before[0][1]
    assert [r.id for r in spark.read.parquet(f"{tmp_path}/lake/time").collect()] == [1]


def test_small_files_of_many_rows(spark, tmp_path):
    """200,000 equal rows have a file of some kilobytes: they are joined where they are, and ten rows are sent once their size is seen."""
    for name, n in (("many", 200_000), ("ten", 10)):
        spark.range(0, n, 1, 1).selectExpr("id % 5 AS id").write.parquet(f"{tmp_path}/{name}")
    assert sum(p.stat().st_size for p in tmp_path.glob("many/*.parquet")) < 300_000

    def plan(name):
        rows = spark.range(1000).join(spark.read.parquet(f"{tmp_path}/{name}"), "id", "left_semi")
        assert sorted(r.id for r in rows.collect()) == [0, 1, 2, 3, 4]
        return rows._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]

    assert "BroadcastHashJoin" in plan("many")
    with joined_by_rows(spark):
        assert "SortMergeJoin" in plan("many") and "BroadcastHashJoin" not in plan("many") and "BroadcastHashJoin" in plan("ten")
    with pytest.raises(ZeroDivisionError), joined_by_rows(spark):
        1 / 0  # noqa: B018
    assert "BroadcastHashJoin" in plan("many")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with joined_by_rows(spark):
            assert "BroadcastHashJoin" not in plan("ten")  # nothing is to be sent, as was said before
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_are_counted_before_they_are_sent(spark, monkeypatch):
    monkeypatch.setattr(csvfiles, "FEW", 100)
    for n in (0, 100, 101):
        kept, sent = csvfiles.few(spark.range(n))
        hinted = "strategy=broadcast" in spark.range(9).join(sent(kept), "id")._jdf.queryExecution().optimizedPlan().toString()
        assert kept.count() == n and hinted == (n <= 100)
