"""CSV members: line ends, quotes, ragged records, repeated names, large numbers, and the entry's guard."""

import importlib
import io
import lzma
import os
import sys
import tarfile
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from runlake.catalog import QUERIES
from runlake.operators import csvtables, quality
from runlake.session import shared_folder
from runlake.sources import archives, csvfiles

DATA = "/root/testdata/sf0.001"


def lines(spark, *texts, id_=1, name="a.csv", ord_=0):
    return spark.createDataFrame([(id_, ord_, name, i, t) for i, t in enumerate(texts)], "id long, ord int, name string, line_no long, line string")


@pytest.mark.parametrize(
    "line, want",
    [('a,"b,x",c', ["a", "b,x", "c"]), (",a,", [None, "a", None]), ('""', [""]), ("", [None]), ('"q""q",1', ['q"q', "1"]), ('x,"two\nlines"', ["x", "two\nlines"]), ('"a"b,c', None), ('"open', None), ('a"b,c', ['a"b', "c"])],
)
def test_cells(spark, line, want):
    assert spark.createDataFrame([(line,)], "line string").select(csvfiles.cells(F.col("line"), ",").alias("c")).first().c == want


def test_types_are_inferred_over_all_files(spark):
    df = lines(spark, "n,x,big,t,none\r", "1,2,1234567890123456789,a,\r", "2,2.5,9223372036854775808,7,\r", "").unionByName(lines(spark, "N,t", "-3,8", id_=2))
    rows, bad = csvfiles.inferred(df)
    kinds = dict(rows.dtypes)
    assert [kinds[c] for c in ("N", "x", "big", "t", "none")] == ["bigint", "double", "decimal(38,0)", "string", "string"] and bad.count() == 0
    got = {(r.id, r.line_no): (r.N, r.x, r.big and str(r.big), r.t, r.none) for r in rows.collect()}
    assert got == {(1, 1): (1, 2.0, "1234567890123456789", "a", None), (1, 2): (2, 2.5, "9223372036854775808", "7", None), (2, 1): (-3, None, None, "8", None)}


def test_names_that_clash(spark):
    rows, _ = csvtables.git_info(lines(spark, "name,id,line_no,x,X", "a,b,c,1,2", name="git_info.csv"))
    assert {c: v for c, v in rows.first().asDict().items() if c != "id"} == {"name": "a", "id_": "b", "line_no": "c", "x": 1, "X_duplicated_0": 2} and rows.first()["id"] == 1


def test_a_ragged_record_fails_its_file_alone(spark):
    df = lines(spark, "a,b", "1,2", "3", id_=1).unionByName(lines(spark, "a,b", "1,2", "3,4,5", id_=2)).unionByName(lines(spark, "a,b", "1,2", id_=3)).unionByName(lines(spark, '"a"x,b', "1,2", id_=4))
    rows, bad = csvfiles.inferred(df)
    assert [r.id for r in rows.collect()] == [3] and sorted(r.id for r in bad.collect()) == [1, 2, 4]
    rows, bad = csvfiles.declared(df, "a long, b long")
    assert sorted({r.id for r in rows.collect()}) == [3, 4] and sorted(r.id for r in bad.collect()) == [1, 2]


def test_a_bad_first_file_lets_the_next_one_in(spark):
    df = lines(spark, "read_id,count,event_id", "1,x,2").unionByName(lines(spark, "read_id,count,event_id\r", "1,5,2\r", ord_=1)).unionByName(lines(spark, "read_id,count,event_id", "1,6,2", ord_=2))
    rows, issues = csvtables.threadstat_event(df)
    assert [r["count"] for r in rows.collect()] == [5]
    assert sorted(r.message for r in issues.collect()) == ["Duplicate file for threadstat_event", "failed to parse for threadstat_event"]


def test_files_without_rows_have_none(spark):
    rows, bad = csvfiles.inferred(lines(spark, "a,b"))
    assert rows.count() == 0 and bad.count() == 0 and {"a", "b"} <= set(rows.columns)
    rows, bad = csvfiles.inferred(lines(spark, "a").limit(0))
    assert rows.count() == 0 and bad.count() == 0


def test_quoted_cells_may_run_over_lines():
    assert list(archives._records(iter([b"a,b\n", b'1,"x\n', b'y"\n', b'2,"open\n', b"end"]))) == [b"a,b\n", b'1,"x\ny"\n', b'2,"open\nend']


def test_long_cells_and_stray_quotes(spark, tmp_path):
    """A cell of a megabyte reads, with as many quotes and line ends; a stray quote ends its file alone, in linear time."""
    long = 'x""\n' * 250_000
    rows, bad = csvfiles.inferred(lines(spark, "a,b", f'1,"{long}"', "2,y"))
    assert sorted((r.a, len(r.b)) for r in rows.collect()) == [(1, 750_000), (2, 1)] and bad.count() == 0
    assert csvfiles.declared(lines(spark, "a,b", f'1,"{long}"'), "a long, b string")[0].first().b.count("\n") == 250_000
    hundred = ["0123456789,abcdefghij,0123456789,abcdefghij,0123456789\n" * 20_000] * 100
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as archive:
        for name, data in (("stray.csv", ('a,"b\n' + "".join(hundred)).encode()), ("jvm0.time", b"a\n1\n")):
            member = tarfile.TarInfo(name)
            member.size = len(data)
            archive.addfile(member, io.BytesIO(data))
    packed = lzma.compress(out.getvalue(), preset=0)
    began = time.monotonic()
    batches = list(archives._scanned(io.BytesIO, ())([pa.RecordBatch.from_pydict({"id": [1], "source": pa.array([packed], pa.binary())})]))
    found = [r for b in batches for r in b.to_pylist() if r["is_last"]]
    assert time.monotonic() - began < 10
    assert [(r["name"], r["fault"]) for r in found] == [("stray.csv", f"a record of more than {archives.RECORD_BYTES} bytes from record 0 on"), ("jvm0.time", None)]


def test_a_byte_order_mark(spark):
    rows, _ = csvfiles.inferred(lines(spark, "\ufeffa,b", "1,2"))
    assert set(rows.columns) >= {"a", "b"}
    rows, bad = csvfiles.declared(lines(spark, "\ufeff1,2", "3,4"), "a long, b long", header=False)
    assert sorted(r.a for r in rows.collect()) == [1, 3] and bad.count() == 0


def test_columns_stand_as_files_have_them(spark):
    df = lines(spark, "t,user,idle", "1,2,3").unionByName(lines(spark, "t,nice,user,steal,idle,guest", "1,2,3,4,5,6", id_=2)).unionByName(lines(spark, "B,t,Idle", "1,2,3", id_=3))
    rows, _ = csvtables.git_info(df)
    assert rows.columns == ["B", "t", "nice", "user", "steal", "Idle", "guest", "id"]
    assert csvfiles.merged_order([("a", "b"), ("b", "a"), ("c",)]) == ["a", "b", "c"]


def test_where_and_why_a_file_fails(spark):
    head = "read_id,timestamp,time_running,time_enabled"
    df = lines(spark, head, "1,2,3,4", "5,6,x,y", "z,1,1,1").unionByName(lines(spark, head, "1,2,3", id_=2)).unionByName(lines(spark, head, "1,2,3,4", id_=3))
    _, issues = csvtables.threadstat_read(df)
    assert sorted((r.id, r.line_no, r.field, r.value) for r in issues.collect()) == [(1, 2, "time_running", "x"), (2, 1, None, "1,2,3")]
    _, issues = csvtables.git_info(lines(spark, 'a,"b', id_=4).unionByName(lines(spark, "a,b", "1,2", '"q"r,2', id_=5)))
    assert sorted((r.id, r.line_no, r.field, r.value) for r in issues.collect()) == [(4, 0, None, 'a,"b'), (5, 2, None, '"q"r,2')]
    assert sorted(r[0] for r in issues.select(quality.told()).collect()) == ["a.csv: failed to parse for git_info: line 1, value 'a,\"b'", "a.csv: failed to parse for git_info: line 3, value '\"q\"r,2'"]
    long = lines(spark, head, "1,2,3," + "y" * 5000, id_=6)
    assert csvtables.threadstat_read(long)[1].first().value == "y" * quality.TOLD


def test_archives_are_dealt_by_size(spark, tmp_path):
    assert archives.lightest_first([10, 1, 1, 1, 1, 9], 3) == [0, 2, 2, 2, 2, 1]
    assert archives.tasks_for(10, 1000, 4) == 4 and archives.tasks_for(10, 2, 4) == 2 and archives.tasks_for(archives.TASK_BYTES * 50, 1000, 4) == 50 and archives.tasks_for(0, 0, 4) == 1
    sized = spark.range(1001).selectExpr("id", "concat('p', id) AS path", "if(id = 500, 1000000L, 100 + id % 7) AS size")
    tasks = archives.packed(sized, 8, 1001).groupBy("task").agg(F.count("*").alias("n"), F.sum("size").alias("size")).collect()
    rest = sorted(r["size"] for r in tasks)[:-1]
    assert len(tasks) == 8 and [r.n for r in tasks if r["size"] >= 1000000] == [1] and rest[-1] - rest[0] <= 106  # one task for the large one, the others alike
    small = lzma.compress(b"\0" * 1024)
    for k in range(1000):
        (tmp_path / f"{k}").write_bytes(small)
    paths = spark.range(1000).selectExpr("id", f"concat('{tmp_path}/', id) AS path")
    assert archives.with_sizes(paths).agg(F.sum("size")).first()[0] == 1000 * len(small)
    parts = archives.scan_archives(paths.repartition(1)).groupBy(F.spark_partition_id().alias("t")).count().count()
    assert archives.scan_archives(paths.withColumn("path", F.concat("path", F.lit("x")))).groupBy(F.spark_partition_id().alias("t")).count().count() == 4 and parts == 0  # empty archives have no rows, missing ones have one each


def test_more_archives_than_are_packed_together(spark, monkeypatch):
    deal = archives.lightest_first

    def watched(sizes, tasks):
        assert len(sizes) <= 400, f"{len(sizes)} archives in one group"
        return deal(sizes, tasks)

    monkeypatch.setattr(archives, "PACKED_TOGETHER", 320)
    monkeypatch.setattr(archives, "lightest_first", watched)
    sized = spark.range(5000).selectExpr("id", "concat('p', id) AS path", "if(id = 500, 1000000L, 100 + id % 7) AS size")
    tasks = archives.packed(sized, 4, 5000).groupBy("task").agg(F.count("*").alias("n"), F.sum("size").alias("size")).collect()
    rest = sorted(r["size"] for r in tasks)[:-1]
    assert len(tasks) == 4 and sum(r.n for r in tasks) == 5000 and [r.n for r in tasks if r["size"] >= 1000000] == [1] and rest[-1] - rest[0] < rest[0] / 20


def test_folders_of_one_machine_are_refused_on_a_cluster(spark):
    class Elsewhere:
        class conf:
            get = staticmethod(lambda key, default=None: None)

        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Elsewhere, "x")
    assert shared_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


@pytest.mark.parametrize("gone", ["runlake.llm", "runlake.llm.queries", "a_wheel"])
def test_the_entry_goes_on_without_its_optional_parts(monkeypatch, capsys, gone):
    import __spark_entry__ as entry

    real = importlib.import_module

    def missing(name, *args):
        if name in ("runlake.llm.queries", "corpus_pipeline"):
            raise ModuleNotFoundError(f"No module named {gone!r}", name=gone)
        return real(name, *args)

    monkeypatch.setattr(importlib, "import_module", missing)
    assert len(entry.queries()) > 60 and set(entry.oracle_sql()) == set(entry.queries())
    assert ("left out" in capsys.readouterr().err) == (gone == "a_wheel")
    assert "pytest" in sys.modules


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
@pytest.mark.parametrize("name", ["sadf_per_core", "sadf_tables", "csv_quoted"])
def test_records_are_not_shuffled(spark, name):
    """What is known of files comes to the records, not records to files: wide rows aren't sorted by file."""
    plan = QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_bad_records_are_found_without_a_sort_of_all(spark, monkeypatch):
    """A file's first record that doesn't fit, of too many cells or with text beside quotes, comes from numbers alone: no aggregate of records sorts them."""
    texts = {1: ["a,b", "1,2", "3,4,5", '"x"y,1'], 2: ["a,b", '"x"y,1', '"z"y,2', "1,2,3"], 3: ["a,b", "1,2"]}
    lines = spark.createDataFrame([(k, 0, "f.csv", n, t) for k, own in texts.items() for n, t in enumerate(own)], "id long, ord int, name string, line_no long, line string")
    plans, real = [], csvfiles.spooled
    monkeypatch.setattr(csvfiles, "spooled", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df))
    rows, bad = csvfiles.inferred(lines)
    assert sorted((r.id, r.line_no, r.field, r.value) for r in bad.collect()) == [(1, 2, None, "3 cells under 2 names"), (2, 1, None, '"x"y,1')]
    assert [(r.id, r.a, r.b) for r in rows.collect()] == [(3, 1, 2)]
    assert not [line for plan in plans for line in plan.splitlines() if "SortAggregate" in line and "partial_min(" in line]


def test_plain_records_are_cut_without_the_pattern(spark):
    """A record is parted once, whichever columns come of it, and only one with quotes or empty cells by the pattern; both ways give the same cells."""
    texts = ["a;b", "a;;b", ";a", "a;", ";", "", "a", 'a;"b"', 'a"b;c', '"a"b;c', "é;ü\n;x", " ;\t", None]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, line string")
    plain = [r.c for r in df.select(csvfiles.cells(F.col("line"), ";").alias("c")).collect()]
    assert plain == [["a", "b"], ["a", None, "b"], [None, "a"], ["a", None], [None, None], [None], ["a"], ["a", "b"], ['a"b', "c"], None, ["é", "ü\n", "x"], [" ", "\t"], None]
    plan = csvfiles.split_records(lines(spark, "a,b", "1,2"))._jdf.queryExecution().optimizedPlan().toString()
    parts = [line for line in plan.splitlines() if "regexp_extract_all" in line]
    assert len(parts) == 1 and parts[0].count("array_join") == 1 and parts[0].count("split(") == 1


def test_records_of_load_exports_are_read_few_times(spark):
    """Five looks at the records: headers, numbers of cells, records that don't part, types with times, and the rows."""
    head = "# hostname;interval;timestamp;CPU;%user"
    texts = [(k, 0, "cpu.sadf", n, t) for k in (1, 2) for n, t in enumerate([head, f"h;1;2031-03-05 08:15:2{k} UTC;0;1.5", "h;1;2031-03-05 08:15:30 UTC;1;2"])]
    looks, folder = spark.sparkContext.accumulator(0), shared_folder(spark, "records")
    spark.createDataFrame(texts, "id long, ord int, name string, line_no long, line string").write.parquet(folder)

    def counted(df):
        def seen(batches):
            for batch in batches:
                looks.add(batch.num_rows)
                yield batch

        return df.mapInArrow(seen, df.schema)

    rows, issues = csvtables.load_table(spark.read.parquet(folder), "cpu_sadf", stage=lambda df: counted(csvfiles.spooled(df)))
    assert sorted((r.id, str(r.timestamp), r.CPU, r["%user"]) for r in rows.collect()) == [(k, f"2031-03-05 08:15:{s}", c, u) for k in (1, 2) for s, c, u in ((f"2{k}", 0, 1.5), ("30", 1, 2.0))]
    assert looks.value == 5 * len(texts) and issues.count() == 0


def test_times_that_fail_a_load_export(spark):
    """The first time that isn't one fails its file, in columns of text and of numbers; files of other headers have their own place for it."""
    late, own = "# hostname;timestamp;%user", "# timestamp;hostname;%user"
    files = {1: [late, "h;2031-03-05 08:15:20;1", "h;then;2", "h;now;3"], 2: [own, "2031-03-05 08:15:21 UTC;h;1", ";h;2"], 3: [own, "2031-02-30 00:00:00;h;1"], 4: [late, "h;2031-03-05 08:15:22;1;9", "h;x;1"]}
    df = spark.createDataFrame([(k, 0, "disk.sadf", n, t) for k, texts in files.items() for n, t in enumerate(texts)], "id long, ord int, name string, line_no long, line string")
    rows, issues = csvtables.load_table(df, "disk_sadf")
    assert sorted((r.id, str(r.timestamp), r["%user"]) for r in rows.collect()) == [(2, "2031-03-05 08:15:21", 1), (2, "None", 2)]
    assert sorted((r.id, r.line_no, r.field, r.value) for r in issues.collect()) == [(1, 2, "timestamp", "then"), (3, 1, "timestamp", "2031-02-30 00:00:00"), (4, 1, None, "4 cells under 3 names")]
    rows, issues = csvtables.load_table(lines(spark, late, "h;7;1", name="disk.sadf"), "disk_sadf")
    assert rows.count() == 0 and [(r.line_no, r.field, r.value) for r in issues.collect()] == [(1, "timestamp", "7")]
