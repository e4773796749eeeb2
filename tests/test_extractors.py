"""Extractors of one's own: stateful ones over a run's files, of several tables, for named benchmarks, in the collect job."""

import pytest

from runlake.operators.extract import Grammar, text
from runlake.plans import extractors
from runlake.plans.collect import collect
from runlake.plans.extractors import Extractor, FileProblem, StatefulExtractor, register_extractor, run_stateful
from runlake.sources.manifest import Task, parse_runs
from runlake.sources.routing import Rule

from .test_collect import pack


@pytest.fixture
def registry():
    kept = dict(extractors._OWN)
    extractors._OWN.clear()
    yield
    extractors._OWN.clear()
    extractors._OWN.update(kept)


class Named:
    """Names of the first file, for the numbers of the second, beside the run's heap size."""

    def __init__(self, run):
        self.run, self.names, self.lines = run, {}, 0

    def read(self, name, lines, first):
        for n, line in enumerate(lines, first):
            if not line:
                continue
            self.lines += 1
            key, _, value = line.partition("=")
            if name == "names.txt":
                self.names[key] = value
            elif key not in self.names:
                raise FileProblem(f"no name for {key} in line {n + 1}")
            else:
                yield "named", {"name": self.names[key], "value": float(value), "scaled": float(value) * self.run["memory_ratio"]}

    def finish(self):
        if not self.names:
            raise FileProblem("a run without names")
        yield "read", {"lines": self.lines, "gc": self.run["gc"]}


RULES = (Rule("own", r"^names\.txt$"), Rule("own", r"^values\.txt$"))
SCHEMAS = {"named": "name string, value double, scaled double", "read": "lines long, gc string"}


def own(**how):
    return StatefulExtractor("naming", RULES, SCHEMAS, Named, endings=("names.txt", "values.txt"), **how)


def runs_of(spark, kinds):
    runs = ", ".join(f'"{i}": {{"benchmark": "{b}", "tar_file": "t", "iteration": 1, "gc": "{gc}", "memory_ratio": 2.5}}' for i, (b, gc) in kinds.items())
    return parse_runs(spark.createDataFrame([(f'{{"bench_index": 1.0, "benchmark_runs": {{{runs}}}}}',)], "value string"))


def test_in_the_collect_job(spark, tmp_path, registry):
    files = {"names.txt": "a=first\nb=second\n", "values.txt": "b=2\na=1\n", "status.txt": "success"}
    pack(tmp_path, 1, files)
    pack(tmp_path, 2, files | {"values.txt": "a=1\nc=3\nb=2\n"})
    pack(tmp_path, 3, files)
    pack(tmp_path, 4, {"status.txt": "success"})
    pack(tmp_path, 5, files | {"names.txt": b"\xff"})
    pack(tmp_path, 6, files | {"more.txt": "mine=1"})
    register_extractor(own(benchmarks=("specjbb",), gate="g1"))
    register_extractor(Extractor("mine", (Rule("mine", r"^more\.txt$"),), Grammar("mine=", r"mine=(\d+)", {"mine": text}), endings=("more.txt",), benchmarks=("mark_abuse",)))
    with pytest.raises(ValueError, match="read"):
        register_extractor(Extractor("read", (Rule("read", "^x$"),), Grammar("x", "(x)", {"x": text})))
    kinds = {1: ("specjbb", "G1"), 2: ("specjbb", "G1"), 3: ("dacapo_samples2", "G1"), 4: ("specjbb", "g1"), 5: ("specjbb", "G1"), 6: ("mark_abuse", "ZGC")}
    collect(spark, Task(str(tmp_path), {"all": {}}), runs_of(spark, kinds), f"{tmp_path}/lake", narrow=False)
    read = lambda t: spark.read.parquet(f"{tmp_path}/lake/{t}")
    assert sorted((r.id, r.name, r.value, r.scaled) for r in read("named").collect()) == [(1, "first", 1.0, 2.5), (1, "second", 2.0, 5.0), (2, "first", 1.0, 2.5)]
    assert sorted((r.id, r.lines, r.gc) for r in read("read").collect()) == [(1, 4, "G1"), (2, 4, "G1")] and read("named").columns[-2:] == ["id", "collection"]
    assert [(r.id, r.mine) for r in read("mine").collect()] == [(6, "1")]
    told = {(r.id, r.message) for r in read("parse_status").collect()}
    assert {(2, "values.txt: failed to read: no name for c in line 2"), (4, "failed to finish: a run without names"), (5, "names.txt: invalid UTF-8 for naming: line 1"), (5, "values.txt: failed to read: no name for b in line 1")} <= told
    assert not {m for i, m in told if i in (1, 3)}


def test_runs_are_streams_in_order(spark):
    """However lines are spread, each run's come in order, a bounded batch at a time."""

    class Order:
        def __init__(self, run):
            self.at, self.most = [], 0

        def read(self, name, lines, first):
            self.at += [int(x) for x in lines]
            self.most = max(self.most, len(lines))
            return ()

        def finish(self):
            yield "order", {"sorted": self.at == sorted(self.at), "n": len(self.at), "most": self.most}

    e = StatefulExtractor("order", (Rule("order", "^x"),), {"order": "sorted boolean, n long, most long"}, Order)
    rows = spark.range(60_000).selectExpr("id % 3 AS id", "cast(id % 6 div 3 AS int) AS ord", "concat('x', id % 6 div 3) AS name", "id div 6 AS line_no", "cast((id % 6 div 3) * 10000 + id div 6 AS string) AS line").repartition(7)
    runs = spark.range(4).selectExpr("id", "'b' AS benchmark")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    try:
        found = run_stateful(e, rows, runs)[0]["order"].orderBy("id").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [(r.id, r.sorted, r.n, r.most <= 1000) for r in found] == [(0, True, 20000, True), (1, True, 20000, True), (2, True, 20000, True), (3, True, 0, True)]
