"""Filters, selection, routing, reductions and data quality."""

import pytest
from pyspark.sql import functions as F

from runlake.operators import quality, reduce, selection
from runlake.sources import manifest
from runlake.sources.routing import route_files


def test_an_absent_attribute_is_in_no_list(spark):
    runs = spark.createDataFrame([(1, "zgc"), (2, None)], "id long, gc string")
    hit = lambda f: [r.id for r in runs.filter(selection.membership(f)).orderBy("id").collect()]
    assert hit({"gc": ["zgc"]}) == [1] and hit({}) == [1, 2] and hit({"gc": []}) == []
    assert [r.id for r in runs.filter(~selection.membership({"gc": ["zgc"]})).collect()] == [2]


def test_misspelt_keys_are_refused_unless_told_otherwise(spark):
    with pytest.raises(ValueError, match="benchmrk"):
        selection.membership({"benchmrk": ["x"]})
    assert spark.range(1).select(selection.membership({"benchmrk": ["x"]}, strict=False)).first()[0]


def manifest_of(spark, runs):
    return manifest.parse_runs(spark.createDataFrame([(f'{{"bench_index": 1.0, "benchmark_runs": {runs}}}',)], "value string"))


def test_manifest(spark):
    run = '{"benchmark": "specjbb", "tar_file": "a", "iteration": 2, "memory_ratio": 1.5, "opp_zgc": true}'
    row = manifest_of(spark, f'{{"17": {run}}}').first()
    assert (row.id, row.benchmark, row.iteration, row.memory_ratio, row.opp_zgc, row.gc) == (17, "specjbb", 2, 1.5, True, None)


@pytest.mark.parametrize("runs, what", [('{"x": {"benchmark": "a", "tar_file": "b", "iteration": 1}}', "invalid run id"), ('{"1": {"benchmark": "a", "tar_file": "b", "iteration": 1, "colour": 1}}', "unknown attribute"), ('{"1": {"benchmark": "a", "tar_file": "b"}}', "missing attribute")])
def test_a_bad_manifest_fails_the_load(spark, runs, what):
    with pytest.raises(Exception, match=what):
        manifest_of(spark, runs).collect()


def test_sample_task():
    task = manifest.parse_task('{"location": "/r", "collect": {"night": {"benchmark": ["specjbb"], "cache_ways": [4, 8], "softmax": ["8g"]}, "rest": {}}}')
    assert task.drop_tables == () and len(task.collect["night"]) == 3 and task.collect["rest"] == {}


def test_names_match_whole_paths(spark):
    names = ["gc.javalog", "./gc.javalog", "a/b.raw", "a/cpu.sadf", "gc-javalog", "runner+3.exit"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = {(r.name, r.table) for r in route_files(df).collect()}
    assert ("gc.javalog", "zgc_phases") in got and ("a/b.raw", "specjbb_summary") in got and ("a/cpu.sadf", "sadf") in got and ("runner+3.exit", "runner_exit") in got
    assert not any(n in ("./gc.javalog", "gc-javalog") for n, _ in got)


def test_narrowest_integers(spark):
    df = spark.createDataFrame([(1, 300, None, 1 << 40, -128), (127, 2, None, 1, 0)], "a long, b long, c long, d long, e long")
    assert dict(reduce.narrow_ints(df).dtypes) == {"a": "tinyint", "b": "smallint", "c": "tinyint", "d": "bigint", "e": "tinyint"}
    assert dict(reduce.narrow_ints(df.limit(0)).dtypes)["d"] == "tinyint"


def test_direction_of_the_suffix_sum(spark):
    df = spark.createDataFrame([(1, 0.1), (2, 0.7), (3, 0.2)], "at int, x double")
    assert reduce.suffix_sum(df, "x", [], ["at"], "s").orderBy("at").first().s == 0.2 + 0.7 + 0.1 != 1.0


def test_constraints(spark):
    df = spark.createDataFrame([(1, 5, 1.0), (2, 0, 1.0), (3, None, float("nan")), (4, 1, -0.0), (5, 1, float("inf")), (6, 1, 0.0)], "id long, timeout long, memory_ratio double")
    ok, rejects = quality.validate(df, on_error="keep")
    assert sorted(r.id for r in ok.collect()) == [1, 5]
    assert {r.id: r.reason for r in rejects.collect()} == {2: "timeout is zero", 3: "memory_ratio is not a number", 4: "memory_ratio is negative", 6: "memory_ratio is zero"}
    with pytest.raises(Exception, match="timeout is zero|memory_ratio is"):
        quality.validate(df)[0].collect()


def test_outcomes(spark):
    runs = spark.createDataFrame([(i,) for i in range(1, 7)], "id long")
    status = spark.createDataFrame([(1, "SUCCESS\n"), (2, "success"), (3, "success"), (4, " killed "), (6, "success")], "id long, text string")
    exits = spark.createDataFrame([(1, 10, 2), (1, 9, 3), (1, 1, 0), (4, 0, 1)], "id long, runner int, code int")
    logs = spark.createDataFrame([(1, "Resctrl: Failed"), (2, "x Resctrl: Failed y"), (3, "ok")], "id long, line string")
    got = {r.id: r.status for r in reduce.run_status(runs, status, exits, logs).collect()}
    assert got == {1: "runner9 exited with code 3", 2: "resctrl_failed", 3: "success", 4: "killed", 5: "unknown", 6: "success"}


def test_unknown_benchmarks_are_issues(spark):
    runs = spark.createDataFrame([(1, "specjbb"), (2, "nope")], "id long, benchmark string")
    routed, issues = selection.route_collectors(runs)
    assert routed.filter("id = 1").count() == 13 and [i.id for i in issues.collect()] == [2]
    assert quality.withhold(runs, issues).select(F.max("id")).first()[0] == 1


def test_manifests_are_streams(spark, tmp_path):
    """Read in pieces of any size a manifest gives the runs that it gives as one text; what breaks a rule ends the load."""
    import io
    import json
    import tracemalloc

    run = {"benchmark": "specjbb", "tar_file": "t {\\" + '"}' + "\\u00e9", "iteration": 1, "gc": "ZGC", "memory_ratio": 1.25}
    whole = json.dumps({"bench_index": 12.5, "more": [{"benchmark_runs": 1}], "benchmark_runs": {str(k): run for k in range(40)}, "after": None}, indent=1)
    for piece in (1, 7, 64, 1 << 20):
        found = dict(manifest.runs_in(io.StringIO(whole), piece))
        assert list(found) == [str(k) for k in range(40)] and all(json.loads(v) == run for v in found.values())
    (tmp_path / "m.json").write_text(whole)
    texts = spark.createDataFrame([(whole,)], "value string")
    assert sorted(manifest.read_runs(spark, f"{tmp_path}/m.json").collect()) == sorted(manifest.parse_runs(texts).collect())
    assert manifest.stream_runs(spark, f"{tmp_path}/m.json", f"file:{tmp_path}/m.json").count() == 80
    for wrong in ("[]", '{"benchmark_runs": 3}', '{"benchmark_runs": {"1": {"a": 1}', whole[:-9], '{"benchmark_runs": {"1": {"a": }}}'):
        with pytest.raises(ValueError):
            list(manifest.runs_in(io.StringIO(wrong), 5))
    for key, own, told in (("x1", run, "invalid run id"), ("1", run | {"nope": 1}, "unknown attribute"), ("1", {"benchmark": "b"}, "missing attribute")):
        (tmp_path / "bad.json").write_text(json.dumps({"benchmark_runs": {"0": run, key: own}}))
        with pytest.raises(Exception, match=told):
            manifest.read_runs(spark, f"{tmp_path}/bad.json").collect()
    assert list(manifest.runs_in(io.StringIO('{"benchmark_runs": {}}'))) == [] == list(manifest.runs_in(io.StringIO("{}")))

    class Endless(io.TextIOBase):
        """A manifest of 36 MB that is never there as a whole."""

        def __init__(self):
            self.n = 0

        def read(self, size=-1):
            self.n += 1
            own = ", ".join(f'"{self.n * 1000 + k}": {{"tar_file": "{"x" * 150}"}}' for k in range(1000))
            return '{"benchmark_runs": {' + own if self.n == 1 else ", " + own if self.n < 200 else "}}" if self.n == 200 else ""

    tracemalloc.start()
    assert sum(1 for _ in manifest.runs_in(Endless())) == 199 * 1000 and tracemalloc.get_traced_memory()[1] < 4 << 20
    tracemalloc.stop()
