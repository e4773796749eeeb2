"""Queries of the run manifest, of selection and of routing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import selection as S
from ..schema import RUN
from ..sources import manifest
from .registry import query, table

_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'dacapo_samples2' WHEN 'O' THEN 'specjbb' ELSE 'other' END"
_GC = "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL WHEN o_orderpriority = '1-URGENT' THEN 'ZGC' WHEN o_orderpriority = '2-HIGH' THEN 'GenZGC' WHEN o_orderpriority = '3-MEDIUM' THEN 'G1' ELSE 'Parallel' END"
_FILTERS = {
    "all": {},
    "empty": {"gc": []},
    "fast": {"benchmark": ["dacapo_samples2", "specjbb"], "gc": ["ZGC", "G1"]},
    "late": {"timeout": [1, 2, 3]},
}
_TESTS = {"all": "TRUE", "empty": "FALSE", "fast": f"{_STATUS} IN ('dacapo_samples2', 'specjbb') AND coalesce({_GC} IN ('ZGC', 'G1'), FALSE)", "late": "o_custkey % 7 IN (1, 2, 3)"}


def runs(spark: SparkSession, d: str) -> DataFrame:
    """Orders as runs: status and priority as benchmark and collector, an unspecified priority as an absent one."""
    rows = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.expr(_STATUS).alias("benchmark"), F.format_string("%d.tar", "o_orderkey").alias("tar_file"), (F.col("o_orderkey") % 3).alias("iteration"),
        F.expr(_GC).alias("gc"), F.expr("nullif(o_custkey % 7, 0)").alias("timeout"), F.col("o_totalprice").alias("memory_ratio"), F.expr("o_custkey % 2 = 0").alias("opp_zgc"),
    )
    return rows


@query("membership_filter", f"SELECT o_orderkey AS id, {', '.join(f'{t} AS in_{n}' for n, t in _TESTS.items())} FROM orders")
def membership_filter(spark: SparkSession, d: str) -> DataFrame:
    return runs(spark, d).select("id", *(S.membership(w).alias(f"in_{n}") for n, w in _FILTERS.items()))


_TASK = manifest.Task("/runs", {n: w for n, w in _FILTERS.items() if n != "all"})
_LABELS = f"concat_ws(',', CASE WHEN {_TESTS['fast']} THEN 'fast' END, CASE WHEN {_TESTS['late']} THEN 'late' END)"


@query("run_selection", f"SELECT * FROM (SELECT o_orderkey AS id, {_LABELS} AS collections FROM orders) WHERE collections <> ''")
def run_selection(spark: SparkSession, d: str) -> DataFrame:
    return S.select_runs(runs(spark, d), _TASK).select("id", F.concat_ws(",", "collections").alias("collections"))


@query("fan_out", " UNION ALL ".join(f"SELECT l_orderkey AS id, l_linenumber, '{n}' AS collection FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE {_TESTS[n]}" for n in ("fast", "late")))
def fan_out(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), "l_linenumber")
    return S.fan_out(rows, S.select_runs(runs(spark, d), _TASK)).select("id", "l_linenumber", "collection")


def _config_sql() -> str:
    own = {"benchmark": _STATUS, "tar_file": "o_orderkey || '.tar'", "iteration": "o_orderkey % 3", "gc": _GC, "timeout": "nullif(o_custkey % 7, 0)", "memory_ratio": "o_totalprice", "opp_zgc": "o_custkey % 2 = 0"}
    kinds = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN", "smallint": "SMALLINT"}
    return "SELECT " + ", ".join(f"CAST({own.get(f.name, 'NULL')} AS {kinds[f.dataType.simpleString()]}) AS {f.name}" for f in RUN) + ", o_orderkey AS id FROM orders"


@query("config_table", _config_sql())
def config_table(spark: SparkSession, d: str) -> DataFrame:
    return S.config_table(runs(spark, d))


_OWN = "['config', 'time', 'java_threads', 'status', 'system_load', 'threadstat', 'zgc_phases', 'zgc_gc_summary', 'g1_phases', 'git_info', 'zgc_task', 'zgc_stats'"


@query("collector_routing", f"""
SELECT o_orderkey AS id, unnest(CASE o_orderstatus WHEN 'F' THEN {_OWN}, 'dacapo_iteration', 'dacapo_latency'] WHEN 'O' THEN {_OWN}, 'specjbb'] ELSE [NULL] END) AS collector,
  CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'no collectors for benchmark other' END AS message FROM orders""")
def collector_routing(spark: SparkSession, d: str) -> DataFrame:
    routed, issues = S.route_collectors(runs(spark, d))
    return routed.withColumn("message", F.lit(None).cast("string")).unionByName(issues.select("id", "collector", "message"))


@query("manifest_scan", f"""
SELECT o_orderkey AS id, {_STATUS} AS benchmark, o_orderkey || '.tar' AS tar_file, o_orderkey % 3 AS iteration, {_GC} AS gc, nullif(o_custkey % 7, 0) AS timeout,
  o_totalprice AS memory_ratio, o_custkey % 2 = 0 AS opp_zgc FROM orders""")
def manifest_scan(spark: SparkSession, d: str) -> DataFrame:
    """Orders written as manifests, one for each thousand or so of runs, and read again."""
    rows = runs(spark, d)
    body = F.to_json(F.struct(*(c for c in rows.columns if c != "id")))
    entry = F.concat(F.lit('"'), F.col("id").cast("string"), F.lit('":'), body)
    parts = rows.groupBy(F.floor(F.col("id") / 1000)).agg(F.concat(F.lit('{"bench_index": 1.5, "benchmark_runs": {'), F.concat_ws(",", F.collect_list(entry)), F.lit("}}")).alias("value"))
    return manifest.parse_runs(parts).select("id", "benchmark", "tar_file", "iteration", "gc", "timeout", "memory_ratio", "opp_zgc")


@query("archive_locator", "SELECT o_orderkey AS id, '/data/runs/' || printf('%016X', o_orderkey) || '.tar.xz' AS path, o_orderkey AS back FROM orders")
def archive_locator(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("id")).withColumn("path", manifest.archive_path(F.col("id"), "/data/"))
    return rows.withColumn("back", manifest.archive_id(F.col("path")))


@query("gc_gate", f"""
SELECT l_orderkey AS id, l_linenumber, CASE WHEN lower({_GC}) LIKE '%zgc%' THEN 'zgc' ELSE 'g1' END AS word
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE lower({_GC}) LIKE '%zgc%' OR lower({_GC}) LIKE '%g1%'""")
def gc_gate(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), "l_linenumber")
    zgc, g1 = (S.gc_gate(rows, runs(spark, d), word).withColumn("word", F.lit(word)) for word in ("zgc", "g1"))
    return zgc.unionByName(g1)
