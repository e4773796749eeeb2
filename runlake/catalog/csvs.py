"""Queries of the tables that come from CSV members."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import csvtables as T
from ..operators import selection as S
from ..operators.reduce import union_tables
from ..sources import csvfiles
from ..sources.routing import route_files
from .registry import events, lines, query, table


def with_header(body: DataFrame, head: str) -> DataFrame:
    """Lines of each file after a header, which becomes its line 0."""
    heads = body.select("id", "ord", "name").distinct().select("id", "ord", "name", F.lit(0).cast("bigint").alias("line_no"), F.lit(head).alias("line"), F.lit(False).alias("is_last"))
    return heads.unionByName(body.withColumn("line_no", F.col("line_no") + 1))


@query("csv_declared", "SELECT user_id AS id, event_id AS read_id, value AS amount, event_type AS kind FROM events WHERE user_id % 13 <> 0")
def csv_declared(spark: SparkSession, d: str) -> DataFrame:
    """The files of every thirteenth run hold values that aren't numbers and give no rows."""
    text = "concat_ws(',', event_id, if(user_id % 13 = 0, 'n/a', number), event_type)"
    body = with_header(lines(events(spark, d), text, "'amounts.csv'"), "read_id,amount,kind")
    rows, _ = csvfiles.declared(body, "read_id long, amount double, kind string")
    return rows.select("id", "read_id", "amount", "kind")


@query("csv_headerless", "SELECT o_orderkey AS id, o_custkey AS start_ns, o_totalprice AS price FROM orders")
def csv_headerless(spark: SparkSession, d: str) -> DataFrame:
    body = lines(table(spark, d, "orders"), "concat_ws(',', o_custkey, cast(cast(o_totalprice as decimal(18,2)) as string))", "'plain.csv'", "o_orderkey", "0")
    return csvfiles.declared(body, "start_ns long, price double", header=False)[0].select("id", "start_ns", "price")


@query("csv_inferred", "SELECT user_id AS id, event_id AS n, value AS x, event_type AS kind FROM events")
def csv_inferred(spark: SparkSession, d: str) -> DataFrame:
    body = with_header(lines(events(spark, d), "concat_ws(',', event_id, number, event_type)", "'any.csv'"), "n,x,kind")
    return csvfiles.inferred(body)[0].select("id", "n", "x", "kind")


@query("csv_crlf", """
SELECT user_id AS id, event_id AS n, value AS x, event_type AS kind, event_id AS read_id FROM events WHERE user_id % 2 = 0
UNION ALL SELECT user_id, event_id, value, event_type, NULL FROM events WHERE user_id % 2 = 1""")
def csv_crlf(spark: SparkSession, d: str) -> DataFrame:
    """Files of every second run end their lines with \\r\\n; those are read with known columns as well."""
    end = "if(user_id % 2 = 0, '\\r', '')"
    rows = events(spark, d)
    body = with_header(lines(rows, f"concat(concat_ws(',', event_id, number, event_type), {end})", "'any.csv'"), "n,x,kind")
    body = body.withColumn("line", F.when((F.col("line_no") == 0) & (F.col("id") % 2 == 0), F.concat("line", F.lit("\r"))).otherwise(F.col("line")))
    known = csvfiles.declared(body.filter("id % 2 = 0"), "n long, x double, kind string")[0].select("id", F.col("n").alias("read_id"), "n")
    return csvfiles.inferred(body)[0].select("id", "n", "x", "kind").join(known, ["id", "n"], "left").select("id", "n", "x", "kind", "read_id")


@query("csv_quoted", """
SELECT user_id AS id, event_id AS n, event_type || ', "' || event_id || '"' || chr(10) || 'more' || CASE WHEN event_id % 500 = 0 THEN repeat('"long" ', 3000) ELSE '' END AS "a,b", value AS n_duplicated_0, CAST(event_id * 1000000000000000000::DECIMAL(38,0) AS VARCHAR) AS big,
  CASE WHEN event_id % 2 = 0 THEN '' END AS note FROM events WHERE user_id % 7 <> 0""")
def csv_quoted(spark: SparkSession, d: str) -> DataFrame:
    """Cells that hold separators, quotes and line ends, some of them very long, a name that stands twice in the header, numbers beyond 64 bits and
    cells that are empty or quoted; each seventh run has records with a cell too many and gives no rows."""
    cell = "concat('\"', event_type, ', \"\"', event_id, '\"\"\\nmore', if(event_id % 500 = 0, repeat('\"\"long\"\" ', 3000), ''), '\"')"
    text = f"concat_ws(',', event_id, {cell}, number, cast(event_id * 1000000000000000000BD as decimal(38,0)), if(event_id % 2 = 0, '\"\"', ''), if(user_id % 7 = 0, 'x', null))"
    body = with_header(lines(events(spark, d), text, "'any.csv'"), 'n,"a,b",n,big,note')
    return csvfiles.inferred(body)[0].select("id", "n", "a,b", "n_duplicated_0", F.col("big").cast("string").alias("big"), "note")


@query("csv_versions", """
SELECT user_id AS id, event_id AS n, CASE WHEN user_id % 2 = 1 THEN value END AS added, event_type AS kind, 'n,added,kind,id' AS order_ FROM events""")
def csv_versions(spark: SparkSession, d: str) -> DataFrame:
    """Files of two header versions: the column that the newer one adds stands where it has it."""
    rows = events(spark, d)
    old = with_header(lines(rows.filter("user_id % 2 = 0"), "concat_ws(',', event_id, event_type)", "'git_info.csv'"), "n,kind")
    new = with_header(lines(rows.filter("user_id % 2 = 1"), "concat_ws(',', event_id, number, event_type)", "'git_info.csv'"), "n,added,kind")
    made, _ = T.git_info(old.unionByName(new))
    return made.select("*", F.lit(",".join(made.columns)).alias("order_"))


@query("sadf_issues", """
WITH bad AS (SELECT DISTINCT user_id FROM events WHERE event_id % 50 = 0)
SELECT user_id AS id, date_trunc('second', ts) AS timestamp, value AS "%user", NULL AS message FROM events WHERE user_id NOT IN (SELECT user_id FROM bad)
UNION ALL SELECT user_id, NULL, NULL, 'failed to parse for disk_sadf' FROM bad""")
def sadf_issues(spark: SparkSession, d: str) -> DataFrame:
    """A load export with a time that isn't one gives no rows but an issue."""
    text = "concat_ws(';', 'host', 60, if(event_id % 50 = 0, 'restart', date_format(ts, 'yyyy-MM-dd HH:mm:ss') || ' UTC'), number)"
    rows, issues = T.load_table(with_header(lines(events(spark, d), text, "'disk.sadf'"), "# hostname;interval;timestamp;%user"), "disk_sadf")
    told = issues.select("id", F.lit(None).cast("timestamp").alias("timestamp"), F.lit(None).cast("double").alias("%user"), "message")
    return rows.select("id", "timestamp", "%user", F.lit(None).cast("string").alias("message")).unionByName(told)


@query("csv_issues", """
WITH bad AS (SELECT DISTINCT user_id FROM events WHERE event_id % 60 = 0)
SELECT user_id AS id, event_type AS branch, event_id AS commits, NULL AS message FROM events WHERE user_id NOT IN (SELECT user_id FROM bad)
UNION ALL SELECT user_id, NULL, NULL, 'failed to parse for git_info' FROM bad""")
def csv_issues(spark: SparkSession, d: str) -> DataFrame:
    """A file with a record of too few cells is an issue of its own."""
    body = with_header(lines(events(spark, d), "concat_ws(',', event_type, if(event_id % 60 = 0, null, event_id))", "'git_info.csv'"), "branch,commits")
    rows, issues = T.git_info(body)
    told = issues.select("id", F.lit(None).cast("string").alias("branch"), F.lit(None).cast("bigint").alias("commits"), "message")
    return rows.select("id", "branch", "commits", F.lit(None).cast("string").alias("message")).unionByName(told)


@query("dacapo_latency", """
SELECT l_orderkey * 1000 AS start_ns, l_suppkey AS owner, CASE WHEN l_partkey % 17 <> 0 THEN l_partkey END AS duration_ns, l_linenumber::BIGINT AS iteration,
  'simple_' || l_returnflag AS latency_type, l_orderkey AS id FROM lineitem""")
def dacapo_latency(spark: SparkSession, d: str) -> DataFrame:
    """One request in seventeen ends before it starts, which has no duration."""
    text = "concat_ws(',', l_orderkey * 1000, l_orderkey * 1000 + if(l_partkey % 17 = 0, -1, l_partkey), l_suppkey)"
    body = lines(table(spark, d, "lineitem"), text, "concat('dacapo-latency-usec-simple-', l_returnflag, '-', l_linenumber, '.csv')", "l_orderkey", "0")
    return T.dacapo_latency(route_files(body, ("dacapo_latency",)))[0]


@query("union_files", "SELECT l_orderkey AS id, l_suppkey AS owner, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_linenumber::BIGINT END AS iteration FROM lineitem")
def union_files(spark: SparkSession, d: str) -> DataFrame:
    """Files of one table in one frame, whichever columns each has."""
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_suppkey").alias("owner"), F.col("l_linenumber").cast("bigint").alias("iteration"), "l_returnflag")
    parts = [rows.filter(F.col("l_returnflag") == f) for f in ("A", "N")] + [rows.filter("l_returnflag = 'R'").drop("iteration")]
    return union_tables(parts).drop("l_returnflag")


@query("mark_abuse", """
SELECT date_trunc('millisecond', ts) AS timestamp, event_id AS gc_time_delta_ms, CAST(trunc(value * 1000000.0::DOUBLE) AS BIGINT) AS time_us, user_id % 4 AS process, user_id AS id FROM events""")
def mark_abuse(spark: SparkSession, d: str) -> DataFrame:
    text = "concat_ws(',', floor(unix_micros(cast(ts as timestamp)) / 1000), event_id, number)"
    body = with_header(lines(events(spark, d), text, "concat('mark_abuse', user_id % 4, '.csv')"), "timestamp_ms,gc_time_delta_ms,time_s")
    return T.mark_abuse(route_files(body, ("mark_abuse",)))[0]


@query("threadstat_event", "SELECT event_id AS read_id, CASE WHEN event_type <> 'click' THEN event_id * 3 END AS count, event_id % 5 AS event_id, user_id AS id FROM events WHERE event_type <> 'error'")
def threadstat_event(spark: SparkSession, d: str) -> DataFrame:
    text = "concat_ws(',', event_id, case event_type when 'error' then -1 when 'click' then -7 else event_id * 3 end, event_id % 5)"
    return T.threadstat_event(with_header(lines(events(spark, d), text, "'threadstat-event.csv'"), "read_id,count,event_id"))[0]


@query("threadstat_read", """
SELECT event_id AS read_id, date_trunc('microsecond', ts) AS timestamp, epoch_us(ts) * 1000 + 123 AS timestamp_ns, event_id * 2 AS time_running, event_id * 3 AS time_enabled, user_id AS id FROM events""")
def threadstat_read(spark: SparkSession, d: str) -> DataFrame:
    text = "concat_ws(',', event_id, unix_micros(cast(ts as timestamp)) * 1000 + 123, event_id * 2, event_id * 3)"
    return T.threadstat_read(with_header(lines(events(spark, d), text, "'threadstat-read.csv'"), "read_id,timestamp,time_running,time_enabled"))[0]


@query("threadstat_description", "SELECT event_id, event_type AS name, user_id * 2 AS pid, user_id AS id FROM events")
def threadstat_description(spark: SparkSession, d: str) -> DataFrame:
    body = lines(events(spark, d), "concat_ws(',', event_id, event_type, user_id * 2)", "'threadstat-event-description.csv'")
    return T.threadstat_description(with_header(body, "event_id,name,pid"))[0]


_LOAD = "concat_ws(';', 'host', 60, date_format(ts, 'yyyy-MM-dd HH:mm:ss') || ' UTC', event_id % 9 - 1, number, cast(cast(value + 1 as decimal(12,3)) as string))"
_LOAD_HEAD = "# hostname;interval;timestamp;CPU;%user;%idle[...]"


def _load_lines(spark: SparkSession, d: str) -> DataFrame:
    return with_header(lines(events(spark, d), _LOAD, "'cpu_all_cores.sadf'"), _LOAD_HEAD)


@query("csv_sadf", "SELECT 'host' AS hostname, 60::BIGINT AS interval, event_id % 9 - 1 AS CPU, value AS \"%user\", user_id AS id FROM events")
def csv_sadf(spark: SparkSession, d: str) -> DataFrame:
    return csvfiles.inferred(_load_lines(spark, d), sep=";", comment="# ")[0].select("hostname", "interval", "CPU", "%user", "id")


@query("sadf_per_core", "SELECT date_trunc('second', ts) AS timestamp, event_id % 9 - 1 AS CPU, value AS \"%user\", user_id AS id FROM events WHERE event_id % 9 <> 0")
def sadf_per_core(spark: SparkSession, d: str) -> DataFrame:
    return T.load_table(_load_lines(spark, d), "cpu_all_cores_sadf")[0].select("timestamp", "CPU", "%user", "id")


@query("sadf_tables", """
SELECT 'cpu_sadf' AS made, date_trunc('second', ts) AS timestamp, event_id % 9 - 1 AS CPU, value AS \"%user\", NULL::DOUBLE AS \"kbmemfree\", user_id AS id FROM events
UNION ALL SELECT 'memory_sadf', date_trunc('second', ts), NULL, NULL, value, user_id FROM events""")
def sadf_tables(spark: SparkSession, d: str) -> DataFrame:
    cpu = with_header(lines(events(spark, d), f"replace({_LOAD}, ';', ',')", "'cpu_data.csv'"), _LOAD_HEAD[2:].replace(";", ","))
    memory_text = "concat_ws(';', 'host', 60, date_format(ts, 'yyyy-MM-dd HH:mm:ss') || ' UTC', number, 1, 2)"
    memory = with_header(lines(events(spark, d), memory_text, "'memory.sadf'"), "# hostname;interval;timestamp;kbmemfree;%memused;%commit")
    made = [T.load_table(cpu, "cpu_sadf", ",")[0].withColumn("made", F.lit("cpu_sadf")), T.load_table(memory, "memory_sadf")[0].withColumn("made", F.lit("memory_sadf"))]
    return union_tables(made).select("made", "timestamp", "CPU", "%user", "kbmemfree", "id")


@query("project_except", "SELECT event_id, user_id, value FROM events")
def project_except(spark: SparkSession, d: str) -> DataFrame:
    return S.without(table(spark, d, "events"), "ts", "event_type", "props", "not_there")


@query("prefix_rename", "SELECT event_id, value AS \"%idle\", event_type FROM events")
def prefix_rename(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select("event_id", F.col("value").alias("%idle[...]"), "event_type")
    return S.rename_prefix(S.rename_prefix(rows, "%idle[", "%idle"), "%nothing[", "%none")


@query("time_table", "SELECT event_id AS elapsed, CASE WHEN event_id % 10 <> 0 THEN event_id % 200 END AS cpu_percent, user_id AS id FROM events")
def time_table(spark: SparkSession, d: str) -> DataFrame:
    body = lines(events(spark, d), "concat_ws(',', event_id, if(event_id % 10 = 0, '?', concat(event_id % 200, '%')))", "'jvm0.time'")
    return T.time_table(with_header(body, "elapsed,cpu_percent"))[0]


@query("git_info", "SELECT 'repo' || (event_id % 3) AS repository, event_type AS branch, event_id AS commits, user_id AS id FROM events")
def git_info(spark: SparkSession, d: str) -> DataFrame:
    body = lines(events(spark, d), "concat_ws(',', concat('repo', event_id % 3), event_type, event_id)", "'git_info.csv'")
    return T.git_info(with_header(body, "repository,branch,commits"))[0]
