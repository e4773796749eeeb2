"""Queries of reductions, lookups, windows and data quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import extract as X
from ..operators import quality as Q
from ..operators import reduce as R
from ..plans.extractors import Extractor, StatefulExtractor, run_extractor, run_stateful, runs_of
from ..sources import archives, csvfiles
from ..sources.routing import Rule
from .registry import events, lines, query, table

_KEYED = "SELECT user_id, event_id // 500 AS grp, event_id, event_type, value FROM events"


def _keyed(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("user_id", F.expr("event_id div 500").alias("grp"), "event_id", "event_type", "value")


@query("first_wins", f"SELECT user_id, grp, arg_min(event_type, event_id) AS event_type FROM ({_KEYED}) GROUP BY 1, 2")
def first_wins(spark: SparkSession, d: str) -> DataFrame:
    return R.first_wins(_keyed(spark, d), ["user_id", "grp"], ["event_id"], "event_type")


@query("last_wins", f"SELECT user_id, grp, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM ({_KEYED}) GROUP BY 1, 2")
def last_wins(spark: SparkSession, d: str) -> DataFrame:
    return R.last_wins(_keyed(spark, d), ["user_id", "grp"], ["event_id"], ["event_type", "value"])


@query("lookup_join_default", f"""
WITH k AS ({_KEYED}), types AS (SELECT user_id, grp, arg_min(event_type, event_id) AS kind FROM k WHERE event_type NOT IN ('error', 'view') GROUP BY 1, 2)
SELECT event_id, user_id, grp, coalesce(kind, '') AS kind FROM k LEFT JOIN types USING (user_id, grp)""")
def lookup_join_default(spark: SparkSession, d: str) -> DataFrame:
    rows = _keyed(spark, d)
    types = R.first_wins(rows.filter("event_type not in ('error', 'view')"), ["user_id", "grp"], ["event_id"], "event_type").withColumnRenamed("event_type", "kind")
    return R.lookup_with_default(rows, types, ["user_id", "grp"], "kind").select("event_id", "user_id", "grp", "kind")


@query("suffix_sum", f"SELECT event_id, sum(floor(value * 4) / 4) OVER (PARTITION BY user_id, grp ORDER BY event_id DESC ROWS UNBOUNDED PRECEDING) AS rest FROM ({_KEYED})")
def suffix_sum(spark: SparkSession, d: str) -> DataFrame:
    rows = _keyed(spark, d).withColumn("ms", F.floor(F.col("value") * 4) / F.lit(4.0))
    return R.suffix_sum(rows, "ms", ["user_id", "grp"], ["event_id"], "rest").select("event_id", "rest")


@query("match_ordinal", "SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS at FROM events")
def match_ordinal(spark: SparkSession, d: str) -> DataFrame:
    return R.ordinal(table(spark, d, "events"), ["user_id"], ["event_id"], "at").select("event_id", "user_id", "at")


_NARROWED = ("l_orderkey", "l_partkey", "l_suppkey", "low", "flag")
_NARROW_SQL = "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber - 100 AS low, l_linenumber % 2 AS flag FROM lineitem"


@query("int_narrowing", " UNION ALL ".join(f"""
SELECT '{c}' AS name, CASE WHEN min({c}) >= -128 AND max({c}) < 128 THEN 'tinyint' WHEN min({c}) >= -32768 AND max({c}) < 32768 THEN 'smallint'
  WHEN min({c}) >= -2147483648 AND max({c}) < 2147483648 THEN 'int' ELSE 'bigint' END AS kind, CAST(sum({c}) AS BIGINT) AS total FROM ({_NARROW_SQL})""" for c in _NARROWED))
def int_narrowing(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", (F.col("l_linenumber") - 100).cast("bigint").alias("low"), (F.col("l_linenumber") % 2).cast("bigint").alias("flag"))
    narrow = R.narrow_ints(rows)
    sums = narrow.agg(*(F.sum(c).alias(c) for c in narrow.columns))
    kinds = dict(narrow.dtypes)
    return sums.select(F.explode(F.array(*(F.struct(F.lit(c).alias("name"), F.lit(kinds[c]).alias("kind"), F.col(c).cast("bigint").alias("total")) for c in narrow.columns))).alias("r")).select("r.*")


@query("run_status", """
WITH per AS (
  SELECT user_id AS id, CASE WHEN user_id % 5 = 0 THEN 'timeout' ELSE 'Success' END AS written,
    min(event_id % 8) FILTER (event_type = 'error' AND user_id % 3 = 0) AS runner, user_id % 7 = 0 AS marked, user_id % 11 = 0 AS lacking
  FROM events GROUP BY user_id)
SELECT id, CASE WHEN lacking THEN 'unknown' WHEN lower(written) <> 'success' THEN written WHEN runner IS NOT NULL THEN 'runner' || runner || ' exited with code 1'
  WHEN marked THEN 'resctrl_failed' ELSE written END AS status FROM per""")
def run_status(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").withColumnRenamed("user_id", "id")
    users = rows.select("id").distinct()
    status = users.filter("id % 11 <> 0").select("id", F.expr("if(id % 5 = 0, ' timeout\\n', 'Success \\n')").alias("text"))
    exits = R.last_wins(
        rows.select("id", (F.col("event_id") % 8).cast("int").alias("runner"), F.expr("event_type = 'error' and id % 3 = 0").cast("int").alias("code"), "event_id"), ["id", "runner"], ["code"], ["code"]
    )
    marks = users.select("id", F.expr("if(id % 7 = 0, '[1.2s] Resctrl: Failed to write', 'Resctrl: ok')").alias("line"))
    return R.run_status(users, status, exits, marks)


@query("first_file_wins", """
SELECT user_id AS id, event_id % 4 AS ord, event_id AS line_no, NULL AS message FROM events
QUALIFY event_id % 4 = min(event_id % 4) OVER (PARTITION BY user_id)
UNION ALL
SELECT DISTINCT user_id, event_id % 4, NULL::BIGINT, 'Duplicate file for git_info' FROM events QUALIFY event_id % 4 > min(event_id % 4) OVER (PARTITION BY user_id)""")
def first_file_wins(spark: SparkSession, d: str) -> DataFrame:
    routed = lines(events(spark, d), "number", "concat('copy', event_id % 4, '/git_info.csv')").withColumn("ord", (F.col("line_no") % 4).cast("bigint"))
    rows, issues = Q.first_file_wins(routed, "git_info")
    told = issues.select("id", F.substring("name", 5, 1).cast("bigint").alias("ord"), F.lit(None).cast("bigint").alias("line_no"), "message")
    return rows.select("id", "ord", "line_no", F.lit(None).cast("string").alias("message")).unionByName(told)


@query("table_collision", """
SELECT user_id AS id, 'table made twice: ' || event_type AS message FROM (SELECT DISTINCT user_id, event_type, event_id % 3 AS collector FROM events) GROUP BY user_id, event_type HAVING count(*) > 1""")
def table_collision(spark: SparkSession, d: str) -> DataFrame:
    made = table(spark, d, "events").select(F.col("user_id").alias("id"), (F.col("event_id") % 3).alias("collector"), F.col("event_type").alias("table")).distinct()
    return Q.assert_unique_tables(made).select("id", "message")


@query("value_constraints", """
SELECT o_orderkey AS id, CASE WHEN o_custkey % 7 = 0 THEN 'timeout is zero' WHEN o_custkey % 7 = 1 THEN 'timeout is negative' WHEN o_orderkey % 11 = 0 THEN 'memory_ratio is negative'
  WHEN o_orderkey % 11 = 1 THEN 'memory_ratio is zero' WHEN o_orderkey % 11 = 2 THEN 'memory_ratio is not a number' END AS reason FROM orders""")
def value_constraints(spark: SparkSession, d: str) -> DataFrame:
    ratio = "case o_orderkey % 11 when 0 then -0.0D when 1 then 0.0D when 2 then double('NaN') when 3 then double('Infinity') else o_totalprice end"
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.expr("case o_custkey % 7 when 1 then -5L when 2 then null else o_custkey % 7 end").alias("timeout"), F.expr(ratio).alias("memory_ratio"))
    ok, rejects = Q.validate(rows, on_error="keep")
    return ok.select("id", F.lit(None).cast("string").alias("reason")).unionByName(rejects.select("id", "reason"))


def _overflowing(spark: SparkSession, d: str) -> DataFrame:
    """Worker lines; a run whose id is divisible by nine writes one number too large for its type in its last line."""
    number = "if(user_id % 9 = 0 and event_id % 5 = 0, '99999999999', cast(event_id as string))"
    return lines(events(spark, d), f"concat('[', clock, '][info][gc,task] GC(', {number}, ') Using ', event_id % 16, ' Workers for Old Generation')", "'gc.javalog'")


@query("parse_issues", """
WITH bad AS (SELECT DISTINCT user_id FROM events WHERE user_id % 9 = 0 AND event_id % 5 = 0)
SELECT user_id AS id, event_id AS gc_number, NULL AS message FROM events WHERE user_id NOT IN (SELECT user_id FROM bad)
UNION ALL SELECT user_id, NULL, 'failed to parse for zgc_task_workers' FROM bad""")
def parse_issues(spark: SparkSession, d: str) -> DataFrame:
    rows, issues = X.zgc_task_workers(_overflowing(spark, d))
    return rows.select("id", "gc_number", F.lit(None).cast("string").alias("message")).unionByName(issues.select("id", F.lit(None).cast("bigint").alias("gc_number"), "message"))


@query("run_failures", "SELECT user_id AS id, event_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND event_id % 10 = 0)")
def run_failures(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select(F.col("user_id").alias("id"), "event_id", "event_type")
    issues = Q.issue(rows.filter("event_type = 'error' and event_id % 10 = 0"), "run", None, F.lit("cannot read archive"))
    return Q.withhold(rows, issues).select("id", "event_id")


@query("custom_extractor", "SELECT doc_id AS id, lang AS language, source AS origin, n_chars AS size FROM documents")
def custom_extractor(spark: SparkSession, d: str) -> DataFrame:
    """A format of one's own: a line for each document, with what is known of it."""
    text = "array(concat('doc lang=', lang, ' source=', source, ' chars=', n_chars), concat('note lang=', lang))"
    body = lines(table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars"), text, "'docs.log'", "doc_id", "0")
    own = Extractor("docs", (Rule("docs", r"^docs\.log$"),), X.Grammar("doc lang=", r"doc lang=(\S+) source=(\S+) chars=(\d+)", {"language": X.text, "origin": X.text, "size": X.C.to_int}))
    rows, _ = run_extractor(own, body)
    return rows.select("id", "language", "origin", "size")


class _Scaled:
    """Keeps the factors of the first file, which its run's timeout multiplies, for the events of the second."""

    def __init__(self, run: dict):
        self.times, self.factors, self.n = run["timeout"], {}, 0

    def read(self, name: str, lines: list[str], first: int):
        for line in lines:
            kind, number = line.rsplit(" ", 1)
            if name == "factors.log":
                self.factors[kind] = int(number) * self.times
            else:
                self.n += 1
                yield "scaled", {"event_id": int(number), "value": int(number) + self.factors[kind]}

    def finish(self):
        yield "seen", {"events": self.n, "kinds": len(self.factors)}


@query("custom_stateful", """
WITH mine AS (SELECT user_id, event_id, event_id + min(event_id) OVER (PARTITION BY user_id, event_type) * (user_id % 5 + 1) AS value, event_type FROM events WHERE user_id % 3 <> 0)
SELECT 'scaled' AS made, user_id AS id, event_id, value FROM mine UNION ALL SELECT 'seen', user_id, count(*), count(DISTINCT event_type) FROM mine GROUP BY user_id""")
def custom_stateful(spark: SparkSession, d: str) -> DataFrame:
    """Two tables of a run from two of its files and one of its attributes; runs of another benchmark aren't touched."""
    rows = events(spark, d)
    factors = rows.groupBy("user_id", "event_type").agg(F.min("event_id").alias("event_id"))
    body = lines(factors, "concat(event_type, ' ', event_id)", "'factors.log'").unionByName(lines(rows, "concat(event_type, ' ', event_id)", "'events.log'").withColumn("ord", F.lit(1)))
    runs = rows.select(F.col("user_id").alias("id")).distinct().select("id", F.expr("if(id % 3 = 0, 'other', 'mine')").alias("benchmark"), (F.col("id") % 5 + 1).alias("timeout"))
    own = StatefulExtractor("scaling", (Rule("scaling", r"^(factors|events)\.log$"),), {"scaled": "event_id long, value long", "seen": "events long, kinds long"}, _Scaled, benchmarks=("mine",))
    mine = runs_of(own, runs)
    tables, _ = run_stateful(own, body.join(mine.select("id"), "id", "left_semi"), mine)
    scaled = tables["scaled"].select(F.lit("scaled").alias("made"), "id", "event_id", "value")
    return scaled.unionByName(tables["seen"].select(F.lit("seen").alias("made"), "id", F.col("events").alias("event_id"), F.col("kinds").alias("value")))


@query("issue_provenance", """
WITH bad AS (SELECT user_id, min(event_id) AS event_id FROM events WHERE user_id % 9 = 0 AND event_id % 5 = 0 GROUP BY 1)
SELECT user_id AS id, event_id AS line_no, 'gc_number' AS field, '99999999999' AS value,
  'gc.javalog: failed to parse for zgc_task_workers: line ' || (event_id + 1) || ', field gc_number, value ' || chr(39) || '99999999999' || chr(39) AS told FROM bad
UNION ALL SELECT user_id, event_id, 'amount', 'n/a' || event_id, 'threads.csv: failed to parse for amounts: line ' || (event_id + 1) || ', field amount, value ' || chr(39) || 'n/a' || event_id || chr(39) FROM bad""")
def issue_provenance(spark: SparkSession, d: str) -> DataFrame:
    """The line, field and value where a log and a CSV file failed first."""
    _, of_logs = X.zgc_task_workers(_overflowing(spark, d))
    text = "concat_ws(',', event_id, if(user_id % 9 = 0 and event_id % 5 = 0, concat('n/a', event_id), number))"
    body = lines(events(spark, d), text, "'threads.csv'")
    rows, bad = csvfiles.declared(body, "read_id long, amount double", header=False)
    _, of_csv = Q.kept_rows(rows, bad, body.select(*Q.FILE).distinct(), "amounts")
    return of_logs.unionByName(of_csv).select("id", "line_no", "field", "value", Q.told().alias("told"))


@query("status_issues", """
WITH users AS (SELECT DISTINCT user_id AS id FROM events)
SELECT id, CASE WHEN id % 5 = 0 THEN 'unknown' WHEN id % 5 = 1 THEN 'failed' WHEN id % 4 = 3 THEN 'runner7 exited with code 3' ELSE 'success' END AS told FROM users
UNION ALL SELECT id, 'status.txt: invalid UTF-8 for status' FROM users WHERE id % 5 = 0
UNION ALL SELECT id, 'status.txt: Duplicate file for status' FROM users WHERE id % 5 = 2
UNION ALL SELECT id, 'runner7.exit: failed to parse for status: line 1, field exit code, value ' || chr(39) || CASE id % 4 WHEN 0 THEN 'x' ELSE '0' END || chr(39) FROM users WHERE id % 4 < 2""")
def status_issues(spark: SparkSession, d: str) -> DataFrame:
    """Status files twice or not UTF-8, exit codes that are no number, or two: issues, and no part of the outcome."""
    users = events(spark, d).select("user_id").distinct()
    said = "array(if(user_id % 5 = 0, unhex('FF'), encode(if(user_id % 5 = 1, ' failed ', 'success'), 'utf-8')))"
    again = lines(users.filter("user_id % 5 = 2"), "array(encode('late', 'utf-8'))", "'status.txt'", "user_id", "0").withColumn("ord", F.lit(4))
    raw = lines(users, said, "'status.txt'", "user_id", "0").unionByName(again)
    text, bad = archives.as_text(raw.withColumn("error", F.lit(None).cast("string")))
    files = raw.select(*Q.FILE).distinct().join(bad.withColumn("fault", F.lit("invalid UTF-8")), Q.FILE, "left")
    codes = "case user_id % 4 when 0 then array('x') when 1 then array('0', '1') when 3 then array('', ' 3 ') else array('0') end"
    exits = lines(users.select("user_id", F.posexplode(F.expr(codes)).alias("at", "code")), "code", "'runner7.exit'", "user_id", "at").withColumns({"ord": F.lit(1), "runner": F.lit("7")})
    logs = lines(users, "'nothing'", "'os.javalog'", "user_id", "0").withColumn("ord", F.lit(2))
    rows, issues = R.run_outcomes(users.select(F.col("user_id").alias("id")), (text, files), (exits, exits.select(*Q.FILE).distinct()), (logs, logs.select(*Q.FILE).distinct()))
    return rows.select("id", F.col("status").alias("told")).unionByName(issues.select("id", Q.told().alias("told")))
