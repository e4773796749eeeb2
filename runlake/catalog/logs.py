"""Queries of the extraction from log text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import extract as X
from ..operators import reduce as R
from .registry import CLOCK, events, lines, query


@query("zgc_gc_summary", f"""
SELECT {CLOCK} AS end_time, event_id AS gc_number, CASE WHEN event_id % 2 = 1 THEN 'minor' ELSE 'major' END AS type, event_type AS cause,
  event_id AS start_memory_mb, CAST(event_id % 100 AS SMALLINT) AS start_percent, event_id // 2 AS end_memory_mb, CAST(event_id % 50 AS SMALLINT) AS end_percent,
  CAST(trunc(value * 1000000.0::DOUBLE) AS BIGINT) AS time_us, user_id AS id FROM events""")
def zgc_gc_summary(spark: SparkSession, d: str) -> DataFrame:
    head = "concat('[', clock, '][info   ][gc          ] GC(', event_id, ') ', if(event_id % 2 = 1, 'Minor', 'Major'), ' Collection (', event_type, ')')"
    tail = "concat(' ', event_id, 'M(', event_id % 100, '%)->', event_id div 2, 'M(', event_id % 50, '%) ', number, 's')"
    return X.zgc_gc_summary(lines(events(spark, d), f"array({head}, concat({head}, {tail}))", "'gc.javalog'"))[0]


@query("zgc_phases", f"""
SELECT {CLOCK} AS clock_time, event_id AS gc_number, CASE WHEN event_id % 4 IN (0, 2) THEN 'y' ELSE 'o' END AS age,
  CASE WHEN event_id % 4 < 2 THEN 'major' ELSE 'minor' END AS type, 'Pause ' || event_type AS name,
  CAST(trunc(value * 1000.0::DOUBLE) AS BIGINT) AS time_us, {CLOCK} - to_milliseconds(CAST(trunc(value) AS BIGINT)) AS start_time, user_id AS id FROM events""")
def zgc_phases(spark: SparkSession, d: str) -> DataFrame:
    text = "concat('[', clock, '][info   ][gc,phases   ] GC(', event_id, ') ', element_at(array('Y', 'O', 'y', 'o'), cast(event_id % 4 as int) + 1), ': Pause ', event_type, ' ', number, 'ms')"
    decoy = "concat('[', clock, '][info   ][gc,phases   ] GC(', event_id, ') Q: Pause ', event_type, ' ', number, 'ms')"
    return X.zgc_phases(lines(events(spark, d), f"array({text}, {decoy})", "'gc.javalog'"))[0]


@query("zgc_stats", f"""
SELECT {CLOCK} AS clock_time, 'Critical' AS stat_type, 'Allocation ' || event_type AS name, CASE WHEN event_type = 'error' THEN 'ms' ELSE 'ops/s' END AS unit,
  round(value, 3) AS last_10s_avg, round(value + 1, 3) AS last_10s_max, round(value + 2, 3) AS last_10m_avg, round(value + 3, 3) AS last_10m_max,
  round(value + 4, 3) AS last_10h_avg, round(value + 5, 3) AS last_10h_max, round(value + 6, 3) AS total_avg, round(value + 7, 3) AS total_max, user_id AS id FROM events""")
def zgc_stats(spark: SparkSession, d: str) -> DataFrame:
    n = lambda k: f"cast(cast(value as decimal(12,3)) + {k} as string)"
    pairs = ", '     ', ".join(f"{n(k)}, ' / ', {n(k + 1)}" for k in (0, 2, 4, 6))
    text = f"concat('[', clock, '][info   ][gc,stats    ]       Critical: Allocation ', event_type, '      ', {pairs}, '     ', if(event_type = 'error', 'ms', 'ops/s'))"
    rows = X.zgc_stats(lines(events(spark, d), f"array({text}, concat('[', clock, '][info   ][gc,stats    ] === Garbage Collection Statistics ==='))", "'gc.javalog'"))[0]
    return rows.withColumns({c: F.round(c, 3) for c in rows.columns if c.endswith(("_avg", "_max"))})


@query("zgc_task_workers", """
SELECT event_id AS gc_number, CASE WHEN event_id % 4 IN (0, 3) THEN 'y' ELSE 'o' END AS age, event_id % 16 AS num_workers, user_id AS id FROM events""")
def zgc_task_workers(spark: SparkSession, d: str) -> DataFrame:
    text = "concat('[', clock, '][info   ][gc,task     ] GC(', event_id, ') Using ', event_id % 16, ' Workers for ', element_at(array('Young', 'OLD', 'old', 'young'), cast(event_id % 4 as int) + 1), ' Generation')"
    return X.zgc_task_workers(lines(events(spark, d), f"array({text}, replace({text}, 'Workers for', 'workers of'))", "'jvm0.txt'"))[0]


_MS = "floor(value * 4) / 4"


def _g1_lines(spark: SparkSession, d: str) -> DataFrame:
    number = "event_id div 500"
    kinds = "case event_type when 'click' then 'Pause Young (Normal) (G1 Evacuation Pause) 10M->5M(20M) 1.5ms' when 'view' then 'Pause Remark 12M->12M(20M) 0.5ms' when 'signup' then 'Concurrent Mark Cycle' when 'purchase' then 'Concurrent Undo Cycle 3.1ms' end"
    type_line = f"concat('[', clock, '][info   ][gc          ] GC(', {number}, ') ', {kinds})"
    phase_line = f"concat('[', clock, '][info   ][gc,phases   ] GC(', {number}, ')   Evacuate ', if(event_id % 2 = 0, 'even', 'odd'), ':  ', cast(cast({_MS} as decimal(12,2)) as string), 'ms')"
    trailer = f"if({kinds} is null, array({phase_line}), array({type_line}, {phase_line}))"
    exploded = events(spark, d).select("user_id", "event_id", F.posexplode(F.expr(trailer)).alias("k", "text"))
    return lines(exploded, "text", "'gc.javalog'", "user_id", "event_id * 2 + k")


_G1_TYPES = """types AS (
  SELECT user_id, event_id // 500 AS gc, arg_min(CASE event_type WHEN 'click' THEN 'Pause Young (Normal)' WHEN 'view' THEN 'Pause Remark' ELSE 'Concurrent Undo Cycle' END, event_id) AS gc_type
  FROM events WHERE event_type IN ('click', 'view', 'purchase') GROUP BY 1, 2)"""


@query("g1_phases", f"""
WITH {_G1_TYPES}, phases AS (SELECT *, event_id // 500 AS gc, floor(value * 4) / 4 AS ms FROM events),
summed AS (SELECT *, sum(ms) OVER (PARTITION BY user_id, gc ORDER BY event_id DESC ROWS UNBOUNDED PRECEDING) AS rest FROM phases)
SELECT {CLOCK} AS clock_time, gc AS gc_number, coalesce(gc_type, '') AS gc_type, 'Evacuate ' || CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END AS name,
  CAST(trunc(ms * 1000.0::DOUBLE) AS BIGINT) AS time_us, {CLOCK} - to_milliseconds(CAST(trunc(rest) AS BIGINT)) AS start_time, user_id AS id
FROM summed LEFT JOIN types USING (user_id, gc)""")
def g1_phases(spark: SparkSession, d: str) -> DataFrame:
    return X.g1_phases(_g1_lines(spark, d))[0]


@query("java_threads", """
WITH created AS (SELECT user_id AS id, event_id % 40 AS pid, arg_max(event_type || ' thread ' || event_id, event_id) AS thread_name, arg_max(event_type, event_id) AS thread_type
  FROM events WHERE event_type IN ('signup', 'view') GROUP BY 1, 2)
SELECT pid, thread_name, thread_type, id FROM created
UNION ALL
SELECT DISTINCT e.event_id % 40, 'unknown', 'unknown', e.user_id FROM events e
WHERE e.event_type = 'click' AND NOT EXISTS (SELECT 1 FROM created c WHERE c.id = e.user_id AND c.pid = e.event_id % 40)""")
def java_threads(spark: SparkSession, d: str) -> DataFrame:
    return X.java_threads(_thread_lines(spark, d))[0]


def _thread_lines(spark: SparkSession, d: str) -> DataFrame:
    created = "concat('[', clock, '][info][os,thread] Thread created tid: ', event_id % 40, ', name:\"', event_type, ' thread ', event_id, '\", thread_type:\"', event_type, '\"')"
    attached = "concat('[', clock, '][info][os,thread] Thread attached (tid: ', event_id % 40, ', pthread id: 7)')"
    ended = "concat('[', clock, '][info][os,thread] Thread finished (tid: ', event_id % 40, ', pthread id: 7)')"
    return lines(events(spark, d), f"case when event_type in ('signup', 'view') then {created} when event_type = 'click' then {attached} else {ended} end", "'os.javalog'")


@query("attached_anti_join", """
SELECT DISTINCT e.user_id AS id, e.event_id % 40 AS pid FROM events e WHERE e.event_type = 'click'
AND NOT EXISTS (SELECT 1 FROM events c WHERE c.event_type IN ('signup', 'view') AND c.user_id = e.user_id AND c.event_id % 40 = e.event_id % 40)""")
def attached_anti_join(spark: SparkSession, d: str) -> DataFrame:
    made, attached = (X.extract(_thread_lines(spark, d), g, "java_threads")[0] for g in (X.CREATED, X.ATTACHED))
    return R.only_in(attached, made, ["id", "pid"])


@query("dacapo_iteration", """
SELECT row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS dacapo_iteration, CAST(value * 100 AS INT)::BIGINT AS dacapo_iteration_time_ms, user_id AS id
FROM events WHERE event_type = 'purchase'""")
def dacapo_iteration(spark: SparkSession, d: str) -> DataFrame:
    ms = "cast(round(value * 100) as bigint)"
    text = f"case when event_type = 'purchase' then concat('===== DaCapo 23.11 h2 ', if(event_id % 2 = 0, 'completed warmup 1 in ', 'PASSED in '), {ms}, ' msec =====') when event_type = 'error' then concat('DaCapo h2 in 99999999999999999999', event_id, ' msec') else concat('starting in ', {ms}, ' msec') end"
    return X.dacapo_iteration(lines(events(spark, d), text, "'jvm0.stdout'"))[0]


@query("specjbb_summary", """
SELECT CASE WHEN event_id % 3 = 0 THEN 'metric.max-jOPS' WHEN event_id % 3 = 1 THEN 'metric.critical-jOPS' ELSE 'SLA-' || (event_id % 7 * 1000 + 1000) || '-jOPS' END AS metric,
  CAST(floor(value) AS BIGINT) AS value, user_id AS id FROM events""")
def specjbb_summary(spark: SparkSession, d: str) -> DataFrame:
    metric = "case event_id % 3 when 0 then 'metric.max-jOPS' when 1 then 'metric.critical-jOPS' else concat('SLA-', event_id % 7 * 1000 + 1000, '-jOPS') end"
    text = f"concat('jbb2015.result.', {metric}, ' = ', cast(floor(value) as bigint))"
    return X.specjbb_summary(lines(events(spark, d), f"array({text}, 'jbb2015.result.metric.mean-jOPS = 5')", "'run-0001.raw'"))[0]


_PROFILE_FIELDS = """CASE event_id % 5 WHEN 0 THEN 'PROFILE' WHEN 1 THEN 'RT_CURVE' WHEN 2 THEN 'VALIDATION' WHEN 3 THEN 'TRANSITION' ELSE 'WARMUP' END AS phase,
  event_id AS requested_ir, event_id // 2 AS achieved_ir, event_id // 3 AS passed_requests, CAST(floor(value) AS BIGINT) AS total_passed_requests, user_id AS id"""
_ODD = "CASE WHEN month(ts) % 2 = 1 THEN INTERVAL 4 HOUR ELSE INTERVAL 5 HOUR END"
_FOREIGN = "user_id = (SELECT min(user_id) FROM events)"


def _profile_lines(spark: SparkSession, d: str) -> DataFrame:
    """Controller logs; the run of the smallest id is in a zone that isn't known."""
    rows = events(spark, d)
    first = rows.agg(F.min("user_id").alias("first_user"))
    rows = rows.join(F.broadcast(first), rows["user_id"] == first["first_user"], "left")  # one row
    zone = "case when first_user is not null then 'PST' when month(ts) % 2 = 1 then 'EDT' else 'EST' end"
    phase = "element_at(array('PROFILE', 'RT_CURVE', 'VALIDATION', 'TRANSITION', 'WARMUP'), cast(event_id % 5 as int) + 1)"
    text = f"concat('<', date_format(if(event_id % 6 = 0, ts + interval 1 day, ts), 'EEE'), ' ', date_format(ts, 'MMM d HH:mm:ss'), ' ', {zone}, ' ', year(ts), '> org.spec.jbb.controller: ', {phase}, ': steady, (rIR:aIR:PR = ', event_id, ':', event_id div 2, ':', event_id div 3, ') (tPR = ', cast(floor(value) as bigint), ') [OK]')"
    return lines(rows, text, "'spec-Controller.log'")


@query("specjbb_profile", f"SELECT CASE WHEN event_id % 6 <> 0 THEN date_trunc('second', ts) + {_ODD} END AS clock_time, {_PROFILE_FIELDS} FROM events WHERE NOT {_FOREIGN}")
def specjbb_profile(spark: SparkSession, d: str) -> DataFrame:
    """Each sixth line has a weekday that its date doesn't have, which gives no time."""
    return X.specjbb_profile(_profile_lines(spark, d))[0]


@query("zone_abbreviations", f"SELECT event_id, CASE WHEN user_id % 5 = 0 THEN NULL ELSE date_trunc('second', ts) + {_ODD} END AS clock_time FROM events")
def zone_abbreviations(spark: SparkSession, d: str) -> DataFrame:
    zone = F.expr("case when user_id % 5 = 0 then 'PST' when month(ts) % 2 = 1 then 'EDT' else 'EST' end")
    parts = [F.date_format("ts", p) for p in ("MMM", "d", "HH:mm:ss")]
    return events(spark, d).select("event_id", C.parse_zoned(*parts, zone, F.date_format("ts", "yyyy"), F.date_format("ts", "EEE")).alias("clock_time"))


@query("parse_timestamps", f"""
SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN {CLOCK} END AS iso_time, CASE WHEN event_id % 10 <> 1 THEN date_trunc('second', ts) END AS load_time, event_id % 10 = 1 AS load_fails FROM events""")
def parse_timestamps(spark: SparkSession, d: str) -> DataFrame:
    """A text that isn't an ISO time has none; one without a load export's time fails its file (see sadf_issues)."""
    iso = F.expr("if(event_id % 10 = 0, replace(clock, 'T', ' at '), clock)")
    load = F.concat(F.lit("at "), F.when(F.expr("event_id % 10 = 1"), F.date_format("ts", "yyyy-MM")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")), F.lit(" UTC"))
    return events(spark, d).select("event_id", C.parse_iso(iso).alias("iso_time"), C.parse_sadf(load).alias("load_time"), (load.isNotNull() & C.parse_sadf(load).isNull()).alias("load_fails"))


@query("epoch_timestamps", """
SELECT event_id, date_trunc('millisecond', ts) AS from_ms, date_trunc('microsecond', ts) AS from_ns, epoch_us(ts) * 1000 + 7 AS ns FROM events""")
def epoch_timestamps(spark: SparkSession, d: str) -> DataFrame:
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    rows = events(spark, d).select("event_id", F.floor(us / 1000).cast("bigint").alias("ms"), (us * 1000 + 7).alias("ns"))
    return rows.select("event_id", C.from_epoch_ms(F.col("ms")).alias("from_ms"), C.from_epoch_ns(F.col("ns")).alias("from_ns"), "ns")


@query("duration_micros", """
SELECT event_id, CAST(trunc(value * 1000.0::DOUBLE) AS BIGINT) AS from_ms_us, CAST(trunc(value * 1000000.0::DOUBLE) AS BIGINT) AS from_s_us,
  date_trunc('millisecond', ts) - to_milliseconds(CAST(trunc(value) AS BIGINT)) AS before, CASE WHEN event_id >= user_id THEN event_id - user_id END AS gap FROM events""")
def duration_micros(spark: SparkSession, d: str) -> DataFrame:
    value = C.to_float(F.col("number"))
    return events(spark, d).select("event_id", C.to_micros(value, 1e3).alias("from_ms_us"), C.to_micros(value, 1e6).alias("from_s_us"), C.minus_ms(F.col("ts").cast("timestamp"), value).alias("before"), C.unsigned_diff(F.col("event_id"), F.col("user_id")).alias("gap"))


@query("scalar_functions", """
SELECT event_id, event_type AS trimmed, upper(event_type) = event_type AS is_upper, CASE WHEN event_id % 10 = 0 THEN NULL ELSE event_id END AS n, value AS x,
  printf('%016X', event_id) AS hex_id, CASE WHEN event_id % 2 = 0 THEN event_type ELSE event_type || '%' END AS stripped, CAST(trunc(value) AS BIGINT) AS whole,
  CASE WHEN event_type LIKE 'p%' THEN substr(event_type, 2) ELSE event_type END AS tail, replace('a-' || event_type, '-', '_') AS replaced FROM events""")
def scalar_functions(spark: SparkSession, d: str) -> DataFrame:
    padded = F.concat(F.lit("  \t"), F.col("event_type"), F.lit(" \n "))
    return events(spark, d).select(
        "event_id",
        C.trim_ws(padded).alias("trimmed"),
        (F.col("event_type") == F.upper("event_type")).alias("is_upper"),
        C.to_int(F.when(F.expr("event_id % 10 = 0"), F.lit("12x")).otherwise(F.col("event_id").cast("string"))).alias("n"),
        C.to_float(F.col("number")).alias("x"),
        C.zero_hex(F.col("event_id")).alias("hex_id"),
        C.strip_suffix(F.expr("if(event_id % 2 = 0, event_type || '%', event_type || '%%')"), "%").alias("stripped"),
        C.truncated(F.col("value")).alias("whole"),
        C.strip_prefix(F.col("event_type"), "p").alias("tail"),
        F.replace(F.concat(F.lit("a-"), "event_type"), F.lit("-"), F.lit("_")).alias("replaced"),
    )
