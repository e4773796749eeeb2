"""Declared schemas: run attributes, scanned log lines, issues, and tables of known columns."""

from __future__ import annotations

from pyspark.sql import types as T

#: What a kind of attribute is to Spark: text, whole numbers above zero and from zero, numbers above zero, truth, 0 to 255.
TYPES = {"text": T.StringType(), "positive": T.LongType(), "natural": T.LongType(), "positive number": T.DoubleType(), "boolean": T.BooleanType(), "byte": T.ShortType()}

# The run attributes in declaration order, and what kind of value each has.
REQUIRED_KINDS = {"benchmark": "text", "tar_file": "text", "iteration": "natural"}
OPTIONAL_KINDS = {
    "timeout": "positive",
    "cpu_mask": "positive",
    "jdk": "text",
    "process_count": "positive",
    "gc": "text",
    "classpath": "text",
    "gc_logging": "text",
    "java_log_gc": "text",
    "java_log_os": "text",
    "memory_ratio": "positive number",
    "memory_config": "positive",
    "softmax": "text",
    "softmax_ratio": "positive number",
    "concgcthreads": "positive",
    "jdk_tiered_compilation": "boolean",
    "zgc_barrier_use_global_variable": "boolean",
    "zgc_barrier_rewrite_on_phase_change": "boolean",
    "GCThreadCPUs": "text",
    "NonGCThreadCPUs": "text",
    "zgc_deactivate_proactive": "boolean",
    "opp_zgc": "boolean",
    "opp_zgc_period": "positive",
    "opp_zgc_minor_threshold": "natural",
    "opp_zgc_major_threshold": "natural",
    "opp_zgc_avg_cpu_window": "positive",
    "java_thp": "boolean",
    "ResctrlIdleGCMask": "positive",
    "ResctrlMarkingGCMask": "positive",
    "ResctrlCollectingGCMask": "positive",
    "ResctrlIdleAppMask": "positive",
    "ResctrlMarkingAppMask": "positive",
    "ResctrlCollectingAppMask": "positive",
    "dacapo_benchmark": "text",
    "dacapo_location": "text",
    "dacapo_threads": "positive",
    "dacapo_harness": "text",
    "specjbb_location": "text",
    "specjbb_props": "text",
    "specjbb_opts": "text",
    "specjbb_args": "text",
    "specjbb_report_level": "byte",
    "mark_abuse_location": "text",
    "mark_abuse_cardinality": "positive",
    "mark_abuse_keys": "positive",
    "mark_abuse_iterations": "positive",
    "mark_abuse_warmup": "positive",
    "mark_abuse_graph_nodes": "positive",
    "mark_abuse_edges_per_node": "positive",
    "mark_abuse_rotate_interval": "natural",
    "mark_abuse_rotate_fraction": "positive number",
    "threadstat_location": "text",
    "threadstat_wrapper_location": "text",
    "threadstat_event": "text",
    "threadstat_frequency": "positive",
    "cos_config": "text",
    "cache_ways": "positive",
}
KINDS = REQUIRED_KINDS | OPTIONAL_KINDS
RUN = T.StructType([T.StructField(name, TYPES[kind], name not in REQUIRED_KINDS) for name, kind in KINDS.items()])

LOG_LINES = "id long, ord int, name string, line_no long, line binary, is_last boolean, error string, fault string, last_text long"
#: ``line_no``, ``field`` and ``value`` tell where in the file ``name`` it failed first, as far as that is known.
ISSUES = "id long, stage string, collector string, name string, message string, line_no long, field string, value string"

THREADSTAT_EVENT = "read_id long, count long, event_id long"
THREADSTAT_DESCRIPTION = "event_id long, name string, pid long"
THREADSTAT_READ = "read_id long, timestamp long, time_running long, time_enabled long"
LATENCY = "start_ns long, end_ns long, owner long"
MARK_ABUSE = "timestamp_ms long, gc_time_delta_ms long, time_s double"

# The collectors of each benchmark.
COMMON_COLLECTORS = ("config", "time", "java_threads", "status", "system_load", "threadstat", "zgc_phases", "zgc_gc_summary", "g1_phases", "git_info", "zgc_task", "zgc_stats")
COLLECTORS = {
    "dacapo_samples2": (*COMMON_COLLECTORS, "dacapo_iteration", "dacapo_latency"),
    "mark_abuse": (*COMMON_COLLECTORS, "mark_abuse"),
    "specjbb": (*COMMON_COLLECTORS, "specjbb"),
}
