"""Log text to tables: sample lines, failures of whole files, and the cases that cross lines."""

from runlake.operators import extract as X


def lines(spark, *texts, id_=1, name="gc.javalog", ord_=0):
    rows = [(id_, ord_, name, i, t, i == len(texts) - 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "id long, ord int, name string, line_no long, line string, is_last boolean")


SUMMARY = [
    "[2031-03-05T08:15:20.000-0400][info   ][gc          ] GC(3) Major Collection (Proactive)",
    "[2031-03-05T08:15:20.125-0400][info   ][gc          ] GC(3) Major Collection (Proactive) 512M(6%)->96M(1%) 0.125s",
    "[2031-03-05T08:16:00.000-0400][info   ][gc          ] GC(9) Minor Collection (High Usage)",
    "[2031-03-05T08:16:01.375-0400][info   ][gc          ] GC(9) Minor Collection (High Usage) 8192M(50%)->2048M(12%) 1.375s",
]


def test_summaries_match_only_at_the_end_of_a_cycle(spark):
    rows, issues = X.zgc_gc_summary(lines(spark, *SUMMARY))
    got = rows.orderBy("gc_number").collect()
    assert [(r.type, r.cause, r.start_memory_mb, r.end_percent, r.time_us) for r in got] == [("major", "Proactive", 512, 1, 125000), ("minor", "High Usage", 8192, 12, 1375000)]
    assert dict(rows.dtypes)["end_time"] == "timestamp" and issues.count() == 0


def test_one_bad_number_withholds_the_file(spark):
    rows, issues = X.zgc_task_workers(lines(spark, "[gc,task ] GC(31) Using 6 Workers for Young Generation", "[gc,task ] GC(99999999999) Using 1 Workers for Old Generation"))
    assert rows.count() == 0
    assert [(i.id, i.name) for i in issues.collect()] == [(1, "gc.javalog")]


def test_a_bad_first_file_lets_the_next_one_in(spark):
    bad = lines(spark, "[gc,task ] GC(99999999999) Using 1 Workers for Old Generation")
    good = lines(spark, "[gc,task ] GC(7) Using 1 Workers for Old Generation", name="jvm0.txt", ord_=1)
    third = lines(spark, "[gc,task ] GC(8) Using 1 Workers for Old Generation", name="jvm0.txt", ord_=2)
    rows, issues = X.zgc_task_workers(bad.unionByName(good).unionByName(third))
    assert [r.gc_number for r in rows.collect()] == [7]
    assert sorted(i.message for i in issues.collect()) == ["Duplicate file for zgc_task_workers", "failed to parse for zgc_task_workers"]


def test_no_match_is_an_empty_table_and_no_issue(spark):
    rows, issues = X.zgc_phases(lines(spark, "nothing here"))
    assert rows.count() == 0 and issues.count() == 0


def test_statistics_of_whole_and_decimal_numbers(spark):
    rows, _ = X.zgc_stats(
        lines(
            spark,
            "[2031-03-05T08:15:20.042-0400][info][gc,stats    ]        Memory: Page Cache Flush                    3 / 11               4 / 19              4 / 19              5 / 27         pages/s",
            "[2031-03-05T08:15:20.042-0400][info][gc,stats    ]          Phase: Relocate Slowly                              0.250 / 1.000         2.125 / 7.750        2.125 / 7.750        2.125 / 8.500      us",
        )
    )
    got = sorted((r.stat_type, r.name, r.unit, r.last_10s_max, r.total_max) for r in rows.collect())
    assert got == [("Memory", "Page Cache Flush", "pages/s", 11.0, 27.0), ("Phase", "Relocate Slowly", "us", 1.0, 8.5)]


G1 = [
    "[2031-03-05T08:15:20.000-0400][info][gc          ] GC(2) Concurrent Mark Cycle",
    "[2031-03-05T08:15:20.100-0400][info][gc          ] GC(2) Pause Remark 12M->12M(20M) 0.5ms",
    "[2031-03-05T08:15:21.000-0400][info][gc,phases   ] GC(2)   Mark: 0.1ms",
    "[2031-03-05T08:15:21.000-0400][info][gc,phases   ] GC(2)   Reclaim: 0.7ms",
    "[2031-03-05T08:15:21.000-0400][info][gc,phases   ] GC(2)   Other: 0.2ms",
]


def test_a_bare_type_line_counts_only_at_the_end_of_the_file(spark):
    rows, _ = X.g1_phases(lines(spark, *G1))
    assert {r.gc_type for r in rows.collect()} == {"Pause Remark"}
    types = {r.gc_number: r.gc_type for r in X.g1_types(lines(spark, G1[1], "[x][info][gc ] GC(3) Concurrent Mark Cycle", "  ")).collect()}
    assert types == {2: "Pause Remark", 3: "Concurrent Mark Cycle"}
    files = spark.createDataFrame([(1, 0, 1)], "id long, ord int, last_text long")  # as the scan tells it
    assert types == {r.gc_number: r.gc_type for r in X.g1_types(lines(spark, G1[1], "[x][info][gc ] GC(3) Concurrent Mark Cycle", "  "), files).collect()}
    types = {r.gc_number: r.gc_type for r in X.g1_types(lines(spark, "[x][info][gc ] GC(3) Concurrent Mark Cycle", "", "7 more", "end")).collect()}
    assert types == {3: "Concurrent Mark Cycle"}


def test_the_rest_of_a_cycle_is_added_from_its_end(spark):
    rows, _ = X.g1_phases(lines(spark, *G1))
    start = {r.name: r.start_time.strftime("%S.%f") for r in rows.collect()}
    assert start["Mark"] == "21.000000"  # 0.2 + 0.7 + 0.1 falls short of one in this order


def test_threads_created_win_over_attached(spark):
    rows, _ = X.java_threads(
        lines(
            spark,
            '[1][i][t] Thread created tid: 5, name:"a", thread_type:"x"',
            '[1][i][t] Thread created tid: 5, name:"b", thread_type:"y"',
            "[1][i][t] Thread attached (tid: 5, p)",
            "[1][i][t] Thread attached (tid: 6 , p)",
            name="os.javalog",
        )
    )
    assert sorted((r.pid, r.thread_name, r.thread_type) for r in rows.collect()) == [(5, "b", "y"), (6, "unknown", "unknown")]


def test_iterations_that_are_no_numbers_are_passed_over(spark):
    rows, issues = X.dacapo_iteration(lines(spark, "DaCapo x in 99999999999999999999 msec", "DaCapo y in 7 msec", name="jvm0.stdout"))
    assert [(r.dacapo_iteration, r.dacapo_iteration_time_ms) for r in rows.collect()] == [(0, 7)] and issues.count() == 0


def test_scores_and_profiles(spark):
    scores, _ = X.specjbb_summary(lines(spark, "jbb2015.result.metric.max-jOPS = 41000", "jbb2015.result.metric.critical-jOPS = 36500", "jbb2015.result.SLA-25000-jOPS = 30250", name="a.raw"))
    assert sorted((r.metric, r.value) for r in scores.collect()) == [("SLA-25000-jOPS", 30250), ("metric.critical-jOPS", 36500), ("metric.max-jOPS", 41000)]
    text = "<{} Jul  8 06:07:08 {} 2031> org.spec.jbb.controller: RT_CURVE: running, (rIR:aIR:PR = 1500:1490:1480) (tPR = 99) [OK]"
    rows, issues = X.specjbb_profile(lines(spark, text.format("Tue", "EDT"), "<Tue Mar 04 05:06:07 EST 2031> org.spec.jbb.controller: TRANSITION: ended (rIR:aIR:PR = 7:6:5) (tPR = 4)", name="c-Controller.log"))
    assert sorted((r.phase, r.requested_ir) for r in rows.collect()) == [("RT_CURVE", 1500), ("TRANSITION", 7)] and issues.count() == 0
    rows, issues = X.specjbb_profile(lines(spark, text.format("Tue", "PST"), name="c-Controller.log"))
    assert rows.count() == 0 and issues.count() == 1
    rows, issues = X.specjbb_profile(lines(spark, text.format("Wed", "EDT"), text.format("Tue", "EDT"), name="c-Controller.log"))
    assert [r.clock_time is None for r in rows.orderBy("clock_time").collect()] == [True, False] and issues.count() == 0


def test_groups_are_read_at_once_or_one_by_one(spark):
    """A group that holds the mark round groups is read as any other; what is read of a match is read once."""
    grammar = X.Grammar("k=", r"k=([^;]*);(x)?(\d+)", {"k": X.text, "x": X.text, "n": X.u32})
    df = spark.createDataFrame([(1, 0, "a", 0, "k=a\x01b;5 k=c;x6"), (1, 0, "a", 1, "k=;x7k=")], "id long, ord int, name string, line_no long, line string")
    got = X.captures(df, grammar)
    assert [tuple(r) for r in got.select("line_no", "pos", "raw_k", "raw_x", "raw_n").orderBy("line_no", "pos").collect()] == [(0, 0, "a\x01b", "", "5"), (0, 1, "c", "x", "6"), (1, 0, "", "x", "7")]
    rows, _ = X.extract(df, grammar, "t")
    assert "regexp" not in rows._jdf.queryExecution().optimizedPlan().toString() and rows.count() == 3
