"""The whole job: from a task file to the lake.

Archives are read once; their lines are staged in a partition for each kind of file, so that a table reads the
lines of its own files only, and once: what it captures from them is staged in turn. Which files there are stands
in a small table, from which names, duplicates and verdicts come without a look at the lines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import csvtables, extract, quality, selection
from ..operators.reduce import run_outcomes
from ..schema import ISSUES
from ..session import joined_by_rows
from ..sources import archives, csvfiles, manifest
from ..sources.routing import RULES, Rule, feeds, kind_of, route_files
from .extractors import Extractor, StatefulExtractor, registered, run_extractor, run_stateful, runs_of
from .sink import delete, reset_collections, side_by_side, write_tables

#: Endings of the members that any table reads; others aren't decompressed into lines.
WANTED = (".javalog", "jvm0.txt", "jvm0.stdout", "status.txt", ".exit", "jvm0.time", ".csv", ".sadf", ".raw", "-Controller.log")
#: Tables by name: collector, what makes them, and the word that the run's garbage collector must hold.
LOG_TABLES = {
    "zgc_phases": ("zgc_phases", extract.zgc_phases, "zgc"),
    "zgc_gc_summary": ("zgc_gc_summary", extract.zgc_gc_summary, "zgc"),
    "zgc_stats": ("zgc_stats", extract.zgc_stats, "zgc"),
    "zgc_task_workers": ("zgc_task", extract.zgc_task_workers, "zgc"),
    "g1_phases": ("g1_phases", extract.g1_phases, "g1"),
    "java_threads": ("java_threads", extract.java_threads, None),
    "dacapo_iteration": ("dacapo_iteration", extract.dacapo_iteration, None),
    "specjbb_summary": ("specjbb", extract.specjbb_summary, None),
    "specjbb_profile": ("specjbb", extract.specjbb_profile, None),
}
CSV_TABLES = {
    "threadstat_event": ("threadstat", csvtables.threadstat_event),
    "threadstat_counter_description": ("threadstat", csvtables.threadstat_description),
    "threadstat_read": ("threadstat", csvtables.threadstat_read),
    "mark_abuse": ("mark_abuse", csvtables.mark_abuse),
    "dacapo_latency": ("dacapo_latency", csvtables.dacapo_latency),
}
PLAIN_TABLES = {"time": ("time", csvtables.time_table), "git_info": ("git_info", csvtables.git_info)}
LOADS = ("cpu_sadf", "sadf")
COLLECTOR = {t: c for tables in (LOG_TABLES, CSV_TABLES, PLAIN_TABLES) for t, (c, *_) in tables.items()} | {"cpu_sadf": "system_load", "sadf": "system_load"} | dict.fromkeys(("status", "runner_exit", "os_log"), "status")


#: A table's name, and its rows and issues; without a name there are issues only.
Taken = tuple[str, tuple]


class Staging:
    """A folder of intermediate tables: written, not cached, so plans stay short and a lost executor loses nothing."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.folder = spark, f"{base}/_staged-{uuid.uuid4().hex}"

    def put(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        path = f"{self.folder}/{name}"
        (df.write.partitionBy(by) if by else df.write).mode("overwrite").parquet(path)
        columns = [f for f in df.schema.fields if f.name != by] + [f for f in df.schema.fields if f.name == by]
        return self.spark.read.schema(type(df.schema)(columns)).parquet(path)

    def clear(self) -> None:
        delete(self.spark, self.folder)


class Corpus:
    """The staged lines of all archives and the files that they came from."""

    def __init__(self, staging: Staging, lines: DataFrame, own: list[Extractor | StatefulExtractor]):
        self.staging, self.rules = staging, RULES + [r for e in own for r in e.rules]
        kind = F.when(F.col("error").isNotNull(), "error").otherwise(kind_of(F.col("name"), self.rules))
        text = F.expr("try_validate_utf8(cast(line as string))")
        spark, key = staging.spark, "spark.sql.maxConcurrentOutputFileWriters"
        before = spark.conf.get(key)
        spark.conf.set(key, "64")  # a writer for each kind of file, instead of a sort of all lines
        try:
            self.lines = staging.put(lines.withColumn("file_kind", kind).filter("file_kind <> ''").withColumn("line", text), "lines", by="file_kind")
        finally:
            spark.conf.set(key, before)
        self.files = staging.put(self.lines.filter("is_last").select("id", "ord", "name", "file_kind", "fault", "last_text"), "files")
        broken = self.lines.filter("file_kind = 'error'").select("id", F.lit(None).cast("string").alias("name"), "error").distinct()
        self.broken = quality.issue(broken, "run", None, F.col("error"))

    def of(self, wanted: list[Rule], runs: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Lines and files that match one of the rules, of these runs."""
        mine = feeds(F.col("file_kind"), wanted, self.rules)
        return tuple(df.filter(mine).join(runs.select("id"), "id", "left_semi") for df in (self.lines.drop("error"), self.files))


def made_tables(files: DataFrame, runs: DataFrame, routed: DataFrame, own: list[Extractor | StatefulExtractor]) -> DataFrame:
    """(id, collector, table) for each table that a run's files make, or its attributes by themselves."""
    fed = route_files(files.select("id", "name")).withColumn("collector", F.try_element_at(F.create_map(*(F.lit(x) for pair in COLLECTOR.items() for x in pair)), F.col("table")))
    name = F.when(F.col("table") == "sadf", F.concat("stem", F.lit("_sadf"))).when(F.col("table") == "dacapo_latency", F.concat(F.lit("dacapo_latency_"), F.replace("latency_type", F.lit("-"), F.lit("_")))).otherwise(F.col("table"))
    fed = fed.filter("collector is not null").select("id", "collector", name.alias("table")).join(routed, ["id", "collector"], "left_semi")
    for e in own:
        mine = runs_of(e, runs).select("id")
        if isinstance(e, Extractor):
            mine = mine.join(route_files(files.select("id", "name"), rules=list(e.rules)).select("id"), "id", "left_semi")
        for table in e.tables:
            fed = fed.unionByName(mine.select("id", F.lit(f"own {table}").alias("collector"), F.lit(table).alias("table")))
    return fed.distinct()


def extract_all(corpus: Corpus, runs: DataFrame, routed: DataFrame, own: list[Extractor | StatefulExtractor]) -> tuple[dict[str, DataFrame], list[DataFrame]]:
    """Every table of the lines, and the issues of their files, frame by frame."""
    issues: list[DataFrame] = []
    tables: dict[str, DataFrame] = {"config": selection.config_table(runs)}

    def of(table: str, gate: str | None = None) -> tuple[DataFrame, DataFrame]:
        """The lines with a rule's captures, and the files."""
        mine = routed.filter(F.col("collector") == COLLECTOR[table])
        lines, files = corpus.of([r for r in RULES if r.table == table], selection.gc_gate(mine, runs, gate) if gate else mine)
        return route_files(lines, (table,)), files

    def stage(table: str, by: str | None = None):
        n = iter(range(99))
        return lambda df: corpus.staging.put(df, f"captured/{table}-{next(n)}", by)

    def log(table: str) -> list[Taken]:
        _, make, gate = LOG_TABLES[table]
        lines, files = of(table, gate)
        return [(table, make(lines.drop("table"), files=files, stage=stage(table)))]

    def csv(table: str) -> list[Taken]:
        lines, files = of(table)
        if table != "dacapo_latency":
            return [(table, CSV_TABLES[table][1](lines, files=files, stage=stage(table)))]
        # each type of latency is a table of its own, which reads its own rows
        latency, wrong = csvtables.dacapo_latency(lines, files=files, stage=stage(table, "latency_type"))
        kinds = route_files(files.select("name"), (table,)).select(F.replace("latency_type", F.lit("-"), F.lit("_"))).distinct().collect()  # a few names
        return [(f"{table}_{k}", (latency.filter(F.col("latency_type") == k).drop("latency_type"),)) for (k,) in kinds] + [("", (None, wrong))]

    def plain(table: str) -> list[Taken]:
        lines, files = of(table)
        return [] if files.isEmpty() else [(table, PLAIN_TABLES[table][1](lines, files=files, stage=stage(table)))]

    def ours(e: Extractor | StatefulExtractor) -> list[Taken]:
        mine = runs_of(e, runs)
        lines, files = corpus.of(list(e.rules), mine)
        if isinstance(e, Extractor) and isinstance(e.how, extract.Grammar):
            return [(e.table, run_extractor(e, lines, files=files, stage=stage(e.table)))]
        lines = lines.join(files.filter("fault is not null").select("id", "ord"), ["id", "ord"], "left_anti")
        if isinstance(e, Extractor):
            return [(e.table, run_extractor(e, lines))]
        made, wrong = run_stateful(e, lines, mine, stage(e.name))
        wrong = wrong.unionByName(quality.file_verdicts(files, F.lit(False), e.name, once=False)[1])
        return [*((t, (rows,)) for t, rows in made.items()), ("", (None, wrong))]

    jobs: dict[str, Callable[[], list[Taken]]] = {"loads": lambda: list(_loads(of, stage)), "status": lambda: [("status", _status(runs, of))]}
    for how, names in ((log, LOG_TABLES), (csv, CSV_TABLES), (plain, PLAIN_TABLES)):
        jobs |= {t: (lambda t=t, how=how: how(t)) for t in names}
    jobs |= {f"own {e.tables[0]}": (lambda e=e: ours(e)) for e in own}
    for table, (rows, *wrong) in (x for found in side_by_side(corpus.staging.spark, jobs).values() for x in found):
        if table:
            tables[table] = rows
        issues += wrong
    return tables, issues


def _loads(of, stage):
    """(table, (rows, issues, ...)) of the load exports; a comma parts the cells of one file name and a semicolon those of others.

    All exports' lines are read and split once, and staged in a partition for each table.
    """
    (commas, comma_files), (lines, files) = of("cpu_sadf"), of("sadf")
    made = route_files(files, ("sadf",)).select(*files.columns, F.concat("stem", F.lit("_sadf")).alias("made"))
    names = [r[0] for r in made.select("made").distinct().collect()]  # a name for each kind of export
    split = stage("loads", "made")(csvfiles.split_records(lines.withColumn("made", F.concat("stem", F.lit("_sadf"))), ";", csvtables.LOAD_COMMENT, ("made",))) if names else None
    for table in sorted({*names, *(() if comma_files.isEmpty() else ("cpu_sadf",))}):
        if table in names:
            rows, issues = csvtables.load_of(split.filter(F.col("made") == table).drop("made"), table, made.filter(F.col("made") == table).drop("made"))
        if table == "cpu_sadf" and not comma_files.isEmpty():
            more, wrong = csvtables.load_table(commas, table, ",", comma_files, stage(f"{table}-commas"))
            if table not in names:
                yield table, (more, wrong)
                continue
            # a run with both has two files of one table; the export of the usual name counts
            both = made.filter(F.col("made") == table).select("id", "ord", "name").join(comma_files.select("id").distinct(), "id", "left_semi")
            twice = quality.issue(both, "collector", table, F.lit(f"Duplicate file for {table}"))
            yield table, (rows.join(both.select("id"), "id", "left_anti").unionByName(more, allowMissingColumns=True), issues, wrong, twice)
        else:
            yield table, (rows, issues)


def _status(runs: DataFrame, of) -> tuple[DataFrame, DataFrame]:
    def text(table: str) -> tuple[DataFrame, DataFrame]:
        lines, files = of(table)
        return lines.join(files.filter("fault is not null").select("id", "ord"), ["id", "ord"], "left_anti"), files

    return run_outcomes(runs, text("status"), text("runner_exit"), text("os_log"))


def collect(spark: SparkSession, task: manifest.Task, runs: DataFrame, base: str, narrow: bool = True, strict: bool = True) -> list[str]:
    """Select runs, scan their archives once, extract every table and write the lake; returns the tables written."""
    with joined_by_rows(spark):  # there is a row for each run, file or collector in small files
        return _collect(spark, task, runs, base, narrow, strict)


def _collect(spark: SparkSession, task: manifest.Task, runs: DataFrame, base: str, narrow: bool, strict: bool) -> list[str]:
    staging, own = Staging(spark, base), registered()
    taken = {*LOG_TABLES, *CSV_TABLES, *PLAIN_TABLES, "config", "status", "parse_status", "cpu_sadf"}
    for table in (t for e in own for t in e.tables):
        if table in taken:
            raise ValueError(f"two extractors make the table {table}")
    checked, _ = quality.validate(runs)
    selected = staging.put(selection.select_runs(checked, task, strict), "runs")
    known, unknown = selection.route_collectors(selected)
    routed = staging.put(known, "collectors")
    paths = routed.select("id").distinct().select("id", manifest.archive_path(F.col("id"), task.location).alias("path"))
    wanted = (*WANTED, *(x for e in own for x in e.endings)) if all(e.endings for e in own) else ()
    corpus = Corpus(staging, archives.scan_archives(staging.put(archives.with_sizes(paths), "archives"), wanted), own)
    twice = quality.assert_unique_tables(made_tables(corpus.files, selected, routed, own))
    failed = staging.put(unknown.unionByName(corpus.broken).unionByName(twice), "failed")
    # a failed run has no rows but those of its failure, whether they come from its lines or its attributes
    good = staging.put(quality.withhold(selected, failed), "good")
    tables, issues = extract_all(corpus, good, quality.withhold(routed, failed), own)
    # issues are gathered by small jobs: one plan over all tables would be too large to plan
    side_by_side(spark, {f"issues {n}": (lambda n=n, some=some: staging.put(some, f"issues/{n}")) for n, some in enumerate([failed, *issues])})
    tables["parse_status"] = spark.read.schema(ISSUES).parquet(f"{staging.folder}/issues/*").select(quality.told().alias("message"), "id")
    written = write_tables(tables, selected, base, task.drop_tables, narrow, sorted(task.collect))
    reset_collections(spark, base, sorted(task.collect), written)  # what earlier runs had goes when the new is there
    staging.clear()
    return written
