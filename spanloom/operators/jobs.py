"""Job-status tables as DataFrame queries."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanloom.operators.intervals import cumulative
from spanloom.sources.folders import set_checkpoint_folder

NUMERIC = {"job_id", "start_time", "wall_time", "maxvmem", "job"}


def load_status(lines: DataFrame, columns: list[str]) -> DataFrame:
    """Typed job rows of tab-separated status lines ``n, value``, with ``batch_id``: how many submit marks stand before."""
    f = F.split("value", "\t")
    marked = lines.select("n", "value", F.when(F.get(f, F.lit(0)) == "submitted", 1).otherwise(0).alias("mark"), F.lit(0).alias("file"))
    rows = cumulative(marked, ["file"], "n", "mark", "batch_id").where(F.get(f, F.lit(1)).rlike(r"^\d+$"))
    return rows.select("batch_id", *[F.get(f, F.lit(i)).alias(c) for i, c in enumerate(columns)])


def status_filter(jobs: DataFrame, conditions: list[tuple[str, str, str]]) -> DataFrame:
    """Rows that meet all ``(column, op, value)``; ops are = != ~ !~ > <, the last two on numeric columns only."""
    for column, op, value in conditions:
        c = F.col(column)
        if op in "<>" and dict(jobs.dtypes)[column] == "string" and column not in NUMERIC:
            raise ValueError(f"{column} has no order")
        text = c.cast("string")
        test: Column = {
            "=": lambda: text == value, "!=": lambda: text != value, "~": lambda: text.rlike(value), "!~": lambda: ~text.rlike(value),
            ">": lambda: c.cast("double") > float(value), "<": lambda: c.cast("double") < float(value),
        }[op]()
        jobs = jobs.where(test)
    return jobs


def status_sort(jobs: DataFrame, by: str) -> DataFrame:
    """Order by ``column[:asc|desc]``, numerically for numeric columns."""
    column, _, way = by.partition(":")
    c = F.col(column).cast("double") if column in NUMERIC else F.col(column)
    return jobs.orderBy(c.desc() if way == "desc" else c.asc())


def array_rollup(tasks: DataFrame) -> DataFrame:
    """One row per job: earliest start, longest wall time, most memory, and the first exit status that is not 0."""
    return tasks.groupBy("job").agg(
        F.count("*").alias("n_tasks"), F.min("start_time").alias("start_time"), F.max("wall_time").alias("wall_time"), F.max("maxvmem").alias("maxvmem"),
        F.coalesce(F.min_by("exit_status", F.when(F.col("exit_status") != 0, F.col("task"))), F.lit(0)).cast("int").alias("exit_status"),
    )


def parse_logs(logs: DataFrame, *, memory_correction: float = 1.0) -> DataFrame:
    """State of jobs from the head and foot of their logs (``job, text``): ``job, start_time, exit_status, wall_time, seconds, maxvmem``.

    A log names its start on a line of its own, and its end as ``key: value;``.  A job that started and names no end
    timed out: 137, 99:99:99 and 9999999 seconds.  One that names neither is pending, with no times and 0 seconds.
    Wall times lose fractions and gain hours, memory (kilobytes with a unit, over ``memory_correction``) is in gigabytes."""
    found = lambda pattern: F.nullif(F.regexp_extract("text", pattern, 1), F.lit(""))
    started = found(r"\nq: execution started: (.+)\n")
    end = lambda key, late, early: F.coalesce(found(rf"\s{key}: (.+?);"), F.when(started.isNotNull(), late).otherwise(early))
    wall = F.regexp_replace(end("walltime", "99:99:99", ""), r"\.\d+$", "")
    full = F.when(F.length("wall") == 4, F.concat(F.lit("00:0"), "wall")).when(F.length("wall") == 5, F.concat(F.lit("00:"), "wall")).when(F.length("wall") == 7, F.concat(F.lit("0"), "wall"))
    kilo = F.expr("substring(memory, 1, length(memory) - 1)").cast("double") / memory_correction
    return logs.select(
        "job", F.coalesce(started, F.lit("")).alias("start_time"), end("exit_status", "137", "pending").alias("exit_status"), wall.alias("wall"),
        end("seconds", "9999999", "0").cast("double").alias("seconds"), end("maxvmem", "0K", "0K").alias("memory"),
    ).select("job", "start_time", "exit_status", F.coalesce(full, "wall").alias("wall_time"), "seconds", (F.floor(kilo / 1e3 + 0.5) / 1e3).alias("maxvmem"))


def latest(jobs: DataFrame) -> DataFrame:
    """The last row of each command."""
    w = Window.partitionBy("command").orderBy(F.desc("job"))
    return jobs.withColumn("nth", F.row_number().over(w)).where("nth = 1").drop("nth")


def extendable(jobs: DataFrame) -> DataFrame:
    """Commands whose last run was deleted, killed (137) or never ended."""
    return latest(jobs).where("exit_status is null or exit_status = 137 or deleted")


def extend(wanted: DataFrame, jobs: DataFrame) -> DataFrame:
    """Commands that are unknown or extendable: an anti-join with those that are satisfied."""
    done = latest(jobs).where("not coalesce(exit_status is null or exit_status = 137 or deleted, true)").select("command")
    return wanted.join(done, "command", "left_anti")


def successors(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """All jobs reachable from ``seeds (batch_id, job)`` along ``edges (batch_id, predecessor, job)``, seeds included.

    Each round follows paths of exactly twice the length, and writes what is reached and the
    longer paths to the checkpoint folder, so a chain of n jobs takes log2(n) rounds.  A
    round that reaches nothing new is the last; a job counts once, so cycles end."""
    set_checkpoint_folder(edges.sparkSession)
    hop = edges.select("batch_id", F.col("predecessor").alias("a"), F.col("job").alias("b")).distinct()
    seen = seeds.select("batch_id", "job").distinct().checkpoint()
    n = seen.count()
    while True:
        step = seen.withColumnRenamed("job", "a").join(hop, ["batch_id", "a"]).select("batch_id", F.col("b").alias("job"))
        seen = seen.unionByName(step).distinct().checkpoint()
        more = seen.count()
        if more == n:
            return seen
        n = more
        onward = hop.select("batch_id", F.col("a").alias("b"), F.col("b").alias("c"))
        hop = hop.join(onward, ["batch_id", "b"]).select("batch_id", "a", F.col("c").alias("b")).distinct().checkpoint()


def delete_order(jobs: DataFrame) -> DataFrame:
    """Last submitted first."""
    return jobs.orderBy(F.desc("job"))


#: Columns of a status listing, and those that a chain shows.
LISTED = ("job_name", "array", "job_id", "exit_status", "start_time", "wall_time", "maxvmem")
CHAINED = ("job_name", "array", "job_id", "exit_status", "job", "predecessors")


def project_status(jobs: DataFrame, *, chain: bool = False) -> DataFrame:
    """The columns of a listing as text; what is empty shows as ``-``, an array mark or memory as a blank."""
    blank = {"array", "maxvmem", "job", "predecessors"}
    shown = lambda c: F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit(" " if c in blank else "-"))
    return jobs.select(*[shown(c).alias(c) for c in (CHAINED if chain else LISTED)])


def job_states(jobs: DataFrame) -> DataFrame:
    """Add ``in_error`` (the scheduler's state Eqw) and ``deletable`` (a state that is no number and no deletion)."""
    state = F.col("exit_status").cast("string")
    ended = state.rlike(r"^\d+$") | state.contains("deleted")
    return jobs.withColumns({"in_error": F.coalesce(state == "Eqw", F.lit(False)), "deletable": F.coalesce(~ended, F.lit(False))})


def texts_of_jobs(jobs: DataFrame, files: DataFrame, kind: str) -> DataFrame:
    """Logs or scripts of the jobs, in order: ``job, path, text``, clear-screen sequences removed.

    ``files`` has ``job, kind, path, text``."""
    own = files.where(F.col("kind") == kind).join(jobs.select("job").distinct(), "job")
    return own.select("job", "path", F.replace("text", F.lit("\x1b[H\x1b[2J"), F.lit("")).alias("text")).orderBy("job", "path")


def snapshot_lines(values: DataFrame, mark: str = "=") -> DataFrame:
    """Settings ``job, name, value`` as lines of a snapshot, without unset ones: ``job, name, line``."""
    return values.where("value is not null").select("job", "name", F.concat("name", F.lit(mark), "value").alias("line"))


def read_snapshot(lines: DataFrame, mark: str = "=") -> DataFrame:
    """The settings of snapshot lines ``job, line``: the name ends at the first mark; lines without one are passed over."""
    at = F.instr("line", mark)
    return lines.where(at > 1).select("job", F.substring("line", F.lit(1), at - 1).alias("name"), F.substr("line", at + len(mark)).alias("value"))


def order_by_size(files: DataFrame, *, largest_first: bool = True) -> DataFrame:
    """``path, size`` by size, then path."""
    return files.orderBy(F.desc("size") if largest_first else F.asc("size"), "path")


def snip(lines: DataFrame, most: int = 10) -> DataFrame:
    """``n, value`` of a text of at most ``most`` lines, else of its first and last ``most // 2``."""
    half = most // 2
    total = lines.agg(F.count("*").alias("total"), F.min("n").alias("first"), F.max("n").alias("last"))
    near = (F.col("n") < F.col("first") + half) | (F.col("n") > F.col("last") - half)
    return lines.crossJoin(F.broadcast(total)).where((F.col("total") <= most) | near).select("n", "value")  # one row of totals


def remap(jobs: DataFrame, ids: DataFrame) -> DataFrame:
    """Dependency arrays with old job ids replaced by new ones (``old, new``); others stay."""
    own = jobs.select("job", F.posexplode_outer("predecessors").alias("at", "old")).join(ids, "old", "left")
    new = own.groupBy("job").agg(F.sort_array(F.collect_list(F.struct("at", F.coalesce("new", "old").alias("id")))).alias("p"))
    return jobs.drop("predecessors").join(new.select("job", F.filter(F.col("p.id"), lambda x: x.isNotNull()).alias("predecessors")), "job")


def rollback(snapshots: DataFrame) -> DataFrame:
    """Rows of the highest archive."""
    top = snapshots.agg(F.max("archive").alias("archive"))
    return snapshots.join(F.broadcast(top), "archive")


def purge_targets(files: DataFrame, archived: DataFrame) -> DataFrame:
    return files.join(archived.select("job"), "job", "left_anti")


def move_paths(jobs: DataFrame, old: str, new: str, columns: list[str]) -> DataFrame:
    return jobs.withColumns({c: F.replace(F.col(c), F.lit(old), F.lit(new)) for c in columns})


def mask_text(text: Column, masks: list[str], by: str = "~") -> Column:
    """Literal masks, the longest first."""
    for m in sorted(masks, key=len, reverse=True):
        text = F.replace(text, F.lit(m), F.lit(by))
    return text


def job_selector(spec: str, job: str = "job", task: str = "task") -> Column:
    """Filter of ``all``, ``n``, ``n[t]``, ``n*``, ``n-m`` (a short end takes leading digits), ``n+``, or a comma list of them."""
    if spec == "all":
        return F.lit(True)
    test = F.lit(False)
    for part in spec.split(","):
        part = part.strip()
        n = F.col(job)
        if m := re.fullmatch(r"(\d+)\[(\d+)\]", part):
            one = (n == int(m[1])) & (F.col(task) == int(m[2]))
        elif m := re.fullmatch(r"(\d+)\*", part):
            one = n.cast("string").startswith(m[1])
        elif m := re.fullmatch(r"(\d+)-(\d+)", part):
            end = m[1][: max(0, len(m[1]) - len(m[2]))] + m[2]
            one = n.between(int(m[1]), int(end))
        elif m := re.fullmatch(r"(\d+)\+", part):
            one = n >= int(m[1])
        elif part.isdigit():
            one = n == int(part)
        else:
            raise ValueError(f"unknown job selector {part}")
        test = test | one
    return test
