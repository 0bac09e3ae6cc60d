"""Reports on loads, runs and metadata, and the clean-up of what has lost its source."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import periods


def cascade(sources: DataFrame, tables: dict[str, DataFrame], pattern: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """What deleting the sources whose table fits `pattern` takes with it: counts, and the tables without them."""
    gone = sources.where(F.col("table_name").like(pattern)).select(F.col("code").alias("source"))
    counts = [sources.where(F.col("table_name").like(pattern)).agg(F.count("*").alias("n")).withColumn("what", F.lit("sources"))]
    counts += [t.join(gone, "source", "left_semi").agg(F.count("*").alias("n")).withColumn("what", F.lit(name)) for name, t in tables.items()]
    kept = {name: t.join(gone, "source", "left_anti") for name, t in tables.items()}
    return reduce(DataFrame.unionByName, counts), kept | {"sources": sources.where(~F.col("table_name").like(pattern))}


def missing_periods(rows: DataFrame, source: str, period: str) -> DataFrame:
    """Months between a source's first and last that have no row."""
    ends = rows.groupBy(source).agg(F.min(period).alias("a"), F.max(period).alias("b"))
    months = F.explode(periods.monthly(periods.period_start(F.col("a")), periods.period_start(F.col("b"))))
    wanted = ends.select(source, months.alias("month")).select(source, F.date_format("month", "yyyy-MM").alias(period))
    return wanted.join(rows.select(source, period), [source, period], "left_anti")


def outliers(rows: DataFrame, source: str, value: str, deviations: float = 3.0) -> DataFrame:
    """Rows above their source's mean by so many standard deviations; the statistics are one aggregate joined back."""
    stats = rows.groupBy(source).agg(F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_sd"))
    return rows.join(stats, source).where(F.col(value) > F.col("_mean") + deviations * F.col("_sd")).drop("_mean", "_sd")


def status_counts(ledger: DataFrame, by: str, statuses: list[str]) -> DataFrame:
    """A column with the number of rows for each status, zero where there is none."""
    return ledger.groupBy(by).agg(*[F.count(F.when(F.col("status") == s, 1)).alias(s) for s in statuses])


def load_status(ledger: DataFrame, by: str = "period") -> DataFrame:
    """Files, rows and last load of each period, and files that aren't loaded yet."""
    done = F.col("status") == "loaded"
    return ledger.groupBy(by).agg(F.count("*").alias("files"), F.sum(F.when(done, F.col("rows_loaded"))).alias("total_rows"), F.max("updated_at").alias("last_load"), F.count_if(~done).alias("pending"))


def daily_summary(ledger: DataFrame, since: Column, by: str = "manifest_name") -> DataFrame:
    """Files, rows, manifests and failures of each day from `since` on."""
    rows = ledger.where(F.col("updated_at") >= since)
    return rows.groupBy(F.to_date("updated_at").alias("day")).agg(F.count("*").alias("files"), F.sum("rows_loaded").alias("total_rows"), F.count_distinct(by).alias("manifests"), F.count_if(F.col("status") == "failed").alias("failures"))


def publication_health(sources: DataFrame, ledger: DataFrame, active_since: Column) -> DataFrame:
    """Periods, rows and last load of each source, Active if that is no earlier than a day, else Stale."""
    loads = ledger.groupBy(F.col("source").alias("code")).agg(F.count_distinct("period").alias("periods"), F.sum("rows_loaded").alias("total_rows"), F.max("updated_at").alias("last_load"))
    out = sources.select("code").join(loads, "code", "left").na.fill(0, ["periods", "total_rows"])
    return out.withColumn("health", F.when(F.col("last_load") >= active_since, "Active").otherwise("Stale"))


def completeness(ledger: DataFrame, by: str = "source") -> DataFrame:
    """Rows, periods, and first and last period of each source."""
    return ledger.groupBy(by).agg(F.sum("rows_loaded").alias("total_rows"), F.count_distinct("period").alias("periods"), F.min("period").alias("first_period"), F.max("period").alias("last_period"))


def stage_performance(events: DataFrame, by: str, value: str) -> DataFrame:
    """Calls, mean and greatest value of each stage."""
    return events.groupBy(by).agg(F.count("*").alias("calls"), F.round(F.avg(value), 4).alias("mean"), F.max(value).alias("most"))


def cost_per_day(calls: DataFrame, at: str, tokens: str, price: float) -> DataFrame:
    """Calls, tokens and their cost of each day."""
    days = calls.groupBy(F.date_trunc("day", at).cast("timestamp_ntz").alias("day"))
    return days.agg(F.count("*").alias("calls"), F.sum(tokens).cast("long").alias("tokens")).withColumn("cost", F.col("tokens") * F.lit(price))


def prompt_reuse(prompts: DataFrame, text: str, by: str, least: int = 2) -> DataFrame:
    """Prompts, as their md5, that are used `least` times or more, and in how many of `by`."""
    return prompts.groupBy(F.md5(text).alias("prompt")).agg(F.count("*").alias("uses"), F.count_distinct(by).alias("conversations")).where(F.col("uses") >= least)


def batch_statistics(ledger: DataFrame, as_of: Column, recent: int = 2, by: str = "manifest_name") -> DataFrame:
    """Files by outcome and rows of each manifest, the months since its newest period, and whether these are `recent` at most."""
    loaded = F.col("status") == "loaded"
    out = ledger.groupBy(by).agg(F.count("*").alias("total"), F.count_if(loaded).alias("loaded"), F.count_if(F.col("status") == "failed").alias("failed"), F.coalesce(F.sum(F.when(loaded, F.col("rows_loaded"))), F.lit(0)).alias("total_rows"), F.max("period").alias("last"))
    age = F.months_between(as_of, F.to_date(F.concat("last", F.lit("-01")))).cast("long")
    return out.withColumns({"age_months": age, "current": age <= recent}).drop("last")


def without_source(rows: DataFrame, sources: DataFrame, key: str, code: str = "code") -> DataFrame:
    """Rows whose `key` is no source's code; rows without a key are such."""
    return rows.join(sources.select(F.col(code).alias(key)).distinct(), key, "left_anti")


def lineage(ledger: DataFrame, sources: DataFrame, history: DataFrame) -> DataFrame:
    """Loaded files with their source and the number of its loads."""
    loads = history.groupBy(F.col("source").alias("_source")).agg(F.count("*").alias("loads"))
    known = sources.select(F.col("code").alias("_code"), "domain")
    out = ledger.where("status = 'loaded'").join(known, F.col("source") == F.col("_code"), "left").join(loads, F.col("_code") == F.col("_source"), "left")
    return out.drop("_code", "_source")


def work_list(ledger: DataFrame, enabled: DataFrame, done: tuple[str, ...] = ("loaded",)) -> DataFrame:
    """Files of enabled sources (code) that aren't done yet."""
    open_files = ledger.where(~F.col("status").isin(*done))
    return open_files.join(enabled.select(F.col("code").alias("source")), "source", "left_semi")


def manifest_files(ledger: DataFrame, manifest: str) -> DataFrame:
    """A manifest's files, the last changed first."""
    return ledger.where(F.col("manifest_name") == manifest).orderBy(F.desc("updated_at"), "id")


def best_for(datasets: DataFrame, words: list[str], is_large: Column, code: str = "code") -> DataFrame:
    """The dataset whose code holds most of the words, half a point more for a large one; the first by code of equals."""
    score = sum((F.contains(F.lower(code), F.lit(w.lower())).cast("int") for w in words), F.lit(0)) + F.when(is_large, 0.5).otherwise(0.0)
    return datasets.orderBy(F.desc(score), code).limit(1)


def grouped_files(ledger: DataFrame, by: str = "source") -> DataFrame:
    """Sources with their files' periods in order, nulls last, whether one is loaded, and the mode that failures ask for."""
    files = F.array_sort(F.collect_list(F.struct(F.col("period").isNull().alias("last"), "period", "id")))  # a source's files
    out = ledger.groupBy(by).agg(F.count("*").alias("files"), F.bool_or(F.col("status") == "loaded").alias("enabled"), files.alias("f"), F.bool_or(F.col("status") == "failed").alias("bad"))
    return out.select(by, "files", "enabled", F.array_join(F.transform("f", lambda x: x["period"]), ",").alias("periods"), F.when(F.col("bad"), "append").otherwise("replace").alias("mode"))


def run_analysis(events: DataFrame, run: str, stage: str, kind: str, at: str, started: str, completed: str, failed: str) -> DataFrame:
    """One row for each run: status, seconds, stages begun, done and failed, and the first failure."""
    is_kind = {n: F.col(kind) == v for n, v in (("started", started), ("completed", completed), ("failed", failed))}
    out = events.groupBy(run).agg(
        F.min(at).alias("began"),
        F.max(at).alias("ended"),
        *[F.count(F.when(c, 1)).alias(n) for n, c in is_kind.items()],
        F.min_by(stage, F.when(is_kind["failed"], F.col(at))).alias("first_failure"),
    )
    status = F.when(F.col("failed") > 0, "FAILED").when(F.col("started") == 0, "NO_WORK").when(F.col("completed") >= F.col("started"), "SUCCESS").otherwise("INCOMPLETE")
    return out.withColumn("status", status)


def analysed_runs(events: DataFrame) -> DataFrame:
    """One row for each run of an event log (run_id, event_type, timestamp, level, publication, period, stage, message, details map).

    status: by what the newest run_completed counts as failed and processed; INCOMPLETE without one, UNKNOWN where there is no run_started either.
    Further: began, ended, seconds, publications, errors, warnings, sources_loaded and rows_loaded (of completed loads that name their rows),
    reference_matches, calls, and where the first failed stage was and what it said.
    """
    kind, at = F.col("event_type"), F.col("timestamp")
    of = lambda name: kind == name
    rows_said = F.when(of("stage_completed") & (F.col("stage") == "load"), F.regexp_extract("message", r"(\d+) rows", 1).try_cast("long"))
    failure = F.struct(at, F.coalesce("stage", F.lit("unknown")).alias("stage"), "publication", "period", "message", F.col("details")["error"].alias("error"))
    out = events.groupBy("run_id").agg(
        F.min(F.when(of("run_started"), at)).alias("began"),
        F.max(F.when(of("run_completed"), at)).alias("ended"),
        F.max(F.when(of("run_completed"), F.struct(at, F.col("details")["failed"].try_cast("long").alias("failed"), F.col("details")["processed"].try_cast("long").alias("processed")))).alias("told"),
        F.count_distinct("publication").alias("publications"),
        F.count_if(of("error") | (F.col("level") == "ERROR")).alias("errors"),
        F.count_if(of("warning") & (F.col("level") == "WARNING")).alias("warnings"),
        F.count(rows_said).alias("sources_loaded"),
        F.coalesce(F.sum(rows_said), F.lit(0)).alias("rows_loaded"),
        F.coalesce(F.sum(F.when(of("reference_matched"), F.col("details")["matched"].try_cast("long"))), F.lit(0)).alias("reference_matches"),
        F.count_if(of("llm_call")).alias("calls"),
        F.min(F.when(of("stage_failed"), failure)).alias("failure"),
    )
    status = F.when(F.col("ended").isNull(), F.when(F.col("began").isNotNull(), "INCOMPLETE").otherwise("UNKNOWN")).when(F.col("told.failed") > 0, "FAILED").when(F.col("told.processed") > 0, "SUCCESS").otherwise("NO_WORK")
    parts = {f"failed_{c}": F.col(f"failure.{c}") for c in ("stage", "publication", "period", "message", "error")}
    seconds = F.unix_timestamp("ended") - F.unix_timestamp("began")
    return out.withColumns({"status": status, "seconds": seconds, **parts}).drop("told", "failure")


def run_stages(events: DataFrame) -> DataFrame:
    """(run_id, stage, started, completed, failed) of every stage that a run's events name."""
    counts = [F.count_if(F.col("event_type") == f"stage_{k}").alias(k) for k in ("started", "completed", "failed")]
    return events.where(F.col("event_type").isin("stage_started", "stage_completed", "stage_failed")).groupBy("run_id", F.coalesce("stage", F.lit("unknown")).alias("stage")).agg(*counts)


def restart_list(runs: DataFrame, events: DataFrame) -> DataFrame:
    """(run_id, publication) of the publications of runs that failed or didn't end, a row each."""
    open_runs = runs.where(F.col("status").isin("FAILED", "INCOMPLETE")).select("run_id")
    return events.where("publication is not null").join(open_runs, "run_id", "left_semi").select("run_id", "publication").distinct()


def rule_findings(df: DataFrame, rules: list[tuple[str, str, Column]], keep: list[str]) -> DataFrame:
    """A row (keep…, level, finding) for every rule that a row breaks: rules are (level, finding, broken)."""
    found = F.array_compact(F.array(*[F.when(broken, F.struct(F.lit(level).alias("level"), F.lit(text).alias("finding"))) for level, text, broken in rules]))
    return df.select(*keep, F.explode(found).alias("f")).select(*keep, "f.level", "f.finding")


def table_findings(profile: DataFrame, total: int, strict: bool = False) -> DataFrame:
    """Findings of a table's column profile: empty table, columns without values, or mostly without."""
    if not total:
        return profile.select(F.lit("*").alias("column_name"), F.lit("error").alias("level"), F.lit("empty table").alias("finding")).limit(1)
    rules = [("error", "no values", F.col("null_rate") == 100), ("warning", "mostly empty", F.lit(strict) & (F.col("null_rate") > 50) & (F.col("null_rate") < 100))]
    return rule_findings(profile, rules, ["column_name"])


def freshness(rows: DataFrame, at: str, as_of: Column, hours: int) -> DataFrame:
    age = (F.unix_timestamp(as_of) - F.unix_timestamp(F.col(at).cast("timestamp"))) / 3600
    return rows.withColumns({"age_hours": F.round(age, 2), "stale": age > hours})


def metadata_audit(metadata: DataFrame, by: str, max_gaps: int = 3) -> DataFrame:
    """Each table's columns without description, type or role, and the verdict."""
    gap = {"no_description": F.col("description").isNull() | (F.col("description") == ""), "no_type": F.col("data_type").isNull(), "no_role": ~(F.coalesce("is_dimension", F.lit(False)) | F.coalesce("is_measure", F.lit(False)))}
    out = metadata.groupBy(by).agg(F.count("*").alias("columns"), *[F.count(F.when(c, 1)).alias(n) for n, c in gap.items()])
    gaps = F.col("no_description") + F.col("no_role")
    return out.withColumn("verdict", F.when(F.col("columns") == 0, "NO_METADATA").when(F.col("no_type") > 0, "ISSUES_FOUND").when(gaps > max_gaps, "WARNINGS").otherwise("OK"))
