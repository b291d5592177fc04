"""Control queries over histories of task instances and over available files. Histories are small tables of a few thousand
rows at most; they are still plain DataFrame queries, texts included."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mosaique.functions.dates import date_of, period_to_date
from mosaique.operators import scan


def _has_argument(name: str) -> Column:
    return F.exists("arguments", lambda x: x["key"] == name)


def _output(name: str) -> Column:
    return F.exists("outputs", lambda x: x["topic"] == name)


def instances_normalise(instances: DataFrame) -> DataFrame:
    """instance, period, failed, type, application_log, part. Invalid calls and failed finish runs go; a last period that
    also made the report becomes two rows (part 0 the period, part 1 the report)."""
    # element_at beyond an empty array is an error in ANSI mode, so get() is used on filtered arrays.
    first = lambda arr, fld: F.get(arr, F.lit(0))[fld]
    period = first(F.filter("arguments", lambda x: x["key"] == "period"), "value").cast("int")
    log = first(F.filter("outputs", lambda x: x["topic"] == "application_log"), "id")
    failed = F.col("status") == "Failed"
    valid = ~F.coalesce(F.col("error").contains(":AE01:"), F.lit(False)) & ~(_has_argument("finish-report") & failed)
    kind = F.when(F.size("arguments") == 0, "poll_request").when(_has_argument("cancel"), "cancel").when(_output("fingerprint_report"), "report").otherwise("h")
    rows = instances.where(valid).select("instance", period.alias("period"), failed.alias("failed"), kind.alias("type"), log.alias("application_log"))
    split = F.when(
        F.col("period").isNotNull() & (F.col("type") == "report"),
        F.array(F.struct(F.lit("h").alias("type"), F.col("period").alias("period"), F.lit(0).alias("part")), F.struct(F.lit("report").alias("type"), F.lit(None).cast("int").alias("period"), F.lit(1).alias("part"))),
    ).otherwise(F.array(F.struct(F.col("type").alias("type"), F.col("period").alias("period"), F.lit(0).alias("part"))))
    return rows.withColumn("x", F.explode(split)).select("instance", "x.period", "failed", "x.type", "application_log", "x.part")


def group_batches(rows: DataFrame, last_seen: int = -1) -> DataFrame:
    """One row for each run of instances of one request that has something newer than last_seen, as gaps and islands.

    Seen from the newest back, a batch starts at a report or a cancel that went well, or at the newest row."""
    boundary = (F.col("type") == "report") | ((F.col("type") == "cancel") & ~F.col("failed"))
    rows, _ = scan.running_sums(rows.withColumn("new", F.col("instance") > last_seen), [F.desc("instance"), F.desc("part")], {"batch": boundary.cast("int")})
    order = F.struct(F.col("instance"), F.col("part"))
    is_h = F.col("type") == "h"
    newest = lambda c, when: F.max_by(c, F.when(when, order))
    descending = lambda when: F.transform(F.sort_array(F.collect_list(F.when(when, F.struct("instance", "period"))), asc=False), lambda x: x["period"])
    grouped = rows.groupBy("batch").agg(
        F.max(F.when(boundary, F.col("type"))).alias("ended"),
        F.max("new").alias("any_new"),
        F.max((boundary & F.col("new")).cast("int")).alias("ended_new"),
        F.max(is_h.cast("int")).alias("any_h"),
        F.max(((F.col("type") == "poll_request") & F.col("new") & ~F.col("failed")).cast("int")).alias("polled_new"),
        F.max(((F.col("type") == "poll_request") & F.col("new") & F.col("failed")).cast("int")).alias("poll_failed"),
        F.max(((F.col("type") == "cancel") & F.col("new") & F.col("failed")).cast("int")).alias("cancel_failed"),
        F.max(F.when(F.col("new") | boundary, F.col("instance"))).alias("instance"),
        newest("application_log", F.col("application_log").isNotNull()).alias("application_log"),
        newest("period", is_h).alias("greatest_period"),
        newest("period", is_h & ~F.col("new")).alias("old_greatest_period"),
        descending(is_h & F.col("new") & ~F.col("failed")).alias("periods"),
        descending(is_h & F.col("new") & F.col("failed")).alias("failed_periods"),
    )
    base = F.when(F.col("ended") == "report", "report").when(F.col("ended") == "cancel", "canceled").when(F.col("any_h") == 1, "processing").otherwise("poll_request")
    fresh = (F.col("polled_new") == 1) & (base != "poll_request")
    kept = grouped.where(F.col("any_new") & (F.col("ended").isNull() | (F.col("ended_new") == 1)))
    anomalies = F.filter(F.array(F.when(F.col("cancel_failed") == 1, "cancel_failed"), F.when(F.col("poll_failed") == 1, "poll_request_failed")), lambda x: x.isNotNull())
    return kept.select(F.concat(base, F.when(fresh, "_new").otherwise("")).alias("type"), "application_log", "instance", "greatest_period", "old_greatest_period", "periods", "failed_periods", anomalies.alias("anomalies"))


def progress_percent(done: Column, total: Column) -> Column:
    return F.format_string("%.2f", 100.0 * done / total)


def every_period(spark, first: int, last: int) -> DataFrame:
    return spark.range(first, last + 1).select(F.col("id").cast("int").alias("period"))


def report_skipped_set(done: DataFrame, first: int, last: int) -> DataFrame:
    """Periods of the range that are neither successful nor failed."""
    return every_period(done.sparkSession, first, last).join(done.select("period"), "period", "left_anti")


def schedule_periods(available: DataFrame, expected: int, last: int) -> DataFrame:
    return available.where(F.col("period").between(expected, last)).select("period").distinct().orderBy("period")


def max_available_period(available: DataFrame) -> DataFrame:
    return available.agg(F.coalesce(F.max("period"), F.lit(-1)).alias("max_period"))


def last_finished_instance(instances: DataFrame) -> DataFrame:
    return instances.where("status = 'Finished'").agg(F.max("instance").alias("instance"))


def last_instance_predicates(instances: DataFrame, period_last: int = -1) -> DataFrame:
    """Of the newest valid instance (raw, not normalised): whether it is a failed making of the report that ends in period_last
    (false without a report, -1), and whether it finished or canceled a report."""
    valid = instances.where(~F.coalesce(F.col("error").contains(":AE01:"), F.lit(False)))
    newest = valid.agg(F.max_by(F.struct("status", "arguments", "outputs"), "instance").alias("x")).select("x.*")
    first = F.get("arguments", F.lit(0))["key"]
    of_last = F.exists("arguments", lambda a: (a["key"] == "period") & (a["value"].try_cast("bigint") == period_last))
    failed = (F.col("status") == "Failed") & (F.size("arguments") > 0) & ((first == "fingerprint_report") | ((first != "cancel") & of_last)) & F.lit(period_last != -1)
    ended = (F.col("status") == "Finished") & (F.size("arguments") > 0) & (_output("fingerprint_report") | (first == "cancel"))
    return newest.select(F.coalesce(failed, F.lit(False)).alias("report_failed"), F.coalesce(ended, F.lit(False)).alias("finished_or_canceled"))


#: Lines of the application log.
CALIBRATION, FIRST, LAST, EXPECTED, SKIPPED = "With calibration: ", "First period: ", ", last period: ", "Expected next period: ", "Skipped period "
NEW_REQUEST, NOTHING_NEW = "New NSI request arrived.", "Waited for new NSI request, nothing came, going back to sleep"
NO_VALID, FAILED_REQUEST, FAILED_WHY = "No new valid NSI request found.", "Failed to look at NSI report request with data id ", ", skipping.\n\tError message: "
CANCELED, METADATA, RUNTIME = "The report generation process was canceled manually.", "\nH metadata:\n", "\nRuntime of enclave (not trustworthy): "


def app_log_parse(logs: DataFrame) -> DataFrame:
    """What a log says of its request: kind is running (the period behind the expected one is next), new_request (no next period
    yet), no_request, or invalid. Where a number is not known, it is -1."""
    range_, running = f"{FIRST}([0-9]+){LAST}([0-9]+)", rf"{FIRST}([0-9]+){LAST}([0-9]+)\s+{EXPECTED}([0-9]+)"
    is_running, is_new = F.col("log").rlike(running), F.col("log").rlike(range_)
    kind = F.when(is_running, "running").when(is_new, "new_request").when(F.col("log").contains(NOTHING_NEW), "no_request").otherwise("invalid")
    number = lambda pattern, k: F.regexp_extract("log", pattern, k).cast("int")
    of_range = lambda k: F.when(is_running, number(running, k)).when(is_new, number(range_, k)).otherwise(-1)
    following = F.when(is_running, number(running, 3) + 1).otherwise(-1)
    return logs.select("log_id", kind.alias("kind"), of_range(1).alias("first_period"), of_range(2).alias("last_period"), following.alias("next_period"))


#: What the anomalies of a progress report are called.
ANOMALIES = {"cancel_failed": "Failed to cancel a report;", "poll_request_failed": "Failed to poll a new request;"}


def _dates(title: str, periods: list[int]) -> str:
    return f"{title} {', '.join(map(date_of, periods))}\n" if periods else ""


def _anomalies(found: list[str] | None) -> str:
    return f"Anomalies: {' '.join(ANOMALIES[x] for x in found)}\n" if found else ""


def progress_texts(batches: DataFrame) -> DataFrame:
    """batches (as group_batches gives them, with first and last of their requests) with the text of each; null where there is none
    to tell. The texts of all batches, newest first and with a line break between, are a progress report."""
    kind, new = F.regexp_replace("type", "_new$", ""), F.when(F.col("type").endswith("_new"), "new ").otherwise("")
    date = lambda p: F.date_format(period_to_date(p), "yyyy-MM-dd")
    span = F.when(F.col("first") >= 0, F.concat(date(F.col("first")), F.lit(" to "), date(F.col("last")))).otherwise("")
    line = lambda title, periods: F.when(F.size(periods) > 0, F.concat(F.lit(f"{title} "), F.array_join(F.transform(periods, date), ", "), F.lit("\n"))).otherwise("")
    done, total = F.col("greatest_period") - F.col("first") + 1, F.col("last") - F.col("first") + 1
    processing = F.concat(F.lit("Processing a "), new, F.lit("report "), span, F.lit(", "), progress_percent(done, total), F.lit("% done, "), done.cast("string"), F.lit(" out of "), total.cast("string"), F.lit("\n"))
    over = F.concat(F.when(kind == "report", "Finished").otherwise("Canceled"), F.lit(" a "), new, F.lit("report "), span, F.lit("\n"))
    since = F.coalesce(F.col("old_greatest_period") + 1, F.col("first"))
    upto = F.when(kind == "processing", F.col("greatest_period")).otherwise(F.col("last"))
    known = F.array_union("periods", "failed_periods")
    skipped = F.when(since <= upto, F.filter(F.sequence(since, upto), lambda p: ~F.array_contains(known, p))).otherwise(F.array().cast("array<int>"))
    names = F.create_map(*(F.lit(x) for pair in ANOMALIES.items() for x in pair))
    odd = F.when(F.size("anomalies") > 0, F.concat(F.lit("Anomalies: "), F.array_join(F.transform("anomalies", lambda a: names[a]), " "), F.lit("\n"))).otherwise("")
    lines = [line("Successful dates:", F.col("periods")), line("Failed dates:", F.sort_array("failed_periods")), line("Skipped dates:", skipped), odd]
    accepted = F.when(F.col("first") >= 0, F.concat(F.lit("Accepted a new report "), span, F.lit("\n")))
    return batches.withColumn("text", F.when(kind == "poll_request", accepted).otherwise(F.concat(F.when(kind == "processing", processing).otherwise(over), *lines)))


def progress_text(batches: list[dict]) -> str:
    """Progress report of batches, newest first; each has type, first, last, greatest_period, old_greatest_period, periods
    and failed_periods (newest first), and anomalies, if any."""
    out = []
    for b in batches:
        kind, new = b["type"].removesuffix("_new"), "new " if b["type"].endswith("_new") else ""
        first, last = b["first"], b["last"]
        span = f"{date_of(first)} to {date_of(last)}" if first >= 0 else ""
        if kind == "poll_request":
            if first >= 0:
                out.append(f"Accepted a new report {span}\n")
            continue
        upto = last
        if kind == "processing":
            done, total, upto = b["greatest_period"] - first + 1, last - first + 1, b["greatest_period"]
            head = f"Processing a {new}report {span}, {100 * done / total:.2f}% done, {done} out of {total}\n"
        else:
            head = f"{'Finished' if kind == 'report' else 'Canceled'} a {new}report {span}\n"
        old = b.get("old_greatest_period")
        since = first if old is None else old + 1
        known = {*b["periods"], *b["failed_periods"]}
        skipped = [p for p in range(since, upto + 1) if p not in known]
        out.append(head + _dates("Successful dates:", b["periods"]) + _dates("Failed dates:", sorted(b["failed_periods"])) + _dates("Skipped dates:", skipped) + _anomalies(b.get("anomalies")))
    return "\n".join(out)
