"""Visits per section of the portal."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from portalmeter import fixed_values as fixed
from portalmeter.config import HitRule, SectionRule
from portalmeter.functions.periods import end_day, with_period
from portalmeter.operators.hits import CURRENT, counts_for, dimension, full_match, hit_filter, rule_predicate


def _is_load() -> Column:
    return F.lower(dimension("event_name")) == fixed.LOAD_EVENT


def _kept(paths: Sequence[str], feed: str) -> Column:
    """Whether a hit's path is none of the excluded ones."""
    match = "full_regex" if feed == CURRENT else "regex"
    return reduce(lambda a, b: a & b, [rule_predicate(HitRule("page_path", match, path, negate=True)) for path in paths], F.lit(True))


def _all_counts(hits: DataFrame, rules: Sequence[SectionRule], month: Column, feed: str) -> DataFrame:
    """All rules in one pass over the hits: (month, key, key_value, sessions).

    Hits shrink to one row per combination of sections and session, or of sections alone where no rule counts
    sessions. A rule that counts sessions marks one row of each session, so that its marks add up like counts do. Then
    sessions go, and patterns are tried once per combination of sections. The last step holds one number per rule and
    month, so a month or a section with very many hits costs no single task anything.
    """
    by_session = [rule for rule in rules if rule.metric == "sessions"]
    counted = [rule for rule in rules if rule.metric != "sessions"]
    sections = sorted({rule.column for rule in rules if rule.column})
    # Without a pattern every hit counts; a section of the current feed counts pages that finished loading.
    in_sections = _is_load() if feed == CURRENT else F.lit(True)

    def counts(rule: SectionRule) -> Column:
        return (in_sections if rule.pattern else F.lit(True)) & _kept(rule.excluded_paths, feed)

    def in_rule(rule: SectionRule) -> Column:
        return F.col(rule.column).rlike(full_match(rule.pattern)) if rule.pattern else F.lit(True)

    # What rules have in common is counted once: by metric, by whether there is a pattern, by excluded paths.
    kinds = {(rule.metric, bool(rule.pattern), rule.excluded_paths): rule for rule in counted}
    number = {kind: f"count_{i}" for i, kind in enumerate(kinds)}
    mark = {rule: f"mark_{i}" for i, rule in enumerate(by_session)}
    by = ["month", *sections]
    combined = hits.groupBy(
        month.alias("month"), *[dimension(name).alias(name) for name in sections], *([F.col("session_id").alias("session")] if by_session else [])
    ).agg(
        *[F.count_if(counts_for(rule.metric) & counts(rule)).alias(number[kind]) for kind, rule in kinds.items()],
        *[F.max(counts(rule)).alias(name) for rule, name in mark.items()],
    )
    if by_session:
        for rule, name in mark.items():
            has = F.col("session").isNotNull() & F.col(name) & in_rule(rule)
            first = F.row_number().over(Window.partitionBy("month", "session", name).orderBy(*sections, F.lit(0)))
            combined = combined.withColumn(name, has).withColumn(name, (F.col(name) & (first == 1)).cast("long"))
        combined = combined.groupBy(*by).agg(*[F.sum(name).alias(name) for name in [*number.values(), *mark.values()]])
    label = {rule: f"{rule.key}/{rule.name}" for rule in rules}
    sums = [F.sum(F.when(in_rule(r), F.col(number[(r.metric, bool(r.pattern), r.excluded_paths)]))).alias(label[r]) for r in counted]
    wide = combined.groupBy("month").agg(*sums, *[F.sum(name).alias(label[r]) for r, name in mark.items()])
    return wide.unpivot("month", [F.col(f"`{label[r]}`") for r in rules], "rule", "sessions").select(
        "month",
        F.substring_index("rule", "/", 1).alias("key"),
        F.regexp_replace("rule", "^[^/]*/", "").alias("key_value"),
        F.coalesce("sessions", F.lit(0)).alias("sessions"),
    )


def section_visits(
    hits: DataFrame,
    rules: Sequence[SectionRule],
    as_of: dt.date | str | None = None,
    feed: str = CURRENT,
    ts_col: str = "ts",
    history: DataFrame | None = None,
    extra_rule: HitRule | None = None,
) -> DataFrame:
    """Visits per month and section rule, with 0 where a section had none.

    Only hits that pass ``extra_rule`` count, also in the site total.

    ``history`` holds visits of earlier months in the same layout; a live row takes precedence over it.
    """
    hits = hit_filter(hits, [extra_rule] if extra_rule else [])
    visits = _all_counts(hits, rules, F.trunc(F.col(ts_col), "MM"), feed)
    live = with_period(visits, "month", as_of).select("year_month", "end_day", "sessions", "key", "key_value")
    return live if history is None else with_history(live, history)


def visits_from_report(rows: DataFrame, rules: Sequence[SectionRule], metric: str = "sessions") -> DataFrame:
    """Visits per month and section from report rows (year_month, end_day, key, key_value, and the metric).

    A section's report has one row; of several the largest counts. Months that any section reports have 0 for the
    others. Sections without a rule are left out.
    """
    months = rows.groupBy("year_month", "end_day").agg(F.count("*").alias("n"))
    wanted = F.inline(F.array(*[F.struct(F.lit(r.key).alias("key"), F.lit(r.name).alias("key_value")) for r in rules]))
    found = rows.groupBy("year_month", "key", "key_value").agg(F.max(metric).alias("sessions"))
    every = months.select("year_month", "end_day", wanted).join(found, ["year_month", "key", "key_value"], "left")
    return every.select("year_month", "end_day", F.coalesce("sessions", F.lit(0).cast("bigint")).alias("sessions"), "key", "key_value")


def with_history(live: DataFrame, history: DataFrame) -> DataFrame:
    """Add the rows of ``history`` whose month and section ``live`` does not have.

    One aggregation picks the live row of each key, so what ``live`` is computed from is read once.
    """
    both = live.withColumn("past", F.lit(0)).unionByName(history.select(*live.columns).withColumn("past", F.lit(1)))
    first = both.groupBy("year_month", "key", "key_value").agg(F.min(F.struct("past", "end_day", "sessions")).alias("row"))
    return first.select("year_month", "row.end_day", "row.sessions", "key", "key_value")


def historic_visits(spark: SparkSession) -> DataFrame:
    """The fixed site totals of the months before the first load."""
    totals = spark.createDataFrame(fixed.HISTORIC_SESSIONS, "year_month string, sessions bigint")
    last_day = end_day(F.to_date(F.concat("year_month", F.lit("-01"))), "9999-12-31")
    return totals.select(
        "year_month", last_day.alias("end_day"), "sessions", F.lit("all").alias("key"), F.lit("").alias("key_value")
    )
