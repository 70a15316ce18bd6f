"""One key with a third of all rows or more: results stay whole, and no single task gets the whole group."""

from __future__ import annotations

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from portalmeter.config import PortalConfig
from portalmeter.operators import facts, hits, identity
from portalmeter.plans import admin_reports as admin
from portalmeter.plans import public_reports as public

ROWS = 60_000
HOT = "hot"


@contextmanager
def settings(spark, **values):
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@pytest.fixture
def no_broadcast(spark):
    """Joins shuffle, as they do on large tables, and skew counts from small sizes on."""
    with settings(
        spark,
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        },
    ):
        yield


@pytest.fixture
def skewed(spark):
    """Fact rows of which two thirds name one publisher and one dataset."""
    is_hot = F.col("id") % 3 < 2
    number = (F.col("id") % 500).cast("string")
    packages_fact = spark.range(0, ROWS, 1, 16).select(
        F.when(F.col("id") % 2 == 0, "2024-01").otherwise("2024-02").alias("year_month"),
        F.lit(31).alias("end_day"),
        F.lit(1).cast("bigint").alias("pageviews"),
        F.concat(F.lit("/catalogo/"), F.col("id").cast("string")).alias("url"),
        F.when(is_hot, F.lit(HOT)).otherwise(F.concat(F.lit("n"), number)).alias("package_name"),
        F.lit("o").alias("organization_id"),
        F.when(is_hot, F.lit(HOT)).otherwise(number).alias("publisher_id"),
    )
    names = spark.range(500).select(F.col("id").cast("string").alias("id")).union(spark.createDataFrame([(HOT,)], "id string"))
    group = names.select("id", F.concat(F.lit("G"), "id").alias("title"), F.lit("organization").alias("type"), F.lit("active").alias("state"))
    package = names.select(
        "id",
        F.when(F.col("id") == HOT, F.col("id")).otherwise(F.concat(F.lit("n"), "id")).alias("name"),
        F.concat(F.lit("T"), "id").alias("title"),
        F.lit("dataset").alias("type"),
        F.lit("active").alias("state"),
        F.lit(False).alias("private"),
        F.lit("o").alias("owner_org"),
    )
    extra = spark.createDataFrame([], "package_id string, key string, value string, state string")
    return {"packages_fact": packages_fact, "group": group, "package": package, "package_extra": extra}


def test_detail_report_splits_a_hot_publisher(spark, no_broadcast, skewed):
    df = admin.dataset_visits_detail(skewed)
    # The plan of this very DataFrame becomes final by running it.
    rows = df.collect()
    assert len(rows) == ROWS
    assert sum(r["publicador"] == "G" + HOT for r in rows) == ROWS * 2 // 3
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_package_totals_shrink_before_the_shuffle(spark, skewed):
    df = facts.package_all_time(skewed["packages_fact"])
    total = {r["package_name"]: r["pageviews"] for r in df.collect()}
    assert total[HOT] == ROWS * 2 // 3 and sum(total.values()) == ROWS
    assert max(shuffled_records(df)) < ROWS // 4


def shuffled_records(df):
    """Records written by each shuffle of a DataFrame that has run."""
    counts = []

    def walk(node):
        metrics = node.metrics()
        if metrics.contains("shuffleRecordsWritten"):
            counts.append(metrics.apply("shuffleRecordsWritten").value())
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            walk(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            walk(node.plan())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return counts


def test_top_rows_of_a_hot_month(spark, no_broadcast, skewed):
    df = public.top_datasets_per_month(skewed, "2024-03-01", PortalConfig())
    assert len(df.collect()) == 20
    # The joins move the fact rows, the last sort moves the result; by month only ten rows per task and month move.
    assert sorted(shuffled_records(df))[1] < ROWS // 10


def test_hits_of_one_page_are_counted_before_the_shuffle(spark, table):
    rows = spark.range(0, ROWS, 1, 8).select(
        F.col("id").alias("hit_id"),
        F.expr("timestamp_ntz'2024-01-05 10:00:00'").alias("ts"),
        F.lit("s").alias("session_id"),
        F.lit("h").alias("host_name"),
        F.when(F.col("id") % 3 < 2, "/catalogo/hot").otherwise(F.concat(F.lit("/es/catalogo/n"), (F.col("id") % 50).cast("string"))).alias("page_path"),
        F.lit("load_complete").alias("event_name"),
        *[F.lit(None).cast("string").alias(c) for c in ("event_category", "event_action", "event_label", "section_s1")],
        F.lit("datasets").alias("section_s2"),
        F.lit("x").alias("section_s3"),
    )
    df = hits.package_hits(rows, PortalConfig(), "2024-06-01")
    counts = {r["url"]: r["pageviews"] for r in df.collect()}
    assert counts["/catalogo/hot"] == ROWS * 2 // 3 and sum(counts.values()) == ROWS
    assert max(shuffled_records(df)) < 1000


def test_files_of_a_hot_dataset_are_all_resolved(spark, no_broadcast, table):
    pairs = spark.range(0, ROWS, 1, 8).select(
        F.lit("2024-01").alias("year_month"),
        F.lit(31).alias("end_day"),
        F.concat(F.lit("http://f/"), F.col("id").cast("string"), F.lit("/")).alias("url"),
        F.lit("/catalogo/hot").alias("package_url"),
        F.lit(1).cast("bigint").alias("total_events"),
    )
    resource = spark.range(0, ROWS, 1, 8).select(
        F.concat(F.lit("r"), F.col("id").cast("string")).alias("id"),
        F.lit("1").alias("package_id"),
        F.concat(F.lit("http://f/"), F.col("id").cast("string")).alias("url"),
        F.lit("CSV").alias("format"),
        F.lit("active").alias("state"),
        F.col("id").cast("int").alias("position"),
    )
    package = table("package", [("1", HOT, "T", "dataset", "active", False, "o")])
    extra, group = table("package_extra", []), table("group", [("o", "O", "organization", "active")])
    df = identity.resolve_resource(pairs, package, resource, extra, group, PortalConfig())
    found = df.where(F.concat(F.lit("http://f/"), F.expr("substring(resource_id, 2)"), F.lit("/")) == F.col("url"))
    assert df.count() == ROWS and found.count() == ROWS


def test_files_and_their_hits_are_moved_once(spark, no_broadcast, table):
    pairs = spark.range(0, ROWS, 1, 8).select(
        F.lit("2024-01").alias("year_month"),
        F.lit(31).alias("end_day"),
        F.concat(F.lit("http://f/a+"), F.col("id").cast("string"), F.lit("/")).alias("url"),
        F.lit("/catalogo/hot").alias("package_url"),
        F.lit(1).cast("bigint").alias("total_events"),
    )
    resource = spark.range(0, ROWS, 1, 8).select(
        F.concat(F.lit("r"), F.col("id").cast("string")).alias("id"),
        F.lit("1").alias("package_id"),
        F.concat(F.lit("http://f/a "), F.col("id").cast("string")).alias("url"),
        F.lit("CSV").alias("format"),
        F.lit("active").alias("state"),
        F.col("id").cast("int").alias("position"),
    )
    package = table("package", [("1", HOT, "T", "dataset", "active", False, "o")])
    extra, group = table("package_extra", []), table("group", [("o", "O", "organization", "active")])
    df = identity.resolve_resource(pairs, package, resource, extra, group, PortalConfig())
    assert len(df.where("resource_id is not null").collect()) == ROWS
    df.collect()
    # Hits move to their dataset, then hits and files to each other, whatever the number of spellings.
    assert sum(n for n in shuffled_records(df) if n >= ROWS // 2) <= 3 * ROWS


def file_fact(spark, months=2):
    """A row per month and file, without hot keys."""
    return spark.range(0, ROWS, 1, 8).crossJoin(spark.createDataFrame([(f"2024-{m + 1:02d}",) for m in range(months)], "year_month string")).select(
        "year_month",
        F.lit(28).alias("end_day"),
        F.lit(1).cast("bigint").alias("total_events"),
        F.concat(F.lit("http://f/"), F.col("id").cast("string")).alias("url"),
        F.lit("CSV").alias("format"),
        F.lit("/catalogo/d").alias("package_url"),
        F.concat(F.lit("r"), F.col("id").cast("string")).alias("resource_id"),
        F.lit("d").alias("package_name"),
        F.lit("o").alias("organization_id"),
        F.lit("p").alias("publisher_id"),
    )


def test_totals_of_files_move_rows_once(spark, no_broadcast):
    df = facts.resource_all_time(file_fact(spark))
    assert len(df.collect()) == ROWS
    assert sum(shuffled_records(df)) <= 2 * ROWS


def test_identities_move_rows_once(spark, no_broadcast):
    df = identity.resource_identities(file_fact(spark))
    rows = df.collect()
    assert len(rows) == ROWS and all((r["newest"]["age"], r["previous"]["age"]) == (-202402, -202401) for r in rows)
    assert sum(shuffled_records(df)) <= 2 * ROWS


def test_history_is_not_read_for_a_month_that_identities_do_not_tell_of(spark, no_broadcast, tmp_path):
    fact = file_fact(spark, 6)
    identity.resource_identities(fact.where("year_month <> '2024-06'")).write.parquet(str(tmp_path / "known"))
    known = spark.read.parquet(str(tmp_path / "known"))
    df = identity.resource_identities_changed(known, fact, "2024-06")
    rows = df.collect()
    assert len(rows) == ROWS and all((r["newest"]["age"], r["previous"]["age"]) == (-202406, -202405) for r in rows)
    # Known identities and their keys, the month's rows and what they tell twice; nothing of the five months before.
    assert sum(shuffled_records(df)) <= 5 * ROWS


def test_totals_after_a_change_move_rows_once_and_add_up_touched_files_only(spark, no_broadcast, tmp_path):
    file_fact(spark).write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    facts.resource_all_time(fact).write.parquet(str(tmp_path / "before"))
    before = spark.read.parquet(str(tmp_path / "before"))
    month = facts.resource_parts(fact.where("year_month = '2024-02' and url like '%/77_'"))
    df = facts.resource_all_time_changed(before, month, month, fact)
    rows = df.collect()
    assert len(rows) == ROWS and {r["total_events"] for r in rows} == {2}
    # Both months' rows and the all-time rows move to the touched keys; what goes on from there is a few files' rows.
    assert sum(shuffled_records(df)) <= 3 * ROWS + 2000


def test_totals_of_datasets_with_many_pairs_shrink_before_the_shuffle(spark, table):
    fact = spark.range(0, ROWS, 1, 8).select(
        F.lit("2024-01").alias("year_month"),
        F.lit(31).alias("end_day"),
        F.lit(1).cast("bigint").alias("pageviews"),
        F.concat(F.lit("/catalogo/"), F.format_string("%06d", "id")).alias("url"),
        F.concat(F.lit("d"), (F.col("id") % 10).cast("string")).alias("package_name"),
        F.col("id").cast("string").alias("organization_id"),
        F.lit("p").alias("publisher_id"),
    )
    df = facts.package_all_time(fact)
    got = {r["package_name"]: (r["pageviews"], r["organization_id"]) for r in df.collect()}
    assert got == {f"d{i}": (ROWS // 10, str(i)) for i in range(10)}
    assert sum(shuffled_records(df)) <= 8 * 10


@pytest.mark.parametrize("lost_ones", [300, ROWS])
def test_history_of_files_not_looked_up_is_not_moved(spark, no_broadcast, tmp_path, lost_ones):
    file_fact(spark).write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    resolved = fact.where("year_month = '2024-02'").withColumn("year_month", F.lit("2024-03"))
    is_lost = F.substring("resource_id", 2, 9).cast("int") % (ROWS // lost_ones) == 0
    resolved = resolved.withColumns({c: F.when(~is_lost, F.col(c)) for c in ("package_name", "resource_id")})
    resolved.select(*fact.columns).write.parquet(str(tmp_path / "resolved"))
    df = identity.backfill_resource(spark.read.parquet(str(tmp_path / "resolved")), fact)
    rows = df.collect()
    # All that were lost are told by the months before, and none of the others got anything else.
    assert len(rows) == ROWS and all(r["resource_id"] == "r" + r["url"][len("http://f/"):] and r["package_name"] == "d" for r in rows)
    if lost_ones < ROWS:
        assert sum(shuffled_records(df)) < ROWS // 10
