"""Linking dataset pages and file addresses to the catalogue, and to what earlier months knew of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portalmeter.config import PortalConfig
from portalmeter.functions.periods import month_number
from portalmeter.functions.urls import spelling_root, with_spellings
from portalmeter.schemas import ALL_TIME

PACKAGE_FIELDS = ("package_name", "organization_id", "publisher_id")
#: What an event on a file is told by.
PAIR = ["url", "package_url"]
RESOURCE_FIELDS = ("resource_id", "package_name", "organization_id", "publisher_id", "format")
#: A number that goes before text keys. Addresses begin alike, so sorting by them alone compares them in full; with the
#: number first, sorts of joins and aggregations mostly compare numbers. Equal numbers are still told apart by the keys.
SPOT = "__spot"
#: Bits that say which keys are looked up, 32 MB of them at most, and the bits of one of their bitmaps, as Spark has them.
LOOKUP_BITS, BITMAP_BITS = 1 << 28, 1 << 15


def _with_spot(df: DataFrame, by: list[str]) -> DataFrame:
    return df.withColumn(SPOT, F.hash(*by))


def _is_filled(column: str) -> Column:
    """Neither NULL nor empty."""
    return F.col(column) != ""


def package_ref(url: Column, cfg: PortalConfig) -> Column:
    """Name or id in the path of a dataset page; NULL for any other path."""
    return F.nullif(F.regexp_extract(url, cfg.dataset_page_pattern, 1), F.lit(""))


def _group_refs(group: DataFrame, out: str) -> DataFrame:
    """(ref, ``out``): the id of the group that a reference means, an id going before an equal name."""
    refs = [F.struct(F.lit(0).alias("rank"), F.col("id").alias("ref"))]
    if "name" in group.columns:
        refs.append(F.struct(F.lit(1).alias("rank"), F.col("name").alias("ref")))
    listed = group.select("id", F.inline(F.array(*refs))).where("ref is not null")
    return listed.groupBy("ref").agg(F.min(F.struct("rank", "id"))["id"].alias(out))


def catalogue_identities(package: DataFrame, extra: DataFrame, group: DataFrame) -> DataFrame:
    """Every dataset with its organisation and its publisher, each only where that group exists.

    Both are told by a group's id, or else by its name if the table of groups has names; the id is what is given.
    """
    publishers = (
        extra.where(F.col("key") == "publisher")
        .groupBy("package_id")
        .agg(F.min("value").alias("publisher_value"))
    )
    owners = _group_refs(group, "organization_id").withColumnRenamed("ref", "owner_ref")
    publishing = _group_refs(group, "publisher_id").withColumnRenamed("ref", "publisher_ref")
    return (
        package.select(F.col("id").alias("package_id"), F.col("name").alias("package_name"), "owner_org")
        .join(publishers, "package_id", "left")
        .join(owners, F.col("owner_org") == F.col("owner_ref"), "left")
        .join(publishing, F.col("publisher_value") == F.col("publisher_ref"), "left")
        .select("package_id", *PACKAGE_FIELDS)
    )


def _join_package(hits: DataFrame, url_col: str, identities: DataFrame, cfg: PortalConfig) -> DataFrame:
    """Add ``package_id`` and the package fields by id or else by name.

    The catalogue is listed under both references at once, an id going before an equal name, so that it is read
    once and the hits meet it in a single join.
    """
    fields = ("package_id", *PACKAGE_FIELDS)
    references = F.array(
        F.struct(F.lit(0).alias("rank"), F.col("package_id").alias("known_ref")),
        F.struct(F.lit(1).alias("rank"), F.col("package_name").alias("known_ref")),
    )
    known = (
        identities.select("*", F.inline(references))
        .groupBy("known_ref")
        .agg(F.min(F.struct("rank", *fields)).alias("found"))
    )
    return (
        hits.withColumn("ref", package_ref(F.col(url_col), cfg))
        .join(known, F.col("ref") == F.col("known_ref"), "left")
        .withColumns({name: F.col(f"found.{name}") for name in fields})
        .drop("ref", "known_ref", "found")
    )


def resolve_package(
    hits: DataFrame, package: DataFrame, extra: DataFrame, group: DataFrame, cfg: PortalConfig
) -> DataFrame:
    """Add dataset name, organisation and publisher to dataset pages; NULL where the dataset is gone."""
    return _join_package(hits, "url", catalogue_identities(package, extra, group), cfg).drop("package_id")


def _bit(by: list[str]) -> tuple[Column, Column]:
    """The bit that stands for a key: the number of its bitmap and its place there."""
    bit = F.pmod(F.xxhash64(*by), F.lit(LOOKUP_BITS))
    return F.floor(bit / BITMAP_BITS).cast("int"), (bit % BITMAP_BITS).cast("int")


def _perhaps_in(rows: DataFrame, by: list[str], wanted: DataFrame) -> DataFrame:
    """``rows`` without most of those whose key is not in ``wanted``; none of the others is left out.

    Bitmaps of the wanted keys, of ``LOOKUP_BITS`` at most whatever the number of keys, go to all tasks, so that rows are
    dropped where they are instead of after a shuffle. A key may share its bit with another, so a join must follow.
    """
    number, place = _bit(by)
    bitmaps = wanted.select(number.alias("__bitmap"), place.alias("__place")).groupBy("__bitmap").agg(F.bitmap_construct_agg("__place").alias("__bits"))
    marked = rows.withColumns({"__bitmap": number, "__place": place}).join(F.broadcast(bitmaps), "__bitmap")
    # One character per byte, whose code is the byte's value.
    byte = F.ascii(F.decode(F.substring("__bits", F.shiftright("__place", 3) + 1, F.lit(1)), "ISO-8859-1"))
    is_set = F.getbit(byte, F.col("__place") % 8) == 1
    return marked.where(is_set).select(*rows.columns)


def _newest_identity(
    rows: DataFrame, by: list[str], fields: tuple[str, ...], wanted: DataFrame
) -> DataFrame:
    """Per key and its ``SPOT``, the fields of its newest month; among equals of one month, the smallest.

    ``wanted`` holds the only keys of interest: few of all the keys there ever were. Some others may be among the result.
    """
    key = [SPOT, *by]
    candidate = F.struct((-month_number(F.col("year_month"))).alias("age"), *fields)
    newest = _with_spot(_perhaps_in(rows, by, wanted), by).groupBy(*key).agg(F.min(candidate).alias("newest"))
    return newest.select(*key, *[F.col(f"newest.{name}").alias(f"past_{name}") for name in fields])


def _usable_packages() -> Column:
    """Rows that tell the identity of a path."""
    return (F.col("year_month") != ALL_TIME) & _is_filled("package_name") & _is_filled("organization_id") & _is_filled("publisher_id")


def _usable_resources() -> Column:
    """Rows that tell the identity of a file on a page."""
    known = F.col("resource_id").isNotNull() & (F.col("package_name") != ALL_TIME) & _is_filled("organization_id")
    return (F.col("year_month") != ALL_TIME) & known & _is_filled("publisher_id") & _is_filled("format")


def _lost_packages() -> Column:
    return F.col("package_name").isNull()


def _lost_resources() -> Column:
    return F.col("package_name").isNull() | F.col("resource_id").isNull()


def backfill_package(
    resolved: DataFrame, packages_fact: DataFrame, period: str | None = None
) -> DataFrame:
    """Give pages whose dataset is gone the identity earlier months stored for the same path.

    ``period`` is the month being loaded: its old rows are about to be replaced and so do not count. Only pages
    without a dataset are looked up; the others go by untouched. ``resolved`` is read for both, so it should be a
    stored table.
    """
    usable = _usable_packages()
    if period is not None:
        usable = usable & (F.col("year_month") != period)
    lost = resolved.where(_lost_packages())
    past = _newest_identity(packages_fact.where(usable), ["url"], PACKAGE_FIELDS, lost)
    return resolved.where(~_lost_packages()).union(_filled_packages(_with_spot(lost, ["url"]).join(past, [SPOT, "url"], "left")).select(*resolved.columns))


def _filled_packages(rows: DataFrame) -> DataFrame:
    filled = {name: F.col(f"past_{name}") for name in PACKAGE_FIELDS}
    return rows.withColumns(filled).withColumn("package_name", F.coalesce("package_name", F.lit("")))


def _filled_resources(rows: DataFrame) -> DataFrame:
    filled = {name: F.col(f"past_{name}") for name in RESOURCE_FIELDS}
    return rows.withColumns(filled).withColumn("resource_id", F.coalesce("resource_id", F.lit("")))


def datasets_of_pages(hits: DataFrame, package: DataFrame, cfg: PortalConfig) -> DataFrame:
    """(package_id) of every dataset that the page of some hit may mean, by id or by name."""
    refs = hits.select(package_ref(F.col("package_url"), cfg).alias("ref")).distinct()
    listed = package.select(F.col("id").alias("package_id"), F.explode(F.array("id", "name")).alias("known_ref"))
    return listed.join(refs, F.col("known_ref") == F.col("ref"), "left_semi").select("package_id").distinct()


def resolve_resource(
    hits: DataFrame,
    package: DataFrame,
    resource: DataFrame,
    extra: DataFrame,
    group: DataFrame,
    cfg: PortalConfig,
) -> DataFrame:
    """Add the file's id and format, and its dataset, organisation and publisher.

    A file is the first of its dataset, by position, stored under any spelling of the address. ``hits`` has one row per
    month, address and page, as ``resource_hits`` gives it, and is read once.

    Hits and files are brought together once, by dataset and by what all spellings of an address have in common, so one
    shuffle serves both the look-up of each spelling and the choice among the files found. Spellings are made after it.
    """
    row_key = ("url", "package_url", "year_month")
    file = F.struct("position", F.col("id").alias("resource_id"), "format")
    listed = resource.where((F.coalesce("state", F.lit("")) != "deleted") & F.col("package_id").isNotNull() & F.col("url").isNotNull())
    files = listed.select("package_id", "url", file.alias("file"))
    pages = _join_package(hits, "package_url", catalogue_identities(package, extra, group), cfg)
    # Pages without a dataset meet no file, so they may go anywhere. The number is made again after the shuffle: it hardly
    # compresses, and both sides of the shuffle make the same one.
    spot = F.when(F.col("package_id").isNull(), F.hash(*row_key)).otherwise(F.hash("package_id", spelling_root(F.col("url"))))
    together = pages.unionByName(files, allowMissingColumns=True).repartition(spot).withColumn(SPOT, spot)
    is_hit = F.col("file").isNull()
    spelled = with_spellings(together.withColumn("hit_url", F.when(is_hit, F.col("url"))), "hit_url", "spellings")
    # The outer form: the plain one would make Spark test the array's size early, at the price of building it twice.
    spelling = F.explode_outer(F.when(is_hit, F.col("spellings")).otherwise(F.array("url")))
    candidates = spelled.withColumn("spelling", spelling).drop("spellings", "hit_url")
    same_file = Window.partitionBy(SPOT, "package_id", "spelling")
    matched = candidates.withColumn("found", F.min("file").over(same_file)).where(is_hit)
    carried = [c for c in (*hits.columns, *PACKAGE_FIELDS) if c not in row_key]
    best = matched.groupBy(SPOT, *row_key).agg(F.min("found").alias("file"), *[F.any_value(c).alias(c) for c in carried])
    return best.select(
        *hits.columns,
        F.col("file.resource_id").alias("resource_id"),
        *PACKAGE_FIELDS,
        F.col("file.format").alias("format"),
    )


def backfill_resource(
    resolved: DataFrame, resources_fact: DataFrame, period: str | None = None
) -> DataFrame:
    """Give files that were not found all five fields from earlier months, or none.

    Nothing found now is kept for them, not even the dataset of a file that is missing from it. ``period`` and
    ``resolved`` are as for ``backfill_package``.
    """
    usable = _usable_resources()
    if period is not None:
        usable = usable & (F.col("year_month") != period)
    lost = resolved.where(_lost_resources())
    past = _newest_identity(resources_fact.where(usable), PAIR, RESOURCE_FIELDS, lost)
    return resolved.where(~_lost_resources()).union(_filled_resources(_with_spot(lost, PAIR).join(past, [SPOT, *PAIR], "left")).select(*resolved.columns))


# --- months loaded together ----------------------------------------------------------------------------------


def _as_of(
    resolved: DataFrame, fact: DataFrame, by: list[str], fields: tuple[str, ...], lost: Column, usable: Column, first: str
) -> tuple[DataFrame, DataFrame]:
    """Rows whose key has nothing lost, and the others with ``past_`` columns for their lost rows.

    A month of the range sees, as if months were loaded one after another, later months as they were, earlier months of
    the range as they are loaded now, and months before the range. So a lost row takes the newest old identity if its
    month is later than the row's; else the last one that a month of the range before it has or was given; else the
    newest from before the range. One window over a key's months finds the second; it holds a row per month.
    """
    keys = resolved.where(lost).select(*by).distinct()
    # Old identities of touched keys: the newest of all, and the newest from before the range.
    old = fact.where(usable).join(keys, by, "left_semi").withColumn("month", month_number(F.col("year_month")))
    identity = F.struct((-F.col("month")).alias("age"), *fields)
    known = old.groupBy(*by).agg(F.min(identity).alias("newest"), F.min(F.when(F.col("year_month") < first, identity)).alias("before"))
    rows = resolved.join(keys, by, "left_semi").join(known, by, "left").withColumn("month", month_number(F.col("year_month")))
    later = F.when(-F.col("newest.age") > F.col("month"), F.col("newest"))
    own = F.struct((-F.col("month")).alias("age"), *fields)
    told = F.when(lost, later).otherwise(F.when(usable, own))
    earlier = Window.partitionBy(*by).orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    found = rows.withColumn("found", F.coalesce(later, F.last(told, ignorenulls=True).over(earlier), F.col("before")))
    past = found.select(*resolved.columns, *[F.col(f"found.{name}").alias(f"past_{name}") for name in fields])
    return resolved.join(keys, by, "left_anti"), past


def backfill_package_range(resolved: DataFrame, packages_fact: DataFrame, first: str) -> DataFrame:
    """``backfill_package`` for several months at once, equal to loading them one after another from ``first`` on.

    ``resolved`` has a row per month and path, of months from ``first`` on; all months between are loaded, also those
    without rows, so no old row of them counts for a later one. It is read several times and should be stored.
    """
    whole, past = _as_of(resolved, packages_fact, ["url"], PACKAGE_FIELDS, _lost_packages(), _usable_packages(), first)
    same = past.where(~_lost_packages()).select(*resolved.columns)
    return whole.unionByName(same).unionByName(_filled_packages(past.where(_lost_packages())).select(*resolved.columns))


def backfill_resource_range(resolved: DataFrame, resources_fact: DataFrame, first: str) -> DataFrame:
    """``backfill_resource`` for several months at once, as ``backfill_package_range``."""
    whole, past = _as_of(resolved, resources_fact, PAIR, RESOURCE_FIELDS, _lost_resources(), _usable_resources(), first)
    same = past.where(~_lost_resources()).select(*resolved.columns)
    return whole.unionByName(same).unionByName(_filled_resources(past.where(_lost_resources())).select(*resolved.columns))


# --- identities as a table of their own ----------------------------------------------------------------------


def _monthly(rows: DataFrame, by: list[str], fields: tuple[str, ...]) -> DataFrame:
    """Rows as (key, age, identity)."""
    return rows.select(*by, (-month_number(F.col("year_month"))).alias("age"), F.struct(*fields).alias("identity"))


def _known(monthly: DataFrame, by: list[str]) -> DataFrame:
    """Per key the identities of its two newest months, so that one month can be left out: newest, previous.

    One shuffle by the key's number and one sort serve the least identity of a month and the order of the months.
    """
    key = [SPOT, *by]
    month = _with_spot(monthly, by).repartition(SPOT).groupBy(*key, "age").agg(F.min("identity").alias("identity"))
    by_age = Window.partitionBy(*key).orderBy("age")
    entry = F.struct("age", "identity")
    listed = month.select(*by, entry.alias("newest"), F.lead(entry).over(by_age).alias("previous"), F.row_number().over(by_age).alias("place"))
    return listed.where("place = 1").drop("place")


def package_identities(packages_fact: DataFrame) -> DataFrame:
    """(url, newest, previous): what the two newest months that know a path say of it, each (age, identity)."""
    return _known(_monthly(packages_fact.where(_usable_packages()), ["url"], PACKAGE_FIELDS), ["url"])


def resource_identities(resources_fact: DataFrame) -> DataFrame:
    """(url, package_url, newest, previous) of files on pages."""
    return _known(_monthly(resources_fact.where(_usable_resources()), PAIR, RESOURCE_FIELDS), PAIR)


def _changed(known: DataFrame, fact: DataFrame, period: str, by: list[str], usable: Column, fields: tuple[str, ...]) -> DataFrame:
    """Identities after a month was replaced: the month's go in beside what is known of the other months.

    Only keys that tell of the month as it was need the history, since an older month may come up in its place; it is not
    read if there are none.
    """
    age = -int(period.replace("-", ""))
    told = F.coalesce(F.col("newest.age") == age, F.lit(False)) | F.coalesce(F.col("previous.age") == age, F.lit(False))
    of_month = fact.where(usable & (F.col("year_month") == period)).dropna(subset=by)
    now = _known(_monthly(of_month, by, fields), by).select(*by, F.col("newest").alias("now"))
    months = F.array_sort(F.array_compact(F.array("newest", "previous", "now")))
    others = known.where(~told).join(now, by, "left").select(*by, F.get(months, F.lit(0)).alias("newest"), F.get(months, F.lit(1)).alias("previous"))
    first = now.join(known, by, "left_anti").withColumnRenamed("now", "newest").withColumn("previous", F.lit(None).cast(known.schema["previous"].dataType))
    changed = others.unionByName(first)
    if known.where(told).isEmpty():
        return changed
    history = fact.where(usable).join(known.where(told).select(*by), by, "left_semi")
    return changed.unionByName(_known(_monthly(history, by, fields), by))


def package_identities_changed(known: DataFrame, packages_fact: DataFrame, period: str) -> DataFrame:
    """The identities after a month was replaced. ``known`` is read several times and should be a stored table."""
    return _changed(known, packages_fact, period, ["url"], _usable_packages(), PACKAGE_FIELDS)


def resource_identities_changed(known: DataFrame, resources_fact: DataFrame, period: str) -> DataFrame:
    """As ``package_identities_changed``, for files on pages."""
    return _changed(known, resources_fact, period, PAIR, _usable_resources(), RESOURCE_FIELDS)


def store_identities(known: DataFrame, name: str, path: str, buckets: int = 64) -> None:
    """Writes identities as a table of the catalogue, in buckets by path, so that lookups do not move it."""
    by = [c for c in known.columns if c not in ("newest", "previous")]
    known.repartition(buckets, *by).write.mode("overwrite").format("parquet").bucketBy(buckets, *by).sortBy(*by).option("path", path).saveAsTable(name)


def _told(known: DataFrame, by: list[str], fields: tuple[str, ...], period: str | None) -> DataFrame:
    chosen = F.col("newest")
    if period is not None:
        chosen = F.when(F.col("newest.age") == -int(period.replace("-", "")), F.col("previous")).otherwise(chosen)
    return known.select(*by, chosen.alias("told")).select(*by, *[F.col(f"told.identity.{name}").alias(f"past_{name}") for name in fields])


def backfill_package_known(resolved: DataFrame, known: DataFrame, period: str | None = None) -> DataFrame:
    """``backfill_package`` from a table of identities instead of the whole history."""
    past = _told(known, ["url"], PACKAGE_FIELDS, period)
    lost = _filled_packages(resolved.where(_lost_packages()).join(past, "url", "left"))
    return resolved.where(~_lost_packages()).union(lost.select(*resolved.columns))


def backfill_resource_known(resolved: DataFrame, known: DataFrame, period: str | None = None) -> DataFrame:
    """``backfill_resource`` from a table of identities instead of the whole history."""
    past = _told(known, PAIR, RESOURCE_FIELDS, period)
    lost = _filled_resources(resolved.where(_lost_resources()).join(past, PAIR, "left"))
    return resolved.where(~_lost_resources()).union(lost.select(*resolved.columns))
