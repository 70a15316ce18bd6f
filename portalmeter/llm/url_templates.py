"""URL verdicts from rules and from a path-template tree learnt from the URLs that rules decide.

Per host the paths form a tree of segments, of any depth. A segment becomes a wildcard if it looks like a number or a
key, or if its parent has many children that are rarely seen; a segment that is an asterisk is taken for one. A branch
whose labelled share does not differ from that of its siblings is merged with them: it takes its parent's share. Those
that do differ are merged with siblings of a like share. The share of blocked URLs of each branch is smoothed towards its
parent's, the host's towards that of all; a branch without siblings is its parent. Templates above a half are rejected.

Everything is counted per distinct host and path first, by expressions and joins only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portalmeter.llm.words import Scratch

#: (host, path, verdict); a rule fits its host and the hosts below it, and paths that start with its path.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Children of a node from which rarely seen ones become a wildcard, and how often they are seen on average below which.
MANY, RARE = 8, 3.0
SMOOTHING, SIMILAR = 4.0, 1.96
#: Bands of the labelled share, from none to all, in which branches that differ from the rest are alike.
BANDS = 8

_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_VARIABLE = r"^(?:[0-9]+|[0-9a-fA-F]{8,}|[0-9a-fA-F-]{32,}|.*[0-9]{4,}.*|[0-9]+[.][A-Za-z]+)$"
_ANY = "*"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _CAPITALS, _SMALL), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """(rule, verdict) of the longest rule that fits, else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, start, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def segments_of(path: Column) -> Column:
    """The segments of a path; those that look like a number or a key are the wildcard."""
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    return F.transform(parts, lambda x: F.when(x.rlike(_VARIABLE), _ANY).otherwise(x))


def url_templates(units: DataFrame, scratch: Scratch) -> DataFrame:
    """(host, segments, template, cuts) of units (host, segments, n, ...), one per host and path.

    A round takes every node on by what all its paths have in common, however long that is, then by one segment, so
    there are as many rounds as branchings on a path, not as many as segments. ``cuts`` are the lengths at which the
    template left a branching.
    """
    none = F.array().cast("array<string>")
    going = units.select("host", "segments", "n", F.col("segments").alias("rest"), none.alias("template"), F.array().cast("array<int>").alias("cuts"))
    finished = None
    node, depth = ["host", "template"], 0
    while True:
        span = going.groupBy(*node).agg(F.min("rest").alias("low"), F.max("rest").alias("high"))
        # What the first and the last in order have in common, all have.
        differs = F.array_position(F.zip_with("low", "high", lambda a, b: F.coalesce(a == b, F.lit(False))), False)
        span = span.select(*node, F.when(F.col("low") == F.col("high"), -1).otherwise(differs.cast("int") - 1).alias("common"))
        moved = going.join(span, node)
        left = F.slice("rest", F.col("common") + 1, F.size("rest"))
        moved = moved.withColumn("at", F.concat("template", F.slice("rest", 1, F.greatest("common", F.lit(0))))).withColumn("left", F.when(F.col("common") >= 0, left))
        # A path ends where nothing is left of it, or where its node has no other.
        ends = F.col("left").isNull() | (F.size("left") == 0)
        moved = scratch.save(moved, f"moved-{depth}")
        ended = moved.where(ends).select("host", "segments", F.when(F.col("common") >= 0, F.col("at")).otherwise(F.concat("template", "rest")).alias("template"), "cuts")
        finished = ended if finished is None else finished.unionByName(ended)
        open_ = moved.where(~ends).select("host", "segments", "n", F.col("at").alias("template"), "cuts", F.get("left", F.lit(0)).alias("seg"), F.slice("left", 2, F.size("left")).alias("rest"))
        if open_.isEmpty():
            return finished
        child = open_.groupBy(*node, "seg").agg(F.sum("n").alias("seen"))
        many = child.where(F.col("seg") != _ANY).groupBy(*node).agg(F.count("*").alias("children"), F.avg("seen").alias("often"))
        wide = many.where((F.col("children") >= MANY) & (F.col("often") < RARE)).select(*node)
        rare = child.where(F.col("seen") < RARE).join(wide, node, "left_semi").select(*node, "seg", F.lit(True).alias("rare"))
        stepped = open_.join(rare, [*node, "seg"], "left")
        step = F.array(F.when(F.col("rare"), _ANY).otherwise(F.col("seg")))
        cut = F.array(F.size("template") + 1)
        going = scratch.save(stepped.select("host", "segments", "n", "rest", F.concat("template", step).alias("template"), F.concat("cuts", cut).alias("cuts")), f"tree-{depth}")
        depth += 1


def _smooth(blocked: Column, labelled: Column, share: Column) -> Column:
    return (blocked + SMOOTHING * share) / (labelled + SMOOTHING)


def template_purities(units: DataFrame, scratch: Scratch) -> DataFrame:
    """(host, segments, template, purity) of units (host, segments, n, blocked, labelled), one per host and path."""
    tree = scratch.save(url_templates(units, scratch), "tree")
    counts = F.sum("blocked").alias("blocked"), F.sum("labelled").alias("labelled")
    leaf = scratch.save(tree.join(units, ["host", "segments"]).groupBy("host", "template", "cuts").agg(*counts), "leaf")
    total, most = leaf.agg(*counts, F.max(F.size("cuts")).alias("most")).select(F.struct("blocked", "labelled"), F.coalesce("most", F.lit(0))).first()
    base = ((total["blocked"] or 0) + SMOOTHING * 0.5) / ((total["labelled"] or 0) + SMOOTHING)
    root = leaf.groupBy("host").agg(*counts).select("host", F.array().cast("array<string>").alias("node"), "blocked", "labelled")
    known = scratch.save(root.withColumn("purity", _smooth(F.col("blocked"), F.col("labelled"), F.lit(base))), "purity-0")
    best = leaf.select("host", "template", "cuts").join(known.select("host", "purity"), "host")
    for depth in range(1, most + 1):
        length = F.get("cuts", F.lit(depth - 1))
        above = F.slice("template", 1, F.coalesce(F.get("cuts", F.lit(depth - 2)), F.lit(0))) if depth > 1 else F.array().cast("array<string>")
        at = leaf.where(F.size("cuts") >= depth).groupBy("host", above.alias("parent"), F.slice("template", 1, length).alias("node")).agg(*counts)
        up = known.select("host", F.col("node").alias("parent"), F.col("purity").alias("above"), F.col("blocked").alias("all_blocked"), F.col("labelled").alias("all_labelled"))
        joined = at.join(up, ["host", "parent"])
        others, their = F.col("all_labelled") - F.col("labelled"), F.col("all_blocked") - F.col("blocked")
        # Two shares, each with one more of both kinds so that none is certain.
        a, b = (F.col("blocked") + 1) / (F.col("labelled") + 2), (their + 1) / (others + 2)
        pooled = (F.col("all_blocked") + 2) / (F.col("all_labelled") + 4)
        apart = F.abs(a - b) / F.sqrt(pooled * (1 - pooled) * (1 / (F.col("labelled") + 2) + 1 / (others + 2)))
        # Branches unlike the rest are merged with those of the same parent whose share is in the same band. Bands are
        # even where the spread of a share is, and joined by their number alone, so no node's branches meet in one task.
        band = F.when(apart >= SIMILAR, F.least(F.lit(BANDS - 1), F.floor(F.asin(F.sqrt(a)) * (2 * BANDS / math.pi)).cast("int")))
        banded = joined.select("host", "parent", "node", "above", "blocked", "labelled", band.alias("band"))
        alike = banded.where("band is not null").groupBy("host", "parent", "band").agg(F.sum("blocked").alias("b"), F.sum("labelled").alias("l"))
        merged = banded.join(alike, ["host", "parent", "band"], "left")
        purity = F.when(F.col("b").isNull(), F.col("above")).otherwise(_smooth(F.col("b"), F.col("l"), F.col("above")))
        known = scratch.save(merged.select("host", "node", "blocked", "labelled", purity.alias("purity")), f"purity-{depth}")
        nearer = known.select("host", F.col("node").alias("at"), F.col("purity").alias("nearer"))
        best = best.withColumn("at", F.when(F.size("cuts") >= depth, F.slice("template", 1, length))).join(nearer, ["host", "at"], "left").select("host", "template", "cuts", F.coalesce("nearer", "purity").alias("purity"))
    return tree.select("host", "segments", "template").join(best.drop("cuts"), ["host", "template"])


def judge_urls(pages: DataFrame, scratch: Scratch, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) for each row of pages (page_id, url, ...).

    The longest rule that fits decides; template and purity are null then. Other URLs are blocked if their template's
    smoothed share of blocked URLs, among those that rules decide, is above a half. Null URLs and those without
    ``://`` have the empty host and path and are judged as such. Repeated rows are judged, and counted, each; a table
    without labelled URLs allows all. Other columns are ignored.
    """
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    ruled = parsed.withColumn("r", rule_of(F.col("host"), F.col("path"), rules)).withColumn("segments", segments_of(F.col("path")))
    label = F.col("r.verdict")
    units = ruled.groupBy("host", "segments").agg(F.count("*").alias("n"), F.count_if(label == "block").alias("blocked"), F.count(label).alias("labelled"))
    purities = template_purities(scratch.save(units, "units"), scratch)
    # Only URLs without a rule need a template.
    free = ruled.where("r is null").join(purities, ["host", "segments"], "left")
    verdict = F.when(F.col("purity") > 0.5, "block").otherwise("allow")
    judged = free.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), verdict.alias("verdict"), F.array_join("template", "/").alias("template"), "purity")
    sure = ruled.where("r is not null").select("page_id", "host", "path", "r.rule", "r.verdict", F.lit(None).cast("string").alias("template"), F.lit(None).cast("double").alias("purity"))
    return sure.union(judged)
