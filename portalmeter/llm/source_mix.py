"""Mixes sources to target weights by a multivariate-hypergeometric splitting tree.

The documents of a source stand in a line in the order of a hash, again and again; the source gives the words of the
line up to its target. The line is cut into blocks. Output shards are the leaves of a tree: at each node the blocks
of every source are split between the two halves by a draw from the multivariate hypergeometric distribution, so
each shard gets its exact number of blocks and every way of dealing them is as likely as in a full shuffle. A shard
then draws its blocks of each source from a keyed permutation, disjoint from the others', and orders its rows by a
hash. The words that the mix takes are those of the blocks so dealt.

Only expressions, no Python. The draws depend on a seed and their place in the tree, so reruns agree.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portalmeter.llm.words import GAP, Scratch

WEIGHTS = (3.0, 1.0, 2.0)
SHARE, MOST = 1.5, 2.0
BLOCK_WORDS, SHARD_WORDS = 1 << 14, 1 << 22
#: Documents of a source that are put in order together.
BUCKET_ROWS = 4096


def word_count(text: Column) -> Column:
    """The number of words of a text: its gaps, and one more, without those at its ends."""
    inner = F.regexp_replace(F.coalesce(text, F.lit("")), f"^{GAP}|{GAP}$", "")
    return F.when(inner == "", 0).otherwise(F.size(F.split(inner, GAP))).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(sid, source, source_size, source_rows, target) for each of the sources (source, source_size, source_rows).

    Sources in order of code points, null last, have the weights in turn, and share ``share`` of all words. A target
    stops at ``most`` times its source's size; what is over is shared by weight among the others. That is a level
    times the weight, up to the cap: with sources in order of cap by weight the first whose share of what is left
    stays below its cap sets the level for all that follow.
    """
    order = Window.orderBy(F.asc_nulls_last("source"))
    turn = F.row_number().over(order)
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(turn - 1, F.lit(len(weights))).cast("int") + 1)
    weighed = sizes.select("*", (turn - 1).alias("sid"), weight.alias("weight"), (most * F.col("source_size")).alias("cap"))
    ranked = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    before, after = ranked.rowsBetween(Window.unboundedPreceding, -1), ranked.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    fit = weighed.withColumn("level", level).withColumn("reached", F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "sid", "level")))
    final = fit.withColumn("level", F.min("reached").over(everything).getField("level"))
    return final.select("sid", "source", "source_size", "source_rows", F.least("cap", F.coalesce(F.col("level") * F.col("weight"), "cap")).alias("target"))


def _log_factorial(n: Column) -> Column:
    x = F.greatest(n, F.lit(1)).cast("double")
    series = x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x) + 1 / (12 * x) - 1 / (360 * x * x * x)
    return F.when(n <= 20, F.log(F.factorial(F.least(n, F.lit(20)).cast("int")).cast("double"))).otherwise(series)


def hypergeometric(total: Column, marked: Column, drawn: Column, uniform: Column) -> Column:
    """How many of ``drawn`` blocks out of ``total`` are among the ``marked``: the draw that a uniform number selects.

    Outcomes are tried from the likeliest one outwards until their probabilities pass the number. Beyond twelve standard
    deviations they add nothing at double precision; a number that rounding keeps above all sums gives the last outcome.
    """
    choose = lambda n, k: _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)
    low, high = F.greatest(F.lit(0).cast("long"), drawn - (total - marked)), F.least(marked, drawn)
    mode = F.greatest(low, F.least(high, F.floor((drawn + 1.0) * (marked + 1.0) / (total + 2.0))))
    top = F.exp(choose(marked, mode) + choose(total - marked, drawn - mode) - choose(total, drawn))
    share = marked / F.greatest(total, F.lit(1))
    deviation = F.sqrt(drawn * share * (1 - share) * (total - drawn) / F.greatest(total - 1, F.lit(1)))
    steps = F.sequence(F.lit(1), F.least(high - low, F.ceil(12 * deviation) + 30).cast("int") + 1)

    def step(s: Column, _: Column) -> Column:
        up, down = s["up"].cast("double"), s["down"].cast("double")
        rise = s["p_up"] * (marked - up) * (drawn - up) / ((up + 1) * (total - marked - drawn + up + 1))
        fall = s["p_down"] * down * (total - marked - drawn + down) / ((marked - down + 1) * (drawn - down + 1))
        found = F.when(s["out"] >= 0, s["out"]).when(s["sum"] + rise > uniform, s["up"] + 1).when(s["sum"] + rise + fall > uniform, s["down"] - 1).otherwise(s["out"])
        return F.struct(
            (s["sum"] + rise + fall).alias("sum"), (s["up"] + 1).alias("up"), rise.alias("p_up"), (s["down"] - 1).alias("down"), fall.alias("p_down"), found.alias("out")
        )

    start = F.struct(
        top.alias("sum"), mode.alias("up"), top.alias("p_up"), mode.alias("down"), top.alias("p_down"), F.when(top > uniform, mode).otherwise(F.lit(-1).cast("long")).alias("out")
    )
    return F.aggregate(steps, start, step, lambda s: F.when(s["out"] >= 0, s["out"]).otherwise(F.least(s["up"], high)))


def permuted(place: Column, size: Column, *key: Column, rounds: int = 40) -> Column:
    """A place below ``size`` in a permutation that the key fixes: swap-or-not rounds, so any size is met exactly.

    In a round a place and its mirror image about a hashed point change places, or do not, by a hash of the pair.
    """

    def one(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(*key, r), size) - x, size)
        return F.when(F.xxhash64(*key, r, F.greatest(x, other)) % 2 == 0, x).otherwise(other)

    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), place.cast("long"), one)


def _split(counts: Column, room: Column, seed: int, lo: Column, hi: Column) -> Column:
    """The left half's blocks of each source: one draw per source from what the ones before it have left."""

    def draw(s: Column, i: Column) -> Column:
        uniform = F.shiftrightunsigned(F.xxhash64(F.lit(seed), lo, hi, i), 11) * 2.0**-53
        k = hypergeometric(s["total"], F.get(counts, i), s["room"], uniform)
        return F.transform(F.array(k), lambda x: F.struct((s["total"] - F.get(counts, i)).alias("total"), (s["room"] - x).alias("room"), F.concat(s["left"], F.array(x)).alias("left")))[0]

    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    start = F.struct(total.alias("total"), room.alias("room"), F.array().cast("array<bigint>").alias("left"))
    return F.aggregate(F.sequence(F.lit(0), F.size(counts) - 1), start, draw, lambda s: s["left"])


def splitting_tree(quotas: DataFrame, shards: int, scratch: Scratch, seed: int) -> DataFrame:
    """(shard, counts): how many blocks of each source each shard gets, from one row (counts) of all of them."""
    nodes = quotas.select(F.lit(0).alias("lo"), F.lit(shards).alias("hi"), "counts", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("all"))
    edge = lambda i: F.floor(i * F.col("all") / shards).cast("long")
    for depth in range(max(0, math.ceil(math.log2(shards)))):
        mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        inner = F.col("hi") - F.col("lo") > 1
        split = nodes.withColumn("mid", mid).withColumn("left", F.when(inner, _split(F.col("counts"), edge(F.col("mid")) - edge(F.col("lo")), seed, F.col("lo"), F.col("hi"))))
        half = lambda lo, hi, counts: F.struct(lo.alias("lo"), hi.alias("hi"), counts.alias("counts"))
        right = F.zip_with("counts", "left", lambda a, b: a - b)
        both = F.array(half(F.col("lo"), F.col("mid"), F.col("left")), half(F.col("mid"), F.col("hi"), right))
        kept = F.array(half(F.col("lo"), F.col("hi"), F.col("counts")))
        nodes = split.select(F.explode(F.when(inner, both).otherwise(kept)).alias("n"), "all").select("n.*", "all")
        # One level a job: the draws are long expressions, and several levels of them in one plan fill the driver.
        nodes = scratch.save(nodes, f"tree-{depth}")
    return nodes.select(F.col("lo").alias("shard"), "counts")


def mix_sources(
    docs: DataFrame,
    scratch: Scratch,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = 7,
) -> DataFrame:
    """The mix of docs (doc_id, text, source, ...): a row for each time a document is taken, whole or in part.

    Columns: doc_id, size, source, source_size, target, row (three numbers that tell rows of docs apart), shard,
    place in the shard, copy, n_words. A document that is not taken has one row with n_words 0 and no shard. The
    document at the end of a source's last round gives only its first n_words words, so a source's words differ
    from its target by rounding alone; none gives more than ``most`` (at most 2) times its size.

    Null texts and those of white space have size 0 and are never taken. Null is a source like others, the last.
    Rows that are equal are taken on their own account. No rows give no rows. Other columns are ignored.
    """
    place = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("source"), F.col("text")), 11)
    sized = scratch.save(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), place.alias("u")), "sized")
    sources = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows")), weights, share, most)
    take = F.least(F.round("target").cast("long"), F.floor(most * F.col("source_size")).cast("long"))
    blocks = lambda words: F.ceil(words / block_words)
    quota = F.when(F.col("take") <= F.col("source_size"), blocks(F.col("take"))).otherwise(blocks(F.col("source_size")) + blocks(F.col("take") - F.col("source_size")))
    sources = scratch.save(sources.withColumn("take", take).withColumn("quota", quota.cast("long")), "sources")
    wanted = sources.agg(F.sum("take")).first()[0] or 0
    shards = max(1, math.ceil(wanted / shard_words))

    # Which blocks of a source go to which shard.
    quotas = sources.groupBy().agg(F.transform(F.array_sort(F.collect_list(F.struct("sid", "quota"))), lambda x: x["quota"]).alias("counts")).where("size(counts) > 0")
    leaves = splitting_tree(quotas, shards, scratch, seed).select("shard", F.posexplode("counts").alias("sid", "n"))
    start = F.coalesce(F.sum("n").over(Window.partitionBy("sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = leaves.withColumn("start", start).where("n > 0").join(sources.select("sid", "quota"), "sid")
    draw = ranges.select("sid", "shard", "quota", F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("draw"))
    dealt = draw.select("sid", "shard", permuted(F.col("draw"), F.col("quota"), F.lit(seed), F.col("sid")).alias("block"))

    # Where each document stands in its source's line.
    row = sized.join(sources.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    buckets = F.ceil(F.col("source_rows") / BUCKET_ROWS)
    row = row.withColumn("bucket", F.floor(F.col("u") * 2.0**-53 * buckets))
    ahead = row.groupBy("sid", "bucket").agg(F.sum("size").alias("words"))
    ahead = ahead.select("sid", "bucket", F.coalesce(F.sum("words").over(Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    line = Window.partitionBy("sid", "bucket").orderBy("u", "doc_id", "size")
    within = F.coalesce(F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    row = row.withColumn("within", within).withColumn("n", F.row_number().over(line)).join(ahead, ["sid", "bucket"]).withColumn("at", F.col("ahead") + F.col("within"))

    round_words = lambda c: F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("take") - F.col("at") - c * F.col("source_size")))
    piece = lambda c: F.struct(F.lit(c).alias("copy"), round_words(c).alias("n_words"))
    pieces = F.filter(F.array(piece(0), piece(1)), lambda p: (p["copy"] == 0) | (p["n_words"] > 0))
    piece_rows = row.withColumn("p", F.explode(pieces)).select(
        "doc_id", "size", "source", "source_size", "target", F.struct("sid", "bucket", "n").alias("row"), "sid", "u", "p.copy", "p.n_words",
        F.when(F.col("p.n_words") > 0, F.floor(F.col("at") / block_words) + F.col("p.copy") * blocks(F.col("source_size"))).alias("block"),
    )
    return in_shards(piece_rows, dealt, seed)


def in_shards(pieces: DataFrame, dealt: DataFrame, seed: int) -> DataFrame:
    """Pieces of documents in the shards that their blocks were dealt to (sid, block, shard), in a shuffled order each.

    Words are taken through a dealt block only: a piece whose block no shard has gives none.
    """
    met = pieces.join(dealt, ["sid", "block"], "left")
    shuffled = met.withColumn("n_words", F.when(F.col("shard").isNotNull(), F.col("n_words")).otherwise(F.lit(0).cast("long")))
    # Rows without a shard are not put in order; they are spread out.
    order = Window.partitionBy("shard", F.when(F.col("shard").isNull(), F.xxhash64("row"))).orderBy(F.xxhash64(F.lit(seed), "u", "copy"), "row")
    mixed = shuffled.withColumn("place", F.when(F.col("shard").isNotNull(), F.row_number().over(order)))
    return mixed.select("doc_id", "size", "source", "source_size", "target", "row", "shard", "place", "copy", "n_words")


def taken_words(mixed: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken, parts) for each row of the documents that went into a mix.

    ``parts`` says where its words went: shard, place in it, and how many words, a part for each time it is taken.
    """
    part = F.when(F.col("shard").isNotNull(), F.struct("copy", "shard", "place", "n_words"))
    whole = mixed.groupBy("row").agg(*[F.first(c).alias(c) for c in ("doc_id", "size", "source_size", "target")], F.sum("n_words").alias("taken"), F.array_sort(F.collect_list(part)).alias("parts"))
    return whole.drop("row")
