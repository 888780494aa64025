"""Mixing sources to target weights by Sainte-Laguë apportionment.

Sources in code-point order (null last) get the weights 5, 2, 1, repeating,
as shares of all words.  A target stops at ``most`` times its source's words
and the excess goes to the others by weight, until none is above.

Seats are blocks of ``block`` words.  They go to sources by the highest
quotients target / (2 seats + 1), then to the shards of a source in the same
way, by the shards' words; a shard is a hash bucket of a source's documents
with about ``shard_words`` words, so a source of any size is cut into bounded
shards.  In a shard the documents lie end to end in a seeded order and are
cut into blocks of equal length; the quota takes blocks in another seeded
order, all of them once before any is taken again.  A document's ``taken`` is
the length of its parts in taken blocks, with repeats, so it never exceeds
``most`` times its size.

The highest-quotients rule equals rounding target / d to the nearest integer
for a divisor d that uses up the seats.  Rounding moves the sum by half a
seat a party at most, which brackets d; passes that each test many divisors
in one aggregate over the (source or shard) table narrow it.  The seats the
bracket leaves open, fewer than the parties, go by quotient.

Null and empty texts have size 0 and are taken 0 times.  Repeated rows (equal
id) are rows of their own; their order follows their text.  A null id is an
id like any other.  Extra columns are not used.  With no words at all every
target is 0; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankspark.llm.common import WORD, stored

#: Divisors tested at once, and passes: each narrows the bracket 64-fold.
TESTED, PASSES = 64, 2


def apportion(parties: DataFrame, votes: str, seats: str, order: list[str], group: list[str]) -> DataFrame:
    """``parties`` with ``quota``: the group's ``seats`` (equal in its rows) given by highest quotients of ``votes``.

    Ties go by ``order``.  Parties without votes get none.
    """
    g = group or ["_all"]
    base = parties if group else parties.withColumn("_all", F.lit(0))
    base = stored(base.where(F.col(votes) > 0).select(*dict.fromkeys([*g, *order, votes, seats])), "parties")
    # at lo the seats are used up or more, at hi not exceeded
    box = base.groupBy(*g).agg(F.sum(votes).alias("v"), F.max(votes).alias("vmax"), F.count("*").alias("n"), F.max(seats).cast("double").alias("s")) \
        .select(*g, "s", (F.col("v") / (F.col("s") + F.col("n") / 2 + 1)).alias("lo"),
                F.when(F.col("s") > F.col("n") / 2 + 1, F.col("v") / (F.col("s") - F.col("n") / 2 - 1)).otherwise(F.col("vmax") * 2 + 1).alias("hi"))
    box = stored(box, "divisors")
    for _ in range(PASSES):
        step = (F.col("hi") - F.col("lo")) / TESTED
        tests = [F.sum(F.floor(F.col(votes) / (F.col("lo") + step * i) + 0.5)).alias(f"f{i}") for i in range(1, TESTED)]
        # the seats given fall with the divisor: how many tested ones give more than there are
        over = sum((F.col(f"f{i}") > F.col("s")).cast("int") for i in range(1, TESTED))
        box = stored(base.drop(seats).join(box, g).groupBy(*g, "s", "lo", "hi").agg(*tests).withColumn("k", over)
                     .select(*g, "s", (F.col("lo") + step * F.col("k")).alias("lo"), (F.col("lo") + step * (F.col("k") + 1)).alias("hi")), "divisors")
    sure = base.join(box.drop("s"), g).withColumn("quota", F.floor(F.col(votes) / F.col("hi") + 0.5).cast("long")) \
        .withColumn("more", F.floor(F.col(votes) / F.col("lo") + 0.5).cast("long") - F.col("quota"))
    sure = stored(sure, "sure")
    left = sure.groupBy(*g).agg((F.max(seats) - F.sum("quota")).alias("left"))
    # each open seat is one row: at most a few for a party, all of nearly equal quotient
    opened = sure.where("more > 0").withColumn("j", F.explode(F.sequence(F.lit(1).cast("long"), F.col("more")))) \
        .withColumn("quotient", F.col(votes) / (2 * (F.col("quota") + F.col("j")) - 1))
    w = Window.partitionBy(*g).orderBy(F.desc("quotient"), *[F.col(c).asc_nulls_last() for c in order], "j")
    won = opened.join(left, g).withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= F.col("left")) \
        .groupBy(*dict.fromkeys([*g, *order])).agg(F.count("*").alias("won"))
    out = sure.join(won, list(dict.fromkeys([*g, *order])), "left").withColumn("quota", F.col("quota") + F.coalesce("won", F.lit(0)))
    keep = list(dict.fromkeys([*group, *order]))
    return parties.join(out.select(*keep, "quota"), keep, "left").withColumn("quota", F.coalesce("quota", F.lit(0).cast("long")))


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """``sizes(source, source_size)``, one row a source -> with ``src`` (its number) and ``target``."""
    spark = sizes.sparkSession
    ordered = sizes.select("source", "source_size").sort(F.col("source").asc_nulls_last())
    ranked = ordered.rdd.zipWithIndex().map(lambda x: (x[0][0], x[0][1], x[1])) \
        .toDF(f"source {dict(sizes.dtypes)['source']}, source_size long, src long")
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("src") % len(weights) + 1).cast("int"))
    t = stored(ranked.withColumn("weight", pick).withColumn("cap", F.col("source_size") * float(most)), "sources")
    total = t.agg(F.sum("source_size")).first()[0] or 0
    scale, capped = None, -1
    while True:  # one pass for each round of resharing; sources that stop stay stopped
        stop = F.lit(False) if scale is None else F.col("cap") <= F.col("weight") * F.lit(scale)
        n, held, rest = t.agg(F.count(F.when(stop, 1)), F.sum(F.when(stop, F.col("cap")).otherwise(0.0)),
                              F.sum(F.when(stop, 0.0).otherwise(F.col("weight")))).first()
        if n == capped or not rest:
            break
        capped, scale = n, (total - held) / rest
    target = F.lit(0.0) if scale is None else F.least(F.col("cap"), F.col("weight") * F.lit(scale))
    return t.select("src", "source", "source_size", target.cast("double").alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (5, 2, 1),
        most: int = 3, block: int = 64, shard_words: int = 1 << 17, seed: int = 6) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every document (see the module's text)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    sized = stored(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                               F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.xxhash64(text).alias("mark")), "sized")
    src = stored(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
                 .withColumn("shards", F.greatest(F.ceil(F.col("source_size") / F.lit(shard_words)), F.lit(1)).cast("int")), "targets")
    # a source table that adaptive execution finds small is broadcast; else its skewed join is split
    known = sized.join(src.select(F.col("source").alias("s"), "src", "shards"), F.col("source").eqNullSafe(F.col("s"))).drop("s", "source")
    dealt = stored(known.withColumn("shard", F.pmod(F.xxhash64("doc_id", "mark", F.lit(seed)), F.col("shards")).cast("int")).drop("shards"), "dealt")

    total = src.agg(F.sum("target")).first()[0] or 0.0
    given = apportion(src.withColumn("seats", F.lit(round(total / block)).cast("long")), "target", "seats", ["src"], [])
    given = stored(given.withColumnRenamed("quota", "source_quota"), "given")
    shards = dealt.groupBy("src", "shard").agg(F.sum("size").alias("words")) \
        .join(given.select("src", "source_size", "source_quota", "target"), "src")
    # a shard can take `most` times its words at most; its votes are its words
    quotas = stored(apportion(shards, "words", "source_quota", ["src", "shard"], ["src"]).select("src", "shard", "words", "quota"), "quotas")

    lie = Window.partitionBy("src", "shard").orderBy(F.xxhash64("doc_id", "mark", F.lit(seed + 1)), F.col("doc_id").asc_nulls_last(), "mark")
    # the last word's number within the shard, words counted from 0
    laid = dealt.withColumn("end", F.sum("size").over(lie.rowsBetween(Window.unboundedPreceding, 0)))
    # blocks: all of `block` words but the last, which has the rest of the shard
    cut = quotas.where("quota > 0 and words > 0").withColumn("n", F.ceil(F.col("words") / F.lit(block)).cast("long")) \
        .withColumn("rounds", F.least(F.floor(F.col("quota") / F.col("n")), F.lit(most)).cast("long")) \
        .withColumn("over", F.when(F.col("rounds") >= most, 0).otherwise(F.col("quota") - F.col("rounds") * F.col("n")).cast("long"))
    blocks = cut.where("over > 0").select("src", "shard", "over", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("b"))
    pick = Window.partitionBy("src", "shard").orderBy(F.xxhash64("src", "shard", "b", F.lit(seed + 2)), "b")
    # the chosen blocks of a shard as one list of block numbers: bounded by the shard's words
    chosen = blocks.withColumn("rn", F.row_number().over(pick)).where("rn <= over").groupBy("src", "shard").agg(F.collect_list("b").alias("extra"))
    plan = stored(cut.join(chosen, ["src", "shard"], "left").select("src", "shard", "rounds", F.col("extra")), "plan")
    a, z = F.col("end") - F.col("size"), F.col("end")
    parts = laid.join(plan, ["src", "shard"], "left").withColumn(
        "own", F.array_intersect(F.sequence(F.floor(a / block), F.floor((z - 1) / block)), F.coalesce("extra", F.array().cast("array<bigint>"))))
    extra = F.aggregate("own", F.lit(0).cast("long"), lambda s, b: s + F.least(z, (b + 1) * block) - F.greatest(a, b * block))
    taken = F.when(F.col("size") > 0, F.coalesce("rounds", F.lit(0)) * F.col("size") + extra).otherwise(F.lit(0)).cast("long")
    return parts.select("doc_id", "src", "size", taken.alias("taken")) \
        .join(src.select("src", "source_size", "target"), "src").select("doc_id", "size", "source_size", "target", "taken")
