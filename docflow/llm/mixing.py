"""Mixing sources to target weights by Pfair scheduling, with DataFrame functions only.

A source's documents are cut into blocks of equal size. With a share ``q`` of
``slots``, its block ``k`` is released at ``floor(k * slots / q)`` and due at
``ceil((k + 1) * slots / q)``; in every slot the released block with the earliest
deadline goes next. As shares add up to ``slots``, every block meets its deadline
and no source is ever a whole block away from its target. The schedule repeats
every ``slots`` slots, so it is made once, for one period.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

SLOTS = 1024
BLOCK_BYTES = 65_536
BROADCAST_SLOTS = 65_536
FRACTION_STEPS = 1_000_000_000  # weights that are no whole numbers count in billionths of the largest
SLICE_BITS = 12  # a source is ordered in 4096 slices, none of them in one task with another


def shuffle_key(ids: Column) -> Column:
    """60 bits that order documents as if at random."""
    return F.conv(F.substring(F.md5(F.coalesce(ids.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("bigint")


def _source(column: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("null"))


def slots_for(sources: int) -> int:
    """Slots of a period: ``SLOTS``, or the next power of two that gives every source one."""
    return max(SLOTS, 1 << max(0, sources - 1).bit_length())


def whole_weights(weights: DataFrame) -> DataFrame:
    """Weights as whole numbers in the same proportions; negative ones and those that are not finite end the job."""
    if isinstance(weights.schema["weight"].dataType, IntegralType):
        scaled = F.col("weight").cast("bigint")
    else:
        every, x = Window.partitionBy(), F.col("weight").cast("double")
        steps = F.round(x / F.max(x).over(every) * FRACTION_STEPS)
        odd = F.abs(x) == F.lit(float("inf"))
        x = F.when(odd | F.isnan(x), F.raise_error(F.lit("a weight is not finite"))).otherwise(x)
        scaled = F.when(F.max(x != F.floor(x)).over(every), steps).otherwise(x).cast("bigint")
    below = F.raise_error(F.lit("a weight is negative"))
    return weights.withColumn("weight", F.when(F.col("weight") < 0, below).otherwise(scaled))


def shares(weights: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``(_source, q)`` from ``(_source, weight)``: one slot each, the others by weight and largest remainder."""
    every = Window.partitionBy()
    weights = whole_weights(weights)
    spare = weights.select(
        "_source", F.col("weight").cast("bigint").alias("w"), F.sum(F.col("weight").cast("bigint")).over(every).alias("all"),
        (F.lit(slots) - F.count("*").over(every)).alias("spare"))
    part = F.when(F.col("all") > 0, F.expr("spare * w div all")).otherwise(F.lit(0))
    rest = F.when(F.col("all") > 0, F.expr("spare * w % all")).otherwise(F.lit(0))
    parted = spare.select("_source", "spare", part.alias("part"), rest.alias("rest"))
    left = F.col("spare") - F.sum("part").over(every)
    place = F.row_number().over(Window.orderBy(F.desc("rest"), "_source"))
    many = F.count("*").over(every)
    extra = F.expr("_left div _many") + F.when(F.col("_place") <= F.expr("_left % _many"), 1).otherwise(0)
    return parted.select("_source", "part", left.alias("_left"), place.alias("_place"), many.alias("_many")).select(
        "_source", F.when(F.col("_left") < 0, F.raise_error(F.lit(f"more sources than the {slots} slots")))
        .otherwise(1 + F.col("part") + extra).cast("int").alias("q"))


def schedule(share: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``(_source, q, k, slot)``: where block ``k`` of each source goes within a period."""
    row = share.agg(F.array_sort(F.collect_list(F.struct("_source", "q"))).alias("sources"))
    n = F.lit(slots)

    def choice(done, t):
        def window(s, j):
            k = F.get(done, j)
            due = F.floor(((k + 1) * n + s["q"] - 1) / s["q"]).cast("int")
            return F.when((k < s["q"]) & (k * n < (t + 1) * s["q"]), F.struct(due.alias("due"), j.alias("j")))

        return F.array_min(F.filter(F.transform("sources", window), lambda x: x.isNotNull()))["j"]

    def step(acc, t):
        pick = choice(acc["done"], t)
        return F.struct(
            F.transform(acc["done"], lambda d, j: F.when(j == pick, d + 1).otherwise(d)).alias("done"),
            F.concat(acc["out"], F.array(pick)).alias("out"))

    start = F.struct(
        F.transform("sources", lambda s: F.lit(0)).alias("done"), F.array().cast("array<int>").alias("out"))
    picked = row.where(F.size("sources") > 0).select(
        "sources", F.posexplode(F.aggregate(F.sequence(F.lit(0), n - 1), start, step, lambda a: a["out"])).alias("slot", "j"))
    chosen = picked.select(F.get("sources", F.col("j")).alias("s"), "slot").select("s._source", "s.q", "slot")
    return chosen.withColumn("k", F.row_number().over(Window.partitionBy("_source").orderBy("slot")) - 1)


def mix(
    docs: DataFrame, weights: DataFrame | None = None, slots: int | None = None, block_bytes: int = BLOCK_BYTES,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """All rows and columns of ``docs`` with ``mix_slot``, ``mix_block`` and ``mix_offset``.

    Reading by (``mix_slot``, ``mix_offset``) gives the mixture: at every slot each
    source has had its share to less than one block, until a source ends; its
    slots then stay empty and the others keep their proportions, so no row is
    dropped. ``weights`` has ``source`` and ``weight``, whole numbers or fractions,
    of which the proportions count (null or missing: the least share, one slot;
    negative or not finite: refused); without it a source's weight is the square
    root of its bytes. Without ``slots`` a period has ``slots_for`` the number of
    sources, which are counted first; a number of slots below theirs is refused.

    A document weighs its bytes and one more, so null and empty texts count; it
    belongs to the block in which it starts. Within a source documents are
    ordered by a digest of their id, then id and size; repeated rows follow each
    other. A null source is a source of its own. Columns of ``docs`` with the
    added names are replaced. An empty table gives an empty result.

    Only sizes and positions are shuffled by slices of a source, so a source with
    a third of all rows is spread over thousands of groups. The schedule has
    ``slots`` rows; up to ``BROADCAST_SLOTS`` it is broadcast, above it is joined
    by a shuffle. One task makes it, in ``slots`` steps over all sources.
    """
    own = ["mix_slot", "mix_block", "mix_offset", "_source", "_size", "_key", "_slice", "_id", "q", "k", "slot"]
    rows = docs.drop(*own).select(
        "*", _source(source_col).alias("_source"), F.col(id_col).alias("_id"), shuffle_key(F.col(id_col)).alias("_key"),
        (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("bigint") + 1).alias("_size"),
    ).withColumn("_slice", F.shiftright("_key", 60 - SLICE_BITS).cast("int"))
    if slots is None:
        slots = slots_for(rows.select("_source").distinct().count())
    sent = F.broadcast if slots <= BROADCAST_SLOTS else lambda table: table
    sizes = rows.groupBy("_source", "_slice").agg(F.sum("_size").alias("_bytes"))
    if weights is None:
        target = sizes.groupBy("_source").agg(F.floor(F.sqrt(F.sum("_bytes").cast("double"))).alias("weight"))
    else:
        given = weights.groupBy(_source("source").alias("_source")).agg(F.max("weight").alias("weight"))
        target = sizes.select("_source").distinct().join(given, "_source", "left").select(
            "_source", F.coalesce("weight", F.lit(0)).alias("weight"))
    plan = schedule(shares(target, slots), slots)
    before = Window.partitionBy("_source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = sizes.select("_source", "_slice", F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_carry"))
    upto = Window.partitionBy("_source", "_slice").orderBy("_key", "_id", "_size").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("_upto", F.sum("_size").over(upto)).join(carried, ["_source", "_slice"]).withColumn(
        "_at", F.col("_carry") + F.col("_upto") - F.col("_size"))
    blocked = placed.withColumn("mix_block", F.expr(f"_at div {block_bytes}")).withColumn(
        "mix_offset", F.expr(f"_at % {block_bytes}"))
    share = plan.select("_source", "q").distinct()
    quoted = blocked.join(sent(share), "_source").withColumn("k", F.expr("cast(mix_block % q as int)"))
    kept = [c for c in docs.columns if c not in own]
    return quoted.join(sent(plan.select("_source", "k", "slot")), ["_source", "k"]).select(
        *kept, (F.expr("mix_block div q") * slots + F.col("slot")).alias("mix_slot"), "mix_block", "mix_offset")
