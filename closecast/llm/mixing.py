"""Mixing sources to target weights by a Pfair schedule, in DataFrame and SQL functions only.

Every source's documents, in the order of the md5 of their ids, form blocks of
``block_docs``. A source with ``units`` of the ``total`` weight units is a
periodic task: its block k (from 0) is released at slot floor(k total / units)
and due by ceil((k + 1) total / units). Slots go, one block each, to the
released block with the earliest deadline (ties: the source's name). The
weights sum to one, so every block meets its deadline, and at every slot each
source has had its weight's share of blocks to less than one block.

The schedule repeats after ``total`` slots (every source is back at its start
there), so it is computed once for one period, by a fold over ``total`` slots
of bounded size, and each block's slot follows arithmetically from its number.
Places within a source come from counts per md5 prefix and a window inside
one prefix: no task sees a whole source, however hot.

A source that runs out leaves its later slots empty and the others keep theirs,
so no row is lost or repeated: any prefix of the schedule in which no source
has run out holds the target weights to less than a block each.

Default weights: shares in proportion to the square root of a source's row
count, in ``resolution`` units, at least one unit each.

Defined cases: a null source and the empty one are the same unnamed source; rows with equal
ids keep any order among themselves (they follow each other); null ids come
first; an empty table gives no rows; columns named like the result's are
replaced. Weights given for sources that hold no rows still take their slots;
rows of sources without a given weight get one unit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BLOCK_DOCS = 16
RESOLUTION = 1000
PREFIX = 3  # hex digits of md5: 4096 ranges of a source's documents; more digits for more rows


def source_units(docs: DataFrame, weights: dict[str, int] | None = None, resolution: int = RESOLUTION) -> DataFrame:
    """(source, units): whole weight units of each source, one row per source."""
    name = F.coalesce("source", F.lit("")).alias("source")
    sizes = docs.groupBy(name).agg(F.count(F.lit(1)).alias("rows"))
    if weights is not None:
        given = F.create_map(*[x for s, u in weights.items() for x in (F.lit(s), F.lit(int(u)))]) if weights else F.create_map().cast("map<string,int>")
        listed = docs.sparkSession.createDataFrame([(s,) for s in weights], "source string")
        return (sizes.select("source").union(listed).distinct()
                .select("source", F.coalesce(F.try_element_at(given, F.col("source")), F.lit(1)).cast("long").alias("units")))
    root = F.sqrt("rows")
    total = sizes.agg(F.sum(F.floor(root * 1000)).alias("all"))
    return sizes.crossJoin(F.broadcast(total)).select(  # one row with the total
        "source", F.greatest(F.lit(1), F.floor(F.floor(root * 1000) * resolution / F.col("all"))).cast("long").alias("units"))


def period(units: DataFrame) -> DataFrame:
    """One period of the schedule: (source, units, total, nth, slot), ``total`` rows, by earliest deadline first.

    The source list (one row per source) is folded in a single row.
    """
    packed = units.agg(F.sort_array(F.collect_list(F.struct("source", "units"))).alias("s"), F.sum("units").alias("total"))
    n_of = lambda done, i: F.element_at(done, (i + 1).cast("int"))
    folded = packed.where("total > 0").select("s", "total", F.aggregate(
        F.sequence(F.lit(0).cast("long"), F.col("total") - 1),
        F.struct(F.transform("s", lambda x: F.lit(0).cast("long")).alias("done"), F.array().cast("array<int>").alias("order")),
        lambda st, t: _step(st, t, n_of)).alias("st"))
    slots = folded.select("s", "total", F.posexplode("st.order").alias("slot", "i"))
    one = slots.select(F.element_at("s", F.col("i") + 1).alias("x"), "total", "slot")
    return one.select("x.source", "x.units", "total", (F.row_number().over(W.partitionBy("x.source").orderBy("slot")) - 1).cast("long").alias("nth"),
                      F.col("slot").cast("long").alias("slot"))


def _step(st, t, n_of):
    """Give slot ``t`` to the released block with the earliest deadline."""
    ready = F.filter(
        F.transform(F.col("s"), lambda x, i: F.struct(
            F.ceil((n_of(st["done"], i) + 1) * F.col("total") / x["units"]).alias("due"), i.alias("i"),
            (F.floor(n_of(st["done"], i) * F.col("total") / x["units"]) <= t).alias("released"))),
        lambda c: c["released"])
    pick = F.array_min(ready)["i"]
    return F.struct(F.transform(st["done"], lambda d, i: F.when(i == pick, d + 1).otherwise(d)).alias("done"),
                    F.concat(st["order"], F.array(pick)).alias("order"))


def mix_sources(docs: DataFrame, weights: dict[str, int] | None = None, block_docs: int = BLOCK_DOCS, resolution: int = RESOLUTION,
                prefix: int = PREFIX) -> DataFrame:
    """``docs`` with block (number within the source), slot (its place in the mix) and in_block (place within the block)."""
    ours = ("block", "slot", "in_block")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ours]
    tagged = docs.select(*kept, F.coalesce("source", F.lit("")).alias("__source"), F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("__md5"))
    tagged = tagged.withColumn("__range", F.substring("__md5", 1, prefix))
    # rows before each range of each source: sources x 16^prefix numbers, never the rows themselves
    ranges = tagged.groupBy("__source", "__range").agg(F.count(F.lit(1)).alias("n"))
    before = ranges.select("__source", "__range", (F.sum("n").over(W.partitionBy("__source").orderBy("__range")) - F.col("n")).alias("__before"))
    nth = F.row_number().over(W.partitionBy("__source", "__range").orderBy("__md5", "doc_id"))
    placed = tagged.withColumn("__nth", nth).join(before, ["__source", "__range"]).withColumn("__k", F.col("__before") + F.col("__nth") - 1)
    placed = placed.withColumn("block", F.floor(F.col("__k") / block_docs).cast("long")).withColumn("in_block", (F.col("__k") % block_docs).cast("long"))
    plan = period(source_units(docs, weights, resolution))
    per = plan.select(F.col("source").alias("__source"), F.col("units").alias("__units"), F.col("nth").alias("__turn"), F.col("slot").alias("__slot"), F.col("total").alias("__total"))
    units = per.select("__source", "__units").distinct()
    turned = placed.join(units, "__source").withColumn("__turn", F.col("block") % F.col("__units"))
    out = turned.join(per.drop("__units"), ["__source", "__turn"]).withColumn("slot", F.floor(F.col("block") / F.col("__units")).cast("long") * F.col("__total") + F.col("__slot"))
    return out.select(*kept, *ours)
