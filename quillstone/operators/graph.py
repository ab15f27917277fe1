"""Co-occurrence networks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def busy(members: DataFrame, least: int) -> DataFrame:
    """(member, n): members of at least so many items."""
    return members.distinct().groupBy("member").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def pairs_within(members: DataFrame, item: str = "item", member: str = "member") -> DataFrame:
    """(a, b) with a < b of the members of each item, which count once: gathered once, not joined with themselves.

    An item's pairs are the square of its members by definition; an item is a short list, such as a byline.
    """
    sets = members.groupBy(item).agg(F.array_sort(F.collect_set(member)).alias("all"))
    firsts = sets.where(F.size("all") > 1).select("all", F.posexplode("all").alias("i", "a"))
    return firsts.select("a", F.explode(F.slice("all", F.col("i") + 2, F.size("all"))).alias("b"))


def edges(members: DataFrame) -> DataFrame:
    """(a, b, w): pairs of members a < b that share items, and how many. Members count once an item."""
    return pairs_within(members).groupBy("a", "b").agg(F.count(F.lit(1)).alias("w"))


def degrees(links: DataFrame) -> DataFrame:
    both = links.select(F.col("a").alias("member")).unionAll(links.select(F.col("b").alias("member")))
    return both.groupBy("member").agg(F.count(F.lit(1)).alias("degree"))


def k_core(links: DataFrame, least: int, *, cut=None, most_rounds: int = 1000) -> DataFrame:
    """The links among members that keep at least ``least`` neighbours, pruned until nothing changes.

    Each round cuts the lineage by a reliable checkpoint; what is counted on the driver is a number of links.
    """
    from quillstone.plans.checkpoint import checkpoint

    cut = cut or checkpoint
    now = cut(links)
    count = now.count()
    for _ in range(most_rounds):
        keep = degrees(now).where(F.col("degree") >= least).select("member")
        now = cut(now.join(keep.withColumnRenamed("member", "a"), "a", "left_semi").join(keep.withColumnRenamed("member", "b"), "b", "left_semi").select("a", "b", "w"))
        before, count = count, now.count()
        if count == before:
            return now
    raise RuntimeError("the core did not settle")


def network(members: DataFrame, *, min_items: int, min_links: int) -> DataFrame:
    """Links of the k-core among busy members; the threshold on items comes before the links."""
    kept = members.join(busy(members, min_items).select("member"), "member", "left_semi")
    return k_core(edges(kept), min_links)


def nodes(members: DataFrame, links: DataFrame, labels: DataFrame) -> DataFrame:
    """(member, n, e, r, total, score): items of each node by label, and its score (e + r / 2) / total, .5 for none.

    labels: (item, label) with labels E, R or others.
    """
    inside = degrees(links).select("member")
    items = members.distinct().join(inside, "member", "left_semi").join(labels, "item", "left")
    counted = items.groupBy("member").agg(F.count_distinct("item").alias("n"), F.count_if(F.col("label") == "E").alias("e"), F.count_if(F.col("label") == "R").alias("r"), F.count("label").alias("total"))
    return counted.withColumn("score", F.when(F.col("total") == 0, 0.5).otherwise(F.round((F.col("e") + F.col("r") / 2) / F.col("total"), 6)))


def ramp(score, steps: int = 10):
    """The colour step of a score, halves to even."""
    return F.bround(score * steps, 0).cast("long")


def numbered(found: DataFrame) -> DataFrame:
    """Nodes with display numbers by (-n, member), from 0 and from 1.

    Ranges of the order are numbered by themselves; how many rows stand before a range is a sum over a row a range.
    """
    from quillstone.plans.checkpoint import checkpoint

    order = [F.desc("n"), F.asc("member")]
    ranged = checkpoint(found.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()))
    nth = ranged.withColumn("__nth", F.row_number().over(Window.partitionBy("__range").orderBy(*order)))
    sizes = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("__size"))
    before = sizes.select("__range", F.coalesce(F.sum("__size").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    placed = nth.join(before, "__range").withColumn("i", (F.col("__before") + F.col("__nth") - 1).cast("long"))
    return placed.withColumn("num", F.col("i") + 1).drop("__range", "__nth", "__before")


def remapped(links: DataFrame, numbers: DataFrame) -> DataFrame:
    """(s, t, w): links by the numbers of their ends."""
    s = numbers.select(F.col("member").alias("a"), F.col("i").alias("s"))
    t = numbers.select(F.col("member").alias("b"), F.col("i").alias("t"))
    return links.join(s, "a").join(t, "b").select("s", "t", "w")
