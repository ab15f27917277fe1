"""Mixing sources to target weights by Sainte-Lague apportionment.

Every source's target is its share by weight of all words, at most ``most`` times what it has; what a
full source can't take is shared by weight among the rest. The mix is dealt in blocks of ``block``
words: sources get their numbers of blocks by the highest quotients target / (2 k + 1), and so do the
shards of a source by their sizes. In a shard, documents stand in a seeded order as one stream of
words; its quota makes whole rounds over the stream plus a run of blocks from a seeded start, round the end, so
that few documents are cut. What a document gives is what its part of the stream holds of the rounds and blocks.

Shards have about ``SHARD_WORDS`` words, so a hot source is many shards: up to ``MOST_SHARDS``, beyond which (some
2^33 words a source) they grow with it. A shard's stream is sorted, not held. The quotients of a window that gets all remaining seats are computed by a divisor that
leaves at most one seat a party, not one by one.

Defined results: a null text has size 0 and gives nothing. A null source is a source, sorted last.
Rows equal in everything are interchangeable. Sources without words have target 0. Extra columns pass
through ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstone.llm.common import WORD, checkpoint, columns_of, tabled, unpack

WEIGHTS = (5, 2, 1)
MOST = 3
BLOCK = 32
SHARD_WORDS = 1 << 17
MOST_SHARDS = 1 << 16
SEED = 20240601


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A name for each source that is never null, so that windows and joins share one partitioning."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def source_targets(sizes: DataFrame, *, weights: tuple[float, ...] = WEIGHTS, most: float = MOST, share: float = 1.0) -> DataFrame:
    """(source, source_size, weight, target) from (source, size); a row for each source.

    A level makes the targets min(most * size, level * weight) add up. Sources in order of their limit
    by weight fill up one after another; the level is that of the first which doesn't.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(place) - 1, F.lit(len(weights))) + 1).cast("int"))
    weighed = by_source.withColumn("weight", weight).withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    everything = Window.partitionBy()
    up = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").isNull(), F.col("source"))
    before = F.coalesce(F.sum("cap").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(up.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = (F.lit(float(share)) * F.sum("source_size").over(everything) - before) / rest
    ranked = weighed.withColumn("level", level).withColumn("nth", F.row_number().over(up)).withColumn("open", F.col("cap") > F.col("level") * F.col("weight"))
    levelled = ranked.withColumn("level", F.min_by(F.when(F.col("open"), F.col("level")), F.when(F.col("open"), F.col("nth"))).over(everything))
    target = F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    return levelled.select("source", F.col("source_size").cast("long").alias("source_size"), "weight", target.alias("target"))


def apportion(parties: DataFrame, *, within: list[str], size: str, seats: str, ties: list[str], into: str) -> DataFrame:
    """Sainte-Lague seats of each party by the highest quotients size / (2 k + 1).

    Parties compete within the groups named; seats is the group's number. With the divisor
    total / (seats - parties / 2) rounding can't give too many seats; at most one a party remains to be
    dealt by quotient, a large party's several.
    """
    w = Window.partitionBy(*within)
    total, n = F.sum(size).over(w), F.count(F.lit(1)).over(w)
    divided = parties.withColumn("__n", n).withColumn("__total", total.cast("double"))
    spare = F.col(seats) - F.col("__n") / 2
    first = F.when((spare > 0) & (F.col("__total") > 0), F.floor(F.col(size) / (F.col("__total") / spare) + 0.5)).otherwise(F.lit(0)).cast("long")
    divided = divided.withColumn("__first", first).withColumn("__left", F.col(seats) - F.sum("__first").over(w))
    chances = F.least(F.col("__left"), F.ceil(F.col(size) / F.greatest(F.col("__total"), F.lit(1.0)) * (F.col("__n") + 1)) + 1)
    plain = parties.columns
    tried = divided.where((F.col("__left") > 0) & (F.col(size) > 0)).select(*plain, "__left", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(chances, F.lit(1)).cast("long") - 1)).alias("__k"), "__first")
    quotient = F.col(size) / (2 * (F.col("__first") + F.col("__k")) + 1)
    order = Window.partitionBy(*within).orderBy(quotient.desc(), *[F.col(c).asc_nulls_last() for c in ties], F.col("__k"))
    won = tried.withColumn("__at", F.row_number().over(order)).where(F.col("__at") <= F.col("__left")).groupBy(*[F.col(c).alias(f"__{c}") for c in within + ties]).agg(F.count(F.lit(1)).alias("__more"))
    same = None
    for c in within + ties:
        part = F.col(c).eqNullSafe(F.col(f"__{c}"))
        same = part if same is None else same & part
    return divided.join(won, same, "left").select(*plain, (F.col("__first") + F.coalesce("__more", F.lit(0))).cast("long").alias(into))


def mix(docs: DataFrame, *, weights: tuple[float, ...] = WEIGHTS, most: int = MOST, share: float = 1.0, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """(row, size, source_size, target, rounds, spans, taken) of every row of docs.

    rounds: how often the mix takes the whole document; spans: runs (start, end) of its words that it
    takes once more, from 0; taken: the words of both.
    """
    size, draw = word_count(F.col("text")), F.xxhash64(F.lit(seed), "doc_id", "text")
    counted = docs.select("source", source_key(F.col("source")).alias("key"), F.pmod(draw, F.lit(MOST_SHARDS)).alias("bin"), size.alias("size"))
    bins = checkpoint(counted.groupBy("source", "key", "bin").agg(F.sum("size").alias("size")))
    goals = source_targets(bins, weights=weights, most=most, share=share)
    goals = goals.withColumn("seats_of_all", F.round(F.sum("target").over(Window.partitionBy()) / block).cast("long")).withColumn("all", F.lit(1))
    goals = apportion(goals, within=["all"], size="target", seats="seats_of_all", ties=["source"], into="blocks_of_source")
    n_shards = F.greatest(F.lit(1), F.least(F.lit(MOST_SHARDS), F.expr(f"(source_size + {SHARD_WORDS - 1}) div {SHARD_WORDS}")))
    goals = tabled(goals.select(source_key(F.col("source")).alias("key"), "source_size", "target", "blocks_of_source", n_shards.alias("n_shards")))
    shard = F.pmod("bin", "n_shards").cast("int")
    shards = bins.drop("source").join(goals, "key").withColumn("shard", shard).groupBy("key", "shard", "source_size", "target", "blocks_of_source").agg(F.sum("size").alias("words"))
    quotas = apportion(shards, within=["key"], size="words", seats="blocks_of_source", ties=["shard"], into="quota")
    given = F.least(F.col("quota") * block, F.col("words") * most)
    whole = F.when(F.col("words") > 0, F.expr("given div words")).otherwise(F.lit(0)).cast("long")
    n_blocks = F.expr(f"(words + {block - 1}) div {block}")
    plan = quotas.withColumn("given", given).withColumn("rounds", whole).withColumn("n_blocks", n_blocks)
    plan = plan.withColumn("chosen", F.when(F.col("words") > 0, F.round((F.col("given") - F.col("rounds") * F.col("words")) * F.col("n_blocks") / F.col("words"))).otherwise(F.lit(0)).cast("long"))
    start = F.pmod(F.xxhash64(F.lit(seed), "key", "shard"), F.greatest(F.col("n_blocks"), F.lit(1)))
    plan = tabled(plan.select("key", "shard", "source_size", "target", "rounds", "n_blocks", "chosen", start.alias("start")))
    rows = docs.select(F.struct(*columns_of(docs)).alias("row"), source_key(F.col("source")).alias("key"), size.alias("size"), draw.alias("draw")).withColumn("bin", F.pmod("draw", F.lit(MOST_SHARDS)))
    placed = rows.join(goals.select("key", "n_shards"), "key").select("row", "key", "size", "draw", shard.alias("shard"))
    stream = Window.partitionBy("key", "shard").orderBy("draw", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    laid = placed.withColumn("till", F.sum("size").over(stream)).join(plan, ["key", "shard"])
    picked = "pmod(b - start, n_blocks) < chosen"
    first, last = f"(till - size) div {block}", f"(till - 1) div {block}"
    spans = F.expr(
        f"""case when size = 0 or chosen = 0 then cast(array() as array<struct<start: bigint, end: bigint>>)
            else transform(filter(sequence({first}, {last}), b -> {picked}),
                           b -> struct(greatest(b * {block} - (till - size), 0L) as start, least((b + 1) * {block} - (till - size), size) as end)) end"""
    )
    return laid.withColumn("spans", spans).select(
        "row", "size", "source_size", "target", "rounds", "spans", (F.col("size") * F.col("rounds") + F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])).alias("taken")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """docs as the mix takes them: a row for each round, and one for each run of words taken once more.

    A run that is the whole document keeps its text as it is; a shorter one begins at its first word
    and ends before the next. n_chars, where there is one, is the length of the text.
    """
    found = mix(docs, **options)
    merged = F.aggregate(
        "spans",
        F.expr("cast(array() as array<struct<start: bigint, end: bigint>>)"),
        lambda a, s: F.when(
            (F.size(a) > 0) & (F.element_at(a, -1)["end"] == s["start"]),
            F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.array(F.struct(F.element_at(a, -1)["start"].alias("start"), s["end"].alias("end")))),
        ).otherwise(F.concat(a, F.array(s))),
    )
    whole = F.struct(F.lit(0).cast("long").alias("start"), F.col("size").alias("end"))
    runs = F.concat(F.transform(F.expr("if(rounds > 0, sequence(1L, rounds), cast(array() as array<bigint>))"), lambda _: whole), merged)
    taken = found.withColumn("run", F.explode(runs)).where(F.col("run.end") > F.col("run.start"))
    words = F.regexp_extract_all("row.text", F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    text = F.when(F.col("run.end") - F.col("run.start") == F.col("size"), F.col("row.text")).otherwise(F.array_join(F.slice(words, F.col("run.start").cast("int") + 1, (F.col("run.end") - F.col("run.start")).cast("int")), ""))
    row = F.col("row").withField("text", text)
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.char_length(text).cast(docs.schema["n_chars"].dataType))
    return unpack(taken.select(row.alias("row")))
