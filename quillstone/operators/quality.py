"""Checks, patches and routing: data quality as functions from DataFrames to DataFrames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class CheckFailed(ValueError):
    pass


def expect_count(df: DataFrame, expected: int, what: str) -> None:
    if (n := df.count()) != expected:
        raise CheckFailed(f"{what}: {n} rows, {expected} expected")


def expect_empty(df: DataFrame, what: str) -> None:
    if row := df.head(1):
        raise CheckFailed(f"{what}: {row[0]}")


def expect_partition(whole: DataFrame, parts: list[DataFrame], key: str) -> None:
    """The parts hold each key of the whole exactly once."""
    union = parts[0].select(key)
    for p in parts[1:]:
        union = union.unionAll(p.select(key))
    expect_empty(difference(whole.select(key), union), "not a partition")


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that only one side has, with their side; repeated rows count."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionAll(b.exceptAll(a).withColumn("side", F.lit("right")))


def null_profile(df: DataFrame) -> DataFrame:
    """(column, filled, pct) of all columns in one pass."""
    one = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count(F.col(c)).alias(c) for c in df.columns])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("filled")) for c in df.columns])
    return one.select("__n", F.inline(cells)).select("column", "filled", F.round(100.0 * F.col("filled") / F.col("__n"), 1).cast("double").alias("pct"))


def fingerprint(df: DataFrame) -> DataFrame:
    """(n, mark): the number of rows and a hash that doesn't depend on their order."""
    return df.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*df.columns)).alias("mark"))


@dataclass
class Patch:
    """Compare-and-set changes of one column: (key, old, new)."""

    key: str
    column: str
    rows: DataFrame

    def apply(self, table: DataFrame) -> DataFrame:
        """The table with new values where the old one is still there; a second time changes nothing."""
        p = self.rows.select(F.col(self.key).alias("__k"), F.col("old").alias("__old"), F.col("new").alias("__new"), F.lit(True).alias("__hit"))
        joined = table.join(p, (F.col(self.key) == F.col("__k")) & F.col(self.column).eqNullSafe(F.col("__old")), "left")
        new = F.when(F.col("__hit"), F.col("__new")).otherwise(F.col(self.column))
        return joined.select(*[new.alias(c) if c == self.column else F.col(c) for c in table.columns])

    def inverse(self) -> Patch:
        return Patch(self.key, self.column, self.rows.select(self.key, F.col("new").alias("old"), F.col("old").alias("new")))

    def archive(self, table: DataFrame) -> DataFrame:
        """The rows as they are before the change."""
        return table.join(self.rows.select(self.key), self.key, "left_semi")

    def preflight(self, table: DataFrame) -> DataFrame:
        """(key, reason) of changes that would not apply."""
        t = table.select(F.col(self.key).alias("__k"), F.col(self.column).alias("__v"))
        joined = self.rows.join(t, F.col(self.key) == F.col("__k"), "left")
        reason = F.when(F.col("__k").isNull(), "no_row").when(~F.col("__v").eqNullSafe(F.col("old")), "changed_meanwhile")
        return joined.select(self.key, reason.alias("reason")).where(F.col("reason").isNotNull())


def delete(table: DataFrame, keys: DataFrame) -> DataFrame:
    """The table without the rows of those keys, as a join however many they are."""
    return table.join(keys, keys.columns, "left_anti")


def merge_credits(links: DataFrame, merges: DataFrame) -> DataFrame:
    """Links (paper, author, corresponding) after merges (paper, keep, drop): flags pass to who stays."""
    dropped = links.join(merges.select("paper", F.col("drop").alias("author"), "keep"), ["paper", "author"])
    flags = dropped.groupBy("paper", F.col("keep").alias("author")).agg(F.max("corresponding").alias("passed"))
    left = delete(links, merges.select("paper", F.col("drop").alias("author")))
    return left.join(flags, ["paper", "author"], "left").select("paper", "author", (F.coalesce("passed", F.lit(False)) | F.col("corresponding")).alias("corresponding"))


def unique_or_held(proposals: DataFrame, key: str, value: str) -> DataFrame:
    """Proposals with ``held`` and the first ``sibling`` where another proposes the same value."""
    w = Window.partitionBy(value)
    return proposals.withColumn("held", F.count(F.lit(1)).over(w) > 1).withColumn("__min", F.min(key).over(w)).withColumn("__max", F.max(key).over(w)).withColumn(
        "sibling", F.when(F.col("held"), F.when(F.col(key) == F.col("__min"), F.col("__max")).otherwise(F.col("__min")))
    ).drop("__min", "__max")


def collisions(proposals: DataFrame, live: DataFrame, *, key: str, value: str, sim: Column, duplicate: float = 0.70) -> DataFrame:
    """Proposals whose value another row owns, as duplicate_of_existing_row or collision_needs_review.

    ``sim`` compares columns title and owner_title.
    """
    owner = live.groupBy(F.lower(value).alias("__v")).agg(F.min_by(F.struct(F.col(key).alias("owner"), F.col("title").alias("owner_title")), F.col(key)).alias("o"))
    found = proposals.join(owner, F.lower(value) == F.col("__v")).select(*proposals.columns, "o.owner", "o.owner_title").where(F.col("owner") != F.col(key))
    return found.withColumn("reason", F.when(sim >= duplicate, "duplicate_of_existing_row").otherwise("collision_needs_review"))


def route(records: DataFrame, spec: dict) -> DataFrame:
    """Records (doi, issns, container) as stay, move, reject, other or skip, with their signal.

    spec: target and source numbers, container words, a moving signal and forbidden ones. A record moves
    when all four gates let it: number, container, signal, and not forbidden.
    """
    series = F.regexp_extract("doi", r"10\.1300/(J[0-9]+)", 1)
    signal = F.when(series != "", series).otherwise(F.split_part("doi", F.lit("/"), F.lit(1)))
    words = F.split(F.lower("container"), "[^a-z]+")
    has = lambda numbers: F.arrays_overlap("issns", F.array(*map(F.lit, numbers)))
    named = F.size(F.array_intersect(words, F.array(*map(F.lit, spec["words"])))) == len(spec["words"])
    moving = signal.isin(*spec["moving"])
    forbidden = signal.isin(*spec.get("forbidden", ["-"]))
    gate = has(spec["target"]) & named & moving & ~forbidden
    verdict = F.when(F.col("issns").isNull() | (F.size("issns") == 0), "skip").when(has(spec["source"]), "stay").when(~has(spec["target"]), "other").when(gate, "move").otherwise("reject")
    return records.withColumn("signal", signal).withColumn("route", verdict)


def column_verdict(sim: Column, journal: Column) -> Column:
    """title_mismatch, journal_mismatch, title_weak or confirmed, in that order."""
    return F.when(sim < 0.75, "title_mismatch").when(journal == "mismatch", "journal_mismatch").when(sim < 0.90, "title_weak").otherwise("confirmed")


def prefix_baseline(keys: DataFrame, *, least: int = 20, share: float = 0.05) -> DataFrame:
    """(journal, prefix): prefixes with a share of a journal's keys; journals with few keys have none."""
    counted = keys.groupBy("journal", "prefix").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("journal")
    return counted.withColumn("total", F.sum("n").over(w)).where((F.col("total") >= least) & (F.col("n") >= share * F.col("total"))).select("journal", "prefix")


def audit(records: DataFrame, baseline: DataFrame, *, digits: Column, overlap: Column, both: Column, container: Column) -> DataFrame:
    """records (journal, prefix) with the reasons that speak against them; no baseline, no verdict on prefixes."""
    known = baseline.groupBy("journal").agg(F.collect_set("prefix").alias("known"))
    foreign = F.col("known").isNotNull() & ~F.array_contains("known", F.col("prefix")) & ~container
    reasons = F.filter(F.array(F.when(foreign, "foreign_prefix"), F.when(digits, "digits_conflict"), F.when(both & (overlap < 0.10), "authors_disjoint")), lambda x: x.isNotNull())
    return records.join(known, "journal", "left").withColumn("reasons", reasons).drop("known")


def metadata(named: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n, columns, vectors): exact counts of tables, their columns, and which of those hold vectors."""
    out = None
    for name, df in named.items():
        vectors = [f.name for f in df.schema if f.dataType.simpleString() in ("array<float>", "array<double>")]
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n", F.lit(len(df.columns)).cast("long").alias("columns"), F.lit(", ".join(vectors)).alias("vectors"))
        out = one if out is None else out.unionByName(one)
    return out
