"""Resumable work: what is done stays done."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Progress:
    """How far work is: rows done of all, and the seconds that those took."""

    done: int
    total: int
    seconds: float

    @property
    def rate(self) -> float:
        return self.done / self.seconds if self.seconds > 0 else 0.0

    @property
    def eta(self) -> float | None:
        """Seconds that the rest will take at this rate; unknown before anything is done."""
        return (self.total - self.done) / self.rate if self.rate else (0.0 if self.done >= self.total else None)


def pending(todo: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of todo without a result."""
    return todo.join(done.select(*keys), keys, "left_anti")


def append(done: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """done with what is new to it; a key that is there already is left alone."""
    return done.unionByName(pending(new.dropDuplicates(keys), done, keys))


def resume(todo: DataFrame, done: DataFrame, work: Callable[[DataFrame], DataFrame], keys: list[str], *, version: str | None = None) -> DataFrame:
    """done and the work on the rest; results of another version don't count as done."""
    valid = done if version is None else done.where(F.col("version") == version)
    new = work(pending(todo, valid, keys))
    return append(valid, new if version is None else new.withColumn("version", F.lit(version)), keys)


def in_batches(todo: DataFrame, path: str, work: Callable[[DataFrame], DataFrame], keys: list[str], *, batches: int, report: Callable[[Progress], None]) -> DataFrame:
    """Results (with keys) of work, written to path batch by batch; report hears after each how far it is.

    What path has already isn't worked on again, so a run that was stopped goes on where it was. Batches are
    dealt by a hash of the keys.
    """
    spark = todo.sparkSession
    schema = work(todo.limit(0)).schema
    spark.createDataFrame([], schema).write.mode("append").parquet(path)
    rest = pending(todo, spark.read.schema(schema).parquet(path), keys)
    total, began, done = rest.count(), time.monotonic(), 0
    report(Progress(0, total, 0.0))
    for i in range(batches):
        part = pending(todo, spark.read.schema(schema).parquet(path), keys).where(F.pmod(F.xxhash64(*keys), F.lit(batches)) == i)
        n = part.count()
        if n:
            work(part).write.mode("append").parquet(path)
        done += n
        report(Progress(done, total, time.monotonic() - began))
    return spark.read.schema(schema).parquet(path)


def lookup(keys: DataFrame, cache: DataFrame, fetch: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(answers, cache): keys (key) answered from a cache (key, value), the missing ones fetched.

    A key that isn't found is cached with a null value, and not asked for again.
    """
    missing = keys.select("key").distinct().join(cache, "key", "left_anti")
    fetched = missing.join(fetch(missing), "key", "left").select("key", "value")
    full = cache.unionByName(fetched)
    return keys.join(full, "key", "left"), full


def follow(stream: DataFrame, sink: Callable[[DataFrame, int], None], *, checkpoint: str, keys: list[str], late: str = "1 hour", time: str = "ts"):
    """A streaming query that hands each new key to the sink once, in batches; all there is, then it ends."""
    fresh = stream.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)
    return fresh.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
