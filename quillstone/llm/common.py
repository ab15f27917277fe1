"""Helpers that the training-data operators share."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words, and the ASCII letters that are folded.
WHITE = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in ``spark.checkpoint.dir``.

    Only where that is unset, and only on a local master, a temporary folder takes its place, once a session.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return sc._jsc.sc().getCheckpointDir().get()


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def tabled(df: DataFrame) -> DataFrame:
    """df as a written table in the shared folder: its size is known, so joins broadcast it only if it is small."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


#: Bits of a Bloom filter: 8 MB, however many rows it stands for.
BITS = 1 << 26


def perhaps(rows: DataFrame, wanted: DataFrame, key: list[str]) -> DataFrame:
    """Those of rows whose key may be in wanted, by a Bloom filter of ``BITS`` bits, which is all that is broadcast.

    It leaves out most others as long as wanted has far fewer rows than bits, and none if it has more.
    """
    bit = F.pmod(F.xxhash64(*key), F.lit(BITS)).cast("long")
    bits = wanted.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("__part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("__bits"))
    held = rows.withColumn("__bit", bit).join(F.broadcast(bits), F.bitmap_bucket_number("__bit") == F.col("__part"))
    place = F.bitmap_bit_position("__bit").cast("int")
    byte = F.conv(F.hex(F.substring("__bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return held.where(F.getbit(byte, place % 8) == 1).drop("__bit", "__part", "__bits")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else.

    ``lower`` does just that to a text without other than ASCII characters, and is many times
    faster than ``translate``.
    """
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def columns_of(df: DataFrame) -> list[Column]:
    """The columns of df by position-safe names, for packing a row into a struct."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in df.columns]


def unpack(df: DataFrame, row: str = "row") -> DataFrame:
    """The columns that were packed into the struct ``row``."""
    return df.select(f"{row}.*")


def release() -> None:
    """Give memory that is free back to the system: a worker process outlives its task, and an executor has several."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def trimmed(run: Callable) -> Callable:
    """A function of batches that releases memory once it has gone through its partition."""

    @functools.wraps(run)
    def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return whole
