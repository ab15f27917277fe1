"""Tables by name, and the file sources and sinks around them."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


class Tables:
    """The tables of a folder as attributes; a scan reads the columns that a query asks for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def views(self, prefix: str = "", only: str | None = None) -> None:
        """Temporary views of the tables (that a text names); a prefix keeps two collections apart."""
        for name in NAMES:
            if only is None or re.search(rf"\b{name}\b", only):
                getattr(self, name).createOrReplaceTempView(f"{prefix}{name}")


def page(df: DataFrame, *, order: list[Column | str], size: int, number: int) -> DataFrame:
    """Page ``number`` from 0 of rows in a total order."""
    return df.orderBy(*order).offset(size * number).limit(size)


def rest_filter(column: str, test: str) -> Column:
    """A predicate from ``operator.value``: eq, neq, gt, gte, lt, lte, like, ilike (with *), in.(a,b), is.null."""
    op, _, value = test.partition(".")
    c = F.col(column)
    if op == "in":
        return c.isin(*[x.strip() for x in value.strip("()").split(",")])
    if op == "is":
        return c.isNull() if value == "null" else c == F.lit(value == "true")
    if op in ("like", "ilike"):
        return getattr(c, op)(value.replace("*", "%"))
    tests = {"eq": c == value, "neq": c != value, "gt": c > value, "gte": c >= value, "lt": c < value, "lte": c <= value}
    if op not in tests:
        raise ValueError(f"unknown filter {test!r}")
    return tests[op]


def rest_scan(df: DataFrame, *, select: str, where: dict[str, str] | None = None, order: str | None = None, limit: int | None = None) -> DataFrame:
    """A table read by names: ``select`` lists columns, ``order`` is ``column.asc|desc``."""
    for column, test in (where or {}).items():
        df = df.where(rest_filter(column, test))
    if order:
        column, _, way = order.partition(".")
        df = df.orderBy(F.col(column).desc_nulls_first() if way == "desc" else F.col(column).asc_nulls_last())
    return (df.limit(limit) if limit else df).select(*[x.strip() for x in select.split(",")])


BOM = "\ufeff"


def write_csv(df: DataFrame, path: str, columns: Iterable[str] | None = None, *, bom: bool = False, order: list[str] | None = None) -> None:
    """CSV with a header; only the named columns (those that there are), quotes doubled.

    bom: each file begins with a byte order mark. order: rows in that order over all files.
    """
    names = [c for c in (columns or df.columns) if c in df.columns]
    rows = (df.orderBy(*order) if order else df).select(*names)
    if bom and names:
        rows = rows.withColumnRenamed(names[0], BOM + names[0])
    rows.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV records, which may hold line feeds."""
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str, *, lines: bool = True) -> DataFrame:
    """JSON lines (plain or gzipped), or whole JSON documents."""
    return spark.read.schema(schema).option("multiLine", not lines).json(path)


def write_json(df: DataFrame, path: str, *, compress: bool = False, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("compression", "gzip" if compress else "none").json(path)


class CountMismatch(ValueError):
    pass


def gate(name: str, count: int, expected: int | None) -> int:
    """The count, if it is the one expected (or none is)."""
    if expected is not None and count != expected:
        raise CountMismatch(f"{name}: {count} records, {expected} expected")
    return count


def export(spark: SparkSession, folder: str, named: dict[str, DataFrame], expected: dict[str, int], *, order: dict[str, list[str]] | None = None) -> dict[str, int]:
    """Write each named frame as CSV in its order, hold its records against what is expected, and write a manifest.

    Records are counted from what was written, so a line feed in a field doesn't count.
    """
    counts = {}
    for name, df in named.items():
        write_csv(df, f"{folder}/{name}", order=(order or {}).get(name))
        counts[name] = gate(name, read_csv(spark, f"{folder}/{name}", df.schema).count(), expected.get(name))
    manifest = spark.createDataFrame([(n, c, f"{n}.csv") for n, c in counts.items()], "name string, records long, file string")
    write_json(manifest, f"{folder}/manifest")
    return counts


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """(key, value) of a cache of gzipped JSON lines; where a key stands twice, one of its values."""
    return read_json(spark, path, "key string, value string").dropDuplicates(["key"])


def write_cache(cache: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """A cache (key, value) as gzipped JSON lines; a null value, a key that wasn't found, is written too."""
    cache.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")).write.mode(mode).option("compression", "gzip").option("ignoreNullFields", False).json(path)
