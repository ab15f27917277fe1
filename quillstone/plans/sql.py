"""A read-only SQL entry: one SELECT, no semicolon, a row cap, a time limit."""

from __future__ import annotations

import re
import threading
import uuid

from pyspark.sql import DataFrame, Row, SparkSession

CAP = 1000
SECONDS = 30.0
_LITERAL = re.compile(r"'(?:[^']|'')*'|--[^\n]*|/\*.*?\*/", re.S)


class NotReadOnly(ValueError):
    pass


def guard(text: str) -> str:
    """The statement, if it is a single query."""
    bare = _LITERAL.sub(" ", text)
    if ";" in bare:
        raise NotReadOnly("one statement without a semicolon")
    if not re.match(r"\s*(select|with|values|\()", bare, re.I):
        raise NotReadOnly("only queries are run")
    if re.search(r"\b(insert\s+into|insert\s+overwrite|create\s+(or|table|view|temp)|drop\s+(table|view)|delete\s+from|update\s+\w+\s+set|merge\s+into|truncate\s+table|alter\s+table)\b", bare, re.I):
        raise NotReadOnly("only queries are run")
    return text


def run_sql(spark: SparkSession, text: str, *, cap: int | None = CAP) -> DataFrame:
    """The rows of a query, at most ``cap`` of them."""
    df = spark.sql(guard(text))
    return df if cap is None else df.limit(cap)


class TooSlow(TimeoutError):
    pass


def fetch_sql(spark: SparkSession, text: str, *, cap: int = CAP, seconds: float = SECONDS) -> list[Row]:
    """The rows of a query, at most ``cap``; its jobs are cancelled once ``seconds`` are over."""
    sc, tag, over = spark.sparkContext, f"sql-{uuid.uuid4().hex}", threading.Event()

    def stop() -> None:
        over.set()
        sc.cancelJobsWithTag(tag)

    timer = threading.Timer(seconds, stop)
    sc.addJobTag(tag)
    timer.start()
    try:
        return run_sql(spark, text, cap=cap).collect()
    except Exception as e:
        if over.is_set():
            raise TooSlow(f"no result within {seconds:g} s") from e
        raise
    finally:
        timer.cancel()
        sc.removeJobTag(tag)
