"""Pairs of members are made one by one, in as many tasks as the table asks for."""

from pyspark.sql import functions as F

from quillstone.operators import graph
from quillstone.queries import operators
from quillstone.sources.tables import Tables


def test_pairs_of_items(spark):
    rows = [(1, 3), (1, 1), (1, 2), (1, 2), (2, 5), (3, 1), (3, 2), (4, None)]
    got = graph.pairs_within(spark.createDataFrame(rows, "item long, member long"))
    assert sorted(map(tuple, got.collect())) == [(1, 2), (1, 2), (1, 3), (2, 3)]
    assert "transform" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_tasks_follow_the_table(spark, monkeypatch):
    monkeypatch.setattr(operators, "_TASK_ROWS", 100, raising=False)
    members = operators._members(Tables(spark, "/root/testdata/sf0.001"))
    assert members.select(F.spark_partition_id()).distinct().count() > 30
