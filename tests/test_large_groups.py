"""Groups of many alike rows: the same results as by brute force, without work that grows with a group's square."""

import math
import random

import pytest
from pyspark.sql import functions as F

from quillstone.functions import names
from quillstone.functions import text as T
from quillstone.operators import linkage


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(rows, width, k):
    """Scores of each id, and pairs that are right."""
    sim = lambda a, b: None if a is None or b is None else round(1 - distance(a, b) / max(len(a), len(b)), 6)
    found = {}
    for i, g, y, x in rows:
        for j, h, z, w in rows:
            if None not in (i, j, g, h, y, z) and i != j and g == h and abs(y - z) <= width:
                found.setdefault(i, []).append((math.inf if (s := sim(x, w)) is None else -s, j))
    return sorted((i, j, None if s == math.inf else -s) for i, all_ in found.items() for s, j in sorted(all_)[:k])


def searched(spark, rows, width, k):
    df = spark.createDataFrame(rows, "id long, g string, y int, x string")
    out = linkage.registry_search(df, df.withColumnRenamed("id", "candidate"), same=["g"], band="y", width=width, text="x", sim=lambda a, b: F.round(T.levenshtein_sim(a, b), 6), k=k)
    assert out.columns == ["id", "candidate", "sim"]
    return out


@pytest.mark.parametrize(("width", "k"), [(5, 1), (1, 5)])
def test_best_of_classes_by_brute_force(spark, width, k):
    r = random.Random(width)
    rows = [(i, r.choice("ab"), r.randrange(8), r.choice(["hot bolt", "hot ring", "cold ring", "old pin", "rod"])) for i in range(150)]
    rows += [(200 + i, "c", i, f"text {i * 37 % 50}") for i in range(25)]  # all texts differ
    rows += [(300, None, 1, "rod"), (301, "a", None, "rod"), (302, "a", 1, None), (303, "a", 1, None), (None, "a", 1, "rod")]
    rows += [(7, "a", 2, "rod"), (7, "a", 3, "hot pin"), rows[0], rows[0], (150, "d", 1, "alone")]  # ids that are on several rows
    key = lambda z: (z[0], z[1], -1 if z[2] is None else z[2])
    assert sorted(map(tuple, searched(spark, rows, width, k).collect()), key=key) == sorted(brute(rows, width, k), key=key)


def test_best_of_one_large_class(spark):
    """30,000 rows of one class were 900 million pairs."""
    n = 30_000
    rows = spark.range(n).select("id", F.lit("g").alias("g"), (F.col("id") % 3).cast("int").alias("y"), F.lit("same text").alias("x"))
    got = linkage.registry_search(rows, rows.withColumnRenamed("id", "candidate"), same=["g"], band="y", width=1, text="x", sim=T.levenshtein_sim, k=2)
    assert got.agg(F.count(F.lit(1)), F.min("sim"), F.max("candidate")).first() == (2 * n, 1.0, 4)


def test_best_of_blocks_by_brute_force(spark):
    """Texts that meet in several blocks, with ties between them, nulls and ids on several rows."""
    r = random.Random(11)
    rows = [(r.randrange(90), r.choice("ab"), r.randrange(4), r.choice(["a", "b", "ab", "abc", "abd", "xbc", "abcd", "zz", None])) for _ in range(60)]
    df = spark.createDataFrame(rows, "id long, g string, y int, x string")
    got = linkage.registry_search(df, df.withColumnRenamed("id", "candidate"), same=["g"], band="y", width=1, text="x", sim=lambda a, b: F.round(T.levenshtein_sim(a, b), 6), k=4, size=4)
    key = lambda z: (z[0], z[1], -1 if z[2] is None else z[2])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute(rows, 1, 4), key=key)


def test_comparisons_are_not_rows(spark):
    """700 texts of one band were 490,000 rows, joined and sorted in one task."""
    n = 700
    rows = spark.range(n).select("id", F.lit("g").alias("g"), F.lit(1).alias("y"), F.hex(F.col("id") * 7919).alias("x"))
    got = linkage.registry_search(rows, rows.withColumnRenamed("id", "candidate"), same=["g"], band="y", width=1, text="x", sim=T.levenshtein_sim, k=1)
    assert len(got.collect()) == n

    def most(node):
        kind = node.getClass().getSimpleName()
        inner = [node.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [node.plan()] if kind.endswith("QueryStageExec") else [node.children().apply(i) for i in range(node.children().size())]
        own = node.metrics().get("numOutputRows")
        return max([own.get().value() if own.isDefined() else 0, *map(most, inner)])

    assert n <= most(got._jdf.queryExecution().executedPlan()) < 20 * n


def test_registry_search_without_rows(spark):
    assert searched(spark, [], 1, 5).count() == 0


@pytest.mark.parametrize("name", ["S16_registry_search", "J16_best_candidate"])
def test_best_parts_with_nulls_and_repeats(spark, tmp_path, name):
    """Null names and types, and rows that stand twice, as in SQL."""
    duckdb = pytest.importorskip("duckdb")
    from quillstone import catalog

    r = random.Random(3)
    names, types = ["hot bolt", "hot ring", None], ["LARGE", "SMALL", "ECONOMY", None]
    rows = [(i, r.choice(names), r.choice(["B1", "B2", None]), r.choice(types), r.choice([1, 2, 3, 9, None]), 1.0) for i in range(120)]
    columns = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    spark.createDataFrame([*rows, *rows[:5]], columns).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    con = duckdb.connect()
    con.execute(f"create view part as select * from '{tmp_path}/part.parquet/*.parquet'")
    key = lambda z: (z[0], z[1], -1 if z[2] is None else z[2])
    want = sorted(con.execute(catalog.oracle_sql()[name]).fetchall(), key=key)
    assert sorted(map(tuple, catalog.queries()[name](spark, str(tmp_path)).collect()), key=key) == want


@pytest.mark.parametrize("broadcast", [True, False])
def test_tokens_of_shared_ids(spark, tmp_path, monkeypatch, broadcast):
    """Ids on several rows, null ones too, and texts without words, as in SQL."""
    duckdb = pytest.importorskip("duckdb")
    from quillstone import catalog
    from quillstone.operators import search

    if not broadcast:
        monkeypatch.setattr(search, "SHARED", 0)
    rows = [(1, "b a b"), (1, "a Ä, c d\n1"), (1, None), (2, "a"), (3, None), (4, ""), (5, "-- !"), (None, "a a"), (None, "x a y"), (6, "Z z z"), (7, " q "), (7, "q")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    got = catalog.queries()["T_token_table"](spark, str(tmp_path))
    assert got.columns == ["id", "term", "tf", "length"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, con.execute(catalog.oracle_sql()["T_token_table"]).fetchall()))


def test_tokens_are_counted_within_rows(spark):
    """No term is shuffled, and a long text's words are those of a count by hand."""
    from collections import Counter

    from quillstone.operators import search

    r = random.Random(2)
    texts = {i: " ".join(r.choices(["ab", "a", "b", "ba", "é", "x1"], k=size)) for i, size in enumerate((1, 2, 7, 30_000))}
    got = search.tokens(spark.createDataFrame([*texts.items()], "id long, text string"))
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    want = [(i, t, n, len(x.split())) for i, x in texts.items() for t, n in Counter(x.split()).items()]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_credits_paper_by_paper(spark):
    """Papers that go on from batch to batch give the groups of their own bylines."""
    r = random.Random(5)
    forms = ["Smith, Ann", "Smith, A.", "Smith, Bo", "Smith, B.", "Lee S.", "Ann Lee", "", None]
    links = [(r.choice([*range(40), None]), r.choice([*range(9), None]), r.choice(forms)) for _ in range(600)]
    by = {}
    for p, a, n in links:
        by.setdefault(p, []).append((a is None, -1 if a is None else a, n is not None, n or "", a, n))
    want = []
    for p, credits in by.items():
        credits.sort(key=lambda c: c[:4])
        for i, g in enumerate(names.group_credits([(k, c[5]) for k, c in enumerate(credits)])):
            keep = names.fullest(g).author_id
            want += [(p, i, credits[keep][4], credits[c.author_id][4]) for c in g]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = linkage.grouped_credits(spark.createDataFrame(links, "paper_id long, author_id long, name string")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_names_alike_are_compared_once(monkeypatch):
    calls, compatible = [0], names.compatible

    def counted(a, b):
        calls[0] += 1
        return compatible(a, b)

    monkeypatch.setattr(names, "compatible", counted)
    groups = names.group_credits([(i, f"Smith, {'AB'[i % 2]}.") for i in range(1000)])
    assert [len(g) for g in groups] == [500, 500] and calls[0] <= 2000


def test_records_without_a_candidate_are_dealt_out(spark):
    """Nulls don't meet in one task, and have one row each."""
    rows = spark.range(4000).select("id", F.when(F.col("id") % 100 == 0, F.concat(F.lit("D"), "id")).alias("doi"), F.lit("t").alias("title"))
    registry = spark.createDataFrame([("d0", "t"), ("d100", "u"), (None, "t")], "doi string, title string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = linkage.rule_arm(rows, registry, candidate=F.col("doi"), sim=F.when(F.col("title") == F.col("registry_title"), 1.0).otherwise(0.0))
        sizes = [r[0] for r in found.groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 4000 and max(sizes) < 2000
    assert dict(found.groupBy("verdict").count().collect()) == {"no_rule_match": 3960, "candidate_not_in_crossref": 38, "recovered": 1, "title_mismatch": 1}


@pytest.mark.parametrize("size", [2, 1024])
def test_pairs_of_names_in_blocks(spark, size):
    r = random.Random(size)
    people = [(r.choice([*range(60), None]), r.choice(["Smith, Ann", "Smith, A.", "A. Smith", "Smith, Bo", "Smith", "Lee S.", "Lee, Sue", "", None])) for _ in range(90)]
    read = [(i, names.parse_name(n)) for i, n in people if i is not None and names.parse_name(n)]
    want = sorted((i, j) for i, x in read for j, y in read if i < j and names.compatible(x, y))
    df = spark.createDataFrame(people, "id long, name string").select("id", names.parsed(F.col("name")).alias("p"))
    assert sorted(map(tuple, linkage.name_pairs(df, size=size).collect())) == want


def test_pairs_of_one_name_are_dealt_out(spark):
    n = 3000
    df = spark.range(n).select("id", names.parsed(F.lit("Smith, A.")).alias("p"))
    sizes = [r[0] for r in linkage.name_pairs(df, size=256).groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert sum(sizes) == n * (n - 1) // 2 and max(sizes) < sum(sizes) / 4
