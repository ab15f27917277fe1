"""Every query with SQL of its own gives the same rows in both engines."""

import math
import re

import duckdb
import pytest

from quillstone import catalog

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
#: Results that are empty when all is well.
EMPTY = {"V7_dimension_guard", "D8_round_trip"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


def same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_same_rows(spark, duck, name):
    df = catalog.queries()[name](spark, FOLDER)
    cur = duck.execute(catalog.oracle_sql()[name])
    columns = [c[0] for c in cur.description]
    assert sorted(columns) == sorted(df.columns)
    key = lambda r: tuple((x is None, "" if x is None else f"{x:.6f}" if isinstance(x, float) else str(x)) for x in r)
    want = sorted(cur.fetchall(), key=key)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=key)
    assert len(got) == len(want)
    assert all(same(a, b) for x, y in zip(got, want, strict=True) for a, b in zip(x, y, strict=True)), [(x, y) for x, y in zip(got, want, strict=True) if x != y][:3]


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_other_queries_run(spark, name):
    assert catalog.queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_title_ratios_row_by_row(spark, duck):
    """What SQL has no measure for, against the standard library."""
    from difflib import SequenceMatcher

    names = dict(duck.execute("select p_partkey, p_name from part").fetchall())
    plain = {k: " ".join(re.sub("[^a-z0-9]+", " ", v.lower()).split()) for k, v in names.items()}

    def sim(a, b):
        if a == b or not a or not b:
            return float(a == b and a != "")
        if a.startswith(b) or b.startswith(a):
            return max(0.75, min(0.97, min(len(a), len(b)) / max(len(a), len(b))))
        return SequenceMatcher(None, a, b).ratio()

    got = {r.id: r.sim for r in catalog.queries()["X8_title_sim_ratio"](spark, FOLDER).collect()}
    assert got.keys() == {k for k in names if k + 1 in names}
    assert all(math.isclose(s, sim(plain[k], plain[k + 1]), abs_tol=1e-6) for k, s in got.items())
