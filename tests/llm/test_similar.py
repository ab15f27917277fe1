"""Near copies by shingle similarity against a comparison of all pairs."""

import random

import numpy as np
import pytest

import corpus_pipeline
from quillstone.llm import simhash, similar
from tests.llm import fixtures as fx


def rows(spark):
    rng = random.Random(8)
    texts = [None, "", " \n", "two words", "TWO\twords", "two word"]
    for n in (8, 40, 120, 400):
        base = [f"w{rng.randrange(5000)}" for _ in range(n)]
        for _ in range(6):
            x = list(base)
            for _ in range(rng.randrange(max(2, n // 30))):
                x[rng.randrange(n)] = f"x{rng.randrange(5000)}"
            texts.append(" ".join(x))
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [passage + " " + " ".join(f"o{i}x{j}" for j in range(25)) for i in range(30)]
    return [(i, t) for i, t in enumerate(texts)]


def similar_one(spark, docs):
    return sorted(r.doc_id for r in simhash.keep_one(spark.createDataFrame(docs, "doc_id long, text string")).collect())


def test_one_of_each_group_stays(spark):
    docs = rows(spark)
    of = fx.similar_groups([t for _, t in docs])
    assert similar_one(spark, docs) == sorted({min(i for i, g in enumerate(of) if g == h) for h in of})


def joined(n, groups, links):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(n):
        for j in range(i):
            if groups[i] == groups[j]:
                up[find(i)] = find(j)
    for i, j in links:
        up[find(i)] = find(j)
    return {tuple(j for j in range(n) if find(j) == find(i)) for i in range(n)}


@pytest.mark.parametrize("known", [False, True])
def test_new_links_against_all_pairs(spark, known):
    texts = [t for _, t in rows(spark) if t and t.split()]
    want = fx.similar_groups(texts)
    labels = [want[i] if known and i % 3 else i + 1000 for i in range(len(texts))]
    got = joined(len(texts), labels, similar.new_links([similar.shingle_set(t) for t in texts], labels))
    assert got == joined(len(texts), want, [])


def test_links_between_sets_that_are_far_from_the_least_one(spark, monkeypatch):
    """A chain of texts, each like the next and unlike the first, in many blocks."""
    monkeypatch.setattr(similar, "BLOCK", 300)
    words = [f"c{i}" for i in range(400)]
    docs = [(i, " ".join(words[4 * i : 4 * i + 100])) for i in range(60)] + [(100 + i, " ".join(words[4 * i : 4 * i + 100])) for i in range(0, 60, 7)]
    kept = similar_one(spark, docs)
    of = fx.similar_groups([t for _, t in docs])
    assert kept == sorted({min(docs[i][0] for i, g in enumerate(of) if g == h) for h in of}) == [0]


def test_bands_of_similar_sets_meet():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a = rng.integers(0, 1 << 64, 90, dtype=np.uint64)
        x, y = similar.bands([np.sort(a), np.sort(np.concatenate((a[:80], rng.integers(0, 1 << 64, 10, dtype=np.uint64))))])
        assert (x == y).any()


@pytest.mark.parametrize("texts", [[], [(None, "no id"), (None, "no id"), (3, "no id")]])
def test_empty_and_without_ids(spark, texts):
    kept = simhash.keep_one(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert [r.doc_id for r in kept] == [3][: len(texts)]


def test_the_pipeline_leaves_no_similar_texts(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        if name == "mixture":
            break
        stage(spark, docs, "").write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    texts = [r.text for r in docs.collect()]
    assert len(set(fx.similar_groups(texts))) == len(texts)
