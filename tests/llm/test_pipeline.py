"""The pipeline against brute-force versions of its stages, each on its own input."""

from collections import Counter, defaultdict

import numpy as np

import corpus_pipeline
from quillstone.llm import mixing
from quillstone.llm.queries import tokenizer_path
from quillstone.llm.tokens import Encoder
from tests.llm import fixtures as fx

FOLDER = "/root/testdata/sf0.001"


def stages(spark, tmp_path, docs):
    """(name, input rows, output rows) of each stage; what one returns is written and read for the next."""
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{tmp_path}/{i}"
        out = stage(spark, docs, FOLDER)
        out.write.parquet(path)
        after = spark.read.parquet(path)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == docs.columns
        yield name, docs.collect(), after.collect(), after
        docs = after


def check(spark, tmp_path, docs):
    found = {name: (before, after) for name, before, after, _ in stages(spark, tmp_path, docs)}
    before, after = found["language"]
    assert Counter(after) == Counter(r for r in before if r.text and any(c.isalpha() for c in r.text))
    before, after = found["lines"]
    assert Counter((r.doc_id, r.text) for r in after) == Counter((d, k) for d, _, _, k in fx.dedup_lines([(r.doc_id, r.text) for r in before]))
    assert Counter((r.doc_id, r.lang, r.source) for r in after) == Counter((r.doc_id, r.lang, r.source) for r in before)
    assert all(r.n_chars in (len(r.text), None) for r in after)
    before, after = found["near_copies"]
    of = dict(zip((r.text for r in before), fx.similar_groups([r.text for r in before]), strict=True))
    least: dict = {}
    for r in before:
        if r.doc_id is not None:
            least[of[r.text]] = min(r.doc_id, least.get(of[r.text], r.doc_id))
    assert Counter(of[r.text] for r in after) == Counter(dict.fromkeys(of.values(), 1))
    assert all(r.doc_id == least.get(of[r.text]) for r in after)
    assert set(after) <= set(before)
    before, after = found["mixture"]
    sizes, target, taken = Counter(), {}, Counter()
    for r in mixing.mix(spark.createDataFrame(before, docs.schema)).select("row.source", "size", "target").collect():
        sizes[r.source] += r.size
        target[r.source] = r.target
    for r in after:
        taken[r.source] += len(fx.WORD.findall(r.text))
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 96 and taken[s] <= 3 * sizes[s]
    texts = defaultdict(set)
    for r in before:
        texts[r.doc_id].add(r.text)
    assert all(any(r.text in t for t in texts[r.doc_id]) for r in after)
    before, after = found["sequences"]
    slow = Encoder(tokenizer_path()).slow
    want = Counter()
    for r in before:
        want[r.doc_id] += len(slow.encode(r.text or "", add_special_tokens=False).ids) + 1
    got = Counter()
    windows = defaultdict(list)
    for r in after:
        got[r.doc_id] += r.length
        windows[r.sequence_id].append((r.offset, r.length))
    assert got == want
    for w in windows.values():
        w.sort()
        assert [o for o, _ in w] == np.cumsum([0, *(n for _, n in w)])[:-1].tolist() and sum(n for _, n in w) <= 4096
    return found


def test_on_the_smallest_table(spark, tmp_path):
    found = check(spark, tmp_path, spark.read.parquet(f"{FOLDER}/documents.parquet"))
    run = corpus_pipeline.run(spark, FOLDER).collect()
    assert Counter(run) == Counter(found["sequences"][1])


def test_on_odd_rows(spark, tmp_path):
    check(spark, tmp_path, spark.createDataFrame(fx.odd_documents(), fx.SCHEMA))


def test_on_an_empty_table(spark, tmp_path):
    check(spark, tmp_path, spark.createDataFrame([], fx.SCHEMA))
