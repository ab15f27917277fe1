import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillstone.llm import components, exact_dedup, line_dedup, simhash, substring_dedup
from tests.llm import fixtures as fx


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(fx.odd_documents(), fx.SCHEMA)


def test_lines(spark, odd):
    got = [(r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in line_dedup.dedup_lines(odd).select("row.doc_id", "n_lines", "n_dropped", "kept").collect()]
    assert Counter(got) == Counter(fx.dedup_lines(fx.odd_documents()))


def test_lines_as_a_stage(spark, odd):
    out = line_dedup.dedup_documents(odd)
    assert out.columns == odd.columns
    want = Counter((d, k) for d, _, _, k in fx.dedup_lines(fx.odd_documents()))
    assert Counter((r.doc_id, r.text or "") for r in out.collect()) == want


def test_lines_of_many_words_of_a_bitmap(spark):
    rows = [(i, "\n".join(f"shared line number {j} of the lot" if j % 3 else f"own {i} line {j} of this document" for j in range(300)), None, None, None, None, None, None, None, None) for i in range(4)]
    got = [(r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, fx.SCHEMA)).select("row.doc_id", "n_lines", "n_dropped", "kept").collect()]
    assert Counter(got) == Counter(fx.dedup_lines(rows))


@pytest.mark.parametrize("rows", [[(1, 0), (1, 0), (2, 0)], [(1, 0), (1, 1), (2, 0)], [(1, 0), (1, 1), (2, 0), (3, 0)], [(None, 0), (None, 1), (2, 0), (3, 1)], [(3, 0), (3, 1), (2, 0), (1, 0)]])
def test_rows_of_one_doc_id_are_one_document(spark, rows):
    line = "This line is in all of the rows of this table."
    table = [(d, line + "\nx" * more) for d, more in rows]
    got = [(r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in line_dedup.dedup_lines(spark.createDataFrame(table, "doc_id long, text string")).select("row.doc_id", "n_lines", "n_dropped", "kept").collect()]
    assert Counter(got) == Counter(fx.dedup_lines(table))


def test_bitmaps_are_compressed(spark):
    line = "This line is found in all of them, it is."
    rows = [(i, "\n".join([line] + [f"{i} {j}" for j in range(1000)]), None, None, None, None, None, None, None, None) for i in range(3)]
    maps = line_dedup.keep_bitmaps(spark.createDataFrame(rows, fx.SCHEMA)).collect()
    assert {m.doc_id: [(w.word, w.bits) for w in m.words] for m in maps} == {0: [(0, -2)], 1: [(0, -2)]}


@pytest.mark.parametrize("f", [lambda d: line_dedup.dedup_lines(d), exact_dedup.exact_dedup, simhash.near_dedup, substring_dedup.repeats, line_dedup.dedup_documents, simhash.keep_one, substring_dedup.without_repeats])
def test_empty_tables(spark, f):
    assert f(spark.createDataFrame([], fx.SCHEMA)).collect() == []


def test_polynomial_hashes_combine():
    data = bytes(random.Random(3).randbytes(3 * exact_dedup.CHUNK + 77))
    cuts = [data[i : i + exact_dedup.CHUNK] for i in range(0, len(data), exact_dedup.CHUNK)]
    h = exact_dedup.hash_chunk(cuts[0])
    for c in cuts[1:]:
        h = exact_dedup.combine(h, exact_dedup.hash_chunk(c), len(c))
    assert (h[0] << 31 | h[1], h[2] << 31 | h[3]) == exact_dedup.fingerprint(data)
    plain = [0] * 4
    for byte in data[:5000]:
        plain = [(x * b + byte + 1) % exact_dedup.PRIME for x, b in zip(plain, exact_dedup.BASES, strict=True)]
    assert tuple(plain) == exact_dedup.hash_chunk(data[:5000])
    a, b = data[:100], data[100:357]
    assert exact_dedup.combine(exact_dedup.hash_chunk(a), exact_dedup.hash_chunk(b), len(b)) == exact_dedup.hash_chunk(data[:357])


def test_exact(spark, odd):
    rows = [(r[0], r[1] or "") for r in fx.odd_documents()]
    groups = defaultdict(list)
    for doc, text in rows:
        groups[text].append(doc)
    got = exact_dedup.exact_dedup(odd).collect()
    assert len(got) == len(rows)
    want = Counter((d, max((x for x in groups[t] if x is not None), default=None), len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for d, t in rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len(groups)


def test_exact_when_fingerprints_collide(spark, monkeypatch):
    """Texts of equal fingerprint that differ stay apart, within and across salts."""
    rows = [(i, ("abc", "xyz", "abz")[i % 3]) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    real = exact_dedup.fingerprints
    monkeypatch.setattr(exact_dedup, "fingerprints", lambda d: real(d).withColumn("fa", F.lit(1).cast("long")).withColumn("fb", F.lit(2).cast("long")))
    monkeypatch.setattr(exact_dedup, "SALT_ROWS", 4)
    got = {r.doc_id: r.keep_id for r in exact_dedup.exact_dedup(docs).collect()}
    assert got == {i: 37 + (i - 37) % 3 for i in range(40)}


def test_exact_over_many_chunks(spark):
    """Documents of several chunks that differ in the last byte, and copies of them."""
    text = "".join(f"{i:x}" for i in range(60000))
    rows = [(1, text), (2, text), (3, text + "a"), (4, text + "b"), (5, text + "a"), (6, text[: exact_dedup.CHUNK]), (7, text[: exact_dedup.CHUNK])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    prints = {r.an_id: (r.fa, r.fb) for r in exact_dedup.fingerprints(docs).collect()}
    assert prints == {i: exact_dedup.fingerprint(t.encode()) for i, t in rows}
    assert {r.doc_id: r.keep_id for r in exact_dedup.exact_dedup(docs).collect()} == {1: 2, 2: 2, 3: 5, 4: 4, 5: 5, 6: 7, 7: 7}


def test_copies_do_not_differ(spark, odd):
    """One round is enough where no fingerprints collide, whatever the script."""
    marks = exact_dedup.fingerprints(odd).withColumn("class", F.lit(0))
    assert marks.groupBy(*exact_dedup.KEY).count().where("count > 1").count() > 2
    assert exact_dedup.differing(odd, marks).collect() == []
    texts = spark.createDataFrame([(i, "École déjà vu 日本語") for i in range(300)], "doc_id long, text string")
    assert exact_dedup.differing(texts, exact_dedup.fingerprints(texts).withColumn("class", F.lit(0))).collect() == []


def test_exact_with_a_large_group(spark):
    docs = spark.range(100_000).select(F.col("id").alias("doc_id"), F.lit("one and the same").alias("text"))
    got = exact_dedup.exact_dedup(docs).agg(F.min("keep_id"), F.max("keep_id"), F.min("group_size"), F.count_if("kept"), F.count(F.lit(1))).first()
    assert tuple(got) == (99_999, 99_999, 100_000, 1, 100_000)


def test_fingerprints(spark, odd):
    got = Counter((r.doc_id, r.fp & (1 << 64) - 1) for r in simhash.fingerprints(odd).collect())
    assert got == Counter((r[0], fx.simhash(r[1])) for r in fx.odd_documents())


def test_near(spark, odd):
    rows = [(r[0], fx.simhash(r[1])) for r in fx.odd_documents()]
    label = fx.components([p for _, p in rows])
    least = {}
    for doc, p in rows:
        if doc is not None:
            least[label[p]] = min(doc, least.get(label[p], doc))
    want = Counter((doc, least.get(label[p])) for doc, p in rows)
    assert Counter((r.doc_id, r.component_id) for r in simhash.near_dedup(odd).collect()) == want
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    of = fx.similar_groups([r[1] for r in fx.odd_documents()])
    first = {}
    for (doc, *_), g in zip(fx.odd_documents(), of, strict=True):
        first[g] = min((x for x in (doc, first.get(g)) if x is not None), default=None)
    assert Counter(r.doc_id for r in kept.collect()) == Counter(first.values())


@pytest.mark.parametrize(("bucket", "limit"), [(4096, 2), (3, 2), (40, 2), (5, 1), (3, 3)])
def test_links_against_all_pairs(spark, bucket, limit, monkeypatch):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(60)]
    codes = set(base)
    for b in base:
        for _ in range(150 if b == base[0] else 12):
            x = b
            for _ in range(rng.randint(1, 3)):
                x ^= 1 << rng.randrange(64)
            codes.add(x)
    codes |= {0, (1 << 64) - 1, 1, 3, 7}
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    prints = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in codes], "fp long")
    links = [(r.u & (1 << 64) - 1, r.v & (1 << 64) - 1) for r in simhash.near_links(prints, limit=limit).collect()]
    assert max((a ^ b).bit_count() for a, b in links) <= 2 * limit
    want = fx.components(sorted(codes), limit)
    up = {x: x for x in codes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        up[find(a)] = find(b)
    groups = lambda f: {frozenset(x for x in codes if f(x) == f(y)) for y in codes}
    assert groups(find) == groups(want.get)


def test_gray_order_and_index():
    codes = np.arange(64, dtype=np.uint64)
    gray = codes ^ codes >> np.uint64(1)
    assert (simhash.gray_rank(gray) == codes).all()
    rng = np.random.default_rng(1)
    own = np.unique(rng.integers(0, 1 << 12, 400, dtype=np.uint64))
    queries = rng.integers(0, 1 << 12, 300, dtype=np.uint64)
    who, what = simhash.GrayIndex(own).search(queries, 2)
    got = {(int(q), int(c)) for q, c in zip(who, what, strict=True)}
    for codes in (own[:1], own[:16], own[:17], own[:300]):
        index = simhash.GrayIndex(codes)
        masks = [m for _, m in index.levels]
        assert sorted(index.levels[-1][0].tolist()) == codes.tolist() and len(masks[0]) == 1
        node = np.arange(len(codes))
        for m in reversed(masks):
            assert len(m) > node.max()
            node = node // simhash.FAN
    assert got == {(i, int(c)) for i, q in enumerate(queries) for c in own if int(q ^ c).bit_count() <= 2}


def test_components(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(rng.randrange(5000, 5400), rng.randrange(5000, 5400)) for _ in range(250)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        up[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}


def _prose(rng, n):
    return [f"{rng.choice('bcdfgk')}{rng.randrange(400)}" for _ in range(n)]


def test_passages_that_begin_and_end_inside_lines(spark):
    """Against brute force: every word of a run of over 50 that an earlier place has is covered, and no other."""
    rng = random.Random(4)
    passages = [_prose(rng, n) for n in (51, 60, 90, 200, 50, 30)]
    rows = []
    for i in range(60):
        words = _prose(rng, rng.randrange(0, 160))
        for p in rng.sample(passages, rng.randrange(0, 3)):
            cut = rng.randrange(len(words) + 1)
            words[cut:cut] = p
        rows.append((i, "".join(w.upper() * (rng.random() < 0.1) or w + rng.choice([" ", " ", "  ", ". ", "\n", "\n\n"]) for w in words)))
        rows[-1] = (i, re.sub(r"(?<=[A-Z0-9])(?=[A-Z])", " ", rows[-1][1]))
    rows += [rows[3], (None, rows[5][1]), (61, None), (62, ""), (63, "\n \t"), (3, rows[7][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring_dedup.repeats(docs).collect()
    texts = defaultdict(set)
    for d, x in rows:
        texts[d].add(x)
    split = lambda x: (x or "").encode().lower().split()
    for r in got:
        assert r.words > 50
        assert any(len(split(x[r.start : r.end])) == r.words and any(split((y or "")[r.keep_start :])[: r.words] == split(x[r.start : r.end]) for y in texts[r.keep_doc_id]) for x in texts[r.doc_id] if x)
    seen, need = {}, defaultdict(set)
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    known = [r for r in order if r[0] not in (3,)]
    for d, x in order:
        w = split(x)
        for i in range(len(w) - 50):
            k = tuple(w[i : i + 51])
            if k in seen and d not in (3,):
                need[d].update(range(i, i + 51))
            seen.setdefault(k, d)
    assert known
    covered = defaultdict(set)
    for r in got:
        for x in texts[r.doc_id]:
            before = len(split(x[: r.start])) if x else 0
            covered[r.doc_id].update(range(before, before + r.words))
    for d in set(need) | set(covered) - {3}:
        assert need[d] == covered[d], d


def test_substrings_of_odd_rows(spark, odd):
    got = {(r.doc_id, r.start, r.words, r.keep_doc_id, r.keep_start) for r in substring_dedup.repeats(odd).collect()}
    whole = {(17, 0, 60000, 16, 0), (18, 0, 60000, 16, 0)}
    assert whole == got
    out = {(r.doc_id, r.text) for r in substring_dedup.without_repeats(odd).collect()}
    assert {d: t for d, t in out if d in (17, 18)} == {17: "", 18: " end"}
    assert {(d, t) for d, t in out if d not in (17, 18)} == {(r[0], r[1]) for r in fx.odd_documents() if r[0] not in (17, 18)}


def test_a_passage_that_a_third_of_all_documents_hold(spark):
    rng = random.Random(6)
    passage = " ".join(_prose(rng, 70))
    rows = [(i, f"{' '.join(_prose(rng, 9))} {passage} {' '.join(_prose(rng, 9))}" if i % 3 == 0 else " ".join(_prose(rng, 70))) for i in range(900)]
    got = substring_dedup.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in got} == {r.doc_id for r in got if r.keep_doc_id == 0} == set(range(3, 900, 3)) and min(r.words for r in got) == 70
