import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillstone.llm import chat, langid, license_scan, mixing, packing, topk
from quillstone.llm.queries import tokenizer_path
from quillstone.llm.tokens import Encoder
from tests.llm import fixtures as fx


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(fx.odd_documents(), fx.SCHEMA)


# Tokens and packing.


def test_encoder_equals_the_tokenizer():
    e = Encoder(tokenizer_path())
    assert e.fast is not None
    rng = random.Random(2)
    letters = "abcdefgh'sTREVE  \n\tÀéßñŒ.,!?0129²½-_|<>\x1c\x85 ﬁΣσİ日本\U0001f600̀"
    texts = ["", " ", "It's DON'T we'LL 3²¼x", "<|startoftext|>", *("".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(800))]
    for text, ids in zip(texts, e.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == e.slow.encode(text, add_special_tokens=False).ids, repr(text)


def check_pieces(rows, pieces, most=4096):
    slow = Encoder(tokenizer_path()).slow
    want = Counter()
    for doc, text in rows:
        ids = [*slow.encode(text or "", add_special_tokens=False).ids, 2]
        want[(doc, tuple(ids))] += 1
    by_doc = defaultdict(list)
    by_sequence = defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
        assert len(p.ids) == 4 * p.length and p.length > 0
    got = Counter()
    for doc, ps in by_doc.items():
        ends = [(d, ids) for (d, ids), n in want.items() for _ in range(n) if d == doc]
        assert sum(p.length for p in ps) == sum(len(ids) for _, ids in ends)
        if len(ends) == 1:
            ps.sort(key=lambda p: p.start)
            ids = np.frombuffer(b"".join(bytes(p.ids) for p in ps), "<u4").tolist()
            assert [p.start for p in ps] == np.cumsum([0, *(p.length for p in ps)])[:-1].tolist()
            assert all(p.doc_tokens == len(ids) for p in ps)
            got[(doc, tuple(ids))] += 1
        else:
            # Rows of one doc_id can't be told apart by it: their pieces must be those of all of them.
            flat = Counter(x for _, ids in ends for x in ids)
            assert Counter(x for p in ps for x in np.frombuffer(bytes(p.ids), "<u4").tolist()) == flat
            assert Counter(p.start for p in ps if p.start == 0) == {0: len(ends)}
            assert {p.doc_tokens for p in ps} == {len(ids) for _, ids in ends}
            for p in ps:
                same = [ids for _, ids in ends if len(ids) == p.doc_tokens]
                assert any(list(ids[p.start : p.start + p.length]) == np.frombuffer(bytes(p.ids), "<u4").tolist() for ids in same)
            got.update(ends)
    assert got == want
    sizes = []
    for ps in by_sequence.values():
        ps.sort(key=lambda p: p.offset)
        assert [p.offset for p in ps] == np.cumsum([0, *(p.length for p in ps)])[:-1].tolist()
        sizes.append(sum(p.length for p in ps))
        assert sizes[-1] <= most
    padding = sum(most - n for n in sizes if n & (n - 1))
    return sizes, padding


def test_packing(spark, odd):
    pieces = packing.pack(odd, tokenizer=tokenizer_path()).collect()
    sizes, padding = check_pieces([(r[0], r[1]) for r in fx.odd_documents()], pieces)
    assert padding == 0 and max(sizes) == 4096
    sums = packing.with_checksums(packing.pack(odd, tokenizer=tokenizer_path())).collect()
    assert Counter((r.doc_id, r.start, r.ids_crc32, r.sequence_id, r.offset) for r in sums) == Counter((p.doc_id, p.start, zlib.crc32(bytes(p.ids)), p.sequence_id, p.offset) for p in pieces)


@pytest.mark.parametrize(("part_bytes", "off"), [(packing.PART_BYTES, 0.06), (60_000, 0.2)])
def test_windows_follow_the_mixture(spark, monkeypatch, part_bytes, off):
    """In one part closely; parts of a dozen documents hold what they hold."""
    monkeypatch.setattr(packing, "PART_BYTES", part_bytes)
    rng = random.Random(4)
    words = ["alpha", "beta", "gamma", "delta", "rho"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(20, 900))), ("x", "x", "x", "y", None)[i % 5]) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    pieces = packing.pack(docs, tokenizer=tokenizer_path()).collect()
    sizes, padding = check_pieces([(r[0], r[1]) for r in rows], pieces)
    assert padding == 0
    tokens = Counter()
    window = defaultdict(Counter)
    for p in pieces:
        tokens[p.source] += p.length
        window[p.sequence_id][p.source] += p.length
    share = tokens["x"] / sum(tokens.values())
    full = [w["x"] / 4096 for w in window.values() if sum(w.values()) == 4096]
    assert len(full) > 10 and np.mean([abs(x - share) for x in full]) < off
    again = packing.pack(docs.repartition(7), tokenizer=tokenizer_path()).collect()
    assert Counter(map(tuple, pieces)) == Counter(map(tuple, again))


def test_packer_serves_sources_without_a_share():
    p = packing.Packer({"a": 1.0, "b": 0.0}, {})
    p.add("b", "doc", b"\0" * 4 * 5000)
    assert sum(len(x[2]) >> 2 for x in p.rest()) == 5000


def test_deficits_are_what_is_due_less_what_is_given():
    """Neither bounded nor reset, whatever waits; a source that lacked tokens for long gets them all when it has some."""
    p = packing.Packer({"a": 0.5, "b": 0.5}, {"a": 1000.0, "b": -1000.0}, length=64, grain=8)
    given = Counter(a=0, b=0)
    for i in range(60):
        p.add("b", f"b{i}", b"\0" * 4 * 64)
    for _ in range(40):
        given["b"] += sum(len(x[2]) >> 2 for x in p.window(64))
    assert p.deficits == {"a": 1000 + 20 * 64, "b": -1000 + 20 * 64 - given["b"]} and given["b"] == 40 * 64
    p.add("a", "a", b"\0" * 4 * 640)
    first = list(p.window(64))
    assert {x[0] for x in first} == {"a"}


@pytest.mark.parametrize("part_bytes", [packing.PART_BYTES, 90_000])
@pytest.mark.parametrize("weights", [{"x": 3, "y": 1}, {"x": 1, "y": 1}, {None: 1, "y": 3}])
def test_packing_to_given_weights(spark, monkeypatch, part_bytes, weights):
    """Windows follow the weights in all parts, as long as a part has tokens of all sources that have a weight."""
    monkeypatch.setattr(packing, "PART_BYTES", part_bytes)
    rng = random.Random(14)
    words = ["alpha", "beta", "gamma", "delta", "rho"]
    names = [s for s in weights for _ in range(weights[s])]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(20, 300))), names[i % len(names)]) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    pieces = packing.pack(docs, tokenizer=tokenizer_path(), weights=weights).collect()
    check_pieces([(r[0], r[1]) for r in rows], pieces)
    window = defaultdict(Counter)
    for p in pieces:
        window[p.sequence_id][p.source] += p.length
    full = {k: w for k, w in window.items() if sum(w.values()) == 4096}
    whole, last = sum(weights.values()), {}
    for k in full:
        last[k >> 32] = max(k, last.get(k >> 32, k))
    assert (len(last) == 1) == (part_bytes > 1_000_000)
    inner = [w for k, w in full.items() if last[k >> 32] - k > 2]
    for s in weights:
        assert abs(np.mean([w[s] / 4096 for w in inner]) - weights[s] / whole) < 0.05
        assert np.mean([abs(w[s] / 4096 - weights[s] / whole) for w in inner]) < 0.1


def test_packing_of_sources_without_weight(spark, odd):
    pieces = packing.pack(odd, tokenizer=tokenizer_path(), weights={"a": 3, "b": 1}).collect()
    check_pieces([(r[0], r[1]) for r in fx.odd_documents()], pieces)


# Mixing.


def water_fill(sizes: dict, weights=(5, 2, 1), most=3):
    """Targets by sharing excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in full]
        level = (total - sum(full.values())) / sum(w[s] for s in rest) if rest else 0
        over = [s for s in rest if level * w[s] > most * sizes[s]]
        if not over:
            return full | {s: level * w[s] for s in rest}
        full |= {s: most * sizes[s] for s in over}


def seats_by_quotient(parties: dict, n: int) -> dict:
    won = dict.fromkeys(parties, 0)
    for _ in range(n):
        best = min(parties, key=lambda p: (-parties[p] / (2 * won[p] + 1), p))
        won[best] += 1
    return won


@pytest.mark.parametrize("n", [0, 1, 2, 7, 50, 333])
def test_apportionment_is_by_highest_quotients(spark, n):
    parties = {"a": 1000.0, "b": 17.0, "c": 333.5, "d": 1.0, "e": 90.0, "f": 0.0}
    df = spark.createDataFrame([(p, s, n, 1) for p, s in parties.items()], "source string, size double, seats long, grp int")
    got = {r.source: r.won for r in mixing.apportion(df, within=["grp"], size="size", seats="seats", ties=["source"], into="won").collect()}
    assert got == (seats_by_quotient(parties, n))


def test_mix(spark, odd):
    rows = [(r[0], r[1], r[3]) for r in fx.odd_documents()]
    size = Counter()
    for _, text, source in rows:
        size[source] += len(fx.WORD.findall(text or ""))
    want = water_fill(size)
    got = mixing.mix(odd).select("row.doc_id", "row.source", "row.text", "size", "source_size", "target", "taken").collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((d, len(fx.WORD.findall(t or ""))) for d, t, _ in rows)
    taken = Counter()
    for r in got:
        assert r.source_size == size[r.source] and r.target == pytest.approx(want[r.source]) and 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s in size:
        assert abs(taken[s] - want[s]) <= 64, s
    again = mixing.mix(odd.repartition(3)).select("row.doc_id", "taken").collect()
    assert Counter((r.doc_id, r.taken) for r in again) == Counter((r.doc_id, r.taken) for r in got)


def test_mixed_documents(spark, odd):
    out = mixing.mixed_documents(odd)
    assert out.columns == odd.columns
    words = Counter()
    texts = {r[1] for r in fx.odd_documents()}
    for r in out.collect():
        words[r.doc_id] += len(fx.WORD.findall(r.text))
        assert r.text in texts or any(r.text in t for t in texts if t)
    taken = Counter()
    for r in mixing.mix(odd).select("row.doc_id", "taken").collect():
        taken[r.doc_id] += r.taken
    assert +words == +taken


def test_mix_of_many_shards(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 500)
    rng = random.Random(8)
    rows = [(i, " ".join("w" for _ in range(rng.randint(0, 90))), rng.choice(["a", "a", "a", "b", "c"])) for i in range(600)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).select("row.source", "size", "target", "taken").collect()
    taken, target = Counter(), {}
    for r in got:
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken <= 3 * r.size
    for s, t in target.items():
        assert abs(taken[s] - t) < 0.03 * t


def brute_mix(df, block=mixing.BLOCK, seed=mixing.SEED):
    """taken of each row: all quotients one by one, every block of every shard looked at. Only the hashes are Spark's."""
    rows = df.select("doc_id", "source", "text", F.xxhash64(F.lit(seed), "doc_id", "text").alias("draw")).collect()
    size = lambda r: len(fx.WORD.findall(r.text or ""))
    of_source = Counter()
    for r in rows:
        of_source[r.source] += size(r)
    target = water_fill(of_source)
    order = lambda s: (s is not None, s or "")
    seats = round(sum(target.values()) / block)

    def quotients(parties, n):
        """Seats by the n highest; among equals the first party, null last."""
        won = dict.fromkeys(parties, 0)
        for _ in range(n):
            best = min((p for p in parties if parties[p] > 0), key=lambda p: (-parties[p] / (2 * won[p] + 1), p is None, p if p is not None else 0))
            won[best] += 1
        return won

    blocks = quotients(target, seats)
    taken = Counter()
    for s in sorted(of_source, key=order):
        n_shards = max(1, min(mixing.MOST_SHARDS, -(-of_source[s] // mixing.SHARD_WORDS)))
        shards = defaultdict(list)
        for i, r in enumerate(rows):
            if r.source == s:
                shards[r.draw % mixing.MOST_SHARDS % n_shards].append((r.draw, size(r), i))
        words = {k: sum(n for _, n, _ in v) for k, v in shards.items()}
        quota = quotients(words, blocks[s]) if any(words.values()) else dict.fromkeys(words, 0)
        key = "" if s is None else f"={s}"
        starts = {r.shard: r.h for r in df.sparkSession.createDataFrame([(key, k) for k in shards], "key string, shard int").select("shard", F.xxhash64(F.lit(seed), "key", "shard").alias("h")).collect()}
        for k, docs in shards.items():
            if not words[k]:
                continue
            given = min(quota[k] * block, words[k] * mixing.MOST)
            n_blocks = -(-words[k] // block)
            rounds = given // words[k]
            chosen = int((given - rounds * words[k]) * n_blocks / words[k] + 0.5)
            start = starts[k] % n_blocks
            picked = [(b - start) % n_blocks < chosen for b in range(n_blocks)]
            at = 0
            for _, n, i in sorted(docs):
                taken[i] += n * rounds + sum(picked[w // block] for w in range(at, at + n))
                at += n
    return Counter((r.doc_id, taken[i]) for i, r in enumerate(rows))


@pytest.mark.parametrize("shard_words", [mixing.SHARD_WORDS, 300])
def test_mix_against_brute_force(spark, odd, monkeypatch, shard_words):
    monkeypatch.setattr(mixing, "SHARD_WORDS", shard_words)
    rng = random.Random(21)
    rows = [(i, None if i % 50 == 0 else " ".join("w" for _ in range(rng.randint(0, 120))), rng.choice(["a", "a", "a", "b", "c", "d", None])) for i in range(400)]
    for df in (spark.createDataFrame(rows, "doc_id long, text string, source string"), *([odd] if shard_words > 1000 else [])):
        got = Counter((r.doc_id, r.taken) for r in mixing.mix(df).select("row.doc_id", "taken").collect())
        assert got == brute_mix(df)


def test_mix_empty(spark):
    empty = spark.createDataFrame([], fx.SCHEMA)
    assert mixing.mix(empty).collect() == [] and mixing.mixed_documents(empty).collect() == []
    assert packing.pack(empty, tokenizer=tokenizer_path()).collect() == []
    assert license_scan.scan(empty).collect() == [] and langid.identify(empty).collect() == []
    assert langid.known_language(empty).collect() == []


# Licences.


LICENSES = "doc_id long, text string, name string, at int, m string, license string"


def licenses(spark, texts):
    """Matches by document, each held against its words."""
    rows = [(i, t, "x", 1, "y", "z") for i, t in enumerate(texts)]
    found = license_scan.scan(spark.createDataFrame(rows, LICENSES)).collect()
    out = defaultdict(dict)
    for r in found:
        name, text, must = license_scan.TEMPLATES[r.template]
        words = license_scan.word_list(texts[r.doc_id])[r.first_word : r.first_word + r.n_words]
        a, b = set(zip(words, words[1:], strict=False)), set(license_scan.template_bigrams(text))
        assert r.license == name and r.dice == round(2 * len(a & b) / (len(a) + len(b)), 6) >= 0.8
        assert all(set(license_scan.template_bigrams(x)) <= a for x in must)
        out[r.doc_id][name] = (r.first_word, r.first_word + r.n_words - 2)
    for places in out.values():
        ordered = sorted(places.values())
        assert all(x[1] < y[0] for x, y in zip(ordered, ordered[1:], strict=False))
    return out


def prose(rng, n):
    return " ".join(rng.choice("the of a in to and river house under light software notice people their any with year public".split()) for _ in range(n))


def template(name, longest=True):
    return (max if longest else min)((t for n, t, _ in license_scan.TEMPLATES if n == name), key=len)


def test_license_cases(spark):
    mit, gpl = template("MIT"), template("GPL-3.0")
    four = mit.replace("to the following conditions: ", "to the following conditions:\n\n").replace(" THE SOFTWARE IS", "\n\nTHE SOFTWARE IS").replace(" IN NO EVENT", "\n\nIN NO EVENT")
    code = "\n".join(f"def f{i}(x):\n    return x + {i}" for i in range(80))
    texts = [
        "# Copyright (c) 2020 A. Author\n#\n" + "\n".join("# " + x for x in four.split("\n")) + "\n\n" + code,
        "// Copyright 2019 The Authors. Licensed under the Apache License, Version 2.0.\n" + code,
        "/*\n * " + "\n * ".join(re.findall(r".{1,60}(?: |$)", gpl)) + "\n */\n" + code,
        "# SPDX-License-Identifier: BSD-3-Clause\n" + code,
        "#!/bin/sh\n" + "\n".join("# " + x for x in re.findall(r".{1,70}(?: |$)", template("Apache-2.0"))) + "\n" + code,
        f"A sentence first. {template('CC-BY-NC-4.0', False)} And one more. {mit.upper()}",
        "SPDX-License-Identifier: Sleepycat", template("GPL-2.0"), template("BSD-2-Clause"), template("BSD-3-Clause"), "nothing of the kind " * 400, mit[: len(mit) // 2], "", None,
    ]
    got = {i: set(x) for i, x in licenses(spark, texts).items()}
    assert got == {0: {"MIT"}, 1: {"Apache-2.0"}, 2: {"GPL-3.0"}, 3: {"BSD-3-Clause"}, 4: {"Apache-2.0"}, 5: {"CC-BY-NC-4.0", "MIT"}, 7: {"GPL-2.0"}, 8: {"BSD-2-Clause"}, 9: {"BSD-3-Clause"}}


def test_licenses_in_altered_copies(spark):
    """Each text with one word in twenty changed, at line ends of its own, inside other words."""
    rng = random.Random(3)
    texts, names = [], []
    for name, text, _ in license_scan.TEMPLATES:
        for _ in range(3 if len(text.split()) >= 25 else 0):
            words = text.split()
            for i in rng.sample(range(len(words)), len(words) // 20):
                words[i] = rng.choice(["changed", "", "other words"])
            texts.append(f"{prose(rng, 150)}\n\n" + "".join(w + rng.choice([" "] * 9 + ["\n\n"]) for w in words) + prose(rng, 400))
            names.append(name)
    clean = [prose(rng, 600) for _ in range(60)]
    got = licenses(spark, texts + clean)
    assert np.mean([n in got[i] for i, n in enumerate(names)]) >= 0.9
    assert not any(i >= len(texts) for i in got)


def test_licenses_of_odd_rows(spark, odd):
    assert license_scan.scan(odd).collect() == []
    rows = [(None, "Released under the MIT License."), (4, "Released under the MIT License."), (4, "Released under the MIT License."), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter((r.doc_id, r.license, r.dice) for r in license_scan.scan(docs).collect()) == {(None, "MIT", 1.0): 1, (4, "MIT", 1.0): 2}
    plan = license_scan.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Exchange|Join", plan)


# Search.


def test_top_k(spark):
    rng = random.Random(6)
    vectors = [(i, [rng.choice([0.0, rng.gauss(0, 0.2)]) for _ in range(12)]) for i in range(400)]
    vectors += [(500 + i, vectors[0][1]) for i in range(30)] + [(1, None), (550, None), (600, []), (650, [float("nan")] * 12), (700, [None] * 12), (750, [1.0, float("inf")]), (800, [0.5] * 5), (None, [1.0] * 12)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    fine = [(i, np.floor(256 * np.array(np.float32(v), dtype=float)).astype(int).tolist()) for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(np.float32(x)) for x in v)]
    want = set()
    for i, q in fine:
        if i % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, c, strict=False)), j) for j, c in fine if j != i)[:5]
            want |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(scores)}
    got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df, is_query=F.col("vec_id") % 50 == 0, lanes=3).collect()}
    assert got == want
    clashing = df.withColumns({c: F.lit("x") for c in ("id", "w", "lane", "score", "ids", "query_id")})
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(clashing, is_query=F.col("vec_id") % 50 == 0, lanes=2).collect()} == want
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(empty, is_query=F.lit(True)).collect() == []


def test_several_vectors_of_one_query_id(spark):
    """Each different vector has a ranking of its own; equal ones answer once; repeated candidates are rows of their own."""
    df = spark.createDataFrame([(50, [1.0, 0.0]), (50, [0.0, 1.0]), (50, [0.0, 1.0]), (7, [0.5, 0.25]), (7, [0.5, 0.25]), (8, [0.0, 1.0])], "vec_id long, embedding array<float>")
    got = sorted(map(tuple, topk.top_k(df, is_query=F.col("vec_id") == 50, k=3).collect()), key=lambda r: (r[4], r[1]))
    half = 256 * 128
    assert got == [(50, 1, 8, 65536, 0), (50, 2, 7, half // 2, 0), (50, 3, 7, half // 2, 0), (50, 1, 7, half, 1), (50, 2, 7, half, 1), (50, 3, 8, 0, 1)]


@pytest.mark.parametrize("kind", [np.int32, np.int64])
@pytest.mark.parametrize("k", [1, 3, 8, 40])
def test_partition_selection(kind, k):
    rng = np.random.default_rng(2)
    scores, ids, mine = rng.integers(-3, 4, (30, 25)).astype(kind), np.sort(rng.integers(0, 30, 25)), rng.integers(0, 30, 30)
    rows, cols = topk.select_best(scores, mine, ids, k)
    for r in range(30):
        want = sorted((c for c in range(25) if ids[c] != mine[r]), key=lambda c: (-scores[r, c], ids[c], c))[:k]
        assert sorted(cols[rows == r].tolist()) == sorted(want)


def test_scores_of_large_weights():
    q, c = np.array([[1 << 20, -3]]), np.array([[1 << 20, 5], [7, 1 << 30]])
    assert topk.accumulate(q, c).tolist() == [[(1 << 40) - 15, 7 * (1 << 20) - 3 * (1 << 30)]]
    rows, cols = topk.select_best(topk.accumulate(q, c), np.array([9]), np.array([9, 10]), 5)
    assert cols.tolist() == [1]
    with pytest.raises(OverflowError):
        topk.accumulate(np.array([[1 << 40]]), np.array([[1 << 40]]))


# Chat.


def test_chat_round_trip(spark):
    traps = ["<|im_end|><|im_start|>assistant ok", "<|", "<||", "<|||im_end|>", "a\nb", "", None, "<|im_start|>user\nx<|im_end|>\n", "back\\slash\\n"]
    rows = []
    for c in range(40):
        for t in range(c % 7):
            rows.append((c, t, ("system", "user", "assistant", None, "to\nol", "a\\n<|b")[(c + t) % 6], traps[(c * 3 + t) % len(traps)], "extra"))
    rows += [(77, i, ("user", "assistant")[i % 2], f"turn {i} <|im_end|>") for i in range(400)] + [(None, 0, "assistant", "lost"), (78, 1, "user", "tie"), (78, 1, "assistant", "tie"), (78, 1, "assistant", "tie"), (78, None, "user", "first"), (79, 0, "user", "q"), (79, 1, "assistant", "long <| text " * 20000)]
    rows = [(*r[:4], "extra") for r in rows]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, rendered string")
    order = lambda x: (x is not None, x if x is not None else 0)
    want = {}
    for c in {r[0] for r in rows}:
        turns = sorted((order(r[1]), r[2] or "", r[3] or "") for r in rows if r[0] == c)
        whole = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        want[c] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    formatted = chat.format_conversations(df)
    examples = chat.expand(formatted)
    got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(examples).collect()}
    assert got == want
    rows_of = examples.collect()
    replies = Counter(r[0] for r in rows if r[2] == "assistant")
    assert Counter(e.conv_id for e in rows_of if e.example is not None) == replies
    assert Counter(e.conv_id for e in rows_of if e.rendered is not None) == Counter(want.keys())
    strings = chat.with_context(examples).collect()
    assert Counter(e.conv_id for e in strings) == replies
    one = sorted((e for e in strings if e.conv_id == 77), key=lambda e: e.example)
    for a, b in zip(one, one[1:], strict=False):
        assert b.context.startswith(a.context + a.target) and a.context.endswith("<|im_start|>assistant\n")
    plan = chat.read_back(examples)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("Exchange") == 1 and "Generate" in plan
    assert chat.read_back(chat.expand(chat.format_conversations(df.limit(0)))).collect() == []


# Language.


def test_language_of_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 250 and np.mean([r.lang == r.lang_pred for r in got]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_language_of_mixtures(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.learn(docs)
    pure = {lang: " ".join(r.text for r in docs.where(F.col("lang") == lang).limit(30).collect())[:20000] for lang in ("en", "de")}
    found = model.predict([pure["en"], pure["de"], pure["en"][:6000] + " " + pure["de"][:14000]])
    assert [f[0] for f in found] == ["en", "de", "de"] and found[2][2] == ["de", "en"] and 0.5 < found[2][1] < 0.9 and found[0][2] == ["en"]


def test_language_of_odd_rows(spark, odd):
    got = langid.identify(odd).collect()
    assert len(got) == len(fx.odd_documents())
    by = defaultdict(set)
    for r in got:
        by[r.doc_id].add(r.lang_pred)
    assert by[0] == by[1] == by[2] == by[19] == {"und"} and by[5] != {"und"} and by[20] != {"und"}
    kept = langid.known_language(odd)
    assert kept.columns == odd.columns and {0, 1, 2, 19}.isdisjoint(r.doc_id for r in kept.collect())
    none = langid.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in none} == {"und"}
