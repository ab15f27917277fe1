"""Near copies for a corpus: the SimHash operator at a similarity of word shingles.

Two texts are near copies if their sets of runs of ``SHINGLE`` words have a Jaccard similarity of
``SIMILARITY`` or more; groups are what such links connect. Texts of equal sets collapse at once.

Candidates are the links of the Gray-order index over the sets' SimHash fingerprints, and, since a pair at 0.8
differs in some ten of the 64 bits, which no index of few bits reaches, sets that share a band: ``ROWS``
minima of the set under as many hash functions. With ``BANDS`` bands a pair at 0.8 is missed with a
probability of (1 - 0.8^4)^32 < 5e-8, and a more similar one with less. Every link is confirmed exactly.

First each set is compared with the least set of each of its bands, so that a band that many share makes
no pairs. Where a band's sets don't all end up in one group, all of them that are in different groups are
compared: such bands with one least set are a residue, which is cut into blocks of about ``BLOCK`` shingles, and a
task has two blocks of one residue. There, sets go by the prefixes of their rarest shingles.

Defined results: a null text has no words, and all texts without words are copies of each other. A text
of fewer words than a shingle is one shingle. Extra columns are not looked at.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import checkpoint, perhaps, tabled, trimmed
from quillstone.llm.components import components
from quillstone.llm.simhash import MAX_BITS, SPAN, Forest, key_columns, majority, near_links, one_of_each, shingle_hashes

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 32
ROWS = 4
BLOCK = 1 << 18
_DRAWN = np.random.default_rng(5).integers(0, 1 << 64, (3, BANDS * ROWS), dtype=np.uint64)
_TIMES, _PLUS, _MIX = _DRAWN[0] | np.uint64(1), _DRAWN[1], _DRAWN[2] | np.uint64(1)


def shingle_set(text: str | None) -> np.ndarray:
    """The distinct shingle hashes in order."""
    return np.unique(shingle_hashes(text, SHINGLE))


def set_id(shingles: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(shingles.tobytes())


def bands(sets: list[np.ndarray]) -> np.ndarray:
    """For each set, none of them empty, a key for each band."""
    flat, starts = np.concatenate(sets), np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), BANDS), dtype=np.uint64)
    for b in range(BANDS):
        key = np.full(len(sets), b, dtype=np.uint64)
        for j in range(b * ROWS, (b + 1) * ROWS):
            key = (key ^ np.minimum.reduceat(flat * _TIMES[j] + _PLUS[j], starts)) * _MIX[j]
            key ^= key >> np.uint64(29)
        out[:, b] = key
    return out


def _marks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, sizes, prints, keys, waiting, size = [], [], [], [], [], 0

        def flush() -> None:
            sets = [np.unique(h) for h in waiting]
            some = [s for s in sets if len(s)]
            found = iter(bands(some).view(np.int64)) if some else iter(())
            keys.extend(next(found) if len(s) else np.empty(0, dtype=np.int64) for s in sets)
            ids.extend(map(set_id, sets))
            sizes.extend(map(len, sets))
            prints.append(majority(waiting))

        for x in batch.column("text"):
            waiting.append(shingle_hashes(x.as_py(), SHINGLE))
            size += len(waiting[-1])
            if size >= SPAN:
                flush()
                waiting, size = [], 0
        if waiting:
            flush()
        names = ["no_id", "an_id", "text_hash"]
        number = lambda x: pa.array(np.array(x, dtype=np.uint64).view(np.int64))
        fp = number(np.concatenate(prints) if prints else [])
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], number(ids), pa.array(sizes, pa.int64()), fp, pa.array(keys, pa.list_(pa.int64()))], [*names, "set_id", "size", "fp", "bands"])


def marks(docs: DataFrame) -> DataFrame:
    """(no_id, an_id, text_hash, set_id, size, fp, bands) of every row."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(*key_columns(docs), "text").mapInArrow(trimmed(_marks), f"no_id boolean, an_id {id_type}, text_hash long, set_id long, size long, fp long, bands array<long>")


def similar_enough(x: np.ndarray, y: np.ndarray, similarity: float = SIMILARITY) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= similarity * (len(x) + len(y) - both) - 1e-9


def new_links(sets: list[np.ndarray], groups: list[int], similarity: float = SIMILARITY) -> list[tuple[int, int]]:
    """(i, j) of links between sets, none of them empty, that join different groups; exact."""
    _, which, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(counts), dtype=np.int64)
    rank[np.argsort(counts, kind="stable")] = np.arange(len(counts))
    shared = np.sort(counts) > 1
    ranked = [np.sort(r) for r in np.split(rank[which], np.cumsum([len(s) for s in sets])[:-1])]
    forest, postings, found = Forest(), defaultdict(list), []
    for i in sorted(range(len(sets)), key=lambda i: len(ranked[i])):
        x = ranked[i]
        prefix = x[: len(x) - math.ceil(similarity * len(x) - 1e-9) + 1]
        prefix = prefix[shared[prefix]].tolist()
        seen = set()
        for p in prefix:
            for j in postings[p]:
                if j in seen:
                    continue
                seen.add(j)
                y = ranked[j]
                if len(y) < similarity * len(x) - 1e-9 or forest.find(groups[i]) == forest.find(groups[j]):
                    continue
                if similar_enough(x, y, similarity):
                    forest.join(groups[i], groups[j])
                    found.append((i, j))
            postings[p].append(i)
    return found


def _confirm(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (u, v, text, v_text), those of one v mostly together."""
    last, y = None, None
    for batch in batches:
        good = []
        for v, text, v_text in zip(batch.column("v").to_pylist(), batch.column("text"), batch.column("v_text"), strict=True):
            if v != last:
                last, y = v, shingle_set(v_text.as_py())
            good.append(similar_enough(shingle_set(text.as_py()), y))
        yield batch.select(["u", "v"]).filter(pa.array(good, pa.bool_()))


def _residues(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (root, low, high, set_id, label, text), sorted by the first three."""
    key, sets, labels = None, {}, {}

    def out() -> pa.RecordBatch:
        ids = list(sets)
        found = new_links(list(sets.values()), [labels[i] for i in ids]) if len(set(labels.values())) > 1 else []
        return pa.RecordBatch.from_arrays([pa.array([ids[i] for i, _ in found], pa.int64()), pa.array([ids[j] for _, j in found], pa.int64())], ["u", "v"])

    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("root", "low", "high", "set_id", "label")), batch.column("text"), strict=True)
        for root, low, high, of_set, label, text in rows:
            if key != (root, low, high):
                if sets:
                    yield out()
                key, sets, labels = (root, low, high), {}, {}
            if of_set not in sets:
                sets[of_set], labels[of_set] = shingle_set(text.as_py()), label
    if sets:
        yield out()


def shared_bands(sets: DataFrame) -> DataFrame:
    """(set_id, band, least): of the bands of sets (set_id, bands) those that several sets have, with the least set of each."""
    dealt = sets.select("set_id", F.explode("bands").alias("band"))
    least = dealt.groupBy("band").agg(F.min("set_id").alias("least"), F.max("set_id").alias("most")).where("least < most").select("band", "least")
    return dealt.join(least, "band")


def print_links(sets: DataFrame) -> DataFrame:
    """(u, v): links of the fingerprints' index between the least sets of each, and of the other sets to those."""
    least = sets.groupBy("fp").agg(F.min("set_id").alias("set_id"))
    links = near_links(least.select("fp"), limit=MAX_BITS)
    name = lambda c: least.select(F.col("fp").alias(f"{c}_fp"), F.col("set_id").alias(c))
    between = links.select(F.col("u").alias("u_fp"), F.col("v").alias("v_fp")).join(name("u"), "u_fp").join(name("v"), "v_fp").select("u", "v")
    return between.unionByName(sets.select("fp", F.col("set_id").alias("u")).join(least.withColumnRenamed("set_id", "v"), "fp").where("u != v").select("u", "v"))


def similar_groups(docs: DataFrame) -> DataFrame:
    """(no_id, an_id, text_hash, root) of every row; root tells groups apart."""
    marked = checkpoint(marks(docs))
    sets = tabled(marked.groupBy("set_id").agg(F.min(F.struct("no_id", "an_id", "text_hash")).alias("key"), F.first("size").alias("size"), F.first("fp").alias("fp"), F.first("bands").alias("bands")))
    shared = tabled(shared_bands(sets.where("size > 0")))
    by_band = shared.where("set_id != least").select(F.col("set_id").alias("u"), F.col("least").alias("v"))
    pairs = by_band.unionByName(print_links(sets.where("size > 0").select("set_id", "fp")))
    pairs = tabled(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct())
    nodes = pairs.select(F.explode(F.array("u", "v")).alias("set_id")).distinct()
    key = ["no_id", "an_id", "text_hash"]
    wanted = tabled(sets.select("set_id", "size", "key").join(nodes, "set_id").select("set_id", "size", "key.*"))
    texts = tabled(perhaps(docs.select(*key_columns(docs), "text"), wanted, key).join(wanted, key).groupBy("set_id").agg(F.first("size").alias("size"), F.first("text").alias("text")))
    both = pairs.join(texts.select(F.col("set_id").alias("u"), "text"), "u").join(texts.select(F.col("set_id").alias("v"), F.col("text").alias("v_text")), "v")
    links = checkpoint(both.select("u", "v", "text", "v_text").mapInArrow(trimmed(_confirm), "u long, v long"))
    labels = components(links)
    left = shared.join(labels.withColumnRenamed("node", "set_id"), "set_id", "left").select("set_id", "band", F.col("least").alias("root"), F.coalesce("root", "set_id").alias("label"))
    open_bands = left.groupBy("band").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a < b").select("band")
    open_sets = checkpoint(left.join(open_bands, "band").select("root", "set_id", "label").distinct())
    more = residue_links(open_sets, texts) if not open_sets.isEmpty() else None
    groups = components(links if more is None else links.unionByName(more)).select(F.col("node").alias("set_id"), "root")
    return marked.join(groups, "set_id", "left").select("no_id", "an_id", "text_hash", F.coalesce("root", "set_id").alias("root"))


def residue_links(open_sets: DataFrame, texts: DataFrame) -> DataFrame:
    """(u, v): links between sets (root, set_id, label) of one root and different labels, by blocks."""
    held = open_sets.join(texts, "set_id")
    blocks = held.groupBy("root").agg(F.expr(f"cast(ceil(sum(size) / {BLOCK}) as int)").alias("blocks"))
    block = F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int")
    spread = held.join(blocks, "root").withColumn("block", block).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    tasks = spread.select("root", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "set_id", "label", "text")
    return tasks.repartition("root", "low", "high").sortWithinPartitions("root", "low", "high").mapInArrow(trimmed(_residues), "u long, v long")
