"""SimHash near-dedup over a Gray-order hierarchical index.

A document's fingerprint is the bitwise majority of the XXH64 hashes of its word shingles. Copies
collapse at once: only distinct fingerprints are indexed. The 64 bits are cut into ``limit + 3`` blocks.
Two fingerprints that differ in no more than ``limit`` bits agree in three blocks at least, so each
fingerprint goes into one bucket for every choice of three blocks: ten buckets at two bits, however many
fingerprints there are. A bucket with more than ``BUCKET`` fingerprints is cut the same way once more,
by the bits on which its members may still differ: then they agree in about 51 bits, and a bucket can't hold more
than some 2^13 fingerprints.

In a bucket the fingerprints are sorted by Gray rank and form a tree. A node keeps the bits on which all
below it agree and which its parent doesn't have yet; a search accumulates differences from the root
down and prunes a node, with all below it, once they exceed the limit. Buckets of at most ``SMALL`` are leaves:
their members are compared directly. Of the links found in a bucket that has a tree only a spanning forest is
written, which leaves the components as they are. No bucket, group or component is collected.

``keep_one`` is for a corpus: it takes texts whose sets of five-word shingles have a similarity of 0.8 or
more as near copies, see ``similar``.

Defined results: a null text has no words. A text without words has fingerprint zero and is linked
like any other. A null doc_id takes part but never names a component unless all its members are null.
Rows equal in doc_id each get a row. Extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstone.llm.common import checkpoint, columns_of, trimmed, unpack
from quillstone.llm.components import components

SHINGLE = 3
SEED = 42
MAX_BITS = 2
BUCKET = 4096
SMALL = 32
FAN = 16
#: Shingle hashes whose bits are counted at a time, and queries searched at a time: bounds on memory.
SPAN = 1 << 17
QUERIES = 1 << 13


def shingle_hashes(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of every run of ``size`` words, repeats included; of all words, if there are fewer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    data, hashed = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([hashed(data, SEED)], dtype=np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - size + 1].tolist()
    return np.array([hashed(data[a:b], SEED) for a, b in zip(starts, ends[size - 1 :].tolist(), strict=True)], dtype=np.uint64)


def majority(hashes: list[np.ndarray]) -> np.ndarray:
    """For each array of hashes the bits that are set in over half of them."""
    counts = np.array([len(h) for h in hashes], dtype=np.int64)
    ones = np.zeros((len(hashes), 64), dtype=np.int64)
    owners = np.repeat(np.arange(len(hashes)), counts)
    flat = np.concatenate(hashes) if len(hashes) else np.empty(0, dtype=np.uint64)
    for at in range(0, len(flat), SPAN):
        part, owner = flat[at : at + SPAN], owners[at : at + SPAN]
        bits = np.unpackbits(part.astype(">u8").view(np.uint8)).reshape(-1, 64)
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        ones[owner[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int32)
    return np.packbits(ones * 2 > counts[:, None], axis=1).view(">u8").astype(np.uint64).reshape(-1)


def _fingerprints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints, waiting, size = [], [], 0
        for x in batch.column("text"):
            waiting.append(shingle_hashes(x.as_py()))
            size += len(waiting[-1])
            if size >= SPAN:
                prints.append(majority(waiting))
                waiting, size = [], 0
        if waiting:
            prints.append(majority(waiting))
        fp = np.concatenate(prints).view(np.int64) if prints else np.empty(0, dtype=np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(fp)], ["doc_id", "text_hash", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp) of every row; fp holds the 64 bits."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(trimmed(_fingerprints), f"doc_id {id_type}, text_hash long, fp long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the reflected Gray sequence."""
    out = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(shift)
    return out


class GrayIndex:
    """A tree over codes in Gray order; each node has the bits its codes agree on and its parent's don't."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes[np.argsort(gray_rank(codes))]
        every, some, levels = [self.codes], [self.codes], []
        while len(every[-1]) > 1 or len(every) == 1:
            starts = np.arange(0, len(every[-1]), FAN)
            every.append(np.bitwise_and.reduceat(every[-1], starts))
            some.append(np.bitwise_or.reduceat(some[-1], starts))
        agreed = np.zeros(1, dtype=np.uint64)
        for e, s in zip(reversed(every), reversed(some), strict=True):
            parents = agreed[np.arange(len(e)) // FAN]
            agreed = ~(e ^ s)
            levels.append((e, agreed & ~parents))
        #: From the root to the codes: patterns, and masks of what is new at the node.
        self.levels = levels

    def search(self, queries: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """(query number, code) of each link within ``limit`` bits."""
        who, what = [], []
        for at in range(0, len(queries), QUERIES):
            q = np.arange(at, min(at + QUERIES, len(queries)))
            node, off = np.zeros(len(q), dtype=np.int64), np.zeros(len(q), dtype=np.int64)
            for depth, (pattern, mask) in enumerate(self.levels):
                if depth:
                    node = (node[:, None] * FAN + np.arange(FAN)).ravel()
                    q, off = np.repeat(q, FAN), np.repeat(off, FAN)
                    there = node < len(pattern)
                    q, off, node = q[there], off[there], node[there]
                off = off + np.bitwise_count((queries[q] ^ pattern[node]) & mask[node])
                near = off <= limit
                q, off, node = q[near], off[near], node[near]
            who.append(q)
            what.append(self.codes[node])
        return (np.concatenate(who), np.concatenate(what)) if who else (np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64))


class Forest:
    """Union-find over the codes of one block; tells which links join two trees."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        while (y := up.setdefault(x, x)) != x:
            up[x] = up[y]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[a] = b
        return a != b


def _links(index: GrayIndex, forest: Forest, queries: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Links of the queries, less those between codes that are joined already."""
    who, what = index.search(queries, limit)
    if not len(who):
        return []
    first = np.concatenate(([True], who[1:] != who[:-1])) if (np.diff(who) >= 0).all() else None
    if first is None:
        order = np.argsort(who, kind="stable")
        who, what = who[order], what[order]
        first = np.concatenate(([True], who[1:] != who[:-1]))
    heads = what[np.flatnonzero(first)][np.cumsum(first) - 1]
    out = [(a, b) for a, b in zip(queries[who[first]].tolist(), what[first].tolist(), strict=True) if a != b]
    pairs = np.unique(np.stack([heads[~first], what[~first]], axis=1), axis=0)
    return out + [(a, b) for a, b in pairs.tolist() if forest.join(a, b)]


def _small_links(key: np.ndarray, codes: np.ndarray, limit: int) -> list[np.ndarray]:
    """(u, v) of links between neighbours of one key, fewer than ``SMALL`` places apart."""
    out = []
    for step in range(1, SMALL):
        same = key[step:] == key[:-step]
        if not same.any():
            break
        at = np.flatnonzero(same)
        near = at[np.bitwise_count(codes[at] ^ codes[at + step]) <= limit]
        out.append(np.stack([codes[near], codes[near + step]], axis=1))
    return out


def _search(limit: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by bucket; what a batch ends with waits for the rest of its bucket."""
        keys, codes = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)

        def links(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
            first = np.flatnonzero(np.diff(key, prepend=key[:1] - 1)) if len(key) else np.empty(0, dtype=np.int64)
            sizes = np.diff(np.append(first, len(key)))
            small = np.repeat(sizes <= SMALL, sizes)
            found = _small_links(key[small], fp[small], limit)
            for i in np.flatnonzero(sizes > SMALL).tolist():
                bucket = np.unique(fp[first[i] : first[i] + sizes[i]])
                if len(bucket) > 1:
                    found.append(np.array(_links(GrayIndex(bucket), Forest(), bucket, limit), dtype=np.uint64).reshape(-1, 2))
            both = np.concatenate([np.empty((0, 2), dtype=np.uint64), *found]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["u", "v"])

        for batch in batches:
            keys = np.concatenate((keys, batch.column("bucket").to_numpy()))
            codes = np.concatenate((codes, batch.column("fp").to_numpy().view(np.uint64)))
            turns = np.flatnonzero(keys[1:] != keys[:-1])
            last = int(turns[-1]) + 1 if len(turns) else 0
            if last:
                yield from links(keys[:last], codes[:last])
                keys, codes = keys[last:], codes[last:]
        if len(keys):
            yield from links(keys, codes)

    return run


def _masks(bits: int, blocks: int, kept: int) -> list[int]:
    """The lowest ``bits`` bits cut into blocks: a mask for each choice of so many blocks."""
    edges = [bits * i // blocks for i in range(blocks + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(parts, kept)]


def _spread(mask: int, within: int) -> int:
    """The bits of ``within``, lowest first, that ``mask`` chooses."""
    places = [i for i in range(64) if within >> i & 1]
    return sum(1 << p for i, p in enumerate(places) if mask >> i & 1)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def near_links(prints: DataFrame, *, limit: int = MAX_BITS) -> DataFrame:
    """(u, v): links between distinct fingerprints ``fp`` that hold all components within ``limit`` bits."""
    outer = _masks(64, limit + 3, 3)
    bucket = lambda masks: F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(_signed(m)))) for i, m in enumerate(masks)])
    rows = prints.select("fp", F.posexplode(bucket(outer)).alias("choice", "bucket"))
    full = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BUCKET).select("bucket", F.lit(True).alias("full"))
    marked = rows.join(full, "bucket", "left")
    inner = F.array(
        *[
            F.array(*[F.xxhash64(F.lit(len(outer)), "bucket", F.lit(j), F.col("fp").bitwiseAND(F.lit(_signed(m | _spread(k, ~m & (1 << 64) - 1))))) for j, k in enumerate(_masks(64 - m.bit_count(), limit + 2, 2))])
            for m in outer
        ]
    )
    dealt = marked.select("fp", F.explode(F.when(F.col("full"), F.get(inner, F.col("choice"))).otherwise(F.array("bucket"))).alias("bucket"))
    return dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_search(limit), "u long, v long")


def near_groups(docs: DataFrame, *, limit: int = MAX_BITS) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) of every row; root tells groups apart."""
    marks = checkpoint(fingerprints(docs))
    prints = checkpoint(marks.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(near_links(prints.select("fp"), limit=limit))
    placed = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    names = placed.join(named, "root").select("fp", "root", "component_id")
    return marks.join(names, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def near_dedup(docs: DataFrame, *, limit: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id) of every row: the smallest doc_id that links lead to."""
    return near_groups(docs, limit=limit).select("doc_id", "fp", "component_id")


def key_columns(docs: DataFrame) -> list:
    """no_id, an_id and text_hash: the key of a row, never null."""
    no_id, an_id = F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0).cast(docs.schema["doc_id"].dataType))
    return [no_id.alias("no_id"), an_id.alias("an_id"), F.xxhash64("text").alias("text_hash")]


def one_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """docs with one row of each group of found (no_id, an_id, text_hash, root): one with the smallest doc_id.

    The key of a row is never null, so that the join and the choice among repeated rows share one shuffle.
    """
    key = ["no_id", "an_id", "text_hash"]
    chosen = found.groupBy("root").agg(F.min(F.struct(*key)).alias("key")).select("key.*")
    rows = docs.select(F.struct(*columns_of(docs)).alias("row"), *key_columns(docs))
    one = Window.partitionBy(*key).orderBy(F.lit(0))
    return unpack(rows.join(chosen, key, "left_semi").withColumn("nth", F.row_number().over(one)).where("nth = 1").select("row"))


def keep_one(docs: DataFrame) -> DataFrame:
    """docs with one row of each group of near copies: one with the smallest doc_id, null if there is no other.

    For a corpus: five words a shingle and a similarity of 0.8 or more, exactly, see ``similar``.
    """
    from quillstone.llm.similar import similar_groups

    return one_of_each(docs, similar_groups(docs))


def hex_fingerprint(fp):
    """16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
