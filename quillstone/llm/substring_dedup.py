"""Substring dedup by hashing paragraphs, lines and pieces of lines.

A document is a sequence of words: runs of other than white space, A-Z lower-cased. Its units are its
paragraphs, its lines, and pieces between cuts that neighbouring words decide by themselves, so that a
passage has the same pieces wherever it stands in a line. Units are hashed and their digests grouped
over all documents: within slices of a digest first, so that a unit that a third of all documents hold is spread
over ``SLICES`` tasks, then over slices. The occurrence that ranks first, by doc_id and then by place, is
the one to keep. Hits of a document that point to one kept document at one distance form a
cluster. Both texts around a cluster are then compared word by word, which extends it to both sides and
makes hash collisions harmless. What is equal over more than ``MORE_THAN`` words is a repeat, given with its original
offsets. A repeat's kept place ranks before it, so a copy of every word stays.

A stretch of hits that can't reach that length, even with all of the unshared pieces around it, is not
compared; that loses nothing. A comparison reaches ``REACH`` words beyond a cluster, on either side, which is
more than a repeat needs to be found, and what lies farther has hits of its own. A repeat is missed
only if no whole unit of at least ``LEAST`` words lies in it.

Defined results: a null or empty text has no words. A null doc_id ranks last. Rows equal in doc_id and
text are one document; rows with the same doc_id and different texts are different ones, in the order of
a hash of the text. Spans that different kept documents explain may overlap. Extra columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstone.llm.common import checkpoint, columns_of, trimmed, unpack

#: Words that a repeat must exceed.
MORE_THAN = 50
#: Words to each side that decide on a cut; the least words of a unit; the most of a piece.
SIDE, LEAST, MOST = 5, 4, 32
#: Words of the largest unit: what is longer has smaller ones.
LARGEST = (1 << 18) - 1
#: Tasks over which a unit's occurrences are dealt.
SLICES = 64
#: Words to each side of a cluster that are compared.
REACH = 64
#: Units that wait before they are written: a bound on memory.
SLAB = 1 << 16

_LETTERS = np.ones(256, dtype=bool)
_LETTERS[[9, 10, 11, 12, 13, 32]] = False
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD1342543DE82EF95)
_BACK = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class _Powers:
    """Powers of the base and of its inverse, as many as were asked for so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(4096, 1 << n.bit_length())
            self.up, self.down = (np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(size, b, dtype=np.uint64)))) for b in (_BASE, _BACK))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


class Words:
    """The words of a text: hashes, and places in code points."""

    def __init__(self, text: str | None):
        data = (text or "").encode("utf-8", "surrogatepass")
        raw = np.frombuffer(data, dtype=np.uint8)
        inside = np.concatenate(([False], _LETTERS[raw], [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.words = data.lower().split()
        first, last = edges[::2], edges[1::2]
        chars = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
        self.starts, self.ends = chars[first], chars[last]
        self.breaks = np.concatenate(([0], np.cumsum(raw == 10)))[first]

    def __len__(self) -> int:
        return len(self.starts)


def cuts_of(hashes: np.ndarray) -> np.ndarray:
    """Where pieces begin, and the end: words whose pair with the next hashes least among ``SIDE`` on either side."""
    n = len(hashes)
    pair = np.full(n, np.iinfo(np.uint64).max, dtype=np.uint64)
    pair[:-1] = _mixed(hashes[:-1] * _ODD + hashes[1:])
    padded = np.concatenate((np.full(SIDE, np.iinfo(np.uint64).max, dtype=np.uint64), pair, np.full(SIDE, np.iinfo(np.uint64).max, dtype=np.uint64)))
    around = np.lib.stride_tricks.sliding_window_view(padded, 2 * SIDE + 1)
    cut = (pair < around[:, :SIDE].min(axis=1)) & (pair <= around[:, SIDE + 1 :].min(axis=1))
    bounds = np.concatenate(([0], np.flatnonzero(cut[1:]) + 1, [n]))
    long = np.diff(bounds) > MOST
    if not long.any():
        return bounds
    more = [np.arange(a, b, MOST) for a, b in zip(bounds[:-1][long].tolist(), bounds[1:][long].tolist(), strict=True)]
    return np.unique(np.concatenate((bounds, *more)))


def units_of(text: str | None) -> tuple[Words, list[np.ndarray]]:
    """The words, and of each unit: digest, first word, words, the words that a repeat with it can reach from and to."""
    w = Words(text)
    n = len(w)
    if not n:
        return w, [np.empty(0, dtype=np.int64)] * 5
    hashes = _mixed(np.fromiter(map(crc32, w.words), dtype=np.uint64, count=n) + _ODD)
    bounds = cuts_of(hashes)
    at, till = [bounds[:-1]], [bounds[1:]]
    step = np.diff(w.breaks)
    for gap in (1, 2):
        begins = np.concatenate(([0], np.flatnonzero(step >= gap) + 1))
        at.append(begins)
        till.append(np.append(begins[1:], n))
    a, b = np.concatenate(at), np.concatenate(till)
    whole = (b - a >= LEAST) & (b - a <= LARGEST)
    a, b = np.unique(np.stack([a[whole], b[whole]]), axis=1) if whole.any() else (a[:0], b[:0])
    up, down = _POWERS.of(n)
    sums = np.concatenate(([np.uint64(0)], np.cumsum(hashes * up, dtype=np.uint64)))
    digest = _mixed((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64)) if len(a) else np.empty(0, dtype=np.uint64)
    low = bounds[np.maximum(np.searchsorted(bounds, a, side="right") - 2, 0)] - SIDE
    high = bounds[np.minimum(np.searchsorted(bounds, b, side="left") + 1, len(bounds) - 1)] + SIDE
    return w, [digest.view(np.int64), a, b - a, np.maximum(low, 0), np.minimum(high, n)]


KEY = ["no_id", "an_id", "twin"]
_UNIT = ["digest", "place", "window"]


def key_columns(docs: DataFrame) -> list:
    """no_id, an_id and twin, which tells texts of one doc_id apart: a document's key, never null."""
    an_id = F.coalesce("doc_id", F.lit(0).cast(docs.schema["doc_id"].dataType))
    return [F.col("doc_id").isNull().alias("no_id"), an_id.alias("an_id"), F.hash("text").alias("twin")]


def packed(at: np.ndarray, n: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Place of a unit in one number that sorts by ``at``; low and high are at most 3 pieces away."""
    return at << 34 | n << 16 | (at - low) << 8 | (high - at - n)


def unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    at, n = place >> 34, place >> 16 & LARGEST
    return at, n, at - (place >> 8 & 255), at + n + (place & 255)


def _units(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        owners, columns, size = [], [[] for _ in _UNIT], 0

        def out(owners=owners, columns=columns, batch=batch) -> pa.RecordBatch:
            rows = pa.array(np.concatenate(owners) if owners else np.empty(0, dtype=np.int64), pa.int64())
            values = [pa.array(np.concatenate(c) if c else np.empty(0, dtype=np.int64)) for c in columns]
            for c in (owners, *columns):
                c.clear()
            return pa.RecordBatch.from_arrays([*(batch.column(k).take(rows) for k in KEY), *values], [*KEY, *_UNIT])

        for row, x in enumerate(batch.column("text")):
            w, (digest, a, n, low, high) = units_of(x.as_py())
            if not len(a):
                continue
            owners.append(np.full(len(a), row))
            c0 = w.starts[np.maximum(a - REACH, 0)]
            for c, v in zip(columns, [digest, packed(a, n, low, high), c0 << 32 | (w.ends[np.minimum(a + n + REACH, len(w)) - 1] - c0)], strict=True):
                c.append(v)
            size += len(a)
            if size >= SLAB:
                yield out()
                size = 0
        yield out()


def units(docs: DataFrame) -> DataFrame:
    """(no_id, an_id, twin, digest, place, window) of every unit.

    place: its first word, its words, and how far a repeat without a further hit could reach; window:
    the code points of the words within ``REACH``.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"no_id boolean, an_id {id_type}, twin int, " + ", ".join(f"{c} long" for c in _UNIT)
    return docs.select(*key_columns(docs), "text").mapInArrow(trimmed(_units), schema)


_CLUSTER = ["first", "last", "shift", "c0", "c1", "k_c0", "k_c1"]


def clusters_of(place: np.ndarray, window: np.ndarray, k_place: np.ndarray, k_window: np.ndarray, kept: np.ndarray, more_than: int) -> tuple[np.ndarray, np.ndarray]:
    """Clusters of one document's hits, which kept[i] numbers by kept document.

    Returns the rows of _CLUSTER and for each the number of a hit that belongs to it.
    """
    order = np.argsort(place, kind="stable")
    at, n, low, high = unpacked(place[order])
    reach = np.maximum.accumulate(at + n)
    begins = np.concatenate(([True], at[1:] > reach[:-1] + SIDE))
    first = np.flatnonzero(begins)
    room = np.maximum.reduceat(high, first) - np.minimum.reduceat(low, first)
    fit = (room > more_than)[np.cumsum(begins) - 1]
    at, n, order = at[fit], n[fit], order[fit]
    if not len(at):
        return np.empty((0, len(_CLUSTER)), dtype=np.int64), order
    shift = unpacked(k_place[order])[0] - at
    by = np.lexsort((at, shift, kept[order]))
    at, end, shift, order = at[by], (at + n)[by], shift[by], order[by]
    kept, c0, k_c0 = kept[order], window[order] >> 32, k_window[order] >> 32
    c1, k_c1 = c0 + (window[order] & 0xFFFFFFFF), k_c0 + (k_window[order] & 0xFFFFFFFF)
    new = np.concatenate(([True], (kept[1:] != kept[:-1]) | (shift[1:] != shift[:-1]) | (at[1:] > end[:-1] + REACH)))
    first = np.flatnonzero(new)
    least, most = np.minimum.reduceat, np.maximum.reduceat
    return np.stack([at[first], most(end, first), shift[first], least(c0, first), most(c1, first), least(k_c0, first), most(k_c1, first)], axis=1), order[first]


def _clusters(more_than: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by document; one document's hits are held at a time."""
        key, held = None, []
        names = [*KEY, *(f"k_{c}" for c in KEY)]

        def out() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            place, window, k_place, k_window = (table.column(c).to_numpy() for c in ("place", "window", "k_place", "k_window"))
            same = pc.dictionary_encode(pc.binary_join_element_wise(*(table.column(f"k_{c}").cast(pa.string()) for c in KEY), ",")).combine_chunks()
            rows, which = clusters_of(place, window, k_place, k_window, same.indices.to_numpy(), more_than)
            taken = table.select(names).take(pa.array(which))
            return pa.RecordBatch.from_arrays([*(taken.column(c).combine_chunks() for c in names), *(pa.array(rows[:, i]) for i in range(len(_CLUSTER)))], [*names, *_CLUSTER])

        for batch in batches:
            if not batch.num_rows:
                continue
            ids, texts = batch.column("an_id").to_numpy(zero_copy_only=False), batch.column("twin").to_numpy()
            flags = batch.column("no_id").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((ids[1:] != ids[:-1]) | (texts[1:] != texts[:-1]) | (flags[1:] != flags[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ids)], strict=True):
                now = (flags[a], ids[a], texts[a])
                if now != key and held:
                    yield out()
                    held = []
                key = now
                held.append(batch.slice(a, b - a))
        if held:
            yield out()

    return run


def runs_of(here: list[bytes], there: list[bytes], at: int, k_at: int) -> list[tuple[int, int]]:
    """Maximal runs [a, b) of words of here that equal those of there, word ``at`` standing against ``k_at``."""
    back = min(at, k_at)
    left, right = here[at - back :], there[k_at - back :]
    n = min(len(left), len(right))
    equal = np.concatenate(([False], np.fromiter(map(bytes.__eq__, left[:n], right[:n]), dtype=bool, count=n), [False]))
    edges = np.flatnonzero(equal[1:] != equal[:-1]) + at - back
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def _compare(more_than: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, spans = [], []
            given = zip(*(batch.column(c).to_pylist() for c in ("first", "last", "shift", "c0", "k_c0", "here", "there")), strict=True)
            for i, (first, last, shift, c0, k_c0, here, there) in enumerate(given):
                w, k = Words(here), Words(there)
                # Both slices begin with the word that is REACH before the cluster, or with the first.
                from_word, k_from = max(0, first - REACH), max(0, first + shift - REACH)
                for a, b in runs_of(w.words, k.words, first - from_word, first + shift - k_from):
                    if b - a > more_than and a + from_word < last and b + from_word > first:
                        at = a + from_word + shift - k_from
                        rows.append(i)
                        spans.append((c0 + int(w.starts[a]), c0 + int(w.ends[b - 1]), b - a, k_c0 + int(k.starts[at])))
            numbers = np.array(spans, dtype=np.int64).reshape(-1, 4)
            names = [*KEY, *(f"k_{c}" for c in KEY)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(rows, pa.int64())) for c in names), *(pa.array(numbers[:, j]) for j in range(4))], [*names, "start", "end", "words", "keep_start"])

    return run


def _id(no_id: str, an_id: str):
    return F.when(~F.col(no_id), F.col(an_id))


def spans(docs: DataFrame, *, more_than: int = MORE_THAN) -> DataFrame:
    """(no_id, an_id, twin, start, end, words, k_..., keep_start): a row for each span to remove."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    keys = f"no_id boolean, an_id {id_type}, twin int, k_no_id boolean, k_an_id {id_type}, k_twin int"
    # A slice that can't be null leaves both readers of the units with one and the same exchange.
    cell = ["digest", "slice"]
    dealt = units(docs).withColumn("slice", F.coalesce(F.pmod(F.xxhash64("an_id", "twin"), F.lit(SLICES)).cast("int"), F.lit(0))).repartition(*cell)
    here = F.struct(*KEY, "place", "window")
    heads = dealt.groupBy(*cell).agg(F.min(here).alias("k"), F.count(F.lit(1)).alias("many"))
    over = Window.partitionBy("digest")
    firsts = heads.select(*cell, F.min("k").over(over).alias("k"), F.sum("many").over(over).alias("many")).where("many > 1").select(*cell, "k")
    hits = dealt.join(firsts, cell).where(here != F.col("k")).select(*KEY, "place", "window", *(F.col(f"k.{c}").alias(f"k_{c}") for c in [*KEY, "place", "window"]))
    sorted_hits = hits.repartition(*KEY).sortWithinPartitions(*KEY)
    groups = checkpoint(sorted_hits.mapInArrow(_clusters(more_than), keys + "".join(f", {c} long" for c in _CLUSTER)))
    texts = docs.select(*key_columns(docs), "text").where(F.col("text").isNotNull())
    cut = lambda c0, c1: F.substring("text", (F.col(c0) + 1).cast("int"), (F.col(c1) - F.col(c0)).cast("int"))
    with_own = groups.join(texts, KEY).withColumn("here", cut("c0", "c1")).drop("text")
    kept = texts.select(*(F.col(c).alias(f"k_{c}") for c in KEY), "text")
    both = with_own.join(kept, [f"k_{c}" for c in KEY]).withColumn("there", cut("k_c0", "k_c1")).drop("text")
    compared = both.mapInArrow(_compare(more_than), f"{keys}, start long, end long, words long, keep_start long")
    return compared.distinct()


def repeats(docs: DataFrame, *, more_than: int = MORE_THAN) -> DataFrame:
    """(doc_id, start, end, words, keep_doc_id, keep_start): a row for each span to remove."""
    found = spans(docs, more_than=more_than)
    return found.select(_id("no_id", "an_id").alias("doc_id"), "start", "end", "words", _id("k_no_id", "k_an_id").alias("keep_doc_id"), "keep_start")


def without_repeats(docs: DataFrame, *, more_than: int = MORE_THAN) -> DataFrame:
    """docs with the repeated spans cut out of their texts."""
    cuts = spans(docs, more_than=more_than).groupBy(*KEY).agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("cuts"))
    joined = docs.select(F.struct(*columns_of(docs)).alias("row"), *key_columns(docs)).join(cuts, KEY, "left")
    text = F.col("row.text")
    piece = lambda a, b: F.substring(text, (a + 1).cast("int"), F.greatest(b - a, F.lit(0)).cast("int"))
    kept = F.aggregate(
        "cuts",
        F.struct(F.lit("").alias("text"), F.lit(0).cast("long").alias("at")),
        lambda a, c: F.struct(F.concat(a["text"], piece(a["at"], c["start"])).alias("text"), F.greatest(a["at"], c["end"]).alias("at")),
        lambda a: F.concat(a["text"], piece(a["at"], F.char_length(text).cast("long"))),
    )
    return unpack(joined.select(F.col("row").withField("text", F.when(F.col("cuts").isNull(), text).otherwise(kept)).alias("row")))
