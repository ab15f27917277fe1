"""Mixture-controlled packing by deficit round-robin.

Documents are dealt by hash into parts of about ``PART_BYTES``. In a part each source has a queue of
tokenised documents. A window of ``length`` tokens is filled by visiting the sources in turn: every
window adds the source's share of it to the source's deficit, and a source is served, ``grain`` tokens
at a time and no more than it has, as long as its deficit allows. Where no source with tokens may be served, the one
with the largest deficit is. Deficits are the tokens due less the tokens given, neither bounded nor reset, and
carry from window to window. Into a part carries, in equal amounts over its windows, what all parts before it had
too little or too much of, source by source: sums over parts, within lanes first and then over lanes, of bytes of text, which a
part turns into tokens at the source's rate in its first texts (counting tokens instead would tokenise all texts twice).
Windows are written as soon as enough tokens wait, so a part's queues stay small whatever it holds.

The end of a part is packed into sequences of a power of two of tokens, which are not padded, so that
there is no padding at all.

Defined results: a null text is empty and has the end token only. A null source is a source. Rows are
packed in the order of (hash, doc_id); rows equal in doc_id and text are packed each by itself. A source that
``weights`` doesn't name has no share, and is packed where others lack tokens. Extra columns are not looked at.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstone.llm.common import checkpoint, tabled, trimmed
from quillstone.llm.tokens import encoder

LENGTH = 4096
GRAIN = 256
END_ID = 2
PART_BYTES = 8 << 20
#: Bins that documents are counted in, and so the most parts; parts that are summed together first.
BINS = 1 << 20
LANE = 1024
#: Windows of tokens that wait before one is written, and texts that are tokenised at a time.
WAITING = 48
BATCH_CHARS = 1 << 21


class Packer:
    """Fills the windows of one part. Pieces are (document, start, ids, sequence, offset)."""

    def __init__(self, shares: dict, carried: dict, *, windows: int = 1, length: int = LENGTH, grain: int = GRAIN):
        self.shares, self.length, self.grain = shares, length, grain
        self.deficits, self.carried, self.windows = dict.fromkeys(shares, 0.0), carried, windows
        self.order = list(shares)
        self.queues = {s: deque() for s in shares}
        self.held = dict.fromkeys(shares, 0)
        self.total = self.sequence = self.turn = 0

    def add(self, source, document, ids: bytes) -> None:
        self.queues[source].append([document, ids, 0])
        self.held[source] += len(ids) >> 2
        self.total += len(ids) >> 2

    def _serve(self, source, most: int, offset: int) -> tuple:
        head = self.queues[source][0]
        document, ids, at = head
        n = min(most, (len(ids) >> 2) - at)
        head[2] = at + n
        if head[2] << 2 == len(ids):
            self.queues[source].popleft()
        self.held[source] -= n
        self.total -= n
        self.deficits[source] -= n
        return document, at, ids[at << 2 : (at + n) << 2], self.sequence, offset

    def window(self, length: int) -> Iterator[tuple]:
        """One sequence of so many tokens, which must be there."""
        filled = 0
        for s in self.order:
            self.deficits[s] += self.shares[s] * length + (self.carried.get(s, 0.0) / self.windows if self.sequence < self.windows else 0.0)
        while filled < length:
            served = False
            for i in range(len(self.order)):
                s = self.order[(self.turn + i) % len(self.order)]
                if filled < length and self.held[s] and self.deficits[s] >= (most := self._next(s, length - filled)):
                    piece = self._serve(s, most, filled)
                    filled += most
                    served = True
                    yield piece
            if not served:
                s = max((s for s in self.order if self.held[s]), key=self.deficits.get)
                most = self._next(s, length - filled)
                piece = self._serve(s, most, filled)
                filled += most
                yield piece
        self.turn = (self.turn + 1) % len(self.order)
        self.sequence += 1

    def _next(self, source, room: int) -> int:
        """Tokens that the source would be served."""
        _, ids, at = self.queues[source][0]
        return min(self.grain, room, (len(ids) >> 2) - at)

    def ready(self) -> Iterator[tuple]:
        while self.total >= WAITING * self.length:
            yield from self.window(self.length)

    def rest(self) -> Iterator[tuple]:
        while self.total >= self.length:
            yield from self.window(self.length)
        while self.total:
            yield from self.window(1 << (self.total.bit_length() - 1))


def _pack(path: str, length: int, grain: int, end_id: int, id_type: pa.DataType):
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        part, shares, deficits, sizes, packer = None, {}, {}, {}, None
        texts, waiting, size = [], [], 0
        out: list[tuple] = []

        def batch() -> pa.RecordBatch:
            nonlocal out
            now, out = out, []
            columns = list(zip(*now, strict=True)) if now else [()] * 8
            kinds = [id_type, pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "source", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

        def emit(pieces: Iterable[tuple]) -> None:
            for (doc_id, source, n), start, ids, sequence, offset in pieces:
                out.append((doc_id, source, start, len(ids) >> 2, n, part << 32 | sequence, offset, ids))

        def tokenise() -> None:
            nonlocal texts, waiting, size, packer
            if not texts:
                return
            coded = encode(texts)
            if packer is None:
                seen, had = dict.fromkeys(shares, 0), dict.fromkeys(shares, 0)
                for (_, source), text, ids in zip(waiting, texts, coded, strict=True):
                    seen[source] += len(text.encode("utf-8", "surrogatepass")) + 1
                    had[source] += (len(ids) >> 2) + 1
                overall = sum(had.values()) / max(1, sum(seen.values()))
                windows = max(1, round(sum(sizes.values()) * overall / length))
                packer = Packer(shares, {s: d * (had[s] / seen[s] if seen[s] else overall) for s, d in deficits.items()}, windows=windows, length=length, grain=grain)
            for (doc_id, source), ids in zip(waiting, coded, strict=True):
                packer.add(source, (doc_id, source, (len(ids) >> 2) + 1), ids + end)
                emit(packer.ready())
            texts, waiting, size = [], [], 0

        def finish() -> None:
            nonlocal packer
            tokenise()
            if packer is not None:
                emit(packer.rest())
            packer = None

        for b in batches:
            for p, source, doc_id, text, share, deficit, held in zip(*(b.column(c).to_pylist() for c in ("part", "source", "doc_id", "text", "share", "deficit", "bytes")), strict=True):
                if p != part:
                    finish()
                    part, shares, deficits, sizes = p, {}, {}, {}
                if share is not None:
                    shares[source], deficits[source], sizes[source] = share, deficit, held
                    continue
                texts.append(text)
                waiting.append((doc_id, source))
                size += len(text)
                if size >= BATCH_CHARS:
                    tokenise()
                    if len(out) >= 2000:
                        yield batch()
            if out:
                yield batch()
        finish()
        encoder(path).forget()
        if out:
            yield batch()

    return run


def pack(docs: DataFrame, *, tokenizer: str, weights: dict | None = None, length: int = LENGTH, grain: int = GRAIN, end_id: int = END_ID) -> DataFrame:
    """(doc_id, source, start, length, doc_tokens, sequence_id, offset, ids): a row for each piece.

    ids: the piece's token ids as little-endian unsigned 32-bit numbers. weights: the target proportions
    by source; by default those of the documents themselves.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = docs.schema["doc_id"].dataType
    text = F.coalesce("text", F.lit(""))
    draw = F.xxhash64("doc_id", text)
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), text.alias("text"), draw.alias("draw"))
    bins = checkpoint(rows.groupBy(F.pmod("draw", F.lit(BINS)).alias("bin"), "source").agg(F.sum(F.octet_length("text") + 1).alias("bytes")))
    total = bins.agg(F.sum("bytes")).first()[0] or 0
    parts = max(1, min(BINS, -(-total // PART_BYTES)))
    part = lambda x: F.shiftright(x * parts, BINS.bit_length() - 1)
    held = bins.groupBy(part(F.col("bin")).alias("part"), "source").agg(F.sum("bytes").alias("bytes"))
    of_source = bins.groupBy("source").agg(F.sum("bytes").alias("supply"))
    if weights is None:
        share = F.col("supply") / F.lit(float(max(1, total)))
    else:
        whole = float(sum(weights.values()))
        share = F.lit(0.0)
        for name, weight in weights.items():
            share = F.when(F.col("source").eqNullSafe(F.lit(name).cast("string")), F.lit(weight / whole)).otherwise(share)
    of_source = tabled(of_source.select(F.col("source").alias("s_source"), "supply", share.alias("share")))
    lane = F.expr(f"part div {LANE}")
    in_order = lambda *by: Window.partitionBy("source", *by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    lanes = held.groupBy("source", lane.alias("part")).agg(F.sum("bytes").alias("bytes"))
    lanes = lanes.select(F.col("source").alias("l_source"), F.col("part").alias("lane"), F.coalesce(F.sum("bytes").over(in_order()), F.lit(0)).alias("lanes_before"))
    in_lane = held.withColumn("lane", lane).withColumn("before", F.coalesce(F.sum("bytes").over(in_order("lane")), F.lit(0)))
    placed = in_lane.join(lanes.withColumnRenamed("lane", "l_lane"), F.col("source").eqNullSafe(F.col("l_source")) & (F.col("lane") == F.col("l_lane")))
    lacked = F.col("supply") * F.col("part") / F.lit(float(parts)) - F.col("before") - F.col("lanes_before")
    heads = placed.join(of_source, F.col("source").eqNullSafe(F.col("s_source"))).select(
        "part", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("draw"), "source", F.lit(None).cast(id_type).alias("doc_id"), F.lit(None).cast("string").alias("text"), "share", lacked.alias("deficit"), "bytes"
    )
    body = rows.select(part(F.pmod("draw", F.lit(BINS))).alias("part"), F.lit(1).alias("kind"), "draw", "source", "doc_id", "text", F.lit(None).cast("double").alias("share"), F.lit(None).cast("double").alias("deficit"), F.lit(None).cast("long").alias("bytes"))
    dealt = heads.unionByName(body).repartition("part").sortWithinPartitions("part", "kind", "draw", "doc_id", "source")
    schema = f"doc_id {id_type.simpleString()}, source string, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    return dealt.select("part", "source", "doc_id", "text", "share", "deficit", "bytes").mapInArrow(trimmed(_pack(tokenizer, length, grain, end_id, to_arrow_type(id_type))), schema)


def with_checksums(pieces: DataFrame) -> DataFrame:
    """The pieces with the crc32 of their ids in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source")
