"""Exact dedup by composable polynomial fingerprints and chunkwise comparison.

A text's bytes are cut into chunks, a row each, and those after the first are dealt out, so that the chunks of a
huge document are hashed in parallel. Hashes of neighbours combine by h(a + b) = h(a) * base^len(b) + h(b),
modulo a prime: each chunk's hash is shifted by the bytes behind it, and a document's is a plain sum.
Four bases make the 124-bit fingerprint.

Texts of equal fingerprint and length are then compared with the one of the largest doc_id, the leader, as
streams of chunks, so a collision can never merge two texts; those that differ from their leader get a
leader of their own, until none differs. Only suspects' texts are shuffled: a Bloom filter of fixed size
leaves out the others (where suspects are so many that it fills up, it lets more pass, and the result is the same).

A group of copies is spread over ``SLICES`` tasks where it is counted, and cut into salts of
``SALT_ROWS`` documents, each with the leader's text, where it is compared. No task needs a whole group.

Defined results: a null text counts as empty. A null doc_id is smaller than any other. Rows equal in
doc_id and text are copies of each other: all count in group_size, one of them is kept.
Extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstone.llm.common import checkpoint, perhaps, tabled

CHUNK = 1 << 16
SALT_ROWS = 96
SLICES = 64
#: The prime and the four bases.
PRIME = (1 << 31) - 1
BASES = (1103515245, 1220703125, 1664525021, 1812433253)


def _powers(n: int) -> np.ndarray:
    """base^(n-1) ... base^0 for each base, as a column each."""
    out = np.ones((n, len(BASES)), dtype=np.uint64)
    base = np.array(BASES, dtype=np.uint64)
    for i in range(n - 2, -1, -1):
        out[i] = out[i + 1] * base % PRIME
    return out


_POWERS: list[np.ndarray] = []


def powers() -> np.ndarray:
    if not _POWERS:
        _POWERS.append(_powers(CHUNK))
    return _POWERS[0]


def hash_chunk(data: bytes | memoryview) -> tuple[int, ...]:
    """The polynomial hashes of at most ``CHUNK`` bytes; a byte counts as its value plus one."""
    part = np.frombuffer(data, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    if not len(part):
        return (0,) * len(BASES)
    table = powers()[CHUNK - len(part) :]
    return tuple(int(x) % PRIME for x in part @ table)


def combine(left: tuple[int, ...], right: tuple[int, ...], right_bytes: int) -> tuple[int, ...]:
    """The hashes of a + b from those of a and b and the length of b."""
    return tuple((x * pow(base, right_bytes, PRIME) + y) % PRIME for x, y, base in zip(left, right, BASES, strict=True))


def fingerprint(data: bytes) -> tuple[int, int]:
    """Two 62-bit numbers for a text of any length: the sum of its chunks' shifted hashes."""
    total = [0] * len(BASES)
    for at in range(0, len(data), CHUNK):
        part = data[at : at + CHUNK]
        total = [(x + y) % PRIME for x, y in zip(total, combine(hash_chunk(part), (0,) * len(BASES), len(data) - at - len(part)), strict=True)]
    return total[0] << 31 | total[1], total[2] << 31 | total[3]


ROW = ["no_id", "an_id", "sha"]
KEY = ["fa", "fb", "n_bytes"]


def _hash(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each chunk's hashes, shifted by the bytes behind it."""
    for batch in batches:
        shifted = [combine(hash_chunk(x.as_buffer()), (0,) * len(BASES), behind) for x, behind in zip(batch.column("chunk"), batch.column("behind").to_pylist(), strict=True)]
        hashes = np.array(shifted, dtype=np.int64).reshape(-1, len(BASES))
        names = [*ROW, "n_bytes", "nth"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *(pa.array(hashes[:, i]) for i in range(len(BASES)))], [*names, *(f"h{i}" for i in range(len(BASES)))])


def _bytes(docs: DataFrame) -> DataFrame:
    """no_id, an_id, sha, which tell rows of different id or text apart; n_bytes and the bytes."""
    data = F.coalesce("text", F.lit("")).cast("binary")
    an_id = F.coalesce("doc_id", F.lit(0).cast(docs.schema["doc_id"].dataType))
    return docs.select(F.col("doc_id").isNull().alias("no_id"), an_id.alias("an_id"), F.unhex(F.sha2(data, 256)).alias("sha"), F.octet_length(data).cast("long").alias("n_bytes"), data.alias("data"))


def _chunks(first: int) -> Column:
    """An array of (nth, behind, chunk) from chunk ``first`` on; a text without bytes has one empty chunk."""
    last = F.greatest(F.expr(f"(n_bytes - 1) div {CHUNK}"), F.lit(0)).cast("int")
    numbers = F.sequence(F.lit(first), last) if not first else F.when(last >= first, F.sequence(F.lit(first), F.greatest(last, F.lit(first)))).otherwise(F.expr("cast(array() as array<int>)"))
    return F.transform(numbers, lambda i: F.named_struct(F.lit("nth"), i, F.lit("behind"), F.greatest(F.col("n_bytes") - (i + 1) * CHUNK, F.lit(0)).cast("long"), F.lit("chunk"), F.substring("data", i * CHUNK + 1, F.lit(CHUNK))))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(no_id, an_id, sha, fa, fb, n_bytes, copies): a row for each distinct doc_id and text."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = _bytes(docs)
    flat = [*ROW, "n_bytes", "c.nth", "c.behind", "c.chunk"]
    heads = rows.select(*ROW, "n_bytes", F.lit(0).alias("nth"), F.greatest(F.col("n_bytes") - CHUNK, F.lit(0)).alias("behind"), F.substring("data", F.lit(1), F.lit(CHUNK)).alias("chunk"))
    rest = rows.where(F.col("n_bytes") > CHUNK).select(*ROW, "n_bytes", F.explode(_chunks(1)).alias("c")).select(*flat).repartition("sha", "nth")
    schema = f"no_id boolean, an_id {id_type}, sha binary, n_bytes long, nth int, " + ", ".join(f"h{i} long" for i in range(len(BASES)))
    hashed = heads.unionByName(rest).mapInArrow(_hash, schema)
    once = hashed.groupBy(*ROW, "n_bytes", "nth").agg(*(F.max(f"h{i}").alias(f"h{i}") for i in range(len(BASES))), F.count(F.lit(1)).alias("copies"))
    whole = once.groupBy(*ROW, "n_bytes").agg(*((F.sum(f"h{i}") % PRIME).alias(f"h{i}") for i in range(len(BASES))), F.max("copies").alias("copies"))
    pair = lambda a, b: F.shiftleft(F.col(a), 31).bitwiseOR(F.col(b))
    return whole.select(*ROW, pair("h0", "h1").alias("fa"), pair("h2", "h3").alias("fb"), "n_bytes", "copies")


def grouped(marks: DataFrame, by: list[str]) -> DataFrame:
    """The columns of marks, and of its group: leader (has_id, an_id, sha), members and group_size.

    Counted within slices first; what is dealt out is read twice from one exchange.
    """
    slice_of = F.coalesce(F.pmod(F.xxhash64("an_id", "sha"), F.lit(SLICES)).cast("int"), F.lit(0))
    cell = [*by, "slice"]
    dealt = marks.withColumn("slice", slice_of).repartition(*cell)
    here = F.struct((~F.col("no_id")).alias("has_id"), "an_id", "sha")
    heads = dealt.groupBy(*cell).agg(F.max(here).alias("leader"), F.count(F.lit(1)).alias("members"), F.sum("copies").alias("group_size"))
    over = Window.partitionBy(*by)
    whole = heads.select(*cell, F.max("leader").over(over).alias("leader"), F.sum("members").over(over).alias("members"), F.sum("group_size").over(over).alias("group_size"))
    return dealt.join(whole, cell).drop("slice")


def _compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams of chunks sorted by salt, chunk and role, the leader's first; yields the rows that differ from it."""
    at, leader = None, b""
    for batch in batches:
        rows = []
        keys = zip(*(batch.column(c).to_pylist() for c in [*KEY, "class", "salt", "nth", "role"]), batch.column("chunk"), strict=True)
        for i, (*place, role, chunk) in enumerate(keys):
            # Not as a view: its bytes would be signed, and never equal to others beyond ASCII.
            data = chunk.as_buffer().to_pybytes()
            if role == 0:
                at, leader = place, data
            elif at != place or data != leader:
                rows.append(i)
        yield batch.take(pa.array(rows, pa.int64())).select(ROW)


def differing(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """no_id, an_id, sha of the rows of marks (with class) whose text isn't their leader's."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    by = [*KEY, "class"]
    suspects = tabled(grouped(marks, by).where("members > 1").select(*ROW, *KEY, "class", "leader", F.expr(f"cast((members + {SALT_ROWS - 1}) div {SALT_ROWS} as int)").alias("salts")))
    texts = perhaps(_bytes(docs).drop("n_bytes"), suspects, ROW)
    found = texts.join(suspects, ROW)
    leads = F.struct((~F.col("no_id")).alias("has_id"), "an_id", "sha") == F.col("leader")
    salt = F.pmod(F.xxhash64(*ROW), F.col("salts")).cast("int")
    dealt = F.when(leads, F.transform(F.expr("sequence(0, salts - 1)"), lambda x: F.named_struct(F.lit("salt"), x, F.lit("role"), F.lit(0)))).otherwise(F.array(F.named_struct(F.lit("salt"), salt, F.lit("role"), F.lit(1))))
    rows = found.select(*ROW, *by, F.explode(dealt).alias("d"), _chunks(0).alias("chunks")).select(*ROW, *by, "d.*", F.explode("chunks").alias("c")).select(*ROW, *by, "salt", "role", "c.nth", "c.chunk")
    stream = rows.repartition(*by, "salt").sortWithinPartitions(*by, "salt", "nth", "role")
    return stream.mapInArrow(_compare, f"no_id boolean, an_id {id_type}, sha binary").distinct()


def exact_classes(docs: DataFrame) -> DataFrame:
    """(no_id, an_id, sha, fa, fb, n_bytes, copies, class): a row for each distinct doc_id and text.

    Texts are equal exactly where fa, fb, n_bytes and class are. copies: how often the row occurs.
    """
    marks = checkpoint(fingerprints(docs)).withColumn("class", F.lit(0))
    todo, of_class = marks, 0
    while True:
        others = checkpoint(differing(docs, todo))
        if others.isEmpty():
            return marks
        of_class += 1
        marks = checkpoint(marks.join(others.withColumn("other", F.lit(True)), ROW, "left").withColumn("class", F.when(F.col("other"), F.lit(of_class)).otherwise(F.col("class"))).drop("other"))
        todo = marks.where(F.col("class") == of_class)


def exact_dedup(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row; the largest doc_id stays."""
    found = grouped(exact_classes(docs), [*KEY, "class"])
    leads = F.struct((~F.col("no_id")).alias("has_id"), "an_id", "sha") == F.col("leader")
    rows = found.withColumn("leads", leads).select("*", F.explode(F.expr("sequence(1L, copies)")).alias("nth"))
    return rows.select(
        F.when(~F.col("no_id"), F.col("an_id")).alias("doc_id"),
        F.when(F.col("leader.has_id"), F.col("leader.an_id")).alias("keep_id"),
        "group_size",
        (F.col("leads") & (F.col("nth") == 1)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
