"""Exact top-k search by term-at-a-time accumulation.

Rows are packed into blocks. A block of candidates keeps a posting list for each dimension: the rows
with a non-zero weight there, and the weights. A block of queries runs over the dimensions; each query
with a non-zero weight scatters it, times the posting list, into its dense array of scores. The k best
of a block are found by partition selection, and blocks merge by rank. Scores are exact integers.

Blocks of candidates are dealt over lanes and every block of queries visits every lane, so a task holds
one block of each at a time. Nothing is broadcast.

Defined results: vectors that are null, or hold a null or a component that is not finite, take no part;
nor do rows without an id. Vectors may differ in length; missing components are zero. A candidate
with the query's own id is the query's own row. Query rows equal in id and weights answer once; different
ones of one id have a ranking each, told apart by query_no, in the order of their weights. Repeated
candidate rows are candidates of their own. Scores must fit a long, else the run ends with an error rather than a
wrong score. Extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCALE = 256
CANDIDATES = 2048
QUERIES = 256
#: A posting list of more than this share of a block is kept dense, without row numbers.
DENSE = 0.5


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def weights(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def _pack(rows: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                ids = part.column("id").to_numpy(zero_copy_only=False)
                w = part.column("w")
                lengths = w.value_lengths().to_numpy(zero_copy_only=False)
                flat = w.flatten().to_numpy(zero_copy_only=False)
                dims = int(lengths.max(initial=0))
                m = np.zeros((len(ids), dims), dtype=np.int64)
                m[np.repeat(np.arange(len(ids)), lengths), np.concatenate([np.arange(n) for n in lengths])] = flat
                order = np.argsort(ids, kind="stable")
                nos = part.column("no").to_numpy(zero_copy_only=False).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([x[order].tobytes()], pa.binary()) for x in (ids, nos, m)] + [pa.array([int(ids[0])], pa.int64())], ["ids", "nos", "m", "seed"])

    return run


def packed(vectors: DataFrame, rows: int) -> DataFrame:
    """(ids, nos, m, seed): blocks of at most so many rows (id, no, w), sorted by id."""
    return vectors.mapInArrow(_pack(rows), "ids binary, nos binary, m binary, seed long")


def accumulate(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Dense scores of all queries against a block, one term at a time."""
    dims = min(queries.shape[1], candidates.shape[1])
    bound = float(np.abs(queries).max(initial=0)) * float(np.abs(candidates).max(initial=0)) * max(1, dims)
    if bound >= 2**62:
        raise OverflowError("inner products may not fit a long")
    kind = np.int32 if bound < 2**30 else np.int64
    terms, scores = np.ascontiguousarray(candidates.T.astype(kind)), np.zeros((len(queries), len(candidates)), dtype=kind)
    queries, spare = queries.astype(kind), np.empty((len(queries), len(candidates)), dtype=kind)
    for t in range(dims):
        asking = np.flatnonzero(queries[:, t])
        listed = np.flatnonzero(terms[t])
        if not len(asking) or not len(listed):
            continue
        if len(listed) <= DENSE * len(candidates):
            scores[np.ix_(asking, listed)] += queries[asking, t][:, None] * terms[t, listed][None, :]
        elif len(asking) == len(queries):
            np.multiply(queries[:, t][:, None], terms[t][None, :], out=spare)
            scores += spare
        else:
            scores[asking] += queries[asking, t][:, None] * terms[t][None, :]
    return scores


def select_best(scores: np.ndarray, query_ids: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query row, column) of each query's k best, ties to the smaller id; ids ascend.

    Partition selection finds the k-th score; what exceeds it is in, and of what equals it the first columns.
    """
    own = query_ids[:, None] == ids[None, :]
    scores = np.where(own, np.iinfo(scores.dtype).min, scores)
    k = min(k, len(ids))
    least = np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k, None]
    over, even = scores > least, scores == least
    room = k - over.sum(axis=1, keepdims=True)
    return np.nonzero((over | (even & (np.cumsum(even, axis=1) <= room))) & ~own)


def _search(k: int):
    def matrix(ids: bytes, m: bytes) -> tuple[np.ndarray, np.ndarray]:
        i = np.frombuffer(ids, dtype=np.int64)
        return i, np.frombuffer(m, dtype=np.int64).reshape(len(i), -1)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q_ids, q_nos, q_m, c_ids, c_m in zip(*(batch.column(c).to_pylist() for c in ("q_ids", "q_nos", "q_m", "ids", "m")), strict=True):
                qi, q = matrix(q_ids, q_m)
                ci, c = matrix(c_ids, c_m)
                scores = accumulate(q, c)
                rows, cols = select_best(scores, qi, ci, k)
                numbers = np.frombuffer(q_nos, dtype=np.int64)[rows]
                yield pa.RecordBatch.from_arrays([pa.array(qi[rows]), pa.array(numbers), pa.array(ci[cols]), pa.array(scores[rows, cols].astype(np.int64))], ["query_id", "query_no", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, *, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, scale: int = SCALE, lanes: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score, query_no): the k highest inner products of each query row."""
    spark = vectors.sparkSession
    lanes = lanes or int(spark.conf.get("spark.sql.shuffle.partitions"))
    clean = vectors.where(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
    rows = clean.select(F.col(id_col).cast("long").alias("id"), F.lit(0).alias("no"), weights(F.col(vector_col), scale).alias("w"))
    asked = clean.where(is_query).select(F.col(id_col).cast("long").alias("id"), weights(F.col(vector_col), scale).alias("w")).distinct()
    asked = asked.select("id", (F.row_number().over(Window.partitionBy("id").orderBy("w")) - 1).alias("no"), "w")
    lane = F.pmod(F.xxhash64("seed"), F.lit(lanes)).cast("int")
    blocks = packed(rows, CANDIDATES).select("ids", "m", lane.alias("lane"))
    queries = packed(asked, QUERIES).select(F.col("ids").alias("q_ids"), F.col("nos").alias("q_nos"), F.col("m").alias("q_m"), F.explode(F.expr(f"sequence(0, {lanes - 1})")).alias("lane"))
    pairs = blocks.hint("merge").join(queries, "lane").select("q_ids", "q_nos", "q_m", "ids", "m")
    found = pairs.mapInArrow(_search(k), "query_id long, query_no long, vec_id long, score long")
    best = Window.partitionBy("query_id", "query_no").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", "query_no")
