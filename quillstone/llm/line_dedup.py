"""Line dedup: hash ranges, secondary sort, first occurrences, keep bitmaps. DataFrame functions only.

Every line gets a 128-bit key hash. Lines are dealt out by ranges of (hash, slice), where the slice comes from
the row, so that ranges can part a line which a third of all documents hold. Within a slice, rows are sorted by
document and position and the first occurrence in each document streams on; documents are then counted
by key, pre-aggregated. The verdicts are joined with the hashes of the lines and become one bitmap a row;
no text takes part in any of this.

Defined results: a null or empty text is one empty line. Documents are told apart by doc_id: rows that share
it are one document, each with a row in the result, and keep or lose a line together; rows without one are one
document, smaller than any other. Extra columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstone.llm.common import WHITE, ascii_lower, columns_of, unpack

SLICES = 64


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_keys(lines: Column) -> Column:
    """The key of each line; a line is trimmed once, whatever the choice of lower-casing asks of it."""
    trimmed = F.transform(lines, lambda x: F.btrim(x, F.lit(WHITE)))
    return F.transform(trimmed, ascii_lower)


def keyed_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, row_hash, pos, h1, h2, slice) of the lines that can be dropped.

    An outer explode works the keys out once, a plain one would once more to see whether there are any.
    """
    row_hash = F.xxhash64("doc_id", "text")
    return (
        docs.select("doc_id", row_hash.alias("row_hash"), F.posexplode_outer(line_keys(lines_of(F.col("text")))).alias("pos", "key"))
        .where(F.char_length("key") >= min_chars)
        .select(
            "doc_id",
            "row_hash",
            F.coalesce("pos", F.lit(0)).alias("pos"),
            F.xxhash64("key").alias("h1"),
            F.xxhash64(F.lit(1), "key").alias("h2"),
            F.coalesce(F.pmod("row_hash", F.lit(SLICES)).cast("int"), F.lit(0)).alias("slice"),
        )
    )


def keep_bitmaps(docs: DataFrame, *, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(doc_id, row_hash, n_dropped, words) for each document that loses lines.

    ``words`` is the compressed keep bitmap: pairs (word, bits) of 64 lines each, a bit set for a
    line that stays; a word without a dropped line is left out and stands for all ones.
    """
    dealt = keyed_lines(docs.select("doc_id", "text"), min_chars).repartitionByRange("h1", "h2", "slice")
    key = ["h1", "h2"]
    w = Window.partitionBy(*key, "slice").orderBy(F.desc_nulls_last("doc_id"), F.col("row_hash"), F.col("pos"))
    here = F.struct("doc_id")
    firsts = dealt.withColumn("before", F.lag(here).over(w)).where(~F.col("before").eqNullSafe(here))
    holders = firsts.groupBy(*key, "doc_id").agg(F.bit_or(F.expr("shiftleft(1L, slice)")).alias("slices"))
    counted = holders.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keep_id"), F.bit_or("slices").alias("slices")).where(F.col("n") >= min_docs)
    # A verdict goes to the slices that hold its key, so that no join meets all lines of a key in one task.
    verdicts = counted.select(*key, "keep_id", F.explode(F.filter(F.sequence(F.lit(0), F.lit(SLICES - 1)), lambda i: F.getbit(F.col("slices"), i) == 1)).alias("slice"))
    dropped = dealt.join(verdicts, [*key, "slice"]).where(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
    bit = F.expr("shiftleft(1L, pos % 64)")
    return (
        dropped.groupBy("doc_id", "row_hash", F.expr("pos div 64").cast("int").alias("word"))
        .agg(F.bit_or(bit).alias("gone"))
        .groupBy("doc_id", "row_hash")
        .agg(F.sum(F.bit_count("gone")).alias("n_dropped"), F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("gone").alias("bits")))).alias("words"))
    )


def kept_lines(lines: Column, words: Column) -> Column:
    """The lines whose bit is set in the bitmap ``words``."""
    by_word = F.map_from_entries(words)
    dense = F.transform(F.sequence(F.lit(0), F.expr("(size(lines) - 1) div 64").cast("int")), lambda i: F.coalesce(F.try_element_at(by_word, i), F.lit(-1).cast("bigint")))
    return F.transform(
        F.filter(
            F.arrays_zip(lines.alias("line"), F.flatten(F.transform(dense, lambda bits: F.transform(F.sequence(F.lit(0), F.lit(63)), lambda j: F.getbit(bits, j)))).alias("bit")),
            lambda x: (x["bit"] == 1) & x["line"].isNotNull(),
        ),
        lambda x: x["line"],
    )


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """(row, n_lines, n_dropped, kept): each row of docs with its text after the drop."""
    bitmaps = bitmaps.select(F.col("doc_id").alias("b_doc"), F.col("row_hash").alias("b_hash"), "n_dropped", "words")
    rows = docs.select(F.struct(*columns_of(docs)).alias("row")).withColumn("row_hash", F.xxhash64("row.doc_id", "row.text"))
    joined = rows.join(bitmaps, F.col("row.doc_id").eqNullSafe(F.col("b_doc")) & (F.col("row_hash") == F.col("b_hash")), "left")
    lines = joined.withColumn("lines", lines_of(F.col("row.text")))
    kept = F.when(F.col("words").isNull(), F.coalesce("row.text", F.lit(""))).otherwise(F.array_join(kept_lines(F.col("lines"), F.col("words")), "\n"))
    return lines.select("row", F.size("lines").cast("bigint").alias("n_lines"), F.coalesce("n_dropped", F.lit(0)).cast("bigint").alias("n_dropped"), kept.alias("kept"))


def dedup_lines(docs: DataFrame, *, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(row, n_lines, n_dropped, kept) of every document."""
    return apply_bitmaps(docs, keep_bitmaps(docs, min_chars=min_chars, min_docs=min_docs))


def dedup_documents(docs: DataFrame, **limits: int) -> DataFrame:
    """docs with the kept lines for text (and n_chars, where there is one, to match)."""
    found = dedup_lines(docs, **limits)
    row = F.col("row").withField("text", F.when(F.col("row.text").isNull(), F.lit(None)).otherwise(F.col("kept")))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.when(F.col("n_dropped") == 0, F.col("row.n_chars")).otherwise(F.char_length("kept").cast(docs.schema["n_chars"].dataType)))
    return unpack(found.select(row.alias("row")))
