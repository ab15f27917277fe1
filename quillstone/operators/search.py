"""Full-text, vector, hybrid and fuzzy search as functions from DataFrames to ranked DataFrames.

Ranking is BM25 over lower-cased words, plain or by their stems. Vector search is exact. A query of fixed
size stands in the plan as a literal, so searches are one scan with partial top-k.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstone.functions.text import trigram_sim

K1, B = 1.2, 0.75
POOL = 60
STATEMENTS = 1000
#: So many ids are broadcast at most.
SHARED = 1 << 18


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def term_counts(w: Column) -> Column:
    """(term, tf, length) of each distinct word, in order, and one entry without tf after them: the runs of the sorted words."""
    named = lambda value, f: F.transform(F.array(value), f)[0]  # noqa: E731 (worked out once)

    def runs(s: Column) -> Column:
        begins = F.filter(F.sequence(F.lit(0), F.size(s)), lambda i: ~F.get(s, i).eqNullSafe(F.get(s, i - 1)))
        entry = lambda at, i, j: F.struct(F.get(s, i).alias("term"), (F.get(at, j + 1) - i).cast("long").alias("tf"), F.size(s).cast("long").alias("length"))
        return named(begins, lambda at: F.transform(at, lambda i, j: entry(at, i, j)))

    return named(F.sort_array(w), runs)


def tokens(docs: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(id, term, tf, length): the token table, a row for each term of an id.

    Words are counted within their row, without a shuffle. Only where several rows have one id are their counts put
    together: tf is their sum, length that of the longest of them that has the term.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counted = lambda x: x.select("id", F.explode(term_counts(words(F.col("text")))).alias("x")).select("id", "x.*").where("tf is not null")
    shared = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("id").alias("__id"))
    n = shared.count()
    if not n:
        return counted(rows)
    some = F.broadcast(shared) if n <= SHARED else shared
    on = F.col("id").eqNullSafe(F.col("__id"))
    put = counted(rows.join(some, on, "left_semi")).groupBy("id", "term").agg(F.sum("tf").alias("tf"), F.max("length").alias("length"))
    return counted(rows.join(some, on, "left_anti")).unionByName(put)


@dataclass
class Query:
    """What a web-style query asks: alternatives of (words and phrases that must occur), and what must not."""

    any_of: list[list[tuple[str, ...]]] = field(default_factory=list)
    none_of: list[tuple[str, ...]] = field(default_factory=list)

    @property
    def terms(self) -> list[str]:
        return sorted({w for group in self.any_of for phrase in group for w in phrase})


def parse_query(text: str) -> Query:
    """AND of words, "phrases", ``or`` between them, ``-`` before what must not occur."""
    out, group, either = Query(), [], False
    for minus, phrase, word in re.findall(r'(-?)(?:"([^"]*)"|(\S+))', text):
        if not phrase and not minus and word.lower() == "or":
            either = bool(group)
            continue
        parts = tuple(x for x in re.split(r"[^\w]+|_", (phrase or word).lower()) if x)
        if not parts:
            continue
        if minus:
            out.none_of.append(parts)
        elif either:
            out.any_of.append(group)
            group, either = [parts], False
        else:
            group.append(parts)
    if group:
        out.any_of.append(group)
    return out


#: The first step of Porter's stemmer as replacements, one after another, in patterns that any engine knows.
STEMS = (
    ("sses$", "ss"), ("ies$", "i"), ("([^s])s$", r"\1"), ("^(.*[aeiouy][^aeiouy].*)eed$", r"\1ee"), ("^(.*(?:at|iz)|.*[aeiouy].*bl)(?:ed|ing)$", r"\1e"),
    *((f"^(.*[aeiouy].*{c}){c}(?:ed|ing)$", r"\1") for c in "bdfgmnprt"), ("^(.*[aeiouy].*[^e]|.*[aiouy])ed$", r"\1"), ("^(.*[aeiouy].*)ing$", r"\1"), ("^(.*[aeiouy].*)y$", r"\1i"),
)


def stem_word(word: str) -> str:
    for pattern, by in STEMS:
        word = re.sub(pattern, by, word)
    return word


def stem(word: Column) -> Column:
    for pattern, by in STEMS:
        word = F.regexp_replace(word, pattern, by.replace("\\", "$"))
    return word


def stemmed(query: Query) -> Query:
    return Query([[tuple(map(stem_word, p)) for p in group] for group in query.any_of], [tuple(map(stem_word, p)) for p in query.none_of])


def stems(w: Column, query: Query) -> Column:
    """The words, those that may be forms of the query's stems by their stems.

    A stem begins with its first two letters in every form, so that other words need no patterns.
    """
    heads = sorted({t[:2] for t in [*query.terms, *(x for p in query.none_of for x in p)]})
    return F.transform(w, lambda x: F.when(F.left(x, F.lit(2)).isin(*heads), stem(x)).otherwise(x)) if heads else w


def has_phrase(w: Column, phrase: tuple[str, ...]) -> Column:
    """The words of a phrase one after another."""
    if len(phrase) == 1:
        return F.array_contains(w, phrase[0])
    joined = F.concat(F.lit(" "), F.array_join(w, " "), F.lit(" "))
    return F.contains(joined, F.lit(f" {' '.join(phrase)} "))


def matches(w: Column, query: Query) -> Column:
    """The boolean test of a query on an array of words."""
    hit = F.lit(not query.any_of and bool(query.none_of))
    for group in query.any_of:
        every = F.lit(True)
        for phrase in group:
            every = every & has_phrase(w, phrase)
        hit = hit | every
    for phrase in query.none_of:
        hit = hit & ~has_phrase(w, phrase)
    return hit


def occurrences(w: Column, term: str) -> Column:
    return F.size(w) - F.size(F.array_remove(w, term))


def likely(text: Column, query: Query) -> Column:
    """Whether a lower-cased text may match: one of the alternatives has (the beginnings of) all of its words in it.

    Far cheaper than taking the text apart; texts without them can't match.
    """
    alternatives = []
    for group in query.any_of:
        every = F.lit(True)
        for term in {t for phrase in group for t in phrase}:
            every = every & F.contains(text, F.lit(term[:-1] if len(term) > 2 else term[:1]))
        alternatives.append(every)
    hit = alternatives[0] if alternatives else F.lit(True)
    for a in alternatives[1:]:
        hit = hit | a
    return hit


def bm25(docs: DataFrame, query: Query, id_col: str = "id", text_col: str = "text", *, by_stem: bool = False) -> DataFrame:
    """(id, score) of the documents that match; statistics cover all documents.

    by_stem: words count as equal if their stems are. The statistics are one row; of the documents only those that may match are taken
    apart a second time.
    """
    query = stemmed(query) if by_stem else query
    terms = query.terms

    def counted(rows: DataFrame) -> DataFrame:
        w = words(F.col(text_col))
        split = rows.select(F.col(id_col).alias("id"), (stems(w, query) if by_stem else w).alias("w"))
        return split.select("id", F.size("w").alias("length"), *[occurrences(F.col("w"), t).alias(f"tf{i}") for i, t in enumerate(terms)], matches(F.col("w"), query).alias("hit"))

    stats = counted(docs).agg(F.count(F.lit(1)).alias("n"), F.avg("length").alias("mean"), *[F.count_if(F.col(f"tf{i}") > 0).alias(f"df{i}") for i in range(len(terms))])
    hits = counted(docs.where(likely(F.lower(text_col), query))).where("hit")
    joined = hits.crossJoin(F.broadcast(stats))
    score = F.lit(0.0)
    for i in range(len(terms)):
        tf, df = F.col(f"tf{i}"), F.col(f"df{i}")
        score = score + F.log(1 + (F.col("n") - df + 0.5) / (df + 0.5)) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("length") / F.col("mean")))
    return joined.select("id", F.round(score, 6).alias("score"))


def best(df: DataFrame, score: str, k: int, tie: str = "id") -> DataFrame:
    return df.orderBy(F.desc(score), F.asc(tie)).limit(k)


def keyword_search(docs: DataFrame, text: str, *, k: int = 10, where: Column | None = None, years: tuple[int, int] | None = None, year_col: str = "year", min_rank: float | None = None, **options) -> DataFrame:
    """(id, score): the k best documents of a web-style query. ``where`` and ``years`` filter before the cut."""
    rows = docs if where is None else docs.where(where)
    rows = rows if years is None else rows.where(F.col(year_col).between(*years))
    found = bm25(rows, parse_query(text), **options)
    return best(found if min_rank is None else found.where(F.col("score") >= min_rank), "score", k)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity in double precision, to 6 places; null for a zero vector."""
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v)
    double = lambda x: F.transform(x, lambda v: v.cast("double"))
    dot = total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))
    norm = lambda x: F.sqrt(total(F.transform(double(x), lambda v: v * v)))
    return F.round(dot / F.nullif(norm(a) * norm(b), F.lit(0.0)), 6)


def vector_search(vectors: DataFrame, query: list[float] | DataFrame, *, k: int = 10, id_col: str = "id", vector_col: str = "embedding", where: Column | None = None, floor: float | None = None, ann_limit: int | None = None) -> DataFrame:
    """(id, similarity): the k nearest by cosine. query: the vector, or a frame of one row (q).

    ``floor`` drops what is less similar; ``ann_limit`` caps k as an approximate index would.
    """
    rows = vectors if where is None else vectors.where(where)
    one = rows.sparkSession.range(1).select(F.array(*[F.lit(float(x)) for x in query]).alias("q")) if isinstance(query, list) else query.limit(1)
    found = rows.crossJoin(F.broadcast(one)).select(F.col(id_col).alias("id"), cosine(F.col(vector_col), F.col("q")).alias("similarity"))
    if floor is not None:
        found = found.where(F.col("similarity") >= floor)
    return best(found, "similarity", min(k, ann_limit) if ann_limit else k)


def ranked(found: DataFrame, score: str, into: str) -> DataFrame:
    """Ranks from 1 of a cut list; it is short, so one window over all of it is fine."""
    return found.select("id", F.row_number().over(Window.orderBy(F.desc(score), F.asc("id"))).cast("long").alias(into))


def fuse(keyword: DataFrame, semantic: DataFrame, *, k: int = 10, rrf_k: int = 60) -> DataFrame:
    """(id, keyword_rank, semantic_rank, score): reciprocal rank fusion; a null rank is absence."""
    both = ranked(keyword, "score", "keyword_rank").join(ranked(semantic, "similarity", "semantic_rank"), "id", "full_outer")
    part = lambda c: F.coalesce(1.0 / (rrf_k + F.col(c)), F.lit(0.0))
    return best(both.withColumn("score", F.round(part("keyword_rank") + part("semantic_rank"), 8)), "score", k)


def hybrid_search(docs: DataFrame, vectors: DataFrame, text: str, query: list[float] | DataFrame, *, k: int = 10, rrf_k: int = 60, pool: int = POOL) -> DataFrame:
    """Each arm gives its best ``pool`` whatever k is."""
    return fuse(keyword_search(docs, text, k=pool), vector_search(vectors, query, k=pool), k=k, rrf_k=rrf_k)


def recall_audit(vectors: DataFrame, statements: DataFrame, known: DataFrame, *, k: int = 40, floor: float = 0.5) -> DataFrame:
    """(id, similarity, statement): near neighbours of several statements that the corpus lacks.

    Each statement (statement, q) gives its k nearest; a document counts for the first that found it. Statements are
    a stated list, of which more than ``STATEMENTS`` are refused: they are broadcast.
    """
    if statements.limit(STATEMENTS + 1).count() > STATEMENTS:
        raise ValueError(f"more than {STATEMENTS} statements")
    near = vectors.crossJoin(F.broadcast(statements.limit(STATEMENTS))).select("id", "statement", cosine(F.col("embedding"), F.col("q")).alias("similarity"))
    top = near.where(F.col("similarity") >= floor).withColumn("r", F.row_number().over(Window.partitionBy("statement").orderBy(F.desc("similarity"), "id"))).where(F.col("r") <= k)
    first = top.withColumn("n", F.row_number().over(Window.partitionBy("id").orderBy("statement"))).where("n = 1")
    return first.join(known.select("id"), "id", "left_anti").select("id", "similarity", "statement")


def name_search(names: DataFrame, text: str, *, k: int = 20, id_col: str = "id", name_col: str = "name", floor: float = 0.0) -> DataFrame:
    """(id, name, similarity) of the names that share most trigrams."""
    found = names.select(F.col(id_col).alias("id"), F.col(name_col).alias("name"), F.round(trigram_sim(F.col(name_col), F.lit(text)), 6).alias("similarity"))
    return best(found.where(F.col("similarity") > floor), "similarity", k)


def autocomplete(names: DataFrame, prefix: str, *, k: int = 10, name_col: str = "name") -> DataFrame:
    """(name, n): the most frequent names that begin so."""
    found = names.where(F.startswith(F.lower(name_col), F.lit(prefix.lower()))).groupBy(F.col(name_col).alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return found.orderBy(F.desc("n"), "name").limit(k)


def document_prompt(title: Column, abstract: Column) -> Column:
    return F.concat(F.lit("title: "), title, F.lit(" | text: "), F.coalesce(F.nullif(abstract, F.lit("")), F.lit("none")))


def query_prompt(query: Column) -> Column:
    return F.concat(F.lit("task: search result | query: "), query)


def check_dimension(vectors: DataFrame, dim: int, vector_col: str = "embedding") -> DataFrame:
    """(size, n) of the vectors that haven't ``dim`` components; empty when all is well."""
    return vectors.where(F.col(vector_col).isNull() | (F.size(vector_col) != dim)).groupBy(F.size(vector_col).cast("long").alias("size")).agg(F.count(F.lit(1)).alias("n"))
