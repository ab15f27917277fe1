"""Language identification by mixture inference.

Each language has a distribution over hashed byte trigrams. A document is a mixture of languages: every
word was written in one of them, with the likelihood of its trigrams. Expectation-maximisation finds the
document's proportions: each document by itself, until none of its proportions moves by ``STILL`` or
more, or ``ROUNDS`` are over. The languages are then ordered by proportion, and the leading set with the best
likelihood, less a penalty for each further language, is the document's language set.

Learning takes a bounded sample: about ``per_lang`` documents of each label, chosen by a hash of the
row; all else reads every whole text. A model has at most ``MODEL`` numbers, so many labels have fewer
buckets each: that bounds what is collected (a table a label) and broadcast. Texts are worked on in slabs of ``SLAB``
numbers, one for each word and label; a longer text is gone through in such pieces, once a round.

Defined results: a text that is null or has no letter is ``und`` with score 0. Where nothing was
learned, every text is ``und``. Ties go to the label that sorts first. Rows equal in doc_id each get a
row. Labels, sources and ids are never inputs of a prediction. Extra columns pass through ``classify``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import columns_of, trimmed, unpack

BUCKETS = 1 << 16
#: Numbers in a model at most (64 MB), labels times buckets; and of those that are worked on at a time.
MODEL = 1 << 24
SLAB = 1 << 21
PER_LANG = 3000
SMOOTHING = 0.5
#: Rounds at most, and the move of a proportion that ends them.
ROUNDS = 64
STILL = 1e-3
PENALTY = 2.0
UNKNOWN = "und"

#: ASCII that is no letter counts as the space between words.
_FOLD = np.array([x if x >= 128 or 97 <= x <= 122 else 32 for x in range(256)], dtype=np.uint8)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def buckets_for(labels: int) -> int:
    """A power of two, so that a model of so many labels stays within ``MODEL``."""
    return max(256, min(BUCKETS, 1 << (MODEL // max(1, labels)).bit_length() - 1))


def trigrams(texts: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigram buckets in order; where each word's begin; where each text's words begin (and the end)."""
    parts = [x.lower().encode("utf-8", "surrogatepass") for x in texts]
    data = _FOLD[np.frombuffer(b" " + b"  ".join(parts) + b" ", dtype=np.uint8)]
    wide = data.astype(np.uint32)
    codes = (wide[:-2] << np.uint32(16) | wide[1:-1] << np.uint32(8) | wide[2:]) * np.uint32(2654435761) >> np.uint32(33 - buckets.bit_length())
    centre = data[1:-1] != 32
    starts = centre & (data[:-2] == 32)
    at = np.cumsum([0, *(len(x) + 2 for x in parts)])
    words_before = np.concatenate(([0], np.cumsum(starts)))
    gram_before = np.cumsum(centre) - centre
    return codes[centre], gram_before[starts], words_before[np.minimum(at, len(words_before) - 1)]


class Model:
    """Log-probabilities of trigram buckets by language."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs, self.buckets = langs, len(counts)
        totals = counts.sum(axis=0, keepdims=True)
        self.logp = np.log((counts + SMOOTHING) / (totals + SMOOTHING * self.buckets)).astype(np.float32)

    def likelihoods(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each word its likelihood in each language, the best being 1; how many words each text has."""
        grams, starts, owners = trigrams(texts, self.buckets)
        if not len(starts):
            return np.empty((0, len(self.langs))), np.diff(owners)
        ll = np.add.reduceat(self.logp[grams], starts, axis=0)
        return np.exp(np.maximum(ll - ll.max(axis=1, keepdims=True), -60)).astype(np.float64), np.diff(owners)

    def chosen(self, share: np.ndarray, fits: np.ndarray, n: int, order: np.ndarray) -> tuple[str, float, list[str]]:
        """The answer for a text of n words; fits: the log-likelihood under the leading 1, 2, ... languages."""
        size = int(np.argmax(fits - PENALTY * np.arange(len(fits)) * np.log(n + 1))) + 1
        names = [self.langs[j] for j in order[:size]]
        return names[0], float(min(1.0, share[order[0]])), names

    @staticmethod
    def leading(share: np.ndarray, order: np.ndarray, m: int) -> np.ndarray:
        """The proportions of the m leading languages, none of them zero, for a row or for each of many."""
        kept = np.zeros_like(share)
        first = order[..., :m]
        np.put_along_axis(kept, first, np.take_along_axis(share, first, axis=-1) + 1e-9, axis=-1)
        return kept / kept.sum(axis=-1, keepdims=True)

    def proportions(self, like: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """By expectation-maximisation, from the likelihoods of the words of texts that each have some."""
        k = len(self.langs)
        share = np.full((len(counts), k), 1.0 / k)
        todo = np.arange(len(counts))
        for _ in range(ROUNDS):
            first = np.cumsum(counts) - counts
            mix = like * np.repeat(share[todo], counts, axis=0)
            mix /= mix.sum(axis=1, keepdims=True)
            now = np.add.reduceat(mix, first, axis=0) / counts[:, None]
            moving = np.abs(now - share[todo]).max(axis=1) >= STILL
            share[todo] = now
            if not moving.any():
                break
            if not moving.all():
                like, todo, counts = like[np.repeat(moving, counts)], todo[moving], counts[moving]
        return share

    def predict(self, texts: list[str]) -> list[tuple[str, float, list[str]]]:
        """(language, its proportion, language set) of each text that has letters."""
        like, counts = self.likelihoods(texts)
        # A text may be all symbols above ASCII, and have no word.
        full = np.flatnonzero(counts)
        out: list[tuple[str, float, list[str]]] = [(UNKNOWN, 0.0, [])] * len(texts)
        if not len(full):
            return out
        n = counts[full]
        share = self.proportions(like, n)
        order = np.argsort(-share, axis=1, kind="stable")
        first = np.cumsum(n) - n
        fits = [np.add.reduceat(np.log((like * np.repeat(self.leading(share, order, m), n, axis=0)).sum(axis=1) + 1e-30), first) for m in range(1, len(self.langs) + 1)]
        for row, i in enumerate(full.tolist()):
            out[i] = self.chosen(share[row], np.array([f[row] for f in fits]), int(n[row]), order[row])
        return out

    def predict_long(self, text: str, piece: int) -> tuple[str, float, list[str]]:
        """The same for a text that is gone through in pieces of about so many characters."""
        k = len(self.langs)

        def pieces() -> Iterator[np.ndarray]:
            at = 0
            while at < len(text):
                end = at + piece if at + piece < len(text) else len(text)
                while end < len(text) and not (text[end].isascii() and not text[end].isalpha()):
                    end += 1
                yield self.likelihoods([text[at:end]])[0]
                at = end

        share, n = np.full(k, 1.0 / k), 0
        for _ in range(ROUNDS):
            total, n = np.zeros(k), 0
            for like in pieces():
                mix = like * share
                total += (mix / mix.sum(axis=1, keepdims=True)).sum(axis=0)
                n += len(like)
            if not n:
                return UNKNOWN, 0.0, []
            moved, share = np.abs(total / n - share).max(), total / n
            if moved < STILL:
                break
        order = np.argsort(-share, kind="stable")
        leading = [self.leading(share, order, m) for m in range(1, k + 1)]
        fits = np.zeros(k)
        for like in pieces():
            fits += [np.log(like @ x + 1e-30).sum() for x in leading]
        return self.chosen(share, fits, n, order)


def _count(buckets: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A table for each label; a label's rows come together."""
        tables: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                grams, _, _ = trigrams([text.as_py() or ""], buckets)
                into = tables.setdefault(lang, np.zeros(buckets, dtype=np.int64))
                np.add.at(into, grams, 1) if len(grams) < 4096 else into.__iadd__(np.bincount(grams, minlength=buckets))
        yield pa.RecordBatch.from_arrays([pa.array(list(tables), pa.string()), pa.array([x.tobytes() for x in tables.values()], pa.binary())], ["lang", "counts"])

    return run


def learn(labelled: DataFrame, *, per_lang: int = PER_LANG) -> Model | None:
    """A model from the rows (doc_id, lang, text) with a lang; about ``per_lang`` rows of each are read.

    The id only takes part in the hash by which rows are chosen.
    """
    rows = labelled.where(F.col("lang").isNotNull()).select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    scale = 1 << 20
    share = F.element_at(F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(scale, -(-per_lang * scale // n)))]), F.col("lang"))
    chosen = rows.where(F.pmod(F.xxhash64("doc_id", "text", F.lit(17)), F.lit(scale)) < share)
    langs, buckets = sorted(sizes), buckets_for(len(sizes))
    found = chosen.select("lang", "text").repartition("lang").mapInArrow(_count(buckets), "lang string, counts binary").collect()
    counts = np.zeros((buckets, len(langs)), dtype=np.int64)
    for r in found:
        counts[:, langs.index(r["lang"])] += np.frombuffer(r["counts"], dtype=np.int64)
    return Model(langs, counts)


def _classify(model, keep: list[str], names: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            found: list[tuple[str, float, list[str]]] = []
            slab, size = [], 0
            # A word has two bytes at least, its own and a space.
            most = max(1 << 12, 2 * SLAB // max(1, len(m.langs))) if m is not None else SLAB

            def flush() -> None:
                nonlocal slab, size
                real = [i for i, x in enumerate(slab) if m is not None and has_letter(x)]
                got = [(UNKNOWN, 0.0, [])] * len(slab)
                if real:
                    for i, p in zip(real, m.predict([slab[i] for i in real]), strict=True):
                        got[i] = p
                found.extend(got)
                slab, size = [], 0

            for x in batch.column("__text"):
                text = x.as_py()
                if len(text or "") > most and m is not None and has_letter(text):
                    flush()
                    found.append(m.predict_long(text, most))
                    continue
                slab.append(text)
                size += len(text or "")
                if size >= most:
                    flush()
            flush()
            langs, scores, sets = zip(*found, strict=True) if found else ((), (), ())
            new = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(sets, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *new], names)

    return run


def classify(rows: DataFrame, text: Column, model: Model | None) -> DataFrame:
    """The columns of rows and lang_pred, score, languages."""
    clash = {"lang_pred", "score", "languages", "__text"} & set(rows.columns)
    if clash:
        raise ValueError(f"rename or pack these columns first: {sorted(clash)}")
    spark = rows.sparkSession
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), "lang_pred string, score double, languages array<string>"])
    shared = spark.sparkContext.broadcast(model)
    names = [*rows.columns, "lang_pred", "score", "languages"]
    return rows.withColumn("__text", text).mapInArrow(trimmed(_classify(shared, rows.columns, names)), schema)


def held_out() -> Column:
    """Rows that no model learns from: crc32 of the id's text leaves 1 when divided by 3."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def identify(docs: DataFrame, *, per_lang: int = PER_LANG) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, languages) of every row."""
    model = learn(docs.where(~held_out()), per_lang=per_lang)
    return classify(docs.select("doc_id", held_out().alias("held_out"), "text"), F.col("text"), model).drop("text")


def known_language(docs: DataFrame, *, per_lang: int = PER_LANG) -> DataFrame:
    """docs without those whose language is unknown: null texts and texts without a letter."""
    model = learn(docs.where(~held_out()), per_lang=per_lang)
    found = classify(docs.select(F.struct(*columns_of(docs)).alias("row")), F.col("row.text"), model)
    return unpack(found.where(F.col("lang_pred") != UNKNOWN).select("row"))
