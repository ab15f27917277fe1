"""Licence scans by Dice coefficient over word bigrams. DataFrame functions only.

A text's words are its runs of letters and digits, lower-cased, so that line ends, comment signs and
markup between them don't count. A stretch of words matches a template if the Dice coefficient of
their sets of bigrams, 2 |A & T| / (|A| + |T|), is ``threshold`` or more and the template's own phrases
are in it. It then holds at least |T| t / (2 - t) of the template's bigrams; so a template of which the whole
document has fewer is not compared, which leaves few templates for few documents.

A template's stretch is the one that makes 2 |A & T| - t |A| largest, found in one pass over the words: a
bigram of the template counts 2 - t, any other -t. It may begin and end anywhere: in a line, or paragraphs
apart. Where stretches of several templates overlap, the one with the most bigrams in common stays, so a match is one row.

Each document is worked on by itself: there is no shuffle and no join. Templates are a fixed number of
short texts that stand in the expression.

Defined results: a null or empty text matches nothing. Of templates that tie the first one counts. A licence
that occurs several times gives a row for its best stretch. Rows equal in doc_id are scanned each by itself,
and a null doc_id is kept. Extra columns are not looked at.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.llm.license_templates import TEMPLATES

THRESHOLD = 0.8


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), "")


def bigrams(tokens: Column) -> Column:
    """Hashes of neighbouring pairs, in order; fewer than two words have none."""
    n = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.zip_with(F.slice(tokens, F.lit(1), n), F.slice(tokens, F.lit(2), n), lambda a, b: F.xxhash64(a, b))


def word_list(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def template_bigrams(text: str) -> list[tuple[str, str]]:
    found = word_list(text)
    return list(dict.fromkeys(zip(found, found[1:], strict=False)))


def once(value: Column, use) -> Column:
    """use(value), where value is worked out once however often use names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _hashes(pairs: list[tuple[str, str]]) -> Column:
    return F.array(*[F.xxhash64(F.lit(a), F.lit(b)) for a, b in pairs]) if pairs else F.expr("cast(array() as array<bigint>)")


def best_stretch(grams: Column, wanted: Column, threshold: float) -> Column:
    """(first, last) bigram of the stretch with the largest sum, where a wanted one counts 2 - t and any other -t."""
    zero = F.struct(F.lit(0.0).alias("now"), F.lit(0).alias("at"), F.lit(0.0).alias("best"), F.lit(0).alias("first"), F.lit(-1).alias("last"), F.lit(0).alias("i"))

    def step(a: Column, g: Column) -> Column:
        value = F.when(F.array_contains(wanted, g), 2 - threshold).otherwise(-threshold)
        fresh = a["now"] <= 0
        now, at = F.when(fresh, value).otherwise(a["now"] + value), F.when(fresh, a["i"]).otherwise(a["at"])
        better = now > a["best"]
        return F.struct(
            now.alias("now"), at.alias("at"), F.when(better, now).otherwise(a["best"]).alias("best"), F.when(better, at).otherwise(a["first"]).alias("first"), F.when(better, a["i"]).otherwise(a["last"]).alias("last"),
            (a["i"] + 1).alias("i"),
        )

    return F.aggregate(grams, zero, step, lambda a: F.struct(a["first"].alias("first"), a["last"].alias("last")))


def scan(docs: DataFrame, *, templates: tuple = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, license, dice, first_word, n_words, template): a row for each match."""
    sets = [(name, template_bigrams(text), [p for x in must for p in template_bigrams(x)]) for name, text, must in templates]
    low = threshold / (2 - threshold)
    least = [max(1, -int(-len(s) * low // 1)) for _, s, _ in sets]
    known = F.array(
        *[
            F.struct(F.lit(i).alias("at"), F.lit(name).alias("name"), _hashes(s).alias("grams"), _hashes(must).alias("must"), F.lit(len(s)).alias("n"), F.lit(few).alias("least"))
            for i, ((name, s, must), few) in enumerate(zip(sets, least, strict=True))
        ]
    )
    every = _hashes(list(dict.fromkeys(p for _, s, _ in sets for p in s)))

    def compared(grams: Column, t: Column, place: Column) -> Column:
        inside = F.slice(grams, place["first"] + 1, F.greatest(place["last"] - place["first"] + 1, F.lit(0)))

        def judged(a: Column) -> Column:
            both = F.size(F.array_intersect(a, t["grams"]))
            dice = 2.0 * both / F.greatest(F.size(a) + t["n"], F.lit(1))
            fits = (dice >= threshold) & (F.size(F.array_except(t["must"], a)) == 0)
            return F.when(fits, F.struct(both.alias("both"), dice.alias("dice"), (-t["at"]).alias("order"), t["name"].alias("name"), place["first"].alias("first"), place["last"].alias("last")))

        return once(F.array_distinct(inside), judged)

    def apart(found: Column) -> Column:
        """Matches in the order of what they have in common; one that overlaps an earlier one goes."""
        ranked = F.reverse(F.array_sort(found))
        overlaps = lambda x, m: (x["first"] <= m["last"]) & (m["first"] <= x["last"])
        return F.aggregate(ranked, F.slice(ranked, F.lit(1), F.lit(0)), lambda kept, m: F.when(F.exists(kept, lambda x: overlaps(x, m)), kept).otherwise(F.concat(kept, F.array(m))))

    def matches(grams: Column) -> Column:
        def of_common(common: Column) -> Column:
            likely = F.filter(known, lambda t: (F.size(common) >= t["least"]) & (F.size(F.array_intersect(common, t["grams"])) >= t["least"]) & (F.size(F.array_except(t["must"], common)) == 0))
            found = F.transform(likely, lambda t: once(best_stretch(grams, t["grams"], threshold), lambda place: compared(grams, t, place)))
            return F.when(F.size(common) >= min(least), once(F.filter(found, lambda m: m.isNotNull()), apart))

        return once(F.array_intersect(grams, every), of_common)

    # An outer explode: else each document would be worked on twice, once to see whether there is a match.
    found = docs.select("doc_id", F.explode_outer(once(bigrams(words(F.coalesce("text", F.lit("")))), matches)).alias("m")).where(F.col("m").isNotNull())
    return found.select(
        "doc_id", F.col("m.name").alias("license"), F.round("m.dice", 6).alias("dice"), F.col("m.first").alias("first_word"), (F.col("m.last") - F.col("m.first") + 2).alias("n_words"), (-F.col("m.order")).alias("template")
    )
