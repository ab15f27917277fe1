"""Text functions: normal forms, similarities, predicates on identifiers. Column expressions but for the edit ratio."""

from __future__ import annotations

import json
from html.entities import html5

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: Words that may stand before a title, identifier forms.
PREFIXES = ("book review", "review essay", "reviews", "review", "editorial", "erratum", "correction")
DOI = r"^10\.[0-9]{4,9}/\S+$"
START_OF_WORD, END_OF_WORD = r"(^|[^\p{L}\p{N}_])", r"($|[^\p{L}\p{N}_])"


def word_pattern(pattern: str) -> str:
    r"""A pattern with ``\m`` and ``\M`` for word starts and ends in terms that work on letters of any script.

    It takes in the neighbouring character, so it tells whether, not where.
    """
    return pattern.replace(r"\m", START_OF_WORD).replace(r"\M", END_OF_WORD)


def any_word(text: Column, patterns: list[str]) -> Column:
    """Whether one of the patterns occurs, whatever the case."""
    return text.rlike("(?i)(" + "|".join(word_pattern(p) for p in patterns) + ")")


#: A named or numbered entity with its semicolon; the names are those of HTML 5.
ENTITY = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"


def unescape_html(text: Column) -> Column:
    """Entities by the characters they stand for, each once; unknown ones stay."""
    named = F.from_json(F.lit(json.dumps({f"&{k}": v for k, v in html5.items() if k.endswith(";")})), "map<string,string>")

    def character(e: Column) -> Column:
        number = F.when(e.rlike("^&#[0-9]"), F.regexp_extract(e, "[0-9]+", 0)).when(e.rlike("^&#[xX]"), F.conv(F.regexp_extract(e, "^&#[xX]([0-9a-fA-F]+)", 1), 16, 10)).cast("int")
        return F.when(number.isNotNull(), F.when(number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF), F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))).otherwise(F.try_element_at(named, e))

    # What gives an ampersand comes last, so that nothing is unescaped twice.
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)))
    ampersand = lambda e: F.coalesce(character(e) == "&", F.lit(False))
    ordered = F.concat(F.filter(found, lambda e: ~ampersand(e)), F.filter(found, ampersand))
    done = F.aggregate(ordered, text, lambda t, e: F.replace(t, e, F.coalesce(character(e), e)))
    return F.when(F.contains(text, F.lit("&")), done).otherwise(text)


def alnum_key(text: Column) -> Column:
    """Letters and digits of ASCII, lower-cased; nothing between."""
    return F.lower(F.regexp_replace(text, "[^a-zA-Z0-9]", ""))


def norm_title(title: Column) -> Column:
    """Unescaped, without a leading kind of article, lower-cased words; empty for null."""
    plain = F.regexp_replace(unescape_html(F.coalesce(title, F.lit(""))), f"(?i)^\\s*({'|'.join(x.replace(' ', chr(92) + 's+') for x in PREFIXES)})\\s*[:\\-—]\\s*", "")
    return F.trim(F.regexp_replace(F.lower(plain), "[^a-z0-9]+", " "))


def norm_journal(name: Column) -> Column:
    """Unescaped, "and" for "&", without a leading "the", lower-cased words; empty for null."""
    plain = F.replace(F.lower(unescape_html(F.coalesce(name, F.lit("")))), F.lit("&"), F.lit(" and "))
    return F.trim(F.regexp_replace(F.regexp_replace(plain, r"^the\s+", ""), "[^a-z0-9]+", " "))


def edit_ratio(a: str, b: str) -> float:
    """Ratcliff-Obershelp similarity."""
    from difflib import SequenceMatcher

    return SequenceMatcher(None, a, b).ratio()


@F.pandas_udf(DoubleType())
def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([edit_ratio(x, y) if isinstance(x, str) and isinstance(y, str) else None for x, y in zip(a, b, strict=True)])


def title_sim(a: Column, b: Column) -> Column:
    """Of two normal titles: 0 if either is empty, 1 if equal, length ratio within .75 and .97 if one begins the other, else the edit ratio.

    Only pairs that reach the last rung go through Python.
    """
    short, long = F.least(F.char_length(a), F.char_length(b)), F.greatest(F.char_length(a), F.char_length(b))
    empty = F.coalesce(a == "", F.lit(True)) | F.coalesce(b == "", F.lit(True))
    prefix = F.startswith(a, b) | F.startswith(b, a)
    hard = ~(empty | (a == b) | prefix)
    return (
        F.when(empty, 0.0)
        .when(a == b, 1.0)
        .when(prefix, F.least(F.lit(0.97), F.greatest(F.lit(0.75), short / long)))
        .otherwise(_ratio(F.when(hard, a), F.when(hard, b)))
    )


def levenshtein_sim(a: Column, b: Column) -> Column:
    """1 less the edit distance by the longer length; another measure than ``title_sim``."""
    n = F.greatest(F.char_length(a), F.char_length(b))
    return F.when(n == 0, 1.0).otherwise(1 - F.levenshtein(a, b) / n)


def digit_runs(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit("[0-9]+"), F.lit(0)), lambda x: F.ltrim(x, F.lit("0")))


def digits_conflict(a: Column, b: Column) -> Column:
    """Both hold numbers and the numbers differ, leading zeros aside."""
    x, y = digit_runs(a), digit_runs(b)
    return (F.size(x) > 0) & (F.size(y) > 0) & (x != y)


def name_tokens(text: Column) -> Column:
    """Distinct lower-cased words of more than two letters."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[^a-zà-öø-ÿā-ſ]+"), lambda x: F.char_length(x) > 2))


def jaccard(a: Column, b: Column) -> Column:
    both, either = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(both / either)


def is_valid_doi(value: Column) -> Column:
    return F.coalesce(F.regexp_replace(value, r"^\s+|\s+$", "").rlike(DOI), F.lit(False))


def oai_to_doi(value: Column, pattern: str, prefix: str) -> Column:
    """The identifier that a rule gives for a value like ``oai:...-123``; null where the rule doesn't fit."""
    return F.when(value.rlike(pattern), F.concat(F.lit(prefix), F.regexp_extract(value, pattern, 1)))


def strip_accents(text: Column) -> Column:
    """Without combining marks; precomposed Latin letters by their base letters."""
    return F.translate(text, ACCENTED, PLAIN)


#: Latin letters with marks, and the letters without.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝāăąćčďēĕėęěğģīĭįķĺľļńňņōŏőŕřśšşťţūŭůűųźžż"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUYaaaccdeeeeeggiiiklllnnnooorrsssttuuuuuzzz"


def demojibake(text: Column) -> Column:
    """The text that was read as Latin-1 though it was UTF-8; null where that is not what happened."""
    narrow = ~text.rlike(r"[^\x{00}-\x{FF}]") & text.rlike(r"[\x{80}-\x{FF}]")
    raw = F.encode(F.when(narrow, text), "ISO-8859-1")
    back = F.when(F.is_valid_utf8(raw.cast("string")), raw.cast("string"))
    return F.when(back != text, back)


def split_names(text: Column, mark: str = ";") -> Column:
    return F.filter(F.transform(F.split(text, mark), lambda x: F.trim(x)), lambda x: x != "")


def year_verdict(year: Column, years: Column) -> Column:
    """unknown, match, match_offset_1 or mismatch of a year with a set of years."""
    return (
        F.when(year.isNull() | years.isNull() | (F.size(years) == 0), "unknown")
        .when(F.array_contains(years, year), "match")
        .when(F.exists(years, lambda y: F.abs(y - year) <= 1), "match_offset_1")
        .otherwise("mismatch")
    )


def journal_match(our_issns: Column, their_issns: Column, ours: Column, theirs: Column) -> Column:
    """(verdict, basis): numbers decide where both have them, else the names do. Numbers are trimmed and upper-cased."""
    numbers = lambda x: F.transform(F.filter(F.coalesce(x, F.array().cast("array<string>")), lambda n: F.coalesce(n != "", F.lit(False))), lambda n: F.upper(F.trim(n)))
    a, b = norm_journal(ours), norm_journal(theirs)
    mine, other = numbers(our_issns), numbers(their_issns)
    numbered = (F.size(mine) > 0) & (F.size(other) > 0)
    answer = lambda verdict, basis: F.struct(F.lit(verdict).alias("verdict"), F.lit(basis).alias("basis"))
    words = lambda x: F.array_sort(F.array_distinct(F.split(x, " ")))
    return (
        F.when(numbered & F.arrays_overlap(mine, other), answer("match", "issn"))
        .when(numbered, answer("mismatch", "issn"))
        .when(b == "", answer("unknown", "no_container_title"))
        .when((a == b) | F.startswith(a, b) | F.startswith(b, a) | (title_sim(a, b) >= 0.85), answer("match", "name"))
        .when(words(a) == words(b), answer("match", "name_tokens"))
        .otherwise(answer("mismatch", "name"))
    )


def trigrams(text: Column) -> Column:
    """Distinct trigrams of each lower-cased word, padded by two spaces before and one after."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    padded = F.transform(words, lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    return F.array_distinct(F.flatten(F.transform(padded, lambda w: F.transform(F.sequence(F.lit(1), F.char_length(w) - 2), lambda i: F.substring(w, i, F.lit(3))))))


def trigram_sim(a: Column, b: Column) -> Column:
    return jaccard(trigrams(a), trigrams(b))


def wilson(k: Column, n: Column, z: float = 1.96) -> Column:
    """(low, high): the Wilson interval of k of n, to 4 places; (0, 0) for none."""
    p, zz = k / n, z * z
    centre, half = (p + zz / (2 * n)) / (1 + zz / n), z * F.sqrt(p * (1 - p) / n + zz / (4 * n * n)) / (1 + zz / n)
    low, high = F.round(F.greatest(F.lit(0.0), centre - half), 4), F.round(F.least(F.lit(1.0), centre + half), 4)
    zero = F.lit(0.0)
    return F.when(n == 0, F.struct(zero.alias("low"), zero.alias("high"))).otherwise(F.struct(low.alias("low"), high.alias("high")))


def surnames(byline: Column) -> Column:
    """The distinct surnames of "Surname, Given; Surname G.; Given Surname", in order, in lower-case letters."""
    name = split_names(byline)
    with_comma = lambda x: F.substring_index(x, ",", 1)
    initials_last = lambda x: F.regexp_replace(x, r"(\s+([A-Z]\.?)+)+$", "")
    last_word = lambda x: F.substring_index(x, " ", -1)
    surname = lambda x: F.when(F.contains(x, F.lit(",")), with_comma(x)).when(x.rlike(r"\s([A-Z]\.?)+$"), initials_last(x)).otherwise(last_word(x))
    return F.array_sort(F.array_distinct(F.transform(name, lambda x: F.regexp_replace(F.lower(strip_accents(surname(x))), "[^a-z]", ""))))


#: The classes and methods that a screening may give.
EVIDENCE, METHODS = ("empirical", "conceptual", "review"), ("quantitative", "qualitative", "mixed_methods")


def valid_screening(relevant: Column, evidence: Column, method: Column) -> Column:
    """Forced choice: what is not relevant has no class, what is empirical has a method, nothing else has one."""
    no_method = method.isNull()
    return F.coalesce(
        F.when(~relevant, evidence.isNull() & no_method).when(evidence == "empirical", method.isin(*METHODS)).when(evidence.isin(*EVIDENCE), no_method),
        F.lit(False),
    )


def expand_screening(relevant: Column, evidence: Column, method: Column) -> Column:
    return F.when(~relevant, "not_relevant").otherwise(F.concat_ws("/", evidence, method))
