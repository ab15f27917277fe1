"""Small hard tables and brute-force versions."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import xxhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, row int, h1 long, part long, score double"


def odd_documents() -> list[tuple]:
    """Nulls everywhere, empty and very long texts, ties, repeated rows, copies, extra columns with inner names."""
    line = "This very common line is in many documents."
    long = " ".join(f"word{i % 977} and{i % 31}" for i in range(30000))
    texts = [
        None, "", " ", "\n", "\n\n\n", "a", "Two words", "three little words", line, line.upper(), f"  {line}\t", f"{line}\nown text here, nowhere else at all\n{line}", f"x\n{line}\n\nÉcole ÀÉ déjà vu monsieur le président\n",
        "ÉCOLE DES FEMMES ET DES HOMMES", "école des femmes et des hommes", "École des Femmes et des Hommes", long, long, long + " end", "12345 67890 !!!", "日本語 の テキスト です", "tab\tand\x0bvertical\x0cfeed\r\nreturn",
        "<|endoftext|> is a marker", "\U0001f600 smile \U0001f600", "the same text", "the same text", "the same text",
    ]
    rows = []
    for i, text in enumerate(texts):
        rows.append((i, text, ("en", "fr", None)[i % 3], ("a", "b", "c", None)[i % 4], None if text is None else len(text), "x", 1, 2, 3, 0.5))
    rows.append(rows[8])
    rows.append(rows[24])
    rows.append((None, "no id", None, None, None, None, None, None, None, None))
    rows.append((None, "the same text", None, "a", None, None, None, None, None, None))
    return rows


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(x: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x)


def simhash(text: str | None) -> int:
    words = WORD.findall(ascii_lower(text or ""))
    if not words:
        return 0
    runs = [words[i : i + 3] for i in range(len(words) - 2)] or [words]
    ones = Counter()
    for r in runs:
        h = xxhash.xxh64_intdigest(" ".join(r).encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(runs))


def components(prints: list[int], limit: int = 2) -> dict[int, int]:
    """A label for each fingerprint, by comparing all pairs."""
    distinct = sorted(set(prints))
    up = {x: x for x in distinct}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= limit:
                up[find(a)] = find(b)
    return {x: find(x) for x in distinct}


def dedup_lines(rows: list[tuple], min_chars: int = 20, min_docs: int = 3) -> list[tuple]:
    """(doc_id, lines, dropped, kept text) of each row; rows with one doc_id are one document."""
    white = " \t\n\x0b\x0c\r"
    split = [(r[0], (r[1] or "").split("\n")) for r in rows]
    key = lambda x: ascii_lower(x.strip(white))
    holders = defaultdict(set)
    for i, (doc, lines) in enumerate(split):
        for k in {key(x) for x in lines}:
            if len(k) >= min_chars:
                holders[k].add(doc)
    out = []
    for doc, lines in split:
        keep = []
        for x in lines:
            h = holders.get(key(x), set())
            most = max((d for d in h if d is not None), default=None)
            if len(h) < min_docs or doc == most:
                keep.append(x)
        out.append((doc, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return out


def shingles(text):
    words = WORD.findall(ascii_lower(text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def similar_groups(texts):
    """A label for each text: those linked at a similarity of 0.8 of five-word shingles share it."""
    sets, up = [shingles(t) for t in texts], list(range(len(texts)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or 5 * len(a & b) >= 4 * len(a | b):
                up[find(i)] = find(j)
    return [find(i) for i in range(len(texts))]
