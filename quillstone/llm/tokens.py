"""Token ids of whole texts, by a tokenizer file of the ``tokenizers`` library.

``Encoder`` gives exactly the ids of the file's tokenizer. For a byte-level BPE with word ends, the kind
that splits texts at white space, words recur so often that a bounded cache of words pays. Words that
miss it are encoded together, by the same merges in a faster library. Texts with characters outside the
Latin blocks, or with a special token's string, go to the tokenizer itself.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

#: What the fast way covers, as the file states it.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMAL = ["NFC", "Replace", "Lowercase"]
_LETTERS = "a-zªµºà-öø-ÿĀ-ɏ"
_NUMBERS = "0-9²³¹¼½¾"
_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}ß]+|[{_NUMBERS}]|[^\s{_LETTERS}ß{_NUMBERS}]+")
_OUTSIDE = re.compile("[^\t\n\x0b\x0c\r\x20-\x7e\xa1-įı-ɏ]")
#: Words kept in the cache: a bound on memory.
CACHE = 400_000


def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        spec = json.loads(open(path, encoding="utf-8").read())
        self.cache: dict[str, bytes] = {}
        self.fast = self._fast(spec)
        self.special = [x["content"] for x in spec.get("added_tokens", [])]

    def _fast(self, spec: dict):
        """The faster library's encoding, where the file is of the kind it can stand in for."""
        model = spec["model"]
        normal = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        split = [(x.get("pattern") or {}).get("Regex") for x in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        if normal != _NORMAL or split[:1] != [_SPLIT] or model.get("end_of_word_suffix") != "</w>" or spec.get("post_processor"):
            return None
        import tiktoken

        letters, ranks = _byte_letters(), {}
        ends = np.zeros(max(model["vocab"].values()) + 1, dtype=bool)
        added = {x["content"] for x in spec.get("added_tokens", [])}
        for token, i in model["vocab"].items():
            if token in added:
                continue
            # A word's end is the byte 0, which no text of the fast way holds.
            end = token.endswith("</w>") and len(token) > 4
            ends[i] = end
            ranks[bytes(letters[c] for c in (token[:-4] if end else token)) + b"\0" * end] = i
        self.ends = ends
        return tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})

    def _learn(self, chunks: list[str]) -> None:
        """Encode pieces between white space into the cache."""
        words = [_WORDS.findall(x) for x in chunks]
        ids = self.fast.encode_to_numpy("\0".join([w for ws in words for w in ws]) + "\0", allowed_special=set(), disallowed_special=()).astype(np.uint32)
        word_ends = np.flatnonzero(self.ends[ids]) + 1
        cuts = np.concatenate(([0], word_ends[np.cumsum([len(x) for x in words]) - 1])) * 4
        data = ids.tobytes()
        at = cuts.tolist()
        self.cache.update(zip(chunks, [data[a:b] for a, b in zip(at, at[1:], strict=False)], strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        out: list[bytes | list[str] | None] = []
        for x in texts:
            plain = self.fast is not None and not _OUTSIDE.search(x) and not any(s in x for s in self.special)
            out.append(x.lower().split() if plain else None)
        odd = [i for i, x in enumerate(out) if x is None]
        if odd:
            for i, e in zip(odd, self.slow.encode_batch([texts[i] for i in odd], add_special_tokens=False), strict=True):
                out[i] = np.array(e.ids, dtype="<u4").tobytes()
        known = [x for x in out if isinstance(x, list)]
        new = set().union(*known).difference(self.cache)
        if len(self.cache) + len(new) > CACHE:
            self.cache, new = {}, set().union(*known)
        if new:
            self._learn(list(new))
        get = self.cache.__getitem__
        return [b"".join(map(get, x)) if isinstance(x, list) else x for x in out]


    def forget(self) -> None:
        """Empty the cache; words recur within a partition, and what another partition learned saves it next to nothing."""
        self.cache = {}


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder a worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
