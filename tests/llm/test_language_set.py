import math
import random
import re

import numpy as np
import pytest

from quillstone.llm import langid


def test_a_text_in_seven_languages_has_them_all():
    rng = random.Random(2)
    letters = ["abc", "def", "ghi", "jkl", "mno", "pqr", "stu"]
    texts = [" ".join("".join(rng.choice(a) for _ in range(6)) for _ in range(300)) for a in letters]
    counts = np.stack([np.bincount(langid.trigrams([t])[0], minlength=langid.BUCKETS) for t in texts], axis=1)
    langs = [f"l{i}" for i in range(len(texts))]
    model = langid.Model(langs, counts)
    found = model.predict([" ".join(texts), texts[3]])
    assert sorted(found[0][2]) == langs and found[1][2] == ["l3"]


def plain(model, text):
    """Proportions, language and set in plain Python, word by word."""
    langs, k = model.langs, len(model.langs)
    words = re.findall(rb"[a-z\x80-\xff]+", text.lower().encode())
    likes = []
    for w in words:
        padded = b" " + w + b" "
        ll = [0.0] * k
        for i in range(len(w)):
            a, b, c = padded[i : i + 3]
            bucket = ((a << 16 | b << 8 | c) * 2654435761 & 0xFFFFFFFF) >> (33 - model.buckets.bit_length())
            for j in range(k):
                ll[j] += float(model.logp[bucket, j])
        top = max(ll)
        likes.append([math.exp(max(x - top, -60)) for x in ll])
    n = len(words)
    share = [1 / k] * k
    for _ in range(langid.ROUNDS):
        sums = [0.0] * k
        for like in likes:
            total = sum(x * s for x, s in zip(like, share, strict=True))
            for j in range(k):
                sums[j] += like[j] * share[j] / total
        now = [x / n for x in sums]
        moved = max(abs(x - y) for x, y in zip(now, share, strict=True))
        share = now
        if moved < langid.STILL:
            break
    order = sorted(range(k), key=lambda j: (-share[j], j))
    best = None
    for m in range(1, k + 1):
        part = {j: share[j] + 1e-9 for j in order[:m]}
        whole = sum(part.values())
        fit = sum(math.log(sum(like[j] * p / whole for j, p in part.items()) + 1e-30) for like in likes) - langid.PENALTY * (m - 1) * math.log(n + 1)
        if best is None or fit > best[0]:
            best = fit, m
    return share, [langs[j] for j in order[: best[1]]]


@pytest.fixture(scope="module")
def model():
    rng = random.Random(5)
    stems = [[rng.choice("abcdeéfgh") + "".join(rng.choice(letters) for _ in range(rng.randint(1, 5))) for _ in range(150)] for letters in ("abcdefgh", "cdefghijk", "fghijklmn", "öüßäabef", "xyzabcde")]
    texts = [" ".join(rng.choice(x) for _ in range(4000)) for x in stems]
    counts = np.stack([np.bincount(langid.trigrams([t])[0], minlength=langid.BUCKETS) for t in texts], axis=1)
    return langid.Model([f"l{i}" for i in range(5)], counts), stems


def documents(stems, rng):
    out = []
    for _ in range(40):
        mixed = rng.sample(range(5), rng.randint(1, 4))
        parts = [w for j in mixed for w in (rng.choice(stems[j]) for _ in range(rng.randint(1, 90)))]
        out.append("".join(w.upper() * (rng.random() < 0.1) or w + rng.choice([" ", "\n", ", ", " 12 "]) for w in parts))
    return out


def test_mixtures_against_plain_python(model):
    m, stems = model
    texts = documents(stems, random.Random(9))
    for text, (lang, score, names) in zip(texts, m.predict(texts), strict=True):
        share, want = plain(m, text)
        assert names == want and lang == want[0] and score == pytest.approx(max(share), abs=1e-6)


@pytest.mark.parametrize("piece", [7, 50, 4000])
def test_long_texts_in_pieces(model, piece):
    m, stems = model
    texts = [*documents(stems, random.Random(11)), "日本語" * 50, "x" * 300]
    for text, (lang, score, names) in zip(texts, m.predict(texts), strict=True):
        again = m.predict_long(text, piece)
        assert (again[0], again[2]) == (lang, names) and again[1] == pytest.approx(score, abs=1e-6)


def test_answers_do_not_depend_on_neighbours(model):
    m, stems = model
    texts = documents(stems, random.Random(12))
    for text, (lang, score, names) in zip(texts, m.predict(texts), strict=True):
        alone = m.predict([text])[0]
        assert (alone[0], alone[2]) == (lang, names) and alone[1] == pytest.approx(score)


def test_proportions_stand_still(model):
    """A further round moves no proportion by much, unless the rounds were over."""
    m, stems = model
    for text in documents(stems, random.Random(13)):
        like, counts = m.likelihoods([text])
        share = m.proportions(like, counts)
        mix = like * share
        again = (mix / mix.sum(axis=1, keepdims=True)).sum(axis=0) / counts[0]
        assert np.abs(again - share[0]).max() < 2 * langid.STILL


def test_models_are_bounded():
    assert langid.buckets_for(4) == langid.buckets_for(256) == langid.BUCKETS
    for labels in (1, 300, 1000, 5000):
        b = langid.buckets_for(labels)
        assert b & (b - 1) == 0 and b * labels <= langid.MODEL
