"""Neighbourhoods and variants against plain versions."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from quernstone.llm import spelling

LETTERS = "[A-Za-zÀ-ÿ]+"


def lowered(word):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in word)


def all_edits(word, alphabet):
    out = {word[:i] + word[i + 1 :] for i in range(len(word))}
    out |= {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in alphabet}
    out |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in alphabet}
    return out - {word}


@pytest.mark.parametrize("cells", [1, 1 << 18])
def test_a_neighbourhood_is_whole_and_holds_each_neighbour_once(monkeypatch, cells):
    monkeypatch.setattr(spelling, "CELLS", cells)
    draw = random.Random(5)
    for _ in range(150):
        word = "".join(draw.choice("aabé") for _ in range(draw.randrange(1, 12)))
        got = [h for hashes, *_ in spelling.neighbourhood(word, np.array([ord(c) for c in "abcé"], np.uint32)) for h in hashes.tolist()]
        assert len(got) == len(set(got)) and set(got) == {spelling.word_hash(w) for w in all_edits(word, "abcé")}


def counted(rows, every=199, least_length=6, least_count=5):
    total = Counter()
    for key, text in rows:
        for run in re.findall(LETTERS, text or ""):
            word = lowered(run)
            h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            total[word[: h % len(word)] + word[h % len(word) + 1 :] if every and h % every == 0 else word] += 1
    return {w: n for w, n in total.items() if len(w) >= least_length and n >= least_count}


def plain_variants(words, ratio=5):
    near, alphabet = defaultdict(set), set("".join(words))
    for w in words:
        near[w] = all_edits(w, alphabet) & words.keys()
    best = {w: min(near[w], key=lambda v: (-words[v], v)) for w in words if near[w]}
    form = {w: v for w, v in best.items() if words[v] >= ratio * words[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), words[w], len(near[w]), words[form[w]] if w in form else None) for w in words}


def some_words(n, seed):
    """Words, their misspellings, and those of these, so that forms make chains."""
    draw, out = random.Random(seed), []
    for _ in range(n):
        word = "".join(draw.choice("abcdeéß÷") for _ in range(draw.randrange(5, 11)))
        times = draw.choice([800, 900, 150])
        while times >= 1:
            out += [word.upper() if draw.random() < 0.1 and word.isascii() else word] * times
            i, times = draw.randrange(len(word)), times // draw.choice([2, 5, 6])
            word = draw.choice([word[:i] + word[i + 1 :], word[:i] + draw.choice("abé") + word[i + 1 :], word[:i] + draw.choice("abß") + word[i:]])
    draw.shuffle(out)
    return out


@pytest.mark.parametrize("every", [3, 199, None])
def test_frames_against_a_plain_version(spark, monkeypatch, every):
    monkeypatch.setattr(spelling, "HELD", 16)
    words = some_words(40, every or 1)
    draw = random.Random(6)
    rows = [(i, "".join(w + draw.choice([" ", ",", "2", "\n"]) for w in words[i::300])) for i in range(300)] + [(400, None), (401, ""), (None, "straßen " * 9), (5, words[0] + " " + words[0])] * 2
    frame = spark.createDataFrame([(t, i, "x") for i, t in rows], "text string, doc_id long, TEXT string").repartition(3)
    found = spelling.vocabulary(frame, every=every)
    want = counted(rows, every)
    assert {r.word: r.n for r in found.collect()} == want and len(want) > 30
    got = [tuple(r) for r in spelling.variants(found).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_variants(want)
    assert any(r[1] and r[1] != r[2] for r in got) or every == 3


def test_long_words_ties_and_empty_tables(spark):
    long = "ab" * 3000
    words = {long: 50, long[1:]: 5, long + "c": 9, "aaaaaa": 5, "aaaaab": 25, "aaaaac": 25, "aaaaaaa": 3, "ÿÿÿÿÿÿ": 7}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {r.word: tuple(r) for r in spelling.variants(frame).collect()}
    assert got[long[1:]] == (long[1:], long, long, 5, 1, 50) and got[long + "c"][1:3] == (long, long)
    assert got["aaaaaa"] == ("aaaaaa", "aaaaab", "aaaaab", 5, 3, 25)  # of two forms of one count, the first
    assert got["aaaaab"][1] is None and got["ÿÿÿÿÿÿ"] == ("ÿÿÿÿÿÿ", None, "ÿÿÿÿÿÿ", 7, 0, None)
    assert spelling.variants(frame.limit(0)).collect() == []
    assert spelling.vocabulary(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    with pytest.raises(ValueError):
        spelling.variants(frame, ratio=1)


def test_roots_of_long_chains(spark):
    words = {"x" * (6 + i): 5 ** (i + 1) for i in range(20)}
    got = {r.word: r.root for r in spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")).collect()}
    assert set(got.values()) == {"x" * 25} and len(got) == 20
