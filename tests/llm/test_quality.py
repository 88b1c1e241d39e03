"""The quality classifier: features against a plain reading, held-out accuracy, edge rows."""

import math
import random

import numpy as np
import pytest

from quernstone.llm import quality


def sample(n=240):
    draw = random.Random(2)
    words = ["the", "thon", "ering", "hand", "reat", "of", "inti", "esan", "ble", "and"]
    rows = []
    for i in range(n):
        text = draw.choices(words, k=draw.randrange(20, 80))
        if i % 4 == 0:
            text = [w + draw.choice(["%%%", "***", "###"]) for w in text] if i % 8 else [w.upper() + "!!" for w in text]
        rows.append((i, " ".join(text), int(i % 4 != 0)))
    return rows


def test_features_are_those_of_single_texts():
    texts = ["", "ab cde", " a  a b a\n", "été word word", "x" * 700, "\t"]
    cells, owners = quality.features(texts)
    for i, text in enumerate(texts):
        assert sorted(cells[owners == i].tolist()) == sorted(quality.features([text])[0].tolist())
    assert (quality.features(["w w q w"])[0] >= quality.CELLS).sum() == 4
    assert sorted(quality.features(["w w q w"])[0][-4:] - quality.CELLS) == [0, 0, 1, 2]


def plain_features(text):
    """One feature at a time: the grams of each word with a blank at both ends, the word, its mark."""
    words = text.encode("utf-8", "surrogatepass").split()
    first, second, third = map(int, quality.ODD)
    out, hashes = [], []
    for word in words:
        padded = b" " + word + b" "
        for n in quality.GRAMS:
            for i in range(len(padded) - n + 1):
                x = n
                for c in padded[i : i + n]:
                    x = (x * 257 + c) % 2**64
                out.append((x * first % 2**64) >> 64 - quality.BITS)
        x = 0
        for i, c in enumerate(word):
            x = (x + (c + 1) * pow(0x100000001B3, i % 256 + 1, 2**64)) % 2**64
        x = x * second % 2**64
        x ^= x >> 29
        hashes.append(x)
        out.append((x * third % 2**64) >> 64 - quality.BITS)
        back = 1 if hashes[-2:-1] == [x] else 2 if hashes[-3:-2] == [x] else 0
        out.append(quality.CELLS + back)
    return sorted(out)


def test_features_against_a_plain_reading():
    texts = ["", "ab cde", " a  a b a\n", "été word word x word", "x" * 700 + " y", "\t", "a b a b a", "ab\x0bcd\x0cef\rgh", "\x1f\x85 z"]
    cells, owners = quality.features(texts)
    for i, text in enumerate(texts):
        assert sorted(cells[owners == i].tolist()) == plain_features(text)


def test_score_is_the_softmax_of_the_mean():
    rows = sample(60)
    model = quality.SubwordClassifier(epochs=2).fit([t for _, t, _ in rows], [y for _, _, y in rows])
    for _, text, _ in rows[:9]:
        values = [float(model.table[c]) for c in plain_features(text)]
        assert model.score([text])[0] == pytest.approx(1 / (1 + math.exp(-sum(values) / len(values) - model.bias)), rel=1e-4)


def test_training_texts_are_bounded(spark):
    docs = spark.createDataFrame([(1, "good words")] * 500 + [(2, "bad %%%"), (3, "x" * 5000), (4, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, 1)], "doc_id long, quality int")
    seen = []

    class Spy(quality.SubwordClassifier):
        def fit(self, texts, labels):
            seen.append(texts)
            return super().fit(texts, labels)

    original, quality.SubwordClassifier = quality.SubwordClassifier, Spy
    try:
        quality.train(docs, labels, sample=5)
        quality.train(docs, labels, sample_bytes=100)
    finally:
        quality.SubwordClassifier = original
    assert len(seen[0]) == 5 and sum(map(len, seen[1])) <= 100 and seen[1] and "x" * 5000 not in seen[1]


def test_held_out_accuracy():
    rows = sample()
    model = quality.SubwordClassifier(epochs=4).fit([t for _, t, _ in rows[:160]], [y for _, _, y in rows[:160]])
    assert np.mean((model.score([t for _, t, _ in rows[160:]]) >= 0.5) == [y for _, _, y in rows[160:]]) >= 0.97


def test_frames(spark):
    rows = sample(80)
    docs = spark.createDataFrame([*[r[:2] for r in rows], (900, None), (901, ""), (None, "the hand"), (902, "the " * 50000)], "doc_id long, text string").selectExpr("*", "1 as id", "'x' as score")
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in rows] + [(900, None, 1), (None, 1, 1), (0, 1, 0)], "doc_id long, quality int, id int")
    model = quality.train(docs, labels, sample=60)
    out = quality.score(docs, model).collect()
    assert len(out) == 84 and all(0 <= r.score <= 1 for r in out)
    assert quality.score(docs.limit(0), model).collect() == []
    nothing = quality.train(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs, nothing).collect() if r.doc_id in (900, 901)} == {0.5}


def test_training_gives_the_drivers_memory_back(spark, monkeypatch):
    """What the sample's features took on the driver is given back once the model is learned."""
    calls = []
    monkeypatch.setattr(quality, "tidy", lambda: calls.append("tidy"))
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    model = quality.train(docs, labels, epochs=1)
    assert model.table.any() and calls == ["tidy"]
