"""Language-model scores: counts, base and model against plain readings; probabilities sum to one; held-out words of each kind against the base."""

import math
import os
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash

from quernstone.llm import maxent

DATA, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def rows(n=160):
    draw = random.Random(6)
    a, b = "the of and to in that is was".split(), "der die und zu von das ist war".split()
    out = []
    for i in range(n):
        words = a if i % 2 else b
        text = " ".join(w + (" " + "".join(draw.choices("abcde", k=4)) if draw.random() < 0.2 else "") for w in draw.choices(words, k=draw.randrange(30)))
        out.append((i, text.upper() if i % 5 == 0 else text))
    return [*out, (1000, None), (1001, ""), (1002, "a " * 30000), (None, "the of"), out[7]]


def plain(train, scored):
    words = lambda t: [*(t or "").encode().lower().split(), None]
    counts = Counter(w for _, t in train for w in words(t))
    n, v = sum(counts.values()), len(counts)
    return {(i, t): (len(words(t)), sum(w in counts for w in words(t)), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words(t))) for i, t in scored}


@pytest.mark.parametrize("head", [1 << 20, 6, 0])
def test_counts_and_base(spark, head):
    sample = rows()
    schema = "doc_id long, text string"
    train = spark.createDataFrame([r for r in sample if r[0] is None or r[0] % 3], schema).selectExpr("*", "1 as word", "2 as n").repartition(3)
    trained = maxent.Trained(train, rounds=1, head=head)
    want = plain([r for r in sample if r[0] is None or r[0] % 3], sample)
    got = maxent.score(spark.createDataFrame(sample, schema).selectExpr("*", "1 as id", "2 as n"), trained).collect()
    assert len(got) == len(sample)
    by_id = {}
    for (i, _), x in want.items():
        by_id[i] = x
    for r in got:
        n, known, total, base = by_id[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    held = [] if not head else [r for r in got if r.doc_id is not None and r.doc_id % 3 == 0 and r.doc_id < 1000]
    assert not held or sum(r.score for r in held) > sum(r.base_score for r in held)


def test_class_probabilities_sum_to_one():
    draw = np.random.default_rng(1)
    model = maxent.Model(draw.integers(0, 50, maxent.CLASSES), draw.normal(size=(maxent.ROWS, maxent.WIDTH)).astype(np.float32))
    every = np.arange(maxent.CLASSES)
    features = [np.full(maxent.CLASSES, r) for r in (3, 77, 900, 4)]
    outer, inner = model.forward(features, every)
    assert (outer[every, every // maxent.GROUP] * inner[every, every % maxent.GROUP]).sum() == pytest.approx(1, rel=1e-5)


class Plain:
    """The model read word by word from its weights, by the definition."""

    def __init__(self, trained, train):
        self.t = trained
        self.counts = Counter(w for _, t in train for w in [*(t or "").encode().lower().split(), b""])
        self.singles = dict(zip(trained.singles.tolist(), trained.single_classes.tolist()))
        words = [w for w in self.counts if xxhash.xxh3_64_intdigest(w) not in self.singles]
        once, twice = (sum(self.counts[w] == n for w in words) for n in (1, 2))
        self.discount = (once + 0.5) / (once + 2 * twice + 1)
        self.total, self.distinct = Counter(), Counter()
        for w in words:
            self.total[self.class_of(w)] += self.counts[w]
            self.distinct[self.class_of(w)] += 1

    def class_of(self, word):
        code = (word[-1] if word else 32) * 256 + (word[-2] if len(word) > 1 else 32)
        form = int(self.t.forms[code * int(maxent.M1) % 2**64 >> 53])
        return self.singles.get(xxhash.xxh3_64_intdigest(word), maxent.SINGLES + form)

    def rows(self, history):
        classes = [self.class_of(w) for w in history]
        c1, c2 = ([maxent.START] * 2 + classes)[-1:-3:-1]
        last = next((c for c in reversed(classes) if c < maxent.SINGLES), maxent.START)
        w1 = xxhash.xxh3_64_intdigest(history[-1]) if history else maxent.START
        for kind, key in enumerate((c1, c1 * 1009 + c2, last, w1)):
            x = (key + (kind + 1) * int(maxent.M2)) * int(maxent.M1) % 2**64
            yield ((x ^ x >> 32) * int(maxent.M2) % 2**64) >> 64 - (len(self.t.weights).bit_length() - 1)

    def classes_after(self, history):
        """P(class | history) of all classes."""
        totals = self.t.totals.astype(float) + 0.5
        weights = sum(self.t.weights[r].astype(float) for r in self.rows(history))
        groups = totals.reshape(maxent.GROUPS, maxent.GROUP).sum(1)
        outer = groups / groups.sum() * np.exp(weights[: maxent.GROUPS])
        inner = (totals * np.exp(weights[maxent.GROUPS :])).reshape(maxent.GROUPS, maxent.GROUP)
        return (outer / outer.sum())[:, None] * (inner / inner.sum(1, keepdims=True))

    def share(self, word):
        """P(word | class); of a word never seen, the unseen event's."""
        c = self.class_of(word)
        if c < maxent.SINGLES:
            return 1.0
        part = self.counts[word] - self.discount if word in self.counts else self.discount * self.distinct[c] + 1
        return part / (self.total[c] + 1)

    def tokens(self, text):
        words = [*(text or "").encode().lower().split(), b""]
        return [(w, math.log10(self.classes_after(words[:i]).reshape(-1)[self.class_of(w)] * self.share(w))) for i, w in enumerate(words)]


def documents(folder=DATA):
    return [tuple(r) for r in duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet' ORDER BY doc_id").fetchall()]


@pytest.mark.skipif(not os.path.isdir(LARGER), reason="no test tables")
@pytest.mark.parametrize("head", [1 << 20, 40])
def test_scores_against_a_plain_reading(spark, head):
    sample = documents(LARGER)
    train = [r for r in sample if r[0] % 7]
    trained = maxent.Trained(spark.createDataFrame(train, "doc_id long, text string").repartition(3), head=head)
    plain_model = Plain(trained, train)
    held = [(i, (t or "")[:1500]) for i, t in sample if i % 7 == 0] + [(-1, None), (-2, "zzzz zzzz qqqq")]
    got = {r.doc_id: r.score for r in maxent.score(spark.createDataFrame(held, "doc_id long, text string"), trained).collect()}
    kinds = {"single": [0.0, 0.0], "other": [0.0, 0.0], "unseen": [0.0, 0.0]}
    n, v = sum(plain_model.counts.values()), len(plain_model.counts)
    for i, t in held:
        each = plain_model.tokens(t)
        assert got[i] == pytest.approx(sum(x for _, x in each), rel=1e-4)
        for w, x in each:
            kind = "unseen" if w not in plain_model.counts else "single" if plain_model.class_of(w) < maxent.SINGLES else "other"
            kinds[kind][0] += x
            kinds[kind][1] += math.log10((plain_model.counts[w] + 1) / (n + v + 1))
    assert all(model > base for model, base in kinds.values()), kinds


def test_known_words_and_unseen_events_sum_to_one(spark):
    train = [r for r in rows() if r[0] is None or r[0] < 1000]
    trained = maxent.Trained(spark.createDataFrame(train, "doc_id long, text string"), head=20)
    model = Plain(trained, train)
    for history in ([], [b"the"], [b"das", b"abcd"], [b"never", b"seen"], [b"of", b"of", b"is"]):
        classes = model.classes_after(history).reshape(-1)
        known = sum(classes[model.class_of(w)] * model.share(w) for w in model.counts)
        unseen = sum(classes[c] * (model.discount * model.distinct[c] + 1) / (model.total[c] + 1) for c in range(maxent.SINGLES, maxent.CLASSES))
        empty = sum(classes[c] for c in range(maxent.SINGLES) if c not in {model.class_of(w) for w in model.counts})
        assert known + unseen + empty == pytest.approx(1, rel=1e-6) and empty < 0.2


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_scores_do_not_depend_on_partitions(spark):
    sample = documents()
    held = spark.createDataFrame(sample[:40], "doc_id long, text string")
    got = []
    for n in (1, 4):
        frame = spark.createDataFrame(sample, "doc_id long, text string").repartition(n)
        got.append([r.score for r in maxent.score(held, maxent.Trained(frame, shard=1 << 17)).orderBy("doc_id").collect()])
    assert got[0] == pytest.approx(got[1], rel=1e-5)


def test_more_equal_counts_than_the_head_holds(spark):
    text = " ".join(f"word{i}" for i in range(300))
    frame = spark.createDataFrame([(i, text) for i in range(4)], "doc_id long, text string")
    small, large = (maxent.Trained(frame, rounds=1, head=h) for h in (5, 1 << 20))
    assert len(small.keys) == 0 and len(large.keys) == 301
    assert len(small.singles) == len(large.singles) == maxent.SINGLES - 1 and (small.singles == large.singles).all()
    a, b = (maxent.score(frame, t).first().score for t in (small, large))
    assert a == pytest.approx(b, rel=1e-9)


def test_forms_are_split_by_neighbours():
    words = [f"{x}{y}".encode() for x in "ab" for y in "cdefgh"]
    text = []
    draw = random.Random(1)
    for _ in range(400):
        text += draw.choices(words[:6], k=9) if draw.random() < 0.5 else draw.choices(words[6:], k=9)
    forms = maxent.forms_by_neighbours(maxent.around_of(maxent.codes_of(text)))
    assert len(set(forms[maxent.codes_of(words)].tolist())) == 12 and forms.max() < maxent.FORMS
    assert not maxent.forms_by_neighbours(np.zeros((maxent.CODES, 2 * maxent.AROUND), np.int64)).any()


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    trained = maxent.Trained(empty)
    assert maxent.score(empty, trained).collect() == []
    got = maxent.score(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), trained).first()
    assert (got.n_tokens, got.n_known, got.train_tokens, got.base_score) == (3, 0, 0, 0.0)


def test_score_does_not_depend_on_the_head(spark):
    sample = rows()
    frame = spark.createDataFrame(sample, "doc_id long, text string").coalesce(1)
    wanted = None
    for head in (1 << 20, 6, 0):
        trained = maxent.Trained(frame, rounds=1, head=head)
        assert len(trained.keys) <= head and len(trained.singles) == maxent.SINGLES - 1
        got = sorted(((r.doc_id or -1, r.n_tokens), r.score) for r in maxent.score(frame, trained).collect())
        wanted = wanted or got
        assert [k for k, _ in got] == [k for k, _ in wanted]
        assert [x for _, x in got] == pytest.approx([x for _, x in wanted], rel=1e-6)
