"""Near duplicates against all pairs, on a small fixture."""

import itertools
import random

import numpy as np
import pytest

from quernstone.llm import neardup
from quernstone.llm.components import connected
from quernstone.llm.neardup import near_duplicates


def brute(rows, width, percent):
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        n = max(1, len(words) - width + 1)
        sets.append({tuple(words[i : i + width]) for i in range(n)} if words else set())
    least = [i for i, _ in rows]
    label = list(range(len(rows)))
    find = lambda x: x if label[x] == x else find(label[x])
    for x in range(len(rows)):
        for y in range(x):
            shared = len(sets[x] & sets[y])
            if shared and 100 * shared >= percent * len(sets[x] | sets[y]):
                label[find(x)] = find(y)
    best = {}
    for x in range(len(rows)):
        best[find(x)] = min(best.get(find(x), least[x]), least[x])
    return sorted((rows[x][0], len(sets[x]), best[find(x)], best[find(x)] == rows[x][0]) for x in range(len(rows)))


def fixture():
    draw = random.Random(8)
    vocabulary = [f"w{i}" for i in range(60)]
    rows, number = [], 0
    for family in range(12):
        base = draw.choices(vocabulary, k=draw.choice([2, 3, 5, 9, 40, 150, 400]))
        for _ in range(draw.randrange(1, 14)):
            words = list(base)
            for _ in range(draw.randrange(0, 1 + len(words) // 14 + 2)):
                words[draw.randrange(len(words))] = draw.choice(vocabulary)
            rows.append((number, " ".join(words).upper() if draw.random() < 0.3 else "\n".join(words)))
            number += draw.randrange(1, 3)
    frame = draw.choices(vocabulary, k=60)
    rows += [(number + i, " ".join(frame + draw.choices(vocabulary, k=40 + 3 * i))) for i in range(20)]
    return [*rows, (9001, None), (9002, ""), (9003, " \n"), (9004, "x"), (9005, "X "), (9006, "long " * 3000 + "a"), (9007, "long " * 3000 + "b"), rows[3]]


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
@pytest.mark.parametrize("long", [128, 1])
def test_against_all_pairs(spark, monkeypatch, width, percent, long):
    monkeypatch.setattr(neardup, "LONG", long)
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 5 if long == 1 else 1024)
    rows = fixture()
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).selectExpr("*", "1 as id", "'k' as key", "2 as n")
    got = near_duplicates(frame, width=width, percent=percent)
    assert sorted(map(tuple, got.collect())) == brute(rows, width, percent)


def test_block_links():
    draw = np.random.default_rng(1)
    base = draw.integers(0, 2**62, 300).astype(np.uint64)
    sets = [np.unique(np.concatenate((base[draw.permutation(300)[: draw.integers(250, 300)]], draw.integers(0, 2**62, 5).astype(np.uint64)))) for _ in range(150)]
    label = list(range(150))
    find = lambda x: x if label[x] == x else find(label[x])
    for a, b in neardup.block_links(np.arange(150), np.arange(150), sets, 85):
        shared = len(np.intersect1d(sets[a], sets[b]))
        assert neardup.enough(shared, len(sets[a]), len(sets[b]), 85) and find(a) != find(b)
        label[find(a)] = find(b)
    for a in range(150):
        for b in range(a):
            if neardup.enough(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b]), 85):
                assert find(a) == find(b)


def test_chain_and_edges(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(200, 100), (100, 300)], "a long, b long")
    assert {r.id: r.component for r in connected(links).collect()} == {i: 1 for i in range(1, 61)} | {100: 100, 200: 100, 300: 100}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(empty).collect() == []
    alone = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (5, "a b c d")], "doc_id long, text string")
    assert sorted((r.doc_id, r.component_id, r.kept) for r in near_duplicates(alone).collect() if r.doc_id) == [(5, 5, True)]


def test_small_sets_share_a_run():
    draw = np.random.default_rng(3)
    for percent in (50, 65, 80, 85):
        for _ in range(3000):
            shared, a, b = int(draw.integers(1, 40)), int(draw.integers(0, 8)), int(draw.integers(0, 3))
            values = draw.integers(0, 2**62, shared + a + b).astype(np.uint64)
            x, y = np.sort(values[: shared + a]), np.sort(np.concatenate((values[:shared], values[shared + a :])))
            if a + b and neardup.enough(shared, len(x), len(y), percent):
                assert len(np.intersect1d(neardup.run_keys(x, percent), neardup.run_keys(y, percent)))


@pytest.mark.parametrize("percent", [80, 85])
def test_no_order_of_small_sets_loses_a_run(percent):
    """All linked sets of up to 12 values, in all orders of their hashes."""
    for n, m in itertools.combinations_with_replacement(range(1, 13), 2):
        for shared in range(1, n + 1):
            a, b = n - shared, m - shared
            if not a + b or not neardup.enough(shared, n, m, percent):
                continue
            every = range(shared + a + b)
            for others in itertools.combinations(every, a + b):
                for left in itertools.combinations(others, a):
                    x = np.array([i for i in every if i not in others or i in left], np.uint64)
                    y = np.array([i for i in every if i not in left], np.uint64)
                    assert set(neardup.run_keys(x, percent).tolist()) & set(neardup.run_keys(y, percent).tolist()), (n, m, shared, others, left)


@pytest.mark.parametrize("long", [128, 3])
def test_frames_with_own_parts(spark, monkeypatch, long):
    """Documents of one frame, some alike enough by their sizes and most not."""
    monkeypatch.setattr(neardup, "LONG", long)
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 7)
    draw = random.Random(11)
    frame = [f"f{i}" for i in range(60)]
    rows = [(i, " ".join(frame + [f"d{i}x{j}" for j in range(draw.choice([4, 8, 9, 10, 12, 13, 14]))])) for i in range(60)]
    rows += [(100 + i, " ".join(draw.sample(frame, 3) + frame[3:] + [f"e{i}"])) for i in range(20)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted(map(tuple, got.collect())) == brute(rows, 5, 80)


def test_nine_words_and_eight(spark):
    rows = []
    for i in range(200):
        words = [f"t{i}x{j}" for j in range(9)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[1:] if i % 2 else words[:-1]))]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted(map(tuple, got.collect())) == brute(rows, 5, 80)


def test_repeated_ids(spark):
    draw = random.Random(4)
    rows = []
    for i in range(12):
        one, two = (draw.choices([f"w{j}" for j in range(500)], k=60) for _ in range(2))
        rows += [(10 * i, " ".join(one)), (10 * i, " ".join(two)), (10 * i + 1, " ".join([*one, "x"])), (10 * i + 2, " ".join([*two, "y"]))]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted(map(tuple, got.collect())) == brute(rows, 5, 80)
