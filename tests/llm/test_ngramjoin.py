"""Keys, bounds and tiles of the n-gram join against plain sets; frames against all pairs."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from quernstone.llm import ngramjoin
from quernstone.llm.neardup import enough


def a_set(draw, n):
    return np.unique(np.array([draw.randrange(1 << 64) for _ in range(n)], np.uint64))


def changed(draw, values, less, more):
    return np.unique(np.array(draw.sample(values.tolist(), len(values) - less) + [draw.randrange(1 << 64) for _ in range(more)], np.uint64))


@pytest.mark.parametrize("percent", [50, 80, 85, 95, 100])
def test_bands_cover_all_links(percent):
    for n in range(1, 600):
        k, high = ngramjoin.band_of(n, percent), 100 * n // percent
        assert ngramjoin.band_of(high, percent) in (k, k + 1)
        for m in range(n, high + 1):
            shared = -(-percent * (n + m) // (100 + percent))
            if shared <= n:
                assert n + m - 2 * shared <= ngramjoin.differences(k, percent)


@pytest.mark.parametrize("percent", [60, 80, 85])
def test_linked_sets_have_a_key_in_common(percent):
    draw, linked = random.Random(percent), 0
    for _ in range(1500):
        x = a_set(draw, draw.choice([draw.randrange(1, 30), draw.randrange(1, 900)]))
        most = int(len(x) * (100 - percent) / 100)
        y = changed(draw, x, draw.randrange(most + 1), draw.randrange(most + 1))
        shared = ngramjoin.common_values(x, y)
        assert shared == len(np.intersect1d(x, y))
        bound = ngramjoin.overlap_bound(len(x), ngramjoin.bitmap(x), len(y), ngramjoin.bitmap(y))
        assert shared <= bound <= min(len(x), len(y))
        if len(y) and enough(shared, len(x), len(y), percent) and shared < max(len(x), len(y)):
            linked += 1
            for parts in (ngramjoin.PARTS, None):
                assert set(ngramjoin.posted_keys(x, percent, parts).tolist()) & set(ngramjoin.posted_keys(y, percent, parts).tolist())
    assert linked > 300


def test_bitmaps_bound_unlike_sets_well_below_a_link():
    draw = random.Random(1)
    for n in (100, 1000, 5000):
        x, y = a_set(draw, n), a_set(draw, n)
        assert ngramjoin.overlap_bound(n, ngramjoin.bitmap(x), n, ngramjoin.bitmap(y)) < 0.8 * n


@pytest.mark.parametrize("every", [True, False])
def test_tiles_against_all_pairs(every):
    draw = random.Random(2)
    base = [a_set(draw, 60) for _ in range(4)]
    sets = [changed(draw, draw.choice(base), draw.randrange(9), draw.randrange(9)) for _ in range(80)]
    ids, maps = list(range(80)), [ngramjoin.bitmap(s) for s in sets]
    for sides in ([0] * 80, [i % 2 for i in ids]):
        pairs = [(i, j) for i in ids for j in ids if i < j and (len(set(sides)) == 1 or sides[i] != sides[j])]
        want = {(i, j) for i, j in pairs if enough(ngramjoin.common_values(sets[i], sets[j]), len(sets[i]), len(sets[j]), 85)}
        got = ngramjoin.tile_links(ids, sides, ids, sets, maps, 85, every)
        assert len(got) == len(set(got)) and set(got) <= want
        assert set(got) == want if every else joined(ids, got) == joined(ids, want)
        assert want


def joined(ids, links):
    label = {i: i for i in ids}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(rows, width, percent):
    """Number of n-grams and component of each row, by all pairs; and the linked pairs of different sets."""
    sets = []
    for _, text in rows:
        words = words_of(text)
        sets.append(frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))) if words else frozenset())
    links, different = [], set()
    for i, x in enumerate(sets):
        for j in range(i):
            if rows[i][0] is not None and rows[j][0] is not None and x and sets[j] and 100 * len(x & sets[j]) >= percent * len(x | sets[j]):
                links.append((j, i))
                if x != sets[j]:
                    different.add(frozenset((x, sets[j])))
    label = joined(range(len(rows)), links)
    least = defaultdict(list)
    for i, root in label.items():
        least[root].append(rows[i][0])
    return [(rows[i][0], len(sets[i]), None if rows[i][0] is None else min(least[label[i]])) for i in range(len(rows))], len(different)


def documents(seed, n=240):
    draw, rows = random.Random(seed), []
    frame = [f"frame{i}" for i in range(40)]
    while len(rows) < n:
        kind = draw.random()
        if kind < 0.2:  # short texts, with copies that lack or change a word
            words = [f"w{draw.randrange(300)}" for _ in range(draw.randrange(1, 14))]
        elif kind < 0.5:  # a frame that many share
            words = frame + [f"u{draw.randrange(10_000)}" for _ in range(draw.randrange(30))]
        else:
            words = [f"v{draw.randrange(10_000)}" for _ in range(draw.randrange(60, 700))]
        for _ in range(draw.choice([1, 2, 6])):
            copy = list(words)
            for _ in range(draw.randrange(1 + len(words) // 40 + (len(words) < 20))):
                copy[draw.randrange(len(copy))] = f"x{draw.randrange(10_000)}"
            rows.append((len(rows) + 10, draw.choice([" ", "  ", "\n"]).join(copy)))
    rows += [(1, None), (2, ""), (3, " \t"), (None, rows[0][1]), (rows[5][0], rows[9][1]), rows[7], (500, "one two"), (501, "One TWO"), (502, "one two three")]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "width", "percent", "long"), [(1, 4, 85, 8), (2, 5, 80, 1024), (3, 4, 85, 1)])
def test_frames_against_all_pairs(spark, monkeypatch, seed, width, percent, long):
    monkeypatch.setattr(ngramjoin, "LONG", long)
    monkeypatch.setattr(ngramjoin, "BLOCK_ROWS", 8)
    rows = documents(seed)
    frame = spark.createDataFrame([(t, i, "z") for i, t in rows], "text string, doc_id long, TEXT string").repartition(3)
    join = ngramjoin.Join(frame, width=width, percent=percent)
    got = [tuple(r) for r in join.components().collect()]
    want, links = plain(rows, width, percent)
    order = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(got, key=order) == sorted(want, key=order)
    pairs = [tuple(r) for r in join.links().collect()]
    assert len(pairs) == len(set(pairs)) == links > 20


def test_copies_with_changes_of_their_own_join_at_their_base(spark):
    draw = random.Random(9)
    base = [f"b{i}" for i in range(400)]
    copies = [base[:i] + ["x%d" % draw.randrange(10**6)] * 6 + base[i + 6 :] + [f"y{draw.randrange(10**6)}" for _ in range(12)] for i in draw.sample(range(394), 150)]
    rows = list(enumerate(map(" ".join, [*copies[:75], base, *copies[75:]])))
    got = ngramjoin.Join(spark.createDataFrame(rows, "doc_id long, text string")).components().collect()
    assert {r.component_id for r in got} == {0} and plain(rows, 4, 85)[0] == sorted((r.doc_id, r.n_shingles, r.component_id) for r in got)


def test_an_empty_table(spark):
    join = ngramjoin.Join(spark.createDataFrame([], "doc_id long, text string"))
    assert join.components().collect() == [] and join.links().collect() == []
