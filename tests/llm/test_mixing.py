"""Temperature mixing against a plain realisation."""

import math
import random

import pytest
from pyspark.sql import functions as F

from quernstone.llm import mixing


def rows():
    draw = random.Random(9)
    sizes = {"big": 160, "mid": 50, "small": 12, None: 9, "": 5, "blank": 4}
    out, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            out.append((i, None if source == "blank" else "w " * draw.randrange(0, 30), source))
            i += 1
    return [*out, (0, out[0][1], "big")]


def weights(totals, budget, entropy, repeats):
    """The exponent by plain bisection."""
    total = sum(totals.values())

    def of(x):
        raised = {s: (t / total) ** x for s, t in totals.items()}
        z = sum(raised.values())
        return {s: r / z for s, r in raised.items()}

    def bisect(holds):
        low, high = 0.0, 1.0
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (middle, high) if holds(of(middle)) else (low, middle)
        return low

    h = lambda w: -sum(x * math.log(x) for x in w.values())
    most = lambda w: max(w[s] * budget / totals[s] for s in w)
    chosen = 1.0 if h(of(1.0)) >= entropy * math.log(len(totals)) else bisect(lambda w: h(w) >= entropy * math.log(len(totals)))
    if most(of(chosen)) > repeats:
        chosen = 1.0 if most(of(1.0)) > repeats else bisect(lambda w: most(w) > repeats)
    return of(chosen)


@pytest.mark.parametrize(("entropy", "repeats", "factor", "block"), [(0.9, 3.0, 1.0, 64), (1.0, 100.0, 0.5, 1 << 20), (0.95, 1.5, 1.0, 16), (0.0, 9.0, 2.7, 100), (0.5, 0.1, 1.0, 64)])
def test_against_plain(spark, entropy, repeats, factor, block):
    sample = rows()
    frame = spark.createDataFrame(sample, "doc_id long, text string, source string").repartition(3)
    places = {r.doc_id: r.p for r in frame.select("doc_id", F.xxhash64("doc_id", "text", F.lit(17)).alias("p")).collect()}
    tokens = {i: len((t or "").split()) for i, t, _ in sample}
    totals = {}
    for i, _, s in sample:
        totals[s] = totals.get(s, 0) + tokens[i]
    totals = {s: t for s, t in totals.items() if t}
    budget = factor * sum(totals.values())
    want = weights(totals, budget, entropy, repeats)
    got = mixing.mix(frame.selectExpr("*", "1 as id", "2 as tokens", "3 as key"), entropy, repeats, budget, block=block).collect()
    assert len(got) == len(sample)
    by_source = {}
    for r in got:
        assert r.tokens == tokens[r.doc_id]
        assert r.weight == pytest.approx(want.get(r.source, 0), abs=1e-5)
        by_source.setdefault(r.source, []).append(r)
    for source, members in by_source.items():
        if source not in totals:
            assert all(r.copies == 0 for r in members)
            continue
        target = round(members[0].weight * budget)
        passes = target // totals[source]
        rest = target - passes * totals[source]
        through = 0
        for r in sorted(members, key=lambda r: ((places[r.doc_id] % 2**64) >> 1, places[r.doc_id], r.doc_id)):
            through += r.tokens
            assert r.copies == passes + (0 < rest >= through), (source, r)


def test_empty_and_one_source(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(empty).collect() == []
    one = spark.createDataFrame([(1, "a b", "s"), (2, None, "s")], "doc_id long, text string, source string")
    assert {r.doc_id: (r.weight, r.copies) for r in mixing.mix(one).collect()} == {1: (1.0, 1), 2: (1.0, 1)}
