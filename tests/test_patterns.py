"""Event sequences against a plain run over all events of a key."""

import random
from datetime import datetime, timedelta

import pytest

from quernstone.operators.patterns import sequences

START = datetime(2024, 1, 1)


def plain(rows, steps, within):
    found = []
    for key in {r[0] for r in rows} - {None}:
        own = sorted((r[1], r[2], r[3]) for r in rows if r[0] == key and r[1] is not None)
        for n, (end, last, kind) in enumerate(own):
            if kind != steps[-1]:
                continue
            chain, at = [last], n
            for step in reversed(steps[:-1]):  # the latest of each step before the one behind it
                at = next((i for i in range(at - 1, -1, -1) if own[i][2] == step), None)
                if at is None:
                    break
                chain.append(own[at][1])
            if at is not None and end - own[at][0] <= timedelta(seconds=within):
                found.append(tuple(reversed(chain)))
    return sorted(found)


@pytest.mark.parametrize("steps", [["a", "b"], ["a", "b", "c"], ["a", "b", "a"]])
@pytest.mark.parametrize("within", [30, 100, 5000])
def test_sequences(spark, steps, within):
    draw = random.Random(within)
    rows = [(draw.choice([1, 1, 1, 2, None]), draw.choice([START + timedelta(seconds=draw.randrange(2000)), None] if i % 9 == 0 else [START + timedelta(seconds=draw.randrange(2000))]), i, draw.choice(["a", "b", "c", "d", None])) for i in range(400)]
    frame = spark.createDataFrame(rows, "k long, t timestamp_ntz, i long, e string").repartition(3)
    got = sequences(frame, "k", "t", "i", "e", steps, within)
    assert got.columns == [f"{s}_{n + 1}" for n, s in enumerate(steps)]
    assert sorted(map(tuple, got.collect())) == plain(rows, steps, within) != []


def test_schemas_depend_on_arguments(spark):
    frame = spark.createDataFrame([("k", START, "x", "a")], "k string, t timestamp_ntz, i string, e string")
    assert sequences(frame, "k", "t", "i", "e", ["a", "z"], 9).schema.simpleString() == "struct<a_1:string,z_2:string>"
    with pytest.raises(Exception, match="at least two kinds"):
        sequences(frame, "k", "t", "i", "e", ["a"], 9).collect()
    with pytest.raises(ValueError):
        sequences(frame, "k", "t", "i", "e", ["a,b", "c"], 9)
