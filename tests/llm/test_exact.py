"""Exact duplicates against a plain grouping."""

import hashlib
import random

from quernstone.llm.exact import PatriciaTrie, deduplicate

BLANK = " \t\n\x0b\x0c\r"


def brute(rows):
    body = lambda t: "".join(c for c in t or "" if c not in BLANK)
    groups = {}
    for i, t in rows:
        groups.setdefault(body(t), []).append((-len(t or ""), i is None, i or 0))
    out = []
    for i, t in rows:
        group = groups[body(t)]
        keep = min(group)
        keep_id = None if keep[1] else keep[2]
        out.append((i, keep_id, len(group), i == keep_id, hashlib.sha256(body(t).encode()).hexdigest()))
    return sorted(out, key=str)


def test_trie_holds_what_was_inserted():
    draw, trie, plain = random.Random(3), PatriciaTrie(), {}
    for i in range(5000):
        key = bytes(draw.choices(b"ab", k=draw.randrange(12)))
        trie.insert(key, (i % 7, False, i), 1)
        plain.setdefault(key, []).append((i % 7, False, i))
    assert {k: (o[0], o[1]) for k, o in trie.spill()} == {k: (min(v), len(v)) for k, v in plain.items()}
    assert not list(trie.spill())


def test_against_brute_force(spark):
    draw = random.Random(4)
    rows = [(i, "".join(draw.choices("ab \n", k=draw.randrange(6)))) for i in range(400)]
    rows += [(500, None), (501, ""), (502, "x" * 200_000), (503, "x " * 200_000), (None, "ab"), (7, rows[7][1]), (504, "é "), (505, "é")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).selectExpr("*", "1 as id", "'q' as sha", "2 as length")
    for held in (1, 1 << 20):
        assert sorted(map(tuple, deduplicate(frame, held=held).collect()), key=str) == brute(rows)
    assert deduplicate(frame.limit(0)).count() == 0
