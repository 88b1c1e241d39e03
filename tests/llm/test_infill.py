"""Ropes against plain strings, and the transformation of whole frames."""

import hashlib
import random
import re

import pytest

from quernstone.llm import infill
from quernstone.llm.infill import PLAIN, PSM, SPM, joined, rearranged, rebuilt, rope, split, written

UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
PIECES = ["a", "b", " ", "\n", "é", "\x1c", "\xa0", "  ", "<P", "𝕏", "<", "word "]


def texts(n, seed=1):
    draw = random.Random(seed)
    return ["".join(draw.choice(PIECES) for _ in range(draw.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize("size", [1, 5, 2048])
def test_ropes_split_where_units_end(size):
    for text in texts(400):
        units = re.findall(UNIT, text)
        tree = rope(text, size)
        assert (tree.units, tree.chars, written(tree)) == (len(units), len(text), text)
        for rank in range(len(units) + 1):
            head, tail = split(tree, rank)
            assert (written(head), written(tail)) == ("".join(units[:rank]), "".join(units[rank:]))
            assert (head.units, tail.units, head.chars + tail.chars) == (rank, len(units) - rank, len(text))
        for at in range(0, len(text) + 1, 7):
            head, tail = split(tree, at, "chars")
            assert (written(head), written(tail)) == (text[:at], text[at:])


def test_a_split_shares_what_it_does_not_cut():
    tree = rope("word " * 10_000, 64)
    head, tail = split(tree, 5_000)
    leaves = lambda t: {id(t)} if isinstance(t, infill.Leaf) else leaves(t.left) | leaves(t.right)
    assert len((leaves(head) | leaves(tail)) - leaves(tree)) <= 2
    assert written(joined(tail, head)) == written(tail) + written(head)


def plain(text, key):
    """The contract, with lists of units."""
    digest = hashlib.sha256(f"42:{key}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    units = re.findall(UNIT, text)
    low, high = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), PLAIN, None, None, text
    if h[3] % 100 < 80:
        return len(units), SPM, len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), PSM, len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_every_output_leads_back_to_its_text():
    draw, forms = random.Random(2), set()
    for text in texts(2000, 3):
        _, form, prefix, middle, output = rearranged(text, [draw.randrange(1 << 32) for _ in range(4)], rate=90)
        assert rebuilt(output, form) == text
        forms.add(form)
        assert (form == PLAIN) == (prefix is None) == (middle is None)
    assert forms == {PLAIN, PSM, SPM}


def test_frames(spark):
    rows = [(i, t) for i, t in enumerate(texts(300, 4))] + [(300, None), (301, ""), (302, "has <S> within"), (None, "no id at all"), (7, "again seven"), (7, "again seven"), (303, "long " * 200_000)]
    frame = spark.createDataFrame([(t, i, "x", "y") for i, t in rows], "text string, doc_id long, form string, TEXT string").repartition(3)
    found = infill.restore(infill.transform(frame)).collect()
    want = sorted(((i, *plain(t or "", "" if i is None else i), t or "") for i, t in rows), key=lambda r: repr(r[0]) + r[-1])
    assert sorted(map(tuple, found), key=lambda r: repr(r[0]) + r[-1]) == want
    assert {r[2] for r in want} == {PLAIN, PSM, SPM}
    assert infill.transform(frame.limit(0)).collect() == []
    assert infill.restore(infill.transform(frame.limit(0))).columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]


@pytest.mark.parametrize("marks", [("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("aa", "b", "c"), ("<P>", "<P>x", "<M>"), ("<P>", "<S>")])
def test_sentinels_that_cannot_be_told_apart_are_refused(spark, marks):
    with pytest.raises(ValueError):
        infill.transform(spark.createDataFrame([(1, "a")], "doc_id long, text string"), sentinels=marks)
