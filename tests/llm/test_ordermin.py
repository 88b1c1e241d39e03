"""Order MinHash against its definition, and the next document against a sorted list."""

import hashlib
import random

from quernstone.llm import ordermin


def mixed(x):
    x = (x ^ x >> 30) * int(ordermin.M2) % 2**64
    x = (x ^ x >> 27) * int(ordermin.M3) % 2**64
    return x ^ x >> 31


def plain_kmers(text):
    """Windows of six characters, each hashed with how often it came before."""
    windows = [text[i : i + ordermin.K] for i in range(max(1, len(text) - ordermin.K + 1))] if text else []
    out = []
    for i, window in enumerate(windows):
        x = 0
        for c in window:
            x = (x ^ ord(c) + 1) * int(ordermin.M1) % 2**64
            x ^= x >> 29
        out.append(mixed((x + windows[:i].count(window) * int(ordermin.M2)) % 2**64))
    return out


def plain(text):
    """The definition, one k-mer at a time."""
    values = plain_kmers(text)
    out = ""
    for a in ordermin.MULTIPLIERS.tolist():
        chosen = sorted(sorted(range(len(values)), key=lambda i: values[i] * a % 2**64)[: ordermin.PICK])
        hashed = 0
        for i in chosen:
            hashed = mixed((hashed * int(ordermin.M1) + values[i]) % 2**64)
        out += f"{hashed >> 32:08x}"
    return out


def test_fingerprint():
    draw = random.Random(1)
    for n in (1, 3, 6, 7, 8, 40, 300):
        text = "".join(draw.choices("abé ", k=n))
        assert ordermin.kmers(text).tolist() == plain_kmers(text)
        assert ordermin.fingerprint(text) == plain(text)
    assert ordermin.fingerprint("") == "" and ordermin.likeness("", "") == 1 and ordermin.likeness("", plain("a")) == 0
    assert len(set(ordermin.kmers("aaaaaaaaaa").tolist())) == 5
    assert len(ordermin.fingerprint("x" * 300_000)) == ordermin.LENGTH


def test_likeness_falls_with_edits_and_with_order():
    draw = random.Random(2)
    words = ["".join(draw.choices("abcdefghij", k=6)) for _ in range(400)]
    likeness = lambda a, b: ordermin.likeness(ordermin.fingerprint(" ".join(a)), ordermin.fingerprint(" ".join(b)))
    few, many = list(words), list(words)
    for i in range(5):
        few[i * 70] = "q"
    for i in range(100):
        many[i * 4] = "q"
    assert likeness(words, few) > likeness(words, many)
    assert likeness(words, few) > likeness(words, words[200:] + words[:200]) > 0.2


def test_next_document(spark):
    draw = random.Random(3)
    rows = [(i * 3, "".join(draw.choices("abc d", k=draw.randrange(0, 90)))) for i in range(150)]
    rows += [(9, "zweite"), (None, "null id"), (1000, None), (1001, "long " * 30000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).selectExpr("*", "1 as id", "2 as bucket", "true as head")
    order = sorted((-1 if i is None else i, t or "") for i, t in rows)
    want = []
    for (i, t), (_, following) in zip(order, order[1:] + order[:1]):
        n = len(t) // 4
        changed = t[: len(t) - n] + following[:n]
        prints = [ordermin.fingerprint(x) for x in (t, changed, following)]
        want.append((i, len(t), hashlib.sha256(changed.encode()).hexdigest(), *prints[:2], ordermin.likeness(*prints[:2]), ordermin.likeness(prints[0], prints[2])))
    for buckets in (1, 7, None):
        got = [(-1 if r[0] is None else r[0], *r[1:]) for r in ordermin.compare_with_next(frame, buckets=buckets).collect()]
        assert sorted(got) == sorted(want)
    assert ordermin.compare_with_next(frame.limit(0)).collect() == []
    assert ordermin.compare_with_next(frame.where("doc_id = 1001")).first().near_next == 1.0
    assert ordermin.fingerprints(frame).count() == len(rows)


def test_a_hot_id_is_dealt_by_its_texts(spark):
    draw = random.Random(5)
    rows = [(None if i % 3 else i, "".join(draw.choices("abc", k=draw.choice([2, 12, 90])))) for i in range(400)] + [(7, "same text " * 9)] * 150 + [(2**63 - 1, "last"), (2**63 - 1, "other")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    order = sorted((-1 if i is None else i, t) for i, t in rows)
    want = []
    for (i, t), (_, following) in zip(order, order[1:] + order[:1]):
        n = len(t) // 4
        changed = t[: len(t) - n] + following[:n]
        want.append((i, len(t), hashlib.sha256(changed.encode()).hexdigest(), plain(t)))
    for buckets in (9, None):
        got = [(-1 if r[0] is None else r[0], *r[1:4]) for r in ordermin.compare_with_next(frame, buckets=buckets).collect()]
        assert sorted(got) == sorted(want)
    source = frame.selectExpr("coalesce(doc_id, -9223372036854775808) id", "text", "substring(text, 1, 64) head")
    cuts, inside = ordermin._cuts(source, 9)
    assert -(2**63) in inside and len(inside[-(2**63)]) >= 2 and len(cuts) <= 36
