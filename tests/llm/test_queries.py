"""Every opN query over the smallest tables, against its contract."""

import hashlib
import json
import math
import os
import zlib
from collections import Counter

import pytest
import test_exact
import test_infill
import test_neardup
import test_ngramjoin
import test_ordermin
import test_spelling
from tokenizers import Tokenizer

from quernstone.llm import queries
from quernstone.llm.common import tokenizer_path

DATA, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{DATA}/documents.parquet").orderBy("doc_id").collect()]


def run(spark, name):
    return queries.QUERIES[name](spark, DATA).collect()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def held(i, modulus, remainder):
    return zlib.crc32(str(i).encode()) % modulus == remainder


def test_op1(spark, docs):
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in run(spark, "op1_bpe")}
    ids = {i: library.encode(t, add_special_tokens=False).ids for i, t in docs}
    assert got == {i: (len(x), sha(",".join(map(str, x))), sha(library.decode(x, skip_special_tokens=False))) for i, x in ids.items()}


def test_op2(spark, docs):
    assert sorted(r.doc_id for r in run(spark, "op2_quality")) == [i for i, _ in docs]
    if not os.path.isdir(LARGER):
        return
    got = queries.QUERIES["op2_quality"](spark, LARGER).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) and r.held_out == held(r.doc_id, 5, 0) for r in got)
    out = [r for r in got if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in out) >= 0.95 * len(out) > 0


def test_op3(spark, docs):
    got = run(spark, "op3_mixing")
    assert sorted(r.doc_id for r in got) == [i for i, _ in docs]
    weights = {r.source: r.weight for r in got}
    total = sum(r.tokens for r in got)
    assert sum(weights.values()) == pytest.approx(1) and all(r.tokens == len(t.encode().split()) for r, (_, t) in zip(sorted(got, key=lambda r: r.doc_id), docs))
    for source, weight in weights.items():
        own = [r for r in got if r.source == source]
        assert -max(r.tokens for r in own) <= sum(r.copies * r.tokens for r in own) - weight * total <= 1
        assert weight * total <= 2.01 * sum(r.tokens for r in own)
    shares = [sum(r.tokens for r in got if r.source == s) / total for s in weights]
    natural, made = (-sum(w * math.log(w) for w in x if w) for x in (shares, weights.values()))
    assert made == pytest.approx((natural + math.log(len(weights))) / 2, rel=1e-6) or max(w / s for w, s in zip(weights.values(), shares)) == pytest.approx(2, rel=1e-3)
    assert {r.copies for r in got} == {0, 1, 2}


def test_op4(spark, docs):
    assert sorted(map(tuple, run(spark, "op4_near_dedup"))) == test_neardup.brute(docs, 3, 85)


def sql(name, table):
    import duckdb

    duckdb.execute(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return duckdb.sql(queries.ORACLE_SQL[name])


def test_op5(spark):
    want = sql("op5_chat", "conversations")
    got = queries.QUERIES["op5_chat"](spark, DATA).select(*want.columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())
    assert {r.status for r in got} == {"message", "call", "result", "orphan", "duplicate"} and {r.n_invalid for r in got} == {0, 1}
    assert any(r.anchor > r.turn - 3 for r in got if r.status == "result") and all(json.loads(r.message)["role"] == r.role for r in got)


def test_op6(spark, docs):
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in run(spark, "op6_exact_dedup")), key=str) == test_exact.brute(docs)


def test_op7(spark, docs):
    words = {i: [*t.encode().lower().split(), None] for i, t in docs}
    counts = Counter(w for i, _ in docs if not held(i, 7, 2) for w in words[i])
    n, v = sum(counts.values()), len(counts)
    got = run(spark, "op7_maxent")
    assert sorted(r.doc_id for r in got) == [i for i, _ in docs]
    for r in got:
        own = words[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id, 7, 2), len(own), sum(w in counts for w in own), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own), rel=1e-9) and r.score < 0
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_op8(spark, docs):
    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    library.no_truncation()
    sizes = {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in docs}
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in run(spark, "op8_token_counts")} == {i: (len(t.encode()), sizes[i], sizes[i] > 2048) for i, t in docs}


def test_op9(spark):
    want = sql("op9_warc", "pages")
    got = queries.QUERIES["op9_warc"](spark, DATA).select(*want.columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())
    assert {r.status for r in got} == {"ok", "corrupt", "missing"}


def test_op11(spark, docs):
    words = test_spelling.counted(docs)
    assert {tuple(r) for r in run(spark, "op11_spelling")} == test_spelling.plain_variants(words)


def test_op12(spark, docs):
    want = {(i, *p[:4], sha(p[4]), sha(t)) for i, t in docs for p in [test_infill.plain(t, i)]}
    assert {tuple(r) for r in run(spark, "op12_infill")} == want == set(sql("op12_infill", "documents").fetchall())


def test_op13(spark, docs):
    assert sorted(map(tuple, run(spark, "op13_ngram_join"))) == sorted(test_ngramjoin.plain(docs, 4, 85)[0])


def test_op10(spark, docs):
    got = {r.doc_id: r for r in run(spark, "op10_order_minhash")}
    assert len(got) == len(docs)
    for (i, t), (_, following) in zip(docs, docs[1:] + docs[:1]):
        n, r = len(t) // 4, got[i]
        changed = t[: len(t) - n] + following[:n]
        assert (r.n_chars, r.edited_sha256) == (len(t), sha(changed)) and 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
        if len(t) < 1500:
            assert (r.fingerprint, r.edited_fingerprint) == (test_ordermin.plain(t), test_ordermin.plain(changed))
    assert sum(r.near_edited for r in got.values()) > 5 * sum(r.near_next for r in got.values())
