"""Shared helpers, and clashing columns in every operator."""

import numpy as np
import pytest

from quernstone.llm import bpe, chat, exact, maxent, mixing, neardup, ordermin, quality, transducer, warc
from quernstone.llm.common import Marks, chunks, cleaning, discard, only, settle, shared_folder, tokenizer_path


def test_chunks_cover_everything():
    assert list(chunks([], 5)) == []
    assert list(chunks([9, 1, 1, 4, 9, 0], 5)) == [(0, 1), (1, 3), (3, 4), (4, 5), (5, 6)]


def test_settled_frames_come_back_and_go(spark):
    held = settle(spark.range(5), "held")
    assert held.count() == 5
    discard(held)
    with pytest.raises(Exception):
        spark.read.parquet(held.settled_at).count()


def test_what_is_written_within_is_deleted(spark):
    kept = settle(spark.range(3), "kept")
    with cleaning(spark):
        inner = settle(spark.range(5), "inner")
        with cleaning(spark):
            innermost = settle(spark.range(6), "innermost")
        assert inner.count() == 5
    assert kept.count() == 3
    for gone in (inner, innermost):
        with pytest.raises(Exception):
            spark.read.parquet(gone.settled_at).count()


def test_folders_need_a_shared_place_on_a_cluster(spark):
    class Conf:
        def __init__(self, **held):
            self.held = held

        def get(self, name, default=None):
            return self.held.get(name, default)

    class Session:
        def __init__(self, **held):
            self.conf = Conf(**held)

    local = Session(**{"spark.master": "local[2]", "spark.sql.warehouse.dir": "w"})
    assert shared_folder(local, "a").startswith("w/a-")
    assert shared_folder(Session(**{"spark.master": "yarn", "spark.checkpoint.dir": "c/"}), "a").startswith("c/a-")
    with pytest.raises(ValueError):
        shared_folder(Session(**{"spark.master": "yarn", "spark.sql.warehouse.dir": "w"}), "a")


def test_marks_hold_every_key(spark):
    draw = np.random.default_rng(2)
    keys = draw.integers(-(2**63), 2**63 - 1, 20_000)
    frame = settle(spark.createDataFrame([(int(k),) for k in keys], "k long"), "keys")
    marks = Marks(frame)
    test, mask = marks.tester(), (1 << marks.bits) - 1
    assert test(keys & mask).all() and test(draw.integers(-(2**63), 2**63 - 1, 20_000) & mask).mean() < 0.1
    assert not Marks(settle(frame.limit(0), "none")).tester()(keys & 0xFFFF).any()
    cells = frame.select(marks.cell(frame["k"]).alias("c")).toPandas()["c"]
    assert sorted(cells) == sorted((keys & mask).tolist())


def test_columns_that_differ_in_case_or_are_doubled(spark):
    frame = spark.createDataFrame([(1, "a b c", "s", 9, "zz")], "doc_id long, text string, source string, DOC_ID int, Text string")
    frame = frame.select("*", frame["source"].alias("source"))
    assert only(frame, "text", "doc_id").first() == ("a b c", 1)
    assert exact.deduplicate(frame).first().doc_id == 1
    assert neardup.near_duplicates(frame).first().n_shingles == 1
    assert mixing.mix(frame).first().tokens == 3
    assert bpe.encode(frame, tokenizer_path("byte_bpe_50k.json")).first().doc_id == 1
    assert transducer.count_tokens(frame, tokenizer_path("word_bpe_49k.json")).first().n_tokens == 3
    assert ordermin.fingerprints(frame).count() == ordermin.compare_with_next(frame).count() == 1
    assert maxent.score(frame, maxent.Trained(frame, rounds=1)).first().n_tokens == 4
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, QUALITY int")
    assert quality.score(frame, quality.train(frame, labels)).first().score > 0.5
    chats = spark.createDataFrame([(1, 0, "user", "hi", "x")], "conv_id long, turn long, role string, text string, ROLE string")
    assert chat.format_chats(chats).first().status == "message"
    pages = spark.createDataFrame([(1, "u", "h", "x")], "page_id long, url string, html string, HTML string")
    assert warc.records(pages).count() == 1
    with pytest.raises(ValueError):
        only(frame, "absent")
