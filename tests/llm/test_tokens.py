"""BPE and token counts against the public library, and their defined edge cases."""

import json
import random

import pytest
from pyspark.sql import types as T
from tokenizers import Tokenizer

from quernstone.llm import bpe, transducer
from quernstone.llm.common import tokenizer_path

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("ids", T.StringType()), T.StructField("id", T.StringType())])


def texts(n=2000):
    draw = random.Random(5)
    pieces = list(" \n\t'''sdtlvrem!<|>aé1²٣\xa0ΣİÀ̧́😀") + ["<|endoftext|>", " the", "ing", "'ll", "　"]
    return ["", "a" * 3000, "ab" * 700 + "ing" * 90, " " * 200, "<|endoftext|>"] + ["".join(draw.choices(pieces, k=draw.randrange(60))) for _ in range(n)]


@pytest.fixture(scope="module")
def byte_level():
    path = tokenizer_path("byte_bpe_50k.json")
    return bpe.RankArrayCodec(open(path, "rb").read()), Tokenizer.from_file(path)


def test_encode_and_decode_match_the_library(byte_level):
    codec, library = byte_level
    sample = texts()
    ours = codec.encode_all(sample)
    assert ours == [x.ids for x in library.encode_batch(sample, add_special_tokens=False)]
    assert [codec.decode(x) for x in ours] == sample == [library.decode(x, skip_special_tokens=False) for x in ours]


def test_long_and_short_words_agree(byte_level):
    codec, _ = byte_level
    word = "erthhaonre"
    codec.known.pop(word, None)
    codec.learn([word])
    assert codec.known[word] == codec.merge_long(word.encode())


def test_every_code_point_counts_as_in_the_library():
    path = tokenizer_path("word_bpe_49k.json")
    counter, library = transducer.TokenCounter(open(path, "rb").read()), Tokenizer.from_file(path)
    sample = [f"a{chr(i)}b {chr(i)}1{chr(i)}!" for i in range(1, 0x3100)] + [f"x{chr(i)}" for i in range(0xA640, 0xABFF)] + texts()
    assert counter.count_all(sample).tolist() == [len(x.ids) for x in library.encode_batch(sample, add_special_tokens=False)]


def test_full_tables_change_no_count(monkeypatch):
    path = tokenizer_path("word_bpe_49k.json")
    plain = transducer.TokenCounter(open(path, "rb").read())
    monkeypatch.setattr(transducer, "STATES", 300)
    monkeypatch.setattr(transducer, "BLOCK", 100)
    tight = transducer.TokenCounter(open(path, "rb").read())
    sample = texts(300)
    assert plain.count_all(sample).tolist() == tight.count_all(sample).tolist()


def test_scan_states_do_not_depend_on_the_chunk():
    import numpy as np

    splitter = transducer.Splitter()
    points = np.frombuffer("".join(texts(50)).encode("utf-32-le"), np.uint32)
    classes = splitter.classes[points]
    state, plain = transducer.GAP, []
    for c in classes.tolist():
        state = splitter.table[c * 8 + state]
        plain.append(state)
    for chunk in (1, 7, 128, 10**6):
        assert splitter.states(classes, chunk).tolist() == plain


def test_edge_rows(spark):
    rows = [(1, None, "x", "y"), (2, "", None, None), (2, "", None, None), (None, "a b", "q", None), (3, "Wort " * 40000, None, None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    encoded = bpe.encode(frame, tokenizer_path("byte_bpe_50k.json"))
    got = {r.doc_id: r.ids for r in encoded.collect()}
    assert got[1] == [] and got[2] == [] and len(got[None]) == 2
    assert {r.doc_id: r.text for r in bpe.decode(encoded, tokenizer_path("byte_bpe_50k.json")).collect()} == {1: "", 2: "", None: "a b", 3: "Wort " * 40000}
    counted = transducer.count_tokens(frame, tokenizer_path("word_bpe_49k.json")).collect()
    assert len(counted) == 5 and {(r.doc_id, r.n_bytes, r.n_tokens) for r in counted} >= {(1, 0, 0), (2, 0, 0), (None, 3, 2)}
    assert bpe.encode(frame.limit(0), tokenizer_path("byte_bpe_50k.json")).count() == 0


def test_long_words_are_counted_by_chunks(monkeypatch):
    path = tokenizer_path("word_bpe_49k.json")
    counter, library = transducer.TokenCounter(open(path, "rb").read()), Tokenizer.from_file(path)
    draw = random.Random(8)
    sample = ["a" * 5000, "abc" * 1500, "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=6000)), "é" * 2000 + "ü" * 700, "x" * 2049, "the" * 700 + " the " + "ing" * 900, "!" * 3000]
    want = [len(x.ids) for x in library.encode_batch(sample, add_special_tokens=False)]
    assert counter.count_all(sample).tolist() == want
    monkeypatch.setattr(transducer, "LONG", 10)
    monkeypatch.setattr(transducer, "CUT", 7)
    monkeypatch.setattr(transducer, "RUN_UP", 0)
    assert counter.count_all(sample + texts(200)).tolist() == want + [len(x.ids) for x in library.encode_batch(texts(200), add_special_tokens=False)]


def test_other_vocabularies_are_refused():
    for name, make in (("byte_bpe_50k.json", bpe.RankArrayCodec), ("word_bpe_49k.json", transducer.TokenCounter)):
        spec = json.load(open(tokenizer_path(name)))
        changes = [{"normalizer": {"type": "NFKC"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"model": {**spec["model"], "byte_fallback": True}}, {"model": {**spec["model"], "type": "WordPiece"}}, {"added_tokens": [{**spec["added_tokens"][0], "lstrip": True}]}]
        for change in changes:
            with pytest.raises(ValueError):
                make(json.dumps({**spec, **change}).encode())


def test_remembered_words_are_bounded(byte_level, monkeypatch):
    codec, library = byte_level
    long = "ab" * 5000
    assert codec.encode_all([long, "word " + long]) == [x.ids for x in library.encode_batch([long, "word " + long], add_special_tokens=False)]
    assert not any(len(w) > bpe.LONGEST for w in codec.known)
    monkeypatch.setattr(bpe, "REMEMBERED_BYTES", 100)
    for i in range(60):
        assert codec.encode_all([f"some{i} words{i}"])[0] == library.encode(f"some{i} words{i}", add_special_tokens=False).ids
        assert codec.held < 200 or i == 0
