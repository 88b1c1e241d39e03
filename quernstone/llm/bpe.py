"""Byte-level BPE encoding and decoding with contiguous rank arrays.

A word's part ids and the ranks of its adjacent pairs are held in contiguous
arrays. The least rank is found by a scan, its boundary deleted, and the two
neighbouring ranks refreshed, until no pair has a rank. Words of one length
form a matrix and take each of these steps together; words of more than
SHORT bytes go through a heap, whose work grows as n log n.

Defined results: a null text is the empty text; an empty text has no ids and
decodes to the empty text; the literal of a special token becomes its id, as
the library does by default; rows, repeated ones too, are encoded one by one;
columns other than those named are not read. A vocabulary with a normaliser,
another pre-tokenizer or other model settings is refused.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quernstone.llm.common import only, read_vocabulary, text_chunks, tidied

#: Fixed value: the split of the byte-level pre-tokenizer.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SHORT = 48
NONE = np.int32(2**31 - 1)
#: Words a worker remembers before it starts afresh, and their bytes; a longer word is encoded each time it comes.
REMEMBERED, REMEMBERED_BYTES = 150_000, 8 << 20
LONGEST = 4096
#: Fixed value: the pre-tokenizer that SPLIT is written for.
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies, to the byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class RankArrayCodec:
    """Encodes and decodes with a byte-level BPE vocabulary in the JSON form of the tokenizers library."""

    def __init__(self, data: bytes):
        import regex

        spec = json.loads(data)
        model, split = spec["model"], spec["pre_tokenizer"] or {}
        unlike = [name for name in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(name)]
        unlike += [x["content"] for x in spec["added_tokens"] if x["single_word"] or x["lstrip"] or x["rstrip"] or x["normalized"]]
        if model.get("type") != "BPE" or spec["normalizer"] is not None or any(split.get(name) != value for name, value in BYTE_LEVEL.items()) or unlike:
            raise ValueError(f"not the byte-level BPE that is handled: {model.get('type')}, {spec['normalizer']}, {split}, {unlike}")
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        alphabet = byte_alphabet()
        added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        size = max(chain(vocab.values(), added.values())) + 1
        self.pieces: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.pieces[i] = bytes(alphabet[c] for c in token)
        for token, i in added.items():
            self.pieces[i] = token.encode()
        self.ints = list(range(size))
        self.size = size
        self.byte_ids = np.zeros(256, np.int32)
        for char, byte in alphabet.items():
            self.byte_ids[byte] = vocab[char]
        pairs = [m if isinstance(m, (list, tuple)) else m.split(" ") for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        keys = left * size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.key_ranks = keys[order], order.astype(np.int32)
        self.rank_of = dict(zip(keys.tolist(), range(len(keys))))
        every = np.arange(256)
        self.first = self.ranks(np.repeat(self.byte_ids, 256), np.tile(self.byte_ids, 256)).reshape(256, 256)[every]
        self.split = regex.compile(SPLIT).findall
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.added = {token: (i,) for token, i in added.items()}
        self.known: dict[str, tuple[int, ...]] = dict(self.added)
        self.held = 0

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids, NONE for pairs that don't merge."""
        keys = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == keys, self.key_ranks[at], NONE)

    def merge_matrix(self, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """words: bytes of words of one length, a row each. Yields the rows that end together and their ids."""
        rows = np.arange(len(words))
        parts = self.byte_ids[words]
        ranks = self.first[words[:, :-1], words[:, 1:]]
        while parts.shape[1] > 1 and len(rows):
            at = ranks.argmin(1)
            least = ranks[np.arange(len(rows)), at]
            ended = least == NONE
            if ended.any():
                yield rows[ended], parts[ended]
                go = ~ended
                rows, parts, ranks, at, least = rows[go], parts[go], ranks[go], at[go], least[go]
                if not len(rows):
                    return
            n, width = parts.shape
            each, new = np.arange(n), self.made[least]
            columns = np.arange(width - 1)
            parts = np.take_along_axis(parts, columns + (columns > at[:, None]), 1)
            parts[each, at] = new
            if width == 2:
                break
            columns = np.arange(width - 2)
            ranks = np.take_along_axis(ranks, columns + (columns >= at[:, None]), 1)
            near = np.flatnonzero(at > 0)
            ranks[near, at[near] - 1] = self.ranks(parts[near, at[near] - 1], new[near])
            near = np.flatnonzero(at < width - 2)
            ranks[near, at[near]] = self.ranks(new[near], parts[near, at[near] + 1])
        if len(rows):
            yield rows, parts

    def merge_long(self, word: bytes) -> tuple[int, ...]:
        """The same merges for one long word: pairs wait in a heap by rank, then place."""
        parts = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        size, rank_of, made = self.size, self.rank_of, self.made
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := rank_of.get(parts[i] * size + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = int(made[rank]), -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank_of.get(parts[i] * size + parts[k])) is not None:
                    heapq.heappush(heap, (r, i, parts[i], parts[k]))
            if (h := before[i]) >= 0 and (r := rank_of.get(parts[h] * size + parts[i])) is not None:
                heapq.heappush(heap, (r, h, parts[h], parts[i]))
        return tuple(x for x in parts if x >= 0)

    def learn(self, words: list[str]) -> None:
        """Encodes words that aren't known yet."""
        ints, by_length = self.ints, {}
        for word in words:
            data = word.encode()
            if len(data) > SHORT:
                self.known[word] = self.merge_long(data)
            else:
                by_length.setdefault(len(data), []).append((word, data))
        for length, group in by_length.items():
            matrix = np.frombuffer(b"".join(data for _, data in group), np.uint8).reshape(len(group), length)
            for rows, parts in self.merge_matrix(matrix):
                for row, ids in zip(rows.tolist(), parts.tolist()):
                    self.known[group[row][0]] = tuple([ints[i] for i in ids])

    def words(self, text: str) -> list[str]:
        if self.specials is None or not any(token in text for token in self.added):
            return self.split(text)
        return list(chain.from_iterable([part] if part in self.added else self.split(part) for part in self.specials.split(text)))

    def encode_all(self, texts: Iterable[str]) -> list[list[int]]:
        split = [self.words(text) for text in texts]
        fresh = set().union(*split)
        if len(self.known) + len(fresh) > REMEMBERED + len(self.added) or self.held > REMEMBERED_BYTES:
            self.known, self.held = dict(self.added), 0
        fresh.difference_update(self.known)
        self.learn(list(fresh))
        self.held += sum(map(len, fresh))
        find = self.known.__getitem__
        out = [list(chain.from_iterable(map(find, words))) for words in split]
        for word in [w for w in fresh if len(w) > LONGEST]:
            del self.known[word]
            self.held -= len(word)
        return out

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.pieces.__getitem__, ids)).decode("utf-8", "replace")


_codecs: dict[int, RankArrayCodec] = {}


def codec_of(data: bytes) -> RankArrayCodec:
    """One codec for each vocabulary and Python worker."""
    import zlib

    key = zlib.crc32(data)
    if key not in _codecs:
        _codecs[key] = RankArrayCodec(data)
    return _codecs[key]


def encode(frame: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", per_row: Callable[[RankArrayCodec, str, list[int]], dict] | None = None, schema: T.StructType | None = None) -> DataFrame:
    """Each row's id and token ids (`ids` array<int>); or, with per_row, the columns that it makes of codec, text and ids."""
    frame = only(frame, id_col, text_col)
    data = frame.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    source = frame.select(frame[f"`{id_col}`"].alias("id"), frame[f"`{text_col}`"].cast("string").alias("text"))
    made = schema or T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType()))])
    out = T.StructType([T.StructField(id_col, frame.schema[id_col].dataType), *made.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        codec, arrow = codec_of(data.value), to_arrow_schema(out)
        for batch in batches:
            for part, texts in text_chunks(batch, budget=2 << 20):
                encoded = codec.encode_all(texts)
                rows = [per_row(codec, text, ids) for text, ids in zip(texts, encoded)] if per_row else [{"ids": ids} for ids in encoded]
                columns = [part.column("id"), *[pa.array([row[f.name] for row in rows], arrow.field(f.name).type) for f in made.fields]]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return source.mapInArrow(tidied(run), out)


def decode(frame: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Each row's id and the text of its token ids; null ids decode to the empty text."""
    frame = only(frame, id_col, ids_col)
    data = frame.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    source = frame.select(frame[f"`{id_col}`"].alias("id"), frame[f"`{ids_col}`"].alias("ids"))
    out = T.StructType([T.StructField(id_col, frame.schema[id_col].dataType), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(data.value)
        for batch in batches:
            texts = [codec.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], names=[id_col, "text"])

    return source.mapInArrow(tidied(run), out)
