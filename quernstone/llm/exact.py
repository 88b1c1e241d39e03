"""Exact duplicates with Patricia-trie owners.

First only keys are read: each row's length and content hash. A (length, short
hash) that several rows have marks its rows, in a table of bits; all other rows
are alone and their texts go nowhere. Then each map task inserts the full byte
strings of its marked texts into a compressed radix trie, whose terminal nodes
hold the owner so far and the number of rows. The trie is bounded: when it holds
more than `held` bytes, its subtrees are spilled one by one as partial owners. So
a hot text leaves a map task in a row or a few, however often it occurs there.
Partial owners are partitioned by length and short hash and inserted into tries
again, each of which holds many texts: strings are told apart by the trie, byte
by byte, never by the hash. In order of length and hash, all strings of a key
are together; so a full trie is drained when a new key begins. Decisions are
joined back on the SHA-256 of the text, a plain equi-join of small rows, which
Spark's adaptive execution splits where a key is hot.

Defined results: a null text is empty; texts are equal when identical without
the bytes 0x20 and 0x09-0x0D; the owner is the row with most code points in its
original text, then the smallest id, a null id last, then the least 64-bit hash
of its text; kept says that a row has the owner's id, so rows that repeat it in
its group are all kept; an empty table gives an empty result; columns other than
those named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.llm.common import BLANKS, Marks, discard, only, settle, text_chunks, tidied

HELD = 64 << 20


class Node:
    __slots__ = ("label", "children", "owner")

    def __init__(self, label: bytes, owner: list | None = None):
        self.label, self.children, self.owner = label, None, owner


class PatriciaTrie:
    """Byte strings in a compressed radix trie; each has [rank of its best row, number of rows]."""

    def __init__(self, held: int = HELD):
        self.root, self.held, self.bytes = Node(b""), held, 0

    def terminal(self, key: bytes) -> Node:
        """The node of a string, made where it is missing."""
        node, at = self.root, 0
        while True:
            if at == len(key):
                return node
            children = node.children
            child = children.get(key[at]) if children else None
            if child is None:
                new = Node(key[at:])
                if children is None:
                    node.children = {}
                node.children[key[at]] = new
                self.bytes += len(new.label) + 200
                return new
            label = child.label
            if key.startswith(label, at):
                node, at = child, at + len(label)
                continue
            # the strings part within the label: halve the stretch that is known to be equal or to differ
            low, high = 1, min(len(label), len(key) - at)
            while low < high:
                middle = (low + high + 1) // 2
                if key.startswith(label[:middle], at):
                    low = middle
                else:
                    high = middle - 1
            upper = Node(label[:low])
            child.label = label[low:]
            upper.children = {child.label[0]: child}
            node.children[key[at]] = upper
            self.bytes += 200
            node, at = upper, at + low

    def insert(self, key: bytes, rank: tuple, count: int) -> None:
        """A lower rank owns."""
        node = self.terminal(key)
        if node.owner is None:
            node.owner = [rank, count]
        else:
            node.owner[0] = min(node.owner[0], rank)
            node.owner[1] += count

    def drain(self, top: Node | None = None) -> Iterator[tuple[bytes, list]]:
        stack = [(top or self.root, b"")]
        while stack:
            node, before = stack.pop()
            key = before + node.label
            if node.owner is not None:
                yield key, node.owner
            stack += [(child, key) for child in (node.children or {}).values()]

    def spill(self) -> Iterator[tuple[bytes, list]]:
        """Empties the trie subtree by subtree."""
        if self.root.owner is not None:
            yield b"", self.root.owner
        while self.root.children:
            _, child = self.root.children.popitem()
            yield from self.drain(child)
        self.root, self.bytes = Node(b""), 0


def normal(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").translate(None, BLANKS)


def rank_of(chars: int, row: int | None, text_key: int) -> tuple:
    return -chars, row is None, row or 0, text_key


def short_of(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


MEMBER = pa.schema([("id", pa.int64()), ("text_key", pa.int64()), ("length", pa.int64()), ("short", pa.int64()), ("sha", pa.binary())])
PARTIAL = pa.schema([("length", pa.int64()), ("short", pa.int64()), ("body", pa.binary()), ("chars", pa.int64()), ("owner", pa.int64()), ("owner_key", pa.int64()), ("size", pa.int64())])
OWNER = pa.schema([("sha", pa.binary()), ("keep_id", pa.int64()), ("keep_key", pa.int64()), ("group_size", pa.int64())])


def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in text_chunks(batch):
            bodies = [normal(t) for t in texts]
            digests = [hashlib.sha256(b).digest() for b in bodies]
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("text_key"), pa.array(map(len, bodies), pa.int64()), pa.array(map(short_of, digests), pa.int64()), pa.array(digests, pa.binary())], schema=MEMBER)


def _batches(rows: Iterator[tuple], schema: pa.Schema, budget: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows in batches of about `budget` bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(x) for x in row if isinstance(x, bytes))
        if size > budget:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def partial_owners(marks: Marks, held: int):
    marked, mask = marks.tester(), (1 << marks.bits) - 1

    def partials(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        trie = PatriciaTrie(held)

        def spilled() -> Iterator[tuple]:
            for body, ((minus, missing, row, key), count) in trie.spill():
                yield len(body), short_of(hashlib.sha256(body).digest()), body, -minus, None if missing else row, key, count

        for batch in batches:
            for part, texts in text_chunks(batch):
                bodies = [normal(t) for t in texts]
                shorts = np.array([short_of(hashlib.sha256(b).digest()) for b in bodies], np.int64)
                ids, keys = part.column("id").to_pylist(), part.column("text_key").to_pylist()
                for i in np.flatnonzero(marked(shorts & mask)).tolist():
                    trie.insert(bodies[i], rank_of(len(texts[i]), ids[i], keys[i]), 1)
                if trie.bytes > trie.held:
                    yield from spilled()
        yield from spilled()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(partials(batches), PARTIAL)

    return run


def merged_owners(held: int):
    def owners(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        trie, at = PatriciaTrie(held), None

        def finished() -> Iterator[tuple]:
            for body, ((_, missing, row, key), count) in trie.spill():
                if count > 1:
                    yield hashlib.sha256(body).digest(), None if missing else row, key, count

        for batch in (whole.slice(i, 256) for whole in batches for i in range(0, whole.num_rows, 256)):
            for length, short, body, chars, owner, key, size in zip(*[c.to_pylist() for c in batch.columns]):
                if (length, short) != at:
                    if trie.bytes > trie.held:
                        yield from finished()
                    at = length, short
                trie.insert(body, rank_of(chars, owner, key), size)
        yield from finished()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(owners(batches), OWNER)

    return run


def deduplicate(frame: DataFrame, id_col: str = "doc_id", text_col: str = "text", held: int = HELD, keyed: bool = False) -> DataFrame:
    """A row for each input row: id, keep_id, group_size, kept, text_sha256 of the normalised text; the id is an integer column.

    keyed: and text_key, the 64-bit hash of the text as it is, and owner, which tells rows of the owner's id and text from all others.
    """
    frame = only(frame, id_col, text_col)
    text = F.coalesce(frame[f"`{text_col}`"].cast("string"), F.lit(""))
    source = frame.select(frame[f"`{id_col}`"].cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    rows = settle(source.mapInArrow(tidied(members), "id long, text_key long, length long, short long, sha binary"), "keys")
    repeated = settle(rows.groupBy("length", "short").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("short"), "repeated")
    partial = source.mapInArrow(tidied(partial_owners(Marks(repeated), held)), "length long, short long, body binary, chars long, owner long, owner_key long, size long")
    discard(repeated)
    owners = partial.repartition("length", "short").sortWithinPartitions("length", "short").mapInArrow(tidied(merged_owners(held)), "sha binary, keep_id long, keep_key long, group_size long")
    joined = rows.join(owners, "sha", "left")
    alone = F.col("group_size").isNull()
    same = F.col("id").eqNullSafe(F.col("keep_id"))
    return joined.select(
        F.col("id").alias(id_col),
        F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | same).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        *([F.col("text_key"), (alone | (same & (F.col("text_key") == F.col("keep_key")))).alias("owner")] if keyed else []),
    )


#: DuckDB SQL of deduplicate() over documents.
SQL = """
    WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS body FROM documents),
    g AS (SELECT body, arg_min(doc_id, (-chars, doc_id)) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM t JOIN g USING (body)"""
