"""A quality classifier of supervised subword embeddings.

A document's features are its words, the character 3- and 4-grams of its words
with their borders, and for each word a mark whether it repeats one of the two
words before it; all but the marks are hashed into 2^BITS cells. Each cell has a
learned vector; a document is the mean of its features' vectors, and a softmax
over two classes reads it. Training is stochastic gradient descent in numpy on
whole texts of a bounded sample of labelled rows, `sample` and `sample_bytes` at
most: those whose ids hash lowest. For scoring, each cell's vector is multiplied out to one
number, so that the executors get a table of fixed size.

Defined results: a null text is empty; a text without words scores by the bias
alone; labels that are null or of null ids are not learned from; a row that has
several labels is learned with each; without any label of either class the score
is the share of 1 (0.5 without labels); an empty table gives an empty result;
columns other than those named are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.llm.common import discard, only, places, settle, text_chunks, tidied, tidy

BITS, GRAMS = 18, (3, 4)
CELLS = 1 << BITS
#: Characters whose features are made at a time; they take some 60 bytes each.
CHARS = 1 << 18
#: After the hashed cells: no repetition, the word before repeated, the one before that.
MARKS = 3
ODD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
POWERS = np.cumprod(np.full(256, 0x100000001B3, np.uint64))


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Cells of all features, and each feature's document; not in order of documents."""
    datas = [t.encode("utf-8", "surrogatepass") for t in texts]
    whole = np.frombuffer(b" " + b" ".join(datas) + b" ", np.uint8)
    blank = (whole == 32) | ((whole >= 9) & (whole <= 13))
    data = np.where(blank, np.uint8(32), whole).astype(np.uint64)
    document = np.repeat(np.arange(len(texts), dtype=np.int32), [len(d) + 1 for d in datas])
    document = np.concatenate((document[:1] if len(document) else np.zeros(1, np.int32), document))
    cells, owners = [], []
    for n in GRAMS:
        m = len(data) - n + 1
        if m <= 0:
            continue
        mixed = np.full(m, n, np.uint64)
        for i in range(n):
            mixed = mixed * np.uint64(257) + data[i : i + m]
        whole_words = ~blank[1 : m + 1]
        for i in range(2, n - 1):
            whole_words &= ~blank[i : m + i]
        at = np.flatnonzero(whole_words)
        cells.append((mixed[at] * ODD[0]) >> np.uint64(64 - BITS))
        owners.append(document[at + 1])
    edges = np.diff(np.concatenate(([True], blank, [True])).astype(np.int8))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    if len(starts):
        runs = np.diff(np.append(starts, len(data)))
        place = np.arange(len(data)) - np.repeat(np.append(0, starts), np.append(starts[0], runs))
        weighed = np.where(blank, np.uint64(0), (data + np.uint64(1)) * POWERS[place & 255])
        words = np.add.reduceat(weighed, starts) * ODD[1]
        words ^= words >> np.uint64(29)
        of = document[starts]
        cells.append((words * ODD[2]) >> np.uint64(64 - BITS))
        owners.append(of)
        mark = np.zeros(len(words), np.uint64)
        for back in (2, 1):
            same = (words[back:] == words[:-back]) & (of[back:] == of[:-back])
            mark[back:][same] = back
        cells.append(mark + np.uint64(CELLS))
        owners.append(of)
    if not cells:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    return np.concatenate(cells).astype(np.int64), np.concatenate(owners)


class SubwordClassifier:
    """Learned vectors of cells, and a softmax over two classes."""

    def __init__(self, dim: int = 12, epochs: int = 8, rate: float = 0.4, seed: int = 11):
        self.dim, self.epochs, self.rate, self.seed = dim, epochs, rate, seed

    def fit(self, texts: list[str], labels: list[int]) -> SubwordClassifier:
        draw = np.random.default_rng(self.seed)
        vectors = draw.uniform(-1, 1, (CELLS + MARKS, self.dim)).astype(np.float32) / self.dim
        out = draw.uniform(-1, 1, (self.dim, 2)).astype(np.float32) / self.dim
        share = (sum(labels) + 0.5) / (len(labels) + 1)
        bias = np.log(np.array([1 - share, share], np.float32))
        documents = []
        for text, label in zip(texts, labels):
            found, counts = np.unique(features([text])[0], return_counts=True)
            if len(found):
                documents.append((found, (counts / counts.sum()).astype(np.float32), label))
        steps, total = 0, max(1, self.epochs * len(documents))
        for _ in range(self.epochs if 0 < sum(labels) < len(labels) else 0):
            for i in draw.permutation(len(documents)):
                found, weights, label = documents[i]
                rate = self.rate * (1 - steps / total)
                steps += 1
                own = vectors[found]
                hidden = weights @ own
                scores = hidden @ out + bias
                scores = np.exp(scores - scores.max())
                wrong = scores / scores.sum()
                wrong[label] -= 1
                back = out @ wrong
                out -= rate * np.outer(hidden, wrong)
                bias -= np.float32(0.1 * rate) * wrong
                # each feature's step is measured by the mean weight, as if features came one by one
                vectors[found] = own - (rate * len(found)) * np.minimum(weights, 0.05)[:, None] * back
        self.table = (vectors @ (out[:, 1] - out[:, 0])).astype(np.float32)
        self.bias = float(bias[1] - bias[0])
        return self

    def score(self, texts: list[str]) -> np.ndarray:
        return scores(texts, self.table, self.bias)


def scores(texts: list[str], table: np.ndarray, bias: float) -> np.ndarray:
    """The probability of class 1."""
    cells, owners = features(texts)
    sums = np.bincount(owners, table[cells], len(texts))
    counts = np.bincount(owners, minlength=len(texts))
    return 1 / (1 + np.exp(-np.clip(sums / np.maximum(counts, 1) + bias, -30, 30)))


def train(frame: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = 4000, sample_bytes: int = 64 << 20, **settings) -> SubwordClassifier:
    """Learns from at most `sample` labelled rows of frame, of `sample_bytes` in all; the caller leaves out rows that are to be held out.

    Rows are taken in order of their ids' hashes; one that would exceed the bytes is left out.
    """
    frame, labels = only(frame, id_col, text_col), only(labels, id_col, label_col)
    ids = labels.select(labels[f"`{id_col}`"].alias("id"), labels[f"`{label_col}`"].cast("int").alias("label")).where("id IS NOT NULL AND label IN (0, 1)")
    place = F.xxhash64("id").alias("place")
    chosen = ids.orderBy(place, "id", "label").limit(sample)
    rows = frame.select(frame[f"`{id_col}`"].alias("id"), F.coalesce(frame[f"`{text_col}`"].cast("string"), F.lit("")).alias("text")).join(F.broadcast(chosen), "id")
    # ids may be repeated in the frame: the rows found are limited again, then their sizes are known before their texts are read
    rows = settle(rows.select(place, "id", "label", F.xxhash64("text").alias("key"), F.octet_length("text").alias("size"), "text"), "labelled")
    order = ["place", "id", "label", "key"]
    taken, left = [], sample_bytes
    for r in rows.select(*order, "size").orderBy(*order).limit(sample).collect():
        if r.size <= left:
            left -= r.size
            taken.append(tuple(r)[:4])
    wanted = rows.orderBy(*order).limit(sample).where(F.col("size") <= sample_bytes)
    kept, learned = Counter(taken), []
    for r in wanted.select(*order, "text").toLocalIterator():  # `sample` rows
        if kept[tuple(r)[:4]]:
            kept[tuple(r)[:4]] -= 1
            learned.append((r.id, r.label, r.text))
    discard(rows)
    learned.sort()
    try:
        return SubwordClassifier(**settings).fit([r[2] for r in learned], [r[1] for r in learned])
    finally:
        learned.clear()
        tidy()  # the driver would hold the features of the sample during all later stages


def score(frame: DataFrame, model: SubwordClassifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's id and score."""
    frame = only(frame, id_col, text_col)
    shared = frame.sparkSession.sparkContext.broadcast((model.table, model.bias))
    source = frame.select(frame[f"`{id_col}`"].cast("long").alias(id_col), frame[f"`{text_col}`"].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bias = shared.value
        for batch in batches:
            for part, texts in text_chunks(batch, budget=CHARS):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores(texts, table, bias), pa.float64())], names=[id_col, "score"])

    return source.mapInArrow(tidied(run), f"`{id_col}` long, score double")


def select(frame: DataFrame, model: SubwordClassifier, least: float, text_col: str = "text") -> DataFrame:
    """The rows that score at least this, with all their columns, in one pass without a shuffle."""
    shared, names = frame.sparkSession.sparkContext.broadcast((model.table, model.bias)), frame.columns
    at = f"c{places(names, text_col)}"
    plain = frame.toDF(*[f"c{i}" for i in range(len(names))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bias = shared.value
        for batch in batches:
            for part, texts in text_chunks(batch, at, budget=CHARS):
                yield part.filter(pa.array(scores(texts, table, bias) >= least))

    return plain.mapInArrow(tidied(run), plain.schema).toDF(*names)


def held_out(column: F.Column, modulus: int, remainder: int) -> F.Column:
    """Whether the CRC-32 of an id as text leaves this remainder."""
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % modulus == remainder, F.lit(False))
