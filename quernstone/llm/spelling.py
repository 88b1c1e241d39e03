"""Spelling variants by full neighbourhood generation.

Words are counted in the tasks that read the texts and summed by a shuffle. Each
word of the vocabulary then emits its whole neighbourhood: all distinct deletions,
replacements and insertions over the alphabet that the vocabulary holds. What a
neighbour and a word of the vocabulary have in common is that they are equal, so
a hash join finds all near words and no distance is computed.

A neighbour is never written out as text. A word's hash is a sum over its
positions, so that the hash of each neighbour is the word's with one term changed
and what follows it moved by a place; a word of L code points costs L times the
alphabet, not L times that again. A neighbour whose cell in a table of marks of
the vocabulary's hashes is empty goes no further. The rest are joined by hash, and
the few that meet a word are built and compared as texts, so that the result does
not rest on a hash.

Defined results: null texts have no words; a null id is written as an empty one;
repeated rows count as often as they are there; an empty table gives no rows;
columns other than those named are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.llm.common import Marks, discard, only, settle, text_chunks, tidied

#: Different words that a task counts before it hands its counts on.
HELD = 1 << 18
#: Words of a task that makes neighbourhoods.
WORDS = 1 << 12
#: Neighbours whose hashes are made at a time.
CELLS = 1 << 18
#: Hashes are sums of a number for each code point times a power of BASE, modulo 2^64; BASE is odd, so that it can be divided by.
BASE = 0x9E3779B97F4A7C15
UNDONE = pow(BASE, -1, 1 << 64)
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
DELETED, REPLACED, INSERTED = 0, 1, 2


def runs_of(letters: str, least: int) -> re.Pattern:
    """Maximal runs of at least `least` letters in a text whose A-Z are lower-cased."""
    return re.compile(f"[{letters}]{{{least},}}")


def damaged(key: str, word: str, every: int) -> str:
    """The word as document `key` spells it: where `every` divides the crc32 of `key:word`, one code point is left out."""
    h = zlib.crc32(f"{key}:{word}".encode())
    return word if h % every else word[: h % len(word)] + word[h % len(word) + 1 :]


def _counts(letters: str, least: int, every: int | None):
    pattern = runs_of(letters, least)
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def handed_on() -> Iterator[pa.RecordBatch]:
            if total:
                yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], schema=schema)
                total.clear()

        for batch in batches:
            for part, texts in text_chunks(batch):
                for key, text in zip(part.column("key").to_pylist(), texts):
                    found = Counter(pattern.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")))
                    if every is not None:
                        start = zlib.crc32(f"{key or ''}:".encode())
                        for word in [w for w in found if zlib.crc32(w.encode(), start) % every == 0]:
                            n, cut = found.pop(word), damaged(key or "", word, every)
                            if len(cut) >= least:
                                total[cut] += n
                    total.update(found)
                    if len(total) > HELD:
                        yield from handed_on()
        yield from handed_on()

    return run


def vocabulary(frame: DataFrame, id_col: str = "doc_id", text_col: str = "text", letters: str = "a-zÀ-ÿ", least_length: int = 6, least_count: int = 5, every: int | None = 199) -> DataFrame:
    """word, n: the runs of letters, A-Z lower-cased, of at least so many code points and occurrences.

    every: plants misspellings for a test of the operator, see damaged(); None counts the runs as they are.
    """
    frame = only(frame, id_col, text_col)
    source = frame.select(F.col(f"`{id_col}`").cast("string").alias("key"), F.col(f"`{text_col}`").cast("string").alias("text"))
    counted = source.mapInArrow(tidied(_counts(letters, least_length, every)), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def letter_values(codes: np.ndarray) -> np.ndarray:
    """A number of 64 bits for each code point."""
    x = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(BASE)
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


def spread(sums: np.ndarray) -> np.ndarray:
    """Sums as hashes: a bijection that makes all bits depend on all others."""
    x = (sums ^ (sums >> np.uint64(32))) * M2
    x = (x ^ (x >> np.uint64(29))) * M1
    return x ^ (x >> np.uint64(32))


def powers(n: int) -> np.ndarray:
    out = np.full(n, BASE, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def code_points(word: str) -> np.ndarray:
    return np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32)


def word_hash(word: str) -> int:
    codes = code_points(word)
    return int(spread((letter_values(codes) * powers(len(codes))).sum(dtype=np.uint64)[None])[0])


def neighbourhood(word: str, alphabet: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray]]:
    """Hashes of all distinct neighbours, with what was done, the places and the letters' places in the alphabet, some at a time.

    Of equal letters in a row only the first is deleted, and no letter is inserted
    after one that is the same, so each neighbour comes once.
    """
    codes = code_points(word)
    n = len(codes)
    own, letters, power = letter_values(codes), letter_values(alphabet), powers(n + 1)
    terms = own * power[:n]
    before = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))
    total = before[-1]
    fresh = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    yield spread(before[fresh] + (total - before[fresh + 1]) * np.uint64(UNDONE)), DELETED, fresh, np.full(len(fresh), -1)
    step = max(1, CELLS // max(1, len(alphabet)))
    for start in range(0, n, step):
        at = np.arange(start, min(n, start + step))
        rows, cols = np.nonzero(codes[at][:, None] != alphabet[None, :])
        yield spread(total + (letters[cols] - own[at[rows]]) * power[at[rows]]), REPLACED, at[rows], cols
    for start in range(0, n + 1, step):
        at = np.arange(start, min(n + 1, start + step))
        last = np.where(at > 0, codes[at - 1].astype(np.int64), -1)
        rows, cols = np.nonzero(last[:, None] != alphabet[None, :].astype(np.int64))
        yield spread(before[at[rows]] + letters[cols] * power[at[rows]] + (total - before[at[rows]]) * np.uint64(BASE)), INSERTED, at[rows], cols


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes = np.array([word_hash(w) for w in batch.column("word").to_pylist()], np.uint64).view(np.int64)
        yield batch.append_column("hash", pa.array(hashes, pa.int64()))


def _letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(set().union(*batch.column("word").to_pylist()), pa.string())], names=["letter"])


def _neighbours(letters: list[str], marks: Marks):
    schema = pa.schema([("hash", pa.int64()), ("of", pa.int64()), ("done", pa.int32()), ("at", pa.int32()), ("letter", pa.string())])
    marked, mask = marks.tester(), np.int64((1 << marks.bits) - 1)
    alphabet = np.array([ord(c) for c in letters], np.uint32)
    names = pa.array([*letters, ""], pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def handed_on() -> pa.RecordBatch:
            hashes, of, done, at, cols = (np.concatenate(x) for x in zip(*held))
            return pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(of), pa.array(done, pa.int32()), pa.array(at, pa.int32()), names.take(pa.array(cols))], schema=schema)

        for batch in batches:
            for word, own in zip(batch.column("word").to_pylist(), batch.column("hash").to_pylist()):
                for hashes, done, at, cols in neighbourhood(word, alphabet):
                    hashes = hashes.view(np.int64)
                    kept = np.flatnonzero(marked(hashes & mask))
                    if len(kept):
                        held.append((hashes[kept], np.full(len(kept), own, np.int64), np.full(len(kept), done), at[kept], np.where(cols[kept] < 0, len(alphabet), cols[kept])))
                        size += len(kept)
                    if size >= CELLS:
                        yield handed_on()
                        held, size = [], 0
        if size:
            yield handed_on()

    return run


def near_words(words: DataFrame) -> DataFrame:
    """word, near, near_n: each pair of words of (word, n, hash) that one deletion, replacement or insertion tells apart, in both directions."""
    letters = sorted(r.letter for r in words.select("word").mapInArrow(_letters, "letter string").distinct().collect())  # as many as are allowed in words
    marks = Marks(words.select("hash"))
    tasks = -(-words.count() // WORDS) or 1  # a few MB of words make a thousand times as many neighbours
    emitted = words.select("word", "hash").repartition(tasks, "hash").mapInArrow(tidied(_neighbours(letters, marks)), "hash long, of long, done int, at int, letter string")
    met = emitted.join(words.select("hash", F.col("word").alias("near"), F.col("n").alias("near_n")), "hash").drop("hash")
    met = met.join(words.select(F.col("hash").alias("of"), "word"), "of")
    rest = F.substring(F.col("word"), F.col("at") + F.when(F.col("done") == INSERTED, 1).otherwise(2), F.length("word"))
    built = F.concat(F.substring(F.col("word"), F.lit(1), F.col("at")), F.col("letter"), rest)
    return met.where(built == F.col("near")).select("word", "near", "near_n").distinct()


def variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """word, form, root, n, n_near, form_n for each row of (word, n).

    form: the near word of largest n (ties: the first in code-point order), if that is
    at least `ratio` times the word's; root: where following forms ends. n grows by
    `ratio` a step, so forms make no circle and a few doublings of the step reach
    every root.
    """
    if ratio < 2:
        raise ValueError("a form must be at least twice as frequent")
    words = settle(words.select("word", "n").mapInArrow(tidied(_hashed), "word string, n long, hash long"), "words")
    best = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("best"))
    found = words.select("word", "n").join(best, "word", "left")
    near = F.when(-F.col("best.n") >= F.col("n") * ratio, F.col("best"))
    found = settle(found.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), near["word"].alias("form"), (-near["n"]).alias("form_n")), "forms")
    steps = settle(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    most, reach = found.agg(F.max("n")).first()[0] or 0, 1
    while ratio**reach <= most:  # a chain of `reach` steps needs a word of ratio^reach occurrences
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        doubled = settle(steps.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
        discard(steps)
        steps, reach = doubled, reach * 2
    discard(words)
    return found.join(steps, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
