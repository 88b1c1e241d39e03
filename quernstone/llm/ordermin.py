"""Order MinHash fingerprints, and each document's next one in order of ids.

A text's k-mers are its windows of K code points, numbered by occurrence, so
that repeated windows count. Each of SKETCHES permutations takes the PICK
least of them, puts these back in text order and hashes the tuple. Two
fingerprints' likeness is the share of equal tuples; since a tuple keeps order,
it falls with the edit distance and not only with the sets of k-mers.

Defined results: a null text is empty; a text shorter than K is one k-mer; an
empty text has the empty fingerprint, like only to itself; ids are integers, a
null id comes before all; rows of one id are in order of their texts, and are
dealt by their texts' first characters where the id is hot; in a table
of one row the row is its own next; an empty table gives an empty result;
columns other than those named are not read.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.llm.common import only, text_chunks, tidied

K, SKETCHES, PICK = 6, 32, 2
M1, M2, M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
#: Fixed length of a fingerprint, in hexadecimal digits.
LENGTH = SKETCHES * 8
#: Characters by which texts of one id are dealt.
HEAD = 64


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M2
    x = (x ^ (x >> np.uint64(27))) * M3
    return x ^ (x >> np.uint64(31))


#: An odd multiplier for each permutation.
MULTIPLIERS = mix(np.arange(1, SKETCHES + 1, dtype=np.uint64) * M1) | np.uint64(1)


def numbered(hashes: np.ndarray) -> np.ndarray:
    """For each place, how often its value came before."""
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    same = np.concatenate(([False], ordered[1:] == ordered[:-1]))
    if not same.any():
        return np.zeros(len(hashes), np.uint64)
    places = np.arange(len(hashes))
    first = np.maximum.accumulate(np.where(same, 0, places))
    out = np.empty(len(hashes), np.uint64)
    out[order] = (places - first).astype(np.uint64)
    return out


def kmers(text: str) -> np.ndarray:
    """A 64-bit hash for each k-mer with its occurrence number, in text order."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    if not len(points):
        return points
    n = max(1, len(points) - K + 1)
    hashes = np.zeros(n, np.uint64)
    for i in range(min(K, len(points))):
        hashes = (hashes ^ points[i : i + n]) * M1
        hashes ^= hashes >> np.uint64(29)
    return mix(hashes + numbered(hashes) * M2)


def fingerprint(text: str) -> str:
    values = kmers(text)
    n = len(values)
    if not n:
        return ""
    out = np.empty(SKETCHES, np.uint32)
    step = max(1, (1 << 18) // n)
    for i in range(0, SKETCHES, step):
        multipliers = MULTIPLIERS[i : i + step]
        rows = np.arange(len(multipliers))
        ranks = values[None, :] * multipliers[:, None]
        chosen = np.empty((len(multipliers), min(PICK, n)), np.int64)
        for j in range(chosen.shape[1]):
            chosen[:, j] = ranks.argmin(1)
            ranks[rows, chosen[:, j]] = np.uint64(2**64 - 1)
        chosen.sort(1)
        tuples = np.zeros(len(multipliers), np.uint64)
        for j in range(chosen.shape[1]):
            tuples = mix(tuples * M1 + values[chosen[:, j]])
        out[i : i + step] = (tuples >> np.uint64(32)).astype(np.uint32)
    return out.astype(">u4").tobytes().hex()


def likeness(a: str, b: str) -> float:
    if not a or not b:
        return float(a == b)
    return sum(a[i : i + 8] == b[i : i + 8] for i in range(0, LENGTH, 8)) / SKETCHES


def fingerprints(frame: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's id and fingerprint; no shuffle."""
    frame = only(frame, id_col, text_col)
    source = frame.select(frame[f"`{id_col}`"].cast("long").alias(id_col), frame[f"`{text_col}`"].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_chunks(batch):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(map(fingerprint, texts), pa.string())], names=[id_col, "fingerprint"])

    return source.mapInArrow(tidied(run), f"`{id_col}` long, fingerprint string")


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as much of the following text's start."""
    tail = len(text) // 4
    return text[: len(text) - tail] + following[:tail]


OUT = pa.schema([("id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of bucket, head and id; the head of the next bucket ends each bucket, and makes no row itself."""
    bucket, held = None, None  # held: id, text and fingerprint of the row that waits for its next
    rows: list[tuple] = []
    for batch in batches:
        for part, texts in text_chunks(batch):
            for at, head, row, text in zip(part.column("bucket").to_pylist(), part.column("head").to_pylist(), part.column("id").to_pylist(), texts):
                if at != bucket:
                    bucket, held = at, None
                elif held is None:
                    continue  # more heads of the same id
                own = fingerprint(text)
                if held is not None:
                    changed = edited(held[1], text)
                    print_ = fingerprint(changed)
                    rows.append((held[0], len(held[1]), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), held[2], print_, likeness(held[2], print_), likeness(held[2], own)))
                held = None if head else (row, text, own)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), OUT)], schema=OUT)
                rows = []


def _cuts(source: DataFrame, parts: int) -> tuple[np.ndarray, dict[int, list[str]]]:
    """Where ids are cut into buckets, and where the texts of an id that fills more than one bucket are; fewer than 4 * parts cuts in all."""
    shares = [i / parts for i in range(1, parts)] or [0.5]
    found = np.array(source.agg(F.percentile_approx("id", shares, 10 * parts)).first()[0] or [], np.int64)
    cuts, times = np.unique(found, return_counts=True)
    hot = cuts[times > 1].tolist()
    if not hot:
        return cuts, {}
    # one text of each of 16 slots for each bucket that an id fills; these are bounds of buckets only, so any of them gives right results
    sizes = source.sparkSession.createDataFrame([(h, int(times[cuts == h][0]) + 1) for h in hot], "hot long, n int")
    heads = source.join(F.broadcast(sizes), F.col("id") == F.col("hot"))
    slots = heads.groupBy("id", "n", F.pmod(F.xxhash64("id", "text"), F.col("n") * 16).alias("slot")).agg(F.min("head").alias("head"))
    inside: dict[int, list[str]] = {}
    for r in slots.groupBy("id", "n").agg(F.array_sort(F.collect_list("head")).alias("heads")).collect():  # at most 32 * parts short texts in all
        inside[r.id] = sorted({r.heads[len(r.heads) * i // r.n] for i in range(1, r.n)})
    return np.unique(np.concatenate((cuts, np.array(hot, np.int64), np.array([h + 1 for h in hot if h < 2**63 - 1], np.int64)))), inside


def compare_with_next(frame: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """For each row its fingerprint, that of its text with the last quarter taken from the next row, and both likenesses.

    Ids are cut into buckets at quantiles, and the texts of an id that is hot at
    theirs; each bucket also gets the first row of the next one, so that one
    shuffle of the rows is enough and no task sees more than its buckets.
    """
    spark, frame = frame.sparkSession, only(frame, id_col, text_col)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    least = -(2**63)
    source = frame.select(F.coalesce(frame[f"`{id_col}`"].cast("long"), F.lit(least)).alias("id"), F.coalesce(frame[f"`{text_col}`"].cast("string"), F.lit("")).alias("text"))
    source = source.withColumn("head", F.substring("text", 1, HEAD))
    cuts, inside = _cuts(source, buckets or 4 * tasks)
    extra = np.zeros(len(cuts) + 1, np.int64)  # buckets that the texts of hot ids add before each
    for hot, texts in inside.items():
        extra[np.searchsorted(cuts, hot, side="right") + 1 :] += len(texts)

    @F.pandas_udf("int")
    def bucket_of(ids: pd.Series, heads: pd.Series) -> pd.Series:
        values = ids.to_numpy(np.int64)
        out = np.searchsorted(cuts, values, side="right")
        out = out + extra[out]
        for hot, texts in inside.items():
            at = np.flatnonzero(values == hot)
            out[at] += np.fromiter((bisect.bisect_right(texts, heads.iat[i]) for i in at), np.int64, len(at))
        return pd.Series(out.astype(np.int32))

    # heads are only read where an id is hot
    head = F.when(F.col("id").isin(list(inside)), F.col("head")) if inside else F.lit(None).cast("string")
    placed = source.withColumn("bucket", bucket_of("id", head))
    firsts = sorted((r.bucket, r.first.id, r.first.head) for r in placed.groupBy("bucket").agg(F.min(F.struct("id", "head")).alias("first")).collect())  # a row for each bucket
    before = [(i, h, firsts[at - 1][0]) for at, (_, i, h) in enumerate(firsts)]
    ends = spark.createDataFrame(before, "i long, h string, ends int")
    # a bucket's first row also ends the bucket before: rows that share its id and head go there too, and all but the first are passed over
    both = placed.join(F.broadcast(ends), (F.col("id") == F.col("i")) & (F.col("head") == F.col("h")), "left")
    places = F.array_compact(F.array(F.struct("bucket", F.lit(False).alias("head")), F.when(F.col("ends").isNotNull(), F.struct(F.col("ends").alias("bucket"), F.lit(True).alias("head")))))
    dealt = both.select("id", "text", F.explode(places).alias("place")).select("place.bucket", "place.head", "id", "text")
    ordered = dealt.repartition(tasks, "bucket").sortWithinPartitions("bucket", "head", "id", "text")
    out = ordered.mapInArrow(tidied(_compared), "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    return out.withColumn("id", F.when(F.col("id") != least, F.col("id"))).withColumnRenamed("id", id_col)
