"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import json
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that `[^\x20\x09-\x0D]+` leaves out of words; the same that bytes.split() splits at.
BLANKS = b" \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def read_vocabulary(path: str, limit: int = 64 << 20) -> bytes:
    """The bytes of a vocabulary file, for a broadcast: refused above `limit`, so that what is broadcast is bounded."""
    with open(path, "rb") as file:
        data = file.read(limit + 1)
    if len(data) > limit:
        raise ValueError(f"{path} is larger than {limit} bytes")
    return data


def places(columns: Sequence[str], *names: str) -> int | list[int]:
    """Where the named columns are: a name means the first column that is spelt so, else the first that differs in case only."""
    spelt, folded = list(columns), [c.lower() for c in columns]
    found = [spelt.index(n) if n in spelt else folded.index(n.lower()) if n.lower() in folded else None for n in names]
    if None in found:
        raise ValueError(f"no column {names[found.index(None)]!r} among {spelt}")
    return found[0] if len(names) == 1 else found


def only(frame: DataFrame, *names: str) -> DataFrame:
    """The named columns, taken by place, so that extra columns, clashing ones too, never reach an operator."""
    at = places(frame.columns, *names)
    return frame.toDF(*[f"c{i}" for i in range(len(frame.columns))]).select(*[F.col(f"c{i}").alias(n) for i, n in zip([at] if isinstance(at, int) else at, names)])


def chunks(sizes: Sequence[int], budget: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of at most `budget` in sum; a larger single item makes a range of its own."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > budget:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def text_chunks(batch: pa.RecordBatch, column: str = "text", budget: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of a batch with their texts (null: empty), each of about `budget` characters."""
    import pyarrow.compute as pc

    texts = batch.column(column)
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    for start, stop in chunks(sizes, budget):
        part = batch.slice(start, stop - start)
        yield part, [x or "" for x in part.column(column).to_pylist()]


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function, and after it the memory that the worker no longer uses given back; an idle worker would hold it else."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            tidy()

    return wrapped


def tidy() -> None:
    """Gives back the memory that this process no longer uses."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


#: Paths that were handed out within cleaning(), innermost last.
_made: list[list[str]] = []


@contextlib.contextmanager
def cleaning(spark: SparkSession) -> Iterator[None]:
    """Deletes on leaving the folders that operators wrote within; for callers that have written the result by then."""
    _made.append([])
    try:
        yield
    finally:
        for path in _made.pop():
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    made = spark._jvm.org.apache.hadoop.fs.Path(path)
    made.getFileSystem(spark._jsc.hadoopConfiguration()).delete(made, True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share. Only a local session (tests) may do without that setting: the folder is in the warehouse then."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not (spark.conf.get("spark.master", None) or "local").startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: driver and executors need a folder that they share")
        base = spark.conf.get("spark.sql.warehouse.dir")
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _made:
        _made[-1].append(path)
    return path


def settle(frame: DataFrame, name: str) -> DataFrame:
    """Cuts lineage: the frame written as Parquet to the shared folder and read again, so that lost executors cost no recomputation."""
    spark = frame.sparkSession
    path = shared_folder(spark, name)
    frame.write.parquet(path)
    read = spark.read.schema(frame.schema).parquet(path)
    read.settled_at = path
    return read


def discard(*settled: DataFrame) -> None:
    """Deletes the folders of settled frames that no later plan reads."""
    for frame in settled:
        _delete(frame.sparkSession, frame.settled_at)


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner delete the shuffle files of plans that nothing refers to any more; it goes by the driver's garbage collection. Saves disk, changes no result."""
    gc.collect()
    with contextlib.suppress(AttributeError):  # there is no such handle in Spark Connect
        spark.sparkContext._jvm.System.gc()


#: Cells of a table of marks, as a power of two: 16 for each key, and 2^30 (128 MB to broadcast) at most. From 2^26 keys on
#: more rows are marked in vain; they cost work in the exact steps that follow and change nothing.
FEWEST, MOST = 16, 30


class Marks:
    """A broadcast table of bits in which each key's cell is set; a row whose cell is not set has none of the keys."""

    def __init__(self, keys: DataFrame):
        """keys: one long column, written already (it is read twice)."""
        spark = keys.sparkSession
        self.bits = min(MOST, max(FEWEST, (16 * keys.count()).bit_length()))
        cells = keys.toDF("key").select(self.cell(F.col("key")).alias("cell")).distinct()
        slices = cells.repartition(F.shiftright("cell", FEWEST)).sortWithinPartitions("cell").mapInArrow(_packed, "slice int, bits binary")
        table, width = np.zeros(1 << (self.bits - 3), np.uint8), 1 << (FEWEST - 3)
        for at, bits in slices.toLocalIterator():  # 2^(bits - 16) rows of 8 KB at most
            table[at * width : (at + 1) * width] |= np.frombuffer(bits, np.uint8)
        self.table = spark.sparkContext.broadcast(table.tobytes())

    def cell(self, key: Column) -> Column:
        return key.bitwiseAND((1 << self.bits) - 1)

    def tester(self) -> Callable[[np.ndarray], np.ndarray]:
        """A function for workers: whether cells are set."""
        table = self.table

        def test(cells: np.ndarray) -> np.ndarray:
            return (np.frombuffer(table.value, np.uint8)[cells >> 3] >> (cells & 7).astype(np.uint8) & 1).astype(bool)

        return test


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells in order to bits, a row or a few for each slice of 2^FEWEST cells."""
    for batch in batches:
        cells = batch.column("cell").to_numpy(zero_copy_only=False)
        slices = cells >> FEWEST
        for part in np.split(cells, np.flatnonzero(slices[1:] != slices[:-1]) + 1):
            held = np.zeros(1 << FEWEST, np.uint8)
            held[part & ((1 << FEWEST) - 1)] = 1
            yield pa.RecordBatch.from_arrays([pa.array(part[:1] >> FEWEST, pa.int32()), pa.array([np.packbits(held, bitorder="little").tobytes()], pa.binary())], names=["slice", "bits"])


def canonical(value: object) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
