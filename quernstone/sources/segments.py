"""Segmented NDJSON as a Spark data source: `format("segments")`, read and written.

A folder holds segments of JSON lines and lists of what was committed. A task
writes its rows to segments of about `segment_bytes` below a name that no list
holds yet. When all tasks are done, the driver writes one list with each
segment's size, rows, and least and greatest value of each column; it gets its
name in one step. So a write is seen whole or not at all: readers know no
segment but by a list, and what failed attempts left is deleted on commit and
on abort. Overwriting is a list that hides the earlier ones.

A reader deals each segment out in ranges of `range_bytes`. A line belongs to
the range where it begins, so each line is read once. Filters that Spark pushes
leave out segments by their least and greatest values. Those whose meaning is the
same here as in Spark are applied to the lines, and the plan states them; Spark
applies all others itself. What the driver holds is one line a segment: 400,000 at 100 TB
in segments of 256 MB.

Streams read what was committed since the last batch, list by list in order, so a
folder that a stream reads should have one writer at a time; a list that hides
others stops it. Streams write a list a batch, which bears the stream's name and
the batch's number: a batch that comes again after a failure changes nothing. Files that a stream's
failed attempts left are in no list; they stay, unread.

Defined results: nulls, empty texts, line breaks, NaN and infinities come back
as they were; dates and moments are written as whole numbers of days and
microseconds; other types than the ones below are refused; a folder without a
list is refused, one without rows has the columns written. Writes that are
committed at the same time are ordered by their lists' names. Rows can be added
only with the columns that are there; every column may hold nulls.
"""

from __future__ import annotations

import datetime
import json
import math
import operator
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

SEGMENT_BYTES, RANGE_BYTES, BATCH_BYTES, STEP = 256 << 20, 64 << 20, 4 << 20, 1 << 20
#: The session setting by which Spark offers filters to such sources.
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
KINDS = (*WHOLE, T.BooleanType, T.FloatType, T.DoubleType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)
DAY_ONE = datetime.datetime(1970, 1, 1)
#: Texts longer than this have no least and greatest value in a list.
LONG = 256


def plain(kind: pa.DataType) -> pa.DataType:
    """The type whose values are written for a type's."""
    return pa.int32() if pa.types.is_date(kind) else pa.int64() if pa.types.is_timestamp(kind) else kind


def checked(schema: T.StructType) -> T.StructType:
    for field in schema:
        if not isinstance(field.dataType, KINDS):
            raise ValueError(f"column {field.name!r}: no segments of {field.dataType.simpleString()}")
    if len(set(schema.names)) < len(schema.names):
        raise ValueError("columns of one name")
    return schema


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])


def opened(path: str) -> tuple[fs.FileSystem, str]:
    system, root = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return system, root.rstrip("/")


def listed(system: fs.FileSystem, root: str) -> list[str]:
    """The committed lists in order."""
    found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return sorted(f.path for f in found if f.base_name.startswith("list-"))


def heads(path: str) -> list[tuple[str, dict]]:
    """The committed lists' names with their first lines, in order."""
    system, root = opened(path)
    found = []
    for name in listed(system, root):
        with system.open_input_stream(name) as stream:
            found.append((name.rpartition("/")[2], json.loads(stream.read().decode().split("\n", 1)[0])))
    return found


def committed(path: str, after: str = "", up_to: str | None = None) -> tuple[T.StructType, list[dict]]:
    """The columns and the segments of a folder, or of its lists after one and up to another."""
    system, root = opened(path)
    schema, segments = None, []
    for name in listed(system, root):
        if name.rpartition("/")[2] <= after or (up_to is not None and name.rpartition("/")[2] > up_to):
            continue
        with system.open_input_stream(name) as stream:
            head, *lines = stream.read().decode().splitlines()
        head = json.loads(head)
        if head["overwrite"]:
            if after:
                raise ValueError(f"{name} hides rows that a stream has read")
            schema, segments = None, []
        schema = schema or T.StructType.fromJson(head["schema"])
        segments += [json.loads(line) for line in lines]
    if schema is None:
        raise FileNotFoundError(f"nothing was committed to {path}")
    return schema, segments


class Bounds:
    """Nulls, and the least and greatest value, of one column of a segment; unknown where a value has no such order here."""

    def __init__(self):
        self.nulls, self.low, self.high, self.known = 0, None, None, True

    def add(self, values: list) -> None:
        there = [v for v in values if v is not None]
        self.nulls += len(values) - len(there)
        if any(isinstance(v, float) and math.isnan(v) or isinstance(v, str) and len(v) > LONG for v in there):
            self.known = False
        if there and self.known:
            low, high = min(there), max(there)
            self.low = low if self.low is None else min(low, self.low)
            self.high = high if self.high is None else max(high, self.high)

    def stated(self) -> list:
        return [self.nulls, self.known, self.low, self.high] if self.known else [self.nulls, False, None, None]


def comparable(value):
    """A filter's value as it is written in segments, None where that depends on the session."""
    if isinstance(value, datetime.datetime):
        return (value - DAY_ONE) // datetime.timedelta(microseconds=1) if value.tzinfo is None else None
    if isinstance(value, datetime.date):
        return value.toordinal() - DAY_ONE.toordinal()
    return None if isinstance(value, float) and math.isnan(value) else value if isinstance(value, (bool, int, float, str)) else None


def may_hold(filter: ds.Filter, schema: T.StructType, segment: dict) -> bool:
    """False only if no row of a segment can pass."""
    at = getattr(filter, "attribute", None)
    if not at or len(at) != 1 or at[0] not in segment["bounds"] or at[0] not in schema.names:
        return True
    nulls, known, low, high = segment["bounds"][at[0]]
    if isinstance(filter, ds.IsNull):
        return nulls > 0
    if isinstance(filter, ds.IsNotNull):
        return nulls < segment["rows"]
    if isinstance(schema[at[0]].dataType, T.TimestampType) or not known:
        return True
    values = [comparable(v) for v in (filter.value if isinstance(filter, ds.In) else [getattr(filter, "value", None)])]
    if not values or any(v is None for v in values):
        return True
    if low is None:
        return not isinstance(filter, (ds.EqualTo, ds.In, ds.GreaterThan, ds.GreaterThanOrEqual, ds.LessThan, ds.LessThanOrEqual))
    if isinstance(filter, (ds.EqualTo, ds.EqualNullSafe, ds.In)):
        return any(low <= v <= high for v in values)
    if isinstance(filter, ds.GreaterThan):
        return high > values[0]
    if isinstance(filter, ds.GreaterThanOrEqual):
        return high >= values[0]
    if isinstance(filter, ds.LessThan):
        return low < values[0]
    if isinstance(filter, ds.LessThanOrEqual):
        return low <= values[0]
    return True


COMPARED = {ds.EqualTo: operator.eq, ds.GreaterThan: operator.gt, ds.GreaterThanOrEqual: operator.ge, ds.LessThan: operator.lt, ds.LessThanOrEqual: operator.le}
#: Types whose values, as written, compare as Spark compares them; not floating numbers, for NaN.
ALIKE = (*WHOLE, T.BooleanType, T.DateType, T.TimestampNTZType)


def row_test(filter: ds.Filter, schema: T.StructType) -> Callable[[dict], bool] | None:
    """Whether a line passes, as Spark would say; None if that is left to Spark."""
    at = getattr(filter, "attribute", None)
    if not at or len(at) != 1 or at[0] not in schema.names:
        return None
    name, kind = at[0], schema[at[0]].dataType
    if isinstance(filter, ds.IsNull):
        return lambda row: row.get(name) is None
    if isinstance(filter, ds.IsNotNull):
        return lambda row: row.get(name) is not None
    if not (isinstance(kind, ALIKE) or kind == T.StringType()):
        return None
    if isinstance(filter, ds.In):
        values = {comparable(v) for v in filter.value}
        return None if None in values else lambda row: row.get(name) in values
    compare = COMPARED.get(type(filter))
    value = comparable(filter.value) if compare else None
    return None if value is None else lambda row: row.get(name) is not None and compare(row[name], value)


@dataclass
class Range(ds.InputPartition):
    """The lines of a segment that begin at `start` or later and before `end`."""

    name: str
    start: int
    end: int


def lines_of(stream, start: int, end: int) -> Iterator[bytes]:
    """Reads from the byte before `start`, which tells whether a line begins there."""
    at = max(start - 1, 0)
    stream.seek(at)
    held, first = [], start > 0
    while at < end or held or first:
        piece = stream.read(STEP)
        if not piece:
            break
        *whole, rest = piece.split(b"\n")
        for part in whole:
            line = b"".join([*held, part])
            begins, held = at, []
            at = begins + len(line) + 1
            if first:
                first = False
            elif begins < end:
                yield line
            else:
                return
        if rest:
            held.append(rest)
        if at >= end and not first:
            return


class Reader(ds.DataSourceReader):
    def __init__(self, path: str, schema: T.StructType, range_bytes: int):
        self.path, self.schema, self.range_bytes, self.filters = path, schema, range_bytes, []

    def pushFilters(self, filters: list[ds.Filter]) -> list[ds.Filter]:
        self.filters = list(filters)
        return [f for f in filters if row_test(f, self.schema) is None]

    def partitions(self) -> list[Range]:
        schema, segments = committed(self.path)
        return self.ranges([s for s in segments if all(may_hold(f, schema, s) for f in self.filters)])

    def ranges(self, kept: list[dict]) -> list[Range]:
        return [Range(s["name"], i, min(i + self.range_bytes, s["bytes"])) for s in kept for i in range(0, s["bytes"], self.range_bytes)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no segment may hold a row
            return
        system, root = opened(self.path)
        schema = to_arrow_schema(self.schema)
        tests = [test for f in self.filters if (test := row_test(f, self.schema))]

        def batch(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], plain(f.type)).cast(f.type) for f in schema], schema=schema)

        with system.open_input_file(f"{root}/{partition.name}") as stream:
            rows, size = [], 0
            for line in lines_of(stream, partition.start, partition.end):
                row = json.loads(line)
                if not all(test(row) for test in tests):
                    continue
                rows.append(row)
                size += len(line)
                if size > BATCH_BYTES:
                    yield batch(rows)
                    rows, size = [], 0
            if rows:
                yield batch(rows)


class StreamReader(ds.DataSourceStreamReader):
    """Offsets are names of lists; a batch has the lists after one and up to another."""

    def __init__(self, reader: Reader):
        self.reader = reader

    def initialOffset(self) -> dict:
        return {"list": ""}

    def latestOffset(self) -> dict:
        names = listed(*opened(self.reader.path))
        return {"list": names[-1].rpartition("/")[2] if names else ""}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        return self.reader.ranges(committed(self.reader.path, start["list"], end["list"])[1]) if start["list"] < end["list"] else []

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return self.reader.read(partition)


@dataclass
class Written(ds.WriterCommitMessage):
    segments: list


class Writer(ds.DataSourceArrowWriter):
    def __init__(self, path: str, schema: T.StructType, overwrite: bool, segment_bytes: int):
        self.path, self.schema, self.overwrite, self.segment_bytes, self.job = path, schema, overwrite, segment_bytes, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = opened(self.path)
        system.create_dir(f"{root}/data-{self.job}", recursive=True)
        done, stream, segment, bounds = [], None, None, {}

        def close() -> None:
            stream.close()
            done.append(segment | {"bounds": {name: b.stated() for name, b in bounds.items()}})

        try:
            for whole in iterator:
                for part in (whole.slice(i, 1024) for i in range(0, whole.num_rows, 1024)):
                    if stream is None:
                        segment = {"name": f"data-{self.job}/{uuid.uuid4().hex}.ndjson", "bytes": 0, "rows": 0}
                        bounds = {name: Bounds() for name in self.schema.names}
                        stream = system.open_output_stream(f"{root}/{segment['name']}", compression=None)
                    columns = [c.cast(pa.timestamp("us", c.type.tz)).cast(pa.int64()) if pa.types.is_timestamp(c.type) else c.cast(plain(c.type)) for c in part.columns]
                    values = [c.to_pylist() for c in columns]
                    for name, cells in zip(self.schema.names, values):
                        bounds[name].add(cells)
                    for row in zip(*values):
                        line = json.dumps(dict(zip(self.schema.names, row)), separators=(",", ":")).encode() + b"\n"
                        stream.write(line)
                        segment["bytes"] += len(line)
                        segment["rows"] += 1
                    if segment["bytes"] >= self.segment_bytes:
                        close()
                        stream = None
            if stream is not None:
                close()
                stream = None
        finally:
            if stream is not None:
                stream.close()
        return Written(done)

    def commit(self, messages: list[Written | None], told: dict | None = None) -> None:
        """told: more for the list's first line."""
        system, root = opened(self.path)
        segments = [s for m in messages if m is not None for s in m.segments]
        head = {"overwrite": self.overwrite, "schema": nullable(self.schema).jsonValue()} | (told or {})
        last = max((int(x.rpartition("/")[2].split("-")[1]) for x in listed(system, root)), default=0)
        name = f"{max(time.time_ns(), last + 1):020d}-{uuid.uuid4().hex}"
        system.create_dir(root, recursive=True)
        with system.open_output_stream(f"{root}/new-{name}", compression=None) as stream:
            stream.write("\n".join(json.dumps(x) for x in [head, *segments]).encode())
        system.move(f"{root}/new-{name}", f"{root}/list-{name}")
        if told is not None:
            return  # a stream's later batches may be under way in the same folder
        kept = {s["name"] for s in segments}
        for f in system.get_file_info(fs.FileSelector(f"{root}/data-{self.job}", allow_not_found=True)):
            if f"data-{self.job}/{f.base_name}" not in kept:
                system.delete_file(f.path)

    def abort(self, messages: list[Written | None]) -> None:
        system, root = opened(self.path)
        if system.get_file_info(f"{root}/data-{self.job}").type == fs.FileType.Directory:
            system.delete_dir(f"{root}/data-{self.job}")


class StreamWriter(ds.DataSourceStreamArrowWriter):
    """Segments of a batch lie in a folder of the writer's run; its list says which are the batch's."""

    def __init__(self, writer: Writer, stream: str):
        self.writer, self.stream = writer, stream

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return self.writer.write(iterator)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        told = {"stream": self.stream, "batch": batchId}
        if any(told.items() <= head.items() for _, head in heads(self.writer.path)):
            self.abort(messages, batchId)
        else:
            self.writer.commit(messages, told)

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        system, root = opened(self.writer.path)
        for message in messages:
            for segment in message.segments if message is not None else []:
                if system.get_file_info(f"{root}/{segment['name']}").type == fs.FileType.File:
                    system.delete_file(f"{root}/{segment['name']}")


class Segments(ds.DataSource):
    """Options: path, segment_bytes (writing), range_bytes (reading), stream (the name under which a stream writes)."""

    @classmethod
    def name(cls) -> str:
        return "segments"

    def _size(self, option: str, usual: int) -> int:
        size = int(self.options.get(option, usual))
        if size < 1:
            raise ValueError(f"{option} is below 1")
        return size

    def schema(self) -> T.StructType:
        return committed(self.options["path"])[0]

    def reader(self, schema: T.StructType) -> Reader:
        return Reader(self.options["path"], checked(schema), self._size("range_bytes", RANGE_BYTES))

    def writer(self, schema: T.StructType, overwrite: bool) -> Writer:
        if not overwrite and listed(*opened(self.options["path"])) and self.schema() != nullable(schema):
            raise ValueError(f"other columns than those of {self.options['path']}")
        return Writer(self.options["path"], checked(schema), overwrite, self._size("segment_bytes", SEGMENT_BYTES))

    def streamReader(self, schema: T.StructType) -> StreamReader:
        return StreamReader(self.reader(schema))

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> StreamWriter:
        if overwrite or not self.options.get("stream"):
            raise ValueError("a stream appends under a name: option stream")
        return StreamWriter(self.writer(schema, False), self.options["stream"])


def register(spark: SparkSession) -> None:
    """Makes the format known to a session and has it offer filters."""
    spark.dataSource.register(Segments)
    spark.conf.set(PUSHDOWN, "true")


def write(frame: DataFrame, path: str, overwrite: bool = False, segment_bytes: int = SEGMENT_BYTES) -> None:
    register(frame.sparkSession)
    frame.write.format("segments").option("segment_bytes", segment_bytes).mode("overwrite" if overwrite else "append").save(path)


def read(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    register(spark)
    return spark.read.format("segments").option("range_bytes", range_bytes).load(path)


def drain(path: str, to: str, stream: str, spark: SparkSession, checkpoint: str, change: Callable[[DataFrame], DataFrame] = lambda frame: frame, range_bytes: int = RANGE_BYTES) -> None:
    """Takes what was committed to a folder since the last call with this checkpoint, changes it, and commits it to another, once."""
    register(spark)
    found = spark.readStream.format("segments").option("range_bytes", range_bytes).load(path)
    writer = change(found).writeStream.format("segments").option("path", to).option("stream", stream)
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
