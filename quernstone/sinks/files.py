"""Batch writers. Results go below spark.checkpoint.dir, which driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Formats, each of which gives back what was written.
FORMATS = ("parquet", "orc", "json", "csv")
#: Marks that texts begin with in files: a null in CSV, and an empty text that names a partition.
NULL, MARK = "\\N", "_"
#: How moments are written as text, to the microsecond.
MOMENTS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
#: Texts are quoted, so that line breaks, blanks and empty texts stay as they are; readers then can't start within a file.
CSV = {"header": "true", "escape": '"', "quoteAll": "true", "multiLine": "true", "lineSep": "\n", "nullValue": NULL, "emptyValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "enforceSchema": "false", "mode": "FAILFAST"}
OPTIONS = {"parquet": {}, "orc": {}, "json": MOMENTS | {"ignoreNullFields": "false", "mode": "FAILFAST"}, "csv": MOMENTS | CSV}


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share; without spark.checkpoint.dir (a local session) it is in the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not (spark.conf.get("spark.master", None) or "local").startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: driver and executors need a folder that they share")
        base = spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _texts(frame: DataFrame, names: list[str], change) -> DataFrame:
    """The frame with the text columns among `names` changed."""
    kinds = dict(frame.dtypes)
    return frame.select(*[change(frame[f"`{c}`"]).alias(c) if c in names and kinds[c] == "string" else frame[f"`{c}`"] for c in frame.columns])


def _marked(first: str):
    """Texts that begin with `first` get another one, so that what stands for a null or an empty text is no text's own spelling."""
    return lambda c: F.when(c.startswith(first), F.concat(F.lit(first), c)).otherwise(c)


def _unmarked(first: str):
    return lambda c: F.when(c.startswith(first), F.substr(c, F.lit(len(first) + 1))).otherwise(c)


def _named(c: Column) -> Column:
    """A partition's text: an empty one, which names no folder, gets a mark, and so does one that begins with the mark."""
    return F.when((c == "") | c.startswith(MARK), F.concat(F.lit(MARK), c)).otherwise(c)


def write(frame: DataFrame, kind: str, path: str, by: list[str] | None = None, mode: str = "errorifexists") -> None:
    """Writes a frame so that read() gives back the same rows: nulls, empty texts, blanks and line breaks included. Columns of a partitioned frame keep their order when read."""
    if kind not in FORMATS:
        raise ValueError(f"no format {kind!r}")
    by = by or []
    if kind == "csv":
        frame = _texts(frame, [c for c in frame.columns if c not in by], _marked(NULL[0]))
    writer = _texts(frame, by, _named).write.format(kind).options(**OPTIONS[kind]).mode(mode)
    (writer.partitionBy(*by) if by else writer).save(path)


def read(like: DataFrame, kind: str, path: str, by: list[str] | None = None) -> DataFrame:
    """What write() wrote of a frame of these columns. Filters on partition columns still leave out folders."""
    by = by or []
    found = like.sparkSession.read.schema(like.schema).format(kind).options(**OPTIONS[kind]).load(path)
    found = _texts(found, by, _unmarked(MARK)).select(*[f"`{c}`" for c in like.columns])
    return _texts(found, [c for c in like.columns if c not in by], _unmarked(NULL[0])) if kind == "csv" else found


def round_trip(frame: DataFrame, kind: str, by: list[str] | None = None) -> DataFrame:
    """The frame written in a format, partitioned by columns where asked, and read again with its own schema."""
    path = shared_path(frame.sparkSession, f"written-{kind}")
    write(frame, kind, path, by)
    return read(frame, kind, path, by)
