"""WARC records and a Merkle audit of replicas.

Pages become WARC response records, laid out in segments: ordered ranges of
bytes (segment, place, offset, length). A replica's leaves are the SHA-256 of
its bytes in each of these ranges together with the range; bytes are hashed
where they are read, so that only digests and lengths are shuffled. FAN leaves or
nodes hash to the node above, up to a root for each segment. The trees of two
replicas are built side by side, each level written once, a FANth of the one
below. An audit compares roots, and descends only below nodes that differ, down
to the records that are damaged: of each level, which is scanned, only the children
of nodes that differ are compared.

Places and offsets are prefix sums in two levels: over the sums of (id, first
digits of the digest), then within each of these; records alike in all are
counted first and get consecutive places, so no window holds a repeated id's rows.
All of it is DataFrame operations; a group is at most FAN rows.

Defined results: a null text is empty; a null, empty or blank url is written as
about:blank, control characters and spaces are taken off its ends and written as %20 within; pages are in order
of id, then of digest; pages of a null id go to segments of their own, by hash;
rows that repeat an id are records of their own, and share a record id if alike;
a record that a replica lacks has no digest and counts as damaged; an empty table
gives an empty result; columns other than those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernstone.llm.common import discard, only, settle, tidied

#: Ids of a segment, and children of a node. LEVELS nodes of nodes reach a root: FAN ** LEVELS leaves; larger segments, of repeated ids, have several roots.
SPAN, FAN, LEVELS = 256, 16, 3
#: Records alike that are numbered by one row.
RUN = 4096
#: The date of records, since the tables have none.
DATE = "1970-01-01T00:00:00Z"
#: The lines of a response record's head and of its HTTP head.
WARC_HEAD = ("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:", ">\r\nWARC-Date: ", "\r\nWARC-Target-URI: ", "\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: ", "\r\n\r\n")
HTTP_HEAD = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: ", "\r\n\r\n")


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", text_col: str = "html", date: str = DATE) -> DataFrame:
    """id, segment, length and digest as the manifest has them, and the record's bytes; no shuffle."""
    pages = only(pages, id_col, url_col, text_col)
    number, text = pages[f"`{id_col}`"].cast("long"), F.coalesce(pages[f"`{text_col}`"].cast("string"), F.lit(""))
    given = F.regexp_replace(F.coalesce(pages[f"`{url_col}`"].cast("string"), F.lit("")), r"^[\x00-\x20\x7F]+|[\x00-\x20\x7F]+$", "")
    given = F.regexp_replace(given, r"[\x00-\x20\x7F]+", "%20")
    url = F.when(given == "", "about:blank").otherwise(given)
    name = F.md5(F.concat_ws(" ", F.coalesce(number.cast("string"), F.lit("")), url, text).cast("binary"))
    uuid = F.concat_ws("-", *[F.substring(name, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    http = F.concat(F.lit(HTTP_HEAD[0]), F.octet_length(text).cast("string"), F.lit(HTTP_HEAD[1]), text)
    size = F.octet_length(text) + F.length(F.octet_length(text).cast("string")) + sum(map(len, HTTP_HEAD))
    record = F.concat(F.lit(WARC_HEAD[0]), uuid, F.lit(WARC_HEAD[1]), F.lit(date), F.lit(WARC_HEAD[2]), url, F.lit(WARC_HEAD[3]), size.cast("string"), F.lit(WARC_HEAD[4]), http, F.lit("\r\n\r\n"))
    segment = F.coalesce(F.floor(number / SPAN), -1 - F.pmod(F.xxhash64(url, text), F.lit(1 << 16)))
    rows = pages.select(number.alias("id"), segment.alias("segment"), F.encode(record, "UTF-8").alias("record"))
    return rows.select("id", "segment", F.octet_length("record").cast("long").alias("length"), F.sha2("record", 256).alias("digest"), "record")


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of a stretch of a WARC file: each one's named fields and its block. Bytes that are no record raise ValueError."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split("\r\n") if end >= 0 else []
        if not lines or not lines[0].startswith("WARC/1."):
            raise ValueError(f"no WARC record at byte {at}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        start, size = end + 4, int(fields["Content-Length"])
        if data[start + size : start + size + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} is cut short")
        yield fields, data[start : start + size]
        at = start + size + 4


def read(replica: DataFrame, record_col: str = "record") -> DataFrame:
    """record_id, date, url and html of the response records in a column of bytes; null bytes have none."""
    schema = "record_id string, date string, url string, html string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for data in batch.column("record").to_pylist():
                for fields, block in parse(data or b""):
                    body = block.partition(b"\r\n\r\n")[2]
                    rows.append((fields["WARC-Record-ID"], fields["WARC-Date"], fields["WARC-Target-URI"], body.decode("utf-8")))
            columns = zip(*rows) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["record_id", "date", "url", "html"])

    return only(replica, record_col).toDF("record").mapInArrow(tidied(run), schema)


def _listed(replica: DataFrame, side: int) -> DataFrame:
    """A replica's rows as its manifest lists them, with the digest of the bytes it has."""
    return replica.select(F.lit(side).alias("side"), "segment", "id", F.col("digest").alias("listed"), "length", F.when(F.col("record").isNotNull(), F.sha2("record", 256)).alias("digest"))


def _placed(rows: DataFrame) -> DataFrame:
    """side, segment, id, place, offset, length, digest, leaf."""
    alike = rows.groupBy("side", "segment", "id", F.substring("listed", 1, 3).alias("sub"), "listed", "length", "digest").agg(F.count(F.lit(1)).alias("n"))
    alike = settle(alike, "alike")
    sums = alike.groupBy("side", "segment", "id", "sub").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("length")).alias("bytes"))
    first = Window.partitionBy("side", "segment").orderBy(F.col("id").asc_nulls_first(), "sub").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col("side").alias("s1"), F.col("segment").alias("s2"), F.col("id").alias("s3"), F.col("sub").alias("s4"), F.coalesce(F.sum("n").over(first), F.lit(0)).alias("start"), F.coalesce(F.sum("bytes").over(first), F.lit(0)).alias("at"))
    same = (F.col("side") == F.col("s1")) & (F.col("segment") == F.col("s2")) & F.col("id").eqNullSafe(F.col("s3")) & (F.col("sub") == F.col("s4"))
    within = Window.partitionBy("side", "segment", "id", "sub").orderBy("listed", "length", F.col("digest").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    rows = alike.join(starts, same).withColumn("start", F.col("start") + F.coalesce(F.sum("n").over(within), F.lit(0))).withColumn("at", F.col("at") + F.coalesce(F.sum(F.col("n") * F.col("length")).over(within), F.lit(0)))
    # records alike: a row for each, by runs, so that a row never makes more than RUN of them
    runs = rows.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {RUN}"))))
    numbers = F.sequence(F.col("run") * RUN, F.least(F.col("n"), (F.col("run") + 1) * RUN) - 1)
    rows = runs.withColumn("i", F.explode(numbers))
    rows = rows.select("side", "segment", "id", (F.col("start") + F.col("i")).cast("long").alias("place"), (F.col("at") + F.col("i") * F.col("length")).cast("long").alias("offset"), "length", "digest")
    return rows.withColumn("leaf", F.sha2(F.concat_ws(":", F.lit("leaf"), "offset", "length", F.coalesce("digest", F.lit(""))), 256))


def leaves(replica: DataFrame) -> DataFrame:
    """id, segment, place, offset, length, digest of the replica's bytes, leaf (digest and range hashed).

    A replica has a row for each record of the manifest; a lost record is null.
    """
    return _placed(_listed(replica, 0)).drop("side")


def above(nodes: DataFrame) -> DataFrame:
    """Nodes of up to FAN children of both trees: segment, place, ours, theirs; null where a tree has no children there."""
    def node(side: str) -> Column:
        children = F.transform(F.array_sort(F.collect_list(F.when(F.col(side).isNotNull(), F.struct("place", F.col(side).alias("hash"))))), lambda x: x["hash"])
        return F.when(F.size(children) > 0, F.sha2(F.concat_ws(":", F.lit("node"), children), 256)).alias(side)

    return nodes.groupBy("segment", F.floor(F.col("place") / FAN).alias("parent")).agg(node("ours"), node("theirs")).withColumnRenamed("parent", "place")


def _descend(lowest: DataFrame) -> DataFrame:
    """segment, place of the rows that differ, found from the roots down. lowest: segment, place, ours, theirs, written already."""
    levels = [lowest]
    for _ in range(LEVELS):
        levels.append(settle(above(levels[-1]), "level"))
    differs = ~F.col("ours").eqNullSafe(F.col("theirs"))
    wrong = levels[-1].where(differs).select("segment", "place")
    for level in reversed(levels[:-1]):
        parents = wrong.withColumnRenamed("place", "parent")
        below = level.withColumn("parent", F.floor(F.col("place") / FAN)).join(parents, ["segment", "parent"], "left_semi")
        wrong = below.where(differs).select("segment", "place")
    wrong = settle(wrong, "wrong")
    discard(*levels[1:])
    return wrong


def audit(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """segment, place of the records that differ between two replicas' leaves."""
    both = ours.select("segment", "place", F.col("leaf").alias("ours"), F.lit(None).cast("string").alias("theirs")).unionByName(theirs.select("segment", "place", F.lit(None).cast("string").alias("ours"), F.col("leaf").alias("theirs")))
    return _descend(settle(both.groupBy("segment", "place").agg(F.max("ours").alias("ours"), F.max("theirs").alias("theirs")), "leaves"))


def damaged(manifest: DataFrame, flipped: Column, lost: Column) -> DataFrame:
    """A replica in which some records have their last byte overwritten and others are lost; ranges stay."""
    overwritten = F.concat(F.expr("substring(record, 1, length(record) - 1)"), F.lit(b"#"))
    return manifest.withColumn("record", F.when(lost, F.lit(None)).when(flipped, overwritten).otherwise(F.col("record")))


def report(manifest: DataFrame, replica: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Each record of the manifest with its range, its digest in both replicas, and its status: ok, corrupt or missing."""
    placed = _placed(_listed(manifest, 0).unionByName(_listed(replica, 1)))
    of = lambda side, column: F.max(F.when(F.col("side") == side, F.col(column)))
    rows = placed.groupBy("segment", "place").agg(
        *[of(0, c).alias(c) for c in ("id", "offset", "length", "digest")], of(1, "digest").alias("found"), of(0, "leaf").alias("ours"), of(1, "leaf").alias("theirs"), F.min("side").alias("side")
    )
    rows = settle(rows, "leaves")
    wrong = _descend(rows.select("segment", "place", "ours", "theirs")).withColumn("wrong", F.lit(True))
    out = rows.where("side = 0").join(wrong, ["segment", "place"], "left")
    status = F.when(F.col("wrong").isNull(), "ok").when(F.col("found").isNull(), "missing").otherwise("corrupt")
    return out.select(F.col("id").alias(id_col), "segment", "place", "offset", "length", "digest", F.when(F.col("wrong").isNull(), F.col("digest")).otherwise(F.col("found")).alias("found"), status.alias("status"))


#: DuckDB SQL of the query over pages.
SQL = """
    WITH h AS (SELECT page_id, url, 'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10) || 'Content-Length: ' || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10) || html AS http,
        md5(page_id || ' ' || url || ' ' || html) AS name FROM pages),
    r AS (SELECT page_id, page_id // 256 AS segment,
        encode('WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:uuid:' || name[1:8] || '-' || name[9:12] || '-' || name[13:16] || '-' || name[17:20] || '-' || name[21:32] || '>' || chr(13) || chr(10)
        || 'WARC-Date: 1970-01-01T00:00:00Z' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10) || 'Content-Type: application/http;msgtype=response' || chr(13) || chr(10) || 'Content-Length: ' || strlen(http)
        || chr(13) || chr(10) || chr(13) || chr(10) || http || chr(13) || chr(10) || chr(13) || chr(10)) AS record FROM h),
    o AS (SELECT page_id, segment, CAST(row_number() OVER w - 1 AS BIGINT) AS place, octet_length(record) AS length, record,
        CAST(sum(octet_length(record)) OVER w - octet_length(record) AS BIGINT) AS "offset" FROM r WINDOW w AS (PARTITION BY segment ORDER BY page_id)),
    f AS (SELECT *, CASE WHEN page_id % 211 = 5 THEN 'missing' WHEN page_id % 101 = 7 THEN 'corrupt' ELSE 'ok' END AS status FROM o)
    SELECT page_id, segment, place, "offset", CAST(length AS BIGINT) AS length, sha256(record) AS digest,
        CASE status WHEN 'ok' THEN sha256(record) WHEN 'corrupt' THEN sha256(record[:-2] || '#'::BLOB) END AS found, status FROM f"""
