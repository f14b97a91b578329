"""WARC: archives written from page rows, and read back by boundary-chain verification.

*Writing*: one record per page.  Of pages with equal payloads of at least ``least`` bytes the one
with the largest id is the response, the others are revisits that refer to it.  Records are the
lines of Spark's text writer with ``CRLF CRLF`` as the line separator, which is exactly WARC's
framing, so archives go to any store Spark writes to.  A file holds at most ``records`` records, and
half as many for each doubling of their size, so that it has about ``file_bytes`` at most (or one
longer record) before compression, whatever the sizes.

*Reading*: a task takes whole archives and emits every candidate record, wherever the record
magic stands, with the offset of its successor by its own Content-Length.  A payload may hold
the magic, even a whole well-formed record, so no candidate is believed by itself: pointer
jumping from the start of each file (every round doubles the distance that a pointer
spans) keeps the candidates that the chain from offset 0 reaches, and only those.  Headers may
have any length.  An archive whose chain does not end exactly at its length fails the job.

Null html is an empty payload.  A null page id has no id header and reads back as null; null
and odd URLs are written with CR and LF escaped.  Repeated rows are written as often as they
occur; with equal ids each is a response.  An empty table gives no archive and no record.
Extra columns are ignored.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandflow.llm.common import Scratch

END = "\r\n\r\n"


def write_archives(pages: DataFrame, path: str, least: int = 1000, records: int = 1000, file_bytes: int = 64_000_000) -> None:
    """``page_id, url, html`` rows as gzip-compressed WARC files below ``path``."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumn("size", F.octet_length("payload").cast("long")).withColumn("digest", F.sha1("payload"))
    copies = rows.where(F.col("size") >= least).groupBy("digest", "size").agg(F.max("page_id").alias("holder"), F.count(F.lit(1)).alias("n"))
    rows = rows.join(copies.where("n > 1").drop("n"), ["digest", "size"], "left")
    rows = rows.withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("holder")), F.col("holder")))
    header = F.concat_ws(
        "\r\n", F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.when(F.col("refers_to").isNull(), "response").otherwise("revisit")),
        F.concat(F.lit("WARC-Record-ID: <urn:sha1:"), F.sha1(F.concat_ws("|", "page_id", "url", "digest")), F.lit(">")),
        F.lit("WARC-Date: 1970-01-01T00:00:00Z"),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.concat(F.lit("X-Page-ID: "), F.col("page_id").cast("string")),
        F.concat(F.lit("X-Refers-To-Page-ID: "), F.col("refers_to").cast("string")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(F.col("refers_to").isNull(), F.col("size")).otherwise(F.lit(0)).cast("string")))
    body = F.when(F.col("refers_to").isNull(), F.col("payload")).otherwise(F.lit(""))
    record = F.concat(header, F.lit(END), body)
    # the class of a record's size: 0 up to its share of a file, then one more for each doubling
    size_class = F.greatest(F.lit(0), F.ceil(F.log2(F.octet_length("value") / F.lit(file_bytes / records)))).cast("int")
    in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = rows.select(record.alias("value")).select("value", size_class.alias("c"), in_task.alias("nth"))
    part = F.concat_ws("-", "c", F.expr(f"nth DIV greatest(1, shiftright({records}, least(c, 30)))"))
    rows.select("value", part.alias("part")).write.partitionBy("part").option("lineSep", END).option("compression", "gzip").text(path)


CANDIDATES = T.StructType([
    T.StructField("file", T.LongType()), T.StructField("offset", T.LongType()), T.StructField("next", T.LongType()),
    T.StructField("record_type", T.StringType()), T.StructField("page_id", T.LongType()), T.StructField("refers_to", T.LongType()),
    T.StructField("url", T.StringType()), T.StructField("digest", T.StringType()), T.StructField("payload", T.BinaryType()),
])
_ARROW = pa.schema([("file", pa.int64()), ("offset", pa.int64()), ("next", pa.int64()), ("record_type", pa.string()), ("page_id", pa.int64()),
                    ("refers_to", pa.int64()), ("url", pa.string()), ("digest", pa.string()), ("payload", pa.binary())])
_MAGIC = re.compile(rb"WARC/1\.[01]\r\n")


def plain(content: bytes) -> bytes:
    """An archive's bytes, out of any number of gzip members."""
    out = []
    while content[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(content))
        content = member.unused_data
    return b"".join(out) if out else content


def _number(value: bytes | None) -> int | None:
    return int(value) if value is not None and re.fullmatch(rb"-?\d{1,19}", value) else None


def records_at_magic(data: bytes) -> Iterator[tuple]:
    """Every position that reads like a record whose payload is followed by the record end."""
    starts: list[tuple[int, int]] = []
    head = -1
    for m in _MAGIC.finditer(data):
        if m.start() > head:
            yield from _records_before(data, starts, head)
            starts, head = [], data.find(b"\r\n\r\n", m.start())
            if head < 0:
                return
        starts.append(m.span())
    yield from _records_before(data, starts, head)


def _records_before(data: bytes, starts: list[tuple[int, int]], head: int) -> Iterator[tuple]:
    """The records of all magics (start, end) whose header ends at ``head``.  Lines are read once, from the
    last magic to the first, so many magics before one header end take linear time."""
    fields: dict[bytes, bytes] = {}
    below = head
    for start, lines in reversed(starts):
        for line in reversed(data[lines:below].split(b"\r\n")):
            name, colon, value = line.partition(b":")
            if colon:
                fields[name.strip().lower()] = value.strip()
        below = lines
        size = _number(fields.get(b"content-length"))
        if size is None or size < 0:
            continue
        end = head + 4 + size
        if data[end:end + 4] != b"\r\n\r\n":
            continue
        text = {k: fields.get(k, b"").decode("utf-8", "replace") for k in (b"warc-type", b"warc-target-uri", b"warc-payload-digest")}
        yield (start, end + 4, text[b"warc-type"], _number(fields.get(b"x-page-id")), _number(fields.get(b"x-refers-to-page-id")),
               text[b"warc-target-uri"], text[b"warc-payload-digest"].removeprefix("sha1:"), data[head + 4:end])


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """All candidate records of the archives below ``path``, with their payloads, and for each archive
    one row at the offset of its end, where ``next`` is null."""
    files = spark.read.format("binaryFile").load(path).select(F.xxhash64("path").alias("file"), "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1), strict=True):
                rows, size = [], 0
                data = plain(content.as_py())
                for r in itertools.chain(records_at_magic(data), [(len(data), None, None, None, None, "", None, b"")]):
                    rows.append((file.as_py(), *r))
                    size += len(r[-1]) + len(r[5])
                    if size > 4_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ARROW.types, strict=True)], schema=_ARROW)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ARROW.types, strict=True)], schema=_ARROW)

    return files.mapInArrow(run, CANDIDATES)


def reachable(found: DataFrame, scratch: Scratch) -> DataFrame:
    """The records of ``found`` (``file, offset, next`` and anything else) that the chain from offset 0 of
    their file reaches.  ``found`` is read several times: pass a written table.  Round k marks
    what the first 2^k records of a file lead to, so there are as many rounds as the logarithm
    of the records in the longest file.  Fails if a file's chain does not end at its length."""
    chain = found.select("file", "offset", F.col("next").alias("to"), (F.col("offset") == 0).alias("marked"))
    chain = scratch.write(chain, "chain")
    while True:
        step = chain.where("marked AND to IS NOT NULL").select("file", F.col("to").alias("offset")).distinct()
        new = step.join(chain.where("NOT marked"), ["file", "offset"], "left_semi")
        if not new.limit(1).count():
            break
        ahead = chain.select("file", F.col("offset").alias("to"), F.col("to").alias("further"))
        jumped = chain.join(ahead, ["file", "to"], "left").join(step.withColumn("now", F.lit(True)), ["file", "offset"], "left")
        before = chain
        chain = scratch.write(jumped.select("file", "offset", F.col("further").alias("to"), (F.col("marked") | F.coalesce("now", F.lit(False))).alias("marked")), "chain")
        scratch.drop(before)
    reached = chain.where("marked").select("file", "offset")
    broken = found.where("next IS NULL").select("file", "offset").join(reached, ["file", "offset"], "left_anti").count()
    if broken:
        raise RuntimeError(f"the chain of records does not end at the end of the file in {broken} archives")
    return found.where("next IS NOT NULL").join(reached, ["file", "offset"], "left_semi")
