"""WARC archives written from pages and read back by segment reassembly.

Writing: pages whose payload another page has as well become revisits of the one with the largest identifier; who they are is
found on digests, and only pages that may be revisits are shuffled. Records go to files of at most ``RECORDS_PER_FILE`` records
through Spark's writer, so archives can lie in any store.

Reading: whole files are parsed in parallel, and records that are whole are decoded at once. Records that are segments (a first record with a segment number, continuations
that name it as their origin) are grouped by the origin, ordered by number, checked for gaps and against the stated total
length, joined, and the chunked transfer coding is undone. A group is one page's block.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.llm.common import mark_probable
from tierlake.llm.exact_dedup import FILTER_BITS
from tierlake.llm.warc_format import SEGMENT_BYTES, Damaged, page_records, payload_of, read_records, sha1
from tierlake.sources.staging import new_folder, stage

REVISIT_BYTES = 1000
RECORDS_PER_FILE = 500
_NO_KEY = -(2**63)
_SEGMENT = "origin string, number int, total long, block binary"
_PAGES = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary, problem string"


def _payload(html: Column) -> Column:
    return F.coalesce(html.cast("string"), F.lit("")).cast("binary")


def _records(limit: int):
    def records(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[bytes] = []
            size = 0
            for page_id, url, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for record in page_records(page_id, url, payload, refers_to, limit):
                    out.append(record)
                    size += len(record)
                if size > 4_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    return records


def write_archives(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    revisit_bytes: int = REVISIT_BYTES,
    segment_bytes: int = SEGMENT_BYTES,
    records_per_file: int = RECORDS_PER_FILE,
    filter_bits: int = FILTER_BITS,
) -> None:
    """Write a record per page to WARC files in ``folder``.

    Of equal payloads of at least ``revisit_bytes`` the page with the largest key is the response and the others revisit it;
    rows that repeat the largest key are responses as well. Smaller payloads are responses. Null pages are empty, null URLs
    ``about:blank``; a row without a key revisits an equal page that has one and is a response otherwise.
    """
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), _payload(F.col(html)).alias("payload"))
    rows = rows.withColumn("place", F.coalesce("page_id", F.lit(_NO_KEY)))
    large = rows.filter(F.length("payload") >= revisit_bytes).select("page_id", "place", F.unhex(F.sha2("payload", 256)).alias("digest"))
    large = stage(large, "payloads")
    kept = large.groupBy("digest").agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("n")).filter("n > 1 and kept is not null")
    again = large.join(kept.select("digest", "kept"), "digest").filter("not page_id <=> kept").select("place", "digest", "kept").distinct()
    again = stage(again, "revisits")
    marked = mark_probable(rows, F.col("place"), again.select("place"), filter_bits, "probable")
    asked = marked.filter("probable").withColumn("digest", F.unhex(F.sha2("payload", 256))).join(again, ["place", "digest"], "left")
    columns = ["page_id", "url", "payload"]
    told = marked.filter("not probable").select(*columns, F.lit(None).cast("long").alias("refers_to")).unionByName(
        asked.select(*columns, F.when(F.length("payload") >= revisit_bytes, F.col("kept")).alias("refers_to"))
    )
    records = told.mapInArrow(_records(segment_bytes), "record binary").select(F.col("record").cast("string").alias("value"))
    writer = records.write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", records_per_file).option("compression", "none")
    writer.text(folder)


def _decoded(kind: str, digest: str, block: bytes) -> tuple[int | None, bytes | None, str | None]:
    """Payload length, payload and problem of a record whose block is whole; a revisit has no payload."""
    try:
        payload, stated = payload_of(block)
        if kind == "revisit":
            return stated, None, None
        if digest and sha1(payload) != digest:
            raise Damaged("The payload doesn't have its digest")
        return len(payload), payload, None
    except Damaged as error:
        return None, None, str(error)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    fields = [part.split(" ") for part in schema.split(", ")]
    columns = [pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows, strict=True), fields, strict=True)]
    rows.clear()
    return pa.RecordBatch.from_arrays(columns, names=[n for n, _ in fields])


def _parse(with_payload: bool):
    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, none = "{}, {}".format(_PAGES, _SEGMENT), (None,) * 4
        number = lambda headers, name: int(headers[name]) if name in headers else None
        for batch in batches:
            for content in batch.column(0):
                rows: list[tuple] = []
                size = 0
                try:
                    for headers, block in read_records(content.as_buffer().to_pybytes()):
                        kind = headers.get("warc-type")
                        if kind not in ("response", "revisit", "continuation"):
                            continue
                        digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
                        about = (number(headers, "x-page-id"), number(headers, "x-refers-to-page-id"))
                        nth = number(headers, "warc-segment-number")
                        if nth is None:
                            length, payload, problem = _decoded(kind, digest, block)
                            rows.append((about[0], length, digest, kind, about[1], payload if with_payload else None, problem, *none))
                            size += len(payload or b"") if with_payload else 200
                        else:
                            origin = headers.get("warc-segment-origin-id") or headers.get("warc-record-id")
                            total = number(headers, "warc-segment-total-length")
                            rows.append((about[0], None, digest, kind, None, None, None, origin, nth, total, block))
                            size += len(block)
                        if size > 4_000_000:
                            yield _batch(rows, schema)
                            size = 0
                except Damaged as error:
                    rows.append((None,) * 6 + (str(error), *none))
                if rows:
                    yield _batch(rows, schema)

    return parse


def _join(with_payload: bool):
    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for kind, page_id, digest, blocks, total, problem in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                length, payload = None, None
                if problem is None:
                    block = b"".join(blocks)
                    if total == len(block):
                        length, payload, problem = _decoded(kind, digest, block)
                    else:
                        problem = "The segments have {} bytes instead of {}".format(len(block), total)
                rows.append((page_id, length, digest, kind, None, payload if with_payload else None, problem))
            if rows:
                yield _batch(rows, _PAGES)

    return join


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """A row per response or revisit in the WARC files of ``folder``: ``page_id, payload_bytes, payload_digest, record_type,
    refers_to, payload, problem``.

    ``problem`` says what is wrong with a record (missing or surplus segments, lengths, digests, chunks, orphaned continuations)
    or with a file from some record on; it is null for sound records. Records stored twice are returned twice. An empty
    folder gives no rows.
    """
    files = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    files = files.option("pathGlobFilter", "*.txt").load(folder)
    parse = files.filter("length > 0").select("content").mapInArrow(_parse(with_payload), "{}, {}".format(_PAGES, _SEGMENT))
    parsed = stage(parse, "records")
    whole = parsed.filter("number is null").drop("origin", "number", "total", "block")
    first = lambda name: F.max(F.when(F.col("number") == 1, F.col(name))).alias(name)
    groups = parsed.filter("number is not null").groupBy("origin").agg(
        first("record_type"), first("page_id"), first("payload_digest"), F.max("total").alias("total"),
        F.array_sort(F.collect_set(F.struct("number", "block"))).alias("segments"),
        F.count_if(F.col("number") == 1).alias("copies"),
    )
    gaps = F.expr("transform(segments, s -> s.number) != sequence(1, size(segments))")
    problem = F.when(F.col("copies") == 0, F.lit("No first segment")).when(gaps, F.lit("Segments are missing or contradict each other"))
    problem = problem.when(F.col("total").isNull(), F.lit("The last segment is missing"))
    joined = groups.select(
        "record_type", "page_id", "payload_digest", F.expr("transform(segments, s -> s.block)").alias("blocks"), "total",
        problem.alias("problem"), F.explode(F.expr("sequence(1, greatest(1, copies))")).alias("copy"),
    ).drop("copy")
    return whole.unionByName(joined.mapInArrow(_join(with_payload), _PAGES))


def roundtrip(pages: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Pages written to archives (in a staged folder unless one is named) and read back, without payloads."""
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "archives")
    write_archives(pages, folder, **options)
    return read_archives(spark, folder, with_payload=False)
