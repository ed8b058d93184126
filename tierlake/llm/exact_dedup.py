"""Exact duplicates by an exchange of Golomb-coded fingerprints.

1. Every partition (a sender) hashes its normalised texts, sorts the distinct fingerprints, cuts them by value among the
   owners and sends each owner one Golomb-coded list.
2. An owner decodes the lists of all senders and answers each with a bitmap: which fingerprints also came from elsewhere.
3. Rows whose bit is set, or whose fingerprint is repeated inside the sender, are suspects. Their texts are read again,
   reduced to one row per text in every task, shuffled and compared byte by byte; only texts that agree form a group.

A sender holds at most ``SENDER_ROWS`` fingerprints at once and sends a fingerprint once, however many copies it has, so a
text that makes up a third of the corpus is one entry of each list. An owner gets its share of all distinct fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import mark_probable, shuffle_width
from tierlake.sources.staging import stage

WHITE = "[\\x20\\x09-\\x0D]+"
FINGERPRINT_BITS = 48
SENDER_ROWS = 1 << 20
FILTER_BITS = 1 << 24
_SENT = "row_id long, digest binary, sender long, owner int, slot int, repeated boolean, packet binary"
_ANSWER = "sender long, owner int, bitmap array<long>"


def normalised(text: Column) -> Column:
    """The text with every run of white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), WHITE, " ")


def golomb_encode(values: np.ndarray) -> bytes:
    """Sorted distinct unsigned values as Golomb-coded gaps: head (count, parameter), unary quotients, remainders."""
    values = np.asarray(values, dtype=np.uint64)
    if not values.size:
        return np.array([0, 0], dtype="<u4").tobytes()
    gaps = np.diff(values, prepend=np.uint64(0))
    mean = max(1.0, float(values[-1]) / values.size * 0.69)
    width = int(np.log2(mean))
    quotients = (gaps >> np.uint64(width)).astype(np.int64)
    unary = np.ones(int(quotients.sum()) + values.size, dtype=np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 0
    shifts = np.arange(width - 1, -1, -1, dtype=np.uint64)
    rest = ((gaps[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
    head = np.array([values.size, width, unary.size], dtype="<u4")
    return head.tobytes() + np.packbits(unary).tobytes() + np.packbits(rest).tobytes()


def golomb_decode(packet: bytes) -> np.ndarray:
    """The values that ``golomb_encode`` was given."""
    count, width = np.frombuffer(packet, dtype="<u4", count=2).tolist()
    if not count:
        return np.empty(0, dtype=np.uint64)
    length = int(np.frombuffer(packet, dtype="<u4", count=1, offset=8)[0])
    body = np.frombuffer(packet, dtype=np.uint8, offset=12)
    cut = (length + 7) // 8
    ends = np.flatnonzero(np.unpackbits(body[:cut], count=length) == 0)
    gaps = (np.diff(ends, prepend=-1) - 1).astype(np.uint64) << np.uint64(width)
    if width:
        bits = np.unpackbits(body[cut:], count=count * width).reshape(count, width)
        rest = np.zeros(count, dtype=np.uint64)
        for column in range(width):
            rest = (rest << np.uint64(1)) | bits[:, column]
        gaps = gaps | rest
    return np.cumsum(gaps, dtype=np.uint64)


def _send(owners: int, bits: int, limit: int):
    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, lists = TaskContext.get().partitionId(), 0
        waiting: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal lists
            table = pa.Table.from_batches(waiting).combine_chunks()
            waiting.clear()
            sender = part * (1 << 24) + lists
            lists += 1
            digest = table.column("digest").combine_chunks()
            heads = np.frombuffer(b"".join(d[:8] for d in digest.to_pylist()), dtype=">u8").astype(np.uint64)
            prints = heads >> np.uint64(64 - bits)
            distinct, inverse, counts = np.unique(prints, return_inverse=True, return_counts=True)
            owner = ((distinct >> np.uint64(max(0, bits - 32))) * np.uint64(owners)) >> np.uint64(min(32, bits))
            owner = owner.astype(np.int32)
            first = np.searchsorted(owner, np.arange(owners + 1))
            slot = (np.arange(distinct.size) - first[owner]).astype(np.int32)
            size = len(table)
            yield pa.RecordBatch.from_arrays(
                [
                    table.column("row_id").combine_chunks(),
                    digest,
                    pa.array(np.full(size, sender)),
                    pa.array(owner[inverse]),
                    pa.array(slot[inverse]),
                    pa.array((counts > 1)[inverse]),
                    pa.nulls(size, pa.binary()),
                ],
                names=["row_id", "digest", "sender", "owner", "slot", "repeated", "packet"],
            )
            held = np.flatnonzero(np.diff(first))
            packets = [golomb_encode(distinct[first[o] : first[o + 1]]) for o in held]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(held.size, pa.int64()),
                    pa.nulls(held.size, pa.binary()),
                    pa.array(np.full(held.size, sender)),
                    pa.array(held.astype(np.int32)),
                    pa.nulls(held.size, pa.int32()),
                    pa.nulls(held.size, pa.bool_()),
                    pa.array(packets, pa.binary()),
                ],
                names=["row_id", "digest", "sender", "owner", "slot", "repeated", "packet"],
            )

        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
            if sum(b.num_rows for b in waiting) >= limit:
                yield from flush()
        if waiting:
            yield from flush()

    return send


def _answer(table: pa.Table) -> pa.Table:
    """One owner's answer to all senders of its range."""
    lists = [golomb_decode(p) for p in table.column("packet").to_pylist()]
    values, inverse, counts = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    shared, maps, at = (counts > 1)[inverse], [], 0
    for one in lists:
        bits = np.zeros(-(-one.size // 64) * 64, dtype=np.uint8)
        bits[: one.size] = shared[at : at + one.size]
        at += one.size
        maps.append(np.packbits(bits, bitorder="little").view("<i8"))
    return pa.table(
        {
            "sender": table.column("sender"),
            "owner": table.column("owner"),
            "bitmap": pa.array([m.tolist() for m in maps], pa.list_(pa.int64())),
        }
    )


def exact_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    digest: Column | None = None,
    owners: int | None = None,
    fingerprint_bits: int = FINGERPRINT_BITS,
    sender_rows: int = SENDER_ROWS,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """One row per document: ``row_id``, ``digest`` (binary), ``keep_id`` (smallest key of the equal texts), ``group_size``.

    Texts are equal if their normalised bytes are. Null and empty texts are equal to each other; repeated rows are copies of
    one another; a null key is never kept before a number; an empty table gives no rows; other columns are ignored, whatever
    their names. ``digest`` replaces the SHA-256 of the normalised text ``body`` (tests use weak ones: groups stay right).
    """
    digest = F.unhex(F.sha2(F.col("body"), 256)) if digest is None else digest
    rows = docs.select(F.col(key).cast("long").alias("row_id"), normalised(F.col(text)).alias("body"))
    send = _send(owners or shuffle_width(docs), fingerprint_bits, sender_rows)
    sent = stage(rows.select("row_id", digest.alias("digest")).mapInArrow(send, _SENT), "fingerprints")
    packets = sent.filter(F.col("packet").isNotNull()).select("sender", "owner", "packet")
    answers = stage(packets.groupBy("owner").applyInArrow(_answer, _ANSWER), "bitmaps")
    told = (
        sent.filter(F.col("packet").isNull())
        .select("row_id", "digest", "sender", "owner", "slot", "repeated")
        .join(answers, ["sender", "owner"])
        .select("row_id", "digest", F.expr("repeated or getbit(get(bitmap, slot div 64), slot % 64) = 1").alias("suspect"))
    )
    told = stage(told, "suspects")
    suspects = told.filter("suspect").select("row_id", "digest")

    again = mark_probable(rows, F.col("row_id"), suspects.select("row_id"), filter_bits, "probable")
    bodies = again.filter("probable").select(digest.alias("digest"), "body", "row_id")
    verified = bodies.groupBy("digest", "body").agg(F.min("row_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    verified = stage(verified, "groups")
    # Texts of one digest that differ: nobody knows any for SHA-256, weak digests have them. Members then join by text too.
    twins = verified.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("digest")
    single = verified.join(twins, "digest", "left_anti").select("digest", "keep_id", "group_size")
    twins = stage(twins, "twins")
    if twins.isEmpty():
        grouped = suspects.join(verified.select("digest", "keep_id", "group_size"), "digest", "left")
    else:
        grouped = suspects.join(twins, "digest", "left_anti").join(single, "digest", "left")
        members = rows.select("row_id", digest.alias("digest"), "body").join(twins, "digest", "left_semi")
        grouped = grouped.unionByName(
            members.join(verified.select("digest", "body", "keep_id", "group_size"), ["digest", "body"], "left").drop("body")
        )
    alone = told.filter("not suspect").select("row_id", "digest", F.lit(None).cast("long").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    return (
        grouped.select("row_id", "digest", "keep_id", "group_size")
        .unionByName(alone)
        .select(
            "row_id",
            "digest",
            F.when(F.coalesce("group_size", F.lit(1)) > 1, F.col("keep_id")).otherwise(F.col("row_id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        )
    )


def whole_rows(docs: DataFrame, **helpers: Column) -> DataFrame:
    """The rows as one column ``row`` beside ``helpers``, whose names can't clash with the rows' own; see ``unpacked``."""
    return docs.select(F.struct(*columns_of(docs)).alias("row"), *[column.alias(name) for name, column in helpers.items()])


def unpacked(packed: DataFrame) -> DataFrame:
    """The rows as they were."""
    return packed.select(*[F.col("row").getField(f.name).alias(f.name) for f in packed.schema["row"].dataType.fields])


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", filter_bits: int = FILTER_BITS) -> DataFrame:
    """The documents without exact copies, columns as they were; of equal texts the smallest key stays.

    Every row is judged by its own text, so a key that repeats with another text loses nothing. Rows that repeat the kept
    key and text are reduced to one of them. Of equal texts without any key one stays; one with a key goes before.
    """
    groups = exact_groups(docs, key, text, filter_bits=filter_bits).filter("group_size > 1")
    kept = stage(groups.groupBy("digest").agg(F.min("keep_id").alias("keep")), "copies")
    digest = F.unhex(F.sha2(normalised(F.col(text)), 256))
    rows = whole_rows(docs, own=F.col(key), mark=digest)
    marked = mark_probable(rows, F.col("mark"), kept.select("digest"), filter_bits, "suspect")
    asked = marked.filter("suspect").join(kept, F.col("mark") == F.col("digest"), "left")
    # texts marked in vain have no copy, so that one row of each mark is all of them
    first = asked.filter("digest is null or own <=> keep").dropDuplicates(["mark"]).select("row")
    return unpacked(marked.filter("not suspect").select("row").unionByName(first))


def columns_of(frame: DataFrame) -> list[Column]:
    """All columns, whatever their names."""
    return [F.col("`{}`".format(c.replace("`", "``"))) for c in frame.columns]


def keep_first(rows: DataFrame, groups: DataFrame, filter_bits: int = FILTER_BITS) -> DataFrame:
    """Of ``rows`` (``row``, ``own``: see ``whole_rows``) drop those whose ``own`` ``groups`` (``row_id``, ``keep_id``) sends
    to another one; one row per kept ``own`` stays. Only rows that ``groups`` may name are shuffled, the others stay.
    """
    named = groups.groupBy("row_id").agg(F.min("keep_id").alias("keep"))
    marked = mark_probable(rows, F.col("own"), named.select("row_id"), filter_bits, "named")
    asked = marked.filter("named").join(named, F.col("own") == F.col("row_id"), "left")
    kept = asked.filter("keep is null").select("row")
    # by row_id, not by own: Spark 4.1 can fail on unions of equally partitioned frames
    first = asked.filter("keep = own").dropDuplicates(["row_id"]).select("row")
    return unpacked(marked.filter("not named").select("row").unionByName(kept).unionByName(first))
