"""Conversations formatted by a compiled template, and read back: streams over sorted partitions.

Turns are shuffled by conversation and sorted inside the partition, and Python goes through them turn by turn. It holds one
turn, never a conversation, so one with a third of all rows is read by one task but needs no more memory than others. (Its
digests are of one sequence, which has to be read in order.)
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.chat_template import TEMPLATE, compile_template, read_turns, unescape

_FORMATTED = "conv_id long, nth long, chunk string, start long, loss array<struct<start: long, end: long>>"
_READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_BATCH = 512
TURN_ENDS = ("[/INST]", "</s>", "[END]")
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _turns(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int | None, dict]]:
    for batch in batches:
        for row in batch.to_pylist():
            yield row["conv_id"], {"role": row["role"] or "", "text": row["text"] or ""}


def _format(template: str):
    def formatted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)
        turns = _turns(batches)
        rows: list[tuple] = []
        ahead = next(turns, None)
        while ahead is not None:
            conversation = ahead[0]

            def messages(conversation=conversation) -> Iterator[dict]:
                nonlocal ahead
                while ahead is not None and ahead[0] == conversation:
                    message = ahead[1]
                    ahead = next(turns, None)
                    yield message

            own = messages()
            nth, start, size, parts, spans = 0, 0, 0, [], []
            for text, masked in render(own):
                if masked:
                    spans.append({"start": start + size, "end": start + size + len(text)})
                parts.append(text)
                size += len(text)
                if size >= 1 << 16:
                    rows.append((conversation, nth, "".join(parts), start, spans))
                    nth, start, size, parts, spans = nth + 1, start + size, 0, [], []
                    if len(rows) >= _BATCH:
                        yield _batch(rows)
            rows.append((conversation, nth, "".join(parts), start, spans))
            for _ in own:  # turns a template without a loop leaves
                pass
            if len(rows) >= _BATCH:
                yield _batch(rows)
        if rows:
            yield _batch(rows)

    return formatted


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    ids, nth, chunks, starts, spans = zip(*rows, strict=True)
    rows.clear()
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(nth, pa.int64()), pa.array(chunks, pa.string()), pa.array(starts, pa.int64()), pa.array(spans, _SPANS)],
        names=["conv_id", "nth", "chunk", "start", "loss"],
    )


def format_conversations(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """Chunks of formatted conversations: ``conv_id, nth, chunk, start, loss`` (spans of generation blocks, code points).

    Chunks follow each other in the partition; ``start`` is a chunk's place in its conversation's text and spans count from
    there too. A chunk ends after a piece of the template once it has 65,536 code points. Turns are sorted by number (nulls
    first), ties by role and text. Null roles and texts are empty; rows without ``conv_id`` are one conversation; repeated
    rows are turns of their own; other columns are ignored; an empty table gives no rows. A template can go through the
    messages once.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
    )
    turns = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return turns.select("conv_id", "role", "text").mapInArrow(_format(template), _FORMATTED)


class _Digest:
    def __init__(self) -> None:
        self.turns, self.loss_chars, self.chars = 0, 0, 0
        self.all, self.loss, self.open = hashlib.sha256(), hashlib.sha256(), ""

    def add(self, chunk: str, start: int, spans: list[dict]) -> None:
        self.chars += len(chunk)
        for span in spans:
            text = unescape(chunk[span["start"] - start : span["end"] - start])
            self.loss_chars += len(text)
            self.loss.update(text.encode("utf-8"))
        # a turn can go on in the next chunk
        self.open += chunk
        cut = max(self.open.rfind(end) + len(end) if end in self.open else 0 for end in TURN_ENDS)
        self._read(self.open[:cut])
        self.open = self.open[cut:]

    def _read(self, text: str) -> None:
        for role, body in read_turns(text):
            self.turns += 1
            self.all.update("{}\n{}\n".format(role, body).encode("utf-8"))

    def row(self, conversation: int | None) -> tuple:
        self._read(self.open)
        return (conversation, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split(" ")[0] for part in _READ.split(", ")]
    rows: list[tuple] = []
    current, digest = None, None
    for batch in batches:
        for row in batch.to_pylist():
            if row["nth"] == 0:
                if digest is not None:
                    rows.append(digest.row(current))
                current, digest = row["conv_id"], _Digest()
            digest.add(row["chunk"], row["start"], row["loss"])
        if len(rows) >= _BATCH:
            yield _digests(rows, names)
    if digest is not None:
        rows.append(digest.row(current))
    if rows:
        yield _digests(rows, names)


def _digests(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = [pa.array(c, pa.string() if n.endswith("sha256") else pa.int64()) for n, c in zip(names, zip(*rows, strict=True), strict=True)]
    rows.clear()
    return pa.RecordBatch.from_arrays(columns, names=names)


def read_conversations(formatted: DataFrame) -> DataFrame:
    """Turns and loss text read back from ``format_conversations`` with the default template, as digests per conversation."""
    return formatted.mapInArrow(_read, _READ)
