"""Token counts by heap-and-linked-list byte-pair merging; no token identifiers are made.

A piece of text starts as a linked list of bytes. A heap holds its adjacent pairs by merge rank and position; the lowest is
popped and merged until no pair has a rank. The count is the number of bytes minus the number of merges. Counts of pieces
already seen are kept in a table of bounded size, as pieces repeat.
"""

from __future__ import annotations

import heapq
import json
import uuid
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the split pattern of byte-level vocabularies of this kind. White space is the Unicode property.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"""
KNOWN_PIECES = 1 << 19
LONGEST_KNOWN = 64


def byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level vocabularies: printable ones for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


def read_merges(path: str) -> tuple[dict[tuple[bytes, bytes], int], list[str]]:
    """Merge ranks by pair of byte strings, and strings of added tokens, from a tokenizer file of byte-level BPE."""
    file = json.loads(Path(path).read_text(encoding="utf-8"))
    model, split = file["model"], file["pre_tokenizer"] or {}
    if model["type"] != "BPE" or split.get("type") != "ByteLevel" or not split.get("use_regex", True) or file["normalizer"]:
        raise ValueError("Only byte-level BPE files without a normalizer are supported")
    if split.get("add_prefix_space") or model.get("ignore_merges") or model.get("dropout"):
        raise ValueError("Prefix spaces, ignored merges and dropout are not supported")
    added = file.get("added_tokens", [])
    if any(t.get(flag) for t in added for flag in ("lstrip", "rstrip", "single_word", "normalized")):
        raise ValueError("Added tokens that look at their surroundings are not supported")
    alphabet = byte_alphabet()
    to_bytes = lambda text: bytes(alphabet[c] for c in text)
    pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
    return {(to_bytes(a), to_bytes(b)): rank for rank, (a, b) in enumerate(pairs)}, [t["content"] for t in added]


def merged_length(piece: bytes, ranks: dict[tuple[bytes, bytes], int]) -> int:
    """Number of symbols left when no adjacent pair of the piece has a rank."""
    size = len(piece)
    symbols: list[bytes | None] = [piece[i : i + 1] for i in range(size)]
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    heap = []
    for i in range(size - 1):
        rank = ranks.get((symbols[i], symbols[i + 1]))
        if rank is not None:
            heap.append((rank, i, symbols[i], symbols[i + 1]))
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if symbols[i] != left or j >= size or symbols[j] != right:
            continue  # one of the two has been merged since
        merges += 1
        symbols[i], symbols[j] = left + right, None
        k = after[i] = after[j]
        if k < size:
            before[k] = i
            rank = ranks.get((symbols[i], symbols[k]))
            if rank is not None:
                heapq.heappush(heap, (rank, i, symbols[i], symbols[k]))
        h = before[i]
        if h >= 0:
            rank = ranks.get((symbols[h], symbols[i]))
            if rank is not None:
                heapq.heappush(heap, (rank, h, symbols[h], symbols[i]))
    return size - merges


class _Counts(dict):
    """Counts of pieces; long pieces and those beyond ``KNOWN_PIECES`` entries are computed again."""

    def __init__(self, ranks: dict[tuple[bytes, bytes], int]) -> None:
        super().__init__()
        self.ranks = ranks

    def __missing__(self, piece: str) -> int:
        count = merged_length(piece.encode("utf-8", "replace"), self.ranks)
        if len(piece) <= LONGEST_KNOWN:
            if len(self) >= KNOWN_PIECES:
                self.clear()
            self[piece] = count
        return count


class Counter:
    """Counts tokens of texts for one tokenizer file's merges and added tokens."""

    def __init__(self, ranks: dict[tuple[bytes, bytes], int], added: list[str]) -> None:
        self.counts = _Counts(ranks)
        self.split = regex.compile(PIECES).findall
        longest_first = sorted(added, key=lambda t: (-len(t), t))
        self.added = regex.compile("|".join(map(regex.escape, longest_first))) if longest_first else None

    def count(self, text: str) -> int:
        known = self.counts.__getitem__
        if self.added is None or not self.added.search(text):
            return sum(map(known, self.split(text)))
        total = len(self.added.findall(text))
        return total + sum(sum(map(known, self.split(part))) for part in self.added.split(text))


_counters: dict[str, Counter] = {}


def count_tokens(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", limit: int = 512) -> DataFrame:
    """One row per document: ``row_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    ``vocabulary`` is the path of a tokenizer file on the driver, which sends its merges to the executors. Strings of added
    tokens inside a text count as one token. Null and empty texts have none; repeated rows are counted each; keys may be
    null; other columns are ignored. An empty table gives no rows.
    """
    session = docs.sparkSession
    model, token = session.sparkContext.broadcast(read_merges(vocabulary)), uuid.uuid4().hex

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counters.get(token)
        if counter is None:  # the table of known pieces outlives the task
            _counters.clear()
            counter = _counters[token] = Counter(*model.value)
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            tokens = np.fromiter((counter.count(t.as_py()) for t in texts), dtype=np.int64, count=len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.cast(pc.binary_length(texts), pa.int64()), pa.array(tokens), pa.array(tokens > limit)],
                names=["row_id", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.select(F.col(key).cast("long").alias("row_id"), F.col(text).cast("string").alias("body"))
    return rows.mapInArrow(count, "row_id long, n_bytes long, n_tokens long, over_limit boolean")
