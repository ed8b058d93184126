"""Language by cross-parsing: how few phrases of a language's sample does it take to spell a text?

A suffix automaton per language accepts every substring of its sample. A text is cut into the longest phrases the automaton
can follow; the language with the fewest phrases per character wins. As a table of transitions the automaton is a scan (a
missing transition ends a phrase and begins the next at the root), so thousands of pieces of text are parsed in step. The
table has a column for each of a sample's ``COMMON_LETTERS`` most frequent letters; transitions by other letters are looked up
in a sorted list, so its size doesn't follow the alphabet.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tierlake.llm.common import in_draw
from tierlake.sources.staging import stage

SAMPLE_ROWS = 48
SAMPLE_CHARS = 16_000
SAMPLE_PIECE = 96
COMMON_LETTERS = 63
PIECE = 1024
SLICE_CHARS = 2_000_000
UNKNOWN = "und"
_SPACE = 32


@cache
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def normalise(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased letters of all texts as code points, runs of others as one space, and each text's offset."""
    lowered = [t.lower() for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in lowered], dtype=np.int64)])
    letter = letters()[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    edges = bounds[(bounds > 0) & (bounds < points.size)]
    keep[edges] = letter[edges]
    out = np.where(letter, points, _SPACE)[keep]
    return out, np.concatenate([[0], np.cumsum(keep, dtype=np.int64)])[bounds]


def suffix_automaton(text: str) -> list[dict[str, int]]:
    """Transitions of the automaton of all substrings, states in order of creation, the root first."""
    moves: list[dict[str, int]] = [{}]
    link, length, last = [-1], [0], 0
    for letter in text:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        state = last
        while state >= 0 and letter not in moves[state]:
            moves[state][letter] = new
            state = link[state]
        if state >= 0:
            target = moves[state][letter]
            if length[target] == length[state] + 1:
                link[new] = target
            else:
                copy = len(moves)
                moves.append(dict(moves[target]))
                length.append(length[state] + 1)
                link.append(link[target])
                while state >= 0 and moves[state].get(letter) == target:
                    moves[state][letter] = copy
                    state = link[state]
                link[target] = link[new] = copy
        last = new
    return moves


class Parser:
    """Phrase counts for one language's sample (normalised text)."""

    def __init__(self, sample: str) -> None:
        moves = suffix_automaton(sample)
        often = Counter(sample)
        alphabet = {c: i for i, c in enumerate(sorted(moves[0], key=lambda c: (-often[c], c)), 1)}
        self.width, self.size = min(len(alphabet), COMMON_LETTERS) + 1, len(alphabet) + 1
        self.symbols = np.zeros(0x110000, dtype=np.int32)
        for letter, symbol in alphabet.items():
            self.symbols[ord(letter)] = symbol
        # odd entries: a phrase ends before this letter; a letter the sample lacks is a phrase of its own (the last state)
        alone = len(moves)
        self.fresh = np.full(self.size, 2 * alone + 1, dtype=np.int32)
        for letter, state in moves[0].items():
            self.fresh[alphabet[letter]] = 2 * state + 1
        table = np.tile(self.fresh[: self.width], (len(moves) + 1, 1))
        table[0] -= 1
        rare = []
        for state, row in enumerate(moves):
            for letter, target in row.items():
                symbol = alphabet[letter]
                if symbol < self.width:
                    table[state, symbol] = 2 * target
                else:
                    rare.append((state * self.size + symbol, 2 * target))
        self.table = table.ravel()
        rare.sort()
        self.rare = np.array([place for place, _ in rare], dtype=np.int64)
        self.rare_target = np.array([target for _, target in rare], dtype=np.int32)

    def phrases(self, grid: np.ndarray, active: np.ndarray) -> np.ndarray:
        """Phrases of each column of ``grid`` (code points by step; in step t the first ``active[t]`` columns have text)."""
        count = np.ones(grid.shape[1], dtype=np.int64)
        state = np.zeros(grid.shape[1], dtype=np.int32)
        for step in range(grid.shape[0]):
            n = active[step]
            symbol = self.symbols[grid[step, :n]]
            if self.rare.size:
                listed = np.flatnonzero(symbol >= self.width)
                asked = symbol[listed]
                place = (state[listed] >> 1).astype(np.int64) * self.size + asked
                at = np.minimum(np.searchsorted(self.rare, place), self.rare.size - 1)
                target = np.where(self.rare[at] == place, self.rare_target[at], self.fresh[asked])
                symbol[listed] = 0
                moved = self.table[(state[:n] >> 1) * self.width + symbol]
                moved[listed] = target
            else:
                moved = self.table[(state[:n] >> 1) * self.width + symbol]
            state[:n] = moved
            count[:n] += moved & 1
        return count


def count_phrases(points: np.ndarray, bounds: np.ndarray, parsers: list[Parser]) -> np.ndarray:
    """Phrases of every text (row) for every parser; texts longer than ``PIECE`` are parsed in pieces."""
    sizes = np.diff(bounds)
    pieces = -(-sizes // PIECE)
    row = np.repeat(np.arange(sizes.size), pieces)
    nth = np.arange(row.size) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = bounds[row] + nth * PIECE
    length = np.minimum(PIECE, bounds[row + 1] - start)
    out = np.zeros((sizes.size, len(parsers)), dtype=np.int64)
    if not row.size:
        return out
    order = np.argsort(-length, kind="stable")
    start, length, row = start[order], length[order], row[order]
    steps = np.arange(int(length[0]))
    active = np.searchsorted(-length, -steps, side="left")
    grid = points[np.minimum(start[None, :] + steps[:, None], points.size - 1)]
    for i, parser in enumerate(parsers):
        np.add.at(out[:, i], row, parser.phrases(grid, active))
    return out


def held_out(key: Column) -> Column:
    """Rows kept from learning: those whose key's CRC-32 leaves 2 modulo 4. A null key counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def _pieces(body: Column, key: Column, chars: int) -> Column:
    """Up to about ``chars`` characters of a text: all of a short one, else pieces at hashed places, one in each equal stretch."""
    count = -(-chars // SAMPLE_PIECE)
    size = F.char_length(body)
    place = lambda i: ((i + F.pmod(F.xxhash64(key, i), F.lit(1 << 20)) / float(1 << 20)) * (size - SAMPLE_PIECE) / count).cast("int") + 1
    order = F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: F.struct(F.xxhash64(i, key).alias("h"), i.alias("i"))))
    drawn = F.transform(order, lambda o: F.substring(body, place(o["i"]), F.lit(SAMPLE_PIECE)))
    return F.when(size <= count * SAMPLE_PIECE, F.array(body)).otherwise(drawn)


def equal_shares(sizes: list[int], total: int) -> int:
    """The largest share for which all of ``min(size, share)`` together are at most ``total``."""
    left = total
    for nth, size in enumerate(sorted(sizes)):
        share = left // (len(sizes) - nth)
        if size > share:
            return share
        left -= size
    return max(sizes, default=0)


def learn_samples(docs: DataFrame, key: str, text: str, label: str, rows: int, chars: int) -> dict[str, str]:
    """Normalised sample per language: at most ``rows`` rows not held out, chosen by key hash, and ``chars`` characters.

    Every row has the same share of the characters (what a short text leaves goes to the others), in pieces of
    ``SAMPLE_PIECE`` characters from hashed places all over the text.
    """
    known = docs.select(F.col(key).cast("long").alias("row_id"), F.col(text).cast("string").alias("body"), F.col(label).cast("string").alias("label"))
    known = known.filter(F.col("label").isNotNull() & F.col("body").rlike("\\p{L}") & ~held_out(F.col("row_id")))
    # a row per language, as the driver's samples; stored, so that the planner knows its size
    totals = stage(known.groupBy("label").agg(F.count(F.lit(1)).alias("total")), "languages")
    known = known.join(totals, "label").filter(in_draw(F.col("row_id"), F.col("total"), rows))
    order = W.partitionBy("label").orderBy(F.xxhash64("row_id"), "row_id", "body")
    chosen = known.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= rows)
    pieces = _pieces(F.col("body"), F.coalesce("row_id", F.lit(0)), max(SAMPLE_PIECE, 4 * chars // rows))
    found: dict[str, list[np.ndarray]] = {}
    for row in chosen.select("label", "nth", pieces.alias("pieces")).orderBy("label", "nth").collect():
        points, _ = normalise([" ".join(row["pieces"]) + " "])
        found.setdefault(row["label"], []).append(points)
    samples = {}
    for name, parts in found.items():
        share = equal_shares([p.size for p in parts], chars)
        points = np.concatenate([p[:share] for p in parts])
        samples[name] = points.astype("<u4").tobytes().decode("utf-32-le", "replace")
    return samples


_parsers: dict[str, Parser] = {}


def _parser(sample: str) -> Parser:
    if sample not in _parsers:
        if len(_parsers) > 64:
            _parsers.clear()
        _parsers[sample] = Parser(sample)
    return _parsers[sample]


def predict_language(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "lang",
    samples: dict[str, str] | None = None,
    sample_rows: int = SAMPLE_ROWS,
    sample_chars: int = SAMPLE_CHARS,
) -> DataFrame:
    """One row per document: ``row_id``, ``held_out``, ``lang_pred`` and ``score``.

    The score is the runner-up's phrases over the sum of the winner's and the runner-up's, 1 with a single language. Ties go
    to the name that sorts first. Null texts, texts without letters, and all texts if nothing could be learned are ``und``
    with score 0. Repeated rows get the same result each; null labels aren't learned from; an empty table gives no rows. A
    worker holds one table of at most ``2 * sample_chars`` states and ``COMMON_LETTERS`` + 1 columns for each language.
    """
    samples = learn_samples(docs, key, text, label, sample_rows, sample_chars) if samples is None else samples
    names = sorted(samples)

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parsers = [_parser(samples[n]) for n in names]
        for batch in batches:
            texts = pc.fill_null(batch.column(2), "").to_pylist()
            first = 0
            while first < len(texts):
                last, size = first, 0
                while last < len(texts) and (last == first or size + len(texts[last]) <= SLICE_CHARS):
                    size += len(texts[last])
                    last += 1
                points, bounds = normalise(texts[first:last])
                phrases = count_phrases(points, bounds, parsers)
                some = (np.add.reduceat(np.append(letters()[points], False), bounds[:-1]) > 0) & (np.diff(bounds) > 0) if points.size else np.zeros(last - first, bool)
                some &= bool(names)
                best = phrases.argmin(axis=1) if names else np.zeros(last - first, int)
                lowest = np.sort(phrases, axis=1)[:, :2].astype(float) if names else np.ones((last - first, 1))
                score = lowest[:, 1] / np.maximum(lowest.sum(axis=1), 1) if lowest.shape[1] > 1 else np.ones(last - first)
                found = [names[b] if s else UNKNOWN for b, s in zip(best.tolist(), some.tolist(), strict=True)]
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(found, pa.string()), pa.array(np.where(some, score, 0.0))],
                    names=["row_id", "held_out", "lang_pred", "score"],
                )
                first = last

    rows = docs.select(F.col(key).cast("long").alias("row_id"), F.col(text).cast("string").alias("body"))
    rows = rows.select("row_id", held_out(F.col("row_id")).alias("held_out"), "body")
    return rows.mapInArrow(predict, "row_id long, held_out boolean, lang_pred string, score double")
