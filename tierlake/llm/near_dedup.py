"""Near duplicates: a blocked sparse product of the document by n-gram incidence matrix.

Rows of the matrix are documents, columns the hashed word n-grams. Two rows of n and m entries are linked if they share at
least ``need(n, m)`` columns, which follows from the sizes alone.

1. Candidates. All rows order their columns alike, by how often the columns occur, rarest first; linked rows then have one of
   the first ``n - need + 1`` of each in common (about a fifth of a row at 0.8). A row sends these columns only, to owners by
   hash. Of a column that ``PAIRED`` rows or fewer have, each pair is a candidate that must pass bounds first: their sizes,
   and the sketches of their columns, which differ in no more bits than the rows in columns. So columns that two texts share
   by chance connect nothing, however many there are. Rows that share a column of more rows become neighbours of the one
   with the smallest key (a star, never all pairs). Connected neighbours form a row block. A passage shared by many
   documents is common, so it comes last and draws none together. Any common order is right; this one is of counts over all
   documents, exchanged as Golomb-coded lists of fingerprints and returned as bit tables of bounded size.
2. Product. Rows of one row block are multiplied with each other. A row's rarest columns come first: partners they don't
   reach, or whose size is out of range, stay below the bound and are discarded; for the rest overlaps are added up and
   compared with the bound. Rows already in the largest group of links needn't be multiplied once all others have been.
3. Links (a spanning forest of them) are joined to components.

Row blocks above ``TILE_SHINGLES`` entries are first divided by size: linked rows lie in one size band or in two neighbouring
ones, so a row goes to two parts at most. What is still above the limit is cut into tiles that share two pivots; then rows
outside the part's largest group are multiplied with every tile. So memory is bounded and no link is lost, whatever the
size of a block.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import distinct_sorted, mark_probable, mix, packed, shingles, shuffle_width, text_slices
from tierlake.llm.components import components
from tierlake.llm.exact_dedup import FILTER_BITS, golomb_decode, golomb_encode, keep_first, whole_rows
from tierlake.sources.staging import stage

SEND_SHINGLES = 1 << 20
TILE_SHINGLES = 1 << 21
CELL_BITS = 36
TABLE_BITS = 28
TABLE_LOAD = 1
PAIRED = 4
SKETCH_BITS = 1 << 14
COMMON = [2, 4, 16, 64, 256, 1024]
Tables = tuple[tuple[int, np.ndarray], ...]
_LISTS = "run long, cells binary, more binary"
_RUNS = "run long, least long, n long, cells binary"
_BITS = "run long, bits binary"
_SENT = "owner int, row_id long, n long, a long, b long, sketch binary, blocks binary, rows binary, sizes binary, places binary"
_MET = "row_id long, n long, a long, b long, asked boolean, sketch binary"
_SETS = "root long, tile int, tiles int, probe boolean, row_id long, columns binary"
_LINKS = "a long, b long"


def need(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Smallest number of shared columns with which rows of n and m entries are linked."""
    return -(-(percent * (n + m)) // (100 + percent))


@cache
def bands(percent: int) -> np.ndarray:
    """Lowest sizes of the size bands: a linked pair lies in one band or in two neighbouring ones."""
    low = [1]
    while low[-1] < 1 << 40:
        low.append(low[-1] * 100 // percent + 1)
    return np.array(low[:-1])


def _cells(values: np.ndarray) -> np.ndarray:
    """The fingerprint of ``CELL_BITS`` bits by which a column is counted."""
    return mix(values) >> np.uint64(64 - CELL_BITS)


def block_values(
    rows: np.ndarray, values: np.ndarray, sizes: np.ndarray, percent: int, tables: Tables = ()
) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the rarest columns of sorted sets: what linked rows have at least one of in common.

    ``tables`` are those of ``common_columns``; without them columns are ordered by their hash alone. A column that surely
    occurs once takes its place among the rarest and is left out.
    """
    cells = _cells(values)
    rank = np.zeros(values.size, dtype=np.uint8)
    for _, bits in tables:
        at = cells >> np.uint64(CELL_BITS - (bits.size * 8).bit_length() + 1)
        rank += (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1)
    order = np.lexsort((values, rank, rows))
    sent = np.where(sizes > 0, sizes - need(sizes, -(-percent * sizes // 100), percent) + 1, 0)
    position = np.arange(values.size) - (np.cumsum(sizes) - sizes)[rows]
    order = order[position < sent[rows]]
    if tables and tables[0][0] == 2:
        order = order[rank[order] > 0]
    return rows[order], values[order]


def _count(size: int, run_bits: int, limit: int):
    """Lists of the columns of about ``limit`` entries: Golomb-coded fingerprints, cut by range, and counts above one."""

    def lists(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        cells, counts = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        bounds = np.searchsorted(cells >> np.uint64(CELL_BITS - run_bits), np.arange((1 << run_bits) + 1))
        some = np.flatnonzero(np.diff(bounds))
        inside = cells & np.uint64((1 << (CELL_BITS - run_bits)) - 1)
        packets, more = [], []
        for run in some:
            part = slice(bounds[run], bounds[run + 1])
            packets.append(golomb_encode(inside[part]))
            at = np.flatnonzero(counts[part] > 1)
            more.append(np.stack([at, counts[part][at]]).astype(np.int64).tobytes())
        yield _rows(some.size, _LISTS, run=some, cells=packets, more=more)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for batch in batches:
            for _, offsets, content in text_slices(batch.column(0)):
                _, values = distinct_sorted(*shingles(offsets, content, size))
                held.append(_cells(values))
                total += values.size
                if total >= limit:
                    yield from lists(held)
                    total = 0
        if held:
            yield from lists(held)

    return count


def _common(table: pa.Table) -> pa.Table:
    """One range of fingerprints: those that occur ``COMMON`` times or more, each threshold a list."""
    cells, counts = [], []
    for packet, more in zip(table.column("cells"), table.column("more"), strict=True):
        cells.append(golomb_decode(packet.as_py()))
        counts.append(np.ones(cells[-1].size, dtype=np.int64))
        at, count = np.frombuffer(more.as_py(), dtype=np.int64).reshape(2, -1)
        counts[-1][at] = count
    cells, counts = np.concatenate(cells), np.concatenate(counts)
    order = np.argsort(cells)
    cells, counts = cells[order], counts[order]
    first = np.flatnonzero(np.diff(cells, prepend=~cells[:1]) != 0)
    cells, counts = cells[first], np.add.reduceat(counts, first) if first.size else counts[:0]
    found = [cells[counts >= least] for least in COMMON]
    run = table.column("run")[0].as_py()
    batch = _rows(
        len(COMMON), _RUNS, run=[run] * len(COMMON), least=COMMON, n=[f.size for f in found], cells=[golomb_encode(f) for f in found]
    )
    return pa.Table.from_batches([batch])


def _bits(run_bits: int, table_bits: int):
    """The part of a bit table that a range's fingerprints fill."""

    def bits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            filled = []
            for packet in batch.column("cells"):
                marks = np.zeros(1 << (table_bits - run_bits), dtype=np.uint8)
                marks[golomb_decode(packet.as_py()) >> np.uint64(CELL_BITS - table_bits)] = 1
                filled.append(np.packbits(marks, bitorder="little").tobytes())
            yield _rows(batch.num_rows, _BITS, run=batch.column("run"), bits=filled)

    return bits


def common_columns(bodies: DataFrame, size: int, owners: int, limit: int, table_bits: int, most_load: float = 1 / 8) -> Tables:
    """Bit tables of the columns that occur in at least 2, 4, 16, ... of all texts of ``bodies`` (one column).

    Columns are counted exactly but for equal fingerprints. A table has eight bits or more for each of its columns, up to
    2 ** ``table_bits`` bits; at that size it takes ``most_load`` columns a bit. One of more columns is left out: then columns
    below the next threshold count as equally rare. Full or missing tables bring more rows together and change no result.
    So what is broadcast has a fixed bound.
    """
    run_bits = min((8 * owners - 1).bit_length(), table_bits - 3)
    lists = bodies.mapInArrow(_count(size, run_bits, limit), _LISTS)
    counted = stage(lists.groupBy("run").applyInArrow(_common, _RUNS), "common-columns")
    tables = []
    for row in counted.groupBy("least").agg(F.sum("n").alias("n")).orderBy("least").collect():
        wanted = max((8 * row["n"]).bit_length(), run_bits + 3)
        if wanted > table_bits and row["n"] <= most_load * (1 << table_bits):
            wanted = table_bits
        if not row["n"] or wanted > table_bits:
            continue
        table = np.zeros(1 << (wanted - 3), dtype=np.uint8)
        width = 1 << (wanted - 3 - run_bits)
        parts = counted.filter((F.col("least") == row["least"]) & (F.col("n") > 0)).select("run", "cells")
        for part in parts.mapInArrow(_bits(run_bits, wanted), _BITS).toLocalIterator():
            table[part["run"] * width : (part["run"] + 1) * width] = np.frombuffer(bytes(part["bits"]), dtype=np.uint8)
        tables.append((row["least"], table))
    return tuple(tables)


def _places(values: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where the distinct (value, id) are, by value and id; the number of each among its value's; which are of values that more
    than ``PAIRED`` ids have; and for those the (smallest id, other id) pairs.
    """
    order = np.lexsort((ids, values))
    fresh = np.ones(values.size, dtype=bool)
    fresh[1:] = (values[order[1:]] != values[order[:-1]]) | (ids[order[1:]] != ids[order[:-1]])
    order = order[fresh]
    values, ids = values[order], ids[order]
    fresh = np.ones(values.size, dtype=bool)
    fresh[1:] = values[1:] != values[:-1]
    first = np.flatnonzero(fresh)
    count = np.diff(first, append=values.size)
    many = np.repeat(count > PAIRED, count)
    centre = np.repeat(ids[first], count)
    star = many & (centre != ids)
    return order, np.arange(values.size) - np.repeat(first, count), many, *distinct_sorted(centre[star], ids[star])


def sketches(values: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the sketches of rows, and where each begins: the parities of a row's columns dealt over hashed bits.

    A row has about as many bits as columns (a power of two, ``SKETCH_BITS`` at most). Two sketches, the longer folded to the
    length of the other, differ in no more bits than their rows do in columns.
    """
    bits = np.clip(1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64), 64, SKETCH_BITS)
    bounds = np.concatenate([[0], np.cumsum(bits)])
    inside = (values & np.repeat(bits - 1, sizes).astype(np.uint64)).astype(np.int64)
    odd = np.bincount(np.repeat(bounds[:-1], sizes) + inside, minlength=bounds[-1]) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little"), bounds // 8


def differing(left: pa.Array, right: pa.Array) -> np.ndarray:
    """In how many bits the sketches of each pair differ."""
    sides = []
    for side in (left, right):
        _, offsets, content = side.cast(pa.large_binary()).buffers()
        at = np.frombuffer(offsets, dtype=np.int64)[side.offset : side.offset + len(side) + 1]
        sides.append((at[:-1], np.diff(at), np.frombuffer(content, dtype=np.uint8)))
    (a, n, left_bytes), (b, m, right_bytes) = sides
    out = np.zeros(len(left), dtype=np.int64)
    for k, j in set(zip(n.tolist(), m.tolist(), strict=True)):
        some = np.flatnonzero((n == k) & (m == j))
        x = left_bytes[a[some][:, None] + np.arange(k)]
        y = right_bytes[b[some][:, None] + np.arange(j)]
        width = min(k, j)
        x = np.bitwise_xor.reduce(x.reshape(some.size, -1, width), axis=1)
        y = np.bitwise_xor.reduce(y.reshape(some.size, -1, width), axis=1)
        out[some] = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
    return out


def _rows(size: int, schema: str, **columns) -> pa.RecordBatch:
    """A batch with the named columns; the others are null."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    fields = [part.strip().split(" ") for part in schema.split(",")]
    arrays = [pa.array(columns[n], kinds[k]) if n in columns else pa.nulls(size, kinds[k]) for n, k in fields]
    return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in fields])


def _packets(
    value: np.ndarray, row: np.ndarray, ids: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray, owners: int
) -> Iterator[pa.RecordBatch]:
    """Pairs found by a sender, and its sorted values with a row for each (a place in a list of rows), cut among the owners."""
    if a.size:
        yield _rows(a.size, _SENT, owner=(a % owners).astype(np.int32), a=a, b=b)
    owner = ((value >> np.uint64(32)) * np.uint64(owners)) >> np.uint64(32)
    bounds = np.searchsorted(owner, np.arange(owners + 1))
    some = np.flatnonzero(np.diff(bounds))
    spans = [(bounds[o], bounds[o + 1]) for o in some]
    named = [np.unique(row[i:j], return_inverse=True) for i, j in spans]
    yield _rows(
        some.size,
        _SENT,
        owner=some.astype(np.int32),
        blocks=[value[i:j].tobytes() for i, j in spans],
        rows=[ids[of].tobytes() for of, _ in named],
        sizes=[sizes[of].astype(np.uint32).tobytes() for of, _ in named],
        places=[at.astype(np.uint16 if of.size <= 1 << 16 else np.uint32).tobytes() for of, at in named],
    )


def _send(owners: int, size: int, percent: int, limit: int, tables: Tables):
    def spread(ids: np.ndarray) -> np.ndarray:
        return ((ids.astype(np.uint64) >> np.uint64(3)) % np.uint64(owners)).astype(np.int32)

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # ids, sizes, values in row order

        def flush() -> Iterator[pa.RecordBatch]:
            ids, sizes, values = (np.concatenate(part) for part in zip(*held, strict=True))
            held.clear()
            rows = np.repeat(np.arange(ids.size), sizes)
            row, value = block_values(rows, values, sizes, percent, tables)
            order, place, many, a, b = _places(value, ids[row])
            asked = np.zeros(ids.size, dtype=bool)
            asked[row[order[~many]]] = True
            if asked.any():
                content, bounds = sketches(values[asked[rows]], sizes[asked])
                n = sizes[asked]
                yield _rows(n.size, _SENT, owner=spread(ids[asked]), row_id=ids[asked], n=n, sketch=packed(content, bounds))
            # one more than PAIRED tells the owner that there are more
            order = order[place <= PAIRED]
            yield from _packets(value[order], row[order], ids, sizes, a, b, owners)

        count = 0
        for batch in batches:
            keys = batch.column(0)
            known = ~np.asarray(keys.is_null())
            ids = np.asarray(keys.fill_null(0))
            for first, offsets, content in text_slices(batch.column(1)):
                rows, values = distinct_sorted(*shingles(offsets, content, size))
                part = slice(first, first + offsets.size - 1)
                sizes = np.bincount(rows, minlength=offsets.size - 1)
                yield _rows(sizes.size, _SENT, owner=spread(ids[part]), row_id=keys.slice(first, sizes.size), n=sizes)
                held.append((ids[part][known[part]], sizes[known[part]], values[known[part][rows]]))
                count += values.size
                if count >= limit:
                    yield from flush()
                    count = 0
        if held:
            yield from flush()

    return send


def _meet(percent: int):
    def meet(table: pa.Table) -> pa.Table:
        """One owner: pass documents and pairs on, and pair what shares a column."""
        plain = table.filter(table.column("blocks").is_null())
        plain = plain.select(["row_id", "n", "a", "b", "sketch"]).append_column("asked", pa.nulls(len(plain), pa.bool_()))
        kept = plain.select(_rows(0, _MET).schema.names).cast(_rows(0, _MET).schema)
        packets = table.filter(table.column("blocks").is_valid())
        values = [np.frombuffer(p, dtype=np.uint64) for p in packets.column("blocks").to_pylist()]
        if not values:
            return kept
        ids, sizes = [], []
        for rows, lengths, places in zip(*(packets.column(c).to_pylist() for c in ("rows", "sizes", "places")), strict=True):
            rows = np.frombuffer(rows, dtype=np.int64)
            at = np.frombuffer(places, dtype=np.uint16 if rows.size <= 1 << 16 else np.uint32)
            ids.append(rows[at])
            sizes.append(np.frombuffer(lengths, dtype=np.uint32)[at])
        values, ids, sizes = np.concatenate(values), np.concatenate(ids), np.concatenate(sizes).astype(np.int64)
        order, _, many, a, b = _places(values, ids)
        order = order[~many]
        values, ids, sizes = values[order], ids[order], sizes[order]
        pairs = []
        for step in range(1, PAIRED):
            first = np.flatnonzero(values[step:] == values[:-step])
            n, m = sizes[first], sizes[first + step]
            first = first[100 * np.minimum(n, m) >= percent * np.maximum(n, m)]
            pairs.append((ids[first], ids[first + step]))
        x, y = distinct_sorted(*(np.concatenate(side) for side in zip(*pairs, strict=True)))
        asked = np.repeat([False, True], [a.size, x.size])
        found = _rows(asked.size, _MET, a=np.concatenate([a, x]), b=np.concatenate([b, y]), asked=asked)
        return pa.concat_tables([kept, pa.Table.from_batches([found])])

    return meet


def _within(percent: int):
    """Pairs whose sketches don't differ in more bits than linked rows can in columns."""

    def within(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = np.asarray(batch.column("n")), np.asarray(batch.column("m"))
            left = differing(batch.column("sketch"), batch.column("other")) <= n + m - 2 * need(n, m, percent)
            yield batch.select(["a", "b"]).filter(pa.array(left))

    return within


def _neighbours(met: DataFrame, percent: int) -> DataFrame:
    """What connects row blocks: the stars, and the pairs asked for that their sketches don't rule out."""
    known = met.filter("sketch is not null").groupBy("row_id").agg(F.max(F.struct("n", "sketch")).alias("of"))
    first = known.select(F.col("row_id").alias("a"), "of.n", "of.sketch")
    second = known.select(F.col("row_id").alias("b"), F.col("of.n").alias("m"), F.col("of.sketch").alias("other"))
    asked = met.filter("asked").select("a", "b").distinct().join(first, "a").join(second, "b")
    pairs = stage(asked.select("a", "b", "n", "sketch", "m", "other").mapInArrow(_within(percent), _LINKS), "pairs")
    return met.filter("a is not null and asked is not true").select("a", "b").unionByName(pairs)


def link_rows(sizes: np.ndarray, rows: np.ndarray, values: np.ndarray, percent: int, probes: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links among the rows of one block (``probes``: only links that have one of these at an end)."""
    total = sizes.size
    start = np.concatenate([[0], np.cumsum(sizes)])
    _, column, count = np.unique(values, return_inverse=True, return_counts=True)
    by_rarity = np.lexsort((column, count[column], rows))  # a row's rarest columns first
    column = column[by_rarity]
    posting = np.argsort(column, kind="stable")
    posting_rows, posting_start = rows[posting], np.concatenate([[0], np.cumsum(count)])
    parent, weight = list(range(total)), [1] * total

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links: list[tuple[int, int]] = []
    largest = 0
    marks = np.zeros(count.size, dtype=bool)

    def multiply_row(row: int) -> None:
        nonlocal largest
        own = column[start[row] : start[row + 1]]
        n = int(sizes[row])
        if not n:
            return
        # beyond these columns too few are left to reach the bound
        reach = own[: n - int(need(n, -(-percent * n // 100), percent)) + 1]
        near = np.unique(np.concatenate([posting_rows[posting_start[c] : posting_start[c + 1]] for c in reach]))
        near = near[(near != row) & (100 * np.minimum(sizes[near], n) >= percent * np.maximum(sizes[near], n))]
        if not near.size:
            return
        marks[own] = True
        lengths = sizes[near]
        ends = np.cumsum(lengths)
        at = np.repeat(start[near] - (ends - lengths), lengths) + np.arange(ends[-1])
        shared = np.add.reduceat(marks[column[at]].astype(np.int64), ends - lengths)
        marks[own] = False
        for other in near[shared >= need(n, lengths, percent)].tolist():
            x, y = find(row), find(other)
            if x != y:
                links.append((row, other))
                if weight[x] < weight[y]:
                    x, y = y, x
                parent[y] = x
                weight[x] += weight[y]
                if weight[x] > weight[find(largest)]:
                    largest = x

    if probes is not None:
        for row in probes.tolist():
            multiply_row(row)
        return links
    # A pair is settled once one of its rows is multiplied, or if both are in one group already: so those of the largest
    # group can wait, and are done after all if another group becomes the largest.
    waiting = list(range(total))
    while waiting:
        passed = []
        for row in waiting:
            if find(row) == find(largest):
                passed.append(row)
            else:
                multiply_row(row)
        final = find(largest)
        waiting = [row for row in passed if find(row) != final]
    return links


def _multiply(percent: int):
    def multiply(table: pa.Table) -> pa.Table:
        table = table.sort_by([("root", "ascending"), ("tile", "ascending"), ("row_id", "ascending")])
        root, tile = np.asarray(table.column("root")), np.asarray(table.column("tile"))
        ids, probe = np.asarray(table.column("row_id")), np.asarray(table.column("probe"))
        columns = [np.frombuffer(c, dtype=np.uint64) for c in table.column("columns").to_pylist()]
        cuts = np.flatnonzero((root[1:] != root[:-1]) | (tile[1:] != tile[:-1])) + 1
        a, b = [], []
        for first, last in zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [ids.size]]), strict=True):
            # the same row can come as a probe and as a row of the tile
            rows_of: dict[int, int] = {}
            for i in range(first, last):
                rows_of.setdefault(int(ids[i]), i)
            chosen = list(rows_of.values())
            sets = [columns[i] for i in chosen]
            sizes = np.array([s.size for s in sets])
            probes = None
            if probe[first:last].any():
                asked = set(ids[first:last][probe[first:last]].tolist())
                probes = np.array([k for k, i in enumerate(chosen) if int(ids[i]) in asked])
            for x, y in link_rows(sizes, np.repeat(np.arange(sizes.size), sizes), np.concatenate(sets), percent, probes):
                a.append(int(ids[chosen[x]]))
                b.append(int(ids[chosen[y]]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return multiply


def _sets(size: int):
    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, offsets, content in text_slices(batch.column(5)):
                rows, values = distinct_sorted(*shingles(offsets, content, size))
                count = offsets.size - 1
                bounds = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=count))])
                part = batch.slice(first, count)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:5], packed(values, bounds)], names=["root", "tile", "tiles", "probe", "row_id", "columns"]
                )

    return sets


def near_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = 5,
    percent: int = 80,
    owners: int | None = None,
    send_shingles: int = SEND_SHINGLES,
    tile_shingles: int = TILE_SHINGLES,
    filter_bits: int = FILTER_BITS,
    table_bits: int = TABLE_BITS,
) -> DataFrame:
    """One row per document: ``row_id``, ``n_shingles`` (distinct word n-grams) and ``component_id``.

    Documents are linked if their n-gram sets have a Jaccard similarity of ``percent`` / 100 or more; ``component_id`` is the
    smallest key reachable by links. A text with fewer words than ``words`` is one n-gram; null texts and texts without words
    are empty sets and linked with nothing. Rows with the same key are one document (their texts should agree). A row
    without a key can't be named by a link: it is returned with its size and a null component. An empty table gives no rows.
    """
    rows = docs.select(F.col(key).cast("long").alias("row_id"), F.col(text).cast("string").alias("body"))
    owners = owners or shuffle_width(docs)
    tables = common_columns(rows.select("body"), words, owners, send_shingles, table_bits, TABLE_LOAD)
    send = _send(owners, words, percent, send_shingles, tables)
    met = stage(rows.mapInArrow(send, _SENT).groupBy("owner").applyInArrow(_meet(percent), _MET), "met")
    sizes = met.filter("a is null and sketch is null").select("row_id", "n")
    stars = components(_neighbours(met, percent))
    inside = stars.select(F.col("node").alias("row_id"), "root").unionByName(
        stars.select(F.col("root").alias("row_id"), "root").distinct()
    )
    known = sizes.groupBy("row_id").agg(F.max("n").alias("n"))
    placed = _place(inside.join(known, "row_id"), tile_shingles)

    wanted = mark_probable(rows, F.col("row_id"), placed.select("row_id"), filter_bits, "probable").filter("probable")
    bodies = wanted.select("row_id", "body").dropDuplicates(["row_id"]).join(placed, "row_id")
    bodies = bodies.select("root", "tile", "tiles", F.lit(False).alias("probe"), "row_id", "body")
    sets = stage(bodies.mapInArrow(_sets(words), _SETS), "sets")
    if not placed.filter("tiles > 1").isEmpty():
        parts = _by_size(placed.filter("tiles > 1").select("row_id", "root", "n"), percent)
        placed = placed.filter("tiles <= 1").unionByName(_place(parts, tile_shingles))
    sets = sets.select("probe", "row_id", "columns").join(placed.drop("n"), "row_id")
    sets = sets.select("root", "tile", "tiles", "probe", "row_id", "columns", "pivot")
    # a pivot goes to every tile; one frame, as Spark 4.1 can fail on unions of equally partitioned frames
    spread = F.explode(F.expr("if(tiles > 1 and pivot, sequence(0, tiles - 1), array(tile))"))
    own = sets.withColumn("tile", spread).drop("pivot")
    total = placed.agg(F.sum("n")).first()[0] or 0
    groups = max(8 * int(total // tile_shingles) + 1, shuffle_width(docs))  # so that large blocks seldom meet in one
    block = F.when(F.col("tiles") <= 1, F.pmod(F.xxhash64("root"), F.lit(groups))).otherwise(F.xxhash64("root", "tile"))

    def multiplied(frame: DataFrame) -> DataFrame:
        named = frame.withColumn("block", block).select("block", "root", "tile", "tiles", "probe", "row_id", "columns")
        return named.groupBy("block").applyInArrow(_multiply(percent), _LINKS)

    links = stage(multiplied(own), "links")
    if not placed.filter("tiles > 1").isEmpty():
        links = links.unionByName(stage(multiplied(_across(sets, placed, links, tile_shingles)), "links"))
    linked = components(links)
    named = linked.select(F.col("node").alias("row_id"), F.col("root").alias("component"))
    return sizes.join(named, "row_id", "left").select(
        "row_id", F.col("n").alias("n_shingles"), F.coalesce("component", "row_id").alias("component_id")
    )


def _place(inside: DataFrame, tile_shingles: int) -> DataFrame:
    """Rows of row blocks (``row_id``, ``root``, ``n``) with their block's number of tiles, their tile, and who is a pivot."""
    inside = stage(inside.select("row_id", "root", "n"), "row-blocks")
    blocks = inside.groupBy("root").agg(F.sum("n").alias("volume"), F.min("row_id").alias("low"), F.max("row_id").alias("high"))
    blocks = blocks.withColumn("tiles", F.ceil(F.col("volume") / F.lit(tile_shingles)).cast("int"))
    tile = F.expr("cast(pmod(xxhash64(row_id), greatest(tiles, 1)) as int)").alias("tile")
    placed = inside.join(blocks.select("root", "tiles", "low", "high"), "root")
    return stage(placed.select("row_id", "root", "n", "tiles", tile, F.expr("row_id in (low, high)").alias("pivot")), "tiles")


def _by_size(inside: DataFrame, percent: int) -> DataFrame:
    """Parts of row blocks: each row with those of its own size band and of the band below."""
    low = [int(n) for n in bands(percent)]
    band = F.size(F.filter(F.lit(low), lambda n: n <= F.col("n")))
    parts = inside.withColumn("band", F.explode(F.array(band, band - 1)))
    return parts.select("row_id", F.xxhash64("root", "band").alias("root"), "n")


def _across(sets: DataFrame, placed: DataFrame, links: DataFrame, tile_shingles: int) -> DataFrame:
    """Rows of tiled blocks outside their block's largest group, each with every tile of the block."""
    tiled = placed.filter("tiles > 1")
    grouped = tiled.join(components(links).select(F.col("node").alias("row_id"), F.col("root").alias("part")), "row_id", "left")
    grouped = stage(grouped.withColumn("part", F.coalesce("part", "row_id")), "parts")
    counts = grouped.groupBy("root", "part").agg(F.count(F.lit(1)).alias("rows"))
    largest = counts.groupBy("root").agg(F.max_by("part", F.struct("rows", "part")).alias("largest"))
    rest = grouped.join(largest, "root").filter("part != largest").select("row_id", "root", "n")
    volume = rest.groupBy("root").agg(F.ceil(F.sum("n") / F.lit(tile_shingles)).cast("int").alias("chunks"))
    asked = rest.select("row_id", "root", F.lit(True).alias("asked"))
    all_rows = sets.filter("tiles > 1").join(volume, "root").join(asked, ["row_id", "root"], "left")
    all_rows = all_rows.withColumn("chunk", F.expr("cast(pmod(xxhash64(row_id, 7L), chunks) as int)"))
    own = "transform(sequence(0, chunks - 1), c -> struct(tile * chunks + c as tile, false as probe))"
    everywhere = "transform(sequence(0, tiles - 1), t -> struct(t * chunks + chunk as tile, true as probe))"
    at = F.explode(F.expr("if(asked, concat({0}, {1}), {0})".format(own, everywhere))).alias("at")
    return all_rows.select("root", "tiles", "row_id", "columns", at).select("root", "at.tile", "tiles", "at.probe", "row_id", "columns")


#: Identities of rows without a key of their own begin here, behind all keys.
FIRST_MADE = 1 << 62


def _identified(docs: DataFrame, key: str, text: str) -> DataFrame:
    """The rows (``row``) with their text and an identity: the key, if it is there and has one text only, else one that is
    made of key and text."""
    of_text = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    keyed = docs.select(F.col(key).cast("long").alias("repeated"), of_text.alias("hash")).filter("repeated is not null")
    texts = keyed.groupBy("repeated").agg(F.min("hash").alias("low"), F.max("hash").alias("high"))
    repeated = stage(texts.filter("low != high").select("repeated"), "repeated-keys")
    rows = whole_rows(docs, key=F.col(key).cast("long"), body=F.col(text), hash=of_text)
    made = F.lit(FIRST_MADE) + F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col("key"), F.lit(-1)), F.col("hash")), 2)
    own = F.when(F.col("key").isNull() | F.col("repeated").isNotNull(), made).otherwise(F.col("key"))
    return rows.join(repeated, F.col("key") == F.col("repeated"), "left").select("row", "body", own.alias("own"))


def drop_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents with one of each group of near copies, columns as they were; the smallest key of a group stays.

    Every row is judged by its own text. A row without a key, or with a key that repeats with another text, is told by key
    and text (64 hashed bits); it takes part in groups like any other, and stays only if no row of its group has a key of
    its own. Of rows with equal key and text in a group, one stays. Null texts and texts without words stay.
    """
    rows = _identified(docs, key, text)
    groups = near_groups(rows.select("own", "body"), "own", "body", **options).filter("row_id != component_id")
    groups = stage(groups.select("row_id", F.col("component_id").alias("keep_id")), "near-copies")
    kept = groups.select(F.col("keep_id").alias("row_id"), "keep_id").distinct()
    return keep_first(rows.select("row", "own"), groups.unionByName(kept), options.get("filter_bits", FILTER_BITS))
