"""Centroid clustering (Lloyd's rounds) over a VA-file.

Components become integers, and every vector is also kept in a second, smaller table: the vector approximation, ``bits``
bits per dimension, which name the cell of the dimension the component lies in. Cells hold about equal numbers of vectors
(approximate quantiles over all rows; they steer the cost, never the result).

The nearest centroid is sought in the approximation alone. The centroid nearest to the middle of a vector's cells is its
favourite. For every other centroid, lookup tables (favourite, dimension, cell) give the interval of how much farther than
the favourite it is; terms that all centroids share cancel there, which keeps intervals narrow. If no interval reaches
zero, the vector is decided. Only vectors with overlapping intervals, and those that change their cluster, are fetched from
the table of full vectors, by an equi-join on the row number.

Sums are exact and kept from round to round: a vector that moves is subtracted from one cluster and added to another. The
first round fetches all vectors for the first sums, the last for their distances. Tasks hand on one row of sums per
cluster; the driver holds centroids, sums and cells only: (clusters + 2**bits) x dimensions numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tierlake.sources.staging import stage

#: Components beyond this would let squared distances leave 64 bits; they end the run with a message.
LARGEST = 1 << 27
QUANTILE_ACCURACY = 1_000
OPEN = -1
_PASS = "row long, cells binary, cluster int, n long, sums array<long>"


@dataclass
class Grid:
    """Lowest and highest integer of every (dimension, cell)."""

    low: np.ndarray
    high: np.ndarray
    starts: list[np.ndarray]
    bits: int

    @classmethod
    def of(cls, rows: list[Row], bits: int) -> Grid:
        """From least, greatest and quantiles of every dimension."""
        cells = 1 << bits
        low, high = np.empty((len(rows), cells), np.int64), np.empty((len(rows), cells), np.int64)
        starts = []
        for number, row in enumerate(rows):
            start = np.unique(np.clip(np.array([row["least"], *row["cuts"]], np.int64), row["least"], row["greatest"]))
            low[number], high[number] = row["greatest"], row["greatest"]
            low[number, : start.size] = start
            high[number, : start.size - 1] = start[1:] - 1
            starts.append(start[1:])
        return cls(low, high, starts, bits)

    def cells(self, values: np.ndarray) -> np.ndarray:
        found = [np.searchsorted(start, values[:, n], side="right") for n, start in enumerate(self.starts)]
        return np.stack(found, axis=1).astype(np.uint8) if len(values) else np.empty(values.shape, np.uint8)

    def pack(self, cells: np.ndarray) -> list[bytes]:
        planes = np.unpackbits(cells[:, :, None], axis=2)[:, :, 8 - self.bits :]
        return [line.tobytes() for line in np.packbits(planes.reshape(len(cells), -1), axis=1)]

    def unpack(self, packed: list[bytes]) -> np.ndarray:
        dims = len(self.starts)
        lines = np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), -1)
        planes = np.unpackbits(lines, axis=1)[:, : dims * self.bits].reshape(len(packed), dims, self.bits)
        filled = np.zeros((len(packed), dims, 8), np.uint8)
        filled[:, :, 8 - self.bits :] = planes
        return np.packbits(filled, axis=2)[:, :, 0]


@dataclass
class Lookup:
    """Distance tables of one set of centroids."""

    grid: Grid
    centres: np.ndarray

    @cached_property
    def _middle(self) -> np.ndarray:
        """(dimension, cell, centroid): four times the squared distance from the cell's middle."""
        return ((self.grid.low + self.grid.high)[:, :, None] - 2 * self.centres.T[:, None, :]).astype(np.float64) ** 2

    @cached_property
    def _kept(self) -> dict[int, np.ndarray]:
        return {}

    def _farther(self, favourite: int) -> np.ndarray:
        """(dimension, cell, centroid): the least of the distance beyond the favourite's."""
        if favourite not in self._kept:
            own = self.centres[favourite]
            step, total = (self.centres - own).T[:, None, :], (self.centres + own).T[:, None, :]
            ends = [step * (total - 2 * end[:, :, None]) for end in (self.grid.low, self.grid.high)]
            self._kept[favourite] = np.minimum(*ends)
        return self._kept[favourite]

    def decide(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The favourite of every vector, and which centroids' intervals reach it (the favourite's own does)."""
        score = np.zeros((len(cells), len(self.centres)))
        for number in range(cells.shape[1]):
            score += self._middle[number][cells[:, number]]
        favourite = score.argmin(axis=1)
        reach = np.zeros(score.shape, bool)
        for one in np.unique(favourite):
            table, rows = self._farther(int(one)), np.flatnonzero(favourite == one)
            least = np.zeros((rows.size, len(self.centres)), np.int64)
            for number in range(cells.shape[1]):
                least += table[number][cells[rows, number]]
            reach[rows] = least <= 0
        return favourite, reach

    def nearest(self, values: np.ndarray, reach: np.ndarray) -> np.ndarray:
        """The nearest of the centroids in reach by exact distance; of equal ones the smallest number."""
        distance = (values**2).sum(axis=1)[:, None] - 2 * (values @ self.centres.T) + (self.centres**2).sum(axis=1)
        return np.where(reach, distance, np.iinfo(np.int64).max).argmin(axis=1)

    def assign(self, values: np.ndarray, cells: np.ndarray) -> np.ndarray:
        favourite, reach = self.decide(cells)
        overlap = np.flatnonzero(reach.sum(axis=1) > 1)
        favourite[overlap] = self.nearest(values[overlap], reach[overlap])
        return favourite


class Sums:
    """Sums of the vectors that enter clusters, less those that leave."""

    def __init__(self, clusters: int, dims: int) -> None:
        self.n, self.sums = np.zeros(clusters, np.int64), np.zeros((clusters, dims), np.int64)

    def add(self, clusters: np.ndarray, values: np.ndarray, sign: int = 1) -> None:
        for one in np.unique(clusters):
            inside = clusters == one
            self.n[one] += sign * int(inside.sum())
            self.sums[one] += sign * values[inside].sum(axis=0)

    def rows(self) -> pa.RecordBatch:
        size = len(self.n)
        none = [None] * size
        return _rows(none, none, np.arange(size, dtype=np.int32), self.n, self.sums.tolist())


def _rows(row, cells, cluster, n, sums) -> pa.RecordBatch:
    types = (pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
    arrays = [pa.array(column, kind) for column, kind in zip((row, cells, cluster, n, sums), types)]
    return pa.RecordBatch.from_arrays(arrays, ["row", "cells", "cluster", "n", "sums"])


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _first_pass(lookup: Lookup):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clusters, dims = lookup.centres.shape
        sums = Sums(clusters, dims)
        for batch in batches:
            values = _matrix(batch.column("values"), dims)
            cells = lookup.grid.cells(values)
            cluster = lookup.assign(values, cells)
            sums.add(cluster, values)
            none = [None] * len(values)
            yield _rows(batch.column("row"), lookup.grid.pack(cells), cluster, none, none)
        yield sums.rows()

    return run


def _bound_pass(lookup: Lookup):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                favourite, reach = lookup.decide(lookup.grid.unpack(batch.column("cells").to_pylist()))
                now = np.where(reach.sum(axis=1) > 1, OPEN, favourite).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(now)], [*batch.schema.names, "now"])

    return run


def _fetch_pass(lookup: Lookup):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clusters, dims = lookup.centres.shape
        sums = Sums(clusters, dims)
        for batch in batches:
            if not batch.num_rows:
                continue
            values, packed = _matrix(batch.column("values"), dims), batch.column("cells").to_pylist()
            was, now = (batch.column(name).to_numpy().astype(np.int64) for name in ("cluster", "now"))
            open_rows = np.flatnonzero(now == OPEN)
            reach = lookup.decide(lookup.grid.unpack([packed[n] for n in open_rows]))[1] if open_rows.size else None
            if open_rows.size:
                now[open_rows] = lookup.nearest(values[open_rows], reach)
            moved = now != was
            sums.add(was[moved], values[moved], -1)
            sums.add(now[moved], values[moved])
            none = [None] * len(values)
            yield _rows(batch.column("row"), packed, now, none, none)
        yield sums.rows()

    return run


def _last_pass(lookup: Lookup):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _matrix(batch.column("values"), lookup.centres.shape[1])
            cluster = lookup.assign(values, lookup.grid.cells(values))
            distance = ((values - lookup.centres[cluster]) ** 2).sum(axis=1)
            arrays = [batch.column("row_id"), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["row_id", "cluster", "distance"])

    return run


def _totals(passed: DataFrame, dims: int) -> tuple[dict[int, int], dict[int, np.ndarray]]:
    """Numbers and sums per cluster: one row per cluster reaches the driver."""
    parts = passed.filter(F.col("sums").isNotNull()).groupBy("cluster")
    rows = parts.agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(dims)]).alias("sums")).collect()
    return {r["cluster"]: r["n"] for r in rows}, {r["cluster"]: np.array(r["sums"], np.int64) for r in rows}


def integer_vectors(vectors: DataFrame, key: str, value: str, dims: int, scale: int) -> DataFrame:
    """(row_id, values): floor(scale * component) of the vectors with ``dims`` components, none null or non-finite."""
    whole = vectors.select(F.col(key).alias("row_id"), F.col(value).cast("array<double>").alias("values")).filter(
        (F.size("values") == dims)
        & F.forall("values", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    )

    def component(x):
        scaled = F.floor(F.lit(float(scale)) * x)
        beyond = F.raise_error(F.lit("A component is beyond {}".format(LARGEST)))
        return F.when(F.abs(scaled) <= LARGEST, scaled.cast("int")).otherwise(beyond.cast("int"))

    return whole.select("row_id", F.transform("values", component).alias("values"))


def _grid(full: DataFrame, bits: int) -> Grid:
    """Cells of every dimension from all rows: a row per dimension reaches the driver."""
    shares = [n / (1 << bits) for n in range(1, 1 << bits)]
    parts = full.select(F.posexplode("values").alias("dim", "x")).groupBy("dim")
    cuts = F.percentile_approx("x", shares, QUANTILE_ACCURACY)
    rows = parts.agg(F.min("x").alias("least"), F.max("x").alias("greatest"), cuts.alias("cuts")).orderBy("dim").collect()
    return Grid.of(rows, bits)


def _first_centroids(full: DataFrame, count: int, salt: str) -> np.ndarray:
    """Vectors with the smallest sha256 of salt and key, in that order; equal ones by components."""
    draw = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("row_id").cast("string"), F.lit(""))), 256)
    rows = full.select(draw.alias("draw"), "values").orderBy("draw", "values").limit(count).collect()
    return np.array([r["values"] for r in rows], np.int64)


def cluster_vectors(
    vectors: DataFrame,
    key: str = "vec_id",
    value: str = "embedding",
    dims: int = 64,
    scale: int = 64,
    clusters: int = 16,
    rounds: int = 3,
    bits: int = 6,
    salt: str = "1:",
) -> DataFrame:
    """One row per kept vector: row_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256.

    A vector is kept if it has exactly ``dims`` components, none null or non-finite; others (null vectors too) aren't in
    the result. A null key counts as an empty one in the draw of first centroids; repeated keys and vectors are rows of
    their own. With fewer vectors than ``clusters`` there are as many clusters as vectors; a cluster that loses all its
    vectors keeps its centroid. Ties go to the smaller number. No kept vector gives no row. Other columns are ignored.
    Components beyond ``LARGEST`` raise an error, as squared distances wouldn't fit a long.
    """
    if not 1 <= bits <= 8 or not 1 <= dims <= 64 or not 1 <= clusters <= 32 or rounds < 1:
        raise ValueError("Bits 1 to 8, dimensions 1 to 64, clusters 1 to 32 and at least one round")
    numbered = integer_vectors(vectors, key, value, dims, scale).withColumn("row", F.monotonically_increasing_id())
    full = stage(numbered, "vectors")
    centres = _first_centroids(full, clusters, salt)
    if not len(centres):
        nothing = "cluster int", "distance long", "cluster_inertia long", "inertia long", "centroid_sha256 string"
        return full.select("row_id", *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in nothing])
    grid = _grid(full, bits)

    passed = stage(full.select("row", "values").mapInArrow(_first_pass(Lookup(grid, centres)), _PASS), "assigned")
    approximation = passed.filter(F.col("row").isNotNull()).select("row", "cells", "cluster")
    n, sums = _totals(passed, dims)
    centres = _moved(centres, n, sums)
    for _ in range(rounds - 1):
        lookup = Lookup(grid, centres)
        bound = stage(approximation.mapInArrow(_bound_pass(lookup), "row long, cells binary, cluster int, now int"), "bounds")
        wanted = bound.filter(F.col("now") != F.col("cluster")).join(full.select("row", "values"), "row")
        fetched = stage(wanted.mapInArrow(_fetch_pass(lookup), _PASS), "fetched")
        more, gained = _totals(fetched, dims)
        for one in more:
            n[one] = n.get(one, 0) + more[one]
            sums[one] = sums.get(one, 0) + gained[one]
        same = bound.filter(F.col("now") == F.col("cluster")).select("row", "cells", "cluster")
        approximation = same.unionByName(fetched.filter(F.col("row").isNotNull()).select("row", "cells", "cluster"))
        centres = _moved(centres, n, sums)

    fields = [full.schema["row_id"].simpleString().replace(":", " ", 1), "cluster int", "distance long"]
    placed = stage(full.select("row_id", "values").mapInArrow(_last_pass(Lookup(grid, centres)), ", ".join(fields)), "placed")
    inertia = placed.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()
    digests = [hashlib.sha256(",".join(map(str, centre)).encode()).hexdigest() for centre in centres.tolist()]
    total = sum(r["cluster_inertia"] for r in inertia)
    told = [(r["cluster"], r["cluster_inertia"], total, digests[r["cluster"]]) for r in inertia]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    clusters_told = F.broadcast(full.sparkSession.createDataFrame(told, schema))  # a row per cluster
    return placed.join(clusters_told, "cluster").select("row_id", *placed.columns[1:], *clusters_told.columns[1:])


def _moved(centres: np.ndarray, n: dict[int, int], sums: dict[int, np.ndarray]) -> np.ndarray:
    """Every centroid at the floor of its vectors' mean; empty ones stay."""
    return np.stack([sums[i] // n[i] if n.get(i) else centre for i, centre in enumerate(centres)])
