from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from tierlake.llm.centroids import Grid, Lookup, cluster_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, row_id string, cluster string, values string"


def plain_clusters(rows, dims, clusters, rounds, scale=64):
    """Lloyd's rounds in Python integers."""
    kept = []
    for key, vector in rows:
        if vector is not None and len(vector) == dims and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((key, [math.floor(scale * float(np.float32(x))) for x in vector]))
    order = sorted(kept, key=lambda r: (hashlib.sha256("1:{}".format("" if r[0] is None else r[0]).encode()).hexdigest(), r[1]))
    centres = [r[1] for r in order[:clusters]]

    def near(vector):
        return min((sum((a - b) ** 2 for a, b in zip(vector, centre)), n) for n, centre in enumerate(centres))

    for _ in range(rounds):
        homes = [near(vector)[1] for _, vector in kept]
        for n in range(len(centres)):
            inside = [vector for home, (_, vector) in zip(homes, kept) if home == n]
            if inside:
                centres[n] = [sum(column) // len(inside) for column in zip(*inside)]
    last = [(key, *near(vector)) for key, vector in kept]
    inertia = {n: sum(d for _, d, home in last if home == n) for n in range(len(centres))}
    digests = [hashlib.sha256(",".join(map(str, centre)).encode()).hexdigest() for centre in centres]
    total = sum(inertia.values())
    return sorted(((k, n, d, inertia[n], total, digests[n]) for k, d, n in last), key=str)


def found(spark, rows, **options):
    frame = spark.createDataFrame([(k, v, 1, "x", "y", "z") for k, v in rows], SCHEMA).repartition(3)
    result = cluster_vectors(frame, **options)
    assert result.columns == ["row_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted(map(tuple, result.collect()), key=str)


def odd_vectors(dims):
    picks = np.random.default_rng(5)
    rows = [(n, picks.normal(0, 0.3, dims).astype(np.float32).tolist()) for n in range(300)]
    hot = picks.normal(0, 0.3, dims).astype(np.float32).tolist()
    rows += [(1_000 + n, hot) for n in range(150)] + [rows[3], rows[3], (None, rows[5][1]), (None, hot)]
    bad = [float("nan"), float("inf"), -float("inf"), None]
    rows += [(2_000 + n, [x, *hot[1:]]) for n, x in enumerate(bad)]
    return rows + [(3_000, None), (3_001, []), (3_002, hot[1:]), (3_003, [*hot, 0.0]), (3_004, [1000.0, *hot[1:]])]


@pytest.mark.parametrize("bits,clusters,rounds", [(6, 16, 3), (2, 5, 4), (8, 3, 1)])
def test_clusters_equal_plain_rounds(spark, bits, clusters, rounds):
    rows = odd_vectors(8)
    wanted = plain_clusters(rows, 8, clusters, rounds)
    assert found(spark, rows, dims=8, clusters=clusters, rounds=rounds, bits=bits) == wanted


def test_few_or_no_vectors(spark):
    rows = [(1, [0.5, 0.25]), (2, [0.5, 0.25]), (3, [-0.5, 0.0])]
    assert found(spark, rows, dims=2) == plain_clusters(rows, 2, 16, 3)
    assert found(spark, [(1, None)], dims=2) == []
    assert found(spark, [], dims=2) == []


def test_components_beyond_a_long_end_with_a_message(spark):
    with pytest.raises(Exception, match="beyond"):
        found(spark, [(1, [1e30, 0.0])], dims=2)


def test_cells_pack_and_intervals_hold():
    picks = np.random.default_rng(2)
    values = picks.integers(-40, 40, (500, 9))
    for bits in (1, 3, 6, 8):
        shares = np.arange(1, 1 << bits) / (1 << bits)
        rows = [{"least": c.min(), "greatest": c.max(), "cuts": np.quantile(c, shares).astype(int).tolist()} for c in values.T]
        grid = Grid.of(rows, bits)
        cells = grid.cells(values)
        assert (grid.unpack(grid.pack(cells)) == cells).all() and len(grid.pack(cells)[0]) == -(-9 * bits // 8)
        columns = np.arange(9)
        assert (grid.low[columns, cells] <= values).all() and (values <= grid.high[columns, cells]).all()
        lookup = Lookup(grid, values[:7])
        favourite, reach = lookup.decide(cells)
        exact = ((values[:, None] - values[:7]) ** 2).sum(axis=2)
        assert reach[np.arange(500), exact.argmin(axis=1)].all()
        assert (lookup.assign(values, cells) == exact.argmin(axis=1)).all()
