"""Histories that are appended to, against de-duplicating everything at once."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tierlake.operators.dedup import Dedup, deduplicate
from tierlake.plans import history
from tierlake.plans.history import BUCKET, append_history, probable_buckets, read_history, rows_path

SCHEMA = "id int, kind string, at int"
DEDUP = Dedup(("id",), "history", ("at",), hash_columns=("kind",))


def rows(spark, start, end, kinds=3):
    found = [(None if i % 17 == 0 else i % 50, None if i % 13 == 0 else "k{}".format(i % kinds), i) for i in range(start, end)]
    return spark.createDataFrame(found, SCHEMA).repartition(3)


def pairs(frame):
    return sorted(((r["id"], r["kind"]) for r in frame.collect()), key=str)


@pytest.mark.parametrize("bits", [64, 1 << 30])
def test_batches_give_what_all_rows_give(spark, root, bits):
    path, parts = root + "func", [rows(spark, 0, 90), rows(spark, 60, 200, 4), rows(spark, 0, 90), rows(spark, 0, 0)]
    counts = [append_history(part, DEDUP, path, buckets=8, bits=bits) for part in parts]
    whole = deduplicate(parts[0].unionByName(parts[1]), DEDUP)
    assert counts[0] > 0 and counts[1] > 0 and counts[2:] == [0, 0] and sum(counts) == whole.count()
    held = read_history(spark, path)
    assert held.columns == whole.columns and pairs(held) == pairs(whole)


def test_only_buckets_with_a_possible_hit_are_read(spark, root, capsys):
    path = root + "func"
    append_history(rows(spark, 0, 40), DEDUP, path, buckets=16)
    new = spark.createDataFrame([(1000 + i, "k", i) for i in range(40)], SCHEMA)
    old = rows(spark, 5, 6)
    placed = lambda frame: history._placed(deduplicate(frame, DEDUP), ["id", "hash_data"], 16, history.BITS)
    assert probable_buckets(placed(new), path) == []
    hit = probable_buckets(placed(new.unionByName(old)), path)
    assert hit == [placed(old).first()[BUCKET]]
    known = history._committed(spark, rows_path(path), hit, history._notes(spark, path))
    every = spark.read.parquet(rows_path(path)).inputFiles()
    assert 0 < len(known.inputFiles()) - len(history._notes(spark, path).inputFiles()) < len(every) / 4
    known.explain("formatted")
    assert "{}={}".format(BUCKET, hit[0]) in capsys.readouterr().out
    assert append_history(new.unionByName(old), DEDUP, path) == 40


def test_a_run_that_dies_appends_nothing(spark, root, monkeypatch):
    path = root + "func"
    append_history(rows(spark, 0, 40), DEDUP, path, buckets=4)
    before = pairs(read_history(spark, path))

    def dies(at):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(history, "_bits_path", dies)
        with pytest.raises(RuntimeError, match="lost"):
            history._append(history._placed(deduplicate(rows(spark, 500, 520, 9), DEDUP), ["id", "hash_data"], 4, 64), path, 4, 64)
    assert pairs(read_history(spark, path)) == before
    added = append_history(rows(spark, 500, 520, 9), DEDUP, path)
    assert len(read_history(spark, path).collect()) == len(before) + added and added > 0


def test_plain_rows_are_adopted(spark, root):
    path = root + "func"
    deduplicate(rows(spark, 0, 30), DEDUP).write.parquet(path)
    assert append_history(rows(spark, 0, 40), DEDUP, path) == deduplicate(rows(spark, 0, 40), DEDUP).count() - deduplicate(rows(spark, 0, 30), DEDUP).count()
    assert pairs(read_history(spark, path)) == pairs(deduplicate(rows(spark, 0, 40), DEDUP))


def test_mistakes_are_refused(spark, root):
    with pytest.raises(ValueError, match="Only histories"):
        append_history(rows(spark, 0, 3), Dedup(("id",)), root + "x")
    with pytest.raises(ValueError, match="multiple of 64"):
        append_history(rows(spark, 0, 3), DEDUP, root + "x", bits=65)
    assert read_history(spark, root + "x") is None
