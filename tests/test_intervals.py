"""The interval join against all pairs."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest

from tierlake.operators.facts import lookup_between, lookup_valid
from tierlake.operators.intervals import valid_versions

START = datetime(2024, 1, 1)
TICK = timedelta(microseconds=1)


def plain(facts, versions):
    """(id, surrogate) of every fact and version valid then, NULL where there is none."""
    rows = []
    for number, key, moment in facts:
        met = [
            name
            for other, start, end, name in versions
            if None not in (key, moment, start) and key == other and start <= moment and (end is None or moment <= end)
        ]
        rows += [(number, name) for name in met or [None]]
    return sorted(rows, key=str)


def frames(spark, facts, versions, kind):
    left = spark.createDataFrame(facts, "id long, k string, moment {}".format(kind))
    right = spark.createDataFrame(versions, "k string, valid_from {0}, valid_to {0}, sk string".format(kind))
    return left.repartition(3), right.repartition(2)


def rows_of(frame, output="sk_out"):
    return sorted(((r["id"], r[output]) for r in frame.collect()), key=str)


def edge_cases():
    """An open version, one of a microsecond, edges of buckets, NULLs, and versions that end before they start."""
    hour = timedelta(hours=1)
    bucket = timedelta(microseconds=8**11)
    versions = [
        ("a", START, None, "open"),
        ("a", START + hour, START + hour, "instant"),
        ("a", START + bucket, START + 2 * bucket - TICK, "bucket"),
        ("a", START - 400 * bucket, START + 900 * bucket, "long"),
        ("a", START + hour, START + hour - TICK, "backwards"),
        ("a", None, None, "nowhen"),
        ("a", None, START, "no start"),
        ("b", START, START + hour, "twice"),
        ("b", START, START + hour, "twice"),
        (None, START, None, "no key"),
        ("late", START + timedelta(days=900), None, "later than all facts"),
        ("early", START - timedelta(days=900), START - timedelta(days=800), "before all facts"),
    ]
    moments = [START, START - TICK, START + hour, START + hour - TICK, START + hour + TICK, START + bucket, START + bucket - TICK]
    moments += [START + 2 * bucket, START + 2 * bucket - TICK, START + 900 * bucket, START + 900 * bucket + TICK, None]
    facts = [(n, key, moment) for n, (key, moment) in enumerate((k, m) for k in ("a", "b", "late", "early", "c", None) for m in moments)]
    return facts + [(1_000, "a", START), (1_000, "a", START)], versions


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_edges_equal_all_pairs(spark, kind):
    facts, versions = edge_cases()
    left, right = frames(spark, facts, versions, kind)
    found = lookup_valid(left, right, [("k", "k")], "moment", "sk", "sk_out")
    assert found.columns == ["id", "k", "moment", "sk_out"]
    assert rows_of(found) == plain(facts, versions)


@pytest.mark.parametrize("seed", range(3))
def test_random_lengths_equal_all_pairs(spark, seed):
    picks = random.Random(seed)
    versions, facts = [], []
    for n in range(150):
        start = START + timedelta(microseconds=picks.randrange(-(10**6), 10**picks.randrange(3, 14)))
        end = None if picks.random() < 0.1 else start + timedelta(microseconds=picks.randrange(10**picks.randrange(1, 14)))
        versions.append((picks.choice("hhhab"), start, end, str(n)))
    for n in range(300):
        facts.append((n, picks.choice("hhhab"), START + timedelta(microseconds=picks.randrange(10**picks.randrange(3, 14)))))
    facts += [(1_000 + n, v[0], v[1 + n % 2] or v[1]) for n, v in enumerate(versions)]
    left, right = frames(spark, facts, versions, "timestamp_ntz")
    assert rows_of(lookup_valid(left, right, [("k", "k")], "moment", "sk", "sk_out")) == plain(facts, versions)


@pytest.mark.parametrize("kind,turn", [("bigint", lambda n: n), ("date", lambda n: date(2024, 1, 1) + timedelta(days=n))])
def test_numbers_and_dates(spark, kind, turn):
    versions = [("a", turn(0), turn(9), "x"), ("a", turn(5), None, "y"), ("a", turn(-70), turn(70), "z")]
    facts = [(n, "a", turn(n - 3)) for n in range(16)]
    left, right = frames(spark, facts, versions, kind)
    assert rows_of(lookup_valid(left, right, [("k", "k")], "moment", "sk", "sk_out")) == plain(facts, versions)


def test_nothing_asked_or_known(spark):
    facts, versions = edge_cases()
    left, right = frames(spark, facts, versions, "timestamp_ntz")
    assert lookup_valid(left.limit(0), right, [("k", "k")], "moment", "sk", "sk_out").count() == 0
    none = lookup_valid(left, right.limit(0), [("k", "k")], "moment", "sk", "sk_out")
    assert rows_of(none) == plain(facts, [])


def test_times_of_other_kinds_take_the_plain_join(spark):
    left, right = frames(spark, [(1, "a", "m")], [("a", "b", None, "x"), ("a", "n", None, "y")], "string")
    assert rows_of(lookup_valid(left, right, [("k", "k")], "moment", "sk", "sk_out")) == [(1, "x")]
    with pytest.raises(TypeError):
        valid_versions(left, right, ["k"], "moment", "valid_from", "valid_to", "sk")


def test_candidates_stay_near_the_matches(spark):
    """Many short versions of one key: the join meets a few candidates a fact, not facts x versions."""
    size = 2_000
    versions = [("a", START + timedelta(hours=n), START + timedelta(hours=n + 3) - TICK, str(n)) for n in range(size)]
    facts = [(n, "a", START + timedelta(minutes=37 * n)) for n in range(size)]
    left, right = frames(spark, facts, versions, "timestamp_ntz")
    found = valid_versions(left, right, ["k"], "moment", "valid_from", "valid_to", "sk")
    assert rows_of(lookup_valid(left, right, [("k", "k")], "moment", "sk", "sk_out")) == rows_of(
        lookup_between(left, right, [("k", "k")], "moment", "sk", "sk_out")
    )
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join Inner" in line)
    assert all(name in join for name in ("__level", "__bucket", "__k0"))


def test_small_files_are_not_broadcast(spark):
    """Few keys and even times pack into files below any broadcast limit, while their rows fill the driver's memory."""
    facts = [(n, "a", START + timedelta(hours=n % 720)) for n in range(5_000)]
    versions = [("a", START + timedelta(hours=n), START + timedelta(hours=n + 4**n), str(n)) for n in range(7)]
    left, right = frames(spark, facts, versions, "timestamp_ntz")
    found = valid_versions(left, right, ["k"], "moment", "valid_from", "valid_to", "sk")
    joined = lookup_valid(left, right, [("k", "k")], "moment", "sk", "sk_out")
    for frame in (found, joined):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert rows_of(joined) == plain(facts, versions)
