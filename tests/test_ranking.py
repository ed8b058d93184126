"""Row numbers and pages against plain sorting."""

from __future__ import annotations

import re

import pytest

from tierlake.operators.ranking import rank


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(i * 37 % 1009, None if i % 11 == 0 else i % 5, "t{}".format(i)) for i in range(1009)]
    return spark.createDataFrame(rows, "id int, grp int, text string").repartition(7)


@pytest.mark.parametrize("slots", [1, 5, 40])
def test_numbers_follow_the_order(frame, slots):
    found = rank(frame, ["grp", "id"], slots).numbered("n").collect()
    wanted = sorted(frame.collect(), key=lambda r: (r["grp"] is None, r["grp"] or 0, r["id"]))
    assert [r["id"] for r in sorted(found, key=lambda r: r["n"])] == [r["id"] for r in wanted]
    assert sorted(r["n"] for r in found) == list(range(1009))


def test_any_page(frame):
    ranking = rank(frame, ["id"], 9)
    for offset, limit in ((0, 1), (0, 5000), (500, 100), (1000, 50), (1008, 1)):
        assert sorted(r["id"] for r in ranking.page(offset, limit).collect()) == list(range(1009))[offset : offset + limit]
    assert ranking.page(1009, 10).collect() == [] and ranking.page(5000, 10).columns == frame.columns
    for offset, limit in ((-1, 5), (0, 0)):
        with pytest.raises(ValueError, match="offset of 0 or more"):
            ranking.page(offset, limit)


def test_pages_up_to_a_limit(frame):
    ranking = rank(frame, ["id"], 9)
    paged, truncated = ranking.pages(100, 250)
    assert truncated and sorted((r["page"], r["id"]) for r in paged.collect()) == [(i // 100, i) for i in range(250)]
    paged, truncated = ranking.pages(100, 1009)
    assert not truncated and paged.count() == 1009
    with pytest.raises(ValueError, match="above 0"):
        ranking.pages(0, 5)


def test_a_page_reads_the_slots_it_touches(frame, capsys):
    page = rank(frame, ["id"], 9).page(900, 10)
    page.explain("formatted")
    plan = capsys.readouterr().out
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(__slot,", plan)
    assert "SinglePartition" not in plan and "RoundRobin" not in plan


def test_equal_and_no_rows(spark):
    same = spark.createDataFrame([(1, "x")] * 300, "id int, text string")
    assert sorted(r["n"] for r in rank(same, ["id"], 4).numbered("n").collect()) == list(range(300))
    empty = rank(same.limit(0), ["id"], 4)
    assert empty.size == 0 and empty.page(0, 10).collect() == [] and empty.pages(5, 5)[1] is False
