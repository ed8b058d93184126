from __future__ import annotations

import copy
import json
from pathlib import Path

import pytest
import yaml

from tierlake.config import load_config, parse_config
from tierlake.operators.quality import NO_FILL
from tierlake.sources.readers import file_location

CONFIGS = Path(__file__).resolve().parent.parent / "configs"


@pytest.fixture()
def document():
    return yaml.safe_load((CONFIGS / "events.yml").read_text())


def test_shipped_configurations_load():
    events = load_config(CONFIGS / "events.yml", "file:///data/")
    orders = load_config(CONFIGS / "orders.yml", "file:///data/")
    assert events.layout.tech == "file:///data/lake/events/silver/tech"
    assert events.layout.reject == "file:///data/lake/events/silver/reject"
    assert orders.layout.monitoring == "file:///data/lake/orders/monitoring"
    assert events.func_mode == "overwrite" and orders.func_mode == "append" and orders.against_existing
    rules = {rule.name: rule for rule in events.rules}
    assert rules["event_id"].required and rules["value"].fill == 0.0 and rules["user_id"].fill is NO_FILL
    assert load_config(CONFIGS / "events.yml").layout.gold == "s3a://lake/events/gold"


def test_json_works_as_well(document, tmp_path):
    path = tmp_path / "events.json"
    path.write_text(json.dumps(document))
    assert load_config(path).name == "events"


def change(document, path, value):
    changed = copy.deepcopy(document)
    target = changed
    for step in path[:-1]:
        target = target[step]
    if value is None:
        del target[path[-1]]
    else:
        target[path[-1]] = value
    return changed


FACT = ("gold", "facts", 0, "joins", 0)
BROKEN = [
    (("pipeline",), None, "has no section"),
    (("bronze",), None, "has no section"),
    (("silver", "tech"), None, "silver has no section"),
    (("source", "type"), "queue", "source.type must be"),
    (("source",), {"type": "api"}, "provider names the transport"),
    (("source",), {"type": "api", "provider": "x", "pagination": {"page_size": -1, "max_rows": 1}}, "above 0"),
    (("silver", "tech", "prefix"), "events/silver/checked", "set silver.reject"),
    (("silver", "tech", "columns", 4, "fill_nulls"), "zero", "not a number"),
    (("silver", "tech", "columns", 2, "accepted_values"), ["x"], "not a number"),
    (("silver", "tech", "columns", 2, "fill_nulls"), 0.5, "not a whole number"),
    (("silver", "tech", "columns", 3, "check_range"), {"min": 1}, "numeric or time type"),
    (("silver", "func", "transformations", 0, "type"), "script", "expression or an aggregate"),
    (("silver", "func", "enrichments", 0, "metrics", 0, "function"), "median", "No such metric function"),
    (("silver", "func", "deduplication", "strategy"), "latest", "No such deduplication"),
    (("gold", "dimensions", 0, "scd", "type"), 3, "scd.type is 1 or 2"),
    (("gold", "dimensions", 0, "scd", "valid_from"), None, "needs scd.valid_from"),
    (("gold", "dimensions", 0, "business_key"), ["nobody"], "does not list"),
    ((*FACT, "dimension"), "dim_nobody", "unknown dimension"),
    ((*FACT, "target_key"), ["user_key", "event_type"], "unequal number"),
    ((*FACT, "effective_at"), "never", "unknown column"),
    ((*FACT, "effective_at"), None, "fan_out: true"),
    (("source",), {"type": "file", "location": "/x", "pagination": {"page_size": 1, "max_rows": 1}}, "read whole"),
    (("source",), {"type": "file", "format": "csv", "bucket": "b"}, "bucket and a prefix"),
    (("silver", "tech", "columns", 2, "fill_nulls"), 99999999999, "does not fit integer"),
    (("silver", "tech", "columns", 1, "fill_nulls"), "abc", "is no time like"),
    (("silver", "tech", "columns", 1, "check_range"), {"min": "soon"}, "is no time like"),
]


@pytest.mark.parametrize("path, value, message", BROKEN)
def test_mistakes_are_found_before_any_job_runs(document, path, value, message):
    with pytest.raises(ValueError, match=message):
        parse_config(change(document, path, value))


def test_a_list_is_no_configuration():
    with pytest.raises(ValueError, match="is a mapping of sections"):
        parse_config([1])


def test_gold_and_monitoring_are_optional(document):
    config = parse_config(change(change(document, ("gold",), None), ("monitoring",), None))
    assert config.layout.gold_location is None and config.layout.monitoring.endswith("events/monitoring")


def test_reject_and_file_locations_can_be_named(document):
    named = change(document, ("silver", "reject"), {"bucket": "other", "prefix": "bad/rows"})
    assert parse_config(named, "file:///d/").layout.reject == "file:///d/other/bad/rows"
    source = {"type": "file", "format": "csv", "bucket": "in", "prefix": "/a/b/"}
    assert file_location(parse_config(change(document, ("source",), source), "file:///d/").source) == "file:///d/in/a/b"


def test_joins_can_fan_out_when_asked(document):
    asked = change(change(document, (*FACT, "effective_at"), None), (*FACT, "fan_out"), True)
    assert parse_config(asked).facts[0].joins[0].fan_out
