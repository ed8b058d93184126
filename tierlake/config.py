"""The pipeline contract: one YAML (or JSON) mapping, checked once and turned into plain dataclasses."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime
from decimal import Decimal, InvalidOperation
from pathlib import Path
from typing import Any

from tierlake.operators.dedup import STRATEGIES, Dedup
from tierlake.operators.dimensions import DETECT, Dimension
from tierlake.operators.facts import DimensionJoin, Fact
from tierlake.operators.quality import NO_FILL, ColumnRule
from tierlake.operators.transform import AGGREGATES, Enrichment, Expression, Metric, OutputColumn
from tierlake.sources.storage import Layout, reject_prefix

try:
    import yaml
except ImportError:  # JSON configurations still work.
    yaml = None

SOURCE_TYPES = ("api", "file", "table", "events")
WHOLE_BITS = {"tinyint": 8, "smallint": 16, "int": 32, "integer": 32, "bigint": 64, "long": 64}
NUMERIC_TYPES = ("tinyint", "smallint", "int", "integer", "bigint", "long", "float", "double")
TIME_TYPES = ("date", "timestamp", "timestamp_ntz", "timestamp_ltz")


@dataclass(frozen=True)
class SourceConfig:
    """Where rows come from. ``options`` holds the keys that only one source type needs."""

    type: str
    provider: str | None = None
    filter: Mapping[str, Any] | None = None
    page_size: int | None = None
    max_rows: int | None = None
    max_retries: int = 3
    request_timeout_seconds: int = 120
    options: Mapping[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class PipelineConfig:
    name: str
    layout: Layout
    source: SourceConfig
    raw_table: str
    tech_table: str
    func_table: str
    raw_columns: tuple[str, ...] | None
    rules: tuple[ColumnRule, ...]
    require_columns: bool
    keep_source: bool
    batch_write: str
    func_columns: tuple[OutputColumn, ...]
    transformations: tuple[Expression | Enrichment, ...]
    enrichments: tuple[Expression | Enrichment, ...]
    dedup: Dedup | None
    func_scope: str
    against_existing: bool
    func_partitions: int | None
    gold_partitions: int | None
    dimensions: tuple[Dimension, ...]
    facts: tuple[Fact, ...]

    @property
    def strategy(self) -> str:
        """The name monitoring shows; without any de-duplication it is the default's."""
        return self.dedup.strategy if self.dedup else "snapshot"

    @property
    def func_mode(self) -> str:
        return "append" if self.strategy == "history" else "overwrite"


def _mapping(value: Any, where: str) -> Mapping[str, Any]:
    if not isinstance(value, Mapping):
        raise ValueError("{}: expected keys with values".format(where))
    return value


def _need(section: Mapping[str, Any], key: str, where: str) -> Any:
    if section.get(key) in (None, "", []):
        raise ValueError("{} needs a value for {}".format(where, key))
    return section[key]


def _names(value: Any, where: str) -> tuple[str, ...]:
    if isinstance(value, str) or not isinstance(value, Sequence):
        raise ValueError("{} must be a list of names".format(where))
    return tuple(str(item) for item in value)


def _one_of(value: str, allowed: Sequence[str], message: str) -> str:
    if value not in allowed:
        raise ValueError("{}: {}".format(message, value))
    return value


def _location(section: Mapping[str, Any], where: str) -> tuple[str, str]:
    return str(_need(section, "bucket", where)), str(_need(section, "prefix", where))


def _check_constant(value: Any, type_name: str, where: str) -> Any:
    """A constant must be usable in the declared type, or the cast would fail while the job runs."""
    kind = type_name.lower()
    if kind in NUMERIC_TYPES or kind.startswith("decimal"):
        try:
            number = Decimal(str(value))
        except InvalidOperation:
            raise ValueError("{}: {!r} is not a number".format(where, value)) from None
        whole = kind in NUMERIC_TYPES and kind not in ("float", "double")
        if whole and number != number.to_integral_value():
            raise ValueError("{}: {!r} is not a whole number".format(where, value))
        bits = WHOLE_BITS.get(kind)
        if bits and not -(2 ** (bits - 1)) <= number < 2 ** (bits - 1):
            raise ValueError("{}: {!r} does not fit {}".format(where, value, kind))
        digits = re.fullmatch(r"decimal\s*\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)", kind)
        if digits and number.is_finite() and abs(number) >= 10 ** (int(digits[1]) - int(digits[2] or 0)):
            raise ValueError("{}: {!r} does not fit {}".format(where, value, kind))
    elif kind in TIME_TYPES and not isinstance(value, (date, datetime)):
        try:
            datetime.fromisoformat(str(value).strip())
        except ValueError:
            raise ValueError("{}: {!r} is no time like 2024-01-31 or 2024-01-31T12:00:00".format(where, value)) from None
    return value


def _rule(item: Any) -> ColumnRule:
    item = _mapping(item, "silver.tech.columns[]")
    name = str(_need(item, "name", "silver.tech.columns[]"))
    kind = str(item.get("type", "string"))
    where = "silver.tech.columns[{}]".format(name)
    bounds = _mapping(item.get("check_range") or {}, where + ".check_range")
    if bounds and not (kind.lower() in NUMERIC_TYPES + TIME_TYPES or kind.lower().startswith("decimal")):
        raise ValueError("{}.check_range needs a numeric or time type".format(where))
    for bound in bounds.values():
        _check_constant(bound, kind if kind.lower() in TIME_TYPES else "double", where + ".check_range")
    accepted = tuple(item.get("accepted_values") or ())
    for value in accepted:
        _check_constant(value, kind, where + ".accepted_values")
    fill = item["fill_nulls"] if "fill_nulls" in item else NO_FILL
    if fill is not NO_FILL and fill is not None:
        _check_constant(fill, kind, where + ".fill_nulls")
    return ColumnRule(
        name=name,
        type=kind,
        required=bool(item.get("check_nullability")) and bool(item.get("is_critical")),
        minimum=bounds.get("min"),
        maximum=bounds.get("max"),
        accepted=accepted,
        fill=fill,
    )


def _column(item: Any) -> OutputColumn:
    item = _mapping(item, "columns[]")
    return OutputColumn(str(_need(item, "name", "columns[]")), item.get("source"), item.get("expression"))


def _command(item: Any) -> Expression | Enrichment:
    item = _mapping(item, "command")
    kind = item.get("type", "expression")
    if kind == "expression":
        return Expression(_need(item, "name", "expression"), str(_need(item, "expression", "expression")))
    if kind == "aggregate":
        metrics = tuple(
            Metric(
                _need(metric, "name", "metrics[]"),
                _one_of(_need(metric, "function", "metrics[]"), tuple(AGGREGATES), "No such metric function"),
                metric.get("column", "*"),
            )
            for metric in _need(item, "metrics", "aggregate")
        )
        return Enrichment(_names(_need(item, "group_by", "aggregate"), "group_by"), metrics)
    raise ValueError("A command is an expression or an aggregate, not {}".format(kind))


def _dedup(section: Mapping[str, Any] | None) -> Dedup | None:
    if not section:
        return None
    hashing = section.get("hash") or {}
    return Dedup(
        keys=_names(_need(section, "keys", "deduplication"), "deduplication.keys"),
        strategy=_one_of(section.get("strategy", "snapshot"), STRATEGIES, "No such deduplication.strategy"),
        order_by=_names(section.get("order_by") or [], "deduplication.order_by"),
        hash_column=hashing.get("column", "hash_data"),
        hash_columns=_names(hashing["columns"], "hash.columns") if "columns" in hashing else None,
        hash_exclude=_names(hashing.get("exclude") or [], "hash.exclude"),
    )


def _dimension(item: Any) -> Dimension:
    item = _mapping(item, "gold.dimensions[]")
    name = str(_need(item, "name", "gold.dimensions[]"))
    where = "gold.dimensions[{}]".format(name)
    scd = item.get("scd") or {}
    scd_type = int(scd.get("type", 1))
    if scd_type not in (1, 2):
        raise ValueError("{}: scd.type is 1 or 2, not {}".format(where, scd_type))
    columns = tuple(_column(column) for column in _need(item, "columns", where))
    names = {column.name for column in columns}
    keys = _names(_need(item, "business_key", where), where + ".business_key")
    valid_from = scd.get("valid_from")
    tracked = _names(scd["tracked_columns"], where + ".tracked_columns") if "tracked_columns" in scd else None
    if scd_type == 2 and not valid_from:
        raise ValueError("{} of type 2 needs scd.valid_from".format(where))
    for used in (*keys, *(tracked or ()), *([valid_from] if valid_from else [])):
        if used not in names:
            raise ValueError("{} uses column {} it does not list".format(where, used))
    return Dimension(
        name=name,
        business_key=keys,
        surrogate_key=_need(item, "surrogate_key", where),
        columns=columns,
        source_columns=_names(item.get("source_columns") or [], where + ".source_columns"),
        scd_type=scd_type,
        valid_from=valid_from,
        tracked=tracked,
        detect=_one_of(scd.get("detect", "distinct"), DETECT, "No such scd.detect"),
        null_token=item.get("null_token"),
        path=item.get("path"),
    )


def _fact(item: Any, dimensions: Mapping[str, Dimension]) -> Fact:
    item = _mapping(item, "gold.facts[]")
    name = str(_need(item, "name", "gold.facts[]"))
    where = "gold.facts[{}]".format(name)
    columns = tuple(_column(column) for column in _need(item, "columns", where))
    available = {column.name for column in columns}
    joins = []
    for join in item.get("joins") or []:
        target = _one_of(_need(join, "dimension", where), tuple(dimensions), where + " joins unknown dimension")
        source_key = _names(_need(join, "source_key", where), where + ".source_key")
        target_key = _names(_need(join, "target_key", where), where + ".target_key")
        if len(source_key) != len(target_key):
            raise ValueError("{} join to {} has source and target keys of unequal number".format(where, target))
        effective_at = join.get("effective_at")
        for used in (*source_key, *([effective_at] if effective_at else [])):
            if used not in available:
                raise ValueError("{} join to {} uses unknown column {}".format(where, target, used))
        found = DimensionJoin(target, source_key, target_key, join.get("output_key"), effective_at, bool(join.get("fan_out")))
        if not found.fan_out and not found.finds_one(dimensions[target]):
            raise ValueError("{} join to {} can multiply rows; set fan_out: true to allow it".format(where, target))
        joins.append(found)
        available.add(join.get("output_key") or dimensions[target].surrogate_key)
    return Fact(name, columns, tuple(joins), item.get("path"))


def _source(section: Mapping[str, Any]) -> SourceConfig:
    kind = _one_of(section.get("type"), SOURCE_TYPES, "source.type must be one of {}, not".format(SOURCE_TYPES))
    pages = section.get("pagination") or {}
    if kind == "api":
        if not section.get("provider"):
            raise ValueError("source.provider names the transport of a paged source and is missing")
        if int(_need(pages, "page_size", "source.pagination")) <= 0 or int(
            _need(pages, "max_rows", "source.pagination")
        ) <= 0:
            raise ValueError("source.pagination: page_size and max_rows have to be above 0")
    elif pages:
        raise ValueError("source.pagination is for paged sources; a {} source is read whole".format(kind))
    if kind == "file" and "location" not in section and not (section.get("bucket") and section.get("prefix")):
        raise ValueError("A file source needs a location, or a bucket and a prefix")
    known = ("type", "provider", "filter", "pagination")
    return SourceConfig(
        type=kind,
        provider=section.get("provider"),
        filter=section.get("filter"),
        page_size=int(pages["page_size"]) if "page_size" in pages else None,
        max_rows=int(pages["max_rows"]) if "max_rows" in pages else None,
        max_retries=int(pages.get("max_retries", 3)),
        request_timeout_seconds=int(pages.get("request_timeout_seconds", 120)),
        options={key: value for key, value in section.items() if key not in known},
    )


def parse_config(document: Any, root: str = "s3a://") -> PipelineConfig:
    """Check a parsed configuration. ``root`` is put before every bucket."""
    if not isinstance(document, Mapping):
        raise ValueError("A pipeline configuration is a mapping of sections")
    for section in ("pipeline", "source", "bronze", "silver"):
        if section not in document:
            raise ValueError("The configuration has no section {}".format(section))
    silver = _mapping(document["silver"], "silver")
    for section in ("raw", "tech", "func"):
        if section not in silver:
            raise ValueError("silver has no section {}".format(section))
    raw, tech, func = silver["raw"], silver["tech"], silver["func"]
    gold = document.get("gold")
    bronze = document["bronze"]
    name = str(_need(document["pipeline"], "name", "pipeline"))
    monitoring = document.get("monitoring") or {}
    if "reject" not in silver:
        reject_prefix(str(_need(tech, "prefix", "silver.tech")))

    layout = Layout(
        root=root,
        pipeline=name,
        bronze_location=_location(bronze, "bronze"),
        raw_location=_location(raw, "silver.raw"),
        tech_location=_location(tech, "silver.tech"),
        func_location=_location(func, "silver.func"),
        gold_location=_location(gold, "gold") if gold else None,
        monitoring_location=(
            monitoring.get("bucket", bronze["bucket"]),
            monitoring.get("prefix", "{}/monitoring".format(name)),
        ),
        reject_location=_location(silver["reject"], "silver.reject") if "reject" in silver else None,
    )
    dimensions = tuple(_dimension(item) for item in (gold or {}).get("dimensions") or [])
    by_name = {dimension.name: dimension for dimension in dimensions}
    schema_mode = _one_of(raw.get("schema_mode", "infer"), ("infer", "declared"), "No such silver.raw.schema_mode")
    declared = None
    if schema_mode == "declared":
        declared = tuple(column["name"] for column in _need(raw, "columns", "silver.raw"))
    return PipelineConfig(
        name=name,
        layout=layout,
        source=_source({"root": root, **_mapping(document["source"], "source")}),
        raw_table=raw.get("table_name", "raw_" + name),
        tech_table=tech.get("table_name", "tech_" + name),
        func_table=func.get("table_name", "func_" + name),
        raw_columns=declared,
        rules=tuple(_rule(item) for item in tech.get("columns") or []),
        require_columns=bool(tech.get("require_columns", False)),
        keep_source=bool(tech.get("keep_source", False)),
        batch_write=_one_of(document.get("batch_write", "append"), ("append", "replace"), "No such batch_write"),
        func_columns=tuple(_column(item) for item in func.get("columns") or []),
        transformations=tuple(_command(item) for item in func.get("transformations") or []),
        enrichments=tuple(_command(item) for item in func.get("enrichments") or []),
        dedup=_dedup(func.get("deduplication")),
        func_scope=_one_of(func.get("scope", "latest_batch"), ("latest_batch", "all_batches"), "No such silver.func.scope"),
        against_existing=bool((func.get("deduplication") or {}).get("against_existing", False)),
        func_partitions=int(func["output_partitions"]) if "output_partitions" in func else None,
        gold_partitions=int(gold["output_partitions"]) if gold and "output_partitions" in gold else None,
        dimensions=dimensions,
        facts=tuple(_fact(item, by_name) for item in (gold or {}).get("facts") or []),
    )


def load_config(path: str | Path, root: str = "s3a://") -> PipelineConfig:
    """Read and check one configuration file."""
    path = Path(path)
    text = path.read_text(encoding="utf-8")
    if path.suffix == ".json":
        return parse_config(json.loads(text), root)
    if yaml is None:
        raise RuntimeError("Reading YAML needs the yaml package; use a .json configuration instead")
    return parse_config(yaml.safe_load(text), root)
