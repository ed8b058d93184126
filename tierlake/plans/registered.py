"""Every operator as a runnable query over the shared test tables, beside the SQL that must give the same rows.

The tables hold clean data, so some queries plant dirt with a CASE projection; its text is the same for Spark and for
the SQL engine that checks it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierlake.config import PipelineConfig, parse_config
from tierlake.functions.scalars import blank_to_null, fill_null, hash_key, typed_cast
from tierlake.operators.dedup import Dedup, deduplicate
from tierlake.operators.dimensions import Dimension, build_dimension
from tierlake.operators.facts import DimensionJoin, Fact, build_fact, lookup_between, lookup_sorted
from tierlake.operators.quality import ColumnRule, evaluate, split
from tierlake.operators.ranking import rank
from tierlake.operators.transform import Enrichment, Expression, Metric, OutputColumn, apply_commands, project
from tierlake.plans.history import append_history, read_history
from tierlake.plans.jobs import run_all
from tierlake.plans.layers import StepResult, bronze_to_raw, func_to_gold, ingest, raw_to_tech, read_func, tech_to_func
from tierlake.sources.catalog import mirror
from tierlake.sources.readers import read_files, read_source
from tierlake.sources.staging import new_folder, stage
from tierlake.sources.storage import batch_path, between, has_parquet, latest_batch, read_bronze, write_jsonl
from tierlake.plans.merge import merge_dimension, read_dimension
from tierlake.sources.versions import read_current, replace_dataset
from tierlake.streaming.quality_stream import start_quality_stream, text_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def registered(sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet("{}/{}.parquet".format(folder, name))


def columns(*names: str) -> tuple[OutputColumn, ...]:
    return tuple(OutputColumn(name) for name in names)


# --- events with planted dirt -------------------------------------------------------------------------------------

DIRTY_COLUMNS = (
    "event_id",
    "user_id",
    "ts",
    "case when event_id % 11 = 0 then '  ' when event_id % 13 = 0 then 'abc' when event_id % 17 = 0 then '-5' "
    "when event_id % 19 = 0 then '9999' else cast(value as string) end as value",
    "case when event_id % 7 = 0 then '' when event_id % 23 = 0 then cast(user_id as string) || '.7' "
    "when event_id % 31 = 0 then '1e3' else cast(user_id as string) end as visitor",
    "case when event_id % 29 = 0 then 'unknown' else event_type end as kind",
)
DIRTY = ", ".join(DIRTY_COLUMNS)

RULES = (
    ColumnRule("event_id", "bigint", required=True),
    ColumnRule("user_id", "bigint"),
    ColumnRule("ts", "timestamp_ntz", required=True),
    ColumnRule("value", "double", required=True, minimum=0, maximum=1000, fill=0.0),
    ColumnRule("visitor", "integer", minimum=1, maximum=140, fill=-1),
    ColumnRule("kind", "string", accepted=("click", "error", "purchase", "signup", "view")),
)

WHOLE = r"^([+-]?[0-9]+)(\.[0-9]*)?$"

CHECKED = """
    dirty as (select {dirty} from events),
    blanked as (select event_id, user_id, ts, case when trim(value) = '' then null else value end as value_s,
        case when trim(visitor) = '' then null else visitor end as visitor_s, kind from dirty),
    typed as (select *, try_cast(value_s as double) as value_t,
        try_cast(regexp_extract(trim(visitor_s), '{whole}', 1) as integer) as visitor_t from blanked),
    coded as (select *,
        case when value_s is not null and value_t is null then 'check=unexpected_value; reason=cast_failed'
             when value_s is null then 'check=unexpected_null; reason=required_field_missing'
             when value_t < 0 then 'check=unexpected_value; reason=below_minimum'
             when value_t > 1000 then 'check=unexpected_value; reason=above_maximum' end as value_c,
        case when visitor_s is not null and visitor_t is null then 'check=unexpected_value; reason=cast_failed'
             when visitor_t < 1 then 'check=unexpected_value; reason=below_minimum'
             when visitor_t > 140 then 'check=unexpected_value; reason=above_maximum' end as visitor_c,
        case when kind not in ('click', 'error', 'purchase', 'signup', 'view')
             then 'check=unexpected_value; reason=not_accepted' end as kind_c from typed),
    checked as (select event_id, user_id, ts, coalesce(value_t, 0.0) as value, coalesce(visitor_t, -1) as visitor, kind,
        concat_ws('; ', 'field=value; ' || value_c, 'field=visitor; ' || visitor_c, 'field=kind; ' || kind_c)
            as rejection_reason,
        concat_ws(',', case when value_c is not null then 'value' end, case when visitor_c is not null then 'visitor' end,
            case when kind_c is not null then 'kind' end) as rejected_fields,
        concat_ws('; ', 'field=kind; ' || kind_c, 'field=value; ' || value_c, 'field=visitor; ' || visitor_c)
            as landed_reason,
        concat_ws(',', case when kind_c is not null then 'kind' end, case when value_c is not null then 'value' end,
            case when visitor_c is not null then 'visitor' end) as landed_fields,
        'tech' as rejection_stage from coded),
    valid as (select event_id, user_id, ts, value, visitor, kind from checked where rejection_reason = '')
""".format(dirty=DIRTY, whole=WHOLE)


def dirty_events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(*DIRTY_COLUMNS)


def valid_events(spark: SparkSession, folder: str) -> DataFrame:
    return split(dirty_events(spark, folder), RULES)[0]


# --- scalar expressions --------------------------------------------------------------------------------------------


@registered(
    "with dirty as (select {} from events) select event_id, case when trim(value) = '' then null else value end as value,"
    " case when trim(visitor) = '' then null else visitor end as visitor from dirty".format(DIRTY)
)
def blank_to_null_text(spark: SparkSession, folder: str) -> DataFrame:
    frame = dirty_events(spark, folder)
    return frame.select("event_id", *[blank_to_null(F.col(name)).alias(name) for name in ("value", "visitor")])


@registered(
    "with dirty as (select {} from events) select event_id, try_cast(trim(value) as double) as value,"
    " try_cast(regexp_extract(trim(visitor), '{}', 1) as integer) as visitor from dirty".format(DIRTY, WHOLE)
)
def typed_cast_text(spark: SparkSession, folder: str) -> DataFrame:
    return dirty_events(spark, folder).select(
        "event_id",
        typed_cast(F.col("value"), "double").alias("value"),
        typed_cast(F.col("visitor"), "integer").alias("visitor"),
    )


@registered(
    "with dirty as (select {} from events) select event_id, coalesce(try_cast(trim(value) as double), 0.0) as value,"
    " coalesce(try_cast(regexp_extract(trim(visitor), '{}', 1) as integer), -1) as visitor from dirty".format(
        DIRTY, WHOLE
    )
)
def fill_nulls(spark: SparkSession, folder: str) -> DataFrame:
    return dirty_events(spark, folder).select(
        "event_id",
        fill_null(typed_cast(F.col("value"), "double"), 0.0, "double").alias("value"),
        fill_null(typed_cast(F.col("visitor"), "integer"), -1, "integer").alias("visitor"),
    )


NULLED = "case when o_orderkey % 7 = 0 then null else o_orderstatus end as status"


@registered(
    "select o_orderkey, sha256(concat_ws('||', cast(o_orderkey as string), status, o_orderpriority, "
    "cast(o_orderdate as string))) as row_key, sha256(concat_ws('||', cast(o_orderkey as string), "
    "coalesce(status, '<null>'), o_orderpriority)) as strict_key from (select *, {} from orders)".format(NULLED)
)
def surrogate_keys(spark: SparkSession, folder: str) -> DataFrame:
    frame = table(spark, folder, "orders").selectExpr("*", NULLED)
    return frame.select(
        "o_orderkey",
        hash_key(["o_orderkey", "status", "o_orderpriority", "o_orderdate"]).alias("row_key"),
        hash_key(["o_orderkey", "status", "o_orderpriority"], null_token="<null>").alias("strict_key"),
    )


# --- quality rules -------------------------------------------------------------------------------------------------


@registered("with {} select * from valid".format(CHECKED))
def quality_valid(spark: SparkSession, folder: str) -> DataFrame:
    return valid_events(spark, folder)


@registered(
    "with {} select * exclude (landed_reason, landed_fields) from checked where rejection_reason <> ''".format(CHECKED)
)
def quality_rejected(spark: SparkSession, folder: str) -> DataFrame:
    return split(dirty_events(spark, folder), RULES)[1].drop("rejected_at")


@registered(
    "with {} select cast(count(*) filter (rejection_reason = '') as bigint) as valid_rows, "
    "cast(count(*) filter (rejection_reason <> '') as bigint) as rejected_rows from checked".format(CHECKED)
)
def quality_counts(spark: SparkSession, folder: str) -> DataFrame:
    evaluated = evaluate(dirty_events(spark, folder), RULES)
    return evaluated.frame.agg(
        F.count(F.when(~evaluated.failed, 1)).alias("valid_rows"),
        F.count(F.when(evaluated.failed, 1)).alias("rejected_rows"),
    )


@registered(
    """
    with bad as (select l_orderkey, l_linenumber, l_quantity, l_discount, l_returnflag,
        case when l_quantity < 5 then 'field=l_quantity; check=unexpected_value; reason=below_minimum'
             when l_quantity > 45 then 'field=l_quantity; check=unexpected_value; reason=above_maximum' end as q,
        case when l_discount > 0.08 then 'field=l_discount; check=unexpected_value; reason=above_maximum' end as d,
        case when l_returnflag not in ('A', 'R')
             then 'field=l_returnflag; check=unexpected_value; reason=not_accepted' end as f from lineitem)
    select concat_ws('; ', q, d, f) as rejection_reason, count(*) as n, cast(sum(l_orderkey) as bigint) as order_sum
    from bad where coalesce(q, d, f) is not null group by 1
    """
)
def quality_reason_report(spark: SparkSession, folder: str) -> DataFrame:
    rules = (
        ColumnRule("l_orderkey", "bigint", required=True),
        ColumnRule("l_quantity", "double", minimum=5, maximum=45),
        ColumnRule("l_discount", "double", maximum=0.08),
        ColumnRule("l_returnflag", accepted=("A", "R")),
    )
    ruled = table(spark, folder, "lineitem").select(*[rule.name for rule in rules])
    rejected = split(ruled, rules)[1]
    return rejected.groupBy("rejection_reason").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("order_sum")
    )


@registered(
    "with {} select event_id, rejected_fields, case when value_c is not null then value_s end as value_text, "
    "case when visitor_c is not null then visitor_s end as visitor_text, case when kind_c is not null then coded.kind end as kind_text "
    "from checked join coded using (event_id) where rejection_reason <> ''".format(CHECKED)
)
def quality_kept_source(spark: SparkSession, folder: str) -> DataFrame:
    rejected = split(dirty_events(spark, folder), RULES, keep_source=True)[1]
    texts = [F.col("source_values")[name].alias(name + "_text") for name in ("value", "visitor", "kind")]
    return rejected.select("event_id", "rejected_fields", *texts)


# --- projection, expressions, enrichment -----------------------------------------------------------------------------


@registered("select o_orderkey as order_key, o_custkey as customer_key, o_totalprice as total, o_orderdate from orders")
def func_project(spark: SparkSession, folder: str) -> DataFrame:
    kept = (
        OutputColumn("order_key", "o_orderkey"),
        OutputColumn("customer_key", "o_custkey"),
        OutputColumn("total", "o_totalprice"),
        OutputColumn("o_orderdate"),
    )
    return project(table(spark, folder, "orders"), kept)


@registered(
    """
    select event_id, cast(ts as date) as event_date, cast(hour(ts) as integer) as event_hour,
        strftime(ts, '%Y%m%d') as date_key, cast(year(ts) as integer) as y, cast(month(ts) as integer) as m,
        cast(day(ts) as integer) as d, case when value > 0 then event_id / value else null end as ratio,
        (cast(hour(ts) as integer) >= 12) as afternoon
    from events
    """
)
def func_expressions(spark: SparkSession, folder: str) -> DataFrame:
    added = (
        Expression("event_date", "to_date(ts)"),
        Expression("event_hour", "hour(ts)"),
        Expression("date_key", "date_format(ts, 'yyyyMMdd')"),
        Expression("y", "year(ts)"),
        Expression("m", "month(ts)"),
        Expression("d", "dayofmonth(ts)"),
        Expression("ratio", "case when value > 0 then event_id / value else null end"),
        Expression("afternoon", "event_hour >= 12"),
    )
    frame = apply_commands(table(spark, folder, "events"), added)
    return frame.select("event_id", *[item.name for item in added])


CENTS = Expression("cents", "cast(round(o_totalprice * 100) as bigint)")


@registered(
    """
    with priced as (select *, cast(round(o_totalprice * 100) as bigint) as cents from orders),
    metrics as (select o_custkey, count(o_orderkey) as orders, avg(cents) as avg_cents from priced group by 1)
    select p.o_custkey, o_orderkey, cents, orders, avg_cents from priced p left join metrics m using (o_custkey)
    """
)
def enrich_count_avg(spark: SparkSession, folder: str) -> DataFrame:
    metrics = (Metric("orders", "count", "o_orderkey"), Metric("avg_cents", "avg", "cents"))
    frame = apply_commands(table(spark, folder, "orders"), (CENTS, Enrichment(("o_custkey",), metrics)))
    return frame.select("o_custkey", "o_orderkey", "cents", "orders", "avg_cents")


@registered(
    """
    with metrics as (select l_suppkey, count(*) as n, count(l_partkey) as parts, sum(l_quantity) as total,
        avg(l_quantity) as mean, min(l_shipdate) as first_ship, max(l_extendedprice) as top_price
        from lineitem group by 1)
    select l_suppkey, l_orderkey, l_linenumber, l_quantity, n, parts, total, mean, first_ship, top_price
    from lineitem join metrics using (l_suppkey)
    """
)
def enrich_all_functions(spark: SparkSession, folder: str) -> DataFrame:
    metrics = (
        Metric("n", "count"),
        Metric("parts", "count", "l_partkey"),
        Metric("total", "sum", "l_quantity"),
        Metric("mean", "avg", "l_quantity"),
        Metric("first_ship", "min", "l_shipdate"),
        Metric("top_price", "max", "l_extendedprice"),
    )
    frame = apply_commands(table(spark, folder, "lineitem"), (Enrichment(("l_suppkey",), metrics),))
    return frame.select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_quantity", *[metric.name for metric in metrics]
    )


KEYED = "case when o_orderkey % 7 = 0 then null else o_custkey end as customer"


@registered(
    """
    with keyed as (select o_orderkey, {} from orders),
    metrics as (select customer, count(*) as orders, max(o_orderkey) as newest from keyed group by 1)
    select k.customer, o_orderkey, orders, newest from keyed k left join metrics m on k.customer = m.customer
    """.format(KEYED)
)
def enrich_null_key(spark: SparkSession, folder: str) -> DataFrame:
    frame = table(spark, folder, "orders").selectExpr("o_orderkey", KEYED)
    metrics = (Metric("orders", "count"), Metric("newest", "max", "o_orderkey"))
    return apply_commands(frame, (Enrichment(("customer",), metrics),))


@registered(
    """
    with a as (select user_id, count(*) as user_events from events group by 1),
    b as (select e.*, user_events from events e join a using (user_id)),
    c as (select event_type, count(*) as type_events from events group by 1),
    d as (select user_events, event_type, count(*) as peers from b group by 1, 2)
    select event_id, user_id, event_type, user_events, type_events, peers
    from b join c using (event_type) join d using (user_events, event_type)
    """
)
def enrich_chain(spark: SparkSession, folder: str) -> DataFrame:
    frame = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    steps = (
        Enrichment(("user_id",), (Metric("user_events", "count"),)),
        Enrichment(("event_type",), (Metric("type_events", "count"),)),
        Enrichment(("user_events", "event_type"), (Metric("peers", "count"),)),
    )
    return apply_commands(frame, steps).select(
        "event_id", "user_id", "event_type", "user_events", "type_events", "peers"
    )


# --- de-duplication --------------------------------------------------------------------------------------------------


def _first(source: str, keys: str, order: str, kept: str = "*") -> str:
    return (
        "select {} from (select *, row_number() over (partition by {} order by {}) as rank_in_key from {}) "
        "where rank_in_key = 1".format(kept, keys, order, source)
    )


@registered(
    _first(
        "lineitem",
        "l_orderkey, l_linenumber",
        "l_shipdate desc nulls last, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,"
        " l_linestatus",
        "* exclude (rank_in_key)",
    )
)
def dedup_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return deduplicate(table(spark, folder, "lineitem"), Dedup(("l_orderkey", "l_linenumber"), "snapshot", ("l_shipdate",)))


TYPE_HASHED = "(select event_id, ts, user_id, event_type, sha256(event_type) as hash_data from events)"


def _event_history(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", "ts", "user_id", "event_type")


@registered(_first(TYPE_HASHED, "user_id, hash_data", "event_id", "* exclude (rank_in_key)"))
def dedup_history(spark: SparkSession, folder: str) -> DataFrame:
    return deduplicate(
        _event_history(spark, folder), Dedup(("user_id",), "history", hash_columns=("event_type",))
    )


@registered(_first(TYPE_HASHED, "user_id, hash_data", "ts desc nulls last", "* exclude (rank_in_key)"))
def dedup_history_ordered(spark: SparkSession, folder: str) -> DataFrame:
    return deduplicate(
        _event_history(spark, folder), Dedup(("user_id",), "history", ("ts",), hash_columns=("event_type",))
    )


@registered(
    "with hashed as (select *, sha256(concat_ws('||', cast(o_custkey as string), o_orderstatus, o_orderpriority)) as "
    "content from orders) " + _first("hashed", "o_custkey, content", "o_orderdate desc, o_orderkey, o_totalprice",
                                     "* exclude (rank_in_key)")
)
def dedup_history_excluding(spark: SparkSession, folder: str) -> DataFrame:
    kept = Dedup(
        ("o_custkey",),
        "history",
        ("o_orderdate",),
        hash_column="content",
        hash_exclude=("o_orderkey", "o_orderdate", "o_totalprice"),
    )
    return deduplicate(table(spark, folder, "orders"), kept)


@registered(
    "with hashed as {0}, known as (select distinct user_id, hash_data from hashed where ts < timestamp '2024-01-04') "
    "select * from ({1}) n where not exists (select 1 from known k where k.user_id = n.user_id and "
    "k.hash_data = n.hash_data)".format(
        TYPE_HASHED, _first("hashed", "user_id, hash_data", "ts desc nulls last", "* exclude (rank_in_key)")
    )
)
def dedup_history_new_only(spark: SparkSession, folder: str) -> DataFrame:
    frame = _event_history(spark, folder)
    dedup = Dedup(("user_id",), "history", ("ts",), hash_columns=("event_type",))
    earlier = deduplicate(frame.filter("ts < timestamp '2024-01-04'"), dedup)
    return deduplicate(frame, dedup, existing=earlier)


@registered(
    "with hashed as {0}, known as ({1}), late as (select * from ({2}) n where not exists (select 1 from known k "
    "where k.user_id is not distinct from n.user_id and k.hash_data = n.hash_data)) "
    "select * from known union all select * from late".format(
        TYPE_HASHED,
        _first("(select * from hashed where ts < timestamp '2024-01-04')", "user_id, hash_data", "ts desc nulls last", "* exclude (rank_in_key)"),
        _first("(select * from hashed where ts >= timestamp '2024-01-03')", "user_id, hash_data", "ts desc nulls last", "* exclude (rank_in_key)"),
    )
)
def dedup_history_appended(spark: SparkSession, folder: str) -> DataFrame:
    """Two overlapping batches to a stored history: the second appends what the buckets it may hit don't hold."""
    frame, path = _event_history(spark, folder), new_folder(spark, "history")
    dedup = Dedup(("user_id",), "history", ("ts",), hash_columns=("event_type",))
    append_history(frame.filter("ts < timestamp_ntz '2024-01-04 00:00:00'"), dedup, path)
    append_history(frame.filter("ts >= timestamp_ntz '2024-01-03 00:00:00'"), dedup, path)
    return read_history(spark, path).select(*frame.columns, "hash_data")


# --- dimensions ------------------------------------------------------------------------------------------------------

SEGMENT = Dimension("dim_segment", ("c_mktsegment",), "segment_key", columns("c_mktsegment"))


@registered("select distinct c_mktsegment, sha256(c_mktsegment) as segment_key from customer")
def dim_scd1(spark: SparkSession, folder: str) -> DataFrame:
    return build_dimension(table(spark, folder, "customer"), SEGMENT)


LAST_ORDER = Dimension(
    "dim_last_order",
    ("o_custkey",),
    "customer_key",
    columns("o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority"),
    valid_from="o_orderdate",
)


@registered(
    "with picked as ({}) select o_custkey, o_orderdate, o_orderstatus, o_orderpriority, "
    "sha256(cast(o_custkey as string)) as customer_key from picked".format(
        _first("orders", "o_custkey", "o_orderdate desc nulls last, o_orderstatus, o_orderpriority")
    )
)
def dim_scd1_latest(spark: SparkSession, folder: str) -> DataFrame:
    return build_dimension(table(spark, folder, "orders"), LAST_ORDER)


@registered(
    "select o_custkey, max(o_orderdate) as o_orderdate, sha256(cast(o_custkey as string)) as customer_key "
    "from orders group by 1"
)
def dim_scd1_last_seen(spark: SparkSession, folder: str) -> DataFrame:
    seen = Dimension(
        "dim_seen", ("o_custkey",), "customer_key", columns("o_custkey", "o_orderdate"), valid_from="o_orderdate"
    )
    return build_dimension(table(spark, folder, "orders"), seen)


NATIONS = Dimension(
    "dim_nation",
    ("nation_id",),
    "nation_key",
    columns("nation_id"),
    source_columns=("c_nationkey", "s_nationkey"),
)

TRADES = """
    trades as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, c_nationkey, s_nationkey
        from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
        join supplier on l_suppkey = s_suppkey)
"""


def trades(spark: SparkSession, folder: str) -> DataFrame:
    joined = (
        table(spark, folder, "lineitem")
        .join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    return joined.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "c_nationkey", "s_nationkey"
    )


@registered(
    "with {}, stacked as (select c_nationkey as nation_id from trades union all select s_nationkey from trades) "
    "select distinct nation_id, sha256(cast(nation_id as string)) as nation_key from stacked "
    "where nation_id is not null".format(TRADES)
)
def dim_roles(spark: SparkSession, folder: str) -> DataFrame:
    return build_dimension(trades(spark, folder), NATIONS)


ORDER_DATE = Dimension(
    "dim_date",
    ("date_key",),
    "date_sk",
    (
        OutputColumn("date_key", expression="date_format(o_orderdate, 'yyyyMMdd')"),
        OutputColumn("order_date", expression="to_date(o_orderdate)"),
        OutputColumn("year", expression="year(o_orderdate)"),
        OutputColumn("month", expression="month(o_orderdate)"),
        OutputColumn("day", expression="dayofmonth(o_orderdate)"),
    ),
)


@registered(
    "select distinct strftime(o_orderdate, '%Y%m%d') as date_key, cast(o_orderdate as date) as order_date, "
    "cast(year(o_orderdate) as integer) as year, cast(month(o_orderdate) as integer) as month, "
    "cast(day(o_orderdate) as integer) as day, sha256(strftime(o_orderdate, '%Y%m%d')) as date_sk from orders"
)
def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    return build_dimension(table(spark, folder, "orders"), ORDER_DATE)


USER_TYPE = Dimension(
    "dim_user",
    ("user_id",),
    "user_sk",
    columns("user_id", "event_type", "ts"),
    scd_type=2,
    valid_from="ts",
    tracked=("event_type",),
)

_ENDED = """
    select *, lead(valid_from) over (partition by {key} order by valid_from, hash_data) - interval 1 microsecond
            as valid_to,
        lead(valid_from) over (partition by {key} order by valid_from, hash_data) is null as is_current,
        sha256(concat_ws('||', cast({key} as string), hash_data)) as {sk} from {source}
"""

USER_VERSIONS = """
    user_first as (select user_id, event_type, min(ts) as valid_from, sha256(event_type) as hash_data
        from events group by user_id, event_type),
    user_versions as ({})
""".format(_ENDED.format(key="user_id", sk="user_sk", source="user_first"))

# More slots than keys, so that timelines are cut in many places.
MANY_SLOTS = 64


@registered("with {} select * from user_versions".format(USER_VERSIONS))
def dim_scd2(spark: SparkSession, folder: str) -> DataFrame:
    return build_dimension(table(spark, folder, "events"), USER_TYPE)


@registered("with {} select * from user_versions".format(USER_VERSIONS))
def dim_scd2_merged(spark: SparkSession, folder: str) -> DataFrame:
    """Three batches of events, the middle of the time first and the newest before the oldest, merged one after the other."""
    path = new_folder(spark, "merged")
    third = F.floor(F.dayofmonth("ts") / 11)
    events = table(spark, folder, "events")
    for part in (1, 2, 0):
        merge_dimension(events.filter(third == part), USER_TYPE, path, 8)
    return read_dimension(spark, path)


@registered("with {} select * from user_versions".format(USER_VERSIONS))
def dim_scd2_hot_keys(spark: SparkSession, folder: str) -> DataFrame:
    return build_dimension(table(spark, folder, "events"), USER_TYPE, MANY_SLOTS)


@registered(
    "select event_type, min(ts) as valid_from, sha256(event_type) as hash_data, cast(null as timestamp) as valid_to, "
    "true as is_current, sha256(concat_ws('||', event_type, sha256(event_type))) as type_sk from events group by 1"
)
def dim_scd2_key_only(spark: SparkSession, folder: str) -> DataFrame:
    only = Dimension(
        "dim_type", ("event_type",), "type_sk", columns("event_type", "ts"), scd_type=2, valid_from="ts"
    )
    return build_dimension(table(spark, folder, "events"), only)


CUSTOMER_STATE = Dimension(
    "dim_customer_state",
    ("o_custkey",),
    "state_sk",
    columns("o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "o_orderkey"),
    scd_type=2,
    valid_from="o_orderdate",
    tracked=("o_orderstatus", "o_orderpriority"),
)


@registered(
    """
    with hashed as (select o_custkey, o_orderdate as valid_from, o_orderstatus, o_orderpriority, o_orderkey,
        sha256(concat_ws('||', o_orderstatus, o_orderpriority)) as hash_data from orders),
    firsts as ({})
    {}
    """.format(
        _first("hashed", "o_custkey, hash_data", "valid_from, o_orderstatus, o_orderpriority, o_orderkey",
               "* exclude (rank_in_key)"),
        _ENDED.format(key="o_custkey", sk="state_sk", source="firsts"),
    )
)
def dim_scd2_attributes(spark: SparkSession, folder: str) -> DataFrame:
    return build_dimension(table(spark, folder, "orders"), CUSTOMER_STATE)


CHANGES = """
    with hashed as (select user_id, event_type, ts as valid_from, sha256(event_type) as hash_data from events),
    compared as (select *, lag(hash_data) over (partition by user_id order by valid_from, hash_data) as before
        from hashed),
    changed as (select * exclude (before) from compared where before is null or before <> hash_data)
    {}
""".format(_ENDED.format(key="user_id", sk="user_sk", source="changed"))


def _user_changes(spark: SparkSession, folder: str, slots: int | None = None) -> DataFrame:
    kept = {name: getattr(USER_TYPE, name) for name in USER_TYPE.__dataclass_fields__}
    return build_dimension(table(spark, folder, "events"), Dimension(**{**kept, "detect": "changes"}), slots)


@registered(CHANGES)
def dim_scd2_changes(spark: SparkSession, folder: str) -> DataFrame:
    return _user_changes(spark, folder)


@registered(CHANGES)
def dim_scd2_changes_hot_keys(spark: SparkSession, folder: str) -> DataFrame:
    return _user_changes(spark, folder, MANY_SLOTS)


# --- facts -----------------------------------------------------------------------------------------------------------


@registered(
    "select o_orderkey, o_custkey, o_totalprice, sha256(cast(c_custkey as string)) as customer_key from orders "
    "left join customer on o_custkey = c_custkey and c_mktsegment <> 'MACHINERY'"
)
def fact_equi(spark: SparkSession, folder: str) -> DataFrame:
    members = table(spark, folder, "customer").filter("c_mktsegment <> 'MACHINERY'")
    customer = Dimension(
        "dim_customer", ("c_custkey",), "customer_key", columns("c_custkey", "c_name", "c_mktsegment")
    )
    fact = Fact(
        "fact_order",
        columns("o_orderkey", "o_custkey", "o_totalprice"),
        (DimensionJoin("dim_customer", ("o_custkey",), ("c_custkey",)),),
    )
    tables = {"dim_customer": stage(build_dimension(members, customer), "dim")}
    return build_fact(table(spark, folder, "orders"), fact, tables, {"dim_customer": customer})


@registered(
    "select l_orderkey, l_linenumber, l_quantity, l_partkey, l_suppkey, "
    "sha256(concat_ws('||', cast(l_partkey as string), cast(l_suppkey as string))) as offer_key from lineitem"
)
def fact_multi_key(spark: SparkSession, folder: str) -> DataFrame:
    frame = table(spark, folder, "lineitem")
    offer = Dimension("dim_offer", ("l_partkey", "l_suppkey"), "offer_key", columns("l_partkey", "l_suppkey"))
    fact = Fact(
        "fact_line",
        columns("l_orderkey", "l_linenumber", "l_quantity", "l_partkey", "l_suppkey"),
        (DimensionJoin("dim_offer", ("l_partkey", "l_suppkey"), ("l_partkey", "l_suppkey")),),
    )
    tables = {"dim_offer": stage(build_dimension(frame, offer), "dim")}
    return build_fact(frame, fact, tables, {"dim_offer": offer})


@registered(
    "with {} select l_orderkey, l_linenumber, l_partkey, c_nationkey, s_nationkey, "
    "sha256(cast(c_nationkey as string)) as buyer_key, sha256(cast(s_nationkey as string)) as seller_key "
    "from trades".format(TRADES)
)
def fact_roles(spark: SparkSession, folder: str) -> DataFrame:
    frame = trades(spark, folder)
    fact = Fact(
        "fact_trade",
        columns("l_orderkey", "l_linenumber", "l_partkey", "c_nationkey", "s_nationkey"),
        (
            DimensionJoin("dim_nation", ("c_nationkey",), ("nation_id",), "buyer_key"),
            DimensionJoin("dim_nation", ("s_nationkey",), ("nation_id",), "seller_key"),
        ),
    )
    tables = {"dim_nation": stage(build_dimension(frame, NATIONS), "dim")}
    return build_fact(frame, fact, tables, {"dim_nation": NATIONS})


ASOF = """
    with {} select event_id, e.user_id, ts, value, user_sk from events e left join user_versions v
    on e.user_id = v.user_id and e.ts >= v.valid_from and (v.valid_to is null or e.ts <= v.valid_to)
""".format(USER_VERSIONS)


def _event_facts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    events = table(spark, folder, "events")
    return events.select("event_id", "user_id", "ts", "value"), stage(build_dimension(events, USER_TYPE), "dim")


@registered(ASOF)
def fact_asof(spark: SparkSession, folder: str) -> DataFrame:
    facts, users = _event_facts(spark, folder)
    fact = Fact(
        "fact_event",
        columns("event_id", "user_id", "ts", "value"),
        (DimensionJoin("dim_user", ("user_id",), ("user_id",), effective_at="ts"),),
    )
    return build_fact(facts, fact, {"dim_user": users}, {"dim_user": USER_TYPE})


@registered(ASOF)
def fact_asof_direct(spark: SparkSession, folder: str) -> DataFrame:
    facts, users = _event_facts(spark, folder)
    return lookup_between(facts, users, [("user_id", "user_id")], "ts", "user_sk", "user_sk")


@registered(ASOF)
def fact_asof_sorted(spark: SparkSession, folder: str) -> DataFrame:
    facts, users = _event_facts(spark, folder)
    return lookup_sorted(facts, users, [("user_id", "user_id")], "ts", "user_sk", "user_sk")


@registered(ASOF)
def fact_asof_hot_keys(spark: SparkSession, folder: str) -> DataFrame:
    facts, users = _event_facts(spark, folder)
    return lookup_sorted(facts, users, [("user_id", "user_id")], "ts", "user_sk", "user_sk", MANY_SLOTS)


TIMED = """
    hashed as (select user_id, event_type, ts as valid_from, sha256(concat_ws('||', event_type, strftime(ts, '%Y-%m-%d')))
        as hash_data from (select user_id, event_type, date_trunc('day', ts) as ts from events)),
    firsts as (select distinct * from hashed),
    user_days as ({})
""".format(_ENDED.format(key="user_id", sk="user_sk", source="firsts"))


def _user_days(spark: SparkSession, folder: str) -> DataFrame:
    """The time is tracked as well: every day with events of a type is a version."""
    days = table(spark, folder, "events").select("user_id", "event_type", F.to_date("ts").alias("ts"))
    kept = {name: getattr(USER_TYPE, name) for name in USER_TYPE.__dataclass_fields__}
    return build_dimension(days, Dimension(**{**kept, "tracked": ("event_type", "ts")}))


@registered(
    "with {} select * exclude (valid_from, valid_to), cast(valid_from as date) as valid_from, valid_to from user_days".format(TIMED)
)
def dim_scd2_time_tracked(spark: SparkSession, folder: str) -> DataFrame:
    return _user_days(spark, folder)


@registered(
    """
    with hashed as (select user_id // 20 as grp, user_id, event_type, ts as valid_from, sha256(event_type) as hash_data from events),
    firsts as (select grp, user_id, event_type, min(valid_from) as valid_from, hash_data from hashed group by all),
    followed as (select *, lead(valid_from) over (partition by grp, user_id order by valid_from, hash_data) as after from firsts),
    known as (select *, after - interval 1 microsecond as valid_to,
        sha256(concat_ws('||', grp, user_id, hash_data)) as user_sk from followed),
    asked as (select c_custkey, c_custkey // 200 as grp, timestamp '2024-01-01' + to_hours(c_custkey * 7 % 720) as moment from customer)
    select c_custkey, asked.grp as grp, moment, user_sk from asked left join known
    on asked.grp = known.grp and moment >= valid_from and (valid_to is null or moment <= valid_to)
    """
)
def fact_asof_part_key(spark: SparkSession, folder: str) -> DataFrame:
    """A join on part of the business key finds every member valid at the time: groups of 20 users, asked by all customers."""
    events = table(spark, folder, "events").select(F.expr("user_id div 20").alias("grp"), "user_id", "event_type", "ts")
    by_group = Dimension(
        "dim_user", ("grp", "user_id"), "user_sk", columns("grp", "user_id", "event_type", "ts"), scd_type=2, valid_from="ts",
        tracked=("event_type",),
    )
    facts = table(spark, folder, "customer").select(
        "c_custkey",
        F.expr("c_custkey div 200").alias("grp"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(c_custkey * 7 % 720 as int))").alias("moment"),
    )
    join = DimensionJoin("dim_user", ("grp",), ("grp",), effective_at="moment", fan_out=True)
    tables = {"dim_user": stage(build_dimension(events, by_group), "dim")}
    return build_fact(facts, Fact("fact", columns("c_custkey", "grp", "moment"), (join,)), tables, {"dim_user": by_group})


@registered(
    "with {} select event_id, e.user_id, user_sk as version_key from events e left join user_versions v "
    "on e.user_id = v.user_id".format(USER_VERSIONS)
)
def fact_scd2_fanout(spark: SparkSession, folder: str) -> DataFrame:
    facts, users = _event_facts(spark, folder)
    fact = Fact(
        "fact_event",
        columns("event_id", "user_id"),
        (DimensionJoin("dim_user", ("user_id",), ("user_id",), "version_key", fan_out=True),),
    )
    return build_fact(facts, fact, {"dim_user": users}, {"dim_user": USER_TYPE})


STAR_USER = Dimension(
    "dim_user", ("user_id",), "user_sk", columns("user_id", "kind", "ts"),
    scd_type=2, valid_from="ts", tracked=("kind",),
)
STAR_KIND = Dimension("dim_kind", ("kind",), "kind_key", columns("kind"))
STAR_DATE = Dimension(
    "dim_date",
    ("date_key",),
    "date_sk",
    (
        OutputColumn("date_key", expression="date_format(ts, 'yyyyMMdd')"),
        OutputColumn("event_date", expression="to_date(ts)"),
    ),
)
STAR_FACT = Fact(
    "fact_event",
    (*columns("event_id", "user_id", "kind", "ts", "value"),
     OutputColumn("date_key", expression="date_format(ts, 'yyyyMMdd')")),
    (
        DimensionJoin("dim_user", ("user_id",), ("user_id",), effective_at="ts"),
        DimensionJoin("dim_kind", ("kind",), ("kind",)),
        DimensionJoin("dim_date", ("date_key",), ("date_key",)),
    ),
)

STAR_VERSIONS = """
    user_first as (select user_id, kind, min(ts) as valid_from, sha256(kind) as hash_data
        from valid group by user_id, kind),
    user_versions as ({})
""".format(_ENDED.format(key="user_id", sk="user_sk", source="user_first"))

STAR = """
    with {}, {}
    select event_id, e.user_id, e.kind, ts, value, strftime(ts, '%Y%m%d') as date_key, user_sk,
        sha256(e.kind) as kind_key, sha256(strftime(ts, '%Y%m%d')) as date_sk
    from valid e left join user_versions v
    on e.user_id = v.user_id and e.ts >= v.valid_from and (v.valid_to is null or e.ts <= v.valid_to)
""".format(CHECKED, STAR_VERSIONS)


@registered(STAR)
def star_schema(spark: SparkSession, folder: str) -> DataFrame:
    """Flagship: dirty events, quality rules, three dimensions and a fact with point-in-time keys."""
    rows = stage(valid_events(spark, folder), "valid")
    configured = {item.name: item for item in (STAR_USER, STAR_KIND, STAR_DATE)}
    tables = {name: stage(build_dimension(rows, item), "dim") for name, item in configured.items()}
    return build_fact(rows, STAR_FACT, tables, configured)


# --- sources and sinks -----------------------------------------------------------------------------------------------


@registered("select * from orders order by o_orderkey offset 1000 limit 500")
def page_slice(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").orderBy("o_orderkey").offset(1000).limit(500)


@registered(
    "select * exclude (n) from (select *, row_number() over (order by o_orderkey) - 1 as n from orders) "
    "where n >= (select count(*) * 9 // 10 from orders) and n < (select count(*) * 9 // 10 from orders) + 500"
)
def page_slice_deep(spark: SparkSession, folder: str) -> DataFrame:
    """A page nine tenths into the table: only the slots it touches are read and numbered."""
    ranking = rank(table(spark, folder, "orders"), ["o_orderkey"])
    return ranking.page(ranking.size * 9 // 10, 500)


@registered("select l_orderkey, l_linenumber, l_shipdate, row_number() over (order by l_shipdate, l_orderkey, l_linenumber) - 1 as place from lineitem")
def rows_numbered(spark: SparkSession, folder: str) -> DataFrame:
    """Every line's place in the order of shipping."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return rank(lines, ["l_shipdate", "l_orderkey", "l_linenumber"]).numbered("place")


@registered(
    "select * from events where ts between timestamp '2024-01-05 00:00:00' and timestamp '2024-01-11 23:59:59'"
)
def range_scan(spark: SparkSession, folder: str) -> DataFrame:
    return between(table(spark, folder, "events"), "ts", "2024-01-05T00:00:00", "2024-01-11T23:59:59")


@registered("select *, (row_number() over (order by o_orderkey) - 1) // 500 as page from orders")
def paged_source(spark: SparkSession, folder: str) -> DataFrame:
    """All rows in pages of 500 by their key."""
    ranking = rank(table(spark, folder, "orders"), ["o_orderkey"])
    return ranking.pages(500, max(1, ranking.size))[0]


@registered(
    """
    with span as (select min(o_orderkey) as low, max(o_orderkey) as high from orders),
    inside as (select o_orderkey, row_number() over (order by o_orderkey) - 1 as n from orders, span
               where o_orderkey between low + (high - low) // 10 and high - (high - low) // 10)
    select 'truncated' as status, o_orderkey, n // 500 as page from inside where n < (select count(*) * 3 // 4 from inside)
    """
)
def paged_range_capped(spark: SparkSession, folder: str) -> DataFrame:
    """The middle of the key span, cut at three quarters of its rows: the range comes before rows are counted."""
    orders = table(spark, folder, "orders").select("o_orderkey")
    low, high = orders.agg(F.coalesce(F.min("o_orderkey"), F.lit(0)), F.coalesce(F.max("o_orderkey"), F.lit(0))).first()
    ranking = rank(between(orders, "o_orderkey", low + (high - low) // 10, high - (high - low) // 10), ["o_orderkey"])
    rows, truncated = ranking.pages(500, max(1, ranking.size * 3 // 4))
    return rows.select(F.lit("truncated" if truncated else "success").alias("status"), "o_orderkey", "page")


@registered("select cast(event_id as string) as event_id, event_type, cast(value as string) as value, props, "
            "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as ts, cast(user_id as string) as user_id from events")
def jsonl_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "jsonl")
    write_jsonl(table(spark, folder, "events"), path)
    return read_bronze(spark, path).drop("_source_file", "_raw_loaded_at")


@registered("select * from customer")
def file_source_csv(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer")
    path = new_folder(spark, "csv")
    customers.write.option("header", "true").csv(path)
    declared = ", ".join("{} {}".format(*item) for item in customers.dtypes)
    source = {"type": "file", "location": path, "format": "csv", "schema_mode": "declared", "schema": declared}
    return read_files(spark, _config(spark, "csv", source).source)


LANDED_FIRST = "o_orderdate < timestamp '1997-06-30 00:00:00' and (o_orderdate < timestamp '1997-06-01 00:00:00' or o_orderkey % 2 = 1)"


@registered(
    "with marked as (select *, case when {0} then 1 else 0 end as early from orders), "
    "seen as (select max(o_orderdate) as last from marked where early = 1) "
    "select cast(o_orderkey as string) as o_orderkey, early = 0 as second from marked, seen where early = 1 or o_orderdate >= last "
    "union all select cast(o_orderkey as string), true from marked, seen where early = 1 and o_orderdate = last".format(LANDED_FIRST)
)
def table_source_resumes(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs over a table that grows in between, also at the greatest value of the first: rows and repeated rows that came
    late with that value land in the second run, those landed before don't land again."""
    orders, view = table(spark, folder, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz")), "growing_orders"
    config = _config(spark, "resumed", {"type": "table", "table": view, "incremental_column": "o_orderdate"})
    early = orders.filter(LANDED_FIRST.replace("timestamp '", "timestamp_ntz '"))
    early.createOrReplaceTempView(view)
    first = ingest(spark, config, "20240101T000000Z")
    again = early.join(early.agg(F.max("o_orderdate").alias("o_orderdate")), "o_orderdate").select(orders.columns)
    orders.unionByName(again).createOrReplaceTempView(view)
    second = ingest(spark, config, "20240102T000000Z")
    parts = [read_bronze(spark, run.path).select("o_orderkey", F.lit(late).alias("second")) for run, late in ((first, False), (second, True))]
    return parts[0].unionByName(parts[1])


@registered("select * from orders where o_orderdate > timestamp '1997-06-30 00:00:00'")
def table_source_incremental(spark: SparkSession, folder: str) -> DataFrame:
    table(spark, folder, "orders").createOrReplaceTempView("incremental_orders")
    source = {
        "type": "table",
        "table": "incremental_orders",
        "incremental_column": "o_orderdate",
        "after": "1997-06-30 00:00:00",
    }
    return read_source(spark, _config(spark, "table", source).source)


@registered(
    "with named as (select *, strftime(ts, '0%Y%m%d') as batch from events) select batch, event_id, user_id, value "
    "from named where batch = (select max(batch) from named)"
)
def latest_batch_rows(spark: SparkSession, folder: str) -> DataFrame:
    base = new_folder(spark, "batches")
    events = table(spark, folder, "events")
    named = events.withColumn("ingestion_timestamp", F.date_format("ts", "'0'yyyyMMdd"))
    named.write.partitionBy("ingestion_timestamp").parquet(base)
    batch = latest_batch(spark, base)
    rows = spark.read.parquet("{}/ingestion_timestamp={}".format(base, batch))
    return rows.select(F.lit(batch).alias("batch"), "event_id", "user_id", "value")


# --- layers ----------------------------------------------------------------------------------------------------------


def _config(spark: SparkSession, name: str, source: dict, root: str | None = None, **tech: object) -> PipelineConfig:
    """The star of this module as a configuration: the same rules, dimensions and fact."""
    rules = [
        {"name": "event_id", "type": "bigint", "check_nullability": True, "is_critical": True},
        {"name": "user_id", "type": "bigint"},
        {"name": "ts", "type": "timestamp_ntz", "check_nullability": True, "is_critical": True},
        {
            "name": "value",
            "type": "double",
            "check_nullability": True,
            "is_critical": True,
            "check_range": {"min": 0, "max": 1000},
            "fill_nulls": 0.0,
        },
        {"name": "visitor", "type": "integer", "check_range": {"min": 1, "max": 140}, "fill_nulls": -1},
        {"name": "kind", "accepted_values": ["click", "error", "purchase", "signup", "view"]},
    ]

    def listed(found: tuple[OutputColumn, ...]) -> list[dict]:
        return [
            {"name": item.name, **({"expression": item.expression} if item.expression else {})} for item in found
        ]

    dimensions = [
        {
            "name": item.name,
            "business_key": list(item.business_key),
            "surrogate_key": item.surrogate_key,
            "columns": listed(item.columns),
            "scd": {"type": 2, "valid_from": item.valid_from, "tracked_columns": list(item.tracked)}
            if item.scd_type == 2
            else {"type": 1},
        }
        for item in (STAR_USER, STAR_KIND, STAR_DATE)
    ]
    joins = [
        {
            "dimension": join.dimension,
            "source_key": list(join.source_key),
            "target_key": list(join.target_key),
            **({"effective_at": join.effective_at} if join.effective_at else {}),
        }
        for join in STAR_FACT.joins
    ]
    document = {
        "pipeline": {"name": name},
        "source": source,
        "bronze": {"bucket": "lake", "prefix": name + "/bronze"},
        "silver": {
            "raw": {"bucket": "lake", "prefix": name + "/silver/raw"},
            "tech": {"bucket": "lake", "prefix": name + "/silver/tech", "columns": rules, **tech},
            "func": {
                "bucket": "lake",
                "prefix": name + "/silver/func",
                "columns": [{"name": column} for column in ("event_id", "user_id", "ts", "value", "visitor", "kind")],
                "enrichments": [
                    {
                        "type": "aggregate",
                        "group_by": ["kind"],
                        "metrics": [{"name": "kind_events", "function": "count"}],
                    }
                ],
                "deduplication": {"keys": ["event_id"], "order_by": ["ts"]},
            },
        },
        "gold": {
            "bucket": "lake",
            "prefix": name + "/gold",
            "dimensions": dimensions,
            "facts": [{"name": "fact_event", "columns": listed(STAR_FACT.columns), "joins": joins}],
        },
    }
    return parse_config(document, root or new_folder(spark, name) + "/")


def _landed(spark: SparkSession, folder: str, name: str, **options: object) -> PipelineConfig:
    """Dirty events as a drop folder, ingested to Bronze and moved to RAW."""
    drop = new_folder(spark, "drop")
    dirty_events(spark, folder).write.parquet(drop)
    config = _config(spark, name, {"type": "file", "location": drop, "format": "parquet"})
    if "output_partitions" in options:
        config = replace(config, func_partitions=options["output_partitions"], gold_partitions=options["output_partitions"])
    ingest(spark, config, "20240201T000000Z")
    bronze_to_raw(spark, config)
    return config


@registered(
    "with {} select event_id, user_id, ts, value, visitor, kind, landed_reason as rejection_reason, "
    "landed_fields as rejected_fields, rejection_stage from checked where rejection_reason <> ''".format(CHECKED)
)
def layers_reject(spark: SparkSession, folder: str) -> DataFrame:
    """Columns inferred from JSON come in name order, and so do the reasons."""
    config = _landed(spark, folder, "layers_reject")
    result = raw_to_tech(spark, config)
    return spark.read.parquet(result.reject_path).drop("_source_file", "_raw_loaded_at", "rejected_at")


@registered(
    """
    with {}, counts as (select count(*) as n, count(distinct kind) as kinds from valid)
    select 'func files' as what, 1 as n from counts union all select 'gold files', 1 from counts
    union all select 'rows with a source file and a load time', (select count(*) from events) from counts
    union all select 'empty batch: raw folder', 0 from counts union all select 'empty batch: status no_data', 1 from counts
    """.format(CHECKED)
)
def layers_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers of output files, load columns, and an empty batch that writes nothing."""
    config = _landed(spark, folder, "layers_outputs", output_partitions=1)
    raw_to_tech(spark, config)
    func = spark.read.parquet(tech_to_func(spark, config).path)
    gold = spark.read.parquet(func_to_gold(spark, config)[-1].path)
    raw = spark.read.parquet(batch_path(config.layout.raw, "20240201T000000Z"))
    loaded = raw.filter("_source_file like '%ingestion_timestamp=20240201T000000Z/%' and _raw_loaded_at is not null").count()
    empty = _config(spark, "empty", {"type": "file", "location": config.source.options["location"], "format": "parquet",
                                     "filter": {"column": "event_id", "start": "-2", "end": "-1"}})
    ingest(spark, empty, "20240301T000000Z")
    status = bronze_to_raw(spark, empty, "20240301T000000Z").status
    found = [
        ("func files", len(func.inputFiles())), ("gold files", len(gold.inputFiles())),
        ("rows with a source file and a load time", loaded),
        ("empty batch: raw folder", int(has_parquet(spark, empty.layout.raw))), ("empty batch: status no_data", int(status == "no_data")),
    ]
    return spark.createDataFrame(found, "what string, n int")


@registered("with {} select event_id, user_id, ts, value, visitor, kind from valid".format(CHECKED))
def pipeline_all(spark: SparkSession, folder: str) -> DataFrame:
    """The whole chain over event batches: one is landed by a run that goes no further, another by the run that ends."""
    drop = new_folder(spark, "drop")
    config = _config(spark, "pipeline_all", {"type": "events", "location": drop, "format": "json"})
    dirty = dirty_events(spark, folder)
    write_jsonl(dirty.filter("pmod(xxhash64(event_id), 3) = 0"), drop + "/first")
    config = replace(config, source=replace(config.source, options={**config.source.options, "location": drop + "/*"}))
    ingest(spark, config)
    write_jsonl(dirty.filter("pmod(xxhash64(event_id), 3) <> 0"), drop + "/second")
    run_all(spark, config, with_catalog=False)
    func = read_func(spark, config)
    fact = read_current(spark, config.layout.gold_table("fact_event"))
    return func.join(fact.select("event_id").distinct(), "event_id", "left_semi").select("event_id", "user_id", "ts", "value", "visitor", "kind")


@registered("select event_type as kind, count(*) as n, min(ts) as first_at, max(ts) as last_at from events group by all")
def replaced_versions(spark: SparkSession, folder: str) -> DataFrame:
    """A dataset replaced twice, the second time from its own rows and while a reader still holds the version before."""
    path = new_folder(spark, "versioned")
    events = table(spark, folder, "events").select(F.col("event_type").alias("kind"), "ts")
    replace_dataset(events.filter("kind in ('click', 'view')"), path)
    held = read_current(spark, path)
    replace_dataset(held.unionByName(events.filter("kind not in ('click', 'view')")), path)
    rows = read_current(spark, path)
    return rows.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_at"), F.max("ts").alias("last_at"))


def _malformed(spark: SparkSession, folder: str, mode: str) -> DataFrame:
    """Every eleventh event's line is broken; landed as an event stream and moved to RAW."""
    drop = new_folder(spark, "drop")
    events = table(spark, folder, "events").select("event_id", "event_type", F.to_json(F.struct("event_id", "event_type")).alias("line"))
    broken = F.when(F.col("event_id") % 11 == 0, F.concat(F.lit("{broken "), F.col("line"))).otherwise(F.col("line"))
    events.select(broken).write.text(drop)
    config = _config(spark, "malformed", {"type": "events", "location": drop, "format": "json"})
    declared = ("event_id", "event_type") if mode == "declared" else None
    config = replace(config, raw_columns=declared)
    for batch in ingest(spark, config).batches:
        bronze_to_raw(spark, config, batch)
    rows = spark.read.parquet(config.layout.raw)
    return rows.select(F.lit(mode).alias("mode"), "event_id", "event_type", F.col("_corrupt_record").alias("broken"))


@registered(
    """
    with modes as (select * from (values ('infer'), ('declared')) as m(mode)),
    lines as (select *, event_id % 11 = 0 as bad, '{broken {"event_id":' || event_id || ',"event_type":"' || event_type || '"}' as line from events)
    select mode, case when not bad then cast(event_id as string) end as event_id, case when not bad then event_type end as event_type,
        case when bad then line end as broken from modes, lines
    """
)
def malformed_lines(spark: SparkSession, folder: str) -> DataFrame:
    return _malformed(spark, folder, "infer").unionByName(_malformed(spark, folder, "declared"))


@registered(
    "with {}, metrics as (select kind, count(*) as kind_events from valid group by 1) "
    "select * from valid join metrics using (kind)".format(CHECKED)
)
def layers_func(spark: SparkSession, folder: str) -> DataFrame:
    config = _landed(spark, folder, "layers_func")
    raw_to_tech(spark, config)
    return spark.read.parquet(tech_to_func(spark, config).path)


def _full_run(spark: SparkSession, folder: str, name: str) -> tuple[PipelineConfig, list[StepResult]]:
    config = _landed(spark, folder, name)
    raw_to_tech(spark, config)
    tech_to_func(spark, config)
    return config, func_to_gold(spark, config)


@registered(STAR)
def layers_fact(spark: SparkSession, folder: str) -> DataFrame:
    _, results = _full_run(spark, folder, "layers_fact")
    return spark.read.parquet(results[-1].path)


@registered(
    """
    with {}, {}, counts as (select count(*) filter (rejection_reason = '') as ok,
        count(*) filter (rejection_reason <> '') as bad from checked),
    gold as (select 'dim_user' as dataset_name, count(*) as n from user_versions
        union all select 'dim_kind', count(distinct kind) from valid
        union all select 'dim_date', count(distinct cast(ts as date)) from valid
        union all select 'fact_event', count(*) from valid),
    facts as (select * from (values ('bronze'), ('raw'), ('tech'), ('func')) as v(layer)),
    states as (select * from (values ('started'), ('success')) as v(status))
    select layer, '' as dataset_name, status, case when status = 'started' then 0 when layer in ('tech', 'func') then ok else ok + bad end
        as row_count, case when layer = 'tech' and status = 'success' then bad else 0 end as rejected_count from facts, states, counts
    union all select 'gold', dataset_name, status, case when status = 'started' then 0 else n end, 0 from gold, states
    """.format(CHECKED, STAR_VERSIONS)
)
def monitoring_events(spark: SparkSession, folder: str) -> DataFrame:
    config, _ = _full_run(spark, folder, "monitoring_events")
    root = config.layout.monitoring
    silver = spark.read.parquet(*["{}/{}".format(root, layer) for layer in ("bronze", "raw", "tech", "func")])
    gold = spark.read.parquet(*["{}/gold/dimensions/{}".format(root, item.name) for item in config.dimensions], root + "/gold/facts/fact_event")
    names = ["layer", "dataset_name", "status", "row_count"]
    return silver.select(*names, "rejected_count").unionByName(gold.select(*names, F.lit(0).cast("long").alias("rejected_count")))


@registered(
    """
    with {0}, {1}, counts as (
        select 'silver.raw_mirrored' as table_name, count(*) as n from events
        union all select 'silver.tech_mirrored', count(*) from valid
        union all select 'silver.reject_mirrored', count(*) from checked where rejection_reason <> ''
        union all select 'silver.func_mirrored', count(*) from valid
        union all select 'gold.dim_user', count(*) from user_versions
        union all select 'gold.dim_kind', count(distinct kind) from valid
        union all select 'gold.dim_date', count(distinct cast(ts as date)) from valid
        union all select 'gold.fact_event', count(*) from valid
        union all select 'monitoring.' || name || '_events', 2 from (values ('bronze'), ('raw'), ('tech'), ('func'),
            ('gold_dim_user'), ('gold_dim_kind'), ('gold_dim_date'), ('gold_fact_event')) as v(name))
    select * from counts
    """.format(CHECKED, STAR_VERSIONS)
)
def mirror_tables(spark: SparkSession, folder: str) -> DataFrame:
    config, _ = _full_run(spark, folder, "mirrored")
    names = mirror(spark, config)
    counts = [
        spark.table(name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name in names
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result


@registered(
    "with {} select 'tech' as part, event_id, user_id, ts, value, visitor, kind, null as rejected_fields from valid "
    "union all select 'reject', event_id, user_id, ts, value, visitor, kind, rejected_fields from checked "
    "where rejection_reason <> ''".format(CHECKED)
)
def stream_quality(spark: SparkSession, folder: str) -> DataFrame:
    bronze, tech, reject, checkpoint = (new_folder(spark, label) for label in ("bronze", "tech", "reject", "checkpoint"))
    dirty = dirty_events(spark, folder)
    write_jsonl(dirty, bronze)
    stream = text_stream(spark, bronze, dirty.columns)
    start_quality_stream(stream, RULES, tech, reject, checkpoint).awaitTermination()
    names = ["event_id", "user_id", "ts", "value", "visitor", "kind"]
    valid = spark.read.parquet(tech).select(F.lit("tech").alias("part"), *names, F.lit(None).cast("string").alias("rejected_fields"))
    return valid.unionByName(spark.read.parquet(reject).select(F.lit("reject").alias("part"), *names, "rejected_fields"))


@registered("select cast(event_id as string) as event_id, cast(user_id as string) as user_id, event_type from events")
def event_source(spark: SparkSession, folder: str) -> DataFrame:
    drop = new_folder(spark, "drop")
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    events.repartition(3).write.json(drop)
    config = _config(spark, "event_source", {"type": "events", "location": drop, "format": "json", "max_files_per_trigger": 1})
    for batch in ingest(spark, config).batches:
        bronze_to_raw(spark, config, batch)
    return spark.read.parquet(config.layout.raw).select("event_id", "user_id", "event_type")
