"""Independent DuckDB SQL for every registered query.

Written from the semantics, not from the Spark code: the nested envelopes
are replaced by the joins they encode (``orders ⟕ lineitem``), dedup by
``QUALIFY row_number()``, upserts by ``NOT EXISTS`` + ``UNION ALL``.

DuckDB differences handled here: ``epoch_ms`` rounds, so epoch millis are
``epoch_us(ts) // 1000``; ``upper('ß')`` is ``ẞ`` (Spark gives ``SS``);
regex groups are ``\\1`` and need the ``'g'`` flag; the whole-second epoch
conversion is ``make_timestamp(trunc(ms / 1000)::BIGINT * 1000000)``.
"""

from __future__ import annotations

# The accented capitals folded by capitalize and their
# replacements (same as the Spark side).
_FOLD = "'ÁÉÍÓÚÇÕÂÃÔÊ', 'AEIOUCOAAOE'"


def _ms(ts: str) -> str:
    return f"(epoch_us({ts}) // 1000)"


def _sec_ts(ms: str) -> str:
    return f"make_timestamp(CAST(trunc({ms} / 1000) AS BIGINT) * 1000000)"


def _sec_text(ms: str) -> str:
    return f"strftime({_sec_ts(ms)}, '%Y-%m-%d %H:%M:%S')"


def _cap(expr: str) -> str:
    return f"translate(upper(replace({expr}, 'ß', 'SS')), {_FOLD})"


EVENT_COLS = "event_id, ts, user_id, event_type, value, props"
ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"

RAW_ORDERS_FLAT = f"""
select {_ms('o.o_orderdate')} + 172800000 as _emitted_at,
       cast(o.o_orderkey as varchar) as _raw_data_orderId,
       o.o_custkey as _raw_data_custId,
       o.o_orderstatus as _raw_data_status,
       o.o_orderpriority as _raw_data_priority,
       o.o_totalprice as _raw_data_totalPrice,
       cast({_ms('o.o_orderdate')} as varchar) as _raw_data_createdAt,
       cast({_ms('o.o_orderdate')} + 86400000 as varchar) as _raw_data_updatedAt,
       o.o_orderstatus = 'O' as _raw_data_active,
       cast(l.l_linenumber as varchar) as _raw_data_lines_lineNumber,
       l.l_partkey as _raw_data_lines_partKey,
       l.l_suppkey as _raw_data_lines_suppKey,
       l.l_quantity as _raw_data_lines_quantity,
       l.l_extendedprice as _raw_data_lines_price,
       l.l_discount as _raw_data_lines_discount,
       l.l_tax as _raw_data_lines_tax,
       l.l_returnflag as _raw_data_lines_returnFlag,
       case when l.l_linestatus <> 'O' then {_ms('l.l_shipdate')} end as _raw_data_lines_shippedAt_long,
       case when l.l_linestatus = 'O' then strftime(l.l_shipdate, '%Y-%m-%dT%H:%M:%S') end
           as _raw_data_lines_shippedAt_string
from orders o left join lineitem l on l.l_orderkey = o.o_orderkey
"""


def _charges(flat: str) -> str:
    """dedup → mapping → SQL → capitalize → regex over flattened envelope rows."""
    return f"""
with r as ({flat}),
d as (
  select * from r
  qualify row_number() over (
    partition by _raw_data_orderId, _raw_data_lines_lineNumber
    order by _emitted_at desc nulls last, _raw_data_lines_shippedAt_long desc nulls last,
             _raw_data_lines_partKey desc nulls last, _raw_data_lines_suppKey desc nulls last,
             _raw_data_lines_price desc nulls last, _raw_data_lines_quantity desc nulls last,
             _raw_data_lines_discount desc nulls last, _raw_data_lines_tax desc nulls last,
             _raw_data_lines_returnFlag desc nulls last, _raw_data_lines_shippedAt_string desc nulls last) = 1
)
select try_cast(_raw_data_orderId as bigint) as order_no, try_cast(_raw_data_lines_lineNumber as integer) as line_no,
       _raw_data_custId as customer_no, _raw_data_lines_suppKey as supplier_no,
       regexp_replace({_cap('_raw_data_priority')}, '^(\\d)-(.*)$', '\\2 (\\1)', 'g') as urgency,
       _raw_data_lines_quantity as quantity,
       _raw_data_lines_price * (1 - _raw_data_lines_discount) as net_price,
       _raw_data_lines_price * (1 - _raw_data_lines_discount) * (1 + _raw_data_lines_tax) as charged,
       case when _raw_data_lines_discount >= 0.05 then 'REDUCED' else 'FULL' end as price_class,
       {_sec_ts('try_cast(_raw_data_createdAt as bigint)')} as ordered_at,
       cast(floor((_raw_data_lines_shippedAt_long - try_cast(_raw_data_createdAt as bigint)) / 86400000) as bigint) as days_to_ship,
       _raw_data_lines_tax as tax
from d
"""


def _charges_published(pipe: str) -> str:
    """Conformance to the published table: tax dropped, texts cut, whole numbers."""
    return f"""
select order_no, line_no, customer_no, supplier_no, substr(urgency, 1, 12) as urgency, cast(quantity as integer) as quantity,
       net_price, charged, substr(price_class, 1, 2) as price_class, ordered_at, cast(days_to_ship as integer) as days_to_ship
from ({pipe})
"""


def _events_pipe(where: str) -> str:
    """struct-flatten recipe over the events envelope, one drop."""
    return f"""
with r as (
  select user_id, event_id, event_type, value, {_ms('ts')} as ms from events where {where}
),
d as (
  select * from r
  qualify row_number() over (partition by cast(user_id as varchar)
                             order by ms desc nulls last, event_id desc nulls last) = 1
)
select user_id, event_id,
       regexp_replace({_cap('event_type')}, '^(ERROR|SIGNUP)$', 'ALERT_\\1', 'g') as kind,
       value, {_sec_ts('ms')} as happened_at, {_sec_text('ms')} as emitted_text
from d
"""


ORDERS_TARGET = """
select o_orderkey as id, o_custkey as cust, o_orderstatus as status, o_totalprice as price,
       o_orderpriority as priority, o_orderdate as dt_updated
from orders
"""

ORDERS_STAGE = f"""
with t as ({ORDERS_TARGET})
select id, cust, status, price + 1.0 as price, priority, dt_updated + interval 1 day as dt_updated
  from t where priority = '1-URGENT'
union all
select id, cust, status, price + 2.0, priority, dt_updated + interval 2 day
  from t where priority = '1-URGENT' and status = 'F'
union all
select id, cust, status, price * 2.0, priority, dt_updated - interval 1 day
  from t where priority = '2-HIGH' and status = 'F'
union all
select cast(null as bigint), cust, status, price, priority, dt_updated
  from t where priority = '2-HIGH' and status = 'P'
union all
select id, cust, 'X', price, priority, dt_updated
  from t where priority = '3-MEDIUM' and status = 'O'
union all
select id, cust, status, price, priority, cast(null as timestamp)
  from t where priority = '4-NOT SPECIFIED' and status = 'P'
union all
select -(id + 1), cust, status, price, priority, dt_updated
  from t where priority = '5-LOW' and status = 'O'
"""

UPSERT_REPLACE = f"""
with t as ({ORDERS_TARGET}), s as ({ORDERS_STAGE})
select * from t where not exists (select 1 from s where s.id = t.id)
union all
select * from s
"""

UPSERT_GUARDED = f"""
with t as ({ORDERS_TARGET}), s as ({ORDERS_STAGE})
select * from t where not exists (select 1 from s where s.id = t.id and s.dt_updated >= t.dt_updated)
union all
select * from s
"""

UPSERT_GUARDED_KEEP_LATEST = f"""
with t as ({ORDERS_TARGET}), s as ({ORDERS_STAGE})
select * from t where not exists (select 1 from s where s.id = t.id and s.dt_updated >= t.dt_updated)
union all
select * from s where not exists (
  select 1 from t where t.id = s.id
    and (t.dt_updated > s.dt_updated or (s.dt_updated is null and t.dt_updated is not null)))
"""

LATEST_EVENT = f"""
select {EVENT_COLS} from events
qualify row_number() over (partition by user_id order by ts desc nulls last, event_id desc nulls last) = 1
"""

_EVENT_PARTS = """cast(year(ts) as integer) as partition_0, cast(month(ts) as integer) as partition_1,
       cast(day(ts) as integer) as partition_2"""

ORACLES = {
    "scan_catalog": f"select {ORDER_COLS} from orders",
    "scan_small_files": "select l_orderkey, l_linenumber, l_quantity, l_extendedprice from lineitem",
    "rolling_scan_componentwise": f"""
select {EVENT_COLS}, {_EVENT_PARTS} from events
where year(ts) >= 2024 and month(ts) >= 1 and day(ts) >= 15""",
    "rolling_scan_date": f"""
select {EVENT_COLS}, {_EVENT_PARTS} from events
where ts >= timestamp '2024-01-22 00:00:00'""",
    "schema_from_descriptor": """
select event_id, event_type, try_cast(json_extract_string(props, '$.k') as bigint) as k from events""",
    "descriptor_json_read": """
select event_id, event_type, try_cast(json_extract_string(props, '$.k') as bigint) as k from events""",
    "zone_ingest": """
select 'customer' as entity, c_custkey as key, c_name as name, c_nationkey as number, c_acctbal as amount,
       c_mktsegment as label, cast(null as varchar) as kind from customer
union all
select 'supplier', s_suppkey, s_name, s_nationkey, s_acctbal, null, null from supplier
union all
select 'part', p_partkey, p_name, p_size, p_retailprice, p_brand, p_type from part""",
    "curated_refresh": """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       case when o_orderstatus = 'P' then null else o_orderpriority end as o_orderpriority
from orders""",
    "zone_rejects": """
select 'zone' as place, c_custkey, c_name, c_nationkey, c_acctbal from customer where c_acctbal >= 0 and c_nationkey <> 7
union all
select 'rejects', c_custkey, null, null, null from customer where c_acctbal < 0 or c_nationkey = 7""",
    "curated_drift": """
select o_orderkey, o_custkey, o_orderstatus, case when o_orderkey % 3 <> 2 then o_totalprice end as o_totalprice, o_orderdate, o_orderpriority
from orders""",
    "refresh_survives_failure": f"select {ORDER_COLS} from orders",
    "row_count_gate": "select count(*) as n from orders",
    "flatten_struct": """
select o_orderkey as id, o_orderdate as created, o_orderstatus as order_status,
       o_totalprice as order_amount_total, o_orderpriority as order_amount_priority,
       o_custkey as order_customer_id, o_orderdate as order_customer_since
from orders""",
    "flatten_all": RAW_ORDERS_FLAT,
    "flatten_two_arrays": """
select n, xs, ys, unnest([k, k + 1, k + 2]) as aa, cast(null as integer) as ea, cast(null as integer) as nn_n
from (
  select n, k, xs, unnest([seg, name]) as ys
  from (
    select c_custkey as n, c_nationkey as k, c_mktsegment as seg, c_name as name,
           unnest([c_nationkey, c_nationkey + 100]) as xs
    from customer))""",
    "flatten_sliced": """
select n, xs, unnest([brand, kind]) as ys
from (
  select p_partkey as n, p_brand as brand, p_type as kind, unnest(cast(range(1, p_size * 2 + 1) as integer[])) as xs
  from part where p_size % 7 <> 0
  union all
  select p_partkey, p_brand, p_type, null from part where p_size % 7 = 0)""",
    "type_choice_coalesce": f"""
select cast(o.o_orderkey as varchar) as order_id, cast(l.l_linenumber as varchar) as line_number,
       l.l_partkey as part_key, l.l_suppkey as supp_key, l.l_extendedprice as price,
       {_ms('l.l_shipdate')} as shipped_ms
from orders o left join lineitem l on l.l_orderkey = o.o_orderkey""",
    "dedup_latest_event": LATEST_EVENT,
    "dedup_hot_keys": """
select * from lineitem
qualify row_number() over (
  partition by l_returnflag, l_linestatus
  order by l_shipdate desc nulls last, l_orderkey desc nulls last, l_linenumber desc nulls last,
           l_partkey desc nulls last, l_suppkey desc nulls last, l_quantity desc nulls last,
           l_extendedprice desc nulls last, l_discount desc nulls last, l_tax desc nulls last) = 1""",
    "dedup_sequential": f"""
with a as (
  select {ORDER_COLS} from orders
  qualify row_number() over (partition by o_custkey, o_orderstatus
                             order by o_orderdate desc nulls last, o_orderkey desc nulls last) = 1
)
select * from a
qualify row_number() over (partition by o_custkey
                           order by o_totalprice desc nulls last, o_orderkey desc nulls last) = 1""",
    "apply_mapping": f"""
select o_orderkey as id, o_custkey as cust, o_totalprice as price, o_orderstatus as status,
       try_cast(o_orderpriority as bigint) as priority_num,
       try_cast(substr(o_orderpriority, 1, 1) as integer) as priority_rank,
       {_ms('o_orderdate')} as dt_created
from orders""",
    "sql_projection": f"""
select o_orderkey as id, o_custkey as cust, o_orderstatus as status, o_totalprice as price,
       try_cast(substr(o_orderpriority, 1, 1) as integer) as priority_rank,
       {_sec_ts(_ms('o_orderdate'))} as dt_created
from orders where o_totalprice > 100000""",
    "epoch_ms_timestamp": f"""
select event_id, {_ms('ts')} as ts_ms, {_sec_ts(_ms('ts'))} as ts_sec from events""",
    "epoch_ms_text": f"""
select event_id, {_sec_text(_ms('ts'))} as ts_text from events""",
    "capitalize_unaccent": f"""
select doc_id, lang, {_cap('text')} as text from documents""",
    "regex_clean": """
select p_partkey,
       regexp_replace(regexp_replace(p_name, '\\s+', '_', 'g'), '^([a-z]+)_([a-z]+)$', '\\2 \\1', 'g') as p_name,
       regexp_replace(p_brand, 'Brand#(\\d+)', 'B-\\1', 'g') as p_brand
from part""",
    "upsert_replace": UPSERT_REPLACE,
    "upsert_guarded": UPSERT_GUARDED,
    "upsert_guarded_keep_latest": UPSERT_GUARDED_KEEP_LATEST,
    "upsert_publish_bucketed": UPSERT_REPLACE,
    "upsert_publish_guarded": UPSERT_GUARDED_KEEP_LATEST,
    "conform_to_target": ORDERS_TARGET,
    "truncate_width": "select doc_id, substr(text, 1, 35) as text, substr(source, 1, 3) as source from documents",
    "key_constraint_report": """
select l_orderkey, count(*) as n from lineitem group by l_orderkey
having count(*) > 1 or l_orderkey is null""",
    "target_layout": f"select {ORDER_COLS} from orders",
    "nested_orders_flagship": _charges(RAW_ORDERS_FLAT),
    "recipe_full_all_replace": f"""
with first_run as ({_charges_published(_charges(RAW_ORDERS_FLAT))}),
second_drop as (
  {_charges_published(_charges(RAW_ORDERS_FLAT.replace("o.o_orderpriority as _raw_data_priority",
                                                          "'1-URGENT' as _raw_data_priority")
                                                 .replace("+ 172800000 as _emitted_at", "+ 259200000 as _emitted_at")
                                  + " where o.o_orderstatus = 'O'"))}
)
select * from first_run f where not exists (select 1 from second_drop s where s.order_no = f.order_no)
union all
select * from second_drop""",
    "recipe_full_struct_replace": f"""
with a as ({_events_pipe("ts < timestamp '2024-01-30 12:00:00'")}),
b as ({_events_pipe("ts >= timestamp '2024-01-30 12:00:00'")})
select * from a where not exists (select 1 from b where b.user_id = a.user_id)
union all select * from b""",
    "recipe_full_struct_guarded": f"""
with a as ({_events_pipe("ts >= timestamp '2024-01-15'")}),
b as ({_events_pipe("ts < timestamp '2024-01-20'")})
select * from a where not exists (select 1 from b where b.user_id = a.user_id and b.happened_at >= a.happened_at)
union all select * from b""",
    "recipe_rolling_struct_replace": f"""
with a as ({_events_pipe("ts >= timestamp '2024-01-01'")}),
b as ({_events_pipe("ts >= timestamp '2024-01-30'")})
select * from a where not exists (select 1 from b where b.user_id = a.user_id)
union all select * from b""",
    "config_batch": f"""
select 'contacts' as destination, *, null as order_no, null as line_no, null as customer_no, null as supplier_no, null as urgency,
       null as quantity, null as net_price, null as charged, null as price_class, null as ordered_at, null as days_to_ship
from ({_events_pipe("true")})
union all by name
select 'deal_pipelines' as destination, * from ({_charges_published(_charges(RAW_ORDERS_FLAT))})""",
    "incremental_upsert": LATEST_EVENT,
    "incremental_catalog_table": LATEST_EVENT,
}
