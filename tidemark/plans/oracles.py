"""Reference SQL for every batch-checkable query (runs on DuckDB over the same tables).

Written independently of the Spark code: plain GROUP BY / date_trunc /
row_number over the SQL form of the table adapter.
"""

from __future__ import annotations

from tidemark.sources.fixtures import EVENTS_SQL, ORDER_CHANGES_SQL

_TYPES = "('view', 'cart', 'purchase')"

# Typed events as in the table: every required field present, type known.
_GOOD = f"""ev as ({EVENTS_SQL}),
good as (select * from ev where event_time is not null and event_type in {_TYPES}
         and product_id is not null and category_id is not null and price is not null
         and user_id is not null)"""

# Events after a trip through the JSON wire: only time and type are required,
# missing longs bind as 0.
_WIRE_GOOD = f"""ev as ({EVENTS_SQL}),
wire as (select event_id, event_time, event_type, coalesce(product_id, 0) as product_id,
                coalesce(category_id, 0) as category_id, category_code, brand, price,
                coalesce(user_id, 0) as user_id, user_session
         from ev where event_time is not null and event_type in {_TYPES})"""


def _json_text(col: str) -> str:
    return f"coalesce(to_json({col})::varchar, 'null')"


def _json_number(col: str) -> str:
    return f"coalesce(cast({col} as varchar), 'null')"


# The event's wire JSON, as the encoder writes it.
EVENT_JSON = (
    "'{\"eventTime\":' || cast(epoch_us(event_time) // 1000000 as varchar) || '.'"
    " || lpad(cast(epoch_us(event_time) % 1000000 as varchar), 6, '0') || '000'"
    f" || ',\"eventType\":' || {_json_text('event_type')}"
    f" || ',\"productId\":' || {_json_number('product_id')}"
    f" || ',\"categoryId\":' || {_json_number('category_id')}"
    f" || ',\"categoryCode\":' || {_json_text('category_code')}"
    f" || ',\"brand\":' || {_json_text('brand')}"
    " || ',\"price\":' || case when price = 0 then '0E-18' else "
    f"{_json_number('price')} end"
    f" || ',\"userId\":' || {_json_number('user_id')}"
    f" || ',\"userSession\":' || {_json_text('user_session')} || '}}'"
)


def _window_counts(unit: str, key_expr: str, key: str, source: str = "good") -> str:
    return (f"select date_trunc('{unit}', event_time) as window_start, "
            f"date_trunc('{unit}', event_time) + interval 1 {unit} as window_end, "
            f"{key_expr} as {key}, count(*) as event_count from {source} group by all")


def _topn(unit: str, source: str = "good") -> str:
    counts = _window_counts(unit, "coalesce(category_code, 'unknown')", "category_code", source)
    return (f"select window_start, window_end, cast(rn as integer) as rank, category_code, event_count "
            f"from (select *, row_number() over (partition by window_start "
            f"order by event_count desc, category_code asc) as rn from ({counts}) c) r where rn <= 5")


def _fmt(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S')"


def _closed(source_query: str, max_source: str = "wire") -> str:
    """Windows whose end the watermark (max event time - 5 s) has reached."""
    return (f"select * from ({source_query}) x where window_end <= "
            f"(select max(event_time) from {max_source}) - interval 5 second")


ORACLES: dict[str, str] = {
    "event_type_counts_1m": f"with {_GOOD} " + _window_counts("minute", "upper(event_type)", "event_type"),
    "event_type_counts_1h": f"with {_GOOD} " + _window_counts("hour", "upper(event_type)", "event_type"),
    "category_counts_1m": f"with {_GOOD} " + _window_counts(
        "minute", "coalesce(category_code, 'unknown')", "category_code"),
    "category_topn_1m": f"with {_GOOD} " + _topn("minute"),
    "category_topn_1h": f"with {_GOOD} " + _topn("hour"),
    "event_type_count_lines": f"with {_GOOD}, c as ("
        + _window_counts("minute", "upper(event_type)", "event_type")
        + ") select '[' || " + _fmt("window_start") + " || ' - ' || " + _fmt("window_end")
        + " || '] ' || event_type || ': ' || cast(event_count as varchar) as line from c",
    "category_topn_lines": f"with {_GOOD}, t as (" + _topn("hour")
        + ") select '[' || " + _fmt("window_start") + " || ' - ' || " + _fmt("window_end")
        + " || '] #' || cast(rank as varchar) || ' ' || category_code || ': '"
        + " || cast(event_count as varchar) as line from t",
    "rejected_events": f"with ev as ({EVENTS_SQL}) select event_id, event_type, case "
        "when event_time is null then 'missing_event_time' "
        "when event_type is null then 'missing_event_type' "
        f"when event_type not in {_TYPES} then 'unknown_event_type' "
        "when product_id is null then 'missing_product_id' "
        "when category_id is null then 'missing_category_id' "
        "when price is null then 'missing_price' "
        "when user_id is null then 'missing_user_id' end as reject_reason "
        "from ev where event_time is null or event_type is null or event_type not in "
        f"{_TYPES} or product_id is null or category_id is null or price is null or user_id is null",
    "ingest_summary": f"with {_GOOD} select (select count(*) from ev) as total_records, "
        "(select count(*) from good) as good_records, "
        "(select count(*) from ev) - (select count(*) from good) as rejected_records",
    "events_preview": f"with {_GOOD} select event_id, event_time, event_type, product_id, category_id, "
        "category_code, brand, price, user_id, user_session from good "
        "order by event_id limit 10",  # the table is stored by id
    "decoded_events": f"with {_WIRE_GOOD} select event_time, event_type, product_id, category_id, "
        "category_code, brand, price, user_id, user_session from wire",
    "kafka_payload": f"with {_GOOD} select cast(user_id as varchar) as key, {EVENT_JSON} as value from good",
    "consumed_audit": f"with {_WIRE_GOOD} select cast(user_id % 4 as integer) as partition, "
        "event_id as offset, cast(user_id as varchar) as key, "
        "'partition=' || cast(user_id % 4 as varchar) || ' offset=' || cast(event_id as varchar) "
        f"|| ' key=' || cast(user_id as varchar) || ' event=' || {EVENT_JSON} as line from wire",
    "record_rejects": f"with ev as ({EVENTS_SQL}) select {EVENT_JSON} as raw, "
        "cast(user_id % 4 as integer) as partition, event_id as offset, "
        "cast(user_id as varchar) as key, case when event_time is null then 'missing_event_time' "
        "when event_type is null then 'missing_event_type' else 'unknown_event_type' end as reason "
        f"from ev where event_time is null or event_type is null or event_type not in {_TYPES}",
    "csv_ingest": f"with {_GOOD} select date_trunc('second', event_time) as event_time, event_type, "
        "product_id, category_id, category_code, brand, price, user_id, user_session from good",
    "csv_rejects": f"with ev as ({EVENTS_SQL}) select "
        "coalesce(strftime(event_time, '%Y-%m-%d %H:%M:%S') || ' UTC', '') || ',' || coalesce(event_type, '') "
        "|| ',' || coalesce(cast(product_id as varchar), '') || ',' || coalesce(cast(category_id as varchar), '') "
        "|| ',' || coalesce(category_code, '') || ',' || coalesce(brand, '') "
        "|| ',' || coalesce(cast(price as varchar), '') || ',' || coalesce(cast(user_id as varchar), '') "
        "|| ',' || coalesce(user_session, '') as raw_record, case "
        "when event_time is null then 'missing_event_time' "
        "when event_type is null then 'missing_event_type' "
        f"when event_type not in {_TYPES} then 'unknown_event_type' "
        "when product_id is null then 'missing_product_id' "
        "when category_id is null then 'missing_category_id' "
        "when price is null then 'missing_price' "
        "when user_id is null then 'missing_user_id' end as reject_reason "
        "from ev where event_time is null or event_type is null or event_type not in "
        f"{_TYPES} or product_id is null or category_id is null or price is null or user_id is null",
    "manual_requests": f"with ev as ({EVENTS_SQL}), req as (select "
        "event_type as eventType, cast(product_id as varchar) as productId, "
        "cast(category_id as varchar) as categoryId, coalesce(category_code, '') as categoryCode, "
        "coalesce(brand, chr(9)) as brand, cast(price as varchar) as price, "
        "cast(user_id as varchar) as userId, "
        "case when user_id % 5 = 0 then ' ' else user_session end as userSession from ev) "
        "select true as stamped_now, eventType as event_type, try_cast(productId as bigint) as product_id, "
        "try_cast(categoryId as bigint) as category_id, "
        "case when trim(categoryCode) = '' then null else categoryCode end as category_code, "
        "case when trim(brand, ' ' || chr(9)) = '' then null else brand end as brand, "
        "try_cast(price as decimal(38,18)) as price, try_cast(userId as bigint) as user_id, "
        "cast(case when trim(userSession) = '' then 36 else length(userSession) end as integer) "
        "as session_length, "
        "case when eventType is null or eventType not in " + _TYPES + " then 'unknown_event_type' "
        "when productId is null then 'bad_product_id' when categoryId is null then 'bad_category_id' "
        "when price is null then 'bad_price' when userId is null then 'bad_user_id' end as reject_reason "
        "from req",
    "orders_current_state": f"with changes as ({ORDER_CHANGES_SQL}), ranked as (select *, "
        "row_number() over (partition by order_id order by change_seq desc) as rn from changes) "
        "select order_id, customer_name, product_name, amount, status, created_at, "
        "change_seq as last_change_seq from ranked where rn = 1 and op <> 'delete'",
    "stream_event_type_counts": f"with {_WIRE_GOOD} " + _closed(
        _window_counts("minute", "upper(event_type)", "event_type", "wire")),
    "stream_category_topn": f"with {_WIRE_GOOD} " + _closed(_topn("minute", "wire")),
}
# Replayed from CSV: times are whole seconds there, and every required field must be present.
_CSV_GOOD = f"""{_GOOD}, sent as (select * replace (date_trunc('second', event_time) as event_time) from good)"""
ORACLES["stream_replay_counts"] = f"with {_CSV_GOOD} " + _closed(
    _window_counts("minute", "upper(event_type)", "event_type", "sent"), "sent")
# Late events (id % 50 = 7) come after all others: lost if their window has closed by then.
ORACLES["stream_late_events"] = f"""with {_WIRE_GOOD},
mark as (select max(event_time) - interval 5 second as w from wire where event_id % 50 <> 7),
counted as (select wire.* from wire, mark where event_id % 50 <> 7
            or date_trunc('minute', event_time) + interval 1 minute > w)
""" + _closed(_window_counts("minute", "upper(event_type)", "event_type", "counted"))
ORACLES["stream_fan_out_lines"] = (
    f"with {_WIRE_GOOD}, c as (" + _closed(_window_counts("minute", "upper(event_type)", "event_type", "wire"))
    + ") select sink, '[' || " + _fmt("window_start") + " || ' - ' || " + _fmt("window_end")
    + " || '] ' || event_type || ': ' || cast(event_count as varchar) as line from c cross join (values ('lines'), ('table')) s(sink)")
ORACLES["stream_two_consumers"] = f"""with {_WIRE_GOOD}
select consumer, cast(user_id % 4 as integer) as partition, event_id as "offset", cast(user_id as varchar) as key
from wire cross join (values ('first'), ('second')) c(consumer)"""
ORACLES["json_binding_cases"] = f"""with ev as ({EVENTS_SQL}),
k as (select *, event_id % 6 as kind,
      case when event_time is null then 'missing_event_time' when event_type is null then 'missing_event_type'
           when event_type not in {_TYPES} then 'unknown_event_type' end as plain_reason from ev)
select event_id as "offset",
       case when kind = 5 then null when kind = 4 then date_trunc('second', event_time) else event_time end as event_time,
       case when kind = 5 then null when kind = 3 then 0 else coalesce(product_id, 0) end as product_id,
       case when kind = 5 then null else coalesce(user_id, 0) end as user_id,
       case when kind = 5 then 'malformed_json' else plain_reason end as reject_reason
from k"""
ORACLES["csv_multiline_ingest"] = f"""with {_GOOD}
select date_trunc('second', event_time) as event_time, event_type, product_id, category_id, category_code,
       case product_id % 3 when 1 then brand || chr(10) || '"x", y' when 2 then 'a' || chr(10) || chr(10) || brand else brand end as brand,
       price, user_id, case when user_id % 5 = 0 then user_session || chr(10) || ',end' else user_session end as user_session
from good"""
# The table is stored by id; the first broken one is the first good id above 700.
ORACLES["csv_until_first_error"] = f"""with {_GOOD}
select date_trunc('second', event_time) as event_time, event_type, product_id, category_id, category_code, brand, price, user_id, user_session
from good where event_id < coalesce((select min(event_id) from good where event_id % 4999 > 700), 9223372036854775807)"""
ORACLES["order_change_images"] = """
with o as (select o_orderkey as k, cast(o_totalprice as decimal(10,2)) as base, o_orderstatus as status from orders),
u as (select *, case when k % 6 = 1 then base else cast(base + 10 as decimal(10,2)) end as raised from o where k % 3 = 1)
select k * 2 as commit_seq, cast(k as int) as order_id, 'insert' as op, null::decimal(10,2) as amount_before, base as amount_after,
       null::varchar as status_before, 'new' as status_after, null::varchar as changed from o
union all
select k * 2 + 1, cast(k as int), 'update', base, raised, 'new', status,
       concat_ws(';', case when raised <> base then 'amount:' || base || '>' || raised end,
                 case when status <> 'new' then 'status:new>' || status end) from u
union all
select k * 2 + 1, cast(k as int), 'delete', base, null, 'new', null, null from o where k % 3 = 2"""
ORACLES["ingest_progress_marks"] = f"""with {_GOOD}
select sent, event_id, event_time from (select row_number() over (order by event_id) as sent, * from good) n where sent % 1000 = 0"""
ORACLES["stream_redelivered_counts"] = ORACLES["stream_event_type_counts"]
ORACLES["stream_open_windows"] = (f"with {_WIRE_GOOD} select * from ("
    + _window_counts("hour", "upper(event_type)", "event_type", "wire")
    + ") x where window_end > (select max(event_time) from wire) - interval 5 second")
# Two inputs at different times lose nothing: as if they were one.
ORACLES["stream_lagging_input"] = ORACLES["stream_event_type_counts"]
ORACLES["stream_record_rejects"] = ORACLES["record_rejects"]
ORACLES["stream_consumed_audit"] = ORACLES["consumed_audit"]
ORACLES["stream_orders_current_state"] = ORACLES["orders_current_state"]
