"""The same results in DuckDB SQL over the test tables."""

from tierline.schemas import PAYLOAD_FIELDS

_FIELDS = ", ".join(PAYLOAD_FIELDS)


def _recipe(prefix: str, key: str, name: str, kind: str, source: str) -> str:
    return f"""
select concat('{prefix}', {key}) as id, {name} as name, concat(' ', {kind}, ' ') as brewery_type,
       case when {key} % 7 = 0 then null when {key} % 7 = 1 then ''
            else concat('  ', lower(n_name), ' TOWN') end as city,
       case when {key} % 11 = 0 then null else concat(' ', n_name, ' ') end as state_province,
       case when {key} % 13 = 0 then null when {key} % 13 = 1 then '' else r_name end as country,
       case when {key} % 5 = 0 then null else concat('+1 (', {key} % 900, ') 555-', {key}) end as phone,
       concat(' HTTP://', {name}, '.Example.COM ') as website_url,
       case when {key} % 17 = 0 then 'n/a' else cast({key} % 180 as varchar) end as latitude,
       cast({key} % 90 as varchar) as longitude,
       case when {key} % 3 = 0 then null else 'Suite 1' end as address_1,
       cast(null as varchar) as address_2,
       case when {key} % 4 = 0 then null else {kind} end as address_3,
       {key} // 200 + 1 as page, cast({key} % 200 as integer) as pos
from {source} join region on n_regionkey = r_regionkey"""


_CUSTOMERS = _recipe(
    "c", "c_custkey", "c_name", "c_mktsegment", "customer join nation on c_nationkey = n_nationkey"
)
_SUPPLIERS = _recipe("s", "s_suppkey", "s_name", "'SUPPLIER'", "supplier join nation on s_nationkey = n_nationkey")

_LAST_STATUS = """
select 'c' || o_custkey as id, o_orderstatus as last_status
from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as nth
      from orders) where nth = 1"""

# The second fetch, and the part of it that is new or changed.
_SECOND = f"""
select c.* replace (case when last_status = 'F' then 'Box F' end as address_2)
from ({_CUSTOMERS}) c join ({_LAST_STATUS}) using (id) where last_status <> 'P'
union all select * from ({_SUPPLIERS})"""
_SECOND_DELTA = f"select * from ({_SECOND}) where address_2 = 'Box F' or id like 's%'"


def _title(value: str) -> str:
    words = f"string_split({value}, ' ')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || lower(w[2:])), ' ')"


def _silver(recipe: str, blank_as_missing: bool = False) -> str:
    def place(column: str) -> str:
        value = f"nullif(trim({column}), '')" if blank_as_missing else column
        return _title(f"trim(coalesce({value}, 'Not Informed'))")

    return f"""
select id, name, {_title("trim(brewery_type)")} as brewery_type, {place("city")} as city,
       {place("state_province")} as state_province, {place("country")} as country,
       regexp_replace(phone, '\\D', '', 'g') as phone, lower(trim(website_url)) as website_url,
       try_cast(latitude as double) as latitude, try_cast(longitude as double) as longitude,
       address_1, address_2, address_3, concat_ws(' ', address_1, address_2, address_3) as full_address
from ({recipe})"""


def _stored(recipe: str) -> str:
    return (
        "select * replace (nullif(country, '') as country, nullif(state_province, '') as state_province) "
        f"from ({_silver(recipe)})"
    )


def _gold(recipe: str) -> str:
    return f"""
select country, state_province, brewery_type, count(*) as total_breweries
from ({_stored(recipe)}) group by 1, 2, 3"""


_CURRENT = f"select * from ({_CUSTOMERS}) where id not in (select id from ({_SECOND})) union all {_SECOND}"
_THIRD = f"""
select * replace (case when id[2:]::bigint % 4 = 0 then ' relocated ' else brewery_type end as brewery_type,
                  case when id[2:]::bigint % 4 <> 0 then state_province end as state_province)
from ({_CUSTOMERS})"""
_MISSING = """concat_ws(',', case when city is null then 'city' end, case when country is null then 'country' end)"""

_PAYLOAD = "to_json(struct_pack(" + ", ".join(f"{f} := {f}" for f in PAYLOAD_FIELDS) + "))::varchar"

_VERSIONS = """
versions as (select *, user_id || '-' || hour(ts) as id_api, ts >= timestamp '2024-01-16' as later from events),
newest as (select * from (select *, row_number() over (partition by id_api, later
                          order by ts desc, event_id desc) as nth from versions) where nth = 1),
t as (select id_api, '{"n":1,"type":"' || event_type || '"}' as payload, event_type as kind, ts
      from newest where not later),
b as (select id_api, '{ "type": "' || event_type || '", "n": 1.0 }' as payload, event_type as kind, ts
      from newest where later)"""

_UPSERT = f"""
with {_VERSIONS}
select id_api,
       case when t.ts is null or t.kind <> b.kind then b.payload else t.payload end as payload,
       coalesce(t.ts, b.ts) as ingested_at,
       case when t.ts is null or t.kind <> b.kind then b.ts else t.ts end as updated_at
from t full outer join b using (id_api)"""

_FIRST_SECONDS = "epoch(timestamp '2024-01-01 09:00:00')::bigint"
_SECOND_SECONDS = "epoch(timestamp '2024-01-03 09:00:00')::bigint"

# Written runs by name: what each run of the two loads put into silver.
_RUN_1, _RUN_2 = "20240101_0900", "20240103_0900"


def _runs(select: str, first: str, second: str, names: tuple[str, str] = (_RUN_1, _RUN_2)) -> str:
    return (
        f"select {select}, '{names[0]}' as run_id from ({first}) "
        f"union all select {select}, '{names[1]}' as run_id from ({second})"
    )


def _gate_case(name: str, select: str) -> str:
    return f"select '{name}' as gate_case, * from ({select})"


def _bronze_verdict(name: str, newer: str) -> str:
    return _gate_case(
        name,
        f"""select case when total = 0 then 'fail' when changed = 0 then 'skip' else 'proceed' end as status,
            case when total = 0 then 'table is empty' when changed = 0 then 'no changes' end as reason,
            total, changed
        from (select count(*) as total, count(*) filter (where {newer}) as changed from events)""",
    )


def _delta_verdict(name: str, up: str, down: str) -> str:
    return _gate_case(
        name,
        f"""select case when u is null then 'fail' when u <= d then 'skip' else 'proceed' end as status,
            case when u is null then 'upstream is empty' when u <= d then 'no new data' end as reason,
            u as latest_upstream, d as latest_downstream,
            coalesce(d, timestamp '1900-01-01 00:00:00') as cursor
        from (select ({up}) as u, ({down})::timestamp as d)""",
    )


_NEWEST_ORDERS = "select count(*) from orders where o_orderdate = (select max(o_orderdate) from orders)"


def _reconciled(name: str, expected: str) -> str:
    return _gate_case(
        name,
        f"""select case when e = 0 then 'skip' when e = a then 'proceed' else 'fail' end as status,
            e as expected, a as actual from (select ({expected}) as e, ({_NEWEST_ORDERS}) as a)""",
    )


_SILVER_COLUMNS = _FIELDS + ", full_address"

ORACLES: dict[str, str] = {
    "parse_payload": f"select {_FIELDS} from ({_CUSTOMERS})",
    "parse_props": "select json_extract_string(props, '$.k') as k from events",
    "silver_clean": _silver(_CUSTOMERS),
    "silver_clean_blank_as_missing": (
        f"select id, city, state_province, country from ({_silver(_CUSTOMERS, blank_as_missing=True)})"
    ),
    "gold_counts": _gold(_CUSTOMERS),
    "gold_current": _gold(_CURRENT),
    "required_keys": f"select id from ({_CUSTOMERS}) where city is not null and country is not null",
    "quarantine": f"""
select id, {_MISSING} as missing_keys, 'missing keys' as reason
from ({_CUSTOMERS}) where city is null or country is null""",
    "bronze_rows": f"""
select id as id_api, {_PAYLOAD} as payload, {_FIRST_SECONDS} as updated_at from ({_CUSTOMERS})""",
    "page_stats": f"""
select page, count(*) as n_records,
       count(*) filter (where city is not null and country is not null) as n_valid
from ({_CUSTOMERS}) group by page""",
    "page_plan": "select unnest(range(1, ceil(n / 200.0)::bigint + 1)) as page from (select count(*) as n from customer)",
    "page_scan": f"select page, pos, {_PAYLOAD} as payload from ({_CUSTOMERS})",
    "latest_per_key": """
select user_id, event_id, ts, event_type
from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as nth from events)
where nth = 1""",
    "key_check": """
select user_id, count(*) as n_rows, case when user_id is null then 'null key' else 'duplicate key' end as problem
from events group by user_id having user_id is null or count(*) > 1""",
    "upsert_changed": _UPSERT,
    "upsert_broadcast": _UPSERT,
    "upsert_changes": f"""
with {_VERSIONS}
select id_api, b.payload, coalesce(t.ts, b.ts) as ingested_at, b.ts as updated_at,
       case when t.ts is null then 'insert' else 'update' end as op
from b left join t using (id_api) where t.ts is null or t.kind <> b.kind""",
    "bronze_store": _UPSERT,
    "high_water_mark": "select max(ts) as high_water_mark, count(*) as n_rows from events",
    "change_stats": """
select count(*) as total, count(*) filter (where ts > timestamp '2024-01-16') as changed from events""",
    "delta_filter": "select * from orders where o_orderdate > timestamp '1998-01-01'",
    "latest_batch": "select * from orders where o_orderdate = (select max(o_orderdate) from orders)",
    "bronze_gate": " union all ".join(
        [
            _bronze_verdict("no cursor", "true"),
            _bronze_verdict("older cursor", "ts > timestamp '2024-01-16'"),
            _bronze_verdict("newest cursor", "ts > (select max(ts) from events)"),
        ]
    ),
    "delta_gate": " union all ".join(
        [
            _delta_verdict("newer", "select max(ts) from events", "select max(o_orderdate) from orders"),
            _delta_verdict("older", "select max(o_orderdate) from orders", "select max(ts) from events"),
            _delta_verdict("equal", "select max(ts) from events", "select max(ts) from events"),
            _delta_verdict("first", "select max(ts) from events", "null"),
        ]
    ),
    "reconcile": " union all ".join(
        [_reconciled("match", _NEWEST_ORDERS), _reconciled("mismatch", "select count(*) from orders")]
    ),
    "preflight": """
select 'customer' as input, '' as missing_columns, count(*) > 0 as has_rows,
       case when count(*) = 0 then 'empty' else 'ok' end as status from customer
union all select 'orders', 'o_updated_at', count(*) > 0, 'missing columns' from orders
union all select 'events', '', count(*) > 0, case when count(*) = 0 then 'empty' else 'ok' end from events""",
    "lake_partitioned": _stored(_CUSTOMERS),
    "lake_scan": _runs(
        "id, name, country, state_province, brewery_type, latitude", _stored(_CUSTOMERS), _stored(_SUPPLIERS)
    ),
    "lake_pruned": _runs(
        "id, state_province, city",
        f"select * from ({_stored(_CUSTOMERS)}) where country = 'Asia'",
        f"select * from ({_stored(_SUPPLIERS)}) where country = 'Asia'",
    ),
    "lake_table": f"""
select run_id, country, count(*) as n_rows, count(latitude) as n_located
from ({_runs("country, latitude", _stored(_CUSTOMERS), _stored(_SUPPLIERS))}) group by 1, 2""",
    "latest_run": _stored(_SUPPLIERS),
    "gold_snapshot": f"select *, {_FIRST_SECONDS} as processed_at from ({_gold(_CUSTOMERS)})",
    "run_id": "select event_id, strftime(ts, '%Y%m%d_%H%M') as run_id from events",
    "bronze_stage": f"""
select id as id_api, name, address_2,
       case when id like 's%' then {_SECOND_SECONDS} else {_FIRST_SECONDS} end as ingested_at,
       case when id in (select id from ({_SECOND_DELTA})) then {_SECOND_SECONDS}
            else {_FIRST_SECONDS} end as updated_at
from ({_CURRENT})""",
    "silver_stage": f"""
select *, case when run_id = '{_RUN_1}' then {_FIRST_SECONDS} else {_SECOND_SECONDS} end as ingested_at
from ({_runs(_SILVER_COLUMNS, _stored(_CUSTOMERS), _stored(_SECOND_DELTA))})""",
    "gold_stage": f"select *, {_SECOND_SECONDS} as processed_at from ({_gold(_SECOND_DELTA)})",
    "gold_stage_current": _gold(_CURRENT),
    "medallion": _runs(
        "country, state_province, brewery_type, total_breweries", _gold(_CUSTOMERS), _gold(_SECOND_DELTA)
    ),
    "stream_silver": _runs(
        _SILVER_COLUMNS, _stored(_CUSTOMERS), _stored(_SECOND_DELTA), (_RUN_1, _RUN_2)
    ),
    "page_files": f"select page, pos, {_PAYLOAD} as payload from ({_CUSTOMERS})",
    "page_source": f"select page, pos, id, name, city, phone from ({_CUSTOMERS})",
    "silver_late": _runs(
        _SILVER_COLUMNS, _stored(_CUSTOMERS), _stored(_SECOND_DELTA), ("20240103_0900", "20240104_0900")
    ),
    "gold_repeat": _runs(
        "country, state_province, brewery_type, total_breweries", _gold(_CUSTOMERS), _gold(_SECOND_DELTA)
    ),
    "medallion_repeat": f"""
select {_SILVER_COLUMNS} from ({_stored(_CUSTOMERS)}) union all select {_SILVER_COLUMNS} from ({_stored(_SECOND_DELTA)})""",
    "stream_repeat": _runs(_SILVER_COLUMNS, _stored(_CUSTOMERS), _stored(_SUPPLIERS), (_RUN_1, "20231231_0900")),
}
ORACLES |= {
    "silver_broken_repeat": ORACLES["silver_late"],
    "silver_audit": f"select {_SILVER_COLUMNS}, '{_RUN_1}' as run_id from ({_stored(_CUSTOMERS)})",
    "quarantine_malformed": f"""
select page, pos, null::varchar as missing_keys, 'malformed' as reason from ({_CUSTOMERS}) where pos % 5 <> 0""",
    # Totals in cents as exact whole numbers, the second spelling scaled by what it adds.
    "json_numbers": """
select o_orderkey, case o_orderkey % 6 when 3 then cents * 10 <> cents * 10 + 1 when 4 then true when 5 then cents <> -cents
                   else false end as differ
from (select o_orderkey, round(o_totalprice * 100)::bigint as cents from orders)""",
    "upsert_pruned": f"""
with {_VERSIONS},
last as (select * from (select *, row_number() over (partition by id_api order by ts desc, event_id desc) as nth
                        from versions where ts >= timestamp '2024-01-30') where nth = 1)
select id_api, '{{ "type": "' || l.event_type || '", "n": 1.0 }}' as payload, coalesce(t.ts, l.ts) as ingested_at, l.ts as updated_at,
       case when t.ts is null then 'insert' else 'update' end as op
from last l left join t using (id_api) where t.ts is null or t.kind <> l.event_type""",
    "split_predicates": "select count(*) as n_rows, 0::bigint as n_misplaced, true as even from orders",
    "lake_compacted": f"""
select * from ({_runs("id, name, country, state_province, brewery_type, latitude", _stored(_CUSTOMERS), _stored(_SUPPLIERS))})
union all select id, name, country, state_province, brewery_type, latitude, '20240104_0900' as run_id from ({_stored(_SUPPLIERS)})""",
    "stream_pages": f"select page, pos, id, name, city, phone from ({_CUSTOMERS})",
    "stream_reconcile": """
select batch, n_read, n_read as n_written, 'proceed' as status, n as n_stored
from (select count(*) as n from customer), lateral (values (0, n // 2), (1, n - n // 2)) b(batch, n_read)""",
    "sink_commit": f"select {_SILVER_COLUMNS}, '{_RUN_1}' as run_id from ({_stored(_CUSTOMERS)})",
    "gold_incremental": _gold(f"select * from ({_THIRD}) union all {_SUPPLIERS}"),
    "stream_after_batch": " union all ".join(
        f"select '{layer}' as layer, * from ({_runs('id, address_2, full_address', _stored(_CUSTOMERS), _stored(_SECOND_DELTA), names)})"
        for layer, names in (("shared", (_RUN_2, f"{_RUN_2}_2")), ("unnoted", (_RUN_1, _RUN_2)))
    ),
}
ORACLES["bronze_stage_shuffled"] = ORACLES["bronze_repeat"] = ORACLES["bronze_stage"]
