"""What every registered query must give, as SQL over the driver's tables.

Money is summed through decimals, so sums do not depend on the order of the rows.
Averages are those sums over the count, to the last digit.
"""

from __future__ import annotations

import re

from triprollup.plans.lineitem_trips import TRIP_SQL
from triprollup.schemas import COUNT_COLUMN, MEASURES, STATS, TRIP_COLUMNS

TRIP = TRIP_SQL.format(source="lineitem")
PLAIN = ", ".join(TRIP_COLUMNS)
KEYS = "vendor_id, payment_type"
BATCH_KEYS = f"batch_id, {KEYS}"
COUNT = "count(*) as count_trips"


def _with_trip(text: str) -> str:
    return f"with trip as ({TRIP})\n{text}"


def _sum(measure: str) -> str:
    if measure == "passenger_count":
        return "cast(sum(passenger_count) as bigint) as sum_passenger_count"
    exact = f"sum(cast({measure} as decimal(18,2)))"
    return f"cast({exact} as double) as sum_{measure}"


def _max(measure: str) -> str:
    return f"max({measure}) as max_{measure}"


def _mean(measure: str) -> str:
    kind = "bigint" if measure == "passenger_count" else "decimal(18,2)"
    total = f"cast(sum(cast({measure} as {kind})) as double)"
    return f"{total} / count(*) as avg_{measure}"


def _each(*stats) -> str:
    return ", ".join(stat(measure) for measure in MEASURES for stat in stats)


def _grouped(keys: str, *columns: str, source: str = "trip") -> str:
    return f"select {keys}, {', '.join(columns)} from {source} group by {keys}"


REPORT = _with_trip(
    _grouped(KEYS, "count(*) as n_trips", _sum("total_amount")) + f" order by {KEYS}"
)
FULL = _grouped(BATCH_KEYS, _each(_sum, _max, _mean), COUNT)
ROLLUP_COLUMNS = ", ".join(
    [BATCH_KEYS, *(f"{stat}_{m}" for m in MEASURES for stat in STATS), COUNT_COLUMN]
)
RECONCILED = _with_trip(
    f"""select {KEYS}, n_trips as left_n_trips, n_trips as right_n_trips,
          total as left_sum_total_amount, total as right_sum_total_amount,
          cast(0 as bigint) as diff_n_trips, cast(0 as double) as diff_sum_total_amount,
          true as match
        from (select {KEYS}, count(*) as n_trips,
                     cast(sum(cast(total_amount as decimal(18,2))) as double) as total
              from trip group by {KEYS}) r"""
)
# One group is missing on the right, another has all its amounts set to 1.
ALTERED = _with_trip(
    f"""select *, left_n_trips - right_n_trips as diff_n_trips,
          left_sum_total_amount - right_sum_total_amount as diff_sum_total_amount
        from (select {KEYS}, count(*) as left_n_trips,
                case when not gone then count(*) end as right_n_trips,
                cast(sum(cast(total_amount as decimal(18,2))) as double)
                  as left_sum_total_amount,
                case when gone then null when other then cast(count(*) as double)
                     else cast(sum(cast(total_amount as decimal(18,2))) as double) end
                  as right_sum_total_amount,
                not gone and not other as match
              from (select *, vendor_id = 'A' and payment_type = '1' as gone,
                           vendor_id = 'R' and payment_type = '2' as other from trip) t
              group by {KEYS}, gone, other) r"""
)
JSON_REJECTS = _with_trip(
    """select 'bad document' as reject_reason, count(*) as n_lines
       from trip where payment_type <> '1'"""
)
# Which damage each line got, by payment type and vendor, and the fault it shows first.
REJECTS = _with_trip(
    """select reject_reason, count(*) as n_lines
       from (select case payment_type
                      when '1' then case when vendor_id = 'R' then 'bad total_amount' end
                      when '2' then 'arity'
                      when '3' then 'arity'
                      when '5' then 'bad passenger_count'
                      when '6' then 'bad trip_distance'
                      when '7' then 'bad passenger_count'
                    end as reject_reason
             from trip) r
       where reject_reason is not null group by reject_reason"""
)
SCHEMA_LISTING = (
    " union all ".join(
        f"""select cast({position} as int) as position, '{name}' as column_name,
            '{kind}' as column_type"""
        for position, (name, kind) in enumerate(
            # The types of the trip columns.
            [
                ("vendor_id", "string"),
                ("tpep_pickup_datetime", "string"),
                ("tpep_dropoff_datetime", "string"),
                ("passenger_count", "bigint"),
                ("trip_distance", "double"),
                ("pickup_longitude", "float"),
                ("pickup_latitude", "float"),
                ("rate_code_id", "string"),
                ("store_and_fwd_flag", "string"),
                ("dropoff_longitude", "float"),
                ("dropoff_latitude", "float"),
                ("payment_type", "string"),
                ("fare_amount", "double"),
                ("extra", "double"),
                ("mta_tax", "double"),
                ("tip_amount", "double"),
                ("tolls_amount", "double"),
                ("improvement_surcharge", "double"),
                ("total_amount", "double"),
            ]
        )
    )
)
COLUMN_COUNTS = _with_trip(
    " union all ".join(
        f"select '{name}' as column_name, count({name}) as n_values from trip"
        for name in TRIP_COLUMNS
    )
)
TIMED = _with_trip(
    f"""select r as round, report, n_rows, true as ended
        from (select count(*) as n_rows from (select distinct {KEYS} from trip) g) c,
             (select unnest([1, 2])::int as r) rounds,
             (select unnest(['raw', 'rollup']) as report) reports"""
)
PLAIN_TRIPS = _with_trip(f"select {PLAIN} from trip")

# The types that the values of trips show, written as text.
INFERRED = {
    **{c: f"strftime(cast({c} as timestamp), '%Y-%m-%d %H:%M:%S') as {c}" for c in TRIP_COLUMNS[1:3]},
    **{
        c: f"cast(cast({c} as varchar) as double) as {c}"
        for c in ("pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude")
    },
    "payment_type": "cast(payment_type as bigint) as payment_type",
}
INFERRED_SCHEMA = SCHEMA_LISTING
for _name, _declared, _found in (
    ("tpep_pickup_datetime", "string", "timestamp"),
    ("tpep_dropoff_datetime", "string", "timestamp"),
    ("pickup_longitude", "float", "double"),
    ("pickup_latitude", "float", "double"),
    ("dropoff_longitude", "float", "double"),
    ("dropoff_latitude", "float", "double"),
    ("payment_type", "string", "bigint"),
):
    INFERRED_SCHEMA = re.sub(
        rf"('{_name}' as column_name,\s+)'{_declared}'", rf"\1'{_found}'", INFERRED_SCHEMA
    )
# Odd batches are damaged: payment types 4, and 1 but for vendor R, are left of them.
LEFT = "(batch_id % 2 = 0 or payment_type = '4' or (payment_type = '1' and vendor_id <> 'R'))"
UPSERTED = f"""with trip as ({TRIP}),
        late as (select * from trip where rate_code_id = 'F'),
        loads as (select 1 as load, a.* from ({FULL}) a
                  union all
                  select 2 as load, b.* from ({FULL.replace("from trip", "from late")}) b),
        ranked as (select *, row_number() over
                     (partition by {BATCH_KEYS} order by load desc) as newest from loads)
        select {ROLLUP_COLUMNS} from ranked where newest = 1"""
# Writes of one key by their number: 1 comes after 2 and is older, 3 and 4 come together.
TAKINGS = _grouped(BATCH_KEYS, _sum("total_amount"), COUNT)
WRITES = " union all ".join(
    f"select cast({number} as bigint) as write_number, w{number}.* "
    f"from ({TAKINGS.replace('from trip', f'from trip where {condition}')}) w{number}"
    for number, condition in (
        (1, "rate_code_id = 'F'"),
        (2, "true"),
        (3, "rate_code_id = 'O'"),
        (4, "store_and_fwd_flag = 'Y'"),
    )
)
ORDERED = _with_trip(
    f"""select {BATCH_KEYS}, sum_total_amount, {COUNT_COLUMN}, write_number
        from (select *, row_number() over
                (partition by {BATCH_KEYS} order by write_number desc) as newest
              from ({WRITES}) w) r
        where newest = 1"""
)

ALL = ", ".join([*TRIP_COLUMNS, "batch_id"])
CHANGED = "batch_id = 1995 and payment_type = '2'"
CASH = "batch_id = 1996 and payment_type = '1' and vendor_id"
DRILLDOWN = _with_trip(
    " union all ".join(
        f"""select {columns}, '{side}' as side, count(*) as n_copies
            from trip where {condition} group by all"""
        for side, columns, condition in (
            ("left", ALL, f"{CHANGED} or {CASH} = 'A'"),
            ("right", ALL.replace("total_amount", "1.0::double as total_amount"), CHANGED),
            ("right", ALL, f"{CASH} = 'N'"),
        )
    )
)
MESSAGES = """select cast(event_id % 4 as int) as "partition", event_id // 4 as "offset",
    cast(user_id as varchar) as "key", props as "value", event_id from events"""
FAULTS = f"""with messages as ({MESSAGES}),
    wanted as (select cast(p as int) as "partition", o as "offset"
               from range(3) a(p), range(2000) b(o)),
    delivered as (select m."partition", m."offset", event_id % 89 = 0 as thrice
                  from messages m where event_id % 97 >= 2),
    missing as (select w."partition", w."offset",
                  w."offset" - row_number() over (partition by w."partition" order by w."offset") as run
                from wanted w anti join delivered d using ("partition", "offset"))
    select "partition", 'gap' as fault, min("offset") as first_offset, max("offset") as last_offset,
      count(*) as n_messages
    from missing group by "partition", run
    union all
    select "partition", 'repeat', "offset", "offset", cast(2 as bigint)
    from delivered where thrice and "partition" < 3 and "offset" < 2000"""

ORACLE: dict[str, str] = {
    "report_raw": REPORT,
    "report_rollup": _with_trip(
        f"""select {KEYS}, cast(sum(count_trips) as bigint) as n_trips,
              cast(sum(cast(sum_total_amount as decimal(18,2))) as double)
                as sum_total_amount
            from ({_grouped(BATCH_KEYS, COUNT, _sum("total_amount"))}) r
            group by {KEYS} order by {KEYS}"""
    ),
    "report_rollup_stats": _with_trip(_grouped(KEYS, _each(_sum, _max, _mean), COUNT)),
    "report_sum_only": _with_trip(_grouped(KEYS, _sum("total_amount"))),
    "reconcile_raw_rollup": RECONCILED,
    "timed_reports": TIMED,
    "reconcile_altered": ALTERED,
    "rollup_full": _with_trip(_grouped(BATCH_KEYS, _each(_sum, _max, _mean), COUNT)),
    "rollup_sum": _with_trip(_grouped(BATCH_KEYS, _each(_sum))),
    "rollup_max": _with_trip(_grouped(BATCH_KEYS, _each(_max))),
    "rollup_avg": _with_trip(_grouped(BATCH_KEYS, _each(_mean))),
    "rollup_count": _with_trip(_grouped(BATCH_KEYS, COUNT)),
    "sum_by_key": _with_trip(_grouped(KEYS, _sum("passenger_count"))),
    "rollup_dated": _with_trip(
        _grouped(
            BATCH_KEYS,
            _sum("total_amount"),
            COUNT,
            "cast('2016-01-01' as date) as report_date",
            "make_date(batch_id, 1, 1) as batch_start",
        )
    ),
    "csv_decode": PLAIN_TRIPS,
    "csv_rejects": REJECTS,
    "json_rejects": JSON_REJECTS,
    "reconcile_drilldown": DRILLDOWN,
    "csv_quarantine": _with_trip(
        f"""select {KEYS}, count(*) as n_trips,
              cast(sum(case when payment_type = '1' and vendor_id = 'A' then 1 else 0 end)
                as bigint) as n_nan,
              cast(sum(passenger_count) as bigint) as sum_passenger_count
            from trip
            where payment_type = '4' or (payment_type = '1' and vendor_id <> 'R')
            group by {KEYS}"""
    ),
    "kv_projection": 'select cast(user_id as varchar) as "key", props as "value" from events',
    "json_roundtrip": PLAIN_TRIPS,
    "json_decode": """select event_id,
        cast(json_extract_string(props, '$.k') as bigint) as k from events""",
    "stamp_format": """select event_id,
        strftime(ts, '%Y-%m-%d %H:%M:%S') || '+0000' as stamp from events""",
    "load_date": "select event_id, cast(ts as date) as load_date from events",
    "csv_file_scan": PLAIN_TRIPS,
    "csv_typed_scan": PLAIN_TRIPS,
    "csv_inferred_scan": _with_trip(
        f"select {', '.join(INFERRED.get(c, c) for c in TRIP_COLUMNS)} from trip"
    ),
    "csv_inferred_schema": INFERRED_SCHEMA,
    "append_refresh": _with_trip(
        """select vendor_id, 2 * count(*) as n_trips,
             (select count(*) from trip) as n_before
           from trip group by vendor_id"""
    ),
    "merge_schema_scan": _with_trip(
        """select vendor_id, 2 * count(*) as n_trips, count(*) as n_stamped,
             max(substr(tpep_pickup_datetime, 1, 10)) as last_stamp
           from trip group by vendor_id"""
    ),
    "upsert_last_wins": UPSERTED,
    "upsert_versions": UPSERTED,
    "upsert_ordered": ORDERED,
    "report_incremental": REPORT,
    "named_rollup_table": _with_trip(FULL),
    "overwritten_table": _with_trip(_grouped(KEYS, _each(_sum, _max, _mean), COUNT)),
    "decoded_upsert": _with_trip(FULL),
    "bounded_read": 'select props as "value" from events',
    "bounded_read_count": "select count(*) as n_messages from events",
    "offset_range_read": f"""select "partition", "offset", "key", "value" from ({MESSAGES}) m
        where "partition" = 1 or ("partition" = 0 and "offset" >= 10 and "offset" < 150)""",
    "offset_faults": FAULTS,
    "evolved_schema_scan": _with_trip(
        """select vendor_id, 3 * count(*) as n_trips,
             cast(sum(2 * passenger_count + 1099511627776) as bigint) as sum_passenger_count,
             2 * count(*) as n_distances,
             greatest(max(trip_distance), cast(max(cast(trip_distance as float)) as double))
               as max_trip_distance,
             count(*) as n_payments
           from trip group by vendor_id"""
    ),
    "preview": _with_trip(f"select {PLAIN} from trip order by {PLAIN} limit 20"),
    "preview_rollup": _with_trip(f"{FULL} order by {BATCH_KEYS} limit 10"),
    "schema_listing": SCHEMA_LISTING,
    "column_counts": COLUMN_COUNTS,
    "stream_ingest_raw": REPORT,
    "stream_ingest_rollup": REPORT,
    "stream_ingest_json": REPORT,
    "stream_reconcile": RECONCILED,
    "stream_two_ingests": _with_trip(
        _grouped(KEYS, _sum("fare_amount"), _max("fare_amount"), COUNT, source=f"trip where {LEFT}")
    ),
    "ingest_ledger": _with_trip(
        f"""select cast(2 as bigint) as n_ingests, count(*) filter (where {LEFT}) as n_rows,
              count(*) filter (where not {LEFT}) as n_refused,
              count(*) filter (where {LEFT}) as n_raw,
              count(*) filter (where not {LEFT}) as n_rejects
            from trip"""
    ),
    "batch_progress": _with_trip(
        f"""select count(*) filter (where {LEFT}) as n_rows,
              count(*) filter (where not {LEFT}) as n_refused,
              cast(0 as bigint) as n_unrecorded, cast(0 as bigint) as n_out_of_order,
              cast(0 as bigint) as n_late
            from trip"""
    ),
    "stream_rejects": REJECTS,
    "compacted_rollup": REPORT,
    "compacted_removed": REPORT,
}
