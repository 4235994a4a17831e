"""DuckDB SQL for the registered queries, over the raw test tables only."""

from __future__ import annotations

import re

from fleetscope import model
from fleetscope.functions.routes import ROUTE_POINTS, ROUTES

AS_OF = "timestamp '2024-01-31 00:00:00'"
EPOCH = "timestamp '2024-01-01 00:00:00'"


def _pick(number: str, values: list[str]) -> str:
    arms = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values[:-1]))
    return f"case {number} % {len(values)} {arms} else '{values[-1]}' end"


def _code(pk: str) -> str:
    return f"concat('SHIP', lpad(cast({pk} as varchar), 10, '0'))"


_LOCK = _pick("c_custkey", model.LOCK_STATUSES)
_SHIP = _pick("s_nationkey", model.SHIPMENT_STATUSES)
_LAT = "cast(-34.0 as double) + (({0} * 37) % 1000) / cast(1000 as double)"
_LON = "cast(-60.0 as double) + (({0} * 53) % 1000) / cast(1000 as double)"
_SUPPLIERS = "(select count(*) from supplier)"


def _later(seconds: str) -> str:
    return f"{EPOCH} + interval '1' second * ({seconds})"


def _islands(rows: str, gap: str) -> str:
    """Rows (lock_id, id, t) with the number of the stretch without gaps that they are in."""
    return f"""select *, sum(fresh) over (partition by lock_id order by t, id rows unbounded preceding) as island
        from (select *, case when t <= lag(t) over (partition by lock_id order by t, id) + interval {gap} then 0 else 1 end
              as fresh from {rows})"""


_SESSIONS = """
    select lock_id, min(event_time) as session_start, max(event_time) + interval 12 hour as session_end,
      count(*) as incidents, cast(sum(case when severity = 'critical' then 1 else 0 end) as bigint) as critical_incidents
    from (select *, sum(fresh) over (partition by lock_id order by event_time, id rows unbounded preceding) as session
          from (select *, case when event_time < lag(event_time) over (partition by lock_id order by event_time, id)
                  + interval 12 hour then 0 else 1 end as fresh
                from security_events where severity in ('high', 'critical')))
    group by lock_id, session"""
_NEXT_STATUS = """(select *, lead(change_time) over (partition by lock_id order by change_time, id) as next from changes)"""


def _flips(spans: str, name: str, limit: float) -> str:
    """When the share of locks within a span [low, high) goes over the limit and back, by whole minutes."""
    minute = lambda c: f"date_trunc('minute', {c}) + case when {c} > date_trunc('minute', {c}) then interval 1 minute else interval 0 minute end"
    return f"""select * from (
        with steps as (
          select {minute("low")} as told_at, 1 as step from {spans} union all select {minute("high")}, -1 from {spans}),
        ticks as (select told_at, sum(step) as step from steps group by told_at),
        counted as (select told_at, sum(step) over (order by told_at rows unbounded preceding) as total from ticks),
        shares as (select *, (select count(*) from locks) as locks from counted),
        told as (select *, total / nullif(locks, 0) > {limit} as alert from shares),
        turned as (select *, lag(alert, 1, false) over (order by told_at) as before from told)
        select told_at, case when alert then 'raised' else 'withdrawn' end as what, cast(total as bigint) as {name},
          locks, round(total / nullif(locks, 0), 4) as share
        from turned where alert <> before)"""


def _half_up(a: str, b: str, digits: int) -> str:
    """a / b rounded half up, in whole numbers because a double quotient may miss a tie."""
    scale = 10**digits
    return f"((({a}) * {2 * scale} + ({b})) // (2 * ({b}))) / {scale}.0"


def _values(rows) -> str:
    cells = lambda r: ", ".join(f"'{x}'" if isinstance(x, str) else f"cast({x} as double)" for x in r)
    return ", ".join(f"({cells(r)})" for r in rows)


# Views by name; each may use the ones above it.
VIEWS = {
    "security_events": """
        select cast(event_id as varchar) as id, cast(user_id as varchar) as lock_id,
          case event_type when 'error' then 'tamper_detected' when 'click' then 'unlock_attempt'
            when 'view' then 'location_deviation' when 'signup' then 'connection_lost'
            else 'battery_low' end as event_type,
          case when value >= 148 then 'critical' when value >= 80 then 'high'
            when value >= 35 then 'medium' else 'low' end as severity,
          cast(ts as timestamp) as event_time
        from events""",
    "locks": f"""
        select cast(c_custkey as varchar) as id, {_LOCK} as status, {AS_OF} as last_update
        from customer""",
    "shipments": f"""
        select s_suppkey + 1 as shipment_pk, {_code("s_suppkey + 1")} as shipment_id,
          {_SHIP} as status, {AS_OF} as last_update
        from supplier""",
    "lock_assignments": f"""
        select o_orderkey as id, cast(o_custkey as varchar) as lock_id,
          o_orderkey % {_SUPPLIERS} + 1 as shipment_pk,
          {_later("(o_orderkey * 7919) % 2592000")} as assigned_at,
          case when o_orderstatus = 'O' then null
            else {_later("(o_orderkey * 7919) % 2592000 + (o_orderkey % 72 + 1) * 3600")} end as released_at
        from orders""",
    "moves": f"""
        select event_id as id, cast(user_id as varchar) as lock_id, {_LAT.format("event_id")} as latitude,
          {_LON.format("event_id")} as longitude, cast(ts as timestamp) as update_time
        from events where event_id % 2 = 1""",
    "changes": f"""
        select event_id as id, cast(user_id as varchar) as lock_id, 'status_changed' as action,
          {_pick("cast(floor(event_id / 3) as bigint)", model.LOCK_STATUSES)} as status,
          case when user_id % 3 = 0 then {_code(f"user_id % {_SUPPLIERS} + 1")} end as shipment_id,
          cast(ts as timestamp) as change_time
        from events where event_id % 3 = 0""",
    "locations": """
        select lock_id, arg_max(latitude, (update_time, id)) as latitude,
          arg_max(longitude, (update_time, id)) as longitude
        from moves group by lock_id""",
    "event_types": "select * from (values "
    + _values((kind, category) for kind, category, _ in model.EVENT_TYPE_SEED)
    + ") as t(event_type, category)",
    "days": """
        select cast(strftime(d, '%Y%m%d') as int) as date_key, cast(d as date) as full_date
        from (select unnest(generate_series(timestamp '2024-01-01', timestamp '2027-12-31', interval 1 day)) as d)""",
    "all_days": """
        select unnest(generate_series(timestamp '2024-01-01', timestamp '2024-02-10', interval 1 day)) as day""",
    "trend": """
        select date_trunc('hour', e.event_time) as event_hour, d.full_date as event_date, e.event_type,
          t.category as event_category, e.severity, count(*) as event_count
        from security_events e
        join days d on cast(strftime(e.event_time, '%Y%m%d') as int) = d.date_key
        join event_types t on e.event_type = t.event_type
        group by all""",
    "pairs": """
        select *, lag(change_time) over w as was_at, lag(status) over w as was
        from changes window w as (partition by lock_id order by change_time, id)""",
    "hops": """
        select *, lag(update_time) over w as was_at, lag(latitude) over w as lat0,
          lag(longitude) over w as lon0
        from moves window w as (partition by lock_id order by update_time, id)""",
    "status_log": f"""
        select cast(c_custkey as varchar) as lock_id, 'created' as action, {_LOCK} as status,
          case when c_custkey % 5 <> 0 then {_LAT.format("c_custkey")} end as latitude,
          case when c_custkey % 5 <> 0 then {_LON.format("c_custkey")} end as longitude,
          {_later("(c_custkey * 7919) % 864000")} as change_time, c_custkey * 4 as seq
        from customer
        union all
        select lock_id, action, status, null, null, change_time, id * 4 + 1 from changes""",
    "shipment_log": f"""
        select {_code("s_suppkey + 1")} as shipment_id, 'created' as action, {_SHIP} as status,
          {_later("(s_suppkey * 3571) % 432000")} as change_time, s_suppkey * 2 as seq
        from supplier
        union all
        select {_code("shipment_pk")}, 'status_changed', {_pick("id", model.SHIPMENT_STATUSES)},
          assigned_at, id * 2 + 1
        from lock_assignments""",
    "per_lock_events": """
        select lock_id, count(*) as n, count(*) filter (severity = 'critical') as critical,
          count(*) filter (severity = 'high') as high,
          sum(case severity when 'critical' then 25 when 'high' then 10 when 'medium' then 3 else 1 end) as points,
          max(event_time) as last_event
        from security_events group by lock_id""",
    "health_fan": """
        select s.shipment_id, s.status as shipment_status, count(distinct c.lock_id) as active_locks,
          count(e.id) as total_security_events,
          cast(sum(case when e.severity = 'critical' then 1 else 0 end) as bigint) as critical_events,
          cast(sum(case when e.severity = 'high' then 1 else 0 end) as bigint) as high_events,
          max(e.event_time) as last_security_event, max(m.update_time) as last_location_update,
          cast(greatest(0, 100 - sum(case when e.severity = 'critical' then 25 when e.severity = 'high' then 10
            when e.severity = 'medium' then 3 else 1 end)) as bigint) as health_score
        from shipments s left join changes c on c.shipment_id = s.shipment_id
        left join security_events e on e.lock_id = c.lock_id
        left join moves m on m.lock_id = c.lock_id
        group by s.shipment_id, s.status""",
    "positions_now": """
        select l.id, l.status, p.latitude, p.longitude, l.last_update
        from locks l join locations p on p.lock_id = l.id""",
    "utilization": f"""
        select lock_id, total_assignments, {_half_up('total', '3600 * total_assignments', 2)} as avg_assignment_duration_hours,
          case when observed > 0 then {_half_up('least(total, observed)', 'observed', 4)} else 0.0 end as utilization_rate,
          {_half_up('total', '3600', 2)} as total_assigned_hours, {AS_OF} as calculated_at
        from (
          select lock_id, count(*) as total_assignments, sum(s) as total,
            date_diff('second', min(assigned_at), max(done)) as observed
          from (select lock_id, assigned_at, coalesce(released_at, {AS_OF}) as done,
                  date_diff('second', assigned_at, coalesce(released_at, {AS_OF})) as s
                from lock_assignments)
          group by lock_id)""",
    "placed": """
        select e.*, m.latitude, m.longitude
        from security_events e asof left join moves m
          on e.lock_id = m.lock_id and e.event_time >= m.update_time""",
    "held": """
        select e.*, a.shipment_pk from security_events e left join lock_assignments a
          on a.lock_id = e.lock_id and e.event_time >= a.assigned_at
          and (a.released_at is null or e.event_time < a.released_at)""",
    "ops": f"""
        select lock_id, {_code("shipment_pk")} as shipment_id, true as opens, assigned_at as happened, id * 4 + 2 as seq
        from lock_assignments
        union all
        select lock_id, {_code("shipment_pk")}, false, released_at, id * 4 + 3
        from lock_assignments where released_at is not null""",
    "numbered": """
        select *, row_number() over (partition by lock_id order by happened, seq) as n from ops""",
    "followed": """
        select lock_id, n, happened, shipment_id, opens, opens as takes,
          case when opens then shipment_id end as active
        from numbered where n = 1
        union all
        select o.lock_id, o.n, o.happened, o.shipment_id, o.opens,
          case when o.opens then f.active is null else f.active is not distinct from o.shipment_id end,
          case when o.opens then coalesce(f.active, o.shipment_id)
            when f.active is not distinct from o.shipment_id then null else f.active end
        from followed f join numbered o on o.lock_id = f.lock_id and o.n = f.n + 1""",
    "intervals": """
        select lock_id, shipment_id, happened as assigned_at, released_at
        from (select *, lead(happened) over (partition by lock_id order by n) as released_at from followed where takes)
        where opens""",
    "route_points": "select route, cast(seq as int) as seq, lat, lon from (values "
    + _values((r, s, lat, lon) for r, s, lat, lon in ROUTE_POINTS)
    + ") as t(route, seq, lat, lon)",
    "legs": """
        select *, sum(len) over (partition by route order by seq) as upto, sum(len) over (partition by route) as total
        from (select *, sqrt((lat1 - lat) * (lat1 - lat) + (lon1 - lon) * (lon1 - lon)) as len
              from (select *, lead(lat) over w as lat1, lead(lon) over w as lon1 from route_points
                    window w as (partition by route order by seq)) where lat1 is not null)""",
    "expected": f"""
        select * exclude (leg, hit) replace (route as route),
          lat + coalesce(share, 0) * (lat1 - lat) as expected_lat, lon + coalesce(share, 0) * (lon1 - lon) as expected_lon
        from (select p.*, l.lat, l.lon, l.lat1, l.lon1, l.seq as leg, 1 as hit,
                case when l.len > 0 then (p.progress * l.total - (l.upto - l.len)) / l.len end as share,
                row_number() over (partition by p.id order by l.seq) as pick
              from (select *, {_pick("cast(lock_id as bigint)", list(ROUTES))} as route,
                      (id % 1001) / cast(1000 as double) as progress from moves) p
              join legs l on l.route = p.route and l.upto >= p.progress * l.total)
        where pick = 1""",
}


def _metres(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (
        f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin(radians({lon2} - {lon1}) / 2), 2))"
    )
    return f"(2 * 6371000 * atan2(sqrt({a}), sqrt(1 - {a})))"


def _needed(sql: str) -> list[str]:
    """The views a text uses, directly or through other views, in definition order."""
    found: set[str] = set()
    todo = [sql]
    while todo:
        text = todo.pop()
        for name in VIEWS:
            if name not in found and re.search(rf"\b{name}\b", text):
                found.add(name)
                todo.append(VIEWS[name])
    return [name for name in VIEWS if name in found]


def _with_views(sql: str) -> str:
    views = _needed(sql)
    if not views:
        return sql
    ctes = ",\n".join(f"{name} as ({VIEWS[name]})" for name in views)
    word = "with recursive" if "followed" in views else "with"
    return f"{word} {ctes}\n{sql}"


_WINDOW = "window w as (partition by lock_id order by event_time, id)"
_SINCE = "cast(floor(epoch({0})) as bigint) - cast(floor(epoch({1})) as bigint)"
_SECONDS = lambda later, earlier: _SINCE.format(later, earlier)
_METRES = _metres("lat0", "lon0", "latitude", "longitude")
_HOURS = "((epoch_us(update_time) - epoch_us(was_at)) / 3.6e9)"
_DEPOT = _metres("latitude", "longitude", "-33.5", "-59.5")
_FENCED = f"""
    select * from (select m.id, m.lock_id, f.fence_id, f.radius_m,
        {_metres("m.latitude", "m.longitude", "f.lat", "f.lon")} as metres
      from moves m, (select s_suppkey as fence_id, {_LAT.replace("* 37", "* 61").format("s_suppkey")} as lat,
        {_LON.replace("* 53", "* 87").format("s_suppkey")} as lon, (s_suppkey % 20 + 1) * 1000.0 as radius_m from supplier) f)
    where metres <= radius_m"""
_DISTANCES = f"""
    select lock_id, latitude, longitude, update_time, {_METRES} as metres,
      case when {_HOURS} > 0 then {_METRES} / 1000 / {_HOURS} end as kmh from hops"""
_DELTA = "select lock_id, latitude, longitude, update_time, round(metres, 3) as distance_delta_m, round(kmh, 3) as speed_kmh"
_SLIDING = """
    select start as window_start, start + interval '1 hour' as window_end, count(*) as critical_events
    from (select unnest(generate_series(
            time_bucket(interval '10 minutes', event_time) - interval '50 minutes',
            time_bucket(interval '10 minutes', event_time), interval '10 minutes')) as start
          from security_events where severity = 'critical')
    group by start"""
_LAST_STATUS = f"""
    (select lock_id, arg_max(status, (change_time, id)) as status, max(change_time) as since
     from changes where change_time <= {AS_OF} group by lock_id)"""
_TRENDS = """
    select date_trunc('hour', event_time) as event_hour, event_type, severity, count(*) as event_count
    from security_events"""
_DURATIONS = f"""
    select lock_id, was as previous_status, status as new_status, change_time,
      {_SECONDS("change_time", "was_at")} as duration_seconds
    from pairs"""
_TABLES = {
    "locks": "id",
    "security_events": "id",
    "shipments": "shipment_id",
    "lock_assignments": "id",
    "locations": "lock_id",
    "fact_location_updates": "id",
    "fact_lock_status_changes": "id",
}
_COLUMNS = {
    "locks": 3,
    "security_events": 5,
    "shipments": 4,
    "lock_assignments": 5,
    "locations": 3,
    "fact_location_updates": 5,
    "fact_lock_status_changes": 6,
}
_SOURCE = {"fact_location_updates": "moves", "fact_lock_status_changes": "changes"}


def _counts(columns: bool) -> str:
    extra = lambda t: f", {_COLUMNS[t]} as column_count" if columns else ""
    return " union all ".join(
        f"select '{t}' as table_name, count(*) as row_count{extra(t)} from {_SOURCE.get(t, t)}" for t in _TABLES
    )


def _reference(name: str, child: str, key: str, parent: str, parent_key: str) -> str:
    return f"""
        select '{name}' as reference, count(*) as child_rows,
          count(*) filter ({key} not in (select {parent_key} from {parent})) as orphan_rows
        from {child}"""


def _day_key(ts: str) -> str:
    return f"cast(strftime({ts}, '%Y%m%d') as int)"


def _share(hits: str, name: str, limit: float) -> str:
    return f"""
        select count(*) as locks, count(h.lock_id) as {name}, round(count(h.lock_id) / count(*), 4) as share,
          count(h.lock_id) / count(*) > {limit} as alert
        from locks l left join {hits} h on h.lock_id = l.id"""


def _scd2(log: str, key: str, tie: str) -> str:
    return f"""
        select {key}, status, change_time as effective_from,
          coalesce(lead(change_time) over w, timestamp '9999-12-31 23:59:59') as effective_to,
          lead(change_time) over w is null as is_current
        from (select *, lag(status) over (partition by {key} order by change_time) as was
              from (select {key}, change_time, arg_max(status, {tie}) as status from {log}
                    group by {key}, change_time))
        where was is null or was <> status
        window w as (partition by {key} order by change_time)"""


def _fold(log: str, key: str, order: str, out: str) -> str:
    return f"""
        select c.{key} as {out}, coalesce(s.status, c.status) as status,
          coalesce(s.change_time, c.change_time) as last_update
        from (select * from {log} where action = 'created'
              qualify row_number() over (partition by {key} order by {order}) = 1) c
        left join (
          select s.* from {log} s join {log} c on c.{key} = s.{key} and c.action = 'created'
          where s.action = 'status_changed' and ({", ".join("s." + o for o in order.split(", "))})
            > ({", ".join("c." + o for o in order.split(", "))})
          qualify row_number() over (partition by s.{key}
            order by {", ".join(f"s.{o} desc" for o in order.split(", "))}) = 1) s
        on s.{key} = c.{key}"""


def _health(fan: bool, events: str, label: bool) -> str:
    label_col = (
        """, case when health_score >= 80 then 'HEALTHY' when health_score >= 50 then 'WARNING'
             else 'CRITICAL' end as health_label"""
        if label
        else ""
    )
    if fan:
        return f"select *{label_col} from health_fan"
    return f"""
        select *{label_col} from (
          select s.shipment_id, s.status as shipment_status, count(distinct p.lock_id) as active_locks,
            coalesce(cast(sum(e.n) as bigint), 0) as total_security_events,
            coalesce(cast(sum(e.critical) as bigint), 0) as critical_events,
            coalesce(cast(sum(e.high) as bigint), 0) as high_events,
            max(e.last_event) as last_security_event, max(m.last_position) as last_location_update,
            cast(greatest(0, 100 - coalesce(sum(e.points), 0)) as bigint) as health_score
          from shipments s
          left join (select distinct shipment_id, lock_id from changes) p on p.shipment_id = s.shipment_id
          left join {events} e on e.lock_id = p.lock_id
          left join (select lock_id, max(update_time) as last_position from moves group by lock_id) m
            on m.lock_id = p.lock_id
          group by s.shipment_id, s.status)"""


ORACLES = {
    "table_counts": _counts(columns=True),
    "table_listing": _counts(columns=False),
    "event_type_stats_sql": """
        select event_type, severity, count(*) as total, min(event_time) as first_event, max(event_time) as last_event
        from security_events group by event_type, severity""",
    "with_date_key_counts": f"""
        select {_day_key("event_time")} as date_key, count(*) as event_count from security_events group by 1""",
    "decoded_event_times": "select id, lock_id, date_trunc('millisecond', event_time) as event_time from security_events",
    "insert_ignore": "select id, lock_id from security_events where event_time >= timestamp '2024-01-16'",
    "validate_locations": """
        select case when latitude * 2.7 not between -90 and 90 then 'latitude out of range'
          when longitude * 3.03 not between -180 and 180 then 'longitude out of range' else 'valid' end as reason,
          count(*) as rows
        from moves group by 1""",
    "validate_events": """
        select id as event_id, case when event_type = 'battery_low' then 'unknown event_type'
          else 'unknown severity' end as reason
        from security_events where event_type = 'battery_low' or severity = 'critical'""",
    "fk_valid_events": """
        select lock_id, count(*) as event_count from security_events
        where lock_id in (select id from locks where status <> 'offline') group by lock_id""",
    "fk_orphans": """
        select id, lock_id, 'unknown lock_id' as reason from security_events
        where lock_id not in (select id from locks where status <> 'offline')""",
    "fk_report": " union all ".join(
        [
            _reference(
                "events_to_date",
                f"(select {_day_key('event_time')} as k from security_events)",
                "k",
                "(select date_key from days where full_date between date '2024-01-05' and date '2024-12-31')",
                "date_key",
            ),
            _reference("events_to_type", "security_events", "event_type", "event_types", "event_type"),
            _reference(
                "status_to_date",
                f"(select {_day_key('change_time')} as k from changes)",
                "k",
                "(select date_key from days where full_date between date '2024-01-05' and date '2024-12-31')",
                "date_key",
            ),
            _reference(
                "locations_to_date",
                f"(select {_day_key('update_time')} as k from moves)",
                "k",
                "(select date_key from days where full_date between date '2024-01-05' and date '2024-12-31')",
                "date_key",
            ),
            _reference("locations_to_lock", "moves", "lock_id", "locks", "id"),
        ]
    ),
    "lock_lookup": "select * from positions_now where id = '7'",
    "shipment_lookup": "select * from shipments where shipment_id = 'SHIP0000000003'",
    "events_by_severity": "select * from security_events where severity = 'high'",
    "events_all": "select * from security_events",
    "active_assignments": "select id, lock_id, shipment_pk, assigned_at from lock_assignments where released_at is null",
    "assigned_locks": """
        select id, status from locks
        where id in (select lock_id from lock_assignments where released_at is null)""",
    "compromised_locks": "select id, status from locks where status in ('tampered', 'offline')",
    "events_of_compromised_locks": """
        select id, lock_id, event_type, event_time from security_events
        where lock_id in (select id from locks where status in ('tampered', 'offline'))""",
    "shipment_codes": f"""
        select {_code("shipment_pk")} as shipment_id, count(*) as assignments from lock_assignments group by 1""",
    "event_class": """
        select event_type, severity, count(*) as event_count,
          case when event_type in ('battery_low', 'connection_lost') then 'WARNING' else 'CRITICAL' end as event_class
        from security_events group by event_type, severity""",
    "dim_event_type": """
        select t.category, count(*) as event_count, count(*) filter (e.severity = 'critical') as critical_events
        from security_events e join event_types t on t.event_type = e.event_type group by t.category""",
    "dim_date": f"""
        select d.date_key, cast(d.full_date as varchar) as full_date, cast(year(full_date) as int) as year,
          cast(quarter(full_date) as int) as quarter, cast(month(full_date) as int) as month,
          cast(day(full_date) as int) as day, cast(weekofyear(full_date) as int) as week,
          cast(dayofweek(full_date) as int) as day_of_week, dayofweek(full_date) in (0, 6) as is_weekend,
          coalesce(n, 0) as event_count
        from days d left join (select {_day_key("event_time")} as k, count(*) as n from security_events group by 1)
          on k = d.date_key""",
    "events_by_type_severity": """
        select event_type, severity, count(*) as total_events from security_events group by all""",
    "locks_by_status": "select status, count(*) as locks from locks group by status",
    "status_totals": """
        select count(*) as locks, count(*) filter (status = 'active') as active,
          count(*) filter (status = 'inactive') as inactive, count(*) filter (status = 'tampered') as tampered,
          count(*) filter (status = 'offline') as offline,
          round(avg(case when status in ('tampered', 'offline') then 0.0 else 1.0 end), 4) as ok_share
        from locks""",
    "locks_changed_recently": f"""
        select lock_id, count(*) as changes, arg_max(status, (change_time, id)) as status,
          max(change_time) as last_change
        from changes where change_time >= {AS_OF} - interval 6 hour group by lock_id""",
    "top_locks": """
        select lock_id, count(*) as total_events, count(distinct event_type) as distinct_types,
          max(event_time) as last_event
        from security_events group by lock_id order by total_events desc, lock_id limit 5""",
    "top_incident_locks": """
        select lock_id, count(*) as incidents from security_events where severity in ('high', 'critical')
        group by lock_id order by incidents desc, lock_id limit 10""",
    "lock_positions": "select * from positions_now",
    "event_type_stats": """
        select event_type, severity, count(*) as total, min(event_time) as first_event, max(event_time) as last_event
        from security_events group by event_type, severity""",
    "event_summary": """
        select lock_id, event_type, severity, count(*) as event_count, min(event_time) as first_seen,
          max(event_time) as last_seen
        from security_events group by all""",
    "mv_hourly_event_trend": "select * replace (cast(event_date as varchar) as event_date) from trend",
    "mv_shipment_health": _health(True, "per_lock_events", False),
    "hourly_event_trend": "select * replace (cast(event_date as varchar) as event_date) from trend",
    "recent_hourly_trend": f"{_TRENDS} where event_time > {AS_OF} - interval 30 day group by all",
    "trend_24h": f"select * exclude (event_date) from trend where event_hour >= {AS_OF} - interval 24 hour",
    "daily_severity_30d": f"""
        select cast(d.full_date as varchar) as full_date, e.severity, count(*) as event_count
        from security_events e join days d on {_day_key("e.event_time")} = d.date_key
        where d.full_date >= cast({AS_OF} as date) - interval 30 day group by all""",
    "top_types_7d": f"""
        select e.event_type, t.category, e.severity, count(*) as event_count,
          count(distinct e.lock_id) as affected_locks
        from security_events e join event_types t on t.event_type = e.event_type
        where e.event_time >= {AS_OF} - interval 7 day group by all""",
    "heatmap": """
        select cast(hour(event_time) as int) as hour_of_day, cast(dayofweek(event_time) as int) as day_of_week,
          severity, count(*) as event_count
        from security_events group by all""",
    "critical_spikes": """
        select event_hour, critical_count, round(a, 2) as rolling_avg_24h, round(critical_count / a, 2) as spike_ratio
        from (select *, avg(critical_count) over (order by event_hour rows between 24 preceding and 1 preceding) as a
              from (select date_trunc('hour', event_time) as event_hour, count(*) as critical_count
                    from security_events where severity = 'critical' group by 1))
        where critical_count > 2 * coalesce(a, 0) and a > 0""",
    "event_severity_rollup": f"""
        select *, {_day_key("event_hour")} as date_key, {AS_OF} as calculated_at from ({_TRENDS} group by all)""",
    "agg_hourly_event_counts": f"""
        select {_day_key("event_time")} as date_key, cast(hour(event_time) as int) as hour, event_type, severity,
          count(*) as event_count
        from security_events group by all""",
    "events_per_minute": f"""
        select date_trunc('minute', event_time) as minute, count(*) as event_count from security_events
        where event_time >= {AS_OF} - interval 6 hour group by 1""",
    "lateness": """
        select severity, count(*) as event_count, count(*) filter (late > 0) as late_events,
          count(*) filter (late > 600) as beyond_watermark, max(late) as max_late_seconds
        from (select severity, case when cast(id as bigint) % 20 = 0 then 60 + cast(id as bigint) % 841 else 0 end as late
              from security_events)
        group by severity""",
    "latest_event_per_lock": """
        select lock_id, event_type, severity, event_time from security_events
        qualify row_number() over (partition by lock_id order by event_time desc, id desc) = 1""",
    "time_between_events": f"""
        select lock_id, event_type, event_time, prev_event_type, {_SECONDS("event_time", "was_at")} as seconds_since_prev
        from (select *, lag(event_type) over w as prev_event_type, lag(event_time) over w as was_at
              from security_events {_WINDOW})
        where was_at is not null""",
    "running_totals": f"""
        select lock_id, event_time, event_type, severity, row_number() over w as event_num,
          count(*) over (w rows unbounded preceding) as running_total,
          cast(sum(case when severity = 'critical' then 1 else 0 end) over (w rows unbounded preceding) as bigint)
            as running_critical
        from security_events {_WINDOW}""",
    "rank_locks": """
        select lock_id, total_events, rank() over (order by total_events desc) as rank,
          dense_rank() over (order by total_events desc) as dense_rank
        from (select lock_id, count(*) as total_events from security_events group by lock_id)""",
    "event_sequences": f"""
        select lock_id, event_type, event_time, next_event_type, {_SECONDS("next_at", "event_time")} as seconds_to_next
        from (select *, lead(event_type) over w as next_event_type, lead(event_time) over w as next_at
              from security_events {_WINDOW})
        where next_event_type is not null""",
    "attack_pattern": f"""
        select lock_id, event_type, event_time, next_event_type, {_SECONDS("next_at", "event_time")} as seconds_to_next
        from (select *, lead(event_type) over w as next_event_type, lead(event_time) over w as next_at
              from security_events {_WINDOW})
        where event_type = 'tamper_detected' and next_event_type = 'unlock_attempt'""",
    "sliding_3": f"""
        select lock_id, event_time, event_type, severity,
          count(*) over (w rows 2 preceding) as events_in_window,
          cast(sum(case when severity = 'critical' then 1 else 0 end) over (w rows 2 preceding) as bigint)
            as critical_in_last_3
        from security_events {_WINDOW}""",
    "event_window_sql": f"""
        select lock_id, event_type, severity, event_time, row_number() over w as event_num,
          lag(event_type) over w as prev_event, lead(event_type) over w as next_event,
          cast(sum(case when severity = 'critical' then 1 else 0 end) over (w rows unbounded preceding) as bigint)
            as running_critical,
          count(*) over (w rows 2 preceding) as count_last_3
        from security_events {_WINDOW}""",
    "events_last_hour_range": """
        select lock_id, id, event_type, event_time,
          count(*) over (partition by lock_id order by cast(floor(epoch(event_time)) as bigint)
            range between 3600 preceding and current row) as events_last_hour
        from security_events""",
    "events_last_day_range": """
        select lock_id, id, event_type, event_time,
          count(*) over (partition by lock_id order by cast(floor(epoch(event_time)) as bigint)
            range between 86400 preceding and current row) as events_last_day
        from security_events""",
    "shipment_health": _health(True, "per_lock_events", False),
    "shipment_health_dedup": _health(False, "per_lock_events", False),
    "shipment_health_dashboard": _health(True, "per_lock_events", True),
    "shipment_health_labels": _health(False, "per_lock_events", True),
    "shipment_event_detail": """
        select e.id as event_id, e.lock_id, e.event_type, t.category, e.severity, e.event_time, e.latitude, e.longitude
        from placed e join event_types t on t.event_type = e.event_type
        join changes c on c.lock_id = e.lock_id and c.shipment_id = 'SHIP0000000004'
        order by e.event_time desc, e.id limit 100""",
    "api_shipment_health": f"""
        select s.shipment_id, count(distinct l.id) as total_locks,
          count(distinct case when l.status in ('tampered', 'offline') then l.id end) as compromised_locks,
          count(distinct case when e.event_type in ('unlock_attempt', 'tamper_detected', 'location_deviation')
            then e.id end) as critical_events_last_hour,
          case when count(case when e.event_type in ('unlock_attempt', 'tamper_detected', 'location_deviation') then 1 end) > 0
              then 'critical'
            when count(case when e.event_type in ('battery_low', 'connection_lost') then 1 end) > 0 then 'warning'
            else 'ok' end as overall_status
        from shipments s join lock_assignments a on a.shipment_pk = s.shipment_pk and a.released_at is null
        join locks l on l.id = a.lock_id
        left join security_events e on e.lock_id = l.id and l.status in ('tampered', 'offline')
          and e.event_time > {AS_OF} - interval 1 hour
        group by s.shipment_id""",
    "mv_shipment_health_doc": f"""
        select a.shipment_pk, count(distinct a.lock_id) as total_locks,
          count(distinct case when l.status in ('tampered', 'offline') then l.id end) as compromised_locks,
          count(case when e.severity in ('critical', 'high') and e.event_time > {AS_OF} - interval 1 hour then 1 end)
            as critical_events_last_hour,
          case when count(case when e.event_type in ('unlock_attempt', 'tamper_detected', 'location_deviation')
                and e.event_time > {AS_OF} - interval 1 hour then 1 end) > 0 then 'critical'
            when count(case when e.event_type in ('battery_low', 'connection_lost')
                and e.event_time > {AS_OF} - interval 1 hour then 1 end) > 0 then 'warning'
            else 'ok' end as overall_status,
          {AS_OF} as computed_at
        from lock_assignments a join locks l on l.id = a.lock_id
        left join security_events e on e.lock_id = a.lock_id
        where a.released_at is null group by a.shipment_pk""",
    "daily_shipment_summary": f"""
        select s.shipment_id, s.status, coalesce(t.n, 0) as total_events, coalesce(t.critical, 0) as critical_events,
          coalesce(c.locks, 0) as locks_count, s.last_update, cast(cast({AS_OF} as date) as varchar) as summary_date
        from shipments s
        left join (select a.shipment_pk, count(*) as n, count(*) filter (e.severity = 'critical') as critical
                   from security_events e join lock_assignments a on a.lock_id = e.lock_id group by 1) t
          on t.shipment_pk = s.shipment_pk
        left join (select shipment_pk, count(distinct lock_id) as locks from lock_assignments group by 1) c
          on c.shipment_pk = s.shipment_pk""",
    "daily_shipment_summary_pit": f"""
        select s.shipment_id, s.status, coalesce(t.n, 0) as total_events, coalesce(t.critical, 0) as critical_events,
          coalesce(c.locks, 0) as locks_count, s.last_update, cast(cast({AS_OF} as date) as varchar) as summary_date
        from shipments s
        left join (select shipment_pk, count(*) as n, count(*) filter (severity = 'critical') as critical
                   from held where shipment_pk is not null group by 1) t
          on t.shipment_pk = s.shipment_pk
        left join (select shipment_pk, count(distinct lock_id) as locks from lock_assignments group by 1) c
          on c.shipment_pk = s.shipment_pk""",
    "daily_shipment_facts": f"""
        select date_key, shipment_pk, cast(sum(a) as bigint) as total_events, cast(sum(b) as bigint) as critical_events,
          cast(sum(c) as bigint) as warning_events, cast(sum(d) as bigint) as status_changes,
          cast(sum(e) as bigint) as compromised_locks, cast(sum(f) as bigint) as total_locks,
          cast(sum(g) as bigint) as time_in_transit_min
        from (
          select {_day_key("event_time")} as date_key, shipment_pk, count(*) as a,
            count(*) filter (severity = 'critical') as b,
            count(*) filter (event_type in ('battery_low', 'connection_lost')) as c, 0 as d, 0 as e, 0 as f, 0 as g
          from held where shipment_pk is not null group by 1, 2
          union all
          select {_day_key("h.change_time")}, a.shipment_pk, 0, 0, 0, count(*),
            count(distinct case when h.status in ('tampered', 'offline') then h.lock_id end), 0, 0
          from changes h join lock_assignments a on a.lock_id = h.lock_id and h.change_time >= a.assigned_at
            and (a.released_at is null or h.change_time < a.released_at)
          group by 1, 2
          union all
          select {_day_key("day")}, shipment_pk, 0, 0, 0, 0, 0, count(distinct lock_id), 0
          from lock_assignments join all_days on day < coalesce(released_at, {AS_OF})
            and day + interval 1 day > assigned_at
          group by 1, 2
          union all
          select {_day_key("day")}, s.shipment_pk, 0, 0, 0, 0, 0, 0,
            sum({_SECONDS("least(until, day + interval 1 day)", "greatest(effective_from, day)")}) // 60
          from (select *, least(effective_to, {AS_OF}) as until from ({_scd2("shipment_log", "shipment_id", "seq")})
                where status = 'in_transit') h
          join all_days on day < until and day + interval 1 day > effective_from
          join shipments s on s.shipment_id = h.shipment_id
          where effective_from < until
          group by 1, 2)
        group by 1, 2""",
    "lock_utilization": "select * from utilization",
    "utilization_histogram": """
        select least(cast(floor(utilization_rate * 10) as bigint) + 1, 10) as bucket, count(*) as locks
        from utilization group by 1""",
    "critical_events_per_shipment": """
        select s.shipment_id, count(distinct a.lock_id) as total_locks, count(e.id) as total_events,
          cast(sum(case when e.severity = 'critical' then 1 else 0 end) as bigint) as critical_events
        from shipments s join lock_assignments a on a.shipment_pk = s.shipment_pk
        left join security_events e on e.lock_id = a.lock_id group by s.shipment_id""",
    "compromised_recent": f"""
        select l.id as lock_id, l.status, count(e.id) as events_last_hour,
          coalesce(string_agg(distinct e.event_type, ',' order by e.event_type), '') as event_types
        from locks l left join security_events e on e.lock_id = l.id and e.event_time > {AS_OF} - interval 1 hour
        where l.status in ('tampered', 'offline') group by l.id, l.status""",
    "lock_mtbf": f"""
        select lock_id, count(*) as failures,
          round(case when count(*) > 1 then ({_SECONDS("max(event_time)", "min(event_time)")}) / (count(*) - 1) end, 2)
            as mtbf_seconds
        from security_events where event_type = 'tamper_detected' group by lock_id""",
    "asof_location": "select id, lock_id, event_time, latitude, longitude from placed",
    "event_shipment_pit": "select id, lock_id, event_time, shipment_pk from held",
    "geo_heatmap": """
        select cast(floor(latitude / 0.1) as bigint) as lat_cell, cast(floor(longitude / 0.1) as bigint) as lon_cell,
          count(*) as critical_events
        from placed where severity = 'critical' and latitude is not null group by all""",
    "current_locks": _fold("status_log", "lock_id", "change_time, seq", "id"),
    "current_locks_by_arrival": _fold("status_log", "lock_id", "seq", "id"),
    "current_locations": """
        select c.lock_id, coalesce(u.latitude, c.latitude) as latitude, coalesce(u.longitude, c.longitude) as longitude
        from (select * from status_log where action = 'created') c
        left join (
          select m.* from moves m join status_log c on c.lock_id = m.lock_id and c.action = 'created'
          where (m.update_time, m.id * 4 + 1) > (c.change_time, c.seq)
          qualify row_number() over (partition by m.lock_id order by m.update_time desc, m.id desc) = 1) u
        on u.lock_id = c.lock_id
        where u.lock_id is not null or c.latitude is not null""",
    "current_shipments": _fold("shipment_log", "shipment_id", "change_time, seq", "shipment_id"),
    "security_events_from_log": """
        select * from security_events where lock_id in (select id from locks where status <> 'inactive')""",
    "previous_status": "select id, lock_id, status, was as previous_status, change_time from pairs",
    "assignments_from_log": "select * from intervals",
    "dim_lock_assignment": """
        select (released_at is null) as is_active, count(*) as assignments, count(distinct lock_id) as locks
        from intervals group by 1""",
    "scd2_lock": _scd2("changes", "lock_id", "id"),
    "scd2_shipment": _scd2("shipment_log", "shipment_id", "seq"),
    "scd2_incremental": _scd2("changes", "lock_id", "id"),
    "merge_dimension_parts": """
        select l.id, coalesce(c.status, l.status) as status
        from locks l full join (select lock_id, arg_max(status, (change_time, id)) as status
                                from changes group by lock_id) c on c.lock_id = l.id""",
    "merge_dimension": """
        select l.id, coalesce(c.status, l.status) as status
        from locks l full join (select lock_id, arg_max(status, (change_time, id)) as status
                                from changes group by lock_id) c on c.lock_id = l.id""",
    "status_durations": _DURATIONS,
    "time_in_status": f"""
        select lock_id, status, cast(sum({_SECONDS(f"coalesce(until, {AS_OF})", "change_time")}) as bigint)
          as seconds_in_status, count(*) as periods
        from (select *, lead(change_time) over (partition by lock_id order by change_time, id) as until from changes)
        group by lock_id, status""",
    "anomalous_transitions": f"{_DURATIONS} where was = 'active' and status = 'tampered'",
    "haversine": f"select id, round({_DEPOT}, 3) as distance_m from moves",
    "distance_delta": f"{_DELTA} from ({_DISTANCES})",
    "speeding": f"{_DELTA} from ({_DISTANCES}) where kmh > 20",
    "geofence_breaches": f"select id, lock_id, round({_DEPOT}, 3) as distance_m from moves where {_DEPOT} > 50000",
    "trajectory": f"""{_DELTA} from ({_DISTANCES})
        where lock_id = '3' and update_time >= timestamp '2024-01-10' and update_time < timestamp '2024-01-20'""",
    "route_position": """
        select id, route, progress, round(expected_lat, 6) as expected_lat, round(expected_lon, 6) as expected_lon
        from expected""",
    "route_deviation": f"""
        select lock_id, update_time, round(m, 3) as distance_m, 'location_deviation' as event_type, 'high' as severity
        from (select *, {_metres("latitude", "longitude", "expected_lat", "expected_lon")} as m from expected)
        where m > 500""",
    "battery_crossings": """
        select lock_id, threshold, arg_min(ts, (ts, event_id)) as reading_time,
          arg_min(battery_pct, (ts, event_id)) as battery_pct,
          case threshold when 20 then 'medium' when 10 then 'high' else 'critical' end as severity
        from (select cast(user_id as varchar) as lock_id, event_id, cast(ts as timestamp) as ts,
                cast((event_id * 7919 + user_id) % 101 as int) as battery_pct,
                unnest([20, 10, 5]) as threshold from events)
        where battery_pct <= threshold group by lock_id, threshold""",
    "incident_bursts": """
        select lock_id, id, event_time, events_in_window
        from (select *, count(*) over (partition by lock_id order by cast(floor(epoch(event_time)) as bigint)
                range between 86400 preceding and current row) as events_in_window
              from security_events where event_type in ('tamper_detected', 'unlock_attempt')
                and severity in ('high', 'critical'))
        where events_in_window >= 3""",
    "geofence_table": f"select id, lock_id, fence_id from ({_FENCED})",
    "geofence_outside": f"select id, lock_id from moves where id not in (select id from ({_FENCED}))",
    "rolling_affected": """select * from (
        with daily as (select distinct event_type, lock_id, cast(event_time as date) as day from security_events),
        days as (select event_type, unnest(generate_series(min(day), max(day), interval 1 day))::date as day
                 from daily group by event_type)
        select d.event_type, cast(d.day as varchar) as day, count(distinct e.lock_id) as affected_locks
        from days d left join daily e on e.event_type = d.event_type and e.day <= d.day and e.day > d.day - 7
        group by d.event_type, d.day)""",
    "incident_sessions": _SESSIONS,
    "stream_incident_sessions": _SESSIONS,
    "alert_tamper": f"""
        select lock_id, count(*) as tamper_events, max(event_time) as last_event from security_events
        where event_type = 'tamper_detected' and event_time > {AS_OF} - interval 6 hour group by lock_id""",
    "alert_mass_offline": _share(
        f"(select lock_id from {_LAST_STATUS} where status = 'offline' and since >= {AS_OF} - interval 12 hour)",
        "offline_locks",
        0.01,
    ),
    "alert_critical_burst": f"select * from ({_SLIDING}) where critical_events > 2",
    "alert_battery": _share(
        f"""(select distinct lock_id from security_events where event_type = 'battery_low'
             and event_time >= {AS_OF} - interval 1 day)""",
        "battery_low_locks",
        0.2,
    ),
    "alert_long_offline": f"""
        select lock_id, since as offline_since, {_SECONDS(AS_OF, "since")} as offline_seconds
        from {_LAST_STATUS} where status = 'offline' and since < {AS_OF} - interval 30 minute""",
    "stream_fact_events": f"""
        select id as event_id, lock_id, event_type, severity, event_time, {_day_key("event_time")} as date_key
        from security_events""",
    "stream_fact_accounting": """
        select 'valid' as verdict, count(*) as row_count from security_events
        union all
        select 'repeated', count(*) from security_events where id::bigint % 20 = 0 having count(*) > 0""",
    "stream_fact_retries": """
        select case when known <= greatest(batch, least(batch + 2, 3)) then 'valid'
                 when batch + 2 <= 3 then 'rejected' else 'waiting' end as verdict, count(*) as row_count
        from (select e.id::bigint % 4 as batch, coalesce(l.id::bigint % 6, 99) as known
              from security_events e left join locks l on l.id = e.lock_id)
        group by verdict""",
    "stream_fact_status": f"""
        select lock_id, action, status, cast(null as varchar) as previous_status, cast(null as double) as latitude,
          cast(null as double) as longitude, shipment_id, change_time, {_day_key("change_time")} as date_key
        from changes""",
    "stream_fact_locations": f"""
        select lock_id, latitude, longitude, update_time, {_day_key("update_time")} as date_key from moves""",
    "stream_hourly_trend": f"{_TRENDS} group by all",
    "stream_sliding_critical": _SLIDING,
    "stream_status_durations": _DURATIONS,
    "stream_distance_delta": f"{_DELTA} from ({_DISTANCES})",
    "stream_enriched_events": """
        select e.id, e.lock_id, e.event_type,
          case when e.event_type in ('battery_low', 'connection_lost') then 'WARNING' else 'CRITICAL' end as event_class,
          l.status as lock_status, e.event_time
        from security_events e left join locks l on l.id = e.lock_id""",
    "stream_assignments": "select * from intervals",
    "stream_alert_tamper": f"""
        select lock_id, min(t) as raised_at, max(t) + interval 6 hour as withdrawn_at, count(*) as tamper_events
        from ({_islands("(select lock_id, id, event_time as t from security_events where event_type = 'tamper_detected')", "6 hour")})
        group by lock_id, island""",
    "stream_alert_long_offline": f"""
        select lock_id, change_time as offline_since, change_time + interval 30 minute as raised_at, next as withdrawn_at
        from {_NEXT_STATUS} where status = 'offline' and (next is null or next > change_time + interval 30 minute)""",
    "stream_alert_mass_offline": _flips(
        f"""(select change_time as low, least(coalesce(next, change_time + interval 12 hour), change_time + interval 12 hour) as high
             from {_NEXT_STATUS} where status = 'offline')""",
        "offline_locks",
        0.008,
    ),
    "stream_alert_battery": _flips(
        f"""(select min(t) as low, max(t) + interval 1 day as high
             from ({_islands("(select lock_id, id, event_time as t from security_events where event_type = 'battery_low')", "1 day")})
             group by lock_id, island)""",
        "battery_low_locks",
        0.04,
    ),
}


def registered() -> dict[str, str]:
    return {name: _with_views(sql) for name, sql in ORACLES.items()}
