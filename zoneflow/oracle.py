"""The same queries as SQL for an independent engine, on the same tables."""

from __future__ import annotations

ZONES = "('click', 'purchase', 'signup', 'view')"
AS_OF = "timestamp '2024-01-31 00:00:00'"
CUT = "timestamp '2024-01-26 00:00:00'"

# Each view may use the ones before it.
VIEWS = {
    "load_area": """
        select date_trunc('hour', ts) + interval 1 hour as time, event_type as zone, user_id % 4 as load_area,
               round(value * 100) as mw, event_id % 7 <> 0 as is_verified from events""",
    "load_pjm": """
        select time, zone, 'pjm' as source, sum(mw) as demand_mw, cast(null as double) as demand_forecast_mw,
               cast(null as double) as net_generation_mw, cast(null as double) as total_interchange_mw,
               bool_and(is_verified) as is_verified from load_area group by time, zone""",
    "load_eia": """
        select time, 'RTO' as zone, 'eia' as source, sum(mw) as demand_mw, sum(mw) + 1000 as demand_forecast_mw,
               sum(mw) - 1000 as net_generation_mw, -500.0::double as total_interchange_mw,
               cast(null as boolean) as is_verified from load_area group by time""",
    "load_all": "select * from load_pjm union all select * from load_eia",
    "lmp_msgs": """
        select event_id as offset_id, date_trunc('hour', ts) + interval 1 hour as time,
               concat(event_type, '-', cast(user_id % 4 as varchar)) as pnode_id,
               case when event_id % 3 <> 0 then 'node ' || event_type end as pnode_name, event_type as zone,
               round(value * 100) as lmp, cast(user_id % 40 as double) as congestion_price,
               cast(event_id % 10 as double) as marginal_loss_price from events""",
    "lmp": """
        select * exclude (offset_id) from lmp_msgs
        qualify row_number() over (partition by time, pnode_id order by offset_id desc) = 1""",
    "weather": """
        select ts as time, event_type as zone,
               cast(cast(regexp_extract(props, '([0-9]+)', 1) as int) - 20 as double) as temperature,
               cast(event_id % 10 as double) as precipitation, cast(user_id % 40 as double) as wind_speed,
               cast(cast(regexp_extract(props, '([0-9]+)', 1) as int) as double) as cloud_cover from events""",
    "stations": """
        select date_trunc('hour', ts) + to_minutes(cast(minute(ts) - minute(ts) % 20 as int)) as poll,
               event_type as zone, user_id % 3 as station, date_trunc('second', ts) as time,
               round(value * 100) as temperature, cast(event_id % 10 as double) as precipitation,
               cast(user_id % 40 as double) as wind_speed, cast(event_id % 100 as double) as cloud_cover from events""",
    "zone_dim": f"""
        select distinct event_type as zone_id, concat('s', cast(user_id % 3 as varchar)) as city
        from events where event_type in {ZONES}""",
    "stg_lmp": f"select * rename (lmp as lmp_total) from lmp where zone in {ZONES}",
    "stg_weather": f"select * from weather where zone in {ZONES}",
    "base": f"select time, zone, demand_mw from load_all where source = 'pjm' and zone in {ZONES}",
    "numbered": "select *, row_number() over (partition by zone order by time) as nr from base",
    "load_features": """
        select r.time, r.zone, r.demand_mw, three.demand_mw as demand_lag_72h, seven.demand_mw as demand_lag_168h,
               (select sum(x.demand_mw) / count(*) from base x where x.zone = r.zone
                and r.time - x.time between interval 72 hours and interval 78 hours) as demand_roll_6h,
               (select sum(x.demand_mw) / count(*) from base x where x.zone = r.zone
                and r.time - x.time between interval 72 hours and interval 96 hours) as demand_roll_24h
        from numbered r
        left join numbered three on three.zone = r.zone and three.nr + 72 = r.nr
        left join numbered seven on seven.zone = r.zone and seven.nr + 168 = r.nr""",
    "lmp_features": f"""
        select time, zone, sum(lmp) / count(lmp) as lmp_total,
               sum(congestion_price) / count(congestion_price) as congestion_price,
               sum(marginal_loss_price) / count(marginal_loss_price) as marginal_loss_price
        from lmp group by all having zone in {ZONES}""",
    "weather_features": f"""
        select time_bucket(interval 1 hour, time) + interval 1 hour as time, zone,
               sum(temperature) / count(temperature) as temperature,
               sum(precipitation) / count(precipitation) as precipitation,
               sum(wind_speed) / count(wind_speed) as wind_speed, sum(cloud_cover) / count(cloud_cover) as cloud_cover,
               count(*) as observation_count
        from weather group by all having zone in {ZONES}""",
    "prices_later": """
        select time + interval 48 hours as time, zone, lmp_total as lmp_total_lag_48h,
               congestion_price as congestion_price_lag_48h, marginal_loss_price as marginal_loss_price_lag_48h
        from lmp_features""",
    "features": """
        select * from load_features left join prices_later using (zone, time)
        left join weather_features using (zone, time)""",
    "latest": "select * from features qualify row_number() over (partition by zone order by time desc) = 1",
    "preds": """
        select time, zone, demand_lag_72h as y_1h, round(demand_roll_24h) as y_24h, demand_lag_168h as y_72h,
               temperature, precipitation, wind_speed, cloud_cover from latest""",
    "win": f"select * from features where time >= {AS_OF} - interval 144 hours",
    "win_long": """
        select time + interval 1 hour as time, zone, 1 as horizon_h, demand_lag_72h as predicted_mw from win
        union all select time + interval 24 hours, zone, 24, round(demand_roll_24h) from win
        union all select time + interval 72 hours, zone, 72, demand_lag_168h from win""",
    "hist": """
        select p.time, p.zone, p.horizon_h, a.demand_mw as actual_mw, p.predicted_mw
        from win_long p left join win a on a.time = p.time and a.zone = p.zone""",
    "peaks": f"""
        select zone, max(demand_mw) as peak_mw from features where time >= {AS_OF} - interval 30 days group by zone""",
    "labels": """
        select *, lead(demand_mw, 1) over w as y_1h, lead(demand_mw, 24) over w as y_24h,
               lead(demand_mw, 72) over w as y_72h
        from load_features window w as (partition by zone order by time)""",
    "labelled": """
        select *, case when time >= (select max(time) from k) - interval 7 days then 'test'
                       when time >= (select max(time) from k) - interval 14 days then 'val' else 'train' end as split
        from k""",
    "scored": """
        select time, zone, split, 1 as horizon_h, y_1h as actual, demand_lag_72h as pred from labelled
        union all select time, zone, split, 24, y_24h, round(demand_roll_24h) from labelled
        union all select time, zone, split, 72, y_72h, demand_lag_168h from labelled""",
    "order_hours": """
        select o_orderkey as row_id, o_orderdate + to_hours(cast(o_orderkey % 24 as int)) as time,
               round(o_totalprice % 60 - 20) as temperature, o_orderstatus as zone, round(o_totalprice) as demand_mw,
               ((o_orderdate + to_hours(cast(o_orderkey % 24 as int))) at time zone 'UTC') at time zone 'US/Eastern'
                   as eastern
        from orders""",
    "messages": """
        select event_type as key, event_id as "offset", date_trunc('hour', ts) + interval 1 hour as time,
               event_type as zone, 'pjm' as source, round(value * 100) as demand_mw,
               case when event_id % 2 = 0 then cast(user_id as double) end as demand_forecast_mw,
               event_id % 7 <> 0 as is_verified,
               case when event_id % 11 = 10 then 11 when event_id % 13 = 12 then 13 when event_id % 17 = 16 then 17
                    when event_id % 19 = 18 then 19 when event_id % 23 = 22 then 23 when event_id % 29 = 28 then 29
                    when event_id % 31 = 30 then 31 when event_id % 37 = 36 then 37 when event_id % 41 = 40 then 41
                    when event_id % 43 = 42 then 43 else 0 end as fault from events""",
    "message_rows": """
        select time, zone, source, case when fault = 31 then 12.5::double else demand_mw end as demand_mw,
               demand_forecast_mw, cast(null as double) as net_generation_mw,
               cast(null as double) as total_interchange_mw,
               case when fault <> 23 then is_verified end as is_verified, "offset"
        from messages where fault not in (11, 13, 17, 19, 37, 41, 43)""",
    "grid": """
        select zone, unnest(generate_series(a, b - interval 1 hour, interval 1 hour)) as time
        from (select event_type as zone, date_trunc('hour', min(ts)) as a, date_trunc('hour', max(ts)) as b
              from events group by 1)""",
    "temps": """
        select time, zone, city, avg(t) as temperature
        from (select date_trunc('hour', ts) as time, event_type as zone,
                     concat('s', cast(user_id % 3 as varchar)) as city, round(value * 100) % 40 as t from events)
        group by time, zone, city""",
    "masks": """
        select zone, m as mask, bit_count(m)::int as n, x.stations
        from (select zone, list_sort(list(distinct city)) as cities from temps group by zone) z,
             lateral (select unnest(range(1, (1 << len(cities))::bigint)) as m) g,
             lateral (select array_to_string(list_filter(cities, lambda c, i: (g.m >> (i - 1)) & 1 = 1), ' + ')
                      as stations) x""",
    "rings": """
        select s_suppkey as entity, 'N' || s_nationkey as name,
               (s_suppkey * 37) % 211 + (s_suppkey // 1000) * 250 as cx, (s_suppkey * 53) % 199 as cy,
               3 + s_suppkey % 11 as r from supplier""",
    # a diamond holds the centres whose city-block distance from its middle is below r
    "cells": """
        select entity, cell_x, cell_y from (
            select *, unnest(range(cx - r, cx + r)) as cell_x from rings) a,
            lateral (select unnest(range(a.cy - a.r, a.cy + a.r)) as cell_y) b
        where abs(cell_x + 0.5 - cx) + abs(cell_y + 0.5 - cy) < r
           or (abs(cell_x + 0.5 - cx) + abs(cell_y + 0.5 - cy) = r and cell_x + 0.5 < cx)""",
    "areas": "select entity, cast(count(*) as double) as area_km2 from cells group by entity",
    "known": """
        select r.entity, r.name, l.zone_id, a.area_km2 from rings r
        left join (select 'N' || n_nationkey as name, 'Z' || n_regionkey as zone_id from nation
                   where n_nationkey % 3 <> 0) l using (name) join areas a using (entity)""",
    "zone_cells": """
        select distinct k.zone_id, c.cell_x, c.cell_y from cells c join known k using (entity)
        where k.zone_id is not null""",
    "minor": "select * from known where zone_id is null and area_km2 < 150",
    "overlapped": """
        select entity, arg_min(zone_id, (-n, zone_id)) as zone_id from (
            select m.entity, z.zone_id, count(*) as n from minor m join cells c using (entity)
            join zone_cells z using (cell_x, cell_y) group by 1, 2) group by entity""",
    "nearest": """
        select entity, arg_min(zone_id, (d2, zone_id)) as zone_id from (
            select m.entity, z.zone_id, (c.cell_x - z.cell_x) ** 2 + (c.cell_y - z.cell_y) ** 2 as d2
            from minor m join cells c using (entity)
            join zone_cells z on z.cell_x between c.cell_x - 3 and c.cell_x + 3
                             and z.cell_y between c.cell_y - 3 and c.cell_y + 3
            where m.entity not in (select entity from overlapped))
        where d2 <= 9 group by entity""",
    "owners": """
        select entity, zone_id, area_km2 from known where zone_id is not null
        union all
        select m.entity, coalesce(o.zone_id, n.zone_id), m.area_km2 from minor m
        left join overlapped o using (entity) left join nearest n using (entity)
        where coalesce(o.zone_id, n.zone_id) is not null""",
    "owned": """
        select o.zone_id, o.entity, c.cell_x, c.cell_y from cells c join owners o using (entity)
        where (c.cell_x + c.cell_y) % 50 <> 0
        qualify row_number() over (partition by c.cell_x, c.cell_y order by o.area_km2, o.entity) = 1""",
}

# The labelled rows that have their longest lag: what "labelled" above is built from.
LABELLED_INPUT = "select * from labels where demand_lag_168h is not null"


def _regressed() -> dict[str, str]:
    """Rows of each station subset with hour, weekdays and degree hours taken out of demand, one after the other."""
    out = {
        "subset_rows": """
        select zone, mask, n, stations, hour(time) as hod, y, y as demand, greatest(f - 65, 0) as c, greatest(65 - f, 0) as h, """
        + ", ".join(f"(isodow(time) = {k + 1})::double as day{k}" for k in range(7))
        + """ from (select m.zone, m.mask::int as mask, m.n, m.stations, l.time, l.demand_mw as y, avg(t.temperature) * 9 / 5 + 32 as f
                   from temps t join masks m on m.zone = t.zone and list_contains(string_split(m.stations, ' + '), t.city)
                   join load_pjm l on l.zone = t.zone and l.time = t.time + interval 1 hour
                   group by m.zone, m.mask, m.n, m.stations, l.time, l.demand_mw)"""
    }
    left = [*[f"day{k}" for k in range(7)], "c", "h", "y"]
    kept = "zone, mask, n, stations, demand"
    out["without_hour"] = f"select {kept}, " + ", ".join(f"{v} - avg({v}) over (partition by zone, mask, hod) as {v}" for v in left) + " from subset_rows"
    before = "without_hour"
    while len(left) > 1:
        gone, *left = left
        marks = ", given_marks" if gone == "h" else ", y as given_marks" if gone == "c" else ""
        share = f"coalesce(sum({gone} * {{v}}) over g / nullif(if(sum({gone} * {gone}) over g > 1e-9, sum({gone} * {gone}) over g, 0), 0), 0)"
        rest = ", ".join(f"{v} - {gone} * {share.format(v=v)} as {v}" for v in left)
        out[f"without_{gone}"] = f"select {kept}, {rest}{marks} from {before} window g as (partition by zone, mask)"
        before = f"without_{gone}"
    out["subset_scores"] = f"""
        select zone, mask, n, stations, case when sum(given_marks * given_marks) > 1e-12 * sum(demand * demand)
               then 1 - sum(y * y) / sum(given_marks * given_marks) end as partial_r2 from {before} group by all"""
    return out


VIEWS |= _regressed()


def _sql(names: str, body: str) -> str:
    """`body` over the named views and whatever they use."""
    wanted: list[str] = []

    def need(name: str) -> None:
        if name in wanted:
            return
        for other in VIEWS:
            if other != name and _mentions(VIEWS[name], other):
                need(other)
        if name == "labelled":
            need("labels")
            wanted.append("k")
        wanted.append(name)

    for n in names.split():
        need(n)
    ctes = [f"{n} as ({LABELLED_INPUT if n == 'k' else VIEWS[n]})" for n in wanted]
    return f"with {', '.join(ctes)} {body}" if ctes else body


def _revised() -> str:
    """The wide table over raw tables in which a day of each was revised."""
    sql = _sql("features", "select * from features")
    day = "cast(time as date) = date"
    revisions = {
        "base": f"""select time, zone, case when {day} '2024-01-10' then 2 * demand_mw + 1 else demand_mw end as demand_mw
                    from load_all where source = 'pjm' and zone in {ZONES}""",
        "lmp": VIEWS["lmp"].replace("* exclude (offset_id)", f"* exclude (offset_id) replace (case when {day} '2024-01-12' then lmp + 100 else lmp end as lmp)"),
        "weather": f"""select * from ({VIEWS["weather"]}) union all
                       select timestamp '2024-01-14 23:30:00', zone, 5.0, precipitation, wind_speed, cloud_cover
                       from ({VIEWS["weather"]}) where {day} '2024-01-14'""",
    }
    for name, body in revisions.items():
        assert f"{name} as ({VIEWS[name]})" in sql
        sql = sql.replace(f"{name} as ({VIEWS[name]})", f"{name} as ({body})")
    return sql


def _mentions(sql: str, view: str) -> bool:
    words = sql.replace("(", " ").replace(")", " ").replace(",", " ").split()
    return any(a in ("from", "join") and b == view for a, b in zip(words, words[1:]))


def _eval(alias: str) -> str:
    return f"""
        round(sqrt(avg(({alias}pred - {alias}actual) ** 2)), 6) as rmse,
        round(avg(abs({alias}pred - {alias}actual)), 6) as mae"""


PCT = "case when {a} <> 0 then abs(({p} - {a}) / {a}) when {p} <> {a} then 'infinity'::double end"
RATES = "round(avg(abs({p} - {a})), 6) as mae, round(avg(" + PCT + ") * 100, 6) as mape"
LOAD_COLS = "time, zone, source, demand_mw, demand_forecast_mw, net_generation_mw, total_interchange_mw, is_verified"
CONDITION = """case when precipitation > 0.1 then case when temperature <= 0 then 'snow' else 'rain' end
    when cloud_cover >= 85 then 'cloudy' when cloud_cover >= 40 then 'partly_cloudy' else 'clear' end"""
LABEL = "case {c} when 'partly_cloudy' then 'Partly cloudy' else upper({c}[1]) || {c}[2:] end"
HOLIDAY = """(
    (month(d) = 1 and day(d) = 1) or (month(d) = 12 and day(d) = 31 and isodow(d) = 5)
    or (month(d) = 1 and day(d) = 2 and isodow(d) = 1)
    or (month(d) = 7 and day(d) = 4) or (month(d) = 7 and day(d) = 3 and isodow(d) = 5)
    or (month(d) = 7 and day(d) = 5 and isodow(d) = 1)
    or (month(d) = 12 and day(d) = 25) or (month(d) = 12 and day(d) = 24 and isodow(d) = 5)
    or (month(d) = 12 and day(d) = 26 and isodow(d) = 1)
    or (month(d) = 5 and isodow(d) = 1 and day(d) > 24)
    or (month(d) = 9 and isodow(d) = 1 and day(d) < 8)
    or (month(d) = 11 and isodow(d) = 4 and day(d) between 22 and 28))"""
NUMERIC = ["demand_lag_72h", "demand_lag_168h", "temperature", "precipitation", "wind_speed", "cloud_cover"]


def _iso(t: str) -> str:
    return f"strftime({t}, '%Y-%m-%dT%H:%M:%S+00:00')"


def _json_number(c: str) -> str:
    return f"coalesce(cast({c} as varchar), 'null')"


def _message(extra: str = "") -> str:
    return f"""'{{"time":"' || {_iso("time")} || '","zone":"' || zone || '","source":"' || source ||
        '","demand_mw":' || {_json_number("demand_mw")} || ',"demand_forecast_mw":' ||
        {_json_number("demand_forecast_mw")} || ',"net_generation_mw":' || {_json_number("net_generation_mw")} ||
        ',"total_interchange_mw":' || {_json_number("total_interchange_mw")} || ',"is_verified":' ||
        coalesce(cast(is_verified as varchar), 'null') || '}}'"""


def _dead_value() -> str:
    """The message text as sent, by kind of fault."""
    head = f"""'{{"time":"' || (case when fault = 37 then 'soon' else {_iso("time")} end) || '","zone":"' || zone ||
        '","source":"pjm","demand_mw":' || (case fault when 17 then 'null' when 19 then '"12x"'
        else {_json_number("demand_mw")} end) || ',"demand_forecast_mw":' || {_json_number("demand_forecast_mw")} ||
        (case when fault = 13 then '' else ',"net_generation_mw":null' end) ||
        ',"total_interchange_mw":null,"is_verified":' || is_verified"""
    return f"""case fault when 11 then {head} when 41 then {head} || '}} }}'
        when 43 then '[' || {head} || '}}]' else {head} || '}}' end"""


def _mi() -> str:
    parts = [
        f"""select '{f}' as feature, case when {f} is not null then cast(least(floor(
            ({f} - min({f}) over ()) / nullif(max({f}) over () - min({f}) over (), 0) * 8), 7) as varchar) end as bin,
            cast(least(floor((demand_mw - min(demand_mw) over ()) /
                (max(demand_mw) over () - min(demand_mw) over ()) * 8), 7) as varchar) as y from features"""
        for f in NUMERIC
    ]
    parts.append(
        """select 'zone', zone, cast(least(floor((demand_mw - min(demand_mw) over ()) /
           (max(demand_mw) over () - min(demand_mw) over ()) * 8), 7) as varchar) from features"""
    )
    return f"""
        select feature, round(sum(n / t * ln(n * t / (b * yy))), 6) + 0.0 as mi from (
            select feature, n::double as n, (sum(n) over (partition by feature))::double as t,
                   (sum(n) over (partition by feature, bin))::double as b,
                   (sum(n) over (partition by feature, y))::double as yy
            from (select feature, bin, y, count(*) as n from ({" union all ".join(parts)})
                  where bin is not null and y is not null group by 1, 2, 3))
        group by feature"""


def _corr() -> str:
    cols = ["demand_mw", *NUMERIC]
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]
    return " union all ".join(
        f"select '{a}' as col_a, '{b}' as col_b, round(corr({a}, {b}), 6) + 0.0 as corr from features"
        for a, b in pairs
    )


def _nulls(view: str, columns: str) -> str:
    return " union all ".join(
        f"select 'not_null' as check_name, '{c}' as column_name, count(*) filter (where {c} is null) as failures "
        f"from {view}"
        for c in columns.split()
    )


FEATURE_COLS = (
    "time zone demand_mw demand_lag_72h demand_lag_168h demand_roll_6h demand_roll_24h lmp_total_lag_48h "
    "congestion_price_lag_48h marginal_loss_price_lag_48h temperature precipitation wind_speed cloud_cover "
    "observation_count"
)


def _incremental() -> str:
    def built(name: str, where: str) -> str:
        """Lags and means over the rows of the base that `where` lets in."""
        near = "(select sum(x.demand_mw) / count(*) from {0}_rows x where x.zone = r.zone and r.time - x.time between interval 72 hours and interval {1} hours)"
        return f"""{name}_rows as (select *, row_number() over (partition by zone order by time) as nr from base where {where}),
            {name} as (
                select r.time, r.zone, r.demand_mw, three.demand_mw as demand_lag_72h, seven.demand_mw as demand_lag_168h,
                       {near.format(name, 78)} as demand_roll_6h, {near.format(name, 96)} as demand_roll_24h
                from {name}_rows r
                left join {name}_rows three on three.zone = r.zone and three.nr + 72 = r.nr
                left join {name}_rows seven on seven.zone = r.zone and seven.nr + 168 = r.nr)"""

    newest = "(select max(time) from early)"
    return f"""{_sql("base", "")}, {built("early", f"time < {CUT}")},
        {built("late", f"time >= {newest} - interval 15 days")},
        again as (from late where time >= {newest} - interval 8 days)
        from again union all (from early anti join again using (time, zone))"""


def _freshness(source: str, view: str, warn: int, error: int) -> str:
    age = f"(epoch_us({AS_OF}) - epoch_us(max(time))) / 3600000000.0"
    return f"""select '{source}' as source, max(time) as latest_time, round({age}, 6) as age_hours,
        case when {age} <= {warn} then 'pass' when {age} <= {error} then 'warn' else 'error' end as status from {view}"""


def _contract() -> str:
    """The declared data tests over the full tables, as (table, check, column, failures)."""
    def nulls(view: str, table: str, columns: str) -> list[str]:
        return [f"select '{table}' as table_name, 'not_null' as check_name, '{c}' as column_name, count(*) filter (where {c} is null) as failures from {view}" for c in columns.split()]

    def unique(view: str, table: str, keys: str) -> str:
        return f"select '{table}', 'unique', '{keys}', (select count(*) from (select 1 from {view} group by {keys} having count(*) > 1))"

    def known(view: str, table: str, column: str, values: str) -> str:
        return f"select '{table}', 'accepted_values', '{column}', count(*) filter (where {column} not in {values}) from {view}"

    def child(view: str, table: str) -> str:
        return f"select '{table}', 'relationship', 'zone', count(*) filter (where zone not in (select zone_id from zone_dim)) from {view}"

    keyed = [("load_features", "demand_mw"), ("lmp_features", ""), ("weather_features", "observation_count"), ("features", "demand_mw")]
    parts = nulls("load_all", "stg_load", "time zone source demand_mw")
    parts += [known("load_all", "stg_load", "zone", ZONES.replace(")", ", 'RTO')")), known("load_all", "stg_load", "source", "('pjm', 'eia')")]
    parts += nulls("stg_lmp", "stg_lmp", "time pnode_id zone") + [unique("stg_lmp", "stg_lmp", "time, pnode_id"), child("stg_lmp", "stg_lmp")]
    parts += nulls("stg_weather", "stg_weather", "time zone") + [child("stg_weather", "stg_weather")]
    for view, more in keyed:
        parts += nulls(view, view, f"time zone {more}") + [unique(view, view, "time, zone"), child(view, view)]
    text = " union all ".join(parts)
    return _sql("load_all stg_lmp stg_weather load_features lmp_features weather_features features zone_dim", f"select table_name, check_name, replace(column_name, ', ', ',') as column_name, failures from ({text})")


def _summary(zone: str, where: str) -> str:
    cols = ["temperature", "precipitation", "wind_speed", "cloud_cover"]
    avgs = ", ".join(f"avg({c}) as {c}" for c in cols)
    known = " and ".join(f"{c} is not null" for c in cols)
    return f"""select '{zone}' as zone, {", ".join(f"round({c}, 6) as {c}" for c in cols)}, {CONDITION} as condition,
        round(temperature * 9 / 5 + 32, 6) as temp_f, round(wind_speed * 0.621371, 6) as wind_mph
        from (select {avgs} from preds {where}) where {known}"""


def oracle_sql() -> dict[str, str]:
    out = {
        "features_flagship": _sql("features", "select * from features"),
        "stg_load": _sql("load_all", f"select {LOAD_COLS} from load_all"),
        "stg_lmp": _sql("stg_lmp", "select * from stg_lmp"),
        "stg_weather": _sql("stg_weather", "select * from stg_weather"),
        "load_features": _sql("load_features", "select * from load_features"),
        "load_features_time_lag": _sql(
            "load_features base",
            """select l.* replace (a.demand_mw as demand_lag_72h, b.demand_mw as demand_lag_168h) from load_features l
               left join base a on a.zone = l.zone and a.time = l.time - interval 72 hours
               left join base b on b.zone = l.zone and b.time = l.time - interval 168 hours""",
        ),
        "lmp_features": _sql("lmp_features", "select * from lmp_features"),
        "weather_features": _sql("weather_features", "select * from weather_features"),
        "load_area_rollup": _sql("load_pjm", f"select {LOAD_COLS} from load_pjm"),
        "eia_pjm_union": _sql("load_all", f"select {LOAD_COLS} from load_all"),
        "load_totals": _sql("load_area", "select time, zone, sum(mw) as demand_mw from load_area group by 1, 2"),
        "station_composite": _sql(
            "stations",
            """select poll, min(time) as time, zone, avg(temperature) as temperature,
               avg(precipitation) as precipitation, avg(wind_speed) as wind_speed, avg(cloud_cover) as cloud_cover
               from stations group by poll, zone""",
        ),
        "composite_by_time": _sql(
            "stations",
            """select poll as time, zone, avg(temperature) as temperature, avg(precipitation) as precipitation,
               avg(wind_speed) as wind_speed, avg(cloud_cover) as cloud_cover from stations group by poll, zone""",
        ),
        "upsert_last_wins": _sql(
            "lmp_msgs",
            """select * exclude (offset_id) from lmp_msgs qualify row_number() over (
               partition by time, pnode_id order by congestion_price >= 20 desc, offset_id desc) = 1""",
        ),
        "partial_upsert": _sql(
            "messages load_all",
            f"""select time, zone, source, case when b.source is not null then b.demand_mw else a.demand_mw end as demand_mw,
               case when a.source is not null then a.demand_forecast_mw else b.demand_forecast_mw end as demand_forecast_mw,
               case when a.source is null then b.net_generation_mw end as net_generation_mw,
               case when a.source is null then b.total_interchange_mw end as total_interchange_mw,
               case when b.source is not null then b.is_verified else a.is_verified end as is_verified
               from (select * from messages qualify row_number() over (
                     partition by time, zone, source order by "offset" desc) = 1) a
               full join load_all b using (time, zone, source)""",
        ),
        "dedupe_first": _sql(
            "lmp_msgs",
            """select * rename (offset_id as "offset") from lmp_msgs
               qualify row_number() over (partition by time, pnode_id order by offset_id) = 1""",
        ),
        "horizon_series": _sql(
            "load_features",
            """select time + interval 1 hour as time, zone, 1 as horizon_h, demand_lag_72h as predicted_mw
               from load_features
               union all select time + interval 24 hours, zone, 24, round(demand_roll_24h) from load_features
               union all select time + interval 72 hours, zone, 72, demand_lag_168h from load_features""",
        ),
        "delete_insert_incremental": _incremental(),
        "weather_incremental": _sql(
            "stg_weather",
            f""", w as (select * replace (date_trunc('hour', time) as time) from stg_weather),
               old as (select * from w where time < {CUT}),
               fresh as (select * from w where time >= (select max(time) from old) - interval 1 day)
               select * from old where (time, zone) not in (select (time, zone) from fresh)
               union all select * from fresh""",
        ),
        "replace_zones": _sql(
            "weather stations",
            """select * from weather where zone not in ('click', 'view') union all
               select poll, zone, avg(temperature), avg(precipitation), avg(wind_speed), avg(cloud_cover)
               from stations where zone in ('click', 'view') group by poll, zone""",
        ),
        "backfill_absent_hours": _sql(
            "weather grid",
            """select time, zone, hour(time)::double as temperature, hour(time)::double as precipitation,
               hour(time)::double as wind_speed, hour(time)::double as cloud_cover from grid
               where (zone, time) not in (select (zone, date_trunc('hour', time)) from weather)""",
        ),
        "hour_grid_gaps": _sql(
            "grid load_pjm",
            """select time + interval 1 hour as time, zone from grid
               where (zone, time + interval 1 hour) not in (select (zone, time) from load_pjm)""",
        ),
        "facility_sheet": """
            select 'site ' || o_orderkey as facility_name, o_orderkey || ' "Old" Mill, Rd' as address,
                   cast(null as varchar) as city, o_orderstatus as state,
                   lpad(cast(o_custkey % 20000 as varchar), 5, '0') as zip, '100-200' as mw,
                   case when o_orderkey % 5 <> 0 then o_orderkey % 90 + 0.5::double end as lat,
                   case when o_orderkey % 9 <> 0 then o_orderkey % 180 - 179.5::double end as "long",
                   case when o_orderkey % 7 <> 0 then cast(o_orderdate as date) end as date_created,
                   cast(null as date) as date_updated from orders""",
        "features_without_time": _sql(
            "order_hours",
            """select row_id, isodow(eastern) >= 6 as is_weekend, hour(eastern) between 14 and 18 as is_peak_hour,
               false as has_time from order_hours""",
        ),
        "horizon_labels": "select o_orderkey as row_id, cast(o_orderkey % 100 as int) as horizon_h from orders",
        "snapshot_latest": """
            select o_custkey as facility_id, date_trunc('month', o_orderdate)::timestamp as synced_at,
                   o_orderkey as row_id, o_orderstatus as status from orders
            where date_trunc('month', o_orderdate) = (select max(date_trunc('month', o_orderdate)) from orders)""",
        "snapshot_history": """
            select o_custkey as facility_id,
                   arg_min(o_orderstatus, (date_trunc('month', o_orderdate), o_orderkey)) as first_status,
                   arg_max(o_orderstatus, (date_trunc('month', o_orderdate), o_orderkey)) as last_status,
                   count(distinct date_trunc('month', o_orderdate)) as n_snapshots
            from orders group by o_custkey""",
        "keyed_messages": _sql("load_all", f"select zone as key, {_message()} as value from load_all"),
        "message_rows": _sql("message_rows", "select * from message_rows"),
        "dlq_split": _sql(
            "messages",
            f"""select key, {_dead_value()} as value, "offset" from messages
                where fault in (11, 13, 17, 19, 37, 41, 43)""",
        ),
        "stream_upsert": _sql(
            "message_rows",
            """select * exclude ("offset") from message_rows qualify row_number() over (
               partition by time, zone, source order by "offset" desc) = 1""",
        ),
        "stream_dead_letters": _sql(
            "messages",
            f"""select key, {_dead_value()} as value, "offset" from messages
                where fault in (11, 13, 17, 19, 37, 41, 43)""",
        ),
        "stream_lmp_upsert": _sql("lmp", "select * from lmp"),
        "stream_weather_append": _sql("weather", "select * from weather"),
        "stream_weather_hourly": _sql(
            "weather",
            """select date_trunc('hour', time) + interval 1 hour as time, zone, avg(temperature) as temperature,
               avg(precipitation) as precipitation, avg(wind_speed) as wind_speed, avg(cloud_cover) as cloud_cover,
               count(*) as observation_count from weather group by 1, 2""",
        ),
        "stream_weather_closed_hours": _sql(
            "weather",
            """select date_trunc('hour', time) + interval 1 hour as time, zone, avg(temperature) as temperature,
               avg(precipitation) as precipitation, avg(wind_speed) as wind_speed, avg(cloud_cover) as cloud_cover,
               count(*) as observation_count from weather group by 1, 2
               having date_trunc('hour', weather.time) + interval 1 hour
                      <= (select max(time) - interval 1 day from weather)""",
        ),
        "calendar_features": _sql(
            "order_hours",
            """select row_id, time, temperature, zone, demand_mw, isodow(eastern) >= 6 as is_weekend,
               greatest(18.33 - temperature, 0) as hdd, greatest(temperature - 18.33, 0) as cdd,
               hour(eastern) between 14 and 18 as is_peak_hour,
               round(sin(2 * pi() * hour(eastern) / 24), 9) + 0.0 as hour_sin,
               round(cos(2 * pi() * hour(eastern) / 24), 9) + 0.0 as hour_cos,
               round(sin(2 * pi() * (month(eastern) - 1) / 12), 9) + 0.0 as month_sin,
               round(cos(2 * pi() * (month(eastern) - 1) / 12), 9) + 0.0 as month_cos, year(eastern)::int as year
               from order_hours""",
        ),
        "degree_days": _sql(
            "order_hours",
            """select row_id, round(case when t is not null then greatest(18.33 - t, 0) end, 6) + 0.0 as hdd,
               round(case when t is not null then greatest(t - 18.33, 0) end, 6) + 0.0 as cdd,
               case when t is not null then greatest(t - 65, 0) end as cdh,
               case when t is not null then greatest(65 - t, 0) end as hdh
               from (select row_id, case when row_id % 5 <> 0 then temperature end as t from order_hours)""",
        ),
        "market_calendar": _sql(
            "order_hours",
            f"""select row_id, time, {HOLIDAY} as is_holiday,
                hour(eastern) between 7 and 22 and isodow(eastern) < 6 and not {HOLIDAY} as is_market_on_peak
                from (select *, cast(eastern as date) as d from order_hours)""",
        ),
        "time_functions": _sql(
            "order_hours",
            f"""select row_id, eastern, date_trunc('hour', time) + interval 1 hour as hour_ending,
                time - interval 7 months as months_back, time + interval 72 hours as later, time as from_epoch,
                {_iso("time")} as iso, round((epoch_us({AS_OF}) - epoch_us(time)) / 3600000000.0, 6) as age_hours
                from order_hours""",
        ),
        "mixed_offset_parse": _sql(
            "order_hours", "select row_id, case when row_id % 7 <> 0 then time end as time from order_hours"
        ),
        "date_parse": _sql(
            "order_hours", "select row_id, case when row_id % 5 <> 0 then time::date end as day from order_hours"
        ),
        "display_labels": _sql(
            "order_hours",
            """select row_id, format('{:,.3f}', demand_mw / 8) as mw,
               case when demand_mw / 8 > 9999 then format('{:,.3f}', demand_mw / 8)
                    else format('{:.3f}', demand_mw / 8) end as mw_conditional,
               strftime(eastern, '%m-%d %-I:%M%p') as label, temperature * 9 / 5 + 32 as temp_f,
               round(temperature * 0.621371, 6) as mph from order_hours""",
        ),
        "weather_condition": _sql(
            "weather_features",
            f"""select time, zone, condition, {LABEL.format(c="condition")} as condition_label
                from (select *, {CONDITION} as condition from weather_features)""",
        ),
        "labels": _sql(
            "base",
            """select *, lead(demand_mw, 1) over w as y_1h, lead(demand_mw, 24) over w as y_24h,
               lead(demand_mw, 72) over w as y_72h from base window w as (partition by zone order by time)""",
        ),
        "table_upsert": _sql(
            "message_rows",
            """select * exclude ("offset") from message_rows qualify row_number() over (
               partition by time, zone, source order by "offset" desc) = 1""",
        ),
        "table_partial_upsert": _sql(
            "messages load_all",
            """select time, zone, source, coalesce(b.demand_mw, a.demand_mw) as demand_mw,
               case when a.source is not null then a.demand_forecast_mw else b.demand_forecast_mw end as demand_forecast_mw,
               case when a.source is null then b.net_generation_mw end as net_generation_mw,
               case when a.source is null then b.total_interchange_mw end as total_interchange_mw,
               case when b.source is not null then b.is_verified else a.is_verified end as is_verified
               from (select * from messages qualify row_number() over (
                     partition by time, zone, source order by "offset" desc) = 1) a
               full join load_all b using (time, zone, source)""",
        ),
        "table_replace_zones": _sql(
            "weather stations",
            """select * from weather where zone not in ('click', 'view') union all
               select poll, zone, avg(temperature), avg(precipitation), avg(wind_speed), avg(cloud_cover)
               from stations where zone in ('click', 'view') group by poll, zone""",
        ),
        "table_backfill": _sql(
            "weather grid",
            """select * from weather union all
               select time, zone, hour(time)::double, hour(time)::double, hour(time)::double, hour(time)::double
               from grid where (zone, time) not in (select (zone, date_trunc('hour', time)) from weather)""",
        ),
        "table_snapshots": """
            select o_custkey as facility_id, o_orderkey as row_id, o_orderstatus as status,
                   date_trunc('month', o_orderdate)::timestamp as synced_at from orders
            where date_trunc('month', o_orderdate) = (select max(date_trunc('month', o_orderdate)) from orders)""",
        "warehouse_incremental": _sql("features", "select * from features"),
        "contract_report": _contract(),
        "training_rows": _sql(
            "labels features",
            """select f.zone, count(*) as n, count(l.y_1h) as n_1h, count(l.y_24h) as n_24h, count(l.y_72h) as n_72h,
               count(f.temperature) as n_temperature, count(f.lmp_total_lag_48h) as n_price, sum(f.demand_lag_72h) as lag_sum
               from features f join labels l using (time, zone)
               where f.demand_lag_168h is not null group by f.zone""",
        ),
        "split_by_date": _sql(
            "order_hours",
            """select * exclude (eastern) from order_hours
               where time >= timestamp '1995-03-01' and time < timestamp '1996-07-15 12:00:00'""",
        ),
        "metered_files": _sql("load_area", "select time, zone, mw, is_verified from load_area"),
        "station_seed": _sql("zone_dim", "select zone_id, city from zone_dim"),
        "sorted_csv": "select c_custkey, c_acctbal from customer",
        "json_export": "select o_orderkey, o_orderstatus, o_totalprice from orders",
        "nan_guard": _sql(
            "order_hours",
            """select zone, count(*) as n, count(case when row_id % 5 <> 0 then demand_mw end) as n_known,
               sum(case when row_id % 5 <> 0 then demand_mw end) as total from order_hours group by zone""",
        ),
        "eastern_to_utc": _sql(
            "order_hours",
            """select row_id, case when ((time - interval 1 hour) at time zone 'UTC') at time zone 'US/Eastern' = eastern
                              then time - interval 1 hour else time end as time from order_hours""",
        ),
        "information_ranking": _sql("features", _mi()),
        "drain_counts": _sql(
            "messages",
            """select count(*) filter (where fault not in (11, 13, 17, 19, 37, 41, 43)) as written,
               count(*) filter (where fault in (11, 13, 17, 19, 37, 41, 43)) as dead_lettered from messages""",
        ),
        "split_counts": _sql(
            "load_features",
            """select case when time >= t - interval 7 days then 'test' when time >= t - interval 14 days then 'val'
               else 'train' end as split, zone, count(*) as n, min(time) as first_time
               from load_features, (select max(time) as t from load_features) group by 1, 2""",
        ),
        "split_months": _sql(
            "order_hours",
            """select case when time >= t - interval 7 months then 'test'
               when time >= t - interval 7 months - interval 12 months then 'val' else 'train' end as split,
               count(*) as n, min(time) as first_time, max(time) as last_time
               from order_hours, (select max(time) as t from order_hours) group by 1""",
        ),
        "split_by_days": _sql(
            "order_hours",
            """select * exclude (eastern) from order_hours
               where time::date between date '1997-01-01' and date '1998-12-31'""",
        ),
        "eval_metrics": _sql(
            "scored",
            f"""select horizon_h, split, {_eval("")}, round(1 - sum((pred - actual) ** 2)
                / (var_pop(actual) * count(actual)), 6) + 0.0 as r2
                from scored where actual is not null group by 1, 2""",
        ),
        "zone_metrics": _sql(
            "scored",
            f"""select horizon_h, zone, {RATES.format(p="pred", a="actual")} from scored
                where actual is not null and split = 'test' group by horizon_h, zone""",
        ),
        "promotion": _sql(
            "scored",
            """, r as (select zone as name, horizon_h, round(sqrt(avg((pred - actual) ** 2)), 6) as rmse from scored
                       where actual is not null group by 1, 2 having avg(pred) is not null),
               c as (select * from r where horizon_h = 24),
               p as (select * from r where horizon_h = 72
                     and rmse > (select min(rmse) from r where horizon_h = 72))
               select p.name, 1 as version, case when c.rmse < p.rmse then 'Archived' else 'Production' end as stage,
                      p.rmse from p left join c using (name)
               union all
               select c.name, 2, case when p.rmse is null or c.rmse < p.rmse then 'Production' else 'Staging' end, c.rmse
               from c left join p using (name)""",
        ),
        "run_record": _sql(
            "labelled",
            f"""select 'v1' as featureset, 'features' as source_table, {AS_OF} as run_at, count(*) as row_count, """
            + ", ".join(
                f"min(time::date) filter (where split = '{s}') as {s}_first, "
                f"max(time::date) filter (where split = '{s}') as {s}_last, "
                f"count(*) filter (where split = '{s}') as {s}_rows"
                for s in ("train", "val", "test")
            )
            + " from labelled",
        ),
        "latest_per_zone": _sql("latest", "select * from latest"),
        "one_zone_rows": _sql("features", "select * from features where zone = 'view'"),
        "recent_peak_week": _sql(
            "features",
            f"""select zone, max(demand_mw) as peak_mw from features
                where time >= {AS_OF} - interval 7 days - interval 7 hours group by zone""",
        ),
        "table_two_writers": _sql(
            "message_rows",
            """select * exclude ("offset") from message_rows qualify row_number() over (
               partition by time, zone, source order by "offset" desc) = 1""",
        ),
        "warehouse_revision": _revised(),
        "latest_one_zone": _sql("latest", "select * from latest where zone = 'view'"),
        "features_window": _sql(
            "features", f"select * from features where time >= {AS_OF} - interval 48 hours order by zone, time"
        ),
        "recent_peak": _sql("peaks", "select * from peaks"),
        "freshness": _sql(
            "load_features",
            f"""select max(time) as latest_load_time,
                (epoch_us({AS_OF}) - epoch_us(max(time))) / 3600000000.0 as age_hours,
                (epoch_us({AS_OF}) - epoch_us(max(time))) / 3600000000.0 <= 96 as is_live from load_features""",
        ),
        "predictions": _sql("preds", "select * from preds"),
        "predictions_weather_join": _sql(
            "load_features weather_features",
            """select l.time, l.zone, demand_lag_72h as y_1h, round(demand_roll_24h) as y_24h,
               demand_lag_168h as y_72h, temperature, precipitation, wind_speed, cloud_cover
               from load_features l left join weather_features w using (time, zone)""",
        ),
        "history_alignment": _sql("hist", "select * from hist"),
        "horizon_accuracy": _sql(
            "hist",
            f"""select horizon_h, {RATES.format(p="predicted_mw", a="actual_mw")} from hist
                where actual_mw is not null group by horizon_h""",
        ),
        "system_totals": _sql(
            "hist",
            """select time, horizon_h, sum(actual_mw) as actual_mw, coalesce(sum(predicted_mw), 0) as predicted_mw,
               'PJM' as zone from hist group by 1, 2""",
        ),
        "drilldown_system": _sql(
            "hist",
            f"""select time, 'PJM' as zone, horizon_h, sum(actual_mw) as actual_mw,
                coalesce(sum(predicted_mw), 0) as predicted_mw from hist
                where time >= {AS_OF} - interval 72 hours and horizon_h = 24 group by time, horizon_h""",
        ),
        "drilldown_zone": _sql(
            "hist",
            f"""select * from hist where time >= {AS_OF} - interval 120 hours and horizon_h = 72 and zone = 'click'
                order by zone, time""",
        ),
        "weather_summary": _sql(
            "preds",
            f"""select *, {LABEL.format(c="condition")} as condition_label from (
                {_summary("PJM", "")} union all {_summary("view", "where zone = 'view' group by zone")})""",
        ),
        "load_ratio": _sql(
            "preds peaks zone_dim",
            """, r as (select p.zone, p.y_24h as predicted_mw, k.peak_mw, p.y_24h / nullif(k.peak_mw, 0) as load_ratio
                       from preds p join peaks k using (zone) where p.zone in (select zone_id from zone_dim))
               select zone, predicted_mw, peak_mw, round(load_ratio, 6) as load_ratio, round(coalesce(least(greatest(
                   (load_ratio - (select min(load_ratio) from r))
                   / nullif((select max(load_ratio) - min(load_ratio) from r), 0), 0), 1), 0), 6) as heat from r""",
        ),
        "zone_ranking": _sql("preds", "select zone, y_24h as predicted_mw from preds order by 2 desc nulls last, 1"),
        "top_zones": _sql(
            "preds", "select zone, y_1h as predicted_mw from preds order by 2 desc nulls last, 1 limit 3"
        ),
        "top_zone_series": _sql(
            "hist preds",
            """select * from hist where horizon_h = 24 and zone in (
                   select zone from preds order by y_24h desc nulls last, zone limit 2) order by zone, time""",
        ),
        "null_audit": _sql("features", _nulls("features", FEATURE_COLS)),
        "dq_report": _sql(
            "load_all stg_lmp weather zone_dim",
            _nulls("load_all", "time zone source demand_mw")
            + f""" union all select 'accepted_values', 'zone', count(*) from load_all
                   where not (zone in {ZONES} or zone = 'RTO')
                   union all select 'accepted_values', 'source', count(*) from load_all where source not in ('pjm', 'eia')
                   union all select 'unique', 'time,pnode_id', count(*) from (
                       select 1 from stg_lmp group by time, pnode_id having count(*) > 1)
                   union all select 'unique', 'time,zone', count(*) from (
                       select 1 from weather group by time, zone having count(*) > 1)
                   union all select 'unique', 'zone_id,city', count(*) from (
                       select 1 from zone_dim group by zone_id, city having count(*) > 1)
                   union all select 'relationship', 'zone', count(*) from stg_lmp
                       where zone not in (select zone_id from zone_dim)
                   union all select 'relationship', 'zone', count(*) from weather
                       where zone not in (select zone_id from zone_dim)""",
        ),
        "dq_outside_values": _sql(
            "load_all", f"select zone, count(*) as n from load_all where not (zone in {ZONES} or zone = 'RTO') group by 1"
        ),
        "dq_duplicates": _sql(
            "lmp_msgs", "select time, pnode_id, count(*) as n from lmp_msgs group by 1, 2 having count(*) > 1"
        ),
        "dq_freshness": _sql(
            "load_all lmp weather",
            " union all ".join(
                [
                    _freshness("load", "load_all", 6, 24),
                    _freshness("lmp", "lmp", 6, 24),
                    _freshness("weather", "weather", 2, 6),
                ]
            ),
        ),
        "dq_key_sync": _sql(
            "load_all zone_dim",
            """select zone, a.zone is not null as in_left, b.zone is not null as in_right
               from (select distinct zone from load_all) a
               full join (select distinct zone_id as zone from zone_dim) b using (zone)
               where a.zone is null or b.zone is null""",
        ),
        "sparse_hours": _sql("weather_features", "select * from weather_features where observation_count < 3"),
        "source_profile": _sql(
            "load_all", "select source, count(*) as n_rows, count(distinct zone) as n_zones from load_all group by 1"
        ),
        "run_profile": _sql(
            "load_pjm",
            """select count(*) as n_rows, count(distinct zone) as n_zones, min(time) as first_time,
               max(time) as last_time, count(*) filter (where not is_verified) as n_unverified from load_pjm""",
        ),
        "value_counts": _sql("lmp_msgs", "select pnode_name, count(*) as n from lmp_msgs group by 1"),
        "value_counts_known": _sql(
            "lmp_msgs", "select pnode_name, count(*) as n from lmp_msgs where pnode_name is not null group by 1"
        ),
        "distinct_zones": _sql("load_all", "select distinct zone from load_all"),
        "corr_matrix": _sql("features", _corr()),
        "binned_mi": _sql("features", _mi()),
        "station_pivot": _sql(
            "temps",
            """select zone, time, avg(temperature) filter (where city = 's0') as s0,
               avg(temperature) filter (where city = 's1') as s1, avg(temperature) filter (where city = 's2') as s2
               from temps group by zone, time""",
        ),
        "station_subsets": _sql("masks", "select zone, mask::int as mask, n, stations from masks"),
        "subset_observations": _sql(
            "temps masks load_pjm",
            """select zone, mask, n, stations, time, y, round(greatest(f - 65, 0), 6) as c,
               round(greatest(65 - f, 0), 6) as h from (
                   select m.zone, m.mask::int as mask, m.n, m.stations, l.time, l.demand_mw as y,
                          avg(t.temperature) * 9 / 5 + 32 as f
                   from temps t join masks m on m.zone = t.zone
                        and list_contains(string_split(m.stations, ' + '), t.city)
                   join load_pjm l on l.zone = t.zone and l.time = t.time + interval 1 hour
                   group by m.zone, m.mask, m.n, m.stations, l.time, l.demand_mw)""",
        ),
        "station_subset_scores": _sql("subset_scores", "select * exclude (partial_r2), round(partial_r2, 6) as partial_r2 from subset_scores"),
        "best_station_subsets": _sql(
            "subset_scores",
            """select s.zone, s.stations as best_single, s.single_r2, c.stations as best_composite, c.composite_r2,
               round(gain, 6) as gain from (
                   select s.zone, s.stations, round(s.partial_r2, 6) as single_r2, s.partial_r2 from subset_scores s where n = 1
                   qualify row_number() over (partition by zone order by round(partial_r2, 9) desc nulls last, mask) = 1) s
               left join (
                   select zone, stations, round(partial_r2, 6) as composite_r2, partial_r2 from subset_scores where n > 1
                   qualify row_number() over (partition by zone order by round(partial_r2, 9) desc nulls last, mask) = 1) c
               on c.zone = s.zone, lateral (select c.partial_r2 - s.partial_r2 as gain)""",
        ),
        "territory_cells": _sql("cells", "select entity, cell_x, cell_y from cells"),
        "territory_area": _sql("areas", "select * from areas"),
        "territory_assign": _sql("owned", "select * from owned"),
        "territory_points": _sql(
            "owned",
            """select p.facility_id, p.x, p.y, o.zone_id from (
                   select c_custkey as facility_id, (c_custkey * 41) % 260 + 0.25::double as x,
                          (c_custkey * 29) % 210 + 0.75::double as y from customer) p
               left join owned o on o.cell_x = floor(p.x) and o.cell_y = floor(p.y)""",
        ),
    }
    located = _sql(
        "lmp_msgs",
        f"""select time, cast(offset_id as varchar) as pnode_id, 'node ' || pnode_id as pnode_name, zone, lmp,
            congestion_price, marginal_loss_price from lmp_msgs where zone in {ZONES}""",
    )
    return out | {"lmp_zone_lookup": located, "lmp_lookup_table": located}
