"""The shared tables of plans/data.py once more, as SQL text for the side-by-side check."""

from __future__ import annotations

import re

SEASON = """case when month(date)*100+day(date) between 321 and 620 then 'Spring'
  when month(date)*100+day(date) between 621 and 922 then 'Summer'
  when month(date)*100+day(date) between 923 and 1220 then 'Autumn' else 'Winter' end"""
PERIOD = """case when hour between 7 and 11 then 'Morning' when hour between 12 and 17 then 'Afternoon'
  when hour between 18 and 22 then 'Evening' else 'Night' end"""
RAIN = """case when rain = 0 then 'no rain' when rain <= 0.3e0 then 'drizzle' when rain <= 0.5e0 then 'light rain'
  when rain <= 4 then 'moderate rain' when rain > 4 then 'heavy rain' end"""
BFT = """case when ms < 0.3e0 then 0 when ms < 1.5e0 then 1 when ms < 3.4e0 then 2 when ms < 5.4e0 then 3
  when ms < 7.9e0 then 4 when ms < 10.7e0 then 5 when ms < 13.8e0 then 6 when ms < 17.1e0 then 7
  when ms < 20.7e0 then 8 when ms < 24.4e0 then 9 when ms < 28.4e0 then 10 when ms < 32.6e0 then 11 else 12 end"""
WIND = """case when wind_bft < 3 then 'Calm / Light Breeze' when wind_bft = 3 then 'Breeze'
  when wind_bft < 6 then 'Moderate Breeze' when wind_bft < 8 then 'Strong Breeze / Near Gale'
  else 'Gale / Storm' end"""
WEEKDAY = "cast(isodow(date) - 1 as integer)"

_SPINE = """select cast(ts as date) as date, cast(hour(ts) as integer) as hour,
  ((i*37)%251)/1e1 - 5e0 as temp, cast(40+(i*29)%61 as integer) as rhum, cast((i*13)%60 as integer) as wdsp,
  case when i%3=0 then 0e0 else ((i*17)%60)/1e1 end as rain
  from (select i, h0 + to_hours(i) as ts from
   (select h0, unnest(generate_series(0, date_diff('hour', h0, h1))) as i from
    (select date_trunc('hour', min({ts})) as h0, date_trunc('hour', max({ts})) as h1 from {src})))"""

_FEATURES = f"""select *, {WIND} as wind_speed_group from (
 select * exclude (ms), cast({BFT} as integer) as wind_bft from (
 select b.*, b.wdsp * 0.514e0 as ms, h.date is not null as holiday,
  cast(day(b.date) as integer) as day, cast(month(b.date) as integer) as month, cast(year(b.date) as integer) as year,
  cast(isodow(b.date) - 1 as integer) as dayofweek_n, dayname(b.date) as dayofweek,
  isodow(b.date) < 6 and h.date is null as working_day,
  {SEASON.replace('(date)', '(b.date)')} as season,
  isodow(b.date) < 6 and (hour between 6 and 10 or hour between 15 and 19) as peak,
  {PERIOD} as timesofday, {RAIN} as rainfall_intensity,
  cast(round(temp) as integer) as temp_r
 from {{base}} b left join holidays h on b.date = h.date))"""

# first and last day of the training sample
TRAIN = ("2021-03-01", "2022-02-28")


def _centres(value: str, bins: int) -> str:
    """Steps of one-dimensional k-means from the centres of equal-width bins, until no centre moves."""
    edges = f"list_transform(range(1, {bins}), lambda i: (c[i] + c[i + 1]) / 2)"
    moved = f"list_max(list_transform(range(1, {bins + 1}), lambda i: abs(c[i] - m[i]))) < 1e-9"
    return f"""select 0 as step, list_transform(range({bins}), lambda i: lo + (hi - lo) / {bins} * (i + 0.5e0)) as c, false as done
        from (select min(v) as lo, max(v) as hi from {value}_counts)
        union all select step + 1, m, {moved} from (select step, c, list(mean order by b) as m from (
         select step, c, b, sum(v * n) / sum(n) as mean from (
          select step, c, v, n, len(list_filter({edges}, lambda e: v >= e)) as b from {value}_centres, {value}_counts where not done)
         group by step, c, b) group by step, c)"""


def _bin(value: str, bins: int) -> str:
    last = f"(select arg_max(c, step) from {value}_centres)"
    return f"(select list_transform(range(1, {bins}), lambda i: (c[i] + c[i + 1]) / 2) as {value}_edges from (select {last} as c))"


def _counts(value: str) -> str:
    return f"""select cast({value} as double) as v, count(*) as n from fact
        where date between date '{TRAIN[0]}' and date '{TRAIN[1]}' group by 1"""


#: Bins learnt from the training dates: number of bins by column.
BINS = {"temp": 10, "rhum": 5}

CTES = {
    "ping_breaks": """select user_id, ts, event_type, value, event_id,
        cast(json_extract_string(props, '$.k') as int) as k,
        case when ts < lag(ts) over (partition by user_id order by ts, event_id) + interval '6' hour then 0 else 1 end as brk
        from events""",
    "ping_runs": """select *, sum(brk) over (partition by user_id order by ts, event_id
        rows between unbounded preceding and current row) as sess from ping_breaks""",
    "pings": """select user_id as bike_id, min(ts) over (partition by user_id, sess) as last_rental_start,
        ts as last_gps_time,
        cast(case when k % 25 = 0 then null when k % 25 = 1 then -k when k = 99 then 104 else k end as integer) as battery,
        case user_id % 10 when 0 then 'Workshop' when 1 then 'Private' when 2 then 'Healthcare' else 'DUB-General' end as bike_type,
        case event_type when 'error' then 1 when 'click' then 2 when 'purchase' then 3 when 'view' then 4 else 5 end as state_id,
        case event_type when 'error' then 0e0 when 'signup' then null else 53.3e0 + value/1e4 end as latitude,
        case event_type when 'error' then 0e0 when 'signup' then null else -6.25e0 - value/1e4 end as longitude
        from ping_runs""",
    "started_pings": """select * exclude (n) from (select *, count(*) over (partition by last_rental_start) as n from pings)
        where not (n = 1 and state_id = 1)""",
    "clean_pings": """select * exclude (bike_type) replace (
        cast(case when battery is null or battery < 0 then -1 else least(battery, 100) end as integer) as battery)
        from started_pings where bike_type = 'DUB-General'""",
    "ranked_rentals": """select last_rental_start, bike_id,
        rank() over (partition by bike_id order by last_rental_start desc) as rent_rank
        from (select distinct last_rental_start, bike_id from pings)""",
    "rentals": """select p.last_rental_start, p.bike_id, arg_min_null(battery, last_gps_time) as battery_start,
        case when count(*) > 1 then arg_max_null(battery, last_gps_time) end as battery_end,
        cast(greatest(datesub('minute', p.last_rental_start, max(last_gps_time)), 0) as integer) as duration
        from pings p join ranked_rentals r on p.last_rental_start = r.last_rental_start and p.bike_id = r.bike_id
        where rent_rank > 1 group by p.last_rental_start, p.bike_id""",
    "trips": """select o_orderkey as trip_id, o_custkey as bike_id,
        cast(date '2021-03-01' + cast(date_diff('day', date '1995-01-01', cast(o_orderdate as date)) % 426 as integer) as timestamp)
          + to_minutes(cast(greatest(o_orderkey % 24, (o_orderkey*5 + o_custkey) % 24) * 60 + (o_custkey*7 + o_orderkey) % 60 as bigint)) as start,
        cast(case when o_orderkey % 97 <> 0 then o_orderkey % 103 - 1 end as integer) as battery_start,
        cast(o_orderkey % 180 as integer) as duration from orders""",
    "weather": _SPINE.format(ts="start", src="trips"),
    "ping_weather": _SPINE.format(ts="ts", src="events"),
    "holidays": """select make_date(cast(y as integer), m, d) as date from range(1, 10000) a(y),
        (values (1,1),(3,17),(12,25),(12,26)) b(m, d)""",
    "hourly": """select cast(start as date) as date, cast(hour(start) as integer) as hour, count(*) as demand
        from trips group by 1, 2""",
    "fact": """select w.*, cast(coalesce(demand, 0) as integer) as demand
        from weather w left join hourly h on w.date = h.date and w.hour = h.hour""",
    "features": _FEATURES.format(base="fact"),
    "trip_weather": """select t.*, w.* from trips t join weather w
        on cast(t.start as date) = w.date and hour(t.start) = w.hour""",
    "trip_features": _FEATURES.format(base="trip_weather"),
    **{f"{c}_counts": _counts(c) for c in BINS},
    **{f"{c}_centres": _centres(c, n) for c, n in BINS.items()},
    "binned": "select f.*, "
    + ", ".join(f"cast(len(list_filter({c}_edges, lambda e: {c} >= e)) as integer) as {c}_bin" for c in BINS)
    + " from features f, "
    + ", ".join(_bin(c, n) for c, n in BINS.items()),
    "daily": "select date, cast(sum(demand) as bigint) as daily_rentals from fact group by date",
}


def _needed(sql: str, known: dict[str, str]) -> list[str]:
    found: list[str] = []

    def visit(text: str) -> None:
        for name in known:
            if re.search(rf"(?<![\w.']){name}(?![\w'])", text) and name not in found:
                visit_body = known[name]
                visit(re.sub(rf"\b{name}\b", "", visit_body))
                if name not in found:
                    found.append(name)

    visit(sql)
    return found


def oracle(sql: str) -> str:
    """Put the common table expressions that a query mentions in front of it."""
    names = _needed(sql, CTES)
    if not names:
        return sql
    head = ",\n".join(f"{n} as ({CTES[n]})" for n in names)
    own = re.match(r"\s*with (recursive )?", sql)
    start = "with recursive" if any("_centres" in n for n in names) or (own and own[1]) else "with"
    return f"{start} {head},\n{sql[own.end():]}" if own else f"{start} {head}\n{sql}"
