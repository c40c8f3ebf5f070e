"""Queries on raw messages and the rentals rebuilt from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calendar import duration_minutes
from ..operators import pings as P
from ..operators import rentals as R
from ..operators.joins import spread_join
from ..operators.profile import value_counts
from ..session import settle
from ..sources.store import insert_ignore
from . import data
from .catalog import query

KEY = "last_rental_start, bike_id"


@query("A2_rental_reconstruction", "select * from rentals")
def reconstruction(spark, sf):
    return R.reconstruct(data.pings(spark, sf))


@query(
    "A1_pending_rentals",
    "select count(*) as pending from (select distinct last_rental_start, bike_id from pings)",
)
def pending(spark, sf):
    return R.count_pending(data.pings(spark, sf))


@query("W1_rental_rank", "select * from ranked_rentals")
def rank(spark, sf):
    return R.rank_rentals(data.pings(spark, sf))


@query(
    "W1_open_and_completed",
    """select cast(count(*) filter (where rent_rank = 1) as bigint) as open,
       cast(count(*) filter (where rent_rank > 1) as bigint) as completed from ranked_rentals""",
)
def open_and_completed(spark, sf):
    pairs = R.rental_pairs(data.pings(spark, sf))
    joined = spread_join(pairs, R.latest_starts(pairs), ["bike_id"], "inner")
    is_open = F.col("last_rental_start") == F.col("open_start")
    return joined.agg(F.count_if(is_open).alias("open"), F.count_if(~is_open).alias("completed"))


@query(
    "W2_first_and_last_ping",
    """select last_rental_start, bike_id, rn_start = 1 as rent_starting, last_gps_time, battery from (
       select *, row_number() over (partition by last_rental_start, bike_id order by last_gps_time) as rn_start,
        row_number() over (partition by last_rental_start, bike_id order by last_gps_time desc) as rn_end from pings)
       where rn_start = 1 or rn_end = 1""",
)
def first_and_last(spark, sf):
    return R.first_and_last(data.pings(spark, sf).select(*R.RENTAL_KEY, "last_gps_time", "battery"))


@query("W3_unique_pings", "select * from pings")
def unique_pings(spark, sf):
    """Messages of state 1 arrive twice; one of each stays."""
    pings = data.pings(spark, sf)
    return P.unique_rows(pings.unionByName(pings.filter("state_id = 1")), P.PING_KEY)


@query(
    "W3_unique_coordinates",
    "select distinct last_rental_start as date, bike_id, latitude, longitude from pings",
)
def unique_coordinates(spark, sf):
    rows = data.pings(spark, sf).select(
        F.col("last_rental_start").alias("date"), "bike_id", "latitude", "longitude"
    )
    return P.unique_rows(rows, rows.columns)


@query(
    "W4_single_ping_starts",
    "select last_rental_start, bike_id from (select *, count(*) over (partition by last_rental_start) as n from pings) where n = 1",
)
def single_ping_starts(spark, sf):
    """Rows whose start time occurs once: the group size is an aggregate, so a hot start never fills one task."""
    return (
        data.pings(spark, sf)
        .groupBy("last_rental_start")
        .agg(F.count("*").alias("n"), F.max("bike_id").alias("bike_id"))
        .filter("n = 1")
        .select("last_rental_start", "bike_id")
    )


@query("P3_drop_never_started", "select * from started_pings")
def drop_never_started(spark, sf):
    return P.drop_never_started(data.pings(spark, sf))


@query(
    "P4_normal_battery",
    """select battery, cast(case when battery is null or battery < 0 then -1 else least(battery, 100) end as integer) as normal,
       count(*) as n from pings group by 1, 2""",
)
def normal_battery(spark, sf):
    pings = data.pings(spark, sf)
    return pings.groupBy("battery", P.normal_battery(F.col("battery")).alias("normal")).agg(F.count("*").alias("n"))


@query(
    "P5_usable_coordinates",
    """select last_rental_start, bike_id, last_gps_time, latitude, longitude from pings
       where (latitude is not null or longitude is not null) and (latitude <> 0 or longitude <> 0)""",
)
def usable_coordinates(spark, sf):
    pings = data.pings(spark, sf)
    usable = pings.filter(P.has_position(F.col("latitude"), F.col("longitude")))
    return usable.select(*P.PING_KEY, "latitude", "longitude")


@query(
    "P13_subsets_by_bike_type",
    """select bike_type, count(*) as n, count(distinct bike_id) as bikes from started_pings
       where bike_type in ('Workshop', 'Private', 'Healthcare') group by 1""",
)
def subsets_by_type(spark, sf):
    kept = P.drop_never_started(data.pings(spark, sf)).filter(F.col("bike_type").isin("Workshop", "Private", "Healthcare"))
    return kept.groupBy("bike_type").agg(F.count("*").alias("n"), F.countDistinct("bike_id").alias("bikes"))


@query(
    "P14_null_counts",
    """select unnest(['bike_id','last_rental_start','last_gps_time','battery','bike_type','state_id','latitude','longitude']) as column_name,
       unnest([count(*) - count(bike_id), count(*) - count(last_rental_start), count(*) - count(last_gps_time),
        count(*) - count(battery), count(*) - count(bike_type), count(*) - count(state_id),
        count(*) - count(latitude), count(*) - count(longitude)]) as nulls from pings""",
)
def null_counts(spark, sf):
    return P.null_counts(data.pings(spark, sf))


@query(
    "J4_completed_pings",
    f"select * from pings where ({KEY}) in (select {KEY} from ranked_rentals where rent_rank > 1)",
)
def completed_pings(spark, sf):
    pings = data.pings(spark, sf)
    return spread_join(pings, R.completed_pairs(pings), R.RENTAL_KEY, "left_semi")


@query(
    "J5_purged_pings",
    """select p.* from pings p join ranked_rentals r on p.bike_id = r.bike_id and p.last_rental_start = r.last_rental_start
       where rent_rank = 1""",
)
def purged(spark, sf):
    pings = data.pings(spark, sf)
    return R.purge(pings, R.completed_pairs(pings))


@query(
    "J10_not_in_list",
    """select bike_id, last_rental_start, last_gps_time from pings p where not exists (
       select 1 from pings q where q.state_id = 5 and q.last_rental_start = p.last_rental_start)""",
)
def not_in_list(spark, sf):
    """Messages of start times that never reported the bike lying on the ground."""
    pings = data.pings(spark, sf)
    listed = pings.filter("state_id = 5").select("last_rental_start").distinct()
    kept = spread_join(pings, listed, ["last_rental_start"], "left_anti")
    return kept.select("bike_id", "last_rental_start", "last_gps_time")


@query(
    "J11_orphan_coordinates",
    """select count(*) as orphans from (select p.last_rental_start, p.bike_id from pings p where latitude <> 0 or longitude <> 0) c
       where not exists (select 1 from rentals r where r.last_rental_start = c.last_rental_start and r.bike_id = c.bike_id)""",
)
def orphan_coordinates(spark, sf):
    """Positions of all messages against completed rentals: those of open rentals have no parent yet."""
    pings = data.pings(spark, sf)
    usable = pings.filter(P.has_position(F.col("latitude"), F.col("longitude")))
    found = R.orphans(usable.select(F.col("last_rental_start").alias("date"), "bike_id"), R.reconstruct(pings))
    return found.agg(F.count("*").alias("orphans"))


@query(
    "L1_completed_coordinates",
    f"""select last_rental_start as date, bike_id, latitude, longitude from pings
       where ({KEY}) in (select {KEY} from ranked_rentals where rent_rank > 1)
       and (latitude is not null or longitude is not null) and (latitude <> 0 or longitude <> 0)""",
)
def completed_coordinates(spark, sf):
    pings = data.pings(spark, sf)
    return R.rental_coordinates(pings, R.completed_pairs(pings))


@query(
    "A26_processing_audit",
    """select cast(count(*) filter (where rent_rank > 1) as bigint) as processed, cast(0 as bigint) as errors
       from ranked_rentals""",
)
def processing_audit(spark, sf):
    return R.process_batch(settle(data.pings(spark, sf), "pings")).log


@query(
    "A3_rental_history",
    """select last_rental_start, bike_id, cast(last_gps_time as date) as day, max(latest) as last_gps_time,
       string_agg(battery, ',' order by last_gps_time desc) as batteries,
       cast(sum(case when latitude is null then 0 else 1 end) as integer) as positions,
       round(max_by(latitude, case when latitude is not null then last_gps_time end), 6) as newest_latitude
       from (select *, max(last_gps_time) over (partition by last_rental_start, bike_id) as latest from clean_pings) group by 1, 2, 3""",
)
def rental_history(spark, sf):
    history = R.rental_history(settle(data.cleaned(spark, sf), "cleaned"))
    known = F.filter("coordinates", lambda c: c[0].isNotNull())
    return history.select(
        *R.RENTAL_KEY,
        "day",
        "last_gps_time",
        F.concat_ws(",", F.transform("battery", lambda b: b.cast("string"))).alias("batteries"),
        F.size(known).alias("positions"),
        F.round(F.get(known, F.lit(0))[0], 6).alias("newest_latitude"),
    )


@query(
    "A4_first_valid_battery",
    """select last_rental_start, bike_id, coalesce(arg_min(battery, last_gps_time) filter (where battery > 0), -1) as start_battery
       from clean_pings group by 1, 2""",
)
def first_valid_battery(spark, sf):
    return R.first_valid_battery(data.cleaned(spark, sf))


GROUPED = """select last_rental_start, bike_id, max(last_gps_time) as last_gps_time,
       coalesce(arg_min(battery, last_gps_time) filter (where battery > 0), -1) as start_battery, count(*) as n_pings
       from clean_pings group by 1, 2"""


@query("A4_grouped_rentals", GROUPED)
def grouped_rentals(spark, sf):
    """The same battery without building arrays: what the hourly jobs read."""
    return R.grouped_rentals(data.cleaned(spark, sf))


@query(
    "A12_workshop_starts_per_day",
    """select cast(last_rental_start as date) as date, count(distinct last_rental_start) as starts
       from started_pings where bike_type = 'Workshop' group by 1""",
)
def workshop_starts(spark, sf):
    return R.starts_per_day(P.drop_never_started(data.pings(spark, sf)), "Workshop")


@query(
    "A13_date_range",
    """select bike_type, cast(min(last_rental_start) as date) as first_day, cast(max(last_rental_start) as date) as last_day
       from started_pings group by 1""",
)
def date_range(spark, sf):
    return (
        P.drop_never_started(data.pings(spark, sf))
        .groupBy("bike_type")
        .agg(
            F.to_date(F.min("last_rental_start")).alias("first_day"),
            F.to_date(F.max("last_rental_start")).alias("last_day"),
        )
    )


@query("A11_state_counts", "select state_id, count(*) as n from pings group by 1")
def state_counts(spark, sf):
    return value_counts(data.pings(spark, sf), "state_id")


@query(
    "A31_fleet_observations",
    """select bike_id, count(*) filter (where bike_type = 'DUB-General') as general,
       count(*) filter (where bike_type = 'Workshop') as workshop, count(*) filter (where bike_type = 'Private') as private,
       count(*) filter (where bike_type = 'Healthcare') as healthcare from pings group by 1""",
)
def fleet_observations(spark, sf):
    """Messages of each bike per fleet; pick a bike id to see how else it was used."""
    kinds = {"general": "DUB-General", "workshop": "Workshop", "private": "Private", "healthcare": "Healthcare"}
    counts = [F.count_if(F.col("bike_type") == kind).alias(name) for name, kind in kinds.items()]
    return data.pings(spark, sf).groupBy("bike_id").agg(*counts)


@query(
    "O1_newest_pings",
    """select bike_id, last_rental_start, last_gps_time, state_id from pings where last_rental_start in
       (select last_rental_start from pings where state_id = 5)
       order by last_rental_start desc, last_gps_time desc, bike_id limit 25""",
)
def newest_pings(spark, sf):
    pings = data.pings(spark, sf)
    marked = pings.filter("state_id = 5").select("last_rental_start").distinct()
    found = spread_join(pings, marked, ["last_rental_start"], "left_semi")
    order = [F.col("last_rental_start").desc(), F.col("last_gps_time").desc(), F.col("bike_id")]
    return found.orderBy(*order).limit(25).select("bike_id", "last_rental_start", "last_gps_time", "state_id")


@query(
    "F1_rental_duration",
    """select last_rental_start, bike_id,
       cast(greatest(datesub('minute', last_rental_start, last_gps_time), 0) as integer) as minutes,
       greatest(date_diff('microsecond', last_rental_start, last_gps_time) / 6e7, 0) as exact_minutes
       from (select last_rental_start, bike_id, max(last_gps_time) as last_gps_time from pings group by 1, 2)""",
)
def rental_duration(spark, sf):
    ends = data.pings(spark, sf).groupBy(*R.RENTAL_KEY).agg(F.max("last_gps_time").alias("last_gps_time"))
    end, start = F.col("last_gps_time"), F.col("last_rental_start")
    return ends.select(
        *R.RENTAL_KEY,
        R.rental_duration(end, start).alias("minutes"),
        duration_minutes(end, start).alias("exact_minutes"),
    )


@query(
    "S11_insert_ignore",
    """select start, bike_id, battery_start, duration from (select *, row_number() over (partition by start, bike_id
       order by late, trip_id) as rn from (select t.*, o_orderstatus <> 'F' as late from trips t
       join orders o on o.o_orderkey = t.trip_id)) where rn = 1""",
)
def insert_ignored(spark, sf):
    """Finished orders are in the store; the others arrive later and lose against a row with their key."""
    trips = data.trips(spark, sf, "o_orderstatus")
    columns = ["start", "bike_id", "battery_start", "duration"]
    key = ["start", "bike_id"]
    nothing = trips.filter(F.lit(False))
    stored = settle(insert_ignore(nothing, trips.filter("o_orderstatus = 'F'"), key, ["trip_id"]), "stored-trips")
    added = insert_ignore(stored, trips.filter("o_orderstatus <> 'F'"), key, ["trip_id"])
    return stored.select(*columns).unionByName(added.select(*columns))
