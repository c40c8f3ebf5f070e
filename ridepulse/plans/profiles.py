"""Queries on distributions, groups, outliers, tests and serial correlation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calendar import hours_since, month_name
from ..functions.calendar import at_hour
from ..operators import hourly as H
from ..operators import profile as P
from ..operators import stats as S
from . import data
from .catalog import query

# The factors whose levels are compared.
BOX_FACTORS = [
    "season", "dayofweek", "working_day", "timesofday", "rainfall_intensity", "month", "holiday", "hour",
    "wind_speed_group", "peak", "temp_bin", "rhum_bin",
]
ZERO_FACTORS = ["timesofday", "dayofweek", "rainfall_intensity", "working_day", "peak", "holiday"]
HOURLY_FACTORS = ["season", "dayofweek", "working_day", "timesofday"]
LIMIT = 4


def per_factor(factors, body: str, source: str = "features", fixed: str = "") -> str:
    return " union all ".join(
        f"select {fixed}'{f}' as factor, cast({f} as varchar) as level, {body} from {source} group by all" for f in factors
    )


@query("A11_rainfall_counts", "select rainfall_intensity, count(*) as n from features group by 1")
def rainfall_counts(spark, sf):
    return P.value_counts(data.features(spark, sf), "rainfall_intensity").orderBy(F.col("n").desc())


@query(
    "A11_working_day_share",
    f"select working_day, count(*) / sum(count(*)) over () as share from features where demand > {LIMIT} group by 1",
)
def working_day_share(spark, sf):
    busy = data.features(spark, sf).filter(F.col("demand") > LIMIT)
    return P.value_counts(busy, "working_day", normalize=True)


@query(
    "A14_mean_duration",
    per_factor(["season", "dayofweek", "holiday", "timesofday"], "avg(duration) as mean_duration, count(*) as n", "trip_features"),
)
def mean_duration(spark, sf):
    trips = data.rentals_with_weather(spark, sf)
    wanted = [F.avg("duration").alias("mean_duration"), F.count("*").alias("n")]
    return P.by_each(trips, ["season", "dayofweek", "holiday", "timesofday"], wanted)


@query("A14_mean_duration_overall", "select round(avg(duration), 2) as mean_duration from trips")
def mean_duration_overall(spark, sf):
    return data.trips(spark, sf).agg(F.round(F.avg("duration"), 2).alias("mean_duration"))


@query(
    "A15_rentals_by_factor",
    per_factor(["season", "dayofweek", "working_day", "timesofday"], "cast(sum(demand) as bigint) as total, avg(demand) as mean"),
)
def rentals_by_factor(spark, sf):
    wanted = [F.sum("demand").alias("total"), F.avg("demand").alias("mean")]
    return P.by_each(data.features(spark, sf), HOURLY_FACTORS, wanted)


@query("A16_mean_by_hour_and_factor", per_factor(HOURLY_FACTORS, "avg(demand) as mean", fixed="hour, "))
def mean_by_hour(spark, sf):
    """Four group-bys in one scan."""
    return P.by_each(data.features(spark, sf), HOURLY_FACTORS, [F.avg("demand").alias("mean")], fixed=["hour"])


@query(
    "A17_monthly_totals",
    """select strftime(make_date(2000, month, 1), '%b') as month_name, cast(sum(demand) as bigint) as total_rentals
       from features group by month""",
)
def monthly_totals(spark, sf):
    totals = data.features(spark, sf).groupBy("month").agg(F.sum("demand").alias("total_rentals"))
    return totals.select(month_name(F.col("month")).alias("month_name"), "total_rentals")


@query(
    "A17_monthly_mean_and_std",
    """select round(avg(total), 2) as mean, round(stddev_samp(total), 2) as std from
       (select month, sum(demand) as total from features group by 1)""",
)
def monthly_mean_and_std(spark, sf):
    totals = data.features(spark, sf).groupBy("month").agg(F.sum("demand").alias("total"))
    return totals.agg(F.round(F.avg("total"), 2).alias("mean"), F.round(F.stddev_samp("total"), 2).alias("std"))


BOX = """select factor, level, q1, median, q3, min(v) filter (where v >= q1 - 1.5e0*(q3-q1) and v <= q3 + 1.5e0*(q3-q1)) as whisker_low,
       max(v) filter (where v >= q1 - 1.5e0*(q3-q1) and v <= q3 + 1.5e0*(q3-q1)) as whisker_high,
       count(*) filter (where v < q1 - 1.5e0*(q3-q1) or v > q3 + 1.5e0*(q3-q1)) as outliers, count(*) as n from (
       select *, quantile_cont(v, 0.25) over w as q1, quantile_cont(v, 0.5) over w as median, quantile_cont(v, 0.75) over w as q3
       from ({rows}) window w as (partition by factor, level)) group by 1, 2, 3, 4, 5"""


def box_rows(factors, value, source):
    return " union all ".join(f"select '{f}' as factor, cast({f} as varchar) as level, {value} as v from {source}" for f in factors)


@query("A18_box_stats_of_demand", BOX.format(rows=box_rows(BOX_FACTORS, "demand", "binned")))
def box_stats(spark, sf):
    return P.box_stats(data.binned_features(spark, sf), "demand", BOX_FACTORS)


@query(
    "A18_box_stats_overall",
    BOX.format(rows="select 'everything' as factor, 'all' as level, demand as v from fact"),
)
def box_stats_overall(spark, sf):
    rows = data.fact(spark, sf).select("demand", F.lit("all").alias("everything"))
    return P.box_stats(rows, "demand", ["everything"])


@query(
    "A18_box_stats_of_quantity",
    BOX.format(rows=box_rows(["l_returnflag", "l_linestatus"], "l_quantity", "lineitem")),
)
def box_stats_quantity(spark, sf):
    """The same operator over the largest table."""
    return P.box_stats(data.table(spark, sf, "lineitem"), "l_quantity", ["l_returnflag", "l_linestatus"])


@query("A19_discrete_histogram", "select timesofday, demand, count(*) as n from features group by 1, 2")
def discrete_histogram(spark, sf):
    return data.features(spark, sf).groupBy("timesofday", "demand").agg(F.count("*").alias("n"))


HIST = """select cast(least(floor((v - lo) / ((hi - lo) / {bins}e0)), {bins} - 1) as integer) as bin, count(*) as n
       from (select {value} as v, min({value}) over () as lo, max({value}) over () as hi from {source}) group by 1"""


@query("A19_binned_temperature", HIST.format(value="temp", bins=20, source="weather"))
def binned_temperature(spark, sf):
    return P.histogram(data.weather(spark, sf), "temp", 20)


@query("A19_binned_price", HIST.format(value="l_extendedprice", bins=50, source="lineitem"))
def binned_price(spark, sf):
    return P.histogram(data.table(spark, sf, "lineitem"), "l_extendedprice", 50)


@query("A19_tallest_bar", "select demand, count(*) as n from fact group by 1 order by n desc, demand limit 1")
def tallest_bar(spark, sf):
    return P.tallest_bar(P.value_counts(data.fact(spark, sf), "demand"), "demand")


ZEROS = """count(*) filter (where demand = 0) / count(*) * 100 as zeros_pct, avg(demand) as mean,
       round(var_samp(demand), 6) as var, round(stddev_samp(demand), 6) as std, count(*) as n"""


def rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query("A20_zero_summary", f"select {ZEROS} from fact")
def zero_summary(spark, sf):
    return rounded(P.zero_summary(data.fact(spark, sf)), "var", "std")


@query("A20_zero_summary_by_period", f"select timesofday, {ZEROS} from features group by 1")
def zero_summary_by_period(spark, sf):
    return rounded(P.zero_summary(data.features(spark, sf), ["timesofday"]), "var", "std")


DESCRIBE = """select count({v}) as count, round(avg({v}), 6) as mean, round(stddev_samp({v}), 6) as std, min({v}) as min, max({v}) as max,
       round(var_samp({v}), 6) as variance, quantile_cont({v}, 0.1) as p10, quantile_cont({v}, 0.25) as p25,
       quantile_cont({v}, 0.5) as p50, quantile_cont({v}, 0.75) as p75, quantile_cont({v}, 0.9) as p90 from {t}"""


@query("A21_describe_demand", DESCRIBE.format(v="demand", t="fact"))
def describe_demand(spark, sf):
    return rounded(P.describe(data.fact(spark, sf), "demand"), "mean", "std", "variance")


@query("A21_describe_daily", DESCRIBE.format(v="daily_rentals", t="daily"))
def describe_daily(spark, sf):
    daily = H.daily_totals(data.fact(spark, sf))
    return rounded(P.describe(daily, "daily_rentals"), "mean", "std", "variance")


@query("A21_describe_quantity", DESCRIBE.format(v="l_quantity", t="lineitem"))
def describe_quantity(spark, sf):
    return rounded(P.describe(data.table(spark, sf, "lineitem"), "l_quantity"), "mean", "std", "variance")


@query(
    "A22_dispersion",
    "select round(var_samp(demand) / avg(demand), 6) as dispersion, var_samp(demand) / avg(demand) > 2 as overdispersed from fact",
)
def dispersion(spark, sf):
    return rounded(P.dispersion(data.fact(spark, sf)), "dispersion")


@query("A23_zero_hours_by_factor", per_factor(ZERO_FACTORS, "count(*) as n", "(select * from features where demand = 0)"))
def zero_hours(spark, sf):
    zero = data.features(spark, sf).filter("demand = 0")
    return P.by_each(zero, ZERO_FACTORS, [F.count("*").alias("n")])


@query("A24_quiet_days", "select date, daily_rentals from daily where daily_rentals < 45")
def quiet_days(spark, sf):
    return H.daily_totals(data.fact(spark, sf)).filter("daily_rentals < 45")


@query(
    "A24_unusual_days",
    "select * from daily where daily_rentals > (select avg(daily_rentals) + 2 * stddev_samp(daily_rentals) from daily)",
)
def unusual_days(spark, sf):
    return P.unusual_days(H.daily_totals(data.fact(spark, sf)), "daily_rentals")


@query(
    "A25_outlier_share",
    f"""select count(*) filter (where demand > {LIMIT}) as outliers,
        round(count(*) filter (where demand > {LIMIT}) / count(*) * 100, 2) as outliers_pct, round(avg(demand), 2) as mean_all,
        round(avg(demand) filter (where demand <= {LIMIT}), 2) as mean_without from fact""",
)
def outlier_share(spark, sf):
    return P.outlier_share(data.fact(spark, sf), LIMIT)


@query(
    "A25_daily_mean_without_outliers",
    f"""select (select round(avg(daily_rentals), 2) from daily) as mean_daily, (select round(avg(s), 2) from
        (select sum(demand) as s from fact where demand <= {LIMIT} group by date)) as mean_daily_without""",
)
def daily_mean_without_outliers(spark, sf):
    days = data.fact(spark, sf).groupBy("date").agg(
        F.sum("demand").alias("a"), F.sum(F.when(F.col("demand") <= LIMIT, F.col("demand"))).alias("b")
    )
    return days.agg(F.round(F.avg("a"), 2).alias("mean_daily"), F.round(F.avg("b"), 2).alias("mean_daily_without"))


CORR = ["temp", "wdsp", "rhum", "rain", "demand"]


@query(
    "A28_correlation_matrix",
    " union all ".join(f"select '{a}' as \"left\", '{b}' as \"right\", round(corr({a}, {b}), 6) as corr from fact" for a in CORR for b in CORR),
)
def correlation_matrix(spark, sf):
    return rounded(P.correlations(data.fact(spark, sf), CORR), "corr")


@query(
    "A28_correlation_with_target",
    " union all ".join(f"select '{a}' as \"left\", round(corr({a}, demand), 6) as corr from fact" for a in CORR[:-1]),
)
def correlation_with_target(spark, sf):
    found = P.correlations(data.fact(spark, sf), CORR).filter("right = 'demand' and left <> 'demand'")
    return rounded(found, "corr").select("left", "corr").orderBy(F.col("corr").desc())


VOLUME = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "A28_correlation_volume",
    " union all ".join(f"select '{a}' as \"left\", '{b}' as \"right\", round(corr({a}, {b}), 6) as corr from lineitem" for a in VOLUME for b in VOLUME),
)
def correlation_volume(spark, sf):
    return rounded(P.correlations(data.table(spark, sf, "lineitem"), VOLUME), "corr")


def skew_sql(columns, source):
    one = """select '{c}' as column_name, round((select avg(power({c} - m, 3)) from {s}, (select avg({c}) as m from {s}))
        / power((select var_pop({c}) from {s}), 1.5), 6) as skew"""
    return " union all ".join(one.format(c=c, s=source) for c in columns)


@query("A29_skewness", skew_sql(["temp", "rhum", "wdsp", "demand"], "fact"))
def skewness(spark, sf):
    return rounded(P.skewness(data.fact(spark, sf), ["temp", "rhum", "wdsp", "demand"]), "skew")


@query("A29_skewness_volume", skew_sql(["l_quantity", "l_extendedprice"], "lineitem"))
def skewness_volume(spark, sf):
    return rounded(P.skewness(data.table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"]), "skew")


@query(
    "W5_average_rank",
    """select demand, count(*) as ties, avg(rn) as avg_rank from
       (select demand, row_number() over (order by demand) as rn from fact) group by 1""",
)
def average_rank(spark, sf):
    return S.average_ranks(data.fact(spark, sf), "demand")


@query(
    "W5_average_rank_volume",
    """select l_quantity, count(*) as ties, avg(rn) as avg_rank from
       (select l_quantity, row_number() over (order by l_quantity) as rn from lineitem) group by 1""",
)
def average_rank_volume(spark, sf):
    return S.average_ranks(data.table(spark, sf, "lineitem"), "l_quantity")


def series(spark, sf):
    """Demand by gapless hour index, and its distance from the mean as residual."""
    fact = data.fact(spark, sf)
    first = fact.agg(F.min(at_hour(F.col("date"), F.col("hour")))).scalar()
    hours = fact.select(hours_since(first, at_hour(F.col("date"), F.col("hour"))).alias("i"), "demand")
    mean = fact.agg(F.avg("demand")).scalar()
    return hours.withColumn("residual", F.col("demand") - mean)


SERIES = """select date_diff('hour', min(date + to_hours(cast(hour as bigint))) over (), date + to_hours(cast(hour as bigint))) as i,
       demand, demand - avg(demand) over () as residual from fact"""


@query(
    "W6_lagged_difference",
    f"select i, demand - lag(demand) over (order by i) as step, lag(demand, 24) over (order by i) as day_before from ({SERIES})",
)
def lagged_difference(spark, sf):
    lagged = S.with_lags(series(spark, sf), "i", "demand", 24, width=1000)
    return lagged.select("i", (F.col("demand") - F.col("lag_1")).alias("step"), F.col("lag_24").alias("day_before"))


@query(
    "M13_durbin_watson",
    f"""select round(sum(d * d) / sum(residual * residual), 6) as durbin_watson from
        (select residual, residual - lag(residual) over (order by i) as d from ({SERIES}))""",
)
def durbin_watson(spark, sf):
    return rounded(S.durbin_watson(series(spark, sf), "i", "residual"), "durbin_watson")


LAGS = 30


@query(
    "M14_autocorrelation",
    " union all ".join(
        f"select {k} as lag, round(sum(residual * p) / sum(residual * residual), 6) as acf from "
        f"(select residual, lag(residual, {k}) over (order by i) as p from ({SERIES}))"
        for k in range(LAGS + 1)
    ),
)
def autocorrelation(spark, sf):
    return rounded(S.autocorrelation(series(spark, sf), "i", "residual", LAGS), "acf")


# Order by order: the new coefficient, and the earlier ones less their share of it.
PARTIAL = f"""with recursive residuals as ({SERIES}), steps as (
       select 0 as k, cast([] as double[]) as phi, 1e0 as pacf, list(acf order by lag) as r from (
        select lag, sum(a.residual * b.residual) / (select sum(residual * residual) from residuals) as acf
        from residuals a, range({LAGS + 1}) l(lag), residuals b where b.i = a.i - lag group by lag)
       union all select k + 1, list_append(list_transform(range(1, k + 1), lambda j: phi[j] - one * phi[k + 1 - j]), one), one, r from (
        select *, (r[k + 2] - coalesce(list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[k + 2 - j])), 0))
         / (1 - coalesce(list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[j + 1])), 0)) as one from steps where k < {LAGS}))
       select cast(k as integer) as lag, round(pacf, 6) as pacf from steps"""


@query("M14_partial_autocorrelation", PARTIAL)
def partial_autocorrelation(spark, sf):
    return rounded(S.partial_autocorrelation(series(spark, sf), "i", "residual", LAGS), "pacf")


# The factors that are tested.
KW_FACTORS = [
    "season", "hour", "holiday", "working_day", "peak", "timesofday", "rainfall_intensity", "dayofweek", "temp_bin",
    "rhum_bin", "wind_speed_group", "wind_bft",
]

_RANKED = "(select *, (cum - (t - 1) / 2e0) as rk from (select f.*, t, cum from binned f join (select demand, t, sum(t) over (order by demand) as cum from (select demand, count(*) as t from fact group by 1)) r on f.demand = r.demand))"


KRUSKAL = (
    f"""select factor, (12e0 / (n * (n + 1e0)) * s - 3 * (n + 1)) / (1 - tt / (cast(n as double) * n * n - n)) as h, k - 1 as freedom
        from (select factor, sum(rs * rs / c) as s, count(*) as k from ("""
    + per_factor(KW_FACTORS, "sum(rk) as rs, count(*) as c", _RANKED)
    + """) group by 1), (select count(*) as n from fact),
        (select sum(cast(t as double) * t * t - t) as tt from (select count(*) as t from fact group by demand))"""
)
# 5 % points of the chi-square distribution for 1 to 30 degrees of freedom.
CRITICAL = [
    3.841, 5.991, 7.815, 9.488, 11.070, 12.592, 14.067, 15.507, 16.919, 18.307, 19.675, 21.026, 22.362, 23.685, 24.996,
    26.296, 27.587, 28.869, 30.144, 31.410, 32.671, 33.924, 35.172, 36.415, 37.652, 38.885, 40.113, 41.337, 42.557, 43.773,
]


@query("M12_kruskal_wallis", f"select factor, round(h, 6) as h, freedom from ({KRUSKAL})")
def kruskal_wallis(spark, sf):
    return rounded(S.kruskal_wallis(data.binned_features(spark, sf), "demand", KW_FACTORS), "h")


@query("M12_kruskal_decision", f"select factor, h > ({CRITICAL})[freedom] as related, h > 0 as positive from ({KRUSKAL})")
def kruskal_decision(spark, sf):
    """Which factors the demand differs by; SQL looks the decision up in a table of 5 % points."""
    found = S.kruskal_decision(data.binned_features(spark, sf), "demand", KW_FACTORS)
    return found.select("factor", "related", ((F.col("h") > 0) & F.col("p_value").between(0, 1)).alias("positive"))
