"""Source profiling: measurements of the raw event stream as Spark aggregates.

Every profile is a (small) aggregate over the whole raw table, which it reads once:
totals and shares come from the rows already grouped (one a day count, event name,
medium or bag key). Exact
percentiles use the distributed ``quantiles.exact_percentiles`` (histogram,
order-preserving bins, bounded windows), never a single-task value buffer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow import constants as C
from cohortflow.functions.params import param_int
from cohortflow.operators.quantiles import exact_percentiles
from cohortflow.session import materialize
from cohortflow.sources.schema import RAW_EVENTS

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _utc_date(col: str = "event_timestamp") -> Column:
    return F.expr(f"CAST(timestampadd(MICROSECOND, {col}, {EPOCH_NTZ}) AS DATE)")


def _with_share(grouped: DataFrame, n: str, share: str, name: str) -> DataFrame:
    """Share of a grouped row's count in the sum over all groups: the groups land, their total is a
    scalar subquery of partial sums."""
    landed = materialize(grouped, name)
    total = landed.agg(F.sum(n).cast("double").alias("n")).scalar()
    return landed.withColumn(share, F.col(n).cast("double") / total)


def prof_volume(raw: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """``users``: the counts of ``distinct.DistinctUsers`` for question ``all``; without them users are counted here.
    So for the other profiles that count users by a key."""
    found = raw.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *([] if users is not None else [F.count_distinct("user_pseudo_id").alias("n_users")]),
        F.count_distinct("user_id").alias("n_user_ids"),
        F.min("event_date").alias("min_event_date"), F.max("event_date").alias("max_event_date"),
        F.min("event_timestamp").alias("min_event_timestamp"), F.max("event_timestamp").alias("max_event_timestamp"),
    )
    return found if users is None else found.withColumn("n_users", F.coalesce(users.select("n_users").scalar(), F.lit(0)))


def prof_daily_cap(raw: DataFrame) -> DataFrame:
    per_day = raw.groupBy("event_date").agg(F.count(F.lit(1)).alias("n_rows"))
    spread = per_day.agg((F.min("n_rows") == F.max("n_rows")).alias("c")).scalar()
    return per_day.select("event_date", "n_rows", spread.alias("is_constant"))


def prof_platform_split(raw: DataFrame, users: DataFrame | None = None) -> DataFrame:
    if users is not None:
        return users.select(F.col("k1").alias("platform"), "n_rows", "n_users")
    return raw.groupBy("platform").agg(F.count(F.lit(1)).alias("n_rows"),
                                       F.count_distinct("user_pseudo_id").alias("n_users"))


def prof_events_per_user(raw: DataFrame) -> DataFrame:
    per_user = raw.groupBy("user_pseudo_id").agg(F.count(F.lit(1)).alias("n_events"))
    p = exact_percentiles(per_user, "n_events", [0.5, 0.9, 0.99], ["p50", "p90", "p99"])
    return p.select("p50", "p90", "p99", per_user.agg(F.max("n_events")).scalar().alias("max_events"))


def prof_active_days(raw: DataFrame) -> DataFrame:
    days = raw.groupBy("user_pseudo_id").agg(F.count_distinct(_utc_date()).alias("active_days"))
    return _with_share(days.groupBy("active_days").agg(F.count(F.lit(1)).alias("n_users")),
                       "n_users", "share_users", "active_days")


def _leaves(fields, prefix: str = "") -> list[str]:
    out = []
    for f in fields:
        inner = getattr(f.dataType, "fields", None)
        out += _leaves(inner, f"{prefix}{f.name}.") if inner else [prefix + f.name]
    return out


#: Label -> path of every column of the source, structs by their fields.
NULL_COVERAGE_COLUMNS = {path.replace(".", "_"): path for path in _leaves(RAW_EVENTS.fields)}


def prof_null_coverage(raw: DataFrame) -> DataFrame:
    """Non-NULL share per column in ONE pass, then unpivoted to rows."""
    wide = raw.agg(*[(F.count(F.col(path)).cast("double") / F.count(F.lit(1)).cast("double")).alias(label)
                     for label, path in NULL_COVERAGE_COLUMNS.items()])
    return wide.unpivot([], list(NULL_COVERAGE_COLUMNS), "column_name", "non_null_share")


def prof_tz_skew(raw: DataFrame) -> DataFrame:
    skewed = F.col("event_date") != F.date_format(_utc_date(), "yyyyMMdd")
    return raw.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(skewed).alias("n_skewed"),
                   F.avg(skewed.cast("double")).alias("share_skewed"))


def prof_prev_ts_anomaly(raw: DataFrame) -> DataFrame:
    return raw.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("event_previous_timestamp").isNull()).alias("n_prev_null"),
        F.count_if(F.col("event_previous_timestamp") >= F.col("event_timestamp")).alias("n_prev_ge_current"))


def prof_event_vocabulary(raw: DataFrame, users: DataFrame | None = None) -> DataFrame:
    grouped = raw.groupBy("event_name").agg(
        F.count(F.lit(1)).alias("n_events"), F.count_distinct("user_pseudo_id").alias("n_users")) if users is None else \
        users.select(F.col("k1").alias("event_name"), F.col("n_rows").alias("n_events"), "n_users")
    return _with_share(grouped, "n_events", "share_events", "event_vocabulary").orderBy(F.col("n_events").desc(), F.col("event_name"))


SLOTS = ("string", "int", "float", "double")


def _slot_counts(value: str) -> list[Column]:
    return [F.count(F.col(f"{value}.{s}_value")).alias(f"n_{s}") for s in SLOTS]


def _with_mix(keys: DataFrame) -> DataFrame:
    """Whether a key fills several value slots, and the share of its values outside the usual one."""
    counts = [F.col(f"n_{s}") for s in SLOTS]
    filled = sum(counts[1:], counts[0])
    return keys.select("*", (sum((c > 0).cast("int") for c in counts) > 1).alias("is_mixed"),
                       (F.lit(1.0) - F.greatest(*counts).cast("double") / F.nullif(filled, F.lit(0)).cast("double")).alias("share_mixed"))


def prof_param_keys(raw: DataFrame) -> DataFrame:
    """Per event-param key: appearances, which value slots are filled, how mixed."""
    e = raw.select(F.explode("event_params").alias("p"))
    return _with_mix(e.groupBy(F.col("p.key").alias("key")).agg(F.count(F.lit(1)).alias("n"), *_slot_counts("p.value")))


def prof_user_property_keys(raw: DataFrame) -> DataFrame:
    """Per user-property key: appearances, value slots, how mixed, distinct values, users, how often the set time is there."""
    e = raw.select("user_pseudo_id", F.explode("user_properties").alias("p"))
    value = F.coalesce(F.col("p.value.string_value"), F.col("p.value.int_value").cast("string"),
                       F.col("p.value.double_value").cast("string"), F.col("p.value.float_value").cast("string"))
    return _with_mix(e.groupBy(F.col("p.key").alias("key")).agg(
        F.count(F.lit(1)).alias("n"), *_slot_counts("p.value"), F.count("p.value.set_timestamp_micros").alias("n_set_timestamp"),
        F.count_distinct(value).alias("n_distinct_values"), F.count_distinct("user_pseudo_id").alias("n_users")))


def prof_engagement_dist(raw: DataFrame) -> DataFrame:
    """From one histogram by value, written once; the wide bag column is read a single time."""
    eng = raw.select(param_int("event_params", C.ENGAGEMENT_KEY).alias("ms")).where(F.col("ms").isNotNull())
    hist = materialize(eng.groupBy("ms").agg(F.count(F.lit(1)).alias("n")), "engagement_histogram")
    p = exact_percentiles(hist, "ms", [0.5, 0.99], ["p50", "p99"], freq="n")
    counts = hist.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.when(F.col("ms") < 0, F.col("n"))), F.lit(0)).alias("n_negative"),
                      F.max("ms").alias("max_ms"))
    return counts.select("n", "n_negative", p.select("p50").scalar().alias("p50"),
                         p.select("p99").scalar().alias("p99"), "max_ms")


def prof_duplicates(raw: DataFrame) -> DataFrame:
    keys = raw.groupBy("user_pseudo_id", "event_timestamp", "event_name").agg(F.count(F.lit(1)).alias("c"))
    return keys.where(F.col("c") > 1).agg(F.count(F.lit(1)).alias("n_duplicate_keys"),
                                          F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("n_extra_rows"))


def prof_identity_exclusivity(raw: DataFrame) -> DataFrame:
    """How many partners a value has at most, for five pairings, in one pass.

    Raw rows collapse to (user, stream, app, platform) first; each of those gives a row a pairing,
    and the distinct partners of a value are counted.
    """
    combos = raw.groupBy("user_pseudo_id", "stream_id", F.col("app_info.id").alias("app_id"), "platform").agg(F.count(F.lit(1)))
    pairs = {"users": ("user_pseudo_id", "platform"), "max_platforms_per_stream": ("stream_id", "platform"),
             "max_streams_per_platform": ("platform", "stream_id"), "max_platforms_per_app": ("app_id", "platform"),
             "max_apps_per_platform": ("platform", "app_id")}
    rows = combos.select(F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(a).alias("a"), F.col(b).alias("b"))
                                             for k, (a, b) in pairs.items()])).alias("p")).select("p.*").distinct()
    fan = rows.groupBy("k", "a").agg(F.count("b").alias("n"))
    return fan.agg(F.count_if((F.col("k") == "users") & (F.col("n") > 1)).alias("users_on_many_platforms"),
                   *[F.max(F.when(F.col("k") == k, F.col("n"))).alias(k) for k in pairs if k != "users"])


def prof_first_touch_mismatch(raw: DataFrame) -> DataFrame:
    users = materialize(raw.groupBy("user_pseudo_id").agg(F.min("user_first_touch_timestamp").alias("ft"),
                                                          F.min("event_timestamp").alias("fe")), "first_touch")
    data_start = users.agg(F.min("fe")).scalar()
    cat = (F.when(F.col("ft").isNull(), F.lit("no_first_touch"))
            .when(F.col("ft") < data_start, F.lit("before_window"))
            .when(F.col("ft") > F.col("fe"), F.lit("after_first_event"))
            .otherwise(F.lit("consistent")))
    return users.groupBy(cat.alias("category")).agg(F.count(F.lit(1)).alias("n_users"))


def prof_first_open_coverage(stg: DataFrame) -> DataFrame:
    per_user = stg.groupBy("user_pseudo_id").agg(
        F.count_if(F.col("event_name") == C.FIRST_OPEN_EVENT).alias("fo"),
        F.coalesce(F.bool_or(F.col("previous_first_open_count") > 0), F.lit(False)).alias("re"))
    return per_user.agg(F.count(F.lit(1)).alias("n_users"),
                        F.count_if(F.col("fo") > 0).alias("users_with_first_open"),
                        F.count_if(F.col("re")).alias("users_reinstalled"))


def prof_literal_nan(raw: DataFrame) -> DataFrame:
    nan = F.col("device.operating_system") == C.NAN_LITERAL
    return raw.agg(F.count_if(nan).alias("n_nan_rows"),
                   F.count_distinct(F.when(nan, F.col("user_pseudo_id"))).alias("n_nan_users"),
                   F.count(F.lit(1)).alias("n_rows"))


def prof_traffic_mix(raw: DataFrame, users: DataFrame | None = None) -> DataFrame:
    grouped = raw.groupBy(F.col("traffic_source.source").alias("source"),
                          F.col("traffic_source.medium").alias("medium")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("user_pseudo_id").alias("n_users")) if users is None else \
        users.select(F.col("k1").alias("source"), F.col("k2").alias("medium"), "n_rows", "n_users")
    return _with_share(grouped, "n_rows", "share_rows", "traffic_mix")


def prof_revenue_signals(raw: DataFrame) -> DataFrame:
    """Purchase-event payers vs lifetime-value payers, and the gap between them, in one pass:
    rows collapse to (user, currency), which count once as a user and once as a currency."""
    paid = (F.col("event_name") == C.PURCHASE_EVENT) & (F.col("event_value_in_usd") > 0)
    flags = raw.groupBy("user_pseudo_id", F.col("user_ltv.currency").alias("currency")).agg(
        F.coalesce(F.bool_or(paid), F.lit(False)).alias("paid"),
        F.coalesce(F.bool_or(F.col("user_ltv.revenue") > 0), F.lit(False)).alias("ltv"))
    keyed = flags.select("paid", "ltv", F.explode(F.array(
        F.struct(F.lit("user").alias("kind"), F.col("user_pseudo_id").alias("key")),
        F.struct(F.lit("currency").alias("kind"), F.col("currency").alias("key")))).alias("k"))
    by_key = keyed.where(F.col("k.key").isNotNull()).groupBy("k").agg(F.bool_or("paid").alias("paid"), F.bool_or("ltv").alias("ltv"))
    user = F.col("k.kind") == "user"
    return by_key.agg(F.count_if(user & F.col("paid")).alias("n_event_payers"), F.count_if(user & F.col("ltv")).alias("n_ltv_payers"),
                      F.count_if(user & F.col("ltv") & ~F.col("paid")).alias("n_ltv_without_purchase"),
                      F.count_if(~user).alias("n_ltv_currencies"))


def prof_ltv_by_currency(raw: DataFrame) -> DataFrame:
    """Lifetime value by currency: rows, users, users above zero, largest value."""
    revenue = F.col("user_ltv.revenue")
    return raw.where(F.col("user_ltv.currency").isNotNull()).groupBy(F.col("user_ltv.currency").alias("currency")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("user_pseudo_id").alias("n_users"),
        F.count_distinct(F.when(revenue > 0, F.col("user_pseudo_id"))).alias("n_payers"), F.max(revenue).alias("max_revenue"))
