"""Data-quality rules as Columns: ranges, contract, cross-field checks, anomalies, keys, counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadflow.functions import fixed
from roadflow.functions.congestion import congestion_score, level_of_score
from roadflow.functions.times import day_name, is_weekend, micros_between, plus_millis, plus_minutes
from roadflow.operators.records import failed_codes, failing
from roadflow.session import staged


def range_rules() -> dict[str, Column]:
    """Code to failure condition of the plausible ranges; NULL never fails."""
    bounds = {
        "latitude": (-90, 90),
        "longitude": (-180, 180),
        "occupancy_pct": (0, 100),
        "hour_of_day": (0, 23),
    }
    rules = {c: ~F.col(c).between(low, high) for c, (low, high) in bounds.items()}
    rules |= {c: F.col(c) < 0 for c in ("vehicle_count", "avg_speed_kmph", "incident_duration_minutes")}
    return rules


def range_violations(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows out of range and which fields are; of ``columns`` only if given, so that a scan reads no others."""
    rules = range_rules()
    if columns is None:
        return failing(df, rules, "failed")
    read = list(dict.fromkeys([*columns, *rules]))
    return failing(df.select(*read), rules, "failed").select(*columns, "failed")


def cross_field_rules(interval_seconds: int = 60) -> dict[str, Column]:
    """Failure conditions that tie fields of an event together, or to its segment's attributes."""
    speed, closed = F.col("avg_speed_kmph"), F.col("incident_type").eqNullSafe(F.lit("Road_Closure"))
    none = F.col("incident_type").eqNullSafe(F.lit("None"))
    duration = F.col("incident_duration_minutes")
    cap = F.ceil(F.col("capacity_vehicles_per_minute") * float(interval_seconds) / 60.0)
    return {
        "speed_over_limit": speed > F.col("speed_limit_kmph"),
        "stopped_on_open_road": (speed == 0) & ~closed,
        "duration_without_incident": none & (duration != 0),
        "incident_without_duration": ~none & F.col("incident_type").isNotNull() & (duration <= 0),
        "weekend_flag": F.col("is_weekend") != F.col("day_of_week").isin("Saturday", "Sunday"),
        "weekend_day": F.col("is_weekend") != is_weekend("event_ts"),
        "day_name": F.col("day_of_week") != day_name("event_ts"),
        "hour": F.col("hour_of_day") != F.hour("event_ts"),
        "count_over_capacity": F.col("vehicle_count") > cap,
    }


def congestion_mismatches(enriched: DataFrame, level: str = "congestion_level") -> DataFrame:
    """Events whose stored level is not the one their speed, limit and occupancy give."""
    closed = F.col("incident_type").eqNullSafe(F.lit("Road_Closure"))
    score = congestion_score("avg_speed_kmph", "speed_limit_kmph", "occupancy_pct")
    return (
        enriched.withColumn("expected_level", level_of_score(score, closed))
        .filter(F.col("expected_level").isNotNull())
        .filter(~F.col(level).eqNullSafe(F.col("expected_level")))
    )


def absent_fields(df: DataFrame, columns: Sequence[str] = tuple(fixed.OPTIONAL_COLUMNS)) -> dict[str, Column]:
    """For each field whether it is NULL or NaN."""
    kinds = dict(df.dtypes)
    return {c: F.col(c).isNull() | F.isnan(c) if kinds[c] == "double" else F.col(c).isNull() for c in columns}


def missing_optional(
    df: DataFrame, columns: Sequence[str] = tuple(fixed.OPTIONAL_COLUMNS), keep: Sequence[str] | None = None
) -> DataFrame:
    """Rows with a NULL or NaN optional field, and which fields; of the ``keep`` columns only if given."""
    gone = absent_fields(df, columns)
    if keep is None:
        return failing(df, gone, "missing_fields")
    read = list(dict.fromkeys([*keep, *columns]))
    return failing(df.select(*read), gone, "missing_fields").select(*keep, "missing_fields")


def detect_anomalies(events: DataFrame, key: str = "event_id", segment_limit: str | None = None) -> DataFrame:
    """Label each row from its values: Duplicate, Delayed, Missing_Field, Invalid_Value, all that apply.

    A duplicate is every row of a key but one that arrived first. Only keys with several rows are looked up, from a
    table written once, so the events are shuffled only if those keys are many. Rows that arrived first together are
    folded by their whole content before they meet, so a hot id that was delivered again and again unchanged is no
    large group; of n equal rows n - 1 are duplicates.
    """
    columns = events.columns
    arrival = F.struct(F.col("generated_at").isNull().alias("none"), "generated_at")
    repeated = staged(
        events.groupBy(key)
        .agg(F.min(arrival).alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select(key, F.col("first.generated_at").alias("first_arrival"), F.lit(True).alias("again")),
        "repeated-keys",
    )
    known = events.join(repeated, key, "left").withColumn(
        "_tied", F.col("again") & F.col("generated_at").eqNullSafe(F.col("first_arrival"))
    )
    folded = known.filter("_tied").groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    variant = F.row_number().over(Window.partitionBy(key).orderBy(F.xxhash64(*columns), *columns))
    tied = folded.withColumn("_variant", variant).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    tied = tied.select(*columns, ((F.col("_variant") > 1) | (F.col("_copy") > 1)).alias("_duplicate"))
    others = known.filter(~F.coalesce("_tied", F.lit(False))).select(
        *columns, F.coalesce("again", F.lit(False)).alias("_duplicate")
    )
    events = others.unionByName(tied)
    limit = F.col(segment_limit) if segment_limit else F.lit(fixed.SPEED_CEILING)
    absent = F.lit(False)
    for gone in absent_fields(events).values():
        absent = absent | gone
    invalid = [
        F.col("vehicle_count") < 0,
        F.col("avg_speed_kmph") > limit,
        F.col("occupancy_pct") > 100,
        F.col("latitude") == 0,
    ]
    bad = F.lit(False)
    for condition in invalid:
        bad = bad | F.coalesce(condition, F.lit(False))
    late = micros_between("event_ts", "generated_at") >= fixed.DELAY_FROM_MINUTES * 60_000_000
    found = {
        "Duplicate": F.col("_duplicate"),
        "Delayed": late,
        "Missing_Field": absent,
        "Invalid_Value": bad,
    }
    return events.withColumn("detected", failed_codes(found)).drop("_duplicate")


def anomaly_rates(df: DataFrame, label: str = "anomaly_type") -> DataFrame:
    """Rows per label and their share of all rows."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return with_share(counts, "n", "rate")


def with_share(groups: DataFrame, count: str, target: str, places: int = 6) -> DataFrame:
    """Share of a grouped count in the grand total; the groups, not the rows, meet in one place."""
    total = groups.agg(F.sum(count)).scalar()
    return groups.withColumn(target, F.round(F.col(count) / total, places))


def band_of(key: Column, seed: int) -> Column:
    """Evenly spread number 0..9999 that depends only on the key and the seed."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 10000).cast("int")


def inject_faults(
    events: DataFrame,
    seed: int = 7,
    delayed_pct: float = 0,
    missing_pct: float = 0,
    invalid_pct: float = 0,
    duplicate_pct: float = 0,
    key: str = "event_id",
) -> DataFrame:
    """Labelled faults in disjoint shares of the rows, the same on every run.

    A row's share is decided by a hash of its key, so no order or count over the table is needed and each
    task works alone; the shares are met on average. Copies keep all values of a row without a fault and
    arrive 1 to 30 seconds later.
    """
    band, pick = band_of(F.col(key), seed), band_of(F.col(key), seed + 1)
    shares = {"Delayed": delayed_pct, "Missing_Field": missing_pct, "Invalid_Value": invalid_pct, "Duplicate": duplicate_pct}
    if min(shares.values()) < 0 or sum(shares.values()) > 100:
        raise ValueError("fault shares must be 0 or more and add up to at most 100 percent")
    label, upto = F.when(F.lit(False), ""), 0
    for name, pct in shares.items():
        upto += round(pct * 100)
        label = label.when(F.col("_band") < upto, name)
    marked = events.withColumns({"_band": band, "_pick": pick}).withColumn("_fault", label)

    def hit(fault: str, choice: int, choices: int) -> Column:
        return F.col("_fault").eqNullSafe(fault) & (F.col("_pick") % choices == choice)

    optional = fixed.OPTIONAL_COLUMNS
    changed = {c: F.when(~hit("Missing_Field", i, len(optional)), F.col(c)) for i, c in enumerate(optional)}
    bad = {
        "vehicle_count": -(F.col("_pick") % 49 + 1),
        "avg_speed_kmph": F.lit(150.0) + F.col("_pick") % 150,
        "occupancy_pct": F.lit(100.5) + F.col("_pick") % 49,
        "latitude": F.lit(0.0),
    }
    for i, (c, value) in enumerate(bad.items()):
        base = changed.get(c, F.col(c))
        changed[c] = F.when(hit("Invalid_Value", i, len(bad)), value).otherwise(base)
    delay = F.when(F.col("_fault").eqNullSafe("Delayed"), F.col("_pick") % 116 + 5).otherwise(0)
    copies = F.when(F.col("_fault").eqNullSafe("Duplicate"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    faulty = marked.withColumn("_copy", F.explode(copies)).withColumns(
        changed
        | {
            "generated_at": plus_millis(
                plus_minutes("generated_at", delay), F.col("_copy") * (F.col("_pick") % 30 + 1) * 1000
            ),
            "anomaly_type": F.when(F.col("_fault").isNull(), F.lit("None"))
            .when((F.col("_fault") == "Duplicate") & (F.col("_copy") == 0), F.lit("None"))
            .otherwise(F.col("_fault")),
        }
    )
    return faulty.select(*events.columns)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count; no row means the key is unique."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def smallest_group(df: DataFrame, group: str, required: int) -> DataFrame:
    """Size of the smallest group, and whether every group has the required size."""
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.min("n").alias("smallest"), (F.min("n") >= required).alias("enough"))


def reconcile(counts: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each named table, and the difference from the first one."""
    parts = None
    for i, (name, df) in enumerate(counts.items()):
        part = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("step"), F.lit(name).alias("table"), "n")
        parts = part if parts is None else parts.unionByName(part)
    first = parts.filter("step = 0").agg(F.max("n")).scalar()
    return parts.withColumn("difference", F.col("n") - first)


def segment_rules() -> dict[str, Column]:
    """Failure conditions of segment attributes."""
    return {
        "road_type": ~F.col("road_type").isin(fixed.ROAD_TYPES),
        "latitude": ~F.col("latitude").between(*fixed.LATITUDE_BOX),
        "longitude": ~F.col("longitude").between(*fixed.LONGITUDE_BOX),
        "lane_count": F.col("lane_count") < 2,
        "speed_limit_kmph": ~F.col("speed_limit_kmph").between(20, 100),
        "capacity_vehicles_per_minute": F.col("capacity_vehicles_per_minute") <= 0,
        "free_flow_ratio": (F.col("free_flow_ratio") <= 0) | (F.col("free_flow_ratio") > 1),
        "road_segment_id": F.col("road_segment_id").isNull(),
        "unknown_area": F.col("area").isNull() | ~F.col("area").isin(list(fixed.AREAS.values())),
    }


def dimension_problems(
    segments: DataFrame, profiles: DataFrame | None = None, per_area: tuple[int, int] | None = None
) -> DataFrame:
    """All problems of the dimension data as rows (subject, problem): fields, ids, sizes, profiles."""
    absent = [c for c in fixed.SEGMENT_COLUMNS if c not in segments.columns]
    if absent:
        raise ValueError(f"segment table lacks {', '.join(absent)}")
    found = failing(segments, segment_rules(), "problem").select(
        F.col("road_segment_id").alias("subject"), F.explode(F.split("problem", ",")).alias("problem")
    )
    twice = repeated_keys(segments, ["road_segment_id"])
    found = found.unionByName(twice.select(F.col("road_segment_id").alias("subject"), F.lit("repeated_id").alias("problem")))
    if per_area:
        sizes = segments.groupBy("area_id").agg(F.count(F.lit(1)).alias("n")).filter(~F.col("n").between(*per_area))
        found = found.unionByName(sizes.select(F.col("area_id").alias("subject"), F.lit("area_size").alias("problem")))
    if profiles is not None:
        short = profiles.filter(F.coalesce(F.size("hourly"), F.lit(-1)) != 24)
        found = found.unionByName(
            short.select(F.concat_ws("/", "area_type", "day_kind").alias("subject"), F.lit("profile_length").alias("problem"))
        )
    return found
