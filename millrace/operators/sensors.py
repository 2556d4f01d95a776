"""Sensor history: clamping, failure labels, windows, health scores.

Readings are identified by machine, time and a unique id that orders equal times. No operator
gathers a machine's whole history in one task: windows run over slices of a history, and each
slice is given the few neighbouring rows it needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.lookup import scalar
from millrace.functions.numeric import clamp, rounded
from millrace.functions.stats import top_per_key

MACHINE, TIME, READING = "machine_id", "reading_ts", "event_id"

# Physical range of each channel, look-back length, hours to failure at probability 0.
RANGES = {
    "temperature": (30.0, 120.0), "vibration": (0.1, 5.0), "pressure": (50.0, 200.0),
    "rpm": (500.0, 2000.0), "current_amps": (2.0, 25.0),
}
WINDOW = 30
HORIZON_HOURS = 24
LIFE_HOURS = 72

CHANNELS = list(RANGES)
# Readings of a machine that a bucket of time should hold at most, and the buckets' lengths in minutes.
SLICE_ROWS = 100_000
BUCKETS = (1440, 480, 120, 60, 30, 10, 5, 1)
# Buckets of readings without a time come after all others.
UNTIMED = 1 << 60


def clip_ranges(df: DataFrame, ranges: dict[str, tuple[float, float]] = RANGES) -> DataFrame:
    return df.withColumns({c: clamp(F.col(c), low, high) for c, (low, high) in ranges.items()})


def label_failures(df: DataFrame, horizon_hours: int = HORIZON_HOURS, event: str = "is_failure",
                   out: str = "failure_in_24h") -> DataFrame:
    """1 where the same machine fails at the reading's time or within the horizon after it.

    Time is cut into slices one horizon long. A failure in the reading's own slice counts if it is
    not earlier, so the slice's last one decides; one in the next slice counts if it is near enough,
    so the first one decides. These two times per machine and slice, found by a plain aggregate, are
    joined to the readings; the history itself is never sorted or gathered. Readings and failures
    without a time have no slice: such a reading is 0, such a failure marks nothing.
    """
    def slice_of(time: Column) -> Column:
        hour = F.datediff(F.to_date(time), F.lit("1970-01-01")) * 24 + F.hour(time)
        return F.floor(hour / horizon_hours)

    none = F.lit(None).cast(df.schema[TIME].dataType)
    at = slice_of(F.col(TIME))
    places = F.array(
        F.struct(at.alias("slice"), none.alias("next"), F.col(TIME).alias("last")),
        F.struct((at - 1).alias("slice"), F.col(TIME).alias("next"), none.alias("last")))
    ends = df.where((F.col(event) == 1) & F.col(TIME).isNotNull()).select(
        F.col(MACHINE).alias("of_machine"), F.inline(places)).groupBy("of_machine", "slice").agg(
        F.min("next").alias("next_first"), F.max("last").alias("own_last"))
    same = F.col(MACHINE).eqNullSafe(F.col("of_machine")) & (slice_of(F.col(TIME)) == F.col("slice"))
    limit = F.col(TIME) + F.make_dt_interval(hours=F.lit(horizon_hours))
    fails = F.coalesce(F.col("own_last") >= F.col(TIME), F.lit(False)) | F.coalesce(
        F.col("next_first") <= limit, F.lit(False))
    return df.join(ends, same, "left").select(*df.columns, fails.cast("int").alias(out))


def minmax(df: DataFrame, cols: list[str] = CHANNELS, fit_on: DataFrame | None = None) -> DataFrame:
    """Scale columns to 0..1 by their global extremes; a constant column becomes 0."""
    source = df if fit_on is None else fit_on
    ends = source.agg(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in cols])

    def scaled(c: str) -> Column:
        low, high = F.col("ends")[c]["lo"], F.col("ends")[c]["hi"]
        share = F.coalesce((F.col(c) - low) / F.nullif(high - low, F.lit(0.0)), F.lit(0.0))
        return F.when(F.col(c).isNotNull(), share)

    return df.withColumn("ends", scalar(ends)).withColumns({c: scaled(c) for c in cols}).drop("ends")


def bucket_minutes(df: DataFrame, most_rows: int) -> int:
    """Length of the time buckets that histories are cut into: a day, or less where some machine has
    more than ``most_rows`` readings in one. Counted per machine and day, so no history moves."""
    daily = df.where(F.col(TIME).isNotNull()).groupBy(MACHINE, F.to_date(TIME)).agg(F.count("*").alias("n"))
    busiest = daily.agg(F.max("n")).first()[0] or 0
    parts = -(-busiest // most_rows) or 1
    return next((m for m in BUCKETS if 1440 // m >= parts), BUCKETS[-1])


def with_lookback(df: DataFrame, window: int, columns: dict[str, Column],
                  slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Add aggregates over the ``window`` preceding readings, for readings that have that many.

    ``columns`` are aggregate expressions. Histories are cut into buckets of time. Within a bucket,
    all but its first ``window`` readings find the readings before them; these first ones and the
    last ``window`` of each bucket, few rows of a history, meet once more per machine. So the
    history is shuffled once, and no task holds more of it than a bucket. Readings without a time
    come last, in the order of their ids, and are cut into buckets by these.
    """
    minute = F.datediff(F.to_date(TIME), F.lit("1970-01-01")) * 1440 + F.hour(TIME) * 60 + F.minute(TIME)
    untimed = F.lit(UNTIMED) + F.coalesce(F.floor(F.col(READING) / max(slice_rows, window)), F.lit(0))
    bucket = F.coalesce(F.floor(minute / bucket_minutes(df, slice_rows)), untimed)
    in_bucket = Window.partitionBy(MACHINE, "bucket").orderBy(TIME, READING)
    near = in_bucket.rowsBetween(-window, -1)
    placed = df.withColumn("bucket", bucket).select(
        "*", F.row_number().over(in_bucket).alias("place"),
        F.lead(F.lit(1), window).over(in_bucket).isNull().alias("is_last"),
        *[agg.over(near).alias(out) for out, agg in columns.items()])
    inner = placed.where(F.col("place") > window).select(*df.columns, *columns)
    edges = placed.where((F.col("place") <= window) | F.col("is_last")).select(
        *df.columns, "bucket", "place")
    before = Window.partitionBy(MACHINE).orderBy("bucket", TIME, READING).rowsBetween(-window, -1)
    outer = edges.select(
        *df.columns, "place", F.count(F.lit(1)).over(before).alias("known"),
        *[agg.over(before).alias(out) for out, agg in columns.items()])
    outer = outer.where((F.col("place") <= window) & (F.col("known") == window))
    return inner.unionByName(outer.select(*df.columns, *columns))


def sequences(df: DataFrame, window: int = WINDOW, cols: list[str] = CHANNELS,
              slice_rows: int = SLICE_ROWS) -> DataFrame:
    """For each reading with enough history: the preceding readings as a list of channel lists.

    The reading itself is not part of its list. Copies every reading ``window`` times.
    """
    # The step is a column of its own, so that both parts of the look-back read one exchange.
    stepped = df.withColumn("step", F.array(*cols))
    lists = {"sequence": F.collect_list("step")}
    return with_lookback(stepped, window, lists, slice_rows).drop("step")


def window_features(df: DataFrame, window: int = WINDOW, cols: list[str] = CHANNELS,
                    slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Mean, spread, extremes, last value and change of each channel over the preceding readings."""
    aggregates: dict[str, Column] = {}
    for c in cols:
        aggregates |= {
            f"{c}_mean": F.avg(c), f"{c}_sd": F.stddev_samp(c), f"{c}_min": F.min(c),
            f"{c}_max": F.max(c), f"{c}_last": F.last(c), f"{c}_first": F.first(c),
        }
    wide = with_lookback(df, window, aggregates, slice_rows)
    change = {f"{c}_change": F.col(f"{c}_last") - F.col(f"{c}_first") for c in cols}
    return wide.withColumns(change).drop(*[f"{c}_first" for c in cols])


WINDOW_FEATURES = [
    f"{c}_{kind}" for c in CHANNELS for kind in ("mean", "sd", "min", "max", "last", "change")
]


def latest_window(df: DataFrame, n: int = WINDOW) -> DataFrame:
    """The newest n readings of every machine."""
    newest = [F.desc(TIME), F.desc(READING)]
    ranked = top_per_key(df, [MACHINE], newest, n, READING, "age")
    return ranked.withColumn("age", F.col("age").cast("bigint"))


def latest_features(df: DataFrame, window: int = WINDOW, cols: list[str] = CHANNELS) -> DataFrame:
    """``window_features`` of the newest window of every machine that has a full one."""
    recent = latest_window(df, window)
    aggregates: list[Column] = []
    for c in cols:
        last, first = F.max_by(c, -F.col("age")), F.max_by(c, "age")
        aggregates += [
            F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_sd"),
            F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"), last.alias(f"{c}_last"),
            (last - first).alias(f"{c}_change"),
        ]
    rows = recent.groupBy(MACHINE).agg(F.count("*").alias("n"), *aggregates)
    return rows.where(F.col("n") == window).drop("n")


def rul_hours(probability: Column) -> Column:
    """Estimated hours left, from the unrounded probability; never below 1."""
    hours = F.floor((1 - probability) * LIFE_HOURS).cast("int")
    return F.when(probability.isNotNull(), F.greatest(F.lit(1), hours))


def severity(probability: Column) -> Column:
    return (
        F.when(probability < 0.25, "LOW").when(probability < 0.50, "MEDIUM")
        .when(probability < 0.75, "HIGH").when(probability.isNotNull(), "CRITICAL")
    )


def health_scores(df: DataFrame, cols: list[str] = CHANNELS) -> DataFrame:
    """Failure probability per machine: how far its newest reading lies from its own mean.

    The mean absolute deviation in sample standard deviations, divided by 4 and limited to 0..1.
    A channel that never varied counts as having deviation 1.

    Moments and the newest reading come from one mergeable aggregate over one scan. A reading without a
    time is older than any other, so a machine that has only such readings is scored by its last id.
    """
    moments = [F.struct(F.avg(c).alias("mean"), F.stddev_samp(c).alias("sd")).alias(f"of_{c}") for c in cols]
    newest = F.max_by(F.struct(*cols), F.struct(TIME, READING)).alias("newest")
    machines = df.where(F.col(MACHINE).isNotNull()).groupBy(MACHINE).agg(newest, *moments)
    machines = machines.select(MACHINE, "newest.*", *[f"of_{c}" for c in cols])

    def distance(c: str) -> Column:
        sd = F.coalesce(F.nullif(F.col(f"of_{c}")["sd"], F.lit(0.0)), F.lit(1.0))
        return F.abs((F.col(c) - F.col(f"of_{c}")["mean"]) / sd)

    total = sum((distance(c) for c in cols[1:]), distance(cols[0]))
    probability = clamp(total / len(cols) / 4, 0.0, 1.0)
    return machines.select(MACHINE, probability.alias("probability"), *cols)


def health_table(scores: DataFrame) -> DataFrame:
    """One readable row per machine from probabilities and newest channel values."""
    p = F.col("probability")
    return scores.select(
        F.format_string("M-%03d", F.col(MACHINE)).alias("machine_id"),
        rounded(p, 4).alias("failure_probability"),
        rounded((1 - p) * 100, 1).alias("health_score"),
        rul_hours(p).alias("rul_hours"),
        severity(p).alias("severity"),
        rounded(F.col("temperature"), 1).alias("last_temperature"),
        rounded(F.col("vibration"), 4).alias("last_vibration"),
        rounded(F.col("pressure"), 1).alias("last_pressure"),
        rounded(F.col("rpm"), 1).alias("last_rpm"),
        rounded(F.col("current_amps"), 3).alias("last_current"),
    )


def machine_health(df: DataFrame) -> DataFrame:
    table = health_table(health_scores(df))
    return table.orderBy(F.desc("failure_probability"), "machine_id")
