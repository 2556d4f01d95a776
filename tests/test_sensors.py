"""Sensor operators on small histories against plain Python."""

import datetime as dt
import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from millrace.operators import sensors
from millrace.plans.maintenance import score_failures, train_failure_model

SCHEMA = ("machine_id long, event_id long, reading_ts timestamp_ntz, temperature double, "
          "vibration double, pressure double, rpm double, current_amps double, is_failure int")
START = dt.datetime(2024, 1, 1)


def reading(machine, event, hours, value=0.0, failed=0):
    ts = START + dt.timedelta(hours=hours)
    return (machine, event, ts, value, value / 2, value + 100, value + 1500, value / 10, failed)


def history(n=300, machines=3, seed=5):
    """Irregular times with ties; most readings belong to machine 1."""
    rng = random.Random(seed)
    return [
        reading(1 if rng.random() < 0.7 else rng.randint(2, machines), i,
                rng.choice([rng.uniform(0, 400), rng.randint(0, 400)]),
                rng.uniform(0, 100), int(rng.random() < 0.02))
        for i in range(n)
    ]


def by_machine(rows):
    out = {}
    for row in sorted(rows, key=lambda r: (r[0], r[2], r[1])):
        out.setdefault(row[0], []).append(row)
    return out


@pytest.mark.parametrize("horizon", [24, 7])
def test_failure_label(spark, horizon):
    rows = history()
    found = {
        r["event_id"]: r["failure_in_24h"]
        for r in sensors.label_failures(spark.createDataFrame(rows, SCHEMA), horizon).collect()
    }
    assert len(found) == len(rows)
    for row in rows:
        expected = any(
            f[0] == row[0] and f[8] and row[2] <= f[2] <= row[2] + dt.timedelta(hours=horizon)
            for f in rows
        )
        assert found[row[1]] == int(expected)


def test_failure_label_includes_both_ends(spark):
    rows = [reading(1, 0, 0), reading(1, 1, 0.5), reading(1, 2, 24, failed=1), reading(1, 3, 24.1),
            reading(2, 4, 23)]
    labelled = sensors.label_failures(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["event_id"]: r["failure_in_24h"] for r in labelled} == {0: 1, 1: 1, 2: 1, 3: 0, 4: 0}


@pytest.mark.parametrize("slice_rows", [1, 7, 100_000])
def test_sequences(spark, slice_rows):
    rows, window = history(), 5
    made = sensors.sequences(spark.createDataFrame(rows, SCHEMA), window, slice_rows=slice_rows)
    found = {r["event_id"]: [step[0] for step in r["sequence"]] for r in made.collect()}
    expected = {}
    for readings in by_machine(rows).values():
        for i in range(window, len(readings)):
            expected[readings[i][1]] = [r[3] for r in readings[i - window:i]]
    assert found == expected


def test_readings_without_a_machine_are_a_history_of_their_own(spark):
    rows = [reading(None, i, i, float(i)) for i in range(8)] + [reading(1, 10 + i, i) for i in range(8)]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = {r["event_id"]: r["sequence"] for r in sensors.sequences(frame, 5).collect()}
    assert found.keys() == {5, 6, 7, 15, 16, 17}
    assert [step[0] for step in found[6]] == [1.0, 2.0, 3.0, 4.0, 5.0]
    assert sensors.window_features(frame, 5).count() == 6


def test_failure_scores_of_short_and_broken_histories(spark):
    rng = random.Random(4)
    rows = [reading(m, 100 * m + i, i, rng.uniform(0, 100), int(i % 25 == 9))
            for m in range(1, 13) for i in range(60)]
    rows += [reading(20, 9_000 + i, i, float(i)) for i in range(5)]
    rows += [(21, 9_100 + i, START + dt.timedelta(hours=i), None if i > 5 else 5.0, 1.0, 100.0, 900.0, 9.0,
              int(i == 35)) for i in range(40)]
    frame = spark.createDataFrame(rows, SCHEMA)
    fitted = train_failure_model(frame, rounds=2, test_share=0.0)
    scored = score_failures(fitted, frame)
    assert scored.columns == sensors.health_table(sensors.health_scores(frame)).columns
    assert len(scored.columns) == 10
    rows = scored.collect()
    seen = {int(r["machine_id"][2:]): r for r in rows}
    assert seen.keys() == {*range(1, 13), 20, 21}
    assert rows == sorted(rows, key=lambda r: (-r["failure_probability"], r["machine_id"]))
    assert seen[20]["last_temperature"] == 4.0 and seen[21]["last_temperature"] is None
    assert all(r["failure_probability"] is not None and r["severity"] for r in seen.values())
    own = sensors.health_scores(frame).where("machine_id = 20").first()["probability"]
    assert seen[20]["failure_probability"] == pytest.approx(own, abs=1e-4)


def test_readings_without_a_time_come_last_and_are_kept(spark):
    rows = [reading(1, i, i) for i in range(4)]
    rows.append((1, 9, None, 1.0, 1.0, 1.0, 1.0, 1.0, 0))
    df = spark.createDataFrame(rows, SCHEMA)
    assert sensors.label_failures(df).count() == 5
    failed = spark.createDataFrame([*rows[:4], (*rows[4][:8], 1)], SCHEMA)
    assert sensors.label_failures(failed).count() == 5
    lists = {r["event_id"]: [x[0] for x in r["sequence"]] for r in sensors.sequences(
        spark.createDataFrame([reading(1, i, i, float(i)) for i in range(4)] + [
            (1, i, None, float(i), 1.0, 1.0, 1.0, 1.0, 0) for i in range(9, 14)], SCHEMA), 2, slice_rows=2).collect()}
    assert lists == {2: [0, 1], 3: [1, 2], 9: [2, 3], 10: [3, 9], 11: [9, 10], 12: [10, 11], 13: [11, 12]}


def exchanges(df):
    """Keys of the exchanges of a plan, those of reused ones left out."""
    text = re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())
    lines = [x for x in text.splitlines() if "ReusedExchange" not in x]
    found = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", "\n".join(lines))
    return [re.sub(r", \d+$", "", f) for f in found]


def test_a_long_history_is_shuffled_once(spark, tmp_path):
    spark.createDataFrame(history(), SCHEMA).write.parquet(str(tmp_path / "h"))
    df = spark.read.parquet(str(tmp_path / "h"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for made in (sensors.window_features(df, 5), sensors.sequences(df, 5)):
            assert sorted(exchanges(made)) == ["machine_id", "machine_id, bucket"]
        labelled = sensors.label_failures(df)
        text = labelled._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in text and "BroadcastHashJoin" in text
        # Only failures are exchanged: below every exchange stands their filter.
        for part in text.split("Exchange hashpartitioning")[1:]:
            assert "Filter (" in part and "is_failure" in part
        assert len(exchanges(sensors.health_scores(df))) == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


@pytest.mark.parametrize("n", [3, 40, 5_000])
def test_newest_readings_at_any_limit(spark, n):
    df = spark.createDataFrame(history(), SCHEMA)
    found = sensors.latest_window(df, n)
    assert sorted(exchanges(found)) == ["machine_id", "machine_id, part"]
    got = {(r["machine_id"], r["age"]): r["event_id"] for r in found.collect()}
    assert got == {(m, i + 1): r[1] for m, rows in by_machine(history()).items()
                   for i, r in enumerate(rows[::-1][:n])}


def test_buckets_shrink_where_a_machine_is_busy(spark):
    rows = [reading(1, i, i / 60) for i in range(1_000)] + [reading(2, 5_000 + i, 30 * i) for i in range(9)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert [sensors.bucket_minutes(df, n) for n in (2_000, 500, 100, 10, 1)] == [1440, 480, 120, 10, 1]
    assert sensors.bucket_minutes(df.limit(0), 10) == 1440


def test_machines_without_any_time_have_a_health(spark):
    rows = [(5, i, None, float(i), 1.0, 1.0, 1.0, 1.0, 0) for i in (3, 8, 4)]
    found = sensors.health_scores(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r["machine_id"], r["temperature"]) for r in found] == [(5, 8.0)]


def test_newest_of_equal_times_is_the_larger_id(spark):
    rows = [reading(1, 1, 0, 10.0), reading(1, 3, 5, 50.0), reading(1, 2, 5, 20.0)]
    found = sensors.health_scores(spark.createDataFrame(rows, SCHEMA)).first()
    assert found["temperature"] == 50.0


def test_window_features(spark):
    rows, window = history(), 4
    made = sensors.window_features(spark.createDataFrame(rows, SCHEMA), window, slice_rows=9).collect()
    found = {r["event_id"]: r for r in made}
    for readings in by_machine(rows).values():
        for i in range(window, len(readings)):
            past, row = [r[3] for r in readings[i - window:i]], found[readings[i][1]]
            assert row["temperature_mean"] == pytest.approx(statistics.mean(past))
            assert row["temperature_sd"] == pytest.approx(statistics.stdev(past))
            assert row["temperature_change"] == pytest.approx(past[-1] - past[0])
            assert (row["temperature_min"], row["temperature_max"]) == (min(past), max(past))


def test_latest_features_equal_the_next_window(spark):
    rows, window = history(), 4
    df = spark.createDataFrame(rows, SCHEMA)
    latest = {r["machine_id"]: r for r in sensors.latest_features(df, window).collect()}
    # a further reading has exactly the newest window before it
    ends = [reading(m, 10_000 + m, 1_000) for m in by_machine(rows)]
    after = sensors.window_features(df.union(spark.createDataFrame(ends, SCHEMA)), window)
    for row in after.where("event_id >= 10000").collect():
        for name in sensors.WINDOW_FEATURES:
            assert latest[row["machine_id"]][name] == pytest.approx(row[name]), name


def test_latest_window_counts(spark):
    rows = history()
    counts = sensors.latest_window(spark.createDataFrame(rows, SCHEMA), 30).groupBy("machine_id").count()
    sizes = {m: min(30, len(r)) for m, r in by_machine(rows).items()}
    assert {r["machine_id"]: r["count"] for r in counts.collect()} == sizes


def test_health_scores(spark):
    rows = [r for r in history() if r[0] == 1] + [reading(9, 9_999, 5, 50.0)]
    rows += [reading(8, 20_000 + i, i, 10.0) for i in range(5)]
    found = {
        r["machine_id"]: r["probability"]
        for r in sensors.health_scores(spark.createDataFrame(rows, SCHEMA)).collect()
    }
    own = by_machine(rows)[1]
    total = 0.0
    for c in range(3, 8):
        values = [r[c] for r in own]
        total += abs(values[-1] - statistics.mean(values)) / statistics.stdev(values)
    assert found[1] == pytest.approx(min(total / 5 / 4, 1.0))
    assert found[9] == 0.0  # a single reading
    assert found[8] == 0.0  # a machine that never varied


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([reading(1, i, i, 7.0) for i in range(3)], SCHEMA)
    scaled = sensors.minmax(df)
    assert {tuple(r) for r in scaled.select(*sensors.CHANNELS).collect()} == {(0.0,) * 5}


def test_clip_keeps_missing_values(spark):
    df = spark.createDataFrame([(None, 500.0), (10.0, 20.0)], "a double, b double")
    clipped = sensors.clip_ranges(df, {"a": (30.0, 120.0), "b": (30.0, 120.0)}).collect()
    assert [tuple(r) for r in clipped] == [(None, 120.0), (30.0, 30.0)]


def test_health_table_golden(spark):
    # Published scores of ten machines.
    golden = [
        (7, 0.1837, 81.6, 58), (4, 0.1533, 84.7, 60), (5, 0.1293, 87.1, 62), (1, 0.1263, 87.4, 62),
        (8, 0.1210, 87.9, 63), (6, 0.0964, 90.4, 65), (10, 0.0904, 91.0, 65), (3, 0.0831, 91.7, 66),
        (9, 0.0805, 92.0, 66), (2, 0.0784, 92.2, 66),
    ]
    scores = spark.createDataFrame([(m, p, *[1.0] * 5) for m, p, _, _ in golden], (
        "machine_id long, probability double, temperature double, vibration double, "
        "pressure double, rpm double, current_amps double"))
    table = sensors.health_table(scores).orderBy(F.desc("failure_probability")).collect()
    expected = [(f"M-{m:03d}", p, h, r, "LOW") for m, p, h, r in golden]
    names = ["machine_id", "failure_probability", "health_score", "rul_hours", "severity"]
    assert [tuple(row[n] for n in names) for row in table] == expected


def test_severity_and_hours_at_the_limits(spark):
    df = spark.createDataFrame([(0.2499,), (0.25,), (0.5,), (0.75,), (1.0,)], "p double")
    rows = df.select(sensors.severity(F.col("p")), sensors.rul_hours(F.col("p"))).collect()
    assert [tuple(r) for r in rows] == [
        ("LOW", 54), ("MEDIUM", 54), ("HIGH", 36), ("CRITICAL", 18), ("CRITICAL", 1)]
