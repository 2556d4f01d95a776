"""Order statistics, ranks and running totals against plain Python."""

import duckdb
import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import stats
from millrace.functions.lookup import attach
from millrace.functions.numeric import rounded


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v double")


@pytest.mark.parametrize("p", [0.0, 0.25, 0.5, 0.99, 1.0])
def test_quantile_is_exact(spark, p):
    rng = np.random.default_rng(7)
    values = np.concatenate([rng.lognormal(3, 2, 30_000), np.full(15_000, 12.5), [-4.0, 0.0]])
    found = stats.quantiles(frame(spark, values.tolist()).repartition(7), {"v": p})
    assert found["v"] == pytest.approx(np.quantile(values, p), rel=1e-12)


def test_many_quantiles_of_several_columns_at_once(spark):
    rng = np.random.default_rng(9)
    a, b = rng.lognormal(1, 2, 20_000), rng.integers(0, 4, 20_000).astype(float)
    b[:15_000] = 2.0
    df = spark.createDataFrame(list(zip(a.tolist(), b.tolist(), [None] * len(a))), "a double, b double, c double")
    points = [0.0, 0.1, 0.25, 0.2501, 0.5, 0.75, 0.9, 0.99, 1.0]
    found = stats.quantile_points(df.repartition(5), {"a": points, "b": points, "c": points})
    assert found["a"] == pytest.approx(np.quantile(a, points).tolist(), rel=1e-12)
    assert found["b"] == pytest.approx(np.quantile(b, points).tolist(), rel=1e-12) and found["c"] == []


@given(st.lists(st.integers(-50, 50), min_size=1, max_size=12), st.sampled_from([0.5, 0.99]))
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_quantile_of_few_values(spark, values, p):
    found = stats.quantiles(frame(spark, [float(v) for v in values]), {"v": p})
    assert found["v"] == pytest.approx(np.quantile(values, p))


def test_quantile_skips_nulls_and_knows_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (4.0, None)], "a double, b double")
    assert stats.quantiles(df, {"a": 0.5, "b": 0.5}) == {"a": 2.5, "b": None}


def test_mode_prefers_smallest_on_ties(spark):
    df = spark.createDataFrame(
        [("b", "x"), ("a", "x"), ("b", None), ("a", None), (None, None)], "p string, q string")
    assert stats.modes(df, ["p", "q"]) == {"p": "a", "q": "x"}


@pytest.mark.parametrize("descending", [True, False])
def test_rank_among_matches_rank(spark, descending):
    values = [5, 9, 9, 1, 7, 7, 7, 3, 9, 2]
    population = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v int")
    few = population.orderBy(F.desc("v"), "id").limit(6)
    ranked = stats.rank_among(few, population, "v", "r", descending).collect()
    for row in ranked:
        ahead = [v for v in values if (v > row["v"] if descending else v < row["v"])]
        assert row["r"] == 1 + len(ahead)
    assert len(ranked) == 6


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("slice_rows", [16, 300, 1_000_000])
def test_running_sums(spark, descending, slice_rows):
    rng = np.random.default_rng(3)
    values = np.unique(np.concatenate([rng.normal(0, 1, 500), rng.normal(5, 1e-6, 500)]))
    rows = [(float(v), i % 5) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "v double, n long").repartition(5)
    found = {r["v"]: r["cum_n"] for r in stats.running_sums(df, "v", ["n"], descending, slice_rows).collect()}
    total = 0
    for v, n in sorted(rows, reverse=descending):
        total += n
        assert found[v] == total


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("slice_rows", [2, 1_000])
def test_running_sums_place_null_and_nan(spark, descending, slice_rows):
    rows = [(None, 1), (float("nan"), 10), (1.0, 100), (2.0, 1_000), (3.0, 10_000), (4.0, 100_000)]
    df = spark.createDataFrame(rows, "v double, n long")
    found = stats.running_sums(df, "v", ["n"], descending, slice_rows).collect()
    got = {str(r["v"]): r["cum_n"] for r in found}
    order = ["None", "1.0", "2.0", "3.0", "4.0", "nan"]
    size = {str(v): n for v, n in rows}
    total = 0
    for v in reversed(order) if descending else order:
        total += size[v]
        assert got[v] == total


def test_attach_gives_the_same_with_and_without_broadcast(spark):
    df = spark.range(20).select((F.col("id") % 5).alias("k"))
    lookup = spark.createDataFrame([(i, i * i) for i in range(4)], "k long, sq long")
    broadcast, plain = attach(df, lookup, "k"), attach(df, lookup, "k", max_rows=2)
    assert sorted(map(str, broadcast.collect())) == sorted(map(str, plain.collect()))
    assert broadcast.where("sq is null").count() == 4


def test_rounding_is_half_up_on_decimal_digits(spark):
    df = frame(spark, [0.125, 2.675, 1.005, -0.125])
    assert [r[0] for r in df.select(rounded(F.col("v"), 2)).collect()] == [0.13, 2.68, 1.01, -0.13]


def test_bins_follow_the_order_of_numbers_and_enclose_ranks(spark):
    rng = np.random.default_rng(5)
    powers = [s * 2.0 ** e * f for s in (1, -1) for e in (-1070, -3, 0, 1, 52, 1000)
              for f in (1.0, 1.0 + 2.0 ** -52, 2.0 - 2.0 ** -52)]
    values = sorted([*powers, 0.0, float("inf"), float("-inf"), *rng.normal(0, 100, 2_000).tolist()])
    df = frame(spark, values)
    bins = [r[0] for r in df.orderBy("v").select(stats.bin_of(F.col("v"))).collect()]
    assert bins == sorted(bins) and len(set(bins)) > 500
    sketch = stats.sketched(df, {"v": F.col("v")})["v"]
    assert sketch.n == len(values)
    for rank in range(0, len(values), 37):
        low, high = sketch.bracket(rank)
        assert low <= values[rank] <= high


def test_rounding_to_eight_decimals_is_that_of_sql(spark):
    n = 2_560
    shares = spark.range(1, n + 1).select(F.col("id"), (F.col("id").cast("double") / n).alias("v"))
    found = {r["id"]: r["v"] for r in shares.select("id", rounded(F.col("v"), 8).alias("v")).collect()}
    asked = duckdb.connect().execute(
        f"SELECT id, CAST(CAST(id::DOUBLE / {n} AS DECIMAL(28,8)) AS DOUBLE) FROM range(1, {n + 1}) r(id)")
    assert found == dict(asked.fetchall())


def test_ranks_of_many_columns_in_one_pass(spark):
    columns = [f"c{i}" for i in range(13)]
    df = spark.range(2_000).select(*[((F.col("id") * (i + 7)) % 1_009).cast("double").alias(c)
                                     for i, c in enumerate(columns)])
    found = stats.quantile_points(df, {c: [0.5, 0.99] for c in columns})
    for i, c in enumerate(columns):
        values = [(k * (i + 7)) % 1_009 for k in range(2_000)]
        assert found[c] == pytest.approx(np.quantile(values, [0.5, 0.99]).tolist())
