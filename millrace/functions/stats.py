"""Exact order statistics, modes, ranks and running totals that never sort everything in one task."""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate
from math import ceil, floor

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from millrace.session import staged

SKETCH_ACCURACY = 10_000
# Bins per power of two, and the bins of zero, of infinities and of what is no number.
OCTAVE, LOWEST_OCTAVE, INFINITE, UNDEFINED = 256, -1100, 1 << 40, 1 << 41
BAND_CELLS = 4_096
WINDOW_ROWS = 1_000_000
MAX_SLICES = 100_000
# Parts that the rows of a key fall into while its first rows are sought.
TOP_PARTS = 32


@dataclass(frozen=True)
class Sketch:
    """Narrow bins of a column in ascending order: rows up to a bin's end, least and largest value."""

    n: int
    bins: list[tuple[int, float, float]]

    def bracket(self, rank: int) -> tuple[float, float]:
        """Values that enclose a rank."""
        found = self.bins[min(bisect_right(self.bins, rank, key=lambda x: x[0]), len(self.bins) - 1)]
        return found[1], found[2]


def bin_of(v: Column) -> Column:
    """Number of a double's bin; larger values never have a smaller one.

    A power of two is cut into ``OCTAVE`` bins by logarithm, which never falls as its argument grows.
    """
    size = F.abs(v)
    cell = F.floor((F.log2(size) - LOWEST_OCTAVE) * OCTAVE)
    finite = F.when(size == 0, F.lit(0)).when(size == float("inf"), F.lit(INFINITE)).otherwise(cell)
    return F.when(F.isnan(v), F.lit(UNDEFINED)).when(v < 0, -finite).otherwise(finite).cast("bigint")


def sketched(df: DataFrame, columns: dict[str, Column]) -> dict[str, Sketch]:
    """Sketches of several expressions in one pass; what is shuffled and collected are counts per bin."""
    if not columns:
        return {}
    entries = [
        F.struct(F.lit(i).alias("name"), v.cast("double").alias("v")) for i, v in enumerate(columns.values())]
    rows = (
        df.select(F.inline(F.array(*entries))).where("v is not null")
        .groupBy("name", bin_of(F.col("v")).alias("bin"))
        .agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect())
    held: dict[int, list[Row]] = {i: [] for i in range(len(columns))}
    for row in rows:
        held[row["name"]].append(row)
    out = {}
    for i, c in enumerate(columns):
        bins = sorted(held[i], key=lambda r: r["bin"])
        upto = list(accumulate(r["n"] for r in bins))
        out[c] = Sketch(upto[-1] if upto else 0, [(u, r["low"], r["high"]) for u, r in zip(upto, bins)])
    return out


def _brackets(sketch: Sketch, ranks: list[int]) -> list[tuple[float, float]]:
    """Enclosing values of neighbouring ranks, in order; those that touch are one."""
    out: list[tuple[float, float]] = []
    for rank in sorted(set(ranks)):
        low, high = sketch.bracket(rank)
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def at_ranks(df: DataFrame, wanted: dict[str, tuple[Column, Sketch, list[int]]]
             ) -> dict[str, dict[int, float]]:
    """Exact values at zero-based ranks of each named expression, in one pass.

    The bins of a sketch enclose the ranks by few numbers. Each row falls into one side per expression: inside a
    bracket, or between two. What lies between is only counted, so nothing but distinct values inside
    brackets is shuffled; these are counted per cell of their range, and the ranks are looked up in the
    cells that hold them. All sizes take the same path.
    """
    if not wanted:
        return {}
    names = list(wanted)
    brackets = [_brackets(wanted[c][1], wanted[c][2]) for c in names]
    entries = [
        F.struct(F.lit(i).alias("name"), wanted[c][0].cast("double").alias("v")) for i, c in enumerate(names)]
    v = F.col("v")

    def bound(j: int, end: int) -> Column:
        """An end of the row's j-th bracket, null beyond the last; one expression for all names."""
        ends = [F.lit(b[j][end] if j < len(b) else None).cast("double") for b in brackets]
        return F.get(F.array(*ends), F.col("name"))

    # Sides count gaps and brackets from below: 0 before the first, 1 in it, 2 after it.
    side, share = F.lit(0), F.lit(0.0)
    for j in range(max(map(len, brackets))):
        low, high = bound(j, 0), bound(j, 1)
        side = side + F.when(v >= low, 1).otherwise(0) + F.when(v > high, 1).otherwise(0)
        wide = (low > float("-inf")) & (low < high) & (high < float("inf"))
        share = F.when(wide & v.between(low, high), (v - low) / (high - low)).otherwise(share)
    sided = df.select(F.inline(F.array(*entries))).where("v is not null").withColumn("side", side)
    tally = staged(
        sided.select(
            "name", "side", F.floor(share * BAND_CELLS).alias("cell"),
            F.when(F.col("side") % 2 == 1, v).alias("key"), "v")
        .groupBy("name", "side", "cell", "key")
        .agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")), "tally")
    in_order = Window.partitionBy("name").orderBy("side", "cell")
    cells = tally.groupBy("name", "side", "cell").agg(F.sum("n").alias("held")).select(
        "name", "side", "cell", (F.sum("held").over(in_order) - F.col("held")).alias("before"), "held")
    ranks = F.lit(None)
    for i, c in enumerate(names):
        ranks = F.when(F.col("name") == i, F.array(*[F.lit(r) for r in sorted(set(wanted[c][2]))])).otherwise(ranks)
    hit = cells.withColumn("rank", F.explode(ranks)).where(
        (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("held")))
    within = Window.partitionBy("name", "side", "cell", "rank").orderBy("key")
    steps = tally.join(hit, ["name", "side", "cell"]).withColumn(
        "last", F.col("before") + F.sum("n").over(within))
    reached = steps.where(
        (F.col("rank") >= F.col("last") - F.col("n")) & (F.col("rank") < F.col("last")))
    # Known are values inside a bracket and the outermost ones between two.
    value = (
        F.when(F.col("side") % 2 == 1, F.col("low"))
        .when(F.col("rank") == F.col("last") - 1, F.col("high"))
        .when(F.col("rank") == F.col("last") - F.col("n"), F.col("low"))
        .otherwise(F.raise_error(F.lit("quantile lies outside its bracket")).cast("double")))
    out: dict[str, dict[int, float]] = {c: {} for c in names}
    for row in reached.select("name", "rank", value.alias("value")).collect():
        out[names[row["name"]]][row["rank"]] = row["value"]
    return out


def position(n: int, p: float) -> tuple[list[int], float]:
    """The two ranks between which the p-quantile of n values lies, and how far it is from the first."""
    exact = (n - 1) * p
    return [floor(exact), ceil(exact)], exact - floor(exact)


def quantile_points(df: DataFrame, wanted: dict[str, list[float]]) -> dict[str, list[float]]:
    """Exact, linearly interpolated quantiles of each named column; none for an empty column."""
    sketches = sketched(df, {c: F.col(c) for c in wanted})
    found = at_ranks(df, {
        c: (F.col(c), sketches[c], [r for p in ps for r in position(sketches[c].n, p)[0]])
        for c, ps in wanted.items() if sketches[c].n})
    out: dict[str, list[float]] = {}
    for c, ps in wanted.items():
        out[c] = []
        for p in ps if sketches[c].n else ():
            ranks, share = position(sketches[c].n, p)
            low, high = (found[c][r] for r in ranks)
            out[c].append(low + (high - low) * share)
    return out


def quantiles(df: DataFrame, wanted: dict[str, float]) -> dict[str, float | None]:
    """One exact quantile of each named column; None for an empty column."""
    found = quantile_points(df, {c: [p] for c, p in wanted.items()})
    return {c: values[0] if values else None for c, values in found.items()}


def modes(df: DataFrame, cols: list[str]) -> dict[str, str | None]:
    """Most frequent value of each column, the smallest one on ties; None for an empty column."""
    entries = [F.struct(F.lit(c).alias("name"), F.col(c).alias("v")) for c in cols]
    counts = (
        df.select(F.inline(F.array(*entries))).where("v is not null")
        .groupBy("name", "v").agg(F.count("*").alias("n"))
    )
    best = counts.groupBy("name").agg(F.min(F.struct(-F.col("n"), "v"))["v"].alias("v"))
    return dict.fromkeys(cols) | {row["name"]: row["v"] for row in best.collect()}


def rank_among(few: DataFrame, population: DataFrame, value: str, out: str,
               descending: bool = True) -> DataFrame:
    """SQL ``RANK`` of the rows of a small top-k frame within an arbitrarily large population.

    The k values cut the population into at most k + 1 bins; counting the bins replaces sorting
    the population in one task. Both frames are read more than once, so they should be staged.
    """
    marks = F.array(*[F.lit(row[0]) for row in few.select(value).distinct().collect()])

    def passed(mark):
        return mark < F.col(value) if descending else mark > F.col(value)

    bin_of = F.size(F.filter(marks, passed))
    bins = population.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("n"))
    beyond = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)
    ahead = bins.select("bin", (F.coalesce(F.sum("n").over(beyond), F.lit(0)) + 1).alias(out))
    return few.withColumn("bin", bin_of).join(F.broadcast(ahead), "bin").drop("bin")


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int, spread: str,
                out: str) -> DataFrame:
    """The first ``n`` rows of every key, numbered from 1 as ``out``.

    Each key's rows are parted by a hash of ``spread``, a column that tells rows apart, and every
    part keeps its own first n; those of all parts meet again. No task holds more of a key than one
    part, then ``TOP_PARTS`` times n rows, whatever n is.
    """
    part = F.pmod(F.xxhash64(spread), F.lit(TOP_PARTS))
    of_part = Window.partitionBy(*keys, "part").orderBy(*order)
    leading = df.withColumn("part", part).withColumn(out, F.row_number().over(of_part))
    of_key = Window.partitionBy(*keys).orderBy(*order)
    return (
        leading.where(F.col(out) <= n).drop("part", out)
        .withColumn(out, F.row_number().over(of_key)).where(F.col(out) <= n))


def places(df: DataFrame, key: str, order: str, out: str) -> DataFrame:
    """Zero-based place of every row among the rows of its key, by distinct values of ``order``.

    Rows are cut into ranges of (key, order) and sorted within them, so no task holds more than a
    range, however large one key is. A row's place is its place in its range plus the rows that the
    key has in ranges before: one small number per key and range.
    """
    at, piece = "at", "piece"
    ranges = staged(
        df.repartitionByRange(F.asc(key), F.asc(order)).sortWithinPartitions(key, order)
        .withColumns({
            piece: F.spark_partition_id(),
            at: F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}), "ranges")
    earlier = Window.partitionBy(key).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.groupBy(key, piece).agg(F.count("*").alias("n"), F.min(at).alias("first")).select(
        key, piece, (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"))
    return ranges.join(starts, [key, piece]).select(
        *df.columns, (F.col("shift") + F.col(at)).alias(out))


def running_sums(levels: DataFrame, order: str, sums: list[str], descending: bool = False,
                 slice_rows: int = WINDOW_ROWS) -> DataFrame:
    """Inclusive running totals over a column of distinct values, as ``cum_<name>`` columns.

    A null comes before all values in ascending order, NaN after them, as in any sort of Spark's.
    Quantile cut points, one number per ``slice_rows`` rows, spread the values evenly over
    slices. Totals of whole slices are summed first, then each slice is summed on its own. The
    input is read several times, so it should be staged.
    """
    direction = F.desc if descending else F.asc
    slices = max(1, min(ceil(levels.count() / slice_rows), MAX_SLICES))
    key = F.col(order).cast("double")
    cuts = []
    if slices > 1:
        fractions = [i / slices for i in range(1, slices)]
        accuracy = max(SKETCH_ACCURACY, 10 * slices)
        numbers = F.when(~F.isnan(key), key)
        cuts = levels.agg(F.percentile_approx(numbers, fractions, accuracy)).first()[0] or []
    # Zero is a cut at every size, so the same steps run with one slice or with many.
    inner = {0.0, *cuts} - {float("-inf"), float("inf")}
    bounds = [float("-inf"), *sorted(inner), float("inf")]
    slicer = Bucketizer(
        splits=bounds, inputCol="slice_key", outputCol="slice", handleInvalid="keep")
    sliced = slicer.transform(levels.withColumn("slice_key", key)).withColumn(
        "slice", F.when(key.isNull(), -1.0).when(F.isnan(key), float(len(bounds)))
        .otherwise(F.col("slice"))).drop("slice_key")

    totals = sliced.groupBy("slice").agg(*[F.sum(c).alias(c) for c in sums])
    earlier = Window.orderBy(direction("slice")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "slice", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"before_{c}") for c in sums]
    )
    within = (
        Window.partitionBy("slice").orderBy(direction(order))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        sliced.join(F.broadcast(offsets), "slice")
        .select(
            *levels.columns,
            *[(F.col(f"before_{c}") + F.sum(c).over(within)).alias(f"cum_{c}") for c in sums],
        )
    )
