"""Approximate nearest neighbours by inner product, on shifted Hilbert curves.

Vectors are extended by one component to a common length, so that the nearest by distance to a
unit query is the largest inner product. ``CURVES`` random projections to ``AXES`` directions, each
shifted at random and cut to a grid, give every vector a place on as many Hilbert curves. Spark
range-partitions each curve into blocks; a query meets the blocks within ``SHARE`` of the curve on
either side (the ends of a curve join) and all blocks that hold its own place, block by block, and
the few best of each meeting are merged and ranked by the exact product.

Of equal vectors only the k + 1 smallest ids can be among a query's k best beside the query itself, so
the others are left out before placing, and a vector that many queries share is searched once. Rows of
one place on a curve are cut into blocks by a hash, so no group of vectors makes a block large.

Without structure in the vectors, near ones are spread over much of any curve, so the windows are a
share of the table and the work grows with queries times rows, as for exact search; recall against
exact search is measured in the tests. The grid's centre and spread come from a sample of at most
``FIT_ROWS`` vectors; every row is placed on every curve.

Defined results: vectors that are null, empty, zero, or hold a null or a non-finite component take
no part, nor do rows without an id or of another length than most; rows of an equal id count as one
query and one candidate, with their best product; fewer candidates than wanted are all returned
where one block holds the table; ties go to the smaller id; an empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import staged

CURVES = 12
AXES = 8
BITS = 6
SHARE = 0.08
FIT_ROWS = 10_000
# A block has about so many rows, the table at least so many blocks if its rows allow.
BLOCK_ROWS = 4_096
LEAST_BLOCKS = 24
LEAST_ROWS = 256
# Queries that meet a block in one task, and are multiplied with it at once.
QUERIES_PER_TASK = 8_192
QUERIES_AT_ONCE = 256
PLACED = "curve int, key long, vec_id long, asks boolean, vector binary"


def hilbert_keys(grid: np.ndarray, bits: int) -> np.ndarray:
    """Place of each grid point (rows of ``bits``-bit coordinates) on the Hilbert curve.

    The Gray-code form: from the highest bit down, each axis either flips or swaps the lower bits
    of the first, then the axes are Gray-decoded and their bits interleaved.
    """
    axes = [np.array(column, np.int64) for column in grid.T]
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for i, axis in enumerate(axes):
            up = (axis & bit) != 0
            swap = np.where(up, 0, (axes[0] ^ axis) & low)
            axes[0] = axes[0] ^ np.where(up, low, swap)
            if i:
                axes[i] = axes[i] ^ swap
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    flip = np.zeros_like(axes[0])
    for level in range(bits - 1, 0, -1):
        flip = np.where(axes[-1] & (1 << level), flip ^ ((1 << level) - 1), flip)
    key = np.zeros_like(flip)
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            key = (key << 1) | (((axis ^ flip) >> level) & 1)
    return key


def usable(vector: str) -> Column:
    """Vectors with finite components that are not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _extended(x: np.ndarray, longest: float) -> np.ndarray:
    x = x / longest
    return np.hstack([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(1)))[:, None]])


def measured(vectors: DataFrame) -> tuple[int, float] | None:
    """The most frequent number of dimensions, and the longest of its vectors."""
    sizes = vectors.groupBy(F.size("vector").alias("size")).agg(
        F.count("*").alias("n"),
        F.max(F.aggregate("vector", F.lit(0.0), lambda s, v: s + v * v)).alias("square")
    ).orderBy(F.desc("n"), "size").limit(1).collect()
    if not sizes:
        return None
    return sizes[0]["size"], float(sizes[0]["square"]) ** 0.5


def place(points: DataFrame, size: int, longest: float, seed: int = 5) -> DataFrame:
    """Every vector with a ``vec_id``, and every one with an ``ask`` as a query, on each curve."""
    sample = points.where("vec_id is not null").orderBy(F.xxhash64("vec_id"), "vec_id").limit(FIT_ROWS).select("vector").collect()
    known = _extended(np.array([r["vector"] for r in sample], float), longest)
    random = np.random.default_rng(seed)
    curves = []
    for _ in range(CURVES):
        axes = np.linalg.qr(random.normal(size=(size + 1, min(AXES, size + 1))))[0]
        seen = known @ axes
        curves.append((axes, seen.mean(0), seen.std(0) + 1e-9, random.uniform(0, 1, axes.shape[1])))

    def keys(points: np.ndarray, curve) -> np.ndarray:
        axes, mean, spread, shift = curve
        at = ((points @ axes - mean) / spread + 4 + shift) / 9
        return hilbert_keys(np.clip(at * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64), BITS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 2_000):
                batch = whole.slice(first, 2_000)
                x = batch.column(2).flatten().to_numpy().reshape(batch.num_rows, size)
                raw = np.array([v.tobytes() for v in x], object)
                hold = np.flatnonzero(batch.column(0).is_valid().to_numpy(zero_copy_only=False))
                ask = np.flatnonzero(batch.column(1).is_valid().to_numpy(zero_copy_only=False))
                ids = batch.column(0).drop_null().to_numpy()
                asked = batch.column(1).drop_null().to_numpy()
                far = _extended(x[hold], longest)
                near = x[ask] / np.sqrt((x[ask] ** 2).sum(1))[:, None]
                near = np.hstack([near, np.zeros((len(ask), 1))])
                for c, curve in enumerate(curves):
                    key = np.concatenate([keys(far, curve), keys(near, curve)])
                    asks = np.arange(len(key)) >= len(ids)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(key), c, np.int32)), pa.array(key),
                        pa.array(np.concatenate([ids, asked])), pa.array(asks),
                        pa.array(np.concatenate([raw[hold], raw[ask]]), pa.binary())],
                        names=["curve", "key", "vec_id", "asks", "vector"])

    return points.select("vec_id", "ask", "vector").mapInArrow(work, PLACED)


def _best(asked: pa.Table, held: pa.Table, size: int, k: int) -> pa.Table:
    """The k best rows of a block for each query that meets it."""
    out: list[tuple[np.ndarray, ...]] = []
    if asked.num_rows and held.num_rows:
        def matrix(t: pa.Table) -> np.ndarray:
            return np.frombuffer(b"".join(t.column("vector").to_pylist()), float).reshape(-1, size)

        x, ids = matrix(held), held.column("vec_id").to_numpy()
        names_held, same = np.unique(ids, return_inverse=True)
        # Rows that repeat an id take no other row's place.
        wide = k + len(ids) - len(names_held)
        q, query = matrix(asked), asked.column("vec_id").to_numpy()
        for first in range(0, len(q), QUERIES_AT_ONCE):
            part, names = q[first:first + QUERIES_AT_ONCE], query[first:first + QUERIES_AT_ONCE]
            scores = part @ x.T
            least = np.partition(scores, -wide, axis=1)[:, -wide] if x.shape[0] > wide else np.full(len(part), -np.inf)
            # The product is computed again in one fixed order, so equal vectors get equal scores.
            near = scores >= (least - 1e-9 * (1 + np.abs(np.where(np.isinf(least), 0, least))))[:, None]
            i, j = np.nonzero(near & (scores > -np.inf))
            exact = np.empty(len(i))
            for a in range(0, len(i), 65_536):
                exact[a:a + 65_536] = (part[i[a:a + 65_536]] * x[j[a:a + 65_536]]).sum(1)
            order = np.lexsort((ids[j], -exact, i))
            i, j, exact = i[order], j[order], exact[order]
            once = np.sort(np.unique(i * len(names_held) + same[j], return_index=True)[1])
            i, j, exact = i[once], j[once], exact[once]
            first_of = np.searchsorted(i, np.arange(len(part)))
            keep = np.arange(len(i)) - first_of[i] < k
            out.append((names[i[keep]], ids[j[keep]], exact[keep]))
    columns = [np.concatenate(c) for c in zip(*out)] if out else [
        np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    return pa.table({"ask": columns[0], "vec_id": columns[1], "score": columns[2]})


def nearest(df: DataFrame, k: int = 20, every: int = 20, vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the k rows found for each query, a row whose
    ``vec_id`` is divisible by ``every``."""
    vectors = df.where(F.col("vec_id").isNotNull() & usable(vector)).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col(vector).cast("array<double>").alias("vector"))
    found = measured(vectors)
    if found is None:
        return vectors.limit(0).select(
            F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score"))
    size, longest = found
    vectors = staged(vectors.where(F.size("vector") == size).distinct(), "vectors")
    copies = Window.partitionBy("vector").orderBy("vec_id")
    kept = vectors.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1)
    asking = vectors.where(F.col("vec_id") % every == 0)
    asks = staged(asking.select("vector").distinct().withColumn(
        "ask", F.monotonically_increasing_id()), "asks")
    queries = asking.join(asks, "vector").select(F.col("vec_id").alias("query_id"), "ask")
    points = staged(kept.select("vec_id", F.lit(None).cast("long").alias("ask"), "vector").unionByName(
        asks.select(F.lit(None).cast("long").alias("vec_id"), "ask", "vector")), "points")
    rows = points.where("vec_id is not null").count()
    placed = place(points, size, longest)
    blocks = max(1, ceil(rows / BLOCK_ROWS), min(LEAST_BLOCKS, rows // LEAST_ROWS))
    if blocks > 1:
        placed = placed.repartitionByRange(
            CURVES * blocks, "curve", "key", F.xxhash64("vec_id", "asks")).withColumn(
            "block", F.spark_partition_id())
    else:  # range bounds are estimates; a table of one block must not be cut
        placed = placed.withColumn("block", F.col("curve"))
    placed = staged(placed, "curves")
    ends = {r["curve"]: (r["low"], r["high"]) for r in placed.groupBy("curve").agg(
        F.min("block").alias("low"), F.max("block").alias("high")).collect()}
    low = F.get(F.array(*[F.lit(ends[c][0]) for c in range(CURVES)]), F.col("curve"))
    many = F.get(F.array(*[F.lit(ends[c][1] - ends[c][0] + 1) for c in range(CURVES)]), F.col("curve"))
    reach = ceil(SHARE * blocks) if blocks > 1 else 0
    together = max(1, QUERIES_PER_TASK * blocks * every // max(rows, 1))
    placed = placed.withColumn("at", F.col("block") - low).withColumn("many", many)
    # Places that several blocks hold; at most one for each block's end.
    cut = placed.groupBy("curve", "key").agg(
        F.min("at").alias("first"), F.max("at").alias("last")).where("first < last")
    steps = F.sequence(F.coalesce("first", "at") - reach, F.coalesce("last", "at") + reach)
    ring = F.array_distinct(F.transform(steps, lambda a: F.pmod(a, F.col("many"))))
    chunk = F.floor(F.col("at") / together).cast("int")
    asked = placed.where("asks").join(F.broadcast(cut), ["curve", "key"], "left").select(
        "curve", F.explode(ring).alias("at"), chunk.alias("chunk"), "vec_id", "vector")
    keys = ["curve", "at", "chunk"]
    # toDF names the columns anew: both sides of the meeting come from the same table.
    meetings = asked.select(*keys).distinct().toDF(*keys)
    asked = asked.toDF(*asked.columns)
    held = placed.where("not asks").select("curve", "at", "vec_id", "vector").join(
        F.broadcast(meetings), ["curve", "at"])
    held = held.toDF(*held.columns)
    met = held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(
        lambda h, a: _best(a, h, size, k + 1), "ask long, vec_id long, score double")
    once = met.groupBy("ask", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("ask").orderBy(F.desc("score"), "vec_id")
    once = once.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k + 1).drop("rank")
    found = queries.join(once, "ask").where("query_id <> vec_id").groupBy("query_id", "vec_id").agg(
        F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
