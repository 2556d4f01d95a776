"""Uniform random shards of exact size by a hypergeometric communication matrix.

Rows fall into parts by a hash of their key. How many rows each part sends to each shard is drawn
exactly from the multivariate hypergeometric law: the numbers that a uniform permutation of all
rows would give, so shard sizes come out exact. Each part then puts its rows in random order and
deals them out by these counts, the rows move to their shards, and each shard orders them once
more. A shard is ordered in blocks of the second random key whose counts give the blocks' first
slots, so no task holds a whole shard. The matrix has one row per part (twice the session's shuffle
partitions) and one column per shard; it is all the driver sees.

Random order comes from hashes of a seed and the row, so a repeated task deals the same way.

Defined results: null text has no bytes; null keys are hashed like any value; equal rows are
interchangeable; fewer rows than shards leave some shards empty; an empty table gives no rows. All
input columns are returned; one named ``shard`` or ``slot`` is replaced by the result's column.
"""

from __future__ import annotations

import json
import random
from math import exp, lgamma

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import fresh, staged

SHARDS = 40
# Rows that one task orders within a shard, about.
BLOCK_ROWS = 2_000


def hypergeometric(good: int, total: int, drawn: int, uniform: float) -> int:
    """How many of ``drawn`` balls are good, out of ``good`` among ``total``, at a given quantile.

    The inverse of the distribution function, summed outwards from the mode, so about as many
    steps as the standard deviation are taken.
    """
    low, high = max(0, drawn + good - total), min(good, drawn)
    if low >= high:
        return low
    mode = min(max((drawn + 1) * (good + 1) // (total + 2), low), high)

    def choose(n: int, k: int) -> float:
        return lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1)

    bad = total - good
    at_mode = exp(choose(good, mode) + choose(bad, drawn - mode) - choose(total, drawn))
    left = right = mode
    p_left = p_right = at_mode
    uniform -= at_mode
    while uniform >= 0 and (left > low or right < high):
        if right < high:
            p_right *= (good - right) * (drawn - right) / ((right + 1) * (bad - drawn + right + 1))
            right += 1
            uniform -= p_right
            if uniform < 0:
                return right
        if left > low:
            p_left *= left * (bad - drawn + left) / ((good - left + 1) * (drawn - left + 1))
            left -= 1
            uniform -= p_left
            if uniform < 0:
                return left
    return mode


def communication_matrix(rows: list[int], shards: list[int], seed: int) -> list[list[int]]:
    """Rows from each part to each shard, with exactly the given sums of rows and columns."""
    generator, room, out = random.Random(seed), list(shards), []
    for n in rows:
        line, left, total = [], n, sum(room)
        for j, space in enumerate(room):
            taken = hypergeometric(space, total, left, generator.random())
            total -= space
            left -= taken
            room[j] -= taken
            line.append(taken)
        out.append(line)
    return out


def shuffle_into_shards(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id",
                        seed: int = 20_260, parts: int | None = None,
                        block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All rows, with ``shard`` (0 to shards - 1, sizes at most one apart) and ``slot`` (0 on)."""
    spark = docs.sparkSession
    parts = parts or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    part, order, again, block, ends = (fresh(n) for n in ("part", "order", "again", "block", "ends"))
    kept = docs.drop("shard", "slot")
    part_of = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(parts)).cast("int")

    sizes = dict(kept.groupBy(part_of.alias("p")).count().collect())
    total = sum(sizes.values())
    room = [total // shards + (j < total % shards) for j in range(shards)]
    matrix = communication_matrix([sizes.get(i, 0) for i in range(parts)], room, seed)
    lines = []
    for i, line in enumerate(matrix):
        upto, acc = [], 0
        for taken in line:
            acc += taken
            upto.append(acc)
        lines.append({"p": i, "e": upto})
    deals = spark.range(1, numPartitions=1).select(F.inline(F.from_json(
        F.lit(json.dumps(lines)), "array<struct<p int, e array<bigint>>>"))).toDF(part, ends)

    whole = F.xxhash64(F.lit(seed + 1), F.struct(*[F.col(f"`{c}`") for c in kept.columns]))
    local = Window.partitionBy(part).orderBy(order)
    dealt = (
        kept.withColumns({part: part_of, order: whole})
        .withColumn("slot", F.row_number().over(local) - 1)
        .join(deals, part)
        .withColumn("shard", F.size(F.filter(ends, lambda e: e <= F.col("slot"))))
        .withColumn(again, F.xxhash64(F.lit(seed + 2), F.col(order)))
        .drop("slot", part, order, ends))
    dealt = staged(dealt, "shards")

    blocks = max(1, -(-total // (shards * block_rows)))
    # The key's upper 53 bits as a share of the whole range.
    share = (F.shiftright(F.col(again), 11) + F.lit(1 << 52)) / F.lit(float(1 << 53))
    dealt = dealt.withColumn(block, F.floor(share * blocks).cast("int"))
    counts = dealt.groupBy("shard", block).agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    first = fresh("first")
    firsts = counts.select("shard", block, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(first))
    within = Window.partitionBy("shard", block).orderBy(again)
    return (
        dealt.withColumn("slot", F.row_number().over(within) - 1)
        .join(firsts, ["shard", block])
        .withColumn("slot", (F.col("slot") + F.col(first)).cast("long"))
        .select(*[f"`{c}`" for c in kept.columns], "shard", "slot"))


def sharded(docs: DataFrame) -> DataFrame:
    """Query op10: the place of every document under the ``rows`` law."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return shuffle_into_shards(docs.select("doc_id", "text")).select(
        "doc_id", (F.octet_length(raw) + 16).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
