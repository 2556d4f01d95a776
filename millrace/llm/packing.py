"""Harmonic packing of tokenised documents into sequences of a fixed capacity.

Class k holds pieces of one reciprocal capacity, ``capacity // k`` tokens, and each of its bins
takes exactly k of them. A document is cut greedily: the longest reciprocal capacity that still
fits, then the same for what is left, so every id falls into exactly one piece and few cuts are
made. Workers number the pieces of a class on their own; only the counts per worker and class meet
to turn these numbers into global ones, and a piece's bin and offset follow by division. Each class
may end in one unfilled bin. The pieces of these bins, fewer than k per class however many
documents there are, are laid end to end and cut at the capacity, and the last sequence at powers
of two, so that only the gap between k * (capacity // k) and the capacity is ever padded.

Defined results: null text counts as empty, and an empty document is its end id alone; repeated
rows are packed as often as they occur; a long document spans as many sequences as it needs; an
empty table gives no pieces; other columns are not read; a null ``doc_id`` is kept.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import slices, staged
from millrace.llm.tokens import ENCODE_BYTES, file_encoder

CAPACITY = 2048
# The plan of bins, 40 bytes per worker and class, is broadcast up to so many rows; more are joined.
BROADCAST_ROWS = 400_000
CUT = (
    "part int, width int, nth long, doc_id long, start long, length long, doc_tokens long, "
    "ids binary")


def cuts(capacity: int) -> list[list[int]]:
    """For every remainder below the capacity, the reciprocal capacities it is cut into."""
    widths = sorted({capacity // k for k in range(1, capacity + 1)})
    out: list[list[int]] = [[]]
    for left in range(1, capacity + 1):
        width = widths[bisect_right(widths, left) - 1]
        out.append([width, *out[left - width]])
    return out


def _cut(batches: Iterator[pa.RecordBatch], path: str, end_id: int, capacity: int,
         drops_white: bool) -> Iterator[pa.RecordBatch]:
    part, plan = TaskContext.get().partitionId(), cuts(capacity)
    end = np.array([end_id], "<u4").tobytes()
    count = dict.fromkeys(range(capacity + 1), 0)
    names = ["part", "width", "nth", "doc_id", "start", "length", "doc_tokens", "ids"]
    types = [pa.int32(), pa.int32(), *[pa.int64()] * 5, pa.binary()]
    for batch in batches:
        for piece in slices(batch, most=ENCODE_BYTES):
            rows: list[tuple] = []
            encoded = file_encoder(path, drops_white).encode(piece.column(0))
            for doc_id, ids in zip(piece.column(1).to_pylist(), encoded):
                ids += end
                total, at = len(ids) // 4, 0
                for width in [capacity] * (total // capacity) + plan[total % capacity]:
                    rows.append((part, width, count[width], doc_id, at, width, total,
                                 ids[4 * at:4 * (at + width)]))
                    count[width] += 1
                    at += width
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _leftovers(rest: DataFrame, capacity: int, first_sequence: Column) -> DataFrame:
    """Lay the pieces of unfilled bins end to end; their number is bounded by the capacity alone."""
    order = Window.orderBy(F.desc("width"), "rank")
    upto = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("length").over(Window.partitionBy())
    bits = (capacity - 1).bit_length() - 1
    line = rest.select(
        "*", upto.alias("b"), (upto - F.col("length")).alias("a"), total.alias("total")
    ).withColumn("whole", F.col("total") - F.col("total") % capacity)
    line = line.withColumn("tail", F.expr(
        f"sort_array(transform(filter(sequence(0, {bits}), "
        "i -> shiftright(total - whole, i) % 2 = 1), "
        "i -> whole + shiftleft(shiftright(total - whole, i + 1), i + 1)))"))
    line = line.withColumn("bounds", F.expr(
        f"filter(concat(array(whole, a - a % {capacity} + {capacity}), tail), "
        "x -> a < x and x < b)"))
    line = line.withColumn("begins", F.expr("sort_array(array_distinct(concat(array(a), bounds)))"))
    line = line.select("*", F.posexplode("begins").alias("i", "p"))
    line = line.withColumn("q", F.expr("coalesce(try_element_at(begins, i + 2), b)"))
    passed = F.expr("filter(tail, x -> x <= p)")
    inside = F.col("p") < F.col("whole")
    sequence = F.when(inside, F.floor(F.col("p") / capacity)).otherwise(
        F.floor(F.col("whole") / capacity) + F.size(passed) - 1)
    begin = F.when(inside, F.col("p") - F.col("p") % capacity).otherwise(F.array_max(passed))
    skip = (F.col("p") - F.col("a")).cast("int")
    length = (F.col("q") - F.col("p")).cast("int")
    return line.select(
        "doc_id", (F.col("start") + skip).alias("start"), length.cast("long").alias("length"),
        F.substring(F.col("ids"), skip * 4 + 1, length * 4).alias("ids"), "doc_tokens",
        (first_sequence + sequence).cast("long").alias("sequence_id"),
        (F.col("p") - begin).cast("long").alias("offset"))


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, end_id: int = 1,
         drops_white: bool = True) -> DataFrame:
    """One row per piece: ``doc_id``, ``start`` in the document, ``length``, ``ids`` (binary,
    little-endian unsigned 32-bit), ``doc_tokens``, ``sequence_id`` and ``offset`` there."""
    path = path or public_tokenizers.path("word_bpe_49k.json")
    source = docs.select(F.col("text").alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    pieces = staged(
        source.mapInArrow(lambda b: _cut(b, path, end_id, capacity, drops_white), CUT), "pieces")

    counts = pieces.groupBy("part", "width").agg(F.count("*").alias("n"))
    of_class = Window.partitionBy("width")
    earlier = of_class.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    workers = counts.select(
        "part", "width", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    # One row per class, at most two square roots of the capacity.
    per_bin = F.expr(f"{capacity} div width")
    classes = counts.groupBy("width").agg(F.sum("n").alias("n")).select(
        "width", F.expr(f"n div ({capacity} div width)").alias("bins"))
    before = Window.orderBy("width").rowsBetween(Window.unboundedPreceding, -1)
    classes = classes.select(
        "width", "bins", F.coalesce(F.sum("bins").over(before), F.lit(0)).alias("first_bin"),
        F.sum("bins").over(Window.partitionBy()).alias("all_bins"))
    plan = workers.join(classes, "width")
    if counts.count() <= BROADCAST_ROWS:
        plan = F.broadcast(plan)
    placed = (
        pieces.join(plan, ["part", "width"])
        .withColumn("rank", F.col("base") + F.col("nth"))
        .withColumn("bin", F.expr(f"rank div ({capacity} div width)")))
    filled = placed.where("bin < bins").select(
        "doc_id", "start", "length", "ids", "doc_tokens",
        (F.col("first_bin") + F.col("bin")).cast("long").alias("sequence_id"),
        ((F.col("rank") % per_bin) * F.col("width")).cast("long").alias("offset"))
    return filled.unionByName(
        _leftovers(placed.where("bin >= bins"), capacity, F.col("all_bins")))


def sequences(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row per sequence: its ids, their number, and the length it is padded to."""
    ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = pieces.groupBy("sequence_id").agg(ordered.alias("parts"))
    ids = F.aggregate("parts", F.lit(b""), lambda done, x: F.concat(done, x["ids"]))
    n = (F.octet_length("ids") / 4).cast("long")
    power = (n > 0) & (F.bit_count(n) == 1)
    return joined.select("sequence_id", ids.alias("ids")).select(
        "sequence_id", "ids", n.alias("n_tokens"),
        F.when(power, n).otherwise(F.lit(capacity).cast("long")).alias("padded"))


def packed_pieces(docs: DataFrame) -> DataFrame:
    """Query op3: where every id of every document went."""
    return pack(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset")
