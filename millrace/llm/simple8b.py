"""Token ids in files of Simple-8b words.

A 64-bit word has a 4-bit selector and 60 bits of ids. The selector says how many ids of which
width the word holds. Ids are cut into blocks of ``BLOCK`` that are coded on their own, and a file
row lists the word at which each block begins, so all blocks of a row decode side by side. An id
that 60 bits cannot hold (or that equals the escape) is written as the escape, 60 set bits in a
one-id word; the ids so escaped follow in order in a list of whole 64-bit numbers.

``write_ids`` writes one row per run of neighbouring documents: their keys and lengths, the words,
the block offsets, the escapes, and the place of the run within its partition. Rows are written by
Spark's Parquet writer, so a lost task leaves no half-written file behind.

Defined results: documents go in ascending ``doc_id`` (nulls first, equal ones by the hash of their
text); null text counts as empty and has only its end id; repeated rows are written as often as
they occur; an empty table gives files without rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import slices
from millrace.llm.tokens import ENCODE_BYTES, file_encoder
from millrace.session import new_folder

# Ids in a word and bits of each, by selector: the fixed values of the format.
COUNTS = (240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
ESCAPE = (1 << 60) - 1
BLOCK = 1024
# A file row closes once it holds this many ids.
ROW_IDS = 131_072

SCHEMA = pa.schema([
    ("part", pa.int32()), ("run", pa.int64()), ("first", pa.int64()), ("n_ids", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("words", pa.binary()),
    ("blocks", pa.list_(pa.int32())), ("escapes", pa.binary())])
FILE = (
    "part int, run long, first long, n_ids long, doc_ids array<long>, lengths array<long>, "
    "words binary, blocks array<int>, escapes binary")


def _bits(ids: np.ndarray) -> np.ndarray:
    """Bit length of every id; frexp is exact below 2**53, larger ones count in two halves."""
    low = np.frexp(ids.astype(np.float64))[1]
    if len(ids) and ids.max() >= 1 << 53:
        high = ids >> np.uint64(32)
        low = np.where(high > 0, np.frexp(high.astype(np.float64))[1] + 32, low)
    return low.astype(np.uint8)


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, the first word of each block, and the escaped ids of an array of ids."""
    ids = np.ascontiguousarray(ids, np.uint64)
    if not len(ids):
        return np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.uint64)
    escaped = ids >= np.uint64(ESCAPE)
    escapes, ids = ids[escaped], np.where(escaped, np.uint64(ESCAPE), ids)
    blocks = -(-len(ids) // BLOCK)
    # 240 zeros after each block let a word reach past its end; the reader cuts them off.
    grid = np.zeros((blocks, BLOCK + COUNTS[0]), np.uint64)
    fill = np.zeros(blocks * BLOCK, np.uint64)
    fill[:len(ids)] = ids
    grid[:, :BLOCK] = fill.reshape(blocks, BLOCK)
    bits = _bits(grid.ravel()).reshape(grid.shape)
    widest = {1: bits}
    span = 1
    while span < 128:
        last = widest[span]
        wide = last.copy()
        wide[:, :-span] = np.maximum(last[:, :-span], last[:, span:])
        span *= 2
        widest[span] = wide
    best = np.full((blocks, BLOCK), 15, np.uint8)
    for selector in range(14, -1, -1):
        count, width = COUNTS[selector], WIDTHS[selector]
        span = 1 << (count.bit_length() - 1)
        most = widest[span][:, :BLOCK]
        if most.min() > width:
            continue
        if span < count:
            shift = count - span
            most = np.maximum(most, widest[span][:, shift:shift + BLOCK])
        best[most <= width] = selector
    sizes = np.full(blocks, BLOCK, np.int64)
    sizes[-1] = len(ids) - (blocks - 1) * BLOCK
    counts = np.array(COUNTS, np.int64)
    at, active = np.zeros(blocks, np.int64), np.arange(blocks)
    took_block, took_at, took_selector, steps = [], [], [], []
    step = 0
    while len(active):
        here = at[active]
        chosen = best[active, here]
        took_block.append(active)
        took_at.append(here)
        took_selector.append(chosen)
        steps.append(np.full(len(active), step))
        at[active] = here + counts[chosen]
        active = active[at[active] < sizes[active]]
        step += 1
    block, start = np.concatenate(took_block), np.concatenate(took_at)
    selector = np.concatenate(took_selector)
    order = np.lexsort((np.concatenate(steps), block))
    block, start, selector = block[order], start[order], selector[order]
    words = selector.astype(np.uint64) << np.uint64(60)
    flat = grid.ravel()
    for s in range(2, 16):
        mine = np.flatnonzero(selector == s)
        if len(mine):
            base = block[mine] * grid.shape[1] + start[mine]
            for k in range(COUNTS[s]):
                words[mine] |= flat[base + k] << np.uint64(k * WIDTHS[s])
    return words, np.searchsorted(block, np.arange(blocks)).astype(np.int32), escapes


def unpack(words: np.ndarray, blocks: np.ndarray, escapes: np.ndarray, n_ids: int) -> np.ndarray:
    """The ids behind ``pack``'s result."""
    out = np.zeros(n_ids, np.uint64)
    if not n_ids:
        return out
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = np.array(COUNTS, np.int64)[selector]
    block = np.repeat(np.arange(len(blocks)), np.diff(np.append(blocks, len(words))))
    ends = np.cumsum(counts)
    before = (ends - counts)
    start = before - before[blocks][block] + block * BLOCK
    limit = np.minimum((block + 1) * BLOCK, n_ids)
    for s in range(2, 16):
        mine = np.flatnonzero(selector == s)
        mask = np.uint64((1 << WIDTHS[s]) - 1)
        for k in range(COUNTS[s]) if len(mine) else ():
            place = start[mine] + k
            inside = place < limit[mine]
            out[place[inside]] = (words[mine] >> np.uint64(k * WIDTHS[s]))[inside] & mask
    marked = np.flatnonzero(out == np.uint64(ESCAPE))
    out[marked] = escapes
    return out


def _rows(batches: Iterator[pa.RecordBatch], path: str, drops_white: bool, end_id: int,
          row_ids: int) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    end = np.array([end_id], "<u4").tobytes()
    held: list[tuple[int | None, bytes]] = []
    size = run = first = 0

    def close():
        nonlocal held, size, run, first
        ids = np.frombuffer(b"".join(x for _, x in held), "<u4")
        words, blocks, escapes = pack(ids)
        row = pa.RecordBatch.from_pylist([{
            "part": part, "run": run, "first": first, "n_ids": len(ids),
            "doc_ids": [d for d, _ in held], "lengths": [len(x) // 4 for _, x in held],
            "words": words.astype("<u8").tobytes(), "blocks": blocks.tolist(),
            "escapes": escapes.astype("<u8").tobytes(),
        }], schema=SCHEMA)
        held, size, run, first = [], 0, run + 1, first + len(ids)
        return row

    for batch in batches:
        for piece in slices(batch, most=ENCODE_BYTES):
            found = file_encoder(path, drops_white).encode(piece.column(0))
            for doc_id, ids in zip(piece.column(1).to_pylist(), found):
                held.append((doc_id, ids + end))
                size += len(ids) // 4 + 1
                if size >= row_ids:
                    yield close()
    if held:
        yield close()


def write_ids(docs: DataFrame, folder: str, path: str | None = None, end_id: int = 0,
              drops_white: bool = False, row_ids: int = ROW_IDS) -> None:
    """Encode whole texts with a tokenizers file and write their ids in ascending ``doc_id``."""
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    keyed = docs.select(
        F.col("text").alias("text"), F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("tie"))
    ordered = keyed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    rows = ordered.mapInArrow(lambda b: _rows(b, path, drops_white, end_id, row_ids), FILE)
    rows.write.option("compression", "none").parquet(folder)


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of the files: ``doc_id``, ``start`` (ids before it in all files) and ``ids``."""
    rows = spark.read.schema(FILE).parquet(folder)
    # One row per partition of the writer; its total decides where the next partition begins.
    totals = rows.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).cast("long").alias("base"))
    # As many rows as the writer had partitions.
    placed = rows.join(F.broadcast(bases), "part").select(
        (F.col("base") + F.col("first")).alias("first"), *SCHEMA.names[3:])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                first, n_ids, docs, lengths, words, blocks, escapes = (
                    c[row].as_py() for c in batch.columns)
                ids = unpack(np.frombuffer(words, "<u8"), np.array(blocks, np.int64),
                             np.frombuffer(escapes, "<u8"), n_ids).astype("<u4")
                ends = np.cumsum(lengths)
                starts = ends - np.array(lengths, np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(docs, pa.int64()), pa.array(starts + first, pa.int64()),
                    pa.array([ids[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                ], names=["doc_id", "start", "ids"])

    return placed.mapInArrow(decode, "doc_id long, start long, ids binary")


def written_and_read(docs: DataFrame) -> DataFrame:
    """Query op9: every document's place, length and checksum, as read back from the files."""
    folder = new_folder(docs.sparkSession, "llm-ids")
    write_ids(docs, folder)
    return read_ids(docs.sparkSession, folder).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"))
