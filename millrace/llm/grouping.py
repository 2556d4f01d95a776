"""Best-fit packing by a grouping genetic algorithm on islands.

Documents longer than a sequence are cut into pieces of its capacity and a rest; a piece of exactly
the capacity is a sequence of its own. All other pieces are dealt by a hash into demes of bounded
size. A deme's chromosome is a grouping: a list of bins, each a list of lengths, since pieces of
equal length may change places. Crossover injects whole well-filled bins of one parent into the
other, drops every bin that holds a piece twice, and puts the displaced pieces where they fit best;
mutation dissolves the emptiest bins, and a few others, in the same way. A deme is evolved on several islands, each a row
of a Spark table with a population of its own; after each epoch the elite of every island migrates
to the next one by a join, and a deme rests when an island has reached the least number of bins its
tokens allow. What a deme's last bins leave open is won back a level up: the emptiest bins of many
demes are dissolved and their pieces form new demes, until one deme is left.

Nothing grows in a task but the number of its rows: a deme holds some thousands of lengths and
keys, tokens are not moved, and placements join the written pieces by key.

Defined results: null text counts as empty, and an empty document is its end id alone; repeated
rows are packed as often as they occur; an empty table gives no pieces; other columns are not read;
a null ``doc_id`` is kept. Equal input, cut into the same partitions, gives equal sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import slices, staged
from millrace.llm.tokens import ENCODE_BYTES, file_encoder

CAPACITY = 2048
# Pieces of a deme, on average, and islands that evolve each deme.
DEME_PIECES = 4_000
ISLANDS = 3
EPOCHS = 3
GENERATIONS = 8
POPULATION = 4
# Chance that a bin of the host is dissolved anyway.
MUTATION = 0.03
# Share of a deme's bins, the emptiest ones, that go up a level, and their number at least.
DISSOLVED = 0.02
LEAST_DISSOLVED = 8
PIECE = (
    "key long, doc_id long, piece int, start long, length long, ids binary, ids_crc32 long")
ISLAND = (
    "deme long, island int, keys array<long>, lengths array<int>, population array<binary>, "
    "bins int, done boolean")
PLACED = "key long, length int, bin int, offset long, up boolean, deme long"

Bins = list[list[int]]


def best_fit(items: list[int], bins: Bins, capacity: int) -> Bins:
    """Put each length into the bin it fills most, in the order given; bins are changed in place.

    The free spaces in use are the bits of one number, so the least that suffices is its lowest
    bit from the length on.
    """
    at: list[list[int]] = [[] for _ in range(capacity + 1)]
    free = [capacity - sum(b) for b in bins]
    mask = 0
    for i, f in enumerate(free):
        at[f].append(i)
        mask |= 1 << f
    for size in items:
        fits = mask >> size
        if fits:
            f = size + (fits & -fits).bit_length() - 1
            i = at[f].pop()
            if not at[f]:
                mask &= ~(1 << f)
            bins[i].append(size)
            f -= size
        else:
            i, f = len(bins), capacity - size
            bins.append([size])
        at[f].append(i)
        mask |= 1 << f
    return bins


def fitness(bins: Bins) -> tuple[int, int]:
    """Higher is better: few bins, then full ones."""
    return -len(bins), sum(sum(b) ** 2 for b in bins)


def crossover(donor: Bins, host: Bins, counts: np.ndarray, capacity: int,
              rng: np.random.Generator) -> Bins:
    """A child with whole well-filled bins of the donor and what the host's bins still can keep."""
    fullest = sorted(range(len(donor)), key=lambda i: -sum(donor[i]))[:(len(donor) + 1) // 2]
    picked = rng.random(len(fullest)) < rng.choice([0.25, 0.5, 0.75])
    child = [list(donor[i]) for i, take in zip(fullest, picked) if take]
    emptiest = max(1, len(host) // 50)
    left = counts.tolist()
    for b in child:
        for size in b:
            left[size] -= 1
    stays = rng.random(len(host)) > MUTATION
    for b, stay in zip(sorted(host, key=sum, reverse=True)[:-emptiest], stays):
        if not stay:
            continue
        done = 0
        for size in b:
            if not left[size]:
                break
            left[size] -= 1
            done += 1
        if done == len(b):
            child.append(list(b))
        else:  # it holds a piece that an injected bin has
            for size in b[:done]:
                left[size] += 1
    displaced = np.repeat(np.arange(capacity, -1, -1), left[::-1])
    if rng.random() < 0.5:
        displaced = displaced[np.argsort(-displaced * rng.uniform(0.5, 1.0, len(displaced)))]
    return best_fit(displaced.tolist(), child, capacity)


def to_bytes(bins: Bins) -> bytes:
    """Lengths of all bins, each bin ended by a zero."""
    return np.array([s for b in bins for s in (*b, 0)], "<i4").tobytes()


def from_bytes(raw: bytes) -> Bins:
    flat, out, begin = np.frombuffer(raw, "<i4"), [], 0
    values = flat.tolist()
    for end in np.flatnonzero(flat == 0).tolist():
        out.append(values[begin:end])
        begin = end + 1
    return out


def founders(lengths: list[int], capacity: int, rng: np.random.Generator) -> list[Bins]:
    """First population: best fit in falling order, and in orders that chance has disturbed."""
    falling = np.sort(np.array(lengths))[::-1]
    out = [best_fit(falling.tolist(), [], capacity)]
    for _ in range(POPULATION - 1):
        order = np.argsort(-falling * rng.uniform(0.5, 1.0, len(falling)), kind="stable")
        out.append(best_fit(falling[order].tolist(), [], capacity))
    return out


def least_bins(lengths: list[int], capacity: int) -> int:
    """No packing needs fewer: by tokens, or by pieces of which no two share a bin."""
    return max(-(-sum(lengths) // capacity), sum(2 * s > capacity for s in lengths))


def evolve(lengths: list[int], population: list[Bins], capacity: int, generations: int,
           rng: np.random.Generator) -> list[Bins]:
    """The population after some generations, best first. Each child replaces the worst."""
    if not population:
        population = founders(lengths, capacity, rng)
    population = sorted(population, key=fitness, reverse=True)
    counts = np.bincount(lengths, minlength=capacity + 1)
    bound = least_bins(lengths, capacity)
    for _ in range(generations):
        if len(population[0]) <= bound:
            break
        first, second = rng.choice(len(population), 2, replace=False).tolist() \
            if len(population) > 1 else (0, 0)
        child = crossover(population[first], population[second], counts, capacity, rng)
        distinct = {fitness(p): p for p in (child, *population)}
        population = [distinct[f] for f in sorted(distinct, reverse=True)][:POPULATION]
    return population


def _islands(batches: Iterator[pa.RecordBatch], capacity: int, epoch: int,
             generations: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            seed = zlib.crc32(f"{row['deme']}:{row['island']}:{epoch}".encode())
            found = evolve(row["lengths"], [from_bytes(p) for p in row["population"]], capacity,
                           generations, np.random.default_rng(seed))
            row["population"] = [to_bytes(p) for p in found]
            row["bins"] = len(found[0])
            row["done"] = len(found[0]) <= least_bins(row["lengths"], capacity)
            yield pa.RecordBatch.from_pylist([row], schema=pa.schema([
                ("deme", pa.int64()), ("island", pa.int32()), ("keys", pa.list_(pa.int64())),
                ("lengths", pa.list_(pa.int32())), ("population", pa.list_(pa.binary())),
                ("bins", pa.int32()), ("done", pa.bool_())]))


def _placed(batches: Iterator[pa.RecordBatch], go_up: bool) -> Iterator[pa.RecordBatch]:
    """Give every piece of a deme a place of its length in the best grouping."""
    for batch in batches:
        for deme, keys, lengths, raw in zip(*(c.to_pylist() for c in batch.columns)):
            bins = sorted(from_bytes(raw), key=sum, reverse=True)
            up = max(LEAST_DISSOLVED, int(len(bins) * DISSOLVED)) if go_up else 0
            of_length: dict[int, list[int]] = {}
            for key, size in sorted(zip(keys, lengths), reverse=True):
                of_length.setdefault(size, []).append(key)
            rows = []
            for i, b in enumerate(bins):
                offset = 0
                for size in b:
                    key = of_length[size].pop()
                    rows.append((key, size, i, offset, i >= len(bins) - up, deme))
                    offset += size
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
                pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.int64()))],
                names=["key", "length", "bin", "offset", "up", "deme"])


def migrated(islands: DataFrame, count: int) -> DataFrame:
    """Every island's elite also joins the population of the next island of its deme."""
    elite = islands.select(
        "deme", ((F.col("island") + 1) % count).cast("int").alias("island"),
        F.slice("population", 1, 1).alias("guest"))
    return islands.join(elite, ["deme", "island"]).withColumn(
        "population", F.array_distinct(F.concat("population", "guest"))).select(islands.columns)


def packed_demes(lengths: DataFrame, demes: int, capacity: int, islands: int, epochs: int,
                 generations: int) -> DataFrame:
    """Best grouping of each deme of a table of ``key`` and ``length``."""
    dealt = lengths.groupBy(F.pmod(F.xxhash64("key"), F.lit(demes)).alias("deme")).agg(
        F.sort_array(F.collect_list(F.struct("key", "length"))).alias("rows"))
    state = dealt.select(
        "deme", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"),
        F.col("rows.key").alias("keys"), F.col("rows.length").cast("array<int>").alias("lengths"),
        F.array().cast("array<binary>").alias("population"))
    # The sizes of rows say little about their cost, so each task gets its share of islands.
    tasks = max(1, min(demes * islands, lengths.sparkSession.sparkContext.defaultParallelism * 4))
    settled: list[DataFrame] = []
    for epoch in range(epochs):
        work = state.repartition(tasks, "deme", "island").mapInArrow(
            lambda b, e=epoch: _islands(b, capacity, e, generations), ISLAND)
        state = staged(work, f"epoch-{epoch}")
        rested = state.groupBy("deme").agg(F.max("done").alias("rest"))
        both = state.join(rested, "deme")
        settled.append(both.where("rest").drop("rest") if epoch < epochs - 1 else state)
        state = both.where(~F.col("rest")).drop("rest")
        if epoch < epochs - 1:
            if state.isEmpty():
                break
            state = migrated(state, islands).drop("bins", "done")
    best = settled[0]
    for more in settled[1:]:
        best = best.unionByName(more)
    return best.groupBy("deme").agg(F.min_by(
        F.struct("keys", "lengths", F.element_at("population", 1).alias("elite")),
        F.struct("bins", "island")).alias("best")).select("deme", "best.*")


def group(lengths: DataFrame, capacity: int = CAPACITY, deme_pieces: int = DEME_PIECES,
          islands: int = ISLANDS, epochs: int = EPOCHS,
          generations: int = GENERATIONS) -> DataFrame:
    """``sequence_id`` and ``offset`` of every row of a table of unique ``key`` and ``length``, all
    of them from 1 to the capacity. The table is read several times, so it should be staged."""
    full = lengths.where(F.col("length") == capacity).select(
        "key", (F.col("key") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    open_rows, level = lengths.where(F.col("length") < capacity).select("key", "length"), 0
    out = full
    while True:
        demes = -(-open_rows.count() // deme_pieces)
        if not demes:
            return out
        best = packed_demes(open_rows, demes, capacity, islands, epochs, generations)
        placed = staged(best.select("deme", "keys", "lengths", "elite").mapInArrow(
            lambda b, up=demes > 1: _placed(b, up), PLACED), f"level-{level}")
        # Even numbers are full pieces, odd ones a level, a deme in it, and a bin of the deme.
        number = ((F.lit(level << 32).cast("long") + F.col("deme")) * (1 << 16) + F.col("bin"))
        out = out.unionByName(placed.where(~F.col("up")).select(
            "key", (number * 2 + 1).alias("sequence_id"), "offset"))
        open_rows, level = placed.where("up").select("key", "length"), level + 1


def _pieces(batches: Iterator[pa.RecordBatch], path: str, end_id: int, capacity: int,
            drops_white: bool) -> Iterator[pa.RecordBatch]:
    key = TaskContext.get().partitionId() << 33
    end = np.array([end_id], "<u4").tobytes()
    names = ["key", "doc_id", "piece", "start", "length", "ids", "ids_crc32"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
    for batch in batches:
        for part in slices(batch, most=ENCODE_BYTES):
            rows: list[tuple] = []
            encoded = file_encoder(path, drops_white).encode(part.column(0))
            for doc_id, ids in zip(part.column(1).to_pylist(), encoded):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[at:at + 4 * capacity]
                    rows.append((key, doc_id, piece, at // 4, len(cut) // 4, cut, zlib.crc32(cut)))
                    key += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, end_id: int = 0,
           drops_white: bool = True) -> DataFrame:
    """Documents as pieces of at most ``capacity`` ids (binary, little-endian unsigned 32-bit)."""
    path = path or public_tokenizers.path("word_bpe_49k.json")
    source = docs.select(F.col("text").alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    return source.mapInArrow(lambda b: _pieces(b, path, end_id, capacity, drops_white), PIECE)


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, end_id: int = 0,
         drops_white: bool = True, **search: int) -> DataFrame:
    """Every piece with its ids, their CRC, and its place: ``sequence_id`` and ``offset``."""
    cut = staged(pieces(docs, capacity, path, end_id, drops_white), "best-fit-pieces")
    return cut.join(group(cut.select("key", "length"), capacity, **search), "key").drop("key")


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: its ids and their number."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    ids = F.aggregate("parts", F.lit(b""), lambda done, x: F.concat(done, x["ids"]))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", ids.alias("ids")).withColumn(
        "n_tokens", F.expr("octet_length(ids) div 4"))


def best_fit_pieces(docs: DataFrame) -> DataFrame:
    """Query op13: the place of every piece of every document."""
    return pack(docs).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
