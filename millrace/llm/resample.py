"""Importance resampling of documents towards the word distribution of a target table.

A regular-expression ``Split`` of the tokenizers library, which has nothing to train, cuts each
ASCII-lowered text into words with their offsets. No word holds a blank, so a text is first cut at
its blanks and each distinct stretch goes to the library once; a word's offsets are those of its
stretch plus those in it. The words of a text, joined by one blank, form a line; a feature is a
window of this line from the start offset of one word to the end offset of another one, and its
CRC picks a bucket. Bucket counts of both tables give the gain of a bucket, a document's weight is
the floored mean of the gains of its features, and a Gumbel number made from its id turns the
highest sums into a draw without replacement.

Texts are read once: the bucket counts of each document are written to the shared folder, then
summed and weighed. Only tables bounded by parameters are gathered: one row per bucket, and one per
distinct score when the limit of the draw is looked up. Scores lie between floors of logarithms, so
there are some tens of thousands of them at any size. Drawn rows are numbered within ranges of their
order, which also parts rows of equal score and id.

Defined results: null text has no words; a document without features has weight 0; a null
``doc_id`` counts as an empty text in the Gumbel number and comes after all ids among ties; repeated rows
count, and are drawn, as often as they occur, in any order among themselves; an empty table gives
an empty table, and an empty target counts no features; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import SLICE_BYTES, slices, staged

# Digits, small letters, and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
MOST_WORDS = 1
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
# Stretches between blanks whose words one worker keeps, and the longest that is kept.
CACHE_STRETCHES = 300_000
CACHE_BYTES = 48
COUNTED = (
    "part int, nth long, doc_id long, n_words long, n_features long, buckets array<int>, "
    "times array<int>")
FOUND = "doc_id long, word string, start long, end long"


@lru_cache(maxsize=4)
def splitter(pattern: str):
    """The library's splitter that keeps what the pattern matches."""
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split
    return Split(Regex(pattern), "removed", invert=True)


class Words:
    """Words of an Arrow column of texts, each with its row and its offsets."""

    def __init__(self, pattern: str = WORD):
        self.pattern = pattern
        self.known: dict[bytes, list[tuple[str, int, int]]] = {}

    def _of(self, stretch: bytes) -> list[tuple[str, int, int]]:
        """Words of one stretch; offsets are code points."""
        found = self.known.get(stretch)
        if found is None:
            cut = splitter(self.pattern).pre_tokenize_str(stretch.decode())
            found = [(word, a, b) for word, (a, b) in cut]
            if len(self.known) < CACHE_STRETCHES and len(stretch) <= CACHE_BYTES:
                self.known[stretch] = found
        return found

    def find(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, pa.Array]:
        """Distinct words, then for all words in text order: which one, its row, its offset pair."""
        parts = pc.split_pattern(pc.ascii_lower(texts.fill_null("")), " ")
        bounds = parts.offsets.to_numpy()
        coded = parts.flatten().dictionary_encode()
        found = [self._of(s.encode()) for s in coded.dictionary.to_pylist()]
        code: dict[str, int] = {}
        flat = [code.setdefault(word, len(code)) for words in found for word, _, _ in words]
        inside = np.array([(a, b) for words in found for _, a, b in words], np.int64).reshape(-1, 2)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        first = np.cumsum(sizes) - sizes
        kind = coded.indices.to_numpy(zero_copy_only=False)
        n = sizes[kind]
        upto = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
        at = np.repeat(first[kind] - upto[:-1], n) + np.arange(upto[-1])
        rows = np.repeat(np.arange(len(texts)), np.diff(bounds))
        # Every text has a stretch at least; each is followed by one blank.
        length = pc.utf8_length(coded.dictionary).to_numpy(zero_copy_only=False)[kind] + 1
        begin = np.cumsum(length) - length
        begin = begin - begin[bounds[:-1]][rows]
        offsets = inside[at] + np.repeat(begin, n)[:, None]
        return list(code), np.array(flat, np.int64)[at], np.repeat(rows, n), offsets


def windows(names: list[str], word: np.ndarray, row: np.ndarray, width: int,
            buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every run of ``width`` words of a row."""
    if width == 1:
        crc = np.fromiter((zlib.crc32(w.encode()) for w in names), np.int64, len(names))
        return row, (crc % buckets)[word] if len(names) else word
    raw = [w.encode() for w in names]
    line = memoryview(b" ".join([raw[i] for i in word.tolist()]))
    sizes = np.array([len(r) for r in raw], np.int64)[word] if raw else word
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    runs = max(len(word) - width + 1, 0)
    same = row[:runs] == row[width - 1:]
    pairs = zip(starts[:runs][same].tolist(), ends[width - 1:][same].tolist())
    crc = np.fromiter((zlib.crc32(line[a:b]) for a, b in pairs), np.int64, int(same.sum()))
    return row[:runs][same], crc % buckets


def _counted(batches: Iterator[pa.RecordBatch], pattern: str, most_words: int,
             buckets: int) -> Iterator[pa.RecordBatch]:
    part, done, reader = TaskContext.get().partitionId(), 0, Words(pattern)
    for batch in batches:
        for piece in slices(batch, most=SLICE_BYTES):
            rows = piece.num_rows
            names, word, row, _ = reader.find(piece.column(0))
            found = [windows(names, word, row, k, buckets) for k in range(1, most_words + 1)]
            key = np.concatenate([r * buckets + b for r, b in found])
            kind, times = np.unique(key, return_counts=True)
            cuts = np.searchsorted(kind, np.arange(rows + 1) * buckets).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(rows, part, np.int32)),
                pa.array(np.arange(done, done + rows)),
                piece.column(1),
                pa.array(np.bincount(row, minlength=rows).astype(np.int64)),
                pa.array(np.bincount(key // buckets, minlength=rows).astype(np.int64)),
                pa.ListArray.from_arrays(cuts, pa.array((kind % buckets).astype(np.int32))),
                pa.ListArray.from_arrays(cuts, pa.array(times.astype(np.int32))),
            ], names=["part", "nth", "doc_id", "n_words", "n_features", "buckets", "times"])
            done += rows


def counted(docs: DataFrame, most_words: int = MOST_WORDS, buckets: int = BUCKETS,
            pattern: str = WORD) -> DataFrame:
    """Per document its numbers of words and features, and how many features each bucket holds."""
    key = F.col("doc_id").cast("long") if "doc_id" in docs.columns else F.lit(None).cast("long")
    source = docs.select(F.col("text").alias("text"), key.alias("doc_id"))
    return source.mapInArrow(lambda b: _counted(b, pattern, most_words, buckets), COUNTED)


def found_words(docs: DataFrame, pattern: str = WORD) -> DataFrame:
    """One row per word of every document: ``word`` and its code points ``start`` to ``end``."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Words(pattern)
        for batch in batches:
            for piece in slices(batch, most=SLICE_BYTES):
                names, word, row, offsets = reader.find(piece.column(0))
                yield pa.RecordBatch.from_arrays([
                    piece.column(1).take(pa.array(row)),
                    pa.array(names, pa.string()).take(pa.array(word)),
                    pa.array(offsets[:, 0]), pa.array(offsets[:, 1]),
                ], names=["doc_id", "word", "start", "end"])

    source = docs.select(
        F.col("text").alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    return source.mapInArrow(work, FOUND)


def bucket_counts(features: DataFrame) -> DataFrame:
    """Features in each bucket over all documents; at most one row per bucket."""
    pairs = features.select(F.inline(F.arrays_zip("buckets", "times")))
    return pairs.groupBy(F.col("buckets").alias("bucket")).agg(F.sum("times").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row, ``gain``: for every bucket the floored logarithm of how much likelier the target
    makes it."""
    both = (
        raw.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
        .join(raw.withColumnRenamed("n", "s"), "bucket", "left")
        .join(target.withColumnRenamed("n", "t"), "bucket", "left")
        .select("bucket", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("s", "t")])
        .withColumns({f"all_{c}": F.sum(c).over(Window.partitionBy()) for c in ("s", "t")}))
    ratio = (
        (F.col("t") + 1.0) * (F.col("all_s") + float(buckets))
        / ((F.col("s") + 1.0) * (F.col("all_t") + float(buckets))))
    gain = F.floor(F.lit(1000.0) * F.log(ratio))
    in_order = F.sort_array(F.collect_list(F.struct("bucket", gain.alias("gain"))))
    return both.agg(F.transform(in_order, lambda x: x["gain"]).alias("gain"))


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Floored thousandths of a Gumbel number that depends on the id and the seed alone."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def weighed(features: DataFrame, gain: DataFrame, seed: int = SEED) -> DataFrame:
    """``weight`` and ``score`` of counted documents; ``gain`` is one row of one number per bucket."""
    summed = F.aggregate(
        F.zip_with("buckets", "times", lambda b, n: F.get("gain", b) * n),
        F.lit(0).cast("long"), lambda done, x: done + x)
    whole = features.crossJoin(F.broadcast(gain)).select(
        "part", "nth", "doc_id", "n_words", "n_features", summed.alias("sum"))
    n = F.col("n_features")
    weight = F.when(n > 0, F.expr("(sum - pmod(sum, n_features)) div n_features")).otherwise(0)
    return whole.withColumn("weight", weight).drop("sum").withColumn(
        "score", F.col("weight") + gumbel(F.col("doc_id"), seed))


def drawn(scored: DataFrame, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """``rank`` from 1 of the highest scores among documents of enough words, null elsewhere.

    ``scored`` is read several times, so it should be staged; ``part`` and ``nth`` are unique.
    """
    enough = F.col("n_words") >= least_words
    levels = scored.where(enough).groupBy("score").agg(F.count("*").alias("n"))
    down = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    steps = levels.select(
        "score", "n", F.sum("n").over(down).alias("upto"),
        F.sum("n").over(Window.partitionBy()).alias("all"))
    wanted = F.expr(f"{percent} * all div 100")
    last = steps.where(F.col("upto") - F.col("n") < wanted).agg(
        F.min("score").alias("least"), F.max(wanted).alias("wanted")).first()
    least, wanted = last["least"], last["wanted"] or 0
    reached = enough & (F.col("score") >= F.lit(least)) if wanted else F.lit(False)
    columns = ["doc_id", "n_features", "weight", "score"]
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("part"), F.asc("nth")]
    ranges = staged(
        scored.where(reached).repartitionByRange(*order).sortWithinPartitions(*order).select(
            *columns, F.spark_partition_id().alias("range"),
            F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("at")), "drawn")
    upto = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    bases = ranges.groupBy("range").agg(F.count("*").alias("n")).select(
        "range", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("base"))
    rank = F.col("base") + F.col("at") + 1
    ranked = ranges.join(bases, "range").select(
        *columns, F.when(rank <= wanted, rank).alias("rank"))
    return ranked.unionByName(scored.where(~F.coalesce(reached, F.lit(False))).select(
        *columns, F.lit(None).cast("long").alias("rank")))


def resample(docs: DataFrame, target: DataFrame, most_words: int = MOST_WORDS,
             buckets: int = BUCKETS, seed: int = SEED, least_words: int = LEAST_WORDS,
             percent: int = PERCENT) -> DataFrame:
    """Query op12: every document with its weight, its score and its place in the draw."""
    features = staged(counted(docs, most_words, buckets), "features")
    gain = gains(
        bucket_counts(features), bucket_counts(counted(target, most_words, buckets)), buckets)
    return drawn(staged(weighed(features, gain, seed), "weights"), least_words, percent)


# The same in SQL. The CRC is taken byte by byte from its polynomial.
SQL = """
WITH RECURSIVE bits(i, k, c) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END
  FROM bits WHERE k < 8),
crcs AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
texts AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents
  UNION ALL SELECT 't', item_id, text FROM benchmark),
numbered AS (SELECT row_number() OVER () AS row, * FROM texts),
found AS (
  SELECT side, row, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM numbered),
counts AS (SELECT side, row, word, count(*) AS n FROM found GROUP BY ALL),
names AS (SELECT DISTINCT word, hex(encode(word)) AS h FROM counts),
coded AS (
  SELECT word, xor(list_reduce(
    list_transform(range(length(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)),
    lambda a, b: xor(a >> 8, t[CAST(xor(a & 255, b) + 1 AS INT)]), 4294967295), 4294967295)
    % 10000 AS bucket
  FROM names, crcs),
sums AS (
  SELECT bucket, sum(n) FILTER (side = 'd') AS s, sum(n) FILTER (side = 't') AS t
  FROM counts JOIN coded USING (word) GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (sum(s) OVER () + 10000)
    / ((coalesce(s, 0) + 1)::DOUBLE * (coalesce(sum(t) OVER (), 0) + 10000)))) AS BIGINT) AS gain
  FROM sums),
weights AS (
  SELECT row, sum(n) AS n_features, CAST(floor(sum(n * gain) / sum(n)) AS BIGINT) AS weight
  FROM counts JOIN coded USING (word) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY row),
scored AS (
  SELECT id AS doc_id, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features,
    coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
      (CAST('0x' || substr(sha256('2024:' || coalesce(id::VARCHAR, '')), 1, 8) AS BIGINT) + 0.5)
      / 4294967296.0))) AS BIGINT) AS score
  FROM numbered LEFT JOIN weights USING (row) WHERE side = 'd'),
ranks AS (
  SELECT *, n_features >= 20 AS able, row_number() OVER (
    PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
    count(*) FILTER (n_features >= 20) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score,
  CASE WHEN able AND place <= 10 * n // 100 THEN place END AS rank
FROM ranks
"""
