"""Order MinHash fingerprints: like MinHash, but sensitive to the order of a text's parts.

A text is a sequence of tokens (runs of non-blank characters, cut after ``TOKEN_CHARS``). Every
k-mer of tokens is numbered by its occurrence, so repeats count. The ``SKETCH`` numbered k-mers
with the smallest hashes are selected; each of ``TUPLES`` seeds picks the two of them that are
smallest under the seed, puts them back into text order, and hashes the ordered pair. Two texts
agree in a tuple if both k-mers are selected in both and stand in the same order, which edits that
insert, delete or move text undo in proportion. The likeness of two fingerprints is the square root
of the share of equal tuples, an estimate of the k-mers that they share in order.

Everything is built-in functions on arrays within a row; texts move once, to stand next to their
neighbour in ``doc_id`` order, in buckets cut at quantiles of the ids.

Defined results: null text counts as empty; a text with fewer tokens than a k-mer has one k-mer, an
empty one none, and texts without any are alike; positions beyond 2**24 tokens count as equal;
repeated rows get equal fingerprints, and rows with an equal ``doc_id`` stand in the order of a hash
of their text, nulls last; the last document is followed by the first, a single one by itself; an
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KMER = 3
TOKEN_CHARS = 16
SKETCH = 64
TUPLES = 48
# A packed number has a hash in its upper 40 bits and a position in its lower 24.
POSITION = (1 << 24) - 1


def with_tuples(df: DataFrame, text: str, out: str) -> DataFrame:
    """The frame with ``out``, the tuple hashes of a text column, as an array of ``TUPLES``."""
    p = out
    keep = [c for c in df.columns if c != out]
    df = df.withColumn(f"{p}_w", F.expr(
        f"transform(regexp_extract_all({text}, '\\\\S{{1,{TOKEN_CHARS}}}', 0), x -> xxhash64(x))"))
    whole = f"size({p}_w)"
    ahead = ", ".join(f"get({p}_w, i + {j})" for j in range(1, KMER))
    df = df.withColumn(f"{p}_k", F.expr(
        f"case when {whole} >= {KMER} then transform(slice({p}_w, 1, {whole} - {KMER - 1}), "
        f"(x, i) -> (xxhash64(x, {ahead}) & {~POSITION}L) | least(i, {POSITION})) "
        f"when {whole} > 0 then array(xxhash64({p}_w) & {~POSITION}L) "
        f"else cast(array() as array<bigint>) end"))
    df = df.withColumn(f"{p}_s", F.sort_array(f"{p}_k"))
    # Where a run of equal k-mers begins.
    df = df.withColumn(f"{p}_r", F.expr(
        f"filter(transform({p}_s, (x, i) -> if(i > 0 and shiftright(x, 24) = "
        f"shiftright(get({p}_s, i - 1), 24), -1, i)), i -> i >= 0)"))
    mark = f"& {~POSITION}L) | (x & {POSITION}L)"
    df = df.withColumn(f"{p}_o", F.sort_array(F.expr(
        f"case when size({p}_r) = size({p}_s) then "
        f"transform({p}_s, x -> (xxhash64(shiftright(x, 24), 0) {mark}) else "
        f"flatten(transform({p}_r, (b, n) -> transform("
        f"slice({p}_s, b + 1, coalesce(get({p}_r, n + 1), size({p}_s)) - b), "
        f"(x, j) -> (xxhash64(shiftright(x, 24), j) {mark}))) end")))
    df = df.withColumn(f"{p}_b", F.slice(f"{p}_o", 1, SKETCH))
    pair = (
        f"transform(array(array_min(y)), m -> transform(array(array_min(array_remove(y, m))), n -> "
        f"if(n is null or (m & {POSITION}L) < (n & {POSITION}L), "
        f"xxhash64(shiftright(m, 24), shiftright(n, 24)), "
        f"xxhash64(shiftright(n, 24), shiftright(m, 24))))[0])[0]")
    # The sketch is named twice, so the optimizer computes it once and not for every seed.
    df = df.withColumn(p, F.expr(
        f"case when size({p}_b) = 0 then array_repeat(0L, {TUPLES}) else "
        f"transform(sequence(0, {TUPLES - 1}), r -> transform(array(transform({p}_b, "
        f"x -> (xxhash64(shiftright(x, 24), r) {mark})), y -> {pair})[0]) end"))
    return df.select(*keep, p)


def fingerprint(tuples: str) -> Column:
    """The tuples as one string, eight hexadecimal digits each."""
    return F.array_join(F.transform(
        tuples, lambda x: F.lpad(F.lower(F.hex(x.bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def likeness(a: str, b: str) -> Column:
    """Square root of the share of equal tuples of two fingerprints."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x))
    return F.sqrt(same / F.lit(float(TUPLES)))


def with_next(docs: DataFrame, carry: tuple[str, ...], buckets: int | None = None) -> DataFrame:
    """Each row with ``next_<c>`` of the row that follows in descending ``doc_id``, in a ring."""
    spark = docs.sparkSession
    buckets = buckets or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / buckets for i in range(1, buckets)]
    found = docs.agg(F.percentile_approx("doc_id", shares, 10 * buckets)).first()[0] if shares else []
    cuts = sorted(set(found or []))
    ladder = F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>")
    missing = F.col("doc_id").isNull()
    bucket = F.when(missing, F.lit(len(cuts) + 1)).otherwise(
        F.size(F.filter(ladder, lambda c: F.col("doc_id") < c)))
    # One number per bucket: the id it begins with, and the bucket that comes before it.
    first = dict(docs.select("doc_id", bucket.alias("b")).groupBy("b").agg(F.max("doc_id")).collect())
    order = sorted(first)
    before = {b: order[i - 1] for i, b in enumerate(order)}
    every = range(len(cuts) + 2)
    first_of = F.get(F.array(*[F.lit(first.get(b)).cast("bigint") for b in every]), F.col("_b"))
    before_of = F.get(F.array(*[F.lit(before.get(b)).cast("int") for b in every]), F.col("_b"))
    own = F.struct(F.col("_b").alias("b"), F.lit(False).alias("guest"))
    guest = F.struct(before_of.alias("b"), F.lit(True).alias("guest"))
    # The first row of a bucket also ends the bucket before it.
    spread = docs.withColumn("_b", bucket).select(
        *docs.columns, F.inline(F.when(F.col("doc_id").eqNullSafe(first_of), F.array(own, guest))
                                .otherwise(F.array(own))))
    line = Window.partitionBy("b").orderBy("guest", F.desc_nulls_last("doc_id"), "tie")
    return spread.select(
        "*", *[F.lead(c).over(line).alias(f"next_{c}") for c in carry]).where("not guest").drop(
        "b", "guest")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, its ``tuples`` and ``fingerprint`` of every row."""
    plain = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return with_tuples(plain, "text", "tuples").withColumn("fingerprint", fingerprint("tuples"))


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Query op1: fingerprints of every text and of its edited text."""
    own = fingerprints(docs).drop("fingerprint").withColumn("tie", F.xxhash64("text"))
    pairs = with_next(own, ("text", "tuples"))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half),
                      F.substring(F.col("next_text"), F.lit(1), half))
    pairs = pairs.select("doc_id", n.cast("long").alias("n_chars"), "tuples", "next_tuples",
                         edited.alias("edited"))
    pairs = with_tuples(pairs, "edited", "edited_tuples")
    return pairs.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint("tuples").alias("fingerprint"),
        fingerprint("edited_tuples").alias("edited_fingerprint"),
        likeness("tuples", "edited_tuples").alias("near_edited"),
        likeness("tuples", "next_tuples").alias("near_next"))
