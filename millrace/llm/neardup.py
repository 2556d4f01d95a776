"""Near duplicates by an inverted join over MinHash signature coordinates.

1. A text's set of word shingles is hashed. Documents with equal sets form a class, and only one
   of each class goes on.
2. A signature has ``COORDINATES`` minima. Classes are posted under each pair of coordinate and
   value, and the postings are counted. Two sets of the wanted similarity agree in at least
   ``MATCHES`` coordinates (the chance of fewer, at a similarity of 0.8, is about 4 in a million).
   So a class with fewer shared postings has no partner, and a pair that agrees often enough also
   meets in the rarest ``shared - MATCHES + 1`` postings of each side: the long lists are skipped.
3. Every list links its members to the one whose postings are longest, the centre of a group of
   near copies; of those centres a class keeps the one it agrees with most, so that this round
   makes at most one pair per class. Confirmed links are contracted to components.
4. At last, lists that still hold several components name the classes that may have partners left.
   These are posted again, under the rarest shingles of their full sets: two sets that are alike
   enough share one of the first ``size - needed + 1`` in the order of rarity, and the first one
   they share lies early enough in both that what follows can still reach the needed overlap. At first
   each meets only the member of a list that has the fewest rarer shingles, the text that a group of
   copies was changed from, and what is confirmed is contracted; then all pairs across components that
   meet this way are compared. In both, parities of hashed shingles leave out pairs that differ too much.
5. Every pair whose signatures agree often enough is confirmed on the two full sets.

Components are found by contraction rounds over the link table: each node takes the smallest node
around it, links between joined nodes vanish, and the rest go on.

Defined results: null text, empty text and text of white space have no shingles and link with
nothing; fewer words than a shingle make one shingle; repeated rows and equal sets are one class;
a null ``doc_id`` takes part but is never a component's smallest id unless all are null; an empty
table gives no rows. Columns in ``carry`` pass through, but for those named like a result.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import apart, fresh, over_slices, staged, text_bytes
from millrace.llm.scan import SPACES, mixed, words

COORDINATES = 48
MATCHES = 26
WORDS = 4
# The row number's column, a name that carried columns do not have.
ROW = fresh("row")
PERCENT = 80
# Words of 64 parities that a posting carries of its set.
PARITIES = 8

_random = np.random.default_rng(19)
MULTIPLIERS = _random.integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADDENDS = _random.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
PLACES = _random.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(raw: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of every row, and their rows."""
    at, (h,) = words(raw, bounds, ~SPACES)
    row = np.searchsorted(bounds, at, side="right") - 1
    n = len(h)
    if n >= width:
        whole = np.flatnonzero(row[:n - width + 1] == row[width - 1:])
        found = np.zeros(len(whole), np.uint64)
        for k in range(width):
            found += h[whole + k] * PLACES[k]
        found, of = mixed(found), row[whole]
    else:
        found, of = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    count = np.bincount(row, minlength=len(bounds) - 1)
    few = np.flatnonzero((count > 0) & (count < width))
    if len(few):
        # Fewer words than a shingle: all of them, and how many they are, make one.
        first = np.searchsorted(row, few)
        total = np.zeros(len(few), np.uint64)
        for k in range(width - 1):
            some = count[few] > k
            total[some] += h[first[some] + k] * PLACES[k]
        total += count[few].astype(np.uint64) * PLACES[width]
        found, of = np.append(found, mixed(total)), np.append(of, few)
    order = np.lexsort((found, of))
    found, of = found[order], of[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (of[1:] != of[:-1])
    return found[new], of[new]


def _digests(found: np.ndarray, edges: np.ndarray) -> list[bytes]:
    return [hashlib.md5(found[a:b].tobytes(), usedforsecurity=False).digest()
            for a, b in zip(edges[:-1], edges[1:])]


def postings(found: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """One 64-bit token per row and coordinate: which coordinate it is, and the value there."""
    out = np.empty((len(edges) - 1, COORDINATES), np.uint64)
    for k in range(COORDINATES):
        out[:, k] = np.minimum.reduceat(found * MULTIPLIERS[k] + ADDENDS[k], edges[:-1])
    return mixed(out + np.arange(1, COORDINATES + 1, dtype=np.uint64) * PLACES[40])


def signatures(docs: DataFrame, width: int = WORDS, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns, ``n_shingles``, ``set_key`` (null without shingles) and ``tokens``."""
    source = docs.select(F.col("text").alias(fresh("text")), *apart(carry, "n_shingles", "set_key", "tokens"))
    fields = [*source.schema.fields[1:], T.StructField("n_shingles", T.LongType()),
              T.StructField("set_key", T.BinaryType()),
              T.StructField("tokens", T.ArrayType(T.LongType()))]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw, bounds = text_bytes(batch.column(0))
        rows = batch.num_rows
        found, of = shingles(raw, bounds, width)
        count = np.bincount(of, minlength=rows)
        some = np.flatnonzero(count)
        keys: list[bytes | None] = [None] * rows
        tokens: list[np.ndarray | None] = [None] * rows
        if len(some):
            edges = np.append(np.flatnonzero(np.append(True, of[1:] != of[:-1])), len(of))
            table = postings(found, edges).view(np.int64)
            for i, r in enumerate(some.tolist()):
                tokens[r] = table[i]
            for r, key in zip(some.tolist(), _digests(found, edges)):
                keys[r] = key
        return pa.RecordBatch.from_arrays([
            *batch.columns[1:], pa.array(count, pa.int64()), pa.array(keys, pa.binary()),
            pa.array(tokens, pa.list_(pa.int64()))], names=[f.name for f in fields])

    return source.mapInArrow(over_slices(work), T.StructType(fields))


def full_sets(docs: DataFrame, width: int) -> DataFrame:
    """``set_key`` and the whole ``hashes`` of each row's shingle set."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw, bounds = text_bytes(batch.column(0))
        found, of = shingles(raw, bounds, width)
        edges = np.append(np.flatnonzero(np.append(True, of[1:] != of[:-1])), len(of)) \
            if len(of) else np.zeros(1, np.int64)
        return pa.RecordBatch.from_arrays([
            pa.array(_digests(found, edges), pa.binary()),
            pa.ListArray.from_arrays(
                pa.array(edges, pa.int32()), pa.array(found.view(np.int64), pa.int64()))
        ], names=["set_key", "hashes"])

    return docs.select(F.col("text").alias("text")).mapInArrow(
        over_slices(work), "set_key binary, hashes array<long>")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node of links ``a``, ``b``."""
    edges = staged(links.select("a", "b"), "links")
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    member = staged(nodes.select("node", F.col("node").alias("component")), "members")
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = staged(both.groupBy("a").agg(F.min("b").alias("low")).select(
            F.col("a").alias("child"), F.least("a", "low").alias("parent")), "parents")
        member = staged(
            member.join(parent, member["component"] == parent["child"], "left").select(
                "node", F.coalesce("parent", "component").alias("component")), "members")
        for end in ("a", "b"):
            edges = edges.join(parent, edges[end] == parent["child"]).drop(end, "child") \
                .withColumnRenamed("parent", end)
        edges = staged(edges.where("a <> b").select("a", "b").distinct(), "links")
    return member


def _agreeing(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs whose signatures agree in enough coordinates, with that number."""
    left = reps.select(F.col("set_key").alias("a"), F.col("tokens").alias("left"))
    right = reps.select(F.col("set_key").alias("b"), F.col("tokens").alias("right"))
    return (
        pairs.join(left, "a").join(right, "b")
        .select("a", "b", F.size(F.array_intersect("left", "right")).alias("agree"))
        .where(F.col("agree") >= MATCHES))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough."""
    left = sets.select(F.col("set_key").alias("a"), F.col("hashes").alias("left"))
    right = sets.select(F.col("set_key").alias("b"), F.col("hashes").alias("right"))
    both = F.size(F.array_intersect("left", "right"))
    either = F.size("left") + F.size("right") - F.col("both")
    return (
        pairs.select("a", "b").join(right, "b").join(left, "a")
        .select("a", "b", "left", "right", both.alias("both"))
        .where(F.col("both") * 100 >= either * percent).select("a", "b"))


def _closest(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Of each ``b`` the pair that agrees most."""
    return staged(_agreeing(pairs, reps).groupBy("b").agg(
        F.max(F.struct("agree", "a"))["a"].alias("a")).select("a", "b"), "closest")


def _components_of(posted: DataFrame, joined: DataFrame) -> DataFrame:
    """Postings with the component of each class; one without a link is its own."""
    return posted.join(joined.withColumnRenamed("node", "set_key"), "set_key", "left").withColumn(
        "component", F.coalesce("component", "set_key"))


def _open_lists(placed: DataFrame) -> DataFrame:
    """Tokens of the lists that hold more than one component, and the largest one in each."""
    sizes = placed.groupBy("token", "component").agg(F.count("*").alias("size"))
    return sizes.groupBy("token").agg(
        F.count("*").alias("several"), F.max(F.struct("size", "component"))["component"].alias("main")
    ).where("several > 1").drop("several")


def _fits(percent: int):
    """Sets of too different sizes cannot be similar enough."""
    return (F.least("n", "other_n") * 100 >= F.greatest("n", "other_n") * percent)


def _parities() -> list[Column]:
    """For each of ``64 * PARITIES`` places the parity of a set's shingles that fall there."""
    place = F.call_function(
        "shiftleft", F.lit(1).cast("long"), F.shiftright("token", 3).bitwiseAND(63).cast("int"))
    word = F.col("token").bitwiseAND(PARITIES - 1)
    return [F.bit_xor(F.when(word == j, place).otherwise(F.lit(0).cast("long"))) for j in range(PARITIES)]


def _can_link(percent: int) -> Column:
    """Whether two postings of a list may be of similar sets: by size, place and parities.

    No similar pair is lost in the first list it shares: what follows there must hold the needed
    overlap. Each place whose parity differs has a shingle that only one of the sets has.
    """
    total = F.col("n") + F.col("other_n")
    left = F.least(F.col("n") - F.col("at"), F.col("other_n") - F.col("other_at"))
    differ = reduce(add, (F.bit_count(F.get("odd", j).bitwiseXOR(F.get("other_odd", j)))
                          for j in range(PARITIES)))
    # With at least total * percent / (100 + percent) in common, all but twice that may differ.
    return _fits(percent) & (left * (100 + percent) >= total * percent) & (
        differ * (100 + percent) <= total * (100 - percent))


def _rare_postings(sets: DataFrame, percent: int) -> DataFrame:
    """Each set's rarest shingles: as many as one of them must be shared with any partner.

    ``token``, ``set_key``, the set's size ``n`` and parities ``odd``, and the shingle's place ``at`` in
    the order of rarity. Shingles that only one set has are placed but not posted.
    """
    each = sets.select("set_key", F.explode("hashes").alias("token"))
    known = each.groupBy("token").agg(F.count("*").alias("long"))
    ranked = each.join(known, "token").groupBy("set_key").agg(
        F.sort_array(F.collect_list(F.struct("long", "token"))).alias("ranked"),
        *[p.alias(f"odd_{j}") for j, p in enumerate(_parities())])
    n = F.size("ranked")
    first = n - F.ceil(n * percent / F.lit(100)).cast("int") + 1
    return ranked.select(
        "set_key", n.alias("n"), F.array(*[f"odd_{j}" for j in range(PARITIES)]).alias("odd"),
        F.posexplode(F.slice("ranked", F.lit(1), first)).alias("at", "x")
    ).where("x.long > 1").select(F.col("x.token").alias("token"), "set_key", "n", "odd", "at")


def _others(members: DataFrame) -> DataFrame:
    """Postings as the other side of a pair."""
    return members.select(
        F.col("token").alias("other_token"), F.col("set_key").alias("other_key"), F.col("n").alias("other_n"),
        F.col("odd").alias("other_odd"), F.col("at").alias("other_at"), F.col("component").alias("other"))


def _across(members: DataFrame, others: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes of different components that share a list and may be similar."""
    met = members.join(others, (F.col("token") == F.col("other_token")) & (
        F.col("component") != F.col("other")) & _can_link(percent))
    return met.select(
        F.least("set_key", "other_key").alias("a"), F.greatest("set_key", "other_key").alias("b")
    ).distinct()


def _core_meetings(posted: DataFrame, joined: DataFrame, percent: int) -> DataFrame:
    """Pairs of each class with the member of a list that has the fewest rarer shingles.

    A group's changed copies have more of them than the text they come from, so most of a group that
    can be linked is linked by one pair for each posting at most.
    """
    placed = _components_of(posted, joined)
    core = placed.groupBy("token").agg(F.min(F.struct("at", "set_key", "n", "odd", "component")).alias("core"))
    return _across(placed, _others(core.select("token", "core.*")), percent)


def _meetings(posted: DataFrame, joined: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes of different components that meet in a list early enough.

    All that are outside a list's largest component meet all others of the list.
    """
    placed = staged(_components_of(posted, joined), "rare")
    lists = _open_lists(placed)
    inside = placed.join(lists, "token")
    outside = inside.where(F.col("component") != F.col("main")).drop("main")
    return _across(outside, _others(inside), percent)


def near_duplicates(docs: DataFrame, width: int = WORDS, percent: int = PERCENT,
                    carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: ``doc_id``, carried columns, ``n_shingles``, ``component_id``, ``kept``, ``single``.

    Links join texts whose sets have a Jaccard similarity of at least ``percent`` in a hundred.
    ``kept`` marks rows with the smallest id of their component; ``single`` marks one row of each
    component, also where rows are repeated.
    """
    carry = apart(carry, "doc_id", "n_shingles", "set_key", "tokens", "component_id", "kept", "single", "first")
    # Row numbers are written with the rows, so later stages see the same ones.
    signed = staged(signatures(docs, width, ("doc_id", *carry)).withColumn(
        ROW, F.monotonically_increasing_id()), "signatures")
    slim = signed.drop("tokens")
    place = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", F.col(ROW).alias("row"))
    reps = staged(signed.where("set_key is not null").groupBy("set_key").agg(
        F.min(place).alias("least"), F.first("n_shingles").alias("n"),
        F.first("tokens").alias("tokens")), "classes")

    posted = reps.select("set_key", F.explode("tokens").alias("token"))
    shared = posted.groupBy("token").agg(F.count("*").alias("long")).where("long > 1")
    lists = posted.join(shared, "token").groupBy("set_key").agg(
        F.sort_array(F.collect_list(F.struct("long", "token"))).alias("found"),
        F.sum("long").alias("mass")).where(F.size("found") >= MATCHES)
    rare = F.slice("found", F.lit(1), F.size("found") - MATCHES + 1)
    prefix = staged(
        lists.select("set_key", "mass", F.explode(rare["token"]).alias("token"))
        .join(reps.select("set_key", "n"), "set_key"), "prefix")

    wanted = prefix.select("set_key").distinct().join(reps, "set_key").select(
        F.col("least.doc_id").alias("doc_id"), "set_key")
    texts = docs.select("doc_id", "text").join(
        wanted.select("doc_id").distinct(), docs["doc_id"].eqNullSafe(wanted["doc_id"]), "left_semi")
    sets = staged(
        full_sets(texts, width).join(wanted.select("set_key"), "set_key", "left_semi")
        .dropDuplicates(["set_key"]), "sets", "none")

    centre = prefix.groupBy("token").agg(
        F.max(F.struct("mass", "set_key", "n")).alias("top")).select(
        "token", F.col("top.set_key").alias("a"), F.col("top.n").alias("other_n"))
    star = prefix.join(centre, "token").where(F.col("a") != F.col("set_key")).where(_fits(percent))
    star = star.select("a", F.col("set_key").alias("b")).distinct()
    closest = _closest(star, reps)
    links = staged(_confirmed(closest, sets, percent), "links")
    joined = components(links)

    placed = _components_of(prefix, joined)
    left_over = placed.join(_open_lists(placed), "token").select("set_key").distinct()
    posted = staged(_rare_postings(sets.join(left_over, "set_key", "left_semi"), percent), "rarest")
    for meet in (_core_meetings, _meetings):
        found = _confirmed(_agreeing(meet(posted, joined, percent), reps), sets, percent)
        links = staged(links.unionByName(found), "links")
        joined = components(links)

    of_class = reps.select("set_key", "least").join(
        joined.withColumnRenamed("node", "set_key"), "set_key", "left").select(
        "set_key", "least", F.coalesce("component", "set_key").alias("component"))
    least = of_class.groupBy("component").agg(F.min("least").alias("first"))
    found = of_class.join(least, "component").select("set_key", "first")
    alone = F.col("set_key").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id"))
    return slim.join(found, "set_key", "left").select(
        "doc_id", *carry, "n_shingles", component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
        (alone | (F.col(ROW) == F.col("first.row"))).alias("single"))


def linked_documents(docs: DataFrame) -> DataFrame:
    """Query op7: the component of every document."""
    return near_duplicates(docs).drop("single")
