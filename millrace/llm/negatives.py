"""Hard negatives by shared candidate lists per cluster of anchors, walked until certified.

Anchors are parted into clusters by direction. A cluster with centre c and radius r, the widest angle
between c and a member, bounds the inner product of any member u with a candidate i by
|u| |i| cos(max(0, angle(c, i) - r)). Candidates are sorted by |i| times that cosine, once per
cluster, and this list is shared: each member walks it from the top, keeps the best scores it has
met, and stops as soon as the bound of what follows is below them, which certifies its result. Each anchor walks
twice, first among rows of its label for its positives, then among the others for negatives in the
band below each positive.

Lists are never held whole. A list is cut by bound into tiers, a few numbers per cluster found by
counting, and a tier into blocks of bounded size by a hash of the row; blocks of a tier are sorted
and walked side by side, their findings are merged per anchor, and only anchors that are not certified
go on to the next tier. The members of a cluster are cut by a hash as well, so copies of one vector, be
they anchors or candidates, are spread over tasks. Vectors are whole numbers in doubles: a
row takes part only if its squared norm is below 2**53, so by Cauchy and Schwarz every
partial sum of an inner product is exact.

Centres come from a bounded sample of anchors (``FIT_ANCHORS``); they decide where walks end,
never what is found.

Defined results: rows with a null label, a null vector, a null or non-finite component, or a squared
norm of 2**53 or more after scaling take no part; shorter vectors count as filled up with zeros; zero
vectors take part; an anchor with no other row of its label, or a positive without rows in its band,
gives no rows; repeated rows count as often as they occur, but a row with the anchor's own id is not
another row; a null id comes after all ids among ties and is no anchor; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import staged

ANCHOR_EVERY = 50
POSITIVES = 5
NEGATIVES = 3
# A negative's score lies between these hundredths of the positive's.
BAND = (50, 95)
SCALE = 256
# Anchors whose vectors the clusters are fitted on, and the number of clusters at most.
FIT_ANCHORS = 10_000
CLUSTERS = 8
ROUNDS = 8
# Candidates sorted and walked at a time, and members that walk together.
BLOCK_ROWS = 8_192
MEMBERS = 2_048
STEP = 2_048
# A tier ends at these shares of a list; bounds are counted in so many steps.
TIERS = (0.1, 0.4, 1.0)
LEVELS = 512
NO_ID = (1 << 63) - 1
EXACT = float(1 << 53)
# Beyond any score, and a hundredfold of it fits a long.
NONE = 1 << 55
FOUND = "row long, slot int, id long, score long"
NOTHING = pd.DataFrame({"row": [], "slot": [], "id": [], "score": []})
RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
    "negative_score long")


def scaled_rows(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """Rows that take part: ``row`` (unique), ``id``, ``label`` and ``v``, whole numbers as doubles."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < math.inf))
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    rows = table.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite).select(
        F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID)).alias("id"),
        F.col("label").cast("long").alias("label"), v.alias("v"))
    square = F.aggregate("v", F.lit(0.0), lambda done, x: done + x * x)
    return rows.where(square < EXACT).withColumns(
        {"norm": F.sqrt(square), "row": F.monotonically_increasing_id()})


def _matrix(vectors: pd.Series, size: int) -> np.ndarray:
    """Vectors as rows, filled up with zeros."""
    if len(vectors) and (vectors.map(len) == size).all():
        return np.stack(vectors.to_numpy())
    out = np.zeros((len(vectors), size))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def centres(anchors: DataFrame, size: int, clusters: int = CLUSTERS) -> np.ndarray:
    """Unit vectors from spherical k-means on a bounded sample of anchors."""
    sample = anchors.select("v").where("norm > 0").orderBy(F.xxhash64("row")).limit(FIT_ANCHORS)
    x = _matrix(sample.toPandas()["v"], size)
    if not len(x):
        return np.zeros((1, size))
    x = np.unique(x / np.linalg.norm(x, axis=1, keepdims=True), axis=0)
    c = x[np.linspace(0, len(x) - 1, min(clusters, len(x))).astype(int)]
    for _ in range(ROUNDS):
        nearest = np.argmax(x @ c.T, axis=1)
        total = np.zeros_like(c)
        np.add.at(total, nearest, x)
        length = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(length > 0, total / np.maximum(length, 1e-300), c)
    return c


def angles(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Angle of each row to each centre; that of a zero vector does not matter."""
    norm = np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)
    return np.arccos(np.clip(v @ c.T / norm, -1.0, 1.0))


def clustered(anchors: DataFrame, c: np.ndarray) -> DataFrame:
    """Anchors with the ``cluster`` of the nearest centre and their ``angle`` to it."""
    size = c.shape[1]

    @F.pandas_udf("cluster int, angle double")
    def nearest(vectors: pd.Series) -> pd.DataFrame:
        angle = angles(_matrix(vectors, size), c)
        at = np.argmin(angle, axis=1)
        return pd.DataFrame({"cluster": at.astype(np.int32), "angle": angle[np.arange(len(at)), at]})

    return anchors.withColumn("near", nearest("v")).select("*", "near.*").drop("near")


def bounds(c: np.ndarray, radius: dict[int, float]):
    """Column function: for each cluster in order an upper bound of the inner product with a unit
    vector of it. A relative 1e-9 makes up for rounding."""
    size, used = c.shape[1], sorted(radius)
    width = np.array([radius[k] for k in used])

    @F.pandas_udf("array<double>")
    def of(vectors: pd.Series, norms: pd.Series) -> pd.Series:
        angle = angles(_matrix(vectors, size), c[used])
        bound = norms.to_numpy()[:, None] * (np.cos(np.maximum(angle - width, 0.0)) + 1e-9)
        return pd.Series(bound.tolist())

    return of


def tiers(lists: DataFrame, top: float) -> dict[int, tuple[list[float], list[int]]]:
    """Per cluster the bounds where its tiers end, the last one open, and the tiers' rows; from one
    count of ``LEVELS`` steps per cluster. A tier takes a step whole, so it may be larger than its
    share of the list."""
    level = F.floor((F.col("bound") / top + 1) / 2 * LEVELS).cast("int")
    counts: dict[int, dict[int, int]] = {}
    for r in lists.groupBy("cluster", level.alias("level")).count().collect():
        counts.setdefault(r["cluster"], {})[r["level"]] = r["count"]
    out = {}
    for cluster, of_level in counts.items():
        total, done, edges, upto = sum(of_level.values()), 0, [], []
        for at in sorted(of_level, reverse=True):
            done += of_level[at]
            if len(edges) < len(TIERS) - 1 and done >= TIERS[len(edges)] * total:
                edges.append((at / LEVELS * 2 - 1) * top)
                upto.append(done)
        spare = len(TIERS) - len(edges)
        upto += [total] * spare
        out[cluster] = (
            edges + [-math.inf] * spare, np.diff([0, *upto]).tolist())
    return out


def _walk(members: pd.DataFrame, block: pd.DataFrame, size: int, keep: int,
          same_label: bool) -> pd.DataFrame:
    """What each slot of a member keeps of a block: its best rows.

    A slot takes scores of which a hundredfold lies between ``low`` and ``high``; ``least`` is the
    score of its last kept row so far. Members walk the block, sorted by bound, in steps, and a
    slot stops when nothing that follows can reach it.
    """
    block = block.sort_values("bound", ascending=False, kind="stable")
    v, ids = _matrix(block["v"], size), block["id"].to_numpy(np.int64)
    bound, labels = block["bound"].to_numpy(), block["label"].to_numpy(np.int64)
    member = members.drop_duplicates("row").sort_values("row")
    u, norm = _matrix(member["v"], size), member["norm"].to_numpy()
    own, own_label = member["id"].to_numpy(np.int64), member["label"].to_numpy(np.int64)
    at = np.searchsorted(member["row"].to_numpy(), members["row"].to_numpy())
    # No score above the band counts, and none below it: a hundredfold of whole numbers.
    floors = np.maximum(-(-members["low"].to_numpy(np.int64) // 100),
                        members["least"].to_numpy(np.int64))
    roofs = members["high"].to_numpy(np.int64) // 100
    kept: list[list[tuple[int, int]]] = [[] for _ in range(len(members))]
    active = np.arange(len(members))
    for begin in range(0, len(v), STEP):
        active = active[norm[at[active]] * bound[begin] >= floors[active]]
        if not len(active):
            break
        part = slice(begin, begin + STEP)
        now, place = np.unique(at[active], return_inverse=True)
        score = np.rint(u[now] @ v[part].T).astype(np.int64)
        fits = (labels[part] == own_label[now, None]) == same_label
        fits &= ids[part] != own[now, None]
        for k, i in zip(active.tolist(), place.tolist()):
            row = score[i]
            hits = np.flatnonzero(fits[i] & (row >= floors[k]) & (row <= roofs[k]))
            if len(hits) > keep:  # ties of the last place stay, so the smallest ids can win
                edge = np.partition(row[hits], len(hits) - keep)[len(hits) - keep]
                hits = hits[row[hits] >= edge]
                order = np.lexsort((ids[part][hits], -row[hits]))[:keep]
                hits = hits[order]
            if len(hits):
                more = zip((-row[hits]).tolist(), ids[part][hits].tolist())
                kept[k] = sorted([*kept[k], *more])[:keep]
                if len(kept[k]) == keep:
                    floors[k] = max(floors[k], -kept[k][-1][0])
    rows = [(r, s, i, -down) for r, s, found in zip(members["row"], members["slot"], kept)
            for down, i in found]
    return pd.DataFrame(rows, columns=["row", "slot", "id", "score"])


def best_of(found: DataFrame, keep: int) -> DataFrame:
    """``best`` of each slot: its first rows as (score negated, id). Two steps, so that no list
    holds what all blocks found."""
    def first(rows: DataFrame, *keys: str) -> DataFrame:
        listed = F.slice(F.sort_array(F.collect_list(F.struct("down", "id"))), 1, keep)
        return rows.groupBy(*keys).agg(listed.alias("best"))

    salted = found.select(
        "row", "slot", F.pmod(F.xxhash64("id"), F.lit(64)).alias("salt"),
        (-F.col("score")).alias("down"), "id")
    return first(
        first(salted, "row", "slot", "salt").select("row", "slot", F.inline("best")), "row", "slot")


class Lists:
    """The clusters' lists: bounds of all candidates, and where the tiers of each list end."""

    def __init__(self, rows: DataFrame, anchors: DataFrame, c: np.ndarray):
        self.rows, self.c = rows, c
        widest = F.coalesce(F.max(F.when(F.col("norm") > 0, F.col("angle"))), F.lit(0.0))
        members = anchors.groupBy("cluster").agg(
            widest.alias("r"), F.count("*").alias("n")).collect()
        self.parts = {m["cluster"]: math.ceil(m["n"] / MEMBERS) for m in members}
        radius = {m["cluster"]: m["r"] for m in members}
        used = F.array(*[F.lit(k) for k in sorted(radius)])
        self.listed = rows.select(
            "*", F.posexplode(bounds(c, radius)("v", "norm")).alias("at", "bound")).select(
            *rows.columns, "bound", F.get(used, "at").alias("cluster"))
        top = rows.agg(F.max("norm")).first()[0] * (1 + 1e-6) or 1.0
        self.tiers = tiers(self.listed.select("cluster", "bound"), top)

    def known(self, values: dict[int, float]) -> Column:
        """A value of the row's cluster."""
        kind = "double" if any(isinstance(v, float) for v in values.values()) else "long"
        listed = F.array(*[F.lit(values.get(k)).cast(kind) for k in range(len(self.c))])
        return F.get(listed, F.col("cluster"))

    def edge(self, tier: int) -> Column:
        return self.known({k: edges[tier] for k, (edges, _) in self.tiers.items()})

    def walk(self, slots: DataFrame, keep: int, same_label: bool) -> DataFrame:
        """``best`` of every slot that finds any row. ``slots`` has, per anchor ``row`` and
        ``slot``, the anchor's columns, its cluster, ``low`` and ``high``."""
        size, found, best = self.c.shape[1], None, None
        lane = F.col("label") if same_label else F.lit(0).cast("long")
        share = self.known(self.parts)
        open_slots = slots.withColumn("least", F.lit(-NONE).cast("long"))
        keys = ("cluster", "lane", "part", "block")
        for tier in range(len(TIERS)):
            inside = F.col("bound") >= self.edge(tier)
            if tier:
                inside &= F.col("bound") < self.edge(tier - 1)
            blocks = self.known({
                k: max(1, math.ceil(n[tier] / BLOCK_ROWS)) for k, (_, n) in self.tiers.items()})
            first = F.lit(0).cast("long")
            block = self.listed.where(inside).select(
                "cluster", lane.alias("lane"), F.pmod(F.xxhash64("row"), blocks).alias("block"),
                F.explode(F.sequence(first, share - 1)).alias("part"),
                "id", "label", "v", "bound").groupBy(*keys)
            member = open_slots.select(
                "cluster", lane.alias("lane"), F.pmod(F.xxhash64("row"), share).alias("part"),
                F.explode(F.sequence(first, blocks - 1)).alias("block"),
                "row", "slot", "id", "label", "norm", "v", "low", "high", "least").groupBy(*keys)
            met = member.cogroup(block).applyInPandas(
                lambda m, b: _walk(m, b, size, keep, same_label) if len(m) and len(b) else NOTHING,
                FOUND)
            best = staged(best_of(met if found is None else met.unionByName(found), keep), "walk")
            if tier == len(TIERS) - 1:
                return best
            last = F.when(F.size("best") == keep, -F.element_at("best", -1)["down"])
            reach = F.col("norm") * self.edge(tier)
            open_slots = staged(
                open_slots.drop("least")
                .join(best.select("row", "slot", last.alias("least")), ["row", "slot"], "left")
                .withColumn("least", F.coalesce("least", F.lit(-NONE).cast("long")))
                # The others are certified: what follows stays below their last row or their band.
                .where((reach >= F.col("least")) & (reach * 100 >= F.col("low"))), "open")
            if open_slots.isEmpty():
                return best
            found = best.select("row", "slot", F.inline("best")).select(
                "row", "slot", "id", (-F.col("down")).alias("score"))


def mine(table: DataFrame, every: int = ANCHOR_EVERY, positives: int = POSITIVES,
         negatives: int = NEGATIVES, band: tuple[int, int] = BAND, scale: int = SCALE) -> DataFrame:
    """First ``negatives`` rows of other labels in the band below each of an anchor's positives."""
    spark = table.sparkSession
    rows = staged(scaled_rows(table, scale), "vectors")
    anchors = rows.where((F.col("id") % every == 0) & (F.col("id") != NO_ID))
    size = max(rows.agg(F.max(F.size("v"))).first()[0] or 0, 1)
    anchors = staged(clustered(anchors, c := centres(anchors, size)), "anchors")
    if anchors.isEmpty():
        return spark.createDataFrame([], RESULT)
    lists = Lists(rows, anchors, c)
    any_score = {"slot": F.lit(0), "low": F.lit(-100 * NONE), "high": F.lit(100 * NONE)}
    best = lists.walk(anchors.withColumns(any_score), positives, True)
    found = best.select("row", F.posexplode("best").alias("at", "p"))
    score = -F.col("p.down")
    slots = staged(
        anchors.join(found.select(
            "row", (F.col("at") + 1).alias("slot"), F.col("p.id").alias("positive_id"),
            score.alias("positive_score"), (score * band[0]).alias("low"),
            (score * band[1]).alias("high")), "row").where("low <= high"), "slots")
    best = lists.walk(slots.drop("positive_id", "positive_score"), negatives, False)
    given = slots.select("row", "slot", "id", "positive_id", "positive_score").join(
        best, ["row", "slot"])

    def shown(column: str) -> Column:
        return F.nullif(F.col(column), F.lit(NO_ID))

    return given.select("*", F.posexplode("best").alias("at", "n")).select(
        F.col("id").alias("anchor_id"), shown("positive_id").alias("positive_id"),
        (F.col("at") + 1).cast("int").alias("rank"), shown("n.id").alias("negative_id"),
        "positive_score", (-F.col("n.down")).alias("negative_score"))


def hard_negatives(table: DataFrame) -> DataFrame:
    """Query op11: labels of every seventh row move on by one, then negatives are mined."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return mine(table.select("vec_id", "embedding", moved.alias("label")))


SQL = """
WITH moved AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM moved a JOIN moved b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
ranked AS (
  SELECT anchor_id, positive_id, CAST(row_number() OVER (
      PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INT) AS rank,
    id AS negative_id, positive_score, score AS negative_score
  FROM positives JOIN scores USING (anchor_id)
  WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT * FROM ranked WHERE rank <= 3
"""
