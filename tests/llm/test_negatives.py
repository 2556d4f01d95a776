"""Hard negatives against a search of all rows in plain Python, and their SQL."""

import math
from itertools import zip_longest

import duckdb
import numpy as np
import pytest

from millrace.llm import negatives, registry
from tests.llm.conftest import SF_DIR

SCHEMA = "vec_id long, embedding array<float>, label int, own string, row string, cluster string"


def brute(rows, every, positives, count, band, scale=256):
    known = []
    for key, v, label in rows:
        if v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(scale * float(np.float32(x))) for x in v]
        if sum(x * x for x in q) < 1 << 53:
            known.append((negatives.NO_ID if key is None else key, label, q))
    out = []
    for key, label, q in known:
        if key == negatives.NO_ID or key % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip_longest(q, w, fillvalue=0)), other, of)
                        for other, of, w in known if other != key)
        for p, (down, other, _) in enumerate([s for s in scored if s[2] == label][:positives]):
            band_of = [s for s in scored if s[2] != label
                       and band[0] * -down <= 100 * -s[0] <= band[1] * -down][:count]
            out += [(key, other, i + 1, s[1], -down, -s[0]) for i, s in enumerate(band_of)]
    return sorted(tuple(None if x == negatives.NO_ID else x for x in r) for r in out)


def hard_rows(n, size, seed):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, size)) + 0.6
    v[: n // 3] = v[0]  # a third of all rows are copies
    v[n // 3: n // 2] = np.round(v[n // 3: n // 2])  # ties
    rows = [(i, x.tolist(), int(rng.integers(0, 3))) for i, x in enumerate(v)]
    bad = [(None, v[1].tolist(), 1), (None, v[n // 2].tolist(), 2), (n, None, 1), (n, [1.0], None),
           (7 * n, [float("nan")] * size, 0), (7 * n, [float("inf")] * size, 0), (0, [None], 1),
           (6, v[6].tolist(), 2), (6, v[6].tolist(), 2), (8 * n, [], 1), (9 * n, [0.0] * size, 1),
           (10 * n, [3.0], 0), (4 * n, [0.5] * (size + 3), 1), (11 * n, [1e30] * size, 1),
           (12 * n, (-v[3]).tolist(), 5), (13 * n, [0.0] * size, 2)]
    return rows + bad


@pytest.fixture()
def small(monkeypatch):
    for name, value in (("BLOCK_ROWS", 40), ("MEMBERS", 8), ("STEP", 16), ("CLUSTERS", 3)):
        monkeypatch.setattr(negatives, name, value)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA).repartition(3)


def test_hard_rows_over_many_blocks(spark, small):
    rows = hard_rows(300, 5, 1)
    found = negatives.mine(frame(spark, rows), every=6, positives=4, negatives=3, band=(50, 95))
    expected = brute(rows, 6, 4, 3, (50, 95))
    assert len(expected) > 300
    assert sorted((tuple(r) for r in found.collect()), key=str) == sorted(expected, key=str)


def test_all_rows_in_one_block_and_wide_band(spark):
    rows = hard_rows(120, 4, 2)
    found = negatives.mine(frame(spark, rows), every=5, positives=2, negatives=7, band=(-20, 100))
    assert sorted((tuple(r) for r in found.collect()), key=str) == sorted(
        brute(rows, 5, 2, 7, (-20, 100)), key=str)


def test_no_rows_no_anchors_no_others(spark):
    for rows in ([], [(3, [1.0], 1), (4, [1.0], 2)], [(50, [1.0, 2.0], 1)], [(50, [], 1), (51, [], 1)]):
        found = negatives.mine(frame(spark, rows))
        assert found.columns == [
            "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        assert found.count() == 0


def test_bounds_hold_and_walks_end_early(spark):
    """Tight clusters: every bound is above every product, and a walk stops before its end."""
    rng = np.random.default_rng(3)
    c = np.eye(6)
    v = np.concatenate([k * 5 + rng.normal(size=(60, 6)) * 0.1 for k in c * 50])
    got = spark.createDataFrame(
        [(i, i, 0, x.tolist(), float(np.linalg.norm(x))) for i, x in enumerate(v)],
        "row long, id long, label long, v array<double>, norm double")
    members = negatives.clustered(got, c)
    lists = negatives.Lists(got, members, c)
    bound = {(r["row"], r["cluster"]): r["bound"]
             for r in lists.listed.select("row", "cluster", "bound").collect()}
    of = {r["row"]: r["cluster"] for r in members.select("row", "cluster").collect()}
    for i, k in of.items():
        norm = np.linalg.norm(v[i])
        for j in range(len(v)):
            assert v[i] @ v[j] <= norm * bound[(j, k)]
    edges, counts = lists.tiers[of[0]]
    assert sum(counts) == len(v) and edges[-1] == -math.inf and edges[0] > edges[1]
    tenth = sorted((v[0] @ w for w in v[1:]), reverse=True)[9]
    assert np.linalg.norm(v[0]) * edges[1] < tenth  # certified before the last tier


def test_query_gives_the_rows_of_its_sql(spark):
    name = "op11_maximus_negatives"
    rows = [tuple(r) for r in registry.queries()[name](spark, SF_DIR).collect()]
    base = duckdb.connect()
    base.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_DIR}/embeddings.parquet'")
    assert rows and sorted(rows) == sorted(base.execute(registry.statements()[name]).fetchall())
