"""Trained scores on held-out rows, the line field against enumeration, neighbours, the pipeline."""

import itertools
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import hilbert, quality, toxicity
from millrace.llm.common import text_bytes
from tests.llm.conftest import SF_DIR, brute_components
from tests.llm.test_text import brute_spans

LARGER = "/root/testdata/sf0.1"


def test_forward_backward_is_enumeration():
    rnd = np.random.default_rng(4)
    row = np.array([0, 0, 0, 0, 1, 2, 2])
    bias, link = rnd.normal(size=7), rnd.normal(size=(2, 2))
    good, pairs = quality.forward_backward(bias, link, row, want_pairs=True)
    expected = np.zeros((2, 2))
    for d in range(3):
        lines = np.flatnonzero(row == d)
        weights = {}
        for path in itertools.product((0, 1), repeat=len(lines)):
            weights[path] = math.exp(sum(bias[i] * y for i, y in zip(lines, path)) + sum(
                link[a, b] for a, b in itertools.pairwise(path)))
        total = sum(weights.values())
        for k, i in enumerate(lines):
            assert good[i] == pytest.approx(sum(w for p, w in weights.items() if p[k]) / total)
        for p, w in weights.items():
            for a, b in itertools.pairwise(p):
                expected[a, b] += w / total
    assert np.allclose(pairs, expected)


@pytest.mark.parametrize("which", ["quality", "toxic"])
def test_held_out_accuracy(spark, which):
    documents = spark.read.parquet(f"{LARGER}/documents.parquet")
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    query = quality.quality_scores if which == "quality" else toxicity.toxicity_scores
    found = query(documents, labels)
    assert found.count() == documents.count()
    told = found.where("held_out").join(labels, "doc_id").agg(
        F.avg((F.col("predicted") == F.col(which)).cast("double")), F.min("score"), F.max("score")).first()
    assert told[0] > 0.97 and told[1] >= 0 and told[2] <= 1


@pytest.mark.parametrize("model", [quality, toxicity])
def test_hard_rows_and_missing_labels(docs, none, labels, model):
    usable = ~model.held_out()
    for known in (labels, labels.limit(0), labels.where("quality = 1 and toxic = 0")):
        fitted = model.fit(docs, known, usable)
        rows = model.score(docs, fitted, ("doc_id", "row", "score")).collect()
        assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert all(r["row"] == "own row" for r in rows)
    assert model.score(none, fitted).count() == 0
    empty = model.score(docs.where("doc_id < 2"), fitted).collect()
    assert empty[0]["score"] == empty[1]["score"]


def test_toxic_sentences_are_located():
    clean = ["the mill stood by the river. nobody came é."] * 40
    bad = [f"the mill stood by the river. you total blockhead{i % 2}! nobody came é." for i in range(20)]
    model = toxicity.train(clean + bad, [0] * 40 + [1] * 20)
    raw, bounds = text_bytes(pa.array(["é nobody came. you total blockhead1! the mill.", ""]))
    found, starts, row, each = model.score(raw, bounds)
    assert found[0] > 0.5 > found[1]
    assert np.argmax(each) == 1 and each[0] < 0.3 and each[2] < 0.3


def test_hilbert_curve_visits_every_cell_by_single_steps():
    for axes, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
        key = hilbert.hilbert_keys(grid, bits)
        assert sorted(key) == list(range(len(grid)))
        steps = np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(1)
        assert (steps == 1).all()


def brute_nearest(rows, k, every):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], float)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        scores = (x * x[i]).sum(1)
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != ids[i]][:k]
        out[ids[i]] = [(ids[j], scores[j]) for j in order]
    return out


def test_neighbours_of_a_small_table_are_exact(spark):
    rnd = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rnd.normal(size=6)]) for i in range(1, 200)]
    rows += [(i, rows[4][1]) for i in range(200, 230)]  # ties
    odd = [(400, None), (420, [0.0] * 6), (440, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (460, [float("nan")] * 6),
           (480, [float("inf")] * 6), (500, [1.0, 2.0]), (None, [1.0] * 6), (520, [])]
    frame = spark.createDataFrame(rows + odd + rows[:3], "vec_id long, embedding array<double>")
    frame = frame.withColumn("block", F.lit("own"))
    got = {}
    for r in hilbert.nearest(frame).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = brute_nearest(rows, 20, 20)
    assert got.keys() == want.keys()
    for q in want:
        assert [v for v, _ in got[q]] == [v for v, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=0, atol=1e-12)
    assert hilbert.nearest(frame.limit(0)).count() == 0
    assert hilbert.nearest(frame.where("vec_id in (20, 3)")).count() == 1


@pytest.mark.parametrize("size", [64, 8])
def test_recall(spark, size):
    rnd = np.random.default_rng(size)
    x = rnd.normal(size=(9_000, size))
    x[:3_000] = x[0] + 0.05 * x[:3_000]  # a hot neighbourhood
    frame = spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in hilbert.nearest(frame).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    want = brute_nearest(list(enumerate(x)), 20, 20)
    hits = sum(len(got[q] & {v for v, _ in want[q]}) for q in want)
    assert hits / (20 * len(want)) >= 0.9


def test_copies_fill_no_block(spark, monkeypatch):
    rnd = np.random.default_rng(8)
    rows = [(i, [float(v) for v in rnd.normal(size=6)]) for i in range(3_000)]
    rows += [(i, rows[4][1]) for i in range(3_000, 6_000)]
    rows += [(i, [v + 1e-9 * i for v in rows[7][1]]) for i in range(6_000, 9_000)]  # one place, no copies
    monkeypatch.setattr(hilbert, "BLOCK_ROWS", 256)
    sizes, staged = [], hilbert.staged

    def watched(df, name):
        out = staged(df, name)
        if name == "curves":
            sizes.extend(r["count"] for r in out.where("not asks").groupBy("block").count().collect())
        return out

    monkeypatch.setattr(hilbert, "staged", watched)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in hilbert.nearest(frame).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert max(sizes) <= 4 * 256
    want = brute_nearest(rows, 20, 20)
    assert got.keys() == want.keys()
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits / (20 * len(want)) >= 0.9
    assert all(len(got[q]) == 20 for q in want)


def test_pipeline_stage_by_stage(spark, real):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "toxicity", "near_duplicates", "personal_data", "packing"]
    steps = [stage for _, stage in corpus_pipeline.STAGES]
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    good = steps[0](spark, real, SF_DIR).cache()
    field = quality.fit(real, labels, ~quality.held_out())
    passed = {r["doc_id"] for r in quality.score(real, field).where("score >= 0.5").collect()}
    assert {r["doc_id"] for r in good.collect()} == passed and good.columns == real.columns
    mild = steps[1](spark, good, SF_DIR).cache()
    model = toxicity.fit(good, labels, ~toxicity.held_out())
    passed = {r["doc_id"] for r in toxicity.score(good, model).where("score < 0.3").collect()}
    assert {r["doc_id"] for r in mild.collect()} == passed and mild.columns == real.columns
    single = steps[2](spark, mild, SF_DIR).cache()
    rows = [(r["doc_id"], r["text"]) for r in mild.collect()]
    components = brute_components(rows, 5)
    kept = {c for n, c in components if n} | {d for (d, _), (n, _) in zip(rows, components) if not n}
    assert {r["doc_id"] for r in single.collect()} == kept
    clean = steps[3](spark, single, SF_DIR).cache()
    text_of = {r["doc_id"]: r["text"] for r in single.collect()}
    for r in clean.collect():
        spans = brute_spans(text_of[r["doc_id"]])
        assert spans or r["text"] == text_of[r["doc_id"]] or "[" in r["text"]
        assert not spans or "[" in r["text"] and not brute_spans(r["text"])
        assert r["n_chars"] == len(r["text"])
    assert clean.columns == real.columns
    pieces = steps[4](spark, clean, SF_DIR)
    assert {r["doc_id"] for r in pieces.select("doc_id").distinct().collect()} == set(text_of)


def test_pipeline_takes_hard_rows(spark, docs, none):
    for frame in (docs, none):
        out = frame
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, out, SF_DIR)
            assert out.columns == frame.columns, name
            out = spark.createDataFrame(out.collect(), frame.schema)
        pieces = corpus_pipeline.STAGES[-1][1](spark, out, SF_DIR)
        assert pieces.count() >= out.count()


def test_tasks_and_lists_learn_the_same_toxicity(spark, monkeypatch):
    words = [f"w{i}" for i in range(60)]
    random = np.random.default_rng(4)
    texts = [". ".join(" ".join(random.choice(words, 6)) for _ in range(3)) for _ in range(80)]
    labels = [int(i % 4 == 0) for i in range(80)]
    texts = [f"{t}. You awful{i % 3} fool" if y else t for i, (t, y) in enumerate(zip(texts, labels))]
    monkeypatch.setattr(toxicity, "LEAST_LIFT", 2.0)
    local = toxicity.train(texts, labels)
    rows = spark.createDataFrame(
        [(i, t, y) for i, (t, y) in enumerate(zip(texts, labels))], "row long, text string, label int")
    monkeypatch.setattr(toxicity, "train", None)
    spread = toxicity.train_on(rows.repartition(5))
    assert len(local.keys) > 3 and (spread.keys == local.keys).all()
    assert (spread.weights == local.weights).all() and spread.constant == local.constant
    # The texts stay with the tasks: a fit needs neither them nor their words on the driver.
    monkeypatch.setattr(toxicity, "portions", None)
    docs = rows.select(F.col("row").alias("doc_id"), "text")
    fitted = toxicity.fit(docs, rows.select(F.col("row").alias("doc_id"), F.col("label").alias("toxic")), F.lit(True))
    assert set(fitted.keys.tolist()) == set(local.keys.tolist())
