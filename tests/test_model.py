"""Split, balancing, preprocessing, training and evaluation."""

import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from millrace import registry
from millrace.operators import evaluation, model, oversample, sensors
from millrace.functions.stats import places
from millrace.operators.features import CATEGORICAL, FEATURES, NUMERIC, dashboard_view
from millrace.operators.preparation import fit_preparation
from millrace.plans import delay_model
from millrace.plans.delay_model import DelayModel, train_delay_model, training_rows
from millrace.plans.etl import clean_orders
from millrace.plans.maintenance import score_failures, train_failure_model
from millrace.session import staged
from millrace.sources.fixtures import mart, sensor
from tests.conftest import SF_DIR


@pytest.mark.parametrize("digits,rows", [(1, 1), (1, 50), (2, 100_000), (4, 3)])
def test_split_takes_exact_shares(spark, monkeypatch, digits, rows):
    monkeypatch.setattr(model, "PREFIX_DIGITS", digits)
    monkeypatch.setattr(model, "PREFIX_ROWS", rows)
    df = spark.range(2_003).select(
        F.col("id").alias("order_item_id"), (F.col("id") % 7 == 0).cast("int").alias("late_delivery_risk"))
    split = model.stratified_split(df)
    counts = {(r[0], r[1]): r[2] for r in split.groupBy("late_delivery_risk", "split").count().collect()}
    for label, n in {0: 2_003 - 287, 1: 287}.items():
        assert counts[label, "test"] == math.ceil(n / 5)
        assert counts[label, "train"] == n - math.ceil(n / 5)
    again = model.stratified_split(df.repartition(5))
    assert split.join(again, ["order_item_id", "split"]).count() == 2_003


def test_repeated_keys_do_not_narrow_for_ever(spark, monkeypatch):
    monkeypatch.setattr(model, "PREFIX_ROWS", 2)
    df = spark.range(50).select(F.lit("same").alias("order_item_id"), F.lit(1).alias("late_delivery_risk"))
    assert {r["split"] for r in model.stratified_split(df).collect()} == {"test"}


@pytest.mark.parametrize("pool_rows", [400, 30, 3, 1])
def test_partners_are_those_of_a_plain_search(spark, pool_rows):
    rng = np.random.default_rng(11)
    # one dense cluster holds most points, the rest is spread out; some are equal
    x = np.vstack([rng.normal(0, 0.01, (260, 3)), rng.uniform(-5, 5, (140, 3))])
    x[300:310] = x[299]
    rows = spark.createDataFrame(
        [(f"p{i}", v.tolist()) for i, v in enumerate(x)], "key string, x array<double>").repartition(3)
    held = list(range(pool_rows))
    pool = spark.createDataFrame([(f"p{i}", x[i].tolist()) for i in held], rows.schema).coalesce(1)
    grid = np.floor(x * oversample.GRID + 0.5)
    for r in oversample.nearest_partners(rows, pool, 5).collect():
        i = int(r["key"][1:])
        near = sorted(((((grid[j] - grid[i]) ** 2).sum(), j) for j in held if j != i))[:5]
        assert r["partners"] == [x[j].tolist() for _, j in near]


def test_neighbours_beyond_the_first_twenty_thousand_rows_are_found(spark):
    # far apart pairs of rows: the nearest other row is always the twin
    near = spark.range(21_000).select(
        F.concat(F.lit("a"), "id").alias("order_item_id"), F.lit(0).alias("y"),
        F.array(F.floor(F.col("id") / 2).cast("double"), (F.col("id") % 2) / 8.0).alias("x"))
    rest = spark.range(21_300).select(
        F.concat(F.lit("b"), "id"), F.lit(1), F.array(F.lit(0.0), F.lit(0.0)))
    df = near.unionAll(rest).select("order_item_id", "y", array_to_vector("x").alias("features"))
    made = oversample.oversample(df, "y", k=1).where("parent is not null").select("parent", "partner").collect()
    assert len(made) == 300
    for r in made:
        i = int(r["parent"][1:])
        assert r["partner"] == [float(i // 2), (1 - i % 2) / 8]


def test_a_cell_thins_equal_points_and_finds_the_same(monkeypatch):
    monkeypatch.setattr(oversample, "CELL_ROWS", 40)
    monkeypatch.setattr(oversample, "BOX_ROWS", 8)
    monkeypatch.setattr(oversample, "SOUGHT_ROWS", 16)
    rng = np.random.default_rng(8)
    # half of the rows are one point, keys come back and some are missing
    x = np.where(rng.random((600, 1)) < 0.5, 0.25, rng.integers(0, 9, (600, 3)) / 4)
    keys = [None if i % 50 == 0 else f"k{i % 37}" if x[i, 0] == 0.25 else f"p{i}" for i in range(600)]
    gathered = oversample.Gathered(3, 4)
    for at in range(0, 600, 7):
        part = slice(at, at + 7)
        gathered.add(x[part], pa.array(keys[part], pa.string()), pa.array(range(at, min(at + 7, 600)), pa.int64()))
    cell = gathered.cell()
    assert len(cell.points) < 500
    within = np.where(np.arange(600) % 3 == 0, 200_000.0, np.inf)
    seekers = pa.RecordBatch.from_pydict({
        "x": pa.array(x.tolist()), "key": pa.array(keys, pa.string()), "within": pa.array(within),
        "order": pa.nulls(600, pa.int64())})
    found, limit = gathered.neighbours(cell, seekers)
    for i, got in enumerate(found.to_pylist()):
        far = ((np.floor(x * 1024 + 0.5) - np.floor(x[i] * 1024 + 0.5)) ** 2).sum(1)
        near = sorted((far[j], j) for j in range(600) if keys[j] != keys[i] and far[j] <= within[i])[:4]
        assert [(p["d"], p["order"], p["x"]) for p in got] == [(d, j, x[j].tolist()) for d, j in near]
        assert limit[i] == (near[3][0] if len(near) == 4 else within[i])


def balanced_rows(spark, n_small, n_large, distinct):
    rng = np.random.default_rng(2)
    rows = [(f"a{i}", 0, rng.normal(0, 1, 4).round(distinct).tolist()) for i in range(n_small)]
    rows += [(f"b{i}", 1, rng.normal(1, 1, 4).tolist()) for i in range(n_large)]
    df = spark.createDataFrame(rows, "order_item_id string, y int, x array<double>")
    return df.select("order_item_id", "y", array_to_vector("x").alias("features"))


@pytest.mark.parametrize("n_small,n_large,distinct", [(60, 101, 6), (60, 320, 0), (40, 41, 6), (7, 30, 6)])
def test_oversample(spark, n_small, n_large, distinct):
    df = balanced_rows(spark, n_small, n_large, distinct)
    rows = oversample.oversample(df, "y")
    counts = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    assert counts == {0: n_large, 1: n_large}
    assert rows.where("parent is null").count() == n_small + n_large
    assert rows.select("order_item_id").distinct().count() == 2 * n_large
    given = {r["order_item_id"]: r["features"].toArray() for r in df.where("y = 0").collect()}
    x = np.vstack(list(given.values()))
    for row in rows.where("parent is not null").collect():
        a, b, new = given[row["parent"]], np.array(row["partner"]), row["features"].toArray()
        assert (np.minimum(a, b) - 1e-12 <= new).all() and (new <= np.maximum(a, b) + 1e-12).all()
        # the partner is a row of the class and among the five nearest (ties included)
        to_all = np.sort(np.sqrt(((x - a) ** 2).sum(1)))[1:]
        assert np.sqrt(((a - b) ** 2).sum()) <= to_all[min(4, len(to_all) - 1)] + 4 / oversample.GRID
        assert (np.abs(x - b).sum(1) == 0).any()
    again = oversample.oversample(df.repartition(3), "y")
    assert sorted(r["order_item_id"] for r in rows.collect()) == sorted(
        r["order_item_id"] for r in again.collect())


def test_balanced_classes_are_left_alone(spark):
    df = balanced_rows(spark, 10, 10, 6)
    assert oversample.oversample(df, "y").where("parent is not null").count() == 0


def test_new_points_of_a_small_table_by_plain_loops(spark):
    df = balanced_rows(spark, 9, 23, 6)
    given = {r["order_item_id"]: r["features"].toArray() for r in df.where("y = 0").collect()}
    order = sorted(given, key=lambda k: hashlib.md5(f"{k}42".encode()).hexdigest())

    def u(*parts):
        return int(hashlib.md5("#".join(map(str, parts)).encode()).hexdigest()[:8], 16) / 2**32

    expected = {}
    for nth, key in enumerate(order):
        x, others = given[key], [k for k in order if k != key]
        far = {k: ((np.floor(given[k] * 1024 + 0.5) - np.floor(x * 1024 + 0.5)) ** 2).sum() for k in others}
        near = sorted(others, key=lambda k: (far[k], order.index(k)))[:5]
        for copy in range(1, 14 // 9 + (nth < 14 % 9) + 1):
            partner = given[near[int(u(key, copy, 42) * 5)]]
            expected[f"{key}#{copy}"] = x + u(key, copy, 43) * (partner - x)
    made = {r["order_item_id"]: r["features"].toArray()
            for r in oversample.oversample(df, "y").where("parent is not null").collect()}
    assert made.keys() == expected.keys()
    assert all(np.allclose(made[k], expected[k], rtol=0, atol=1e-12) for k in made)


def test_preparation_learns_and_applies(spark):
    train = spark.createDataFrame(
        [(1.0, 2.0, "b", None), (3.0, 2.0, "a", None), (None, 2.0, "a", None), (8.0, None, None, None)],
        "n double, flat double, t string, empty string")
    fitted = fit_preparation(train, ["n", "flat"], ["t", "empty"])
    assert fitted.modes == {"t": "a", "empty": None}
    assert fitted.numbers["n"].median == 3.0 and fitted.numbers["flat"].deviation == 1.0
    new = spark.createDataFrame(
        [(None, 5.0, "b", "x"), (3.75, None, "zz", None), (1.0, 2.0, None, None)], train.schema)
    rows = [r[0] for r in fitted.transform(new).select(vector_to_array("features")).collect()]
    sd = np.std([1, 3, 3, 8])
    assert np.allclose(rows, [[-0.75 / sd, 3, 1, -1], [0, 0, -1, -1], [-2.75 / sd, 0, 0, -1]])
    assert fitted.transform(new).drop("features").collect() == new.collect()


def test_places_over_many_ranges(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [("hot" if i % 3 else f"k{i % 17}", f"v{v:06d}") for i, v in enumerate(rng.permutation(4_000))]
    frame = spark.createDataFrame(rows, "k string, v string").repartition(7)
    got = {(r["k"], r["v"]): r["place"] for r in places(frame, "k", "v", "place").collect()}
    of_key = {}
    for k, v in sorted(rows):
        assert got[k, v] == of_key.setdefault(k, 0)
        of_key[k] += 1
    assert places(frame.limit(0), "k", "v", "place").count() == 0


def test_risk_labels_round_first_only_in_batch(spark):
    df = spark.createDataFrame([(0.7004,), (0.7006,), (0.4504,), (0.3,)], "p double")
    batch = [r[0] for r in df.select(model.risk_label(F.col("p"))).collect()]
    single = [r[0] for r in df.select(model.risk_label(F.col("p"), round_first=False)).collect()]
    assert batch == [model.MEDIUM, model.HIGH, model.LOW, model.LOW]
    assert single == [model.HIGH, model.HIGH, model.MEDIUM, model.LOW]


def test_published_confusion_gives_published_measures(spark):
    cells = [(1, 1, 3178), (0, 1, 1302), (1, 0, 2153), (0, 0, 2384)]
    df = spark.createDataFrame(cells, "label int, prediction int, n int").select(
        "label", "prediction", F.explode(F.sequence(F.lit(1), "n")))
    # Published accuracy, precision, recall and F1.
    expected = (0.6168348674725519, 0.709375, 0.5961358094166198, 0.6478442564468454)
    assert tuple(evaluation.binary_metrics(df).first()) == pytest.approx(expected, rel=1e-12)
    assert {tuple(r) for r in evaluation.confusion(df).collect()} == set(cells)


def test_area_under_curve_counts_ties_half(spark):
    rng = np.random.default_rng(4)
    label, score = rng.integers(0, 2, 400), rng.integers(0, 30, 400) / 30
    df = spark.createDataFrame([(int(y), float(s)) for y, s in zip(label, score)], "label int, score double")
    pos, neg = score[label == 1], score[label == 0]
    wins = (pos[:, None] > neg).sum() + (pos[:, None] == neg).sum() / 2
    assert evaluation.auc(df).first()[0] == pytest.approx(wins / len(pos) / len(neg))


def test_measures_without_positives(spark):
    df = spark.createDataFrame([(0, 0, 0.1), (0, 0, 0.2)], "label int, prediction int, score double")
    found = evaluation.binary_metrics(df).first()
    assert (found["accuracy"], found["precision"], found["recall"], found["f1"]) == (1.0, None, None, None)
    assert evaluation.auc(df).first()[0] is None


@pytest.fixture(scope="module")
def clean(spark):
    return clean_orders(mart(spark, SF_DIR))


@pytest.fixture(scope="module")
def fitted(clean):
    return train_delay_model(clean, rounds=5)


def test_training_holds_out_and_measures(fitted, clean):
    n = clean.count()
    assert n / 5 <= fitted.holdout.count() <= n / 5 + 2
    scores = {r["Metric"]: r["Score"] for r in fitted.metrics().collect()}
    assert list(scores) == ["Accuracy", "Precision", "Recall", "F1-Score", "AUC-ROC"]
    assert scores["AUC-ROC"] > 0.5
    assert all(0 <= v <= 1 for v in scores.values())


@pytest.fixture(scope="module")
def loaded(spark, fitted, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("saved") / "model")
    fitted.save(folder)
    assert spark.read.parquet(f"{folder}/metrics").count() == 5
    return DelayModel.load(spark, folder)


def test_scoring_fills_gaps_and_absent_features(fitted, loaded, clean):
    view = dashboard_view(clean).orderBy("order_id", "sales").limit(50).cache()
    broken = view.withColumn("market", F.lit("nowhere")).withColumn("sales", F.lit(None).cast("double"))
    broken = broken.withColumn("sales", F.when(F.col("order_hour") < 12, 5.0)).drop("mode_risk_score")
    for df in (view, broken):
        rows = model.score_orders(loaded.classifier, df).collect()
        assert len(rows) == df.count()
        assert all(0 <= r["delay_probability"] <= 1 and r["predicted_late"] in (0, 1) for r in rows)
        given = model.score_orders(loaded.classifier, df).select(*df.columns)
        assert given.schema == df.schema and given.exceptAll(df).isEmpty()
    same = model.score_orders(fitted.classifier, view).select("order_id", "delay_probability")
    assert sorted(same.collect()) == sorted(
        model.score_orders(loaded.classifier, view).select("order_id", "delay_probability").collect())
    assert sorted(loaded.metrics().collect()) == sorted(fitted.metrics().collect())


def test_models_of_other_features_are_refused(spark, fitted, tmp_path):
    fitted.save(str(tmp_path / "m"))
    fitted.features().where("place > 0").write.mode("overwrite").parquet(str(tmp_path / "m/features"))
    with pytest.raises(ValueError, match="other features"):
        DelayModel.load(spark, str(tmp_path / "m"))


def test_incoming_orders_are_scored_as_table_and_as_stream(spark, loaded, clean, tmp_path):
    columns = ["order_item_id", "order_date", "sales", "order_item_quantity", "shipping_mode",
               "order_region", "market", "category_name", "department_name", "customer_segment",
               "payment_type", "days_for_shipment_scheduled", "order_item_discount_rate",
               "order_item_product_price"]
    arrived = clean.select(*columns).orderBy("order_item_id").limit(60).withColumn(
        "payment_type", F.when(F.col("order_item_quantity") > 10, F.col("payment_type")))
    arrived.repartition(3).write.parquet(str(tmp_path / "in"))
    table = model.score_incoming(
        loaded.classifier, spark.read.parquet(str(tmp_path / "in")), ["order_item_id"])
    rows = sorted(table.collect())
    assert len(rows) == 60
    for r in rows:
        p = r["delay_probability"]
        level = "HIGH RISK" if p > 0.7 else "MEDIUM RISK" if p > 0.45 else "LOW RISK"
        assert r["risk_level"] == level and r["message"] == model.ADVICE[level]
        assert r["predicted_late"] == int(p > 0.5)
    stream = spark.readStream.schema(arrived.schema).option("maxFilesPerTrigger", 1).parquet(
        str(tmp_path / "in"))
    query = model.score_incoming(loaded.classifier, stream, ["order_item_id"]).writeStream.format(
        "parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert sorted(spark.read.parquet(str(tmp_path / "out")).select(*table.columns).collect()) == rows


def test_feature_vector_has_numeric_then_category_columns(fitted, clean):
    assert fitted.classifier.preparation.columns == NUMERIC + CATEGORICAL
    assert len(FEATURES) == len(NUMERIC + CATEGORICAL)
    prepared = fitted.classifier.preparation.transform(training_rows(clean))
    codes = np.array([r["f"] for r in prepared.select(vector_to_array("features").alias("f")).collect()])
    assert codes.shape[1] == len(FEATURES)
    assert (codes[:, len(NUMERIC):] % 1 == 0).all() and codes[:, len(NUMERIC):].min() >= -1


def test_importance_is_ascending(fitted):
    rows = model.feature_importance(fitted.classifier, 15).collect()
    weights = [r["Importance"] for r in rows]
    assert len(rows) == 15 and weights == sorted(weights)


def test_failure_model_scores_every_full_machine(spark):
    readings = sensor(spark, "/root/testdata/sf0.01")
    fitted = train_failure_model(readings, rounds=3)
    scored = score_failures(fitted, readings).collect()
    full = readings.groupBy("machine_id").count().where(F.col("count") >= sensors.WINDOW).count()
    assert len(scored) == full
    assert all(0 <= r["failure_probability"] <= 1 and 1 <= r["rul_hours"] <= 72 for r in scored)
    assert fitted.report().count() == 5


def test_registered_models_train_once_and_with_the_default_rounds(spark, fitted, monkeypatch):
    seen = []
    monkeypatch.setattr(registry, "_models", {})
    monkeypatch.setattr(registry, "train_delay_model", lambda *a, **kw: seen.append(kw) or fitted)
    first, again = registry._trained(spark, SF_DIR), registry._trained(spark, SF_DIR)
    assert seen == [{}] and sorted(first.metrics().collect()) == sorted(again.metrics().collect())
    registry._trained(spark, "/root/testdata/sf0.01")
    assert seen == [{}, {}]
    for name in ("sensor", "score_failures"):
        monkeypatch.setattr(registry, name, lambda *a: None)
    monkeypatch.setattr(registry, "train_failure_model", lambda *a, **kw: seen.append(kw))
    registry._failure_scores(None, "")
    assert seen == [{}, {}, {}]


def test_wide_categories_are_coded(spark):
    frame = spark.range(60_000).select(
        F.col("id").alias("order_item_id"), *[(F.col("id") % 7).cast("double").alias(c) for c in NUMERIC],
        *[F.format_string("v%06d", "id").alias(c) for c in CATEGORICAL])
    fitted = fit_preparation(frame, NUMERIC, CATEGORICAL)
    assert fitted.codes.count() == 60_000 * len(CATEGORICAL)
    known = fitted.transform(frame.where("order_item_id = 59999")).select(vector_to_array("features")).first()[0]
    assert known[len(NUMERIC):] == [59_999.0] * len(CATEGORICAL)


def test_training_rows_are_written_once(spark, monkeypatch):
    written = []

    def counted(df, name):
        written.append(name)
        return staged(df, name)

    for module in (model, delay_model):
        if hasattr(module, "staged"):
            monkeypatch.setattr(module, "staged", counted)
    clean = clean_orders(mart(spark, SF_DIR))
    rows = training_rows(clean)
    assert written == ["digested"]
    assert {"train", "test"} == {r["split"] for r in rows.select("split").distinct().collect()}
