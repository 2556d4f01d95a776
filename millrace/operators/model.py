"""Late-delivery classifier: split, preprocessing, training, scoring and what its scores mean."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.lookup import attach
from millrace.functions.numeric import rounded
from millrace.functions.stats import quantiles
from millrace.operators.boosting import BoostedTrees, fit_trees
from millrace.operators.features import CATEGORICAL, FEATURES, NUMERIC, TARGET, incoming_orders
from millrace.operators.preparation import Preparation
from millrace.session import staged

# Labels, limits and messages of the risk levels.
HIGH, MEDIUM, LOW = "🔴 High Risk", "🟡 Medium Risk", "🟢 Low Risk"
HIGH_ABOVE, MEDIUM_ABOVE = 0.70, 0.45
RED_ABOVE, AMBER_ABOVE = 0.65, 0.45
ADVICE = {
    "HIGH RISK": "This order has a HIGH probability of being delayed. Consider upgrading to First "
                 "Class or Same Day shipping, or sourcing from a closer warehouse.",
    "MEDIUM RISK": "This order has MODERATE delay risk. Monitor closely and have a contingency "
                   "plan ready.",
    "LOW RISK": "This order is likely to be delivered ON TIME. Continue with the current shipping "
                "plan.",
}
# Hexadecimal digits by which the counted prefix of a digest grows, the rows of a prefix that one task
# may order, and the digits of a whole digest.
PREFIX_DIGITS = 4
PREFIX_ROWS = 100_000
DIGEST_DIGITS = 32


def digest_of(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed))))


def quota_limits(hashed: DataFrame, group: str, quota: Column) -> DataFrame:
    """Per group the digest of its ``quota``-th row in digest order, as (group, limit).

    ``quota`` may refer to the group's row count as ``total``. Rows are counted per digest prefix,
    which tells the one prefix in which the quota is reached; as long as that holds too many rows,
    they are counted again by a longer prefix. Only the rows of the last prefix are ordered. There
    is one small number per group and prefix, and few groups: the classes of a label. The frame is
    read more than once, so it should be staged.
    """
    spark, digits = hashed.sparkSession, PREFIX_DIGITS
    keyed = hashed.select(group, "digest")
    within = keyed.withColumns(
        {"quota": F.lit(None).cast("bigint"), "base": F.lit(0).cast("bigint")})
    while True:
        counts = within.groupBy(group, F.substring("digest", 1, digits).alias("prefix")).agg(
            F.count("*").alias("n"), F.first("quota").alias("given"), F.first("base").alias("base"))
        upto = F.col("base") + F.sum("n").over(Window.partitionBy(group).orderBy("prefix"))
        total = F.sum("n").over(Window.partitionBy(group))
        reached = (
            counts.select(group, "prefix", "n", "given", upto.alias("upto"), total.alias("total"))
            .withColumn("quota", F.coalesce("given", quota.cast("bigint")))
            .where((F.col("upto") - F.col("n") < F.col("quota")) & (F.col("upto") >= F.col("quota")))
            .select(group, "prefix", "n", "quota", (F.col("upto") - F.col("n")).alias("base")))
        found = reached.collect()
        bounds = F.broadcast(spark.createDataFrame(found, reached.schema).drop("n"))
        within = keyed.join(bounds, group).where(F.startswith("digest", "prefix")).drop("prefix")
        if digits >= DIGEST_DIGITS or all(r["n"] <= PREFIX_ROWS for r in found):
            break
        digits = min(digits + PREFIX_DIGITS, DIGEST_DIGITS)
    place = F.col("base") + F.row_number().over(Window.partitionBy(group).orderBy("digest"))
    rows = within.withColumn("place", place).where("place = quota")
    return rows.select(group, F.col("digest").alias("limit"))


def stratified_split(df: DataFrame, label: str = TARGET, key: str = "order_item_id",
                     test_share: float = 0.2, seed: int = 42, out: str = "split") -> DataFrame:
    """Mark exactly ``ceil(test_share * n)`` rows of each class as test, chosen by hashed key.

    The rows are written once, with a digest, and never sorted or shuffled: each is compared with
    its class's digest limit as it is read.
    """
    hashed = staged(df.withColumn("digest", digest_of(key, seed)), "digested")
    share = F.lit(test_share).cast("decimal(9,6)")
    limits = quota_limits(hashed, label, F.ceil(share * F.col("total")).cast("bigint"))
    marked = attach(hashed, limits, label)
    side = F.when(F.col("digest") <= F.col("limit"), "test").otherwise("train")
    return marked.withColumn(out, side).drop("digest", "limit")


def class_weight(df: DataFrame, label: str = TARGET) -> DataFrame:
    """Negatives per positive, two decimals."""
    counts = df.agg(F.count_if(F.col(label) == 0).alias("neg"), F.count_if(F.col(label) == 1).alias("pos"))
    return counts.select(
        rounded(F.try_divide(F.col("neg").cast("double"), F.col("pos")), 2).alias("weight"))


def fit_classifier(train: DataFrame, weight: float = 1.0, rounds: int = 300, seed: int = 42,
                   label: str = TARGET) -> BoostedTrees:
    """Boosted trees over a prepared ``features`` vector; positives count ``weight`` times."""
    return fit_trees(
        train, label, weight=weight, rounds=rounds, depth=6, rate=0.05, least=3.0, share=0.8,
        columns_share=0.8, seed=seed)


@dataclass(frozen=True)
class Classifier:
    """Fitted preprocessing and boosted trees; saved as plain tables."""

    preparation: Preparation
    trees: BoostedTrees

    def save(self, folder: str) -> None:
        self.preparation.save(f"{folder}/preparation")
        self.trees.save(self.preparation.codes.sparkSession, f"{folder}/trees")

    @staticmethod
    def load(spark: SparkSession, folder: str) -> Classifier:
        return Classifier(
            Preparation.load(spark, f"{folder}/preparation"),
            BoostedTrees.load(spark, f"{folder}/trees"))


def predict(model: Classifier, df: DataFrame) -> DataFrame:
    """Add ``score`` and ``prediction`` to rows that have all feature columns."""
    out = model.preparation.transform(df).withColumn("score", model.trees.probability())
    return out.select(*df.columns, "score", (F.col("score") > 0.5).cast("int").alias("prediction"))


def score_incoming(model: Classifier, df: DataFrame, keep: list[str]) -> DataFrame:
    """Probability, level and advice for new orders without an outcome: a table or a stream.

    Levels compare the unrounded probability. All steps are projections and joins with the model's own
    tables, so ``df`` may be a stream; ``keep`` names the columns that identify an order.
    """
    scored = predict(model, incoming_orders(df, keep))
    level = risk_level(F.col("score"))
    return scored.select(
        *keep, F.col("prediction").alias("predicted_late"), F.col("score").alias("delay_probability"),
        level.alias("risk_level"), advice(level).alias("message"))


def score_orders(model: Classifier, df: DataFrame) -> DataFrame:
    """Class, probability and risk label for a full table, whose own columns stay as they are.

    Only for the model, missing numbers get the median of this table, missing text ``Unknown``, absent features 0.
    """
    numeric = [c for c in NUMERIC if c in df.columns]
    text = [c for c in CATEGORICAL if c in df.columns]
    gaps = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in numeric]).first()
    medians = quantiles(df, {c: 0.5 for c in numeric if gaps[c]}) if any(gaps) else {}
    ready = df.withColumn("given", F.struct("*"))
    ready = ready.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in medians.items()})
    ready = ready.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("Unknown")) for c in text})
    ready = ready.withColumns({c: F.lit(0) for c in FEATURES if c not in df.columns})
    scored = predict(model, ready)
    return scored.select(
        "given.*", F.col("prediction").alias("predicted_late"),
        rounded(F.col("score"), 3).alias("delay_probability"),
        risk_label(F.col("score")).alias("risk_label"),
    )


def risk_label(probability: Column, round_first: bool = True) -> Column:
    """Risk level of a probability; batch scoring compares the value rounded to 3 decimals."""
    p = rounded(probability, 3) if round_first else probability
    return F.when(p > HIGH_ABOVE, HIGH).when(p > MEDIUM_ABOVE, MEDIUM).otherwise(LOW)


def risk_level(probability: Column) -> Column:
    """Level name for a single order; compares the unrounded probability."""
    return (
        F.when(probability > HIGH_ABOVE, "HIGH RISK").when(probability > MEDIUM_ABOVE, "MEDIUM RISK")
        .otherwise("LOW RISK")
    )


def advice(level: Column) -> Column:
    return F.when(level == "HIGH RISK", ADVICE["HIGH RISK"]).when(
        level == "MEDIUM RISK", ADVICE["MEDIUM RISK"]).otherwise(ADVICE["LOW RISK"])


def risk_factors(df: DataFrame, key: str = "order_item_id") -> DataFrame:
    """Five named factors per order, each with its size and traffic-light level."""
    days = F.least(F.col("days_for_shipment_scheduled") / F.lit(10.0), F.lit(1.0))
    factors = {
        "Market Risk Score": F.col("market_risk_score"),
        "Region Risk Score": F.col("region_risk_score"),
        "Mode Risk Score": F.col("mode_risk_score"),
        "Scheduled Days": days,
        "Discount Rate": F.col("order_item_discount_rate"),
    }
    rows = [F.struct(F.lit(n).alias("factor"), s.cast("double").alias("score")) for n, s in factors.items()]
    level = (
        F.when(F.col("score") > RED_ABOVE, "red").when(F.col("score") > AMBER_ABOVE, "amber")
        .otherwise("green")
    )
    return df.select(key, F.inline(F.array(*rows))).withColumn("level", level)


def feature_importance(model: Classifier, n: int = 15) -> DataFrame:
    """The n most important features, least important first."""
    weights = model.trees.importances
    pairs = [(name, float(w)) for name, w in zip(model.preparation.columns, weights)]
    spark = model.preparation.codes.sparkSession
    table = spark.createDataFrame(pairs, "Feature string, Importance double")
    top = table.orderBy(F.desc("Importance"), "Feature").limit(n)
    return top.orderBy("Importance", F.desc("Feature"))
