"""A learned sentiment labeler (M6): sparse multinomial logistic regression over hashed words, classes weighted.

Words are what stands between white space, present or not; the L1 penalty keeps the few that tell the classes apart,
since labelled rows are far fewer than words.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinio.operators.labelers import SENTIMENTS

CLASSES = SENTIMENTS
FEATURES, ITERATIONS, PENALTY = 1 << 14, 60, 0.01


def _class_number(label: Column) -> Column:
    return (F.array_position(F.array(*map(F.lit, CLASSES)), label) - 1).cast("double")


def fit(rows: DataFrame, text_col: str, label_col: str) -> PipelineModel:
    """Train on (text, one of ``CLASSES``); a class weighs as much as any other, however rare it is."""
    rows = rows.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), _class_number(F.col(label_col)).alias("label"))
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}  # one row per class
    weight = F.element_at(F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, sum(counts.values()) / (len(counts) * n))]),
                          F.col("label"))
    return Pipeline(stages=[
        RegexTokenizer(inputCol="text", outputCol="tokens", pattern=r"\S+", gaps=False, toLowercase=True),
        HashingTF(inputCol="tokens", outputCol="features", numFeatures=FEATURES, binary=True),
        LogisticRegression(family="multinomial", weightCol="weight", maxIter=ITERATIONS, elasticNetParam=1.0, regParam=PENALTY),
    ]).fit(rows.withColumn("weight", weight))


def predict(model: PipelineModel, rows: DataFrame, text_col: str) -> DataFrame:
    """Add ``sentiment`` and the probability ``p_<class>`` of each class; a NULL text reads as the empty one."""
    out = model.transform(rows.withColumn("text", F.coalesce(F.col(text_col), F.lit(""))))
    p = vector_to_array(F.col("probability"))
    name = F.get(F.array(*map(F.lit, CLASSES)), F.col("prediction").cast("int"))
    return out.select(*rows.columns, name.alias("sentiment"), *[F.coalesce(F.get(p, k), F.lit(0.0)).alias(f"p_{c}")
                                                                for k, c in enumerate(CLASSES)])


def quality(predicted: DataFrame, bins: int = 10) -> tuple[float, DataFrame]:
    """Macro F1 over rows with an ``actual`` label, and (bin, n, confidence, accuracy) of the predicted class."""
    rows = predicted.where(F.col("actual").isNotNull())
    counts = {(r["actual"], r["sentiment"]): r["count"] for r in rows.groupBy("actual", "sentiment").count().collect()}
    scores = []
    for c in {a for a, _ in counts}:
        hit = counts.get((c, c), 0)
        scores.append(2 * hit / (sum(n for (a, _), n in counts.items() if a == c) + sum(n for (_, s), n in counts.items() if s == c)))
    sure = F.greatest(*[F.col(f"p_{c}") for c in CLASSES])
    calibration = rows.groupBy(F.least(F.floor(sure * bins), F.lit(bins - 1)).alias("bin")).agg(
        F.count("*").alias("n"), F.avg(sure).alias("confidence"), F.avg((F.col("sentiment") == F.col("actual")).cast("int")).alias("accuracy"))
    return sum(scores) / max(1, len(scores)), calibration
