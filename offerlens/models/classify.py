"""Salary-class classifiers on MLlib (text + numeric + categorical features).

Everything that learns is fitted on the training rows only: TF-IDF
vocabulary and idf, numeric means / population standard deviations, the
category indexes, and the model.  The four reference models map to MLlib:

* logistic regression -> multinomial ``LogisticRegression`` with an L2 weight
  equal to sklearn's C=1 (``regParam = 1 / n_train``) and its tolerance 1e-4
* random forest       -> ``RandomForestClassifier`` (200 trees, sqrt features)
* linear SVM          -> ``OneVsRest(LinearSVC)`` (LinearSVC is binary only)
* gradient boosting   -> ``OneVsRest(GBTClassifier)`` (GBT is binary only)
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml import Pipeline
from pyspark.ml.classification import (GBTClassifier, LinearSVC, LogisticRegression, OneVsRest,
                                       RandomForestClassifier)
from pyspark.ml.feature import IndexToString, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlens.models.tfidf import tfidf_vectors

NUMERIC = ["department_num", "experience_years", "remote"]
CATEGORICAL = ["category", "contract_type", "salary_unit"]
TEXT = "text_all"
LABEL = "salary_category"
NULL_CATEGORY = "__null__"
MODELS = ("LogisticRegression", "RandomForest", "LinearSVC", "GradientBoosting")


def make_classifier(name: str, n_train: int, seed: int = 42):
    if name == "LogisticRegression":
        return LogisticRegression(family="multinomial", maxIter=2000, tol=1e-4, regParam=1.0 / max(n_train, 1),
                                  elasticNetParam=0.0, standardization=False)
    if name == "RandomForest":
        # cacheNodeIds / maxMemoryInMB only change how deep trees are grown
        # (fewer passes over the data), not the trees themselves
        return RandomForestClassifier(numTrees=200, seed=seed, featureSubsetStrategy="sqrt", maxDepth=30,
                                      minInstancesPerNode=1, cacheNodeIds=True, maxMemoryInMB=1024)
    if name == "LinearSVC":
        # one binary model per class, trained concurrently
        return OneVsRest(classifier=LinearSVC(maxIter=1000, tol=1e-4, regParam=1.0 / max(n_train, 1),
                                              standardization=False),
                         parallelism=3)
    if name == "GradientBoosting":
        return OneVsRest(classifier=GBTClassifier(maxIter=100, maxDepth=3, stepSize=0.1, seed=seed),
                         parallelism=3)
    raise ValueError(f"unknown model {name!r}")


def _standardize_with(train: DataFrame, others: list[DataFrame], cols: list[str]) -> list[DataFrame]:
    """Population standardisation with statistics of ``train`` (one row, broadcast)."""
    stats = train.agg(*[F.avg(c).alias(f"__mu_{c}") for c in cols],
                      *[F.stddev_pop(c).alias(f"__sd_{c}") for c in cols])
    out = []
    for d in [train, *others]:
        x = d.crossJoin(F.broadcast(stats))
        for c in cols:
            z = (F.col(c) - F.col(f"__mu_{c}")) / F.nullif(F.col(f"__sd_{c}"), F.lit(0.0))
            x = x.withColumn(f"std_{c}", F.coalesce(z, F.lit(0.0)))
        out.append(x.drop(*[f"__mu_{c}" for c in cols], *[f"__sd_{c}" for c in cols]))
    return out


class Features(NamedTuple):
    """Feature tables of one split, for any number of classifiers."""

    train: DataFrame        # key, salary_category, label, features
    test: DataFrame
    labels: list[str]
    n_train: int


def prepare_features(train: DataFrame, test: DataFrame, key: str = "offer_id", vocab_size: int = 20000) -> Features:
    """TF-IDF, standardised numbers and one-hot categories, fitted on ``train``
    and written once for both sides: every estimator and optimizer iteration
    reads the written rows."""
    def prep(d):
        return d.select(key, LABEL, TEXT, *NUMERIC,
                        *[F.coalesce(F.col(c), F.lit(NULL_CATEGORY)).alias(c) for c in CATEGORICAL])
    from offerlens.session import materialize
    train, test = materialize(prep(train), "train"), materialize(prep(test), "test")
    n_train = train.count()
    train, test = _standardize_with(train, [test], NUMERIC)
    text_model = tfidf_vectors(train, TEXT, out="text_vec", min_df=2, max_features=vocab_size)
    train, test = text_model.transform(train), text_model.transform(test)
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep") for c in CATEGORICAL]
    ohe = OneHotEncoder(inputCols=[f"{c}_idx" for c in CATEGORICAL], outputCols=[f"{c}_ohe" for c in CATEGORICAL],
                        handleInvalid="keep", dropLast=True)  # unseen -> all zeros
    label = StringIndexer(inputCol=LABEL, outputCol="label", handleInvalid="keep")
    asm = VectorAssembler(inputCols=["text_vec", *[f"std_{c}" for c in NUMERIC], *[f"{c}_ohe" for c in CATEGORICAL]],
                          outputCol="features")
    feats = Pipeline(stages=[*idx, ohe, label, asm]).fit(train)
    cols = [key, LABEL, "label", "features"]
    return Features(materialize(feats.transform(train).select(*cols), "train_features"),
                    materialize(feats.transform(test).select(*cols), "test_features"),
                    feats.stages[len(idx) + 1].labels, n_train)


def fit_predict(train: DataFrame, test: DataFrame, model: str, key: str = "offer_id",
                vocab_size: int = 20000, seed: int = 42, features: Features | None = None) -> DataFrame:
    """Fit ``model`` on ``train`` (or on ready ``features``); predict ``test``.
    Returns (key, salary_category, prediction)."""
    f = features or prepare_features(train, test, key, vocab_size)
    clf = make_classifier(model, f.n_train, seed)
    clf.setFeaturesCol("features").setLabelCol("label").setPredictionCol("pred_idx")
    out = clf.fit(f.train).transform(f.test)
    back = IndexToString(inputCol="pred_idx", outputCol="prediction", labels=f.labels)
    return back.transform(out).select(key, LABEL, "prediction")


def classification_report(pred: DataFrame, y: str = LABEL, p: str = "prediction") -> DataFrame:
    """Per-class precision / recall / F1 / support, then accuracy, macro and
    weighted averages (sklearn's layout; the accuracy row carries the value
    in ``f1_score``).  Built from the (true, predicted) count table, whose
    size is bounded by classes squared."""
    conf = pred.groupBy(y, p).agg(F.count(F.lit(1)).alias("n"))
    tp = conf.where(F.col(y) == F.col(p)).select(F.col(y).alias("cls"), F.col("n").alias("tp"))
    sup = conf.groupBy(y).agg(F.sum("n").alias("support")).withColumnRenamed(y, "cls")
    prd = conf.groupBy(p).agg(F.sum("n").alias("predicted")).withColumnRenamed(p, "cls")
    per = (sup.join(prd, "cls", "full").join(tp, "cls", "left").na.fill(0, ["tp", "support", "predicted"])
           .where(F.col("support") > 0))
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("predicted")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp"), F.col("support")), F.lit(0.0))
    per = per.select(F.col("cls").alias("row"), prec.alias("precision"), rec.alias("recall"), "support")
    per = per.withColumn("f1_score", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                                             F.col("precision") + F.col("recall")), F.lit(0.0)))
    tot = per.agg(F.sum("support").alias("total"), F.avg("precision").alias("mp"), F.avg("recall").alias("mr"),
                  F.avg("f1_score").alias("mf"),
                  (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
                  (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
                  (F.sum(F.col("f1_score") * F.col("support")) / F.sum("support")).alias("wf"))
    acc = tp.agg(F.sum("tp").alias("correct")).crossJoin(tot)
    rows = [
        acc.select(F.lit("accuracy").alias("row"), F.lit(None).cast("double").alias("precision"),
                   F.lit(None).cast("double").alias("recall"),
                   (F.col("correct") / F.col("total")).alias("f1_score"), F.col("total").alias("support")),
        acc.select(F.lit("macro avg").alias("row"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                   F.col("mf").alias("f1_score"), F.col("total").alias("support")),
        acc.select(F.lit("weighted avg").alias("row"), F.col("wp").alias("precision"), F.col("wr").alias("recall"),
                   F.col("wf").alias("f1_score"), F.col("total").alias("support")),
    ]
    out = per.select("row", "precision", "recall", "f1_score", "support")
    for r in rows:
        out = out.unionByName(r)
    return out


def compare_models(spark: SparkSession, train: DataFrame, test: DataFrame, models=MODELS,
                   key: str = "offer_id") -> DataFrame:
    """(model, accuracy) for each model, fitted on the same split and features."""
    features, res = prepare_features(train, test, key), []
    for m in models:
        pr = fit_predict(train, test, m, key, features=features)
        acc = pr.agg(F.avg((F.col(LABEL) == F.col("prediction")).cast("double")).alias("a")).first()["a"]
        res.append((m, float(acc)))
    return spark.createDataFrame(res, "model STRING, accuracy DOUBLE")
