"""Text classification: exact stratified split, trained model, keyword rules, metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IndexToString, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewatch.fixed_values import KEYWORD_DEFAULT, KEYWORD_RULES
from casewatch.functions.columns import contains_any, first_match
from casewatch.operators.text_features import fit_tfidf
from casewatch.sources.files import stored

SPLIT_DIGITS = 4  # hash digits by which a bucket is cut at a time
EDGE_ROWS = 100_000  # rows that one task may order


def stratified_split(df: DataFrame, label: str, key: str, test: float = 0.2, seed: int = 42) -> DataFrame:
    """The input with ``is_train``; exactly ``floor((1 - test) * n)`` rows of each class are train rows.

    Rows are ordered by a seeded hash of their key, and the first ones of each class are the
    test rows. A class is never sorted as a whole: hash buckets are counted, the bucket in
    which the quota runs out is found from the counts, and that bucket is cut by further digits until it
    is small; only then it is ordered. The resulting threshold, one row per class, is joined back to the rows.

    The two per-class tables are stored first. Their size is then known, so the rows, hot
    class or not, are joined in place instead of being shuffled by class.
    """
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{seed}")))
    order = F.concat(digest, F.lit("/"), F.col(key).cast("string"))
    keys = df.select(F.col(label), order.alias("_order"))
    over_class = Window.partitionBy(label)
    sizes = keys.groupBy(label).agg(F.count("*").alias("_n"))
    quota = (F.col("_n") - F.floor(F.col("_n") * (1 - test) + 1e-9)).alias("_take")
    edge = stored(sizes.select(F.col(label).alias("_edge_class"), F.lit("").alias("_edge"), quota, F.col("_n").alias("_in")).filter("_take > 0"), "split-edge")
    digits = 0
    while True:
        in_edge = F.col(label).eqNullSafe(F.col("_edge_class")) & (F.substring("_order", 1, digits) == F.col("_edge"))
        inside = keys.join(edge, in_edge)
        if digits >= 32 or (edge.agg(F.max("_in")).first()[0] or 0) <= EDGE_ROWS:
            break
        digits += SPLIT_DIGITS
        buckets = inside.groupBy(label, F.substring("_order", 1, digits).alias("_bucket")).agg(F.count("*").alias("_in"), F.first("_take").alias("_take"))
        buckets = buckets.withColumn("_upto", F.sum("_in").over(over_class.orderBy("_bucket"))).filter("_upto >= _take AND _upto - _in < _take")
        edge = stored(buckets.select(F.col(label).alias("_edge_class"), F.col("_bucket").alias("_edge"), F.expr("_take - _upto + _in").alias("_take"), "_in"), "split-edge")
    threshold = (
        inside.withColumn("_at", F.row_number().over(over_class.orderBy("_order")))
        .filter(F.col("_at") == F.col("_take"))
        .select(F.col(label).alias("_class"), F.col("_order").alias("_last_test"))
    )
    threshold = stored(threshold, "split-threshold")
    is_train = F.coalesce(order > F.col("_last_test"), F.lit(True))
    return (
        df.join(threshold, F.col(label).eqNullSafe(F.col("_class")), "left")
        .withColumn("is_train", is_train)
        .select(*df.columns, "is_train")
    )


def train_classifier(
    train: DataFrame,
    text: str = "complaint_text",
    channel: str = "channel",
    label: str = "complaint_category",
    vocab: int = 500,
    C: float = 1.0,
    max_iter: int = 1000,
    tol: float = 1e-4,
) -> PipelineModel:
    """Multinomial logistic regression on TF-IDF of the text and the one-hot channel.

    The returned model scores frames without a label column; an unseen channel counts as none.
    ``train`` is read several times: hand over a stored table.
    """
    tfidf = fit_tfidf(train, text, vocab)
    channels = StringIndexer(inputCol=channel, outputCol="channel_index", handleInvalid="keep", stringOrderType="alphabetAsc").fit(train)
    labels = StringIndexer(inputCol=label, outputCol="label_index", stringOrderType="alphabetAsc").fit(train)
    onehot = OneHotEncoder(inputCol="channel_index", outputCol="channel_onehot", dropLast=True).fit(channels.transform(train.limit(1)))
    assembler = VectorAssembler(inputCols=["tfidf", "channel_onehot"], outputCol="features")
    features = PipelineModel([*tfidf.stages, channels, onehot, assembler])
    ready = labels.transform(features.transform(train)).select("features", "label_index")
    regression = LogisticRegression(
        featuresCol="features",
        labelCol="label_index",
        family="multinomial",
        elasticNetParam=0.0,
        regParam=1.0 / (C * train.count()),
        standardization=False,
        maxIter=max_iter,
        tol=tol,
    ).fit(ready)
    names = IndexToString(inputCol="prediction", outputCol="predicted_category", labels=labels.labels)
    return PipelineModel([*features.stages, regression, names])


_WORK = ["tfidf_tokens", "tfidf_terms", "tfidf_counts", "tfidf_raw", "tfidf", "channel_index", "channel_onehot",
         "features", "rawPrediction", "prediction"]


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """The input with ``predicted_category`` and ``confidence`` (top probability in percent)."""
    top = F.bround(F.array_max(vector_to_array("probability")) * 100, 1)
    return model.transform(df).withColumn("confidence", top).drop(*_WORK, "probability")


def class_probabilities(model: PipelineModel, df: DataFrame, key: str) -> DataFrame:
    """``key, category, probability`` for every class."""
    names = F.array(*[F.lit(v) for v in model.stages[-1].getLabels()])
    pairs = F.arrays_zip(names.alias("category"), vector_to_array("probability").alias("probability"))
    return model.transform(df).select(key, F.inline(pairs)).toDF(key, "category", "probability")


def keyword_classify(
    df: DataFrame, key: str, text: str, rules: Sequence[tuple[str, list[str]]] = KEYWORD_RULES, default: str = KEYWORD_DEFAULT
) -> DataFrame:
    """``key, predicted_category`` by the first rule with a word in the lower-cased text."""
    lowered = df.select(key, F.lower(text).alias("_text"))
    conditions = [(name, contains_any(F.col("_text"), words)) for name, words in rules]
    return lowered.select(key, first_match(conditions, default).alias("predicted_category"))


# --- metrics --------------------------------------------------------------------------------


def confusion_counts(pred: DataFrame, label: str = "label", prediction: str = "predicted_category") -> DataFrame:
    return pred.groupBy(F.col(label).alias("label"), F.col(prediction).alias("predicted")).agg(F.count("*").alias("n"))


def confusion_matrix(pred: DataFrame, classes: Sequence[str], label: str = "label", prediction: str = "predicted_category") -> DataFrame:
    """One row per actual class, one column per predicted class; ``other`` counts all further predictions."""
    named = F.when(F.col("predicted").isin(list(classes)), F.col("predicted")).otherwise(F.lit("other"))
    counts = confusion_counts(pred, label, prediction).withColumn("_named", named)
    return counts.groupBy("label").pivot("_named", [*classes, "other"]).agg(F.sum("n")).fillna(0)


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def classification_report(pred: DataFrame, label: str = "label", prediction: str = "predicted_category") -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy and the two averages.

    Predictions are counted once into class pairs; everything else is arithmetic on those.
    """
    n, hit = F.col("n"), F.col("label") == F.col("predicted")
    zero = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("label").alias("class"), n.alias("actual"), zero.alias("guessed"), F.when(hit, n).otherwise(zero).alias("tp")),
        F.struct(F.col("predicted").alias("class"), zero.alias("actual"), n.alias("guessed"), zero.alias("tp")),
    )
    per_class = (
        confusion_counts(pred, label, prediction)
        .select(F.inline(sides))
        .groupBy("class")
        .agg(F.sum("actual").alias("support"), F.sum("guessed").alias("guessed"), F.sum("tp").alias("tp"))
        .withColumns({"precision": _ratio(F.col("tp"), F.col("guessed")), "recall": _ratio(F.col("tp"), F.col("support"))})
        .withColumn("f1", _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    )
    measures = ["precision", "recall", "f1"]
    whole = per_class.agg(
        F.sum("support").alias("support"),
        F.sum("tp").alias("tp"),
        *[F.avg(m).alias(f"macro_{m}") for m in measures],
        *[F.sum(F.col(m) * F.col("support")).alias(f"weighted_{m}") for m in measures],
    )
    accuracy = _ratio(F.col("tp"), F.col("support"))
    summary = F.array(
        F.struct(F.lit("accuracy").alias("label"), *[accuracy.alias(m) for m in measures], "support"),
        F.struct(F.lit("macro avg").alias("label"), *[F.col(f"macro_{m}").alias(m) for m in measures], "support"),
        F.struct(
            F.lit("weighted avg").alias("label"),
            *[_ratio(F.col(f"weighted_{m}"), F.col("support")).alias(m) for m in measures],
            "support",
        ),
    )
    return per_class.select(F.col("class").alias("label"), *measures, "support").unionByName(whole.select(F.inline(summary)))
