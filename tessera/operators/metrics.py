"""Evaluation metrics of stored predictions, for all models in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import f1_of, is_text, normalize_text, strip, token_f1, ws_tokens

METRICS = ("exact_match", "normalized_exact_match", "token_f1", "non_empty_rate", "average_output_characters")


def unique_predictions(predictions: DataFrame) -> DataFrame:
    """One row for each model and id: of repeated ones the least text, null last."""
    return predictions.groupBy("model", "id").agg(F.min("prediction").alias("prediction"))


def samples_with_predictions(samples: DataFrame, predictions: DataFrame) -> DataFrame:
    """(model, id, reference, prediction): an equi-join on the id; null predictions are empty.

    ``samples`` is (id, reference) with unique ids."""
    one = unique_predictions(predictions)
    return one.join(samples, "id").select("model", "id", "reference", F.coalesce("prediction", F.lit("")).alias("prediction"))


def scored(pairs: DataFrame) -> DataFrame:
    """Per prediction: exact, normalised exact, token F1, non-empty, characters.  Texts are
    normalised once, as a projection of its own."""
    norm = pairs.withColumn("__p", normalize_text(F.col("prediction"))).withColumn("__r", normalize_text(F.col("reference")))
    tokens = norm.withColumn("__pt", ws_tokens(F.col("__p"))).withColumn("__rt", ws_tokens(F.col("__r")))
    return tokens.select(
        "model",
        "id",
        (strip(F.col("prediction")) == strip(F.col("reference"))).cast("double").alias("exact_match"),
        (F.col("__p") == F.col("__r")).cast("double").alias("normalized_exact_match"),
        token_f1(F.col("__pt"), F.col("__rt")).alias("token_f1"),
        is_text(F.col("prediction")).cast("double").alias("non_empty_rate"),
        F.length("prediction").cast("double").alias("average_output_characters"),
    )


def metrics_by_model(pairs: DataFrame) -> DataFrame:
    """Means over a model's predictions; a model without any has no row."""
    return scored(pairs).groupBy("model").agg(F.count("*").alias("examples"), *(F.avg(m).alias(m) for m in METRICS))


def token_f1_by_id(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., token_f1) by counting and joining tokens: linear in long texts, where the array
    form compares every distinct token with all others."""
    norm = pairs.select(*keys, ws_tokens(normalize_text(F.col("prediction"))).alias("p"), ws_tokens(normalize_text(F.col("reference"))).alias("r"))
    sizes = norm.select(*keys, F.size("p").alias("np"), F.size("r").alias("nr"))
    count = lambda c: norm.select(*keys, F.explode(c).alias("t")).groupBy(*keys, "t").agg(F.count("*").alias(f"n_{c}"))
    both = count("p").join(count("r"), [*keys, "t"]).groupBy(*keys).agg(F.sum(F.least("n_p", "n_r")).alias("o"))
    return sizes.join(both, keys, "left").select(*keys, f1_of(F.coalesce("o", F.lit(0)), F.col("np"), F.col("nr")).alias("token_f1"))


def comparisons(metrics: DataFrame, baseline: str, columns: tuple[str, ...] = METRICS[:4]) -> DataFrame:
    """Every other model minus the baseline, in one pass: the metrics are one row a model, so the
    baseline's are found by a window over all of them.  Without the baseline there is no row."""
    over = Window.partitionBy(F.lit(1))
    is_base = F.col("model") == baseline
    rows = metrics.select("model", *columns, F.max(is_base).over(over).alias("__any"), *(F.max(F.when(is_base, F.col(c))).over(over).alias(f"__{c}") for c in columns))
    rows = rows.where(~is_base & F.col("__any"))
    return rows.select(F.lit(baseline).alias("baseline"), "model", *((F.col(c) - F.col(f"__{c}")).alias(f"{c}_delta") for c in columns))
