"""Numeric kernels over stored logits and log-probabilities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.arrays import IGNORED, kl_divergence, label_log_prob, log_softmax, log_sum_exp


def supervised(df: DataFrame, seq: str = "seq", pos: str = "pos", label: str = "label") -> DataFrame:
    """Positions that predict a supervised label: the logits at a position score the next one's."""
    w = Window.partitionBy(seq).orderBy(pos)  # a sequence is bounded by its maximal length
    return df.withColumn("target", F.lead(label).over(w)).where(F.col("target") != IGNORED)


def token_losses(df: DataFrame, temperature: float) -> DataFrame:
    """Adds ``kl`` (teacher to student at the temperature) and ``nll`` (student, temperature 1)."""
    logs = df.withColumn("__s", log_softmax(F.col("student"), temperature)).withColumn("__t", log_softmax(F.col("teacher"), temperature))
    return logs.withColumn("kl", kl_divergence(F.col("__t"), F.col("__s"))).withColumn("nll", -label_log_prob(F.col("student"), F.col("target"))).drop("__s", "__t")


def distillation_loss(losses: DataFrame, batch: str, temperature: float, alpha: float) -> DataFrame:
    """Per batch: hard loss, soft loss (T squared times the mean over all supervised tokens) and
    their mixture.  A batch without supervised tokens has no row: see ``empty_batches``."""
    soft = F.avg("kl") * temperature * temperature
    out = losses.groupBy(batch).agg(F.count("*").alias("n_tokens"), F.avg("nll").alias("hard_loss"), soft.alias("soft_loss"))
    return out.withColumn("loss", alpha * F.col("hard_loss") + (1 - alpha) * F.col("soft_loss"))


def require_supervised(df: DataFrame, losses: DataFrame, batch: str) -> None:
    """Raises the least batch without a supervised token."""
    for r in empty_batches(df, losses, batch).agg(F.min(batch).alias("b")).where("b IS NOT NULL").collect():  # at most one row
        raise ValueError(f"batch {r.b} has no supervised token")


def preference_loss(policy_chosen: Column, policy_rejected: Column, reference_chosen: Column, reference_rejected: Column, beta: float) -> Column:
    """Sigmoid preference loss over stored log-probabilities: -ln(sigmoid(beta * margin)), computed
    without overflow."""
    x = F.lit(float(beta)) * ((policy_chosen - policy_rejected) - (reference_chosen - reference_rejected))
    return F.log1p(F.exp(-F.abs(x))) + F.greatest(-x, F.lit(0.0))


def empty_batches(df: DataFrame, losses: DataFrame, batch: str) -> DataFrame:
    """Batches without a supervised token: an error of the run, to be raised by the caller."""
    return df.select(batch).distinct().join(losses.select(batch).distinct(), batch, "left_anti")


def conditional_log_prob(full_ids: Column, prompt_ids: Column, logits: Column, max_length: int) -> Column:
    """struct(score, violation): the sum of the completion's token log-probabilities after cutting
    the conversation to ``max_length``; the violation says why there is none."""
    ids = F.slice(full_ids, 1, max_length)
    stable = F.slice(full_ids, 1, F.size(prompt_ids)) == prompt_ids
    n = F.size(ids)
    pairs = F.zip_with(F.slice(logits, 1, F.greatest(n - 1, F.lit(0))), F.slice(ids, 2, F.greatest(n - 1, F.lit(0))), lambda v, y: F.element_at(v, y + 1) - log_sum_exp(v))
    chosen = F.filter(pairs, lambda v, i: i >= F.greatest(F.size(prompt_ids) - 1, F.lit(0)))
    score = F.aggregate(chosen, F.lit(0.0), lambda acc, v: acc + v)
    problem = F.when(~stable, "prompt_not_prefix").when(F.size(prompt_ids) >= n, "no_completion")
    return F.struct(F.when(problem.isNull(), score).alias("score"), problem.alias("violation"))


def win_rate(chosen: Column, rejected: Column) -> Column:
    """Mean of 1 for a win, one half for a tie, 0 for a loss."""
    return F.avg(F.when(chosen > rejected, 1.0).when(chosen == rejected, 0.5).otherwise(0.0))


def loss_windows(df: DataFrame, keys: list[str], step: str, every: int, values: list[str]) -> DataFrame:
    """Means over tumbling windows of ``every`` steps, from step 1; nulls and NaN don't count."""
    means = [F.avg(F.when(~F.isnan(v), F.col(v))).alias(v) for v in values]
    window = F.floor((F.col(step) - 1) / F.lit(every)).cast("bigint").alias("window")
    return df.groupBy(*keys, window).agg(F.count("*").alias("n_events"), *means)
