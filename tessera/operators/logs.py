"""Compact lines of training logs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import format_metric

# Keys of trainers' logs and the labels they are shown under.
USEFUL = ("loss", "learning_rate", "grad_norm", "rewards/margins", "loss/hard", "loss/soft_kl")
COMMON = (("epoch", "epoch"), ("loss", "loss"), ("learning_rate", "lr"), ("grad_norm", "grad"))
REWARD = (("rewards/chosen", "chosen"), ("rewards/rejected", "rejected"), ("rewards/margins", "margin"), ("rewards/accuracies", "accuracy"), ("entropy", "entropy"))
COMPONENTS = (("loss/hard", "hard"), ("loss/soft_kl", "soft_kl"))


def log_line(stage: Column, step: Column, max_steps: Column, logs: Column) -> Column:
    """One line of an event, parts joined by bars; null for an event without a useful key."""
    has = lambda k: F.coalesce(F.map_contains_key(logs, k), F.lit(False))
    shown = lambda pairs: [F.when(has(k), F.concat(F.lit(f"{label} "), format_metric(logs[k]))) for k, label in pairs]
    progress = F.concat(F.lit("["), stage, F.lit("] step "), step.cast("string"), F.when(max_steps > 0, F.concat(F.lit("/"), max_steps.cast("string"))).otherwise(F.lit("")))
    reward = F.when(has("rewards/margins"), F.concat_ws(" | ", F.lit("reward"), *shown(REWARD)))
    parts = F.when(~has("rewards/margins") & (has("loss/hard") | has("loss/soft_kl")), F.concat_ws(" | ", F.lit("components"), *shown(COMPONENTS)))
    useful = F.lit(False)
    for k in USEFUL:
        useful = useful | has(k)
    return F.when(useful, F.concat_ws(" | ", progress, *shown(COMMON), reward, parts))
