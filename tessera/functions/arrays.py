"""Array functions: truncation, masking, padding and numeric kernels over stored arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Label of positions that are not supervised (a fixed value of the trainers' convention).
IGNORED = -100


def _repeat(value: int, n: Column) -> Column:
    return F.array_repeat(F.lit(value), n.cast("int"))


def truncate_prompt(ids: Column, budget: Column) -> Column:
    """At most ``budget`` ids: all, none, the last, or the first and the last ones."""
    tail = F.slice(ids, F.size(ids) - (budget - 2), budget - 1)
    return (
        F.when(F.size(ids) <= budget, ids)
        .when(budget <= 0, F.slice(ids, 1, 0))
        .when(budget == 1, F.slice(ids, -1, 1))
        .otherwise(F.concat(F.slice(ids, 1, 1), F.when(budget > 1, tail)))
    )


def with_eos(ids: Column, eos: int) -> Column:
    return F.when((F.size(ids) > 0) & (F.try_element_at(ids, F.lit(-1)) == eos), ids).otherwise(F.concat(ids, F.array(F.lit(eos))))


def encode_pair(prompt_ids: Column, response_ids: Column, eos: int, max_length: Column) -> Column:
    """struct(input_ids, attention_mask, labels): the response closed by the end mark, cut if it
    fills the sequence, else with as much of the prompt as fits; prompt positions are not supervised.

    One transform over a one-element array binds each step once, so no expression is repeated."""
    step1 = F.array(F.struct(prompt_ids.alias("p"), with_eos(response_ids, eos).alias("r"), max_length.alias("m")))
    cut = lambda x: F.concat(F.slice(x["r"], 1, x["m"] - 1), F.array(F.lit(eos)))
    step2 = F.transform(
        step1,
        lambda x: F.struct(
            F.when(F.size(x["r"]) >= x["m"], F.slice(x["p"], 1, 0)).otherwise(truncate_prompt(x["p"], x["m"] - F.size(x["r"]))).alias("p"),
            F.when(F.size(x["r"]) >= x["m"], cut(x)).otherwise(x["r"]).alias("r"),
        ),
    )
    step3 = F.transform(
        step2,
        lambda x: F.struct(
            F.concat(x["p"], x["r"]).alias("input_ids"),
            _repeat(1, F.size(x["p"]) + F.size(x["r"])).alias("attention_mask"),
            F.concat(_repeat(IGNORED, F.size(x["p"])), x["r"]).alias("labels"),
        ),
    )
    return F.element_at(step3, 1)


def pad(ids: Column, width: Column, value: int, side: str = "right") -> Column:
    fill = _repeat(value, width - F.size(ids))
    return F.concat(ids, fill) if side == "right" else F.concat(fill, ids)


def log_sum_exp(x: Column) -> Column:
    top = F.array_max(x)
    return top + F.ln(F.aggregate(x, F.lit(0.0), lambda acc, v: acc + F.exp(v - top)))


def log_softmax(x: Column, temperature: float = 1.0) -> Column:
    """Log-probabilities of an array of logits, shifted by its maximum."""
    bound = F.transform(F.array(F.transform(x, lambda v: v / temperature)), lambda s: F.struct(s.alias("s"), log_sum_exp(s).alias("z")))
    return F.element_at(F.transform(bound, lambda b: F.transform(b["s"], lambda v: v - b["z"])), 1)


def kl_divergence(log_teacher: Column, log_student: Column) -> Column:
    """KL(teacher || student) of two arrays of log-probabilities."""
    return F.aggregate(F.zip_with(log_teacher, log_student, lambda t, s: F.exp(t) * (t - s)), F.lit(0.0), lambda acc, v: acc + v)


def label_log_prob(logits: Column, label: Column) -> Column:
    return F.element_at(logits, (label + 1).cast("int")) - log_sum_exp(logits)
