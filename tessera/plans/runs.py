"""Whole runs: dry-run plans, input checks, training sets, evaluation.

Training and generation stay outside: a training set ends as Parquet, an evaluation begins with
stored predictions and stored completion scores.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import contracts, encoding, kernels, metrics, sampling, vocab
from tessera.operators.contracts import PreferenceFields, ResponseFields
from tessera.session import materialize
from tessera.sources import models, registry, sinks
from tessera.sources.config import Settings

#: What a dry run shows, as paths into the configuration.
PLANS = {
    "response": "model data formatting.mode training.max_length training.per_device_train_batch_size training.gradient_accumulation_steps training.learning_rate training.num_train_epochs training.bf16 training.gradient_checkpointing training.max_steps training.max_train_samples output",
    "logit": "teacher student data formatting.mode distillation compatibility hardware output",
    "preference": "source data training output",
    "evaluation": "models data preference_data formatting.mode generation output",
    "export": "model model_card.output_path model_card.distillation_type model_card.dpo_applied export",
}


def plan(kind: str, config: Settings) -> dict[str, Any]:
    """Flat view of what a run would do; keys are paths."""

    def flat(prefix: str, v: Any) -> dict[str, Any]:
        if isinstance(v, Settings):
            v = v.as_dict()
        if isinstance(v, dict):
            return {k: x for name, item in v.items() for k, x in flat(f"{prefix}.{name}", item).items()}
        if isinstance(v, list) and v and isinstance(v[0], Settings):
            return {k: x for i, item in enumerate(v) for k, x in flat(f"{prefix}[{i}]", item).items()}
        return {prefix: v}

    out: dict[str, Any] = {}
    for path in PLANS[kind].split():
        node: Any = config
        for part in path.split("."):
            node = getattr(node, part)
        out |= flat(path, node)
    if "training" in config._values or "distillation" in config._values:
        t = config.training if "training" in config._values else config.distillation
        out["effective_batch_size"] = t.per_device_train_batch_size * t.gradient_accumulation_steps
    return out


def response_fields(data: Settings) -> ResponseFields:
    return ResponseFields(data.prompt_field, data.response_field, data.id_field, data.metadata_field, data.dataset_split)


def eval_fields(data: Settings) -> ResponseFields:
    """The evaluation's view of response data: the reference is the response, without metadata."""
    return ResponseFields(data.prompt_field, data.reference_field, data.id_field, None, data.dataset_split)


def preference_fields(data: Settings, metadata: bool = True) -> PreferenceFields:
    return PreferenceFields(data.prompt_field, data.chosen_field, data.rejected_field, data.id_field, data.metadata_field if metadata else None, data.dataset_split)


def load(spark: SparkSession, data: Settings) -> DataFrame:
    return registry.load(spark, data.dataset_id, data.dataset_split, data.dataset_config_name)


def inspect(df: DataFrame, fields: contracts.Fields, limit: int | None = None) -> dict[str, Any]:
    """Checks the rows and returns their summary; raises the first violation.  One pass for both."""
    checked = contracts.check_rows(df, fields, limit)
    both = contracts.summary(df, checked, limit is None).crossJoin(checked.agg(F.min_by("violation", F.when(F.col("violation").isNotNull(), F.col(fields.row_index))).alias("code"), F.min(F.when(F.col("violation").isNotNull(), F.col(fields.row_index))).alias("at")))
    r = both.collect()[0]  # one row
    if r.code is not None:
        raise contracts.ContractError(f"row {r['at']}: {r.code}")
    out = {"row_count": r.row_count, "inspected_rows": r.inspected_rows, "unique_ids": r.unique_ids, "column_names": sorted(df.columns)}
    return out | ({"format": contracts.dataset_format(df, fields)} if isinstance(fields, PreferenceFields) else {})


def validate_inputs(spark: SparkSession, kind: str, config: Settings, limit: int | None = None, catalog: models.Catalog | None = None) -> dict[str, Any]:
    """Everything a run needs, without running it: model references resolve, tokenizers agree where
    the run asks for it, and the data keeps its contract."""
    out: dict[str, Any] = {}
    if kind == "response":
        refs = {"model": (config.model.model_name_or_path, config.model.revision), "tokenizer": (config.model.tokenizer_name_or_path, config.model.revision)}
    elif kind == "preference":
        refs = {"model": (config.source.checkpoint_path, config.source.revision), "tokenizer": (config.source.tokenizer_path, config.source.revision)}
    elif kind == "logit":
        refs = {n: (getattr(config, n).checkpoint_path, getattr(config, n).revision) for n in ("teacher", "student")}
        if config.compatibility.require_same_tokenizer:
            vocab.require_compatible(spark, config.teacher.tokenizer_path, config.student.tokenizer_path)
    else:
        refs = {m.name: (m.model_name_or_path, m.revision) for m in config.models}
    out["models"] = {n: vars(models.resolve(ref, rev, catalog)) for n, (ref, rev) in refs.items()}
    fields = {"preference": preference_fields, "evaluation": eval_fields}.get(kind, response_fields)(config.data)
    df = load(spark, config.data)
    out["data"] = inspect(df, fields, limit)
    if kind == "evaluation":
        if out["data"]["inspected_rows"] == 0:
            raise contracts.ContractError("evaluation data must have at least one row")
        out["preference_data"] = inspect(load(spark, config.preference_data), preference_fields(config.preference_data, metadata=False), limit)
    return out


def _limited(df: DataFrame, limit: int | None) -> DataFrame:
    """The training prefix, after the whole source was checked."""
    if limit is None:
        return df
    numbered = encoding.positions(df.withColumn("__all", F.lit(1)), ["__all"], "row_index")
    return sampling.prefix_limit(numbered, limit, "position").drop("position", "__all")


def _valid_rows(df: DataFrame, fields: contracts.Fields, limit: int | None) -> DataFrame:
    """The training prefix of canonical rows.  The source is checked once, as a whole: its checked rows
    are written, then looked at for the first violation."""
    checked = materialize(contracts.check_rows(df, fields), "checked")
    for r in contracts.first_violation(checked, fields.row_index).collect():  # at most one row
        raise contracts.ContractError(f"row {r.row_index}: {r.code}")
    return _limited(contracts.renamed(checked, fields), limit)


def response_training_set(df: DataFrame, data: Settings, formatting: Settings, settings: Settings, tokenizer: encoding.Tokenizer, max_train_samples: int | None = None) -> DataFrame:
    """(input_ids, attention_mask, labels) of a response or logit run: checked, limited, encoded.
    An explicit ``max_train_samples`` beats the configured one."""
    rows = _valid_rows(df, response_fields(data), settings.max_train_samples if max_train_samples is None else max_train_samples)
    encoded = encoding.encode_records(rows, tokenizer, settings.max_length, formatting.mode, formatting.system_prompt)
    if formatting.mode == "chat":
        encoded = materialize(encoded, "encoded")
    if formatting.mode == "chat" and not encoded.where("NOT stable").isEmpty():
        raise ValueError("the chat template doesn't keep the prompt as a prefix of the conversation")
    return encoded.select("input_ids", "attention_mask", "labels")


def preference_training_set(df: DataFrame, data: Settings, settings: Settings, max_train_samples: int | None = None) -> DataFrame:
    """(prompt, chosen, rejected) of a preference run."""
    limit = settings.max_train_samples if max_train_samples is None else max_train_samples
    return _valid_rows(df, preference_fields(data), limit).select("prompt", "chosen", "rejected")


def evaluation_samples(df: DataFrame, data: Settings, limit: int, seed: int) -> DataFrame:
    """(id, prompt, reference) of the seeded sample; the selected rows are checked, not the first."""
    fields = eval_fields(data)
    chosen = sampling.reindexed(sampling.seeded_sample(df, limit, seed), data.dataset_split)
    contracts.require_valid(chosen, fields)
    ids = F.col("generated_id") if data.id_field is None else F.col(data.id_field).cast("string")
    return chosen.select(ids.alias("id"), F.col(data.prompt_field).cast("string").alias("prompt"), F.col(data.reference_field).cast("string").alias("reference"))


def evaluate(samples: DataFrame, predictions: DataFrame, scores: DataFrame, baseline: str) -> tuple[DataFrame, DataFrame]:
    """(metrics, comparisons) of all models at once.

    ``predictions`` is (model, id, prediction), ``scores`` (model, id, chosen, rejected), the
    completions' log-probabilities."""
    pairs = metrics.samples_with_predictions(samples.select("id", "reference"), predictions)
    wins = scores.groupBy("model").agg(F.count("*").alias("preference_pairs"), kernels.win_rate(F.col("chosen"), F.col("rejected")).alias("preference_accuracy"))
    result = materialize(metrics.metrics_by_model(pairs).join(wins, "model", "left"), "metrics")  # one row a model
    return result, metrics.comparisons(result, baseline, (*metrics.METRICS[:4], "preference_accuracy"))


def preference_records(df: DataFrame, data: Settings, limit: int, seed: int) -> DataFrame:
    """The seeded sample of preference records, checked and under canonical names."""
    fields = preference_fields(data, metadata=False)
    chosen = sampling.seeded_sample(df, limit, seed)
    contracts.require_valid(chosen, fields)
    return contracts.canonical(chosen, fields)


def run_evaluation(spark: SparkSession, config: Settings, predictions: DataFrame, scores: DataFrame, limit: int | None = None) -> dict[str, Any]:
    """Samples of both datasets, metrics, comparisons, and both sinks.  Scores count of the sampled
    preference records only, by their id."""
    g = config.generation
    n = g.limit if limit is None else limit
    if n <= 0:
        raise ValueError("limit must be positive")
    samples = evaluation_samples(load(spark, config.data), config.data, n, g.seed)
    named = [m.name for m in config.models]
    chosen = predictions.where(F.col("model").isin(named))
    records = materialize(preference_records(load(spark, config.preference_data), config.preference_data, n, g.seed).select("id"), "preference-sample")
    n_pairs, examples = records.count(), samples.count()
    if not n_pairs:
        raise ValueError("preference data must have at least one row")
    scored = scores.where(F.col("model").isin(named)).join(F.broadcast(records), "id")
    result, compared = evaluate(samples, chosen, scored, named[0])
    out = {
        "dataset_id": config.data.dataset_id,
        "dataset_split": config.data.dataset_split,
        "examples": examples,
        "preference_pairs": n_pairs,
        "results_path": config.output.results_path,
    } | sinks.evaluation_results(result, compared, {m.name: m.model_name_or_path for m in config.models}, config.output.predictions_dir)
    rows = metrics.unique_predictions(chosen).join(samples, "id").withColumn("prediction", F.coalesce("prediction", F.lit("")))
    sinks.write_predictions(rows, config.output.predictions_dir)
    sinks.write_results(config.output.results_path, out)
    return out
