"""Sinks: prediction lines, nested results."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PREDICTION_FIELDS = ("id", "prompt", "reference", "prediction")


def prediction_lines(predictions: DataFrame) -> DataFrame:
    """(model, id, line): one JSON object a prediction, fields in a fixed order, nulls kept, other
    scripts unescaped."""
    line = F.to_json(F.struct(*PREDICTION_FIELDS), {"ignoreNullFields": "false"})
    return predictions.select("model", "id", line.alias("line"))


def write_predictions(predictions: DataFrame, path: str) -> None:
    """One folder for each model, one JSON object a line."""
    lines = prediction_lines(predictions).select("model", F.col("line").alias("value"))
    lines.write.mode("overwrite").partitionBy("model").text(path)


def write_results(path: str, results: dict) -> None:
    """A bounded nested result: sorted keys, two blanks a level."""
    p = Path(path)
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_text(json.dumps(results, indent=2, sort_keys=True, ensure_ascii=False) + "\n", encoding="utf-8")


def evaluation_results(metrics: DataFrame, comparisons: DataFrame, models: dict[str, str], predictions_dir: str) -> dict:
    """Models and comparisons as nested records in the configured order; ``models`` is their names and
    references.  A model without a row has no predictions and is left out."""
    rows = {r.model: r.asDict() for r in metrics.collect()}  # one row a model
    deltas = {r.model: r.asDict() for r in comparisons.collect()}
    out = []
    for name, reference in models.items():
        if name in rows:
            r = rows[name]
            pairs, accuracy = r.pop("preference_pairs"), r.pop("preference_accuracy")
            r.pop("model")
            out.append({"name": name, "model_name_or_path": reference, "predictions_path": f"{predictions_dir}/model={name}", "metrics": r, "preference_pairs": pairs, "preference_accuracy": accuracy})
    return {"models": out, "comparisons": [deltas[n] for n in models if n in deltas]}
