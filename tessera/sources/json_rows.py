"""Records delivered as JSON objects, one per row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def canonical_payloads(df: DataFrame, fields: dict[str, tuple[str, str]], payload: str = "payload", dataset: str = "dataset_id") -> DataFrame:
    """Adds ``readable``, ``prompt`` and ``response``: the two fields that each dataset is mapped to.

    The payload is parsed once, strictly; what isn't a JSON object isn't readable and has null
    fields, as has a dataset without a mapping."""
    parsed = F.try_parse_json(F.col(payload))
    rows = df.withColumn("__v", F.when(F.schema_of_variant(parsed).startswith("OBJECT"), parsed))
    prompt = response = F.lit(None).cast("string")
    for name, (p, r) in fields.items():
        mine = F.col(dataset) == name
        prompt = F.when(mine, F.try_variant_get("__v", f"$.{p}", "string")).otherwise(prompt)
        response = F.when(mine, F.try_variant_get("__v", f"$.{r}", "string")).otherwise(response)
    return rows.withColumn("readable", F.col("__v").isNotNull()).withColumn("prompt", prompt).withColumn("response", response).drop("__v")
