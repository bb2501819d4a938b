"""Row contracts: violations, first violation, canonical records and summaries as plans.

A contract is a list of (code, condition) in the order in which a row is checked; a row's violation
is the first that holds.  Nothing is raised inside a plan: the violation that comes first in source
order is computed as an aggregate, and raised on the driver by ``require_valid``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import generated_id, is_text


class ContractError(ValueError):
    """The first violation in source order."""


@dataclass(frozen=True)
class ResponseFields:
    prompt: str = "prompt"
    response: str = "response"
    id: str | None = "id"
    metadata: str | None = "metadata"
    split: str = "train"
    row_index: str = "row_index"

    def required(self) -> set[str]:
        return {self.prompt, self.response} | {c for c in (self.id, self.metadata) if c is not None}


@dataclass(frozen=True)
class PreferenceFields:
    prompt: str = "prompt"
    chosen: str = "chosen"
    rejected: str = "rejected"
    id: str | None = "id"
    metadata: str | None = "metadata"
    split: str = "train"
    row_index: str = "row_index"

    def required(self) -> set[str]:
        return {self.prompt, self.chosen, self.rejected} | {c for c in (self.id, self.metadata) if c is not None}


Fields = ResponseFields | PreferenceFields


def require_columns(df: DataFrame, fields: Fields) -> None:
    """Raises before any job if configured columns are absent."""
    missing = sorted(fields.required() - set(df.columns))
    if missing:
        raise ContractError(f"missing configured column(s): {', '.join(missing)}")


def record_id(fields: Fields) -> Column:
    if fields.id is None:
        return generated_id(F.lit(fields.split), F.col(fields.row_index))
    return F.col(fields.id)


def _id_check(fields: Fields) -> list[tuple[str, Column]]:
    return [] if fields.id is None else [("id", ~is_text(F.col(fields.id)))]


def _metadata_check(fields: Fields) -> list[tuple[str, Column]]:
    return [] if fields.metadata is None else [("metadata", F.col(fields.metadata).isNull())]


def response_checks(df: DataFrame, fields: ResponseFields) -> list[tuple[str, Column]]:
    return [
        ("prompt", ~is_text(F.col(fields.prompt))),
        ("response", ~is_text(F.col(fields.response))),
        *_id_check(fields),
        *_metadata_check(fields),
    ]


def value_format(dtype: T.DataType) -> str:
    """``standard`` for text, ``conversational`` for a list of messages, decided by the type."""
    if isinstance(dtype, T.StringType):
        return "standard"
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType) and {"role", "content"} <= set(dtype.elementType.names):
        return "conversational"
    return "unsupported"


def bad_message(messages: Column) -> Column:
    """Place (from 0) of the first message without a role or content, or -1."""
    ok = F.transform(messages, lambda m: m.isNotNull() & is_text(m["role"]) & is_text(m["content"]))
    return (F.coalesce(F.array_position(ok, False), F.lit(0)) - 1).cast("int")


def canonical_messages(messages: Column) -> Column:
    """Role and content only."""
    return F.transform(messages, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))


def preference_value_checks(name: str, c: Column, fmt: str) -> list[tuple[str, Column]]:
    if fmt == "standard":
        return [(name, ~is_text(c))]
    if fmt == "conversational":
        return [(name, c.isNull() | (F.size(c) == 0)), (f"{name}_message", bad_message(c) >= 0)]
    return [(name, F.lit(True))]


def preference_checks(df: DataFrame, fields: PreferenceFields) -> list[tuple[str, Column]]:
    names = (fields.prompt, fields.chosen, fields.rejected)
    formats = [value_format(df.schema[n].dataType) for n in names]
    checks = _id_check(fields)
    for n, label, fmt in zip(names, ("prompt", "chosen", "rejected"), formats, strict=True):
        checks += preference_value_checks(label, F.col(n), fmt)
    checks.append(("mixed_formats", F.lit(len(set(formats)) > 1)))
    if formats[1] == formats[2]:
        pair = (F.col(fields.chosen), F.col(fields.rejected))
        if formats[1] == "conversational":
            pair = tuple(canonical_messages(c) for c in pair)
        checks.append(("identical", pair[0].eqNullSafe(pair[1])))
    return [*checks, *_metadata_check(fields)]


def checks_of(df: DataFrame, fields: Fields) -> list[tuple[str, Column]]:
    require_columns(df, fields)
    return response_checks(df, fields) if isinstance(fields, ResponseFields) else preference_checks(df, fields)


def violation(checks: list[tuple[str, Column]]) -> Column:
    """Code of the first check that fails, or null."""
    return F.coalesce(*(F.when(F.coalesce(c, F.lit(True)), F.lit(code)) for code, c in checks))


def duplicate_ids(df: DataFrame, id_col: Column, order: Column) -> DataFrame:
    """Adds ``duplicate``: whether an earlier row, in source order, has the same id.

    A minimum by id is combined before the shuffle, so one frequent id is no hot spot, unlike a
    window over it; rows meet their id's minimum by a join that splits skewed keys.  Of rows that
    are equal in id and order, all but the first in source order count; null ids never do."""
    keyed = df.withColumn("__order", order).withColumn("__none", id_col.isNull())
    # Rows without an id have keys of their own, so that they spread over the tasks of the join.
    keyed = keyed.withColumn("__id", F.coalesce(id_col.cast("string"), F.col("__order").cast("string")))
    first = keyed.where("NOT __none").groupBy("__id", "__none").agg(F.min("__order").alias("__first"))
    late = F.coalesce(F.col("__order") > F.col("__first"), F.lit(False))
    return keyed.join(first, ["__id", "__none"], "left").withColumn("duplicate", late).drop("__id", "__none", "__order", "__first")


def check_rows(df: DataFrame, fields: Fields, limit: int | None = None) -> DataFrame:
    """The inspected rows with ``record_id`` and ``violation`` (null where sound).

    With ``limit`` only rows before it in source order are inspected.  Duplicate ids count among
    rows that are sound otherwise, as a scan in source order would meet them."""
    if limit is not None:
        if limit <= 0:
            raise ValueError("inspection limit must be positive")
        df = df.where(F.col(fields.row_index) < limit)
    code = violation(checks_of(df, fields))
    rows = df.withColumn("record_id", record_id(fields)).withColumn("violation", code)
    marked = duplicate_ids(rows, F.when(F.col("violation").isNull(), F.col("record_id")), F.col(fields.row_index))
    code = F.coalesce(F.col("violation"), F.when(F.col("duplicate"), F.lit("duplicate_id")))
    return marked.withColumn("violation", code).drop("duplicate")


def first_violation(checked: DataFrame, row_index: str = "row_index") -> DataFrame:
    """(row_index, code) of the violation that comes first; no row if all are sound."""
    bad = checked.where(F.col("violation").isNotNull())
    return bad.agg(F.min(row_index).alias("row_index"), F.min_by("violation", row_index).alias("code")).where("row_index IS NOT NULL")


def summary(df: DataFrame, checked: DataFrame, whole: bool = False) -> DataFrame:
    """One row: all rows, inspected rows, distinct ids of sound rows, violations.  With ``whole`` every
    row was inspected, and none is counted apart."""
    seen = checked.agg(
        F.count("*").alias("inspected_rows"),
        F.countDistinct(F.when(F.col("violation").isNull(), F.col("record_id"))).alias("unique_ids"),
        F.count("violation").alias("n_violations"),
    )
    if whole:
        return seen.select(F.col("inspected_rows").alias("row_count"), "*")
    return df.agg(F.count("*").alias("row_count")).crossJoin(F.broadcast(seen))  # one row each


def canonical(df: DataFrame, fields: Fields) -> DataFrame:
    """Sound rows under canonical names, values unchanged."""
    return renamed(check_rows(df, fields), fields)


def renamed(checked: DataFrame, fields: Fields) -> DataFrame:
    """Sound rows of ``check_rows`` under canonical names."""
    df, checked = checked, checked.where(F.col("violation").isNull())
    meta = F.col(fields.metadata) if fields.metadata is not None else F.create_map().cast("map<string,string>")
    if isinstance(fields, ResponseFields):
        values = [F.col(fields.prompt).alias("prompt"), F.col(fields.response).alias("response")]
    else:
        values = []
        for name, label in ((fields.prompt, "prompt"), (fields.chosen, "chosen"), (fields.rejected, "rejected")):
            c = F.col(name)
            values.append((canonical_messages(c) if value_format(df.schema[name].dataType) == "conversational" else c).alias(label))
    return checked.select(F.col(fields.row_index).alias("row_index"), F.col("record_id").alias("id"), *values, meta.alias("metadata"))


def dataset_format(df: DataFrame, fields: PreferenceFields) -> str:
    """``standard``, ``conversational``, ``mixed`` or ``empty``, from the types and one row."""
    formats = {value_format(df.schema[c].dataType) for c in (fields.prompt, fields.chosen, fields.rejected)}
    if df.isEmpty():
        return "empty"
    return formats.pop() if len(formats) == 1 else "mixed"


def require_valid(df: DataFrame, fields: Fields, limit: int | None = None) -> None:
    """Raises the first violation in source order; one job."""
    for r in first_violation(check_rows(df, fields, limit), fields.row_index).collect():  # at most one row
        raise ContractError(f"row {r.row_index}: {r.code}")


# ---- rows that mix formats -----------------------------------------------------------------------


def variant_format(v: Column) -> Column:
    """Format of a value of a JSON row, decided by the value: as ``value_format``, null where it is absent."""
    kind = F.schema_of_variant(v)
    messages = kind.startswith("ARRAY<OBJECT<") & kind.contains("content: STRING") & kind.contains("role: STRING")
    return F.when(v.isNull() | (kind == "VOID"), F.lit(None)).when(kind == "STRING", "standard").when(messages, "conversational").otherwise("unsupported")


def json_formats(df: DataFrame, payload: str, row_index: str = "row_index", names: tuple[str, str, str] = ("prompt", "chosen", "rejected")) -> DataFrame:
    """(row_index, format, violation) of preference rows kept as JSON text, whose values may be text in
    one row and messages in the next.  A row's violation is ``unreadable``, the first absent or
    unsupported value, ``mixed_formats`` within the row, or ``dataset_format`` where its format is not
    that of the first sound row in source order."""
    parsed = df.select(F.col(row_index).alias("row_index"), F.try_parse_json(F.col(payload)).alias("v"))
    of = parsed.select("row_index", F.col("v").isNull().alias("unreadable"), *(variant_format(F.variant_get("v", f"$.{n}", "variant")).alias(f"f{i}") for i, n in enumerate(names)))
    found = [F.col(f"f{i}") for i in range(3)]
    bad = [F.when(F.coalesce(f, F.lit("unsupported")) == "unsupported", n) for f, n in zip(found, names, strict=True)]
    mixed = F.when((found[0] != found[1]) | (found[1] != found[2]), "mixed_formats")
    rows = of.select("row_index", found[0].alias("format"), F.coalesce(F.when(F.col("unreadable"), "unreadable"), *bad, mixed).alias("violation"))
    first = rows.where("violation IS NULL").agg(F.min_by("format", "row_index").alias("__first"))  # one row
    other = F.when(F.col("format") != F.col("__first"), "dataset_format")
    return rows.crossJoin(F.broadcast(first)).select("row_index", F.when(F.col("violation").isNull(), F.col("format")).alias("format"), F.coalesce("violation", other).alias("violation"))


def missing_columns(df: DataFrame, wanted: DataFrame, key: str, column: str) -> DataFrame:
    """(key, column): the columns wanted, by key, that ``df`` doesn't have; null ones aren't wanted."""
    have = df.sparkSession.createDataFrame([(c,) for c in df.columns], f"{column} string")
    return wanted.where(F.col(column).isNotNull()).select(key, column).distinct().join(F.broadcast(have), column, "left_anti").select(key, column)
