"""Comparison of tokenizers as tables of tokens."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPECIAL_KEYS = {"added_tokens": list, "special_tokens": dict, "bos_token": str, "eos_token": str, "pad_token": str, "unk_token": str}


def tokenizer_file(path: str) -> Path:
    """The file itself, else the tokenizer or vocabulary file of the folder."""
    p = Path(path)
    for c in [p] if p.is_file() else [p / "tokenizer.json", p / "vocab.json"]:
        if c.is_file():
            return c
    raise FileNotFoundError(f"no tokenizer file at {path}")


def load_payload(path: str) -> dict:
    payload = json.loads(tokenizer_file(path).read_text(encoding="utf-8"))
    if not isinstance(payload, dict):
        raise ValueError(f"tokenizer file of {path} must hold a JSON object")
    return payload


def vocab_of(payload: dict) -> dict[str, int]:
    """The vocabulary of a payload; one that is nothing but a vocabulary is taken as such."""
    model = payload.get("model")
    vocab = model["vocab"] if isinstance(model, dict) and isinstance(model.get("vocab"), dict) else payload.get("vocab")
    if not isinstance(vocab, dict):
        vocab = payload if payload and all(isinstance(v, int) and not isinstance(v, bool) for v in payload.values()) else None
    if vocab is None or not all(isinstance(v, int) and not isinstance(v, bool) for v in vocab.values()):
        raise ValueError("tokenizer payload has no vocabulary of token ids")
    return vocab


def specials_of(payload: dict) -> str:
    """Special tokens as canonical JSON; the order of added tokens counts."""
    kept = {k: payload[k] for k, kind in SPECIAL_KEYS.items() if isinstance(payload.get(k), kind)}
    return json.dumps(kept, sort_keys=True, ensure_ascii=False)


def payload_of(tokenizer: object) -> dict:
    """The payload of a loaded tokenizer: its vocabulary and, where it has one, its map of special tokens."""
    vocab = tokenizer.get_vocab()
    specials = getattr(tokenizer, "special_tokens_map", None)
    return {"vocab": dict(vocab)} | ({"special_tokens": dict(specials)} if specials else {})


def vocab_table(spark: SparkSession, payload: dict) -> DataFrame:
    return spark.createDataFrame(list(vocab_of(payload).items()), "token string, id bigint")


def vocab_diff(teacher: DataFrame, student: DataFrame) -> DataFrame:
    """(token, teacher_id, student_id) of tokens that don't have the same id on both sides."""
    t, s = teacher.select("token", F.col("id").alias("teacher_id")), student.select("token", F.col("id").alias("student_id"))
    return t.join(s, "token", "full_outer").where(~F.col("teacher_id").eqNullSafe(F.col("student_id")))


def gate(n_different: int, same_specials: bool) -> str:
    """Reason of the comparison: the vocabulary counts before the special tokens."""
    return "vocab_mismatch" if n_different else "compatible" if same_specials else "special_tokens_mismatch"


def check_payloads(spark: SparkSession, a: dict, b: dict) -> str:
    different = vocab_diff(vocab_table(spark, a), vocab_table(spark, b)).limit(1).count()
    return gate(different, specials_of(a) == specials_of(b))


def check_tokenizers(spark: SparkSession, teacher_path: str, student_path: str) -> str:
    return check_payloads(spark, load_payload(teacher_path), load_payload(student_path))


def require_compatible(spark: SparkSession, teacher_path: str, student_path: str) -> None:
    reason = check_tokenizers(spark, teacher_path, student_path)
    if reason != "compatible":
        raise ValueError(f"tokenizers differ: {reason} (teacher={teacher_path}, student={student_path})")


# ---- payloads as data ----------------------------------------------------------------------------


def payload_vocab(df: DataFrame, payload: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """(keep..., token, id) of JSON payloads: of ``model.vocab`` where it is an object, else of ``vocab``."""
    as_map = lambda path: F.from_json(F.get_json_object(payload, path), "map<string,bigint>")
    return df.select(*keep, F.explode(F.coalesce(as_map("$.model.vocab"), as_map("$.vocab"))).alias("token", "id"))


def payload_specials(payload: str) -> Column:
    """Special tokens of a JSON payload as one text: those whose value has its type, names sorted, the
    order of added tokens kept."""
    v, parts = F.try_parse_json(F.col(payload)), []
    starts = {list: "ARRAY", dict: "OBJECT", str: "STRING"}
    for name in sorted(SPECIAL_KEYS):
        value = F.variant_get(v, f"$.{name}", "variant")
        parts.append(F.when(F.schema_of_variant(value).startswith(starts[SPECIAL_KEYS[name]]), F.concat(F.lit(f'"{name}":'), F.to_json(value))))
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def gate_of(pairs: DataFrame, teacher: str, student: str, key: str) -> DataFrame:
    """(key, reason) of pairs of JSON payloads, all pairs at once: see ``gate``."""
    sides = [payload_vocab(pairs, c, (key,)).withColumnRenamed("id", f"{n}_id") for n, c in (("t", teacher), ("s", student))]
    both = sides[0].join(sides[1], [key, "token"], "full_outer").where(~F.col("t_id").eqNullSafe(F.col("s_id")))
    different = both.groupBy(key).agg(F.count("*").alias("__n"))
    same = payload_specials(teacher).eqNullSafe(payload_specials(student))
    rows = pairs.select(key, same.alias("__same")).join(different, key, "left")
    return rows.select(key, F.when(F.col("__n") > 0, "vocab_mismatch").when(~F.col("__same"), "special_tokens_mismatch").otherwise("compatible").alias("reason"))
