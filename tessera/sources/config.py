"""Run configurations: YAML trees checked against declared fields.

A kind of run is a table of sections, a section a table of fields, a field its type and a rule.
Everything is checked in the order declared, and the first problem is raised with its path.
"""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path
from types import MappingProxyType
from typing import Any

import yaml


class ConfigError(ValueError):
    pass


class Settings:
    """A read-only tree: fields as attributes."""

    def __init__(self, values: dict[str, Any]):
        object.__setattr__(self, "_values", MappingProxyType(dict(values)))

    def __getattr__(self, name: str) -> Any:
        try:
            return object.__getattribute__(self, "_values")[name]
        except KeyError:
            raise AttributeError(name) from None

    def __setattr__(self, name: str, value: Any) -> None:
        raise AttributeError("settings are read-only")

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Settings) and self.as_dict() == other.as_dict()

    def as_dict(self) -> dict[str, Any]:
        plain = lambda v: v.as_dict() if isinstance(v, Settings) else [plain(x) for x in v] if isinstance(v, list) else v
        return {k: plain(v) for k, v in self._values.items()}


# ---- types of fields ----------------------------------------------------------------------------

Check = Callable[[Any, str], Any]


def _number(v: Any) -> bool:
    return isinstance(v, (int, float)) and not isinstance(v, bool)


def text(v: Any, at: str) -> str:
    if not isinstance(v, str) or not v:
        raise ConfigError(f"{at} must be a non-empty string")
    return v


def flag(v: Any, at: str) -> bool:
    if not isinstance(v, bool):
        raise ConfigError(f"{at} must be true or false")
    return v


def whole(v: Any, at: str) -> int:
    if not isinstance(v, int) or isinstance(v, bool):
        raise ConfigError(f"{at} must be an integer")
    return v


def number(v: Any, at: str) -> float:
    if not _number(v):
        raise ConfigError(f"{at} must be a number")
    return v


def texts(v: Any, at: str) -> list[str]:
    if not isinstance(v, list) or not v:
        raise ConfigError(f"{at} must be a non-empty list")
    return [text(x, f"{at}[{i}]") for i, x in enumerate(v)]


def optional(check: Check) -> Check:
    return lambda v, at: None if v is None else check(v, at)


def one_or_more(check: Check) -> Check:
    """A single value or a non-empty list of them; always a list."""
    return lambda v, at: [check(x, f"{at}[{i}]") for i, x in enumerate(v)] if isinstance(v, list) and v else [check(v, at)]


def ruled(check: Check, holds: Callable[[Any], bool], rule: str) -> Check:
    def run(v: Any, at: str) -> Any:
        v = check(v, at)
        if v is not None and not holds(v):
            raise ConfigError(f"{at} must be {rule}")
        return v

    return run


def choice(*allowed: str) -> Check:
    return ruled(text, allowed.__contains__, "one of " + ", ".join(allowed))


COUNT = ruled(whole, lambda v: v > 0, "positive")
MAYBE_COUNT = optional(COUNT)
AT_LEAST_0 = ruled(whole, lambda v: v >= 0, "non-negative")
POSITIVE = ruled(number, lambda v: v > 0, "positive")
NOT_NEGATIVE = ruled(number, lambda v: v >= 0, "non-negative")
BELOW_1 = ruled(number, lambda v: 0 <= v < 1, "at least 0 and less than 1")
UNIT = ruled(number, lambda v: 0 <= v <= 1, "between 0 and 1")
MAYBE_TEXT = optional(text)

# Preference losses that trainers know.
PREFERENCE_LOSSES = (
    "sigmoid", "hinge", "ipo", "exo_pair", "nca_pair", "robust", "bco_pair", "sppo_hard",
    "aot", "aot_unpaired", "apo_zero", "apo_down", "discopop", "sft", "sigmoid_norm",
)

# ---- sections -----------------------------------------------------------------------------------

_SOURCE = {"dataset_id": text, "dataset_config_name": MAYBE_TEXT, "dataset_split": text, "id_field": MAYBE_TEXT}
RESPONSE_DATA = _SOURCE | {"prompt_field": text, "response_field": text, "metadata_field": MAYBE_TEXT}
PREFERENCE_PAIRS = _SOURCE | {"prompt_field": text, "chosen_field": text, "rejected_field": text}
PREFERENCE_DATA = PREFERENCE_PAIRS | {"metadata_field": MAYBE_TEXT}
EVAL_DATA = _SOURCE | {"prompt_field": text, "reference_field": text}
FORMATTING = {"mode": choice("chat", "plain"), "system_prompt": MAYBE_TEXT}
SCHEDULE = {
    "max_length": COUNT, "per_device_train_batch_size": COUNT, "gradient_accumulation_steps": COUNT, "learning_rate": POSITIVE,
    "num_train_epochs": POSITIVE, "warmup_ratio": BELOW_1, "weight_decay": NOT_NEGATIVE, "max_grad_norm": POSITIVE, "lr_scheduler_type": text,
    "logging_steps": COUNT, "save_steps": COUNT, "save_total_limit": COUNT, "bf16": flag, "gradient_checkpointing": flag,
    "dataloader_num_workers": AT_LEAST_0, "seed": whole, "max_steps": MAYBE_COUNT, "max_train_samples": MAYBE_COUNT,
}
RUN_OUTPUT = {"model_name": text, "run_dir": text, "checkpoint_dir": text, "final_checkpoint_dir": text}
CHECKPOINT = {"model_name": text, "checkpoint_path": text, "tokenizer_path": text, "revision": MAYBE_TEXT}
HUB_MODEL = {"model_name_or_path": text, "tokenizer_name_or_path": text, "revision": MAYBE_TEXT}

KINDS: dict[str, dict[str, Any]] = {
    "response": {"model": HUB_MODEL, "data": RESPONSE_DATA, "formatting": FORMATTING, "training": SCHEDULE, "output": RUN_OUTPUT},
    "logit": {
        "teacher": {"provider": choice("local")} | CHECKPOINT,
        "student": CHECKPOINT,
        "data": RESPONSE_DATA,
        "formatting": FORMATTING,
        "distillation": {"mode": choice("logit"), "temperature": POSITIVE, "alpha": UNIT} | SCHEDULE,
        "compatibility": {"require_same_tokenizer": flag},
        "hardware": {"single_gpu_required": flag, "allowed_gpu_classes": texts},
        "output": RUN_OUTPUT,
    },
    "preference": {
        "source": CHECKPOINT,
        "data": PREFERENCE_DATA,
        "training": {"method": choice("dpo"), "beta": POSITIVE} | SCHEDULE | {
            "dataset_num_proc": COUNT, "loss_type": one_or_more(choice(*PREFERENCE_LOSSES)), "loss_weights": optional(one_or_more(POSITIVE)),
            "truncation_mode": choice("keep_start"), "precompute_ref_log_probs": flag,
        },
        "output": RUN_OUTPUT,
    },
    "evaluation": {
        "models": [{"name": text} | HUB_MODEL],
        "data": EVAL_DATA,
        "preference_data": PREFERENCE_PAIRS,
        "formatting": FORMATTING,
        "generation": {"max_input_length": COUNT, "max_new_tokens": COUNT, "per_device_batch_size": COUNT, "do_sample": flag, "temperature": NOT_NEGATIVE, "seed": whole, "limit": COUNT},
        "output": {"results_path": text, "predictions_dir": text},
    },
    "export": {
        "model": {"model_name": text, "checkpoint_path": text, "tokenizer_path": text, "export_repo": text},
        "model_card": {
            "output_path": text, "source_checkpoint": text, "teacher_model": text, "distillation_type": text, "dpo_applied": flag,
            "response_dataset": text, "preference_dataset": text, "eval_results_path": text,
        },
        "export": {"push_to_hub": flag, "include_tokenizer": flag, "private": flag},
    },
    "artifacts": {
        "artifact": {
            "run_name": text, "backend": choice("s3"), "s3_bucket_env": text, "s3_prefix_env": text, "local_dir": text, "bundle_path": text,
            "delete_remote_extra": flag, "required": texts, "include": texts,
        },
    },
}


def _section(spec: dict[str, Check], raw: Any, at: str) -> Settings:
    if not isinstance(raw, dict):
        raise ConfigError(f"{at} must be a mapping")
    return Settings({name: check(raw.get(name), f"{at}.{name}") for name, check in spec.items()})


def load_yaml(path: str | Path) -> dict[str, Any]:
    """The file's mapping; an empty file is an empty one."""
    p = Path(path)
    if not p.exists():
        raise FileNotFoundError(f"configuration file not found: {p}")
    data = yaml.safe_load(p.read_text(encoding="utf-8"))
    data = {} if data is None else data
    if not isinstance(data, dict):
        raise ConfigError(f"{p} must hold a mapping")
    return data


def parse(kind: str, raw: dict[str, Any]) -> Settings:
    out: dict[str, Any] = {}
    for name, spec in KINDS[kind].items():
        if isinstance(spec, list):
            items = raw.get(name)
            if not isinstance(items, list) or not items:
                raise ConfigError(f"{name} must be a non-empty list")
            out[name] = [_section(spec[0], x, f"{name}[{i}]") for i, x in enumerate(items)]
        else:
            out[name] = _section(spec, raw.get(name), name)
    return _across(kind, Settings(out))


def _across(kind: str, s: Settings) -> Settings:
    """Rules between fields."""
    if kind == "evaluation":
        names = [m.name for m in s.models]
        if twice := sorted({n for n in names if names.count(n) > 1}):
            raise ConfigError(f"model names must be unique: {', '.join(twice)}")
        if s.generation.do_sample and s.generation.temperature <= 0:
            raise ConfigError("generation.temperature must be positive when sampling")
    if kind == "preference":
        t = s.training.as_dict()
        t["loss_weights"] = t["loss_weights"] or [1.0] * len(t["loss_type"])
        if len(t["loss_weights"]) != len(t["loss_type"]):
            raise ConfigError("training.loss_weights must have one weight for each loss")
        s = Settings({**s._values, "training": Settings(t)})
    return s


def load(kind: str, path: str | Path) -> Settings:
    return parse(kind, load_yaml(path))
