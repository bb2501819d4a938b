"""Values from a dotenv file, then from the environment."""

from __future__ import annotations

import os
import re
from pathlib import Path

_LINE = re.compile(r"^\s*(?:export\s+)?([A-Za-z_][A-Za-z0-9_]*)\s*=\s*(.*?)\s*$")


def read_env_file(path: str | Path = ".env") -> dict[str, str]:
    """Assignments of the file, quotes removed, comments left out; no file, no values."""
    p = Path(path)
    out: dict[str, str] = {}
    for line in p.read_text(encoding="utf-8").splitlines() if p.exists() else []:
        m = _LINE.match(line)
        if m and not line.lstrip().startswith("#"):
            v = m[2]
            quoted = len(v) > 1 and v[0] == v[-1] and v[0] in "'\""
            out[m[1]] = v[1:-1] if quoted else re.sub(r"\s+#.*$", "", v)
    return out


def value(key: str, path: str | Path = ".env", environment: bool = False) -> str | None:
    """The file's value if it isn't empty, else the environment's where asked for."""
    return read_env_file(path).get(key) or (os.environ.get(key) if environment else None)


def required(key: str, path: str | Path = ".env", environment: bool = False) -> str:
    if found := value(key, path, environment):
        return found
    raise ValueError(f"{key} is required in {path}")


def tracking_targets(run_name: str, stage: str, values: dict[str, str]) -> dict[str, str]:
    """Settings an experiment tracker would get: none unless it has a key or works offline."""
    mode = values.get("WANDB_MODE", "").strip().lower()
    if mode == "disabled" or not (values.get("WANDB_API_KEY", "").strip() or mode == "offline"):
        return {}
    defaults = {"WANDB_PROJECT": "distillation", "WANDB_NAME": f"{run_name}-{stage}", "WANDB_GROUP": run_name, "WANDB_JOB_TYPE": stage}
    return defaults | {k: v for k, v in values.items() if k.startswith("WANDB_") and v}
