"""Provenance card of an exported model, as Markdown."""

from __future__ import annotations

from pathlib import Path

from tessera.sources.config import Settings

# The card's sections and labels.
SECTIONS = (
    ("Model", "model", (("Model name", "model_name"), ("Export repo", "export_repo"), ("Checkpoint path", "checkpoint_path"), ("Tokenizer path", "tokenizer_path"))),
    (
        "Distillation",
        "model_card",
        (("Source checkpoint", "source_checkpoint"), ("Teacher model", "teacher_model"), ("Distillation type", "distillation_type"), ("DPO applied", "dpo_applied"),
         ("Response dataset", "response_dataset"), ("Preference dataset", "preference_dataset")),
    ),
    ("Evaluation", "model_card", (("Results", "eval_results_path"),)),
)


def build(config: Settings) -> str:
    out = [f"# {config.model.model_name}", ""]
    for title, part, rows in SECTIONS:
        out += [f"## {title}", "", "| Field | Value |", "|---|---|"]
        out += [f"| {label} | `{getattr(getattr(config, part), name)}` |" for label, name in rows] + [""]
    out += ["## Notes", "", "Made from the export configuration. Check licences, data provenance and results before publishing."]
    return "\n".join(out).rstrip() + "\n"


def write(config: Settings) -> str:
    path = Path(config.model_card.output_path)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(build(config), encoding="utf-8")
    return str(path)


def export(config: Settings) -> dict[str, object]:
    """Checks the folders, writes the card and says what goes where; uploading is left to the hub's client."""
    if missing := missing_export_paths(config):
        raise FileNotFoundError(f"missing export folder(s): {', '.join(missing)}")
    folders = [config.model.checkpoint_path]
    if config.export.include_tokenizer and config.model.tokenizer_path != config.model.checkpoint_path:
        folders.append(config.model.tokenizer_path)
    return {"card": write(config), "repo": config.model.export_repo, "private": config.export.private, "folders": folders}


def missing_export_paths(config: Settings) -> list[str]:
    """Checkpoint and, if it is exported too, tokenizer folders that aren't there."""
    wanted = [config.model.checkpoint_path] + [config.model.tokenizer_path] * config.export.include_tokenizer
    return [p for p in dict.fromkeys(wanted) if not Path(p).is_dir()]
