"""spark-submit entry point: ``python -m tessera.plans.cli COMMAND --config FILE``.

plan      what a run would do, as JSON
validate  check a run's data and print its summary
prepare   write a run's training set as Parquet
evaluate  metrics of stored predictions and scores
export    check an export's folders and write its model card
pack / unpack / verify  artifact bundles
push / pull  a staged folder to or from a folder of any Hadoop file system
"""

from __future__ import annotations

import argparse
import json

from tessera.operators import artifacts, encoding
from tessera.plans import runs
from tessera.session import get_spark
from tessera.sources import config as C
from tessera.sources import model_card

DATA_KINDS = ("response", "logit", "preference", "evaluation")


def _tokenizer(path: str | None, eos: int) -> encoding.Tokenizer:
    return encoding.WordHashTokenizer() if path is None else encoding.FileTokenizer(path, eos)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("command", choices=["plan", "validate", "prepare", "evaluate", "export", "pack", "unpack", "verify", "push", "pull"])
    p.add_argument("--config")
    p.add_argument("--kind", choices=sorted(C.KINDS), default="response")
    p.add_argument("--limit", type=int)
    p.add_argument("--max-train-samples", type=int)
    p.add_argument("--tokenizer")
    p.add_argument("--eos", type=int, default=0)
    p.add_argument("--predictions")
    p.add_argument("--scores")
    p.add_argument("--output")
    p.add_argument("--manifest")
    p.add_argument("--bundle")
    p.add_argument("--root", default=".")
    p.add_argument("--uri")
    p.add_argument("--delete-extra", action="store_true")
    a = p.parse_args(argv)
    show = lambda x: print(json.dumps(x, indent=2, sort_keys=True, ensure_ascii=False))
    if a.command == "plan":
        show(runs.plan(a.kind, C.load(a.kind, a.config)))
        return 0
    if a.command == "unpack":
        show(artifacts.unpack(a.bundle, a.output or a.root))
        return 0
    if a.command == "export":
        show(model_card.export(C.load("export", a.config)))
        return 0
    spark = get_spark("tessera-" + a.command)
    if a.command == "verify":
        manifest = artifacts.load_manifest(a.manifest)
        rows = artifacts.manifest_table(spark, manifest)
        paths = [x["path"] for x in manifest.get("files", [])]
        bad = artifacts.first_problem(artifacts.verify(rows, artifacts.hash_files(spark, paths, a.root))).collect()  # at most one row
        show({"run_name": manifest["run_name"], "problem": bad[0].asDict() if bad else None})
        return int(bool(bad))
    if a.command == "pack":
        art = C.load("artifacts", a.config).artifact
        done = artifacts.stage(spark, art.run_name, art.required, art.include, art.local_dir, a.root)
        artifacts.pack(f"{a.root}/{art.local_dir}", f"{a.root}/{art.bundle_path}", art.run_name)
        show(done.totals)
        return 0
    if a.command in ("push", "pull"):
        art = C.load("artifacts", a.config).artifact
        if a.command == "pull":
            show(artifacts.pull(spark, a.uri, a.output or f"{a.root}/{art.local_dir}"))
            return 0
        done = artifacts.stage(spark, art.run_name, art.required, art.include, art.local_dir, a.root)
        show(done.totals | artifacts.push(spark, done.folder, a.uri, a.delete_extra))
        return 0
    config = C.load(a.kind, a.config)
    if a.command == "validate":
        show(runs.validate_inputs(spark, a.kind, config, a.limit))
    elif a.command == "prepare":
        df = runs.load(spark, config.data)
        if a.kind == "preference":
            out = runs.preference_training_set(df, config.data, config.training, a.max_train_samples)
        else:
            settings = config.distillation if a.kind == "logit" else config.training
            out = runs.response_training_set(df, config.data, config.formatting, settings, _tokenizer(a.tokenizer, a.eos), a.max_train_samples)
        out.write.mode("overwrite").parquet(a.output)
    else:
        show(runs.run_evaluation(spark, config, spark.read.parquet(a.predictions), spark.read.parquet(a.scores), a.limit))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
