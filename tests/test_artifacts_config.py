import json

import pytest

from tessera.operators import artifacts as A
from tessera.operators import vocab as V
from tessera.plans import runs
from tessera.sources import config as C
from tessera.sources import env, model_card, models, registry


def test_stage_pack_unpack_verify(spark, tmp_path):
    (tmp_path / "run").mkdir()
    (tmp_path / "run" / "config.json").write_text("{}")
    (tmp_path / "run" / "empty.txt").write_text("")
    done = A.stage(spark, "r", ["run/config.json"], ["run/*", "run/*.json"], "staged", str(tmp_path))
    assert done.totals == {"run_name": "r", "file_count": 2, "total_bytes": 2}
    A.pack(str(tmp_path / "staged"), str(tmp_path / "b.tar.gz"), "r")
    assert sorted(A.unpack(str(tmp_path / "b.tar.gz"), str(tmp_path / "out"))) == ["r/manifest.json", "r/run/config.json", "r/run/empty.txt"]
    manifest = A.load_manifest(str(tmp_path / "out" / "r" / "manifest.json"))
    table = A.manifest_table(spark, manifest)
    paths = [f["path"] for f in manifest["files"]]
    check = lambda root: A.first_problem(A.verify(table, A.hash_files(spark, paths, root))).collect()
    assert check(str(tmp_path / "out" / "r")) == []
    (tmp_path / "run" / "config.json").write_text("[]")
    assert check(str(tmp_path))[0].problem == "checksum"
    (tmp_path / "run" / "config.json").write_text("[ ]")
    assert check(str(tmp_path))[0].problem == "size"
    (tmp_path / "run" / "config.json").unlink()
    assert (check(str(tmp_path))[0].path, check(str(tmp_path))[0].problem) == ("run/config.json", "missing")
    with pytest.raises(FileNotFoundError, match="run/config.json"):
        A.stage(spark, "r", ["run/config.json"], ["run/*"], "staged", str(tmp_path))
    assert A.totals(table.limit(0)).collect()[0].asDict() == {"file_count": 0, "total_bytes": 0}


def test_stale_keys_and_batches(spark):
    remote = spark.createDataFrame([(f"k{i:05d}",) for i in range(2500)] * 2, "key string")
    stale = A.stale_keys(remote, remote.where("key < 'k00100'"))
    got = {r.key: r.batch for r in A.delete_batches(stale).collect()}
    assert len(got) == 2400 and got["k00100"] == 0 and got["k01099"] == 0 and got["k01100"] == 1 and got["k02499"] == 2


def test_listing_and_plans(spark, tmp_path):
    (tmp_path / "r" / "sub").mkdir(parents=True)
    for name in ("a.txt", "sub/b.txt"):
        (tmp_path / "r" / name).write_text("x")
    remote = A.remote_keys(spark, str(tmp_path / "r"))
    assert {r.key for r in remote.collect()} == {"a.txt", "sub/b.txt"}
    assert A.remote_keys(spark, str(tmp_path / "none")).count() == 0
    local = spark.createDataFrame([("a.txt",), ("c.txt",)], "key string")
    assert {tuple(r) for r in A.push_plan(remote, local, True).collect()} == {("a.txt", "upload"), ("c.txt", "upload"), ("sub/b.txt", "delete")}
    assert A.push_plan(remote, local, False).count() == 2
    assert {r.key for r in A.pull_plan(spark.createDataFrame([("d/",), ("d/x",)], "key string")).collect()} == {"d/x"}


def test_object_uris():
    assert A.Folder.of_run("b", "/x/", "r").uri == "s3://b/x/r/" and A.Folder.of_run("b", None, "r").uri == "s3://b/r/"
    assert A.Folder.parse("s3://b/x/r") == A.Folder("b", "x/r/") and A.Folder.parse("s3://b") == A.Folder("b")
    for bad in ("http://b/x", "s3:///x"):
        with pytest.raises(ValueError):
            A.Folder.parse(bad)
    with pytest.raises(ValueError):
        A.Folder.of_run(None, None, "r")


def test_unsafe_bundles_and_broken_manifests(tmp_path):
    import io
    import tarfile

    with tarfile.open(tmp_path / "bad.tar.gz", "w:gz") as t:
        member = tarfile.TarInfo("../outside.txt")
        member.size = 1
        t.addfile(member, io.BytesIO(b"x"))
    with pytest.raises(ValueError, match="outside"):
        A.unpack(str(tmp_path / "bad.tar.gz"), str(tmp_path / "out"))
    assert not (tmp_path / "outside.txt").exists()
    for text in ("[]", '{"run_name": "r"}', '{"run_name": "r", "files": [{"path": "a"}]}', '{"run_name": "r", "files": [{"path": "a", "size_bytes": true, "sha256": "x"}]}'):
        with pytest.raises(ValueError):
            A.parse_manifest(text)
    with pytest.raises(FileNotFoundError):
        A.load_manifest(str(tmp_path / "none.json"))


def test_push_and_pull(spark, tmp_path):
    (tmp_path / "run").mkdir()
    (tmp_path / "run" / "a.txt").write_text("a")
    (tmp_path / "remote").mkdir()
    (tmp_path / "remote" / "old.txt").write_text("old")
    done = A.stage(spark, "r", ["run/a.txt"], ["run/*"], "staged", str(tmp_path))
    uri = f"file://{tmp_path}/remote"
    assert A.push(spark, done.folder, uri, True) == {"uploaded": 2, "deleted": 1}
    assert A.pull(spark, uri, str(tmp_path / "back")) == {"downloaded": 2}
    assert (tmp_path / "back" / "run" / "a.txt").read_text() == "a"
    (tmp_path / "remote" / "run" / "a.txt").write_text("b")
    with pytest.raises(ValueError, match="checksum"):
        A.pull(spark, uri, str(tmp_path / "back"))


def test_tokenizer_gate(spark, tmp_path):
    def put(name, vocab, added):
        (tmp_path / name).mkdir()
        (tmp_path / name / "tokenizer.json").write_text(json.dumps({"model": {"vocab": vocab}, "added_tokens": added}))
        return str(tmp_path / name)

    a = put("a", {"x": 0, "y": 1}, [{"id": 1, "content": "y"}])
    b = put("b", {"y": 1, "x": 0}, [{"content": "y", "id": 1}])
    c = put("c", {"x": 0, "y": 2}, [])
    d = put("d", {"x": 0, "y": 1}, [])
    assert [V.check_tokenizers(spark, a, t) for t in (b, c, d)] == ["compatible", "vocab_mismatch", "special_tokens_mismatch"]
    with pytest.raises(ValueError, match="vocab_mismatch"):
        V.require_compatible(spark, a, c)
    assert V.vocab_of({"x": 0}) == {"x": 0}

    class Loaded:
        special_tokens_map = {"eos_token": "y"}

        def get_vocab(self):
            return {"x": 0, "y": 1}

    assert V.check_payloads(spark, V.payload_of(Loaded()), V.payload_of(Loaded())) == "compatible"
    with pytest.raises(ValueError):
        V.vocab_of({"model": {}})


RESPONSE = {
    "model": {"model_name_or_path": "m", "tokenizer_name_or_path": "m", "revision": None},
    "data": {"dataset_id": "d", "dataset_split": "train", "id_field": None, "prompt_field": "prompt", "response_field": "response"},
    "formatting": {"mode": "plain"},
    "training": {
        "max_length": 8, "per_device_train_batch_size": 2, "gradient_accumulation_steps": 4, "learning_rate": 1e-5, "num_train_epochs": 1, "warmup_ratio": 0.1, "weight_decay": 0,
        "max_grad_norm": 1, "lr_scheduler_type": "cosine", "logging_steps": 1, "save_steps": 1, "save_total_limit": 1, "bf16": True, "gradient_checkpointing": False, "dataloader_num_workers": 0, "seed": 1,
    },
    "output": {"model_name": "m", "run_dir": "r", "checkpoint_dir": "c", "final_checkpoint_dir": "f"},
}


def changed(path, value):
    raw = json.loads(json.dumps(RESPONSE))
    *head, last = path.split(".")
    node = raw
    for h in head:
        node = node[h]
    node[last] = value
    return raw


def test_config_rules():
    config = C.parse("response", RESPONSE)
    assert config.training.max_steps is None and runs.plan("response", config)["effective_batch_size"] == 8
    for path, value in (("training.max_length", 0), ("training.max_length", True), ("training.warmup_ratio", 1), ("formatting.mode", "x"), ("data", []), ("training.bf16", 1), ("data.prompt_field", "")):
        with pytest.raises(C.ConfigError, match=path.split(".")[-1]):
            C.parse("response", changed(path, value))


def test_yaml(tmp_path):
    with pytest.raises(FileNotFoundError):
        C.load_yaml(tmp_path / "x.yaml")
    (tmp_path / "x.yaml").write_text("")
    assert C.load_yaml(tmp_path / "x.yaml") == {}
    (tmp_path / "x.yaml").write_text("- a")
    with pytest.raises(C.ConfigError):
        C.load_yaml(tmp_path / "x.yaml")


def test_env_and_models(tmp_path):
    (tmp_path / ".env").write_text("# c\nA=1\nB='x y'\nexport C=\nD=2 # note\n")
    assert env.read_env_file(tmp_path / ".env") == {"A": "1", "B": "x y", "C": "", "D": "2"}
    assert env.value("C", tmp_path / ".env") is None
    with pytest.raises(ValueError):
        env.required("Z", tmp_path / ".env")
    assert env.tracking_targets("r", "s", {}) == {} and env.tracking_targets("r", "s", {"WANDB_MODE": "offline"})["WANDB_NAME"] == "r-s"
    assert models.resolve(str(tmp_path)).source == "local"
    with pytest.raises(FileNotFoundError):
        models.resolve(str(tmp_path / "none"))
    assert models.resolve("org/name", "main", lambda r, v: (r, "sha")).commit == "sha"
    assert models.matching_device("NVIDIA H200 NVL", ["h200"]) and not models.matching_device("T4", ["a100"])


def test_training_set_from_a_registered_source(spark):
    df = spark.createDataFrame([(0, "a b", "c d"), (1, "e", "f " * 20), (2, "g", "h")], "row_index bigint, prompt string, response string")
    registry.register("fixture", lambda s, split, name: df)
    config = C.parse("response", changed("data.dataset_id", "fixture"))
    rows = runs.response_training_set(runs.load(spark, config.data), config.data, config.formatting, config.training, __import__("tessera.operators.encoding", fromlist=["x"]).WordHashTokenizer(), 2).collect()
    assert sorted(len(r.input_ids) for r in rows) == [6, 8]
    assert runs.inspect(df, runs.response_fields(config.data))["unique_ids"] == 3
    seen = runs.validate_inputs(spark, "response", config, 2, lambda ref, rev: (ref, "sha"))
    assert seen["data"]["inspected_rows"] == 2 and seen["models"]["model"]["commit"] == "sha"
    bad = df.withColumn("response", df.prompt.substr(9, 1))
    with pytest.raises(ValueError, match="row 0: response"):
        runs.inspect(bad, runs.response_fields(config.data))


def test_parquet_row_numbers_follow_files(spark, tmp_path):
    for name, values in (("b", [3, 4]), ("a", [1, 2])):
        spark.createDataFrame([(v,) for v in values], "v int").coalesce(1).write.parquet(str(tmp_path / "t" / f"part={name}"))
    df = registry.with_row_index(spark.read.parquet(str(tmp_path / "t")))
    assert [(r.row_index, r.v) for r in df.orderBy("row_index").collect()] == [(0, 1), (1, 2), (2, 3), (3, 4)]


def test_model_card():
    part = {"output_path": "x", "source_checkpoint": "s", "teacher_model": "t", "distillation_type": "response", "dpo_applied": True, "response_dataset": "a", "preference_dataset": "b", "eval_results_path": "e"}
    raw = {"model": {"model_name": "m", "checkpoint_path": "c", "tokenizer_path": "c", "export_repo": "o/m"}, "model_card": part, "export": {"push_to_hub": False, "include_tokenizer": True, "private": False}}
    config = C.parse("export", raw)
    text = model_card.build(config)
    assert text.startswith("# m\n") and "| Teacher model | `t` |" in text and model_card.missing_export_paths(config) == ["c"]


def test_evaluation_run(spark, tmp_path):
    df = spark.createDataFrame([(i, f"i{i}", f"p{i}", f"answer {i}") for i in range(10)], "row_index bigint, id string, prompt string, response string")
    registry.register("eval-fixture", lambda s, split, name: df)
    prefs = spark.createDataFrame([(i, f"i{i}", "p", "good", "bad") for i in range(10)], "row_index bigint, id string, prompt string, c string, r string")
    registry.register("eval-preferences", lambda s, split, name: prefs)
    raw = {
        "models": [{"name": n, "model_name_or_path": n, "tokenizer_name_or_path": n} for n in ("zero", "new")],
        "data": {"dataset_id": "eval-fixture", "dataset_split": "train", "id_field": "id", "prompt_field": "prompt", "reference_field": "response"},
        "preference_data": {"dataset_id": "eval-preferences", "dataset_split": "train", "id_field": "id", "prompt_field": "prompt", "chosen_field": "c", "rejected_field": "r"},
        "formatting": {"mode": "plain"},
        "generation": {"max_input_length": 8, "max_new_tokens": 8, "per_device_batch_size": 2, "do_sample": False, "temperature": 0.0, "seed": 1, "limit": 5},
        "output": {"results_path": str(tmp_path / "r.json"), "predictions_dir": str(tmp_path / "p")},
    }
    config = C.parse("evaluation", raw)
    preds = spark.createDataFrame([(m, f"i{i}", f"answer {i}" if m == "new" else "x") for m in ("zero", "new", "other") for i in range(10)], "model string, id string, prediction string")
    scores = spark.createDataFrame([(m, f"i{i}", float(m == "new"), 0.0) for m in ("zero", "new") for i in range(10)] + [("new", "elsewhere", 0.0, 1.0)], "model string, id string, chosen double, rejected double")
    out = runs.run_evaluation(spark, config, preds, scores)
    assert [(m["name"], m["metrics"]["examples"], m["preference_pairs"], m["preference_accuracy"]) for m in out["models"]] == [("zero", 5, 5, 0.5), ("new", 5, 5, 1.0)]
    assert (out["dataset_id"], out["examples"], out["preference_pairs"]) == ("eval-fixture", 5, 5)
    assert out["comparisons"][0]["exact_match_delta"] == 1.0 and out["comparisons"][0]["preference_accuracy_delta"] == 0.5
    assert json.loads((tmp_path / "r.json").read_text()) == out and (tmp_path / "p" / "model=new").is_dir()
    with pytest.raises(C.ConfigError, match="unique"):
        C.parse("evaluation", raw | {"models": raw["models"][:1] * 2})


def test_make_targets():
    import shutil
    import subprocess
    from pathlib import Path

    if shutil.which("make") is None:
        pytest.skip("make is absent")
    root = Path(__file__).resolve().parent.parent
    for target in ("plan", "validate", "prepare", "evaluate", "export", "pack", "unpack", "verify", "push", "pull"):
        said = subprocess.run(["make", "-n", target, "KIND=logit", "CONFIG=c.yaml", "ARGS=--limit 5"], cwd=root, capture_output=True, text=True, check=True).stdout
        assert f"tessera.plans.cli {target} " in said and "--limit 5" in said
        assert ("--kind logit" in said) == (target in ("plan", "validate", "prepare", "evaluate"))
