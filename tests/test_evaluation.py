import json
import math

import pytest
from pyspark.sql import functions as F

from tessera.operators import encoding as E
from tessera.operators import kernels as K
from tessera.operators import logs, metrics, sampling


def test_metrics_of_known_pairs(spark):
    samples = spark.createDataFrame([("1", "four"), ("2", "blue")], "id string, reference string")
    preds = spark.createDataFrame([("m", "1", "  FOUR "), ("m", "2", "blue sky"), ("n", "1", None), ("n", "1", "four")], "model string, id string, prediction string")
    got = {r.model: r for r in metrics.metrics_by_model(metrics.samples_with_predictions(samples, preds)).collect()}
    m = got["m"]
    assert (m.examples, m.exact_match, m.normalized_exact_match, m.non_empty_rate) == (2, 0.0, 0.5, 1.0)
    assert math.isclose(m.token_f1, (1 + 2 / 3) / 2)
    assert got["n"].examples == 1 and got["n"].exact_match == 1.0
    d = metrics.comparisons(metrics.metrics_by_model(metrics.samples_with_predictions(samples, preds)), "m").collect()
    assert [(r.baseline, r.model, r.normalized_exact_match_delta) for r in d] == [("m", "n", 0.5)]


def test_relational_f1_equals_array_f1(spark):
    pairs = spark.createDataFrame([("m", str(i), "a b b c " * (i % 4), "b c d " * (i % 3)) for i in range(20)], "model string, id string, prediction string, reference string")
    a = {r.id: r.token_f1 for r in metrics.scored(pairs).collect()}
    b = {r.id: r.token_f1 for r in metrics.token_f1_by_id(pairs, ["model", "id"]).collect()}
    assert a.keys() == b.keys() and all(math.isclose(a[k], b[k]) for k in a)


def test_ties_count_half(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (0.0, 1.0), (2.0, 1.0)], "c double, r double")
    assert df.agg(K.win_rate(F.col("c"), F.col("r"))).collect()[0][0] == 0.625


def test_distillation_loss_masks_and_mixes(spark):
    rows = [(0, p, label, s, t) for p, (label, s, t) in enumerate([(-100, [0.0, 0.0], [0.0, 0.0]), (-100, [4.0, -4.0], [-4.0, 4.0]), (1, [0.0, 0.0], [0.0, 0.0])])]
    df = spark.createDataFrame(rows, "seq int, pos int, label int, student array<double>, teacher array<double>")
    losses = K.token_losses(K.supervised(df), 2.0)
    assert losses.count() == 1
    r = K.distillation_loss(losses.withColumn("b", F.lit(0)), "b", 2.0, 0.5).collect()[0]
    kl = (2 / (1 + math.exp(-4)) - 1) * 4
    assert math.isclose(r.soft_loss, 4 * kl) and math.isclose(r.loss, 0.5 * r.hard_loss + 2 * kl)
    masked = df.withColumn("label", F.lit(-100))
    none = K.token_losses(K.supervised(masked), 2.0)
    assert K.empty_batches(masked, none, "seq").count() == 1


def model_log_prob(full, prompt, logits, m):
    ids = full[:m]
    total = 0.0
    for i in range(max(len(prompt) - 1, 0), len(ids) - 1):
        z = math.log(sum(map(math.exp, logits[i])))
        total += logits[i][ids[i + 1]] - z
    return total


def test_conditional_log_probability(spark):
    logits = [[0.1 * i, 0.5, -0.2 * i] for i in range(6)]
    cases = [([0, 1, 2, 1, 0], [0, 1], 6), ([0, 1, 2, 1, 0], [], 6), ([0, 1, 2, 1, 0], [0, 1], 3), ([0, 1], [0, 1], 6), ([0, 1, 2], [1], 6), ([2], [], 6)]
    df = spark.createDataFrame([(i, f, p, logits, m) for i, (f, p, m) in enumerate(cases)], "i int, f array<int>, p array<int>, l array<array<double>>, m int")
    for i, (f, p, m) in enumerate(cases):
        r = df.where(f"i = {i}").select(K.conditional_log_prob(F.col("f"), F.col("p"), F.col("l"), m).alias("s")).collect()[0].s
        if i == 3:
            assert r.violation == "no_completion" and r.score is None
        elif i == 4:
            assert r.violation == "prompt_not_prefix"
        else:
            assert r.violation is None and math.isclose(r.score, model_log_prob(f, p, logits, m), abs_tol=1e-9)


def test_seeded_sample_is_deterministic(spark):
    df = spark.range(1000).withColumnRenamed("id", "row_index")
    a = [r.row_index for r in sampling.seeded_sample(df.repartition(7), 20, 42).collect()]
    b = [r.row_index for r in sampling.seeded_sample(df.repartition(2), 20, 42).collect()]
    assert a == b and len(set(a)) == 20 and a != [r.row_index for r in sampling.seeded_sample(df, 20, 43).collect()]
    assert [r.generated_id for r in sampling.reindexed(sampling.seeded_sample(df, 2, 42), "test").collect()] == ["test-00000000", "test-00000001"]
    with pytest.raises(ValueError):
        sampling.prefix_limit(df, 0)


def test_positions_count_in_order(spark):
    df = spark.createDataFrame([(s, i * 70_000) for s in "ab" for i in range(9)], "split string, row_index bigint")
    got = E.positions(df, ["split"], "row_index").collect()
    assert all(r.position == r.row_index // 70_000 for r in got)


def test_chat_format_and_unstable_prefix(spark):
    df = spark.createDataFrame([("q", "a")], "prompt string, response string")
    text = df.select(E.chat_text(E.answered(E.user_messages(F.col("prompt"), "s"), F.col("response")), False)).collect()[0][0]
    assert text == "<|system|>\ns\n<|end|>\n<|user|>\nq\n<|end|>\n<|assistant|>\na\n<|end|>\n"

    class Reversed:
        bos, eos = None, 2

        def ids(self, t):
            return F.transform(F.split(F.reverse(t), ""), lambda c: F.ascii(c))

    r = E.encode_records(df, Reversed(), 64, "chat").collect()[0]
    assert r.stable is False
    assert E.encode_records(df, E.WordHashTokenizer(), 64, "chat").collect()[0].stable is True


def test_padding_by_batch(spark):
    df = spark.createDataFrame([(i, [1] * (i + 1), [1] * (i + 1), [5] * (i + 1)) for i in range(5)], "i bigint, input_ids array<int>, attention_mask array<int>, labels array<int>")
    got = {r.i: r for r in E.pad_batches(df, "i", 2, 9).collect()}
    assert [len(got[i].input_ids) for i in range(5)] == [2, 2, 4, 4, 5]
    assert got[0].input_ids == [1, 9] and got[0].labels == [5, -100] and got[0].attention_mask == [1, 0]


def test_log_lines(spark):
    rows = [("s", 5, 10, {"loss": 0.5, "learning_rate": 2e-5}), ("s", 5, 0, {"rewards/margins": 0.25, "loss": 1.0}), ("s", 1, 1, {"other": 1.0}), ("s", 2, 3, {"loss/hard": 1.5}), ("s", 2, 3, None)]
    df = spark.createDataFrame(rows, "stage string, step bigint, max_steps bigint, logs map<string,double>")
    got = [r[0] for r in df.select(logs.log_line(*(F.col(c) for c in df.columns))).collect()]
    assert got == ["[s] step 5/10 | loss 0.5 | lr 2.000e-05", "[s] step 5 | loss 1 | reward | margin 0.25", None, "[s] step 2/3 | components | hard 1.5", None]


def test_prediction_lines(spark, tmp_path):
    from tessera.sources import sinks

    df = spark.createDataFrame([("m", "1", "ä", None, '"x"')], "model string, id string, prompt string, reference string, prediction string")
    sinks.write_predictions(df, str(tmp_path / "p"))
    line = next((tmp_path / "p" / "model=m").glob("*.txt")).read_text(encoding="utf-8")
    assert json.loads(line) == {"id": "1", "prompt": "ä", "reference": None, "prediction": '"x"'} and "ä" in line
