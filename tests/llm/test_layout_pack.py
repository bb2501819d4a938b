import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.llm import layout, pack


def groups(spark, df, fields, as_json=False, **limits):
    rows = layout.canonical_rows(df, "row_index", fields, as_json, "t")
    return {r.row: r.rep for r in layout.group_layout_copies(rows, **limits).collect()}


@pytest.mark.parametrize("limits", [{}, {"bucket_rows": 2, "step": 2, "max_level": 6, "salts": 3}, {"bucket_rows": 1, "step": 1, "max_level": 2, "salts": 2}])
def test_copies_against_brute_force(spark, limits):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        p, r = (" ".join(rng.choices(["Ab", "ac", "1"], k=rng.randint(0, 3))) for _ in range(2))
        rows.append((i, rng.choice([p, p.upper(), f" {p}.", None if not p else p]), rng.choice([r, r.replace(" ", "\n- ")]), "clash"))
    rows += [(1000 + i, "the hot one", "y" * 50, "clash") for i in range(150)]
    rows += [(2000, "x" * 200_000, "", "c"), (2001, ("x" * 200_000).upper(), None, "c"), (2002, "x" * 199_999 + "y", "", "c")]
    df = spark.createDataFrame(rows, "row_index bigint, prompt string, response string, body string")
    key = lambda r: tuple("".join(c for c in (x or "").lower() if c.isalnum()) for x in r[1:3])
    first = {}
    for r in rows:
        first.setdefault(key(r), r[0])
    want = {r[0]: first[key(r)] for r in rows}
    assert groups(spark, df, ["prompt", "response"], **limits) == want
    counted = layout.copy_counts(layout.canonical_rows(df, "row_index", ["prompt", "response"], False, "t"), **limits)
    assert {r.rep: r.n_copies for r in counted.collect()} == Counter(want.values())


def test_radix_goes_three_levels_deep_at_the_default_limits(spark):
    """Texts that share their first 40 bytes fill one bucket at level 0 and level 1."""
    same = F.when(F.col("id") % 1000 == 0, F.lit("X")).otherwise(F.col("id").cast("string"))
    df = spark.range(layout.BUCKET_ROWS + 1000).select(F.col("id").alias("row_index"), F.concat(F.lit("All of these begin with the same forty letters and more. "), same).alias("prompt"))
    rows = layout.canonical_rows(df, "row_index", ["prompt"], False, "t")
    split, stuck = layout.radix_plan(rows, layout.BUCKET_ROWS, layout.STEP_BYTES, layout.MAX_LEVEL)
    assert len(split) == 2 and stuck.isEmpty()
    got = layout.copy_counts(rows).where("n_copies > 1").collect()
    assert [(r.rep, r.n_copies) for r in got] == [(0, 51)]


def test_canonical_bytes_in_the_jvm_and_in_python(spark):
    texts = ["", "A-b_c ÄÖ 1²", "İx ΑΣ Σ", "日本、x①Ⅷ", "ſtraße ﬁ", "a\u0301 \u200b", "Ǆ ꙁ"]
    df = spark.createDataFrame(list(enumerate(texts)), "row_index bigint, t string")
    got = {r.row: bytes(r.body) for r in layout.canonical_rows(df, "row_index", ["t"], False, "t").collect()}
    assert got == {i: layout.canonical(t) for i, t in enumerate(texts)}


def test_fields_do_not_run_into_each_other(spark):
    df = spark.createDataFrame([(0, "ab", "c"), (1, "a", "bc"), (2, None, None), (3, "", "-")], "row_index bigint, prompt string, response string")
    assert groups(spark, df, ["prompt", "response"]) == {0: 0, 1: 1, 2: 2, 3: 2}


def test_json_objects_by_name(spark):
    payloads = ['{"a": "X y", "b": 1}', '{"b":1 ,"a":"x-Y"}', '{"b": "1", "a": "xy"}', '{"a": "xy"}', "{broken", None, "[1]", '{"a": null, "b": {"d": 1, "c": 2}}', '{"b": {"c": 2, "d": 1}, "a": ""}']
    df = spark.createDataFrame(list(enumerate(payloads)), "row_index bigint, payload string")
    assert groups(spark, df, ["payload"], True) == {0: 0, 1: 0, 2: 0, 3: 3, 7: 7, 8: 7}


def test_counts_and_empty(spark):
    df = spark.createDataFrame([(5, "a", "b"), (3, "A", "b!"), (4, "c", "d")], "row_index bigint, prompt string, response string")
    rows = layout.canonical_rows(df, "row_index", ["prompt", "response"], False, "t")
    assert {(r.rep, r.n_copies) for r in layout.copy_counts(rows).collect()} == {(3, 2), (4, 1)}
    assert groups(spark, df.limit(0), ["prompt", "response"]) == {}


def test_trie_counts():
    t = layout.Trie()
    keys = [b"", b"a", b"ab", b"abc", b"abd", b"b", b"ab", b"", b"abd", b"abd"]
    for k in keys:
        t.add(k)[0] += 1
    assert [t.add(k)[0] for k in (b"", b"a", b"ab", b"abc", b"abd", b"b", b"ac")] == [2, 1, 2, 1, 3, 1, 0]


def model_lengths(rows):
    return {r[0]: len((r[2] or "").split()) + len((r[3] or "").split()) + 1 for r in rows}


@pytest.mark.parametrize("limits", [{}, {"block_rows": 7, "plan_rows": 20}])
def test_packing_keeps_the_rules(spark, limits):
    rng = random.Random(6)
    rows = [(i, rng.choice(["train", " Train ", "test", None]), rng.choice([None, "", "a b", "a b c"]), "w " * rng.choice([0, 1, 2, 2, 2, 9, 30, 64])) for i in range(400)]
    df = spark.createDataFrame(rows, "row_index bigint, dataset_split string, prompt string, response string")
    records = df.select("row_index", F.lower(F.trim("dataset_split")).alias("split"), pack.record_length("prompt", "response").alias("length"))
    runs = spark.createDataFrame([("a", "train", 16), ("b", "train", 64), ("c", "test", 5), ("none", None, 9), ("zero", "test", None), ("a", "train", 16)], "config_name string, split string, max_length int")
    got = pack.pack_records(records, runs, **limits).collect()
    lengths, split = model_lengths(rows), {r[0]: (r[1] or "").strip().lower() for r in rows}
    for name, s, cap in (("a", "train", 16), ("b", "train", 64), ("c", "test", 5)):
        mine, pieces, sequences = [r for r in got if r.config_name == name], {}, {}
        for r in mine:
            pieces.setdefault(r.row_index, []).append((r.piece, r.length))
            sequences.setdefault(r.sequence, []).append((r.place, r.length))
        assert set(pieces) == {i for i, x in split.items() if x == s}
        for i, p in pieces.items():
            assert sorted(k for k, _ in p) == list(range(len(p))) and sum(n for _, n in p) == lengths[i]
            assert len(p) >= -(-lengths[i] // cap) and (len(p) == 1 or lengths[i] > cap)
            assert all(n >= min(pack.MIN_PIECE, lengths[i] % cap) for _, n in p if lengths[i] > cap)
        for items in sequences.values():
            end = 0
            for place, n in sorted(items):
                assert place == end
                end += n
            assert end <= cap
        assert sorted(sequences) == list(range(len(sequences)))
        total = sum(lengths[i] for i in pieces)
        assert len(sequences) <= 1.2 * -(-total // cap) + 1
    assert {r.config_name for r in got} == {"a", "b", "c"}
    report = {r.config_name: r for r in pack.fill_report(pack.pack_records(records, runs, **limits)).collect()}
    assert report["a"].n_words == sum(lengths[i] for i, x in split.items() if x == "train") and 0 < report["a"].fill <= 1


def test_runs_of_one_name_are_packed_each(spark):
    records = spark.createDataFrame([(i, "train", 3 + i % 9) for i in range(50)] + [(None, "train", 4)], "row_index bigint, split string, length bigint")
    runs = spark.createDataFrame([("a", "train", 8), ("a", "train", 16), ("a", "train", 8)] + [(f"r{i}", "train", 8) for i in range(30)], "config_name string, split string, max_length int")
    got = pack.pack_records(records, runs, plan_rows=100).collect()
    words = sum(3 + i % 9 for i in range(50)) + 4
    for cap in (8, 16):
        mine = [r for r in got if r.config_name == "a" and r.max_length == cap]
        assert sum(r.length for r in mine) == words and any(r.row_index is None for r in mine)
    assert not {r.sequence for r in got if r.config_name == "a" and r.max_length == 8} & {r.sequence for r in got if r.config_name == "a" and r.max_length == 16}
    for i in range(30):
        assert sum(r.length for r in got if r.config_name == f"r{i}") == words


def test_packing_empty(spark):
    records = spark.createDataFrame([], "row_index bigint, split string, length bigint")
    runs = spark.createDataFrame([("a", "train", 16)], "config_name string, split string, max_length int")
    assert pack.pack_records(records, runs).count() == 0
    assert pack.pack_records(records, runs.limit(0)).count() == 0


def check_plan(whole, rests, cap):
    slots, n = pack.plan_slots(whole, rests, cap)
    used, placed = [0] * n, {}
    for cut, length, lo, hi, seq, place, part, words in sorted(slots, key=lambda x: x[5]):
        for r in range(lo, hi):
            assert used[seq + r - lo] == place
            used[seq + r - lo] += words
            placed.setdefault((cut, length, r), {})[part] = words
    assert max(used, default=0) <= cap and all(used)
    for cut, counts in ((False, whole), (True, rests)):
        for length, count in counts.items():
            for r in range(count):
                parts = placed.pop((cut, length, r))
                assert sorted(parts) == list(range(len(parts))) and sum(parts.values()) == length and (cut or len(parts) == 1)
    assert not placed
    return n


def test_plans_keep_the_rules():
    rng = random.Random(7)
    for _ in range(300):
        cap = rng.choice([5, 17, 64, 128])
        draw = lambda: {n: rng.randint(1, 40) for n in rng.sample(range(1, cap + 1), rng.randint(0, min(cap, 12)))}
        whole, rests = draw(), {k: v for k, v in draw().items() if k < cap}
        n = check_plan(whole, rests, cap)
        assert n >= -(-sum(k * v for c in (whole, rests) for k, v in c.items()) // cap)
    assert check_plan({6: 2, 4: 2, 3: 1, 1: 5}, {}, 10) == 3
    assert check_plan({100: 10}, {56: 5}, 128) == 10  # every rest is cut to fill two rooms
    assert check_plan({}, {}, 10) == 0
