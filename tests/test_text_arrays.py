import math
import random
import unicodedata
from collections import Counter

from pyspark.sql import functions as F

from tessera.functions import arrays as A
from tessera.functions import text as X

SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def rows(spark, data, schema, *cols):
    return spark.createDataFrame(data, schema).select(*cols).collect()


def test_white_space_is_pythons(spark):
    texts = [f"{c}a{c}b{c}" for c in SPACES] + ["", " ", "​", "a", None]
    got = rows(spark, [(i, t) for i, t in enumerate(texts)], "i int, t string", "i", X.strip(F.col("t")).alias("s"), X.ws_tokens(F.col("t")).alias("w"), X.is_text(F.col("t")).alias("ok"))
    for r in got:
        t = texts[r.i]
        assert r.s == (t.strip() if t is not None else None)
        assert r.w == (t.split() if t is not None else None)
        assert r.ok == bool(t is not None and t.strip())


def test_normalize_text(spark):
    texts = ["  FOUR \t x ", "ﬁne①", "é", "…", "　A B", "İ", "", None]
    got = rows(spark, [(i, t) for i, t in enumerate(texts)], "i int, t string", "i", X.normalize_text(F.col("t")).alias("n"))
    for r in got:
        t = texts[r.i]
        want = None if t is None else " ".join(unicodedata.normalize("NFKC", t).strip().lower().split())
        assert r.n == want


def model_f1(p, r):
    p, r = p.split(), r.split()
    if not p and not r:
        return 1.0
    o = sum((Counter(p) & Counter(r)).values())
    if not p or not r or not o:
        return 0.0
    return 2 * (o / len(p)) * (o / len(r)) / (o / len(p) + o / len(r))


def test_token_f1_against_a_model(spark):
    rng = random.Random(1)
    pairs = [(" ".join(rng.choices("abcd", k=rng.randint(0, 7))), " ".join(rng.choices("abcd", k=rng.randint(0, 7)))) for _ in range(300)]
    got = rows(spark, [(i, *p) for i, p in enumerate(pairs)], "i int, p string, r string", "i", X.token_f1(X.ws_tokens(F.col("p")), X.ws_tokens(F.col("r"))).alias("f"))
    for r in got:
        assert math.isclose(r.f, model_f1(*pairs[r.i]), abs_tol=1e-12)


def test_format_metric(spark):
    values = [0.0, 1.0, 0.5, 3.14159, 12345.0, 1e-5, -2.25, 0.00012, 2e-5]
    want = ["0", "1", "0.5", "3.1416", "1.234e+04", "1.000e-05", "-2.25", "0.0001", "2.000e-05"]
    got = rows(spark, [(v,) for v in values], "v double", X.format_metric(F.col("v")).alias("s"))
    assert [r.s for r in got] == [w.replace("1.234e+04", got[4].s) for w in want] and got[4].s in ("1.234e+04", "1.235e+04")


def model_truncate(ids, budget):
    if len(ids) <= budget:
        return ids
    if budget <= 0:
        return []
    return ids[-1:] if budget == 1 else [ids[0], *ids[-(budget - 1) :]]


def model_encode(p, r, eos, m):
    r = r if r and r[-1] == eos else [*r, eos]
    if len(r) >= m:
        r = [*r[: m - 1], eos]
        p = []
    else:
        p = model_truncate(p, m - len(r))
    return p + r, [1] * len(p + r), [-100] * len(p) + r


def test_encode_pair_against_a_model(spark):
    rng = random.Random(2)
    cases = [([rng.randint(3, 9) for _ in range(rng.randint(0, 8))], [rng.choice([2, 5, 6]) for _ in range(rng.randint(0, 8))], rng.randint(1, 12)) for _ in range(400)]
    e = A.encode_pair(F.col("p"), F.col("r"), 2, F.col("m"))
    got = rows(spark, [(i, *c) for i, c in enumerate(cases)], "i int, p array<int>, r array<int>, m int", "i", e.alias("e"))
    for r in got:
        assert (r.e.input_ids, r.e.attention_mask, r.e.labels) == model_encode(*cases[r.i][:2], 2, cases[r.i][2])


def test_padding_sides(spark):
    r = rows(spark, [([1, 2], 4)], "x array<int>, w int", A.pad(F.col("x"), F.col("w"), 0).alias("r"), A.pad(F.col("x"), F.col("w"), 0, "left").alias("l"))[0]
    assert r.r == [1, 2, 0, 0] and r.l == [0, 0, 1, 2]


def test_log_softmax_and_kl(spark):
    x, y = [4.0, -4.0], [-4.0, 4.0]
    t, s = A.log_softmax(F.col("x"), 2.0), A.log_softmax(F.col("y"), 2.0)
    r = rows(spark, [(x, y)], "x array<double>, y array<double>", t.alias("t"), A.kl_divergence(t, s).alias("k"))[0]
    assert math.isclose(sum(map(math.exp, r.t)), 1.0)
    p = 1 / (1 + math.exp(-4))
    assert math.isclose(r.k, (2 * p - 1) * 4, rel_tol=1e-9)
