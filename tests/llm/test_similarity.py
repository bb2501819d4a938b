import random

import pytest
from pyspark.sql import functions as F

from tessera.llm import near_dup, signatures, split_overlap
from tessera.llm.similarity import components
from tessera.llm.text import flat_shingles, flat_words, sequence_keys, words

VOCAB = [f"w{i}" for i in range(400)]


def edited(rng, base, edits):
    t = list(base)
    for _ in range(edits):
        k = rng.randrange(len(t))
        t[k : k + rng.choice([0, 1])] = [rng.choice(VOCAB)]
    return t


def runs(text, size):
    w = words(text)
    return {tuple(w)} if len(w) < size else set(zip(*(w[i:] for i in range(size))))


def brute(texts, size, threshold):
    keys = list(texts)
    sets = {k: runs(texts[k], size) for k in keys}
    return {(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])}


def corpus(seed=3, families=25):
    rng, texts, n = random.Random(seed), {}, 0
    for _ in range(families):
        base = rng.choices(VOCAB, k=rng.randint(5, 60))
        for _ in range(rng.randint(1, 5)):
            texts[n] = " ".join(edited(rng, base, rng.randint(0, 4)))
            n += 1
    texts |= {n: "", n + 1: "  ", n + 2: "one", n + 3: "ONE!", n + 4: "one two", n + 5: texts[0].upper(), n + 6: "x " * 30_000}
    return texts


def frame(spark, texts):
    rows = [(k, t[: len(t) // 2] if t.strip() else None, t[len(t) // 2 :], "clash", 7) for k, t in texts.items()]
    rows = [(k, None, t, "clash", 7) for k, t in texts.items()]
    return spark.createDataFrame(rows, "row_index bigint, prompt string, response string, key string, a int")


def test_flat_words_are_those_of_the_pattern():
    texts = ["", None, "A-b_c ÄÖ 1²", "İx ΑΣ Σ", "\x00a\n", "ab a b ba", "日本 x" * 30_000, "aa", "a\ta", "_", "\ud800 q"]
    flat, ends = flat_words(texts)
    flat, seen = flat.tolist(), {}
    assert ends.tolist()[0] == 0 and len(ends) == len(texts) + 1
    for k, t in enumerate(texts):
        mine = flat[ends[k] : ends[k + 1]]
        assert len(mine) == len(words(t))
        assert all(seen.setdefault(w, h) == h for w, h in zip(words(t), mine, strict=True))
    assert len(set(seen.values())) == len(seen)


def test_flat_shingles_match_a_plain_model():
    texts = ["a b c d", "a b", "", None, "a b c d", "d c b a a b c d"]
    flat, ends = flat_words(texts)
    sh, at = flat_shingles(flat, ends, 3)
    sets = [set(sh[at[i] : at[i + 1]].tolist()) for i in range(len(texts))]
    for i, x in enumerate(texts):
        for j, y in enumerate(texts):
            assert len(sets[i] & sets[j]) == len(runs(x or "", 3) & runs(y or "", 3))
    keys = sequence_keys(flat, ends)
    assert keys[0] == keys[4] and keys[2] == keys[3] and len(set(keys.tolist())) == 4


@pytest.mark.parametrize("limits", [{}, {"limit": 2, "held": 8, "block": 3}])
def test_forest_finds_what_brute_force_finds(spark, limits):
    texts = corpus()
    members, links = near_dup.near_duplicates(frame(spark, texts), size=3, threshold=0.5, **limits)
    got = {(r.row_index_a, r.row_index_b) for r in near_dup.row_pairs(members, links).collect()}
    want = brute(texts, 3, 0.5)
    assert not got - want
    assert len(want - got) <= (0 if not limits else 0.03 * len(want))
    assert links.count() == links.select(F.least("a", "b"), F.greatest("a", "b")).distinct().count()


def test_dense_family_keeps_all_its_links(spark):
    """One family holds most rows: regions are far over the limits, and no link may be lost."""
    rng = random.Random(5)
    base = rng.choices(VOCAB, k=250)
    texts = {i: " ".join(edited(rng, base, 1)) for i in range(60)} | {100 + i: " ".join(rng.choices(VOCAB, k=40)) for i in range(20)}
    members, links = near_dup.near_duplicates(frame(spark, texts), size=5, threshold=0.8, limit=4, held=16, block=8)
    got = {(r.row_index_a, r.row_index_b) for r in near_dup.row_pairs(members, links).collect()}
    assert got == brute(texts, 5, 0.8) and len(got) > 1000


def test_groups_and_copies(spark):
    texts = {0: "a b c d e f g h", 1: "a b c d e f g x", 2: "A, b c d e f g h", 3: "nothing like it here"}
    members, links = near_dup.near_duplicates(frame(spark, texts), size=3, threshold=0.5)
    got = {r.row: (r.class_id, r.group_id, r.n_links) for r in near_dup.groups(members, links).collect()}
    assert got == {0: (0, 0, 1), 2: (0, 0, 1), 1: (1, 0, 1), 3: (3, 3, 0)}


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 20)] + [(100, x) for x in range(101, 120)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert {got[i] for i in range(21)} == {0} and {got[i] for i in range(100, 120)} == {100}


def test_empty_table_and_repeated_rows(spark):
    empty = frame(spark, {0: "x"}).limit(0)
    members, links = near_dup.near_duplicates(empty)
    assert members.count() == links.count() == near_dup.row_pairs(members, links).count() == 0
    held = F.lit(None).cast("boolean")
    members, links = split_overlap.split_overlaps(empty, held)
    assert members.count() == links.count() == 0
    twice = frame(spark, {0: "a b c d e f"}).union(frame(spark, {0: "a b c d e f"}))
    assert near_dup.row_pairs(*near_dup.near_duplicates(twice)).count() == 0


def test_overlaps_across_splits(spark):
    texts = {k: t for k, t in corpus(9, 60).items() if k < 10_000}
    df = frame(spark, texts).withColumn("text", F.col("response"))
    held = F.when(F.col("row_index") % 3 == 0, True).when(F.col("row_index") % 7 != 1, False)
    members, links = split_overlap.split_overlaps(df, held, text_col="text", size=3, threshold=0.5)
    got = {tuple(sorted((r.train_row, r.held_row))) for r in split_overlap.row_pairs(members, links).collect()}
    side = lambda k: 1 if k % 3 == 0 else 0 if k % 7 != 1 else None
    want = {(a, b) for a, b in brute({k: t for k, t in texts.items() if words(t)}, 3, 0.5) if {side(a), side(b)} == {0, 1}}
    assert not got - want and len(want - got) <= 0.05 * len(want)


def test_overlap_report(spark):
    df = spark.createDataFrame([(0, "a b c d e", "train", "s"), (1, "a b c d e", "test", "s"), (2, "q r s t u v", "test", None), (3, None, "test", "s")], "row_index bigint, prompt string, split string, source string")
    held = F.when(F.col("split") == "test", True).when(F.col("split") == "train", False)
    out = split_overlap.split_overlaps(df, held)
    got = {(r.split, r.source): (r.n_rows, r.n_exact, r.n_near) for r in split_overlap.overlap_report(*out, df, "row_index", F.col("split"), F.col("source")).collect()}
    assert got == {("test", "s"): (1, 1, 0), ("test", None): (1, 0, 0)}


def test_overlaps_that_share_one_passage(spark):
    """Pairs near the threshold that share a long passage and differ in another are all found."""
    rng, texts = random.Random(11), {}
    for k in range(0, 600, 2):
        base, other = rng.choices(VOCAB, k=40), rng.choices(VOCAB, k=36)
        texts[k] = " ".join(base)
        texts[k + 1] = " ".join(base + other if k % 4 else base[:28] + other[:10])
    df = frame(spark, texts)
    _, links = out = split_overlap.split_overlaps(df, F.col("row_index") % 2 == 1, text_col="response", size=3, threshold=0.5)
    got = {tuple(sorted((r.train_row, r.held_row))) for r in split_overlap.row_pairs(*out).collect()}
    want = {(a, b) for a, b in brute(texts, 3, 0.5) if (a + b) % 2}
    assert got == want and len(want) > 250 and links.count() == len(want)


def test_forest_near_the_threshold(spark):
    """Of pairs with a similarity of 0.5 to 0.6 none is missed here."""
    rng, texts = random.Random(21), {}
    for k in range(0, 3000, 2):
        base = [f"v{rng.randrange(20_000)}" for _ in range(60)]
        texts[k], texts[k + 1] = " ".join(base), " ".join(edited(rng, base, rng.randint(5, 6)))
    sets = {k: runs(t, 3) for k, t in texts.items()}
    sims = {(k, k + 1): len(sets[k] & sets[k + 1]) / len(sets[k] | sets[k + 1]) for k in range(0, 3000, 2)}
    want = {p for p, x in sims.items() if 0.5 <= x < 0.6}
    out = near_dup.near_duplicates(frame(spark, texts), size=3, threshold=0.5)
    got = {(r.row_index_a, r.row_index_b) for r in near_dup.row_pairs(*out).collect()}
    assert not {p for p in got if sims[p] < 0.5}
    missed = want - got
    assert len(want) > 300 and not missed


@pytest.mark.parametrize("limits", [{"limit": 8}, {"limit": 8, "held": 100}])
def test_recall_where_most_regions_are_crowded(spark, limits):
    """All texts share a part; nearly every region with company is over the limit, and some leave the
    task.  Pairs with a similarity of 0.5 to 0.6 are still found."""
    rng, texts = random.Random(31), {}
    shared = rng.choices(VOCAB, k=22)
    for k in range(0, 1200, 2):
        own = [f"v{rng.randrange(20_000)}" for _ in range(50)]
        texts[k], texts[k + 1] = " ".join(own + shared), " ".join(edited(rng, own, rng.randint(7, 9)) + shared)
    sets = {k: runs(t, 3) for k, t in texts.items()}
    sims = {(k, k + 1): len(sets[k] & sets[k + 1]) / len(sets[k] | sets[k + 1]) for k in range(0, 1200, 2)}
    want = {p for p, x in sims.items() if 0.5 <= x < 0.6}
    df = frame(spark, texts)
    sizes = [r["count"] for r in signatures.entries(signatures.sign(df, "row_index", F.col("response"), 3)).groupBy("region").count().where("count > 2").collect()]
    assert sum(x for x in sizes if x > 8) > 0.9 * sum(sizes) and max(sizes) > 100
    out = near_dup.near_duplicates(df, size=3, threshold=0.5, **limits)
    got = {(r.row_index_a, r.row_index_b) for r in near_dup.row_pairs(*out).collect()}
    assert len(want) > 150 and len(want & got) >= 0.97 * len(want)
    assert all(sims[p] >= 0.5 for p in got)
    held_out = F.col("row_index") % 2 == 1
    _, links = split_overlap.split_overlaps(df, held_out, text_col="response", size=3, threshold=0.5, **limits)
    assert abs(links.count() - len(got)) <= 0.03 * len(got)


def test_radius():
    assert signatures.radius(0.5) == 33 and signatures.radius(1.0) == 0 and signatures.radius(0.8) < signatures.radius(0.5)
