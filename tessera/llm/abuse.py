"""Abusive, hateful or sexual language: FTRL-proximal logistic regression over hashed n-grams.

Spellings are undone first (marks inside words, look-alike letters and digits, spread or repeated
letters), then every sentence becomes hashed word 1- to 3-grams and skip-grams.  One model for each
category is fitted by FTRL-proximal on raters' opinions about a bounded sample of documents
(``TRAIN_DOCS``): first on whole documents, then on sentences, where a document's opinion falls to
its most suspicious sentences.  L1 keeps few weights, which are broadcast; scoring reads the corpus
once without a shuffle, and a document's score is that of its worst sentence.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.text import mix, word_hash
from tessera.session import spread

CATEGORIES = ("abusive", "hateful", "sexual")
#: Hashed features, and the most labelled documents the models are fitted on (the driver holds them).
BUCKETS, TRAIN_DOCS = 1 << 20, 12_000
#: FTRL-proximal: learning rate, its smoothing, L1 and L2.
ALPHA, BETA, L1, L2 = 0.1, 1.0, 0.5, 0.5
BATCH = 256
#: A sentence of few features counts as one of so many.
LEAST_FEATURES = 16
#: Share of the sentences of unsuspicious documents that serve as counterexamples.
NEGATIVES = 0.3
#: Scores from which a sentence counts.
THRESHOLDS = {"abusive": 0.3, "hateful": 0.25, "sexual": 0.3}
CACHE = 300_000

# Digits and signs used for letters, letters of other scripts that look like Latin ones.
LEET = str.maketrans("0134578@$!|€£+", "oieastbasiielt")
LOOKALIKE = str.maketrans("аеорсухівкмнтԁѕјһɡαεορτυνικхӏ", "aeopcyxibkmhtdsjhgaeoptuvikxl")
INVISIBLE = re.compile(r"[­͏؜ᅟᅠ឴឵᠋-᠏​-‏‪-‮⁠-⁯︀-️﻿￹-￻]")
SPREAD = re.compile(r"(?<![^\W_])(?:[^\W\d_][ \t]){2,}[^\W\d_](?![^\W_])")
SPREAD_MARKS = re.compile(r"(?:[^\W_][._\-*~|/+']){2,}[^\W_]")
TOKEN = re.compile(r"[^\W\d_]\*+[^\W\d_]*|[^\W_]+(?:'[^\W_]+)?")
REPEAT = re.compile(r"([^\W\d_])\1{2,}")
LATIN = re.compile(r"[a-z]")
#: Interjections that are written together with the next word.
GLUED = re.compile(r"(lol|lmao|rofl|omg|wtf)(?=[^\W\d_]{2})")
STOP = ".!?。！？…"
BREAK = "\x00"
#: A capitalised word begins a new sentence, with or without a stop, after so many words.
SENTENCE_WORDS = 5


def plain_tokens(chunk: str) -> list[str]:
    """Words of one white-space-free piece of text, their spelling undone."""
    s = unicodedata.normalize("NFKC", INVISIBLE.sub("", chunk)).lower()
    if not s.isascii():
        s = "".join(c for c in unicodedata.normalize("NFD", s) if unicodedata.category(c) != "Mn")
        if LATIN.search(s):
            s = s.translate(LOOKALIKE)
    s = s.replace("’", "'")
    if SPREAD_MARKS.search(s):
        s = SPREAD_MARKS.sub(lambda m: re.sub(r"[._\-*~|/+']", "", m.group(0)), s)
    core = s.strip(".,;:?\"'()[]{}«»“”„‘’<>…-–—")
    if not core.endswith("!") or not core[:-1].isalpha():
        if LATIN.search(core) and not core.isalpha() and re.search(r"[0-9@$!|€£+]", core.rstrip("!")):
            s = s.replace(core, core.rstrip("!").translate(LEET))
    out = []
    for t in TOKEN.findall(s):
        t = REPEAT.sub(r"\1", t)
        if "*" in t:
            out.append("*")  # some masked word, then which one
        elif m := GLUED.match(t):
            out.append(m[0])
            t = t[m.end() :]
        out.append(t)
    return out


class Sentences:
    """Texts to hashed features by sentence."""

    def __init__(self):
        self.cache: dict[str, tuple[tuple[int, ...], bool, bool]] = {}

    def _chunk(self, chunk: str) -> tuple[tuple[int, ...], bool, bool]:
        """(token hashes, ends a sentence, may begin one)."""
        ends = chunk == BREAK or chunk.rstrip("\"'”»)]").endswith(tuple(STOP))
        # A capitalised word; of single letters, the articles and prepositions that begin sentences ("I" is always a capital).
        return tuple(map(word_hash, plain_tokens(chunk))), ends, chunk in ("A", "À") or chunk[:1].isupper() and chunk[1:2].islower()

    def tokens(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(token hashes, sentence of each token, document of each sentence)."""
        cache, out, sent, doc, n = self.cache, [], [], [], 0
        for d, text in enumerate(texts):
            if text:
                text = text.replace("\n", " \x00 ").replace("。", "。 ")
                if SPREAD.search(text):
                    text = SPREAD.sub(lambda m: m.group(0).replace(" ", "").replace("\t", ""), text)
                begun = len(out)
                for chunk in text.split():
                    got = cache.get(chunk)
                    if got is None:
                        if len(cache) >= CACHE:
                            cache.clear()
                        got = cache[chunk] = self._chunk(chunk)
                    if got[2] and len(out) - begun >= SENTENCE_WORDS:
                        doc.append(d)
                        n += 1
                        begun = len(out)
                    if got[0]:
                        out.extend(got[0])
                        sent.extend([n] * len(got[0]))
                    if got[1] and len(out) > begun:
                        doc.append(d)
                        n += 1
                        begun = len(out)
                if len(out) > begun:
                    doc.append(d)
                    n += 1
        return np.array(out, np.uint64), np.array(sent, np.int64), np.array(doc, np.int64)

    def features(self, texts: list[str | None], in_order: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bucket, sentence of the bucket, document of each sentence)."""
        h, s, d = self.tokens(texts)
        found, owner = [h], [s]
        with np.errstate(over="ignore"):
            for gap, salt in ((1, 11), (2, 12), (3, 13)):
                if len(h) > gap:
                    ok = s[gap:] == s[:-gap]
                    found.append(mix(h[:-gap] * np.uint64(2 * salt + 1) + h[gap:] + np.uint64(salt))[ok])
                    owner.append(s[gap:][ok])
            if len(h) > 2:
                ok = s[2:] == s[:-2]
                found.append(mix(mix(h[:-2] * np.uint64(31) + h[1:-1]) * np.uint64(37) + h[2:])[ok])
                owner.append(s[2:][ok])
        bucket = (mix(np.concatenate(found)) & np.uint64(BUCKETS - 1)).astype(np.int64)
        owner = np.concatenate(owner)
        if not in_order:
            return bucket, owner, d
        order = np.argsort(owner, kind="stable")
        return bucket[order], owner[order], d


class FTRL:
    """FTRL-proximal logistic regression of several categories at once, in mini-batches."""

    def __init__(self, k: int = len(CATEGORIES)):
        self.z = np.zeros((BUCKETS, k))
        self.n = np.zeros((BUCKETS, k))
        self.bias = np.full(k, -3.0)
        self.bias_n = np.zeros(k)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def fit(self, bucket: np.ndarray, owner: np.ndarray, y: np.ndarray, weight: np.ndarray, seed: int) -> None:
        """One pass over the instances (rows of y) in random order; weight 0 leaves one out.
        ``owner`` is in order."""
        counts = np.bincount(owner, minlength=len(y))
        at = np.concatenate([[0], np.cumsum(counts)])
        use = np.flatnonzero((weight.sum(axis=1) > 0) & (counts > 0))
        use = np.random.default_rng(seed).permutation(use)
        for b in range(0, len(use), BATCH):
            rows = use[b : b + BATCH]
            size = counts[rows]
            place = np.repeat(at[rows] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            uniq, inv = np.unique(bucket[place], return_inverse=True)
            who = np.repeat(np.arange(len(rows)), size)
            w = self.weights(uniq)
            value = np.repeat(scale(size), size)
            score = np.stack([np.bincount(who, value * w[inv, k], len(rows)) for k in range(w.shape[1])], axis=1) + self.bias
            error = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - y[rows]) * weight[rows]
            g = np.stack([np.bincount(inv, value * error[who, k], len(uniq)) for k in range(w.shape[1])], axis=1)
            g2 = np.stack([np.bincount(inv, (value * error[who, k]) ** 2, len(uniq)) for k in range(w.shape[1])], axis=1)
            n = self.n[uniq]
            sigma = (np.sqrt(n + g2) - np.sqrt(n)) / ALPHA
            self.z[uniq] += g - sigma * w
            self.n[uniq] = n + g2
            e = error.sum(axis=0)
            self.bias_n += (error**2).sum(axis=0)
            self.bias -= ALPHA * e / (BETA + np.sqrt(self.bias_n))


def scale(size: np.ndarray) -> np.ndarray:
    """The value of a feature of an instance with ``size`` features."""
    return 4.0 / np.sqrt(np.maximum(size, LEAST_FEATURES))


def score_instances(weights: np.ndarray, bias: np.ndarray, bucket: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Probability of each category for each of ``n`` instances."""
    size = np.bincount(owner, minlength=n)
    total = np.stack([np.bincount(owner, weights[bucket, k], n) for k in range(weights.shape[1])], axis=1)
    return 1 / (1 + np.exp(-np.clip(total * scale(size)[:, None] + bias, -30, 30)))


def sample_labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, category_col: str, most: int):
    """At most ``most`` labelled documents, in the order of a hash of their id: (text, categories)."""
    opinions = (
        labels.where(F.col(category_col).isNotNull())
        .select(F.col(id_col).alias("id"), F.lower(F.trim(category_col)).alias("c"))
        .groupBy("id")
        .agg(F.collect_set("c").alias("said"), F.count("*").alias("n"), *(F.count_if(F.col("c") == c).alias(c) for c in CATEGORIES))
        .orderBy(F.xxhash64("id"), "id")
        .limit(most)
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    # The opinions are at most ``most`` rows, so the texts are filtered where they are read.
    return texts.join(F.broadcast(opinions), "id").orderBy("id").limit(most).select("text", "n", *CATEGORIES).toArrow()


def fit(texts: list[str], said: np.ndarray, opinions: np.ndarray, rounds: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """(weights [bucket, category], bias).  ``said`` counts a document's opinions by category, of
    ``opinions`` in all; a category holds for it if at least half of them name it."""
    bucket, owner, doc = Sentences().features(texts, in_order=True)
    yes = said * 2 >= np.maximum(opinions, 1)[:, None]
    yes &= said > 0
    unsure = (said > 0) & ~yes
    model = FTRL()
    if not len(owner):
        return model.weights(), model.bias
    some = yes.any(axis=1)
    balance = np.where(yes, np.minimum(20.0, len(yes) / np.maximum(3 * yes.sum(axis=0), 1)), 1.0)
    for epoch in range(2):
        model.fit(bucket, doc[owner], yes.astype(float), np.where(unsure, 0.0, balance), epoch)
    lucky = np.random.default_rng(3).random(len(doc)) < NEGATIVES
    for r in range(rounds):
        p = score_instances(model.weights(), model.bias, bucket, owner, len(doc))
        best = np.zeros((len(texts), p.shape[1]))
        np.maximum.at(best, doc, p)
        top = p >= best[doc] * 0.999
        # In a document of the category the worst sentences are its cases; the others are unknown in
        # the first round, and in the next sound unless suspicious.
        pos = yes[doc] & (top | (p >= 0.5)) if not r else yes[doc] & ((p >= 0.3) | (top & (p >= 0.03)))
        neg = ~yes[doc] & ~unsure[doc] & (lucky | some[doc] | (p.max(axis=1) > 0.05))[:, None]
        if r:
            neg |= yes[doc] & (p < 0.1)
            neg &= p < 0.9  # opinions that miss a case
        model = FTRL()
        for epoch in range(2):
            model.fit(bucket, owner, pos.astype(float), (pos | neg).astype(float), 10 * r + epoch)
    return model.weights(), model.bias


def score_documents(docs: DataFrame, weights: np.ndarray, bias: np.ndarray, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), least: float = 0.0) -> DataFrame:
    """(id, keep..., abusive, hateful, sexual): scores of every row, or of those with one of at least
    ``least``.  Null and blank texts score 0; repeated rows are scored each."""
    used = np.flatnonzero((weights != 0).any(axis=1))
    shared = docs.sparkSession.sparkContext.broadcast((used, weights[used].astype(np.float32), bias))
    kept = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in (id_col, *keep)]
    names = [id_col, *keep, *CATEGORIES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, w, b = shared.value
        table = np.zeros((BUCKETS, len(CATEGORIES)), np.float32)
        table[at] = w
        make = Sentences()
        for batch in batches:
            for part in (batch.slice(i, 2_000) for i in range(0, batch.num_rows, 2_000)):
                bucket, owner, doc = make.features(part.column(0).to_pylist())
                worst = np.zeros((part.num_rows, len(CATEGORIES)))
                if len(doc):
                    np.maximum.at(worst, doc, score_instances(table, b, bucket, owner, len(doc)))
                on = pa.array((worst >= least).any(axis=1))
                cols = [part.column(i) for i in range(1, part.num_columns)] + [pa.array(worst[:, k]) for k in range(len(CATEGORIES))]
                yield pa.RecordBatch.from_arrays(cols, names).filter(on)

    source = spread(docs.select(F.col(text_col).alias("__text"), F.col(id_col), *(F.col(c) for c in keep)))
    return source.mapInArrow(run, ", ".join([*kept, *(f"{c} double" for c in CATEGORIES)]))


def fit_labels(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", category_col: str = "category", most: int = TRAIN_DOCS):
    rows = sample_labelled(docs, labels, id_col, text_col, category_col, most)
    said = np.stack([rows.column(c).to_numpy() for c in CATEGORIES], axis=1) if rows.num_rows else np.zeros((0, len(CATEGORIES)))
    return fit(rows.column("text").to_pylist(), said, rows.column("n").to_numpy())


def found(scores: DataFrame, id_col: str = "doc_id", thresholds: dict[str, float] = THRESHOLDS) -> DataFrame:
    """(id, category, score): one row for each category that a document reaches."""
    each = F.array(*(F.struct(F.lit(c).alias("category"), F.col(c).alias("score"), F.lit(thresholds[c]).alias("least")) for c in CATEGORIES))
    return scores.select(id_col, F.explode(each).alias("x")).where("x.score >= x.least").select(id_col, "x.category", "x.score")


def rates(scores: DataFrame, source_col: str, thresholds: dict[str, float] = THRESHOLDS) -> DataFrame:
    """Per source: documents, and the share with each category."""
    flags = [F.round(F.avg((F.col(c) >= thresholds[c]).cast("double")), 6).alias(f"{c}_rate") for c in CATEGORIES]
    return scores.groupBy(F.coalesce(source_col, F.lit("(none)")).alias(source_col)).agg(F.count("*").alias("n_documents"), *flags)
