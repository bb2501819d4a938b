"""Held-out test passages inside a training corpus: a generalised suffix automaton over words.

The items are normalised to words and put into one automaton, which is small, bounded by
``MAX_WORDS`` words and therefore safe to broadcast; a larger collection of items is split into
several automata, each of which scans the corpus.  The corpus itself is only streamed: one pass,
no shuffle before the aggregation of the few hits.  Texts without the hash of any run of the least
length are dropped a batch at a time; the automaton finds the matches of the others.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tessera.llm.text import WORD, flat_shingles, flat_words, words
from tessera.session import spread

#: Words of test items in one automaton; its broadcast stays under about 1 GB at this bound.
MAX_WORDS = 1_000_000
MIN_WORDS = 13
#: Bits of the table that drops most runs of words before their hashes are looked up.
BITS = 24


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences; every state knows the sequences it occurs in."""

    def __init__(self, min_words: int = MIN_WORDS):
        self.next: list[dict[str, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.min_words = min_words
        self.sequences: list[list[str]] = []

    def _extend(self, last: int, w: str) -> int:
        nxt, link, length = self.next, self.link, self.length
        if w in nxt[last]:  # a state for this word exists: reuse or split it
            q = nxt[last][w]
            if length[q] == length[last] + 1:
                return q
            return self._clone(last, q, w)
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][w]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, q, w)
        return cur

    def _clone(self, p: int, q: int, w: str) -> int:
        nxt, link, length = self.next, self.link, self.length
        c = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = c
        while p != -1 and nxt[p].get(w) == q:
            nxt[p][w] = c
            p = link[p]
        return c

    def add(self, sequence: list[str]) -> None:
        last = 0
        for w in sequence:
            last = self._extend(last, w)
        self.sequences.append(sequence)

    def finish(self) -> None:
        """For every state of at least ``min_words`` words: the state of its shortest such suffix,
        and there the numbers of the sequences that contain that suffix."""
        least, link, length = self.min_words, self.link, self.length
        self.short = [-1] * len(link)
        for v in sorted(range(len(link)), key=length.__getitem__):
            if length[v] >= least:
                self.short[v] = self.short[link[v]] if length[link[v]] >= least else v
        holders: dict[int, set[int]] = defaultdict(set)
        for k, seq in enumerate(self.sequences):
            v = 0
            for w in seq:
                v = self.next[v][w]
                if self.short[v] >= 0:
                    holders[self.short[v]].add(k)
        self.holders = {v: tuple(sorted(s)) for v, s in holders.items()}

    def hashes(self) -> np.ndarray:
        """Hashes of all runs of ``min_words`` words of the sequences, sorted."""
        flat, ends = flat_words([" ".join(s) for s in self.sequences])
        return np.unique(flat_shingles(flat, ends, self.min_words)[0]) if self.sequences else np.zeros(0, np.uint64)

    def runs(self, tokens: list[str]) -> dict[int, list[tuple[int, int]]]:
        """Per sequence: the maximal stretches (from, to) of ``tokens`` covered by common runs of
        at least ``min_words`` words."""
        nxt, link, length, least = self.next, self.link, self.length, self.min_words
        v, matched, root = 0, 0, self.next[0]
        out: dict[int, list[tuple[int, int]]] = {}
        for i, w in enumerate(tokens):
            if w not in root:
                v = matched = 0
                continue
            while w not in nxt[v]:
                v = link[v]
                matched = length[v]
            v = nxt[v][w]
            matched += 1
            if matched >= least:
                u = v
                while length[link[u]] >= least:
                    u = link[u]
                for k in self.holders.get(u, ()):
                    spans = out.setdefault(k, [])
                    if spans and spans[-1][1] >= i - least + 1:
                        spans[-1] = (spans[-1][0], i + 1)
                    else:
                        spans.append((i - least + 1, i + 1))
        return out


class Present:
    """Whether texts have any run of words of the sequences: by hash, so that the few texts that don't
    are let through, and none that do is lost."""

    def __init__(self, hashes: np.ndarray, size: int):
        self.hashes, self.size = hashes, size
        self.bits = np.zeros(1 << BITS, bool)
        self.bits[(hashes >> np.uint64(64 - BITS)).astype(np.int64)] = True

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        flat, ends = flat_words(texts)
        runs, at = flat_shingles(flat, ends, self.size)
        on = np.flatnonzero(self.bits[(runs >> np.uint64(64 - BITS)).astype(np.int64)])
        place = np.searchsorted(self.hashes, runs[on])
        on = on[self.hashes[np.minimum(place, len(self.hashes) - 1)] == runs[on]] if len(self.hashes) else on[:0]
        found = np.zeros(len(texts), bool)
        found[np.searchsorted(at, on, "right") - 1] = True
        return found & (np.diff(ends) >= self.size)


def _automata(items: DataFrame, id_col: str, text_col: str, min_words: int, max_words: int):
    """Automata over the items, each of at most ``max_words`` words (a longer item has its own)."""
    auto, ids, size = SuffixAutomaton(min_words), [], 0
    for key, text in items.select(id_col, text_col).orderBy(id_col).toLocalIterator():
        seq = words(text)
        if len(seq) < min_words:
            continue
        if size and size + len(seq) > max_words:
            auto.finish()
            yield auto, ids
            auto, ids, size = SuffixAutomaton(min_words), [], 0
        auto.add(seq)
        ids.append(key)
        size += len(seq)
    auto.finish()
    yield auto, ids


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    min_words: int = MIN_WORDS,
    max_words: int = MAX_WORDS,
) -> DataFrame:
    """One row for each row of ``docs`` and item with a common run of at least ``min_words`` words.

    Columns: doc id, item id, ``n_spans``, ``longest`` (words of the longest stretch), ``coverage``
    (words of the document's stretches over the item's words, at most 1), ``spans``
    (array of from/to character offsets).  Case and everything between words is ignored.  Null and
    empty texts, and items of fewer words, match nothing; repeated rows give their rows again; other
    columns are not looked at.
    """
    spark = docs.sparkSession
    out = None
    struct = StructType.fromDDL(
        f"{doc_id} {docs.schema[doc_id].dataType.simpleString()}, {item_id} {items.schema[item_id].dataType.simpleString()}, n_spans int, longest int, coverage double, spans array<struct<start:int,end:int>>"
    )
    arrow = to_arrow_schema(struct)
    source = spread(docs.select(F.col(doc_id), F.col(doc_text)))
    for auto, ids in _automata(items, item_id, item_text, min_words, max_words):
        shared = spark.sparkContext.broadcast((auto, ids, auto.hashes()))

        def run(batches, shared=shared):
            auto, ids, hashes = shared.value
            some = Present(hashes, auto.min_words)
            for whole in batches:
                batch, rows = whole.filter(pa.array(some(whole.column(1).to_pylist()), pa.bool_())), []
                for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    tokens = words(text)
                    found = auto.runs(tokens) if len(tokens) >= auto.min_words else {}
                    if found:
                        at = offsets(text, tokens)
                        for k, spans in found.items():
                            covered = sum(b - a for a, b in spans) / len(auto.sequences[k])
                            chars = [{"start": at[a][0], "end": at[b - 1][1]} for a, b in spans]
                            rows.append((key, ids[k], len(spans), max(b - a for a, b in spans), min(1.0, covered), chars))
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(arrow.names, r, strict=True)) for r in rows], schema=arrow)

        part = source.mapInArrow(run, struct)
        out = part if out is None else out.unionByName(part)
    return out


def offsets(text: str, tokens: list[str]) -> list[tuple[int, int]]:
    """Character places of the words in the original text (lower-casing may change lengths)."""
    low = text.lower()
    spans = [m.span() for m in WORD.finditer(low)]
    if len(low) == len(text):
        return spans
    place, at = [], 0
    for i, c in enumerate(text):
        place += [i] * len(c.lower())
    place.append(len(text))
    return [(place[a], place[b - 1] + 1) for a, b in spans]


def remove_leaks(docs: DataFrame, leaks: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", max_words: int = 13, max_coverage: float = 0.5) -> DataFrame:
    """``docs`` rows with leaks, their text without the spans of items that reach ``max_words`` words
    in one stretch or ``max_coverage`` of the item: (doc id, clean_text, n_removed)."""
    doomed = (
        leaks.where((F.col("longest") >= max_words) | (F.col("coverage") >= max_coverage))
        .select(F.col(doc_id).alias("__id"), F.explode("spans").alias("__s"))
        .groupBy("__id")
        .agg(F.array_sort(F.collect_set("__s")).alias("__spans"))
    )

    @F.pandas_udf("string")
    def cut(text, spans):
        out = []
        for t, ss in zip(text, spans, strict=True):
            keep, at = [], 0
            for s in ss:
                keep.append(t[at : max(at, s["start"])])
                at = max(at, s["end"])
            out.append("".join([*keep, t[at:]]))
        return pd.Series(out)

    return docs.select(F.col(doc_id), F.col(doc_text).alias("__text")).join(doomed, F.col(doc_id) == F.col("__id")).select(
        doc_id, cut("__text", "__spans").alias("clean_text"), F.size("__spans").alias("n_removed")
    )


def item_report(leaks: DataFrame, item_id: str = "item_id") -> DataFrame:
    """Per leaked item: documents, longest stretch, greatest coverage."""
    return leaks.groupBy(item_id).agg(
        F.count("*").alias("n_documents"), F.max("longest").cast("bigint").alias("longest"), F.round(F.max("coverage"), 6).alias("coverage")
    )
