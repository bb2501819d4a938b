"""Shared parts of the similarity joins: keys of shingle sets, exact verification, expansion.

Rows with the same words in the same order have the same class key (64 bits of a hash).  The joins
work on classes, so groups of exact copies, however large, are one record to them; rows come
back in only at the end.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.text import flat_shingles, flat_words, jaccard
from tessera.session import materialize


def presence(codes: DataFrame, bits: int) -> np.ndarray:
    """Bitmap of the values of column ``code`` (0 to 2**bits - 1).  Its words are or-ed on the
    executors, so at most ``2**bits / 64`` rows reach the driver, whatever the data."""
    one = F.expr("shiftleft(1L, cast(code & 63 AS int))")
    rows = codes.groupBy(F.shiftright("code", 6).alias("at")).agg(F.bit_or(one).alias("bits")).toArrow()
    full = np.zeros(1 << (bits - 6), np.int64)
    full[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return full.view(np.uint8)


FILTER_BITS = 24


def likely_rows(df: DataFrame, wanted: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """Rows of ``df`` whose ``row`` may be in ``wanted`` (row): a bitmap of 2**bits hashed rows (2 MB)
    is broadcast, so most rows that a later join drops are never shuffled.  It has no false negatives."""
    code = F.pmod(F.xxhash64("row"), F.lit(1 << bits))
    bitmap = df.sparkSession.sparkContext.broadcast(presence(wanted.select(code.alias("code")), bits))

    @F.pandas_udf("boolean")
    def there(codes: pd.Series) -> pd.Series:
        c = codes.to_numpy()
        return pd.Series((bitmap.value[c >> 3] >> (c & 7).astype(np.uint8)) & 1 == 1)

    return df.where(there(code))


def texts_of(keys: DataFrame, members: DataFrame, source: DataFrame) -> DataFrame:
    """(key, text) of the wanted classes: the text of the smallest row of each.

    ``keys`` (key), ``members`` (row, key), ``source`` (row, text)."""
    reps = members.join(keys.distinct(), "key", "left_semi").groupBy("key").agg(F.min("row").alias("row"))
    reps = materialize(reps, "representatives")
    found = likely_rows(source, reps.select("row")).join(reps, "row")
    return found.dropDuplicates(["key"]).select("key", "text")


def verify_pairs(pairs: DataFrame, texts: DataFrame, size: int, threshold: float) -> DataFrame:
    """(a, b, similarity) of the pairs of ``pairs`` (a, b) that reach the threshold exactly.

    ``texts`` is (key, text) with one row for each key that occurs in ``pairs``."""
    left = texts.select(F.col("key").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("key").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ka, kb = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            # Every text of the batch is cut once, however many pairs it is in.
            keys, first, of = np.unique(np.concatenate([ka, kb]), return_index=True, return_inverse=True)
            sides = [first[first < len(ka)], first[first >= len(ka)] - len(ka)]
            texts = pa.chunked_array([batch.column(2).take(pa.array(sides[0])), batch.column(3).take(pa.array(sides[1]))])
            place = np.empty(len(keys), np.int64)
            place[np.concatenate([np.flatnonzero(first < len(ka)), np.flatnonzero(first >= len(ka))])] = np.arange(len(keys))
            flat, at = flat_shingles(*flat_words(texts.to_pylist()), size)
            sets = [np.unique(flat[at[i] : at[i + 1]]) for i in range(len(at) - 1)]
            i, j = place[of[: len(ka)]], place[of[len(ka) :]]
            sim = np.array([jaccard(sets[x], sets[y]) for x, y in zip(i.tolist(), j.tolist(), strict=True)])
            ok = sim >= threshold
            yield pa.RecordBatch.from_arrays([pa.array(ka[ok]), pa.array(kb[ok]), pa.array(sim[ok], pa.float64())], ["a", "b", "similarity"])

    return both.mapInArrow(run, "a bigint, b bigint, similarity double")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of the graph of ``links`` (a, b): alternating large-star and small-star.

    Each step joins edges with the least neighbour of their node: a map-side minimum, no neighbour
    list is ever gathered.  A written table cuts the lineage of every round."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = materialize(edges, "components")
    while True:
        # Large star: neighbours greater than the node go to its least neighbour.
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Small star: neighbours not greater than the node go to the least of them.
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(least.select("u", F.col("m").alias("v"))).distinct()
        new = materialize(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "components")
        n_new = new.count()
        same = new.join(edges, ["u", "v"], "left_semi").count()
        n_old = edges.count()
        edges = new
        if same == n_new == n_old:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
