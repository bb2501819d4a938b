"""Records shared by splits: fingerprints of bits, joined across splits by code blocks.

Every class of prompts with the same words has a similarity hash, the labels of its min-hash
signature: fingerprints of 1,920 bits in which the bits of a label agree with the similarity of the
shingle sets.  (Signs of random projections are the other such hash.  At a similarity of 0.5 their
bits agree too often by chance: with 80 blocks of 20 bits, of pairs that share one passage and differ
in another 39 % were found.)  ``signatures.TREES`` blocks of 40 bits are joined across splits; those
of the training side that no held-out prompt has are dropped by a bitmap before the shuffle.  Pairs
that share a block stay candidates if their fingerprints lie within the radius of the threshold, in
four bits of each label; crowded blocks are joined with further bits in several orders, see
``signatures``.  The texts of the candidates are then compared exactly.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import signatures
from tessera.llm.similarity import presence, texts_of, verify_pairs
from tessera.session import materialize

#: The bitmap has 16 bits for each block of the held-out side, within these powers of 2.
BITMAP_BITS = (16, 28)


def split_overlaps(
    df: DataFrame,
    held_out,
    row_col: str = "row_index",
    text_col: str = "prompt",
    size: int = 5,
    threshold: float = 0.8,
    limit: int = signatures.LIMIT,
    held: int = signatures.HELD,
    block: int = signatures.BLOCK,
) -> tuple[DataFrame, DataFrame]:
    """(members, links): members is (row, held, key) of every row with words in its text; links is
    (a, b, similarity) with a a class of the training side and b one of the held-out side, a <> b
    or equal (copies across splits, similarity 1).

    ``held_out`` is a boolean column: true for held-out rows, false for training rows, null for
    others, which are left out.  Null texts and texts without words don't count.  Repeated rows are
    members each; an empty table or side gives no links.  Other columns are not looked at.
    """
    spark = df.sparkSession
    side = F.when(held_out, 1).when(~held_out, 2)
    signed = materialize(signatures.sign(df, row_col, F.col(text_col), size, side), "overlap-signed")
    members = signed.select("row", (F.col("side") == 1).alias("held"), "key")
    one, two = signed.where("side = 1"), signed.where("side = 2")
    n = one.where("codes IS NOT NULL").count()
    bits = min(max(BITMAP_BITS[0], ceil(log2(16 * signatures.TREES * n + 1))), BITMAP_BITS[1])
    bitmap = spark.sparkContext.broadcast(presence(signatures.places(one, bits), bits))
    level = signatures.entries(one).unionByName(signatures.entries(two, bitmap, bits))
    pairs = materialize(signatures.candidates(signed, level, threshold, limit, held, block), "overlap-candidates")
    keys = pairs.select(F.col("a").alias("key")).union(pairs.select(F.col("b").alias("key")))
    source = df.select(F.col(row_col).cast("bigint").alias("row"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    texts = texts_of(keys, members, source)
    both = members.groupBy("key").agg(F.bool_or("held").alias("x"), F.bool_and("held").alias("y")).where("x AND NOT y")
    same = both.select(F.col("key").alias("a"), F.col("key").alias("b"), F.lit(1.0).alias("similarity"))
    return members, verify_pairs(pairs, texts, size, threshold).unionByName(same)


def row_pairs(members: DataFrame, links: DataFrame) -> DataFrame:
    """All pairs of a training and a held-out row of linked classes: (train_row, held_row, similarity)."""
    left = members.where("NOT held").select(F.col("key").alias("a"), F.col("row").alias("train_row"))
    right = members.where("held").select(F.col("key").alias("b"), F.col("row").alias("held_row"))
    return links.join(left, "a").join(right, "b").select("train_row", "held_row", "similarity")


def overlap_report(members: DataFrame, links: DataFrame, df: DataFrame, row_col: str, split, source) -> DataFrame:
    """Per held-out split and source: its rows, those the training split has exactly, and almost."""
    best = links.groupBy("b").agg(F.max("similarity").alias("similarity")).withColumnRenamed("b", "key")
    rows = members.where("held").join(best, "key", "left").select("row", "similarity")
    of = df.select(F.col(row_col).cast("bigint").alias("row"), split.alias("split"), source.alias("source"))
    return (
        of.join(rows, "row")
        .groupBy("split", "source")
        .agg(
            F.count("*").alias("n_rows"),
            F.count_if(F.coalesce(F.col("similarity"), F.lit(0.0)) == 1.0).alias("n_exact"),
            F.count_if(F.coalesce(F.col("similarity"), F.lit(0.0)).between(1e-9, 1.0 - 1e-9)).alias("n_near"),
        )
    )
