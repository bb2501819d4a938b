"""Near-duplicate records by an LSH forest over word shingles.

Every class of records with the same words is in ``signatures.TREES`` trees, each an order of its own
of the labels of its min-hash signature.  Classes with a common first label form a region of a tree,
in which neighbours are candidates: all of them where the region is sparse; where it is crowded,
those with a longer common prefix in one of several further orders, the longer the more crowded it
is.  Candidates have fingerprints within the radius of the threshold; their texts are compared
exactly.  See ``signatures`` for the depths, and for the probability of a meeting, which doesn't
depend on how crowded a region is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import signatures
from tessera.llm.similarity import components, texts_of, verify_pairs
from tessera.session import materialize


def _text(cols: list[str]):
    return F.concat_ws(" ", *(F.coalesce(F.col(c), F.lit("")) for c in cols))


def near_duplicates(
    df: DataFrame,
    row_col: str = "row_index",
    text_cols: list[str] = ("prompt", "response"),
    size: int = 5,
    threshold: float = 0.8,
    limit: int = signatures.LIMIT,
    held: int = signatures.HELD,
    block: int = signatures.BLOCK,
) -> tuple[DataFrame, DataFrame]:
    """(members, links): members is (row, key), the class of every row; links is (a, b,
    similarity), all pairs of classes whose shingle sets reach the threshold, each once.

    The text of a row is its columns joined by a blank, null counting as empty; rows without any
    word form one class, rows of fewer words than a shingle are one shingle.  Repeated rows are
    members of one class; an empty table has no members.  Other columns are not looked at.
    """
    text = _text(list(text_cols))
    signed = materialize(signatures.sign(df, row_col, text, size), "forest-signed")
    members = signed.select("row", "key")
    pairs = materialize(signatures.candidates(signed, signatures.entries(signed), threshold, limit, held, block), "forest-candidates")
    keys = pairs.select(F.col("a").alias("key")).union(pairs.select(F.col("b").alias("key")))
    source = df.select(F.col(row_col).cast("bigint").alias("row"), text.alias("text"))
    return members, verify_pairs(pairs, texts_of(keys, members, source), size, threshold)


def row_pairs(members: DataFrame, links: DataFrame) -> DataFrame:
    """All pairs of rows (row_index_a, row_index_b), a < b, of one class or of linked classes."""
    copies = members.join(members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "key", "left_semi")
    x, y = copies.alias("x"), copies.alias("y")
    same = x.join(y, F.col("x.key") == F.col("y.key")).where("x.row < y.row").select(F.col("x.row").alias("p"), F.col("y.row").alias("q"))
    left = members.select(F.col("key").alias("a"), F.col("row").alias("p"))
    right = members.select(F.col("key").alias("b"), F.col("row").alias("q"))
    across = links.select("a", "b").join(left, "a").join(right, "b").select("p", "q").where("p <> q")
    return same.union(across).select(F.least("p", "q").alias("row_index_a"), F.greatest("p", "q").alias("row_index_b"))


def groups(members: DataFrame, links: DataFrame) -> DataFrame:
    """One row for each record: (row, class_id, group_id, n_links): the smallest row of its class,
    the smallest row of its group, and the number of other classes its class is linked with."""
    links = materialize(links, "forest-links")
    both = links.select(F.col("a").alias("key")).union(links.select(F.col("b").alias("key")))
    degree = both.groupBy("key").agg(F.count("*").alias("n_links"))
    comp = components(links).select(F.col("node").alias("key"), "component")
    first = members.groupBy("key").agg(F.min("row").alias("class_id"))
    info = first.join(degree, "key", "left").join(comp, "key", "left").withColumn("component", F.coalesce("component", "key"))
    least = info.groupBy("component").agg(F.min("class_id").alias("group_id"))
    info = info.join(least, "component").select("key", "class_id", "group_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return members.join(info, "key").select("row", "class_id", "group_id", "n_links")
