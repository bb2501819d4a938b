"""Records that differ only in layout: recursive radix partitioning on canonical bytes, then tries.

A record's canonical bytes are, for every field in the order of names, the letters and digits in
lower case.  Level 0 of the radix is the table and the first bytes; a bucket with more records than
fit is split by further bytes, level by level, until each fits or its records can't be told apart any
more (one group of copies).  Only such a bucket is salted by row: each salt makes its own
trie, and the salts' smallest rows are reduced once more.  Buckets are streamed through tries with
terminal counters, so memory follows the distinct records of one bucket, not its rows.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize, spread

#: Rows of a bucket that fit, bytes of level 0 (each further level takes twice as many more), the
#: deepest level, and the salts of a bucket that bytes can't split.
BUCKET_ROWS, STEP_BYTES, MAX_LEVEL, SALTS = 50_000, 8, 24, 64
#: Buckets split at one level, at most: they are broadcast.  Of more rows more fit into a bucket.
MAX_SPLIT = 500_000
DROP = re.compile(r"[\W_]+")
END = b"\x00"


def canonical(text: str | None) -> bytes:
    """Letters and digits only, in lower case; null counts as the empty text."""
    return DROP.sub("", text.lower()).encode("utf-8", "surrogatepass") if text else b""


def canonical_json(payload: str | None) -> list[bytes] | None:
    """Alternately names and canonical values of a JSON object's fields by name; None if unreadable.

    Of a repeated name the last value counts, as in a JSON parser; nested values count as their
    JSON text with sorted names."""
    try:
        obj = json.loads(payload) if payload is not None else None
    except (ValueError, RecursionError):
        return None
    if not isinstance(obj, dict):
        return None
    out = []
    for name in sorted(obj):
        v = obj[name]
        text = v if isinstance(v, str) else "" if v is None else json.dumps(v, sort_keys=True, ensure_ascii=False)
        out += [name.encode("utf-8", "surrogatepass"), canonical(text)]
    return out


def _head(parts: list[bytes]) -> bytes:
    return ",".join(str(len(x)) for x in parts).encode()


def canonical_rows(df: DataFrame, row_col: str, fields: list[str], as_json: bool = False, table: str = "") -> DataFrame:
    """(tab, row, head, body): body has the canonical bytes of the fields, head their lengths.
    Unreadable JSON is left out."""
    source = df.select(F.col(row_col).cast("bigint").alias("row"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(fields)))
    if not as_json:
        plain = [F.regexp_replace(F.lower(F.coalesce(f"c{i}", F.lit(""))), r"[^\p{L}\p{N}]+", "") for i in range(len(fields))]
        source = source.select(F.lit(table).alias("tab"), "row", *(c.alias(f"c{i}") for i, c in enumerate(plain)))
        cols = [F.col(f"c{i}") for i in range(len(fields))]
        head = F.concat_ws(",", *(F.octet_length(c).cast("string") for c in cols))
        return source.select("tab", "row", F.encode(head, "UTF-8").alias("head"), F.encode(F.concat_ws("\0", *cols), "UTF-8").alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [canonical_json(x) for x in batch.column(1).to_pylist()]
            keep = [i for i, m in enumerate(made) if m is not None]
            head, body = [_head(made[i]) for i in keep], [END.join(made[i]) for i in keep]
            rows = batch.column(0).take(pa.array(keep, pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array([table] * len(keep), pa.string()), rows, pa.array(head, pa.binary()), pa.array(body, pa.binary())], ["tab", "row", "head", "body"])

    return spread(source).mapInArrow(run, "tab string, row bigint, head binary, body binary")


def _bytes(level: int, step: int) -> int:
    """Canonical bytes that count at a level: doubling steps, so a text of any length takes few."""
    return min(step * (2 ** (level + 1) - 1), 2**31 - 1)


def _prefix(level: int, step: int):
    """The radix key of a level: table and the level's canonical bytes."""
    return F.xxhash64("tab", F.substring("body", 1, _bytes(level, step)))


def radix_plan(rows: DataFrame, bucket_rows: int, step: int, max_level: int) -> tuple[list[DataFrame], DataFrame]:
    """Splits oversized buckets by further bytes.  Returns, of each level, the buckets split there
    (key), and those that can't be split (key).

    Every level counts only rows inside buckets that were too large a level before, so of any level
    there are at most rows / bucket_rows.  A bucket can't be split if its records are all the same, or
    its bytes or levels are used up."""
    split, stuck, level, open_rows = [], None, 0, rows
    whole = F.xxhash64("tab", "head", "body")
    while True:
        same = F.min(whole) == F.max(whole)
        counts = open_rows.groupBy(_prefix(level, step).alias("key")).agg(F.count("*").alias("n"), (F.max(F.length("body") > _bytes(level, step)) & ~same & F.lit(level < max_level)).alias("more"))
        large = materialize(counts.where(F.col("n") > bucket_rows).select("key", "more"), "layout-large")
        ended, more = large.where("NOT more").select("key"), large.where("more").select("key")
        stuck = ended if stuck is None else stuck.unionByName(ended)
        if more.isEmpty():
            return split, stuck
        split.append(more)
        open_rows = open_rows.withColumn("__k", _prefix(level, step)).join(F.broadcast(more.withColumnRenamed("key", "__k")), "__k", "left_semi").drop("__k")
        level += 1


class Trie:
    """Path-compressed byte trie; a terminal has its counter and its smallest row."""

    __slots__ = ("root",)

    def __init__(self):
        self.root = [{}, None]  # edges by first byte: [label, node]; terminal

    def add(self, key: bytes) -> list:
        """The terminal [count, smallest row] of ``key``, made where absent."""
        node, at, n = self.root, 0, len(key)
        while True:
            if at == n:
                if node[1] is None:
                    node[1] = [0, None]
                return node[1]
            edge = node[0].get(key[at])
            if edge is None:
                leaf = [{}, [0, None]]
                node[0][key[at]] = [key[at:], leaf]
                return leaf[1]
            label, child = edge
            if key.startswith(label, at):
                node, at = child, at + len(label)
                continue
            k, most = 1, min(len(label), n - at)
            while k < most and label[k] == key[at + k]:
                k += 1
            middle = [{label[k]: [label[k:], child]}, None]
            node[0][key[at]] = [label[:k], middle]
            node, at = middle, at + k


def _by_bucket(rows: DataFrame, bucket_rows: int, step: int, max_level: int, salts: int) -> tuple[DataFrame, bool]:
    """Rows in the order of their buckets (and salts), then of their numbers; and whether any bucket
    had to be salted."""
    rows = materialize(rows, "layout-canonical")
    bucket_rows = max(bucket_rows, rows.count() // MAX_SPLIT)
    split, stuck = radix_plan(rows, bucket_rows, step, max_level)
    # The bucket of a row: its key at the first level at which it isn't split.
    tagged = rows.withColumn("bucket", _prefix(0, step))
    for level, keys in enumerate(split):
        tagged = tagged.join(F.broadcast(keys.select(F.col("key").alias("bucket"), F.lit(True).alias("__s"))), "bucket", "left")
        tagged = tagged.withColumn("bucket", F.when(F.col("__s"), _prefix(level + 1, step)).otherwise(F.col("bucket"))).drop("__s")
    hot = not stuck.isEmpty()
    salt = F.lit(0)
    if hot:
        tagged = tagged.join(F.broadcast(stuck.select(F.col("key").alias("bucket"), F.lit(True).alias("__s"))), "bucket", "left")
        salt = F.when(F.col("__s"), F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    tagged = tagged.select("tab", "row", "head", "body", "bucket", salt.alias("salt"))
    return tagged.repartition("bucket", "salt").sortWithinPartitions("bucket", "salt", "row"), hot


def _through_tries(ordered: DataFrame, hot: bool, counts: bool) -> DataFrame:
    """Streams the buckets through one trie each.  Every row with the first row of its record in the
    bucket, or with ``counts`` every terminal once, with its counter.  The digest tells records of
    different salts apart; it is empty where nothing was salted."""

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) if rows else [(), (), (), ()]
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["tab", "rep", "row", "digest"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come by bucket and in row order, so the first row of a record is its smallest.
        now, trie, terminals = None, Trie(), []
        for batch in batches:
            out = []
            for t, r, h, b, k, s in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if (k, s) != now:
                    out += [(e[1][0], e[1][1], e[0], e[1][2]) for e in terminals]
                    now, trie, terminals = (k, s), Trie(), []
                key = t.encode() + END + b + END + h
                end = trie.add(key)
                if not end[0]:
                    end[1] = (t, r, blake2b(key, digest_size=16).digest() if hot else b"")
                    if counts:
                        terminals.append(end)
                end[0] += 1
                if not counts:
                    out.append((t, end[1][1], r, end[1][2]))
            yield batch_of(out)
        if terminals:
            yield batch_of([(e[1][0], e[1][1], e[0], e[1][2]) for e in terminals])

    return ordered.mapInArrow(run, "tab string, rep bigint, row bigint, digest binary")


def group_layout_copies(rows: DataFrame, bucket_rows: int = BUCKET_ROWS, step: int = STEP_BYTES, max_level: int = MAX_LEVEL, salts: int = SALTS) -> DataFrame:
    """(tab, rep, row) for every row of ``canonical_rows``: rep is the smallest row of its record.

    Rows with equal numbers count as they stand; ties have no influence, as the smallest row is
    unique up to equality.
    """
    ordered, hot = _by_bucket(rows, bucket_rows, step, max_level, salts)
    local = _through_tries(ordered, hot, counts=False)
    if not hot:
        return local.select("tab", "rep", "row")
    # Salted buckets: the smallest of the salts' smallest rows (one row for each record and salt).
    local = materialize(local, "layout-local")
    heads = local.groupBy("tab", "digest", "rep").agg(F.lit(1).alias("one"))
    best = heads.groupBy("tab", "digest").agg(F.min("rep").alias("best"), F.collect_set("rep").alias("reps"))  # at most one a salt
    moved = best.where(F.size("reps") > 1).select("tab", "digest", F.explode("reps").alias("rep"), "best").where("rep <> best")
    return local.join(moved, ["tab", "digest", "rep"], "left").select("tab", F.coalesce("best", "rep").alias("rep"), "row")


def copy_counts(rows: DataFrame, bucket_rows: int = BUCKET_ROWS, step: int = STEP_BYTES, max_level: int = MAX_LEVEL, salts: int = SALTS) -> DataFrame:
    """One row per record of ``canonical_rows``: (tab, rep, n_copies), from the terminal counters of
    the tries; those of salts are summed."""
    ordered, hot = _by_bucket(rows, bucket_rows, step, max_level, salts)
    ends = _through_tries(ordered, hot, counts=True).withColumnRenamed("row", "n_copies")
    if not hot:
        return ends.select("tab", "rep", "n_copies")
    return ends.groupBy("tab", "digest").agg(F.min("rep").alias("rep"), F.sum("n_copies").alias("n_copies")).drop("digest")
