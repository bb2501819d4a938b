"""Filling sequences of fixed capacity with whole records, planned on the histogram of lengths.

Only counts of lengths are planned, never records: best-fit decreasing over (length, count) takes
whole ranges of equal sequences at a time, so its cost depends on the capacity, not on the number
of records.  The plan is a list of slots, each a range of ranks within a length; records find their
slots by their rank within their length, with a binary search in the plan's arrays.

Records longer than the capacity are cut anyway: into full sequences and a rest.  Rests come last
and fill the room that whole records left; one that fits nowhere as a whole is cut at the largest room,
as often as that is possible, rather than open another sequence.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import materialize, spread

#: White space as Python's split sees it.
WORD_RUN = r"[^\s\x1c-\x1f\x85\p{Z}]+"
#: Rows of one length that one task ranks; longer groups are cut into blocks.
BLOCK_ROWS = 500_000
#: Capacities of the runs that are planned at once, together: bounds the histogram on the driver.
PLAN_ROWS = 2_000_000
#: Ranks within a length have fewer bits.
RANK_BITS = 43
#: Words of the shortest piece that a rest is cut into.
MIN_PIECE = 8


def record_length(*cols: str):
    """White-space-separated words of all columns plus 1; null counts as no words."""
    return sum((F.coalesce(F.regexp_count(F.col(c), F.lit(WORD_RUN)), F.lit(0)) for c in cols), F.lit(1)).cast("bigint")


#: cut, length, first rank, last rank + 1, first sequence, place in it, part of the rest, words
Slot = tuple[bool, int, int, int, int, int, int, int]


def plan_slots(whole: dict[int, int], rests: dict[int, int], capacity: int, min_piece: int = MIN_PIECE) -> tuple[list[Slot], int]:
    """Best-fit decreasing over counts by length.  Returns slots and the number of sequences.

    Rank r of the slot's length goes to sequence ``first sequence + r - first rank``.  Equal sequences
    are kept as ranges by room left, and a length takes the ranges with the least sufficient room first.
    """
    slots: list[Slot] = []
    by_room: dict[int, list[tuple[int, int]]] = {}  # room left: ranges (first sequence, count)
    rooms: list[int] = []  # sorted
    n_seq = 0

    def give(room: int, first: int, count: int) -> None:
        if room <= 0 or count <= 0:
            return
        if room not in by_room:
            by_room[room] = []
            insort(rooms, room)
        by_room[room].append((first, count))

    def take(i: int, most: int) -> tuple[int, int, int]:
        """(room, first, count) of at most ``most`` sequences with the i-th room."""
        room = rooms[i]
        first, count = by_room[room].pop()
        if not by_room[room]:
            del by_room[room]
            rooms.pop(i)
        m = min(most, count)
        give(room, first + m, count - m)
        return room, first, m

    def open_for(cut: bool, length: int, rank: int, left: int, part: int, words: int) -> None:
        """New sequences: as many as are needed if each takes as many of these as fit."""
        nonlocal n_seq
        per, first = capacity // words, n_seq
        m = -(-left // per)
        n_seq += m
        for k in range(per):
            at = k * m
            if at >= left:
                break
            slots.append((cut, length, rank + at, rank + min(at + m, left), first, k * words, part, words))
        full, more = divmod(left, m)
        give(capacity - (full + 1) * words, first, more)
        give(capacity - full * words, first + more, m - more)

    for length in sorted(whole, reverse=True):
        left, rank = whole[length], 0
        while left:
            i = bisect_left(rooms, length)
            if i == len(rooms):
                open_for(False, length, rank, left, 0, length)
                break
            room, first, m = take(i, left)
            slots.append((False, length, rank, rank + m, first, capacity - room, 0, length))
            give(room - length, first, m)
            rank, left = rank + m, left - m

    # Words still to place, the longest first: their rest's length, ranks, and parts placed so far.
    todo = [(-length, length, 0, count, 0) for length, count in rests.items() if count]
    heapify(todo)
    while todo:
        words, length, lo, hi, part = heappop(todo)
        words = -words
        i = bisect_left(rooms, words)
        if i < len(rooms):
            room, first, m = take(i, hi - lo)
            piece = words
        elif rooms and min(rooms[-1], words - min_piece) >= min_piece:
            room, first, m = take(len(rooms) - 1, hi - lo)
            piece = min(room, words - min_piece)
            heappush(todo, (piece - words, length, lo, lo + m, part + 1))
        else:
            open_for(True, length, lo, hi - lo, part, words)
            continue
        slots.append((True, length, lo, lo + m, first, capacity - room, part, piece))
        give(room - piece, first, m)
        if lo + m < hi:
            heappush(todo, (-words, length, lo + m, hi, part))
    return slots, n_seq


class Plan:
    """The slots of several runs, found by the run, the length and a rank: arrays in the order of
    (run, cut, length, part, first rank), looked up by binary search."""

    def __init__(self, slots: list[tuple[int, ...]]):
        cols = np.array(slots, np.int64).reshape(len(slots), 9)
        run, cut, rest, lo, hi, seq, place, part, words = cols.T
        self.rest, self.parts = int(rest.max(initial=0)) + 1, int(part.max(initial=0)) + 1
        code = self.code(run, cut, rest, part)
        order = np.lexsort((lo, code))
        self.codes, group = np.unique(code[order], return_inverse=True)
        self.at = (group << RANK_BITS) + lo[order]
        self.hi, self.seq, self.place, self.words = ((group << RANK_BITS) + hi[order], (seq - lo)[order], place[order], words[order])

    def code(self, run, cut, rest, part):
        return ((run * 2 + cut) * self.rest + rest) * self.parts + part

    def find(self, run: np.ndarray, cut: np.ndarray, rest: np.ndarray, rank: np.ndarray):
        """For every part: (places in the input, part, sequence, place in it, words)."""
        for part in range(self.parts if len(self.codes) else 0):
            code = self.code(run, cut, rest, part)
            group = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            key = (group << RANK_BITS) + rank
            slot = np.maximum(np.searchsorted(self.at, key, "right") - 1, 0)
            on = np.flatnonzero((self.codes[group] == code) & (self.at[slot] <= key) & (key < self.hi[slot]))
            slot = slot[on]
            yield on, part, self.seq[slot] + rank[on], self.place[slot], self.words[slot]


def place_records(ranked: DataFrame, plan) -> DataFrame:
    """(rid, sequence, row, piece, place, length) of ranked records: one row for each of their slots."""
    names = ["rid", "sequence", "row", "piece", "place", "length"]

    def run(batches):
        for batch in batches:
            rid, cut, rest, rank, full = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1, 2, 3, 5))
            for on, part, seq, place, words in plan.value.find(rid, cut, rest, rank):
                yield pa.RecordBatch.from_arrays([pa.array(rid[on].astype(np.int32)), pa.array(seq), batch.column(4).take(pa.array(on)), pa.array(full[on] + part), pa.array(place), pa.array(words)], names)

    source = ranked.select("rid", F.col("cut").cast("int"), "rest", "rank", F.col("row"), "full")
    return source.mapInArrow(run, "rid int, sequence bigint, row bigint, piece bigint, place bigint, length bigint")


def pack_records(records: DataFrame, runs: DataFrame, row_col: str = "row_index", run_col: str = "config_name", capacity_col: str = "max_length", block_rows: int = BLOCK_ROWS, plan_rows: int = PLAN_ROWS) -> DataFrame:
    """One row for each run and piece of a record: (run, capacity, sequence, row, piece, place, length).

    ``records`` has (row, split, length), ``runs`` (run, split, capacity); a run takes the records
    whose ``split`` equals its own.  A record of at most the capacity is one piece (0); a longer one is
    cut into full sequences and the parts of its rest, numbered in that order.  ``place`` is the number
    of words before the piece in its sequence.  Runs without capacity or split get nothing, equal runs
    count once, and runs that differ only in split or capacity are packed each, their sequences numbered
    one after another.  Records without a split belong to none, repeated rows are packed each, an empty
    table gives no rows.

    Runs are planned in groups whose capacities sum up to ``plan_rows``, which bounds the histogram
    that reaches the driver and the plan that is broadcast, whatever the number of runs and records.
    """
    spark = records.sparkSession
    runs = runs.select(F.col(run_col).alias("run"), F.col("split"), F.col(capacity_col).cast("bigint").alias("cap")).where("cap > 0 AND split IS NOT NULL").distinct()
    known = sorted(runs.toLocalIterator(), key=lambda r: (r.run is None, r.run or "", r.split, r.cap))
    n_records = materialize(spread(records.select(F.col(row_col).cast("bigint").alias("row"), "split", "length")), "pack-lengths")
    blocks = max(1, -(-n_records.count() // block_rows))
    out, used, at = None, {}, 0
    while at < len(known) or out is None:
        to, room = at, 0
        while to < len(known) and (to == at or room + known[to].cap <= plan_rows):
            room += known[to].cap
            to += 1
        group = known[at:to]
        rows = [(i, r.run, r.split, r.cap) for i, r in enumerate(group)]
        at = to
        numbered = F.broadcast(spark.createDataFrame(rows, "rid int, run string, split string, cap bigint"))
        pieces = (
            n_records.join(numbered.drop("run"), "split")
            .withColumn("full", F.when(F.col("length") > F.col("cap"), F.floor(F.col("length") / F.col("cap"))).otherwise(F.lit(0)).cast("bigint"))
            .withColumn("rest", F.col("length") - F.col("full") * F.col("cap"))
            .withColumn("cut", F.col("full") > 0)
            .withColumn("block", F.pmod(F.xxhash64("row", "length"), F.lit(blocks)).cast("int"))
        )
        # Counts by run, rest length and block: at most capacities * blocks rows, before blocks are summed.
        sizes = materialize(pieces.groupBy("rid", "cut", "rest", "block").agg(F.count("*").alias("n"), F.sum("full").alias("fulls")), "pack-histogram")
        by_length = sizes.groupBy("rid", "cut", "rest").agg(F.sum("n").alias("n"), F.sum("fulls").alias("fulls")).toLocalIterator()  # at most 2 * plan_rows
        hist, fulls = [({}, {}) for _ in group], [0] * len(group)
        for r in by_length:
            fulls[r.rid] += r.fulls
            if r.rest:
                hist[r.rid][r.cut][r.rest] = r.n
        slots, bases = [], []
        for i, r in enumerate(group):
            made, n_seq = plan_slots(*hist[i], r.cap)
            slots += [(i, *s) for s in made]
            first = used.get(r.run, 0)
            used[r.run] = first + n_seq + fulls[i]
            bases.append((i, r.run, r.cap, first, first + n_seq))
        base = F.broadcast(spark.createDataFrame(bases, f"rid int, {run_col} string, {capacity_col} bigint, start bigint, base bigint"))

        # Rank within the length: rows before in earlier blocks plus rank in the own block.
        before = Window.partitionBy("rid", "cut", "rest").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        offsets = sizes.select("rid", "cut", "rest", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
        own = Window.partitionBy("rid", "cut", "rest", "block").orderBy("row", "length")
        ranked = pieces.where("rest > 0").withColumn("rank", F.row_number().over(own) - 1)
        ranked = ranked.join(offsets, ["rid", "cut", "rest", "block"]).withColumn("rank", F.col("rank") + F.col("ahead"))
        whole = place_records(ranked, spark.sparkContext.broadcast(Plan(slots))).join(base, "rid").withColumn("sequence", F.col("sequence") + F.col("start"))

        # Full sequences of longer records, numbered after the planned ones.
        long = pieces.where("full > 0")
        cuts = long.groupBy("rid", "block").agg(F.sum("full").alias("n"))
        before = Window.partitionBy("rid").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        cuts = cuts.select("rid", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
        own = Window.partitionBy("rid", "block").orderBy("row", "length").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        long = long.withColumn("upto", F.sum("full").over(own)).join(cuts, ["rid", "block"]).join(base, "rid")
        first = F.col("base") + F.col("ahead") + F.col("upto") - F.col("full")
        long = long.withColumn("first", first).withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("full") - 1)))
        long = long.select(run_col, capacity_col, (F.col("first") + F.col("piece")).alias("sequence"), "row", "piece", F.lit(0).cast("bigint").alias("place"), F.col("cap").alias("length"))
        both = whole.select(long.columns).unionByName(long)
        out = both if out is None else out.unionByName(both)
    return out.withColumnRenamed("row", row_col)


def fill_report(packed: DataFrame, run_col: str = "config_name", capacity_col: str = "max_length") -> DataFrame:
    """Per run and capacity: pieces, sequences, words, and the share of the room that is used."""
    per = packed.groupBy(run_col, capacity_col, "sequence").agg(F.sum("length").alias("used"), F.count("*").alias("n"))
    per = per.groupBy(run_col, capacity_col).agg(F.sum("n").alias("n_pieces"), F.sum("used").alias("n_words"), F.count("*").alias("n_sequences"))
    return per.withColumn("fill", F.round(F.col("n_words") / (F.col("n_sequences") * F.col(capacity_col)), 6))
