"""Min-hash signatures of shingle sets, and the meetings of signatures that share a code.

A class of texts with the same words has ``MARKS`` min-hash labels.  ``TREES`` of them are kept as
codes of 40 bits; four bits of each make a fingerprint of 192 bits.  Two sets of similarity J agree
in a label with probability J, so the number of four-bit places in which two fingerprints differ,
their distance, has the mean ``MARKS * (1 - J) * 15 / 16``.  The radius of a threshold leaves out at
most ``LOSS`` of the pairs that just reach it, whatever the number of texts.

Classes with a code in common form a region, which one task sees in the order of the codes:

* a region of at most ``LIMIT`` members is compared as it is;
* a larger one is seen again in several orders of the fingerprints' places: those that share the
  first of them, the more the larger the region is, are compared; the number of orders is such that
  a pair at the threshold meets in one of them with a probability of ``KEPT``;
* one of more than ``HELD`` members leaves the task and is split by further codes, in ``CHILDREN``
  orders, as often as it takes;
* a dense family, of which a further code holds ``DENSE_SHARE``, is compared whole, in blocks that
  spread over tasks.

So crowded regions are seen more often as they are split, and a pair loses little where its regions
are large.  A pair of similarity 0.5 meets in a given tree with a probability of 0.5 in a
sparse region, 0.46 in a crowded one, and 0.44 to 0.3 after one to three splits: in one of the trees
at least with 0.9997, 0.9994, 0.999 and 0.986.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.text import flat_shingles, flat_words, mix, sequence_keys
from tessera.session import materialize, spread

MARKS, TREES, CODE_BYTES = 48, 12, 5
#: Words of a fingerprint: 16 places of four bits each.
FACES = [f"f{i}" for i in range(MARKS // 16)]
LOSS, KEPT = 0.001, 0.93
LIMIT, HELD, BLOCK = 256, 32_000, 2_000
CHILDREN, DENSE_SHARE, MAX_SPLITS = 3, 0.5, 4
#: Keys a task remembers so as not to sign copies again, rows of a task's step, pairs compared at once.
SEEN, STEP_ROWS, CHUNK = 500_000, 50_000, 1 << 19
EPS = 1e-9
_LOW = np.uint64(0x1111111111111111)


def radius(threshold: float, loss: float = LOSS) -> int:
    """Most places in which fingerprints may differ: pairs at the threshold exceed it with ``loss``."""
    p = (1 - threshold) * 15 / 16
    tail, r = 0.0, MARKS
    while r > 0 and tail + comb(MARKS, r) * p**r * (1 - p) ** (MARKS - r) <= loss:
        tail += comb(MARKS, r) * p**r * (1 - p) ** (MARKS - r)
        r -= 1
    return r


class Signer:
    """Labels of texts: [text, mark], and the number of distinct shingles."""

    def __init__(self, size: int):
        self.size = size
        self.seeds = np.random.default_rng(20_240_229).integers(1, 2**63, (2, MARKS), dtype=np.uint64) | np.uint64(1)

    def keys(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        flat, ends = flat_words(texts)
        return flat, ends, sequence_keys(flat, ends)

    def labels(self, flat: np.ndarray, ends: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low, n = np.empty((len(wanted), MARKS), np.uint64), np.empty(len(wanted), np.int32)
        sizes = np.diff(ends)
        at = 0
        while at < len(wanted):  # pieces of about 32,000 shingles stay in the cache
            to = at + max(1, int(np.searchsorted(np.cumsum(sizes[wanted[at : at + 4096]]), 32_000)))
            part = wanted[at:to]
            m = sizes[part]
            edges = np.concatenate([[0], np.cumsum(m)])
            place = np.repeat(ends[part] - edges[:-1], m) + np.arange(edges[-1])
            sh, starts = flat_shingles(flat[place], edges, self.size)
            with np.errstate(over="ignore"):
                for i in range(MARKS):
                    h = sh ^ self.seeds[0, i]
                    h *= self.seeds[1, i]
                    low[at:to, i] = np.minimum.reduceat(h, starts[:-1])
            owner = np.repeat(np.arange(len(part)), np.diff(starts))
            order = np.lexsort((sh, owner))
            new = np.ones(len(sh), bool)
            new[1:] = (sh[order][1:] != sh[order][:-1]) | (owner[order][1:] != owner[order][:-1])
            n[at:to] = np.bincount(owner[order][new], minlength=len(part))
            at = to
        return mix(low), n


def faces_of(low: np.ndarray) -> np.ndarray:
    """Fingerprints [text, word] of labels: four bits of each."""
    out = np.zeros((len(low), len(FACES)), np.uint64)
    for i in range(MARKS):
        out[:, i // 16] |= ((low[:, i] >> np.uint64(60)) & np.uint64(15)) << np.uint64(4 * (i % 16))
    return out


def sign(df: DataFrame, row_col: str, text, size: int, side=None) -> DataFrame:
    """(row, side, key, codes, n, f0..): the class of every row, and for the first row of a class (and
    side) within its task its codes, number of shingles and fingerprint; null for the rest.

    ``side`` is 1 or 2, null for rows to leave out; rows without words are left out where there are
    sides, and one class where there are none (side 0)."""
    source = df.select(F.col(row_col).cast("bigint").alias("row"), (F.lit(0) if side is None else side).cast("int").alias("side"), text.alias("text"))
    sided = side is not None
    if sided:
        source = source.where("side IS NOT NULL AND text IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer, seen = Signer(size), set()
        for whole in batches:
            for batch in (whole.slice(i, 2_000) for i in range(0, whole.num_rows, 2_000)):
                flat, ends, keys = signer.keys(batch.column(2).to_pylist())
                some = np.diff(ends) > 0 if sided else np.ones(len(keys), bool)
                new = np.zeros(len(keys), bool)
                for i, x in enumerate(zip(keys.tolist(), batch.column(1).to_pylist(), strict=True)):
                    if some[i] and x not in seen:
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add(x)
                        new[i] = True
                low, n = signer.labels(flat, ends, np.flatnonzero(new))
                codes = (low[:, :TREES] >> np.uint64(24)).astype("<u8").view(np.uint8).reshape(len(low), TREES, 8)[:, :, :CODE_BYTES].reshape(len(low), -1)
                to = pa.array(np.maximum(np.cumsum(new) - 1, 0), mask=~new)
                made = [pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(n), *(pa.array(x.view(np.int64)) for x in np.ascontiguousarray(faces_of(low).T))]
                cols = [batch.column(0), batch.column(1), pa.array(keys), *(x.take(to) for x in made)]
                yield pa.RecordBatch.from_arrays(cols, ["row", "side", "key", "codes", "n", *FACES]).filter(pa.array(some))

    return spread(source).mapInArrow(run, "row bigint, side int, key bigint, codes binary, n int, " + ", ".join(f"{c} bigint" for c in FACES))


ENTRY = ["region", "key", "side", "n", *FACES]
_ENTRY_TYPES = "region bigint, key bigint, side int, n int, " + ", ".join(f"{c} bigint" for c in FACES)


def _codes(raw: pa.Array) -> np.ndarray:
    """[class, tree] of a column of codes."""
    n = len(raw)
    out = np.zeros((n, TREES, 8), np.uint8)
    out[:, :, :CODE_BYTES] = np.frombuffer(b"".join(raw.to_pylist()), np.uint8).reshape(n, TREES, CODE_BYTES)
    return out.reshape(n, TREES * 8).view("<i8")


def entries(signed: DataFrame, bitmap=None, bits: int = 0) -> DataFrame:
    """Every class in every tree; the region is the tree and the code.  With ``bitmap``, a broadcast
    of ``2**bits`` bits, only regions whose bit is set."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            region = (_codes(batch.column(1)) | (np.arange(TREES, dtype=np.int64) << (8 * CODE_BYTES))).ravel()
            on = np.arange(len(region))
            if bitmap is not None:
                b = hashed(region, bits)
                on = np.flatnonzero((bitmap.value[b >> 3] >> (b & 7).astype(np.uint8)) & 1)
            who = pa.array(on // TREES)
            yield pa.RecordBatch.from_arrays([pa.array(region[on]), *(batch.column(i).take(who) for i in (0, *range(2, batch.num_columns)))], ENTRY)

    return signed.where("codes IS NOT NULL").select("key", "codes", "side", "n", *FACES).mapInArrow(run, _ENTRY_TYPES)


def places(signed: DataFrame, bits: int) -> DataFrame:
    """(code): the bits of a bitmap of all regions."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                region = _codes(batch.column(0)) | (np.arange(TREES, dtype=np.int64) << (8 * CODE_BYTES))
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(hashed(region.ravel(), bits)))], ["code"])

    return signed.where("codes IS NOT NULL").select("codes").mapInArrow(run, "code bigint")


def hashed(region: np.ndarray, bits: int) -> np.ndarray:
    return (mix(region.view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


# ---- comparing inside regions -------------------------------------------------------------------


def _ranges(start: np.ndarray, stop: np.ndarray):
    """(left, right) of all pairs of i with start[i] .. stop[i] - 1, about ``CHUNK`` at a time."""
    count = np.maximum(stop - start, 0)
    i = np.flatnonzero(count)
    total = np.cumsum(count[i])
    at = 0
    while at < len(i):
        done = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, done + CHUNK, "right")))
        part, c = i[at:to], count[i[at:to]]
        first = np.cumsum(c) - c
        yield np.repeat(part, c), np.arange(c.sum()) - np.repeat(first - start[part], c)
        at = to


def _partners(group: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of elements in the order of (group, side): the range of those that each meets.  Those of
    side 0 meet all behind them, those of side 1 the group's side 2."""
    at = np.arange(len(group))
    new = np.ones(len(group), bool)
    new[1:] = group[1:] != group[:-1]
    g = np.cumsum(new) - 1
    edge = np.append(np.flatnonzero(new), len(group))
    stop = edge[g + 1]
    second = edge[1:] - np.bincount(g, weights=side == 2, minlength=len(edge) - 1).astype(np.int64)
    start = np.where(side == 0, at + 1, second[g])
    return start, np.where(side == 2, start, stop)


class Region:
    """Compares members by size and fingerprint."""

    def __init__(self, threshold: float, limit: int):
        self.threshold, self.radius, self.limit = threshold, radius(threshold), limit
        q = threshold + (1 - threshold) / 16
        # Places that must agree in an order, and orders so that one of them holds with KEPT.
        self.orders = {k: max(1, int(np.ceil(np.log(1 - KEPT) / np.log1p(-(q**k))))) for k in (2, 3, 4)}

    def close(self, i: np.ndarray, j: np.ndarray, n: np.ndarray, faces: np.ndarray) -> np.ndarray:
        n_i, n_j = n[i], n[j]
        on = np.flatnonzero(np.minimum(n_i, n_j) >= self.threshold * np.maximum(n_i, n_j) - EPS)
        i, j, d = i[on], j[on], np.zeros(len(on), np.uint8)
        for w in range(faces.shape[1]):
            x = faces[i, w] ^ faces[j, w]
            x |= x >> np.uint64(1)
            x |= x >> np.uint64(2)
            x &= _LOW
            d += np.bitwise_count(x)
        return on[d <= self.radius]

    def pairs(self, group, side, n, faces) -> tuple[np.ndarray, np.ndarray]:
        """Close pairs of places inside the groups."""
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, j in _ranges(*_partners(group, side)):
            on = self.close(i, j, n, faces)
            left.append(i[on])
            right.append(j[on])
        return np.concatenate(left), np.concatenate(right)

    def split(self, tree: int, side, n, faces) -> tuple[np.ndarray, np.ndarray]:
        """Close pairs of one crowded region: those that share the first places in some order."""
        size = len(n)
        k = 2 if size <= 8 * self.limit else 3 if size <= 64 * self.limit else 4
        rng, found = np.random.default_rng([tree % TREES, k]), []
        free = [x for x in range(MARKS) if x != tree]
        for order in range(self.orders[k]):
            key = np.zeros(size, np.int64)
            for place in rng.choice(free, k, replace=False):
                key = (key << 4) | ((faces[:, place // 16] >> np.uint64(4 * (place % 16))) & np.uint64(15)).astype(np.int64)
            if not order and np.bincount(key).max() >= DENSE_SHARE * size:
                return self.pairs(np.zeros(size, np.int64), side, n, faces)
            at = np.lexsort((side, key))
            i, j = self.pairs(key[at], side[at], n[at], faces[at])
            i, j = at[i], at[j]
            found.append(np.minimum(i, j) * size + np.maximum(i, j))
        both = np.unique(np.concatenate(found))
        return both // size, both % size


def meet(level: DataFrame, threshold: float, limit: int = LIMIT, held: int = HELD) -> DataFrame:
    """(a, b) of close pairs that share a region, and, with null a, the members of regions too large
    for a task.  Of sides, a is that of side 2; else the larger set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, names = Region(threshold, limit), ["a", "b", *ENTRY]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * len(FACES)]

        def out(i, j, key, side, n, rest):
            swap = np.where(side[i] == side[j], (n[i] < n[j]) | ((n[i] == n[j]) & (key[i] < key[j])), side[i] < side[j])
            i, j = np.where(swap, j, i), np.where(swap, i, j)
            ok = key[i] != key[j]
            m = int(ok.sum())
            cols = [pa.concat_arrays([pa.array(x[ok], t), pa.nulls(len(rest[0]), t)]) for x, t in ((key[i], types[0]), (key[j], types[1]))]
            cols += [pa.concat_arrays([pa.nulls(m, t), pa.array(x, t)]) for x, t in zip(rest, types[2:], strict=True)]
            return pa.RecordBatch.from_arrays(cols, names)

        def step(cols):
            """Whole regions."""
            region, key, side, n = cols[:4]
            faces = np.stack([c.view(np.uint64) for c in cols[4:]], axis=1)
            edge = np.append(np.flatnonzero(np.append(True, region[1:] != region[:-1])), len(region))
            size = np.diff(edge)
            two = np.add.reduceat(side == 2, edge[:-1])
            met = np.where(np.add.reduceat(side == 0, edge[:-1]) > 0, size * (size - 1) // 2, two * (size - two))
            crowded, owner = met > limit * limit // 2, np.repeat(size, size)
            small = np.flatnonzero(~np.repeat(crowded, size) & (owner <= held))
            i, j = work.pairs(region[small], side[small], n[small], faces[small])
            left, right = [small[i]], [small[j]]
            for k in np.flatnonzero(crowded & (size <= held)):
                lo, hi = edge[k], edge[k + 1]
                i, j = work.split(int(region[lo] >> (8 * CODE_BYTES)), side[lo:hi], n[lo:hi], faces[lo:hi])
                left.append(i + lo)
                right.append(j + lo)
            over = np.flatnonzero(owner > held)
            return out(np.concatenate(left), np.concatenate(right), key, side, n, [c[over] for c in cols])

        kept, rows, large = [], 0, None
        none = np.zeros(0, np.int64)

        def flush(last: bool):
            """Works on the whole regions held; the one at the end stays unless it is the last."""
            nonlocal kept, rows, large
            cols = [np.concatenate(x) for x in zip(*kept, strict=True)]
            same = np.zeros(len(cols[0]), bool)  # copies signed by several tasks are neighbours
            same[1:] = (cols[0][1:] == cols[0][:-1]) & (cols[1][1:] == cols[1][:-1]) & (cols[2][1:] == cols[2][:-1])
            cols = [c[~same] for c in cols]
            passing = cols[0] == large if large is not None else np.zeros(len(cols[0]), bool)
            if passing.any():
                yield out(none, none, none, none, none, [c[passing] for c in cols])
                cols = [c[~passing] for c in cols]
            cut = len(cols[0]) if last or not len(cols[0]) else int(np.searchsorted(cols[0], cols[0][-1]))
            if cut:
                yield step([c[:cut] for c in cols])
            tail = [c[cut:] for c in cols]
            if len(tail[0]) > held:  # known to be too large: its members pass through
                large = tail[0][0]
                yield out(none, none, none, none, none, tail)
                tail = [c[:0] for c in tail]
            kept, rows = [tail], len(tail[0])

        for batch in batches:
            kept.append([batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)])
            rows += batch.num_rows
            if rows >= max(STEP_ROWS, 2 * len(kept[0][0])):
                yield from flush(False)
        if kept and rows:
            yield from flush(True)

    ordered = level.select(ENTRY).repartition("region").sortWithinPartitions("region", "side", "key")
    return ordered.mapInArrow(run, "a bigint, b bigint, " + _ENTRY_TYPES)


def blocks_of(dense: DataFrame, block: int = BLOCK) -> DataFrame:
    """Entries of dense regions in cells: each pair of blocks of a region is a region of its own, so
    that one of any size spreads over many tasks."""
    n = F.greatest(F.lit(1), F.ceil(F.count("*") / block)).cast("int")
    sizes = dense.groupBy("region").agg(n.alias("all"), F.greatest(F.lit(1), F.ceil(F.count_if(F.col("side") == 1) / block)).cast("int").alias("one"), F.greatest(F.lit(1), F.ceil(F.count_if(F.col("side") == 2) / block)).cast("int").alias("two"))
    tagged = dense.join(sizes, "region")
    mine = lambda c: F.pmod(F.xxhash64("key"), F.col(c)).cast("int")
    others = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    whole = tagged.where("side = 0").withColumn("mine", mine("all")).withColumn("other", F.explode(others("all")))
    whole = whole.withColumn("x", F.least("mine", "other")).withColumn("y", F.greatest("mine", "other")).withColumn("side", F.when(F.col("x") == F.col("y"), 0).when(F.col("mine") == F.col("x"), 1).otherwise(2))
    one = tagged.where("side = 1").withColumn("x", mine("one")).withColumn("y", F.explode(others("two")))
    two = tagged.where("side = 2").withColumn("y", mine("two")).withColumn("x", F.explode(others("one")))
    cells = [d.select(F.xxhash64("region", "x", "y").alias("region"), *ENTRY[1:]) for d in (whole, one, two)]
    return cells[0].unionByName(cells[1]).unionByName(cells[2])


def candidates(signed: DataFrame, level: DataFrame, threshold: float, limit: int = LIMIT, held: int = HELD, block: int = BLOCK) -> DataFrame:
    """Distinct pairs (a, b) of classes that meet: see the module."""
    codes = signed.where("codes IS NOT NULL").select("key", "codes").dropDuplicates(["key"])
    pairs = None
    for depth in range(MAX_SPLITS + 1):
        made = materialize(meet(level, threshold, limit, held), "met")
        new = made.where("a IS NOT NULL").select("a", "b")
        pairs = new if pairs is None else pairs.unionByName(new)
        rest = made.where("a IS NULL").select(ENTRY)
        if rest.isEmpty():
            break
        # Further codes of the members of regions that no task could hold.
        tree, children = F.shiftright("region", 8 * CODE_BYTES), []
        for i in range(CHILDREN):
            at = F.pmod(tree + F.lit(1 + CHILDREN * depth + i), F.lit(TREES)).cast("int") * CODE_BYTES + 1
            code = F.xxhash64("region", F.lit(i), F.substring("codes", at, F.lit(CODE_BYTES))).bitwiseAND(F.lit((1 << 8 * CODE_BYTES) - 1))
            children.append(code.bitwiseOR(F.shiftleft(tree, 8 * CODE_BYTES)))
        split = rest.join(codes, "key").withColumn("child", F.explode(F.array(*children))).drop("codes")
        shares = split.groupBy("region", "child").agg(F.count("*").alias("m")).groupBy("region").agg((F.max("m") * CHILDREN >= DENSE_SHARE * F.sum("m")).alias("dense"))
        if depth == MAX_SPLITS:
            shares = shares.withColumn("dense", F.lit(True))
        shares = materialize(shares, "shares")
        dense = rest.join(shares.where("dense"), "region", "left_semi")
        cells = meet(blocks_of(dense, block), threshold, 1 << 60, 1 << 60)
        pairs = pairs.unionByName(cells.select("a", "b"))
        level = split.join(shares.where("NOT dense"), "region", "left_semi").select(F.col("child").alias("region"), *ENTRY[1:])
    return pairs.distinct()
