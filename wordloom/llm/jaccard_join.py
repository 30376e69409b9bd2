"""Exact Jaccard join of word-shingle sets, size-aware: subsets for small sets, inverted lists for large ones.

Equal sets are one class from the start, named by its smallest id. Two different sets
that reach the threshold are met in one of two ways. Small sets list their subsets of
the sizes that two linked small sets must share, each a key of one hash. Large sets
are scanned through inverted lists: ordered from the rarest shingle on, two linked sets
share one of their first ones, so only these are listed, by the large sets and by those
small sets that are large enough to link with them. The size that parts small from
large is the one with the least cost, from the counts of sizes and from how often
shingles repeat. Rareness comes from a sketch of counters of fixed size; any order that
is the same for all sets gives exact results, a good one gives short lists.

A key's list is not expanded into pairs. Each member is first compared to the hub of the
list, so that a large group of near copies costs one comparison each; lists whose members
are connected by then are done. In the others, what is not connected to the hub is
compared to all that it is not connected to, in cells of bounded size inside tasks, by
bitmaps whose bound is exact; only pairs that may link leave a task. Bitmaps of long sets
are as wide as the sets, so that few pairs but links have their sets read. Nothing is capped.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import as_bytes, pack, pick, plain_names, sent_whole, text_slices, unpack
from wordloom.session import stage

COUNTERS = 1 << 20
SLICES = 64
SMALL_SIZES = 64
BITMAP = 1024
BLOCK = 1024
SIFT = 1 << 20


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted distinct 63-bit hashes of each text's runs of ``words`` lower-cased words; a shorter text is one run."""
    split = [t.lower().split() for t in texts]
    known = {w: xxhash.xxh3_64_intdigest(w) for w in set().union(*split)}
    flat = np.fromiter((known[w] for ws in split for w in ws), np.uint64, sum(map(len, split)))
    mixed = np.zeros(max(0, len(flat) - words + 1), np.uint64)
    with np.errstate(over="ignore"):
        for step in range(words):
            mixed = (mixed ^ flat[step : step + len(mixed)]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
    mixed = (mixed >> np.uint64(1)).astype(np.int64)
    out, at = [], 0
    for ws in split:
        n = len(ws)
        if n >= words:
            out.append(np.unique(mixed[at : at + n - words + 1]))
        elif n:
            out.append(np.array([xxhash.xxh3_64_intdigest(b"\x20".join(ws), seed=1) >> 1], np.int64))
        else:
            out.append(np.zeros(0, np.int64))
        at += n
    return out


class Threshold:
    """Jaccard >= over / under, in whole numbers."""

    def __init__(self, over: int, under: int):
        self.over, self.under = over, under

    def least_of(self, n: int) -> int:
        """Fewest shingles that a set of n shares with any partner, also the least partner size."""
        return -(-self.over * n // self.under)

    def shared(self, n, m):
        """Fewest shingles that sets of n and m share."""
        return -(-self.over * (n + m) // (self.over + self.under))

    def prefix(self, n: int) -> int:
        return n - self.least_of(n) + 1

    def subset_sizes(self, n: int, small: int) -> list[int]:
        """What sets of n share at least with partners of at most ``small``."""
        return sorted({self.shared(n, m) for m in range(self.least_of(n), min(small, n * self.under // self.over) + 1)})

    def subsets(self, n: int, small: int) -> int:
        return sum(comb(n, c) for c in self.subset_sizes(n, small))


def sketch_batches(words: int):
    """Counters of all shingles and the numbers of sets by size, in slices of the counters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, sizes = np.zeros(COUNTERS, np.int64), np.zeros(SMALL_SIZES + 1, np.int64)
        for chunk in text_slices(batches, "text"):
            sets = shingle_sets(as_bytes(chunk.column("text")), words)
            counters += np.bincount(np.concatenate(sets) & (COUNTERS - 1), minlength=COUNTERS)
            sizes += np.bincount(np.minimum([len(s) for s in sets], SMALL_SIZES), minlength=SMALL_SIZES + 1)
        if sizes.any():
            parts = [*np.split(counters, SLICES), sizes]
            yield pa.RecordBatch.from_pydict({
                "slice": pa.array(np.arange(len(parts), dtype=np.int32)), "counts": pa.array([pack(p) for p in parts], pa.binary()),
            })

    return run


def add_slices(table: pa.Table) -> pa.Table:
    total = sum(unpack(x, np.int64) for x in table.column("counts").to_pylist())
    return pa.table({"slice": table.column("slice").slice(0, 1), "counts": [pack(total)]})


def small_limit(threshold: Threshold, counters: np.ndarray, sizes: np.ndarray) -> int:
    """The largest size handled by subsets: the one with the least cost over all sets.

    A subset costs its row. An inverted entry costs its row and the members that it meets there: the mean length
    of a list, from the counters' second moment without what chance alone gives.
    """
    total = counters.sum()
    if not total:
        return 0
    length = max(0.0, float((counters.astype(float) ** 2).sum() - total) / total - total / COUNTERS)
    best, least = 0, None
    for small in range(SMALL_SIZES):
        cost = 0.0
        for n in range(1, SMALL_SIZES + 1):
            if n <= small:
                cost += float(sizes[n]) * threshold.subsets(n, small)
            if n >= threshold.least_of(small + 1):
                cost += float(sizes[n]) * threshold.prefix(n) * (1 + length)
        if least is None or cost < least:
            best, least = small, cost
    return best


def subset_keys(shingles: np.ndarray, sizes: list[int]) -> list[int]:
    """A hash of each subset of these sizes: the sum of its mixed shingles and a mark of its size."""
    n = len(shingles)
    with np.errstate(over="ignore"):
        mixed = shingles.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0x165667B19E3779F9)
        total = mixed.sum(dtype=np.uint64)
        out = []
        for size in sizes:
            gone = n - size
            mark = np.uint64((size + 1) * 0x27D4EB2F165667C5 & 0xFFFFFFFFFFFFFFFF)
            if gone == 0:
                out.append(int((total + mark) >> np.uint64(1)))
                continue
            left_out = np.array(list(combinations(range(n), gone)), np.int64)
            out += ((total + mark - mixed[left_out].sum(axis=1, dtype=np.uint64)) >> np.uint64(1)).tolist()
    return [-x - 1 for x in out]  # apart from the shingles, which are not negative


def bitmap(shingles: np.ndarray) -> bytes:
    """Which of 1024 hash classes hold an odd number of shingles."""
    odd = np.bincount((shingles >> 20) & (BITMAP - 1), minlength=BITMAP) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def wide_bitmap(shingles: np.ndarray) -> bytes | None:
    """The same over as many classes as the set has shingles, at least; None for sets that the short bitmap can tell apart."""
    if len(shingles) <= BITMAP:
        return None
    width = 1 << (len(shingles) - 1).bit_length()
    odd = np.bincount((shingles >> 20) & (width - 1), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def wide_apart(x: bytes, y: bytes) -> int:
    """Least number of shingles that only one of two sets holds, by wide bitmaps; the longer is folded to the shorter."""
    a, b = (np.frombuffer(z, np.uint8) for z in sorted((x, y), key=len))
    return int(np.bitwise_count(a ^ np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)).sum(dtype=np.int64))


LISTED = "n int, sign binary, bits binary, wide binary, keys array<long>"


def list_sets(words: int, threshold: Threshold, counters: np.ndarray, small: int):
    def keys_of(shingles: np.ndarray) -> list[int]:
        n = len(shingles)
        if not n:
            return []
        keys = subset_keys(shingles, threshold.subset_sizes(n, small)) if n <= small else []
        if n >= threshold.least_of(small + 1):
            order = np.lexsort((shingles, counters[shingles & (COUNTERS - 1)]))
            keys += shingles[order[: threshold.prefix(n)]].tolist()
        return keys

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_slices(batches, "text"):
            sets = shingle_sets(as_bytes(chunk.column("text")), words)
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.column("id"), pa.array([len(s) for s in sets], pa.int32()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([bitmap(s) for s in sets], pa.binary()), pa.array([wide_bitmap(s) for s in sets], pa.binary()),
                    pa.array([keys_of(s) for s in sets], pa.list_(pa.int64())),
                ],
                names=["id", "n", "sign", "bits", "wide", "keys"],
            )

    return run


def write_sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_slices(batches, "text"):
            sets = shingle_sets(as_bytes(chunk.column("text")), words)
            yield pa.RecordBatch.from_arrays([chunk.column("id"), pa.array([s.tobytes() for s in sets], pa.binary())], names=["id", "shingles"])

    return run


def may_link(threshold: Threshold):
    """Keeps pairs whose bitmaps leave room for enough shared shingles; an exact bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BITMAP // 8) for c in ("bits_a", "bits_b"))
            n, m = (batch.column(c).to_numpy().astype(np.int64) for c in ("n_a", "n_b"))
            apart = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
            least = threshold.shared(n, m)
            keep = (n + m - apart) // 2 >= least
            long = keep & pc.and_(pc.is_valid(batch.column("wide_a")), pc.is_valid(batch.column("wide_b"))).to_numpy(zero_copy_only=False)
            for i in np.flatnonzero(long):
                wide = wide_apart(batch.column("wide_a")[i].as_py(), batch.column("wide_b")[i].as_py())
                keep[i] = (n[i] + m[i] - wide) // 2 >= least[i]
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def near_rows(table: pa.Table, threshold: Threshold) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs of rows of a cell that may link; rows of a cell stand together.

    Row i meets row i + step for every step at once over all cells; bitmaps are compared word by word, for as long as
    a pair's bound lasts.
    """
    cell = table.column("cell_id").to_numpy()
    n, side = (table.column(c).to_numpy().astype(np.int64) for c in ("n", "side"))
    place = table.column("component").combine_chunks().dictionary_encode().indices.to_numpy()
    bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint64).reshape(len(n), -1)
    within = table.column("kind").to_numpy() == 1
    left, found_a, found_b = np.arange(len(n)), [], []
    step = 0
    while len(left):
        step += 1
        left = left[left < len(n) - step]
        left = left[cell[left] == cell[left + step]]
        a, b = left, left + step
        meet = (within[a] | (side[a] != side[b])) & (place[a] != place[b])
        meet &= np.minimum(n[a], n[b]) * threshold.under >= np.maximum(n[a], n[b]) * threshold.over
        a, b = a[meet], b[meet]
        room = n[a] + n[b] - 2 * threshold.shared(n[a], n[b])
        for word in range(bits.shape[1]):
            room = room - np.bitwise_count(bits[a, word] ^ bits[b, word])
            lasts = room >= 0
            a, b, room = a[lasts], b[lasts], room[lasts]
        found_a.append(a)
        found_b.append(b)
    return tuple(np.concatenate([*x, np.zeros(0, np.int64)]) for x in (found_a, found_b))


def compare_cells(threshold: Threshold):
    """Pairs (a, b) that may link, from rows sorted by cell; what is held is a batch and one cell, of bounded size."""

    def pairs(table: pa.Table) -> pa.RecordBatch:
        a, b = near_rows(table, threshold)
        ids = table.column("id").combine_chunks()
        x, y = ids.take(pa.array(a)), ids.take(pa.array(b))
        first = pc.less(x, y)
        return pa.RecordBatch.from_arrays([pc.if_else(first, x, y), pc.if_else(first, y, x)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            cell = held.column("cell_id").to_numpy()
            whole = int(np.searchsorted(cell, cell[-1]))
            if whole:
                yield pairs(held.slice(0, whole))
                held = held.slice(whole)
        if held is not None:
            yield pairs(held)

    return run


def do_link(threshold: Threshold):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("shingles_a").to_pylist(), batch.column("shingles_b").to_pylist(), strict=True):
                a, b = np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(both * threshold.under >= threshold.over * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id connected to each id of the edges (a, b), by large-star and small-star steps."""

    def star(arcs: DataFrame, large: bool) -> DataFrame:
        seen = arcs.unionByName(arcs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = seen if large else seen.filter("v < u")
        low = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        joined = near.join(low, "u")
        if large:
            out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        return out.filter("u <> v").distinct()

    arcs = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "arcs")
    mark = None
    while True:
        row = arcs.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
        if (row.n, row.h) == mark:
            break
        mark = (row.n, row.h)
        arcs = stage(star(star(arcs, True), False), "arcs")
    found = arcs.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component"))
    roots = found.select(F.col("component").alias("id")).distinct().withColumn("component", F.col("id"))
    return stage(found.unionByName(roots), "components")


class Join:
    """One run over a table of (id, text)."""

    def __init__(self, rows: DataFrame, words: int, threshold: Threshold):
        self.rows, self.words, self.threshold = rows, words, threshold
        self.spark = rows.sparkSession
        self.kind = rows.schema["id"].dataType.simpleString()

    def sketch(self) -> tuple[np.ndarray, np.ndarray]:
        """Summed counters (2**20 at any input) and numbers of sets by size."""
        parts = self.rows.select("text").mapInArrow(sketch_batches(self.words), "slice int, counts binary")
        slices = sorted(parts.groupBy("slice").applyInArrow(add_slices, "slice int, counts binary").collect())
        if not slices:
            return np.zeros(COUNTERS, np.int64), np.zeros(SMALL_SIZES + 1, np.int64)
        arrays = [unpack(s.counts, np.int64) for s in slices]
        return np.concatenate(arrays[:-1]), arrays[-1]

    def prepare(self) -> None:
        counters, sizes = self.sketch()
        self.small = small_limit(self.threshold, counters, sizes)
        order = np.minimum(counters, np.iinfo(np.int32).max).astype(np.int32)
        run = list_sets(self.words, self.threshold, order, self.small)
        self.listed = stage(self.rows.mapInArrow(run, f"id {self.kind}, {LISTED}"), "sets_listed")
        known = self.listed.filter("n > 0 and id is not null")
        first = F.min_by(F.struct("n", "bits", "wide", "keys"), "id").alias("own")
        self.reps = stage(known.groupBy("sign").agg(F.min("id").alias("id"), first).select("sign", "id", "own.*"), "set_reps")
        entries = self.reps.select("id", "n", F.explode("keys").alias("key"))
        shared = stage(entries.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low <> high").select("key"), "shared_keys")
        self.entries = stage(entries.join(shared, "key"), "shared_entries").withColumn("component", F.col("id"))

    def read_sets(self, pairs: DataFrame) -> DataFrame:
        """(id, shingles) of the sets in these pairs; the texts are sifted by a table of at most 2**20 rows, not moved."""
        ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        sieve = ids.select(F.pmod(F.xxhash64("id"), F.lit(SIFT)).alias("h")).distinct()
        some = self.rows.filter("id is not null").withColumn("h", F.pmod(F.xxhash64("id"), F.lit(SIFT))).join(F.broadcast(sieve), "h", "left_semi")
        return stage(some.select("id", "text").mapInArrow(write_sets(self.words), f"id {self.kind}, shingles binary"), "sets")

    def verify(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that reach the threshold: first by bitmap, then by the sets of those that are left."""
        pairs = stage(pairs.select("a", "b").distinct(), "pairs")
        ab = f"a {self.kind}, b {self.kind}"
        for side in "ab":
            own = self.reps.select(F.col("id").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("n", "bits", "wide")])
            pairs = pairs.join(own, side)
        likely = pairs = stage(pairs.mapInArrow(may_link(self.threshold), ab).distinct(), "likely_pairs")
        sets = self.read_sets(likely)
        for side in "ab":
            pairs = pairs.join(sets.select(F.col("id").alias(side), F.col("shingles").alias(f"shingles_{side}")), side)
        return pairs.mapInArrow(do_link(self.threshold), ab).distinct()

    def near_size(self, n: str, m: str):
        small, large = F.least(n, m), F.greatest(n, m)
        return small * self.threshold.under >= large * self.threshold.over

    def join_hub(self) -> DataFrame:
        """Each entry beside the smallest id of its list."""
        hubs = self.entries.groupBy("key").agg(F.min(F.struct("id", "n")).alias("hub"))
        met = self.entries.join(hubs, "key").filter((F.col("id") != F.col("hub.id")) & self.near_size("n", "hub.n"))
        return met.select(F.col("hub.id").alias("a"), F.col("id").alias("b"))

    def join_rest(self) -> DataFrame:
        """Pairs of a list that may link and are not connected yet; those with the hub have been compared.

        A list has two sides: what is connected to its hub, and the rest. Blocks of the rest meet all blocks, blocks
        of the first side never meet each other; a block has about BLOCK members, two of them make a cell.
        """
        mains = self.entries.groupBy("key").agg(
            F.min(F.struct("id", "component")).alias("hub"), F.min("component").alias("low"), F.max("component").alias("high"),
            F.count(F.lit(1)).alias("length"),
        ).filter("low <> high and length > 2")
        sided = self.entries.join(mains.select("key", "hub"), "key").filter(F.col("id") != F.col("hub.id")).select(
            "key", "id", "n", "component", (F.col("component") != F.col("hub.component")).cast("int").alias("side")
        )
        sided = stage(sided, "sided")
        blocks = sided.groupBy("key").agg(*[
            F.ceil(F.sum(F.when(F.col("side") == side, 1).otherwise(0)) / BLOCK).cast("int").alias(f"blocks{side}") for side in (0, 1)
        ]).filter("blocks1 > 0")
        own = F.pmod(F.xxhash64("id"), F.when(F.col("side") == 0, F.col("blocks0")).otherwise(F.col("blocks1"))).cast("int")
        placed = sided.join(blocks, "key").withColumn("block", own)
        numbers = lambda n: F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))
        cross = F.transform(numbers("blocks1"), lambda k: F.struct(F.lit(0).alias("kind"), k.alias("i"), F.col("block").alias("j")))
        across = F.transform(numbers("blocks0"), lambda k: F.struct(F.lit(0).alias("kind"), F.col("block").alias("i"), k.alias("j")))
        inside = F.transform(
            numbers("blocks1"), lambda k: F.struct(F.lit(1).alias("kind"), F.least("block", k).alias("i"), F.greatest("block", k).alias("j"))
        )
        cells = placed.withColumn("cell", F.explode(F.when(F.col("side") == 0, cross).otherwise(F.concat(across, inside))))
        cells = cells.select(F.xxhash64("key", "cell").alias("cell_id"), F.col("cell.kind").alias("kind"), "id", "n", "component", "side")
        cells = cells.join(self.reps.select("id", "bits").dropDuplicates(["id", "bits"]), "id")
        return cells.repartition("cell_id").sortWithinPartitions("cell_id").mapInArrow(
            compare_cells(self.threshold), f"a {self.kind}, b {self.kind}"
        ).distinct()

    def relabel(self, found: DataFrame) -> None:
        base = self.entries.select("key", "id", "n")
        self.entries = stage(
            base.join(found, "id", "left").select("key", "id", "n", F.coalesce("component", "id").alias("component")), "entries"
        )

    def run(self) -> DataFrame:
        """(id, n, component) of every row."""
        self.prepare()
        edges = stage(self.verify(self.join_hub()), "links")
        self.relabel(components(edges))
        edges = stage(edges.unionByName(self.verify(self.join_rest())), "links")
        found = components(edges)
        named = self.reps.select("sign", "id").join(found, "id", "left").select("sign", F.coalesce("component", "id").alias("component"))
        kept = self.listed.select("id", "n", "sign")
        linked = kept.filter("n > 0 and id is not null").join(named, "sign").select("id", "n", "component")
        alone = kept.filter("n = 0 or id is null").select("id", "n", F.col("id").alias("component"))
        return linked.unionByName(alone)


def jaccard_components(
    docs: DataFrame, words: int = 5, over: int = 4, under: int = 5, id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """doc_id, n_shingles, component_id of every row: its set's size and the smallest id reachable by links.

    Documents link when their sets of ``words``-word shingles have a Jaccard likeness of at least over / under. Texts
    with fewer words are one shingle; null and empty texts and texts without words have no shingle, link with
    nothing and are their own component, as are rows without an id (component null). Repeated rows and rows of equal
    ids are one node. An empty table gives no rows. Shingles are told apart by 63-bit hashes, sets by 128-bit ones.
    """
    rows = pick(docs, id, text).toDF("id", "text")
    found = Join(rows, words, Threshold(over, under)).run()
    return found.select(F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), F.col("component").alias("component_id"))


def keep_one(docs: DataFrame, words: int = 5, over: int = 4, under: int = 5, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows, unchanged, of the smallest id of each component; of rows with equal ids, the least by all columns.

    Rows without an id stay. The ids that go are sent to the scan if they are counted to be few, else joined by shuffle.
    """
    found = stage(jaccard_components(docs, words, over, under, id, text), "near_copies").filter("doc_id is not null")
    gone = stage(found.filter("component_id <> doc_id").select(F.col("doc_id").alias("key")).distinct(), "copies")
    repeated = stage(found.groupBy(F.col("doc_id").alias("key")).count().filter("count > 1").select("key"), "repeated_ids")
    plain = plain_names(docs, key=id)
    kept = plain.join(sent_whole(gone), "key", "left_anti").select(*plain.columns)
    many = sent_whole(repeated)
    once = kept.join(many, "key", "left_anti").select(*plain.columns)
    first = kept.join(many, "key", "left_semi").groupBy("key").agg(F.min(F.struct(*plain.columns)).alias("row"))
    return once.unionByName(first.select(*[F.col("row")[c].alias(c) for c in plain.columns])).toDF(*docs.columns)
