"""Variable-capacity best-fit packing of documents into training sequences.

Several sequence lengths are permitted. What counts is the sum of the final bins' costs.
Each shard is packed in two ways, and the cheaper result is taken. Best fit: a piece goes
to the open bin that it fills best, and if none has room, a bin is opened at one size for
the whole shard (all permitted sizes are tried) or the least that fits. By cost: bins are
filled one by one, each at its own size, the one whose cost for each packed token is least
given the pieces still to place. At the end every bin shrinks to the smallest permitted
length that holds what it got.

Documents are dealt to shards of bounded size by a hash of the row, and each shard packs
on its own: lengths alone move, and a shard's last unfilled bins are all that is lost
against one global run. Within a shard equal lengths are kept together as counts.
"""

from __future__ import annotations

import bisect
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import pick
from wordloom.session import stage

CAPACITIES = (512, 1024, 2048, 4096)
SHARD_ROWS = 20_000


def bin_cost(capacity: int) -> float:
    """Cost of a sequence: its tokens, and a part that grows with the square, as attention does."""
    return capacity * (1 + capacity / 65536)


def best_fit(lengths: np.ndarray, open_at: int, capacities: Sequence[int]) -> list[list[int]]:
    """Positions of the pieces in each bin; pieces come longest first, bins open at ``open_at`` or the least size that fits."""
    bins: list[list[int]] = []
    rooms: list[tuple[int, int]] = []  # (room left, bin), ascending
    for piece in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[piece])
        at = bisect.bisect_left(rooms, (size, -1))
        if at < len(rooms):
            room, number = rooms.pop(at)
            bins[number].append(piece)
        else:
            room = next(c for c in capacities if c >= max(size, open_at))
            number = len(bins)
            bins.append([piece])
        if room > size:
            bisect.insort(rooms, (room - size, number))
    return bins


def downsize(total: int, capacities: Sequence[int]) -> int:
    return next(c for c in capacities if c >= total)


def pack_lengths(lengths: np.ndarray, capacities: Sequence[int] = CAPACITIES) -> list[tuple[int, list[int]]]:
    """(final capacity, positions in order) of each bin, for the opening size with the least total cost."""
    best, least = [], None
    for open_at in capacities:
        bins = [(downsize(int(lengths[b].sum()), capacities), b) for b in best_fit(lengths, open_at, capacities)]
        cost = sum(bin_cost(c) for c, _ in bins)
        if least is None or cost < least:
            best, least = bins, cost
    return best


def open_by_cost(lengths: np.ndarray, capacities: Sequence[int] = CAPACITIES) -> list[tuple[int, list[int]]]:
    """(final capacity, positions in order) of bins that each open at the size of least cost for each packed token.

    A bin takes the longest piece left, then as long ones as have room.
    """
    left: dict[int, list[int]] = {}
    for piece in np.argsort(-lengths, kind="stable")[::-1].tolist():
        left.setdefault(int(lengths[piece]), []).append(piece)
    there = sum(1 << size for size in left)  # bit by length
    bins = []
    while there:
        best = None
        for capacity in capacities:
            if capacity < there.bit_length() - 1:
                continue
            room, fits, taken = capacity, there, []
            while fits := fits & ((2 << room) - 1):
                size = fits.bit_length() - 1
                n = min(len(left[size]), room // size)
                taken.append((size, n))
                room -= size * n
                fits ^= 1 << size
            final = downsize(capacity - room, capacities)
            rate = bin_cost(final) / (capacity - room)
            if best is None or rate < best[0]:
                best = rate, final, taken
        pieces = []
        for size, n in best[2]:
            pieces += [left[size].pop() for _ in range(n)]
            if not left[size]:
                there ^= 1 << size
        bins.append((best[1], pieces))
    return bins


def pack_pieces(lengths: np.ndarray, capacities: Sequence[int] = CAPACITIES) -> list[tuple[int, list[int]]]:
    """The cheaper of both ways."""
    return min(pack_lengths(lengths, capacities), open_by_cost(lengths, capacities), key=lambda bins: sum(bin_cost(c) for c, _ in bins))


def pack_shard(capacities: Sequence[int]):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("id", "ascending"), ("piece", "ascending"), ("twin", "ascending")])
        lengths = table.column("length").to_numpy()
        number = np.zeros(len(lengths), np.int64)
        capacity = np.zeros(len(lengths), np.int32)
        offset = np.zeros(len(lengths), np.int32)
        for k, (size, pieces) in enumerate(pack_pieces(lengths, capacities)):
            number[pieces], capacity[pieces] = k, size
            offset[pieces] = np.cumsum(lengths[pieces]) - lengths[pieces]
        return table.select(["id", "piece", "length", "shard"]).append_column("number", pa.array(number)).append_column(
            "capacity", pa.array(capacity)
        ).append_column("offset", pa.array(offset))

    return run


def pack_documents(docs: DataFrame, capacities: Sequence[int] = CAPACITIES, shard_rows: int = SHARD_ROWS, id: str = "doc_id", text: str = "text", length: str | None = None) -> DataFrame:
    """One row per piece of a document: doc_id, piece, length, bin_id, capacity, offset.

    A document's length is what the column ``length`` says, the tokens of its text, and one end token; without such a
    column the white-space words stand for the tokens, which are fewer than a tokenizer's. Documents longer than the largest
    capacity are cut into pieces of that length and a rest; nothing is dropped. Null and empty texts are one token
    long; repeated rows and null ids are packed each; an empty table gives no rows. Bins hold pieces of one shard.
    """
    largest = max(capacities)
    words = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    if length is None:
        rows = pick(docs, id, text).toDF("id", "text").select("id", (words + 1).alias("whole"))
    else:
        rows = pick(docs, id, length).toDF("id", "n").select("id", (F.greatest(F.coalesce("n", F.lit(0)), F.lit(0)) + 1).alias("whole"))
    rows = stage(rows, "packing_lengths")
    n = rows.count()
    shards = max(1, -(-n // shard_rows))
    pieces = (
        rows.withColumn("twin", F.monotonically_increasing_id())
        .withColumn("piece", F.explode(F.sequence(F.lit(0), F.ceil(F.col("whole") / largest).cast("int") - 1)))
        .withColumn("length", F.least(F.col("whole") - F.col("piece") * largest, F.lit(largest)).cast("int"))
        .withColumn("shard", F.pmod(F.xxhash64("id", "twin", "piece"), F.lit(shards)).cast("int"))
        .drop("whole")
    )
    kind = rows.schema["id"].dataType.simpleString()
    packed = pieces.groupBy("shard").applyInArrow(
        pack_shard(sorted(capacities)), f"id {kind}, piece int, length int, shard int, number long, capacity int, offset int"
    )
    return packed.select(
        F.col("id").alias("doc_id"), "piece", "length",
        (F.col("shard").cast("long") * (1 << 32) + F.col("number")).alias("bin_id"), "capacity", "offset",
    )
