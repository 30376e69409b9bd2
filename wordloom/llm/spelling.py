"""Spelling variants: words one edit apart, found by k-d trees over letter-count vectors.

One edit moves a word's vector of letter counts by little in L1 distance: a replaced letter by exactly
two (one count falls, another rises) at equal length, an inserted or deleted one by exactly one at
neighbouring lengths. So each pair of lengths is a range search: a k-d tree over the vectors of one length is
descended with all queries at once, branches whose box lies too far are pruned, and what the leaves
leave is compared letter by letter.

The tree has two parts. The upper splits are found level by level from histograms of all words, until a cell holds a bounded
number of them; each word is stored in its cell, and sent as a query to the cells that its ball reaches. Inside a cell a task
builds the rest of the tree with tight boxes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.common import pick
from wordloom.session import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = "[A-Za-zÀ-ÿ]+"
DAMAGE = 97
MIN_LENGTH = 5
MIN_COUNT = 3
MARGIN = 2  # a form occurs at least so many times as often
CELL_WORDS = 20_000
LEAF_WORDS = 24
PAIRS_AT_ONCE = 200_000
QUERIES_AT_ONCE = 20_000

#: Place of each Latin-1 letter in a vector: a-z, then U+00C0 to U+00FF; other bytes do not occur in a word.
LETTERS = 26 + 64
PLACE = np.zeros(256, np.int16)
PLACE[ord("a") : ord("z") + 1] = np.arange(26)
PLACE[0xC0:] = 26 + np.arange(64)


# --- words -------------------------------------------------------------------------------------------


def damaged(id: Column, run: Column, every: int) -> Column:
    """The run, without one letter if the crc32 of ``id:run`` is a multiple of ``every``."""
    hashed = F.crc32(F.concat(F.coalesce(id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(hashed, F.char_length(run).cast("long")).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(hashed % every == 0, cut).otherwise(run)


def counted_words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, every: int = DAMAGE, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): runs of letters, A-Z lower-cased, of at least so many letters and occurrences. Null texts have none."""
    rows = pick(docs, id, text).toDF("id", "text")
    low = F.translate("text", UPPER, LOWER)
    runs = rows.select("id", F.explode(F.regexp_extract_all(low, F.lit(f"({RUN})"), F.lit(1))).alias("run"))
    words = runs.select(damaged(F.col("id"), F.col("run"), every).alias("word")).filter(F.char_length("word") >= min_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


# --- vectors and trees -------------------------------------------------------------------------------


def letter_matrix(words: list[str]) -> np.ndarray:
    """One row of Latin-1 bytes for each word; all have one length."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def count_vectors(matrix: np.ndarray) -> np.ndarray:
    """How often each letter occurs in each row."""
    kind = np.int8 if matrix.shape[1] <= 63 else np.int32  # differences of counts fit too
    out = np.zeros((len(matrix), LETTERS), kind)
    for column in PLACE[matrix].T:
        out[np.arange(len(matrix)), column] += 1
    return out


@dataclass
class Node:
    """A box of counts, both ends included; a leaf has a cell number or the rows that lie in it."""

    low: np.ndarray
    high: np.ndarray
    letter: int = -1
    most: int = 0  # rows with at most so many of the letter go left
    left: Node | None = None
    right: Node | None = None
    cell: int = -1
    rows: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def leaves(self) -> Iterator[Node]:
        if self.left is None:
            yield self
        else:
            yield from self.left.leaves()
            yield from self.right.leaves()


def within(node: Node, vectors: np.ndarray, radius: int) -> Iterator[tuple[Node, np.ndarray]]:
    """(leaf, rows of ``vectors`` whose ball reaches its box), for all leaves that any reaches."""
    pending = [(node, np.arange(len(vectors)))]
    while pending:
        node, rows = pending.pop()
        near = vectors[rows]
        gap = np.maximum(np.maximum(node.low - near, near - node.high), 0).sum(axis=1, dtype=np.int64)
        rows = rows[gap <= radius]
        if not len(rows):
            continue
        if node.left is None:
            yield node, rows
        else:
            pending += [(node.left, rows), (node.right, rows)]


def local_tree(vectors: np.ndarray, rows: np.ndarray | None = None) -> Node:
    """A tree with tight boxes over rows of ``vectors``; leaves hold few rows, or rows that are all equal."""
    rows = np.arange(len(vectors)) if rows is None else rows
    here = vectors[rows]
    node = Node(here.min(axis=0), here.max(axis=0))
    spread = node.high - node.low
    if len(rows) <= LEAF_WORDS or not spread.any():
        node.rows = rows
        return node
    node.letter = int(np.argmax(here.astype(np.float32).var(axis=0)))
    column = here[:, node.letter]
    # the median, or one less if nothing lies above it
    node.most = int(min(np.partition(column, len(column) // 2)[len(column) // 2], node.high[node.letter] - 1))
    goes_left = column <= node.most
    node.left, node.right = local_tree(vectors, rows[goes_left]), local_tree(vectors, rows[~goes_left])
    return node


# --- upper tree --------------------------------------------------------------------------------------


def root_of(length: int, cell: int) -> Node:
    kind = np.int8 if length <= 63 else np.int32
    return Node(np.zeros(LETTERS, kind), np.full(LETTERS, min(length, 127) if kind is np.int8 else length, kind), cell=cell)


def split_cell(node: Node, letter: int, most: int, cells: tuple[int, int]) -> None:
    high, low = node.high.copy(), node.low.copy()
    high[letter], low[letter] = most, most + 1
    node.letter, node.most = letter, most
    node.left, node.right = Node(node.low, high, cell=cells[0]), Node(low, node.high, cell=cells[1])


def own_cells(root: Node, vectors: np.ndarray) -> np.ndarray:
    """The cell of each row."""
    out = np.zeros(len(vectors), np.int32)
    pending = [(root, np.arange(len(vectors)))]
    while pending:
        node, rows = pending.pop()
        if node.left is None:
            out[rows] = node.cell
        elif len(rows):
            goes_left = vectors[rows, node.letter] <= node.most
            pending += [(node.left, rows[goes_left]), (node.right, rows[~goes_left])]
    return out


def by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str], np.ndarray]]:
    """(length, words, their rows in the batch)."""
    words = batch.column("word").to_pylist()
    lengths = np.array([len(w) for w in words], np.int64)
    for length in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == length)
        yield length, [words[i] for i in rows.tolist()], rows


def histograms(trees: dict[int, Node], open_cells: set[int]):
    """For each open cell, how many words have how many of each letter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for length, words, _ in by_length(batch):
                vectors = count_vectors(letter_matrix(words))
                cells = own_cells(trees[length], vectors)
                for cell in open_cells.intersection(np.unique(cells).tolist()):
                    inside = vectors[cells == cell]
                    counted = np.zeros((LETTERS, length + 1), np.int64)
                    np.add.at(counted, (np.broadcast_to(np.arange(LETTERS), inside.shape), inside), 1)
                    key = (length, cell)
                    totals[key] = totals.get(key, 0) + counted
        rows = [(cell, letter, value, int(counted[letter, value])) for (_, cell), counted in totals.items() for letter, value in np.argwhere(counted).tolist()]
        columns = list(zip(*rows, strict=True)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)], names=["cell", "letter", "value", "n"])

    return run


def upper_trees(words: DataFrame, cell_words: int = CELL_WORDS) -> dict[int, Node]:
    """A tree for each length of words: cells are halved level by level while they hold more than ``cell_words``.

    The split of a cell is the letter and count that part its words most evenly, chosen in Spark from histograms of all of
    them; the driver gets one row per cell. Words with equal vectors cannot be parted and share a cell.
    """
    lengths = words.groupBy(F.char_length("word").alias("length")).agg(F.count(F.lit(1)).alias("n")).collect()
    trees, at = {}, {}
    open_cells = set()
    for cell, row in enumerate(sorted(lengths)):
        at[cell] = trees[row.length] = root_of(row.length, cell)
        if row.n > cell_words:
            open_cells.add(cell)
    last = len(at)
    while open_cells:
        counted = words.select("word").mapInArrow(histograms(trees, open_cells), "cell int, letter int, value int, n long")
        counted = counted.groupBy("cell", "letter", "value").agg(F.sum("n").alias("n"))
        line = Window.partitionBy("cell", "letter")
        below = F.sum("n").over(line.orderBy("value"))
        sides = counted.select("cell", "letter", "value", below.alias("below"), (F.sum("n").over(line) - below).alias("above"))
        evenly = F.struct(F.least("below", "above").alias("least"), (-F.col("letter")).alias("letter"), "value", "below", "above")
        best = sides.groupBy("cell").agg(F.max(evenly).alias("best")).select("cell", "best.*")
        open_cells = set()
        for row in best.collect():
            if not row.least:
                continue
            new = (last + 1, last + 2)
            last += 2
            node = at.pop(row.cell)
            split_cell(node, -row.letter, row.value, new)
            at[new[0]], at[new[1]] = node.left, node.right
            open_cells |= {cell for cell, n in zip(new, (row.below, row.above), strict=True) if n > cell_words}
    return trees


# --- search ------------------------------------------------------------------------------------------

ROUTED = "cell int, length int, role int, word string, n long"
PAIRS = "word string, near string, near_n long"
STORED, SAME, SHORTER = 0, 1, 2


def route(trees: dict[int, Node]):
    """Each word to its own cell, to later cells of its length, and to those of words one letter longer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, QUERIES_AT_ONCE):
                part = batch.slice(start, QUERIES_AT_ONCE)
                for length, words, rows in by_length(part):
                    vectors = count_vectors(letter_matrix(words))
                    own = own_cells(trees[length], vectors)
                    sent = [(own, np.arange(len(words)), STORED, length)]
                    for leaf, near in within(trees[length], vectors, 2):
                        near = near[own[near] < leaf.cell]
                        sent.append((np.full(len(near), leaf.cell, np.int32), near, SAME, length))
                    if length + 1 in trees:
                        for leaf, near in within(trees[length + 1], vectors.astype(trees[length + 1].low.dtype), 1):
                            sent.append((np.full(len(near), leaf.cell, np.int32), near, SHORTER, length + 1))
                    for cells, near, role, target in sent:
                        if len(near):
                            taken = part.take(pa.array(rows[near]))
                            yield pa.RecordBatch.from_arrays([
                                pa.array(cells, pa.int32()), pa.array(np.full(len(near), target), pa.int32()), pa.array(np.full(len(near), role), pa.int32()),
                                taken.column("word"), taken.column("n"),
                            ], names=["cell", "length", "role", "word", "n"])

    return run


def one_replaced(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left != right).sum(axis=1) == 1


def one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether the longer word is the shorter one with a letter put in: a common beginning and a common end cover the shorter."""
    width = short.shape[1]
    head = np.cumprod(short == long[:, :width], axis=1, dtype=np.int8).sum(axis=1, dtype=np.int32)
    tail = np.cumprod((short == long[:, 1:])[:, ::-1], axis=1, dtype=np.int8).sum(axis=1, dtype=np.int32)
    return head + tail >= width


def near_rows(tree: Node, stored: np.ndarray, stored_letters: np.ndarray, vectors: np.ndarray, letters: np.ndarray, radius: int, same) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, stored) of all pairs one edit apart: range search by box, exact distance in the leaves, letters last."""
    for start in range(0, len(vectors), QUERIES_AT_ONCE):
        some = vectors[start : start + QUERIES_AT_ONCE]
        for leaf, rows in within(tree, some, radius):
            held = leaf.rows
            step = max(1, PAIRS_AT_ONCE // len(rows))
            for at in range(0, len(held), step):  # equal vectors may fill a leaf of any size
                block = held[at : at + step]
                width = max(1, PAIRS_AT_ONCE // len(block))
                for low in range(0, len(rows), width):
                    asked = rows[low : low + width]
                    apart = np.abs(some[asked][:, None, :] - stored[block][None, :, :]).sum(axis=2, dtype=np.int32)
                    i, j = np.nonzero(apart == radius)
                    i, j = start + asked[i], block[j]
                    good = same(letters[i], stored_letters[j])
                    if good.any():
                        yield i[good], j[good]


def search(group: pa.Table) -> Iterator[pa.RecordBatch]:
    """Pairs one edit apart, both ways round, with at least one word stored in the cell."""
    roles = group.column("role").to_numpy()
    words, counts = np.array(group.column("word").to_pylist(), object), group.column("n").to_numpy()
    held = np.flatnonzero(roles == STORED)
    if not len(held):
        return
    stored_letters = letter_matrix(words[held].tolist())
    stored = count_vectors(stored_letters)
    tree = local_tree(stored)
    kind = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])

    def told(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        left, right = np.r_[a, b], np.r_[b, a]
        return pa.RecordBatch.from_arrays([pa.array(words[left], pa.string()), pa.array(words[right], pa.string()), pa.array(counts[right], pa.int64())], schema=kind)

    for i, j in near_rows(tree, stored, stored_letters, stored, stored_letters, 2, one_replaced):
        once = i < j
        if once.any():
            yield told(held[i[once]], held[j[once]])
    for role, radius, same in ((SAME, 2, one_replaced), (SHORTER, 1, one_inserted)):
        asked = np.flatnonzero(roles == role)
        if len(asked):
            letters = letter_matrix(words[asked].tolist())
            vectors = count_vectors(letters).astype(stored.dtype)
            for i, j in near_rows(tree, stored, stored_letters, vectors, letters, radius, same):
                yield told(asked[i], held[j])


def search_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from search(pa.Table.from_batches(list(batches)))


def near_words(words: DataFrame, cell_words: int = CELL_WORDS) -> DataFrame:
    """(word, near, near_n): all ordered pairs of words that differ by one inserted, deleted or replaced letter.

    ``words`` is (word, n) with distinct words of Latin-1 letters; it should be staged, as it is read once per level of the tree.
    """
    trees = upper_trees(words, cell_words)
    routed = words.select("word", "n").mapInArrow(route(trees), ROUTED)
    return routed.groupBy("cell").applyInArrow(search_cell, PAIRS)


# --- forms -------------------------------------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the chain of forms from each word, by doubling the steps until none moves.

    A form occurs at least twice as often as its word, so chains are short and have no circles.
    """
    chain = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = chain.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = chain.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        moved = stage(moved, "roots")
        chain = moved.select("word", "root")
        if not moved.filter("moved").limit(1).count():
            return chain


def spelling_variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, margin: int = MARGIN, every: int = DAMAGE, cell_words: int = CELL_WORDS, id: str = "doc_id", text: str = "text") -> DataFrame:
    """word, n, form, form_n, n_near and root of every word of the corpus.

    A word's form is its near word with the largest n (ties: the least by code points) if that is at least ``margin``
    times its own; the root is where the chain of forms ends, the word itself without a form. ``every`` drops a letter
    from that share of the runs, as the contract of the query has it; ``margin`` is at least 2. Null and empty texts have no words, a
    null id counts as empty text, repeated rows count each, and an empty table gives no rows.
    """
    words = stage(counted_words(docs, min_length, min_count, every, id, text), "words")
    best = near_words(words, cell_words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    )
    best = best.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))
    joined = words.join(best, "word", "left")
    fits = F.col("near_n") >= margin * F.col("n")
    told = stage(joined.select(
        "word", "n", F.when(fits, F.col("near")).alias("form"), F.when(fits, F.col("near_n")).alias("form_n"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near")
    ), "forms")
    ends = roots(told.filter("form IS NOT NULL"))
    return told.join(ends, "word", "left").select("word", "n", "form", "form_n", "n_near", F.coalesce("root", "word").alias("root"))
