"""Language-model scores of documents by context-tree weighting.

How the model meets the texts without being broadcast: documents are handled in
blocks (one split of the input each). A block lists its distinct byte n-grams and
words once, packed by bucket; the buckets gather the training counts over all blocks,
build their part of the context trees, and answer each block with the probability of
each n-gram and the count of each word. Then block and answers meet for the scores.
What moves is the blocks' distinct n-grams and words, never one row per position.
An n-gram's bucket follows from its two nearest context bytes, so that a whole subtree
lies in one bucket; the two levels above have at most 257 x 255 nodes by construction
and are the only part that goes through the driver.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm import ctw
from wordloom.llm.common import as_bytes, fold, pack, pack_sorted, pick, text_slices, unpack, unpack_sorted
from wordloom.session import stage

DEPTH = 5
BLOCK_BYTES = 16 << 20
SALT_BLOCKS = 64
END = b"\n"


def normal(text: bytes) -> tuple[bytes, list[bytes]]:
    """The modelled bytes of a text (lower-cased words, a space after each, an end byte) and its words."""
    words = text.lower().split()
    return b" ".join([*words, END]), words


def word_keys(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) >> 1 for w in words), np.int64, len(words))


def placed_ngrams(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram of every byte of the texts, each text after ``depth`` end bytes, and the texts' lengths."""
    joined = (END * depth).join([b"", *texts])
    lengths = np.array([len(t) for t in texts])
    codes = ctw.ngrams(np.frombuffer(joined, np.uint8), depth)
    ends = np.cumsum(lengths + depth) - depth
    mask = np.ones(len(codes) + depth, bool)
    for shift in range(depth):
        mask[ends + shift] = False
    return codes[mask[: len(codes)]], lengths


def bucket_of(kind: str, keys: np.ndarray, depth: int, buckets: int) -> np.ndarray:
    group = (keys >> (8 * (depth - 1))) if kind == "g" else keys >> 20
    return ((group * 0x9E3779B1) & 0x7FFFFFFF) % buckets


def merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return ctw.sum_by(np.concatenate(keys), np.concatenate(counts))


class Distinct:
    """Distinct keys with training counts, merged now and then as chunks come in."""

    def __init__(self):
        self.keys, self.counts, self.loose, self.size = [], [], 0, 0

    def add(self, keys, counts):
        self.keys.append(keys)
        self.counts.append(counts)
        self.loose += len(keys)
        if self.loose > max(1 << 20, self.size):
            self.close()

    def close(self):
        if self.keys:
            keys, counts = merge(self.keys, self.counts)
            self.keys, self.counts, self.size, self.loose = [keys], [counts], len(keys), 0
        return (self.keys[0], self.counts[0]) if self.keys else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def with_block(docs: DataFrame, block_bytes: int) -> DataFrame:
    """Each row's block: the split of the file that it comes from, cut by a hash if splits are larger than a block.

    The frame must be read from files. Rows that come from no file are dealt to 64 blocks by id.
    """
    split = docs.sparkSession.conf.get("spark.sql.files.maxPartitionBytes", "128m")
    size = int(docs.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(split))
    cuts = max(1, -(-size // block_bytes))
    known = F.input_file_name() != ""
    place = F.xxhash64(F.input_file_name(), F.input_file_block_start())
    share = F.pmod(F.xxhash64("id"), F.when(known, cuts).otherwise(64))
    return docs.withColumn("block", F.xxhash64(place, share))


PART = "block long, kind string, bucket int, keys binary, counts binary"


def list_parts(depth: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[Distinct, Distinct]] = {}
        for chunk in text_slices(batches, "text"):
            blocks = chunk.column("block").to_numpy()
            trains = chunk.column("train").to_numpy(zero_copy_only=False).astype(bool)
            texts = [normal(t) for t in as_bytes(chunk.column("text"))]
            for block in np.unique(blocks):
                grams, words = found.setdefault(int(block), (Distinct(), Distinct()))
                own = np.flatnonzero(blocks == block)
                codes, lengths = placed_ngrams([texts[i][0] for i in own], depth)
                marked = np.sort((codes << 1) | np.repeat(trains[own], lengths))
                starts = np.flatnonzero(np.r_[True, marked[1:] != marked[:-1]])
                times = np.diff(np.r_[starts, len(marked)])
                grams.add(marked[starts] >> 1, times * (marked[starts] & 1))
                counted = Counter()
                for i in own:
                    if trains[i]:
                        counted.update(texts[i][1])
                for i in own:
                    if not trains[i]:
                        counted.update(dict.fromkeys(texts[i][1], 0))
                words.add(word_keys(list(counted)), np.fromiter(counted.values(), np.int64, len(counted)))
        for block, pair in found.items():
            for kind, distinct in zip("gw", pair, strict=True):
                keys, counts = distinct.close()
                places = bucket_of(kind, keys, depth, buckets)
                for bucket in np.unique(places):
                    own = places == bucket
                    yield pa.RecordBatch.from_pydict({
                        "block": pa.array([block], pa.int64()), "kind": [kind], "bucket": pa.array([bucket], pa.int32()),
                        "keys": [pack_sorted(keys[own])], "counts": [pack(counts[own])],
                    })

    return run


def merge_group(table: pa.Table) -> pa.Table:
    """One row with the summed counts of all rows of a bucket; keys never seen in training go."""
    keys, counts = merge(
        [unpack_sorted(x) for x in table.column("keys").to_pylist()],
        [unpack(x, np.int64) for x in table.column("counts").to_pylist()],
    )
    seen = counts > 0
    return pa.table({
        "kind": table.column("kind").slice(0, 1), "bucket": table.column("bucket").slice(0, 1),
        "keys": [pack_sorted(keys[seen])], "counts": [pack(counts[seen])],
        "total": [int(counts.sum())], "distinct": [int(seen.sum())],
    })


MODEL = "kind string, bucket int, keys binary, counts binary, total long, distinct long"


def deep_levels(row_keys: bytes, row_counts: bytes, depth: int) -> dict[int, ctw.Level]:
    return ctw.levels(unpack_sorted(row_keys), unpack(row_counts, np.int64).astype(float), depth, 2)


def second_level(depth: int):
    """Per bucket, the sums over depth-two nodes that a depth-one node needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(batch.column("keys").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                level = deep_levels(keys, counts, depth)[2]
                for bit, (node, zeros, ones, weighted, _) in enumerate(level.nodes):
                    parent = ((node >> (8 + bit)) << bit) | (node & ((1 << bit) - 1))
                    parent, zeros, ones, weighted = ctw.sum_by(parent, zeros, ones, weighted)
                    yield pa.RecordBatch.from_pydict({
                        "bit": pa.array(np.full(len(parent), bit, np.int32)), "node": parent,
                        "zeros": zeros, "ones": ones, "weighted": weighted,
                    })

    return run


class Shallow(ctw.Level):
    """A level given by its node values."""

    def __init__(self, nodes):
        self.nodes = nodes


def top_levels(sums: pd.DataFrame) -> dict[int, ctw.Level]:
    """Depths one and zero from at most 256 x 255 summed nodes."""
    first, root = [], []
    for bit in range(8):
        own = sums[sums["bit"] == bit].sort_values("node")
        node = ctw.node_values(*(own[c].to_numpy() for c in ("node", "zeros", "ones", "weighted")))
        first.append(node)
        keys, zeros, ones, weighted = ctw.sum_by(node[0] & ((1 << bit) - 1), node[1], node[2], node[3])
        root.append(ctw.node_values(keys, zeros, ones, weighted))
    return {1: Shallow(first), 0: Shallow(root)}


ANSWER = "block long, kind string, keys binary, answer binary"


def answer_group(depth: int, shallow: dict[int, ctw.Level]):
    """For every block's list of a bucket: ln probability of each n-gram, or training count of each word."""

    def run(lists: pa.Table, model: pa.Table) -> pa.Table:
        if not lists.num_rows:
            return pa.table({"block": pa.array([], pa.int64()), "kind": pa.array([], pa.string()), "keys": pa.array([], pa.binary()), "answer": pa.array([], pa.binary())})
        kind = lists.column("kind")[0].as_py()
        wanted = [unpack_sorted(x) for x in lists.column("keys").to_pylist()]
        distinct = np.unique(np.concatenate(wanted))
        row = model.to_pylist()[0]
        if kind == "g":
            values = ctw.predict(distinct, depth, deep_levels(row["keys"], row["counts"], depth) | shallow)
        else:
            keys, counts = unpack_sorted(row["keys"]), unpack(row["counts"], np.int64)
            values = np.zeros(len(distinct))
            if len(keys):
                at = np.minimum(np.searchsorted(keys, distinct), len(keys) - 1)
                values = np.where(keys[at] == distinct, counts[at], 0).astype(float)
        return pa.table({
            "block": lists.column("block"), "kind": lists.column("kind"), "keys": lists.column("keys"),
            "answer": [pack(values[np.searchsorted(distinct, w)]) for w in wanted],
        })

    return run


def gathered(answers: pa.Table, kind: str) -> tuple[np.ndarray, np.ndarray]:
    own = [(unpack_sorted(k), unpack(v, float)) for k, v, t in zip(*(answers.column(c).to_pylist() for c in ("keys", "answer", "kind")), strict=True) if t == kind]
    if not own:
        return np.zeros(0, np.int64), np.zeros(0)
    keys = np.concatenate([k for k, _ in own])
    order = np.argsort(keys)
    return keys[order], np.concatenate([v for _, v in own])[order]


def score_block(depth: int, ends: int, total: int, distinct: int):
    floor = math.log10(total + 0.5 * (distinct + 1))

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        codes_known, logs = gathered(answers, "g")
        word_known, times = gathered(answers, "w")
        out = {name: [] for name in ("id", "train", "n_tokens", "n_known", "base_score", "score", "n_bytes")}
        for chunk in text_slices(docs.to_batches(), "text"):
            texts = [normal(t) for t in as_bytes(chunk.column("text"))]
            codes, lengths = placed_ngrams([t for t, _ in texts], depth)
            value = logs[np.searchsorted(codes_known, codes)]
            out["score"] += (np.add.reduceat(value, np.cumsum(lengths) - lengths) / math.log(10)).tolist()
            vocabulary = list(set().union(*(words for _, words in texts)))
            count = times[np.searchsorted(word_known, word_keys(vocabulary))] if vocabulary else np.zeros(0)
            logged = dict(zip(vocabulary, np.log10(count + 0.5).tolist(), strict=True))
            new = {w for w, c in zip(vocabulary, count.tolist(), strict=True) if c == 0}
            for _, words in texts:
                n = len(words) + 1
                out["n_tokens"].append(n)
                out["n_known"].append(n - (ends == 0) - (sum(map(new.__contains__, words)) if new else 0))
                out["base_score"].append(math.fsum(map(logged.__getitem__, words)) + math.log10(ends + 0.5) - n * floor)
            out["n_bytes"] += lengths.tolist()
            out["id"] += chunk.column("id").to_pylist()
            out["train"] += chunk.column("train").to_pylist()
        kinds = {"id": docs.schema.field("id").type, "train": pa.bool_(), "base_score": pa.float64(), "score": pa.float64()}
        return pa.table({name: pa.array(v, kinds.get(name, pa.int64())) for name, v in out.items()})

    return run


def ctw_scores(
    docs: DataFrame, id: str = "doc_id", text: str = "text", folds: int = 5, held_out: int = 1,
    depth: int = DEPTH, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """log10 probability of every text by context-tree weighting, beside a word-unigram base score.

    ``docs`` is read from files. The model learns from the rows whose crc32(id) modulo ``folds`` is not
    ``held_out`` and scores all. Lower-case A-Z; words are runs of bytes other than space and 0x09-0x0D; the
    modelled bytes are each word and a space, then one end byte. ``depth`` (2 to 6) is the longest context in bytes.
    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte.

    Null and empty texts count as one end token; a null id as empty text in the fold; repeated rows are scored
    (and learned) each; with no training rows every bit has probability one half; an empty table gives no rows.
    Words are counted by a 63-bit hash.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = with_block(pick(docs, id, text).toDF("id", "text"), block_bytes)
    rows = rows.select("id", "text", "block", (fold(F.col("id"), folds) != held_out).alias("train"))
    salt = F.pmod(F.xxhash64("block"), F.lit(1 << 30)).cast("int")
    parts = stage(rows.drop("id").mapInArrow(list_parts(depth, buckets), PART), "ctw_parts")
    facts = parts.agg(F.approx_count_distinct("block").alias("blocks")).first()
    salts = max(1, -(-facts.blocks // SALT_BLOCKS))
    parts = parts.withColumn("salt", salt % salts)
    part = parts.select("kind", "bucket", "salt", "keys", "counts").groupBy("kind", "bucket", "salt").applyInArrow(merge_group, MODEL)
    model = stage(part.groupBy("kind", "bucket").applyInArrow(merge_group, MODEL), "ctw_model")
    sums = (
        model.filter("kind = 'g' and distinct > 0").select("keys", "counts")
        .mapInArrow(second_level(depth), "bit int, node long, zeros double, ones double, weighted double")
        .groupBy("bit", "node").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "weighted")])
    )
    shallow = top_levels(sums.toPandas())
    totals = model.filter("kind = 'w'").agg(F.sum("total").alias("n"), F.sum("distinct").alias("v")).first()
    ends = rows.filter("train").count()
    total, distinct = (totals.n or 0) + ends, (totals.v or 0) + (ends > 0)
    spread = model.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    keys = ["kind", "bucket", "salt"]
    answers = (
        parts.groupBy(*keys).cogroup(spread.groupBy(*keys))
        .applyInArrow(answer_group(depth, shallow), ANSWER)
    )
    scored = rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        score_block(depth, ends, total, distinct),
        f"id {rows.schema['id'].dataType.simpleString()}, train boolean, n_tokens long, n_known long, base_score double, score double, n_bytes long",
    )
    return scored.select(
        F.col("id").alias("doc_id"), (~F.col("train")).alias("held_out"), "n_tokens", "n_known",
        F.lit(total).cast("long").alias("train_tokens"), "base_score", "score", "n_bytes",
        (-F.col("score") * math.log2(10) / F.col("n_bytes")).alias("bits_per_byte"),
    )
