"""Quality scores: random Fourier features of document statistics, ridge regression, isotonic calibration.

The statistics of a text are a handful of ratios; cosines of random projections of them
approximate a Gaussian kernel. Every partition sums its own normal equations, the sums
are added up row by row, and one small system is solved. The raw score is then made a
probability by an isotonic fit on labelled rows that the regression has not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.llm.common import as_bytes, fold, pick, plain_names, text_slices
from wordloom.session import stage

#: Classes of bytes whose share is a statistic; what is in none counts as other.
BYTE_CLASSES = (
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b".", b",", b"!", b"?", b"#", b"$", b"%", b"&",
    b"*", b"|", b"<>{}[]()=+/\\_~^`", b"\"':;-@", bytes(range(0x80, 0x100)),
)
N_STATS = len(BYTE_CLASSES) + 1 + 10
N_FEATURES = 256
SALTS = 32
BINS = 1000


def byte_table() -> np.ndarray:
    table = np.full(256, len(BYTE_CLASSES), np.int64)
    for k, members in enumerate(BYTE_CLASSES):
        table[list(members)] = k
    return table


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of ratios per text; all zero for an empty one."""
    out = np.zeros((len(texts), N_STATS))
    lengths = np.array([len(t) for t in texts], np.int64)
    flat = np.frombuffer(b"".join(texts), np.uint8)
    width = len(BYTE_CLASSES) + 1
    owner = np.repeat(np.arange(len(texts)) * width, lengths)
    shares = np.bincount(owner + byte_table()[flat], minlength=width * len(texts)).reshape(-1, width)
    out[:, :width] = shares / np.maximum(lengths, 1)[:, None]
    same = np.r_[False, flat[1:] == flat[:-1]] if len(flat) else np.zeros(0, bool)
    out[:, width] = np.bincount(owner // width, weights=same, minlength=len(texts)) / np.maximum(lengths, 1)
    out[:, width + 1] = np.log1p(lengths)
    for row, text in enumerate(texts):
        words = text.split()
        if not words:
            continue
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        lines = [x for x in text.split(b"\n") if x]
        out[row, width + 2 :] = (
            np.log1p(len(words)), sizes.mean(), sizes.std(), (sizes <= 3).mean(), len(set(words)) / len(words),
            len(set(lines)) / max(1, len(lines)), np.log1p(len(text) / max(1, len(lines))),
            sum(map(eq, words[1:], words)) / len(words),
        )
    return out


def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with the text replaced by its statistics."""
    for chunk in text_slices(batches, "text"):
        stats = statistics(as_bytes(chunk.column("text")))
        others = [n for n in chunk.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays(
            [*(chunk.column(n) for n in others), pa.array(list(stats), pa.list_(pa.float64()))], names=[*others, "stats"]
        )


class Fourier:
    """Random features that approximate a Gaussian kernel on standardised statistics."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, features: int = N_FEATURES, width: float = 4.0, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.mean, self.spread = mean, np.where(spread > 1e-9, spread, 1.0)
        self.waves = rng.normal(0, 1 / width, (len(mean), features))
        self.phases = rng.uniform(0, 2 * np.pi, features)

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.spread, -6, 6)
        waves = np.sqrt(2 / len(self.phases)) * np.cos(z @ self.waves + self.phases)
        return np.hstack([np.ones((len(stats), 1)), waves])


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("stats")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def partition_sums(fourier: Fourier):
    """Rows (row number, that row of Z'Z with Z'y at its end) of the partition's normal equations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, salt = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            z = fourier(matrix(batch))
            y = batch.column("y").to_numpy(zero_copy_only=False)
            part = z.T @ np.hstack([z, y[:, None]])
            total = part if total is None else total + part
            salt = (salt * 31 + batch.num_rows + int(y.sum())) % SALTS
        if total is not None:
            n = len(total)
            yield pa.RecordBatch.from_pydict({
                "row": pa.array(np.arange(n, dtype=np.int32)), "salt": pa.array(np.full(n, salt, np.int32)),
                "sums": pa.array(list(total), pa.list_(pa.float64())),
            })

    return run


def add_rows(table: pa.Table) -> pa.Table:
    """One row for all of a group; adds their sums."""
    flat = table.column("sums").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
    return table.slice(0, 1).select(["row", "salt"]).append_column("sums", pa.array([flat.sum(axis=0)], pa.list_(pa.float64())))


def solve(examples: DataFrame, fourier: Fourier, ridge: float) -> np.ndarray:
    """Ridge weights from rows of stats and y; what comes to the driver is one small matrix."""
    schema = "row int, salt int, sums array<double>"
    sums = examples.select("stats", "y").mapInArrow(partition_sums(fourier), schema)
    sums = sums.groupBy("row", "salt").applyInArrow(add_rows, schema).groupBy("row").applyInArrow(add_rows, schema)
    rows = sorted(sums.collect(), key=lambda r: r.row)
    if not rows:
        return np.zeros(len(fourier.phases) + 1)
    whole = np.array([r.sums for r in rows])
    return np.linalg.solve(whole[:, :-1] + ridge * np.eye(len(whole)), whole[:, -1])


def pool_adjacent(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression of y on ascending x with weights n: block centres and their rising values."""
    blocks: list[list[float]] = []
    for a, b, w in zip(x.tolist(), y.tolist(), n.tolist(), strict=True):
        blocks.append([a * w, b * w, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last, strict=True)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


class QualityModel:
    """Statistics to a calibrated probability of label 1."""

    def __init__(self, fourier: Fourier, weights: np.ndarray, x: np.ndarray, y: np.ndarray):
        self.fourier, self.weights, self.x, self.y = fourier, weights, x, y

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        if not len(self.x):
            return np.full(len(stats), 0.5)
        return np.clip(np.interp(self.fourier(stats) @ self.weights, self.x, self.y), 0, 1)


def raw_scores(fourier: Fourier, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(fourier(matrix(batch)) @ weights), batch.column("y")], names=["raw", "y"])

    return run


def train_quality(described: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, calibration: int = 4, ridge: float = 0.3, id: str = "doc_id", label: str = "quality") -> QualityModel:
    """Fits on all labelled rows (label 0 or 1) whose crc32(id) modulo ``folds`` is not ``held_out``.

    Fold ``calibration`` fits the isotonic step, the others the regression; if either has no rows, both use all.
    ``described`` has id and stats. Rows without an id or a label teach nothing; repeated labels count each.
    Without labels the model says one half.
    """
    marks = pick(labels, id, label).toDF("id", "y").filter("y in (0, 1)").select("id", F.col("y").cast("double").alias("y"))
    examples = stage(
        described.join(marks, "id").withColumn("fold", fold(F.col("id"), folds)).filter(F.col("fold") != held_out), "quality_examples"
    )
    at = [F.col("stats")[k] for k in range(N_STATS)]
    facts = examples.agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("fold") == calibration).cast("long")).alias("last"),
        F.array(*map(F.avg, at)).alias("mean"), F.array(*map(F.stddev_pop, at)).alias("spread"),
    ).first()
    if not facts.n:
        return QualityModel(Fourier(np.zeros(N_STATS), np.ones(N_STATS)), np.zeros(N_FEATURES + 1), np.zeros(0), np.zeros(0))
    fourier = Fourier(np.array(facts["mean"]), np.array(facts["spread"]))
    apart = 0 < facts.last < facts.n
    weights = solve(examples.filter(F.col("fold") != calibration) if apart else examples, fourier, ridge)
    unseen = (examples.filter(F.col("fold") == calibration) if apart else examples).select("stats", "y")
    raw = unseen.mapInArrow(raw_scores(fourier, weights), "raw double, y double")
    binned = raw.groupBy(F.floor(F.least(F.greatest("raw", F.lit(-1.0)), F.lit(2.0)) * BINS).alias("bin")).agg(
        F.avg("raw").alias("x"), F.avg("y").alias("y"), F.count(F.lit(1)).alias("n")
    ).orderBy("bin").toPandas()  # 3 * BINS + 1 rows at most
    return QualityModel(fourier, weights, *pool_adjacent(*(binned[c].to_numpy(float) for c in ("x", "y", "n"))))


def score_stats(model: QualityModel, cut: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                score = model(matrix(batch))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("held_out"), pa.array(score), pa.array((score >= cut).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"],
                )

    return run


def score_texts(model: QualityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_slices(batches, "text"):
            score = model(statistics(as_bytes(chunk.column("text"))))
            kept = [chunk.column(k) for k in range(chunk.num_columns)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(score)], names=[*chunk.schema.names, "score"])

    return run


def describe_texts(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, stats) of every row, written once."""
    rows = pick(docs, id, text).toDF("id", "text")
    kind = rows.schema["id"].dataType.simpleString()
    return stage(rows.mapInArrow(describe, f"id {kind}, stats array<double>"), "quality_stats")


def quality_scores(docs: DataFrame, labels: DataFrame, cut: float = 0.3, folds: int = 5, held_out: int = 0) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 if the score reaches ``cut``) of every row.

    Only the text is an input of a score. Null and empty texts have all-zero statistics and the score of these;
    repeated rows and null ids are scored like others; an empty table gives no rows.
    """
    described = describe_texts(docs)
    model = train_quality(described, labels, folds, held_out)
    kind = described.schema["id"].dataType.simpleString()
    return described.withColumn("held_out", fold(F.col("id"), folds) == held_out).mapInArrow(
        score_stats(model, cut), f"doc_id {kind}, held_out boolean, score double, predicted int"
    )


def keep_good(docs: DataFrame, labels: DataFrame, cut: float = 0.3, text: str = "text") -> DataFrame:
    """The rows, unchanged, whose score reaches ``cut``."""
    model = train_quality(describe_texts(docs), labels)
    plain = plain_names(docs, text=text)
    scored = plain.mapInArrow(score_texts(model), T.StructType([*plain.schema, T.StructField("score", T.DoubleType())]))
    return scored.filter(F.col("score") >= cut).select(*plain.columns).toDF(*docs.columns)
