"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Statistics of a document's text are standardised and mapped to random cosine
features, whose inner products approximate a Gaussian kernel. Every task sums its
part of the normal equations; the sums are small and fixed in size, so they are
solved in one place. Scores of rows held back from the fit are calibrated by
pooling adjacent violators over a fixed number of bins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campusgrid.llm.common import written

FEATURES = 192
#: Width of the kernel over standardised statistics.
WIDTH = 4.0
RIDGE = 1.0
BINS = 2048
SEED = 20
THRESHOLD = 0.7

#: Function words of the four languages, told by frequency; a share of them marks prose.
STATISTICS = (
    "log_bytes", "log_words", "word_bytes", "long_words", "short_words", "upper", "digits", "punctuation",
    "symbols", "beyond_ascii", "blanks", "newlines", "line_words", "distinct_words", "distinct_top",
    "repeated_next", "bangs", "bars", "capital_words", "byte_entropy", "closed_lines", "symbol_words",
)


def _classes() -> np.ndarray:
    """Byte classes: 0 lower, 1 upper, 2 digit, 3 usual punctuation, 4 other symbol,
    5 beyond ASCII, 6 blank, 7 line end."""
    table = np.full(256, 4)
    table[97:123], table[65:91], table[48:58], table[128:] = 0, 1, 2, 5
    table[[ord(c) for c in ".,;:'\"?()-"]] = 3
    table[[9, 11, 12, 13, 32]] = 6
    table[10] = 7
    return table


_CLASS = _classes()


def statistics(text: bytes) -> list[float]:
    """The statistics of one text, finite for any bytes; zeros for an empty text."""
    data = np.frombuffer(text, dtype=np.uint8)
    n = len(data)
    if not n:
        return [0.0] * len(STATISTICS)
    each = np.bincount(data, minlength=256)
    lower, upper, digit, usual, other, beyond, blank, line_ends = np.bincount(_CLASS, each, 8) / n
    words = text.split()
    count = max(1, len(words))
    kinds: dict[bytes, int] = {}
    for word in words:
        kinds[word] = kinds.get(word, 0) + 1
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    share = each[each > 0] / n
    firsts = _CLASS[np.frombuffer(b"".join([w[:1] for w in words]), dtype=np.uint8)]
    lasts = _CLASS[np.frombuffer(b"".join([w[-1:] for w in words]), dtype=np.uint8)]
    lines = text.count(b"\n") + 1
    return [
        np.log1p(n),
        np.log1p(len(words)),
        min(40.0, lengths.sum() / count),
        (lengths > 12).sum() / count,
        (lengths <= 3).sum() / count,
        upper,
        digit,
        usual,
        other,
        beyond,
        blank,
        line_ends * 100,
        np.log1p(len(words) / lines),
        len(kinds) / count,
        max(kinds.values(), default=0) / count,
        sum(map(bytes.__eq__, words, words[1:])) / count,
        each[ord("!")] / count,
        each[ord("|")] / count,
        (firsts == 1).sum() / count,
        float(-(share * np.log2(share)).sum()),
        (text.count(b".\n") + text.endswith(b".")) / lines,
        (lasts == 4).sum() / count,
    ]


def document_statistics(docs: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """The `keep` columns and `stats`, of every whole text; null counts as empty."""
    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").cast("binary").alias("_text"))
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = [statistics(t.as_py() or b"") for t in batch.column(n)]
            own = [batch.column(i) for i in range(n)]
            yield pa.RecordBatch.from_arrays(
                own + [pa.array(stats, pa.list_(pa.float64()))], names=[*keep, "stats"]
            )

    stats = T.StructField("stats", T.ArrayType(T.DoubleType()))
    return source.mapInArrow(run, T.StructType([source.schema[c] for c in keep] + [stats]))


@dataclass
class QualityModel:
    """What scoring needs; its size doesn't depend on the data."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None = None
    edges: np.ndarray = field(default_factory=lambda: np.zeros(0))
    levels: np.ndarray = field(default_factory=lambda: np.ones(1))

    def features(self, stats: np.ndarray) -> np.ndarray:
        generator = np.random.default_rng(SEED)
        directions = generator.standard_normal((len(STATISTICS), FEATURES)) / WIDTH
        phases = generator.uniform(0, 2 * np.pi, FEATURES)
        standard = np.clip((stats - self.mean) / self.scale, -8, 8)
        waves = np.cos(standard @ directions + phases) * np.sqrt(2 / FEATURES)
        return np.hstack([waves, np.ones((len(stats), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        """From 0 to 1; steps of the calibration joined by straight lines."""
        if self.weights is None:
            return np.full(len(stats), self.levels[0])
        return np.clip(np.interp(self.raw(stats), self.edges, self.levels), 0.0, 1.0)


def _stacked(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), len(STATISTICS))


def pooled(counts: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Non-decreasing levels by pooling adjacent violators, each weighted by its count."""
    blocks: list[list[float]] = []
    for n, s in zip(counts, sums):
        blocks.append([n, s, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            n2, s2, k2 = blocks.pop()
            blocks[-1][0] += n2
            blocks[-1][1] += s2
            blocks[-1][2] += k2
    return np.concatenate([np.full(k, s / n) for n, s, k in blocks])


def fit(labelled: DataFrame) -> QualityModel:
    """From rows with `stats`, `label` (0 or 1) and `calibrate` (boolean).

    Rows to calibrate on are not fitted. Without rows, or with labels of one kind
    only, the score is the same for all: that label, or 1 when there are none.
    """
    labelled = labelled.filter(F.col("label").isin(0, 1))
    moments = [F.struct(F.avg(F.col("stats")[i]).alias("m"), F.stddev_pop(F.col("stats")[i]).alias("s")) for i in range(len(STATISTICS))]
    first = labelled.agg(
        F.count("*").alias("n"), F.avg("label").alias("p"), F.array(*moments).alias("moments")
    ).first()
    if not first["n"] or first["p"] in (0.0, 1.0):
        flat = np.ones(1) if not first["n"] else np.full(1, first["p"])
        width = len(STATISTICS)
        return QualityModel(np.zeros(width), np.ones(width), levels=flat)
    mean = np.array([x["m"] for x in first["moments"]])
    scale = np.array([x["s"] for x in first["moments"]])
    model = QualityModel(mean, np.where(scale > 1e-9, scale, 1.0))
    shared = labelled.sparkSession.sparkContext.broadcast(model.__dict__)

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total = QualityModel(**shared.value), None
        for batch in batches:
            z = own.features(_stacked(batch.column(0)))
            y = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
            part = z.T @ np.hstack([z, y[:, None]])
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total))), pa.array(list(total), pa.list_(pa.float64()))],
                names=["line", "sums"],
            )

    parts = labelled.filter(~F.col("calibrate")).select("stats", "label")
    lines = parts.mapInArrow(equations, "line bigint, sums array<double>")
    columns = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(FEATURES + 2)]
    summed = sorted(lines.groupBy("line").agg(*columns).collect())
    if not summed:
        model.levels = np.full(1, first["p"])
        return model
    matrix = np.array([list(row)[1:] for row in summed])
    ridge = RIDGE * np.eye(FEATURES + 1)
    ridge[-1, -1] = 1e-6
    model.weights = np.linalg.solve(matrix[:, :-1] + ridge, matrix[:, -1])
    shared_fit = labelled.sparkSession.sparkContext.broadcast(model.__dict__)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = QualityModel(**shared_fit.value)
        for batch in batches:
            raw = np.clip(own.raw(_stacked(batch.column(0))), -0.5, 1.5)
            bins = np.floor((raw + 0.5) / 2 * (BINS - 1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column(1)], names=["bin", "label"])

    held = labelled.filter("calibrate").select("stats", F.col("label").cast("bigint"))
    counts = (
        held.mapInArrow(binned, "bin bigint, label bigint")
        .groupBy("bin")
        .agg(F.count("*").alias("n"), F.sum("label").alias("s"))
        .orderBy("bin")
        .collect()
    )
    if not counts:
        model.edges, model.levels = np.array([0.0, 1.0]), np.array([0.0, 1.0])
        return model
    model.edges = np.array([(row["bin"] + 0.5) / (BINS - 1) * 2 - 0.5 for row in counts])
    model.levels = pooled(np.array([r["n"] for r in counts]), np.array([r["s"] for r in counts]))
    return model


def score(scored: DataFrame, model: QualityModel, keep: tuple[str, ...]) -> DataFrame:
    """The `keep` columns and `score` of rows with `stats`."""
    shared = scored.sparkSession.sparkContext.broadcast(model.__dict__)
    source = scored.select(*keep, "stats")
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = QualityModel(**shared.value)
        for batch in batches:
            found = own.score(_stacked(batch.column(n)))
            columns = [batch.column(i) for i in range(n)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found)], names=[*keep, "score"])

    fields = [source.schema[c] for c in keep] + [T.StructField("score", T.DoubleType())]
    return source.mapInArrow(run, T.StructType(fields))


def score_texts(docs: DataFrame, model: QualityModel, output: str = "score", column: str = "text") -> DataFrame:
    """All columns and the score of every whole text; null counts as empty.

    Statistics and score are made in one step, and only the text goes to Python: a task
    holds one worker and one copy of a batch of texts, whatever the other columns hold.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model.__dict__)

    @F.arrow_udf(T.DoubleType())
    def scored(texts: pa.Array) -> pa.Array:
        stats = np.array([statistics(t.as_py() or b"") for t in texts], dtype=float)
        return pa.array(QualityModel(**shared.value).score(stats.reshape(-1, len(STATISTICS))), pa.float64())

    return docs.withColumn(output, scored(F.col(f"`{column}`").cast("binary")))


def train(docs: DataFrame, labels: DataFrame, fold: str = "fold", calibration_fold: int = 3) -> QualityModel:
    """Fits on the labelled rows of `docs` (doc_id, text, and the fold column: 2 is held
    out, `calibration_fold` calibrates). A document with several labels counts once per
    label; null labels and null ids don't count."""
    known = labels.select(F.col("doc_id").alias("_id"), F.col("quality").alias("label")).filter("label IS NOT NULL")
    rows = document_statistics(docs.filter(F.col(fold) != 2), ("doc_id", fold))
    labelled = rows.join(known, F.col("doc_id") == F.col("_id")).select(
        "stats", "label", (F.col(fold) == calibration_fold).alias("calibrate")
    )
    return fit(written(labelled))  # read three times
