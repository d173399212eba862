"""Quality rules: plain limits, and a likelihood ratio of hashed n-grams.

Words and pairs of neighbouring words fall into a fixed number of buckets. Their shares
among trusted documents and in the whole corpus are two multinomials; a text's score is
the mean logarithm of the ratio of the two over its n-grams, so long texts and short
ones are judged alike. Logarithms are whole multiples of 2**-20 and summed as whole
numbers: a score doesn't depend on partitions, batches or the order of tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campusgrid.llm.hashing import BLANK_SEPARATED, Words, byte_table, chunks, mixed

#: Buckets that n-grams fall into; the model has one number for each.
BUCKETS = 1 << 16
#: Trusted documents the target is learned from at most: those of the smallest hashes of
#: their ids. The corpus is counted whole.
TRUSTED_DOCUMENTS = 50_000
#: Occurrences per bucket, shared out as the corpus has them, that the target is given beforehand.
PRIOR = 1.0
#: Least score of a document that is kept. 0 means: as likely in either. Trusted documents
#: lie near 0, a little above; n-grams that they lack pull a text far below.
THRESHOLD = -0.12
#: Limits of the plain rules: fewest words, largest share of repeated words in hundredths.
MIN_WORDS = 10
MAX_REPEATED = 20

_WINDOW = 5
_UNIT = 1 << 20
_LINES = byte_table(bytes(b for b in range(256) if b != 10))
_SYMBOLS = byte_table(b"#*$%&|<>")
_NGRAM = (np.uint64(0x9FB21C651E98DF25), np.uint64(0xD1B54A32D192ED03))

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per_text(each: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of a whole number per word over the words of each text."""
    sums = np.zeros(len(each) + 1, dtype=np.int64)
    np.cumsum(each, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]


def _within(flags: np.ndarray, words: Words) -> np.ndarray:
    """How many bytes with a flag each word has."""
    sums = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[words.ends] - sums[words.starts]


def _again(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values their text holds more than once, and which it holds earlier."""
    keys = mixed(hashes ^ mixed(owner.astype(np.uint64) + np.uint64(1)))
    _, first, kind, count = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    return count[kind] > 1, first[kind] != np.arange(len(keys))


def plain_counts(words: Words, lines: Words) -> dict[str, np.ndarray]:
    """The counts of the plain rules for the texts of a chunk."""
    lead = (words.data & 0xC0) != 0x80
    found, inside = words.windows(_WINDOW)
    starts = np.flatnonzero(inside)
    several, _ = _again(words.owner[starts], found[starts])
    steps = np.zeros(len(words.hashes) + 1, dtype=np.int64)
    steps[starts[several]] += 1
    steps[starts[several] + _WINDOW] -= 1
    filled = _within(BLANK_SEPARATED[lines.data], lines) > 0
    later = np.zeros(len(lines.hashes), dtype=bool)
    later[filled] = _again(lines.owner[filled], lines.hashes[filled])[1]
    return {
        "n_words": np.diff(words.first),
        "word_chars": _per_text(_within(lead, words), words.first),
        "n_symbols": _per_text(_within(_SYMBOLS[words.data], words), words.first),
        "n_dup_lines": _per_text(later, lines.first),
        "n_repeat_words": _per_text(np.cumsum(steps)[:-1] > 0, words.first),
    }


def _buckets(words: Words, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place of the first word, bucket) of the single words, then of the pairs."""
    yield np.arange(len(words.hashes)), (mixed(words.hashes ^ _NGRAM[0]) % np.uint64(buckets)).astype(np.int64)
    found, inside = words.windows(2)
    yield np.flatnonzero(inside), (mixed(found[inside] ^ _NGRAM[1]) % np.uint64(buckets)).astype(np.int64)


@dataclass
class NgramRatio:
    """Logarithm of the ratio per bucket, in multiples of 2**-20."""

    units: np.ndarray

    def scores(self, words: Words) -> np.ndarray:
        total = np.zeros(len(words.first) - 1, dtype=np.int64)
        count = np.zeros(len(words.first) - 1, dtype=np.int64)
        for places, found in _buckets(words, len(self.units)):
            each = np.zeros(len(words.hashes), dtype=np.int64)
            each[places] = self.units[found]
            total += _per_text(each, words.first)
            each[places] = 1
            count += _per_text(each, words.first)
        return total / _UNIT / np.maximum(count, 1)


def ratio(target: np.ndarray, corpus: np.ndarray, prior: float = PRIOR) -> NgramRatio:
    """From n-grams per bucket. The target is drawn towards the corpus by `prior`
    occurrences per bucket. Without trusted n-grams all ratios are 1."""
    share = (corpus + 1) / (corpus.sum() + len(corpus))
    pulled = (target + prior * len(corpus) * share) / (target.sum() + prior * len(corpus))
    return NgramRatio(np.rint(np.log(pulled / share) * _UNIT).astype(np.int64))


def train(
    docs: DataFrame,
    trusted: DataFrame,
    buckets: int = BUCKETS,
    most: int = TRUSTED_DOCUMENTS,
) -> NgramRatio:
    """Counts all texts of `docs` (doc_id, text), and those whose id is in `trusted`
    (doc_id) once more.

    Tasks sum up buckets before anything is shuffled. Null texts have no n-grams; null
    ids are never trusted; a repeated row counts each time, a repeated trusted id once.
    Empty tables give ratios of 1. The ids broadcast are `most`, 8 bytes each, at most.
    """
    ids = trusted.select(F.col("doc_id").cast("bigint").alias("id")).filter("id IS NOT NULL").distinct()
    ids = ids.orderBy(F.xxhash64("id"), "id").limit(most).toArrow().column(0).to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(np.sort(ids.astype(np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, buckets), dtype=np.int64)
        for batch in batches:
            known = pc.fill_null(batch.column(0), 0).to_numpy(zero_copy_only=False)
            held = np.isin(known, shared.value) & batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            for begin, words in chunks(batch.column(1), False, BLANK_SEPARATED):
                own = held[begin : begin + len(words.first) - 1][words.owner]
                for places, found in _buckets(words, buckets):
                    sums[0] += np.bincount(found, minlength=buckets)
                    sums[1] += np.bincount(found[own[places]], minlength=buckets)
        some = np.flatnonzero(sums[0])
        columns = [pa.array(c) for c in (some, sums[0][some], sums[1][some])]
        yield pa.RecordBatch.from_arrays(columns, names=["bucket", "corpus", "target"])

    source = docs.select(F.col("doc_id").cast("bigint"), "text")
    parts = source.mapInArrow(run, "bucket bigint, corpus bigint, target bigint")
    summed = parts.groupBy("bucket").agg(F.sum("corpus").alias("corpus"), F.sum("target").alias("target")).toArrow()
    totals = np.zeros((2, buckets), dtype=np.float64)
    for line, name in zip(totals, ("corpus", "target")):
        line[summed.column("bucket").to_numpy()] = summed.column(name).to_numpy()
    return ratio(totals[1], totals[0])


def judge(docs: DataFrame, model: NgramRatio, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, the counts of the plain rules, base_failed, score, kept) of every row.

    Texts are judged whole; null and empty ones have no words and fail. Lines without a
    word are never repeated ones. A score of exactly the threshold is kept. Rows are
    independent: repeated rows, null ids and other columns, whatever their names, change
    nothing, and an empty table gives an empty one. Nothing is shuffled; the model, 8
    bytes a bucket, is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model.units)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = NgramRatio(shared.value)
        for batch in batches:
            parts: dict[str, list[np.ndarray]] = {name: [] for name in (*COUNTS, "score")}
            both = zip(chunks(batch.column(1), False, BLANK_SEPARATED), chunks(batch.column(1), False, _LINES))
            for (_, words), (_, lines) in both:
                for name, counts in plain_counts(words, lines).items():
                    parts[name].append(counts)
                parts["score"].append(own.scores(words))
            found = {name: np.concatenate(p) if p else np.zeros(0, dtype=np.int64) for name, p in parts.items()}
            failed = (found["n_words"] < MIN_WORDS) | (100 * found["n_repeat_words"] > MAX_REPEATED * found["n_words"])
            columns = [pa.array(found[name], pa.int64()) for name in COUNTS]
            columns += [pa.array(failed), pa.array(found["score"], pa.float64()), pa.array(~failed & (found["score"] >= threshold))]
            names = ["doc_id", *COUNTS, "base_failed", "score", "kept"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    source = docs.select("doc_id", "text")
    made = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    made = T.StructType.fromDDL(made + "base_failed boolean, score double, kept boolean")
    return source.mapInArrow(run, T.StructType([source.schema["doc_id"], *made.fields]))


def keep(docs: DataFrame, model: NgramRatio, threshold: float = THRESHOLD) -> DataFrame:
    """The kept documents with all their columns, whatever their names; as `judge` has it."""
    renamed = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    places = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    marked = renamed.select(F.struct(*renamed.columns).alias("doc_id"), F.col(places["text"]).alias("text"))
    kept = judge(marked, model, threshold).filter("kept")
    return kept.select(*[F.col(f"doc_id.{place}").alias(c) for c, place in places.items()])
