"""Language of a text: known words first, then shorter and shorter character n-grams.

A word the model knows is scored by its log frequency in each language. An unseen
word is scored by the longest character n-grams the model knows for it. The model
keeps the most frequent words and n-grams of each language, a documented number,
counted over a documented sample of labelled documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campusgrid.llm.common import written

#: Labelled documents to learn from, in expectation; chosen by a hash of text and language.
SAMPLE_DOCUMENTS = 20_000
#: Words, and n-grams of each length, kept per language at most; and languages. Entries of
#: equal count are kept together or not at all.
WORDS_KEPT = 20_000
GRAMS_KEPT = 5_000
LANGUAGES_KEPT = 200
LONGEST_GRAM = 5
#: Entries a task keeps of its cache of words. Results don't depend on it.
CACHE_ENTRIES = 300_000

_WORD = regex.compile(r"\p{L}+")


def _grams(word: str, size: int) -> list[str]:
    marked = f"^{word}$" if size > 1 else word
    return [marked[i : i + size] for i in range(len(marked) - size + 1)]


def _most_frequent(counted: DataFrame, keys: list[str], most: int) -> DataFrame:
    """The rows whose count `n` is so high that no more than `most` rows per key reach it.

    The window runs over the distinct counts of a key, not over its rows.
    """
    kinds = counted.groupBy(*keys, "n").agg(F.count("*").alias("rows"))
    down = Window.partitionBy(*keys).orderBy(F.desc("n"))
    fits = kinds.withColumn("reached", F.sum("rows").over(down)).filter(F.col("reached") <= most)
    least = fits.groupBy(*keys).agg(F.min("n").alias("least"))
    return counted.join(F.broadcast(least), keys).filter(F.col("n") >= F.col("least")).drop("least")


def train(labelled: DataFrame) -> dict:
    """The model from (text, lang); null texts or languages don't count.

    Each task counts its words and sends the counts on; n-grams are counted from the
    distinct words. A model of no rows knows no language.
    """
    labelled = labelled.select("text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL")
    total = labelled.count()
    share = min(1.0, SAMPLE_DOCUMENTS / max(1, total))
    place = F.pmod(F.xxhash64("lang", "text"), F.lit(1_000_000)) / 1_000_000
    sample = labelled.filter(place < share)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found):
            return pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in found], pa.string()), pa.array([w for _, w in found], pa.string()),
                 pa.array(list(found.values()), pa.int64())],
                names=["lang", "word", "n"],
            )

        found: Counter = Counter()
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found.update([(lang, w) for w in _WORD.findall(text.lower())])
                if len(found) > CACHE_ENTRIES:
                    yield out(found)
                    found.clear()
        if found:
            yield out(found)

    words = written(
        sample.mapInArrow(count, "lang string, word string, n bigint")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n"))
    )
    sums = words.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES_KEPT)
    langs = {row["lang"]: row["n"] for row in sums.collect()}
    words = words.filter(F.col("lang").isin(list(langs)))
    known = _most_frequent(words, ["lang"], WORDS_KEPT).collect()

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for lang, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                for size in range(1, LONGEST_GRAM + 1):
                    for gram in _grams(word, size):
                        found[lang, size, gram] += n
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[i] for k in found], kind) for i, kind in enumerate((pa.string(), pa.int32(), pa.string()))]
                + [pa.array(list(found.values()), pa.int64())],
                names=["lang", "size", "gram", "n"],
            )

    grams = written(
        words.mapInArrow(spell, "lang string, size int, gram string, n bigint")
        .groupBy("lang", "size", "gram")
        .agg(F.sum("n").alias("n"))
    )
    both = ["lang", "size"]
    totals = grams.groupBy(*both).agg(F.sum("n").alias("total"))
    best = _most_frequent(grams, both, GRAMS_KEPT).join(F.broadcast(totals), both).collect()
    return _model(langs, known, best)


def _model(langs: dict[str, int], known, best) -> dict:
    """Log frequencies as one vector per word or n-gram, a place per language."""
    order = sorted(langs)
    place = {lang: i for i, lang in enumerate(order)}
    all_words = sum(langs.values())
    vectors: dict[str, np.ndarray] = {}
    floor = np.array([math.log(0.5 / (langs[lang] + all_words)) for lang in order])
    for row in known:
        vector = vectors.setdefault(row["word"], floor.copy())
        vector[place[row["lang"]]] = math.log((row["n"] + 0.5) / (langs[row["lang"]] + all_words))
    totals: dict[tuple[int, str], int] = {(row["size"], row["lang"]): row["total"] for row in best}
    grams: dict[int, dict[str, np.ndarray]] = {}
    for row in best:
        size = row["size"]
        base = [math.log(0.5 / (totals.get((size, lang), 0) + 1)) for lang in order]
        vector = grams.setdefault(size, {}).setdefault(row["gram"], np.array(base))
        vector[place[row["lang"]]] = math.log((row["n"] + 0.5) / (row["total"] + 1))
    return {"langs": order, "words": vectors, "grams": grams}


class Identifier:
    def __init__(self, model: dict) -> None:
        self.model = model
        self._cache: dict[str, np.ndarray] = {}

    def vector(self, word: str) -> np.ndarray:
        """Evidence of one word: its own entry, or the mean over the n-grams of the
        greatest length of which the model knows any; nothing if it knows none."""
        known = self.model["words"].get(word)
        if known is not None:
            return known
        for size in range(LONGEST_GRAM, 0, -1):
            table = self.model["grams"].get(size, {})
            found = [table[gram] for gram in _grams(word, size) if gram in table]
            if found:
                return np.mean(found, axis=0)
        return np.zeros(len(self.model["langs"]))

    def language(self, text: str | None) -> tuple[str, float]:
        langs = self.model["langs"]
        words = _WORD.findall(text.lower()) if text else []
        if not words or not langs:
            return "und", 0.0
        cache = self._cache
        if len(cache) > CACHE_ENTRIES:
            cache.clear()
        kinds = Counter(words)
        rows = []
        for word in kinds:
            vector = cache.get(word)
            if vector is None:
                vector = cache[word] = self.vector(word)
            rows.append(vector)
        total = np.fromiter(kinds.values(), dtype=float, count=len(kinds)) @ np.array(rows)
        total *= min(1.0, 30 / len(words))  # words of a text are no independent witnesses
        weights = np.exp(total - total.max())
        best = int(np.argmax(weights))
        return langs[best], float(weights[best] / weights.sum())


def identify(docs: DataFrame, model: dict, keep: tuple[str, ...]) -> DataFrame:
    """The `keep` columns, lang_pred and score (0 to 1), from whole texts alone.

    `und` with score 0 if a text is null, empty or has no letter, or if the model
    knows no language. Rows are independent; only the model, whose size is bounded by
    its parameters, is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast({"model": model, "made": {}})
    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").alias("_text"))
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = shared.value["made"]  # lives as long as the worker
        if "own" not in made:
            made["own"] = Identifier(shared.value["model"])
        for batch in batches:
            found = [made["own"].language(t.as_py()) for t in batch.column(n)]
            own = [batch.column(i) for i in range(n)]
            yield pa.RecordBatch.from_arrays(
                own + [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=[*keep, "lang_pred", "score"],
            )

    fields = [source.schema[c] for c in keep]
    fields += [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return source.mapInArrow(run, T.StructType(fields))
