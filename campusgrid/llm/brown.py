"""Class-based n-gram scores (Brown et al.), with classes found by exchange.

Every word of the training texts has a class of its own finding. Exchange clustering
moves the most frequent words, the end of a text, and one group per kind of ending of
rarer words between classes while that raises the likelihood of the class bigrams. Then
each rarer word is placed by itself: in the class whose frequent words make the classes
before and behind its own tokens likeliest. Class bigrams are counted again over all
tokens with the classes of all words. A token's probability is that of its class after
the class before, times that of its word in the class; both are smoothed and sum to one
over all known words and one unknown word per group, in the class of the group.

Words are 64-bit fingerprints throughout. Counts cover every token of the training
texts; words, counts and classes are kept as a table. Only a fixed number of most frequent
words is broadcast, rarer ones are joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campusgrid.llm.common import written
from campusgrid.llm.hashing import BLANK_SEPARATED, Words, chunks, mixed, signed

#: Words that the exchange moves, groups of the others while it runs, classes, rounds of exchange.
UNIT_WORDS = 1500
GROUPS = 256
CLASSES = 48
ROUNDS = 24
#: Each round moves one of so many portions of the units.
PORTIONS = 8
#: Words whose counts and classes are broadcast (24 bytes each); all others are joined.
BROADCAST_WORDS = 200_000
#: Weight of the class frequencies in the transitions.
BACKOFF = 5.0
#: Distinct entries a task gathers before it sends them on.
GATHERED = 2_000_000

END = np.int64(-1)  # the token at the end of a text; no word has this fingerprint


def _tokens(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprints of all tokens, their groups, and the index of each text's end token."""
    texts = len(words.first) - 1
    ends = words.first[1:] + np.arange(texts)
    total = len(words.hashes) + texts
    inner = np.ones(total, dtype=bool)
    inner[ends] = False
    tokens = np.full(total, END)
    tokens[inner] = signed(words.hashes)
    # A group: the last two bytes and whether the word is longer than eight.
    last = words.data[words.ends - 1].astype(np.uint64)
    before = np.where(words.ends - words.starts > 1, words.data[words.ends - 2], 0).astype(np.uint64)
    long = (words.ends - words.starts > 8).astype(np.uint64)
    groups = np.zeros(total, dtype=np.int64)
    groups[inner] = (mixed(last * np.uint64(512) + before * np.uint64(2) + long) % np.uint64(GROUPS)).astype(np.int64)
    return tokens, groups, ends


class _Sums:
    """Sums of counts per key, sent on when they get many."""

    def __init__(self) -> None:
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        found, counts = np.unique(keys, return_counts=True)
        self.keys.append(found)
        self.counts.append(counts)
        self.size += len(found)

    def take(self, least: int) -> tuple[np.ndarray, np.ndarray] | None:
        """The sums so far, if they are `least` or more."""
        if not self.keys or self.size < least:
            return None
        keys, place = np.unique(np.concatenate(self.keys), return_inverse=True)
        counts = np.bincount(place, np.concatenate(self.counts)).astype(np.int64)
        self.__init__()
        if least > 1 and len(keys) < least // 2:  # mostly the same keys again: go on
            self.keys, self.counts, self.size = [keys], [counts], len(keys)
            return None
        return keys, counts


def count_words(texts: DataFrame) -> DataFrame:
    """(word, grp, n): every distinct token of the column `text`, the end included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, groups = _Sums(), {}

        def out(found):
            keys, counts = found
            where = np.concatenate([g for g in groups["word"]])
            kinds, at = np.unique(where, return_index=True)
            grp = np.concatenate(groups["grp"])[at][np.searchsorted(kinds, keys)]
            groups["word"], groups["grp"] = [kinds], [np.concatenate(groups["grp"])[at]]
            return pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(grp.astype(np.int32)), pa.array(counts)], names=["word", "grp", "n"]
            )

        groups["word"], groups["grp"] = [], []
        for batch in batches:
            for _, words in chunks(batch.column(0), True, BLANK_SEPARATED):
                tokens, grp, _ = _tokens(words)
                kinds, at = np.unique(tokens, return_index=True)
                groups["word"].append(kinds)
                groups["grp"].append(grp[at])
                sums.add(tokens)
            if found := sums.take(GATHERED):
                yield out(found)
                groups["word"], groups["grp"] = [], []
        if found := sums.take(1):
            yield out(found)

    parts = texts.select("text").mapInArrow(run, "word bigint, grp int, n bigint")
    return parts.groupBy("word", "grp").agg(F.sum("n").alias("n"))


def _units(tokens: np.ndarray, groups: np.ndarray, words: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Unit of each token: a listed word (the end among them), or else its group."""
    at = np.minimum(np.searchsorted(words, tokens), len(words) - 1)
    return np.where(words[at] == tokens, places[at], len(words) + groups)


def count_bigrams(texts: DataFrame, words: np.ndarray, places: np.ndarray) -> DataFrame:
    """(unit, following, n) over neighbouring tokens; a text follows an end."""
    shared = texts.sparkSession.sparkContext.broadcast((words, places))
    units = len(words) + GROUPS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, own_places = shared.value
        sums = _Sums()

        def out(found):
            keys, counts = found
            return pa.RecordBatch.from_arrays(
                [pa.array((keys // units).astype(np.int32)), pa.array((keys % units).astype(np.int32)), pa.array(counts)],
                names=["unit", "following", "n"],
            )

        for batch in batches:
            for _, words_ in chunks(batch.column(0), True, BLANK_SEPARATED):
                tokens, groups, _ = _tokens(words_)
                unit = _units(tokens, groups, own, own_places)
                end = own_places[np.searchsorted(own, END)]
                before = np.concatenate([[end], unit[:-1]])
                sums.add(before * units + unit)
            if found := sums.take(GATHERED):
                yield out(found)
        if found := sums.take(1):
            yield out(found)

    parts = texts.select("text").mapInArrow(run, "unit int, following int, n bigint")
    return parts.groupBy("unit", "following").agg(F.sum("n").alias("n"))


def _entropy_part(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def _moves(classes: np.ndarray, after: np.ndarray, before: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Best class of each unit, all else unchanged, and what the move gains.

    after, before: counts of each unit with the class behind and ahead of it; own: with
    itself. The likelihood is sum N(a,b) log N(a,b) - sum N(a) log N(a) - sum N(b) log N(b).
    """
    grid = np.zeros((k, k))
    np.add.at(grid, classes, after)
    rows, columns = grid.sum(1), grid.sum(0)
    best, gain = classes.copy(), np.zeros(len(classes))
    for u in range(len(classes)):
        a, r, c, s = classes[u], after[u].copy(), before[u].copy(), own[u]
        total_r, total_c = r.sum(), c.sum()
        if not total_r + total_c:
            continue
        r[a] -= s  # contexts without the unit itself
        c[a] -= s
        rest = grid.copy()
        rest[a] -= r
        rest[:, a] -= c
        rest[a, a] -= s
        row_rest, column_rest = rows.copy(), columns.copy()
        row_rest[a] -= total_r
        column_rest[a] -= total_c
        # Joining class b adds r to its row, c to its column, s to its corner.
        row_gain = (_entropy_part(rest + r) - _entropy_part(rest)).sum(1)
        column_gain = (_entropy_part(rest + c[:, None]) - _entropy_part(rest)).sum(0)
        d = np.diagonal(rest)
        corner = (
            _entropy_part(d + r + c + s) - _entropy_part(d)
            - (_entropy_part(d + r) - _entropy_part(d)) - (_entropy_part(d + c) - _entropy_part(d))
        )
        value = row_gain + column_gain + corner
        value -= _entropy_part(row_rest + total_r) - _entropy_part(row_rest)
        value -= _entropy_part(column_rest + total_c) - _entropy_part(column_rest)
        best[u] = int(np.argmax(value))
        gain[u] = value[best[u]] - value[a]
    return best, gain


def exchange(bigrams: DataFrame, units: int, k: int = CLASSES, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of the units, and each unit's counts by the class behind and by the class ahead of it.

    Each round is one job: tasks turn their bigrams into counts of units with classes,
    a table of fixed size. Then units move to their best class, a portion of them per
    round, since moves at the same time don't know of each other; should they harm,
    the best classes so far stand.
    """
    classes = np.arange(units) % k
    context = bigrams.sparkSession.sparkContext

    def contexts() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        shared = context.broadcast(classes)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = shared.value
            table = np.zeros((units, 2 * k + 1))
            for batch in batches:
                unit, following, n = (c.to_numpy() for c in batch.columns)
                np.add.at(table, (unit, own[following]), n)
                np.add.at(table, (following, k + own[unit]), n)
                same = unit == following
                np.add.at(table, (unit[same], 2 * k), n[same])
            filled = np.flatnonzero(table.any(1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(filled), pa.array(list(table[filled]), pa.list_(pa.float64()))], names=["unit", "counts"]
            )

        parts = bigrams.mapInArrow(run, "unit bigint, counts array<double>")
        sums = [F.sum(F.col("counts")[i]) for i in range(2 * k + 1)]
        table = np.zeros((units, 2 * k + 1))
        for row in parts.groupBy("unit").agg(F.array(*sums).alias("counts")).collect():
            table[row["unit"]] = row["counts"]
        return table[:, :k], table[:, k : 2 * k], table[:, 2 * k]

    portion = mixed(np.arange(units, dtype=np.uint64)) % np.uint64(PORTIONS)
    best_likelihood, kept, idle = -np.inf, (classes, *[np.zeros((units, k))] * 2), 0
    for turn in range(rounds + 1):
        after, before, own = contexts()
        grid = np.zeros((k, k))
        np.add.at(grid, classes, after)
        parts = _entropy_part(grid).sum() - _entropy_part(grid.sum(0)).sum()
        likelihood = parts - _entropy_part(grid.sum(1)).sum()
        if likelihood > best_likelihood:
            best_likelihood, kept = likelihood, (classes, after, before)
        if turn == rounds or idle == PORTIONS:
            break
        best, gain = _moves(classes, after, before, own, k)
        moved = (gain > 1e-6) & (portion == turn % PORTIONS)
        idle = 0 if moved.any() else idle + 1
        classes = np.where(moved, best, classes)
    return kept


class _WordSums:
    """Sums of counts per word and key below `width`."""

    def __init__(self, width: int) -> None:
        self.width = width
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, words: np.ndarray, keys: np.ndarray, counts: np.ndarray | None = None) -> None:
        kinds, place = np.unique(words, return_inverse=True)
        both, at = np.unique(place * self.width + keys, return_inverse=True)
        sums = np.bincount(at, counts, len(both)).astype(np.int64)
        self.parts.append((kinds[both // self.width], both % self.width, sums))
        self.size += len(both)

    def take(self, least: int) -> pa.RecordBatch | None:
        """The sums so far, if they are `least` or more."""
        if not self.parts or self.size < least:
            return None
        words, keys, counts = (np.concatenate(x) for x in zip(*self.parts))
        self.parts, self.size = [], 0
        self.add(words, keys, counts)
        if least > 1 and self.size < least // 2:  # mostly the same again: go on
            return None
        words, keys, counts = self.parts[0]
        self.parts, self.size = [], 0
        return pa.RecordBatch.from_arrays(
            [pa.array(words), pa.array(keys.astype(np.int32)), pa.array(counts)], names=["word", "between", "n"]
        )


def place(texts: DataFrame, words: np.ndarray, places: np.ndarray, classes: np.ndarray, ahead: np.ndarray, behind: np.ndarray) -> DataFrame:
    """(word, n, cls): every word that isn't listed, its tokens and its likeliest class.

    Neighbours count by the classes of units; `ahead` and `behind` are the probabilities, per
    class, of the classes before and after its tokens. Tasks sum the pairs of classes that a
    word stands between; these are dealt and sorted by word and summed as a stream.
    """
    k = len(ahead)
    shared = texts.sparkSession.sparkContext.broadcast((words, places, classes, np.log(ahead), np.log(behind)))

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, own_places, own_classes, _, _ = shared.value
        end = own_classes[own_places[np.searchsorted(own, END)]]
        sums = _WordSums(k * k)
        for batch in batches:
            for _, words_ in chunks(batch.column(0), True, BLANK_SEPARATED):
                tokens, groups, _ = _tokens(words_)
                unit = _units(tokens, groups, own, own_places)
                kind = own_classes[unit]
                before = np.concatenate([[end], kind[:-1]])
                rest = np.flatnonzero(unit >= len(own))  # an end follows in the same text
                sums.add(tokens[rest], before[rest] * k + kind[rest + 1])
            if found := sums.take(GATHERED):
                yield found
        if found := sums.take(1):
            yield found

    def likeliest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, _, _, log_ahead, log_behind = shared.value

        def out(found: np.ndarray, table: np.ndarray) -> pa.RecordBatch:
            before, after = table[:, :k], table[:, k:]
            n = before.sum(1)
            value = before @ log_ahead.T + after @ log_behind.T
            kinds = np.argmax(np.round(value, 6), axis=1).astype(np.int32)  # of equal ones the first
            return pa.RecordBatch.from_arrays(
                [pa.array(found), pa.array(n.astype(np.int64)), pa.array(kinds)], names=["word", "n", "cls"]
            )

        last, carried = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            word, between, n = (c.to_numpy() for c in batch.columns)
            found, at = np.unique(word, return_inverse=True)
            table = np.hstack(
                [np.bincount(at * k + side, n, len(found) * k).reshape(-1, k) for side in (between // k, between % k)]
            )
            if last is not None and found[0] == last:
                table[0] += carried
            elif last is not None:
                yield out(np.array([last]), carried[None])
            last, carried = found[-1], table[-1].copy()
            if len(found) > 1:
                yield out(found[:-1], table[:-1])
        if last is not None:
            yield out(np.array([last]), carried[None])

    parts = texts.select("text").mapInArrow(contexts, "word bigint, between int, n bigint")
    dealt = parts.repartition("word").sortWithinPartitions("word")
    return dealt.mapInArrow(likeliest, "word bigint, n bigint, cls int")


def count_class_bigrams(texts: DataFrame, known: np.ndarray, classes: np.ndarray, others: DataFrame, k: int) -> np.ndarray:
    """Tokens of each class behind each class, over all neighbours; a text follows an end.

    known: words, sorted, with their classes, the end among them; others: the table of all
    further words. Neighbours that are both known are counted in the tasks, the rest joined.
    """
    shared = texts.sparkSession.sparkContext.broadcast((known, classes))
    names = ["word", "cls", "next_word", "next_cls", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, own_classes = shared.value
        end = own_classes[np.searchsorted(own, END)]
        grid = np.zeros(k * k, dtype=np.int64)

        def out(left, kind, right, next_kind, n):
            columns = [
                pa.array(left, mask=kind >= 0), pa.array(kind, mask=kind < 0),
                pa.array(right, mask=next_kind >= 0), pa.array(next_kind, mask=next_kind < 0), pa.array(n),
            ]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            for _, words in chunks(batch.column(0), True, BLANK_SEPARATED):
                tokens, _, _ = _tokens(words)
                at = np.minimum(np.searchsorted(own, tokens), len(own) - 1)
                kind = np.where(own[at] == tokens, own_classes[at], -1).astype(np.int32)
                left, left_kind = np.concatenate([[END], tokens[:-1]]), np.concatenate([[end], kind[:-1]]).astype(np.int32)
                both = (kind >= 0) & (left_kind >= 0)
                grid += np.bincount(left_kind[both].astype(np.int64) * k + kind[both], minlength=k * k)
                rest = np.flatnonzero(~both)
                if len(rest):
                    yield out(left[rest], left_kind[rest], tokens[rest], kind[rest], np.ones(len(rest), dtype=np.int64))
        cells = np.flatnonzero(grid)
        none = np.zeros(len(cells), dtype=np.int64)
        yield out(none, (cells // k).astype(np.int32), none, (cells % k).astype(np.int32), grid[cells])

    pairs = written(texts.select("text").mapInArrow(run, "word bigint, cls int, next_word bigint, next_cls int, n bigint"))
    first = others.select("word", F.col("cls").alias("cls"))
    second = others.select(F.col("word").alias("next_word"), F.col("cls").alias("next_cls"))
    in_front = pairs.filter("word IS NOT NULL").drop("cls").join(first, "word")
    so_far = pairs.filter("word IS NULL").select("cls", "next_word", "next_cls", "n").unionByName(
        in_front.select("cls", "next_word", "next_cls", "n")
    )
    behind = so_far.filter("next_word IS NOT NULL").drop("next_cls").join(second, "next_word")
    whole = so_far.filter("next_word IS NULL").select("cls", "next_cls", "n").unionByName(behind.select("cls", "next_cls", "n"))
    grid = np.zeros((k, k))
    for row in whole.groupBy("cls", "next_cls").agg(F.sum("n").alias("n")).collect():
        grid[row["cls"], row["next_cls"]] = row["n"]
    return grid


def _follow(grid: np.ndarray, class_tokens: np.ndarray) -> np.ndarray:
    """Probability of each class beside each class, from their counts and those of single classes."""
    shares = (class_tokens + 0.5) / (class_tokens + 0.5).sum()
    return (grid + BACKOFF * shares) / (grid.sum(1, keepdims=True) + BACKOFF)


def train(texts: DataFrame, unit_words: int = UNIT_WORDS, broadcast_words: int = BROADCAST_WORDS, k: int = CLASSES) -> dict:
    """The model of the column `text`; null counts as empty.

    counts: table of all words that the exchange didn't move, with tokens and class; known,
    known_counts, known_classes: the most frequent of all, sorted by fingerprint; the rest
    has a size set by the parameters.
    """
    texts = texts.select("text")
    counts = written(count_words(texts))
    totals = counts.agg(F.count("*").alias("v"), F.sum("n").alias("n")).first()
    frequent = counts.filter(F.col("word") != int(END)).orderBy(F.desc("n"), "word").limit(unit_words)
    top = frequent.select("word", "n").union(counts.filter(F.col("word") == int(END)).select("word", "n")).toArrow()
    word, n = (top.column(i).to_numpy() for i in range(2))
    if END not in word:  # no texts
        word, n = np.append(word, END).astype(np.int64), np.append(n, 0)
    order = np.argsort(word)
    words, places = word[order], order.astype(np.int64)
    units = len(words) + GROUPS
    bigrams = written(count_bigrams(texts, words, places))
    classes, after, before = exchange(bigrams, units, k)
    own, sizes = classes[: len(words)], after.sum(0)
    ahead, behind = np.zeros((k, k)), np.zeros((k, k))
    np.add.at(ahead, own, before[: len(words)])
    np.add.at(behind, own, after[: len(words)])
    placed = written(place(texts, words, places, classes, _follow(ahead, sizes), _follow(behind, sizes)))

    more = placed.orderBy(F.desc("n"), "word").limit(max(broadcast_words - len(words), 0)).toArrow()
    known = np.concatenate([word, more.column("word").to_numpy()]).astype(np.int64)
    known_counts = np.concatenate([n, more.column("n").to_numpy()]).astype(np.float64)
    known_classes = np.concatenate([own, more.column("cls").to_numpy()]).astype(np.int64)
    by_word = np.argsort(known)
    known, known_counts, known_classes = known[by_word], known_counts[by_word], known_classes[by_word]
    grid = count_class_bigrams(texts, known, known_classes, placed, k)

    tokens, types = np.bincount(own, n, k), np.bincount(own[n > 0], minlength=k).astype(float)
    for row in placed.groupBy("cls").agg(F.count("*").alias("v"), F.sum("n").alias("n")).collect():
        types[row["cls"]] += row["v"]
        tokens[row["cls"]] += row["n"]
    group_classes = classes[len(words) :]
    types += np.bincount(group_classes, minlength=k)
    return {
        "counts": placed,
        "parameters": {
            "n": int(totals["n"] or 0), "v": int(totals["v"]),
            "known": known, "known_counts": known_counts, "known_classes": known_classes,
            "group_classes": group_classes, "follow": np.log10(_follow(grid, tokens)),
            "class_scale": np.log10(np.maximum(tokens + 0.5 * types, 0.5)),
        },
    }


_LOCAL = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()),
        T.StructField("base_score", T.DoubleType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("_rare", T.ArrayType(T.LongType())),
        T.StructField("_groups", T.ArrayType(T.IntegerType())),
        T.StructField("_before", T.ArrayType(T.IntegerType())),
        T.StructField("_after", T.ArrayType(T.IntegerType())),
    ]
)


def score(docs: DataFrame, model: dict, keep: tuple[str, ...]) -> DataFrame:
    """The `keep` columns, n_tokens, n_known, train_tokens, base_score (unigrams), score
    and perplexity of every whole text; null counts as empty: one end token.

    The words that aren't broadcast are joined with the table of counts and classes: per
    row and word one pair. Rows keep these tokens in order, with the classes beside them, and
    are completed with what was found. Rows are independent, ids may repeat or be null.
    """
    parameters = model["parameters"]
    shared = docs.sparkSession.sparkContext.broadcast(parameters)
    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").alias("_text"))
    width = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        known, known_counts, known_classes = m["known"], m["known_counts"], m["known_classes"]
        end = known_classes[np.searchsorted(known, END)]
        base_scale = np.log10(max(m["n"] + 0.5 * (m["v"] + 1), 0.5))
        for batch in batches:
            columns: list[list] = [[] for _ in _LOCAL.fields]
            for _, words in chunks(batch.column(width), True, BLANK_SEPARATED):
                tokens, groups, ends = _tokens(words)
                at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
                listed = known[at] == tokens
                count = known_counts[at]
                kind = np.where(listed, known_classes[at], -1)
                before = np.concatenate([[end], kind[:-1]])
                own = np.where(listed, np.log10(count + 0.5), 0.0)
                full = np.where(listed, own - m["class_scale"][kind], 0.0)
                full += np.where(listed & (before >= 0), m["follow"][before, kind], 0.0)
                starts = np.concatenate([[0], ends[:-1] + 1])
                columns[0].extend((ends - starts + 1).tolist())
                columns[1].extend(np.add.reduceat(listed & (count > 0), starts, dtype=np.int64).tolist())
                columns[2].extend(np.add.reduceat(own - base_scale, starts).tolist())
                columns[3].extend(np.add.reduceat(full, starts).tolist())
                rest = np.flatnonzero(~listed)  # an end follows in the same text
                cuts = np.searchsorted(rest, starts[1:])
                parts = (tokens[rest], groups[rest].astype(np.int32), before[rest].astype(np.int32), kind[rest + 1].astype(np.int32))
                for column, part in zip(columns[4:], parts):
                    column.extend(np.split(part, cuts))
            ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), longs, ints, ints, ints)
            made = [pa.array(values, kind) for values, kind in zip(columns, kinds)]
            own_columns = [batch.column(i) for i in range(width)]
            yield pa.RecordBatch.from_arrays(own_columns + made, names=[*keep, *_LOCAL.names])

    def completed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            n_known, base, full = (batch.column(width + i).to_numpy() for i in (1, 2, 3))
            rare, groups, before, after = (batch.column(width + i).flatten().to_numpy() for i in (4, 5, 6, 7))
            lengths = np.diff(batch.column(width + 4).offsets.to_numpy())
            owner = np.repeat(np.arange(batch.num_rows), lengths)
            word, n, kinds = (x.to_numpy() for x in batch.column(width + 8).flatten().flatten())
            # What was found for a word is the same in every row.
            found, first = np.unique(word, return_index=True)
            count, kind = np.zeros(len(rare)), m["group_classes"][groups]
            if len(found):
                at = np.minimum(np.searchsorted(found, rare), len(found) - 1)
                listed = found[at] == rare
                count = np.where(listed, n[first][at], 0)
                kind = np.where(listed, kinds[first][at], kind)
            own = np.log10(count + 0.5)
            before = np.where(before >= 0, before, np.concatenate([[0], kind])[: len(kind)])
            more = own - m["class_scale"][kind] + m["follow"][before, kind]
            more += np.where(after >= 0, m["follow"][kind, after], 0.0)
            rows = batch.num_rows
            made = [
                batch.column(width),
                pa.array(n_known + np.bincount(owner[count > 0], minlength=rows)),
                pa.array(base + np.bincount(owner, own, rows)),
                pa.array(full + np.bincount(owner, more, rows)),
            ]
            own_columns = [batch.column(i) for i in range(width)]
            yield pa.RecordBatch.from_arrays(own_columns + made, names=[*keep, *_LOCAL.names[:4]])

    own_fields = [source.schema[c] for c in keep]
    local = written(source.mapInArrow(run, T.StructType(own_fields + _LOCAL.fields)).withColumn("_row", F.monotonically_increasing_id()))
    pairs = local.select("_row", F.explode(F.array_distinct("_rare")).alias("word"))
    found = pairs.join(model["counts"], "word").groupBy(F.col("_row").alias("_r"))
    found = found.agg(F.collect_list(F.struct("word", "n", "cls")).alias("_found"))
    both = local.join(found, F.col("_row") == F.col("_r"), "left")
    columns = [F.col(f"`{c}`") for c in [*keep, *_LOCAL.names]]
    scored = both.select(*columns, "_found").mapInArrow(completed, T.StructType(own_fields + _LOCAL.fields[:4]))
    return scored.select(
        *keep,
        "n_tokens",
        "n_known",
        F.lit(parameters["n"]).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
