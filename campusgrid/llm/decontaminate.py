"""Benchmark decontamination with a broadcast set of n-gram windows.

Windows of the test items are hashed once and sent to every task, which scans the
word windows of its documents, looks the hits up word by word, and reports or
removes the spans. A set above `max_windows` goes out in blocks of items, one scan
after the other, so that no broadcast outgrows its bound.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campusgrid.llm.common import written
from campusgrid.llm.hashing import ALPHANUMERIC, chunks

WINDOW = 10
#: Windows in one broadcast; with their words some 300 bytes each.
MAX_WINDOWS = 500_000

SPANS = T.ArrayType(T.ArrayType(T.IntegerType()))


def item_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item, window) for each distinct window of an item: its words joined by one blank.

    An item of fewer words, but not none, is one window. Null texts have none; a null
    item_id counts as the id 'null'. Repeated rows change nothing.
    """
    folded = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.filter(F.split(folded, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", -1), lambda w: w != "")
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1)))
    return (
        items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), words.alias("words"))
        .filter(F.size("words") > 0)
        .select("item", F.explode(F.transform(starts, lambda i: F.array_join(F.slice("words", i, size), " "))).alias("window"))
        .distinct()
    )


def _blocks(windows: DataFrame, max_windows: int) -> Iterator[dict[bytes, list[str]]]:
    """Bounded parts of window -> items; all windows of one text fall into one part."""
    total = windows.count()
    parts = max(1, -(-total * 2 // max_windows)) if total > max_windows else 1
    for part in range(parts):
        own = windows.filter(F.pmod(F.xxhash64("window"), F.lit(parts)) == part)
        table: dict[bytes, list[str]] = {}
        for row in own.toLocalIterator():
            table.setdefault(row["window"].encode(), []).append(row["item"])
        yield table


def _scanner(table: dict[bytes, list[str]]):
    """Finds windows of one table in an Arrow column: per text its number of words,
    hit spans (word from, word to) and items."""
    by_size: dict[int, np.ndarray] = {}
    for size in {w.count(b" ") + 1 for w in table}:
        own = pa.array([w for w in table if w.count(b" ") + 1 == size], pa.binary())
        found = [words.windows(size)[0][words.first[:-1]] for _, words in chunks(own, True, ALPHANUMERIC)]
        by_size[size] = np.unique(np.concatenate(found))

    def scan(column: pa.Array) -> tuple[list[int], list[list[list[int]]], list[set[str]]]:
        counts: list[int] = []
        spans: list[list[list[int]]] = [[] for _ in range(len(column))]
        items: list[set[str]] = [set() for _ in range(len(column))]
        for begin, words in chunks(column, True, ALPHANUMERIC):
            counts.extend(np.diff(words.first).tolist())
            owner = words.owner
            for size, wanted in by_size.items():
                found, inside = words.windows(size)
                at = np.searchsorted(wanted, found)
                at[at == len(wanted)] = 0
                for i in np.flatnonzero(inside & (wanted[at] == found)):
                    text = b" ".join(words.word(j) for j in range(i, i + size))
                    if text in table:  # the words themselves, not only their fingerprint
                        t = owner[i]
                        start = int(i - words.first[t])
                        spans[begin + t].append([start, start + size])
                        items[begin + t].update(table[text])
        return counts, spans, items

    return scan


def _merged(spans: list[list[int]]) -> list[list[int]]:
    found: list[list[int]] = []
    for start, end in sorted(spans):
        if found and start <= found[-1][1]:
            found[-1][1] = max(found[-1][1], end)
        else:
            found.append([start, end])
    return found


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    keep: tuple[str, ...] = ("doc_id",),
    size: int = WINDOW,
    max_windows: int = MAX_WINDOWS,
    digests: bool = False,
) -> DataFrame:
    """The `keep` columns of every row with n_words, hit_spans ([word from, word to),
    merged and sorted) and hit_items (ids as text, sorted as text); with `digests`,
    n_hit, n_items and items_sha256 instead of spans and items.

    Words are runs of ASCII letters and digits and of characters beyond ASCII, A-Z
    folded. Null and empty texts have no words, an empty item table hits nothing, rows
    are independent of each other. Documents are never shuffled.
    """
    context = docs.sparkSession.sparkContext
    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").alias("_text"))
    kept = [source.schema[c] for c in keep]
    middle = T.StructType(
        [*source.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("hit_spans", SPANS)]
        + [T.StructField("hit_items", T.ArrayType(T.StringType()))]
    )
    n = len(kept)

    def scanned(df: DataFrame, table: dict[bytes, list[str]], final: bool) -> DataFrame:
        shared = context.broadcast({"table": table, "made": {}})

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            made = shared.value["made"]  # lives as long as the worker
            if "scan" not in made:
                made["scan"] = _scanner(shared.value["table"])
            for batch in batches:
                counts, spans, found = made["scan"](batch.column(n))
                if batch.num_columns > n + 1:  # what earlier blocks found
                    before, known = batch.column(n + 2).to_pylist(), batch.column(n + 3).to_pylist()
                    spans = [a + b for a, b in zip(before, spans)]
                    found = [set(a) | b for a, b in zip(known, found)]
                spans, hit = [_merged(s) for s in spans], [sorted(f) for f in found]
                if final and digests:
                    columns = [
                        pa.array(counts, pa.int64()),
                        pa.array([sum(b - a for a, b in s) for s in spans], pa.int64()),
                        pa.array([len(h) for h in hit], pa.int64()),
                        pa.array([hashlib.sha256(",".join(h).encode()).hexdigest() for h in hit], pa.string()),
                    ]
                else:
                    columns = [
                        pa.array(counts, pa.int64()),
                        pa.array(spans, pa.list_(pa.list_(pa.int32()))),
                        pa.array(hit, pa.list_(pa.string())),
                    ]
                own = [batch.column(i) for i in range(n if final else n + 1)]
                names = (final_schema if final else middle).names
                yield pa.RecordBatch.from_arrays(own + columns, names=names)

        return df.mapInArrow(run, final_schema if final else middle)

    made = (
        [T.StructField(c, T.LongType()) for c in ("n_words", "n_hit", "n_items")]
        + [T.StructField("items_sha256", T.StringType())]
        if digests
        else middle.fields[n + 1 :]
    )
    final_schema = T.StructType([*kept, *made])
    windows = item_windows(items, size)
    tables = _blocks(windows, max_windows)
    table, result = next(tables), source
    for following in tables:
        result, table = written(scanned(result, table, final=False)), following
    return scanned(result, table, final=True)


def drop_contaminated(
    docs: DataFrame, items: DataFrame, size: int = WINDOW, max_windows: int = MAX_WINDOWS
) -> DataFrame:
    """The documents without a window of a test item; all columns as they are.

    Only the text goes to Python, once, and comes back as one boolean: a task holds one
    Arrow copy of a batch of texts, whatever the other columns hold.
    """
    context = docs.sparkSession.sparkContext
    keep = [f"c{i}" for i in range(len(docs.columns))]
    text = keep[docs.columns.index("text")]

    def clean(df: DataFrame, table: dict[bytes, list[str]]) -> DataFrame:
        shared = context.broadcast({"table": table, "made": {}})

        @F.arrow_udf(T.BooleanType())
        def hit(texts: pa.Array) -> pa.Array:
            made = shared.value["made"]  # lives as long as the worker
            if "scan" not in made:
                made["scan"] = _scanner(shared.value["table"])
            return pa.array([bool(spans) for spans in made["scan"](texts)[1]], pa.bool_())

        return df.filter(~hit(text))

    tables = _blocks(item_windows(items, size), max_windows)
    result = clean(docs.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(docs.columns, keep)]), next(tables))
    for following in tables:
        result = clean(written(result), following)
    return result.select(*[F.col(k).alias(c) for k, c in zip(keep, docs.columns)])


def remove_spans(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents with the hit words taken out of `text`, together with what follows
    each hit word up to the next word; a null text stays null."""
    names = docs.columns
    renamed = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], F.col("text"))
    keep = tuple(f"c{i}" for i in range(len(names)))
    at = keep[names.index("text")]
    found = find_contamination(renamed, items, keep, size)
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
    lead = F.regexp_extract(at, r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", 0)
    pieces = F.regexp_extract_all(F.col(at), F.lit(word), F.lit(0))
    clean = F.filter(pieces, lambda p, i: ~F.exists("hit_spans", lambda s: (s[0] <= i) & (i < s[1])))
    text = F.when(F.size("hit_spans") > 0, F.concat(lead, F.array_join(clean, ""))).otherwise(F.col(at))
    return found.select(*[(text if k == at else F.col(k)).alias(c) for k, c in zip(keep, names)])
