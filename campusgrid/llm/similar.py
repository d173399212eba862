"""Near-duplicate join on word shingles: grouped prefix join.

A document's set holds its distinct 5-word shingles as 64-bit fingerprints, ordered
by how frequent they are and then by value. Two sets with Jaccard likeness t or more
share a shingle within their prefixes, the first n - ceil(t n) + 1 of each.

Equal sets collapse to one. Sets of equal prefix and size form a group before anything
is shuffled by shingle, and only groups are paired, by shingle, size and place of the shingle. Pairs of groups are
then expanded to their members and those verified on the whole sets.

Members that are linked already needn't be compared. So a first round compares each
group, and each member, with a few leaders per shingle only; a second round compares
what is still in different components.
Before whole sets are read, a sketch rules out pairs that differ too much. The result is
the components that links form; not all links are found, so neither are they counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campusgrid.llm.common import written
from campusgrid.llm.components import components
from campusgrid.llm.hashing import BLANK_SEPARATED, Words, chunks, mixed, signed

SHINGLE = 5
#: Likeness in hundredths.
PERCENT = 80
#: Frequent shingles that stand last in the order; broadcast, 12 bytes each. Any order
#: that all sets share gives the same links, a better one gives fewer candidates.
FREQUENT = 200_000
#: Bits of the broadcast filter that leaves out most sets in no pair before the join.
PICKED = 1 << 26
#: Fingerprints a task remembers in order to send a set once.
REMEMBERED = 100_000
#: Shingles a task counts at a time.
GATHERED = 3_000_000

#: 64-bit words of a sketch, and orders in which the first round picks leaders.
SKETCH_WORDS = 16
LEADERS = 3
#: Leaders a group is compared with in the first round: those it shares most shingles
#: with. The second round compares all that is still apart.
TRIED = 4

_SALT = np.uint64(0x27D4EB2F165667C5)
#: No frequent shingles: sets are ordered by value alone.
NONE_FREQUENT = (np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64))


def _sets(words: Words, size: int) -> Iterator[np.ndarray]:
    """The distinct shingles of each text, sorted by value."""
    found, _ = words.windows(size)
    for first, last in zip(words.first, words.first[1:]):
        count = last - first
        if count >= size:
            yield np.unique(found[first : last - size + 1])
        elif count:  # the whole sequence is the one shingle
            whole = np.uint64(count)
            for h in words.hashes[first:last].tolist():
                whole = mixed(np.array([whole], dtype=np.uint64) * np.uint64(31) + np.uint64(h))[0]
            yield np.array([whole], dtype=np.uint64)
        else:
            yield np.zeros(0, dtype=np.uint64)


def _identity(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    one, two = mixed(shingles).sum(dtype=np.uint64), mixed(shingles ^ _SALT).sum(dtype=np.uint64)
    pair = np.array([one, two], dtype=np.uint64).view(np.int64)
    return int(pair[0]), int(pair[1])


def _sketch(shingles: np.ndarray) -> np.ndarray:
    flips = np.bincount((shingles % np.uint64(64 * SKETCH_WORDS)).astype(np.int64), minlength=64 * SKETCH_WORDS)
    return np.packbits((flips & 1).astype(np.uint8)).view(np.int64)


def _prefix(shingles: np.ndarray, percent: int, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The first shingles of a set in the order of all sets, enough for a link of `percent`."""
    values, counts = frequent
    n = len(shingles)
    if len(values):
        at = np.minimum(np.searchsorted(values, shingles), len(values) - 1)
        often = np.where(values[at] == shingles, counts[at], 0)
        shingles = shingles[np.argsort(often, kind="stable")]
    return shingles[: n - (n * percent + 99) // 100 + 1]


def _group(prefix: np.ndarray, n: int) -> int:
    """Fingerprint of a prefix, in its order, and the size of its set."""
    steps = mixed(prefix + np.arange(len(prefix), dtype=np.uint64) * _SALT).sum(dtype=np.uint64)
    return int(signed(mixed(np.array([steps + np.uint64(n)], dtype=np.uint64)))[0])


def document_sets(
    docs: DataFrame, size: int, percent: int = PERCENT, frequent: tuple[np.ndarray, np.ndarray] = NONE_FREQUENT
) -> DataFrame:
    """(doc_id, mark, n, set_id, check, grp, sketch) of every document; n = 0 without words.

    mark: fingerprint of the text. grp: that of the set's prefix and size. sketch: 1024
    bits; a shingle flips one of them.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, one, two, groups, bits = [], [], [], [], []
            for _, words in chunks(batch.column(2), True, BLANK_SEPARATED):
                for shingles in _sets(words, size):
                    a, b = _identity(shingles)
                    bits.append(_sketch(shingles))
                    n.append(len(shingles))
                    one.append(a)
                    two.append(b)
                    groups.append(_group(_prefix(shingles, percent, shared.value), len(shingles)))
            made = [pa.array(c, pa.int64()) for c in (n, one, two, groups)]
            own = [batch.column(0), batch.column(1)]
            made.append(pa.array(bits, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(own + made, names=["doc_id", "mark", "n", "set_id", "check", "grp", "sketch"])

    source = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("mark"), F.col("text"))
    schema = "doc_id bigint, mark bigint, n bigint, set_id bigint, check bigint, grp bigint, sketch array<bigint>"
    return source.mapInArrow(run, schema)


def frequent_shingles(docs: DataFrame, size: int, most: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, sorted by value, and their counts.

    A task counts sets per shingle, equal sets once, some millions of shingles at a time,
    and sends on what occurs twice or more; what is frequent is so again and again.
    """

    def counted(found: list[np.ndarray]) -> pa.RecordBatch:
        every = np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)
        found.clear()
        every.sort()
        first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])[: len(every)])
        counts = np.diff(np.append(first, len(every)))
        twice = counts >= 2
        return pa.RecordBatch.from_arrays(
            [pa.array(signed(every[first[twice]])), pa.array(counts[twice])], names=["shingle", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, found, gathered = set(), [], 0
        for batch in batches:
            for _, words in chunks(batch.column(0), True, BLANK_SEPARATED):
                for shingles in _sets(words, size):
                    own = _identity(shingles)
                    if own not in seen:
                        seen.add(own)
                        found.append(shingles)
                        gathered += len(shingles)
                if gathered >= GATHERED:
                    yield counted(found)
                    seen, gathered = set(), 0
        yield counted(found)

    parts = docs.select("text").mapInArrow(run, "shingle bigint, n bigint")
    top = parts.groupBy("shingle").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "shingle").limit(most).toArrow()
    values = top.column(0).to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(values)
    return values[order], top.column(1).to_numpy()[order]


def _ceil_share(n: Column, percent: int) -> Column:
    return F.floor((n * percent + 99) / 100)


def postings(docs: DataFrame, size: int, percent: int, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(grp, n, shingle, place) for each shingle of a group's prefix; place from 0.

    Sets of one prefix and size are one group, which comes once per task or more.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for _, words in chunks(batch.column(0), True, BLANK_SEPARATED):
                columns: list[list[np.ndarray]] = [[] for _ in range(4)]
                for shingles in _sets(words, size):
                    n = len(shingles)
                    own = _identity(shingles)[0] if n else 0
                    if not n or own in seen:
                        continue
                    prefix = _prefix(shingles, percent, shared.value)
                    group = _group(prefix, n)
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(own)
                    if group in seen:
                        continue
                    seen.add(group)
                    for column, value in zip(columns, (group, n)):
                        column.append(np.full(len(prefix), value, dtype=np.int64))
                    columns[2].append(signed(prefix))
                    columns[3].append(np.arange(len(prefix)))
                if columns[0]:
                    arrays = [pa.array(np.concatenate(c)) for c in columns]
                    yield pa.RecordBatch.from_arrays(arrays, names=["grp", "n", "shingle", "place"])

    return docs.select("text").mapInArrow(run, "grp bigint, n bigint, shingle bigint, place bigint")


def _may_link(n: Column, place: Column, other_n: Column, other_place: Column, percent: int) -> Column:
    """Whether sizes and what can follow the common shingle allow enough overlap."""
    sizes = 100 * F.least(n, other_n) >= percent * F.greatest(n, other_n)
    most = 1 + F.least(n - place, other_n - other_place) - 1
    # 100 i >= percent (n + m - i)
    return sizes & ((100 + percent) * most >= percent * (n + other_n))


def _sketches_allow(n: Column, sketch: Column, other_n: Column, other_sketch: Column, percent: int) -> Column:
    """Whether the sets can differ by as little as links do: each bit that differs stands
    for a shingle that only one of them has."""
    differ = sum(
        (F.bit_count(sketch[i].bitwiseXOR(other_sketch[i])) for i in range(SKETCH_WORDS)), F.lit(0)
    )
    return (100 + percent) * differ <= (100 - percent) * (n + other_n)


def _filter_of(ids: DataFrame, bits: int) -> np.ndarray:
    """A Bloom filter of `bits` bits, made in tasks, with two bits per id."""
    places = F.explode(F.array(*[F.pmod(F.shiftright("id", by), F.lit(bits)) for by in (0, 32)]))
    bit = F.expr("shiftleft(1L, CAST(place % 64 AS INT))")
    found = ids.select(places.alias("place")).groupBy(F.floor(F.col("place") / 64).alias("word")).agg(F.bit_or(bit).alias("bits"))
    found = found.toArrow()
    made = np.zeros(-(-bits // 64), dtype=np.int64)
    made[found.column(0).to_numpy()] = found.column(1).to_numpy()
    return made


def _may_hold(made: np.ndarray, bits: int, one: int) -> bool:
    places = (one % bits, (one >> 32) % bits)
    return all(int(made[place // 64]) >> (place % 64) & 1 for place in places)


def verified(pairs: DataFrame, docs: DataFrame, size: int, percent: int, picked: int = PICKED) -> DataFrame:
    """The pairs (a, b) of sets that link, judged on the whole sets.

    Only sets in a pair are read out of the texts again, by a join. Before it, a filter
    of `picked` bits, whatever the number of pairs, leaves out most others; 0: none.
    """
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    shared = docs.sparkSession.sparkContext.broadcast(_filter_of(wanted, picked) if picked else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = shared.value, set()
        for batch in batches:
            for _, words in chunks(batch.column(0), True, BLANK_SEPARATED):
                found, sets = [], []
                for shingles in _sets(words, size):
                    if not len(shingles):
                        continue
                    one = _identity(shingles)[0]
                    if one in seen or (own is not None and not _may_hold(own, picked, one)):
                        continue
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(one)
                    found.append(one)
                    sets.append(signed(shingles))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["id", "shingles"]
                    )

    # Sets are dealt by their id once; both joins use that shuffle.
    sets = docs.select("text").mapInArrow(run, "id bigint, shingles array<bigint>")
    sets = sets.join(wanted.withColumnRenamed("id", "_id"), F.col("id") == F.col("_id"), "left_semi")
    sets = sets.groupBy("id").agg(F.any_value("shingles").alias("shingles"))
    left = sets.select(F.col("id").alias("ida"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("idb"), F.col("shingles").alias("sb"))
    both = pairs.select("a", "b").join(right, F.col("b") == F.col("idb")).join(left, F.col("a") == F.col("ida"))
    common = F.size(F.array_intersect("sa", "sb"))
    return both.filter(100 * common >= percent * (F.size("sa") + F.size("sb") - common)).select("a", "b")


def _shared_postings(posted: DataFrame, percent: int) -> DataFrame:
    """(shingle, grp, n, place, leaders) for the shingles of two groups or more.

    leaders: a few other groups of the shingle, the same ones for all its groups, as
    far as a link with them is possible. All is worked out behind one shuffle by shingle.
    """
    by_shingle = Window.partitionBy("shingle")
    shared = posted.withColumn("low", F.min("grp").over(by_shingle)).withColumn("high", F.max("grp").over(by_shingle))
    lists = shared.filter("low <> high").groupBy("shingle", "grp").agg(*[F.any_value(c).alias(c) for c in ("n", "place")])
    turns = [F.struct(F.xxhash64("grp", F.lit(turn)), "grp", "n", "place") for turn in range(LEADERS)]
    led = lists.select("*", *[F.min(order).over(by_shingle).alias(f"first_{t}") for t, order in enumerate(turns)])

    def able(first: Column) -> Column:
        other = F.col("grp") != first["grp"]
        return other & _may_link(F.col("n"), F.col("place"), first["n"], first["place"], percent)

    leaders = F.array_distinct(
        F.filter(
            F.array(*[F.when(able(F.col(f"first_{t}")), F.col(f"first_{t}.grp")) for t in range(LEADERS)]),
            lambda grp: grp.isNotNull(),
        )
    )
    return led.select("shingle", "grp", "n", "place", leaders.alias("leaders"))


def links(
    docs: DataFrame, known_sets: DataFrame, frequent: tuple[np.ndarray, np.ndarray], size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """(node, component) of the distinct sets that link with another one.

    known_sets: (set_id, n, grp, sketch), one row per distinct set.
    """
    grouped = written(_shared_postings(postings(docs, size, percent, frequent), percent))
    crowded = known_sets.groupBy("grp").agg(F.count("*").alias("k")).filter("k > 1").select("grp")
    named = grouped.select("grp").distinct().union(crowded).distinct()
    members = written(known_sets.join(named, "grp", "left_semi").select("set_id", "grp", "n", "sketch"))
    heads = members.groupBy("grp").agg(F.min("set_id").alias("head"))
    one = members.select(*[F.col(c).alias(f"{c}_a") for c in members.columns])
    two = members.select(*[F.col(c).alias(f"{c}_b") for c in members.columns])
    alike = _sketches_allow(F.col("n_a"), F.col("sketch_a"), F.col("n_b"), F.col("sketch_b"), percent)

    # Members with the head of their group; groups with leaders of each of their shingles.
    pairs = members.join(heads, "grp").filter("set_id <> head").select(F.col("head").alias("a"), F.col("set_id").alias("b"))
    led = grouped.select(F.explode("leaders").alias("ga"), F.col("grp").alias("gb"))
    between = led.groupBy("ga", "gb").agg(F.count("*").alias("common"))
    nearest = F.row_number().over(Window.partitionBy("gb").orderBy(F.desc("common"), "ga"))
    between = between.withColumn("nearest", nearest).filter(F.col("nearest") <= TRIED)
    named = between.join(heads.select(F.col("grp").alias("ga"), F.col("head").alias("a")), "ga").join(
        heads.select(F.col("grp").alias("gb"), F.col("head").alias("b")), "gb"
    )
    pairs = pairs.union(named.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    able = pairs.distinct().join(one, F.col("a") == F.col("set_id_a")).join(two, (F.col("b") == F.col("set_id_b")) & alike)
    found = written(verified(written(able.select("a", "b")), docs, size, percent))
    known = components(found)

    # What still stands apart: every pair of groups that may link, by their members.
    labelled = members.join(known, F.col("set_id") == F.col("node"), "left").select(
        "set_id", "grp", "n", "sketch", F.coalesce("component", "set_id").alias("label")
    )
    labelled = written(labelled)
    spread = labelled.groupBy("grp").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    marked = grouped.select("shingle", "grp", "n", "place").join(spread, "grp")
    several = marked.groupBy("shingle").agg(F.min("low").alias("_low"), F.max("high").alias("_high"))
    open_lists = marked.join(several.filter("_low <> _high").select("shingle"), "shingle")
    # A group of one set carries its sketch, so that the join itself rules pairs out.
    single = labelled.groupBy("grp").agg(
        F.when(F.count("*") == 1, F.any_value("sketch")).alias("sketch")
    )
    open_lists = written(open_lists.join(single, "grp"))
    other = open_lists.select(*[F.col(c).alias(f"o_{c}") for c in open_lists.columns])
    apart = ~((F.col("low") == F.col("high")) & (F.col("o_low") == F.col("o_high")) & (F.col("low") == F.col("o_low")))
    differ = _sketches_allow(F.col("n"), F.col("sketch"), F.col("o_n"), F.col("o_sketch"), percent)
    crossing = open_lists.join(
        other,
        (F.col("shingle") == F.col("o_shingle"))
        & (F.col("grp") < F.col("o_grp"))
        & apart
        & _may_link(F.col("n"), F.col("place"), F.col("o_n"), F.col("o_place"), percent)
        & F.coalesce(differ, F.lit(True)),
    )
    crossing = crossing.select(F.col("grp").alias("ga"), F.col("o_grp").alias("gb")).distinct()
    inside = spread.filter("low <> high").select(F.col("grp").alias("ga"), F.col("grp").alias("gb"))
    one = labelled.select(*[F.col(c).alias(f"{c}_a") for c in labelled.columns])
    two = labelled.select(*[F.col(c).alias(f"{c}_b") for c in labelled.columns])
    expanded = crossing.union(inside).join(one, F.col("ga") == F.col("grp_a")).join(
        two,
        (F.col("gb") == F.col("grp_b"))
        & (F.col("label_a") != F.col("label_b"))
        & ((F.col("ga") != F.col("gb")) | (F.col("set_id_a") < F.col("set_id_b")))
        & alike,
    )
    rest = written(expanded.select(F.col("set_id_a").alias("a"), F.col("set_id_b").alias("b")).distinct())
    if rest.isEmpty():
        return known
    # A few links between two components do: only one of each pair of labels is kept.
    label = labelled.select("set_id", "label")
    more = verified(rest, docs, size, percent)
    more = more.join(label.toDF("a", "label_a"), "a").join(label.toDF("b", "label_b"), "b")
    bridges = more.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")).distinct()
    joined = components(bridges).select(F.col("node").alias("label"), "component")
    return written(
        labelled.select("set_id", "label")
        .join(joined, "label", "left")
        .select(F.col("set_id").alias("node"), F.coalesce("component", "label").alias("component"))
    )


def _joined(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, mark, n, set_id, label, component_id) of every document; label names the
    component, null without words."""
    texts = docs.select("doc_id", "text")
    frequent = frequent_shingles(texts, size)
    sets = written(document_sets(texts, size, percent, frequent))
    smallest = (
        sets.filter("n > 0")
        .groupBy("set_id", "check", "n", "grp")
        .agg(F.min("doc_id").alias("low"), F.any_value("sketch").alias("sketch"))
    )
    smallest = written(smallest.select("set_id", "n", "grp", "low", "sketch"))
    found = links(texts, smallest, frequent, size, percent)
    labels = smallest.join(found, F.col("set_id") == F.col("node"), "left").select(
        "set_id", "low", F.coalesce("component", "set_id").alias("label")
    )
    least = labels.groupBy("label").agg(F.min("low").alias("component_id"))
    named = labels.join(least, "label").select(F.col("set_id").alias("_set"), "label", "component_id")
    joined = sets.join(named, (F.col("set_id") == F.col("_set")) & (F.col("n") > 0), "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "mark", "n", "label", own.alias("component_id"))


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document.

    Documents link when 100 |A and B| >= percent |A or B|. component_id is the smallest
    doc_id reachable by links. Null texts and texts without words link with nothing:
    their own doc_id. Fewer words than a shingle form one shingle. Rows of equal text
    link, whatever their ids; null ids link too but name no component unless it has no
    other id. Other columns are ignored.
    """
    return _joined(docs, size, percent).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def drop_near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of each component, that of the smallest doc_id (null last; of equal ids
    the one with the smallest fingerprint of its text); all columns as they are, whatever
    their names.

    Rows without words are no one's duplicates and stay, repeated or not.
    """
    groups = written(_joined(docs, size, percent))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "mark")
    first = groups.filter("n > 0").groupBy("label").agg(F.min(order).alias("first"))
    kept = first.select(F.col("first.doc_id").alias("_id"), F.col("first.mark").alias("_mark"), F.lit(True).alias("_one"))
    blank = groups.filter("n = 0").select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), F.lit(False).alias("_one"))
    chosen = kept.union(blank.distinct())
    places = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    own_id, own_text = F.col(places["doc_id"]), F.col(places["text"])
    renamed = docs.select(*[F.col(f"`{c}`").alias(place) for c, place in places.items()])
    marked = renamed.withColumn("_text", F.xxhash64(own_text))
    joined = marked.join(chosen, own_id.eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_mark")))
    again = F.row_number().over(Window.partitionBy(own_id, "_text").orderBy(F.lit(1)))
    kept = joined.withColumn("_again", again).filter("_again = 1 OR NOT _one")
    return kept.select(*[F.col(place).alias(c) for c, place in places.items()])
