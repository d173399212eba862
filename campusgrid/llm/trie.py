"""Conversation prefix trie by van Emde Boas recursion.

Sequences of turns are cut at half depth. The name of a cut prefix is a fingerprint of
where it begins and what it holds; what follows belongs to the forest of that name. The
upper part and all lower ones are cut again in the same step, at a quarter of the depth,
and so on down to single turns, whose names are the trie's nodes. Names depend on
content only, so equal prefixes of different conversations meet without being compared.

Each turn remembers the cuts below which it lies, and those that it lies right above. A
lower forest's totals are summed per cut and grafted on every node of the upper part
that leads to the cut. Any node and any descendant of it are parted by exactly one cut,
so one sum per cut and one per node give the totals of all subtrees.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campusgrid.llm.common import written

#: Turns that are cut in one row; longer sequences are cut between blocks of as many first.
BLOCK = 1024
#: Rows of one conversation that a single task numbers at most.
TASK_ROWS = 100_000
#: Turns of a base conversation that others may begin with.
SHARED_TURNS = 5
#: Bytes of joined ids per row before they are hashed.
JOINED_BYTES = 1_000_000

_BYTES = 16


def _root() -> Column:
    return F.unhex(F.lit("00" * _BYTES))


def _name(*parts: Column) -> Column:
    """128 bits that stand for parts of fixed or told length."""
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 2 * _BYTES))


def _turn_name(role: Column, text: Column) -> Column:
    return _name(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))


def numbered(rows: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """The rows (conv_id, turn, name, ...) with `pos`, from 1 in each conversation, by turn
    (null first) and then by name.

    A conversation of more than `task_rows` rows is sorted by ranges over many tasks, whose
    counts are summed up to give each range its first number.
    """
    order = ("turn", "name")
    sizes = rows.groupBy("conv_id").agg(F.count("*").alias("n")).filter(F.col("n") > task_rows)
    long = written(sizes.select(F.col("conv_id").alias("_long")))
    one = Window.partitionBy("conv_id").orderBy(*order)
    if long.isEmpty():
        return rows.withColumn("pos", F.row_number().over(one).cast("bigint"))
    short = rows.join(long, F.col("conv_id") == F.col("_long"), "left_anti")
    short = short.withColumn("pos", F.row_number().over(one).cast("bigint"))
    hot = rows.join(long, F.col("conv_id") == F.col("_long"), "left_semi")
    placed = hot.repartitionByRange("conv_id", *order).sortWithinPartitions("conv_id", *order)
    placed = written(placed.withColumn("at", F.monotonically_increasing_id())).withColumn("slot", F.shiftright("at", 33))
    slots = placed.groupBy("conv_id", "slot").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first") + 1
    slots = slots.select(F.col("conv_id").alias("_c"), F.col("slot").alias("_s"), shift.alias("shift"))
    hot = placed.join(slots, (F.col("conv_id") == F.col("_c")) & (F.col("slot") == F.col("_s")))
    return short.unionByName(hot.withColumn("pos", F.col("at") + F.col("shift")).select(*short.columns))


def rebuilt(turns: DataFrame, task_rows: int = TASK_ROWS) -> tuple[DataFrame, DataFrame]:
    """Every conversation, begun as its base begins: (conv_id), and (conv_id, pos, name,
    chars), written.

    The first h turns come from conversation c - c % 100, if there is one; h is crc32 of
    the id as text, modulo 6. The conversation's own follow from its turn h + 1 on. % has
    the sign of c. Null roles and texts are empty; rows without conv_id are no
    conversation and are ignored, as are other columns.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint"), F.col("turn"), _turn_name(role, text).alias("name"), F.length(text).cast("bigint").alias("chars")
    )
    own = written(numbered(written(rows), task_rows))
    convs = own.select("conv_id").distinct()
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (SHARED_TURNS + 1)
    convs = convs.withColumn("h", taken).withColumn("base", F.col("conv_id") - F.col("conv_id") % 100)
    heads = own.filter((F.col("pos") <= SHARED_TURNS) & (F.col("conv_id") % 100 == 0))
    heads = heads.groupBy(F.col("conv_id").alias("_base")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "name", "chars"))).alias("head")
    )
    convs = convs.join(heads, F.col("base") == F.col("_base"), "left")
    given = F.coalesce(F.slice("head", 1, F.col("h").cast("int")), F.array().cast("array<struct<pos:bigint,name:binary,chars:bigint>>"))
    convs = written(convs.select("conv_id", "h", F.when(F.col("h") > 0, given).alias("head")))
    shared = convs.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.*")
    shift = (F.coalesce(F.size("head"), F.lit(0)) - F.col("h")).alias("shift")
    moved = own.join(convs.select(F.col("conv_id").alias("_c"), "h", shift), F.col("conv_id") == F.col("_c"))
    rest = moved.filter(F.col("pos") > F.col("h")).select("conv_id", (F.col("pos") + F.col("shift")).alias("pos"), "name", "chars")
    return convs.select("conv_id"), written(shared.unionByName(rest))


def _cut(pieces: DataFrame, longest: int) -> DataFrame:
    """The recursion: pieces (forest, upto, below, above, items: array of structs with
    `name`, ...) come out with one item each.

    forest: name of the prefix a piece stands behind. upto: name of the prefix it ends,
    null while it ends within a half. below: cuts it lies below; above: cuts it lies
    right above. All pieces of a step are cut alike; nothing is shuffled.
    """
    others = [c for c in pieces.columns if c not in ("forest", "upto", "below", "above", "items")]
    if longest == 1:
        return pieces.withColumn("upto", F.coalesce("upto", _name(F.col("forest"), _content(F.col("items")))))
    half = 1 << ((longest - 1).bit_length() - 1)
    whole = F.size("items") == 2 * half
    # The whole trie's end, for a sequence that fills it.
    first = F.when(F.col("upto").isNull() & whole, _name(F.col("forest"), _content(F.col("items")))).otherwise(F.col("upto"))
    pieces = pieces.withColumn("upto", first)
    while True:
        upper, lower = F.slice("items", 1, half), F.slice("items", half + 1, half)
        size = F.size("items")
        cut = F.when(size >= half, _name(F.col("forest"), _content(upper)))
        marked = pieces.withColumn("cut", cut)
        named = F.array(F.col("cut"))
        up = F.struct(
            F.col("forest"),
            F.col("cut").alias("upto"),
            F.col("below"),
            F.when(size > half, F.concat("above", named)).otherwise(F.col("above")).alias("above"),
            upper.alias("items"),
        )
        down = F.struct(
            F.col("cut").alias("forest"),
            F.when(size == 2 * half, F.col("upto")).alias("upto"),
            F.concat("below", named).alias("below"),
            F.col("above"),
            lower.alias("items"),
        )
        parts = F.explode(F.when(size > half, F.array(up, down)).otherwise(F.array(up)))
        pieces = marked.select(*others, parts.alias("p")).select(*others, "p.*")
        if half == 1:
            return pieces
        half //= 2


def _content(items: Column) -> Column:
    """The names of some items behind each other; each has as many bytes."""
    return F.unhex(F.array_join(F.transform(items, lambda t: F.hex(t["name"])), ""))


def paths(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, depth, node, parent, chars, below, above) of every turn (conv_id, pos, name,
    chars): the trie's node it stands for, and the cuts around it."""
    placed = turns.withColumn("block", F.floor((F.col("pos") - 1) / block))
    blocks = placed.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list(F.struct("pos", "name", "chars"))).alias("items"))
    blocks = written(blocks)
    most = blocks.agg(F.max("block").alias("most"), F.max(F.size("items")).alias("longest")).first()
    none = F.array().cast("array<binary>")
    if most["most"]:
        # Sequences of blocks are cut first; a block is one item of theirs.
        named = blocks.select("conv_id", "block", _name(_content(F.col("items"))).alias("name"), F.size("items").alias("n"))
        rows = named.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("block", "name", "n"))).alias("items"))
        rows = rows.withColumns({"forest": _root(), "upto": F.lit(None).cast("binary"), "below": none, "above": none})
        tops = _cut(rows, most["most"] + 1).withColumn("one", F.col("items")[0])
        tops = tops.select(
            F.col("conv_id").alias("_c"),
            F.col("one.block").alias("_b"),
            "forest",
            # Only a full block ends where others may go on.
            F.when(F.col("one.n") == block, F.col("upto")).alias("upto"),
            "below",
            "above",
        )
        pieces = blocks.join(tops, (F.col("conv_id") == F.col("_c")) & (F.col("block") == F.col("_b"))).drop("_c", "_b")
        longest = block
    else:
        pieces = blocks.withColumns({"forest": _root(), "upto": F.lit(None).cast("binary"), "below": none, "above": none})
        longest = most["longest"] or 1
    single = _cut(pieces.drop("block"), longest).withColumn("one", F.col("items")[0])
    return single.select(
        "conv_id",
        F.col("one.pos").alias("depth"),
        F.col("upto").alias("node"),
        F.col("forest").alias("parent"),
        F.col("one.chars").alias("chars"),
        "below",
        "above",
    )


def _joined_hashes(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of (node, conv_id): the ids in ascending order, comma-joined.

    Ids are sorted by ranges and joined in portions, so that a node where very many
    conversations end is dealt over tasks; its portions are then hashed in order, as a
    stream.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, first, found, size = None, None, [], 0
        out: list[tuple] = []

        def portion():
            if found:
                out.append((at, first, ",".join(found)))

        def sent():
            nodes, firsts, ids = zip(*out) if out else ((), (), ())
            out.clear()
            columns = [pa.array(nodes, pa.binary()), pa.array(firsts, pa.int64()), pa.array(ids, pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=["node", "first", "ids"])

        for batch in batches:
            for node, conv in zip(*[column.to_pylist() for column in batch.columns]):
                if node != at or size > JOINED_BYTES:
                    portion()
                    at, first, found, size = node, conv, [], 0
                found.append(str(conv))
                size += len(found[-1]) + 1
            yield sent()
        portion()
        yield sent()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest = None, None
        out: list[tuple] = []

        def sent():
            nodes, digests = zip(*out) if out else ((), ())
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(digests, pa.string())], names=["node", "ends"])

        for batch in batches:
            for node, _, ids in zip(*[column.to_pylist() for column in batch.columns]):
                if node != at:
                    if digest is not None:
                        out.append((at, digest.hexdigest()))
                    at, digest = node, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield sent()
        if digest is not None:
            out.append((at, digest.hexdigest()))
        yield sent()

    ranged = ends.select("node", "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    portions = ranged.mapInArrow(join, "node binary, first bigint, ids string")
    whole = portions.repartition("node").sortWithinPartitions("node", "first")
    return whole.mapInArrow(hashed, "node binary, ends string")


def trie(convs: DataFrame, turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per distinct prefix of the conversations (conv_id) with turns (conv_id, pos
    from 1, name, chars), the empty one at the root included:

    node, its name; conv_id, smallest member; depth; parent_conv_id; n_convs, members;
    n_children; n_leaves, childless nodes in the subtree; saved_tokens, summed over the
    subtree, each node's (n_convs - 1) times the code points of its last text; and
    ends_sha256 of the members that end there.

    A conversation without turns is a member of the root only. No conversations, no rows.
    """
    path = written(paths(turns, block))
    nodes = path.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        *[F.any_value(c).alias(c) for c in ("depth", "parent", "chars", "below")],
    )
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    root = root.select(
        _root().alias("node"), "conv_id", "n_convs", F.lit(0).cast("bigint").alias("depth"), F.lit(None).cast("binary").alias("parent"),
        F.lit(0).cast("bigint").alias("chars"), F.array().cast("array<binary>").alias("below"),
    )
    nodes = written(nodes.unionByName(root))
    children = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("_p")).agg(F.count("*").alias("n_children"))
    counted = nodes.join(children, F.col("node") == F.col("_p"), "left").drop("_p")
    counted = counted.withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    counted = counted.withColumn("leaf", (F.col("n_children") == 0).cast("bigint")).withColumn("saved", (F.col("n_convs") - 1) * F.col("chars"))
    counted = written(counted)

    # Totals of the lower forest of each cut, grafted on the nodes above the cut.
    forests = counted.select(F.explode("below").alias("cut"), "leaf", "saved").groupBy("cut")
    forests = forests.agg(F.sum("leaf").alias("leaves"), F.sum("saved").alias("saved"))
    leading = path.select("node", F.explode("above").alias("_cut")).distinct()
    grafted = leading.join(forests, F.col("cut") == F.col("_cut"))
    # The root leads to every node.
    total = counted.agg(F.sum("leaf").alias("leaves"), F.sum("saved").alias("saved")).select(_root().alias("node"), "leaves", "saved")
    own = counted.filter("parent IS NOT NULL").select("node", F.col("leaf").alias("leaves"), "saved")
    every = own.union(total).union(grafted.select("node", "leaves", "saved"))
    sums = every.groupBy(F.col("node").alias("_n")).agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))

    last = path.groupBy("conv_id").agg(F.max_by("node", "depth").alias("node"))
    ends = convs.join(last.withColumnRenamed("conv_id", "_c"), F.col("conv_id") == F.col("_c"), "left")
    ends = written(_joined_hashes(ends.select(F.coalesce("node", _root()).alias("node"), "conv_id")))
    parents = nodes.select(F.col("node").alias("_parent"), F.col("conv_id").alias("parent_conv_id"))
    out = counted.drop("saved", "leaf", "below", "chars").join(sums, F.col("node") == F.col("_n"))
    out = out.join(ends.withColumnRenamed("node", "_e"), F.col("node") == F.col("_e"), "left")
    out = out.join(parents, F.col("parent") == F.col("_parent"), "left")
    return out.select(
        "node",
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


#: DuckDB's text of `trie(*rebuilt(conversations))` without `node`. It has no crc32, so that is
#: spelt out.
TRIE_SQL = """
WITH crc AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8),
    lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS tbl),
convs AS (SELECT conv_id, conv_id - conv_id % 100 AS base, xor(list_reduce(
    list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT)),
    lambda a, b: xor(a >> 8, tbl[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL), crc),
named AS (SELECT conv_id, turn, length(coalesce(text, '')) AS chars,
    left(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 32) AS name
  FROM conversations),
own AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, name) AS pos FROM named),
seq AS (SELECT c.conv_id, 0 AS part, pos, name, chars FROM convs c JOIN own o ON o.conv_id = c.base AND o.pos <= h
  UNION ALL SELECT c.conv_id, 1, pos, name, chars FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.pos > h),
keyed AS (SELECT conv_id, chars, row_number() OVER w AS depth, md5(string_agg(name, '') OVER w) AS key
  FROM seq WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)),
path AS (SELECT conv_id, depth, chars, key, lag(key, 1, 'root') OVER (PARTITION BY conv_id ORDER BY depth) AS parent FROM keyed
  UNION ALL SELECT conv_id, 0, 0, 'root', NULL FROM convs),
nodes AS (SELECT key, any_value(parent) AS parent, any_value(depth) AS depth, any_value(chars) AS chars,
    min(conv_id) AS conv_id, count(*) AS n_convs FROM path GROUP BY key),
kids AS (SELECT parent AS key, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY 1),
sums AS (SELECT p.key, count(*) FILTER (WHERE k.key IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.chars) AS saved_tokens
  FROM nodes n LEFT JOIN kids k USING (key) JOIN path p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY 1),
ends AS (SELECT key, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends
  FROM (SELECT conv_id, arg_max(key, depth) AS key FROM path GROUP BY 1) GROUP BY 1)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM nodes n JOIN sums USING (key) LEFT JOIN kids USING (key) LEFT JOIN ends USING (key) LEFT JOIN nodes up ON up.key = n.parent
"""
