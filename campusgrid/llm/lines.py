"""Line dedup with a log-template tree, in DataFrame operations only.

Each line goes down a tree of fixed depth: by its number of tokens, then by its
leading tokens, where a token with a digit is a variable field. A leaf has a template if
at most positions one token covers most occurrences; the others are variable fields too.
The lines that agree with it at most positions are of that template. The others, and the
lines of a leaf that is too mixed, are parted and looked at again, a fixed number of
times, since a leaf may hold several templates. Templates that
recur across documents are dropped. Exact copies of a text count as one document
everywhere, so that copies alone neither make a text's own lines recur nor shape a template.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campusgrid.llm.common import written

#: Leading tokens that the tree looks at.
DEPTH = 4
#: Documents a template must occur in.
MIN_DOCUMENTS = 10
#: Least share of constant positions in a template.
SIMILARITY = 0.7
#: Least share of a leaf's occurrences that the token of a constant position covers.
COVERED = 0.8
#: Times a leaf is looked at: whole, then its parts.
PARTS = 4

FIELD = "<*>"


@dataclass(frozen=True)
class Tree:
    depth: int = DEPTH
    min_documents: int = MIN_DOCUMENTS
    similarity: float = SIMILARITY
    covered: float = COVERED
    parts: int = PARTS


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def plain(line: Column) -> Column:
    """Tokens joined by single blanks. A single blank stays as it is, so it needs no replacement."""
    return F.trim(F.regexp_replace(line, r"[\x09-\x0D ]{2,}|[\x09-\x0D]", " "))


def masked(line: Column) -> Column:
    """A plain line with the tokens that hold a digit as fields."""
    field = F.regexp_replace(line, r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*", FIELD)
    return F.when(line.rlike("[0-9]"), field).otherwise(line)


def _tokens(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def _leaf(line: Column, depth: int) -> Column:
    return F.xxhash64(_tokens(line), F.substring_index(line, " ", depth))


def _masked_lines(docs: DataFrame, *keep: str) -> DataFrame:
    """The `keep` columns, `pos` and `masked` of every line that isn't blank, masked once."""
    lines = docs.select(*keep, F.posexplode(lines_of(F.col("text"))).alias("pos", "raw"))
    # A filter on what is masked would mask it twice.
    filled = lines.filter(F.trim(F.col("raw"), F.lit(" \t\n\x0b\x0c\r")) != "")
    plain_lines = filled.select(*keep, "pos", plain(F.col("raw")).alias("plain"))
    return plain_lines.select(*keep, "pos", masked(F.col("plain")).alias("masked"))


def _coded(masks: DataFrame, depth: int, *keep: str) -> DataFrame:
    return masks.select(*keep, F.xxhash64("masked").alias("line"), _leaf(F.col("masked"), depth).alias("leaf"))


def _templates(kinds: DataFrame, tree: Tree) -> DataFrame:
    """(leaf, line, template) of the lines that a template of their leaf covers, from (leaf,
    line, masked, n) of the mixed leaves.

    A group of lines that is too mixed is parted by the token at the place where tokens
    that may recur cover most; the lines that a group's template doesn't cover become a
    group of their own. So a leaf may hold several templates.
    """
    open_lines, found = kinds.withColumn("grp", F.col("leaf")), []
    same_place = [F.col("grp") == F.col("_grp"), F.col("at") == F.col("pos"), F.col("own") == F.col("col")]
    for part in range(tree.parts):
        own = F.split("masked", " ")
        tokens = open_lines.select("grp", "n", F.posexplode(own)).groupBy("grp", "pos", "col").agg(F.sum("n").alias("n"))
        tokens = written(tokens)
        often = F.col("n") >= tree.min_documents
        places = tokens.groupBy("grp", "pos").agg(
            F.max(F.struct("n", "col")).alias("top"), F.sum("n").alias("n"), F.sum(F.when(often, F.col("n"))).alias("often")
        )
        constant = F.col("top.n") >= tree.covered * F.col("n")
        groups = places.groupBy(F.col("grp").alias("_grp")).agg(
            (F.avg(constant.cast("int")) >= tree.similarity).alias("one"),
            F.array_sort(F.collect_list(F.struct("pos", F.when(constant, F.col("top.col")).alias("token")))).alias("places"),
            F.max(F.when(~constant & F.col("often").isNotNull(), F.struct("often", (-F.col("pos")).alias("before")))).alias("best"),
            F.max("n").alias("size"),
        )
        agreeing = F.zip_with(own, F.col("places.token"), lambda word, token: word.eqNullSafe(token))
        alike = F.size(F.filter(agreeing, lambda same: same)) >= tree.similarity * F.size("places")
        judged = open_lines.join(groups.filter(F.col("size") >= tree.min_documents), F.col("grp") == F.col("_grp")).drop("_grp")
        judged = written(judged.withColumn("alike", F.col("one") & alike))
        found.append(judged.filter("alike").select("leaf", "line", F.col("grp").alias("template")))
        if part == tree.parts - 1:
            break
        names = ("leaf", "line", "masked", "n")
        rest = judged.filter("one AND NOT alike").select(*names, F.xxhash64("grp", F.lit("rest")).alias("grp"))
        mixed = judged.filter("NOT one AND best IS NOT NULL").select(*names, "grp", (-F.col("best.before")).alias("at"))
        mixed = mixed.withColumn("own", F.get(own, F.col("at")))
        shared = tokens.filter(often).select(F.col("grp").alias("_grp"), "pos", "col")
        mixed = mixed.join(shared, same_place, "left_semi").select(*names, F.xxhash64("grp", "at", "own").alias("grp"))
        open_lines = rest.union(mixed)
    return reduce(DataFrame.union, found)


def recurring_lines(docs: DataFrame, tree: Tree = Tree()) -> DataFrame:
    """(_id, _key, pos) of the lines that a recurring template covers: a document's id, the
    fingerprint of its text, the line's place from 0.

    All texts are masked once, and lines go on as fingerprints. A template counts once per
    distinct text and masked line. Tokens are looked at in the mixed leaves that may
    recur only: there, one text per line is read again.
    """
    rows = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_key"), "text")
    lines = written(_coded(_masked_lines(rows, "_id", "_key"), tree.depth, "_id", "_key", "pos"))
    each = lines.groupBy("_key", "line", "leaf").agg(F.lit(1).alias("_one"))
    counted = written(each.groupBy("leaf", "line").agg(F.count("*").alias("n"), F.min("_key").alias("_from")))
    leaves = counted.groupBy("leaf").agg(F.sum("n").alias("leaf_n"), F.count("*").alias("kinds"))
    leaves = leaves.filter(F.col("leaf_n") >= tree.min_documents)
    open_lines = written(counted.join(leaves.select("leaf", "kinds"), "leaf"))
    mixed = open_lines.filter("kinds > 1").select(F.col("leaf").alias("_leaf"), F.col("line").alias("_line"), "n", "_from")
    read = rows.select("_key", "text").join(mixed.select(F.col("_from").alias("_k")).distinct(), F.col("_key") == F.col("_k"), "left_semi")
    coded = _coded(_masked_lines(read, "_key"), tree.depth, "_key", "masked")
    kinds = coded.join(mixed, (F.col("leaf") == F.col("_leaf")) & (F.col("line") == F.col("_line")) & (F.col("_key") == F.col("_from")))
    kinds = kinds.groupBy("leaf", "line").agg(F.any_value("masked").alias("masked"), F.any_value("n").alias("n"))
    covered = _templates(written(kinds), tree)
    single = F.when(F.col("kinds") == 1, F.col("leaf"))
    judged = open_lines.join(covered, ["leaf", "line"], "left")
    judged = written(judged.select("leaf", "line", "n", F.coalesce("template", single).alias("template")))
    totals = judged.groupBy("template").agg(F.sum("n").alias("total")).filter(F.col("total") >= tree.min_documents)
    together = judged.join(totals.filter("template IS NOT NULL"), "template", "left_semi").select("line", "leaf")
    alone = judged.filter(F.col("template").isNull() & (F.col("n") >= tree.min_documents)).select("line", "leaf")
    return lines.join(together.union(alone), ["line", "leaf"], "left_semi").select("_id", "_key", "pos")


def drop_recurring(docs: DataFrame, tree: Tree = Tree(), counts: tuple[str, str] = ("n_lines", "n_dropped")) -> DataFrame:
    """All columns of all documents, `text` without lines of recurring templates, and two
    columns more, named by `counts`: the lines a text had and those dropped.

    All such lines go, also if they are all that a document has. Null texts stay null
    with 0 lines. Rows with equal id and text get the same result; null ids are like any
    other. An empty table gives an empty one. Other columns are untouched, whatever their
    names; one named as in `counts` is replaced.
    """
    own = [c for c in docs.columns if c not in counts]
    places = {c: f"c{i}" for i, c in enumerate(own)}
    hit = recurring_lines(docs.select("doc_id", "text"), tree).groupBy("_id", "_key").agg(F.collect_set("pos").alias("_hit"))
    renamed = docs.select(*[F.col(f"`{c}`").alias(place) for c, place in places.items()])
    text = F.col(places["text"])
    same = F.col(places["doc_id"]).eqNullSafe(F.col("_id")) & (F.xxhash64(text) == F.col("_key"))
    joined = renamed.join(hit, same, "left").withColumn("_lines", lines_of(text))
    # Places by a set difference, so that a text of very many lines takes time in proportion.
    size = F.size("_lines")
    left = F.array_except(F.sequence(F.lit(0), size - 1), F.col("_hit"))
    clean = F.array_join(F.transform(left, lambda place: F.get(F.col("_lines"), place)), "\n")
    some = F.col("_hit").isNotNull()
    return joined.select(
        *[(F.when(some, clean).otherwise(text) if c == "text" else F.col(place)).alias(c) for c, place in places.items()],
        F.when(text.isNull(), 0).otherwise(size).cast("bigint").alias(counts[0]),
        F.when(some, F.size("_hit")).otherwise(0).cast("bigint").alias(counts[1]),
    )


def drop_recurring_sql(docs: str, tree: Tree = Tree()) -> str:
    """DuckDB common table expressions that end in `lined`: doc_id, text, n_lines, n_dropped."""
    covered, similar, least = (f"CAST({x} AS DOUBLE)" for x in (tree.covered, tree.similarity, tree.min_documents))
    first = "SELECT m, toks, n, k || '|' || array_to_string(lead, ' ') AS grp FROM lined3 JOIN lined4 USING (k, lead) WHERE kinds > 1"
    rounds = "\n".join(
        f"""open{r} AS ({first if r == 0 else f"""
    SELECT m, toks, n, grp || '|rest' AS grp FROM judged{r - 1} WHERE one AND NOT alike
    UNION ALL SELECT m, toks, n, grp || '|' || spot || ' ' || toks[spot + 1] FROM judged{r - 1} j WHERE NOT one
      AND EXISTS (SELECT 1 FROM tokens{r - 1} t WHERE t.grp = j.grp AND p = spot AND tok = toks[spot + 1] AND t.n >= {least})"""}),
tokens{r} AS (SELECT grp, p, tok, sum(n) AS n
    FROM (SELECT grp, n, unnest(toks) AS tok, unnest(range(len(toks))) AS p FROM open{r}) GROUP BY grp, p, tok),
places{r} AS (SELECT grp, p, arg_max(tok, (n, tok)) AS tok, max(n) >= {covered} * sum(n) AS fixed, sum(n) AS n,
    sum(n) FILTER (WHERE n >= {least}) AS often FROM tokens{r} GROUP BY grp, p),
groups{r} AS (SELECT grp, count(*) FILTER (WHERE fixed) / count(*) >= {similar} AS one,
    list(CASE WHEN fixed THEN tok END ORDER BY p) AS places,
    arg_max(p, (often, -p)) FILTER (WHERE NOT fixed AND often IS NOT NULL) AS spot
    FROM places{r} GROUP BY grp HAVING max(n) >= {least}),
judged{r} AS (SELECT *, one AND len(list_filter(list_zip(toks, places), lambda z: z[1] IS NOT DISTINCT FROM z[2]))
    >= {similar} * len(toks) AS alike FROM open{r} JOIN groups{r} USING (grp)),"""
        for r in range(tree.parts)
    )
    found = " UNION ALL ".join(f"SELECT m, grp AS template FROM judged{r} WHERE alike" for r in range(tree.parts))
    return f"""
lined0 AS (SELECT *, row_number() OVER () AS rid,
    CASE WHEN text IS NULL THEN []::VARCHAR[] ELSE string_split(text, chr(10)) END AS raw FROM {docs}),
lined1 AS (SELECT *, list_transform(raw, lambda l: list_aggregate(list_transform(
    list_filter(regexp_split_to_array(l, '[\\x09-\\x0D ]+'), lambda t: t <> ''),
    lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '{FIELD}' ELSE t END), 'string_agg', ' ')) AS masks FROM lined0),
lined2 AS (SELECT m, string_split(m, ' ') AS toks, count(*) AS n
    FROM (SELECT DISTINCT text, unnest(masks) AS m FROM lined1) WHERE m IS NOT NULL GROUP BY m),
lined3 AS (SELECT *, len(toks) AS k, toks[1:{tree.depth}] AS lead FROM lined2),
lined4 AS (SELECT k, lead, count(*) AS kinds FROM lined3 GROUP BY k, lead HAVING sum(n) >= {least}),
{rounds}
lined8 AS (SELECT k, lead, m, n, CASE WHEN kinds = 1 THEN k || '|' || array_to_string(lead, ' ') ELSE template END AS template
    FROM lined3 JOIN lined4 USING (k, lead) LEFT JOIN ({found}) USING (m)),
lined9 AS (SELECT template FROM lined8 WHERE template IS NOT NULL GROUP BY template HAVING sum(n) >= {least}),
lined10 AS (SELECT m FROM lined8 JOIN lined9 USING (template)
    UNION ALL SELECT m FROM lined8 WHERE template IS NULL AND n >= {least}),
lined11 AS (SELECT rid, list(line ORDER BY i) FILTER (WHERE hit IS NULL) AS clean, count(hit) AS hits
    FROM (SELECT rid, unnest(raw) AS line, unnest(masks) AS m, unnest(range(len(raw))) AS i FROM lined1) x
    LEFT JOIN (SELECT m AS hit FROM lined10) y ON x.m = y.hit GROUP BY rid),
lined AS (SELECT a.* EXCLUDE (rid, raw, masks, text),
    CASE WHEN hits > 0 THEN coalesce(array_to_string(clean, chr(10)), '') ELSE text END AS text,
    CAST(len(raw) AS BIGINT) AS n_lines, CAST(coalesce(hits, 0) AS BIGINT) AS n_dropped
  FROM lined1 a LEFT JOIN lined11 b USING (rid))"""
