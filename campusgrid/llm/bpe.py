"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For every prefix of a piece there is exactly one token that can end its encoding.
`PrefixEncoder` keeps that last token per prefix: the encoding is read off from
the end, bytes are appended without touching what is there, and after an edit only the
prefixes near it are looked at again.
"""

from __future__ import annotations

import base64
import hashlib
import weakref
from array import array
from collections.abc import Iterable, Iterator
from itertools import pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space as Unicode defines it; the `\s` of the tokenizers' patterns.
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Bytes that a task's caches hold, together and roughly, and pairs of tokens it remembers.
#: Results don't depend on them.
CACHE_BYTES = 75_000_000
PAIR_ENTRIES = 250_000
#: Bytes that Python needs for an entry besides its contents.
ENTRY_BYTES = 180
#: Bytes of text that a task looks through for new words at once; then it sends its results on.
PORTION_BYTES = 1_000_000
#: Characters of a long text that are coded at a time.
SECTION = 1_000_000
#: Of pieces up to SHORT bytes, AT_ONCE of one length are coded at once; of FEW for each byte or
#: less, and of longer pieces, each is coded by itself. 2 ** PAIR_BITS pairs of tokens have places.
SHORT, AT_ONCE, FEW, PAIR_BITS = 32, 8192, 4, 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks from a file with one `base64 rank` pair per line."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}


class Vocabulary:
    """Tokens, how each is put together, and which tokens may stand side by side."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self._finder: ahocorasick.Automaton | None = None
        self.longest = max(map(len, ranks), default=1)
        self._reached: dict[bytes, int] | None = None
        self._parts: dict[int, tuple[int, int] | None] = {}
        self.known_pairs: dict[int, bool] = {}

    def parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens that merge into this one; None for single bytes and for
        tokens that merging never reaches."""
        if token not in self._parts:
            data = self.tokens[token]
            pieces = [data[i : i + 1] for i in range(len(data))]
            while len(pieces) > 2:
                rank, at = min(
                    (self.ranks.get(a + b, token), i) for i, (a, b) in enumerate(zip(pieces, pieces[1:]))
                )
                if rank >= token:
                    break
                pieces[at : at + 2] = [pieces[at] + pieces[at + 1]]
            known = len(pieces) == 2 and all(p in self.ranks for p in pieces)
            self._parts[token] = (self.ranks[pieces[0]], self.ranks[pieces[1]]) if known else None
        return self._parts[token]

    def reached(self) -> dict[bytes, int]:
        """The tokens that merging reaches."""
        if self._reached is None:
            self._reached = {t: r for t, r in self.ranks.items() if len(t) == 1 or self.parts(r) is not None}
        return self._reached

    def finder(self) -> ahocorasick.Automaton:
        """Finds every token that merging reaches, at every place of a text (bytes as Latin-1)."""
        if self._finder is None:
            self._finder = ahocorasick.Automaton()
            for token, rank in self.reached().items():
                self._finder.add_word(token.decode("latin-1"), (rank, len(token)))
            self._finder.make_automaton()
        return self._finder

    def fits(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both ends with exactly these two tokens.

        Time runs backwards: the side that merged last is taken apart. While two
        edges stand side by side, a token made of them would have been merged if
        its rank came before the next merge of either; of equal ranks, the one
        further left goes first.
        """
        key = left << 32 | right
        if key not in self.known_pairs:
            if len(self.known_pairs) > PAIR_ENTRIES:
                self.known_pairs.clear()
            self.known_pairs[key] = self._survives(left, right)
        return self.known_pairs[key]

    def _survives(self, left: int, right: int) -> bool:
        left_ends = right_ends = len(self.ranks) + 1
        while True:
            across = self.ranks.get(self.tokens[left] + self.tokens[right])
            if across is not None and across < left_ends and across <= right_ends:
                return False
            left_parts, right_parts = self.parts(left), self.parts(right)
            if left_parts is None and right_parts is None:
                return True
            if right_parts is None or (left_parts is not None and left > right):
                left_ends, left = left, left_parts[1]
            else:
                right_ends, right = right, right_parts[0]


class PrefixEncoder:
    """The encoding of one piece that can grow and change."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b"") -> None:
        self.vocabulary = vocabulary
        self.data = b""
        self.last: list[int] = []
        self.append(data)

    def append(self, data: bytes) -> None:
        """Exact: what is stored for earlier prefixes stays right."""
        self.data += data
        self._extend([], 0, 0)

    def replace(self, start: int, end: int, data: bytes) -> None:
        """Bytes start to end become `data`. Prefixes before them are kept, and so are those
        behind them as soon as they end as before: a last token depends on the tokens and
        bytes of `longest` places only, so as many equal ones in a row mean that the rest
        is equal too."""
        old, self.last = self.last, self.last[:start]
        self.data = self.data[:start] + data + self.data[end:]
        self._extend(old, start + len(data), len(data) - (end - start))

    def _extend(self, old: list[int], equal_from: int, shift: int) -> None:
        """Last tokens for all bytes that have none. `old`: those of an earlier text, whose
        bytes are the same from `equal_from` on, `shift` places before."""
        v, last = self.vocabulary, self.last
        done, same = len(last), 0
        from_ = max(0, done - v.longest + 1)
        known, fits = v.known_pairs, v.fits
        for at, (token, length) in v.finder().iter(self.data[from_:].decode("latin-1")):
            if from_ + at != done:
                continue  # that prefix has its last token
            before = done + 1 - length
            if before:
                left = last[before - 1]
                fit = known.get(left << 32 | token)
                if not (fits(left, token) if fit is None else fit):
                    continue
            last.append(token)
            done += 1
            if old and done > equal_from:
                same = same + 1 if old[done - 1 - shift] == token else 0
                if same == v.longest:
                    last += old[done - shift :]
                    return
        if len(last) != len(self.data):
            raise ValueError("the vocabulary lacks a byte of the text")

    def ids(self) -> list[int]:
        """The tokens, read from the end; a piece that is a token is that token."""
        if self.data in self.vocabulary.ranks:
            return [self.vocabulary.ranks[self.data]]
        found, end = [], len(self.data)
        while end:
            found.append(self.last[end - 1])
            end -= len(self.vocabulary.tokens[found[-1]])
        return found[::-1]


def _places(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where keys lie in a table of 2 ** bits places."""
    return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int64)


class BatchEncoder:
    """The last tokens of many pieces at once, as `PrefixEncoder` has them for one.

    Pieces of equal length are the rows of a matrix. Tokens are found by walking a trie from
    every place; then, prefix by prefix, the longest token that fits what the prefix before
    it ends with is its last.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        nodes, edges = {b"": 0}, {}
        for token in vocabulary.reached():
            for end in range(1, len(token) + 1):
                if token[:end] not in nodes:
                    edges[nodes[token[: end - 1]] << 8 | token[end - 1]] = nodes[token[:end]] = len(nodes)
        self._nowhere = len(nodes)
        self._token = np.full(len(nodes) + 1, -1, np.int32)
        for token, rank in vocabulary.reached().items():
            self._token[nodes[token]] = rank
        self._length = np.zeros(max(vocabulary.tokens, default=0) + 1, np.int32)
        self._length[list(vocabulary.tokens)] = list(map(len, vocabulary.tokens.values()))
        # Edges lie at their place or at the next free ones.
        self._bits = max(10, (8 * len(edges)).bit_length() - 1)
        self._edges, self._to = np.full(1 << self._bits, -1, np.int64), np.zeros(1 << self._bits, np.int32)
        keys, to = np.array(list(edges), np.int64), np.array(list(edges.values()), np.int32)
        places = _places(keys, self._bits)
        while keys.size:
            free = self._edges[places] < 0
            taken, first = np.unique(places[free], return_index=True)
            first = np.flatnonzero(free)[first]
            self._edges[taken], self._to[taken] = keys[first], to[first]
            keys, to, places = (np.delete(x, first) for x in (keys, to, places))
            places = (places + 1) & ((1 << self._bits) - 1)
        self._pairs, self._fits = np.full(1 << PAIR_BITS, -1, np.int64), np.zeros(1 << PAIR_BITS, bool)

    def _next(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        keys = node.astype(np.int64) << 8 | byte
        places = _places(keys, self._bits)
        found = self._edges[places]
        to = np.where(found == keys, self._to[places], self._nowhere)
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while open_.size:
            places[open_] = (places[open_] + 1) & ((1 << self._bits) - 1)
            found = self._edges[places[open_]]
            here = found == keys[open_]
            to[open_[here]] = self._to[places[open_[here]]]
            open_ = open_[~here & (found >= 0)]
        return to

    def _fit(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """`Vocabulary.fits`, remembered until another pair takes the place."""
        pairs = left.astype(np.int64) << 32 | right
        places = _places(pairs, PAIR_BITS)
        fit = self._fits[places]
        new = np.flatnonzero(self._pairs[places] != pairs)
        if new.size:
            asked, which = np.unique(pairs[new], return_inverse=True)
            fits = self.vocabulary.fits
            answers = np.array([fits(p >> 32, p & 0xFFFFFFFF) for p in asked.tolist()], bool)
            fit[new] = answers[which]
            taken, first = np.unique(_places(asked, PAIR_BITS), return_index=True)
            self._pairs[taken], self._fits[taken] = asked[first], answers[first]
        return fit

    def ids(self, pieces: list[bytes]) -> list[list[int]]:
        """The tokens of pieces of one length that are no tokens themselves."""
        size, n = len(pieces[0]), len(pieces)
        data = np.ascontiguousarray(np.frombuffer(b"".join(pieces), np.uint8).reshape(n, size).T)
        ending: list[list[tuple]] = [[] for _ in range(size)]  # by last place: start, rows, tokens
        for start in range(size):
            rows, node = np.arange(n), np.zeros(n, np.int32)
            for at in range(start, size):
                node = self._next(node, data[at, rows])
                alive = node != self._nowhere
                rows, node = rows[alive], node[alive]
                if not rows.size:
                    break
                token = self._token[node]
                is_token = token >= 0
                ending[at].append((start, rows[is_token], token[is_token]))
        last = np.full((size, n), -1, np.int32)
        for at in range(size):
            for start, rows, token in ending[at]:  # the longest first
                free = last[at, rows] < 0
                rows, token = rows[free], token[free]
                if start:
                    fit = self._fit(last[start - 1, rows], token)
                    rows, token = rows[fit], token[fit]
                last[at, rows] = token
            if n and last[at].min() < 0:
                raise ValueError("the vocabulary lacks a byte of the text")
        found, ends, rows = [], np.full(n, size), np.arange(n)
        count = np.zeros(n, np.int64)
        while rows.size:
            token = last[ends[rows] - 1, rows]
            found.append(np.zeros(n, np.int32))
            found[-1][rows] = token
            count[rows] += 1
            ends[rows] -= self._length[token]
            rows = rows[ends[rows] > 0]
        return [ids[k - 1 :: -1] for ids, k in zip(np.array(found).T.tolist(), count.tolist())]


class _Cache(dict):
    """Computes what is missing. When it holds half its bytes, it becomes the older
    generation, out of which entries still in use come back, and the one before is dropped."""

    def __init__(self, make, most: int) -> None:
        self._make = make
        self._most, self._held = most // 2, 0
        self._older: dict = {}

    def __missing__(self, key):
        value = self._older.get(key, self)  # any value but the cache itself, None too
        if value is self:
            value = self._make(key)
        self._held += ENTRY_BYTES + len(key) + (len(value) if value else 0)
        if self._held > self._most:
            self._turn()
        self[key] = value
        return value

    def _turn(self) -> None:
        self._older = dict(self)
        self.clear()
        self._held = 0

    def add(self, entries: dict) -> None:
        held = sum([ENTRY_BYTES + len(k) + (len(v) if v else 0) for k, v in entries.items()])
        if self._held + held > self._most:
            self._turn()
        self._held += held
        self.update(entries)

    def lacking(self, keys: set) -> list:
        """The keys that are to be made, at most as many as a generation has room for; those
        in the older generation come back."""
        keys, older = keys.difference(self), self._older
        back = {k: older[k] for k in keys if k in older}
        self.add(back)
        room, made = self._most, []
        for key in keys.difference(back):
            room -= ENTRY_BYTES + 8 * len(key)  # of a byte's id, six digits and a blank
            if room < 0:
                break
            made.append(key)
        return made


class Coder:
    """Encodes texts. Words between single blanks are matched once per task.

    Where a blank stands between two characters that are no white space, the
    pattern always begins a new piece, so a text may be cut there.

    `prepare` takes the new words of many texts together; pieces of one length are coded at once.

    The caches don't keep the coder alive, so all of it goes as soon as a task of another
    step takes over the worker, not when Python next looks for cycles.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.vocabulary = Vocabulary(ranks)
        self.pattern = regex.compile(pattern.replace(r"[^\s", f"[^{_WHITE}").replace(r"\S", f"[^{_WHITE}]").replace(r"\s", f"[{_WHITE}]"))
        self._cut = regex.compile(f"(?<=[^{_WHITE}]) (?=[^{_WHITE}])")
        self._batch: BatchEncoder | None = None
        self._names = {rank: str(rank).encode() for rank in ranks.values()}
        own = weakref.proxy(self)
        self._pieces = _Cache(lambda piece: own._text(own._piece(piece)), CACHE_BYTES // 12)
        self._heads = _Cache(lambda word: own._word(word), CACHE_BYTES // 12)
        self._tails = _Cache(lambda word: own._word(word, " "), CACHE_BYTES * 5 // 6)
        self._bytes = {self._names[rank]: token for token, rank in ranks.items()}

    def _piece(self, piece: str) -> list[int]:
        data = piece.encode()
        own = self.vocabulary.ranks.get(data)
        return PrefixEncoder(self.vocabulary, data).ids() if own is None else [own]

    @staticmethod
    def _text(ids: list[int]) -> bytes:
        return " ".join(map(str, ids)).encode()

    def _joined(self, pieces: list[str]) -> bytes:
        # A blank and letters are a word that others are likely to hold too.
        tails, others = self._tails, self._pieces
        return b" ".join([tails[p[1:]] if p[0] == " " and p[1:].isalpha() else others[p] for p in pieces])

    def _word(self, word: str, blank: str = "") -> bytes | None:
        if not word or word[0].isspace() or word[-1].isspace():
            return None
        pieces = self.pattern.findall(blank + word)
        # A word of one piece is remembered as a word already.
        return self._text(self._piece(pieces[0])) if len(pieces) == 1 else self._joined(pieces)

    def prepare(self, texts: Iterable[str]) -> None:
        """Codes the new words of texts that are coded next. Results don't depend on it."""
        words: set[str] = set()
        for text in texts:
            words.update(text.split(" ")[1:])
        whole, made = [], {}
        for word in self._tails.lacking(words):
            if not word or word[0].isspace() or word[-1].isspace():
                made[word] = None
            else:
                whole.append(word)
        pieces = self.pattern.findall("".join([f" {word}" for word in whole]))
        found = self._found(set(pieces))
        # A word's first piece, and no other, begins with a blank.
        begins = [i for i, piece in enumerate(pieces) if piece[0] == " "] + [len(pieces)]
        for word, (begin, end) in zip(whole, pairwise(begins), strict=True):
            made[word] = found[pieces[begin]] if end == begin + 1 else b" ".join([found[p] for p in pieces[begin:end]])
        self._tails.add(made)

    def _found(self, pieces: set[str]) -> dict[str, bytes]:
        """The ids of pieces as decimal text."""
        ranks, names, found = self.vocabulary.ranks, self._names, {}
        by_size: dict[int, list[tuple[bytes, str]]] = {}
        for piece in pieces:
            rank = ranks.get(data := piece.encode())
            if rank is None:
                by_size.setdefault(len(data), []).append((data, piece))
            else:
                found[piece] = names[rank]
        for size, alike in by_size.items():
            if size > SHORT or len(alike) < FEW * size:
                found.update((piece, self._text(self._piece(piece))) for _, piece in alike)
                continue
            self._batch = self._batch or BatchEncoder(self.vocabulary)
            for begin in range(0, len(alike), AT_ONCE):
                part = alike[begin : begin + AT_ONCE]
                for (_, piece), ids in zip(part, self._batch.ids([data for data, _ in part])):
                    found[piece] = b" ".join([names[i] for i in ids])
        return found

    def _sections(self, text: str) -> Iterator[str]:
        """The text cut at blanks that begin a piece; each section but the first begins with its blank."""
        begin = 0
        while len(text) - begin > SECTION:
            cut = self._cut.search(text, begin + SECTION)
            if cut is None:
                break
            yield text[begin : cut.start()]
            begin = cut.start()
        yield text[begin:] if begin else text

    def coded(self, text: str) -> Iterator[bytes]:
        """The ids as decimal text, a section of the text at a time."""
        for section in self._sections(text):
            if section is not text:
                self.prepare([section])
            words = section.split(" ")
            if section[0] == " " and section is not text:
                texts = list(map(self._tails.__getitem__, words[1:]))
            else:
                texts = [self._heads[words[0]]]
                texts += map(self._tails.__getitem__, words[1:])
            yield self._joined(self.pattern.findall(section)) if None in texts else b" ".join(texts)

    def decode(self, ids: bytes) -> bytes:
        """The bytes of ids in decimal text."""
        return b"".join(map(self._bytes.__getitem__, ids.split()))


OUTPUTS = {
    "n_tokens": T.LongType(),
    "ids": T.ArrayType(T.IntegerType()),
    "decoded": T.BinaryType(),
    "ids_sha256": T.StringType(),
    "decoded_sha256": T.StringType(),
}
_ARROW = {
    "n_tokens": pa.int64(),
    "decoded": pa.binary(),
    "ids_sha256": pa.string(),
    "decoded_sha256": pa.string(),
}


def _portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, some megabytes of text (its last column) at a time."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_numpy())
    begin = 0
    while begin < batch.num_rows:
        before = sizes[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(sizes, before + PORTION_BYTES, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


def encode(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    outputs: tuple[str, ...] = ("n_tokens", "ids"),
    keep: tuple[str, ...] = ("doc_id",),
    column: str = "text",
) -> DataFrame:
    """The `keep` columns of every row and, of its whole text, the asked outputs:
    n_tokens, ids, decoded (the bytes the ids decode to) and the digests ids_sha256
    (of the decimal ids joined by one blank) and decoded_sha256.

    Matches of `pattern` are encoded one by one, without special tokens. Null and
    empty texts have no ids. Rows are independent: repeated rows, null ids and other
    columns change nothing, an empty table gives an empty one. Nothing is shuffled;
    only the rank table is broadcast, whose size the file fixes.
    """
    shared = docs.sparkSession.sparkContext.broadcast({"ranks": ranks, "made": {}})
    decodes = bool({"decoded", "decoded_sha256"} & set(outputs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = shared.value["made"]  # lives as long as the worker
        if pattern not in made:
            made[pattern] = Coder(shared.value["ranks"], pattern)
        coder = made[pattern]
        for batch in (part for whole in batches for part in _portions(whole)):
            texts = (x.as_py() for x in batch.column(batch.num_columns - 1))
            coder.prepare(x for x in texts if x and len(x) <= SECTION)
            rows: dict[str, list] = {name: [] for name in outputs if name != "ids"}
            ids, ends = array("i"), [0]
            for value in batch.column(batch.num_columns - 1):
                content = value.as_py()
                n, decoded = 0, []
                digests = {"ids_sha256": hashlib.sha256(), "decoded_sha256": hashlib.sha256()}
                for text in coder.coded(content) if content else ():
                    if n and text:
                        digests["ids_sha256"].update(b" ")
                    n += text.count(b" ") + 1
                    digests["ids_sha256"].update(text)
                    if "ids" in outputs:
                        ids.extend(map(int, text.split()))
                    if decodes:
                        part = coder.decode(text)
                        digests["decoded_sha256"].update(part)
                        if "decoded" in outputs:
                            decoded.append(part)
                ends.append(len(ids))
                for name, cells in rows.items():
                    if name == "n_tokens":
                        cells.append(n)
                    elif name == "decoded":
                        cells.append(b"".join(decoded))
                    else:
                        cells.append(digests[name].hexdigest())
            made_columns = {name: pa.array(cells, _ARROW[name]) for name, cells in rows.items()}
            if "ids" in outputs:
                made_columns["ids"] = pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.array(np.array(ids, dtype=np.int32))
                )
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(kept + [made_columns[c] for c in outputs], names=[*keep, *outputs])

    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{column}`").alias("_text"))
    schema = T.StructType(
        [source.schema[c] for c in keep] + [T.StructField(name, OUTPUTS[name]) for name in outputs]
    )
    return source.mapInArrow(run, schema)


def decode(docs: DataFrame, ranks: dict[bytes, int], ids: str = "ids", output: str = "decoded") -> DataFrame:
    """All columns and the bytes the ids stand for; null ids stay null, no ids are no bytes.

    Rows are independent: repeated ones and other columns change nothing, an empty table
    gives an empty one. An id that the ranks lack fails the job.
    """
    shared = docs.sparkSession.sparkContext.broadcast({rank: token for token, rank in ranks.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shared.value
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            found = [None if x is None else b"".join([tokens[i] for i in x]) for x in lists]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.binary())], names=[*batch.schema.names, output]
            )

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(output, T.BinaryType())]))
