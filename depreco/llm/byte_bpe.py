"""Byte-level BPE by dynamic programming over prefixes, and decoding.

Every prefix of a byte string has exactly one last token: the one token that ends there and fits behind
the last token of the prefix before it. Two tokens fit when merging their bytes together gives just these
two again. So the encoding of a piece is a table with one entry a byte; it grows by appends without a look
at earlier entries, and behind an edit it is filled only until it meets the old table again
(:class:`Prefixes`, :class:`Text`). A byte costs a few look-ups, whatever the piece's length.

A rank file holds a base64 token and its rank a line. Adjacent tokens merge when their joined bytes are a
token, lowest rank first, the leftmost of equals first; no special tokens are known, so their strings
are plain text. A piece that is a token as a whole is that token.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import ship

MEMO_PIECES = 250_000  # pieces of up to MEMO_BYTES whose ids a worker remembers, in each of two halves
MEMO_BYTES = 48
TABLES = 1 << 14  # pieces whose tables are filled side by side
BLOCK_CHARS = 1 << 20  # texts are taken in blocks of about so many characters; a longer one is matched in parts of it

_ID = 20  # bits of a token's rank in the key of a pair


class Lookup:
    """A map from integers below 2**62 to integers from 0 on, for whole arrays of keys; -1 where a key is missing."""

    _MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, items: dict[int, int]):
        bits = max(8, (4 * len(items)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int64)
        keys, values = np.fromiter(items.keys(), np.int64, len(items)), np.fromiter(items.values(), np.int64, len(items))
        at = self._slot(keys)
        while len(keys):  # each free slot goes to one of the keys that want it, the others move on
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]
            put = self.keys[at] == keys
            self.values[at[put]] = values[put]
            keys, values, at = keys[~put], values[~put], (at[~put] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * self._MULTIPLIER) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        out, seen = self.values[at], self.keys[at]
        rest = np.flatnonzero((seen != keys) & (seen >= 0))
        while len(rest):
            at[rest] = (at[rest] + 1) & self.mask
            seen = self.keys[at[rest]]
            out[rest] = self.values[at[rest]]
            rest = rest[(seen != keys[rest]) & (seen >= 0)]
        return out


class Vocabulary:
    """Tables of one rank file, given its content.

    Fails with ``ValueError`` where a byte is no token, or a token is built from tokens of higher rank only:
    merges then aren't made in the order of the ranks."""

    def __init__(self, content: bytes):
        self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, content.splitlines()))}
        self.bytes_of = {r: t for t, r in self.rank.items()}
        if any(bytes([b]) not in self.rank for b in range(256)) or max(self.bytes_of) >> _ID:
            raise ValueError("not a byte-level rank file")
        rank = self.rank
        self.single = [rank[bytes([b])] for b in range(256)]
        # The two tokens that a token was last merged from; a token of one byte is its own halves.
        self.left = {r: r for r in self.single}
        self.right = dict(self.left)
        self.merge: dict[int, int] = {}  # pair of tokens -> rank of the token that they make
        for r in sorted(self.bytes_of):
            t = self.bytes_of[r]
            if len(t) < 2:
                continue
            pairs = [(a, b) for k in range(1, len(t)) if (a := rank.get(t[:k])) is not None and (b := rank.get(t[k:])) is not None]
            for a, b in pairs:
                self.merge[a << _ID | b] = r
            made = next(((a, b) for a, b in pairs if a in self.left and b in self.left and self.fits(a, b, r)), None)
            if made:
                self.left[r], self.right[r] = made
            elif pairs and any(max(p) > r for p in pairs):
                raise ValueError(f"token {r} is built from later tokens")
        # Tokens that merging can give, spelled backwards: node and byte -> node; node -> token.
        self.step: dict[int, int] = {}
        self.ends = [-1]
        for r in self.left:
            node = 0
            for byte in reversed(self.bytes_of[r]):
                key = node << 8 | byte
                if (nxt := self.step.get(key)) is None:
                    nxt = self.step[key] = len(self.ends)
                    self.ends.append(-1)
                node = nxt
            self.ends[node] = r
        self.longest = max(len(self.bytes_of[r]) for r in self.left)
        # The same for arrays.
        n = max(self.bytes_of) + 1
        self.a_step, self.a_merge, self.a_ends = Lookup(self.step), Lookup(self.merge), np.array(self.ends)
        self.a_left, self.a_right, self.a_size = (np.zeros(n, np.int64) for _ in range(3))
        for r, t in self.bytes_of.items():
            self.a_left[r], self.a_right[r], self.a_size[r] = self.left.get(r, r), self.right.get(r, r), len(t)

    def fits(self, a: int, b: int, below: int = 1 << 62) -> bool:
        """Whether tokens ``a`` and ``b`` stay apart when their bytes are merged together by ranks under ``below``.

        Only the tokens beside the border can merge across it. From the last merge back, they are the halves
        towards the border; a pair merges if its rank comes before the merges that use up either token, where a
        merge on the left goes before one of its own rank that begins further right."""
        merge, left, right = self.merge, self.left, self.right
        till_a = till_b = below  # ranks of the merges that use up the tokens at the border
        while True:
            r = merge.get(a << _ID | b)
            if r is not None and r < till_a and (r <= till_b if till_b < below else r < below):
                return False
            a_in, b_in = right[a], left[b]
            if a_in == a and b_in == b:
                return True
            if b_in == b or (a_in != a and a > b):
                a, till_a = a_in, a
            else:
                b, till_b = b_in, b

    def fill(self, data: bytes, last: list[int]) -> None:
        """Grow ``last``, where entry i is the last token of the prefix of i bytes (entry 0: none), to all of ``data``."""
        for end in range(len(last), len(data) + 1):
            last.append(self.last_token(data, end, last))

    def last_token(self, data: bytes, end: int, last: list[int]) -> int:
        step, ends, fits = self.step, self.ends, self.fits
        node, at, found = 0, end, []
        while at and (node := step.get(node << 8 | data[at - 1])) is not None:
            at -= 1
            if (t := ends[node]) >= 0:
                found.append((at, t))
        for at, t in reversed(found):
            if not at or fits(last[at], t):
                return t
        raise AssertionError("every prefix has a last token")

    def trace(self, last: list[int]) -> list[int]:
        """The ids of the whole of what ``last`` covers."""
        out, at = [], len(last) - 1
        while at:
            out.append(last[at])
            at -= len(self.bytes_of[last[at]])
        return out[::-1]

    def all_fit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """:meth:`fits` for each pair of two arrays."""
        out, at = np.ones(len(a), bool), np.arange(len(a))
        till_a = till_b = np.full(len(a), 1 << 62)
        while len(at):
            r = self.a_merge(a << _ID | b)
            a_in, b_in = self.a_right[a], self.a_left[b]
            crossed = (r >= 0) & (r < till_a) & (r <= till_b)
            out[at[crossed]] = False
            go = ~crossed & ((a_in != a) | (b_in != b))
            a, b, a_in, b_in, till_a, till_b, at = (x[go] for x in (a, b, a_in, b_in, till_a, till_b, at))
            from_a = (b_in == b) | ((a_in != a) & (a > b))
            a, till_a, b, till_b = np.where(from_a, a_in, a), np.where(from_a, a, till_a), np.where(from_a, b, b_in), np.where(from_a, till_b, b)
        return out

    def encode_all(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of many short pieces that are no token as a whole: their tables are filled side by side."""
        order = sorted(range(len(pieces)), key=lambda i: -len(pieces[i]))
        size = np.array([len(pieces[i]) for i in order], np.int64)
        width = int(size[0])
        data = np.frombuffer(b"".join(pieces[i].ljust(width, b"\0") for i in order), np.uint8).reshape(len(order), width)
        last = np.full((len(order), width + 1), -1, np.int32)
        for end in range(1, width + 1):
            rows = np.arange(np.searchsorted(-size, -end, "right"))  # the pieces that are as long
            node, found = np.zeros(len(rows), np.int64), []
            for at in range(end - 1, -1, -1):
                node = self.a_step(node << 8 | data[rows, at])
                rows, node = rows[node >= 0], node[node >= 0]
                if not len(rows):
                    break
                token = self.a_ends[node]
                found.append((at, rows[token >= 0], token[token >= 0]))
            for at, rows, token in reversed(found):
                open_ = last[rows, end] < 0
                rows, token = rows[open_], token[open_]
                good = self.all_fit(last[rows, at].astype(np.int64), token) if at else slice(None)
                last[rows[good], end] = token[good]
        rows, at, steps = np.arange(len(order)), size.copy(), []
        n = np.zeros(len(order), np.int64)
        while len(rows):
            token = last[rows, at[rows]]
            steps.append((rows, token))
            n[rows] += 1
            at[rows] -= self.a_size[token]
            rows = rows[at[rows] > 0]
        ends = np.cumsum(n)
        ids = np.zeros(int(ends[-1]), "<i4")
        for k, (rows, token) in enumerate(steps):  # from each piece's end
            ids[ends[rows] - 1 - k] = token
        packed, out = ids.tobytes(), [b""] * len(pieces)
        for i, end, k in zip(order, ends.tolist(), n.tolist(), strict=True):
            out[i] = packed[4 * (end - k) : 4 * end]
        return out

    def encode(self, piece: bytes) -> list[int]:
        if (whole := self.rank.get(piece)) is not None:
            return [whole]
        last = [-1]
        self.fill(piece, last)
        return self.trace(last)


class Prefixes:
    """One piece with the table of its prefixes' last tokens. ``filled`` counts the entries made so far."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last, self.filled = vocabulary, b"", [-1], 0
        self.append(data)

    def append(self, more: bytes) -> None:
        """Exact, and no earlier entry is read again but those of the longest token."""
        self.data += more
        self.filled += len(more)
        self.vocabulary.fill(self.data, self.last)

    def replace(self, start: int, end: int, new: bytes) -> None:
        """Put ``new`` for the bytes from ``start`` to ``end``.

        An entry hangs only on the bytes and entries of the longest token before it. So entries up to ``start`` stay, and
        as soon as that many entries behind the edit in a row equal the old ones, all that follow do."""
        old, shift = self.last, len(new) - (end - start)
        self.data = self.data[:start] + new + self.data[end:]
        self.last = old[: start + 1]
        same = 0
        for at in range(start + 1, len(self.data) + 1):
            t = self.vocabulary.last_token(self.data, at, self.last)
            self.last.append(t)
            self.filled += 1
            # Behind the edit by a token's length, the bytes that an entry hangs on are the old ones.
            same = same + 1 if at - shift > end and t == old[at - shift] else 0
            if same >= self.vocabulary.longest:
                self.last += old[at - shift + 1 :]
                return

    def ids(self) -> list[int]:
        whole = self.vocabulary.rank.get(self.data)
        return self.vocabulary.trace(self.last) if whole is None else [whole]


def splitter(pattern: str) -> regex.Pattern:
    r"""The pattern with ``\s`` as Unicode's White_Space."""
    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


class Text:
    """A text's pieces with their ids, kept exact under edits.

    Matching goes from left to right without a look behind, and a match reads ``LOOK`` characters past its end at
    most. So pieces that end earlier before the edit stay, and the first new piece that begins behind the edit where an
    old one began brings all that follow. Only the pieces between are matched and encoded anew."""

    LOOK = 2

    def __init__(self, vocabulary: Vocabulary, pattern: regex.Pattern, text: str = ""):
        self.vocabulary, self.pattern, self.text = vocabulary, pattern, ""
        self.begins: list[int] = []
        self.pieces: list[list[int]] = []
        self.encoded = 0
        self.replace(0, 0, text)

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, new: str) -> None:
        shift = len(new) - (end - start)
        ends = [*self.begins[1:], len(self.text)] if self.begins else []
        keep = next((i for i, e in enumerate(ends) if e + self.LOOK > start), len(ends))
        old = {b + shift: i for i, b in enumerate(self.begins) if b >= end}
        self.text = self.text[:start] + new + self.text[end:]
        begins, pieces = self.begins[:keep], self.pieces[:keep]
        for m in self.pattern.finditer(self.text, self.begins[keep] if keep < len(ends) else (ends[-1] if ends else 0)):
            if m.start() >= start + len(new) and (i := old.get(m.start())) is not None:
                begins += [b + shift for b in self.begins[i:]]
                pieces += self.pieces[i:]
                break
            begins.append(m.start())
            pieces.append(self.vocabulary.encode(m.group().encode("utf-8")))
            self.encoded += 1
        self.begins, self.pieces = begins, pieces

    def ids(self) -> list[int]:
        return [i for p in self.pieces for i in p]


class Encoder:
    """Ids of whole texts as packed 32-bit integers; remembers the ids of short pieces.

    The pieces used lately are kept in two halves: when the new half is full it becomes the old one."""

    def __init__(self, content: bytes, pattern: str):
        self.vocabulary, self.pattern = Vocabulary(content), splitter(pattern)
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Packed ids of pieces that the new half lacks; the short ones go there."""
        if len(self.new) >= MEMO_PIECES:
            self.old, self.new = self.new, {}
        out, long, fresh = {}, {}, []
        for p in pieces:
            if (packed := self.old.get(p)) is not None:
                out[p] = packed
                continue
            data = p.encode("utf-8")
            if (whole := self.vocabulary.rank.get(data)) is not None:
                out[p] = np.array([whole], "<i4").tobytes()
            elif len(data) <= MEMO_BYTES:
                fresh.append((p, data))
            else:
                long[p] = np.array(self.vocabulary.encode(data), "<i4").tobytes()
        for lo in range(0, len(fresh), TABLES):
            own = fresh[lo : lo + TABLES]
            out.update(zip([p for p, _ in own], self.vocabulary.encode_all([d for _, d in own]), strict=True))
        self.new.update(out)
        return out | long

    def packed(self, pieces: list[str]) -> list[bytes]:
        out = list(map(self.new.get, pieces))
        if None not in out:
            return out
        learned = self.learn({p for p, x in zip(pieces, out, strict=True) if x is None})
        return [x or learned[p] for p, x in zip(pieces, out, strict=True)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        if len(texts) == 1 and len(texts[0]) > BLOCK_CHARS:
            found, out = self.pattern.finditer(texts[0]), []
            while pieces := [m.group() for m in islice(found, BLOCK_CHARS // 8)]:
                out.append(b"".join(self.packed(pieces)))
            return [b"".join(out)]
        lists = [self.pattern.findall(t) for t in texts]
        ids = self.packed([p for x in lists for p in x])
        ends = [0, *accumulate(map(len, lists))]
        return [b"".join(ids[a:b]) for a, b in zip(ends, ends[1:], strict=False)]


@lru_cache(maxsize=2)
def encoder(content: bytes, pattern: str) -> Encoder:
    """One for each worker process and vocabulary: tasks that follow find the tables made."""
    return Encoder(content, pattern)


def spans(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of rows of about BLOCK_CHARS bytes; a longer text is a run of its own."""
    lo, held = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(column), 0).to_pylist()):
        if i > lo and held + n > BLOCK_CHARS:
            yield lo, i
            lo, held = i, 0
        held += n
    if lo < len(column):
        yield lo, len(column)


def _content(spark, ranks: str):
    ship(spark)
    with open(ranks, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """(doc_id, ids) of each row: the ids of the whole text, matches of ``pattern`` encoded one by one.
    With ``decoded`` also the bytes that the ids decode to, as :func:`decode` gives them, in the same pass.

    ``ranks`` is a path on the driver; its content (about a megabyte, no larger for more documents) is broadcast.
    A null or empty text has no ids, an empty array. Repeated rows are encoded each; a null id stays null; other columns
    are not read. Characters that no match covers have no ids, as in the library. A long text is matched piece by
    piece, and a long piece costs its length. One pass, no shuffle."""
    content = _content(docs.sparkSession, ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, by_rank = encoder(content.value, pattern), vocabulary_bytes(content.value)
        for batch in batches:
            for lo, hi in spans(batch.column(1)):
                packed = own.encode([x or "" for x in batch.column(1).slice(lo, hi - lo).to_pylist()])
                ends = np.zeros(len(packed) + 1, np.int32)
                np.cumsum([len(x) // 4 for x in packed], out=ends[1:])
                values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(packed))])
                ids = pa.ListArray.from_arrays(pa.array(ends), values)
                made = {"doc_id": batch.column(0).slice(lo, hi - lo), "ids": ids}
                yield pa.RecordBatch.from_pydict(made | ({"decoded": joined_bytes(ids, by_rank)} if decoded else {}))

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, ids array<int>" + (", decoded binary" if decoded else ""))


def decode(encoded: DataFrame, ranks: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, ids, decoded) of each row: the bytes of the ids, as binary, since ids may end inside a character.

    No ids (or a null) give no bytes. An id that the vocabulary lacks, or a null one, is an error."""
    content = _content(encoded.sparkSession, ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_rank = vocabulary_bytes(content.value)
        for batch in batches:
            lists = batch.column(1).fill_null(pa.scalar([], pa.list_(pa.int32()))) if batch.column(1).null_count else batch.column(1)
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, joined_bytes(lists, by_rank)], names=["doc_id", "ids", "decoded"])

    rows = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def joined_bytes(lists: pa.ListArray, by_rank: pa.Array) -> pa.Array:
    """The bytes of each list of ids."""
    ends = lists.offsets.to_numpy().astype(np.int64)
    ids = lists.values.slice(ends[0], ends[-1] - ends[0])
    known = pc.and_(pc.greater_equal(ids, 0), pc.less(ids, len(by_rank)))
    tokens = by_rank.take(pc.if_else(known, ids, None))
    if tokens.null_count:
        raise ValueError("an id outside the vocabulary")
    _, offsets, data = tokens.buffers()
    cut = np.frombuffer(offsets, np.int64)[tokens.offset : tokens.offset + len(tokens) + 1][ends - ends[0]]
    return pa.Array.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(cut.tobytes()), data]).cast(pa.binary())


@lru_cache(maxsize=2)
def vocabulary_bytes(content: bytes) -> pa.Array:
    """Bytes of each token by rank; null where a rank has none."""
    tokens = {int(b): base64.b64decode(a) for a, b in map(bytes.split, filter(None, content.splitlines()))}
    return pa.array([tokens.get(i) for i in range(max(tokens) + 1)], pa.large_binary())


#: The last place of a text with white space right behind another character.
_SEAM = regex.compile(r"(?r)\P{White_Space}(?=\p{White_Space})")


def append(encoded: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", ids_col: str = "ids", more_col: str = "more") -> DataFrame:
    """(doc_id, text, ids) of texts with ``more_col`` put behind them, from the ids that they have.

    No match of ``pattern`` may hold white space behind another character, so the last such place of the old text is
    a border of pieces with or without the addition. The ids before it stay; only what follows is encoded. Nulls count
    as empty. The ids must be those of the text."""
    content = _content(encoded.sparkSession, ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = encoder(content.value, pattern)
            bytes_of, texts, out = own.vocabulary.bytes_of, [], []
            for text, ids, more in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                text, ids, more = text or "", ids or [], more or ""
                seam = m.end() if (m := _SEAM.search(text)) else 0
                left, n = len(text[seam:].encode("utf-8")), len(ids)
                while left > 0:
                    n -= 1
                    left -= len(bytes_of[ids[n]])
                texts.append(text + more)
                out.append([*ids[:n], *np.frombuffer(own.encode([text[seam:] + more])[0], "<i4").tolist()])
            made = [batch.column(0), pa.array(texts, pa.string()), pa.array(out, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(made, names=["doc_id", "text", "ids"])

    rows = encoded.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
        F.col(ids_col).cast("array<int>").alias("ids"), F.col(more_col).cast("string").alias("more"),
    )
    return rows.mapInArrow(run, "doc_id long, text string, ids array<int>")
