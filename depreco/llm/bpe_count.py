"""Token counts by heap-and-linked-list byte-pair merging.

The count of a word is its number of byte symbols less the merges that byte-pair encoding makes in it;
no identifiers are looked up. All adjacent pairs that have a rank wait in a heap, the symbols form a
linked list, and the pair of lowest rank (the leftmost of equals) is merged until none is left: each
merge costs a logarithm of the word's length, so one very long word is no trouble.

The vocabulary file is a public ``tokenizers`` JSON of the word-end BPE kind: NFC, white space to a
space, lower case, a split pattern, byte symbols, an end-of-word suffix on the last symbol. Special
tokens count one where their string occurs in a text, as the library does by default; none are added.
A null text counts as the empty text: 0 bytes, 0 tokens. A text of any length is counted whole; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import ship

MEMO_WORDS = 200_000  # words of up to MEMO_CHARS whose counts a task remembers
MEMO_CHARS = 64
PIECE_CHARS = 1 << 16  # a text is matched in runs of about this many characters, cut at white space

#: White space by Unicode's White_Space property.
_SPACE = "\t-\r \x85\xa0  -     　"


def _byte_symbols() -> list[str]:
    """The printable stand-in for each byte that byte-level vocabularies use."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    out = [chr(b) for b in range(256)]
    for i, b in enumerate(rest):
        out[b] = chr(256 + i)
    return out


class Counter:
    """Counts the tokens of texts under one vocabulary file, given its content."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if spec["model"]["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("not a lower-cased word-end BPE vocabulary")
        self.suffix = spec["model"]["end_of_word_suffix"] or ""
        self.rank = {(a, b): i for i, (a, b) in enumerate(spec["model"]["merges"])}
        self.known = spec["model"]["vocab"].keys()
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(split.replace(r"\s", _SPACE))
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.blank = regex.compile(f"[{_SPACE}]+")
        self.symbols = _byte_symbols()
        self.memo: dict[str, int] = {}

    def merged(self, word: str) -> int:
        """Symbols left of one word after all merges."""
        symbol = [self.symbols[b] for b in word.encode("utf-8")]
        symbol[-1] += self.suffix
        symbol = [s for s in symbol if s in self.known]
        n = len(symbol)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap = [(self.rank[p], i, p) for i, p in enumerate(zip(symbol, symbol[1:], strict=False)) if p in self.rank]
        heapq.heapify(heap)
        left = n
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or (symbol[i], symbol[j]) != pair:
                continue  # one of the two has been merged since
            symbol[i] += symbol[j]
            alive[j] = False
            left -= 1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (rank := self.rank.get((symbol[a], symbol[b]))) is not None:
                    heapq.heappush(heap, (rank, a, (symbol[a], symbol[b])))
        return left

    def word(self, word: str) -> int:
        n = self.memo.get(word)
        if n is None:
            n = self.merged(word)
            if len(word) <= MEMO_CHARS:
                if len(self.memo) >= MEMO_WORDS:
                    self.memo.clear()
                self.memo[word] = n
        return n

    def plain(self, text: str) -> int:
        """Tokens of a text without special strings."""
        text = self.blank.sub(" ", unicodedata.normalize("NFC", text))
        # Lower-cased letter by letter, as the library does: no final form of sigma.
        text = text.replace("Σ", "σ").lower()
        total, at, memo = 0, 0, self.memo
        while at < len(text):  # words hold no white space, so a cut at a space splits none
            end = text.find(" ", at + PIECE_CHARS)
            end = len(text) if end < 0 else end
            for w in self.words.findall(text, at, end):
                n = memo.get(w)
                total += self.word(w) if n is None else n
            at = end
        return total

    def count(self, text: str) -> int:
        if self.special is None or not self.special.search(text):
            return self.plain(text)
        return len(self.special.findall(text)) + sum(map(self.plain, self.special.split(text)))


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each row; ``vocabulary`` is a path on the driver.

    The file's content (some megabytes, as large as the vocabulary and no larger for more documents) is
    broadcast. Repeated rows are counted each; a null id stays null. One pass, no shuffle."""
    ship(docs.sparkSession)
    with open(vocabulary, "rb") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(content.value)
        for batch in batches:
            tokens, sizes = [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                tokens.append(counter.count(text))
                sizes.append(len(text.encode("utf-8")))
            n = pa.array(tokens, pa.int64())
            over = pa.array([t > limit for t in tokens], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), n, over], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
