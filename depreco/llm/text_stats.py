"""Statistics of whole texts, computed over blocks of texts with numpy."""

from __future__ import annotations

import numpy as np

from .words import SPACE, Texts, U64, mix, powers, windows, words

SYMBOLS = b"#*$%&|<>"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_MARK = np.zeros(256, bool)
_MARK[list(b".,;:!?")] = True
_BANG = np.zeros(256, bool)
_BANG[list(b"!?")] = True
_HEAD = np.ones(256, bool)  # first bytes of code points
_HEAD[0x80:0xC0] = False

WINDOW = 3

#: Counts, in this order.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars", "n_lines", "n_upper", "n_digits", "n_marks", "n_bangs", "n_distinct_words", "n_bytes")


def _per_text(flag: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flag, dtype=np.int64)])
    return total[at[1:]] - total[at[:-1]]


def _earlier_equal(code: np.ndarray, text: np.ndarray) -> np.ndarray:
    """For each entry: an earlier entry of the same text has the same code."""
    order = np.lexsort((np.arange(len(code)), code, text))
    same = (code[order][1:] == code[order][:-1]) & (text[order][1:] == text[order][:-1])
    out = np.zeros(len(code), bool)
    out[order[1:][same]] = True
    return out


def _lines(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code, text index and "has a word" of every line (texts are split at newlines)."""
    data, at = texts
    cut = np.flatnonzero(data == 0x0A)
    text_of_cut = np.searchsorted(at, cut, "right") - 1
    start = np.concatenate([at[:-1], cut + 1])
    text = np.concatenate([np.arange(len(at) - 1), text_of_cut])
    order = np.lexsort((start, text))
    start, text = start[order], text[order]
    nexts = np.append(start[1:], 0)
    last = np.append(text[1:] != text[:-1], True)
    end = np.where(last, at[text + 1], nexts - 1)
    solid = np.concatenate([[0], np.cumsum(~SPACE[data], dtype=np.int64)])
    has_word = solid[end] > solid[start]
    # A code of each line's bytes: their polynomial from the line's first byte.
    size = end - start
    code = np.zeros(len(start), np.uint64)
    full = np.flatnonzero(size > 0)
    if len(full):
        body = np.ones(len(data), bool)
        body[cut] = False
        kept = data[body].astype(np.uint64) + U64(1)
        where = np.cumsum(size[full]) - size[full]
        place = np.arange(len(kept)) - np.repeat(where, size[full])
        code[full] = np.add.reduceat(mix(kept) * powers(int(size.max()))[place], where)
    return mix(code + size.astype(np.uint64)), text, has_word


def counts(texts: Texts) -> np.ndarray:
    """One row of COUNTS for each text."""
    data, at = texts
    n = len(at) - 1
    out = np.zeros((n, len(COUNTS)), np.int64)
    if not len(data):
        return out
    w = words(texts, lower=False)
    n_words = np.diff(w.first)
    solid = ~SPACE[data]
    col = dict(zip(COUNTS, out.T, strict=True))
    col["n_words"][:] = n_words
    col["word_chars"][:] = _per_text(_HEAD[data] & solid, at)
    col["n_chars"][:] = _per_text(_HEAD[data], at)
    for name, flag in (("n_symbols", _SYMBOL), ("n_upper", _UPPER), ("n_digits", _DIGIT), ("n_marks", _MARK), ("n_bangs", _BANG)):
        col[name][:] = _per_text(flag[data], at)
    col["n_bytes"][:] = np.diff(at)

    code, text, has_word = _lines(texts)
    code, text = code[has_word], text[has_word]
    col["n_lines"][:] = np.bincount(text, minlength=n)
    col["n_dup_lines"][:] = np.bincount(text[_earlier_equal(code, text)], minlength=n)

    text = np.repeat(np.arange(n), n_words)
    col["n_distinct_words"][:] = n_words - np.bincount(text[_earlier_equal(w.hash, text)], minlength=n)
    # Words inside windows that occur twice or more in their text.
    code, first = windows(w, WINDOW, whole_short=False)
    text = np.repeat(np.arange(n), np.diff(first))
    order = np.lexsort((code, text))
    same = np.zeros(len(code), bool)
    if len(code) > 1:
        equal = (code[order][1:] == code[order][:-1]) & (text[order][1:] == text[order][:-1])
        same[order[1:][equal]] = True
        same[order[:-1][equal]] = True
    covered = np.zeros(len(w.hash) + WINDOW, bool)
    begin = np.repeat(w.first[:-1], np.diff(first)) + np.arange(len(code)) - np.repeat(first[:-1], np.diff(first))
    for j in range(WINDOW):
        covered[begin[same] + j] = True
    text = np.repeat(np.arange(n), n_words)
    col["n_repeat_words"][:] = np.bincount(text[covered[: len(text)]], minlength=n)
    return out
