"""Brute-force versions of the corpus operators, in plain Python, for small inputs."""

from __future__ import annotations

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None, lower: bool = True) -> list[str]:
    text = text or ""
    return WORD.findall(text.translate(_FOLD) if lower else text)


def shingle_set(text: str | None, k: int = 5) -> set[tuple]:
    ws = words(text)
    if len(ws) < k:
        return {tuple(ws)} if ws else set()
    return {tuple(ws[i : i + k]) for i in range(len(ws) - k + 1)}


def near_duplicates(rows: list[tuple]) -> dict[int, tuple]:
    """doc_id -> (n_shingles, component_id, kept) for rows of distinct non-null ids."""
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((find(a), find(b)))
                    parent[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def tiles(item: list[str], text: list[str], least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling by trying every pair of places."""
    least = min(least, len(item))
    free_i, free_t, out = [True] * len(item), [True] * len(text), []
    while least:
        best, found = least - 1, []
        for t in range(len(text)):
            for i in range(len(item)):
                n = 0
                while i + n < len(item) and t + n < len(text) and item[i + n] == text[t + n] and free_i[i + n] and free_t[t + n]:
                    n += 1
                if n > best:
                    best, found = n, [(i, t)]
                elif n == best and n >= least:
                    found.append((i, t))
        if best < least:
            break
        for i, t in found:
            if all(free_i[i : i + best]) and all(free_t[t : t + best]):
                free_i[i : i + best] = [False] * best
                free_t[t : t + best] = [False] * best
                out.append((i, t, best))
    return out


def line_dedup(rows: list[tuple], percent: int, least_pages: int, classes: list | None = None) -> list[tuple]:
    """(host, text) rows -> (text, n_lines, n_dropped). Rows of one of the ``classes`` are one page."""
    blank = " \t\x0b\x0c\r"
    pages, on = defaultdict(set), defaultdict(set)
    for i, (host, text) in enumerate(rows):
        page = classes[i] if classes else i
        pages[host].add(page)
        for line in {x.strip(blank) for x in (text or "").split("\n")} - {""}:
            on[host, line].add(page)
    total = {k: len(v) for k, v in pages.items()}
    held = {k: len(v) for k, v in on.items()}
    out = []
    for host, text in rows:
        if text is None:
            out.append((None, 0, 0))
            continue
        lines = text.split("\n")

        def common(x, host=host):
            n = held.get((host, x.strip(blank)), 0)
            return n >= least_pages and 100 * n > percent * total[host]

        kept = [x for x in lines if not common(x)]
        if not any(x.strip(blank) for x in kept):
            kept = lines
        out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    ws = words(text, lower=False)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    at = defaultdict(list)
    for i in range(len(ws) - 2):
        at[tuple(ws[i : i + 3])].append(i)
    covered = {i + j for places in at.values() if len(places) > 1 for i in places for j in range(3)}
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)
