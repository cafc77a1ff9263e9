"""Line dedup of the pipeline counts near copies as one page."""

from __future__ import annotations

import random
from collections import defaultdict

import brute

import corpus_pipeline

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


def said(rng, lines, size=8):
    return "\n".join(" ".join(f"w{rng.randrange(10**6)}" for _ in range(size)) for _ in range(lines))


def by_class(rows, classes):
    """``brute.line_dedup`` at 1 % and 3 pages, its pages counted by class."""
    held, total = defaultdict(set), defaultdict(set)
    for (host, text), c in zip(rows, classes, strict=True):
        total[host].add(c)
        for line in {x.strip(" \t\x0b\x0c\r") for x in (text or "").split("\n")} - {""}:
            held[host, line].add(c)
    out = []
    for host, text in rows:
        lines = (text or "").split("\n")
        n = lambda x, host=host: len(held[host, x.strip(" \t\x0b\x0c\r")])
        kept = [x for x in lines if not (n(x) >= 3 and n(x) > len(total[host]) / 100)]
        out.append(text if text is None or not any(x.strip(" \t\x0b\x0c\r") for x in kept) else "\n".join(kept))
    return out


def test_group_of_near_copies_leaves_one_whole_page(spark):
    rng = random.Random(5)
    shared = said(rng, 20)
    rows = [(i, f"{said(rng, 6)}\nfooter of the site", "hot") for i in range(100)]
    edited = [(100 + i, f"{shared}\n{said(rng, 1)}", "hot") for i in range(40)]  # each has a line of its own
    exact = [(200 + i, shared, "hot") for i in range(40)]
    alone = [(None, "no id\nfooter of the site", "hot"), (300, None, "hot")]
    rows += edited + exact + alone
    docs = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)
    lines = corpus_pipeline.lines(spark, docs, SF)
    named = [(i, t) for i, t, _ in rows if i is not None]
    found = brute.near_duplicates(named)
    want = by_class([(s, t) for _, t, s in rows], [None if i is None else found[i][1] for i, _, _ in rows])
    assert sorted(((r.doc_id, r.text) for r in lines.collect()), key=str) == sorted(((i, t) for (i, _, _), t in zip(rows, want, strict=True)), key=str)

    left = {r.doc_id: r for r in corpus_pipeline.near_copies(spark, lines, SF).collect()}
    group = [r for i, r in left.items() if i is not None and 100 <= i < 300]
    assert [(r.doc_id, r.text, r.n_chars) for r in group] == [(100, edited[0][1], len(edited[0][1]))]
    assert left[0].text == rows[0][1].removesuffix("\nfooter of the site")
    assert left[None].text == "no id"
    assert len(left) == 100 + 1 + 2
