"""Operator 13: ids against the library, byte-exact round trips, appends and edits against encoding anew."""

from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as public
import pytest
import tiktoken
from pyspark.sql import functions as F

from depreco.llm import byte_bpe, catalog

RANKS = str(public.path("byte_bpe_50k.tiktoken"))
ODD = [None, "", " ", "\n\n \t", "a", "it's we'll 'x", "<|endoftext|>", "été 你好 \U0001f600‍\x1c\x85\xa0 x", "  two  spaces  ", "a" * 3000, "ab" * 2000 + " " * 900, "12 345½"]


def library(ranks: str) -> tiktoken.Encoding:
    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=table, special_tokens={})


@pytest.fixture(scope="module", params=["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def both(request):
    ranks = str(public.path(request.param))
    with open(ranks, "rb") as f:
        return byte_bpe.Encoder(f.read(), public.PATTERN), library(ranks)


def pieces(rng, tokens, n):
    for _ in range(n):
        kind = rng.randrange(3)
        if kind == 0:
            yield bytes(rng.randrange(256) for _ in range(rng.randrange(1, 30)))
        elif kind == 1:
            yield bytes(rng.choice(b"abehilnorst  e") for _ in range(rng.randrange(1, 40)))
        else:
            yield b"".join(rng.choice(tokens) for _ in range(rng.randrange(1, 6)))


def test_pieces_match_the_library(both):
    own, lib = both
    found = list(pieces(random.Random(1), list(own.vocabulary.rank), 3000))
    want = [lib._encode_single_piece(p) for p in found]
    assert [own.vocabulary.encode(p) for p in found] == want
    apart = [(p, w) for p, w in zip(found, want, strict=True) if p not in own.vocabulary.rank]
    assert [np.frombuffer(x, "<i4").tolist() for x in own.vocabulary.encode_all([p for p, _ in apart])] == [w for _, w in apart]


def test_every_prefix_has_one_last_token(both):
    vocabulary = both[0].vocabulary
    for data in pieces(random.Random(2), list(vocabulary.rank), 60):
        last = [-1]
        vocabulary.fill(data, last)
        for end in range(1, len(data) + 1):
            fit = [vocabulary.rank[data[at:end]] for at in range(end) if data[at:end] in vocabulary.rank and (not at or vocabulary.fits(last[at], vocabulary.rank[data[at:end]]))]
            assert fit == [last[end]]


def test_appends_and_edits_of_a_piece_are_exact(both):
    own, rng = both[0].vocabulary, random.Random(3)
    tokens = list(own.rank)
    for _ in range(40):
        data = b"".join(rng.choice(tokens) for _ in range(200))
        whole = byte_bpe.Prefixes(own, data)
        more = b"".join(rng.choice(tokens) for _ in range(3))
        before = whole.filled
        whole.append(more)
        assert whole.filled == before + len(more) and whole.ids() == own.encode(data + more)
        a = rng.randrange(len(data))
        b, new = min(len(data), a + rng.randrange(5)), rng.choice(tokens)
        whole.replace(a, b, new)
        assert whole.data == data[:a] + new + data[b:] + more
        assert whole.ids() == own.encode(whole.data) and whole.last == byte_bpe.Prefixes(own, whole.data).last


def test_an_edit_fills_only_what_it_changes():
    with open(public.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        own = byte_bpe.Vocabulary(f.read())
    whole = byte_bpe.Prefixes(own, b"thequickbrownfoxjumpsoverthelazydog" * 100)
    before = whole.filled
    whole.replace(40, 41, b"zz")
    assert whole.filled - before < 4 * own.longest


def test_edits_of_a_text_are_exact(both):
    own, lib = both
    rng = random.Random(4)
    bits = ["word", " word", "  ", "\n", " ", "'", "'s", "'r", "e", "l", "12", "你", "!?", "é", "\t\n ", "s"]
    for _ in range(150):
        text = byte_bpe.Text(own.vocabulary, own.pattern, "".join(rng.choices(bits, k=rng.randrange(40))))
        for _ in range(4):
            a = rng.randrange(len(text.text) + 1)
            b = min(len(text.text), a + rng.randrange(4))
            text.replace(a, b, "".join(rng.choices(bits, k=rng.randrange(4))))
            assert text.ids() == lib.encode_ordinary(text.text)
        text.append("".join(rng.choices(bits, k=2)))
        assert text.ids() == lib.encode_ordinary(text.text)
    long = byte_bpe.Text(own.vocabulary, own.pattern, "some words here, " * 500)
    before = long.encoded
    long.replace(4000, 4003, "xy")
    assert long.encoded - before < 10


def test_refuses_files_that_are_no_byte_ranks():
    with pytest.raises(ValueError):
        byte_bpe.Vocabulary(b"YQ== 0\nYg== 1\n")


def test_query_matches_the_library(spark):
    lib = library(RANKS)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = catalog.op13_byte_bpe(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(texts)
    for r in got:
        ids = lib.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_odd_rows(spark, monkeypatch):
    lib = library(RANKS)
    monkeypatch.setattr(byte_bpe, "BLOCK_CHARS", 64)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "null id"), (4, "a"), (4, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash")).withColumn("decoded", F.lit(1))
    coded = byte_bpe.decode(byte_bpe.encode(docs, RANKS, public.PATTERN), RANKS).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.ids, bytes(r.decoded)) for r in coded) == sorted((i is None, i or 0, lib.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows)
    assert sorted(byte_bpe.encode(docs, RANKS, public.PATTERN, decoded=True).collect(), key=str) == sorted(coded, key=str)
    assert byte_bpe.decode(byte_bpe.encode(docs.limit(0), RANKS, public.PATTERN), RANKS).count() == 0


def test_ids_that_are_null_or_unknown(spark):
    ids = spark.createDataFrame([(1, None), (2, []), (3, [0, 50255])], "doc_id long, ids array<int>")
    got = {r.doc_id: (r.ids, bytes(r.decoded)) for r in byte_bpe.decode(ids, RANKS).collect()}
    assert got[1] == got[2] == ([], b"") and got[3][1] == library(RANKS).decode_bytes([0, 50255])
    with pytest.raises(Exception, match="outside the vocabulary"):
        byte_bpe.decode(spark.createDataFrame([(1, [50257])], "doc_id long, ids array<int>"), RANKS).collect()


def test_appended_texts_keep_their_ids(spark):
    lib = library(RANKS)
    rng = random.Random(5)
    bits = ["word", " word", "  ", "\n", " ", "'s", "'r", "e", "12", "你"]
    rows = [(i, "".join(rng.choices(bits, k=rng.randrange(30))), "".join(rng.choices(bits, k=rng.randrange(6)))) for i in range(200)] + [(200, None, None), (201, "a", None), (202, None, "b")]
    frame = spark.createDataFrame([(i, t, lib.encode_ordinary(t or ""), m) for i, t, m in rows], "doc_id long, text string, ids array<int>, more string")
    got = {r.doc_id: (r.text, r.ids) for r in byte_bpe.append(frame, RANKS, public.PATTERN).collect()}
    for i, t, m in rows:
        whole = (t or "") + (m or "")
        assert got[i] == (whole, lib.encode_ordinary(whole))
