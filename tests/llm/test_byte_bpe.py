"""Byte-level BPE: scans, merges, offsets and decoding against the tiktoken library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

import public_tokenizers
from fleetwarden.llm import byte_bpe
from fleetwarden.llm.queries import QUERIES

PATH = byte_bpe.multi_path()
LIBRARY = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.vocabulary(PATH), special_tokens={}
)
PARTS = [*" \t\n\r'strevmldabAB12!?.é　\x1c\x85\xa0漢字٣́😀​\x00", "'s", "'re", " 've", "'ll", "  ", "\n\n", "'' "]


def agree(texts: list[str]) -> None:
    ids, ends, counts = byte_bpe.encode_texts([t.encode() for t in texts], PATH)
    at = 0
    for text, n in zip(texts, counts):
        own, stops = ids[at : at + n], ends[at : at + n]
        assert own.tolist() == LIBRARY.encode_ordinary(text)
        assert byte_bpe.decode_ids(own, PATH, block=7) == text.encode()
        spans = zip([0, *stops[:-1]], stops)
        assert [LIBRARY.decode_single_token_bytes(i) for i in own] == [text.encode()[a:b] for a, b in spans]
        at += n
    assert at == len(ids)


def test_random_texts_one_after_another():
    rng = random.Random(3)
    agree(["".join(rng.choices(PARTS, k=rng.randint(0, 40))) for _ in range(4000)])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from([c for p in PARTS for c in p]) | st.characters(codec="utf-8"), max_size=30), max_size=4))
def test_any_text(texts):
    agree(texts)


def test_long_pieces_and_runs():
    agree(["a" * 5000, "ab" * 3000, "the" * 1000, " " * 900 + "x", "\n" * 700, "'" * 300, "漢字" * 2000, "x" * 900 + "'re"])


def test_short_and_long_merges_agree():
    ranks = byte_bpe.vocabulary(PATH)
    rng = random.Random(5)
    for _ in range(2000):
        piece = "".join(rng.choices("aeinorsthl", k=rng.randint(2, 40))).encode()
        if piece not in ranks:
            assert byte_bpe._merged_long(piece, ranks) == byte_bpe.merged(piece, ranks)


def test_scan_is_the_automaton_step_by_step():
    rng = np.random.default_rng(1)
    of_symbol, compose, from_free, _, none = byte_bpe._functions()
    for n in (1, 2, 63, 64, 65, 500, 5000):
        symbols = rng.integers(0, 16, n)
        state, want = byte_bpe.FREE, []
        for s in symbols:
            state = byte_bpe.next_state(int(s), state)
            want.append(state)
        assert from_free[byte_bpe.scan(of_symbol[symbols], compose, none)].tolist() == want


def test_full_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 3)
    pieces = byte_bpe.Pieces(byte_bpe.vocabulary(PATH))
    for word in (b" the", b" and", b" of", b" zzyzx", b" the"):
        assert np.frombuffer(pieces[word], np.int32).tolist() == LIBRARY.encode_ordinary(word.decode())
        assert len(pieces) <= 3


def test_frames(spark):
    long = "word " * 300_000
    rows = [(1, "Don't stop", "x"), (1, "Don't stop", "x"), (None, None, None), (2, "", "y"), (3, long, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(2)
    encoded = byte_bpe.encode(docs)
    assert encoded.columns == ["doc_id", "ids", "ends"]
    got = byte_bpe.decode(encoded).collect()
    assert sorted((r["doc_id"] or 0, r["decoded"].decode()) for r in got) == sorted((r[0] or 0, r[1] or "") for r in rows)
    by_id = {r["doc_id"]: r for r in encoded.collect()}
    assert list(by_id[None]["ids"]) == list(by_id[2]["ids"]) == []
    assert list(by_id[3]["ids"]) == LIBRARY.encode_ordinary(long) and by_id[3]["ends"][-1] == len(long)


def test_unknown_ids_and_clashing_names(spark):
    rows = spark.createDataFrame(
        [(1, [72, 73], "a"), (2, [72, 60_000], "b"), (3, None, "c"), (4, [72, None], "d"), (5, [], "e"), (6, [-1], "f")],
        "k int, ids array<int>, decoded string",
    )
    got = {r["k"]: r["decoded"] for r in byte_bpe.decode(rows).collect()}
    assert got == {1: LIBRARY.decode_bytes([72, 73]), 2: None, 3: None, 4: None, 5: b"", 6: None}


@pytest.mark.parametrize("empty", [True, False])
def test_query(spark, sf, tmp_path, empty):
    folder = sf
    if empty:
        folder = str(tmp_path)
        spark.createDataFrame([], "doc_id long, text string, lang string").write.parquet(f"{folder}/documents.parquet")
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for row in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect():
        ids = LIBRARY.encode_ordinary(row["text"] or "")
        want.append((row["doc_id"], len(ids), sha(",".join(map(str, ids)).encode()), sha((row["text"] or "").encode())))
    got = QUERIES["op13_byte_bpe"](spark, folder)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(want)
