import pytest
from pyspark.sql import functions as F

from fleetwarden.llm import token_counts as tc
from fleetwarden.llm.queries import QUERIES


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tc.public_path())


ODD = [
    (1, None),
    (2, ""),
    (3, "a  b\n\n c\t 's don't ''ll <|endoftext|> x<|endoftext|>y 中文 café\x1c\x1dz  "),
    (4, "日本語   x 　　y"),
    (5, "   "),
    (6, "word 12 \x85\xa0 it's " * 60_000),
    (7, "x" * 30_000),
    (7, "x" * 30_000),
    (None, "null id"),
]


def test_counts_as_the_library_does(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame(ODD, "doc_id long, text string"))
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in tc.with_token_counts(docs).collect()), key=repr)
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    want = [(r.doc_id, len((r.text or "").encode()), count(r.text or "")) for r in docs.collect()]
    assert got == sorted(want, key=repr)


def test_plain_pattern_agrees_on_every_code_point(library):
    for c in range(tc.PLAIN_BELOW):
        text = f"a{chr(c)}b {chr(c)} {chr(c)}{chr(c)}1 {chr(c)}'s"
        cut = [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]
        assert tc._plain().findall(text) == cut


def test_long_texts_are_cut_safely(library):
    text = "don't stop  now\n\n 12 we'll\tsee " * 50
    whole = tc.pretoken_counts(text, tc.public_path())
    for size in (1, 7, 50):
        parts = list(tc.pieces_of_text(text, size))
        assert "".join(parts) == text
        cut = [p for part in parts for p in tc._plain().findall(part)]
        assert cut == tc._plain().findall(text) and sum(whole.values()) == len(cut)


def test_packed_numbers():
    import numpy as np

    values = np.array([0, 1, 127, 128, 300, 2**20, 2**31 - 1])
    assert (tc.unpacked(tc.packed(values)) == values).all()
    assert len(tc.unpacked(tc.packed(values[:0]))) == 0


def test_query_and_empty_table(spark, sf):
    got = QUERIES["op9_token_counts"](spark, sf)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert got.where(F.col("over_limit") != (F.col("n_tokens") > 1024)).count() == 0
    empty = spark.createDataFrame([], "doc_id long, text string, row long, block string, words string")
    assert tc.with_token_counts(empty).count() == 0
    clash = spark.createDataFrame([(1, "a b", 5, "x")], "doc_id long, text string, row long, block string")
    assert tc.with_token_counts(clash).first().n_tokens == 2
