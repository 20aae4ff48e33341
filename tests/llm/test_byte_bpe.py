"""Tree encoding against tiktoken and against merging whole pieces."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tellake.llm import byte_bpe, queries

D = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(open(PATH, "rb").read())


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder(ranks):
    return byte_bpe.TreeEncoder(ranks, public_tokenizers.PATTERN)


def test_every_row_as_tiktoken(spark, library):
    base = spark.read.parquet(f"{D}/documents.parquet").select("doc_id", "text")
    odd = [(-1, None), (-2, ""), (None, "no id <|endoftext|>"), (-3, "  \n\t x  "), (-4, "a" * 70000), (-5, "word " * 200000), (-5, "日本語のテキスト" * 4000), (-6, "'s't're 12 34!?  é́ 🙂🙂" * 50)]
    docs = base.unionByName(spark.createDataFrame(odd, "doc_id long, text string")).selectExpr("*", "1 AS ids", "'x' AS decoded", "2 AS `a.b`")
    got = sorted(tuple(r) for r in byte_bpe.round_trip(docs.fillna(-9, ["doc_id"]), PATH, public_tokenizers.PATTERN).collect())
    want = []
    for r in docs.collect():
        ids = library.encode_ordinary(r.text or "")
        want.append((-9 if r.doc_id is None else r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert got == sorted(want)
    assert byte_bpe.round_trip(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
    assert byte_bpe.encode_texts(docs.filter("doc_id is null"), PATH, public_tokenizers.PATTERN).first().doc_id is None


def test_query_is_one_row_a_document(spark):
    out = queries.op12_byte_bpe(spark, D)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() == spark.read.parquet(f"{D}/documents.parquet").count()


@pytest.mark.parametrize("seed", range(6))
def test_tree_equals_merging_the_whole_piece(ranks, coder, seed):
    """Random and repetitive bytes, whose windows grow far, in any split."""
    rng = random.Random(seed)
    for _ in range(300):
        letters = rng.choice([b"ab", b"aeiou st", b"0", b"ing", bytes(range(256)), "éüñ日".encode()])
        piece = bytes(rng.choice(letters) for _ in range(rng.randrange(1, 200)))
        want = byte_bpe.merge_long(piece, ranks)
        assert coder.tree(piece) == want
        at = rng.randrange(len(piece) + 1)
        assert coder.join(coder.tree(piece[:at]), coder.tree(piece[at:])) == want
        assert len(piece) > byte_bpe.SCANNED or byte_bpe.merge(piece, ranks) == want
        assert coder.decode(want) == piece


def test_windows_that_move_every_token():
    """A vocabulary of runs: one byte more moves all borders to the right of it."""
    runs = {b"a" * n: k for k, n in enumerate((1, 2, 3, 5, 7))} | {b"b": 5, b"ab": 6, b"aba": 7}
    coder = byte_bpe.TreeEncoder(runs, "[ab]+")
    library = tiktoken.Encoding("runs", pat_str="[ab]+", mergeable_ranks=runs | {bytes([k]): 100 + k for k in range(256) if bytes([k]) not in runs}, special_tokens={})
    rng = random.Random(1)
    for n in range(1, 400):
        text = "".join(rng.choice("aaaaaab") for _ in range(n)) if n % 2 else "a" * n
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == library.encode_ordinary(text)


def test_sections_change_nothing(coder, library):
    text = ("some words,\n\n and  more\t" * 50 + "x" * 300 + "   ") * 5
    parts = list(byte_bpe.sections(text, 100))
    assert "".join(parts) == text and len(parts) > 20
    assert [i for p in parts for i in library.encode_ordinary(p)] == library.encode_ordinary(text)


def test_ranks_are_read_as_they_are(ranks):
    first = open(PATH, "rb").readline().split()
    assert ranks[base64.b64decode(first[0])] == int(first[1])
