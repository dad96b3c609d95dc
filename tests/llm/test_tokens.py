"""BPE and token counts against the tokenizers library."""

import random

import numpy as np
import pyarrow.parquet as pq
import pytest
import regex
from tokenizers import Tokenizer

from tests.conftest import SF0001
from tessera.llm import bpe, pretoken
from tessera.llm.token_counts import TokenCounter, token_counts

PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LETTERS = "aé1 ''  srtevmldthe\n\t!. 中\U0001f600"


def _texts(seed: int, n: int, longest: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, longest))) for _ in range(n)]


ODD = ["", "a" * 1000, "the" * 700 + " x", " " * 600, "<|endoftext|>", "a <|endoftext|>b<|endoftext|><|endoftext|> c<|endoftex", "é" * 900, "\x00\x1c", "=-" * 500]


def test_split_is_the_pattern():
    pattern = regex.compile(PATTERN)
    for text in _texts(1, 5000, 14):
        assert pretoken.pieces(text) == [x.encode() for x in pattern.findall(text)]


def test_stretches_keep_the_pieces():
    for text in _texts(2, 300, 400):
        assert sum((pretoken.pieces(s) for s in pretoken.stretches(text, 30)), []) == pretoken.pieces(text)


@pytest.fixture(scope="module")
def library(tokenizer):
    return Tokenizer.from_file(tokenizer)


def test_encode_and_decode_like_the_library(tokenizer, library):
    with open(tokenizer) as f:
        own = bpe.SegmentTreeBpe(f.read())
    texts = _texts(3, 1500, 60) + ODD + pq.read_table(f"{SF0001}/documents.parquet")["text"].to_pylist()
    coded = own.encode(texts)
    for text, ids, back in zip(texts, coded, own.decode(coded)):
        want = library.encode(text, add_special_tokens=False).ids
        assert bpe.id_array(ids) == want, text[:60]
        assert back == library.decode(want, skip_special_tokens=False) == text


def test_both_trees_agree(tokenizer):
    with open(tokenizer) as f:
        own = bpe.SegmentTreeBpe(f.read())
    rng = random.Random(4)
    for n in (2, 3, 17, 64, 200):
        piece = "".join(rng.choice("thaeinrs") for _ in range(n)).encode()
        assert own._encode_one(piece).tolist() == own.encode_pieces([piece])[0].tolist()


def test_equal_hashes_are_told_apart(tokenizer, monkeypatch):
    from tessera.llm import piecetable

    with open(tokenizer) as f:
        own = bpe.SegmentTreeBpe(f.read())
    want = own.encode(["some words and other words"])
    monkeypatch.setattr(piecetable, "slice_hashes", lambda body, starts, ends: np.zeros(len(starts), np.uint64))
    own.known.clear()
    assert own.encode(["some words and other words"]) == want


def test_counts_like_the_library(tokenizer, library):
    with open(tokenizer) as f:
        counter = TokenCounter(f.read())
    texts = _texts(5, 60, 3000) + ODD + ["<|endoftext|>" * 40, "a <|endoftext|>b" * 30, "中" * 2000, "\x00\x1c" * 100]
    for text in texts:
        want = len(library.encode(text, add_special_tokens=False).ids)
        for chunk, overlap in ((64, 8), (300, 40), (1 << 14, 256)):
            assert counter.count(text.encode(), chunk, overlap) == want, (text[:40], chunk)


def test_frames(odd, empty, tokenizer, library):
    texts = [(r.doc_id, r.text or "") for r in odd.collect()]
    coded = bpe.encode_decode(odd, tokenizer).collect()
    assert sorted((str(r.doc_id), r.decoded, bpe.id_array(r.ids)) for r in coded) == sorted(
        (str(i), t, library.encode(t, add_special_tokens=False).ids) for i, t in texts
    )
    counted = token_counts(odd, tokenizer).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in counted) == sorted(
        (str(i), len(t.encode()), len(library.encode(t, add_special_tokens=False).ids)) for i, t in texts
    )
    assert bpe.encode_decode(empty, tokenizer).count() == 0
    assert token_counts(empty, tokenizer).count() == 0
    with pytest.raises(ValueError, match="already there"):
        bpe.encode_decode(odd, tokenizer, keep=("doc_id", "ids"))
    with pytest.raises(ValueError, match="chunk"):
        token_counts(odd, tokenizer, chunk=10)
