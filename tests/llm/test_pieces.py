"""SentencePiece encoding by the prefix table, against the library."""

import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from sentencepiece import SentencePieceProcessor

from tests.conftest import SF0001
from tessera.llm import pieces
from tessera.llm.queries import tokenizer_path

LETTERS = "aé1 ''  srtevmldthe\n\t!. 中\U0001f600▁ñçﬁ\x00​,;e"
ODD = ["", " ", "a" * 1000, " " * 700, " " * 33 + "x", "▁" * 50, "the" * 700 + " x", "é" * 900, "\U0001f600" * 300, "=-" * 500, "中文" * 999, "<s> </s> <0x0A> <unk>"]


@pytest.fixture(scope="module")
def path():
    return tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library(path):
    return SentencePieceProcessor(model_file=path)


@pytest.fixture(scope="module")
def own(path):
    with open(path, "rb") as f:
        return pieces.PrefixTable(f.read())


def _ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


def test_like_the_library(own, library, monkeypatch):
    rng = random.Random(7)
    texts = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ODD + pq.read_table(f"{SF0001}/documents.parquet")["text"].to_pylist()
    for held, remembered in ((pieces.HELD, pieces.REMEMBERED), (40, 6)):
        monkeypatch.setattr(pieces, "HELD", held)
        monkeypatch.setattr(pieces, "REMEMBERED", remembered)
        coded = own.encode([t.encode() for t in texts])
        for text, ids, back in zip(texts, coded, own.decode(coded)):
            want = library.encode(text, add_bos=True, add_eos=True)
            assert _ids(ids) == want, text[:60]
            assert back == library.decode(want)


def test_decode_any_ids(own, library):
    rng = random.Random(8)
    for _ in range(3000):
        ids = [rng.choice([0, 1, 2, 259, 260, 28705, *[3 + rng.randrange(256)] * 6, rng.randrange(32000)]) for _ in range(rng.randint(0, 12))]
        assert own.decode([np.array(ids, "<u4").tobytes()])[0] == library.decode(ids), ids


def test_table_holds_the_last_token_of_each_prefix(own, library):
    for text in ("the thing, thereafter", "internationalisation 1234", "été \U0001f600 x", "aaaaaaa   b"):
        marked = "▁" + text.replace(" ", "▁")
        last = own.last_tokens(marked)
        for end in range(2, len(marked) + 1):
            token = library.encode(text[: end - 1])[-1]
            assert last[end] == token or (last[end] == -1 and library.is_byte(token))


def test_cuts_are_in_no_piece(own):
    for piece in own.score:
        raw = piece.encode()
        assert not any(own.apart[a << 8 | b] for a, b in zip(raw, raw[1:]))


def test_frames(spark, odd, empty, path, library):
    texts = [(r.doc_id, r.text or "") for r in odd.collect()]
    rows = pieces.encode_decode(odd, path).collect()
    want = [(str(i), library.encode(t, add_bos=True, add_eos=True)) for i, t in texts]
    assert sorted((str(r.doc_id), _ids(r.ids), r.decoded) for r in rows) == sorted((i, x, library.decode(x)) for i, x in want)
    assert pieces.encode_decode(empty, path).count() == 0
    with pytest.raises(ValueError, match="already there"):
        pieces.encode_decode(odd, path, keep=("doc_id", "ids"))


def test_other_models_are_refused(path):
    with open(path, "rb") as f:
        model = f.read()
    with pytest.raises(ValueError, match="not a"):
        pieces.PrefixTable(model + bytes([0x12, 2, 0x18, 1]))  # a trainer part that names another kind of model
