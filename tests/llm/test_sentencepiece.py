import base64
import hashlib
import random
import time

import numpy as np
import pytest

sentencepiece = pytest.importorskip("sentencepiece")

from pyspark.sql import functions as F  # noqa: E402

from stopwise.llm import sentencepiece_bpe as sp  # noqa: E402

from .helpers import LONG, ODD, empty, odd  # noqa: E402


@pytest.fixture(scope="module")
def bpe():
    with open(sp.default_model(), "rb") as f:
        return sp.Bpe(f.read())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=sp.default_model())


def _texts():
    rng = random.Random(3)
    out = ["", None, " ", "  a", "a  b   c ", "\n\n", "\t x▁y", "日本語 テキスト", "ab" * 2000, " " * 333, "é\x00b", "<s></s><unk><0x41>", "😀😀 x", LONG[:20_000], "\ufeffa"]
    out += ["".join(rng.choice("abcdefghinorst  \n,.éß日▁'ABC0123=-_/") for _ in range(rng.randint(0, 200))) for _ in range(500)]
    out += ["".join(rng.choice("ab ") for _ in range(rng.randint(0, 60))) for _ in range(500)]
    out += ["".join(rng.choice(["the", "ing", " ", "tion", "on", "  ", "=", "==", "--", "\n", "    "]) for _ in range(rng.randint(0, 60))) for _ in range(500)]
    return out


def test_equals_the_library(bpe, library):
    texts = _texts()
    ids, at = sp.Encoder(bpe).encode(texts)
    back = sp.Decoder(bpe).decode(ids, at)
    for i, t in enumerate(texts):
        want = library.encode(t or "", add_eos=True)
        assert ids[at[i] : at[i + 1]].tolist() == want and back[i] == library.decode(want)


def test_very_long_words(bpe, library):
    rng = random.Random(4)
    letters = "etaoinshrdlu=-\n"
    texts = [
        " " * 1_000_000,
        *[" " * n + tail for n in (14, 15, 16, 17, 31, 32, 33, 48, 49, 1000) for tail in ("", "a", "the", "\n")],
        base64.b64encode(rng.randbytes(300_000)).decode(),
        "\n".join(rng.choice(["the", "transition", "Haus", "être", "señor", "walking", "123"]) for _ in range(100_000)),
        "".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(200_000)),
        *["".join(rng.choice(letters[:k]) for _ in range(100_000)) for k in (2, 5, 9, 12, 15)],
        *[c * 100_000 for c in ("a", "=", "-", "th", "return", "\t", ".", "abcdefghijklm")],
    ]
    began = time.time()
    ids, at = sp.Encoder(bpe).encode(texts)
    took = time.time() - began
    for i, t in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == library.encode(t, add_eos=True)
    assert took < 60  # a quadratic encoder takes hours


def test_forgetting_words_changes_nothing(bpe, monkeypatch):
    monkeypatch.setattr(sp, "_MEMO_TOKENS", 50)
    enc, texts = sp.Encoder(bpe), _texts()[:60]
    parts = [enc.encode([t])[0].tolist() for t in texts]
    ids, at = sp.Encoder(bpe).encode(texts)
    assert parts == [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]


def test_decoding_of_any_ids(bpe, library):
    rng = random.Random(5)
    rows = [[rng.randrange(3, bpe.n) for _ in range(rng.randint(0, 30))] for _ in range(200)] + [[rng.randrange(3, 259) for _ in range(12)] for _ in range(200)]
    at = np.cumsum([0, *map(len, rows)])
    got = sp.Decoder(bpe).decode(np.array([i for r in rows for i in r]), at)
    assert got == [library.decode(r) for r in rows]
    with pytest.raises(ValueError, match="outside"):
        sp.Decoder(bpe).decode(np.array([bpe.n]), np.array([0, 1]))


def test_columns(spark, library):
    docs = odd(spark).withColumn("IDS", F.lit("old"))
    out = sp.decode(sp.encode(docs, sp.default_model()), sp.default_model()).collect()
    assert len(out) == len(ODD)
    for r in out:
        assert r.ids == library.encode(r.text or "", add_eos=True) and r.decoded == library.decode(r.ids)
    assert sp.encode(empty(spark), sp.default_model()).count() == 0
    nulls = spark.createDataFrame([(None,), ([2],), ([],)], "ids array<int>")
    assert [r.decoded for r in sp.decode(nulls, sp.default_model()).collect()] == ["", "", ""]


def test_digests(spark, library):
    for r in sp.round_trip(odd(spark), sp.default_model()).collect():
        ids = library.encode(r.text or "", add_eos=True)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
