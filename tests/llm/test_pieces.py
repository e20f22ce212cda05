import os
import random
from collections import Counter

import pandas as pd
import pytest

from helpers import ODD, empty_docs, odd_docs, rows_of
from sieveflow.llm import pieces
from sieveflow.llm.pieces import Chunk, Codec, _combine, _matrix_row, _thread, decode, encode, normal, read_model
from sieveflow.llm.queries import PIECES

pytestmark = pytest.mark.skipif(not os.path.exists(PIECES), reason="no vocabulary here")
TEXTS = [
    "a" * 500, "ab" * 333, "thequickbrownfox" * 40, "𝄞é漢字" * 60, "x" + " " * 300 + "y", " " * 90, "\n\n\n" * 50 + "hello   world  ",
    "." * 400, "0123456789" * 50, "日本語のテキスト" * 40, "Words of usual length, and so on; " * 30,
]


@pytest.fixture(scope="module")
def codec():
    return Codec(read_model(PIECES))


def in_chunks(codec, text, size):
    s, pad = normal(text), 3 * codec.longest
    chunks = []
    for at in range(0, len(s), size):
        stop, left = min(at + size, len(s)), min(at, pad)
        chunks.append(Chunk(s[at - left: stop + pad], left, left + stop - at, at == 0, stop == len(s)))
    rows = pd.DataFrame([_matrix_row("d", i, *c.matrix(codec)) for i, c in enumerate(chunks)])
    whole = _combine(rows).iloc[0]
    assert list(whole.w) == [0.0]  # one path leads through
    ends = _thread(rows.assign(d1=0, p1="", d2=0, p2=""))
    return sum((c.trace(codec, (e.d1, e.p1), (e.d2, e.p2)) for c, e in zip(chunks, ends.itertuples())), [])


@pytest.mark.parametrize("size", [20, 64, 131])
def test_chunks_give_what_the_library_gives(codec, size):
    rng = random.Random(size)
    texts = TEXTS + ["".join(rng.choices("abcde  \né▁", k=rng.randrange(30, 400))) for _ in range(60)]
    for t in texts:
        if len(t) >= size:
            assert in_chunks(codec, t, size) == codec.sp.encode(t)


def test_words_and_round_trip(codec):
    for t in TEXTS + [r[1] or "" for r in ODD]:
        assert codec.encode(t) == codec.sp.encode(t) and codec.decode(codec.encode(t)) == t
    assert codec.decode(codec.encode("a▁b")) == "a b"


def test_encode_and_decode(spark, codec, monkeypatch):
    monkeypatch.setattr(pieces, "FAN", 3)  # several levels of the scan
    model = read_model(PIECES)
    rows = ODD + [(30 + i, t * 5, "en", "a", 1) for i, t in enumerate(TEXTS)] * 2
    got = encode(odd_docs(spark, True, rows), model, chunk=100)
    want = Counter((r[0], tuple(codec.sp.encode(r[1] or ""))) for r in rows)
    assert Counter((r.doc_id, tuple(r.ids)) for r in got.collect()) == want
    texts = Counter((r.doc_id, r.text) for r in decode(got, model).collect())
    assert texts == Counter((r[0], r[1] or "") for r in rows)


def test_empty(spark):
    assert rows_of(encode(empty_docs(spark), read_model(PIECES))) == []
