"""SentencePiece ids by the agenda against the library."""

import hashlib
import random

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor

from valuetide.llm import pieces
from valuetide.llm.binary import public_tokenizer

NAME = "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=public_tokenizer(NAME)())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("table", ["hard", "small"])
def test_piece_digests(request, library, table):
    docs = request.getfixturevalue(table)
    want = []
    for r in docs.select("doc_id", "text").collect():
        ids = library.encode(r.text or "")
        want.append((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)), True))
    got = pieces.piece_digests(docs)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "agrees"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_texts_of_hard_characters(library):
    own = pieces.vocabulary(public_tokenizer(NAME)())
    rng = random.Random(6)
    pool = "ab   ▁▁ é日本🎉\x00\n\t<0x0A><s></s>theing ́�İß"
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(60))) for _ in range(3000)]
    planes = [range(1, 0xD800), range(0xE000, 0x110000)]
    texts += ["".join(chr(rng.choice(rng.choice(planes))) for _ in range(500)) for _ in range(40)]
    texts += ["a" * 50_000 + "the" * 20_000, " " * 30_000, "", " ", "▁", "  x  "]
    for text, found in zip(texts, own.encode(texts)):
        assert found == (library.encode(text), True), text[:80]
        assert own.by_list(text[:400]) == own.by_heap(text[:400])


def test_short_runs_are_worked_side_by_side(monkeypatch):
    """As one by one, also where characters are no piece; no short run has a list of its own."""
    own = pieces.Pieces(public_tokenizer(NAME)())
    rng = random.Random(8)
    pool = "theingards▁.,\n%é日🎉\x00"
    runs = ["".join(rng.choice(pool) for _ in range(n)) for n in range(1, pieces.WIDTHS[-1] + 20) for _ in range(40)]
    want = [list(map(int, own.run_ids(r))) for r in runs]
    lists = []
    monkeypatch.setattr(own, "by_list", lists.append)
    monkeypatch.setattr(pieces, "ROWS", 7)
    assert [np.frombuffer(b, "<u4").tolist() for b in own.checked(runs)] == want
    assert lists == []


def test_agenda_prefers_high_scores_then_the_left():
    own = pieces.Pieces.__new__(pieces.Pieces)
    own.costs = {"ab": 1.0, "bc": 0.0, "aa": 2.0, "aab": 5.0}
    for symbols in (own.by_list, own.by_heap):
        assert symbols("abc") == ["a", "bc"]
        assert symbols("aaa") == ["aa", "a"]
        assert symbols("aab") == ["aab"] and symbols("aac") == ["aa", "c"]
        assert symbols("") == []


def test_ids_and_texts_come_back(spark, library):
    texts = ["Hello  world", None, "", "日本 ▁ x\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "name int, body string")
    got = {r.name: r for r in pieces.encode_texts(df, public_tokenizer(NAME), "name", "body").collect()}
    for k, text in enumerate(texts):
        assert got[k].ids == library.encode(text or "") and got[k].agrees
        assert got[k].decoded == library.decode(got[k].ids)


def test_long_batches_are_cut(spark, library, monkeypatch):
    assert list(pieces._slices(["a"] * 3)) == [(0, 3)] and list(pieces._slices([])) == []
    monkeypatch.setattr(pieces, "BATCH_CHARS", 4)
    assert list(pieces._slices(["abc", None, "de", "f"])) == [(0, 3), (3, 4)]


def test_a_differing_run_is_told(library):
    own = pieces.Pieces(public_tokenizer(NAME)())
    own.ids["▁world"] += 1
    texts = ["hello there", "hello world", "a world " + "x" * 200, "hello ", ""]
    assert [agrees for _, agrees in own.encode(texts)] == [True, False, False, True, True]


def test_no_documents(none):
    assert pieces.piece_digests(none).collect() == []
