import hashlib
import random
from array import array

import pytest

from scoremill.llm import sentencepiece_codec as S

spm = pytest.importorskip("sentencepiece")

PIECES = [*"abcdetthin  \n\t▁éßñ漢🙂\x00.,'", "  ", "the ", "tion", "ing", "<s>", "<0x41>", "▁▁", " x"]


@pytest.fixture(scope="module")
def library():
    return spm.SentencePieceProcessor(model_file=S.model_file())


@pytest.fixture(scope="module")
def codec():
    return S.Codec(S.model_file(), fragments=500)


def test_same_ids_and_text_as_the_library(codec, library):
    draw = random.Random(5)
    texts = ["", " ", "\n", "a" * 5000, "the " * 2000, "x y  z "]
    texts += ["".join(draw.choice(PIECES) for _ in range(draw.randint(0, 40))) for _ in range(3000)]
    for text in texts:
        ids = [1, *library.encode(text), 2]
        assert codec.encode(text) == ids
        assert codec.decode(ids) == library.decode(ids)


def test_decodes_any_ids_like_the_library(codec, library):
    draw = random.Random(6)
    for _ in range(2000):
        ids = [draw.choice([1, 2, *range(3, 259), *range(259, 32000, 61)]) for _ in range(draw.randint(0, 12))]
        assert codec.decode(ids) == library.decode(ids)


def test_round_trip_rows(docs, library):
    rows = [(1, None), (2, ""), (3, "the cat\nsat"), (3, "the cat\nsat"), (None, " two  spaces "), (4, "long " * 30000)]
    out = S.round_trip(docs(rows), S.model_file()).collect()
    assert len(out) == 6
    by_id = {r["doc_id"]: r for r in out}
    for key, text in rows:
        ids = array("I", [1, *library.encode(text or ""), 2])
        assert by_id[key]["n_tokens"] == len(ids)
        assert by_id[key]["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
        assert by_id[key]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_columns(docs, spark):
    plain = docs([(1, "some text"), (2, None)]).withColumnRenamed("lang", "token_ids")
    out = S.decode_documents(S.encode_documents(plain, S.model_file()), S.model_file())
    assert {r["doc_id"]: r["decoded"] for r in out.collect()} == {1: "some text", 2: ""}
    assert S.round_trip(docs([]), S.model_file()).count() == 0
