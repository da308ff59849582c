"""Byte-level BPE by forced cuts against the tokenizers library."""

import hashlib
import json
import random

import pytest
from tokenizers import Tokenizer

from scoremill.llm import bpe_codec
from scoremill.llm.bpe_codec import ForcedCutBpe, decode_documents, encode_documents, round_trip, tokenizer_file

PIECES = ["a", "the", "Berlin", " ", "  ", "\n", "\t", "'s", "'ll", "é", "中文", "1", "23", "!", "...", "\x1c", " ",
          "　", "<|endoftext|>", "<|", "😀", "\x00", "​", "\x85", "ß", "word", "_"]


@pytest.fixture(scope="module")
def codec():
    return ForcedCutBpe(tokenizer_file())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_file())


def expected(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    joined = ",".join(map(str, ids)).encode()
    return len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_ids_and_text_equal_the_library(codec, library):
    draw = random.Random(11)
    for _ in range(3000):
        text = "".join(draw.choices(PIECES, k=draw.randrange(16)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text) == ids, text
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_every_kind_of_character(codec, library):
    for code in [*range(0x3100), *range(0x3100, 0x110000, 211)]:
        if not 0xD800 <= code < 0xE000:
            text = f"a{chr(code)}b 1{chr(code)}2 {chr(code)} {chr(code)}{chr(code)}"
            assert codec.encode(text) == library.encode(text, add_special_tokens=False).ids, hex(code)


def test_any_ids_decode_alike(codec, library):
    draw = random.Random(12)
    for _ in range(500):
        ids = [draw.randrange(50257) for _ in range(8)]
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["a" * 60_000, "ab" * 30_000, "中文" * 20_000, " " * 5_000 + "x", "x\n" * 9_000])
def test_long_texts_without_cuts(codec, library, text):
    assert codec.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_cuts_stand_where_no_token_reaches_across(codec):
    pairs = {token[i : i + 2] for token in codec.bytes_of for i in range(len(token) - 1)}
    for data in ("naïve café".encode(), b"x\x00y\xff\xfez", "日本語".encode() * 40):
        parts = codec.cut(data)
        assert b"".join(parts) == data
        assert all(left[-1:] + right[:1] not in pairs for left, right in zip(parts, parts[1:], strict=False))
        assert all(part[i : i + 2] in pairs for part in parts for i in range(len(part) - 1))


def test_a_full_store_of_words_changes_nothing(library):
    small = ForcedCutBpe(tokenizer_file(), kept=2)
    text = "one two three one two three four"
    assert small.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_other_tokenizers_are_refused(tmp_path):
    with pytest.raises(ValueError):
        ForcedCutBpe(tokenizer_file("word_bpe_49k.json"))
    with open(tokenizer_file(), encoding="utf-8") as file:
        spec = json.load(file)
    spec["normalizer"] = {"type": "NFC"}
    other = tmp_path / "other.json"
    other.write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        ForcedCutBpe(str(other))


def test_rows_nulls_repeats_and_clashing_columns(spark, library):
    long = "the quick brown fox " * 3_000
    rows = [(1, "a b", "x"), (1, "a b", "x"), (None, None, "y"), (2, "", None), (3, long, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    found = sorted(map(tuple, round_trip(docs, tokenizer_file()).collect()), key=str)
    assert found == sorted([(i, *expected(library, text or "")) for i, text, _ in rows], key=str)
    assert round_trip(docs.limit(0), tokenizer_file()).collect() == []

    clash = docs.withColumnRenamed("n_tokens", "token_ids")
    decoded = decode_documents(encode_documents(clash, tokenizer_file()), tokenizer_file())
    assert sorted(str(r["decoded"]) for r in decoded.collect()) == sorted(text or "" for _, text, _ in rows)
    assert decoded.columns == ["doc_id", "text", "token_ids", "decoded"]


def test_query_over_the_given_documents(spark, data, library):
    found = {r["doc_id"]: tuple(r)[1:] for r in bpe_codec.op11_bpe_codec(spark, data).collect()}
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(docs)
    for row in docs:
        assert found[row["doc_id"]] == expected(library, row["text"] or "")
