import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark import cloudpickle

from scoremill.llm import token_files as T
from scoremill.session import run_folder

tokenizers = pytest.importorskip("tokenizers")


def test_same_ids_as_the_library():
    coder = T.WordwiseTokenizer(T.tokenizer_file(), limit=300)
    draw = random.Random(2)
    pool = [*"abcdethin  \n\t\x85 éß漢🙂.,'\"1(){}= ", "  ", "the ", " \n", "'s", "<|endoftext|>", " <|endoftext|> "]
    texts = [None, "", " ", *("".join(draw.choice(pool) for _ in range(draw.randint(0, 40))) for _ in range(5000))]
    for at in range(0, len(texts), 100):
        some = texts[at : at + 100]
        found = coder.tokenizer.encode_batch([t or "" for t in some], add_special_tokens=False)
        for packed, own in zip(coder.encode_all(some), found, strict=True):
            assert np.frombuffer(packed, coder.kind).tolist() == own.ids


def test_perfect_hash():
    keys = np.random.default_rng(1).integers(0, 1 << 63, 20_000, np.uint64)
    perfect = T.PerfectHash.of(keys)
    assert sorted(perfect.slots(keys)) == list(range(len(keys)))
    again = T.PerfectHash.load(perfect.save())
    assert (again.slots(keys) == perfect.slots(keys)).all()
    assert len(T.PerfectHash.of(keys[:0]).slots(keys[:3])) == 3
    with pytest.raises(ValueError):
        T.PerfectHash.of(np.array([5, 5], np.uint64))


def test_files_keep_every_row(docs, spark):
    rows = [(7, "seven words"), (3, None), (7, "again seven"), (None, "no id"), (1, ""), (2, "x " * 20000), (None, "")]
    folder = run_folder(spark, "test-token-files")
    T.write_token_files(docs(rows), folder, T.tokenizer_file())
    keys = spark.read.parquet(f"{folder}/entries").select("doc_id", "copy")
    out = T.digests(T.locate(keys, folder), folder).collect()
    library = tokenizers.Tokenizer.from_file(T.tokenizer_file())
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, expected = 0, []
    for key, text in ordered:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        expected.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, out), key=lambda r: r[1]) == expected
    unknown = spark.createDataFrame([(99, 0), (7, 5)], "doc_id long, copy long")
    assert T.locate(unknown, folder).count() == 0


def test_empty(docs, spark):
    folder = run_folder(spark, "test-token-files")
    T.write_token_files(docs([]), folder, T.tokenizer_file())
    keys = spark.read.parquet(f"{folder}/entries").select("doc_id", "copy")
    assert T.digests(T.locate(keys, folder), folder).count() == 0


def test_a_third_of_rows_on_one_id_is_dealt_over_shards(spark, docs, tmp_path, monkeypatch):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(7 if i % 3 else i, f"text number {i} of many") for i in range(600)] + [(None, f"none {i}") for i in range(90)]
        folder = str(tmp_path / "hot")
        T.write_token_files(docs(rows), folder, T.tokenizer_file())
        entries = spark.read.parquet(f"{folder}/entries")
        assert entries.filter("doc_id = 7").select("shard").distinct().count() > 1
        keys = [(r["doc_id"], r["copy"]) for r in entries.collect()]
        assert sorted(k for d, k in keys if d == 7) == list(range(400)) and len(set(keys)) == len(rows)
        out = T.digests(T.locate(entries.select("doc_id", "copy"), folder), folder).collect()
        library = tokenizers.Tokenizer.from_file(T.tokenizer_file())
        expected = Counter((d, zlib.crc32(np.array([*library.encode(t).ids, 2], "<u4").tobytes())) for d, t in rows)
        assert Counter((r["doc_id"], r["ids_crc32"]) for r in out) == expected
        assert sorted(r["start"] for r in out)[0] == 0 and len({r["start"] for r in out}) == len(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_a_path_without_scheme_is_on_the_default_file_system(spark, docs, tmp_path):
    assert T._qualified(spark, str(tmp_path)).startswith("file:/")
    assert T._qualified(spark, f"file://{tmp_path}").startswith("file:/")


def test_the_library_sees_words_once_whatever_stands_beside_them():
    coder = T.WordwiseTokenizer(T.tokenizer_file())
    draw = random.Random(4)
    words = ["".join(draw.choice("abcdeh") for _ in range(7)) for _ in range(60)]
    gaps = [" ", " ", " ", ". ", ", ", "\n", ".\n\n", "  ", "\n  ", ".\r\n", "\t", " \n"]
    texts = ["".join(draw.choice(words) + draw.choice(gaps) for _ in range(60)) for _ in range(300)]
    taken = []
    whole = coder._whole

    def counted(some):
        taken.extend(map(len, some))
        return whole(some)

    coder._whole = counted
    found = coder.encode_all(texts)
    assert sum(taken) < sum(map(len, texts)) / 20
    ids = [x.ids for x in coder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, coder.kind).tolist() for x in found] == ids
    assert not any(" " in word for word in coder.known)


def test_white_space_beside_added_tokens_ends_a_text():
    coder = T.WordwiseTokenizer(T.tokenizer_file())
    pieces = ["a b{}<|endoftext|>c d", "a{}<|endoftext|>", "<|endoftext|>{}a b", "a <|endoftext|>{}. b", "a{}\x85b c", "a b\x0b{}c"]
    texts = [p.format(gap) for p in pieces for gap in ("\n", "\n\n", "\t\n", "  ", " \n ", "\r\n")]
    ids = [x.ids for x in coder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, coder.kind).tolist() for x in coder.encode_all(texts)] == ids


def test_a_pattern_that_joins_line_ends_to_punctuation_is_not_cut_at_lines(tmp_path):
    tokenizer = tokenizers.Tokenizer.from_file(T.tokenizer_file())
    pattern = tokenizers.Regex(r"\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+\n*|\s+(?!\S)|\s+".replace(r"\p{L}+", r" ?\p{L}+", 1))
    tokenizer.pre_tokenizer = tokenizers.pre_tokenizers.Sequence(
        [
            tokenizers.pre_tokenizers.Split(pattern, "isolated"),
            tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ]
    )
    tokenizer.save(str(tmp_path / "joins.json"))
    coder = T.WordwiseTokenizer(str(tmp_path / "joins.json"))
    texts = ["end.\nNext one.\n\nLast", "a  b.\n c", "plain words, here"]
    ids = [x.ids for x in coder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, coder.kind).tolist() for x in coder.encode_all(texts)] == ids


def test_tasks_of_a_worker_share_the_tokenizer(monkeypatch):
    monkeypatch.setattr(T, "_loaded", {})
    path = T.tokenizer_file()

    def task():
        return T._coder(path)

    # What Spark does for every task: the function is read anew.
    sent = cloudpickle.dumps(task)
    assert cloudpickle.loads(sent)() is cloudpickle.loads(sent)()


def test_the_writer_names_no_store_of_its_own():
    inner = [c for c in T.write_token_files.__code__.co_consts if hasattr(c, "co_names")]
    assert inner and not any("_loaded" in c.co_names for c in inner)
