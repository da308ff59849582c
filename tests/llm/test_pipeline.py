import hashlib
from array import array

import numpy as np
import pytest

import corpus_pipeline
from scoremill.llm import sentencepiece_codec as S

spm = pytest.importorskip("sentencepiece")

VOWELS = {"xx": "aou", "yy": "ei"}


def text(language, seed, n=90):
    random = np.random.default_rng([ord(language[0]), seed])
    syllables = [c + v for c in "bdfgklmnprst" for v in VOWELS[language]]
    return " ".join("".join(random.choice(syllables, 3)) for _ in range(n))


@pytest.fixture(scope="module")
def case(spark, tmp_path_factory):
    """Tables with planted cases, and the ids that stay by the plain meaning of each stage."""
    clean = [(i, text("xx" if i % 2 else "yy", i), "xx" if i % 2 else "yy", f"h{i % 3}") for i in range(40)]
    item = text("xx", 777, 30)
    planted = [
        (100, "12 34 %%", None, "h0"),  # no letters
        (101, None, "xx", None),
        (102, text("xx", 500, 20), "xx", "h1"),  # too short
        (103, "ba be " * 60, "xx", "h1"),  # repeats
        (104, clean[7][1], "xx", "h2"),  # copy of 7
        (105, clean[8][1] + " bebe", "yy", "h0"),  # nearly 8
        (105, clean[8][1] + " bebe", "yy", "h0"),
        (106, text("xx", 501) + "\n" + item + ".\n" + text("xx", 502), "xx", "h2"),  # holds an item
        (None, text("yy", 503), "yy", None),  # clean, without an id
        (107, text("yy", 504, 5000), None, "h1"),  # clean and long
    ]
    folder = str(tmp_path_factory.mktemp("tables"))
    rows = [(*r, len(r[1] or "")) for r in clean + planted]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    items = spark.createDataFrame([(1, item), (2, None)], "item_id long, text string")
    items.write.parquet(f"{folder}/benchmark.parquet")
    stay = {r[0]: r[1] for r in clean} | {None: planted[8][1], 107: planted[9][1]}
    return folder, stay


def test_stages(spark, case):
    folder, stay = case
    library = spm.SentencePieceProcessor(model_file=S.model_file())
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and corpus_pipeline.ORACLE_SQL is None
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert set(out) == set(stay)
    for key, row in out.items():
        ids = array("I", [1, *library.encode(stay[key]), 2])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(stay[key].encode()).hexdigest()


def test_stages_keep_the_columns_and_take_empty_tables(spark, case):
    folder, _ = case
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    wider = docs.selectExpr("*", "'x' AS kept", "1 AS score", "2 AS n_words").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, wider, folder)
        assert out.columns == wider.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, wider, folder).count() == 0
