"""What the two classifiers learn from: bounded rows, whole texts, and scores against a plain computation."""

import math

import numpy as np
import zstandard

from scoremill.llm import language_id as I
from scoremill.llm import quality_classifier as Q

WORDS = {"aa": "alba mare sole vita notte luna".split(), "zz": "zug herz katze topf wurst kraft".split()}


def text(language, seed, n=60):
    random = np.random.default_rng([ord(language[0]), seed])
    return " ".join(random.choice(WORDS[language], n))


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_rows_of_a_label_are_bounded_though_ids_repeat(docs, spark, monkeypatch):
    monkeypatch.setattr(Q, "PER_LABEL", 10)
    seen = []
    monkeypatch.setattr(Q, "fit", lambda texts, labels, f=Q.fit: seen.append((texts, labels)) or f(texts, labels))
    long = text("aa", 5, 9_000) + " the very end"
    rows = [(1, text("aa", i)) for i in range(90)] + [(2 + i, text("zz", i)) for i in range(40)] + [(1, long), (1, None), (3, "")]
    rows += rows[:20]
    labels = labels_of(spark, [(1, 1, 0), *[(2 + i, 0, 0) for i in range(40)], (None, 1, 0), (7, None, 0)])
    frame = docs(rows).drop("lang", "source", "n_chars")
    assert Q.learn(frame, labels, held_out_fold=-1) is not None
    texts, marks = seen[0]
    assert sorted(marks) == [0] * 10 + [1] * 10 and len(set(texts)) == 20 and "" not in texts
    monkeypatch.setattr(Q, "PER_LABEL", 1_000)
    Q.learn(frame, labels, held_out_fold=-1)
    assert long in seen[1][0] and len(seen[1][0]) == 131


def test_scores_equal_a_plain_computation(docs, spark):
    rows = [(i, text("aa", i)) for i in range(40)] + [(100 + i, text("zz", i)) for i in range(40)]
    labels = labels_of(spark, [(i, int(i < 100), 0) for i, _ in rows])
    model = Q.learn(docs(rows).select("doc_id", "text"), labels)
    cases = [(1, text("aa", 70)), (2, text("zz", 71) * 50), (3, ""), (4, None), (4, None)]
    frame = docs(cases).withColumnRenamed("lang", "score")
    found = {(r["doc_id"], r["text"]): r["score"] for r in Q.score(frame, model).collect()}
    for key, value in cases:
        data = (value or "").encode()
        sizes = []
        for dictionary in (model.bad, model.good):
            made = zstandard.ZstdCompressor(level=Q.LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary),
                                            write_checksum=False, write_content_size=False, write_dict_id=False)
            sizes.append(len(made.compress(data)))
        measures = ((sizes[0] - sizes[1]) / math.sqrt(len(data) + Q.SHORT), math.log((sizes[1] + 20) / (len(data) + 50)))
        margin = sum(m * s for m, s in zip(measures, model.slopes, strict=True)) + model.offset
        assert abs(found[key, value] - 1 / (1 + math.exp(-margin))) < 1e-9
    assert Q.score(docs([]), model).collect() == []
    assert Q.learn(docs([]).select("doc_id", "text"), labels) == 0.5


def test_rows_of_a_language_are_bounded_and_read_to_their_end(docs, monkeypatch):
    monkeypatch.setattr(I, "PER_LANGUAGE", 5)
    seen = []
    monkeypatch.setattr(I, "train_on_windows", lambda drawn, languages, f=I.train_on_windows: seen.append((drawn, languages)))
    rows = [(1, text("aa", i), "aa", "h") for i in range(30)] + [(2, text("zz", i), "zz", "h") for i in range(3)]
    I.learn(docs(rows + rows), held_out_fold=-1)
    assert sorted(seen[0][1]) == ["aa"] * 5 + ["zz"] * 3
    whole = "a" * 50_000 + "b" * 50_000
    ends = sum((I.drawn_windows(whole + str(i)) == ord("b")).all(axis=1).any() for i in range(20))
    assert ends > 15


def test_language_scores_equal_a_plain_network(docs):
    rows = [(i, text(x, i), x, "h") for i in range(20) for x in ("aa", "zz")]
    model = I.learn(docs(rows))
    value = text("aa", 99, 200)
    found = I.predict(docs([(1, value)]), model).first()
    total = np.zeros(len(model.languages))
    cells = I.windows(value)
    for cell in cells:
        embedded = model.embedding[cell]
        responses = []
        for width, kernel, bias in zip(I.WIDTHS, model.filters, model.biases, strict=True):
            spans = [embedded[a : a + width].ravel() for a in range(I.LENGTH - width + 1)]
            responses.append(np.maximum(np.max([s @ kernel + bias for s in spans], axis=0), 0))
        margins = np.concatenate(responses) @ model.out + model.out_bias
        p = np.exp(margins - margins.max())
        total += p / p.sum()
    total /= len(cells)
    assert found["lang_pred"] == model.languages[int(total.argmax())]
    assert abs(found["score"] - total.max()) < 1e-3
