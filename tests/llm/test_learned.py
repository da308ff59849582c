import numpy as np
import pytest

from scoremill.llm import common
from scoremill.llm import language_id as I
from scoremill.llm import pitman_yor as P
from scoremill.llm import quality_classifier as Q

WORDS = {"aa": "alba mare sole vita notte luna".split(), "zz": "zug herz katze topf wurst kraft".split()}


def text(language, seed, n=60):
    random = np.random.default_rng([ord(language[0]), seed])
    return " ".join(random.choice(WORDS[language], n))


# Language


def test_slopes_are_those_of_the_loss():
    model = I.train([text("aa", i) for i in range(3)] + [text("zz", i) for i in range(3)], ["aa"] * 3 + ["zz"] * 3)
    params = [p.astype(np.float64) for p in (model.embedding, *model.filters, *model.biases, model.out, model.out_bias)]
    inputs, marks = np.concatenate([I.windows(text(x, 9)) for x in ("aa", "zz")]), []
    marks = np.array([0] * len(I.windows(text("aa", 9))) + [1] * len(I.windows(text("zz", 9))))

    def loss():
        own = I.Model(model.languages, params[0], tuple(params[1:4]), tuple(params[4:7]), params[7], params[8])
        return -np.log(I.Network(own).probabilities(inputs)[np.arange(len(marks)), marks]).mean()

    slopes = I._slopes(params, inputs, marks)
    for p, g in zip(params, slopes, strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        before, p[at] = p[at], p[at] + 1e-5
        up = loss()
        p[at] = before - 1e-5
        assert (up - loss()) / 2e-5 == pytest.approx(g[at], rel=1e-2, abs=1e-6)
        p[at] = before


def test_languages_and_edges(docs):
    rows = [(i, text("aa", i), "aa") for i in range(40)] + [(100 + i, text("zz", i), "zz") for i in range(40)]
    rows = [(*r, "h") for r in rows]
    model = I.learn(docs(rows))
    cases = [(1, text("aa", 99), None, None), (2, text("zz", 99) * 300, "aa", None), (3, None, "aa", None), (4, "", None, None),
             (5, "12 34 %%", "zz", None), (5, text("zz", 7), None, None), (None, "herz", None, None)]
    frame = docs(cases).withColumnRenamed("source", "score")
    out = I.predict(frame, model).collect()
    assert sorted((r["doc_id"] or 0, r["lang_pred"]) for r in out) == [
        (0, "zz"), (1, "aa"), (2, "zz"), (3, "und"), (4, "und"), (5, "und"), (5, "zz")]
    assert all(0 <= r["score"] <= 1 for r in out)
    assert I.filter_documents(frame, model).columns == frame.columns
    assert I.filter_documents(frame, model).count() == 4
    assert I.learn(docs([(1, "x", None, None)])) is None
    assert {r["lang_pred"] for r in I.predict(frame, None).collect()} == {"und"}
    assert I.predict(docs([]), model).count() == 0


def test_windows_cover_the_text():
    for n in (1, 127, 128, 129, 1000):
        own = I.windows("x" * n)
        assert own.shape[1] == I.LENGTH and (own == ord("x")).sum() >= n


# Quality


def labelled(docs, spark, n=60):
    good, bad = ([(k + i, text(x, i), x, "h") for i in range(n)] for k, x in ((0, "aa"), (1000, "zz")))
    frame = docs(good + bad)
    labels = spark.createDataFrame([(r[0], int(r[2] == "aa"), 0) for r in good + bad] + [(5, None, 1), (None, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    return frame, labels


def test_quality_learns_the_labels(docs, spark):
    frame, labels = labelled(docs, spark)
    model = Q.learn(frame, labels)
    cases = [(1, text("aa", 500)), (2, text("zz", 500)), (3, None), (3, ""), (None, text("zz", 501) * 200)]
    scores = {(r["doc_id"], r["n_chars"] == 0): r["score"] for r in Q.score(docs(cases), model).collect()}
    assert scores[1, False] > 0.7 > 0.3 > scores[2, False]
    assert 0 <= scores[None, False] <= 1 and 0 <= scores[3, True] <= 1
    assert Q.learn(frame, labels) == model


def test_quality_without_two_labels(docs, spark):
    frame, labels = labelled(docs, spark)
    assert Q.learn(frame, labels.limit(0)) == 0.5
    assert Q.learn(frame, labels.where("quality = 1")) > 0.9
    assert Q.score(frame, 0.5).select("score").distinct().count() == 1


# Language model


def test_stirling_numbers_count_seatings():
    d = 0.4
    logs = P.stirling(d)
    assert np.exp(logs[2, 1]) == pytest.approx(1 - d)
    assert np.exp(logs[3, 2]) == pytest.approx(3 - 3 * d)
    assert np.exp(logs[3, 1]) == pytest.approx((1 - d) * (2 - d))


def test_tables_follow_their_conditional():
    n, random = 40_000, np.random.default_rng(0)
    weight, chance, d = 2.0, 0.3, 0.5
    drawn = P.tables_of(np.full(n, 3), np.full(n, weight), np.full(n, chance), d, random)
    raw = [chance * weight * (1 - d) * (2 - d), chance**2 * weight * (weight + d) * (3 - 3 * d),
           chance**3 * weight * (weight + d) * (weight + 2 * d)]
    assert np.bincount(drawn, minlength=4)[1:] / n == pytest.approx(np.array(raw) / sum(raw), abs=0.01)
    many = P.tables_of(np.array([0, 1, 5000]), np.full(3, weight), np.full(3, chance), d, random)
    assert many[0] == 0 and many[1] == 1 and 1 < many[2] < 5000


def train_rows():
    random = np.random.default_rng(4)
    pool = [f"w{i}" for i in range(30)]
    return [(i, " ".join(random.choice(pool, 40, p=np.arange(30, 0, -1) / 465)) + " the end") for i in range(60)]


def test_scores_and_edges(docs, spark):
    from pyspark.sql import functions as F

    rows = [*train_rows(), (100, None), (101, ""), (102, "unseen words only"), (102, "W1 w1"), (None, "w1 w2"), (103, "w3 " * 30_000)]
    frame = docs(rows).withColumn("held_out", F.expr("doc_id >= 100")).withColumnRenamed("lang", "score")
    out = P.score(frame).collect()
    assert len(out) == len(rows)
    tokens = {(r[0], len(r[1] or "")): len((r[1] or "").lower().split()) + 1 for r in rows}
    for r in out:
        assert r["n_known"] <= r["n_tokens"] and r["score"] < 0 and r["base_score"] < 0
        assert r["held_out"] == (r["doc_id"] is not None and r["doc_id"] >= 100)
    assert sorted(r["n_tokens"] for r in out) == sorted(tokens.values())
    train = [r for r in out if not r["held_out"]]
    assert train[0]["train_tokens"] == sum(r["n_tokens"] for r in train)
    assert sum(r["score"] for r in train) > sum(r["base_score"] for r in train)
    assert [r["n_known"] for r in out if r["doc_id"] == 102] in ([1, 3], [3, 1])
    again = P.score(frame).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))
    assert P.score(frame.limit(0)).count() == 0


def test_chances_sum_to_one(docs, spark, monkeypatch):
    """Over all words of a context, seen or not, and with some of them spread as frequent ones."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(P, "CONTEXTS", 4)
    monkeypatch.setattr(P, "FREQUENT", 0.04)
    frame = docs(train_rows()).withColumn("held_out", F.lit(False))
    frequent = P.frequent_words(frame)
    assert len(frequent) > 2
    rows = P.gathered(P.blocks(frame, 5, frequent)).where("bucket >= 0").toPandas().to_dict("records")
    model = P.train(spark.createDataFrame([(r["bucket"], *(bytes(r[c]) for c in P.COUNTED[1:])) for r in rows],
                                          "bucket long, words binary, pairs binary, contexts binary, seen binary"), frequent)
    sums = np.zeros(P.CONTEXTS)
    totals = model.history[-1]
    root = 0.0
    for row in rows:
        bucket = P.Bucket(row, model)
        for k in range(P.SWEEPS):
            bucket.sweep(k)
        chance = bucket.chance(totals)
        rare = np.setdiff1d(np.arange(len(chance)), bucket.often)
        root += chance[rare].sum()
        own = bucket.seen - model.discount * bucket.tables
        sums += np.bincount(bucket.context, own, P.CONTEXTS)
    often = model.root_chance(totals.often_customers, totals.often_tables, totals)
    unknown = model.root_chance(np.zeros(1), np.zeros(1), totals)[0]
    root += often[model.often_seen > 0].sum() + unknown
    assert root == pytest.approx(1)
    whole = (sums + (P.STRENGTH + model.discount * totals.tables) * root) / (P.STRENGTH + model.customers)
    assert whole == pytest.approx(np.ones(P.CONTEXTS))


def test_word_hashes_are_of_ascii_words():
    known = common.HashOfWord(limit=3)
    same = common.word_hashes("A\tb\x0bÄ c d", known), common.word_hashes("a b Ä  c d\n", known)
    assert (same[0] == same[1]).all() and len(same[0]) == 4
    assert len(common.word_hashes(None, known)) == 0
