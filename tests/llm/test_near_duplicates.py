import numpy as np
import pytest

from scoremill.llm import near_duplicates as N


def shingles(text, size):
    words = text.encode().lower().split() if text else []
    if not words:
        return frozenset()
    size = min(size, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute_force(rows, size, percent):
    """Smallest id reachable by row number, from all pairs."""
    sets = [shingles(text, size) for _, text in rows]
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                x, y = label[i], label[j]
                label = [min(x, y) if v in (x, y) else v for v in label]
    ids = {}
    for (key, _), c in zip(rows, label, strict=True):
        if key is not None:
            ids[c] = min(ids.get(c, key), key)
    return [ids.get(c) for c in label], [len(s) for s in sets]


def edited(text, random, edits):
    words = text.split()
    for at in random.integers(0, len(words), edits):
        words[at] = f"edit{random.integers(0, 9)}"
    return " ".join(words)


def compare(docs, rows, size=4, percent=80):
    component, sizes = brute_force(rows, size, percent)
    expected = sorted(zip([r[0] for r in rows], sizes, component, strict=True), key=str)
    out = N.find(docs(rows), size, percent).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out), key=str) == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)


def test_against_all_pairs(docs, prose):
    random = np.random.default_rng(3)
    rows = [(10 * i, prose(i, 100)) for i in range(25)]
    rows += [(10 * i + 1 + k, edited(prose(i, 100), random, k)) for i in range(12) for k in (0, 1, 2, 3, 4, 5)]
    rows += [(900, None), (901, ""), (902, " \n"), (903, "two words"), (904, "Two  WORDS"), (905, "x " * 20_000),
             (906, "x " * 30_000), (None, "only words without id"), (907, "only words without id"), (903, prose(1, 100))]
    compare(docs, rows)


def test_large_group_of_unequal_copies(docs, prose, monkeypatch):
    monkeypatch.setattr(N, "SMALL", 3)
    random = np.random.default_rng(4)
    base = prose(1, 120)
    rows = [(i, edited(base, random, int(random.integers(1, 9)))) for i in range(120)]
    compare(docs, rows)


def test_shuffled_when_classes_are_many(docs, prose, monkeypatch):
    monkeypatch.setattr(N, "BROADCAST_CLASSES", 0)
    compare(docs, [(1, prose(1)), (2, prose(1) + " more"), (3, prose(2))], size=5)


def test_one_of_each_group_stays(docs, prose):
    rows = [(5, prose(1)), (5, prose(1)), (3, prose(1) + " tail"), (9, prose(2)), (9, prose(2)), (7, None), (7, None), (8, prose(3))]
    frame = docs(rows).withColumnRenamed("lang", "component_id")
    out = N.deduplicate(frame)
    assert out.columns == frame.columns
    assert sorted(r["doc_id"] for r in out.collect()) == [3, 7, 7, 8, 9]


def test_empty(docs):
    assert N.find(docs([])).count() == 0 == N.deduplicate(docs([])).count()


def test_minwise_tokens_agree_as_sets_do():
    random = np.random.default_rng(1)
    a = random.integers(0, 1 << 63, 2000, np.uint64)
    b = np.concatenate([a[:1600], random.integers(0, 1 << 63, 400, np.uint64)])
    minwise = N.Minwise()
    share = (minwise(a) == minwise(b)).mean()
    assert share == pytest.approx(1600 / 2400, abs=0.15)
    assert N.sketch(minwise(a)).shape == (N.TOKENS // 64,)


def test_one_row_of_a_group_stays_whatever_its_ids(docs, prose):
    rows = [(5, prose(1)), (5, prose(1) + " tail"), (None, prose(2)), (None, prose(2) + " tail"), (None, None)]
    kept = N.deduplicate(docs(rows)).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == ["5", "None", "None"]
    assert sum(r["text"] is None for r in kept) == 1


def test_many_texts_of_one_id_are_read_once(spark, docs, prose, monkeypatch):
    """Sets are made from the text of a class, not from all texts of its id."""
    rows = [(7, prose(i, 40)) for i in range(200)] + [(7, prose(i, 40) + " tail") for i in range(200)]
    made = []

    def counted(join, wanted, sets=N.Join.sets):
        found = sets(join, wanted)
        made.append((found.count(), wanted.count()))
        return found

    monkeypatch.setattr(N.Join, "sets", counted)
    out = N.find(docs(rows), 5, 80).collect()
    assert {r["component_id"] for r in out} == {7} and len(out) == 400
    assert made and all(sets == wanted for sets, wanted in made)


def test_recall_over_the_given_documents(spark, data):
    """All similar pairs of ids divisible by 20 with any document are in one component."""
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    component = {r["doc_id"]: r["component_id"] for r in N.op10_near_duplicates(spark, data).collect()}
    sets = {key: shingles(text, 4) for key, text in rows}
    pairs = [(a, b) for a in sets if a % 20 == 0 for b in sets
             if a != b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert pairs and all(component[a] == component[b] for a, b in pairs)


def test_rows_of_nodes_are_narrow_and_only_shared_shingles_kept(spark, docs, prose):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f h"), (3, prose(5, 40))]
    join = N.Join(docs(rows), 4, 80)
    assert join.roots().columns == ["node", "c"]  # sketches went through the shuffle with all of them
    large = join.classes.selectExpr("1L AS node", "c")
    placed = join.set_shingles(large)
    numbers = {r["doc_id"]: r["c"] for r in join.classes.collect()}
    held = sorted((r["c"], r["n"], r["common"]) for r in placed.collect())
    assert held == sorted((numbers[i], 4, 2) for i in (1, 2) for _ in range(3))
    one = join.some_classes(large.where(f"c = {numbers[3]}"))
    assert [r["doc_id"] for r in one.collect()] == [3]
    # The third class holds no shared shingle and still meets the centre.
    met = {(r["a"], r["b"]) for r in join.central_pairs(large, placed).collect()}
    assert len(met) == 2 and numbers[3] in {c for pair in met for c in pair}
