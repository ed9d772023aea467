import brute
import numpy as np
import pytest

from tidemark.llm import components, simhash, vectors
from tidemark.llm.scratch import Scratch

VECTORS = "vec_id long, embedding array<float>, label int, v string, cls int, n_links string, bucket int"


@pytest.mark.parametrize("kind", ["chain", "star", "random", "empty"])
def test_components(spark, scratch, kind):
    rng = np.random.default_rng(0)
    edges = {
        "chain": [(i, i + 1) for i in range(60)] + [(100, 100), (None, 5), (7, None)],
        "star": [(500, i) for i in range(80)] * 2,
        "random": [tuple(map(int, e)) for e in rng.integers(0, 80, (50, 2))],
        "empty": [],
    }[kind]
    sets = brute.Sets()
    for a, b in edges:
        if a is not None and b is not None:
            sets.unite(a, b)
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components.components(df, scratch).collect()}
    assert got == {n: sets.find(n) for n in sets.up if sets.find(n) != n}


def simhash_rows(df, stage):
    return sorted((tuple(r) for r in simhash.simhash_groups(df, stage).collect()), key=repr)


def test_simhash_on_odd_documents(odd_documents, odd_rows, scratch):
    assert simhash_rows(odd_documents, scratch) == sorted(brute.simhash(odd_rows), key=repr)


def test_simhash_of_nothing(no_documents, scratch):
    assert simhash_rows(no_documents, scratch) == []


def near_texts(n, edits, seed=3):
    rng = np.random.default_rng(seed)
    base = [f"t{x}" for x in rng.integers(0, 900, 120)]
    rows = []
    for key in range(n):
        words = list(base)
        for _ in range(rng.integers(0, edits)):
            words[rng.integers(len(words))] = f"e{rng.integers(1000)}"
        rows.append((key, " ".join(words)))
    return rows


def test_simhash_large_groups_in_blocks(spark, scratch, monkeypatch):
    """Groups above the limit meet block by block; nothing is lost."""
    monkeypatch.setattr(simhash, "GROUP", 7)
    monkeypatch.setattr(simhash, "TILE", 3)
    rows = near_texts(60, 12)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert simhash_rows(df, scratch) == sorted(brute.simhash(rows), key=repr)


@pytest.mark.parametrize("classes", [10, 10**7, 10**10])
def test_bands_lose_no_pair(classes):
    """Any four bits may differ: some choice of bands holds none of them."""
    choices = simhash.band_choices(classes)
    rng = np.random.default_rng(1)
    for _ in range(500):
        bits = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(not c & bits for c in choices)


def vector_rows():
    rng = np.random.default_rng(5)
    rows = []
    for key in range(120):
        base = np.random.default_rng(key % 9).standard_normal(16)
        v = base + 0.25 * rng.standard_normal(16)
        rows.append((key, v.astype(np.float32).tolist(), key % 3))
    rows += [(200, rows[0][1], 0), (201, rows[0][1], 0), (201, rows[1][1], 1), (202, rows[0][1], None)]
    rows += [(203, None, 0), (204, [], 0), (205, [0.0] * 16, 0), (206, [float("nan")] * 16, 0)]
    rows += [(207, [None] * 16, 0), (208, [1.0, float("inf")] * 8, 0), (209, [1.0, 2.0], 0)]
    rows += [(None, rows[0][1], 0), (210, [x * 4 for x in rows[0][1]], 0), (200, rows[0][1], 0)]
    return rows


def vector_result(spark, rows, stage):
    df = spark.createDataFrame([(*r, "v", 1, "n", 2) for r in rows], VECTORS)
    return sorted((tuple(r) for r in vectors.near_vectors(df, stage).collect()), key=repr)


def test_vectors(spark, scratch):
    rows = vector_rows()
    assert vector_result(spark, rows, scratch) == sorted(brute.vectors(rows), key=repr)


def test_vectors_in_blocks(spark, scratch, monkeypatch):
    monkeypatch.setattr(vectors, "GROUP", 5)
    monkeypatch.setattr(vectors, "TILE", 2)
    rows = vector_rows()
    assert vector_result(spark, rows, scratch) == sorted(brute.vectors(rows), key=repr)


def test_no_vectors(spark, scratch):
    assert vector_result(spark, [], scratch) == []


def test_recall_at_the_threshold():
    """Pairs right at the threshold share a bucket in some table."""
    rng = np.random.default_rng(2)
    bits, tables = vectors.plan_tables(50_000)
    a = rng.standard_normal((3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((3000, 64))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    b = 0.93 * a + np.sqrt(1 - 0.93**2) * b
    x, y = vectors.signatures(a, bits, tables), vectors.signatures(b, bits, tables)
    assert (x == y).any(axis=1).mean() > 0.995


def test_forest():
    forest = components.Forest(8)
    forest.unite(np.array([7, 3, 5]), np.array([3, 1, 6]))
    assert forest.label.tolist() == [0, 1, 2, 1, 4, 5, 5, 1]
    member, root = forest.links()
    assert list(zip(member.tolist(), root.tolist(), strict=True)) == [(3, 1), (6, 5), (7, 1)]


def test_scratch_gives_shuffles_back(spark):
    from tidemark.llm.scratch import CLEANUP

    with Scratch(spark) as stage:
        assert stage.put(spark.range(5).groupBy("id").count(), "x").count() == 5
    assert spark.conf.get(CLEANUP) == "false"
