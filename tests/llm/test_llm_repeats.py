import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import repeats, rolling, substrings, suffixes
from tidemark.llm.scratch import Scratch


def ordered(rows):
    return sorted(rows, key=repr)


def bytes_result(df):
    return ordered(
        (r.doc_id, r.n_bytes, r.n_removed, len(r.removed), brute.sha(bytes(r.kept))) for r in df.collect()
    )


def words_result(df):
    return ordered((r.doc_id, r.n_words, r.n_removed, brute.sha(r.kept)) for r in df.collect())


def test_bytes_on_odd_documents(odd_documents, odd_rows, scratch):
    got = suffixes.dedup_substrings(odd_documents, scratch, carry=("lang", "copy", "carried"))
    assert bytes_result(got) == ordered(brute.substrings(odd_rows))
    assert {(r.carried.lang, r.carried.copy, r.carried.carried) for r in got.collect()} == {("xx", 1, 2)}


def test_words_on_odd_documents(odd_documents, odd_rows, scratch):
    got = substrings.dedup_passages(odd_documents, scratch)
    assert words_result(got) == ordered(brute.passages(odd_rows))


def test_empty_tables(no_documents, scratch):
    assert suffixes.dedup_substrings(no_documents, scratch).collect() == []


def test_empty_tables_of_words(no_documents, scratch):
    assert substrings.dedup_passages(no_documents, scratch).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_random_texts(spark, seed):
    """Few letters and many cut-and-paste stretches: repeats of all lengths around the threshold."""
    rng = np.random.default_rng(seed)
    pool = ["".join(rng.choice(list("abc d"), 300)) for _ in range(4)]
    rows = []
    for key in rng.permutation(40).tolist():
        parts = []
        for _ in range(rng.integers(1, 5)):
            text, at = pool[rng.integers(4)], rng.integers(0, 240)
            parts.append(text[at : at + rng.integers(20, 120)])
        rows.append((key // 2, "".join(parts)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    with Scratch(spark) as stage:
        assert bytes_result(suffixes.dedup_substrings(df, stage)) == ordered(brute.substrings(rows))
    with Scratch(spark) as stage:
        assert words_result(substrings.dedup_passages(df, stage)) == ordered(brute.passages(rows))


def test_spans_and_kept_text(spark, scratch):
    text = "the quick brown fox jumps over the lazy dog and runs far away"
    df = spark.createDataFrame([(1, text), (2, f"A {text} B")], "doc_id long, text string")
    row = {r.doc_id: r for r in suffixes.dedup_substrings(df, scratch).collect()}[2]
    assert bytes(row.kept) == b"A  B" and [tuple(s) for s in row.removed] == [(2, len(text))]


def test_cut_characters_leave_text():
    assert suffixes.whole_characters("aé".encode()[:-1] + b"b") == "ab"


def test_many_blobs_of_one_bucket(spark, odd_rows, scratch, monkeypatch):
    """Blocks shorter than a text, and several batches of few bytes each."""
    monkeypatch.setattr(repeats, "BLOCK", 64)
    column = __import__("pyarrow").array([t or "" for _, t in odd_rows])
    flat = suffixes.flatten(column)
    found = {
        (int(repeats.row_of(flat[1], np.array([low + f]))[0]), int(m))
        for low, _, first, _, least in repeats.minima(flat, suffixes.PLAN)
        for f, m in zip(first, least, strict=True)
    }
    monkeypatch.undo()
    whole = {
        (int(repeats.row_of(flat[1], np.array([low + f]))[0]), int(m))
        for low, _, first, _, least in repeats.minima(flat, suffixes.PLAN)
        for f, m in zip(first, least, strict=True)
    }
    assert found == whole


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=80), st.integers(1, 9), st.integers(1, 9))
def test_rolling(items, k, w):
    a = np.array(items, np.uint64)
    h = rolling.gram_hashes(a, k)
    assert len(h) == max(0, len(a) - k + 1)
    names = {}
    for i, x in enumerate(h):
        names.setdefault(tuple(items[i : i + k]), set()).add(int(x))
    assert all(len(v) == 1 for v in names.values())
    assert len(set().union(*names.values())) == len(names) if names else True
    assert rolling.window_min(h, w).tolist() == [min(h[i : i + w].tolist()) for i in range(len(h) - w + 1)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=20, max_size=20).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=40))
def test_multikey_order(rows):
    matrix = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), 20)
    order = suffixes.multikey_order(suffixes.big_endian(matrix))
    assert [rows[i] for i in order] == sorted(rows)


def test_hot_passage_leaves_a_task_once(spark):
    """An anchor in all texts of a task is sent as one seed, the others as known."""
    text = "a passage that stands in every single document of this table, again and again"
    rows = [(i, f"{i} {text} {i}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    with Scratch(spark) as stage:
        got = bytes_result(suffixes.dedup_substrings(df, stage))
    assert got == ordered(brute.substrings(rows))


def test_anchors_leave_by_stretches_of_text(monkeypatch):
    """What a task holds depends on the stretch it is at, not on the size of its batch, and the
    buckets get like shares."""
    import pyarrow as pa

    steps = {}
    monkeypatch.setattr(repeats, "shuffled", lambda rows, buckets, *fs: steps.update(make=fs[0]))

    class Rows:
        def select(self, *_):
            return self

    repeats.repeated_anchors(Rows(), suffixes.PLAN, 8)
    draw = np.random.default_rng(1)
    texts = ["".join(map(chr, draw.integers(97, 123, 1 << 20))) for _ in range(12)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(12), pa.int64()), pa.array(texts)], names=["h1", "text"])
    left = [[(b, k, len(d)) for b, k, d in zip(*out.to_pydict().values())] for out in steps["make"](iter([batch]))]
    assert len(left) >= 3
    for out in left:
        sizes = [size for _, kind, size in out if kind == 0]
        assert len(sizes) == 8 and max(sizes) < 1.2 * min(sizes)
