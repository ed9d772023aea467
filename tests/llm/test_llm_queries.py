"""The queries that SQL cannot express, and the pipeline, against plain versions on whole tables."""

import os

import brute
import pytest
from test_llm_text import naive_posteriors
from test_llm_tokens import BYTE, PIECE, WORD, check_packing

import corpus_pipeline
from tidemark.llm import langcrf, ledger
from tidemark.llm.queries import QUERIES
from tidemark.llm.scratch import Scratch

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()]


def result(spark, name):
    return sorted((tuple(r) for r in QUERIES[name](spark, DIR).collect()), key=repr)


def test_vectors(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DIR}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got, want = result(spark, "op2_vectors"), sorted(brute.vectors(rows), key=repr)
    links = sum(r[1] for r in want)
    assert sum(r[1] for r in got) >= 0.99 * links and all(a[1] <= b[1] for a, b in zip(got, want, strict=True))
    assert sum(a[2:] == b[2:] for a, b in zip(got, want, strict=True)) >= 0.99 * len(want)


def test_tokens(spark, docs):
    at, want = 0, []
    for (key, _), ids in zip(sorted(docs), brute.tokens(WORD, [t for _, t in sorted(docs)]), strict=True):
        want.append((key, at, len(ids), brute.crc(ids)))
        at += len(ids)
    assert result(spark, "op3_token_files") == sorted(want, key=repr)


def test_passages(spark, docs):
    assert result(spark, "op4_substrings") == sorted(brute.passages(docs), key=repr)


def test_simhash(spark, docs):
    assert result(spark, "op5_simhash") == sorted(brute.simhash(docs), key=repr)


def test_pieces(spark, docs):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    want = []
    for key, text in docs:
        ids = model.encode(text or "")
        want.append((key, len(ids), brute.crc(ids), len(text or ""), brute.sha(text or "")))
    assert result(spark, "op6_pieces") == sorted(want, key=repr)


def test_packing(spark, docs):
    ids = brute.tokens(BYTE, [t for _, t in docs])
    check_packing(result(spark, "op7_packing"), [(k, i) for (k, _), i in zip(docs, ids, strict=True)])


def test_language_held_out(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}
    rows = QUERIES["op9_language"](spark, DIR).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and held
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_substrings(spark, docs):
    assert result(spark, "op10_suffix_dedup") == sorted(brute.substrings(docs), key=repr)


def test_main_texts(spark):
    import html
    import re

    for r in QUERIES["op1_html"](spark, DIR).join(
        spark.read.parquet(f"{DIR}/pages.parquet").select("page_id", "html"), "page_id"
    ).collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [html.unescape(re.sub("<[^>]+>", "", x)) for x in re.split("</?(?:p|h1)>", article)]
        want = [re.sub(r"\s+", " ", b).strip() for b in blocks]
        assert r.text == "\n".join(b for b in want if b) and r.n_chars == len(r.text)


def test_pipeline(spark):
    """Each stage by hand on what the stage before it left."""
    frame = spark.read.parquet(f"{DIR}/documents.parquet")
    rows = {r.doc_id: r.text for r in frame.collect()}
    model = langcrf.learn_from(frame)
    for key, text in list(rows.items()):
        words = [b for b in map(langcrf.bare, (text or "").split()) if b]
        mass = naive_posteriors(model.emissions(words), model).mean(axis=0) if words else [0]
        if max(mass) < corpus_pipeline.LEAST_SCORE:
            del rows[key]
    standard = len(ledger.STANDARD.rules)
    assert standard == 6
    for key, text in list(rows.items()):
        n, chars, symbols, lines, same, again = brute.quality(text)
        if (n < 20 or 100 * again > 30 * n or 5 * symbols > n or 2 * same > lines
                or 2 * chars < 5 * n or chars > 40 * n):
            del rows[key]
    near = brute.simhash(list(rows.items()))
    rows = {k: t for k, t in rows.items() if (k, k) in {(a, c) for a, _, c in near}}
    first, cut = {}, {}
    for key in sorted(rows):
        raw, gone, own = rows[key].encode(), set(), []
        for i in range(len(raw) - 49):
            if raw[i : i + 50] in first:
                gone.update(range(i, i + 50))
            own.append(raw[i : i + 50])
        first.update(dict.fromkeys(own, key))
        cut[key] = bytes(b for i, b in enumerate(raw) if i not in gone).decode("utf-8", "ignore")
    got = [tuple(r) for r in corpus_pipeline.run(spark, DIR).collect()]
    ids = brute.tokens(BYTE, list(cut.values()))
    assert {r[0] for r in got} == set(cut)
    check_packing(got, list(zip(cut, ids, strict=True)))


@pytest.mark.parametrize("place", range(len(corpus_pipeline.STAGES)))
def test_stages_on_odd_documents(spark, odd_documents, place):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = odd_documents.select(*columns)
    step = corpus_pipeline.STAGES[place][1]
    with Scratch(spark) as stage:
        kept = stage.put(step(spark, docs, DIR), "kept")
        if place < len(corpus_pipeline.STAGES) - 1:
            assert kept.columns == columns
            assert kept.schema.simpleString() == docs.schema.simpleString()
        assert kept.count() > 0
        assert stage.put(step(spark, docs.limit(0), DIR), "none").count() == 0


def test_one_row_of_each_group_stays(spark):
    from llm_helpers import sentence

    a, b, c, d = (sentence(k, 200) for k in (31, 32, 33, 34))
    near = a.upper()  # of the same fingerprint
    rows = [(3, a), (3, a), (3, near), (7, a), (None, a), (None, b), (None, b), (None, None), (4, ""),
            (3, c), (5, d), (5, d), (5, d), (None, near)]
    docs = spark.createDataFrame([(k, t, "xx", f"s{i % 2}", 1) for i, (k, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, DIR).collect()]
    rest = sorted(((k, t) for k, t in got if t not in (a, near)), key=repr)
    assert rest == sorted([(None, b), (4, ""), (3, c), (5, d)], key=repr)
    assert [k for k, t in got if t in (a, near)] == [3]
