"""Odd texts and columns of any name."""

import random

import pytest
from test_llm_tokens import BYTE

import corpus_pipeline
from tidemark.llm import langcrf, ledger
from tidemark.llm.encode import encoder
from tidemark.llm.queries import QUALITY_SQL


def test_ids_with_all_white_space():
    """Byte-level ids equal the library's, whatever white space meets whatever else."""
    from tokenizers import Tokenizer

    plain, mine = Tokenizer.from_file(BYTE), encoder(BYTE, "leading")
    assert mine.cached
    white = "\t\n\x0b\x0c\r \x1c\x1d\x1e\x1f\x85\xa0           　"
    rng = random.Random(7)
    alphabet = [*white, *" \n\n  ", *"xyZé日½.,'!-_0", "the", "don't", "​", "﻿"]
    texts = ["x\n  y", "x\n y", "　　x", "x\n\t\ty"]
    texts += ["".join(rng.choices(alphabet, k=rng.randint(1, 14))) for _ in range(20_000)]
    for text in texts:
        want = plain.encode(text, add_special_tokens=False).ids
        got = memoryview(mine(text)).cast("I").tolist()
        assert got == want, repr(text)


@pytest.mark.parametrize("word", ["½", "²", "①", "Ⅷ", "12", "--", "½²"])
def test_words_without_a_letter(word):
    assert langcrf.bare(word) == ""


def test_letterless_texts_have_no_language(spark):
    rows = [(i, "the and of to in is that", "en") for i in range(40)] + [(i, "der die und das ist von zu", "de") for i in range(40, 80)]
    odd = [(100, "½ ² Ⅷ 12", None), (101, None, None), (102, "", None), (103, "½ the", None)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in langcrf.label_documents(docs, langcrf.learn_from(docs)).collect()}
    assert [got[k] for k in (100, 101, 102)] == [langcrf.UNKNOWN] * 3 and got[103] == "en"


def test_rule_sql_and_code_agree_on_odd_texts(spark):
    import duckdb

    texts = ["中文 " * 40, "ab " * 40, "中 a " * 30, "日本 ab " * 30, "กข " * 40, "x" * 50 + " word" * 30, None, "", " \n\t ", "#$ " * 30,
             "a b c d e f g h " * 9, "line one here\n" * 30, "한국 어 " * 25, "é " * 30]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = ledger.apply_policy(ledger.ledger(docs), ledger.STANDARD)
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "failures", "kept"]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({QUALITY_SQL}) ORDER BY doc_id").fetchall()
    assert sorted(tuple(r) for r in rows.select(*columns).collect()) == want


NAMES = ("kept", "n_words", "_id", "_hash", "_n", "row", "failures", "fp", "h1", "carried", "copy", "marks", "component", "certainty", "n_lines")


def test_stages_leave_columns_of_any_name_alone(spark):
    text = " ".join(f"the{i} and{i * 7} of{i * 3}" for i in range(40))
    other = " ".join(f"word{i * 5} that{i} is{i * 11}" for i in range(40))
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in NAMES)
    rows = [(k, t, "en", "s", len(t), *[f"{c} of {k}" for c in NAMES]) for k, t in enumerate([text, text, other])]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString(), name
        for r in out.collect():
            assert all(r[c] == f"{c} of {r.doc_id}" for c in NAMES), name
            assert r.text or name == "repeats", name
        assert {r.doc_id for r in out.collect()} == ({0, 2} if name == "near_duplicates" else {0, 1, 2})
