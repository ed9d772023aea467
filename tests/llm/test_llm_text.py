import brute
import numpy as np
import pytest

from tidemark.llm import html_paths, langcrf, ledger

LEDGER = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def measured(rows):
    return sorted((tuple(r) for r in rows.select("doc_id", *LEDGER).collect()), key=repr)


def test_measurements(odd_documents, odd_rows):
    got = measured(ledger.ledger(odd_documents))
    assert got == sorted(((k, *brute.quality(t)) for k, t in odd_rows), key=repr)


def test_repeated_windows_and_lines(spark):
    eight = "a b c d e f g h"
    texts = [eight, f"{eight} {eight}", f"{eight} i {eight}", "x " * 30, "x\nx\n \n\nx\ny", "#*$%&|<> a#",
             f"{eight} a b c d e f g", "\x0b\x0c\r a\xa0b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert measured(ledger.measure(df)) == sorted(((k, *brute.quality(t)) for k, t in enumerate(texts)), key=repr)


def test_policies_and_ablation(spark):
    masks = [0, 1, 1, 3, 4, 32, 33]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(masks)], "doc_id long, failures long")
    kept = {r.doc_id for r in ledger.apply_policy(df, ledger.BASE).where("kept").collect()}
    assert kept == {0, 4, 5}
    got = {r.rule: (r.n_failed, r.n_only, r.n_rejected) for r in ledger.ablation(df, ledger.BASE).collect()}
    assert got == {"few_words": (4, 3, 4), "repeated_windows": (1, 0, 4)}
    assert len({r.bit for r in ledger.RULES}) == len(ledger.RULES)


def test_short_words_of_other_scripts(spark):
    han = " ".join("我 今天 去 了 北京 的 大 学 和 朋友 们 一起 学习 中文 很 有 意思 老师 也 非常 好".split())
    kana = "私 は 昨日 東京 に 行き まし た そして 友人 と 会い 美味しい 寿司 を 食べ て から 家 に 帰り まし た"
    rows = [(1, han), (2, kana), (3, " ".join("abcdefghijklmnopqrstuvwxyz")), (4, "a b c 我 " + " ".join("defghijklmnopqrstuv"))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id: r.kept for r in ledger.apply_policy(ledger.ledger(df), ledger.STANDARD).collect()}
    assert kept == {1: True, 2: True, 3: False, 4: False}


def test_texts_of_several_languages_stay(spark):
    import corpus_pipeline

    rows = language_rows()
    mixed = " ".join(rows[k][1] for k in range(3))
    odd = [(900, mixed, None, "s", 1), (901, "12 34 --", None, "s", 1), (902, None, None, "s", 1)]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, source string, n_chars long")
    score = {r.doc_id: r.score for r in langcrf.label_documents(df, langcrf.learn_from(df)).collect()}
    assert score[900] < corpus_pipeline.LEAST_SCORE
    kept = {r.doc_id for r in corpus_pipeline.language(spark, df, "").collect()}
    assert kept == {k for k, *_ in rows} | {900}


def test_empty_ledger(no_documents):
    assert ledger.ledger(no_documents).collect() == []
    assert ledger.ablation(ledger.ledger(no_documents), ledger.STANDARD).collect() == []


def test_native(odd_documents):
    plan = ledger.ledger(odd_documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def naive_posteriors(log_e, model):
    e = np.exp(log_e - log_e.max(axis=1, keepdims=True))
    n, k = e.shape
    f, b = np.zeros((n, k)), np.ones((n, k))
    f[0] = model.start * e[0]
    f[0] /= f[0].sum()
    for t in range(1, n):
        f[t] = f[t - 1] @ model.transitions * e[t]
        f[t] /= f[t].sum()
    for t in range(n - 2, -1, -1):
        b[t] = model.transitions @ (e[t + 1] * b[t + 1])
        b[t] /= b[t].sum()
    p = f * b
    return p / p.sum(axis=1, keepdims=True)


def test_forward_backward_in_blocks():
    rng = np.random.default_rng(0)
    model = langcrf.Model(list("abc"), {}, np.zeros((0, 3)), rng.random((3, 3)) + 0.05, rng.random(3) + 0.1)
    sizes = [1, 2, 700, 1, 255, 256, 257, 40]
    log_e = 3 * rng.standard_normal((sum(sizes), 3))
    first = np.zeros(sum(sizes), bool)
    starts = np.cumsum([0, *sizes[:-1]])
    first[starts] = True
    got = langcrf.forward_backward(log_e, first, model)
    for a, n in zip(starts, sizes, strict=True):
        assert np.allclose(got[a : a + n], naive_posteriors(log_e[a : a + n], model))


def test_forward_backward_side_by_side():
    """More languages than blocks take as matrices."""
    rng = np.random.default_rng(0)
    k = langcrf.FEW + 3
    model = langcrf.Model([str(i) for i in range(k)], {}, np.zeros((0, k)), rng.random((k, k)) + 0.05, rng.random(k) + 0.1)
    sizes = [1, 2, 300, 1, 40, 300]
    log_e = 3 * rng.standard_normal((sum(sizes), k))
    first = np.zeros(sum(sizes), bool)
    starts = np.cumsum([0, *sizes[:-1]])
    first[starts] = True
    got = langcrf.forward_backward(log_e, first, model)
    for a, n in zip(starts, sizes, strict=True):
        assert np.allclose(got[a : a + n], naive_posteriors(log_e[a : a + n], model))


def test_sums_and_transitions_in_parts(monkeypatch):
    rng = np.random.default_rng(2)
    weights, sizes = rng.random((50, 3)), rng.integers(0, 9, 40)
    flat, ends = rng.integers(0, 50, sizes.sum()), np.cumsum(sizes)
    monkeypatch.setattr(langcrf, "CELLS", 30)
    got = langcrf._sum_rows(weights, flat, ends)
    assert np.allclose(got, [weights[flat[b - n : b]].sum(axis=0) for b, n in zip(ends, sizes, strict=True)])
    log_e, move, begin = rng.standard_normal((2, 4, 3)), rng.standard_normal((3, 3)), rng.standard_normal(3)
    p, pair, _ = langcrf._chain_posteriors(log_e, move, begin)
    # What goes from a label and into one is the posterior of that label before and after.
    assert np.allclose(pair.sum(axis=1), p[:, :-1].sum(axis=(0, 1))) and np.allclose(pair.sum(axis=0), p[:, 1:].sum(axis=(0, 1)))


def test_every_label_is_learned(spark):
    """Also of more languages than a cap would let in."""
    rng = np.random.default_rng(3)
    stems = ["".join(rng.choice(list("bcdfghklmnprstvz"), 3)) + str(chr(0x430 + i % 32)) + chr(0x561 + i // 32) for i in range(230)]
    rows = [(i * 8 + j, " ".join(stems[i] + x for x in "aeioua"), f"l{i:03}") for i in range(230) for j in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langcrf.learn_from(df)
    assert len(model.labels) == 230
    got = [r for r in langcrf.label_documents(df.where(langcrf.held_out()), model).collect()]
    assert np.mean([r.lang_pred == f"l{r.doc_id // 8:03}" for r in got]) > 0.95


WORDS = {"xx": "alda balda caldo daldi eldam faldi", "yy": "orniq porniq quorne sorneq tornaq", "zz": "µßim ümißu îmîmi"}


def language_rows(n=240):
    rng = np.random.default_rng(1)
    rows = []
    for key in range(n):
        lang = list(WORDS)[key % 3]
        rows.append((key, " ".join(rng.choice(WORDS[lang].split(), 30)), lang, "s", 1))
    return rows


def test_languages(spark):
    rows = language_rows()
    text = f"{rows[0][1]} {rows[1][1]} {rows[0][1]}"
    odd = [(900, None, "xx"), (901, "", None), (902, "12 34 --", "yy"), (None, "alda balda", "xx"), (903, text, None),
           (903, text, None), (904, "unheard", None)]
    df = spark.createDataFrame(rows + [(*o, None, None) for o in odd], "doc_id long, text string, lang string, score string, spans int")
    model = langcrf.learn_from(df)
    assert model.labels == ["xx", "yy", "zz"]
    got = {}
    for r in langcrf.label_documents(df, model).collect():
        got.setdefault(r.doc_id, r)
    assert all(got[k].lang_pred == lang and 0.9 < got[k].score <= 1 for k, _, lang, *_ in rows)
    for key in (900, 901, 902):
        assert (got[key].lang_pred, got[key].score, got[key].spans) == ("und", 0.0, [])
    assert got[None].lang_pred == "xx"
    assert [tuple(s) for s in got[903].spans] == [("xx", 0, 30), ("yy", 30, 30), ("xx", 60, 30)]
    assert got[904].lang_pred in model.labels


def test_held_out_labels_are_not_learned_from(spark):
    import zlib

    rows = language_rows()
    out = lambda k: zlib.crc32(str(k).encode()) % 4 == 2
    wrong = [(k, t, "qq" if out(k) else lang, s, n) for k, t, lang, s, n in rows]
    df = spark.createDataFrame(wrong, "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id for r in df.where(langcrf.held_out()).collect()} == {k for k, *_ in rows if out(k)}
    assert langcrf.learn_from(df).labels == ["xx", "yy", "zz"]


def test_no_languages(spark, no_documents, odd_documents):
    assert langcrf.learn_from(no_documents) is None
    assert langcrf.label_documents(no_documents, None).collect() == []
    rows = langcrf.label_documents(odd_documents, None).collect()
    assert {(r.lang_pred, r.score) for r in rows} == {("und", 0.0)}
    model = langcrf.learn([("a", ["one", "two"]), ("b", ["uno", "dos"])])
    assert langcrf.label_documents(no_documents, model).collect() == []


PARAGRAPHS = [
    "First paragraph, with text & more — and punctuation. It goes on for a while, as articles do.",
    "Second paragraph, long enough; it has a link and several words, too. That, surely, is enough.",
    "Short.", "A third one, he said, which ends the piece. It says little, but at some length.",
]
BODY = (
    f"<p>{PARAGRAPHS[0].replace('&', '&amp;').replace('—', '&#8212;')}</p>"
    f"<p>{PARAGRAPHS[1].replace('a link', '<a href=x>a link</a>')}<p>{PARAGRAPHS[2]}"
    f"<p><b>{PARAGRAPHS[3].replace('he said', 'he<br>said')}<!-- not this --><script>var x='<p>no</p>';</script></p>"
)
AROUND = {
    "article": f"<nav><a href=1>Home</a><p>Menu, text.</p></nav><article><h1>Title</h1>{BODY}</article><footer><p>(c) All, rights, reserved.</footer>",
    "classes": "<div class=header><p>Best site, ever, for all of your many needs.</p></div>"
    "<div id=cookie-notice><p>We use cookies, to improve, things. OK?</p></div><div class='sidebar left'><p>Popular, posts, here.</div>"
    f"<div class=post><h1>Title</h1>{BODY}</div><div class=comments><p>Great post, I really liked it. Thanks, author, for this.</p></div>"
    "<div class=ad>Buy now, buy here, buy, buy.</div><form><p>Enter your name, please, sir.</form>",
    "main": f"<header><h2>Site</h2><p>Slogan, slogan.</p></header><main><div><h1>Title</h1><div>{BODY}</div></div></main><aside><p>See also, and so on.</aside>",
    "plain": f"<ul><li><a href=1>One</a><li><a href=2>Two</a></ul><div><h1>Title</h1>{BODY}</div><div><a href=3>More</a> <a href=4>and more</a></div>",
}


@pytest.mark.parametrize("kind", sorted(AROUND))
def test_main_text(kind):
    page = f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{AROUND[kind]}</body></html>"
    assert html_paths.main_text(page) == "\n".join(["Title", *PARAGRAPHS])


WRAPPERS = [
    "<div class='content has-sidebar'>{}</div>", "<div class='layout no-sidebar'>{}</div>",
    "<div class='post comments-open'>{}</div>", "<form action=x><div>{}</div></form>",
    "<div class='elementor-widget-container elementor-widget'>{}</div>", "<div class='widget'><div>{}</div></div>",
    "<div class='post tag-legal category-search'>{}</div>", "<div id=page-overlay><article>{}</article></div>",
]


@pytest.mark.parametrize("wrapper", WRAPPERS)
def test_names_of_wrappers(wrapper):
    page = f"<body><nav><a href=1>Home</a></nav>{wrapper.format('<h1>Title</h1>' + BODY)}<div class=left-sidebar><p>Popular, posts.</p></div></body>"
    assert html_paths.main_text(page) == "\n".join(["Title", *PARAGRAPHS])


def test_surroundings_stay_out():
    comments = "<div id=comments>" + "<article class=comment><p>Great, great post, thanks. Thanks, author!</p></article>" * 30 + "</div>"
    page = f"<article><h1>Title</h1>{BODY}</article>{comments}<div class='cookie-notice'>We, use, cookies.</div>"
    assert html_paths.main_text(page) == "\n".join(["Title", *PARAGRAPHS])
    assert html_paths.main_text("<nav><a href=1>One</a></nav><footer>All, rights.</footer>") == ""


LONG, LESS = "Some words, of text; and more. " * 130, "Another part, of text; and more. " * 9


@pytest.mark.parametrize("page", [
    "<div><h1>T</h1><p>{}</p><p>{}</p></div>", "<body><h1>T</h1><p>{}</p><p>{}</p></body>",
    "<div><h1>T</h1><div class=sec>{}</div><div class=sec>{}</div></div>",
    "<section><h1>T</h1><section><p>{}</p></section><section><p>{}</p></section></section>",
])
def test_short_parts_stay(page):
    assert html_paths.main_text(page.format(LONG, LESS)) == "\n".join(["T", LONG.strip(), LESS.strip()])


def test_quotes_in_tags():
    page = """<p class="a" ">One, two.</p><p title="x > y" data='">'>Three, four.</p><p it's>Five, six.</p>"""
    assert html_paths.main_text(page) == "One, two.\nThree, four.\nFive, six."


def test_extraction_of_odd_pages(spark):
    odd = [(1, "u", None), (2, None, ""), (3, "u", "just text, no tags"), (None, "u", "<p>One.<p>Two."), (4, "u", "<<<>"),
           (4, "u", "<div"), (5, "u", "<p>" * 3000 + "deep"), (6, "u", "<script>x"), (7, "u", "a" * 200_000)]
    df = spark.createDataFrame([(*o, "t", 9) for o in odd], "page_id long, url string, html string, text string, n_chars int")
    rows = html_paths.extract(df).collect()
    assert len(rows) == len(odd)
    got = [(r.page_id, r.text) for r in rows]
    for want in [(1, ""), (2, ""), (3, "just text, no tags"), (None, "One.\nTwo."), (5, "deep"), (6, ""), (7, "a" * 200_000)]:
        assert want in got
    assert all(r.n_chars == len(r.text) for r in rows)
    assert html_paths.extract(df.limit(0)).collect() == []


PROSE = "This is a plain sentence, with some words in it. " * 24


def test_sections_beside_each_other_stay():
    menu = "<div class=m><h2>Topics</h2><a href=1>One thing</a> <a href=2>Another thing</a></div>"
    for tag in ("div", "section"):
        page = (f"{menu}<{tag} class=a><h2>Intro</h2><p>{PROSE}</p></{tag}>"
                f"<{tag} class=b><h2>End</h2><p>Short closing words.</p></{tag}><div class=c><p>All, rights.</p></div>")
        assert html_paths.main_text(page) == "\n".join(["Intro", PROSE.strip(), "End", "Short closing words."])


def test_unequal_sections_without_article():
    parts = [(f"Part {i}", "A sentence, of few words. " * n) for i, n in enumerate((1, 40, 3, 12))]
    page = "<body><ul><li><a href=1>Home</a></ul><div id=x>" + "".join(f"<div><h2>{h}</h2><p>{p}</p></div>" for h, p in parts) + "</div>"
    assert html_paths.main_text(page) == "\n".join(x.strip() for part in parts for x in part)


@pytest.mark.parametrize("name", ["legal", "search", "related", "alert", "discussion"])
def test_names_do_not_outrank_the_content(name):
    said = "One sentence, here. Two sentences, there. Three of them, in all, by now. Four sentences, done."
    page = f"<main><p>{PROSE}</p><div class={name}><p>{said}</p></div>{{}}</main>"
    assert html_paths.main_text(page.format("")) == f"{PROSE.strip()}\n{said}"
    links = f"<div class={name}><a href=1>One of them, that.</a> <a href=2>Another. And more. Yes.</a></div>"
    comments = f"<div class=comments><p>{said}</p></div>"
    assert html_paths.main_text(page.format(links + comments)) == f"{PROSE.strip()}\n{said}"
    # Outside of it a name counts.
    assert html_paths.main_text(f"<main><p>{PROSE}</p></main><div class={name}><p>{said}</p></div>") == PROSE.strip()
