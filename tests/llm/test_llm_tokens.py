import brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import elias_fano, encode, packing, pieces, token_files
from tidemark.llm.registry import folder, public_vocabulary

WORD, BYTE = public_vocabulary("word_bpe_49k.json"), public_vocabulary("byte_bpe_50k.json")
PIECE = public_vocabulary("piece_bpe_32k.model")


def strings(alphabet, most):
    return st.lists(st.sampled_from(alphabet), max_size=most).map("".join)


TEXT = strings([*"aAbeéÉßtT '.,\n\t12!-_日😀Σσİ", "<|endoftext|>", " ", "  "], 40)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=300))
def test_elias_fano(gaps):
    values = np.cumsum(np.array(gaps, np.int64))
    code = elias_fano.EliasFano(elias_fano.encode(values))
    assert len(code) == len(values)
    assert code.values().tolist() == values.tolist()
    assert [code.select(i) for i in range(len(values))] == values.tolist()
    with pytest.raises(IndexError):
        code.select(len(values))


def test_elias_fano_takes_little_space():
    values = np.cumsum(np.random.default_rng(0).integers(100, 900, 20_000))
    bits = 8 * len(elias_fano.encode(values)) / len(values)
    assert bits < 2.4 + np.log2(values[-1] / len(values))


@settings(max_examples=150, deadline=None)
@given(TEXT, st.sampled_from([(WORD, "dropped"), (BYTE, "leading")]))
def test_cached_encoding_is_the_library_s(text, kind):
    encoder = encode.encoder(*kind)
    assert encoder.cached
    assert encoder(text) == encoder.plain(text)


APOSTROPHES = strings([*"\"(o ", " '", "said", "some", "the", "l'", "'", "very", "\n", "re", "ll", ", ", "'d"], 20)


@settings(max_examples=150, deadline=None)
@given(APOSTROPHES, st.sampled_from([(WORD, "dropped"), (BYTE, "leading")]))
def test_cached_encoding_of_apostrophes(text, kind):
    encoder = encode.encoder(*kind)
    assert encoder.cached
    assert encoder(text) == encoder.plain(text)


@pytest.mark.parametrize("kind", [(WORD, "dropped"), (BYTE, "leading")])
@pytest.mark.parametrize("text", [
    "He said, 'some of the people told me' and 'the end' came.", "a 'twas b ('the c o'that d l'very e",
])
def test_words_split_before_the_merges(text, kind):
    encoder = encode.encoder(*kind)
    assert encoder(text) == encoder.plain(text)


BLANKS = strings([*"aé.'1\n\t \r\x0b\x0c\x1c\x1f", *map(chr, (0x85, 0xA0, 0x1680, 0x2003, 0x2028, 0x202F, 0x205F, 0x3000, 0x200B)), "à", "ÿ", "日"], 25)


@settings(max_examples=300, deadline=None)
@given(BLANKS, st.sampled_from([(WORD, "dropped"), (BYTE, "leading")]))
def test_cached_encoding_of_all_white_space(text, kind):
    encoder = encode.encoder(*kind)
    assert encoder.cached
    assert encoder(text) == encoder.plain(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT | BLANKS | st.none(), max_size=8), st.sampled_from([(WORD, "dropped"), (BYTE, "leading")]))
def test_texts_of_a_batch_stay_apart(texts, kind):
    encoder = encode.encoder(*kind)
    got = encoder.batch(pa.array(["left out", *texts], pa.string())[1:])
    assert [g.tobytes() for g in got] == [encoder.plain(t or "") for t in texts]


def test_memory_of_words_has_two_generations():
    asked = []

    def compute(words):
        asked.extend(words)
        return [w * 2 for w in words]

    words = encode.Remembered(compute, 4)
    for word in (b"a", b"b", b"c", b"a", b"d", b"a", b"x" * 70, b"x" * 70):
        assert words.get([word]) == [word * 2] and len(words) <= 4
    assert asked == [b"a", b"b", b"c", b"d", b"x" * 70, b"x" * 70]


def test_token_files(spark, odd_documents, odd_rows, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 50)
    path = folder(spark, "tokens")
    token_files.write_tokens(odd_documents, path, WORD, "dropped")
    got = sorted((tuple(r) for r in token_files.read_tokens(spark, path).collect()), key=lambda r: r[1])
    key = lambda k: (k is not None, k or 0)
    assert [r[0] for r in got] == sorted((k for k, _ in odd_rows), key=key)
    assert [r[1] for r in got] == np.cumsum([0, *(r[2] for r in got)])[:-1].tolist()
    ids = brute.tokens(WORD, [t for _, t in odd_rows])
    want = sorted(((k, len(i), brute.crc(i)) for (k, _), i in zip(odd_rows, ids, strict=True)), key=repr)
    assert sorted(((r[0], r[2], r[3]) for r in got), key=repr) == want
    segment = spark.read.parquet(path).where("size(doc_ids) > 1").first()
    own = dict(((k, t or ""), i) for (k, t), i in zip(odd_rows, ids, strict=True))
    found = token_files.document_ids(segment, 1).tolist()
    assert found in [i for (k, _), i in own.items() if k == segment.doc_ids[1]]


def test_no_token_files(spark, no_documents):
    path = folder(spark, "tokens")
    token_files.write_tokens(no_documents, path, WORD, "dropped")
    assert token_files.read_tokens(spark, path).collect() == []


def check_packing(rows, ids_by_row):
    """Every id once, sequences without gaps, no padding."""
    sequences = {}
    for r in rows:
        sequences.setdefault(r[5], []).append(r)
    for parts in sequences.values():
        parts.sort(key=lambda r: r[6])
        assert [p[6] for p in parts] == np.cumsum([0, *(p[2] for p in parts)])[:-1].tolist()
        total = sum(p[2] for p in parts)
        assert total <= packing.WINDOW and total & (total - 1) == 0
        assert {p[7] for p in parts} == {total}
    left = list(ids_by_row)
    by_doc = {}
    for r in rows:
        by_doc.setdefault((r[0], r[4]), []).append(r)
    for (doc, total), parts in by_doc.items():
        own = [i for k, i in left if k == doc and len(i) == total]
        assert sum(p[2] for p in parts) == total * len(own)
        for ids in own:
            for p in {p[1:4] for p in parts}:
                assert any(brute.crc(i[p[0] : p[0] + p[1]]) == p[2] for i in own)
            del ids


def test_packing(spark, odd_documents, odd_rows):
    rows = [tuple(r) for r in packing.pack_documents(odd_documents, BYTE).collect()]
    ids = brute.tokens(BYTE, [t for _, t in odd_rows])
    check_packing(rows, [(k, i) for (k, _), i in zip(odd_rows, ids, strict=True)])
    assert sum(r[2] for r in rows) == sum(map(len, ids))


def test_packing_of_nothing(no_documents):
    assert packing.pack_documents(no_documents, BYTE).collect() == []


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 9000), min_size=1, max_size=60))
def test_packer(lengths):
    packer = packing.Packer(3)
    docs = [(k, np.arange(n, dtype=np.uint32) + k) for k, n in enumerate(lengths)]
    for k, (key, ids) in enumerate(docs):
        packer.add(key, ids)
        if k % 9 == 8:
            packer.pack()
    packer.finish()
    assert packer.held == 0 and not packer.pool
    check_packing(packer.rows, docs)
    for key, ids in docs:
        parts = sorted(r[1:3] for r in packer.rows if r[0] == key)
        assert [p[0] for p in parts] == np.cumsum([0, *(p[1] for p in parts)])[:-1].tolist()
        assert sum(p[1] for p in parts) == len(ids)


def test_step_groups_cost_the_same():
    packer = packing.Packer(0, step=8 * packing.WINDOW)
    rng = np.random.default_rng(4)
    for key in range(2000):
        packer.add(key, np.zeros(int(rng.integers(1, 1500)), np.uint32))
    packer.finish()
    groups = {}
    for r in packer.rows:
        groups.setdefault(r[8], []).append(r)
    full = [sum(r[2] for r in g) for g in groups.values()]
    assert max(full) <= 8 * packing.WINDOW
    assert sum(f == 8 * packing.WINDOW for f in full) >= len(full) - 12
    assert all(len({r[7] for r in g}) == 1 for g in groups.values())


@pytest.fixture(scope="module")
def machine():
    import sentencepiece

    return pieces.transducer(PIECE), sentencepiece.SentencePieceProcessor(model_file=PIECE)


@settings(max_examples=200, deadline=None)
@given(text=strings([*" \nabcdehinorstT.,1…éü▁日😀\x00", "the", "tion", "ing "], 30))
def test_pieces_are_the_library_s(machine, text):
    ours, theirs = machine
    ids = np.frombuffer(ours.encode(text), "<u4")
    assert ids.tolist() == theirs.encode(text)
    assert ours.decode(ids) == theirs.decode(ids.tolist())


def test_neighbours_are_what_merges_give(machine):
    ours, _ = machine
    rng = np.random.default_rng(0)
    all_pieces = [p for p in ours.ids if ours.merged(p) == [p]]
    for _ in range(3000):
        a, b = (all_pieces[i] for i in rng.integers(0, len(all_pieces), 2))
        assert ours.neighbours(a, b) == (ours.merged(a + b) == [a, b])


def test_unigram_path_is_the_lightest(machine):
    import copy

    ours = copy.copy(machine[0])
    ours.merges = False
    ours.ids = {"a": 0, "b": 1, "ab": 2, "ba": 3}
    ours.weight = {"a": 1.0, "b": 1.0, "ab": 1.5, "ba": 0.2}
    ours.prefixes = {"a", "b", "ab", "ba"}
    assert ours.shortest_path("abab") == ["a", "ba", "b"]


def test_piece_encoding(spark, odd_documents, odd_rows, machine):
    rows = pieces.encode_texts(odd_documents, PIECE)
    got = sorted(((r.doc_id, list(r.ids), r.ids_crc32, r.decoded) for r in rows.collect()), key=repr)
    want = [(k, machine[1].encode(t or "")) for k, t in odd_rows]
    assert got == sorted(((k, i, brute.crc(i), machine[1].decode(i)) for k, i in want), key=repr)
    texts = {(r.doc_id, r.text) for r in pieces.decode_ids(rows, PIECE).collect()}
    assert texts == {(k, t or "") for k, t in odd_rows}


def test_no_pieces(no_documents):
    assert pieces.encode_texts(no_documents, PIECE).collect() == []
