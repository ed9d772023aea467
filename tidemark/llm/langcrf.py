"""Language of words and documents by a linear-chain conditional random field.

A word's features are its affixes, its letter n-grams and, for words of the learned lexicon, the
word; the chain has learned transitions, so a switch of language inside a text is found where the
words ask for it. Forward-backward gives every word its posterior; a document's language has the
largest part of the mass, and that part is its score.

Every label is learned. Learning takes a bounded sample: about ``SAMPLE_DOCS`` documents of each
language (of more than 40 languages fewer, see :func:`sample_of`), chosen by a hash of the id, and
``SAMPLE_WORDS`` words of each, from a random place; the features are those of the sample. Their stretches are strung
together at random, so that the transitions have switches to learn from. Prediction covers every
word of every text, in blocks; a text's length does not matter.

Defined cases: a null text or one without a letter is ``und`` with score 0, and so is every text
when nothing is labelled; a tie goes to the language that sorts first; null ids and repeated rows
are predicted row by row (a null id is never learned from, nor held out); an empty table gives no
rows; other columns are not read for a prediction.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.repeats import sub_batches

SAMPLE_DOCS, SAMPLE_TOTAL, SAMPLE_LEAST = 600, 24_000, 60
SAMPLE_WORDS = 60
#: Words of a stretch of one document in a learning chain, at most, and words of a chain.
STRETCH, CHAIN = 20, 60
LEXICON_LEAST = 3
#: Numbers that are held at once while learning and predicting: rows times languages.
CELLS = 4 << 20
#: Languages up to which the blocks of a chain advance as matrices.
FEW = 32
ROUNDS, RATE, DECAY = 50, 0.15, 1e-3
UNKNOWN = "und"
#: Weights of words that a worker keeps, at most.
CACHED_CELLS = 150_000 * FEW
BLOCK = 256
_EDGE = re.compile(r"^[\W\d_]+|[\W\d_]+$")


def features(word: str) -> list[str]:
    """Of a bare lower-case word: prefixes, suffixes, n-grams and the word."""
    framed = f"^{word}$"
    out = [f"w{word}", f"p{word[:2]}", f"p{word[:3]}", f"s{word[-2:]}", f"s{word[-3:]}"]
    out += [framed[i : i + 2] for i in range(len(framed) - 1)]
    return out + [framed[i : i + 3] for i in range(len(framed) - 2)]


def bare(word: str) -> str:
    """The word in lower case without marks and digits at its ends; empty without a letter (fractions,
    powers and Roman numerals of one character are none)."""
    word = _EDGE.sub("", word).lower()
    return word if any(map(str.isalpha, word)) else ""


@dataclass
class Model:
    labels: list[str]
    index: dict[str, int]
    weights: np.ndarray  # features x labels
    transitions: np.ndarray  # from x to, probabilities-like
    start: np.ndarray

    def emissions(self, words: list[str]) -> np.ndarray:
        """Log potentials of bare words."""
        return _sum_rows(self.weights, *_indices(self.index, words))


def _indices(index: dict[str, int], words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    flat, ends, get = [], [], index.get
    for word in words:
        flat += [i for i in map(get, features(word)) if i is not None]
        ends.append(len(flat))
    return np.array(flat, np.int64), np.array(ends, np.int64)


def _sum_rows(weights: np.ndarray, flat: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the rows ``flat`` of ``weights`` up to each of the ends, some words at a time."""
    out = np.empty((len(ends), weights.shape[1]))
    begins = np.concatenate([[0], ends[:-1]])
    step, at = max(1, CELLS // max(1, weights.shape[1])), 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, begins[at] + step, "right")))
        low, high = begins[at], ends[to - 1]
        total = np.zeros((high - low + 1, weights.shape[1]))
        np.cumsum(weights[flat[low:high]], axis=0, out=total[1:])
        out[at:to] = total[ends[at:to] - low] - total[begins[at:to] - low]
        at = to
    return out


def _filter_side_by_side(e: np.ndarray, reset: np.ndarray, a: np.ndarray, init: np.ndarray) -> np.ndarray:
    """As :func:`_filter`, chains next to each other, for many languages: no block needs a matrix."""
    starts = np.flatnonzero(reset)
    sizes = np.diff(np.append(starts, len(e)))
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    out = np.empty_like(e)
    x = np.empty((0, e.shape[1]))
    for s in range(int(sizes[0]) if len(sizes) else 0):
        at = starts[: np.searchsorted(-sizes, -s, "left")] + s
        x = (x[: len(at)] @ a if s else init) * e[at]
        x /= x.sum(axis=1, keepdims=True)
        out[at] = x
    return out


def _filter(e: np.ndarray, reset: np.ndarray, a: np.ndarray, init: np.ndarray) -> np.ndarray:
    """``x[t] = (x[t-1] @ a, or init where reset) * e[t]``, each scaled to a sum of one.

    Blocks of the chain advance side by side: first as matrices, to learn what each block does to
    its input, then one after the other, then as vectors from their true inputs."""
    t, k = e.shape
    if k > FEW:
        return _filter_side_by_side(e, reset, a, init)
    blocks = -(-t // BLOCK)
    e = np.concatenate([e, np.ones((blocks * BLOCK - t, k))]).reshape(blocks, BLOCK, k)
    reset = np.concatenate([reset, np.zeros(blocks * BLOCK - t, bool)]).reshape(blocks, BLOCK)
    effect = np.repeat(np.eye(k)[None], blocks, axis=0)
    for s in range(BLOCK):
        moved = (effect.reshape(-1, k) @ a).reshape(blocks, k, k)
        at = np.flatnonzero(reset[:, s])
        moved[at] = effect[at].sum(axis=2, keepdims=True) * init
        effect = moved * e[:, s, None, :]
        effect /= effect.max(axis=(1, 2), keepdims=True)
    inputs = np.empty((blocks, k))
    x = init
    for b in range(blocks):
        inputs[b] = x
        x = x @ effect[b]
        x = x / x.sum()
    out = np.empty((blocks, BLOCK, k))
    x = inputs
    for s in range(BLOCK):
        x = np.where(reset[:, s, None], init, x @ a) * e[:, s]
        x /= x.sum(axis=1, keepdims=True)
        out[:, s] = x
    return out.reshape(-1, k)[:t]


def forward_backward(log_e: np.ndarray, first: np.ndarray, model: Model) -> np.ndarray:
    """Posteriors of all words of chains set end to end; ``first`` marks the chains' first words."""
    e = np.exp(np.maximum(log_e - log_e.max(axis=1, keepdims=True), -60.0))
    ahead = _filter(e, first, model.transitions, model.start)
    last = np.append(first[1:], True)
    k = e.shape[1]
    back = _filter(e[::-1], last[::-1], model.transitions.T, np.ones(k))[::-1]
    p = ahead * back / e
    return p / p.sum(axis=1, keepdims=True)


def learn(samples: list[tuple[str, list[str]]], seed: int = 0) -> Model:
    """Fit to (language, bare words in order) samples by gradient steps on the chains' likelihood."""
    labels = sorted({lang for lang, _ in samples})
    code = {lang: i for i, lang in enumerate(labels)}
    k = len(labels)
    rng = np.random.default_rng(seed)
    words, ys = _chains(samples, code, rng)
    vocabulary, ids = np.unique(np.array([w for c in words for w in c], dtype=object), return_inverse=True)
    ids = ids.reshape(len(words), -1) if len(words) else np.empty((0, CHAIN), np.int64)
    seen: dict[str, int] = {}
    for word, n in zip(vocabulary, np.bincount(ids.reshape(-1)), strict=True):
        for f in features(word):
            seen[f] = seen.get(f, 0) + int(n)
    often = sorted((f for f, n in seen.items() if n >= LEXICON_LEAST), key=lambda f: (-seen[f], f))
    index = {f: i for i, f in enumerate(often)}
    flat, ends = _indices(index, list(vocabulary))
    owner = np.repeat(np.arange(len(vocabulary)), np.diff(ends, prepend=0))
    y = np.array(ys)
    w = np.zeros((len(index), k))
    move, begin = np.zeros((k, k)), np.zeros(k)
    momentum = [[np.zeros_like(x), np.zeros_like(x)] for x in (w, move, begin)]
    n = max(1, y.size)
    some = max(1, CELLS // (CHAIN * k))  # chains at a time
    for step in range(1, ROUNDS + 1):
        of_word = _sum_rows(w, flat, ends)
        by_word = np.zeros_like(of_word)
        grad_move, grad_begin = np.zeros((k, k)), np.zeros(k)
        for at in range(0, len(y), some):
            part, gold = ids[at : at + some], np.eye(k)[y[at : at + some]]
            p, pair, p0 = _chain_posteriors(of_word[part], move, begin)
            off = (gold - p).reshape(-1, k)
            for j in range(k):
                by_word[:, j] += np.bincount(part.reshape(-1), off[:, j], len(vocabulary))
            grad_move += np.einsum("nta,ntb->ab", gold[:, :-1], gold[:, 1:], optimize=True) - pair
            grad_begin += (gold[:, 0] - p0).sum(axis=0)
        grad_w = np.stack([np.bincount(flat, by_word[owner, j], len(index)) for j in range(k)], axis=1)
        for value, grad, (m, v) in zip((w, move, begin), (grad_w, grad_move, grad_begin), momentum, strict=True):
            grad = grad / n * 100 - DECAY * value
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            value += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Model(labels, index, w, np.exp(move - move.max()), np.exp(begin - begin.max()))


def _chains(samples, code, rng):
    """Stretches of random documents, strung together to chains of ``CHAIN`` words."""
    stretches = []
    for lang, words in samples:
        at = 0
        while at < len(words):
            size = int(rng.integers(3, STRETCH + 1))
            stretches.append((code[lang], words[at : at + size]))
            at += size
    order = rng.permutation(len(stretches))
    flat = [(w, stretches[i][0]) for i in order for w in stretches[i][1]]
    flat = flat[: len(flat) - len(flat) % CHAIN] or (flat * CHAIN)[:CHAIN]
    chains = [flat[i : i + CHAIN] for i in range(0, len(flat), CHAIN)]
    return [[w for w, _ in c] for c in chains], [[y for _, y in c] for c in chains]


def _chain_posteriors(log_e, move, begin):
    """Posteriors of equally long chains, the expected transitions, and the first posteriors."""
    e = np.exp(log_e - log_e.max(axis=2, keepdims=True))
    a = np.exp(move - move.max())
    n, t, k = e.shape
    ahead, back = np.empty_like(e), np.ones_like(e)
    ahead[:, 0] = np.exp(begin - begin.max()) * e[:, 0]
    ahead[:, 0] /= ahead[:, 0].sum(axis=1, keepdims=True)
    for s in range(1, t):
        ahead[:, s] = ahead[:, s - 1] @ a * e[:, s]
        ahead[:, s] /= ahead[:, s].sum(axis=1, keepdims=True)
    for s in range(t - 2, -1, -1):
        back[:, s] = (back[:, s + 1] * e[:, s + 1]) @ a.T
        back[:, s] /= back[:, s].sum(axis=1, keepdims=True)
    p = ahead * back
    p /= p.sum(axis=2, keepdims=True)
    # Of two neighbours, x then y: ahead(x) a(x, y) behind(y), over its sum.
    before, behind = ahead[:, :-1].reshape(-1, k), (e * back)[:, 1:].reshape(-1, k)
    behind = behind / np.einsum("nk,nk->n", before @ a, behind)[:, None]
    return p, a * (before.T @ behind), p[:, 0]


def sample_of(docs: DataFrame, each: int = SAMPLE_DOCS) -> list[tuple[str, list[str]]]:
    """About ``each`` labelled documents of every language (columns ``doc_id, text, lang``), or where
    languages are many about ``SAMPLE_TOTAL`` in all, ``SAMPLE_LEAST`` each at least, with
    ``SAMPLE_WORDS`` bare words of each document."""
    labelled = docs.where("lang IS NOT NULL AND doc_id IS NOT NULL")
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return []
    each = min(each, max(SAMPLE_LEAST, SAMPLE_TOTAL // len(counts)))
    scale = 1 << 30
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(scale))
    limits = {lang: min(scale, each * scale // n + 1) for lang, n in sorted(counts.items())}
    limit = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
    # The draw is by id, so the texts of other documents are not looked at.
    chosen = labelled.where(draw < F.try_element_at(limit, F.col("lang")))

    def cut(batches):
        for batch in batches:
            langs, out = [], []
            for lang, text, key in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(),
                                       batch["doc_id"].to_pylist(), strict=True):
                words = [b for b in map(bare, (text or "").split()) if b]
                at = int(np.random.default_rng(abs(key)).integers(0, max(1, len(words) - SAMPLE_WORDS + 1)))
                if words:
                    langs.append(lang)
                    out.append(words[at : at + SAMPLE_WORDS])
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(out, pa.list_(pa.string()))], names=["lang", "words"]
            )

    got = chosen.select("doc_id", "lang", "text").mapInArrow(cut, "lang string, words array<string>")
    rows = [(r["lang"], list(r["words"])) for r in got.collect()]
    return sorted(rows)


class _Reader:
    """Emissions of words, kept by a worker while it uses the same model."""

    def __init__(self, model: Model):
        self.model, self.place, self.table = model, {}, np.empty((0, len(model.labels)))

    def rows(self, words: list[str]) -> np.ndarray:
        """Row of each word in ``table``; -1 without a letter."""
        if self.table.size > CACHED_CELLS:
            self.place, self.table = {}, self.table[:0]
        new, shapes = [], []
        at, base = self.place, len(self.table)
        for word in words:
            if word not in at:
                shape = bare(word)
                at[word] = base + len(new) if shape else -1
                if shape:
                    new.append(word)
                    shapes.append(shape)
        if new:
            self.table = np.concatenate([self.table, self.model.emissions(shapes)])
        return np.fromiter(map(at.__getitem__, words), np.int64, len(words))


def label_documents(
    docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text",
    carry: tuple[str, ...] = (), certainty: bool = False,
) -> DataFrame:
    """``doc_id, lang_pred, score, spans, carried``; with ``certainty`` also that column, the mean over
    the words of their best posterior, which a text of several languages has too. Spans are the stretches of one language among
    the words with letters, each as language, first such word and number; carried is a struct of
    the columns named in ``carry``."""
    along = F.struct(F.lit(0).alias("_none"), *[F.col(f"`{c}`") for c in carry])
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"), along.alias("carried"))
    spans = "array<struct<lang:string,first:long,words:long>>"
    schema = (
        f"doc_id long, lang_pred string, score double, spans {spans},"
        f" carried {rows.schema['carried'].dataType.simpleString()}" + ", certainty double" * certainty
    )
    if model is None:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(None).cast(spans).alias("spans"), "carried",
                           *[F.lit(0.0).alias("certainty")] * certainty)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # as large as the sample makes it

    def label(batches):
        reader = _Reader(sent.value)
        for batch in batches:
            for part in sub_batches(batch, most=max(1 << 14, (1 << 20) * FEW // max(FEW, len(model.labels)))):
                rows = _label_part(part, reader)
                yield rows if certainty else rows.select(rows.schema.names[:-1])

    return rows.mapInArrow(label, schema)


def _label_part(part: pa.RecordBatch, reader: _Reader) -> pa.RecordBatch:
    model, n = reader.model, part.num_rows
    lists = pc.utf8_split_whitespace(part["text"].cast(pa.large_string()))
    owner = np.repeat(np.arange(n), np.diff(lists.offsets.to_numpy()))
    coded = lists.flatten().dictionary_encode()
    known = reader.rows(coded.dictionary.to_pylist())
    word = known[coded.indices.to_numpy()] if len(known) else np.empty(0, np.int64)
    owner, word = owner[word >= 0], word[word >= 0]
    pred, score, certain = np.full(n, -1), np.zeros(n), np.zeros(n)
    spans: list[list] = [[] for _ in range(n)]
    if len(word):
        first = np.ones(len(word), bool)
        first[1:] = owner[1:] != owner[:-1]
        p = forward_backward(reader.table[word], first, model)
        starts = np.flatnonzero(first)
        mass = np.add.reduceat(p, starts, axis=0)
        at = owner[starts]
        pred[at] = mass.argmax(axis=1)
        score[at] = mass.max(axis=1) / mass.sum(axis=1)
        certain[at] = np.add.reduceat(p.max(axis=1), starts) / np.diff(np.append(starts, len(p)))
        best = p.argmax(axis=1)
        new = first.copy()
        new[1:] |= best[1:] != best[:-1]
        edges = np.flatnonzero(new)
        sizes = np.diff(np.append(edges, len(word)))
        begun = starts[np.searchsorted(starts, edges, "right") - 1]
        for row, lang, since, size in zip(owner[edges].tolist(), best[edges].tolist(),
                                          (edges - begun).tolist(), sizes.tolist(), strict=True):
            spans[row].append((model.labels[lang], since, size))
    names = np.array([*model.labels, UNKNOWN], dtype=object)
    kind = pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int64()), ("words", pa.int64())]))
    listed = pa.array([[{"lang": a, "first": b, "words": c} for a, b, c in s] for s in spans], kind)
    return pa.RecordBatch.from_arrays(
        [part["doc_id"], pa.array(names[pred], pa.string()), pa.array(np.minimum(score, 1.0)), listed,
         part["carried"], pa.array(np.minimum(certain, 1.0))],
        names=["doc_id", "lang_pred", "score", "spans", "carried", "certainty"],
    )


def held_out(doc_id: str = "doc_id"):
    """Documents that are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn_from(docs: DataFrame) -> Model | None:
    """Fit to the labelled documents that are not held out."""
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    samples = sample_of(named.where(~held_out()))
    return learn(samples) if samples else None
