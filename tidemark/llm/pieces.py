"""SentencePiece encoding and decoding as a weighted transducer.

Three machines are compiled from a model file: the normaliser (blanks to the blank mark, one put
before the text), the pieces with their weights, and byte fallback for characters that no piece
has. An input is composed with them to a lattice of piece arcs, and the shortest path in the
tropical semiring (minimum over paths, sum along a path) is its encoding; decoding runs the
machine backwards.

For a unigram model an arc weighs the negative log probability of its piece. A model of merges (BPE)
has no such weights: there, a path is what the merges give if and only if each two neighbours are
what the merges give for the two alone. So a second acceptor over pairs of neighbours weighs zero for
such a pair and infinity for any other; the composition keeps exactly the merge result, and the
shortest path finds it.

No piece has a blank mark after another character, so no arc spans the start of a word, and the
lattice of a text is a chain of lattices of words; equal words of a batch are composed once, and the
worker remembers them.

Defined cases: a null or empty text has no ids and decodes to an empty one; null ids and repeated
rows are encoded row by row; an empty table gives no rows; other columns are not read. Models with
a character map of their own are refused.
"""

from __future__ import annotations

import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.encode import gather, words_between
from tidemark.llm.repeats import sub_batches

MARK = "▁"
#: Words, and pairs of neighbours, that a worker remembers, words in two generations.
CACHED_WORDS, CACHED_PAIRS = 500_000, 1_000_000
#: Bytes of text that are cut at once.
STRETCH_BYTES = 4 << 20
INFINITY = float("inf")
_CUT = re.compile(r"(?<=[^ \n])(?=[ \n])|(?<=\n)(?=[^\n])")
_UNEVEN = re.compile(r"[ \n][ \n]|^[ \n]|[ \n]$")
_NORMAL, _UNKNOWN, _CONTROL, _USER, _BYTE = 1, 2, 3, 4, 6
_MACHINES: dict[str, "PieceTransducer"] = {}


class PieceTransducer:
    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if len(spec.precompiled_charsmap) > 2 or spec.remove_extra_whitespaces or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models without a character map and with blanks kept")
        self.prefix = MARK if spec.add_dummy_prefix else ""
        self.merges = model.trainer_spec.model_type == 2
        self.weight: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.bytes = [0] * 256
        self.output: list[bytes] = []
        self.unknown = 0
        for i, p in enumerate(model.pieces):
            if p.type in (_NORMAL, _USER):
                self.ids[p.piece] = i
                self.weight[p.piece] = -p.score
                self.output.append(p.piece.replace(MARK, " ").encode())
            elif p.type == _BYTE:
                self.bytes[int(p.piece[3:5], 16)] = i
                self.output.append(bytes([int(p.piece[3:5], 16)]))
            else:
                self.unknown = i if p.type == _UNKNOWN else self.unknown
                self.output.append(" ⁇ ".encode() if p.type == _UNKNOWN else b"")
        self.spelt = np.frombuffer(b"".join(self.output), np.uint8)
        self.spelt_bounds = np.cumsum([0, *map(len, self.output)])
        self.fallback = model.trainer_spec.byte_fallback
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece spans the start of a word")
        #: The pieces as a trie, by its paths; and all pairs of characters that a piece holds: no
        #: arc spans any other pair, so a text may be cut there.
        self.prefixes = {p[:n] for p in self.ids for n in range(1, len(p) + 1)}
        self.inside = {p[n : n + 2] for p in self.ids for n in range(len(p) - 1)}
        self.parts: dict[str, tuple[str, str] | None] = {}
        self.pairs: dict[str, dict[str, bool]] = {}
        self.n_pairs = 0
        self.words: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """What the merges give for a short text: the best pair first, the leftmost of equals."""
        parts, weight = list(text), self.weight
        while len(parts) > 1:
            costs = [weight.get(a + b, INFINITY) for a, b in zip(parts, parts[1:], strict=False)]
            best = min(costs)
            if best == INFINITY:
                break
            i = costs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def last_merge(self, piece: str) -> tuple[str, str] | None:
        """The two parts that the merges join last to the piece; itself twice for a character, and
        None if the merges never give the piece."""
        if piece not in self.parts:
            parts, weight = list(piece), self.weight
            while len(parts) > 2:
                costs = [weight.get(a + b, INFINITY) for a, b in zip(parts, parts[1:], strict=False)]
                i = costs.index(min(costs))
                if costs[i] == INFINITY:
                    break
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            if len(parts) == 1:
                parts *= 2
            self.parts[piece] = tuple(parts) if len(parts) == 2 else None
        return self.parts[piece]

    def _joins(self, left: str, right: str) -> bool:
        """Whether the merges, given the two texts end to end, give the two pieces. The merges are
        undone from the last: a join across the border that would have come before one undone is
        one that the merges would have taken."""
        if not self.last_merge(right):
            return False
        if not left:
            return True
        weight = self.weight
        rank = lambda piece: weight[piece] if len(piece) > 1 else -INFINITY
        limit, equal_wins = INFINITY, False
        while True:
            across = weight.get(left + right)
            if across is not None and (across < limit or equal_wins and across == limit):
                return False
            if len(left) == len(right) == 1:
                return True
            # Of equal merges the left one comes first, so the right one is undone first.
            if rank(left) > rank(right):
                limit, equal_wins = rank(left), False
                left = self.last_merge(left)[1]
            else:
                limit, equal_wins = rank(right), True
                right = self.last_merge(right)[0]

    def neighbours(self, left: str, right: str) -> bool:
        """The acceptor of pairs: true if the pair weighs zero. ``left`` is empty at the start."""
        row = self.pairs.setdefault(left, {})
        known = row.get(right)
        if known is None:
            if self.n_pairs >= CACHED_PAIRS:
                self.pairs, self.n_pairs = {}, 0
                row = self.pairs.setdefault(left, {})
            known = row[right] = self._joins(left, right)
            self.n_pairs += 1
        return known

    def arcs(self, text: str, at: int) -> list[str]:
        """Pieces that start at a place of the text; a character without a piece stands for itself
        and is spelt in bytes."""
        ids, prefixes = self.ids, self.prefixes
        found = [text[at]]
        for end in range(at + 2, len(text) + 1):
            piece = text[at:end]
            if piece not in prefixes:
                break
            if piece in ids:
                found.append(piece)
        return found

    def shortest_path(self, text: str) -> list[str]:
        """Pieces of a normalised text along the path of least weight."""
        n = len(text)
        cost, back = [INFINITY] * (n + 1), [""] * (n + 1)
        cost[0] = 0.0
        for i in range(n):
            if cost[i] == INFINITY:
                continue
            left = back[i]
            known = self.pairs.get(left, {})
            for piece in self.arcs(text, i):
                if not self.merges:
                    total = cost[i] + self.weight.get(piece, 1e3)
                elif known.get(piece) or piece not in known and self.neighbours(left, piece):
                    total = cost[i]
                else:
                    continue
                j = i + len(piece)
                if total < cost[j]:
                    cost[j], back[j] = total, piece
        if cost[n] == INFINITY:
            raise ValueError(f"no path for {text!r}")
        out, at = [], n
        while at:
            out.append(back[at])
            at -= len(back[at])
        return out[::-1]

    def _ids(self, pieces: list[str]) -> bytes:
        out = array("I")
        for p in pieces:
            i = self.ids.get(p)
            if i is not None:
                out.append(i)
            elif self.fallback:
                out.extend(self.bytes[b] for b in p.encode())
            else:
                out.append(self.unknown)
        return out.tobytes()

    def stretch(self, text: str) -> bytes:
        """Ids of a piece of a word between places that no arc spans."""
        ids = self._known(text)
        if ids is None:
            ids = self._ids(self.shortest_path(text))
            if len(text) <= 64:
                self._keep(text, ids)
        return ids

    def word(self, text: str) -> bytes:
        """Ids of a normalised stretch that no arc leaves."""
        ids = self._known(text)
        if ids is None:
            inside = self.inside
            cuts = [n for n in range(1, len(text)) if text[n - 1 : n + 1] not in inside]
            edges = [0, *cuts, len(text)] if self.merges else [0, len(text)]
            ids = b"".join(
                [self.stretch(text[x:y]) for x, y in zip(edges, edges[1:], strict=False)]
            )
            if len(text) <= 64:
                self._keep(text, ids)
        return ids

    def _keep(self, text: str, ids: bytes) -> None:
        """Remember; a full memory becomes the old one, in front of which a new one grows."""
        if len(self.words) >= CACHED_WORDS // 2:
            self.words, self.old = {}, self.words
        self.words[text] = ids

    def _known(self, text: str) -> bytes | None:
        ids = self.words.get(text)
        if ids is None:
            ids = self.old.get(text)
            if ids is not None:
                self._keep(text, ids)
        return ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit values."""
        if not text:
            return b""
        text = text.replace(MARK, " ")
        if not self.merges:
            return self._ids(self.shortest_path((self.prefix + text).replace(" ", MARK)))
        split_lines = "\n" not in self.ids
        if not self.prefix or not split_lines or _UNEVEN.search(text):
            whole = (self.prefix + text).replace(" ", MARK)
            cuts = re.split(f"(?<=[^{MARK}])(?={MARK})", whole)
            return b"".join(map(self.word, cuts))
        newline, word = self._ids(["\n"]), self.word
        out = []
        for part in text.replace("\n", " \n").split(" "):
            out.append(newline + word(part[1:]) if part[:1] == "\n" else word(MARK + part))
        return b"".join(out)

    def encode_batch(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text. Distinct words of the batch are composed once: texts are cut before each
        run of blanks and around line ends, where no arc runs across."""
        if not self.merges or not self.prefix or any("\n" in p for p in self.ids):
            return [np.frombuffer(self.encode(t.as_py() or ""), "<u4") for t in texts]
        plain = pc.replace_substring(texts.cast(pa.large_string()).fill_null(""), MARK, " ")
        empty, blank = (pa.scalar(x, pa.large_string()) for x in ("", " "))
        led = pc.binary_join_element_wise(pc.if_else(pc.equal(plain, empty), empty, blank), plain, empty)
        words, ends = words_between(led, _piece_starts)
        coded = words.dictionary_encode()
        word = self.word
        ids = [word(w.decode().replace(" ", MARK)) for w in coded.dictionary.to_pylist()]
        if not ids:
            return [np.empty(0, "<u4") for _ in range(len(texts))]
        bounds = np.cumsum([0, *map(len, ids)]) // 4
        flat, word_ends = gather(np.frombuffer(b"".join(ids), "<u4"), bounds, coded.indices.to_numpy())
        return np.split(flat, np.concatenate([[0], word_ends])[ends])[: len(texts)]

    def decode_batch(self, ids: list[np.ndarray]) -> list[str]:
        """Each text read back."""
        codes = np.concatenate([np.empty(0, np.int64), *ids]).astype(np.int64)
        flat, ends = gather(self.spelt, self.spelt_bounds, codes)
        cuts = np.concatenate([[0], ends])[np.cumsum([0, *map(len, ids)])]
        raw = flat.tobytes()
        texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        return [t[1:] if self.prefix and t[:1] == " " else t for t in texts]

    def decode(self, ids: np.ndarray) -> str:
        raw = b"".join(map(self.output.__getitem__, ids.tolist()))
        text = raw.decode("utf-8", "replace")
        return text[1:] if self.prefix and text[:1] == " " else text


def _piece_starts(raw: np.ndarray) -> np.ndarray:
    """Where a word may begin: a blank after something else, a line end, and what follows one."""
    line = raw == 10
    return (raw[1:] == 32) & (raw[:-1] != 32) | line[1:] | line[:-1]


def transducer(path: str) -> PieceTransducer:
    """The worker's machine for a model file; compiled once."""
    if path not in _MACHINES:
        _MACHINES[path] = PieceTransducer(path)
    return _MACHINES[path]


def encode_texts(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids, ids_crc32, decoded``: ids as an int array; decoded is the text read back."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))

    def encode(batches):
        machine = transducer(path)
        for whole in batches:
            for part in sub_batches(whole, most=STRETCH_BYTES):
                ids = machine.encode_batch(part["text"])
                flat = np.concatenate(ids).astype(np.int32)
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                     pa.array([zlib.crc32(i.tobytes()) for i in ids], pa.int64()),
                     pa.array(machine.decode_batch(ids), pa.string())],
                    names=["doc_id", "ids", "ids_crc32", "decoded"],
                )

    return rows.mapInArrow(encode, "doc_id long, ids array<int>, ids_crc32 long, decoded string")


def decode_ids(rows: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """Add ``text``, read back from an int array column; null ids give an empty text."""

    def decode(values):
        machine = transducer(path)
        import pandas as pd

        for part in values:
            yield pd.Series(["" if v is None else machine.decode(np.asarray(v)) for v in part])

    from collections.abc import Iterator

    import pandas as pd

    decode.__annotations__ = {"values": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return rows.withColumn("text", F.pandas_udf(decode, "string")(F.col(f"`{ids}`")))
