"""Token ids of whole texts by the ``tokenizers`` library, each distinct word of a batch encoded once.

No piece of either vocabulary's pattern spans a place where white space follows something else, or
where a mark, digit or blank follows a Latin letter, and none looks back over one. A text may be cut
at these places, so its ids are those of its words, each with the white space before it, and of the
marks after them, set end to end. A batch of texts is cut, its distinct words are
found by Arrow, those that the worker does not remember go to the library in one call, and the ids
are gathered by index.

A tokenizer for which a probe text shows another result encodes whole texts.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Words whose ids a worker keeps, at most, in two generations. It saves time only.
CACHED_WORDS = 400_000
#: Bytes of text that are cut at once.
STRETCH_BYTES = 8 << 20
#: Words of a line that goes to the library.
LINE_WORDS = 1024
PROBE = (
    "The wordy, Straße café. a\nB don't 12,5 x.y of.,;\nfoo\n\nbar  baz   q \n end— ΣΣ 'tis "
    "so 'some said, 'said ('the and o'that l'very we'll\n'told x\n  y 　z  \tw "
)
_BEFORE = np.zeros(256, bool)
_BEFORE[[9, 10, 13, 32]] = True
#: Bytes that end a character other than white space, or end one as well: those of white space
#: beyond ASCII are looked at with the bytes before them.
_ENDS = np.zeros(256, bool)
_ENDS[33:127] = True
_ENDS[128:] = True
#: ASCII letters, the second bytes of accented Latin-1 letters (after C3), and ASCII but letters.
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123)]] = True
_LATIN = np.zeros(256, bool)
_LATIN[[b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)]] = True
_OTHERS = ~_LETTERS
_OTHERS[128:] = False
_WIDE = tuple("\u0085\u00a0\u1680\u2028\u2029\u202f\u205f\u3000") + tuple(map(chr, range(0x2000, 0x200B)))
_TAILS = {
    n: np.array([int.from_bytes(w, "big") for c in _WIDE if len(w := c.encode()) == n], np.uint32) for n in (2, 3)
}
_ENCODERS: dict[tuple[str, str], "TextEncoder"] = {}


def words_between(texts: pa.Array, begins) -> tuple[pa.Array, np.ndarray]:
    """The texts' words as one array, and how many words there are up to the end of each text. An empty
    or null text has none. ``begins`` tells for all bytes of the batch but the first whether one begins
    there; every text begins a word."""
    texts = pa.concat_arrays([texts.cast(pa.large_binary())]).fill_null(b"")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    low, high = (int(ends[0]), int(ends[-1])) if len(ends) else (0, 0)
    raw = np.frombuffer(texts.buffers()[2], np.uint8)[low:high] if high > low else np.empty(0, np.uint8)
    ends = ends - low
    starts = np.zeros(len(raw) + 1, bool)
    if len(raw):
        starts[1:-1] = begins(raw)
    starts[ends] = True
    edges = np.flatnonzero(starts) if len(raw) else np.zeros(1, np.int64)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(raw)]
    )
    return words, np.searchsorted(edges, ends[1:])


def _word_starts(raw: np.ndarray) -> np.ndarray:
    """White space after something else, and marks, digits and blanks after a Latin letter."""
    starts = np.zeros(len(raw), bool)
    starts[1:] = _BEFORE[raw[1:]] & _ENDS[raw[:-1]]
    after = np.flatnonzero(starts)
    after = after[(after > 2) & (raw[after - 1] >= 128)]
    tail = raw[after - 1].astype(np.uint32) | raw[after - 2].astype(np.uint32) << 8
    wide = np.isin(tail, _TAILS[2])
    wide |= np.isin(tail | raw[after - 3].astype(np.uint32) << 16, _TAILS[3])
    starts[after[wide]] = False
    starts[:3] = False
    letters = _LETTERS[raw[:-1]]
    letters[1:] |= (raw[:-2] == 0xC3) & _LATIN[raw[1:-1]]
    return starts[1:] | letters & _OTHERS[raw[1:]]


def gather(flat: np.ndarray, bounds: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches ``codes`` of ``flat`` set end to end, and their ends; stretch ``c`` lies between
    ``bounds[c]`` and ``bounds[c + 1]``."""
    sizes = np.diff(bounds)[codes]
    ends = np.cumsum(sizes)
    at = np.arange(ends[-1] if len(ends) else 0)
    return flat[at + np.repeat(bounds[codes] - (ends - sizes), sizes)], ends


class Remembered:
    """Values of words in two generations: a full one becomes the old one, and what is asked for again
    moves on to the new one."""

    def __init__(self, compute, most: int = CACHED_WORDS):
        self.compute, self.most = compute, max(2, most)
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def __len__(self) -> int:
        return len(self.new) + len(self.old)

    def get(self, words: list[bytes]) -> list[bytes]:
        """Values of distinct words; those not remembered are computed in one call."""
        new, old = self.new, self.old
        out = [new.get(w) for w in words]
        missing = []
        for i, value in enumerate(out):
            if value is None:
                value = out[i] = old.get(words[i])
                if value is None:
                    missing.append(i)
                else:
                    self._keep(words[i], value)
        if missing:
            for i, value in zip(missing, self.compute([words[i] for i in missing]), strict=True):
                out[i] = value
                self._keep(words[i], value)
        return out

    def _keep(self, word: bytes, value: bytes) -> None:
        if len(word) > 64:
            return
        if len(self.new) >= self.most // 2:
            self.old, self.new = self.new, {}
        self.new[word] = value


class TextEncoder:
    def __init__(self, path: str, white_space: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        #: White space that is dropped is not a part of what a word is remembered by.
        self.dropped = white_space == "dropped"
        self.simple = re.compile(rb"%s(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+" % (b"" if self.dropped else b" "))
        #: Ids that end a word (word-end vocabularies) or begin one after a blank (byte-level ones).
        self.edges = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.edges[[
            i for t, i in self.tokenizer.get_vocab().items()
            if (t.endswith("</w>") if self.dropped else t.startswith("\u0120"))
        ]] = True
        self.words = Remembered(self._encode)
        self.cached = True
        self.cached = all(self(x) == self.plain(x) for x in (PROBE, PROBE.strip(), ""))

    def plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of words. Plain ones go to the library as lines of many; each has one piece, so the
        pieces' edges tell them apart."""
        simple = [i for i, w in enumerate(words) if self.simple.fullmatch(w)]
        out: list[bytes] = [b""] * len(words)
        other = range(len(words))
        if simple and self.edges.any():
            lines = [simple[a : a + LINE_WORDS] for a in range(0, len(simple), LINE_WORDS)]
            glue = b" " if self.dropped else b""
            found = self._library([glue.join([words[i] for i in line]) for line in lines])
            left = []
            for line, ids in zip(lines, found, strict=True):
                at = np.flatnonzero(self.edges[ids])
                if len(at) != len(line):
                    left += line
                    continue
                at = [0, *(at + 1).tolist()] if self.dropped else [*at.tolist(), len(ids)]
                raw = ids.tobytes()
                for i, x, y in zip(line, at, at[1:], strict=False):
                    out[i] = raw[4 * x : 4 * y]
            done = set(simple).difference(left)
            other = [i for i in range(len(words)) if i not in done]
        for i, ids in zip(other, self._library([words[i] for i in other]), strict=True):
            out[i] = ids.tobytes()
        return out

    def _library(self, texts: list[bytes]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in found]

    def __call__(self, text: str) -> bytes:
        return self.batch(pa.array([text], pa.string()))[0].tobytes()

    def batch(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text."""
        if not self.cached:
            return [np.frombuffer(self.plain(t.as_py() or ""), "<u4") for t in texts]
        words, ends = words_between(texts, _word_starts)
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if not distinct:
            return [np.empty(0, "<u4") for _ in range(len(texts))]
        if self.dropped:
            distinct = [w.strip(b" \n") for w in distinct]
        ids = self.words.get(distinct)
        bounds = np.cumsum([0, *map(len, ids)]) // 4
        flat, word_ends = gather(np.frombuffer(b"".join(ids), "<u4"), bounds, coded.indices.to_numpy())
        cuts = np.concatenate([[0], word_ends])[ends]
        return np.split(flat, cuts)[: len(texts)]


def encoder(path: str, white_space: str) -> TextEncoder:
    """The worker's encoder of this vocabulary; loaded once."""
    if (path, white_space) not in _ENCODERS:
        _ENCODERS[path, white_space] = TextEncoder(path, white_space)
    return _ENCODERS[path, white_space]
