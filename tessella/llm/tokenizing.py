"""Token ids of many texts by a file of the tokenizers library."""

from __future__ import annotations

import os
import sys
import types
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: A word of Latin letters and the ASCII signs after it: the pattern's own two pieces.
_WORD = rf"^[ \n]?[{_LATIN}]+[!-/:-@\[-`{{-~]*\z"
#: Single pieces: a word after a space; a word or signs as they stand.
_SPACED = rf"^ [{_LATIN}]+\z"
_PIECE = rf"^(?:[{_LATIN}]+|[!-/:-@\[-`{{-~]+)\z"
_KEPT, _KEPT_BYTES = 500_000, 1 << 26
_RESTING = 300_000  # chunks of a worker between its tasks
_CALL, _CALL_TEXTS = 1 << 20, 20_000  # characters and texts that the library gets in a call, unless one text is longer
_BARE = "\0"
#: White space by its UTF-8 bytes: single bytes as a table, longer ones as numbers.
_SPACES = np.array([b < 128 and chr(b).isspace() for b in range(256)])
_WIDE = {n: np.array([int.from_bytes(c) for c in (chr(i).encode() for i in range(128, 0x3001) if chr(i).isspace()) if len(c) == n]) for n in (2, 3)}


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the rest follows from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


_LETTERS = _byte_letters()
_LINED = _LETTERS | {10: "\n"}
_LINE, _TOGETHER = 1024, 16


def _in_letters(pieces: str) -> str:
    """Pieces, a line each, in the byte-level alphabet; they hold signs, letters and spaces only."""
    return pieces.replace(" ", _LETTERS[32]) if pieces.isascii() else pieces.encode().decode("latin-1").translate(_LINED)


def _strings(offsets: np.ndarray, data) -> pa.StringArray:
    """The strings between the offsets, without a copy of their bytes."""
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(np.ascontiguousarray(offsets, np.int32)), pa.py_buffer(data))


def _bytes_of(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of the texts and the bytes they point into."""
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(1, np.int32), np.zeros(0, np.uint8)
    return np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1], np.frombuffer(data or b"", np.uint8)


def _numbered(first: pa.StringArray, then: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    """``first``, which are distinct, with the new ones of ``then`` after them; the places of ``then`` in that list."""
    found = pa.concat_arrays([first, then]).dictionary_encode()
    return found.dictionary, found.indices[len(first):].to_numpy()


def _calls(texts: list[str]) -> Iterator[list[str]]:
    """The texts in lists of bounded size: the library's results take many times a text's room."""
    part, size = [], 0
    for text in texts:
        if part and (size + len(text) > _CALL or len(part) == _CALL_TEXTS):
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def _chunked(texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    """The texts cut before each single space or line feed between two characters that are no
    white space, where the byte-level pattern always starts a new piece; each text's first chunk,
    and the end."""
    offsets, data = _bytes_of(texts)
    offsets, data = offsets - offsets[0], data[offsets[0]:offsets[-1]]
    around = np.concatenate([np.zeros(3, np.uint8), data, np.zeros(3, np.uint8)])
    at = np.flatnonzero((data == 32) | (data == 10)) + 3
    at = at[~(_SPACES[around[at - 1]] | _SPACES[around[at + 1]])]
    wide = np.flatnonzero((around[at - 1] > 127) | (around[at + 1] > 127))
    if len(wide):
        near, inside = at[wide], np.zeros(len(wide), bool)
        for size, spaces in _WIDE.items():
            for first in (near - size, near + 1):
                char = np.zeros(len(near), np.int64)
                for i in range(size):
                    char = char << 8 | around[first + i]
                inside |= np.isin(char, spaces)
        at = np.delete(at, wide[inside])
    starts = np.zeros(len(data) + 1, bool)
    starts[at - 3] = True
    starts[offsets] = True
    starts = np.flatnonzero(starts)
    return _strings(starts, data), np.searchsorted(starts, offsets)


def worker_encoder(path: str) -> "TextEncoder":
    """This process's encoder: a worker that runs several tasks loads the file once.

    Call ``rest`` at the end of a task, so that idle workers hold the most frequent chunks only.
    """
    state = sys.modules.setdefault("tessella_worker_state", types.ModuleType("tessella_worker_state")).__dict__
    known = state.setdefault("encoders", {})
    if path not in known:
        known[path] = TextEncoder(path)
    return known[path]


class TextEncoder:
    """Encodes whole texts, each distinct chunk between two safe cuts only once.

    The byte-level pattern never matches across a safe cut, so the ids of a text are those
    of its chunks, one after the other. Chunks are numbered by Arrow, many texts at once. A
    chunk that is a word with signs after it is two pieces of the pattern, which go to the
    model at once. Other kinds of tokenizers get the whole text.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.tokenizer = Tokenizer.from_file(path)
        split = str(self.tokenizer.pre_tokenizer)
        self.cuts = self.tokenizer.normalizer is None and split == "ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=True)"
        model = self.tokenizer.model
        if hasattr(model, "_resize_cache"):
            model._resize_cache(0)  # every text it sees is new
        #: The same model for single pieces in byte letters.
        self.pieced = Tokenizer(model)
        #: The same for lines of pieces; a piece after a space begins with the only token that holds it.
        self.lined = Tokenizer(model)
        self.lined.pre_tokenizer = CharDelimiterSplit("\n")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.begins = np.zeros(1 + max(vocabulary.values(), default=0), bool)
        self.begins[[i for t, i in vocabulary.items() if t.startswith(_LETTERS[32])]] = True
        self.clear()

    def clear(self):
        #: Known chunks, the empty one first; where their ids stand in ``flat``; how often they were used.
        self.known = pa.array([""], pa.string())
        self.sizes, self.starts, self.flat = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(0, np.uint32)
        self.uses = np.zeros(1, np.int64)

    @property
    def numbers(self) -> dict[str, int]:
        """Known chunks: words after a space without it, others with a mark."""
        return {c[1:] if c[0] == " " else _BARE + c: i for i, c in enumerate(self.known.to_pylist()) if c}

    def encode(self, texts: list[str] | pa.StringArray) -> list[np.ndarray]:
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if not self.cuts:
            return self._ids(self.tokenizer, column.to_pylist())
        if len(self.known) > _KEPT or self.known.nbytes > _KEPT_BYTES:
            self._forget(_KEPT // 2)
            if self.known.nbytes > _KEPT_BYTES // 2:
                self.clear()
        chunks, ends = _chunked(column.cast(pa.string()))
        listed, numbers = _numbered(self.known, chunks)
        if len(listed) > len(self.known):
            self._learn(listed)
        self.uses += np.bincount(numbers, minlength=len(self.uses))
        return [self._gathered(numbers[a:b]) for a, b in zip(ends, ends[1:])]

    def _gathered(self, numbers: np.ndarray) -> np.ndarray:
        """Ids of known chunks, one after the other."""
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[numbers] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        return self.flat[at]

    def _add(self, numbers: np.ndarray, sizes: np.ndarray, flat: np.ndarray):
        """Chunks' ids, in the order of their numbers given."""
        self.sizes[numbers] = sizes
        self.starts[numbers] = len(self.flat) + np.cumsum(sizes) - sizes
        self.flat = np.concatenate([self.flat, flat])

    @staticmethod
    def _ids(tokenizer, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.uint32) for part in _calls(texts) for e in tokenizer.encode_batch_fast(part, add_special_tokens=False)]

    def rest(self):
        self._forget(_RESTING)

    def _forget(self, most: int):
        """Keep the chunks most often used, but for those seen only once since the last time."""
        keep = np.flatnonzero(self.uses > 1)
        if len(keep) > most:
            keep = np.sort(keep[np.argpartition(self.uses[keep], -most)[-most:]])
        flat, sizes, uses = self._gathered(keep), self.sizes[keep], self.uses[keep]
        known = self.known.take(pa.array(keep))
        self.clear()
        self._list(pa.concat_arrays([self.known, known]))
        self._add(np.arange(1, len(self.known)), sizes, flat)
        self.uses[1:] = uses // 2

    def _list(self, known: pa.StringArray):
        """More chunks, without ids yet."""
        new = np.zeros(len(known) - len(self.known), np.int64)
        self.known = known
        self.sizes, self.starts, self.uses = (np.concatenate([x, new]) for x in (self.sizes, self.starts, self.uses))

    def _learn(self, listed: pa.StringArray):
        """Ids of the chunks listed after the known ones: of a line feed, a word and its signs each, else of the whole."""
        old, new = len(self.known), listed[len(self.known):]
        offsets, data = _bytes_of(new)
        word = pc.match_substring_regex(new, _WORD).to_numpy(zero_copy_only=False)
        begin = offsets[:-1] + (word & (data[offsets[:-1]] == 10))
        signs = offsets[:-1] + pc.binary_length(pc.ascii_rtrim(new, _SIGNS)).to_numpy()
        end = np.where(word, signs, offsets[1:])
        parts = _strings(np.append(np.stack([offsets[:-1], begin, end], axis=1).ravel(), offsets[-1]), data)
        known, rows = _numbered(listed, parts)
        self._list(known)
        single = np.zeros(len(known), bool)
        single[rows] = True
        self._learn_pieces(old + np.flatnonzero(single[old:]))
        rest = old + np.flatnonzero(~single[old:])
        rows = rows.reshape(-1, 3)[rest - old]
        self._add(rest, self.sizes[rows].sum(axis=1), self._gathered(rows.ravel()))

    def _learn_pieces(self, numbers: np.ndarray):
        """Single pieces go to the model in byte letters, other texts through the whole tokenizer."""
        texts = self.known.take(pa.array(numbers))
        spaced, piece = (pc.match_substring_regex(texts, p).to_numpy(zero_copy_only=False) for p in (_SPACED, _PIECE))
        plain = spaced & pc.string_is_ascii(texts).to_numpy(zero_copy_only=False)
        for chosen in (plain, spaced & ~plain):
            self._add(*self._lines(numbers[chosen], texts.filter(pa.array(chosen)).to_pylist()))
        for tokenizer, chosen in ((self.pieced, piece), (self.tokenizer, ~spaced & ~piece)):
            new = texts.filter(pa.array(chosen)).to_pylist()
            self._add(*self._singly(tokenizer, numbers[chosen], [_in_letters(t) for t in new] if tokenizer is self.pieced else new))

    @staticmethod
    def _singly(tokenizer, order: np.ndarray, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The numbers given, the texts' sizes and their ids."""
        sizes, flat = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
        for part in _calls(texts):
            found = [e.ids for e in tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
            flat.append(np.fromiter(chain.from_iterable(found), np.uint32, int(sizes[-1].sum())))
        return order, np.concatenate(sizes), np.concatenate(flat)

    def _lines(self, order: np.ndarray, new: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pieces after a space, many at once, as one by one.

        Only tokens that begin a piece hold a space if no merge crossed a border, and then none
        changed another piece's merges; so a few pieces stand together without a line feed.
        """
        joined = ["".join(new[at:at + _TOGETHER]) for at in range(0, len(new), _TOGETHER)]
        step = max(1, _LINE // _TOGETHER)
        lines = [_in_letters("\n".join(joined[at:at + step])) for at in range(0, len(joined), step)]
        step *= _TOGETHER
        sizes, flat = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
        found = (line for part in _calls(lines) for line in self.lined.encode_batch_fast(part, add_special_tokens=False))
        for at, line in enumerate(found):
            ids = np.array(line.ids, np.uint32)
            starts = np.flatnonzero(self.begins[ids])
            if len(starts) != len(new[at * step:(at + 1) * step]) or starts[0]:
                return self._singly(self.pieced, order, [_in_letters(t) for t in new])
            sizes.append(np.diff(np.append(starts, len(ids))))
            flat.append(ids)
        return order, np.concatenate(sizes), np.concatenate(flat)
