"""Token files: block round trips, exact ids, and reading back."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessella.llm import token_files, tokenizing
from tessella.llm.token_files import pack_blocks, token_index, tokenizer_path, unpack_block
from tessella.llm.tokenizing import TextEncoder
from tests.llm.cases import documents, empty

PATH = tokenizer_path()
PLAIN = Tokenizer.from_file(PATH)
ENCODER = TextEncoder(PATH)


@pytest.mark.parametrize("size", [0, 1, 1023, 1024, 1025, 70_001])
@pytest.mark.parametrize("high", [1, 2, 300, 50_257, 2**32])
def test_blocks(size, high):
    rng = np.random.default_rng(size + high)
    ids = rng.integers(0, high, size, dtype=np.uint64).astype(np.uint32)
    ids[rng.integers(0, max(size, 1), size // 30)] = 2**32 - 1
    blocks = pack_blocks(ids, 0.95)
    assert np.array_equal(np.concatenate([unpack_block(b) for b in blocks]) if blocks else ids[:0], ids)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list(" \n\t'a1.é  \x1c\0é日😀,sS_-")), max_size=20))
def test_encoder_agrees_with_the_library(text):
    assert ENCODER.encode([text])[0].tolist() == PLAIN.encode(text, add_special_tokens=False).ids


def test_encoder_on_special_and_line_texts():
    texts = ["<|endoftext|> a", "a\n\nb", "it's\nI'll  go ", "one two\nthree, four", "", "\n", "x" * 5000]
    assert [e.tolist() for e in ENCODER.encode(texts)] == [PLAIN.encode(t, add_special_tokens=False).ids for t in texts]


def test_frequent_chunks_stay_between_tasks():
    """A worker's next task finds the most used chunks, within a bound, and gets the same ids."""
    encoder = TextEncoder(PATH)
    texts = [" ".join(f"word{i % n}" for i in range(200)) for n in (3, 5, 40, 200)]
    want = [PLAIN.encode(t, add_special_tokens=False).ids for t in texts]
    assert [e.tolist() for e in encoder.encode(texts)] == want
    before = len(encoder.numbers)
    encoder._forget(5)
    assert before > 200 and sorted(encoder.numbers) == [f"word{i}" for i in range(5)]
    assert [e.tolist() for e in encoder.encode(texts)] == want
    encoder.rest()
    assert 5 < len(encoder.numbers) < before and [e.tolist() for e in encoder.encode(texts)] == want


def test_spaced_words_go_to_the_model_in_lines(monkeypatch):
    """Words after a space share calls of the library, and get the ids of calls of their own."""
    words = [a + b for a in ("tion", "été", "Übung", "x", "naïveté", "ZZ") for b in ("", "s", "ers", "ñandú", "qqq")]
    texts = ["start " + " ".join(words), "other\nline " + ", ".join(words) + "!"]
    monkeypatch.setattr(tokenizing, "_LINE", 7)
    encoder, sent = TextEncoder(PATH), []
    plain = encoder._singly
    monkeypatch.setattr(encoder, "_singly", lambda tokenizer, order, texts: sent.extend(texts) or plain(tokenizer, order, texts))
    assert [e.tolist() for e in encoder.encode(texts)] == [PLAIN.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(sent) < 10 < len(words)


WIDE = [chr(i) for i in range(128, 0x3001) if chr(i).isspace()]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from([*" \n\t'a1.éàÂ—“ł中à\x1c\0\x01", *WIDE]), max_size=12), max_size=6), st.integers(0, 3))
def test_columns_of_texts_agree_with_the_library(texts, first):
    """Arrow columns, sliced ones and all kinds of white space too."""
    want = [PLAIN.encode(t, add_special_tokens=False).ids for t in texts[first:]]
    assert [e.tolist() for e in ENCODER.encode(pa.array(texts, pa.string()).slice(first))] == want


def test_wide_spaces_beside_cuts():
    texts = [f"{a}x{w}{s}y, {w}z{s}{w}" for w in [*WIDE, "\t", "à", "Š", "…", "”"] for s in " \n" for a in ("", " ", "é")]
    assert [e.tolist() for e in ENCODER.encode(texts)] == [PLAIN.encode(t, add_special_tokens=False).ids for t in texts]
    chunks, ends = tokenizing._chunked(pa.array(["“a” “b” «c» dà é\nf", "", "g h"]))
    assert chunks.to_pylist() == ["“a”", " “b”", " «c»", " dà", " é", "\nf", "g", " h"] and ends.tolist() == [0, 6, 6, 8]


def test_a_chunk_is_looked_up_in_whole_columns(monkeypatch):
    """Two passes of Arrow over a column of many texts, and few pieces for the library to cut."""
    calls, plain, encoder = [], tokenizing._numbered, TextEncoder(PATH)
    monkeypatch.setattr(tokenizing, "_numbered", lambda first, then: calls.append(len(then)) or plain(first, then))
    texts = [f"text of words like qu{'abcdefghij'[i % 10] * (i // 10 + 1)}zz and été{'klmnopqrst'[i % 10]}" for i in range(200)]
    for _ in range(2):
        assert [e.tolist() for e in encoder.encode(texts)] == [PLAIN.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(calls) == 3


def test_long_chunks_and_calls_are_bounded(monkeypatch):
    """Texts without cuts: few characters in a call of the library, few bytes kept."""
    monkeypatch.setattr(tokenizing, "_CALL", 100)
    monkeypatch.setattr(tokenizing, "_KEPT_BYTES", 3000)
    encoder, sizes = TextEncoder(PATH), []
    plain = tokenizing._calls
    monkeypatch.setattr(tokenizing, "_calls", lambda texts: (sizes.append((sum(map(len, p)), len(p))) or p for p in plain(texts)))
    for i in range(20):
        texts = [f"{chr(0x4E00 + i * 9 + k)}日本語の文{k}" * 9 for k in range(9)] + ["repeated文" * 50, "a b c"]
        assert [e.tolist() for e in encoder.encode(texts)] == [PLAIN.encode(t, add_special_tokens=False).ids for t in texts]
        assert encoder.known.nbytes < 3000 + 2 * sum(len(t.encode()) + 4 for t in texts)
    assert all(size <= 100 or count == 1 for size, count in sizes)


def test_shares_of_a_column(monkeypatch):
    monkeypatch.setattr(token_files, "_TEXT_BYTES", 10)
    for sizes in ([], [0, 0], [3], [25, 1, 1], [4, 4, 4, 0, 30, 0], [1] * 57):
        texts = pa.array(["x" * n for n in sizes], pa.string())
        runs = list(token_files._shares(texts))
        assert [a + i for a, n in runs for i in range(n)] == list(range(len(sizes)))
        assert all(sum(sizes[a:a + n]) <= 10 + max(sizes) for a, n in runs)


def test_files(spark):
    docs = documents(spark)
    want, at = [], 0
    rows = docs.collect()
    for r in sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0)):
        ids = np.array(PLAIN.encode(r["text"] or "", add_special_tokens=False).ids + [0], "<u4")
        want.append((r["doc_id"], at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, token_index(docs).collect()), key=repr) == sorted(want, key=repr)


def test_no_rows(spark):
    assert token_index(empty(spark)).collect() == []
