import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
from tokenizers import Tokenizer

from ebbtide.llm.packing import BpeEncoder, Windows, merge_engine, pack
from ebbtide.llm.queries import QUERIES
from tests.conftest import DATA
from tests.llm.helpers import AWKWARD, docs

FILE = public_tokenizers.path("byte_bpe_50k.json")


def library():
    tokenizer = Tokenizer.from_file(FILE)
    tokenizer.encode_special_tokens = True
    return tokenizer


def check_sequences(rows, size):
    """No gap and no overlap in any sequence; returns tokens per sequence."""
    used = defaultdict(int)
    for row in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert row.length > 0 and row.offset == used[row.sequence_id]
        used[row.sequence_id] += row.length
    assert all(0 < n <= size for n in used.values())
    return used


def test_whole_table(spark):
    frame = pd.read_parquet(f"{DATA}/documents.parquet")
    rows = QUERIES["op7_packing"](spark, DATA).collect()
    used = check_sequences(rows, 1024)
    padding = sum(0 if n & (n - 1) == 0 else 1024 - n for n in used.values())
    assert padding <= 0.01 * sum(used.values())
    pieces = defaultdict(list)
    for row in rows:
        pieces[row.doc_id].append(row)
    assert set(pieces) == set(frame.doc_id)
    tokenizer = library()
    encoded = tokenizer.encode_batch([t or "" for t in frame.text], add_special_tokens=False)
    for i, found in zip(frame.doc_id, encoded):
        ids, at = [*found.ids, 0], 0
        for row in sorted(pieces[i], key=lambda r: r.start):
            assert row.start == at and row.doc_tokens == len(ids)
            part = np.array(ids[at : at + row.length], "<u4").tobytes()
            assert row.ids_crc32 == zlib.crc32(part)
            at += row.length
        assert at == len(ids)


def test_awkward_rows_and_merging(spark):
    texts = AWKWARD + [f"short text {i}" for i in range(300)]
    table = docs(spark, texts).repartition(5)
    rows = pack(table, FILE, size=64, open_windows=3, merge_parts=2, slice_chars=100).collect()
    check_sequences(rows, 64)
    total = sum(r.length for r in rows)
    tokenizer = library()
    plain = [t[1] if isinstance(t, tuple) else t for t in texts]
    assert total == sum(
        len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for t in plain
    )
    nothing = [r for r in rows if r.doc_tokens == 1]
    assert len(nothing) == 2 and {bytes(r.ids) for r in nothing} == {b"\0\0\0\0"}
    assert pack(docs(spark, []), FILE).collect() == []


def test_encoder_equals_the_library():
    texts = ["", " ", "a b", "a  b", " a\n b ", "it's\tall  \n\n here", "x　y z  w",
             "<|endoftext|> é\U0001f600 1234 !!! don't", "\x1c a \x85 b",
             "a \n b \nc\t d"]
    tokenizer, encoder, slow = library(), BpeEncoder(FILE, most_words=3), BpeEncoder(FILE)
    assert encoder.engine is not None
    slow.engine = None
    for text in texts:
        expected = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == expected, text
        assert np.frombuffer(slow.encode([text])[0], "<u4").tolist() == expected, text


def test_other_kinds_of_tokenizer_keep_to_the_library():
    assert merge_engine(public_tokenizers.path("word_bpe_49k.json")) is None


def test_windows_are_bounded_and_best_fit():
    windows = Windows(10, most_open=2, least_cut=3, first_id=0)
    assert list(windows.place(7)) == [(0, 0, 7)]
    assert list(windows.place(6)) == [(1, 0, 6)]
    assert list(windows.place(3)) == [(0, 7, 3)]  # fits best, and fills the window
    assert list(windows.place(5)) == [(2, 0, 5)]
    # Nothing fits: the fullest window is filled by a cut, the rest opens a new one.
    assert list(windows.place(8)) == [(1, 6, 4), (2, 5, 4)]
    assert list(windows.place(9)) == [(3, 0, 9)]
    assert list(windows.place(25)) == [(4, 0, 10), (5, 0, 10), (6, 0, 5)]
    assert len(windows.open) <= 2
