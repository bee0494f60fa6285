"""Packing of tokenised documents into training sequences of fixed length.

Bounded-space online packing: while a task reads its documents it keeps a fixed
number of open windows. Stretches that fill a whole sequence leave at once. The rest of
a document goes into the open window that it fills best. When none fits and no new
window may be opened, the fullest one is filled up by cutting the piece (unless less
than ``least_cut`` tokens are free) and emitted. At the end the open windows of
``merge_parts`` partitions meet and their pieces are cut into full sequences, which
leaves one partial sequence per group of partitions.

The tokens are written once to the shared folder, so that merging the few open windows
repeats no tokenisation. Memory per task is ``open_windows`` sequences and one slice of
texts; no key is shuffled except the partition group of open windows.

Defined results: a NULL text is an empty document, which is its end token only.
Repeated rows are packed as often as they occur; NULL ids stay NULL; an empty table
gives no rows. Only the id and text columns are read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ebbtide.llm.textbatches import segments
from ebbtide.session import stored

# A single space between other characters always starts a token of a byte-level BPE
# with the usual word pattern, so the stretches between such spaces are independent.
BOUNDARY = re.compile(r"(?<=\S) (?=\S)")
ODD_SPACE = re.compile(r"\s | \s|^\s|\s$")
MERGED = 1 << 31


# Fixed value: the word pattern of byte-level BPE tokenizers.
WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def byte_characters() -> dict[str, int]:
    """The printable characters by which byte-level vocabularies write bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    table = {chr(b): b for b in shown}
    return table | {chr(256 + i): b for i, b in enumerate(hidden)}


def merge_engine(tokenizer_file: str) -> tiktoken.Encoding | None:
    """The same tokenizer with a faster merge loop.

    None if the file is not a plain byte-level BPE whose ids are in merge order.
    """
    with open(tokenizer_file, encoding="utf-8") as file:
        spec = json.load(file)
    model, words = spec["model"], spec.get("pre_tokenizer") or {}
    if (
        model.get("type") != "BPE"
        or words.get("type") != "ByteLevel"
        or words.get("add_prefix_space")
        or not words.get("use_regex", True)
        or spec.get("normalizer")
        or model.get("ignore_merges")
        or model.get("dropout")
    ):
        return None
    special = {t["content"] for t in spec.get("added_tokens", [])}
    code = byte_characters()
    ranks = {
        bytes(code[c] for c in token): i
        for token, i in model["vocab"].items()
        if token not in special
    }
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    order = [model["vocab"][m] for m in merged]
    if order != sorted(order) or len(ranks) != 256 + len(order):
        return None
    return tiktoken.Encoding("own", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})


class BpeEncoder:
    """Ids as little-endian unsigned 32-bit bytes, those of the ``tokenizers`` library.

    Stretches between single spaces are encoded once and kept in bounded tables. New
    stretches are encoded together, as one text, and its ids are cut at their ends.
    """

    def __init__(self, tokenizer_file: str, most_words: int = 300_000):
        self.library = Tokenizer.from_file(tokenizer_file)
        self.library.encode_special_tokens = True
        self.engine = merge_engine(tokenizer_file)
        if self.engine is not None:
            self.widths = np.zeros(self.engine.n_vocab, np.int64)
            for token in self.engine.token_byte_values():
                self.widths[self.engine.encode_single_token(token)] = len(token)
        self.first: dict[str, bytes] = {}
        self.later: dict[str, bytes] = {}
        self.most_words = most_words

    def _ids(self, texts: list[str]) -> list[bytes]:
        if self.engine is not None:
            found = [self.engine.encode_ordinary(t) for t in texts]
        else:
            batch = self.library.encode_batch_fast(texts, add_special_tokens=False)
            found = [e.ids for e in batch]
        return [np.array(ids, "<u4").tobytes() for ids in found]

    def _unknown(self, table: dict[str, bytes], words: set[str]) -> list[str]:
        unknown = words - table.keys()
        if len(table) + len(unknown) > self.most_words:
            table.clear()
            unknown = words
        return list(unknown)

    def _learn_later(self, words: set[str]) -> None:
        unknown = self._unknown(self.later, words)
        if self.engine is None or not unknown:
            self.later.update(zip(unknown, self._ids([" " + w for w in unknown])))
            return
        ids = np.array(self.engine.encode_ordinary(" " + " ".join(unknown)), "<u4")
        ends = np.cumsum(self.widths[ids])
        limits = np.cumsum([len(w.encode()) + 1 for w in unknown])
        cuts = np.searchsorted(ends, limits)
        if not np.array_equal(ends[cuts], limits):
            raise ValueError("a token crosses the start of a word")
        raw, start = ids.tobytes(), 0
        for word, end in zip(unknown, (4 * cuts + 4).tolist()):
            self.later[word] = raw[start:end]
            start = end

    def encode(self, texts: list[str]) -> list[bytes]:
        parts = [
            BOUNDARY.split(t) if ODD_SPACE.search(t) else t.split(" ") for t in texts
        ]
        heads = self._unknown(self.first, {p[0] for p in parts})
        self.first.update(zip(heads, self._ids(heads)))
        self._learn_later({w for p in parts for w in p[1:]})
        later = self.later.__getitem__
        return [self.first[p[0]] + b"".join(map(later, p[1:])) for p in parts]


class Windows:
    """The open sequences of one task."""

    def __init__(self, size: int, most_open: int, least_cut: int, first_id: int):
        self.size, self.most_open, self.least_cut = size, most_open, least_cut
        self.next_id = first_id
        self.open: dict[int, int] = {}  # sequence to free tokens

    def _new(self) -> int:
        self.next_id += 1
        return self.next_id - 1

    def place(self, length: int) -> Iterator[tuple[int, int, int]]:
        """(sequence, offset, tokens) for every part of a piece, in order."""
        while length >= self.size:
            yield self._new(), 0, self.size
            length -= self.size
        while length:
            fitting = [(free, w) for w, free in self.open.items() if free >= length]
            if fitting:
                free, window = min(fitting)
            elif len(self.open) < self.most_open:
                free, window = self.size, self._new()
            else:
                free, window = min((free, w) for w, free in self.open.items())
                if free < self.least_cut:
                    del self.open[window]
                    continue
            part = min(free, length)
            yield window, self.size - free, part
            length -= part
            if part == free:
                self.open.pop(window, None)
            else:
                self.open[window] = free - part


FIELDS = (
    "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)


def _batch(rows: list[tuple], doc_ids: pa.Array, extra: list[tuple[str, list]]) -> pa.RecordBatch:
    names = ("start", "length", "ids", "doc_tokens", "sequence_id", "offset")
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
    columns = list(zip(*rows)) if rows else [[]] * len(names)
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
    return pa.RecordBatch.from_arrays(
        [doc_ids, *arrays, *(pa.array(values) for _, values in extra)],
        names=["doc_id", *names, *(name for name, _ in extra)],
    )


def pack(
    docs: DataFrame,
    tokenizer_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 1024,
    end_id: int = 0,
    open_windows: int = 32,
    least_cut: int = 16,
    merge_parts: int = 64,
    slice_chars: int = 1 << 20,
) -> DataFrame:
    """One row per piece: id, start, length, ids (little-endian uint32), doc_tokens,
    sequence_id and offset. A document is its ids and then ``end_id``."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encoder = BpeEncoder(tokenizer_file)
        windows = Windows(size, open_windows, least_cut, part << 32)
        waiting: dict[int, list] = {}  # pieces of open windows, with their ids

        def rows_of(found: list, is_open: bool) -> pa.RecordBatch:
            ids = pa.array([doc for doc, _ in found], id_kind)
            return _batch(
                [row for _, row in found],
                ids,
                [("part", [part] * len(found)), ("is_open", [is_open] * len(found))],
            )

        id_kind = None
        for batch in batches:
            id_kind = batch.schema.field("doc_id").type
            doc_ids = batch.column("doc_id").to_pylist()
            for first, texts in segments(batch.column("text"), slice_chars):
                done: list = []
                for at, encoded in enumerate(encoder.encode(texts), start=first):
                    tokens = encoded + end
                    total, start = len(tokens) // 4, 0
                    for window, offset, length in windows.place(total):
                        cut = tokens[4 * start : 4 * (start + length)]
                        row = (start, length, cut, total, window, offset)
                        waiting.setdefault(window, []).append((doc_ids[at], row))
                        start += length
                    for window in [w for w in waiting if w not in windows.open]:
                        done += waiting.pop(window)
                if done:
                    yield rows_of(done, False)
        left = [row for rows in waiting.values() for row in rows]
        if left:
            yield rows_of(left, True)

    schema = f"doc_id {id_type}, {FIELDS}, part long, is_open boolean"
    placed = stored(source.mapInArrow(run, schema), "is_open")

    def merge(table: pa.Table) -> pa.Table:
        table = table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        group = table.column("part")[0].as_py() // merge_parts
        sequence, used = ((group * merge_parts) << 32) + MERGED, 0
        rows, owners = [], []
        for at, row in enumerate(
            table.select(["start", "length", "ids", "doc_tokens"]).to_pylist()
        ):
            done = 0
            while done < row["length"]:
                part = min(size - used, row["length"] - done)
                cut = row["ids"][4 * done : 4 * (done + part)]
                rows.append(
                    (row["start"] + done, part, cut, row["doc_tokens"], sequence, used)
                )
                owners.append(at)
                done, used = done + part, used + part
                if used == size:
                    sequence, used = sequence + 1, 0
        ids = table.column("doc_id").combine_chunks().take(pa.array(owners, pa.int64()))
        return pa.Table.from_batches([_batch(rows, ids, [])])

    columns = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    full = placed.filter(~F.col("is_open")).select(columns)
    left = placed.filter("is_open").select(*columns, "part")
    merged = left.groupBy((F.col("part") / merge_parts).cast("long")).applyInArrow(
        merge, f"doc_id {id_type}, {FIELDS}"
    )
    return full.unionByName(merged).withColumnRenamed("doc_id", id_col)


def padded(used, size: int = 1024):
    """Length of a sequence of ``used`` tokens in training: a power of two stays."""
    power = F.bit_count(used) == 1
    return F.when(power & (used <= size), used).otherwise(F.lit(size))
