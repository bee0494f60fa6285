"""SentencePiece encoding with byte offsets into the original text, and decoding.

The library gives the ids. The offsets come from repeating its normalisation: at each
position the longest key of the model's compiled character map (a double-array trie) is
replaced, anything else is copied, and every normalised byte remembers the original
byte it came from. Pieces are cut from the normalised bytes in order, so those
alignments give each piece its span ``[begin, end)`` in the original UTF-8 text. A
piece that only holds the added leading space has an empty span.

A model whose pieces never hold a space mark after another character cannot merge
across a word start. For such models words are encoded once and kept in a bounded
table; a text with doubled or outer spaces, or with the space mark itself, is encoded
whole. Both ways give the same ids.

Defined results: a NULL text is an empty text, with no ids and the empty decoded text.
Repeated rows each give a row; NULL ids stay NULL; an empty table gives no rows. Only
the id and text columns are read. Very long texts are encoded whole, one at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from ebbtide.llm.textbatches import segments

SPACE = "▁"
MARK = SPACE.encode()


class CharacterMap:
    """The compiled character map of a model: longest-prefix lookup of replacements."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.replacements = blob[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest key at ``at`` and its replacement."""
        units = self.units
        if not units:
            return None
        node = _child_base(units[0])
        best = None
        for length, byte in enumerate(text[at:], start=1):
            unit = units[node ^ byte]
            if unit & 0x800000FF != byte:  # the label of the unit
                break
            node ^= byte ^ _child_base(unit)
            if unit >> 8 & 1:  # a key ends here
                best = length, units[node] & 0x7FFFFFFF
        if best is None:
            return None
        end = self.replacements.index(b"\0", best[1])
        return best[0], self.replacements[best[1] : end]


def _child_base(unit: int) -> int:
    return (unit >> 10) << ((unit & 0x200) >> 6)


class Normaliser:
    """Normalised bytes of a text, and for each of them (and the end) the original byte."""

    def __init__(self, spec):
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix = spec.add_dummy_prefix
        self.squeeze = spec.remove_extra_whitespaces
        self.space = MARK if spec.escape_whitespaces else b" "
        self.plain = not self.map.units and not self.squeeze

    def __call__(self, text: str) -> tuple[bytes, np.ndarray]:
        raw = text.encode()
        if not raw:
            return b"", np.zeros(1, np.int64)
        return self._plain(raw) if self.plain else self._mapped(raw)

    def _plain(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        source = np.frombuffer(raw, np.uint8)
        widths = np.where(source == 0x20, len(self.space), 1)
        align = np.repeat(np.arange(len(raw)), widths)
        head = self.space if self.prefix else b""
        align = np.concatenate([np.zeros(len(head), np.int64), align, [len(raw)]])
        return head + raw.replace(b" ", self.space), align

    def _chunk(self, raw: bytes, at: int) -> tuple[int, bytes]:
        found = self.map.longest(raw, at)
        if found:
            return found
        lead = raw[at]
        width = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return width, raw[at : at + width]

    def _mapped(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        at = 0
        while self.squeeze and at < len(raw):
            width, chunk = self._chunk(raw, at)
            if chunk != b" ":
                break
            at += width
        if at == len(raw):
            return b"", np.array([len(raw)])
        out, align = bytearray(), []
        if self.prefix:
            out += self.space
            align += [at] * len(self.space)
        after_space = self.squeeze
        while at < len(raw):
            width, chunk = self._chunk(raw, at)
            if after_space:
                chunk = chunk.lstrip(b" ")
            if chunk:
                shown = chunk.replace(b" ", self.space)
                out += shown
                align += [at] * len(shown)
                after_space = chunk.endswith(b" ")
            at += width
            if not self.squeeze:
                after_space = False
        if self.squeeze:
            while out.endswith(self.space):
                del out[-len(self.space) :]
                at = align[len(out)]
                del align[len(out) :]
        align.append(at)
        return bytes(out), np.array(align)


class PieceEncoder:
    def __init__(self, model_file: str, most_words: int = 400_000):
        with open(model_file, "rb") as file:
            self._load(file.read(), most_words)

    @classmethod
    def from_bytes(cls, model: bytes, most_words: int = 400_000) -> PieceEncoder:
        self = cls.__new__(cls)
        self._load(model, most_words)
        return self

    def _load(self, model: bytes, most_words: int) -> None:
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        proto = model_pb2.ModelProto()
        proto.ParseFromString(model)
        self.normaliser = Normaliser(proto.normalizer_spec)
        kinds = model_pb2.ModelProto.SentencePiece
        self.byte_fallback = proto.trainer_spec.byte_fallback
        self.widths = np.array(
            [1 if p.type == kinds.BYTE else len(p.piece.encode()) for p in proto.pieces]
        )
        self.by_word = (
            self.normaliser.plain
            and self.normaliser.prefix
            and self.normaliser.space == MARK
            and proto.trainer_spec.model_type == model_pb2.TrainerSpec.BPE
            and self.byte_fallback
            and not any(SPACE in p.piece.lstrip(SPACE) for p in proto.pieces)
            and not any(p.type == kinds.USER_DEFINED for p in proto.pieces)
        )
        self.words: dict[str, bytes] = {}
        self.most_words = most_words

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text."""
        if not self.by_word:
            encoded = self.library.encode(texts, num_threads=1)
            return [np.array(ids, np.int32) for ids in encoded]
        parts = [
            None if SPACE in t or "  " in t or t[:1] == " " or t[-1:] == " " else t.split(" ")
            for t in texts
        ]
        whole = iter(
            self.library.encode(
                [t for t, words in zip(texts, parts) if words is None], num_threads=1
            )
        )
        unknown = {w for words in parts if words is not None for w in words} - self.words.keys()
        if len(self.words) + len(unknown) > self.most_words:
            self.words.clear()
            unknown = {w for words in parts if words is not None for w in words}
        unknown = list(unknown)
        for word, ids in zip(unknown, self.library.encode(unknown, num_threads=1)):
            self.words[word] = np.array(ids, np.int32).tobytes()
        # The empty text is one empty word without ids.
        get = self.words.__getitem__
        return [
            np.array(next(whole), np.int32)
            if words is None
            else np.frombuffer(b"".join(map(get, words)), np.int32)
            for words in parts
        ]

    def spans(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Original byte spans of the pieces ``ids`` of ``text``."""
        normalised, align = self.normaliser(text)
        if self.byte_fallback:
            widths = self.widths[ids]
        else:  # an unknown piece is as wide as its surface
            pieces = self.library.encode(text, out_type=str)
            widths = np.array([len(p.encode()) for p in pieces], np.int64)
        ends = np.cumsum(widths)
        if (int(ends[-1]) if len(ends) else 0) != len(normalised):
            raise ValueError("the pieces do not cover the normalised text")
        return align[ends - widths].astype(np.int32), align[ends].astype(np.int32)

    def decode(self, encoded: list[np.ndarray]) -> list[str]:
        return self.library.decode([ids.tolist() for ids in encoded], num_threads=1)


def encode_pieces(
    docs: DataFrame,
    model_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    slice_chars: int = 1 << 19,
) -> DataFrame:
    """One row per row: id, ids, begins, ends (bytes of the original) and decoded."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(model_file)
        for batch in batches:
            for first, texts in segments(batch.column("text"), slice_chars):
                encoded = encoder.encode(texts)
                spans = [encoder.spans(t, ids) for t, ids in zip(texts, encoded)]
                edges = pa.array(np.cumsum([0, *map(len, encoded)]), pa.int32())

                def lists(arrays, edges=edges):
                    flat = np.concatenate(arrays).astype(np.int32)
                    return pa.ListArray.from_arrays(edges, pa.array(flat))

                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(first, len(texts)),
                        lists(encoded),
                        lists([b for b, _ in spans]),
                        lists([e for _, e in spans]),
                        pa.array(encoder.decode(encoded), pa.string()),
                    ],
                    names=["id", "ids", "begins", "ends", "decoded"],
                )

    schema = f"id {id_type}, ids array<int>, begins array<int>, ends array<int>, decoded string"
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)
