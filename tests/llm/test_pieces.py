import hashlib

import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from ebbtide.llm.pieces import PieceEncoder, encode_pieces
from ebbtide.llm.queries import QUERIES
from tests.conftest import DATA
from tests.llm.helpers import AWKWARD, LONG, docs

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "",
    " ",
    "a",
    "two  spaces inside",
    " outer ",
    "tab\tand\nlines\r\n",
    "▁mark ▁▁",
    "café \U0001f600 你好",
    "x" * 3000,
    " wide　space",
    "ﬁ ligature ① Ａ",
    "À combining é",
]


def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def variant(rule: str, **settings) -> bytes:
    """The model with another normalisation rule."""
    proto = model_pb2.ModelProto()
    proto.ParseFromString(open(MODEL, "rb").read())
    charsmap = model_pb2.ModelProto()
    normaliser = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    charsmap.ParseFromString(normaliser.serialized_model_proto())
    proto.normalizer_spec.precompiled_charsmap = charsmap.normalizer_spec.precompiled_charsmap
    for name, value in settings.items():
        setattr(proto.normalizer_spec, name, value)
    return proto.SerializeToString()


def test_whole_table_equals_the_library(spark):
    frame = pd.read_parquet(f"{DATA}/documents.parquet")
    sp = library()
    expected = {}
    for i, text in zip(frame.doc_id, frame.text):
        ids = sp.encode(text or "")
        expected[i] = (
            len(ids),
            hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(sp.decode(ids).encode()).hexdigest(),
        )
    rows = QUERIES["op6_sentencepiece"](spark, DATA).collect()
    assert {r[0]: tuple(r[1:]) for r in rows} == expected
    assert len(rows) == len(frame)


def test_awkward_rows(spark):
    sp = library()
    rows = encode_pieces(docs(spark, AWKWARD), MODEL, slice_chars=50).collect()
    texts = [(a if isinstance(a, tuple) else (i, a)) for i, a in enumerate(AWKWARD)]
    expected = sorted((repr(i), sp.encode(t or "")) for i, t in texts)
    assert sorted((repr(r.doc_id), r.ids) for r in rows) == expected
    assert any(len(r.ids) > 50_000 for r in rows) and len(LONG) > 500_000
    assert encode_pieces(docs(spark, []), MODEL).collect() == []


def test_a_small_word_table_changes_nothing():
    encoder = PieceEncoder(MODEL, most_words=2)
    assert encoder.by_word
    for text in TEXTS:
        assert encoder.encode([text])[0].tolist() == library().encode(text)


@pytest.mark.parametrize(
    "model",
    [
        open(MODEL, "rb").read(),
        variant("nmt_nfkc"),
        variant("nmt_nfkc_cf", remove_extra_whitespaces=True),
        variant("nfkc", add_dummy_prefix=False),
        variant("identity", escape_whitespaces=False),
    ],
)
def test_spans_equal_those_of_the_library(model):
    encoder = PieceEncoder.from_bytes(model)
    for text in TEXTS:
        ids = encoder.encode([text])[0]
        assert ids.tolist() == encoder.library.encode(text)
        begins, ends = encoder.spans(text, ids)
        proto = encoder.library.encode(text, return_type="proto")
        for piece, begin, end in zip(proto.pieces, begins.tolist(), ends.tolist()):
            if encoder.library.is_byte(piece.id):
                # Here every byte has its own span; the library gives all to the last one.
                assert piece.begin <= begin <= end <= max(piece.end, begin + 1)
            else:
                assert (begin, end) == (piece.begin, piece.end), (text, piece)
