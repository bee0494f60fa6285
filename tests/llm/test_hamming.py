import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.llm.hamming import MultiIndex, nearest_codes, sign_code

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("code", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("part", T.StringType()),
    ]
)


def brute(rows, queries, k):
    out = set()
    for q, v in queries:
        near = sorted(
            {(int(np.sum((np.array(v) > 0) != (np.array(w) > 0))), i) for i, w in rows if i != q}
        )
        out |= {(q, i, d, place) for place, (d, i) in enumerate(near[:k], start=1)}
    return out


@pytest.mark.parametrize("blocks", [(1 << 18, 1 << 17), (40, 7)])
def test_equals_brute_force(spark, blocks):
    random = np.random.default_rng(3)
    vectors = random.normal(size=(150, 32)).astype("f4")
    vectors[30:90] = vectors[0]  # many rows share a code
    vectors[90:100] = -vectors[0]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    table = spark.createDataFrame([(*r, "c", "i", "p") for r in rows] * 2, SCHEMA)
    found = nearest_codes(
        table, F.col("vec_id") % 10 == 0, k=4, bits=32, index_block=blocks[0], query_block=blocks[1]
    ).collect()
    assert len(found) == len(set(found))
    assert {tuple(r) for r in found} == brute(rows, rows[::10], 4)


def test_awkward_rows(spark):
    rows = [
        (0, None),
        (None, [1.0] * 16),
        (1, [1.0] * 16),
        (2, [float("nan")] * 16),
        (3, []),
        (4, [None, 1.0]),
    ]
    table = spark.createDataFrame([(*r, "c", "i", "p") for r in rows], SCHEMA)
    found = nearest_codes(table, F.lit(True), k=10, bits=16).collect()
    assert {(r.query_id, r.neighbor_id, r.distance) for r in found} == {
        (1, 2, 16), (1, 3, 16), (1, 4, 15), (2, 1, 16), (2, 3, 0), (2, 4, 1),
        (3, 1, 16), (3, 2, 0), (3, 4, 1), (4, 1, 15), (4, 2, 1), (4, 3, 1),
    }
    empty = spark.createDataFrame([], SCHEMA)
    assert nearest_codes(empty, F.lit(True)).collect() == []
    code = spark.createDataFrame([(1, [1.0] + [-1.0] * 15, "", "", "")], SCHEMA)
    assert bytes(code.select(sign_code(F.col("embedding"), 16)).first()[0]) == b"\x80\x00"


def test_search_stops_only_when_covered():
    random = np.random.default_rng(5)
    codes = random.integers(0, 1 << 16, size=(3000, 4), dtype=np.uint16)
    index = MultiIndex(codes, np.arange(3000))
    queries = np.concatenate([codes[:20] ^ np.uint16(3), random.integers(0, 1 << 16, size=(20, 4), dtype=np.uint16)])
    for places, distances, ids in index.search(queries, 5, most_pairs=40_000):
        for q in set(places.tolist()):
            full = np.bitwise_count(queries[q] ^ codes).sum(axis=1)
            best = sorted(zip(full.tolist(), range(3000)))[:5]
            mine = places == q
            assert list(zip(distances[mine].tolist(), ids[mine].tolist())) == best
