"""Exact top-k search in binary codes by incremental multi-index hashing.

Codes are cut into 16-bit segments with one table each. A search grows the radius, one
segment after the other: it probes all segment values at the next distance and verifies
what it finds on the full codes. A code that is still missing after segment ``j`` was
searched up to radius ``r`` (of ``s`` segments) differs in more than ``s * r + j``
bits, so a query is done as soon as ``k`` verified distances are within that bound.

The stated queries meet all codes in blocks: a task gets one block of the index and one
block of queries, both of bounded size, builds the tables of its index block and
returns the ``k`` best of it for each query; the best of all blocks are merged by a
ranking that is limited before its shuffle. Of a code that very many rows share only the
``k + 1`` rows with the smallest ids can ever be returned, so only they are indexed, and
queries with one code are searched once.

Defined results: neighbours are ordered by distance and then id, and a row is never its
own neighbour; fewer than ``k`` rows are returned only if there are no more. A NULL
vector has no code: it is neither found nor has results. NULL, NaN and missing elements
give the bit 0. Rows with NULL ids are left out. Repeated rows (same id and code) count
once. An empty table gives no rows. Only the id and the vector column are read.
"""

from __future__ import annotations

from itertools import combinations
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.session import stored

SEGMENT_BITS = 16


def sign_code(vector: Column, bits: int) -> Column:
    """Binary code of ``bits`` (a multiple of 16) bits: 1 where the element is positive."""

    def segment(first: int) -> Column:
        marks = F.array_join(
            F.transform(
                F.sequence(F.lit(first), F.lit(first + SEGMENT_BITS - 1)),
                lambda i: F.when(
                    (F.get(vector, i) > 0) & ~F.isnan(F.get(vector, i)), "1"
                ).otherwise("0"),
            ),
            "",
        )
        return F.lpad(F.conv(marks, 2, 16), SEGMENT_BITS // 4, "0")

    code = F.unhex(F.concat(*(segment(i) for i in range(0, bits, SEGMENT_BITS))))
    return F.when(vector.isNotNull(), code)


def shells(bits: int = SEGMENT_BITS):
    """Segment masks by number of set bits."""
    for ones in range(bits + 1):
        yield np.array(
            [sum(1 << b for b in places) for places in combinations(range(bits), ones)],
            np.uint32,
        )


class MultiIndex:
    """Segment tables over one block of codes; ``codes`` is (rows, segments) uint16."""

    def __init__(self, codes: np.ndarray, ids: np.ndarray):
        self.codes, self.ids = codes, ids
        self.tables = []
        for segment in codes.T:
            order = np.argsort(segment, kind="stable")
            edges = np.searchsorted(segment[order], np.arange((1 << SEGMENT_BITS) + 1))
            self.tables.append((order, edges))

    def search(self, queries: np.ndarray, k: int, most_pairs: int = 1 << 21):
        """(query place, distance, id) of the ``k`` nearest of every query."""
        step = max(1, most_pairs // max(1, len(self.codes)))
        for first in range(0, len(queries), step):
            yield from self._few(queries[first : first + step], first, k)

    def _few(self, queries: np.ndarray, first: int, k: int):
        segments = self.codes.shape[1]
        active = np.arange(len(queries))
        found = [np.zeros((3, 0), np.int64)]
        wanted = min(k, len(self.codes))
        for radius, masks in enumerate(shells()):
            for place in range(segments):
                found.append(self._probe(queries, active, place, radius, masks))
                covered = segments * radius + place
                near = np.concatenate([f[0][f[1] <= covered] for f in found])
                done = np.bincount(near, minlength=len(queries)) >= wanted
                active = active[~done[active]]
                if not len(active):
                    break
            if not len(active):
                break
        query, distance, ids = np.concatenate(found, axis=1)
        order = np.lexsort((ids, distance, query))
        query, distance, ids = query[order], distance[order], ids[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        best = rank < k
        yield query[best] + first, distance[best], ids[best]

    def _probe(self, queries, active, place, radius, masks) -> np.ndarray:
        order, edges = self.tables[place]
        probes = queries[active, place].astype(np.uint32)[:, None] ^ masks[None, :]
        starts, ends = edges[probes].ravel(), edges[probes + 1].ravel()
        sizes = ends - starts
        owner = np.repeat(np.repeat(active, len(masks)), sizes)
        offsets = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        rows = order[np.repeat(starts, sizes) + offsets]
        parts = np.bitwise_count(queries[owner] ^ self.codes[rows])
        # Found before, by another segment or at a smaller radius there: skip.
        earlier = (parts[:, :place] <= radius).any(axis=1) | (
            parts[:, place + 1 :] <= radius - 1
        ).any(axis=1)
        new = ~earlier
        distance = parts.sum(axis=1, dtype=np.int64)
        return np.stack([owner[new], distance[new], self.ids[rows[new]]])


def _codes(column: pa.ChunkedArray, segments: int) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, ">u2").reshape(-1, segments).astype(np.uint16)


def nearest_codes(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    bits: int = 64,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    index_block: int = 1 << 18,
    query_block: int = 1 << 17,
) -> DataFrame:
    """query_id, neighbor_id, distance and rank of the ``k`` nearest rows of each query.

    ``is_query`` is a condition on the columns of ``vectors``.
    """
    coded = stored(
        vectors.select(
            F.col(id_col).cast("long").alias("id"),
            sign_code(F.col(vector_col), bits).alias("code"),
            is_query.alias("asked"),
        ).filter("id IS NOT NULL AND code IS NOT NULL")
    )
    rank = F.row_number().over(Window.partitionBy("code").orderBy("id"))
    members = stored(
        coded.groupBy("id", "code")
        .agg(F.max("asked").alias("asked"))
        .withColumn("place", rank)
        .filter(F.col("place") <= k + 1)
        .select("id", "code")
    )
    asked = coded.filter("asked").select("id", "code").distinct()
    questions = stored(asked.select("code").distinct())
    parts = max(1, ceil(members.count() / index_block))
    batches = max(1, ceil(questions.count() / query_block))

    def block(count: int) -> Column:
        return F.pmod(F.xxhash64("code"), F.lit(count))

    def numbers(count: int) -> Column:
        return F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))

    index_side = members.select(
        "id",
        "code",
        block(parts).alias("part"),
        F.explode(numbers(batches)).alias("batch"),
    )
    query_side = questions.select(
        F.col("code").alias("query_code"),
        F.explode(numbers(parts)).alias("part"),
        block(batches).alias("batch"),
    )
    segments = bits // SEGMENT_BITS

    def search(entries: pa.Table, queries: pa.Table) -> pa.Table:
        names = ["query_code", "neighbor_id", "distance"]
        kinds = [pa.binary(), pa.int64(), pa.int64()]
        if not entries.num_rows or not queries.num_rows:
            return pa.table([pa.array([], kind) for kind in kinds], names=names)
        index = MultiIndex(
            _codes(entries.column("code"), segments),
            entries.column("id").to_numpy(),
        )
        places, distances, ids = zip(
            *index.search(_codes(queries.column("query_code"), segments), k + 1)
        )
        chosen = queries.column("query_code").combine_chunks().take(
            pa.array(np.concatenate(places))
        )
        return pa.table(
            [chosen, pa.array(np.concatenate(ids)), pa.array(np.concatenate(distances))],
            names=names,
        )

    best = (
        index_side.groupBy("part", "batch")
        .cogroup(query_side.groupBy("part", "batch"))
        .applyInArrow(search, "query_code binary, neighbor_id long, distance long")
    )
    by_code = Window.partitionBy("query_code").orderBy("distance", "neighbor_id")
    merged = best.withColumn("place", F.row_number().over(by_code)).filter(
        F.col("place") <= k + 1
    )
    by_query = Window.partitionBy("query_id").orderBy("distance", "neighbor_id")
    return (
        asked.select(F.col("id").alias("query_id"), F.col("code").alias("query_code"))
        .join(merged.drop("place"), "query_code")
        .filter("query_id <> neighbor_id")
        .withColumn("rank", F.row_number().over(by_query))
        .filter(F.col("rank") <= k)
        .select("query_id", "neighbor_id", "distance", F.col("rank").cast("long"))
    )
