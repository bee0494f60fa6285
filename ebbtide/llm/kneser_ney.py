"""Text quality by perplexity under a modified Kneser-Ney n-gram model.

An interpolated modified Kneser-Ney model over characters is trained on all trusted
texts. Its tables stay distributed: counts, continuation counts and context sums are
aggregations, each order takes the next lower one by a join.

Interpolation is brought into a sum. With ``B`` the interpolated probability, for every
n-gram ``h w`` (``h'`` is ``h`` without its first sign)::

    log B(w | h) = gamma(h) + log B(w | h') + delta(h w)

where ``delta`` is 0 for n-grams and ``gamma`` for contexts outside the model. The log
probability of a text is therefore a sum of one weight per n-gram occurrence and order. An
n-gram and all its suffixes of two signs or more end in the same two signs; those signs
choose the shard. Texts are reduced to their distinct n-grams and counts, in
compressed blocks per shard, and each shard of counts is joined to its shard of weights;
the sums per text are then added up. Neither texts nor the model are collected or
broadcast; only discounts and totals (a few numbers per order) reach the driver. A
block covers a bounded number of signs and a group of blocks a bounded number of scan
partitions, so a frequent n-gram, text or source makes no large group.

A text is kept if its log perplexity is near the median of its language, on either side.
The distance is measured in median distances of the language, after both are multiplied by
the root of the number of signs (``most_signs`` at most), as the mean of a short text varies
more. The largest distance is a quantile over the texts of all languages, so a few odd
trusted texts do not open a language. One in ``holdout`` trusted texts, chosen by the hash
of its id, is not trained on; only those set the limits, so a limit is fair to texts that
the model has not seen. Texts that it was trained on have too low a perplexity, so the lower
side holds for all others only.

Defined results: a NULL text is empty, which is the end sign only. The signs U+0000,
U+0002 and U+0003 are read as U+FFFD. A NULL language counts as "". A language with
under ``least_texts`` held-out texts takes the median of all held-out texts, one with under
``least_spread`` the median distance of all. Without trusted texts there is no
model: perplexities and limits are NULL and all texts are kept. Rows, repeated ones too,
are scored one by one; trusted ids are taken once per row that has them; NULL ids are
never trusted. An empty table gives no rows. Only the id, text and language columns are
read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.minhash import rows_with_ids, scrambled
from ebbtide.llm.textbatches import release_memory, segments, unpacked_texts
from ebbtide.session import stored

START, END, OTHER = "\x02", "\x03", "�"
BLOCK_CHARS = 1 << 20
GROUP_CHARS = 1 << 28
SHARDS = 8


def _signs(text: str | None) -> np.ndarray:
    signs = np.frombuffer((text or "").encode("utf-32-le"), np.uint32)
    special = (signs == 0) | (signs == ord(START)) | (signs == ord(END))
    return np.where(special, np.uint32(ord(OTHER)), signs) if special.any() else signs


def blocks(texts: list[str | None], order: int) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Places of texts and their signs with start and end signs, up to BLOCK_CHARS
    together. A longer text is cut into several blocks that overlap by a context."""
    head = np.full(order - 1, ord(START), np.uint32)
    tail = np.array([ord(END)], np.uint32)
    places, parts, size = [], [], 0
    for place, text in enumerate(texts):
        signs = np.concatenate([head, _signs(text), tail])
        for first in range(0, len(signs) - order + 1, BLOCK_CHARS):
            part = signs[first : first + BLOCK_CHARS + order - 1]
            if parts and size + len(part) > BLOCK_CHARS:
                yield places, parts
                places, parts, size = [], [], 0
            places.append(place)
            parts.append(part)
            size += len(part)
    if parts:
        yield places, parts


def column_blocks(column: pa.Array, order: int) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    for first, texts in segments(column, 2 * BLOCK_CHARS):
        for places, parts in blocks(texts, order):
            yield [first + p for p in places], parts


def gram_counts(parts: list[np.ndarray], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (n-gram, text) pairs of a block: n-gram signs, place of the text, count.

    Sorted by n-gram and then text.
    """
    joined = np.concatenate(parts)
    letters, codes = np.unique(joined, return_inverse=True)
    bits = max(1, int(len(letters) - 1).bit_length())
    owner_bits = max(1, int(len(parts) - 1).bit_length())
    if order * bits + owner_bits > 63:
        if len(parts) > 1:  # halves have fewer letters and texts
            middle = len(parts) // 2
            left = gram_counts(parts[:middle], order)
            signs, owner, count = gram_counts(parts[middle:], order)
            both = [np.concatenate(x) for x in zip(left, (signs, owner + middle, count))]
            by = np.lexsort((both[1], *both[0].T[::-1]))
            return both[0][by], both[1][by], both[2][by]
        windows = np.lib.stride_tricks.sliding_window_view(joined, order)
        signs, count = np.unique(windows, axis=0, return_counts=True)
        return signs, np.zeros(len(signs), np.int64), count
    codes = codes.astype(np.int64)
    keys = np.zeros(len(codes) - order + 1, np.int64)
    for i in range(order):
        keys = (keys << bits) | codes[i : i + len(keys)]
    lengths = np.array([len(p) for p in parts])
    owners = np.repeat(np.arange(len(parts)), lengths)[: len(keys)]
    ends = np.cumsum(lengths)
    inside = np.arange(len(keys)) + order <= ends[owners]
    pairs, count = np.unique(keys[inside] << owner_bits | owners[inside], return_counts=True)
    owner = pairs & ((1 << owner_bits) - 1)
    grams = pairs >> owner_bits
    mask = (1 << bits) - 1
    signs = np.stack([letters[grams >> bits * (order - 1 - i) & mask] for i in range(order)], 1)
    return signs, owner, count


def _strings(signs: np.ndarray) -> list[str]:
    order = signs.shape[1]
    return np.ascontiguousarray(signs).view(f"<U{order}").ravel().tolist()


def train(texts: DataFrame, order: int) -> DataFrame | None:
    """The weights (gram, weight) of the model of ``texts`` (a column text, packed or not).

    The row with the empty gram has the weight of an unknown sign. None without texts.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, parts in column_blocks(unpacked_texts(batch.column("text")), order):
                signs, _, counts = gram_counts(parts, order)
                new = np.ones(len(signs), bool)
                new[1:] = (signs[1:] != signs[:-1]).any(axis=1)
                starts = np.flatnonzero(new)
                totals = np.add.reduceat(counts, starts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_strings(signs[starts])), pa.array(totals)], names=["gram", "c"]
                )

    highest = texts.select("text").mapInArrow(count, "gram string, c long")
    tables = {order: stored(highest.groupBy("gram").agg(F.sum("c").alias("c")))}
    for k in range(order - 1, 0, -1):
        # Below the highest order a count is the number of different signs before; at
        # the start of a text nothing else can stand before, and the plain count stays.
        suffix = F.substring("gram", 2, k)
        before = F.when(F.col("gram").startswith(START) & suffix.startswith(START), F.col("c"))
        tables[k] = stored(
            tables[k + 1]
            .groupBy(suffix.alias("gram"))
            .agg(F.sum(F.coalesce(before, F.lit(1))).alias("c"))
        )
    types = tables[1].count()
    if not types:
        return None
    lower: DataFrame | None = None
    weights: DataFrame | None = None
    for k in range(1, order + 1):
        discounts = _discounts(tables[k])
        taken = F.element_at(F.array(*map(F.lit, discounts)), F.least("c", F.lit(3)).cast("int"))
        rows = tables[k].select(
            "gram",
            F.substring("gram", 1, k - 1).alias("context"),
            F.substring("gram", 2, k - 1).alias("suffix"),
            (F.col("c") - taken).alias("rest"),
            "c",
            taken.alias("taken"),
        )
        contexts = stored(
            rows.groupBy("context").agg(F.sum("c").alias("total"), F.sum("taken").alias("given"))
        ).select(
            "context", "total", F.greatest(F.col("given") / F.col("total"), F.lit(1e-12)).alias("share")
        )
        if k == 1:
            first = contexts.first()
            unknown = first.share / (types + 1)
            probability = F.col("rest") / first.total + unknown
            lower = stored(rows.select("gram", probability.alias("p")))
            own = lower.select("gram", F.log("p").alias("weight")).unionByName(
                lower.limit(1).select(F.lit("").alias("gram"), F.lit(math.log(unknown)).alias("weight"))
            )
        else:
            below = lower.select(F.col("gram").alias("suffix"), F.col("p").alias("q"))
            joined = rows.join(contexts, "context").join(below, "suffix")
            mixed = F.col("share") * F.col("q")
            lower = stored(
                joined.select(
                    "gram",
                    (F.col("rest") / F.col("total") + mixed).alias("p"),
                    mixed.alias("from_below"),
                )
            )
            own = lower.select("gram", F.log(F.col("p") / F.col("from_below")).alias("weight"))
            own = own.unionByName(
                contexts.select(F.col("context").alias("gram"), F.log("share").alias("weight"))
            )
        weights = own if weights is None else weights.unionByName(own)
    return stored(weights.groupBy("gram").agg(F.sum("weight").alias("weight")))


def _discounts(table: DataFrame) -> list[float]:
    """Discounts for counts 1, 2 and 3 or more, from the numbers of small counts."""
    n = table.agg(*(F.count(F.when(F.col("c") == i, 1)) for i in range(1, 5))).first()
    if min(n) == 0:
        return [0.5, 1.0, 1.5]
    y = n[0] / (n[0] + 2 * n[1])
    found = [i + 1 - (i + 2) * y * n[i + 1] / n[i] for i in range(3)]
    return [min(max(d, 0.0), i + 1.0) for i, d in enumerate(found)]


def _hashed(signs: np.ndarray) -> np.ndarray:
    """64-bit hashes of rows of signs; rows of different width differ."""
    mixed = np.full(len(signs), np.uint64(signs.shape[1]))
    for column in signs.T:
        mixed = scrambled(mixed * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64))
    return mixed


def _shard_of(signs: np.ndarray) -> np.ndarray:
    return (_hashed(signs[:, -2:]) % np.uint64(SHARDS)).astype(np.int64)


def _packed(array: np.ndarray, level: int = 1) -> bytes:
    return pa.Codec("zstd", compression_level=level).compress(array.tobytes(), asbytes=True)


def _planes(numbers: np.ndarray) -> np.ndarray:
    """The bytes of small numbers, all lowest ones first: they compress best."""
    return numbers.astype("<u4").view("u1").reshape(-1, 4).T.copy()


def _from_planes(data: bytes, size: int) -> np.ndarray:
    return _unpacked(data, 4 * size, "u1").reshape(4, -1).T.copy().view("<u4").ravel()


def _unpacked(data: bytes, size: int, kind) -> np.ndarray:
    raw = pa.decompress(data, decompressed_size=size * np.dtype(kind).itemsize, codec="zstd")
    return np.frombuffer(raw, kind)


COUNTS = (
    "shard long, grp long, row long, texts long, grams long, pairs long, signs binary, "
    "sizes binary, owners binary, counts binary, ids array<long>, langs array<string>, "
    "lengths array<long>"
)


def _count_blocks(docs: DataFrame, order: int, groups: int) -> DataFrame:
    """Compressed n-gram counts per block and shard; shard 0 also names the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, langs = (batch.column(c).to_pylist() for c in ("id", "lang"))
            for places, parts in column_blocks(batch.column("text"), order):
                signs, owner, count = gram_counts(parts, order)
                shard = _shard_of(signs)
                out = []
                for s in range(SHARDS):
                    mine = shard == s
                    own, who = signs[mine], owner[mine]
                    new = np.ones(len(own), bool)
                    new[1:] = (own[1:] != own[:-1]).any(axis=1)
                    starts = np.flatnonzero(new)
                    # Texts of one n-gram ascend, so differences are small.
                    steps = np.diff(who, prepend=0)
                    steps[starts] = who[starts]
                    out.append(
                        {
                            "shard": s,
                            "grp": part % groups,
                            "row": (part << 40) + row + places[0],
                            "texts": len(places),
                            "grams": len(starts),
                            "pairs": len(own),
                            "signs": _packed(np.ascontiguousarray(own[starts].T), 9),
                            "sizes": _packed(_planes(np.diff(starts, append=len(own)))),
                            "owners": _packed(_planes(steps)),
                            "counts": _packed(_planes(count[mine])),
                            "ids": [ids[p] for p in places] if s == 0 else None,
                            "langs": [langs[p] for p in places] if s == 0 else None,
                            "lengths": [len(p) - order + 1 for p in parts] if s == 0 else None,
                        }
                    )
                yield pa.RecordBatch.from_pylist(out, BLOCK_SCHEMA)
            row += batch.num_rows

    return docs.mapInArrow(run, COUNTS)


BLOCK_SCHEMA = pa.schema(
    [(n, pa.int64()) for n in ("shard", "grp", "row", "texts", "grams", "pairs")]
    + [(n, pa.binary()) for n in ("signs", "sizes", "owners", "counts")]
    + [("ids", pa.list_(pa.int64())), ("langs", pa.list_(pa.string())), ("lengths", pa.list_(pa.int64()))]
)


class Weights:
    """The weights of one shard, by the hash of the n-gram."""

    def __init__(self, grams: list[str], weights: np.ndarray, order: int):
        signs = np.array(grams, f"<U{order}").view(np.uint32).reshape(len(grams), order)
        lengths = np.array([len(g) for g in grams], np.int64)
        self.unknown = float(weights[lengths == 0].sum())
        self.tables = {}
        for k in range(1, order + 1):
            mine = lengths == k
            hashes = _hashed(signs[mine, :k])
            by = np.argsort(hashes)
            self.tables[k] = hashes[by], weights[mine][by]

    def of(self, signs: np.ndarray) -> np.ndarray:
        """Summed weights of rows of signs and of all their suffixes."""
        total = np.zeros(len(signs))
        for k, (hashes, weights) in self.tables.items():
            if k == 1:
                total += self.unknown
            if not len(hashes):
                continue
            wanted = _hashed(signs[:, -k:])
            at = np.minimum(np.searchsorted(hashes, wanted), len(hashes) - 1)
            known = hashes[at] == wanted
            total += np.where(known, weights[at], 0.0)
            if k == 1:
                total[known] -= self.unknown
        return total


def log_probabilities(docs: DataFrame, weights: DataFrame, order: int) -> DataFrame:
    """id, lang, signs (with the end sign) and log_prob of every row of ``docs``
    (id, lang, text)."""
    chars = docs.agg(F.sum(F.char_length("text"))).first()[0] or 0
    groups = max(1, math.ceil(chars / GROUP_CHARS))
    counts = _count_blocks(docs, order, groups)

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = batch.column("gram").to_pylist()
            ends = np.array([g[-2:].rjust(2, "\0") for g in grams], "<U2")
            found = _shard_of(ends.view(np.uint32).reshape(len(grams), 2))
            short = np.array([len(g) < 2 for g in grams])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.where(short, -1, found))],
                names=["gram", "weight", "shard"],
            )

    # Single signs are at most as many as there are code points: every shard has them.
    placed = weights.mapInArrow(shard, "gram string, weight double, shard long")
    shards = F.sequence(F.lit(0).cast("long"), F.lit(SHARDS - 1).cast("long"))
    model = placed.select(
        "gram",
        "weight",
        F.explode(F.when(F.col("shard") < 0, shards).otherwise(F.array("shard"))).alias("shard"),
    ).select(
        "*",
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("grp"),
    )

    def score(texts: pa.Table, own: pa.Table) -> pa.Table:
        table = Weights(
            own.column("gram").to_pylist(), own.column("weight").to_numpy(), order
        )
        out = []
        for block in texts.to_batches(max_chunksize=16):
            for x in block.to_pylist():
                signs = _unpacked(x["signs"], x["grams"] * order, np.uint32)
                sizes = _from_planes(x["sizes"], x["grams"])
                steps, count = (_from_planes(x[c], x["pairs"]) for c in ("owners", "counts"))
                weight = np.repeat(table.of(signs.reshape(order, -1).T), sizes)
                walked = np.cumsum(steps.astype(np.int64))
                starts = np.cumsum(sizes) - sizes
                base = walked[starts] - steps[starts] if len(starts) else walked
                owner = walked - np.repeat(base, sizes)
                sums = np.bincount(owner, weights=weight * count, minlength=x["texts"])
                nothing = [None] * x["texts"]
                out.append(
                    pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.arange(x["row"], x["row"] + x["texts"])),
                            pa.array(x["ids"] or nothing, pa.int64()),
                            pa.array(x["langs"] or nothing, pa.string()),
                            pa.array(x["lengths"] or nothing, pa.int64()),
                            pa.array(sums.astype(np.float64)),
                        ],
                        names=["row", "id", "lang", "signs", "log_prob"],
                    )
                )
        release_memory()
        return pa.Table.from_batches(out, SCORED)

    sums = (
        counts.groupBy("shard", "grp")
        .cogroup(model.groupBy("shard", "grp"))
        .applyInArrow(score, "row long, id long, lang string, signs long, log_prob double")
    )
    starts = F.col("gram").isin(*(START * k for k in range(1, order)))
    at_start = weights.filter(starts).agg(F.sum("weight")).first()[0] or 0.0
    return (
        sums.groupBy("row")
        .agg(
            F.max("id").alias("id"),
            F.max("lang").alias("lang"),
            F.sum("signs").alias("signs"),
            F.sum("log_prob").alias("log_prob"),
        )
        .select("id", "lang", "signs", (F.col("log_prob") + at_start).alias("log_prob"))
    )


SCORED = pa.schema(
    [
        ("row", pa.int64()),
        ("id", pa.int64()),
        ("lang", pa.string()),
        ("signs", pa.int64()),
        ("log_prob", pa.float64()),
    ]
)


def quality(
    docs: DataFrame,
    trusted: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    order: int = 4,
    quantile: float = 0.99,
    holdout: int = 5,
    most_signs: int = 1000,
    least_texts: int = 5,
    least_spread: int = 30,
) -> DataFrame:
    """One row per row: id, lang, perplexity, threshold (the highest perplexity for the
    language and length), lowest (the lowest one) and kept.

    ``trusted`` has the ids (``id_col``) of the texts to train on.
    """
    source = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(lang_col), F.lit("")).alias("lang"),
        F.col(text_col).alias("text"),
    )
    ids = stored(trusted.select(F.col(id_col).cast("long").alias("id")).na.drop().distinct())
    held_out = F.pmod(F.xxhash64("id"), F.lit(holdout)) == 0
    known = rows_with_ids(source.select("id", "text"), ids.filter(~held_out), packed=True)
    weights = train(known, order)
    if weights is None:
        nothing = F.lit(None).cast("double")
        return source.select(
            F.col("id").alias(id_col),
            "lang",
            nothing.alias("perplexity"),
            nothing.alias("threshold"),
            nothing.alias("lowest"),
            F.lit(True).alias("kept"),
        )
    scored = log_probabilities(source, weights, order)
    scored = stored(
        scored.select(
            "id",
            "lang",
            (-F.col("log_prob") / F.col("signs")).alias("x"),
            F.sqrt(F.least("signs", F.lit(most_signs))).alias("root"),
        )
    )
    good = stored(scored.join(ids.filter(held_out), "id", "left_semi"))

    def median(value: Column, rows: DataFrame, least: int) -> tuple[float | None, DataFrame]:
        """The median of all rows, and those of the languages with enough of them."""
        half = F.percentile_approx(value, 0.5, 100_000)
        by_lang = rows.groupBy("lang").agg(half.alias("own"), F.count(value).alias("n"))
        return rows.agg(half).first()[0], by_lang.filter(F.col("n") >= least).drop("n")

    def placed(rows: DataFrame, found: tuple[float | None, DataFrame], name: str) -> DataFrame:
        every, by_lang = found
        value = F.coalesce("own", F.lit(every).cast("double")).alias(name)
        return rows.join(by_lang, "lang", "left").select(*rows.columns, value)

    away = F.abs(F.col("x") - F.col("middle")) * F.col("root")
    middles = median(F.col("x"), good, least_texts)
    spreads = median(away, placed(good, middles, "middle"), least_spread)
    reach = F.percentile_approx(F.try_divide(away, F.col("spread")), quantile, 100_000)
    furthest = placed(placed(good, middles, "middle"), spreads, "spread").agg(reach).first()[0]
    furthest = math.inf if furthest is None else furthest
    most = F.lit(furthest) * F.col("spread")
    width = F.coalesce(most / F.col("root"), F.lit(math.inf))
    middle = F.coalesce("middle", F.lit(0.0))
    trained = ids.filter(~held_out).withColumn("trained", F.lit(True))
    scored = scored.join(trained, "id", "left")
    below = F.coalesce(F.col("trained"), F.lit(False)) & (F.col("x") < F.col("middle"))
    return placed(placed(scored, middles, "middle"), spreads, "spread").select(
        F.col("id").alias(id_col),
        "lang",
        F.exp("x").alias("perplexity"),
        F.exp(middle + width).alias("threshold"),
        F.exp(middle - width).alias("lowest"),
        F.coalesce(below | (away <= most), F.lit(True)).alias("kept"),
    )
