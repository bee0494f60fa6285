"""Near-duplicate groups by MinHash with tensored banding, verified on full sets.

Instead of ``L`` band keys of ``k`` minhashes each, a text gets two collections of
``sqrt(L)`` keys of ``k / 2`` minhashes; table ``(i, j)`` is keyed by key ``i`` of the first
and key ``j`` of the second collection. That computes ``sqrt(L) * k`` minhashes instead
of ``L * k``. With the defaults (two times 20 keys of 3) there are 400 tables from 120
minhashes, and a pair with similarity 0.8 shares no table with probability 1.2e-6.

1. Texts with the same shingle set form a class; only its smallest id goes on.
2. In a small sub-grid of the tables every member of a cell is compared with the
   cell's smallest id only. Verified links give first components; a family of very many
   near copies becomes one component here, with one comparison per member.
3. A bucket of the first collection whose members are all in one component has nothing
   left to find. Only the other buckets are crossed with the second collection. A cell that
   still holds several components gives its pairs across components if it has few
   members. The members of larger cells meet in an exact prefix-filter join: shingles are
   ordered from rare to frequent, and two texts over the threshold must share one
   among the first few, so a passage that very many texts share makes no pairs.
4. Candidates whose minhashes agree too rarely are dropped (one byte of each is kept as
   a sketch); all others are verified on the full shingle sets, recomputed from the texts.

Which texts a verification needs is told to the scan by a bitmap of hashed ids of a
fixed size (1 MB), followed by an exact join.

Defined results: a text has the set of its distinct shingles of ``width`` words; with
fewer words the whole sequence is its only shingle; a NULL text or one without words has an
empty set, is linked with nothing and kept. Ids are expected to be unique; rows that
repeat an id are each decided by their text. Rows with a NULL id are never linked and
kept. An empty table gives no rows. Only the id and text column are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.graph import components
from ebbtide.llm.textbatches import packed_texts, release_memory, segments
from ebbtide.session import stored

BITMAP = 8_388_593  # a prime below 2**23: the fixed number of bits of the id bitmap
MOST_WORDS = 100_000
SMALL_CELL = 16


class Shingler:
    """Sorted distinct 64-bit shingle hashes of texts."""

    def __init__(self, width: int):
        self.width = width
        self.words: dict[bytes, int] = {}
        seeds = np.random.default_rng(width).integers(1, 2**63, size=width, dtype=np.uint64)
        self.factors = seeds | np.uint64(1)

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        known = self.words
        if len(known) > MOST_WORDS:
            known.clear()
        hashes = np.empty(len(words), np.uint64)
        for i, word in enumerate(words):
            value = known.get(word)
            if value is None:
                value = known[word] = xxhash.xxh3_64_intdigest(word)
            hashes[i] = value
        width = min(self.width, len(words))
        count = len(words) - width + 1
        mixed = np.full(count, np.uint64(width), np.uint64)
        for place in range(width):
            mixed += hashes[place : place + count] * self.factors[place]
        return np.unique(scrambled(mixed))


def scrambled(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


class Signer:
    """The two key collections of a shingle set."""

    def __init__(self, keys: int, rows: int):
        random = np.random.default_rng(2 * keys + rows)
        size = 2 * keys * rows
        self.flips = random.integers(0, 2**63, size=(size, 1), dtype=np.uint64)
        self.factors = random.integers(0, 2**63, size=(size, 1), dtype=np.uint64) | np.uint64(1)
        self.weights = random.integers(0, 2**63, size=rows, dtype=np.uint64) | np.uint64(1)
        self.keys, self.rows = keys, rows

    def __call__(self, shingles: np.ndarray) -> tuple[np.ndarray, bytes]:
        """The keys, and the lowest byte of every minhash as a sketch."""
        least = np.full(len(self.flips), np.iinfo(np.uint64).max)
        for first in range(0, len(shingles), 4096):
            part = (shingles[None, first : first + 4096] ^ self.flips) * self.factors
            part ^= part >> np.uint64(32)
            np.minimum(least, part.min(axis=1), out=least)
        keys = (least.reshape(-1, self.rows) * self.weights).sum(axis=1, dtype=np.uint64)
        sketch = (least & np.uint64(255)).astype(np.uint8).tobytes()
        return scrambled(keys).view(np.int64).reshape(2, self.keys), sketch


def signatures(docs: DataFrame, width: int, keys: int, rows: int) -> DataFrame:
    """id, n (set size), set_key (128 bits of the sorted set), a and b (key collections)
    and sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, signer = Shingler(width), Signer(keys, rows)
        for batch in batches:
            for first, texts in segments(batch.column("text"), 1 << 20):
                sets = [shingler(t) for t in texts]
                signed = [signer(s) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(first, len(texts)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets]),
                        pa.array([s and s[0][0] for s in signed], pa.list_(pa.int64())),
                        pa.array([s and s[0][1] for s in signed], pa.list_(pa.int64())),
                        pa.array([s and s[1] for s in signed], pa.binary()),
                    ],
                    names=["id", "n", "set_key", "a", "b", "sketch"],
                )

    return docs.mapInArrow(
        run,
        "id long, n long, set_key binary, a array<long>, b array<long>, sketch binary",
    )


def rows_with_ids(docs: DataFrame, ids: DataFrame, packed: bool = False) -> DataFrame:
    """The rows of ``docs`` (id, text) whose id is in ``ids`` (a column id); texts are shuffled
    and given back by :func:`packed_texts` if ``packed``."""
    spark = docs.sparkSession
    bit = F.pmod(F.col("id"), F.lit(BITMAP)) + 1
    parts = (
        ids.groupBy(F.bitmap_bucket_number(bit).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
        .collect()  # at most 256 rows of 4 KB
    )
    bits = np.zeros((BITMAP // 32768 + 1, 4096), np.uint8)
    for part in parts:
        bits[part.bucket - 1] = np.frombuffer(part.bits, np.uint8)
    shared = spark.sparkContext.broadcast(bits.tobytes())

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            batch = batch.filter(batch.column("id").is_valid())
            place = np.mod(batch.column("id").to_numpy(zero_copy_only=False), BITMAP)
            batch = batch.filter(pa.array((bitmap[place >> 3] >> (place & 7) & 1).astype(bool)))
            if packed:
                texts = packed_texts(batch.column("text"))
                batch = pa.RecordBatch.from_arrays([batch.column("id"), texts], names=["id", "text"])
            yield batch
            release_memory()

    near = docs.mapInArrow(wanted, f"id long, text {'binary' if packed else 'string'}")
    return near.join(ids, "id", "left_semi")


def _likely(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sketches agree often enough.

    A pair at the threshold agrees in ``percent`` of the minhashes on average; 5.5
    standard deviations below that, it is lost with probability 2e-8.
    """
    share = percent / 100
    own = reps.select("rep", "sketch")
    first = own.select(F.col("rep").alias("a"), F.col("sketch").alias("sketch_a"))
    second = own.select(F.col("rep").alias("b"), F.col("sketch").alias("sketch_b"))
    both = pairs.join(first, "a").join(second, "b").select("a", "b", "sketch_a", "sketch_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(
                    batch.num_rows, -1
                )
                for c in ("sketch_a", "sketch_b")
            )
            size = left.shape[1]
            least = share - 5.5 * (share * (1 - share) / max(1, size)) ** 0.5
            same = (left == right).sum(axis=1)
            yield batch.select(["a", "b"]).filter(pa.array(same >= least * size))

    return both.mapInArrow(run, "a long, b long")


def verified(docs: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    pairs = stored(pairs)
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b"))).distinct()
    texts = stored(rows_with_ids(docs, ids))
    first = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(first, "a").join(second, "b").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            kept, last, right = [], None, None
            columns = [batch.column(c) for c in ("text_a", "b", "text_b")]
            for row in range(batch.num_rows):
                left_text, id_b, right_text = (c[row].as_py() for c in columns)
                left = shingler(left_text)
                if id_b != last:  # neighbours mostly share their second text
                    last, right = id_b, shingler(right_text)
                common = len(np.intersect1d(left, right, assume_unique=True))
                union = len(left) + len(right) - common
                kept.append(common > 0 and 100 * common >= percent * union)
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))
            release_memory()

    return both.mapInArrow(run, "a long, b long")


def _mixed(cells: DataFrame) -> DataFrame:
    """Keys whose members are in several components."""
    return (
        cells.groupBy("cell")
        .agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.count(F.lit(1)).alias("members"),
        )
        .filter("low < high")
        .select("cell", "members")
    )


def _hub_pairs(reps: DataFrame, grid: int) -> DataFrame:
    """(a, b): members of a cell of the sub-grid with the smallest id of the cell."""
    keys = [
        F.xxhash64(F.lit(i), F.get("a", F.lit(i)), F.lit(j), F.get("b", F.lit(j)))
        for i in range(grid)
        for j in range(grid)
    ]
    cells = reps.select("rep", F.explode(F.array(*keys)).alias("cell"))
    hubs = (
        cells.groupBy("cell")
        .agg(F.min("rep").alias("hub"), F.max("rep").alias("last"))
        .filter("hub < last")
    )
    return (
        cells.join(hubs.drop("last"), "cell")
        .filter("rep <> hub")
        .select(F.col("rep").alias("a"), F.col("hub").alias("b"))
        .distinct()
    )


def _rest_pairs(
    docs: DataFrame, reps: DataFrame, labels: DataFrame, width: int, percent: int, least_shared: int
) -> DataFrame:
    """Candidate pairs across components, from all tables."""
    labelled = reps.join(labels, "rep")
    buckets = labelled.select(
        "rep", "component", F.posexplode("a").alias("i", "key")
    ).withColumn("cell", F.xxhash64("i", "key"))
    open_rows = stored(
        buckets.join(_mixed(buckets).select("cell"), "cell", "left_semi")
        .groupBy("rep")
        .agg(F.collect_list("i").alias("open"))  # at most one entry per key
    )
    crossed = labelled.join(open_rows, "rep").select(
        "rep", "component", "a", "b", F.explode("open").alias("i")
    )
    cells = stored(
        crossed.select(
            "rep",
            "component",
            F.get("a", F.col("i")).alias("key"),
            "i",
            F.posexplode("b").alias("j", "other"),
        ).select("rep", "component", F.xxhash64("i", "key", "j", "other").alias("cell"))
    )
    members = stored(cells.join(_mixed(cells), "cell"))
    # A pair with similarity 0.8 shares about 100 tables; below ``least_shared`` it is
    # not over the threshold.
    item = F.struct("rep", "component")
    small = (
        members.filter(F.col("members") <= SMALL_CELL)
        .groupBy("cell")
        .agg(F.sort_array(F.collect_list(item)).alias("items"))  # at most SMALL_CELL
        .select(F.explode("items").alias("x"), "items")
        .select("x", F.explode("items").alias("y"))
        .filter("x.rep < y.rep AND x.component <> y.component")
        .groupBy(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))
        .agg(F.count(F.lit(1)).alias("shared"))
        .filter(F.col("shared") >= least_shared)
        .select("a", "b")
    )
    large = members.filter(F.col("members") > SMALL_CELL).select("rep", "component").distinct()
    large = stored(large)
    if large.isEmpty():
        return small
    return small.unionByName(_prefix_pairs(docs, large, width, percent)).distinct()


def _prefix_pairs(docs: DataFrame, nodes: DataFrame, width: int, percent: int) -> DataFrame:
    """All pairs across components that can reach the threshold, by prefix filtering."""
    ids = nodes.select(F.col("rep").alias("id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            for first, texts in segments(batch.column("text"), 1 << 20):
                sets = [shingler(t).view(np.int64) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(first, len(texts)), pa.array(sets, pa.list_(pa.int64()))],
                    names=["id", "shingles"],
                )

    texts = stored(rows_with_ids(docs, ids))  # or a task would keep two Python workers
    sets = stored(texts.mapInArrow(run, "id long, shingles array<long>"))
    shingles = sets.select("id", F.explode("shingles").alias("shingle"))
    often = shingles.groupBy("shingle").agg(F.count(F.lit(1)).alias("texts"))
    # A shingle of one text makes no pair, but it fills its place in the prefix.
    ordered = (
        shingles.join(often.filter("texts > 1"), "shingle")
        .groupBy("id")
        .agg(F.sort_array(F.collect_list(F.struct("texts", "shingle"))).alias("known"))
    )
    n, alone = F.size("shingles"), F.size("shingles") - F.size("known")
    prefixes = (
        sets.join(ordered, "id")
        .select(
            "id",
            n.alias("n"),
            alone.alias("alone"),
            # Shingles of one text only come first, so the others are shifted by them.
            F.posexplode(
                F.slice("known", F.lit(1), F.greatest(_reach(n, percent, 100) - alone, F.lit(0)))
            ).alias("place", "item"),
        )
        .select(
            "id",
            "n",
            (F.col("alone") + F.col("place") + 1).alias("place"),
            F.col("item.shingle").alias("cell"),
        )
        .join(nodes.withColumnRenamed("rep", "id"), "id")
    )
    prefixes = stored(prefixes)
    rest = prefixes.join(_mixed(prefixes).select("cell"), "cell", "left_semi")
    # Of a pair over the threshold, the smaller set has a common shingle even in a
    # shorter prefix, and behind the first common one enough must follow in both.
    x = rest.filter(F.col("place") <= _reach(F.col("n"), 2 * percent, 100 + percent)).alias("x")
    y = rest.alias("y")
    follows = 1 + F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    return (
        x.join(y, F.col("x.cell") == F.col("y.cell"))
        .filter("x.n < y.n OR (x.n = y.n AND x.id < y.id)")
        .filter("x.component <> y.component")
        .filter(F.col("x.n") * 100 >= F.col("y.n") * percent)
        .filter(follows * (100 + percent) >= (F.col("x.n") + F.col("y.n")) * percent)
        .select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))
        .distinct()
    )


def _reach(n: Column, part: int, whole: int) -> Column:
    """Places, from the rarest shingle, in which a set of ``n`` must share a shingle with
    any set that has ``part / whole`` of it."""
    return (n - F.ceil(n * part / whole) + 1).cast("int")


def _labelled(reps: DataFrame, links: DataFrame) -> DataFrame:
    found = components(links).withColumnRenamed("node", "rep")
    return stored(
        reps.select("rep")
        .join(found, "rep", "left")
        .select("rep", F.coalesce("component", "rep").alias("component"))
    )


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 80,
    keys: int = 20,
    rows: int = 3,
    grid: int = 4,
    least_shared: int = 6,
) -> DataFrame:
    """One row per row: id, n_shingles, component_id (smallest id reachable) and kept.

    Two texts are linked if ``100 * |both| >= percent * |either|``. ``keys`` per
    collection, of ``rows`` minhashes each; ``grid`` squared tables are used first.
    """
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signed = stored(signatures(source, width, keys, rows))
    reps = stored(
        signed.filter("n > 0 AND id IS NOT NULL")
        .groupBy("set_key")
        .agg(
            F.min("id").alias("rep"),
            *(F.first(c).alias(c) for c in ("a", "b", "sketch")),
        )
    )
    pairs = _likely(_hub_pairs(reps, grid), reps, percent)
    links = stored(verified(source, pairs, width, percent))
    labels = _labelled(reps, links)
    pairs = _rest_pairs(source, reps, labels, width, percent, least_shared)
    more = stored(verified(source, _likely(pairs, reps, percent), width, percent))
    if not more.isEmpty():
        labels = _labelled(reps, links.unionByName(more))
    classes = reps.select("set_key", "rep").join(labels, "rep").select("set_key", "component")
    empty: Column = (F.col("n") == 0) | F.col("id").isNull()
    return (
        signed.select("id", "n", F.when(~empty, F.col("set_key")).alias("set_key"))
        .join(classes, "set_key", "left")
        .select(
            F.col("id").alias(id_col),
            F.col("n").alias("n_shingles"),
            F.coalesce("component", "id").alias("component_id"),
        )
        .withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
    )


def without_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings
) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their group, with all their columns."""
    groups = near_groups(docs, id_col, text_col, **settings)
    gone = groups.filter(~F.col("kept")).select(F.col(id_col).alias("gone_id")).distinct()
    return docs.join(gone, docs[id_col] == gone["gone_id"], "left_anti")
