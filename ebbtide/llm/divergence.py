"""Audit of sources: how far the words of each source are from others of its language.

Counting moves fixed-width term digests only. Every task counts the terms of its texts by
(language, source) and writes rows of numbers, keyed by the language and a 64-bit
digest of the term, and apart from them each digest once with its string. The rows of numbers
are shuffled and summed; a digest that enough documents have is kept. Only then are strings
looked at: the smallest and the largest string of every kept digest. Where they differ,
several terms share the digest; these are counted again under (digest, number of the
term). All other strings stay where they are, and only terms of the report get theirs back.

The distance of two sources sums over all kept terms of the language. Terms are cut into
tiles of bounded size; a task has one tile and two blocks of sources, so neither a
language, nor a source, nor a term meets in one place. Terms that neither block has are added as a
product, not listed.

Exact arithmetic: shares are whole billionths, ``1 + 10**9 * (count + 1) // (N + V)``, and the
divergence of a term is ``(p - q)**2 // q``.

Defined results: NULL text, language and source are empty strings. A row is one
document; repeated rows count again. A group without terms has its rows of pairs. A
language without kept terms has distances 0 and no terms; one source alone has no pairs. Equal values rank by the bytes of the item. An
empty table gives no rows. Only the three named columns are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.textbatches import release_memory
from ebbtide.session import broadcast_checked, stored

WHOLE = 1_000_000_000
KEY = ("lang_key", "key")  # of a term, unless others share its digest
# A-Z become a-z, other ASCII signs a blank; bytes of longer characters stay.
TERM_BYTES = bytes(
    b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
SLICE = 1 << 22


def digest64(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data)


def term_slices(text: str) -> Iterator[list[bytes]]:
    """The terms of a text, some megabytes at a time."""
    data = text.encode().translate(TERM_BYTES)
    first = 0
    while first < len(data):
        last = data.find(b" ", first + SLICE)
        last = len(data) if last < 0 else last
        yield data[first:last].split()
        first = last


class Numbers(dict):
    """Numbers the terms in the order they are first asked for."""

    def __missing__(self, term: bytes) -> int:
        number = self[term] = len(self)
        return number


class Tally:
    """Counts of one task: occurrences and documents per term and (group, language)."""

    def __init__(self, digest: Callable[[bytes], int], spelled: bool):
        self.digest, self.spelled = digest, spelled
        self._clear()

    def _clear(self) -> None:
        self.terms: dict[int, Numbers] = {}
        self.pairs: dict[tuple[int, int], int] = {}
        # Sorted codes (pair, term number), occurrences, documents; and those of new texts.
        self.merged = tuple(np.zeros(0, np.int64) for _ in range(3))
        self.fresh: list[tuple[np.ndarray, ...]] = []
        self.waiting = 0

    @property
    def entries(self) -> int:
        return len(self.merged[0]) + sum(map(len, self.terms.values())) * 4

    def add(self, group: int, lang: int, text: str) -> None:
        pair = self.pairs.setdefault((group, lang), len(self.pairs))
        known = self.terms.setdefault(lang, Numbers())
        slices = []
        for terms in term_slices(text):
            numbers = np.fromiter(map(known.__getitem__, terms), np.int64, len(terms))
            slices.append(np.unique(numbers, return_counts=True))
        if not slices:
            return
        codes, counts = slices[0] if len(slices) == 1 else _summed(slices)
        self.fresh.append((codes | pair << 32, counts, np.ones(len(codes), np.int64)))
        self.waiting += len(codes)
        if self.waiting > 1 << 20:
            self._merge()

    def _merge(self) -> None:
        self.merged = _summed([self.merged, *self.fresh])
        self.fresh, self.waiting = [], 0

    def rows(self) -> Iterator[pa.RecordBatch]:
        """All counts, and every (language, term) once with its string."""
        self._merge()
        codes, counts, docs = self.merged
        keys = {
            lang: np.fromiter(map(self.digest, known), np.uint64, len(known)).view(np.int64)
            for lang, known in self.terms.items()
        }
        spelled = {
            lang: pa.array(list(known), pa.binary()) for lang, known in self.terms.items()
        }
        for (group, lang), pair in self.pairs.items():
            low, high = np.searchsorted(codes, [pair << 32, pair + 1 << 32])
            numbers = codes[low:high] & (1 << 32) - 1
            terms = spelled[lang].take(pa.array(numbers)) if self.spelled else None
            yield _batch(keys[lang][numbers], group, lang, terms, counts[low:high], docs[low:high])
        if not self.spelled:
            for lang in self.terms:
                yield _batch(keys[lang], None, lang, spelled[lang], None, None)
        self._clear()


def _summed(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Codes that occur once each, and the sums of their numbers."""
    codes, *numbers = (np.concatenate(column) for column in zip(*parts))
    if not len(codes):
        return codes, *numbers
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[starts], *(np.add.reduceat(n[order], starts) for n in numbers)


def _batch(keys: np.ndarray, group, lang, terms, counts, docs) -> pa.RecordBatch:
    n = len(keys)

    def column(values, kind) -> pa.Array:
        return pa.nulls(n, kind) if values is None else pa.array(values, kind)

    return pa.RecordBatch.from_pydict(
        {
            "key": pa.array(keys),
            "group": column(None if group is None else np.full(n, group), pa.int64()),
            "lang_key": pa.array(np.full(n, lang), pa.int64()),
            "term": pa.nulls(n, pa.string()) if terms is None else terms.cast(pa.string()),
            "count": column(counts, pa.int64()),
            "docs": column(docs, pa.int64()),
        }
    )


def tallied(
    docs: DataFrame, digest: Callable[[bytes], int], spelled: bool = False, most: int = 2_000_000
) -> DataFrame:
    """key, group, lang_key, term, count and docs: rows of counts without their term, and
    rows of terms without counts. ``spelled`` rows of counts have their term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(digest, spelled)
        for batch in batches:
            groups, langs = (batch.column(c).to_pylist() for c in ("group", "lang_key"))
            texts = batch.column("text")
            for i, (group, lang) in enumerate(zip(groups, langs)):
                tally.add(group, lang, texts[i].as_py())
                if tally.entries >= most:
                    yield from tally.rows()
                    release_memory()
        yield from tally.rows()
        release_memory()

    return docs.mapInArrow(
        run, "key long, group long, lang_key long, term string, count long, docs long"
    )


def kept_cells(cells: DataFrame, least_docs: int, *key: str) -> DataFrame:
    """Counts per term and group of the terms of enough documents, with the term's total.

    Tasks have summed their rows already, so a term has at most one row per task and
    source, and one shuffle by term serves the sums and the window.
    """
    summed = cells.repartition(*key).groupBy(*key, "group").agg(
        F.sum("count").alias("count"), F.sum("docs").alias("docs")
    )
    term = Window.partitionBy(*key)
    return (
        summed.withColumn("in_docs", F.sum("docs").over(term))
        .withColumn("total", F.sum("count").over(term))
        .withColumn("first", F.col("group") == F.min("group").over(term))
        .filter(F.col("in_docs") >= least_docs)
        .drop("in_docs", "docs")
    )


def share(count: Column, occurrences: Column, terms: Column) -> Column:
    wide = (count + 1).cast("decimal(19,0)") * F.lit(WHOLE).cast("decimal(10,0)")
    return 1 + F.call_function("div", wide, (occurrences + terms).cast("decimal(19,0)"))


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _groups(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The (lang, source) groups and the texts, under 64-bit names that are all different."""
    pairs = stored(docs.select("lang", "source").distinct())
    seed = 0
    while True:
        names = (
            F.xxhash64(F.lit(seed), "lang").alias("lang_key"),
            F.xxhash64(F.lit(seed), "lang", "source").alias("group"),
        )
        named = pairs.select("lang", "source", *names)
        found = named.agg(
            F.count(F.lit(1)).alias("pairs"),
            F.count_distinct("group").alias("groups"),
            F.count_distinct("lang").alias("langs"),
            F.count_distinct("lang_key").alias("keys"),
        ).first()
        if found.pairs == found.groups and found.langs == found.keys:
            return named, docs.select("text", *names)
        seed += 1


def source_divergence(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least_docs: int = 3,
    top: int = 200,
    tile_cells: int = 1 << 18,
    source_block: int = 256,
    digest: Callable[[bytes], int] = digest64,
) -> DataFrame:
    """lang, source, part, item, value and rank: the distances from other sources of the
    language (``pair``) and the ``top`` terms a source uses more than its language (``term``).

    ``digest`` maps bytes to 64 bits; any one, even a constant, gives the same result.
    """

    def read(name: str, alias: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(alias)

    texts = docs.select(read(text_col, "text"), read(lang_col, "lang"), read(source_col, "source"))
    groups, named = _groups(texts)
    table = stored(tallied(named, digest))
    counts = table.filter("group IS NOT NULL").drop("term")
    kept = stored(kept_cells(counts, least_docs, *KEY).withColumn("part", F.lit(0)))
    strings = (
        table.filter("group IS NULL")
        .groupBy(*KEY)
        .agg(F.min("term").alias("term"), F.max("term").alias("last"))
    )
    names = strings.withColumn("part", F.lit(0))
    names = stored(names.join(kept.select(*KEY).distinct(), [*KEY], "left_semi"))
    clashing = names.filter("term <> last").select(*KEY)
    if not clashing.isEmpty():
        kept, names = _split(named, kept, names, clashing, least_docs, digest)

    sizes = kept.groupBy("lang_key").agg(
        F.count_if("first").alias("terms"), F.sum("count").alias("lang_n"), F.count(F.lit(1)).alias("cells")
    )
    own = kept.groupBy("group").agg(F.sum("count").alias("n"))
    zero = F.lit(0).cast("long")
    info = stored(
        groups.join(own, "group", "left")
        .join(sizes, "lang_key", "left")
        .select(
            "lang",
            "source",
            "lang_key",
            "group",
            *(F.coalesce(c, zero).alias(c) for c in ("n", "terms", "lang_n", "cells")),
            # One short row per source.
            (F.row_number().over(Window.partitionBy("lang_key").orderBy("source")) - 1).alias("place"),
            F.count(F.lit(1)).over(Window.partitionBy("lang_key")).alias("sources"),
        )
    )
    return _pair_rows(kept, info, tile_cells, source_block).unionByName(
        _term_rows(kept, names, info, top)
    )


def _split(
    named: DataFrame,
    kept: DataFrame,
    names: DataFrame,
    clashing: DataFrame,
    least_docs: int,
    digest: Callable[[bytes], int],
) -> tuple[DataFrame, DataFrame]:
    """The kept terms with those of shared digests counted one by one: such a term has
    ``part`` 1, 2, ... by its string."""
    spelled = tallied(named, digest, spelled=True).join(clashing, [*KEY], "left_semi")
    cells = kept_cells(spelled, least_docs, *KEY, "term")
    place = F.dense_rank().over(Window.partitionBy(*KEY).orderBy("term"))
    apart = stored(cells.withColumn("part", place))
    strings = apart.select(*KEY, "part", "term").distinct()
    whole = names.filter("term = last").select(*KEY, "part", "term")
    rest = kept.join(clashing, [*KEY], "left_anti")
    return (
        stored(rest.unionByName(apart.drop("term"))),
        stored(whole.unionByName(strings)),
    )


def _term_rows(kept: DataFrame, names: DataFrame, info: DataFrame, top: int) -> DataFrame:
    sizes = info.select("lang", "source", "group", "n", "lang_n", "terms")
    valued = (
        kept.join(broadcast_checked(sizes), "group")
        .withColumn("p", share(F.col("count"), F.col("n"), F.col("terms")))
        .withColumn("q", share(F.col("total"), F.col("lang_n"), F.col("terms")))
        .filter("p > q")
        .select("lang", "source", *KEY, "part", divergence(F.col("p"), F.col("q")).alias("value"))
    )
    group = Window.partitionBy("lang", "source")
    # Strings are joined to rows that can be among the first, ties of the last one included.
    first = valued.withColumn("rank", F.rank().over(group.orderBy(F.desc("value")))).filter(
        F.col("rank") <= top
    )
    spelled = first.drop("rank").join(names.select(*KEY, "part", "term"), [*KEY, "part"])
    rank = F.row_number().over(group.orderBy(F.desc("value"), "term"))
    return spelled.withColumn("rank", rank).filter(F.col("rank") <= top).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank"
    )


def _blocks(block: Column, sources: Column, size: int) -> Column:
    """The pairs of source blocks that one block takes part in."""
    every = F.sequence(F.lit(0), F.floor((sources - 1) / size).cast("int"))
    return F.transform(
        every, lambda other: F.struct(F.least(block, other).alias("a"), F.greatest(block, other).alias("b"))
    )


def _pair_rows(kept: DataFrame, info: DataFrame, tile_cells: int, size: int) -> DataFrame:
    block = F.floor(F.col("place") / size).cast("int")
    # A tile's result has two cells per pair of sources, so tiles grow with them.
    room = F.greatest(F.lit(tile_cells), 4 * F.least("sources", F.lit(2 * size)) * F.least("sources", F.lit(2 * size)))
    tiles = F.greatest(F.lit(1), F.ceil(F.col("cells") / room)).cast("int")
    placed = info.select(
        "group", "place", tiles.alias("tiles"), _blocks(block, F.col("sources"), size).alias("pairs")
    )
    left = (
        kept.select("key", "part", "group", "lang_key", "count")
        .join(broadcast_checked(placed), "group")
        .withColumn("tile", F.pmod(F.xxhash64(F.lit("tile"), "key", "part"), "tiles").cast("int"))
        .select("lang_key", "tile", F.explode("pairs").alias("pair"), "key", "part", "place", "count")
        .select("lang_key", "tile", "pair.a", "pair.b", "key", "part", "place", "count")
    )
    right = (
        info.select(
            "lang_key", "place", "n", "terms",
            F.explode(_blocks(block, F.col("sources"), size)).alias("pair"),
            F.sequence(F.lit(0), tiles - 1).alias("tile"),
        )
        .select("lang_key", F.explode("tile").alias("tile"), "pair.a", "pair.b", "place", "n", "terms")
    )
    keys = ("lang_key", "tile", "a", "b")

    def run(cells: pa.Table, sources: pa.Table) -> pa.Table:
        return pa.Table.from_pydict(_tile_sums(cells, sources, size))

    sums = (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInArrow(run, "lang_key long, place long, other long, value long, seen long")
        .groupBy("lang_key", "place", "other")
        .agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    )
    x = info.select("lang", "source", "lang_key", "place", "n", "terms")
    y = info.select("lang_key", F.col("source").alias("item"), F.col("place").alias("other"), F.col("n").alias("m"))
    none = F.lit(0).cast("long")

    def nothing(occurrences: str) -> Column:
        return share(none, F.col(occurrences), F.greatest("terms", F.lit(1)))

    # Each pair of different sources of a language is asked for.
    pairs = x.join(y, "lang_key").filter("place <> other").join(
        sums, ["lang_key", "place", "other"], "left"
    )
    rest = (F.col("terms") - F.coalesce("seen", none)) * divergence(nothing("n"), nothing("m"))
    value = F.coalesce("value", none) + F.when(F.col("terms") > 0, rest).otherwise(0)
    group = Window.partitionBy("lang", "source")
    return pairs.select("lang", "source", "item", value.alias("value")).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value",
        F.row_number().over(group.orderBy(F.desc("value"), "item")).alias("rank"),
    )


def _tile_sums(cells: pa.Table, sources: pa.Table, size: int) -> dict:
    """Sums of divergences over the terms of a tile, for all pairs across two blocks."""
    names = ("lang_key", "place", "other", "value", "seen")
    if not cells.num_rows:
        return {c: pa.array([], pa.int64()) for c in names}
    order = np.argsort(sources["place"].to_numpy())
    places, n, terms = (sources[c].to_numpy()[order].astype(np.int64) for c in ("place", "n", "terms"))
    rows = np.stack([cells["key"].to_numpy(), cells["part"].to_numpy().astype(np.int64)], axis=1)
    order = np.lexsort((rows[:, 1], rows[:, 0]))
    new = np.ones(len(rows), bool)
    new[1:] = (rows[order][1:] != rows[order][:-1]).any(axis=1)
    number = np.empty(len(rows), np.int64)
    number[order] = np.cumsum(new) - 1
    own = np.searchsorted(places, cells["place"].to_numpy())
    count = cells["count"].to_numpy()
    a, b = cells["a"][0].as_py(), cells["b"][0].as_py()
    first = [i for i, p in enumerate(places) if p // size == a]
    second = [i for i, p in enumerate(places) if p // size == b]
    # Counts near the range of a long are multiplied as Python's whole numbers.
    kind = np.int64 if int(count.max()) < (1 << 62) // WHOLE else object
    values = np.zeros((len(places), len(places)), np.int64)
    seen = int(new.sum())
    step = max(1, (1 << 21) // len(places))
    for low in range(0, seen, step):
        here = (number >= low) & (number < low + step)
        counts = np.zeros((len(places), min(step, seen - low)), np.int64)
        counts[own[here], number[here] - low] = count[here]
        shares = 1 + WHOLE * (counts.astype(kind) + 1) // (n + terms)[:, None]
        shares = shares.astype(np.int64)
        for mine, others in ((first, second), (second, first)) if a != b else ((first, second),):
            for i in mine:
                apart = shares[i] - shares[others]
                values[i, others] += (apart * apart // shares[others]).sum(axis=1)
    out = [
        (places[i], places[j], values[i, j])
        for mine, others in ((first, second), (second, first))[: 1 if a == b else 2]
        for i in mine
        for j in others
        if i != j
    ]
    place, other, value = (pa.array([int(r[k]) for r in out], pa.int64()) for k in range(3))
    lang = cells["lang_key"][0].as_py()
    return dict(
        zip(
            names,
            (
                pa.array([lang] * len(out), pa.int64()),
                place,
                other,
                value,
                pa.array([seen] * len(out), pa.int64()),
            ),
        )
    )
