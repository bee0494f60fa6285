"""Toxicity by a chain of linear classifiers.

Categories are predicted one after the other. The model of a category sees the marks of
the text and the log odds of all earlier categories. While training, those come from models that were fitted without the row's own fold
(out-of-fold), so a later model learns how far an earlier one can be trusted on texts
it has not seen; when scoring they come from the models fitted on all training rows.

Marks are words and their beginnings of 3 to 7 signs, each counted up to ``MOST`` times, so a
family of rare words with one stem is one mark, and one chance word differs from many. The
logarithm of the number of words, held within the range of the training texts, is a column of
its own: a long text gains nothing by being long.
No mark that enough texts share is left out of the search (see ``linear``), which ends when
all conditions of the optimum hold.

The training set is the ``train_rows`` labelled rows with the smallest hash of their id, or
as many of these as have ``train_chars`` signs together; only this id list is
broadcast, and one task holds the numbered marks of one sample. The models without each fold and of all rows are
fitted by one task each, in one job per category. The limit of a category is the
out-of-fold probability with the best F1. Scoring is one pass over all whole texts without a shuffle; it
looks up only marks with a weight.

Defined results: a NULL text is empty and gets the probability of a text without
words. A row is labelled if no category is NULL; of repeated labels of an id the largest
values count. Without labelled rows there is
no model: probabilities are NULL and nothing is rejected. A category with one value only
is predicted as that value. Rows, repeated ones too, are scored one by one and keep all
their columns; the result is one more column, in place of one of the same name if there is any. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.llm.linear import Linear, Sample, fit_linear, log_odds, logistic
from ebbtide.llm.textbatches import release_memory
from ebbtide.session import broadcast_checked, stored

# Column names of this module while a frame passes through it.
OWN = "toxicity__"
STEMS = range(3, 8)
MOST = 4
SLICE = 1 << 20
# Runs of letters and digits, and runs of other signs.
WORD = re.compile(r"[^\W_]+|(?:[^\w\s]|_)+")
BLANK = re.compile(r"\s")


def words(text: str | None) -> Iterator[list[str]]:
    """The lower-case words of a text, some at a time."""
    text = text or ""
    first = 0
    while first < len(text):
        cut = BLANK.search(text, first + SLICE)
        last = cut.start() if cut else len(text)
        yield WORD.findall(text[first:last].lower())
        first = last


def marks(text: str | None) -> tuple[Counter, int]:
    """How often words and beginnings (with a blank behind, no word has one) occur, and
    the number of words."""
    found, size = Counter(), 0
    for part in words(text):
        found.update(part)
        size += len(part)
    for word, count in list(found.items()):
        for stem in STEMS:
            if len(word) > stem:
                found[word[:stem] + " "] += count
    return found, size


@dataclass
class Model:
    """A category's model: the weights of marks by name, of the length, and of earlier ones."""

    linear: Linear
    marks: dict[str, float]
    numFeatures: int


class Scorer:
    """Probabilities of all categories of a chain."""

    def __init__(self, models: Sequence[Model], lengths: tuple[int, int]):
        self.models, self.lengths = models, lengths
        names = {name for model in models for name in model.marks}
        self.whole = {name for name in names if not name.endswith(" ")}
        self.stems = {
            size: {n[:-1] for n in names if n.endswith(" ") and len(n) == size + 1} for size in STEMS
        }

    def __call__(self, text: str | None) -> list[float]:
        found, size = Counter(), 0
        for part in words(text):
            size += len(part)
            different = set(part)
            for word in different & self.whole:
                found[word] += part.count(word)
            for stem, known in self.stems.items():
                if known:
                    for word in different:
                        if word[:stem] in known and len(word) > stem:
                            found[word[:stem] + " "] += part.count(word)
        shortest, longest = self.lengths
        dense, chances = [np.log1p(min(max(size, shortest), longest))], []
        for model in self.models:
            if model.linear.constant is not None:
                chances.append(model.linear.constant)
            else:
                score = model.linear.intercept + float(np.dot(model.linear.dense, dense))
                for name, count in found.items():
                    score += model.marks.get(name, 0.0) * min(count, MOST)
                chances.append(float(logistic(score)))
            dense.append(log_odds(chances[-1]))
        return chances


@dataclass
class Chain:
    categories: Sequence[str]
    models: list[Model] = field(default_factory=list)
    # Per category: the probability from which a text has it.
    limits: list[float] = field(default_factory=list)
    # Fewest and most words of a training text.
    lengths: tuple[int, int] = (0, 0)

    def limit(self, category: str) -> float:
        return dict(zip(self.categories, self.limits)).get(category, 0.5)

    def probabilities(self, docs: DataFrame, text_col: str = "text", name: str = "chain") -> DataFrame:
        """``docs`` with a struct column of one probability per category."""
        if not self.models:
            nothing = [F.lit(None).cast("double").alias(c) for c in self.categories]
            return docs.withColumn(name, F.struct(*nothing))
        models, lengths, categories = self.models, self.lengths, list(self.categories)

        @F.arrow_udf(T.StructType([T.StructField(c, T.DoubleType()) for c in categories]))
        def scored(texts: pa.Array) -> pa.Array:
            scorer = Scorer(models, lengths)
            rows = [scorer(text.as_py()) for text in texts]
            release_memory()
            columns = np.array(rows).reshape(len(rows), len(categories)).T
            return pa.StructArray.from_arrays([pa.array(c, pa.float64()) for c in columns], categories)

        return docs.withColumn(name, scored(F.col(text_col)))


def training_rows(
    docs: DataFrame,
    labels: DataFrame,
    categories: Sequence[str],
    id_col: str,
    text_col: str,
    train_rows: int,
    train_chars: int,
    folds: int,
) -> DataFrame:
    """Number, text, one 0/1 value per category and the fold of the training texts."""
    places = range(len(categories))
    chosen = (
        labels.select(
            F.col(id_col).alias("id"),
            *(F.col(c).cast("double").alias(f"y{i}") for i, c in enumerate(categories)),
        )
        .na.drop()
        .groupBy("id")
        .agg(*(F.max(f"y{i}").alias(f"y{i}") for i in places))
        .withColumn("order", F.xxhash64("id"))
        .orderBy("order", "id")
        .limit(train_rows)
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # At most ``train_rows`` short rows.
    rows = stored(
        texts.join(F.broadcast(chosen), "id").select(
            "order",
            F.monotonically_increasing_id().alias("row"),
            F.pmod(F.xxhash64(F.lit("fold"), "id"), F.lit(folds)).cast("int").alias("fold"),
            F.array(*(F.col(f"y{i}") for i in places)).alias("y"),
            "text",
        )
    )
    sizes = rows.select("order", F.char_length("text").alias("size")).na.fill(0).toArrow()
    place = np.argsort(sizes["order"].to_numpy(), kind="stable")
    fits = np.cumsum(sizes["size"].to_numpy()[place]) <= train_chars
    if not fits.all():
        rows = rows.filter(F.col("order") < int(sizes["order"].to_numpy()[place][~fits][0]))
    return rows


def _names(rows: DataFrame, least_texts: int) -> list[str]:
    """The marks of enough texts, the most frequent first. A mark has a sign of its text or
    stem, so ``train_chars`` and ``least_texts`` bound their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = Counter()
        for batch in batches:
            column = batch.column("text")
            for i in range(batch.num_rows):
                texts.update(marks(column[i].as_py())[0].keys())
        found = pa.RecordBatch.from_pydict(
            {"mark": pa.array(list(texts), pa.string()), "texts": pa.array(list(texts.values()), pa.int64())}
        )
        texts.clear()
        release_memory()
        yield found

    found = (
        rows.select("text")
        .mapInArrow(run, "mark string, texts long")
        .groupBy("mark")
        .agg(F.sum("texts").alias("texts"))
        .filter(F.col("texts") >= least_texts)
        .toArrow()
        .sort_by([("texts", "descending"), ("mark", "ascending")])
    )
    return found["mark"].to_pylist()


def _numbered(rows: DataFrame, names: list[str]) -> DataFrame:
    """The training rows with the numbers and counts of known marks, and the length.

    The marks of a text travel packed (see :func:`_sample`): a task that fits holds them all,
    in its Python worker and in the buffers of its executor that feed it.
    """
    shared = rows.sparkSession.sparkContext.broadcast(pa.array(names, pa.string()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = {name: i for i, name in enumerate(shared.value.to_pylist())}
        for batch in batches:
            texts, lengths, sizes, packed = batch.column("text"), [], [], []
            for i in range(batch.num_rows):
                found, size = marks(texts[i].as_py())
                known = sorted((places[m], min(c, MOST)) for m, c in found.items() if m in places)
                columns = np.array(known, np.int32).reshape(-1, 2).T
                lengths.append(size)
                steps = np.diff(columns[0], prepend=np.int32(0)).astype(np.int32)
                data = steps.tobytes() + columns[1].astype(np.int8).tobytes()
                sizes.append(len(known))
                packed.append(pa.compress(data, codec="zstd", asbytes=True) if known else b"")
            yield pa.RecordBatch.from_pydict(
                {
                    "row": batch.column("row"),
                    "fold": batch.column("fold"),
                    "y": batch.column("y"),
                    "words": pa.array(lengths, pa.int64()),
                    "dense": pa.array([[float(np.log1p(n))] for n in lengths], pa.list_(pa.float64())),
                    "size": pa.array(sizes, pa.int32()),
                    "marks": pa.array(packed, pa.binary()),
                }
            )
            release_memory()
        places.clear()
        release_memory()

    return stored(
        rows.drop("order").mapInArrow(
            run,
            "row long, fold int, y array<double>, words long, dense array<double>, "
            "size int, marks binary",
        )
    )


def _sample(rows: pa.Table, order: np.ndarray) -> Sample:
    """The rows in this order, with their marks unpacked: the steps from one number to the next
    and then the counts, compressed per text."""
    sizes = rows["size"].to_numpy().astype(np.int64)[order]
    starts = np.concatenate([[0], np.cumsum(sizes)])
    numbers, counts = np.empty(starts[-1], np.int32), np.empty(starts[-1], np.int8)
    for place, first, size in zip(order.tolist(), starts.tolist(), sizes.tolist()):
        if size:
            packed = rows["marks"][place].as_py()
            data = pa.decompress(packed, 5 * size, codec="zstd", asbytes=True)
            numbers[first : first + size] = np.cumsum(np.frombuffer(data, np.int32, size))
            counts[first : first + size] = np.frombuffer(data, np.int8, size, 4 * size)
    dense = rows["dense"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return Sample(starts, numbers, counts, dense.reshape(rows.num_rows, -1)[order])


def _fold_fits(place: int, lengths: np.ndarray, least_texts: int, false_marks: float):
    """Fits category ``place`` without one fold, or of all rows (fold -1): a row per held-out
    text with its probability, and one row (NULL) with the model."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        fit = key[0].as_py()
        # In one order, whichever way the rows came.
        order = np.argsort(table["row"].to_numpy(), kind="stable")
        fold, rows = (table[c].to_numpy()[order] for c in ("fold", "row"))
        y = np.array([v[place].as_py() for v in table["y"]])[order]
        sample = _sample(table, order)
        used, held = fold != fit, fold == fit
        if not used.any():
            used = held
        learnt, rest = sample if used.all() else sample.only(used), sample.only(held)
        del table, sample
        release_memory()
        model = fit_linear(learnt, y[used], lengths, least_texts, false_marks)
        known = [] if model.constant is not None else [model.intercept, *model.dense]
        chances = model.chances(rest, len(lengths))
        none = [[]] * int(held.sum())
        del learnt, rest
        release_memory()
        return pa.table(
            {
                "fit": pa.array([fit] * (len(none) + 1), pa.int32()),
                "row": pa.array([*rows[held].tolist(), None], pa.int64()),
                "chance": pa.array([*chances.tolist(), model.constant], pa.float64()),
                "known": pa.array([*none, known], pa.list_(pa.float64())),
                "marks": pa.array([*none, model.marks.tolist()], pa.list_(pa.int64())),
                "weights": pa.array([*none, model.weights.tolist()], pa.list_(pa.float64())),
            }
        )

    return run


def fit_chain(
    docs: DataFrame,
    labels: DataFrame,
    categories: Sequence[str] = ("low_quality", "toxic"),
    id_col: str = "doc_id",
    text_col: str = "text",
    train_rows: int = 10_000,
    train_chars: int = 50_000_000,
    least_texts: int = 5,
    folds: int = 3,
    false_marks: float = 0.05,
) -> Chain:
    """Fit a chain on the texts of ``docs`` that ``labels`` (id and 0/1 columns) covers."""
    rows = training_rows(
        docs, labels, categories, id_col, text_col, train_rows, train_chars, folds
    )
    chain = Chain(tuple(categories))
    names = _names(rows, least_texts)
    frame = _numbered(rows, names)
    lengths = frame.agg(F.min("words"), F.max("words")).first()
    if lengths[0] is None:
        return chain
    chain.lengths = tuple(lengths)
    sizes = np.array([len(name) for name in names], np.int64)
    frame = frame.drop("words")

    for place in range(len(categories)):
        # One bounded sample per task: without each fold, and whole (-1).
        fits = F.explode(F.array(*(F.lit(f) for f in range(-1, folds))))
        result = stored(
            frame.withColumn("fit", fits)
            .groupBy("fit")
            .applyInArrow(
                _fold_fits(place, sizes, least_texts, false_marks),
                "fit int, row long, chance double, known array<double>, marks array<long>, "
                "weights array<double>",
            )
        )
        whole = result.filter("fit = -1 AND row IS NULL").first()
        linear = Linear(
            whole.chance,
            whole.known[0] if whole.known else 0.0,
            np.array(whole.known[1:]),
            np.array(whole.marks, np.int64),
            np.array(whole.weights),
        )
        weights = {names[m]: w for m, w in zip(whole.marks, whole.weights)}
        chain.models.append(Model(linear, weights, len(names) + place))
        held_out = result.filter("row IS NOT NULL").select("row", "chance")
        scored = frame.join(held_out, "row")
        chain.limits.append(_limit(scored.select("chance", F.get("y", F.lit(place)).alias("y"))))
        if place + 1 < len(categories):
            near = F.greatest(F.least("chance", F.lit(1 - 1e-6)), F.lit(1e-6))
            odds = F.array(F.log(near / (1 - near)))
            frame = stored(scored.withColumn("dense", F.concat("dense", odds)).drop("chance"))
    return chain


def _limit(scored: DataFrame) -> float:
    """The probability that parts a category best (F1), the nearest to 0.5 among equals."""
    steps = (
        scored.groupBy(F.round("chance", 3).alias("p"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("positive"))
        .collect()  # at most 1,001 rows
    )
    steps.sort(key=lambda r: -r.p)
    every = sum(r.positive for r in steps)
    best, taken, right = (0.0, -0.5, 0.5), 0, 0.0
    for here, after in zip(steps, steps[1:]):
        taken, right = taken + here.n, right + here.positive
        limit = min(max(0.5, after.p + 0.0005), here.p - 0.0005)
        best = max(best, (2 * right / (taken + every), -abs(limit - 0.5), limit))
    return best[2]


def standard_labels(labels: DataFrame) -> DataFrame:
    """The ``labels`` table as chain categories: low quality first, then toxic."""
    return labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")


def not_toxic(
    docs: DataFrame,
    chain: Chain,
    text_col: str = "text",
    limit: float | None = None,
    labels: DataFrame | None = None,
    id_col: str = "doc_id",
) -> DataFrame:
    """The rows of ``docs`` whose toxic probability is below ``limit`` (else the chain's).

    With ``labels`` (id and 0/1 column ``toxic``) a label that is not NULL decides, and the
    model decides for all other rows; of repeated labels of an id the largest counts.
    """
    limit = chain.limit("toxic") if limit is None else limit
    name, known, known_id = f"{OWN}chain", f"{OWN}label", f"{OWN}id"
    scored = chain.probabilities(docs, text_col, name)
    toxic = F.coalesce(F.col(name)["toxic"], F.lit(0.0)) >= limit
    if labels is None:
        return scored.filter(~toxic).drop(name)
    given = (
        labels.filter("toxic IS NOT NULL")
        .groupBy(F.col(id_col).alias(known_id))
        .agg((F.max("toxic") >= 1).alias(known))
    )
    joined = scored.join(broadcast_checked(given), scored[id_col] == F.col(known_id), "left")
    return joined.filter(~F.coalesce(F.col(known), toxic)).drop(name, known, known_id)
