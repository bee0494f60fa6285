"""Language model scores from a hashed maximum-entropy model with class-factored softmax.

The counts of all training tokens give a vocabulary: the most frequent words (a bounded
number) are outcomes of the model, dealt by rank to classes of equal size; all others are
one more class, the tail. A token has the probability of its class times that within
the class. Both are softmaxes over sums of rows of a hashed weight table: a row for the
word before (bigram), one each for the second, third and fourth word before (skips) and
one for the two words before together (trigram); the rows of words are hashed with the
class too. Biases are the logarithms of the exact training frequencies. Within the tail a
word has its count, less a discount, and what is discounted goes to the words without
any count, which are one outcome (as in the base score).

Training passes once over all training texts, in ``rounds`` parts. Every task starts
from the weights so far, takes gradient steps over its texts and returns the changed
rows with the number of steps that touched them; the next weights are the means by
that number, summed by a shuffle. Step sizes shrink with the squared gradients a row has seen, so
neither rounds nor tasks have to agree on a rate. Weights have a fixed size.

Scoring looks up frequent words in a broadcast table of a bounded size. All other
words of a text go through a shuffle join with the counts, so the counts may be of any
size. Texts are cut at blanks into slices of some megabytes that carry the words before.

Defined results: a NULL text is empty and has the end token only. Rows, repeated ones too, are scored
one by one; a NULL id is an id. Without training texts the base score is 0 and the model
knows just the end of a text and the tail. An empty table gives no rows. A row of the result
has the id, not the other columns.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.textbatches import release_memory
from ebbtide.session import stored

END = b"\n"  # no word has a blank
BLANK = re.compile(rb"[\x20\x09-\x0d]")
SLICE = 1 << 22
LONGEST = 64  # bytes of a word in the broadcast table
BEFORE = 4
ABSENT = np.float32(-1e9)


def word_slices(text: str | None) -> Iterator[list[bytes]]:
    """The tokens of a text, some megabytes at a time; the last slice has the end."""
    data = (text or "").encode().lower()  # of bytes: A-Z only
    first = 0
    while True:
        cut = BLANK.search(data, first + SLICE)
        if cut is None:
            yield [*data[first:].split(), END]
            return
        yield data[first : cut.start()].split()
        first = cut.start()


class Numbers(dict):
    """Places of words in the vocabulary; all other words have the place after the last."""

    def __missing__(self, word: bytes) -> int:
        return self.other


@dataclass(frozen=True)
class Vocabulary:
    """Frequent words with their counts: the end, then falling counts."""

    words: list[bytes]
    counts: np.ndarray
    outcomes: int
    tokens: int
    distinct: int
    tail_tokens: int
    tail_words: int
    discount: float

    def numbers(self, first: int) -> Numbers:
        """Places of the ``first`` words."""
        numbers = Numbers(zip(self.words[:first], range(first)))
        numbers.other = first
        return numbers

    def tail_log10(self, count):
        """Within the tail: words of a count (numbers or a column)."""
        log10 = F.log10 if isinstance(count, Column) else np.log10
        return log10((count - self.discount) / (self.tail_tokens + 1))

    @property
    def unseen_log10(self) -> float:
        """Within the tail: all words without a count."""
        left = self.discount * self.tail_words + 1
        return float(np.log10(left / (self.tail_tokens + 1)))


@dataclass(frozen=True)
class Shape:
    classes: int = 32
    size: int = 32  # words of a class
    bits: int = 13  # rows of a weight table, as a power of two (16 at most)
    batch: int = 2048
    rate: float = 0.2

    @property
    def widths(self) -> tuple[int, int]:
        return self.classes + 1, self.size


def mixed(values: np.ndarray, seed: int) -> np.ndarray:
    values = (values + np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xFF51AFD7ED558CCD)
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ values >> np.uint64(29)


def features(outcomes: np.ndarray, kinds: int) -> np.ndarray:
    """Hashes of what stands before each outcome but the first ``BEFORE``."""
    n = len(outcomes) - BEFORE
    before = [outcomes[BEFORE - j : BEFORE - j + n].astype(np.uint64) for j in range(1, BEFORE + 1)]
    pair = before[0] * np.uint64(kinds) + before[1]
    return np.stack([mixed(v, seed) for seed, v in enumerate([*before, pair], 1)], axis=1)


class Weights:
    """The two weight tables (0: classes, 1: words of a class) and their step sizes."""

    def __init__(self, vocabulary: Vocabulary, shape: Shape):
        self.shape, self.outcomes = shape, vocabulary.outcomes
        rows, room = 1 << shape.bits, shape.classes * shape.size
        counts = np.zeros(room)
        counts[: self.outcomes] = np.maximum(vocabulary.counts[: self.outcomes], 1)
        by_class = counts.reshape(shape.classes, shape.size)
        sums = np.append(by_class.sum(axis=1), vocabulary.tail_tokens + 1)
        with np.errstate(divide="ignore"):
            self.class_bias = np.maximum(np.log(sums / sums.sum()), ABSENT).astype(np.float32)
            self.word_bias = np.maximum(np.log(by_class), ABSENT).astype(np.float32)
        self.tables = [np.zeros((rows, width), np.float32) for width in shape.widths]
        self.squares = np.full((2, rows), 0.1, np.float32)

    def scores(
        self, hashes: np.ndarray, outcomes: np.ndarray, learn: "Steps | None" = None
    ) -> np.ndarray:
        """Natural log probabilities: of the class, plus of the word within its class."""
        shape = self.shape
        classes = np.minimum(outcomes // shape.size, shape.classes)
        places = (hashes & np.uint64((1 << shape.bits) - 1)).astype(np.uint16)
        found = self._softmax(0, places, np.broadcast_to(self.class_bias, (len(outcomes), shape.classes + 1)), classes, learn)
        # The tail has no softmax of its own.
        words = np.flatnonzero(outcomes < self.outcomes)
        if len(words):
            own = classes[words]
            salted = hashes[words] + own.astype(np.uint64)[:, None] * np.uint64(0x632BE59BD9B4E019)
            places = (mixed(salted, 9) & np.uint64((1 << shape.bits) - 1)).astype(np.uint16)
            found[words] += self._softmax(1, places, self.word_bias[own], outcomes[words] % shape.size, learn)
        return found

    def _softmax(
        self, which: int, places: np.ndarray, bias: np.ndarray, targets: np.ndarray, learn: "Steps | None"
    ) -> np.ndarray:
        rows, table = np.arange(len(targets)), self.tables[which]
        sums = bias + table.take(places[:, 0], axis=0, mode="clip")
        for column in places.T[1:]:
            sums += table.take(column, axis=0, mode="clip")
        sums -= sums.max(axis=1, keepdims=True)
        target = sums[rows, targets].astype(np.float64)
        chances = np.exp(sums)
        total = chances @ np.ones(chances.shape[1], np.float32)
        if learn is not None:
            chances /= total[:, None]
            chances[rows, targets] -= 1
            learn.step(which, places, chances)
        return target - np.log(total.astype(np.float64))


class Steps:
    """Gradient steps on a copy of the weights, and the rows that they changed."""

    def __init__(self, weights: Weights):
        self.weights = weights
        self.start, self.squares = [t.copy() for t in weights.tables], weights.squares.copy()
        self.touched = np.zeros(weights.squares.shape, np.int64)

    def step(self, which: int, places: np.ndarray, errors: np.ndarray) -> None:
        """One step from the errors (probability less target) of a batch."""
        rows, gradient = gradients(places, errors)
        squares = self.weights.squares[which]
        squares[rows] += np.einsum("ij,ij->i", gradient, gradient) / gradient.shape[1]
        rate = self.weights.shape.rate / np.sqrt(squares[rows])
        self.weights.tables[which][rows] -= rate[:, None] * gradient
        self.touched[which, rows] += 1

    def changes(self) -> Iterator[pa.RecordBatch]:
        width = max(self.weights.shape.widths)
        for which in range(2):
            rows = np.flatnonzero(self.touched[which])
            steps = self.touched[which, rows].astype(np.float64)
            moved = np.zeros((len(rows), width))
            change = self.weights.tables[which][rows] - self.start[which][rows]
            moved[:, : change.shape[1]] = change * steps[:, None]
            grown = (self.weights.squares[which, rows] - self.squares[which, rows]) * steps
            yield pa.RecordBatch.from_pydict(
                {"place": rows + (which << self.weights.shape.bits), "steps": steps, "grown": grown}
                | {f"v{i}": moved[:, i] for i in range(width)}
            )


def gradients(places: np.ndarray, errors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and the sums of the errors that reach them."""
    flat = places.ravel()  # of two bytes, which sort by radix
    order = np.argsort(flat, kind="stable")
    at = flat[order]
    starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    sorted_errors = errors.take(order // places.shape[1], axis=0, mode="clip")
    return at[starts], np.add.reduceat(sorted_errors, starts, axis=0)


class Reader:
    """Turns texts into streams of vocabulary places for the model."""

    def __init__(self, vocabulary: Vocabulary, first: int):
        self.vocabulary, self.numbers = vocabulary, vocabulary.numbers(first)
        self.start = vocabulary.outcomes + 1

    def slices(self, text: str | None) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
        """Words, their places, and the outcomes with those before the slice."""
        before = np.full(BEFORE, self.start)
        for words in word_slices(text):
            places = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
            stream = np.concatenate([before, np.minimum(places, self.vocabulary.outcomes)])
            yield words, places, stream
            before = stream[-BEFORE:]

    def hashes(self, streams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Feature hashes and outcomes of all positions of some slices."""
        joined = np.concatenate(streams)
        sizes = np.array([len(s) for s in streams])
        own = np.ones(len(joined), bool)
        starts = np.cumsum(sizes) - sizes
        own[(starts[:, None] + np.arange(BEFORE)).ravel()] = False
        found = features(joined, self.vocabulary.outcomes + 2)
        return found[own[BEFORE:]], joined[own]


def counted(texts: DataFrame, most: int = 400_000) -> DataFrame:
    """(word, n): occurrences of all tokens, summed per task as far as memory allows."""

    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"word": pa.array(list(counts), pa.binary()), "n": pa.array(list(counts.values()), pa.int64())}
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        for batch in batches:
            column = batch.column("text")
            for i in range(batch.num_rows):
                for words in word_slices(column[i].as_py()):
                    counts.update(words)
                    if len(counts) >= most:
                        yield rows(counts)
                        counts = Counter()
                        release_memory()
        yield rows(counts)
        release_memory()

    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


def vocabulary_of(counts: DataFrame, shape: Shape, most_words: int) -> Vocabulary:
    """``counts`` has every training token once. Only words above a count that at most
    ``most_words`` reach come to the driver."""
    level = F.floor(F.log2("c") * 64)
    sums = counts.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("tokens"), F.count(F.lit(1)).alias("distinct")
    ).first()
    levels = (
        counts.filter(F.octet_length("word") <= LONGEST)
        .groupBy(level.alias("level"))
        .agg(F.count(F.lit(1)).alias("words"))
        .collect()  # at most 64 rows per doubling of a count
    )
    least, words = None, 0
    for row in sorted(levels, key=lambda r: -r.level):
        words += row.words
        if words > most_words:
            break
        least = row.level
    chosen = counts.filter(F.octet_length("word") <= LONGEST).filter(
        level >= least if least is not None else F.lit(False)
    )
    table = chosen.filter(F.col("word") != F.lit(END)).toArrow()
    end = counts.filter(F.col("word") == F.lit(END)).first()
    found = sorted(
        zip(table["word"].to_pylist(), table["c"].to_pylist()), key=lambda r: (-r[1], r[0])
    )
    found.insert(0, (END, end.c if end else 0))
    outcomes = min(len(found), shape.classes * shape.size)
    head = [w for w, _ in found[:outcomes]]
    tail = counts.join(
        F.broadcast(counts.sparkSession.createDataFrame([(w,) for w in head], "word binary")),
        "word",
        "left_anti",
    )
    rare = tail.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("tokens"),
        F.count(F.lit(1)).alias("words"),
        F.count_if(F.col("c") == 1).alias("once"),
        F.count_if(F.col("c") == 2).alias("twice"),
    ).first()
    seen = rare.once + 2 * rare.twice
    return Vocabulary(
        [w for w, _ in found],
        np.array([c for _, c in found], np.int64),
        outcomes,
        sums.tokens,
        sums.distinct,
        rare.tokens,
        rare.words,
        # Never the whole of a single occurrence.
        min(0.9, max(0.1, rare.once / seen)) if seen else 0.5,
    )


@dataclass(frozen=True)
class LanguageModel:
    vocabulary: Vocabulary
    weights: Weights
    counts: DataFrame  # every training token once, with its count

    def score(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """id, n_tokens, n_known, base_score and score of every row."""
        vocabulary, context = self.vocabulary, docs.sparkSession.sparkContext
        # Of bounded size: ``most_words`` short words and the weight tables.
        shared = context.broadcast((vocabulary, self.weights))
        kind = docs.schema[id_col].dataType.simpleString()
        numbered = docs.select(
            F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text")
        )

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scorer = Scorer(*shared.value)
            for batch in batches:
                yield from scorer.rows(batch)
                release_memory()

        parts = stored(
            numbered.mapInArrow(
                run,
                f"row long, id {kind}, n_tokens long, n_known long, base double, score double, "
                "rest array<struct<word: binary, n: long>>",
            )
        )
        rest = parts.select("row", F.explode("rest").alias("item")).select("row", "item.word", "item.n")
        gained = vocabulary.tail_log10(F.col("c")) - vocabulary.unseen_log10
        known = rest.join(self.counts, "word").select(
            "row",
            F.lit(None).cast(kind).alias("id"),
            F.lit(0).cast("long").alias("n_tokens"),
            F.col("n").alias("n_known"),
            (F.col("n") * F.log10(F.col("c") + 1)).alias("base"),
            (F.col("n") * gained).alias("score"),
        )
        room = float(np.log10(vocabulary.tokens + vocabulary.distinct + 1))
        sums = parts.drop("rest").unionByName(known).groupBy("row").agg(
            F.max("id").alias(id_col),
            *(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "score")),
        )
        return sums.select(
            id_col,
            "n_tokens",
            "n_known",
            (F.col("base") - F.col("n_tokens") * room).alias("base_score"),
            "score",
        )


class Scorer:
    """Scores of texts as far as the vocabulary knows their words."""

    def __init__(self, vocabulary: Vocabulary, weights: Weights):
        self.weights, self.reader = weights, Reader(vocabulary, len(vocabulary.words))
        outcomes = vocabulary.outcomes
        self.other = len(vocabulary.words)
        self.known = np.append(vocabulary.counts > 0, False)
        self.base = np.append(np.log10(vocabulary.counts + 1.0), 0.0)
        self.tail = np.zeros(self.other + 1)
        self.tail[outcomes : self.other] = vocabulary.tail_log10(vocabulary.counts[outcomes:].astype(float))
        # Also for words of the shuffled counts, which correct it.
        self.tail[self.other] = vocabulary.unseen_log10

    def rows(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Some slices at a time: a row per slice, most texts are one."""
        waiting, size = [], 0
        texts = batch.column("text")
        for i in range(batch.num_rows):
            for part in self.reader.slices(texts[i].as_py()):
                waiting.append((i, *part))
                size += len(part[1])
                if size >= 1 << 16:
                    yield self._scored(batch, waiting)
                    waiting, size = [], 0
        if waiting:
            yield self._scored(batch, waiting)

    def _scored(self, batch: pa.RecordBatch, parts: list) -> pa.RecordBatch:
        rows = pa.array([p[0] for p in parts])
        sizes = np.array([len(p[2]) for p in parts])
        places = np.concatenate([p[2] for p in parts])
        hashes, outcomes = self.reader.hashes([p[3] for p in parts])
        step = self.weights.shape.batch
        logs = np.concatenate(
            [
                self.weights.scores(hashes[i : i + step], outcomes[i : i + step])
                for i in range(0, len(outcomes), step)
            ]
        ) if len(outcomes) else np.zeros(0)
        owner = np.repeat(np.arange(len(parts)), sizes)

        def summed(values: np.ndarray) -> np.ndarray:
            return np.bincount(owner, values, len(parts))

        rest = [
            Counter(itemgetter(*missing)(words) if len(missing) > 1 else [words[j] for j in missing])
            for _, words, at, _ in parts
            for missing in [np.flatnonzero(at == self.other).tolist()]
        ]
        items = pa.StructArray.from_arrays(
            [
                pa.array([w for counts in rest for w in counts], pa.binary()),
                pa.array([n for counts in rest for n in counts.values()], pa.int64()),
            ],
            ["word", "n"],
        )
        ends = np.cumsum([0, *map(len, rest)], dtype=np.int32)
        return pa.RecordBatch.from_arrays(
            [
                batch.column("row").take(rows),
                batch.column("id").take(rows),
                pa.array(sizes, pa.int64()),
                pa.array(summed(self.known[places]).astype(np.int64)),
                pa.array(summed(self.base[places])),
                pa.array(summed(logs / np.log(10) + self.tail[places])),
                pa.ListArray.from_arrays(ends, items),
            ],
            names=["row", "id", "n_tokens", "n_known", "base", "score", "rest"],
        )


def fit_language_model(
    docs: DataFrame,
    learn: Column,
    part: Column,
    text_col: str = "text",
    rounds: int = 3,
    shape: Shape = Shape(),
    most_words: int = 1 << 17,
) -> LanguageModel:
    """A model of the texts for which ``learn`` holds; ``part`` (0 to ``rounds`` - 1) names
    the round that trains on a row."""
    texts = docs.filter(learn).select(F.col(text_col).alias("text"), part.alias("part"))
    counts = stored(counted(texts.select("text")))
    vocabulary = vocabulary_of(counts, shape, most_words)
    weights = Weights(vocabulary, shape)
    for number in range(rounds):
        weights = _round(texts.filter(F.col("part") == number).select("text"), vocabulary, weights)
    return LanguageModel(vocabulary, weights, counts)


def _round(texts: DataFrame, vocabulary: Vocabulary, weights: Weights) -> Weights:
    """The weights after one pass over ``texts``."""
    shape = weights.shape
    shared = texts.sparkSession.sparkContext.broadcast((vocabulary, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, start = shared.value
        reader, mine = Reader(known, known.outcomes), Weights(known, shape)
        mine.tables, mine.squares = [t.copy() for t in start.tables], start.squares.copy()
        steps = Steps(mine)
        for streams in _batched(reader, batches):
            hashes, outcomes = reader.hashes(streams)
            for i in range(0, len(outcomes), shape.batch):
                mine.scores(hashes[i : i + shape.batch], outcomes[i : i + shape.batch], steps)
        yield from steps.changes()
        release_memory()

    values = [f"v{i}" for i in range(max(shape.widths))]
    changes = texts.mapInArrow(
        run, ", ".join(["place long, steps double, grown double", *(f"{v} double" for v in values)])
    )
    # At most one row per row of the two tables.
    summed = changes.groupBy("place").agg(
        *(F.sum(c).alias(c) for c in ("steps", "grown", *values))
    ).toArrow()
    shared.unpersist()
    place, steps = summed["place"].to_numpy(), summed["steps"].to_numpy()
    moved = np.stack([summed[v].to_numpy() for v in values], axis=1) / steps[:, None]
    grown = summed["grown"].to_numpy() / steps
    for which, table in enumerate(weights.tables):
        mine = place >> shape.bits == which
        rows = place[mine] & (1 << shape.bits) - 1
        table[rows] += moved[mine, : table.shape[1]].astype(np.float32)
        weights.squares[which, rows] += grown[mine].astype(np.float32)
    return weights


def _batched(
    reader: Reader, batches: Iterator[pa.RecordBatch], least: int = 1 << 15
) -> Iterator[list[np.ndarray]]:
    """Outcome streams of slices, enough for some steps at a time."""
    streams, size = [], 0
    for batch in batches:
        column = batch.column("text")
        for i in range(batch.num_rows):
            for _, places, stream in reader.slices(column[i].as_py()):
                streams.append(stream)
                size += len(places)
                if size >= least:
                    yield streams
                    streams, size = [], 0
    if streams:
        yield streams
