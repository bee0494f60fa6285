"""Secret scans through a trigram inverted index.

Every rule's regular expression is read into a Boolean trigram query in disjunctive
form: a text can only match if it holds all trigrams of at least one term. Each task
cuts its texts into segments, builds the postings (trigram to texts) of a segment,
intersects and unites them per rule, and runs the expression on the candidates only. A
rule without a mandatory trigram has the query "anything" and scans all texts.

Only trigrams that some rule asks for get postings. Segments need no shuffle, so no
text or trigram, however frequent, gathers rows anywhere.

Defined results: a NULL text is empty and has no spans; every row, repeated ones
too, gives one row; NULL ids stay NULL; an empty table gives no rows. Only the id and
text columns are read.
"""

from __future__ import annotations

import re
import re._constants as _op
import re._parser as _parser
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.textbatches import segments


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches are leftmost and do not overlap; those whose ``group``
    is shorter than ``least`` code points are dropped afterwards."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII)


# The rules, in the order in which spans with one start are listed.
RULES = (
    Rule(
        "assign",
        r"(?i:(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
        r"([A-Za-z0-9+/_.=-]+))",
        group=2,
        least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("pem", r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----"),
    Rule("forge", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)

SPANS = "array<struct<kind:string,start:int,end:int>>"
ANY: frozenset[frozenset[str]] = frozenset([frozenset()])
MOST_STRINGS = 64  # more exact strings than this are cut into a query of their trigrams
MOST_TERMS = 64


def _either(*queries):
    terms = frozenset().union(*queries)
    return frozenset(t for t in terms if not any(u < t for u in terms))


def _both(a, b):
    if len(a) * len(b) > MOST_TERMS:
        return a if len(a) <= len(b) else b  # weaker, so still complete
    return _either(frozenset(x | y for x in a for y in b))


def _spelled(strings: set[str]):
    """The query of texts that hold one of ``strings``."""
    return _either(
        *(
            frozenset([frozenset(s[i : i + 3] for i in range(len(s) - 2))])
            for s in strings
        )
    )


def _folded(code: int) -> str:
    return chr(code).lower() if code < 128 else chr(code)


def _class_members(items) -> set[str] | None:
    found: set[str] = set()
    for kind, value in items:
        if kind is _op.LITERAL:
            found.add(_folded(value))
        elif kind is _op.RANGE and value[1] - value[0] < 8:
            found |= {_folded(c) for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found if len(found) <= 8 else None


def _node(op, value):
    """(exact strings or None, query) of one element of a parsed expression."""
    if op is _op.LITERAL:
        return {_folded(value)}, ANY
    if op is _op.IN:
        return _class_members(value), ANY
    if op is _op.SUBPATTERN:
        return _sequence(value[3])
    if op is _op.BRANCH:
        parts = [_sequence(branch) for branch in value[1]]
        if all(exact is not None for exact, _ in parts):
            strings = set().union(*(exact for exact, _ in parts))
            if len(strings) <= MOST_STRINGS:
                return strings, ANY
        return None, _either(*(q if e is None else _spelled(e) for e, q in parts))
    if op in (_op.MAX_REPEAT, _op.MIN_REPEAT, _op.POSSESSIVE_REPEAT):
        least, most, body = value
        exact, query = _sequence(body)
        if least == 0:
            return ((exact | {""}) if most == 1 and exact is not None else None), ANY
        if exact is None:
            return None, query
        if least == most == 1:
            return exact, ANY
        return None, _spelled({s * least for s in exact} if len(exact) == 1 else exact)
    if op in (_op.AT, _op.ASSERT, _op.ASSERT_NOT):
        return {""}, ANY  # no width; it can only forbid matches
    return None, ANY


def _sequence(parsed):
    run, query, whole = {""}, ANY, True
    for op, value in parsed:
        exact, needed = _node(op, value)
        query = _both(query, needed)
        if exact is not None and len(run) * len(exact) <= MOST_STRINGS:
            run = {a + b for a in run for b in exact}
            continue
        query, whole = _both(query, _spelled(run)), False
        run = exact if exact is not None else {""}
    return (run, query) if whole else (None, _both(query, _spelled(run)))


def trigram_query(pattern: str) -> frozenset[frozenset[str]]:
    """Terms of lower-cased trigrams, one of which every match must hold completely.

    ``frozenset([frozenset()])`` stands for "anything".
    """
    exact, query = _sequence(_parser.parse(pattern))
    return query if exact is None else _spelled(exact)


class Segment:
    """The postings of the wanted trigrams over a few texts."""

    def __init__(self, texts: list[str], trigrams: list[str], slots: np.ndarray):
        lowered = [t.encode("utf-8", "surrogatepass").lower() for t in texts]
        joined = np.frombuffer(b"\0\0\0".join(lowered) + b"\0\0\0", np.uint8)
        starts = np.cumsum([0] + [len(t) + 3 for t in lowered[:-1]])
        codes = joined[:-2].astype(np.int32)
        codes <<= 8
        codes |= joined[1:-1]
        codes <<= 8
        codes |= joined[2:]
        found = slots[codes]
        places = np.flatnonzero(found)
        owner = np.searchsorted(starts, places, side="right") - 1
        pairs = np.unique(found[places].astype(np.int64) * len(texts) + owner)
        which, rows = np.divmod(pairs, len(texts))
        edges = np.searchsorted(which, np.arange(1, len(trigrams) + 2))
        self.size = len(texts)
        self.postings = {t: rows[edges[i] : edges[i + 1]] for i, t in enumerate(trigrams)}

    def candidates(self, query) -> np.ndarray:
        if query == ANY:
            return np.arange(self.size)
        hit = np.zeros(self.size, bool)
        for term in query:
            lists = sorted((self.postings[t] for t in term), key=len)
            rows = lists[0]
            for other in lists[1:]:
                rows = np.intersect1d(rows, other, assume_unique=True)
            hit[rows] = True
        return np.flatnonzero(hit)


class Scanner:
    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [(r, r.compiled(), trigram_query(r.pattern)) for r in rules]
        wanted = {t for _, _, query in self.rules for term in query for t in term}
        # Trigrams beyond ASCII would not be three bytes: leave them out of the terms.
        self.rules = [
            (r, c, _either(frozenset(frozenset(t for t in x if t.isascii()) for x in q)))
            for r, c, q in self.rules
        ]
        self.trigrams = sorted(t for t in wanted if t.isascii())
        self.slots = np.zeros(1 << 24, np.uint16)
        for slot, trigram in enumerate(self.trigrams, start=1):
            self.slots[int.from_bytes(trigram.encode(), "big")] = slot

    def scan(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """Per text, sorted (start, place of the rule, end)."""
        spans: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        segment = Segment(texts, self.trigrams, self.slots)
        for place, (rule, pattern, query) in enumerate(self.rules):
            for row in segment.candidates(query):
                for match in pattern.finditer(texts[row]):
                    if match.end(rule.group) - match.start(rule.group) >= rule.least:
                        spans[row].append((match.start(), place, match.end()))
        for found in spans:
            found.sort()
        return spans


def scan_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: tuple[Rule, ...] = RULES,
    segment_chars: int = 1 << 20,
) -> DataFrame:
    """One row per row: id and ``spans``, ordered by start and then by rule."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = source.schema["id"].dataType.simpleString()
    kinds = [r.kind for r in rules]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        span_type = pa.list_(
            pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        )
        for batch in batches:
            for first, texts in segments(batch.column("text"), segment_chars):
                spans = [
                    [{"kind": kinds[k], "start": s, "end": e} for s, k, e in found]
                    for found in scanner.scan(texts)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(first, len(texts)),
                        pa.array(spans, span_type),
                    ],
                    names=["id", "spans"],
                )

    found = source.mapInArrow(scan, f"id {id_type}, spans {SPANS}")
    return found.withColumnRenamed("id", id_col)


def masked(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: tuple[Rule, ...] = RULES,
    mask: str = "[secret]",
    segment_chars: int = 1 << 20,
) -> DataFrame:
    """All rows and columns of ``docs`` with every secret in the text replaced."""
    schema = docs.schema

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            column = batch.column(at)
            for first, texts in segments(column, segment_chars):
                part = batch.slice(first, len(texts))
                changed = part.column(at).to_pylist()
                for i, found in enumerate(scanner.scan(texts)):
                    if found:
                        changed[i] = _blanked(texts[i], found, mask)
                yield part.set_column(
                    at, batch.schema.field(at), pa.array(changed, column.type)
                )

    return docs.mapInArrow(replace, schema)


def _blanked(text: str, spans: list[tuple[int, int, int]], mask: str) -> str:
    out, done = [], 0
    for start, _, end in spans:
        if start >= done:
            out += [text[done:start], mask]
        done = max(done, end)
    return "".join([*out, text[done:]])
