"""Benchmark decontamination with a generalised suffix automaton of the test items.

The test items are normalised to words and put into one automaton. Document words stream through
it and the longest stretch that matches any item is tracked. A stretch is *hit* when it reaches the
length limit (``length`` words in a row of one item) or the coverage limit (``coverage`` of an item's
words in a row); with coverage 1 that means whole items of fewer than ``length`` words. Hit stretches
are cut out of the text, and a document of which more than ``most`` is hit goes as a whole.

The automaton travels to the tasks, so its size is bounded: items are dealt into blocks of about
``BLOCK_WORDS`` words, and the documents pass block after block without a shuffle.

Defined cases: a null or empty text has no words and is kept; a null or empty item matches nothing;
an item without an id takes part under the empty id; repeated items and items of one id count once;
repeated documents are judged row by row; other columns pass through whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from showroom.llm.shared import exact, fresh, with_fields, written
from showroom.llm.words import NOT_WORD, separator_table, slices, words_of

LENGTH = 10
COVERAGE = 1.0
MOST = 0.5
BLOCK_WORDS = 100_000

RESULT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("longest", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", T.ArrayType(T.LongType()))])
_ARROW = pa.struct([
    ("n_words", pa.int64()), ("n_hit", pa.int64()), ("longest", pa.int64()),
    ("items", pa.list_(pa.string())), ("spans", pa.list_(pa.int64()))])


class Automaton:
    """Suffix automaton of several word sequences; ``marks`` name the items of each counted window."""

    def __init__(self, items: list[tuple[str, list[bytes]]], length: int = LENGTH, coverage: float = COVERAGE):
        self.number: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.size = [0]
        coded = [(key, [self.number.setdefault(w, len(self.number)) for w in words]) for key, words in items]
        for _, words in coded:
            state = 0
            for word in words:
                state = self._extend(state, word)
        self.marks: dict[int, dict[int, set[str]]] = {}
        self.least = 0
        for key, words in coded:
            if words:
                window = min(length, max(1, math.ceil(coverage * len(words))))
                self.least = min(self.least or window, window)
                self._mark(key, words, window)
        self.marked = [0] * len(self.size)  # nearest marked state on the way up, the state included
        for state in sorted(range(1, len(self.size)), key=self.size.__getitem__):
            self.marked[state] = state if state in self.marks else self.marked[self.link[state]]

    def _new(self, size: int, step: dict[int, int], link: int) -> int:
        self.size.append(size)
        self.step.append(step)
        self.link.append(link)
        return len(self.size) - 1

    def _split(self, state: int, word: int) -> int:
        """The state for the shorter strings of ``state``'s target, apart from the longer ones."""
        target = self.step[state][word]
        if self.size[target] == self.size[state] + 1:
            return target
        copy = self._new(self.size[state] + 1, dict(self.step[target]), self.link[target])
        self.link[target] = copy
        while state >= 0 and self.step[state].get(word) == target:
            self.step[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.step[last]:
            return self._split(last, word)
        new = self._new(self.size[last] + 1, {}, 0)
        while last >= 0 and word not in self.step[last]:
            self.step[last][word] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, word)
        return new

    def _mark(self, key: str, words: list[int], window: int) -> None:
        state = length = 0
        for word in words:
            state, length = self.step[state][word], length + 1
            if length > window:
                length = window
            while self.size[self.link[state]] >= length:
                state = self.link[state]
            if length == window:
                self.marks.setdefault(state, {}).setdefault(window, set()).add(key)

    def stream(self, words: list[int], hit: np.ndarray, at: int, found: set[str]) -> int:
        """Follow the words, set ``hit`` from position ``at`` on, gather items; the longest match."""
        step, link, size, marks, marked = self.step, self.link, self.size, self.marks, self.marked
        state = length = longest = 0
        for i, word in enumerate(words):
            while state and word not in step[state]:
                state = link[state]
                length = size[state]
            if word in step[state]:
                state, length = step[state][word], length + 1
                longest = max(longest, length)
            up = marked[state]
            while up:
                for window, keys in marks[up].items():
                    if window <= length:
                        hit[at + i + 1 - window : at + i + 1] = True
                        found |= keys
                up = marked[link[up]]
        return longest


def item_words(text: str | None) -> list[bytes]:
    words = words_of(pa.array([text], pa.string()), separator_table(NOT_WORD), lower=True)
    names = words.unique.to_pylist()
    return [names[c] for c in words.codes]


def _runs(mask: np.ndarray, bounds: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of ``mask`` with at least ``least`` entries that cross no bound."""
    edge = np.zeros(len(mask) + 1, dtype=bool)
    edge[bounds] = True
    before = np.concatenate([[False], mask[:-1]])
    after = np.concatenate([mask[1:], [False]])
    starts = np.flatnonzero(mask & (~before | edge[:-1]))
    ends = np.flatnonzero(mask & (~after | edge[1:])) + 1
    long = ends - starts >= least
    return starts[long], ends[long]


def _pass(automaton, text: str, result: str, rewrite: str | None) -> Callable:
    """One pass of the documents through an automaton that Spark broadcasts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Automaton = automaton.value
        table = separator_table(NOT_WORD)
        for whole in batches:
            for batch in slices(whole, text):
                words = words_of(batch[text], table, lower=True)
                names = words.unique.to_pylist()
                number = np.fromiter((index.number.get(n, -1) for n in names), np.int64, len(names))[words.codes]
                hit = np.zeros(len(number), dtype=bool)
                items: list[set[str]] = [set() for _ in range(batch.num_rows)]
                longest = np.zeros(batch.num_rows, dtype=np.int64)
                if result in batch.schema.names:
                    for i, old in enumerate(batch[result].to_pylist()):
                        items[i].update(old["items"])
                        longest[i] = old["longest"]
                        for a, b in zip(old["spans"][::2], old["spans"][1::2], strict=True):
                            hit[words.bounds[i] + a : words.bounds[i] + b] = True
                starts, ends = _runs(number >= 0, words.bounds, index.least) if index.least else ([], [])
                owner = np.searchsorted(words.bounds, starts, side="right") - 1
                for i, a, b in zip(owner, starts, ends, strict=True):
                    longest[i] = max(longest[i], index.stream(number[a:b].tolist(), hit, a, items[i]))
                a, b = _runs(hit, words.bounds, 1)
                of = np.searchsorted(words.bounds, a, side="right") - 1
                cuts = np.searchsorted(of, np.arange(batch.num_rows + 1))
                spans = [np.stack([a[p:q], b[p:q]], 1).ravel() - words.bounds[i] for i, (p, q) in enumerate(pairwise(cuts))]
                before = np.concatenate([[0], np.cumsum(hit)])
                counts = before[words.bounds[1:]] - before[words.bounds[:-1]]
                value = pa.StructArray.from_arrays(
                    [pa.array(words.count(), pa.int64()), pa.array(counts, pa.int64()), pa.array(longest),
                     pa.array([sorted(s) for s in items], _ARROW[3].type), pa.array(spans, _ARROW[4].type)],
                    fields=list(_ARROW))
                kept = batch if result not in batch.schema.names else batch.drop_columns([result])
                fields = [(result, value)]
                if rewrite is not None:
                    fields.append((rewrite, _without(words, a, b, of, batch.num_rows)))
                yield with_fields(kept, fields)

    return run


def _without(words, starts: np.ndarray, ends: np.ndarray, of: np.ndarray, rows: int) -> pa.Array:
    """Texts without the words from ``starts`` to ``ends``; null where nothing is cut."""
    texts: list[str | None] = [None] * rows
    for i in np.unique(of):
        pieces, at = [], words.offsets[i]
        for a, b in zip(starts[of == i], ends[of == i], strict=True):
            pieces.append(words.data_as_given[at : words.starts[a]].tobytes())
            at = words.ends[b - 1]
        pieces.append(words.data_as_given[at : words.offsets[i + 1]].tobytes())
        texts[i] = b"".join(pieces).decode()
    return pa.array(texts, pa.string())


def mark(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    length: int = LENGTH, coverage: float = COVERAGE, result: str = "contamination", rewrite: str | None = None,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """All columns of ``docs`` and a struct ``result``: words, hit words, longest match, items, hit spans.

    ``spans`` lists start and end word of every hit stretch; ``longest`` is 0 if no stretch of words known
    to the items is as long as the shortest window. With ``rewrite`` a further column of that
    name holds the text without these stretches, or null where nothing is hit. Names that ``docs`` has already are lengthened by ``_``.

    Items of more than ``block_words`` words go in blocks, one pass of the documents each; what a pass marks is written before the next, and
    neither the driver nor a task holds more than one block.
    """
    spark = docs.sparkSession
    result = fresh(docs.columns, result)
    rewrite = rewrite and fresh([*docs.columns, result], rewrite)
    tests = benchmark.select(
        F.coalesce(exact(item).cast("string"), F.lit("")).alias("item"), exact(item_text).cast("string").alias("text"))
    # Every word but the last takes two bytes at least.
    size = tests.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, math.ceil(size / 2 / block_words))
    for block in range(blocks):
        part = tests.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block) if blocks > 1 else tests
        rows = [(r["item"], item_words(r["text"])) for r in part.collect()]
        sent = spark.sparkContext.broadcast(Automaton(rows, length, coverage))
        last = block == blocks - 1
        kind = T.StructType([f for f in docs.schema if f.name != result]).add(result, RESULT)
        if last and rewrite:
            kind = kind.add(rewrite, T.StringType())
        docs = docs.mapInArrow(_pass(sent, text, result, rewrite if last else None), kind)
        if not last:
            docs = written(docs, "benchmark-marks")
            sent.destroy()
    return docs


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", length_column: str | None = "n_chars",
    length: int = LENGTH, coverage: float = COVERAGE, most: float = MOST,
) -> DataFrame:
    """``docs`` without hit stretches and without documents of which more than ``most`` is hit.

    The columns stay; ``length_column``, if there is one, counts the characters of the new text.
    """
    columns = docs.columns
    result, rest = fresh(columns, "contamination"), fresh(columns, "rest_of_text")
    marked = mark(docs, benchmark, text, length=length, coverage=coverage, result=result, rewrite=rest)
    kept = marked.where(f"`{result}`.n_hit <= {most} * `{result}`.n_words")
    new = {text: F.coalesce(F.col(rest), exact(text))}
    if length_column in columns:
        new[length_column] = F.when(F.col(rest).isNull(), exact(length_column)).otherwise(
            F.length(rest).cast(docs.schema[length_column].dataType))
    return kept.select(*[new[c].alias(c) if c in new else exact(c) for c in columns])
