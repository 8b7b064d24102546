"""Language identification: multinomial naive Bayes over hashed character n-grams.

The n-grams (1 to ``LONGEST`` characters) of each word between two blanks are hashed into ``2 ** BITS`` buckets. Training
counts buckets per language over a bounded sample of the labelled rows, inside tasks and then by aggregation; the matrix of
log-probabilities travels to the tasks. Scoring is a product of sparse matrices, slice by slice: the different words
of a slice times the matrix, and then documents times words. Whole texts are scored.

The matrix has a row per bucket and a column per language. More than ``WIDE`` languages share coarser buckets, by the leading bits of the hash,
so its size stays within 128 MB.

Defined cases: null texts and texts without letters get ``UNKNOWN`` with score 0, and so does all without labelled rows;
rows without language are not learned from; ties go to the first language by name; repeated rows count as often as they
stand there; other columns pass through whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from showroom.llm.hashing import mix
from showroom.llm.shared import exact, fresh, hash_sample, with_fields
from showroom.llm.words import SPACES, Words, separator_table, slices, words_of

LONGEST = 3
BITS = 15
SMOOTHING = 0.5
UNKNOWN = "und"
#: Bound of the labelled rows that are learned from.
TRAINING_ROWS = 20_000
WIDE = 512
#: Words handled at once.
_STEP = 100_000


def buckets_of(words: pa.Array, bits: int = BITS, longest: int = LONGEST) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For a stretch of words at a time: buckets of all n-grams, and the word each belongs to."""
    for first in range(0, len(words), _STEP):
        texts = pc.utf8_lower(words.slice(first, _STEP).cast(pa.large_string())).to_pylist()
        points = np.frombuffer((" " + "  ".join(texts) + " ").encode("utf-32-le"), "<u4").astype(np.uint64)
        length = np.fromiter(map(len, texts), np.int64, len(texts)) + 2
        word = np.repeat(np.arange(len(texts)), length)
        left = np.repeat(np.cumsum(length), length) - np.arange(len(points))  # characters to the end of the word
        rolled = np.zeros(len(points), np.uint64)
        for n in range(1, longest + 1):
            here = len(points) - n + 1
            rolled = rolled[:here] * np.uint64(1_000_003) + points[n - 1 :]
            whole = left[:here] >= n
            yield (mix(rolled[whole], n) >> np.uint64(64 - bits)).astype(np.int64), word[:here][whole] + first


def _cut(texts: pa.Array) -> Words:
    return words_of(texts, separator_table(SPACES))


@dataclass
class Model:
    languages: list[str]
    prior: np.ndarray
    weights: np.ndarray
    bits: int
    longest: int

    def word_scores(self, words: pa.Array) -> np.ndarray:
        out = np.zeros((len(words), len(self.languages)))
        for bucket, word in buckets_of(words, self.bits, self.longest):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(word) else np.zeros(0, np.int64)
            if len(first):
                out[word[first]] += np.add.reduceat(self.weights[bucket], first, axis=0)
        return out

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        words = _cut(texts)
        lettered = pc.match_substring_regex(words.unique.cast(pa.large_string()), r"\p{L}").to_numpy(zero_copy_only=False)
        n = len(words.bounds) - 1
        known = np.zeros(n, dtype=bool)
        total = np.tile(self.prior, (n, 1))
        some = np.flatnonzero(words.count() > 0)
        if len(some):
            begin = words.bounds[:-1][some]
            known[some] = np.logical_or.reduceat(lettered[words.codes], begin)
            for k, column in enumerate(self.word_scores(words.unique).T):
                total[some, k] += np.add.reduceat(column[words.codes], begin)
        if not self.languages:
            return [UNKNOWN] * n, np.zeros(n)
        best = total.argmax(axis=1)
        score = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], np.where(known, score, 0.0)


def _count(bits: int, longest: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for whole in batches:
            for batch in slices(whole, "text"):
                words = _cut(batch["text"])
                lang = batch["lang"].to_pylist()
                grams = list(buckets_of(words.unique, bits, longest))
                owner = np.repeat(np.arange(len(lang)), words.count())
                for name in set(lang):
                    mine = np.array([x == name for x in lang])
                    often = np.bincount(words.codes[mine[owner]], minlength=len(words.unique))
                    counts = total.setdefault(name, np.zeros(1 << bits, np.int64))
                    for bucket, word in grams:
                        counts += np.bincount(bucket, weights=often[word], minlength=1 << bits).astype(np.int64)
                    rows[name] = rows.get(name, 0) + int(mine.sum())
        for name, counts in total.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * (len(used) + 1)), pa.array(np.append(used, -1)), pa.array(np.append(counts[used], rows[name]))],
                names=["lang", "bucket", "n"])

    return run


def train(
    docs: DataFrame, text: str = "text", lang: str = "lang", key: Column | None = None, rows: int = TRAINING_ROWS,
    bits: int = BITS, longest: int = LONGEST,
) -> Model:
    """Learn from at most about ``rows`` rows of known language, chosen by a hash of ``key`` (the text, if left out)."""
    key = exact(text) if key is None else key
    labelled = docs.select(exact(text).cast("string").alias("text"), exact(lang).cast("string").alias("lang"), key.alias("key"))
    labelled = hash_sample(labelled.where("lang IS NOT NULL"), F.col("key"), rows).select("text", "lang")
    counts = labelled.mapInArrow(_count(bits, longest), "lang string, bucket bigint, n bigint")
    counts = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # One row per bucket and language of the sample.
    found = counts.toArrow()
    names = sorted(set(found["lang"].to_pylist()))
    fewer = max(0, math.ceil(math.log2(max(1, len(names)) / WIDE)))
    place = {x: i for i, x in enumerate(names)}
    column = np.array([place[x] for x in found["lang"].to_pylist()], np.int64)
    bucket, n = found["bucket"].to_numpy(), found["n"].to_numpy()
    bits -= fewer
    table = np.full((1 << bits, len(names)), SMOOTHING)
    prior = np.full(len(names), SMOOTHING)
    np.add.at(table, (bucket[bucket >= 0] >> fewer, column[bucket >= 0]), n[bucket >= 0])
    prior[column[bucket < 0]] += n[bucket < 0]
    return Model(names, np.log(prior / max(prior.sum(), 1)), np.log(table / table.sum(axis=0, keepdims=True)), bits, longest)


def predict(docs: DataFrame, model: Model, text: str = "text", result: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """All columns of ``docs``, the likeliest language and its probability. Names that ``docs`` has already are lengthened by ``_``."""
    name = fresh(docs.columns, result[0])
    result = (name, fresh([*docs.columns, name], result[1]))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text):
                names, score = sent.value.predict(batch[text])
                yield with_fields(batch, [(result[0], pa.array(names, pa.string())), (result[1], pa.array(score))])

    kind = T.StructType(list(docs.schema)).add(result[0], T.StringType()).add(result[1], T.DoubleType())
    return docs.mapInArrow(run, kind)
