"""Secret scans: fixed patterns, and two character Markov models compared by log-likelihood ratio.

Three patterns find assignments, access keys and hexadecimal strings. Beyond them, runs of characters from a key alphabet are judged: a
Markov model of random strings and one of ordinary identifiers each give the probability of a string, and a ratio above ``THRESHOLD`` (natural
logarithm) makes it a secret. In each run, outside of the spans of patterns, the stretch of the greatest ratio is a span if it has ``LEAST``
or more characters; then the parts before and behind it are searched alike. So a secret behind a name or inside a path stands out on its own.
The models are learned from a bounded sample of rows, labelled by the patterns: what they find are the random strings, the other words the
identifiers. Without any row no string stands out.

Spans count code points, end exclusive. A batch of texts is numbered at once: pairs of neighbouring characters are counted, and their
ratios summed, in one pass over all its runs; only runs whose favourable pairs could reach the threshold are searched.

Defined cases: a null or empty text has no spans; repeated rows are scanned each; other columns pass through whatever their names.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from showroom.llm.shared import exact, fresh, hash_sample, with_fields
from showroom.llm.words import slices

#: The patterns, by kind, in the order in which spans of one start are listed.
ASSIGN = re.compile(
    r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # runs of fewer are dropped, and runs do not overlap
KINDS = ("assign", "access", "hex", "markov")
VALUE_LEAST, ACCESS_LEAST = 12, 18
#: One of these stands in every text with an assignment, whatever the case.
_KEYWORDS = ("passw", "secret", "token", "api")

LEAST = 12
THRESHOLD = 12.0
#: Weight of the even distribution in both models, so that a pair which neither knows says nothing.
EVEN = 0.05
#: Bound of the rows that the models are learned from.
TRAINING_ROWS = 10_000
#: "=" stands at the end of a value only, as padding; in other places it parts a name from a value, as "_" and "-" part the words of a name.
CANDIDATE = re.compile(r"[A-Za-z0-9+/]{%d,}={0,2}" % LEAST)
WORD = re.compile(r"[A-Za-z0-9+/_-]{4,}={0,2}")
#: The models see letters without case: what is random in one case is so in the other.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_SIZE = len(ALPHABET)
_NUMBER = np.full(128, -1, np.int64)
_NUMBER[[ord(c) for c in ALPHABET]] = np.arange(_SIZE)
_NUMBER[65:91] = _NUMBER[97:123]

Span = tuple[int, int, int]


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) of what the patterns find, in order."""
    out = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= VALUE_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _merged(spans: list[Span]) -> tuple[list[int], list[int]]:
    """Starts and ends of what ``spans`` cover."""
    starts: list[int] = []
    ends: list[int] = []
    for a, _, b in spans:
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def _touches(covered: tuple[list[int], list[int]], start: int, end: int) -> bool:
    starts, ends = covered
    at = bisect_right(ends, start)
    return at < len(starts) and starts[at] < end


def _free(covered: tuple[list[int], list[int]], start: int, end: int) -> Iterator[tuple[int, int]]:
    """The parts of a run that nothing covers."""
    starts, ends = covered
    for at in range(bisect_right(ends, start), len(starts)):
        if starts[at] >= end:
            break
        if starts[at] > start:
            yield start, starts[at]
        start = ends[at]
    if start < end:
        yield start, end


def _pairs(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the pairs of neighbouring characters of all words, one word after the other, and where those of each begin (the last: end)."""
    joined = _NUMBER[np.frombuffer("\n".join(words).encode("ascii"), np.uint8)]
    inside = (joined[:-1] >= 0) & (joined[1:] >= 0) if len(joined) else np.zeros(0, bool)
    length = np.fromiter(map(len, words), np.int64, len(words))
    return (joined[:-1] * _SIZE + joined[1:])[inside], np.concatenate([[0], np.cumsum(np.maximum(length - 1, 0))])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, _SIZE * _SIZE), np.int64)
    for whole in batches:
        for batch in slices(whole, "text"):
            plain: list[str] = []
            random: list[str] = []
            for text in batch["text"].to_pylist():
                spans = base_spans(text or "")
                if not spans:
                    plain += WORD.findall(text or "")
                    continue
                covered = _merged(spans)
                plain += [m[0] for m in WORD.finditer(text) if not _touches(covered, m.start(), m.end())]
                random += [m[1] for m in ASSIGN.finditer(text) if len(m[1]) >= VALUE_LEAST]  # not the name in front of a value
                random += [text[a:b] for a, kind, b in spans if kind > 0]
            for kind, words in enumerate((plain, random)):
                counts[kind] += np.bincount(_pairs(words)[0], minlength=_SIZE * _SIZE)
    kind, pair = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(pair), pa.array(counts[kind, pair])], names=["random", "pair", "n"])


def train(docs: DataFrame, text: str = "text", key: Column | None = None, rows: int = TRAINING_ROWS) -> np.ndarray:
    """Log-likelihood ratio of every pair of characters, learned from about ``rows`` rows, chosen by a hash of ``key``."""
    key = exact(text) if key is None else key
    sample = hash_sample(docs.select(exact(text).cast("string").alias("text"), key.alias("key")), F.col("key"), rows).select("text")
    counts = sample.mapInArrow(_count, "random bigint, pair bigint, n bigint").groupBy("random", "pair").agg(F.sum("n").alias("n"))
    table = np.zeros((2, _SIZE * _SIZE))
    for row in counts.collect():  # a row per model and pair of characters at most
        table[row["random"], row["pair"]] += row["n"]
    table = table.reshape(2, _SIZE, _SIZE)
    total = table.sum(axis=2, keepdims=True)
    seen = np.where(total > 0, table / np.maximum(total, 1), 1 / _SIZE)
    chance = np.log((1 - EVEN) * seen + EVEN / _SIZE)
    return (chance[1] - chance[0]).ravel()


def stretches(ratios: np.ndarray, threshold: float) -> Iterator[tuple[int, int]]:
    """Start and end of the stretches of characters whose pairs add up to more than ``threshold``: the greatest first, then those around it."""
    todo = [(0, len(ratios))]
    while todo:
        a, b = todo.pop()
        if b - a < LEAST - 1:
            continue
        sums = np.concatenate([[0.0], np.cumsum(ratios[a:b])])
        gain = sums[1:] - np.minimum.accumulate(sums[:-1])
        end = int(gain.argmax())
        if gain[end] <= threshold:
            continue
        start = int(sums[: end + 1].argmin())
        if end - start + 2 >= LEAST:
            yield a + start, a + end + 2
        todo += [(a, a + start - 1), (a + end + 2, b)]


def spans_of(texts: list[str], ratio: np.ndarray, threshold: float = THRESHOLD) -> Iterator[tuple[list[Span], list[Span]]]:
    """Of each text the spans of the patterns, and these with the spans of the models."""
    base = [base_spans(text) for text in texts]
    runs: list[tuple[int, int, int]] = []
    for i, text in enumerate(texts):
        covered = _merged(base[i]) if base[i] else None
        for m in CANDIDATE.finditer(text):
            runs += [(i, m.start(), m.end())] if covered is None else [(i, a, b) for a, b in _free(covered, m.start(), m.end()) if b - a >= LEAST]
    more: list[list[Span]] = [[] for _ in texts]
    pairs, begin = _pairs([texts[i][a:b] for i, a, b in runs])
    ratios = ratio[pairs]
    before = np.concatenate([[0.0], np.cumsum(np.maximum(ratios, 0))])
    for r in np.flatnonzero(before[begin[1:]] - before[begin[:-1]] > threshold).tolist():
        i, at, _ = runs[r]
        more[i] += [(at + a, 3, at + b) for a, b in stretches(ratios[begin[r] : begin[r + 1]], threshold)]
    for own, new in zip(base, more, strict=True):
        yield own, sorted(own + new) if new else own


def scan(docs: DataFrame, ratio: np.ndarray, text: str = "text", threshold: float = THRESHOLD, result: str = "secrets") -> DataFrame:
    """All columns of ``docs`` and a struct ``result``: n_assign, n_access, n_hex, n_markov, base, spans.

    ``base`` and ``spans`` list ``kind:start:end``, by start and then kind, joined by commas. A name that ``docs`` has already is lengthened by ``_``.
    """
    result = fresh(docs.columns, result)
    names = [*[f"n_{k}" for k in KINDS], "base", "spans"]
    fields = [pa.field(n, pa.int64() if n[:2] == "n_" else pa.string()) for n in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text):
                rows = []
                for base, spans in spans_of([t or "" for t in batch[text].to_pylist()], ratio, threshold):
                    kinds = [k for _, k, _ in spans]
                    rows.append([*[kinds.count(k) for k in range(len(KINDS))], listed(base), listed(spans)])
                columns = zip(*rows, strict=True) if rows else [[]] * len(names)
                value = pa.StructArray.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, fields, strict=True)], fields=fields)
                yield with_fields(batch, [(result, value)])

    of = T.StructType([T.StructField(f.name, T.LongType() if f.name[:2] == "n_" else T.StringType()) for f in fields])
    return docs.mapInArrow(run, T.StructType(list(docs.schema)).add(result, of))
