"""Similarity join on word n-grams by vertical partitioning.

A document is the set of its distinct n-grams of words, as 64-bit hashes. Documents of equal sets are one
*class*. The hash order of all n-grams is cut into fragments. Each fragment is worked on alone: it finds
the n-grams that more than one class has (about one occurrence in six on ordinary text), and only these
go on; with them every class knows how many of its n-grams it shares at all.

Candidates come from prefixes: if two sets reach the threshold, then each holds one of the other's n-grams
among its rarest ``n - ceil(t * n) + 1``. N-grams of a single class are the rarest of all, so a class that shares
too few is done. Within the classes of one prefix n-gram, all are compared with one *pivot*, the class with the
smallest share of n-grams of its own. What is known about the pivot bounds the overlap of any two others:
common n-grams lie inside the pivot, or among the shared ones outside of it; and two sets have in common what both have of the
pivot, so they must differ from it in the same n-grams, which small bit tables bound. Only pairs which these bounds leave
open, and which the pivot does not join already, are compared as well. So a group of near copies costs a few comparisons
per member, and no link between components is lost.

The overlap of a pair is counted fragment by fragment and summed per pair.

N-grams that a hundredth of a small sample of documents has would fill one fragment; they are known as
shared, and go to the classes directly. Two different sets or n-grams with one 64-bit hash would be
taken as equal (chance about n^2 / 2^65).

Defined cases: a text with fewer than five words is one n-gram; null, empty and blank texts have none and link with
nothing; a row without id takes no part in links; repeated rows are rows of one class; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from showroom.llm.components import components
from showroom.llm.hashing import mix
from showroom.llm.shared import exact, fresh, hash_sample, written
from showroom.llm.words import SPACES, Words, separator_table, slices, words_of

NGRAM = 5
PERCENT = 80
#: Documents looked at to find n-grams that very many have, and the share of them that makes an n-gram frequent.
SAMPLE_ROWS = 4_000
FREQUENT = 0.01
#: Pieces of the hash order in which the overlap of a pair is counted.
PIECES = 8
_MOST = np.uint16(65535)

_ROWS = "part bigint, kind int, doc_id bigint, n bigint, sig bigint, sigs binary, counts binary, sizes binary, hashes binary, often binary, mark bigint"
_ARROW = pa.schema([
    ("part", pa.int64()), ("kind", pa.int32()), ("doc_id", pa.int64()), ("n", pa.int64()), ("sig", pa.int64()), ("sigs", pa.binary()),
    ("counts", pa.binary()), ("sizes", pa.binary()), ("hashes", pa.binary()), ("often", pa.binary()), ("mark", pa.int64())])
#: Kinds of rows: a document; hashes of a fragment; sizes and frequent hashes of classes; shared hashes of classes.
DOCUMENT, FRAGMENT, CLASS, SHARED = range(4)


def ngrams(words: Words, n: int = NGRAM) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of every document, one after the other, and where each one's begin."""
    names = words.unique.to_pylist()
    word = np.fromiter(map(xxhash.xxh64_intdigest, names), np.uint64, len(names))[words.codes]
    count = words.count()
    rolled = np.zeros(max(0, len(word) - n + 1), np.uint64)
    for k in range(n):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + mix(word[k : len(word) - n + 1 + k], k)
    rolled = mix(rolled, n)
    size = np.where(count >= n, count - n + 1, (count > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(size)])
    full = count >= n
    shift = np.repeat(words.bounds[:-1] - bounds[:-1], size)
    at = np.arange(bounds[-1]) + shift
    whole = np.repeat(full, size)
    out = np.zeros(bounds[-1], np.uint64)
    out[whole] = rolled[at[whole]]
    for i in np.flatnonzero(~full & (count > 0)):
        key = np.uint64(count[i])
        for k, x in enumerate(word[words.bounds[i] : words.bounds[i + 1]]):
            key = mix(np.array([key]) + mix(np.array([x]), k))[0]
        out[bounds[i]] = key
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        out[a:b].sort()
    new = np.ones(len(out), dtype=bool)
    new[1:] = out[1:] != out[:-1]
    new[bounds[:-1][bounds[:-1] < len(out)]] = True
    return out[new], np.concatenate([[0], np.cumsum(new)])[bounds]


def signatures(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One hash per set."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes, 77), dtype=np.uint64)])
    size = np.diff(bounds)
    return mix(sums[bounds[1:]] - sums[bounds[:-1]] + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), 78)


def _row(**values) -> dict:
    return dict.fromkeys(_ARROW.names) | values


def _cut(ngram: int, fragments: int, buckets: int, frequent) -> Callable:
    """Documents to rows of all kinds but SHARED."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_ = separator_table(SPACES)
        often = frequent.value
        maybe = np.zeros(1 << 16, dtype=bool)
        maybe[(often & np.uint64(0xFFFF)).astype(np.int64)] = True
        seen: set[int] = set()
        for whole in batches:
            for batch in slices(whole, "text"):
                hashes, bounds = ngrams(words_of(batch["text"], table_, lower=True), ngram)
                size, sigs = np.diff(bounds), signatures(hashes, bounds)
                ids = batch["doc_id"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(size)) % fragments), pa.array(np.full(len(size), DOCUMENT, np.int32)), ids, pa.array(size),
                     pa.array(sigs.view(np.int64)), *[pa.nulls(len(size), pa.binary())] * 5, batch["mark"]], schema=_ARROW)
                new = []
                for i, (sig, given) in enumerate(zip(sigs.tolist(), ids.is_valid().to_pylist(), strict=True)):
                    if given and size[i] and sig not in seen:
                        seen.add(sig)
                        new.append(i)
                if not new:
                    continue
                new = np.array(new)
                take = np.zeros(len(size), dtype=bool)
                take[new] = True
                hashes = hashes[np.repeat(take, size)]
                size, sigs = size[new], sigs[new]
                owner = np.repeat(np.arange(len(new)), size)
                hot = maybe[(hashes & np.uint64(0xFFFF)).astype(np.int64)]
                hot[hot] = np.isin(hashes[hot], often)
                rows = list(_packed(CLASS, sigs % np.uint64(buckets), buckets, owner[hot], hashes[hot], sigs, size))
                rows += _packed(FRAGMENT, None, fragments, owner[~hot], hashes[~hot], sigs, size)
                yield pa.RecordBatch.from_pylist(rows, _ARROW)

    return run


def _packed(kind: int, bucket: np.ndarray | None, parts: int, owner: np.ndarray, hashes: np.ndarray, sigs: np.ndarray, size: np.ndarray) -> Iterator[dict]:
    """A row per part: its classes, how many hashes each has there, and the hashes.

    The part is the bucket of the class, whose classes are all listed, or else comes from the hash.
    """
    part = (bucket[owner] if bucket is not None else (hashes >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part.astype(np.uint16) if parts < 1 << 16 else part, kind="stable")
    ends = np.cumsum(np.bincount(part, minlength=parts))
    hashes, owner = hashes[order], owner[order]
    groups = np.argsort(bucket.astype(np.int64), kind="stable") if bucket is not None else None
    cuts = np.cumsum(np.bincount(bucket.astype(np.int64), minlength=parts)) if bucket is not None else None
    for p in range(parts):
        a, b = (ends[p - 1] if p else 0), ends[p]
        if bucket is not None:
            listed = groups[(cuts[p - 1] if p else 0) : cuts[p]]
            counts = np.bincount(owner[a:b], minlength=len(sigs))[listed] if b > a else np.zeros(len(listed), np.int64)
        else:
            new = np.flatnonzero(np.concatenate([[True], owner[a + 1 : b] != owner[a : b - 1]])) if b > a else np.zeros(0, np.int64)
            listed, counts = owner[a:b][new], np.diff(np.concatenate([new, [b - a]]))
        if len(listed):
            yield _row(
                part=p + (0 if bucket is None else (1 << 32)), kind=kind, sigs=sigs[listed].tobytes(), counts=counts.astype("<u4").tobytes(),
                sizes=size[listed].astype("<u4").tobytes() if bucket is not None else b"", hashes=hashes[a:b].tobytes(), often=b"")


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    """Rows sorted by part, as one list per part."""
    part, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if held and row["part"] != part:
                yield part, held
                held = []
            part = row["part"]
            held.append(row)
    if held:
        yield part, held


def _joined(rows: list[dict], column: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(r[column] for r in rows), kind)


def _share(buckets: int) -> Callable:
    """Rows sorted by part: the hashes of each fragment that several classes have, by bucket of the class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _parts(batches):
            passed = [r for r in rows if r["kind"] != FRAGMENT]
            if passed:
                yield pa.RecordBatch.from_pylist(passed, _ARROW)
            rows = [r for r in rows if r["kind"] == FRAGMENT]
            hashes = _joined(rows, "hashes", "<u8")
            sigs = np.repeat(_joined(rows, "sigs", "<u8"), _joined(rows, "counts", "<u4"))
            rows.clear()
            order = np.argsort(hashes, kind="stable")
            ordered = hashes[order]
            same = ordered[1:] == ordered[:-1]
            twice = np.concatenate([same, [False]]) | np.concatenate([[False], same]) if len(ordered) else np.zeros(0, bool)
            hashes, sigs = ordered[twice], sigs[order[twice]]
            order = np.lexsort((sigs, hashes))
            hashes, sigs = hashes[order], sigs[order]
            new = np.ones(len(hashes), dtype=bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (sigs[1:] != sigs[:-1])
            hashes, sigs = hashes[new], sigs[new]
            _, back, often = np.unique(hashes, return_inverse=True, return_counts=True)
            often = often[back]
            hashes, sigs, often = hashes[often > 1], sigs[often > 1], often[often > 1]
            bucket = (sigs % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((sigs, bucket))
            hashes, sigs, often, bucket = hashes[order], sigs[order], np.minimum(often[order], _MOST), bucket[order]
            out = []
            for b in np.unique(bucket):
                i, j = np.searchsorted(bucket, [b, b + 1])
                new = np.flatnonzero(np.concatenate([[True], sigs[i + 1 : j] != sigs[i : j - 1]]))
                out.append(_row(
                    part=int(b) + (1 << 32), kind=SHARED, sigs=sigs[i:j][new].tobytes(), counts=np.diff(np.concatenate([new, [j - i]])).astype("<u4").tobytes(),
                    hashes=hashes[i:j].tobytes(), often=often[i:j].astype("<u2").tobytes()))
            if out:
                yield pa.RecordBatch.from_pylist(out, _ARROW)

    return run


_CLASSES = "cls bigint, n bigint, m bigint, prefix array<bigint>, pieces array<array<bigint>>"


def _need(n: np.ndarray, percent: int) -> np.ndarray:
    return -(-percent * n // 100)


def _classes(percent: int) -> Callable:
    """Rows sorted by bucket: the classes that share enough, their rarest hashes, and all shared ones in pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _parts(batches):
            listed = [r for r in rows if r["kind"] == CLASS]
            sigs, at = np.unique(_joined(listed, "sigs", "<u8"), return_index=True)
            n = _joined(listed, "sizes", "<u4").astype(np.int64)[at]
            shared = [r for r in rows if r["kind"] == SHARED]
            hashes = np.concatenate([_joined(listed, "hashes", "<u8"), _joined(shared, "hashes", "<u8")])
            owner = np.concatenate([np.repeat(_joined(x, "sigs", "<u8"), _joined(x, "counts", "<u4")) for x in (listed, shared)])
            hot = sum(len(r["hashes"]) for r in listed) // 8
            often = np.concatenate([np.full(hot, _MOST), _joined(shared, "often", "<u2")])
            rows.clear()
            owner = np.searchsorted(sigs, owner)
            order = np.lexsort((hashes, often, owner))
            hashes, owner = hashes[order], owner[order]
            new = np.ones(len(hashes), dtype=bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
            hashes, owner = hashes[new], owner[new]
            m = np.bincount(owner, minlength=len(sigs))
            need = _need(n, percent)
            good = m >= need
            take = good[owner]
            hashes, owner = hashes[take], owner[take]
            ids = np.flatnonzero(good)
            if not len(ids):
                continue
            m, n, need = m[ids], n[ids], need[ids]
            begin = np.concatenate([[0], np.cumsum(m)])
            rank = np.arange(len(hashes)) - np.repeat(begin[:-1], m)
            short = m - need + 1
            prefix = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(short)]), pa.int32()), pa.array(hashes[rank < np.repeat(short, m)].view(np.int64)))
            piece = np.repeat(np.arange(len(ids)), m) * PIECES + (hashes >> np.uint64(61)).astype(np.int64)
            inner = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(np.bincount(piece, minlength=len(ids) * PIECES))]), pa.int32()),
                pa.array(hashes[np.argsort(piece, kind="stable")].view(np.int64)))
            pieces = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * PIECES, pa.int32()), inner)
            yield pa.RecordBatch.from_arrays(
                [pa.array(sigs[ids].view(np.int64)), pa.array(n), pa.array(m), prefix, pieces], names=["cls", "n", "m", "prefix", "pieces"])

    return run


def frequent_hashes(docs: DataFrame, ngram: int) -> np.ndarray:
    """Hashes that a hundredth of a sample of documents has: at most a hundred times a document's size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                hashes, _ = ngrams(words_of(batch["text"], separator_table(SPACES), lower=True), ngram)
                values, counts = np.unique(hashes, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts)], names=["h", "c"])

    chosen = hash_sample(docs, F.col("mark"), SAMPLE_ROWS)
    sample = chosen.mapInArrow(run, "h bigint, c bigint")
    least = max(8, int(chosen.count() * FREQUENT))
    found = sample.groupBy("h").agg(F.sum("c").alias("c")).where(F.col("c") >= least).select("h")
    return np.sort(np.array([r["h"] for r in found.collect()], np.int64).view(np.uint64))


def _overlaps(pairs: DataFrame, classes: DataFrame, differences: bool = False) -> DataFrame:
    """``pairs`` (a, b, …) with the number ``o`` of n-grams in both, counted by piece and summed.

    With ``differences`` also, for each piece, the number ``d`` of n-grams in one of the two only, and a bit table
    ``s`` of 64 bits in which each of them sets one.
    """
    pieces = classes.select("cls", F.posexplode("pieces").alias("piece", "part"))
    left = pairs.select("a", "b").join(pieces.withColumnRenamed("cls", "a").withColumnRenamed("part", "mine"), "a")
    both = left.join(pieces.withColumnRenamed("cls", "b"), ["b", "piece"])
    sums = [F.sum(F.size(F.array_intersect("mine", "part"))).alias("o")]
    if differences:
        both = both.withColumn("only", F.concat(F.array_except("mine", "part"), F.array_except("part", "mine")))
        both = both.withColumn("bits", F.expr("aggregate(only, 0L, (s, h) -> s | shiftleft(1L, cast(h & 63 as int)))"))
        for i in range(PIECES):
            here = F.col("piece") == i
            sums += [F.max(F.when(here, F.size("only"))).alias(f"d{i}"), F.max(F.when(here, F.col("bits"))).alias(f"s{i}")]
    return pairs.join(both.groupBy("a", "b").agg(*sums), ["a", "b"])


def links_of(classes: DataFrame, percent: int) -> DataFrame:
    """Rows (a, b) of linked classes which connect all that is connected."""
    rows = classes.select("cls", "n", "m", F.explode("prefix").alias("h"))
    own = F.struct(((F.col("n") - F.col("m")) / F.col("n")).alias("own"), "cls", "n", "m")
    pivots = rows.groupBy("h").agg(F.count("*").alias("c"), F.min(own).alias("p")).where("c > 1")
    pivots = pivots.select("h", F.col("p.cls").alias("b"), F.col("p.n").alias("nb"), F.col("p.m").alias("mb"))
    near = rows.join(pivots, "h").where("cls <> b").select(F.col("cls").alias("a"), "n", "m", "b", "nb", "mb").distinct()
    linked = F.expr(f"100 * o >= {percent} * (n + nb - o)")
    tested = written(_overlaps(near, classes, differences=True).withColumn("linked", linked), "pivot-pairs")

    # What two classes x and y with one pivot p can have in common: no more than each has of p, and of what is not in p; and
    # x.o + y.o - p + (differences from p that both have), of which two bit tables bound the number piece by piece.
    least = "least(x.o, y.o) + least(x.m - x.o, y.m - y.o)"
    both = " + ".join(f"shiftright(x.d{i} + y.d{i} - bit_count(x.s{i} ^ y.s{i}), 1)" for i in range(PIECES))
    reaches = " AND ".join(f"({bound}) * {100 + percent} >= {percent} * (x.n + y.n)" for bound in (least, f"x.o + y.o - x.mb + {both}"))
    x, y = tested.where("NOT linked").alias("x"), tested.alias("y")
    open_ = x.join(y, F.expr(f"x.b = y.b AND x.a <> y.a AND (y.linked OR x.a < y.a) AND {reaches}"))
    open_ = open_.select(F.col("x.a").alias("a"), F.col("y.a").alias("b"), F.col("x.n").alias("n"), F.col("y.n").alias("nb")).distinct()
    others = _overlaps(written(open_, "open-pairs"), classes).where(linked)
    return tested.where("linked").select("a", "b").union(others.select("a", "b"))


def similar(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ngram: int = NGRAM, percent: int = PERCENT,
    fragments: int | None = None,
) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id) of all documents.

    Two documents link when ``100 * common >= percent * union`` n-grams; ``component_id`` is the smallest id
    reachable over links. ``fragments`` are as many as shuffle partitions, if left out.
    """
    return _grouped(docs, doc_id, text, ngram, percent, fragments).select("doc_id", "n_shingles", "component_id")


def _grouped(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ngram: int = NGRAM, percent: int = PERCENT,
    fragments: int | None = None,
) -> DataFrame:
    """The rows of ``similar`` with a hash ``mark`` of the text, and what tells components of one smallest id apart (null: no n-grams)."""
    spark = docs.sparkSession
    fragments = fragments or int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(1, fragments // 4)
    docs = docs.select(exact(doc_id).cast("bigint").alias("doc_id"), exact(text).cast("string").alias("text"))
    docs = docs.withColumn("mark", F.xxhash64("text"))
    frequent = spark.sparkContext.broadcast(frequent_hashes(docs, ngram))
    cut = docs.mapInArrow(_cut(ngram, fragments, buckets, frequent), _ROWS)
    rows = written(cut.repartition("part").sortWithinPartitions("part").mapInArrow(_share(buckets), _ROWS), "ngram-rows")

    packed = rows.where(F.col("kind").isin(CLASS, SHARED)).repartition("part").sortWithinPartitions("part")
    classes = written(packed.mapInArrow(_classes(percent), _CLASSES), "ngram-classes")
    joined = components(links_of(classes, percent))

    known = rows.where(F.col("kind") == DOCUMENT).select("doc_id", "mark", F.col("n").alias("n_shingles"), F.when(F.expr("n > 0 AND doc_id IS NOT NULL"), F.col("sig")).alias("sig"))
    least = known.where("sig IS NOT NULL").groupBy("sig").agg(F.min("doc_id").alias("least"))
    of_component = least.join(joined.withColumnRenamed("node", "sig"), "sig").groupBy("component").agg(F.min("least").alias("least"))
    of_class = joined.join(of_component, "component").select(F.col("node").alias("sig"), "component", F.col("least").alias("joined"))
    least = least.join(of_class, "sig", "left").select(
        "sig", F.coalesce("component", "sig").alias("component"), F.coalesce("joined", "least").alias("component_id"))
    least = written(least, "ngram-components")  # with an exchange of its own the last join can split a hot class
    return known.join(least, "sig", "left").select(
        "doc_id", "mark", "n_shingles", "component", F.coalesce("component_id", "doc_id").alias("component_id"))


def first_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row per group of linked documents: the one of the smallest id.

    Rows with the same id and texts that don't link are different groups and stay. Of several rows of the smallest id in a group one
    stays, and of rows of one id without n-grams; rows without id stay all.
    """
    found = _grouped(docs, doc_id, text, **options)
    id_, mark, place = (fresh(docs.columns, c) for c in ("kept_id", "text_mark", "place"))
    kept = found.where("doc_id = component_id").groupBy(F.col("doc_id").alias(id_), "component").agg(F.min("mark").alias("kept_mark"))
    marked = docs.withColumn(mark, F.xxhash64(exact(text).cast("string")))
    stay = marked.join(kept, (exact(doc_id).cast("bigint") == F.col(id_)) & (F.col(mark) == kept["kept_mark"]), "left_semi")
    order = Window.partitionBy(exact(doc_id), F.col(mark)).orderBy(F.col(mark))
    single = stay.withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).drop(place, mark)
    return single.union(docs.where(exact(doc_id).isNull()))
