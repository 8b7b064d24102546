"""Near duplicates by SuperMinHash signatures, bands, verification and union-find.

A document is the set of its distinct word shingles, as 64-bit hashes; documents of equal sets are one *class*. SuperMinHash gives every shingle
a random permutation of the slots, drawn step by step, and writes ``step + random`` into the slot of each step; a slot keeps its
least value. The ranks of one shingle differ from slot to slot, which lowers the variance of the share of equal slots. Once all slots of a
document are below a step, later steps cannot change it and are left out; a document of many shingles takes two or three steps.

Signatures are cut into bands; classes with an equal band are candidates. At the similarity asked for, a pair shares none of 25 bands of
5 slots with a chance of 4 in ten million. Candidates are verified on their full sets, against pivots (see ``pivots``): no pair of one band is
left out, and few but with pivots are formed. The texts of candidates, and no others, are read again for that. Links join trees of
a union-find in each task; what remains is joined by alternating stars (see ``components``).

Defined cases: a text with fewer words than a shingle is one shingle; null, empty and blank texts have none and link with nothing; a row
without id takes no part in links, and its component is null; repeated rows are rows of one class; rows of one id share its component only if
their texts link; ``kept`` holds where id and component agree; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from showroom.llm.hashing import mix
from showroom.llm.jaccard_join import ngrams, signatures
from showroom.llm.pivots import connected
from showroom.llm.shared import exact, join_heavy, written
from showroom.llm.words import SPACES, separator_table, slices, words_of

SHINGLE = 3
PERCENT = 85
BANDS = 25
ROWS = 5
#: Pieces of the hash range in which sets are stored and compared.
PIECES = 8
#: Bits of a hash that choose a word of 64 bits in the table of texts that are read again: 262,144 words at most.
WORD_BITS = 18
#: Shingles whose permutations are held at once.
BLOCK = 1 << 16


def super_minhash(hashes: np.ndarray, bounds: np.ndarray, slots: int) -> np.ndarray:
    """Signatures of sets of hashes, one row each; set i has those from ``bounds[i]`` to ``bounds[i + 1]``. An empty set keeps infinities."""
    out = np.full((len(bounds) - 1, slots), np.inf)
    flat = out.reshape(-1)
    owner = np.repeat(np.arange(len(out)), np.diff(bounds))
    for start in range(0, len(hashes), BLOCK):
        x, of = hashes[start : start + BLOCK], owner[start : start + BLOCK]
        order = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint32), (len(x), 1))
        here = np.arange(of[0], of[-1] + 1)
        on = np.arange(len(x))
        for step in range(slots):
            open_ = out[here].max(axis=1) > step  # a value of this step or a later one can still be the least of a slot
            on = on[open_[of[on] - here[0]]]
            if not len(on):
                break
            drawn = mix(x[on], step)
            other = step + ((drawn & np.uint64(0xFFFFFFFF)) * np.uint64(slots - step) >> np.uint64(32)).astype(np.int64)
            slot = order[on, other]
            order[on, other] = order[on, step]
            np.minimum.at(flat, of[on] * slots + slot, step + (drawn >> np.uint64(32)) / 2.0**32)
    return out


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band, bands first."""
    values = signature.view(np.uint64).reshape(-1, bands, rows)
    keys = np.empty((bands, len(signature)), np.uint64)
    for b in range(bands):
        key = np.full(len(signature), b, np.uint64)
        for r in range(rows):
            key = mix(key ^ values[:, b, r], r)
        keys[b] = key
    return keys


def _signed(shingle: int, bands: int, rows: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each document's set by its hash; of each different set of a slice also the bands."""
        table_ = separator_table(SPACES)
        for whole in batches:
            for batch in slices(whole, "text"):
                hashes, bounds = ngrams(words_of(batch["text"], table_, lower=True), shingle)
                size, sigs = np.diff(bounds), signatures(hashes, bounds)
                first = np.zeros(len(size), dtype=bool)
                first[np.unique(sigs, return_index=True)[1]] = True
                first &= size > 0
                kept = np.concatenate([[0], np.cumsum(size[first])])
                keys = band_keys(super_minhash(hashes[np.repeat(first, size)], kept, bands * rows), bands, rows)
                lists = np.zeros((len(size), bands), np.int64)
                lists[first] = keys.T.view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"], batch["mark"], pa.array(size), pa.array(sigs.view(np.int64), mask=size == 0),
                     *[pa.array(lists[:, b], mask=~first) for b in range(bands)]],
                    names=["doc_id", "mark", "n", "sig", *[f"band{b}" for b in range(bands)]])

    return run


def _sets(shingle: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The sets of texts in pieces, once for each set of a slice."""
        for whole in batches:
            for batch in slices(whole, "text"):
                hashes, bounds = ngrams(words_of(batch["text"], separator_table(SPACES), lower=True), shingle)
                sigs = signatures(hashes, bounds)
                first = np.sort(np.unique(sigs, return_index=True)[1])
                take = np.zeros(len(sigs), dtype=bool)
                take[first] = True
                size = np.diff(bounds)
                hashes, size = hashes[np.repeat(take, size)], size[take]
                # Sorted hashes: a piece is a range of them.
                piece = np.repeat(np.arange(len(size)), size) * PIECES + (hashes >> np.uint64(61)).astype(np.int64)
                cuts = np.concatenate([[0], np.cumsum(np.bincount(piece, minlength=len(size) * PIECES))])
                inner = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(hashes.view(np.int64)))
                pieces = pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1) * PIECES, pa.int32()), inner)
                yield pa.RecordBatch.from_arrays([pa.array(sigs[take].view(np.int64)), pa.array(size), pieces], names=["cls", "n", "pieces"])

    return run


def of_marks(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """``docs`` whose hash ``mark`` is in ``needed``. A bit table of bounded size is broadcast, so that few others have to move."""
    word, bit = F.shiftrightunsigned("mark", 64 - WORD_BITS).alias("word"), "shiftleft(1L, cast(mark & 63 as int))"
    words = written(needed.select(word, F.expr(bit).alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")), "dedup-words")
    maybe = docs.withColumn("word", word).join(F.broadcast(words), "word").where(f"bits & {bit} <> 0").drop("word", "bits")
    return maybe.join(needed.distinct().hint("merge"), "mark")  # Spark would move a semi-join before the look-up in the table


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS,
) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept) of all documents.

    Documents link when ``100 * common >= percent * union`` shingles; ``component_id`` is the smallest id reachable over links.
    """
    docs = docs.select(exact(doc_id).cast("bigint").alias("doc_id"), exact(text).cast("string").alias("text"))
    docs = docs.withColumn("mark", F.xxhash64("doc_id", "text"))
    names = [f"band{b}" for b in range(bands)]
    schema = ", ".join(["doc_id bigint, mark bigint, n bigint, sig bigint", *[f"{b} bigint" for b in names]])
    known = written(docs.mapInArrow(_signed(shingle, bands, rows), schema), "dedup-documents")
    classes = known.where("sig IS NOT NULL").groupBy("sig").agg(
        F.count("doc_id").alias("rows"), F.min("doc_id").alias("least"), F.min("mark").alias("mark"), *[F.max(b).alias(b) for b in names])
    classes = written(classes.where("rows > 0"), "dedup-classes")
    keyed = written(classes.select(F.col("sig").alias("cls"), F.explode(F.array(*names)).alias("key")), "dedup-bands")
    common = keyed.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1")
    buckets = written(join_heavy(keyed, common, "key", "rows").select("key", "cls"), "dedup-buckets")

    needed = classes.select("mark", F.col("sig").alias("cls")).join(buckets.select("cls").distinct(), "cls", "left_semi")
    texts = of_marks(docs, written(needed.select("mark"), "dedup-needed")).select("text")
    sets = texts.mapInArrow(_sets(shingle), "cls bigint, n bigint, pieces array<array<bigint>>").dropDuplicates(["cls"])
    sets = written(sets.select("cls", "n", F.posexplode("pieces").alias("piece", "part")), "dedup-sets")
    return with_component(known, classes, connected(buckets, sets, percent))


def with_component(known: DataFrame, classes: DataFrame, joined: DataFrame) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept) of ``known`` (doc_id, n, sig), ``classes`` (sig, rows, least) and components (node, component) of classes."""
    named = classes.select("sig", "rows", "least").join(joined.withColumnRenamed("node", "sig"), "sig", "left")
    least = named.where("component IS NOT NULL").groupBy("component").agg(F.min("least").alias("joined"))
    named = named.join(least, "component", "left").select("sig", "rows", F.coalesce("joined", "least").alias("component_id"))
    # A class of one row that links with nothing is its own component.
    named = named.join(classes.select("sig", "least"), "sig").where("rows > 1 OR component_id <> least").select("sig", "rows", "component_id")
    part = known.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.col("sig")).alias("sig"))
    found = join_heavy(part, named, "sig", "rows", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
