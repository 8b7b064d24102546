"""Links between sets of numbers that share a bucket, by comparison with pivots instead of all pairs.

In each bucket one *pivot* is compared with all other members; most links come from that. All that hang together by buckets are a *cluster*, and all
of it are compared with one more pivot, its *center*. Members x and y of a cluster that are in one component need no more. For the
others the differences from the center decide: they link only if ``|x - y| <= k * (|x| + |y|)`` with ``k = (100 - t) / (100 + t)``,
where ``x - y`` are the numbers in one of them only; and ``|x - y| = |x - p| + |y - p| - 2 * (common differences from p)``. So with
``v = |x - p| - k * |x|`` they need ``(v of x + v of y) / 2`` common differences, one at least, as both would link with p otherwise. A
difference that no other member has is common to no pair: with ``w = v - 2 * (differences that others have, too)`` a pair links only if ``v + w <= 0``
both ways round. A member goes when that fails with the least ``v`` and ``w`` of all other components; what goes leaves others with more
differences of their own. Near copies that are too far from their origin are mostly gone then, without any pair of them.

The few that stay are paired where they share a difference. Common ones come last in the order of differences, and of those a member stands only in as many
as leave enough behind them for a link. The pairs are decided by their common differences alone, which is exact.

No pair inside a bucket is left out, nor one of a cluster.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from showroom.llm.components import components
from showroom.llm.shared import join_heavy, written

#: Open members around a center that are paired without looking at their differences.
SMALL = 64


def forest(links: DataFrame) -> DataFrame:
    """Links (a, b) that connect what ``links`` connect: in every task, those that join two trees of a union-find."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict[int, int] = {}

        def top(x: int) -> int:
            while (y := above.get(x, x)) != x:
                above[x] = x = above.get(y, y)
            return x

        for batch in batches:
            kept = []
            for i, (a, b) in enumerate(zip(batch["a"].to_pylist(), batch["b"].to_pylist(), strict=True)):
                a, b = top(a), top(b)
                if a != b:
                    above[max(a, b)] = min(a, b)
                    kept.append(i)
            yield batch.take(pa.array(kept, pa.int64()))

    return links.mapInArrow(run, "a bigint, b bigint")


def _pairwise(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows (a, b, center, na, nb, o, only) for each of ``pairs`` (a, b, center) and each piece: the size of the overlap and, of centers, what is in one of the two only.

    Both meet by key at every size, so the work grows evenly.
    """
    left = pairs.join(sets.select(F.col("cls").alias("a"), F.col("n").alias("na"), "piece", F.col("part").alias("mine")).hint("merge"), "a")
    both = left.join(sets.select(F.col("cls").alias("b"), F.col("n").alias("nb"), "piece", "part").hint("merge"), ["b", "piece"])
    only = F.when(F.col("center"), F.concat(F.array_except("mine", "part"), F.array_except("part", "mine")))
    return both.select("a", "b", "center", "piece", "na", "nb", F.size(F.array_intersect("mine", "part")).alias("o"), only.alias("only"))


def _stars(buckets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (a, b) of members and the pivots of their buckets, and rows (cls, weight): how many members a class meets in its buckets.

    The pivot of a bucket is its member of the greatest weight, so buckets of one group mostly have one pivot, from the middle of it.
    """
    rows = buckets.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1")
    rows = written(join_heavy(buckets.select("key", "cls"), rows, "key", "rows").select("key", "cls", "rows"), "bucket-rows")
    weight = written(rows.groupBy("cls").agg(F.sum("rows").alias("weight")), "bucket-weights")
    pivots = rows.join(weight, "cls").groupBy("key").agg(F.max("rows").alias("rows"), F.max(F.struct("weight", "cls")).alias("p"))
    pivots = pivots.select("key", "rows", F.col("p.cls").alias("b"))
    stars = join_heavy(rows.select("key", "cls"), pivots, "key", "rows").where("cls <> b").select(F.col("cls").alias("a"), "b")
    return written(stars.distinct(), "bucket-stars"), weight


def _centers(stars: DataFrame, weight: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows (a, b) of the members and the center of each cluster: all that hang together by ``stars``.

    The center has at most twice the numbers of an average member, so differences from it are at most three times as many as the numbers of all.
    """
    hanging = written(components(forest(stars)).select(F.col("node").alias("cls"), F.col("component").alias("key")), "cluster-members")
    sizes = sets.where("piece = 0").select("cls", "n")
    named = written(hanging.join(sizes, "cls").join(weight, "cls"), "cluster-sizes")
    means = named.groupBy("key").agg(F.count("*").alias("rows"), F.avg("n").alias("mean"))
    fit = join_heavy(named, means.where("rows > 2"), "key", "rows").where("n <= 2 * mean")
    centers = fit.groupBy("key").agg(F.max(F.struct("weight", "cls")).alias("p"), F.max("rows").alias("rows")).select("key", "rows", F.col("p.cls").alias("b"))
    return join_heavy(hanging, centers, "key", "rows").where("cls <> b").select(F.col("cls").alias("a"), "b")


def _least_of_others(members: DataFrame) -> DataFrame:
    """``members`` (b, a, comp, v, w, …) of centers around which are several components, with the least ``v`` and ``w`` in other components than their own."""
    groups = written(members.groupBy("b", "comp").agg(F.count("*").alias("rows"), F.min("v").alias("v"), F.min("w").alias("w")), "open-components")
    first = groups.groupBy("b").agg(
        F.sum("rows").alias("rows"), F.count("*").alias("c"), F.min(F.struct("v", "comp")).alias("v1"), F.min(F.struct("w", "comp")).alias("w1")).where("c > 1")
    second = groups.select("b", "comp", "v", "w").join(first, "b").groupBy("b").agg(
        F.max("rows").alias("rows"), F.first("v1").alias("v1"), F.first("w1").alias("w1"),
        F.min(F.when(F.col("comp") != F.col("v1.comp"), F.col("v"))).alias("v2"), F.min(F.when(F.col("comp") != F.col("w1.comp"), F.col("w"))).alias("w2"))
    found = join_heavy(members, second, "b", "rows")
    return found.withColumn("v_other", F.expr("IF(comp = v1.comp, v2, v1.v)")).withColumn("w_other", F.expr("IF(comp = w1.comp, w2, w1.w)")).drop(
        "v1", "v2", "w1", "w2", "rows")


def _open(members: DataFrame, percent: int) -> DataFrame:
    """The ``members`` (b, a, comp, n, d, lone) that can link with one of another component around their center, with ``least``, the fewest differences it takes to have in common."""
    twice = 2 * (100 + percent)
    named = members.select("b", "a", "comp", "n", "d", "lone").withColumn("v", F.expr(f"{100 + percent} * d - {100 - percent} * n"))
    named = _least_of_others(named.withColumn("w", F.expr(f"v - {twice} * (d - lone)")))
    kept = named.where("v + w_other <= 0 AND w + v_other <= 0")
    return written(kept.withColumn("least", F.expr(f"greatest(1, ceil((v + v_other) / {twice}))")).drop("v_other", "w_other"), "open-members")


def _differences(members: DataFrame, parts: DataFrame) -> DataFrame:
    """Rows (b, a, item) of the differences of ``members`` from their center."""
    return members.select("a").join(parts, "a").select("b", "a", F.explode("only").alias("item"))


def _still_open(members: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """``_open`` with the differences that no other open member has (``lone``) counted, again while a tenth of the members goes."""
    open_ = _open(members.withColumn("lone", F.lit(0).cast("bigint")), percent)
    count = open_.count()
    while count:
        lone = _differences(open_, parts).groupBy("b", "item").agg(F.count("*").alias("c"), F.min("a").alias("a")).where("c = 1")
        lone = written(lone.groupBy("a").agg(F.count("*").alias("lone")), "open-lone")
        open_ = _open(open_.drop("lone").join(lone, "a", "left").fillna(0, ["lone"]), percent)
        before, count = count, open_.count()
        if 10 * count > 9 * before:
            break
    return open_


def _pairs(open_: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """Rows (a, b, d, n) of the open members of different components that can link: the sums of their distances from the center and of their sizes.

    Around centers of more than ``SMALL`` they share one of the differences that are first by frequency and leave enough behind it.
    """
    sizes = open_.groupBy("b").agg(F.count("*").alias("rows"))
    open_ = written(join_heavy(open_, sizes, "b", "rows"), "open-sizes")
    twice = 2 * (100 + percent)
    two = [F.col("x.a").alias("a"), F.col("y.a").alias("b"), F.expr("x.d + y.d").alias("d"), F.expr("x.n + y.n").alias("n")]
    differ = "x.a < y.a AND x.comp <> y.comp AND x.v + y.w <= 0 AND y.v + x.w <= 0"
    small, large = open_.where(F.col("rows") <= SMALL), open_.where(F.col("rows") > SMALL)
    pairs = small.alias("x").join(small.alias("y"), F.expr(f"x.b = y.b AND {differ}")).select(*two)
    if large.isEmpty():
        return pairs
    items = written(_differences(large, parts).join(large.select("a", "comp"), "a"), "open-differences")
    counts = items.groupBy("b", "item").agg(F.count("*").alias("c"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
    shared = items.select("b", "item", "a").join(written(counts.select("b", "item", "c"), "open-counts"), ["b", "item"])
    mine = Window.partitionBy("a")
    ranked = shared.withColumn("place", F.row_number().over(mine.orderBy("c", "item"))).withColumn("all", F.count("*").over(mine))
    first = ranked.withColumn("after", F.expr("all - place + 1")).select("item", "a", "after")
    first = written(first.join(large, "a").where("after >= least"), "open-items")
    reaches = f"x.v + y.v <= {twice} * least(x.after, y.after)"
    met = first.alias("x").join(first.alias("y"), F.expr(f"x.b = y.b AND x.item = y.item AND {differ} AND {reaches}")).select(*two)
    return pairs.union(met.distinct())


def connected(buckets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Rows (node, component) of the linked classes in ``buckets`` (key, cls): the smallest class reachable.

    ``sets`` has the distinct numbers of a class as rows (cls, n, piece, part): their number, and for each piece of their range those in it.
    Classes link when ``100 * common >= percent * union``.
    """
    stars, weight = _stars(buckets)
    both = stars.withColumn("center", F.lit(False)).union(_centers(stars, weight, sets).withColumn("center", F.lit(True)))
    near = written(both.groupBy("a", "b").agg(F.max("center").alias("center")), "pivot-near")
    parts = written(_pairwise(near, sets), "pivot-parts")
    sums = [F.max("na").alias("na"), F.max("nb").alias("nb"), F.sum("o").alias("o")]
    pairs = written(parts.groupBy("a", "b", "center").agg(*sums), "pivot-pairs")
    links = written(forest(pairs.where(f"100 * o >= {percent} * (na + nb - o)").select("a", "b")), "pivot-links")
    joined = written(components(links), "pivot-components")

    members = pairs.where("center").join(joined.select(F.col("node").alias("a"), "component"), "a", "left")
    members = members.select("b", "a", F.coalesce("component", "a").alias("comp"), F.col("na").alias("n"), F.expr("na + nb - 2 * o").alias("d"))
    members = written(members, "center-members")
    parts = parts.where("center").select("b", "a", "piece", "only")
    open_ = _still_open(members, parts, percent)
    if open_.isEmpty():
        return joined
    parts = written(parts.join(open_.select("a"), "a", "left_semi").select("a", "piece", "only"), "open-parts")
    beside = written(_pairs(open_, parts.join(open_.select("a", "b"), "a"), percent), "open-pairs").join(parts.withColumnRenamed("only", "mine"), "a")
    beside = beside.join(parts.withColumnRenamed("a", "b"), ["b", "piece"])
    common = beside.groupBy("a", "b", "d", "n").agg(F.sum(F.size(F.array_intersect("mine", "only"))).alias("c"))
    more = common.where(f"{100 + percent} * (d - 2 * c) <= {100 - percent} * n").select("a", "b")
    return components(forest(links.union(more)))
