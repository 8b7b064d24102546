"""Train / valid / test splits. Every split is a column ``split`` on the rows.

Random order is the hash of a unique id and a seed: the same on every run and independent of the
partitioning. A stratum is never gathered in one task. The row at which a part ends is found in two
narrow passes: counts per hash bucket locate the bucket that holds it, and only the rows of that
bucket are ranked. Wide rows are then labelled by comparing their hash with the cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from showroom import vocab as v
from showroom.functions.cells import as_time, micros, named, one_row
from showroom.operators.ordering import exact_quantiles
from showroom.session import stored_lookup, cut_lineage

TRAIN, VALID, TEST = "train", "valid", "test"
SPLIT = "split"
BUCKET_SHIFT = 48  # the 16 top bits of the hash: 65,536 buckets
DEFAULT_RATIOS = (0.70, 0.15, 0.15)
Sizes = Callable[[Column], list[tuple[str, Column]]]


# --- sizes of the parts of a stratum with n rows --------------------------------------


def two_way_sizes(test_ratio: float, rounding: str = "nearest") -> Sizes:
    """Test part first: nearest whole number or floor of n·ratio."""
    whole = F.rint if rounding == "nearest" else F.floor
    return lambda n: [(TEST, whole(n * F.lit(float(test_ratio))).cast("bigint")), (TRAIN, n)]


def three_way_sizes(ratios: tuple[float, float, float]) -> Sizes:
    """Every part gets at least one row when the stratum has three or more."""

    def ends(n: Column) -> list[tuple[str, Column]]:
        one = F.lit(1).cast("bigint")
        at_least = lambda r: F.greatest(one, F.rint(n * F.lit(float(r))).cast("bigint"))
        train = F.when(n >= 3, at_least(ratios[0])).otherwise(F.greatest(one, n - 2))
        valid = F.when(n >= 3, F.least(train + at_least(ratios[1]), n - 1)).otherwise(
            F.least(n, train + 1))
        return [(TRAIN, train), (VALID, valid), (TEST, n)]

    return ends


# --- random splits --------------------------------------------------------------------


def shuffle_key(row_id: str, seed: int) -> Column:
    return F.xxhash64(named(row_id), F.lit(seed))


def _cuts(df: DataFrame, stratum: str, row_id: str, seed: int, sizes: Sizes) -> DataFrame:
    """Per stratum the (hash, id) of the last row of every part but the final one."""
    key = shuffle_key(row_id, seed)
    rows = df.select(
        named(stratum).alias("__stratum"), named(row_id).alias("__id"), key.alias("__hash"),
        F.shiftright(key, BUCKET_SHIFT).alias("__bucket"),
    )
    # At most 65,536 rows per stratum.
    buckets = rows.groupBy("__stratum", "__bucket").agg(F.count("*").alias("__n"))
    whole = Window.partitionBy("__stratum")
    earlier = whole.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = buckets.withColumns({
        "__before": F.coalesce(F.sum("__n").over(earlier), F.lit(0)),
        "__total": F.sum("__n").over(whole),
    })
    ends = sizes(F.col("__total"))[:-1]
    marks = F.explode(F.array(*[
        F.struct(F.lit(name).alias("part"), end.alias("end")) for name, end in ends]))
    at = placed.withColumn("__m", marks).select("*", "__m.part", "__m.end").drop("__m")
    holding = at.where((F.col("end") > F.col("__before")) & (F.col("end") <= F.col("__before") + F.col("__n")))
    # At most one row per stratum and cut.
    holding = holding.select(
        F.col("__stratum").alias("s"), F.col("__bucket").alias("b"), "part",
        (F.col("end") - F.col("__before")).alias("nth"))
    inside = rows.join(
        stored_lookup(holding), F.col("__stratum").eqNullSafe(F.col("s")) & (F.col("__bucket") == F.col("b")))
    order = Window.partitionBy("s", "b", "part").orderBy("__hash", "__id")
    last = inside.withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") == F.col("nth"))
    point = F.struct("__hash", "__id")
    return last.groupBy(F.col("s").alias("__s")).agg(
        *[F.max(F.when(F.col("part") == name, point)).alias(f"__cut_{name}") for name, _ in ends]
    )


def _labelled(df: DataFrame, row_id: str, sizes: Sizes, seed: int, names: list[str]) -> DataFrame:
    """Name the part of every row from the cut columns next to it."""
    here = F.struct(shuffle_key(row_id, seed).alias("__hash"), named(row_id).alias("__id"))
    split = F.lit(sizes(F.lit(0))[-1][0])
    for name in reversed(names):
        split = F.when(here <= F.col(f"__cut_{name}"), name).otherwise(split)
    return df.withColumn(SPLIT, split).drop(*[f"__cut_{n}" for n in names])


def stratified_split(
    df: DataFrame, target: str, row_id: str, sizes: Sizes, seed: int = 42, drop_null_target: bool = False
) -> DataFrame:
    """Exact part sizes per class of ``target``; ``row_id`` must be unique."""
    if drop_null_target:
        df = df.where(named(target).isNotNull())
    cuts = stored_lookup(_cuts(df, target, row_id, seed, sizes))
    names = [c.removeprefix("__cut_") for c in cuts.columns if c != "__s"]
    joined = df.join(cuts, named(target).eqNullSafe(F.col("__s")), "left").drop("__s")
    return _labelled(joined, row_id, sizes, seed, names)


def simple_split(df: DataFrame, row_id: str, sizes: Sizes, seed: int = 42) -> DataFrame:
    """One stratum: all rows."""
    cuts = _cuts(df.withColumn("__all", F.lit(0)), "__all", row_id, seed, sizes).drop("__s")
    names = [c.removeprefix("__cut_") for c in cuts.columns]
    found = one_row(cuts)
    return _labelled(df.withColumns({c: found[c] for c in cuts.columns}), row_id, sizes, seed, names)


def random_split(
    df: DataFrame, target: str | None, row_id: str = v.LEAD_ID, test_ratio: float = 0.2,
    seed: int = 42, rounding: str = "nearest",
) -> DataFrame:
    """Two-way split, stratified when the target exists."""
    sizes = two_way_sizes(test_ratio, rounding)
    if target is None or target not in df.columns:
        return simple_split(df, row_id, sizes, seed)
    return stratified_split(df, target, row_id, sizes, seed, drop_null_target=True)


def holdout_split(
    df: DataFrame, target: str, row_id: str = v.LEAD_ID, test_size: float = 0.2, seed: int = 42,
    stratify: bool = True,
) -> DataFrame:
    """Train/test through the three-way rule; the one-row valid part of a class is left out."""
    df = df.where(named(target).isNotNull())
    if not stratify:
        return simple_split(df, row_id, two_way_sizes(test_size), seed)
    sizes = three_way_sizes((1 - test_size, 0.0, test_size))
    return stratified_split(df, target, row_id, sizes, seed).where(F.col(SPLIT) != VALID)


# --- grouped split --------------------------------------------------------------------

NOT_A_VALUE = ["", "nan", "None", "null"]


def group_key(df: DataFrame, lead_id: str = v.LEAD_ID) -> Column:
    """``phone::…`` where a phone is known, else ``lead::…``."""
    phone_column = next((c for c in (v.PHONE, "手机号") if c in df.columns), None)
    lead = F.concat(F.lit("lead::"), F.trim(F.coalesce(named(lead_id).cast("string"), F.lit(""))))
    if phone_column is None:
        return lead
    phone = F.trim(F.coalesce(named(phone_column).cast("string"), F.lit("")))
    return F.when(~phone.isin(NOT_A_VALUE), F.concat(F.lit("phone::"), phone)).otherwise(lead)


def dominant_label(df: DataFrame, group: str, target: str) -> DataFrame:
    """Most frequent label per group, ties by label. Both steps combine before the shuffle, so a
    group that holds a third of all rows stays cheap."""
    counts = df.groupBy(named(group).alias(group), named(target).alias(target)).agg(F.count("*").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("less"), named(target).isNull().alias("no"), named(target).alias("label")))
    return counts.groupBy(group).agg(best.alias("b")).select(group, F.col("b.label").alias(target))


def group_split(
    df: DataFrame, target: str, lead_id: str = v.LEAD_ID, ratios: tuple[float, float, float] = DEFAULT_RATIOS,
    seed: int = 42, group: str = "split_group_key", keep_key: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Groups never straddle parts. Returns the labelled rows and the table (group, split)."""
    keyed = df.withColumn(group, group_key(df, lead_id))
    groups = cut_lineage(dominant_label(keyed, group, target))
    assigned = stratified_split(groups, target, group, three_way_sizes(ratios), seed).select(group, SPLIT)
    rows = keyed.join(assigned, group)
    return (rows if keep_key else rows.drop(group)), assigned


def group_fingerprint(assigned: DataFrame, group: str = "split_group_key") -> dict:
    """Group counts per part and a 16-digit fingerprint that does not depend on row order."""
    hashed = F.xxhash64(named(group)).cast("decimal(38,0)")
    rows = assigned.groupBy(SPLIT).agg(F.count("*").alias("n"), F.sum(hashed).alias("h")).collect()
    found = {r[SPLIT]: (r["n"], int(r["h"])) for r in rows}
    parts = [(p, *found.get(p, (0, 0))) for p in (TRAIN, VALID, TEST)]
    text = "|".join(f"{p}:{n}:{h}" for p, n, h in parts)
    return {
        "group_counts": {p: n for p, n, _ in parts},
        "group_key_fingerprint": hashlib.sha1(text.encode()).hexdigest()[:16],
    }


# --- time splits ----------------------------------------------------------------------


def _moment(value) -> Column:
    return F.lit(value).cast("timestamp") if not isinstance(value, Column) else value.cast("timestamp")


def time_split(df: DataFrame, cutoff, time: str = v.CREATED) -> DataFrame:
    """Before the cut-off: train. From it on: test. Rows without a time are dropped."""
    t = as_time(df, time)
    return df.where(t.isNotNull()).withColumn(SPLIT, F.when(t < _moment(cutoff), TRAIN).otherwise(TEST))


def time_split_three(df: DataFrame, train_end, valid_end, time: str = v.CREATED) -> DataFrame:
    t = as_time(df, time)
    part = F.when(t < _moment(train_end), TRAIN).when(t < _moment(valid_end), VALID).otherwise(TEST)
    return df.where(t.isNotNull()).withColumn(SPLIT, part)


def require_parts(df: DataFrame, parts: tuple[str, ...]) -> DataFrame:
    """Error when a part is empty; one row per part comes back."""
    found = {r[SPLIT] for r in df.groupBy(SPLIT).agg(F.lit(1)).collect()}
    empty = [p for p in parts if p not in found]
    if empty:
        raise ValueError(f"empty parts: {empty}")
    return df


def part_ranges(df: DataFrame, time: str = v.CREATED, target: str | None = None) -> DataFrame:
    """Rows, first and last time, and optionally the class counts of every part."""
    keys = [SPLIT] + ([target] if target else [])
    t = as_time(df, time)
    return df.groupBy(*[named(k).alias(k) for k in keys]).agg(
        F.count("*").alias("n"), F.min(t).alias("first_time"), F.max(t).alias("last_time"))


def time_span(df: DataFrame, time: str = v.CREATED) -> tuple[datetime | None, datetime | None]:
    t = as_time(df, time)
    row = df.agg(F.min(micros(t)).alias("a"), F.max(micros(t)).alias("b")).first()
    at = lambda us: None if us is None else datetime(1970, 1, 1) + timedelta(microseconds=us)
    return at(row["a"]), at(row["b"])


def auto_cutoff(first: datetime, last: datetime, test_ratio: float) -> date:
    """Day that leaves ``test_ratio`` of the span after it."""
    return (first + (last - first) * (1 - test_ratio)).date()


def auto_split(
    df: DataFrame, target: str | None, row_id: str = v.LEAD_ID, time: str = v.CREATED,
    test_ratio: float = 0.2, min_days: int = 30, seed: int = 42,
) -> tuple[DataFrame, dict]:
    """By time when the span is long enough, else at random."""
    first, last = time_span(df, time) if time in df.columns else (None, None)
    span = (last - first).days if first else 0
    if first and span >= min_days:
        cutoff = auto_cutoff(first, last, test_ratio)
        return time_split(df, str(cutoff), time), {"mode": "oot", "cutoff": str(cutoff), "span_days": span}
    return random_split(df, target, row_id, test_ratio, seed), {"mode": "random", "span_days": span}


def smart_split(
    df: DataFrame, target: str, time: str = v.CREATED, lead_id: str = v.LEAD_ID, split_mode: str = "auto",
    min_oot_days: int = 14, auto_oot_min_days: int | None = None, seed: int = 42,
) -> tuple[DataFrame, dict]:
    """Three-way split by time when the span allows it, else grouped random.

    The metadata is small; the ids of the test part stay a table (``test_ids``).
    """
    if split_mode == "manual_oot":
        raise ValueError("manual_oot needs train_end and valid_end: call time_split_three")
    df = df.where(named(target).isNotNull())
    limit = auto_oot_min_days if auto_oot_min_days is not None else min_oot_days
    first, last = time_span(df, time) if time in df.columns else (None, None)
    span = (last - first).days if first else 0
    info = {"span_days": span, "min_date": str(first) if first else None, "max_date": str(last) if last else None,
            "id_column": lead_id}
    if split_mode != "random" and first and span >= limit:
        cut = lambda share: str((first + (last - first) * share).date())
        info |= {"mode": "oot", "train_end": cut(0.70), "valid_end": cut(0.85)}
        return time_split_three(df, info["train_end"], info["valid_end"], time), info
    rows, assigned = group_split(df, target, lead_id, seed=seed)
    info |= {"mode": "random", "split_group_mode": "phone_or_lead", **group_fingerprint(assigned)}
    return rows, info


def test_ids(df: DataFrame, lead_id: str = v.LEAD_ID) -> DataFrame:
    return df.where(F.col(SPLIT) == TEST).select(named(lead_id))


def time_quantile(df: DataFrame, share: float = 0.8, time: str = v.CREATED) -> datetime:
    """Exact quantile of the time column, interpolated to the microsecond."""
    t = df.select(micros(as_time(df, time)).alias("t"))
    base = t.agg(F.min("t").alias("m")).first()["m"]
    value = exact_quantiles(t.select((F.col("t") - F.lit(base)).alias("t")), ["t"], [share]).first()
    return datetime(1970, 1, 1) + timedelta(microseconds=base + int(value["quantile"]))


def unified_split(
    df: DataFrame, cutoff=None, time: str = v.CREATED, driven: str = v.DRIVEN
) -> tuple[DataFrame, DataFrame]:
    """Full rows and driven rows under one cut-off (default: the 0.8 quantile of time)."""
    full = time_split(df, cutoff if cutoff is not None else time_quantile(df, 0.8, time), time)
    return full, full.where(named(driven).isNotNull())


def parts(df: DataFrame) -> dict[str, DataFrame]:
    return {p: df.where(F.col(SPLIT) == p).drop(SPLIT) for p in (TRAIN, VALID, TEST)}


def given_parts(train: DataFrame, test: DataFrame, valid: DataFrame | None = None) -> DataFrame:
    """Parts that come as tables of their own win over any automatic split."""
    named_parts = [(TRAIN, train), (TEST, test)] + ([(VALID, valid)] if valid is not None else [])
    labelled = [d.withColumn(SPLIT, F.lit(p)) for p, d in named_parts]
    out = labelled[0]
    for part in labelled[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def isolate_test(df: DataFrame, info: dict, recorded_ids: DataFrame | None = None, time: str = v.CREATED) -> DataFrame:
    """The rows a model has not seen: after ``valid_end``, or the recorded ids."""
    if info.get("mode") in ("oot", "oot_manual"):
        return df.where(as_time(df, time) >= _moment(info["valid_end"]))
    if info.get("mode") == "random":
        if recorded_ids is None:
            raise ValueError("a random split is replayed by its recorded test ids")
        return df.join(recorded_ids.distinct(), info["id_column"], "left_semi")
    raise ValueError(f"unknown split mode: {info.get('mode')}")


def check_disjoint(train: DataFrame, test: DataFrame, lead_id: str = v.LEAD_ID) -> None:
    shared = test.select(named(lead_id)).join(train.select(named(lead_id)), lead_id, "left_semi")
    if not shared.isEmpty():
        raise ValueError("test ids occur in the training part")
