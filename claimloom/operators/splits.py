"""Train/test splits, folds and samples that do not leak between people.

A split is decided by hash cut points, found once; applying it is a projection,
so rows are neither sorted nor joined.
"""

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom import settings as S
from claimloom.functions.ranks import exact_quantiles, hash_cut_table, hash_cuts, hash_of, number_copies
from claimloom.functions.skew import broadcast_if_small
from claimloom.functions.storage import as_table, cut

# A key above this share of the rows is placed on its own; there are at most 100.
HEAVY_SHARE = 1 / 100


def key_hash(key: str, seed: int) -> Column:
    return hash_of(F.col(key).cast("string"), seed=seed)


def _first(share: float):
    """Target: the first ``ceil(share * total)`` units."""
    return lambda total: [F.ceil(F.lit(share) * total)]


def group_split(
    frame: DataFrame,
    key: str = S.GROUP_KEY,
    share: float = S.TEST_SHARE,
    seed: int = S.SEED,
    exact: bool = True,
) -> DataFrame:
    """Add ``fold``: exactly ``ceil(share * keys)`` keys are 'test', the rest 'train'.

    With ``exact=False`` the hash space itself is cut, which needs no pass over
    the data and gives the share only in expectation.
    """
    if exact:
        keys = frame.select(key).distinct().select(
            key_hash(key, seed).alias("h"), F.lit(1).alias("w")
        )
        cuts = hash_cuts(cut(keys), "h", "w", _first(share))
        edge = cuts[None][0] if cuts else ""
    else:
        edge = f"{min(int(share * 16**8), 16**8 - 1):08x}"
    in_test = key_hash(key, seed) <= F.lit(edge)
    return frame.withColumn("fold", F.when(in_test, F.lit("test")).otherwise(F.lit("train")))


def split_by_beneficiary(
    frame: DataFrame, test_size: float = S.TEST_SHARE, seed: int = S.SEED
) -> tuple[DataFrame, DataFrame]:
    """``(train, test)`` sharing no person."""
    folds = group_split(frame, S.GROUP_KEY, test_size, seed)
    return (
        folds.filter("fold = 'train'").drop("fold"),
        folds.filter("fold = 'test'").drop("fold"),
    )


def group_kfold(
    frame: DataFrame, key: str = S.GROUP_KEY, k: int = 3, seed: int = S.SEED
) -> DataFrame:
    """Add ``fold`` 0..k-1: each key in one fold, folds nearly even in rows.

    The few heavy keys go to the lightest fold one by one; the others fill the
    folds up in hash order.
    """
    counts = cut(frame.groupBy(key).agg(F.count(F.lit(1)).alias("w")))
    total = counts.agg(F.sum("w")).first()[0] or 0
    is_heavy = F.col("w") > HEAVY_SHARE * total
    heavy = sorted(counts.filter(is_heavy).collect(), key=lambda r: (-r.w, r[key]))
    loads, placed = [0] * k, {}
    for row in heavy:
        lightest = loads.index(min(loads))
        placed[row[key]] = lightest
        loads[lightest] += row.w
    rest = total - sum(loads)
    room = _room(loads, rest)
    targets = [math.ceil(sum(room[: i + 1])) for i in range(k - 1)]
    light = counts.filter(~is_heavy).select(key_hash(key, seed).alias("h"), "w")
    # A target of zero or less leaves its fold without light keys.
    cuts = hash_cuts(light, "h", "w", lambda _: [F.lit(max(t, 1)) for t in targets])
    edges = [h if t > 0 else "" for h, t in zip(cuts.get(None, [""] * (k - 1)), targets)]
    fold = F.lit(k - 1)
    for i in reversed(range(k - 1)):
        fold = F.when(key_hash(key, seed) <= F.lit(edges[i]), F.lit(i)).otherwise(fold)
    if placed:
        fixed = F.create_map(*[F.lit(x) for pair in placed.items() for x in pair])
        fold = F.coalesce(fixed[F.col(key)], fold)
    return frame.withColumn("fold", fold)


def _room(loads: Sequence[float], rest: float) -> list[float]:
    """How much of ``rest`` each fold takes so that the fullest stays lowest."""
    open_folds = sorted(range(len(loads)), key=lambda i: loads[i])
    while open_folds:
        level = (rest + sum(loads[i] for i in open_folds)) / len(open_folds)
        if loads[open_folds[-1]] <= level:
            return [max(level - loads[i], 0) if i in open_folds else 0 for i in range(len(loads))]
        open_folds.pop()
    return [0.0] * len(loads)


def naive_split(
    frame: DataFrame, columns: Sequence[Column], share: float = S.TEST_SHARE, seed: int = S.SEED
) -> DataFrame:
    """Split rows, not people: kept to show how such a split leaks.

    ``columns`` are texts that identify a row; equal rows are numbered apart.
    """
    numbered, h = _row_hashes(frame, columns, seed)
    cuts = hash_cuts(
        numbered.select(h.alias("h"), F.lit(1).alias("w")), "h", "w", _first(share)
    )
    in_test = h <= F.lit(cuts[None][0] if cuts else "")
    return numbered.withColumn("fold", F.when(in_test, F.lit("test")).otherwise(F.lit("train")))


def _row_hashes(frame: DataFrame, columns: Sequence[Column], seed: int) -> tuple[DataFrame, Column]:
    # Stored, because finding the cuts and applying them both read it.
    numbered = as_table(number_copies(frame, frame.columns), "numbered")
    return numbered, hash_of(*columns, F.col("copy_no").cast("string"), seed=seed)


def stratified_split(
    frame: DataFrame,
    stratum: str,
    columns: Sequence[Column],
    share: float = 0.7,
    seed: int = S.SEED,
) -> DataFrame:
    """Take the first ``ceil(share * n)`` rows, in hash order, of every stratum as 'train'.

    The cuts are joined back as a table, so strata may be many. Null is a stratum of its own.
    """
    numbered, h = _row_hashes(frame, columns, seed)
    cuts = hash_cut_table(
        numbered.select(stratum, h.alias("h"), F.lit(1).alias("w")), "h", "w", _first(share), stratum
    ).select(F.col("stratum").alias("__of"), F.col("h").alias("__edge"))
    edges = broadcast_if_small(as_table(cuts, "cuts"))
    fold = F.when(h <= F.col("__edge"), F.lit("train")).otherwise(F.lit("test"))
    return (
        numbered.join(edges, F.col(stratum).eqNullSafe(F.col("__of")), "left")
        .withColumn("fold", fold)
        .drop("__of", "__edge")
    )


def sample_by(
    frame: DataFrame, stratum: str, fractions: DataFrame, columns: Sequence[Column], seed: int = S.SEED
) -> DataFrame:
    """A sample with a fraction of its own per stratum: approximate sizes, one pass, nothing counted or ordered.

    ``fractions`` has one row per value of ``stratum`` and ``fraction`` (0 to 1); it is joined, so strata may be many.
    Strata without a row or with a null fraction give none; a row for null stands for null. A row is taken if the
    first 32 bits of the hash of ``columns`` lie below its fraction, whatever the layout of the files; rows
    that are equal in ``columns`` are taken together.
    """
    wanted = broadcast_if_small(
        fractions.select(F.col(stratum).alias("__of"), F.col("fraction").cast("double").alias("__fraction"))
    )
    place = F.conv(F.substring(hash_of(*columns, seed=seed), 1, 8), 16, 10).cast("double") / 2.0**32
    return (
        frame.join(wanted, F.col(stratum).eqNullSafe(F.col("__of")))
        .filter(place < F.col("__fraction"))
        .drop("__of", "__fraction")
    )


def quantile_groups(frame: DataFrame, value: str, groups: int = 5) -> DataFrame:
    """Add ``quantile_group`` 1..groups by exact quantile edges of ``value``."""
    probabilities = {f"q{i}": i / groups for i in range(1, groups)}
    edges = exact_quantiles(
        frame.select(F.lit("all").alias("column_name"), F.col(value).cast("double").alias("value")),
        ["column_name"],
        "value",
        probabilities,
    ).first()
    group = F.lit(groups)
    for i in reversed(range(1, groups)):
        group = F.when(F.col(value) <= F.lit(edges[f"q{i}"]), F.lit(i)).otherwise(group)
    return frame.withColumn("quantile_group", group)


def sample_rows(
    frame: DataFrame, columns: Sequence[Column], n: int = S.BACKGROUND_ROWS, seed: int = S.SEED
) -> DataFrame:
    """``min(n, rows)`` rows with the smallest hashes: a repeatable sample.

    Each task keeps its own first ``n`` only.
    """
    h = hash_of(*columns, seed=seed)
    return frame.withColumn("__h", h).orderBy("__h", *frame.columns).limit(n).drop("__h")


def shared_keys(folds: DataFrame, key: str = S.GROUP_KEY, fold: str = "fold") -> DataFrame:
    """Keys present in more than one fold, with one aggregation."""
    return (
        folds.groupBy(key)
        .agg(F.min(fold).alias("first_fold"), F.max(fold).alias("last_fold"))
        .filter(F.col("first_fold") != F.col("last_fold"))
    )


def require_disjoint(folds: DataFrame, key: str = S.GROUP_KEY) -> None:
    """Raise when a key is present in more than one fold."""
    leaked = shared_keys(folds, key).count()
    if leaked:
        raise ValueError(f"split leaked {leaked} keys across folds")
