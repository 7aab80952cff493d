"""Order statistics without a single-task sort.

Each helper works in two levels: rows are counted per coarse bucket, the small
bucket table is accumulated, and only rows inside one bucket are ordered together.
"""

import math
import sys
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.functions.skew import broadcast_if_small
from claimloom.functions.storage import as_table

# Groups up to this many rows are ordered by one task; above it buckets are used.
WINDOW_ROWS = 1_000_000
BUCKETS = 512

# Bins of a selection round, and the ratio of its ends beyond which an interval is cut in its logarithm.
BINS = 1024
WIDE = 2.0**20
LARGEST = sys.float_info.max

# Hex digits of an md5 hash that name a bucket: 65,536 even buckets.
PREFIX = 4


def hash_of(*parts: Column | str, seed: int) -> Column:
    """Engine-portable md5 of the text of ``parts`` and a seed."""
    texts = [F.coalesce(F.col(p) if isinstance(p, str) else p, F.lit("")) for p in parts]
    return F.md5(F.concat(F.concat_ws("|", *texts), F.lit(f":{seed}")))


def hash_cut_table(
    keys: DataFrame,
    hash_col: str,
    weight_col: str,
    targets: Callable[[Column], Sequence[Column]],
    stratum_col: str | None = None,
) -> DataFrame:
    """Hashes at which the running weight, in hash order, first reaches each target.

    ``targets`` maps the total weight to the wanted running weights. Returns ``stratum`` (0 when not stratified;
    null is a stratum of its own), ``target_no`` and ``h``. Two aggregation passes; strata may be many, as nothing
    is listed on the driver.
    """
    frame = keys.select(
        (F.col(stratum_col) if stratum_col else F.lit(0)).alias("stratum"),
        F.col(hash_col).alias("h"),
        F.col(weight_col).cast("long").alias("w"),
    ).withColumn("prefix", F.substring("h", 1, PREFIX))
    # At most 65,536 rows a stratum, also where Spark warns of a window without partitions.
    in_order = Window.partitionBy("stratum").orderBy("prefix")
    buckets = frame.groupBy("stratum", "prefix").agg(F.sum("w").alias("w"))
    wanted = (
        buckets.withColumn("upto", F.sum("w").over(in_order))
        .withColumn("total", F.sum("w").over(Window.partitionBy("stratum")))
        .select("*", F.posexplode(F.array(*[t.cast("long") for t in targets(F.col("total"))])))
        .withColumnsRenamed({"pos": "target_no", "col": "target"})
        .filter((F.col("target") <= F.col("upto")) & (F.col("target") > F.col("upto") - F.col("w")))
        .select(
            F.col("stratum").alias("of"), F.col("prefix").alias("begin"), "target_no", "target",
            (F.col("upto") - F.col("w")).alias("before"),
        )
    )
    marks = broadcast_if_small(as_table(wanted, "marks"))
    here = F.col("stratum").eqNullSafe(F.col("of")) & (F.col("prefix") == F.col("begin"))
    inside = (
        frame.join(marks, here)
        .groupBy("stratum", "target_no", "target", "before", "h")
        .agg(F.sum("w").alias("w"))
    )
    running = F.col("before") + F.sum("w").over(
        Window.partitionBy("stratum", "target_no").orderBy("h")
    )
    return (
        inside.withColumn("reached", running)
        .filter(F.col("reached") >= F.col("target"))
        .groupBy("stratum", "target_no")
        .agg(F.min("h").alias("h"))
    )


def hash_cuts(
    keys: DataFrame,
    hash_col: str,
    weight_col: str,
    targets: Callable[[Column], Sequence[Column]],
    stratum_col: str | None = None,
) -> dict:
    """The rows of :func:`hash_cut_table` as one list of hashes per stratum (``None`` when not stratified).

    Strata must be few, such as class labels: the driver holds their cuts.
    """
    rows = hash_cut_table(keys, hash_col, weight_col, targets, stratum_col).collect()
    cuts: dict = {}
    for row in sorted(rows, key=lambda r: r.target_no):
        cuts.setdefault(row.stratum if stratum_col else None, []).append(row.h)
    return cuts


def ordered_value(column: str) -> Column:
    """Whether a number can be ordered: neither null nor NaN."""
    return F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double"))


def _in_buckets(frame: DataFrame, by: Sequence[str], order: str, rows: int) -> DataFrame:
    """Add ``bucket``: ranges of (group, value), by Spark's range partitioning, of about half of ``WINDOW_ROWS``."""
    if rows <= WINDOW_ROWS:
        return frame.withColumn("bucket", F.lit(0))
    ranges = frame.repartitionByRange(max(BUCKETS, 2 * rows // WINDOW_ROWS), *by, order)
    # Stored, because the numbers of the partitions must not change between passes.
    return as_table(ranges.withColumn("bucket", F.spark_partition_id()), "ranges")


def running_totals(
    frame: DataFrame, by: Sequence[str], order: str, sums: Sequence[str]
) -> DataFrame:
    """Running totals of ``sums`` in ``order`` within each ``by`` group.

    ``frame`` holds one row per group and value and its groups are few (columns,
    classes). Rows whose value has no place in the order (null or NaN) take no part,
    neither in the result nor in the totals. Adds ``before_<c>`` (excluding the row), ``total_<c>`` and
    ``next_value`` (the following value of the group, null at its end).
    """
    by = list(by)
    frame = as_table(frame.filter(ordered_value(order)), "ordered")
    columns = frame.columns
    frame = _in_buckets(frame, by, order, frame.count())
    whole = Window.partitionBy(*by)
    earlier = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        frame.groupBy(*by, "bucket")
        .agg(F.min(order).alias("lowest"), *[F.sum(c).alias(f"sum_{c}") for c in sums])
        .select(
            *by,
            "bucket",
            F.lead("lowest").over(whole.orderBy("bucket")).alias("next_lowest"),
            *[
                F.coalesce(F.sum(f"sum_{c}").over(earlier), F.lit(0)).alias(f"offset_{c}")
                for c in sums
            ],
            *[F.sum(f"sum_{c}").over(whole).alias(f"total_{c}") for c in sums],
        )
    )
    inside = Window.partitionBy(*by, "bucket").orderBy(order)
    preceding = inside.rowsBetween(Window.unboundedPreceding, -1)
    ordered = frame.select(
        "*",
        F.lead(order).over(inside).alias("next_inside"),
        *[F.coalesce(F.sum(c).over(preceding), F.lit(0)).alias(f"inside_{c}") for c in sums],
    )
    # At most (groups + buckets) rows, so the offsets are safe to broadcast.
    return ordered.join(F.broadcast(offsets), [*by, "bucket"]).select(
        *columns,
        F.coalesce("next_inside", "next_lowest").alias("next_value"),
        *[(F.col(f"offset_{c}") + F.col(f"inside_{c}")).alias(f"before_{c}") for c in sums],
        *[f"total_{c}" for c in sums],
    )


def exact_quantiles(
    frame: DataFrame, by: Sequence[str], value: str, probabilities: dict[str, float]
) -> DataFrame:
    """Exact quantiles per group, interpolating linearly between neighbours, by selection.

    Values are doubles; null and NaN take no part, and a group without other values has no row. No order over
    all values is made: rows are counted in ``BINS`` bins between the extremes of an interval, only bins that
    hold a wanted rank are looked into again, and bins of at most ``WINDOW_ROWS`` rows are ordered. A
    shuffle carries bin counts and, at the end, counts per value of the small bins.

    Groups are few (columns, classes): the driver holds one interval per group and wanted rank.
    """
    by = list(by)
    rows = as_table(
        frame.filter(ordered_value(value)).select(*by, F.col(value).cast("double").alias("__v")), "values"
    )
    groups = rows.groupBy(*by).agg(F.count("__v").alias("n"), F.min("__v").alias("low"), F.max("__v").alias("high"))
    totals, pending, found = {}, [], {}
    for row in groups.collect():
        key = tuple(row[c] for c in by)
        totals[key] = row["n"]
        ends = (share * (row["n"] - 1) for share in probabilities.values())
        ranks = sorted({rank for at in ends for rank in (math.floor(at), math.ceil(at))})
        pending.append(_Interval(key, row["low"], row["high"], 0, row["n"], ranks))
    while pending:
        for done in [i for i in pending if i.low == i.high]:
            found.update({(done.key, rank): done.low for rank in done.ranks})
        pending = [i for i in pending if i.low < i.high]
        small = [i for i in pending if i.rows <= WINDOW_ROWS or not i.divisible()]
        pending = [i for i in pending if i.rows > WINDOW_ROWS and i.divisible()]
        for interval, low, _, before, n in _bins_with_ranks(rows, by, small, F.col("__v")):
            found.update({(interval.key, rank): low for rank in interval.ranks if before <= rank < before + n})
        pending = [
            _Interval(interval.key, low, high, before, n, [r for r in interval.ranks if before <= r < before + n])
            for interval, low, high, before, n in _bins_with_ranks(rows, by, pending, _bin_number())
        ]
    results = []
    for key, n in totals.items():
        quantiles = []
        for share in probabilities.values():
            at = share * (n - 1)
            low, high = found[key, math.floor(at)], found[key, math.ceil(at)]
            quantiles.append(low if low == high else low + (high - low) * (at - math.floor(at)))
        results.append((*key, *quantiles))
    names = [T.StructField(name, T.DoubleType()) for name in probabilities]
    schema = T.StructType([*[frame.schema[c] for c in by], *names])
    return frame.sparkSession.createDataFrame(results, schema)


@dataclass
class _Interval:
    """Values of a group from ``low`` to ``high`` that hold wanted ``ranks``, after ``before`` smaller rows."""

    key: tuple
    low: float
    high: float
    before: int
    rows: int
    ranks: list[int]

    def scale(self) -> tuple[int, bool, float, float]:
        """Sign, whether bins are even in the logarithm, and where they begin and how far they reach.

        An interval that spans zero is cut at zero and evenly on both sides. A wide one is cut in its logarithm, so that
        values of any magnitude are told apart after few rounds.
        """
        low, high = max(self.low, -LARGEST), min(self.high, LARGEST)
        if low <= 0 <= high:
            return 0, False, 0.0, max(-low, high)
        sign = 1 if low > 0 else -1
        first, last = sorted((sign * low, sign * high))
        logged = last / first > WIDE
        if logged:
            first, last = math.log(first), math.log(last)
        return sign, logged, first, last - first

    def divisible(self) -> bool:
        """Whether bins can separate the two ends: not between the largest number and infinity."""
        return max(self.low, -LARGEST) < min(self.high, LARGEST)


def _bin_number() -> Column:
    """Bin of ``__v`` in its interval; never falls when the value rises."""
    v = F.greatest(F.least(F.col("__v"), F.lit(LARGEST)), F.lit(-LARGEST))
    size = F.abs(v)
    place = F.when(F.col("sign") == 0, size).when(F.col("logged"), F.ln(size)).otherwise(size)
    bin_no = F.floor((place - F.col("first")) / F.col("reach") * BINS)
    return F.when(F.col("sign") == 0, F.signum(v) * (1 + bin_no)).otherwise(F.col("sign") * bin_no)


def _bins_with_ranks(rows: DataFrame, by: Sequence[str], intervals: list["_Interval"], bin_no: Column) -> list[tuple]:
    """Bins that hold a wanted rank, as (interval, lowest, highest value, rows before, rows)."""
    if not intervals:
        return []
    spark = rows.sparkSession
    keys = [T.StructField(f"__by{i}", rows.schema[c].dataType) for i, c in enumerate(by)]
    facts = T.StructType.fromDDL(
        "no int, low double, high double, before long, ranks array<long>, sign int, logged boolean, first double, reach double"
    )
    marks = spark.createDataFrame(
        [(*i.key, no, i.low, i.high, i.before, i.ranks, *i.scale()) for no, i in enumerate(intervals)],
        T.StructType([*keys, *facts]),
    )
    same = [F.col(c).eqNullSafe(F.col(k.name)) for c, k in zip(by, keys)]
    inside = F.col("__v").between(F.col("low"), F.col("high"))
    counts = (
        rows.join(F.broadcast(marks), reduce(Column.__and__, [*same, inside]))
        .groupBy("no", "before", "ranks", bin_no.alias("bin"))
        .agg(F.count("__v").alias("n"), F.min("__v").alias("lowest"), F.max("__v").alias("highest"))
    )
    upto = F.col("before") + F.sum("n").over(Window.partitionBy("no").orderBy("bin"))
    held = F.exists("ranks", lambda r: (r >= F.col("upto") - F.col("n")) & (r < F.col("upto")))
    return [
        (intervals[r["no"]], r["lowest"], r["highest"], r["upto"] - r["n"], r["n"])
        for r in counts.withColumn("upto", upto).filter(held).collect()
    ]


def number_copies(frame: DataFrame, columns: Sequence[str], chunk: int = 10_000) -> DataFrame:
    """Give equal rows running numbers 1, 2, 3 ... in column ``copy_no``.

    Copies are counted first and expanded again in chunks spread over the
    cluster, so a row that repeats very often never sits in one task.
    """
    columns = list(columns)
    counted = frame.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))
    chunks = counted.withColumn(
        "start", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"), F.lit(chunk).cast("long")))
    )
    # Only rows that need several chunks are moved.
    one, many = F.col("copies") <= chunk, F.col("copies") > chunk
    spread = chunks.filter(many).repartition(F.xxhash64(*columns, "start"))
    last = F.least(F.col("start") + chunk - 1, F.col("copies"))
    return (
        chunks.filter(one)
        .unionByName(spread)
        .select(*columns, F.explode(F.sequence(F.col("start"), last)).alias("copy_no"))
    )
