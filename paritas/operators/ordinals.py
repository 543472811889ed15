"""Occurrence numbers inside a key (``row_number`` per key), skew-safe.

The straightforward plan is ``row_number() over (partition by key order by
...)``.  A window needs every row of a key in one task, so a key that holds
a large share of the table would serialise onto one executor.  Keys above
``hot_rows`` occurrences (on either side) therefore take a different plan:

1. the hot keys are found from one aggregate with a map-side partial step
   over a fixed-seed Bernoulli sample of the key columns (about
   ``SAMPLE_ROWS_PER_HOT_KEY`` sampled rows for a key at the threshold; exact
   when the threshold is small).  Detection only chooses the plan - both
   plans give the same ordinals - so a sample suffices, and it keeps this
   extra job from shuffling every distinct key of a huge table.  There are
   at most about ``2 * rows / hot_rows`` flagged keys; the set is checkpointed;
2. hot rows are globally sorted by ``(key, side, order..., random tie)``: a
   range exchange whose bounds are sampled over the whole sort tuple, so one
   key's rows are split across many tasks, even when they are all identical;
3. ``monotonically_increasing_id`` then encodes (partition, position); the
   first position and row count per (key, side, partition) form a table of at
   most ``#partitions + 2 * #hot keys`` rows, from which a running sum gives
   each partition's offset inside the key;
4. ``rn = offset + position - first position + 1``.

The sorted hot rows are checkpointed (a reliable checkpoint in the shared
``spark.checkpoint.dir``) before offsets are derived from them, so the
offsets and the rows they are added to come from one materialisation.
Everything stays in JVM operators.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import comparable
from ..session import conf_int, require_checkpoint_dir

HOT_ROWS_CONF = "spark.paritas.hotKeyRows"
HOT_ROWS_DEFAULT = 2_000_000

_POS_BITS = 33
# Expected sampled rows of a key holding exactly ``hot_rows`` rows; a key is
# flagged when its sampled count exceeds half of this (binomial sd ~ 63, so a
# key at the threshold is missed with negligible probability).
SAMPLE_ROWS_PER_HOT_KEY = 4000
_SAMPLE_SEED = 20251203
_TIE_SEED = 7
#: Values (rows times columns) that a task of a clustering by key holds; Spark
#: chooses the partitions of frames that so many tasks hold; most tasks of one exchange.
TASK_VALUES, FEW_TASKS, MOST_TASKS = 1_000_000, 8, 20_000


def order_columns(df: DataFrame, order: list[str]) -> list[Column]:
    """NULLs-last sort expressions; maps (not orderable) sort by their sorted entries."""
    return [comparable(df[c], df.schema[c].dataType).asc_nulls_last() for c in order]


def total_order(df: DataFrame, part: list[str], order: list[str]) -> list[Column]:
    """``order``, then every other carried column as a tie-break: rows left
    tied are identical, so the numbering is deterministic up to swapping
    equal rows (a recomputed task numbers the same way)."""
    rest = [c for c in df.columns if c not in part and c not in order]
    return order_columns(df, [*order, *rest])


def hot_rows_setting(spark, hot_rows: int | None) -> int:
    return conf_int(spark, HOT_ROWS_CONF, HOT_ROWS_DEFAULT) if hot_rows is None else hot_rows


def find_hot_keys(df: DataFrame, keys: list[str], group: list[str] | None = None,
                  hot_rows: int | None = None,
                  sample_rows: int = SAMPLE_ROWS_PER_HOT_KEY) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows in some ``group`` (e.g. per side);
    estimated from a sample when ``hot_rows`` is large (see module doc), of about
    ``sample_rows`` rows for a key at the threshold.

    Returns ``None`` when there are none (the common case) or when the feature
    is off.  The set is checkpointed; Spark picks its joins by its size in bytes.
    Runs one small job.
    """
    return hot_keys_and_rows(df, keys, group, hot_rows, sample_rows)[0]


def hot_keys_and_rows(df: DataFrame, keys: list[str], group: list[str] | None = None,
                      hot_rows: int | None = None, sample_rows: int = SAMPLE_ROWS_PER_HOT_KEY
                      ) -> tuple[DataFrame | None, int]:
    """``find_hot_keys``, and about how many rows ``df`` has, counted by the same
    aggregate (0 when the feature is off)."""
    spark = df.sparkSession
    hot_rows = hot_rows_setting(spark, hot_rows)
    if hot_rows <= 0:
        return None, 0
    fraction = min(1.0, sample_rows / hot_rows)
    by = [*keys, *(group or [])]
    src = df.select(*by)
    if fraction < 1.0:
        src = src.sample(withReplacement=False, fraction=fraction, seed=_SAMPLE_SEED)
        bar = fraction * hot_rows / 2
    else:
        bar = hot_rows
    # each row counts for its key, and once more for the table
    whole = "__paritas_whole"
    twice = src.withColumn(whole, F.explode(F.array(F.lit(False), F.lit(True))))
    counts = twice.groupBy(whole, *[F.when(~F.col(whole), F.col(c)).alias(c) for c in by]).agg(
        F.count(F.lit(1)).alias("__cnt"))
    found = counts.filter(F.col(whole) | (F.col("__cnt") > F.lit(bar))) \
        .groupBy(whole, *keys).agg(F.sum("__cnt").alias("__cnt"))
    require_checkpoint_dir(spark)
    found = found.checkpoint(eager=True)
    hot = found.filter(~F.col(whole)).select(*keys)
    rows = found.filter(whole).agg(F.sum("__cnt")).first()[0] or 0  # one row
    return None if hot.isEmpty() else hot, round(rows / fraction)


def is_clustered(df: DataFrame, keys: list[str]) -> bool:
    """Whether a window by ``keys`` adds no exchange to the plan of ``df``."""
    def exchanges(frame: DataFrame) -> int:
        return frame._jdf.queryExecution().executedPlan().toString().count("Exchange hash")

    return exchanges(df.select("*", F.count(F.lit(1)).over(
        Window.partitionBy(*[df[k] for k in keys])).alias("__paritas_n"))) == exchanges(df)


def spread(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """``df`` clustered by ``keys`` in as many tasks as its ``rows`` need, so that the
    memory of a task does not grow with the table: left to itself, AQE joins
    partitions up to a size in compressed bytes, whose rows, sorted and stacked
    into cells, take many times that.  Frames that few tasks hold, and those that
    are clustered by the keys already (bucketed inputs), stay as they are."""
    tasks = min(math.ceil(rows * len(df.columns) / TASK_VALUES), MOST_TASKS)
    if tasks <= FEW_TASKS or is_clustered(df, keys):
        return df
    return df.repartition(tasks, *[df[k] for k in keys])


def window_ordinals(df: DataFrame, keys: list[str], order: list[str], rn: str = "rn",
                    group: list[str] | None = None) -> DataFrame:
    part = [*keys, *(group or [])]
    # with no other column, order by the (constant) partition columns: the
    # rows are identical and row_number needs some ordering
    ordering = total_order(df, part, order) or [df[k] for k in part]
    w = Window.partitionBy(*[df[k] for k in part]).orderBy(*ordering)
    return df.withColumn(rn, F.row_number().over(w).cast("long"))


def side_ordinals(df: DataFrame, keys: list[str], order: list[str], rn: str, side: str) -> DataFrame:
    """``window_ordinals`` per (key, ``side``) for a 0/1 ``side`` column, as one
    window partitioned by the key alone: rows ordered by side, then the total
    order, so the left rows take 1..m and the right rows m+1..m+n; subtracting
    m (counted in the same window) numbers each side from 1.  The window only
    *requires* clustering by key, so input already hash-partitioned or
    bucketed by the key is not shuffled again, and a later operator clustered
    on the key (with any further columns) reuses the partitioning."""
    s = F.col(side)
    w = Window.partitionBy(*[df[k] for k in keys]).orderBy(
        s.asc(), *total_order(df, [*keys, side], order))
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    lefts = F.sum(F.when(s == 0, 1).otherwise(0)).over(whole)
    return df.withColumn(rn, (F.row_number().over(w) - F.when(s == 1, lefts).otherwise(0))
                         .cast("long"))


def range_ordinals(df: DataFrame, keys: list[str], order: list[str], rn: str = "rn",
                   group: list[str] | None = None) -> DataFrame:
    """Distributed row numbering for keys too large for one task (see module doc)."""
    part = [*keys, *(group or [])]
    # last sort key: a seeded random tie-break, so rows equal in every sorted
    # column (identical rows of a hot key, interchangeable for numbering) are
    # spread over range partitions instead of forming one partition
    tie = "__paritas_tie"
    sort_cols = ([df[k].asc_nulls_last() for k in part] + total_order(df, part, order)
                 + [F.col(tie)])
    mid = "__paritas_mid"
    srt = df.withColumn(tie, F.rand(_TIE_SEED)).orderBy(*sort_cols).drop(tie) \
        .withColumn(mid, F.monotonically_increasing_id())
    srt = srt.checkpoint(eager=True)
    pid = F.shiftright(F.col(mid), _POS_BITS)
    pos = F.col(mid).bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    pieces = (srt.groupBy(*part, pid.alias("__pid"))
              .agg(F.min(pos).alias("__first"), F.count(F.lit(1)).alias("__n")))
    before = Window.partitionBy(*part).orderBy("__pid").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = pieces.select(*part, "__pid", "__first",
                            F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    # offsets: at most (#range partitions + #hot keys * #groups) rows; Spark
    # broadcasts them when their bytes allow, else splits the skewed join
    joined = srt.withColumn("__pid", pid).join(offsets, on=[*part, "__pid"], how="inner")
    out = joined.withColumn(
        rn, (F.col("__offset") + pos - F.col("__first") + 1).cast("long"))
    return out.select(*df.columns, rn)


def with_ordinals(df: DataFrame, keys: list[str], order: list[str], rn: str = "rn",
                  group: list[str] | None = None, hot: DataFrame | None | str = "auto",
                  cold_partitioned: bool = False) -> DataFrame:
    """Add ``rn`` = 1-based occurrence number of each row inside its key (and
    ``group``), ordered by ``order`` with NULLs last.

    ``hot="auto"`` detects hot keys; pass ``None`` to use the window plan for
    everything or a hot-key DataFrame from ``find_hot_keys``.  With
    ``cold_partitioned`` the numbered rows come out clustered by ``keys`` only,
    so later operators clustered on ``keys`` need no further exchange (a 0/1
    ``group`` such as the side tag uses ``side_ordinals``; anything else is
    repartitioned by the keys first).
    """
    rows = 0
    if isinstance(hot, str):
        hot, rows = hot_keys_and_rows(df, keys, group)

    def cold_plan(frame):
        if cold_partitioned and group and len(group) == 1:
            return side_ordinals(spread(frame, keys, rows), keys, order, rn, group[0])
        if cold_partitioned:
            frame = frame.repartition(*[frame[k] for k in keys])
        return window_ordinals(frame, keys, order, rn, group)

    if hot is None:
        return cold_plan(df)
    cold = cold_plan(df.join(hot, on=keys, how="left_anti"))
    warm = range_ordinals(df.join(hot, on=keys, how="left_semi"), keys, order, rn, group)
    return cold.unionByName(warm)
