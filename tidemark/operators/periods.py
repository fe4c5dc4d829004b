"""Period-level operators: aggregate posts to one row per period, volume,
spread, lag/lead differences, the row-level volume change, max scaling.

Posts carry the period keys ``match_id, period_id, id``. Everything here is
one ``groupBy`` on the keys (partial aggregation, so a hot match or period is
combined map-side before the shuffle), windows only over the *period* table,
and scalar maxima as scalar subqueries instead of unpartitioned windows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.lookup import join_lookup
from tidemark.sources.io import materialize

PERIOD_KEYS = ("match_id", "period_id", "id")


def _nan_to_null(c: str) -> Column:
    """pandas' mean skips NaN; Spark's avg skips only NULL."""
    col = F.col(c).cast("double")
    return F.when(F.isnan(col), F.lit(None).cast("double")).otherwise(col)


def aggregate_periods(posts: DataFrame,
                      keys: Sequence[str] = PERIOD_KEYS,
                      scalar_cols: Sequence[str] = (),
                      vector_cols: Sequence[str] = (),
                      label_col: str | None = "event_type",
                      label_agg: str = "mean",
                      spread_cols: Sequence[str] = (),
                      max_cols: Sequence[str] = ()) -> DataFrame:
    """One row per period: post count, means of scalars and vectors, label.

    * ``n_posts``: period size (group ``size`` fold, A2 / J8).
    * ``<c>`` for each scalar: mean over posts, NaN treated as missing (A1).
    * ``<v>`` for each ``array<double>`` vector: element-wise mean (A1/X12),
      computed by ``Summarizer`` - a JVM aggregate with partial aggregation.
    * ``std_<c>``: sample standard deviation, NULL for one-post periods (A3).
    * ``max_<c>``: per-period maximum (feeds global max scaling).
    * label: ``mean`` (the original averaging), ``max``, or ``constant``
      (the label must not vary inside a period; checked, see
      ``assert_constant_label``).
    """
    aggs = [F.count(F.lit(1)).alias("n_posts")]
    for c in scalar_cols:
        aggs.append(F.avg(_nan_to_null(c)).alias(c))
    for c in spread_cols:
        aggs.append(F.stddev_samp(_nan_to_null(c)).alias(f"std_{c}"))
    for c in max_cols:
        aggs.append(F.max(_nan_to_null(c)).alias(f"max_{c}"))
    for v in vector_cols:
        aggs.append(Summarizer.mean(array_to_vector(F.col(v))).alias(f"__vec_{v}"))
    if label_col:
        lab = _nan_to_null(label_col)
        if label_agg == "mean":
            aggs.append(F.avg(lab).alias(label_col))
        elif label_agg == "max":
            aggs.append(F.max(lab).alias(label_col))
        elif label_agg == "constant":
            aggs.append(F.min(lab).alias(label_col))
            aggs.append(F.max(lab).alias("__label_max"))
        else:
            raise ValueError(f"label_agg must be 'mean', 'max' or 'constant', got {label_agg!r}")
    out = posts.groupBy(*keys).agg(*aggs)
    if label_col and label_agg == "constant":
        out = assert_constant_label(out, label_col)
    for v in vector_cols:
        out = out.withColumn(v, vector_to_array(F.col(f"__vec_{v}"), "float64")).drop(f"__vec_{v}")
    return out


def assert_constant_label(periods: DataFrame, label_col: str = "event_type") -> DataFrame:
    """Fail if any period mixes labels (its min and max differ).

    One aggregate over the period table counts offending periods; only that
    number reaches the driver. Returns the periods without the helper column.
    """
    bad = periods.where(F.col(label_col) != F.col("__label_max")).count()
    if bad:
        raise ValueError(f"{bad} periods have more than one {label_col} value")
    return periods.drop("__label_max")


def period_volume(posts: DataFrame, keys: Sequence[str] = PERIOD_KEYS) -> DataFrame:
    return posts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_posts"))


def period_spread(posts: DataFrame, col: str, keys: Sequence[str] = PERIOD_KEYS) -> DataFrame:
    return posts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_posts"),
        F.stddev_samp(_nan_to_null(col)).alias(f"std_{col}"))


def neighbour_values(periods: DataFrame, col: str, offsets: Sequence[int],
                     by: Sequence[str] | str = "match_id",
                     order: Sequence[str] = ("period_id", "id"),
                     partitions: int | None = None) -> tuple[DataFrame, dict[int, Column]]:
    """Values of ``col`` ``k`` rows back (k > 0) or ahead (k < 0) in the same
    group, in ``order``; NULL past the group's ends.

    The periods are sorted once into range partitions of (group, order), so a
    large group is many partitions. The last rows of a partition, as many as
    the largest offset, are also handed to the ones after it (and the first
    to the ones before): with that halo every offset is a window inside one
    partition, whatever the size of a group. ``partitions``: how many
    (default: as many as the table needs). Returns the frame and a Column
    per offset.
    """
    by = [by] if isinstance(by, str) else list(by)
    back, ahead = max((k for k in offsets if k > 0), default=0), max((-k for k in offsets if k < 0), default=0)
    names = {k: f"__nb{k}".replace("-", "m") for k in offsets}
    rows, sizes = _range_sorted(periods, by + list(order), partitions)
    total = F.array(*[F.lit(n) for n in sizes or [0]])
    begin = F.array(*[F.lit(sum(sizes[:p])).cast("long") for p in range(max(1, len(sizes)))])
    place = F.get(begin, F.col("__part")) + F.col("__local")
    edge = (F.col("__local") < ahead) | (F.col("__local") >= F.get(total, F.col("__part")) - back)
    near = F.filter(F.sequence(F.lit(0), F.lit(max(0, len(sizes) - 1))), lambda p: (
        (place >= F.get(begin, p) - back) & (place < F.get(begin, p) + F.get(total, p) + ahead)))
    homes = F.when(edge, near).otherwise(F.array("__part")) if len(sizes) > 1 else F.array("__part")
    w = Window.partitionBy("__home", *by).orderBy("__part", "__local")
    lags = {names[k]: (F.lag(col, k) if k > 0 else F.lead(col, -k)).over(w) for k in offsets}
    out = (rows.select("*", F.explode(homes).alias("__home")).withColumns(lags)
           .where(F.col("__home") == F.col("__part")).drop("__home", "__part", "__local"))
    return out, {k: F.col(n) for k, n in names.items()}


def _drop_helpers(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("__nb")])


def period_change(periods: DataFrame, col: str,
                  lags: Sequence[int] = (1, 2, 3), leads: Sequence[int] = (1,),
                  by: Sequence[str] | str = "match_id",
                  order: Sequence[str] = ("period_id", "id"),
                  partitions: int | None = None) -> DataFrame:
    """``x - lag(x, k)`` as ``<col>_before<k>`` and ``x - lead(x, k)``
    as ``<col>_after<k>``; 0 where the neighbour does not exist.

    Runs on the period table (one row per period), all offsets in one pass
    (``neighbour_values``).
    """
    offsets = list(lags) + [-k for k in leads]
    out, nb = neighbour_values(periods, col, offsets, by, order, partitions)
    x = F.col(col)
    for k in lags:
        out = out.withColumn(f"{col}_before{k}", F.coalesce(x - nb[k], F.lit(0)))
    for k in leads:
        out = out.withColumn(f"{col}_after{k}", F.coalesce(x - nb[-k], F.lit(0)))
    return _drop_helpers(out)


def volume_change(periods: DataFrame, n_col: str = "n_posts", mode: str = "row_lag",
                  by: Sequence[str] | str = "match_id",
                  order: Sequence[str] = ("period_id", "id"),
                  out_col: str = "volume_change", partitions: int | None = None) -> DataFrame:
    """Change in volume two steps back, per period.

    ``mode="row_lag"`` is what the original computes: every *post* carries
    its period size n, posts are differenced two rows back and the result is
    averaged per period. With posts contiguous by period only the first two
    posts of a period differ from 0, so on the period table (n_p = size of
    period p, p-1 and p-2 the preceding periods of the match)::

        d0 = n_p - (n_{p-1} if n_{p-1} >= 2 else n_{p-2})   (0 if undefined)
        d1 = n_p - n_{p-1}                 (0 if n_p < 2 or p is the first)
        value = (d0 + d1) / n_p

    Also returns ``<out_col>_absmax = max(|d0|, |d1|)``: the largest post-level
    magnitude in the period, whose global max is the scaling denominator.

    ``mode="period_lag"``: ``n_p - n_{p-2}`` on the period table.
    """
    if mode not in ("row_lag", "period_lag"):
        raise ValueError(f"mode must be 'row_lag' or 'period_lag', got {mode!r}")
    out, nb = neighbour_values(periods, n_col, [1, 2], by, order, partitions)
    n = F.col(n_col).cast("double")
    out = out.withColumn("__n1", nb[1].cast("double")).withColumn("__n2", nb[2].cast("double"))
    p1, p2 = F.col("__n1"), F.col("__n2")
    if mode == "period_lag":
        v = F.coalesce(n - p2, F.lit(0.0))
        out = out.withColumn(out_col, v).withColumn(f"{out_col}_absmax", F.abs(v))
        return _drop_helpers(out.drop("__n1", "__n2"))
    d0 = (F.when(p1.isNull(), F.lit(0.0))
          .when(p1 >= 2, n - p1)
          .when(p2.isNull(), F.lit(0.0))
          .otherwise(n - p2))
    d1 = F.when(p1.isNull() | (n < 2), F.lit(0.0)).otherwise(n - p1)
    out = (out.withColumn(out_col, (d0 + d1) / n)
              .withColumn(f"{out_col}_absmax", F.greatest(F.abs(d0), F.abs(d1))))
    return _drop_helpers(out.drop("__n1", "__n2"))


def max_scale(df: DataFrame, col: str, by: Sequence[str] | str | None = None,
              absolute: bool = False, norm_col: str | None = None,
              out_col: str | None = None) -> DataFrame:
    """Divide ``col`` by the maximum of ``norm_col`` (default ``col``).

    ``by=None``: one global maximum, a scalar subquery (partial max per task,
    one row to the driver) - no unpartitioned window, no cross join.
    ``by=cols``: maximum per group - a group-by (partial aggregation) joined
    back on the group keys (NULLs are a group); the group table (one row per
    group) is broadcast behind a bound in bytes, else joined sort-merge with
    a hot group split.
    Division by a 0 maximum gives NULL (``try_divide``).
    """
    out_col = out_col or col
    src = F.col(norm_col or col).cast("double")
    src = F.abs(src) if absolute else src
    if by is None:
        m = df.agg(F.max(src)).scalar()
        return df.withColumn(out_col, F.try_divide(F.col(col).cast("double"), m))
    by = [by] if isinstance(by, str) else list(by)
    keys = [F.col(c).alias(f"__k{i}") for i, c in enumerate(by)]
    # Written once: it is counted, then joined.
    maxima = materialize(df.groupBy(*keys).agg(F.max(src).alias("__max")), "maxima")
    same = [F.col(c).eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(by)]
    # The group table is counted and broadcast when small, so a hot group
    # is not shuffled; rows whose group is NULL form a group of their own.
    return (join_lookup(df, maxima, same, "left")
              .withColumn(out_col, F.try_divide(F.col(col).cast("double"), F.col("__max")))
              .drop("__max", *[f"__k{i}" for i in range(len(by))]))


def fill_nulls(df: DataFrame, cols: Sequence[str], value: float = 0.0) -> DataFrame:
    """NULL and NaN to a constant."""
    out = df
    for c in cols:
        x = F.col(c)
        out = out.withColumn(c, F.when(x.isNull() | F.isnan(x), F.lit(value)).otherwise(x))
    return out


def _range_sorted(df: DataFrame, order: Sequence[str | Column],
                  partitions: int | None = None) -> tuple[DataFrame, list[int]]:
    """``df`` in range partitions of ``order`` with its place (``__part int, __local long``), and their sizes.

    The numbered table is written to the shared checkpoint folder so that
    sizes and places come from one run. The sizes - one number per partition -
    come to the driver.
    """
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    rows = materialize(ranged.sortWithinPartitions(*order).withColumn("__mid", F.monotonically_increasing_id()),
                       "row-index")
    part = F.shiftright("__mid", 33)
    rows = (rows.withColumn("__part", part.cast("int")).withColumn("__local", F.col("__mid") - F.shiftleft(part, 33))
                .drop("__mid"))
    counts = dict(rows.groupBy("__part").count().collect())
    return rows, [counts.get(p, 0) for p in range(max(counts, default=-1) + 1)]


def global_row_index(df: DataFrame, order: Sequence[str | Column],
                     out_col: str = "row_index") -> DataFrame:
    """1-based position of every row in the total order ``order``.

    Distributed: rows are numbered inside range partitions, then the count of
    all earlier partitions is added, an array literal indexed by partition.
    """
    rows, sizes = _range_sorted(df, order)
    starts = F.array(*[F.lit(sum(sizes[:p])).cast("long") for p in range(max(1, len(sizes)))])
    return rows.withColumn(out_col, F.get(starts, F.col("__part")) + F.col("__local") + 1).drop("__part", "__local")
