import random

from pyspark.sql import functions as F

from tidemark.operators.periods import (
    aggregate_periods,
    global_row_index,
    max_scale,
    period_change,
    period_volume,
    volume_change,
)


def _posts(spark, runs, match="m"):
    rows, pid = [], 0
    for p, n in enumerate(runs):
        for _ in range(n):
            rows.append((match, p, f"{match}:{p}", pid, float(pid % 7)))
            pid += 1
    return spark.createDataFrame(rows, "match_id string, period_id long, id string, post_id long, value double")


def _row_level(runs):
    """The original computation: per-post period size, lag 2 over posts, mean per period."""
    sizes = [n for n in runs for _ in range(n)]
    diffs = [0.0 if i < 2 else sizes[i] - sizes[i - 2] for i in range(len(sizes))]
    out, i = [], 0
    for n in runs:
        out.append(sum(diffs[i:i + n]) / n)
        i += n
    mx = max(abs(d) for d in diffs)
    return out, mx


def _closed_form(spark, runs):
    v = volume_change(period_volume(_posts(spark, runs))).orderBy("period_id").collect()
    return [r.volume_change for r in v], max(r.volume_change_absmax for r in v)


def test_volume_change_fixture_runs(spark):
    for runs in ([1], [1, 1, 1], [3, 1, 4], [2, 2, 2], [5, 1]):
        got, gmax = _closed_form(spark, runs)
        want, wmax = _row_level(runs)
        assert got == want, runs
        assert gmax == wmax, runs


def test_volume_change_random_runs(spark):
    rng = random.Random(7)
    for _ in range(5):
        runs = [rng.randint(1, 5) for _ in range(rng.randint(1, 12))]
        got, gmax = _closed_form(spark, runs)
        want, wmax = _row_level(runs)
        assert [round(x, 12) for x in got] == [round(x, 12) for x in want]
        assert gmax == wmax


def test_scaling_by_zero_max_is_null(spark):
    v = volume_change(period_volume(_posts(spark, [2, 2, 2])))
    s = max_scale(v, "volume_change", norm_col="volume_change_absmax", out_col="scaled")
    assert [r.scaled for r in s.collect()] == [None, None, None]


def test_scaled_magnitude_at_most_one(spark):
    v = volume_change(period_volume(_posts(spark, [3, 1, 4, 1, 5, 9, 2, 6])))
    s = max_scale(v, "volume_change", norm_col="volume_change_absmax", out_col="scaled")
    assert all(abs(r.scaled) <= 1.0 for r in s.collect())


def test_one_post_period_spread_is_null_and_mean_skips_nan(spark):
    df = spark.createDataFrame([("m", 0, "m:0", 0, 1.0), ("m", 1, "m:1", 1, 2.0),
                                ("m", 1, "m:1", 2, float("nan")), ("m", 1, "m:1", 3, 4.0)],
                               "match_id string, period_id long, id string, post_id long, value double")
    p = {r.period_id: r for r in aggregate_periods(df, scalar_cols=["value"], spread_cols=["value"],
                                                   label_col=None).collect()}
    assert p[0].std_value is None and p[0].n_posts == 1
    assert p[1].value == 3.0 and p[1].n_posts == 3


def test_lags_and_leads(spark):
    v = period_change(period_volume(_posts(spark, [3, 1, 4])), "n_posts").orderBy("period_id").collect()
    assert [r.n_posts_before1 for r in v] == [0, -2, 3]
    assert [r.n_posts_before2 for r in v] == [0, 0, 1]
    assert [r.n_posts_after1 for r in v] == [2, -3, 0]


def test_global_row_index_is_total_order(spark):
    df = spark.range(0, 500).select((F.col("id") * 7919 % 500).alias("k")).repartition(7)
    out = global_row_index(df, ["k"]).collect()
    assert sorted((r.k, r.row_index) for r in out) == [(k, k + 1) for k in range(500)]


def test_result_independent_of_partitioning(spark):
    posts = _posts(spark, [3, 1, 4, 1, 5])
    a = volume_change(period_volume(posts)).collect()
    b = volume_change(period_volume(posts.repartition(5, "post_id"))).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_halo_over_many_partitions(spark):
    """Neighbours across range partitions, some smaller than the largest offset, against plain lists."""
    from tidemark.operators.periods import neighbour_values
    rng = random.Random(3)
    groups = {m: [rng.randrange(50) for _ in range(n)] for m, n in (("a", 1), ("b", 40), ("c", 2), (None, 9), ("d", 3))}
    rows = [(m, p, f"{m}:{p}", x) for m, xs in groups.items() for p, x in enumerate(xs)]
    df = spark.createDataFrame(rows, "match_id string, period_id long, id string, x long").repartition(3)
    offsets = [1, 2, 7, -1, -5]
    for partitions in (None, 1, 4, 23, 80):
        out, nb = neighbour_values(df, "x", offsets, partitions=partitions)
        got = out.select("match_id", "period_id", "x", *[nb[k].alias(f"o{i}") for i, k in enumerate(offsets)]).collect()
        assert len(got) == len(rows)
        for r in got:
            xs = groups[r.match_id]
            assert r.x == xs[r.period_id]
            assert list(r[3:]) == [xs[r.period_id - k] if 0 <= r.period_id - k < len(xs) else None for k in offsets]
    out, nb = neighbour_values(df.limit(0), "x", [1])
    assert out.select(nb[1]).collect() == []


def test_changes_do_not_depend_on_partitions(spark):
    rng = random.Random(3)
    rows, pid = [], 0
    for m in ("a", "b", "c"):
        for p in range(rng.randint(1, 9)):
            for _ in range(rng.randint(1, 4)):
                rows.append((m, p, f"{m}:{p}", pid, 1.0))
                pid += 1
    posts = spark.createDataFrame(rows, "match_id string, period_id long, id string, post_id long, value double")
    vol = period_volume(posts)
    for mode in ("row_lag", "period_lag"):
        a = volume_change(vol, mode=mode).collect()
        b = volume_change(vol, mode=mode, partitions=7).collect()
        assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    a = period_change(vol, "n_posts").collect()
    b = period_change(vol, "n_posts", partitions=7).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_constant_label_check(spark):
    import pytest
    ok = spark.createDataFrame([("m", 0, "m:0", 0, 1.0), ("m", 0, "m:0", 1, 1.0),
                                ("m", 1, "m:1", 2, 0.0)],
                               "match_id string, period_id long, id string, post_id long, event_type double")
    out = {r.period_id: r.event_type for r in aggregate_periods(ok, label_agg="constant").collect()}
    assert out == {0: 1.0, 1: 0.0}
    mixed = ok.union(spark.createDataFrame([("m", 1, "m:1", 3, 1.0)], ok.schema))
    with pytest.raises(ValueError, match="1 periods"):
        aggregate_periods(mixed, label_agg="constant")
