import random

from pyspark.sql import functions as F

from docflow.operators.ordered import earliest_by_key, latest_by_key, ordinal, running


def events(n=600, seed=3):
    """One key holds two thirds of the rows, in bursts."""
    rng = random.Random(seed)
    order = rng.sample(range(100_000), n)
    return [("hot" if rng.random() < 0.66 else f"k{rng.randrange(40)}", o if o % 2 else 50_000 + o // 1000, rng.randrange(9))
            for o in order]


def expected(rows):
    out, by_key = {}, {}
    for key, order, value in sorted(rows, key=lambda r: r[1]):
        seen = by_key.setdefault(key, [])
        seen.append(value)
        out[key, order] = (len(seen) - 1, sum(seen), min(seen), max(seen))
    return out


def test_running_totals_equal_brute_force_across_slices(spark):
    rows = list({(k, o): (k, o, v) for k, o, v in events()}.values())
    df = spark.createDataFrame(rows, "key STRING, seq BIGINT, v BIGINT")
    want = expected(rows)
    for slice_rows, dense in ((7, False), (100, False), (10**6, False), (1000, True)):
        got = running(
            df, ["key"], ["seq"],
            {"n": ("sum", F.lit(1)), "s": ("sum", F.col("v")), "lo": ("min", F.col("v")), "hi": ("max", F.col("v"))},
            slice_rows=slice_rows, dense=dense,
        ).collect()
        assert {(r.key, r.seq): (r.n - 1, r.s, r.lo, r.hi) for r in got} == want


def test_ordinal_counts_from_zero(spark):
    df = spark.createDataFrame([("a", 5), ("a", 1), ("b", 9)], "key STRING, seq BIGINT")
    got = {(r.key, r.seq): r.ord for r in ordinal(df, ["key"], ["seq"], slice_rows=1).collect()}
    assert got == {("a", 1): 0, ("a", 5): 1, ("b", 9): 0}


def test_latest_and_earliest_keep_null_values(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None)], "key STRING, seq INT, v STRING")
    assert latest_by_key(df, ["key"], "seq").first().v is None
    assert earliest_by_key(df, ["key"], "seq").first().v == "x"


def test_hot_key_is_cut_before_the_window(spark):
    """No window partition may be a whole hot key."""
    df = spark.range(1000).select(F.lit("hot").alias("key"), F.col("id").alias("seq"))
    plan = ordinal(df, ["key"], ["seq"], slice_rows=100)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window [" in line]
    assert any("_slice" in w for w in windows)
    assert all("_slice" in w for w in windows if "seq" in w)
