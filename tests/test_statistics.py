import random
import statistics

import pytest
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from cityweave.operators import charts, crosstab, profile
from cityweave.operators import quantiles as quantile_module
from cityweave.operators.quantiles import quantiles

LEVELS = {"a": 0.0, "b": 0.1, "c": 0.25, "d": 0.5, "e": 0.77, "f": 1.0}


def numbers(spark, shape):
    r = random.Random(3)
    rows = []
    for g in ("x", "y", "z"):
        for _ in range({"x": 2000, "y": 101, "z": 1}[g]):
            v = {"even": r.uniform(-5, 50), "spiky": r.lognormvariate(0, 6), "copies": float(r.choice([1, 1, 1, 2, 7])),
                 "scales": r.choice([-1, 1]) * 10.0 ** r.randint(-30, 30), "infinite": r.choice([r.random(), float("inf")])}[shape]
            rows.append((g, v))
    rows += [("x", None), ("y", float("nan")), (None, 1.0)]
    return spark.createDataFrame(rows, "g string, v double")


@pytest.mark.parametrize("few", [0, 3, 100_000])
@pytest.mark.parametrize("shape,by", [("even", ["g"]), ("spiky", []), ("copies", ["g"]), ("scales", []), ("infinite", ["g"])])
def test_quantiles_equal_the_built_in(spark, shape, by, few):
    df = numbers(spark, shape)
    kept = df.where("v is not null and not isnan(v)" + "".join(f" and {c} is not null" for c in by))
    levels = F.array(*map(F.lit, LEVELS.values()))
    built_in = sorted((*r[:-1], *r[-1]) for r in kept.groupBy(*by).agg(F.percentile("v", levels)).collect())
    found = sorted(map(tuple, quantiles(df, "v", LEVELS, by, few=few).collect()))
    assert len(built_in) == len(found) == (3 if by else 1)
    for b, r in zip(built_in, found):
        assert b[: len(by)] == r[: len(by)] and r[len(by) :] == pytest.approx(b[len(by) :], rel=1e-12)


@pytest.mark.parametrize("by", [[], ["g"]])
def test_quantiles_take_two_scans(spark, by, monkeypatch):
    """However the values lie, a sketch and one more pass; and a sketch that is wrong changes nothing."""
    df = spark.range(60_000).select((F.col("id") % 3).alias("g"), F.exp(F.randn(5) * 3).alias("v"))
    labels = []
    durable = quantile_module.durable
    monkeypatch.setattr(quantile_module, "durable", lambda frame, label: labels.append(label) or durable(frame, label))
    built_in = df.groupBy(*by).agg(*[F.percentile("v", F.lit(p)).alias(k) for k, p in LEVELS.items()]).orderBy(*by, "a")
    found = quantiles(df, "v", LEVELS, by, few=5_000).orderBy(*by, "a")
    expected = [r.asDict() for r in built_in.collect()]
    assert [r.asDict() for r in found.collect()] == [pytest.approx(r) for r in expected]
    assert labels == ["quantile-profile", "quantile-values"]
    monkeypatch.setattr(F, "percentile_approx", lambda v, around, accuracy: F.array(*[F.lit(0.5)] * len(around)))
    found = quantiles(df, "v", LEVELS, by, few=5_000).orderBy(*by, "a")
    assert [r.asDict() for r in found.collect()] == [pytest.approx(r) for r in expected]


def test_quantiles_of_weights_ends_and_nothing(spark):
    df = spark.createDataFrame([(1.0, 3), (2.0, 1), (9.0, 0), (5.0, 2)], "v double, n int")
    assert tuple(quantiles(df, "v", {"low": 0.0, "mid": 0.5, "high": 1.0}, weight="n", few=0).first()) == (1.0, 1.5, 5.0)
    ends = spark.createDataFrame([(-1.7e308,), (0.5,), (1.7e308,), (float("-inf"),), (float("inf"),)], "v double")
    levels = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.75, "e": 1.0}
    found = quantiles(ends, "v", levels, few=0).first()
    assert tuple(found) == (float("-inf"), -1.7e308, 0.5, 1.7e308, float("inf"))
    assert tuple(quantiles(df.limit(0), "v", levels).first()) == (None,) * 5


def test_describe_skips_missing(spark):
    df = numbers(spark, "even")
    values = [r.v for r in df.collect() if r.v is not None and r.v == r.v]
    for d in (profile.describe(df, "v").first(), profile.describe(df, "v", few=0).first()):
        assert d.n == len(values)
        assert d.mean == pytest.approx(statistics.fmean(values)) and d.std == pytest.approx(statistics.stdev(values))
        assert (d.min, d.max) == (min(values), max(values))
        assert [d.p25, d.p50, d.p75] == pytest.approx(statistics.quantiles(values, n=4, method="inclusive"))


def table(spark, cells):
    rows = [(r, c) for (r, c), n in cells.items() for _ in range(n)]
    return spark.createDataFrame(rows, "r string, c string")


@pytest.mark.parametrize("shape", [(3, 4), (2, 4), (4, 2), (3, 3)])
def test_chi_square_equals_the_ml_test(spark, shape):
    r = random.Random(sum(shape))
    cells = {(f"r{i}", f"c{j}"): r.randint(0, 30) for i in range(shape[0]) for j in range(shape[1])}
    cells["r0", "c1"] = 0
    df = table(spark, cells)
    ours = crosstab.chi_square(crosstab.observed_cells(df, "r", "c"), "r", "c").first()
    indexed = StringIndexer(inputCols=["r", "c"], outputCols=["ri", "ci"]).fit(df).transform(df)
    vectors = VectorAssembler(inputCols=["ci"], outputCol="features").transform(indexed)
    theirs = ChiSquareTest.test(vectors, "features", "ri", True).first()
    assert ours.dof == theirs.degreesOfFreedom
    assert ours.statistic == pytest.approx(theirs.statistic, rel=1e-10)
    assert ours.p_value == pytest.approx(theirs.pValue, abs=1e-9)


@pytest.mark.parametrize("cells,statistic", [
    ({("a", "x"): 10, ("a", "y"): 20, ("b", "x"): 30, ("b", "y"): 5}, None),
    ({("a", "x"): 10, ("b", "x"): 3, ("b", "y"): 5}, None),
    ({("a", "x"): 10, ("b", "y"): 5}, None),
])
def test_one_degree_of_freedom_uses_the_yates_correction(spark, cells, statistic):
    total = sum(cells.values())
    rows = {r: sum(n for (a, _), n in cells.items() if a == r) for r in "ab"}
    cols = {c: sum(n for (_, b), n in cells.items() if b == c) for c in "xy"}
    expected = 0.0
    for r in rows:
        for c in cols:
            e = rows[r] * cols[c] / total
            d = abs(cells.get((r, c), 0) - e)
            expected += (d - min(0.5, d)) ** 2 / e
    got = crosstab.chi_square(crosstab.observed_cells(table(spark, cells), "r", "c"), "r", "c").first()
    assert got.dof == 1 and got.statistic == pytest.approx(expected)
    assert got.verdict == ("significant" if got.p_value < 0.05 else "not significant")


def test_full_table_shares_and_wide_form(spark):
    df = table(spark, {("a", "x"): 3, ("a", "y"): 1, ("b", "y"): 2}).union(spark.createDataFrame([(None, "x"), ("a", None)], "r string, c string"))
    cells = crosstab.observed_cells(df, "r", "c")
    full = {(r.r, r.c): (r.n, r.row_total, r.column_total, r.total) for r in crosstab.full_table(cells, "r", "c", ["x", "y"]).collect()}
    assert full == {("a", "x"): (3, 4, 3, 6), ("a", "y"): (1, 4, 3, 6), ("b", "x"): (0, 2, 3, 6), ("b", "y"): (2, 2, 3, 6)}
    shares = crosstab.row_share(cells, "r", "c", 100).groupBy("r").agg(F.sum("share").alias("s")).collect()
    assert all(r.s == pytest.approx(100) for r in shares)
    wide = sorted(map(tuple, crosstab.wide(df, "r", "c", ["x", "y", "z"]).collect()))
    assert wide == [("a", 3, 1, 0, 0), ("b", 0, 2, 0, 0)]
    assert sorted(map(tuple, crosstab.wide(df, "r", "c", ["x"]).collect())) == [("a", 3, 1), ("b", 0, 2)]
    assert sorted(map(tuple, crosstab.wide(df, "r", "c", ["x", "y"], empty=None).collect())) == [("a", 3, 1, None), ("b", None, 2, None)]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in list(range(0, 91)) + [90, 90]] + [(None,), (float("nan"),)], "v double")
    rows = charts.histogram(df, "v").orderBy("bin").collect()
    assert len(rows) == 30 and [r.n for r in rows] == [3] * 29 + [6]
    assert (rows[0].lower_edge, rows[-1].upper_edge) == (0.0, 90.0)
    single = charts.histogram(spark.createDataFrame([(5.0,)] * 4, "v double"), "v").collect()
    assert sum(r.n for r in single) == 4 and {r.bin for r in single if r.n} == {16}


def test_box_plot(spark):
    rows = [("a", float(v)) for v in [1, 2, 3, 4, 5, 6, 7, 8, 100]] + [("b", 5.0), ("c", None)]
    for limit in (0, 1000):
        got = {r.g: r for r in charts.box_plot(spark.createDataFrame(rows, "g string, v double"), "g", "v", few=limit).collect()}
        assert set(got) == {"a", "b"}
        a, b = got["a"], got["b"]
        assert (a.q1, a.median, a.q3, a.n, a.whisker_low, a.whisker_high, a.n_outliers) == (3, 5, 7, 9, 1, 8, 1)
        assert (b.q1, b.whisker_low, b.whisker_high, b.n_outliers) == (5, 5, 5, 0)


def test_binned_density_is_close_to_exact(spark):
    r = random.Random(1)
    df = spark.createDataFrame([(r.gauss(10, 3),) for _ in range(3000)] + [(None,)], "v double")
    curve = charts.density(df, "v", bins=None).collect()
    exact, xs = {p.point: p.density for p in curve}, [p.x for p in curve]
    binned = {p.point: p.density for p in charts.density(df, "v").collect()}
    width, bandwidth = (max(xs) - min(xs)) / charts.CURVE_PARTS, 3 * 3000**-0.2
    assert len(exact) == 200
    assert max(abs(exact[k] - binned[k]) for k in exact) < 0.1 * (width / bandwidth) ** 3 / bandwidth + 1e-15
    assert 0.95 < sum(exact.values()) * (max(xs) - min(xs)) / 199 < 1.01


def test_density_of_equal_values_is_unknown(spark):
    df = spark.createDataFrame([(2.0,)] * 5, "v double")
    for bins in (None, 16):
        assert {p.density for p in charts.density(df, "v", bins=bins).collect()} == {None}


def test_correlation_uses_pairwise_complete_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, 4.0, 1.0), (3.0, 6.5, 0.0), (4.0, None, 5.0)], "a double, b double, c double")
    got = {(r.row_variable, r.column_variable): r.correlation for r in profile.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert len(got) == 9 and got["a", "a"] == 1.0 and got["a", "b"] == got["b", "a"]
    assert got["a", "b"] == pytest.approx(statistics.correlation([1, 2, 3], [2, 4, 6.5]))
    assert got["a", "c"] == pytest.approx(statistics.correlation([2, 3, 4], [1, 0, 5]))


def test_counts_rank_ties_by_value_and_drop_null(spark):
    df = spark.createDataFrame([(v,) for v in ["b", "a", "c", "c", None, None, None]], "v string")
    assert [tuple(r) for r in profile.value_counts(df, "v").collect()] == [("c", 2), ("a", 1), ("b", 1)]
    assert [r.v for r in profile.top_values(df, "v", 2).collect()] == ["c", "a"]
    assert [r.v for r in profile.frequent_values(df, "v", 2).collect()] == ["c"]
    assert profile.keep_top_values(df, "v", 2).count() == 3


def test_top_types_are_picked_on_all_rows(spark):
    everything = spark.createDataFrame([("a", 0)] * 3 + [("b", 1)] * 2, "v string, h int")
    assert profile.keep_top_values(everything.where("h > 0"), "v", 1, everything).count() == 0


def test_nlargest_skips_missing_and_breaks_ties(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 9.0), (3, 9.0), (4, None)], "k int, v double")
    assert [r.k for r in profile.nlargest(df, "v", 2, "k").collect()] == [2, 3]
    assert profile.nlargest(df, "v", 10, "k").count() == 3


@pytest.mark.parametrize("n", [0, 1, 100, 999, 1000, 5000])
def test_sample_is_exact_and_independent_of_partitions(spark, n):
    df = spark.range(1000).withColumnRenamed("id", "k")
    picked = sorted(r.k for r in profile.sample_n(df, n, "k").collect())
    again = sorted(r.k for r in profile.sample_n(df.repartition(7), n, "k").collect())
    assert len(picked) == min(n, 1000) and picked == again
    if n == 100:
        assert picked != sorted(r.k for r in profile.sample_n(df, n, "k", seed=7).collect())


def test_sample_of_copies_has_the_exact_size(spark):
    df = spark.range(1000).select(F.lit(1).alias("k"))
    assert profile.sample_n(df, 10, "k").count() == 10


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert [tuple(r) for r in profile.null_profile(df).collect()] == [(1, "a", 1), (2, "b", 2)]
