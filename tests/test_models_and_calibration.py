import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from loanweft.functions.checks import DataCheckError
from loanweft.operators import calibration, features, models


@pytest.fixture(scope="module")
def loans():
    rng = np.random.default_rng(11)
    n = 400
    frame = pd.DataFrame({
        "id": range(n), "income": rng.normal(50, 10, n).round(2), "flat": 7.0,
        "length": [None if i % 9 == 0 else ["1 year", "10+ years", " n"][i % 3] for i in range(n)]})
    frame.loc[::7, "income"] = None
    score = (frame.income.fillna(50) - 50) / 10 + (frame.length == "10+ years")
    frame["bad_loan"] = (rng.random(n) < 1 / (1 + np.exp(-score))).astype(int)
    return frame


COLUMNS = features.FeatureColumns(("income", "flat"), ("length",))


def test_median_of_an_even_count_is_the_mean_of_the_middle(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, None), (100.0, 5.0)], "a double, b double")
    for size in (1, 100):
        assert features.exact_medians(df, ["a", "b"], rows_per_part=size) == {"a": 2.5, "b": 5.0}


def test_numeric_statistics(spark, loans):
    got = features.numeric_statistics(spark.createDataFrame(loans), ["income", "flat"])
    filled = loans.income.fillna(loans.income.median())
    s = got["income"]
    assert (s.median, s.mean, s.scale) == pytest.approx((loans.income.median(), filled.mean(), filled.std(ddof=0)))
    assert got["flat"].scale == 1.0
    with pytest.raises(DataCheckError, match="without values"):
        features.numeric_statistics(spark.createDataFrame([(1, None)], "a int, b double"), ["a", "b"])


def test_prepared_vectors(spark, loans, tmp_path):
    df = spark.createDataFrame(loans)
    fitted = features.fit_features(df, COLUMNS)
    assert list(fitted.names) == ["numeric__income", "numeric__flat", "categorical__length_ n", "categorical__length_1 year",
                                  "categorical__length_10+ years", "categorical__length_Missing"]
    new = spark.createDataFrame([(1, None, 7.0, "never seen"), (2, 50.0, 8.0, None)], "id int, income double, flat double, length string")
    values = {row.id: list(row.v) for row in fitted.transform(new, ["id"]).select("id", vector_to_array("features").alias("v")).collect()}
    s = fitted.statistics["income"]
    assert values[1] == pytest.approx([(s.median - s.mean) / s.scale, 0, 0, 0, 0, 0])
    assert values[2] == pytest.approx([(50 - s.mean) / s.scale, 1, 0, 0, 0, 1])
    from loanweft.sources import load_model, save_model
    save_model(fitted.pipeline, str(tmp_path / "p"))
    again = load_model(spark, str(tmp_path / "p"), "pipeline").transform(new).select("id", vector_to_array("features").alias("v"))
    assert {row.id: list(row.v) for row in again.collect()} == values


def test_logistic_fit_has_zero_gradient(spark, loans):
    df = spark.createDataFrame(loans)
    prepared = features.fit_features(df, COLUMNS).transform(df, ["id", "bad_loan"])
    model = models.fit_logistic(prepared)
    scored = models.score_logistic(model, prepared, ["id", "bad_loan", "features"]).select(
        "bad_loan", "p", "z", vector_to_array("features").alias("x")).toPandas()
    x, residual = np.array(scored.x.tolist()), (scored.p - scored.bad_loan).to_numpy()
    slope = x.T @ residual + model.coefficients.toArray()
    assert np.abs(slope).max() < 1e-3 and abs(residual.sum()) < 1e-3
    assert np.allclose(scored.p, 1 / (1 + np.exp(-scored.z)))
    report = models.coefficient_report(models.coefficient_table(model, list("abcdef"), df)).collect()
    sizes = [row.absolute_coefficient for row in report]
    assert sizes == sorted(sizes, reverse=True) and [row.coefficient_rank for row in report] == [1, 2, 3, 4, 5, 6]
    with pytest.raises(DataCheckError, match="feature names"):
        models.coefficient_table(model, ["a"], df)
    with pytest.raises(DataCheckError, match="both classes"):
        models.fit_logistic(prepared.where("bad_loan = 1"))


def test_prior(spark, loans):
    df = spark.createDataFrame(loans)
    values = {row.p_prior for row in models.apply_prior(df, models.prior_rate(df)).select("p_prior").collect()}
    assert len(values) == 1 and values.pop() == pytest.approx(loans.bad_loan.mean())


@pytest.fixture(scope="module")
def scores():
    rng = np.random.default_rng(5)
    z = rng.normal(0, 1.5, 2000).round(2)
    z[:600] = 0.5
    return pd.DataFrame({"id": range(2000), "z": z, "bad_loan": (rng.random(2000) < 1 / (1 + np.exp(-(0.6 * z - 0.7)))).astype(int)})


def test_intercept_shift(spark, scores):
    df = spark.createDataFrame(scores)
    shift = calibration.fit_intercept_shift(df)
    p = 1 / (1 + np.exp(-(scores.z + shift)))
    assert abs((p - scores.bad_loan).mean()) < 1e-10
    assert calibration.fit_intercept_shift(df, lower=1.0, upper=2.0) == pytest.approx(1.0, abs=1e-6)
    with pytest.raises(ValueError):
        calibration.fit_intercept_shift(df, lower=1.0, upper=1.0)
    with pytest.raises(ValueError):
        calibration.apply_intercept_shift(F.col("z"), math.inf)


def test_intercept_shift_far_from_the_start(spark):
    df = spark.createDataFrame([(-30.0 + i * 0.01, 1 if i % 2 else 0) for i in range(100)], "z double, bad_loan int")
    assert calibration.fit_intercept_shift(df) == pytest.approx(10.0, abs=1e-6)


def test_platt(spark, scores):
    platt = calibration.fit_platt(spark.createDataFrame(scores))
    p = 1 / (1 + np.exp(-(platt.scale * scores.z + platt.intercept)))
    assert abs((p - scores.bad_loan).mean()) < 1e-10 and abs(((p - scores.bad_loan) * scores.z).mean()) < 1e-10
    assert platt.scale == pytest.approx(0.6, abs=0.15)
    flat = spark.createDataFrame([(1.0, 0), (1.0, 1)], "z double, bad_loan int")
    with pytest.raises(DataCheckError):
        calibration.fit_platt(flat)


def test_platt_ends_where_sums_are_rounded(spark, monkeypatch):
    """Log-odds far from 0, whose sums have large rounding errors: few passes, and the fit of the same rows around 0."""
    rng = np.random.default_rng(7)
    near = rng.normal(0, 1.0, 20_000)
    label = (rng.random(20_000) < 1 / (1 + np.exp(-(0.8 * near - 0.5)))).astype(int)
    passes, sums = [], calibration._platt_sums

    def counted(*arguments):
        passes.append(1)
        assert len(passes) <= 40
        return sums(*arguments)

    monkeypatch.setattr(calibration, "_platt_sums", counted)
    far = calibration.fit_platt(spark.createDataFrame(pd.DataFrame({"z": near + 1000.0, "bad_loan": label})))
    passes.clear()
    expected = calibration.fit_platt(spark.createDataFrame(pd.DataFrame({"z": near, "bad_loan": label})))
    assert far.scale == pytest.approx(expected.scale, abs=1e-6)
    assert far.intercept + 1000.0 * far.scale == pytest.approx(expected.intercept, abs=1e-6)


def pooled(z, y):
    """Pool adjacent violators over distinct z."""
    table = pd.DataFrame({"z": z, "y": y}).groupby("z").y.agg(["sum", "count"])
    blocks = []
    for point, row in table.iterrows():
        blocks.append([row["sum"], row["count"], [point]])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            s, n, points = blocks.pop()
            blocks[-1][0] += s
            blocks[-1][1] += n
            blocks[-1][2] += points
    return {point: s / n for s, n, points in blocks for point in points}


def test_isotonic(spark, scores):
    df = spark.createDataFrame(scores)
    model = calibration.fit_isotonic(df)
    got = calibration.apply_isotonic(model, df).toPandas()
    fit = pooled(scores.z, scores.bad_loan)
    assert np.allclose(got.p_isotonic, [fit[z] for z in got.z])
    ordered = got.sort_values("z").p_isotonic
    assert (ordered.diff().dropna() >= -1e-15).all() and got.p_isotonic.between(0, 1).all()
    steps = calibration.isotonic_steps(model, df).orderBy("boundary").collect()
    assert steps[0].boundary == scores.z.min() and steps[-1].boundary == scores.z.max()


def test_isotonic_ties_interpolation_and_ends(spark):
    df = spark.createDataFrame([(0.0, 0), (0.0, 1), (0.0, 0), (0.0, 0), (2.0, 1), (2.0, 1), (2.0, 0), (2.0, 1)], "z double, bad_loan int")
    points = spark.createDataFrame([(-9.0,), (0.0,), (1.0,), (2.0,), (9.0,)], "z double")
    got = [row.p_isotonic for row in calibration.apply_isotonic(calibration.fit_isotonic(df), points).orderBy("z").collect()]
    assert got == pytest.approx([0.25, 0.25, 0.5, 0.75, 0.75])


def test_calibrator_guards(spark):
    for rows in ([(float("nan"), 0), (1.0, 1)], [(1.0, 1), (2.0, 1)], [(None, 0), (1.0, 1)]):
        with pytest.raises(DataCheckError):
            calibration.enforce_log_odds(spark.createDataFrame(rows, "z double, bad_loan int"))


def test_reconstruction(spark):
    df = spark.createDataFrame([(0.0, 0.5), (0.0, 0.6), (0.0, None)], "z double, p double")
    assert [row.p for row in calibration.check_reconstruction(df).collect()] == [0.6]
