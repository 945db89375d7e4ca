"""Models against small solutions of our own, and properties that must hold."""

from __future__ import annotations

import itertools
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from churnlake.operators import cox
from churnlake.operators import explore as X
from churnlake.operators import mlprep as M
from churnlake.operators import models as L
from churnlake.operators import segment as G


@pytest.fixture(scope="module")
def survival(spark):
    rng = np.random.default_rng(11)
    n = 600
    x = rng.normal(size=(n, 2)) * [1.0, 30.0] + [0.0, 100.0]
    rate = np.exp(0.8 * x[:, 0] - 0.02 * (x[:, 1] - 100))
    time = np.ceil(rng.exponential(1.0 / rate) * 10).clip(max=25).astype(int)   # many ties
    event = ((time < 25) & (rng.random(n) < 0.8)).astype(int)
    pdf = pd.DataFrame({"duration": time, "event": event, "a": x[:, 0], "b": x[:, 1]})
    return pdf, spark.createDataFrame(pdf)


def efron(pdf: pd.DataFrame, beta: np.ndarray):
    """Row-level log-likelihood, gradient and information."""
    x = pdf[["a", "b"]].to_numpy()
    t, e = pdf["duration"].to_numpy(), pdf["event"].to_numpy()
    w = np.exp(x @ beta)
    value, grad, info = 0.0, np.zeros(2), np.zeros((2, 2))
    for day in np.unique(t[e == 1]):
        risk, died = t >= day, (t == day) & (e == 1)
        for k in range(died.sum()):
            weight = np.where(died, 1 - k / died.sum(), 1.0) * w * risk
            mean = weight @ x / weight.sum()
            value -= np.log(weight.sum())
            grad -= mean
            info += (x * weight[:, None]).T @ x / weight.sum() - np.outer(mean, mean)
        value += (x[died] @ beta).sum()
        grad += x[died].sum(axis=0)
    return value, grad, info


def test_cox_equals_row_level_newton(survival):
    pdf, df = survival
    beta = np.zeros(2)
    for _ in range(30):
        _, grad, info = efron(pdf, beta)
        beta = beta + np.linalg.solve(info, grad)
    se = np.sqrt(np.diag(np.linalg.inv(efron(pdf, beta)[2])))
    rows = {r["covariate"]: r for r in cox.cox_fit(df, ["a", "b"]).collect()}
    for i, name in enumerate(["a", "b"]):
        assert rows[name]["coef"] == pytest.approx(beta[i], rel=1e-4)
        assert rows[name]["se"] == pytest.approx(se[i], rel=1e-4)
        assert rows[name]["hazard_ratio"] == pytest.approx(np.exp(beta[i]), rel=1e-4)
    assert rows["a"]["coef_low"] < 0.8 < rows["a"]["coef_high"]


@pytest.mark.parametrize("deaths", [1, 7, 1024, 1025, 3000, 200_000])
@pytest.mark.parametrize("survivors", [0.0, 3.5, 1e9])
def test_tied_sums_equal_the_sums_over_events(deaths, survivors):
    e0 = 0.7 * deaths
    s0 = e0 + survivors
    share = np.arange(deaths) / deaths
    r = 1 / (survivors + e0 * (np.arange(deaths, 0, -1) / deaths))
    expected = [np.log(r), r, share * r, r * r, share * r * r, share * share * r * r]
    np.testing.assert_allclose(
        cox.tied_sums(deaths, s0, s0 - survivors), [v.sum() for v in expected], rtol=1e-7)


def test_a_billion_tied_events_take_no_time():
    start = time.time()
    sums = [cox.tied_sums(1_000_000_000, 3e9, 1e9) for _ in range(100)]
    assert time.time() - start < 2
    assert sums[0][1] == pytest.approx(np.log(1.5), rel=1e-6)  # integral of dt / (3 - t)


def test_cox_sums_give_the_row_level_gradient(survival):
    pdf, df = survival
    beta = np.array([0.3, -0.01])
    sums = cox._duration_sums(df, "duration", "event", ["a", "b"], np.zeros(2), np.ones(2), beta)
    got, expected = cox._likelihood(sums, beta), efron(pdf, beta)
    for mine, theirs in zip(got, expected):
        np.testing.assert_allclose(mine, theirs, rtol=1e-9)


@pytest.fixture(scope="module")
def churners(spark):
    rng = np.random.default_rng(5)
    n = 800
    x = rng.normal(size=(n, 3)) * [1, 5, 0.2]
    churn = (rng.random(n) < 1 / (1 + np.exp(-(x[:, 0] * 1.5 - x[:, 1] * 0.2 - 0.5)))).astype(int)
    pdf = pd.DataFrame(x, columns=["p", "q", "r"]).assign(
        user_id=np.arange(n), churn=churn, gender=np.where(x[:, 2] > 0, "MALE", "FEMALE"),
        age=25, gender_bin=1,
    )
    return spark.createDataFrame(pdf)


def test_logistic_equals_a_newton_solution(churners):
    prepared, design = L.prepare(churners, "user_id", "churn", ["p", "q", "r"], ["gender"])
    fitted = L.fit_models(prepared, design, {"logistic": L.Logistic()}, "user_id")
    train = prepared.where("split = 'train'").toPandas()
    x = np.column_stack([
        *[(train[c] - design.scaler.means[c]) / design.scaler.scales[c] for c in ("p", "q", "r")],
        train["gender_MALE"], np.ones(len(train)),
    ])
    y, w = train["label"].to_numpy(), train["weight"].to_numpy()
    theta, penalty = np.zeros(5), np.diag([1, 1, 1, 1, 0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ theta))
        grad = x.T @ (w * (p - y)) + penalty @ theta
        theta -= np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + penalty, grad)
    got = {r["feature"]: r["coef"] for r in L.coefficients(fitted).collect()}
    assert list(got) == ["p", "q", "r", "gender_MALE"]
    np.testing.assert_allclose(list(got.values()), theta[:4], atol=2e-4)


def test_models_rank_better_than_chance_and_report_importance(churners):
    from churnlake.operators import evaluate as V

    prepared, design = L.prepare(churners, "user_id", "churn", ["p", "q", "r"], ["gender"])
    fitted = L.fit_models(
        prepared, design, {"rf": L.Forest(15), "gbt": L.Boosting(8, 3, 0.2)}, "user_id",
        carry=["age", "q"],
    )
    assert {r["model"]: r["roc_auc"] > 0.75 for r in V.auc(fitted.scores, ["model"]).collect()} \
        == {"rf": True, "gbt": True}
    assert set(fitted.scores.columns) == {"model", "id", "label", "score", "age", "q"}
    table = L.importances(fitted, "rf")
    assert table.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    assert L.top_importances(fitted, "rf", 1).first()["feature"] == "p"


def test_several_models_compare_with_a_small_driver(spark):
    """The forest of several models was collected, and sent again with the code of every scoring task."""
    from churnlake.operators import evaluate as V

    rows = spark.range(4000).select(
        F.col("id").alias("user_id"), *[F.rand(i).alias(c) for i, c in enumerate("pqr")],
        (F.rand(9) > 0.5).cast("int").alias("churn"))
    specs, conf = {"rf": L.Forest(30, 2), "gbt": L.Boosting(5, 3)}, spark.sparkContext._jsc.sc().conf()
    conf.set("spark.driver.maxResultSize", "300k")
    try:
        prepared, design = L.prepare(rows, "user_id", "churn", ["p", "q", "r"])
        fitted = L.fit_models(prepared, design, specs, "user_id", carry=["q"])
        table = V.compare_models(fitted.scores).collect()
    finally:
        conf.remove("spark.driver.maxResultSize")
    assert {r["model"] for r in table} == {"rf", "gbt"}
    assert fitted.scores.groupBy("model").count().toPandas()["count"].nunique() == 1


def test_carried_columns_are_raw_not_scaled(churners):
    prepared, design = L.prepare(churners, "user_id", "churn", ["p", "q", "r"])
    fitted = L.fit_models(prepared, design, {"m": L.Logistic()}, "user_id", carry=["q"])
    raw = {r["user_id"]: r["q"] for r in churners.collect()}
    assert all(raw[r["id"]] == r["q"] for r in fitted.scores.collect())


def test_one_hot(spark):
    df = spark.createDataFrame(
        [(1, "a", True), (2, "b", False), (3, None, None), (4, "c", True)],
        "id INT, g STRING, flag BOOLEAN",
    )
    known = M.levels(df, ["g", "flag"])
    assert known == {"g": ["a", "b", "c"], "flag": ["False", "True"]}
    encoded, names = M.one_hot(df, known)
    assert names == ["g_a", "g_b", "g_c", "flag_True"]
    rows = {r["id"]: [r[n] for n in names] for r in encoded.collect()}
    assert rows == {1: [1, 0, 0, 1], 2: [0, 1, 0, 0], 3: [0, 0, 0, 0], 4: [0, 0, 1, 1]}
    assert M.one_hot(df, known, drop="first")[1] == ["g_b", "g_c", "flag_True"]


def test_scaler_keeps_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a DOUBLE, c DOUBLE")
    assert M.fit_scaler(df, ["a", "c"]).apply(df).collect() == [(-1.0, 0.0), (1.0, 0.0)]


def brute_ward(points: np.ndarray) -> list[float]:
    """Heights by trying every pair at every step."""
    clusters = [[i] for i in range(len(points))]
    heights = []
    while len(clusters) > 1:
        def cost(pair):
            a, b = points[clusters[pair[0]]], points[clusters[pair[1]]]
            gap = ((a.mean(0) - b.mean(0)) ** 2).sum()
            return 2 * len(a) * len(b) / (len(a) + len(b)) * gap
        i, j = min(itertools.combinations(range(len(clusters)), 2), key=cost)
        heights.append(np.sqrt(cost((i, j))))
        clusters[i] += clusters.pop(j)
    return heights


def test_ward_merges_equal_brute_force():
    points = np.random.default_rng(2).normal(size=(25, 3))
    merges = G.ward_merges(points, np.ones(25))
    np.testing.assert_allclose([m[2] for m in merges], brute_ward(points))
    assert merges[-1][3] == 25
    assert sorted(i for m in merges for i in m[:2]) == list(range(48))


def test_weighted_ward_equals_repeated_points():
    rng = np.random.default_rng(4)
    points, copies = rng.normal(size=(8, 2)), rng.integers(1, 5, 8)
    repeated = brute_ward(np.repeat(points, copies, axis=0))
    merges = G.ward_merges(points, copies.astype(float))
    np.testing.assert_allclose([m[2] for m in merges], repeated[-7:])


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(9)
    centres = np.array([[0, 0], [12, 0], [0, 12], [12, 12]])
    tag = np.arange(240) % 4
    x = centres[tag] + rng.normal(size=(240, 2))
    pdf = pd.DataFrame({"user_id": np.arange(240), "tag": tag, "a": x[:, 0], "b": x[:, 1],
                        "churn": tag % 2})
    return pdf, G.scaled_vectors(spark.createDataFrame(pdf), ["a", "b"]).cache()


def recovered(rows, cluster) -> bool:
    pairs = {(r["tag"], r[cluster]) for r in rows.select("tag", cluster).collect()}
    return len(pairs) == 4


def test_clusters_are_recovered(blobs):
    _, vectors = blobs
    assert recovered(G.kmeans(vectors, 4)[0], "kmeans_cluster")
    grouped, merges = G.ward(vectors, 4, micro=30)
    assert recovered(grouped, "hclust_cluster")
    assert merges.count() == 29
    table = X.cluster_summary(grouped, "hclust_cluster", ["a", "b"]).collect()
    assert [r["size"] for r in table] == [60] * 4


def exact_silhouette(x: np.ndarray, tag: np.ndarray) -> float:
    gaps = ((x[:, None] - x[None]) ** 2).sum(2)
    out = []
    for i in range(len(x)):
        same = (tag == tag[i]) & (np.arange(len(x)) != i)
        others = [gaps[i, tag == g].mean() for g in set(tag) - {tag[i]}]
        a, b = (gaps[i, same].mean() if same.any() else 0.0), min(others, default=0.0)
        out.append((b - a) / max(a, b) if same.any() and others and max(a, b) > 0 else 0.0)
    return float(np.mean(out))


def test_silhouette_of_all_rows_is_exact(blobs):
    pdf, vectors = blobs
    z = vectors.select("z_a", "z_b").toPandas().to_numpy()
    got = G.silhouette(vectors, "tag").first()
    assert got["n"] == 240
    assert got["silhouette"] == pytest.approx(exact_silhouette(z, pdf["tag"].to_numpy()))


def test_silhouette_of_lone_rows_single_clusters_and_nothing(spark):
    def score(rows):
        df = spark.createDataFrame(rows, "tag INT, a DOUBLE, b DOUBLE")
        made = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
        return G.silhouette(made, "tag").first()

    rows = [(0, 0.0, 0.0), (0, 0.0, 0.0), (0, 1.0, 0.0), (1, 5.0, 5.0), (2, 5.0, 4.0), (2, 6.0, 4.0)]
    x, tag = np.array([r[1:] for r in rows]), np.array([r[0] for r in rows])
    assert score(rows)["silhouette"] == pytest.approx(exact_silhouette(x, tag))
    assert score(rows[:3])["silhouette"] == 0.0
    assert tuple(score([])) == (None, 0)


def test_pca_sign_and_variance(blobs):
    _, vectors = blobs
    plane, loadings = G.pca_coordinates(vectors)
    rows = loadings.toPandas()
    for _, part in rows.groupby("component"):
        assert part.loc[part["loading"].abs().idxmax(), "loading"] > 0
    assert rows.groupby("component")["explained"].first().sum() == pytest.approx(1.0)
    assert plane.count() == 240


def test_registered_ensembles_have_the_published_sizes(monkeypatch):
    from churnlake.registry import QUERIES
    from churnlake.registry import model_queries as Q

    class Fits(Exception):
        pass

    def stop(prepared, design, specs, *args, **kwargs):
        raise Fits({n: (s.trees, getattr(s, "depth", s.__dict__.get("min_leaf")))
                    for n, s in specs.items() if hasattr(s, "trees")})

    monkeypatch.setattr(Q.L, "fit_models", stop)
    for owner, name in ((Q.T, "shop_features"), (Q, "training_rows"), (Q.C, "model_input"),
                        (Q, "stage")):
        monkeypatch.setattr(owner, name, lambda *args: None)
    for name in ("driver_design", "training_design"):
        monkeypatch.setattr(Q.L, name, lambda *args: (None, None))
    forest, driver, training = {"rf": (500, 1)}, {"gbt": (600, 5)}, {"rf": (500, 2), "gbt": (800, 5)}
    for name, sizes in (("l3_forest_scores", forest), ("l4_boosting_scores", driver),
                        ("l5_feature_importance", forest), ("l12_multi_model", training)):
        with pytest.raises(Fits) as got:
            QUERIES[name](None, "")
        assert got.value.args[0] == sizes, name
    with pytest.raises(Fits) as got:
        Q.l3_forest_scores(None, "", specs={"rf": L.Forest(3, 2)})
    assert got.value.args[0] == {"rf": (3, 2)}
