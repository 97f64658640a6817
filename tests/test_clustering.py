"""Density clustering and evaluation against brute force on small fixtures."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind.operators import clustering as cl
from tradewind.operators import dbscan as density
from tradewind.operators import kmeans
from tradewind.operators import silhouette as sil
from tradewind.operators.dbscan import connected_components, dbscan


def brute_dbscan(x, eps, min_samples):
    near = ((x[:, None] - x[None]) ** 2).sum(-1) <= eps * eps
    core = near.sum(1) >= min_samples
    labels, cluster = np.full(len(x), -1), 0
    for i in range(len(x)):
        if not core[i] or labels[i] != -1:
            continue
        stack = [i]
        labels[i] = cluster
        while stack:
            p = stack.pop()
            if not core[p]:
                continue
            for q in np.flatnonzero(near[p]):
                if labels[q] == -1:
                    labels[q] = cluster
                    stack.append(q)
        cluster += 1
    return core, labels


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(5)
    blobs = [rng.normal(c, 0.25, (60, 4)) for c in ([0, 0, 0, 0], [2, 0, 1, 0], [0, 3, 0, 1])]
    copies = np.repeat([[5.0, 5.0, 5.0, 5.0]], 90, axis=0)  # one vector on a third of the rows
    return np.concatenate([*blobs, copies, rng.uniform(-4, 8, (25, 4))])


@pytest.mark.parametrize("block_points", [2000, 7])
def test_dbscan_equals_brute_force(spark, points, block_points):
    names = ["a", "b", "c", "d"]
    rows = [(i, *map(float, p)) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "id long, " + ", ".join(f"{n} double" for n in names))
    got = dbscan(df, "id", names, 0.6, 5, block_points=block_points).orderBy("id").toPandas()
    core, labels = brute_dbscan(points, 0.6, 5)
    assert got["is_core"].tolist() == core.tolist()
    assert got["dbscan_cluster"].tolist() == labels.tolist()


def test_dbscan_with_text_keys(spark, points):
    rows = [(f"k{i:05d}", *map(float, p)) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "id string, a double, b double, c double, d double")
    got = dbscan(df, "id", ["a", "b", "c", "d"], 0.6, 5).orderBy("id").toPandas()
    core, labels = brute_dbscan(points, 0.6, 5)
    assert got["is_core"].tolist() == core.tolist() and got["dbscan_cluster"].tolist() == labels.tolist()


@pytest.mark.parametrize("shape", ["line", "one", "none"])
def test_dbscan_of_odd_shapes(spark, shape):
    rng = np.random.default_rng(3)
    points = {
        "line": np.stack([np.linspace(0, 30, 300), np.zeros(300)], axis=1) + rng.normal(0, 0.02, (300, 2)) * [1, 0],
        "one": np.repeat([[1.5, -2.0]], 30, axis=0),
        "none": np.zeros((0, 2)),
    }[shape]
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(points)], "id long, a double, b double")
    got = dbscan(df, "id", ["a", "b"], 0.25, 3, block_points=20).orderBy("id").toPandas()
    core, labels = brute_dbscan(points, 0.25, 3)
    assert got["is_core"].tolist() == core.tolist() and got["dbscan_cluster"].tolist() == labels.tolist()


def test_kmeans_starts_all_at_once(spark, points):
    names = ["a", "b", "c", "d"]
    df = spark.createDataFrame([tuple(map(float, p)) for p in points], ", ".join(f"{n} double" for n in names))
    fits = kmeans.fit_kmeans_all(kmeans.weighted_points(df.repartition(7), names), [2, 4], restarts=4)
    for k, fit in fits.items():
        c = np.array(fit.centroids)
        nearest = ((points[:, None] - c[None]) ** 2).sum(-1)
        label = nearest.argmin(1)
        assert c.shape == (k, 4) and fit.centroids == sorted(fit.centroids)
        assert fit.inertia == pytest.approx(nearest.min(1).sum(), rel=1e-3)
        for i in range(k):
            assert points[label == i].mean(0) == pytest.approx(c[i], abs=1e-3)
    assert fits[4].inertia < fits[2].inertia
    few = spark.createDataFrame([(1.0,), (1.0,), (5.0,)], "a double")
    assert kmeans.fit_kmeans(kmeans.weighted_points(few, ["a"]), 4).centroids == [[1.0], [5.0]]
    assert kmeans.fit_kmeans_all(kmeans.weighted_points(few.limit(0), ["a"]), [2]) == {}


def test_silhouette_of_many_clusters_in_blocks(spark, points, monkeypatch):
    points = points[:180]  # without copies
    labels = np.arange(len(points)) // 9
    df = spark.createDataFrame([(list(map(float, p)), int(i)) for p, i in zip(points, labels)], "x array<double>, label int")
    whole = cl.silhouette_squared(df, "x", "label").first()[0]
    monkeypatch.setattr(cl, "CLUSTER_BLOCK", 5)
    assert cl.silhouette_squared(df, "x", "label").first()[0] == pytest.approx(whole, abs=1e-9)
    assert whole == pytest.approx(silhouette(points, labels, 2), abs=1e-9)


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(0, 200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    got = connected_components(spark.createDataFrame(chain + star, "u long, v long")).toPandas()
    roots = dict(zip(got["vid"], got["root"]))
    assert all(roots[i] == 0 for i in range(1, 201)) and all(roots[1000 + i] == 1000 for i in range(1, 300))


def silhouette(x, labels, power):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)) ** power
    out = []
    for i, own in enumerate(labels):
        n = (labels == own).sum()
        if n == 1:
            out.append(0.0)
            continue
        a = d[i, labels == own].sum() / (n - 1)
        b = min(d[i, labels == o].mean() for o in set(labels) if o != own)
        out.append((b - a) / max(a, b))
    return np.mean(out)


def test_silhouettes(spark, points):
    labels = np.arange(len(points)) // 55
    labels[-1] = 99  # a cluster of one row
    rows = [(i, int(g), [float(v) for v in p]) for i, (p, g) in enumerate(zip(points, labels))]
    df = spark.createDataFrame(rows, "id long, g int, x array<double>")
    want = silhouette(points, labels, 1)
    for tolerance, block_rows in ((0, 40), (0, 4096), (1e-7, 70), (0.05, 40)):
        exact = sil.measure(df, "x", "g", tolerance=tolerance, block_rows=block_rows)
        assert exact.value == pytest.approx(want, abs=max(tolerance, 1e-9))
    assert sil.silhouette(df, "x", "g").first()[0] == pytest.approx(want, abs=1e-7)
    assert cl.silhouette_squared(df, "x", "g").first()[0] == pytest.approx(silhouette(points, labels, 2), abs=1e-6)


def test_weights_stand_for_rows(spark, points):
    rows = [([float(v) for v in p], int(i % 3)) for i, p in enumerate(points[:50])]
    df = spark.createDataFrame(rows, "x array<double>, g int")
    weighted = df.withColumn("w", (F.col("g") + 1).cast("double"))
    repeated = df.withColumn("n", F.explode(F.sequence(F.lit(0), F.col("g"))))
    a = cl.silhouette_squared(weighted, "x", "g", "w").first()[0]
    assert a == pytest.approx(cl.silhouette_squared(repeated, "x", "g").first()[0], abs=1e-9)


def test_kmeans_finds_separate_blobs(spark):
    rng = np.random.default_rng(1)
    rows = [tuple(map(float, rng.normal(c, 0.1, 2))) for c in (0, 5, 10) for _ in range(40)]
    df = spark.createDataFrame(rows, "a double, b double")
    search = cl.find_optimal_k(df, ["a", "b"], max_k=4, restarts=3)
    assert search.best_k == 3
    inertias = [r["inertia"] for r in search.scores.orderBy("k").collect()]
    assert inertias == sorted(inertias, reverse=True)


def test_constant_column_is_not_divided_by_zero(spark):
    df = spark.range(5).select(F.col("id").cast("double").alias("a"), F.lit(3.0).alias("b"))
    got = cl.standardize(df, ["a", "b"]).toPandas()
    assert got["z_b"].tolist() == [0.0] * 5
    assert got["z_a"].std(ddof=0) == pytest.approx(1.0)


def test_pca_matches_numpy(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(80, 3)) @ np.array([[2, 0, 0], [1, 1, 0], [0, 0.5, 0.2]])
    x -= x.mean(0)
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    found = cl.fit_pca(df, ["a", "b", "c"])
    values, vectors = np.linalg.eigh(np.cov(x.T))
    for i in range(2):
        v = vectors[:, -1 - i]
        v = v * np.sign(v[np.argmax(np.abs(v))])
        assert np.allclose(found.loadings[i], v, atol=1e-8)
        assert found.explained[i] == pytest.approx(values[-1 - i] / values.sum())


def test_dbscan_on_one_feature_without_any_cluster(spark):
    df = spark.createDataFrame([(i, float(10 * i)) for i in range(6)], "id long, a double")
    got = dbscan(df, "id", ["a"], 1.0, 2).toPandas()
    assert got["dbscan_cluster"].tolist() == [-1] * 6 and not got["is_core"].any()


def test_uniform_numbers_depend_on_values_only():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(50_000, 3))
    u = kmeans.uniform(x, 7)
    assert (kmeans.uniform(x[::-1], 7) == u[::-1]).all() and not (kmeans.uniform(x, 8) == u).any()
    assert abs(u.mean() - 0.5) < 0.01 and abs(np.corrcoef(u, x[:, 0])[0, 1]) < 0.02 and len(np.unique(u)) == len(u)
    assert (kmeans.uniform(np.array([[0.0, 1.0]]), 1) == kmeans.uniform(np.array([[-0.0, 1.0]]), 1)).all()


def test_a_cluster_of_one_in_a_hundred_thousand_is_found(spark):
    """Ten of a million vectors, far away from the others."""
    base = spark.range(1_000_000).select(F.col("id"), F.rand(1).alias("a"), F.rand(2).alias("b"))
    far = F.col("id") % 100_000 == 7
    df = base.select(*[F.when(far, 500 + F.col(c)).otherwise(F.col(c)).alias(c) for c in ("a", "b")])
    fit = kmeans.fit_kmeans(kmeans.weighted_points(df, ["a", "b"]), 3, restarts=2)
    assert max(c[0] for c in fit.centroids) > 499


@pytest.mark.parametrize("n", [19_990, 20_010])
def test_nothing_changes_at_twenty_thousand_vectors(spark, n):
    """Three blobs and a small far one: the same centroids from slightly fewer and slightly more vectors."""
    noise = lambda s: F.rand(s) * 0.5
    blob = F.col("id") % 3
    rows = spark.range(n).select((blob * 10 + noise(3)).alias("a"), (blob * blob * 5 + noise(4)).alias("b"))
    few = spark.range(4).select((100 + F.col("id") * 0.1).alias("a"), (-100 - F.col("id") * 0.1).alias("b"))
    fit = kmeans.fit_kmeans(kmeans.weighted_points(rows.union(few), ["a", "b"]), 4, restarts=3)
    want = [[0.25, 0.25], [10.25, 5.25], [20.25, 20.25], [100.15, -100.15]]
    assert np.abs(np.array(fit.centroids) - want).max() < 0.02


def test_candidates_are_the_same_for_any_partitioning_and_all_of_few_points(spark, points):
    names = ["a", "b", "c", "d"]
    df = spark.createDataFrame([tuple(map(float, p)) for p in points], ", ".join(f"{n} double" for n in names))
    weighted = kmeans.weighted_points(df, names)
    drawn = [kmeans.starting_candidates(p, 20, 4, 1) for p in (weighted.repartition(1), weighted.repartition(9))]
    assert (drawn[0] == drawn[1]).all() and len(np.unique(drawn[0], axis=0)) == len(drawn[0]) == 100
    every = kmeans.starting_candidates(weighted, 400, 4, 1)
    assert {tuple(p) for p in every} == {tuple(p) for p in points}


def test_bounds_hold_the_silhouette_and_the_search_needs_few_pairs(spark):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(c, s, (400, 3)) for c, s in (([0, 0, 0], 1), ([4, 0, 0], 0.5), ([0, 5, 0], 0.8), ([4, 4, 4], 1.2))])
    df = spark.createDataFrame([tuple(map(float, p)) for p in x], "a double, b double, c double")
    weighted = kmeans.weighted_points(df, ["a", "b", "c"])
    fits = kmeans.fit_kmeans_all(weighted, [2, 4, 6], restarts=3)
    bounds = sil.bounds_of_models(weighted, {k: f.centroids for k, f in fits.items()})
    for k, fit in fits.items():
        labels = sil._squares(x, np.array(fit.centroids)).argmin(axis=1)
        want = silhouette(x, labels, 1)
        low, high = bounds[k]
        assert low <= want <= high and high - low < 0.1
        rows = spark.createDataFrame([(p.tolist(), int(g)) for p, g in zip(x, labels)], "x array<double>, g int")
        found = sil.measure(rows, "x", "g")
        assert found.value == pytest.approx(want, abs=1e-6)
        if k >= 4:
            assert found.pairs < 0.55 * found.all_pairs
    assert cl.find_optimal_k(df, ["a", "b", "c"], max_k=6, restarts=3).best_k == 4


def test_silhouette_of_copies_lone_rows_and_no_clusters(spark):
    schema = "x array<double>, g int"
    value = lambda rows: sil.measure(spark.createDataFrame(rows, schema), "x", "g").value
    assert value([([1.0], 0)] * 5 + [([3.0], 1)]) == pytest.approx(5 / 6)
    assert value([([1.0], 0)] * 5 + [([1.0], 1)] * 3) == 0
    assert value([([1.0], 0), ([2.0], 0)]) is None and value([]) is None
    far = [([1e6 + i], i // 3) for i in range(9)]
    assert value(far) == pytest.approx(silhouette(np.array([f[0] for f in far]), np.array([f[1] for f in far]), 1), abs=1e-7)


def test_density_work_follows_the_neighbourhood_not_the_square(monkeypatch):
    """Points of one coarse cell that differ in other features are told apart by boxes; dense ones are counted only as far as needed."""
    rng = np.random.default_rng(5)
    a, b = (np.concatenate([rng.uniform(0, 40, (1500, 5)) * [0.01, 0.01, 0.01, 1, 1], rng.normal(0, 0.05, (500, 5))]) for _ in range(2))
    b[0, 0], weights = np.nan, rng.integers(1, 4, 2000)
    pairs = 0
    within = density._within

    def seen(x, y, eps):
        nonlocal pairs
        pairs += len(x) * len(y)
        return within(x, y, eps)

    monkeypatch.setattr(density, "_within", seen)
    got = density._counted(a, b, weights, 0.8, 10)
    want = within(a, b, 0.8) @ weights
    assert np.array_equal(np.minimum(got, 10), np.minimum(want, 10)) and (want >= 10).sum() >= 500
    assert np.array_equal(got[want < 10], want[want < 10])
    assert pairs < 0.1 * len(a) * len(b)
    joined = [(i, j) for left, right in density._leaves(a, b, 0.8) for i in left for j in right[within(a[left][left == i], b[right], 0.8)[0]]]
    i, j = np.nonzero(within(a, b, 0.8))
    assert len(joined) == len(set(joined)) and set(joined) == set(zip(i, j))
