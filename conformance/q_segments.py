"""Customer segments and clustering.

Reports on segments use clusters given by fixed centroids, so that both engines
see the same cluster numbers. Evaluations use the labels that come with the
embeddings. Fitted models are not reproducible in SQL and are checked for their
properties in the tests.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from conformance.ctes import CENTROIDS, _Z
from conformance.fixtures import REFERENCE_DATE, read
from conformance.q_reports import rounded
from conformance.q_sources import folder
from conformance.registry import query
from conformance.star import star
from tradewind.functions.text import money_text
from tradewind.operators import clustering as cl
from tradewind.operators import dbscan as density
from tradewind.operators import rfm, segments
from tradewind.operators import silhouette as sil
from tradewind.operators.kmeans import KMeansFit, fit_kmeans, weighted_points
from tradewind.plans import segmentation
from tradewind.session import materialize
from tradewind.sources import models
from tradewind.sources.schemas import FEATURE_COLUMNS, SEGMENT_COLUMNS

_ZCOLS = [cl.z_name(c) for c in FEATURE_COLUMNS]
_kept: dict = {}


def _once(spark, sf_dir, name, make):
    """A table that several queries of a session read."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _kept:
        _kept[key] = materialize(make(), name)
    return _kept[key]


def features(spark, sf_dir):
    def make():
        s = star(spark, sf_dir)
        return rfm.rfm_features(
            rfm.rfm_extract(
                s["dim_customer"], s["fact_order_items"], s["dim_order_status"], s["fact_payments"], s["fact_reviews"], REFERENCE_DATE
            )
        )

    return _once(spark, sf_dir, "features", make)


def scaled(spark, sf_dir):
    return _once(spark, sf_dir, "scaled", lambda: cl.standardize(features(spark, sf_dir), FEATURE_COLUMNS))


def given_segments(spark, sf_dir):
    """Features with the cluster of the nearest fixed centroid."""
    return _once(
        spark, sf_dir, "segments",
        lambda: cl.kmeans_assign(scaled(spark, sf_dir), F.array(*_ZCOLS), CENTROIDS).drop(*_ZCOLS),
    )


def vectors(spark, sf_dir):
    return read(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))


# Profiles and reports


@query("segment_kpis", """SELECT count(*) AS total_customers, count(DISTINCT kmeans_cluster) AS n_segments, CAST(sum(CAST(monetary_value AS DECIMAL(30,2))) AS DOUBLE) AS total_revenue,
    round(avg(avg_order_value), 6) AS avg_order_value FROM segments""")
def segment_kpis(spark, sf_dir):
    return rounded(segments.segment_kpis(given_segments(spark, sf_dir)), "avg_order_value")


_MONEY = "CAST(monetary_value AS DECIMAL(30,2))"


@query("segment_profile", f"""SELECT kmeans_cluster, count(*) AS "Count", round(avg(recency_days), 2) AS "Avg_Recency", round(avg(frequency_orders), 2) AS "Avg_Frequency",
    round(CAST(sum({_MONEY}) AS DOUBLE) / count(*), 2) AS "Avg_Monetary", CAST(sum({_MONEY}) AS DOUBLE) AS "Total_Revenue", round(avg(avg_order_value), 2) AS "Avg_Order_Value",
    round(avg(avg_review_score), 2) AS "Avg_Review", round(avg(customer_lifetime_days), 2) AS "Avg_Lifetime", round(avg(purchase_frequency_rate), 2) AS "Purchase_Rate"
    FROM segments GROUP BY 1""")
def segment_profile(spark, sf_dir):
    return segments.segment_profile(given_segments(spark, sf_dir))


@query("segment_profile_medians", f"""SELECT kmeans_cluster, count(*) AS "Total_Customers", round(avg(recency_days), 2) AS recency_days_mean, round(median(recency_days), 2) AS recency_days_median,
    round(avg(frequency_orders), 2) AS frequency_orders_mean, round(median(frequency_orders), 2) AS frequency_orders_median,
    round(CAST(sum({_MONEY}) AS DOUBLE) / count(*), 2) AS monetary_value_mean, round(median(monetary_value), 2) AS monetary_value_median, CAST(sum({_MONEY}) AS DOUBLE) AS monetary_value_sum,
    round(avg(avg_order_value), 2) AS avg_order_value_mean, round(avg(avg_review_score), 2) AS avg_review_score_mean, round(avg(customer_lifetime_days), 2) AS customer_lifetime_days_mean
    FROM segments GROUP BY 1""")
def segment_profile_medians(spark, sf_dir):
    return segments.segment_profile_medians(given_segments(spark, sf_dir))


_SUMMARY = f"""SELECT kmeans_cluster, count(*) AS customer_sk_count, round(avg(recency_days), 2) AS recency_days_mean, round(avg(frequency_orders), 2) AS frequency_orders_mean,
    round(CAST(sum({_MONEY}) AS DOUBLE) / count(*), 2) AS monetary_value_mean, CAST(sum({_MONEY}) AS DOUBLE) AS monetary_value_sum, round(avg(avg_review_score), 2) AS avg_review_score_mean
    FROM segments GROUP BY 1"""


@query("segment_summary", _SUMMARY)
def segment_summary(spark, sf_dir):
    return segments.segment_summary(given_segments(spark, sf_dir))


@query("segment_geography", "SELECT customer_state, kmeans_cluster, count(*) AS count FROM segments GROUP BY 1, 2")
def segment_geography(spark, sf_dir):
    return segments.segment_geography(given_segments(spark, sf_dir))


@query("segment_value_mix", "SELECT kmeans_cluster, customer_value, count(*) AS count FROM segments GROUP BY 1, 2 UNION ALL SELECT NULL, customer_value, count(*) FROM segments GROUP BY 2")
def segment_value_mix(spark, sf_dir):
    rows = given_segments(spark, sf_dir)
    overall = segments.segment_value_mix(rows).select(F.lit(None).cast("int").alias("kmeans_cluster"), "customer_value", "count")
    return segments.segment_value_mix(rows, per_cluster=True).unionByName(overall)


@query("minmax_profile", """SELECT kmeans_cluster, round((r - min(r) OVER ()) / (max(r) OVER () - min(r) OVER ()), 6) AS recency_days,
    round((f - min(f) OVER ()) / (max(f) OVER () - min(f) OVER ()), 6) AS frequency_orders, round((m - min(m) OVER ()) / (max(m) OVER () - min(m) OVER ()), 6) AS monetary_value
    FROM (SELECT kmeans_cluster, avg_recency AS r, avg_frequency AS f, avg_monetary AS m FROM segment_means)""")
def minmax_profile(spark, sf_dir):
    return rounded(segments.minmax_profile(given_segments(spark, sf_dir)), "recency_days", "frequency_orders", "monetary_value")


@query("radar_profile", """SELECT kmeans_cluster, round(1 / (avg_recency / 100 + 1), 9) AS recency, avg_frequency AS frequency, avg_monetary / 100 AS monetary,
    round(avg_review, 9) AS review_score, CAST(customers AS DOUBLE) / 1000 AS size FROM segment_means""")
def radar_profile(spark, sf_dir):
    return rounded(segments.radar_profile(given_segments(spark, sf_dir)), "recency", "review_score", digits=9)


@query("segment_revenue", f"SELECT kmeans_cluster, CAST(sum({_MONEY}) AS DOUBLE) AS revenue FROM segments GROUP BY 1")
def segment_revenue(spark, sf_dir):
    return segments.segment_revenue(given_segments(spark, sf_dir))


@query("top_states_per_segment", """SELECT customer_state, kmeans_cluster, count(*) AS count, CAST(row_number() OVER (PARTITION BY kmeans_cluster ORDER BY count(*) DESC, customer_state) AS INTEGER) AS place
    FROM segments GROUP BY 1, 2 QUALIFY place <= 10""")
def top_states_per_segment(spark, sf_dir):
    return segments.top_states(given_segments(spark, sf_dir))


@query("first_in_group", "SELECT kmeans_cluster, arg_min(customer_value, customer_sk) AS customer_value FROM segments GROUP BY 1")
def first_in_group(spark, sf_dir):
    return segments.first_in_group(given_segments(spark, sf_dir), "customer_value", "customer_sk")


_LABEL = """CASE WHEN avg_recency < 60 AND avg_frequency > 3 AND avg_monetary > 500 THEN '🌟 Champions (VIP)'
    WHEN avg_frequency > 2 AND avg_monetary > 300 THEN '💎 Loyal Customers' WHEN avg_recency < 90 AND avg_frequency <= 2 THEN '🌱 Potential Loyalists'
    WHEN avg_recency > 180 THEN '😴 Lost Customers' WHEN avg_recency > 90 THEN '⚠️  At Risk' ELSE '📊 Standard Customers' END"""


@query("segment_labels", f"SELECT s.customer_sk, s.kmeans_cluster, {_LABEL} AS segment_label FROM segments s JOIN segment_means USING (kmeans_cluster)")
def segment_labels(spark, sf_dir):
    return segments.segment_labels(given_segments(spark, sf_dir)).select("customer_sk", "kmeans_cluster", "segment_label")


@query("segment_actions", """SELECT kmeans_cluster, customers,
    CASE WHEN avg_recency < 60 AND avg_frequency > 3 AND avg_monetary > 500 THEN 'VIP treatment and exclusive offers; Personal account manager; Early access to new products'
         WHEN avg_frequency > 2 AND avg_monetary > 300 THEN 'Loyalty rewards program; Referral bonuses; Birthday discounts'
         WHEN avg_recency < 90 AND avg_frequency <= 2 THEN 'Engagement campaigns; Product recommendations; Educational content'
         WHEN avg_recency > 180 THEN 'Win-back campaigns; Survey for feedback; Special reactivation offers' ELSE 'Standard marketing; Cross-sell opportunities' END AS actions,
    concat_ws('; ', CASE WHEN avg_recency < 60 THEN 'Recent activity - Focus on retention' END, CASE WHEN avg_frequency > 3 THEN 'High frequency - Offer loyalty rewards' END,
              CASE WHEN avg_monetary > 500 THEN 'High value - Provide VIP service' END, CASE WHEN avg_recency > 180 THEN 'Inactive - Launch win-back campaign' END) AS advice
    FROM segment_means""")
def segment_actions(spark, sf_dir):
    return segments.segment_actions(given_segments(spark, sf_dir))


@query("segment_report", """SELECT m.* REPLACE (round(m.avg_review, 9) AS avg_review), CAST(customers AS DOUBLE) / (SELECT count(*) FROM segments) * 100 AS share_pct,
    (SELECT customer_state FROM segments s WHERE s.kmeans_cluster = m.kmeans_cluster GROUP BY 1 ORDER BY count(*) DESC, customer_state LIMIT 1) AS top_state
    FROM segment_means m""")
def segment_report(spark, sf_dir):
    return rounded(segments.segment_report(given_segments(spark, sf_dir)), "avg_review", digits=9)


@query("cluster_distribution", "SELECT kmeans_cluster, count(*) AS n, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM segments) * 100 AS percentage FROM segments GROUP BY 1")
def cluster_distribution(spark, sf_dir):
    return segments.cluster_distribution(given_segments(spark, sf_dir))


_EXPORTED = ["customer_sk", "customer_unique_id", "customer_state", "customer_region", "recency_days", "frequency_orders",
             "avg_order_value", "avg_review_score", "customer_lifetime_days", "rfm_score", "customer_value", "kmeans_cluster"]
_EXPORT_SQL = f"SELECT {', '.join('s.' + c for c in _EXPORTED)}, s.monetary_value, {_LABEL} AS segment_label FROM segments s JOIN segment_means USING (kmeans_cluster)"


def _exported(spark, sf_dir):
    """All seventeen export columns; the density cluster and projection stand-ins are left out of the comparison."""
    rows = segments.segment_labels(given_segments(spark, sf_dir)).withColumns(
        {"dbscan_cluster": F.col("kmeans_cluster"), "pca_1": F.lit(0.0), "pca_2": F.lit(0.0)}
    )
    path = folder(spark, "customer_segments")
    segmentation.export_segments(rows, path)
    saved = segmentation.segments_scan(spark, path)
    assert saved.columns == SEGMENT_COLUMNS
    return saved.select(*_EXPORTED, "monetary_value", "segment_label")


@query("segments_export", _EXPORT_SQL)
def segments_export(spark, sf_dir):
    return _exported(spark, sf_dir)


@query("segments_scan", f"SELECT kmeans_cluster, count(*) AS n, CAST(sum({_MONEY}) AS DOUBLE) AS revenue FROM segments GROUP BY 1")
def segments_scan(spark, sf_dir):
    return _exported(spark, sf_dir).groupBy("kmeans_cluster").agg(F.count(F.lit(1)).alias("n"), F.sum("monetary_value").alias("revenue"))


@query("summary_export", _SUMMARY)
def summary_export(spark, sf_dir):
    rows = segments.segment_labels(given_segments(spark, sf_dir))
    summary, labels = folder(spark, "summary"), folder(spark, "labels")
    segmentation.export_summary(rows, summary, labels)
    saved = spark.read.option("header", True).csv(summary)
    types = {"kmeans_cluster": "int", "customer_sk_count": "bigint"}
    return saved.select(*[F.col(c).cast(types.get(c, "double")).alias(c) for c in saved.columns])


@query("segment_display", f"SELECT customer_sk, 'R$ ' || format('{{:,.2f}}', monetary_value) AS shown FROM segments")
def segment_display(spark, sf_dir):
    return given_segments(spark, sf_dir).select("customer_sk", money_text("monetary_value").alias("shown"))


# Features and assignment


@query("feature_matrix", f"SELECT customer_sk, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in FEATURE_COLUMNS)} FROM rfm_features")
def feature_matrix(spark, sf_dir):
    return cl.feature_matrix(features(spark, sf_dir), "customer_sk")


@query("standardize", f"SELECT customer_sk, {', '.join(f'round({z}, 6) AS {z}' for z in _Z)} FROM rfm_scaled")
def standardize(spark, sf_dir):
    return rounded(scaled(spark, sf_dir).select("customer_sk", *_ZCOLS), *_ZCOLS)


@query("kmeans_assign", "SELECT customer_sk, kmeans_cluster FROM segments")
def kmeans_assign(spark, sf_dir):
    rows = scaled(spark, sf_dir).select("customer_sk", F.array(*_ZCOLS).alias("x"))
    return cl.kmeans_assign(rows, F.col("x"), CENTROIDS).drop("x")


@query("covariance_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(covar_pop({a}, {b}), 6) + 0 AS covariance FROM rfm_scaled"
    for i, a in enumerate(_Z) for b in _Z[i:]))
def covariance_matrix(spark, sf_dir):
    matrix = rounded(cl.covariance_matrix(scaled(spark, sf_dir), _ZCOLS), "covariance")
    return matrix.withColumn("covariance", F.col("covariance") + F.lit(0.0))


# Evaluation


@query("inertia", "SELECT round(sum(d2), 6) AS inertia FROM vector_spread")
def inertia(spark, sf_dir):
    return rounded(cl.inertia(vectors(spark, sf_dir), "x", "label"), "inertia")


@query("davies_bouldin", """SELECT round(avg(worst), 6) AS davies_bouldin FROM (
    SELECT a.label, max((a.s + b.s) / list_distance(a.c, b.c)) AS worst FROM vector_spread a JOIN vector_spread b ON a.label <> b.label GROUP BY a.label)""")
def davies_bouldin(spark, sf_dir):
    return rounded(cl.davies_bouldin(vectors(spark, sf_dir), "x", "label"), "davies_bouldin")


def _silhouette_sql(distance: str) -> str:
    return f"""SELECT round(avg(CASE WHEN n > 1 THEN (b - a) / greatest(a, b) ELSE 0 END), 6) AS silhouette_squared FROM (
        SELECT vec_id, max(n) FILTER (own) AS n, max(total / (n - 1)) FILTER (own AND n > 1) AS a, min(total / n) FILTER (NOT own) AS b
        FROM (SELECT v.vec_id, w.label, v.label = w.label AS own, count(*) AS n, sum({distance}) AS total
              FROM vectors v, vectors w GROUP BY ALL) GROUP BY vec_id)"""


@query("silhouette", _silhouette_sql("list_distance(v.x, w.x)").replace("silhouette_squared", "silhouette"))
def silhouette(spark, sf_dir):
    return rounded(sil.silhouette(vectors(spark, sf_dir), "x", "label"), "silhouette")


@query("silhouette_squared", _silhouette_sql("list_distance(v.x, w.x) * list_distance(v.x, w.x)"))
def silhouette_squared(spark, sf_dir):
    return rounded(cl.silhouette_squared(vectors(spark, sf_dir), "x", "label"), "silhouette_squared")


@query("noise_report", f"""SELECT count(DISTINCT CASE WHEN label <> 0 THEN label END) AS n_clusters, count(*) FILTER (label = 0) AS n_noise,
    CAST(count(*) FILTER (label = 0) AS DOUBLE) / count(*) * 100 AS noise_pct,
    (SELECT silhouette_squared FROM ({_silhouette_sql('list_distance(v.x, w.x) * list_distance(v.x, w.x)').replace('FROM vectors v, vectors w', 'FROM (SELECT * FROM vectors WHERE label <> 0) v, (SELECT * FROM vectors WHERE label <> 0) w')})) AS silhouette_squared
    FROM vectors""")
def noise_report(spark, sf_dir):
    """The first label plays the part of noise."""
    rows = vectors(spark, sf_dir).withColumn("label", F.when(F.col("label") == 0, -1).otherwise(F.col("label")))
    return rounded(cl.noise_report(rows, "x", "label"), "silhouette_squared")


@query("dbscan_core", """SELECT s.customer_sk, c.customer_sk IS NOT NULL AS is_core,
    c.customer_sk IS NULL AND s.customer_sk NOT IN (SELECT p.a FROM dense_pairs p JOIN dense_core k ON p.b = k.customer_sk) AS is_noise
    FROM rfm_scaled s LEFT JOIN dense_core c USING (customer_sk)""")
def dbscan_core(spark, sf_dir):
    found = density.dbscan(scaled(spark, sf_dir), "customer_sk", _ZCOLS, density.RUN_EPS, density.RUN_MIN_SAMPLES)
    return found.select("customer_sk", "is_core", (F.col("dbscan_cluster") == density.NOISE).alias("is_noise"))


# Fitted models


@query("dbscan", """SELECT s.customer_sk, c.cluster IS NOT NULL AS is_core, CAST(coalesce(c.cluster, b.cluster, -1) AS INTEGER) AS dbscan_cluster
    FROM rfm_scaled s LEFT JOIN dense_clusters c USING (customer_sk)
    LEFT JOIN (SELECT p.a AS customer_sk, min(k.cluster) AS cluster FROM dense_pairs p JOIN dense_clusters k ON p.b = k.customer_sk GROUP BY p.a) b USING (customer_sk)""")
def dbscan(spark, sf_dir):
    return density.dbscan(scaled(spark, sf_dir), "customer_sk", _ZCOLS, density.RUN_EPS, density.RUN_MIN_SAMPLES)


@query("kmeans_fit")
def kmeans_fit(spark, sf_dir):
    data = scaled(spark, sf_dir)
    fit = fit_kmeans(weighted_points(data, _ZCOLS), 4)
    rows = data.select("customer_sk", F.array(*_ZCOLS).alias("x"))
    return cl.kmeans_assign(rows, F.col("x"), fit.centroids).drop("x")


@query("find_optimal_k")
def find_optimal_k(spark, sf_dir):
    return cl.find_optimal_k(scaled(spark, sf_dir).select(*_ZCOLS), _ZCOLS, max_k=8).scores


_PLACED = "round(pca_1, 6) + 0 AS pca_1, round(pca_2, 6) + 0 AS pca_2"


def _placed(rows, *columns):
    out = rounded(rows.select(*columns, "pca_1", "pca_2"), "pca_1", "pca_2")
    return out.withColumns({c: F.col(c) + F.lit(0.0) for c in ("pca_1", "pca_2")})


@query("pca_project", f"SELECT customer_sk, {_PLACED} FROM projected")
def pca_project(spark, sf_dir):
    rows = scaled(spark, sf_dir).select("customer_sk", *_ZCOLS)
    return _placed(cl.project(rows, _ZCOLS, cl.fit_pca(rows, _ZCOLS)), "customer_sk")


@query("explained_variance", """SELECT CAST(i AS INTEGER) AS component, round(e / t, 6) AS share FROM (
    SELECT unnest([1, 2]) AS i, unnest([a.eigenvalue, b.eigenvalue]) AS e, list_sum(list_transform(a.m, lambda r, i: r[i])) AS t FROM component_1 a, component_2 b)""")
def explained_variance(spark, sf_dir):
    shares = cl.fit_pca(scaled(spark, sf_dir).select(*_ZCOLS), _ZCOLS).explained
    return rounded(spark.createDataFrame(list(enumerate(shares, 1)), "component int, share double"), "share")


def _given_model(spark, sf_dir):
    """A bundle with the fixed centroids and the components of the data, as it comes back from the folder it was saved in."""
    data = scaled(spark, sf_dir)
    stats, projection = cl.scaling(cl.feature_matrix(features(spark, sf_dir), "customer_sk"), FEATURE_COLUMNS), cl.fit_pca(data.select(*_ZCOLS), _ZCOLS)
    scores = {"silhouette_squared": 0.0, "davies_bouldin": 0.0}
    path = folder(spark, "model")
    models.model_save(models.bundle(spark, FEATURE_COLUMNS, stats, KMeansFit(CENTROIDS, 0.0), projection, scores, data.count()), path)
    return models.model_load(spark, path)


@query("given_model_rows", f"SELECT customer_sk, kmeans_cluster, {_PLACED} FROM segments JOIN projected USING (customer_sk)")
def given_model_rows(spark, sf_dir):
    """Raw features through a stored pipeline: scaling, nearest centroid and projection."""
    rows = features(spark, sf_dir).select("customer_sk", *FEATURE_COLUMNS)
    return _placed(models.predict_segment(_given_model(spark, sf_dir), rows), "customer_sk", "kmeans_cluster")


@query("given_model_centroids", " UNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS kmeans_cluster, round(list_dot_product({list(map(float, c))}, a.v), 6) + 0 AS pca_1, round(list_dot_product({list(map(float, c))}, b.v), 6) + 0 AS pca_2 FROM component_1 a, component_2 b"
    for i, c in enumerate(CENTROIDS)))
def given_model_centroids(spark, sf_dir):
    return _placed(segmentation.project_centroids(_given_model(spark, sf_dir)), "kmeans_cluster")


def _run(spark, sf_dir):
    key = (spark.sparkContext.applicationId, sf_dir, "run")
    if key not in _kept:
        _kept[key] = segmentation.run_segmentation(features(spark, sf_dir), k=4)
    return _kept[key]


@query("segmentation_run")
def segmentation_run(spark, sf_dir):
    return segmentation.run_segmentation(features(spark, sf_dir)).segments.select(*SEGMENT_COLUMNS)


@query("model_save")
def model_save(spark, sf_dir):
    path = folder(spark, "model")
    models.model_save(_run(spark, sf_dir).model, path)
    return models.model_load(spark, path).metadata


@query("model_load", "SELECT CAST(4 AS BIGINT) AS n_clusters, count(*) AS n_samples FROM rfm_features")
def model_load(spark, sf_dir):
    path = folder(spark, "model")
    models.model_save(_run(spark, sf_dir).model, path)
    return models.model_load(spark, path).metadata.select("n_clusters", "n_samples")


@query("predict_segment")
def predict_segment(spark, sf_dir):
    """New rows scored by the loaded model get the cluster the fitted one gave them."""
    path = folder(spark, "model")
    models.model_save(_run(spark, sf_dir).model, path)
    rows = features(spark, sf_dir).select("customer_sk", *FEATURE_COLUMNS)
    return models.predict_segment(models.model_load(spark, path), rows).select("customer_sk", "kmeans_cluster", "pca_1", "pca_2")


@query("project_centroids")
def project_centroids(spark, sf_dir):
    return segmentation.project_centroids(_run(spark, sf_dir).model)
