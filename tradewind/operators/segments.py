"""Profiles, labels and recommended actions of customer segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.operators.ranking import exact_quantiles
from tradewind.operators.stats import mode_value, value_counts

CLUSTER = "kmeans_cluster"

# Segment labels in rule order.
LABELS = {
    "champions": "🌟 Champions (VIP)",
    "loyal": "💎 Loyal Customers",
    "potential": "🌱 Potential Loyalists",
    "new": "🆕 New Customers",
    "lost": "😴 Lost Customers",
    "at_risk": "⚠️  At Risk",
    "standard": "📊 Standard Customers",
}

# Recommended actions per kind of segment.
ACTIONS = {
    "champions": ["VIP treatment and exclusive offers", "Personal account manager", "Early access to new products"],
    "loyal": ["Loyalty rewards program", "Referral bonuses", "Birthday discounts"],
    "potential": ["Engagement campaigns", "Product recommendations", "Educational content"],
    "lost": ["Win-back campaigns", "Survey for feedback", "Special reactivation offers"],
    "standard": ["Standard marketing", "Cross-sell opportunities"],
}

# Independent advice, each with its own condition.
ADVICE = {
    "recent": "Recent activity - Focus on retention",
    "frequent": "High frequency - Offer loyalty rewards",
    "valuable": "High value - Provide VIP service",
    "inactive": "Inactive - Launch win-back campaign",
}

_MEASURES = ["recency_days", "frequency_orders", "monetary_value"]


def _mean(column: str) -> Column:
    return F.sum(F.col(column)).cast("double") / F.count(column)


def cluster_means(df: DataFrame, by: str = CLUSTER) -> DataFrame:
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("customers"),
        _mean("recency_days").alias("avg_recency"),
        _mean("frequency_orders").alias("avg_frequency"),
        _mean("monetary_value").alias("avg_monetary"),
        F.sum("monetary_value").alias("total_revenue"),
        _mean("avg_review_score").alias("avg_review"),
    )


def segment_rules() -> dict[str, Column]:
    """Conditions on cluster means, in the order in which they are tried.

    ``new`` can never match: everything it holds is already ``potential``.
    """
    recency, frequency, monetary = F.col("avg_recency"), F.col("avg_frequency"), F.col("avg_monetary")
    return {
        "champions": (recency < 60) & (frequency > 3) & (monetary > 500),
        "loyal": (frequency > 2) & (monetary > 300),
        "potential": (recency < 90) & (frequency <= 2),
        "new": (recency < 60) & (frequency == 1),
        "lost": recency > 180,
        "at_risk": recency > 90,
    }


def _chain(values: dict[str, Column], otherwise: Column) -> Column:
    rules = segment_rules()
    names = [n for n in rules if n in values]
    chain = F.when(rules[names[0]], values[names[0]])
    for name in names[1:]:
        chain = chain.when(rules[name], values[name])
    return chain.otherwise(otherwise)


def cluster_labels(df: DataFrame) -> DataFrame:
    """One row per cluster with its label."""
    labels = {name: F.lit(text) for name, text in LABELS.items()}
    return cluster_means(df).withColumn("segment_label", _chain(labels, labels["standard"]))


def segment_labels(df: DataFrame) -> DataFrame:
    """Every customer with the label of its cluster; there are as many labels as clusters."""
    labels = cluster_labels(df).select(CLUSTER, "segment_label")
    return df.join(labels, CLUSTER, "left")


def segment_actions(df: DataFrame) -> DataFrame:
    """Recommended actions per cluster, and the independent advice that applies."""
    actions = {name: F.lit("; ".join(texts)) for name, texts in ACTIONS.items()}
    means = cluster_means(df)
    advice = [
        F.when(F.col("avg_recency") < 60, F.lit(ADVICE["recent"])),
        F.when(F.col("avg_frequency") > 3, F.lit(ADVICE["frequent"])),
        F.when(F.col("avg_monetary") > 500, F.lit(ADVICE["valuable"])),
        F.when(F.col("avg_recency") > 180, F.lit(ADVICE["inactive"])),
    ]
    return means.select(
        CLUSTER,
        "customers",
        _chain(actions, actions["standard"]).alias("actions"),
        F.array_join(F.array_compact(F.array(*advice)), "; ").alias("advice"),
    )


def segment_profile(df: DataFrame) -> DataFrame:
    """Count, means and total revenue per cluster, two decimals."""
    rounded = lambda c: F.round(_mean(c), 2)
    return df.groupBy(CLUSTER).agg(
        F.count("customer_sk").alias("Count"),
        rounded("recency_days").alias("Avg_Recency"),
        rounded("frequency_orders").alias("Avg_Frequency"),
        rounded("monetary_value").alias("Avg_Monetary"),
        F.round(F.sum("monetary_value"), 2).alias("Total_Revenue"),
        rounded("avg_order_value").alias("Avg_Order_Value"),
        rounded("avg_review_score").alias("Avg_Review"),
        rounded("customer_lifetime_days").alias("Avg_Lifetime"),
        rounded("purchase_frequency_rate").alias("Purchase_Rate"),
    )


def segment_profile_medians(df: DataFrame) -> DataFrame:
    """Means beside exact medians per cluster, two decimals."""
    medians = None
    for column in _MEASURES:
        found = exact_quantiles(df, column, [0.5], by=[CLUSTER]).select(
            CLUSTER, F.round("value", 2).alias(f"{column}_median")
        )
        medians = found if medians is None else medians.join(found, CLUSTER)
    rounded = lambda c: F.round(_mean(c), 2).alias(f"{c}_mean")
    means = df.groupBy(CLUSTER).agg(
        F.count("customer_sk").alias("Total_Customers"),
        *[rounded(c) for c in [*_MEASURES, "avg_order_value", "avg_review_score", "customer_lifetime_days"]],
        F.round(F.sum("monetary_value"), 2).alias("monetary_value_sum"),
    )
    return means.join(medians, CLUSTER)


def segment_summary(df: DataFrame) -> DataFrame:
    """The exported summary: count, means and revenue per cluster, two decimals."""
    rounded = lambda c: F.round(_mean(c), 2).alias(f"{c}_mean")
    return df.groupBy(CLUSTER).agg(
        F.count("customer_sk").alias("customer_sk_count"),
        *[rounded(c) for c in _MEASURES],
        F.round(F.sum("monetary_value"), 2).alias("monetary_value_sum"),
        rounded("avg_review_score"),
    )


def segment_kpis(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.countDistinct(CLUSTER).alias("n_segments"),
        F.sum("monetary_value").alias("total_revenue"),
        _mean("avg_order_value").alias("avg_order_value"),
    )


def cluster_distribution(df: DataFrame, by: str = CLUSTER) -> DataFrame:
    return value_counts(df, by)


def segment_geography(df: DataFrame) -> DataFrame:
    return df.groupBy("customer_state", CLUSTER).agg(F.count(F.lit(1)).alias("count"))


def segment_value_mix(df: DataFrame, per_cluster: bool = False) -> DataFrame:
    keys = [CLUSTER, "customer_value"] if per_cluster else ["customer_value"]
    return df.dropna(subset=["customer_value"]).groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def segment_revenue(df: DataFrame) -> DataFrame:
    return df.groupBy(CLUSTER).agg(F.sum("monetary_value").alias("revenue")).orderBy(F.desc("revenue"))


def segment_filter(df: DataFrame, cluster: int) -> DataFrame:
    return df.where(F.col(CLUSTER) == cluster)


def top_states(df: DataFrame, k: int = 10) -> DataFrame:
    """The k largest states of each cluster. The window runs over (cluster, state) counts only."""
    counted = segment_geography(df)
    place = F.row_number().over(Window.partitionBy(CLUSTER).orderBy(F.desc("count"), F.asc("customer_state")))
    return counted.withColumn("place", place).where(F.col("place") <= k)


def minmax_profile(df: DataFrame) -> DataFrame:
    """Cluster means scaled to 0..1 over the clusters, per metric."""
    means = df.groupBy(CLUSTER).agg(*[_mean(c).alias(c) for c in _MEASURES])
    bounds = means.agg(
        F.array(*[F.min(c) for c in _MEASURES]).alias("low"), F.array(*[F.max(c) for c in _MEASURES]).alias("high")
    )
    low, high = bounds.select("low").scalar(), bounds.select("high").scalar()
    scaled = []
    for i, c in enumerate(_MEASURES):
        width = high[i] - low[i]
        scaled.append(((F.col(c) - low[i]) / F.when(width == 0, F.lit(1.0)).otherwise(width)).alias(c))
    return means.select(CLUSTER, *scaled)


def radar_profile(df: DataFrame) -> DataFrame:
    means = cluster_means(df)
    return means.select(
        CLUSTER,
        (1 / (F.col("avg_recency") / 100 + 1)).alias("recency"),
        F.col("avg_frequency").alias("frequency"),
        (F.col("avg_monetary") / 100).alias("monetary"),
        F.col("avg_review").alias("review_score"),
        (F.col("customers") / 1000).alias("size"),
    )


def first_in_group(df: DataFrame, value: str, key: str, by: str = CLUSTER) -> DataFrame:
    return df.groupBy(by).agg(F.min_by(value, key).alias(value))


def segment_report(df: DataFrame) -> DataFrame:
    """Size, share, means, revenue and most frequent state per cluster."""
    total = df.agg(F.count(F.lit(1))).scalar()
    states = mode_value(df, "customer_state", by=[CLUSTER]).select(CLUSTER, F.col("mode").alias("top_state"))
    return cluster_means(df).join(states, CLUSTER, "left").withColumn("share_pct", F.col("customers") / total * 100)
