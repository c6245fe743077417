"""Serving views over the gold / silver / ops tables.

Each view is a DataFrame function; :func:`register_views` exposes them as
temp views so SQL users and DataFrame users get the same plans.  Rankings add
a unique tie-break column so LIMIT results are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.operators.quality import dq_health


def event_type_distribution(event_type_summary: DataFrame) -> DataFrame:
    return event_type_summary.groupBy("event_type").agg(
        F.sum("event_count").alias("events"), F.sum("unique_actors").alias("actors")
    )


def trending_repos(hot_repos: DataFrame) -> DataFrame:
    # "contributors" sums hourly distinct actors: a returning actor counts again.
    return hot_repos.groupBy("repo_name").agg(
        F.sum("unique_actors").alias("contributors"),
        F.sum("event_count").alias("events"),
        F.sum("stars").alias("stars"),
        F.sum("forks").alias("forks"),
    )


def contributors_rollup(hot_repos_sketches: DataFrame) -> DataFrame:
    """Distinct contributors over all hours, next to the sum of hourly ones.

    The sum counts an actor in every hour; the hours' sketches add up to the
    distinct actors, within a relative standard error of 1.6 %.
    """
    return hot_repos_sketches.groupBy("repo_name").agg(
        F.sum("event_count").alias("events"),
        F.sum("unique_actors").alias("contributors_summed"),
        F.hll_sketch_estimate(F.hll_union_agg("actors_sketch")).alias("contributors"),
    )


def language_trends(language_daily: DataFrame) -> DataFrame:
    return (
        language_daily.filter(F.col("primary_language").isNotNull())
        .groupBy("primary_language")
        .agg(F.sum("event_count").alias("events"), F.sum("unique_repos").alias("repos"), F.sum("stars").alias("stars"))
    )


def topic_trends(topic_daily: DataFrame) -> DataFrame:
    return topic_daily.groupBy("topic").agg(F.sum("event_count").alias("events"), F.sum("unique_repos").alias("repos"))


def top_contributors(contributor_daily: DataFrame) -> DataFrame:
    """Non-bot actors with at least one PR or issue opened (NULL is_bot excluded)."""
    return (
        contributor_daily.filter(~F.col("is_bot"))
        .groupBy("actor_login")
        .agg(
            F.sum("prs_opened").alias("prs_opened"),
            F.sum("issues_opened").alias("issues_opened"),
            F.sum("repos_touched").alias("repos"),
            F.sum("total_events").alias("events"),
        )
        .filter(F.col("prs_opened") + F.col("issues_opened") > 0)
    )


def bot_vs_human(contributor_daily: DataFrame) -> DataFrame:
    """Grouped by the flag, labelled after: a NULL flag is a second 'human' row."""
    return (
        contributor_daily.groupBy("is_bot")
        .agg(F.sum("total_events").alias("events"), F.count_distinct("actor_login").alias("actors"))
        .select(
            F.when(F.col("is_bot"), F.lit("bot")).otherwise(F.lit("human")).alias("actor_kind"),
            "events",
            "actors",
        )
    )


def hourly_activity(event_type_summary: DataFrame) -> DataFrame:
    return event_type_summary.groupBy("event_hour").agg(F.sum("event_count").alias("events"))


def batch_vs_stream(silver: DataFrame) -> DataFrame:
    return silver.groupBy("source").agg(F.count(F.lit(1)).alias("events"))


def repo_versions(repos_scd2: DataFrame) -> DataFrame:
    return repos_scd2.groupBy("is_current").agg(F.count(F.lit(1)).alias("rows"))


def kpi_totals(silver: DataFrame) -> DataFrame:
    """Headline numbers: events, distinct repositories, distinct contributors."""
    return silver.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_distinct("repo_id").alias("distinct_repos"),
        F.count_distinct("actor_id").alias("distinct_contributors"),
    )


# ---- whole results in order (K6) --------------------------------------------

def layers_in_order(health: DataFrame) -> DataFrame:
    return health.orderBy("layer")


def event_types_in_order(distribution: DataFrame) -> DataFrame:
    """Most frequent type first, equal counts by name."""
    return distribution.orderBy(F.desc("events"), "event_type")


def hours_in_order(activity: DataFrame) -> DataFrame:
    return activity.orderBy("event_hour")


# ---- ranked tiles (K2-K5) ---------------------------------------------------

def top_trending(trending: DataFrame, n: int = 20) -> DataFrame:
    return trending.orderBy(F.desc("contributors"), F.desc("events"), F.asc("repo_name")).limit(n)


def top_languages(languages: DataFrame, n: int = 15) -> DataFrame:
    return languages.orderBy(F.desc("events"), F.asc("primary_language")).limit(n)


def top_topics(topics: DataFrame, n: int = 20) -> DataFrame:
    return topics.orderBy(F.desc("events"), F.asc("topic")).limit(n)


def top_contributor_ranking(contributors: DataFrame, n: int = 20) -> DataFrame:
    return contributors.orderBy(
        F.desc("prs_opened"), F.desc("issues_opened"), F.desc("repos"), F.asc("actor_login")
    ).limit(n)


VIEW_BUILDERS = {
    "vw_dq_health": ("dq_results", dq_health),
    "vw_event_type_distribution": ("event_type_summary_hourly", event_type_distribution),
    "vw_trending_repos": ("hot_repos_hourly", trending_repos),
    "vw_language_trends": ("language_trends_daily", language_trends),
    "vw_topic_trends": ("topic_trends_daily", topic_trends),
    "vw_top_contributors": ("contributor_activity_daily", top_contributors),
    "vw_bot_vs_human": ("contributor_activity_daily", bot_vs_human),
    "vw_hourly_activity": ("event_type_summary_hourly", hourly_activity),
    "vw_batch_vs_stream": ("silver_events", batch_vs_stream),
    "vw_repo_versions": ("repos_scd2", repo_versions),
}


def build_views(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every view whose source table is present in ``tables``."""
    return {name: fn(tables[src]) for name, (src, fn) in VIEW_BUILDERS.items() if src in tables}


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> list[str]:
    """Create-or-replace one temp view per serving view (re-runnable)."""
    views = build_views(tables)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)
