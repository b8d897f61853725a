"""What clusters look like and who is in them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.config import Scorecard
from scoreloom.functions.expressions import archetype, col, mean_of_rounded, named, round_half_even
from scoreloom.operators.rank import with_group_position, with_position
from scoreloom.plans.staging import stage

PAGE_ROWS = 1000


def number_clusters(df: DataFrame, cluster: str, score: str, name: str = "cluster_id") -> DataFrame:
    """Number the clusters from 0 by ascending mean score; rows without a cluster get null.

    Ties go by label. The numbers are a table with a row per cluster, staged, so
    any number of clusters may be numbered: Spark joins by their real size.
    """
    means = (
        df.where(F.col(cluster).isNotNull())
        .groupBy(cluster)
        .agg(F.expr(named(mean_of_rounded(col(score)), "mean")))
    )
    placed = with_position(means, [F.asc_nulls_first("mean"), F.asc(cluster)], "__place")
    numbers = stage(placed.select(F.col(cluster).alias("__of"), (F.col("__place") - 1).cast("int").alias("__number")), "numbers")
    kept = df.drop(name)
    return kept.join(numbers, kept[cluster] == numbers["__of"], "left").select(*kept.columns, F.col("__number").alias(name))


def cluster_profiles(df: DataFrame, card: Scorecard, cluster: str, score: str) -> DataFrame:
    """Per cluster: size, mean scores and the archetype these match.

    The archetype rules look at the rounded means.
    """
    means = {**{p.score: f"avg_{p.slug}" for p in card.pillars}, score: f"avg_{card.name}"}
    measures = {slug: col(f"avg_{slug}") for slug in (*(p.slug for p in card.pillars), card.name)}
    return (
        df.where(F.col(cluster).isNotNull())
        .groupBy(cluster)
        .agg(
            F.count(card.label).alias(f"n_{card.plural}"),
            *(F.expr(named(round_half_even(mean_of_rounded(col(s))), n)) for s, n in means.items()),
        )
        .selectExpr("*", named(archetype(measures, card.archetypes, card.default_archetype), "archetype"))
    )


def member_pages(df: DataFrame, card: Scorecard, cluster: str, page_rows: int = PAGE_ROWS) -> DataFrame:
    """Member names in alphabetical order, joined by commas, in pages.

    A cluster may hold most of the table, which no single cell could list, so
    its names come in pages of ``page_rows``, numbered from 0. A cluster that
    fits one page has the whole list in it.
    """
    named = df.where(F.col(cluster).isNotNull() & F.col(card.label).isNotNull()).select(
        cluster, card.label, card.key
    )
    placed = with_group_position(named, cluster, [F.asc(card.label), F.asc(card.key)])
    page = F.floor((F.col("position") - 1) / F.lit(page_rows)).cast("int")
    names = F.sort_array(F.collect_list(F.struct("position", card.label)))
    return placed.groupBy(cluster, page.alias("page")).agg(
        F.concat_ws(", ", F.transform(names, lambda m: m[card.label])).alias(card.plural)
    )


def profile_pages(profiles: DataFrame, pages: DataFrame, cluster: str) -> DataFrame:
    """Profiles next to their member pages: one row per cluster and page."""
    return pages.join(stage(profiles, "profiles"), cluster)


def with_archetype(df: DataFrame, profiles: DataFrame, cluster: str) -> DataFrame:
    """Attach each row's archetype; rows without a cluster get none."""
    names = stage(profiles.select(cluster, "archetype"), "archetypes")
    return df.join(names, cluster, "left")
