"""From entities to a scored, rated and ranked table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from scoreloom.config import Scorecard
from scoreloom.operators.marts import group_summary, metric_detail, scores_long
from scoreloom.operators.metadata import framework_record
from scoreloom.operators.rank import group_percentiles
from scoreloom.operators.score import bands, composite, pillar_scores
from scoreloom.plans.staging import stage
from scoreloom.sources.writers import write_marts, write_record


def score_entities(entities: DataFrame, card: Scorecard) -> DataFrame:
    """Pillar scores, composite, rating and bands: two passes, no shuffle of rows."""
    return bands(composite(pillar_scores(entities, card), card), card)


def build_scorecard(entities: DataFrame, card: Scorecard) -> DataFrame:
    """The master table: everything of :func:`score_entities` plus percentiles.

    ``entities`` is read three times (bounds, percentiles, result). Stage it
    first when it is the outcome of joins or aggregates.
    """
    scored = score_entities(entities, card)
    ranked = group_percentiles(scored, card.group, card.all_scores)
    percentiles = [f"{score}_{card.group}_pct" for score in card.all_scores]
    scores = [*card.all_scores, card.rating]
    score_bands = [card.band, *(f"{p.slug}_band" for p in card.pillars)]
    return ranked.select(*entities.columns, *scores, *percentiles, *score_bands)


def run_scorecard(
    entities: DataFrame,
    card: Scorecard,
    folder: str,
    fmt: str = "csv",
    scoring_date: str | None = None,
    by_group: bool = False,
    file_rows: int | None = None,
) -> DataFrame:
    """Score ``entities``, write all marts and the framework record, return the master table.

    With ``by_group`` the marts of entities are written in a folder per group,
    large groups in several files; the summary of groups stays one table in order.
    ``file_rows`` limits the rows of a file.
    """
    held = stage(entities, "entities")
    master = stage(build_scorecard(held, card), "master")
    write_marts(
        {
            f"{card.name}_scores_master": master,
            f"{card.name}_scores_long": scores_long(master, card),
            f"{card.name}_metric_detail": metric_detail(held, card),
        },
        folder,
        fmt,
        card.group if by_group else None,
        file_rows,
    )
    write_marts({f"{card.name}_{card.group}_summary": group_summary(master, card).orderBy(card.group)}, folder, fmt)
    write_record(framework_record(held, card, scoring_date), f"{folder.rstrip('/')}/scoring_framework")
    return master
