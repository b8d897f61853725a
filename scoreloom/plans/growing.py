"""A scorecard that takes its entities batch by batch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from scoreloom.config import Scorecard
from scoreloom.operators.state import (
    State,
    batch_state,
    load_state,
    merge_states,
    moved_bounds,
    percentiles_within,
    save_state,
    score_batch,
)
from scoreloom.plans.staging import stage


@dataclass(frozen=True)
class Grown:
    """A batch's scores in the universe so far, that universe's state, and the bounds the batch moved."""

    scores: DataFrame
    state: State
    moved: DataFrame


def add_batch(batch: DataFrame, card: Scorecard, before: State | None = None) -> Grown:
    """Score ``batch`` with the bounds of the universe so far and add it to the state.

    No earlier row is read. The first batch sets the bounds. Where ``moved`` has
    rows, scores of this and of earlier batches still stand under the old bounds:
    ``scoreloom.operators.state.rebase`` takes all rows and scores them anew. Keys
    are not looked at; an entity that comes twice counts twice.
    """
    held = stage(batch, "batch")
    own = batch_state(held, card, before.basis if before else None)
    state = merge_states(before, own) if before else own
    scored = score_batch(held, card, state.bounds())
    return Grown(percentiles_within(scored, card, state), state, moved_bounds(state))


def run_batch(batch: DataFrame, card: Scorecard, new_path: str, old_path: str | None = None) -> Grown:
    """``add_batch`` on the state stored at ``old_path`` (none: the first batch); the new one goes to ``new_path``."""
    before = load_state(batch.sparkSession, old_path) if old_path else None
    grown = add_batch(batch, card, before)
    save_state(grown.state, new_path)
    return grown
