"""Scorecards over any table of entities, expressed as Spark DataFrame plans."""

from scoreloom.config import Archetype, Metric, Pillar, Scorecard
from scoreloom.plans.archetypes import enhance_scorecard, run_enhancement
from scoreloom.plans.scorecard import build_scorecard, run_scorecard, score_entities
from scoreloom.presets import CUSTOMER, SUSTAINABILITY
from scoreloom.sources.readers import read_entities

__all__ = [
    "Archetype",
    "CUSTOMER",
    "Metric",
    "Pillar",
    "SUSTAINABILITY",
    "Scorecard",
    "build_scorecard",
    "enhance_scorecard",
    "read_entities",
    "run_enhancement",
    "run_scorecard",
    "score_entities",
]
