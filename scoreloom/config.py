"""What a scorecard is: entities, pillars, and the metrics that feed them.

The registry is plain data. Operators read it while they build a plan, so no
part of it is evaluated per row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

SCALED, PENALTY, FLAG = "scaled", "penalty", "flag"

# Rating edges and letters. An edge belongs to the letter below it.
RATING_EDGES = (0, 30, 45, 55, 65, 75, 85, 100)
RATING_LETTERS = ("D", "C", "C+", "B", "B+", "A", "A+")

# Score bands, lower bound included, and the band of everything else.
BANDS = ((75, "Leader"), (55, "Average"), (35, "Laggard"))
LOWEST_BAND = "Critical"
BAND_COLOURS = {
    "Leader": "#2ecc71",
    "Average": "#f39c12",
    "Laggard": "#e74c3c",
    "Critical": "#8e44ad",
}


@dataclass(frozen=True)
class Metric:
    """One input column and how it enters its pillar.

    ``scaled`` metrics are min-max scaled over the universe, ``penalty`` counts
    are subtracted, ``flag`` columns count 100 when set.
    """

    column: str
    pillar: str
    name: str
    weight: float
    label: str = ""
    lower_is_better: bool = False
    kind: str = SCALED
    log1p: bool = False
    cap: float = 4.0
    points: float = 10.0


@dataclass(frozen=True)
class Pillar:
    slug: str
    label: str
    weight: float
    colour: str = ""

    @property
    def score(self) -> str:
        return f"{self.slug}_score"


@dataclass(frozen=True)
class Archetype:
    """A named profile: every ``(measure, comparison, bound)`` must hold.

    ``measure`` is a pillar slug or the scorecard name (the composite).
    """

    name: str
    conditions: tuple[tuple[str, str, float], ...]


@dataclass(frozen=True)
class Scorecard:
    """Column roles and registry of one kind of entity."""

    name: str
    key: str
    label: str
    group: str
    pillars: tuple[Pillar, ...]
    metrics: tuple[Metric, ...]
    attributes: tuple[str, ...] = ()
    size: str | None = None
    archetypes: tuple[Archetype, ...] = ()
    default_archetype: str = "Other"
    plural: str = "entities"
    composite_label: str = "Composite"
    schema: str = field(default="", repr=False)

    @property
    def score(self) -> str:
        return f"{self.name}_score"

    @property
    def rating(self) -> str:
        return f"{self.name}_rating"

    @property
    def band(self) -> str:
        return f"{self.name}_band"

    @property
    def pillar_scores(self) -> list[str]:
        return [p.score for p in self.pillars]

    @property
    def all_scores(self) -> list[str]:
        return [*self.pillar_scores, self.score]

    @property
    def weights(self) -> dict[str, float]:
        return {p.slug: p.weight for p in self.pillars}

    @property
    def scaled(self) -> list[Metric]:
        return [m for m in self.metrics if m.kind == SCALED]

    @property
    def metric_columns(self) -> list[str]:
        return [m.column for m in self.metrics]

    @property
    def id_columns(self) -> list[str]:
        return [self.key, self.label, self.group, *self.attributes]

    def of_pillar(self, slug: str) -> list[Metric]:
        """The registry restricted to one pillar."""
        return [m for m in self.metrics if m.pillar == slug]

    def pillar_label(self, slug: str) -> str:
        return next(p.label for p in self.pillars if p.slug == slug)
