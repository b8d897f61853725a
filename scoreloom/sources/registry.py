"""Scorecards as data: read from JSON or from tables, checked, and written back."""

from __future__ import annotations

import json
import math
from dataclasses import asdict, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.config import FLAG, PENALTY, SCALED, Archetype, Metric, Pillar, Scorecard
from scoreloom.functions.literals import small_table

KINDS = (SCALED, PENALTY, FLAG)
COMPARISONS = (">=", ">", "<=", "<", "=", "<>")
# How far weights may be from adding up to one.
TOLERANCE = 1e-9

_METRICS = "place int, column string, pillar string, name string, weight double, label string, lower_is_better boolean, kind string, log1p boolean, cap double, points double"
_PILLARS = "place int, slug string, label string, weight double, colour string"
_ROLES = "name string, key string, label string, `group` string, size string, attributes array<string>, default_archetype string, plural string, composite_label string, schema string"
_RULES = "place int, name string, measure string, comparison string, bound double"


def problems(card: Scorecard) -> list[str]:
    """What is wrong with a scorecard; nothing, if it can be used."""
    found: list[str] = []

    def twice(what: str, values: list[str]) -> None:
        found.extend(f"{what} {v!r} stands twice" for v in sorted({v for v in values if values.count(v) > 1}))

    def number(what: str, value: object, least: float) -> bool:
        fine = isinstance(value, (int, float)) and not isinstance(value, bool) and math.isfinite(value) and value >= least
        if not fine:
            found.append(f"{what} is {value!r}")
        return fine

    for role in ("name", "key", "label", "group"):
        if not getattr(card, role):
            found.append(f"no {role}")
    if not card.pillars:
        found.append("no pillars")
    slugs = [p.slug for p in card.pillars]
    twice("pillar", slugs)
    twice("column", [c for c in (card.key, card.label, card.group, card.size, *card.attributes, *card.metric_columns) if c])
    if all([number(f"the weight of pillar {p.slug!r}", p.weight, 0) for p in card.pillars]):
        total = sum(p.weight for p in card.pillars)
        if card.pillars and abs(total - 1) > TOLERANCE:
            found.append(f"the weights of the pillars add up to {total:g}")
    for m in card.metrics:
        if m.pillar not in slugs:
            found.append(f"metric {m.column!r} is of an unknown pillar {m.pillar!r}")
        if m.kind not in KINDS:
            found.append(f"metric {m.column!r} is of an unknown kind {m.kind!r}")
        if m.log1p and m.kind != SCALED:
            found.append(f"metric {m.column!r} is a {m.kind}, which has no logarithm")
        if m.kind == PENALTY:
            number(f"the cap of {m.column!r}", m.cap, 1e-12)
            number(f"the points of {m.column!r}", m.points, 0)
    for p in card.pillars:
        own = card.of_pillar(p.slug)
        if all([number(f"the weight of {m.column!r}", m.weight, 0) for m in own]):
            total = sum(m.weight for m in own)
            if abs(total - 1) > TOLERANCE:
                found.append(f"the weights of pillar {p.slug!r} add up to {total:g}")
    twice("archetype", [a.name for a in card.archetypes])
    for a in card.archetypes:
        for measure, comparison, bound in a.conditions:
            if measure not in (*slugs, card.name):
                found.append(f"archetype {a.name!r} asks for an unknown measure {measure!r}")
            if comparison not in COMPARISONS:
                found.append(f"archetype {a.name!r} compares by {comparison!r}")
            number(f"the bound of archetype {a.name!r}", bound, -math.inf)
        if not a.conditions:
            found.append(f"archetype {a.name!r} has no condition")
    return found


def checked(card: Scorecard, entities: DataFrame | None = None) -> Scorecard:
    """``card`` itself, if nothing is wrong with it and ``entities``, where given, has its columns."""
    found = problems(card)
    if entities is not None:
        wanted = [c for c in (*card.id_columns, card.size, *card.metric_columns) if c]
        found += [f"the entities have no column {c!r}" for c in wanted if c not in entities.columns]
    if found:
        raise ValueError(f"scorecard {card.name!r}: " + "; ".join(found))
    return card


def to_json(card: Scorecard) -> str:
    """The registry as JSON text that ``from_json`` reads back."""
    return json.dumps(asdict(card), ensure_ascii=False, indent=1)


def _only(kind: type, values: dict, what: str) -> dict:
    known = {f.name for f in fields(kind)}
    strange = sorted(values.keys() - known)
    if strange:
        raise ValueError(f"{what} has unknown entries {', '.join(strange)}")
    return values


def from_json(text: str) -> Scorecard:
    """A checked scorecard out of JSON text; unknown entries, kinds and columns raise."""
    raw = _only(Scorecard, json.loads(text), "the scorecard")
    try:
        pillars = tuple(Pillar(**_only(Pillar, p, "a pillar")) for p in raw.get("pillars", ()))
        metrics = tuple(Metric(**_only(Metric, m, "a metric")) for m in raw.get("metrics", ()))
        rules = tuple(
            Archetype(a["name"], tuple((m, c, b) for m, c, b in a["conditions"])) for a in (_only(Archetype, a, "an archetype") for a in raw.get("archetypes", ()))
        )
        attributes = tuple(raw.get("attributes", ()))
        card = Scorecard(**{**raw, "pillars": pillars, "metrics": metrics, "archetypes": rules, "attributes": attributes})
    except (KeyError, TypeError) as wrong:
        raise ValueError(f"not a scorecard: {wrong}") from None
    return checked(card)


def registry_tables(spark: SparkSession, card: Scorecard) -> dict[str, DataFrame]:
    """The registry as tables: roles (one row), pillars, metrics, and a row for each condition of an archetype."""
    role = (card.name, card.key, card.label, card.group, card.size, list(card.attributes), card.default_archetype, card.plural, card.composite_label, card.schema)
    pillars = [(i, p.slug, p.label, float(p.weight), p.colour) for i, p in enumerate(card.pillars)]
    metrics = [
        (i, m.column, m.pillar, m.name, float(m.weight), m.label, m.lower_is_better, m.kind, m.log1p, float(m.cap), float(m.points))
        for i, m in enumerate(card.metrics)
    ]
    rules = [(i, a.name, m, c, float(b)) for i, a in enumerate(card.archetypes) for m, c, b in a.conditions]
    tables = (("roles", [role], _ROLES), ("pillars", pillars, _PILLARS), ("metrics", metrics, _METRICS), ("archetypes", rules, _RULES))
    return {name: small_table(spark, rows, schema) for name, rows, schema in tables}


def from_tables(roles: DataFrame, pillars: DataFrame, metrics: DataFrame, archetypes: DataFrame) -> Scorecard:
    """A checked scorecard out of ``registry_tables``, in the order of ``place``.

    The tables are as long as the registry and come to the driver whole. Conditions
    of one archetype stand in one place, in the order of measure.
    """
    held = roles.limit(2).collect()
    if len(held) != 1:
        raise ValueError("roles must have one row")
    role = held[0].asDict()
    own = {
        "pillars": tuple(Pillar(r["slug"], r["label"], r["weight"], r["colour"] or "") for r in pillars.orderBy("place").collect()),
        "metrics": tuple(
            Metric(**{f.name: r[f.name] for f in fields(Metric) if r[f.name] is not None}) for r in metrics.orderBy("place").collect()
        ),
    }
    grouped = archetypes.groupBy("place", "name").agg(F.sort_array(F.collect_list(F.struct("measure", "comparison", "bound"))).alias("conditions"))
    own["archetypes"] = tuple(Archetype(r["name"], tuple(tuple(c) for c in r["conditions"])) for r in grouped.orderBy("place").collect())
    kept = {k: v for k, v in role.items() if v is not None}
    return checked(Scorecard(**{**kept, "attributes": tuple(role["attributes"] or ()), **own}))


def agrees_with_record(card: Scorecard, record: DataFrame) -> list[str]:
    """How a framework record (see ``framework_record``) differs from the registry; nothing, if it was written with it."""
    row = record.first()
    told = row["pillars"].asDict() if row is not None else {}
    found = [f"no pillar {p.label!r}" for p in card.pillars if p.label not in told]
    found += [f"pillar {label!r} is not registered" for label in told if label not in {p.label for p in card.pillars}]
    for p in card.pillars:
        if p.label in told:
            if told[p.label]["weight"] != f"{p.weight:.0%}":
                found.append(f"pillar {p.label!r} weighs {told[p.label]['weight']} there")
            if list(told[p.label]["metrics"]) != [m.name for m in card.of_pillar(p.slug)]:
                found.append(f"pillar {p.label!r} has other metrics there")
    return found
