"""A small made-up universe of companies, and its scores worked out in pandas."""

import numpy as np
import pandas as pd

from scoreloom.config import FLAG, PENALTY
from scoreloom.presets import SUSTAINABILITY as CARD


def companies(n: int = 40, seed: int = 7) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    df = pd.DataFrame(
        {
            "ticker": [f"T{i:03d}" for i in range(n)],
            "company": [f"Company {i * 7 % n:03d}" for i in range(n)],
            "sector": [f"S{i % 4}" if i % 3 else "S0" for i in range(n)],
            "country": [f"C{i % 5}" for i in range(n)],
            "market_cap_bn": rng.integers(50, 3000, n),
            "year": 2023,
        }
    )
    for m in CARD.metrics:
        if m.kind == PENALTY:
            df[m.column] = rng.integers(0, int(m.cap) + 3, n)
        elif m.kind == FLAG:
            df[m.column] = rng.integers(0, 2, n)
        elif " int" in next(f for f in CARD.schema.split(", ") if f.startswith(m.column)):
            df[m.column] = rng.integers(5, 100, n)
        else:
            df[m.column] = rng.uniform(0.5, 90, n).round(1)
    return df


def halfeven(x, digits=1):
    return np.rint(x * 10.0**digits) / 10.0**digits


# Three companies whose scores were worked out by hand: each metric of MIDDLE lies halfway
# between the two others (community investment by its logarithm), penalties and flags apart.
WORKED_COLUMNS = (
    "ticker", "company", "sector", "country", "market_cap_bn", "year",
    "carbon_emissions_mt", "renewable_energy_pct", "water_usage_intensity", "waste_recycling_pct", "env_controversies",
    "employee_turnover_pct", "gender_diversity_pct", "safety_incident_rate", "community_investment_mn", "data_breaches",
    "board_independence_pct", "exec_pay_ratio", "audit_committee_quality", "anti_corruption_policy", "shareholder_rights_score",
)
WORKED = [
    ("BEST", "Best", "S", "C", 10, 2023, 10.0, 90, 1.0, 80, 0, 5.0, 50, 0.5, 99, 0, 90, 100, 10, 0, 9),
    ("MIDDLE", "Middle", "S", "C", 10, 2023, 20.0, 50, 2.0, 60, 2, 10.0, 40, 1.0, 9, 2, 70, 200, 8, 0, 7),
    ("WORST", "Worst", "S", "C", 10, 2023, 30.0, 10, 3.0, 40, 4, 15.0, 30, 1.5, 0, 2, 50, 300, 6, 1, 5),
]
# Environment, social, governance, composite; then the percentile all four share.
WORKED_SCORES = {
    "BEST": (90.0, 85.0, 85.0, 87.0, 100.0),
    "MIDDLE": (44.5, 41.0, 42.5, 42.8, 66.7),
    "WORST": (0.0, 0.0, 15.0, 3.8, 33.3),
}


def entities(spark, df: pd.DataFrame):
    """The frame as an entity table; gaps are nulls, whole numbers stay whole."""
    kinds = dict(f.split() for f in CARD.schema.split(", "))
    cast = {"int": int, "double": float, "string": str}
    rows = [
        tuple(None if pd.isna(v) else cast[kinds[c]](v) for c, v in zip(df.columns, row))
        for row in df.itertuples(index=False)
    ]
    return spark.createDataFrame(rows, CARD.schema)
