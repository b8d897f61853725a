"""Two ready-made scorecards: listed companies, and the customers of a star schema."""

from __future__ import annotations

from scoreloom.config import FLAG, PENALTY, Archetype, Metric, Pillar, Scorecard

# The name of what fits no rule, and the pillar colours.
MIDDLING = "Mid-Tier Performers"
COLOURS = ("#27ae60", "#2980b9", "#8e44ad")


def _archetypes(composite: str, pillars: tuple[str, str, str], names: tuple[str, str, str]) -> tuple[Archetype, ...]:
    """The rules over a composite and its first, second and third pillar, in order."""
    first, second, third = pillars
    # Names, comparisons and bounds.
    return (
        Archetype("Balanced Leaders", ((composite, ">=", 72),)),
        Archetype("Structural Laggards", ((first, "<", 20), (second, "<", 40))),
        Archetype(names[0], ((third, ">=", 65), (first, "<", 40))),
        Archetype(names[1], ((first, ">=", 60), (second, "<", 45))),
        Archetype(names[2], ((second, ">=", 60), (first, "<", 50))),
    )


# The company scorecard's columns, labels, weights and thresholds.
SUSTAINABILITY = Scorecard(
    name="esg",
    key="ticker",
    label="company",
    group="sector",
    attributes=("country",),
    size="market_cap_bn",
    plural="companies",
    composite_label="Composite ESG",
    pillars=(
        Pillar("env", "Environmental", 0.40, COLOURS[0]),
        Pillar("soc", "Social", 0.35, COLOURS[1]),
        Pillar("gov", "Governance", 0.25, COLOURS[2]),
    ),
    metrics=(
        Metric("carbon_emissions_mt", "env", "Carbon Emissions", 0.25, "Carbon Emissions (MT CO2e)", True),
        Metric("renewable_energy_pct", "env", "Renewable Energy", 0.25, "Renewable Energy (%)"),
        Metric("water_usage_intensity", "env", "Water Usage", 0.20, "Water Usage Intensity", True),
        Metric("waste_recycling_pct", "env", "Waste Recycling", 0.20, "Waste Recycling (%)"),
        Metric("env_controversies", "env", "Env Controversies", 0.10, lower_is_better=True, kind=PENALTY, cap=4),
        Metric("employee_turnover_pct", "soc", "Employee Turnover", 0.20, "Employee Turnover (%)", True),
        Metric("gender_diversity_pct", "soc", "Gender Diversity", 0.20, "Gender Diversity (%)"),
        Metric("safety_incident_rate", "soc", "Safety Incidents", 0.25, "Safety Incident Rate", True),
        Metric("community_investment_mn", "soc", "Community Investment", 0.20, "Community Investment ($M)", log1p=True),
        Metric("data_breaches", "soc", "Data Breaches", 0.15, lower_is_better=True, kind=PENALTY, cap=2),
        Metric("board_independence_pct", "gov", "Board Independence", 0.25, "Board Independence (%)"),
        Metric("exec_pay_ratio", "gov", "Exec Pay Ratio", 0.20, "Exec Pay Ratio", True),
        Metric("audit_committee_quality", "gov", "Audit Quality", 0.20, "Audit Committee Quality"),
        Metric("anti_corruption_policy", "gov", "Anti-Corruption Policy", 0.15, kind=FLAG),
        Metric("shareholder_rights_score", "gov", "Shareholder Rights", 0.20, "Shareholder Rights Score"),
    ),
    archetypes=_archetypes("esg", ("env", "soc", "gov"), ("Governance-Strong, E-Weak", "Environmental Focus", "Social Focus")),
    default_archetype=MIDDLING,
    schema=(
        "ticker string, company string, sector string, country string, market_cap_bn int, year int, "
        "carbon_emissions_mt double, renewable_energy_pct int, water_usage_intensity double, "
        "waste_recycling_pct int, env_controversies int, employee_turnover_pct double, "
        "gender_diversity_pct int, safety_incident_rate double, community_investment_mn int, "
        "data_breaches int, board_independence_pct int, exec_pay_ratio int, "
        "audit_committee_quality int, anti_corruption_policy int, shareholder_rights_score int"
    ),
)

CUSTOMER = Scorecard(
    name="account",
    key="customer_key",
    label="customer",
    group="segment",
    attributes=("country",),
    plural="customers",
    composite_label="Composite",
    pillars=(
        Pillar("fulfilment", "Fulfilment", 0.40, COLOURS[0]),
        Pillar("commercial", "Commercial", 0.35, COLOURS[1]),
        Pillar("credit", "Credit", 0.25, COLOURS[2]),
    ),
    metrics=(
        Metric("ship_lag_days", "fulfilment", "Shipping Lag", 0.25, "Shipping Lag (days)", True),
        Metric("fulfilled_pct", "fulfilment", "Fulfilled Lines", 0.25, "Fulfilled Lines (%)"),
        Metric("avg_tax", "fulfilment", "Average Tax", 0.20, "Average Tax", True),
        Metric("kept_pct", "fulfilment", "Kept Lines", 0.20, "Kept Lines (%)"),
        Metric("urgent_orders", "fulfilment", "Urgent Orders", 0.10, lower_is_better=True, kind=PENALTY, cap=4),
        Metric("return_pct", "commercial", "Returned Lines", 0.20, "Returned Lines (%)", True),
        Metric("part_diversity_pct", "commercial", "Part Diversity", 0.20, "Part Diversity (%)"),
        Metric("avg_discount", "commercial", "Average Discount", 0.25, "Average Discount", True),
        Metric("revenue", "commercial", "Revenue", 0.20, "Revenue", log1p=True),
        Metric("pending_orders", "commercial", "Pending Orders", 0.15, lower_is_better=True, kind=PENALTY, cap=2),
        Metric("account_balance", "credit", "Account Balance", 0.25, "Account Balance"),
        Metric("price_spread_ratio", "credit", "Price Spread", 0.20, "Price Spread Ratio", True),
        Metric("supplier_breadth", "credit", "Supplier Breadth", 0.20, "Supplier Breadth"),
        Metric("in_credit", "credit", "In Credit", 0.15, kind=FLAG),
        Metric("priority_breadth", "credit", "Priority Breadth", 0.20, "Priority Breadth"),
    ),
    archetypes=_archetypes(
        "account",
        ("fulfilment", "commercial", "credit"),
        ("Credit-Strong, Fulfilment-Weak", "Fulfilment Focus", "Commercial Focus"),
    ),
    default_archetype=MIDDLING,
)
