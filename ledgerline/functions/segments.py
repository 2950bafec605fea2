"""Segment classifiers: sub-region, vertical, opportunity status.

Each classifier is an ordered rule list (first match wins) compiled into one
chained ``F.when`` expression, so it stays inside whole-stage codegen.  A rule
is a tuple of tests plus a result.  A test is ``(field, value)`` where the
value is a string (equality), a tuple (IN list) or ``None`` (IS NULL).  A
result is a string literal or ``Field(name)`` (copy that input).

Fields: ``role`` (team role), ``location`` (team), ``region`` (sales region),
``country`` (country name), ``code`` (country code), ``industry``.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclasses.dataclass(frozen=True)
class Field:
    name: str


# ---------------------------------------------------------------------------
# Rule lists of the reports, as written there.  Industry names,
# region and country labels and results must equal the source reports.
# ---------------------------------------------------------------------------

# Sub-region, base variant (processing report and margin report).
SUB_REGION_A = (
    ((("role", "NBA"),), "NBA"),
    ((("region", "UK"), ("industry", ("Ticketing & Events", "Travel & Hosp"))), "Ticketing/Travel"),
    ((("region", "UK"), ("industry", ("Financial",))), "Financial Services"),
    ((("region", "UK"), ("industry", ("Healthcare", "Professional Services", "Other Services", "B2B", "B2C Software", "Content", "Other Software & Content", "B2C (Software)", "B2B (Software)", "Real Estate", "On-Demand Services"))), "Services, Software & Content"),
    ((("region", "UK"), ("industry", ("Fashion", "Food & Bev", "Manufacturing", "Other Retail"))), "Retail"),
    ((("region", "UK"), ("industry", ("Government", "EDU", "Non-Profit", "Utilities", "Other Public Sector"))), "Public Sector"),
    ((("country", "United States"), ("industry", ("B2B", "B2C Software", "Content", "Other Software & Content", "B2C (Software)", "B2B (Software)"))), "Software & Content"),
    ((("country", "United States"), ("industry", ("Ticketing & Events", "Financial", "Healthcare", "Professional Services", "Other Services", "Travel & Hosp", "Real Estate", "On-Demand Services"))), "Services"),
    ((("country", "United States"), ("industry", ("Government", "EDU", "Non-Profit", "Utilities", "Other Public Sector"))), "Public Sector"),
    ((("country", "United States"), ("industry", ("Fashion", "Food & Bev", "Manufacturing", "Other Retail"))), "Retail"),
    ((("country", "United States"), ("industry", None)), "No industry"),
    ((("country", "Canada"),), "CA"),
    ((("region", "Southern EU"),), Field("country")),
    ((("region", "Northern EU"), ("country", ("Germany", "Austria", "Switzerland"))), "DACH"),
    ((("region", "Northern EU"), ("country", ("Belgium", "Netherlands", "Luxembourg"))), "BENELUX"),
    ((("region", "Northern EU"), ("country", ("Norway", "Finland", "Sweden", "Denmark", "Iceland"))), "NORDICS"),
    ((("region", "AU/NZ"),), Field("country")),
    ((("region", "SG/HK"),), Field("industry")),
    ((("region", "New Markets"),), Field("country")),
    ((("region", "IE"),), Field("country")),
)

# Deal-signed report: Canada spelled out, regions 'AU' and 'SG', SG returns the country.
SUB_REGION_B_CHANGES = {
    11: ((("country", "Canada"),), "Canada"),
    16: ((("region", "AU"),), Field("country")),
    17: ((("region", "SG"),), Field("country")),
}

# Pipeline report: Northern EU rules test the country name against ISO codes; SG/HK returns the country.
SUB_REGION_C_CHANGES = {
    13: ((("region", "Northern EU"), ("country", ("DE", "AT", "CH"))), "DACH"),
    14: ((("region", "Northern EU"), ("country", ("BE", "NL", "LU"))), "BENELUX"),
    15: ((("region", "Northern EU"), ("country", ("NO", "FI", "SE", "DK", "IS"))), "NORDICS"),
    17: ((("region", "SG/HK"),), Field("country")),
}

# Backlog report: Northern EU rules test the country code against ISO codes.
SUB_REGION_D_CHANGES = {
    13: ((("region", "Northern EU"), ("code", ("DE", "AT", "CH"))), "DACH"),
    14: ((("region", "Northern EU"), ("code", ("BE", "NL", "LU"))), "BENELUX"),
    15: ((("region", "Northern EU"), ("code", ("NO", "FI", "SE", "DK", "IS"))), "NORDICS"),
}

# Weekly snapshots (older rule list, complete).
SUB_REGION_E = (
    ((("role", "NBA"),), "NBA"),
    ((("region", "UK"), ("industry", ("Ticketing & Events", "Travel & Hosp"))), "Ticketing/Travel"),
    ((("region", "UK"), ("industry", ("Financial",))), "Financial Services"),
    ((("region", "UK"), ("industry", ("Healthcare", "Professional Services", "Other Services", "B2B", "B2C Software", "Content", "Other Software & Content", "B2C (Software)", "B2B (Software)", "Real Estate"))), "Services, Software & Content"),
    ((("country", "US"), ("industry", ("B2B", "B2C Software", "Content", "Other Software & Content", "B2C (Software)", "B2B (Software)"))), "Software & Content"),
    ((("country", "US"), ("industry", ("Ticketing & Events", "Financial", "Healthcare", "Professional Services", "Other Services", "Travel & Hosp", "Real Estate"))), "Services"),
    ((("country", "US"), ("industry", ("Government", "EDU", "Non-Profit", "Utilities", "Other Public Sector"))), "Public Sector"),
    ((("country", "US"), ("industry", ("Fashion", "Food & Bev", "Manufacturing", "Other Retail"))), "Retail"),
    ((("country", "US"), ("industry", None)), "No industry"),
    ((("country", "CA"),), "CA"),
    ((("region", "SouthernEU"),), Field("country")),
    ((("region", "NorthernEU"), ("country", ("DE", "AT", "CH"))), "DACH"),
    ((("region", "NorthernEU"), ("country", ("BE", "NL", "LU"))), "BENELUX"),
    ((("region", "NorthernEU"), ("country", ("NO", "FI", "SE", "DK", "IS"))), "BENELUX"),
    ((("region", "AU"),), Field("country")),
    ((("region", "SG"),), Field("country")),
    ((("region", "New Markets"),), Field("country")),
    ((("region", "IE"),), Field("country")),
)

SUB_REGION_DEFAULT = "other"

# Switched-off first rule present in every report; enable with ``hub_rule=True``.
HUB_RULE = ((("location", "Hub"),), "Hub")

# Vertical, base variant.
VERTICAL_A = (
    ((("region", "UK"), ("industry", ("Ticketing & Events", "Travel & Hosp"))), "Ticketing/Travel"),
    ((("region", "UK"), ("industry", ("Financial",))), "Financial Services"),
    ((("region", "UK"), ("industry", ("Healthcare", "Professional Services", "Other Services", "B2B", "B2C Software", "Content", "Other Software & Content", "B2C (Software)", "B2B (Software)", "Real Estate", "On-Demand Services"))), "Services, Software & Content"),
    ((("region", "UK"), ("industry", ("Fashion", "Food & Bev", "Manufacturing", "Other Retail"))), "Retail"),
    ((("region", "UK"), ("industry", ("Government", "EDU", "Non-Profit", "Utilities", "Other Public Sector"))), "Public Sector"),
    ((("industry", ("B2B", "B2C Software", "Content", "Other Software & Content", "B2C (Software)", "B2B (Software)")),), "Software & Content"),
    ((("industry", ("Ticketing & Events", "Financial", "Healthcare", "Professional Services", "Other Services", "Travel & Hosp", "Real Estate", "On-Demand Services")),), "Services"),
    ((("industry", ("Government", "EDU", "Non-Profit", "Utilities", "Other Public Sector")),), "Public Sector"),
    ((("industry", ("Fashion", "Food & Bev", "Manufacturing", "Other Retail")),), "Retail"),
    ((("industry", None),), "No industry"),
)

# Vertical, weekly snapshots.
VERTICAL_E = (
    ((("region", "UK"), ("industry", ("Ticketing & Events", "Travel & Hosp"))), "Ticketing/Travel"),
    ((("region", "UK"), ("industry", ("Financial",))), "Financial Services"),
    ((("region", "UK"), ("industry", ("Healthcare", "Professional Services", "Other Services", "B2B", "B2C Software", "Content", "Other Software & Content", "B2C (Software)", "B2B (Software)", "Real Estate"))), "Services, Software & Content"),
    ((("industry", ("B2B", "B2C Software", "Content", "Other Software & Content", "B2C (Software)", "B2B (Software)")),), "Software & Content"),
    ((("industry", ("Ticketing & Events", "Financial", "Healthcare", "Professional Services", "Other Services", "Travel & Hosp", "Real Estate")),), "Services"),
    ((("industry", ("Government", "EDU", "Non-Profit", "Utilities", "Other Public Sector")),), "Public Sector"),
    ((("industry", ("Fashion", "Food & Bev", "Manufacturing", "Other Retail")),), "Retail"),
    ((("industry", None),), "No industry"),
)

# Vertical, older daily pipeline: UK tested on the opportunity country name; default 'Other'.
VERTICAL_F = (
    ((("country", "United Kingdom"), ("industry", ("Ticketing & Events", "Travel & Hosp"))), "Ticketing/Travel"),
    ((("country", "United Kingdom"), ("industry", ("Financial",))), "Financial Services"),
    ((("country", "United Kingdom"), ("industry", ("Healthcare", "Professional Services", "Other Services", "B2B", "B2C Software", "Content", "Other Software & Content", "B2C (Software)", "B2B (Software)"))), "Services, Software & Content"),
    ((("industry", ("Ticketing & Events", "Financial", "Healthcare", "Professional Services", "Other Services", "Travel & Hosp", "Real Estate")),), "Services"),
    ((("industry", ("Fashion", "Food & Bev", "Manufacturing", "Other Retail")),), "Retail"),
    ((("industry", ("B2B", "B2C Software", "Content", "Other Software & Content")),), "Software & Content"),
    ((("industry", ("Government", "EDU", "Non-Profit", "Utilities", "Other")),), "Public Sector"),
    ((("industry", None),), "No industry"),
)

VERTICAL_DEFAULTS = {"A": "other", "E": "other", "F": "Other"}

# Opportunity stages.
PIPELINE_STAGES = ("Negotiating", "Discovering Needs", "Validating Fit", "Proposing Solution")
SIGNED_STAGES = ("Onboarding", "Live")
CLOSED_STAGES = ("Live", "Onboarding")
EXCLUDED_DEAL_STAGES = ("Lost", "Duplicate")
# ---------------------------------------------------------------------------


def _with_changes(base, changes):
    rules = list(base)
    for i, rule in changes.items():
        rules[i] = rule
    return tuple(rules)


SUB_REGION_RULES = {
    "A": SUB_REGION_A,
    "B": _with_changes(SUB_REGION_A, SUB_REGION_B_CHANGES),
    "C": _with_changes(SUB_REGION_A, SUB_REGION_C_CHANGES),
    "D": _with_changes(SUB_REGION_A, SUB_REGION_D_CHANGES),
    "E": SUB_REGION_E,
}
VERTICAL_RULES = {"A": VERTICAL_A, "E": VERTICAL_E, "F": VERTICAL_F}


def sub_region_rules(variant: str = "A", hub_rule: bool = False):
    """Rule list of a sub-region variant, optionally with the Hub rule first."""
    rules = SUB_REGION_RULES[variant]
    return ((HUB_RULE,) + rules) if hub_rule else rules


def _test(col: Column, value) -> Column:
    if value is None:
        return col.isNull()
    if isinstance(value, tuple):
        return col.isin(*value)
    return col == F.lit(value)


def compile_rules(rules, fields: dict[str, Column], default: str) -> Column:
    """Compile an ordered rule list to one chained CASE expression."""
    expr = None
    for tests, result in rules:
        cond = None
        for name, value in tests:
            t = _test(fields[name], value)
            cond = t if cond is None else (cond & t)
        out = fields[result.name] if isinstance(result, Field) else F.lit(result)
        expr = F.when(cond, out) if expr is None else expr.when(cond, out)
    return expr.otherwise(F.lit(default))


def _fields(**cols) -> dict[str, Column]:
    return {k: (F.col(v) if isinstance(v, str) else v) for k, v in cols.items() if v is not None}


def sub_region(role, region, country, industry, code=None, location=None, variant: str = "A", hub_rule: bool = False) -> Column:
    """First-match sub-region classifier (variants A..E, see module doc)."""
    fields = _fields(role=role, region=region, country=country, industry=industry, code=code, location=location)
    return compile_rules(sub_region_rules(variant, hub_rule), fields, SUB_REGION_DEFAULT)


def vertical(region, country, industry, variant: str = "A") -> Column:
    """First-match vertical classifier (variants A, E, F)."""
    fields = _fields(region=region, country=country, industry=industry)
    return compile_rules(VERTICAL_RULES[variant], fields, VERTICAL_DEFAULTS[variant])


def opportunity_status(stage) -> Column:
    """Stage -> 'pipeline' / 'signed_not_live' / 'lost' (NULL stage -> 'lost')."""
    s = F.col(stage) if isinstance(stage, str) else stage
    return (
        F.when(s.isin(*PIPELINE_STAGES), F.lit("pipeline"))
        .when(s.isin(*SIGNED_STAGES), F.lit("signed_not_live"))
        .otherwise(F.lit("lost"))
    )


def closed_flag(stage) -> Column:
    """1 when the stage is Live or Onboarding."""
    s = F.col(stage) if isinstance(stage, str) else stage
    return F.when(s.isin(*CLOSED_STAGES), F.lit(1)).otherwise(F.lit(0))
