import pytest

from ledgerline.functions.segments import closed_flag, opportunity_status, sub_region, vertical

SCHEMA = "role string, location string, region string, country string, code string, industry string"

# (role, location, region, country, code, industry) -> expected sub-region, variant A
CASES_A = [
    (("NBA", "Hub", "UK", "United Kingdom", "GB", "Financial"), "NBA"),
    (("AE", "Hub", "UK", "United Kingdom", "GB", "Travel & Hosp"), "Ticketing/Travel"),
    (("AE", "Hub", "UK", "United Kingdom", "GB", "Financial"), "Financial Services"),
    (("AE", "Hub", "UK", "United Kingdom", "GB", "On-Demand Services"), "Services, Software & Content"),
    (("AE", "Hub", "UK", "United Kingdom", "GB", "B2B"), "Services, Software & Content"),
    (("AE", "Hub", "UK", "United Kingdom", "GB", "Fashion"), "Retail"),
    (("AE", "Hub", "UK", "United Kingdom", "GB", "EDU"), "Public Sector"),
    (("AE", "Hub", "UK", "United Kingdom", "GB", None), "other"),
    (("AE", "Hub", "US/CA", "United States", "US", "Content"), "Software & Content"),
    (("AE", "Hub", "US/CA", "United States", "US", "Real Estate"), "Services"),
    (("AE", "Hub", "US/CA", "United States", "US", "Utilities"), "Public Sector"),
    (("AE", "Hub", "US/CA", "United States", "US", "Food & Bev"), "Retail"),
    (("AE", "Hub", "US/CA", "United States", "US", None), "No industry"),
    (("AE", "Hub", "US/CA", "United States", "US", "Unlisted"), "other"),
    (("AE", "Hub", "US/CA", "Canada", "CA", "Content"), "CA"),
    (("AE", "Hub", "Southern EU", "Spain", "ES", "B2B"), "Spain"),
    (("AE", "Hub", "Northern EU", "Austria", "AT", "B2B"), "DACH"),
    (("AE", "Hub", "Northern EU", "Luxembourg", "LU", "B2B"), "BENELUX"),
    (("AE", "Hub", "Northern EU", "Iceland", "IS", "B2B"), "NORDICS"),
    (("AE", "Hub", "AU/NZ", "New Zealand", "NZ", "B2B"), "New Zealand"),
    (("AE", "Hub", "SG/HK", "Singapore", "SG", "Healthcare"), "Healthcare"),
    (("AE", "Hub", "New Markets", "Brazil", "BR", "B2B"), "Brazil"),
    (("AE", "Hub", "IE", "Ireland", "IE", "B2B"), "Ireland"),
    (("AE", "Hub", "Unmapped", "Poland", "PL", "B2B"), "other"),
]


def _classify(spark, rows, **kw):
    df = spark.createDataFrame([r for r, _ in rows], SCHEMA)
    out = df.select(sub_region("role", "region", "country", "industry", code="code", location="location", **kw).alias("s"))
    return [r.s for r in out.collect()]


def test_sub_region_variant_a_every_rule(spark):
    assert _classify(spark, CASES_A) == [e for _, e in CASES_A]


def test_sub_region_variant_differences(spark):
    rows = [
        (("AE", "Hub", "US/CA", "Canada", "CA", "B2B"), None),
        (("AE", "Hub", "AU", "Australia", "AU", "B2B"), None),
        (("AE", "Hub", "SG", "Singapore", "SG", "B2B"), None),
        (("AE", "Hub", "SG/HK", "Singapore", "SG", "B2B"), None),
        (("AE", "Hub", "Northern EU", "Germany", "DE", "B2B"), None),
    ]
    assert _classify(spark, rows, variant="B") == ["Canada", "Australia", "Singapore", "other", "DACH"]
    # C: Northern EU tested on the name against ISO codes (full names fall through); SG/HK returns the country
    assert _classify(spark, rows, variant="C") == ["CA", "other", "other", "Singapore", "other"]
    # D: Northern EU tested on the code
    assert _classify(spark, rows, variant="D") == ["CA", "other", "other", "B2B", "DACH"]
    # E: older labels; US and CA tested as codes in the name column
    e_rows = [
        (("AE", "Hub", "NorthernEU", "NO", "NO", "B2B"), None),
        (("AE", "Hub", "UK", "United Kingdom", "GB", "On-Demand Services"), None),
        (("AE", "Hub", "US/CA", "US", "US", "Content"), None),
        (("NBA", "Hub", "IE", "Ireland", "IE", "B2B"), None),
    ]
    assert _classify(spark, e_rows, variant="E") == ["BENELUX", "other", "Software & Content", "NBA"]


def test_hub_rule_is_optional(spark):
    rows = [(("NBA", "Hub", "IE", "Ireland", "IE", "B2B"), None)]
    assert _classify(spark, rows) == ["NBA"]
    assert _classify(spark, rows, hub_rule=True) == ["Hub"]


@pytest.mark.parametrize("variant,industry,region,country,expected", [
    ("A", "B2B", "UK", "United Kingdom", "Services, Software & Content"),
    ("A", "B2B", "IE", "Ireland", "Software & Content"),
    ("A", "On-Demand Services", "IE", "Ireland", "Services"),
    ("A", None, "IE", "Ireland", "No industry"),
    ("A", "Unlisted", "IE", "Ireland", "other"),
    ("E", "On-Demand Services", "IE", "Ireland", "other"),
    ("F", "B2C (Software)", "IE", "Ireland", "Other"),
    ("F", "Other", "IE", "Ireland", "Public Sector"),
    ("F", "Real Estate", "UK", "United Kingdom", "Services"),
    ("F", "Financial", "UK", "United Kingdom", "Financial Services"),
])
def test_vertical_variants(spark, variant, industry, region, country, expected):
    df = spark.createDataFrame([(region, country, industry)], "region string, country string, industry string")
    assert df.select(vertical("region", "country", "industry", variant=variant).alias("v")).first().v == expected


def test_status_and_closed(spark):
    stages = ["Negotiating", "Onboarding", "Live", "Lost", None]
    df = spark.createDataFrame([(s,) for s in stages], "s string")
    got = df.select(opportunity_status("s").alias("st"), closed_flag("s").alias("c")).collect()
    assert [r.st for r in got] == ["pipeline", "signed_not_live", "signed_not_live", "lost", "lost"]
    assert [r.c for r in got] == [0, 1, 1, 0, 0]
