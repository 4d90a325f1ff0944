"""Small invented records for the tests."""

from custofold.operators import Lookup
from custofold.schemas import DATASETS, LANDING, LOOKUP, TAG

VALUE_SETS = [
    ("RD SRC SYSTEMS", "CDB", "sys CDB", "OK"),
    ("RD SRC SYSTEMS", "S", "sys S", "OK"),
    ("RD SRC SYSTEMS", "Not Available", "sys none", "OK"),
    ("RD BRAND NAMES", "B1", "brand 1", "OK"),
    ("RD BRAND NAMES", "B2", "brand 2", "STOP"),
    ("RD BRAND NAMES", "B3", "brand 3", "BLOCK"),
    ("RD BRAND NAMES", "B4", "brand 4", None),
    ("RD BRAND NAMES", "B5", "brand 5a", "OK"),
    ("RD BRAND NAMES", "B5", "brand 5b", "OK"),
    ("RD BRAND NAMES", "Not Available", "brand none", "OK"),
    ("RD COUNTRY CODES", "FR", "France", "OK"),
    ("RD COUNTRY CODES", "DE", "Germany", "OK"),
    ("RD COUNTRY CODES", "GBR", "Britain", "OK"),
    ("RD COUNTRY CODES", "Not Available", "no country", "OK"),
    ("RD COUNTRY TYPES", "TAX RESIDENCY COUNTRY", "tax", "OK"),
    ("RD COUNTRY TYPES", "COUNTRY OF NATIONALITY", "nat", "OK"),
    ("RD COUNTRY TYPES", "COUNTRY OF CITIZENSHIP", "cit", "OK"),
    ("RD NATIONAL IDENTITY TYPE", "Individual National Insurance Number", "ins", "OK"),
    ("RD IDENTIFIER TYPES", "CIN", "own", "OK"),
    ("RD IDENTIFIER TYPES", "GURN", "other", "OK"),
    ("RD CUST_REL_TYPES", "SB", "sibling", "OK"),
    ("RD CUST_REL_TYPES", "OO", "owner", "OK"),
    ("RD DISABILITY", "D", "disabled", "OK"),
    ("RD INDIVIDUAL JOB TITLE", "7", "baker", "OK"),
]


def record(tag, **columns):
    """One landing record, an insert of system S and instance I unless told otherwise."""
    return {
        TAG: tag,
        "SRC_SYS_ID": "S",
        "SRC_SYS_INST_ID": "I",
        "SRC_EVT_TYP_FLG": "IN",
        "SRC_EXTRACT_TS": "2020-01-01T00:00:00",
        **columns,
    }


def landing(spark, records):
    return spark.createDataFrame([tuple(r.get(f) for f in LANDING.names) for r in records], LANDING)


def data_of(spark, **datasets):
    """Datasets from lists of column dicts; the missing ones are empty."""
    out = {}
    for name, spec in DATASETS.items():
        rows = [record(name, **r) for r in datasets.get(name, [])]
        blank = spec.blanked
        out[name] = spark.createDataFrame(
            [tuple((r.get(c) or "") if c in blank else r.get(c) for c in spec.columns) for r in rows], spec.schema
        )
    return out


def value_sets(spark):
    return Lookup.of(spark.createDataFrame(VALUE_SETS, LOOKUP))


def values(df, name):
    """(customer, value as a dict) pairs, without copies."""
    found = []
    for row in df.collect():
        value = row[name]
        item = (row["CUSTOMER_ID"], value.asDict() if hasattr(value, "asDict") else value)
        if item not in found:
            found.append(item)
    return found


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()
