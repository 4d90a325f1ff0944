"""Record layouts: the landing batch, its nine datasets, the code table and the audit table.

Every landing column is a string. A JSON number then reads as its text (ids keep their leading zeros),
a missing field reads as NULL, and no ANSI cast can fail between the landing file and the document.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------------
# Column names of the records, in the order the datasets list them.
# ---------------------------------------------------------------------------------------------
TAG = "SRC_LS_MAP"
FLAG = "SRC_EVT_TYP_FLG"
EXTRACT_TS = "SRC_EXTRACT_TS"
INSERT_FLAG = "IN"

DOC_KEY = ("CUSTOMER_ID", "SRC_SYS_INST_ID", "SRC_SYS_ID")
RELATION_KEY = ("CUSTOMER_ID_1", "CUSTOMER_ID_2", "REL_TYPE")

INDIVIDUAL_PLAIN = "CUSTOMER_ID SRC_EVT_TYP_FLG SRC_EXTRACT_TS SRC_SYS_ID SRC_SYS_INST_ID".split()
INDIVIDUAL_BLANKED = (
    "CUSTOMER_TITLE CUSTOMER_SURNAME CUSTOMER_FIRST_NAM CUSTOMER_FORENAM_1 CUSTOMER_FORENAM_2 "
    "CUSTOMER_FORENAM_3 CUSTOMER_NAME_SFX CUSTOMER_GENDER CUSTOMER_DOB DEPEND_CHILD_CNT BANK_ID "
    "CUSTOMER_OWNED_BY CTRY_OF_RESIDENCE CTRY_OF_BIRTH PLACE_OF_BIRTH TAX_NUMBER GRADUATION_DATE "
    "DECEASED_DATE FIRST_CONTACT_DATE BUSINESS_PHONE_NO HOME_PHONE_NO MOBILE_PHONE_NO LAST_CHNG_DATE "
    "PASSPORT_CTRY PASSPORT_EXP_DATE PASSPORT_NO HOME_OWNER_IND DISABILITY_CODE CUSTOMER_STATUS "
    "SEGMENT_CODE OCCUPATION_CODE NATIONAL_INS_NO CTRY_OF_NATIONALTY"
).split()
STREET_ADDRESS = (
    "CUSTOMER_ID CUSTOMER_ADDR_NO ADDRESS_LINE_1 ADDRESS_LINE_2 ADDRESS_LINE_3 ADDRESS_LINE_4 "
    "ADDRESS_LINE_5 POSTCODE POSTCODE_EXEMPT ADDRESS_UPDT_COUNT SRC_SYS_INST_ID SRC_SYS_ID"
).split()
GURN = "GURN CUSTOMER_ID SRC_SYS_INST_ID SRC_SYS_ID".split()
EMAIL = (
    "CUSTOMER_ID E_ADDR_TYPE UPDATE_DATE_TIME E_ADDR SRC_SYS_ID SRC_SYS_INST_ID SRC_EXTRACT_TS "
    "SRC_EVT_TYP_FLG SRC_LS_MAP"
).split()
RELATIONSHIP = (
    "SRC_SYS_ID SRC_SYS_INST_ID SRC_EVT_TYP_FLG SRC_EXTRACT_TS CUSTOMER_ID_1 REL_TYPE CUSTOMER_ID_2 "
    "DATE_CREATED SRC_LS_MAP"
).split()
INDICATORS = (
    "CUSTOMER_ID UPDATE_DATE_TIME INDICATOR_TYPE INDICATOR_VALUE SRC_SYS_INST_ID SRC_SYS_ID "
    "SRC_EXTRACT_TS SRC_EVT_TYP_FLG"
).split()
TAX_RESIDENCE = (
    "CUSTOMER_ID CTRY_OF_TAXATION SRC_EXTRACT_TS TAX_CRE_TIMESTAMP SRC_SYS_INST_ID SRC_SYS_ID "
    "SRC_EVT_TYP_FLG"
).split()
CITIZENSHIP = (
    "CUSTOMER_ID ADDNL_CITIZENSHIP SRC_SYS_INST_ID SRC_SYS_ID SRC_EXTRACT_TS SRC_EVT_TYP_FLG"
).split()
AGREEMENT = (
    "CUSTOMER_ID CUST_ADDR_STATUS BRANCH_NO ACCOUNT_NO CUSTOMER_NAME_KEY CUSTOMER_TYPE BANK_ID "
    "ACCOUNT_TYPE_CODE CUST_ACC_ADDR_ID RELATION_TYPE RELATION_SOURCE CONSENT_TO_CTCT SRC_SYS_ID "
    "SRC_SYS_INST_ID SRC_EXTRACT_TS SRC_EVT_TYP_FLG"
).split()
# ------------------------------- end of fixed values -----------------------------------------


def strings(names) -> T.StructType:
    """A schema of nullable string columns."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


@dataclass(frozen=True)
class Dataset:
    """One logical dataset inside the mixed landing batch."""

    columns: tuple[str, ...]
    blanked: frozenset[str] = frozenset()
    required: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return strings(self.columns)


DATASETS: dict[str, Dataset] = {
    "individual": Dataset(
        tuple(INDIVIDUAL_PLAIN + INDIVIDUAL_BLANKED), frozenset(INDIVIDUAL_BLANKED), ("CUSTOMER_ID",)
    ),
    "street_address": Dataset((*STREET_ADDRESS, EXTRACT_TS)),  # the time tells the newest address
    "gurn": Dataset(tuple(GURN)),
    "email": Dataset(tuple(EMAIL)),
    "relationship": Dataset(tuple(RELATIONSHIP)),
    "indicators": Dataset(tuple(INDICATORS)),
    "tax_residence": Dataset(tuple(TAX_RESIDENCE)),
    "citizenship": Dataset(tuple(CITIZENSHIP)),
    "agreement": Dataset(tuple(AGREEMENT)),
}

LANDING = strings(dict.fromkeys([TAG, *(c for d in DATASETS.values() for c in d.columns)]))

# A staged batch carries one more column, by which (and by the tag) its files are partitioned.
KIND = "CHANGE_KIND"
INSERTED, CHANGED = "insert", "change"
STAGED = T.StructType([*LANDING.fields, T.StructField(KIND, T.StringType())])

# What one parse of a landing file leaves in the stage: usable records, and others with the reason and their text.
BROKEN, REASON, RECORD = "BROKEN_LINE", "REASON", "RECORD"
LOAD = "LOAD_ID"
LOADED = T.StructType([*STAGED.fields, *strings([RECORD, REASON, LOAD]).fields])
RECORDS = T.StructType([*LANDING.fields, T.StructField(BROKEN, T.StringType())])

# The batch whose run has written a row; writing a batch again replaces what it had written.
BATCH = "BATCH_ID"

LOOKUP = strings(["VALUE_SET_NAME", "COLUMN_1_STRING_VALUE", "VSL_LKP_VALUE", "OUT_ACTION_CODE"])

AUDIT = T.StructType(
    [
        T.StructField("filename", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("lslayer", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)

VERIFIED = strings(
    "uprn mail_score match_code result_percent addressLine1 addressLine2 addressLine3 addressLine4 "
    "addressLine5 post_code request_key".split()
)


@dataclass(frozen=True)
class Tags:
    """Which tag value marks which dataset. The defaults are the dataset names themselves."""

    values: dict[str, str] = field(default_factory=lambda: {name: name for name in DATASETS})

    def __post_init__(self):
        missing = DATASETS.keys() - self.values.keys()
        if missing:
            raise ValueError(f"no tag given for {sorted(missing)}")
        unknown = self.values.keys() - DATASETS.keys()
        if unknown:
            raise ValueError(f"tags given for unknown datasets {sorted(unknown)}")
        if len(set(self.values.values())) < len(self.values):
            raise ValueError("two datasets have the same tag")

    def __getitem__(self, dataset: str) -> str:
        return self.values[dataset]
