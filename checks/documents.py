"""Customer documents on the given tables.

The landing batch is derived from the tables by Spark: customers are inserted individuals, their orders are
later changes, events are e-mails and indicators, line items are relationships, and so on. The SQL below
derives the same datasets on its own and states every section's result from them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from checks.registry import Tables, query, scratch
from custofold.operators import Lookup, reconcile_dataset, verification_results
from custofold.plans import BatchConfig, document_values, fold_values, run
from custofold.plans import sections as s
from custofold.plans.batch import release_datasets, store_datasets
from custofold.plans.document import section_arrays
from custofold.plans.sections.address import SUB_DOCUMENT
from custofold.plans.sections.individual import EMPTY_COLUMNS
from custofold.schemas import DATASETS, LANDING, TAG, Tags
from custofold.sources import Store, conform

TAGS = Tags()
START = "1995-01-01T00:00:00"
LANDING_ROWS = 50_000


# ------------------------------------------------------------------ the landing batch


def _text(c: str) -> Column:
    return F.col(c).cast("string")


def _time(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")


def _records(df: DataFrame, tag: str, customer: Column | None, time: Column, flag: Column | str = "IN", **columns) -> DataFrame:
    base = {
        TAG: F.lit(tag),
        "SRC_SYS_ID": F.lit("CDB"),
        "SRC_SYS_INST_ID": F.lit("LIVE"),
        "SRC_EVT_TYP_FLG": F.lit(flag) if isinstance(flag, str) else flag,
        "SRC_EXTRACT_TS": time,
        **({} if customer is None else {"CUSTOMER_ID": customer}),
        **columns,
    }
    return conform(df.select(*[c.alias(name) for name, c in base.items()]), LANDING)


def records(t: Tables, dataset: str) -> list[DataFrame]:
    """The landing records of one dataset."""
    c, o, e, li, su = t.customer, t.orders, t.events, t.lineitem, t.supplier
    segment, nation, key = F.col("c_mktsegment"), _text("c_nationkey"), _text("c_custkey")
    brand = F.when(segment != "FURNITURE", F.substring(segment, 1, 2))
    order, priority = _text("o_orderkey"), F.col("o_orderpriority")
    status = F.col("o_orderstatus")
    makers = {"individual": lambda: [
        _records(
            c, TAGS["individual"], key, F.lit(START),
            CUSTOMER_TITLE=F.concat(F.lit(" "), F.nullif(segment, F.lit("BUILDING"))),
            CUSTOMER_FIRST_NAM=F.when(segment == "HOUSEHOLD", "  ").when(segment == "MACHINERY", "Max "),
            CUSTOMER_SURNAME=F.concat(F.lit("  "), "c_name", F.lit(" ")),
            BANK_ID=brand,
            CUSTOMER_OWNED_BY=nation,
            CUSTOMER_FORENAM_1=F.when(segment != "BUILDING", F.concat(F.lit(" F"), nation)),
            CUSTOMER_FORENAM_2=F.lit("Q "),
            CUSTOMER_FORENAM_3=F.nullif(segment, F.lit("MACHINERY")),
            CUSTOMER_NAME_SFX=F.nullif(F.concat(F.lit(" Jr "), segment), F.lit(" Jr FURNITURE")),
            CUSTOMER_GENDER=F.substring(segment, 1, 1),
            CUSTOMER_DOB=F.concat(F.lit("1970-01-0"), F.substring(key, 1, 1)),
            DEPEND_CHILD_CNT=nation,
            CTRY_OF_BIRTH=F.concat(F.lit(" "), nation),
            PLACE_OF_BIRTH=F.concat("c_name", F.lit(" ")),
            TAX_NUMBER=F.concat(F.lit(" T"), key),
            GRADUATION_DATE=F.when(F.col("c_acctbal") > 5000, "1990-06-30"),
            DECEASED_DATE=F.when(F.col("c_acctbal") < 0, "1999-01-01"),
            FIRST_CONTACT_DATE=F.lit("1994-12-31"),
            HOME_OWNER_IND=F.when(F.col("c_acctbal") > 0, "Y"),
            CUSTOMER_STATUS=segment,
            CTRY_OF_RESIDENCE=nation,
            BUSINESS_PHONE_NO=F.when(F.col("c_acctbal") > 0, F.concat(F.lit("B"), key)),
            HOME_PHONE_NO=F.when(segment == "HOUSEHOLD", " ").otherwise(F.concat(F.lit(" H"), nation)),
            LAST_CHNG_DATE=F.lit("1995-01-01"),
            PASSPORT_CTRY=F.nullif(nation, F.lit("3")),
            PASSPORT_NO=F.when(segment != "MACHINERY", F.concat(F.lit(" P"), key)),
            DISABILITY_CODE=F.when(segment == "AUTOMOBILE", "D"),
            SEGMENT_CODE=segment,
            OCCUPATION_CODE=nation,
            NATIONAL_INS_NO=F.when(segment == "BUILDING", F.concat(F.lit("N"), key)),
            CTRY_OF_NATIONALTY=nation,
        ),
        _records(
            o, TAGS["individual"], _text("o_custkey"), _time("o_orderdate"),
            F.when(status == "F", "UP").when(status == "P", "DL"),
            CUSTOMER_TITLE=F.substring(priority, 1, 1),
            CUSTOMER_SURNAME=F.concat(F.lit("Order "), order),
            BANK_ID=F.lit("MA"),
            CUSTOMER_OWNED_BY=F.lit("7 "),
            MOBILE_PHONE_NO=F.concat(F.lit("M"), order),
            LAST_CHNG_DATE=F.date_format("o_orderdate", "yyyy-MM-dd"),
            CTRY_OF_NATIONALTY=F.substring(priority, 1, 1),
        ),
    ], "gurn": lambda: [
        _records(o.where((status == "F") & (priority == "1-URGENT")), TAGS["gurn"], _text("o_custkey"), F.lit(START),
                 GURN=F.concat(F.lit(" G"), order)),
    ], "email": lambda: [
        _records(
            e, TAGS["email"], _text("user_id"), F.date_format("ts", "yyyy-MM-dd'T00:00:00'"),
            SRC_SYS_INST_ID=F.when(F.col("event_type") == "error", "TEST").otherwise("LIVE"),
            E_ADDR_TYPE=F.col("event_type"),
            E_ADDR=F.concat(F.lit(" "), "event_type", F.lit("."), _text("user_id"), F.lit("@mail ")),
        ),
    ], "relationship": lambda: [
        _records(
            li, TAGS["relationship"], None, _time("l_shipdate"),
            CUSTOMER_ID_1=_text("l_suppkey"),
            CUSTOMER_ID_2=_text("l_partkey"),
            REL_TYPE=F.when(F.col("l_returnflag") == "A", "SB").when(F.col("l_returnflag") == "N", "OO").otherwise("ZB"),
            DATE_CREATED=F.date_format("l_shipdate", "yyyy-MM-dd"),
        ),
    ], "street_address": lambda: [
        _records(c, TAGS["street_address"], key, F.lit(START),
                 CUSTOMER_ADDR_NO=F.lit("2"), ADDRESS_LINE_1=F.concat(F.lit(" "), "c_name"),
                 ADDRESS_LINE_2=nation, POSTCODE=segment),
        _records(c, TAGS["street_address"], key, F.lit("1995-06-01T00:00:00"), "UP",
                 CUSTOMER_ADDR_NO=F.lit("3"), ADDRESS_LINE_1=F.concat(F.lit("Z "), "c_name"), ADDRESS_LINE_2=nation,
                 ADDRESS_LINE_3=segment, ADDRESS_LINE_4=F.concat(F.lit(" "), nation), POSTCODE=segment),
        _records(su, TAGS["street_address"], _text("s_suppkey"), F.lit(START),
                 CUSTOMER_ADDR_NO=F.lit("1"), ADDRESS_LINE_1=F.col("s_name"), ADDRESS_LINE_5=_text("s_nationkey")),
    ], "agreement": lambda: [
        _records(o, TAGS["agreement"], _text("o_custkey"), _time("o_orderdate"),
                 CUST_ADDR_STATUS=F.when(status == "F", "C").when(status == "O", "A").otherwise("R"), ACCOUNT_NO=order),
    ], "tax_residence": lambda: [
        _records(o, TAGS["tax_residence"], _text("o_custkey"), _time("o_orderdate"),
                 CTRY_OF_TAXATION=F.substring(priority, 1, 1), TAX_CRE_TIMESTAMP=order),
    ], "citizenship": lambda: [
        _records(su, TAGS["citizenship"], _text("s_suppkey"), F.lit("1996-06-01T00:00:00"),
                 ADDNL_CITIZENSHIP=_text("s_nationkey")),
    ], "indicators": lambda: [
        _records(
            e, TAGS["indicators"], _text("user_id"), F.date_format("ts", "yyyy-MM-dd'T00:00:00'"),
            UPDATE_DATE_TIME=F.date_format("ts", "yyyy-MM-dd"),
            INDICATOR_TYPE=F.when(F.col("event_type").isin("purchase", "view"), "PEP").otherwise("OTHER"),
            INDICATOR_VALUE=F.when(F.col("event_type") == "view", "N").otherwise("Y "),
        ),
    ]}
    return makers[dataset]()


def landing(t: Tables) -> DataFrame:
    """The mixed batch: one frame, all nine datasets."""
    return reduce(DataFrame.unionByName, [frame for name in DATASETS for frame in records(t, name)])


def write_landing(records: DataFrame, folder: str, most: int = LANDING_ROWS) -> None:
    """JSON lines, packed, in files of at most ``most`` records, as a packed file is read by one task."""
    records.write.option("maxRecordsPerFile", most).json(folder, compression="gzip")


class Batch(dict):
    """The nine datasets of the reconciled batch, each built when a section asks for it."""

    def __init__(self, t: Tables):
        super().__init__()
        self.t = t

    def __missing__(self, name: str) -> DataFrame:
        rows = reduce(DataFrame.unionByName, records(self.t, name))
        self[name] = reconcile_dataset(rows, name, TAGS[name])
        return self[name]




def value_sets(t: Tables) -> DataFrame:
    """A value-set table whose country, brand and class codes come from the nations and regions."""
    nation = _text("n_nationkey")
    region = F.col("n_regionkey")
    action = F.when(region == 0, "STOP").when(region == 1, "BLOCK").when(region != 2, "OK")
    per_nation = [
        ("RD COUNTRY CODES", nation, F.col("n_name"), action),
        ("RD BRAND NAMES", F.concat(F.lit("MA"), nation), F.concat(F.lit("machine brand "), nation), F.lit("OK")),
        ("RD BRAND NAMES", F.concat(F.lit("AU"), nation), F.concat(F.lit("auto brand "), nation), F.lit("OK")),
        ("RD INDIVIDUAL EMPLOYMENT STATUS", nation, F.concat(F.lit("job "), nation), F.lit("OK")),
        ("RD CUSTOMER OWNED BY", nation, F.concat(F.lit("owner "), nation), action),
    ]
    fixed = [
        ("RD COUNTRY CODES", "GBR", "United Kingdom"),
        ("RD BRAND NAMES", "MA", "machine bank"),
        ("RD SRC SYSTEMS", "CDB", "system 1"),
        ("RD SRC SYSTEMS", "CDB", "system 2"),
        ("RD IDENTIFIER TYPES", "CIN", "own number"),
        ("RD NATIONAL IDENTITY TYPE", "Individual National Insurance Number", "insurance"),
        ("RD CUST_REL_TYPES", "SB", "sibling"),
        ("RD CUST_REL_TYPES", "OO", "owner"),
        ("RD COUNTRY TYPES", "TAX RESIDENCY COUNTRY", "tax"),
        ("RD COUNTRY TYPES", "COUNTRY OF NATIONALITY", "nationality"),
    ]
    names = ["VALUE_SET_NAME", "COLUMN_1_STRING_VALUE", "VSL_LKP_VALUE", "OUT_ACTION_CODE"]
    frames = [t.nation.select(F.lit(name), code, value, act).toDF(*names) for name, code, value, act in per_nation]
    rows = F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip([*f, "OK"], names, strict=True)]) for f in fixed])
    frames.append(t.spark.range(1).select(F.inline(rows)).toDF(*names))
    return reduce(DataFrame.unionByName, frames)


# ------------------------------------------------------------------ the same in SQL

TS = "strftime({}, '%Y-%m-%dT%H:%M:%S')"
INDIVIDUALS = f"""
ind_in AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, 'IN' AS flag, '{START}' AS ts,
         ' ' || nullif(c_mktsegment, 'BUILDING') AS title,
         CASE c_mktsegment WHEN 'HOUSEHOLD' THEN '  ' WHEN 'MACHINERY' THEN 'Max ' END AS first_nm,
         '  ' || c_name || ' ' AS surname,
         CASE WHEN c_mktsegment <> 'FURNITURE' THEN substr(c_mktsegment, 1, 2) END AS bank,
         CAST(c_nationkey AS VARCHAR) AS owned,
         CASE WHEN c_acctbal > 0 THEN 'B' || CAST(c_custkey AS VARCHAR) END AS business,
         CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN ' ' ELSE ' H' || CAST(c_nationkey AS VARCHAR) END AS home,
         NULL AS mobile, '1995-01-01' AS changed,
         nullif(CAST(c_nationkey AS VARCHAR), '3') AS ppt_country,
         CASE WHEN c_mktsegment <> 'MACHINERY' THEN ' P' || CAST(c_custkey AS VARCHAR) END AS ppt_no,
         CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'D' END AS disability,
         c_mktsegment AS segment, CAST(c_nationkey AS VARCHAR) AS occupation,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 'N' || CAST(c_custkey AS VARCHAR) END AS insurance,
         CAST(c_nationkey AS VARCHAR) AS nationality,
         CASE WHEN c_mktsegment <> 'BUILDING' THEN ' F' || CAST(c_nationkey AS VARCHAR) END AS fore1,
         'Q ' AS fore2, nullif(c_mktsegment, 'MACHINERY') AS fore3, nullif(' Jr ' || c_mktsegment, ' Jr FURNITURE') AS sfx,
         substr(c_mktsegment, 1, 1) AS gender, '1970-01-0' || substr(CAST(c_custkey AS VARCHAR), 1, 1) AS dob,
         CAST(c_nationkey AS VARCHAR) AS kids, ' ' || CAST(c_nationkey AS VARCHAR) AS birth_country,
         c_name || ' ' AS birth_place, ' T' || CAST(c_custkey AS VARCHAR) AS tax,
         CASE WHEN c_acctbal > 5000 THEN '1990-06-30' END AS graduated, CASE WHEN c_acctbal < 0 THEN '1999-01-01' END AS dead,
         '1994-12-31' AS contact, CASE WHEN c_acctbal > 0 THEN 'Y' END AS owner_ind, c_mktsegment AS status
  FROM customer),
ind_up AS (
  SELECT CAST(o_custkey AS VARCHAR) AS id, CASE o_orderstatus WHEN 'F' THEN 'UP' ELSE 'DL' END AS flag,
         {TS.format('o_orderdate')} AS ts, substr(o_orderpriority, 1, 1) AS title, NULL AS first_nm,
         'Order ' || CAST(o_orderkey AS VARCHAR) AS surname, 'MA' AS bank, '7 ' AS owned,
         NULL AS business, NULL AS home, 'M' || CAST(o_orderkey AS VARCHAR) AS mobile,
         strftime(o_orderdate, '%Y-%m-%d') AS changed, NULL AS ppt_country, NULL AS ppt_no, NULL AS disability,
         NULL AS segment, NULL AS occupation, NULL AS insurance, substr(o_orderpriority, 1, 1) AS nationality,
         NULL AS fore1, NULL AS fore2, NULL AS fore3, NULL AS sfx, NULL AS gender, NULL AS dob, NULL AS kids, NULL AS birth_country, NULL AS birth_place, NULL AS tax, NULL AS graduated, NULL AS dead, NULL AS contact, NULL AS owner_ind, NULL AS status
  FROM orders WHERE o_orderstatus IN ('F', 'P')),
ind_kept AS (
  SELECT * FROM ind_in
  UNION ALL
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, nationality, surname, title, mobile, flag) AS rn
    FROM ind_up) x WHERE rn = 1),
ind AS (
  SELECT id, flag, ts, coalesce(title, '') AS title, coalesce(first_nm, '') AS first_nm,
         coalesce(surname, '') AS surname, coalesce(bank, '') AS bank, coalesce(owned, '') AS owned,
         coalesce(business, '') AS business, coalesce(home, '') AS home, coalesce(mobile, '') AS mobile,
         changed, coalesce(ppt_country, '') AS ppt_country, coalesce(ppt_no, '') AS ppt_no,
         coalesce(disability, '') AS disability, coalesce(segment, '') AS segment,
         coalesce(occupation, '') AS occupation, coalesce(insurance, '') AS insurance, nationality,
         coalesce(fore1, '') AS fore1, coalesce(fore2, '') AS fore2, coalesce(fore3, '') AS fore3, coalesce(sfx, '') AS sfx, coalesce(gender, '') AS gender, coalesce(dob, '') AS dob, coalesce(kids, '') AS kids, coalesce(birth_country, '') AS birth_country, coalesce(birth_place, '') AS birth_place, coalesce(tax, '') AS tax, coalesce(graduated, '') AS graduated, coalesce(dead, '') AS dead, coalesce(contact, '') AS contact, coalesce(owner_ind, '') AS owner_ind, coalesce(status, '') AS status
  FROM ind_kept)"""
VSL = """
vsl AS (
  SELECT * FROM (
    SELECT 'RD COUNTRY CODES' AS vs, CAST(n_nationkey AS VARCHAR) AS src, n_name AS lkp,
           CASE n_regionkey WHEN 0 THEN 'STOP' WHEN 1 THEN 'BLOCK' WHEN 2 THEN NULL ELSE 'OK' END AS act FROM nation
    UNION ALL SELECT 'RD BRAND NAMES', 'MA' || CAST(n_nationkey AS VARCHAR), 'machine brand ' || CAST(n_nationkey AS VARCHAR), 'OK' FROM nation
    UNION ALL SELECT 'RD BRAND NAMES', 'AU' || CAST(n_nationkey AS VARCHAR), 'auto brand ' || CAST(n_nationkey AS VARCHAR), 'OK' FROM nation
    UNION ALL SELECT 'RD INDIVIDUAL EMPLOYMENT STATUS', CAST(n_nationkey AS VARCHAR), 'job ' || CAST(n_nationkey AS VARCHAR), 'OK' FROM nation
    UNION ALL SELECT 'RD CUSTOMER OWNED BY', CAST(n_nationkey AS VARCHAR), 'owner ' || CAST(n_nationkey AS VARCHAR),
           CASE n_regionkey WHEN 0 THEN 'STOP' WHEN 1 THEN 'BLOCK' WHEN 2 THEN NULL ELSE 'OK' END FROM nation
    UNION ALL SELECT vs, src, lkp, 'OK' FROM (VALUES
      ('RD COUNTRY CODES', 'GBR', 'United Kingdom'), ('RD BRAND NAMES', 'MA', 'machine bank'),
      ('RD SRC SYSTEMS', 'CDB', 'system 1'), ('RD SRC SYSTEMS', 'CDB', 'system 2'),
      ('RD IDENTIFIER TYPES', 'CIN', 'own number'),
      ('RD NATIONAL IDENTITY TYPE', 'Individual National Insurance Number', 'insurance'),
      ('RD CUST_REL_TYPES', 'SB', 'sibling'), ('RD CUST_REL_TYPES', 'OO', 'owner'),
      ('RD COUNTRY TYPES', 'TAX RESIDENCY COUNTRY', 'tax'),
      ('RD COUNTRY TYPES', 'COUNTRY OF NATIONALITY', 'nationality')) v(vs, src, lkp)) x
  WHERE act NOT IN ('STOP', 'BLOCK'))"""
RELATIONS = f"""
rel AS (
  SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS id1, CAST(l_partkey AS VARCHAR) AS id2,
         CASE l_returnflag WHEN 'A' THEN 'SB' WHEN 'N' THEN 'OO' ELSE 'ZB' END AS kind,
         {TS.format('l_shipdate')} AS ts, strftime(l_shipdate, '%Y-%m-%d') AS day
  FROM lineitem)"""

# Section values in SQL: the CTE gives (id, inst, v), where v is the value written out as text.
SECTION_SQL: dict[str, str] = {}
SECTION_FRAME: dict[str, Callable[[Mapping[str, DataFrame], Lookup], DataFrame]] = {}


def _section(name: str, build, sql: str) -> None:
    SECTION_FRAME[name] = build
    SECTION_SQL[name] = sql


def _n(c: str) -> str:
    return f"coalesce({c}, '-')"


_section(
    "GURN",
    lambda d, v: s.other_numbers(d),
    """SELECT i.id, 'LIVE' AS inst, trim(' G' || CAST(o_orderkey AS VARCHAR)) AS v
       FROM ind i JOIN orders ON CAST(o_custkey AS VARCHAR) = i.id
       WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""",
)
_section(
    "RL_TP_ID",
    lambda d, v: s.relation_kinds(d),
    """SELECT i.id, 'LIVE' AS inst, kind AS v FROM ind i JOIN (
         SELECT id1 AS id, kind FROM rel WHERE id2 IN (SELECT id FROM ind)
         UNION SELECT id2, kind FROM rel WHERE id2 IN (SELECT id FROM ind)) r ON r.id = i.id""",
)
_section(
    "EMAIL",
    s.email,
    f"""SELECT e.id, e.inst, e.kind || '~' || {_n('sy.lkp')} || '~' || {_n('br.lkp')} || '~' || e.kind || '.' || e.id ||
               '@mail' || '~' || e.ts || '~IN' AS v
        FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS id, event_type AS kind,
                     strftime(ts, '%Y-%m-%dT00:00:00') AS ts,
                     CASE event_type WHEN 'error' THEN 'TEST' ELSE 'LIVE' END AS inst FROM events) e
        JOIN (SELECT DISTINCT id, trim(bank || owned) AS brand FROM ind) b ON b.id = e.id AND e.inst = 'LIVE'
        LEFT JOIN vsl sy ON sy.vs = 'RD SRC SYSTEMS' AND sy.src = 'CDB'
        LEFT JOIN vsl br ON br.vs = 'RD BRAND NAMES' AND br.src = b.brand""",
)
_section(
    "PHONE",
    s.phone,
    f"""SELECT p.id, 'LIVE' AS inst, kind || '~' || trim(num) || '~' || {_n('sy.lkp')} || '~' || {_n('br.lkp')} || '~' ||
               replace(ts, 'T', ' ') || '~' || flag AS v
        FROM (SELECT *, 'IND BUSINESS PHONE' AS kind, business AS num FROM ind
              UNION ALL SELECT *, 'IND DAYTIME PHONE', business FROM ind
              UNION ALL SELECT *, 'IND EVENING PHONE', home FROM ind
              UNION ALL SELECT *, 'IND LANDLINE PHONE', home FROM ind
              UNION ALL SELECT *, 'IND MOBILE PHONE', mobile FROM ind) p
        LEFT JOIN vsl sy ON sy.vs = 'RD SRC SYSTEMS' AND sy.src = 'CDB'
        LEFT JOIN vsl br ON br.vs = 'RD BRAND NAMES'
                        AND br.src = CASE WHEN trim(bank || owned) = '' THEN 'Not Available' ELSE bank || owned END
        WHERE trim(num) <> ''""",
)
_section(
    "PASSPORT",
    s.passport,
    f"""SELECT i.id, 'LIVE' AS inst, trim(ppt_no) || '~' || {_n('c.lkp')} || '~' || changed || '~' ||
               replace(ts, 'T', ' ') || '~' || flag AS v
        FROM ind i LEFT JOIN vsl c ON c.vs = 'RD COUNTRY CODES'
                                  AND c.src = CASE WHEN trim(ppt_country) = '' THEN 'Not Available' ELSE ppt_country END
        WHERE trim(ppt_no) <> ''""",
)
_section(
    "CLASS",
    s.classification,
    f"""SELECT c.id, 'LIVE' AS inst, flag || '~' || val || '~' || changed || '~' || replace(ts, 'T', ' ') || '~' || cls ||
               '~' || {_n('l.lkp')} AS v
        FROM (SELECT *, 'RD DISABILITY' AS cls, disability AS val FROM ind
              UNION ALL SELECT *, 'RD INDIVIDUAL MARKET SEGMENT', segment FROM ind
              UNION ALL SELECT *, 'RD INDIVIDUAL EMPLOYMENT STATUS', occupation FROM ind
              UNION ALL SELECT *, 'RD RBS EMPLOYEE', occupation FROM ind
              UNION ALL SELECT *, 'RD INDIVIDUAL JOB TITLE CODE', occupation FROM ind
              UNION ALL SELECT *, 'RD INDIVIDUAL JOB TITLE', occupation FROM ind
              UNION ALL SELECT *, 'RD BANK ID', bank FROM ind
              UNION ALL SELECT *, 'RD CUSTOMER OWNED BY', trim(owned) FROM ind
              UNION ALL SELECT *, 'RD HOME OWNERSHIP STATUS', owner_ind FROM ind
              UNION ALL SELECT *, 'RD MARITAL STATUS', status FROM ind) c
        LEFT JOIN vsl l ON l.vs = cls AND l.src = val
        WHERE trim(val) <> ''""",
)
_section(
    "IDVNATID",
    s.national_id,
    """SELECT id, 'LIVE' AS inst, 'insurance~United Kingdom~' || insurance || '~' || changed || '~' ||
              replace(ts, 'T', ' ') || '~' || flag AS v
       FROM ind WHERE trim(insurance) <> ''""",
)
_section(
    "IDVIDENT",
    s.identifiers,
    f"""SELECT i.id, 'LIVE' AS inst, {_n('ty.lkp')} || '~' || {_n('sy.lkp')} || '~' || {_n('br.lkp')} || '~' || num ||
               '~' || changed || '~' || ts || '~' || flag AS v
        FROM (SELECT *, 'CIN' AS kind, id AS num FROM ind
              UNION ALL
              SELECT ind.*, 'GURN', ' G' || CAST(o_orderkey AS VARCHAR) FROM ind
              JOIN orders ON CAST(o_custkey AS VARCHAR) = id
              WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') i
        LEFT JOIN vsl ty ON ty.vs = 'RD IDENTIFIER TYPES' AND ty.src = kind
        LEFT JOIN vsl sy ON sy.vs = 'RD SRC SYSTEMS' AND sy.src = 'CDB'
        LEFT JOIN vsl br ON br.vs = 'RD BRAND NAMES' AND br.src = CASE WHEN bank = '' THEN 'Not Available' ELSE bank END""",
)
_section(
    "RL_IDV",
    s.individual_relations,
    """SELECT id, 'LIVE' AS inst, 'SB~sibling~' || day || '~' || ts || '~IN' AS v FROM (
         SELECT id1 AS id, day, ts FROM rel WHERE kind = 'SB' AND id1 IN (SELECT id FROM ind) AND id2 IN (SELECT id FROM ind)
         UNION
         SELECT id2, day, ts FROM rel WHERE kind = 'SB' AND id1 IN (SELECT id FROM ind) AND id2 IN (SELECT id FROM ind)) x""",
)
_section(
    "IDVORG",
    s.organisation_relations,
    f"""SELECT x.id, 'LIVE' AS inst, kind || '~' || {_n('l.lkp')} || '~' || day || '~' || ts || '~IN' AS v FROM (
          SELECT id1 AS id, kind, day, ts FROM rel WHERE id2 IN (SELECT id FROM ind)
          UNION ALL SELECT id2, kind, day, ts FROM rel WHERE id2 IN (SELECT id FROM ind)) x
        LEFT JOIN vsl l ON l.vs = 'RD CUST_REL_TYPES' AND l.src = kind""",
)
_section(
    "IDV_FLAG",
    lambda d, v: s.flags(d),
    """SELECT id, 'LIVE' AS inst, 'Yes~RD SENSITIVITY FLAG~' || changed || '~' || ts || '~' || flag AS v
       FROM ind WHERE trim(disability) <> ''
       UNION ALL
       SELECT id, 'LIVE', CASE WHEN trim(bank) || trim(owned) = '' THEN 'Not Available' ELSE trim(bank) || trim(owned) END ||
              '~RD RING FENCE INDICATOR~' || changed || '~' || ts || '~' || flag FROM ind
       UNION ALL
       SELECT CAST(user_id AS VARCHAR), 'LIVE', 'Yes~RD POLITICALLY EXPOSED INDICATOR~' || strftime(ts, '%Y-%m-%d') || '~' ||
              strftime(ts, '%Y-%m-%dT00:00:00') || '~IN' FROM events WHERE event_type = 'purchase'""",
)
_section(
    "IDV_CNTRY",
    s.countries,
    f"""SELECT id, 'LIVE' AS inst, {_n('ct.lkp')} || '~' || {_n('cc.lkp')} || '~' || ts || '~' || flag AS v FROM (
          SELECT *, row_number() OVER (PARTITION BY id, country, kind ORDER BY ts DESC, flag) AS rn FROM (
            SELECT id, country, 'TAX RESIDENCY COUNTRY' AS kind, ts, 'IN' AS flag FROM (
              SELECT CAST(o_custkey AS VARCHAR) AS id, substr(o_orderpriority, 1, 1) AS country,
                     {TS.format('o_orderdate')} AS ts,
                     row_number() OVER (PARTITION BY o_custkey, substr(o_orderpriority, 1, 1)
                                        ORDER BY CAST(o_orderkey AS VARCHAR) DESC) AS r FROM orders) a WHERE r = 1
            UNION ALL
            SELECT id, nationality, k.kind, ts, flag FROM (
              SELECT *, row_number() OVER (PARTITION BY id, nationality ORDER BY changed DESC, ts, flag) AS r FROM ind) b
              CROSS JOIN (VALUES ('COUNTRY OF CITIZENSHIP'), ('COUNTRY OF NATIONALITY')) k(kind) WHERE r = 1
            UNION ALL
            SELECT CAST(s_suppkey AS VARCHAR), CAST(s_nationkey AS VARCHAR), k.kind, '1996-06-01T00:00:00', 'IN'
            FROM supplier CROSS JOIN (VALUES ('COUNTRY OF CITIZENSHIP'), ('COUNTRY OF NATIONALITY')) k(kind)
            WHERE CAST(s_suppkey AS VARCHAR) IN (SELECT id FROM ind)) u) p
        LEFT JOIN vsl ct ON ct.vs = 'RD COUNTRY TYPES' AND ct.src = kind
        LEFT JOIN vsl cc ON cc.vs = 'RD COUNTRY CODES' AND cc.src = country
        WHERE rn = 1""",
)
def _postal(c: str) -> str:
    return _n(f"CASE WHEN st IN ('C', 'A') THEN trim({c}) END")


ADDRESS_SQL = f"""
SELECT a.id, 'LIVE' AS inst,
       {_n('sy.lkp')} || '~' || {" || '~' || ".join(_postal(f"line{i}") for i in range(1, 6))} || '~' ||
       {" || '~' || ".join(_n(f"trim(line{i})") for i in range(1, 6))} || '~-~-~' ||
       {_n('post')} || '~-~' || {_n('br.lkp')} || '~' || {_n('d.ts')} || '~' || {_n('d.flag')} AS v
FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seen DESC, line1) AS rn FROM (
        SELECT CAST(c_custkey AS VARCHAR) AS id, ' ' || c_name AS line1, CAST(c_nationkey AS VARCHAR) AS line2,
               CAST(NULL AS VARCHAR) AS line3, CAST(NULL AS VARCHAR) AS line4, CAST(NULL AS VARCHAR) AS line5,
               c_mktsegment AS post, '{START}' AS seen FROM customer
        UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'Z ' || c_name, CAST(c_nationkey AS VARCHAR), c_mktsegment,
               ' ' || CAST(c_nationkey AS VARCHAR), NULL, c_mktsegment, '1995-06-01T00:00:00' FROM customer
        UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, NULL, NULL, NULL, CAST(s_nationkey AS VARCHAR), NULL, '{START}'
        FROM supplier) x) a
JOIN (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, bank, owned) AS rn FROM ind) i ON i.id = a.id AND i.rn = 1
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pr, ts DESC) AS rn FROM (
        SELECT CAST(o_custkey AS VARCHAR) AS id, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS pr,
               CASE o_orderstatus WHEN 'F' THEN 'C' WHEN 'O' THEN 'A' ELSE 'R' END AS st,
               {TS.format('o_orderdate')} AS ts, 'IN' AS flag FROM orders) o) d ON d.id = a.id AND d.rn = 1
LEFT JOIN vsl sy ON sy.vs = 'RD SRC SYSTEMS' AND sy.src = 'CDB'
LEFT JOIN vsl br ON br.vs = 'RD BRAND NAMES' AND br.src = CASE WHEN trim(i.bank || i.owned) = '' THEN 'Not Available'
                                                             ELSE i.bank || trim(i.owned) END
WHERE a.rn = 1"""
# The 41 columns of a document's base by name, in SQL over the versions of an individual.
BASE_COLUMNS = {
    "CUSTOMER_ID": "id", "SRC_SYS_INST_ID": "'LIVE'", "SRC_SYS_ID": "'CDB'",
    "TAX_NUMBER": "trim(tax)", "PLACE_OF_BIRTH": "trim(birth_place)", "CTRY_OF_BIRTH": "trim(birth_country)",
    "CUSTOMER_NAME_SFX": "trim(sfx)", "MIDDLE_NM_1": "trim(fore1)", "MIDDLE_NM_2": "trim(fore2)", "MIDDLE_NM_3": "trim(fore3)",
    "CUSTOMER_FIRST_NAM": "trim(first_nm)", "CUSTOMER_SURNAME": "trim(surname)", "SALUTATION_NM": "trim(title)",
    "CTRY_OF_RESIDENCE": "CASE WHEN surname LIKE 'Order %' THEN '' ELSE owned END", "GRADUATION_DATE": "graduated",
    "DECEASED_DATE": "dead", "FIRST_CONTACT_DATE": "contact", "DEPEND_CHILD_CNT": "kids", "CUSTOMER_DOB": "dob",
    "CUSTOMER_GENDER": "gender", "CUSTOMER_OWNED_BY": "owned", "SRC_EVT_TYP_FLG": "flag", "CRT_DT": "ts",
    "BANK_ID": "trim(bank || owned)",
    "FULL_NM": "trim(concat_ws(' ', trim(title), trim(first_nm), trim(fore1), trim(fore2), trim(fore3), trim(surname), trim(sfx)))",
    "CNTRY_OF_RISK_ID": "-1", "LEGAL_CAPACITY_TP_ID": "-1",
    **dict.fromkeys(EMPTY_COLUMNS, "CAST(NULL AS VARCHAR)"),
}
BASE_SQL = "SELECT " + ", ".join(f'{v} AS "{k}"' for k, v in BASE_COLUMNS.items()) + """
FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, flag) AS rn FROM ind) x WHERE rn = 1"""


def _value_text(df: DataFrame, name: str) -> Column:
    """A value as the SQL writes it: its fields with ``~`` between them."""
    kind = df.schema[name].dataType.elementType
    if not hasattr(kind, "names"):
        return F.array_join(name, "|")
    fields = kind.names
    def line(x: Column) -> Column:
        return F.concat_ws("~", *[F.coalesce(x[f].cast("string"), F.lit("-")) for f in fields])
    return F.array_join(F.array_sort(F.transform(name, line)), "|")


def _gathered(name: str) -> str:
    return f"SELECT id, inst, string_agg(DISTINCT v, '|' ORDER BY v) AS v FROM ({SECTION_SQL[name]}) q GROUP BY id, inst"


def _register(name: str) -> None:
    sql = f"""WITH {INDIVIDUALS}, {VSL}, {RELATIONS}
              SELECT id AS "CUSTOMER_ID", inst AS "SRC_SYS_INST_ID", v AS "{name}" FROM ({_gathered(name)}) g"""

    @query(f"section_{name.lower()}", sql)
    def _(t: Tables) -> DataFrame:
        rows = SECTION_FRAME[name](Batch(t), Lookup.of(value_sets(t)))
        # Stored once, as in a batch run: gathering reads its input twice.
        got = section_arrays(Store(t.spark, scratch(t.spark)).materialize(rows, name), name)
        return got.select("CUSTOMER_ID", "SRC_SYS_INST_ID", _value_text(got, name).alias(name))


for _name in SECTION_SQL:
    _register(_name)


def address_text(at: Column | None = None) -> Column:
    """The source address as the SQL writes it: system, postal lines, and every field of the sub-document."""
    def field(name: str) -> Column:
        return F.col(name) if at is None else at[name]
    sub = field("IDV_SRC")
    parts = [field("VSL_DATA_SRC_ID"), *[field(f"addressLine{i}") for i in range(1, 6)], *[sub[n] for n in SUB_DOCUMENT]]
    return F.concat_ws("~", *[F.coalesce(p, F.lit("-")) for p in parts])


@query(
    "section_idv_src",
    f"""WITH {INDIVIDUALS}, {VSL} SELECT id AS "CUSTOMER_ID", v AS address FROM ({ADDRESS_SQL}) a""",
)
def _(t: Tables) -> DataFrame:
    rows = s.source_address(Batch(t), Lookup.of(value_sets(t)))
    return rows.select("CUSTOMER_ID", address_text().alias("address"))


VERIFIED_SQL = ADDRESS_SQL.replace(" || '~' || ".join(_postal(f"line{i}") for i in range(1, 6)), _postal("upper(line1)") + " || '~-~-~-~-'")


def answers(asked: DataFrame, match: str = "V4", percent: int = 100, mark: str = "") -> DataFrame:
    """An answer to each request: its first line in capitals."""

    def asked_for(name: str) -> Column:
        return F.regexp_extract("payload", f"<av:{name}>(.*?)</av:{name}>", 1)

    answer = F.concat(
        F.lit(f"<Envelope><Body><Operation><Match_Code>{match}</Match_Code><Result_Percent>{percent}</Result_Percent><AddressLine1>"),
        F.upper(asked_for("AddressLine1")),
        F.lit(f"{mark}</AddressLine1><SEQ_NUM>"),
        asked_for("SEQ_NUM"),
        F.lit("</SEQ_NUM></Operation></Body></Envelope>"),
    )
    return verification_results(asked.select(answer.alias("response")), "response")


@query(
    "section_idv_src_verified",
    f"""WITH {INDIVIDUALS}, {VSL} SELECT id AS "CUSTOMER_ID", v AS address FROM ({VERIFIED_SQL}) a""",
)
def _(t: Tables) -> DataFrame:
    """Requests from the address rows, an answer to each that gives the first line in capitals, and the lines replaced."""
    store, table = Store(t.spark, scratch(t.spark)), Lookup.of(value_sets(t))
    data = store_datasets(store, landing(t), TAGS, "unique")
    verified = answers(s.address_requests(s.address_rows(data, table)))
    rows = s.source_address(data, table, verified)
    return rows.select("CUSTOMER_ID", address_text().alias("address"))


@query(
    "individual_base",
    f"WITH {INDIVIDUALS} {BASE_SQL}",
)
def _(t: Tables) -> DataFrame:
    return s.individual_base(Batch(t))


@query(
    "reconcile_landing",
    f"""WITH {INDIVIDUALS}, {RELATIONS}
        SELECT 'individual' AS tag, id, flag, ts, surname AS detail FROM ind_kept
        UNION ALL SELECT 'relationship', id1 || '>' || id2, 'IN', ts, kind FROM rel
        UNION ALL SELECT DISTINCT 'email', CAST(user_id AS VARCHAR), 'IN', strftime(ts, '%Y-%m-%dT00:00:00'), event_type FROM events
        UNION ALL SELECT 'agreement', CAST(o_custkey AS VARCHAR), 'IN', {TS.format('o_orderdate')}, CAST(o_orderkey AS VARCHAR) FROM orders
        UNION ALL SELECT 'gurn', CAST(o_custkey AS VARCHAR), NULL, NULL, ' G' || CAST(o_orderkey AS VARCHAR) FROM orders
          WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
        UNION ALL SELECT 'street_address', CAST(c_custkey AS VARCHAR), NULL, '{START}', ' ' || c_name FROM customer
        UNION ALL SELECT 'street_address', CAST(c_custkey AS VARCHAR), NULL, '1995-06-01T00:00:00', 'Z ' || c_name FROM customer
        UNION ALL SELECT 'street_address', CAST(s_suppkey AS VARCHAR), NULL, '{START}', s_name FROM supplier
        UNION ALL SELECT 'tax_residence', CAST(o_custkey AS VARCHAR), 'IN', {TS.format('o_orderdate')}, CAST(o_orderkey AS VARCHAR) FROM orders
        UNION ALL SELECT 'citizenship', CAST(s_suppkey AS VARCHAR), 'IN', '1996-06-01T00:00:00', CAST(s_nationkey AS VARCHAR) FROM supplier
        UNION ALL SELECT DISTINCT 'indicators', CAST(user_id AS VARCHAR), 'IN', strftime(ts, '%Y-%m-%dT00:00:00'),
          CASE WHEN event_type IN ('purchase', 'view') THEN 'PEP' ELSE 'OTHER' END || '~' ||
          CASE WHEN event_type = 'view' THEN 'N' ELSE 'Y ' END || '~' || strftime(ts, '%Y-%m-%d') FROM events""",
)
def _(t: Tables) -> DataFrame:
    data = Batch(t)
    ends = F.concat("CUSTOMER_ID_1", F.lit(">"), "CUSTOMER_ID_2")
    detail = {
        "individual": ("CUSTOMER_ID", "CUSTOMER_SURNAME"),
        "relationship": (ends, "REL_TYPE"),
        "email": ("CUSTOMER_ID", "E_ADDR_TYPE"),
        "agreement": ("CUSTOMER_ID", "ACCOUNT_NO"),
        "gurn": ("CUSTOMER_ID", "GURN"),
        "street_address": ("CUSTOMER_ID", "ADDRESS_LINE_1"),
        "tax_residence": ("CUSTOMER_ID", "TAX_CRE_TIMESTAMP"),
        "citizenship": ("CUSTOMER_ID", "ADDNL_CITIZENSHIP"),
        "indicators": ("CUSTOMER_ID", F.concat_ws("~", "INDICATOR_TYPE", "INDICATOR_VALUE", "UPDATE_DATE_TIME")),
    }

    def kept(name: str, column: str) -> Column:
        return F.col(column) if column in DATASETS[name].columns else F.lit(None).cast("string")

    frames = [
        data[name].select(
            F.lit(name).alias("tag"),
            (F.col(key) if isinstance(key, str) else key).alias("id"),
            kept(name, "SRC_EVT_TYP_FLG").alias("flag"),
            kept(name, "SRC_EXTRACT_TS").alias("ts"),
            (F.col(text) if isinstance(text, str) else text).alias("detail"),
        )
        for name, (key, text) in detail.items()
    ]
    return reduce(DataFrame.unionByName, frames)


ARRAYS = list(SECTION_SQL)
GATHERED = (
    f"WITH {INDIVIDUALS}, {VSL}, {RELATIONS}, "
    + ", ".join(f"s_{n} AS ({_gathered(n)})" for n in ARRAYS)
    + f", s_address AS (SELECT id, string_agg(DISTINCT v, '|' ORDER BY v) AS v FROM ({ADDRESS_SQL}) a GROUP BY id)"
)
DOCUMENT_SQL = (
    f"{GATHERED} SELECT b.*, "
    + ", ".join(f's_{n}.v AS "{n}"' for n in ARRAYS)
    + f""", s_address.v AS "ADDRESS", 0 AS "DOC_PART" FROM ({BASE_SQL}) b """
    + " ".join(f'LEFT JOIN s_{n} ON s_{n}.id = b."CUSTOMER_ID" AND s_{n}.inst = b."SRC_SYS_INST_ID"' for n in ARRAYS)
    + """ LEFT JOIN s_address ON s_address.id = b."CUSTOMER_ID" """
)


def document_text(docs: DataFrame) -> DataFrame:
    addresses = F.array_join(F.array_sort(F.transform("ADDRESS", address_text)), "|")
    return docs.select(
        *BASE_COLUMNS, *[_value_text(docs, n).alias(n) for n in ARRAYS], addresses.alias("ADDRESS"), "DOC_PART"
    )


def stored_values(t: Tables) -> DataFrame:
    """The stacked values of all documents, with the two stored steps of a batch run."""
    store = Store(t.spark, scratch(t.spark))
    data = store_datasets(store, landing(t), TAGS, "unique")
    values = store.materialize(document_values(data, Lookup.of(value_sets(t))), "partial")
    release_datasets(store, data, "unique")
    return values


@query("customer_document", DOCUMENT_SQL)
def customer_document(t: Tables) -> DataFrame:
    """Reconcile, split, sections, fold: whole documents."""
    return document_text(fold_values(stored_values(t)))


@query("customer_document_verified", DOCUMENT_SQL.replace(ADDRESS_SQL, VERIFIED_SQL))
def _(t: Tables) -> DataFrame:
    """Documents with verified address lines; a second, worse answer to every request changes nothing."""
    store, table = Store(t.spark, scratch(t.spark)), Lookup.of(value_sets(t))
    data = store_datasets(store, landing(t), TAGS, "unique")
    asked = s.address_requests(s.address_rows(data, table))
    both = answers(asked).unionByName(answers(asked, percent=60, mark=" OR NOT")).unionByName(answers(asked, "?", 100, "?"))
    values = store.materialize(document_values(data, table, verified=both), "partial")
    release_datasets(store, data, "unique")
    return document_text(fold_values(values))


VALUE_SQL = " UNION ALL ".join(
    [f"""SELECT id, '{n}' AS section, v FROM (SELECT DISTINCT id, inst, v FROM ({SECTION_SQL[n]}) q) d
         WHERE EXISTS (SELECT 1 FROM base WHERE base."CUSTOMER_ID" = d.id AND d.inst = 'LIVE')""" for n in ARRAYS]
    + [f"""SELECT id, 'ADDRESS', v FROM (SELECT DISTINCT id, v FROM ({ADDRESS_SQL}) q) d"""]
)


@query(
    "customer_document_parts",
    f"""WITH {INDIVIDUALS}, {VSL}, {RELATIONS}, base AS ({BASE_SQL}), vals AS ({VALUE_SQL}),
        sizes AS (SELECT "CUSTOMER_ID" AS id, "FULL_NM" AS name, (SELECT count(*) FROM vals WHERE vals.id = "CUSTOMER_ID") AS n FROM base)
        SELECT s.id AS "CUSTOMER_ID", s.name AS "FULL_NM", n + 1 > 12 AS continued, true AS parts_fit, section, v
        FROM sizes s LEFT JOIN vals ON vals.id = s.id""",
)
def _(t: Tables) -> DataFrame:
    """Documents of at most about twelve values a part: every value once, under a part that has the base filled."""
    docs = document_text(fold_values(stored_values(t), max_items=12))
    none = F.array().cast("array<struct<section:string,v:string>>")

    def listed(name: str) -> Column:
        texts = F.split(F.col(name), r"\|")
        return F.coalesce(F.transform(texts, lambda v: F.struct(F.lit(name).alias("section"), v.alias("v"))), none)

    values = F.flatten(F.array(*[listed(n) for n in (*ARRAYS, "ADDRESS")]))
    # The parts of a customer lie in one task as they are gathered, so they are counted there.
    own = Window.partitionBy("CUSTOMER_ID")
    counted = docs.select("CUSTOMER_ID", "FULL_NM", "DOC_PART", values.alias("values")).withColumns(
        {"n": F.sum(F.size("values")).over(own), "place": F.dense_rank().over(own.orderBy("DOC_PART"))}
    ).withColumns({"last": F.max("DOC_PART").over(own), "parts": F.max("place").over(own)})
    rows = counted.withColumn("one", F.explode_outer("values"))
    together = rows.where("one IS NOT NULL OR DOC_PART = 0")
    fits = (F.col("last") + 1 == F.ceil((F.col("n") + 1) / 12)) & (F.col("parts") == F.col("last") + 1)
    empty_first = F.col("one").isNull() & (F.col("n") > 0)  # a first part to which no value was dealt
    return together.where(~empty_first).select(
        "CUSTOMER_ID", "FULL_NM", (F.col("last") > 0).alias("continued"), fits.alias("parts_fit"), "one.section", "one.v"
    )


@query("customer_document_run", DOCUMENT_SQL)
def _(t: Tables) -> DataFrame:
    """The whole batch run, from JSON files to the stored documents."""
    base = scratch(t.spark)
    write_landing(landing(t), f"{base}/landing")
    store = Store(t.spark, f"{base}/tables")
    store.append(value_sets(t), "value_sets")
    return document_text(run(t.spark, BatchConfig(f"{base}/landing"), store))
