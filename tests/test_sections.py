"""Each section on hand-written records, with the expected values written out by hand."""

import datetime as dt

from pyspark.sql import functions as F

from custofold.operators import Lookup
from custofold.plans import sections as s
from custofold.plans.document import documents
from custofold.schemas import DATASETS, LOOKUP
from tests.helpers import data_of, value_sets, values

T1, T2 = "2020-01-01T00:00:00", "2020-02-01T00:00:00"
AT1, AT2 = dt.datetime(2020, 1, 1), dt.datetime(2020, 2, 1)
UP = {"SRC_EVT_TYP_FLG": "UP", "SRC_EXTRACT_TS": T2}


def test_base_is_the_latest_version_and_cleans_names(spark):
    data = data_of(spark, individual=[
        dict(CUSTOMER_ID="1", CUSTOMER_TITLE=" Mr", CUSTOMER_SURNAME="Old "),
        dict(CUSTOMER_ID="1", CUSTOMER_TITLE=" Dr ", CUSTOMER_SURNAME=" New", BANK_ID=" B", CUSTOMER_OWNED_BY="1 ",
             CUSTOMER_FORENAM_2=" Q ", **UP),
        dict(CUSTOMER_ID="2"),
        dict(CUSTOMER_ID="1", SRC_SYS_INST_ID="J", CUSTOMER_SURNAME="Else"),
    ])
    got = {(r.CUSTOMER_ID, r.SRC_SYS_INST_ID): r for r in s.individual_base(data).collect()}
    assert got.keys() == {("1", "I"), ("2", "I"), ("1", "J")}
    one = got["1", "I"]
    assert one.FULL_NM == "Dr   Q  New" and one.CUSTOMER_SURNAME == "New" and one.SALUTATION_NM == "Dr"
    assert (one.BANK_ID, one.CRT_DT, one.CNTRY_OF_RISK_ID, one.ALIAS_NM) == ("B1", T2, -1, None)
    assert got["2", "I"].FULL_NM == "" and got["2", "I"].TAX_NUMBER == ""
    assert "void" not in dict(s.individual_base(data).dtypes).values()


def test_base_rows_repeat_per_version_and_number(spark):
    data = data_of(
        spark, individual=[dict(CUSTOMER_ID="1"), dict(CUSTOMER_ID="1", **UP), dict(CUSTOMER_ID="2")],
        gurn=[dict(CUSTOMER_ID="1", GURN=" G1"), dict(CUSTOMER_ID="1", GURN="G2 "), dict(CUSTOMER_ID="1", GURN="G2 ")],
    )
    got = sorted((r.CUSTOMER_ID, r.CRT_DT, r.GURN) for r in s.individual_rows(data).collect() if r.GURN)
    assert got == [("1", T1, "G1"), ("1", T1, "G2"), ("1", T2, "G1"), ("1", T2, "G2")]
    assert s.individual_rows(data).count() == 5
    assert values(s.other_numbers(data), "GURN") in ([("1", "G1"), ("1", "G2")], [("1", "G2"), ("1", "G1")])


def test_relation_types_are_each_customers_own(spark):
    data = data_of(spark, individual=[dict(CUSTOMER_ID=c) for c in "123"], relationship=[
        dict(CUSTOMER_ID_1="1", CUSTOMER_ID_2="2", REL_TYPE="SB"),
        dict(CUSTOMER_ID_1="9", CUSTOMER_ID_2="2", REL_TYPE="OO"),
        dict(CUSTOMER_ID_1="3", CUSTOMER_ID_2="9", REL_TYPE="OO"),
        dict(CUSTOMER_ID_1="3", CUSTOMER_ID_2="1", REL_TYPE="??"),
    ])
    assert sorted(values(s.relation_kinds(data), "RL_TP_ID")) == [("1", "SB"), ("2", "OO"), ("2", "SB")]


def test_email(spark):
    data = data_of(
        spark,
        individual=[dict(CUSTOMER_ID="1", BANK_ID="B", CUSTOMER_OWNED_BY="1 "), dict(CUSTOMER_ID="2", BANK_ID="B", CUSTOMER_OWNED_BY="2")],
        email=[dict(CUSTOMER_ID="1", E_ADDR_TYPE="H", E_ADDR=" a@x "), dict(CUSTOMER_ID="2", E_ADDR="b@x"),
               dict(CUSTOMER_ID="1", SRC_SYS_INST_ID="J", E_ADDR="other instance"), dict(CUSTOMER_ID="9", E_ADDR="unknown")],
    )
    one = dict(EMAIL_TP_ID="H", DATA_SRC_ID="sys CDB", SRC_BRND_ID="brand 1", EMAIL_ID_VAL="a@x", SRC_SYS_CHG_DT=T1, SRC_EVT_TYP_FLG="IN")
    assert sorted(values(s.email(data, value_sets(spark)), "EMAIL"), key=repr) == [
        ("1", one), ("2", {**one, "EMAIL_TP_ID": None, "SRC_BRND_ID": None, "EMAIL_ID_VAL": "b@x"})]


def test_phone_types_and_blanks(spark):
    data = data_of(spark, individual=[
        dict(CUSTOMER_ID="1", BUSINESS_PHONE_NO=" 01 ", HOME_PHONE_NO="  ", MOBILE_PHONE_NO="07", SRC_SYS_ID=" "),
        dict(CUSTOMER_ID="2"),
    ])
    got = values(s.phone(data, value_sets(spark)), "PHONE")
    assert sorted((c, v["PHONE_TYP_ID"], v["PHONE_NUM"]) for c, v in got) == [
        ("1", "IND BUSINESS PHONE", "01"), ("1", "IND DAYTIME PHONE", "01"), ("1", "IND MOBILE PHONE", "07")]
    assert {(v["DATA_SRC_ID"], v["SRC_BRND_ID"], v["SRC_SYS_CHG_DT"]) for _, v in got} == {("sys none", "brand none", AT1)}


def test_passport(spark):
    data = data_of(spark, individual=[
        dict(CUSTOMER_ID="1", PASSPORT_NO=" P1 ", PASSPORT_CTRY="FR", LAST_CHNG_DATE="d"),
        dict(CUSTOMER_ID="2", PASSPORT_NO="P2"),
        dict(CUSTOMER_ID="3", PASSPORT_NO="  ", PASSPORT_CTRY="FR"),
    ])
    got = dict(values(s.passport(data, value_sets(spark)), "PASSPORT"))
    assert got["1"] == dict(PPT_NUM="P1", PPT_ISSUING_CNTRY_ID="France", SRC_SYS_CHG_DT="d", SRC_EXTRACT_TS=AT1, SRC_EVT_TYP_FLG="IN")
    assert got["2"]["PPT_ISSUING_CNTRY_ID"] == "no country" and got.keys() == {"1", "2"}


def test_classification_covers_ten_sets(spark):
    data = data_of(spark, individual=[
        dict(CUSTOMER_ID="1", HOME_OWNER_IND="h", DISABILITY_CODE="D", CUSTOMER_STATUS="m", SEGMENT_CODE="s",
             OCCUPATION_CODE="7", BANK_ID="b", CUSTOMER_OWNED_BY=" o "), dict(CUSTOMER_ID="2", DISABILITY_CODE=" ")])
    rows = s.classification(data, value_sets(spark))
    got = {v["CLASS_SET_NAME"]: (v["ORIG_CLASS_VAL_ID"], v["CLASS_VAL_ID"]) for _, v in values(rows, "CLASS")}
    assert got == {
        "RD HOME OWNERSHIP STATUS": ("h", None), "RD DISABILITY": ("D", "disabled"), "RD MARITAL STATUS": ("m", None),
        "RD INDIVIDUAL MARKET SEGMENT": ("s", None), "RD INDIVIDUAL EMPLOYMENT STATUS": ("7", None),
        "RD RBS EMPLOYEE": ("7", None), "RD INDIVIDUAL JOB TITLE CODE": ("7", None),
        "RD INDIVIDUAL JOB TITLE": ("7", "baker"), "RD BANK ID": ("b", None), "RD CUSTOMER OWNED BY": ("o", None)}
    assert {(r.CUSTOMER_ID, r.SRC_SYS_INST_ID, r.CLASS.SRC_EVT_TYP_FLG) for r in rows.collect()} == {("1", "I", "IN")}


def test_national_id(spark):
    data = data_of(spark, individual=[dict(CUSTOMER_ID="1", NATIONAL_INS_NO=" N1"), dict(CUSTOMER_ID="2", NATIONAL_INS_NO=" ")])
    ((who, v),) = values(s.national_id(data, value_sets(spark)), "IDVNATID")
    assert who == "1" and (v["NAT_IDENT_TP"], v["ISSUING_CNTRY_ID"], v["NAT_IDENT_VAL"]) == ("ins", "Britain", " N1")


def test_identifiers_keep_a_blank_system_in_the_key(spark):
    data = data_of(
        spark, individual=[dict(CUSTOMER_ID="1", BANK_ID="B1"), dict(CUSTOMER_ID="2", SRC_SYS_ID="")],
        gurn=[dict(CUSTOMER_ID="1", GURN="G1", SRC_SYS_ID="other"), dict(CUSTOMER_ID="9", GURN="G9")])
    rows = s.identifiers(data, value_sets(spark))
    got = {(r.CUSTOMER_ID, r.SRC_SYS_ID, r.IDVIDENT.IDENT_TP_ID, r.IDVIDENT.IDV_ID_VAL, r.IDVIDENT.DATA_SRC_ID, r.IDVIDENT.SRC_BRND_ID)
           for r in rows.collect()}
    assert got == {("1", "S", "own", "1", "sys S", "brand 1"), ("1", "S", "other", "G1", "sys S", "brand 1"),
                   ("2", "", "own", "2", "sys none", "brand none")}


def test_relations(spark):
    data = data_of(spark, individual=[dict(CUSTOMER_ID="1"), dict(CUSTOMER_ID="1", **UP), dict(CUSTOMER_ID="2")], relationship=[
        dict(CUSTOMER_ID_1="1", CUSTOMER_ID_2="2", REL_TYPE="SB", DATE_CREATED="d1"),
        dict(CUSTOMER_ID_1="1", CUSTOMER_ID_2="9", REL_TYPE="SB", DATE_CREATED="d2"),
        dict(CUSTOMER_ID_1="8", CUSTOMER_ID_2="2", REL_TYPE="OO", DATE_CREATED="d3"),
        dict(CUSTOMER_ID_1="1", CUSTOMER_ID_2="2", REL_TYPE="??", DATE_CREATED="d4"),
    ])
    table = value_sets(spark)
    both = sorted((c, v["REL_TYPE"], v["RL_TP_ID"], v["DATE_CREATED"]) for c, v in values(s.individual_relations(data, table), "RL_IDV"))
    assert both == [("1", "SB", "sibling", "d1"), ("2", "SB", "sibling", "d1")]
    org = sorted((c, v["REL_TYPE"], v["RL_TP_ID"], v["CRT_DT"]) for c, v in values(s.organisation_relations(data, table), "IDVORG"))
    assert org == [("1", "SB", "sibling", "d1"), ("2", "OO", "owner", "d3"), ("2", "SB", "sibling", "d1"), ("8", "OO", "owner", "d3")]


def test_flags(spark):
    data = data_of(
        spark, individual=[dict(CUSTOMER_ID="1", DISABILITY_CODE="D", BANK_ID=" B ", CUSTOMER_OWNED_BY=" 1"), dict(CUSTOMER_ID="2", DISABILITY_CODE=" ")],
        indicators=[dict(CUSTOMER_ID="1", INDICATOR_TYPE="PEP", INDICATOR_VALUE="Y "), dict(CUSTOMER_ID="2", INDICATOR_TYPE="PEP", INDICATOR_VALUE="N"),
                    dict(CUSTOMER_ID="2", INDICATOR_TYPE="VIP", INDICATOR_VALUE="Y")])
    got = sorted((c, v["INDICATOR_NAME"], v["INDICATOR_TYPE"]) for c, v in values(s.flags(data), "IDV_FLAG"))
    assert got == [
        ("1", "RD POLITICALLY EXPOSED INDICATOR", "Yes"), ("1", "RD RING FENCE INDICATOR", "B1"),
        ("1", "RD SENSITIVITY FLAG", "Yes"), ("2", "RD RING FENCE INDICATOR", "Not Available")]


def test_countries(spark):
    data = data_of(
        spark,
        individual=[dict(CUSTOMER_ID="1", CTRY_OF_NATIONALTY=" FR", LAST_CHNG_DATE="2"), dict(CUSTOMER_ID="2"),
                    dict(CUSTOMER_ID="1", CTRY_OF_NATIONALTY=" FR", LAST_CHNG_DATE="1", **UP)],
        tax_residence=[dict(CUSTOMER_ID="2", CTRY_OF_TAXATION="DE", TAX_CRE_TIMESTAMP="1", SRC_EXTRACT_TS=T2),
                       dict(CUSTOMER_ID="2", CTRY_OF_TAXATION="DE", TAX_CRE_TIMESTAMP="2", SRC_EXTRACT_TS=None),
                       dict(CUSTOMER_ID="2", TAX_CRE_TIMESTAMP="3"), dict(CUSTOMER_ID="9", CTRY_OF_TAXATION="DE")],
        citizenship=[dict(CUSTOMER_ID="2", ADDNL_CITIZENSHIP="XX"), dict(CUSTOMER_ID="2", ADDNL_CITIZENSHIP=" ")])
    got = sorted((c, v["CNTRY_TYPE_ID"], v["CNTRY_ID"], v["SRC_SYS_CHG_DT"]) for c, v in
                 values(s.countries(data, value_sets(spark), dt.date(2024, 1, 1)), "IDV_CNTRY"))
    assert got == [("1", "cit", "France", T1), ("1", "nat", "France", T1), ("2", "cit", None, T1), ("2", "nat", None, T1),
                   ("2", "tax", "Germany", "2024-01-01")]
    no_tax = data_of(spark, individual=[dict(CUSTOMER_ID="1", CTRY_OF_NATIONALTY="FR")])
    assert s.countries(no_tax, value_sets(spark)).count() == 2


def test_address_follows_the_best_agreement(spark):
    lines = dict(ADDRESS_LINE_1=" l1 ", ADDRESS_LINE_5="l5", POSTCODE=" pc")
    data = data_of(
        spark,
        individual=[dict(CUSTOMER_ID=c, BANK_ID="B", CUSTOMER_OWNED_BY=" 1 ") for c in ("c", "a", "r", "none", "odd")],
        street_address=[dict(CUSTOMER_ID=c, **lines) for c in ("c", "a", "r", "none", "odd", "unknown")],
        agreement=[dict(CUSTOMER_ID=c, CUST_ADDR_STATUS=st) for c, st in
                   [("c", "R"), ("c", "A"), ("c", "C"), ("a", "R"), ("a", "A"), ("r", "R"), ("odd", "Z"), ("odd", None)]])
    got = {r.CUSTOMER_ID: r for r in s.source_address(data, value_sets(spark)).collect()}
    assert got.keys() == {"c", "a", "r", "none", "odd"}
    assert {k: r.addressLine1 for k, r in got.items()} == {"c": "l1", "a": "l1", "r": None, "none": None, "odd": None}
    assert {r.IDV_SRC.RES_ADDR_LN_1_TX for r in got.values()} == {"l1"}
    c = got["c"]
    assert (c.VSL_DATA_SRC_ID, c.addressLine5, c.IDV_SRC.RES_POSTCODE_TX, c.IDV_SRC.VSL_SRC_BRAND_ID) == ("sys CDB", "l5", "pc", "brand 1")
    assert (got["none"].IDV_SRC.SRC_EVT_TYP_FLG, c.IDV_SRC.SRC_EVT_TYP_FLG) == (None, "IN")
    sent = s.address_rows(data, value_sets(spark))
    assert sent.where("CUSTOMER_ID = 'c'").first().addressLine6 == "pc"


def test_address_of_a_busy_customer_builds_no_combinations(spark):
    data = data_of(
        spark, individual=[dict(CUSTOMER_ID="1", SRC_EXTRACT_TS=f"2020-01-01T00:{i:02}:00") for i in range(40)],
        street_address=[dict(CUSTOMER_ID="1", CUSTOMER_ADDR_NO=str(i)) for i in range(40)],
        agreement=[dict(CUSTOMER_ID="1", CUST_ADDR_STATUS="A", ACCOUNT_NO=str(i)) for i in range(40)])
    assert s.source_address(data, value_sets(spark)).count() == 1


def everything(spark):
    people = [dict(CUSTOMER_ID="1", MOBILE_PHONE_NO="07", HOME_OWNER_IND="h", DISABILITY_CODE="D"), dict(CUSTOMER_ID="2")]
    return data_of(
        spark, individual=people, gurn=[dict(CUSTOMER_ID="1", GURN="G")], email=[dict(CUSTOMER_ID="1", E_ADDR="a")],
        relationship=[dict(CUSTOMER_ID_1="1", CUSTOMER_ID_2="2", REL_TYPE="SB"), dict(CUSTOMER_ID_1="1", CUSTOMER_ID_2="2", REL_TYPE="ZB")],
        street_address=[dict(CUSTOMER_ID="2", ADDRESS_LINE_1="l")])


def test_whole_documents_in_both_shapes(spark):
    data, table = everything(spark), value_sets(spark)
    array = documents(data, table)
    got = {r.CUSTOMER_ID: r for r in array.collect()}
    assert got.keys() == {"1", "2"}
    one = got["1"]
    sizes = {c: len(one[c] or []) for c in ("GURN", "RL_TP_ID", "EMAIL", "PHONE", "CLASS", "IDVIDENT", "RL_IDV", "IDVORG", "IDV_FLAG")}
    assert sizes == dict(GURN=1, RL_TP_ID=2, EMAIL=1, PHONE=1, CLASS=2, IDVIDENT=2, RL_IDV=1, IDVORG=2, IDV_FLAG=2)
    assert one.ADDRESS is None and [a.IDV_SRC.RES_ADDR_LN_1_TX for a in got["2"].ADDRESS] == ["l"]
    rows = documents(data, table, "rows")
    # class x identifier x organisation relation x flag
    assert rows.where("CUSTOMER_ID = '1'").count() == 2 * 2 * 2 * 2
    flat = {"VSL_DATA_SRC_ID", "IDV_SRC", *[f"addressLine{i}" for i in range(1, 6)]}
    parts = {"EMAIL_PART", "PHONE_PART", "RL_TP_ID_PART"}
    assert set(rows.columns) - flat - parts == set(array.columns) - {"DOC_PART", "ADDRESS"} and flat | parts < set(rows.columns)
    assert dict(rows.dtypes)["PHONE"].startswith("array") and dict(rows.dtypes)["CLASS"].startswith("struct")


def test_no_address_is_lost_when_a_system_code_is_listed_twice(spark):
    data = everything(spark)
    found = []
    for order in (1, -1):
        twice = [("RD SRC SYSTEMS", "CDB", f"sys {k}", "OK") for k in (1, 2)][::order]
        table = Lookup.of(spark.createDataFrame(twice, LOOKUP))
        arrays = documents(data, table).where("CUSTOMER_ID = '2'").first().ADDRESS
        rows = documents(data, table, "rows").where("CUSTOMER_ID = '2'").collect()
        found.append([a.VSL_DATA_SRC_ID for a in arrays])
        assert sorted({r.VSL_DATA_SRC_ID for r in rows}) == found[-1]
    assert found == [["sys 1", "sys 2"]] * 2


def test_the_newest_address_counts(spark):
    address = [("A old", "IN", "2020-01-01T00:00:00"), ("Z new", "UP", "2020-02-01T00:00:00"), ("B bad", "IN", "later")]
    data = data_of(
        spark, individual=[dict(CUSTOMER_ID="1")],
        street_address=[dict(CUSTOMER_ID="1", ADDRESS_LINE_1=x, SRC_EVT_TYP_FLG=f, SRC_EXTRACT_TS=t) for x, f, t in address])
    (row,) = s.source_address(data, value_sets(spark)).collect()
    assert row.IDV_SRC.RES_ADDR_LN_1_TX == "Z new"


def test_no_sections_at_all(spark):
    data = data_of(spark, individual=[dict(CUSTOMER_ID="1")])
    (doc,) = documents(data, value_sets(spark)).collect()
    assert doc.EMAIL is None and doc.GURN is None and doc.ADDRESS is None
    assert len(DATASETS["individual"].columns) == 38
    assert documents(data, value_sets(spark)).where(F.col("DOC_PART") == 0).count() == 1
