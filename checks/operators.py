"""One query per operator, on the given tables."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.registry import Tables, query, scratch
from custofold.functions import (
    blank_default,
    blank_to,
    clean,
    code_concat,
    default_today,
    full_name,
    has_value,
    null_fallback,
    parse_ts,
    typed_null,
    value_if,
)
from custofold.operators import (
    Lookup,
    assemble,
    attach,
    collect_subdocs,
    edges_both_ends,
    edges_oriented,
    edges_within,
    event_counts,
    latest_by,
    lookup,
    lookup_constant,
    merge_verified,
    priority_pick,
    read_matching,
    reconcile,
    relation_types,
    request_key,
    unpivot_typed,
    verification_requests,
    verification_results,
    with_match,
    without_match,
)
from custofold.schemas import DATASETS, KIND, LANDING, TAG, Tags
from custofold.sources import (
    Store,
    audit_append,
    conform,
    empty_dataset,
    publish_payload,
    read_records,
    rejected_records,
    reset_stage,
    split_all,
    split_by_tag,
    stage_batch,
    usable_records,
    with_reason,
)

DAY = dt.date(2024, 5, 1)


# ------------------------------------------------------------------ columns and filters


def tagged_events(t: Tables) -> DataFrame:
    """Events as records of a mixed batch, tagged by their type."""
    rows = t.events.select(
        F.col("event_type").alias(TAG),
        F.lit("IN").alias("SRC_EVT_TYP_FLG"),
        F.col("user_id").cast("string").alias("CUSTOMER_ID"),
        F.col("event_type").alias("E_ADDR_TYPE"),
        F.col("event_id").cast("string").alias("E_ADDR"),
    )
    return conform(rows, LANDING)


@query(
    "split_by_tag",
    """SELECT CAST(user_id AS VARCHAR) AS "CUSTOMER_ID", event_type AS "E_ADDR_TYPE", CAST(event_id AS VARCHAR) AS "E_ADDR"
       FROM events WHERE event_type = 'click'""",
)
def _(t: Tables) -> DataFrame:
    return split_by_tag(tagged_events(t), "email", "click").select("CUSTOMER_ID", "E_ADDR_TYPE", "E_ADDR")


@query(
    "split_all",
    """SELECT CASE event_type WHEN 'click' THEN 'email' WHEN 'view' THEN 'indicators' END AS dataset, count(*) AS n
       FROM events WHERE event_type IN ('click', 'view') GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    tags = Tags({**{n: n for n in DATASETS}, "email": "click", "indicators": "view"})
    frames = split_all(tagged_events(t), tags)
    rows = [frame.select(F.lit(name).alias("dataset")) for name, frame in frames.items()]
    rows.append(empty_dataset(t.spark, "gurn").select(F.lit("nothing").alias("dataset")))
    return reduce(DataFrame.unionByName, rows).groupBy("dataset").agg(F.count(F.lit(1)).alias("n"))


@query(
    "flag_filter",
    """SELECT o_orderkey, 'insert' AS kind FROM orders WHERE o_orderstatus = 'O'
       UNION ALL
       SELECT o_orderkey, 'change' AS kind FROM orders WHERE o_orderstatus <> 'O'""",
)
def _(t: Tables) -> DataFrame:
    staged = stage_batch(Store(t.spark, scratch(t.spark)), order_records(t), "stage")
    return staged.select(F.col("ACCOUNT_NO").cast("long").alias("o_orderkey"), F.col(KIND).alias("kind"))


def order_records(t: Tables) -> DataFrame:
    """Orders as agreement records: open ones are inserts, the others changes."""
    rows = t.orders.select(
        F.lit("agreement").alias(TAG),
        F.when(F.col("o_orderstatus") == "O", "IN").otherwise("UP").alias("SRC_EVT_TYP_FLG"),
        F.col("o_custkey").cast("string").alias("CUSTOMER_ID"),
        F.col("o_orderkey").cast("string").alias("ACCOUNT_NO"),
    )
    return conform(rows, LANDING)


@query(
    "stage_backlog",
    """SELECT 'after a failed run' AS step, count(*) AS n, count(DISTINCT o_orderkey) AS orders FROM
         (SELECT o_orderkey FROM orders UNION ALL SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O') x
       UNION ALL SELECT 'after a reset', count(*), count(DISTINCT o_orderkey) FROM orders WHERE o_orderstatus = 'P'""",
)
def _(t: Tables) -> DataFrame:
    # The first batch stays staged, as after a failed run; the second one is added to it; then the stage is reset.
    store, rows = Store(t.spark, scratch(t.spark)), order_records(t)
    stage_batch(store, rows.withColumn(TAG, F.when(F.col("ACCOUNT_NO").isNotNull(), F.col(TAG))), "stage")
    inserts = rows.where("SRC_EVT_TYP_FLG = 'IN'")
    both = stage_batch(store, inserts.unionByName(inserts.withColumn(TAG, F.lit(None).cast("string"))), "stage")

    def counted(step: str, staged: DataFrame) -> DataFrame:
        n = F.count(F.lit(1)).alias("n")
        return staged.agg(n, F.countDistinct("ACCOUNT_NO").alias("orders")).select(F.lit(step).alias("step"), "n", "orders")

    first = Store(t.spark, scratch(t.spark)).materialize(counted("after a failed run", both), "counts")
    reset_stage(store, "stage")
    late = t.orders.where("o_orderstatus = 'P'").select(F.col("o_orderkey").cast("string").alias("ACCOUNT_NO"))
    again = stage_batch(store, rows.join(late, "ACCOUNT_NO", "left_semi"), "stage")
    return first.unionByName(counted("after a reset", again))


@query(
    "landing_rejects",
    """SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'malformed line' WHEN '2-HIGH' THEN 'no tag'
              WHEN '3-MEDIUM' THEN 'unknown tag' WHEN '5-LOW' THEN 'no event flag' ELSE 'no CUSTOMER_ID' END AS "REASON",
              count(*) AS n FROM orders GROUP BY 1
       UNION ALL SELECT 'used', count(*) FROM customer""",
)
def _(t: Tables) -> DataFrame:
    """Good lines from customers, and a line that cannot be used from every order."""
    number, priority = F.col("o_orderkey").cast("string"), F.col("o_orderpriority")
    record = F.to_json(
        F.struct(
            F.when(priority == "2-HIGH", None).when(priority == "3-MEDIUM", "nobody's").otherwise("individual").alias(TAG),
            F.when(priority != "5-LOW", "IN").alias("SRC_EVT_TYP_FLG"),
            number.alias("TAX_NUMBER"),
        )
    )
    bad = t.orders.select(F.when(priority == "1-URGENT", F.concat(F.lit("{broken "), number)).otherwise(record).alias("value"))
    good = t.customer.select(
        F.to_json(
            F.struct(
                F.lit("individual").alias(TAG),
                F.lit("IN").alias("SRC_EVT_TYP_FLG"),
                F.col("c_custkey").cast("string").alias("CUSTOMER_ID"),
            )
        ).alias("value")
    )
    path = scratch(t.spark)
    bad.unionByName(good).write.text(path)
    judged = with_reason(read_records(t.spark, path), Tags())
    refused = rejected_records(judged).groupBy("REASON").agg(F.count("RECORD").alias("n"))
    return refused.unionByName(usable_records(judged).agg(F.count("CUSTOMER_ID").alias("n")).select(F.lit("used").alias("REASON"), "n"))


@query(
    "blank_default",
    "SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), '') AS segment FROM customer",
)
def _(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", blank_default(F.nullif("c_mktsegment", F.lit("BUILDING"))).alias("segment"))


@query(
    "blank_to_na",
    """SELECT c_custkey,
              CASE WHEN c_mktsegment = 'BUILDING' OR c_mktsegment = 'MACHINERY' THEN 'Not Available'
                   ELSE ' ' || c_mktsegment END AS segment
       FROM customer""",
)
def _(t: Tables) -> DataFrame:
    raw = F.when(F.col("c_mktsegment") == "BUILDING", None).when(F.col("c_mktsegment") == "MACHINERY", "  ")
    return t.customer.select(
        "c_custkey", blank_to(raw.otherwise(F.concat(F.lit(" "), "c_mktsegment"))).alias("segment")
    )


@query("clean_trim", "SELECT c_custkey, trim('  ' || c_name || ' ') AS name FROM customer")
def _(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", clean(F.concat(F.lit("  "), "c_name", F.lit(" "))).alias("name"))


@query(
    "full_name",
    """SELECT c_custkey,
              trim(concat_ws(' ', coalesce(nullif(c_mktsegment, 'BUILDING'), ''), '', c_name)) AS full_nm
       FROM customer""",
)
def _(t: Tables) -> DataFrame:
    parts = [F.nullif("c_mktsegment", F.lit("BUILDING")), F.lit("  "), F.concat(F.lit(" "), "c_name")]
    return t.customer.select("c_custkey", full_name(*parts).alias("full_nm"))


@query(
    "code_concat",
    "SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') || CAST(c_nationkey AS VARCHAR) AS code FROM customer",
)
def _(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey",
        code_concat(F.nullif("c_mktsegment", F.lit("BUILDING")), F.col("c_nationkey").cast("string")).alias("code"),
    )


@query(
    "null_fallback",
    """SELECT o_orderkey,
              coalesce(nullif(o_orderstatus, 'P'), o_orderpriority) AS status,
              coalesce(CASE WHEN o_orderstatus <> 'F' THEN strftime(o_orderdate, '%Y-%m-%d') END, '2024-05-01') AS day
       FROM orders""",
)
def _(t: Tables) -> DataFrame:
    day = F.when(F.col("o_orderstatus") != "F", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return t.orders.select(
        "o_orderkey",
        null_fallback(F.nullif("o_orderstatus", F.lit("P")), "o_orderpriority").alias("status"),
        default_today(day, DAY).alias("day"),
    )


@query(
    "constant_columns",
    """SELECT o_orderkey, 'CDB' AS system, -1 AS risk_id, CAST(NULL AS VARCHAR) AS alias_nm FROM orders""",
)
def _(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey", F.lit("CDB").alias("system"), F.lit(-1).alias("risk_id"), typed_null().alias("alias_nm")
    )


@query(
    "value_if",
    """SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'O') THEN trim(' ' || o_orderpriority) END AS line
       FROM orders""",
)
def _(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey",
        value_if(F.col("o_orderstatus").isin("F", "O"), F.concat(F.lit(" "), "o_orderpriority")).alias("line"),
    )


@query(
    "parse_ts",
    """SELECT o_orderkey,
              strftime(try_strptime(CASE WHEN o_orderstatus = 'P' THEN 'no time'
                                         ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END,
                                    '%Y-%m-%dT%H:%M:%S'), '%d.%m.%Y %H:%M') AS parsed
       FROM orders""",
)
def _(t: Tables) -> DataFrame:
    text = F.when(F.col("o_orderstatus") == "P", "no time").otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    )
    return t.orders.select("o_orderkey", F.date_format(parse_ts(text), "dd.MM.yyyy HH:mm").alias("parsed"))


@query(
    "has_value",
    """SELECT c_custkey FROM customer
       WHERE trim(CASE WHEN c_mktsegment = 'BUILDING' THEN '  ' ELSE nullif(c_mktsegment, 'MACHINERY') END) <> ''""",
)
def _(t: Tables) -> DataFrame:
    raw = F.when(F.col("c_mktsegment") == "BUILDING", "  ").otherwise(F.nullif("c_mktsegment", F.lit("MACHINERY")))
    return t.customer.where(has_value(raw)).select("c_custkey")


# ------------------------------------------------------------------ lookups

VALUE_SETS = """
vsl AS (
  SELECT 'RD COUNTRY CODES' AS value_set, CAST(n_nationkey AS VARCHAR) AS src, n_name AS lkp,
         CASE n_regionkey WHEN 0 THEN 'STOP' WHEN 1 THEN 'BLOCK' WHEN 2 THEN NULL ELSE 'OK' END AS action
  FROM nation
  UNION ALL SELECT 'RD COUNTRY CODES', CAST(n_nationkey AS VARCHAR), 'again ' || n_name, 'OK'
  FROM nation WHERE n_regionkey = 4
  UNION ALL SELECT 'RD REGIONS', CAST(r_regionkey AS VARCHAR), r_name, 'OK' FROM region
  UNION ALL SELECT 'RD SEGMENTS', c_mktsegment, 'segment ' || c_mktsegment,
                   CASE c_mktsegment WHEN 'BUILDING' THEN 'STOP' WHEN 'FURNITURE' THEN NULL ELSE 'OK' END
  FROM (SELECT DISTINCT c_mktsegment FROM customer) s
)"""


def value_sets(t: Tables) -> DataFrame:
    """A value-set table drawn from the nations, regions and market segments."""
    action = (
        F.when(F.col("n_regionkey") == 0, "STOP")
        .when(F.col("n_regionkey") == 1, "BLOCK")
        .when(F.col("n_regionkey") != 2, "OK")
    )
    key = F.col("n_nationkey").cast("string")
    segment = (
        F.when(F.col("c_mktsegment") == "BUILDING", "STOP").when(F.col("c_mktsegment") != "FURNITURE", "OK")
    )
    frames = [
        t.nation.select(F.lit("RD COUNTRY CODES"), key, "n_name", action),
        t.nation.where(F.col("n_regionkey") == 4).select(
            F.lit("RD COUNTRY CODES"), key, F.concat(F.lit("again "), "n_name"), F.lit("OK")
        ),
        t.region.select(F.lit("RD REGIONS"), F.col("r_regionkey").cast("string"), "r_name", F.lit("OK")),
        t.customer.select("c_mktsegment").distinct().select(
            F.lit("RD SEGMENTS"), "c_mktsegment", F.concat(F.lit("segment "), "c_mktsegment"), segment
        ),
    ]
    names = ["VALUE_SET_NAME", "COLUMN_1_STRING_VALUE", "VSL_LKP_VALUE", "OUT_ACTION_CODE"]
    out = frames[0].toDF(*names)
    for f in frames[1:]:
        out = out.union(f.toDF(*names))
    return out


@query(
    "lookup_static",
    f"""WITH {VALUE_SETS}
        SELECT c_custkey, code, lkp AS country
        FROM (SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS code FROM customer) c
        LEFT JOIN vsl ON value_set = 'RD COUNTRY CODES' AND src = code AND action NOT IN ('STOP', 'BLOCK')""",
)
def _(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", F.col("c_nationkey").cast("string").alias("code"))
    return lookup(rows, Lookup.of(value_sets(t)), "code", "country", set_name="RD COUNTRY CODES")


@query(
    "lookup_by_set",
    f"""WITH {VALUE_SETS}, typed AS (
          SELECT c_custkey, 'RD SEGMENTS' AS set_name, c_mktsegment AS code FROM customer
          UNION ALL SELECT c_custkey, 'RD COUNTRY CODES', CAST(c_nationkey AS VARCHAR) FROM customer
          UNION ALL SELECT c_custkey, 'RD UNKNOWN', c_name FROM customer)
        SELECT c_custkey, set_name, code, lkp AS found
        FROM typed LEFT JOIN vsl ON value_set = set_name AND src = code AND action NOT IN ('STOP', 'BLOCK')""",
)
def _(t: Tables) -> DataFrame:
    columns = [("RD SEGMENTS", "c_mktsegment"), ("RD COUNTRY CODES", "c_nationkey"), ("RD UNKNOWN", "c_name")]
    rows = unpivot_typed(t.customer, columns, "set_name", "code", ["c_custkey"])
    return lookup(rows, Lookup.of(value_sets(t)), "code", "found", set_col="set_name")


@query(
    "lookup_constant",
    f"""WITH {VALUE_SETS}
        SELECT o_orderkey, a.lkp AS twice, b.lkp AS stopped
        FROM orders
        LEFT JOIN vsl a ON a.value_set = 'RD COUNTRY CODES' AND a.src = '4' AND a.action NOT IN ('STOP', 'BLOCK')
        LEFT JOIN vsl b ON b.value_set = 'RD COUNTRY CODES' AND b.src = '0' AND b.action NOT IN ('STOP', 'BLOCK')""",
)
def _(t: Tables) -> DataFrame:
    table = Lookup.of(value_sets(t))
    rows = lookup_constant(t.orders.select("o_orderkey"), table, "RD COUNTRY CODES", "4", "twice")
    return lookup_constant(rows, table, "RD COUNTRY CODES", "0", "stopped")


# ------------------------------------------------------------------ matching, counting, reconciling

KEYS = ["o_custkey", "o_orderpriority"]


@query(
    "without_match",
    """SELECT o_orderkey FROM orders a WHERE o_orderstatus <> 'O' AND NOT EXISTS (
         SELECT 1 FROM orders b WHERE b.o_orderstatus = 'O' AND a.o_custkey = b.o_custkey
                                  AND a.o_orderpriority = b.o_orderpriority)""",
)
def _(t: Tables) -> DataFrame:
    inserts = t.orders.where("o_orderstatus = 'O'")
    return without_match(t.orders.where("o_orderstatus <> 'O'"), inserts, KEYS).select("o_orderkey")


@query(
    "with_match",
    """SELECT o_orderkey FROM orders a WHERE o_orderstatus <> 'O' AND EXISTS (
         SELECT 1 FROM orders b WHERE b.o_orderstatus = 'O' AND a.o_custkey = b.o_custkey
                                  AND a.o_orderpriority = b.o_orderpriority)""",
)
def _(t: Tables) -> DataFrame:
    inserts = t.orders.where("o_orderstatus = 'O'")
    return with_match(t.orders.where("o_orderstatus <> 'O'"), inserts, KEYS).select("o_orderkey")


@query(
    "event_counts",
    """SELECT o_custkey, o_orderpriority, count(*) AS cnt FROM orders WHERE o_orderstatus <> 'O'
       GROUP BY o_custkey, o_orderpriority HAVING count(*) = 1""",
)
def _(t: Tables) -> DataFrame:
    return event_counts(t.orders.where("o_orderstatus <> 'O'"), KEYS, "cnt").where("cnt = 1")


@query(
    "read_matching",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 5000)""",
)
def _(t: Tables) -> DataFrame:
    keys = t.customer.where("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"))
    return read_matching(t.orders, keys, ["o_custkey"], ["o_orderkey", "o_totalprice"])


@query(
    "reconcile_events",
    """WITH twice AS (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderpriority = '1-URGENT'),
       ranked AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority
                                               ORDER BY o_orderdate DESC, o_orderkey) AS rk
                  FROM twice WHERE o_orderstatus <> 'O')
       SELECT DISTINCT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
       FROM twice WHERE o_orderstatus = 'O'
       UNION ALL
       SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM ranked WHERE rk = 1""",
)
def _(t: Tables) -> DataFrame:
    copies = t.orders.unionByName(t.orders.where("o_orderpriority = '1-URGENT'"))
    kept = reconcile(copies, KEYS, ["o_orderdate"], flag="o_orderstatus", insert="O", ties=["o_orderkey"])
    return kept.drop("o_orderdate")


# ------------------------------------------------------------------ picks


@query(
    "latest_by",
    """SELECT user_id, event_type, event_id, value FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) AS rn
         FROM events) x WHERE rn = 1""",
)
def _(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", "event_type", "event_id", "value", "ts")
    return latest_by(rows, ["user_id", "event_type"], "ts", ["event_id"]).drop("ts")


@query(
    "priority_pick",
    """SELECT o_custkey, o_orderstatus, o_orderkey FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY
                     CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END, o_orderdate DESC, o_orderkey) AS rn
         FROM orders) x WHERE rn = 1""",
)
def _(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderstatus", "o_orderdate", "o_orderkey")
    best = priority_pick(
        rows, ["o_custkey"], "o_orderstatus", ["F", "O"], [F.col("o_orderdate").desc()], ["o_orderkey"]
    )
    return best.select("o_custkey", "o_orderstatus", "o_orderkey")


# ------------------------------------------------------------------ reshaping


@query(
    "unpivot_typed",
    """SELECT c_custkey, 'segment' AS kind, c_mktsegment AS val FROM customer
       UNION ALL SELECT c_custkey, 'sector', c_mktsegment FROM customer
       UNION ALL SELECT c_custkey, 'nation', CAST(c_nationkey AS VARCHAR) FROM customer
       UNION ALL SELECT c_custkey, 'name', c_name FROM customer""",
)
def _(t: Tables) -> DataFrame:
    columns = [("segment", "c_mktsegment"), ("sector", "c_mktsegment"), ("nation", "c_nationkey"), ("name", "c_name")]
    return unpivot_typed(t.customer, columns, "kind", "val", ["c_custkey"])


@query(
    "edges_within",
    """SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem
       WHERE EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size > 10)
         AND EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey AND s_nationkey > 5)""",
)
def _(t: Tables) -> DataFrame:
    edges = t.lineitem.select("l_partkey", "l_suppkey", "l_returnflag")
    parts = t.part.where("p_size > 10").select("p_partkey")
    suppliers = t.supplier.where("s_nationkey > 5").select("s_suppkey")
    return edges_within(edges, "l_partkey", "l_suppkey", parts, suppliers)


@query(
    "edges_oriented",
    """SELECT l_orderkey, l_linenumber, l_returnflag,
              CASE WHEN l_returnflag = 'R' THEN l_suppkey ELSE l_partkey END AS id1,
              CASE WHEN l_returnflag = 'R' THEN l_partkey ELSE l_suppkey END AS id2
       FROM lineitem WHERE l_returnflag IN ('A', 'R')""",
)
def _(t: Tables) -> DataFrame:
    edges = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_returnflag", F.col("l_partkey").alias("id1"), F.col("l_suppkey").alias("id2")
    )
    return edges_oriented(edges, "id1", "id2", "l_returnflag", ["A"], ["R"])


@query(
    "edges_both_ends",
    """SELECT l_partkey AS id, l_returnflag FROM lineitem UNION SELECT l_suppkey, l_returnflag FROM lineitem""",
)
def _(t: Tables) -> DataFrame:
    edges = t.lineitem.select("l_partkey", "l_suppkey", "l_returnflag")
    return edges_both_ends(edges, "l_partkey", "l_suppkey", "id")


@query(
    "rules_union",
    """SELECT CAST(c_custkey AS VARCHAR) AS id, 'low balance' AS rule FROM customer WHERE c_acctbal < 0
       UNION SELECT CAST(c_custkey AS VARCHAR), c_mktsegment FROM customer
       UNION SELECT CAST(user_id AS VARCHAR), 'buyer' FROM events WHERE event_type = 'purchase'""",
)
def _(t: Tables) -> DataFrame:
    own = (
        t.customer.select(
            F.col("c_custkey").cast("string").alias("id"),
            F.explode(
                F.array(F.when(F.col("c_acctbal") < 0, "low balance"), F.col("c_mktsegment"))
            ).alias("rule"),
        ).where(F.col("rule").isNotNull())
    )
    seen = t.events.where("event_type = 'purchase'").select(
        F.col("user_id").cast("string").alias("id"), F.lit("buyer").alias("rule")
    )
    return own.unionByName(seen).distinct()


@query(
    "identifiers_union",
    """SELECT c_custkey, 'CIN' AS kind, CAST(c_custkey AS VARCHAR) AS ident FROM customer
       UNION ALL SELECT c_custkey, 'ORDER', CAST(o_orderkey AS VARCHAR)
       FROM customer JOIN orders ON o_custkey = c_custkey""",
)
def _(t: Tables) -> DataFrame:
    own = t.customer.select("c_custkey", F.lit("CIN").alias("kind"), F.col("c_custkey").cast("string").alias("ident"))
    other = t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey")).select(
        "c_custkey", F.lit("ORDER").alias("kind"), F.col("o_orderkey").cast("string").alias("ident")
    )
    return own.unionByName(other)


@query(
    "countries_merge",
    """WITH c AS (
         SELECT c_custkey AS id, c_nationkey AS country, 'CITIZENSHIP' AS kind, c_acctbal AS seen FROM customer
         UNION SELECT c_custkey, c_nationkey, 'NATIONALITY', c_acctbal FROM customer
         UNION SELECT s_suppkey, s_nationkey, 'CITIZENSHIP', s_acctbal FROM supplier
         UNION SELECT s_suppkey, s_nationkey, 'TAX', s_acctbal FROM supplier)
       SELECT id, country, kind, seen FROM (
         SELECT *, row_number() OVER (PARTITION BY id, country, kind ORDER BY seen DESC) AS rn FROM c) x
       WHERE rn = 1""",
)
def _(t: Tables) -> DataFrame:
    def typed(df: DataFrame, key: str, nation: str, seen: str, *kinds: str) -> DataFrame:
        return df.select(
            F.col(key).alias("id"), F.col(nation).alias("country"),
            F.explode(F.array(*[F.lit(k) for k in kinds])).alias("kind"), F.col(seen).alias("seen"),
        )

    both = typed(t.customer, "c_custkey", "c_nationkey", "c_acctbal", "CITIZENSHIP", "NATIONALITY").unionByName(
        typed(t.supplier, "s_suppkey", "s_nationkey", "s_acctbal", "CITIZENSHIP", "TAX")
    )
    return latest_by(both, ["id", "country", "kind"], "seen")


@query(
    "relation_types",
    """SELECT id, string_agg(l_returnflag, ',' ORDER BY l_returnflag) AS types FROM (
         SELECT l_partkey AS id, l_returnflag FROM lineitem UNION SELECT l_suppkey, l_returnflag FROM lineitem) x
       GROUP BY id""",
)
def _(t: Tables) -> DataFrame:
    pairs = relation_types(t.lineitem, "l_partkey", "l_suppkey", "l_returnflag", "types")
    found = collect_subdocs(pairs, ["l_partkey"], "types", "types")
    return found.select(F.col("l_partkey").alias("id"), F.array_join("types", ",").alias("types"))


# ------------------------------------------------------------------ sub-documents

ORDER_TEXT = "o_orderpriority || '/' || o_orderstatus"


def order_values(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_custkey").alias("c_custkey"),
        F.struct("o_orderpriority", "o_orderstatus").alias("orders"),
    )


def order_text(column: str):
    return F.array_join(F.transform(column, lambda x: F.concat(x["o_orderpriority"], F.lit("/"), x["o_orderstatus"])), "|")


@query(
    "collect_subdocs",
    f"""SELECT o_custkey AS c_custkey, string_agg(DISTINCT {ORDER_TEXT}, '|' ORDER BY {ORDER_TEXT}) AS orders
        FROM orders GROUP BY o_custkey""",
)
def _(t: Tables) -> DataFrame:
    got = collect_subdocs(order_values(t), ["c_custkey"], "orders", "orders")
    return got.select("c_custkey", order_text("orders").alias("orders"))


@query(
    "collect_subdocs_split",
    """SELECT l_suppkey, count(*) AS n_values, min(l_partkey) AS lowest, max(l_partkey) AS highest,
              CAST(sum(l_partkey) AS BIGINT) AS total
       FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) x GROUP BY l_suppkey""",
)
def _(t: Tables) -> DataFrame:
    # Every supplier exceeds 20 values, so all of them are continued in further parts.
    parts = collect_subdocs(t.lineitem, ["l_suppkey"], "l_partkey", "parts", max_items=20)
    return (
        parts.select("l_suppkey", F.explode("parts").alias("l_partkey"))
        .groupBy("l_suppkey")
        .agg(
            F.count("*").alias("n_values"),
            F.min("l_partkey").alias("lowest"),
            F.max("l_partkey").alias("highest"),
            F.sum("l_partkey").alias("total"),
        )
    )


@query(
    "attach_rows",
    """SELECT c_custkey, c_name, o_orderpriority, o_orderstatus FROM customer
       LEFT JOIN (SELECT DISTINCT o_custkey, o_orderpriority, o_orderstatus FROM orders) o ON o_custkey = c_custkey""",
)
def _(t: Tables) -> DataFrame:
    got = attach(t.customer.select("c_custkey", "c_name"), order_values(t), ["c_custkey"], "rows")
    return got.select("c_custkey", "c_name", "orders.o_orderpriority", "orders.o_orderstatus")


@query(
    "attach_array",
    f"""SELECT c_custkey, c_name, orders FROM customer LEFT JOIN (
          SELECT o_custkey, string_agg(DISTINCT {ORDER_TEXT}, '|' ORDER BY {ORDER_TEXT}) AS orders
          FROM orders GROUP BY o_custkey) o ON o_custkey = c_custkey""",
)
def _(t: Tables) -> DataFrame:
    got = attach(t.customer.select("c_custkey", "c_name"), order_values(t), ["c_custkey"])
    return got.select("c_custkey", "c_name", order_text("orders").alias("orders"))


@query(
    "attach_parts",
    f"""SELECT c_custkey, c_name, {ORDER_TEXT} AS one, n > 3 AS continued, true AS parts_fit FROM customer
        LEFT JOIN (SELECT DISTINCT o_custkey, o_orderpriority, o_orderstatus FROM orders) o ON o_custkey = c_custkey
        LEFT JOIN (SELECT o_custkey AS id, count(DISTINCT {ORDER_TEXT}) AS n FROM orders GROUP BY o_custkey) s ON id = c_custkey""",
)
def _(t: Tables) -> DataFrame:
    # Three values to a part: the base columns stand on every part, and every value in one of them.
    got = attach(t.customer.select("c_custkey", "c_name"), order_values(t), ["c_custkey"], max_items=3)
    sizes = got.groupBy("c_custkey").agg(F.sum(F.size("orders")).alias("n"), F.max("DOC_PART").alias("last"))
    rows = got.select("c_custkey", "c_name", "DOC_PART", F.explode_outer("orders").alias("one")).join(sizes, "c_custkey")
    return rows.select(
        "c_custkey",
        "c_name",
        F.concat(F.col("one.o_orderpriority"), F.lit("/"), F.col("one.o_orderstatus")).alias("one"),
        F.when(F.col("one").isNotNull(), F.col("n") > 3).alias("continued"),
        (F.col("DOC_PART") < F.ceil(F.greatest("n", F.lit(1)) / 3)).alias("parts_fit"),
    )


@query(
    "assemble_document",
    f"""WITH o AS (SELECT o_custkey AS id, string_agg(DISTINCT {ORDER_TEXT}, '|' ORDER BY {ORDER_TEXT}) AS orders
                   FROM orders GROUP BY o_custkey),
        e AS (SELECT user_id AS id, string_agg(DISTINCT event_type, '|' ORDER BY event_type) AS events
              FROM events GROUP BY user_id),
        s AS (SELECT s_suppkey AS id, s_name FROM supplier)
        SELECT c_custkey, c_name, orders, events, s_name, 0 AS "DOC_PART"
        FROM customer LEFT JOIN o ON o.id = c_custkey LEFT JOIN e ON e.id = c_custkey LEFT JOIN s ON s.id = c_custkey""",
)
def _(t: Tables) -> DataFrame:
    docs = assemble(
        t.customer.select("c_custkey", "c_name"),
        {
            "orders": order_values(t),
            "events": t.events.select(F.col("user_id").alias("c_custkey"), F.col("event_type").alias("events")),
            "s_name": t.supplier.select(F.col("s_suppkey").alias("c_custkey"), "s_name"),
        },
        ["c_custkey"],
    )
    return docs.select(
        "c_custkey", "c_name", order_text("orders").alias("orders"), F.array_join("events", "|").alias("events"),
        F.array_join("s_name", "|").alias("s_name"), "DOC_PART",
    )


# ------------------------------------------------------------------ stores, messages, audit


@query(
    "stage_roundtrip",
    """SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus <> 'O'
       UNION ALL SELECT o_orderkey, o_orderpriority || ' new' FROM orders""",
)
def _(t: Tables) -> DataFrame:
    store = Store(t.spark, scratch(t.spark))
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus")
    store.append(rows, "orders")
    store.overwrite(store.read("orders").where("o_orderstatus <> 'O'"), "orders")
    store.append(rows.withColumn("o_orderpriority", F.concat("o_orderpriority", F.lit(" new"))), "orders")
    return store.read("orders").select("o_orderkey", "o_orderpriority")


@query(
    "publish_payload",
    """SELECT '{"c_custkey":' || CAST(c_custkey AS VARCHAR) || ',"c_name":"' || c_name || '"' ||
              coalesce(',"segment":"' || nullif(c_mktsegment, 'BUILDING') || '"', '') || '}' AS value
       FROM customer""",
)
def _(t: Tables) -> DataFrame:
    segment = F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment")
    return publish_payload(t.customer.select("c_custkey", "c_name", segment))


@query(
    "audit_rows",
    """SELECT 'orders' AS filename, o_orderstatus AS status, '2024-05-01' AS date, 'customer' AS lslayer,
              CAST(count(*) AS VARCHAR) || ' rows' AS message
       FROM orders GROUP BY o_orderstatus""",
)
def _(t: Tables) -> DataFrame:
    store = Store(t.spark, scratch(t.spark))
    found = t.orders.groupBy("o_orderstatus").count().collect()  # a row per status
    audit_append(store, "audit", "orders", "customer", [(r["o_orderstatus"], f"{r['count']} rows") for r in found], DAY)
    return store.read("audit").withColumn("date", F.col("date").cast("string"))


# ------------------------------------------------------------------ address verification

HEAD = (
    '<soap:Envelope xmlns:soap="http://www.w3.org/2003/05/soap-envelope" '
    'xmlns:av="urn:address-verification"><soap:Header/><soap:Body><av:Operation>'
)
TAIL = "</av:Operation></soap:Body></soap:Envelope>"


def address_lines(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").cast("string").alias("request_key"),
        F.concat(F.lit("A & <"), "c_name", F.lit(">")).alias("line1"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("line2"),
        F.lit("x").alias("line3"),
        typed_null().alias("line4"),
        typed_null().alias("line5"),
        F.col("c_nationkey").cast("string").alias("line6"),
    )


LINE_COLUMNS = [f"line{i}" for i in range(1, 7)]


@query(
    "verification_requests",
    f"""SELECT CAST(c_custkey AS VARCHAR) AS request_key,
               '{HEAD}<av:AddressLine1>' ||
               replace(replace(replace('A & <' || c_name || '>', '&', '&amp;'), '<', '&lt;'), '>', '&gt;') ||
               '</av:AddressLine1><av:AddressLine2>' || coalesce(nullif(c_mktsegment, 'BUILDING'), '') ||
               '</av:AddressLine2><av:AddressLine3>x</av:AddressLine3><av:AddressLine4></av:AddressLine4>' ||
               '<av:AddressLine5></av:AddressLine5><av:AddressLine6>' || CAST(c_nationkey AS VARCHAR) ||
               '</av:AddressLine6><av:SEQ_NUM>' || CAST(c_custkey AS VARCHAR) || '</av:SEQ_NUM>{TAIL}' AS payload
        FROM customer""",
)
def _(t: Tables) -> DataFrame:
    return verification_requests(address_lines(t), LINE_COLUMNS).select("request_key", "payload")


def responses(t: Tables) -> DataFrame:
    """Answers built from the customers: one in the service's own wording for each customer with money."""
    def tag(name: str, value) -> list:
        return [F.lit(f"<av:{name}>"), value, F.lit(f"</av:{name}>")]

    body = [
        *tag("UPRN", F.concat(F.lit("U"), F.col("c_custkey").cast("string"))),
        *tag("Match_Code", F.when(F.col("c_mktsegment") == "MACHINERY", "?").otherwise(F.lit("V4"))),
        *tag("AddressLine1", F.concat(F.lit("A &amp; "), "c_name")),
        *tag("PostCode", F.col("c_nationkey").cast("string")),
        *tag("SEQ_NUM", F.col("c_custkey").cast("string")),
    ]
    return t.customer.where("c_acctbal > 0").select(
        F.concat(F.lit(HEAD), *body, F.lit(TAIL)).alias("response")
    )


@query(
    "verification_results",
    """SELECT 'U' || CAST(c_custkey AS VARCHAR) AS uprn,
              CASE WHEN c_mktsegment = 'MACHINERY' THEN '?' ELSE 'V4' END AS match_code,
              CAST(NULL AS VARCHAR) AS mail_score, 'A & ' || c_name AS "addressLine1",
              CAST(c_nationkey AS VARCHAR) AS post_code, CAST(c_custkey AS VARCHAR) AS request_key
       FROM customer WHERE c_acctbal > 0""",
)
def _(t: Tables) -> DataFrame:
    return verification_results(responses(t), "response").select(
        "uprn", "match_code", "mail_score", "addressLine1", "post_code", "request_key"
    )


@query(
    "merge_verified",
    """SELECT CAST(c_custkey AS VARCHAR) AS request_key, c_name,
              CASE WHEN c_acctbal > 0 THEN 'U' || CAST(c_custkey AS VARCHAR) END AS verified_uprn,
              CASE WHEN c_acctbal > 0 AND c_mktsegment <> 'MACHINERY' THEN 'V4' END AS verified_match_code
       FROM customer""",
)
def _(t: Tables) -> DataFrame:
    addresses = t.customer.select(F.col("c_custkey").cast("string").alias("request_key"), "c_name")
    answers = verification_results(responses(t), "response")
    merged = merge_verified(addresses, answers.unionByName(answers))
    return merged.select("request_key", "c_name", "verified_uprn", "verified_match_code")


@query(
    "request_keys",
    """SELECT c_custkey, md5('{"c_name":"' || c_name || '","segment":"' || c_mktsegment || '"}') AS request_key
       FROM customer""",
)
def _(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey", request_key("c_name", F.col("c_mktsegment").alias("segment")).alias("request_key")
    )
