"""Queries of what is taken in step by step: streams, repeated writes, snapshots, skew, sizes and numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.operators import KEYS, VALUE_SETS, order_records, value_sets
from checks.registry import Tables, query, scratch
from custofold.operators import (
    Lookup,
    Snapshot,
    collect_subdocs,
    lookup_spread,
    read_bucketed,
    row_index,
    with_bucket,
)
from custofold.operators.match import KEY_BUCKET
from custofold.schemas import BATCH, KIND, Tags
from custofold.sources import Store, by_template, drift, read_variants, staged_records
from custofold.streaming import stage_new_files


@query(
    "stage_stream",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'insert' ELSE 'change' END AS kind FROM orders""",
)
def _(t: Tables) -> DataFrame:
    """Files staged through one checkpoint: what is there, nothing new, then what came later; every row once."""
    base = scratch(t.spark)
    store, path = Store(t.spark, f"{base}/tables"), f"{base}/landing"

    def arrive(which: str) -> None:
        order_records(t).where(which).write.mode("append").json(path)

    arrive("SRC_EVT_TYP_FLG = 'IN'")
    for _ in range(2):
        stage_new_files(store, path, f"{base}/progress", "stage", Tags())
    arrive("SRC_EVT_TYP_FLG <> 'IN'")
    stage_new_files(store, path, f"{base}/progress", "stage", Tags(), files_per_load=4)
    return staged_records(store, "stage").select(
        F.col("ACCOUNT_NO").cast("long").alias("o_orderkey"), F.col(KIND).alias("kind")
    )


@query(
    "replace_batch",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 1 ELSE 2 END AS batch FROM orders""",
)
def _(t: Tables) -> DataFrame:
    """Two batches of documents of which the first is written a second time, as after a run that died."""
    store = Store(t.spark, scratch(t.spark))
    docs = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") == "O", 1).otherwise(2).alias(BATCH))
    for batch in (1, 1, 2):
        store.replace(docs.where(F.col(BATCH) == batch), "documents", [BATCH])
    return store.read("documents").select("o_orderkey", F.col(BATCH).alias("batch"))


@query(
    "snapshot_batches",
    """WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority
                                                    ORDER BY o_orderdate DESC, o_orderkey) AS rk
                       FROM orders WHERE o_orderstatus <> 'O')
       SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus = 'O'
       UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM ranked WHERE rk = 1""",
)
def _(t: Tables) -> DataFrame:
    """Orders in three batches, one of them twice, give what all of them give at once."""
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    store = Store(t.spark, scratch(t.spark))
    kept = Snapshot(store, "latest", KEYS, ["o_orderdate"], 8, "o_orderstatus", "O", ["o_orderkey"])
    for part in (0, 1, 1, 2):
        kept.update(rows.where(F.col("o_orderkey") % 3 == part))
    return kept.read().drop("o_orderdate")


@query(
    "read_bucketed",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 5000)""",
)
def _(t: Tables) -> DataFrame:
    """``read_matching`` from a table in buckets of its key."""
    store = Store(t.spark, scratch(t.spark))
    store.append(with_bucket(t.orders, ["o_custkey"], 16).repartition(KEY_BUCKET), "orders", [KEY_BUCKET])
    keys = t.customer.where("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"))
    return read_bucketed(store.read("orders"), keys, ["o_custkey"], ["o_orderkey", "o_totalprice"], 16)


SKEWED = """CASE WHEN o_orderkey % 2 = 0 THEN '22' WHEN o_orderkey % 7 = 0 THEN NULL
            ELSE CAST(o_custkey % 30 AS VARCHAR) END"""


@query(
    "lookup_spread",
    f"""WITH {VALUE_SETS}, typed AS (
          SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'RD REGIONS' ELSE 'RD COUNTRY CODES' END AS set_name,
                 {SKEWED} AS code FROM orders)
        SELECT o_orderkey, set_name, code, a.lkp AS found, b.lkp AS country
        FROM typed LEFT JOIN vsl a ON a.value_set = set_name AND a.src = code AND a.action NOT IN ('STOP', 'BLOCK')
        LEFT JOIN vsl b ON b.value_set = 'RD COUNTRY CODES' AND b.src = code AND b.action NOT IN ('STOP', 'BLOCK')""",
)
def _(t: Tables) -> DataFrame:
    """Half of the rows have one code, some have none; the table counts as too large to broadcast."""
    key = F.col("o_orderkey")
    code = F.when(key % 2 == 0, "22").when(key % 7 != 0, (F.col("o_custkey") % 30).cast("string"))
    sets = F.when(key % 5 == 0, "RD REGIONS").otherwise("RD COUNTRY CODES")
    rows = t.orders.select("o_orderkey", sets.alias("set_name"), code.alias("code"))
    table = Lookup.of(value_sets(t), max_bytes=0)
    found = lookup_spread(rows, table, "code", "found", set_col="set_name")
    return lookup_spread(found, table, "code", "country", set_name="RD COUNTRY CODES")


@query(
    "collect_bytes",
    """WITH vals AS (SELECT DISTINCT o_custkey, o_clerk_like AS v, length(o_clerk_like) + 8 AS size FROM (
                       SELECT o_custkey, o_orderpriority || repeat('x', CAST(o_orderkey % 23 AS INT)) AS o_clerk_like FROM orders) q),
       sums AS (SELECT *, sum(size) OVER (PARTITION BY o_custkey) AS total, max(size) OVER (PARTITION BY o_custkey) AS largest,
                  coalesce(sum(size) OVER (PARTITION BY o_custkey ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
                FROM vals)
       SELECT o_custkey, CAST(CASE WHEN total <= 120 THEN 0 ELSE start // (120 - largest + 1) END AS INT) AS "DOC_PART",
              string_agg(v, '|' ORDER BY v) AS v
       FROM sums GROUP BY 1, 2""",
)
def _(t: Tables) -> DataFrame:
    """Values of a customer in parts of at most 120 bytes of JSON."""
    text = F.concat("o_orderpriority", F.repeat(F.lit("x"), (F.col("o_orderkey") % 23).cast("int")))
    rows = t.orders.select("o_custkey", text.alias("v"))
    return collect_subdocs(rows, ["o_custkey"], "v", "v", max_bytes=120).withColumn("v", F.array_join("v", "|"))


@query(
    "row_index",
    """SELECT l_orderkey, l_linenumber,
              row_number() OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) - 1 AS place FROM lineitem""",
)
def _(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    order = [F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber"]
    numbered = row_index(Store(t.spark, scratch(t.spark)), rows, order, "numbered", "place")
    return numbered.drop("l_extendedprice")


TEMPLATE = T.StructType(
    [
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_name", T.StringType()),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType()),
    ]
)


def variants(t: Tables) -> DataFrame:
    """Customers as JSON lines of uneven shape, read back without a schema."""
    key = F.col("c_custkey")
    segment = F.when(key % 4 == 0, F.to_json(F.struct("c_mktsegment"))).otherwise(F.to_json(F.array("c_mktsegment")))
    shapes = [
        F.to_json(F.struct("c_custkey", "c_name", "c_acctbal", "c_mktsegment")),
        F.to_json(F.struct(F.col("c_custkey").cast("string").alias("c_custkey"), F.col("c_nationkey").alias("c_name"), F.col("c_mktsegment").alias("c_phone"))),
        F.concat(F.lit('{"c_custkey":null,"c_mktsegment":'), segment, F.lit("}")),
    ]
    line = F.when(key % 10 == 9, F.concat(F.lit("{cut off "), "c_name"))
    for i, shape in enumerate(shapes):
        line = line.when(key % 3 == i, shape)
    path = scratch(t.spark)
    t.customer.select(line.alias("value")).write.text(path)
    return read_variants(t.spark, path)


@query(
    "template_columns",
    """SELECT CASE WHEN c_custkey % 3 < 2 THEN c_custkey END AS c_custkey,
              CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN CAST(c_nationkey AS VARCHAR) END AS c_name,
              CASE WHEN c_custkey % 3 = 0 THEN CAST(c_acctbal AS DOUBLE) END AS c_acctbal,
              CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment WHEN c_custkey % 3 = 2 AND c_custkey % 4 = 0
                   THEN '{"c_mktsegment":"' || c_mktsegment || '"}' WHEN c_custkey % 3 = 2 THEN '["' || c_mktsegment || '"]' END
                AS c_mktsegment
       FROM customer WHERE c_custkey % 10 <> 9""",
)
def _(t: Tables) -> DataFrame:
    return by_template(variants(t), TEMPLATE)


@query(
    "template_drift",
    """WITH used AS (SELECT * FROM customer WHERE c_custkey % 10 <> 9)
       SELECT 'c_custkey' AS "COLUMN", 'mistyped' AS "PROBLEM", 'STRING' AS "FOUND", count(*) AS "N" FROM used WHERE c_custkey % 3 = 1
       UNION ALL SELECT 'c_name', 'mistyped', 'BIGINT', count(*) FROM used WHERE c_custkey % 3 = 1
       UNION ALL SELECT 'c_phone', 'unknown', 'STRING', count(*) FROM used WHERE c_custkey % 3 = 1
       UNION ALL SELECT 'c_mktsegment', 'mistyped', 'OBJECT', count(*) FROM used WHERE c_custkey % 3 = 2 AND c_custkey % 4 = 0
       UNION ALL SELECT 'c_mktsegment', 'mistyped', 'ARRAY', count(*) FROM used WHERE c_custkey % 3 = 2 AND c_custkey % 4 <> 0
       UNION ALL SELECT NULL, 'malformed', 'NONE', count(*) FROM customer WHERE c_custkey % 10 = 9""",
)
def _(t: Tables) -> DataFrame:
    """Which columns of the records the template does not know or reads differently."""
    return drift(variants(t), TEMPLATE)
