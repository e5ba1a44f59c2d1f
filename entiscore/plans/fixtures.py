"""Inputs of the reference's jobs, derived from the supplied parquet tables.

Each derivation has a Spark form (used by the queries) and an SQL form (a
DuckDB CTE used by the oracle); both must describe the same rows.

* items       part ⋈ (lineitem rows per part); code = '12' + key
* behaviour   one text row per lineitem: entity = customer of the order,
              ``12<partkey>:<quantity>`` plus crafted malformed tokens
* labels      customers whose key is not a multiple of 3; label = balance ≥ 4500
* credit      customer + order count, total and mean; label = balance < 0
* scored      documents ⋈ labels; label = quality; score = n/(n+1000)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values the fixtures are built from.
CODE_PREFIX = "12"
TOP_K = 1000
LABEL_BALANCE = 4500.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The supplied table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --------------------------------------------------------------------------- items

def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``item_id, item_name, installs`` — every part, installs = its lineitem rows."""
    counts = (table(spark, sf_dir, "lineitem").groupBy("l_partkey")
              .agg(F.count(F.lit(1)).alias("installs")))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return (part.join(counts, part.p_partkey == counts.l_partkey, "left")
            .select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("item_name"),
                    F.coalesce(F.col("installs"), F.lit(0)).cast("long").alias("installs")))


ITEMS_SQL = """items AS (
  SELECT p.p_partkey AS item_id, p.p_name AS item_name,
         CAST(COALESCE(c.installs, 0) AS BIGINT) AS installs
  FROM part p LEFT JOIN (SELECT l_partkey, COUNT(*) AS installs FROM lineitem GROUP BY l_partkey) c
    ON p.p_partkey = c.l_partkey)"""


# ------------------------------------------------------------------------ behaviour

def behavior_text(spark: SparkSession, sf_dir: str, extra_bad_numbers: bool = False) -> DataFrame:
    """``entity_id, text`` — one behaviour row per lineitem.

    By line number: 1 → the pair, a double space and a code without value;
    2 → a trailing colon and a token with an empty code; 3 → a three-part token
    (the whole token is rejected); otherwise the plain pair.  With
    ``extra_bad_numbers`` every 7th line also carries a non-numeric value.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    code = F.concat(F.lit(CODE_PREFIX), F.col("l_partkey").cast("string"))
    base = F.concat(code, F.lit(":"), F.col("l_quantity").cast("string"))
    ln = F.col("l_linenumber").cast("string")
    variant = F.col("l_linenumber") % 5
    text = (F.when(variant == 1, F.concat(base, F.lit("  "), code, F.lit(":")))
            .when(variant == 2, F.concat(base, F.lit(": :"), ln))
            .when(variant == 3, F.concat(base, F.lit(":"), ln))
            .otherwise(base))
    if extra_bad_numbers:
        text = F.when(F.col("l_linenumber") % 7 == 0, F.concat(text, F.lit(" "), code, F.lit(":n/a"))).otherwise(text)
    joined = li.join(od, li.l_orderkey == od.o_orderkey)
    return joined.select(F.col("o_custkey").cast("string").alias("entity_id"), text.alias("text"))


def behavior_sql(extra_bad_numbers: bool = False) -> str:
    code = f"('{CODE_PREFIX}' || CAST(l.l_partkey AS VARCHAR))"
    base = f"({code} || ':' || CAST(l.l_quantity AS VARCHAR))"
    ln = "CAST(l.l_linenumber AS VARCHAR)"
    text = (f"CASE l.l_linenumber % 5 WHEN 1 THEN {base} || '  ' || {code} || ':' "
            f"WHEN 2 THEN {base} || ': :' || {ln} "
            f"WHEN 3 THEN {base} || ':' || {ln} ELSE {base} END")
    if extra_bad_numbers:
        text = f"CASE WHEN l.l_linenumber % 7 = 0 THEN ({text}) || ' ' || {code} || ':n/a' ELSE ({text}) END"
    return f"""behavior AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS entity_id, {text} AS text
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


# --------------------------------------------------------------------------- labels

def known_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``entity_id, label`` (1/0) for two thirds of the customers."""
    c = table(spark, sf_dir, "customer")
    return (c.where(F.col("c_custkey") % 3 != 0)
            .select(F.col("c_custkey").cast("string").alias("entity_id"),
                    F.when(F.col("c_acctbal") >= LABEL_BALANCE, 1).otherwise(0).alias("label")))


LABELS_SQL = f"""known AS (
  SELECT CAST(c_custkey AS VARCHAR) AS entity_id,
         CASE WHEN c_acctbal >= {LABEL_BALANCE} THEN 1 ELSE 0 END AS label
  FROM customer WHERE c_custkey % 3 <> 0)"""


def customer_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``entity_id, label`` (1/0) of every customer."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").cast("string").alias("entity_id"),
                    F.when(F.col("c_acctbal") >= LABEL_BALANCE, 1).otherwise(0).alias("label"))


CUSTOMERS_SQL = f"""known AS (
  SELECT CAST(c_custkey AS VARCHAR) AS entity_id,
         CASE WHEN c_acctbal >= {LABEL_BALANCE} THEN 1 ELSE 0 END AS label
  FROM customer)"""


# --------------------------------------------------------------------------- credit

def credit_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credit-like numeric table: one row per customer."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    o = (table(spark, sf_dir, "orders").groupBy("o_custkey")
         .agg(F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("total_price")))
    j = c.join(o, c.c_custkey == o.o_custkey, "left")
    n = F.coalesce(F.col("n_orders"), F.lit(0)).cast("long")
    total = F.coalesce(F.col("total_price"), F.lit(0.0))
    return j.select(
        F.col("c_custkey").alias("customer_id"),
        F.when(F.col("c_acctbal") < 0, 1).otherwise(0).alias("label"),
        F.col("c_nationkey").cast("double").alias("nation"),
        n.alias("n_orders"),
        total.alias("total_price"),
        F.when(n == 0, F.lit(0.0)).otherwise(total / n).alias("mean_price"),
    )


CREDIT_SQL = """credit AS (
  SELECT c.c_custkey AS customer_id,
         CASE WHEN c.c_acctbal < 0 THEN 1 ELSE 0 END AS label,
         CAST(c.c_nationkey AS DOUBLE) AS nation,
         CAST(COALESCE(o.n_orders, 0) AS BIGINT) AS n_orders,
         COALESCE(o.total_price, 0.0) AS total_price,
         CASE WHEN COALESCE(o.n_orders, 0) = 0 THEN 0.0 ELSE COALESCE(o.total_price, 0.0) / o.n_orders END AS mean_price
  FROM customer c LEFT JOIN (SELECT o_custkey, COUNT(*) AS n_orders, SUM(o_totalprice) AS total_price
                             FROM orders GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey)"""


# --------------------------------------------------------------------------- planted behaviour

#: The nations of label 1, and every how many-th of their customers behaves like label 0.
PLANTED_BELOW, PLANTED_WEAK = 10, 7


def planted_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part; the smaller its key, the more installs."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"), F.col("p_name").alias("item_name"),
        (F.lit(1_000_000_000) - F.col("p_partkey")).cast("long").alias("installs"))


def planted_behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One behaviour row a customer: part 1 for the strong customers of the first nations, part 2 for all others.

    Every ``PLANTED_WEAK``-th customer of those nations is weak: labelled 1, but with the behaviour of label 0.
    """
    strong = (F.col("c_nationkey") < PLANTED_BELOW) & (F.col("c_custkey") % PLANTED_WEAK != 0)
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("entity_id"),
        F.when(strong, F.lit(f"{CODE_PREFIX}1:3")).otherwise(F.lit(f"{CODE_PREFIX}2:1")).alias("text"))


def planted_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two thirds of the customers are known; label 1: the first nations."""
    return table(spark, sf_dir, "customer").where("c_custkey % 3 <> 0").select(
        F.col("c_custkey").cast("string").alias("entity_id"), (F.col("c_nationkey") < PLANTED_BELOW).cast("int").alias("label"))


PLANTED_CUSTOMERS_SQL = f"""planted AS (
  SELECT c_custkey AS id, c_nationkey < {PLANTED_BELOW} AS first, c_nationkey < {PLANTED_BELOW} AND c_custkey % {PLANTED_WEAK} <> 0 AS strong,
         c_custkey % 3 <> 0 AS known, c_custkey % 100 >= 80 AS held FROM customer)"""


# --------------------------------------------------------------------------- scored

def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, label, score`` — an uninformative score that tests arithmetic."""
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    n = F.col("n_chars").cast("double")
    return d.join(lab, "doc_id").select("doc_id", F.col("quality").alias("label"),
                                        (n / (n + F.lit(1000.0))).alias("score"))


SCORED_SQL = """scored AS (
  SELECT d.doc_id, l.quality AS label,
         CAST(d.n_chars AS DOUBLE) / (CAST(d.n_chars AS DOUBLE) + CAST(1000 AS DOUBLE)) AS score
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# --------------------------------------------------------------------------- stream

def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream: the given files, as they are."""
    from entiscore.streaming import stream_source
    root = sf_dir.rstrip("/")
    schema = table(spark, sf_dir, "events").schema
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/events.parquet")
    if where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).isDirectory():
        return stream_source(spark, f"{root}/events.parquet", schema)
    return stream_source(spark, root, schema, pathGlobFilter="events.parquet")


def event_bodies(events: DataFrame) -> DataFrame:
    """``event_id, value``: the body of each event as bytes, ``<type> u<user>``."""
    body = F.concat_ws(" ", F.col("event_type"), F.concat(F.lit("u"), F.col("user_id").cast("string")))
    return events.select("event_id", F.encode(body, "UTF-8").alias("value"))


EVENT_BODIES_SQL = """bodies AS (
  SELECT event_id, event_type || ' ' || 'u' || CAST(user_id AS VARCHAR) AS value FROM events)"""
