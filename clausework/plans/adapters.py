"""The test tables as logical tables: a graph of customers, orders, parts and suppliers with planted faults, and clauses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import Ontology, SpecConfig
from ..session import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


ONTOLOGY = Ontology(
    entity_types=(("Entity", None), ("Party", "Entity"), ("Customer", "Party"), ("Supplier", "Party"), ("Part", "Entity"), ("Order", "Entity"), ("Place", "Entity"), ("Nation", "Place"), ("Region", "Place")),
    relation_types=(("PLACES", ("Customer",), ("Order",)), ("BASED_IN", ("Party",), ("Nation",)), ("PART_OF", ("Nation",), ("Region",)), ("SUPPLIES", ("Supplier",), ("Part",)), ("FILED", ("*",), ("Ledger",))),
    functional=("BASED_IN", "PLACES"),
    releases=("Y1992", "Y1993", "Y1994", "Y1995", "Y1996", "Y1997"),
)
CONFIG = SpecConfig("TS 38.331", "19.2.0", include_prefixes=("src1",), drop_prefixes=("src19", "src5."), actor_terms=("The Th", "über"), other_terms=("ing of",), vocab=(("Word", ("the", "and", "with", "und", "les", "una")), ("Name", ("Thand", "Verbe", "Enauau"))))

def _none():
    return F.lit(None).cast("string")


def _life(release):
    return [F.array(release).alias("observed_in"), release.alias("introduced_in"), _none().alias("valid_until")]


def entities(spark: SparkSession, d: str) -> DataFrame:
    """(ord, id, type, label, observed_in, introduced_in, valid_until, supersedes): every 101st customer is missing, every
    97th has an undeclared type, every 500th order supersedes one that is not there."""
    parts = []
    for k, (name, kind, key, label) in enumerate((("customer", "Customer", "c_custkey", "c_name"), ("supplier", "Supplier", "s_suppkey", "s_name"), ("part", "Part", "p_partkey", "p_name"), ("nation", "Nation", "n_nationkey", "n_name"), ("region", "Region", "r_regionkey", "r_name"))):
        rows = table(spark, d, name)
        kind_of = F.when(F.col(key) % 97 == 0, "Prospect").otherwise(kind) if kind == "Customer" else F.lit(kind)
        rows = rows.where(F.col(key) % 101 != 0) if kind == "Customer" else rows
        parts.append(rows.select((F.col(key).cast("long") * 8 + k).alias("ord"), F.concat(F.lit(f"kg:x/{name}/"), F.col(key)).alias("id"), kind_of.alias("type"), F.col(label).alias("label"), *_life(F.lit("Y1992")), _none().alias("supersedes")))
    year = F.concat(F.lit("Y"), F.year("o_orderdate"))
    gone = F.when(F.col("o_orderkey") % 500 == 0, F.concat(F.lit("kg:x/order/-"), F.col("o_orderkey")))
    orders = table(spark, d, "orders").select((F.col("o_orderkey") * 8 + 5).alias("ord"), F.concat(F.lit("kg:x/order/"), F.col("o_orderkey")).alias("id"), F.lit("Order").alias("type"), F.concat(F.lit("Order "), F.col("o_orderkey")).alias("label"), *_life(year), gone.alias("supersedes"))
    out = orders
    for p in parts:
        out = out.unionByName(p)
    return out


def relations(spark: SparkSession, d: str) -> DataFrame:
    """(ord, id, type, src, dst, lifecycle): every 89th order's edge is reversed, every 211th has an undeclared type, every
    1000th is filed in a ledger, which no entity is."""
    o = F.col("o_orderkey")
    at = lambda name, key: F.concat(F.lit(f"kg:x/{name}/"), F.col(key))
    orders = table(spark, d, "orders")
    c, r = at("customer", "o_custkey"), at("order", "o_orderkey")
    back = o % 89 == 0
    none = [F.array().cast("array<string>").alias("observed_in"), _none().alias("introduced_in"), _none().alias("valid_until"), _none().alias("supersedes")]
    kind = F.when(o % 211 == 0, "ORDERED").when(o % 1000 == 0, "FILED").otherwise("PLACES")
    dst = F.when(o % 1000 == 0, F.concat(F.lit("kg:x/ledger/"), o)).otherwise(F.when(back, c).otherwise(r))
    placed = orders.select((o * 8).alias("ord"), F.concat(F.lit("rel:o:"), o).alias("id"), kind.alias("type"), F.when(back, r).otherwise(c).alias("src"), dst.alias("dst"), *none)
    edges = [placed]
    for k, (name, key, nation) in enumerate((("customer", "c_custkey", "c_nationkey"), ("supplier", "s_suppkey", "s_nationkey"))):
        edges.append(table(spark, d, name).select((F.col(key) * 8 + 1 + k).alias("ord"), F.concat(F.lit(f"rel:{name[0]}:"), F.col(key)).alias("id"), F.lit("BASED_IN").alias("type"), at(name, key).alias("src"), at("nation", nation).alias("dst"), *none))
    edges.append(table(spark, d, "nation").select((F.col("n_nationkey").cast("long") * 8 + 3).alias("ord"), F.concat(F.lit("rel:n:"), F.col("n_nationkey")).alias("id"), F.lit("PART_OF").alias("type"), at("nation", "n_nationkey").alias("src"), at("region", "n_regionkey").alias("dst"), *none))
    out = edges[0]
    for e in edges[1:]:
        out = out.unionByName(e)
    return out


#: The same two tables in SQL.
GRAPH_SQL = """
entities AS (
  SELECT c_custkey * 8 AS ord, 'kg:x/customer/' || c_custkey AS id, CASE WHEN c_custkey % 97 = 0 THEN 'Prospect' ELSE 'Customer' END AS type, c_name AS label, 'Y1992' AS observed, NULL AS supersedes FROM customer WHERE c_custkey % 101 <> 0
  UNION ALL SELECT s_suppkey * 8 + 1, 'kg:x/supplier/' || s_suppkey, 'Supplier', s_name, 'Y1992', NULL FROM supplier
  UNION ALL SELECT p_partkey * 8 + 2, 'kg:x/part/' || p_partkey, 'Part', p_name, 'Y1992', NULL FROM part
  UNION ALL SELECT n_nationkey::BIGINT * 8 + 3, 'kg:x/nation/' || n_nationkey, 'Nation', n_name, 'Y1992', NULL FROM nation
  UNION ALL SELECT r_regionkey::BIGINT * 8 + 4, 'kg:x/region/' || r_regionkey, 'Region', r_name, 'Y1992', NULL FROM region
  UNION ALL SELECT o_orderkey * 8 + 5, 'kg:x/order/' || o_orderkey, 'Order', 'Order ' || o_orderkey, 'Y' || year(o_orderdate), CASE WHEN o_orderkey % 500 = 0 THEN 'kg:x/order/-' || o_orderkey END FROM orders
), relations AS (
  SELECT o_orderkey * 8 AS ord, 'rel:o:' || o_orderkey AS id, CASE WHEN o_orderkey % 211 = 0 THEN 'ORDERED' WHEN o_orderkey % 1000 = 0 THEN 'FILED' ELSE 'PLACES' END AS type,
         CASE WHEN o_orderkey % 89 = 0 THEN 'kg:x/order/' || o_orderkey ELSE 'kg:x/customer/' || o_custkey END AS src,
         CASE WHEN o_orderkey % 1000 = 0 THEN 'kg:x/ledger/' || o_orderkey WHEN o_orderkey % 89 = 0 THEN 'kg:x/customer/' || o_custkey ELSE 'kg:x/order/' || o_orderkey END AS dst FROM orders
  UNION ALL SELECT c_custkey * 8 + 1, 'rel:c:' || c_custkey, 'BASED_IN', 'kg:x/customer/' || c_custkey, 'kg:x/nation/' || c_nationkey FROM customer
  UNION ALL SELECT s_suppkey * 8 + 2, 'rel:s:' || s_suppkey, 'BASED_IN', 'kg:x/supplier/' || s_suppkey, 'kg:x/nation/' || s_nationkey FROM supplier
  UNION ALL SELECT n_nationkey::BIGINT * 8 + 3, 'rel:n:' || n_nationkey, 'PART_OF', 'kg:x/nation/' || n_nationkey, 'kg:x/region/' || n_regionkey FROM nation
), types(type) AS (VALUES ('Entity'), ('Party'), ('Customer'), ('Supplier'), ('Part'), ('Order'), ('Place'), ('Nation'), ('Region')),
rels(rel, allowed_src, allowed_dst) AS (VALUES
  ('PLACES', ['Customer'], ['Order']), ('BASED_IN', ['Party', 'Customer', 'Supplier'], ['Nation']), ('PART_OF', ['Nation'], ['Region']), ('SUPPLIES', ['Supplier'], ['Part']), ('FILED', NULL, []::VARCHAR[])
), typed AS (
  SELECT r.*, s.type AS src_type, d.type AS dst_type, s.id AS src_id, d.id AS dst_id, k.rel,
         s.type IS NOT NULL AND (k.allowed_src IS NULL OR list_contains(k.allowed_src, s.type)) AS src_ok, d.type IS NOT NULL AND list_contains(k.allowed_dst, d.type) AS dst_ok,
         d.type IS NOT NULL AND (k.allowed_src IS NULL OR list_contains(k.allowed_src, d.type)) AS src_swapped, s.type IS NOT NULL AND list_contains(k.allowed_dst, s.type) AS dst_swapped
  FROM relations r LEFT JOIN entities s ON s.id = r.src LEFT JOIN entities d ON d.id = r.dst LEFT JOIN rels k ON k.rel = r.type
), found AS (
  SELECT 'entity-undeclared-type' AS cat, id, ord, NULL AS ref, type AS got FROM entities WHERE type NOT IN (SELECT type FROM types)
  UNION ALL SELECT 'relation-undeclared-type', id, ord, NULL, type FROM typed WHERE rel IS NULL
  UNION ALL SELECT 'dangling-from', id, ord, src, NULL FROM typed WHERE rel IS NOT NULL AND src_id IS NULL
  UNION ALL SELECT 'dangling-to', id, ord, dst, NULL FROM typed WHERE rel IS NOT NULL AND dst_id IS NULL
  UNION ALL SELECT 'domain-violation', id, ord, src, src_type FROM typed WHERE rel IS NOT NULL AND src_type IS NOT NULL AND NOT src_ok
  UNION ALL SELECT 'range-violation', id, ord, dst, dst_type FROM typed WHERE rel IS NOT NULL AND dst_type IS NOT NULL AND NOT dst_ok
  UNION ALL SELECT 'lifecycle-release', id, ord, NULL, observed FROM entities WHERE observed NOT IN ('Y1992', 'Y1993', 'Y1994', 'Y1995', 'Y1996', 'Y1997')
  UNION ALL SELECT 'lifecycle-field', id, ord, NULL, observed FROM entities WHERE observed NOT IN ('Y1992', 'Y1993', 'Y1994', 'Y1995', 'Y1996', 'Y1997')
  UNION ALL SELECT 'lifecycle-supersedes', id, ord, NULL, supersedes FROM entities WHERE supersedes IS NOT NULL AND supersedes NOT IN (SELECT id FROM entities)
)"""


def clauses(spark: SparkSession, d: str) -> DataFrame:
    """Documents as clauses: key source.doc_id, title of the first line, parent a lower doc_id of the same source or none."""
    docs = table(spark, d, "documents")
    n = F.col("doc_id")
    key = F.concat("source", F.lit("."), n)
    parent = F.when(n % 4 == 0, F.lit(None).cast("string")).otherwise(F.concat("source", F.lit("."), F.floor(n / 4).cast("long")))
    cut = F.instr("text", "\n")
    title = F.when(cut > 0, F.substring("text", F.lit(1), cut - 1)).otherwise(F.col("text"))
    return docs.select(F.lit("docs").alias("doc_id"), n.cast("int").alias("ord"), key.alias("key"), F.lit(None).cast("string").alias("number"), title.alias("title"), (n % 6).cast("int").alias("level"), parent.alias("parent"), "text", F.lit(0).alias("tables"))


def blocks(spark: SparkSession, d: str) -> DataFrame:
    """Documents' lines as blocks: line 0 opens nothing, every third after it is a heading, half of them numbered, and
    lines of more than 400 characters are tables."""
    lines = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), F.posexplode(F.split("text", "\n")).alias("ord", "line"))
    head = (F.col("ord") % 3 == 2) & (F.col("line") != "")
    text = F.when(head & (F.col("ord") % 2 == 0), F.concat(F.floor(F.col("ord") / 3), F.lit("."), F.col("ord"), F.lit("\t"), "line")).otherwise(F.col("line"))
    kind = F.when(~head & (F.length("line") > 400), "t").otherwise("p")
    return lines.select("doc_id", "ord", kind.alias("kind"), F.when(head, "Heading 2").when(F.col("ord") % 3 == 1, "B2").otherwise("Normal").alias("style"), F.when(head, 2).alias("level"), text.alias("text"))
