"""Arrays, maps, structs and JSON columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from verdigrid.operators.nested import flatten_structs
from verdigrid.plans.registry import Tables, query

# Words of the part name; an empty array for STANDARD parts, null for PROMO parts.
_WORDS = """SELECT p_partkey, CASE p_type WHEN 'STANDARD' THEN []::VARCHAR[] WHEN 'PROMO' THEN NULL
                                ELSE string_split(p_name, ' ') END AS words FROM part"""


def part_words(t: Tables):
    empty = F.array().cast("array<string>")
    words = (
        F.when(F.col("p_type") == "STANDARD", empty)
        .when(F.col("p_type") == "PROMO", F.lit(None))
        .otherwise(F.split("p_name", " "))
    )
    return t.part.select("p_partkey", words.alias("words"))


@query("explode_array", f"SELECT p_partkey, unnest(words) AS word FROM ({_WORDS})")
def explode_array(t: Tables):
    return part_words(t).withColumn("word", F.explode("words")).drop("words")


@query(
    "explode_outer",
    f"""SELECT p_partkey, unnest(CASE WHEN words IS NULL OR len(words) = 0 THEN [NULL]
                                      ELSE words END) AS word FROM ({_WORDS})""",
)
def explode_outer(t: Tables):
    return part_words(t).select("p_partkey", F.explode_outer("words").alias("word"))


@query(
    "posexplode_array",
    f"""SELECT p_partkey, CAST(unnest(range(len(words))) AS INTEGER) AS pos, unnest(words) AS word
        FROM ({_WORDS}) WHERE len(words) > 0""",
)
def posexplode_array(t: Tables):
    return part_words(t).select("p_partkey", F.posexplode("words").alias("pos", "word"))


@query(
    "posexplode_outer",
    f"""SELECT p_partkey, CAST(unnest(range(len(words))) AS INTEGER) AS pos, unnest(words) AS word
        FROM ({_WORDS}) WHERE len(words) > 0
        UNION ALL SELECT p_partkey, NULL, NULL FROM ({_WORDS}) WHERE words IS NULL OR len(words) = 0""",
)
def posexplode_outer(t: Tables):
    return part_words(t).select("p_partkey", F.posexplode_outer("words").alias("pos", "word"))


@query(
    "explode_map",
    """SELECT o_orderkey, 'price' AS measure, CAST(trunc(o_totalprice) AS INTEGER) AS amount FROM orders
       UNION ALL SELECT o_orderkey, 'customer', CAST(o_custkey AS INTEGER) FROM orders""",
)
def explode_map(t: Tables):
    measures = F.create_map(
        F.lit("price"), F.col("o_totalprice").cast("int"),
        F.lit("customer"), F.col("o_custkey").cast("int"),
    )
    return t.orders.withColumn("measures", measures).select(
        "o_orderkey", F.explode("measures").alias("measure", "amount")
    )


def nested_customers(t: Tables):
    """Customers as records with an address, scores and a list of tags."""
    return t.customer.select(
        F.col("c_custkey").alias("id"),
        F.struct(
            F.col("c_nationkey").alias("nation"),
            F.struct(F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("label")).alias("shop"),
        ).alias("address"),
        F.struct(F.col("c_acctbal").alias("balance")).alias("scores"),
        F.split("c_name", "#").alias("tags"),
    )


@query(
    "struct_access",
    "SELECT c_custkey AS id, c_nationkey AS nation, c_mktsegment AS segment FROM customer WHERE c_acctbal > 0",
)
def struct_access(t: Tables):
    return (
        nested_customers(t)
        .filter(F.col("scores.balance") > 0)
        .select("id", "address.nation", "address.shop.segment")
    )


@query(
    "struct_flatten",
    "SELECT c_custkey AS id, c_nationkey AS nation_key, c_acctbal AS balance FROM customer",
)
def struct_flatten(t: Tables):
    return nested_customers(t).select(
        "id", F.col("address.nation").alias("nation_key"), F.col("scores.balance").alias("balance")
    )


@query(
    "struct_flatten_deep",
    """SELECT c_custkey AS id, c_nationkey AS address_nation, c_mktsegment AS address_shop_segment,
              c_name AS address_shop_label, c_acctbal AS scores_balance FROM customer""",
)
def struct_flatten_deep(t: Tables):
    return flatten_structs(nested_customers(t).drop("tags"))


@query(
    "struct_array_flatten",
    """SELECT c_custkey AS id, c_mktsegment AS segment, unnest(string_split(c_name, '#')) AS tag
       FROM customer""",
)
def struct_array_flatten(t: Tables):
    return nested_customers(t).select(
        "id", F.col("address.shop.segment").alias("segment"), F.explode_outer("tags").alias("tag")
    )


@query(
    "tokenize_lines",
    """SELECT doc_id, count(*) AS tokens, CAST(sum(length(token)) AS BIGINT) AS characters
       FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS token FROM documents) GROUP BY doc_id""",
)
def tokenize_lines(t: Tables):
    tokens = t.documents.select("doc_id", F.explode(F.split("text", " ")).alias("token"))
    return tokens.groupBy("doc_id").agg(
        F.count("*").alias("tokens"), F.sum(F.length("token")).alias("characters")
    )


@query(
    "json_from_json",
    """SELECT event_id, event_type, CAST(props->>'k' AS INTEGER) AS k,
              CAST(props->>'missing' AS VARCHAR) AS missing FROM events""",
)
def json_from_json(t: Tables):
    parsed = F.from_json("props", "k int, missing string")
    return t.events.select("event_id", "event_type", parsed.alias("p")).select(
        "event_id", "event_type", "p.k", "p.missing"
    )
