"""Whole flows composed of the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from verdigrid.functions.conditions import banded
from verdigrid.functions.text import word_counts
from verdigrid.plans.registry import Tables, query
from verdigrid.plans.scans import CUSTOMER, damaged_csv, _SOUND as _SOUND_CUSTOMERS
from verdigrid.shared import fresh_folder, written
from verdigrid.sources.quality import quarantine, read_permissive, CORRUPT
from verdigrid.sources.readers import inline_table, read_csv
from verdigrid.sources.writers import write_csv


@query(
    "pipe_banded_summary",
    """SELECT o_orderpriority,
              CASE WHEN o_totalprice > 350000 THEN 'bulk' WHEN o_totalprice > 220000 THEN 'large'
                   WHEN o_totalprice > 90000 THEN 'medium' ELSE 'small' END AS price_band,
              count(*) AS n, round(avg(o_totalprice), 4) AS mean_price
       FROM orders WHERE o_totalprice BETWEEN 20000 AND 480000
       GROUP BY 1, 2 ORDER BY 1, 2""",
)
def banded_summary(t: Tables):
    """Range filter, band, two-key aggregate, sort: one partial-aggregate shuffle."""
    limits = [(350000, "bulk"), (220000, "large"), (90000, "medium")]
    band = banded("o_totalprice", limits, "small")
    return (
        t.orders.filter(F.col("o_totalprice").between(20000, 480000))
        .withColumn("price_band", band)
        .groupBy("o_orderpriority", "price_band")
        .agg(F.count("*").alias("n"), F.round(F.avg("o_totalprice"), 4).alias("mean_price"))
        .orderBy("o_orderpriority", "price_band")
    )


_WORD_COUNT = """SELECT word, count(*) AS n
                 FROM (SELECT unnest(regexp_split_to_array(lower(text), '[ \\t\\n\\r\\f\\v]+')) AS word
                       FROM documents) WHERE length(word) > 2 GROUP BY word"""


@query("pipe_word_count", _WORD_COUNT)
def word_count(t: Tables):
    return word_counts(t.documents, "text").orderBy(F.desc("n"), "word")


@query(
    "pipe_vocab_totals",
    f"SELECT count(*) AS vocabulary, CAST(sum(n) AS BIGINT) AS tokens FROM ({_WORD_COUNT})",
)
def vocab_totals(t: Tables):
    return word_counts(t.documents, "text").agg(
        F.count("*").alias("vocabulary"), F.sum("n").alias("tokens")
    )


@query(
    "pipe_basics",
    """WITH f AS (SELECT * FROM customer WHERE c_mktsegment <> 'MACHINERY'
                    AND (c_acctbal < 7500 OR c_nationkey % 2 = 1))
       SELECT 'group' AS part, c_mktsegment AS label, count(c_custkey) AS n,
              round(avg(c_acctbal), 6) AS amount FROM f GROUP BY 2
       UNION ALL
       SELECT * FROM (SELECT 'top', reverse(c_name), 1, round(c_acctbal / 4, 4) FROM f
                      ORDER BY c_acctbal DESC, c_custkey LIMIT 5)
       UNION ALL
       SELECT 'sql', c_name, 1, c_acctbal FROM customer
       WHERE c_mktsegment = 'HOUSEHOLD' AND c_acctbal > 8000""",
)
def basics(t: Tables):
    """CSV in, filter, derive, group, top five, SQL, CSV out and in again."""
    source = fresh_folder(t.spark, "flow-in")
    write_csv(t.customer, source)
    people = read_csv(t.spark, source, CUSTOMER)
    chosen = (
        people.filter(F.col("c_mktsegment") != "MACHINERY")
        .filter((F.col("c_acctbal") < 7500) | (F.col("c_nationkey") % 2 == 1))
    )
    derived = (
        chosen.withColumn("backwards", F.reverse("c_name"))
        .withColumn("quarter", F.round(F.col("c_acctbal") / 4, 4))
        .withColumnRenamed("c_mktsegment", "segment")
    )
    grouped = derived.groupBy("segment").agg(
        F.count("c_custkey").alias("n"), F.round(F.avg("c_acctbal"), 6).alias("amount")
    )
    target = fresh_folder(t.spark, "flow-out")
    write_csv(grouped, target)
    stored = read_csv(t.spark, target, "segment string, n bigint, amount double")
    top = derived.orderBy(F.desc("c_acctbal"), "c_custkey").limit(5)
    by_sql = t.spark.sql(
        """SELECT 'sql' AS part, c_name AS label, 1L AS n, c_acctbal AS amount FROM {people}
           WHERE c_mktsegment = 'HOUSEHOLD' AND c_acctbal > 8000""",
        people=people,
    )
    return (
        stored.select(F.lit("group").alias("part"), F.col("segment").alias("label"), "n", "amount")
        .unionByName(
            top.select(
                F.lit("top").alias("part"),
                F.col("backwards").alias("label"),
                F.lit(1).cast("long").alias("n"),
                F.col("quarter").alias("amount"),
            )
        )
        .unionByName(by_sql)
    )


# Bands of account balances, from the floor of each.
_WORTH = [(8200, "ample"), (3700, "settled"), (-0.01, "thin")]
_BANDS = ("ample", "settled", "thin", "owing")


@query(
    "pipe_transforms",
    f"""WITH c AS ({_SOUND_CUSTOMERS}),
             d AS (SELECT c.*, CASE WHEN c_acctbal > 8200 THEN 'ample' WHEN c_acctbal > 3700 THEN 'settled'
                                    WHEN c_acctbal > -0.01 THEN 'thin' ELSE 'owing' END AS worth,
                          n_name, desk
                   FROM c LEFT JOIN (VALUES ('AUTOMOBILE', 'north'), ('HOUSEHOLD', 'south')) m(seg, desk)
                          ON c_mktsegment = seg JOIN nation ON c_nationkey = n_nationkey)
        SELECT 'no desk' AS part, c_mktsegment AS label, count(*) AS n, NULL::BIGINT AS ample,
               NULL::BIGINT AS owing FROM d WHERE desk IS NULL GROUP BY 2
        UNION ALL SELECT 'desk', unnest(string_split(desk || '+' || lower(n_name), '+')), n, NULL, NULL
                  FROM (SELECT desk, n_name, count(*) AS n FROM d WHERE desk IS NOT NULL GROUP BY 1, 2)
        UNION ALL SELECT 'worth', c_mktsegment, count(*), count(*) FILTER (WHERE worth = 'ample'),
                         count(*) FILTER (WHERE worth = 'owing') FROM d GROUP BY 2
        UNION ALL SELECT 'json', event_type, CAST(sum(CAST(props->>'k' AS INTEGER)) AS BIGINT), NULL, NULL
                  FROM events GROUP BY 2
        UNION ALL SELECT 'refused', 'rows', (SELECT count(*) FROM customer) - (SELECT count(*) FROM c), NULL, NULL""",
)
def transforms(t: Tables):
    """Bad rows set apart, then bands, joins, explode, pivot and JSON, put together by name."""
    rows = read_permissive(t.spark, damaged_csv(t), CUSTOMER, header=False)
    good, bad = quarantine(rows, F.col(CORRUPT).isNotNull(), "flow-quarantine")
    desks = inline_table(
        t.spark, [("AUTOMOBILE", "north"), ("HOUSEHOLD", "south")], "c_mktsegment string, desk string"
    )
    nation = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    people = (
        good.drop(CORRUPT)
        .withColumn("worth", banded("c_acctbal", _WORTH, "owing"))
        .join(F.broadcast(desks), "c_mktsegment", "left")
        .join(nation, "c_nationkey")
    )
    # One pass over the people; every part below works on these written counts.
    counts = written(
        people.groupBy("c_mktsegment", "desk", "n_name", "worth").agg(F.count("*").alias("c")), "flow-counts"
    )
    label = F.col("c_mktsegment").alias("label")
    without = counts.filter(F.col("desk").isNull()).groupBy(label).agg(F.sum("c").alias("n"))
    served = counts.filter(F.col("desk").isNotNull()).groupBy("desk", "n_name").agg(F.sum("c").alias("n"))
    names = F.split(F.concat_ws("+", "desk", F.lower("n_name")), r"\+")
    worth = counts.groupBy(label).pivot("worth", list(_BANDS)).agg(F.sum("c")).na.fill(0)
    everyone = reduce(lambda a, b: a + b, map(F.col, _BANDS))
    k = F.from_json("props", "k int")["k"]
    json = t.events.groupBy(F.col("event_type").alias("label")).agg(F.sum(k).alias("n"))
    refused = bad.agg(F.count("*").alias("n")).select(F.lit("rows").alias("label"), "n")

    result = worth.select(F.lit("worth").alias("part"), "label", everyone.alias("n"), "ample", "owing")
    others = (
        ("no desk", without),
        ("desk", served.select(F.explode(names).alias("label"), "n")),
        ("json", json),
        ("refused", refused),
    )
    for part, df in others:
        result = result.unionByName(
            df.select(F.lit(part).alias("part"), "label", "n"), allowMissingColumns=True
        )
    return result
