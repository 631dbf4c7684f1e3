"""Sources and malformed rows.

The tables exist as parquet only, so each query first lets Spark write a whole
table in the format under test to a fresh folder of the shared location.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdigrid.plans.registry import Tables, query
from verdigrid.shared import fresh_folder
from verdigrid.sources.quality import (
    CORRUPT,
    MALFORMED,
    admit,
    quarantine,
    read_drop_malformed,
    read_dropping,
    read_permissive,
    with_reason,
)
from verdigrid.sources.readers import (
    conform,
    inline_table,
    parse_delimited,
    read_csv,
    read_csv_inferred,
    read_format,
    read_json,
    read_lines,
    read_whole_files,
)
from verdigrid.sources.writers import number_files, write_csv, write_lines, write_numbered

CUSTOMER = (
    T.StructType()
    .add("c_custkey", T.LongType())
    .add("c_name", T.StringType())
    .add("c_nationkey", T.IntegerType())
    .add("c_acctbal", T.DoubleType())
    .add("c_mktsegment", T.StringType())
)


def customer_csv(t: Tables, **options) -> str:
    folder = fresh_folder(t.spark, "customer-csv")
    write_csv(t.customer, folder, **options)
    return folder


@query("src_csv_infer", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_infer(t: Tables):
    inferred = read_csv_inferred(t.spark, customer_csv(t))
    return inferred.withColumn("c_custkey", F.col("c_custkey").cast("long"))


@query("src_csv_schema", "SELECT * FROM customer")
def csv_schema(t: Tables):
    return read_csv(t.spark, customer_csv(t), CUSTOMER)


@query("src_format_generic", "SELECT * FROM customer")
def format_generic(t: Tables):
    return read_format(t.spark, "csv", customer_csv(t), CUSTOMER, header=True)


_KEEP_BLANKS = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
_DIALECT = {"sep": ";", "quote": "'", "escape": "\\", "encoding": "UTF-8", "multiLine": True}


@query(
    "src_csv_dialect",
    """SELECT doc_id, lang, length(text) AS characters, md5(text) AS digest FROM documents""",
)
def csv_dialect(t: Tables):
    """Texts with line breaks, quotes and separators, in files bounded by bytes."""
    folder = fresh_folder(t.spark, "documents-csv")
    rows = t.documents.select("doc_id", "lang", "text")
    # A quote inside a text takes one more byte; ids, language and separators some thirty.
    quotes = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("'"), F.lit("")))
    size = F.coalesce(F.octet_length("text") + quotes, F.lit(0)) + 40
    write_numbered(number_files(rows, size), folder, "csv", header=True, quoteAll=True, **_KEEP_BLANKS, **_DIALECT)
    back = read_csv(t.spark, folder, "doc_id bigint, lang string, text string", **_DIALECT)
    return back.select(
        "doc_id", "lang", F.length("text").cast("long").alias("characters"), F.md5("text").alias("digest")
    )


@query(
    "src_csv_tokens",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'null' WHEN c_mktsegment = 'BUILDING' THEN 'nan'
                              ELSE 'value' END AS state,
              CASE WHEN c_acctbal < 0 OR c_mktsegment = 'BUILDING' THEN 0 ELSE c_acctbal END AS balance,
              CASE WHEN c_mktsegment = 'FURNITURE' THEN 'was empty' ELSE c_mktsegment END AS segment
       FROM customer""",
)
def csv_tokens(t: Tables):
    balance = (
        F.when(F.col("c_acctbal") < 0, "NA")
        .when(F.col("c_mktsegment") == "BUILDING", "not-a-number")
        .otherwise(F.col("c_acctbal").cast("string"))
    )
    segment = F.when(F.col("c_mktsegment") == "FURNITURE", '""').otherwise(F.col("c_mktsegment"))
    lines = t.customer.select(F.concat_ws(",", F.col("c_custkey"), balance, segment).alias("line"))
    folder = fresh_folder(t.spark, "tokens")
    write_lines(lines, "line", folder)
    back = read_csv(
        t.spark, folder, "c_custkey bigint, b double, segment string",
        header=False, nullValue="NA", nanValue="not-a-number", emptyValue="was empty",
    )
    b = F.col("b")
    return back.select(
        "c_custkey",
        F.when(b.isNull(), "null").when(F.isnan(b), "nan").otherwise("value").alias("state"),
        F.when(b.isNull() | F.isnan(b), 0.0).otherwise(b).alias("balance"),
        "segment",
    )


@query(
    "src_csv_dates",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_orderdate + INTERVAL 90 MINUTE AS moment FROM orders",
)
def csv_dates(t: Tables):
    patterns = {"dateFormat": "dd/MM/yyyy", "timestampFormat": "yyyy.MM.dd HH-mm-ss"}
    moment = (F.col("o_orderdate") + F.expr("INTERVAL 90 MINUTES")).cast("timestamp")
    folder = fresh_folder(t.spark, "dates")
    rows = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"), moment.alias("moment"))
    write_csv(rows, folder, **patterns)
    back = read_csv(t.spark, folder, "o_orderkey bigint, day date, moment timestamp", **patterns)
    return back.withColumn("moment", F.col("moment").cast("timestamp_ntz"))


@query(
    "src_multi_path",
    """SELECT 'list' AS via, o_orderkey, o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'O')
       UNION ALL SELECT 'folder', o_orderkey, o_totalprice FROM orders
       UNION ALL SELECT 'glob', o_orderkey, o_totalprice FROM orders WHERE o_orderstatus IN ('O', 'P')""",
)
def multi_path(t: Tables):
    folder = fresh_folder(t.spark, "by-status")
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    rows.write.partitionBy("o_orderstatus").option("header", True).csv(folder)
    schema = "o_orderkey bigint, o_totalprice double"

    def via(label: str, paths, **options):
        found = read_csv(t.spark, paths, schema, **options)
        return found.select(F.lit(label).alias("via"), "o_orderkey", "o_totalprice")

    listed = via("list", [f"{folder}/o_orderstatus=F", f"{folder}/o_orderstatus=O"])
    whole = via("folder", folder, pathGlobFilter="*.csv")
    matched = via("glob", f"{folder}/o_orderstatus=[OP]")
    return listed.union(whole).union(matched)


_PERSON = "id bigint, address struct<nation:int, segment:string>, tags array<string>"


def _people(t: Tables):
    return t.customer.select(
        F.col("c_custkey").alias("id"),
        F.struct(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")).alias("address"),
        F.split("c_name", "#").alias("tags"),
    )


_PEOPLE_SQL = """SELECT c_custkey AS id, c_nationkey AS nation, c_mktsegment AS segment,
                        split_part(c_name, '#', 2) AS last_tag FROM customer"""


def _flat_people(df):
    return df.select(
        "id", "address.nation", "address.segment", F.element_at("tags", -1).alias("last_tag")
    )


@query("src_json_lines", _PEOPLE_SQL)
def json_lines(t: Tables):
    folder = fresh_folder(t.spark, "people-json")
    _people(t).write.json(folder)
    return _flat_people(read_json(t.spark, folder, _PERSON))


@query("src_json_multiline", _PEOPLE_SQL)
def json_multiline(t: Tables):
    """Files that each hold one pretty-printed array, bounded by bytes."""
    text = F.to_json(F.struct("id", "address", "tags"), {"pretty": "true"})
    people = number_files(_people(t).select(text.alias("text")), F.octet_length("text") + 2)
    # A list holds what one file may hold.
    lists = people.groupBy("file").agg(F.collect_list("text").alias("values"))
    arrays = lists.select(
        "file", F.concat(F.lit("[\n"), F.array_join("values", ",\n"), F.lit("\n]")).alias("text")
    )
    folder = fresh_folder(t.spark, "people-arrays")
    write_numbered(arrays, folder, "text")
    return _flat_people(read_json(t.spark, folder, _PERSON, multi_line=True))


@query("src_parquet", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def parquet(t: Tables):
    return t.supplier.select("s_suppkey", "s_name", "s_acctbal")


@query("src_orc", "SELECT p_partkey, p_name, p_size FROM part")
def orc(t: Tables):
    folder = fresh_folder(t.spark, "part-orc")
    t.part.write.orc(folder)
    return t.spark.read.schema(t.part.schema).orc(folder).select("p_partkey", "p_name", "p_size")


def _order_lines(t: Tables):
    return t.orders.select(
        F.concat_ws("|", F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_totalprice")).alias("line")
    )


_ORDER_LINES = "SELECT concat_ws('|', o_orderkey, o_orderstatus, o_totalprice) AS line FROM orders"


@query(
    "src_text_lines",
    "SELECT o_orderstatus AS status, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1",
)
def text_lines(t: Tables):
    folder = fresh_folder(t.spark, "order-lines")
    write_lines(_order_lines(t), "line", folder)
    fields = T.StructType.fromDDL("id bigint, status string, price double")
    rows = parse_delimited(read_lines(t.spark, folder), fields)
    return rows.groupBy("status").agg(
        F.count("*").alias("n"), F.round(F.sum("price"), 2).alias("total")
    )


@query(
    "src_whole_files",
    "SELECT o_orderstatus AS status, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1",
)
def whole_files(t: Tables):
    """Files bounded by bytes, each read as one row and cut into lines again."""
    folder = fresh_folder(t.spark, "order-files")
    write_numbered(number_files(_order_lines(t), F.octet_length("line") + 1), folder, "text")
    files = read_whole_files(t.spark, folder)
    lines = files.select(F.explode(F.split("content", "\n")).alias("line"))
    fields = T.StructType.fromDDL("id bigint, status string, price double")
    return parse_delimited(lines, fields).groupBy("status").agg(
        F.count("*").alias("n"), F.round(F.sum("price"), 2).alias("total")
    )


@query(
    "src_inline",
    """SELECT o_orderpriority, weight, count(*) AS n FROM orders
       JOIN (VALUES ('1-URGENT', 5), ('2-HIGH', 4), ('3-MEDIUM', 3)) w(o_orderpriority, weight)
       USING (o_orderpriority) GROUP BY 1, 2""",
)
def inline(t: Tables):
    """A literal table of three rows meets the counted orders."""
    weights = inline_table(
        t.spark, [("1-URGENT", 5), ("2-HIGH", 4), ("3-MEDIUM", 3)], "o_orderpriority string, weight int"
    )
    counts = t.orders.groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    return counts.join(F.broadcast(weights), "o_orderpriority").select("o_orderpriority", "weight", "n")


_LONG = 50_000


@query(
    "src_inline_long",
    f"""SELECT o_orderkey % 10 AS weight, count(*) AS n, round(sum(o_totalprice), 2) AS total
        FROM orders WHERE o_orderkey < {_LONG} GROUP BY 1""",
)
def inline_long(t: Tables):
    """A literal table of fifty thousand rows is written and joined like any other."""
    rows = [(k, k % 10) for k in range(_LONG)]
    weights = inline_table(t.spark, rows, "o_orderkey long, weight long")
    return t.orders.join(weights, "o_orderkey").groupBy("weight").agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query(
    "parse_delimited",
    """SELECT c_mktsegment AS segment, round(avg(c_acctbal), 6) AS mean, count(*) AS n
       FROM customer WHERE c_acctbal >= 0 AND c_nationkey <> 7 GROUP BY 1""",
)
def delimited(t: Tables):
    """Delimited lines to a typed table to a mean per group.

    Customers in debt become comment lines, those of nation 7 lose their fields.
    """
    line = F.concat_ws(
        "|", F.col("c_name"), F.col("c_nationkey"), F.col("c_acctbal"), F.col("c_mktsegment")
    )
    lines = t.customer.select(
        F.when(F.col("c_acctbal") < 0, F.concat(F.lit("# "), line))
        .when(F.col("c_nationkey") == 7, F.lit("BROKEN_LINE"))
        .otherwise(line)
        .alias("line")
    )
    folder = fresh_folder(t.spark, "delimited")
    write_lines(lines, "line", folder)
    schema = T.StructType.fromDDL("name string, nation int, balance double, segment string")
    people = conform(parse_delimited(read_lines(t.spark, folder), schema), schema)
    return people.groupBy("segment").agg(
        F.round(F.avg("balance"), 6).alias("mean"), F.count("*").alias("n")
    )


# How a customer's line is broken: cut after two fields, a word for a number, or
# six fields that are empty after the first.
_DAMAGE = """CASE WHEN c_acctbal < 0 AND c_mktsegment = 'MACHINERY' THEN 'short'
                  WHEN c_acctbal BETWEEN 0 AND 500 THEN 'word'
                  WHEN c_acctbal < 0 AND c_mktsegment = 'FURNITURE' THEN 'long' ELSE 'none' END"""


def _damaged_lines(t: Tables, *columns):
    sound = F.concat_ws(
        ",", F.col("c_custkey"), F.col("c_name"), F.col("c_nationkey"), F.col("c_acctbal"), F.col("c_mktsegment")
    )
    line = (
        F.when(F.col("damage") == "short", F.concat_ws(",", F.col("c_custkey"), F.col("c_name")))
        .when(
            F.col("damage") == "word",
            F.concat_ws(",", F.col("c_custkey"), F.col("c_name"), F.col("c_nationkey"),
                        F.lit("unknown"), F.col("c_mktsegment")),
        )
        .when(F.col("damage") == "long", F.concat(F.col("c_custkey"), F.lit(",,,,,")))
        .otherwise(sound)
    )
    return t.customer.withColumn("damage", F.expr(_DAMAGE)).select(*columns, line.alias("line"))


def damaged_csv(t: Tables) -> str:
    folder = fresh_folder(t.spark, "damaged")
    write_lines(_damaged_lines(t), "line", folder)
    return folder


_DAMAGED = f"(SELECT *, {_DAMAGE} AS damage FROM customer)"
_SOUND = f"""SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
             FROM {_DAMAGED} WHERE damage = 'none'"""


@query(
    "bad_csv_permissive",
    f"""SELECT c_custkey, damage <> 'none' AS is_bad,
               CASE WHEN damage <> 'long' THEN c_name END AS c_name,
               CASE WHEN damage IN ('none', 'word') THEN c_nationkey END AS c_nationkey,
               CASE WHEN damage = 'none' THEN c_acctbal END AS c_acctbal FROM {_DAMAGED}""",
)
def bad_csv_permissive(t: Tables):
    rows = read_permissive(t.spark, damaged_csv(t), CUSTOMER, header=False)
    return rows.select(
        "c_custkey", F.col(CORRUPT).isNotNull().alias("is_bad"), "c_name", "c_nationkey", "c_acctbal"
    )


@query(
    "bad_split_quarantine",
    f"SELECT CASE damage WHEN 'none' THEN 'good' ELSE 'bad' END AS side, c_custkey FROM {_DAMAGED}",
)
def bad_split_quarantine(t: Tables):
    rows = read_permissive(t.spark, damaged_csv(t), CUSTOMER, header=False)
    good, bad = quarantine(rows, F.col(CORRUPT).isNotNull(), "quarantine")
    return good.select(F.lit("good").alias("side"), "c_custkey").unionByName(
        bad.select(F.lit("bad").alias("side"), "c_custkey")
    )


@query("bad_csv_drop", _SOUND)
def bad_csv_drop(t: Tables):
    return read_drop_malformed(t.spark, damaged_csv(t), CUSTOMER, header=False)


@query("bad_csv_drop_count", f"SELECT count(*) AS n FROM ({_SOUND})")
def bad_csv_drop_count(t: Tables):
    """The number of sound rows, although no column is asked for."""
    return read_dropping(t.spark, damaged_csv(t), CUSTOMER, header=False).agg(F.count("*").alias("n"))


# Deliveries of damaged_csv's lines: customers by segment, those of two segments once
# more without damage.
_DELIVERIES = f"""(SELECT lower(c_mktsegment) AS delivery, damage, c_acctbal FROM {_DAMAGED}
                   UNION ALL SELECT 'again-' || lower(c_mktsegment), 'none', c_acctbal
                             FROM customer WHERE c_mktsegment IN ('MACHINERY', 'FURNITURE'))"""


@query(
    "bad_csv_failfast",
    f"""SELECT delivery, bool_or(damage <> 'none') AS refused,
               CASE WHEN bool_or(damage <> 'none') THEN '{MALFORMED}' END AS condition,
               CASE WHEN bool_or(damage <> 'none') THEN true END AS file_named,
               CASE WHEN NOT bool_or(damage <> 'none') THEN count(*) ELSE 0 END AS n,
               CASE WHEN NOT bool_or(damage <> 'none') THEN round(sum(c_acctbal), 2) ELSE 0 END AS balance
        FROM {_DELIVERIES} GROUP BY 1""",
)
def bad_csv_failfast(t: Tables):
    """A malformed record refuses its delivery, and the error is a row; sound ones pass."""
    folder = fresh_folder(t.spark, "deliveries")
    lines = _damaged_lines(t, F.lower("c_mktsegment").alias("part"))
    lines.write.partitionBy("part").text(folder)
    segments = ["automobile", "building", "furniture", "household", "machinery"]
    deliveries = {name: f"{folder}/part={name}" for name in segments}
    for name in ("machinery", "furniture"):
        deliveries[f"again-{name}"] = again = fresh_folder(t.spark, "sound-delivery")
        write_csv(t.customer.filter(F.lower("c_mktsegment") == name), again, header=False)
    verdicts, rows = admit(t.spark, deliveries, CUSTOMER, header=False)
    admitted = rows.groupBy("delivery").agg(
        F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance")
    )
    return verdicts.join(admitted, "delivery", "left").select(
        "delivery",
        "refused",
        F.substring_index("condition", ".", 1).alias("condition"),
        F.when(F.col("refused"), F.col("file").contains("part=")).alias("file_named"),
        F.coalesce("n", F.lit(0)).alias("n"),
        F.coalesce("balance", F.lit(0.0)).alias("balance"),
    )


@query(
    "bad_json_permissive",
    """SELECT CASE WHEN c_acctbal >= 0 THEN c_custkey END AS id, c_acctbal < 0 AS is_bad,
              CASE WHEN c_acctbal >= 0 AND c_mktsegment <> 'BUILDING' THEN c_name END AS name
       FROM customer""",
)
def bad_json_permissive(t: Tables):
    """Lines of customers in debt are cut in the middle; some names are null."""
    name = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name"))
    text = F.to_json(F.struct(F.col("c_custkey").alias("id"), name.alias("name")))
    cut = F.expr("substr(text, 1, length(text) - 3)")
    lines = t.customer.select(text.alias("text"), "c_acctbal").select(
        F.when(F.col("c_acctbal") < 0, cut).otherwise(F.col("text")).alias("line")
    )
    folder = fresh_folder(t.spark, "damaged-json")
    write_lines(lines, "line", folder)
    schema = T.StructType.fromDDL("id bigint, name string")
    rows = read_permissive(t.spark, folder, schema, fmt="json")
    is_bad = F.col(CORRUPT).isNotNull()
    return rows.select(
        F.when(~is_bad, F.col("id")).alias("id"),
        is_bad.alias("is_bad"),
        F.when(~is_bad, F.col("name")).alias("name"),
    )


@query(
    "validate_with_reason",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND o_totalprice > 400000 THEN 'field count'
                               WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'empty name'
                               WHEN o_totalprice < 50000 THEN 'bad number' END AS reason
       FROM orders""",
)
def validate_with_reason(t: Tables):
    priority = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "").otherwise(F.col("o_orderpriority"))
    price = F.when(F.col("o_totalprice") < 50000, "n/a").otherwise(F.col("o_totalprice").cast("string"))
    full = F.concat_ws(",", priority, price, F.col("o_orderkey"))
    short = F.concat_ws(",", priority, F.col("o_orderkey"))
    cut = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 400000)
    lines = t.orders.select("o_orderkey", F.when(cut, short).otherwise(full).alias("line"))
    parts = lines.withColumn("p", F.split("line", ",", -1))
    checked = with_reason(
        parts,
        [
            ("field count", F.size("p") != 3),
            ("empty name", F.trim(F.get("p", F.lit(0))) == ""),
            ("bad number", F.get("p", F.lit(1)).try_cast("double").isNull()),
        ],
    )
    return checked.select("o_orderkey", "reason")
