"""Personal data in texts: fixed patterns, and identifiers learnt from their contexts.

Everything is DataFrame and SQL functions. One pass over the texts finds

* base spans: e-mail and IP addresses, card and phone numbers by fixed patterns and
  checks. Between two matches stands what ``split`` returns, so the positions of a
  kind's matches are running sums of lengths;
* identifier-shaped tokens outside base spans: seven digits or more, or an ``@``
  between word characters.

Each is seen in contexts: the two words before it, and the word on either side. The
seeds are base spans; a pattern is a context with a kind. Rounds over the graph of
patterns and instances: a pattern's confidence is the share of its distinct instances
that are believed to be of its kind, and only patterns with ``SUPPORT`` believed
instances count; an instance is believed to be of the kind of its most confident
pattern if that reaches ``CONFIDENCE``. Believed instances support further patterns in
the next round. At the end every place where a believed instance stands in a confident
pattern is a span of that kind.

The texts' rows meet the discovered spans by two hashes of the text, so equal texts
get equal spans. Null text counts as empty and has no spans; ids may be null or
repeat; every row gives one row, with its own columns read by name only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdigrid.shared import written

KINDS = ("email", "ip", "card", "phone")
#: Fixed patterns. Possessive, so that a match costs no stack and no second attempt:
#: in none of them can a shorter inner repetition lead to a match.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be tried.
NEEDS = {"email": "@", "ip": None, "card": None, "phone": "+"}
CONFIDENCE = 0.8
SUPPORT = 5
ROUNDS = 3
#: Characters of the surroundings that contexts are taken from.
REACH = 80

_TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
_BYTE_PART = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
_SPANS = "array<struct<kind:int,first:int,last:int,value:string>>"


def _running(sizes: Column) -> Column:
    """Sums of all earlier elements, in about n * sqrt(n) steps."""
    step = F.ceil(F.sqrt(F.size(sizes))).cast("int")
    parts = F.transform(F.sequence(F.lit(0), step - 1), lambda k: F.slice(sizes, k * step + 1, step))

    def ahead(values: Column, start: Column) -> Column:
        empty = F.struct(start.alias("at"), F.array().cast("array<int>").alias("seen"))
        return F.aggregate(
            values,
            empty,
            lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["seen"], F.array(a["at"])).alias("seen")),
            lambda a: a["seen"],
        )

    totals = F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda a, x: a + x))
    sums = F.flatten(F.zip_with(parts, ahead(totals, F.lit(0)), ahead))
    return F.when(F.size(sizes) > 0, sums).otherwise(F.array().cast("array<int>"))


def _located(df: DataFrame, pattern: str, when: Column, name: str) -> DataFrame:
    """Adds ``name``: first, last (end exclusive) and text of every match, in code points."""
    none = F.array().cast("array<string>")
    hits, gaps, at = (f"_{name}_{x}" for x in ("hits", "gaps", "at"))
    df = df.withColumn(hits, F.when(when, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none))
    df = df.withColumn(gaps, F.when(F.size(hits) > 0, F.split("text", pattern, -1)).otherwise(none))
    sizes = F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, h: F.struct(F.length(g).alias("g"), F.length(h).alias("h")))
    df = df.withColumn(at, _running(F.transform(sizes, lambda s: s["g"] + s["h"])))
    spans = F.transform(
        F.arrays_zip(F.col(at).alias("at"), F.slice(gaps, 1, F.size(hits)).alias("gap"), F.col(hits).alias("value")),
        lambda s: F.struct(
            (s["at"] + F.length(s["gap"])).alias("first"),
            (s["at"] + F.length(s["gap"]) + F.length(s["value"])).alias("last"),
            s["value"].alias("value"),
        ),
    )
    return df.withColumn(name, spans).drop(hits, gaps, at)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """True if the digits pass the check sum of card numbers."""
    figures = F.transform(F.split(F.reverse(digits), ""), lambda d: d.try_cast("int"))
    doubled = F.transform(
        figures, lambda d, k: F.when(k % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)
    )
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def _sound(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{_BYTE_PART}(?:\.{_BYTE_PART}){{3}}$")
    if kind == "card":
        digits = _digits(value)
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def _of_kind(number: int, kind: str) -> Column:
    """The sound spans in the column ``kind``, with the kind's number."""
    named = lambda s: F.struct(
        F.lit(number).alias("kind"), s["first"].alias("first"), s["last"].alias("last"), s["value"].alias("value")
    )
    return F.transform(F.filter(kind, lambda s: _sound(kind, s["value"])), named).cast(_SPANS)


def _marked(docs: DataFrame) -> DataFrame:
    """doc_id, text, text hashes, ``base`` spans and identifier-shaped ``tokens``."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    df = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        text.alias("text"),
        F.xxhash64(text).alias("h1"),
        F.xxhash64(text, F.lit(1)).alias("h2"),
    ).withColumn("digit", F.col("text").rlike("[0-9]"))
    for k, kind in enumerate(KINDS):
        need = NEEDS[kind]
        when = F.contains("text", F.lit(need)) if need else F.col("digit")
        df = _located(df, PATTERNS[kind], when, kind)
        df = df.withColumn(kind, _of_kind(k, kind))
    df = df.withColumn("base", F.concat(*KINDS)).drop(*KINDS)
    df = _located(df, _TOKEN, F.col("digit") | F.contains("text", F.lit("@")), "tokens")
    return df.drop("digit")


def _candidates(df: DataFrame) -> DataFrame:
    """Replaces ``tokens`` by trimmed, identifier-shaped ones that touch no base span."""
    lead = lambda v: F.length(F.regexp_extract(v, r"^[^\p{L}\p{N}]*", 0))
    trail = lambda v: F.length(F.regexp_extract(v, r"[^\p{L}\p{N}]*$", 0))
    trimmed = F.transform(
        "tokens",
        lambda s: F.struct(
            F.lit(-1).alias("kind"),
            (s["first"] + lead(s["value"])).alias("first"),
            (s["last"] - trail(s["value"])).alias("last"),
            F.regexp_replace(s["value"], r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "").alias("value"),
        ),
    ).cast(_SPANS)
    shaped = F.filter(
        trimmed,
        lambda s: (F.length(_digits(s["value"])) >= 7) | s["value"].rlike(r"[\p{L}\p{N}]@[\p{L}\p{N}]"),
    )
    free = F.filter(
        shaped,
        lambda s: ~F.exists("base", lambda b: (b["first"] < s["last"]) & (s["first"] < b["last"])),
    )
    return df.withColumn("tokens", free)


def _contexts(df: DataFrame) -> DataFrame:
    """Replaces spans of ``base`` and ``tokens`` by the same with their contexts, as ``seen``."""
    plain = lambda s: F.regexp_replace(F.lower(s), "[0-9]", "0")

    def seen(s: Column) -> Column:
        begin = F.greatest(s["first"] - REACH, F.lit(0))
        before = plain(F.substring(F.col("text"), begin + 1, s["first"] - begin))
        after = plain(F.substring(F.col("text"), s["last"] + 1, F.lit(REACH)))
        one = F.regexp_extract(before, r"(\S*)\s*$", 1)
        two = F.regexp_extract(before, r"(?:^|\s)(\S+\s+\S*)\s*$", 1)
        following = F.regexp_extract(after, r"^\s*(\S*)", 1)
        return F.struct(
            s["kind"].alias("kind"), s["first"].alias("first"), s["last"].alias("last"),
            F.xxhash64(F.lower(s["value"])).alias("instance"),
            F.filter(
                F.array(
                    F.when(two != "", F.xxhash64(F.lit("before"), F.regexp_replace(two, r"\s+", " "))),
                    F.when((one != "") & (following != ""), F.xxhash64(F.lit("around"), one, following)),
                ),
                lambda c: c.isNotNull(),
            ).alias("contexts"),
        )

    return df.withColumn("seen", F.transform(F.concat("base", "tokens"), seen))


def _found(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` without its text: base spans and all places seen."""
    slim = F.transform("base", lambda b: F.struct(b["kind"].alias("kind"), b["first"].alias("first"), b["last"].alias("last")))
    marked = _contexts(_candidates(_marked(docs)))
    return written(marked.select("doc_id", "h1", "h2", slim.alias("base"), "seen"), "personal")


def _discovered(found: DataFrame, confidence: float, support: int, rounds: int) -> DataFrame:
    """h1, h2, kind, first, last of the spans that confident patterns discover."""
    places = written(
        found.where(F.size("seen") > 0)
        .select("h1", "h2", F.explode("seen").alias("s"))
        .select("h1", "h2", "s.kind", "s.first", "s.last", "s.instance", F.explode("s.contexts").alias("context"))
        .distinct(),
        "places",
    )
    edges = places.select("context", "instance").distinct()
    believed = written(places.where("kind >= 0").select("instance", "kind").distinct(), "believed")
    size = edges.groupBy("context").agg(F.count("*").alias("size"))
    patterns = None
    for _ in range(rounds):
        patterns = written(
            edges.join(believed, "instance")
            .groupBy("context", "kind")
            .agg(F.count("*").alias("support"))
            .where(F.col("support") >= support)
            .join(size, "context")
            .withColumn("confidence", F.col("support") / F.col("size"))
            .where(F.col("confidence") >= confidence)
            .select("context", "kind", "confidence"),
            "patterns",
        )
        # The most confident kind of an instance that is not yet believed to be of any.
        order = F.struct("confidence", -F.col("kind"))
        fresh = written(
            edges.join(patterns, "context")
            .join(believed.select("instance").distinct(), "instance", "left_anti")
            .groupBy("instance")
            .agg(F.max(order).alias("best"))
            .select("instance", (-F.col("best")["col2"]).alias("kind")),
            "believed",
        )
        if fresh.isEmpty():
            break
        believed = believed.unionByName(fresh)
    return (
        places.where("kind < 0")
        .drop("kind")
        .join(patterns, "context")
        .join(believed, ["instance", "kind"], "left_semi")
        .select("h1", "h2", "kind", "first", "last")
        .distinct()
    )


def find_personal(
    docs: DataFrame, confidence: float = CONFIDENCE, support: int = SUPPORT, rounds: int = ROUNDS
) -> DataFrame:
    """doc_id, counts and digest of base spans, all spans, number of discovered ones."""
    found = _found(docs)
    extra = (
        _discovered(found, confidence, support, rounds)
        .groupBy("h1", "h2")
        .agg(F.collect_list(F.struct("kind", "first", "last")).alias("extra"))
    )
    extra = written(extra, "discovered")
    names = F.array(*map(F.lit, KINDS))
    label = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["first"], s["last"])
    line = lambda spans: F.array_join(F.transform(F.array_sort(spans), label), ",")
    none = F.array().cast("array<struct<kind:int,first:int,last:int>>")
    number = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    counts = [number(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return (
        found.select("doc_id", "h1", "h2", "base")
        .join(extra, ["h1", "h2"], "left")
        .withColumn("extra", F.coalesce("extra", none))
        .select(
            "doc_id",
            *counts,
            F.sha2(line(F.col("base")), 256).alias("base_sha256"),
            line(F.concat("base", "extra")).alias("spans"),
            F.size("extra").cast("long").alias("n_discovered"),
        )
    )
