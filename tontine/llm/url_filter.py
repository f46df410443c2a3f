"""URL filters: list rules first, then association rules mined by FP-growth.

List rules name a host and a path; a rule fits its host and all subdomains where the path starts
with the rule's, and the longest rule wins. What they decide labels the urls that the mining
learns from (or give ``labels``). Urls become sets of tokens: host labels, path segments (digits
written as one 0) and query keys. FP-growth finds the frequent combinations of tokens and class;
rules with too little confidence or support are pruned. The rest match by an inverted index:
each rule hangs on its rarest item, a url's items look up only those, and a hit is checked on
the whole combination. Among matching rules the most confident wins, then the best supported,
then allow; no match is allow.

Mining reads every labelled url, so supports and confidences are those of the corpus. Two exact
steps keep a long url from having 2^n frequent combinations: tokens that the same urls hold count
as one item, and a token whose urls all have one verdict is not combined with others, since its own
rule beats every rule that it stands in. What remains to be combined are the items of a url that are
found under both verdicts. The items are bounded by the tokens of a url divided by the support.

Defined results: null urls, or without ``://``: host and path empty, no tokens, allow; repeated
rows each get their row; no labels: no mined rules.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tontine.llm.common import materialize

RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))
MIN_SUPPORT, MIN_CONFIDENCE = 0.005, 0.9
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def match_list(host: Column, path: Column, rules=RULES) -> Column:
    """The longest list rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):  # longer ones are asked first: outermost
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """Sorted distinct tokens of a url."""
    def tagged(tag: str, parts: Column) -> Column:
        return F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(tag), x))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda x: F.regexp_extract(x, "^([^=]*)", 1))
    return F.array_sort(F.array_distinct(F.concat(
        tagged("h:", F.split(host, r"\.")), tagged("p:", F.split(F.regexp_replace(path, r"[0-9]+", "0"), "/")), tagged("q:", keys))))


def label_counts(labelled: DataFrame) -> DataFrame:
    """``(tokens, verdict)`` rows -> the distinct ones that have tokens, with their count ``c``."""
    return materialize(labelled.where(F.size("tokens") > 0).groupBy("tokens", "verdict").agg(F.count(F.lit(1)).alias("c")), "labels")


def least_count(counts: DataFrame, min_support: float) -> tuple[int, int]:
    """(labelled urls, the fewest of them that a rule must hold for)."""
    n = counts.agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    return n, math.ceil(min_support * n)


def token_items(counts: DataFrame, least: int) -> DataFrame:
    """``(token, item, pure)`` of the tokens in at least ``least`` labelled urls.

    Tokens that the same urls hold are one item, named by the smallest of them: any of them makes a
    rule of the same confidence and support. An item is pure if its urls have one verdict. The
    table is bounded by the tokens of a url divided by the support."""
    held = counts.select("c", "verdict", F.explode("tokens").alias("token"), F.xxhash64("tokens", "verdict").alias("x"), F.xxhash64("verdict", "tokens").alias("y"))
    t = held.groupBy("token").agg(F.sum("c").alias("freq"), (F.min("verdict") == F.max("verdict")).alias("pure"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    t = materialize(t.where(F.col("freq") >= least), "tokens")
    names = t.groupBy("freq", "x", "y").agg(F.min("token").alias("item"))
    return materialize(t.join(names, ["freq", "x", "y"]).select("token", "item", "pure"), "items")


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``(tokens array, verdict)`` -> rules ``(antecedent, verdict, confidence, support, key)`` over items."""
    counts = label_counts(labelled)
    n, least = least_count(counts, min_support)
    return mine_items(counts, token_items(counts, least), n, least, min_confidence)


def mine_items(counts: DataFrame, items: DataFrame, n: int, least: int, min_confidence: float) -> DataFrame:
    """FP-growth over the labelled urls' items. No combination with a pure item beats the rule of the item
    alone (its confidence is 1 and its support the larger), so a pure item stands in a transaction of
    its own, and only items found with both verdicts are combined."""
    spark = counts.sparkSession
    schema = "antecedent array<string>, verdict string, confidence double, support double, key string"
    if not n:
        return spark.createDataFrame([], schema)
    found = counts.withColumn("url", F.monotonically_increasing_id()).select("url", "verdict", "c", F.explode("tokens").alias("token")).join(items, "token")
    kind = F.array(F.concat(F.lit("class:"), "verdict"))
    alone = found.where("pure").select("url", "verdict", "c", "item").distinct().select(F.concat(F.array("item"), kind).alias("items"), "c")
    mixed = found.where("not pure").groupBy("url", "verdict", "c").agg(F.collect_set("item").alias("set")).select(F.concat("set", kind).alias("items"), "c")
    rows = materialize(alone.unionByName(mixed).select("items", F.explode(F.sequence(F.lit(1).cast("long"), "c"))).select("items"), "transactions")
    total = rows.count()
    if not total:
        return spark.createDataFrame([], schema)
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / total, minConfidence=min_confidence).fit(rows)
    single = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("t"), "freq")
    rules = (model.associationRules.where(F.col("consequent")[0].startswith("class:") & ~F.exists("antecedent", lambda x: x.startswith("class:")))
             .select(F.array_sort("antecedent").alias("antecedent"), F.substring(F.col("consequent")[0], 7, 100).alias("verdict"), "confidence",
                     (F.round(F.col("support") * total) / n).alias("support")))
    rare = (rules.select("antecedent", F.explode("antecedent").alias("t")).distinct().join(single, "t")
            .groupBy("antecedent").agg(F.min(F.struct("freq", "t")).getField("t").alias("key")))
    return rules.join(rare, "antecedent").select("antecedent", "verdict", "confidence", "support", "key")


def apply_rules(urls: DataFrame, rules: DataFrame, items: DataFrame) -> DataFrame:
    """``(row, tokens)`` -> ``(row, mined, antecedent)``: the best mined rule of each row that has one.
    Rows are regrouped by their own number only, never by a token or a token set."""
    known = urls.select("row", F.explode("tokens").alias("token")).join(items.select("token", "item"), "token")
    sets = known.groupBy("row").agg(F.collect_set("item").alias("set"))
    hit = sets.select("row", "set", F.explode("set").alias("key")).join(rules, "key").where(F.size(F.array_except("antecedent", "set")) == 0)
    best = F.max(F.struct("confidence", "support", (F.col("verdict") == "allow").alias("allow"), "verdict", "antecedent"))
    return hit.groupBy("row").agg(best.alias("b")).select("row", F.col("b.verdict").alias("mined"), F.col("b.antecedent").alias("antecedent"))


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, labels: DataFrame | None = None,
          min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``(page_id, host, path, rule, verdict, antecedent)``, one row per row of ``pages``.
    ``labels``: own ``(url, verdict)`` rows to learn from instead of the listed urls."""
    def prepared(df: DataFrame, *more: str) -> DataFrame:
        u = F.col(url_col if df is pages else "url").cast("string")
        d = df.select(*([F.col(id_col).alias("page_id")] if df is pages else []), *more, u.alias("url"), host_of(u).alias("host"), path_of(u).alias("path"))
        return d.withColumn("tokens", tokens_of(F.col("url"), F.col("host"), F.col("path")))

    p = prepared(pages).withColumn("rule", match_list(F.col("host"), F.col("path"), rules))
    listed = F.lit(None).cast("string")
    for rule, verdict in rules:
        listed = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(listed)
    p = p.withColumn("listed", listed)
    p = materialize(p.drop("url").withColumn("row", F.monotonically_increasing_id()), "urls")
    known = p.where("listed is not null").select("tokens", F.col("listed").alias("verdict")) if labels is None else prepared(labels, "verdict").select("tokens", "verdict")
    counts = label_counts(known)
    n, least = least_count(counts, min_support)
    items = token_items(counts, least)
    rules_mined = materialize(mine_items(counts, items, n, least, min_confidence), "rules")
    mined = apply_rules(p.where("listed is null").select("row", "tokens"), rules_mined, items)
    out = p.join(mined, "row", "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("listed", "mined", F.lit("allow")).alias("verdict"),
                      F.when(F.col("listed").isNull(), F.col("antecedent")).alias("antecedent"))
