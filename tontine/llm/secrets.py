"""Secret scans: fixed patterns, and a battery of randomness tests on long tokens.

Everything is DataFrame expressions. One pass over the texts keeps, for every match, the length of
the gap before it and its own length (``split`` and ``regexp_extract_all`` see the same leftmost
matches); positions are running sums of these, taken per document in a window, so the work is
linear in the number of matches.

The method: runs of 20 or more letters, digits and ``+ / _ = -`` are candidate tokens. A token's
encoding is inferred from its symbols (hex, base32, base62, base64). Three tests hold it against
uniform random symbols: chi-squared of the symbol counts, the number of runs above and below the
middle of the alphabet, and the correlation of neighbouring symbols. A token must pass all three
(Bonferroni over the battery). The discovery is then tested against text in two ways: the chance
that a token with the symbol collision rate of ordinary text repeats its symbols as rarely as this
one, and the likelihood ratio of the token's symbol pairs, text against uniform, whose inverse text
exceeds t times with a chance of 1/t at most. Text's pairs are counted in Spark over the distinct
words of the corpus that are too short to be tokens, each as written, in lower case, in upper
case and capitalized, and mixed with a fixed share of switches between letter cases and digits. The smaller p-value
counts, doubled. These, weighted by length (longer tokens get a larger share of the error budget), go
through Benjamini-Hochberg over all distinct tokens. P-values are rounded up to a grid of 2**(-1/8),
so ranks are counts over a table of bounded size and nothing is sorted globally.

Defined results: null text is empty; no match gives zero counts, the hash of the empty string and
an empty string of spans; rows are judged one by one, so repeated rows give repeated results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tontine.llm.common import materialize

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS, HEX = r"AKIA[A-Z0-9]{16,}", r"[0-9a-f]{24,}"
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
WORD = r"[A-Za-z0-9+/_=-]+"
FDR, BATTERY, LEAST = 0.05, 0.001, 20
#: Share of the fixed pair model in that of text, and its weight in pseudo-counts.
FIXED, PSEUDO = 0.2, 100
GRID, TOP = 8, 8000
_D, _U, _L = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: encoding -> (pattern of its tokens, alphabet, symbol collision rate of text written in it, its excess third moment)
ENCODINGS = {
    "hex": ("^[0-9a-f]+$|^[0-9A-F]+$", _D + "abcdef", 0.10, 0.002),
    "base32": ("^[A-Z2-7]+$", _U + "234567", 0.066, 0.001),
    "base62": ("^[A-Za-z0-9]+$", _U + _L + _D, 0.060, 0.001),
    "base64": ("", _U + _L + _D + "+/_-", 0.060, 0.001),
}
CLASSES = (_U, _L, _D, "+/_-=")
#: The fixed pair model: chances from class to class, where identifiers switch too.
MOVES = ((0.45, 0.45, 0.05, 0.05), (0.1, 0.75, 0.05, 0.1), (0.05, 0.05, 0.8, 0.1), (0.2, 0.5, 0.2, 0.1))
SYMBOLS = "".join(CLASSES)


def found(text: Column, pattern: str, ok=None) -> Column:
    """Matches of ``pattern`` as an array of (gap before, length, keep)."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    keep = ok or (lambda m: F.lit(True))
    made = F.zip_with(hits, F.slice(gaps, 1, F.size(hits)), lambda m, g: F.struct(
        F.length(g).alias("gap"), F.length(m).alias("len"), keep(m).alias("keep"), F.lit(None).cast("string").alias("token")))
    return F.when(text.rlike(pattern), made)


def found_tokens(text: Column) -> Column:
    hits = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    gaps = F.split(text, TOKEN, -1)
    made = F.zip_with(hits, F.slice(gaps, 1, F.size(hits)), lambda m, g: F.struct(
        F.length(g).alias("gap"), F.length(m).alias("len"), F.lit(True).alias("keep"), m.alias("token")))
    return F.when(text.rlike(TOKEN), made)


def upper_tail(z: Column) -> Column:
    """1 - Phi(z) of the normal distribution, by the usual rational approximation."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    q = F.exp(-a * a / 2) * poly / math.sqrt(2 * math.pi)
    return F.when(z >= 0, q).otherwise(1 - q)


def text_costs(texts: DataFrame) -> list[float]:
    """``(text)`` -> the bits that each pair of ``SYMBOLS`` costs in text, second symbol given the
    first: a list of fixed length."""
    words = (texts.select(F.explode(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("word"))
             .where(F.length("word").between(2, LEAST - 1)).distinct())
    forms = words.select(F.explode(F.array("word", F.lower("word"), F.upper("word"), F.initcap("word"))).alias("word"))
    pairs = forms.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.col("word").substr(i, F.lit(2)))).alias("pair"))
    seen = {r["pair"]: r["count"] for r in pairs.groupBy("pair").count().collect()}  # one row per pair of symbols at most
    of = {c: i for i, k in enumerate(CLASSES) for c in k}
    costs = []
    for a in SYMBOLS:
        total = sum(seen.get(a + b, 0) for b in SYMBOLS)
        for b in SYMBOLS:
            fixed = MOVES[of[a]][of[b]] / len(CLASSES[of[b]])
            counted = (seen.get(a + b, 0) + PSEUDO * fixed) / (total + PSEUDO)
            costs.append(-math.log2((1 - FIXED) * counted + FIXED * fixed))
    return costs


def battery(tokens: DataFrame, costs: list[float] | None = None) -> DataFrame:
    """``(token)`` -> plus ``encoding, n, p_chi, p_runs, p_serial, p_text``. Padding does not
    count; tokens with fewer than ``LEAST`` other symbols are left out. Without ``costs`` (those
    of ``text_costs``) ``p_text`` rests on the collision rate alone."""
    body = F.regexp_replace("token", "=+$", "")
    kind = F.lit("base64")
    for name in ("base62", "base32", "hex"):
        kind = F.when(F.col("body").rlike(ENCODINGS[name][0]), F.lit(name)).otherwise(kind)
    t = tokens.withColumn("body", body).where(F.length("body") >= LEAST).withColumn("encoding", kind)
    t = t.withColumn("written", F.col("body"))
    t = t.withColumn("body", F.when(F.col("encoding") == "hex", F.lower("body")).otherwise(F.col("body"))).withColumn("n", F.length("body").cast("double"))

    def by_kind(value) -> Column:
        out = F.lit(value("base64"))
        for name in ("base62", "base32", "hex"):
            out = F.when(F.col("encoding") == name, F.lit(value(name))).otherwise(out)
        return out

    alphabet = by_kind(lambda k: ENCODINGS[k][1])
    m = by_kind(lambda k: float(len(ENCODINGS[k][1])))
    symbols = F.split(alphabet, "")
    counts = F.transform(symbols, lambda c: (F.col("n") - F.length(F.regexp_replace("body", F.concat(F.lit(r"\Q"), c, F.lit(r"\E")), ""))))
    t = t.withColumn("squares", F.aggregate(F.filter(counts, lambda c: c > 0), F.lit(0.0), lambda s, c: s + c * c)).withColumn("m", m)
    chi = F.col("m") / F.col("n") * F.col("squares") - F.col("n")
    df = F.col("m") - 1
    z_chi = (F.pow(F.greatest(chi, F.lit(0.0)) / df, 1 / 3) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))

    def halves(k: str) -> tuple[str, str]:
        a = ENCODINGS[k][1]
        return a, "0" * (len(a) // 2) + "1" * (len(a) - len(a) // 2)

    bits = F.translate("body", *halves("base64"))
    for name in ("base62", "base32", "hex"):
        bits = F.when(F.col("encoding") == name, F.translate("body", *halves(name))).otherwise(bits)
    t = t.withColumn("bits", bits)
    ones = F.length(F.regexp_replace("bits", "0", "")).cast("double")
    switches = (2 * F.col("n") - F.length(F.regexp_replace("bits", "01", "")) - F.length(F.regexp_replace("bits", "10", ""))) / 2
    t = t.withColumns({"ones": ones, "runs": switches + 1, "z_chi": z_chi})
    mean = 2 * F.col("ones") * (F.col("n") - F.col("ones")) / F.col("n") + 1
    var = (mean - 1) * (mean - 2) / (F.col("n") - 1)
    p_runs = F.when(var > 0, F.least(F.lit(1.0), 2 * upper_tail(F.abs(F.col("runs") - mean) / F.sqrt(var)))).otherwise(F.lit(0.0))

    place = F.transform(F.split("body", ""), lambda c: (F.instr(alphabet, c) - F.lit(1)).cast("double"))
    t = t.withColumn("x", place)
    avg = F.aggregate("x", F.lit(0.0), lambda s, v: s + v) / F.col("n")
    t = t.withColumn("x", F.transform("x", lambda v: v - avg))
    square = F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v)
    lagged = F.aggregate(F.zip_with(F.slice("x", 1, F.size("x") - 1), F.slice("x", 2, F.size("x") - 1), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    p_serial = F.when(square > 0, F.least(F.lit(1.0), 2 * upper_tail(F.abs((lagged / square + 1 / F.col("n")) * F.sqrt("n"))))).otherwise(F.lit(0.0))

    rate, excess = by_kind(lambda k: ENCODINGS[k][2]), by_kind(lambda k: ENCODINGS[k][3])
    pairs = (F.col("squares") - F.col("n")) / 2
    expected = rate * F.col("n") * (F.col("n") - 1) / 2
    spread = F.sqrt(expected + F.col("n") * (F.col("n") - 1) * (F.col("n") - 2) * excess)
    p_text = 1 - upper_tail((pairs + 0.5 - expected) / spread)
    if costs is not None:
        bits = F.split(F.lit(",".join(map(repr, costs))), ",").cast("array<double>")
        at = F.transform(F.split("written", ""), lambda c: F.instr(F.lit(SYMBOLS), c) - 1)
        t = t.withColumn("at", at)
        step = F.zip_with(F.slice("at", 1, F.size("at") - 1), F.slice("at", 2, F.size("at") - 1), lambda a, b: F.get(bits, a * len(SYMBOLS) + b))
        gain = F.aggregate(step, F.lit(0.0), lambda s, v: s + v) - (F.col("n") - 1) * F.log2("m")
        # hex is written in two cases: one alternative more than encodings
        p_text = F.least(F.lit(1.0), 2 * F.least(p_text, (len(ENCODINGS) + 1) * F.pow(F.lit(2.0), -gain)))
    return t.select("token", "encoding", "n", upper_tail(F.col("z_chi")).alias("p_chi"), p_runs.alias("p_runs"), p_serial.alias("p_serial"),
                    F.greatest(p_text, F.lit(1e-300)).alias("p_text"))


def discoveries(tokens: DataFrame, fdr: float = FDR, alpha: float = BATTERY, costs: list[float] | None = None) -> DataFrame:
    """The ``(token)`` rows judged random: pass the battery, and are rejected as text at a false
    discovery rate of ``fdr`` over all distinct tokens, weighted by length."""
    t = materialize(battery(tokens.distinct(), costs), "battery")
    total = t.agg(F.count(F.lit(1)).alias("m"), F.avg("n").alias("mean_n"))
    fine = (F.least("p_chi", "p_runs", "p_serial") * 3 >= alpha)
    weighted = F.least(F.lit(1.0), F.col("p_text") * F.col("mean_n") / F.col("n"))
    step = F.least(F.lit(TOP), F.floor(-F.log2(weighted) * GRID)).cast("int")  # rounds p up
    t = t.crossJoin(F.broadcast(total)).withColumn("step", F.when(fine, step).otherwise(F.lit(0)))  # total: one row
    per = t.groupBy("step", "m").count()  # TOP + 1 rows at most
    above = Window.partitionBy("m").orderBy(F.desc("step"))
    limit = (per.withColumn("rank", F.sum("count").over(above))
             .where(F.pow(F.lit(2.0), -F.col("step") / GRID) <= fdr * F.col("rank") / F.col("m")).agg(F.min("step").alias("limit")))
    return t.crossJoin(F.broadcast(limit)).where("step >= limit and step > 0").select("token")  # limit: one row


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = FDR, alpha: float = BATTERY) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans)`` per row of ``docs``.
    Spans are kind:start:end in code points, end exclusive, by start and then kind."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    kinds = {"assign": found(F.col("text"), ASSIGN, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 6),
             "access": found(F.col("text"), ACCESS), "hex": found(F.col("text"), HEX), "random": found_tokens(F.col("text"))}
    rows = materialize(src.select(F.monotonically_increasing_id().alias("row"), "doc_id", *[c.alias(k) for k, c in kinds.items()]), "matches")
    tagged = F.array(*[F.struct(F.lit(i).alias("kind"), F.col(k).alias("hits")) for i, k in enumerate(KINDS)])
    one = (rows.where(" or ".join(f"{k} is not null" for k in KINDS)).select("row", F.explode(tagged).alias("k"))
           .select("row", "k.kind", F.posexplode("k.hits").alias("pos", "hit")).select("row", "kind", "pos", "hit.*"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    upto = Window.partitionBy("row", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    spans = (one.repartition(parts, "row").withColumn("end", F.sum(F.col("gap") + F.col("len")).over(upto))
             .withColumn("start", F.col("end") - F.col("len")).where("keep").select("row", "kind", "start", "end", "token"))
    spans = materialize(spans, "spans")
    random = discoveries(spans.where("kind = 3").select("token"), fdr, alpha, text_costs(src))
    kept = spans.where("kind < 3").drop("token").unionByName(spans.where("kind = 3").join(random, "token", "left_semi").drop("token"))
    label = lambda c: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), c["kind"] + 1), c["start"], c["end"])
    of_kind = lambda i: F.size(F.filter("s", lambda c: c["kind"] == i)).cast("long")
    per = kept.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("s"))
    per = per.select("row", *[of_kind(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
                     F.array_join(F.transform(F.filter("s", lambda c: c["kind"] < 3), label), ",").alias("base"), F.array_join(F.transform("s", label), ",").alias("spans"))
    zero = lambda k: F.coalesce(F.col(f"n_{k}"), F.lit(0).cast("long")).alias(f"n_{k}")
    return rows.select("row", "doc_id").join(per, "row", "left").select(
        "doc_id", *map(zero, KINDS), F.sha2(F.coalesce("base", F.lit("")).cast("binary"), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))
