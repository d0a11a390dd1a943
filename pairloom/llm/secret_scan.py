"""Secrets: fixed forms, and random strings found by a character Markov model, in built-in functions only.

Two first-order Markov models over ASCII, one of random strings and one of
ordinary identifiers, give each candidate a log-likelihood ratio. They learn from
labelled samples: what the fixed forms match, against all other long tokens.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 20_000  # documents the two models learn from
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
ORDINARY = r"[A-Za-z0-9+/_=-]{6,}"
KINDS = ["assign", "access", "hex", "random"]
THRESHOLD = 12.0  # nats by which the random model must win in all
RATE = 0.4  # and a character
SPAN = "struct<start:int,kind:int,end:int,value:string>"
MASK = "[SECRET]"


def _spans(text: str, pattern: str, kind: int, group: int = 0, keep=None) -> Column:
    """Matches in order, as structs with code point positions; ``value`` is the group."""
    none = F.expr(f"CAST(array() AS array<{SPAN}>)")
    parts = [F.split(text, F.lit(pattern), -1).alias("piece"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole")]
    if group:
        parts.append(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"))

    def step(acc: Column, x: Column) -> Column:
        x = {"piece": x["piece"], "whole": x["whole"], "value": x["value" if group else "whole"]}
        start = acc["at"] + F.length(x["piece"])
        end = start + F.coalesce(F.length(x["whole"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["value"].alias("value"))
        good = x["whole"].isNotNull() & (keep(x["value"]) if keep else F.lit(True))
        return F.struct(end.alias("at"), F.when(good, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    found = F.aggregate(F.arrays_zip(*parts), F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda acc: acc["out"])
    return F.when(F.col(text).rlike(pattern), found).otherwise(none)


def with_base_spans(docs: DataFrame) -> DataFrame:
    """Adds ``base``: spans of the fixed forms, by start and then kind. A null text counts as empty.

    ACCESS and HEX ask for the least length in the pattern, which gives the same
    spans as dropping short matches, since matches are maximal runs; ASSIGN must
    match first and be dropped after.
    """
    text = docs.withColumn("__text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    forms = [_spans("__text", ASSIGN, 0, 1, lambda v: F.length(v) >= 8), _spans("__text", ACCESS, 1), _spans("__text", HEX, 2)]
    return text.withColumn("base", F.array_sort(F.concat(*forms)))


def learn(docs: DataFrame, rows: int = SAMPLE_ROWS) -> list[float]:
    """Log-likelihood ratios of the 128 x 128 pairs of characters, random against ordinary.

    Labelled samples come from about ``rows`` documents, chosen by hash of the
    text. Only distinct strings teach, so copies do not weigh.
    """
    lot = F.shiftrightunsigned(F.xxhash64("text", F.lit(11)), 11) / float(1 << 53)
    share = min(1.0, rows / max(1, docs.count()))
    sample = with_base_spans(docs.select("text").where("text IS NOT NULL").where(lot < share))
    secret = sample.select(F.explode("base.value").alias("s"), F.lit(1).alias("secret"))
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace("__text", ASSIGN, " "), ACCESS, " "), HEX, " ")
    plain = sample.select(F.explode(F.regexp_extract_all(rest, F.lit(ORDINARY), F.lit(0))).alias("s"), F.lit(0).alias("secret"))
    pairs = secret.union(plain).distinct().select("secret", F.explode(F.regexp_extract_all("s", F.lit("(?=(..))"), F.lit(1))).alias("pair"))
    counts = [[0] * 16384, [0] * 16384]
    for r in pairs.groupBy("secret", "pair").count().collect():  # at most twice 128 x 128 rows
        counts[r.secret][ord(r.pair[0]) * 128 + ord(r.pair[1])] = r["count"]

    def logs(n: list[int]) -> list[float]:
        symbols = 66
        alphabet = sum(n) or 1
        after = [sum(n[128 * a + b] for a in range(128)) / alphabet for b in range(128)]
        smooth = [0.5 * after[b] + 0.5 / symbols for b in range(128)]
        total = [sum(n[128 * a : 128 * a + 128]) for a in range(128)]
        return [math.log((n[128 * a + b] + 20 * smooth[b]) / (total[a] + 20)) for a in range(128) for b in range(128)]

    return [round(r - o, 4) for r, o in zip(logs(counts[1]), logs(counts[0]), strict=True)]


def log_ratio(value: Column, ratios: list[float]) -> Column:
    """Sum of the ratios of all pairs of neighbouring characters; ASCII strings only."""
    table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<double>")
    pairs = F.regexp_extract_all(value, F.lit("(?=(..))"), F.lit(1))
    return F.aggregate(pairs, F.lit(0.0), lambda acc, p: acc + F.get(table, F.ascii(p) * 128 + F.ascii(F.substring(p, 2, 1))))


def find(docs: DataFrame, ratios: list[float]) -> DataFrame:
    """Adds ``base`` and ``spans``, arrays of (start, kind, end, value) by start, then kind.

    A token that overlaps no base span is added as ``random`` if the random model
    wins by ``THRESHOLD`` and by ``RATE`` a character. Null and empty texts have no
    spans; each row is judged by itself.
    """

    def random(value: Column) -> Column:
        llr = log_ratio(value, ratios)
        return llr >= F.greatest(F.lit(THRESHOLD), F.lit(RATE) * F.length(value))

    based = with_base_spans(docs).withColumn("__more", _spans("__text", TOKEN, 3, 0, random))
    apart = F.filter("__more", lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    return based.withColumn("spans", F.array_sort(F.concat("base", apart))).drop("__more", "__text")


def as_text(spans: str) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, ratios: list[float], mask: str = MASK) -> DataFrame:
    """The documents with every found span replaced by ``mask`` (overlapping spans by one); null texts stay null."""
    found = find(docs, ratios)
    text = F.col("text").cast("string")

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        upto = F.concat(acc["out"], text.substr(acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(fresh, upto).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    whole = F.aggregate("spans", start, step, lambda acc: F.concat(acc["out"], text.substr(acc["at"] + 1, F.length(text))))
    return found.withColumn("text", F.when(F.size("spans") > 0, whole).otherwise(text)).drop("base", "spans")
