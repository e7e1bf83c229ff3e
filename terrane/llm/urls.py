"""URL filters (operator 6): host and path rules first, then association rules mined from the urls they label.

Longest-match rules (host and subdomains, path prefix) give verdicts where they fit, and those verdicts label urls.
Each url becomes a transaction of its tokens (host labels, registered domain, path segments, query keys); a labelled
one has its label too. Over the labelled urls, Spark's FP-growth finds the frequent combinations. A rule "tokens ->
label" needs its support and confidence there, at most ``MAX_TOKENS`` tokens, a lift over the label's share of all
labelled urls, and more urls than chance explains: with that share q, c of n urls have the label with a probability
of at most exp(-n * KL(c / n, q)) (Chernoff), which must not exceed ``ALPHA`` divided by the number of rules in
question. These rules judge the urls without a label. Mined rules are matched by an inverted index: each is filed under
its rarest token, urls look up their tokens, and the other tokens are verified.

Defined results: a null url, or one without "://", has empty host and path and no rule; it is allowed unless a mined
rule fits (none can: it has no tokens). Without labelled urls everything left is allowed. Equal rows give equal results;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import string

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (verdict, host/path prefix); the longest one that fits wins.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"),
         ("block", "net/fr/"))
MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.9
MIN_LIFT = 1.1
#: Chance of any accidental rule, over all rules that pass the other bounds.
ALPHA = 0.05
#: Tokens on the left side of a mined rule, at most.
MAX_TOKENS = 3


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """The longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: len(r[1])):
        rule_host, _, rest = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def verdict_of(rule: Column, rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    verdict = F.lit(None).cast("string")
    for judged, name in rules:
        verdict = F.when(rule == name, F.lit(judged)).otherwise(verdict)
    return verdict


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a url; runs of digits count as one token each."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    domain = F.filter(F.array(F.substring_index(host, ".", -2)), lambda x: x != "")
    segments = F.filter(F.split(F.lower(path), "/"), lambda x: x != "")
    query = F.regexp_extract_all(F.coalesce(url, F.lit("")), F.lit(r"[?&]([^=&#?]+)"), 1)

    def tagged(kind: str, part: Column) -> Column:
        return F.transform(part, lambda x: F.concat(F.lit(kind), F.regexp_replace(x, "[0-9]+", "0")))

    return F.array_distinct(F.concat(tagged("host:", labels), tagged("domain:", domain), tagged("path:", segments),
                                     tagged("query:", query)))


def mine_rules(urls: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
               max_tokens: int = MAX_TOKENS) -> DataFrame | None:
    """(tokens, key, verdict, confidence, support) of the mined rules; ``urls`` has tokens and verdict (null: no label).

    ``key`` is the rarest token of a rule. None without labelled rows.
    """
    labelled = urls.where("verdict IS NOT NULL")
    n = labelled.count()
    if not n:
        return None
    label = F.concat(F.lit("label:"), F.col("verdict"))
    baskets = labelled.select(F.array_append("tokens", label).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    frequency = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    rules = (model.associationRules
             .where((F.size("consequent") == 1) & F.col("consequent")[0].startswith("label:")
                    & (F.size("antecedent") <= max_tokens) & ~F.exists("antecedent", lambda t: t.startswith("label:")))
             .where(F.col("lift") >= MIN_LIFT)
             .select(F.array_sort("antecedent").alias("tokens"), F.substring(F.col("consequent")[0], 7, 100).alias("verdict"),
                     "confidence", "support", "lift"))
    limit = math.log(max(rules.count(), 1) / ALPHA)
    hit, miss, base_rate = F.col("confidence"), 1 - F.col("confidence"), F.col("confidence") / F.col("lift")
    surprise = hit * F.log("lift") + F.when(miss > 0, miss * F.log(miss / (1 - base_rate))).otherwise(0.0)
    rules = rules.where(n * F.col("support") / hit * surprise >= limit).drop("lift")
    rarest = (rules.select("tokens", F.explode("tokens").alias("token")).join(frequency, "token")
              .groupBy("tokens").agg(F.min_by("token", F.struct("freq", "token")).alias("key")))
    return rules.join(rarest, "tokens")


def apply_mined(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """url, mined verdict: the most confident (then best supported) rule whose tokens are all in the url."""
    looked_up = urls.select("url", "tokens", F.explode("tokens").alias("key"))
    index = rules.select("key", F.col("tokens").alias("needed"), F.col("verdict").alias("mined"), "confidence", "support")
    fits = looked_up.join(index, "key").where(F.size(F.array_except("needed", "tokens")) == 0)
    order = F.struct("confidence", "support", F.col("mined"), F.col("needed"))
    return fits.groupBy("url").agg(F.max_by("mined", order).alias("mined"),
                                   F.max_by("needed", order).alias("mined_rule"))


def filter_urls(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, min_support: float = MIN_SUPPORT,
                min_confidence: float = MIN_CONFIDENCE, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per row: id, host, path, rule, verdict, mined_rule (tokens of the mined rule that judged, else null)."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    judged = (pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
              .withColumns({"host": host, "path": path})
              .withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
              .withColumn("base", verdict_of(F.col("rule"), rules)))
    tokens = tokens_of(F.col("url"), F.col("host"), F.col("path"))
    mined = mine_rules(judged.select(tokens.alias("tokens"), F.col("base").alias("verdict")), min_support, min_confidence)
    if mined is None:
        judged = judged.withColumns({"mined": F.lit(None).cast("string"), "mined_rule": F.lit(None).cast("array<string>")})
    else:
        left = judged.where("rule IS NULL AND url IS NOT NULL").select("url", tokens.alias("tokens")).distinct()
        judged = judged.join(apply_mined(left, mined), "url", "left")
    return judged.select("page_id", "host", "path", "rule",
                         F.coalesce("base", "mined", F.lit("allow")).alias("verdict"),
                         F.when(F.col("rule").isNull(), F.col("mined_rule")).alias("mined_rule"))
