"""PII (operator 7): base patterns, and terms that the corpus shows to disclose a protected entity. Native plans only.

Base spans (e-mail, ip, card, phone) are the protected values. Most values stand in one document, so each is also an
entity at the levels that recur: its name parts, host and domain (e-mail), network (ip), issuer (card), exchange
(phone) and its kind. A term t is a word outside base spans. Over all distinct texts, with n of them in all, n_c with
an entity c, n_t with t and n_ct with both anywhere:

    information of c      IC(c) = log2(n / n_c)
    disclosure of c by t  PMI(c; t) = log2(n * n_ct / (n_c * n_t)),  at most IC(c)

t discloses c when PMI(c; t) / IC(c) reaches a threshold and chance does not explain n_ct: by Chernoff's bound,
n_ct of n_t texts have c with a probability of at most exp(-n_t * KL(n_ct / n_t, n_c / n)), which must not exceed
``ALPHA`` divided by the number of pairs judged (recurring entities times the terms of their texts). Every occurrence
of such a term is acted on, in all documents: above ``REMOVE`` it is removed, above ``GENERALISE`` replaced by its class.

What counting needs of a text (its hash, entities and distinct words) is written once, so the patterns run twice over
a text, there and for the result. The counts are taken in steps that keep data small: entities of at least two texts (one text estimates nothing), pairs
that could pass if their term stood nowhere else, then text counts of those terms alone. Each count is a map-side
combined aggregate of per-document distinct values; each of k equal texts counts 1 / k.

Defined results: a null text is empty (no spans); rows with the same id and text share their spans; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrane.llm.common import Scratch, beside, row_id
from terrane.llm.spans import NO_SPANS, in_order, merged, no_spans, pattern_spans, replaced

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
#: Chance of any accidental term, over all pairs judged.
ALPHA = 0.05
GENERALISE, REMOVE = 0.8, 0.95
#: Words that may be terms: letters, at least three.
WORD_START, WORD_END = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
TERM_PATTERN = WORD_START + r"\p{L}{3,}" + WORD_END
PLACEHOLDER = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}

# Where a run of the local part's characters holds no match from its start, it holds none from later; \G allows a
# start right behind the match before. Possessive runs keep the search linear.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}+"
CARD = r"[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_PART = r"0*+(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])?"


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Luhn's check over a string of digits."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d: d.try_cast("int"))
    doubled = F.transform(values, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(doubled, F.lit(0), lambda total, d: total + F.coalesce(d, F.lit(0))) % 10 == 0


def _card(found: Column) -> Column:
    digits = _digits(found)
    return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(F.lit(False))


def base_spans(text: Column) -> Column:
    """Base spans of a text, by start, then kind; matches that fail their check are dropped."""
    digit = text.rlike("[0-9]")
    return in_order(
        pattern_spans(text, EMAIL, "email", 0, F.contains(text, F.lit("@"))),
        pattern_spans(text, IP, "ip", 1, digit & text.rlike(r"[0-9]\.[0-9]"),
                      lambda f: f.rlike(rf"^{IP_PART}(?:\.{IP_PART}){{3}}$")),
        pattern_spans(text, CARD, "card", 2, digit & text.rlike(r"(?:[0-9][\x20-]?){13}[0-9]"), _card),
        pattern_spans(text, PHONE, "phone", 3, F.contains(text, F.lit("+")),
                      lambda f: F.length(_digits(f)).between(10, 15)))


def _entities(span: Column) -> Column:
    """The value of a base span and the levels above it, each with its level's name."""
    value, digits = F.lower(span["found"]), _digits(span["found"])
    host = F.substring_index(value, "@", -1)
    names = F.regexp_extract_all(F.substring_index(value, "@", 1), F.lit("[a-z]{3,}"), 0)

    def level(name: str, part: Column) -> Column:
        return F.concat(F.lit(f"{name}:"), part)

    own = (F.when(span["kind"] == "email", F.concat(
               F.array(level("email", value), level("host", host), level("domain", F.substring_index(host, ".", -2))),
               F.transform(names, lambda x: level("name", x))))
           .when(span["kind"] == "ip", F.array(level("ip", value), level("network", F.substring_index(value, ".", 3))))
           .when(span["kind"] == "card", F.array(level("card", digits), level("issuer", F.substring(digits, 1, 6))))
           .otherwise(F.array(level("phone", digits), level("exchange", digits.substr(F.lit(1), F.length(digits) - 4)))))
    return F.array_append(own, level("kind", span["kind"]))


def _plain(text: Column, base: Column) -> Column:
    """The text with base spans as digits, so that places stay and no term lies inside or touches a span."""
    return replaced(text, merged(base), lambda p: F.repeat(F.lit("0"), (p["end"] - p["start"]).cast("int")))


def _words(text: Column, base: Column) -> Column:
    """Words of a text that may be terms, as written."""
    return F.regexp_extract_all(_plain(text, base), F.lit(TERM_PATTERN), 0)


def _facts(found: DataFrame) -> DataFrame:
    """h (text hash), entities and words (distinct, as written) of every document: all that counting needs of a text."""
    entities = F.array_distinct(F.flatten(F.transform("base", _entities)))
    return found.select(F.col("row.h").alias("h"), entities.alias("entities"),
                        F.array_distinct(_words(F.col("text"), F.col("base"))).alias("words"))


def disclosing_terms(facts: DataFrame, scratch: Scratch, alpha: float = ALPHA, generalise: float = GENERALISE) -> DataFrame:
    """(entity, term, disclosure): pairs whose disclosure ratio reaches ``generalise`` and that chance does not explain.

    ``facts``: see ``_facts``.
    """
    sizes = facts.groupBy("h").agg(F.count(F.lit(1)).alias("k"))
    n = sizes.count()
    copies = scratch.write(sizes.where("k > 1"), "copies")
    # a text without terms and entities has nothing to count; all others carry their share of the texts equal to them
    shared = (facts.where((F.size("words") > 0) | (F.size("entities") > 0)).join(beside(copies, copies.count()), "h", "left")
              .select("entities", F.array_distinct(F.transform("words", F.lower)).alias("terms"),
                      (F.lit(1.0) / F.coalesce("k", F.lit(1))).alias("share")))

    def texts(name: str) -> Column:
        return F.round(F.sum("share")).cast("bigint").alias(name)

    owners = shared.where(F.size("entities") > 0).select("terms", "share", F.explode("entities").alias("entity"))
    entities = scratch.write(owners.groupBy("entity").agg(texts("n_c")).where((F.col("n_c") > 1) & (F.col("n_c") < n)), "entities")
    pairs = (owners.join(beside(entities.select("entity"), entities.count()), "entity", "left_semi")
             .select("entity", "share", F.explode("terms").alias("term"))
             .groupBy("entity", "term").agg(texts("n_ct")))
    pairs = scratch.write(pairs, "pairs")
    judged = entities.count() * pairs.agg(F.count_distinct("term").alias("n")).first()["n"]
    limit = math.log(max(judged, 1) / alpha)
    rarity = F.log(n / F.col("n_c"))
    able = pairs.join(entities, "entity").where(F.col("n_ct") * rarity >= limit)
    counted = (shared.select("share", F.explode("terms").alias("term"))
               .groupBy("term").agg(texts("n_t")).join(able.select("term").distinct(), "term", "left_semi"))
    share, base_rate = F.col("n_ct") / F.col("n_t"), F.col("n_c") / F.lit(float(n))
    missing = F.col("n_t") - F.col("n_ct")
    surprise = (F.col("n_ct") * F.log(share / base_rate)
                + F.when(missing > 0, missing * F.log((1 - share) / (1 - base_rate))).otherwise(0.0))
    disclosure = F.log(share / base_rate) / rarity
    flagged = (able.join(counted, "term").where((disclosure >= generalise) & (surprise >= limit))
               .select("entity", "term", disclosure.alias("disclosure")))
    flagged = scratch.write(flagged, "flagged")
    scratch.drop("copies", "entities", "pairs")
    return flagged


def find_pii(docs: DataFrame, alpha: float = ALPHA, generalise: float = GENERALISE, remove: float = REMOVE,
             id_col: str = "doc_id", text_col: str = "text", extra: dict[str, Column] | None = None) -> DataFrame:
    """Per document row: row (id and text hash), base (base spans), terms (disclosing terms' spans, kind ``term``;
    ``found`` holds "remove" or "generalise"); ``extra`` adds columns made from the input's."""
    found = docs.select(row_id(id_col, text_col).alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                        *((c.alias(n)) for n, c in (extra or {}).items()))
    found = found.withColumn("base", base_spans(F.col("text")))
    scratch = Scratch(docs.sparkSession, "pii")
    facts = scratch.write(_facts(found), "facts")
    action = F.when(F.max("disclosure") >= remove, "remove").otherwise("generalise")
    flagged = disclosing_terms(facts, scratch, alpha, generalise).groupBy("term").agg(action.alias("action"))
    flagged = scratch.write(flagged, "actions")
    # texts with such a term, by hash, and its forms there; places are searched for those forms alone
    hits = (facts.select(F.col("h").alias("own"), F.explode("words").alias("word")).withColumn("term", F.lower("word"))
            .join(beside(flagged, flagged.count()), "term").groupBy("own")
            .agg(F.map_from_entries(F.collect_set(F.struct("word", "action"))).alias("hits")))
    hits = scratch.write(hits, "hits")
    scratch.drop("facts", "flagged", "actions")
    forms = F.concat(F.lit(WORD_START + "(?:"), F.array_join(F.map_keys("hits"), "|"), F.lit(")" + WORD_END))
    spans = pattern_spans(_plain(F.col("text"), F.col("base")), forms, TERM, 4, F.col("hits").isNotNull())
    acted = F.transform(spans, lambda s: F.struct(
        s["start"], s["end"], s["rank"], s["kind"], F.try_element_at("hits", s["found"]).alias("found")))
    entries = hits.agg(F.sum(F.size("hits"))).first()[0] or 0
    return (found.join(beside(hits, entries), F.col("row.h") == F.col("own"), "left")
            .withColumn("terms", F.when(F.col("hits").isNotNull(), acted.cast(NO_SPANS)).otherwise(no_spans()))
            .drop("own", "hits"))


def sanitised(text: Column, base: Column, terms: Column) -> Column:
    """Text with entities as placeholders, disclosing terms removed or generalised to their class."""
    acted = F.transform(terms, lambda s: F.struct(s["start"], s["end"], s["rank"], s["found"].alias("kind"), s["found"]))
    pieces = merged(in_order(base, acted))

    def put(piece: Column) -> Column:
        new = F.lit("")
        for kind, name in (PLACEHOLDER | {"generalise": "[TERM]"}).items():
            new = F.when(piece["kind"] == kind, F.lit(name)).otherwise(new)
        return new

    return replaced(text, pieces, put)
