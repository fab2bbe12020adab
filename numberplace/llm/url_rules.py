"""URLs judged by a rule list, and beyond it by association rules mined from labels.

A listed rule is a host and a path; it fits the host and its subdomains where the
URL's path starts with the rule's. Spark's FP-growth mines the token sets of
labelled URLs that come with a label; rules under a least support or confidence
are dropped, and so are those that a shorter rule of the same label makes
redundant. A URL finds its rules by an inverted index: every rule is listed
under its rarest token. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from numberplace.session import stored

MIN_SUPPORT, MIN_CONFIDENCE = 0.01, 0.9
#: Verdict of a URL that no rule speaks about.
DEFAULT = "allow"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"^[\s\S]*?://([^/?#]*)([^?#]*)(\?[^#]*)?(#[\s\S]*)?"
_LABEL = "label="


def host(url: str | Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z in lower case; else ''."""
    return F.coalesce(F.translate(F.regexp_extract(url, _PARTS, 1), _UPPER, _LOWER), F.lit(""))


def path(url: str | Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else ''."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def tokens(url: str) -> Column:
    """Distinct host labels, path segments that start with no digit, query names and a mark for a fragment."""
    query = F.regexp_replace(F.regexp_extract(url, _PARTS, 3), r"^\?", "")
    marked = [
        F.transform(F.split(host(url), r"\."), lambda x: F.concat(F.lit("h:"), x)),
        F.transform(F.filter(F.split(path(url), "/"), lambda x: ~x.rlike("^[0-9]")), lambda x: F.concat(F.lit("p:"), x)),
        F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("q:"), F.split(x, "=")[0])),
        F.when(F.regexp_extract(url, _PARTS, 4) != "", F.array(F.lit("f:"))).otherwise(F.array().cast("array<string>")),
    ]
    bare = F.array(*map(F.lit, ("h:", "p:", "q:")))
    return F.coalesce(F.array_except(F.array_distinct(F.concat(*marked)), bare), F.array().cast("array<string>"))


def listed_rule(url: str, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest fitting rule of (verdict, host, path) as a struct (text, verdict), or null; of equals, the first by text."""
    own_host, own_path = host(url), path(url)
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2], r[0]))
    fits = [
        F.when(
            ((own_host == name) | own_host.endswith("." + name)) & own_path.startswith(start),
            F.struct(F.lit(name + start).alias("text"), F.lit(verdict).alias("verdict")),
        )
        for verdict, name, start in ranked
    ]
    none = F.lit(None).cast("struct<text:string,verdict:string>")
    return F.coalesce(*fits, none)


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(antecedent, label, confidence, support) from (tokens, label), stored; empty if nothing is labelled.

    A rule is redundant if leaving out one of its tokens gives a rule of the same
    label that is at least as sure.
    """
    spark = labelled.sparkSession
    schema = "antecedent array<string>, label string, confidence double, support double"
    baskets = stored(labelled.select(F.array_append("tokens", F.concat(F.lit(_LABEL), F.col("label"))).alias("items")))
    if baskets.isEmpty():
        return spark.createDataFrame([], schema)
    mined = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets).associationRules
    rules = stored(mined.select(
        F.array_sort("antecedent").alias("antecedent"), F.substring(F.col("consequent")[0], len(_LABEL) + 1, 1_000).alias("label"),
        "confidence", "support").where(F.col("consequent")[0].startswith(_LABEL)))
    shorter = rules.select(F.col("antecedent").alias("part"), "label", F.col("confidence").alias("sure"))
    one_less = rules.select("antecedent", "label", "confidence", F.explode("antecedent").alias("out")).withColumn(
        "part", F.array_remove("antecedent", F.col("out")))
    redundant = one_less.join(shorter, ["part", "label"]).filter("sure >= confidence").select("antecedent", "label").distinct()
    return stored(rules.join(redundant, ["antecedent", "label"], "left_anti").select(
        "antecedent", "label", "confidence", "support"))


def judge(
    df: DataFrame,
    rules: Sequence[tuple[str, str, str]],
    labelled: DataFrame | None = None,
    id_column: str = "page_id",
    url: str = "url",
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """Per row: the id, ``host``, ``path``, ``rule``, ``verdict`` and ``mined``, the tokens of the mined rule that decided.

    A fitting listed rule decides. Otherwise the surest mined rule does (then the
    one with more support, with more tokens, first by label and tokens), otherwise
    ``DEFAULT``. Rules are mined from the URLs that a listed rule fits, labelled by
    its verdict, and from ``labelled`` (``id_column``, label), which labels others. Null URLs and such without ``://`` have an empty
    host and path and no tokens. Rows are judged one by one; other columns play no part.
    """
    seen = stored(df.select(
        F.col(id_column).alias("id"), host(url).alias("host"), path(url).alias("path"),
        listed_rule(url, rules).alias("listed"), tokens(url).alias("tokens")))
    known = seen.filter("listed IS NOT NULL").select("tokens", F.col("listed.verdict").alias("label"))
    if labelled is not None:
        others = labelled.select(F.col(id_column).alias("id"), "label").filter("label IS NOT NULL")
        known = known.unionByName(seen.filter("listed IS NULL").join(others, "id").select("tokens", "label"))
    mined = mine_rules(known, min_support, min_confidence)
    # Distinct token sets of URLs that no listed rule fits; copies are judged once.
    open_ = stored(seen.filter("listed IS NULL AND size(tokens) > 0").select(F.array_sort("tokens").alias("tokens")).distinct())
    entries = open_.select("tokens", F.explode("tokens").alias("token"))
    counts = stored(entries.groupBy("token").agg(F.count("*").alias("n")))
    spread = mined.select("antecedent", "label", "confidence", "support", F.explode("antecedent").alias("token"))
    # A token that no open URL has rules its rules out.
    counted = spread.join(counts, "token", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    index = stored(counted.groupBy("antecedent", "label", "confidence", "support").agg(F.min(F.struct("n", "token")).alias("key")).select(
        F.col("key.token").alias("token"), "antecedent", "label", "confidence", "support"))
    met = entries.join(index, "token").filter(F.size(F.array_except("antecedent", "tokens")) == 0)
    rank = F.struct((-F.col("confidence")).alias("c"), (-F.col("support")).alias("s"), (-F.size("antecedent")).alias("k"),
                    (F.col("label") != "block").alias("b"), F.col("antecedent").alias("mined"), F.col("label").alias("label"))
    decided = stored(met.groupBy("tokens").agg(F.min(rank).alias("best")).select(
        F.col("tokens").alias("key"), F.col("best.label").alias("label"), F.col("best.mined").alias("mined")))
    return seen.withColumn("key", F.when(F.col("listed").isNull(), F.array_sort("tokens"))).join(decided, "key", "left").select(
        F.col("id").alias(id_column), "host", "path", F.col("listed.text").alias("rule"),
        F.coalesce("listed.verdict", "label", F.lit(DEFAULT)).alias("verdict"), "mined")
