"""URL filters: stated host and path rules first, mined association rules for the rest.

Spark's FP-growth finds frequent combinations of URL tokens among the pages that a stated
rule judges. Combinations that imply a verdict with enough confidence and support become
rules; one whose part is as sure already is dropped. A rule is indexed by its rarest
token, so a page meets only the rules of its own tokens.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import materialize

#: Stated rules: verdict, host (with all subdomains), start of the path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host_of(url: Column) -> Column:
    """From the first ``://`` to the next ``/``, ``?``, ``#`` or end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def stated_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null if none does (equal lengths: the last given)."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text, verdict = F.when(fits, F.lit(h + p)).otherwise(text), F.when(fits, F.lit(says)).otherwise(verdict)
    return text, verdict


def tokens_of(url: Column) -> Column:
    """Distinct tokens: host labels, path segments and fragment (digits as ``#``), names of query fields."""
    rest = _after_scheme(url)
    parts = lambda text, by: F.filter(F.split(text, by), lambda x: x != "")
    plain = lambda x: F.regexp_replace(x, "[0-9]+", "#")
    asked = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    marked = F.regexp_extract(rest, r"^[^#]*#([\s\S]*)$", 1)
    return F.array_sort(
        F.array_distinct(
            F.concat(
                F.transform(parts(host_of(url), "[.]"), lambda x: F.concat(F.lit("h:"), x)),
                F.transform(parts(path_of(url), "/"), lambda x: F.concat(F.lit("p:"), plain(x))),
                F.transform(parts(asked, "&"), lambda x: F.concat(F.lit("q:"), F.regexp_extract(x, "^[^=]*", 0))),
                F.when(marked != "", F.array(F.concat(F.lit("f:"), plain(marked)))).otherwise(F.array().cast("array<string>")),
            )
        )
    )


def token_classes(rows: DataFrame) -> DataFrame:
    """(token, name): tokens that occur in exactly the same ``rows`` (tokens, verdict) share a name, the least of them.

    Such tokens mean the same to every rule. Rows are told apart by hashes: number, exclusive
    or and sum of a token's rows must agree.
    """
    h = F.xxhash64("tokens", "verdict")
    seen = rows.select(F.explode("tokens").alias("token"), h.alias("h")).groupBy("token").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("h").alias("mixed"), F.sum(F.pmod("h", F.lit(1 << 31))).alias("sum")
    )
    names = seen.groupBy("n", "mixed", "sum").agg(F.min("token").alias("name"))
    return materialize(seen.join(names, ["n", "mixed", "sum"]).select("token", "name"), "url-tokens")


def named_sets(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """(tokens, names) of the distinct arrays ``tokens``: the sorted names of their tokens."""
    named = sets.select("tokens", F.explode("tokens").alias("token")).join(classes, "token")
    return named.groupBy("tokens").agg(F.array_sort(F.collect_set("name")).alias("names"))


def uncovered(sets: DataFrame) -> DataFrame:
    """``sets`` (antecedent, verdict, confidence, support) without those that a part of theirs is as sure of.

    All parts of a frequent set are frequent, so the best confidence over the parts of a set
    follows from the sets with one item less, level by level.
    """
    deepest = sets.agg(F.coalesce(F.max(F.size("antecedent")), F.lit(0))).first()[0]
    out = level = materialize(sets.where(F.size("antecedent") == 1).withColumn("best", F.lit(0.0)), "url-level")
    for n in range(2, deepest + 1):
        whole = sets.where(F.size("antecedent") == n)
        less = whole.select("antecedent", "verdict", F.explode(F.transform("antecedent", lambda x: F.array_except("antecedent", F.array(x)))).alias("part"))
        before = level.select(F.col("antecedent").alias("part"), "verdict", F.greatest("confidence", "best").alias("best"))
        best = less.join(before, ["part", "verdict"]).groupBy("antecedent", "verdict").agg(F.max("best").alias("best"))
        level = materialize(whole.join(best, ["antecedent", "verdict"], "left").withColumn("best", F.coalesce("best", F.lit(0.0))), "url-level")
        out = out.unionByName(level)
    return out.where("best < confidence").drop("best")


def mine_named(labelled: DataFrame, support: float = 0.01, confidence: float = 0.9) -> tuple[DataFrame, DataFrame]:
    """Rules (antecedent, verdict, confidence, support, token) from rows of tokens and verdict, and the names of tokens.

    Combinations of any length may become rules, over names (see :func:`token_classes`): a
    template of many constant parts is one item. Equal rows of tokens and verdict count
    once, so copies of one URL neither make a combination frequent nor load one task.
    """
    spark = labelled.sparkSession
    seen = materialize(labelled.where(F.size("tokens") > 0).select("tokens", "verdict").distinct(), "url-rows")
    classes = token_classes(seen)
    named = seen.join(named_sets(seen.select("tokens").distinct(), classes), "tokens")
    rows = materialize(named.select(F.concat("names", F.array(F.concat(F.lit("v:"), "verdict"))).alias("items")), "url-transactions")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if rows.isEmpty():
        return spark.createDataFrame([], "antecedent array<string>, verdict string, confidence double, support bigint, token string"), classes
    sets = materialize(
        FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence, numPartitions=parts).fit(rows).freqItemsets
        .select(
            F.array_sort(F.filter("items", lambda x: ~x.startswith("v:"))).alias("antecedent"),
            F.try_element_at(F.filter("items", lambda x: x.startswith("v:")), F.lit(1)).alias("says"),
            "freq",
        )
        .where(F.size("antecedent") > 0),
        "url-itemsets",
    )
    alone = sets.where("says is null").select("antecedent", F.col("freq").alias("of"))
    judged = materialize(
        sets.where("says is not null").join(alone, "antecedent")
        .select("antecedent", F.expr("substring(says, 3)").alias("verdict"), (F.col("freq") / F.col("of")).alias("confidence"), F.col("freq").alias("support")),
        "url-rules",
    )
    kept = uncovered(judged).where(F.col("confidence") >= confidence)
    often = alone.where(F.size("antecedent") == 1).select(F.col("antecedent")[0].alias("item"), F.col("of").alias("times"))
    rarest = (
        kept.select("antecedent", "verdict", F.explode("antecedent").alias("item")).join(often, "item")
        .groupBy("antecedent", "verdict").agg(F.min(F.struct("times", "item")).alias("least"))
    )
    rules = kept.join(rarest, ["antecedent", "verdict"]).select("antecedent", "verdict", "confidence", "support", F.col("least.item").alias("token"))
    return materialize(rules, "url-index"), classes


def mine_rules(labelled: DataFrame, support: float = 0.01, confidence: float = 0.9) -> DataFrame:
    """The rules of :func:`mine_named` written out over tokens: one for every choice of a token of each name."""
    rules, classes = mine_named(labelled, support, confidence)
    members = rules.select("antecedent", "verdict", F.explode("antecedent").alias("name")).join(classes, "name").groupBy("antecedent", "verdict", "name").agg(
        F.collect_list(F.struct("name", "token")).alias("all")
    )
    members = members.groupBy("antecedent", "verdict").agg(F.collect_list("all").alias("choices"))
    empty = F.array().cast("array<array<struct<name: string, token: string>>>")
    every = F.aggregate(
        "choices", F.concat(empty, F.array(F.array().cast("array<struct<name: string, token: string>>"))),
        lambda done, some: F.flatten(F.transform(done, lambda d: F.transform(some, lambda m: F.concat(d, F.array(m))))),
    )
    wide = rules.withColumnRenamed("token", "rarest").join(members, ["antecedent", "verdict"]).select("*", F.explode(every).alias("chosen"))
    return wide.select(
        F.array_sort(F.transform("chosen", lambda c: c["token"])).alias("antecedent"), "verdict", "confidence", "support",
        F.element_at(F.filter("chosen", lambda c: c["name"] == F.col("rarest")), 1)["token"].alias("token"),
    )


def match_rules(sets: DataFrame, rules: DataFrame, classes: DataFrame) -> DataFrame:
    """Verdict of each distinct array ``tokens`` that some rule fits: the surest, then best supported, rule wins."""
    return (
        named_sets(sets, classes).select("tokens", "names", F.explode("names").alias("token"))
        .join(rules, "token")
        .where(F.size(F.array_except("antecedent", "names")) == 0)
        .groupBy("tokens")
        .agg(F.max(F.struct("confidence", "support", F.size("antecedent").alias("n"), F.col("antecedent").alias("by"), "verdict")).alias("best"))
        .select("tokens", F.col("best.verdict").alias("mined"), F.col("best.by").alias("mined_rule"))
    )


def judge(pages: DataFrame, rules=RULES, support: float = 0.01, confidence: float = 0.9, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict, mined_rule of every row of ``pages``.

    A null URL or one without ``://`` has empty host, path and tokens and gets
    ``default``, as does a URL that no rule fits. Other columns of ``pages`` are not read.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    text, verdict = stated_rule(F.col("host"), F.col("path"), rules)
    seen = pages.select("page_id", host.alias("host"), path.alias("path"), tokens_of(F.col("url")).alias("tokens")).select(
        "*", text.alias("rule"), verdict.alias("stated")
    )
    mined, classes = mine_named(seen.where("stated is not null").select("tokens", F.col("stated").alias("verdict")), support, confidence)
    matched = match_rules(seen.where("stated is null and size(tokens) > 0").select("tokens").distinct(), mined, classes)
    return seen.join(matched, "tokens", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("stated", "mined", F.lit(default)).alias("verdict"),
        F.when(F.col("stated").isNull(), F.array_join("mined_rule", " ")).alias("mined_rule"),
    )
