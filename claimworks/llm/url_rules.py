"""URL filtering: listed rules, then association rules mined from labels. JVM side only.

A url's tokens are its host labels, the domains they form, path parts, file ending and the names of
its parameters. Frequent token sets of the labelled urls are mined with FP-growth, together with
the label; rules "tokens -> block" stay when support and confidence are high enough and no rule
with fewer tokens is at least as sure. A rule is listed in the index under its rarest token only;
urls meet the index by token, and a hit counts when the url has all tokens of the rule. Rules that
are listed by hand win over mined ones; among those the longest wins.

Urls are judged once each and joined back by url; Spark splits a hot one (adaptive skew join). Mining
reads every token of a labelled url that is in enough blocked urls for a rule, wherever it stands.
Tokens of exactly the same labelled urls (a domain and its host label, say) are mined as one, since
token sets double with each, and every rule is then listed with each of them.

Defined results: a null url, or one without ``://``, has an empty host and path and no tokens, and
is allowed; without labels no rule is mined; repeated rows and null keys give one row each; an
empty table gives an empty result. Only key and url are read.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimworks.llm.common import written

BLOCK = "label:block"
#: Fixed: the listed rules, as host, path start, verdict.
LISTED = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
#: Fixed: characters of a name that a name server can hold. A longer host is in no domain but itself.
LONGEST_NAME = 253
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url) -> F.Column:
    found = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), _UPPER, _LOWER)


def path(url) -> F.Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(url) -> F.Column:
    """Distinct tokens of a url, in a fixed order."""
    h, p = host(url), path(url)
    labels = F.split(h, r"\.")
    every = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(
        F.lit("domain:"), F.array_join(F.slice(labels, -i, i), ".")))
    domains = F.when(F.length(h) <= LONGEST_NAME, every).otherwise(F.array(F.concat(F.lit("domain:"), h)))
    hosts = F.concat(F.transform(labels, lambda x: F.concat(F.lit("host:"), x)), domains)
    paths = F.transform(F.filter(F.split(p, "/"), lambda x: x != ""), lambda x: F.concat(F.lit("path:"), x))
    ending = F.array(F.concat(F.lit("ending:"), F.regexp_extract(p, r"\.([A-Za-z0-9]{1,8})\z", 1)))
    query = F.regexp_extract(url, r"(?s)\A[^?#]*\?([^#]*)", 1)
    names = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""),
                        lambda x: F.concat(F.lit("query:"), F.split_part(x, F.lit("="), F.lit(1))))
    both = F.array_distinct(F.concat(hosts, paths, F.filter(ending, lambda x: x != "ending:"), names))
    return F.when(F.coalesce(h, F.lit("")) != "", both).otherwise(F.array().cast("array<string>"))


def listed(h, p, rules=LISTED) -> F.Column:
    """``rule, verdict`` of the longest listed rule that fits, else nulls."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, start, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((h == name) | F.endswith(h, F.lit("." + name))) & F.startswith(p, F.lit(start))
        out = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def baskets(labelled: DataFrame, url: str, blocked: str, min_support: float) -> tuple[DataFrame, DataFrame]:
    """What is mined: ``items`` per labelled url with a token, and ``item, same``, the tokens an item
    stands for. Tokens in too few blocked urls for any rule are left out, and tokens of exactly the
    same urls are one item, so no rule is lost; ``mine`` names the tokens again."""
    rows = labelled.select(F.monotonically_increasing_id().alias("row"), F.col(blocked).alias("blocked"),
                           tokens(F.col(url)).alias("tokens")).filter(F.size("tokens") > 0)
    rows = written(rows, "labelled")
    each = rows.select("row", "blocked", F.explode("tokens").alias("token"))
    least = F.broadcast(rows.agg(F.ceil(F.count(F.lit(1)) * F.lit(min_support)).alias("least")))
    seen = each.groupBy("token").agg(
        F.count_if("blocked").alias("n"), F.bit_xor(F.xxhash64("row")).alias("h1"),
        F.bit_xor(F.xxhash64("row", F.lit(1))).alias("h2"), F.count(F.lit(1)).alias("all"))
    frequent = seen.join(least, F.col("n") >= F.col("least"), "left_semi")
    items = written(frequent.groupBy("all", "n", "h1", "h2").agg(F.array_sort(F.collect_list("token")).alias("same"))
                    .select(F.element_at("same", 1).alias("item"), "same"), "items")
    mined = each.join(items.select("item"), F.col("token") == F.col("item")).groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items"))
    none = F.array().cast("array<string>")
    mined = rows.join(mined, "row", "left").select(F.concat(
        F.coalesce("items", none), F.when(F.col("blocked"), F.array(F.lit(BLOCK))).otherwise(none)).alias("items"))
    return mined, items


def mine(labelled: DataFrame, url: str = "url", blocked: str = "blocked", *, min_support: float = 0.005,
         min_confidence: float = 0.6, min_lift: float = 1.5) -> DataFrame:
    """``rule_id, rule_tokens, confidence, support``: pruned rules for blocking."""
    mined, items = baskets(labelled, url, blocked, min_support)
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(mined)
    rules = model.associationRules.filter(
        (F.element_at("consequent", 1) == BLOCK) & (F.col("lift") >= min_lift)).select(
        F.array_sort("antecedent").alias("rule_tokens"), "confidence", "support")
    rules = written(rules.withColumn("rule_id", F.xxhash64("rule_tokens")), "rules")
    part = rules.withColumn("token", F.explode("rule_tokens"))
    fewer = rules.select(F.col("rule_id").alias("less_id"), F.col("rule_tokens").alias("less"),
                         F.col("confidence").alias("less_confidence"), F.element_at("rule_tokens", 1).alias("token"))
    beaten = (part.join(fewer, "token")
              .filter((F.size("less") < F.size("rule_tokens")) & (F.col("less_confidence") >= F.col("confidence"))
                      & (F.size(F.array_except("less", "rule_tokens")) == 0)).select("rule_id").distinct())
    kept = rules.join(beaten, "rule_id", "left_anti").withColumn("item", F.explode("rule_tokens"))
    named = kept.join(items, "item").groupBy("rule_id", "confidence", "support").agg(F.collect_list("same").alias("each"))
    start = F.array(F.array().cast("array<string>"))
    every = F.aggregate("each", start, lambda made, same: F.flatten(F.transform(
        made, lambda left: F.transform(same, lambda t: F.concat(left, F.array(t))))))
    named = named.select(F.explode(every).alias("rule_tokens"), "confidence", "support").withColumn(
        "rule_tokens", F.array_sort("rule_tokens"))
    return named.select(F.xxhash64("rule_tokens").alias("rule_id"), "rule_tokens", "confidence", "support")


def inverted_index(rules: DataFrame, urls: DataFrame, url: str = "url") -> DataFrame:
    """Each rule under the token that fewest urls have: ``token, rule_id, rule_tokens, confidence``."""
    part = rules.withColumn("token", F.explode("rule_tokens"))
    wanted = part.select("token").distinct()
    seen = (urls.select(F.explode(tokens(F.col(url))).alias("token")).join(wanted, "token", "left_semi")
            .groupBy("token").count())
    rarest = part.join(seen, "token").groupBy("rule_id").agg(F.min(F.struct("count", "token")).alias("least"))
    return rules.join(rarest, "rule_id").select(
        F.col("least.token").alias("token"), "rule_id", "rule_tokens", "confidence")


def matches(urls: DataFrame, index: DataFrame, url: str = "url") -> DataFrame:
    """``url, confidence, rule_tokens`` of the surest mined rule per url that has one."""
    all_tokens = tokens(F.col(url))
    hit = (urls.select(F.col(url).alias("__url"), all_tokens.alias("have"), F.explode(all_tokens).alias("token"))
           .join(index, "token").filter(F.size(F.array_except("rule_tokens", "have")) == 0))
    best = F.max(F.struct("confidence", F.negative(F.size("rule_tokens")).alias("short"), "rule_tokens"))
    return hit.groupBy("__url").agg(best.alias("best")).select(
        F.col("__url").alias(url), F.col("best.confidence").alias("confidence"), F.col("best.rule_tokens").alias("rule_tokens"))


def judge(pages: DataFrame, labels: DataFrame, key: str = "page_id", url: str = "url", **fit) -> DataFrame:
    """``key, host, path, rule, verdict, mined, confidence`` for each row of ``pages``.

    ``labels`` has ``key`` and a boolean ``blocked``; labels of unknown keys are not used.
    """
    plain = pages.select(F.col(key), F.col(url).alias("url"))
    known = labels.select(F.col(key).alias("__key"), "blocked").filter("__key IS NOT NULL AND blocked IS NOT NULL")
    rules = mine(plain.join(known, F.col(key) == F.col("__key")).select("url", "blocked"), **fit)
    # As many tasks as the session shuffles into: urls are small until their tokens are exploded.
    tasks = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    urls = plain.select("url").filter(F.instr("url", "://") > 0).repartition(tasks, "url").distinct()
    found = matches(urls, inverted_index(rules, urls)).withColumnRenamed("url", "__url")
    h, p = host(F.col("url")), path(F.col("url"))
    verdict = F.coalesce(F.col("listed.verdict"), F.when(F.col("rule_tokens").isNotNull(), "block").otherwise("allow"))
    return (plain.join(found, F.col("url") == F.col("__url"), "left")
            .withColumns({"host": h, "path": p}).withColumn("listed", listed(F.col("host"), F.col("path")))
            .select(key, "host", "path", F.col("listed.rule").alias("rule"), verdict.alias("verdict"),
                    F.array_join("rule_tokens", " ").alias("mined"), "confidence"))
