"""Judges URLs by fixed rules and, where none fits, by mined association rules.

A URL is a set of tokens: its scheme, each ending of its host, the first directory and the
ending of its path, the names of its query's fields, and whether it has a fragment. The
document number that ends a page's path ties the page to a label. FP-growth finds frequent
combinations of tokens over all pages whose label says block; those that are sure enough
over all labelled pages are the rules. A rule blocks a URL that has all its tokens.

Rules are matched through an inverted index: each is listed once, under its rarest token,
and a URL looks up its own tokens. Only distinct URLs that no fixed rule settles are
looked up, so a URL that a third of all pages share is matched once.

A null URL, or one without ``://``, has an empty host and path and no tokens: no rule
fits, and it is allowed. Repeated page ids and URLs each keep their rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.staging import stage

# Host, path, verdict.
FIXED = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A rule is held by so many bad pages, of all pages that hold it at least this share is bad
# (the lower end of a 99 % interval), and it has at most so many items.
LEAST, CONFIDENCE, Z, LONGEST = 10, 0.6, 2.5758, 3
# The widest basket that FP-growth gets, which lists all its parts; a multiple of LONGEST.
WIDE = 9
PARTS = r"(?s)^(.*?)://([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, PARTS, 2), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 3), F.lit(""))


def fixed_rule(host: Column, path: Column) -> Column:
    """The longest rule that fits, as struct (rule, verdict), or null."""
    longest_first = sorted(FIXED, key=lambda r: -len(r[0] + r[1]))

    def fits(rule: tuple[str, str, str]) -> Column:
        return ((host == rule[0]) | host.endswith("." + rule[0])) & path.startswith(rule[1])

    def told(rule: tuple[str, str, str]) -> Column:
        return F.struct(F.lit(rule[0] + rule[1]).alias("rule"), F.lit(rule[2]).alias("verdict"))

    return reduce(
        lambda found, rule: F.when(fits(rule), told(rule)).otherwise(found),
        reversed(longest_first),
        F.lit(None).cast("struct<rule:string,verdict:string>"),
    )


def tokens(url: Column) -> Column:
    """The distinct tokens of a URL; none if it isn't one."""
    host, path = host_of(url), path_of(url)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    endings = F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.concat(F.lit("host="), F.array_join(F.slice(labels, n - i + 1, i), ".")),
    )
    names = F.transform(
        F.filter(F.split(F.regexp_extract(url, PARTS, 4), "&"), lambda f: f != ""),
        lambda f: F.concat(F.lit("field="), F.substring_index(f, "=", 1)),
    )
    ending = F.regexp_extract(path, r"(?s)[^/](/|\.[A-Za-z]+)$", 1)
    single = F.array(
        F.concat(F.lit("scheme="), F.translate(F.regexp_extract(url, PARTS, 1), UPPER, LOWER)),
        F.concat(F.lit("dir="), F.regexp_extract(path, r"(?s)^/([^/]*)/", 1)),
        F.concat(F.lit("ends="), ending),
        F.when(url.contains("#"), F.lit("fragment")),
    )
    all_ = F.array_distinct(F.array_compact(F.concat(endings, names, single)))
    return F.when(url.contains("://"), all_).otherwise(F.array().cast("array<string>"))


def labelled(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Tokens of the pages whose document is labelled, and whether it is to be blocked."""
    number = F.regexp_extract(path_of(F.col("url")), r"(?s)/(\d{1,18})(?:/|\.[A-Za-z]+)?$", 1)
    numbered = pages.select(
        tokens(F.col("url")).alias("tokens"),
        F.when(number != "", number.cast("long")).alias("doc_id"),
    ).where(F.col("doc_id").isNotNull())
    bad = (F.coalesce("toxic", F.lit(0)) == 1) | (F.coalesce("quality", F.lit(1)) == 0)
    marked = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(bad).alias("bad"))
    return numbered.join(marked, "doc_id").select("tokens", "bad")


def lower_bound(hits: Column, n: Column) -> Column:
    """The lower end of Wilson's interval for a share of ``hits`` in ``n``."""
    share, z = hits / n, F.lit(Z)
    spread = z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n))
    return (share + z * z / (2 * n) - spread) / (1 + z * z / n)


def pieces(items: Column) -> Column:
    """Parts of a basket, none wider than ``WIDE``, such that any ``LONGEST`` (3) items of
    it stand in a part together: every three of its groups of ``WIDE / 3`` items."""
    each = WIDE // LONGEST
    last = F.ceil(F.size(items) / each).cast("int") - 1
    some = F.filter(F.sequence(F.lit(0), last), lambda i: F.lit(True))

    def group(i: Column) -> Column:
        return F.slice(items, i * each + 1, F.lit(each))

    def from_(i: Column) -> Column:
        return F.filter(some, lambda j: j > i)

    split = F.flatten(
        F.flatten(
            F.transform(
                some,
                lambda i: F.transform(
                    from_(i),
                    lambda j: F.transform(from_(j), lambda k: F.concat(group(i), group(j), group(k))),
                ),
            )
        )
    )
    return F.when(F.size(items) <= WIDE, F.array(items)).otherwise(split)


def candidates(baskets: DataFrame) -> DataFrame:
    """Combinations (antecedent) of up to ``LONGEST`` items that FP-growth finds often enough
    among the bad pages; in wide baskets some are counted more than once.

    Equal parts are given to FP-growth ``LEAST`` times at most: what is met that often is
    frequent, however much oftener it is met.
    """
    parts = baskets.where("bad > 0").select(F.explode(pieces(F.col("items"))).alias("items"), "bad")
    often = parts.groupBy("items").agg(F.least(F.sum("bad"), F.lit(LEAST)).cast("int").alias("times"))
    given = stage(often.select("items", F.explode(F.array_repeat(F.lit(1), F.col("times")))).select("items"), "parts")
    n = given.count()
    if n < LEAST:
        return baskets.select(F.col("items").alias("antecedent")).limit(0)
    # Spark rounds the product of this share and n up to a whole number.
    model = FPGrowth(itemsCol="items", minSupport=(LEAST - 0.5) / n, minConfidence=CONFIDENCE).fit(given)
    return model.freqItemsets.where(F.size("items") <= LONGEST).select(F.array_sort("items").alias("antecedent"))


def looked_up(baskets: DataFrame, rules: DataFrame) -> DataFrame:
    """Baskets beside the rules of which they hold all items, by the rule's rarest item."""
    by_item = baskets.select("*", F.explode("items").alias("rarest"))
    whole = F.forall("antecedent", lambda t: F.array_contains(F.col("items"), t))
    return by_item.join(rules, "rarest").where(whole)


def mine(marked: DataFrame) -> DataFrame:
    """Rules (antecedent, confidence, rarest) that tell to block.

    Tokens that stand in too few bad pages go first. Tokens that stand in exactly the same
    labelled pages count as one item, told by two 64-bit sums of hashes; a rule with one of
    them needs them all. A rule has ``LONGEST`` items at most, is held by ``LEAST`` bad pages
    at least, and the lower bound of its confidence is ``CONFIDENCE``; none of that depends on
    how large the table is. Every candidate is counted over all labelled pages.
    """
    sets = stage(
        marked.groupBy(F.array_sort("tokens").alias("tokens")).agg(
            F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("bad")
        ),
        "sets",
    )
    one, two = F.xxhash64("tokens"), F.xxhash64(F.lit("second"), "tokens")
    held = sets.select(one.alias("one"), two.alias("two"), "n", "bad", F.explode("tokens").alias("token"))
    common = held.groupBy("token").agg(
        F.sum("n").alias("freq"), F.sum("bad").alias("bad"), F.count("*").alias("sets"),
        F.bit_xor("one").alias("one"), F.bit_xor("two").alias("two"),
    ).where(F.col("bad") >= LEAST)
    items = stage(
        common.groupBy("one", "two", "sets", "freq")
        .agg(F.min("token").alias("token"), F.array_sort(F.collect_list("token")).alias("members"))
        .select("token", "members", "freq"),
        "items",
    )
    cut = held.join(items.select("token"), "token").groupBy("one", "two", "n", "bad").agg(
        F.array_sort(F.collect_list("token")).alias("items")
    )
    baskets = stage(cut.groupBy("items").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), "baskets")
    item = items.select(F.col("token").alias("item"), "members", "freq")
    spread = candidates(baskets).distinct().withColumn("item", F.explode("antecedent")).join(item, "item")
    listed = stage(
        spread.groupBy("antecedent").agg(
            F.min_by("item", F.struct("freq", "item")).alias("rarest"),
            F.array_sort(F.flatten(F.collect_list("members"))).alias("all_tokens"),
        ),
        "candidates",
    )
    counted = looked_up(baskets, listed).groupBy("antecedent", "all_tokens", "rarest").agg(
        F.sum("n").alias("n"), F.sum("bad").alias("bad")
    )
    sure = (F.col("bad") >= LEAST) & (lower_bound(F.col("bad"), F.col("n")) >= CONFIDENCE)
    rules = stage(counted.where(sure), "rules")
    # A rule that holds all items of a shorter one blocks nothing more.
    drop_one = rules.select("antecedent", F.explode("antecedent").alias("item")).select(
        "antecedent", F.array_remove("antecedent", F.col("item")).alias("shorter")
    )
    known = rules.select(F.col("antecedent").alias("shorter"))
    needless = drop_one.join(known, "shorter", "left_semi").select("antecedent").distinct()
    return rules.join(needless, "antecedent", "left_anti").select(
        F.col("all_tokens").alias("antecedent"), (F.col("bad") / F.col("n")).alias("confidence"), "rarest"
    )


def blocked_urls(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The distinct URLs that have all tokens of some rule."""
    held = urls.select("url", tokens(F.col("url")).alias("items"))
    return looked_up(held, rules).select("url").distinct()


def judge(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """page_id, host, path, rule and verdict of every page."""
    rules = stage(mine(labelled(pages, labels)), "rules")
    told = pages.select(
        "page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    ).withColumn("fixed", fixed_rule(F.col("host"), F.col("path")))
    open_ = told.where(F.col("fixed").isNull() & F.col("url").isNotNull()).select("url").distinct()
    mined = stage(blocked_urls(open_, rules), "blocked").withColumn("mined", F.lit("block"))
    return told.join(mined, "url", "left").select(
        "page_id", "host", "path", F.col("fixed.rule").alias("rule"),
        F.coalesce("fixed.verdict", "mined", F.lit("allow")).alias("verdict"),
    )
