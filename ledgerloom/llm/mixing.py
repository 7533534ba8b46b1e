"""Mixes sources to target weights by Sainte-Laguë apportionment.

A document's size is its number of words. Sources, in code point order with null last,
weigh 5, 2, 1, 5, 2, 1 and so on and share 1.5 times all words; no source gives more than
twice its words, and what that leaves over is shared again by weight.

Each source is dealt into shards of about ``SHARD_WORDS`` words by a hash of the id, and
each shard is a row of words, its documents in seeded order, cut into blocks of
``BLOCK_WORDS``. All blocks of the mix are seats that the shards claim with their blocks' part
of the source's target: the seats go to the highest quotients claim / (2 k - 1). The
quotient of the last seat is found by sums over all claims, many thresholds a job, so no
list of claims reaches the driver or one task. A shard with more seats than blocks is
taken whole as often as that fits; the blocks of the rest are picked by a seeded
permutation of its block numbers.

Null and empty texts have size 0 and are never taken; a null source is a source of its
own. Equal rows may swap their parts but the rows returned are the same. Other columns
are not looked at.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ledgerloom.llm.groups import text_key
from ledgerloom.llm.texts import slices, utf8, word_bounds
from ledgerloom.staging import stage

WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2.0
BLOCK_WORDS = 32
SHARD_WORDS = 1 << 18
SEED = 20_240_501
# Primes above every number of blocks in a shard: multiplying by one permutes them.
STRIDES = (2147483647, 2147483629, 2147483587, 2147483579)
THRESHOLDS = 40
RANGES = 64


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def numbered_sources(sized: DataFrame) -> DataFrame:
    """source, source_size and its weight by its place in code point order, null last.

    Sources are dealt by ranges; a place is the number of sources in earlier ranges plus
    that within the range.
    """
    totals = stage(
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .repartitionByRange(RANGES, F.col("source").asc_nulls_last())
        .withColumn("part", F.spark_partition_id()),
        "sources",
    )
    counted = totals.groupBy("part").agg(F.count("*").alias("n"))
    before = counted.select(
        "part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before")
    )
    inside = F.row_number().over(W.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    place = F.col("before") + inside - 1
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in WEIGHTS]), (place % len(WEIGHTS) + 1).cast("int")
    )
    return totals.join(before, "part").select("source", "source_size", weight.alias("weight"))


def targets(sized: DataFrame) -> DataFrame:
    """source, source_size and target; one aggregate per round of resharing."""
    sources = stage(numbered_sources(sized), "weights")
    most = MOST * F.col("source_size")
    rate, n_full = 0.0, -1
    while True:
        full = F.col("weight") * rate >= most
        row = sources.agg(
            F.sum("source_size").alias("all"),
            F.count(F.when(full, 1)).alias("n_full"),
            F.coalesce(F.sum(F.when(full, most)), F.lit(0.0)).alias("given"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("weights"),
        ).first()
        if not row["all"] or row["n_full"] == n_full or not row["weights"]:
            break
        n_full = row["n_full"]
        rate = (SHARE * row["all"] - row["given"]) / row["weights"]
    target = F.least(most, F.col("weight") * rate)
    return sources.select("source", "source_size", target.alias("target"))


def seats_above(claim: Column, quotient: Column | float) -> Column:
    """How many of the quotients claim / (2 k - 1) are at least ``quotient``."""
    return F.floor((claim / quotient + 1) / 2)


def apportion(claims: DataFrame, seats: int) -> DataFrame:
    """Adds ``seats`` by highest quotients of the column ``claim``.

    Seats that tie for the last places go by source and shard.
    """
    bounds = claims.where("claim > 0").agg(F.min("claim").alias("a"), F.max("claim").alias("b")).first()
    if not seats or bounds["a"] is None:
        return claims.withColumn("seats", F.lit(0).cast("long"))
    low, high = bounds["a"] / (2 * seats + 1), 2.0 * bounds["b"]
    claim = F.col("claim")
    while True:
        ratio = (high / low) ** (1 / (THRESHOLDS + 1))
        tried = sorted({min(high, max(low, low * ratio**i)) for i in range(1, THRESHOLDS + 1)} - {low, high})
        if not tried:
            middle = (low + high) / 2
            tried = [middle] if low < middle < high else []
        if not tried:
            break
        found = claims.agg(*[F.sum(seats_above(claim, q)).alias(f"q{i}") for i, q in enumerate(tried)]).first()
        enough = [q for q, n in zip(tried, found, strict=True) if n >= seats]
        fewer = [q for q, n in zip(tried, found, strict=True) if n < seats]
        low, high = max(enough, default=low), min(fewer, default=high)
        if low in found or any(n == seats for n in found):
            high = low
            break
        if math.nextafter(low, high) >= high:
            break
    if low == high:
        return claims.withColumn("seats", seats_above(claim, low).cast("long"))
    sure, tied = seats_above(claim, high), seats_above(claim, low) - seats_above(claim, high)
    left = seats - claims.agg(F.sum(sure)).first()[0]
    # Ties are added up in order: what earlier ranges hold, then within the range.
    place = [F.col("source").asc_nulls_last(), F.col("shard")]
    ties = stage(
        claims.where(tied > 0)
        .select("source", "shard", tied.alias("tied"))
        .repartitionByRange(RANGES, *place)
        .withColumn("part", F.spark_partition_id()),
        "ties",
    )
    counted = ties.groupBy("part").agg(F.sum("tied").alias("n"))
    before = counted.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"))
    upto = F.col("before") + F.sum("tied").over(W.partitionBy("part").orderBy(*place))
    last = ties.join(before, "part").select(
        "source", "shard",
        F.greatest(F.lit(0), F.least(F.col("tied"), left - upto + F.col("tied"))).alias("more"),
    )
    same = claims["source"].eqNullSafe(last["source"]) & (claims["shard"] == last["shard"])
    total = (sure + F.coalesce("more", F.lit(0))).cast("long")
    return claims.join(last, same, "left").select(claims["*"], total.alias("seats"))


def mixed(rows: DataFrame) -> DataFrame:
    """What the mix takes of each row of (doc_id, source, size, any others).

    Adds source_size, target, ``copies`` (how often the whole document is taken), and
    ``parts``: ranges of word numbers, (first, end), that are taken once more.
    """
    at_home = stage(rows, "sizes")
    goal = stage(targets(at_home), "targets")
    n_shards = F.ceil(F.greatest(F.col("source_size"), F.lit(1)) / SHARD_WORDS)
    dealt = at_home.alias("d").join(goal.alias("g"), F.col("d.source").eqNullSafe(F.col("g.source")))
    dealt = dealt.select(
        "d.*", "source_size", "target",
        F.pmod(F.xxhash64("doc_id", F.lit(SEED)), n_shards).alias("shard"),
    )
    claims = stage(
        dealt.groupBy("source", "shard").agg(
            F.sum("size").alias("shard_size"),
            F.first("source_size").alias("of"),
            F.first("target").alias("target"),
        ).select(
            "source", "shard",
            F.ceil(F.col("shard_size") / BLOCK_WORDS).alias("blocks"),
            F.when(
                F.col("of") > 0,
                F.col("target") / F.col("of") * F.ceil(F.col("shard_size") / BLOCK_WORDS) * BLOCK_WORDS,
            ).otherwise(0.0).alias("claim"),
        ),
        "claims",
    )
    total = claims.agg(F.sum("claim")).first()[0] or 0.0
    given = stage(apportion(claims, round(total / BLOCK_WORDS)), "quotas")
    quota = F.least(F.col("seats"), 2 * F.col("blocks"))
    given = given.select(
        F.col("source").alias("q_source"), F.col("shard").alias("q_shard"), "blocks",
        F.when(F.col("blocks") > 0, F.floor(quota / F.col("blocks"))).otherwise(0).alias("copies"),
        F.when(F.col("blocks") > 0, quota % F.col("blocks")).otherwise(0).alias("rest"),
        F.pmod(F.xxhash64("source", "shard", F.lit(SEED)), F.lit(2**30)).alias("shift"),
        F.element_at(
            F.array(*[F.lit(p).cast("long") for p in STRIDES]),
            (F.pmod(F.xxhash64("shard", "source", F.lit(SEED + 1)), F.lit(len(STRIDES))) + 1).cast("int"),
        ).alias("stride"),
    )
    order = W.partitionBy("source", "shard").orderBy(
        F.xxhash64("doc_id", F.lit(SEED + 2)), "doc_id", "size"
    )
    placed = dealt.withColumn(
        "end", F.sum("size").over(order.rowsBetween(W.unboundedPreceding, 0))
    ).withColumn("start", F.col("end") - F.col("size"))
    joined = placed.join(
        given, placed["source"].eqNullSafe(given["q_source"]) & (placed["shard"] == given["q_shard"])
    )
    picked = F.filter(
        F.sequence(F.floor(F.col("start") / BLOCK_WORDS), F.floor((F.col("end") - 1) / BLOCK_WORDS)),
        lambda i: (i * F.col("stride") + F.col("shift")) % F.col("blocks") < F.col("rest"),
    )
    parts = F.transform(
        picked,
        lambda i: F.struct(
            (F.greatest(i * BLOCK_WORDS, F.col("start")) - F.col("start")).alias("first"),
            (F.least((i + 1) * BLOCK_WORDS, F.col("end")) - F.col("start")).alias("end"),
        ),
    )
    kind = "array<struct<first:bigint,end:bigint>>"
    return joined.select(
        *rows.columns, "source_size", "target",
        F.when(F.col("size") > 0, F.col("copies")).otherwise(0).cast("long").alias("copies"),
        F.when((F.col("size") > 0) & (F.col("rest") > 0), parts).otherwise(F.array().cast(kind)).alias("parts"),
    )


def mix_documents(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and the number of words taken of each document."""
    plan = mixed(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    extra = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["end"] - p["first"])
    return plan.select(
        "doc_id", "size", "source_size", "target",
        (F.col("copies") * F.col("size") + extra).alias("taken"),
    )


@F.arrow_udf(T.StringType())
def cut_words(texts: pa.Array, parts: pa.Array) -> pa.Array:
    """The words of the ranges of each text, each range as it stands, parted by a space."""
    out = []
    for a, b in slices(texts, 8 << 20):
        data, offsets = utf8(texts.slice(a, b - a))
        starts, ends, first = word_bounds(data, offsets)
        line = data.tobytes()
        for i, ranges in enumerate(parts.slice(a, b - a).to_pylist()):
            at = first[i]
            spans = [(starts[at + r["first"]], ends[at + r["end"] - 1]) for r in ranges or []]
            out.append(" ".join(line[x:y].decode("utf-8", "replace") for x, y in spans))
    return pa.array(out, pa.string())


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of the mix: a document as often as it is taken whole, and its parts as one more.

    Rows of one id and text are numbered by source, taken or not, so that each meets its own
    row of the plan.
    """
    numbered = W.partitionBy("doc_id", "text_key").orderBy("source")
    keyed = docs.select(
        F.struct(*docs.columns).alias("row"), "doc_id", "source", text_key(F.col("text")).alias("text_key")
    )
    plan = mixed(keyed.select("doc_id", "source", word_count(F.col("row.text")).alias("size"), "text_key"))
    plan = plan.select(
        F.col("doc_id").alias("p_id"), F.col("text_key").alias("p_key"), "copies", "parts",
        F.row_number().over(numbered).alias("p_place"),
    ).where((F.col("copies") > 0) | (F.size("parts") > 0))
    rows = keyed.select("row", "doc_id", "text_key", F.row_number().over(numbered).alias("place"))
    same = F.col("doc_id").eqNullSafe(F.col("p_id")) & (F.col("text_key") == F.col("p_key"))
    met = rows.join(plan, same & (F.col("place") == F.col("p_place"))).withColumn(
        "cut", F.when(F.size("parts") > 0, cut_words(F.col("row.text"), F.col("parts")))
    )
    texts = F.concat(
        F.array_repeat("row.text", F.col("copies").cast("int")),
        F.when(F.size("parts") > 0, F.array("cut")).otherwise(F.array().cast("array<string>")),
    )
    taken = met.select("row", F.explode(texts).alias("taken"))
    return taken.select(
        *[
            F.col("taken").alias(c) if c == "text"
            else F.length("taken").cast("long").alias(c) if c == "n_chars"
            else F.col("row")[c].alias(c)
            for c in docs.columns
        ]
    )
