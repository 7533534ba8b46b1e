"""Operators 4, 5 and 7: mixing, URL rules, quality."""

from __future__ import annotations

import itertools
import math
import zlib

import brute
import numpy as np
import pytest
from cases import plain, table
from pyspark.sql import functions as F

from ledgerloom.llm import mixing, quality, url_rules


def shares(sizes):
    """Targets by source, by hand: share, stop at twice the size, share again."""
    weights = dict(zip(sorted(sizes, key=lambda s: (s is None, (s or "").encode())), (5, 2, 1) * len(sizes)))
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        left = total - sum(2 * sizes[s] for s in full)
        open_ = [s for s in sizes if s not in full]
        rate = left / sum(weights[s] for s in open_) if open_ else 0
        more = {s for s in open_ if rate * weights[s] >= 2 * sizes[s]}
        if not more:
            return {s: 2.0 * sizes[s] if s in full else rate * weights[s] for s in sizes}
        full |= more


def sourced(spark):
    rows = []
    for i in range(400):
        source = [None, "b", "B", "é", "zz", "big", "big", "big", "", "tiny"][i % 10]
        n = 3 if source == "tiny" else 40 + i % 90
        rows.append((i, " \n".join(f"w{j}" for j in range(n)), "en", source, n))
    rows += [(900, None, "en", "b", 0), (901, "", "en", "void", 0), rows[1], rows[1]]
    rows.append((None, "one two", "en", "b", 2))
    return rows


@pytest.mark.parametrize("shard_words", [500, 1 << 18])
def test_sources_come_near_their_targets(spark, monkeypatch, shard_words):
    monkeypatch.setattr(mixing, "SHARD_WORDS", shard_words)
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 8)
    rows = sourced(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = mixing.mix_documents(docs).collect()
    assert len(found) == len(rows)
    source = {r[0]: r[3] for r in rows}
    sizes, taken, target = {}, {}, {}
    for d, _, _, s, n in rows:
        sizes[s] = sizes.get(s, 0) + n
    for r in found:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and 0 <= r["taken"] <= 2 * r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
        target[s] = r["target"]
    expected = shares(sizes)
    assert target == pytest.approx(expected)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(8 * (2 + math.ceil(sizes[s] / shard_words)), 0.01 * target[s])
        if target[s] == 2 * sizes[s]:
            assert taken[s] == target[s]
    assert plain(mixing.mix_documents(docs)) == plain(mixing.mix_documents(docs.repartition(7)))


def test_apportioning_gives_the_highest_quotients(spark):
    claims = {("a", 0): 100.0, ("a", 1): 70.0, ("b", 0): 70.0, ("b", 1): 70.0, ("c", 0): 1.0, (None, 0): 0.0}
    frame = spark.createDataFrame([(*k, v) for k, v in claims.items()], "source string, shard long, claim double")
    for seats in (0, 1, 2, 3, 7, 50, 311):
        given = {(r["source"], r["shard"]): r["seats"] for r in mixing.apportion(frame, seats).collect()}
        held = dict.fromkeys(claims, 0)
        for _ in range(seats):
            order = sorted(claims, key=lambda k: (-claims[k] / (2 * held[k] + 1), k[0] is None, k[0] or "", k[1]))
            held[order[0]] += 1
        assert given == held


def test_seats_of_many_equal_shards_go_in_order(spark):
    """Half of 5,000 shards with equal claims get a seat, those that come first."""
    names = ["b", "a", None]
    frame = spark.range(5000).selectExpr(
        "element_at(array('b', 'a', null), cast(id % 3 + 1 AS int)) AS source", "id AS shard", "8.0D AS claim"
    )
    given = {(r["source"], r["shard"]): r["seats"] for r in mixing.apportion(frame, 2500).collect()}
    order = sorted(given, key=lambda k: (k[0] is None, k[0] or "", k[1]))
    assert [given[k] for k in order] == [1] * 2500 + [0] * 2500 and {k[0] for k in order} == set(names)


def test_mixed_documents_hold_what_was_taken(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 8)
    rows = sourced(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    plan, got = {}, {}
    for r in mixing.mix_documents(docs).collect():
        plan[r["doc_id"]] = plan.get(r["doc_id"], 0) + r["taken"]
    made = mixing.mixed_documents(docs)
    assert made.columns == docs.columns
    texts = {r[0]: r[1] or "" for r in rows}
    for r in made.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + len(brute.words(r["text"]))
        assert set(brute.words(r["text"])) <= set(brute.words(texts[r["doc_id"]])) and r["text"]
        assert r["n_chars"] == len(r["text"])
    assert got == {d: n for d, n in plan.items() if n}


def test_mixing_nothing(nothing, spark):
    assert mixing.mix_documents(nothing).count() == mixing.mixed_documents(nothing).count() == 0
    empty = table(spark, [(1, ""), (2, None)])
    assert [r["taken"] for r in mixing.mix_documents(empty).collect()] == [0, 0]
    assert mixing.mixed_documents(empty).count() == 0


def judged(url):
    """Host, path and fixed rule, by hand."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, tail = rest[:cut].translate(brute.LOWER), rest[cut:]
    path = tail[: min((tail.find(c) for c in "?#" if c in tail), default=len(tail))]
    fits = [
        (h + p, v) for h, p, v in url_rules.FIXED
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    rule, verdict = max(fits, key=lambda f: len(f[0]), default=(None, None))
    return host, path, rule, verdict


def pages():
    urls = [
        None, "", "no scheme", "http://", "HTTP://A.Example.NET/en/1?x=1#y", "https://example.net/fr/2",
        "x://net", "x://net/", "x://mynet/", "ftp://É.org/fr/3?a://b/", "https://a.example.com/de/4.html",
        "https://example.com.de/", "a://b://c/d", "https://w.example.org?q=/fr/", "https://h\n.net/\n",
    ]
    made = list(enumerate(urls))
    # A host whose pages are mostly bad, and one whose pages are not.
    made += [(100 + i, f"https://spam.example.com/en/{i}") for i in range(40)]
    made += [(200 + i, f"https://good.example.com/en/{i + 40}?ref=x") for i in range(40)]
    made += [(300, "https://spam.example.com/en/"), (301, "https://spam.example.com/en/")]
    return made


@pytest.fixture(scope="module")
def web(spark):
    labels = [(i, 1, 1 if i < 36 else 0) for i in range(40)] + [(i + 40, 1, int(i == 0)) for i in range(40)]
    labels += [(None, 1, 1), (3, 0, None)]
    return (
        spark.createDataFrame(pages(), "page_id long, url string").withColumn("rule", F.lit("clash")),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_urls_are_judged_by_rule_and_else_by_what_was_mined(web):
    found = {r["page_id"]: tuple(r)[1:] for r in url_rules.judge(*web).collect()}
    assert len(found) == len(pages())
    for page, url in pages():
        host, path, rule, verdict = judged(url)
        mined = "block" if host == "spam.example.com" else "allow"
        assert found[page] == (host, path, rule, verdict or mined), url


def test_mined_rules_equal_a_count_by_hand(web):
    marked = [(set(r["tokens"]), r["bad"]) for r in url_rules.labelled(*web).collect()]
    rules = url_rules.mine(url_rules.labelled(*web)).collect()
    assert rules
    for r in rules:
        held = [bad for tokens, bad in marked if set(r["antecedent"]) <= tokens]
        assert sum(held) >= url_rules.LEAST
        assert r["confidence"] == pytest.approx(np.mean(held)) and r["confidence"] >= url_rules.CONFIDENCE
        assert r["rarest"] in r["antecedent"]


def wide(spark, urls, bad):
    rows = [(i, f"{u[0]}/{i}?{u[1]}") for i, u in enumerate(urls)]
    labels = [(i, 1, int(b)) for i, b in enumerate(bad)]
    return spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(
        labels, "doc_id long, quality int, toxic int"
    )


def test_many_fields_of_equal_pages_are_one_item(spark):
    fields = "&".join(f"f{j}={j}" for j in range(30))
    urls = [("https://a.com/x", fields)] * 12 + [("https://a.com/x", "g=1")] * 12
    (rule,) = url_rules.mine(url_rules.labelled(*wide(spark, urls, [1] * 12 + [0] * 12))).collect()
    assert set(rule["antecedent"]) == {f"field=f{j}" for j in range(30)} and rule["confidence"] == 1


def test_wide_baskets_give_all_short_rules(spark, monkeypatch):
    """Fields in differing pages stay items of their own; every rule of up to three is found."""
    monkeypatch.setattr(url_rules, "CONFIDENCE", 0.5)
    rng = np.random.default_rng(5)
    chosen = [rng.random(14) < 0.75 for _ in range(120)]
    urls = [("https://a.com/x", "&".join(f"f{j}=1" for j in np.flatnonzero(c))) for c in chosen]
    bad = [int(c[2] and c[5] and c[7]) or int(rng.random() < 0.05) for c in chosen]
    marked = url_rules.labelled(*wide(spark, urls, bad))
    pages_ = [(set(r["tokens"]), r["bad"]) for r in marked.collect()]
    found = {tuple(r["antecedent"]): r["confidence"] for r in url_rules.mine(marked).collect()}
    # Tokens of every page are one item.
    same = {t for t in pages_[0][0] if all(t in held for held, _ in pages_)}
    items = [frozenset({t}) for t in sorted(set().union(*(h for h, _ in pages_)) - same)] + [frozenset(same)]

    def sure(parts):
        held = [b for tokens, b in pages_ if frozenset().union(*parts) <= tokens]
        n, hits = len(held), sum(held)
        if hits < url_rules.LEAST:
            return False
        z, p = url_rules.Z, hits / n
        low = (p + z * z / 2 / n - z * (p * (1 - p) / n + z * z / 4 / n / n) ** 0.5) / (1 + z * z / n)
        return low >= 0.5

    passing = {c for k in (1, 2, 3) for c in itertools.combinations(items, k) if sure(c)}
    sets = {frozenset(c) for c in passing}
    least = {s for s in sets if not any(s - {x} in sets for x in s)}
    assert {tuple(sorted(frozenset().union(*s))) for s in least} == set(found) and found


@pytest.mark.parametrize("others", [60, 6000])
def test_a_host_is_judged_alike_in_small_and_large_tables(spark, others):
    urls = [("https://bad.com/x", "q=1")] * 20 + [(f"https://h{i % 7}.org/y", "q=1") for i in range(others)]
    web = wide(spark, urls, [1] * 20 + [0] * others)
    blocked = url_rules.judge(*web).where("verdict = 'block'")
    assert {r["host"] for r in blocked.collect()} == {"bad.com"} and blocked.count() == 20


def test_a_url_of_very_many_fields(spark):
    urls = [("https://a.com/x", "&".join(f"f{j}=1" for j in range(20_000)))] * 2 + [("https://a.com/x", "g")] * 3
    assert url_rules.judge(*wide(spark, urls, [1, 1, 0, 0, 0])).where("verdict = 'allow'").count() == 5


def test_urls_without_labels_or_pages(web):
    urls, labels = web
    verdicts = {r["verdict"] for r in url_rules.judge(urls, labels.limit(0)).where("rule IS NULL").collect()}
    assert verdicts == {"allow"}
    assert url_rules.judge(urls.limit(0), labels).count() == 0


def lessons(spark):
    rng = np.random.default_rng(4)
    good, bad = ["ruhig", "lesen", "satz", "wort", "text"], ["BUY!!", "NOW!!", "$$$", "WIN!!"]
    rows, labels = [], []
    for i in range(240):
        kind = int(i % 4 > 0)
        some = rng.choice(good if kind else bad, 30)
        rows.append((i, " ".join(f"{w}{rng.integers(9)}" for w in some)))
        labels.append((i, kind, 0))
    rows += [(900, None), (901, ""), (902, "satz " * 20_000), (None, "lesen wort"), rows[0], rows[0]]
    labels += [(None, 0, 0), (5, None, None), (6, 7, 0), labels[0], (9999, 1, 0)]
    return table(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_labels_are_learned_and_held_out_ones_told(spark, monkeypatch):
    monkeypatch.setattr(quality, "STEPS", 2000)
    docs, labels = lessons(spark)
    found = quality.judge(docs, labels).collect()
    assert len(found) == docs.count()
    known = {r["doc_id"]: r["quality"] for r in labels.collect() if r["doc_id"] is not None and r["doc_id"] < 240}
    for r in found:
        out = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1
        assert r["held_out"] == out and 0 <= r["score"] <= 1
        assert r["predicted"] == int(r["score"] >= 0.5)
    held = [(r["predicted"], known[r["doc_id"]]) for r in found if r["held_out"] and r["doc_id"] in known and r["doc_id"] not in (5, 6)]
    assert len(held) > 50 and np.mean([p == q for p, q in held]) > 0.95
    again = quality.judge(docs.repartition(5), labels.repartition(3))
    for a, b in zip(plain(again), plain(quality.judge(docs, labels)), strict=True):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], abs=1e-9)


def test_held_out_labels_are_not_used(spark, monkeypatch):
    monkeypatch.setattr(quality, "STEPS", 300)
    docs, labels = lessons(spark)
    turned = labels.withColumn(
        "quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    assert plain(quality.judge(docs, turned)) == plain(quality.judge(docs, labels))


def test_quality_without_labels_or_documents(spark, nothing):
    docs, labels = lessons(spark)
    assert {r["score"] for r in quality.judge(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.judge(nothing, labels).count() == 0


def test_scores_are_those_of_averaged_vectors():
    import pyarrow as pa

    model = quality.Model(
        np.random.default_rng(1).normal(size=(quality.BUCKETS, 4)), np.array([[0.0] * 4, [1.0, 2, 3, 4]])
    )
    texts = pa.array(["a b a b a b", None, "été été", "x" * 300])
    for ids, parts in quality.counted(texts):
        assert parts.sum() == pytest.approx(1)
        mean = parts @ model.vectors[ids] @ model.layer[1]
        assert (parts * model.table()[ids]).sum() == pytest.approx(mean, rel=1e-5)
