"""One callable per registered query: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.contract.tables import (
    benchmark_questions,
    chunks,
    documents,
    flat,
    gold,
    private_namespace,
    questions,
    silver,
    silver_lookup,
    spaceless_chunks,
    spaceless_questions,
    stored_index,
    table,
)
from ledgerloom.functions import parse_order_id, user_slug
from ledgerloom.catalog import install_order_lookup, install_rule_search
from ledgerloom.operators.answers import (
    answer,
    compare,
    evidence,
    record_request,
    requests_from,
    search_order_info,
)
from ledgerloom.operators.index import build_index, in_namespace, index_report
from ledgerloom.operators.bootstrap import difference_intervals, evaluate_intervals
from ledgerloom.operators.model import apply_model, apply_model_once, prompt
from ledgerloom.operators.scoring import delta_summary, evaluate, evaluate_delta, score_cases
from ledgerloom.operators.passages import chunk
from ledgerloom.operators.search import search_rules
from ledgerloom.operators.segments import GrowingIndex
from ledgerloom.operators.vectors import centroids, search_vectors
from ledgerloom.plans import reports
from ledgerloom.plans.medallion import set_up, to_gold
from ledgerloom.plans.rolling import RollingGold
from ledgerloom.session import open_namespace, session_facts
from ledgerloom.sinks import create_once, publish, replace_table
from ledgerloom.sources import landing_files, read_bronze, read_documents
from ledgerloom.sources.documents import first_line
from ledgerloom.staging import fresh_path, stage
from ledgerloom.streaming import ingest_evolving, ingest_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        return build

    return register


# Sources


@query("scan_orders")
def scan_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice"
    )


@query("bronze_orders")
def bronze_orders(spark, sf_dir):
    return read_bronze(spark, f"{sf_dir}/orders.parquet")


@query("bronze_stream_events")
def bronze_stream_events(spark, sf_dir):
    """Events land in four drops; the last two arrive after a first run, and the very
    last has one more column."""
    events = table(spark, sf_dir, "events")
    landing = fresh_path(spark, "landing")
    target, checkpoint = fresh_path(spark, "events"), fresh_path(spark, "progress")
    drop = F.pmod("event_id", F.lit(4))

    def arrive(number: int, rows: DataFrame) -> None:
        rows.where(drop == number).write.parquet(f"{landing}/drop{number}")

    noted = events.withColumn("note", F.concat("event_type", F.lit("!")))
    arrive(0, events)
    arrive(1, events)
    ingest_files(spark, f"{landing}/*", target, checkpoint, noted.schema)
    arrive(2, events)
    arrive(3, noted)
    for _ in range(2):
        stored = ingest_files(spark, f"{landing}/*", target, checkpoint, noted.schema)
    return stored.select(
        *events.columns, "note", F.col("source_file").isNotNull().alias("has_source")
    )


@query("bronze_evolving_events")
def bronze_evolving_events(spark, sf_dir):
    """Events land in four drops, of which the last two have one more column; no schema is
    given, and a last run finds nothing new."""
    events = table(spark, sf_dir, "events")
    landing, progress = fresh_path(spark, "landing"), fresh_path(spark, "progress")
    drop = F.pmod("event_id", F.lit(4))
    noted = events.withColumn("note", F.concat("event_type", F.lit("!")))
    with private_namespace(spark) as private:
        name = open_namespace(spark, **private).table("events_bronze")
        for number, rows in enumerate((events, events, noted, noted)):
            rows.where(drop == number).write.parquet(f"{landing}/drop{number}")
            if number:
                ingest_evolving(spark, f"{landing}/*", name, progress)
        stored = ingest_evolving(spark, f"{landing}/*", name, progress)
        return stored.select(*events.columns, "note", F.col("source_file").isNotNull().alias("has_source"))


def land_items(spark: SparkSession, sf_dir: str) -> str:
    """A folder with one text file per benchmark item, its number in the path. The writer
    ends each file with a line end."""
    folder = fresh_path(spark, "items")
    items = table(spark, sf_dir, "benchmark").select("item_id", F.coalesce("text", F.lit("")))
    items.repartition("item_id").write.partitionBy("item_id").text(folder)
    return folder


def item_number(path: str) -> Column:
    return F.regexp_extract(path, r"item_id=(\d+)/", 1).cast("bigint").alias("item_id")


@query("landing_files")
def landing_files_list(spark, sf_dir):
    found = landing_files(spark, land_items(spark, sf_dir), "*.txt")
    return found.select(item_number("path"), "n_bytes")


@query("documents_from_files")
def documents_from_files(spark, sf_dir):
    found = read_documents(spark, land_items(spark, sf_dir))
    text = F.substring("text", F.lit(1), F.length("text") - 1)
    return found.select(item_number("doc_id"), "title", text.alias("text"), "format")


@query("rules_documents")
def rules_documents(spark, sf_dir):
    return documents(spark, sf_dir)


# Namespace and sinks


@query("session_scalars")
def session_scalars(spark, sf_dir):
    facts = [fact.alias(name) for name, fact in session_facts(spark).items()]
    return table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(
        F.count("*").alias("n_orders")
    ).select("*", *facts)


@query("user_slug")
def user_slugs(spark, sf_dir):
    user = F.concat("c_name", F.lit("."), "c_mktsegment", F.lit("@desk.example"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", user_slug(user).alias("schema_name")
    )


@query("namespace_setup")
def namespace_setup(spark, sf_dir):
    inputs = [table(spark, sf_dir, t) for t in ("orders", "customer", "nation")]
    with private_namespace(spark) as private:
        before = spark.catalog.currentCatalog()
        set_up(spark, *inputs, **private)
        made = set_up(spark, *inputs, **private)
        slug = user_slug(F.col("user_name"), private["prefix"])
        return made.status().select(
            "table_name",
            "n_rows",
            (F.col("schema_name") == slug).alias("is_slug_of_user"),
            (F.col("catalog_name") == before).alias("is_fallback_catalog"),
            (F.lit(spark.catalog.currentDatabase()) == F.col("schema_name")).alias("is_current"),
        )


@query("ctas_idempotent")
def ctas_idempotent(spark, sf_dir):
    with private_namespace(spark) as private:
        ns = open_namespace(spark, **private)
        create_once(silver(spark, sf_dir), ns.table("orders_silver"))
        again = create_once(table(spark, sf_dir, "orders"), ns.table("orders_silver"))
        return flat(again, "order_amount", to="double")


@query("overwrite_table")
def overwrite_table(spark, sf_dir):
    with private_namespace(spark) as private:
        ns = open_namespace(spark, **private)
        name = ns.table("sales")
        create_once(silver(spark, sf_dir), name)
        replaced = replace_table(to_gold(spark.table(name)), name)
        return flat(replaced, "total_sales", "avg_order_value")


@query("publish_table")
def publish_table(spark, sf_dir):
    """Three versions under one name; the last is made from the one before."""
    with private_namespace(spark) as private:
        name = open_namespace(spark, **private).table("sales")
        publish(table(spark, sf_dir, "orders"), name)
        publish(silver(spark, sf_dir), name)
        return flat(publish(to_gold(spark.table(name)), name), "total_sales", "avg_order_value")


@query("record_request")
def request_log(spark, sf_dir):
    sent = requests_from(questions(spark, sf_dir))
    with private_namespace(spark) as private:
        log = open_namespace(spark, **private).table("requests")
        record_request(sent.unionByName(sent), log)
        record_request(sent, log)
        return spark.table(log)


# Refined tables and reports


@query("orders_silver")
def orders_silver(spark, sf_dir):
    return flat(silver(spark, sf_dir), "order_amount", to="double")


@query("sales_monthly_gold")
def sales_monthly_gold(spark, sf_dir):
    return flat(gold(spark, sf_dir), "total_sales", "avg_order_value")


@query("sales_gold_rolling")
def sales_gold_rolling(spark, sf_dir):
    """Orders come in three batches. Of the first, many have a wrong price, date or customer;
    the others bring the orders it lacks and correct it, and one is applied twice."""
    orders, customer, nation = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    kind = F.pmod("o_orderkey", F.lit(5))
    early = orders.where(kind < 4).withColumns(
        {
            "o_totalprice": F.when(kind == 0, F.col("o_totalprice") * 2 + 1).otherwise(F.col("o_totalprice")),
            "o_orderdate": F.when(kind == 1, F.add_months("o_orderdate", 40)).otherwise(F.col("o_orderdate")),
            "o_custkey": F.when(kind == 2, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")),
        }
    )
    with private_namespace(spark) as private:
        rolling = RollingGold(spark, open_namespace(spark, **private))
        rolling.apply(1, early, customer, nation)
        late = orders.where(kind.isin(0, 4))
        rolling.apply(2, late, customer, nation)
        rolling.apply(2, late, customer, nation)
        rolling.apply(3, orders.where(kind.isin(1, 2)), customer, nation)
        return flat(rolling.gold(), "total_sales", "avg_order_value")


@query("dash_monthly_sales")
def dash_monthly_sales(spark, sf_dir):
    return flat(reports.monthly_sales(gold(spark, sf_dir)), "total_sales")


@query("dash_segment_share")
def dash_segment_share(spark, sf_dir):
    return flat(reports.segment_share(gold(spark, sf_dir)), "total_sales")


@query("dash_top_nations")
def dash_top_nations(spark, sf_dir):
    return flat(reports.top_nations(silver(spark, sf_dir), 10), "total_sales", to="double")


@query("dash_month_over_month")
def dash_month_over_month(spark, sf_dir):
    return flat(
        reports.month_over_month(gold(spark, sf_dir)), "total_sales", "previous_sales", "change"
    )


# Documents and search


@query("rules_chunks")
def rules_chunks(spark, sf_dir):
    return chunks(spark, sf_dir)


@query("rules_index")
def rules_index(spark, sf_dir):
    built = build_index(chunks(spark, sf_dir))
    return built.postings.select("term", "chunk_id", "tf", "n_terms")


@query("rules_vocabulary")
def rules_vocabulary(spark, sf_dir):
    return stored_index(spark, sf_dir).vocabulary.select("term", "df")


@query("index_report")
def rules_index_report(spark, sf_dir):
    return index_report(stored_index(spark, sf_dir))


@query("search_rules")
def search_rules_benchmark(spark, sf_dir):
    return search_rules(benchmark_questions(spark, sf_dir), stored_index(spark, sf_dir), 5)


@query("search_rules_by_postings")
def search_rules_by_postings(spark, sf_dir):
    asked, index = benchmark_questions(spark, sf_dir), stored_index(spark, sf_dir)
    return search_rules(asked, index, 5, "postings")


@query("search_rules_sql")
def search_rules_sql(spark, sf_dir):
    """One question, as the function takes one: the smallest of the benchmark."""
    asked = benchmark_questions(spark, sf_dir).agg(F.min("text")).first()[0]
    with private_namespace(spark) as private:
        ns = open_namespace(spark, **private)
        build_index(chunks(spark, sf_dir), in_namespace(ns))
        install_rule_search(spark, ns)
        found = spark.sql("SELECT * FROM search_rules(:asked, 5)", {"asked": asked})
        return stage(found, "found")


@query("search_order_info_sql")
def search_order_info_sql(spark, sf_dir):
    """The function over all ids that questions name, laterally."""
    asked = parse_order_ids(spark, sf_dir).where(F.col("order_id").isNotNull())
    with private_namespace(spark) as private:
        ns = open_namespace(spark, **private)
        create_once(silver(spark, sf_dir), ns.table("orders_silver"))
        install_order_lookup(spark, ns)
        found = spark.sql(
            "SELECT q.question_id, s.* FROM {asked} q, LATERAL search_order_info(q.order_id) s",
            asked=asked,
        )
        return flat(found, "order_amount", to="double")


@query("spaceless_chunks")
def spaceless_passages(spark, sf_dir):
    """Passages of texts without blanks, which end with sentences."""
    return spaceless_chunks(spark, sf_dir)


@query("search_grown_index")
def search_grown_index(spark, sf_dir):
    """Questions to an index after documents were added, removed and replaced."""
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    index = GrowingIndex(spark, fresh_path(spark, "grown"))
    index.add(chunk(texts.where("doc_id % 4 IN (0, 1)")))
    index.add(chunk(texts.where("doc_id % 4 = 2")))
    index.remove(texts.where("doc_id % 4 = 1"))
    index.add(chunk(texts.where("doc_id % 8 = 3")))
    amended = F.concat("text", F.lit(" amended"))
    index.add(chunk(texts.where("doc_id % 16 = 0").withColumn("text", amended)))
    return search_rules(benchmark_questions(spark, sf_dir), index.open(), 5)


@query("search_spaceless")
def search_spaceless(spark, sf_dir):
    """Questions to an index over texts without blanks."""
    index = build_index(spaceless_chunks(spark, sf_dir))
    return search_rules(spaceless_questions(spark, sf_dir), index, 5)


@query("search_vectors")
def search_vectors_centroids(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return search_vectors(centroids(vectors, "label"), vectors, 10)


# Questions and answers


@query("parse_order_id")
def parse_order_ids(spark, sf_dir):
    return questions(spark, sf_dir).select(
        "question_id", parse_order_id(F.col("text")).alias("order_id")
    )


@query("search_order_info")
def order_lookup(spark, sf_dir):
    ids = stage(parse_order_ids(spark, sf_dir), "parsed")
    found = search_order_info(ids, silver_lookup(spark, sf_dir))
    return flat(found, "order_amount", to="double")


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answer(
        questions(spark, sf_dir), silver_lookup(spark, sf_dir), stored_index(spark, sf_dir), 3
    )


@query("supervisor_answers")
def supervisor_answers(spark, sf_dir):
    given = answers(spark, sf_dir)
    return given.select(
        "question_id",
        "order_id",
        "order_date",
        "order_priority",
        F.col("order_amount").cast("double").alias("order_amount"),
        "customer_name",
        "market_segment",
        "nation",
        "order_found",
        "rules_found",
        F.coalesce(F.array_join("passages.chunk_id", " "), F.lit("")).alias("cited"),
        F.coalesce(F.array_join("passages.text", "\n"), F.lit("")).alias("passages"),
    )


@query("compare_routes")
def compare_routes(spark, sf_dir):
    index = stored_index(spark, sf_dir)
    return compare(evidence(questions(spark, sf_dir), silver_lookup(spark, sf_dir), index, 3))


# Models and scoring


@query("prompt_table")
def prompt_table(spark, sf_dir):
    asking = prompt("Summarise this document.", first_line(F.col("text")), F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", asking.alias("prompt"))


# A prompt with this in it makes the stand-in for a model fail.
SHOUT = "!! "


def length_class(prompts: pd.Series) -> pd.Series:
    """Stands in for a model: any function from prompts to answers will do. It fails on
    some prompts, as models do."""
    if prompts.str.contains(SHOUT, regex=False).any():
        raise ValueError("shouting")
    return prompts.str.len().ge(1000).map({True: "long", False: "short"})


@query("apply_model")
def apply_model_lengths(spark, sf_dir):
    asking = prompt("Is this document long?", F.col("text"))
    asked = table(spark, sf_dir, "documents").select("doc_id", asking.alias("prompt"))
    return apply_model(asked, F.col("prompt"), length_class, "answer").select(
        "doc_id", "answer", "answer_error"
    )


@query("apply_model_once")
def apply_model_once_lengths(spark, sf_dir):
    """The second run asks only what failed in the first."""
    asking = prompt("Is this document long?", F.col("text"))
    asked = table(spark, sf_dir, "documents").select("doc_id", asking.alias("prompt"))
    with private_namespace(spark) as private:
        store = open_namespace(spark, **private).table("answers")
        for _ in range(2):
            told = apply_model_once(asked, F.col("prompt"), length_class, "length", store, "answer")
        return told.select("doc_id", "answer", "answer_error")


def guesses(spark: SparkSession, sf_dir: str, least: int) -> DataFrame:
    """Documents called good when they have at least so many characters."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("case_id"),
        "lang",
        (F.col("n_chars") >= least).cast("int").alias("guess"),
    )


def expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(F.col("doc_id").alias("case_id"), "quality")


@query("evaluate_answers")
def evaluate_answers(spark, sf_dir):
    return evaluate(
        guesses(spark, sf_dir, 400), expected(spark, sf_dir), "guess", "quality", ["lang"]
    )


RESAMPLES = 100


@query("evaluate_intervals")
def evaluate_answers_intervals(spark, sf_dir):
    said, truth = guesses(spark, sf_dir, 400), expected(spark, sf_dir)
    return evaluate_intervals(said, truth, "guess", "quality", ["lang"], resamples=RESAMPLES)


@query("difference_intervals")
def difference_of_runs_intervals(spark, sf_dir):
    runs = [guesses(spark, sf_dir, least).select("case_id", "guess") for least in (400, 1500)]
    return difference_intervals(*runs, expected(spark, sf_dir), "guess", "quality", resamples=RESAMPLES)


def scored_run(spark: SparkSession, sf_dir: str, least: int) -> DataFrame:
    """Whether each labelled document is guessed right."""
    hit = (F.col("guess") == F.col("quality")).cast("double")
    tried = guesses(spark, sf_dir, least).join(expected(spark, sf_dir), "case_id")
    return tried.select("case_id", hit.alias("score"))


@query("evaluate_delta")
def evaluate_runs_delta(spark, sf_dir):
    return evaluate_delta(scored_run(spark, sf_dir, 400), scored_run(spark, sf_dir, 1500))


@query("delta_summary")
def delta_of_runs_summary(spark, sf_dir):
    return delta_summary(evaluate_runs_delta(spark, sf_dir))


@query("score_cases")
def score_lengths(spark, sf_dir):
    """Scores of any kind: how far off, and whether right."""
    said = guesses(spark, sf_dir, 400).select("case_id", "guess")
    scorers = {
        "off_by": F.abs(F.col("guess") - F.col("quality")),
        "right": F.col("guess").eqNullSafe(F.col("quality")),
    }
    return score_cases(said, expected(spark, sf_dir), scorers)
