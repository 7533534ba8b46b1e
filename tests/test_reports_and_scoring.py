from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.model import apply_model, apply_model_once, prompt
from ledgerloom.operators.scoring import delta_summary, evaluate, evaluate_delta, score_cases
from ledgerloom.plans import reports

JAN, FEB = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)


@pytest.fixture(scope="module")
def gold(spark):
    rows = [
        (JAN, "A", 2, Decimal(30), Decimal(15)),
        (FEB, "A", 1, Decimal(45), Decimal(45)),
        (JAN, "B", 1, Decimal(90), Decimal(90)),
    ]
    return spark.createDataFrame(
        rows,
        "order_month timestamp, market_segment string, n_orders bigint, "
        "total_sales decimal(27,0), avg_order_value decimal(17,0)",
    )


def test_monthly_sales(gold):
    rows = {r[0]: r[1:] for r in reports.monthly_sales(gold).collect()}
    assert rows == {JAN: (3, 120), FEB: (1, 45)}
    assert {r[0]: r[2] for r in reports.monthly_sales(gold, "A").collect()} == {JAN: 30, FEB: 45}


def test_segment_share(gold):
    shares = {r[1]: r[3] for r in reports.segment_share(gold, JAN.date()).collect()}
    assert shares == {"A": 25.0, "B": 75.0}
    assert reports.segment_share(gold).count() == 3


def test_month_over_month(gold):
    rows = {(r[0], r[1]): r[2:] for r in reports.month_over_month(gold).collect()}
    assert rows["A", FEB] == (45, 30, 15, 50.0)
    assert rows["A", JAN] == (30, None, None, None)


def test_a_month_without_sales_is_not_skipped(spark, gold):
    april = spark.createDataFrame([(dt.datetime(2024, 4, 1), "A", 1, Decimal(9), Decimal(9))], gold.schema)
    rows = {(r[0], r[1]): r[2:] for r in reports.month_over_month(gold.union(april)).collect()}
    assert rows["A", dt.datetime(2024, 4, 1)] == (9, None, None, None)
    assert rows["A", FEB] == (45, 30, 15, 50.0)


def test_top_nations_break_ties_by_name(spark):
    silver = spark.createDataFrame(
        [("B", 5.0), ("A", 5.0), ("C", 1.0)], "nation string, order_amount double"
    )
    rows = [(r[0], r[1]) for r in reports.top_nations(silver, 2).collect()]
    assert rows == [("A", 1), ("B", 1)]


def test_prompt_leaves_nulls_out(spark):
    df = spark.createDataFrame([("x", None)], "a string, b string")
    made = df.select(prompt("Do.", F.col("a"), F.col("b"))).first()[0]
    assert made == "Do.\n\nx"


def test_a_bad_prompt_costs_only_its_own_answer(spark):
    def shout(prompts):
        if prompts.str.contains("bad").any():
            raise RuntimeError("cannot answer")
        return prompts.str.upper()

    given = [(i, "bad" if i == 7 else f"t{i}") for i in range(20)]
    df = spark.createDataFrame(given, "i int, t string")
    rows = {r["i"]: r for r in apply_model(df, F.col("t"), shout, "out", batch_rows=4).collect()}
    assert len(rows) == 20
    assert rows[7]["out"] is None and rows[7]["out_error"] == "RuntimeError: cannot answer"
    assert all(r["out"] == f"T{i}" and r["out_error"] is None for i, r in rows.items() if i != 7)


def test_models_may_return_numbers_and_must_answer_all(spark):
    df = spark.createDataFrame([("ab",), ("abc",)], "t string")
    numbers = apply_model(df, F.col("t"), lambda s: s.str.len(), "n", "int")
    assert sorted(r["n"] for r in numbers.collect()) == [2, 3]
    short = apply_model(df, F.col("t"), lambda s: s.iloc[:0], "n", "int").collect()
    assert all(r["n"] is None and "0 answers to 1 prompts" in r["n_error"] for r in short)


def test_a_bad_prompt_costs_few_calls(spark, tmp_path):
    log = str(tmp_path / "calls")

    def model(texts):
        with open(log, "a") as calls:
            calls.write(f"{len(texts)}\n")
        if texts.str.contains("bad").any():
            raise ValueError("no")
        return texts.str.upper()

    asked = spark.createDataFrame([(i, "bad" if i == 77 else f"t{i}") for i in range(256)], "i int, t string").coalesce(1)
    rows = {r["i"]: r for r in apply_model(asked, F.col("t"), model, "out").collect()}
    assert all((r["out"], r["out_error"]) == (f"T{i}", None) for i, r in rows.items() if i != 77)
    assert (rows[77]["out"], rows[77]["out_error"]) == (None, "ValueError: no")
    assert len(open(log).readlines()) == 1 + 2 * 8


def test_answers_are_paid_once(spark, tmp_path):
    log, store = str(tmp_path / "calls"), f"answers_{tmp_path.name}".lower()

    def model(texts):
        with open(log, "a") as calls:
            calls.write("\n".join([*texts, ""]))
        if texts.str.contains("bad").any():
            raise ValueError("no")
        return texts.str.upper()

    def ask(rows, name="m", **options):
        open(log, "w").close()
        df = spark.createDataFrame(rows, "answer int, t string")
        told = apply_model_once(df, F.col("t"), model, name, store, "out", **options).collect()
        assert sorted(r["answer"] for r in told) == sorted(r[0] for r in rows)
        for r in told:
            good = r["t"] is not None and "bad" not in r["t"]
            assert r["out"] == (r["t"].upper() if good else None)
            assert (r["out_error"] is None) == (good or r["t"] is None)
        return Counter(open(log).read().splitlines())

    rows = [(i, f"t{i % 20}") for i in range(90)] + [(90, None), (91, ""), (92, "")]
    assert ask(rows, portions=3) == Counter({f"t{i}": 1 for i in range(20)} | {"": 1})
    assert ask(rows) == Counter()
    more = ask([*rows, (93, "new"), (94, "bad one")])
    assert set(more) == {"new", "bad one"} and more["new"] <= 2
    assert ask([(1, "new"), (2, "bad one")]) == Counter({"bad one": 1})
    assert ask([(1, "new")], name="other model") == Counter({"new": 1})
    assert ask([]) == Counter()
    spark.sql(f"DROP TABLE {store}")


@pytest.fixture(scope="module")
def cases(spark):
    truths, answers = [(1, 1), (2, 1), (3, 0), (4, 0), (5, 1)], [(1, 1), (2, 0), (3, 1), (4, 0)]
    expected = spark.createDataFrame(truths, "case_id int, truth int")
    said = spark.createDataFrame([*answers, (9, 1)], "case_id int, said int")
    return said, expected


def test_evaluate(cases):
    said, expected = cases
    row = evaluate(said, expected, "said", "truth").first()
    assert (row["n_cases"], row["tp"], row["fp"], row["fn"]) == (5, 1, 1, 2)
    assert row["precision"] == 0.5 and row["recall"] == 0.333333
    assert row["f1"] == 0.4 and row["hit_rate"] == 0.4


def test_a_case_counts_once_however_often_it_is_predicted(spark):
    expected = spark.createDataFrame([(1, 1), (2, 1)], "case_id int, truth int")
    said = spark.createDataFrame([(1, 1), (1, 1), (1, 1), (2, 1), (2, 0)], "case_id int, said int")
    row = evaluate(said, expected, "said", "truth").first()
    assert (row["n_cases"], row["tp"], row["fn"]) == (2, 1, 1)
    twice = expected.union(expected)
    assert evaluate(said, twice, "said", "truth").first()["n_cases"] == 2


def test_measures_without_a_base_are_null(spark):
    none = spark.createDataFrame([], "case_id int, said int")
    negative = spark.createDataFrame([(1, 0)], "case_id int, truth int")
    row = evaluate(none, negative, "said", "truth").first()
    assert row["precision"] is None and row["recall"] is None and row["hit_rate"] == 1.0


def test_own_scorers(cases):
    said, expected = cases
    scored = score_cases(said, expected, {"exact": F.col("said").eqNullSafe(F.col("truth"))})
    assert {r["case_id"]: r["exact"] for r in scored.collect()} == {
        1: True, 2: False, 3: False, 4: True, 5: False,
    }


def test_delta(spark):
    schema = "case_id int, score double"
    a = spark.createDataFrame([(1, 0.0), (2, 1.0), (3, 0.5), (4, 1.0), (6, 0.0), (6, 1.0)], schema)
    b = spark.createDataFrame([(1, 1.0), (2, 0.0), (3, 0.5), (5, 1.0), (6, 0.5)], schema)
    delta = evaluate_delta(a, b)
    assert {r["case_id"]: r["change"] for r in delta.collect()} == {
        1: "improved", 2: "regressed", 3: "same", 4: "removed", 5: "added", 6: "same",
    }
    assert {r["change"]: r["n_cases"] for r in delta_summary(delta).collect()}["same"] == 2
