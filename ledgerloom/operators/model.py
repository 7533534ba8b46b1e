"""Applying a caller's model to a column, in batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.sinks import create_once
from ledgerloom.staging import stage


def prompt(instruction: str, *parts: Column) -> Column:
    """An instruction and the row's own text, separated by blank lines; nulls
    are left out."""
    return F.concat_ws("\n\n", F.lit(instruction), *parts)


def apply_model(
    df: DataFrame,
    prompts: Column,
    model: Callable[[pd.Series], pd.Series],
    out: str,
    returns: str = "string",
    batch_rows: int = 256,
) -> DataFrame:
    """``df`` with ``out``, the model's answer, and ``out_error``.

    ``model`` takes a series of prompts and returns as many answers. Only the
    prompts go to Python, as Arrow batches cut into ``batch_rows``. A batch that fails is
    halved until the prompts that fail are alone, so that a bad one costs only its own
    answer: the answer is null and ``out_error`` says why. Each bad prompt makes the model
    be called about twice log2 of ``batch_rows`` times; the good prompts beside it are sent
    again each time, which a model that is paid by the prompt charges again.
    """

    def run(texts: pd.Series) -> pd.DataFrame:
        if texts.empty:
            return pd.DataFrame({"answer": [], "error": []}, dtype=object)
        try:
            answers = list(model(texts.reset_index(drop=True)))
            if len(answers) != len(texts):
                raise ValueError(f"{len(answers)} answers to {len(texts)} prompts")
            return pd.DataFrame({"answer": answers, "error": [None] * len(answers)}, dtype=object)
        except Exception as error:  # noqa: BLE001 - any failure of the caller's model
            if len(texts) == 1:
                said = f"{type(error).__name__}: {error}"
                return pd.DataFrame({"answer": [None], "error": [said]}, dtype=object)
            half = len(texts) // 2
            return pd.concat([run(texts[:half]), run(texts[half:])], ignore_index=True)

    def in_batches(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in series:
            cut = [texts[i : i + batch_rows] for i in range(0, len(texts), batch_rows)] or [texts]
            yield pd.concat([run(piece) for piece in cut], ignore_index=True)

    in_batches.__annotations__ = {
        "series": Iterator[pd.Series], "return": Iterator[pd.DataFrame]
    }
    ask = F.pandas_udf(in_batches, f"answer {returns}, error string")
    asked = df.select("*", ask(prompts).alias("_model"))
    return asked.select(
        *df.columns,
        F.col("_model.answer").alias(out),
        F.col("_model.error").alias(f"{out}_error"),
    )


def apply_model_once(
    df: DataFrame,
    prompts: Column,
    model: Callable[[pd.Series], pd.Series],
    name: str,
    store: str,
    out: str,
    returns: str = "string",
    batch_rows: int = 256,
    portions: int = 1,
) -> DataFrame:
    """``df`` with ``out`` and ``out_error`` as of :func:`apply_model`; no answer is paid twice.

    The table ``store`` holds answers by model ``name`` and SHA-256 of the prompt. Only
    prompts it lacks are asked, each once however many rows share it; their answers are
    stored after each of ``portions`` parts, so a run that ends early has paid at most one
    part for nothing. Prompts that fail are not stored and are asked again by the next run.
    A null prompt is not asked and has no answer. Let one run at a time write to a store;
    ``name`` stands for the model with all its settings. A task that is run again, because
    its executor was lost, asks its prompts again.
    """
    spark = df.sparkSession
    empty = f"model string, prompt_sha256 string, answer {returns}"
    create_once(spark.createDataFrame([], empty), store)

    def answers() -> DataFrame:
        mine = spark.table(store).where(F.col("model") == name)
        return mine.groupBy("prompt_sha256").agg(F.first("answer").alias("answer"))

    asked = df.select(F.struct("*").alias("row"), F.sha2(prompts, 256).alias("prompt_sha256"))
    wanted = df.select(prompts.alias("prompt")).where("prompt IS NOT NULL")
    wanted = wanted.withColumn("prompt_sha256", F.sha2("prompt", 256))
    new = wanted.join(answers().select("prompt_sha256"), "prompt_sha256", "left_anti")
    fresh = stage(new.dropDuplicates(["prompt_sha256"]), "prompts")
    failed = []
    for part in range(portions):
        some = fresh.where(F.pmod(F.xxhash64("prompt_sha256"), F.lit(portions)) == part)
        told = apply_model(some, F.col("prompt"), model, "answer", returns, batch_rows)
        told = stage(told.drop("prompt"), "answers")
        good = told.where("answer_error IS NULL")
        good.select(F.lit(name).alias("model"), "prompt_sha256", "answer").write.insertInto(store)
        failed.append(told.where("answer_error IS NOT NULL").select("prompt_sha256", "answer_error"))
    errors = failed[0]
    for more in failed[1:]:
        errors = errors.unionByName(more)
    joined = asked.join(answers(), "prompt_sha256", "left").join(errors, "prompt_sha256", "left")
    return joined.select(
        "row.*", F.col("answer").alias(out), F.col("answer_error").alias(f"{out}_error")
    )
