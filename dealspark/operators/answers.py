"""Answers of an injected model: batches in a fixed order, retries, an error row for a failed batch, records out of JSON, plans with their issues."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dealspark.functions.signals import json_object
from dealspark.operators.articles import plan_rules
from dealspark.operators.expectations import issues
from dealspark.operators.facts import clean_list
from dealspark.operators.selection import global_position
from dealspark.session import ship_package, task_count

#: Rows a batch is made of, records of an answer that count, tries for each batch.
BATCH, RECORDS, TRIES = 20, 12, 2
#: Caps of a plan's lists: fixed values.
PLAN_LISTS = {"depth_angles": 6, "chapter_directions": 7, "must_cover": 8, "avoid_patterns": 8}
PLAN = "core_question string, central_thesis string, narrative_focus string, deal_origin_chain string, initiation_mechanism string, strategic_objective string, title_direction string, structure_logic string, " + ", ".join(f"{c} array<string>" for c in PLAN_LISTS)


def answered(items: DataFrame, key: str, model: Callable[[int, pd.DataFrame], str], size: int = BATCH, tries: int = TRIES) -> DataFrame:
    """(batch, answer, error, tried): the model's answer for each run of ``size`` rows in the order of a unique key.

    ``model`` gets the number of the batch and its rows in order, in an executor. It is asked again where it raises or gives no text; after the last
    try the batch has a null answer and the error's text, and the others go on. A lost executor repeats its batches, so a model
    should answer alike; keep the result in a table before it is read twice. No rows make no batch.
    """
    ship_package(items.sparkSession)

    def ask(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        number, error = int(group[0]), None
        rows = rows.sort_values("__position").drop(columns=["__batch", "__position"]).reset_index(drop=True)
        for tried in range(1, tries + 1):
            try:
                answer = model(number, rows)
                if not isinstance(answer, str):
                    raise TypeError("the model gave no text")
                return pd.DataFrame({"batch": [number], "answer": [answer], "error": [None], "tried": [tried]})
            except Exception as e:  # noqa: BLE001: whatever a model raises fails its own batch only
                error = f"{type(e).__name__}: {e}"[:240]
        return pd.DataFrame({"batch": [number], "answer": [None], "error": [error], "tried": [tries]})

    placed = global_position(items, key, "__position").withColumn("__batch", F.floor(F.col("__position") / size))
    placed = placed.repartition(task_count(items), "__batch")  # a batch costs a call of the model, not its bytes
    return placed.groupBy("__batch").applyInPandas(ask, "batch long, answer string, error string, tried int")


def records(answers: DataFrame, field: str, schema: str, most: int = RECORDS) -> DataFrame:
    """The records that answers (batch, answer, error, tried) hold in a list: batch, place, tried, error and the fields of ``schema``.

    The first ``most`` objects of a list count; what isn't an object is passed over. An answer without JSON, or whose field is no list, gives one
    row with an error and no record, as a failed batch does; an empty list, or a missing field, gives no row.
    """
    found = answers.withColumn("__json", json_object(F.col("answer")))
    found = found.withColumn("__raw", F.get_json_object("__json", f"$.{field}"))
    listed = F.from_json("__raw", "array<string>")
    wrong = F.when(F.col("answer").isNull(), F.col("error")).when(F.col("__json").isNull(), "no JSON object").when(F.col("__raw").isNotNull() & ~F.startswith("__raw", F.lit("[")), f"{field} is no list")
    found = found.withColumns({"error": wrong, "__rows": F.slice(F.filter(F.coalesce(listed, F.array().cast("array<string>")), lambda r: F.startswith(r, F.lit("{"))), 1, most)})
    rows = F.when(F.col("error").isNotNull(), F.array(F.lit(None).cast("string"))).otherwise(F.col("__rows"))
    return found.select("batch", "tried", "error", F.posexplode(rows).alias("place", "__row")).select("batch", "place", "tried", "error", *[F.from_json("__row", schema)[f.name].alias(f.name) for f in StructType.fromDDL(schema)])


def model_records(items: DataFrame, key: str, model: Callable[[int, pd.DataFrame], str], field: str, schema: str, size: int = BATCH, most: int = RECORDS, tries: int = TRIES) -> DataFrame:
    """Records of all batches by batch and place, those of failed batches as errors. See ``answered`` and ``records``."""
    return records(answered(items, key, model, size, tries), field, schema, most)


def with_plan(answers: DataFrame, answer: str) -> DataFrame:
    """The rows with ``plan``, what an answer says as a narrative plan with clean, distinct and capped lists, and the plan's ``issues``.

    An answer without JSON is a plan without anything, so it has an issue for every rule.
    """
    raw = answers.withColumn("__plan", F.from_json(F.coalesce(json_object(F.col(answer)), F.lit("{}")), PLAN))

    def field(name: str) -> Column:
        value = F.col("__plan")[name]
        return clean_list(F.coalesce(value, F.array().cast("array<string>")), PLAN_LISTS[name]) if name in PLAN_LISTS else F.coalesce(value, F.lit(""))

    out = raw.withColumn("plan", F.struct(*[field(f.name).alias(f.name) for f in StructType.fromDDL(PLAN)])).drop("__plan")
    return out.withColumn("issues", issues(plan_rules(F.col("plan"))))
