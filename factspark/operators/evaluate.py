"""Evaluation: grading of answers, and the metrics of a graded set."""

from __future__ import annotations

import json
from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factspark.functions import text
from factspark.shipping import shipped

GRADES = ("CORRECT", "INCORRECT", "NOT_ATTEMPTED")
# Answers that say they are none.
NO_ANSWERS = ("i don t know", "i do not know", "unknown", "not sure", "i m not sure", "cannot answer", "i cannot answer", "no answer", "n a")


def grade(prediction: Column, answer: Column, aliases: Column) -> Column:
    """CORRECT if the answers are equal as names, NOT_ATTEMPTED if there is none; null where that doesn't decide."""
    norm = text.normalize_name(F.coalesce(prediction, F.lit("")))
    names = F.filter(F.transform(F.concat(F.array(answer), F.coalesce(aliases, F.array().cast("array<string>"))), text.normalize_name), lambda n: n.isNotNull() & (n != ""))
    no_answer = (norm == "") | norm.isin(*NO_ANSWERS)
    return F.when(no_answer, "NOT_ATTEMPTED").when(F.array_contains(names, norm), "CORRECT").when(~F.exists(names, lambda n: F.contains(norm, n) | F.contains(n, norm)), "INCORRECT")


def dataset(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """``(id, question, answer, answer_aliases)``, and further columns, of a dataset in JSON lines."""
    more = "".join(f", {c} string" for c in columns or [])
    return spark.read.schema(f"id string, question string, answer string, answer_aliases array<string>{more}").json(path)


def predictions(spark: SparkSession, path: str) -> DataFrame:
    """``(id, prediction)`` of a model's answers in JSON lines; of several for one id the first in order counts."""
    rows = spark.read.schema("id string, prediction string").json(path)
    return rows.groupBy("id").agg(F.min("prediction").alias("prediction"))


def graded(questions: DataFrame, answers: DataFrame, factory: Callable[[], GraderClient] | None = None) -> DataFrame:
    """Questions with ``prediction`` and ``grade``. A missing prediction is NOT_ATTEMPTED; what rules can't decide is the client's, or INCORRECT without one."""
    rows = questions.join(answers, "id", "left").withColumn("grade", grade(F.col("prediction"), F.col("answer"), F.col("answer_aliases")))
    if factory is not None:
        return grade_rest(rows, factory)
    return rows.withColumn("grade", F.coalesce("grade", F.lit("INCORRECT")))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def metrics(graded: DataFrame, grade_col: str = "grade", by: list[str] | None = None) -> DataFrame:
    """Counts, rates, accuracy (over all, and over those attempted) and their harmonic mean; 0 where a ratio has no base."""
    count = lambda g: F.count_if(F.col(grade_col) == g)
    c = graded.groupBy(*(by or [])).agg(F.count("*").alias("n"), *(F.coalesce(count(g), F.lit(0)).alias(g.lower()) for g in GRADES))
    c = c.withColumn("attempted", F.col("correct") + F.col("incorrect"))
    n = F.col("n")
    c = c.withColumns({
        "accuracy": _ratio(F.col("correct"), n), "correct_rate": _ratio(F.col("correct"), n), "incorrect_rate": _ratio(F.col("incorrect"), n), "not_attempted_rate": _ratio(F.col("not_attempted"), n), "attempt_rate": _ratio(F.col("attempted"), n),
        "accuracy_given_attempted": _ratio(F.col("correct"), F.col("attempted")),
    })
    a, b = F.col("accuracy"), F.col("accuracy_given_attempted")
    return c.withColumn("f1", _ratio(2 * a * b, a + b))


class GraderClient(ABC):
    """Grades what rules can't decide."""

    @abstractmethod
    def grade(self, question: str, answer: str, prediction: str) -> str:
        """One of the grades."""


def grade_rest(graded: DataFrame, factory: Callable[[], GraderClient], id_col: str = "id") -> DataFrame:
    """``graded`` with the grades of a client where the rules gave none (INCORRECT if it fails or answers something else)."""

    def ask(batches: Iterator) -> Iterator:
        client = factory()
        for pdf in batches:
            out = []
            for raw in pdf["payload"]:
                x = json.loads(raw)
                try:
                    got = client.grade(x.get("question", ""), x.get("answer", ""), x.get("prediction", ""))
                except Exception:  # a grader that fails grants nothing
                    got = "INCORRECT"
                out.append(got if got in GRADES else "INCORRECT")
            yield pdf[["id"]].assign(asked=out)

    kind = graded.schema[id_col].dataType.simpleString()
    asked = graded.where("grade is null").select(F.col(id_col).alias("id"), F.to_json(F.struct("question", "answer", "prediction")).alias("payload")).transform(shipped).mapInPandas(ask, f"id {kind}, asked string")
    return graded.join(asked.withColumnRenamed("id", "__id"), F.col(id_col) == F.col("__id"), "left").withColumn("grade", F.coalesce("grade", "asked")).drop("__id", "asked")
