"""A fitted forest as SQL text over the columns of its rows.

The text is plain SQL: Spark evaluates it as a column, without building vectors, and another
engine can compute the same scores from it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.ml.features import CATEGORIES, FEATURE_ORDER

#: Labels that the text may name; of more, scoring needs the stored model.
MOST_LABELS = 10_000
_RULE = re.compile(r"(?:If|Else) \(feature (\d+) (<=|>|in|not in) (.*)\)$")


def code_sql(model: PipelineModel) -> dict[str, str]:
    """Code column -> expression over its category: the label's place, one more for any other."""
    indexer = next(stage for stage in model.stages if isinstance(stage, StringIndexerModel))
    found = {}
    for name, code, labels in zip(CATEGORIES, CATEGORIES.values(), indexer.labelsArray):
        if len(labels) > MOST_LABELS:
            raise ValueError(f"{name} has {len(labels)} values; an expression names at most {MOST_LABELS}")
        cases = " ".join(f"WHEN {_text(label)} THEN {_number(place)}" for place, label in enumerate(labels))
        rest = _number(len(labels)) if indexer.getHandleInvalid() == "keep" else "NULL"
        found[code] = f"CASE {name} {cases} ELSE {rest} END" if cases else rest
    return found


def forest_sql(forest: RandomForestRegressionModel) -> str:
    """The mean of the trees, each as nested CASEs over :data:`FEATURE_ORDER`."""
    trees = [_tree(iter(tree.toDebugString.splitlines()[1:])) for tree in forest.trees]
    return f"({' + '.join(trees)}) / {_number(len(trees))}"


def predict_by_sql(model: PipelineModel, df: DataFrame, column: str = "prediction") -> DataFrame:
    """``df`` with the model's prediction, NULL where a number is missing."""
    forest = model.stages[-1]
    coded = df.withColumns({code: F.expr(sql) for code, sql in code_sql(model).items()})
    numbers = [name for name in FEATURE_ORDER if name not in CATEGORIES.values()]
    whole = F.greatest(*[F.col(name).isNull() for name in numbers])
    return coded.withColumn(column, F.when(~whole, F.expr(forest_sql(forest)))).drop(*CATEGORIES.values())


def query_sql(model: PipelineModel, rows: str, shown: str = "*") -> str:
    """A SELECT over the table or subquery ``rows`` that adds ``prediction``; no number may be missing."""
    codes = ", ".join(f"{sql} AS {code}" for code, sql in code_sql(model).items())
    return f"SELECT {shown}, {forest_sql(model.stages[-1])} AS prediction FROM (SELECT *, {codes} FROM {rows}) AS coded"


def _tree(lines: Iterator[str]) -> str:
    """One node and all below it, from the lines of the printed tree."""
    line = next(lines).strip()
    if line.startswith("Predict: "):
        return _number(float(line.removeprefix("Predict: ")))
    index, relation, value = _RULE.match(line).groups()
    feature = FEATURE_ORDER[int(index)]
    if relation == "<=":
        rule = f"{feature} <= {_number(float(value))}"
    elif relation == "in":
        codes = ", ".join(_number(float(code)) for code in value.strip("{}").split(","))
        rule = f"{feature} IN ({codes})"
    else:
        raise ValueError(f"a branch begins with {line!r}")
    left = _tree(lines)
    next(lines)  # the same rule, denied
    return f"CASE WHEN {rule} THEN {left} ELSE {_tree(lines)} END"


def _number(value: float) -> str:
    """A double in either dialect: one with an exponent."""
    shown = repr(float(value))
    return shown if "e" in shown else f"{shown}e0"


def _text(label: str) -> str:
    return "'" + label.replace("'", "''") + "'"
