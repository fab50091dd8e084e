"""Names of operators: (stage, name) to a function over DataFrames."""

from __future__ import annotations

import importlib
import inspect
import pkgutil
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from docloom.operators.features import chat_prompt, parsed_answer
from docloom.schemas import STEP_TYPES

OPERATORS: dict[tuple[str, str], Callable[..., DataFrame]] = {}


def operator(stage: str, name: str):
    """Registers a function (spark, df, **params) -> DataFrame; a second one of that name is an error."""
    if stage not in STEP_TYPES:
        raise ValueError(f"{stage} is not one of {STEP_TYPES}")

    def add(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        if (stage, name) in OPERATORS:
            raise KeyError(f"{stage}/{name} is registered already")
        OPERATORS[stage, name] = function
        return function

    return add


def parameters(stage: str, name: str) -> dict[str, bool]:
    """Parameter names and whether they are required, without spark and df."""
    own = list(inspect.signature(OPERATORS[stage, name]).parameters.values())[2:]
    return {p.name: p.default is inspect.Parameter.empty for p in own}


def listing(spark: SparkSession) -> DataFrame:
    rows = [(s, n, ", ".join(parameters(s, n))) for s, n in sorted(OPERATORS)]
    return spark.createDataFrame(rows, "stage STRING, name STRING, parameters STRING")


@dataclass(frozen=True)
class Prompt:
    """What a model is asked and how its answer is read: a system text, a column that makes the user's text, and the fields of the JSON answer with their fallbacks."""

    system: str
    user: Callable[..., Column]
    schema: str
    fallback: dict[str, str]

    def messages(self, *columns: Column) -> Column:
        return chat_prompt(self.system, self.user(*columns))

    def parsed(self, answer: Column) -> Column:
        return parsed_answer(answer, self.schema, self.fallback)


PROMPTS: dict[str, Prompt] = {}


def prompt(name: str, made: Prompt) -> Prompt:
    """Registers a prompt; a second one of that name is an error."""
    if name in PROMPTS:
        raise KeyError(f"prompt {name} is registered already")
    PROMPTS[name] = made
    return made


def discover(package: str) -> list[str]:
    """Imports all modules below a package, so that what they register is known; returns their names."""
    root = importlib.import_module(package)
    names = sorted(m.name for m in pkgutil.walk_packages(root.__path__, f"{package}."))
    for name in names:
        importlib.import_module(name)
    return names
