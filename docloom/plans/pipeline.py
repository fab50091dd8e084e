"""Pipelines from a YAML file: stages of operators over DataFrames, with a Parquet table per step to resume from."""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Any

import yaml
from pyspark.sql import DataFrame, SparkSession

import docloom.plans.operators  # noqa: F401  registers the operators
from docloom.plans.registry import OPERATORS, parameters
from docloom.schemas import DOMAINS, STEP_TYPES
from docloom.sources.sinks import Storage


def base_stage(name: str) -> str:
    """chunk_2 is a chunk stage."""
    return re.sub(r"_\d+$", "", name)


def errors(config: dict[str, Any]) -> list[str]:
    """Everything that is wrong with a configuration."""
    found = []
    if not config.get("stages"):
        return ["no stages"]
    for stage in config["stages"]:
        kind = base_stage(stage.get("name", ""))
        if kind not in STEP_TYPES:
            found.append(f"unknown stage {stage.get('name')}")
            continue
        for f in stage.get("functions", []):
            name, params = f.get("name"), f.get("params") or {}
            if (kind, name) not in OPERATORS:
                found.append(f"unknown operator {kind}/{name}")
                continue
            known = parameters(kind, name)
            found += [f"{kind}/{name}: unknown parameter {p}" for p in params if p not in known]
            found += [f"{kind}/{name}: missing parameter {p}" for p, needed in known.items() if needed and p not in params]
            own = (config.get("pipeline") or {}).get("collection_name")
            if "collection_name" in params and own is not None and params["collection_name"] != own:
                found.append(f"{kind}/{name}: collection_name is not the pipeline's {own}")
            for k, v in (params.get("added_metadata") or {}).items():
                if k in DOMAINS and v is not None and str(v).lower() not in DOMAINS[k]:
                    found.append(f"{kind}/{name}: {k} can't be {v}")
    return found


@dataclass
class Pipeline:
    config: dict[str, Any]

    @classmethod
    def load(cls, path: str) -> Pipeline:
        with open(path, encoding="utf-8") as file:
            return cls(yaml.safe_load(file))

    def run(self, spark: SparkSession) -> DataFrame:
        """Runs the stages after resume_from_step (0-based, that step itself is read) and returns the last result.

        All functions of a stage get the same input and their results are
        united; each stage is written before the next one reads it.
        """
        wrong = errors(self.config)
        if wrong:
            raise ValueError("; ".join(wrong))
        storage, own = Storage.of(self.config.get("storage") or {}), self.config.get("pipeline") or {}
        name = lambda n, s: f"{own.get('pipeline_id', 0)}/{n}_{s['name']}"
        resume, df = own.get("resume_from_step"), None
        for n, stage in enumerate(self.config["stages"]):
            if resume is not None and n <= resume:
                df = storage.read(spark, name(n, stage)) if n == resume else df
                continue
            parts = [OPERATORS[base_stage(stage["name"]), f["name"]](spark, df, **(f.get("params") or {})) for f in stage["functions"]]
            out = parts[0]
            for part in parts[1:]:
                out = out.unionByName(part, allowMissingColumns=True)
            df = spark.read.parquet(storage.write(out, name(n, stage)))
        return df
