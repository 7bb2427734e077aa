"""Entity contracts: the schema of an entity and the rules its rows must meet."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from .rules import rules_from_constraints, validate_rules


@dataclass(frozen=True)
class Contract:
    entity: str
    schema: T.StructType
    constraints: tuple[str, ...]

    @property
    def rules(self) -> dict[str, str]:
        return rules_from_constraints(self.constraints)

    def to_json(self) -> str:
        return json.dumps(
            {
                "entity": self.entity,
                "schema": self.schema.jsonValue(),
                "constraints": list(self.constraints),
            },
            indent=2,
        )

    @classmethod
    def from_json(cls, text: str) -> Contract:
        document = json.loads(text)
        missing = {"entity", "schema", "constraints"} - document.keys()
        if missing:
            raise ValueError(f"contract lacks {sorted(missing)}")
        return cls(
            document["entity"],
            T.StructType.fromJson(document["schema"]),
            tuple(document["constraints"]),
        )

    def validate(self, spark: SparkSession) -> None:
        """Check names and constraints against the schema; runs no job."""
        names = [name.lower() for name in self.schema.fieldNames()]
        twice = sorted({name for name in names if names.count(name) > 1})
        if twice:
            raise ValueError(f"contract {self.entity!r} names {twice} more than once")
        validate_rules(spark.createDataFrame([], self.schema), self.rules)


def contract_path(directory: str, entity: str) -> str:
    return f"{directory.rstrip('/')}/{entity}.json"


def save_contract(spark: SparkSession, contract: Contract, directory: str) -> None:
    (
        spark.createDataFrame([(contract.to_json(),)], "value STRING")
        .coalesce(1)
        .write.mode("overwrite")
        .option("lineSep", "\n")
        .text(contract_path(directory, contract.entity))
    )


def load_contract(spark: SparkSession, directory: str, entity: str) -> Contract:
    """Read ``<directory>/<entity>.json`` from any file system Spark can reach."""
    row = spark.read.text(contract_path(directory, entity), wholetext=True).first()
    if row is None:
        raise FileNotFoundError(contract_path(directory, entity))
    contract = Contract.from_json(row["value"])
    contract.validate(spark)
    return contract
