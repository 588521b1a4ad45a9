"""Data contracts: declared models, their constraints and relationships, tested as rules."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from dqspark.operators import rules as r
from dqspark.operators.evaluate import evaluate, union_results
from dqspark.operators.suites import rule_from_expectation


@dataclass(frozen=True)
class Field:
    type: str = "string"
    precision: int | None = None
    scale: int | None = None
    required: bool = False
    unique: bool = False
    primary_key: bool = False
    format: str | None = None
    references: str | None = None

    @property
    def sql_type(self) -> str:
        if self.precision is None:
            return self.type
        return f"{self.type}({self.precision},{self.scale or 0})"


@dataclass(frozen=True)
class Model:
    fields: Mapping[str, Field]
    primary_key: tuple[str, ...] = ()
    quality: tuple[r.Rule, ...] = ()

    def schema(self) -> StructType:
        return StructType.fromDDL(", ".join(f"`{n}` {f.sql_type}" for n, f in self.fields.items()))

    def rules(self) -> list[r.Rule]:
        """The declaration as rules; a constraint stated twice is tested once."""
        found: dict[tuple, r.Rule] = {}

        def add(rule: r.Rule) -> None:
            found.setdefault((rule.rule, rule.columns, rule.definition), rule)

        for name, f in self.fields.items():
            add(r.field_type(name, f.sql_type))
            if f.required or f.primary_key:
                add(r.not_null(name))
            if f.unique or f.primary_key:
                add(r.unique(name))
            if f.format == "uri":
                add(r.uri_format(name))
            if f.references:
                add(r.references(name, *f.references.split(".")))
        for name in self.primary_key:
            add(r.not_null(name))
        if len(self.primary_key) == 1:
            add(r.unique(self.primary_key[0]))
        elif self.primary_key:
            add(r.compound_unique(self.primary_key))
        return list(found.values()) + list(self.quality)


@dataclass(frozen=True)
class Relationship:
    model: str
    field: str
    to_model: str
    to_field: str


@dataclass(frozen=True)
class Contract:
    models: Mapping[str, Model]
    relationships: tuple[Relationship, ...] = field(default=())

    def rules(self, model: str) -> list[r.Rule]:
        rules = self.models[model].rules()
        stated = {rule.definition for rule in rules}
        for rel in self.relationships:
            if rel.model == model:
                rule = r.references(rel.field, rel.to_model, rel.to_field)
                if rule.definition not in stated:
                    rules.append(rule)
        return rules

    @classmethod
    def from_dict(cls, spec: Mapping[str, Any]) -> Contract:
        """From the dictionary form of a contract file: models, fields, quality, relationships."""
        models = {name: _model(m) for name, m in spec["models"].items()}
        ends = [(rel["from"], rel["to"]) for rel in spec.get("relationships", [])]
        return cls(
            models,
            tuple(Relationship(a["model"], a["field"], b["model"], b["field"]) for a, b in ends),
        )


def contract_from_draft(draft: DataFrame) -> Contract:
    """The contract that ``contract_from_tables`` drafted; a row per field comes to the driver."""
    models: dict[str, dict[str, Field]] = {}
    for row in sorted(draft.collect(), key=lambda row: (row["model"], row["position"])):
        fields = models.setdefault(row["model"], {})
        fields[row["field"]] = Field(row["type"], required=row["required"], unique=row["unique"])
    return Contract({name: Model(fields) for name, fields in models.items()})


def _model(spec: Mapping[str, Any]) -> Model:
    fields = {
        name: Field(
            type=f.get("type", "string"),
            precision=f.get("precision"),
            scale=f.get("scale"),
            required=f.get("required", False),
            unique=f.get("unique", False),
            primary_key=f.get("primaryKey", False),
            format=f.get("format"),
            references=f.get("references"),
        )
        for name, f in spec["fields"].items()
    }
    return Model(fields, tuple(spec.get("primaryKey", ())), tuple(_quality(q) for q in spec.get("quality", [])))


# The bounds that a contract's SQL check may state.
_COMPARISONS = {
    "mustBe": "=",
    "mustBeEqualTo": "=",
    "mustNotBe": "!=",
    "mustNotBeEqualTo": "!=",
    "mustBeGreaterThan": ">",
    "mustBeGreaterThanOrEqualTo": ">=",
    "mustBeLessThan": "<",
    "mustBeLessThanOrEqualTo": "<=",
}
_ABOUT = ("type", "query", "description", "name")


def _sql_quality(spec: Mapping[str, Any]) -> r.Rule:
    """A key that is not understood raises: a bound left out would let anything pass."""
    unknown = set(spec) - {*_ABOUT, *_COMPARISONS, "mustBeBetween", "mustSatisfy"}
    if unknown:
        raise ValueError(f"unknown keys in a quality check: {', '.join(sorted(unknown))}")
    must = tuple(f"{sign} {spec[key]}" for key, sign in _COMPARISONS.items() if spec.get(key) is not None)
    if spec.get("mustBeBetween") is not None:
        low, high = spec["mustBeBetween"]
        must += (f">= {low}", f"<= {high}")
    return r.contract_sql(spec["query"], must=must, must_satisfy=spec.get("mustSatisfy", ()))


def _quality(spec: Mapping[str, Any]) -> r.Rule:
    if spec["type"] == "sql":
        return _sql_quality(spec)
    check = spec["implementation"]
    if "expectation_type" in check:
        return rule_from_expectation(check["expectation_type"], check["kwargs"])
    if check["type"] == "row_count":
        return r.row_count(f"> {check['must_be_greater_than']}")
    raise ValueError(f"unknown quality check {check}")


def test_contract(tables: Mapping[str, DataFrame], contract: Contract) -> DataFrame:
    """All rules of all models; ``context`` is the model."""
    return union_results(
        [
            evaluate(tables[name], contract.rules(name), name, tables).select(F.lit(name).alias("context"), "*")
            for name in contract.models
        ]
    )


test_contract.__test__ = False  # a function of the library, not a test
