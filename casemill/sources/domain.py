"""Domain contracts: one small YAML file becomes a typed contract and dimension tables."""

from __future__ import annotations

import json
import os
from copy import deepcopy
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from casemill import fixed

try:
    import yaml
except ImportError:  # JSON contracts still load
    yaml = None


@dataclass(frozen=True)
class Domain:
    """A contract. It holds what the rules compare against, never rows."""

    domain_id: str
    case_types: list[str]
    difficulties: list[int]
    scenarios: list[str]
    abilities: list[str] = field(default_factory=list)
    environments: list[str] = field(default_factory=list)
    route_codes: list[str] = field(default_factory=lambda: list(fixed.ROUTE_CODES))
    subcodes: list[str] = field(default_factory=list)
    novelty_threshold: float = fixed.NOVELTY_THRESHOLD
    max_design_retries: int = 2
    max_generation_retries: int = 2
    rules: dict = field(default_factory=dict)
    quality_gate_rules: list[str] = field(default_factory=list)
    rubric_gate_rules: list[str] = field(default_factory=list)
    output_schema: dict = field(default_factory=dict)
    case_schema: dict = field(default_factory=dict)

    @property
    def executable(self) -> bool:
        """Whether candidates carry a workspace that must run."""
        return self.domain_id == fixed.CODE_DOMAIN

    def minimum(self, rule: str, default: int) -> int:
        return int(self.rules.get(rule, default))

    def required(self, rule: str) -> bool:
        return bool(self.rules.get(rule, False))


def bind_case_schema(output_schema: dict, case_schema: dict) -> dict:
    """The output schema whose ``benchmark_case`` definition is the domain's own case schema."""
    if not output_schema or not case_schema:
        return output_schema
    bound = deepcopy(output_schema)
    definitions = bound.setdefault("$defs", {})
    definitions["benchmark_case"] = {k: v for k, v in deepcopy(case_schema).items() if k != "$schema"}
    return bound


def _parse(path: str, text: str) -> dict:
    if path.endswith(".json") or yaml is None:
        return json.loads(text)
    return yaml.safe_load(text)


def _read(path: str) -> str:
    with open(path, encoding="utf-8") as handle:
        return handle.read()


def domain_from(raw: dict, output_schema: dict | None = None) -> Domain:
    case_schema = raw.get("benchmark_case_schema") or {}
    named = {
        "rules": "deterministic_rules",
        "case_schema": "benchmark_case_schema",
    }
    values = {}
    for name in Domain.__dataclass_fields__:
        source = named.get(name, name)
        if name != "output_schema" and raw.get(source) is not None:
            values[name] = raw[source]
    values["output_schema"] = bind_case_schema(output_schema or raw.get("output_schema") or {}, case_schema)
    return Domain(**values)


def load_domain(path: str) -> Domain:
    """Parse a contract on the driver and bind its case schema into its output schema."""
    raw = _parse(path, _read(path))
    schema_path = raw.get("output_schema_path")
    output_schema = None
    if schema_path:
        if not os.path.isabs(schema_path):
            schema_path = os.path.join(os.path.dirname(path), schema_path)
        output_schema = json.loads(_read(schema_path))
    return domain_from(raw, output_schema)


def domain_tables(spark: SparkSession, domain: Domain) -> dict[str, DataFrame]:
    """The contract as dimension tables: allowed values, rules, gate rules and subcodes."""
    allowed = [
        (kind, str(value), position)
        for kind, values in (
            ("case_type", domain.case_types),
            ("difficulty", domain.difficulties),
            ("scenario", domain.scenarios),
            ("ability", domain.abilities),
            ("environment", domain.environments),
            ("route_code", domain.route_codes),
            ("subcode", domain.subcodes),
        )
        for position, value in enumerate(values)
    ]
    rules = [(name, json.dumps(value)) for name, value in sorted(domain.rules.items())]
    gates = [
        (gate, position, text)
        for gate, texts in (("quality", domain.quality_gate_rules), ("rubric", domain.rubric_gate_rules))
        for position, text in enumerate(texts)
    ]
    schema_texts = [("output", json.dumps(domain.output_schema)), ("benchmark_case", json.dumps(domain.case_schema))]
    return {
        "allowed": spark.createDataFrame(allowed, "kind string, value string, ord int"),
        "rules": spark.createDataFrame(rules, "rule string, value string"),
        "gate_rules": spark.createDataFrame(gates, "gate string, ord int, rule string"),
        "schemas": spark.createDataFrame(schema_texts, "name string, schema string"),
    }
