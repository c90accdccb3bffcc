"""Python surface: contracts, validation, derived views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .contract.model import Contract, ContractError, change_step, compiled, release, resolved
from .operators import rules as R
from .operators import validate as V
from .operators.paths import fields

__all__ = ["Contract", "ContractError", "Validator", "change_step", "compiled", "release", "resolved", "validate_records"]


class Validator:
    """Validation of raw records against one contract (and a profile)."""

    def __init__(self, contract: Contract, profile: str | None = None):
        self.contract, self.profile = contract, profile
        self.schema = contract.schema(profile)
        self.fields = []
        for f in contract.selected(profile):
            codes = contract.vocabularies.get(f.get("vocabulary"), {})
            own = {k: f[k] for k in ("path", "type", "required", "pattern", "minimum", "maximum") if k in f}
            self.fields.append(own | ({"enum": list(codes["codes"])} if codes.get("enforcement") == "error" else {}))

    def issues(self, record: Column, typed: DataFrame) -> Column:
        """array<issue>: structure of the VARIANT record, then the rules and vocabularies on the typed columns."""
        structural = V.structural_issues(record, [f for f in self.fields if f["type"] in V._VARIANT])
        paths = {p for p, _ in fields(typed.schema)}
        rules = R.issues([r for r in self.contract.rules if set(R.rule_paths(r)) <= paths], typed.schema)
        found = [structural, rules]
        for f in self.contract.selected(self.profile):
            body = self.contract.vocabularies.get(f.get("vocabulary"), {})
            if body.get("enforcement") == "warning":
                found.append(V.vocabulary_issues(f["path"], list(body["codes"]), body.get("deprecated")))
        return F.concat(*found)

    def validate(self, records: DataFrame) -> DataFrame:
        """records (raw JSON text and VARIANT record) with typed columns, issues and valid."""
        groups = []
        for g in self.schema:
            cells = [F.try_variant_get("record", f"$['{g.name}']['{f.name}']", f.dataType.simpleString()).alias(f.name) for f in g.dataType]
            groups.append(F.struct(*cells).alias(g.name))
        typed = records.select("*", *groups)
        return typed.withColumn("issues", self.issues(F.col("record"), typed)).withColumn("valid", V.valid("issues"))


def validate_records(records: DataFrame, contract: Contract, profile: str | None = None) -> DataFrame:
    return Validator(contract, profile).validate(records)
