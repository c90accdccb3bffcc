"""The contract: fields, rules, vocabularies and profiles, compiled from YAML sources on the driver.

A contract is control data of fixed size; records never pass through here.  A released contract is pinned by a digest."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field, replace
from functools import lru_cache
from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(), "integer": T.LongType(), "number": T.DoubleType(), "boolean": T.BooleanType(), "array_string": T.ArrayType(T.StringType()), "object_string": T.MapType(T.StringType(), T.StringType()),
    "array_link": T.ArrayType(T.StructType([T.StructField("mention", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])),
}
_FIELD_KEYS = {"path", "type", "required", "vocabulary", "key_role", "pattern", "minimum", "maximum", "since", "deprecated", "argument_role", "workflow_edge", "label", "availability"}


class ContractError(ValueError):
    """A contract source that cannot be used."""


@dataclass(frozen=True)
class Contract:
    version: str
    fields: tuple[dict, ...]
    rules: tuple[dict, ...] = ()
    vocabularies: dict[str, dict] = field(default_factory=dict)
    profiles: dict[str, dict] = field(default_factory=dict)

    @property
    def digest(self) -> str:
        body = {"fields": self.fields, "rules": self.rules, "vocabularies": self.vocabularies, "profiles": self.profiles, "version": self.version}
        return hashlib.sha256(json.dumps(body, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()

    def schema(self, profile: str | None = None) -> T.StructType:
        """Two-level StructType in the order of the sources; roles and vocabularies are field metadata."""
        groups: dict[str, list[T.StructField]] = {}
        for f in self.selected(profile):
            group, _, name = f["path"].partition(".")
            meta = {k: f[k] for k in ("key_role", "vocabulary", "argument_role", "workflow_edge") if k in f}
            groups.setdefault(group, []).append(T.StructField(name, _TYPES[f["type"]], True, meta))
        return T.StructType([T.StructField(g, T.StructType(fs)) for g, fs in groups.items()])

    def selected(self, profile: str | None = None) -> list[dict]:
        """The fields of a profile (all without one): availability codes and groups, with includes and excludes."""
        if profile is None:
            return list(self.fields)
        p = self.profile(profile)
        chosen = [f for f in self.fields if (not p.get("availability") or f.get("availability") in p["availability"]) and (not p.get("groups") or f["path"].split(".")[0] in p["groups"])]
        paths = {f["path"] for f in chosen} | set(p.get("include", ()))
        return [f for f in self.fields if f["path"] in paths - set(p.get("exclude", ()))]

    def profile(self, name: str) -> dict:
        """A profile merged over the ones it extends."""
        own, seen = self.profiles.get(name), []
        if own is None:
            raise ContractError(f"no profile {name}")
        chain = [own]
        while base := chain[-1].get("extends"):
            if base in seen or base not in self.profiles:
                raise ContractError(f"profile {name} extends {base}, which is missing or in a circle")
            seen.append(base)
            chain.append(self.profiles[base])
        merged: dict = {}
        for p in reversed(chain):
            for k, v in p.items():
                merged[k] = {**merged[k], **v} if isinstance(v, dict) and isinstance(merged.get(k), dict) else v
        return merged

    def by_role(self, role: str) -> list[str]:
        return [f["path"] for f in self.fields if f.get("key_role") == role]

    def codes(self, vocabulary: str) -> list[str]:
        return list(self.vocabularies[vocabulary]["codes"])

    def tables(self, spark: SparkSession) -> dict[str, DataFrame]:
        """The contract as small tables: fields, rules, codes."""
        fields = [(i, f["path"], f["type"], bool(f.get("required")), f.get("vocabulary"), f.get("key_role")) for i, f in enumerate(self.fields)]
        codes = [(v, c, (d or {}).get("label")) for v, body in self.vocabularies.items() for c, d in body["codes"].items()]
        return {
            "fields": spark.createDataFrame(fields, "ordinal int, path string, type string, required boolean, vocabulary string, key_role string"),
            "rules": spark.createDataFrame([(r["id"], r["kind"], r.get("level", "error"), r.get("blocking", True)) for r in self.rules], "id string, kind string, level string, blocking boolean"),
            "codes": spark.createDataFrame(codes, "vocabulary string, code string, label string"),
        }


def checked(contract: Contract) -> Contract:
    """The contract, if its parts fit together."""
    from ..operators.rules import rule_paths

    paths = [f["path"] for f in contract.fields]
    for f in contract.fields:
        if unknown := set(f) - _FIELD_KEYS:
            raise ContractError(f"{f.get('path')}: unknown keys {sorted(unknown)}")
        if f.get("type") not in _TYPES:
            raise ContractError(f"{f['path']}: unknown type {f.get('type')}")
        if f.get("vocabulary") and f["vocabulary"] not in contract.vocabularies:
            raise ContractError(f"{f['path']}: no vocabulary {f['vocabulary']}")
    if len(set(paths)) < len(paths):
        raise ContractError("a field path is repeated")
    for r in contract.rules:
        if lost := [p for p in rule_paths(r) if p not in paths and p != "*"]:
            raise ContractError(f"rule {r['id']} names unknown fields {lost}")
    for name in contract.profiles:
        contract.profile(name)
    return contract


def compiled(folder: str | Path) -> Contract:
    """Compiles contract.yaml and vocabularies/*.yaml of a folder."""
    root = Path(folder)
    body = yaml.safe_load((root / "contract.yaml").read_text())
    vocabularies = {p.stem: yaml.safe_load(p.read_text()) for p in sorted(root.glob("vocabularies/*.yaml"))}
    return checked(Contract(str(body["version"]), tuple(body["fields"]), tuple(body.get("rules", ())), vocabularies, body.get("profiles", {})))


def release(contract: Contract, folder: str | Path) -> Path:
    """Writes an immutable release: the contract and its digest.  An existing version is never replaced."""
    target = Path(folder) / contract.version
    if target.exists():
        raise ContractError(f"version {contract.version} is released already")
    target.mkdir(parents=True)
    body = {"version": contract.version, "fields": contract.fields, "rules": contract.rules, "vocabularies": contract.vocabularies, "profiles": contract.profiles}
    (target / "contract.json").write_text(json.dumps(body, indent=1, ensure_ascii=False))
    (target / "release.json").write_text(json.dumps({"version": contract.version, "digest": contract.digest}))
    return target


@lru_cache(maxsize=64)
def resolved(folder: str, version: str = "latest") -> Contract:
    """A released version, checked against its digest."""
    root = Path(folder)
    versions = sorted((p.name for p in root.iterdir() if (p / "release.json").exists()), key=lambda v: tuple(map(int, v.split("."))))
    if not versions:
        raise ContractError("no release")
    name = versions[-1] if version == "latest" else version
    if name not in versions:
        raise ContractError(f"no release {version}")
    body = json.loads((root / name / "contract.json").read_text())
    contract = Contract(body["version"], tuple(body["fields"]), tuple(body["rules"]), body["vocabularies"], body["profiles"])
    if contract.digest != json.loads((root / name / "release.json").read_text())["digest"]:
        raise ContractError(f"release {name} was changed")
    return contract


def change_step(old: Contract, new: Contract) -> tuple[str, list[str]]:
    """(major, minor, patch or none; reasons) between two contracts."""
    a, b = ({f["path"]: f for f in c.fields} for c in (old, new))
    major = [f"removed {p}" for p in a if p not in b] + [f"type of {p}" for p in a if p in b and a[p]["type"] != b[p]["type"]] + [f"required {p}" for p in b if b[p].get("required") and not a.get(p, {}).get("required")]
    for v, body in old.vocabularies.items():
        gone = set(body["codes"]) - set(new.vocabularies.get(v, {"codes": {}})["codes"])
        major += [f"code {v}:{c} removed" for c in sorted(gone)]
    rules = {r["id"]: r for r in old.rules}
    major += [f"rule {r['id']} is an error now" for r in new.rules if r.get("level", "error") == "error" and rules.get(r["id"], {"level": "none"}).get("level", "error") != "error"]
    minor = [f"added {p}" for p in b if p not in a] + [f"code {v}:{c} added" for v, body in new.vocabularies.items() for c in body["codes"] if c not in old.vocabularies.get(v, {"codes": {}})["codes"]]
    if major:
        return "major", major
    if minor:
        return "minor", minor
    return ("none", []) if replace(old, version=new.version).digest == new.digest else ("patch", ["text"])
