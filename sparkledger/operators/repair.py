"""Structural repair of candidates: shape and encoding only, never content, each step logged.

A candidate is JSON text.  It is read as VARIANT and worked off inside its row: nothing is shuffled, and a row's log comes with
it.  What would need judgement (unknown keys, numbers that cannot be read) is dropped or left to validation.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEP = "struct<action:string,key:string,to:string>"
VALUE = "struct<type:string,text:string>"
_CELL = f"struct<place:string,path:string,value:{VALUE},log:array<{STEP}>>"
_EVIDENCE = "evidence"
_SORTS = {"STRING": "string", "BIGINT": "number", "DECIMAL": "number", "DOUBLE": "number", "BOOLEAN": "boolean", "ARRAY": "array", "OBJECT": "object"}
# How numbers and references are written.
_INTEGER = r"^[-+]?([0-9]+|[0-9]{1,3}(,[0-9]{3})+)$"
_NUMBER = r"^[-+]?([0-9]+|[0-9]{1,3}(,[0-9]{3})+)(\.[0-9]+)?([eE][-+]?[0-9]+)?$"
_REF = r"^[A-Za-z0-9_.:-]{1,64}\z"


@dataclass(frozen=True)
class Form:
    """What a candidate may hold.  fields: path -> {type, role, vocabulary}, role one of extract, document or another;
    known: further paths of the contract; evidence: role -> path; vocabularies: name -> {code: labels}."""

    fields: dict[str, dict]
    known: tuple[str, ...] = ()
    evidence: dict[str, str] = field(default_factory=dict)
    kinds: tuple[str, ...] = ()
    links: tuple[str, ...] = ()
    vocabularies: dict[str, dict[str, list[str]]] = field(default_factory=dict)

    def groups(self) -> list[str]:
        return sorted({p.split(".")[0] for p in (*self.fields, *self.known, *self.evidence.values()) if "." in p})

    def paths(self) -> list[str]:
        return sorted({*self.fields, *self.known, *self.evidence.values()})

    def bare(self) -> dict[str, list[str]]:
        found: dict[str, list[str]] = {}
        for path, f in self.fields.items():
            if f["role"] in ("extract", "document"):
                found.setdefault(path.split(".")[-1], []).append(path)
        return found

    def labels(self) -> dict[str, str]:
        """Key of a path and a folded label -> code; the first that claims a label has it."""
        found: dict[str, str] = {}
        for path, f in self.fields.items():
            for code, labels in self.vocabularies.get(f.get("vocabulary"), {}).items():
                for label in (code, *labels):
                    if label.strip():
                        found.setdefault(f"{path}\x1f{label.strip().casefold()}", code)
        return found


def _lookup(values: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in values.items() for x in kv)), key) if values else F.lit(None).cast("string")


def _folded(text: Column) -> Column:
    return F.replace(F.lower(F.trim(text)), F.lit("ß"), F.lit("ss"))


def _among(value: Column, values) -> Column:
    return F.coalesce(value.isin(*values), F.lit(False)) if values else F.lit(False)


def _step(action: str | Column, key: Column, to: Column | None = None) -> Column:
    return F.struct((F.lit(action) if isinstance(action, str) else action).alias("action"), key.cast("string").alias("key"), (F.lit(None) if to is None else to).cast("string").alias("to"))


def _steps(*pairs: tuple[Column, Column]) -> Column:
    """The steps whose condition holds."""
    return F.array_compact(F.array(*(F.when(when, step) for when, step in pairs)))


def _sort(v: Column) -> Column:
    """string, number, boolean, array, object or null, by the first word of a VARIANT's schema."""
    word = F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)
    return F.coalesce(_lookup(_SORTS, word), F.lit("null"))


def _text(v: Column, sort: Column) -> Column:
    return F.when(sort == "string", F.trim(v.cast("string"))).otherwise(v.cast("string"))


def _empty(sort: Column, text: Column) -> Column:
    return (sort == "null") | (text == "") | (sort.isin("array", "object") & text.isin("[]", "{}"))


def _entries(v: Column) -> Column:
    """An object's entries in the order of their names, none of anything else."""
    return F.when(_sort(v) == "object", F.map_entries(v.cast("map<string,variant>"))).otherwise(F.array().cast("array<struct<key:string,value:variant>>"))


def _let(value: Column, fn) -> Column:
    """fn of a value that is worked out once."""
    return F.get(F.transform(F.array(value), fn), 0)


def _staged(cells: Column, names: list[str], *stages: dict) -> Column:
    """cells (structs with the given names) with more members, stage by stage, so that each is worked out once."""
    have = list(names)
    for stage in stages:
        cells = F.transform(cells, lambda c: F.struct(*(c[n].alias(n) for n in have), *(fn(c).alias(n) for n, fn in stage.items())))  # noqa: B023
        have += stage
    return cells


def _read(entries: Column) -> Column:
    """(key, v, sort, text, empty, endless) of entries."""
    named = F.transform(entries, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("v"), _sort(e["value"]).alias("sort")))
    endless = lambda c: F.coalesce(F.abs(F.when(c["sort"] == "number", c["v"].cast("double"))) == F.lit(float("inf")), F.lit(False))
    return _staged(named, ["key", "v", "sort"], {"text": lambda c: _text(c["v"], c["sort"]), "endless": endless}, {"empty": lambda c: _empty(c["sort"], c["text"])})


_SEEN = ["key", "v", "sort", "text", "endless", "empty"]


def _value(kind, text: Column) -> Column:
    return F.struct((F.lit(kind) if isinstance(kind, str) else kind).alias("type"), text.alias("text")).cast(VALUE)


def _whole(text: Column) -> Column:
    return F.regexp_replace(text, ",", "").try_cast("decimal(38,0)").cast("string")


def _members(v: Column) -> Column:
    """A list's members as texts without empty ones; null where one is neither text nor number."""
    read = F.transform(v.cast("array<variant>"), lambda x: F.struct(_sort(x).alias("sort"), x.cast("string").alias("text")))
    full = F.filter(read, lambda x: ~_empty(x["sort"], x["text"]))
    return _let(full, lambda f: F.when(F.forall(f, lambda x: x["sort"].isin("string", "number")), F.to_json(F.transform(f, lambda x: x["text"]))))


def _coerced(c: Column) -> Column:
    """The value in the type of its field, where nothing is lost by that."""
    wanted, sort, text, plain = c["wanted"], c["sort"], c["text"], c["plain"]
    real = F.regexp_replace(plain, ",", "").try_cast("double")
    number = F.when(plain.rlike(_INTEGER), _whole(plain)).when(F.abs(real) < F.lit(float("inf")), real.cast("string"))
    level = F.when((wanted == "integer") & (sort == "number"), c["v"].cast("double"))
    turned = (
        F.when((wanted == "integer") & plain.rlike(_INTEGER), _value("number", _whole(plain)))
        .when((wanted == "number") & plain.rlike(_NUMBER), _value("number", number))
        .when((level == F.floor(level)) & (F.abs(level) < 2.0**53), _value("number", level.cast("long").cast("string")))
        .when((wanted == "string") & (sort == "number"), _value("string", text))
        .when((wanted == "array_string") & (sort == "string"), _value("array", F.to_json(F.array(text))))
        .when((wanted == "array_string") & (sort == "array"), _value("array", _members(c["v"])))
        .when((wanted == "boolean") & (sort == "string") & F.lower(text).isin("true", "false"), _value("boolean", F.lower(text)))
    )
    return _let(turned, lambda t: F.when(t["text"].isNotNull(), t).otherwise(_value(sort, text)))


def _coded(form: Form, path: Column, value: Column) -> Column:
    """Labels of the field's vocabulary as codes, in a text or in a list of texts."""
    named = {p: "".join(f"\x1f{c}" for c in form.vocabularies[f["vocabulary"]]) + "\x1f" for p, f in form.fields.items() if f.get("vocabulary") in form.vocabularies}
    if not named:
        return value
    codes = _lookup(named, path)

    def one(text: Column) -> Column:
        own = F.contains(codes, F.concat(F.lit("\x1f"), text, F.lit("\x1f")))
        return F.when(~own, F.coalesce(_lookup(form.labels(), F.concat_ws("\x1f", path, _folded(text))), text)).otherwise(text)

    texts = F.when(value["type"] == "string", F.array(value["text"])).when(value["type"] == "array", F.from_json(value["text"], "array<string>"))
    done = F.when(codes.isNotNull(), F.transform(texts, one))
    return _let(done, lambda d: F.when(d.isNull(), value).when(value["type"] == "string", _value("string", F.get(d, 0))).otherwise(_value("array", F.to_json(d))))


def _cell(place: Column, path: Column, value: Column, log: Column) -> Column:
    return F.struct(place.alias("place"), path.alias("path"), value.alias("value"), log.alias("log")).cast(_CELL)


def _evidence_cells(form: Form, entries: Column, renamed: bool = True) -> Column:
    """Cells of evidence under their roles; a page is a number, all else text."""

    def value(c: Column) -> Column:
        page = c["role"] == "page"
        return F.when(page & (c["sort"] == "string") & c["text"].rlike("^[0-9]+$"), _value("number", F.coalesce(_whole(c["text"]), c["text"]))).when(~page & (c["sort"] == "number"), _value("string", c["text"])).otherwise(_value(c["sort"], c["text"]))

    def cell(c: Column) -> Column:
        fine = c["known"] & ~c["empty"] & ~c["endless"]
        malformed = fine & (c["role"] != "page") & ~c["sort"].isin("string", "number")
        name = F.concat(F.lit("evidence."), c["role"])
        log = _steps(
            ((c["role"] != c["key"]) & F.lit(renamed), _step("renamed_evidence_key", c["key"], c["role"])), (~c["known"], _step("dropped_unknown_evidence_key", c["key"])), (c["known"] & c["endless"], _step("dropped_non_finite_number", name)),
            (fine & (c["value"]["type"] != c["sort"]), _step("coerced_type", name, c["value"]["text"])), (malformed, _step("dropped_malformed_evidence_value", name)),
        )
        return _cell(F.when(fine & ~malformed, F.lit(_EVIDENCE)), c["role"], c["value"], log)

    roles = {p: r for r, p in form.evidence.items()}
    staged = _staged(_read(entries), _SEEN, {"role": lambda c: F.coalesce(_lookup(roles, c["key"]), c["key"])}, {"known": lambda c: _among(c["role"], form.evidence), "value": value})
    return F.transform(staged, cell)


def _field_cells(form: Form, entries: Column, document: bool) -> Column:
    """Cells of fields: where each belongs, its value, and what was done to it."""
    bare = form.bare()
    single = {n: p[0] for n, p in bare.items() if len(p) == 1}
    roles, types = ({p: f[k] for p, f in form.fields.items()} for k in ("role", "type"))
    sources = [] if document else list(form.evidence.values())
    path = lambda c: F.when(_among(c["key"], form.paths()), c["key"]).when(~F.contains(c["key"], F.lit(".")), _lookup(single, c["key"]))
    plain = lambda c: F.when(c["sort"] == "string", F.when(c["path"].endswith("_percent"), F.trim(F.regexp_replace(c["text"], "%$", ""))).otherwise(c["text"]))

    def place(c: Column) -> Column:
        live = c["path"].isNotNull() & ~c["empty"] & ~c["endless"]
        known = F.when(c["role"] == "document", "document") if document else F.when(_among(c["path"], sources), "moved").when(c["role"] == "document", "document").when(c["role"] == "extract", "fields")
        return F.when(live, F.coalesce(known, F.lit("refused")))

    def cell(c: Column) -> Column:
        kept, named = c["place"].isin("fields", "document"), c["path"].isNotNull()
        many = _among(c["key"], [n for n, p in bare.items() if len(p) > 1])
        log = _steps(
            (c["path"] != c["key"], _step("resolved_bare_field_name", c["key"], c["path"])),
            (~named, _step(F.when(many, "dropped_ambiguous_field_name").otherwise("dropped_unknown_field"), c["key"])),
            (named & c["empty"], _step("dropped_empty_value", c["path"])), (named & c["endless"], _step("dropped_non_finite_number", c["path"])),
            (kept & ((c["typed"]["type"] != c["sort"]) | (c["typed"]["text"] != c["text"])), _step("coerced_type", c["path"], c["typed"]["text"])),
            (kept & (c["value"]["text"] != c["typed"]["text"]), _step("mapped_vocabulary_label", c["path"], c["value"]["text"])),
            ((c["place"] == "document") & F.lit(not document), _step("document_field_override", c["path"])),
            (c["place"] == "refused", _step("dropped_non_document_field" if document else "dropped_field", c["path"], None if document else F.when(c["role"].isNull(), "not_in_profile").otherwise("computed_by_pipeline"))),
        )
        return F.struct(_cell(c["place"], c["path"], c["value"], log).alias("cell"), c["v"].alias("v"))

    stages = [{"path": path}, {"role": lambda c: _lookup(roles, c["path"]), "wanted": lambda c: _lookup(types, c["path"]), "plain": plain}, {"place": place, "typed": _coerced}, {"value": lambda c: _coded(form, c["path"], c["typed"])}]
    return F.transform(_staged(_read(entries), _SEEN, *stages), cell)


def _flat(form: Form, v: Column) -> Column:
    """Entries with those of a group's object under ``group.name``."""
    own = F.array().cast("array<struct<key:string,value:variant>>")
    return F.flatten(F.transform(_entries(v), lambda e: F.when(_among(e["key"], form.groups()) & (_sort(e["value"]) == "object"), F.transform(_entries(e["value"]), lambda x: F.struct(F.concat_ws(".", e["key"], x["key"]).alias("key"), x["value"].alias("value")))).otherwise(F.concat(own, F.array(e)))))


def _placed(cells: Column, place: str) -> Column:
    """map path -> value of the cells of a place; of several for one path the first stays."""
    mine = F.transform(F.filter(cells, lambda c: c["place"] == place), lambda c: F.struct(c["path"].alias("path"), c["value"].alias("value")))
    return _let(mine, lambda m: _let(F.transform(m, lambda c: c["path"]), lambda paths: F.map_from_entries(F.filter(m, lambda c, i: F.array_position(paths, c["path"]) == i + 1))))


def _logs(cells: Column) -> Column:
    return F.flatten(F.transform(cells, lambda c: c["log"]))


def repaired_documents(rows: DataFrame, text: str, form: Form) -> DataFrame:
    """rows with ``document`` (map path -> type and text) and ``repairs`` of the JSON object in a column; anything else is an
    empty document.  ``document``, ``repairs``, ``_v`` and ``_cells`` must not be there before."""
    _refuse(rows, ["document", "repairs", "_v", "_cells"])
    made = rows.withColumn("_v", F.try_parse_json(F.col(f"`{text}`")))
    made = made.withColumn("_cells", F.transform(_field_cells(form, _flat(form, F.col("_v")), document=True), lambda c: c["cell"]))
    return made.withColumn("document", _placed(F.col("_cells"), "document")).withColumn("repairs", _logs(F.col("_cells"))).drop("_v", "_cells")


def _refuse(rows: DataFrame, made: list[str]) -> None:
    clash = sorted(set(made) & set(rows.columns))
    if clash:
        raise ValueError(f"columns of the result are there already: {clash}")


def _references(v: Column) -> Column:
    """A list of references, or one, as distinct texts in order; null where it is neither."""
    one = lambda x: F.when(F.regexp_extract(F.schema_of_variant(x), "^[A-Z]+", 0).isin("STRING", "BIGINT"), F.trim(x.cast("string")))
    given = F.when(_sort(v) == "array", F.transform(v.cast("array<variant>"), one)).otherwise(_let(one(v), lambda x: F.when(x.isNotNull(), F.array(x))))
    return F.array_distinct(F.filter(given, lambda r: r != ""))


def repaired_candidates(rows: DataFrame, text: str, form: Form) -> DataFrame:
    """rows with record_kind, fields, evidence, overrides (maps path -> type and text), ref, links (map name -> refs),
    ``kept`` and ``repairs`` (array of action, key, to) of the candidate in a column of JSON text.

    What is no object (null and text that is no JSON too) has kept = false and one step.  Texts are told without quotes,
    lists and objects as JSON.  Evidence that is given as such goes before evidence that was among the fields; of several
    entries for one path the first by name stays.  An object with one name twice is no JSON here.  Numbers of more than 38
    digits stay text.  The columns made, and the working columns, must not be there before."""
    working = ["_v", "_fields", "_given", "_moved", "_links", "_said", "_own", "_other"]
    _refuse(rows, ["record_kind", "fields", "evidence", "overrides", "ref", "links", "kept", "repairs", *working])
    part = lambda name: F.try_variant_get("_v", f"$.{name}", "variant")
    rows = rows.withColumn("_v", _let(F.try_parse_json(F.col(f"`{text}`")), lambda v: F.when(_sort(v) == "object", v)))
    rows = rows.withColumn("_fields", _field_cells(form, _flat(form, part("fields")), document=False))
    moved = F.transform(F.filter("_fields", lambda c: c["cell"]["place"] == "moved"), lambda c: F.struct(c["cell"]["path"].alias("key"), c["v"].alias("value")))
    links = F.transform(_entries(part("links")), lambda e: F.struct(e["key"].alias("key"), _among(e["key"], form.links).alias("known"), _references(e["value"]).alias("value")))
    rows = rows.withColumns({"_given": _evidence_cells(form, _entries(part("evidence"))), "_moved": _evidence_cells(form, moved, renamed=False), "_links": links})

    said = F.when(_sort(part("record_kind")) == "string", part("record_kind").cast("string"))
    folded = _lookup({k.casefold(): k for k in reversed(form.kinds)}, _folded(F.col("_said")))
    rows = rows.withColumn("_said", said)
    kind = F.when(_among(F.col("_said"), form.kinds), F.col("_said")).otherwise(F.coalesce(folded, "_said"))
    ref = F.get(_references(F.when(_sort(part("ref")) != "array", part("ref"))), 0)
    rows = rows.withColumns({"record_kind": kind, "_own": _placed(F.col("_given"), _EVIDENCE), "_other": _placed(F.col("_moved"), _EVIDENCE), "ref": _let(ref, lambda r: F.when(r.rlike(_REF), r))})
    fresh = F.map_filter("_other", lambda k, _: ~F.coalesce(F.map_contains_key("_own", k), F.lit(False)))
    odd = lambda name: _let(part(name), lambda v: _let(_sort(v), lambda s: (s != "object") & ~_empty(s, v.cast("string"))))
    log = F.concat(
        _steps((F.col("_said") != F.col("record_kind"), _step("normalized_record_kind", F.col("_said"), F.col("record_kind"))), (odd("evidence"), _step("dropped_malformed_evidence", F.lit("evidence")))),
        _logs(F.col("_given")), _logs(F.transform("_fields", lambda c: c["cell"])), _logs(F.col("_moved")), F.transform(F.map_keys(fresh), lambda r: _step("moved_to_evidence", r)),
        _steps(((_sort(part("ref")) != "null") & F.col("ref").isNull(), _step("dropped_malformed_ref", part("ref").cast("string"))), (odd("links"), _step("dropped_malformed_links", F.lit("links")))),
        F.array_compact(F.transform("_links", lambda e: F.when(~e["known"], _step("dropped_unknown_link", e["key"])).when(e["value"].isNull(), _step("dropped_malformed_links", e["key"])))),
    )
    there = F.col("_v").isNotNull()
    refs = F.map_from_entries(F.transform(F.filter("_links", lambda e: e["known"] & (F.coalesce(F.size(e["value"]), F.lit(0)) > 0)), lambda e: F.struct(e["key"], e["value"])))
    cells = F.transform("_fields", lambda c: c["cell"])
    return rows.withColumns({
        "fields": _placed(cells, "fields"), "evidence": F.map_concat("_own", fresh), "overrides": _placed(cells, "document"), "links": refs,
        "kept": there, "repairs": F.when(there, log).otherwise(F.array(_step("dropped_malformed_candidate", F.lit(None)))),
    }).drop(*working)
