"""Phrases in texts by one automaton, codes of predicates by their cues, and entity markers.

An automaton (a trie with failure links) finds every phrase of a vocabulary in one scan of a text.  It is built on the driver
from phrases whose size is known first, and broadcast; a larger vocabulary is cut by a hash into as many parts as it takes,
each a scan of its own, so results don't depend on its size.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import exact_form, first_span, normalized

#: Bytes of phrases (and of their ids) that one automaton is built from.
VOCABULARY_BYTES = 16 << 20
_SPACE = re.compile(r"\s+")
#: Letters and digits of ASCII, with the two that are forms of "i" regardless of case.
_PLAIN = frozenset("abcdefghijklmnopqrstuvwxyz0123456789İı")

#: Words that negate, added forms of cues, agents and passives, determiners and nouns around an entity.
NEGATION = r"(?<![a-z0-9])(?:not|no|non|none|never|neither|nor|cannot|without|fail(?:s|ed)? to)(?![a-z0-9])|n't|未|没|不(?![同仅但断论])|无(?!论)|非(?!常)"
ADDED_FORMS = {"located in": ("located within", "mapped in"), "associated with": ("related to",)}
AGENT_AFTER = r"\s+(?:[a-z]+ly\s+)?by(?![a-z0-9])"
PASSIVE_BEFORE = r"受(?!体)|被(?!认为|视为|发现|证明|证实|鉴定|报道|用于)"
DETERMINERS = ("the", "a", "an", "this", "that")
TYPE_NOUNS = {"qtl": ("qtl", "locus"), "gene": ("gene", "locus")}


def folded(text: str) -> tuple[str, list[int], list[int]]:
    """(text without case and with single spaces, places after a shortened run, how much is left out up to there)."""
    plain = text.casefold()
    if len(plain) != len(text):
        plain = "".join(c if len(c.casefold()) != 1 else c.casefold() for c in text)
    places, shifts, shift = [], [], 0
    for run in _SPACE.finditer(plain):
        if run.end() - run.start() > 1:
            shift += run.end() - run.start() - 1
            places.append(run.end() - shift)
            shifts.append(shift)
    return _SPACE.sub(" ", plain), places, shifts


class Automaton:
    """phrases: text -> what is told of it.  Phrases are compared as ``folded``; a letter or digit of ASCII at a phrase's edge
    must not stand beside another one in the text."""

    def __init__(self, phrases: dict[str, list]):
        import ahocorasick

        self.found = ahocorasick.Automaton()
        for phrase, told in phrases.items():
            if phrase:
                self.found.add_word(phrase, (len(phrase), phrase[0] in _PLAIN, phrase[-1] in _PLAIN, told))
        self.empty = not len(self.found)
        if not self.empty:
            self.found.make_automaton()

    def within(self, plain: str) -> Iterator[tuple[int, int, list]]:
        """(start, end, told) of every phrase in a folded text."""
        for last, (size, left, right, told) in () if self.empty else self.found.iter(plain):
            start, end = last - size + 1, last + 1
            if not (left and start and plain[start - 1] in _PLAIN) and not (right and end < len(plain) and plain[end] in _PLAIN):
                yield start, end, told

    def hits(self, text: str) -> Iterator[tuple[int, int, list]]:
        """(start, end, told) in code points of the text itself."""
        plain, places, shifts = folded(text)

        def source(at: int) -> int:
            k = bisect_right(places, at)
            return at + (shifts[k - 1] if k else 0)

        for start, end, told in self.within(plain):
            yield source(start), source(end - 1) + 1, told


def longest_cover(hits: list[tuple[int, int, list]]) -> list[tuple[int, int, list]]:
    """Of overlapping hits the longest stays, of equally long ones the first; in order of place."""
    kept: list[tuple[int, int, list]] = []
    for hit in sorted(hits, key=lambda h: (h[0] - h[1], h[0])):
        k = bisect_right(kept, hit[0], key=lambda h: h[0])
        if (k == 0 or kept[k - 1][1] <= hit[0]) and (k == len(kept) or hit[1] <= kept[k][0]):
            kept.insert(k, hit)
    return kept


def phrase_hits(texts: DataFrame, phrases: DataFrame, *, text_id: str, text: str, phrase_id: str, phrase: str, cover: bool = False, vocabulary_bytes: int = VOCABULARY_BYTES) -> DataFrame:
    """(text_id, phrase_id, start, end): every occurrence of every phrase, regardless of case and of the length of white space.

    With ``cover``, overlapping occurrences give way to the longest (which needs the whole vocabulary in one automaton, so a
    larger one is refused).  Null texts, null phrases and phrases of white space alone have no occurrences."""
    asked = phrases.where(F.col(phrase).isNotNull()).select(F.col(phrase_id).alias("_p"), F.col(phrase).alias("_phrase")).distinct()
    size = asked.agg(F.sum(F.octet_length("_phrase") + 16)).first()[0] or 0
    parts = max(1, -(-size // vocabulary_bytes))
    if cover and parts > 1:
        raise ValueError(f"a cover needs all phrases in one automaton; {size} bytes are more than {vocabulary_bytes}")
    ids, kinds = texts.schema[text_id].dataType.simpleString(), phrases.schema[phrase_id].dataType.simpleString()
    plain = texts.where(F.col(text).isNotNull()).select(F.col(text_id).alias("_t"), F.col(text).alias("_text"))

    def scanned(part: int) -> DataFrame:
        told: dict[str, list] = {}
        # no more than vocabulary_bytes, twice at most where the hash deals unevenly
        for key, value in asked.where(F.pmod(F.xxhash64("_phrase"), F.lit(parts)) == part).collect():
            told.setdefault(folded(value)[0].strip(), []).append(key)
        shared = texts.sparkSession.sparkContext.broadcast(told)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            machine = Automaton(shared.value)
            for batch in batches:
                out = []
                for key, value in zip(batch["_t"], batch["_text"], strict=True):
                    found = list(machine.hits(value))
                    out += [(key, p, a, b) for a, b, own in (longest_cover(found) if cover else found) for p in own]
                yield pd.DataFrame(out, columns=["text_id", "phrase_id", "start", "end"])

        return plain.mapInPandas(run, f"text_id {ids}, phrase_id {kinds}, start int, end int")

    found = scanned(0)
    for part in range(1, parts):
        found = found.unionByName(scanned(part))
    return found.select(F.col("text_id").alias(text_id), F.col("phrase_id").alias(phrase_id), "start", "end")


def cue_forms(cue: str) -> list[str]:
    """A cue and the forms in which it is also written: fixed ones, and the participle of a single English verb."""
    forms = [cue, *ADDED_FORMS.get(cue, ())]
    if " " in cue or not cue.isascii() or len(cue) < 5 or not cue.endswith("s") or cue.endswith("ss"):
        return forms
    verb = cue[:-1]
    if verb.endswith("e"):
        verb = verb[:-1]
    elif verb[-1] not in "aeiouwxy" and verb[-2] in "aeiou":
        verb += verb[-1]
    return forms if f"{verb}ing" in forms else [*forms, f"{verb}ing"]


def _cue_machine(vocabulary: list[dict]) -> Automaton:
    """Of all forms of all cues: (code, length of the cue, cue, whether it is passive itself)."""
    told: dict[str, list] = {}
    for entry in vocabulary:
        for cue in entry.get("cues") or ():
            plain = exact_form(cue)
            passive = bool(re.search(rf"(?<![a-z0-9])by(?![a-z0-9])|{PASSIVE_BEFORE}", plain))
            for form in cue_forms(plain):
                told.setdefault(form, []).append((entry["code"], len(cue), cue, passive))
    return Automaton(told)


def predicate_codes(rows: DataFrame, vocabulary: list[dict], *, mention: str, context: str | None = None, subject_types: str | None = None, object_types: str | None = None, stand_in: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """rows with code, cue and reason: the code that a predicate's words name.

    vocabulary: dicts of code, cues, and the types of both ends that a code may have (subject_types, object_types; none for
    any).  The longest cue of a code counts, and the code with the longest one wins; equal ones are ``ambiguous``, none is
    ``no_cue``, and a negation in the mention or the context is ``negated``.  A cue counts in its own voice: an active one
    followed by its agent, or after a passive, does not.  An end without a type passes, a typed one must fit; stand_in says,
    for a code, which types count as which.  A null or blank mention has neither code nor reason."""
    size = sum(len(c.encode()) + 16 for e in vocabulary for c in e.get("cues") or ())
    if size > VOCABULARY_BYTES:
        raise ValueError("the vocabulary is too large to be sent to all tasks")
    shared = rows.sparkSession.sparkContext.broadcast((vocabulary, stand_in or {}))
    negation, after, before = re.compile(NEGATION), re.compile(AGENT_AFTER), re.compile(PASSIVE_BEFORE)

    @F.pandas_udf("code string, cue string, reason string")
    def coded(mentions: pd.Series, contexts: pd.Series, subjects: pd.Series, objects: pd.Series) -> pd.DataFrame:
        entries, stands = shared.value
        machine, by_code = _cue_machine(entries), {e["code"]: e for e in entries}

        def fits(code: str, given: list, name: str) -> bool:
            kinds = {*given, *(stands.get(code, {}).get(k) for k in given)} if name == "subject_types" else set(given)
            asked = by_code[code].get(name)
            return not given or not asked or bool(kinds & set(asked))

        def one(text: str | None, around: str | None, subject: list | None, object_: list | None) -> tuple:
            if not text or not text.strip():
                return None, None, None
            plain = exact_form(text)
            if negation.search(plain) or (around and negation.search(exact_form(around))):
                return None, None, "negated"
            best: dict[str, tuple[int, str]] = {}
            for start, end, told in machine.within(plain):
                active = not after.match(plain, end) and not before.search(plain, 0, start)
                for code, length, cue, passive in told:
                    if (passive or active) and length > best.get(code, (0,))[0] and fits(code, list(subject if subject is not None else ()), "subject_types") and fits(code, list(object_ if object_ is not None else ()), "object_types"):
                        best[code] = (length, cue)
            if not best:
                return None, None, "no_cue"
            top = max(n for n, _ in best.values())
            winners = [(code, cue) for code, (n, cue) in best.items() if n == top]
            return (*winners[0], None) if len(winners) == 1 else (None, None, "ambiguous")

        return pd.DataFrame([one(*x) for x in zip(mentions, contexts, subjects, objects, strict=True)], columns=["code", "cue", "reason"])

    given = lambda name, kind: F.col(name) if name else F.lit(None).cast(kind)
    out = rows.withColumn("_coded", coded(F.col(mention), given(context, "string"), given(subject_types, "array<string>"), given(object_types, "array<string>")))
    return out.select(*rows.columns, F.col("_coded.code").alias("code"), F.col("_coded.cue").alias("cue"), F.col("_coded.reason").alias("reason"))


def _wraps(text: Column, span: Column, entity_type: Column) -> Column:
    """Whether text is the span plus only determiners and nouns of the entity's type."""
    rest = normalized(F.concat(F.substring(text, F.lit(1), span["start"]), F.lit(" "), F.substring(text, span["end"] + 1, F.length(text))))
    nouns = F.array(entity_type)
    for kind, own in TYPE_NOUNS.items():
        nouns = F.when(entity_type == kind, F.array(*[F.lit(x) for x in own])).otherwise(nouns)
    allowed = F.concat(F.array(*[F.lit(x) for x in DETERMINERS]), nouns)
    return F.forall(F.filter(F.split(rest, " "), lambda w: w != ""), lambda w: F.array_contains(allowed, w))


def entity_markers(mentions: DataFrame, quotes: DataFrame, ends: DataFrame) -> DataFrame:
    """(record, field, mention, entity_type, start, end, role): a marker for each mention of a record, with its place in the
    record's quote where it stands there literally, and the end of the statement that it plays.

    mentions (record, field, place, mention, entity_type), quotes (record, quote; one for a record), ends (record, role,
    field, text) with the roles subject and object.  A mention counts once for a field; one that equals an end plays it; an
    end that no mention equals is played by the only typed mention inside it if nothing but determiners and type nouns
    stands around, else it gets a marker of its own without a type.  Blank mentions and ends are left out."""
    first = mentions.where(F.col("mention").isNotNull() & (F.trim("mention") != "")).withColumn("key", normalized(F.col("mention")))
    own = first.groupBy("record", "field", "key").agg(F.min_by(F.struct("mention", "entity_type"), F.struct("place", "mention")).alias("m"), F.min("place").alias("place"))
    wanted = ends.where(F.col("role").isin("subject", "object") & F.col("text").isNotNull() & (F.trim("text") != "")).select("record", "role", F.col("field").alias("end_field"), "text", normalized(F.col("text")).alias("key"))
    # subject comes before object where both are the same words
    equal = wanted.groupBy("record", "key").agg(F.max("role").alias("role"))
    marked = own.select("record", "field", "place", "key", "m.mention", "m.entity_type").join(equal, ["record", "key"], "left")
    played = marked.where("role IS NOT NULL").select("record", "role").distinct()
    missing = wanted.join(played, ["record", "role"], "left_anti")
    for role in ("subject", "object"):
        open_ends = missing.where(F.col("role") == role).select("record", F.col("text").alias("end_text"))
        inside = marked.where("role IS NULL AND entity_type IS NOT NULL").join(open_ends, "record").withColumn("at", first_span(F.col("end_text"), F.col("mention"))).where("at IS NOT NULL")
        one = inside.groupBy("record").agg(F.count(F.lit(1)).alias("n"), F.first(F.struct("field", "key", "end_text", "at", "entity_type")).alias("i")).where("n = 1")
        taken = one.where(_wraps(F.col("i.end_text"), F.col("i.at"), F.col("i.entity_type"))).select("record", "i.field", "i.key", F.lit(role).alias("taken"))
        marked = marked.join(taken, ["record", "field", "key"], "left").withColumn("role", F.coalesce("role", "taken")).drop("taken")
        missing = missing.join(taken.select("record", F.col("taken").alias("role")), ["record", "role"], "left_anti")
    rows = marked.select("record", "field", "mention", "entity_type", "role").unionByName(missing.select("record", F.col("end_field").alias("field"), F.col("text").alias("mention"), F.lit(None).cast("string").alias("entity_type"), "role"))
    spanned = rows.join(quotes.select("record", "quote"), "record", "left").withColumn("span", first_span(F.col("quote"), F.col("mention")))
    return spanned.select("record", "field", "mention", "entity_type", "span.start", "span.end", "role")
