"""Secret scans with structural confirmation.

Base kinds come from patterns (``assign``, ``access``, ``hex``).  Further kinds are reported only if their inside confirms
them: a candidate in base64 or hex is decoded, and the decoded bytes must parse as what they claim to be.

* ``pem``: a PEM block (BEGIN ... PRIVATE KEY ... END) whose body decodes to one DER sequence that fills it exactly, or to
  an OpenSSH key with well-formed nested lengths; header lines may come first, and if they say that the body is encrypted
  (Proc-Type and DEK-Info) it need only decode to whole cipher blocks;
* ``der``: a bare base64 or hex run that decodes to a PKCS#1 / PKCS#8 / SEC 1 / DSA private key in DER: a sequence with an
  integer version first and nested lengths that end where it ends;
* ``ssh``: a bare base64 run that decodes to ``openssh-key-v1`` or to an SSH wire-format key with fitting lengths;
* ``jwt``: a signed token of three base64url parts whose first part is a JSON object with ``alg`` and whose second is a
  JSON object.

Spans are in code points, end exclusive.  Defined cases: a null text is empty and has no spans; ids may be null or repeat;
other columns are ignored.  The plan is one scan without a shuffle, and texts are read whole.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytetext as B
from .shared import map_batches, text_column

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: A run of lower-case hex digits is one match, so runs of 32 or more are the matches that stay.
HEX = re.compile(r"[0-9a-f]{32,}")
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----\s*+((?:[A-Za-z0-9-]++:[^\r\n]*+\r?\n(?:[ \t][^\r\n]*+\r?\n)*+)*+)([A-Za-z0-9+/=\s]++)-----END \1-----")
_ENCRYPTED = re.compile(r"^Proc-Type:[ \t]*4[ \t]*,[ \t]*ENCRYPTED[ \t\r]*$", re.MULTILINE)
#: Three base64url parts, the first as long as the shortest header with an alg and starting like a brace or white space;
#: only the first character is consumed, so a candidate may start inside another.
JWT = re.compile(r"[eICD](?<![A-Za-z0-9_-].)(?=([A-Za-z0-9_-]{13,}+\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++))")
#: A base64 run long enough for the shortest private key (an Ed25519 PKCS#8 key has 48 bytes) that starts like a DER
#: sequence (0x30) or like the two SSH formats.
BARE64 = re.compile(r"(?<![A-Za-z0-9+/])(?:M[A-Za-f]|b3BlbnNzaC1rZXkt|AAAA[A-E])[A-Za-z0-9+/]{54,}={0,2}")
BAREHEX = re.compile(r"(?<![0-9A-Fa-f])30[0-9A-Fa-f]{94,}")

KINDS = ("assign", "access", "hex", "pem", "der", "ssh", "jwt")
_RANK = {k: i for i, k in enumerate(KINDS)}
#: One of these strings is in any text that has a match of the kind.
_HINTS_64 = re.compile(r"M[A-Za-f][A-Za-z0-9+/]{54}|b3BlbnNzaC1rZXkt|AAAA[A-E][A-Za-z0-9+/]{54}")


def der_value(raw: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, start, end) of the DER value at a place; None if its length is not in shortest form or runs over the end."""
    if at + 2 > end:
        return None
    tag, n = raw[at], raw[at + 1]
    at += 2
    if n >= 0x80:
        k = n & 0x7F
        if not 1 <= k <= 4 or at + k > end or raw[at] == 0:
            return None
        n = int.from_bytes(raw[at : at + k], "big")
        if n < 0x80:
            return None
        at += k
    return (tag, at, at + n) if at + n <= end else None


def der_children(raw: bytes, lo: int, hi: int) -> list[tuple[int, int, int]] | None:
    """The values that fill a range of bytes; None if they do not, or a sequence inside is not filled by values.

    Sequences inside are parsed from a list of open ranges, so any depth of nesting is taken."""
    found, waiting = None, [(lo, hi)]
    while waiting:
        at, end = waiting.pop()
        own = []
        while at < end:
            value = der_value(raw, at, end)
            if not value:
                return None
            own.append(value)
            at = value[2]
        waiting += [(a, b) for tag, a, b in own if tag == 0x30]
        found = own if found is None else found
    return found


def der_sequence(raw: bytes) -> list[tuple[int, int, int]] | None:
    """The values of a sequence that fills the bytes, all of whose lengths nest; None if it is not one."""
    top = der_value(raw, 0, len(raw))
    return der_children(raw, top[1], top[2]) if top and top[0] == 0x30 and top[2] == len(raw) else None


def private_key_der(raw: bytes) -> bool:
    """A sequence that fills the bytes, with an integer version of one byte first and at least one more value, all of
    whose lengths nest; sequences inside are parsed too."""
    parts = der_sequence(raw)
    if not parts or len(parts) < 2 or parts[0][0] != 0x02 or parts[0][2] - parts[0][1] != 1:
        return False
    rest = [t for t, _, _ in parts[1:]]
    pkcs1 = len(rest) >= 8 and all(t == 0x02 for t in rest[:8])
    pkcs8 = len(rest) >= 2 and rest[0] == 0x30 and rest[1] == 0x04
    sec1 = rest[0] == 0x04
    dsa = len(rest) == 5 and all(t == 0x02 for t in rest)
    return pkcs1 or pkcs8 or sec1 or dsa


def _chunks(raw: bytes, at: int) -> list[bytes] | None:
    """Length-prefixed strings up to the end; None if a length runs over."""
    found = []
    while at < len(raw):
        if at + 4 > len(raw):
            return None
        n = int.from_bytes(raw[at : at + 4], "big")
        at += 4
        if at + n > len(raw):
            return None
        found.append(raw[at : at + n])
        at += n
    return found


def ssh_key(raw: bytes) -> bool:
    """The OpenSSH private format, or a wire-format key that names its algorithm."""
    if raw.startswith(b"openssh-key-v1\0"):
        at, strings = 15, []
        for _ in range(3):  # cipher, derivation, its options
            if at + 4 > len(raw) or at + 4 + (n := int.from_bytes(raw[at : at + 4], "big")) > len(raw):
                return False
            strings.append(raw[at + 4 : at + 4 + n])
            at += 4 + n
        if at + 4 > len(raw) or not strings[0] or not (count := int.from_bytes(raw[at : at + 4], "big")):
            return False
        keys = _chunks(raw, at + 4)
        return keys is not None and len(keys) == count + 1
    parts = _chunks(raw, 0)
    return bool(parts) and len(parts) >= 2 and re.fullmatch(rb"(ssh|ecdsa)-[a-z0-9-]+", parts[0]) is not None


def _b64(text: str, url: bool = False) -> bytes | None:
    text = text.rstrip("=")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), altchars=b"-_" if url else None, validate=True)
    except (binascii.Error, ValueError):
        return None


def _json_object(part: str) -> dict | None:
    raw = _b64(part, url=True)
    try:
        value = json.loads(raw) if raw is not None else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def confirmed(text: str) -> list[tuple[int, int, str]]:
    """Spans of the kinds that need structure."""
    found = []
    if "PRIVATE KEY-----" in text:
        for m in PEM.finditer(text):
            raw = _b64("".join(m[3].split()))
            encrypted = _ENCRYPTED.search(m[2]) and "DEK-Info:" in m[2]
            if raw and (len(raw) % 8 == 0 if encrypted else der_sequence(raw) or ssh_key(raw)):
                found.append((m.start(), m.end(), "pem"))
    end = 0
    for m in JWT.finditer(text):
        if m.start() >= end:
            head, body, _ = text[m.start() : m.end(1)].split(".")
            if isinstance((_json_object(head) or {}).get("alg"), str) and _json_object(body) is not None:
                end = m.end(1)
                found.append((m.start(), end, "jwt"))
    inside = [s for s in found if s[2] == "pem"]
    if _HINTS_64.search(text):
        for m in BARE64.finditer(text):
            if any(a <= m.start() and m.end() <= b for a, b, _ in inside):
                continue
            raw = _b64(m[0])
            kind = None if raw is None else "der" if private_key_der(raw) else "ssh" if ssh_key(raw) else None
            if kind:
                found.append((m.start(), m.end(), kind))
    for m in BAREHEX.finditer(text) if "30" in text else ():
        if len(m[0]) % 2 == 0 and private_key_der(bytes.fromhex(m[0])):
            found.append((m.start(), m.end(), "der"))
    return found


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def _order(span: tuple[int, int, str]) -> tuple[int, int, int]:
    return span[0], _RANK[span[2]], span[1]


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, kind, start, end): arrays of each document's spans, by start and then kind."""

    def find(batch: pa.RecordBatch):
        column = batch.column(1)
        _, offsets = B.utf8_buffers(column)
        for lo, hi in B.row_slices(offsets, 8 << 20):
            spans = [sorted([*base_spans(t), *confirmed(t)], key=_order) for t in ((x or "") for x in column.slice(lo, hi - lo).to_pylist())]
            yield {"doc_id": batch.column(0).slice(lo, hi - lo), "kind": [[s[2] for s in x] for x in spans], "start": [[s[0] for s in x] for x in spans], "end": [[s[1] for s in x] for x in spans]}

    return map_batches(text_column(docs, text_col).select(F.col(id_col).cast("long").alias("doc_id"), text_col), find, "doc_id long, kind array<string>, start array<long>, end array<long>")


def digests(scanned: DataFrame) -> DataFrame:
    """Counts, the digest of the base spans, and all spans as text, of the output of ``scan``."""
    label = F.transform(F.arrays_zip("kind", "start", "end"), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    base = F.filter(label, lambda s: F.split(s, ":")[0].isin("assign", "access", "hex"))
    count = lambda k: F.size(F.filter("kind", lambda x: x == k)).cast("long").alias(f"n_{k}")
    return scanned.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(F.array_join(base, ","), 256).alias("base_sha256"), F.array_join(label, ",").alias("spans"))


def redact(text: str, marker: str = "[secret]") -> str:
    """The text with every span replaced; overlapping spans become one marker."""
    out, at = [], 0
    for start, end, _ in sorted([*base_spans(text), *confirmed(text)], key=_order):
        if start >= at:
            out += [text[at:start], marker]
        at = max(at, end)
    return "".join([*out, text[at:]])


def digest(spans: list[tuple[int, int, str]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in spans).encode()).hexdigest()


def redacted(docs: DataFrame, *, text_col: str = "text", chars_col: str | None = None, marker: str = "[secret]") -> DataFrame:
    """docs with every span of every text replaced by the marker, and the length column, if one is named, kept right.

    All rows and columns stay; a null text stays null."""
    place, chars = docs.columns.index(text_col), docs.columns.index(chars_col) if chars_col else None

    def run(batches):
        for batch in batches:
            _, offsets = B.utf8_buffers(batch.column(place))
            for lo, hi in B.row_slices(offsets, 8 << 20):
                rows = batch.slice(lo, hi - lo)
                before = rows.column(place).to_pylist()
                after = [t and redact(t, marker) for t in before]
                changed = [i for i, (x, y) in enumerate(zip(before, after, strict=True)) if x != y]
                if changed:
                    rows = rows.set_column(place, rows.schema.field(place), pa.array(after, type=rows.schema.field(place).type))
                    if chars is not None:
                        counts = rows.column(chars).to_pylist()
                        for i in changed:
                            counts[i] = len(after[i])
                        rows = rows.set_column(chars, rows.schema.field(chars), pa.array(counts, type=rows.schema.field(chars).type))
                yield rows

    return docs.mapInArrow(run, docs.schema)
