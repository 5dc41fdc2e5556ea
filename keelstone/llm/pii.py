"""Personal data by anchors.

An Aho-Corasick automaton finds at-signs, plus signs, digits, schemes and identifier
cues in one pass over a text; a deterministic parser for each kind expands from the
anchor to the boundaries of the value and validates it.
"""

from __future__ import annotations

import functools
import hashlib
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The kinds, base ones first, and the words that announce an identifier.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "account", "address")
ACCOUNT_CUES = (
    "account", "iban", "passport", "ssn", "customer no", "konto", "kundennummer", "compte",
    "cuenta", "pasaporte", "username", "user id",
)
STREET_CUES = ("street", "avenue", "road", "boulevard", "straße", "strasse")

LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DIGITS = re.compile(r"[0-9]+")
IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ACCOUNT = re.compile(r"(?:\x20(?:number|no\.?|nr\.?))?\x20?[:#=]\x20?([A-Za-z0-9][A-Za-z0-9._-]{3,33}[A-Za-z0-9])")
USER_INFO = re.compile(r"[^\s/@:\"'<>]++:[^\s/@\"'<>]++@")
NUMBER_BEFORE = re.compile(r"[0-9]{1,5}[A-Za-z]?\x20(?:[A-Z][\w.'-]{0,30}\x20){1,4}\Z")
CAPITALS = re.compile(r"[A-Z]+")
NUMBER_AFTER = re.compile(r"\x20[0-9]{1,4}[A-Za-z]?\b")


@functools.cache
def _automaton():
    found = ahocorasick.Automaton()
    for digit in "0123456789":
        found.add_word(digit, ("digit", 1))
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    found.add_word("://", ("scheme", 3))
    for kind, cues in (("account", ACCOUNT_CUES), ("street", STREET_CUES)):
        for cue in cues:
            found.add_word(cue, (kind, len(cue)))
    found.make_automaton()
    return found


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if place % 2:
            value = 2 * value - 9 * (value > 4)
        total += value
    return total % 10 == 0


def _iban(value: str) -> bool:
    if not re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", value):
        return False
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def spans(text: str | None) -> list[tuple[str, int, int]]:
    """Kind, start and end in code points of all findings, by start, then kind.

    Null and empty texts have none. Findings of one kind do not overlap, those of
    different kinds may.
    """
    if not text:
        return []
    found = []
    free = dict.fromkeys(KINDS, 0)  # where the next finding of a kind may begin

    def put(kind, start, end, valid=True):
        if valid:
            found.append((kind, start, end))
        free[kind] = end

    # cues in any spelling; only A-Z change, so places stay
    lowered = text.lower() if text.isascii() else CAPITALS.sub(lambda m: m.group().lower(), text)
    for last, (anchor, length) in _automaton().iter(lowered):
        at = last - length + 1
        if anchor == "digit":
            if at >= free["card"] and (m := CARD.match(text, at)):
                digits = re.sub(r"[\x20-]", "", m.group())
                put("card", at, m.end(), 14 <= len(digits) <= 19 and _luhn(digits))
            if at >= free["ip"]:
                if m := IP.match(text, at):
                    parts = [p.lstrip("0") for p in m.group().split(".")]
                    put("ip", at, m.end(), all(len(p) < 4 and int(p or 0) < 256 for p in parts))
                else:  # no later digit of this run can begin an address either
                    free["ip"] = DIGITS.match(text, at).end()
        elif anchor == "at":
            start = at
            while start > free["email"] and text[start - 1] in LOCAL_PART:
                start -= 1
            if start < at and (m := DOMAIN.match(text, at + 1)):
                put("email", start, m.end())
        elif anchor == "plus":
            if at >= free["phone"] and (m := PHONE.match(text, at)):
                put("phone", at, m.end(), 10 <= sum(c.isdigit() for c in m.group()) <= 15)
        elif anchor == "scheme":
            if last >= free["account"] and (m := USER_INFO.match(text, last + 1)):
                put("account", last + 1, m.end() - 1)
        elif anchor == "account":
            bounded = not at or not text[at - 1].isalnum()
            if bounded and at >= free["account"] and (m := ACCOUNT.match(text, last + 1)):
                value = m.group(1)
                valid = any(c.isdigit() for c in value) or _iban(value)
                put("account", m.start(1), m.end(1), valid)
        elif at >= free["address"]:
            if m := NUMBER_AFTER.match(text, last + 1):
                start = at
                while start > free["address"] and text[start - 1].isalpha():
                    start -= 1
                put("address", start, m.end(), text[start].isupper())
            elif m := NUMBER_BEFORE.search(text, max(free["address"], at - 160), at):
                put("address", m.start(), last + 1)
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def redact(text: str, findings: list[tuple[str, int, int]]) -> str:
    """The text with each finding replaced by its kind in angle brackets.

    Findings that overlap are replaced as one, under the kind that begins first.
    """
    out, at = [], 0
    merged: list[list] = []
    for kind, start, end in findings:
        if merged and start < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], end)
        else:
            merged.append([kind, start, end])
    for kind, start, end in merged:
        out += [text[at:start], f"<{kind.upper()}>"]
        at = end
    return "".join(out) + text[at:]


def clean(text: str | None) -> str | None:
    """The text with all findings replaced, also those that only show once others are gone."""
    while text and (findings := spans(text)):
        text = redact(text, findings)
    return text


def _joined(findings) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in findings)


def _digest(batches):
    names = ["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans"]
    for batch in batches:
        columns: list[list] = [[] for _ in names[1:]]
        for text in batch.column("text"):
            findings = spans(text.as_py())
            base = [x for x in findings if x[0] in BASE_KINDS]
            for column, kind in zip(columns, BASE_KINDS, strict=False):
                column.append(sum(x[0] == kind for x in base))
            columns[4].append(hashlib.sha256(_joined(base).encode()).hexdigest())
            columns[5].append(_joined(findings))
        types = [pa.int64()] * 4 + [pa.string()] * 2
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=names)


def find(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row: counts of the base kinds, a digest of their spans, all spans.

    Null texts count as empty. Repeated rows and null ids are kept as they are, other
    columns are not read. Works row by row, without a shuffle.
    """
    counts = ", ".join(f"n_{k} long" for k in BASE_KINDS)
    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")
    ).mapInArrow(_digest, f"doc_id long, {counts}, base_sha256 string, spans string")


def mask(docs: DataFrame, text_column: str = "text", length_column: str = "n_chars") -> DataFrame:
    """``docs`` with personal data in the text replaced and the length brought up to date.

    Null texts stay null; every other column and all rows are kept.
    """
    place = docs.columns.index(text_column)

    def masked(batches):
        for batch in batches:
            texts = [clean(text) for text in batch.column(place).to_pylist()]
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.types[place]))

    out = docs.mapInArrow(masked, docs.schema)
    if length_column in docs.columns:
        kind = docs.schema[length_column].dataType
        out = out.withColumn(length_column, F.coalesce(F.length(text_column).cast(kind), F.col(length_column)))
    return out
