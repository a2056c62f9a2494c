"""Operator 2: personal data.

Regular expressions propose spans, checksums confirm them (Luhn for cards,
mod-97 for IBANs), and words close by adjust the score. Base kinds are email,
ip, card and phone; the method adds iban, ssn and local (a national phone
number), which need their context words. The scan runs in Arrow batches; each
text is read once per pattern, in linear time for any input.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.llm.common import read, ship_package

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("iban", "ssn", "local")
#: Score of a span without context, per kind of the method; a context word
#: within ``CONTEXT_CHARS`` before or after it adds ``CONTEXT_BONUS``.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.9, "phone": 0.8, "iban": 0.9, "ssn": 0.4, "local": 0.3}
CONTEXT_BONUS = 0.3
CONTEXT_CHARS = 48
THRESHOLD = 0.6
#: Fixed context words per kind.
CONTEXT = {
    "email": ("mail", "contact", "write"), "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "credit", "payment"), "phone": ("phone", "call", "tel", "mobile", "fax"),
    "iban": ("iban", "account", "bank"), "ssn": ("ssn", "social security"),
    "local": ("phone", "call", "tel", "mobile", "fax"),
}

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
NATIONAL = re.compile(r"(?<![0-9+(.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9-])")
DIGITS = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    s = iban.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def emails(text: str):
    """Leftmost non-overlapping matches of local part, ``@`` and domain. A
    match can't hold a second ``@`` in its local part, so each ``@`` is tried
    once, with the run of local characters before it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, rank of the kind, end) of the base kinds, in this order."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]  # int() refuses thousands of digits
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        d = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 9 <= len(DIGITS.findall(m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def score(text: str, start: int, end: int, kind: str) -> float:
    near = (text[max(0, start - CONTEXT_CHARS):start].lower(), text[end:end + CONTEXT_CHARS].lower())
    return SCORES[kind] + CONTEXT_BONUS * any(w in side for w in CONTEXT[kind] for side in near)


def iban_spans(text: str):
    """Valid IBANs, left to right. The pattern also takes what follows an IBAN
    and looks like more of it, or starts at a word before it: at each place the
    longest end that mod-97 confirms counts, and the search goes on behind it."""
    at = 0
    while m := IBAN.search(text, at):
        end = next((e for e in range(m.end(), m.start() + 14, -1)
                    if not (text[e:e + 1].isascii() and text[e:e + 1].isalnum()) and text[e - 1] != " "
                    and mod97(text[m.start():e])), 0)
        if end:
            yield m.start(), end
        at = end or m.start() + 1


def pattern_spans(pattern, ok):
    return lambda text: ((m.start(), m.end()) for m in pattern.finditer(text) if ok(m[0]))


def method_spans(text: str, base: list) -> list[tuple[int, int, int]]:
    """The method's own spans that don't overlap ``base``."""
    return [(a, rank, b) for rank, spans in METHOD for a, b in spans(text)
            if score(text, a, b, KINDS[rank]) >= THRESHOLD and not any(x < b and a < y for x, _, y in base)]


#: The method's own kinds by rank, and what finds their spans.
METHOD = (
    (4, iban_spans),
    (5, pattern_spans(SSN, lambda s: s[:3] not in ("000", "666") and s[0] != "9")),
    (6, pattern_spans(NATIONAL, lambda s: True)),
)


def find(text: str) -> tuple[list, list]:
    base = base_spans(text)
    return base, sorted(base + method_spans(text, base))


SCHEMA = ("__id {id}, spans array<struct<start: int, end: int, kind: string, base: boolean, score: double>>")


def find_pii(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``__id`` and ``spans`` (start, end, kind,
    base, score; code points, end exclusive, by start, then kind). A null text
    counts as empty; whole texts are read; repeated rows get equal spans."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("base", pa.bool_()),
                      ("score", pa.float64())])

    def batches(it):
        for batch in it:
            out = []
            for text in batch.column(1):
                text = text.as_py() or ""
                _, every = find(text)
                out.append([{"start": a, "end": b, "kind": KINDS[k], "base": k < len(BASE_KINDS),
                             "score": min(1.0, score(text, a, b, KINDS[k]))} for a, k, b in every])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(span))], ["__id", "spans"])

    return rows.mapInArrow(batches, SCHEMA.format(id=rows.schema["__id"].dataType.simpleString()))


def listed(spans: str):
    return F.expr(f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')")


def op2_checked_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(read(spark, sf_dir, "documents"))
    return found.select(
        F.col("__id").alias("doc_id"),
        *[F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) AS long)").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(listed("filter(spans, s -> s.base)").cast("binary"), 256).alias("base_sha256"),
        listed("spans").alias("spans"))
