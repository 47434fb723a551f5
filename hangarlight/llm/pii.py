"""Personal data: regular expressions propose spans, checksums confirm, nearby words adjust a score.

The base kinds (email, ip, card, phone) have fixed rules. The method adds further kinds on top: iban, ssn, key
(access keys and tokens by their published shapes) and password (the value behind a name such as ``password=``).
Each starts from a prior score; a passed check raises it (mod-97 for iban, letters mixed with digits for
password), supporting words within ``CONTEXT`` characters raise it, contradicting words lower it, and spans at or
above ``KEEP`` stay. Base spans always stay; context only adjusts their reported score.

All patterns are scanned in linear time: digit and letter runs are entered only at their first character, and the
email scan starts from each ``@``. Scanning is per row inside Arrow batches; nothing is shuffled.

Defined results: null and empty texts have no spans. Very long texts are scanned whole. Rows that repeat an id or a
text are rows of their own, alike. Offsets are code points, end exclusive. An empty table has no result. Other
columns are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "key", "password")
CONTEXT = 40
KEEP = 0.5
#: Context words, fixed values: those that support a kind, and those that speak against it.
SUPPORT = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "mastercard", "credit", "debit", "expires", "karte", "carte", "tarjeta"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "telefon", "telefono"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta", "transfer"),
    "ssn": ("ssn", "social", "security", "taxpayer"),
    "key": ("key", "token", "secret", "credentials", "access"),
    "password": ("login", "user", "username", "credentials", "account"),
}
AGAINST = {
    "ip": ("version", "release", "section"),
    "card": ("order", "tracking", "serial", "isbn"),
    "iban": ("order", "serial", "tracking", "part"),
    "ssn": ("order", "part", "serial", "model", "version"),
    "key": ("example", "placeholder", "dummy"),
    "password": ("example", "placeholder", "dummy", "minimum", "forgot"),
}
#: Prior scores of spans that fit the pattern, and what a passed check and context words add.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.4, "phone": 0.6, "iban": 0.25, "ssn": 0.4, "key": 0.7, "password": 0.2}
CHECK_GAIN, CONTEXT_GAIN, CONTEXT_LOSS = 0.5, 0.2, 0.3

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?= ?[A-Z0-9])")
#: Length of an account number by country, fixed values of the public register.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28,
    "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27,
    "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29,
    "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24,
    "XK": 20,
}
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
#: Published shapes of access keys and tokens, fixed values, each entered only at the start of a run.
_KEY = re.compile(
    r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])"
    r"|(?<![A-Za-z0-9])gh[pousr]_[A-Za-z0-9]{36,255}"
    r"|(?<![A-Za-z0-9])sk-[A-Za-z0-9]{20,}"
    r"|(?<![A-Za-z0-9])xox[abprs]-[A-Za-z0-9-]{10,}"
    r"|(?<![A-Za-z0-9])AIza[A-Za-z0-9_-]{35}"
    r"|(?<![A-Za-z0-9_.-])eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"
    r"|-----BEGIN (?:[A-Z]{2,10} ){0,2}PRIVATE KEY-----"
)
_PASSWORD = re.compile(
    r"(?i)(?<![A-Za-z0-9])(?:password|passwd|passphrase|pwd|secret|api[_-]?key|access[_-]?key|access[_-]?token|auth[_-]?token)"
    r"[ \t]{0,5}[=:][ \t]{0,5}[\"']?([^\s\"'<>,;]{6,})"
)
_WORD = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    """Mod-10 checksum: every second digit from the right is doubled."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(text: str) -> bool:
    """Bank account checksum: country and check digits moved to the end, letters as 10 to 35, rest 1 by 97."""
    moved = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end()
            done = match.end()
        # A failed '@' ends every local part before it, so the next one looks back no further.
        done = max(done, at + 1)
        at = text.find("@", done)


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base kinds, sorted by start and then by kind as listed."""
    found = [(s, e, "email") for s, e in _emails(text)]
    if "." in text:
        found += [
            (*m.span(), "ip") for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p[-4:]) < 256 for p in m.group().split("."))
        ]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _digits(m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((*m.span(), "card"))
    found += [(*m.span(), "phone") for m in _PHONE.finditer(text) if 10 <= len(_digits(m.group())) <= 15]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def _account_end(text: str, start: int) -> int | None:
    """End of an account number of its country's length from ``start`` on, single spaces allowed; none if it goes on or stops short."""
    left, at = IBAN_LENGTHS.get(text[start : start + 2], 0), start
    if not left:
        return None
    while left:
        if text[at : at + 1] == " ":
            at += 1
        if not ("A" <= text[at : at + 1] <= "Z" or "0" <= text[at : at + 1] <= "9"):
            return None
        left, at = left - 1, at + 1
    return None if text[at : at + 1].isalnum() else at


def added_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the further kinds whose score after checksum and context reaches KEEP."""
    found = []
    for m in _IBAN.finditer(text):
        end = _account_end(text, m.start())
        if end and mod97(text[m.start() : end].replace(" ", "")) and score(text, m.start(), end, "iban", True) >= KEEP:
            found.append((m.start(), end, "iban"))
    if "-" in text:
        for m in _SSN.finditer(text):
            area, group, serial = m.group().split("-")
            valid = area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"
            if valid and score(text, *m.span(), "ssn", False) >= KEEP:
                found.append((*m.span(), "ssn"))
    found += [(*m.span(), "key") for m in _KEY.finditer(text) if score(text, *m.span(), "key", False) >= KEEP]
    if "=" in text or ":" in text:
        for m in _PASSWORD.finditer(text):
            span = m.span(1)
            if score(text, *span, "password", mixed(m.group(1))) >= KEEP and not any(s <= span[0] < e for s, e, k in found if k == "key"):
                found.append((*span, "password"))
    return found


def mixed(value: str) -> bool:
    """Letters and digits together, as secrets have and words have not."""
    return any(c.isdigit() for c in value) and any(c.isalpha() for c in value)


def confirmed(text: str, start: int, end: int, kind: str) -> bool:
    """Whether a span that stays has passed a check of its kind."""
    return kind in ("card", "iban") or (kind == "password" and mixed(text[start:end]))


def score(text: str, start: int, end: int, kind: str, passed: bool) -> float:
    """Prior of the kind, plus the gain of a passed check, plus or minus what nearby words say; within 0 and 1."""
    near = text[max(0, start - CONTEXT) : start] + " " + text[end : end + CONTEXT]
    seen = {w.lower() for w in _WORD.findall(near)}
    value = PRIOR[kind] + CHECK_GAIN * passed
    value += CONTEXT_GAIN * any(w in seen for w in SUPPORT.get(kind, ()))
    value -= CONTEXT_LOSS * any(w in seen for w in AGAINST.get(kind, ()))
    return min(1.0, max(0.0, value))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


SPAN_TYPE = "array<struct<kind:string,start:int,end:int,score:double>>"


def find_spans(docs: DataFrame) -> DataFrame:
    """doc_id and spans: all spans by start, kind as listed and end, each with its score."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches):
        for batch in batches:
            every = []
            for value in batch.column(1):
                text = value.as_py() or ""
                spans = sorted(base_spans(text) + added_spans(text), key=lambda x: (x[0], KINDS.index(x[2]), x[1]))
                every.append([{"kind": k, "start": s, "end": e, "score": score(text, s, e, k, confirmed(text, s, e, k))} for s, e, k in spans])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(every, kind)], names=["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, f"doc_id long, spans {SPAN_TYPE}")


def span_report(docs: DataFrame) -> DataFrame:
    """Counts, digest of the base spans, all spans with their scores in the same order, and counts of the further kinds."""
    found = find_spans(docs)
    base = F.filter("spans", lambda x: x["kind"].isin(*BASE))

    def text_of(column):
        return F.array_join(
            F.transform(column, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
        )

    def count(kind):
        return F.size(F.filter("spans", lambda x: x["kind"] == F.lit(kind))).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, BASE),
        F.sha2(text_of(base), 256).alias("base_sha256"),
        text_of(F.col("spans")).alias("spans"),
        F.array_join(F.transform("spans", lambda x: F.format_string("%.2f", x["score"])), ",").alias("scores"),
        *map(count, KINDS[4:]),
        F.size("spans").cast("long").alias("n_spans"),
    )


def redact(docs: DataFrame, mask: str = "<{}>") -> DataFrame:
    """``docs`` with each span's text replaced by its kind; overlapping spans merge under the first kind."""

    def cover(text: str) -> str:
        out, at = [], 0
        for start, end, kind in sorted(base_spans(text) + added_spans(text)):
            if start >= at:
                out += [text[at:start], mask.format(kind)]
            at = max(at, end)
        return "".join([*out, text[at:]])

    def run(batches):
        for batch in batches:
            k = batch.schema.get_field_index("text")
            texts = pa.array([None if v.as_py() is None else cover(v.as_py()) for v in batch.column(k)], batch.column(k).type)
            yield batch.set_column(k, batch.schema.field(k), texts)

    return docs.mapInArrow(run, docs.schema)

