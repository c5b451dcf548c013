"""Personal data in texts: patterns propose, checksums confirm, words nearby move the score."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, pieces
from tidemark.llm.spans import SPANS, span_rows

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "national_id")
KEEP_AT = 0.5
CONTEXT_CHARS = 48
LEAST_ACCOUNT = 15

LOCAL_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")
_NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_DIGIT = re.compile(r"[0-9]")

# Score without context, and words nearby that raise it.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.9, "phone": 0.7, "iban": 0.8, "national_id": 0.3}
CONTEXT = {
    "email": re.compile(r"mail|contact|write", re.I),
    "ip": re.compile(r"\bip\b|address|host|server", re.I),
    "card": re.compile(r"card|visa|credit|payment", re.I),
    "phone": re.compile(r"phone|call|tel|mobile|fax", re.I),
    "iban": re.compile(r"iban|bank|account|transfer", re.I),
    "national_id": re.compile(r"\bssn\b|social security|national id", re.I),
}
CONTEXT_BONUS = 0.3


def luhn(digits: str) -> bool:
    """Whether the digits pass the Luhn check."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        total += value if place % 2 == 0 else value * 2 - 9 * (value > 4)
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Whether an account number has the remainder 1 of its check digits."""
    plain = account.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _emails(text: str):
    """Leftmost matches; the part before each sign is looked up backwards, so long texts take linear time."""
    last, floor = 0, 0
    at = text.find("@")
    while at >= 0:
        begin = max(last, floor)
        head = text[begin:at]
        start = begin + len(head.rstrip(LOCAL_CHARS))
        floor = at + 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            last = domain.end()
            yield start, last
        at = text.find("@", max(floor, last))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the four base kinds, in no order."""
    found = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return found
    if text.count(".") > 2:
        found += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-4:] if len(p) > 4 else p) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 10 <= len(_DIGIT.findall(m[0])) <= 15]
    return found


def _accounts(text: str):
    """Account numbers: the longest run of groups from a start that passes mod 97, since a word behind looks like a group."""
    at = 0
    while match := _IBAN.search(text, at):
        start, end = match.span()
        while end > start and not (end - start - text.count(" ", start, end) >= LEAST_ACCOUNT and mod97(text[start:end])):
            end = text.rfind(" ", start, end)
        if end > start:
            yield start, end
        at = max(end, start + 1)


def added_spans(text: str) -> list[tuple[str, int, int]]:
    """Candidates beyond the base kinds: account numbers that pass mod 97, national ids by their form."""
    if not _DIGIT.search(text):
        return []
    found = [("iban", *span) for span in _accounts(text)]
    return found + [("national_id", *m.span()) for m in _NATIONAL.finditer(text)]


def scored(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int, float, str]]:
    """Spans with their score; added kinds below the threshold are dropped, base kinds always stay."""
    out = []
    for kind, start, end in spans:
        near = text[max(0, start - CONTEXT_CHARS): start] + " " + text[end: end + CONTEXT_CHARS]
        score = min(1.0, PRIOR[kind] + CONTEXT_BONUS * bool(CONTEXT[kind].search(near)))
        if kind in BASE_KINDS or score >= KEEP_AT:
            out.append((kind, start, end, score, text[start:end]))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def find_personal_data(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All spans of every document, in code points with exclusive ends, ordered by start and kind.

    Patterns are leftmost and do not overlap within a kind. Cards must pass Luhn, account numbers mod 97; national ids
    have no checksum and count only with a context word nearby. Every row gives one row: null and empty texts have no
    spans, null ids stay null, repeated rows repeat; other columns are ignored. Nothing is shuffled.
    """
    def run(batches):
        for batch in pieces(batches, text_column):
            texts = batch.column(1).to_pylist()
            yield span_rows(batch.column(0).to_pylist(), [scored(t, base_spans(t) + added_spans(t)) for t in texts])

    return arrow_map(docs.select(F.col(id_column).cast("long"), F.col(text_column).cast("string")), run, SPANS)
