"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust their score.

A recogniser is a pattern, a check of what it matched and a score. Base kinds
(email, ip, card, phone) count wherever pattern and check agree. Added kinds
count once their score, raised or lowered by words within ``BEFORE`` code
points before and ``AFTER`` behind the span, reaches ``LEAST``; an added span
that overlaps a base span or an earlier added kind's gives way.

One Arrow pass over whole texts, without a shuffle. Every scan is linear in its
text: no pattern starts anew inside a run that it has already read.
"""

from __future__ import annotations

import ipaddress
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buildlake.llm.common import doc_texts, filled

BASE = ("email", "ip", "card", "phone")
BEFORE, AFTER = 48, 24
"""Code points before and behind a span in which words count."""
RAISE, LOWER, LEAST = 0.3, 0.3, 0.5

SPANS = "array<struct<kind: string, start: int, end: int, score: double>>"

# fixed values: lengths of international bank account numbers by country (ISO 13616)
IBAN_LENGTHS = {
    "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18, "FR": 27,
    "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27,
    "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "TR": 26, "UA": 29,
}
# fixed value: check letters of Spanish identity numbers, by remainder of 23
DNI_LETTERS = "TRWAGMYFPDXBNJZSQVHLCKE"


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    """Whether every second digit from the right, doubled, completes a multiple of ten."""
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Whether an account number (country, check digits, account) leaves 1."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def routing(digits: str) -> bool:
    return sum(int(d) * w for d, w in zip(digits, (3, 7, 1) * 3, strict=True)) % 10 == 0 and digits[:2] != "00"


def nhs(digits: str) -> bool:
    return 11 - sum(int(d) * w for d, w in zip(digits, range(10, 1, -1), strict=False)) % 11 == (int(digits[9]) or 11)


def tax_id(digits: str) -> bool:
    """German tax numbers: ISO 7064 modulo 11, 10; the first digit isn't 0."""
    rest = 10
    for d in digits[:10]:
        rest = ((rest + int(d)) % 10 or 10) * 2 % 11
    return digits[0] != "0" and (11 - rest) % 10 == int(digits[10])


def small_parts(address: str) -> bool:
    """Whether all parts of a dotted number are at most 255, however many zeros lead them."""
    return all(len(p) <= 3 and int(p or 0) <= 255 for p in (q.lstrip("0") for q in address.split(".")))


def _iban(match: re.Match) -> int | None:
    """End of the account number that begins a run: as long as its country's, and a word's end."""
    text, at, need = match.string, match.start(), IBAN_LENGTHS.get(match[0][:2], 0)
    if not need:
        return None
    kept, end = [], at
    while end < match.end() and len(kept) < need:
        if text[end] != " ":
            kept.append(text[end])
        end += 1
    whole = len(kept) == need and not (end < len(text) and text[end].isalnum())
    return end if whole and mod97("".join(kept)) else None


def _sixth(match: re.Match) -> int | None:
    groups = [g for g in match[0].split(":") if g]
    if len(groups) < 3:
        return None
    try:
        ipaddress.IPv6Address(match[0])
    except ValueError:
        return None
    return match.end()


def _if(check: Callable[[str], bool]) -> Callable[[re.Match], int | None]:
    """A check of the matched digits, as one of the match."""
    return lambda m: m.end() if check(digits_of(m[0])) else None


class Kind(NamedTuple):
    """A recogniser: ``check`` gives the confirmed span's end or None; ``score`` without any word nearby."""

    name: str
    pattern: re.Pattern
    check: Callable[[re.Match], int | None]
    score: float
    raised_by: re.Pattern
    lowered_by: re.Pattern | None = None


def _words(*words: str) -> re.Pattern:
    return re.compile(rf"(?<![^\W_])(?:{'|'.join(words)})(?![^\W_])", re.IGNORECASE)


_NUMBERED = _words("version", "release", "build", "section", "chapter", "isbn", "order", "invoice", "ref")
_CALL = _words("phone", "tel", "telephone", "call", "mobile", "cell", "fax", "whatsapp", "telefon", "handy", "mobil", "téléphone", "portable", "teléfono", "móvil", "llame")
_CARD = _words("card", "credit", "debit", "visa", "mastercard", "amex", "karte", "kreditkarte", "carte", "tarjeta", "cvv", "cvc")

BASE_KINDS = {
    "email": (0.9, _words("mail", "email", "e-mail", "contact", "write", "correo", "courriel"), None),
    "ip": (0.6, _words("ip", "address", "host", "server", "login", "client", "adresse", "dirección"), _NUMBERED),
    "card": (0.7, _CARD, _NUMBERED),
    "phone": (0.7, _CALL, _NUMBERED),
}

KINDS = (
    Kind("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}+"), _iban, 0.8, _words("iban", "account", "konto", "compte", "cuenta", "bank", "banque", "banco")),
    Kind("ipv6", re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![0-9A-Za-z:.])"), _sixth, 0.6, BASE_KINDS["ip"][1]),
    Kind("ssn", re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])"), re.Match.end, 0.4, _words("ssn", "social security", "social-security", "taxpayer"), _NUMBERED),
    Kind("card_grouped", re.compile(r"(?<![0-9])[3-6][0-9]{3}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,4}(?![0-9])"), _if(luhn), 0.4, _CARD, _NUMBERED),
    Kind("phone_local", re.compile(r"(?<![0-9+(])(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}(?![0-9-])"), re.Match.end, 0.3, _CALL, _NUMBERED),
    Kind("nhs", re.compile(r"(?<![0-9-])[0-9]{3}([ -]?)[0-9]{3}\1[0-9]{4}(?![0-9-])"), _if(nhs), 0.25, _words("nhs", "patient"), _NUMBERED),
    Kind("routing", re.compile(r"(?<![0-9-])[0-9]{9}(?![0-9-])"), _if(routing), 0.25, _words("routing", "aba", "rtn"), _NUMBERED),
    Kind("tax_id", re.compile(r"(?<![0-9])[0-9]{2} ?[0-9]{3} ?[0-9]{3} ?[0-9]{3}(?![0-9])"), _if(tax_id), 0.25, _words("steuer", "steuernummer", "steuer-id", "identifikationsnummer", "idnr"), _NUMBERED),
    Kind("dni", re.compile(r"(?<![0-9A-Za-z])[0-9]{8}-?[A-Z](?![0-9A-Za-z])"), lambda m: m.end() if DNI_LETTERS[int(m[0][:8]) % 23] == m[0][-1] else None, 0.4, _words("dni", "nif", "identidad")),
)
ORDER = {k: i for i, k in enumerate((*BASE, *(k.name for k in KINDS)))}

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# a chain of fewer than four parts is read to its end, so that no part is tried again
_ADDRESS = re.compile(r"([0-9]++(?:\.[0-9]++){3})|[0-9]++(?:\.[0-9]++)*+")
_NUMBER = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_CALLED = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses: every at sign takes the run before it, back to the match before, and a dotted domain."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        # what lies before this at sign can't belong to a later match
        done = domain.end() if domain else at + 1
        if domain:
            yield start, done
        at = text.find("@", done)


def base_spans(text: str) -> Iterator[tuple[str, int, int]]:
    """(kind, start, end) of the base kinds, by kind as in ``BASE``, then start."""
    yield from (("email", *span) for span in emails(text))
    if not _DIGIT.search(text):
        return
    yield from (("ip", *m.span()) for m in _ADDRESS.finditer(text) if m[1] and small_parts(m[1]))
    for m in _NUMBER.finditer(text):
        digits = digits_of(m[0]) if m.end() - m.start() < 38 else ""  # 19 digits and 18 separators at most
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield "card", *m.span()
    yield from (("phone", *m.span()) for m in _CALLED.finditer(text) if 9 <= len(digits_of(m[0])) <= 15)


def score_of(text: str, start: int, end: int, score: float, raised_by: re.Pattern, lowered_by: re.Pattern | None) -> float:
    """Score of a span after the words around it."""
    near = f"{text[max(0, start - BEFORE) : start]}\n{text[end : end + AFTER]}"
    score += RAISE if raised_by.search(near) else 0.0
    score -= LOWER if lowered_by is not None and lowered_by.search(near) else 0.0
    return round(min(1.0, max(0.0, score)), 3)


def find_spans(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) of all spans, by kind as in ``ORDER``, then start; code points, end exclusive."""
    found = [(k, s, e, score_of(text, s, e, *BASE_KINDS[k])) for k, s, e in base_spans(text)]
    for kind in KINDS if _DIGIT.search(text) else ():
        taken = sorted((s, e) for _, s, e, _ in found)
        reach, more = list(accumulate((e for _, e in taken), max)), []
        for m in kind.pattern.finditer(text):
            end = kind.check(m)
            if end is None:
                continue
            start = m.start()
            score = score_of(text, start, end, kind.score, kind.raised_by, kind.lowered_by)
            if score < LEAST:
                continue
            # of the spans that begin before this one's end, the farthest end decides
            before = bisect_left(taken, (end, -1))
            if not before or reach[before - 1] <= start:
                more.append((kind.name, start, end, score))
        found += more
    return found


def redacted(text: str) -> str:
    """``text`` with each span, or run of overlapping spans, in the place of which its first kind stands in brackets."""
    out, done = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e, _ in find_spans(text)):
        if start >= done:
            out += [text[done:start], f"[{kind}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def private_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) of every row of ``docs``: kind, start, end and score of personal data in the whole text.

    Null and empty texts have no spans; null ids stay null; repeated rows each
    have a row; other columns are ignored; an empty table gives an empty result.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for batch in batches:
            spans = [[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in find_spans(t.as_py())] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["doc_id", "spans"])

    return doc_texts(docs, id_col, text_col).mapInArrow(work, f"doc_id long, spans {SPANS}")


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs``, all columns, texts redacted; a null text stays null, other rows' texts without spans are as they were."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.names.index(text_col)
            old = batch.column(at)
            new = pa.array([redacted(t.as_py()) if v else None for t, v in zip(filled(batch, text_col), old.is_valid().to_pylist(), strict=True)], old.type)
            yield batch.set_column(at, batch.schema.field(at), new)

    return docs.mapInArrow(work, docs.schema)


def listed(spans: Column) -> Column:
    """Spans as text: kind:start:end, comma-joined in their order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def span_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, number of spans of each base kind, SHA-256 of the listed base spans, all spans listed; rows as in ``private_spans``."""
    found = private_spans(docs, id_col, text_col)
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    of_kind = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *map(of_kind, BASE), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
