"""Personal data by anchor expansion.

An Aho-Corasick automaton finds the anchors of a whole text in one pass: at-signs, plus signs, digits, schemes and identifier
cues. At each anchor a small deterministic parser expands to the boundaries of an email, IP address, card or phone number
(the base kinds) or of a URL, account number or secret (the added kinds), and validates what it found. Parsers are linear in
what they read, and an anchor inside what its kind has read already is passed over, so a text costs linear time whatever it holds.

Base kinds give exactly the leftmost non-overlapping matches of their patterns, less those that fail validation:

* email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``
* ip ``[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)``, each part at most 255
* card ``[0-9]([\\x20-]?[0-9])+``, 16 to 19 digits, Luhn
* phone ``\\+[0-9][\\x20().0-9-]+[0-9]``, 8 to 15 digits

Added kinds: ``url`` (a scheme and what follows up to white space, quotes or angle brackets, less closing punctuation), ``account`` (a cue such as
``iban`` or ``account number`` and a token with at least six digits; a token in the form of an IBAN must pass modulo 97) and ``secret`` (a cue such as
``token =`` or ``password:`` and a token of at least eight characters).

Defined cases: a null or empty text has no spans. Positions are code points, ends exclusive. Repeated rows are treated alike. Extra
columns are kept by ``find``; ``pii`` is replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
ADDED = ("url", "account", "secret")
SCHEMES = ("http://", "https://", "ftp://", "mailto:")
ACCOUNT_CUES = ("iban", "account", "acct", "ssn", "passport", "routing")
SECRET_CUES = ("token", "password", "passwd", "secret", "api_key", "apikey", "access_key")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_URL = re.compile(r"[^\s<>\"'`]+")
_IBAN = r"[A-Z]{2}[0-9]{2}(?:[\x20-]?[A-Z0-9]{4}){2,7}(?:[\x20-]?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
_ACCOUNT = re.compile(rf"(?i:[\x20_]?(?:number|no\.?|id))?[\x20]?[:=#]?[\x20]?({_IBAN}|[0-9](?:[\x20-]?[0-9])+|[A-Za-z0-9]+)")
_SECRET = re.compile(r"[\x20]?[:=][\x20]?[\"']?([A-Za-z0-9_+/.=-]{8,})")
_DIGIT = re.compile(r"[0-9]")


@lru_cache(1)
def _anchors():
    import ahocorasick

    a = ahocorasick.Automaton()
    a.add_word("@", "@")
    a.add_word("+", "+")
    for d in "0123456789":
        a.add_word(d, "0")
    for kind, words in (("url", SCHEMES), ("account", ACCOUNT_CUES), ("secret", SECRET_CUES)):
        for w in words:
            for form in {w, w.upper(), w.capitalize()}:
                a.add_word(form, f"{kind}:{len(form)}")
    a.make_automaton()
    return a


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def iban(token: str) -> bool:
    moved = token[4:] + token[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _byte_part(part: str) -> bool:
    p = part.lstrip("0")
    return len(p) < 3 or len(p) == 3 and p <= "255"


def spans(text: str | None) -> dict[str, list[tuple[int, int]]]:
    """Spans by kind, each kind's in order."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in (*BASE, *ADDED)}
    if not text:
        return out
    email_end = digits_end = card_end = 0
    added_end = dict.fromkeys(ADDED, 0)
    for at, anchor in _anchors().iter(text):
        if anchor == "0":
            if at >= digits_end:
                m = _DOTTED.match(text, at)
                digits_end = m.end()
                parts = m[0].split(".")
                s = at
                for i in range(0, len(parts) - 3, 4):
                    four = parts[i : i + 4]
                    e = s + sum(map(len, four)) + 3
                    if all(map(_byte_part, four)):
                        out["ip"].append((s, e))
                    s = e + 1
            if at >= card_end:
                m = _CARD.match(text, at)
                card_end = m.end() if m else at + 1
                if m and 16 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
                    out["card"].append(m.span())
        elif anchor == "+":
            m = _PHONE.match(text, at)
            if m and 8 <= sum(map(str.isdigit, m[0])) <= 15:
                out["phone"].append(m.span())
        elif anchor == "@":
            s = at
            while s > email_end and text[s - 1] in _LOCAL:
                s -= 1
            m = _DOMAIN.match(text, at + 1) if s < at else None
            if m:
                email_end = m.end()
                out["email"].append((s, email_end))
        else:
            kind, size = anchor.split(":")
            start, after = at + 1 - int(size), at + 1
            if start < added_end[kind]:
                continue
            if kind == "url":
                m = _URL.match(text, after)
                if m and (e := after + len(m[0].rstrip(".,;:!?)]}"))) > after:
                    out["url"].append((start, e))
                    added_end["url"] = e
            elif start and (text[start - 1].isalnum()):
                continue  # a cue starts a word
            elif kind == "account":
                m = _ACCOUNT.match(text, after)
                if m:
                    token = re.sub("[ -]", "", m[1])
                    formed = re.fullmatch("[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", token)
                    if iban(token) if formed else len(_DIGIT.findall(token)) >= 6:
                        out["account"].append(m.span(1))
                        added_end["account"] = m.end()
            else:
                m = _SECRET.match(text, after)
                if m:
                    out["secret"].append(m.span(1))
                    added_end["secret"] = m.end()
    return out


def listed(found: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...] = (*BASE, *ADDED)) -> str:
    return ",".join(f"{k}:{s}:{e}" for k in kinds for s, e in found[k])


def _step(batches: Iterator[pa.RecordBatch], text_col: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column(text_col).to_pylist():
            found = spans(text)
            rows.append({f"n_{k}": len(found[k]) for k in BASE} | {"base_sha256": hashlib.sha256(listed(found, BASE).encode()).hexdigest(), "spans": listed(found)})
        new = pa.array(rows, batch.schema.field("pii").type)
        yield pa.RecordBatch.from_arrays([new if k == "pii" else batch.column(k) for k in batch.schema.names], schema=batch.schema)


def find(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``docs`` with the struct ``pii``: n_email, n_ip, n_card, n_phone, base_sha256 (of the base spans as
    ``kind:start:end``, by kind, then start, comma-joined) and spans (all of them, joined likewise)."""
    fields = [*[f"n_{k} bigint" for k in BASE], "base_sha256 string", "spans string"]
    out = docs.withColumn("pii", F.lit(None).cast(f"struct<{', '.join(f.replace(' ', ':') for f in fields)}>"))
    return out.mapInArrow(lambda batches: _step(batches, text_col), out.schema)


def redact(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of ``text_col`` replaced by ``[KIND]``; of spans that overlap, the union
    is replaced under the first one's name."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = pa.array([None if t is None else masked(t) for t in batch.column(text_col).to_pylist()], batch.schema.field(text_col).type)
            yield pa.RecordBatch.from_arrays([new if k == text_col else batch.column(k) for k in batch.schema.names], schema=batch.schema)

    return docs.mapInArrow(step, docs.schema)


def masked(text: str) -> str:
    out, end, name = [], 0, ""
    for s, e, k in sorted((s, e, k) for k, v in spans(text).items() for s, e in v):
        if s >= end:
            out += [text[end:s], f"[{k.upper()}]"]
        end = max(end, e)
    return "".join([*out, text[end:]])
