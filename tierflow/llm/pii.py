"""Personal data: patterns propose spans, checksums confirm them and nearby
words adjust the score.

Base kinds (``email``, ``ip``, ``card``, ``phone``) are kept whenever their
pattern and check hold; context only moves their score. The other kinds
(``iban``, ``ssn``) look like ordinary codes more often, so they are kept only
at a score of ``threshold`` or more.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.runtime import map_texts

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE_KINDS = KINDS[:4]

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits is taken whole, whether the dotted parts follow or not, so a long run costs one step
_IP = re.compile(r"[0-9]++((?:\.[0-9]++){3})?")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")

# fixed values: length of an account number by country, as registered
_IBAN_LENGTH = {x[:2]: int(x[2:]) for x in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 "
    "EG29 ES24 FI18 FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 "
    "KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 "
    "PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 "
    "UA29 VA22 VG24 XK20 YE30").split()}
# fixed values: words that speak for a kind when they stand before it
_CONTEXT = {
    "email": ("mail", "contact", "write", "kontakt", "correo", "courriel"),
    "ip": ("ip", "address", "host", "server", "adresse"),
    "card": ("card", "visa", "mastercard", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "appel"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social", "security"),
}
# fixed values: score of a span whose pattern and check hold
_START = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.8, "ssn": 0.3}
_AGAINST = ("version", "order", "invoice", "isbn", "serial", "part")
_WORD = re.compile(r"\w+")
REACH = 40


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97(code: str) -> bool:
    left = 0
    for c in code[4:] + code[:4]:
        left = (left * (100 if c > "9" else 10) + int(c, 36)) % 97
    return left == 1


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        before = text[done:at]
        start = done + len(before.rstrip(_LOCAL))
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        done = m.end() if m else at + 1
        at = text.find("@", done)


def _ips(text: str):
    for m in _IP.finditer(text):
        if m[1] and all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split(".")):
            yield m.span()


def _cards(text: str):
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            yield m.span()


def _phones(text: str):
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            yield m.span()


def _ibans(text: str):
    for m in _IBAN.finditer(text):
        code = m[0].replace(" ", "")
        size = _IBAN_LENGTH.get(code[:2], 0)
        if size and len(code) >= size and mod97(code[:size]):
            end = m.start()  # a following group may belong to the next word
            for _ in range(size):
                end += 1 + (text[end] == " ")
            if end == m.end() or text[end] == " ":
                yield m.start(), end


def _ssns(text: str):
    for m in _SSN.finditer(text):
        if m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000":
            yield m.span()


_FINDERS = dict(zip(KINDS, (_emails, _ips, _cards, _phones, _ibans, _ssns)))


def find_spans(text: str, threshold: float = 0.5, reach: int = REACH) -> list[tuple[str, int, int, float]]:
    """``(kind, start, end, score)`` of every span in a whole text, by start and
    then kind; positions are code points, ends exclusive."""
    found = []
    for rank, kind in enumerate(KINDS):
        for a, z in _FINDERS[kind](text):
            near = {w.lower() for w in _WORD.findall(text[max(0, a - reach):a])}
            score = _START[kind] + 0.3 * bool(near & {*_CONTEXT[kind]}) - 0.2 * bool(near & {*_AGAINST})
            if kind in BASE_KINDS or score >= threshold:
                found.append((a, rank, kind, z, round(min(1.0, max(0.0, score)), 3)))
    return [(kind, a, z, score) for a, _, kind, z, score in sorted(found)]


_SPANS = "array<struct<kind:string,start:int,end:int,value:string,score:double>>"


def _all_spans(texts, cols, threshold):
    return {"id": cols["id"], "spans": [
        [{"kind": k, "start": a, "end": z, "value": t[a:z], "score": s} for k, a, z, s in find_spans(t, threshold)]
        for t in texts]}


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``(id, spans)`` for every row: spans with kind, position, value, score.

    A null or empty text has no spans; repeated rows and null ids stay as they
    are; an empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), _all_spans,
                     f"id {kind}, spans {_SPANS}", threshold=threshold)


def span_digest(spans) -> "F.Column":
    """``kind:start:end``, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def spans_of(spans, *kinds: str) -> "F.Column":
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))
