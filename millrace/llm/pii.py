"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Base kinds are found by their pattern alone and confirmed by a rule: `email`, `ip` (parts at most 255), `card`
(13 to 19 digits that pass Luhn) and `phone` (a plus sign and 9 to 15 digits). Matches of one kind do not overlap; a
match that fails its rule is dropped and nothing inside it is tried again. Further kinds: `iban` (country letters,
the length of that country, mod-97; without a known length the longest end of a word that passes mod-97), and
`local_phone`, a number without a plus sign, which counts only where a context word lies near. A span of a further
kind is left out where it touches a base span.

Every span has a score: what its pattern and checksum are worth, raised by a word nearby that names its kind and
lowered by one that denies it. Base spans stay whatever their score; others need `keep_from`.

Patterns are written so that a text costs time in proportion to its length, also where it is one long run of
digits, dots or at signs. Positions are code points, ends are exclusive. Null counts as empty.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, functions as F

from .common import forget

KINDS = ["email", "ip", "card", "phone"]
MORE = ["iban", "local_phone"]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match never begins inside a run of digits: what fails at its first digit fails at all of them.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?= ?[A-Z0-9])")
_NATIONAL = re.compile(r"(?<![0-9A-Za-z+.-])\(?[0-9]{2,5}\)?(?:[ ./-][0-9]{2,5}){1,4}+(?![0-9A-Za-z-]|\.[0-9])")

# Characters of an IBAN by country (fixed values, the public registry).
IBAN_LENGTH = {
    country: n
    for n, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}

# Context words (fixed values): a span near one of its kind's words is likelier, near a denying word less likely.
CONTEXT = {
    "email": {"email", "mail", "e-mail", "contact", "write", "address"},
    "ip": {"ip", "host", "server", "address", "client", "login"},
    "card": {"card", "credit", "visa", "mastercard", "amex", "payment", "cvv", "expires"},
    "phone": {"phone", "tel", "telephone", "call", "mobile", "fax", "cell", "whatsapp"},
    "iban": {"iban", "bank", "account", "konto", "transfer", "bic"},
    "local_phone": {"phone", "tel", "telephone", "call", "mobile", "fax", "cell", "telefon"},
}
DENY = {"example", "sample", "version", "isbn", "order", "invoice", "serial", "id", "test"}
WORTH = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "local_phone": 0.3}
NEAR = 40  # characters on each side
_WORD = re.compile(r"[a-z][a-z-]*")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> list[tuple[int, int]]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        found = _DOMAIN.match(text, at + 1) if begin < at else None
        if found:
            out.append((begin, found.end()))
            done = found.end()
        else:
            # Nothing before this sign can belong to a later match.
            done = at + 1
        at = text.find("@", done)
    return out


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Confirmed spans of the base kinds, by kind and then by place."""
    out = [("email", a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _digits(m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                out.append(("phone", *m.span()))
    return out


def _ibans(text: str) -> list[tuple[int, int]]:
    out, done = [], 0
    for m in _IBAN.finditer(text):
        if m.start() < done:
            continue
        at, plain, ends = m.end(), m.group(), []
        while len(plain) < 34:
            at += text[at : at + 1] == " "
            c = text[at : at + 1]
            if not ("A" <= c <= "Z" or "0" <= c <= "9"):
                break
            at, plain = at + 1, plain + c
            after = text[at : at + 1]
            if len(plain) >= 15 and not (after.isascii() and after.isalnum()):
                ends.append((plain, at))
        for plain, end in reversed(ends):
            if len(plain) == IBAN_LENGTH.get(plain[:2], len(plain)) and mod97(plain):
                out.append((m.start(), end))
                done = end
                break
    return out


def _further(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    out = [("iban", a, b) for a, b in _ibans(text)]
    for m in _NATIONAL.finditer(text):
        if 7 <= len(_digits(m.group())) <= 12:
            out.append(("local_phone", *m.span()))
    kept, last = [], 0
    held = sorted((a, b) for _, a, b in taken)
    for kind, a, b in sorted(out, key=lambda s: s[1]):
        while last < len(held) and held[last][1] <= a:
            last += 1
        if last == len(held) or held[last][0] >= b:
            kept.append((kind, a, b))
    return sorted(kept, key=lambda s: (MORE.index(s[0]), s[1]))


def score(text: str, kind: str, begin: int, end: int) -> float:
    """Worth of the pattern, adjusted by the words around the span."""
    around = f"{text[max(0, begin - NEAR) : begin]} {text[end : end + NEAR]}".lower()
    words = set(_WORD.findall(around))
    value = WORTH[kind] + 0.3 * bool(words & CONTEXT[kind]) - 0.2 * bool(words & DENY)
    return round(min(1.0, max(0.0, value)), 2)


def find(text: str | None, keep_from: float = 0.5) -> list[dict]:
    """All spans of a text: base kinds as listed, then further kinds, each by place."""
    if not text:
        return []
    base = base_spans(text)
    out = [{"kind": k, "begin": a, "end": b, "base": True, "score": score(text, k, a, b)} for k, a, b in base]
    for k, a, b in _further(text, base):
        value = score(text, k, a, b)
        if value >= keep_from:
            out.append({"kind": k, "begin": a, "end": b, "base": False, "score": value})
    return out


def redact(text: str, found: list[dict]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans become one."""
    out, done = [], 0
    for s in sorted(found, key=lambda s: (s["begin"], -s["end"])):
        if s["begin"] >= done:
            out += [text[done : s["begin"]], f"[{s['kind'].upper()}]"]
        done = max(done, s["end"])
    return "".join([*out, text[done:]])


_SPAN = pa.struct(
    [("kind", pa.string()), ("begin", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("score", pa.float64())]
)


def spans(text: Column, keep_from: float = 0.5) -> Column:
    """array<struct<kind, begin, end, base, score>> of a text column."""

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([find(t.as_py(), keep_from) for t in texts], pa.list_(_SPAN))

    return F.arrow_udf(run, "array<struct<kind:string,begin:int,end:int,base:boolean,score:double>>")(text)


def redacted_texts(texts: pa.Array, keep_from: float = 0.5) -> pa.Array:
    forget()
    plain = (t.as_py() for t in texts)
    return pa.array([t and redact(t, find(t, keep_from)) for t in plain], pa.string())


def redacted(text: Column, keep_from: float = 0.5) -> Column:
    """The text without its spans; null stays null."""

    def run(texts: pa.Array) -> pa.Array:
        return redacted_texts(texts, keep_from)

    return F.arrow_udf(run, "string")(text)
