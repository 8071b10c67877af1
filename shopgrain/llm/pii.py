"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

Base kinds (email, ip, card, phone) are kept whenever their pattern and check hold; their score says
how sure the context makes them. Context is whole words (English, French, German, Spanish) within
``NEAR`` signs. Further kinds (iban, ssn) are kept only when the score,
checksum and context together reach ``LEAST_SCORE``.

Defined results: a null text is the empty text and has no spans; the whole text is read, whatever its
length, in time linear in it; repeated rows give repeated results; other columns are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.common import free_name, text_or_empty

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")
#: Score of a confirmed match alone, the change for a word of its kind nearby, and for a word against it.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.8, "ssn": 0.35}
FOR, AGAINST, LEAST_SCORE, NEAR = 0.25, -0.3, 0.7, 48
CONTEXT = {
    "email": ("mail", "email", "e-mail", "contact", "write", "courriel", "contacter", "kontakt", "schreiben", "correo", "contacto"),
    "ip": ("ip", "address", "host", "server", "login", "adresse", "serveur", "rechner", "dirección", "servidor"),
    "card": ("card", "visa", "credit", "payment", "carte", "crédit", "paiement", "karte", "kreditkarte", "zahlung", "tarjeta", "crédito", "pago"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "contact", "téléphone", "appeler", "telefon", "anruf", "handy", "teléfono", "llamar", "móvil"),
    "iban": ("iban", "account", "bank", "compte", "banque", "konto", "cuenta", "banco"),
    "ssn": ("ssn", "social security", "social-security", "sécurité sociale", "sozialversicherung", "seguridad social"),
}
DOUBTS = (
    "version", "example", "sample", "test", "isbn", "invoice", "order no", "exemple", "facture", "beispiel", "rechnung",
    "ejemplo", "prueba", "factura",
)


def _any_word(words: tuple[str, ...]) -> re.Pattern:
    """One of some words, whole: no letter or digit stands next to it."""
    return re.compile(rf"(?<![^\W_])(?:{'|'.join(map(re.escape, words))})(?![^\W_])")


_CONTEXT, _DOUBTS = {kind: _any_word(words) for kind, words in CONTEXT.items()}, _any_word(DOUBTS)

# Signs of an international account number, by country.
IBAN_LENGTHS = dict(
    AD=24, AE=23, AL=28, AT=20, AZ=28, BA=20, BE=16, BG=22, BH=22, BR=29, BY=28, CH=21, CR=22, CY=28, CZ=24, DE=22, DK=18,
    DO=28, EE=20, EG=29, ES=24, FI=18, FO=18, FR=27, GB=22, GE=22, GI=23, GL=18, GR=27, GT=28, HR=21, HU=28, IE=22, IL=23,
    IQ=23, IS=26, IT=27, JO=30, KW=30, KZ=20, LB=28, LC=32, LI=21, LT=20, LU=20, LV=21, MC=27, MD=24, ME=22, MK=19, MR=27,
    MT=31, MU=30, NL=18, NO=15, PK=24, PL=28, PS=29, PT=25, QA=29, RO=24, RS=22, SA=24, SC=31, SE=24, SI=19, SK=24, SM=27,
    ST=25, SV=28, TL=23, TN=24, TR=26, UA=29, VA=22, VG=24, XK=20,
)

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
# A match that starts inside a run of digits would also start at its beginning: the look-behind keeps this linear.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=\x20?[A-Z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    """The sum of the digits, every second from the right doubled and cast out nines, ends in 0."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(code: str) -> bool:
    """An account code with its first four signs moved to the end, letters as 10 to 35, leaves 1."""
    rest = 0
    for sign in code[4:] + code[:4]:
        n = int(sign, 36)
        rest = (rest * (100 if n > 9 else 10) + n) % 97
    return rest == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From every @ to both sides: nothing before it is read twice, unlike with one pattern."""
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        end = at + 1
        if start < at and (m := _DOMAIN.match(text, end)):
            end = free = m.end()
            yield start, end
        at = text.find("@", end)


def _digits(s: str) -> str:
    return "".join(_DIGITS.findall(s))


def proposals(text: str) -> Iterator[tuple[str, int, int]]:
    """Confirmed spans of every kind, before context; a match that fails its check is dropped and not retried."""
    for start, end in _emails(text):
        yield "email", start, end
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            yield "ip", *m.span()
    for m in _CARD.finditer(text):
        if 14 <= m.end() - m.start() and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            yield "card", *m.span()
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            yield "phone", *m.span()
    for m in _IBAN.finditer(text):
        end = _account_end(text, m.start(), IBAN_LENGTHS.get(m[0][:2], 0))
        if end and mod97(text[m.start() : end].replace(" ", "")):
            yield "iban", m.start(), end
    for m in _SSN.finditer(text):
        area, group, serial = m[0].split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield "ssn", *m.span()


def _account_end(text: str, start: int, signs: int) -> int:
    """Where so many capitals and digits end, single blanks between them left out; 0 if there are fewer or more.

    The country says how many there are, so a capital word behind the number does not count as a part of it.
    """
    at, seen = start, 0
    while seen < signs:
        if text[at : at + 1] == " " and seen:
            at += 1
        sign = text[at : at + 1]
        if not (sign.isascii() and (sign.isdigit() or sign.isupper())):
            return 0
        at, seen = at + 1, seen + 1
    behind = text[at : at + 1]
    return 0 if not signs or (behind.isascii() and behind.isalnum()) else at


def score(text: str, kind: str, start: int, end: int) -> float:
    """The prior of the kind, moved by words within ``NEAR`` signs before and after the span."""
    near = f"{text[max(0, start - NEAR):start]} {text[end:end + NEAR]}".lower()
    moved = FOR * bool(_CONTEXT[kind].search(near)) + AGAINST * bool(_DOUBTS.search(near))
    return round(min(1.0, max(0.0, PRIOR[kind] + moved)), 2)


def find_pii(text: str) -> list[dict]:
    """Spans by start, then kind; base kinds always stay."""
    out = []
    for kind, start, end in proposals(text):
        s = score(text, kind, start, end)
        if kind in BASE or s >= LEAST_SCORE:
            out.append({"kind": kind, "start": start, "end": end, "score": s})
    return sorted(out, key=lambda s: (s["start"], KINDS.index(s["kind"])))


SPANS_ARROW = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
)


def detect(df: DataFrame, text: str = "text") -> DataFrame:
    """All columns of df and ``pii``, the spans of its texts (code points, end exclusive)."""

    @F.arrow_udf("array<struct<kind:string,start:int,end:int,score:double>>")
    def spans(texts: pa.Array) -> pa.Array:
        return pa.array([find_pii(t.as_py()) for t in texts], SPANS_ARROW)

    return df.withColumn(free_name(df, "pii"), spans(text_or_empty(text)))
