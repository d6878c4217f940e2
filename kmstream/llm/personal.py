"""Personal data: patterns propose spans, validators confirm them, context adjusts the score.

Every kind has a pattern, a check and context words. The pattern proposes spans,
leftmost first and not overlapping; the check (Luhn for cards, mod-97 for IBANs,
number ranges, the calendar) confirms or drops a proposal as it stands; words near
the span raise or lower its score. Spans of the base kinds -- ``email``, ``ip``,
``card``, ``phone`` -- are always returned with their score. The other kinds --
``birth``, ``iban``, ``national`` (a phone number without its country), ``ssn`` --
are returned only from ``least`` upwards and where no base span overlaps them.

Scale: one pass over each text in Arrow batches, no shuffle, no state. Searches are
linear in the text: e-mail addresses are looked for at their @, digit patterns
start at the head of a digit run only, and a text without @ and digits is skipped.

Defined results: places are code points, end exclusive; null or empty text = no
spans; rows without id and repeated rows are rows like others; kinds come in the
order of ``KINDS``, spans of a kind by start (they cannot tie); extra columns are
not read; an empty table gives an empty result.
"""

from __future__ import annotations

import datetime
import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("birth", "iban", "national", "ssn")
SPAN_TYPE = "array<struct<kind:string,start:long,stop:long,score:double>>"

# What each kind looks like. A digit run is entered at its head only, which finds the same matches.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_BIRTH = re.compile(r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4})(?![0-9])")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
_NATIONAL = re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_DIGIT = re.compile("[0-9]")
_WORD = re.compile(r"[^\W\d_]+")

#: Length of an IBAN by country.
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18,
    "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21,
    "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TR": 26,
}

#: Words near a span that speak for a kind, in the languages of the corpus.
FOR = {
    "email": "email e-mail mail contact kontakt contacto correo courriel write schreiben",
    "ip": "ip address server host adresse dirección login from",
    "card": "card credit visa mastercard amex carte crédit karte kreditkarte tarjeta crédito payment",
    "phone": "phone tel telephone mobile call fax whatsapp téléphone telefon anruf teléfono móvil llame",
    "birth": "born birth birthday dob né née naissance geboren geburtstag geburtsdatum nacido nacida nacimiento",
    "iban": "iban account bank konto compte cuenta transfer",
    "national": "phone tel telephone mobile call fax whatsapp téléphone telefon anruf teléfono móvil llame",
    "ssn": "ssn social security taxpayer",
}
#: Words near a span that speak against it.
AGAINST = {
    "ip": "version release build section chapitre kapitel capítulo",
    "card": "isbn order invoice serial tracking commande bestellung pedido",
    "phone": "isbn order serial version",
    "birth": "released published version",
    "national": "isbn order serial version part",
    "ssn": "isbn order serial part",
}


@dataclass(frozen=True)
class PersonalRules:
    least: float = 0.6          # score from which a span of the other kinds is returned
    before: int = 48            # code points looked at before and after a span
    after: int = 24
    gain: float = 0.3           # what context words add or take
    email: float = 0.9          # score of a confirmed span without context
    ip: float = 0.6
    card: float = 0.7
    phone: float = 0.6
    birth: float = 0.35
    iban: float = 0.9
    national: float = 0.35
    ssn: float = 0.35


def luhn(digits: str) -> bool:
    """Whether the digits pass the check of payment cards."""
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Whether an IBAN without spaces passes its check: country and check digits last, letters as 10 to 35."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _emails(t: str):
    end = 0
    for m in _DOMAIN.finditer(t):
        at = start = m.start()
        while start > end and t[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            end = m.end()
            yield start, end


def _ips(t: str):
    for m in _IP.finditer(t):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            yield m.span()


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _cards(t: str):
    for m in _CARD.finditer(t):
        d = _digits(m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            yield m.span()


def _phones(t: str):
    for m in _PHONE.finditer(t):
        if 9 <= len(_digits(m[0])) <= 15:
            yield m.span()


def _births(t: str):
    for m in _BIRTH.finditer(t):
        a, b, c = map(int, re.split("[./-]", m[0]))
        y, mon, day = (a, b, c) if "-" in m[0] else (c, b, a)
        try:
            datetime.date(y, mon, day)
        except ValueError:
            continue
        if 1900 <= y <= 2100:
            yield m.span()


def _ibans(t: str):
    """The country says how many characters count; what the pattern took beyond them is left."""
    for m in _IBAN.finditer(t):
        size = IBAN_LENGTH.get(m[0][:2], 0)
        stop, own = m.start(), ""
        while stop < m.end() and len(own) < size:
            own += t[stop].strip()
            stop += 1
        if size and len(own) == size and not t[stop:stop + 1].isalnum() and mod97(own):
            yield m.start(), stop


def _nationals(t: str):
    for m in _NATIONAL.finditer(t):
        d = _digits(m[0])
        if d[0] not in "01" and d[3] not in "01" and m[0].count("(") == m[0].count(")"):
            yield m.span()


def _ssns(t: str):
    for m in _SSN.finditer(t):
        a, b, c = m[0].split("-")
        if a not in ("000", "666") and a[0] != "9" and b != "00" and c != "0000":
            yield m.span()


_FIND = {"email": _emails, "ip": _ips, "card": _cards, "phone": _phones, "birth": _births, "iban": _ibans, "national": _nationals, "ssn": _ssns}


class SpanFinder:
    """Finds and scores the spans of a text."""

    def __init__(self, rules: PersonalRules = PersonalRules()):
        self.rules = rules
        self.good = {k: frozenset(w.split()) for k, w in FOR.items()}
        self.bad = {k: frozenset(w.split()) for k, w in AGAINST.items()}

    def score(self, t: str, kind: str, start: int, stop: int) -> float:
        r = self.rules
        near = {w.lower() for w in _WORD.findall(t[max(0, start - r.before):start])}
        near |= {w.lower() for w in _WORD.findall(t[stop:stop + r.after])}
        out = getattr(r, kind)
        out += r.gain * bool(near & self.good.get(kind, frozenset()))
        out -= r.gain * bool(near & self.bad.get(kind, frozenset()))
        return round(min(max(out, 0.0), 1.0), 6)

    def spans(self, t: str | None) -> list[tuple[str, int, int, float]]:
        """(kind, start, stop, score) in the order of kinds, then starts."""
        if not t:
            return []
        digit = _DIGIT.search(t) is not None
        kinds = (["email"] if "@" in t else []) + (list(KINDS[1:]) if digit else [])
        out, taken = [], []
        for kind in kinds:
            for start, stop in _FIND[kind](t):
                if kind in BASE_KINDS:
                    taken.append((start, stop))
                elif any(a < stop and start < b for a, b in taken):
                    continue
                score = self.score(t, kind, start, stop)
                if kind in BASE_KINDS or score >= self.rules.least:
                    out.append((kind, start, stop, score))
        return out


def personal_spans(text: Column, rules: PersonalRules = PersonalRules()) -> Column:
    """The spans of a text column, as an array of (kind, start, stop, score)."""

    @F.pandas_udf(SPAN_TYPE)
    def find(texts: pd.Series) -> pd.Series:
        spans = SpanFinder(rules).spans
        names = ("kind", "start", "stop", "score")
        return pd.Series([[dict(zip(names, s)) for s in spans(t)] for t in texts], dtype=object)

    return find(text.cast("string"))


def redacted(text: Column, spans: Column) -> Column:
    """The text with ``<kind>`` in place of its spans (the earlier one where two overlap); null text stays null."""

    @F.pandas_udf("string")
    def redact(texts: pd.Series, found: pd.Series) -> pd.Series:
        out = []
        for t, rows in zip(texts, found):
            if t is None or rows is None:
                out.append(t)
                continue
            parts, at = [], 0
            for r in sorted(rows, key=lambda r: (r["start"], -r["stop"])):
                if r["start"] >= at:
                    parts += [t[at:r["start"]], f"<{r['kind']}>"]
                at = max(at, r["stop"])
            out.append("".join(parts) + t[at:])
        return pd.Series(out, dtype=object)

    return redact(text, spans)


def personal_data(docs: DataFrame, rules: PersonalRules = PersonalRules(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans) per row of ``docs``."""
    return docs.select(F.col(doc_id).alias("doc_id"), personal_spans(F.col(text), rules).alias("spans"))


def span_list(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def _of_kind(kind: str) -> Column:
    return F.filter("spans", lambda s: s["kind"] == kind)


def span_digest(found: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, scores) of (doc_id, spans)."""
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    counts = [F.size(_of_kind(k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(span_list(base), 256).alias("base_sha256"), span_list(F.col("spans")).alias("spans"),
                        F.transform("spans", lambda s: s["score"]).alias("scores"))
