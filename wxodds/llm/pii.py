"""Personal data: patterns propose spans, validators confirm them, nearby words adjust the score.

A kind has a pattern, an optional validator (digit counts, octets, Luhn, mod-97) and a score; a
context word of the kind within CONTEXT code points raises the score by CONTEXT_GAIN.  Spans that
reach MIN_SCORE are returned.  The kinds of BASE score above it on their own, so every valid match of
their patterns is returned.  Matches of one kind never overlap; kinds may.

All scans are linear in the text.  Defined results: a null or empty text has no spans; long texts
are scanned whole; rows are independent, so repeated rows, ties and null doc_ids need no rule.
"""
from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTEXT, CONTEXT_GAIN, MIN_SCORE = 48, 0.3, 0.6
BASE = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"

_DIGITS = re.compile("[^0-9]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def mod97(iban: str) -> bool:
    rest = 0
    for c in iban[4:] + iban[:4]:
        v = int(c, 36)
        rest = (rest * (100 if v > 9 else 10) + v) % 97
    return rest == 1


def _card(found: str) -> bool:
    digits = _DIGITS.sub("", found)
    return 14 <= len(digits) <= 19 and luhn(digits)


def _phone(found: str) -> bool:
    return 10 <= len(_DIGITS.sub("", found)) <= 15


def _ip(found: str) -> bool:
    return all(len(x) <= 3 and int(x or "0") <= 255 for x in (p.lstrip("0") for p in found.split(".")))


def _iban(found: str) -> bool:
    bare = found.replace(" ", "")
    return 15 <= len(bare) <= 34 and mod97(bare)


def _social(found: str) -> bool:
    a, b, c = found.split("-")
    return a not in ("000", "666") and a < "900" and b != "00" and c != "0000"


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of [A-Za-z0-9._%+-]+@ and a domain.  A local part can't hold an @, so each @
    is tried once, with all local characters before it that no earlier match has taken."""
    done = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            done = m.end()
            yield start, done


class Kind(NamedTuple):
    find: Callable[[str], Iterator[tuple[int, int]]]
    valid: Callable[[str], bool] | None
    score: float
    words: tuple[str, ...]


def _pattern(pattern: str) -> Callable[[str], Iterator[tuple[int, int]]]:
    finditer = re.compile(pattern).finditer
    return lambda text: (m.span() for m in finditer(text))


# The checks (?<!..) and possessive repeats keep the scans linear; they change no match of the
# plain patterns, since a run of digits is always taken whole.
KINDS: dict[str, Kind] = {
    "email": Kind(emails, None, 0.9, ("mail", "contact", "kontakt", "courriel", "correo")),
    "ip": Kind(_pattern(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}"), _ip, 0.7, ("ip", "host", "server", "login")),
    "card": Kind(_pattern(r"[0-9](?:[ -]?[0-9])++"), _card, 0.8, ("card", "visa", "karte", "carte", "tarjeta")),
    "phone": Kind(_pattern(r"\+[0-9][ ().0-9-]+[0-9]"), _phone, 0.7, ("tel", "phone", "call", "fax", "mobil")),
    "iban": Kind(_pattern(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
                 _iban, 0.8, ("iban", "konto", "account", "compte", "cuenta")),
    "ssn": Kind(_pattern(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"), _social, 0.5, ("ssn", "social", "security")),
    "access_key": Kind(_pattern(r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])"), None, 0.8, ("key", "secret")),
}


def spans(text: str | None, kinds: dict[str, Kind] = KINDS) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by start, then by the order of the kinds; code points, end exclusive."""
    found = []
    for rank, (name, kind) in enumerate(kinds.items()):
        for a, b in kind.find(text or ""):
            if kind.valid and not kind.valid(text[a:b]):
                continue
            score = kind.score
            around = (text[max(0, a - CONTEXT):a] + " " + text[b:b + CONTEXT]).lower()
            if any(w in around for w in kind.words):
                score = min(1.0, score + CONTEXT_GAIN)
            if score >= MIN_SCORE:
                found.append((a, rank, name, b, score))
    return [(name, a, b, round(score, 2)) for a, _, name, b, score in sorted(found)]


def _find(texts: pd.Series) -> pd.Series:
    return pd.Series([[{"kind": k, "start": a, "end": b, "score": s} for k, a, b, s in spans(t)] for t in texts],
                     dtype=object)


def _redact(texts: pd.Series) -> pd.Series:
    return pd.Series([redacted(t) for t in texts], dtype=object)


def redacted(text: str | None) -> str | None:
    """The text with each span, or run of overlapping spans, replaced by <KIND> of its first span."""
    out, done, parts = spans(text), 0, []
    if not out:
        return text
    start, end, label = out[0][1], out[0][2], out[0][0]
    for kind, a, b, _ in [*out[1:], ("", len(text) + 1, len(text) + 1, 0.0)]:
        if a < end:
            end = max(end, b)
            continue
        parts += [text[done:start], f"<{label.upper()}>"]
        done, start, end, label = end, a, b, kind
    return "".join([*parts, text[done:]])


def spans_of(text: Column) -> Column:
    return F.pandas_udf(_find, SPANS)(text)


def find(docs: DataFrame) -> DataFrame:
    """`docs` without its other columns: doc_id and `spans`."""
    return docs.select("doc_id", spans_of(F.col("text")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """`docs` with redacted texts and their new n_chars, if it has that column; null stays null."""
    out = docs.withColumn("text", F.pandas_udf(_redact, "string")("text"))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
