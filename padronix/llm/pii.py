"""Personal data: an Aho-Corasick scan for anchors, then local parsers that expand and validate each one."""

from __future__ import annotations

import re
from collections.abc import Callable

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from padronix.llm.batches import append_columns

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account", "secret")

# Cues that announce an identifier or a secret, lower-cased.
SCHEMES = ("http://", "https://", "ftp://", "mailto:")
ACCOUNT_CUES = ("iban", "account", "passport", "ssn", "konto", "compte", "cuenta")
ACCOUNT_FILLERS = ("number", "numbers", "num", "no", "nr", "nummer", "numéro", "numero", "número", "n°", "nº", "id", "code", "is", "ist", "est", "es", "of", "the")
SECRET_CUES = ("password", "passwd", "token", "secret", "api_key", "apikey")

_DIGITS = frozenset("0123456789")
_ALNUM = frozenset("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOCAL = _ALNUM | frozenset("._%+-")
_LABEL = _ALNUM | frozenset("-")
_PHONE = _DIGITS | frozenset(" ().-")
_URL_END = frozenset(" \t\n\r\x0b\x0c\"'<>`")
_TRAIL = ".,;:!?)]}"
_HOST_END = re.compile(r"[/?#\\]")
_NO_WORD = re.compile(r"[0-9]|[A-Za-z][_+/.-]+[A-Za-z]|[a-z][A-Z]")
_FOLD = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}  # keeps every place in the text

Span = tuple[int, int]
Parser = Callable[[str, int, int], tuple[Span | None, int]]


def _run(text: str, at: int, allowed: frozenset[str]) -> int:
    """End of the run of allowed characters that begins at `at`."""
    n = len(text)
    while at < n and text[at] in allowed:
        at += 1
    return at


# Each parser gets the text, the place of an anchor and where its kind's last match ended (`floor`). It returns the
# span, or None, and the new floor: what a leftmost, non-overlapping search would have used up.


def _email(text: str, at: int, floor: int) -> tuple[Span | None, int]:
    """local@label.label...: at is the place of the at-sign."""
    start = at
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    end = _run(text, at + 1, _LABEL)
    if start == at or end == at + 1:
        return None, floor
    dots = 0
    while end < len(text) and text[end] == ".":
        label = _run(text, end + 1, _LABEL)
        if label == end + 1:
            break
        end, dots = label, dots + 1
    return ((start, end), end) if dots else (None, floor)


def _ip(text: str, at: int, floor: int) -> tuple[Span | None, int]:
    """Four dotted numbers of up to 255: at is a digit with a dot and a digit after it."""
    start = at
    while start > floor and text[start - 1] in _DIGITS:
        start -= 1
    end, parts = start, []
    for i in range(4):
        stop = _run(text, end, _DIGITS)
        if stop == end:
            return None, floor
        parts.append(text[end:stop])
        end = stop
        if i < 3:
            if end >= len(text) or text[end] != ".":
                return None, floor
            end += 1
    fits = all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts)
    return ((start, end) if fits else None), end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _card(text: str, at: int, floor: int) -> tuple[Span | None, int]:
    """Digits with at most one space or hyphen between two: at is a digit that another one follows so."""
    end, n = at, len(text)
    digits = []
    while True:
        stop = _run(text, end, _DIGITS)
        digits.append(text[end:stop])
        end = stop
        if end + 1 < n and text[end] in " -" and text[end + 1] in _DIGITS:
            end += 1
            continue
        break
    number = "".join(digits)
    return ((at, end) if 12 <= len(number) <= 19 and luhn(number) else None), end


def _phone(text: str, at: int, floor: int) -> tuple[Span | None, int]:
    """+digits with spaces, brackets, dots or hyphens: at is the plus sign."""
    if at + 1 >= len(text) or text[at + 1] not in _DIGITS:
        return None, floor
    end = _run(text, at + 2, _PHONE)
    while end > at + 2 and text[end - 1] not in _DIGITS:
        end -= 1
    if end < at + 4:
        return None, floor
    n = sum(c in _DIGITS for c in text[at:end])
    return ((at, end) if 9 <= n <= 15 else None), end


def _url(text: str, at: int, floor: int) -> tuple[Span | None, int]:
    """A scheme and what follows up to white space or a quote, without closing punctuation; it needs a host, a mail
    address something on both sides of its at-sign."""
    start = end = text.index(":", at) + 1
    while end < len(text) and text[end] not in _URL_END:
        end += 1
    while end > start and text[end - 1] in _TRAIL:
        end -= 1
    rest = text[start:end]
    if rest.startswith("//"):
        host = _HOST_END.split(rest[2:], maxsplit=1)[0].rsplit("@", 1)[-1].removeprefix("[")
        valid = host[:1].isalnum()
    else:
        local, _, domain = rest.partition("@")
        valid = local[-1:].isalnum() and domain[:1].isalnum()
    return ((at, end), end) if valid else (None, floor)


def _after_cue(text: str, at: int, cues: tuple[str, ...]) -> int:
    """Where a value begins after the cue at `at` and one of : = # or a space; -1 if the cue is part of a word."""
    cue = next(c for c in sorted(cues, key=len, reverse=True) if text[at : at + len(c)].lower() == c)
    end = at + len(cue)
    if at and text[at - 1] in _ALNUM or end < len(text) and text[end] in _ALNUM:
        return -1
    stop = _run(text, end, frozenset(" :=#\"'"))
    return stop if stop > end else -1


def iban(value: str) -> bool:
    """Country, two check digits and 11 to 30 letters or digits, whose number leaves 1 by 97."""
    v = value.upper()
    if not (15 <= len(v) <= 34 and v[:2].isalpha() and v[2:4].isdigit()):
        return False
    return int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97 == 1


def _iban(text: str, at: int) -> int:
    """End of the longest valid IBAN from `at`, in one piece or in printed groups of up to four; -1 if there is none."""
    if at + 4 > len(text) or not all(c in _ALNUM for c in text[at : at + 4]):
        return -1
    value, end, found = "", at, -1
    while True:
        stop = _run(text, end, _ALNUM)
        group = text[end:stop]
        if value and (len(group) > 4 or value[:2].isupper() and group != group.upper()):
            break
        value, end = value + group, stop
        if iban(value):
            found = end
        if len(value) > 34 or len(group) < 4 or end + 1 >= len(text) or text[end] not in " -" or text[end + 1] not in _ALNUM:
            break
        end += 1
    return found


def _past_fillers(text: str, at: int) -> int:
    """Where a value begins behind words such as number, no. or is, and what parts them; `at` if there are none."""
    while True:
        end = at
        while end < len(text) and (text[end].isalpha() or text[end] in "°º"):
            end += 1
        if text[at:end].lower() not in ACCOUNT_FILLERS:
            break
        stop = _run(text, end, frozenset(" .:=#\"'"))
        if stop == end:
            break
        at = stop
    return at


def _account(text: str, at: int, floor: int) -> tuple[Span | None, int]:
    """The identifier after an account cue and filler words: a valid IBAN, or 6 to 34 letters and digits, at least 4 of
    them digits, where a space may stand before a digit."""
    start = _after_cue(text, at, ACCOUNT_CUES)
    if start < 0:
        return None, floor
    start = _past_fillers(text, start)
    end = _iban(text, start)
    if end > 0:
        return (start, end), end
    end, n = start, 0
    while end < len(text) and (text[end] in _ALNUM or text[end] == "-" or text[end] == " " and end + 1 < len(text) and text[end + 1] in _DIGITS):
        n += text[end] in _DIGITS
        end += 1
    size = sum(c in _ALNUM for c in text[start:end])
    return ((start, end), end) if n >= 4 and 6 <= size <= 34 else (None, floor)


def _secret(text: str, at: int, floor: int) -> tuple[Span | None, int]:
    """The value after a password or token cue with = or a colon: at least 8 characters, and not a word by itself: a
    digit, a sign between two characters, or a capital behind a small letter."""
    start = _after_cue(text, at, SECRET_CUES)
    if start < 0 or not set("=:") & set(text[at:start]):
        return None, floor
    end = _run(text, start, _ALNUM | frozenset("_-+/."))
    while end > start and text[end - 1] in _TRAIL:
        end -= 1
    return ((start, end), end) if end - start >= 8 and _NO_WORD.search(text[start:end]) else (None, floor)


PARSERS: dict[str, Parser] = {
    "email": _email, "ip": _ip, "card": _card, "phone": _phone, "url": _url, "account": _account, "secret": _secret,
}


def anchors() -> ahocorasick.Automaton:
    """Anchor text -> kinds: at-signs, plus signs, digit pairs with what may part them, schemes and cues in small letters."""
    found: dict[str, set[str]] = {"@": {"email"}, "+": {"phone"}}
    for a in "0123456789":
        for b in "0123456789":
            for between, kind in (("", "card"), (" ", "card"), ("-", "card"), (".", "ip")):
                found.setdefault(a + between + b, set()).add(kind)
    for texts, kind in ((SCHEMES, "url"), (ACCOUNT_CUES, "account"), (SECRET_CUES, "secret")):
        for t in texts:
            found.setdefault(t, set()).add(kind)
    built = ahocorasick.Automaton()
    for anchor, kinds in found.items():
        built.add_word(anchor, (len(anchor) - 1, tuple(sorted(kinds))))
    built.make_automaton()
    return built


def spans_of(built: ahocorasick.Automaton, text: str) -> dict[str, list[Span]]:
    """Spans of each kind in one text, by anchors from left to right."""
    found: dict[str, list[Span]] = {}
    floor = dict.fromkeys(KINDS, 0)
    for last, (back, kinds) in built.iter(text.translate(_FOLD)):
        at = last - back
        for kind in kinds:
            if at < floor[kind]:
                continue
            span, floor[kind] = PARSERS[kind](text, at, floor[kind])
            if span:
                found.setdefault(kind, []).append(span)
    return found


def joined(found: dict[str, list[Span]], kinds: tuple[str, ...]) -> str:
    """kind:start:end by start, then by the order of `kinds`."""
    rows = sorted((s, kinds.index(k), k, e) for k in kinds for s, e in found.get(k, ()))
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in rows)


FIELDS = T.StructType(
    [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
    + [T.StructField("base_spans", T.StringType()), T.StructField("spans", T.StringType())]
)


def find_personal_data(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`docs` with personal data found in each whole text.

    Columns: n_<kind> for each of KINDS, base_spans and spans (`kind:start:end` in code points, end exclusive, by
    start, comma-joined; base_spans has emails, IP addresses, cards and phone numbers only). A match of a kind never
    overlaps an earlier one of that kind. Every row of `docs` is returned once; a null or empty text has no spans.
    Columns of `docs` named as new ones are replaced. No rows are exchanged between tasks.
    """

    def start():
        built = anchors()

        def compute(texts: pa.Array) -> list:
            columns: list[list] = [[] for _ in FIELDS]
            for t in texts.cast(pa.string()).to_pylist():
                found = spans_of(built, t) if t else {}
                for column, kind in zip(columns, KINDS, strict=False):
                    column.append(len(found.get(kind, ())))
                columns[-2].append(joined(found, BASE_KINDS) if found else "")
                columns[-1].append(joined(found, KINDS) if found else "")
            return columns

        return compute

    return append_columns(docs, text, FIELDS, start, keep)


def masked_text(text, spans):
    """Column: `text` with every span of `spans` replaced by its kind in brackets; overlapping spans mask once."""
    parts = F.transform(F.filter(F.split(spans, ","), lambda s: s != ""), lambda s: F.split(s, ":"))
    state = F.struct(F.lit(1).alias("at"), F.lit("").alias("out"))
    merged = F.aggregate(
        parts,
        state,
        lambda a, p: F.when(p[2].cast("int") < a["at"], a).otherwise(
            F.struct(
                (p[2].cast("int") + 1).alias("at"),
                F.concat(
                    a["out"],
                    F.substring(text, a["at"], F.greatest(p[1].cast("int") + 1 - a["at"], F.lit(0))),
                    F.concat(F.lit("["), p[0], F.lit("]")),
                ).alias("out"),
            )
        ),
        lambda a: F.concat(a["out"], F.substring(text, a["at"], F.length(text))),
    )
    return merged
