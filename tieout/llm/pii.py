"""Personal data, also where it is disguised, with offsets in the original text.

Four kinds are found by pattern: e-mail addresses, IP addresses, card numbers
and phone numbers. A cascade of three transducers then rewrites the text:
look-alike letters and invisible characters, spelled-out digits, and disguised
at and dot signs. Each keeps, for every character it emits, the range of source
characters it came from. The same patterns run on the rewritten text, and what
they find there is carried back through those ranges.

Spans found in the text as it stands always stay. A span from the rewritten
text is added unless one of its kind equals or covers it, so a disguised part of an
address widens what the text as it stands shows of it. Texts are handled one by one
where they are; nothing is shuffled. Time grows linearly with the text.

Defined cases: a NULL text is an empty one and has no spans; repeated rows each
get theirs. Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieout.llm.common import table
from tieout.llm.top_level import TOP_LEVEL

KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind: string, start: int, end: int, value: string, added: boolean>>"

# --- patterns, on any text ----------------------------------------------------------

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGITS = re.compile(r"[^0-9]")


def emails(text: str) -> Iterable[tuple[int, int]]:
    """From each at sign outwards, so that long runs without one cost nothing."""
    done = 0
    at = text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at)
        start = at
        if domain:
            while start > done and text[start - 1] in LOCAL:
                start -= 1
        if start < at:
            yield start, domain.end()
            done = domain.end()
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)


def ips(text: str) -> Iterable[tuple[int, int]]:
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
            yield m.span()


def passes_luhn(digits: str) -> bool:
    doubled = (int(d) * 2 for d in digits[-2::-2])
    return (sum(map(int, digits[::-2])) + sum(d - 9 * (d > 9) for d in doubled)) % 10 == 0


def cards(text: str) -> Iterable[tuple[int, int]]:
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = NOT_DIGITS.sub("", m.group())
            if 16 <= len(digits) <= 19 and passes_luhn(digits):
                yield m.span()


def phones(text: str) -> Iterable[tuple[int, int]]:
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(NOT_DIGITS.sub("", m.group())) <= 15:
                yield m.span()


FINDERS: dict[str, Callable[[str], Iterable[tuple[int, int]]]] = {
    "email": emails,
    "ip": ips,
    "card": cards,
    "phone": phones,
}

# --- transducers --------------------------------------------------------------------

# Letters of other scripts that look like ASCII ones.
LOOKALIKES = {
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C",
    "Т": "T", "У": "Y", "Х": "X", "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y",
    "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N",
    "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o", "ν": "v", "ι": "i",
    "﹫": "@", "․": ".", "。": ".", "‐": "-", "‑": "-", "–": "-", "−": "-", "﹢": "+",
}
# Full-width forms of the printable ASCII characters, in order.
FULL_WIDTH = {chr(0xFF01 + i): chr(0x21 + i) for i in range(94)}
# The decimal digits of every script.
DIGITS = {c: str(int(c)) for c in map(chr, range(0x80, 0x20000)) if c.isdecimal() and c not in FULL_WIDTH}
INVISIBLE = "­​‌‍⁠﻿"
REPLACED = {**LOOKALIKES, **FULL_WIDTH, **DIGITS, **dict.fromkeys(INVISIBLE, "")}
ANY_REPLACED = re.compile("[" + re.escape("".join(REPLACED)) + "]")
ALL_REPLACED = frozenset(REPLACED)
LETTERS = frozenset(c for c, put in LOOKALIKES.items() if put.isalpha())
NON_SPACE = re.compile(r"\S+")
ASCII_SIGN = re.compile("[A-Za-z0-9@+.-]")

# Digit words of English, French, German and Spanish, each language from 0 to 9.
NUMBER_WORDS = {
    word: str(digit)
    for language in (
        "zero,oh one two three four five six seven eight nine",
        "zéro un,une deux trois quatre cinq six sept huit neuf",
        "null eins,ein,eine zwei,zwo drei vier fünf,fuenf sechs sieben acht neun",
        "cero uno,una dos tres cuatro cinco seis siete ocho nueve",
    )
    for digit, words in enumerate(language.split())
    for own in words.split(",")
    for word in (own, unicodedata.normalize("NFD", own))
}
# Longest first, so that no word is cut short by one that begins it.
_NUMBER = "(?:" + "|".join(sorted(NUMBER_WORDS, key=len, reverse=True)) + "|[0-9])"
_DOT_WORD = r"\x20(?:dot|point|punkt|punto)\x20"
_PLUS = r"(?:plus|más|mas)\x20"
_RUN = rf"{_NUMBER}(?:[\x20-]{_NUMBER})*"
# A part of an address: spelled, or a group of digits.
_PART = rf"(?:[0-9]{{2,3}}(?![A-Za-z0-9])|{_RUN})"
_DOT_SIGN = rf"(?:{_DOT_WORD}|\.)"
# Letters of the languages above; others may touch a number.
_WORD = "[A-Za-z0-9À-ɏ̀-ͯ]"
SPELLED = re.compile(
    rf"(?<!{_WORD})(?:{_PLUS})?"
    rf"(?:{_PART}(?:{_DOT_SIGN}{_PART}){{3}}|{_NUMBER}(?:[\x20-]{_NUMBER}){{2,}})(?!{_WORD})",
    re.I,
)
# Every such run to rewrite holds the last two of three digits, or a dot word before one. It is
# looked for from the separators, which are fewer than letters.
MAY_BE_SPELLED = re.compile(
    rf"[\x20-](?:{_NUMBER}[\x20-]|(?:dot|point|punkt|punto)\x20){_NUMBER}", re.I
)
SPELLED_PART = re.compile(rf"(?P<plus>{_PLUS})|(?P<dot>{_DOT_SIGN})|{_NUMBER}", re.I)
WITHIN_SPELLED = {"plus": "+", "dot": "."}

# After "the dot" only these ends make a domain, others are words of the prose.
ENDS_AFTER_ARTICLE = (
    "com|org|net|edu|gov|mil|int|info|biz|name|io|ai|co|me|tv|app|dev|eu|us|uk|de|fr|es|it|nl|be|ch"
    "|at|se|no|dk|fi|pl|pt|ie|cz|ru|ua|gr|tr|in|cn|jp|kr|au|nz|ca|mx|br|ar|cl|za|example"
)
# Longest first; "example" is reserved for texts like these.
_END = "(?:" + "|".join(sorted({*TOP_LEVEL, "example"}, key=lambda t: (-len(t), t))) + ")(?![A-Za-z0-9])"
_PROSE = rf"the\x20dot\x20(?!(?:{ENDS_AFTER_ARTICLE})(?![A-Za-z0-9]))"
_DISGUISED_DOT = r"(?:\x20dot\x20|\x20?[\[({]\x20?dot\x20?[\])}]\x20?)"
_DOT = rf"(?:{_DISGUISED_DOT}|\.)"
DISGUISED_DOT = re.compile(_DISGUISED_DOT, re.I)
# What announces an address: a bare "at" before a plain domain is prose without it.
ANNOUNCED = re.compile(r"\b(?:e-?mails?|mailto|contact|write|reach|kontakt|correo|courriel)\b|:", re.I)
ANNOUNCED_WITHIN = 48
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
OPENED = frozenset("([{<\"'\n")
CLOSED = re.compile(r"[.,;]?(?:\Z|[\])}>\"'\n])")
# Bracketed or written-out signs; bare words only where the end of a domain follows.
AT_OR_DOT = re.compile(
    r"\x20{0,2}(?:[\[({<]\x20?(?P<at>at|@|arroba)\x20?[\])}>]|&\#64;|&commat;)\x20{0,2}"
    r"|\x20{0,2}(?:[\[({<]\x20?(?P<dot>dot|punto|punkt|point|\.)\x20?[\])}>]|&\#46;|&period;)\x20{0,2}"
    r"|(?<=[A-Za-z0-9])\x20(?P<bare_at>at)\x20"
    rf"(?!{_PROSE})(?=(?P<domain>[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+){{0,3}}{_DOT}{_END}(?!/)))"
    r"|(?<=[A-Za-z0-9])\x20(?P<bare_dot>dot)\x20"
    rf"(?=(?:[A-Za-z0-9-]+{_DOT}){{0,3}}{_END})",
    re.I,
)
MAY_BE_SIGN = re.compile(
    r"[\[({<]\x20?(?:at|dot|@|\.|arroba|punto|punkt|point)\x20?[\])}>]"
    r"|&(?:#64|#46|commat|period);"
    r"|\x20(?:dot\x20|at\x20[A-Za-z0-9-]+\.|(?:point|punkt|punto)\x20[0-9])",
    re.I,
)
# Four groups of digits with signs or bare dot words between them.
_BETWEEN = rf"(?:{_DOT_WORD}|\.|\x20?[\[({{]\x20?(?:dot|point|punkt|punto)\x20?[\])}}]\x20?)"
FOUR_GROUPS = re.compile(rf"(?<![A-Za-z0-9])[0-9]+(?:{_BETWEEN}[0-9]+){{3}}(?![A-Za-z0-9])", re.I)
BARE_DOT = re.compile(_DOT_WORD, re.I)
GROUP = re.compile("[0-9]+")


class Rewritten:
    """A text and, per character, the range of source characters behind it."""

    def __init__(self, text: str):
        self.text, self.starts, self.ends = text, None, None

    def source(self, start: int, end: int) -> tuple[int, int]:
        if self.starts is None:
            return start, end
        return self.starts[start], self.ends[end - 1]

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Apply (start, end, replacement), in order and apart from each other.

        Every character of a replacement stands for all that it replaces.
        """
        if not edits:
            return
        starts = self.starts or list(range(len(self.text)))
        ends = self.ends or list(range(1, len(self.text) + 1))
        text, new_starts, new_ends, done = [], [], [], 0
        for start, end, put in edits:
            text += [self.text[done:start], put]
            new_starts += starts[done:start] + [starts[start]] * len(put)
            new_ends += ends[done:start] + [ends[end - 1]] * len(put)
            done = end
        self.text = "".join([*text, self.text[done:]])
        self.starts, self.ends = new_starts + starts[done:], new_ends + ends[done:]


def lookalikes(r: Rewritten) -> None:
    """Letters only in words that hold ASCII signs too: words of another script stay.

    Digits and signs are rewritten whatever their word holds, invisible characters
    in words that have either.
    """
    if r.text.isascii() or ALL_REPLACED.isdisjoint(r.text):
        return
    edits = []
    for word in NON_SPACE.finditer(r.text):
        found = [m.start() for m in ANY_REPLACED.finditer(word.group())]
        if found and not (
            ASCII_SIGN.search(word.group()) or any(word.group()[i] in FULL_WIDTH for i in found)
        ):
            found = [i for i in found if word.group()[i] not in LETTERS]
            if all(word.group()[i] in INVISIBLE for i in found):
                found = []
        if found:
            at = word.start()
            edits += [(at + i, at + i + 1, REPLACED[word.group()[i]]) for i in found]
    r.replace(edits)


def spelled_digits(r: Rewritten) -> None:
    if not MAY_BE_SPELLED.search(r.text):
        return
    edits = []
    for run in SPELLED.finditer(r.text):
        at = done = run.start()
        for part in SPELLED_PART.finditer(run.group()):
            word = part.group().lower()
            digit = WITHIN_SPELLED.get(part.lastgroup) or NUMBER_WORDS.get(word, word)
            start, end = at + part.start(), at + part.end()
            if start > done:  # the separator of two digits
                edits.append((done, start, ""))
            edits.append((start, end, digit))
            done = end
    r.replace(edits)


def is_address(text: str, at: re.Match) -> bool:
    """Whether a bare "at" makes an address: by its dots, what comes before, or standing alone."""
    if DISGUISED_DOT.search(at["domain"]):
        return True
    start = at.start()
    if ANNOUNCED.search(text, max(0, start - ANNOUNCED_WITHIN), start):
        return True
    first = start
    while first and start - first < ANNOUNCED_WITHIN and text[first - 1] in LOCAL:
        first -= 1
    opened = not first or text[first - 1] in OPENED
    # A capital begins a sentence: "More at example.com".
    return opened and not text[first].isupper() and CLOSED.match(text, at.end("domain")) is not None


def at_and_dot(r: Rewritten) -> None:
    if not MAY_BE_SIGN.search(r.text):
        return
    edits = {}
    for m in AT_OR_DOT.finditer(r.text):
        if m["bare_at"] and not is_address(r.text, m):
            continue
        sign = m.group().strip().lower()
        is_at = m["at"] or m["bare_at"] or sign in ("&#64;", "&commat;")
        edits[m.span()] = "@" if is_at else "."
    for run in FOUR_GROUPS.finditer(r.text):
        if all(len(g) <= 3 and int(g) <= 255 for g in GROUP.findall(run.group())):
            for m in BARE_DOT.finditer(r.text, *run.span()):
                edits[m.span()] = "."
    r.replace([(*span, put) for span, put in sorted(edits.items())])


def spans_of(text: str | None) -> list[dict]:
    """All spans by kind, then start; `added` marks those of the rewritten text."""
    if not text:
        return []
    rewritten = Rewritten(text)
    for transduce in (lookalikes, spelled_digits, at_and_dot):
        transduce(rewritten)
    spans = []
    for kind in KINDS:
        base = list(FINDERS[kind](text))
        found = [(start, end, False) for start, end in base]
        if rewritten.starts is not None:
            for start, end in FINDERS[kind](rewritten.text):
                start, end = rewritten.source(start, end)
                # Base spans are sorted and apart: only the last to start by `start` may cover it.
                before = bisect_left(base, (start + 1, 0))
                if not before or base[before - 1][1] < end:
                    found.append((start, end, True))
        spans += [
            {"kind": kind, "start": s, "end": e, "value": text[s:e], "added": added}
            for s, e, added in sorted(found)
        ]
    return spans


def all_spans(texts: pd.Series) -> pd.Series:
    return pd.Series([spans_of(text) for text in texts], dtype=object)


def find_pii(docs: DataFrame, text_col: str = "text", name: str = "pii") -> DataFrame:
    """Add `name`: the spans of personal data in the text."""
    return docs.withColumn(name, F.pandas_udf(all_spans, SPANS)(F.col(text_col)))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def op8_pii_spans(spark, sf_dir):
    """Personal data in all documents. The counts cover all spans, added ones too."""
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    pii = F.col("pii")

    def count(kind: str) -> Column:
        return F.size(F.filter(pii, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in KINDS],
        F.sha2(listed(F.filter(pii, lambda s: ~s["added"])), 256).alias("base_sha256"),
        listed(pii).alias("spans"),
        F.size(F.filter(pii, lambda s: s["added"])).cast("bigint").alias("n_added"),
    )
