"""Personal data in plain and in disguised form, at exact places of the source text.

Plain identifiers are found by fixed patterns: e-mail addresses, IPv4 addresses, card numbers (Luhn), phone numbers with a plus.

Disguised ones are found in a normalised text. A chain of transducers rewrites the source: homoglyphs (characters that look like
ASCII, compatibility forms, invisible characters), at and dot signs in brackets or spelled out, spelled digits. Each keeps for every
character of its output the span of source characters that it stands for, so the chain composes, and what the same patterns find in
the last text maps back to source characters.

Rules of the chain, made so that ordinary prose yields nothing:

- at and dot in brackets (``(at)``, ``[dot]``, ``{punkt}``) and their character references always count;
- bare at words count before a host whose last label is a known top-level domain; the host's dots are spelled or spaced out, or
  the local part holds more than letters (``anna.berg at example.org``);
- spelled digits count in runs of three or more, together with the numbers between them, and as parts of four joined by dot words.

A disguised span that a plain one of its kind holds whole is not reported. Positions are code points, ends exclusive.

Nulls: a null text is empty and has no spans. Repeated rows are scanned each. Texts are scanned whole, however long, in time that grows
with their length. An empty table gives no rows. Other columns pass through; a column named as the result is replaced.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

# ---- plain identifiers ------------------------------------------------------------------------------

# fixed values: the patterns of the four kinds
_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# a run of digits is tried from its start only: what fails there fails further on
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) << (i & 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _byte(digits: str) -> bool:
    """Whether a number without leading zeros is at most 255; it may have thousands of digits."""
    return len(digits) <= 3 and int(digits or 0) <= 255


_LOCALS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Addresses from left to right: each at sign with the characters before it that no earlier address took."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCALS:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            yield start, host.end()
            done = host.end()
        at = text.find("@", max(done, at + 1))


def identifiers(text: str) -> Iterator[tuple[int, int, int]]:
    """``kind, start, end`` of every plain identifier, by kind, then start."""
    for start, end in emails(text):
        yield 0, start, end
    if not _DIGIT.search(text):
        return
    for m in _IP.finditer(text):
        if all(_byte(part.lstrip("0")) for part in m[0].split(".")):
            yield 1, *m.span()
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield 2, *m.span()
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            yield 3, *m.span()


# ---- transducers --------------------------------------------------------------------------------------


class Mapped:
    """A rewritten text; for each of its characters the span of source characters that it stands for."""

    def __init__(self, text: str, starts: np.ndarray | None = None, ends: np.ndarray | None = None) -> None:
        self.text = text
        self.starts = np.arange(len(text)) if starts is None else starts
        self.ends = self.starts + 1 if ends is None else ends

    def rewrite(self, pieces: list[tuple[int, int, str]]) -> Mapped:
        """Replace the pieces (start, end, new text), which are in order and don't overlap."""
        if not pieces:
            return self
        texts, starts, ends, at = [], [], [], 0
        for start, end, new in pieces:
            texts += [self.text[at:start], new]
            starts += [self.starts[at:start], np.full(len(new), self.starts[start])]
            ends += [self.ends[at:start], np.full(len(new), self.ends[end - 1])]
            at = end
        texts.append(self.text[at:])
        return Mapped("".join(texts), np.concatenate([*starts, self.starts[at:]]), np.concatenate([*ends, self.ends[at:]]))

    def source(self, start: int, end: int) -> tuple[int, int]:
        return int(self.starts[start]), int(self.ends[end - 1])


# Letters of other scripts that look like ASCII letters, and signs that compatibility forms don't cover.
_LOOKS = {
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "Х": "X", "У": "Y", "З": "3",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ɩ": "i", "ո": "n", "օ": "o", "ս": "u", "ց": "g", "հ": "h",
    "。": ".", "·": ".", "∙": ".", "•": ".", "۔": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "⁃": "-", "╋": "+", "➕": "+",
}


@lru_cache(1)
def glyphs() -> dict[str, str]:
    """Characters to the ASCII ones they look like ("": invisible). By rule: single-character compatibility forms, digits of other
    scripts, spaces, and format characters; beside them the table above."""
    found = {}
    for point in [*range(0x80, 0xD800), *range(0xF900, 0x10000), *range(0x10000, 0x20000)]:
        c = chr(point)
        kind = unicodedata.category(c)
        if kind == "Cf":
            found[c] = ""
        elif kind == "Zs":
            found[c] = " "
        elif kind == "Nd":
            found[c] = str(unicodedata.decimal(c))
        else:
            plain = unicodedata.normalize("NFKC", c)
            if plain != c and len(plain) == 1 and (plain.isascii() or plain in _LOOKS):
                found[c] = _LOOKS.get(plain, plain)
    return found | _LOOKS


@lru_cache(1)
def _glyph_pattern() -> re.Pattern:
    """One character class of ranges."""
    points, ranges = sorted(map(ord, glyphs())), []
    for p in points:
        if ranges and ranges[-1][1] == p - 1:
            ranges[-1][1] = p
        else:
            ranges.append([p, p])
    return re.compile("[" + "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in ranges) + "]")


def unmask_glyphs(mapped: Mapped) -> Mapped:
    if mapped.text.isascii():
        return mapped
    table = glyphs()
    return mapped.rewrite([(m.start(), m.end(), table[m[0]]) for m in _glyph_pattern().finditer(mapped.text)])


# Words for the at sign, the dot and the digits, in the corpus' languages.
_AT, _DOT = "at|arroba|arobase|ät|klammeraffe", "dot|punkt|punto|point|period"
_DIGITS = {
    "zero": 0, "oh": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9,
    "null": 0, "eins": 1, "zwei": 2, "zwo": 2, "drei": 3, "vier": 4, "fünf": 5, "fuenf": 5, "sechs": 6, "sieben": 7, "acht": 8, "neun": 9,
    "zéro": 0, "un": 1, "deux": 2, "trois": 3, "quatre": 4, "cinq": 5, "sept": 7, "huit": 8, "neuf": 9,
    "cero": 0, "uno": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5, "seis": 6, "siete": 7, "ocho": 8, "nueve": 9,
}
_REPEATS = {"double": 2, "triple": 3, "doble": 2, "doppel": 2}
# fixed values: common top-level domains
_DOMAINS = frozenset(
    "com org net edu gov mil int info biz name io ai app dev co me tv eu de at ch fr be nl lu es pt it uk ie us ca au nz jp cn in br mx ar cl se no dk fi pl cz "
    "ru ua gr tr example test invalid local".split()
)

_MARKS = re.compile(
    rf"\s{{0,2}}(?:[\[({{<]\s{{0,2}}(?:(?P<at>{_AT}|@)|(?P<dot>{_DOT}|\.))\s{{0,2}}[\])}}>]|(?P<at2>&\#0*64;|&\#x0*40;|&commat;|%40)|(?P<dot2>&\#0*46;|&\#x0*2e;|&period;|%2e))\s{{0,2}}",
    re.IGNORECASE,
)


def unmask_marks(mapped: Mapped) -> Mapped:
    """Bracketed at and dot signs and their character references, with the spaces around them."""
    return mapped.rewrite([(m.start(), m.end(), "@" if m["at"] or m["at2"] else ".") for m in _MARKS.finditer(mapped.text)])


_AT_WORD = re.compile(rf"\s{{1,2}}(?:{_AT})\s{{1,2}}|(?<=[A-Za-z0-9])([-_*])(?:{_AT})\1(?=[A-Za-z0-9])|\s{{0,2}}@\s{{0,2}}", re.IGNORECASE)
_DOT_SIGN = re.compile(rf"\s{{1,2}}(?:{_DOT})\s{{1,2}}|([-_*])(?:{_DOT})\1|\s{{1,2}}\.\s{{1,2}}|\.", re.IGNORECASE)
_DOT_BEFORE = re.compile(rf"(?:\s{{1,2}}(?:{_DOT})\s{{1,2}}|([-_*])(?:{_DOT})\1)\Z", re.IGNORECASE)
_LABEL = re.compile(r"[A-Za-z0-9]+(?:-(?!(?:dot|punkt|punto|point|period)-)[A-Za-z0-9]+)*", re.IGNORECASE)
_LONGEST_DOT = 2 + 6 + 2


def unmask_hosts(mapped: Mapped) -> Mapped:
    """Bare at and dot words of one address: a local part, an at, and a host that ends in a known top-level domain."""
    text, pieces, done = mapped.text, [], 0
    for m in _AT_WORD.finditer(text):
        if m.start() < done:
            continue
        label = _LABEL.match(text, m.end())
        if not label:
            continue
        # the host: labels and dots, cut after the last one that is a top-level domain
        dots, host, end = [], [], 0
        at = label.end()
        while dot := _DOT_SIGN.match(text, at):
            if host and end == at and dot[0] != "." and dot[0].strip() == ".":
                break  # a spaced dot after a whole host is no part of it
            label = _LABEL.match(text, dot.end())
            if not label:
                break
            dots.append(dot.span())
            at = label.end()
            if label[0].lower() in _DOMAINS:
                host, end = list(dots), at
        if not host:
            continue
        # the local part, with spelled dots inside it
        inner, start = [], m.start()
        while True:
            stop = start
            while start > done and text[start - 1] in _LOCALS:
                start -= 1
            if start == stop:
                break
            dot = _DOT_BEFORE.search(text, max(done, start - _LONGEST_DOT), start)
            if not dot or dot.start() == done or text[dot.start() - 1] not in _LOCALS:
                break
            inner.append(dot.span())
            start = dot.start()
        local = text[start : m.start()]
        if start == m.start() or not local.strip("-_*"):
            continue
        spelled = any(text[a:b] != "." for a, b in host)
        words = any(text[a:b].strip(" \t\n.") for a, b in host)
        bare = "@" not in m[0]
        if bare and not words and not (re.search(r"[A-Za-z]", local) and re.search(r"[0-9._%+]", local) or inner):
            continue
        if m[0] == "@" and not spelled and not inner:
            continue
        pieces += [(a, b, ".") for a, b in reversed(inner)] + [(m.start(), m.end(), "@")] + [(a, b, ".") for a, b in host]
        done = end
    return mapped.rewrite([p for p in pieces if text[p[0] : p[1]] != p[2]])


_WORD = "|".join(sorted(_DIGITS, key=len, reverse=True))
_SPELLED = rf"(?:(?:{'|'.join(_REPEATS)})\s)?(?:{_WORD})(?![^\W_])"
_TOKEN = rf"(?:{_SPELLED}|[0-9]++(?![^\W_]))"
_GAP = r"(?:,\s|[\s,()-]{1,3}|\.)"
_DOTS = rf"(?:\s{{1,2}}(?:{_DOT})\s{{1,2}}|\s?\.\s?)"
_RUN = re.compile(rf"(?<![^\W_])(?:plus\s{{1,2}})?{_TOKEN}(?:(?:{_DOTS}|{_GAP}){_TOKEN})+", re.IGNORECASE)
_PART = re.compile(rf"(?P<plus>plus\s{{1,2}})|(?P<word>{_SPELLED})|(?P<dot>{_DOTS})|(?P<number>[0-9]+)|(?P<gap>[\s,()-]+)", re.IGNORECASE)


def _digits_of(word: str) -> str:
    *times, name = word.lower().split()
    return str(_DIGITS[name]) * (_REPEATS[times[0]] if times else 1)


def unmask_digits(mapped: Mapped) -> Mapped:
    """Runs of spelled digits and numbers: as parts joined by dots, or digits with single signs between them."""
    pieces = []
    for run in _RUN.finditer(mapped.text):
        parts, at = [], run.start()
        while at < run.end():
            m = _PART.match(mapped.text, at, run.end())
            parts.append((m.lastgroup, m.start(), m.end(), m[0]))
            at = m.end()
        words = sum(kind == "word" for kind, *_ in parts)
        dots = sum(kind == "dot" for kind, *_ in parts)
        # spelled, or with a space on both sides
        named = any(kind == "dot" and len(text.lstrip()) < len(text) and len(text.rstrip()) < len(text) for kind, _, _, text in parts)
        if not (words >= 3 or named and dots >= 3):
            continue
        for kind, start, end, text in parts:
            if kind == "plus":
                pieces.append((start, end, "+"))
            elif kind == "word":
                pieces.append((start, end, _digits_of(text)))
            elif kind == "dot":
                pieces.append((start, end, "."))
            elif kind == "gap":
                kept = text.strip(" \t\r\n,") or (" " if text.strip(",") or "," in text else "")
                pieces.append((start, end, "" if dots >= 3 else kept))
    return mapped.rewrite([p for p in pieces if mapped.text[p[0] : p[1]] != p[2]])


# What a text must hold before a transducer has anything to do: cheap tests that most texts fail.
_BRACKETS = re.compile(rf"[\[({{<]\s{{0,2}}(?:{_AT}|{_DOT}|@|\.)\s{{0,2}}[\])}}>]|&\#|%40|%2e|&commat|&period")
_REAL_DOT = re.compile(r"[a-z0-9](?:\.|\s\.\s)[a-z]")
_AT_WORDS, _DOT_WORDS, _DIGIT_WORDS = frozenset(_AT.split("|")), frozenset(_DOT.split("|")), frozenset([*_DIGITS, *_REPEATS])
_JOINED = ("-at-", "_at_", "*at*")


def _clues(text: str) -> tuple[bool, bool]:
    """Whether a text may hold a bare at, and a run of spelled digits or of parts joined by dot words."""
    lower = text.lower()
    words = lower
    for sign in ",().-":
        words = words.replace(sign, " ")
    words = words.split()
    kinds = set(words)
    dots = not _DOT_WORDS.isdisjoint(kinds)
    hosts = (
        "@" in lower and (dots or " @" in lower or "@ " in lower or "\n@" in lower or "@\n" in lower)
        or not _AT_WORDS.isdisjoint(kinds) and (dots or _REAL_DOT.search(lower) is not None)
        or any(j in lower for j in _JOINED)
    )
    at = [i for i, w in enumerate(words) if w in _DIGIT_WORDS] if dots or len(kinds & _DIGIT_WORDS) else []
    runs = " . " in lower or any(b - a <= 2 for a, b in zip(at, at[2:])) or dots and any(
        words[i] in _DOT_WORDS and all(w in _DIGIT_WORDS or w.isdecimal() for w in (words[i - 1], words[i + 1])) for i in range(1, len(words) - 1)
    )
    return hosts, runs


def normalise(text: str) -> Mapped | None:
    """The text after all transducers, or None if none had anything to rewrite."""
    mapped = whole = Mapped(text) if len(text) else None
    if whole is None:
        return None
    if not text.isascii() and _glyph_pattern().search(text):
        mapped = unmask_glyphs(mapped)
    if any(c in mapped.text for c in "[({<&%") and _BRACKETS.search(mapped.text.lower()):
        mapped = unmask_marks(mapped)
    hosts, runs = _clues(mapped.text)
    if hosts:
        mapped = unmask_hosts(mapped)
    if runs:
        mapped = unmask_digits(mapped)
    return None if mapped is whole else mapped


# ---- spans -----------------------------------------------------------------------------------------------


def find(text: str | None) -> list[tuple[int, int, int, str, bool]]:
    """``kind, start, end, value, disguised`` of every identifier, by kind, start and end; values are normalised."""
    text = text or ""
    plain = [(kind, start, end, text[start:end], False) for kind, start, end in identifiers(text)]
    mapped = normalise(text)
    if mapped is None:
        return plain
    own = {kind: [(s, e) for k, s, e, *_ in plain if k == kind] for kind in range(len(KINDS))}
    found = set()
    for kind, start, end in identifiers(mapped.text):
        a, b = mapped.source(start, end)
        value = mapped.text[start:end]
        if text[a:b] == value:
            continue
        i = bisect_right(own[kind], (a, len(text))) - 1
        if i >= 0 and own[kind][i][1] >= b:
            continue
        found.add((kind, a, b, value, True))
    return sorted([*plain, *found])


SPANS = "array<struct<kind: string, start: long, end: long, value: string, disguised: boolean>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string()), ("disguised", pa.bool_())]))


def _finder() -> Callable[[Column], Column]:
    def search(texts: pa.Array) -> pa.Array:
        out = [[{"kind": KINDS[k], "start": s, "end": e, "value": v, "disguised": d} for k, s, e, v, d in find(t)] for t in texts.to_pylist()]
        return pa.array(out, _SPANS)

    return F.arrow_udf(search, SPANS).asNondeterministic()


def scan(docs: DataFrame, column: str = "pii") -> DataFrame:
    """All columns and one more: the spans of personal data in ``text``."""
    return docs.withColumn(column, _finder()(F.col("text").cast("string")))


def redact(text: Column, spans: Column, fill: Callable[[Column], Column] = lambda span: F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]"))) -> Column:
    """The text with each span replaced; of overlapping spans the first, and of equal starts the longest, is replaced."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s.alias("span"))))
    state = F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at"))

    def step(acc: Column, item: Column) -> Column:
        s = item["span"]
        inside = s["start"] < acc["at"]
        before = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        return F.struct(
            F.when(inside, acc["done"]).otherwise(F.concat(acc["done"], before, fill(s))).alias("done"),
            F.when(inside, F.greatest(acc["at"], s["end"])).otherwise(s["end"]).alias("at"),
        )

    return F.aggregate(order, state, step, lambda acc: F.concat(acc["done"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))


def digest(found: DataFrame, column: str = "pii") -> DataFrame:
    """The digest columns: counts and places of plain identifiers, and all spans."""
    spans = F.col(column)
    plain = F.filter(spans, lambda s: ~s["disguised"])
    written = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(plain, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, KINDS), F.sha2(written(plain).cast("binary"), 256).alias("base_sha256"), written(spans).alias("spans"),
        F.size(F.filter(spans, lambda s: s["disguised"])).cast("long").alias("n_disguised"),
    )
