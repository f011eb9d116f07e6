"""String columns: splitting, pattern runs, query strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of episode numbers and of Han script.
NUMBERS = "[0-9]+"
HAN_RUNS = "[\\u4e00-\\u9fa5]+"
HAN_THEN_NUMBER = "[\\u4e00-\\u9fa5]+\\s*[0-9]+"


BLANKS = "".join(chr(i) for i in range(33))


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def split_fields(line: Column | str, sep: str = "\t") -> Column:
    """Split at a single character and drop trailing empty fields, the way a JVM ``String.split`` does."""
    return F.split(F.rtrim(_c(line), F.lit(sep)), sep)


def strip(text: Column | str) -> Column:
    """Drop blanks and control characters at both ends (``F.trim`` alone drops only spaces)."""
    return F.btrim(_c(text), F.lit(BLANKS))


def field(parts: Column | str, index: int) -> Column:
    """0-based field; NULL past the end."""
    return F.get(_c(parts), F.lit(index))


def drop_ends(parts: Column | str, head: int = 0, tail: int = 0) -> Column:
    """The array without its first ``head`` and last ``tail`` elements."""
    parts = _c(parts)
    return F.slice(parts, head + 1, F.greatest(F.size(parts) - head - tail, F.lit(0)))


def find_all(text: Column | str, pattern: str) -> Column:
    """Every match of the pattern, left to right."""
    return F.regexp_extract_all(_c(text), F.lit(pattern), F.lit(0))


def matches_all(text: Column | str, pattern: str) -> Column:
    """True where the whole string matches (``rlike`` alone would accept a part of it)."""
    return _c(text).rlike(f"\\A(?:{pattern})\\z")


def distinct_chars(text: Column | str) -> Column:
    """The string with only the first occurrence of each character."""
    return F.array_join(F.array_distinct(F.split(_c(text), "")), "")


def after_last_space(text: Column | str) -> Column:
    return F.substring_index(_c(text), " ", -1)


def before_last_space(text: Column | str) -> Column:
    """The text in front of the last space; only meaningful where there is one."""
    return F.left(_c(text), F.length(_c(text)) - F.length(after_last_space(text)) - 1)


def last_piece(text: Column | str, sep: str = "_") -> Column:
    return F.element_at(F.split(_c(text), sep), -1)


def query_param(query: Column | str, name: str) -> Column:
    """Value of the first ``name=`` piece between ``&``; NULL when there is none."""
    pattern = f"(?:^|&){name}=([^&]*)"
    return F.when(_c(query).rlike(pattern), F.regexp_extract(_c(query), pattern, 1))


def last_query_param(query: Column | str, name: str) -> Column:
    """Value of the last ``name`` or ``name=…`` piece, as in a map built left to right; NULL when there is none."""
    pattern = f"(?s)\\A(?:.*&)?{name}(?:=([^&]*))?(?=&|\\z)"
    return F.when(_c(query).rlike(pattern), F.regexp_extract(_c(query), pattern, 1))


def query_pairs(query: Column | str) -> Column:
    """``a=1&b=&c=x=y`` → array of (key, value); the first ``=`` splits, a missing ``=`` gives an empty value."""
    pieces = F.filter(F.split(_c(query), "&"), lambda p: p != "")
    return F.transform(
        pieces,
        lambda p: F.struct(
            F.substring_index(p, "=", 1).alias("key"),
            F.when(p.contains("="), F.regexp_replace(p, "\\A[^=]*=", "")).otherwise("").alias("value"),
        ),
    )


def url_clean(text: Column | str) -> Column:
    """URL-decoded text, empty where the escapes are broken."""
    return F.coalesce(F.try_url_decode(_c(text)), F.lit(""))


def tokens(text: Column | str) -> Column:
    """Lower-cased pieces between single white-space characters, trailing empties dropped."""
    return F.split(F.regexp_replace(F.lower(_c(text)), "\\s+\\z", ""), "\\s")
