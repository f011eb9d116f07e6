"""Fill-in-the-middle: each text is cut into prefix, middle and suffix at line ends and written in another order.

``regexp_count`` gives a text's number of units n (lines by default). Two draws of its id, modulo n + 1, are the cuts a <= b. A
pattern of the row's own, ``((?:unit){a}+)((?:unit){b-a}+)(.*)``, captures all three parts in one match, and its replacement
writes them in the order of the row's form. The counted groups are possessive: they run in a loop without a stack, whatever n is.

Forms: ``psm`` (prefix, suffix, middle), ``spm`` (suffix, prefix, middle) and ``plain``, the text as it is. A text that is empty
or holds a marker is always plain, so a marker of the output is never part of a text, and the text can be rebuilt from output
and form.

Draws are the first four 8-digit groups of the sha256 of ``seed:doc_id``. Nulls: a null text is empty, a null id has the empty
name. Rows that repeat an id have the same draws, each for its own text. An empty table gives no rows. Other columns pass
through, whatever their names; only a column named as the result is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# a line with its end; the last one may have none. Possessive, as a unit is never cut shorter
LINE = r"[^\n]*+\n|[^\n]++"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
ORDERS = {"psm": ((PREFIX, 1), (SUFFIX, 3), (MIDDLE, 2)), "spm": ((SUFFIX, 3), (PREFIX, 1), (MIDDLE, 2))}


def draws(doc_id: Column, seed: int, count: int = 4) -> list[Column]:
    """Unsigned 32-bit numbers that depend on the id and the seed alone."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(count)]


def _free(docs: DataFrame, name: str) -> str:
    """A name like the given one that no column has."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def transform(docs: DataFrame, seed: int = 7, moved_percent: int = 100, spm_percent: int = 50, unit: str = LINE, column: str = "fim") -> DataFrame:
    """All columns and ``fim``: ``n`` (units), ``form`` and ``output``.

    ``moved_percent`` of the texts are cut, the others stay plain; ``spm_percent`` of those cut have the form spm. ``unit`` is the
    pattern of a unit; units must tile any text without gaps.
    """
    text, n, form, pattern = (_free(docs, f"{column}_{part}") for part in ("text", "n", "form", "pattern"))
    h1, h2, h3, h4 = draws(F.col("doc_id"), seed)
    marked = F.lit(False)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(F.col(text), F.lit(marker))
    one, two = h1 % (F.col(n) + 1), h2 % (F.col(n) + 1)
    first, between = F.least(one, two), F.abs(one - two)
    orders = F.create_map(*[F.lit(x) for name, parts in ORDERS.items() for x in (name, "".join(f"{m}${g}" for m, g in parts))])
    moved = F.regexp_replace(F.col(text), F.col(pattern), F.element_at(orders, F.col(form)))
    found = docs.withColumn(text, F.coalesce(F.col("text").cast("string"), F.lit("")))
    found = found.withColumn(n, F.regexp_count(F.col(text), F.lit(unit)).cast("long"))
    found = found.withColumns({
        form: F.when((F.col(text) == "") | marked | (h3 % 100 >= moved_percent), "plain").when(h4 % 100 < spm_percent, "spm").otherwise("psm"),
        pattern: F.concat(F.lit(rf"(?s)\A((?:{unit}){{"), first, F.lit(rf"}}+)((?:{unit}){{"), between, F.lit(r"}+)(.*)\z")),
    })
    output = F.when(F.col(form) == "plain", F.col(text)).otherwise(moved)
    result = F.struct(F.col(n).alias("n"), F.col(form).alias("form"), output.alias("output"))
    return found.withColumn(column, result).drop(text, n, form, pattern)


def parts(output: Column, form: Column) -> tuple[Column, Column, Column]:
    """Prefix, middle and suffix of an output, found by its markers; null if it is plain."""
    at = {marker: F.instr(output, marker) for marker in (PREFIX, SUFFIX, MIDDLE)}

    def between(order: str, marker: str) -> Column:
        markers = [m for m, _ in ORDERS[order]]
        start = at[marker] + len(marker)
        i = markers.index(marker) + 1
        end = at[markers[i]] if i < len(markers) else F.length(output) + 1
        return F.substring(output, start, end - start)

    return tuple(F.when(form == "psm", between("psm", m)).when(form == "spm", between("spm", m)) for m in (PREFIX, MIDDLE, SUFFIX))


def restore(output: Column, form: Column) -> Column:
    """The text, from output and form alone."""
    prefix, middle, suffix = parts(output, form)
    return F.when(form == "plain", output).otherwise(F.concat(prefix, middle, suffix))


def digest(found: DataFrame, column: str = "fim") -> DataFrame:
    """The digest columns; lengths and restored text are read back from the output."""
    output, form = F.col(f"{column}.output"), F.col(f"{column}.form")
    prefix, middle, _ = parts(output, form)
    return found.select(
        "doc_id", F.col(f"{column}.n").alias("n"), form.alias("form"), F.length(prefix).cast("long").alias("prefix_chars"),
        F.length(middle).cast("long").alias("middle_chars"), F.sha2(output.cast("binary"), 256).alias("output_sha256"),
        F.sha2(restore(output, form).cast("binary"), 256).alias("restored_sha256"),
    )
