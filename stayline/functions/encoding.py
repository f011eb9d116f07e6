"""Class-token decoding: token arrays to label and numeric features.

One operator with presets. Special tokens are tested before any number is parsed, because NaN sorts
above every number in Spark and would otherwise survive the clamp.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.functions.scalars import clamp, number
from stayline.functions.strings import drop_ends, split_fields


@dataclass(frozen=True)
class Encoding:
    tokens: dict[str, float] = field(default_factory=dict)
    clamp: bool = False
    floor_negative: bool = False  # negative numbers become 0
    skip_head: int = 0  # fields dropped in front of the label
    skip_tail: int = 0
    label: str = "first"  # first | last | none


def _tokens(one: str = "", zero: str = "", **other: float) -> dict[str, float]:
    return {**{t: 1.0 for t in one.split()}, **{t: 0.0 for t in zero.split()}, **other}


# Which tokens stand for which number in each file layout.
ENCODINGS = {
    "churn": Encoding(_tokens(one="b c", zero="a NaN Infinity NULL"), clamp=True),
    "churn_b": Encoding(_tokens(one="b", zero="a NaN Infinity NULL")),
    "unlabelled_c": Encoding(_tokens(one="c", zero="a b NaN Infinity"), label="none"),
    "keyed_b": Encoding(_tokens(one="b", zero="a"), skip_head=1),
    "regression": Encoding(skip_head=2, label="last"),
    "retained": Encoding(_tokens(one="a", zero="b c NULL"), clamp=True),
    "bayes": Encoding(_tokens(one="b", zero="a NaN NULL"), floor_negative=True),
    "three_class": Encoding(_tokens(one="c", zero="a NULL NaN", b=2.0), floor_negative=True),
    "three_class_abc": Encoding(_tokens(one="a", zero="NULL NaN", b=2.0, c=3.0)),
    "svm_binary": Encoding(_tokens(one="b", zero="a NULL NaN SEQ"), floor_negative=True),
}


def encode_token(token: Column, value: Column, enc: Encoding) -> Column:
    """Numeric value of one token, given what it parses to; NULL when it is neither a known token nor a number."""
    if enc.clamp:
        value = F.when(F.isnan(value), F.lit(0.0)).otherwise(clamp(value))
    if enc.floor_negative:
        value = F.when(value < 0, F.lit(0.0)).otherwise(value)
    by_value: dict[float, list[str]] = {}
    for name, v in enc.tokens.items():
        by_value.setdefault(v, []).append(name)
    expr = None
    for v, names in by_value.items():
        expr = (F if expr is None else expr).when(token.isin(names), F.lit(v))
    return value if expr is None else expr.otherwise(value)


def encode(df: DataFrame, preset: str | Encoding, parts: str = "parts", keep: list[str] | None = None) -> DataFrame:
    """Add ``label``, ``features`` (array<double>) and ``n_bad`` (unparsable tokens) from a token array."""
    enc = ENCODINGS[preset] if isinstance(preset, str) else preset
    fields = drop_ends(parts, enc.skip_head, enc.skip_tail)
    # each token is parsed once; what follows only reads the parsed number
    parsed = F.transform(fields, lambda t: F.struct(t.alias("token"), number(t).alias("value")))
    values = F.transform(parsed, lambda t: encode_token(t["token"], t["value"], enc))
    columns = [F.col(c) for c in (keep or [])]
    df = df.select(*columns, values.alias("_v"))
    v = F.col("_v")
    label, features = {
        "first": (F.get(v, F.lit(0)), drop_ends(v, 1, 0)),
        "last": (F.element_at(v, -1), drop_ends(v, 0, 1)),
        "none": (F.lit(None).cast("double"), drop_ends(v, 1, 0)),
    }[enc.label]
    return df.select(
        *columns,
        label.alias("label"),
        features.alias("features"),
        F.size(F.filter(v, lambda x: x.isNull())).alias("n_bad"),
    )


def encode_lines(lines: DataFrame, preset: str | Encoding, key: bool = False, drop_last: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Tab-separated ``value`` lines; with ``key`` the first field is kept as ``guid`` and not decoded. ``keep`` names other columns to keep."""
    keep = keep or []
    df = lines.select(split_fields("value").alias("_p"), *keep)
    head, tail = (1 if key else 0), (1 if drop_last else 0)
    columns = [drop_ends("_p", head, tail).alias("parts"), *keep]
    if key:
        columns.append(F.get("_p", F.lit(0)).alias("guid"))
    return encode(df.select(*columns), preset, keep=(["guid"] if key else []) + keep)
