"""Text line decoders: view logs, dense and serialized points, vector JSON, click logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.functions.scalars import number
from stayline.functions.strings import field, last_piece, last_query_param, matches_all, split_fields, strip, url_clean
from stayline.functions.strings import HAN_THEN_NUMBER
from stayline.sources.views import VIEW_LOG_FIELDS


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def _split_where(lines: DataFrame, parts: Column, keep: list[str], condition) -> DataFrame:
    """Columns ``keep`` and ``p``, the field array of the lines whose fields meet the condition.

    The condition sits in a generator because Catalyst would push a plain filter below the split and
    split every line once per predicate.
    """
    split = lines.select(*keep, parts.alias("_p"))
    return split.select(*keep, F.explode(F.when(condition("_p"), F.array("_p"))).alias("p"))


def view_log(lines: DataFrame, channel: str | None = None, rule: str = "show", title_pattern: str = HAN_THEN_NUMBER) -> DataFrame:
    """29 named string columns from view-log lines.

    ``rule='show'`` keeps rows with a show name, ``rule='title'`` rows whose whole title matches the
    pattern; both also require the channel when one is given. Lines that do not contain the channel
    anywhere are dropped before they are split.
    """
    position = {name: i for i, name in enumerate(VIEW_LOG_FIELDS)}

    def wanted(p: str) -> Column:
        ok = F.lit(True)
        if rule == "show":
            ok = field(p, position["showname"]) != ""
        elif rule == "title":
            ok = matches_all(field(p, position["title"]), title_pattern)
        return ok if channel is None else ok & (field(p, position["channelId2"]) == channel)

    if channel is not None:
        lines = lines.where(F.contains("value", F.lit(channel)))
    df = _split_where(lines, split_fields("value"), [], wanted)
    return df.select(*[field("p", i).alias(name) for name, i in position.items()])


def dense_points(
    lines: DataFrame,
    label_sep: str = ",",
    value_sep: str = " ",
    recode: dict[float, float] | None = None,
    comment: str | None = None,
    has_id: bool = False,
    label: str = "first",
) -> DataFrame:
    """``label<sep>x1 x2 …`` lines to label and features; separators are regular expressions.

    ``comment`` drops lines that start with it, ``recode`` maps label values (such as -1 to 0),
    ``has_id`` reads a leading id, ``label='last'`` expects the label at the end.
    """
    if comment:
        lines = lines.where(~F.col("value").startswith(comment))
    sep = label_sep if label_sep == value_sep else f"(?:{label_sep}|{value_sep})"
    df = lines.select(F.split(strip("value"), sep).alias("t"))
    ident = field("t", 0) if has_id else F.lit(None).cast("string")
    start = 1 if has_id else 0
    rest = F.slice("t", start + 1, F.size("t") - start)
    df = df.select(ident.alias("id"), F.transform(rest, number).alias("v"))
    n = F.size("v")
    y = field("v", 0) if label == "first" else F.element_at("v", -1)
    for old, new in (recode or {}).items():
        y = F.when(y == old, F.lit(new)).otherwise(y)
    x = F.slice("v", 2, n - 1) if label == "first" else F.slice("v", 1, n - 1)
    return df.select(*(["id"] if has_id else []), y.alias("label"), x.alias("features"))


def _numbers(text: Column) -> Column:
    return F.transform(F.filter(F.split(text, ","), lambda t: F.trim(t) != ""), number)


def serialized_points(lines: DataFrame, column: str = "value", keep: list[str] | None = None) -> DataFrame:
    """``(y,[x,…])``, ``(y,(n,[i,…],[v,…]))`` or the old form ``y,x x …`` to columns.

    Gives label, size, indices (NULL when dense) and values; ``corrupt`` marks lines of none of the
    three forms or with a piece that is not a number.
    """
    text = F.regexp_replace(column, "\\s+", " ")
    num = "\\s*([^,\\[\\]() ]+)\\s*"
    dense = f"\\A\\s*\\({num},\\s*\\[([^\\[\\]()]*)\\]\\s*\\)\\s*\\z"
    sparse = f"\\A\\s*\\({num},\\s*\\({num},\\s*\\[([^\\[\\]()]*)\\],\\s*\\[([^\\[\\]()]*)\\]\\s*\\)\\s*\\)\\s*\\z"
    old = f"\\A{num},([^,\\[\\]()]*)\\z"
    t = F.col("_t")
    is_dense, is_sparse, is_old = (t.rlike(p) for p in (dense, sparse, old))
    part = lambda p, g: F.regexp_extract(t, p, g)
    label = number(F.when(is_dense, part(dense, 1)).when(is_sparse, part(sparse, 1)).when(is_old, part(old, 1)))
    values = (
        F.when(is_dense, _numbers(part(dense, 2)))
        .when(is_sparse, _numbers(part(sparse, 4)))
        .when(is_old, _numbers(F.regexp_replace(F.trim(part(old, 2)), " ", ",")))
    )
    indices = F.when(is_sparse, F.transform(_numbers(part(sparse, 3)), lambda v: v.cast("int")))
    size = F.when(is_sparse, number(part(sparse, 2)).cast("int"))
    df = lines.select(*(keep or []), text.alias("_t")).select(
        *(keep or []), label.alias("label"), size.alias("size"), indices.alias("indices"), values.alias("values")
    )
    bad = (
        F.col("label").isNull()
        | F.col("values").isNull()
        | F.exists("values", lambda v: v.isNull())
        | (F.col("indices").isNotNull() & (F.size("indices") != F.size("values")))
        | (F.col("indices").isNotNull() & (F.col("size").isNull() | F.exists("indices", lambda v: v.isNull())))
    )
    return df.select(
        *(keep or []),
        F.when(~bad, F.col("label")).alias("label"),
        F.when(~bad, F.coalesce("size", F.size("values"))).alias("size"),
        F.when(~bad, F.col("indices")).alias("indices"),
        F.when(~bad, F.col("values")).alias("values"),
        bad.alias("corrupt"),
    )


VECTOR_JSON = "type int, size int, indices array<int>, values array<double>"


def vector_json(text: Column | str) -> Column:
    """``{"type":0,"size":n,"indices":[…],"values":[…]}`` (sparse) or ``{"type":1,"values":[…]}`` (dense)."""
    return F.from_json(text, VECTOR_JSON)


def clicks(lines: DataFrame, codes: tuple[str, ...], keep: list[str] | None = None) -> DataFrame:
    """Click-log lines to page, pos, vid, title and user.

    A row is a click when it has more than 75 fields and field 73 holds one of the codes. Codes that
    contain ``home_shome`` identify the user by field 3, take the page from ``ct`` and the video id
    from the fifth piece; the others use field 1, ``cn`` and the fourth.
    """
    keep = keep or []
    df = _split_where(
        lines, F.split("value", "\t"), keep, lambda p: (F.size(p) > 75) & F.greatest(*[field(p, 73).contains(c) for c in codes], F.lit(False))
    )
    refer = strip(field("p", 73))
    owner = refer.contains("home_shome")
    df = df.select(
        *keep,
        refer.alias("refer"),
        owner.alias("owner"),
        strip(field("p", 1)).alias("guid"),
        strip(field("p", 3)).alias("ouid"),
        url_clean(strip(field("p", 58))).alias("params"),
    )
    pieces = F.split("refer", ",")

    return df.select(
        *keep,
        F.when(F.col("owner"), last_query_param("params", "ct")).otherwise(last_query_param("params", "cn")).alias("page"),
        last_piece("refer").alias("pos"),
        F.when(F.col("owner"), F.get(pieces, F.lit(4))).otherwise(F.get(pieces, F.lit(3))).alias("vid"),
        last_query_param("params", "title").alias("title"),
        F.when(F.col("owner"), F.col("ouid")).otherwise(F.col("guid")).alias("user"),
    )
