"""Fill-in-the-middle against a plain version; every text is rebuilt from output and form."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from stayline.llm import fim
from stayline.llm.queries import QUERIES


def plain(doc_id, text, seed=7, moved=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= moved:
        return len(units), "plain", text, None, None
    if h[3] % 100 < spm:
        return len(units), "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    return len(units), "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def texts():
    draw = random.Random(5)
    rows = [(None, "no id\nhere\n"), (1, None), (2, ""), (3, "\n"), (4, "\n\n\n"), (5, "a <P> b\nc\n"), (6, "x\n<M>"), (7, "one line"), (8, "é\U0001f600\r\nß \n$1 \\1 {3}\n"),
            (9, "<P"), (10, "<S\n>\nM>\n<"), (11, "same\nid\n"), (11, "same\nid\n"), (11, "other\ntext\nof\nit"), (-4, "below\nzero\n"), (12, "\n".join(map(str, range(100_000)))), (13, "z" * 300_000), (14, "\n" * 70_000)]
    for i in range(20, 320):
        rows.append((i, "".join(draw.choice(("a", "\n", "<", ">", "P", "é", "\U0001f600", " ", "\r")) for _ in range(draw.choice((1, 2, 5, 40, 400))))))
    return rows


def test_forms_and_round_trip(spark):
    rows = texts()
    # names that the operator uses inside are the caller's too
    df = spark.createDataFrame([(i, t, 1, "keep") for i, t in rows], "doc_id long, text string, fim_n int, FIM_TEXT string")
    for moved, spm in ((100, 50), (60, 0), (0, 50), (100, 100)):
        found = fim.transform(df, 7, moved, spm)
        assert found.columns == ["doc_id", "text", "fim_n", "FIM_TEXT", "fim"]
        got = found.select("doc_id", "text", "fim_n", "FIM_TEXT", "fim.*", *[F.length(x).alias(y) for x, y in zip(fim.parts(F.col("fim.output"), F.col("fim.form"))[:2], "pm")],
                           fim.restore(F.col("fim.output"), F.col("fim.form")).alias("restored")).collect()
        assert len(got) == len(rows)
        for r in got:
            assert (r["n"], r["form"], r["output"], r["p"], r["m"]) == plain(r["doc_id"], r["text"], 7, moved, spm), r["doc_id"]
            assert r["restored"] == (r["text"] or "") and r["fim_n"] == 1 and r["FIM_TEXT"] == "keep"


def test_other_units(spark):
    df = spark.createDataFrame([(i, "aa bb  cc d" * i) for i in range(6)], "doc_id int, text string")
    found = fim.transform(df, unit=r"[^ ]*+ |[^ ]++").select("text", fim.restore(F.col("fim.output"), F.col("fim.form")), "fim.n").collect()
    assert all(r[0] == r[1] and r["n"] == len(re.findall(r"[^ ]* |[^ ]+", r[0])) for r in found)


def test_query_and_empty_table(spark, sf):
    assert fim.transform(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op12_fill_in_middle"](spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        n, form, output, p, m = plain(r["doc_id"], docs[r["doc_id"]])
        assert tuple(r) == (r["doc_id"], n, form, p, m, sha(output), sha(docs[r["doc_id"]] or ""))


def test_plan_has_no_python(spark, sf):
    plan = QUERIES["op12_fill_in_middle"](spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
