"""Personal data: plain spans against the given patterns, disguised ones by example, prose without any."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from stayline.llm import pii
from stayline.llm.queries import QUERIES

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, value):
    digits = [int(c) for c in value if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def plain(text):
    return [(kind, *m.span()) for kind, pattern in PLAIN.items() for m in re.finditer(pattern, text or "") if valid(kind, m[0])]


def disguised(text):
    return [(pii.KINDS[k], text[a:b], v) for k, a, b, v, d in pii.find(text) if d]


def test_plain_spans_are_those_of_the_patterns():
    draw = random.Random(4)
    pieces = ["4207051279108084", "4111 1111-1111 1111", "+1 (375) 555-4393", "192.168.0.1", "300.1.1.1", "00001.2.3.4", "a.b@c-d.example.org", "@", "x@y", "..", "é", "\U0001f600", " ", "-", "+", "1", "23", "(", "@@", "_", "%", "a@b.c_d@e.f", ".5.6.7", "  ", "\n"]
    for _ in range(4000):
        text = "".join(draw.choice(pieces) for _ in range(draw.randint(1, 9)))
        assert [(pii.KINDS[k], a, b) for k, a, b, _, d in pii.find(text) if not d] == plain(text), text
    for _ in range(4000):
        text = "".join(draw.choice("09+.-@a (") for _ in range(draw.randint(1, 40)))
        assert [(pii.KINDS[k], a, b) for k, a, b, _, d in pii.find(text) if not d] == plain(text), text


@pytest.mark.parametrize("kind,source,value", [
    ("email", "anna dot berg at mail dot example dot org", "anna.berg@mail.example.org"),
    ("email", "anna.berg (at) mail (dot) example (dot) org", "anna.berg@mail.example.org"),
    ("email", "fakol.33[at]mail7[.]example[.]com", "fakol.33@mail7.example.com"),
    ("email", "fаkol.33@mаil7.examрle.com", "fakol.33@mail7.example.com"),
    ("email", "fakol.33 at mail7.example.com", "fakol.33@mail7.example.com"),
    ("email", "max klammeraffe post punkt de", "max@post.de"),
    ("email", "juan arroba correo punto es", "juan@correo.es"),
    ("email", "jean arobase exemple point fr", "jean@exemple.fr"),
    ("email", "john-at-example-dot-com", "john@example.com"),
    ("email", "anna&#64;example&#46;com", "anna@example.com"),
    ("email", "x @ y . com", "x@y.com"),
    ("email", "ｕｓｅｒ＠ｅｘ．ｃｏｍ", "user@ex.com"),
    ("email", "a​nna@exa­mple.com", "anna@example.com"),
    ("ip", "one nine two dot one six eight dot zero dot one", "192.168.0.1"),
    ("ip", "192 dot 168 dot 0 dot 12", "192.168.0.12"),
    ("ip", "192[.]168[.]0[.]1", "192.168.0.1"),
    ("ip", "192 . 168 . 0 . 1", "192.168.0.1"),
    ("card", "four one one one, one one one one, one one one one, one one one one", "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1"),
    ("card", "４２０７０５１２７９１０８０８４", "4207051279108084"),
    ("card", "vier zwei null sieben null fünf eins zwei sieben neun eins null acht null acht vier", "4 2 0 7 0 5 1 2 7 9 1 0 8 0 8 4"),
    ("card", "4111 one one one one 1111 1111", "4111 1 1 1 1 1111 1111"),
    ("phone", "plus four nine one five one two three four five six seven eight", "+4 9 1 5 1 2 3 4 5 6 7 8"),
    ("phone", "plus one double five five zero one two three four five six", "+1 55 5 0 1 2 3 4 5 6"),
    ("phone", "+٤٩ 151 2345678", "+49 151 2345678"),
    ("phone", "+1 375–555‑4393", "+1 375-555-4393"),
])
def test_disguises_map_back(kind, source, value):
    for before, after in (("", ""), ("Write é\U0001f600 to ", " now."), ("\n", "\nand more. "), ("x" * 50_000 + " ", ".")):
        assert disguised(before + source + after) == [(kind, source, value)]
    assert len(disguised(f"{source}; {source}")) == 2


@pytest.mark.parametrize("text", [
    "look at the dot on the screen", "At that. On it goes, at this point in time.", "see the docs at www.example.com or example.org", "one two", "seven, eight, nine, zero people", "a point of order, one by one",
    "mail a@b.com · de", "mail a@b.com — thanks", "10.0.0.5 one thing", "un deux trois", "chapter 12 at docs.example.com", "1. 2. 3. 4. and 5.", "привет at home", "(.) [at]", "a@b.com", "@ . @", "½ of them", "",
])
def test_prose_yields_nothing(text):
    assert disguised(text) == []


def test_spans_of_both_kinds_stay():
    text = "fаkol.33@mail7.example.com"
    assert pii.find(text) == [(0, 0, 26, "fakol.33@mail7.example.com", True), (0, 2, 26, "kol.33@mail7.example.com", False)]


def test_no_planted_prose_is_disguised(spark, sf):
    texts = [r[0] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    assert not any(disguised(t) for t in texts)


@pytest.mark.parametrize("piece", ["at ", "1.", "one ", "a@", "9", "+1 ", "a.b.c@d.", "1 dot ", "x at y dot ", "а", "one dot ", " . 1", "[at]", "-at-", "(("])
def test_long_texts(piece):
    pii.find(piece * 20_000)


def test_scan_redact_and_query(spark, sf):
    text = "ab fаkol.33@mail7.example.com, anna at example dot com; 10.0.0.5!"
    rows = [(1, text, "x"), (1, text, "x"), (None, None, "y"), (2, "", "z"), (3, "4207051279108084 \U0001f600 +1 (375) 555-4393", None)]
    found = pii.scan(spark.createDataFrame(rows, "doc_id long, text string, kind string"))
    got = {(r["doc_id"], r["kind"]): r for r in found.withColumn("clean", pii.redact(F.coalesce("text", F.lit("")), F.col("pii"))).collect()}
    assert len(found.collect()) == 5 and found.columns == ["doc_id", "text", "kind", "pii"]
    assert got[1, "x"]["clean"] == "ab [EMAIL], [EMAIL]; [IP]!" and got[3, None]["clean"] == "[CARD] \U0001f600 [PHONE]" and got[None, "y"]["clean"] == ""
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op11_personal_data"](spark, sf).collect():
        want = plain(docs[r["doc_id"]])
        assert [r[f"n_{k}"] for k in PLAIN] == [sum(s[0] == k for s in want) for k in PLAIN]
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest() and set(listed.split(",")) <= set(r["spans"].split(","))
    assert pii.digest(pii.scan(spark.createDataFrame([], "doc_id long, text string"))).count() == 0
