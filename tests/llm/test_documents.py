"""Fingerprints, licences, languages and toxicity against plain versions and held-out rows."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from stayline.llm import chunks, langid, licences, toxicity
from stayline.llm.queries import QUERIES

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(draw, n):
    return " ".join("".join(draw.choices("abcdeéß", k=draw.randint(1, 8))) for _ in range(n))


def test_chunks_cover_and_come_back_in_step():
    draw = random.Random(1)
    data = words_of(draw, 3000).encode()
    ends = chunks.cuts(data)
    assert ends[-1] == len(data) and all(a < b <= a + chunks.MOST for a, b in zip([0, *ends], ends))
    moved = chunks.chunks(b"inserted at the front " + data)
    assert chunks.containment(chunks.chunks(data), moved) > 0.98
    assert chunks.parse(chunks.render(moved)) == moved
    assert chunks.cuts(b"") == [] and chunks.cuts(b"x") == [1]
    assert chunks.containment({}, {}) == 1.0 and chunks.containment({}, {1: 2}) == 0.0
    # the gear hash against its definition
    h = chunks.gear(data[:200])
    for i in (0, 5, 31, 32, 150):
        assert int(h[i]) == sum(int(chunks.GEAR[data[i - k]]) << k for k in range(min(i + 1, 32))) % 2**32


@pytest.mark.parametrize("buckets", [1, 2, 7, 50])
def test_edits_follow_the_ids(spark, buckets):
    draw = random.Random(2)
    rows = [(i * 3 - 20, words_of(draw, draw.choice((0, 1, 5, 80)))) for i in range(40)] + [(5, "tie b"), (5, "tie a"), (5, "tie a"), (None, "null id"), (10**12, None)]
    order = sorted(((i if i is not None else -(10**18)), t is not None, t or "") for i, t in rows)
    expected = []
    for k, (i, _, t) in enumerate(order):
        following, half = order[(k + 1) % len(order)][2], len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        a, b, c = (chunks.chunks(x.encode()) for x in (t, edited, following))
        expected.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), chunks.render(a), chunks.render(b), chunks.containment(a, b), chunks.containment(a, c)))
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, bucket int, last string").repartition(4)
    got = [(-(10**18) if r[0] is None else r[0], *r[1:]) for r in map(tuple, chunks.with_edits(df, buckets).collect())]
    assert sorted(got) == sorted(expected)


def test_edit_cases(spark):
    schema = "doc_id long, text string"
    assert chunks.with_edits(spark.createDataFrame([], schema)).count() == 0
    one = chunks.with_edits(spark.createDataFrame([(1, "abcd")], schema)).collect()[0]
    assert one["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and one["near_next"] == 1.0
    marked = chunks.fingerprint(spark.createDataFrame([(1, None), (2, "abc")], schema)).collect()
    assert marked[0]["fingerprint"] == "" and marked[1]["fingerprint"]


def places(text):
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))
    found = {}
    for phrase, label in licences.BASE.items():
        p = phrase.split()
        at = [i for i in range(len(ws) - len(p) + 1) if ws[i : i + len(p)] == p]
        if at:
            found[label] = at
    all_ = [i for at in found.values() for i in at]
    return len(ws), len(all_), min(all_, default=None), max(all_, default=None), ",".join(sorted(found))


def test_licences_against_all_places(spark):
    draw = random.Random(4)
    alphabet = ["cc", "by", "CC", "By-", "general", "public", "license", "License,", "all", "rights", "reserved", "x", "é", "4.0", "\n", "nc"]
    rows = [(i, " ".join(draw.choices(alphabet, k=draw.choice((0, 3, 30, 300))))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "cc by " * 50_000), (103, "Released under the MIT License."), (103, "Released under the MIT License."),
             (104, "This work is licensed under the GNU General Public License, version 3."), (105, "Licensed under CC BY-NC 4.0."),
             (106, "Licensed under the Apache License, Version 2.0."), (107, "under the license of the public"), (108, "the Apache License"), (None, "mit license released under the")]
    df = spark.createDataFrame([(i, t, "x", 3) for i, t in rows], "doc_id long, text string, licences string, n_words int")
    got = licences.digest(licences.scan(df)).collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted([tuple(r)[:6] for r in got], key=key) == sorted([(i, *places(t)) for i, t in rows], key=key)
    labels = {r["doc_id"]: (r["labels"], r["score"]) for r in got}
    assert labels[103] == ("mit", 1.0) and labels[104][0] == "gpl,gpl-3.0" and labels[105][0] == "cc-by,cc-by-nc-4.0" and labels[106][0] == "apache-2.0"
    assert labels[107] == labels[108] == labels[None] == ("", 0.0)
    assert all(0 <= r["score"] <= 1 for r in got)
    assert licences.scan(df.limit(0)).count() == 0


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION
OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
BSD2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution.
{}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF
THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
THIRD = "3. Neither the name of {} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
GNU = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice
and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS."""


def test_whole_licences_and_headers(spark):
    comment = lambda t: "/*\n" + "\n".join(" * " + line for line in t.split("\n")) + "\n */ int main() {}"
    texts = {
        comment(MIT): "mit", BSD2.format(""): "bsd,bsd-2-clause", comment(BSD2.format(THIRD.format("the Lemur Works of Upper Fenwick"))): "bsd,bsd-2-clause,bsd-3-clause",
        GNU.format("General Public", 2): "gpl,gpl-2.0", GNU.format("Affero General Public", 3): "agpl-3.0,gpl", GNU.format("Lesser General Public", "2.1"): "gpl,lgpl-2.1",
        "# SPDX-License-Identifier: BSD-3-Clause\nx = 1": "bsd-3-clause", "// SPDX-License-Identifier: EPL-2.0": "epl-2.0", "SPDX license of an identifier: MIT": "",
        "Distributed under the Boost Software License, Version 1.0.": "bsl-1.0", MIT.replace("free of charge", "for a fee"): "",
        # a changed word is borne, a changed key phrase isn't, and pieces in the wrong order are no licence
        BSD2.format("").replace("retain", "keep"): "bsd,bsd-2-clause", BSD2.format("").replace("CONSEQUENTIAL", "OTHER"): "bsd",
        "\n".join(reversed(BSD2.format("").split("\n"))): "bsd", "x " * 30_000 + MIT + " y" * 30_000: "mit",
    }
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["labels"] for r in licences.digest(licences.scan(df)).collect()}
    assert got == dict(enumerate(texts.values()))
    assert {"isc"} == {m["label"] for m in licences.scan_words(licences.build_index([0] * len(licences.VOCABULARY), 9), licences.words.hashes(ISC, licences.words.PLAIN))}


def test_licence_pieces_against_every_start():
    """The index proposes what the rule, tried at every start of a file, proposes."""
    import numpy as np

    draw, rare, meet = random.Random(8), 3, 2
    frequencies = [draw.randint(0, 50) for _ in licences.VOCABULARY]
    index = licences.build_index(frequencies, 60, rare, meet)
    idf = {w: np.log(61 / (1 + n)) + 1e-3 for w, n in zip(licences.VOCABULARY, frequencies)}
    n_found = 0
    for _ in range(20):
        label, base, parts = draw.choice(licences.ALL)
        text = [w for own, _ in parts for w in own] * draw.choice((1, 2)) + draw.choices(licences.VOCABULARY, k=draw.randint(0, 30))
        for i in draw.sample(range(len(text)), len(text) // 12):
            text[i] = draw.choice(("x", draw.choice(licences.VOCABULARY)))
        hashed = licences.words.hashes(" ".join(text), licences.words.PLAIN)
        at = {i: np.array([k for k, t in enumerate(text) if t == w]) for i, w in enumerate(licences.VOCABULARY) if w in text}
        piece_no = 0
        for _, is_base, own_pieces in licences.ALL:
            for own, need in own_pieces:
                piece, piece_no = index["pieces"][piece_no], piece_no + 1
                ranked = sorted(set(own) & set(text), key=lambda w: (-idf[w], w))
                looked = ranked if is_base else ranked[:rare]
                least = len(set(own)) if is_base else min(meet, len(set(own)))
                expected = []
                for start in range(-len(own), len(text) + 1):
                    same = [0 <= start + j < len(text) and text[start + j] == w for j, w in enumerate(own)]
                    agreeing = {w for w, ok in zip(own, same) if ok and w in looked}
                    weight = sum(idf[w] for w, ok in zip(own, same) if ok) / sum(idf[w] for w in own)
                    if len(agreeing) >= max(1, least) and all(same[j] for j in need) and (all(same) or weight >= 0.7):
                        expected.append(start)
                got, _ = licences.piece_matches(index, piece, at, hashed)
                assert got.tolist() == expected
                n_found += len(expected)
    assert n_found > 20


def test_languages_of_held_out_rows(spark):
    """On the documents with labels left out of the training folds."""
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    got = QUERIES["op8_language_id"](spark, sf).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(truth)
    held = [r for r in got if r["held_out"]]
    import zlib

    assert {r["doc_id"] for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.98
    assert sum(r["rejected"] for r in got) / len(got) < 0.005


def test_language_cases(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = langid.fit(docs)
    assert len(set(model["languages"])) == 4 < len(model["languages"])
    rows = [(1, None), (2, ""), (3, "123 $$ ### 4"), (4, "the"), (5, "Привет, как дела? " * 100), (6, "日本語の文章です。" * 200), (7, "the and that " * 100_000), (8, "x"), (8, "x")]
    df = spark.createDataFrame([(i, t, "en", 0.5) for i, t in rows], "doc_id long, text string, language string, score double")
    got = {r["doc_id"]: r["language"] for r in langid.identify(df, model).collect()}
    for i in (1, 2, 3):
        assert (got[i]["lang"], got[i]["score"], got[i]["rejected"]) == ("und", 0.0, True)
    assert got[5]["rejected"] and got[6]["rejected"] and not got[7]["rejected"] and got[7]["lang"] == "en" and not got[4]["rejected"]
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert langid.identify(df, model).count() == len(rows)
    assert langid.fit(docs.limit(0)) is None
    assert {r["language"]["lang"] for r in langid.identify(df, None).collect()} == {"und"}
    # only texts and languages teach: a changed source, and null languages, change nothing
    again = langid.fit(docs.withColumn("source", docs["lang"]).unionByName(docs.selectExpr("doc_id", "text", "cast(null as string) lang", "source", "n_chars")))
    assert again["languages"] == model["languages"]


def test_toxicity_of_rows_without_a_part_in_the_fit(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.fit(docs, labels.filter("doc_id % 2 = 0"))
    rest = labels.filter("doc_id % 2 = 1").withColumnRenamed("toxic", "truth")
    rows = toxicity.score(docs, model).join(rest, "doc_id").select("truth", "toxicity.*").collect()
    caught = sum(r["truth"] and r["toxic"] for r in rows) / sum(r["truth"] for r in rows)
    wrong = sum(r["toxic"] and not r["truth"] for r in rows) / sum(not r["truth"] for r in rows)
    assert caught > 0.88 and wrong < 0.01


def test_toxicity_cases(spark):
    draw = random.Random(5)
    text = lambda: " ".join(draw.choices([f"w{i}" for i in range(300)], k=40))
    clean = [(i, text()) for i in range(300)]
    bad = [(1000 + i, " ".join([text(), *draw.choices(("grumbo", "SNARFing", "blech!"), k=4)])) for i in range(60)]
    rows = [*clean, *bad, (2000, None), (2001, ""), (2002, "grumbo snarfed blech"), (2002, "grumbo snarfed blech"), (2003, "w1 " * 100_000), (None, "w1")]
    df = spark.createDataFrame([(i, t, "old", 1.0) for i, t in rows], "doc_id long, text string, toxicity string, p_toxic double")
    labels = spark.createDataFrame([(i, 0) for i, _ in clean[:200]] + [(i, 1) for i, _ in bad[:40]] + [(None, 1), (5000, None), (1, None), (1000, 0)], "doc_id long, toxic int")
    model = toxicity.fit(df, labels)
    got = toxicity.score(df, model)
    assert got.columns == df.columns and got.count() == len(rows)
    flags = {r["doc_id"]: r["toxicity"] for r in got.collect()}
    assert all(flags[i]["toxic"] for i, _ in bad) and not any(flags[i]["toxic"] for i, _ in clean)
    assert flags[2002]["toxic"] and not flags[2003]["toxic"] and flags[2000]["p_toxic"] == flags[2001]["p_toxic"] == 0.0
    assert toxicity.fit(df, labels.filter("toxic = 0")) is None and toxicity.fit(df, labels.limit(0)) is None
    assert not any(r["toxicity"]["toxic"] for r in toxicity.score(df, None).collect())
    assert toxicity.score(df.limit(0), model).count() == 0


def test_chain_feeds_earlier_categories():
    import numpy as np

    rng = np.random.default_rng(0)
    x = (rng.random((600, 6)) < 0.3).astype(np.float32)
    first = ((x[:, 0] + x[:, 1]) > 0).astype(np.float32)
    models = toxicity.fit_chain(x, [first, first * (x[:, 2] > 0)], np.arange(600) % 3)
    assert [len(m) for m in models] == [7, 8] and models[1][6] > 0.5


def test_out_of_fold_inputs_know_no_label_of_their_fold(spark):
    """With random labels, marks chosen with all labels would fit; those of the other folds do not."""
    draw = random.Random(11)
    rows = [(i, " ".join(draw.choices([f"q{k}" for k in range(400)], k=20)), draw.randint(0, 1), draw.randint(0, 1)) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int, quality int")
    seen = {}

    def keep(x, targets, fold, views=None):
        seen.update(x=x, targets=targets, fold=fold, views=views)
        return original(x, targets, fold, views)

    original, toxicity.fit_chain = toxicity.fit_chain, keep
    try:
        toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic", "quality"), least_z=1.0)
    finally:
        toxicity.fit_chain = original
    toxic, fold = seen["targets"][3], seen["fold"]
    leak = seen["x"][:, -5]
    clean = sum(seen["views"][f][0][:, -5] * (fold == f) for f in seen["views"])
    gap = lambda v: v[toxic == 1].mean() - v[toxic == 0].mean()
    assert gap(leak) > 0.1 and abs(gap(clean)) < 0.5 * gap(leak)
    assert seen["targets"][0].sum() == sum(r[3] == 0 for r in rows)


def test_the_fit_holds_no_matrix_of_all_marks_on_the_driver(spark):
    """The sample's inputs, for all folds, take the driver a small part of rows x marks numbers."""
    import tracemalloc

    draw = random.Random(3)
    clean, bad = [f"w{i}" for i in range(400)], [f"vile{i:03d}" for i in range(400)]
    rows = [(i, " ".join([*draw.choices(clean, k=20), *(draw.choices(bad, k=6) if i % 3 == 0 else ())]), int(i % 3 == 0)) for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(8)
    rows.clear()
    tracemalloc.start()
    try:
        model = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    marks = len(model["table"]["hashes"])
    assert marks > 300 and peak < 2 * 6000 * marks * 4
    got = toxicity.score(df, model).collect()
    assert sum(r["toxicity"]["toxic"] == r["toxic"] for r in got) > 0.99 * 6000


def test_toxicity_ignores_odd_labels(spark):
    """Null qualities are not poor, labels above 1 are toxic, ties between repeated labels go to the larger."""
    rows = [(i, ("grumbo snarf " if i % 3 == 0 else "") + f"w{i % 7} w{i % 5}", 2 if i % 3 == 0 else 0, None if i % 2 else 1) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int, quality int")
    labels = df.select("doc_id", "toxic", "quality").union(df.selectExpr("doc_id", "0", "null"))
    got = toxicity.score(df.select("doc_id", "text"), toxicity.fit(df, labels)).collect()
    assert all(r["toxicity"]["toxic"] == (r["doc_id"] % 3 == 0) and r["toxicity"]["p_poor"] < 0.5 for r in got)


def test_every_labelled_language_is_learned(spark):
    """Many languages of one or two rows each: none is lost to the draw of the sample."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(i, " ".join(letters[(k * 7 + j * 3) % 26] * 3 for j in range(6)), f"l{k:03d}") for i, k in enumerate([*range(400), *range(0, 400, 5)])]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), most=100)
    assert set(model["languages"]) == {r[2] for r in rows}
    assert spark.range(1).select(langid.held_out(F.lit(None).cast("long"))).first()[0] is False
