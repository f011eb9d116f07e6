"""Licence scan with a positional index of rare words.

Templates are licence texts, headers, short notices and tags. A template is one or more pieces; where a licence names its holders, one piece ends and
the next begins. The index lists every licence word with the pieces and the places in them where it stands. How rare a word is comes
from its document frequency over all documents.

For each file, and each piece whose key words the file has, the ``rare`` words of the highest inverse document frequency *that the file
holds* are looked up. A posting whose word stands at place o of the piece and at word p of the file says that the piece would start
at p - o; the starts of the looked-up words are intersected: a start stays if at least ``meet`` of the words propose it (all words of a base phrase). At each
start left the aligned words are compared: a base phrase must agree in every word; a piece must agree in ``share`` of its weight (by
inverse document frequency) and hold all its mandatory key phrases. A template of several pieces matches where all of them do, in
order, each at most ``gap`` words behind the one before. A licence that contains another's whole text has both labels.

Every word of a base phrase is looked up and every occurrence of it counts, so no place is lost.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased. Nulls: a null or empty text has no words and no
matches. Words of equal frequency rank by the alphabet. Repeated rows come back repeated; an empty table gives no rows. All other columns are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.llm import words

# fixed values: phrases whose every place is reported, and their labels
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# fixed values: well-known notices, headers and licence texts; *key phrases* must stand in a match, [...] are names of holders and the like
_BSD = (
    "*redistribution and use in source and binary forms* with or without modification are permitted provided that the following conditions are met "
    "[...] *redistributions of source code* must retain the above copyright notice this list of conditions and the following disclaimer "
    "[...] *redistributions in binary form* must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution "
)
_BSD_END = (
    "[...] as is and *any express or implied warranties* including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed "
    "[...] be liable for any *direct indirect incidental special exemplary or consequential damages* including but not limited to procurement of substitute goods or services "
    "loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise "
    "arising in any way out of the use of this software even if advised of the possibility of such damage"
)
_GNU = "you can redistribute it and or modify it under the terms of the *gnu {} license* as published by the free software foundation either *version {}* of the license or at your option any later version"
TEMPLATES = (
    ("0bsd", "*permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is and the author disclaims all warranties* with regard to this software"),
    ("agpl-3.0", _GNU.format("affero general public", 3)),
    ("agpl-3.0", "licensed under the gnu *affero general public license*"),
    ("apache-2.0", "licensed under the *apache license* version 2 0"),
    ("apache-2.0", "you may obtain a copy of the license at http www *apache org licenses* license 2 0"),
    (
        "apache-2.0",
        "licensed under the *apache license* version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 "
        "[...] unless required by applicable law or agreed to in writing software distributed under the license is distributed on an *as is basis without warranties or conditions* of any kind either express or implied "
        "see the license for the specific language governing permissions and limitations under the license",
    ),
    ("artistic-2.0", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed [...] this license establishes the terms under which a given *free software package* may be copied modified distributed and or redistributed"),
    ("bsd", "*redistribution and use in source and binary forms* with or without modification are permitted"),
    ("bsd-2-clause", _BSD + _BSD_END),
    ("bsd-3-clause", _BSD + "[...] *may be used to endorse or promote products* derived from this software without specific prior written permission " + _BSD_END),
    (
        "bsl-1.0",
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation *covered by this license the software* to use reproduce display distribute execute and transmit "
        "the software and to prepare *derivative works of the software*",
    ),
    ("bsl-1.0", "distributed under the *boost software license* version 1 0"),
    ("cc-by-4.0", "this work is licensed under a *creative commons attribution 4 0* international license"),
    ("cc-by-nc-4.0", "licensed under *cc by nc* 4 0"),
    ("cc-by-sa-4.0", "licensed under *cc by sa* 4 0"),
    ("cc0-1.0", "to the extent possible under law the author has *waived all copyright* and related or neighboring rights"),
    ("epl-2.0", "this program and the accompanying materials are made available under the terms of the *eclipse public license* 2 0"),
    ("epl-2.0", "the accompanying materials are made available under the terms of the *eclipse public license v 2 0*"),
    ("gpl-2.0", "this work is licensed under the *gnu general public license* *version 2*"),
    ("gpl-2.0", _GNU.format("general public", 2)),
    ("gpl-3.0", "this work is licensed under the *gnu general public license* *version 3*"),
    ("gpl-3.0", _GNU.format("general public", 3)),
    (
        "isc",
        "*permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted* provided that the above *copyright notice and this permission notice appear in all copies* "
        "[...] *disclaims all warranties* with regard to this software including all implied warranties of merchantability and fitness",
    ),
    ("lgpl", "licensed under the gnu *lesser general public license*"),
    ("lgpl-2.1", _GNU.format("lesser general public", "2 1")),
    ("lgpl-3.0", _GNU.format("lesser general public", 3)),
    ("mit", "released under the *mit license*"),
    ("mit", "*permission is hereby granted* *free of charge* to any person obtaining a copy of this software"),
    (
        "mit",
        "*permission is hereby granted free of charge* to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions "
        "[...] *permission notice shall be included in all copies* or substantial portions of the software "
        "[...] the software is provided *as is without warranty of any kind* express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement "
        "[...] be liable for any *claim damages or other liability* whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    ),
    ("mpl-2.0", "this source code form is subject to the terms of the *mozilla public license* v 2 0"),
    ("proprietary", "*unauthorized copying* of this file via any medium is *strictly prohibited*"),
    ("unlicense", "this is free and *unencumbered software* released into the public domain"),
    (
        "unlicense",
        "this is free and *unencumbered software* released into the public domain [...] anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary "
        "*for any purpose commercial or non commercial* and by any means",
    ),
    (
        "zlib",
        "this software is provided *as is without any express or implied warranty* in no event will the authors be held liable for any damages arising from the use of this software "
        "[...] permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions "
        "[...] the origin of this software *must not be misrepresented* [...] altered source versions must be *plainly marked as such* [...] this notice may not be removed or altered from any *source distribution*",
    ),
)
# fixed values: identifiers that a tag may name right behind "SPDX-License-Identifier:"
TAGS = (
    "0BSD AGPL-3.0 Apache-2.0 Artistic-2.0 BSD-2-Clause BSD-3-Clause BSL-1.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-SA-4.0 CC0-1.0 EPL-2.0 GPL-2.0 GPL-3.0 ISC LGPL-2.1 LGPL-3.0 MIT MPL-2.0 Unlicense Zlib"
).split()


def pieces(text: str) -> list[tuple[list[str], list[int]]]:
    """The pieces of a template: their words, and the places of words in key phrases."""
    out = []
    for piece in text.split("[...]"):
        own, need = [], []
        for i, part in enumerate(piece.split("*")):
            found = part.split()
            need += range(len(own), len(own) + len(found)) if i % 2 else ()
            own += found
        if own:
            out.append((own, need))
    return out


# label, whether it is a base phrase, pieces
ALL = (
    *((label, True, pieces(f"*{phrase}*")) for phrase, label in BASE.items()),
    *((label, False, pieces(text)) for label, text in TEMPLATES),
    *((tag.lower(), False, pieces(f"*spdx license identifier {re.sub('[-.]', ' ', tag.lower())}*")) for tag in TAGS),
)
VOCABULARY = sorted({w for _, _, ps in ALL for own, _ in ps for w in own})

MATCH = pa.struct([("label", pa.string()), ("base", pa.bool_()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("share", pa.float64())])
SCAN = pa.struct([("n_words", pa.int64()), ("matches", pa.list_(MATCH))])
_SCAN = "n_words: long, matches: array<struct<label: string, base: boolean, first_word: long, n_words: long, share: double>>"


def _vocabulary() -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the licence words, and the word number of each."""
    hashed = np.array([words.word_hash(w) for w in VOCABULARY], np.uint64)
    order = np.argsort(hashed)
    return hashed[order], order


def _licence_words(hashed: np.ndarray, values: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of licence words in a file, and which they are."""
    at = np.minimum(np.searchsorted(values, hashed), len(values) - 1)
    places = np.flatnonzero(values[at] == hashed)
    return places, order[at[places]]


def document_frequencies(docs: DataFrame) -> tuple[list[int], int]:
    """For each licence word, how many of all documents hold it; and the number of documents.

    Each task counts what it reads into one row per word; sums of at most ``len(VOCABULARY)`` rows reach the driver.
    """
    values, order = _vocabulary()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(order) + 1, np.int64)
        for batch in batches:
            for text in words.texts(batch.column(0)):
                total[np.unique(_licence_words(words.hashes(text, words.PLAIN), values, order)[1])] += 1
            total[-1] += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["word", "n"])

    rows = docs.select(F.col("text").cast("string")).mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    found = {r["word"]: r["n"] for r in rows}
    return [found.get(i, 0) for i in range(len(order))], found.get(len(order), 0)


def build_index(frequencies: list[int], n_docs: int, rare: int = 3, meet: int = 2, share: float = 0.7, gap: int = 60) -> dict:
    """Pieces with their words by falling inverse document frequency, the places of each, and the words that each piece must find."""
    idf = np.log((1 + n_docs) / (1 + np.array(frequencies, np.float64))) + 1e-3
    number = {w: i for i, w in enumerate(VOCABULARY)}
    templates, found = [], []
    for label, base, parts in ALL:
        own_pieces = []
        for own, need in parts:
            which = np.array([number[w] for w in own])
            distinct = np.unique(which)
            own_pieces.append(len(found))
            found.append({
                "base": base, "words": np.array([words.word_hash(w) for w in own], np.uint64), "weights": idf[which] / idf[which].sum(),
                "need": np.array(need, np.int64), "ranked": distinct[np.lexsort((distinct, -idf[distinct]))].tolist(),
                "places": {w: np.flatnonzero(which == w) for w in distinct.tolist()},
            })
        templates.append((label, base, own_pieces))
    values, order = _vocabulary()
    must = np.zeros((len(found), len(VOCABULARY)), np.float32)
    for i, p in enumerate(found):
        must[i, [number[w] for w in VOCABULARY if words.word_hash(w) in set(p["words"][p["need"]].tolist())]] = 1
    return {"values": values, "order": order, "pieces": found, "templates": templates, "must": must, "rare": rare, "meet": meet, "share": share, "gap": gap}


def proposed_starts(piece: dict, at: dict[int, np.ndarray], rare: int, meet: int) -> np.ndarray:
    """Where a piece may start in a file, from the postings of the file's rarest words of it; ``at``: the places of each licence word."""
    lookups = [w for w in piece["ranked"] if w in at]
    lookups, least = (lookups, len(piece["ranked"])) if piece["base"] else (lookups[:rare], min(meet, len(piece["ranked"])))
    starts = [np.unique((at[w][:, None] - piece["places"][w]).reshape(-1)) for w in lookups]
    if len(starts) < max(1, least):
        return np.empty(0, np.int64)
    first, n = np.unique(np.concatenate(starts), return_counts=True)
    return first[n >= least]


def piece_matches(index: dict, piece: dict, at: dict[int, np.ndarray], hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words of a piece's matches, and how much of its weight agrees in each."""
    first, size = proposed_starts(piece, at, index["rare"], index["meet"]), len(piece["words"])
    if not len(first):
        return first, np.empty(0)
    # words beyond either end of the file agree with nothing
    place = first[:, None] + np.arange(size)
    same = (place >= 0) & (place < len(hashed)) & (hashed[np.clip(place, 0, len(hashed) - 1)] == piece["words"])
    score = np.where(same.all(axis=1), 1.0, np.minimum(1.0, same @ piece["weights"]))
    good = (score >= index["share"]) & same[:, piece["need"]].all(axis=1)
    return first[good], score[good]


def scan_words(index: dict, hashed: np.ndarray) -> list[dict]:
    """All matches in a file, given the hashes of its words."""
    places, which = _licence_words(hashed, index["values"], index["order"])
    absent = np.ones(len(VOCABULARY), np.float32)
    absent[which] = 0
    possible = index["must"] @ absent == 0
    if not possible.any():
        return []
    by_word = np.argsort(which, kind="stable")
    distinct, begins = np.unique(which[by_word], return_index=True)
    at = dict(zip(distinct.tolist(), np.split(places[by_word], begins[1:])))
    found = []
    for label, base, own in index["templates"]:
        if not possible[own].all():
            continue
        begin = end = score = None
        for i in own:
            piece = index["pieces"][i]
            first, agreed = piece_matches(index, piece, at, hashed)
            weight = len(piece["words"])
            if begin is None:
                begin, end, score, total = first, first + weight, agreed * weight, weight
            elif len(first):
                # the last match of the pieces so far that ends before this one begins
                nearest = np.searchsorted(end, first, side="right") - 1
                near = (nearest >= 0) & (first - end[np.maximum(nearest, 0)] <= index["gap"])
                nearest, first = nearest[near], first[near]
                begin, end, score, total = begin[nearest], first + weight, score[nearest] + agreed[near] * weight, total + weight
            else:
                begin = first
            if not len(begin):
                break
        for b, e, x in zip(begin.tolist(), end.tolist(), score.tolist()) if len(begin) else ():
            b, e = max(0, b), min(e, len(hashed))
            found.append({"label": label, "base": base, "first_word": b, "n_words": e - b, "share": min(1.0, x / total)})
    return sorted(found, key=lambda m: (m["first_word"], m["label"], m["base"], m["n_words"]))


def _scanner(index: Broadcast):
    def scan(texts: pa.Array) -> pa.Array:
        out = []
        for text in words.texts(texts):
            hashed = words.hashes(text, words.PLAIN)
            out.append({"n_words": len(hashed), "matches": scan_words(index.value, hashed)})
        return pa.array(out, SCAN)

    return F.arrow_udf(scan, f"struct<{_SCAN}>").asNondeterministic()


def scan(docs: DataFrame, share: float = 0.7, rare: int = 3, meet: int = 2, gap: int = 60) -> DataFrame:
    """All columns of ``docs`` and ``licences``: the number of words and the matches (label, span in words, share that agrees)."""
    index = docs.sparkSession.sparkContext.broadcast(build_index(*document_frequencies(docs), rare, meet, share, gap))
    return docs.withColumn("licences", _scanner(index)(F.col("text").cast("string")))


def digest(scanned: DataFrame) -> DataFrame:
    """One line of numbers and labels per document."""
    base = F.filter("licences.matches", lambda m: m["base"])
    first = F.transform(base, lambda m: m["first_word"])
    joined = lambda ms: F.array_join(F.array_sort(F.array_distinct(F.transform(ms, lambda m: m["label"]))), ",")
    best: Column = F.array_max(F.transform("licences.matches", lambda m: m["share"]))
    return scanned.select(
        "doc_id", F.col("licences.n_words").alias("n_words"), F.size(base).cast("long").alias("n_base"),
        F.array_min(first).alias("first_word"), F.array_max(first).alias("last_word"), joined(base).alias("base_labels"),
        joined(F.col("licences.matches")).alias("labels"), F.coalesce(best, F.lit(0.0)).alias("score"),
    )
