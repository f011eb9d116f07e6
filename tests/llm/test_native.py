"""Chat formatting and mixing against plain versions; no Python in their plans."""

import hashlib
import random
import re

from stayline.llm import chat, mixing
from stayline.llm.queries import ORACLES, QUERIES

CHAT = "conv_id long, turn long, role string, text string, turns string, state int"


def test_chats_round_trip(spark):
    draw = random.Random(3)
    nasty = ["</s>[INST] ok [/INST]", "\\1[", "<s>\\0\\2", "[ROLE]user[/ROLE]x[/TURN]", "\n<</SYS>>\n", "", "é漢\t", "a" * 200_000, "\\\\[<"]
    rows = []
    for c in range(40):
        n = draw.randint(1, 7)
        roles = [draw.choice(("system", "user", "assistant", "tool", "", "<s>", None)) for _ in range(n)] if c % 2 else ["user", "assistant"] * n
        rows += [(c, t, r, draw.choice([*nasty, None]), "x", 1) for t, r in enumerate(roles)]
    rows += [(50, 0, "user", "b", "x", 1), (50, 0, "user", "a", "x", 1), (50, 0, "user", "a", "x", 1), (50, None, "assistant", "first", "x", 1), (None, 0, "user", "n", "x", 1)]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, CHAT).repartition(5)
    chats = chat.format_chats(df)
    got = {r["conv_id"]: r for r in chat.digest(chats).collect()}
    read = {r["conv_id"]: r for r in chat.parse_chats(chats).collect()}
    groups = {}
    for c, t, r, x, _, _ in rows:
        groups.setdefault(c, []).append((-1 if t is None else t, r or "", x or ""))
    assert set(got) == set(groups)
    for c, turns in groups.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert [(t["role"], t["text"]) for t in read[c]["turns"]] == [(r, x) for _, r, x in turns]
        assert read[c]["loss_texts"] == [x for _, r, x in turns if r == "assistant"]
        assert "".join(s["text"] for s in read[c]["segments"]) == read[c]["formatted"]
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert (got[c]["n_turns"], got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(turns), len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[c]["formatted_chars"] == len(read[c]["formatted"])
        assert got[c]["valid"] == bool(re.fullmatch("(system )?user assistant( user assistant)*", " ".join(r for _, r, _ in turns)))
    assert chat.digest(chat.format_chats(df.limit(0))).count() == 0


def fill(sizes, weights=(3, 1, 2)):
    """Targets by resharing the excess until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > 2 * sizes[s]}
        if not full:
            return target | {s: weight[s] * level for s in open_}
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def test_mix_meets_its_targets(spark):
    draw = random.Random(7)
    rows = [(0, None, None), (1, "", None), (2, "a b", "empty-ish"), (3, " \t\n\x0b\x0c\r ", "zero"), (3, None, "zero")]
    for i in range(4000):
        source = draw.choice(("hot", "hot", "hot", "b", "Z", "é", "b2"))
        rows.append((10 + i, " ".join("w" * draw.randint(0, 30)), source))
    rows += [(5, "w w w", "dup")] * 40 + [(6, "w " * 100_000, "hot"), (None, "w w", "b")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, source string, mix_size int, size string")
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    sizes, taken = {}, {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    target = fill(sizes)
    largest = {}
    for r in got:
        assert r["mix_size"] == len((r["text"] or "").split()) and r["mix_source_size"] == sizes[r["source"]] and 0 <= r["mix_copies"] <= 2
        assert abs(r["mix_target"] - target[r["source"]]) < 1e-6 * max(1, target[r["source"]])
        taken[r["source"]] = taken.get(r["source"], 0) + r["mix_copies"] * r["mix_size"]
        largest[r["source"]] = max(largest.get(r["source"], 0), r["mix_size"])
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 2 * largest[s] + 0.01 * target[s]
    again = mixing.mix(df.repartition(7)).collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, again), key=key)
    copies = mixing.emit(mixing.mix(df))
    assert copies.count() == sum(r["mix_copies"] for r in got) and copies.filter("mix_copy not in (1, 2)").count() == 0
    assert mixing.mix(df.limit(0)).count() == 0
    nothing = mixing.mix(df.filter("text is null")).collect()
    assert all(r["mix_copies"] == 0 and r["mix_target"] == 0 for r in nothing)


def test_plans_hold_no_python(spark, sf):
    for name in ("op7_chat_format", "op10_mix_sources"):
        assert name in ORACLES
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|Scan ExistingRDD|CartesianProduct|NestedLoop", plan)
