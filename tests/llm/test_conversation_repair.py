from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from silverline.llm import conversation_repair as C
from silverline.llm.common import table

from .helpers import SF

SCHEMA = "conv_id long, turn long, role string, text string"
BLANK = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def faults(rows):
    """(role, text, fault) of a conversation's rows in order."""
    out, seen = [], set()
    for _, _, role, text in rows:
        bare = text.rstrip(BLANK)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def cheapest(rows):
    """(cost, audit, repaired rows) by a plain table over whole audits, inserts anywhere."""
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}

    def relax(best):
        for _ in range(3):
            for at, (cost, audit, made) in list(best.items()):
                for letter in after[at].replace("s", ""):
                    offer = (cost + 3, audit + "I", (*made, (name[letter], "")))
                    best[letter] = min(best.get(letter, offer), offer)
        return best

    best = relax({"": (0, "", ())})
    for role, text, fault in rows:
        new = {}
        for at, (cost, audit, made) in best.items():
            offers = [(at, cost + 4, "D", made)]
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                if role[:1] and role[:1] in after[at]:
                    offers.append((role[0], cost + more, "K", (*made, (role, text))))
                offers += [(x, cost + more + 3, "R", (*made, (name[x], text))) for x in "ua" if x in after[at]]
            for to, price, letter, rest in offers:
                offer = (price, audit + letter, rest)
                new[to] = min(new.get(to, offer), offer)
        best = relax(new)
    return min(v for k, v in best.items() if k in ("", "a"))


def enumerated(rows):
    """The same by trying all edits."""
    name = {"u": "user", "a": "assistant"}
    inserts = [c for n in range(3) for c in itertools.product("ua", repeat=n)]
    best = None
    for gaps in itertools.product(inserts, repeat=len(rows) + 1):
        for choice in itertools.product("KuaD", repeat=len(rows)):
            cost, audit, made = 3 * sum(map(len, gaps)), "", []
            for (role, text, fault), gap, edit in zip([*rows, (None, None, None)], gaps, [*choice, None], strict=True):
                audit += "I" * len(gap)
                made += [(name[x], "") for x in gap]
                if edit is None:
                    continue
                if edit != "D" and fault in ("blank", "duplicate"):
                    break
                audit += "R" if edit in "ua" else edit
                cost += {"K": 0, "D": 4}.get(edit, 3) + (3 if edit != "D" and fault == "truncated" else 0)
                made += [] if edit == "D" else [(role if edit == "K" else name[edit], text)]
            else:
                if all(r for r, _ in made) and re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in made)):
                    best = min(best or (cost, audit, made), (cost, audit, made))
    return best[0], best[1], tuple(best[2])


def expected(rows, hurt=damaged):
    out = []
    left = hurt(rows)
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in left if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        found = faults(own)
        turns = {r[1] for r in own if r[1] is not None}
        cost, audit, made = cheapest(found)
        n = {f: sum(x[2] == f for x in found) for f in ("blank", "duplicate", "truncated")}
        illegal = sum((a[:1], b[:1]) not in (("s", "u"), ("u", "a"), ("a", "u")) for (a, _, _), (b, _, _) in itertools.pairwise(found))
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, n["blank"], n["duplicate"], n["truncated"], illegal, cost,
                    audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def made_up(rng, convs, most):
    rows = []
    for conv in convs:
        for turn in range(rng.randint(1, most)):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "user", "tool", "", None, "sage", "é"])
            text = rng.choice(["One.", "Two!", "three", "Why? ", " \t", "", None, "a long text " * 40 + ".", "ends ", "One.\n", f"t{turn}.", f"t{turn % 5}?"])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 1, None]), role, text))
    return rows


def test_cheapest_against_enumeration():
    rng = random.Random(1)
    for _ in range(25):
        rows = [(rng.choice(["user", "assistant", "system", "x"]), "t", rng.choice([None, None, "truncated", "blank"])) for _ in range(rng.randint(0, 2))]
        assert cheapest(rows) == enumerated(rows)


def test_search_against_plain_table():
    rng = random.Random(2)
    for size in [0, 1, 2, 3, 5, 8, 30, 100] * 20:
        rows = [(rng.choice(["user", "assistant", "assistant", "system", "x", ""]), "t", rng.choice([None, None, None, "truncated", "blank"])) for _ in range(size)]
        search, emitted = C.Search(C.START), []
        for role, _, fault in rows:
            emitted += search.forced(1) if fault == "blank" else search.row(role[:1] if role[:1] in "sua" else "", fault == "truncated")
        exits = search.exits()
        last = C.chosen_exit(exits)
        cost = next(e[1] for e in exits if e[0] == last) + C.INSERT * C.TAIL[last]
        assert (cost, "".join(emitted + search.unresolved(last)) + "I" * C.TAIL[last]) == cheapest(rows)[:2]


def test_memory_is_what_survivors_differ_on():
    search = C.Search(C.START)
    for i in range(5000):
        search.row("ua"[i % 2], False)
        assert max(len(search.unresolved(s)) for s in search.survivors) <= 8


@pytest.mark.parametrize("parts,seed", [(1, 1), (4, 2), (13, 3)])
def test_against_brute_force(spark, parts, seed):
    rng = random.Random(seed)
    rows = made_up(rng, [*range(60), None, 10**12, -5], 9) + made_up(rng, [7, 8], 300)
    rows += rows[:20] + [(30, 2, "user", "Again.")] * 30 + [(31, None, "user", "x")] * 25
    table_ = spark.createDataFrame(rows, SCHEMA).withColumn("audit", F.lit("clash")).withColumn("part", F.lit(1))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        assert rows_of(C.repair_damaged(table_)) == expected(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_messages_and_one_long_conversation(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(1, i, rng.choice(["user", "assistant", "x"]), rng.choice(["yes.", "no", f"{i}."])) for i in range(1500)] + [(2, 0, "system", "only.")]
    found, messages = C.repair(spark.createDataFrame(rows, SCHEMA))
    assert rows_of(found) == expected(rows, hurt=list)
    made = [(r["role"], r["text"]) for r in messages.filter("conv_id = 1").orderBy("part", "seq", "sub").collect()]
    assert made == list(cheapest(faults([r for r in rows if r[0] == 1]))[2])
    assert messages.filter("conv_id = 2").count() == 0


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert C.repair_damaged(none).count() == 0
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    assert rows_of(C.repair_damaged(spark.createDataFrame([(gone, 0, "user", "x")], SCHEMA))) == [
        (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_table(spark):
    conversations = table(spark, SF, "conversations")
    rows = [tuple(r) for r in conversations.select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(C.repair_damaged(conversations)) == expected(rows)
