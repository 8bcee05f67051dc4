"""Conversation repair against a plain reading of the contract and an exhaustive search."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict
from heapq import heappop, heappush

import pytest

from tallyfold.llm import registry, repair

SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, head string, dropped string, audit string, kind int"


def spoiled(rows):
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub(r"[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        yield from [(conv, turn, role, text)] * (2 if kind == 3 else 1)


def cheapest(rows):
    """Uniform-cost search over (cost, audit); rows are (initial, fault)."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, last = heappop(heap)
        if i == len(rows) and last in ("", "a"):
            return cost, audit
        if (i, last) in done:
            continue
        done.add((i, last))
        for role in "ua":
            if last + role in ("u", "su", "ua", "au"):
                heappush(heap, (cost + 3, audit + "I", i, role))
        if i == len(rows):
            continue
        initial, fault = rows[i]
        heappush(heap, (cost + 4, audit + "D", i + 1, last))
        if fault in ("blank", "duplicate"):
            continue
        more = 3 if fault == "truncated" else 0
        for role in "ua":
            if last + role in ("u", "su", "ua", "au"):
                heappush(heap, (cost + 3 + more, audit + "R", i + 1, role))
        if last + initial in ("s", "u", "su", "ua", "au") and initial:
            heappush(heap, (cost + more, audit + "K", i + 1, initial))


def read(rows, conversations):
    """{conv_id: (gaps, blank, duplicate, truncated, illegal, cost, audit, sha)} of rows as they are."""
    parts = defaultdict(list)
    for row in rows:
        parts[row[0]].append(row)
    out = {}
    for conv in conversations:
        own = parts[conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3][:64].encode(), hashlib.md5(r[3].encode()).hexdigest()))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, found = set(), []
        for _, _, role, text in own:
            bare = text.strip(SPACE)
            fault = ""
            if not bare:
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            elif bare[-1] not in ".!?":
                fault = "truncated"
            seen.add((role, text))
            found.append(fault)
        initials = [r[2][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = cheapest(list(zip(initials, found)))
        lines, i, last = [], 0, ""
        for edit in audit:
            role, text = ("", "") if edit == "I" else own[i][2:]
            i += edit != "I"
            if edit == "D":
                continue
            if edit in "RI":
                role = "assistant" if last == "u" else "user"
            last = role[:1]
            lines.append((role, text))
        assert i == len(own) and re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in lines))
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
        counts = [found.count(x) for x in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, illegal, cost, audit, sha)
    return out


def awkward(seed=5):
    rnd = random.Random(seed)
    texts = ["Yes.", "No!", "Why? ", "cut off", "", None, " \n", "x" * 5000 + ".", "é?\x0b", "a. ", "Same."]
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "usher"]
    rows = [(None, None, None, None), (None, 3, "user", "Hi."), (None, 4, "assistant", "Ho.")]
    for conv in range(300):
        clean = rnd.random() < 0.6
        for turn in range(rnd.randrange(1, 9)):
            role = "ua"[turn % 2]
            role = {"u": "user", "a": "assistant"}[role] if clean else rnd.choice(roles)
            at = rnd.choice([None, turn, turn, turn, turn + 2, -turn])
            rows.append((conv, at if not clean else turn, role, rnd.choice(texts[:3]) if clean else rnd.choice(texts)))
    rows += [(1000, t, rnd.choice(roles[:5]), rnd.choice(texts[:4]) + str(t) + ".") for t in range(700)]
    rows += [(1001, t, "user", "again.") for t in range(200)] + [(1002, t, None, None) for t in range(30)]
    rows += [(1003, t, "system", f"{t}.") for t in range(60)] + [(1004, t, "assistant", f"{t}") for t in range(60)]
    rows += [(10**12 + k, k, "user", "?") for k in range(60)]  # some lose their only row
    rnd.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def rows():
    return awkward()


@pytest.fixture(scope="module")
def table(spark, rows):
    more = [(*r, "head", "dropped", "audit", 0) for r in rows]
    return spark.createDataFrame(more, SCHEMA).repartition(5)


def collected(df):
    got = [tuple(r) for r in df.select("conv_id", *repair.COUNTS, "audit", "repaired_sha256").collect()]
    out = {r[0]: r[1:] for r in got}
    assert len(out) == len(got)
    return out


def test_whole_table(spark, tmp_path, rows, table):
    table.write.parquet(f"{tmp_path}/conversations.parquet")
    df = registry.QUERIES["op11_conversation_repair"](spark, str(tmp_path))
    want = read(spoiled(rows), {r[0] for r in rows})
    assert collected(df) == want
    assert any(w[5] == 0 and w[6] == "" for w in want.values())  # a conversation that lost all rows
    types = dict(df.dtypes)
    assert {types[c] for c in repair.COUNTS} == {"bigint"} and types["conv_id"] == "bigint"


@pytest.mark.parametrize("table_name", ["sf0.001", "sf0.01"])
def test_given_tables(spark, table_name):
    root = f"/root/testdata/{table_name}"
    given = spark.read.parquet(f"{root}/conversations.parquet")
    rows = [tuple(r) for r in given.select("conv_id", "turn", "role", "text").collect()]
    want = read(spoiled(rows), {r[0] for r in rows})
    assert collected(registry.QUERIES["op11_conversation_repair"](spark, root)) == want


def test_rows_as_they_are(spark, rows, table):
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    want = read(plain, {r[0] for r in rows})
    as_is = repair.whole(table)
    assert collected(repair.repair(as_is)) == want
    texts = defaultdict(list)
    for r in repair.repaired_rows(as_is).orderBy("conv_id", "turn").collect():
        assert r.turn == len(texts[r.conv_id])
        texts[r.conv_id].append(f"{r.role}:{r.text}")
    for conv, (*_, sha) in want.items():
        assert hashlib.sha256("\n".join(texts[conv]).encode()).hexdigest() == sha


def test_empty_table(spark, tmp_path, table):
    table.limit(0).write.parquet(f"{tmp_path}/conversations.parquet")
    assert registry.QUERIES["op11_conversation_repair"](spark, str(tmp_path)).collect() == []


NAMES = {repair.CLEAN: "", repair.BLANK: "blank", repair.DUPLICATE: "duplicate", repair.CUT: "truncated"}


def test_search_on_all_short_conversations():
    kinds = [(letter, fault) for letter in "sua?" for fault in (repair.CLEAN, repair.CUT)] + [("u", repair.BLANK)]
    for n in range(5):
        for rows in itertools.product(kinds, repeat=n):
            want = cheapest([(letter, NAMES[fault]) for letter, fault in rows])
            assert repair.best_repair(list(rows)) == want
            assert repair.lower_bounds(list(rows))[0] <= want[0] <= repair.greedy(list(rows))[0]


def test_search_on_long_conversations():
    rnd = random.Random(1)
    for n in (60, 400, 2500):
        rows = [(rnd.choice("uauauas?"), rnd.choices(list(NAMES), [8, 1, 1, 2])[0]) for _ in range(n)]
        assert repair.best_repair(rows) == cheapest([(letter, NAMES[f]) for letter, f in rows])
