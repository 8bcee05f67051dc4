"""Conversation structure repair by depth-first branch-and-bound.

Rows are reduced to one code each: the first letter of the role and the row's first fault. A
conversation's codes are searched with an explicit stack. A node is (row, last role letter);
children are tried in the order Delete, Insert, Keep, Rerole, so that paths come in the order
of their audits, and a node reached again at no lower cost is dominated. A prefix whose cost
and the lower bound of the rows behind it cannot beat the incumbent (cost, audit) is cut; a
greedy repair is the first incumbent. A node is entered anew only at a strictly lower cost, so
a search takes at most rows x costs steps, whatever the rows.

The bound of a suffix charges every row its own cheapest edit, and two neighbours that cannot
stand beside each other, taken disjointly, their cheapest common remedy.

Texts move once: codes are made from a narrow projection, and each conversation's audit meets
its rows in one sort, as a row in front of them, which a task streams through. The search holds
about a hundred bytes a row of one conversation, never its texts. A hash is one stream by
nature, so the rows of one conversation pass through one task.

Defined cases: a null in conv_id, turn, role or text is one space to the damage, the roles and
the texts, while rows of null id are one conversation of id null and rows of null turn come
first; rows of one turn stand by role, then by the first 64 characters of their text, then by
its hash; an empty role or one of another letter can only be rerolled or deleted; repeated rows
are duplicates; very long texts are hashed as they pass; an empty table gives an empty result;
other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
WHITE = " \t\n\x0b\x0c\r"
ROLES = {"s": "system", "u": "user", "a": "assistant"}
#: Letters that may stand side by side, "" being the start; what an inserted or rerolled row is.
FOLLOWS = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
#: First faults of a row; dropped rows only tell that their conversation exists.
CLEAN, BLANK, DUPLICATE, CUT, DROPPED = range(5)
LETTERS, OTHER = "sua", "?"

Row = tuple[str, int]  # role letter, fault


# The search


def lower_bounds(rows: list[Row]) -> list[int]:
    """For each row and the end: a cost that no repair of the rows from there on undercuts."""
    bounds = [0] * (len(rows) + 1)
    ahead = None  # the nearest row behind this one that may stay
    for i in range(len(rows) - 1, -1, -1):
        letter, fault = rows[i]
        if fault in (BLANK, DUPLICATE):
            bounds[i] = bounds[i + 1] + DELETE
            continue
        cut = TRUNCATED * (fault == CUT)
        bounds[i] = bounds[i + 1] + min(cut + REROLE * (letter == OTHER), DELETE)
        if ahead is None:
            if letter != "a":
                bounds[i] = max(bounds[i], bounds[i + 1] + min(cut + INSERT, DELETE))
        elif (letter, rows[ahead][0]) not in FOLLOWS:
            other = TRUNCATED * (rows[ahead][1] == CUT)
            pair = min(INSERT + cut + other, DELETE + min(cut, other))
            due = DELETE * (ahead - i - 1)  # all rows between the two have to go
            bounds[i] = max(bounds[i], pair + due + bounds[ahead + 1])
        ahead = i
    return bounds


def greedy(rows: list[Row]) -> tuple[int, str]:
    """Some repair: rows that fit stay, all others go, a missing last reply is inserted."""
    cost, audit, last = 0, [], ""
    for letter, fault in rows:
        stays = fault in (CLEAN, CUT) and (last, letter) in FOLLOWS
        cost += TRUNCATED * (fault == CUT) if stays else DELETE
        audit.append("K" if stays else "D")
        last = letter if stays else last
    while last not in ("", "a"):
        last = NEXT[last]
        cost += INSERT
        audit.append("I")
    return cost, "".join(audit)


def best_repair(rows: list[Row]) -> tuple[int, str]:
    """The least (cost, audit) of all repairs."""
    bounds, n = lower_bounds(rows), len(rows)
    best = greedy(rows)
    room = best[0] + 1  # paths have to stay below it; the greedy repair may lose a tie
    dominance = {last: [room] * (n + 1) for last in NEXT}  # cheapest arrival per node
    path: list[str] = []
    stack = [(0, "", 0, 0, "")]  # row, last letter, cost, depth, edit
    while stack:
        i, last, cost, depth, edit = stack.pop()
        if cost + bounds[i] >= room or dominance[last][i] <= cost:
            continue
        dominance[last][i] = cost
        if edit:
            path[depth - 1 :] = edit
        if i == n and last in ("", "a"):
            best, room = (cost, "".join(path[:depth])), cost
            continue
        depth += 1
        insert = (i, NEXT[last], cost + INSERT, depth, "I")
        if i == n:
            stack.append(insert)
            continue
        # The stack is taken from its end, so the last letter goes on it first.
        letter, fault = rows[i]
        if fault in (CLEAN, CUT):
            kept = cost + TRUNCATED * (fault == CUT)
            stack.append((i + 1, NEXT[last], kept + REROLE, depth, "R"))
            if (last, letter) in FOLLOWS:
                stack.append((i + 1, letter, kept, depth, "K"))
        stack.append(insert)
        stack.append((i + 1, last, cost + DELETE, depth, "D"))
    return best


# Codes


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, dropped: the rows after damage by crc32 of ``conv_id:turn``."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.pmod(F.crc32(key.cast("binary")), F.lit(20)).cast("int")
    # Equal copies are made of narrow marks, before the text is touched.
    marks = F.when(kind == 3, F.array(kind, kind)).otherwise(F.array(kind))
    given = whole(rows).drop("dropped").withColumn("kind", F.explode(marks))
    cut = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", ""))
    return given.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        cut.otherwise(F.col("text")).alias("text"),
        (F.col("kind") == 0).alias("dropped"),
    )


def whole(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, dropped: the rows as they are, nulls as one space."""
    texts = [F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")]
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), *texts, F.lit(False).alias("dropped"))


ORDER = ["turn", "role", "head", "print"]


def _placed(rows: DataFrame) -> DataFrame:
    """With the columns that order rows of one turn."""
    text = F.col("text")
    return rows.withColumns({"head": F.substring(text, 1, 64), "print": F.md5(text.cast("binary"))})


def faults(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, head, print and the first fault of each row of ``damaged`` or ``whole``."""
    trimmed = F.rtrim(F.col("text"), F.lit(WHITE))
    ended = F.substring(trimmed, -1, 1).isin(".", "!", "?")
    own = F.when(F.col("dropped"), DROPPED).when(trimmed == "", BLANK).when(ended, CLEAN).otherwise(CUT)
    slim = _placed(rows).select("conv_id", *ORDER, own.alias("fault"))
    same = ["conv_id", "role", "print", F.col("fault") == DROPPED]
    again = F.row_number().over(Window.partitionBy(*same).orderBy("turn"))
    repeated = F.col("fault").isin(CLEAN, CUT) & (F.col("again") > 1)
    fault = F.when(repeated, DUPLICATE).otherwise(F.col("fault"))
    return slim.withColumn("again", again).withColumn("fault", fault).drop("again")


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def summary_of(rows: list[Row]) -> dict:
    letters = [letter for letter, _ in rows]
    legal = FOLLOWS - {("", "s"), ("", "u")}
    cost, audit = best_repair(rows)
    found = {c: sum(f == k for _, f in rows) for c, k in zip(COUNTS[1:4], (BLANK, DUPLICATE, CUT))}
    return found | {"illegal": sum(p not in legal for p in zip(letters, letters[1:])), "cost": cost, "audit": audit}


def _batch(done: list[dict], key: pa.DataType, *texts: str) -> pa.RecordBatch:
    types = {"conv_id": key} | dict.fromkeys(COUNTS, pa.int64()) | dict.fromkeys(texts, pa.string())
    columns = [pa.array([d[c] for d in done], t) for c, t in types.items()]
    return pa.RecordBatch.from_arrays(columns, list(types))


def audits(found: DataFrame) -> DataFrame:
    """One row per conversation of ``faults``: conv_id, the counts, cost and audit."""
    letter = F.instr(F.lit(LETTERS), F.substring("role", 1, 1))
    known = F.when((F.col("role") != "") & (letter > 0), letter - 1).otherwise(3)
    coded = found.select("conv_id", *ORDER, (known * 8 + F.col("fault")).cast("int").alias("code"))
    coded = coded.repartition("conv_id").sortWithinPartitions("conv_id", *ORDER)
    pairs = [((LETTERS + OTHER)[c >> 3], c & 7) for c in range(32)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, last, n_turns = None, None, None, 0
        rows: list[Row] | None = None
        done: list[dict] = []

        def close() -> dict:
            gaps = 0 if first is None else last - first + 1 - n_turns
            return {"conv_id": now, "gaps": gaps} | summary_of(rows)

        for batch in batches:
            key = batch.column(0).type
            for one, turn, code in zip(*[c.to_pylist() for c in batch.columns]):
                if rows is None or one != now:
                    if rows is not None:
                        done.append(close())
                    now, first, last, n_turns, rows = one, None, None, 0, []
                pair = pairs[code]
                if pair[1] == DROPPED:
                    continue
                rows.append(pair)
                if turn is not None and turn != last:
                    first, last, n_turns = turn if first is None else first, turn, n_turns + 1
            if len(done) >= 10_000:
                yield _batch(done, key, "audit")
                done.clear()
        if rows is not None:
            yield _batch([*done, close()], key, "audit")

    key = found.schema["conv_id"].dataType.simpleString()
    ddl = ", ".join([f"conv_id {key}", *[f"{c} long" for c in COUNTS], "audit string"])
    return coded.select("conv_id", "turn", "code").mapInArrow(run, ddl)


# Replay


def _replay(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conversation's summary, None, None) when one begins, then (None, role, text) of its repaired rows."""
    audit, at, last = "", 0, ""

    def inserted() -> Iterator[tuple]:
        nonlocal at, last
        while audit[at : at + 1] == "I":
            at, last = at + 1, NEXT[last]
            yield None, ROLES[last], ""

    for batch in batches:
        heads = {c: batch.column(c).to_pylist() for c in ("conv_id", *COUNTS, "audit")}
        for k, (role, text) in enumerate(zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())):
            yield from inserted()  # also what is due at the end of the conversation before
            if role is None:
                audit, at, last = heads["audit"][k], 0, ""
                yield {c: v[k] for c, v in heads.items()}, None, None
                continue
            edit, at = audit[at], at + 1
            if edit == "R":
                last = NEXT[last]
                yield None, ROLES[last], text
            elif edit == "K":
                last = role[0]
                yield None, role, text
    yield from inserted()


def _with_audits(rows: DataFrame) -> DataFrame:
    """Rows that are left, each conversation's behind a row of null role that holds its summary."""
    left = _placed(rows.where(~F.col("dropped"))).withColumn("part", F.lit(1))
    heads = audits(faults(rows)).withColumn("part", F.lit(0))
    both = heads.unionByName(left.drop("dropped"), allowMissingColumns=True)
    both = both.repartition("conv_id").sortWithinPartitions("conv_id", "part", *ORDER)
    return both.select("conv_id", *COUNTS, "audit", "role", "text")


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``damaged`` or ``whole``: conv_id, counts, audit, repaired_sha256."""
    both = _with_audits(rows)
    key = both.schema["conv_id"].dataType.simpleString()
    ddl = ", ".join([f"conv_id {key}", *[f"{c} long" for c in COUNTS], "audit string, repaired_sha256 string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha, apart, kind = None, None, b"", None
        done: list[dict] = []

        def kinds() -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for batch in batches:
                kind = batch.column("conv_id").type
                yield batch

        for summary, role, text in _replay(kinds()):
            if summary is None:
                sha.update(apart + f"{role}:{text}".encode())
                apart = b"\n"
                continue
            if now is not None:
                done.append(now | {"repaired_sha256": sha.hexdigest()})
            now, sha, apart = summary, hashlib.sha256(), b""
            if len(done) >= 10_000:
                yield _batch(done, kind, "audit", "repaired_sha256")
                done.clear()
        if now is not None:
            yield _batch([*done, now | {"repaired_sha256": sha.hexdigest()}], kind, "audit", "repaired_sha256")

    return both.mapInArrow(run, ddl)


def repaired_rows(rows: DataFrame) -> DataFrame:
    """The repaired conversations themselves: conv_id, turn (from 0), role, text."""
    both = _with_audits(rows)
    key = both.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        now, turn, size, kind = None, 0, 0, None

        def batch_of() -> pa.RecordBatch:
            types = [kind, pa.int64(), pa.string(), pa.string()]
            columns = [pa.array(c, t) for c, t in zip(zip(*held), types)]
            return pa.RecordBatch.from_arrays(columns, ["conv_id", "turn", "role", "text"])

        def kinds() -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for batch in batches:
                kind = batch.column("conv_id").type
                yield batch

        for summary, role, text in _replay(kinds()):
            if summary is not None:
                now, turn = summary["conv_id"], 0
                continue
            held.append((now, turn, role, text))
            turn, size = turn + 1, size + len(text) + 64
            if size >= 4 << 20:
                yield batch_of()
                held, size = [], 0
        if held:
            yield batch_of()

    return both.mapInArrow(run, f"conv_id {key}, turn long, role string, text string")


def op11_conversation_repair(spark, sf: str) -> DataFrame:
    return repair(damaged(spark.read.parquet(f"{sf}/conversations.parquet")))
