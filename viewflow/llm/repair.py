"""Conversations brought into the form `(s?(ua)+)?` of role initials by their cheapest edits.

Rows in order are walked through four states: nothing yet, after the system's turn, after a user's, after an
assistant's. The cost of the rest of a conversation from each state is a vector, computed backward. Only the vectors at
checkpoints, every square root of the rows, are stored; a block between two is computed anew while walking forward,
where of all tight edits (those that keep the least cost) the ASCII-least is taken.

The same is done over the cluster. Rows are sorted by conversation and order into parts of bounded size, so that a long
conversation lies in several parts. Each part gives the matrix of costs from state to state of a conversation that
goes on beyond it; the matrices, one row a part, give the vectors at the parts' ends, and with them the states that the
parts begin in. Then all parts are walked at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewflow.llm.common import stored

#: Bytes of text of a part.
PART_BYTES = 32 << 20
#: Costs; no way is so dear.
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
NEVER = 1 << 60
#: The state after the next turn that the form asks for, that turn's role, and the cost of ending in a state.
_NEXT = (2, 2, 3, 2)
_ROLE = ("user", "user", "assistant", "user")
_END = (0, 2 * INSERT, INSERT, 0)
#: The state after keeping a row, by state and initial.
_KEEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: Adjacent initials that the form has.
_LEGAL = {"su", "ua", "au"}
_BLANK, _DUPLICATE, _TRUNCATED = "blank", "duplicate", "truncated"

#: What a row comes to: its role's initial, whether it must go, and what it costs more if it stays.
Row = tuple[str, bool, int]
Vector = tuple[int, int, int, int]


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of the rows that the checksum of `conv_id:turn` leaves, damaged by it.

    Nulls of roles and texts, and of ids and turns within the checksum, are one space.
    """
    key = F.concat_ws(":", *[F.coalesce(conversations[c].cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = conversations.select(
        conversations["conv_id"].alias("conv_id"),
        conversations["turn"].alias("turn"),
        F.coalesce(conversations["role"].cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(conversations["text"].cast("string"), F.lit(" ")).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("kind"),
    ).filter("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def _ordered(rows: DataFrame) -> DataFrame:
    """The rows with `at`, a number in order of conversation, turn (nulls first), role and the text's SHA-256, and `part`.

    Rows alike in all of them are told apart by their place in the input, so that they spread over parts.
    """
    session = rows.sparkSession
    size = rows.select(F.sum(F.octet_length("text") + 32)).first()[0] or 0
    n = max(int(session.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    keyed = rows.withColumns({"digest": F.sha2(F.col("text").cast("binary"), 256), "copy": F.monotonically_increasing_id()})
    order = ["conv_id", "turn", "role", "digest", "copy"]
    placed = keyed.repartitionByRange(n, *order).sortWithinPartitions(*order).drop("copy").withColumn("at", F.monotonically_increasing_id())
    return stored(placed.withColumn("part", F.shiftright("at", 33)))


def _faults(rows: DataFrame) -> DataFrame:
    """conv_id, part, at, initial and the first fault (null: none) of the ordered rows; narrow, stored."""
    first = rows.groupBy("conv_id", "role", "digest").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    truncated = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    own = rows.select("conv_id", "part", "at", F.substring("role", 1, 1).alias("initial"), blank.alias("blank"), truncated.alias("cut"))
    fault = F.when(F.col("blank"), _BLANK).when(F.col("first").isNull(), _DUPLICATE).when(F.col("cut"), _TRUNCATED)
    return stored(own.join(first, "at", "left").select("conv_id", "part", "at", "initial", fault.alias("fault")))


def _back(row: Row, after: Vector) -> Vector:
    """The costs before a row from those after it: the row is edited, behind up to two inserted turns."""
    initial, must_go, more = row
    own = []
    for state in range(4):
        cost = after[state] + DELETE
        if not must_go:
            cost = min(cost, after[_NEXT[state]] + REROLE + more)
            kept = _KEEP[state].get(initial)
            if kept is not None:
                cost = min(cost, after[kept] + more)
        own.append(cost)
    return tuple(min(own[s], own[_NEXT[s]] + INSERT, own[_NEXT[_NEXT[s]]] + 2 * INSERT) for s in range(4))


def costs(rows: list[Row], after: Vector) -> Vector:
    """The costs before all of the rows."""
    for row in reversed(rows):
        after = _back(row, after)
    return after


def walk(rows: list[Row], state: int, after: Vector = _END, last: bool = True) -> tuple[str, int]:
    """The initials of the cheapest, of those the ASCII-least, edits from a state, and the state they end in.

    `after` are the costs behind the rows. Turns missing at the end are inserted behind the last rows of a conversation.
    """
    block = max(isqrt(len(rows)), 1)
    # Backward once, with vectors kept only where blocks end.
    ends, vector = {}, after
    for start in range((len(rows) - 1) // block * block, -1, -block) if rows else ():
        ends[start] = vector
        vector = costs(rows[start : start + block], vector)
    out = []
    for start in range(0, len(rows), block):
        own = rows[start : start + block]
        vectors = [ends.pop(start)]
        for row in reversed(own):
            vectors.append(_back(row, vectors[-1]))
        vectors.reverse()
        for (initial, must_go, more), now, then in zip(own, vectors, vectors[1:]):
            while True:
                cost, next_ = now[state], _NEXT[state]
                kept = None if must_go else _KEEP[state].get(initial)
                if then[state] + DELETE == cost:
                    out.append("D")
                    break
                if now[next_] + INSERT == cost:
                    out.append("I")
                    state = next_
                    continue
                if kept is not None and then[kept] + more == cost:
                    out.append("K")
                    state = kept
                    break
                out.append("R")
                state = next_
                break
    if last:
        while _END[state]:
            out.append("I")
            state = _NEXT[state]
    return "".join(out), state


def _runs(table: pa.Table) -> Iterator[tuple[object, list[dict]]]:
    """The conversations of a part in order, with their rows."""
    own: list[dict] = []
    for row in table.sort_by("at").to_pylist():
        if own and own[0]["conv_id"] != row["conv_id"]:
            yield own[0]["conv_id"], own
            own = []
        own.append(row)
    if own:
        yield own[0]["conv_id"], own


def _steps(rows: list[dict]) -> list[Row]:
    return [(r["initial"], r["fault"] in (_BLANK, _DUPLICATE), TRUNCATED if r["fault"] == _TRUNCATED else 0) for r in rows]


def _made(rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(rows, schema)


def _crossing(faults: DataFrame, kind: str) -> DataFrame:
    """For each part of a conversation that lies in several: the costs behind it, the state it begins in, the initial
    before it, and whether it is the last. At most two rows a part."""
    key = pa.schema([faults.select("conv_id").limit(0).toArrow().schema.field(0)])
    matrix = key.append(pa.field("part", pa.int64())).append(pa.field("costs", pa.list_(pa.int64())))
    matrix = matrix.append(pa.field("first", pa.string())).append(pa.field("final", pa.string()))

    def matrices(table: pa.Table) -> pa.Table:
        runs = list(_runs(table))
        out = []
        for conv, rows in runs[:1] + runs[1:][-1:]:
            units = [tuple(0 if s == t else NEVER for s in range(4)) for t in range(4)]
            columns = [costs(_steps(rows), unit) for unit in units]
            flat = [min(columns[t][s], NEVER) for s in range(4) for t in range(4)]
            out.append({"conv_id": conv, "part": rows[0]["part"], "costs": flat, "first": rows[0]["initial"], "final": rows[-1]["initial"]})
        return _made(out, matrix)

    behind = key.append(pa.field("part", pa.int64())).append(pa.field("after", pa.list_(pa.int64())))
    behind = behind.append(pa.field("before", pa.string())).append(pa.field("last", pa.bool_()))

    def vectors(table: pa.Table) -> pa.Table:
        rows = table.sort_by("part").to_pylist()
        out, vector = [], _END
        for i in range(len(rows) - 1, -1, -1) if len(rows) > 1 else ():
            out.append(
                {"conv_id": rows[i]["conv_id"], "part": rows[i]["part"], "after": vector, "before": rows[i - 1]["final"] if i else None, "last": i == len(rows) - 1}
            )
            flat = rows[i]["costs"]
            vector = tuple(min(flat[4 * s + t] + vector[t] for t in range(4)) for s in range(4))
        return _made(out, behind)

    reached = behind.append(pa.field("to", pa.list_(pa.int64())))

    def maps(left: pa.Table, right: pa.Table) -> pa.Table:
        known = {row["conv_id"]: row for row in right.to_pylist()}
        out = []
        for conv, rows in _runs(left) if known else ():
            if row := known.get(conv):
                steps = _steps(rows)
                out.append({**row, "to": [walk(steps, state, tuple(row["after"]), False)[1] for state in range(4)]})
        return _made(out, reached)

    entered = behind.append(pa.field("state", pa.int64()))

    def states(table: pa.Table) -> pa.Table:
        out, state = [], 0
        for row in table.sort_by("part").to_pylist():
            to = row.pop("to")
            out.append({**row, "state": state})
            state = to[state]
        return _made(out, entered)

    parts = f"conv_id {kind}, part long"
    ends = faults.groupBy("part").applyInArrow(matrices, f"{parts}, costs array<long>, first string, final string")
    more = f"{parts}, after array<long>, before string, last boolean"
    checkpoints = stored(ends.groupBy("conv_id").applyInArrow(vectors, more))
    mapped = faults.groupBy("part").cogroup(checkpoints.groupBy("part")).applyInArrow(maps, f"{more}, to array<long>")
    return stored(mapped.groupBy("conv_id").applyInArrow(states, f"{more}, state long"))


def repair(rows: DataFrame) -> DataFrame:
    """The conversations of rows with conv_id, turn, role and text, one row for each part of each conversation.

    conv_id, part (in order), whether it is the `first` and the `last` of its conversation, the numbers of `blank`,
    `duplicate`, `truncated` and `illegal` (pairs), the cost, `audit` (the edits' initials) and `repaired`, an array of
    role and text. A row's first fault counts. Null ids are one conversation. Rows of one turn stand in order of role
    and of the text's SHA-256. A part has about `PART_BYTES` of text, or one longer text.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    ordered = _ordered(rows.select("conv_id", "turn", "role", "text"))
    faults = _faults(ordered)
    crossing = _crossing(faults, kind)
    of_turn = pa.struct([("role", pa.string()), ("text", pa.string())])
    fields = [("part", pa.int64()), ("first", pa.bool_()), ("last", pa.bool_())]
    fields += [(name, pa.int64()) for name in _NUMBERS] + [("audit", pa.string()), ("repaired", pa.list_(of_turn))]
    schema = pa.schema([faults.select("conv_id").limit(0).toArrow().schema.field(0), *(pa.field(*f) for f in fields)])

    def walked(left: pa.Table, right: pa.Table) -> pa.Table:
        known = {row["conv_id"]: row for row in right.to_pylist() if row["role"] is None}
        texts = right.filter(pa.compute.is_valid(right["role"])).sort_by("at")
        roles, said, at = texts["role"], texts["text"], 0
        out = []
        for conv, own in _runs(left):
            steps = _steps(own)
            begun = known.get(conv) or {"after": _END, "before": None, "last": True, "state": 0}
            state = begun["state"]
            audit, end = walk(steps, state, tuple(begun["after"]), begun["last"])
            found, cost, row = [], 0, at
            for edit in audit:
                if edit == "D":
                    cost += DELETE
                elif edit == "I":
                    found.append({"role": _ROLE[state], "text": ""})
                    cost, state = cost + INSERT, _NEXT[state]
                else:
                    role, text = roles[row].as_py() if edit == "K" else _ROLE[state], said[row].as_py()
                    found.append({"role": role, "text": text})
                    cost += steps[row - at][2] + (REROLE if edit == "R" else 0)
                    state = _KEEP[state][role[:1]]
                row += edit != "I"
            initials = ([begun["before"]] if begun["before"] is not None else []) + [s[0] for s in steps]
            faulty = [r["fault"] for r in own]
            numbers = [faulty.count(f) for f in (_BLANK, _DUPLICATE, _TRUNCATED)]
            numbers += [sum(x + y not in _LEGAL for x, y in zip(initials, initials[1:])), cost]
            values = [conv, own[0]["part"], begun["before"] is None, begun["last"], *numbers, audit, found]
            out.append(dict(zip(schema.names, values)))
            at += len(own)
        return _made(out, schema)

    texts = ordered.select("part", "at", "role", "text")
    both = texts.unionByName(crossing, allowMissingColumns=True)
    numbers = ", ".join(f"{name} long" for name in _NUMBERS)
    out = f"conv_id {kind}, part long, first boolean, last boolean, {numbers}, audit string, repaired array<struct<role:string,text:string>>"
    return faults.groupBy("part").cogroup(both.groupBy("part")).applyInArrow(walked, out)


_NUMBERS = ("blank", "duplicate", "truncated", "illegal", "cost")


def digests(repaired: DataFrame) -> DataFrame:
    """One row per conversation of `repair`: its id, numbers, audit, and `repaired_sha256` of `role:text` joined by newlines.

    A conversation in one part is hashed where it is. One in several has one row a part, hashed in order by one task
    that holds a row at a time: a hash of the whole can't be parted.
    """
    lines = F.array_join(F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    rows = stored(repaired.withColumn("lines", lines).withColumn("some", F.size("repaired") > 0).drop("repaired"))
    numbers = ", ".join(f"{name} long" for name in _NUMBERS)
    kind = rows.schema["conv_id"].dataType.simpleString()
    alone = rows.filter(F.col("first") & F.col("last")).select("conv_id", *_NUMBERS, "audit", F.sha2(F.col("lines").cast("binary"), 256).alias("repaired_sha256"))
    names = ["conv_id", *_NUMBERS, "audit", "repaired_sha256"]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, audits, hash_, begun = [0] * len(_NUMBERS), [], hashlib.sha256(), False
        for batch in batches:
            types = [batch.schema.field(n).type for n in ("conv_id", *_NUMBERS, "audit")] + [pa.string()]
            for i in range(len(batch)):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                if row["first"]:
                    total, audits, hash_, begun = [0] * len(_NUMBERS), [], hashlib.sha256(), False
                if row["some"]:
                    hash_.update((b"\n" if begun else b"") + row["lines"].encode())
                    begun = True
                audits.append(row["audit"])
                total = [t + row[n] for t, n in zip(total, _NUMBERS)]
                if row["last"]:
                    values = [row["conv_id"], *total, "".join(audits), hash_.hexdigest()]
                    yield pa.record_batch([pa.array([v], t) for v, t in zip(values, types)], names=names)

    several = rows.filter(~(F.col("first") & F.col("last"))).repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return alone.unionByName(several.mapInArrow(hashed, f"conv_id {kind}, {numbers}, audit string, repaired_sha256 string"))


def gaps(rows: DataFrame) -> DataFrame:
    """conv_id and `gaps`: the turns missing between the least and the greatest one. Null turns aren't counted."""
    own = rows.filter("turn IS NOT NULL").groupBy("conv_id").agg(F.max("turn").alias("top"), F.min("turn").alias("low"), F.countDistinct("turn").alias("n"))
    return own.select("conv_id", (F.col("top") - F.col("low") + 1 - F.col("n")).alias("gaps"))


def repaired_conversations(conversations: DataFrame) -> DataFrame:
    """One row per conv_id, null included: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    A conversation without rows after damage has zeros, an empty audit and the hash of an empty text.
    """
    rows = damaged(conversations)
    ids = conversations.select(conversations["conv_id"].alias("id")).distinct()
    found = digests(repair(rows))
    missing = gaps(rows)

    def with_(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.join(right.withColumnRenamed("conv_id", "of"), F.col("id").eqNullSafe(F.col("of")), "left").drop("of")

    both = with_(with_(ids, found), missing)
    zero = [F.coalesce(F.col(name).cast("long"), F.lit(0).cast("long")).alias(name) for name in ("gaps", *_NUMBERS)]
    empty: Column = F.lit(hashlib.sha256().hexdigest())
    return both.select(F.col("id").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))
