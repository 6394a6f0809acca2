"""Conversations repaired by the cheapest edits, found by a bidirectional Dijkstra search over the edit lattice.

A node of the lattice is (rows read, what was said last): nothing yet, the
system, a user, an assistant.  Edits lead on: Keep a row that fits (0), Rerole
it to what must come next (2), Delete it (3, the only choice for a blank or
repeated row), Insert an empty message of what must come next (2); a truncated
row that stays adds 1.  A repaired conversation is ``(s?(ua)+)?`` by the
initials of its roles, so it ends with nothing said or with an assistant.

A forward heap starts before the first row, a reverse heap after the last.
When they have met at cost c they go on until their next costs sum to more than
c: then every cheapest path crosses, by some edge, from what the forward search
has settled to what the reverse one has.  The least edits (by their initials) to
each node and from each node are built over the edges that cost no more than
they must, and the least concatenation over all crossings is the audit.  Audits
of equal cost between the same nodes are never prefixes of one another (more
letters would be more inserts), so least parts make the least whole.

Scale: a conversation of up to ``CHUNK`` rows is repaired where its sorted rows
pass.  A longer one (it may hold a third of all rows) is never gathered: its
rows are sorted into ranges, repeated rows are found by aggregation, chunks are
solved from each to each state, a fold over the chunks' costs and audits picks
the states between them, and chunks are then repaired each for itself.  Only
the digest of its text has to pass one task, as a stream.  Both ways give the
same result.

Defined results: rows are taken by turn, then role, then text, nulls first.  A
null text is blank; null roles and texts equal one another when repeated rows
are sought; a role counts by its first letter, a null or empty role has none
and can't be kept.  Rows without ``conv_id`` are one conversation.  Other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from heapq import heappop, heappush
from itertools import pairwise

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswh.llm.tables import written

#: Rows of a conversation that are repaired at once.
CHUNK = 512
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
SPACE = " \t\n\x0b\x0c\r"
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)  # what must come after each state
BEFORE = {USER: (NOTHING, SYSTEM, ASSISTANT), ASSISTANT: (USER,)}
NAMES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
COUNTS = ("blank", "duplicate", "truncated", "illegal")
MESSAGES = "array<struct<role:string,text:string>>"


def initial(role: str | None) -> str:
    return (role or "")[:1]


def faults(roles: list, texts: list, repeated: list | None = None) -> list[str]:
    """The first fault of each row (b, d, t or none); ``repeated`` says which rows were seen earlier, if they are known."""
    out, seen = [], set()
    for i, row in enumerate(zip(roles, texts)):  # noqa: B905
        bare = (row[1] or "").rstrip(SPACE)
        again = repeated[i] if repeated is not None else row in seen
        out.append("b" if not bare else "d" if again else "t" if bare[-1] not in ".!?" else "")
        seen.add(row)
    return out


def _after(i: int, s: int, letters: list[str], bad: list[str]) -> Iterator[tuple[int, int, int, str]]:
    """(rows read, state, cost, letter) of the edits at a node."""
    to = NEXT[s]
    yield i, to, INSERT, "I"
    if i < len(letters):
        yield i + 1, s, DELETE, "D"
        if bad[i] not in ("b", "d"):
            cut = CUT * (bad[i] == "t")
            yield i + 1, to, REROLE + cut, "R"
            if letters[i] == "s" and s == NOTHING:
                yield i + 1, SYSTEM, KEEP + cut, "K"
            elif letters[i] == "ua"[to - USER]:
                yield i + 1, to, KEEP + cut, "K"


def _before(i: int, s: int, letters: list[str], bad: list[str]) -> Iterator[tuple[int, int, int, str]]:
    """(rows read, state, cost, letter) of the edits that lead to a node."""
    for p in BEFORE.get(s, ()):
        yield i, p, INSERT, "I"
    if i:
        yield i - 1, s, DELETE, "D"
        if bad[i - 1] not in ("b", "d"):
            cut = CUT * (bad[i - 1] == "t")
            if s == SYSTEM and letters[i - 1] == "s":
                yield i - 1, NOTHING, KEEP + cut, "K"
            for p in BEFORE.get(s, ()):
                yield i - 1, p, REROLE + cut, "R"
                if letters[i - 1] == "ua"[s - USER]:
                    yield i - 1, p, KEEP + cut, "K"


def cheapest(letters: list[str], bad: list[str], start: int = NOTHING, ends: tuple = (NOTHING, ASSISTANT)) -> tuple[int, str] | None:
    """Cost and audit of the cheapest edits from one state to one of the others, the least audit of them."""
    n = len(letters)
    heaps: tuple[list, list] = ([], [])
    known = ({(0, start): 0}, {(n, e): 0 for e in ends})
    settled: tuple[dict, dict] = ({}, {})
    steps = (_after, _before)
    met = float("inf")

    def settle(way: int, cost: int, i: int, s: int) -> None:
        nonlocal met
        settled[way][i, s] = cost
        met = min(met, cost + known[1 - way].get((i, s), met))
        for j, t, more, _ in steps[way](i, s, letters, bad):
            if cost + more < known[way].get((j, t), cost + more + 1):
                known[way][j, t] = cost + more
                heappush(heaps[way], (cost + more, j, t))

    settle(0, 0, 0, start)
    for e in ends:
        settle(1, 0, n, e)
    while heaps[0] and heaps[1] and heaps[0][0][0] + heaps[1][0][0] <= met:
        way = int((heaps[1][0][0], len(settled[1])) < (heaps[0][0][0], len(settled[0])))
        cost, i, s = heappop(heaps[way])
        if (i, s) not in settled[way]:
            settle(way, cost, i, s)
    if met == float("inf"):
        return None
    # the least edits to (from) each settled node, over edges that cost no more than they must; only keeping is free,
    # and it goes on by a row
    to = {(0, start): ""}
    for cost, i, s in sorted((c, i, s) for (i, s), c in settled[0].items()):
        for j, t, more, letter in _after(i, s, letters, bad):
            if settled[0].get((j, t)) == cost + more:
                audit = to[i, s] + letter
                to[j, t] = min(to.get((j, t), audit), audit)
    on = {(n, e): "" for e in ends}
    for cost, i, s in sorted((c, -i, s) for (i, s), c in settled[1].items()):
        for j, t, more, letter in _before(-i, s, letters, bad):
            if settled[1].get((j, t)) == cost + more:
                audit = letter + on[-i, s]
                on[j, t] = min(on.get((j, t), audit), audit)
    best = None
    for (i, s), cost in settled[0].items():
        crossings = [(to[i, s] + on[i, s])] if cost + settled[1].get((i, s), met + 1) == met else []
        crossings += [to[i, s] + letter + on[j, t] for j, t, more, letter in _after(i, s, letters, bad) if cost + more + settled[1].get((j, t), met + 1) == met]
        for audit in crossings:
            best = audit if best is None or audit < best else best
    return met, best


def applied(audit: str, roles: list, texts: list, state: int = NOTHING) -> list[dict]:
    """The messages that the edits of an audit leave."""
    out, i = [], 0
    for letter in audit:
        to = SYSTEM if letter == "K" and initial(roles[i]) == "s" else NEXT[state]
        if letter == "K":
            out.append({"role": roles[i], "text": texts[i]})
        elif letter in "RI":
            out.append({"role": NAMES[to], "text": texts[i] if letter == "R" else ""})
        state = state if letter == "D" else to
        i += letter != "I"
    return out


def _counted(letters: list[str], bad: list[str]) -> dict[str, int]:
    return {"blank": bad.count("b"), "duplicate": bad.count("d"), "truncated": bad.count("t"), "illegal": sum(a + b not in LEGAL for a, b in pairwise(letters))}


def _streamed(batches: Iterator[pa.RecordBatch], most: int | None = None) -> Iterator[tuple[object, dict[str, list]]]:
    """The consecutive rows of each ``conv_id``, at most ``most`` at a time, as columns."""
    held: dict[str, list] = {}
    for b in batches:
        columns = {name: b[name].to_pylist() for name in b.schema.names}
        for i, conv in enumerate(columns["conv_id"]):
            if held and (held["conv_id"][0] != conv or len(held["conv_id"]) == most):
                yield held["conv_id"][0], held
                held = {}
            for name, values in columns.items():
                held.setdefault(name, []).append(values[i])
    if held:
        yield held["conv_id"][0], held


def _batch(rows: list[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        yield from pa.Table.from_pylist(rows, schema).to_batches()
        rows.clear()


def _rows_out(schema: pa.Schema, make: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], many: int = 256):
    """A function for ``mapInArrow`` from one that yields rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for row in make(batches):
            rows.append(row)
            if len(rows) == many:
                yield from _batch(rows, schema)
        yield from _batch(rows, schema)

    return run


def _arrow(frame: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(frame.schema[column].dataType)


_LONGS = [("gaps", pa.int64()), *((c, pa.int64()) for c in (*COUNTS, "cost"))]
_MESSAGES = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
ORDER = ["conv_id", "turn", "role", "text"]


def _short(turns: DataFrame) -> DataFrame:
    """conv_id, counts, cost, audit and messages of conversations of at most ``CHUNK`` rows."""
    schema = pa.schema([("conv_id", _arrow(turns, "conv_id")), *_LONGS, ("audit", pa.string()), ("messages", _MESSAGES)])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for conv, rows in _streamed(batches):
            letters, bad = [initial(r) for r in rows["role"]], faults(rows["role"], rows["text"])
            cost, audit = cheapest(letters, bad)
            turn = {t for t in rows["turn"] if t is not None}
            yield {"conv_id": conv, "gaps": max(turn) - min(turn) + 1 - len(turn) if turn else 0, "cost": cost, "audit": audit,
                   "messages": applied(audit, rows["role"], rows["text"]), **_counted(letters, bad)}

    longs = ", ".join(f"{name} long" for name, _ in _LONGS)
    ordered = turns.select(*ORDER).repartition("conv_id").sortWithinPartitions(*ORDER)
    return ordered.mapInArrow(_rows_out(schema, solve), f"conv_id {dict(turns.dtypes)['conv_id']}, {longs}, audit string, messages {MESSAGES}")


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


class Path:
    """A way through chunks: the state after the last one, its cost, and the way before; equal ways share their beginnings."""

    def __init__(self, before: Path | None, state: int, cost: int, audit: str):
        self.before, self.state, self.cost, self.audit = before, state, cost, audit
        self.length = before.length + 1 if before else 0

    def steps(self) -> list[Path]:
        out, at = [], self
        while at.before:
            out.append(at)
            at = at.before
        return out[::-1]


def less(a: Path, b: Path) -> bool:
    """Whether ``a`` is the cheaper way, or as cheap with the lesser audit; ways of as many chunks."""
    if a.cost != b.cost:
        return a.cost < b.cost
    x, y, left, right = a, b, [], []
    while x is not y and x.before:
        left.append(x.audit)
        right.append(y.audit)
        x, y = x.before, y.before
    return "".join(reversed(left)) < "".join(reversed(right))


def _long(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations of more rows: (conv_id, counts, cost, audit, repaired_sha256) and (conv_id, part, messages)."""
    kind, arrow = dict(turns.dtypes)["conv_id"], _arrow(turns, "conv_id")
    rows = written(turns.select(*ORDER).withColumn("row", F.monotonically_increasing_id()), "repair-rows")
    same = F.struct("conv_id", "role", F.sha2("text", 256).alias("text"))
    first = rows.groupBy(same.alias("same")).agg(F.min(F.struct("turn", "row")).alias("first")).select(F.col("first.row").alias("first"))
    known = rows.join(first, rows["row"] == first["first"], "left").select(*ORDER, "row", F.col("first").isNull().alias("again"))
    # the ranges are cut by all that rows are sorted by, so one conversation spreads over many
    known = written(known, "repair-known")
    spread = known.repartitionByRange(*ORDER, "row").sortWithinPartitions(*ORDER, "row")
    at = [("conv_id", arrow), ("part", pa.int32()), ("chunk", pa.int32())]
    at_sql = f"conv_id {kind}, part int, chunk int"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        part = TaskContext.get().partitionId()
        for chunk, (conv, held) in enumerate(_streamed(batches, CHUNK)):
            yield {"conv_id": conv, "part": part, "chunk": chunk, "roles": held["role"], "texts": held["text"], "again": held["again"]}

    lists = pa.schema([*at, ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("again", pa.list_(pa.bool_()))])
    chunks = written(spread.mapInArrow(_rows_out(lists, cut, 16), f"{at_sql}, roles array<string>, texts array<string>, again array<boolean>"), "repair-chunks")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            for row in b.to_pylist():
                letters, bad = [initial(r) for r in row["roles"]], faults(row["roles"], row["texts"], row["again"])
                ways = [(s, e, *found) for s in range(4) for e in range(4) if (found := cheapest(letters, bad, s, (e,)))]
                yield {**{k: row[k] for k in ("conv_id", "part", "chunk")}, **_counted(letters, bad), "first": letters[0], "last": letters[-1],
                       "ways": [{"start": s, "end": e, "cost": c, "audit": a} for s, e, c, a in ways]}

    way = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
    solved_as = pa.schema([*at, *((c, pa.int64()) for c in COUNTS), ("first", pa.string()), ("last", pa.string()), ("ways", pa.list_(way))])
    longs = ", ".join(f"{c} long" for c in COUNTS)
    solved = chunks.mapInArrow(_rows_out(solved_as, solve, 16), f"{at_sql}, {longs}, first string, last string, ways array<struct<start:int,end:int,cost:long,audit:string>>")
    solved = solved.repartition("conv_id").sortWithinPartitions("conv_id", "part", "chunk")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        conv, have, sums, last, places = None, None, {}, "", []

        def result() -> dict:
            ends = [p for s, p in have.items() if s in (NOTHING, ASSISTANT)]
            best = ends[0]
            for p in ends[1:]:
                best = p if less(p, best) else best
            steps = best.steps()
            return {"conv_id": conv, **sums, "cost": best.cost, "audit": "".join(p.audit for p in steps),
                    "steps": [{"part": a, "chunk": c, "start": p.before.state, "edits": p.audit} for (a, c), p in zip(places, steps, strict=True)]}

        for b in batches:
            for row in b.to_pylist():
                if have is None or row["conv_id"] != conv:
                    if have is not None:
                        yield result()
                    conv, have, sums, places = row["conv_id"], {NOTHING: Path(None, NOTHING, 0, "")}, dict.fromkeys(COUNTS, 0), []
                elif last + row["first"] not in LEGAL:
                    sums["illegal"] += 1
                for c in COUNTS:
                    sums[c] += row[c]
                last = row["last"]
                places.append((row["part"], row["chunk"]))
                new: dict[int, Path] = {}
                for w in row["ways"]:
                    if w["start"] in have:
                        p = Path(have[w["start"]], w["end"], have[w["start"]].cost + w["cost"], w["audit"])
                        if w["end"] not in new or less(p, new[w["end"]]):
                            new[w["end"]] = p
                have = new
        if have is not None:
            yield result()

    step = pa.struct([("part", pa.int32()), ("chunk", pa.int32()), ("start", pa.int32()), ("edits", pa.string())])
    folded_as = pa.schema([("conv_id", arrow), *((c, pa.int64()) for c in (*COUNTS, "cost")), ("audit", pa.string()), ("steps", pa.list_(step))])
    folded = written(solved.mapInArrow(_rows_out(folded_as, fold, 1), f"conv_id {kind}, {longs}, cost long, audit string, steps array<struct<part:int,chunk:int,start:int,edits:string>>"), "repair-folded")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            for row in b.to_pylist():
                yield {**{k: row[k] for k in ("conv_id", "part", "chunk")}, "messages": applied(row["edits"], row["roles"], row["texts"], row["start"])}

    # a chunk's number and range are its own, whatever its conversation
    chosen = folded.select(F.inline("steps"))
    repaired = written(chunks.join(chosen, ["part", "chunk"]).mapInArrow(_rows_out(pa.schema([*at, ("messages", _MESSAGES)]), apply, 16), f"{at_sql}, messages {MESSAGES}"), "repair-messages")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        conv, h, empty = None, None, True
        for b in batches:
            for row in b.to_pylist():
                if h is None or row["conv_id"] != conv:
                    if h is not None:
                        yield {"conv_id": conv, "repaired_sha256": h.hexdigest()}
                    conv, h, empty = row["conv_id"], hashlib.sha256(), True
                text = "\n".join(f"{m['role']}:{m['text']}" for m in row["messages"])
                if row["messages"]:
                    h.update((text if empty else "\n" + text).encode())
                    empty = False
        if h is not None:
            yield {"conv_id": conv, "repaired_sha256": h.hexdigest()}

    ordered = repaired.repartition("conv_id").sortWithinPartitions("conv_id", "part", "chunk")
    hashes = ordered.mapInArrow(_rows_out(pa.schema([("conv_id", arrow), ("repaired_sha256", pa.string())]), digest), f"conv_id {kind}, repaired_sha256 string")
    span = rows.groupBy(F.col("conv_id").alias("g")).agg((F.coalesce(F.max("turn") - F.min("turn") + 1, F.lit(0)) - F.count_distinct("turn")).alias("gaps"))
    whole = folded.join(span, _same("conv_id", "g")).join(hashes.withColumnRenamed("conv_id", "h"), _same("conv_id", "h"))
    return whole.select("conv_id", "gaps", *COUNTS, "cost", "audit", "repaired_sha256"), repaired.select("conv_id", F.struct("part", "chunk").alias("part"), "messages")


def _divided(turns: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The rows of conversations of at most ``CHUNK`` rows, and of the longer ones if there are any."""
    turns = turns.select(*ORDER)
    sizes = turns.groupBy(F.col("conv_id").alias("g")).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > CHUNK).select("g")
    sizes = written(sizes, "repair-long")
    if sizes.isEmpty():
        return turns, None
    return turns.join(sizes, _same("conv_id", "g"), "left_anti"), turns.join(sizes, _same("conv_id", "g"), "left_semi")


def audited(turns: DataFrame) -> DataFrame:
    """For each conversation of ``turns`` (conv_id, turn, role, text): conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit, and ``repaired_sha256`` of its repaired messages, ``role:text`` by line."""
    short, long = _divided(turns)
    lines = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["text"])), "\n")
    out = _short(short).select("conv_id", "gaps", *COUNTS, "cost", "audit", F.sha2(lines, 256).alias("repaired_sha256"))
    return out if long is None else out.unionByName(_long(long)[0])


def repaired(turns: DataFrame) -> DataFrame:
    """The repaired messages: conv_id, ``part`` (in order; short conversations have one) and messages (role, text)."""
    short, long = _divided(turns)
    none = F.struct(F.lit(0).alias("part"), F.lit(0).alias("chunk"))
    out = _short(short).select("conv_id", none.alias("part"), "messages")
    return out if long is None else out.unionByName(_long(long)[1])


def damaged(conversations: DataFrame) -> DataFrame:
    """The damage of the contract: by crc32 of ``conv_id:turn`` modulo 20, 0 drops a row, 1 empties its text, 2 takes its
    sentence ends, 3 repeats it, 4 makes it a user's."""
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(name.cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1).cast("int")))
    return conversations.where(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("copy")).drop("copy")
