"""Repair of conversations: generalised LR parsing of roles with weighted edits.

The stacks of all parses share one graph. Each row may be kept, given another role or deleted,
and turns may be put in anywhere; parses whose stacks have the same top are merged, the one
with the least (cost, audit) staying. In this grammar what may follow depends on the top
alone, and an audit leads to one top, so nothing is lost.
"""

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import importable, sized, stored

#: What the first letters of the roles have to be: (s?(ua)+)?
GRAMMAR = (
    ("conversation", ()),
    ("conversation", ("opening", "turns")),
    ("opening", ()),
    ("opening", ("s",)),
    ("turns", ("pair",)),
    ("turns", ("turns", "pair")),
    ("pair", ("u", "a")),
)
START = "conversation"
RULES: dict[str, list[tuple[str, tuple[str, ...]]]] = {}
for _rule in GRAMMAR:
    RULES.setdefault(_rule[0], []).append(_rule)

REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
ROLES = {"u": "user", "a": "assistant"}
LEGAL_PAIRS = frozenset({"su", "ua", "au"})
SPACE = " \t\n\x0b\x0c\r"

#: A conversation beyond these is repaired in chunks of rows by many tasks.
MANY_ROWS = 20_000
MANY_BYTES = 32 << 20
CHUNK_BITS = 13

Item = tuple[str, tuple[str, ...], int]
#: A stack: its top state, and the stacks it stands on.
Stack = tuple[frozenset[Item], frozenset]


# ---- the LR automaton and its stacks ------------------------------------------------------


def _closed(items: Iterable[Item]) -> frozenset[Item]:
    done, todo = set(), list(items)
    while todo:
        item = todo.pop()
        if item not in done:
            done.add(item)
            name, body, dot = item
            if dot < len(body):
                todo += [(*rule, 0) for rule in RULES.get(body[dot], [])]
    return frozenset(done)


@lru_cache(None)
def _goto(state: frozenset[Item], symbol: str) -> frozenset[Item]:
    return _closed((n, b, d + 1) for n, b, d in state if d < len(b) and b[d] == symbol)


def _bottom() -> Stack:
    return (_closed((*rule, 0) for rule in RULES[START]), frozenset())


def _below(stack: Stack, depth: int) -> set[Stack]:
    found = {stack}
    for _ in range(depth):
        found = {under for s in found for under in s[1]}
    return found


@lru_cache(None)
def _reduced(stack: Stack) -> tuple[frozenset[Stack], bool]:
    """(the stack and all it reduces to, whether one of them is a whole conversation)."""
    done, todo, whole = set(), [stack], False
    while todo:
        one = todo.pop()
        if one in done:
            continue
        done.add(one)
        for name, body, dot in one[0]:
            if dot == len(body):
                for under in _below(one, dot):
                    if name == START:
                        whole = whole or not under[1]
                    elif state := _goto(under[0], name):
                        todo.append((state, frozenset({under})))
    return frozenset(done), whole


def _merged(stacks: Iterable[Stack]) -> frozenset[Stack]:
    """Stacks with the same top as one that stands on what each of them stands on."""
    under: dict[frozenset[Item], frozenset] = {}
    for state, links in stacks:
        under[state] = under.get(state, frozenset()) | links
    return frozenset(under.items())


@lru_cache(None)
def _shifted(stack: Stack, symbol: str) -> frozenset[Stack]:
    """What a symbol makes of a stack: shifted, then reduced in every way, merged by top."""
    found: set[Stack] = set()
    for one in _reduced(stack)[0]:
        if state := _goto(one[0], symbol):
            found |= _reduced((state, frozenset({one})))[0]
    return frozenset(s for s in _merged(found) if any(d < len(b) for _, b, d in s[0]))


def _tops() -> list[Stack]:
    """Every top that can occur, standing on all it can stand on; the empty stack is the first."""
    known = _merged({_bottom()})
    while True:
        more = _merged(known | {s for k in known for symbol in "sua" for s in _shifted(k, symbol)})
        if more == known:
            break
        known = more
    rest = sorted((s for s in known if s[1]), key=lambda s: sorted(map(str, s[0])))
    return [_bottom(), *rest]


#: The graph of all stacks, by the number of its top.
GRAPH = _tops()
_NUMBER = {state: i for i, (state, _) in enumerate(GRAPH)}


@lru_cache(None)
def moves(top: int, symbol: str) -> tuple[int, ...]:
    """Tops that a symbol leads to."""
    return tuple(sorted(_NUMBER[s[0]] for s in _shifted(GRAPH[top], symbol)))


@lru_cache(None)
def inserts(top: int) -> tuple[tuple[int, int], ...]:
    """(top, turns put in) that inserted turns lead to, fewest first; no turns included."""
    best, frontier, n = {top: 0}, {top}, 0
    while frontier:
        n += 1
        frontier = {t for f in frontier for symbol in ROLES for t in moves(f, symbol)} - set(best)
        best |= dict.fromkeys(frontier, n)
    return tuple(sorted(best.items(), key=lambda x: (x[1], x[0])))


WHOLE = frozenset(i for i, s in enumerate(GRAPH) if _reduced(s)[1])


@lru_cache(None)
def steps(top: int, initial: str, fault: str) -> tuple[tuple[int, int, str], ...]:
    """(next top, cost, audit) of what can be done with a row, turns put in before it included."""
    cut = TRUNCATED if fault == "truncated" else 0
    found: dict[tuple[int, int], str] = {}
    for start, n in inserts(top):
        options = [(start, DELETE, "D")]
        if fault not in ("blank", "duplicate"):
            options += [(t, cut, "K") for t in (moves(start, initial) if initial else ())]
            options += [(t, REROLE + cut, "R") for symbol in ROLES for t in moves(start, symbol)]
        for t, cost, audit in options:
            key, audit = (t, cost + INSERT * n), "I" * n + audit
            found[key] = min(found.get(key, audit), audit)
    return tuple((t, cost, audit) for (t, cost), audit in sorted(found.items()))


# ---- parsing ------------------------------------------------------------------------------


@dataclass
class Parses:
    """The least (cost, audit) by stack top, over the rows so far.

    Audits aren't compared as strings: they all end with a row's own action, so none is the beginning of
    another, and their order is that of (order of the audit before, what was added).
    """

    best: dict[int, tuple[int, int]]  # top -> (cost, order of its audit)
    back: list[dict[int, tuple[int, str]]] = field(default_factory=list)

    def row(self, initial: str, fault: str) -> None:
        found: dict[int, tuple[int, int, str, int]] = {}
        for top, (cost, order) in self.best.items():
            for to, more, audit in steps(top, initial, fault):
                one = (cost + more, order, audit, top)
                if to not in found or one < found[to]:
                    found[to] = one
        orders = {key: i for i, key in enumerate(sorted({(o, a) for _, o, a, _ in found.values()}))}
        self.best = {to: (cost, orders[order, audit]) for to, (cost, order, audit, _) in found.items()}
        self.back.append({to: (top, audit) for to, (_, _, audit, top) in found.items()})

    def audit(self, top: int) -> list[str]:
        """What was done with each row to reach a top."""
        done = []
        for links in reversed(self.back):
            top, step = links[top]
            done.append(step)
        return done[::-1]


def finish(best: dict[int, tuple[int, int]]) -> tuple[int, int, int]:
    """(cost, top, turns put in at the end) of the best whole conversation."""
    ends = [(cost + INSERT * n, order, n, top) for top, (cost, order) in best.items() for t, n in inserts(top) if t in WHOLE]
    cost, _, n, top = min(ends)
    return cost, top, n


def emitted(top: int, symbol: str | None) -> tuple[int, str]:
    """(next top, role letter) of a turn: its own letter, or for None the one that may come next."""
    symbol = symbol or next(s for s in ROLES if moves(top, s))
    return moves(top, symbol)[0], symbol


class Replay:
    """Lines of the repaired conversation, from its rows and the audit."""

    def __init__(self) -> None:
        self.top = 0

    def lines(self, step: str, role: str = "", text: str = "") -> list[str]:
        made = []
        for action in step:
            if action == "D":
                continue
            self.top, symbol = emitted(self.top, role[:1] if action == "K" else None)
            if action == "K":
                made.append(f"{role}:{text}")
            else:
                made.append(f"{ROLES[symbol]}:{text if action == 'R' else ''}")
        return made


def fault_of(text: str, repeated: bool) -> str:
    """The first fault of a row: blank, duplicate, truncated or none."""
    seen = text.rstrip(SPACE)
    if not seen:
        return "blank"
    if repeated:
        return "duplicate"
    return "" if seen[-1] in ".!?" else "truncated"


def repair(rows: list[tuple[int | None, str, str]]) -> dict:
    """Counts, cost, audit and digest of one conversation: (turn, role, text) in order."""
    turns = [t for t, _, _ in rows if t is not None]
    seen: set[tuple[str, str]] = set()
    faults = []
    parses = Parses({0: (0, 0)})
    for _, role, text in rows:
        fault = fault_of(text, (role, text) in seen)
        seen.add((role, text))
        faults.append(fault)
        parses.row(role[:1], fault)
    initials = [role[:1] for _, role, _ in rows]
    cost, top, added = finish(parses.best)
    done, replay, lines = parses.audit(top), Replay(), []
    for step, (_, role, text) in zip(done, rows, strict=True):
        lines += replay.lines(step, role, text)
    lines += replay.lines("I" * added)
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in LEGAL_PAIRS for a, b in zip(initials, initials[1:], strict=False)),
        "cost": cost,
        "audit": "".join(done) + "I" * added,
        "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }


COUNTS = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint"
OUT = f"{COUNTS}, audit string, repaired_sha256 string"


# ---- on Spark -----------------------------------------------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows damaged by the crc32 of their id and turn; 0 copies: dropped."""
    key = "concat(coalesce(cast(conv_id as string), ' '), ':', coalesce(cast(turn as string), ' '))"
    kind = rows.select("conv_id", "turn", "role", "text", F.expr(f"crc32({key}) % 20").alias("_kind"))
    return kind.selectExpr(
        "conv_id",
        "turn",
        "CASE _kind WHEN 0 THEN '' WHEN 4 THEN 'user' ELSE coalesce(role, ' ') END AS role",
        "CASE _kind WHEN 0 THEN '' WHEN 1 THEN '' WHEN 2 THEN translate(coalesce(text, ' '), '.!?', '') "
        "ELSE coalesce(text, ' ') END AS text",
        "CASE _kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END AS copies",
    )


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """(first column, iterator of the other columns' rows) of each run of equal first values."""
    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    for key, members in groupby(rows(), key=lambda r: r[0]):
        yield key, (m[1:] for m in members)


def _schema(rows: DataFrame) -> str:
    return f"conv_id {dict(rows.dtypes)['conv_id']}, {OUT}"


def _results(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    out: list[dict] = []
    for conv, members in _groups(batches):
        rows = [(turn, role, text) for turn, role, text, copies in members for _ in range(copies)]
        out.append({"conv_id": conv, **repair(rows)})
        if len(out) >= 1000:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out = []
    yield pa.RecordBatch.from_pylist(out, schema=schema)


def _arrow(rows: DataFrame, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(rows.sparkSession.createDataFrame([], schema).schema)


ORDER = ("conv_id", "turn", "role", "text")


def repaired(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation.

    ``rows`` is (conv_id, turn, role, text, copies), null turns first; rows of one turn go by
    role, then text, so that repeated and tied rows have one order. A null conv_id is a conversation of its
    own. A conversation without rows (all have 0 copies) has zeros, an empty audit and the digest of
    the empty string. An empty table gives no rows. Further columns are left out. Texts
    are read whole. A conversation is repaired by one task if it has at most
    MANY_ROWS rows and MANY_BYTES of text, and by many otherwise, with the same result.
    """
    importable(rows.sparkSession)
    rows = rows.select(*ORDER, "copies")
    sizes = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    many = sizes.where((F.col("n") > MANY_ROWS) | (F.col("bytes") > MANY_BYTES)).select(F.col("conv_id").alias("_conv"))
    many = sized(stored(many, "many"))
    if many.isEmpty():
        return _whole(rows)
    same = F.col("conv_id").eqNullSafe(F.col("_conv"))
    return _whole(rows.join(many, same, "left_anti")).unionByName(_chunked(rows.join(many, same, "left_semi")))


def _whole(rows: DataFrame) -> DataFrame:
    schema = _schema(rows)
    arrow = _arrow(rows, schema)
    # hash partitions hold whole conversations; sorted, each is read as one run
    ordered = rows.repartition("conv_id").sortWithinPartitions(*ORDER)
    return ordered.mapInArrow(lambda batches: _results(batches, arrow), schema)


# ---- conversations of very many rows ------------------------------------------------------

_ROUTE = "struct<entry:int,exit:int,cost:bigint,rank:int,audit:string>"


def _routes(members: Iterable[tuple[str, str]]) -> list[dict]:
    """How a chunk of (initial, fault) leads from each top to each: cost, order of the audit, audit."""
    members = list(members)
    found = []
    for entry in range(len(GRAPH)):
        parses = Parses({entry: (0, 0)})
        for initial, fault in members:
            parses.row(initial, fault)
        for top, (cost, order) in parses.best.items():
            audit = "".join(parses.audit(top))
            found.append({"entry": entry, "exit": top, "cost": cost, "rank": order, "audit": audit})
    return found


def _chunk(rows: list[dict]) -> list[dict]:
    """The rows of a chunk -> one row: its faults, its first and last letter, its routes."""
    members = []
    for r in sorted(rows, key=lambda r: r["at"]):
        members.append((r["initial"], r["fault"]))
        if r["copies"] > 1:  # the second copy has been seen; a blank one is blank
            members.append((r["initial"], r["fault"] if r["fault"] == "blank" else "duplicate"))
    letters, found = [i for i, _ in members], [f for _, f in members]
    return [
        {
            "conv_id": rows[0]["conv_id"],
            "chunk": rows[0]["chunk"],
            **{f: found.count(f) for f in ("blank", "duplicate", "truncated")},
            "illegal": sum(a + b not in LEGAL_PAIRS for a, b in zip(letters, letters[1:], strict=False)),
            "first": letters[0],
            "last": letters[-1],
            "routes": _routes(members),
        }
    ]


def _chain(rows: list[dict]) -> list[dict]:
    """The chunks of a conversation -> the route taken through each, and the totals."""
    rows = sorted(rows, key=lambda r: r["chunk"])
    best, back = {0: (0, 0)}, []
    for r in rows:
        found: dict[int, tuple[int, int, int, int]] = {}
        for route in r["routes"]:
            if route["entry"] in best:
                cost, order = best[route["entry"]]
                one = (cost + route["cost"], order, route["rank"], route["entry"])
                if route["exit"] not in found or one < found[route["exit"]]:
                    found[route["exit"]] = one
        orders = {key: i for i, key in enumerate(sorted({(o, rank) for _, o, rank, _ in found.values()}))}
        best = {to: (cost, orders[o, rank]) for to, (cost, o, rank, _) in found.items()}
        back.append({to: entry for to, (_, _, _, entry) in found.items()})
    seams = sum(a["last"] + b["first"] not in LEGAL_PAIRS for a, b in zip(rows, rows[1:], strict=False))
    total, top, added = finish(best)
    pairs = seams + sum(r["illegal"] for r in rows)
    taken = []
    for r, links in zip(rows[::-1], back[::-1], strict=True):
        one = {"conv_id": r["conv_id"], "chunk": r["chunk"], "entry": links[top], "exit": top, "added": added}
        taken.append({**one, "total": total, "pairs": pairs})
        top, added = links[top], 0
    return taken


def _by_group(rows: DataFrame, keys: tuple[str, ...], fn: Callable[[list[dict]], list[dict]], schema: str) -> DataFrame:
    arrow = _arrow(rows, schema)
    return rows.groupBy(*keys).applyInArrow(lambda t: pa.Table.from_pylist(fn(t.to_pylist()), schema=arrow), schema)


def _digests(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Digest of each conversation, read in order and hashed line by line; holds a chunk's audit at most."""
    for conv, members in _groups(batches):
        replay, digest, between = Replay(), hashlib.sha256(), b""
        todo: list[str] = []

        def put(lines: list[str]) -> None:
            nonlocal between
            for line in lines:
                digest.update(between + line.encode())
                between = b"\n"

        for _, at, role, text, copies in members:
            if at is None:
                put(replay.lines("".join(todo[::-1])))  # turns put in after the last row
                todo = re.findall("I*[KRD]|I+", text)[::-1]
                continue
            for _ in range(copies):
                put(replay.lines(todo.pop(), role, text))
        put(replay.lines("".join(todo[::-1])))
        yield pa.RecordBatch.from_pylist([{"conv_id": conv, "repaired_sha256": digest.hexdigest()}], schema=schema)


def _chunked(rows: DataFrame) -> DataFrame:
    """As :func:`_whole`, for conversations of any length.

    Rows are sorted over all partitions. Each chunk of them gives the least (cost, audit) from every
    stack top to every other, chunks are chained on these few figures, and the audits of the
    routes taken are put together. Only the digest is made in one run over a conversation, as SHA-256
    goes on from its state before; it reads line by line.
    """
    conv = f"conv_id {dict(rows.dtypes)['conv_id']}"
    sorted_rows = rows.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    ordered = stored(sorted_rows.withColumn("at", F.monotonically_increasing_id()), "ordered").withColumn(
        "chunk", F.shiftright("at", CHUNK_BITS)
    )
    light = ordered.select(
        "conv_id", "chunk", "at", "turn", "copies", F.substring("role", 1, 1).alias("initial"),
        F.expr("sha2(concat(octet_length(role), ':', role, text), 256)").alias("same"),
        F.expr("regexp_extract(text, '([^ \\t-\\r])[ \\t-\\r]*\\\\z', 1)").alias("ending"),
    ).where("copies > 0")
    light = stored(light, "light")
    repeats = light.groupBy("conv_id", "same").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    repeats = stored(repeats.select(F.col("conv_id").alias("_conv"), F.col("same").alias("_same"), "first"), "repeats")
    here = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("same") == F.col("_same"))
    fault = """CASE WHEN ending = '' THEN 'blank' WHEN at > first THEN 'duplicate'
      WHEN ending NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END"""
    faults = light.join(sized(repeats), here, "left")
    faults = faults.selectExpr("conv_id", "chunk", "at", "initial", "copies", f"{fault} AS fault")
    counted = "blank bigint, duplicate bigint, truncated bigint, illegal bigint, first string, last string"
    chunks = _by_group(faults, ("conv_id", "chunk"), _chunk, f"{conv}, chunk bigint, {counted}, routes array<{_ROUTE}>")
    chunks = stored(chunks, "chunks")
    figures = "transform(routes, r -> named_struct('entry', r.entry, 'exit', r.exit, 'cost', r.cost, 'rank', r.rank))"
    figures = chunks.select("conv_id", "chunk", "illegal", "first", "last", F.expr(figures).alias("routes"))
    route = "entry int, exit int, added int, total bigint, pairs bigint"
    taken = stored(_by_group(figures, ("conv_id",), _chain, f"{conv}, chunk bigint, {route}"), "taken")
    same_chunk = F.col("c.conv_id").eqNullSafe(F.col("t.conv_id")) & (F.col("c.chunk") == F.col("t.chunk"))
    piece = "filter(routes, r -> r.entry = entry AND r.exit = exit)[0].audit || repeat('I', added)"
    pieces = stored(
        chunks.alias("c").join(taken.alias("t"), same_chunk).select("c.*", "entry", "exit", "added", "total", "pairs")
        .selectExpr("conv_id", "chunk", "blank", "duplicate", "truncated", "total", "pairs", f"{piece} AS audit"),
        "pieces",
    )
    totals = pieces.groupBy("conv_id").agg(
        *(F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")),
        F.max("pairs").alias("illegal"),
        F.max("total").alias("cost"),
        F.expr("array_join(transform(array_sort(collect_list(struct(chunk, audit))), x -> x.audit), '')").alias("audit"),
    )
    turns = light.groupBy("conv_id").agg(
        F.expr("coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)").alias("gaps")
    )
    heads = pieces.selectExpr("conv_id", "chunk", "cast(null as bigint) AS at", "'' AS role", "audit AS text", "1 AS copies")
    lines = heads.unionByName(ordered.where("copies > 0").select("conv_id", "chunk", "at", "role", "text", "copies"))
    schema = f"{conv}, repaired_sha256 string"
    arrow = _arrow(rows, schema)
    hashed = lines.repartition("conv_id").sortWithinPartitions("conv_id", "chunk", "at")
    hashed = hashed.mapInArrow(lambda batches: _digests(batches, arrow), schema)
    # of conversations whose rows were all dropped only the id is left
    out = ordered.select("conv_id").distinct()
    for found in (totals, turns, hashed):
        found = found.withColumnRenamed("conv_id", "_conv")
        out = out.join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    figures = [f.split()[0] for f in COUNTS.split(", ")]
    return out.select(
        "conv_id",
        *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in figures),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
