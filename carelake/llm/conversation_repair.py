"""Conversations brought back to alternating turns by the cheapest edits.

A conversation's rows become tokens; a depth-first branch and bound over them finds the cheapest
edits and, among those, the first in ASCII order. A conversation of any length is cut into chunks:
each chunk is searched from every role state to every other, and the tables of neighbours join to
one (equal costs never make one audit the start of another, so the least of a whole is made of
least parts). Ordinary conversations are done in one pass over sorted rows; one too large for a
task goes through blocks of rows, and only its tables meet.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..operators.ordered import Placed, split_hot
from ..session import written

#: What an edit costs: Rerole, Delete, Insert, and a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Role states: nothing yet, after system, after user, after assistant; a repaired conversation ends in one of ENDS.
STATES, ENDS = (0, 1, 2, 3), (0, 3)
KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
MADE = {0: 2, 1: 2, 2: 3, 3: 2}
LEGAL = {"su", "ua", "au"}
SPACE = " \t\n\v\f\r"
#: Tokens searched at once, rows of a block, and the size (rows, and 256 bytes of text a row) that a task takes as one.
CHUNK, BLOCK_ROWS, LARGE = 32, 2_048, 65_536

Best = tuple[int, str]


def search(tokens: tuple[str, ...], start: int, ends: tuple[int, ...]) -> Best | None:
    """The cheapest (cost, audit) that leads from ``start`` to one of ``ends``, first in ASCII order among equals.

    A token is a role's initial (``x`` for any other), in upper case if the row is truncated, or
    a run of ``D`` for rows that have to go. Prefixes come off the stack in ASCII order. One is
    dropped if its cost and the least cost of the rows to come exceed the incumbent's (or equal
    it behind the incumbent's audit), or if the table of its node (rows done, state) has a
    prefix as good. When the stack is empty the incumbent is proved.
    """
    n = len(tokens)
    low = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        t = tokens[i]
        low[i] = low[i + 1] + (DELETE * len(t) if t[0] == "D" else DELETE if t.isupper() else REROLE if t == "x" else 0)
    best = _greedy(tokens, start, ends)
    least: dict[tuple[int, int], Best] = {}
    stack: list[tuple[int, int, int, str]] = [(0, start, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        if best is not None and (cost + low[i], audit) > (best[0], best[1][: len(audit)]):
            continue
        known = least.get((i, state))
        if known is not None and known <= (cost, audit):
            continue
        least[i, state] = cost, audit
        if i == n and state in ends and (best is None or (cost, audit) < best):
            best = cost, audit
        if i < n:
            t = tokens[i]
            if t[0] != "D":
                extra = TRUNCATED if t.isupper() else 0
                stack.append((i + 1, MADE[state], cost + REROLE + extra, audit + "R"))
                to = KEPT.get((state, t.lower()))
                if to is not None:
                    stack.append((i + 1, to, cost + extra, audit + "K"))
            stack.append((i, MADE[state], cost + INSERT, audit + "I"))
            run = len(t) if t[0] == "D" else 1
            stack.append((i + 1, state, cost + DELETE * run, audit + "D" * run))
        else:
            stack.append((i, MADE[state], cost + INSERT, audit + "I"))
    return best


def _greedy(tokens: tuple[str, ...], start: int, ends: tuple[int, ...]) -> Best | None:
    """A first incumbent: rows that fit stay, truncated and doubled ones go, others are reroled, an insert at the end."""
    state, cost, audit = start, 0, []
    for t in tokens:
        to = KEPT.get((state, t))
        if to is not None:
            state, letter = to, "K"
        elif t == "x":
            state, cost, letter = MADE[state], cost + REROLE, "R"
        else:
            cost, letter = cost + DELETE * len(t), "D" * len(t)
        audit.append(letter)
    for _ in range(3):
        if state in ends:
            return cost, "".join(audit)
        state, cost = MADE[state], cost + INSERT
        audit.append("I")
    return None


Table = dict[tuple[int, int], Best]


@lru_cache(maxsize=20_000)
def _chunk(tokens: tuple[str, ...]) -> Table:
    found = {(a, b): search(tokens, a, (b,)) for a in STATES for b in STATES}
    return {k: v for k, v in found.items() if v is not None}


def joined(left: Table, right: Table) -> Table:
    out: Table = {}
    for (a, b), (cost, audit) in left.items():
        for c in STATES:
            if (b, c) in right:
                more, rest = right[b, c]
                new = cost + more, audit + rest
                if (a, c) not in out or new < out[a, c]:
                    out[a, c] = new
    return out


def table(tokens: list[str]) -> Table:
    """The best edits of a run of rows between all role states; chunks join pairwise."""
    parts = [_chunk(tuple(tokens[i : i + CHUNK])) for i in range(0, len(tokens), CHUNK)] or [_chunk(())]
    while len(parts) > 1:
        parts = [joined(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


@lru_cache(maxsize=50_000)
def _short(tokens: tuple[str, ...]) -> Best:
    return search(tokens, 0, ENDS)  # type: ignore[return-value]  # deleting everything always ends well


def cheapest(tokens: list[str]) -> Best:
    if len(tokens) <= CHUNK:
        return _short(tuple(tokens))
    whole = table(tokens)
    return min(whole[0, end] for end in ENDS if (0, end) in whole)


class Rows:
    """Counts and tokens of rows that follow each other; ``n`` equal rows come as one, ``first`` if their like was not seen before."""

    def __init__(self) -> None:
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.turn = self.turn0 = None
        self.initial0 = self.initial = None
        self.tokens: list[str] = []

    def add(self, turn: int | None, role: str, text: str, n: int, first: bool) -> None:
        if turn is not None:
            if turn != self.turn:
                self.turns += 1
            if self.low is None:
                self.low = self.turn0 = turn
            self.high = self.turn = turn
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.illegal += 1
        self.illegal += n - 1  # equal neighbours
        if self.initial is None:
            self.initial0 = initial
        self.initial = initial
        end = text.rstrip(SPACE)[-1:]
        kept = first and end != ""
        if kept:
            cut = end not in ".!?"
            self.truncated += cut
            token = initial if initial in ("s", "u", "a") else "x"
            self.tokens.append(token.upper() if cut else token)
        if end == "":
            self.blank += n
        else:
            self.duplicate += n - first
        gone = n - kept
        if gone:
            if self.tokens and self.tokens[-1][0] == "D":
                self.tokens[-1] += "D" * gone
            else:
                self.tokens.append("D" * gone)

    def counts(self) -> tuple[int, int, int, int, int]:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal


class Written:
    """The hash of a repaired conversation, row by row, as its audit says."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state, self.any = audit, 0, 0, False
        self.hash = hashlib.sha256()

    def _put(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.any else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.any = True

    def _made(self, text: str) -> None:
        self.state = MADE[self.state]
        self._put("assistant" if self.state == 3 else "user", text)

    def inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._made("")
            self.at += 1

    def add(self, role: str, text: str, n: int) -> None:
        for _ in range(n):
            self.inserts()
            letter = self.audit[self.at]
            self.at += 1
            if letter == "K":
                self.state = KEPT[self.state, role[:1]]
                self._put(role, text)
            elif letter == "R":
                self._made(text)

    def digest(self) -> str:
        self.inserts()
        return self.hash.hexdigest()


def damaged(rows: DataFrame) -> DataFrame:
    """The rows after damage: conv, turn, role, text and ``n``, how often (0: dropped); null role and text are one space."""
    part = lambda c: F.coalesce(rows[c].cast("string"), F.lit(" "))
    code = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % 20
    text = F.when(code == 1, "").when(code == 2, F.translate(part("text"), ".!?", "")).otherwise(part("text"))
    return rows.select(
        rows["conv_id"].alias("conv"), rows["turn"].cast("long").alias("turn"), F.when(code == 4, "user").otherwise(part("role")).alias("role"),
        F.when(code == 0, "").otherwise(text).alias("text"), F.when(code == 0, 0).when(code == 3, 2).otherwise(1).cast("long").alias("n"),
    )


ORDER = ("turn", "role", "text")
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")


def _result(conv: T.DataType) -> T.StructType:
    whole = [T.StructField(c, T.LongType()) for c in (*COUNTS, "cost")]
    return T.StructType([T.StructField("conv_id", conv), *whole, T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, Iterable[tuple]]]:
    """Neighbouring rows that agree in their first ``keys`` columns, as (key, rows); the rows are read as they are asked for."""
    def rows() -> Iterator[tuple]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                yield from zip(*(c.to_pylist() for c in part.columns), strict=True)

    return groupby(rows(), key=lambda row: row[:keys])


def _batches(rows: Iterator[tuple], schema: T.StructType, size: int = 512) -> Iterator[pa.RecordBatch]:
    arrow, held = to_arrow_schema(schema), []

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(zip(*held, strict=True), arrow, strict=True)], schema=arrow)

    for row in rows:
        held.append(row)
        if len(held) == size:
            yield made()
            held = []
    if held:
        yield made()


def _ordinary(rows: DataFrame, schema: T.StructType) -> DataFrame:
    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (conv,), group in _runs(batches, 1):
            found, seen, stay = Rows(), set(), []
            for _, turn, role, text, n in group:
                if n:
                    found.add(turn, role, text, n, (role, text) not in seen)
                    seen.add((role, text))
                    stay.append((role, text, n))
            cost, audit = cheapest(found.tokens)
            out = Written(audit)
            for row in stay:
                out.add(*row)
            yield (conv, *found.counts(), cost, audit, out.digest())

    by_conv = rows.repartition("conv").sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text", "n")
    return by_conv.mapInArrow(lambda batches: _batches(repaired(batches), schema), schema)


def _large(rows: DataFrame, schema: T.StructType, block_rows: int) -> DataFrame:
    """Conversations of any length: equal rows are one, blocks of rows give tables, the tables of a conversation meet."""
    conv_type = rows.schema["conv"].dataType
    there = written(rows.where("n > 0").groupBy("conv", *ORDER).agg(F.sum("n").alias("n")), "long-rows")
    firsts = there.groupBy("conv", "role", "text").agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first"))
    marked = there.withColumn("first", F.lit(False)).unionByName(
        firsts.select("conv", F.col("first.turn").alias("turn"), "role", "text", F.lit(0).cast("long").alias("n"), F.lit(True).alias("first"))
    )
    flagged = marked.groupBy("conv", *ORDER).agg(F.sum("n").alias("n"), F.max("first").alias("first"))
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()]
    placed = Placed(flagged, order).rows

    best = "array<struct<a:int,b:int,cost:bigint,audit:string>>"
    parts = T.StructType([
        T.StructField("conv", conv_type), T.StructField("block", T.LongType()), T.StructField("n", T.LongType()),
        *[T.StructField(c, T.LongType()) for c in ("blank", "duplicate", "truncated", "illegal", "turns", "low", "high")],
        T.StructField("initial0", T.StringType()), T.StructField("initial", T.StringType()), T.StructField("best", T._parse_datatype_string(best)),
    ])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (block, conv), group in _runs(batches, 2):
            found = Rows()
            n = 0
            for _, _, _, turn, role, text, times, first in group:
                found.add(turn, role, text, times, first)
                n += times
            solved = [{"a": a, "b": b, "cost": cost, "audit": audit} for (a, b), (cost, audit) in table(found.tokens).items()]
            yield (conv, block, n, found.blank, found.duplicate, found.truncated, found.illegal, found.turns, found.low, found.high, found.initial0, found.initial, solved)

    in_blocks = placed.select(F.expr(f"_pos div {block_rows}").alias("block"), "conv", "_pos", *ORDER, "n", "first").repartition("block")
    solved = in_blocks.sortWithinPartitions("block", "_pos").mapInArrow(lambda batches: _batches(blocks(batches), parts), parts)
    # Every conversation has a part, also one that lost all its rows.
    nothing = rows.select("conv").distinct().select("conv", *[F.lit(None).cast(f.dataType).alias(f.name) for f in parts.fields[1:]])
    audits = T.StructType([f for f in schema.fields if f.name != "repaired_sha256"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (conv,), group in _runs(batches, 1):
            state: Table = {(0, 0): (0, "")}
            sums, turns, low, high, last = [0, 0, 0, 0], 0, None, None, None
            for _, block, _, blank, duplicate, truncated, illegal, distinct, from_, to, initial0, initial, solved in group:
                if block is None:
                    continue
                border = last is not None and last + initial0 not in LEGAL
                sums = [x + y for x, y in zip(sums, (blank, duplicate, truncated, illegal + border), strict=True)]
                last = initial
                if from_ is not None:
                    turns += distinct - (from_ == high)
                    low, high = from_ if low is None else low, to
                state = joined(state, {(s["a"], s["b"]): (s["cost"], s["audit"]) for s in solved})
            cost, audit = min(state[0, end] for end in ENDS if (0, end) in state)
            yield (conv, 0 if low is None else high - low + 1 - turns, *sums, cost, audit)

    met = solved.unionByName(nothing).repartition("conv").sortWithinPartitions("conv", F.col("block").asc_nulls_first())
    decided = written(met.mapInArrow(lambda batches: _batches(meet(batches), audits, 16), audits), "long-audits")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (conv,), group in _runs(batches, 1):
            head = next(iter(group))
            out = Written(head[-1])
            for _, _, role, text, n, *_ in group:
                out.add(role, text, n)
            yield (conv, *head[5:], out.digest())

    none = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in audits.fields[1:]}
    lines = placed.select("conv", "_pos", "role", "text", "n", *none.values())
    heads = decided.select(F.col("conv_id").alias("conv"), F.lit(-1).cast("long").alias("_pos"), *[F.lit(None).cast(k).alias(c) for c, k in (("role", "string"), ("text", "string"), ("n", "long"))], *none)
    # A digest is a chain, so a conversation's text passes one task, in batches; everything before is spread.
    ordered = heads.unionByName(lines).repartition("conv").sortWithinPartitions("conv", "_pos")
    return ordered.mapInArrow(lambda batches: _batches(hashed(batches), schema, 16), schema)


def size(text: Column) -> Column:
    return F.count("*") + F.coalesce(F.sum(F.octet_length(text)), F.lit(0)) / 256


def repair(rows: DataFrame, large: int = LARGE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """A row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    The table is damaged by its own key first (see ``damaged``), and the rows that are left are
    taken by turn, null first; equal turns by role, then text, so repeated rows are neighbours
    and all but the first are duplicates. A null conv_id is a conversation of its own. Null
    roles and texts are one space. A role without a known initial is never kept as it is; an
    empty role has none. A conversation that lost all its rows has zeros, an empty audit and the
    hash of nothing. Only the four columns are read; an empty table gives no rows.

    Conversations above ``large`` (rows, and a row more for each 256 bytes of text) go through
    blocks of ``block_rows``; the result is the same. Jobs run while this is called: the counts,
    and if there is a large conversation, its rows and tables.
    """
    after = damaged(rows)
    schema = _result(rows.schema["conv_id"].dataType)
    totals = rows.groupBy(rows["conv_id"].alias("conv")).agg(size(rows["text"]).alias("_n"))
    cold, hot = split_hot(after, ["conv"], large, totals=totals)
    out = _ordinary(cold, schema)
    return out if hot is None else out.unionByName(_large(hot, schema, block_rows))
