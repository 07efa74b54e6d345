"""Operator 13: repair of conversation structure by weighted interval parsing.

A repaired conversation's role initials read ``(s?(ua)+)?``. Its automaton has
the states S (nothing yet), X (after s), U (after u), A (after a). The repair
grammar is in Chomsky normal form: nonterminal ``pq`` derives the edits of a
span of rows that lead from state p to q. Rules are ``pq -> pr rq`` for every r;
a single row derives ``pq`` by one edit (keep, rerole or delete at its cost),
closed under insertions on both sides. The cell of a span holds for every pq the
least (cost, audit); of equal costs the ASCII-least audit. Two audits of one
span and equal cost never begin one with the other (letters other than I stand
for rows, and I costs), so the least of a whole is made of least parts. Every
derivation of a span crosses each of its split points, so any one split gives
the whole cell: spans double in length from level to level, bottom-up, in
O(rows) cells.

Conversations up to ``MAX_ROWS`` rows and ``MAX_BYTES`` bytes are dealt out by
id, sorted and parsed whole. A longer one never is in one task: equal rows are
counted first, the first place of every (role, text) is found by an aggregate,
rows are dealt by ranges of their order, each task parses its span to one cell,
and the cells of a conversation are combined in order. Only the digest of its
repaired text is made by one task, as a stream (SHA-256 has no parallel form).

Order of rows: by turn, nulls first; rows of one turn by role, then by the first
``HEAD`` characters of the text and its hash.

Defined results: a null role or text is one space; a null conversation id or
turn is one space in the damage key, null ids are one conversation, and null
turns do not count for gaps. An empty text is blank. Repeated rows are
duplicates. A conversation without rows after damage gets zeros, an empty audit
and the digest of the empty string. Texts of any length are taken whole. An
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import groupby

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import WHITE, store

MAX_ROWS, MAX_BYTES = 2_000, 4 << 20
HEAD = 64

# Costs of the contract; an audit's letters sort D, I, K, R.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
#: state -> the state after a user's or assistant's turn that may follow
NEXT = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
KEEPS = {"s": [(START, SYSTEM)], "u": [(p, USER) for p in (START, SYSTEM, ASSISTANT)], "a": [(USER, ASSISTANT)]}
LEGAL = {"su", "ua", "au"}
#: Symbols of rows: initial of the role (x: any other), upper case if truncated,
#: b for blank and d for duplicate rows.
BLANK, DUPLICATE = "b", "d"

Cell = dict  # (p, q) -> (cost, audit)


# --- parsing ---------------------------------------------------------------

def join(left: Cell, right: Cell) -> Cell:
    """pq -> pr rq: the cell of two neighbouring spans."""
    out: Cell = {}
    for (p, r), (c1, a1) in left.items():
        for q in range(4):
            if (other := right.get((r, q))) is not None:
                cost = c1 + other[0]
                have = out.get((p, q))
                if have is None or cost < have[0] or (cost == have[0] and a1 + other[1] < have[1]):
                    out[p, q] = (cost, a1 + other[1])
    return out


def _inserted() -> Cell:
    """Insertions alone, up to two between any two states."""
    out: Cell = {(p, p): (0, "") for p in range(4)}
    for p in range(4):
        q, n = p, 0
        while (q := NEXT[q]) and (n := n + 1) <= 2:
            if (p, q) not in out:
                out[p, q] = (INSERT * n, "I" * n)
    return out


INSERTED = _inserted()


@lru_cache(None)
def row_cell(symbol: str) -> Cell:
    """One row: its cheapest edit between any two states."""
    edits: Cell = {(p, p): (DELETE, "D") for p in range(4)}
    if symbol not in (BLANK, DUPLICATE):
        more = TRUNCATED if symbol.isupper() else 0
        for p, q in NEXT.items():
            edits[p, q] = (REROLE + more, "R")
        for p, q in KEEPS.get(symbol.lower(), ()):
            edits[p, q] = (more, "K")
    return join(join(INSERTED, edits), INSERTED)


class Spans:
    """Cells of neighbouring spans; equal lengths join, so lengths double."""

    def __init__(self):
        self.stack: list[tuple[int, Cell]] = []

    def push(self, cell: Cell, length: int = 1) -> None:
        while self.stack and self.stack[-1][0] <= length:
            n, left = self.stack.pop()
            cell, length = join(left, cell), length + n
        self.stack.append((length, cell))

    def repeat(self, symbol: str, times: int) -> None:
        """A run of one symbol, by doubling."""
        cell, length = row_cell(symbol), 1
        while times:
            if times & 1:
                self.push(cell, length)
            times >>= 1
            if times:
                cell, length = join(cell, cell), 2 * length

    def whole(self) -> Cell:
        out = INSERTED
        for _, cell in reversed(self.stack):
            out = join(cell, out)
        return out


def best(cell: Cell) -> tuple[int, str]:
    """Cheapest derivation from nothing to nothing or to a last assistant."""
    return min(cell[START, q] for q in (START, ASSISTANT) if (START, q) in cell)


def parse(symbols: str) -> tuple[int, str]:
    """(cost, audit) of a conversation."""
    s = Spans()
    for x in symbols:
        s.push(row_cell(x))
    return best(s.whole())


_remembered = lru_cache(50_000)(parse)


def initial(role: str) -> str:
    return role[:1] if role[:1] in ("s", "u", "a") else "x"


def symbol(role: str, blank: bool, truncated: bool) -> str:
    return BLANK if blank else initial(role).upper() if truncated else initial(role)


class Editor:
    """Repaired ``role:text`` lines, as rows pass by in order."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _turn(self) -> str:
        self.state = NEXT[self.state]
        return "user" if self.state == USER else "assistant"

    def inserted(self):
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            yield self._turn() + ":"

    def row(self, role: str, text: str):
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[initial(role)]
            yield f"{role}:{text}"
        elif edit == "R":
            yield f"{self._turn()}:{text}"

    def skip(self, rows: int):
        """Deleted rows, with insertions between them."""
        for _ in range(rows):
            yield from self.row("", "")


# --- rows ------------------------------------------------------------------

def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and m, the number of times that the row is
    there (0: dropped), with the flags ``blank`` and ``truncated``."""
    space = F.lit(" ")
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), space)
    fate = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    df = rows.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), fate.alias("fate"))
    df = df.select(
        "conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fate").isin(0, 1), "").when(F.col("fate") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(F.col("fate") == 0, 0).when(F.col("fate") == 3, 2).otherwise(1).cast("long").alias("m"))
    return flagged(df)


def flagged(df: DataFrame) -> DataFrame:
    end = F.rtrim("text", F.lit(WHITE))
    return df.withColumns({"blank": end == "", "truncated": ~F.substring(end, -1, 1).isin(".", "!", "?")})


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.substring("text", 1, HEAD), F.xxhash64("text")]


RESULT = ("conv_id {}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")


def _tuples(batches, size: int):
    for b in batches:
        yield from zip(*[c.to_pylist() for c in b.columns[:size]])


def _emit(rows, names, types, size: int = 2_000):
    """Record batches of a stream of tuples."""
    import pyarrow as pa

    part = []
    send = lambda: pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*part), types)], names)
    for r in rows:
        part.append(r)
        if len(part) >= size:
            yield send()
            part = []
    if part:
        yield send()


def _types(schema: str):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    s = to_arrow_schema(StructType.fromDDL(schema))
    return s.names, s.types


def _whole(rows) -> tuple:
    """Counts, cost, audit and digest of one conversation's rows, in order."""
    kept, symbols, initials, turns, seen = [], [], [], set(), set()
    for turn, role, text, m, blank, truncated in rows:
        if not m:
            continue
        if turn is not None:
            turns.add(turn)
        first = (role, text) not in seen
        seen.add((role, text))
        run = symbol(role, blank, truncated) if first or blank else DUPLICATE
        symbols.append(run + (BLANK if blank else DUPLICATE) * (m - 1))
        initials.append(initial(role) * m)
        kept.append((role, text, m))
    symbols, initials = "".join(symbols), "".join(initials)
    cost, audit = (_remembered if len(symbols) <= 64 else parse)(symbols)
    edit, lines = Editor(audit), []
    for role, text, m in kept:
        lines += edit.row(role, text)
        lines += edit.skip(m - 1)
    lines += edit.inserted()
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, symbols.count(BLANK), symbols.count(DUPLICATE),
            sum(x.isupper() for x in symbols), sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def short(rows: DataFrame, schema: str) -> DataFrame:
    """Conversations that one task can hold."""
    names, types = _types(schema)
    cols = ("conv_id", "turn", "role", "text", "m", "blank", "truncated")

    def run(batches):
        groups = groupby(_tuples(batches, len(cols)), key=lambda r: r[0])
        yield from _emit(((conv, *_whole(r[1:] for r in g)) for conv, g in groups), names, types)

    return (rows.select(*cols).repartition("conv_id")
            .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *_order()).mapInArrow(run, schema))


# --- conversations of any length -------------------------------------------

PIECE = ("conv_id {}, part long, p array<int>, q array<int>, cost array<long>, audit array<string>, turns long, "
         "first_turn long, last_turn long, head string, tail string, blank long, duplicate long, truncated long, "
         "illegal long")


def _piece(rows) -> tuple:
    """One span: its cell, and counts that add up with those beside it."""
    spans, before, last, first = Spans(), "", None, None
    head, turns, counts = "", 0, {"b": 0, "d": 0, "t": 0, "illegal": 0}
    for turn, role, m, fresh, blank, truncated in rows:
        if not m:
            continue
        if turn is not None and turn != last:
            turns, last, first = turns + 1, turn, turn if first is None else first
        x, rest = symbol(role, blank, truncated) if fresh or blank else DUPLICATE, BLANK if blank else DUPLICATE
        spans.push(row_cell(x))
        spans.repeat(rest, m - 1)
        counts["b"] += m if blank else 0
        counts["d"] += 0 if blank else m - 1 + (x == DUPLICATE)
        counts["t"] += x.isupper()
        i = initial(role)
        counts["illegal"] += (before + i not in LEGAL if before else 0) + (m - 1)   # no role may follow itself
        before, head = i, head or i
    cell = spans.whole()
    keys = list(cell)
    return ([p for p, _ in keys], [q for _, q in keys], [cell[k][0] for k in keys], [cell[k][1] for k in keys],
            turns, first, last, head, before, counts["b"], counts["d"], counts["t"], counts["illegal"])


def _combined(pieces: list[dict]) -> dict:
    """Counts, cost and audit of a conversation from its spans, in order."""
    out = {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
    spans, turns, last, tail, low = Spans(), 0, None, "", None
    for x in pieces:
        for c in ("blank", "duplicate", "truncated", "illegal"):
            out[c] += x[c]
        spans.push({(p, q): (c, a) for p, q, c, a in zip(x["p"], x["q"], x["cost"], x["audit"])})
        if x["first_turn"] is not None:
            turns += x["turns"] - (x["first_turn"] == last)
            low, last = x["first_turn"] if low is None else low, x["last_turn"]
        if x["head"]:
            out["illegal"] += bool(tail) and tail + x["head"] not in LEGAL
            tail = x["tail"]
    out["gaps"] = last - low + 1 - turns if last is not None else 0
    out["cost"], out["audit"] = best(spans.whole())
    return out


def long(rows: DataFrame, schema: str, conv_type: str) -> DataFrame:
    """Conversations of any length, cut into spans."""
    import pyarrow as pa

    counted = rows.groupBy("conv_id", "turn", "role", "text", "blank", "truncated").agg(F.sum("m").alias("m"))
    keyed = counted.withColumn("digest", F.sha2("text", 256))
    firsts = keyed.where("m > 0").groupBy(F.col("conv_id").alias("f_conv"), F.col("role").alias("f_role"),
                                          F.col("digest").alias("f_digest")).agg(
        F.min(F.struct(F.col("turn").isNotNull().alias("has"), F.col("turn").alias("turn"))).alias("f"))
    stored = store(keyed.join(
        firsts, F.col("conv_id").eqNullSafe(F.col("f_conv")) & (F.col("role") == F.col("f_role"))
        & (F.col("digest") == F.col("f_digest")) & F.col("turn").eqNullSafe(F.col("f.turn")), "left")
        .withColumn("fresh", F.col("f_digest").isNotNull())
        .select("conv_id", "turn", "role", "text", "m", "fresh", "blank", "truncated"), "repair-rows")
    piece = PIECE.format(conv_type)
    names, types = _types(piece)
    cols = ("conv_id", "turn", "role", "m", "fresh", "blank", "truncated")

    def spans(batches):
        part = TaskContext.get().partitionId()
        groups = groupby(_tuples(batches, len(cols)), key=lambda r: r[0])
        yield from _emit(((conv, part, *_piece(r[1:] for r in g)) for conv, g in groups), names, types, 16)

    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "head_of_text", "hash_of_text"]
    slim = stored.withColumns({"head_of_text": F.substring("text", 1, HEAD), "hash_of_text": F.xxhash64("text")}).drop("text")
    pieces = store(slim.repartitionByRange(*order).sortWithinPartitions(*order).select(*cols).mapInArrow(spans, piece),
                   "repair-spans")
    verdict = schema.rsplit(",", 1)[0]
    v_names, v_types = _types(verdict)

    def combine(table: pa.Table) -> pa.Table:
        got = _combined(sorted(table.to_pylist(), key=lambda x: x["part"]))
        row = [table["conv_id"][0].as_py(), *[got[c] for c in v_names[1:]]]
        return pa.table([pa.array([x], t) for x, t in zip(row, v_types)], names=v_names)

    verdicts = store(pieces.groupBy("conv_id").applyInArrow(combine, verdict), "repair-verdicts")
    texts = stored.select("conv_id", F.lit(1).alias("rank"), "turn", "role", "text", "m")
    heads = verdicts.select("conv_id", F.lit(0).alias("rank"), F.lit(None).cast("long").alias("turn"),
                            F.lit("").alias("role"), F.lit("").alias("text"), F.lit(0).cast("long").alias("m"),
                            *v_names[1:])
    full_names, full_types = _types(schema)
    both = heads.unionByName(texts, allowMissingColumns=True)

    def digest(batches):
        def results():
            for conv, g in groupby(_tuples(batches, len(both_cols)), key=lambda r: r[0]):
                head = next(g)[6:]
                edit, sha, sep = Editor(head[-1]), hashlib.sha256(), b""

                def write(lines):
                    nonlocal sep
                    for line in lines:
                        sha.update(sep + line.encode())
                        sep = b"\n"

                for r in g:
                    if r[5]:
                        write(edit.row(r[3], r[4]))
                        write(edit.skip(r[5] - 1))
                write(edit.inserted())
                yield (conv, *head, sha.hexdigest())
        yield from _emit(results(), full_names, full_types, 16)

    both_cols = ["conv_id", "rank", "turn", "role", "text", "m", *v_names[1:]]
    return (both.select(*both_cols).repartition("conv_id")
            .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "rank", *_order()).mapInArrow(digest, schema))


def repair(rows: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Counts of faults, cost, audit and digest per conversation, from rows
    (conv_id, turn, role, text, m, blank, truncated) as ``damaged`` or
    ``flagged`` give them."""
    conv_type = rows.schema["conv_id"].dataType.simpleString()
    schema = RESULT.format(conv_type)
    rows = rows.withColumn("turn", F.col("turn").cast("long"))
    large = store(rows.groupBy(F.col("conv_id").alias("l_conv")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b"))
        .where((F.col("n") > max_rows) | (F.col("b") > max_bytes)).select("l_conv"), "repair-large")
    if large.isEmpty():
        return short(rows, schema)
    same = F.col("conv_id").eqNullSafe(F.col("l_conv"))
    return short(rows.join(large, same, "left_anti"), schema).unionByName(
        long(rows.join(large, same, "left_semi"), schema, conv_type))


def report(conversations: DataFrame) -> DataFrame:
    """The columns of ``RESULT`` for ``conversations`` after damage."""
    return repair(damaged(conversations))
