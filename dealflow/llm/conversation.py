"""Conversation structure repair: a generalised LR parser over a grammar of role initials, whose
edits (keep, rerole, delete, insert) have costs.

``RoleGrammar`` builds the LR(0) automaton of the grammar. A parse holds a graph-structured stack:
nodes (state, node below) that are shared, so equal stack tops are one node, which keeps the
minimum (cost, audit) of all edit sequences that lead there. Two edit sequences of equal cost that
consume the same rows never have one as a prefix of the other (it would have fewer inserts, at a
lower cost), so the minimum of audits is also the minimum of all their continuations.

A conversation may hold a third of all rows. Its rows are therefore parsed in runs: the parser
starts a run from every stack that the grammar allows, which gives a small table of (stack before,
stack after) -> (cost, audit); the tables of a conversation's runs are multiplied pairwise.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealflow.llm.common import WS, arrow_schema, cut, kept, map_arrow

#: Fixed: the grammar (s?(ua)+)? of role initials, what a conversation may add, and the costs.
RULES = (("Talk", ("u", "a")), ("Talk", ("s", "u", "a")), ("Talk", ("Talk", "u", "a")))
NEW = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
LEGAL = ("su", "ua", "au")


class RoleGrammar:
    """``rules``: (name, (symbols)); the first name is the start, and an empty sequence is accepted too.
    Stacks are tuples of states nested as (state, stack below); they are finite in number for a
    grammar that doesn't nest (others are an error), so a run's table is finite."""

    def __init__(self, rules=RULES, most_stacks: int = 64):
        self.rules = (("", (rules[0][0],)), *rules)
        names = {name for name, _ in rules}

        def close(items):
            items, todo = set(items), list(items)
            while todo:
                r, dot = todo.pop()
                after = self.rules[r][1][dot:][:1]
                for i, (name, _) in enumerate(self.rules):
                    if after == (name,) and (i, 0) not in items:
                        items.add((i, 0))
                        todo.append((i, 0))
            return frozenset(items)

        states, self.goto, self.reduces = [close({(0, 0)})], {}, {}
        for at, items in enumerate(states):
            self.reduces[at] = [r for r, dot in items if r and dot == len(self.rules[r][1])]
            for symbol in sorted({self.rules[r][1][dot] for r, dot in items if dot < len(self.rules[r][1])}):
                nxt = close({(r, dot + 1) for r, dot in items if self.rules[r][1][dot: dot + 1] == (symbol,)})
                if nxt not in states:
                    states.append(nxt)
                self.goto[at, symbol] = states.index(nxt)
        self.live = {at for at, _ in self.goto} | {self.goto[0, rules[0][0]]}
        self.terminals = sorted({x for _, right in rules for x in right} - names)
        bottom = (0, None)
        self.stacks, self.shift = [bottom], {}
        for stack in self.stacks:
            for t in self.terminals:
                self.shift[stack, t] = after = self.shifted(stack, t)
                self.stacks += [x for x in after if x not in self.stacks]
            if len(self.stacks) > most_stacks:
                raise ValueError("the grammar nests: its stacks are not finite in number")
        self.number = {s: i for i, s in enumerate(self.stacks)}
        self.moves = [{t: [self.number[x] for x in self.shift[s, t]] for t in self.terminals} for s in self.stacks]
        self.accepts = {i for i, s in enumerate(self.stacks) if s == bottom or s == (self.goto[0, rules[0][0]], bottom)}

    def shifted(self, stack, symbol):
        """The stacks after ``symbol``, with every reduction done or not done where a state allows both."""
        if (stack[0], symbol) not in self.goto:
            return []
        todo, out = [(self.goto[stack[0], symbol], stack)], []
        while todo:
            top = todo.pop()
            if top[0] in self.live:
                out.append(top)
            for r in self.reduces[top[0]]:
                below = top
                for _ in self.rules[r][1]:
                    below = below[1]
                todo.append((self.goto[below[0], self.rules[r][0]], below))
        return out

    def inserted(self, tops: dict) -> dict:
        """``tops`` (stack number -> (cost, audit)) with all that inserted turns lead to. Costs only rise,
        so taking the cheapest first settles each stack once."""
        tops, open_ = dict(tops), set(tops)
        while open_:
            at = min(open_, key=tops.__getitem__)
            open_.discard(at)
            cost, audit = tops[at]
            new = (cost + INSERT, audit + "I")
            for t in NEW:
                for to in self.moves[at][t]:
                    if to not in tops or new < tops[to]:
                        tops[to] = new
                        open_.add(to)
        return tops

    def consumed(self, tops: dict, symbol: str) -> dict:
        """``tops`` after one row: ``symbol`` is its role's initial (upper case: the row is truncated), ``d``
        for a row that must go, and any other character for a role outside the grammar."""
        out = {}

        def merge(to, new):
            if to not in out or new < out[to]:
                out[to] = new

        role, extra = symbol.lower(), TRUNCATED if symbol.isupper() else 0
        for at, (cost, audit) in self.inserted(tops).items():
            merge(at, (cost + DELETE, audit + "D"))
            if symbol == "d":
                continue
            for to in self.moves[at].get(role, ()):
                merge(to, (cost + extra, audit + "K"))
            for t in NEW:
                for to in self.moves[at][t]:
                    merge(to, (cost + extra + REROLE, audit + "R"))
        return out

    def table(self, symbols: list[tuple[str, int]], entries) -> list[tuple[int, int, int, str]]:
        """(stack before, stack after, cost, audit) of a run of (symbol, times), from each of ``entries``. A
        symbol that repeats is ``d``: an insert between two deletions is never better than one after."""
        out = []
        for entry in entries:
            tops = {entry: (0, "")}
            for symbol, times in symbols:
                tops = self.consumed(tops, symbol)
                if times > 1:
                    tops = {at: (cost + DELETE * (times - 1), audit + "D" * (times - 1)) for at, (cost, audit) in tops.items()}
            out += [(entry, at, cost, audit) for at, (cost, audit) in tops.items()]
        return out

    def product(self, first, second):
        """The table of two runs, one after the other."""
        after = {}
        for a, b, cost, audit in second:
            after.setdefault(a, []).append((b, cost, audit))
        best = {}
        for a, b, cost, audit in first:
            for c, more, rest in after.get(b, ()):
                old = best.get((a, c))
                if old is None or cost + more < old[0] or (cost + more == old[0] and audit + rest < old[1]):
                    best[a, c] = (cost + more, audit + rest)
        return [(a, c, *v) for (a, c), v in best.items()]

    def finish(self, table) -> tuple[int, str]:
        """The cheapest edits of a whole conversation, of equal ones the least audit."""
        ends = self.inserted({b: (cost, audit) for a, b, cost, audit in table if a == 0}) if table else {0: (0, "")}
        return min(ends[i] for i in ends if i in self.accepts)


def blank(text: Column) -> Column:
    return F.length(F.btrim(text, F.lit(WS))) == 0


def truncated(text: Column) -> Column:
    """The last character that is not white space is none of ``.!?``."""
    return ~F.substring(F.btrim(text, F.lit(WS)), -1, 1).isin(".", "!", "?")


def damage(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, copies): nulls in role, text and the key are one space; by crc32 of
    ``conv_id:turn`` modulo 20 a row is dropped (0: no copies), emptied (1), loses its ``.!?`` (2), is
    repeated (3: two copies), or gets the role user (4)."""
    c = {n: F.col(f"`{v}`") for n, v in (("conv_id", conv_id), ("turn", turn), ("role", role), ("text", text))}
    part = lambda n: F.coalesce(c[n].cast("string"), F.lit(" "))
    code = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    return rows.select(
        c["conv_id"].cast("bigint").alias("conv_id"), c["turn"].cast("bigint").alias("turn"),
        F.when(code == 4, "user").otherwise(part("role")).alias("role"),
        F.when(code == 1, "").when(code == 2, F.regexp_replace(part("text"), "[.!?]", "")).otherwise(part("text")).alias("text"),
        F.when(code == 0, 0).when(code == 3, 2).otherwise(1).cast("bigint").alias("copies"))


ORDER = ("turn", "role", "h1", "h2")
RUN = ("part bigint, n bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, head string, tail string, "
       "low bigint, high bigint, turns bigint, first bigint, last bigint, table array<struct<a: int, b: int, cost: bigint, audit: string>>")


def pair_is_legal(a: str, b: str) -> bool:
    return a + b in LEGAL


class Run:
    """A run of a conversation's rows, in order, before it is parsed."""

    def __init__(self):
        self.symbols, self.size, self.n = [], 0, 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.head, self.tail = 0, None, None
        self.low = self.high = self.first = self.last = None
        self.turns = 0

    def add(self, turn, initial, copies, is_first, is_blank, is_cut):
        if self.tail is None:
            self.head, self.first = initial, turn
        else:
            self.illegal += not pair_is_legal(self.tail, initial)
        self.illegal += 0 if pair_is_legal(initial, initial) else copies - 1
        if turn is not None:
            self.turns += self.high is None or turn != self.last
            self.low, self.high = turn if self.low is None else self.low, turn
        self.tail, self.last = initial, turn
        self.n += copies
        stays = is_first and not is_blank
        if is_blank:
            self.faults["blank"] += copies
        else:
            self.faults["duplicate"] += copies - stays
            self.faults["truncated"] += stays and is_cut
        if stays:
            self.symbols.append(((initial.upper() if is_cut else initial) if initial in ("s", "u", "a") else "O" if is_cut else "o", 1))
        if copies > stays:
            if self.symbols and self.symbols[-1][0] == "d":
                self.symbols[-1] = ("d", self.symbols[-1][1] + copies - stays)
            else:
                self.symbols.append(("d", copies - stays))


def parsed(grammar: RoleGrammar, run: Run, whole: bool, tables: dict):
    """The run's row of columns; tables are remembered by the run's symbols."""
    key = (whole, tuple(run.symbols))
    table = tables.get(key)
    if table is None:
        table = grammar.table(run.symbols, [0] if whole else range(len(grammar.stacks)))
        if len(run.symbols) <= 32 and sum(n for _, n in run.symbols) <= 64:
            if len(tables) > 50_000:
                tables.clear()
            tables[key] = table
    return (run.n, *run.faults.values(), run.illegal, run.head, run.tail, run.low, run.high, run.turns, run.first, run.last,
            [{"a": a, "b": b, "cost": c, "audit": s} for a, b, c, s in table])


def runs_of(rows: DataFrame, run_rows: int) -> DataFrame:
    """``rows`` (sorted runs of whole partitions) as parsed runs of at most ``run_rows`` different rows."""
    schema = f"conv_id bigint, {RUN}"
    arrow = arrow_schema(schema)

    def run(batches):
        grammar, tables = kept("role grammar", lambda: (RoleGrammar(), {}))
        part, n_out, now, conv, begins = TaskContext.get().partitionId(), 0, None, None, False
        out = []

        def close():
            nonlocal n_out
            out.append((conv, (part << 40) + n_out, *parsed(grammar, now, begins, tables)))
            n_out += 1

        def batch_out():
            cols = list(zip(*out, strict=True))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)

        for batch in batches:
            for c, turn, initial, copies, is_first, is_blank, is_cut in zip(*[batch.column(i).to_pylist() for i in range(7)], strict=True):
                if now is None or c != conv or len(now.symbols) >= run_rows:
                    # A partition's first conversation may have begun in the partition before.
                    fresh = now is not None and c != conv
                    if now is not None:
                        close()
                    now, conv, begins = Run(), c, fresh
                now.add(turn, initial, copies, is_first, is_blank, is_cut)
            if len(out) >= 5000:
                yield batch_out()
        if now is not None:
            close()
        if out:
            yield batch_out()

    return map_arrow(rows, run, schema)


class Folded:
    """What a conversation's runs give together. Tables of equal depth are multiplied, so an audit's
    characters are copied a logarithmic number of times."""

    def __init__(self, grammar):
        self.grammar, self.tables, self.sums = grammar, [], [0] * 4
        self.tail = self.last = self.low = self.high = None
        self.turns = self.n = 0

    def add(self, r: dict):
        self.n += r["n"]
        for i, k in enumerate(("blank", "duplicate", "truncated", "illegal")):
            self.sums[i] += r[k]
        if self.tail is not None:
            self.sums[3] += not pair_is_legal(self.tail, r["head"])
        self.turns += r["turns"] - (self.last is not None and self.last == r["first"])
        self.low = r["low"] if self.low is None else self.low
        self.high = self.high if r["high"] is None else r["high"]
        self.tail, self.last = r["tail"], r["last"]
        self.tables.append((0, [(x["a"], x["b"], x["cost"], x["audit"]) for x in r["table"]]))
        while len(self.tables) > 1 and self.tables[-1][0] == self.tables[-2][0]:
            (_, right), (depth, left) = self.tables.pop(), self.tables.pop()
            self.tables.append((depth + 1, self.grammar.product(left, right)))

    def result(self):
        table = None
        for _, t in self.tables:
            table = t if table is None else self.grammar.product(table, t)
        cost, audit = self.grammar.finish(table)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (gaps, *self.sums, cost, audit)


class Repaired:
    """The digest of a repaired conversation, row by row as the rows come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.sha, self.n, self.next = audit, 0, hashlib.sha256(), 0, "u"

    def put(self, role: bytes, text: bytes):
        self.sha.update((b"\n" if self.n else b"") + role + b":")
        self.sha.update(text)
        self.n += 1

    def inserts(self):
        while self.audit.startswith("I", self.at):
            self.put(NEW[self.next].encode(), b"")
            self.next = "a" if self.next == "u" else "u"
            self.at += 1

    def row(self, role: bytes, text: bytes):
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "D":
            return
        if edit == "K" and not self.n and role[:1] == b"s":
            self.put(role, text)
            return
        self.put(NEW[self.next].encode() if edit == "R" else role, text)
        self.next = "a" if self.next == "u" else "u"

    def digest(self) -> str:
        self.inserts()
        return self.sha.hexdigest()


RESULT = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def repair(damaged: DataFrame, run_rows: int = 256) -> DataFrame:
    """One row for every conv_id of ``damaged`` (rows as ``damage`` returns them): (conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256).

    1. Rows without their texts, but with hashes of them, are written as a table. Equal rows are
       counted, and the first of each (conversation, role, text) is marked, both by aggregates with
       partial combine, so that no repeated row, text or conversation is a hot group.
    2. The rest is range-partitioned by (conv_id, turn, role, text's hash): a long conversation
       spreads over as many partitions as it needs. Each is parsed in runs of ``run_rows`` rows.
    3. Runs and texts meet by conversation, sorted, as a stream: runs come first and are multiplied,
       then the rows, which feed the digest. A task holds one batch and one conversation's audit (one
       character a row), never a conversation's texts. The digest of one conversation is
       sequential by definition; that is all that a long conversation leaves to one task.

    The order within a conversation is by turn, nulls first; rows of one turn by role, then by the
    text's 64-bit hashes, so equal rows are neighbours. A null conv_id is a conversation of its own.
    Conversations without a row after damage have zeros, an empty audit and the hash of nothing. No
    rows give no rows."""
    hashed = damaged.select("*", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit("text"), "text").alias("h2"))
    light = cut(hashed.select("conv_id", "turn", "role", "h1", "h2", "copies", blank(F.col("text")).alias("blank"), truncated(F.col("text")).alias("cut")), "turns")
    here = light.where("copies > 0")
    first = (here.groupBy("conv_id", "role", "h1", "h2").agg(F.min(F.struct(F.col("turn").isNotNull().alias("given"), "turn")).alias("at"))
             .select("conv_id", F.col("at.turn").alias("turn"), "role", "h1", "h2", F.lit(0).cast("bigint").alias("copies"), F.lit(False).alias("blank"), F.lit(False).alias("cut"), F.lit(True).alias("first")))
    marked = (here.withColumn("first", F.lit(False)).unionByName(first).groupBy("conv_id", *ORDER)
              .agg(F.sum("copies").alias("copies"), *[F.max(c).alias(c) for c in ("first", "blank", "cut")]))
    ranged = (marked.repartitionByRange("conv_id", *ORDER).sortWithinPartitions("conv_id", *ORDER)
              .select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "copies", "first", "blank", "cut"))
    runs = cut(runs_of(ranged, run_rows), "runs")
    run = F.struct(*[c for c in runs.columns if c != "conv_id"])
    blanks = {"run": F.lit(None).cast(runs.select(run.alias("run")).schema["run"].dataType), "at": F.lit(0).cast("bigint"), "by": F.lit(""), "h1": F.lit(0).cast("bigint"),
              "h2": F.lit(0).cast("bigint"), "role": F.lit(None).cast("binary"), "text": F.lit(None).cast("binary"), "copies": F.lit(0).cast("bigint")}
    lane = lambda df, kind, **own: df.select("conv_id", F.lit(kind).alias("kind"), *[own.get(c, v).alias(c) for c, v in blanks.items()])
    rows = lane(hashed.where("copies > 0"), 2, at=F.col("turn"), by=F.col("role"), h1=F.col("h1"), h2=F.col("h2"), copies=F.col("copies"),
                role=F.encode("role", "UTF-8"), text=F.encode("text", "UTF-8"))
    stream = (lane(light.select("conv_id").distinct(), 0).unionByName(lane(runs, 1, run=run, at=F.col("part"))).unionByName(rows).repartition("conv_id")
              .sortWithinPartitions("conv_id", "kind", "at", "by", "h1", "h2").select("conv_id", "kind", "run", "role", "text", "copies"))
    return map_arrow(stream, repaired(arrow_schema(RESULT)), RESULT)


def repaired(schema: pa.Schema):
    """The stream of one partition (conversation by conversation: its id, its runs, its rows) as results."""

    def results(batches):
        grammar = kept("role grammar", lambda: (RoleGrammar(), {}))[0]
        out, conv, folded, values, text = [], None, None, None, None

        def settle():
            nonlocal values, text
            if values is None:
                values = folded.result()
                text = Repaired(values[-1])

        def close():
            settle()
            out.append(dict(zip(schema.names, (conv, *values, text.digest()), strict=True)))

        for batch in batches:
            for c, kind, run, role, content, copies in zip(*[batch.column(i).to_pylist() for i in range(6)], strict=True):
                if kind == 0:
                    if folded is not None:
                        close()
                    conv, folded, values, text = c, Folded(grammar), None, None
                elif kind == 1:
                    folded.add(run)
                else:
                    settle()
                    for _ in range(copies):
                        text.row(role, content)
            if len(out) >= 5000:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out.clear()
        if folded is not None:
            close()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return results
