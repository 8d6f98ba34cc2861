import hashlib
import itertools
import os
import random
import re
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from dealflow.llm.conversation import RoleGrammar, damage, repair

WS = " \t\n\x0b\x0c\r"
GRAMMAR = re.compile("(s?(ua)+)?")
SCHEMA = "conv_id bigint, turn bigint, role string, text string"
ROLE = {"u": "user", "a": "assistant"}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text, code = " " if role is None else role, " " if text is None else text, zlib.crc32(key.encode()) % 20
        if code == 1:
            text = ""
        if code == 2:
            text = re.sub("[.!?]", "", text)
        out += [(conv, turn, "user" if code == 4 else role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    return out


def faults(rows):
    """(first fault or None) of every row, in order."""
    seen, out = set(), []
    for _, _, role, text in rows:
        bare = text.strip(WS)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else None if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, repaired) from the end: what remains of a conversation depends on the role that must
    come next ('' start, 'u' after a system turn, 'a' after a user's, '.' after a whole pair)."""
    bad = faults(rows)
    after = {("", "s"): "u", ("", "u"): "a", ("u", "u"): "a", ("a", "a"): ".", (".", "u"): "a"}
    best = {q: (0, "", []) if q in ("", ".") else None for q in ("", "u", "a", ".")}

    def insert(best):
        for _ in range(4):
            for q in best:
                for t in "ua":
                    nxt = best.get(after.get((q, t)))
                    if nxt is not None:
                        new = (nxt[0] + 3, "I" + nxt[1], [(ROLE[t], ""), *nxt[2]])
                        best[q] = new if best[q] is None else min(best[q], new)
        return best

    best = insert(best)
    for (_, _, role, text), fault in zip(reversed(rows), reversed(bad), strict=True):
        now = {}
        for q in best:
            ways = [] if best[q] is None else [(best[q][0] + 4, "D" + best[q][1], best[q][2])]
            if fault in (None, "truncated"):
                more = 3 if fault else 0
                for letter, r, cost in (("K", role, 0), ("R", "user", 3), ("R", "assistant", 3)):
                    nxt = best.get(after.get((q, r[:1]))) if letter == "K" or r[:1] in "ua" else None
                    if nxt is not None:
                        ways.append((nxt[0] + more + cost, letter + nxt[1], [(r, text), *nxt[2]]))
            now[q] = min(ways) if ways else None
        best = insert(now)
    return best[""]


def text_hash(text):
    """Spark's xxhash64 of a string."""
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - 2**64 if h >= 2**63 else h


def brute(rows):
    out = []
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in damaged(rows) if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], text_hash(r[3])))
        turns = [r[1] for r in own if r[1] is not None]
        bad = faults(own)
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        cost, audit, fixed = cheapest(own)
        assert GRAMMAR.fullmatch("".join(r[:1] for r, _ in fixed))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((conv, gaps, bad.count("blank"), bad.count("duplicate"), bad.count("truncated"), illegal, cost, audit, digest))
    return sorted(out, key=repr)


def got(df, **options):
    return sorted((tuple(r) for r in repair(damage(df), **options).collect()), key=repr)


def test_parser_against_every_edit():
    """All edits of all short conversations: each row kept, reroled or deleted, up to two inserts between."""
    g = RoleGrammar()
    assert len(g.stacks) == 6
    inserts = ["", "u", "a", "ua", "au"]
    for n in range(4):
        ways = {}
        for edits in itertools.product(("K", "Ru", "Ra", "D"), repeat=n):
            for gaps in itertools.product(inserts, repeat=n + 1):
                audit = "".join("I" * len(i) + e[:1] for i, e in zip(gaps, (*edits, ""), strict=True))
                # the roles it leaves, with * for a kept row's own
                roles = "".join(i + (f"*{k}" if e == "K" else e[1:]) for k, (i, e) in enumerate(zip(gaps, (*edits, ""), strict=True)))
                ways[audit, roles] = edits
        every = list(itertools.product("suaoUSd", repeat=n))
        for symbols in every if n < 3 else random.Random(1).sample(every, 40):
            best = None
            for (audit, roles), edits in ways.items():
                if any(e != "D" and s == "d" for e, s in zip(edits, symbols, strict=True)):
                    continue
                left = re.sub(r"\*(\d)", lambda m, s=symbols: s[int(m[1])].lower(), roles)
                if not GRAMMAR.fullmatch(left):
                    continue
                cost = 3 * audit.count("I") + 4 * audit.count("D") + 3 * audit.count("R") + sum(3 for e, s in zip(edits, symbols, strict=True) if e != "D" and s in "US")
                best = min(best or (cost, audit), (cost, audit))
            assert g.finish(g.table([(s, 1) for s in symbols], [0])) == best, symbols
            halves = g.product(g.table([(s, 1) for s in symbols[:1]], range(6)), g.table([(s, 1) for s in symbols[1:]], range(6)))
            assert n == 0 or g.finish(halves) == best


def test_a_grammar_that_nests_is_an_error():
    with pytest.raises(ValueError):
        RoleGrammar((("Talk", ("u", "Talk", "a")), ("Talk", ("u", "a"))))


def conversations(seed, n, most):
    r = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(r.randrange(1, most)):
            role = r.choice(["user", "assistant", "assistant", "user", "system", "tool", None, "", "User"])
            text = r.choice(["Yes.", "no", "What?", " \t", "", None, f"Text {r.randrange(30)}!", "end. \n", "é…", "a.b"])
            rows.append((conv, None if r.random() < 0.05 else turn, role, text))
    return rows


@pytest.mark.parametrize("run_rows", [2, 256])
def test_against_brute_force(spark, run_rows):
    rows = conversations(7, 150, 14) + [(500, t, "user" if t % 2 == 0 else "assistant", f"Line {t}." if t % 9 else "cut") for t in range(700)]
    rows = [r for i, r in enumerate(rows) if r not in rows[:i] or r[1] is not None]
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(5), run_rows=run_rows) == brute(rows)


def test_edge_cases(spark):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    plain = next(t for t in range(1000) if zlib.crc32(f"9:{t}".encode()) % 20 > 4)
    rows = [(None, None, None, None), (None, 3, "user", "Hi."), (dropped, 0, "user", "gone."), (9, plain, "user", "x" * 200_000 + ".")]
    rows += [(9, plain, "user", "x" * 200_000 + ".")] * 3 + [(-5, -2, "assistant", "One."), (-5, 2, "system", "Two.")]
    df = spark.createDataFrame(rows, SCHEMA)
    clash = df.select("*", *[F.lit("extra").alias(c) for c in ("copies", "h1", "cost", "run", "kind", "TEXTS", "first", "blank", "cut")])
    assert got(clash) == brute(rows)
    empty = [r for r in got(df) if r[0] == dropped][0]
    assert empty[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got(df.limit(0)) == []


def test_a_row_repeated_many_times(spark):
    """One conversation whose one row is repeated 20,000 times: one run of deletions."""
    plain = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 > 4)
    df = spark.range(20_000).select(F.lit(1).cast("bigint").alias("conv_id"), F.lit(plain).cast("bigint").alias("turn"), F.lit("user").alias("role"), F.lit("Hi.").alias("text"))
    r = got(df)[0]
    assert r[:7] == (1, 0, 0, 19_999, 0, 19_999, 4 * 19_999 + 3) and r[7] == "K" + "D" * 19_999 + "I"


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver test data not present")
    df = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert got(df) == brute([tuple(r) for r in df.collect()])


def test_oracle_against_brute_force(spark, tmp_path):
    """The registered SQL on hard conversations (without rows of one turn and role, whose order SQL has not)."""
    import duckdb

    from dealflow.llm.queries import ORACLE

    rows = [(c, t, r, x) for c, t, r, x in conversations(11, 120, 12) if t is not None]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "c"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/c/*.parquet'")
    assert sorted(con.execute(ORACLE["op13_conversation_repair"]).fetchall(), key=repr) == brute(rows)
