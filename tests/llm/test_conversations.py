import hashlib
import random
import zlib
from collections import defaultdict

from tests.llm.helpers import SF
from tabprism.llm import conversations as C
from tabprism.llm import queries

SPACE = " \t\n\x0b\x0c\r"
STATES = ("", "s", "u", "a")


def brute_audit(rows, start="", goals=("", "a")):
    """(cost, audit) by a plain table over (rows taken, last letter); rows: (letter, must go, truncated)."""
    def inserted(row):
        for _ in range(3):  # up to two inserts in a row pay
            for s, best in list(row.items()):
                to = "a" if s == "u" else "u"
                row[to] = min(row.get(to, (1 << 60, "")), (best[0] + 5, best[1] + "I"))
        return row

    now = inserted({start: (0, "")})
    for letter, must, cut in rows:
        then = {}
        for s, (cost, audit) in now.items():
            ways = [(s, cost + 2, audit + "D")]
            if not must:
                more = cost + (5 if cut else 0)
                ways.append(("a" if s == "u" else "u", more + 1, audit + "R"))
                if (s, letter) in {("", "s"), ("", "u"), ("s", "u"), ("a", "u"), ("u", "a")}:
                    ways.append((letter, more, audit + "K"))
            for to, c, a in ways:
                then[to] = min(then.get(to, (1 << 60, "")), (c, a))
        now = inserted(then)
    return min(now[g] for g in goals if g in now)


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def brute(rows, hurt=damage):
    by = defaultdict(list)
    for r in hurt(rows):
        by[r[0]].append(r)
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(by[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()))
        turns = {r[1] for r in own if r[1] is not None}
        seen, judged, faults = set(), [], [0, 0, 0]
        for _, _, role, text in own:
            bare = text.rstrip(SPACE)
            fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                faults[fault] += 1
            judged.append((role[:1], fault in (0, 1), fault == 2))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        cost, audit = brute_audit(judged)
        lines, last, left = [], "", iter(own)
        for e in audit:
            row = next(left) if e != "I" else (None, None, None, "")
            if e == "D":
                continue
            last = row[2][:1] if e == "K" else "a" if last == "u" else "u"
            lines.append((row[2] if e == "K" else {"u": "user", "a": "assistant"}[last]) + ":" + row[3])
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *faults, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def as_dict(df, conv="conv_id"):
    rows = df.collect()
    out = {r[conv]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in rows}
    assert len(out) == len(rows)
    return out


def drawn(draw, n):
    return [(draw.choice(["s", "u", "u", "a", "a", "t", ""]), draw.random() < 0.2, draw.random() < 0.3) for _ in range(n)]


def test_search_equals_the_table():
    draw = random.Random(1)
    for _ in range(3000):
        rows = drawn(draw, draw.randrange(12))
        assert C.search(rows) == brute_audit(rows), rows
    for n in (60, 300):
        rows = drawn(draw, n)
        assert C.search(rows) == brute_audit(rows)


def test_ties_take_the_least_audit():
    assert C.search([]) == (0, "")
    assert C.search([("u", False, False)]) == (2, "D")  # beside an insert for 5
    assert C.search([("u", False, False), ("u", False, False)]) == (1, "KR")
    assert C.search([("s", False, False), ("u", False, False), ("a", False, False)]) == (0, "KKK")
    assert C.search([("u", False, False), ("u", False, False), ("a", False, False)]) == (2, "DKK")


def rows_with_ties():
    draw, rows = random.Random(4), []
    for conv in [None, *range(60)]:
        for turn in range(draw.randrange(1, 14)):
            text = draw.choice(["Yes.", "No", "Long text here!", "  ", "\x0b", "é?", "dup.", "dup."])
            rows.append((conv, draw.choice([turn, turn, turn, None]), draw.choice(["system", "user", "user", "assistant", "assistant", "tool", None, "", "unknown"]), draw.choice([text, text, text, None])))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, mark int, n string, audit string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)


def test_nulls_ties_and_clashing_columns_equal_brute_force(spark):
    rows = rows_with_ties()
    want = brute(rows)
    for parts in (1, 7):
        out, copies = C.damaged(frame(spark, rows).repartition(parts))
        assert as_dict(C.repair(out, copies=copies)) == want


def test_long_conversations_are_solved_in_runs(spark):
    draw = random.Random(9)
    rows = [(1, t, draw.choice(["user", "assistant", "system"]), draw.choice(["a.", "b", f"{t}.", f"{t}!", f"{t}", " "])) for t in range(700)]
    rows += [(c, t, ("user", "assistant")[t % 2], f"{c} {t}.") for c in range(2, 40) for t in range(c % 9 + 1)] + [(50, 3, "user", "Same.")] * 90
    want = brute(rows, hurt=lambda r: r)
    for segment in (1, 5, 64, 512):
        assert as_dict(C.repair(frame(spark, rows), segment=segment)) == want
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # one conversation in several tasks
    try:
        assert as_dict(C.repair(frame(spark, rows))) == want
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_copies_of_a_row_count(spark):
    from pyspark.sql import functions as F
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (2, 0, "user", "Gone."), (3, None, "user", None)]
    n = F.when(F.col("conv_id") == 2, 0).when(F.col("turn") == 1, 3).otherwise(1)
    out = as_dict(C.repair(frame(spark, rows), copies=n))
    assert out[1][1:7] == (0, 2, 0, 2, 4, "KKDD")
    assert out[2] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert out[3] == (0, 1, 0, 0, 0, 2, "D", hashlib.sha256(b"").hexdigest())


def test_very_long_text_and_empty_table(spark):
    rows = [(1, 0, "user", "word " * 300_000 + "."), (1, 1, "assistant", "x" * 1_000_000)]
    assert as_dict(C.repair(frame(spark, rows))) == brute(rows, hurt=lambda r: r)
    out, copies = C.damaged(frame(spark, rows).limit(0))
    assert C.repair(out, copies=copies).collect() == []


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = as_dict(queries.op12_conversation_repair(spark, SF))
    assert got == brute(rows)
    assert any("I" in r[6] for r in got.values()) or any(r[5] for r in got.values())
