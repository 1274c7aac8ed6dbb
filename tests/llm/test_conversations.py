import hashlib
import random
import re
import zlib

import pytest

from cinerank.llm.conversations import Repair, collapse, damaged, moves, repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string, audit string, part int"
WS = " \t\n\x0b\x0c\r"


def harm(rows):
    out = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        f = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if f:
            row = (c, t, "user" if f == 4 else role, "" if f == 1 else re.sub("[.!?]", "", text) if f == 2 else text)
            out += [row] * (2 if f == 3 else 1)
    return out


def cheapest(rows):
    """rows: (role, text, fault). Least (cost, audit) into each state; the repaired lines."""
    word = {"u": "user", "a": "assistant"}
    fits = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def inserted(best):
        for _ in range(3):
            for q, (cost, audit, lines) in list(best.items()):
                for r in "ua":
                    if (to := fits.get((q, r))) is not None:
                        new = (cost + 2, audit + "I", (*lines, word[r] + ":"))
                        if to not in best or new[:2] < best[to][:2]:
                            best[to] = new
        return best
    best = inserted({"": (0, "", ())})
    for role, text, fault in rows:
        after = {}
        for q, (cost, audit, lines) in best.items():
            ways = [(3, "D", q, lines)]
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if (to := fits.get((q, role[:1]))) is not None:
                    ways.append((extra, "K", to, (*lines, f"{role}:{text}")))
                ways += [(2 + extra, "R", fits[q, r], (*lines, f"{word[r]}:{text}")) for r in "ua" if (q, r) in fits]
            for c, a, to, new in ways:
                if to not in after or (cost + c, audit + a) < after[to][:2]:
                    after[to] = (cost + c, audit + a, new)
        best = inserted(after)
    return min(best[q] for q in ("", "a") if q in best)


def brute(rows, ids):
    out = []
    for c in set(ids):
        mine = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).digest()))
        seen, marked = set(), []
        for _, _, role, text in mine:
            bare = text.rstrip(WS)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = {r[1] for r in mine if r[1] is not None}
        count = [sum(m[2] == f for m in marked) for f in ("blank", "duplicate", "truncated")]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, audit, lines = cheapest(marked)
        out.append((c, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *count, illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows, harmed=False):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    out = repair(damaged(df), df) if harmed else repair(df)
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted(map(tuple, out.collect()), key=str)


def random_rows(n, seed):
    rnd = random.Random(seed)
    texts = ["Yes.", "No", "", " \t", "Why?", "x. \n", "end ", "Well!", None, "Yes.", "a.b", "ünï."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"]
    return [(rnd.choice([None, 1, 2, 3, 4, 5, 6, 7]), rnd.choice([None, *range(-2, 12)]), rnd.choice(roles), rnd.choice(texts)) for _ in range(n)]


@pytest.mark.parametrize("harmed", [False, True])
def test_equals_brute_force(spark, harmed):
    rows = random_rows(150, 1)
    plain = harm(rows) if harmed else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert got(spark, rows, harmed) == brute(plain, [r[0] for r in rows])


def test_a_conversation_over_many_tasks(spark):
    rnd = random.Random(2)
    rows = [(9, k // 3, rnd.choice(["user", "assistant", "user", "system"]), rnd.choice(["a.", "b", "c!", f"n{k}.", f"m{k}"])) for k in range(4000)]
    rows += [(k, 0, "user", "Hello.") for k in range(8)] + [(9, None, "user", "Same.")] * 500
    assert got(spark, rows) == brute(rows, [r[0] for r in rows])


def test_empty_and_all_dropped(spark):
    empty = hashlib.sha256(b"").hexdigest()
    assert got(spark, []) == []
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    assert got(spark, [(gone, 0, "user", "Hi.")], harmed=True) == [(gone, 0, 0, 0, 0, 0, 0, "", empty)]
    assert got(spark, [(5, None, None, None)]) == [(5, 0, 1, 0, 0, 0, 3, "D", empty)]


def test_very_long_text(spark):
    long = "word " * 400_000
    rows = [(1, 0, "user", long), (1, 1, "assistant", long + "."), (1, 2, "user", " " * 1_000_000)]
    assert got(spark, rows) == brute(rows, [1])


def test_plans_of_runs_equal_the_row_by_row_search():
    rnd = random.Random(3)
    known = Repair()
    as_row = {"s": ("system", "", ""), "S": ("system", "", "truncated"), "u": ("user", "", ""), "U": ("user", "", "truncated"),
              "a": ("assistant", "", ""), "A": ("assistant", "", "truncated"), "o": ("tool", "", ""), "O": ("tool", "", "truncated"),
              "x": ("user", "", "blank")}
    for _ in range(400):
        runs = collapse([(rnd.choice("sSuUaAoOx"), rnd.choice([1, 1, 1, 2, 3, 9])) for _ in range(rnd.randrange(9))])
        rows = [as_row[s] for s, n in runs for _ in range(n)]
        assert known.plan(runs) == cheapest(rows)[:2], runs


def test_powers_of_a_run():
    known = Repair()
    for symbol in "sSuUaAoOx":
        v = (0, 3, 2, 5)
        step = v
        for _ in range(1000):
            step = known.ahead(symbol, 1, step)
        assert known.ahead(symbol, 1000, v) == step
        assert len(known.powers[symbol]) == 10
        assert [m[0] for m in moves(0, symbol)] == sorted(m[0] for m in moves(0, symbol))
    cost, audit = known.plan([("u", 100_001)])
    assert len(audit.replace("I", "")) == 100_001 and cost == 2 * (audit.count("I") + audit.count("R")) + 3 * audit.count("D")
