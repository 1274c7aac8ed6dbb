"""Operator 11: conversations repaired by a run-length dynamic program.

Rows of a conversation, in the order of turn (nulls first), ties by role and
then by the MD5 of the text, become symbols: a row that must go (blank, or
equal in role and text to an earlier one), else its role's initial (s, u, a,
or o for any other), in upper case if the text is truncated. Equal
neighbouring symbols collapse into runs. What a symbol allows is a matrix of
costs between the states of the grammar `(s?(ua)+)?`, inserts included;
matrices combine by (min, +). The cheapest cost to the end is carried back
over a run by the cached binary powers of its matrix, so a run of n rows
takes log n products; then the choices are unrolled from the front, always
the letter least in ASCII that keeps the cost. A choice depends only on the
symbol, the state and the differences of the costs ahead, so it is remembered.

In Spark: the first row of each (conversation, role, text) comes from a
partial aggregate and a join by row id; rows are sorted by range, so that a
large conversation spans many tasks, which return runs and counts of their
pieces. A conversation's runs, no more than letters of its audit, meet in one
row. The hash of the repaired text has to be taken in order: rows stream, by
conversation and sorted, past their audit, a batch at a time.

Nulls: a null role or text, like a null conv_id or turn where a key is
written, counts as one space; rows of a null conv_id are one conversation.
Repeated rows are duplicates of each other. An empty table gives an empty
result, a conversation without rows zeros, no edits, and the hash of an empty
text. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.llm.common import columns, drop, prepare, save

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
PIECE = 1 << 16     # rows of a conversation that a task sums up at a time
GONE = "x"          # the symbol of a row that must be deleted
START, S, U, A = range(4)
ENDS = (START, A)
ROLES = {U: "user", A: "assistant"}
_BLANK = " \t\n\x0b\x0c\r"
_FAR = 1 << 40


def expected(state: int) -> int:
    """The state after an inserted or re-roled row: the only one that fits."""
    return A if state == U else U


def kept(state: int, initial: str) -> int | None:
    """The state after a row that stays as it is, if the grammar has one."""
    if initial == "s":
        return S if state == START else None
    if initial == "u":
        return U if state != U else None
    return A if initial == "a" and state == U else None


def moves(state: int, symbol: str) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of a row, letters in ASCII order."""
    if symbol == GONE:
        return [("D", DELETE, state)]
    more = TRUNCATED if symbol.isupper() else 0
    to = kept(state, symbol.lower())
    stay = [] if to is None else [("K", KEEP + more, to)]
    return [("D", DELETE, state), *stay, ("R", REROLE + more, expected(state))]


# -- (min, +) products --------------------------------------------------------

Matrix = tuple[tuple[int, ...], ...]


def _times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(a[i][k] + b[k][j] for k in range(4)) for j in range(4)) for i in range(4))


def _apply(a: Matrix, v: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(min(a[i][k] + v[k] for k in range(4)) for i in range(4))


def _inserts() -> Matrix:
    one = tuple(tuple(0 if i == j else INSERT if j == expected(i) else _FAR for j in range(4)) for i in range(4))
    return _times(one, one)


INSERTS = _inserts()


class Repair:
    """Costs and choices of runs, with what has been worked out before."""

    def __init__(self) -> None:
        self.powers: dict[str, list[Matrix]] = {}
        self.back: dict[tuple, tuple] = {}
        self.choices: dict[tuple, list[tuple[str, int]]] = {}

    def matrix(self, symbol: str, k: int) -> Matrix:
        """The transition of 2^k rows of a symbol, inserts before each."""
        if symbol not in self.powers:
            step = [[_FAR] * 4 for _ in range(4)]
            for q in range(4):
                for _, cost, to in moves(q, symbol):
                    step[q][to] = min(step[q][to], cost)
            self.powers[symbol] = [_times(INSERTS, tuple(map(tuple, step)))]
        known = self.powers[symbol]
        while len(known) <= k:
            known.append(_times(known[-1], known[-1]))
        return known[k]

    def ahead(self, symbol: str, n: int, v: tuple[int, ...]) -> tuple[int, ...]:
        """The cheapest costs to the end before a run, from those after it."""
        k = 0
        while n:
            if n & 1:
                v = _apply(self.matrix(symbol, k), v)
            n >>= 1
            k += 1
        return v

    def choose(self, symbol: str, after: tuple[int, ...]) -> list[tuple[str, int]]:
        """For each state before a row: the letters up to it, and the state
        then; `after` are the costs ahead, less the least of them."""
        if (symbol, after) not in self.choices:
            before = _apply(self.matrix(symbol, 0), after)
            found = []
            for q in range(4):
                letters = ""
                while True:
                    fit = [(c, to) for c, cost, to in moves(q, symbol) if cost + after[to] == before[q]]
                    if INSERT + before[expected(q)] == before[q]:
                        fit.append(("I", expected(q)))
                    c, to = min(fit)
                    letters, q = letters + c, to
                    if c != "I":
                        break
                found.append((letters, q))
            self.choices[symbol, after] = found
        return self.choices[symbol, after]

    def _one_back(self, symbol: str, v: tuple[int, ...]) -> tuple[int, ...]:
        if (symbol, v) not in self.back:
            self.back[symbol, v] = _least(_apply(self.matrix(symbol, 0), v))
        return self.back[symbol, v]

    def plan(self, runs: list[tuple[str, int]]) -> tuple[int, str]:
        """The cheapest cost, and the audit least in ASCII of that cost."""
        end = _apply(INSERTS, tuple(0 if q in ENDS else _FAR for q in range(4)))
        costs = [end]
        for symbol, n in reversed(runs):
            costs.append(self.ahead(symbol, n, costs[-1]))
        costs.reverse()
        audit, q = [], START
        for (symbol, n), after in zip(runs, costs[1:]):
            v, within = _least(after), []
            for _ in range(n):
                within.append(self.choose(symbol, v))
                v = self._one_back(symbol, v)
            for choice in reversed(within):
                letters, q = choice[q]
                audit.append(letters)
        while q not in ENDS:
            audit.append("I")
            q = expected(q)
        return costs[0][START], "".join(audit)


def _least(v: tuple[int, ...]) -> tuple[int, ...]:
    low = min(v)
    return tuple(x - low for x in v)


def collapse(symbols) -> list[tuple[str, int]]:
    """Runs of equal neighbours; items are (symbol, count)."""
    return [(s, sum(n for _, n in g)) for s, g in groupby(symbols, key=lambda x: x[0])]


# -- the rows -----------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): rows dropped, emptied, cut, repeated or
    given to the user, by crc32 of `conv_id:turn` modulo 20."""
    rows = columns(conversations, "conv_id", "turn", "role", "text").select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = rows.withColumn("fault", F.crc32(key.cast("binary")) % 20).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.sequence(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("_")).drop("_")


def _symbols(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, h, rid, initial, fault, symbol) of saved rows."""
    same = rows.groupBy("conv_id", "role", "h").agg(F.min(F.struct("turn", "rid")).alias("first"))
    firsts = same.select(F.col("first.rid").alias("rid"), F.lit(True).alias("is_first"))
    rows = rows.drop("text").join(firsts, "rid", "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("is_first").isNull(), "duplicate").when(F.col("truncated"), "truncated")
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    symbol = F.when(fault.isin("blank", "duplicate"), GONE).when(fault == "truncated", F.upper(known)).otherwise(known)
    return rows.select("conv_id", "turn", "role", "h", "rid", initial.alias("initial"), fault.alias("fault"), symbol.alias("symbol"))


_PIECE = ("conv_id bigint, part int, seq bigint, symbols array<string>, lengths array<bigint>, blank bigint, duplicate bigint, "
          "truncated bigint, illegal bigint, first string, last string, low bigint, high bigint, turns bigint")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over sorted rows, for each conversation of the task and PIECE rows."""
    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int64()), ("symbols", pa.list_(pa.string())),
                        ("lengths", pa.list_(pa.int64())), *((n, pa.int64()) for n in ("blank", "duplicate", "truncated", "illegal")),
                        ("first", pa.string()), ("last", pa.string()), *((n, pa.int64()) for n in ("low", "high", "turns"))])
    now, n, seq, done = None, 0, 0, []
    for b in batches:
        got = [b.column(b.schema.get_field_index(c)).to_pylist() for c in ("conv_id", "part", "turn", "initial", "fault", "symbol")]
        for conv, part, turn, initial, fault, symbol in zip(*got):
            if now is None or now["conv_id"] != conv or n >= PIECE:
                if now:
                    done.append(now)
                now, n, seq = {"conv_id": conv, "part": part, "seq": seq, "symbols": [], "lengths": [], "blank": 0, "duplicate": 0,
                               "truncated": 0, "illegal": 0, "first": initial, "last": None, "low": None, "high": None, "turns": 0}, 0, seq + 1
            n += 1
            if fault:
                now[fault] += 1
            if now["last"] is not None:
                now["illegal"] += now["last"] + initial not in ("su", "ua", "au")
            now["last"] = initial
            if turn is not None and turn != now["high"]:
                now["low"] = turn if now["low"] is None else now["low"]
                now["high"] = turn
                now["turns"] += 1
            if now["symbols"] and now["symbols"][-1] == symbol:
                now["lengths"][-1] += 1
            else:
                now["symbols"].append(symbol)
                now["lengths"].append(1)
        if len(done) >= 1000:
            yield pa.RecordBatch.from_pylist(done, schema)
            done = []
    if now:
        done.append(now)
    if done:
        yield pa.RecordBatch.from_pylist(done, schema)


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _plans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts, cost and audit of each conversation from its pieces in order."""
    repair = Repair()
    schema = pa.schema([("conv_id", pa.int64()), *((n, pa.int64()) for n in _COUNTS), ("audit", pa.string())])
    for b in batches:
        rows = []
        for conv, pieces in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            out = dict.fromkeys(_COUNTS, 0) | {"conv_id": conv}
            low = high = last = None
            turns, runs = 0, []
            for p in pieces:
                if not p["symbols"]:
                    continue
                for n in ("blank", "duplicate", "truncated", "illegal"):
                    out[n] += p[n]
                if last is not None:
                    out["illegal"] += last + p["first"] not in ("su", "ua", "au")
                last = p["last"]
                if p["turns"]:
                    turns += p["turns"] - (p["low"] == high)
                    low, high = p["low"] if low is None else low, p["high"]
                runs += zip(p["symbols"], p["lengths"])
            if turns:
                out["gaps"] = high - low + 1 - turns
            out["cost"], out["audit"] = repair.plan(collapse(runs))
            rows.append(out)
        yield pa.RecordBatch.from_pylist(rows, schema)


class _Text:
    """The repaired text of one conversation, as a running hash."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.hash, self.any = audit, 0, START, hashlib.sha256(), False

    def _line(self, role: str, text: str, state: int) -> None:
        self.hash.update((("\n" if self.any else "") + role + ":" + text).encode())
        self.any, self.state = True, state

    def inserts(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            self._line(ROLES[expected(self.state)], "", expected(self.state))

    def row(self, role: str, text: str) -> None:
        self.inserts()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self._line(role, text, kept(self.state, role[:1]))
        elif letter == "R":
            self._line(ROLES[expected(self.state)], text, expected(self.state))

    def digest(self) -> str:
        self.inserts()
        return self.hash.hexdigest()


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows, each conversation's plan first: the finished results."""
    schema = pa.schema([("conv_id", pa.int64()), *((n, pa.int64()) for n in _COUNTS), ("audit", pa.string()), ("repaired_sha256", pa.string())])
    now, text, done = None, None, []
    for b in batches:
        names = ("conv_id", *_COUNTS, "audit", "role", "text")
        for conv, *counts, audit, role, words in zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in names)):
            if audit is None:
                text.row(role, words)
                continue
            if now:
                done.append(now | {"repaired_sha256": text.digest()})
            now, text = {"conv_id": conv, "audit": audit} | dict(zip(_COUNTS, counts)), _Text(audit)
        if len(done) >= 1000:
            yield pa.RecordBatch.from_pylist(done, schema)
            done = []
    if now:
        done.append(now | {"repaired_sha256": text.digest()})
    if done:
        yield pa.RecordBatch.from_pylist(done, schema)


def repair(conversations: DataFrame, originals: DataFrame | None = None) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256) of the conversations of `conversations` (conv_id, turn,
    role, text), and of the conv_ids in `originals`, which may have no rows."""
    spark = conversations.sparkSession
    prepare(spark)
    bare = F.expr("trim(TRAILING ' \\t\\n\\u000b\\f\\r' FROM text)")
    rows = columns(conversations, "conv_id", "turn", "role", "text").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    rows = rows.withColumn("_end", F.right(bare, F.lit(1))).select(
        "*", F.unhex(F.md5(F.col("text").cast("binary"))).alias("h"), F.monotonically_increasing_id().alias("rid"),
        (F.col("_end") == "").alias("blank"), (~F.col("_end").isin(".", "!", "?", "")).alias("truncated")).drop("_end")
    rows, rpath = save(rows, "op11-rows")
    order = ["turn", "role", "h", "rid"]
    symbols, spath = save(_symbols(rows), "op11-symbols")
    pieces = (symbols.repartitionByRange("conv_id", *order).sortWithinPartitions("conv_id", *order)
              .select("conv_id", F.spark_partition_id().alias("part"), "turn", "initial", "fault", "symbol")
              .mapInArrow(_pieces, _PIECE))
    ids = conversations if originals is None else originals
    empty = columns(ids, "conv_id").select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct().select(
        "conv_id", F.lit(-1).alias("part"), F.lit(0).cast("bigint").alias("seq"))
    pieces = pieces.unionByName(empty, allowMissingColumns=True)
    body = F.struct(*[c for c in pieces.columns if c != "conv_id"])
    plans = pieces.groupBy("conv_id").agg(F.sort_array(F.collect_list(body)).alias("pieces")).mapInArrow(
        _plans, "conv_id bigint, " + ", ".join(f"{n} bigint" for n in _COUNTS) + ", audit string")
    plans, ppath = save(plans, "op11-plans")
    both = plans.unionByName(rows.drop("blank", "truncated"), allowMissingColumns=True)
    out = (both.repartition("conv_id").sortWithinPartitions("conv_id", F.col("audit").isNull(), *order)
           .mapInArrow(_hashes, "conv_id bigint, " + ", ".join(f"{n} bigint" for n in _COUNTS) + ", audit string, repaired_sha256 string"))
    out, _ = save(out, "op11-out")
    drop(spark, rpath, spath, ppath)
    return out
