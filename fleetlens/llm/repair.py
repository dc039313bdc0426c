"""Repair of the structure of conversations by the auction shortest-path algorithm.

A conversation's rows, in order, and the states of the wanted sequence of roles
(nothing yet, a system turn, a user turn, an assistant turn) span a lattice: from
place ``i`` in a state, Delete (2), Keep (0) and Rerole (1) lead past row ``i``,
Insert (5) to the next state at the same place; a truncated row that stays costs 5
more, blank and repeated rows can only be deleted. A cheapest way through the
lattice is the repair.

:func:`auction` finds it: it holds a price for every node and a path from the
start. While the end of the path has a price below its best arc plus the price
behind it, the price is raised to that and the path contracted by one node, else
the path is extended along the best arc. The prices stay below the true distances,
so all arcs of every cheapest path are tight when the goal is reached; arcs are
tried in the order of their letters, so of all cheapest paths the one traced has
the least letters.

A conversation is cut into blocks of ``BLOCK`` rows. For one of several blocks the
auction first gives the costs between its entry and exit states; a pass from the
last block to the first (four numbers held) turns these into the prices behind each
block, with which every block is traced on its own from each entry state; a pass
forward chooses. The hash of the repaired conversation runs over all its rows in
order, so the rows of one conversation pass through one task, one by one; that task
holds the edits' letters, which are the result, and no texts.

Defined results: null roles and texts are one space; rows of the same turn are
ordered by role and text as given, a repeated row next to its first; a null
``conv_id`` is a conversation of its own; its number and a null turn count as one
space in the checksum; an empty table gives no rows; other columns are ignored.
Texts of any length stay out of the lattice.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import load, shuffle_partitions, staged
from fleetlens.llm.numbering import positions

BLOCK = 64
SPACES = " \t\n\x0b\x0c\r"
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
NONE, SYSTEM, USER, ASSISTANT = range(4)
#: The state that follows by an inserted or renamed turn, and its role.
NEXT = [USER, USER, ASSISTANT, USER]
ROLE = {USER: "user", ASSISTANT: "assistant"}
DELETE, INSERT, RENAME, LATE = 2, 5, 1, 5
FAR = 1 << 40


def kept_state(state: int, initial: str) -> int | None:
    """The state after keeping a turn of this initial, if the order allows it."""
    if initial == "s":
        return SYSTEM if state == NONE else None
    if initial == "u":
        return USER if state != USER else None
    return ASSISTANT if initial == "a" and state == USER else None


def lattice(rows: list[dict], ends: list[int], last: bool) -> list[list[tuple[str, int, int]]]:
    """Arcs ``(letter, cost, node)`` of every node ``4 * place + state``, by letter;
    the goal is the node after them, reached at the cost ``ends`` of the state."""
    goal = 4 * (len(rows) + 1)
    arcs = []
    for i, r in enumerate(rows):
        late = LATE if r["fault"] == TRUNCATED else 0
        for q in range(4):
            here = [("D", DELETE, 4 * i + 4 + q), ("I", INSERT, 4 * i + NEXT[q])]
            if r["fault"] not in (BLANK, DUPLICATE):
                to = kept_state(q, r["initial"])
                if to is not None:
                    here.append(("K", late, 4 * i + 4 + to))
                here.append(("R", RENAME + late, 4 * i + 4 + NEXT[q]))
            arcs.append(here)
    for q in range(4):
        here = [("", ends[q], goal)] if ends[q] < FAR else []
        arcs.append(here + ([("I", INSERT, goal - 4 + NEXT[q])] if last else []))
    return arcs


def auction(arcs: list[list[tuple[str, int, int]]], prices: list[int], start: int) -> str | None:
    """Letters of the cheapest path from ``start`` to the goal, the least of equals;
    None if there is none. ``prices`` rise towards the distances to the goal."""
    goal, path, letters = len(arcs), [start], []
    while path[-1] != goal:
        node = path[-1]
        best, letter, to = FAR, "", -1
        for x, cost, j in arcs[node]:
            if cost + prices[j] < best:
                best, letter, to = cost + prices[j], x, j
        if prices[node] < best:
            prices[node] = best
            if len(path) > 1:
                path.pop()
                letters.pop()
        elif to < 0:
            return None
        else:
            path.append(to)
            letters.append(letter)
    return "".join(letters)


def crossing(rows: list[dict]) -> list[int]:
    """Costs from entry state to exit state (row-major) of a block that is not the last."""
    n, out = len(rows), [FAR] * 16
    out[0] = out[4 * SYSTEM + SYSTEM] = DELETE * n  # nothing but deletions leads there
    system = [LATE if r["fault"] == TRUNCATED else 0 for r in rows
              if r["initial"] == "s" and r["fault"] not in (BLANK, DUPLICATE)]
    if system:
        out[SYSTEM] = DELETE * (n - 1) + min(system)
    for exit_ in (USER, ASSISTANT):
        arcs = lattice(rows, [0 if q == exit_ else FAR for q in range(4)], False)
        prices = [0] * (len(arcs) + 1)
        for q in range(4):
            if auction(arcs, prices, q) is not None:
                out[4 * q + exit_] = prices[q]
    return out


ACCEPTED = [0, FAR, FAR, 0]


def entry_prices(rows: list[dict]) -> list[int]:
    """Distances to the end of the conversation from the entry states of its last block."""
    arcs = lattice(rows, ACCEPTED, True)
    prices = [0] * (len(arcs) + 1)
    for q in range(4):
        auction(arcs, prices, q)
    return prices[:4]


def trace(rows: list[dict], ends: list[int] | None, entry: int) -> dict:
    """Edits of a block from an entry state: letters per row (and after the last
    row), the cost inside the block and the exit state."""
    arcs = lattice(rows, ACCEPTED if ends is None else ends, ends is None)
    prices = [0] * (len(arcs) + 1)
    letters = auction(arcs, prices, entry)
    edits, node, cost = [""] * (len(rows) + 1), entry, 0
    for x in letters:
        edits[node // 4] += x
        _, c, node = next(a for a in arcs[node] if a[0] == x)
        cost += c
    return {"edits": edits, "cost": cost, "exit": node % 4}


_CROSSINGS = pa.schema([("grp", pa.string()), ("block", pa.int64()), ("last", pa.bool_()),
                        ("costs", pa.list_(pa.int64()))])


def _crossings(batches):
    for b in batches:
        yield pa.RecordBatch.from_pylist(
            [{"grp": r["grp"], "block": r["block"], "last": r["last"],
              "costs": entry_prices(r["rows"]) if r["last"] else crossing(r["rows"])} for r in b.to_pylist()], _CROSSINGS)


def _behind(batches):
    """From the last block to the first: the prices behind each block."""
    price = None
    for b in batches:
        out = []
        for r in b.to_pylist():
            if r["last"]:
                price = r["costs"]
                continue
            out.append({"grp": r["grp"], "block": r["block"], "ends": price})
            price = [min(r["costs"][4 * q + e] + price[e] for e in range(4)) for q in range(4)]
        yield pa.RecordBatch.from_pylist(out, pa.schema(
            [("grp", pa.string()), ("block", pa.int64()), ("ends", pa.list_(pa.int64()))]))


_TRACES = pa.schema([("grp", pa.string()), ("block", pa.int64()), ("traces", pa.list_(pa.struct(
    [("edits", pa.list_(pa.string())), ("cost", pa.int64()), ("exit", pa.int32())])))])
_TRACES_SQL = "grp string, block long, traces array<struct<edits:array<string>,cost:long,exit:int>>"


def _traces(batches):
    for b in batches:
        yield pa.RecordBatch.from_pylist(
            [{"grp": r["grp"], "block": r["block"],
              "traces": [trace(r["rows"], r["ends"], q) for q in range(4 if r["block"] else 1)]}
             for r in b.to_pylist()], _TRACES)


def _chosen(batches):
    """From the first block to the last: the trace of the state that the one before leaves."""
    state = NONE
    for b in batches:
        out = []
        for r in b.to_pylist():
            t = r["traces"][state if r["block"] else 0]
            state = t["exit"]
            first, n = BLOCK * r["block"], len(t["edits"]) - 1
            out += [{"grp": r["grp"], "pos": first + i, "edit": t["edits"][i], "cost": 0 if i else t["cost"],
                     "tail": t["edits"][n] if i + 1 == n else ""} for i in range(n)]
        yield pa.RecordBatch.from_pylist(out, pa.schema(
            [("grp", pa.string()), ("pos", pa.int64()), ("edit", pa.string()), ("cost", pa.int64()), ("tail", pa.string())]))


def edits(rows: DataFrame) -> DataFrame:
    """``grp, pos, edit, cost, tail`` of rows ``grp, pos, initial, fault``: letters of
    the edits at each row, and of those after the last one."""
    n = shuffle_partitions(rows.sparkSession)
    block = F.floor(F.col("pos") / BLOCK).alias("block")
    sizes = rows.groupBy("grp").agg(F.floor(F.max("pos") / BLOCK).alias("top"))
    held = staged(rows.groupBy("grp", block)
                  .agg(F.sort_array(F.collect_list(F.struct("pos", "initial", "fault"))).alias("rows"))
                  .join(sizes, "grp").withColumn("last", F.col("block") == F.col("top")), "lattice-blocks")
    costs = held.filter("top > 0").mapInArrow(_crossings, "grp string, block long, last boolean, costs array<long>")
    ends = (costs.repartition(n, "grp").sortWithinPartitions("grp", F.col("block").desc())
            .mapInArrow(_behind, "grp string, block long, ends array<long>"))
    traces = held.drop("top").join(ends, ["grp", "block"], "left").mapInArrow(_traces, _TRACES_SQL)
    return (traces.repartition(n, "grp").sortWithinPartitions("grp", "block")
            .mapInArrow(_chosen, "grp string, pos long, edit string, cost long, tail string"))


def _group(c):
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


def damaged(turns: DataFrame) -> DataFrame:
    """The rows after damage: ``grp, turn, role, text, pos`` in order within ``grp``."""
    t = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                     F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                     F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    named = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                     F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    t = t.withColumn("kind", F.crc32(named.cast("binary")) % 20).filter("kind <> 0")
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    t = t.withColumn("grp", _group(F.col("conv_id"))).withColumn("copy", F.explode(copies))
    placed = positions(t, "grp", [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("copy")], "turns")
    return placed.select(
        "grp", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"), "pos")


def faulted(rows: DataFrame) -> DataFrame:
    """``rows`` with ``initial`` of the role and the first ``fault`` (0: none)."""
    end = F.substring(F.rtrim(F.col("text"), F.lit(SPACES)), -1, 1)
    keyed = rows.withColumn("said", F.sha2("text", 256))
    first = keyed.groupBy("grp", "role", "said").agg(F.min("pos").alias("first"))
    return (keyed.join(first, ["grp", "role", "said"]).select(
        "grp", "turn", "role", "text", "pos", F.substring("role", 1, 1).alias("initial"),
        F.when(end == "", BLANK).when(F.col("pos") > F.col("first"), DUPLICATE)
        .when(~end.isin(".", "!", "?"), TRUNCATED).otherwise(0).alias("fault")))


class _Conversation:
    """What is held of one conversation while its rows pass by."""

    def __init__(self, grp: str):
        self.grp, self.state, self.before, self.hash, self.lines = grp, NONE, None, hashlib.sha256(), 0
        self.turns, self.counts, self.illegal, self.cost, self.letters = [], [0, 0, 0, 0], 0, 0, []

    def _line(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.lines else "") + role + ":" + text).encode())
        self.lines += 1

    def _edit(self, letters: str, row: dict) -> None:
        for x in letters:
            self.letters.append(x)
            if x in "IR":
                self.state = NEXT[self.state]
                self._line(ROLE[self.state], row["text"] if x == "R" else "")
            elif x == "K":
                self.state = kept_state(self.state, row["initial"])
                self._line(row["role"], row["text"])

    def add(self, row: dict) -> None:
        if row["turn"] is not None:
            if not self.turns:
                self.turns = [row["turn"], row["turn"], 1]
            elif row["turn"] != self.turns[1]:
                self.turns[1:] = [row["turn"], self.turns[2] + 1]
        self.counts[row["fault"]] += 1
        self.illegal += self.before is not None and self.before + row["initial"] not in ("su", "ua", "au")
        self.before, self.cost = row["initial"], self.cost + row["cost"]
        self._edit(row["edit"], row)
        self._edit(row["tail"], row)

    def result(self) -> dict:
        low, high, distinct = self.turns or (0, 0, 1)
        return {"grp": self.grp, "gaps": high - low + 1 - distinct, "blank": self.counts[BLANK],
                "duplicate": self.counts[DUPLICATE], "truncated": self.counts[TRUNCATED], "illegal": self.illegal,
                "cost": self.cost, "audit": "".join(self.letters), "repaired_sha256": self.hash.hexdigest()}


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_RESULT = pa.schema([("grp", pa.string()), *((c, pa.int64()) for c in _COUNTS), ("audit", pa.string()),
                     ("repaired_sha256", pa.string())])


def _repaired(batches):
    now = None
    for b in batches:
        out = []
        for row in b.to_pylist():
            if now is None or now.grp != row["grp"]:
                if now:
                    out.append(now.result())
                now = _Conversation(row["grp"])
            now.add(row)
        yield pa.RecordBatch.from_pylist(out, _RESULT)
    if now:
        yield pa.RecordBatch.from_pylist([now.result()], _RESULT)


def repair(turns: DataFrame) -> DataFrame:
    """One row per ``conv_id`` of ``turns``: its faults after damage and its repair."""
    n = shuffle_partitions(turns.sparkSession)
    rows = staged(faulted(damaged(turns)), "faulted-turns")
    found = (rows.join(edits(rows.select("grp", "pos", "initial", "fault")), ["grp", "pos"])
             .repartition(n, "grp").sortWithinPartitions("grp", "pos")
             .mapInArrow(_repaired, f"grp string, {', '.join(c + ' long' for c in _COUNTS)}, "
                                    "audit string, repaired_sha256 string"))
    ids = turns.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().withColumn("grp", _group(F.col("conv_id")))
    nothing = hashlib.sha256(b"").hexdigest()
    return ids.join(found, "grp", "left").select(
        "conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in _COUNTS),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(load(spark, sf_dir, "conversations"))


def _least(*ways: str) -> str:
    return f"list_sort([{', '.join(ways)}])[1]"


def _way(cost: str, letter: str, then: str, line: str | None = None) -> str:
    out = f"list_prepend({line}, ({then}).o)" if line else f"({then}).o"
    return f"{{'c': {cost} + ({then}).c, 'a': '{letter}' || ({then}).a, 'o': {out}}}"


def _oracle() -> str:
    """From the last row to the first, the best (cost, letters) of every state. States
    are named e, s, u, a; ``v`` is before row ``i``, with the insertions ``f``."""
    def past(state: str, nexts: dict[str, str], role: str) -> str:
        to = "a" if role == "assistant" else "u"
        line = "t.role || ':' || t.text"
        ways = [_way("2", "D", f"b.{state}"),
                _way("CASE WHEN fault IN (1, 2) THEN 1000000000 WHEN fault = 3 THEN 6 ELSE 1 END", "R", f"b.{to}",
                     f"'{role}:' || t.text")]
        ways += [_way(f"CASE WHEN fault IN (1, 2) OR initial <> '{x}' THEN 1000000000 WHEN fault = 3 THEN 5 ELSE 0 END",
                      "K", f"b.{y}", line) for x, y in nexts.items()]
        return _least(*ways)

    ins = {"e": ["u", "a"], "s": ["u", "a"], "u": ["a"], "a": ["u"]}

    def inserted(state: str) -> str:
        ways, names = [f"v{state}"], {"u": "'user:'", "a": "'assistant:'"}
        one = ins[state][0]
        ways.append(_way("5", "I", f"v{one}", names[one]))
        if len(ins[state]) > 1:
            ways.append(_way("5", "I", "{'c': 5 + va.c, 'a': 'I' || va.a, 'o': list_prepend('assistant:', va.o)}", names[one]))
        return _least(*ways) + f" AS {state}"
    crc = """xor(list_reduce(
           list_prepend(4294967295, list_transform(string_split(x, ''), lambda y: CAST(ascii(y) AS BIGINT))),
           lambda c, b: list_reduce(list_prepend(xor(c, b), [CAST(i AS BIGINT) FOR i IN range(8)]),
                                    lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295)"""
    empty = "{'c': 0, 'a': '', 'o': CAST([] AS VARCHAR[])}"
    never = "{'c': 1000000000, 'a': '', 'o': CAST([] AS VARCHAR[])}"
    return f"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS x FROM conversations),
h AS (SELECT *, {crc} % 20 AS kind FROM k),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) - 1 AS pos
  FROM h, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS c(copy) WHERE kind <> 0),
g AS (
  SELECT *, right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) AS nth FROM d),
t AS (
  SELECT conv_id, turn, role, text, pos, left(role, 1) AS initial,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS earlier,
         CASE WHEN last = '' THEN 1 WHEN nth > 1 THEN 2 WHEN last NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault FROM g),
n AS (
  SELECT conv_id, count(*) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
         count(*) FILTER (fault = 3) AS truncated,
         count(*) FILTER (earlier IS NOT NULL AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM t GROUP BY conv_id),
b AS (
  SELECT conv_id, rows AS pos, {inserted('e')}, {inserted('s')}, {inserted('u')}, {inserted('a')}
  FROM (SELECT conv_id, rows, {empty} AS ve, {never} AS vs, {never} AS vu, {empty} AS va FROM n)
  UNION ALL
  SELECT conv_id, pos, {inserted('e')}, {inserted('s')}, {inserted('u')}, {inserted('a')}
  FROM (SELECT t.conv_id, t.pos, {past('e', dict(s='s', u='u'), 'user')} AS ve, {past('s', dict(u='u'), 'user')} AS vs,
               {past('u', dict(a='a'), 'assistant')} AS vu, {past('a', dict(u='u'), 'user')} AS va
        FROM b JOIN t ON b.conv_id IS NOT DISTINCT FROM t.conv_id AND t.pos = b.pos - 1))
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(b.e.c, 0) AS BIGINT) AS cost,
       coalesce(b.e.a, '') AS audit, sha256(coalesce(array_to_string(b.e.o, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN n ON c.conv_id IS NOT DISTINCT FROM n.conv_id
LEFT JOIN b ON c.conv_id IS NOT DISTINCT FROM b.conv_id AND b.pos = 0
"""


ORACLE = _oracle()
