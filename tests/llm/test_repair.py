"""Conversation repair against an exhaustive search of the lattice."""

import hashlib
import random
import re
import zlib

import duckdb
import pytest

from fleetlens.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, grp string, pos int, block string, edit int, fault string"
WORD = re.compile("[^\x20\x09-\x0d]")


def _damage(rows):
    out = []
    for c, t, role, text, *_ in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind == 0:
            continue
        key = (t is not None, t or 0, role, text)
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(c, key, t, role, text)] * (2 if kind == 3 else 1)
    return out


def _faults(rows):
    seen, out = set(), []
    for role, text in rows:
        said = WORD.findall(text)
        out.append(1 if not said else 2 if (role, text) in seen else 3 if said[-1] not in ".!?" else 0)
        seen.add((role, text))
    return out


LINE = {"u": "user:", "a": "assistant:"}


def cheapest(rows, faults):
    """Cost, letters and lines of the best edits: the least of all, from the end."""
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", []), "a": (0, "", []), "s": None, "u": None}

    def insert(at):
        for _ in range(3):
            for q in at:
                then = at[after[q]]
                if then:
                    way = (5 + then[0], "I" + then[1], [LINE[after[q]], *then[2]])
                    at[q] = min(filter(None, (at[q], way)))
        return at
    best = insert(best)
    for (role, text), fault in reversed(list(zip(rows, faults))):
        late, x, now = 5 * (fault == 3), role[:1], {}
        for q in best:
            ways = []
            if best[q]:
                ways.append((2 + best[q][0], "D" + best[q][1], best[q][2]))
            if fault not in (1, 2):
                ok = {"s": q == "", "u": q != "u", "a": q == "u"}.get(x, False)
                if ok and best[x]:
                    ways.append((late + best[x][0], "K" + best[x][1], [f"{role}:{text}", *best[x][2]]))
                then = best[after[q]]
                if then:
                    ways.append((1 + late + then[0], "R" + then[1], [LINE[after[q]] + text, *then[2]]))
            now[q] = min(ways, default=None)
        best = insert(now)
    return best[""]


def brute(rows):
    convs = {c: [] for c, *_ in rows}
    for r in _damage(rows):
        convs[r[0]].append(r[1:])
    out = []
    for c, held in convs.items():
        held.sort(key=lambda r: r[0])
        said = [(r[2], r[3]) for r in held]
        faults = _faults(said)
        turns = [r[1] for r in held if r[1] is not None]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
        cost, audit, lines = cheapest(said, faults)
        assert re.fullmatch("(s?(ua)+)?", "".join(x[:1] for x in lines))
        out.append((c, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count(1), faults.count(2),
                    faults.count(3), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def _row(c, t, role, text):
    return (c, t, role, text, "g", 1, "b", 2, "f")


def _random(seed, convs, turns):
    r = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(r.randrange(1, turns)):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool"])
            rows.append(_row(c, t, role, r.choice(["Fine.", "Well!", "cut off", f"word {r.randrange(9)}.", f"odd {t}"])))
    return rows


def _key(r):
    return (r[0] is not None, r[0] or 0)


AWKWARD = [_row(None, 0, "user", "Null conversation."), _row(None, None, "assistant", None), _row(1, None, None, None),
           _row(1, None, "user", "A."), _row(1, 5, "user", "A."), _row(1, 5, "user", "A."), _row(1, 5, "assistant", "B."),
           _row(1, 90, "assistant", "end . \t\n"), _row(2, 1, "", ""), _row(3, 1, "user", "x" * 300_000), _row(3, 2, "assistant", "Y."),
           _row(4, 7, "system", "S."), _row(5, 3, "sage", "S."), _row(5, 4, "unknown", "U."), _row(5, 5, "a", "Á.")] + \
          [_row(c, t, "user", "drop or keep.") for c in range(6, 30) for t in (0,)]


def _check(spark, rows, parts=3):
    got = [tuple(r) for r in repair.repair(spark.createDataFrame(rows, SCHEMA).repartition(parts)).collect()]
    assert sorted(got, key=_key) == sorted(brute(rows), key=_key)
    return got


def test_random_conversations(spark):
    _check(spark, _random(1, 120, 14))


def test_awkward_rows(spark):
    got = _check(spark, AWKWARD)
    nothing = [r for r in got if r[7] == ""]
    assert nothing and all(r[1:7] == (0,) * 6 and r[8] == hashlib.sha256(b"").hexdigest() for r in nothing)


def test_conversations_of_several_blocks(spark):
    """Longer than a block, with a third of all rows in one conversation."""
    rows = _random(2, 6, 200) + [_row(99, t, "user" if t % 2 else "assistant", f"turn {t}" + "." * (t % 7 > 0)) for t in range(400)]
    _check(spark, rows, 5)


def test_unnumbered_repeats(spark):
    """All rows equal: one row is kept next to an inserted answer, the others go."""
    _check(spark, [_row(1, None, "user", "Same.")] * 300 + [_row(2, 1, "user", "One.")])


def test_empty_table(spark):
    assert repair.repair(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("seed", range(60))
def test_auction_of_one_block(seed):
    r = random.Random(seed)
    said = [(r.choice(["user", "assistant", "system", "tool"]), r.choice(["a.", "b", "", "c!"])) for _ in range(r.randrange(1, 12))]
    faults = _faults(said)
    rows = [{"initial": x[:1], "fault": f} for (x, _), f in zip(said, faults)]
    t = repair.trace(rows, None, repair.NONE)
    cost, audit, _ = cheapest(said, faults)
    assert (t["cost"], "".join(t["edits"])) == (cost, audit)


def test_prices_stay_below_distances():
    """After the auction no arc is shorter than the drop of the prices along it, and
    those of the path are tight."""
    rows = [{"initial": x, "fault": f} for x, f in zip("auusaaus", (0, 3, 0, 0, 1, 0, 2, 0))]
    arcs = repair.lattice(rows, repair.ACCEPTED, True)
    prices = [0] * (len(arcs) + 1)
    letters, node = repair.auction(arcs, prices, 0), 0
    assert all(prices[i] <= c + prices[j] for i, here in enumerate(arcs) for _, c, j in here)
    for x in letters:
        _, c, to = next(a for a in arcs[node] if a[0] == x)
        assert prices[node] == c + prices[to]
        assert not any(c + prices[j] == prices[node] for y, c, j in arcs[node] if y < x)
        node = to


def test_oracle(spark, tmp_path):
    rows = AWKWARD + _random(3, 30, 10)
    rows = [r if r[0] is None or r in AWKWARD else (r[0] + 100, *r[1:]) for r in rows]
    path = str(tmp_path / "conversations.parquet")
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}/*.parquet'")
    assert sorted(con.execute(repair.ORACLE).fetchall(), key=_key) == sorted(brute(rows), key=_key)
