"""Substring dedup against a dictionary of all windows."""

import hashlib
import random

import duckdb
import numpy as np

from fleetlens.llm import rlz

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, name int, seeds string, start int, n long, words string"
W = rlz.WINDOW


def _words(seed, n, kinds=5000):
    r = random.Random(seed)
    return [f"w{r.randrange(kinds)}" for _ in range(n)]


def brute(rows):
    first = {}
    docs = [(d, (t or "").encode().split()) for d, t, *_ in rows]
    for d, w in docs:
        for i in range(len(w) - W + 1) if d is not None else ():
            key = tuple(w[i:i + W])
            first[key] = min(d, first.get(key, d))
    out = []
    for d, w in docs:
        gone = [False] * len(w)
        for i in range(len(w) - W + 1) if d is not None else ():
            if first[tuple(w[i:i + W])] < d:
                gone[i:i + W] = [True] * W
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((d, len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def _row(d, words):
    text = words if words is None or isinstance(words, str) else " ".join(words)
    return (d, text, "en", "s", 1, "d", 2, "x", 3, 4, "w")


def _rows():
    a, b, line = _words(1, 400), _words(2, 300), _words(3, 49)
    mixed = a[100:149] + ["x"] + b[20:70] + a[10:60] + a[200:300] + ["end"]  # 49 words are too few
    near = list(a)
    near[77], near[200] = "changed", "other"
    loop = ["x"] * 700
    return [
        _row(5, a), _row(1, a[150:260]), _row(9, b + a), _row(9, a[300:] + _words(8, 20)), _row(3, near), _row(30, mixed),
        _row(31, mixed), _row(31, mixed), _row(32, "\t".join(mixed) + " \n"), _row(None, a), _row(None, None), _row(40, None),
        _row(41, ""), _row(42, " \t\n"), _row(43, a[:49]), _row(44, a[:50]), _row(45, [x.upper() for x in a]), _row(46, loop),
        _row(47, loop[:60]), _row(48, ["x"] * 20_000), _row(49, line + _words(50, 30)), _row(50, line + _words(51, 30)),
        _row(-3, _words(60, 80)), _row(60, _words(60, 80)), _row(61, _words(61, 80) + _words(60, 80)),
        _row(62, ["é" + x for x in a]), _row(63, [x + " y" for x in a[:80]]), _row(64, ["é" + x for x in a[50:120]]),
        *[_row(100 + i, _words(70 + i, 30) + line + ["mid"] + line + _words(170 + i, 30)) for i in range(60)],
        *[_row(200 + i, a[i:i + 90] + b[i:i + 90]) for i in range(40)],
    ]


ROWS = _rows()


def _run(spark, rows, parts=4):
    return [tuple(r) for r in rlz.without_repeats(spark.createDataFrame(rows, SCHEMA).repartition(parts)).collect()]


def _sorted(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


def test_awkward_rows(spark):
    assert _sorted(_run(spark, ROWS)) == _sorted(brute(ROWS))


def test_frequent_seeds_by_single_windows(spark, monkeypatch):
    """Every shared seed counts as hot; and some do."""
    for hot in (0, 20):
        monkeypatch.setattr(rlz, "HOT", hot)
        assert _sorted(_run(spark, ROWS, 9)) == _sorted(brute(ROWS))


def test_a_third_of_all_rows_repeated(spark):
    rows = [_row(7, _words(1, 120))] * 200 + [_row(7 + i, _words(1, 120)) for i in range(100)] + ROWS[:20]
    assert _sorted(_run(spark, rows)) == _sorted(brute(rows))


def test_nothing_shared_and_empty_table(spark):
    rows = [_row(i, _words(1000 + i, 80)) for i in range(5)]
    assert _sorted(_run(spark, rows)) == _sorted(brute(rows))
    assert _run(spark, []) == []


def test_oracle(spark, tmp_path):
    path = str(tmp_path / "documents.parquet")
    rows = [r for r in ROWS if r[0] is not None]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    assert _sorted(con.execute(rlz.ORACLE).fetchall()) == _sorted(brute(rows))


def test_equal_windows_have_equal_seeds():
    h = np.array([hash(x) % (1 << 62) for x in _words(5, 300)], np.uint64)
    seeds, plain = rlz.window_seeds(h), rlz.grams(h, rlz.SEED)
    assert len(seeds) == 300 - W + 1
    for i in (0, 7, 250):
        assert seeds[i] == plain[i:i + W - rlz.SEED + 1].min() == rlz.window_seeds(h[i:i + W])[0]


def _plain_factors(pieces, docs):
    first = {}
    for d, p in zip(docs, pieces):
        for i in range(len(p) - W + 1):
            first.setdefault(tuple(p[i:i + W]), d)
    return [{i + j for i in range(len(p) - W + 1) if first[tuple(p[i:i + W])] < d for j in range(W)} for d, p in zip(docs, pieces)]


def _covered(pieces, docs):
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
    start, length = rlz.factors(np.concatenate(pieces), offsets, np.array(docs))
    out = [set() for _ in pieces]
    for s, n in zip(start, length):
        p = int(np.searchsorted(offsets, s, "right")) - 1
        out[p].update(range(int(s - offsets[p]), int(s - offsets[p] + n)))
    return out, len(start)


def test_factors_and_their_boundaries():
    """Two factors that meet: the windows across the boundary count only if they repeat."""
    r = random.Random(4)
    a, b = ([r.randrange(1000) for _ in range(90)] for _ in range(2))
    pieces = [np.array(x, np.int32) for x in (a, b, a[:60] + b[20:90], a + b, b[5:80] + a[10:75])]
    docs = [1, 2, 3, 4, 4]
    got, n = _covered(pieces, docs)
    assert got == _plain_factors(pieces, docs) and n > 3


def test_false_equal_prints_are_told_apart(monkeypatch):
    """With one print for all windows the words alone decide."""
    r = random.Random(5)
    a = [r.randrange(50) for _ in range(120)]
    pieces = [np.array(x, np.int32) for x in (a, a[10:80], [r.randrange(50) for _ in range(70)], a[60:])]
    monkeypatch.setattr(rlz, "grams", lambda h, n: np.zeros(len(h) - n + 1, np.uint64))
    got, _ = _covered(pieces, [1, 2, 3, 4])
    assert got == _plain_factors(pieces, [1, 2, 3, 4])
