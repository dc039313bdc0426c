"""The Merkle manifest against a tree built level by level."""

import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, pos long, node string, grp string, block int, levels string"


def _h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def _field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def _level(nodes):
    return [_h("".join(nodes[i:i + 16])) for i in range(0, len(nodes), 16)]


def _proof(nodes, i):
    """Root of ``nodes`` and, per level, the place of node ``i`` and its siblings."""
    out = []
    while len(nodes) > 1:
        run = nodes[i // 16 * 16: i // 16 * 16 + 16]
        out.append((i % 16, run[:i % 16] + run[i % 16 + 1:]))
        nodes, i = _level(nodes), i // 16
    return nodes[0], out


def brute(rows):
    low = str.maketrans(merkle.UPPER, merkle.LOWER)
    groups = {}
    for d, text, lang, source, n, *_ in rows:
        head = "".join(map(_field, (d, source, lang, n)))
        leaf = _h(head + _field(text))
        chosen = d is not None and zlib.crc32(str(d).encode()) % 5 == 0
        changed = _h(head + _field(text.translate(low) if text is not None else None)) if chosen else leaf
        groups.setdefault(source, []).append((d is not None, d or 0, leaf, d, changed))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for g in groups.values():
        g.sort()
    subroots = [_proof([x[2] for x in groups[s]], 0)[0] for s in order]
    out = []
    for k, s in enumerate(order):
        leaves = [x[2] for x in groups[s]]
        root, above = _proof(subroots, k)
        for i, (_, _, leaf, d, changed) in enumerate(groups[s]):
            path = _proof(leaves, i)[1] + above
            node = changed
            for at, sib in path:
                node = _h("".join(sib[:at]) + node + "".join(sib[at:]))
            out.append((d, leaf, subroots[k], root, _h("".join("".join(x) for _, x in path)), node, node == root))
    return out


def _key(r):
    return (r[0] is not None, r[0] or 0, r[1:])


def _run(spark, rows, parts=3):
    return merkle.manifest(spark.createDataFrame(rows, SCHEMA).repartition(parts))


def _row(d, text, source, lang="en", n=3):
    return (d, text, lang, source, n, 1, "n", "g", 2, "l")


AWKWARD = [_row(1, "One TWO", "b"), _row(2, None, "b"), _row(2, "", "b"), _row(2, "", "b"), _row(None, "Null Id", "b"),
           _row(None, None, None, None, None), _row(5, "É Ünï WORDS", "ä"), _row(-7, "Minus", "Z"), _row(8, "alone", ""),
           _row(9, "Long " * 60_000, "b")] + [_row(100 + i, f"Text {i} A", "c") for i in range(17)] + \
          [_row(200 + i, f"Many {i}", f"s{i:02d}") for i in range(20)]


def test_awkward_rows(spark):
    got = [tuple(r) for r in _run(spark, AWKWARD).collect()]
    assert sorted(got, key=_key) == sorted(brute(AWKWARD), key=_key)
    assert not all(r[-1] for r in got) and any(r[-1] for r in got)


def test_blocks_of_a_hot_source(spark):
    """One source of several blocks, with a last run of one, beside small ones."""
    rows = [_row(i, f"T{i}", "hot") for i in range(merkle.BLOCK + 1)] + [_row(i, "x", "few") for i in range(16)]
    got = [tuple(r) for r in _run(spark, rows, 7).collect()]
    assert sorted(got, key=_key) == sorted(brute(rows), key=_key)


def test_single_row_and_empty_table(spark):
    got = _run(spark, AWKWARD[:1]).collect()
    assert [tuple(r) for r in got] == brute(AWKWARD[:1])
    assert got[0].leaf == got[0].root and got[0].proof_sha256 == _h("")
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256, 257, 300])
def test_witnesses_of_appended_nodes(n):
    nodes = [_h(str(i)) for i in range(n)]
    tree = merkle.WitnessTree()
    held = [tree.append(x) for x in nodes]
    root = tree.finish()
    for i in range(n):
        want, path = _proof(nodes, i)
        got = merkle.path(held[i])
        assert root == want == merkle.fold(nodes[i], got)
        assert [(v["at"], v["siblings"]) for v in got] == [(a, "".join(s)) for a, s in path]


def test_forced_levels_hash_single_nodes():
    tree = merkle.WitnessTree()
    w = tree.append("a" * 64)
    assert tree.finish(3) == _h(_h(_h("a" * 64))) == merkle.fold("a" * 64, merkle.path(w))


def test_oracle(spark, tmp_path):
    """The registered SQL on awkward rows."""
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(AWKWARD, SCHEMA).coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    assert sorted(con.execute(merkle.ORACLE).fetchall(), key=_key) == sorted(brute(AWKWARD), key=_key)


def test_leaves_travel_without_texts(spark):
    df = merkle.leaves(spark.createDataFrame(AWKWARD, SCHEMA))
    assert df.columns == ["doc_id", "grp", "node", "tampered"]
    assert df.filter(F.length("node") != 64).count() == 0
