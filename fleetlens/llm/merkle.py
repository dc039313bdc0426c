"""Merkle manifest of a table by incremental witnesses.

A row is a leaf: the lowercase hex sha256 of its fields, each ``-`` if null or
else its UTF-8 byte count, ``:`` and its value. The leaves of a source ascend by
id; while several nodes remain, every 16 consecutive ones become the hash of
their joined digests (the last run may be shorter, even one). What remains is the
source's subroot; the subroots by source (null first) give the root likewise.

Leaves are dealt in aligned blocks of ``BLOCK`` = 16^3. In a block a task appends
them one by one: an open subtree keeps a partial witness for what lies below it,
and when the run of a subtree fills, the siblings are attached to the witnesses
of all its children at once, since these share the link to their parent
(:class:`WitnessTree`). The roots of the blocks are appended in the same way to
the next tree, until one node remains; the subroots are appended to the tree of
the sources. Then the upper parts, one per block, come down and complete the
witnesses of the leaves, which are hashed and folded where they lie. No task
holds more than a block, whatever a source holds.

Defined results: a null id sorts first and is not tampered with; rows that share
an id are ordered by their leaf; repeated rows are separate leaves; a null text
counts as the field ``-``, an empty one as ``0:``; texts of any length are hashed
by Spark and travel no further; an empty table gives no rows; a single row is leaf,
subroot and root, with an empty proof; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import load, shuffle_partitions, staged
from fleetlens.llm.numbering import positions

FAN = 16
LEVELS = 3
BLOCK = FAN ** LEVELS
TAMPERED = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class _Witness:
    """One level of a witness: place among the siblings, these, and the next level."""

    __slots__ = ("at", "siblings", "above")

    def __init__(self):
        self.at, self.siblings, self.above = 0, "", None


class WitnessTree:
    """Nodes appended one by one; each append returns a witness that later
    completions of its siblings extend."""

    def __init__(self):
        self.open: list[list[tuple[str, _Witness]]] = [[]]
        self.count = [0]

    def append(self, node: str) -> _Witness:
        return self._add(0, node)

    def _add(self, level: int, node: str) -> _Witness:
        if level == len(self.open):
            self.open.append([])
            self.count.append(0)
        w = _Witness()
        self.open[level].append((node, w))
        self.count[level] += 1
        if len(self.open[level]) == FAN:
            self._close(level)
        return w

    def _close(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        nodes = [d for d, _ in run]
        above = self._add(level + 1, digest("".join(nodes)))
        for i, (_, w) in enumerate(run):
            w.at, w.siblings, w.above = i, "".join(nodes[:i] + nodes[i + 1:]), above

    def finish(self, levels: int | None = None) -> str:
        """Close what is open and return the root; ``levels`` forces that many
        levels, as in a block that is one of several."""
        level = 0
        while self.count[level] > 1 if levels is None else level < levels:
            if self.open[level]:
                self._close(level)
            level += 1
        return self.open[level][0][0]


def path(w: _Witness) -> list[dict]:
    """The levels of a finished witness, lowest first; the root itself has none."""
    out = []
    while w.above is not None:
        out.append({"at": w.at, "siblings": w.siblings})
        w = w.above
    return out


def fold(node: str, levels: list[dict]) -> str:
    """The root that ``node`` and its siblings give."""
    for level in levels:
        at, siblings = 64 * level["at"], level["siblings"]
        node = digest(siblings[:at] + node + siblings[at:])
    return node


def _appended(nodes: list[str], alone: bool) -> tuple[str, list[_Witness]]:
    tree = WitnessTree()
    held = [tree.append(x) for x in nodes]
    return tree.finish(None if alone else LEVELS), held


def _roots(batches):
    for b in batches:
        yield pa.RecordBatch.from_pylist(
            [{"grp": r["grp"], "pos": r["block"],
              "node": _appended([x["node"] for x in r["nodes"]], r["alone"])[0]} for r in b.to_pylist()],
            pa.schema([("grp", pa.string()), ("pos", pa.int64()), ("node", pa.string())]))


_LEVEL = "array<struct<at:int,siblings:string>>"
_LEVEL_ARROW = pa.list_(pa.struct([("at", pa.int32()), ("siblings", pa.string())]))


def _paths(batches):
    for b in batches:
        out = []
        for r in b.to_pylist():
            held = _appended([x["node"] for x in r["nodes"]], r["alone"])[1]
            out += [{"grp": r["grp"], "pos": x["pos"], "node": x["node"], "levels": path(w) + r["levels"]}
                    for x, w in zip(r["nodes"], held)]
        yield pa.RecordBatch.from_pylist(out, pa.schema([("grp", pa.string()), ("pos", pa.int64()),
                                                         ("node", pa.string()), ("levels", _LEVEL_ARROW)]))


def blocks(nodes: DataFrame, *carried: str) -> DataFrame:
    """``grp, block, alone, nodes`` of nodes ``grp, pos, node``: at most ``BLOCK`` in a row."""
    one = (nodes.groupBy("grp", F.floor(F.col("pos") / BLOCK).alias("block"))
           .agg(F.sort_array(F.collect_list(F.struct("pos", "node", *carried))).alias("nodes")))
    size = nodes.groupBy("grp").agg((F.max("pos") < BLOCK).alias("alone"))
    return staged(one.join(size, "grp"), "merkle-blocks")


def grow(nodes: DataFrame, *carried: str) -> tuple[list[DataFrame], DataFrame]:
    """The rounds of blocks over ``nodes``, lowest first, and the one node of each group."""
    rounds = []
    while True:
        rounds.append(blocks(nodes, *carried))
        nodes = staged(rounds[-1].mapInArrow(_roots, "grp string, pos long, node string"), "merkle-nodes")
        carried = ()
        if nodes.filter("pos > 0").limit(1).count() == 0:
            return rounds, nodes


def witnesses(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """``grp, block, alone, nodes, levels`` of the lowest round: its blocks with what
    lies above them. ``tops`` holds ``grp, levels`` of the last node of each group."""
    above = tops.select("grp", F.lit(0).cast("long").alias("block"), "levels")
    for r in reversed(rounds[1:]):
        found = r.join(above, ["grp", "block"]).mapInArrow(_paths, f"grp string, pos long, node string, levels {_LEVEL}")
        above = staged(found.select("grp", F.col("pos").alias("block"), "levels"), "merkle-levels")
    return rounds[0].join(above, ["grp", "block"])


def _proofs(batches):
    for b in batches:
        for r in b.to_pylist():
            held = _appended([x["node"] for x in r["nodes"]], r["alone"])[1]
            out = []
            for x, w in zip(r["nodes"], held):
                levels = path(w) + r["levels"]
                folded = fold(x["tampered"] or x["node"], levels)
                out.append({"doc_id": x["doc_id"], "leaf": x["node"], "subroot": r["subroot"], "root": r["root"],
                            "proof_sha256": digest("".join(v["siblings"] for v in levels)),
                            "folded_root": folded, "verified": folded == r["root"]})
            yield pa.RecordBatch.from_pylist(out, pa.schema(
                [("doc_id", pa.int64()), *((c, pa.string()) for c in
                                           ("leaf", "subroot", "root", "proof_sha256", "folded_root")),
                 ("verified", pa.bool_())]))


def _field(c: Column) -> Column:
    text = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaves(docs: DataFrame) -> DataFrame:
    """``doc_id, grp, node, tampered``: the leaf of every row, and that of its changed
    text where the id is chosen. ``grp`` orders as the source does, null first."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                    F.col("lang").cast("string").alias("lang"), F.col("n_chars").cast("long").alias("n_chars"),
                    F.col("text").cast("string").alias("text"))
    head = [_field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")]
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    return d.select(
        "doc_id", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("grp"),
        F.sha2(F.concat(*head, _field(F.col("text"))), 256).alias("node"),
        F.when(chosen, F.sha2(F.concat(*head, _field(F.translate("text", UPPER, LOWER))), 256)).alias("tampered"))


def manifest(docs: DataFrame) -> DataFrame:
    """Leaf, subroot, root, proof and folded root of every row of ``docs``."""
    spark = docs.sparkSession
    hashed = staged(leaves(docs), "merkle-hashed")  # the sort samples and reads hashes, not texts
    placed = positions(hashed, "grp", [F.col("doc_id").asc_nulls_first(), F.col("node")], "merkle-leaves")
    rounds, subroots = grow(placed, "doc_id", "tampered")
    listed = subroots.select(F.lit("").alias("all"), F.col("grp").alias("source"), "node")
    listed = staged(positions(listed, "all", [F.col("source")], "merkle-sources"), "merkle-sources-placed")
    upper, root = grow(listed.withColumnRenamed("all", "grp"), "source")
    tops = witnesses(upper, root.select("grp", F.array().cast(_LEVEL).alias("levels")))
    found = tops.mapInArrow(_paths, f"grp string, pos long, node string, levels {_LEVEL}")
    of_source = staged(
        found.join(listed.select("pos", "source"), "pos")
        .join(F.broadcast(root.select("grp", F.col("node").alias("root"))), "grp")  # one row
        .select(F.col("source").alias("grp"), "levels", F.col("node").alias("subroot"), "root"), "merkle-tops")
    low = witnesses(rounds, of_source.select("grp", "levels")).join(of_source.select("grp", "subroot", "root"), "grp")
    dealt = low.repartition(shuffle_partitions(spark), "grp", "block")
    return dealt.mapInArrow(_proofs, "doc_id long, leaf string, subroot string, root string, "
                                     "proof_sha256 string, folded_root string, verified boolean")


#: A tree level of at most 16 children a node, every group until one node is left.
#: crc32 is written out: DuckDB has no such function.
ORACLE = """
WITH RECURSIVE d AS (
  SELECT doc_id, source, text,
         concat_ws('', coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'),
                   coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
                   coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')) AS head,
         doc_id IS NOT NULL AND xor(list_reduce(
           list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
           lambda c, b: list_reduce(list_prepend(xor(c, b), [CAST(i AS BIGINT) FOR i IN range(8)]),
                                    lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) % 5 = 0 AS chosen
  FROM documents),
l AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN chosen THEN sha256(head || coalesce(strlen(text) || ':' || translate(
           text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS tampered
  FROM d),
p AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY source) AS n FROM l),
low(lvl, source, pos, n, node) AS (
  SELECT 0, source, pos, n, leaf FROM p
  UNION ALL
  SELECT lvl + 1, source, pos // 16, (n + 15) // 16, sha256(string_agg(node, '' ORDER BY pos))
  FROM low WHERE n > 1 GROUP BY lvl, source, pos // 16, n),
s AS (
  SELECT source, node AS subroot, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS pos,
         count(*) OVER () AS n FROM low WHERE n = 1),
up(lvl, pos, n, node) AS (
  SELECT 0, pos, n, subroot FROM s
  UNION ALL
  SELECT lvl + 1, pos // 16, (n + 15) // 16, sha256(string_agg(node, '' ORDER BY pos))
  FROM up WHERE n > 1 GROUP BY lvl, pos // 16, n),
r AS (SELECT node AS root FROM up WHERE n = 1),
us AS (
  SELECT a.lvl, a.pos, coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos <> a.pos), '') AS sibs
  FROM up a JOIN up b ON a.lvl = b.lvl AND a.pos // 16 = b.pos // 16 GROUP BY a.lvl, a.pos),
ls AS (
  SELECT a.lvl, a.source, a.pos, coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos <> a.pos), '') AS sibs
  FROM low a JOIN low b ON a.lvl = b.lvl AND a.source IS NOT DISTINCT FROM b.source AND a.pos // 16 = b.pos // 16
  GROUP BY a.lvl, a.source, a.pos),
uw(lvl, source, pos, n, places, sibs) AS (
  SELECT 0, source, pos, n, CAST([] AS BIGINT[]), CAST([] AS VARCHAR[]) FROM s
  UNION ALL
  SELECT w.lvl + 1, w.source, w.pos // 16, (w.n + 15) // 16, list_append(w.places, w.pos % 16), list_append(w.sibs, x.sibs)
  FROM uw w JOIN us x ON x.lvl = w.lvl AND x.pos = w.pos WHERE w.n > 1),
lw(lvl, doc_id, leaf, tampered, source, pos, n, places, sibs) AS (
  SELECT 0, doc_id, leaf, tampered, source, pos, n, CAST([] AS BIGINT[]), CAST([] AS VARCHAR[]) FROM p
  UNION ALL
  SELECT w.lvl + 1, w.doc_id, w.leaf, w.tampered, w.source, w.pos // 16, (w.n + 15) // 16,
         list_append(w.places, w.pos % 16), list_append(w.sibs, x.sibs)
  FROM lw w JOIN ls x ON x.lvl = w.lvl AND x.source IS NOT DISTINCT FROM w.source AND x.pos = w.pos WHERE w.n > 1),
w AS (
  SELECT lw.doc_id, lw.leaf, coalesce(lw.tampered, lw.leaf) AS start, s.subroot,
         list_concat(lw.places, uw.places) AS places, list_concat(lw.sibs, uw.sibs) AS sibs
  FROM lw JOIN uw ON lw.source IS NOT DISTINCT FROM uw.source JOIN s ON lw.source IS NOT DISTINCT FROM s.source
  WHERE lw.n = 1 AND uw.n = 1),
f AS (
  SELECT *, array_to_string(sibs, '') AS proof,
         list_reduce(list_prepend(start, [CAST(i AS VARCHAR) FOR i IN range(1, len(places) + 1)]), lambda node, i:
           sha256(left(sibs[CAST(i AS INT)], 64 * places[CAST(i AS INT)]) || node
                  || substr(sibs[CAST(i AS INT)], 64 * places[CAST(i AS INT)] + 1))) AS folded
  FROM w)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM f, r
"""


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(load(spark, sf_dir, "documents"))
