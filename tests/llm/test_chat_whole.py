"""Chat rotation of whole dialogues: the parts of a perspective join to the uncut rendering."""

import collections

import duckdb

from fleetlens.llm import chat

#: The uncut dialogue once for every participant, with spans in the whole rendering.
WHOLE = f"""
WITH t AS (
  SELECT conv_id, turn, replace(coalesce(role, 'unknown'), '<|', '< |') AS speaker,
         replace(coalesce(text, ''), '<|', '< |') AS body FROM conversations),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, speaker, body) AS rn FROM t),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> '{chat.SYSTEM}'),
s AS (
  SELECT n.conv_id, perspective, rn, speaker = perspective AS mine,
         '{chat.START}' || CASE WHEN speaker = '{chat.SYSTEM}' THEN 'system' WHEN speaker = perspective THEN 'assistant'
                                ELSE 'user name=' || speaker END || chr(10) AS head,
         body || '{chat.END}' AS body
  FROM p JOIN n ON p.conv_id IS NOT DISTINCT FROM n.conv_id),
o AS (
  SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (
              PARTITION BY conv_id, perspective ORDER BY rn
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS a FROM s)
SELECT conv_id, perspective, count(*) AS n_turns,
       string_agg(head || body || chr(10), '' ORDER BY rn) AS rendered,
       coalesce(string_agg(CASE WHEN mine THEN CAST(a AS VARCHAR) || ':' || CAST(a + length(body) AS VARCHAR) END,
                           ',' ORDER BY rn), '') AS mask
FROM o GROUP BY conv_id, perspective
"""

ROWS = ([(1, t, "ann" if t % 2 else "bob", f"t{t}") for t in range(1, 300)]
        + [(1, 0, "system", "rules"), (1, 3, "cyd", "only once <|"), (1, 150, "system", "new rules")]
        + [(2, t, "system", f"s{t}") for t in range(64, 192)] + [(2, 5, "ann", "é"), (2, 200, "bob", None)]
        + [(3, 60 + t, ["system", "ann", "bob"][min(t, 1) + t % 2 if t else 0], f"x{t}") for t in range(8)]
        + [(4, None, "ann" if t % 3 else "bob", f"u{t}") for t in range(150)] + [(4, 7, "cyd", "first"), (4, -70, "system", "s")]
        + [(5, 9, "ann", f"same {t:03}") for t in range(130)] + [(5, 10**12, "bob", "far"), (5, 9, "ann", "same 000")]
        + [(6, 1, "system", "alone")] + [(None, t, None if t % 2 else "dan", "n") for t in range(70)])


def test_parts_join_to_the_whole_dialogue(spark):
    df = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string").repartition(5)
    got = collections.defaultdict(list)
    for r in chat.rotate(df).collect():
        got[r.conv_id, r.perspective].append(r)
    c = duckdb.connect()
    c.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    c.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", ROWS)
    want = {(k, p): tuple(rest) for k, p, *rest in c.execute(WHOLE).fetchall()}
    assert set(got) == set(want) and {k for k, _ in want} == {1, 2, 3, 4, 5, None}
    for key, parts in got.items():
        parts.sort(key=lambda r: (r.block is None, r.block or 0, r.part))
        assert len({(r.block, r.part) for r in parts}) == len(parts)
        assert [r.n_turns for r in parts[:-1]] == [chat.WINDOW] * (len(parts) - 1) and 0 < parts[-1].n_turns <= chat.WINDOW
        at, spans = 0, []
        for r in parts:
            spans += [f"{int(a) + at}:{int(b) + at}" for a, b in (m.split(":") for m in r.mask.split(",") if m)]
            at += len(r.rendered)
        assert (sum(r.n_turns for r in parts), "".join(r.rendered for r in parts), ",".join(spans)) == want[key]
    assert len(got[3, "ann"]) == 1  # 8 turns numbered 60 to 67


def test_registered_sql_on_gaps_nulls_and_silent_speakers(spark):
    df = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string").repartition(5)
    out = chat.rotate(df)
    c = duckdb.connect()
    c.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    c.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", ROWS)
    found = c.execute(chat.ORACLE)
    names = [x[0] for x in found.description]
    want = found.fetchall()
    assert names == out.columns
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in out.collect())
