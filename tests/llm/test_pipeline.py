"""The pipeline stage by stage against brute force."""

import collections
import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from fleetlens.llm import mixing
from fleetlens.session import scratch_path

P = pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _corpus():
    r = random.Random(21)
    vocabulary = [a + b for a in "ba de ki lo mu".split() for b in "rna stel von qui zor pim".split()]
    docs, toxic = [], set()
    for i in range(600):
        w = [r.choice(vocabulary) for _ in range(r.randrange(20, 80))]
        if i % 6 == 0:
            toxic.add(i)
            for k in range(6):
                w[r.randrange(len(w))] = r.choice(["grumbelo", "grumbelan", "grumbelix", "idiot"])
        docs.append([i, " ".join(w)])
    clean = [d for d in docs if d[0] not in toxic]
    for n, (i, t) in enumerate(clean[:30]):
        docs.append([1000 + n, t.upper()])                      # exact copies
        docs.append([2000 + n, t + " extra"])                   # near copies
    docs += [[3000, None], [3001, ""], [3002, "one two"], [3003, " ".join(r.choice(vocabulary) for _ in range(5000))]]
    rows = [(i, t, "xx", [None, "a", "b", "c"][i % 4], len(t or "")) for i, t in docs]
    return rows, [(i, 1, int(i in toxic)) for i in range(600)], toxic


def _words(t):
    return (t or "").encode().lower().split()


def test_stages(spark):
    rows, labels, toxic = _corpus()
    sf = scratch_path(spark, "pipeline-test")
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "jaccard_join", "mixing", "packing"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        if k < 4:
            assert out.columns == docs.columns
        path = scratch_path(spark, f"test-{name}")
        out.write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        kept[name] = docs.collect()

    ids = {r.doc_id for r in kept["toxicity"]}
    held = {i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert len(held & toxic & ids) <= 1 and len(held - toxic - ids) <= 1
    assert {3000, 3001, 3002, 3003} <= ids

    best = {}
    for r in kept["toxicity"]:
        key = (r.text or "").encode().lower()
        best[key] = max(best.get(key, -1), r.doc_id)
    assert sorted(r.doc_id for r in kept["exact_dedup"]) == sorted(best.values())

    left = [r for r in kept["exact_dedup"]]
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
            for w in (_words(r.text) for r in left)]
    group = list(range(len(left)))
    for i in range(len(left)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    least = collections.defaultdict(list)
    for g, r in zip(group, left):
        least[g].append(r.doc_id)
    assert sorted(r.doc_id for r in kept["jaccard_join"]) == sorted(min(v) for v in least.values())

    plan = {(r.doc_id): r for r in mixing.mix(spark.createDataFrame(kept["jaccard_join"], SCHEMA)).collect()}
    times = collections.Counter(r.doc_id for r in kept["mixing"])
    assert times == {i: r.times for i, r in plan.items() if r.times}
    target = {}
    taken = collections.Counter()
    for r in plan.values():
        target[r.src, r.no_src] = r.target
        taken[r.src, r.no_src] += r.times * r.size
    longest = max(r.size for r in plan.values())
    assert all(abs(taken[s] - t) <= 2 * longest for s, t in target.items())

    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = collections.Counter()
    for r in kept["mixing"]:
        t = [*tok.encode(r.text or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(t), 2048):
            want[r.doc_id, k // 2048, len(t[k:k + 2048]), zlib.crc32(np.array(t[k:k + 2048], "<u4").tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in kept["packing"]) == want
    used = collections.Counter()
    for r in kept["packing"]:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 2048 and len(used) <= -(-sum(used.values()) // 2048) + 1


def test_rows_that_share_an_id_or_have_none(spark):
    """Stages decide by row: a unique document stays whatever its id."""
    r = random.Random(5)
    a, b, c = (" ".join(f"{x}{r.randrange(999)}" for _ in range(60)) for x in "abc")
    rows = [(1, a, "x", "s", 1), (2, a + " more", "x", "s", 2), (2, b, "x", "s", 3), (None, c, "x", "s", 4),
            (None, c + " end", "x", "s", 5), (None, "lone words here to stay", "x", None, 6), (7, b, "x", "s", 7), (7, b, "x", "s", 7)]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = [tuple(x) for x in corpus_pipeline.drop_exact_copies(spark, docs, "").collect()]
    assert sorted(x[4] for x in kept) == [1, 2, 4, 5, 6, 7]            # of the three b one row of id 7
    near = [tuple(x) for x in corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(kept, SCHEMA), "").collect()]
    assert sorted(x[4] for x in near) in ([1, 4, 6, 7], [1, 5, 6, 7])  # one of the two c, which have no id
    only = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows[:3], SCHEMA), "").collect()
    assert sorted(x.n_chars for x in only) == [1, 3]
    again = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame([rows[0]] * 200 + [rows[1]] * 200, SCHEMA), "")
    assert again.count() == 1
    mixed = corpus_pipeline.mix_sources(spark, docs, "")
    plan = mixing.mix(mixing.numbered(docs)).collect()
    assert mixed.count() == sum(x.times for x in plan) and mixed.columns == docs.columns


def test_an_empty_table(spark):
    sf = scratch_path(spark, "pipeline-empty")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0
