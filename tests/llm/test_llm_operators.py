"""The operators against brute force on a small table of awkward rows."""

import bisect
import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import ann, chat, common, dac, exact_dedup, jaccard_join, lm_score, mixing, packing, pii, toxicity
from fleetlens.llm.tokens import CorpusEncoder

P = pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row int, key string, size string, shard int, batch int, rank int, found string"


def _words(seed, n):
    r = random.Random(seed)
    return [r.choice("the of ander tion wie sehr el los que casa bien 12 x7 über né".split()) + str(r.randrange(40)) for _ in range(n)]


def _rows():
    long = _words(1, 6000)
    near = list(long)
    for i in range(0, 6000, 150):
        near[i] = "changed"
    base = _words(2, 60)
    close = base[:57] + ["z1", "z2", "z3"]
    edge = _words(3, 24)  # 20 shingles
    texts = [
        (1, "Hello World, hello"), (2, "hello world, HELLO"), (3, None), (4, ""), (5, " \t\n "), (6, "one"), (7, "ONE"),
        (8, "a b c d"), (9, "a b c d e"), (9, "a b c d e"), (None, "a b c d e"), (None, None),
        (10, " ".join(long)), (11, " ".join(near)), (12, " ".join(long).upper()), (13, " ".join(base)),
        (14, " ".join(close)), (15, "\n".join(base)), (16, " ".join(edge)), (17, " ".join(edge[:-1] + ["other"])),
        (18, "mail me: bob.x+1@mail.example.com. or 10.0.0.256, 192.168.1.20 card 4111 1111 1111 1111 tel +49 (30) 123456-78"),
        (19, "É ünïcode 4111-1111-1111-1112 +1 2 x@y z@a.b@c.d 1.2.3.4.5.6.7.8 " + "9" * 40),
        (20, "x" * 30000), (21, "<|endoftext|> don't  stop\n\n now"), (22, "日本 語 " * 50), (-5, "negative id"),
    ]
    texts += [(100 + i, " ".join(_words(50 + i, 30 + i))) for i in range(40)]
    sources = ["b", "a", None, "ä", "c"]
    return [(d, t, "en", sources[i % 5], 1, i, "k", "s", 1, 2, 3, "f") for i, (d, t) in enumerate(texts)]


ROWS = _rows()


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    path = f"{common.scratch_path(spark, 'awkward')}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def _split(t):
    return (t or "").encode().lower().split()


def test_exact_dedup(docs):
    got = exact_dedup.exact_groups(docs).drop("row").collect()
    groups = collections.defaultdict(list)
    for r in ROWS:
        groups[hashlib.sha256((r[1] or "").encode().lower()).hexdigest()].append(r[0])
    want = collections.Counter()
    for sha, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        want.update((i, keep, len(ids), sha) for i in ids)
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = collections.Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept) == set(groups) and set(kept.values()) == {1}
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    rest = exact_dedup.drop_copies(docs)
    assert rest.columns == docs.columns and rest.count() == len(groups)


def test_cuckoo_index_inserts_deletes_and_resizes():
    index, live, r = exact_dedup.CuckooIndex(4), {}, random.Random(5)
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    for _ in range(20000):
        k = r.choice(keys)
        if k in live and r.random() < 0.4:
            assert index.delete(k)
            del live[k]
        elif k not in live:
            index.insert(k, len(live))
            live[k] = index.get(k)
        else:
            assert index.get(k) == live[k]
    assert dict(index.items()) == live and index.size == len(live) and index.buckets > 4
    assert all(index.get(k) is None for k in keys if k not in live)
    # every two-byte prefix alike: all keys fight for two buckets, so the filter grows until they fit
    same = exact_dedup.CuckooIndex(4)
    for i in range(200):
        same.insert(b"\1\0" + hashlib.sha256(str(i).encode()).digest()[:30], i)
    assert sorted(v for _, v in same.items()) == list(range(200))


def test_index_update(spark):
    live = spark.createDataFrame([(b"a" * 32, 2), (b"b" * 32, 1)], "digest binary, n long")
    changes = spark.createDataFrame([(b"a" * 32, -1), (b"b" * 32, -1), (b"c" * 32, 1), (b"c" * 32, 1), (b"d" * 32, -1)], "digest binary, n long")
    got = {bytes(r.digest)[:1]: r.n for r in exact_dedup.update_index(live, changes).collect()}
    assert got == {b"a": 1, b"c": 2}


def test_mixing_of_many_small_sources(spark):
    """Sources smaller than a block give their targets too."""
    rows = [(i, "one two three four five six", "en", f"s{i:03d}", 1, i, "k", "s", 1, 2, 3, "f") for i in range(50)]
    rows += [(100, " ".join(["w"] * 12), "en", "a12", 1, 0, "k", "s", 1, 2, 3, "f"), (101, "w", "en", "b", 1, 0, "k", "s", 1, 2, 3, "f")]
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    taken = collections.Counter()
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        taken[r.src] += r.taken
    assert all(abs(taken[r.src] - r.target) <= 0.5 for r in got) and sum(taken.values()) > 450


def test_mixing(docs):
    got = mixing.mix(docs).collect()
    size = collections.Counter()
    for r in ROWS:
        size[r[3]] += len(_split(r[1]))
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), 1.5 * sum(size.values())
    while True:
        lam = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * lam > 2 * size[s]}
        if not over:
            break
        for s in over:
            target[s] = 2 * size[s]
            left -= target[s]
        open_ -= over
    target |= {s: weight[s] * lam for s in open_}
    by = {(r.src if not r.no_src else None): r for r in got}
    taken = collections.Counter()
    for r in got:
        s = None if r.no_src else r.src
        assert r.source_size == size[s] and r.target == pytest.approx(target[s]) and 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in order) and len(by) == len(order)
    assert sorted((r.doc_id or -1, r.size) for r in got) == sorted((r[0] or -1, len(_split(r[1]))) for r in ROWS)
    again = mixing.mix(docs.repartition(7)).select("doc_id", "size", "taken")
    assert sorted(map(str, again.collect())) == sorted(str(r) for r in mixing.mix(docs).select("doc_id", "size", "taken").collect())


def test_shard_quotas_are_the_highest_quotients(spark, monkeypatch):
    sizes = [1000, 40, 7, 0, 333, 2500, 90, 61]
    targets = [1500.0, 80.0, 14.0, 0.0, 400.5, 2000.25, 180.0, 100.0]
    rows = spark.createDataFrame([(f"s{i}", False, i + 1, s, t) for i, (s, t) in enumerate(zip(sizes, targets))],
                                 "src string, no_src boolean, rank int, source_size long, target double")
    monkeypatch.setattr(mixing, "SHARD_BLOCKS", 17)
    got = collections.defaultdict(dict)
    for r in mixing.shard_quotas(rows).collect():
        got[r.shard][r.src] = r.quota
    total = math.floor(sum(targets) / mixing.BLOCK_WORDS)
    won, prev = [0] * 8, [0] * 8
    caps = [2 * s // mixing.BLOCK_WORDS for s in sizes]
    for n in range(1, total + 1):
        i = max(range(8), key=lambda i: (targets[i] / (2 * won[i] + 1), -i))
        won[i] += 1
        if n % 17 == 0 or n == total:
            cum = [min(w, c) for w, c in zip(won, caps)]
            assert [got[-(-n // 17)][f"s{i}"] for i in range(8)] == [a - b for a, b in zip(cum, prev)]
            prev = cum


def test_jaccard_components(docs):
    got = jaccard_join.jaccard_components(docs, shards=7).collect()
    sets = []
    for r in ROWS:
        w = _split(r[1])
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(ROWS)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(ROWS)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(ROWS):
        if r[0] is not None:
            least[find(i)] = min(r[0], least.get(find(i), r[0]))
    want = collections.Counter((r[0], len(sets[i]), least.get(find(i))) for i, r in enumerate(ROWS))
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want


@pytest.mark.parametrize("block", [1024, 7])
def test_jaccard_finds_every_link_of_random_families(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    r = random.Random(11)
    rows, n = [], 0
    for _ in range(60):
        size = r.choice([5, 6, 8, 9, 13, 21, 40, 90, 130, 260])
        base = [f"w{r.randrange(10**6)}" for _ in range(size)]
        for _ in range(r.choice([2, 3, 6])):
            w = list(base)
            for _ in range(r.randrange(0, max(2, size // 14))):
                k = r.randrange(len(w))
                w[k: k + r.choice([0, 1])] = [f"n{r.randrange(10**6)}"] * r.choice([0, 1])
            rows.append((n, " ".join(w)))
            n += 1
    shared = " ".join(f"p{i}" for i in range(60))  # a passage that many documents share
    for _ in range(40):
        rows.append((n, shared + " " + " ".join(f"q{r.randrange(10**6)}" for _ in range(90))))
        n += 1
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {x.doc_id: x.component_id for x in jaccard_join.jaccard_components(df).collect()}
    sets = [{tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} for w in (t.split() for _, t in rows)]
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(n):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert got == {i: find(i) for i in range(n)}


def test_sketch_differences_bound_the_set_difference():
    r = np.random.default_rng(3)
    for n in (1, 3, 7, 40, 300):
        a = np.unique(r.integers(0, 2**63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: max(1, n - n // 10)], r.integers(0, 2**63, n // 10, dtype=np.uint64)]))
        for c in (len(a).bit_length() - 1, len(a).bit_length()):
            x, y = set(jaccard_join.sketch(a, c, 0).tolist()), set(jaccard_join.sketch(b, c, 0).tolist())
            apart = len(set(a.tolist()) ^ set(b.tolist()))
            assert max(len(x - y), len(y - x)) <= apart
            bits = jaccard_join.parity_bits(a, c) ^ jaccard_join.parity_bits(b, c)
            assert int(np.bitwise_count(bits).sum()) <= apart


@pytest.mark.parametrize("kind,name", [("byte", "byte_bpe_50k.json"), ("word", "word_bpe_49k.json")])
def test_encoder_gives_the_library_ids(kind, name):
    from tokenizers import Tokenizer
    tok, enc = Tokenizer.from_file(P.path(name)), CorpusEncoder(P.path(name), kind)
    texts = [r[1] or "" for r in ROWS] + [" ", "  a  b", "a\n b", " a ", "x\n\n y  ", "I'LL we'Ve", "\x1cfoo\x1d", "é ﬁ İ ΣΑΣ", "½ ²", "tab\tb\r\nc"]
    for t in texts:
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, t[:60]


def test_dac_round_trip_and_random_access():
    r = np.random.default_rng(1)
    for n in (0, 1, 511, 512, 513, 3000):
        ids = r.choice([0, 5, 255, 256, 65535, 65536, 2**32 - 1, 40000], n).astype(np.uint32)
        lengths = np.array([n // 3, 0, n - n // 3]) if n else np.array([0])
        data = dac.encode_dac([7, None, -1][: len(lengths)], lengths, ids)
        reader = dac.DacReader(lambda k, at, data=data: data[at: at + k])
        assert reader.tokens(0, n).tolist() == ids.tolist()
        assert [reader.token(i) for i in range(0, n, 37)] == ids[::37].tolist()
        for a, z in ((0, n // 2), (n // 3, n), (n, n)):
            assert reader.tokens(a, z).tolist() == ids[a:z].tolist()
        assert reader.documents()[0] == [7, None, -1][: len(lengths)]


def test_token_files(spark, docs, monkeypatch):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    manifest = dac.write_token_files(docs, common.scratch_path(spark, "dac"), P.path("byte_bpe_50k.json"), partitions=4)
    got = sorted(dac.read_documents(manifest).collect(), key=lambda r: r.start)
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(len(got))]
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))
    want = collections.Counter()
    for r in ROWS:
        t = [*tok.encode(r[1] or "", add_special_tokens=False).ids, 0]
        want[r[0], len(t), zlib.crc32(np.array(t, "<u4").tobytes())] += 1
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want


def test_packing(docs):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    got = packing.pack(docs, P.path("word_bpe_49k.json")).collect()
    want = collections.Counter()
    for r in ROWS:
        t = [*tok.encode(r[1] or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(t), 2048):
            want[r[0], k // 2048, k, len(t[k:k + 2048]), zlib.crc32(np.array(t[k:k + 2048], "<u4").tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    seqs = collections.defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
    for placed in seqs.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(seqs) <= -(-sum(r.length for r in got) // 2048) + 1


def _best_fit_decreasing(hist):
    """Sequences that best fit decreasing needs, piece by piece."""
    rooms = []
    for n in sorted((n for n, c in hist.items() for _ in range(c)), reverse=True):
        at = bisect.bisect_left(rooms, n)
        room = rooms.pop(at) if at < len(rooms) else 2048
        bisect.insort(rooms, room - n)
    return len(rooms)


def test_program_makes_nearly_all_sequences():
    r = random.Random(9)
    hist = collections.Counter(min(2040, int(r.lognormvariate(5.5, 1.2)) // 8 * 8 + 8) for _ in range(30_000))
    lengths = np.array(sorted(hist))
    found = packing.priced_fillings(lengths, np.array([hist[int(n)] for n in lengths]), 2048)
    every = sum(t for _, t, _ in found)
    assert sum(t for _, t, whole in found if whole) >= 0.9 * every
    assert every <= 1.001 * sum(n * c for n, c in hist.items()) / 2048 + 2
    assert len(found) <= 3 * len(lengths)


def test_best_filling_is_the_best_knapsack():
    r = random.Random(4)
    for _ in range(20):
        lengths = np.array(sorted(r.sample(range(1, 31), 5)))
        value = np.array([r.random() for _ in lengths])
        best = [0.0] * 41
        for w in range(1, 41):
            best[w] = max([best[w - 1]] + [best[w - n] + v for n, v in zip(lengths.tolist(), value) if n <= w])
        counts = packing.best_fillings(lengths, value, 40)[0]
        assert (counts * lengths).sum() <= 40 and (counts * value).sum() == pytest.approx(best[40])


def test_plan_uses_every_piece_once_and_little_more_room_than_needed():
    r = random.Random(2)
    for hist in ({}, {2048: 5}, {1: 3}, {1025: 7}, {r.randrange(1, 2049): r.randrange(1, 400) for _ in range(300)}, {700: 1000, 648: 1000}):
        plan = packing.plan_fillings(hist)
        used = collections.Counter()
        for counts, times in plan:
            assert times > 0 and sum(n * c for n, c in counts.items()) <= 2048
            for n, c in counts.items():
                used[n] += c * times
        assert used == collections.Counter(hist)
        if hist and 1025 not in hist:
            least = max(sum(n * c for n, c in hist.items()) / 2048, sum(c for n, c in hist.items() if n > 1024))
            assert least <= sum(t for _, t in plan) <= 1.03 * least + 2
            assert sum(t for _, t in plan) <= _best_fit_decreasing(hist)
    assert sum(t for _, t in packing.plan_fillings({700: 1000, 648: 1000})) <= 670  # 2 x 700 + 648 fills a sequence


def test_language_model(docs):
    held = common.crc_mod(F.col("doc_id"), 7) == 2
    got = lm_score.score_documents(docs, held, shards=5).collect()
    is_held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    c, b, n_docs = collections.Counter(), collections.Counter(), 0
    seqs = [(r[0], [*_split(r[1]), "END"]) for r in ROWS]
    for d, w in seqs:
        if not is_held(d):
            n_docs += 1
            c.update(w)
            b.update(zip(["START", *w[:-1]], w))
    total, kinds = sum(c.values()), len(c)
    want = []
    for d, w in seqs:
        base = sum(math.log10((c[x] + 1) / (total + kinds + 1)) for x in w)
        score = sum(math.log10((b[v, x] + lm_score.MU * (c[x] + 1) / (total + kinds + 1)) / ((n_docs if v == "START" else c[v]) + lm_score.MU))
                    for v, x in zip(["START", *w[:-1]], w))
        want.append((d or -99, is_held(d), len(w), sum(c[x] > 0 for x in w), total, base, score))
    have = sorted(((r.doc_id or -99, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got), key=lambda r: (r[:5], round(r[5], 6)))
    for x, y in zip(have, sorted(want, key=lambda r: (r[:5], round(r[5], 6))), strict=True):
        assert x[:5] == y[:5] and x[5] == pytest.approx(y[5], abs=1e-6) and abs(x[6] - y[6]) <= 0.02 * x[2]


def test_personal_data(docs):
    rx = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
          "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def luhn(s):
        d = [int(x) * (1 + i % 2) for i, x in enumerate(reversed(s))]
        return sum(x - 9 * (x > 9) for x in d) % 10 == 0
    ok = {"email": lambda m: True, "ip": lambda m: all(int(x) <= 255 for x in m.split(".")),
          "card": lambda m: 16 <= len(re.sub("[ -]", "", m)) <= 19 and luhn(re.sub("[ -]", "", m)),
          "phone": lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15}
    got = pii.candidates(docs).collect()
    want = collections.Counter()
    for r in ROWS:
        want[r[0], tuple((k, *m.span()) for k, p in rx.items() for m in re.finditer(p, r[1] or "") if ok[k](m.group()))] += 1
    assert sum(len(s) for _, s in want) == 7
    assert collections.Counter((r.doc_id, tuple((pii.KINDS[x.k], x.s, x.e) for x in r.found if x.base)) for r in got) == want
    kept = pii.find_personal_data(docs).collect()
    assert all(sum(x.base for x in r.found) == sum(x.base for x in g.found) for r, g in zip(
        sorted(kept, key=lambda r: str((r.doc_id, len(r.found)))), sorted(got, key=lambda r: str((r.doc_id, len(r.found))))))


def test_weak_supervision_tells_good_patterns_from_bad():
    patterns = [(3, "111-11" + "0", 50), (3, "--11-1" + "0", 40), (3, "-00-00" + "0", 40), (3, "-0--00" + "0", 30), (0, "111--1" + "1", 60)]
    post = pii.estimate(patterns)
    assert min(post[0], post[1], post[4]) > 0.8 and max(post[2], post[3]) < 0.2
    w = pii.fit_classifier(patterns, post)
    score = [sum(a * b for a, b in zip(w, pii._inputs(k, v))) for k, v, _ in patterns]
    assert [s > 0 for s in score] == [True, True, False, False, True]
    assert pii.estimate([]) == [] and len(pii.fit_classifier([], [])) == len(w)


def test_nearest_neighbours(spark):
    r = np.random.default_rng(4)
    x = r.normal(size=(300, 24))
    x[::3] *= 3  # norms differ, so the nearest by product are not the nearest by angle
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(300, rows[40][1]), (301, rows[40][1]), (302, None), (303, []), (304, [0.0] * 24), (305, [float("nan")] + [1.0] * 23),
             (306, [None] + [1.0] * 23), (307, [1.0, 2.0]), (None, rows[1][1]), (5, rows[5][1])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, rank int, qb int")
    got = collections.defaultdict(list)
    for q in ann.nearest(df, F.col("vec_id") % 20 == 0, 20).collect():
        got[q.query_id].append((q.rank, q.vec_id, q.score))
    use = {i: np.array(v) for i, v in rows if i is not None and i <= 301 and i != 307}
    hits = 0
    assert sorted(got) == list(range(0, 301, 20))
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21))
        assert all(s == pytest.approx(float(use[v] @ use[q]), rel=1e-12) for _, v, s in found)
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
        best = sorted((-float((use[v] * use[q]).sum()), v) for v in use if v != q)[:20]
        hits += len({v for _, v in best} & {f[1] for f in found})
    assert hits / (20 * len(got)) >= 0.9
    few = df.filter("vec_id IN (0, 1, 2, 302)")
    assert ann.nearest(few, F.lit(True), 20).count() == 6


def test_index_finds_every_code_in_the_radius():
    r = np.random.default_rng(9)
    codes = r.integers(0, 256, (400, ann.BITS // 8), dtype=np.uint8)
    index = ann.SubstringIndex(codes)
    for radius in (0, 15, 40, 57, 64, 100, ann.BITS):
        q = codes[7] ^ r.integers(0, 4, ann.BITS // 8, dtype=np.uint8)
        far = np.bitwise_count(codes ^ q).sum(axis=1)
        assert index.within(q, radius).tolist() == np.flatnonzero(far <= radius).tolist()


def test_chat_rotation(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob", None), (1, 3, "ann", "é!"), (1, 3, "ann", "é!"),
            (2, 0, "system", "alone"), (3, None, None, "x"), (None, 5, "ann", "y"), (4, 1, "ann", "z" * 9000)]
    rows += [(5, t, "ann" if t % 2 else "bob", f"t{t}") for t in range(200)]
    df = spark.createDataFrame([(*r, 1, "b") for r in rows], "conv_id long, turn long, role string, text string, n int, block string")
    got = {(r.conv_id, r.block, r.part, r.perspective): r for r in chat.rotate(df).collect()}
    assert {k[3] for k in got if k[0] == 1} == {"ann", "bob"} and not [k for k in got if k[0] == 2]
    r = got[1, 0, 0, "bob"]
    assert r.rendered == ("<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>user name=ann\nhi < |im_end|><|im_end|>\n"
                          "<|im_start|>assistant\n<|im_end|>\n" + "<|im_start|>user name=ann\né!<|im_end|>\n" * 2)
    for r in got.values():
        parts = [r.rendered[int(a):int(b)] for a, b in (m.split(":") for m in r.mask.split(",") if m)]
        turns = re.findall(r"<\|im_start\|>assistant\n(.*?<\|im_end\|>)\n", r.rendered, re.S)
        assert parts == turns and r.n_turns == r.rendered.count("<|im_start|>")
    assert sum(r.n_turns for k, r in got.items() if k[0] == 5 and k[3] == "ann") == 200
    assert {k[1] for k in got if k[0] == 5} == {0, 1, 2, 3}
    assert got[3, None, 0, "unknown"].n_turns == 1


def test_toxicity_learns_and_keeps_columns(spark):
    r = random.Random(8)
    rows, labels = [], []
    for i in range(700):
        w = _words(1000 + i, 40)
        toxic = i % 5 == 0
        if toxic:
            for _ in range(4):
                w[r.randrange(40)] = r.choice(["brugel", "brugelo", "brugelan", "idiot", "brugelix"])
        rows.append((i, " ".join(w), "x", "s", 1, 0.5))
        labels.append((i, 1, int(toxic)))
    rows += [(None, None, "x", "s", 1, 0.1), (9000, "", "x", "s", 1, 0.1), (9001, "IDIOT " * 20000, "x", "s", 1, 0.1)]
    labels += [(None, 1, 1), (3, 1, None), (4, 1, 0)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, label string, fold int, prediction double")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = toxicity.score(d, lab)
    assert out.columns == [*d.columns, "__score"]
    got = out.collect()
    assert len(got) == len(rows) and all(0 <= x["__score"] <= 1 for x in got)
    held = [x for x in got if x.doc_id is not None and x.doc_id < 700 and zlib.crc32(str(x.doc_id).encode()) % 5 == 0]
    right = sum((x["__score"] >= 0.5) == (x.doc_id % 5 == 0) for x in held)
    assert right / len(held) >= 0.95
    by = {x.doc_id: x["__score"] for x in got}
    assert by[9001] > by[9000]
    alone = toxicity.score(d, lab.filter("toxic = 0")).agg(F.max("__score")).first()[0]
    assert alone == 0.0


EMPTY_CHECKS = {
    "exact": lambda e: exact_dedup.exact_groups(e), "drop": lambda e: exact_dedup.drop_copies(e), "mix": lambda e: mixing.mix(e),
    "mixed": lambda e: mixing.mixed_documents(e), "jaccard": lambda e: jaccard_join.jaccard_components(e),
    "pack": lambda e: packing.pack(e, P.path("word_bpe_49k.json")), "pii": lambda e: pii.find_personal_data(e),
    "lm": lambda e: lm_score.score_documents(e, F.col("doc_id") % 2 == 0),
    "dac": lambda e: dac.read_documents(dac.write_token_files(e, common.scratch_path(e.sparkSession, "dac"), P.path("byte_bpe_50k.json"))),
    "toxic": lambda e: toxicity.score(e, e.sparkSession.createDataFrame([], "doc_id long, toxic int")),
}


@pytest.mark.parametrize("name", EMPTY_CHECKS)
def test_empty_tables(spark, name):
    assert EMPTY_CHECKS[name](spark.createDataFrame([], SCHEMA)).count() == 0


def test_empty_vectors_and_turns(spark):
    assert ann.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True), 5).count() == 0
    assert chat.rotate(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_personal_data_in_a_text_of_many_spans(spark):
    """Places, neighbours and overlaps of tens of thousands of spans in one text."""
    part = ["Mr Adam Lee", "x{i}@mail.example.com", "call 555-123-{n}", "10.0.0.{o}"]
    pieces = [part[i % 4].format(i=i, n=1000 + i % 9000, o=i % 250) for i in range(20_000)]
    text = " é ".join(pieces)
    row = pii.candidates(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")).filter("doc_id = 1").first()
    got = collections.Counter(pii.KINDS[x.k] for x in row.found)
    assert got == {"name": 5000, "email": 5000, "phone": 5000, "ip": 5000}
    for x in row.found[::97]:
        said = text[x.s:x.e]
        assert {"name": "Mr Adam", "email": "@mail", "phone": "555-123", "ip": "10.0.0."}[pii.KINDS[x.k]] in said
        assert not text[x.s - 1:x.s].isalnum() or x.s == 0


def test_weak_spans_that_touch_base_spans_go(spark):
    from pyspark.sql import functions as sf
    r = random.Random(6)
    rows = []
    for i in range(60):
        def spans(n):
            cuts = sorted(r.sample(range(400), 2 * n))
            return [(a, b, "m", "", "") for a, b in zip(cuts[::2], cuts[1::2])]
        rows.append((i, spans(r.randrange(0, 90)), [(a, b) for a, b, *_ in spans(r.randrange(0, 40)) + spans(r.randrange(0, 40))]))
    df = spark.createDataFrame(rows, f"i int, weak {pii._SPAN}, taken array<struct<s:int,e:int>>")
    out = df.select("i", pii._apart(sf.col("weak"), sf.col("taken")).alias("kept")).collect()
    for x in out:
        _, weak, taken = rows[x.i]
        want = [(a, b) for a, b, *_ in weak if not any(s < b and e > a for s, e in taken)]
        assert [(k.s, k.e) for k in x.kept] == want
