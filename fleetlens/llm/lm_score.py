"""Language-model scores from an Elias-Fano n-gram trie.

Tokens are the words of the lower-cased (A-Z) text and one end. The model mixes
bigrams with the add-one unigrams by a Dirichlet prior:

    p1(x)   = (c(x) + 1) / (N + V + 1)
    p(x|v)  = (c(v, x) + MU p1(x)) / (c(v) + MU)

with counts from the training documents; ``v`` is the word before or the start.
Seen bigrams' ``log10 p(x|v)`` are quantised to 8 bits in tries; unseen ones
back off exactly.

Words get dense numbers from the shard that counts them, small ones for
frequent words. The model is dealt by bigram hash to shards, so a word that follows or precedes
a third of everything is spread over all of them. Documents are tokenised once
in batches of at most ``BATCH_TOKENS`` tokens (or one document); a batch sends
each shard its distinct words, later its distinct bigrams, with their training
counts, in packed arrays. The shard adds the counts, writes its trie to the
shared folder, maps it, looks every bigram up in it, and answers each batch in
the order it was asked. So what moves is one entry per batch and distinct
bigram, and no table of the corpus is ever whole in one place.

Defined results: a null or wordless text is its end alone; a null id is held
in (its remainder counts as 0); repeated rows are separate documents; without
training documents all counts are 0; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import crc_mod, load, shuffle_partitions, staged
from fleetlens.llm.elias_fano import NgramTrie, read_arrays, write_arrays
from fleetlens.llm.shingles import mix, word_hashes
from fleetlens.session import scratch_path

BATCH_TOKENS = 1_000_000
MU = 4.0
END, START = np.uint64(1), np.uint64(2)
_U64 = np.uint64


def _pack(arrays: list[np.ndarray]) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(write_arrays(arrays))


def _unpack(data: bytes) -> list[np.ndarray]:
    return read_arrays(zstandard.ZstdDecompressor().decompress(data))


def _planes(a: np.ndarray) -> np.ndarray:
    """Bytes of small numbers, lowest byte of all first: packs well."""
    return np.ascontiguousarray(a.astype("<u4").view(np.uint8).reshape(-1, 4).T).ravel()


def _wide_planes(a: np.ndarray) -> np.ndarray:
    """As :func:`_planes`, for 8 bytes."""
    return np.ascontiguousarray(a.astype("<i8").view(np.uint8).reshape(-1, 8).T).ravel()


def _join_wide_planes(p: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(p.reshape(8, -1).T).view("<i8").ravel()


def _join_planes(p: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(p.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


_BATCHES = "batch long, n_train long, n_docs long, data binary"


def _tokenise(batches):
    """A row per batch of documents: ids, held flags, lengths, its words from
    the most frequent on, and the texts as positions in them."""
    from pyspark import TaskContext

    part, seq = TaskContext.get().partitionId(), 0
    docs, size = [], 0

    def row():
        tokens = np.concatenate([np.append(w, END) for _, _, w in docs])
        lengths = np.array([len(w) + 1 for _, _, w in docs], "<u4")
        held = np.array([h for _, h, _ in docs], np.uint8)
        words, inverse, count = np.unique(tokens, return_inverse=True, return_counts=True)
        order = np.argsort(-count, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        n_train = int(lengths[held == 0].sum())
        data = _pack([np.array([d or 0 for d, _, _ in docs], "<i8"), np.array([d is None for d, _, _ in docs], np.uint8),
                      held, lengths, words[order].astype("<u8"), _planes(place[inverse])])
        return pa.RecordBatch.from_arrays([pa.array([(part << 20) + seq]), pa.array([n_train]), pa.array([len(docs)]),
                                           pa.array([data], pa.binary())], ["batch", "n_train", "n_docs", "data"])
    for b in batches:
        for d, h, text in zip(*(b.column(c).to_pylist() for c in ("doc_id", "held", "text"))):
            w = np.maximum(word_hashes(text), _U64(3))  # 0 to 2 are no words
            if docs and size + len(w) > BATCH_TOKENS:
                yield row()
                docs, size, seq = [], 0, seq + 1
            docs.append((d, h, w))
            size += len(w) + 1
    if docs:
        yield row()


class _Batch:
    """A batch of tokenised documents."""

    def __init__(self, data: bytes):
        ids, nulls, held, self.lengths, self.words, planes = _unpack(data)
        self.ids = [None if z else int(d) for d, z in zip(ids, nulls)]
        self.held = held.astype(bool)
        self.tokens = _join_planes(planes)
        self.train = np.repeat(~self.held, self.lengths)
        self.first = np.cumsum(self.lengths, dtype=np.int64) - self.lengths

    def word_shards(self, shards: int):
        """Positions of the words of every shard."""
        shard = ((mix(self.words) >> _U64(32)) * _U64(shards) >> _U64(32)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        return order, np.searchsorted(shard[order], np.arange(shards + 1))

    def bigrams(self, shards: int):
        """Distinct bigrams by shard, context and successor: the cuts between
        shards, contexts (the start is one past the words), successors, and the
        number of the bigram of every token."""
        n = len(self.words) + 1
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        before[self.first] = n - 1
        kinds, inverse = np.unique(before * n + self.tokens, return_inverse=True)
        v, x = kinds // n, kinds % n
        hashes = np.append(self.words, START)
        shard = ((mix(hashes[v] * _U64(0x9E3779B97F4A7C15) + hashes[x]) >> _U64(32)) * _U64(shards) >> _U64(32)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        return np.searchsorted(shard[order], np.arange(shards + 1)), v[order], x[order], number[inverse]


_SENT = "shard int, batch long, data binary"


def _sent(rows) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [[]] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int32(), pa.int64(), pa.binary()))],
                                      ["shard", "batch", "data"])


def _send_words(shards: int):
    def run(batches):
        for b in batches:
            for batch, data in zip(b.column("batch").to_pylist(), b.column("data").to_pylist()):
                t = _Batch(data)
                count = np.bincount(t.tokens[t.train], minlength=len(t.words))
                order, cut = t.word_shards(shards)
                yield _sent([(s, batch, _pack([t.words[i], count[i].astype("<u4")]))
                             for s in range(shards) if len(i := order[cut[s]:cut[s + 1]])])
    return run


_ANSWERS = "kind int, batch long, shard int, distinct long, data binary"


def _answers(kind, rows):
    cols = list(zip(*rows)) or [[]] * 4
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
    return pa.table([pa.array([kind] * len(rows), pa.int32()), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                    names=["kind", "batch", "shard", "distinct", "data"])


def _count_words(shards: int):
    """Training count and number of every word asked for; the first row says
    how many words with a count the shard has. A shard numbers its words from
    the most frequent on, in steps of ``shards``; 0 is the start."""
    def run(key, table):
        return _answer_words(shards, key, table)
    return run


def _answer_words(shards: int, key, table):
    asked = [_unpack(d) for d in table.column("data").to_pylist()]
    words, inverse = np.unique(np.concatenate([a[0] for a in asked]), return_inverse=True)
    total = np.bincount(inverse, weights=np.concatenate([a[1] for a in asked])).astype("<u4")
    rows, at, distinct, shard = [], 0, int((total > 0).sum()), key[0].as_py()
    number = np.empty(len(total), np.int64)
    number[np.argsort(-total.astype(np.int64), kind="stable")] = np.arange(len(total)) * shards + shard + 1
    for batch, a in zip(table.column("batch").to_pylist(), asked):
        mine = inverse[at: at + len(a[0])]
        rows.append((batch, shard, distinct, _pack([_planes(total[mine]), _wide_planes(number[mine])])))
        distinct, at = 0, at + len(a[0])
    return _answers(0, rows)


def _counts_of(t: _Batch, answers, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Training counts and numbers of the batch's words."""
    order, cut = t.word_shards(shards)
    counts, numbers = np.zeros((2, len(t.words)), np.int64)
    for r in answers:
        if r["kind"] == 0:
            mine = order[cut[r["shard"]]: cut[r["shard"] + 1]]
            c, n = _unpack(r["data"])
            counts[mine], numbers[mine] = _join_planes(c), _join_wide_planes(n)
    return counts, numbers


def _send_bigrams(shards: int, docs: int):
    def run(left, right):
        rows = []
        for r in left.to_pylist():
            t = _Batch(r["data"])
            counts, numbers = _counts_of(t, right.to_pylist(), shards)
            counts, numbers = np.append(counts, docs), np.append(numbers, 0)  # every training document has one start
            cut, v, x, number = t.bigrams(shards)
            train = np.bincount(number[t.train], minlength=len(v))
            for s in range(shards):
                a, z = cut[s], cut[s + 1]
                if a < z:
                    used, both = np.unique(np.concatenate([v[a:z], x[a:z]]), return_inverse=True)
                    order = np.argsort(numbers[used])
                    rank = np.empty_like(order)
                    rank[order] = np.arange(len(order))
                    left_, right_ = rank[both[: z - a]], rank[both[z - a:]]
                    sort = np.argsort(left_, kind="stable")  # contexts in steps; the answer comes in this order
                    rows.append((s, r["batch"], _pack([
                        _wide_planes(np.diff(numbers[used][order], prepend=0)), _planes(counts[used][order]),
                        _planes(np.diff(left_[sort], prepend=0)), _planes(right_[sort]), _planes(train[a:z][sort])])))
        return pa.Table.from_batches([_sent(rows)])
    return run


def _trie_shard(folder: str, total: int, distinct: int):
    """Add up a shard's bigrams, write its trie, and look every one up in it."""
    def run(key, table):
        shard = key[0].as_py()
        asked = [_unpack(d) for d in table.column("data").to_pylist()]
        words = [np.cumsum(_join_wide_planes(a[0])) for a in asked]
        counts = [_join_planes(a[1]) for a in asked]
        vocabulary, at = np.unique(np.concatenate(words), return_index=True)
        c = np.concatenate(counts)[at]
        n = len(vocabulary)
        keys = []
        for w, a in zip(words, asked):
            ids = np.searchsorted(vocabulary, w)
            keys.append(ids[np.cumsum(_join_planes(a[2]))] * n + ids[_join_planes(a[3])])
        kinds, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        train = np.bincount(inverse, weights=np.concatenate([_join_planes(a[4]) for a in asked]))
        v, x = kinds // n, kinds % n
        seen = train > 0
        p1 = (c[x] + 1) / (total + distinct + 1)
        log_p = np.log10((train + MU * p1) / (c[v] + MU))
        data = NgramTrie.build(vocabulary, v[seen], x[seen], log_p[seen])
        trie = NgramTrie(_store(folder, shard, data))
        contexts, which = np.unique(v, return_inverse=True)
        codes = trie.codes_of(vocabulary[contexts], which, vocabulary[x])
        rows, at = [], 0
        for batch, k in zip(table.column("batch").to_pylist(), keys):
            rows.append((batch, shard, 0, _pack([codes[inverse[at: at + len(k)]], trie.book])))
            at += len(k)
        return _answers(1, rows)
    return run


def _store(folder: str, shard: int, data: bytes):
    """Write a trie under a name of this attempt in the shared folder and map it."""
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(folder)
    store.create_dir(base, recursive=True)
    name = f"{base}/trie-{shard:06d}-{uuid.uuid4().hex}.eft"
    with store.open_output_stream(name) as f:
        f.write(data)
    if isinstance(store, fs.LocalFileSystem):
        with pa.memory_map(name) as f:
            return f.read_buffer()
    with store.open_input_file(name) as f:
        return f.read_buffer()


_SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _score_batches(shards: int, docs: int, total: int, distinct: int):
    def run(left, right):
        out = []
        answers = right.to_pylist()
        for r in left.to_pylist():
            t = _Batch(r["data"])
            counts, numbers = _counts_of(t, answers, shards)
            log_1 = np.log10((counts + 1) / (total + distinct + 1))
            cut, v, x, number = t.bigrams(shards)
            log_p = np.log10(MU / (np.append(counts, docs)[v] + MU)) + log_1[x]  # unseen bigrams
            for a in answers:
                if a["kind"] == 1:
                    codes, book = _unpack(a["data"])
                    part = np.arange(cut[a["shard"]], cut[a["shard"] + 1])
                    part = part[np.argsort(np.append(numbers, 0)[v[part]], kind="stable")]  # the order it was sent in
                    log_p[part] = np.where(codes > 0, book[codes], log_p[part])
            base = np.add.reduceat(log_1[t.tokens], t.first)
            score = np.add.reduceat(log_p[number], t.first)
            known = np.add.reduceat((counts > 0)[t.tokens].astype(np.int64), t.first)
            out.append(pa.table([pa.array(t.ids, pa.int64()), pa.array(t.held), pa.array(t.lengths.astype(np.int64)),
                                 pa.array(known), pa.array(np.full(len(known), total, np.int64)), pa.array(base), pa.array(score)],
                                names=[c.split()[0] for c in _SCORES.split(", ")]))
        return pa.concat_tables(out) if out else pa.schema([(n, k) for n, k in zip(
            [c.split()[0] for c in _SCORES.split(", ")],
            [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()])]).empty_table()
    return run


def score_documents(docs: DataFrame, held_out, shards: int | None = None) -> DataFrame:
    """Scores of all documents by a model of those that are not ``held_out`` (a column)."""
    spark = docs.sparkSession
    n = shards or shuffle_partitions(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held"), F.col("text").cast("string").alias("text"))
    made = staged(rows.mapInArrow(_tokenise, _BATCHES), "lm-batches")
    sent = made.select("batch", "data").mapInArrow(_send_words(n), _SENT)
    words = staged(sent.groupBy("shard").applyInArrow(_count_words(n), _ANSWERS), "lm-words")
    total = made.agg(F.sum("n_train")).first()[0] or 0
    distinct = words.agg(F.sum("distinct")).first()[0] or 0
    train_docs = docs.filter(~held_out).count()
    by_batch = made.select("batch", "data").groupBy("batch")
    bigrams = by_batch.cogroup(words.groupBy("batch")).applyInArrow(_send_bigrams(n, train_docs), _SENT)
    found = bigrams.groupBy("shard").applyInArrow(_trie_shard(scratch_path(spark, "lm-tries"), total, distinct), _ANSWERS)
    return by_batch.cogroup(words.unionByName(found).groupBy("batch")).applyInArrow(
        _score_batches(n, train_docs, total, distinct), _SCORES)


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return score_documents(docs, crc_mod(F.col("doc_id"), 7) == 2)
