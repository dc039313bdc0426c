"""The Elias-Fano sequence and the trie against plain arrays."""

import numpy as np
import pytest

from fleetlens.llm import elias_fano as ef


@pytest.mark.parametrize("n,universe", [(0, 10), (1, 1), (5, 1 << 40), (700, 900), (5000, 5000), (3000, 1 << 48)])
def test_access_and_locate(n, universe, monkeypatch):
    monkeypatch.setattr(ef, "CHUNK", 1000)
    r = np.random.default_rng(n)
    v = np.sort(r.integers(0, universe, n))
    e = ef.EliasFano.of(ef.read_arrays(ef.write_arrays(ef.EliasFano.parts(v, universe))))
    assert e.access(np.arange(n)).tolist() == v.tolist()
    ask = np.concatenate([v, r.integers(0, universe, 2000), [0, universe - 1]])
    at = e.locate(ask)
    assert ((at >= 0) == np.isin(ask, v)).all()
    assert (v[at[at >= 0]] == ask[at >= 0]).all()


def test_trie_finds_exactly_its_bigrams():
    r = np.random.default_rng(3)
    words = np.unique(r.integers(0, 1 << 30, 4000))
    pairs = np.unique(np.concatenate([r.integers(0, len(words), (20000, 2)), np.c_[np.full(3000, 7), np.arange(3000)]]), axis=0)
    log_p = -r.random(len(pairs)) * 6
    trie = ef.NgramTrie(ef.NgramTrie.build(words, pairs[:, 0], pairs[:, 1], log_p))
    contexts, which = np.unique(pairs[:, 0], return_inverse=True)
    codes = trie.codes_of(words[contexts], which, words[pairs[:, 1]])
    assert (codes > 0).all() and np.abs(trie.book[codes] - log_p).max() <= 6 / 255
    known = set(map(tuple, pairs.tolist()))
    ask = np.array([p for p in r.integers(0, len(words), (5000, 2)).tolist() if tuple(p) not in known])
    contexts, which = np.unique(ask[:, 0], return_inverse=True)
    assert not trie.codes_of(words[contexts], which, words[ask[:, 1]]).any()
    assert not trie.codes_of(np.array([1 << 31]), np.array([0]), words[:1]).any()
