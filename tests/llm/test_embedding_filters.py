"""Recall of operator 7's filters."""

import numpy as np

from candlewick.llm import embedding_dedup as ED


def test_pairs_at_the_cosine_share_a_filter_at_every_code_size():
    r = np.random.default_rng(31)
    for k, n in ((64, 300), (1001, 500), (4096, 400)):
        one, two = ED.unit(r.normal(size=(n, 64))), r.normal(size=(n, 64))
        two = ED.unit(two - (one * two).sum(axis=1, keepdims=True) * one) * np.sqrt(1 - 0.95**2) + 0.95 * one
        keys = ED.filters(np.concatenate((one, two)), k, ED.rotations_for(64, k, 0.95))
        assert all(len(np.intersect1d(a, b)) for a, b in zip(keys[:n], keys[n:], strict=True)), k
