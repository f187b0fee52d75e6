"""Which shingles count as frequent bears on cost alone: any two sets that link
share a signature, whatever is marked."""

import numpy as np
import pytest

from touchline.llm.arrays import U64
from touchline.llm.similarity_join import signatures


@pytest.mark.parametrize("size", [1, 2, 5, 7, 12, 40, 150, 700])
def test_linked_sets_share_a_signature_whatever_is_frequent(size):
    rng = np.random.default_rng(size)
    for _ in range(12):
        a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        # a partner at the limit: some shingles replaced, some left out or added
        differ = 2 * size // 7
        out = rng.integers(0, differ + 1)
        more = rng.integers(0, 1 << 63, differ - out, dtype=np.uint64)
        b = np.unique(np.concatenate([rng.permutation(a)[out:], more]))
        both = len(np.intersect1d(a, b))
        if 100 * both < 75 * (len(a) + len(b) - both):
            continue
        every = np.union1d(a, b)
        for hot in (every[:0], every, a, rng.permutation(every)[: len(every) // 2], rng.permutation(every)[: len(every) // 10]):
            sa, sb = (np.concatenate(signatures(x.astype(U64), np.isin(x, hot))) for x in (a, b))
            assert len(np.intersect1d(sa, sb))
