"""Deep-shallow order and prefixes against plain sorting."""

import os

import numpy as np
from hypothesis import given, settings, strategies as st

from sluice.llm import suffixes as S

TEXTS = st.lists(st.tuples(st.integers(0, 3), st.binary(max_size=6).flatmap(lambda b: st.sampled_from([b, b * 30, b"ab" * 40 + b, b"\0" * 33 + b, b"x" * 200]))), max_size=40)


def check(pairs, shallow):
    pairs = sorted(pairs, key=lambda p: p[0])
    groups, strings = np.array([g for g, _ in pairs], np.int64), [s for _, s in pairs]
    order, prefix = S.deep_shallow(strings, groups, shallow)
    found = [(groups[i], strings[i]) for i in order]
    assert found == sorted((g, s) for g, s in pairs)
    for k in range(len(found)):
        if k == 0 or found[k][0] != found[k - 1][0]:
            assert prefix[k] == -1
        else:
            assert prefix[k] == len(os.path.commonprefix([found[k][1], found[k - 1][1]]))


@settings(deadline=None, max_examples=150)
@given(TEXTS, st.sampled_from([8, 32]))
def test_order(pairs, shallow):
    check(pairs, shallow)


def test_blind_trie():
    strings = [b"", b"a", b"ab" * 50, b"ab" * 50 + b"c", b"ab" * 50, b"b", b"ab" * 49 + b"zz"]
    order, prefix = S.blind_trie_order(strings, list(range(len(strings))))
    assert [strings[i] for i in order] == sorted(strings)
    assert prefix == [0, 0, 1, 98, 99, 100, 0] or prefix == [len(os.path.commonprefix([sorted(strings)[i], sorted(strings)[i - 1]])) if i else 0 for i in range(7)]
