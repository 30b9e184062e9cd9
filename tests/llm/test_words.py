import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from jobmart.llm import darts, quality, rules, words

TEXT = st.text(alphabet="ab é\t\n\x0b\x0c\r .|#ß", max_size=80)


def _data(text):
    data = words.as_bytes(text.encode())
    return data, *words.bounds(data)


@given(TEXT)
@settings(max_examples=200, deadline=None)
def test_words_are_runs_between_separators(text):
    data, starts, ends = _data(text)
    found = [data[a:b].tobytes().decode() for a, b in zip(starts, ends, strict=True)]
    assert found == re.findall(r"[^\x20\x09-\x0D]+", text)
    hashed = words.hashes(data, starts, ends).tolist()
    assert len(set(hashed)) == len(set(found))
    assert len(set(zip(found, hashed, strict=True))) == len(set(found))


@given(st.lists(st.sampled_from("abcd"), max_size=40))
@settings(max_examples=200, deadline=None)
def test_repeated_words_by_brute_force(tokens):
    data, starts, ends = _data(" ".join(tokens))
    counts = Counter(tuple(tokens[i : i + 5]) for i in range(len(tokens) - 4))
    covered = {i + k for i in range(len(tokens) - 4) for k in range(5) if counts[tuple(tokens[i : i + 5])] > 1}
    assert rules.repeated_words(words.hashes(data, starts, ends)) == len(covered)


def test_hashes_do_not_depend_on_blocks():
    text = ("x" * (1 << 19) + " ") + "word and " * 60_000
    data, starts, ends = _data(text)
    hashed = words.hashes(data, starts, ends)
    assert len(set(hashed.tolist())) == 3
    assert hashed[1] == words.hashes(*_data("word"))[0]


def test_signatures_estimate_weighted_similarity():
    draw = np.random.default_rng(3)
    for n, shared in ((400, 0.9), (30, 0.5), (4, 0.5)):
        pool = words.mixed(draw.integers(1, 2**60, 2 * n).astype(np.uint64))
        m = int(n * shared)
        weight = draw.integers(1, 4, 2 * n) * draw.choice([0.5, 1.0, 1.7])
        a, b = np.arange(n), np.concatenate([np.arange(m), np.arange(n, 2 * n - m)])
        common = weight[:m].sum()
        real = common / (weight[a].sum() + weight[b].sum() - common)
        agree = [
            (darts.signature(x[a], weight[a], 120) == darts.signature(x[b], weight[b], 120)).mean()
            for x in (words.mixed(pool + np.uint64(k)) for k in range(25))
        ]
        assert abs(np.mean(agree) - real) < 0.04


def test_a_signature_does_not_depend_on_order():
    pool = words.mixed(np.arange(1, 300, dtype=np.uint64))
    weight = np.ones(len(pool))
    order = np.random.default_rng(1).permutation(len(pool))
    assert (darts.signature(pool, weight, 90) == darts.signature(pool[order], weight, 90)).all()
    assert len(set(darts.bands(np.zeros(12, dtype=np.uint64), 3).tolist())) == 4


def test_features_of_empty_texts():
    assert quality.features(None).tolist() == quality.features(b" \n").tolist() == [0.0] * quality.N_FEATURES
