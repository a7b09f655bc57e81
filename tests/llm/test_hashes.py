"""Words made so that algebraic hashes of them meet: the operators must tell them apart."""

import collections

import brute
import numpy as np
import pyarrow as pa
import pytest
from test_text_operators import check_scores

from relocate.llm import hmm, minhash, substring, words


def thue_morse(size, first="a", second="b"):
    return "".join(second if bin(i).count("1") % 2 else first for i in range(size))


def pairs():
    """Words of equal length that sums of powers, sums of letters or exchanged places do not tell apart."""
    for size in (1024, 4096, 65536):
        yield thue_morse(size), thue_morse(size, "b", "a")
    yield "ab" * 3000, "ba" * 3000
    yield "abc" * 700 + "cba" * 700, "cba" * 700 + "abc" * 700
    yield "a" * 4095 + "b", "b" + "a" * 4095
    yield "x" * 2048, "y" * 2048


PAIRS = list(pairs())


def test_each_half_tells_them_apart():
    every = sorted({w for pair in PAIRS for w in pair} | {f"w{i}" for i in range(5000)})
    found = words.split_words(*words.layout(pa.array([" ".join(every)])))
    for lower in (False, True):
        first, second = (found.hashes(lower, half) for half in (False, True))
        assert len(np.unique(first)) == len(np.unique(second)) == len(every)
        assert not len(np.intersect1d(first, second))


def test_case_is_kept_or_dropped_for_letters_alone():
    found = words.split_words(*words.layout(pa.array(["Ab aB É é [ {", None, "ab"])))
    as_is, lower = found.hashes(), found.hashes(lower=True)
    assert len(np.unique(as_is)) == 7 and lower[0] == lower[1] == lower[6] and lower[2] != lower[3] and lower[4] != lower[5]


def test_empty_and_bordering_texts():
    none = words.split_words(*words.layout(pa.array([None, "", " "])))
    assert len(none.hashes()) == 0 and none.bounds.tolist() == [0, 0, 0, 0]
    close = words.split_words(*words.layout(pa.array(["one", "two", "onetwo"])))
    assert len(np.unique(close.hashes())) == 3


@pytest.fixture(scope="module")
def rows():
    tail = " ".join(f"tail{i}" for i in range(34))
    out = [(2 * i + side, f"{word} {tail}") for i, pair in enumerate(PAIRS) for side, word in enumerate(pair)]
    alone = [(100 + i, word) for i, word in enumerate(w for pair in PAIRS for w in pair)]
    return out + alone + [(200, brute.STORY * 3), (201, brute.STORY * 3)]


def test_substring_dedup_keeps_them(spark, rows):
    got = substring.without_repeats(brute.documents(spark, rows), 35, counts=("n", "gone")).collect()
    want = collections.Counter((len(own), sum(covered)) for own, covered in brute.repeats(rows, 35))
    assert want == collections.Counter((r.n, r.gone) for r in got)
    assert sum(r.gone > 0 for r in got) == 2


def test_near_dedup_keeps_them_apart(spark, rows):
    sets, groups = brute.near_groups(rows, 4)
    got = {r.doc_id: r for r in minhash.near_duplicates(brute.documents(spark, rows), shingle=4, percent=80).collect()}
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == {i: (len(sets[i]), groups.root(i)) for i in sets}


def test_counts_of_them(spark, rows):
    check_scores(rows, hmm.scored(brute.documents(spark, rows)).collect())
