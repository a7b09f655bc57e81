"""Word-based operators against plain versions: scoring, quality, near-duplicates, repeated passages."""

import collections
import hashlib
import math
import zlib

import brute
import pytest
from compare import database, differences

from relocate import llm
from relocate.llm import components, hmm, minhash, quality, substring

llm.load_all()


def given(spark, name="documents"):
    return [tuple(r) for r in spark.read.parquet(f"{brute.FOLDER}/{name}.parquet").select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(llm.ORACLES))
def test_query_matches_sql(spark, name):
    assert differences(llm.QUERIES[name](spark, brute.FOLDER), database(brute.FOLDER), llm.ORACLES[name]) == []


def check_scores(rows, got):
    texts = [(i, brute.words(brute.lower(t)) + [None]) for i, t in rows]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    counts = collections.Counter(w for i, own in texts if not held(i) for w in own)
    total, kinds = sum(counts.values()), len(counts)
    want = collections.Counter()
    for i, own in texts:
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in own)
        want[i, held(i), len(own), sum(counts[w] > 0 for w in own), total, round(base, 6)] += 1
    assert want == collections.Counter((r[0], *r[1:5], round(r.base_score, 6)) for r in got)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)


def test_scores_of_the_table(spark):
    got = llm.QUERIES["op1_hidden_markov_scoring"](spark, brute.FOLDER).collect()
    check_scores(given(spark), got)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_scores_of_odd_rows(spark):
    check_scores(brute.TEXTS, hmm.scored(brute.documents(spark)).collect())
    assert hmm.scored(brute.documents(spark, [])).collect() == []


def small_model():
    import numpy as np

    random = np.random.default_rng(3)
    norm = lambda x, axis: x / x.sum(axis=axis, keepdims=True)
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    model = hmm.Model(*none, np.zeros(hmm.BUCKETS, int), np.zeros(hmm.BUCKETS, int), 0, 0, 0)
    model.start, model.move = norm(random.random(3), 0), norm(random.random((3, 3)), 1)
    model.emit = norm(random.random((5, 3)), 0)
    return model, random


def test_likelihood_is_that_of_all_state_paths():
    import itertools

    import numpy as np

    model, random = small_model()
    sizes = np.array([1, 4, 7, 6])
    sequence = random.integers(0, 5, sizes.sum())
    for chain in (2, 3, 100):
        got = hmm.likelihoods(sequence, sizes, model, chain)
        at = 0
        for size, value in zip(sizes, got):
            own, total = sequence[at : at + size], 0.0
            for path in itertools.product(range(3), repeat=int(size)):
                p = model.start[path[0]] * model.emit[own[0], path[0]]
                for t in range(1, size):
                    p *= model.move[path[t - 1], path[t]] * model.emit[own[t], path[t]]
                total += p
            assert value == pytest.approx(math.log10(total), abs=1e-9)
            at += size


def test_baum_welch_counts_are_expected_counts():
    import itertools

    import numpy as np

    model, random = small_model()
    sizes = np.array([5, 3, 1])
    sequence = random.integers(0, 5, sizes.sum())
    counts = hmm.Counts(5, 3)
    counts.add(sequence, sizes, model, segment=100)
    emit, move, at = np.zeros((5, 3)), np.zeros((3, 3)), 0
    for size in sizes:
        own = sequence[at : at + size]
        paths = []
        for path in itertools.product(range(3), repeat=int(size)):
            p = model.start[path[0]] * model.emit[own[0], path[0]]
            for t in range(1, size):
                p *= model.move[path[t - 1], path[t]] * model.emit[own[t], path[t]]
            paths.append((path, p))
        total = sum(p for _, p in paths)
        for path, p in paths:
            for t in range(size):
                emit[own[t], path[t]] += p / total
                if t:
                    move[path[t - 1], path[t]] += p / total
        at += size
    assert np.allclose(counts.emit, emit, atol=1e-4)
    assert np.allclose(counts.move * model.move, move, atol=1e-4)


def test_quality_of_odd_rows(spark):
    got = quality.judged(brute.documents(spark)).collect()
    assert len(got) == len(brute.TEXTS)
    for r in got:
        own = brute.words(r.text)
        windows = collections.Counter(tuple(own[p : p + 5]) for p in range(len(own) - 4))
        covered = {q for p in range(len(own) - 4) if windows[tuple(own[p : p + 5])] > 1 for q in range(p, p + 5)}
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(own), sum(map(len, own)), len(covered))
        assert r.base_failed == (len(own) < 10 or 100 * len(covered) > 20 * len(own))
        assert (r.clean_text is None) == (r.text is None)
    assert quality.judged(brute.documents(spark, [])).collect() == []


def test_lines_that_fail_go(spark):
    good = "This is a sentence that says something worth keeping for later."
    other = "Another statement follows, quite unlike the first one, and ends with a mark!"
    text = f"Home | News | About\n{good}\nAll rights reserved.\nno end here\n{other}\n### $$$ %%% now."
    row = quality.judged(brute.documents(spark, [(1, text)])).first()
    assert row.kept and row.clean_text == f"{good}\n{other}"


def check_groups(rows, got, size):
    sets, groups = brute.near_groups(rows, size)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert (r.component_id, r.kept) == (None, True)
        else:
            root = groups.root(r.doc_id)
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), root, root == r.doc_id)


def test_near_duplicates_of_the_table(spark):
    check_groups(given(spark), llm.QUERIES["op4_minhash_near_dedup"](spark, brute.FOLDER).collect(), 4)


def test_near_duplicates_of_odd_rows(spark):
    rows = [r for r in brute.TEXTS if r[0] is not None]
    got = minhash.near_duplicates(brute.documents(spark)).collect()
    check_groups(rows, [r for r in got if r.doc_id is not None], 5)
    assert [r.kept for r in got if r.doc_id is None] == [True]
    assert minhash.near_duplicates(brute.documents(spark, [])).collect() == []


def test_groups_around_a_centre_that_links_only_some(spark, monkeypatch):
    """A chain of copies, each like the next alone, in blocks of a few sets."""
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 300)
    monkeypatch.setattr(minhash, "REST_SHINGLES", 200)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(24):
        own = list(base)
        own[: i * 4] = [f"n{j}" for j in range(i * 4)]
        rows.append((i, " ".join(own)))
    check_groups(rows, minhash.near_duplicates(brute.documents(spark, rows), shingle=3).collect(), 3)


def test_signatures_agree_as_often_as_sets_overlap():
    import numpy as np

    random = np.random.default_rng(1)
    shared, one, two = (random.integers(0, 2**63, n, dtype=np.uint64) for n in (800, 100, 100))
    sets = [np.unique(np.concatenate([shared, x])) for x in (one, two)]
    found = minhash.superminhash(np.concatenate(sets), np.array([0, 900, 1800]), 2000)
    assert abs((found[0] == found[1]).mean() - 0.8) < 0.04
    tiny = minhash.superminhash(sets[0][:3], np.array([0, 1, 1, 3]), 50)
    assert len(set(tiny[0] >> np.uint64(32))) == 50 and (tiny[1] == minhash._UNSET).all() and (tiny[2] != minhash._UNSET).all()


def test_components(spark):
    edges = [(1, 2), (2, 1), (3, 3), (5, 4), (9, 5), (7, 9), (2, 2)] + [(100 + i, 101 + i) for i in range(60)]
    got = dict(components.components(spark.createDataFrame(edges, "x long, y long").repartition(7)).collect())
    want = {1: 1, 2: 1, 4: 4, 5: 4, 9: 4, 7: 4} | {100 + i: 100 for i in range(61)}
    assert got == want
    assert components.components(spark.createDataFrame([], "x long, y long")).collect() == []


def check_removed(rows, got, size):
    want = collections.Counter()
    for (i, _), (own, covered) in zip(rows, brute.repeats(rows, size)):
        want[i, len(own), sum(covered), " ".join(w for w, c in zip(own, covered) if not c)] += 1
    assert want == collections.Counter((r[0], r[1], r[2], r[3]) for r in got)


def test_repeated_passages_of_the_table(spark):
    got = llm.QUERIES["op9_substring_dedup"](spark, brute.FOLDER).collect()
    rows = given(spark)
    want = {}
    for (i, _), (own, covered) in zip(rows, brute.repeats(rows, 35)):
        kept = " ".join(w for w, c in zip(own, covered) if not c)
        want[i] = (len(own), sum(covered), hashlib.sha256(kept.encode()).hexdigest())
    assert want == {r.doc_id: tuple(r)[1:] for r in got}


@pytest.mark.parametrize("size", [3, 20, 35])
def test_repeated_passages_of_odd_rows(spark, size):
    docs = brute.documents(spark)
    got = substring.without_repeats(docs, size, counts=("n_words", "lost")).collect()
    check_removed(brute.TEXTS, [(r.doc_id, r.n_words, r.lost, " ".join(brute.words(r.text))) for r in got], size)
    assert {r.text for r in got if r.doc_id == 1} == {None}
    assert substring.without_repeats(brute.documents(spark, []), size).collect() == []


def test_other_columns_and_blanks_stay(spark):
    passage = " ".join(f"p{i}" for i in range(12))
    rows = [(1, f"Head\tof  it\n\n{passage}\nand the  tail "), (2, f"{passage} end"), (3, "as\tit  is ")]
    got = substring.without_repeats(brute.documents(spark, rows), 10)
    assert got.columns == brute.documents(spark).columns
    assert {r.doc_id: (r.text, r.payload) for r in got.collect()} == {
        1: ("Head\tof  it\n\nand the  tail", 1), 2: ("end", 1), 3: ("as\tit  is ", 1)
    }


def test_scores_do_not_depend_on_the_layout_of_files(spark):
    docs = spark.read.parquet(f"{brute.FOLDER}/documents.parquet").select("doc_id", "text")
    layouts = [hmm.scored(docs.repartition(n).sortWithinPartitions("text")).collect() for n in (1, 7)]
    one, two = ({r.doc_id: r for r in rows} for rows in layouts)
    # counts are added up in single precision, in another order
    assert all(two[i].score == pytest.approx(r.score, rel=1e-4) and two[i].base_score == pytest.approx(r.base_score, rel=1e-9) for i, r in one.items())


def test_training_covers_texts_longer_than_the_start(spark, monkeypatch):
    monkeypatch.setattr(hmm, "START_TOKENS", 500)
    rows = [(i, " ".join(f"w{(i + k) % 7} and" for k in range(2000))) for i in range(12)]
    got = hmm.scored(brute.documents(spark, rows)).collect()
    check_scores(rows, got)
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_every_pass_counts_all_training_texts(spark, monkeypatch):
    monkeypatch.setattr(hmm, "START_TOKENS", 500)
    rows = [(i, " ".join(f"w{(i * k) % 11}" for k in range(400))) for i in range(30)]
    counted, plain = [], hmm._updated
    monkeypatch.setattr(
        hmm, "_updated", lambda model, rows, share: counted.append((rows[: model.end + 1].sum(), model.tokens)) or plain(model, rows, share)
    )
    check_scores(rows, hmm.scored(brute.documents(spark, rows)).collect())
    assert len(counted) > 1 and all(found == pytest.approx(tokens, rel=1e-4) for found, tokens in counted)


def test_batches_of_a_task_do_not_change_what_is_counted():
    import numpy as np

    model, random = small_model()
    sizes = random.integers(1, 60, 40)
    sequence = random.integers(0, 5, sizes.sum())
    whole, cut = hmm.Counts(5, 3), hmm.Counts(5, 3)
    whole.add(sequence, sizes, model, 16)
    cut.add(sequence, sizes, model, 16, at_once=20)
    assert np.allclose(whole.rows(), cut.rows(), rtol=1e-4, atol=1e-4) and whole.tokens == cut.tokens == sizes.sum()


def test_scores_equal_a_plain_forward_pass(spark):
    """The likelihood of each text by one multiplication a token, with the trained model."""
    import numpy as np

    rows = given(spark)[:40]
    docs = brute.documents(spark, rows)
    models = []
    plain = hmm._scoring
    hmm._scoring = lambda model, ranges, chain: models.append(model) or plain(model, ranges, 64)
    try:
        got = {r.doc_id: r for r in hmm.scored(docs).collect()}
    finally:
        hmm._scoring = plain
    (model,) = models
    texts = [(i, brute.words(brute.lower(t))) for i, t in rows]
    counts = collections.Counter(w for i, own in texts if not got[i].held_out for w in own)
    for i, own in texts:
        state, log = None, 0.0
        for word in [*own, None]:
            if word is None:
                place, inside = model.end, 1.0
            else:
                import pyarrow as pa

                from relocate.llm import words

                found = words.split_words(*words.layout(pa.array([word])))
                key, bucket = found.hashes(lower=True), hmm._buckets(found, np.array([0]))
                place = int(model.classes(key, bucket)[0])
                inside = 10 ** float(model.inside(np.array([place]), np.array([counts[word]]))[0])
            state = (model.start if state is None else state @ model.move) * model.emit[place]
            log += math.log10(state.sum() * inside)
            state = state / state.sum()
        assert got[i].score == pytest.approx(log, rel=1e-9)
