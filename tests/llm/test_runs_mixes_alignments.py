"""Periodic runs, curriculum mixes and token alignments against plain versions."""

import collections
import hashlib
import random
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest

from relocate import llm
from relocate.llm import align, curriculum, periods
from relocate.llm.queries import BYTE_TOKENIZER, PIECE_TOKENIZER

llm.load_all()

ROUND = "one two three four five six seven eight nine ten "


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def given(spark, *columns):
    return [tuple(r) for r in spark.read.parquet(f"{brute.FOLDER}/documents.parquet").select(*columns).collect()]


# --- periodic runs ---


def plain_runs(own, least=24, times=3):
    """Every lag, every stretch, every smaller period."""
    found = []
    for q in range(1, len(own) // times + 1):
        i = 0
        while i + q < len(own):
            j = i
            while j + q < len(own) and own[j] == own[j + q]:
                j += 1
            stretch = own[i : j + q]
            if len(stretch) >= max(least, times * q) and not any(stretch[p:] == stretch[:-p] for p in range(1, q)):
                found.append((i, len(stretch), q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_collapse(own, found):
    dropped = {i for start, length, period in found for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(own) if i not in dropped)


def test_runs_equal_those_of_all_lags():
    draw = random.Random(4)
    for _ in range(600):
        size, kinds = draw.randint(0, 240), draw.choice([1, 2, 2, 3, 5, 40])
        own = [draw.randrange(kinds) for _ in range(size)]
        for _ in range(draw.randint(0, 4) if size > 30 else 0):
            at, period, end = draw.randrange(size), draw.randint(1, 40), min(size, draw.randrange(size) + 150)
            for i in range(at + period, end):
                own[i] = own[i - period]
        for least, times in ((24, 3), (10, 3), (40, 4)):
            assert periods.runs(np.array(own, np.int32), least, times) == plain_runs(own, least, times)


def test_runs_of_texts_made_to_repeat_in_many_ways():
    a, b = [0], [0, 1]
    while len(b) < 700:
        a, b = b, b + a
    thue = [bin(i).count("1") % 2 for i in range(512)]
    nested = ([0, 1] * 20 + [2]) * 9
    for own in (b, thue, nested, [0] * 500, [0, 1, 0, 0, 1] * 60, list(range(80)) * 4):
        assert periods.runs(np.array(own, np.int32)) == plain_runs(own)


def test_one_word_a_million_times():
    assert periods.runs(np.zeros(1_000_000, np.int32)) == [(0, 1_000_000, 1)]


def test_strongest_run_is_chosen_exactly():
    assert periods.strongest([(5, 30, 10), (0, 60, 20), (9, 31, 10)]) == (9, 31, 10)
    assert periods.strongest([(3, 3 * 10**15 + 1, 10**15), (9, 3 * 10**15 + 2, 10**15)]) == (9, 3 * 10**15 + 2, 10**15)
    assert periods.strongest([(0, 60, 20), (5, 30, 10)]) == (0, 60, 20)
    assert periods.strongest([]) is None


def test_runs_below_three_periods_are_refused(spark):
    with pytest.raises(ValueError):
        periods.collapsed(brute.documents(spark), min_times=2)


def check_runs(rows, got):
    want = collections.Counter()
    for i, text in rows:
        own = brute.words(text)
        found = plain_runs(own) if len(own) < 3000 else None
        if found is not None:
            want[i, len(own), tuple(found), None if text is None else plain_collapse(own, found)] += 1
    short = [r for r in got if r.n_words < 3000]
    assert want == collections.Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.text) for r in short)
    assert len(got) == len(rows)


def test_collapsed_odd_rows(spark):
    rows = [*brute.TEXTS, (20, ROUND * 9 + "end"), (20, ROUND * 9 + "end"), (None, "x " * 100), (21, "a\x0bb \x1f c" * 40)]
    got = periods.collapsed(brute.documents(spark, rows)).collect()
    check_runs(rows, got)
    assert next(r for r in got if r.doc_id == 20).text == ROUND + "end"
    assert next(r for r in got if r.doc_id == 20).best.asDict() == {"start": 0, "length": 90, "period": 10}
    assert periods.collapsed(brute.documents(spark, [])).collect() == []


def test_query_of_runs(spark):
    got = {r.doc_id: r for r in llm.QUERIES["op11_periodic_runs"](spark, brute.FOLDER).collect()}
    rows = given(spark, "doc_id", "text")
    assert len(got) == len(rows)
    planted = 0
    for i, text in rows:
        own, drawn = brute.words(text), zlib.crc32(str(i).encode())
        if drawn % 10 == 0 and own:
            g = drawn // 10
            a = g % len(own)
            p = 1 + (len(own) - a) // (3 + g % 8)
            own = [own[k] if k < a else own[a + (k - a) % p] for k in range(len(own))]
        elif len(own) > 2000:
            continue
        found, row = plain_runs(own), got[i]
        planted += bool(found)
        best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else (None, None, None)
        assert (row.n_runs, row.start, row.length, row.period) == (len(found), *best)
        assert row.exponent_milli == (1000 * best[1] // best[2] if found else None)
        assert row.runs_sha256 == sha("".join(f"{s},{n},{p}\n" for s, n, p in found))
        assert row.collapsed_sha256 == sha(plain_collapse(own, found))
    assert planted > 5


# --- mixes ---


def plain_targets(sizes, weights=(3, 1, 2), percent=150, most=2):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    stopped, total = set(), percent / 100 * sum(sizes.values())
    while True:
        free = [s for s in order if s not in stopped]
        rest = total - sum(most * sizes[s] for s in stopped)
        share = {s: weight[s] * rest / max(1, sum(weight[f] for f in free)) for s in free}
        above = {s for s in free if share[s] >= most * sizes[s]}
        if not above:
            return {s: most * sizes[s] if s in stopped else share[s] for s in order}
        stopped |= above


def check_mix(rows, got):
    size = lambda t: len(brute.words(t))
    sizes = collections.Counter()
    for _, text, source in rows:
        sizes[source] += size(text)
    aims = plain_targets(sizes)
    want = collections.Counter((i, size(t), sizes[s], round(aims[s], 6)) for i, t, s in rows)
    assert want == collections.Counter((r.doc_id, r.size, r.source_size, round(r.target, 6)) for r in got)
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    assert all(sum(t.words for t in r.takes) == r.taken and all(0 <= t.position <= 1 for t in r.takes) for r in got)
    taken = collections.Counter()
    for r in got:
        taken[r.source] += r.taken
    assert all(taken[s] == int(aims[s] + 0.5) for s in aims)
    return aims


def sourced(spark, rows):
    schema = "doc_id long, text string, source string, size string, rank int, key string, taken int, bucket int"
    return spark.createDataFrame([(*r, "x", 1, "k", 2, 3) for r in rows], schema)


def test_mix_of_odd_rows(spark):
    sources = ["b", None, "a", "", "é", "Z"]
    rows = [(i, t, sources[n % 6]) for n, (i, t) in enumerate(brute.TEXTS)]
    rows += [(None, brute.STORY, None)] * 40 + [(7, "same words here", "a")] * 40 + [(8, "", "empty")]
    docs = sourced(spark, rows)
    got = curriculum.mixed(docs, keep=("source",)).collect()
    check_mix(rows, got)
    again = curriculum.mixed(docs.repartition(5), keep=("source",)).collect()
    assert collections.Counter(map(str, got)) == collections.Counter(map(str, again))
    assert curriculum.mixed(sourced(spark, [])).collect() == []
    assert [r.taken for r in curriculum.mixed(sourced(spark, [(1, None, None), (2, "", "a")])).collect()] == [0, 0]


def test_mix_of_the_table_in_small_buckets(spark, monkeypatch):
    rows = given(spark, "doc_id", "text", "source")
    docs = spark.read.parquet(f"{brute.FOLDER}/documents.parquet")
    got = curriculum.mixed(docs, keep=("source",)).collect()
    aims = check_mix(rows, got)
    monkeypatch.setattr(curriculum, "BUCKET_ROWS", 7)
    small = curriculum.mixed(docs.repartition(3), keep=("source",)).collect()
    assert sorted(map(str, got)) == sorted(map(str, small))
    # at every moment a source has given what its schedule asks for by then, but for a document and a word
    schedules = [curriculum.EARLY, curriculum.EVEN, curriculum.LATE]
    for rank, source in enumerate(sorted(aims)):
        schedule, longest = schedules[rank % 3], max(r.size for r in got if r.source == source)
        for moment in (0.1, 0.3, 0.5, 0.8):
            given_by = sum(t.words for r in got if r.source == source for t in r.takes if t.position <= moment)
            asked = aims[source] * schedule.demand(moment) / schedule.demand(1.0)
            assert abs(given_by - asked) <= longest + 1


def test_training_order_is_sorted_by_position(spark):
    mixed = curriculum.mixed(spark.read.parquet(f"{brute.FOLDER}/documents.parquet"), keep=("source",))
    rows = curriculum.in_order(mixed).collect()
    assert [r.position for r in rows] == sorted(r.position for r in rows)
    assert sum(r.words for r in rows) == sum(r.taken for r in mixed.collect())


def test_schedules_invert_their_integrals(spark):
    for schedule in (curriculum.EARLY, curriculum.EVEN, curriculum.LATE, curriculum.Schedule(((0, 1), (0.2, 0), (0.6, 0), (1, 3)))):
        shares = [schedule.demand(m / 50) / schedule.demand(1.0) for m in range(51)]
        rows = spark.createDataFrame([(s,) for s in shares], "s double").select("s", schedule.moment(rows_col()).alias("m")).collect()
        assert all(schedule.demand(r.m) / schedule.demand(1.0) == pytest.approx(r.s, abs=1e-9) for r in rows)
    for points in (((0, 1),), ((0, 1), (0.5, 1)), ((0, 0), (1, 0)), ((0, -1), (1, 2))):
        with pytest.raises(ValueError):
            curriculum.Schedule(points)


def rows_col():
    from pyspark.sql import functions as F

    return F.col("s")


# --- alignments ---


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(BYTE_TOKENIZER)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECE_TOKENIZER)


def plain_alignment(rows, libraries):
    first, second = libraries
    names = {i: t for t, i in first.get_vocab().items()}
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    byte_of = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in own)}
    bytes_a = lambda i: bytes(byte_of[c] for c in names[i])

    def bytes_b(i):
        name = second.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if name.startswith("<0x") else name.replace("▁", " ").encode()

    out, counts = [], collections.Counter()
    for i, text in rows:
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        want = (" " + (text or "")).encode()
        if text and not (b"".join(map(bytes_a, a)) == want == b"".join(map(bytes_b, b))):
            a, b = [], []
        ends = lambda ids, of: np.cumsum([len(of(x)) for x in ids]).tolist()
        ends_a, ends_b = ends(a, bytes_a), ends(b, bytes_b)
        shared = sorted(set(ends_a) & set(ends_b))
        sides = []
        for ids, own in ((a, ends_a), (b, ends_b)):
            groups_of = collections.defaultdict(list)
            for x, e in zip(ids, own):
                groups_of[next(s for s in shared[len(groups_of) - 1 if groups_of else 0 :] if e <= s)].append(str(x))
            sides.append([",".join(groups_of[s]) for s in shared])
        groups = ";".join(f"{x}|{y}" for x, y in zip(*sides))
        at_a, at_b = dict(zip(ends_a, a)), dict(zip(ends_b, b))
        links = [(at_a[e], at_b[e]) for e in shared]
        counts.update(links)
        out.append((i, len(a), len(b), len(shared), links, groups))
    highest = collections.Counter()
    for (_, y), n in counts.items():
        highest[y] = max(highest[y], n)
    return collections.Counter(
        (i, a, b, n, len(links), sum(counts[p] == highest[p[1]] for p in links), sum(counts[p] for p in links), groups)
        for i, a, b, n, links, groups in out
    )


ODD = [
    (30, "▁ piece mark"),
    (31, "  two  blanks\t\ttabs\n\nlines \r\n end  "),
    (32, "<|endoftext|> <s> </s> <unk> <0x41> <pad>"),
    (33, "zero\x00byte \x1f\x85  and more　wide"),
    (34, "한국어 ไทย العربية हिन्दी 𝔘𝔫𝔦 👩‍👩‍👧 é ﻿‍"),
    (35, "x" * 3000 + " " + "ab" * 2000 + " " * 700 + "z"),
    (36, "1234567890 3.14159 don't we'll I'M they'RE"),
    (37, " "),
    (38, "\n"),
    (39, "漢字" * 500),
]


def test_alignment_of_odd_rows(spark, libraries, monkeypatch):
    rows = [(i, t) for i, t in brute.TEXTS if len(t or "") < 20_000] + ODD + [(10, brute.TEXTS[10][1])]
    got = align.aligned(brute.documents(spark, rows), BYTE_TOKENIZER, PIECE_TOKENIZER).collect()
    assert plain_alignment(rows, libraries) == collections.Counter(map(tuple, got))
    assert align.aligned(brute.documents(spark, []), BYTE_TOKENIZER, PIECE_TOKENIZER).collect() == []


def test_parts_of_long_texts_are_encoded_as_the_whole(libraries, monkeypatch):
    monkeypatch.setattr(align, "PART_CHARS", 50)
    first, second = align.tokenizers(BYTE_TOKENIZER, PIECE_TOKENIZER)
    aligner = align.Aligner(BYTE_TOKENIZER, PIECE_TOKENIZER)
    draw = random.Random(6)
    pieces = ["a", "Word", "é", "漢字", "\n", " ", "  ", "\t", "\x85", "\x1f", "\u2028", "▁", "12", "'s", "!?", "\u00a0", "🙂", "zz-top"]
    mixtures = ["".join(draw.choice(pieces + [" "] * 6) for _ in range(draw.randint(1, 40))) for _ in range(3000)]
    for text in [*(t for _, t in [*brute.TEXTS, *ODD]), *mixtures]:
        if text:
            (a,), (b,) = aligner.encoded([text])
            assert a.tolist() == libraries[0].encode(" " + text, add_special_tokens=False).ids
            if "▁" not in text:
                assert b.tolist() == libraries[1].encode(text)
            assert first.encode(text).tolist() == libraries[0].encode(" " + text, add_special_tokens=False).ids
            assert second.encode(text).tolist() == libraries[1].encode(text)


def test_query_of_alignments(spark, libraries):
    rows = given(spark, "doc_id", "text")
    want = plain_alignment(rows, libraries)
    want = collections.Counter({(*r[:7], sha(r[7]) if r[7] else ""): n for r, n in want.items()})
    got = llm.QUERIES["op13_token_alignment"](spark, brute.FOLDER).collect()
    assert want == collections.Counter(map(tuple, got))
    assert max(r.n_links for r in got) > 1000


def test_other_kinds_of_tokenizers_are_refused():
    with pytest.raises(ValueError):
        align.ByteTokens(public_tokenizers.path("word_bpe_49k.json"))
