"""Encoding, packing, personal data, WARC records, URLs, vectors and the pipeline."""

import collections
import gzip
import html
import random
import re
import time
import zlib

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from relocate import llm
from relocate.llm import bpe, neighbours, packing, pii, urls, warc

llm.load_all()
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_encoding_and_joins_equal_the_library(library):
    draw, coder = random.Random(7), bpe.encoder(PATH)
    alphabets = ["abcdefgh", "ABCxyz", "éèüßñ", "01234", "'''s'll't", "!!!..,,##", " \n\t", " 　\x85", "éö", "漢字", "Σσς İ", "한국", "🙂<|>"]
    for _ in range(400):
        text = "".join(draw.choice(draw.choice(alphabets)) for _ in range(draw.randrange(150))) + draw.choice(["", "<|endoftext|>", "a" * 300])
        want = ids_of(library, text)
        assert coder.encode(text).tolist() == want
        step = max(1, -(-len(text) // draw.choice([2, 4, 8])))
        parts = [(text[i : i + step], coder.encode(text[i : i + step])) for i in range(0, len(text), step)] or [("", coder.encode(""))]
        assert bpe._tree(coder, parts).tolist() == want
        assert coder.decode(np.array(want, int)) == library.decode(want, skip_special_tokens=False)


def test_joins_of_unsplit_text_encode_little(library, monkeypatch):
    draw, coder = random.Random(2), bpe.encoder(PATH)
    text = "".join(draw.choice(["the", "ing", "tion", "er"]) for _ in range(20_000))
    step = len(text) // 8 + 1
    parts = [(text[i : i + step], coder.encode(text[i : i + step])) for i in range(0, len(text), step)]
    seen, plain = [], bpe.Encoder.encode
    monkeypatch.setattr(bpe.Encoder, "encode", lambda self, t: seen.append(len(t)) or plain(self, t))
    assert bpe._tree(coder, parts).tolist() == ids_of(library, text)
    assert sum(seen) < len(text) / 10


@pytest.mark.parametrize("leaf", [64, 16_384])
def test_round_trip_of_odd_rows(spark, library, leaf):
    docs = brute.documents(spark)
    got = bpe.encoded(docs, PATH, leaf=leaf, decoded_col="text").collect()
    want = collections.Counter()
    for i, t in brute.TEXTS:
        ids = ids_of(library, t)
        want[i, np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)] += 1
    assert want == collections.Counter((r[0], bytes(r[1]), r[2]) for r in got)
    again = bpe.decoded(bpe.encoded(docs, PATH), PATH).collect()
    assert collections.Counter((r[0], r.decoded) for r in again) == collections.Counter((r[0], r[2]) for r in got)
    assert bpe.encoded(brute.documents(spark, []), PATH).collect() == []


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        bpe.Encoder(public_tokenizers.path("byte_bpe_50k.json"))


def brute_cuts(places, penalties, length):
    best = {0: 0}
    for place, penalty in zip(places, penalties):
        best[place] = min(best[p] + length - (place - p) + penalty for p in best if place - length <= p < place)
    return best[places[-1]]


def test_cuts_cost_least():
    draw = random.Random(4)
    for _ in range(200):
        places = np.cumsum([draw.randrange(1, 20) for _ in range(draw.randrange(1, 40))]).tolist()
        penalties = [draw.choice([0, 3, 9]) for _ in places]
        chosen = packing.cuts(places, penalties, 25)
        cost, before = 0, 0
        for c in chosen:
            assert 0 < places[c] - before <= 25
            cost += 25 - (places[c] - before) + penalties[c]
            before = places[c]
        assert before == places[-1] and cost == brute_cuts(places, penalties, 25)


@pytest.mark.parametrize("run", [500, 1 << 20])
def test_packing_of_odd_rows(spark, library, monkeypatch, run):
    rows = [r for r in brute.TEXTS if r[0] != 5]
    monkeypatch.setattr(packing, "RUN_TOKENS", run)
    got = packing.packed(brute.documents(spark, rows).coalesce(1), PATH, length=512).collect()
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for i, t in rows:
        ids, at = [*ids_of(library, t), 2], 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, bytes(r.ids)) == (at, len(ids), np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= 512
    assert sum(r.length for r in got) > 0.9 * 512 * (len(sequences) - 1)
    assert packing.packed(brute.documents(spark, []), PATH).collect() == []


def test_packing_of_the_table(spark, library):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{brute.FOLDER}/documents.parquet").collect()}
    got = llm.QUERIES["op5_sequence_packing"](spark, brute.FOLDER).collect()
    for r in got:
        ids = [*ids_of(library, rows[r.doc_id]), 2]
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    assert sum(r.length for r in got) == sum(len(ids_of(library, t)) + 1 for t in rows.values())


PRIVATE = "Call +1 (608) 555-3598 or +1 608 555 3598, mail Jo.Doe@Mail.Example.com; 10.20.30.40, card 4012 8888 8888 1881, password=ab12cd34."


def test_surrogates_keep_type_and_format():
    found = pii.mentions(PRIVATE)
    assert [m.kind for m in found] == ["phone", "phone", "email", "ip", "card", "secret"]
    new = pii._replaced(PRIVATE, found, b"k", {})
    again = pii.mentions(new)
    assert [m.kind for m in again] == [m.kind for m in found]
    assert again[0].entity == again[1].entity and all(a.entity != b.entity for a, b in zip(found, again))
    assert pii._luhn(again[4].entity) == 0 and len(again[4].text) == len(found[4].text)
    assert new.startswith("Call +1 (") and "password=" in new


def test_names_keep_gender_script_and_coreference():
    text = "Mr John Smith met Frau Weber. Mr SMITH and Anna Weber left. Господин Иванов пришёл."
    new = pii._replaced(text, pii.mentions(text), b"k", {})
    people = pii.mentions(new)
    assert [m.kind for m in people] == [m.kind for m in pii.mentions(text)]
    names = [m.text for m in people]
    assert names[1].upper() == names[3] and names[2] == names[5] and "John" not in new and "Weber" not in new


def test_replacements_are_distinct(spark, monkeypatch):
    kinds = [("given-m-latin", f"name{i}") for i in range(60)] + [("secret", f"{i:04d}") for i in range(1000, 1300)]
    entities = spark.createDataFrame(kinds, "kind string, entity string")
    turns = {(r.kind, r.entity): r.turn for r in pii.distinct_draws(entities, b"k").collect()}
    new = [(k.split("-")[0], pii.surrogate(b"k", k, e, turns.get((k, e), 0))) for k, e in kinds]
    assert len(set(new)) == len(kinds) and not set(new) & {(k.split("-")[0], e) for k, e in kinds}


def test_short_phones_do_not_run_out(spark):
    rows = [(i, f"call +100{i} now") for i in range(10)] + [(10 + i, f"+123{i}") for i in range(1, 6)]
    got = {r.doc_id: r.text for r in pii.with_surrogates(brute.documents(spark, rows), b"k").collect()}
    found = {i: [m.entity for m in pii.mentions(t)] for i, t in got.items()}
    assert len(got) == 15 and len({e for (e,) in found.values()}) == 15
    assert not {e for (e,) in found.values()} & {m.entity for _, t in rows for m in pii.mentions(t)}
    assert all(got[i].startswith("call +100") and got[i].endswith(" now") for i in range(10))


@pytest.mark.parametrize("kind, entity", [("phone", "+100 0"), ("phone", "6085553598")])
def test_late_draws_of_free_length_grow(kind, entity):
    sizes = [len(pii._digits(pii.surrogate(b"k", kind, entity, pii.LOOSE + turn))) for turn in (-1, 20)]
    assert sizes[1] >= sizes[0] + 10
    new = pii.surrogate(b"k", kind, entity, pii.LOOSE + 3)
    assert pii._digits(pii.written(pii.Mention(0, 0, kind, entity, entity), new)) == pii._digits(new)


@pytest.mark.parametrize("kind, entity", [("card", "4012888888881881"), ("ssn", "123456789"), ("ip", "1.2.3.4"), ("iban", "DE89370400440532013000")])
def test_late_draws_of_fixed_formats_stay(kind, entity):
    drawn = {pii.surrogate(b"k", kind, entity, turn) for turn in range(200)}
    assert len(drawn) == 200
    for new in drawn:
        assert new.count(".") == entity.count(".") and (kind == "ip" or len(new) == len(entity))
        assert kind != "ip" or all(0 < int(octet) < 256 for octet in new.split("."))
        assert kind != "card" or pii._luhn(new) == 0


@pytest.mark.parametrize("text", ["%D0%BF%D1%80%D0%B8" * 60_000, "a%" * 500_000, "%" * 1_000_000, "a.b-c+d" * 150_000])
def test_long_encoded_texts_are_searched_in_linear_time(text):
    begin = time.process_time()
    assert pii.mentions(text + " 7") == []
    assert time.process_time() - begin < 5


def test_mail_after_encoded_text_is_found():
    assert [m.text for m in pii.mentions("x%20 to=%3Cjo@ex.org%3E a%b@ex.org")] == ["%3Cjo@ex.org", "a%b@ex.org"]


@pytest.mark.parametrize("text", ["sk-" + "aB" * 12, "ghp_" + "x" * 20, "AKIA" + "Q" * 16, "abcdef" * 6, "１２３-４５-６７８９", "+٩٦٦ ٥٥ ١٢٣ ٤٥٦٧"])
def test_data_without_ascii_digits_is_found(text):
    (alone,), (beside, *_) = pii.mentions(text), pii.mentions(f"{text} 7")
    assert alone == beside and alone.text == text
    assert pii._replaced(text, [alone], b"k", {}) != text


def test_surrogates_of_odd_rows(spark):
    rows = [*brute.TEXTS, (20, PRIVATE), (21, "x " * 30_000 + PRIVATE), (20, PRIVATE)]
    docs = brute.documents(spark, rows)
    got = pii.with_surrogates(docs, b"k", count_col="n")
    assert got.columns == [c for c in docs.columns if c != "n"] + ["n"]
    by = collections.defaultdict(list)
    for r in got.collect():
        by[r.doc_id].append(r)
    for i, t in brute.TEXTS:
        assert all((r.text, r.n) == (t, 0) for r in by[i])
    (a, b), (c,) = by[20], by[21]
    assert a.text == b.text and c.text.endswith(a.text) and a.n == 6 and "3598" not in a.text
    assert pii.with_surrogates(brute.documents(spark, []), b"k").collect() == []


PAGE = (
    "<html lang='en'><head><title>A &amp; B</title><script>var t='</p>';</script></head><body><!-- no -->"
    "<p>One <b>two</b></p><div>three<br>four</div><a href='/x?y=1#z'>link</a></body></html>"
)


def test_derivatives_of_pages(spark):
    rows = [(1, "http://a.org/d/e", PAGE), (2, None, None), (3, "http://a.org/", ""), (3, "http://a.org/", ""), (None, "http://b.org", "<p")]
    pages = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, content string, date int")
    sources = warc.responses(pages, "2024-01-01T00:00:00Z")
    got = warc.derived(sources, keep=("page_id",)).collect()
    assert len(got) == 2 * len(rows)
    meta, text = (next(r for r in got if r.page_id == 1 and r.record_type == k) for k in ("metadata", "conversion"))
    assert text.content == "A & B\nOne two\nthree\nfour\nlink"
    for line in ("title: A & B", "language: en", "outlink: http://a.org/x?y=1#z", "http-status: HTTP/1.1 200 OK", f"source-record-id: {meta.refers_to}"):
        assert line in meta.content.split("\r\n")
    assert meta.refers_to == text.refers_to == next(r.record_id for r in sources.collect() if r.page_id == 1)
    assert (meta.concurrent_to, text.concurrent_to) == (text.record_id, meta.record_id)
    for r in got:
        assert (r.content_length, r.block_digest) == (len(r.content.encode()), warc.digest(r.content.encode()))
    assert warc.derived(warc.responses(pages.limit(0), "x")).collect() == []


def plain_page(page):
    """Tags and shown text of a page, one character at a time."""
    out, links, i = [], [], 0
    while i < len(page):
        rest = page[i:]
        if page[i] != "<" or not re.match(r"<(!|\?|/?[a-zA-Z])", rest):
            out.append(page[i])
            i += 1
            continue
        if rest.startswith("<!--"):
            i = len(page) if "-->" not in rest[4:] else i + 4 + rest[4:].index("-->") + 3
            continue
        j, quote = 1, None
        while j < len(rest) and (quote or rest[j] != ">"):
            if quote and rest[j] == quote:
                quote = None
            elif not quote and rest[j] in "\"'" and rest[1] not in "!?" and rest[j] in rest[j + 1 :]:
                quote = rest[j]
            j += 1
        if j == len(rest):
            out.append(rest)
            break
        tag = re.match(r"</?([a-zA-Z][^\s/>]*)", rest)
        name = tag[1].lower() if tag else ""
        i += j + 1
        if name in ("script", "style", "noscript", "template") and rest[1] != "/":
            over = re.search(rf"</{name}\s*>", page[i:], re.I)
            i = i + over.end() if over else len(page)
        elif name in warc._BREAKS:
            out.append("\n")
        elif name == "a" and rest[1] != "/":
            own = re.search(r"\shref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", rest[:j], re.I)
            links += [html.unescape(next(g for g in own.groups() if g is not None))] if own else []
    shown = html.unescape("".join(out)).split("\n")
    lines = [re.sub(r"[^\S\n]+", " ", line).strip() for line in shown]
    return "\n".join(line for line in lines if line), links


ODD_PAGES = [
    PAGE, "", "a < b > c <1> <p", "<p title='a>b'>x</p><p title=\"it's\">y", "<!-- <a href=no> --><a href=yes>1</a><!doctype html>z",
    "<script>if (a<b) '</p>'</SCRIPT ><style>x", "<a href='u?a=1&amp;b=2'>l</a><A HREF = \"v w\" id=q>m</A><a name=n>k<area href=no>",
    "<ul><li>one<li>two</ul>&lt;b&gt; &eacute;&#233; <br/>end<?php echo ?>", "x<template><p>hidden</template><noscript>n</noscript>y<!-- open",
    "it's <b class=it's>bold</b> and \"<i>quoted</i>\"",
]


@pytest.mark.parametrize("page", ODD_PAGES)
def test_pages_read_like_one_character_at_a_time(page):
    text, links = plain_page(page)
    assert warc.plain_text(page) == text
    assert [t.attribute("href") for t in warc.tags(page) if t.name == "a" and not t.closing and t.attribute("href")] == links


def test_pages_of_the_table_read_like_one_character_at_a_time(spark):
    for (page,) in spark.read.parquet(f"{brute.FOLDER}/pages.parquet").select("html").limit(60).collect():
        assert warc.plain_text(page or "") == plain_page(page or "")[0]


@pytest.mark.parametrize("piece", ["<a ", '<a "', "<a '", "<!", "<!--", "<a href=", "<title>", "<html ", "<script>", '<a ">" ', "</script", "<a x='\">", "&amp", "<a b='"])
def test_long_odd_pages_end_in_linear_time(piece):
    page, begin = piece * (1_000_000 // len(piece)), time.process_time()
    source = {"record_id": "<urn:uuid:1>", "target_uri": "http://a.org/", "date": "d", "payload_digest": None, "block": page.encode()}
    assert len(warc.derivatives(source)) == 2
    assert time.process_time() - begin < 8


def response(head, payload):
    return {"record_id": "<urn:uuid:1>", "target_uri": "u", "date": "d", "payload_digest": None, "block": head + payload}


@pytest.mark.parametrize("end", [b"\r\n", b"\n"])
def test_encodings_are_undone(end):
    body = "<p>héllo</p><p>wörld</p>".encode()
    head = end.join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8"])
    raw = zlib.compressobj(wbits=-15)
    cases = {
        b"": body,
        b"Content-Encoding: gzip": gzip.compress(body[:9]) + gzip.compress(body[9:]),
        b"Content-Encoding: deflate": zlib.compress(body),
        b"Content-encoding: Deflate": raw.compress(body) + raw.flush(),
        b"Transfer-Encoding: chunked": b"5;x=1" + end + body[:5] + end + b"%x" % (len(body) - 5) + end + body[5:] + end + b"0" + end + end,
        b"Content-Encoding: x-gzip": body,
    }
    both = gzip.compress(body)
    cases[b"Transfer-Encoding: chunked" + end + b"Content-Encoding: gzip"] = b"%x" % len(both) + end + both + end + b"0" + end + end
    for header, payload in cases.items():
        full = head + (end + header if header else b"") + end + end
        _, text = warc.derivatives(response(full, payload))
        assert text["content"] == "héllo\nwörld", header
    (only,) = warc.derivatives(response(head + end + b"Content-Encoding: br" + end + end, b"\x01\x02"))
    assert only["record_type"] == "metadata"
    _, cut = warc.derivatives(response(head + end + b"Content-Encoding: gzip" + end + end, gzip.compress(body * 500)[:60]))
    assert cut["content"] == "" or cut["content"].startswith("héllo")


def test_line_ends_in_values_begin_no_header(spark):
    pages = spark.createDataFrame([(1, "http://a.org/\r\nX-Bad: 1", "<p>x")], "page_id long, url string, html string")
    for row in warc.as_text(warc.derived(warc.responses(pages, "d"))).collect():
        assert "WARC-Target-URI: http://a.org/ X-Bad: 1\r\n" in row.warc


def test_files_can_be_read_again(spark, tmp_path):
    records = llm.QUERIES["op7_warc_derivatives"](spark, brute.FOLDER)
    warc.write(records, str(tmp_path / "files"))
    for kind in ("conversion", "metadata"):
        want = {r.record_id: r.content.encode() for r in records.filter(f"record_type = '{kind}'").collect()}
        assert {r.record_id: bytes(r.block) for r in warc.read(spark, str(tmp_path / "files"), kind).collect()} == want


def test_binary_payloads_have_metadata_alone():
    block = b"HTTP/1.1 200 OK\r\nContent-Type: image/png\r\nX-A: b\r\n\r\n\x00\x01"
    (only,) = warc.derivatives({"record_id": "<urn:uuid:1>", "target_uri": "u", "date": "d", "payload_digest": "sha1:X", "block": block})
    assert only["record_type"] == "metadata" and "source-payload-digest: sha1:X" in only["content"] and "http-header-x-a: b" in only["content"]


def test_url_verdicts_of_odd_rows(spark):
    rules = [urls.Rule.parse("block", "net/"), urls.Rule.parse("allow", "example.net/en/")]
    rows = [
        (1, None), (2, ""), (3, "no scheme"), (4, "HTTP://A.Example.NET/en/x"), (5, "http://example.net/enx"), (6, "http://b.net?x"),
        (7, "http://xnet/"), (8, "https://www.bad.org/a/?utm_source=q&b=2&a=1#f"), (9, "http://bad.org/a?a=1&b=2"), (9, "http://bad.org/a?a=1&b=2"),
        (10, "http://bad.org/A"), (None, "http://bad.org/a?a=1&b=2"),
    ]
    pages = spark.createDataFrame([(*r, "h", "v", 1) for r in rows], "page_id long, url string, host string, verdict string, block int")
    listed = spark.createDataFrame([("http://bad.org/a?b=2&a=1",), (None,), ("junk",)], "url string")
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in urls.judged(pages, rules, listed).collect()}
    assert got == {
        (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "", "", None, "allow"), (4, "a.example.net", "/en/x", "example.net/en/", "allow"),
        (5, "example.net", "/enx", "net/", "block"), (6, "b.net", "", None, "allow"), (7, "xnet", "/", None, "allow"),
        (8, "www.bad.org", "/a/", None, "block"), (9, "bad.org", "/a", None, "block"), (10, "bad.org", "/A", None, "allow"), (None, "bad.org", "/a", None, "block"),
    }
    assert urls.judged(pages, rules, listed).count() == len(rows)
    assert {r.verdict for r in urls.judged(pages, [], listed.limit(0)).collect()} == {"allow"}
    assert urls.judged(pages.limit(0), rules, listed).collect() == []


@pytest.mark.parametrize("limit", [0, 400_000])
def test_bloom_filter_passes_all_listed(spark, monkeypatch, limit):
    monkeypatch.setattr(urls, "BROADCAST_BLOCKS", limit)
    names = spark.range(2000).selectExpr("concat('http://h', id, '.org/p') AS url", "id")
    got = urls.judged(names, [], names.filter("id % 2 = 0").select("url"), bits=4).collect()
    assert all(r.verdict == ("block" if r.id % 2 == 0 else "allow") for r in got) and len(got) == 2000


def vector_answer(rows, cosine):
    sound = {}
    for i, v, label in rows:
        if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            sound[i] = (label, np.array(v) / np.linalg.norm(v))
    groups, links = brute.Groups(sound), collections.Counter()
    for a, (la, va) in sound.items():
        for b, (lb, vb) in sound.items():
            if a < b and la == lb and len(va) == len(vb) and va @ vb >= cosine:
                links.update((a, b))
                groups.join(a, b)
    return {i: (links[i], groups.root(i) if i in sound else i) for i, _, _ in rows if i is not None}


def test_near_vectors_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_VECTORS", 8)
    draw = np.random.default_rng(5)
    rows = []
    for i in range(40):
        centre = draw.normal(size=6)
        for j in range(5):
            rows.append((10 * i + j, [float(x) for x in centre + draw.normal(size=6) * 0.05], i % 3))
    rows += [(900 + j, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0], 1) for j in range(30)] + [(940 + j, [2.0, 0.001 * j, 0.0, 0.0, 0.0, 0.0], 1) for j in range(20)]
    rows += [(1000, None, 1), (1001, [], 1), (1002, [0.0] * 6, 1), (1003, [1.0, None] * 3, 1), (1004, [float("nan")] * 6, 1), (1005, [float("inf")] * 6, 1)]
    rows += [(1006, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0], None), (1007, [1.0, 0.0], 1), (1008, [1.0], 1), (None, [1.0] * 6, 1), rows[0]]
    table = spark.createDataFrame([(*r, "c", 1) for r in rows], "vec_id long, embedding array<double>, label int, rep string, kept int")
    got = neighbours.near_vectors(table, recall=1.0).collect()
    want = vector_answer(rows, 0.98)
    assert len(got) == len(rows)
    for r in got:
        if r.vec_id is not None:
            assert (r.n_links, r.component_id) == want[r.vec_id] and r.kept == (r.vec_id == r.component_id)
        else:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)
    assert neighbours.near_vectors(table.limit(0)).collect() == []


def test_vectors_out_of_range_of_their_squares(spark):
    rows = [(1, [1e200, 2e200]), (2, [1e-200, 2e-200]), (3, [1.0, 2.0]), (4, [-1e300, 1e300]), (5, [5e-324, 0.0]), (6, [1e308, 0.0])]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in neighbours.near_vectors(table).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4), 5: (1, 5), 6: (1, 5)}


def test_recall_of_the_index():
    draw = np.random.default_rng(8)
    centres = draw.normal(size=(300, 32))
    points = np.repeat(centres, 8, axis=0) + draw.normal(size=(2400, 32)) * 0.08
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    index = neighbours.fitted(points[::2], np.zeros(1200), 12, 0.98, 0.99)
    cells, visits = index.visits(points)
    x, y = np.nonzero(np.triu(points @ points.T >= 0.98, 1))
    met = np.mean([cells[b] in visits[a] or cells[a] in visits[b] for a, b in zip(x.tolist(), y.tolist())])
    assert len(x) > 1000 and met >= 0.95
    assert np.mean([len(v) for v in visits]) < 0.5 * 144


def test_links_of_small_groups_beside_a_large_one(spark):
    draw = np.random.default_rng(6)
    near = lambda v: v + draw.normal(size=v.shape) * 0.02
    pairs = draw.normal(size=(300, 16))
    points = np.concatenate([near(np.repeat(draw.normal(size=(1, 16)), 600, axis=0)), near(pairs), near(pairs)])
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(points)]
    got = neighbours.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == vector_answer(rows, 0.98)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{brute.FOLDER}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality_rules"](spark, docs, brute.FOLDER)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    out = corpus_pipeline.run(spark, brute.FOLDER).collect()
    assert {r.doc_id for r in out} <= {r.doc_id for r in kept.collect()}
    empty = docs.limit(0)
    for stage in stages.values():
        assert stage(spark, empty, brute.FOLDER).collect() == []


def test_pipeline_stages_take_odd_rows(spark):
    docs = brute.documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, brute.FOLDER)
        assert name == "packing" or got.columns == docs.columns
        got.collect()


def test_one_row_of_each_group_of_copies_stays_whole(spark):
    texts = {c: " ".join(f"{c}{i}" for i in range(80)) for c in "abcd"}
    rows = [(7, texts["a"]), (7, texts["a"]), (None, texts["b"]), (None, texts["b"]), (9, texts["c"]), (None, texts["c"]), (4, texts["c"])]
    rows += [(3, texts["d"]), (3, "another text of the same id"), (5, None), (5, ""), (5, None)]
    docs = brute.documents(spark, rows).repartition(4)
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["near_duplicates"](spark, docs, brute.FOLDER)
    got = stages["repeated_passages"](spark, kept, brute.FOLDER)
    assert got.columns == docs.columns
    want = [(7, texts["a"]), (None, texts["b"]), (4, texts["c"]), *rows[7:]]
    assert collections.Counter((r.doc_id, r.text) for r in got.collect()) == collections.Counter(want)


CLASHING = "doc_id long, text string, n_words string, kept string, _row long, clean_text string, component_id string, id int, block_id string"


def test_stages_keep_columns_of_any_name(spark):
    good = "\n".join(" ".join(f"{w}{i}" for i in range(9)) + "." for w in ("one", "two", "three", "four"))
    rows = [(1, good, "mine", "keepme", 99, "ct", "c", 7, "b"), (None, good + "\nAnother line is here.", None, "k", None, None, "d", 8, None)]
    docs = spark.createDataFrame(rows, CLASHING)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, brute.FOLDER)
        assert got.columns == docs.columns, name
        left = {r.n_words: tuple(r)[2:] for r in got.collect()}
        assert left.items() <= {r[2]: r[2:] for r in rows}.items() and "mine" in left, name


def test_pipeline_against_plain_stages(spark, tmp_path):
    """All stages over odd rows, and what plain versions of the stages leave."""
    texts = {i: "\n".join(" ".join(f"{w}{i}x{k}" for k in range(9)) + "." for w in ("a", "b", "c", "d", "e")) for i in range(9)}
    shared = " ".join(f"shared{i}" for i in range(60)) + "."
    rows = [(i, t) for i, t in texts.items()] + [(20, texts[0]), (None, texts[1]), (3, texts[3]), (21, "too short"), (22, None), (23, "")]
    rows += [(24 + i, f"Own words start text number {i} here so.\n{shared}\n" + "\n".join(" ".join(f"{w}{i}x{k}" for k in range(9)) + "." for w in "pqrstuvw")) for i in range(2)]
    folder = tmp_path / "sf"
    docs = brute.documents(spark, rows)
    docs.coalesce(2).write.parquet(f"{folder}/documents.parquet")
    pieces = corpus_pipeline.run(spark, str(folder)).collect()
    library, kept = Tokenizer.from_file(PATH), {}
    for i, t in rows:
        if len(brute.words(t)) >= 10:
            kept.setdefault(t, []).append(i)
    named = {t: min(i for i in ids if i is not None) for t, ids in kept.items()}
    plain = [(i, t) for t, i in named.items()]
    covered = brute.repeats(plain, 50)
    want = collections.Counter(
        (i, len(ids_of(library, " ".join(w for w, gone in zip(own, lost) if not gone))) + 1) for (i, _), (own, lost) in zip(plain, covered)
    )
    assert want == collections.Counter({(r.doc_id, r.doc_tokens): 1 for r in pieces})
    assert sum(r.length for r in pieces) == sum(n for _, n in want)


def test_arrow_slices_of_strings():
    from relocate.llm import words

    texts = pa.array(["skipped", "One two", None, "", "three", "four five "]).slice(1)
    found = words.split_words(*words.layout(texts))
    assert found.bounds.tolist() == [0, 2, 2, 2, 3, 5]
    assert words.split_words(*words.layout(pa.array(["one", "two"]))).bounds.tolist() == [0, 1, 2]
