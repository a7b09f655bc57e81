"""Alignment of the tokens of two tokenizers over the same texts.

Both encode each whole text. Where a token of each ends at the same byte and the next token of each starts with a
blank, the text is cut into windows: some ids of one tokenizer, some of the other, over the same bytes. The alignment
of a window depends on its ids alone, so each different tuple of ids of a block is aligned once, and texts are put
together from numbers of windows.

Counts of linked id pairs are added up over the whole corpus by :mod:`relocate.llm.exchange` and handed back to each block.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relocate.llm import exchange, shipped, words
from relocate.session import saved

BLOCK_BYTES = 4 << 20
BROADCAST_BYTES = 32 << 20
#: Longer texts are encoded in parts of about so many characters, cut where neither tokenizer can merge across.
PART_CHARS = 1 << 18
WORDS_KEPT = 50_000
#: A blank beside other white space or at an end of a text.
_UNEVEN = re.compile(r"\s | $|^ ")
_CUT = re.compile("[A-Za-z0-9](?= [A-Za-z0-9])")
_MARK = 2**32 - 1

#: Fixed value: the pattern by which byte-level tokenizers of this kind split a text before merging.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class _Tokenizer:
    """Token ids of texts, and the bytes of each id."""

    def __init__(self, table: list[bytes]):
        self.widths = np.array([len(b) for b in table], np.int64)
        self.begins = np.cumsum(self.widths) - self.widths
        self.data = np.frombuffer(b"".join(table), np.uint8)
        self.spaced = np.array([b[:1] == b" " for b in table], bool)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the tokens in a row."""
        widths = self.widths[ids]
        ends = np.cumsum(widths)
        return self.data[np.repeat(self.begins[ids] - (ends - widths), widths) + np.arange(ends[-1] if len(ends) else 0)]


def _parts(text: str) -> Iterator[str]:
    """The text in parts that all but the first start with a blank between two letters or digits."""
    at = 0
    while len(text) - at > PART_CHARS and (cut := _CUT.search(text, at + PART_CHARS)):
        yield text[at : cut.end()]
        at = cut.end()
    yield text[at:]


class ByteTokens(_Tokenizer):
    """Byte-level BPE from a file of the tokenizers library; strings of special tokens are plain text.

    Encoded by rank, which gives the same ids where merges come in the order of the ids they make.
    """

    def __init__(self, path: str):
        import tiktoken

        plan = json.loads(Path(path).read_text())
        model, before = plan["model"], plan["pre_tokenizer"] or {}
        known = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        if model["type"] != "BPE" or plan["normalizer"] or any(before.get(k) != v for k, v in known.items()):
            raise ValueError(f"{path}: not a byte-level BPE tokenizer without normalization")
        own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        rest = [b for b in range(256) if b not in own]
        byte_of = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}
        special = {t["id"] for t in plan["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in model["vocab"].items() if i not in special}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"][a + b] for a, b in merges]
        if made != sorted(made) or len(set(made)) < len(made):
            raise ValueError(f"{path}: merges are not in the order of their ids")
        size = 1 + max(max(ranks.values()), max(special, default=0))
        table = [b""] * size
        for token, i in ranks.items():
            table[i] = token
        super().__init__(table)
        self._coding = tiktoken.Encoding("byte-level", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        """Ids of a blank and the text."""
        found = [self._coding.encode_ordinary(" " + p if i == 0 else p) for i, p in enumerate(_parts(text))]
        return np.concatenate([np.array(f, np.uint32) for f in found])

    def each(self, words: list[str]) -> list[bytes]:
        """Ids of a blank and each word, as bytes."""
        encode = self._coding.encode_ordinary
        return [array("I", encode(" " + w)).tobytes() for w in words]


class PieceTokens(_Tokenizer):
    """A sentencepiece model, which puts a blank before each text."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self._model.id_to_piece(i) for i in range(self._model.vocab_size())]
        super().__init__(
            [
                bytes([int(n[1:-1], 16)]) if self._model.is_byte(i) else n.replace("▁", " ").encode()
                for i, n in enumerate(names)
            ]
        )
        # no piece goes on across a blank, so parts that start with one are encoded as they are within the whole
        self.apart = not any("▁" in n.lstrip("▁") for n in names)

    def encode(self, text: str) -> np.ndarray:
        parts = list(_parts(text)) if self.apart else [text]
        found = self._model.encode([p if i == 0 else p[1:] for i, p in enumerate(parts)], num_threads=1)
        return np.concatenate([np.array(f, np.uint32) for f in found])

    def each(self, words: list[str]) -> list[bytes]:
        """Ids of a blank and each word, as bytes; words are not empty."""
        return [array("I", f).tobytes() for f in self._model.encode(words, num_threads=1)] if words else []


@cache
def tokenizers(byte_path: str, piece_path: str) -> tuple[ByteTokens, PieceTokens]:
    return ByteTokens(byte_path), PieceTokens(piece_path)


# --- windows ----------------------------------------------------------------------------------------------------------


class Aligner:
    """Cuts texts into windows and aligns windows."""

    def __init__(self, byte_path: str, piece_path: str):
        self.a, self.b = tokenizers(byte_path, piece_path)
        self._known: tuple[dict[str, bytes], dict[str, bytes]] = {}, {}

    def encoded(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of a blank and each whole text by both; none of null and empty texts.

        No token of either reaches over a blank that follows any other character, so words between such blanks are
        encoded by themselves, once, and remembered within bounds. Texts with other white space beside a blank, or a
        blank at an end, are encoded at once.
        """
        split = [t.split(" ") if t and self.b.apart and not _UNEVEN.search(t) else None for t in texts]
        out = []
        for coder, known in zip((self.a, self.b), self._known):
            if len(known) > WORDS_KEPT:
                known.clear()
            new = list({w for words in split if words for w in words if w not in known})
            known.update(zip(new, coder.each(new)))
            find = known.__getitem__
            none = np.zeros(0, np.uint32)
            out.append(
                [
                    np.frombuffer(b"".join(map(find, words)), np.uint32) if words else coder.encode(t) if t else none
                    for t, words in zip(texts, split)
                ]
            )
        return out[0], out[1]

    def aligned(self, windows: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Groups of each window as text, how many links it has, and all links as numbers ``a << 32 | b``.

        All windows are laid out one behind the other, so that bytes at which tokens of both end are found for all at
        once; no group reaches over the end of a window, as that is such a byte.
        """
        _, offsets, data = windows.buffers()
        bounds = np.frombuffer(offsets, np.int32)[windows.offset : windows.offset + len(windows) + 1] // 4
        ids = np.frombuffer(data, np.uint32)[bounds[0] : bounds[-1]] if len(windows) else np.zeros(0, np.uint32)
        mark = np.flatnonzero(ids == _MARK)
        window = np.repeat(np.arange(len(windows)), np.diff(bounds))
        first = np.arange(len(ids)) < mark[window]
        second = np.arange(len(ids)) > mark[window]
        a, b = ids[first], ids[second]
        ends_a, ends_b = np.cumsum(self.a.widths[a]), np.cumsum(self.b.widths[b])
        ending = np.zeros(int(ends_a[-1]) + 1 if len(a) else 1, np.int8)
        ending[ends_a] = 1
        ending[ends_b] += 2
        shared = np.flatnonzero(ending == 3)
        last_a, last_b = np.searchsorted(ends_a, shared), np.searchsorted(ends_b, shared)
        links = a[last_a].astype(np.uint64) << np.uint64(32) | b[last_b].astype(np.uint64)
        of_link = window[first][last_a]
        # ids in the order in which they are written: those of A, then those of B, group by group
        group_a, group_b = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)
        place_a = np.arange(len(a)) + np.concatenate([[0], last_b + 1])[group_a]
        place_b = np.arange(len(b)) + (last_a + 1)[group_b]
        written, after = np.zeros(len(a) + len(b), np.uint32), np.zeros(len(a) + len(b), np.int8)
        written[place_a], written[place_b] = a, b
        after[place_a[last_a]] = 1
        after[place_b[last_b]] = 2
        ends = np.cumsum(np.diff(bounds) - 1)
        after[ends - 1] = 3
        spelt = pc.cast(pa.array(written), pa.string())
        spelt = pc.binary_join_element_wise(spelt, pa.array([",", "|", ";", ""]).take(pa.array(after)), "")
        rows = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), spelt)
        return pc.binary_join(rows, ""), np.bincount(of_link, minlength=len(windows)).astype(np.uint32), links

    def windows(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array, np.ndarray]:
        """Tokens of each text by both, windows of each text, the different windows, and which of them each one is."""
        ids_a, ids_b = self.encoded(texts)
        for i, text in enumerate(texts):
            if text:
                whole = np.frombuffer(b" " + text.encode(), np.uint8)
                if not all(np.array_equal(t.joined(ids), whole) for t, ids in ((self.a, ids_a[i]), (self.b, ids_b[i]))):
                    ids_a[i] = ids_b[i] = np.zeros(0, np.uint32)
        n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b))
        a, b = np.concatenate([*ids_a, np.zeros(0, np.uint32)]), np.concatenate([*ids_b, np.zeros(0, np.uint32)])
        wide_a, wide_b = self.a.widths[a], self.b.widths[b]
        starts_a, starts_b = np.cumsum(wide_a) - wide_a, np.cumsum(wide_b) - wide_b
        # a blank opens a token of both: what lies before ends together. Every text starts so
        mark = np.zeros(int(wide_a.sum()), np.int8)
        mark[starts_a[self.a.spaced[a]]] = 1
        mark[starts_b[self.b.spaced[b]]] += 2
        anchors = np.flatnonzero(mark == 3)
        from_a, from_b = np.searchsorted(starts_a, anchors), np.searchsorted(starts_b, anchors)
        sizes_a, sizes_b = np.diff(np.append(from_a, len(a))), np.diff(np.append(from_b, len(b)))
        # ids of each window in a row: those of the one, a mark, those of the other
        sizes = sizes_a + sizes_b + 1
        begins = np.cumsum(sizes) - sizes
        rows = np.full(int(sizes.sum()), _MARK, np.uint32)
        rows[np.arange(len(a)) + np.repeat(begins - from_a, sizes_a)] = a
        rows[np.arange(len(b)) + np.repeat(begins + sizes_a + 1 - from_b, sizes_b)] = b
        offsets = np.append(begins, len(rows)).astype(np.int32) * 4
        found = pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])
        coded = found.dictionary_encode()
        text_of = np.searchsorted(np.cumsum(n_a), from_a, "right")
        return n_a, n_b, np.bincount(text_of, minlength=len(texts)), coded.dictionary, coded.indices.to_numpy()


# --- operator ---------------------------------------------------------------------------------------------------------

_STATE = (
    "block_id long, ids array<{kind}>, n_a array<long>, n_b array<long>, n_windows array<long>, places binary, groups binary,"
    " sizes binary, links binary, keys binary, counts binary"
)


def _squeezed(array: np.ndarray) -> bytes:
    raw = array.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _restored(blob: bytes, kind) -> np.ndarray:
    size = int.from_bytes(blob[:8], "little")
    return np.frombuffer(pa.decompress(blob[8:], size, "zstd", asbytes=True) if size else b"", kind)


def _unmixed(x: np.ndarray) -> np.ndarray:
    """What :func:`words.mixed` made the numbers of."""
    x = x ^ (x >> np.uint64(31)) ^ (x >> np.uint64(62))
    x *= np.uint64(pow(0x94D049BB133111EB, -1, 2**64))
    x ^= (x >> np.uint64(27)) ^ (x >> np.uint64(54))
    x *= np.uint64(pow(0xBF58476D1CE4E5B9, -1, 2**64))
    x ^= (x >> np.uint64(30)) ^ (x >> np.uint64(60))
    return x


def _block(number: int, ids: pa.Array, texts: pa.Array, aligner: Aligner) -> pa.RecordBatch:
    n_a, n_b, n_windows, different, places = aligner.windows(texts.to_pylist())
    groups, sizes, links = aligner.aligned(different)
    weights = np.repeat(np.bincount(places, minlength=len(groups)), sizes)
    distinct, pair = np.unique(words.mixed(links), return_inverse=True)
    counts = np.bincount(pair, weights=weights, minlength=len(distinct)).astype(np.uint32)
    row = {
        "ids": pa.array([ids.to_pylist()], pa.list_(ids.type)),
        "n_a": pa.array([n_a]),
        "n_b": pa.array([n_b]),
        "n_windows": pa.array([n_windows]),
        "places": _squeezed(places.astype(np.uint32)),
        "groups": _squeezed(np.frombuffer("\n".join(groups.to_pylist()).encode(), np.uint8)),
        "sizes": _squeezed(sizes),
        "links": _squeezed(pair.astype(np.uint32)),
        "keys": distinct.tobytes(),
        "counts": counts.tobytes(),
    }
    columns = {k: v if isinstance(v, pa.Array) else pa.array([v], pa.binary()) for k, v in row.items()}
    return pa.RecordBatch.from_pydict({"block_id": pa.array([number], pa.int64())} | columns)


def _added(rows: pa.Table) -> pa.Table:
    """Totals of a range of pairs, for each block those of its own, and the highest of each second id."""
    _, totals, where, borders = exchange.added(rows["keys"].to_pylist(), rows["counts"].to_pylist(), np.uint32)
    keys = np.frombuffer(b"".join(rows["keys"].to_pylist()), np.uint64)
    pairs = np.empty(len(totals), np.uint64)
    pairs[where] = keys
    second, at = np.unique(_unmixed(pairs) & np.uint64(2**32 - 1), return_inverse=True)
    most = np.zeros(len(second), np.int64)
    np.maximum.at(most, at, totals)
    back, size = totals[where], rows.num_rows
    packs = [pa.compress(back[x:y].tobytes(), "zstd", asbytes=True) for x, y in zip(borders[:-1], borders[1:])]
    return pa.table(
        {
            "range": pa.array([rows["range"][0].as_py()] * (size + 1), pa.int32()),
            "block_id": pa.array([*rows["block_id"].to_pylist(), None], pa.int64()),
            "totals": pa.array([*packs, None], pa.binary()),
            "second": pa.array([None] * size + [second.astype(np.int64)], pa.list_(pa.int64())),
            "most": pa.array([None] * size + [most], pa.list_(pa.int64())),
        }
    )


def aligned(
    docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """How the tokens of a byte-level BPE (A) and a sentencepiece model (B) lie on each other, text by text.

    Returns ``id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups``. Both encode a blank and the text, without
    special tokens, whose strings are plain text. Bytes at which a token of A and one of B end together cut them into
    groups: ``groups`` reads ``a1,a2|b1;a3|b2,b3``, ids in order. A link is a pair of tokens that end together; the count
    of a pair of ids is how many links of all ``docs`` join them. ``count_sum`` adds the counts of a text's links;
    ``n_best`` says how many of them have the highest count that their id of B has with any id of A, ties included.

    Null and empty texts, and those whose tokens do not spell a blank and the text, have no tokens: zeros and an empty
    ``groups``. A row for each row, null ids and repeated rows too, each counted; an empty table gives none; other
    columns are ignored. ``byte_path`` and ``piece_path`` are the tokenizers' files, at the same place on all
    executors. A task holds one text with its tokens, or a block of about ``BLOCK_BYTES``.
    """
    shipped(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number = Aligner(byte_path, piece_path), TaskContext.get().partitionId() << 32
        for batch in batches:
            offsets, at = words.layout(batch.column(1))[1], 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES, "right")) - 1)
                yield _block(number, batch.column(0).slice(at, to - at), batch.column(1).slice(at, to - at), aligner)
                number, at = number + 1, to
            pa.default_memory_pool().release_unused()

    state = saved(texts.mapInArrow(begin, _STATE.format(kind=kind)), "align-blocks")
    size = state.agg(F.coalesce(F.sum(F.octet_length("keys")), F.lit(0))).first()[0] // 8
    ranges = exchange.ranges_for(size)
    schema = "range int, block_id long, totals binary, second array<long>, most array<long>"
    totals = saved(exchange.dealt(state, ranges, 4).groupBy("range").applyInArrow(_added, schema), "align-totals")
    # one number for each id of B
    each = totals.filter("block_id IS NULL").select(F.explode(F.arrays_zip("second", "most")).alias("x")).select("x.*")
    most = {row[0]: row[1] for row in each.groupBy("second").agg(F.max("most")).collect()}
    parts = exchange.gathered(totals.filter("block_id IS NOT NULL"), "totals")
    # a few bytes for each different pair of a block
    parts = F.broadcast(parts) if 2 * 8 * size <= BROADCAST_BYTES else parts
    joined = state.drop("counts").join(parts, "block_id", "left")
    counted = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
    return joined.mapInArrow(_finish(ranges, most), f"id {kind}, {counted}").withColumnRenamed("id", id_col)


def _finish(ranges: int, most: dict[int, int]):
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        highest = np.zeros(1 + max(most, default=0), np.int64)
        highest[list(most)] = list(most.values())
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch[name][i].as_py() for name in batch.schema.names}
                yield _counted(row, batch["ids"].type.value_type, ranges, highest)

    return finish


def _counted(row: dict, type_of_id: pa.DataType, ranges: int, highest: np.ndarray) -> pa.RecordBatch:
    links, keys = _restored(row["links"], np.uint32), np.frombuffer(row["keys"], np.uint64)
    totals = exchange.totals_of(keys, ranges, row["parts"] or [])
    count = totals[links]
    best = (totals == highest[(_unmixed(keys) & np.uint64(2**32 - 1)).astype(np.int64)])[links]
    # numbers of each different window, then of each text
    sizes = _restored(row["sizes"], np.uint32).astype(np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    counts = np.zeros(len(sizes), np.int64)
    np.add.at(counts, owner, count)
    bests = np.bincount(owner[best], minlength=len(sizes))
    names = pa.array(_restored(row["groups"], np.uint8).tobytes().decode().split("\n"))
    places = _restored(row["places"], np.uint32)
    ends = np.cumsum(row["n_windows"])
    begins = ends - np.array(row["n_windows"], np.int64)

    def of_texts(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(values[places])])
        return sums[ends] - sums[begins]

    n_links = of_texts(sizes)
    rows = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), names.take(pa.array(places)))
    groups = pc.binary_join(rows, ";")
    return pa.RecordBatch.from_pydict(
        {
            "id": pa.array(row["ids"], type_of_id),
            "n_a": pa.array(row["n_a"], pa.int64()),
            "n_b": pa.array(row["n_b"], pa.int64()),
            "n_groups": pa.array(n_links),
            "n_links": pa.array(n_links),
            "n_best": pa.array(of_texts(bests)),
            "count_sum": pa.array(of_texts(counts)),
            "groups": groups,
        }
    )
