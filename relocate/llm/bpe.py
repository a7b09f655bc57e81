"""BPE encoding and decoding of whole texts, long ones by tree concatenation.

A long text is cut into halves, and these again, down to leaves that tasks encode side by side. Neighbours are then
joined two by two: a window around the join is encoded anew and grows until its tokens agree with those of both sides.

For tokenizers that drop white space, as ``word_bpe_49k.json``: there, text between blanks is encoded by itself, so
each different word is encoded once per task and remembered within bounds.
"""

from __future__ import annotations

import json
import math
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relocate.llm import shipped, words

LEAF_CHARS = 16_384
LEAVES_AT_ONCE = 64
FIRST_WINDOW = 64
WORDS_KEPT, PIECES_KEPT = 200_000, 300_000
#: So many letters on both sides of a place show that no special token or contraction lies across it.
CLEAR = 16

#: Characters that neither normal form nor any other rule of the tokenizer changes, but for letter case.
_PLAIN = re.compile("[!-~¡-¬®-ÖØ-öø-ÿ×÷]+")
_BREAK = re.compile(r"[ \t\n\x0b\x0c\r0-9]")


def _byte_names() -> list[str]:
    """The character that byte-level BPE writes for each byte: printable ones stand for themselves, others follow 255."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


class Encoder:
    """Encodes texts as the tokenizers library does, without special tokens added, truncation or padding."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        plan = json.loads(Path(path).read_text())
        split = next((p for p in (plan["pre_tokenizer"] or {}).get("pretokenizers", []) if p["type"] == "Split"), {})
        if plan["model"]["type"] != "BPE" or not (split.get("behavior") == "Removed" and split.get("invert")) or plan["decoder"]:
            raise ValueError(f"{path}: not a BPE tokenizer that drops white space")
        self._library = Tokenizer.from_file(path)
        self._library.no_truncation()
        self._library.no_padding()
        self._model = self._library.model
        self._split = regex.compile(split["pattern"]["Regex"])
        self._names = _byte_names()
        self._words: dict[str, bytes] = {}
        self._pieces: dict[str, bytes] = {}
        self.tokens = [self._library.id_to_token(i) or "" for i in range(self._library.get_vocab_size(with_added_tokens=True))]
        suffix = plan["model"]["end_of_word_suffix"] or ""
        self.widths = np.array([len(t.removesuffix(suffix)) if suffix else len(t) for t in self.tokens])

    def _piece(self, piece: str) -> bytes:
        known = self._pieces.get(piece)
        if known is None:
            if len(self._pieces) >= PIECES_KEPT:
                self._pieces.clear()
            spelt = piece if piece.isascii() else "".join([self._names[b] for b in piece.encode()])
            known = array("I", [t.id for t in self._model.tokenize(spelt)]).tobytes()
            self._pieces[piece] = known
        return known

    def _word(self, word: str) -> bytes:
        stem = word.rstrip(".,;:!?")
        if stem.isalpha() and (word.isascii() or _PLAIN.fullmatch(word)):
            known = self._piece(stem.lower())
            if len(stem) < len(word):
                known += self._piece(word[len(stem) :])
        elif _PLAIN.fullmatch(word) and "<|" not in word:
            known = b"".join([self._piece(p) for p in self._split.findall(word.lower())])
        else:
            known = np.array(self._library.encode(word, add_special_tokens=False).ids, np.uint32).tobytes()
        if len(self._words) >= WORDS_KEPT:
            self._words.clear()
        self._words[word] = known
        return known

    def encode(self, text: str) -> np.ndarray:
        """Token ids of one text."""
        return self.encode_many(pa.array([text]))[0]

    def encode_many(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str], np.ndarray, np.ndarray]:
        """Token ids of all texts in a row, and borders by text.

        And of the words, empty ones included: tokens up to each one's end, the different words, which of them each
        one is, and how many each text has.
        """
        split = pc.ascii_split_whitespace(texts.fill_null(""))
        coded = split.flatten().dictionary_encode()
        own = coded.dictionary.to_pylist()
        known = self._words
        blobs = [found if (found := known.get(w)) is not None else self._word(w) for w in own]
        sizes = np.fromiter(map(len, blobs), np.int32, len(blobs)) >> 2
        alphabet = np.frombuffer(b"".join(blobs), np.uint32)
        begins = np.cumsum(sizes, dtype=np.int32) - sizes
        order = coded.indices.to_numpy()
        counts = sizes[order]
        ends = np.cumsum(counts, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        place = np.repeat(begins[order] - (ends - counts).astype(np.int32), counts)
        place += np.arange(total, dtype=np.int32)
        offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
        return alphabet[place], np.concatenate([[0], ends])[offsets], ends, own, order, np.diff(offsets)

    def decode(self, ids: np.ndarray) -> str:
        return " ".join([self.tokens[i] for i in ids.tolist()])

    # --- joins ---

    def joined(self, left: tuple[str, np.ndarray], right: tuple[str, np.ndarray]) -> tuple[str, np.ndarray]:
        """Text and ids of ``left`` followed by ``right``, as if encoded at once.

        A window's left edge is a blank or a digit, where encoding always starts afresh, or a token of the left side
        inside a run of letters; its right edge likewise. Two neighbouring tokens of a BPE encoding depend on nothing
        else, so where the window repeats one token of each side, the rest of that side stands.
        """
        text = left[0] + right[0]
        reach = FIRST_WINDOW
        while reach < max(len(left[0]), len(right[0])):
            ids = self._windowed(left, right, reach)
            if ids is not None:
                return text, ids
            reach *= 2
        return text, self.encode(text)

    def _windowed(self, left: tuple[str, np.ndarray], right: tuple[str, np.ndarray], reach: int) -> np.ndarray | None:
        begin = self._left_edge(left, reach)
        if begin is None:
            return None
        at, kept = begin
        tail, (head, head_ids) = left[0][at:], right
        cut = _BREAK.search(head)
        if len(head) <= reach or cut and cut.end() < reach:
            to = cut.end() - (not cut[0].isdigit()) if cut and cut.end() < reach else len(head)
            window, inside = self.encode(tail + head[:to]), self.encode(head[:to])
            if not np.array_equal(inside, head_ids[: len(inside)]):
                return None
            rest = head_ids[len(inside) :]
        else:
            part = head[:reach]
            if not _letters(part):
                return None
            window = self.encode(tail + part)
            ends = np.cumsum(self.widths[window]) - self.widths[window].sum() + len(part.lower().encode())
            own = np.cumsum(self.widths[head_ids[: 4 * reach]])
            places = {int(e): i for i, e in enumerate(own) if e >= 4 * CLEAR}
            # not the window's last token, which ends where the window was cut
            agreed = [(i, places[int(e)]) for i, e in enumerate(ends[:-1]) if int(e) in places and window[i] == head_ids[places[int(e)]]]
            if not agreed:
                return None
            window, rest = window[: agreed[0][0] + 1], head_ids[agreed[0][1] + 1 :]
        if kept < len(left[1]) and (not len(window) or window[0] != left[1][kept]):
            return None
        return np.concatenate([left[1][:kept], window, rest])

    def _left_edge(self, left: tuple[str, np.ndarray], reach: int) -> tuple[int, int] | None:
        """Where the window starts in the text, and how many tokens lie before."""
        text, ids = left
        part = text[-reach:]
        cuts = list(_BREAK.finditer(part))
        if cuts:
            at = len(text) - len(part) + cuts[-1].start()
            inside = self.encode(text[at:])
            kept = len(ids) - len(inside)
            return (at, kept) if np.array_equal(ids[kept:], inside) else None
        if len(part) == len(text):
            return 0, 0
        if not _letters(part):
            return None
        spelt = part.lower().encode()
        start, kept = len(spelt), len(ids)
        best = None
        while kept and start - self.widths[ids[kept - 1]] >= 4 * CLEAR:
            kept -= 1
            start -= int(self.widths[ids[kept]])
            if kept < len(ids) - 1 and spelt[start] & 0xC0 != 0x80:
                best = (len(text) - len(spelt[start:].decode()), kept)
        return best


def _letters(text: str) -> bool:
    """A run of letters that normalization leaves as long as it is."""
    return text.isalpha() and unicodedata.is_normalized("NFC", text) and len(text.lower()) == len(text)


def _tree(coder: Encoder, parts: list[tuple[str, np.ndarray]]) -> np.ndarray:
    while len(parts) > 1:
        pairs = [coder.joined(a, b) for a, b in zip(parts[::2], parts[1::2])]
        parts = pairs + parts[len(parts) - len(parts) % 2 :]
    return parts[0][1]


def runs_of_texts(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``words.SLICE_BYTES``."""
    offsets = words.layout(texts)[1]
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + words.SLICE_BYTES, "right")) - 1)
        yield at, to
        at = to


def encoded(
    docs: DataFrame,
    path: str,
    leaf: int = LEAF_CHARS,
    id_col: str = "doc_id",
    text_col: str = "text",
    decoded_col: str | None = None,
) -> DataFrame:
    """``(id_col, ids)``: the token ids of every whole text, as little-endian unsigned 32-bit numbers in one binary.

    ``path`` is the tokenizer's file, at the same place on all executors. Null and empty texts have no tokens. A row
    for each row, repeated rows and null ids included; an empty table gives none. Texts of more than ``leaf``
    characters are cut into leaves that are dealt over the cluster; one text and its ids must fit in a task.
    ``decoded_col`` adds the ids' text, as :func:`decoded` does, without a second pass.
    """
    shipped(docs.sparkSession)
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    back = decoded_col is not None
    schema = f"id {kind}, ids binary" + ", back string" * back

    def answers(coder: Encoder, found: list[np.ndarray]) -> dict[str, pa.Array]:
        out = {"ids": pa.array([x.astype(np.uint32).tobytes() for x in found], pa.binary())}
        return out | ({"back": pa.array([coder.decode(x) for x in found], pa.string())} if back else {})

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            for at, to in runs_of_texts(batch.column(1)):
                ids, borders, *_ = coder.encode_many(batch.column(1).slice(at, to - at))
                found = [ids[a:b] for a, b in zip(borders[:-1], borders[1:])]
                yield pa.RecordBatch.from_pydict({"id": batch.column(0).slice(at, to - at)} | answers(coder, found))
        pa.default_memory_pool().release_unused()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch["text"].to_pylist()):
                pieces = 1 << math.ceil(math.log2(len(text) / leaf))
                step = -(-len(text) // pieces)
                for first in range(0, pieces, LEAVES_AT_ONCE):
                    some = range(first, min(first + LEAVES_AT_ONCE, pieces))
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(batch[c].slice(i, 1).take(pa.array([0] * len(some))) for c in ("row", "id")),
                            pa.array(some, pa.int32()),
                            pa.array([text[j * step : (j + 1) * step] for j in some], pa.string()),
                        ],
                        ["row", "id", "leaf", "text"],
                    )

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            blobs = [coder.encode(t).tobytes() for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(blobs, pa.binary())], [*batch.schema.names, "ids"])

    def join(group: pa.Table) -> pa.Table:
        coder = encoder(path)
        rows = sorted(group.select(["leaf", "text", "ids"]).to_pylist(), key=lambda r: r["leaf"])
        ids = _tree(coder, [(r["text"], np.frombuffer(r["ids"], np.uint32)) for r in rows])
        return pa.table({"id": group["id"].slice(0, 1)} | answers(coder, [ids]))

    at_once = rows.filter(F.coalesce(F.length("text"), F.lit(0)) <= leaf).mapInArrow(short, schema)
    long = rows.filter(F.length("text") > leaf).withColumn("row", F.monotonically_increasing_id())
    dealt = long.select("row", "id", "text").mapInArrow(cut, f"row long, id {kind}, leaf int, text string")
    dealt = dealt.repartition("row", "leaf")
    done = dealt.mapInArrow(leaves, f"row long, id {kind}, leaf int, text string, ids binary")
    in_parts = done.groupBy("row").applyInArrow(join, schema)
    both = at_once.unionByName(in_parts).withColumnRenamed("id", id_col)
    return both.withColumnRenamed("back", decoded_col) if back else both


def decoded(rows: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``rows`` with ``text_col``, the text of the token ids in ``ids_col``, special tokens included; null where null.

    A column that already has the name is replaced.
    """
    shipped(rows.sparkSession)
    names = [c for c in rows.columns if c != text_col]
    schema = rows.select(*[rows[c] for c in names]).schema.add(text_col, "string")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            texts = [None if b is None else coder.decode(np.frombuffer(b, np.uint32)) for b in batch[ids_col].to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in names), pa.array(texts, pa.string())], [*names, text_col])

    return rows.mapInArrow(decode, schema)
