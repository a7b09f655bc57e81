"""Surrogates for personal data: keyed replacements of the same type and format.

A replacement is drawn from a keyed hash of the entity, so the same entity gets the same one everywhere. Over the whole
corpus, replacements of different entities are then compared with each other and with all entities found; those that
collide are drawn again, until all are distinct. Only entities that were drawn again have to be carried to the texts.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relocate.llm.blocks import saved_blocks, unpacked
from relocate.llm.memory import lean
from relocate.session import saved

BROADCAST_BYTES = 32 << 20
#: From this draw on, replacements of free length grow, so that short ones cannot run out: names, phones, secrets, local
#: parts. Formats of a fixed length stay; each has 10**8 places or more to draw from.
LOOSE = 8

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_TITLES = {
    "Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Dr": "", "Prof": "", "Herr": "m", "Frau": "f", "Monsieur": "m", "Madame": "f",
    "Mme": "f", "Señor": "m", "Señora": "f", "Sr": "m", "Sra": "f", "Господин": "m", "Госпожа": "f",
}
_GIVEN = {
    ("m", "latin"): "James John Robert Michael David Thomas Peter Paul Hans Karl Jean Pierre Luis Carlos Jorge Miguel".split(),
    ("f", "latin"): "Mary Anna Linda Susan Sarah Laura Julia Emma Greta Ingrid Marie Claire Sofia Carmen Elena Lucia".split(),
    ("m", "cyrillic"): "Иван Пётр Алексей Николай Сергей Дмитрий Михаил Андрей".split(),
    ("f", "cyrillic"): "Анна Мария Елена Ольга Наталья Ирина Татьяна Светлана".split(),
}
_GENDER = {name.casefold(): (gender, script) for (gender, script), names in _GIVEN.items() for name in names}
_SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ha he ka ke ko la le lo ma me mo na ne no pa pe ra re ro sa se so ta te to va ve wa we".split(),
    "cyrillic": "ба бе бо ва ве го да де до за ка ке ко ла ле ло ма ме мо на не но па пе ра ре ро са се со та те то".split(),
}
_LAST = {("m", "latin"): "n", ("f", "latin"): "na", ("m", "cyrillic"): "н", ("f", "cyrillic"): "на"}

_NAME = r"[^\W\d_][\w'’-]*"
_PATTERN = re.compile(
    "|".join(
        [
            r"(?P<email>(?<![\w.%+-])[\w.%+-]+@[\w-]+(?:\.[\w-]+)+)",
            r"(?P<secret>(?<!\w)(?i:password|passwd|pwd|secret|token|api[_-]?key)[ ]?[=:][ ]?(?P<value>[^\s,;]{4,}))",
            r"(?P<key>(?<![0-9A-Za-z])(?:[0-9a-f]{32,64}|AKIA[0-9A-Z]{16}|(?:sk|ghp)[-_][0-9A-Za-z]{20,})(?![0-9A-Za-z]))",
            r"(?P<iban>(?<!\w)[A-Z]{2}\d\d(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w))",
            rf"(?P<ip>(?<!\w)(?<!\d\.){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\d))",
            r"(?P<card>(?<!\w)[3-6]\d(?:[ -]?\d){11,17}(?!\w))",
            r"(?P<ssn>(?<![\w-])\d{3}-\d\d-\d{4}(?![\w-]))",
            r"(?P<phone>(?<!\w)(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4}|(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4})(?!\w|-\d))",
        ]
    )
)
_PERSON = re.compile(
    rf"\b(?P<title>{'|'.join(_TITLES)})\.? (?P<first>(?=[A-ZÀ-ÞА-Я]){_NAME})(?: (?P<last>(?=[A-ZÀ-ÞА-Я]){_NAME}))?"
    rf"|\b(?P<given>{'|'.join(n for names in _GIVEN.values() for n in names)}) (?P<family>(?=[A-ZÀ-ÞА-Я]){_NAME})"
)
#: One of these is in every text that the pattern matches.
_SIGNS = re.compile(r"[\d@]|AKIA|(?:sk|ghp)[-_]|[a-f]{32}|(?i:password|passwd|pwd|secret|token|api.?key)[ ]?[=:]")


@dataclass(frozen=True)
class Mention:
    start: int
    end: int
    kind: str
    entity: str  # the same for all spellings of one entity
    text: str


def _script(text: str) -> str:
    return "cyrillic" if any("Ѐ" <= c <= "ӿ" for c in text) else "latin"


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def _entity(kind: str, text: str) -> str:
    if kind == "email":
        return text.lower()
    if kind == "phone" and text.startswith("+"):
        code = re.match(r"\+\d{1,3}", text)[0]
        return f"{code} {_digits(text[len(code):])}"
    if kind in ("phone", "card", "ssn"):
        return _digits(text)
    return text.replace(" ", "") if kind == "iban" else text


def mentions(text: str | None) -> list[Mention]:
    """Personal data in a text, in order, without overlaps."""
    found = []
    if text and _SIGNS.search(text):
        for m in _PATTERN.finditer(text):
            kind = m.lastgroup if m.lastgroup != "value" else "secret"
            start, end = m.span("value") if kind == "secret" else m.span()
            if kind == "secret":
                end -= len(m["value"]) - len(m["value"].rstrip(".!?)\"'"))
            elif kind == "email":
                end -= len(m[0]) - len(m[0].rstrip(".-"))
            found.append(Mention(start, end, kind, _entity(kind, text[start:end]), text[start:end]))
    people = []
    for m in _PERSON.finditer(text or ""):
        title = _TITLES.get(m["title"] or "", "")
        first, last = ("first", "last") if m["title"] else ("given", "family")
        gender, known = _GENDER.get(m[first].casefold(), (title, None))
        if not m[last] and not known:
            first, last = None, "first"
        for part, role in ((first, f"given-{gender}"), (last, "family")):
            if part and m[part]:
                script = _script(m[part])
                people.append(Mention(*m.span(part), f"{role}-{script}", m[part].casefold(), m[part]))
    if not people:
        return found
    taken = [(x.start, x.end) for x in found]
    people = [p for p in people if not any(a < p.end and p.start < b for a, b in taken)]
    return sorted(found + people, key=lambda x: x.start)


class _Draws:
    """Numbers from a keyed hash."""

    def __init__(self, key: bytes, *what: object):
        self._key, self._what, self._block, self._left = key, "\x1f".join(map(str, what)), 0, b""

    def below(self, count: int) -> int:
        if len(self._left) < 6:
            seed = f"{self._what}\x1f{self._block}".encode()
            self._left, self._block = hmac.new(self._key, seed, hashlib.sha256).digest(), self._block + 1
        value, self._left = int.from_bytes(self._left[:6], "big"), self._left[6:]
        return value % count

    def of(self, choices):
        return choices[self.below(len(choices))]


def _like(text: str, draw: _Draws, letters: str = "abcdefghijklmnopqrstuvwxyz") -> str:
    """Another text of the same format: digits for digits, letters for letters of the same case and script."""
    out = []
    for c in text:
        if c.isdigit():
            out.append(draw.of("123456789" if c != "0" and not out else "0123456789"))
        elif "а" <= c.lower() <= "я":
            new = chr(ord("а") + draw.below(32))
            out.append(new.upper() if c.isupper() else new)
        elif c.isascii() and c.isalpha() or c.isalpha() and c.lower() != c.upper():
            new = draw.of(letters)
            out.append(new.upper() if c.isupper() else new)
        else:
            out.append(chr(0x4E00 + draw.below(0x5000)) if "一" <= c <= "鿿" else c)
    return "".join(out)


def _luhn(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10


def surrogate(key: bytes, kind: str, entity: str, turn: int = 0) -> str:
    """The ``turn``-th replacement of an entity; of the same type, script, gender and format."""
    draw = _Draws(key, kind, entity, turn)
    extra = max(0, turn - LOOSE + 1)
    longer = "".join(draw.of("abcdefghijklmnopqrstuvwxyz") for _ in range(extra))
    digits = "".join(draw.of("0123456789") for _ in range(extra))
    if kind == "email":
        local, _, domain = entity.partition("@")
        labels = domain.split(".")
        new = _like(".".join(labels[:-1]), _Draws(key, "domain", domain))
        return f"{_like(local, draw)}{longer}@{new}.{labels[-1]}"
    if kind == "ip":
        return ".".join(str(1 + draw.below(254)) for _ in range(4))
    if kind == "phone":
        code, space, rest = entity.rpartition(" ")
        return code + space + _like(rest, draw) + digits
    if kind == "card":
        body = entity[0] + _like(entity[1:], draw)
        if _luhn(entity) == 0:
            body = next(body[:-1] + d for d in "0123456789" if _luhn(body[:-1] + d) == 0)
        return body
    if kind == "iban":
        body = _like(entity[4:], draw)
        number = "".join(str(int(c, 36)) for c in body + entity[:2])
        return f"{entity[:2]}{98 - int(number + '00') % 97:02d}{body}"
    if kind.startswith("given"):
        _, gender, script = kind.split("-")
        gender = gender or draw.of("mf")
        if turn < 3:
            return draw.of(_GIVEN[gender, script]).casefold()
        return _name(draw, script, 2 + max(0, turn - LOOSE)) + _LAST[gender, script]
    if kind.startswith("family"):
        return _name(draw, kind.rpartition("-")[2], 3 + max(0, turn - LOOSE))
    letters = "abcdef" if re.fullmatch(r"[0-9a-f]+", entity) else "abcdefghijklmnopqrstuvwxyz"
    return _like(entity, draw, letters) + (longer if kind == "secret" else "")


def _name(draw: _Draws, script: str, syllables: int) -> str:
    return "".join(draw.of(_SYLLABLES[script]) for _ in range(syllables))


def written(mention: Mention, replacement: str) -> str:
    """The replacement in the spelling of the mention; what it has more goes to the end."""
    text = mention.text
    if mention.kind in ("phone", "card", "ssn", "iban"):
        sources = iter(replacement.replace("+", "").replace(" ", ""))
        return "".join(next(sources) if c.isalnum() else c for c in text) + "".join(sources)
    if "-" in mention.kind:
        return replacement.upper() if text.isupper() and len(text) > 1 else replacement.capitalize() if text[0].isupper() else replacement
    return replacement.upper() if mention.kind == "email" and text.isupper() else replacement


def _found(text_col: str) -> Callable:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, payload in zip(batch["block_id"].to_pylist(), batch["payload"]):
                texts = unpacked(payload.as_py())[text_col]
                own = sorted({(m.kind, m.entity) for t in texts for m in mentions(t.as_py())})
                yield pa.RecordBatch.from_pydict(
                    {
                        "block_id": pa.array([block] * len(own), pa.int64()),
                        "kind": pa.array([o[0] for o in own], pa.string()),
                        "entity": pa.array([o[1] for o in own], pa.string()),
                    }
                )

    return lean(find)


def _drawn(key: bytes) -> Callable:
    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch[c].to_pylist() for c in ("kind", "entity", "turn")))
            new = pa.array([surrogate(key, *row) for row in rows], pa.string())
            yield pa.RecordBatch.from_arrays([batch["kind"], batch["entity"], batch["turn"], new], ["kind", "entity", "turn", "new"])

    return lean(draw)


def _family(kind):
    """Kinds whose replacements must differ from each other: all given names of a script together."""
    return F.regexp_replace(kind, "^given-[mf]?", "given")


def distinct_draws(entities: DataFrame, key: bytes) -> DataFrame:
    """``(kind, entity, turn)`` of the entities whose first replacement is taken; all replacements are distinct then.

    Of those that meet in one replacement the first to draw it keeps it; a replacement that is itself an entity of the
    corpus is never used.
    """
    known = entities.select(_family(F.col("kind")).alias("family"), F.col("entity").alias("new")).distinct()
    now = entities.withColumn("turn", F.lit(0))
    while True:
        drawn = saved(now.mapInArrow(_drawn(key), "kind string, entity string, turn int, new string"), "pii-draws")
        named = drawn.withColumn("family", _family(F.col("kind")))
        holders = named.groupBy("family", "new").agg(F.min(F.struct("turn", "kind", "entity")).alias("holder"))
        taken = known.withColumn("real", F.lit(True))
        judged = named.join(holders, ["family", "new"]).join(taken, ["family", "new"], "left")
        again = F.col("real").isNotNull() | (F.struct("turn", "kind", "entity") != F.col("holder"))
        judged = saved(judged.select("kind", "entity", "turn", again.alias("again")), "pii-judged")
        if not judged.filter("again").limit(1).count():
            return drawn.filter("turn > 0").select("kind", "entity", "turn")
        now = judged.select("kind", "entity", (F.col("turn") + F.col("again").cast("int")).alias("turn"))


def with_surrogates(docs: DataFrame, key: bytes, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with the personal data in ``text_col`` replaced.

    Replaced are e-mail addresses, phone and card numbers, IP addresses, social security numbers, IBANs, passwords and
    keys, and names after a title or made of a known given name and a family name. The rest of the text, all rows,
    repeated ones too, and all other columns stay. One entity has one replacement wherever and however it is written;
    two have different ones. Null and empty texts stay. ``count_col`` adds the number of replacements and replaces a
    column of that name. An empty table gives an empty table. The same key gives the same replacements, as long as the
    corpus holds the same entities.
    """
    blocks = saved_blocks(docs, "pii-blocks")
    found = saved(blocks.mapInArrow(_found(text_col), "block_id long, kind string, entity string"), "pii-found")
    changed = distinct_draws(found.select("kind", "entity").distinct(), key)
    turns = found.join(changed, ["kind", "entity"]).groupBy("block_id").agg(F.collect_list(F.struct("kind", "entity", "turn")).alias("turns"))
    turns = saved(turns, "pii-turns")
    size = turns.agg(F.sum(F.aggregate("turns", F.lit(0).cast("long"), lambda s, t: s + 40 + F.octet_length(t["entity"])))).first()[0]
    if (size or 0) <= BROADCAST_BYTES:
        turns = F.broadcast(turns)
    names = [c for c in docs.columns if c != count_col]
    schema = docs.select(*[docs[c] for c in names]).schema
    if count_col is not None:
        schema = schema.add(count_col, "long")

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for i in range(rows.num_rows):
                batch = unpacked(rows["payload"][i].as_py())
                later = {(t["kind"], t["entity"]): t["turn"] for t in rows["turns"][i].as_py() or []}
                texts, counts = [], []
                for text in batch[text_col].to_pylist():
                    own = mentions(text)
                    texts.append(_replaced(text, own, key, later) if own else text)
                    counts.append(len(own))
                columns = {c: pa.array(texts, batch[c].type) if c == text_col else batch[c] for c in names}
                if count_col is not None:
                    columns[count_col] = pa.array(counts, pa.int64())
                yield pa.RecordBatch.from_pydict(columns)

    return blocks.join(turns, "block_id", "left").mapInArrow(lean(replace), schema)


def _replaced(text: str, own: list[Mention], key: bytes, later: dict) -> str:
    out, at = [], 0
    for m in own:
        new = surrogate(key, m.kind, m.entity, later.get((m.kind, m.entity), 0))
        out += [text[at : m.start], written(m, new)]
        at = m.end
    return "".join(out) + text[at:]
