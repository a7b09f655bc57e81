"""Plain versions of the operators, and small tables with odd rows."""

from __future__ import annotations

import collections
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLDER = "/root/testdata/sf0.001"

STORY = "The quick brown fox jumps over the lazy dog while the small grey cat sleeps on the warm red roof near our old house. "
LONG = " ".join(f"word{i % 997} and{i % 31}." for i in range(6000))

#: Null, empty, blank, repeated, tied and very long texts; ids repeat with their rows.
TEXTS = [
    (1, None),
    (2, ""),
    (3, " \t\n\r\x0b\x0c "),
    (4, STORY * 3),
    (5, STORY * 3),
    (5, STORY * 3),
    (6, STORY + "One more sentence follows here, and it ends well."),
    (7, LONG),
    (8, LONG + " tail."),
    (9, "x" * 50_000),
    (10, "Ünïcödé 漢字かな 🙂 naïve space don't <|endoftext|> 12 345."),
    (None, STORY),
    (12, "single"),
    (13, "Single"),
]


def documents(spark, rows=None):
    """Documents with columns whose names operators use themselves."""
    rows = TEXTS if rows is None else rows
    schema = "doc_id long, text string, n_words string, id int, block_id string, payload int, kept string, n int"
    return spark.createDataFrame([(i, t, "w", 7, "b", 1, "k", 3) for i, t in rows], schema)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(text or "")


class Groups:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def root(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def near_groups(rows, size, percent=80):
    """Shingle sets and group of each id."""
    sets, where = {}, collections.defaultdict(set)
    for i, text in rows:
        own = words(lower(text))
        sets[i] = {tuple(own[p : p + size]) for p in range(max(1, len(own) - size + 1))} if own else set()
        for shingle in sets[i]:
            where[shingle].add(i)
    groups = Groups(sets)
    common = collections.Counter((a, b) for ids in where.values() for a in ids for b in ids if a < b)
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            groups.join(a, b)
    return sets, groups


def repeats(rows, size):
    """For each row, which of its words lie in a window found anywhere else."""
    found = collections.Counter()
    for _, text in rows:
        own = words(text)
        found.update(tuple(own[p : p + size]) for p in range(len(own) - size + 1))
    out = []
    for _, text in rows:
        own = words(text)
        covered = [False] * len(own)
        for p in range(len(own) - size + 1):
            if found[tuple(own[p : p + size])] > 1:
                covered[p : p + size] = [True] * size
        out.append((own, covered))
    return out
