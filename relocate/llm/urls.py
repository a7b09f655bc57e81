"""URL verdicts: rules by host and path first, then a list of URLs behind a blocked Bloom filter.

Each listed URL sets one bit in each of the eight words of one block, so a look-up reads a single block. URLs that the
filter passes are joined with the list itself, which removes its false positives.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relocate.session import saved

WORDS = 8
BITS_PER_URL = 16
BROADCAST_BLOCKS = 400_000  # of 72 bytes, about 30 MB

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Query parameters that say how a visitor came.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=.*)?$"


@dataclass(frozen=True)
class Rule:
    """``allow`` or ``block`` of a host with its subdomains, where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @classmethod
    def parse(cls, verdict: str, text: str) -> Rule:
        host, slash, path = text.partition("/")
        return cls(verdict, host, slash + path)

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def _part(url: Column, group: int) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, group), F.lit(""))


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?`` or ``#``, A-Z lower-cased; empty without ``://``."""
    return F.translate(_part(url, 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return _part(url, 2)


def canonical(url: Column) -> Column:
    """The URL without scheme, ``www.``, last slash, fragment and tracking parameters, the other parameters sorted.

    Null without a host.
    """
    host = F.regexp_replace(host_of(url), r"^www\.", "")
    given = F.split(F.substring(_part(url, 3), 2, 1_000_000_000), "&")
    kept = F.array_join(F.sort_array(F.filter(given, lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    path = F.regexp_replace(path_of(url), "/$", "")
    return F.when(host != "", F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")))


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks))


def _bit(url: Column, word: int) -> Column:
    """The URL's bit in a word of its block."""
    place = F.shiftrightunsigned(F.xxhash64(url, F.lit("bits")), 6 * word).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def bloom_filter(urls: DataFrame, blocks: int) -> DataFrame:
    """``(block, w0 .. w7)`` of the column ``url``; blocks without a URL are left out."""
    url = F.col("url")
    bits = [F.bit_or(_bit(url, k)).alias(f"w{k}") for k in range(WORDS)]
    return urls.groupBy(_block(url, blocks).alias("block")).agg(*bits)


def judged(
    pages: DataFrame, rules: Sequence[Rule], listed: DataFrame, url_col: str = "url", bits: int = BITS_PER_URL
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``; columns of these names are replaced.

    The longest rule that fits gives the verdict, among equally long ones that of the longer host. Where none fits, a URL is
    blocked when its canonical form is that of a URL in the first column of ``listed``, else allowed. A null URL, or
    one without ``://``, has an empty host and path and is allowed. Every row keeps its place: repeated rows get the
    same verdict. An empty list blocks nothing, an empty table gives no rows.

    The filter has ``bits`` bits for each listed URL. Its size is known before it is used: small ones are broadcast,
    others are joined by block.
    """
    named = listed.select(F.col(listed.columns[0]).alias("raw")).select(canonical(F.col("raw")).alias("url"))
    exact = saved(named.filter("url IS NOT NULL").distinct(), "listed-urls")
    blocks = max(1, math.ceil(exact.count() * bits / (64 * WORDS)))
    table = saved(bloom_filter(exact, blocks), "url-filter")
    table = table.select(*[F.col(c).alias(f"_u_{c}") for c in table.columns])
    if blocks <= BROADCAST_BLOCKS:
        table = F.broadcast(table)

    ordered = sorted(rules, key=lambda r: (-len(r.text), -len(r.host), r.text))
    url = pages[url_col]
    out = pages.drop("host", "path", "rule", "verdict", "_u_url", "_u_own", "_u_maybe", "_u_listed")
    out = out.withColumns({"host": host_of(url), "path": path_of(url), "_u_url": canonical(url)})
    host, path = F.col("host"), F.col("path")
    pick = lambda value: F.coalesce(F.lit(None), *[F.when(r.fits(host, path), F.lit(value(r))) for r in ordered])
    out = out.withColumns({"rule": pick(lambda r: r.text).cast("string"), "verdict": pick(lambda r: r.verdict).cast("string")})

    key = F.when(F.col("rule").isNull(), F.col("_u_url"))
    own = F.col("_u_url")
    passes = F.lit(True)
    for k in range(WORDS):
        passes = passes & (F.col(f"_u_w{k}").bitwiseAND(_bit(own, k)) != 0)
    settled = out.filter(key.isNull())
    open_rows = out.filter(key.isNotNull()).withColumn("_u_own", _block(own, blocks))
    probed = open_rows.join(table, F.col("_u_own") == F.col("_u_block"), "left")
    probed = probed.withColumn("_u_maybe", F.coalesce(passes, F.lit(False)))
    probed = saved(probed.select(*out.columns, "_u_maybe"), "url-probed")

    absent = probed.filter("NOT _u_maybe").withColumn("verdict", F.lit("allow"))
    found = F.when(F.col("_u_listed").isNotNull(), "block").otherwise("allow")
    present = probed.filter("_u_maybe").join(exact.withColumnRenamed("url", "_u_listed"), F.col("_u_url") == F.col("_u_listed"), "left")
    parts = [
        settled.withColumn("verdict", F.coalesce("verdict", F.lit("allow"))),
        absent,
        present.withColumn("verdict", found),
    ]
    names = [c for c in out.columns if c != "_u_url"]
    first, *rest = [p.select(*names) for p in parts]
    for part in rest:
        first = first.unionByName(part)
    return first
