"""URL filters: ordered host/path rules, then a list of canonical URLs behind a
blocked Bloom filter.

The filter has ``2 ** k`` blocks of one 64-bit word; a listed URL sets
``BITS`` bits in the one block its hash chooses.  Its non-empty blocks form a
table (block, bits) of known size, joined to the pages by block: broadcast when
its proven size is within ``BROADCAST_BYTES``, else a plain join.  Pages whose
bits are all set are possible hits; an exact join on the canonical URL then
removes the false positives, so verdicts never depend on the filter.

Defined results: a null URL or one without ``://`` has an empty host and path,
fits no rule and is never listed; repeated rows are judged alike; an empty
list blocks nothing; an empty table gives an empty result; extra columns are
not read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.llm.registry import register
from stayline.sources.tables import table

#: Bits set per URL, bits of filter per URL, and the largest filter that is broadcast.
BITS = 5
BITS_PER_URL = 16
BROADCAST_BYTES = 64 << 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Query keys that only track a visit: fixed values.
TRACKING = ("ref", "fbclid", "gclid", "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content")


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def label(self) -> str:
        return self.host + self.path


#: The stated rules.
RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
         Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))

#: Words in a host that put its pages on the list: fixed values.
LISTED_TERMS = ("adult", "casino")


def host_of(url: Column) -> Column:
    h = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(h, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Host without ``www.`` and default port, path without a closing slash or
    ``.html``, the query's non-tracking pairs in order; no scheme or fragment.
    Null where the URL has no host."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(path_of(url), r"(\.html)?/*$", "")
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    pairs = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.substring_index(p, "=", 1).isin(
        *TRACKING)))
    q = F.array_join(pairs, "&")
    return F.when(host != "", F.concat(host, path, F.when(q != "", F.concat(F.lit("?"), q)).otherwise("")))


def longest_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Label and verdict of the longest rule that fits (null where none does)."""
    label, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # Built from the shortest up, so that the longest is asked first.
    for r in sorted(rules, key=lambda r: len(r.label)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        label = F.when(fits, F.lit(r.label)).otherwise(label)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return label, verdict


def bloom_bits(key: Column) -> Column:
    """The word with the key's bits set, taken from six bits each of a second hash."""
    h = F.xxhash64(key, F.lit(1))
    word = F.lit(0).cast("long")
    for i in range(BITS):
        at = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        word = word.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), at))
    return word


def bloom_block(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_blocks))


def bloom_filter(keys: DataFrame, n_blocks: int) -> DataFrame:
    """(block, bits) of the distinct values of column ``key``."""
    return keys.groupBy(bloom_block(F.col("key"), n_blocks).alias("__block")).agg(
        F.bit_or(bloom_bits(F.col("key"))).alias("__bits"))


def in_list(df: DataFrame, key: str, listed: DataFrame, flag: str) -> DataFrame:
    """``df`` with boolean ``flag``: whether column ``key`` is among the values
    of ``listed``'s only column.  Rows that the filter rules out take no part
    in the exact join."""
    keys = listed.select(F.col(listed.columns[0]).alias("key")).filter("key IS NOT NULL").distinct()
    n = max(1, keys.count())  # sizes the filter
    n_blocks = 1 << max(0, (n * BITS_PER_URL - 1).bit_length() - 6)
    blocks = bloom_filter(keys, n_blocks)
    if 16 * n_blocks <= BROADCAST_BYTES:
        blocks = F.broadcast(blocks)
    d = df.withColumn("__block", bloom_block(F.col(key), n_blocks)).join(blocks, "__block", "left")
    want = bloom_bits(F.col(key))
    maybe = F.coalesce(F.col("__bits").bitwiseAND(want) == want, F.lit(False))
    out = d.filter(~maybe).select(*df.columns, F.lit(False).alias(flag))
    exact = keys.select(F.col("key").alias(key), F.lit(True).alias("__found"))
    hits = d.filter(maybe).join(exact, key, "left")
    return out.unionByName(hits.select(*df.columns, F.col("__found").isNotNull().alias(flag)))


def judge(pages: DataFrame, listed: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, listed for every row of ``pages``
    (page_id, url).  ``listed`` has one column of canonical URLs."""
    url = F.col("url")
    d = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("__url"))
    d = in_list(d, "__url", listed, "listed")
    label, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    other = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return d.select("page_id", "host", "path", label.alias("rule"), F.coalesce(verdict, other).alias("verdict"),
                    "listed")


def listed_urls(pages: DataFrame, terms=LISTED_TERMS) -> DataFrame:
    """The query's list: canonical URLs of pages with a listed term as a part of the host's labels."""
    host = host_of(F.col("url"))
    return pages.filter(host.rlike(r"(^|[.-])(" + "|".join(terms) + r")([.-]|$)")).select(
        canonical(F.col("url")).alias("url"))


URL_SQL = """
WITH u AS (
  SELECT page_id, coalesce(url, '') AS url,
         translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path,
         regexp_extract(coalesce(url, ''), '^.*?://[^?#]*[?]([^#]*)', 1, 's') AS query
  FROM pages
), c AS (
  SELECT *, regexp_replace(regexp_replace(host, '^www[.]', ''), ':(80|443)$', '')
            || regexp_replace(path, '([.]html)?/*$', '') || coalesce('?' || nullif(array_to_string(list_sort(
              list_filter(string_split(query, '&'), lambda p: p <> '' AND split_part(p, '=', 1) NOT IN
                ('ref', 'fbclid', 'gclid', 'utm_source', 'utm_medium', 'utm_campaign', 'utm_term', 'utm_content'))),
              '&'), ''), '') AS canonical
  FROM u
), l AS (
  SELECT DISTINCT canonical FROM c WHERE host <> '' AND regexp_matches(host, '(^|[.-])(adult|casino)([.-]|$)')
), r(verdict, rhost, rpath) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
)
SELECT c.page_id, c.host, c.path,
       (SELECT arg_max(rhost || rpath, length(rhost || rpath)) FROM r
        WHERE (c.host = rhost OR ends_with(c.host, '.' || rhost)) AND starts_with(c.path, rpath)) AS rule,
       coalesce((SELECT arg_max(verdict, length(rhost || rpath)) FROM r
                 WHERE (c.host = rhost OR ends_with(c.host, '.' || rhost)) AND starts_with(c.path, rpath)),
                CASE WHEN c.host <> '' AND l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
       c.host <> '' AND l.canonical IS NOT NULL AS listed
FROM c LEFT JOIN l ON c.canonical = l.canonical
"""


@register("op5_url_filter", URL_SQL)
def op5_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, listed_urls(pages))
