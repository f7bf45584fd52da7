"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    chat_windows,
    content_sort,
    dominance_packing,
    jaccard_join,
    lanczos_whitening,
    piece_bpe,
    quality_rules,
    site_style,
    source_divergence,
    suffix_automaton,
    token_store,
    toxicity,
    url_lists,
)
from tidemark.session import scratch_path
from tidemark.workload.registry import Tables

#: Where the public tokenizers lie; a folder with the files named below.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")
BYTE_BPE = f"{TOKENIZERS}/byte_bpe_50k.json"
PIECE_BPE = f"{TOKENIZERS}/piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_quality_rules")
def op1(t: Tables) -> DataFrame:
    return quality_rules.judged(t.documents, keep=["doc_id"])


@query(
    "op9_content_sort",
    r"""
    WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
    SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
    FROM n WINDOW w AS (PARTITION BY norm)
    """,
)
def op9(t: Tables) -> DataFrame:
    return content_sort.grouped(t.documents, keep=["doc_id"])


@query("op2_token_store")
def op2(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "tokens")
    token_store.write(t.documents, path, BYTE_BPE)
    return token_store.documents(t.spark, path)


@query("op6_dominance_packing")
def op6(t: Tables) -> DataFrame:
    return dominance_packing.packed(t.documents, BYTE_BPE)


@query("op5_piece_bpe")
def op5(t: Tables) -> DataFrame:
    return piece_bpe.digests(t.documents, PIECE_BPE)


@query("op4_toxicity")
def op4(t: Tables) -> DataFrame:
    model = toxicity.fit(t.documents, t.labels.filter(~toxicity.held_out()))
    out = toxicity.scored(t.documents, model, keep=["doc_id"])
    return out.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


@query("op8_jaccard_join")
def op8(t: Tables) -> DataFrame:
    return jaccard_join.near_duplicates(t.documents)


@query("op10_site_style")
def op10(t: Tables) -> DataFrame:
    return site_style.main_text(t.pages)


@query("op3_chat_windows")
def op3(t: Tables) -> DataFrame:
    control = "</s>[INST] ok [/INST]"
    extra = t.spark.sql(
        "SELECT * FROM VALUES (-1L, 0L, 'user', :c), (-1L, 1L, 'assistant', :c) AS v(conv_id, turn, role, text)",
        args={"c": control},
    )
    chats = t.conversations.select("conv_id", "turn", "role", "text").union(extra)
    return chat_windows.digests(chat_windows.windows(chats))


def _number(value: Column, modulus: int) -> Column:
    """A number below the modulus that depends on a text only, the same in every engine."""
    return (F.conv(F.substring(F.md5(value), 1, 6), 16, 10).cast("long") % modulus).cast("int")


_DAYS = 720  # pages count as fetched within two years


def _list_entries(pages: DataFrame) -> DataFrame:
    """Dated entries for the domains and addresses of the pages: a third of the domains go on
    a list of spam, malware or adult sites, most of those go off it later and some come back;
    an eighth of the addresses go on a list of takedowns."""
    address = url_lists.normalised(F.col("url"))
    host = url_lists.host_of(address)
    domain = F.regexp_extract(host, r"([^.]+\.[^.]+\.[^.]+)$", 1)
    hosts = pages.select(F.when(domain == "", host).otherwise(domain).alias("pattern")).distinct()
    hosts = hosts.filter((F.col("pattern") != "") & (_number(F.col("pattern"), 3) == 0))
    kind = F.element_at(F.array(*map(F.lit, ("adult", "malware", "spam"))), _number(F.concat("pattern", F.lit("k")), 3) + 1)
    on, off = _number(F.concat("pattern", F.lit("a")), 300), _number(F.concat("pattern", F.lit("b")), 300) + 1
    back = _number(F.concat("pattern", F.lit("c")), 200) + 1
    first = hosts.select(kind.alias("list"), "pattern", on.alias("day"), F.lit(True).alias("listed"))
    gone = hosts.filter(_number(F.concat("pattern", F.lit("d")), 4) > 0)
    second = gone.select(kind.alias("list"), "pattern", (on + off).alias("day"), F.lit(False).alias("listed"))
    third = gone.filter(_number(F.concat("pattern", F.lit("e")), 3) == 0).select(
        kind.alias("list"), "pattern", (on + off + back).alias("day"), F.lit(True).alias("listed")
    )
    taken = pages.select(address.alias("pattern")).distinct().filter(_number(F.col("pattern"), 8) == 0)
    taken = taken.select(
        F.lit("takedown").alias("list"),
        "pattern",
        _number(F.concat("pattern", F.lit("t")), _DAYS).alias("day"),
        F.lit(True).alias("listed"),
    )
    entries = first.union(second).union(third).union(taken)
    return entries.select("list", "pattern", F.date_add(F.lit("2022-01-01").cast("date"), F.col("day")).alias("at"), "listed")


@query(
    "op7_url_lists",
    r"""
    WITH base AS (
      SELECT page_id, url, DATE '2022-01-01' + CAST(page_id % 720 AS INT) AS fetched,
             regexp_replace(trim(url), '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?', '') AS bare
      FROM pages),
    split AS (
      SELECT page_id, url, fetched,
             regexp_replace(lower(regexp_extract(bare, '^([^/:?#]*)', 1)), '^www\.|\.$', '', 'g') AS host,
             regexp_replace(regexp_extract(bare, '^[^/:?#]*(?::[0-9]*)?([^#]*)', 1), '/+$', '') AS rest
      FROM base),
    caps AS (
      SELECT page_id, url, fetched, host, host || rest AS address,
             CASE WHEN regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1) = '' THEN host
                  ELSE regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1) END AS domain
      FROM split),
    hosts AS (
      SELECT DISTINCT domain AS pattern FROM caps
      WHERE domain <> '' AND CAST('0x' || substr(md5(domain), 1, 6) AS BIGINT) % 3 = 0),
    dated AS (
      SELECT pattern,
             (['adult', 'malware', 'spam'])[CAST('0x' || substr(md5(pattern || 'k'), 1, 6) AS BIGINT) % 3 + 1] AS list,
             CAST('0x' || substr(md5(pattern || 'a'), 1, 6) AS BIGINT) % 300 AS d1,
             CAST('0x' || substr(md5(pattern || 'b'), 1, 6) AS BIGINT) % 300 + 1 AS d2,
             CAST('0x' || substr(md5(pattern || 'c'), 1, 6) AS BIGINT) % 200 + 1 AS d3,
             CAST('0x' || substr(md5(pattern || 'd'), 1, 6) AS BIGINT) % 4 > 0 AS gone,
             CAST('0x' || substr(md5(pattern || 'e'), 1, 6) AS BIGINT) % 3 = 0 AS back
      FROM hosts),
    spans AS (
      SELECT list, pattern, d1 AS since, CASE WHEN gone THEN d1 + d2 END AS until FROM dated
      UNION ALL SELECT list, pattern, d1 + d2 + d3, NULL FROM dated WHERE gone AND back
      UNION ALL
      SELECT 'takedown', address, CAST('0x' || substr(md5(address || 't'), 1, 6) AS BIGINT) % 720, NULL
      FROM (SELECT DISTINCT address FROM caps)
      WHERE CAST('0x' || substr(md5(address), 1, 6) AS BIGINT) % 8 = 0),
    hits AS (
      SELECT c.page_id, s.list, arg_max(s.pattern, length(s.pattern)) AS pattern
      FROM caps c JOIN spans s
        ON (c.address = s.pattern OR c.host = s.pattern OR ends_with(c.host, '.' || s.pattern))
       AND c.fetched >= DATE '2022-01-01' + CAST(s.since AS INT)
       AND (s.until IS NULL OR c.fetched < DATE '2022-01-01' + CAST(s.until AS INT))
      GROUP BY c.page_id, s.list)
    SELECT c.page_id, c.url, c.fetched, coalesce(h.lists, '') AS lists, coalesce(h.matched, '') AS matched,
           h.lists IS NOT NULL AS listed
    FROM caps c LEFT JOIN (
      SELECT page_id, string_agg(list, ',' ORDER BY list) AS lists, string_agg(pattern, ',' ORDER BY list) AS matched
      FROM hits GROUP BY page_id) h USING (page_id)
    """,
)
def op7(t: Tables) -> DataFrame:
    fetched = F.date_add(F.lit("2022-01-01").cast("date"), (F.col("page_id") % _DAYS).cast("int"))
    captures = t.pages.select("page_id", "url", fetched.alias("fetched"))
    return url_lists.judged(captures, _list_entries(t.pages))


_ITEM_WORDS = (
    "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)


@query(
    "op11_suffix_automaton",
    f"""
    WITH d AS (SELECT doc_id, {_ITEM_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
    b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ITEM_WORDS.format('text')} AS ws FROM benchmark),
    sized AS (SELECT *, least(10, len(ws)) AS k FROM b WHERE len(ws) > 0),
    grams AS (SELECT DISTINCT item, k, array_to_string(ws[i : i + k - 1], ' ') AS gram
              FROM (SELECT *, unnest(range(1, len(ws) - k + 2)) AS i FROM sized)),
    places AS (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
               FROM d, (SELECT DISTINCT k FROM grams)),
    hits AS (SELECT doc_id, k, i, item FROM (SELECT *, array_to_string(ws[i : i + k - 1], ' ') AS gram FROM places)
             JOIN grams USING (k, gram)),
    marked AS (SELECT doc_id, count(DISTINCT p) AS n_hit
               FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
    listed AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
               FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
    SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
    FROM d LEFT JOIN marked USING (doc_id) LEFT JOIN listed USING (doc_id)
    """,
)
def op11(t: Tables) -> DataFrame:
    return suffix_automaton.digests(t.spread("documents"), t.benchmark)


@query(
    "op12_source_divergence",
    r"""
    WITH d AS (
      SELECT row_number() OVER () AS no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws
      FROM documents),
    found AS (SELECT no, lang, source, term, count(*) AS n
              FROM (SELECT no, lang, source, unnest(ws) AS term FROM d) GROUP BY ALL),
    kept AS (SELECT lang, term, CAST(sum(n) AS BIGINT) AS c FROM found GROUP BY ALL HAVING count(*) >= 10),
    groups AS (SELECT DISTINCT lang, source FROM d),
    counts AS (SELECT lang, source, term, CAST(sum(n) AS BIGINT) AS c
               FROM found SEMI JOIN kept USING (lang, term) GROUP BY ALL),
    v AS (SELECT lang, count(*) AS v, CAST(sum(c) AS BIGINT) AS n FROM kept GROUP BY lang),
    totals AS (SELECT lang, source, coalesce(CAST(sum(c) AS BIGINT), 0) AS n
               FROM groups LEFT JOIN counts USING (lang, source) GROUP BY ALL),
    p AS (SELECT g.lang, g.source, k.term, coalesce(x.c, 0) AS c,
                 1 + (1000000000 * (coalesce(x.c, 0) + 2)) // (g.n + 2 * v.v) AS p,
                 1 + (1000000000 * (k.c + 2)) // (v.n + 2 * v.v) AS q
          FROM totals g JOIN v USING (lang) JOIN kept k USING (lang) LEFT JOIN counts x
            ON x.lang = g.lang AND x.source = g.source AND x.term = k.term),
    pairs AS (SELECT a.lang, a.source, b.source AS item, CAST(sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS BIGINT) AS value
              FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    parts AS (
      SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(value, 0) AS value
      FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
      LEFT JOIN pairs x ON x.lang = g.lang AND x.source = g.source AND x.item = h.source
      UNION ALL
      SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM p WHERE c > 0 AND p > q)
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts
    QUALIFY part = 'pair' OR rank <= 10
    """,
)
def op12(t: Tables) -> DataFrame:
    return source_divergence.audited(t.spread("documents"))


@query("op13_lanczos_whitening")
def op13(t: Tables) -> DataFrame:
    return lanczos_whitening.component_rows(t.embeddings)
