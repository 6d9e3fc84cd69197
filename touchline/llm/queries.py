"""One query per operator over the driver's tables, and SQL to check them by."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from touchline.llm.common import scratch_dir, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_token_output")
def token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    from touchline.llm.token_output import digests, read_token_ids, write_token_ids

    path = scratch_dir(spark, "token-ids")
    write_token_ids(table(spark, sf_dir, "documents"), path, vocabulary("byte_bpe_50k.json"))
    return digests(read_token_ids(spark, path))


OP2_SQL = r"""
WITH raw AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM documents),
items AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT cast(item_id AS VARCHAR) AS item, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS win
  FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) t(i) WHERE len(w) > 0),
lengths AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM raw, unnest(range(1, len(w) + 1)) t(i), lengths WHERE i + n - 1 <= len(w)),
hits AS (SELECT g.doc_id, g.i, g.n, w.item FROM grams g JOIN windows w USING (win, n)),
hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY 1),
hit_items AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hits GROUP BY 1)
SELECT r.doc_id, cast(len(r.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM raw r LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


@query("op2_decontamination", OP2_SQL)
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from touchline.llm.decontamination import decontaminate

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    ids = F.sha2(F.array_join("item_ids", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", ids.alias("items_sha256"), "contaminated")


@query("op7_packing")
def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from touchline.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query("op6_simhash")
def simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from touchline.llm.simhash import hex_digits, near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex_digits(F.col("fp0")).alias("fingerprint"), "component_id")


OP4_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
    list_filter(string_split(regexp_extract(coalesce(url, ''), '(?s)^.*?://[^?#]*\?([^#]*)', 1), '&'),
      lambda x: x <> '' AND NOT regexp_matches(x, '^(?:utm_[^=]*|ref|gclid|fbclid)(?:=|$)')) AS query
  FROM pages),
n AS (
  SELECT *, CASE WHEN host <> '' THEN
    regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^(www|m)\.([^.]+\.)', '\2') || regexp_replace(path, '/+$', '')
    || CASE WHEN len(query) > 0 THEN '?' || array_to_string(query, '&') ELSE '' END END AS address
  FROM p),
rules(verdict, h, q) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
own AS (
  SELECT page_id, arg_max(h || q, length(h || q)) AS rule, arg_max(r.verdict, length(h || q)) AS verdict
  FROM n JOIN rules r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q) GROUP BY page_id),
classes AS (
  SELECT address FROM n LEFT JOIN own USING (page_id) WHERE address IS NOT NULL
  GROUP BY 1 HAVING bool_or(verdict = 'block') AND NOT bool_or(verdict = 'allow'))
SELECT page_id, host, path, rule,
  coalesce(verdict, CASE WHEN address IN (SELECT address FROM classes) THEN 'block' ELSE 'allow' END) AS verdict
FROM n LEFT JOIN own USING (page_id)
"""


@query("op4_url_filter", OP4_SQL)
def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from touchline.llm.url_filter import Rule, judge_urls

    rules = [
        Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
        Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"),
    ]
    found = judge_urls(table(spark, sf_dir, "pages"), rules)
    return found.select("page_id", "host", "path", "rule", "verdict")


@query("op5_sharding")
def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from touchline.llm.sharding import shard

    found = shard(table(spark, sf_dir, "documents").select("doc_id", "text"))
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return found.select(
        "doc_id", "size", crc.alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


OP10_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
k(kind, ord, pat, context) AS (VALUES
  ('email', 1, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+', NULL),
  ('ip', 2, '[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+', NULL),
  ('card', 3, '[0-9](?:[ -]?[0-9])+', NULL),
  ('phone', 4, '\+[0-9][ ().0-9-]+[0-9]', NULL),
  ('iban', 5, '\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}\b', NULL),
  ('ssn', 6, '\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b', '\bssn\b|social security')),
m AS (SELECT doc_id, t, k.*, regexp_extract_all(t, pat) AS ms, string_split_regex(t, pat) AS gs FROM d, k),
s AS (SELECT doc_id, t, kind, ord, context, ms[i] AS v, regexp_replace(ms[i], '[ -]', '', 'g') AS p,
    cast(list_sum(list_transform(gs[1:i], lambda x: length(x)))
      + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS a
  FROM m, unnest(range(1, len(ms) + 1)) u(i)),
ok AS (SELECT doc_id, kind, ord, a, a + length(v) AS b FROM s WHERE CASE kind
  WHEN 'email' THEN true
  WHEN 'ip' THEN list_max(list_transform(string_split(v, '.'), lambda x: coalesce(try_cast(x AS HUGEINT), 999))) <= 255
  WHEN 'card' THEN length(p) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, length(p) + 1),
    lambda i: CASE WHEN (length(p) - i) % 2 = 0 THEN cast(p[i] AS INTEGER)
      ELSE cast(p[i] AS INTEGER) * 2 - CASE WHEN cast(p[i] AS INTEGER) > 4 THEN 9 ELSE 0 END END)) % 10 = 0
  WHEN 'phone' THEN length(regexp_replace(v, '[^0-9]', '', 'g')) BETWEEN 9 AND 15
  WHEN 'iban' THEN length(p) BETWEEN 15 AND 34 AND list_reduce(list_prepend(0::BIGINT,
      list_transform(range(1, length(p) + 1), lambda i: CASE WHEN ascii((p[5:] || p[:4])[i]) < 58
        THEN ascii((p[5:] || p[:4])[i]) - 48 ELSE ascii((p[5:] || p[:4])[i]) - 55 END::BIGINT)),
    lambda acc, x: CASE WHEN x < 10 THEN (acc * 10 + x) % 97 ELSE (acc * 100 + x) % 97 END) = 1
  ELSE NOT regexp_matches(v, '^(?:000|666|9)|-00-|-0000$')
    AND regexp_matches(lower(substr(t, greatest(a - 40, 0) + 1, a + length(v) - greatest(a - 40, 0) + 40)), context) END),
l AS (SELECT doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
    count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
    string_agg(kind || ':' || a || ':' || b, ',' ORDER BY ord, a) FILTER (ord <= 4) AS base,
    string_agg(kind || ':' || a || ':' || b, ',' ORDER BY ord, a) AS spans FROM ok GROUP BY doc_id)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
  coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN l USING (doc_id)
"""


@query("op10_pii", OP10_SQL)
def pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from touchline.llm.pii import KINDS, count_of, find_personal_data, listed

    found = find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = [k.name for k in KINDS if k.base]
    spans = F.filter("pii", lambda s: s["kind"].isin(base))
    return found.select(
        "doc_id",
        *[count_of(F.col("pii"), k).alias(f"n_{k}") for k in base],
        F.sha2(listed(spans).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("pii")).alias("spans"),
    )


@query("op9_quality")
def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from touchline.llm.quality import classify

    found = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


@query("op8_fingerprints")
def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from touchline.llm.digest import compare_with_edits

    return compare_with_edits(table(spark, sf_dir, "documents"))


@query("op3_repeats")
def repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from touchline.llm.repeats import remove_repeats

    found = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op11_spelling")
def spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from touchline.llm.spelling import variants

    return variants(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM t),
l AS (SELECT doc_id, max(coalesce(quality, 0) = 1) AS good, max(coalesce(toxic, 0) = 1) AS toxic FROM labels GROUP BY 1),
d AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN len(w) < 50 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS failing
  FROM w LEFT JOIN l USING (doc_id)),
c AS (SELECT part, failing, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM d GROUP BY 1, 2),
f(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
  WHERE a.x NOT IN (b.x, c.x, d.x, e.x) AND b.x NOT IN (c.x, d.x, e.x) AND c.x NOT IN (d.x, e.x) AND d.x <> e.x),
s AS (SELECT filter_order, step, filter_order[step] AS letter, filter_order[1:step - 1] AS before FROM o, unnest(range(1, 6)) u(step)),
g AS (
  SELECT part, filter_order, step, letter, n, good, toxic, failing = letter AS only_here, contains(failing, letter) AS fails,
    regexp_matches(failing, '[' || before || '0]') AS gone
  FROM c, s),
r AS (
  SELECT part, filter_order, step, letter, coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0) AS kept,
    coalesce(sum(n) FILTER (NOT gone AND fails), 0) AS removed, coalesce(sum(n) FILTER (gone AND fails), 0) AS redundant,
    coalesce(sum(n) FILTER (only_here), 0) AS unique_fails, coalesce(sum(good) FILTER (NOT gone AND fails), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (NOT gone AND fails), 0) AS toxic_lost
  FROM g GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, cast(step AS INTEGER) AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
  redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
  toxic_lost::BIGINT AS toxic_lost, cast(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM r
"""


@query("op12_filter_audit", OP12_SQL)
def filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from touchline.llm.audit import audit

    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP13_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
k(kind, ord, pat) AS (VALUES
  ('assign', 1, '(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+'),
  ('access', 2, 'AKIA[A-Z0-9]+'), ('hex', 3, '[0-9a-f]+'),
  ('github', 4, 'gh[pousr]_[A-Za-z0-9]{36,}'), ('slack', 5, 'xox[abprs]-[A-Za-z0-9-]{10,}'),
  ('webtoken', 6, 'eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}'),
  ('private_key', 7, '-----BEGIN (?:[A-Z]{2,10} )?PRIVATE KEY-----')),
m AS (SELECT doc_id, k.*, regexp_extract_all(t, pat) AS ms, string_split_regex(t, pat) AS gs FROM d, k WHERE regexp_matches(t, pat)),
e AS (SELECT doc_id, kind, ord, unnest(ms) AS v, unnest(gs[1:len(ms)]) AS g, unnest(range(1, len(ms) + 1)) AS i FROM m),
s AS (SELECT *, sum(length(g) + length(v)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS b FROM e),
ok AS (SELECT doc_id, kind, ord, cast(b - length(v) AS BIGINT) AS a, cast(b AS BIGINT) AS b FROM s WHERE CASE kind
  WHEN 'assign' THEN length(regexp_extract(v, '^[A-Za-z_]+["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)$', 1)) >= 6
  WHEN 'access' THEN length(v) >= 20 WHEN 'hex' THEN length(v) >= 24 ELSE true END),
l AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, ord) FILTER (ord <= 3) AS base,
    string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, ord) AS spans FROM ok GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN l USING (doc_id)
"""


@query("op13_secrets", OP13_SQL)
def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from touchline.llm.ledger import RULES, Ledger, listed

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = Ledger(spark, scratch_dir(spark, "secret-ledger"))
    ledger.scan(docs)
    base = [r.name for r in RULES if r.base]
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return ledger.findings(docs).select(
        "doc_id", *[of(k).alias(f"n_{k}") for k in base],
        F.sha2(listed(F.filter("spans", lambda s: s["kind"].isin(base))).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
