"""The operators of this package as named queries over whole tables, with SQL twins where SQL can
express them.  Each query gets its rows through its operator and only derives digests from them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import bpe, chat, conversations, decontaminate, jaccard, language, licenses, lines, quality, secrets, suffixes, urls, whitening
from tidegate.llm.common import hex_sha256

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

BPE_FILE = "byte_bpe_50k.json"
PIECE_FILE = "piece_bpe_32k.model"


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


CONTROL_TEXT = "\\### Assistant: </turn> ok"


@query
def op1_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"),
    )
    read = chat.read_back(chat.format_threads(rows.unionByName(extra)))
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.array_join("loss_texts", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        hex_sha256(F.array_join(turns, "")).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        hex_sha256(learned).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def _escaped_sql(column: str, table: tuple[tuple[str, str], ...]) -> str:
    for plain, written in table:
        column = f"replace({column}, '{plain}', '{written}')"
    return column


ORACLE["op1_chat_formatting"] = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM
  (SELECT conv_id, turn, role, text FROM conversations
   UNION ALL VALUES (-7, 0, 'user', '{CONTROL_TEXT}'), (-7, 1, 'assistant', '{CONTROL_TEXT}')) AS v(conv_id, turn, role, text))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(4 + length({_escaped_sql("role", chat.ROLE_ESCAPES)}) + 2 + length({_escaped_sql("text", chat.ESCAPES)}) + 8) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id"""


@query
def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(BPE_FILE)
    docs = table(spark, folder, "documents").select("doc_id", "text")
    both = bpe.round_trip(docs, path)
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        hex_sha256(F.col("ids")).alias("ids_sha256"),
        hex_sha256(F.col("decoded")).alias("decoded_sha256"),
    )


def _spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


@query
def op3_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(table(spark, folder, "documents").select("doc_id", "text"))
    base = [r.kind for r in secrets.BASE]
    return found.select(
        "doc_id",
        *[_count(kind).alias(f"n_{kind}") for kind in base],
        hex_sha256(_spans_text(F.filter("spans", lambda s: s["kind"].isin(base)))).alias("base_sha256"),
        _spans_text(F.col("spans")).alias("spans"),
    )


def _found_sql(rule: secrets.Rule, order: int) -> str:
    """Matches with their places: the texts between matches and the matches themselves, added up."""
    p = rule.pattern.replace("'", "''")
    part = f"regexp_extract(m[k], '{p}', {rule.group})" if rule.group else "m[k]"
    return f"""SELECT r, doc_id, '{rule.kind}' AS kind, {order} AS ord, length(m[k]) AS len, length({part}) AS part,
        coalesce(list_sum(list_transform(g[1:k], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:k-1], lambda x: length(x))), 0) AS start
      FROM (SELECT r, doc_id, m, g, unnest(range(1, len(m) + 1)) AS k
            FROM (SELECT r, doc_id, regexp_extract_all(t, '{p}') AS m, regexp_split_to_array(t, '{p}') AS g FROM d WHERE regexp_matches(t, '{p}')))
      WHERE length({part}) >= {rule.least}"""


ORACLE["op3_secret_scan"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
f AS ({" UNION ALL ".join(_found_sql(rule, k) for k, rule in enumerate(secrets.RULES))}),
s AS (SELECT r, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS k, count(*) FILTER (kind = 'hex') AS h,
        string_agg(concat(kind, ':', CAST(start AS BIGINT), ':', CAST(start + len AS BIGINT)), ',' ORDER BY start, ord) FILTER (ord < {len(secrets.BASE)}) AS base,
        string_agg(concat(kind, ':', CAST(start AS BIGINT), ':', CAST(start + len AS BIGINT)), ',' ORDER BY start, ord) AS spans
      FROM f GROUP BY r)
SELECT d.doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(h, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN s USING (r)"""


@query
def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.decontaminate(docs, table(spark, folder, "benchmark").select("item_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        hex_sha256(F.array_join("items", ",")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE["op4_decontamination"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, n, w[k:k+n-1] AS win FROM (SELECT item, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS k
       FROM b WHERE len(w) > 0)),
dw AS (SELECT r, k, n, w[k:k+n-1] AS win FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k
       FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hit AS (SELECT r, k, n, item FROM dw JOIN bw USING (n, win)),
cov AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS p FROM hit) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (r) LEFT JOIN it USING (r)"""


@query
def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.quality(table(spark, folder, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_WORD_SQL = r"[^\x20\x09-\x0D]+"
ORACLE["op6_quality_rules"] = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '{_WORD_SQL}') AS w, string_split(t, chr(10)) AS l FROM d),
g AS (SELECT r, k, w[k:k+2] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS k FROM w WHERE len(w) > 2)),
twice AS (SELECT r, k FROM (SELECT r, k, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT k + o) AS n FROM twice, (VALUES (0), (1), (2)) AS v(o) GROUP BY r),
l AS (SELECT r, k, l[k] AS line, len(regexp_extract_all(l[k], '{_WORD_SQL}')) AS n FROM (SELECT r, l, unnest(range(1, len(l) + 1)) AS k FROM w)),
m AS (SELECT *, len(regexp_extract_all(line, '[!-/:-@\[-`{{-~]')) AS marks,
        regexp_extract_all(line, '{_WORD_SQL}') AS w, row_number() OVER (PARTITION BY r ORDER BY k) AS pos,
        n <= 3 AND NOT regexp_matches(line, '[.!?:;,…。！？；：，、؟۔।]["'')\]}}»”’]*[\x20\x09-\x0D]*$') AS item FROM l WHERE n > 0),
runs AS (SELECT *, pos - row_number() OVER (PARTITION BY r, item ORDER BY k) AS run FROM m),
j AS (SELECT r, n, row_number() OVER (PARTITION BY r, line ORDER BY k) > 1 AS dup,
        (item AND count(*) OVER (PARTITION BY r, item, run) >= 5)
        OR 2 * marks >= strlen(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g'))
        OR n >= 4 AND (len(regexp_extract_all(line, '[#*$%&<>]')) >= n OR 2 * len(regexp_extract_all(line, '!!')) >= n
          OR 5 * len(regexp_extract_all(line, '[|]')) >= n OR seps > 1 AND 5 * seps >= n
          OR regexp_matches(line, '(\.\.\.|…)["'')\]}}»”’]*[\x20\x09-\x0D]*$'))
        OR n >= 40 AND marks = 0 AND NOT regexp_matches(line, '[…。！？；：，、؟۔।]')
        OR regexp_matches(line, '(?i)(all rights reserved|licensed under|released under the|terms of (use|service)|privacy policy|cookie policy|accept (all )?cookies|subscribe to our|sign up for our|click here to|javascript (is|must be) (disabled|enabled))') AS bad
      FROM (SELECT *, len(list_filter(w, lambda x: x IN ('·', '•', '/', '>', '::', '→')))
              + greatest(0, len(list_filter(w, lambda x: x = '»')) - len(list_filter(w, lambda x: x = '«')))
              + greatest(0, len(list_filter(w, lambda x: x = '›')) - len(list_filter(w, lambda x: x = '‹'))) AS seps FROM runs)),
s AS (SELECT r, count(*) FILTER (dup) AS dups, coalesce(sum(n) FILTER (bad), 0) AS lost FROM j GROUP BY r)
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * lost <= 50 * n_words AS kept
FROM (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
        CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, coalesce(dups, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
        len(w) < 50 OR 100 * coalesce(rep.n, 0) > 50 * len(w) AS base_failed, coalesce(lost, 0) AS lost
      FROM w LEFT JOIN rep USING (r) LEFT JOIN s USING (r))"""


def remainder(column: str) -> Column:
    """crc32 of an id's text modulo 4; -1 for a null id, which is learned from."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 4, F.lit(-1))


@query
def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language.fit(docs.filter(remainder("doc_id") != 2), language.read_pieces(public_tokenizers.path(PIECE_FILE)))
    return model.predict(docs.select("doc_id", (remainder("doc_id") == 2).alias("held_out"), "text")).drop("text")


@query
def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    found = jaccard.jaccard_components(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


ORACLE["op9_jaccard_join"] = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '{_WORD_SQL}') AS w FROM documents),
s AS (SELECT DISTINCT r, w[k:k+4] AS g FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
p AS (SELECT x.r AS a, y.r AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.r < y.r GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n na ON na.r = a JOIN n nb ON nb.r = b WHERE 100 * c >= {jaccard.PERCENT} * (na.n + nb.n - c)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach(r, o) AS (SELECT r, r FROM d UNION SELECT reach.r, b FROM reach JOIN both_ways ON reach.o = a)
SELECT x.doc_id, coalesce(n.n, 0) AS n_shingles, min(y.doc_id) AS component_id
FROM reach JOIN d x ON x.r = reach.r JOIN d y ON y.r = reach.o LEFT JOIN n ON n.r = x.r GROUP BY x.r, x.doc_id, n.n"""


@query
def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = lines.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    runs = F.array_join(F.transform("deleted_runs", lambda r: F.concat_ws(":", r["start"], r["end"])), ",")
    return found.select("doc_id", "n_lines", "n_deleted", runs.alias("deleted_runs"), hex_sha256(F.coalesce("kept_text", F.lit(""))).alias("kept_sha256"))


ORACLE["op5_line_dedup"] = rf"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id, text) AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
l AS (SELECT r, l, k, len(regexp_extract_all(l[k], '{_WORD_SQL}')) AS n FROM (SELECT r, l, unnest(range(1, len(l) + 1)) AS k FROM d)),
c AS (SELECT *, sum(n) OVER (PARTITION BY r ORDER BY k) AS c FROM l),
w AS (SELECT x.r, x.k, any_value(x.l)[x.k:min(y.k)] AS w, min(y.k) AS z FROM c x JOIN c y ON x.r = y.r AND y.k >= x.k AND y.c - x.c + x.n >= {lines.MIN_WORDS}
      GROUP BY x.r, x.k),
gone AS (SELECT DISTINCT r, unnest(range(k, z + 1)) AS k FROM (SELECT *, row_number() OVER (PARTITION BY w ORDER BY r, k) AS o FROM w) WHERE o > 1),
m AS (SELECT l.r, l.k, l.l[l.k] AS line, gone.k IS NOT NULL AS gone FROM l LEFT JOIN gone ON l.r = gone.r AND l.k = gone.k),
runs AS (SELECT r, string_agg(concat(CAST(s AS BIGINT), ':', CAST(e AS BIGINT)), ',' ORDER BY s) AS runs FROM
  (SELECT r, min(k) - 1 AS s, max(k) AS e FROM (SELECT r, k, k - row_number() OVER (PARTITION BY r ORDER BY k) AS g FROM m WHERE gone) GROUP BY r, g) GROUP BY r),
t AS (SELECT r, count(*) AS n_lines, count(*) FILTER (gone) AS n_deleted, coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT gone), '') AS kept FROM m GROUP BY r)
SELECT doc_id, n_lines, n_deleted, coalesce(runs, '') AS deleted_runs, sha256(kept) AS kept_sha256 FROM t JOIN d USING (r) LEFT JOIN runs USING (r)"""


@query
def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffixes.dedup_bytes(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("removed_spans").cast("long").alias("n_spans"), hex_sha256(F.col("kept")).alias("kept_sha256"))


@query
def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(table(spark, folder, "documents").select("doc_id", "text"), licenses.known_licenses(spark))
    notices = F.transform("notices", lambda n: F.concat_ws(":", n["line"], n["license"]))
    return found.select("doc_id", "digest", F.array_join("licenses", ",").alias("licenses"), F.array_join(notices, ",").alias("notices"))


def _canonical_sql(text: str) -> str:
    words = f"regexp_replace(regexp_replace(lower({text}), '{licenses.COPYRIGHT_LINE}', '', 'g'), '[^\\p{{L}}\\p{{N}}]+', '  ', 'g')"
    words = f"concat(' ', trim({words}), ' ')"
    for one, other in licenses.SPELLINGS:
        words = f"replace({words}, ' {one} ', ' {other} ')"
    return f"trim({words})"


def _known_sql() -> str:
    return ", ".join("('{}', '{}')".format(k, t.replace("'", "''")) for k, t in licenses.KNOWN)


ORACLE["op10_license_scan"] = f"""
WITH known AS (SELECT form, list_sort(list(DISTINCT license)) AS ls FROM
    (SELECT license, {_canonical_sql("text")} AS form FROM (VALUES {_known_sql()}) AS v(license, text)) WHERE form <> '' GROUP BY form),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, {_canonical_sql("t")} AS form FROM d),
l AS (SELECT r, k, {_canonical_sql("line")} AS form FROM (SELECT r, unnest(range(len(l))) AS k, unnest(l) AS line FROM (SELECT r, string_split(t, chr(10)) AS l FROM d))),
n AS (SELECT r, string_agg(concat(k, ':', x), ',' ORDER BY k, x) AS notices FROM (SELECT r, k, unnest(ls) AS x FROM l JOIN known USING (form)) GROUP BY r)
SELECT doc_id, sha256(w.form) AS digest, coalesce(array_to_string(ls, ','), '') AS licenses, coalesce(notices, '') AS notices
FROM w LEFT JOIN known USING (form) LEFT JOIN n USING (r)"""


RULES = [
    urls.Rule(urls.ALLOW, "com"), urls.Rule(urls.BLOCK, "example.com", "/en/"), urls.Rule(urls.ALLOW, "www.example.com", "/en/"),
    urls.Rule(urls.BLOCK, "net", "/es/"), urls.Rule(urls.BLOCK, "net", "/fr/"),
]
#: Stands in for a list of hosts from elsewhere: those of the pages with one of these words in their name.
LISTED_HOSTS = r"(^|[.-])(adult|ads|bets|casino|pills|spam)([.-]|$)"


@query
def op11_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    hosts = pages.select(urls.host_and_path(F.col("url"))[0].alias("host")).filter(F.col("host").rlike(LISTED_HOSTS)).distinct()
    return urls.filter_urls(pages, RULES, hosts).select("page_id", "host", "path", "rule", "verdict")


_HOST_SQL = r"translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE["op11_url_filters"] = rf"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, {_HOST_SQL} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (SELECT *, CASE WHEN ('.' || host) LIKE '%.www.example.com' AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/es/') THEN 'net/es/' WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/') THEN 'com/' END AS rule FROM h)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN regexp_matches(host, '(^|[.-])(adult|ads|bets|casino|pills|spam)([.-]|$)') THEN 'block' ELSE 'allow' END AS verdict FROM r"""


def damaged(rows: DataFrame) -> DataFrame:
    """Rows after damage by the checksum of ``conv_id:turn``; ``there`` is false for dropped ones, which keep their conversation known."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(blank("text"), ".!?", "")).otherwise(blank("text"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1)))
    role = F.when(kind == 4, "user").otherwise(blank("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (kind != 0).alias("there"), copies.alias("copy")).drop("copy")


@query
def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = damaged(table(spark, folder, "conversations"))
    return conversations.repair(rows, F.col("there")).summary


@query
def op13_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(rows)
    found = model.apply(rows).select("vec_id", "n", "deviation", F.posexplode("whitened").alias("k", "whitened"))
    shares = F.element_at(F.array([F.lit(float(e / model.trace)) for e in model.values]).cast("array<double>"), F.col("k") + 1)
    return found.select(
        "vec_id", (F.col("k") + 1).cast("int").alias("component"), "n", "deviation", "whitened",
        shares.alias("explained"), F.lit(model.identity_error).alias("identity_error"),
    )
