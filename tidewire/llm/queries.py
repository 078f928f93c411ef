"""The queries of this subpackage, with production parameters over the whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm import alignment, bpe, fingerprints, infill, mixing, pii, quality, sharding, suffixarrays, suffixes, urls, weighted, wordpiece
from tidewire.llm.tables import table
from tidewire.session import scratch_dir


WORD_PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


# Target weights of the mix. The tables name no domains, so a rule on the source's last character stands in for one.
MIX = {
    "domain": {"web": 5, "forum": 3, "reference": 2},
    "lang": {"en": 4, "de": 2, "fr": 2, "es": 2},
    "source": {"src0": 2},
}
DOMAINS = ("web", "forum", "reference")


def domain_of(source: str = "source"):
    last = F.ascii(F.right(F.concat(F.lit("0"), F.coalesce(F.col(source), F.lit(""))), F.lit(1)))
    return F.when(last % 3 == 0, DOMAINS[0]).when(last % 3 == 1, DOMAINS[1]).otherwise(DOMAINS[2])


def op1_budget_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.mix_documents(docs, MIX, domain=domain_of())
    return mixed.select(F.col("item").try_cast("bigint").alias("doc_id"), *mixing.LEVELS, "n_tokens", "copies")


def op2_longest_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece.count_tokens(table(spark, sf_dir, "documents"), wordpiece.vocabulary(WORD_PIECES))


def op3_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))[0]


def op4_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted.near_duplicates(table(spark, sf_dir, "documents"))[0].select("doc_id", "class_id", "n_in_class")


def op5_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed, _ = sharding.shard_documents(table(spark, sf_dir, "documents"), map_path=scratch_dir(spark, "slot-map"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "vslot",
    )


def token_digests(docs: DataFrame) -> DataFrame:
    """Ids and decoded bytes of every text, reduced to digests beside the other columns."""
    tokenizer = bpe.Tokenizer(docs.sparkSession, BYTE_RANKS, public_tokenizers.PATTERN)
    decoded = tokenizer.round_trip(docs)
    return decoded.select(
        *[c for c in docs.columns if c != "text"],
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op6_rank_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pii.pseudonymize_documents(table(spark, sf_dir, "documents").withColumn("_before", F.col("text")))
    return docs.select("doc_id", "text", (~F.col("text").eqNullSafe(F.col("_before"))).alias("changed"))


def op8_redirect_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_pages(table(spark, sf_dir, "pages"))


def op9_prefix_subtrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"), F.size("spans").alias("n_spans")
    )


def op10_quartile_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op11_lyndon_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = suffixarrays.remove_repeats(table(spark, sf_dir, "documents"), shape=lambda kept: F.sha2(kept, 256))
    return cleaned.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.col("kept").alias("kept_sha256"))


def op12_displacement_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.infill_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )


def op13_distinct_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokenizers(table(spark, sf_dir, "documents"), BYTE_LEVEL, WORD_PIECES)


QUERIES = {
    f.__name__: f
    for f in (
        op1_budget_tree, op2_longest_match, op3_decision_list, op4_weighted_sampling, op5_virtual_slots, op6_rank_queue, op7_pseudonyms,
        op8_redirect_classes, op9_prefix_subtrees, op10_quartile_digest, op11_lyndon_grouping, op12_displacement_scatter, op13_distinct_alignment,
    )
}


def _case(level: str) -> str:
    return f"CASE {level} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in MIX[level].items()) + " ELSE 1 END"


def _fill_sql(name: str, nodes: str, parent: str) -> str:
    """Closed form of the rounds: children in the order of capacity per weight fill up one after the other."""
    by = f"PARTITION BY {parent} " if parent else ""
    return f"""
{name}_o AS (SELECT *,
    sum(w) OVER ({by}ORDER BY cap::DOUBLE / w, {name} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::HUGEINT AS w_from,
    coalesce(sum(cap) OVER ({by}ORDER BY cap::DOUBLE / w, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS c_before
    FROM ({nodes})),
{name}_s AS (SELECT *, cap::HUGEINT * w_from <= (budget::HUGEINT - c_before) * w AS sat FROM {name}_o),
{name}_r AS (SELECT *, budget::HUGEINT - coalesce(sum(cap) FILTER (sat) OVER ({by.strip()}), 0)::HUGEINT AS rem,
    sum(w) FILTER (NOT sat) OVER ({by.strip()})::HUGEINT AS open FROM {name}_s),
{name}_a AS (SELECT * EXCLUDE (budget), CASE WHEN sat THEN cap::HUGEINT ELSE (rem * w) // open END AS alloc FROM {name}_r)"""


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

# Every pair of texts that share a shingle, and the classes of the links among them.
_NEAR_SQL = f"""
WITH RECURSIVE texts AS (SELECT coalesce(text, '') AS text, min(doc_id) AS rep, count(*) AS copies FROM documents GROUP BY 1),
worded AS (SELECT rep, copies, {_WORDS} AS ws FROM texts),
pieces AS (SELECT rep, copies, unnest(CASE WHEN len(ws) >= 5
    THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ') || ' '] ELSE [] END) AS k FROM worded),
counted AS (SELECT rep, copies, k, count(*) AS n FROM pieces GROUP BY ALL),
idf AS (SELECT k, ln(1 + 1 / greatest(sum(copies) / (SELECT count(*) FROM documents), 0.2)) AS v FROM counted GROUP BY k),
weighed AS (SELECT rep, k, n * v AS x FROM counted JOIN idf USING (k)),
total AS (SELECT rep, sum(x) AS s FROM weighed GROUP BY rep),
shared AS (SELECT a.rep AS a, b.rep AS b, sum(least(a.x, b.x)) AS m FROM weighed a JOIN weighed b ON a.k = b.k AND a.rep < b.rep GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN total x ON x.rep = a JOIN total y ON y.rep = b WHERE m / (x.s + y.s - m) >= 0.8 - 1e-9),
ends AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT rep AS node, rep AS root FROM texts UNION SELECT e.b, r.root FROM reach r JOIN ends e ON e.a = r.node),
classes AS (SELECT node, min(root) AS class_id FROM reach GROUP BY node),
sized AS (SELECT class_id, CAST(sum(copies) AS BIGINT) AS n_in_class FROM classes JOIN texts ON rep = node GROUP BY class_id)
SELECT doc_id, class_id, n_in_class FROM documents d JOIN texts t ON t.text = coalesce(d.text, '')
JOIN classes ON node = rep JOIN sized USING (class_id)"""

_REPEATS_SQL = f"""
WITH worded AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
windows AS (SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS k FROM worded, unnest(range(1, len(ws) - 18)) AS r(i)),
later AS (SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM later, range(20) AS r(j)),
placed AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM worded),
marked AS (SELECT doc_id, p, word, gone.p IS NOT NULL AS g FROM placed LEFT JOIN gone USING (doc_id, p)),
runs AS (SELECT *, g AND NOT coalesce(lag(g) OVER (PARTITION BY doc_id ORDER BY p), false) AS opens FROM marked)
SELECT w.doc_id, count(p) AS n_words, count(*) FILTER (g) AS n_removed,
    sha256(coalesce(string_agg(word, ' ' ORDER BY p) FILTER (NOT g), '')) AS kept_sha256,
    CAST(count(*) FILTER (opens) AS INTEGER) AS n_spans
FROM worded w LEFT JOIN runs r ON r.doc_id = w.doc_id GROUP BY w.doc_id"""


_INFILL_SQL = """
WITH cut AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d FROM documents),
drawn AS (SELECT doc_id, t, u, len(u) AS n, list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(d, i, 8) AS BIGINT)) AS h FROM cut),
placed AS (SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS lo, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS hi,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
    WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (SELECT *, array_to_string(u[1:lo], '') AS p, array_to_string(u[lo + 1:hi], '') AS m, array_to_string(u[hi + 1:n], '') AS s FROM placed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256 FROM parts"""

# Texts as hexadecimal digits; their windows are cut out of pieces, as a place far into a string is slow to reach.
_PASSAGES_SQL = """
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
parts AS (SELECT doc_id, length(x) // 2 AS n, o, substr(x, 2 * o + 1, 2 * 1073) AS c FROM b, unnest(range(0, greatest(length(x) // 2, 1), 1024)) AS r(o)),
w AS (SELECT doc_id, o + i AS p, substr(c, 2 * i + 1, 100) AS k FROM parts, unnest(range(0, least(1024, n - 49 - o))) AS r(i)),
firsts AS (SELECT md5(k) AS k, min(doc_id) AS d FROM w GROUP BY 1 HAVING count(DISTINCT doc_id) > 1),
late AS (SELECT doc_id, p FROM w JOIN firsts ON firsts.k = md5(w.k) WHERE d < doc_id),
gone AS (SELECT DISTINCT doc_id, p + j AS p FROM late, unnest(range(50)) AS r(j)),
runs AS (SELECT doc_id, min(p) AS a, max(p) + 1 AS e FROM (SELECT doc_id, p, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS g FROM gone) GROUP BY doc_id, g),
cuts AS (SELECT doc_id, list(a ORDER BY a) AS s, list(e ORDER BY a) AS t, sum(e - a)::BIGINT AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id)
SELECT doc_id, length(x) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN n_spans > 0 THEN array_to_string(list_transform(range(0, n_spans + 1), lambda i:
    substr(x, (CASE WHEN i = 0 THEN 0 ELSE t[i] END) * 2 + 1, ((CASE WHEN i = n_spans THEN length(x) // 2 ELSE s[i + 1] END) - (CASE WHEN i = 0 THEN 0 ELSE t[i] END)) * 2)), '') ELSE x END)) AS kept_sha256
FROM b LEFT JOIN cuts USING (doc_id)"""


def _rules_sql() -> str:
    rows = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in urls.RULES)
    return f"(VALUES {rows}) AS r(rule_host, rule_path, says)"


_HOST = "translate(regexp_extract({0}, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "regexp_extract({0}, '(?s)^.*?://([^/?#]*)([^?#]*)', 2)"


def _judged_sql(source: str) -> str:
    return f"""SELECT u.*, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    max_by(says, length(rule_host || rule_path)) AS says FROM {source} u LEFT JOIN {_rules_sql()}
    ON (u.host = rule_host OR ends_with(u.host, '.' || rule_host)) AND starts_with(u.path, rule_path) GROUP BY ALL"""


_URLS_SQL = f"""
WITH RECURSIVE tags AS (SELECT url, unnest(regexp_extract_all(html, '(?i)<(?:link|meta)[^>]*>')) AS tag FROM pages),
targets AS (SELECT url, CASE
    WHEN regexp_matches(tag, '(?i)^<link.*rel *= *["'']?canonical') THEN regexp_extract(tag, '(?i)href *= *["'']?([^"'' >]+)', 1)
    WHEN regexp_matches(tag, '(?i)^<meta.*http-equiv *= *["'']?refresh') THEN regexp_extract(tag, '(?i)url *= *([^"'' >]+)', 1) END AS t FROM tags),
absolute AS (SELECT url AS a, CASE WHEN contains(t, '://') THEN t WHEN starts_with(t, '//') THEN 'http:' || t
    WHEN starts_with(t, '/') THEN regexp_extract(url, '(?s)^(.*?)://', 1) || '://' || {_HOST.format('url')} || t END AS b FROM targets WHERE t <> ''),
named AS (SELECT url, {_HOST.format('url')} AS host, {_PATH.format('url')} AS path FROM
    (SELECT url FROM pages UNION SELECT b FROM absolute WHERE b IS NOT NULL)),
judged AS (SELECT *, CASE WHEN host <> '' THEN host || regexp_replace(path, '/+$', '') ||
    regexp_extract(url, '(?s)^[^?#]*(\\?[^#]*)', 1) END AS key FROM ({_judged_sql('named')})),
ends AS (SELECT x.key AS a, y.key AS b FROM absolute JOIN judged x ON x.url = a JOIN judged y ON y.url = b),
reach AS (SELECT DISTINCT key AS node FROM judged WHERE says = 'block' AND key IS NOT NULL
    UNION SELECT e.b FROM reach JOIN (SELECT a, b FROM ends UNION ALL SELECT b, a FROM ends) e ON e.a = node)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
    coalesce(says, CASE WHEN key IN (SELECT node FROM reach) THEN 'block' ELSE 'allow' END) AS verdict
FROM pages LEFT JOIN judged USING (url)"""

_DOMAIN = "ascii(right('0' || coalesce(source, ''), 1)) % 3"

ORACLES: dict[str, str] = {
    "op1_budget_tree": f"""
WITH items AS (SELECT coalesce(doc_id::VARCHAR, 't' || md5(coalesce(text, ''))) AS item,
    CASE {_DOMAIN} WHEN 0 THEN 'web' WHEN 1 THEN 'forum' ELSE 'reference' END AS domain, coalesce(lang, 'none') AS lang,
    coalesce(source, 'none') AS source, sum(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')))::BIGINT AS n_tokens
    FROM documents GROUP BY ALL),
leaves AS (SELECT domain, lang, source, sum(n_tokens) AS tokens, 4 * sum(n_tokens) AS cap FROM items GROUP BY ALL),
total AS (SELECT sum(tokens) AS budget FROM leaves),
{_fill_sql("domain", f"SELECT domain, sum(cap) AS cap, {_case('domain')} AS w, any_value(budget) AS budget FROM leaves, total GROUP BY domain", "")},
{_fill_sql("lang", f"SELECT l.domain, l.lang, sum(l.cap) AS cap, {_case('lang')} AS w, any_value(a.alloc) AS budget FROM leaves l JOIN domain_a a USING (domain) GROUP BY domain, lang", "domain")},
{_fill_sql("source", f"SELECT l.domain, l.lang, l.source, l.cap, l.tokens, {_case('source')} AS w, a.alloc AS budget FROM leaves l JOIN lang_a a USING (domain, lang)", "domain, lang")},
ranked AS (SELECT i.*, s.alloc // greatest(s.tokens, 1) AS whole, s.alloc % greatest(s.tokens, 1) AS rest
    FROM items i JOIN source_a s USING (domain, lang, source)),
summed AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source
    ORDER BY md5('1:' || whole::VARCHAR || ':' || item), item ROWS UNBOUNDED PRECEDING) AS upto FROM ranked)
SELECT TRY_CAST(item AS BIGINT) AS doc_id, domain, lang, source, n_tokens,
    (whole + CASE WHEN upto <= rest AND rest >= 0 THEN 1 ELSE 0 END)::BIGINT AS copies FROM summed""",
    "op4_weighted_sampling": _NEAR_SQL,
    "op8_redirect_classes": _URLS_SQL,
    "op9_prefix_subtrees": _REPEATS_SQL,
    "op11_lyndon_grouping": _PASSAGES_SQL,
    "op12_displacement_scatter": _INFILL_SQL,
}
