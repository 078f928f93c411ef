"""DuckDB statements that give the same results as the catalogue's queries.

They are put together from a few named pieces (articles, sentiment, features,
aggregates, ...) so that each statement still reads as plain SQL.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from tidewire.functions import lexicons as lx
from tidewire.functions.text import SPACE_CLASS as SPACE
from tidewire.plans.catalog import (
    CONFLICT_HITS, CONFLICT_WORDS, HUB, MATCH_AT, NEGATIVE, PATH_FROM, PATH_TO, POSITIVE, RUN_TS,
    TRIGGERS, WATCHED, ZONES,
)

BODY = "coalesce(title, '') || ' ' || coalesce(content, '')"
LOW = f"lower({BODY})"
# Letters beyond ASCII become '_', which RE2 counts as a word character too:
# word boundaries then fall where they do with Unicode-aware matching.
PLAIN = (
    r"regexp_replace({0}, '[^\x00-\x7F\x{{80}}-\x{{A9}}\x{{AB}}-\x{{B4}}\x{{B6}}-\x{{B9}}\x{{BB}}-\x{{BF}}"
    r"\x{{D7}}\x{{F7}}\x{{1680}}\x{{2000}}-\x{{206F}}\x{{3000}}]', '_', 'g')"
)


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def items(values: Iterable[str]) -> str:
    return "[" + ", ".join(lit(v) for v in values) + "]"


def joined(expr: str) -> str:
    return f"coalesce(array_to_string({expr}, '|'), '')"


def present(pairs: Iterable[tuple[str, str]]) -> str:
    """List of the values whose condition holds, in order."""
    cells = ", ".join(f"CASE WHEN {cond} THEN {value} END" for cond, value in pairs)
    return f"list_filter([{cells}], lambda x: x IS NOT NULL)"


def has(word: str, low: str = "low") -> str:
    return f"contains({low}, {lit(word.lower())})"


def has_any(words: Iterable[str], low: str = "low") -> str:
    return "(" + " OR ".join(has(w, low) for w in words) + ")"


def found(words: Iterable[str], low: str = "low") -> str:
    return present((has(w, low), lit(w)) for w in words)


def labels(lists: Mapping[str, list[str]], low: str = "low") -> str:
    return present((has_any(ws, low), lit(lab)) for lab, ws in lists.items())


def strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def squeeze(expr: str) -> str:
    return f"trim(regexp_replace({expr}, '{SPACE}+', ' ', 'g'), ' ')"


def arrival(key: str) -> str:
    return f"(TIMESTAMP '2024-01-01' + to_seconds(({key} * 7919) % 2592000))"


ISO_T = "'%Y-%m-%dT%H:%M:%S'"

ARTICLES = f"""
dated AS (SELECT *, {arrival('doc_id')} AS ts FROM documents),
articles AS (
  SELECT CAST(doc_id AS VARCHAR) AS event_id, 'documents' AS source, 'news_article' AS event_type,
         ts AS event_ts, split_part(text, chr(10), 1) AS title, text AS content,
         CAST(NULL AS VARCHAR) AS description, '' AS url, source AS source_name, lang AS "language",
         CASE WHEN doc_id % 17 = 9 THEN NULL
              WHEN doc_id % 13 = 7 THEN 'n/a'
              WHEN doc_id % 11 = 5 THEN strftime(ts, '%a, %d %b %Y %H:%M:%S') || ' +0000'
              WHEN doc_id % 7 = 3 THEN strftime(ts + INTERVAL '5 hours 30 minutes', {ISO_T}) || '+05:30'
              ELSE strftime(ts, {ISO_T}) || 'Z' END AS published,
         md5(split_part(text, chr(10), 1)) AS dedup_key
  FROM dated),
firsts AS (
  SELECT * FROM articles
  QUALIFY row_number() OVER (PARTITION BY dedup_key ORDER BY event_ts, event_id) = 1)"""

PAGES = f"""
page_articles AS (
  SELECT 'page:' || page_id AS event_id, 'pages' AS source, 'web_page' AS event_type,
         regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, html AS content, url
  FROM pages)"""


def times(source: str) -> str:
    """Publication time parts of ``source``, in the source's own offset."""
    return f"""
isos AS (
  SELECT *, CASE WHEN regexp_matches(published, '^[A-Z][a-z]+, ')
                 THEN strftime(strptime(left(published, 25), '%a, %d %b %Y %H:%M:%S'), {ISO_T}) || '+00:00'
                 ELSE replace(published, 'Z', '+00:00') END AS iso
  FROM {source}),
timed AS (
  SELECT *, try_cast(left(iso, 19) AS TIMESTAMP) AS local_ts, substr(iso, 20) AS off FROM isos)"""


PARSED = f"""CASE WHEN published <> '' THEN
    coalesce(strftime(local_ts, {ISO_T}) || off, '{RUN_TS}+00:00') END AS published_parsed"""


def sentiment(body: str, positive: Iterable[str], negative: Iterable[str]) -> str:
    """Columns score/label/positive_words/negative_words come from p and n."""
    words = f"list_distinct(regexp_split_to_array(lower({body}), '{SPACE}+'))"
    return (
        f"len(list_intersect({words}, {items(positive)})) AS p, "
        f"len(list_intersect({words}, {items(negative)})) AS n"
    )


RAW_SCORE = "(p - n) / CAST(greatest(p + n, 1) AS DOUBLE)"
SCORE = f"round({RAW_SCORE}, 4)"
LABEL = (
    f"CASE WHEN {RAW_SCORE} > 0.1 THEN 'positive' WHEN {RAW_SCORE} < -0.1 THEN 'negative' ELSE 'neutral' END"
)


def orgs(acronyms: list[str], suffixes: list[str]) -> str:
    plain = PLAIN.format(BODY)
    listed = rf"\b(?:{'|'.join(acronyms)})\b"
    suffixed = rf"\b[A-Z][a-z]+(?:{SPACE}[A-Z][a-z]+)*{SPACE}(?:{'|'.join(suffixes)})\b"
    return (
        f"list_sort(list_distinct(regexp_extract_all({plain}, {lit(listed)}) || "
        f"regexp_extract_all({plain}, {lit(suffixed)})))"
    )


PLACES_ALL = (
    f"regexp_extract_all({PLAIN.format(BODY)}, " + lit(rf"\b[A-Z][a-z]+(?:{SPACE}[A-Z][a-z]+)*\b") + ")"
)
# distinct in order of first appearance
PLACES = (
    "list_filter(list_filter(allp, lambda x, i: list_position(allp, x) = i), lambda x: length(x) > 2)"
)

TAGGED = f"""
scored AS (
  SELECT *, {sentiment(BODY, POSITIVE, NEGATIVE)},
         list_sort({found(lx.NER_COUNTRIES, LOW)}) AS countries,
         {orgs(lx.NER_ACRONYMS, lx.NER_SUFFIXES)} AS orgs,
         {PLACES_ALL} AS allp
  FROM articles),
feats AS (
  SELECT event_id, event_ts, dedup_key, source_name, "language", title, source, url, published,
         {SCORE} AS sentiment_score, {LABEL} AS sentiment_label,
         countries, orgs, len(countries) + len(orgs) AS entity_count,
         length(content) AS text_length,
         CASE WHEN len(list_filter(allp, lambda x: length(x) > 2)) > 0 THEN 1 ELSE 0 END AS has_geo
  FROM scored)"""


def aggregate(source: str, keys: str, name: str = "aggs") -> str:
    group = f"GROUP BY {keys}" if keys else ""
    select = f"{keys}," if keys else ""
    return f"""
{name} AS (
  SELECT {select} count(*) AS total_events,
         CAST(sum(CAST(round(sentiment_score * 10000) AS BIGINT)) AS DOUBLE) / 10000.0 / count(*) AS avg_sentiment,
         count(*) FILTER (sentiment_label = 'positive') / CAST(count(*) AS DOUBLE) AS positive_ratio,
         count(*) FILTER (sentiment_label = 'negative') / CAST(count(*) AS DOUBLE) AS negative_ratio,
         sum(entity_count) / CAST(count(*) AS DOUBLE) AS avg_entity_count,
         sum(has_geo) / CAST(count(*) AS DOUBLE) AS geo_ratio
  FROM {source} {group})"""


BY_DAY = "(SELECT *, strftime(event_ts, '%Y-%m-%d') AS day FROM feats)"

TWO = "printf('%.2f', round(avg_sentiment, 2))"


def signal(kind: str, severity: str, direction: str, confidence: str, reason: str) -> str:
    return (
        f"{{'type': {lit(kind)}, 'severity': {lit(severity)}, 'direction': {lit(direction)}, "
        f"'confidence': CAST({confidence} AS DOUBLE), 'reason': {reason}}}"
    )


RULES = f"""list_filter([
  CASE WHEN avg_sentiment <= -0.5 THEN {signal('market_risk', 'high', 'bearish', 'abs(avg_sentiment)',
        "'Strong negative sentiment (' || " + TWO + " || ')'")}
       WHEN avg_sentiment <= -0.2 THEN {signal('market_risk', 'medium', 'bearish', 'abs(avg_sentiment)',
        "'Negative sentiment (' || " + TWO + " || ')'")} END,
  CASE WHEN avg_sentiment >= 1.0 THEN {signal('market_opportunity', 'high', 'bullish', 'avg_sentiment',
        "'Strong positive sentiment (' || " + TWO + " || ')'")} END,
  CASE WHEN negative_ratio > 0.6 THEN {signal('negative_surge', 'high', 'bearish', 'negative_ratio',
        "'Negative ratio ' || CAST(CAST(round(negative_ratio * 100) AS BIGINT) AS VARCHAR) || '% exceeds threshold'")} END,
  CASE WHEN geo_ratio > 0.5 THEN {signal('geopolitical_activity', 'medium', 'neutral', 'geo_ratio',
        "'High geographic diversity in events'")} END
], lambda s: s IS NOT NULL)"""

DAILY_RULES = f"""list_filter([
  CASE WHEN avg_sentiment < -0.3 THEN {signal('market_risk', 'high', 'bearish', 'abs(avg_sentiment)',
        "'Daily aggregate sentiment ' || " + TWO + " || ' indicates elevated risk'")}
       WHEN avg_sentiment < -0.1 THEN {signal('market_caution', 'medium', 'bearish', 'abs(avg_sentiment)',
        "'Daily aggregate sentiment ' || " + TWO + " || ' suggests caution'")} END,
  CASE WHEN avg_sentiment > 0.3 THEN {signal('market_opportunity', 'medium', 'bullish', 'avg_sentiment',
        "'Daily aggregate sentiment ' || " + TWO + " || ' indicates opportunity'")} END,
  CASE WHEN avg_entity_count > 3 THEN {signal('high_entity_density', 'low', 'neutral',
        'least(avg_entity_count / 10, 1.0)', "'High entity density suggests complex multi-actor event'")} END
], lambda s: s IS NOT NULL)"""


def fired(keys: str, source: str, rules: str, where: str = "") -> str:
    """One row per signal."""
    return f"""
SELECT {keys}, CAST(ord - 1 AS BIGINT) AS ord, s.type AS type, s.severity AS severity,
       s.direction AS direction, round(s.confidence, 6) AS confidence, s.reason AS reason
FROM (SELECT {keys}, unnest(sigs) AS s, unnest(range(1, len(sigs) + 1)) AS ord
      FROM (SELECT {keys}, {rules} AS sigs FROM {source})) {where}"""


def ctes(*parts: str) -> str:
    return "WITH " + ",".join(p.strip().rstrip(",") for p in parts) + "\n"


def recursive(*parts: str) -> str:
    return "WITH RECURSIVE " + ",".join(p.strip().rstrip(",") for p in parts) + "\n"


ENTITY_ID = (
    "CASE kind WHEN 'country' THEN 'country:' ELSE 'org:' END || replace(lower(name), ' ', '_')"
)
MENTIONS = f"""
named AS (
  SELECT event_id, 'country' AS kind, unnest(countries) AS name FROM feats
  UNION ALL SELECT event_id, 'organization', unnest(orgs) FROM feats),
mentions AS (
  SELECT event_id AS source, {ENTITY_ID} AS target, kind, name FROM named)"""
EDGES = """
kg_edges AS (
  SELECT source, target, 'mentions' AS type, 'MENTIONS' AS relation,
         CASE WHEN kind = 'country' THEN CAST(0.8 AS DOUBLE) ELSE CAST(0.7 AS DOUBLE) END AS weight
  FROM mentions
  UNION ALL
  SELECT event_id, 'market:global', 'affects', 'AFFECTS', abs(sentiment_score)
  FROM feats WHERE sentiment_score < -0.3),
merged AS (
  SELECT source, target, r.type AS type, r.relation AS relation, r.weight AS weight FROM (
    SELECT source, target, max({'weight': weight, 'relation': relation, 'type': type}) AS r
    FROM kg_edges GROUP BY source, target)),
node_ids AS (
  SELECT event_id AS id FROM feats UNION SELECT target FROM mentions
  UNION SELECT source FROM merged UNION SELECT target FROM merged)"""

SUPPLY = """
supply AS (
  SELECT 'order:' || l_orderkey AS source, 'supplier:' || l_suppkey AS target,
         'SHIPPED_BY' AS relation, sum(l_quantity) AS weight
  FROM lineitem GROUP BY l_orderkey, l_suppkey
  UNION ALL SELECT 'order:' || o_orderkey, 'customer:' || o_custkey, 'PLACED_BY', 1.0::DOUBLE FROM orders
  UNION ALL SELECT 'supplier:' || s_suppkey, 'nation:' || s_nationkey, 'LOCATED_IN', 1.0::DOUBLE FROM supplier
  UNION ALL SELECT 'customer:' || c_custkey, 'nation:' || c_nationkey, 'LOCATED_IN', 1.0::DOUBLE FROM customer
  UNION ALL SELECT 'nation:' || n_nationkey, 'region:' || n_regionkey, 'LOCATED_IN', 1.0::DOUBLE FROM nation),
supply_nodes AS (
  SELECT 'order:' || o_orderkey AS id, 'order' AS type FROM orders
  UNION ALL SELECT 'customer:' || c_custkey, 'customer' FROM customer
  UNION ALL SELECT 'supplier:' || s_suppkey, 'supplier' FROM supplier
  UNION ALL SELECT 'nation:' || n_nationkey, 'nation' FROM nation
  UNION ALL SELECT 'region:' || r_regionkey, 'region' FROM region)"""


def hits_by_id() -> str:
    """Rows whose id is divisible by 20 against all others."""
    return """
corpus AS (SELECT vec_id, CAST(vec_id AS VARCHAR) AS hit_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE len(embedding) > 0),
pairs AS (
  SELECT q.hit_id AS query_id, c.hit_id,
         round(list_inner_product(q.v, c.v) / sqrt(list_inner_product(q.v, q.v)) / sqrt(list_inner_product(c.v, c.v)), 6) AS score
  FROM corpus q JOIN corpus c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
hits AS (
  SELECT query_id, hit_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, hit_id) AS rank
  FROM pairs QUALIFY rank <= 20)"""


def hits(skip: str = "") -> str:
    return f"""
corpus AS (
  SELECT CAST(vec_id AS VARCHAR) AS hit_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings
  WHERE len(embedding) > 0),
cells AS (
  SELECT label, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS pos FROM corpus),
means AS (SELECT label, pos, avg(x) AS x FROM cells GROUP BY label, pos),
qs AS (
  SELECT 'label:' || label AS query_id, list(x ORDER BY pos) AS q FROM means GROUP BY label),
pairs AS (
  SELECT query_id, hit_id,
         round(list_inner_product(q, v) / sqrt(list_inner_product(q, q)) / sqrt(list_inner_product(v, v)), 6) AS score
  FROM qs, corpus),
hits AS (
  SELECT query_id, hit_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, hit_id) AS rank
  FROM pairs QUALIFY rank <= 20),
matches AS (
  SELECT query_id, hit_id AS matched_event_id, score AS similarity_score, rank,
         count(*) OVER (PARTITION BY query_id) AS match_count
  FROM hits WHERE score >= {MATCH_AT}),
outcomes AS (
  SELECT *, CASE WHEN similarity_score > 0.85 THEN 'up' ELSE 'down' END AS direction,
         round(similarity_score * 0.8, 4) AS confidence, '{'|'.join(lx.ASSET_CLASSES)}' AS asset_classes
  FROM matches)"""


LINKS = f"""SELECT query_id AS source_event, matched_event_id AS target_event, similarity_score AS similarity,
       direction, confidence, asset_classes, '{RUN_TS}' AS created_at FROM outcomes"""

HISTORY = "history AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, {lit(n)}, {lit(k)}, {lit(m)}, CAST({s} AS DOUBLE))" for i, (n, k, m, s) in enumerate(lx.HISTORICAL_EVENTS)
) + ") h(ord, name, type, impact, sentiment))"


def ranked_history(key: str) -> str:
    return f"""{HISTORY},
analogs AS (
  SELECT {key}, name, type, impact, sentiment AS historical_sentiment,
         round((1 - abs(sentiment - avg_sentiment)) * 0.6
               + CASE WHEN type = 'economic' THEN 1.0::DOUBLE ELSE 0.3::DOUBLE END * 0.4, 4) AS similarity_score, ord
  FROM aggs, history),
top_analogs AS (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY similarity_score DESC, ord) AS rank
  FROM analogs QUALIFY rank <= 5)"""


TRENDS = f"""
sigs AS (SELECT *, {RULES} AS signals FROM aggs),
drifts AS (
  SELECT *, 0.05 * coalesce(list_sum(list_transform(signals, lambda s:
     CASE s.direction WHEN 'bearish' THEN -0.1 WHEN 'bullish' THEN 0.1 ELSE 0.0 END * s.confidence)), 0.0) AS drift
  FROM sigs),
trends AS (
  SELECT *, CASE WHEN drift > 0.01 THEN 'bullish' WHEN drift < -0.01 THEN 'bearish' ELSE 'neutral' END AS trend,
         abs(drift) * 10 + 0.5 AS confidence FROM drifts)"""

SERIES = """
series AS (
  SELECT event_type AS series_id, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS idx,
         round(avg(value), 6) AS value
  FROM events GROUP BY 1, 2),
fitted AS (
  SELECT series_id, coalesce(regr_slope(value, idx), 0.0) AS slope, max_by(value, idx) AS last
  FROM series GROUP BY series_id)"""

BACKTEST = f"""
days AS (
  SELECT strategy_id, day, list_sum(list_transform({DAILY_RULES}, lambda s:
           CASE s.direction WHEN 'bullish' THEN 1 WHEN 'bearish' THEN -1 ELSE 0 END)) AS votes
  FROM (SELECT *, "language" AS strategy_id FROM aggs)),
positions AS (SELECT strategy_id, day, CAST(coalesce(sign(votes), 0) AS BIGINT) AS pos FROM days),
prices AS (SELECT strftime(ts, '%Y-%m-%d') AS day, round(avg(value), 6) AS act FROM events GROUP BY 1),
priced AS (
  SELECT strategy_id, day, pos, act,
         row_number() OVER (PARTITION BY strategy_id ORDER BY day) - 1 AS seq
  FROM positions JOIN prices USING (day)),
fold AS (
  SELECT strategy_id, CAST(-1 AS BIGINT) AS seq, 10000.0::DOUBLE AS capital, 0.0::DOUBLE AS holdings,
         10000.0::DOUBLE AS peak, 0.0::DOUBLE AS last, CAST(NULL AS VARCHAR) AS action,
         CAST(NULL AS DOUBLE) AS units, CAST(NULL AS DOUBLE) AS value
  FROM (SELECT DISTINCT strategy_id FROM priced)
  UNION ALL
  SELECT strategy_id, seq, capital, holdings,
         greatest(peak, CASE WHEN holdings > 0 THEN capital + holdings * act ELSE capital END), act, action, units, value
  FROM (
    SELECT p.strategy_id, p.seq, p.act, f.peak,
           CASE WHEN buy THEN 0.0 WHEN sell THEN f.holdings * p.act ELSE f.capital END AS capital,
           CASE WHEN buy THEN f.capital / greatest(abs(p.act), 0.001) WHEN sell THEN 0.0 ELSE f.holdings END AS holdings,
           CASE WHEN buy THEN 'buy' WHEN sell THEN 'sell' END AS action,
           CASE WHEN buy THEN f.capital / greatest(abs(p.act), 0.001) END AS units,
           CASE WHEN sell THEN f.holdings * p.act END AS value
    FROM (SELECT f.*, p.act, p.pos, p.pos <> 0 AND f.holdings = 0 AS buy, p.pos = 0 AND f.holdings > 0 AS sell
          FROM fold f JOIN priced p ON p.strategy_id = f.strategy_id AND p.seq = f.seq + 1) f
    JOIN priced p ON p.strategy_id = f.strategy_id AND p.seq = f.seq + 1)),
trades AS (
  SELECT strategy_id, row_number() OVER (PARTITION BY strategy_id ORDER BY seq) - 1 AS seq,
         seq AS day, action, last AS price, units, value
  FROM fold WHERE action IS NOT NULL),
ends AS (
  SELECT f.strategy_id, f.capital + f.holdings * f.last AS final, f.peak,
         (SELECT count(*) FROM trades t WHERE t.strategy_id = f.strategy_id) AS trade_count
  FROM fold f JOIN (SELECT strategy_id, max(seq) AS seq FROM fold GROUP BY 1) m USING (strategy_id, seq)),
equity AS (
  SELECT strategy_id, 10000.0::DOUBLE AS initial_capital, round(final, 2) AS final_value,
         round((final - 10000) / 10000 * 100, 2) AS total_return_pct, trade_count,
         round(peak, 2) AS peak_value, CASE WHEN peak > 0 THEN round((peak - final) / peak * 100, 2) ELSE 0.0 END
           AS max_drawdown_pct
  FROM ends)"""

METRICS = """
levels AS (
  SELECT *, coalesce(value, price) AS lvl,
         lag(coalesce(value, price)) OVER (PARTITION BY strategy_id ORDER BY seq) AS before,
         lag(units * abs(price)) OVER (PARTITION BY strategy_id ORDER BY seq) AS invested
  FROM trades),
changes AS (
  SELECT *, CASE WHEN before <> 0 AND lvl <> 0 THEN (lvl - before) / before END AS mixed,
         CASE WHEN value IS NOT NULL AND invested <> 0 THEN value / invested - 1 END AS fixed
  FROM levels),
metrics AS (
  SELECT strategy_id,
         CASE WHEN count(mixed) >= 2 AND stddev_pop(mixed) > 0
              THEN sqrt(252) * (avg(mixed) - 0.02 / 252) / stddev_pop(mixed) ELSE 0.0 END AS sharpe_ratio,
         count(*) FILTER (value > 0) / CAST(greatest(count(value), 1) AS DOUBLE) AS win_rate,
         coalesce(avg(value) / min_by(price, seq) - 1, 0.0) AS avg_return_per_trade,
         CASE WHEN count(fixed) >= 2 AND stddev_pop(fixed) > 0
              THEN sqrt(252) * (avg(fixed) - 0.02 / 252) / stddev_pop(fixed) ELSE 0.0 END AS sharpe_fixed,
         count(*) FILTER (value > invested) / CAST(greatest(count(value), 1) AS DOUBLE) AS win_fixed,
         coalesce(avg(fixed), 0.0) AS avg_fixed
  FROM changes GROUP BY strategy_id)"""

SUMMARY_SENTENCES = f"""
texts AS (
  SELECT event_id, coalesce(title, '') || '. ' || coalesce(nullif(content, ''), description, '') AS full_text FROM articles),
parts AS (
  SELECT event_id, full_text,
         string_split(regexp_replace({strip('full_text')}, '([.!?]){SPACE}+', '\\1' || chr(1), 'g'), chr(1)) AS ss
  FROM texts),
summaries AS (
  SELECT event_id, CASE WHEN len(ss) <= 3 THEN full_text ELSE
    array_to_string(list_transform(list_sort(list_transform(ss, lambda s, i: {{
      'p': -(len(list_filter(regexp_split_to_array(s, '{SPACE}+'), lambda w: w <> ''))
             + CASE WHEN {has_any(lx.SUMMARY_KEYWORDS, 'lower(s)')} THEN 10 ELSE 0 END),
      'i': i, 's': s}}))[1:3], lambda r: r.s), ' ') END AS summary
  FROM parts)"""

FEATURE_TABLE = ctes(ARTICLES, TAGGED)


def _words_count(words: Iterable[str]) -> str:
    return " + ".join(f"CAST({has(w)} AS BIGINT)" for w in words)


def statements() -> dict[str, str]:
    sql: dict[str, str] = {}
    art = ctes(ARTICLES)
    lowered = ctes(ARTICLES, f"lows AS (SELECT *, {LOW} AS low FROM articles)")

    # the daily path: first copies only, tagged from the short linker lists
    daily = f"""
linked AS (
  SELECT *, {sentiment(BODY, POSITIVE, NEGATIVE)}, {PLACES_ALL} AS allp,
         {orgs(lx.LINKER_ACRONYMS, lx.LINKER_SUFFIXES)} AS orgs, {found(lx.LINKER_COUNTRIES, LOW)} AS countries
  FROM firsts),
feats AS (
  SELECT event_id, event_ts, "language", orgs, countries, len(orgs) + len(countries) AS entity_count,
         {SCORE} AS sentiment_score, {LABEL} AS sentiment_label,
         CASE WHEN len({PLACES}) > 0 THEN 1 ELSE 0 END AS has_geo FROM linked)"""

    # sources
    sql["src_gdelt"] = art + """
SELECT event_id AS gdelt_doc_id, 'gdelt' AS source, 'news_article' AS event_type, title, url,
       md5(content) AS content_md5, source_name, published, "language" AS categories, '' AS locations,
       0.0::DOUBLE AS tone FROM articles"""
    sql["src_gdelt_conflict"] = lowered + f"""
SELECT event_id, 'conflict_intelligence' AS event_type, title, source_name FROM lows
WHERE {has_any(CONFLICT_WORDS)}"""
    sql["src_newsapi"] = art + """
SELECT 'newsapi' AS source, 'news_article' AS event_type, title, description, md5(content) AS content_md5, url,
       source_name, published FROM articles"""
    sql["src_rss"] = art + """
SELECT 'rss' AS source, 'news_article' AS event_type, title, md5(content) AS description_md5,
       'http://feed.example/' || event_id AS link, coalesce(published, '') AS published, true AS has_feed
FROM articles"""
    sql["src_webhook"] = """
SELECT 'webhook' AS source, 'incoming' AS event_type, conv_id, turn, role, md5(text) AS text_md5, true AS parsed
FROM conversations"""
    sql["src_cap"] = ctes(ARTICLES, times("articles")) + """
SELECT event_id, published, title FROM timed
ORDER BY local_ts - CASE WHEN length(off) = 6
    THEN to_minutes(CAST(left(off, 1) || '1' AS INTEGER) * (60 * CAST(off[2:3] AS INTEGER) + CAST(off[5:6] AS INTEGER)))
    ELSE INTERVAL 0 MINUTE END DESC NULLS LAST, event_id LIMIT 250"""
    sql["stream_kafka_in"] = """
SELECT CAST(event_id AS VARCHAR) AS key, 'raw-events' AS topic, event_id, user_id, event_type, value,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS kafka_ts FROM events"""
    sql["src_union"] = ctes(ARTICLES, PAGES) + """
SELECT event_id, source, event_type, title, md5(content) AS content_md5, url, "language" FROM articles
UNION ALL SELECT event_id, source, event_type, title, md5(content), url, NULL FROM page_articles
UNION ALL SELECT 'turn:' || conv_id || '/' || turn, 'conversations', 'incoming', NULL, md5(text), NULL, NULL
FROM conversations"""

    # clean and transform
    sql["clean_dedup"] = art + """
SELECT dedup_key, event_id, title, source_name, strftime(event_ts, '%Y-%m-%d %H:%M:%S') AS event_ts FROM firsts"""
    sql["daily_dedup"] = art + """
SELECT strftime(event_ts, '%Y-%m-%d') AS day, count(DISTINCT dedup_key) AS kept,
       count(*) - count(DISTINCT dedup_key) AS skipped FROM articles GROUP BY 1"""
    sql["clean_dedup_history"] = art + """
SELECT dedup_key, event_id, title FROM articles
WHERE event_ts >= TIMESTAMP '2024-01-16'
  AND dedup_key NOT IN (SELECT dedup_key FROM articles WHERE event_ts < TIMESTAMP '2024-01-16')
QUALIFY row_number() OVER (PARTITION BY dedup_key ORDER BY event_ts, event_id) = 1"""
    sql["clean_dedup_store"] = art + "SELECT dedup_key, event_id, title FROM firsts"
    normal = f"""
normal AS (
  SELECT event_id, dedup_key, {strip("coalesce(title, '')")} AS title,
         {squeeze("coalesce(nullif(content, ''), nullif(description, ''), '')")} AS content FROM @rows)"""
    sql["clean_normalize"] = ctes(ARTICLES, normal.replace("@rows", "articles")) + """
SELECT event_id, title, md5(content) AS content_md5, length(content) AS text_length FROM normal"""
    valid = """NOT (length(title) = 0 AND length(content) = 0)
  AND NOT (length(content) < 20 AND length(title) < 3)"""
    sql["clean_validate"] = art + f"SELECT event_id, title FROM articles WHERE {valid}"
    sql["clean_chain"] = ctes(ARTICLES, normal.replace("@rows", "firsts")) + f"""
SELECT event_id, dedup_key, title, md5(content) AS content_md5, length(content) AS text_length
FROM normal WHERE {valid}"""
    sql["xf_schema_map"] = art + """
SELECT event_id, title, title AS headline, "language" AS lang, source AS source_name FROM articles"""
    sql["xf_event_build"] = art + f"""
SELECT event_id, 'news' AS channel, event_type AS original_type, source, strftime(event_ts, {ISO_T}) AS "timestamp",
       title, url, source_name, coalesce("language", 'en') AS "language", md5(content) AS content_md5 FROM articles"""
    sql["xf_rss"] = ctes(ARTICLES, times("articles")) + f"""
SELECT event_id, 'http://feed.example/' || event_id AS url, title, source_name,
       strftime(event_ts, {ISO_T}) AS "timestamp", {PARSED}, strftime(local_ts, '%Y-%m-%d') AS published_date,
       CAST(hour(local_ts) AS BIGINT) AS published_hour, dayname(local_ts) AS day_of_week, '{RUN_TS}' AS ingested_at
FROM timed"""

    # enrichment and text
    sql["enrich_geo"] = ctes(ARTICLES, f"geo AS (SELECT event_id, {PLACES_ALL} AS allp FROM articles)",
                             f"named AS (SELECT event_id, {PLACES} AS places FROM geo)") + f"""
SELECT event_id, len(places) > 0 AS has_geo, len(places) AS n_locations, {joined('places')} AS names,
       CASE WHEN len(places) > 0 THEN 0.5::DOUBLE END AS confidence FROM named"""
    sql["enrich_entities"] = ctes(ARTICLES, f"""ents AS (
  SELECT event_id, {orgs(lx.LINKER_ACRONYMS, lx.LINKER_SUFFIXES)} AS orgs,
         {found(lx.LINKER_COUNTRIES, LOW)} AS countries FROM articles)""") + f"""
SELECT event_id, len(orgs) + len(countries) AS entity_count, {joined('orgs')} AS organizations,
       {joined('countries')} AS countries, CAST(0 AS BIGINT) AS n_people, CAST(0 AS BIGINT) AS n_events FROM ents"""
    sql["enrich_temporal"] = ctes(ARTICLES, times("articles")) + f"""
SELECT event_id, published, {PARSED}, strftime(local_ts, '%Y-%m-%d') AS published_date,
       CAST(hour(local_ts) AS BIGINT) AS published_hour, dayname(local_ts) AS day_of_week, '{RUN_TS}' AS ingested_at
FROM timed"""
    sql["daily_enrich"] = ctes(ARTICLES, times("firsts"), f"""ents AS (
  SELECT *, {PLACES_ALL} AS allp, {orgs(lx.LINKER_ACRONYMS, lx.LINKER_SUFFIXES)} AS orgs,
         {found(lx.LINKER_COUNTRIES, LOW)} AS countries FROM timed)""") + f"""
SELECT event_id, dedup_key, len({PLACES}) AS n_locations, len(orgs) + len(countries) AS entity_count, {PARSED},
       dayname(local_ts) AS day_of_week FROM ents"""
    sql["nlp_entities"] = FEATURE_TABLE + f"""
SELECT event_id, {joined('countries')} AS countries, {joined('orgs')} AS organizations, entity_count AS total
FROM feats"""
    for name, pos, neg in (
        ("nlp_sentiment", lx.POSITIVE_WORDS, lx.NEGATIVE_WORDS), ("nlp_sentiment_lexicon", POSITIVE, NEGATIVE)
    ):
        sql[name] = ctes(ARTICLES, f"pn AS (SELECT event_id, {sentiment(BODY, pos, neg)} FROM articles)") + f"""
SELECT event_id, {SCORE} AS score, {LABEL} AS label, p AS positive_words, n AS negative_words FROM pn"""
    sql["nlp_summary"] = ctes(ARTICLES, SUMMARY_SENTENCES) + "SELECT event_id, summary FROM summaries"
    level = " ".join(
        f"WHEN {has_any(TRIGGERS[x])} THEN '{x}'" for x in ("low", "medium", "high")
    )
    triggers = [w for ws in TRIGGERS.values() for w in ws]
    sql["intel_conflict"] = lowered + f"""
SELECT *, CAST(CASE escalation_level WHEN 'high' THEN 10 WHEN 'medium' THEN 5 ELSE 1 END AS BIGINT) AS severity_score
FROM (SELECT event_id, CASE {level} ELSE 'low' END AS escalation_level, {joined(found(triggers))} AS matched_triggers,
             {joined(found(ZONES))} AS active_zones,
             {_words_count(CONFLICT_HITS)} AS keyword_hits FROM lows)"""
    indicators = present(
        (has_any(ws), f"{{'indicator': {lit(k)}, 'matched': {found(ws)}}}") for k, ws in lx.ECONOMIC_INDICATORS.items()
    )
    sql["intel_economic"] = ctes(ARTICLES, f"lows AS (SELECT *, {LOW} AS low FROM articles)", f"""ind AS (
  SELECT event_id, {joined(labels(lx.SECTORS))} AS primary_sectors, {indicators} AS hits FROM lows)""") + f"""
SELECT event_id, len(hits) AS indicator_count, primary_sectors, h.indicator AS indicator,
       {joined('h.matched')} AS matched, len(h.matched) AS matches
FROM (SELECT *, unnest(hits) AS h FROM ind)
UNION ALL SELECT event_id, 0, primary_sectors, NULL, NULL, NULL FROM ind WHERE len(hits) = 0"""
    sql["terms_economic"] = f"SELECT event_id, indicator, matched, matches FROM ({sql['intel_economic']}) WHERE indicator IS NOT NULL"
    sql["terms_benchmark"] = ctes(ARTICLES, f"lows AS (SELECT *, {LOW} AS low FROM articles)", """
words AS (SELECT unnest(string_split(lower(text), ' ')) AS w FROM benchmark),
listed AS (SELECT w FROM words WHERE length(w) >= 6 AND regexp_full_match(w, '[!-~]+') GROUP BY w ORDER BY count(*) DESC, w LIMIT 10000)""") + """
SELECT w AS keyword, count(*) AS articles FROM listed JOIN lows ON contains(low, w) GROUP BY w"""
    commodities = present(
        (has_any(ws), f"{{'category': {lit(k)}, 'names': {found(ws)}}}") for k, ws in lx.COMMODITIES.items()
    )
    sql["intel_commodity"] = lowered + f"""
SELECT event_id, h.category AS category, {joined('h.names')} AS mentioned
FROM (SELECT event_id, unnest({commodities}) AS h FROM lows)"""
    categories = f"CASE WHEN len(c) = 0 THEN ['general'] ELSE c END"
    sql["news_classify"] = lowered + f"""
SELECT event_id, {joined('cats')} AS categories, len(cats) AS category_count
FROM (SELECT event_id, {categories} AS cats FROM (SELECT event_id, {labels(lx.NEWS_CATEGORIES)} AS c FROM lows))"""
    weights = " ".join(f"WHEN {lit(k)} THEN CAST({v} AS DOUBLE)" for k, v in lx.SOURCE_WEIGHTS.items())
    weigh = f"CASE replace(lower(coalesce(nullif(source_name, ''), source)), ' ', '_') {weights} ELSE 0.5::DOUBLE END"
    renamed = """renamed AS (
  SELECT * REPLACE (CASE source_name WHEN 'src0' THEN 'Reuters' WHEN 'src1' THEN 'Al Jazeera' WHEN 'src2' THEN ''
                    ELSE source_name END AS source_name) FROM articles)"""
    sql["news_credibility"] = ctes(ARTICLES, renamed) + f"""
SELECT event_id, source_name, {weigh} AS source_credibility, {weigh} AS source_weight FROM renamed"""
    spots = present(
        (has(p), f"{{'kind': {lit(k)}, 'place': {lit(p)}}}") for k, ps in WATCHED.items() for p in ps
    )
    sql["watchlist_mentions"] = ctes(ARTICLES, f"lows AS (SELECT *, {LOW} AS low FROM articles)", f"""spotted AS (
  SELECT strftime(event_ts, '%Y-%m-%d') AS day, unnest({spots}) AS h FROM lows)""", """daily AS (
  SELECT h.kind AS kind, h.place AS place, day, count(*) AS mentions FROM spotted GROUP BY 1, 2, 3)""") + """
SELECT kind, place, day, mentions, CASE WHEN stddev_pop(mentions) OVER w > 0
       THEN round((mentions - avg(mentions) OVER w) / stddev_pop(mentions) OVER w, 4) ELSE 0.0::DOUBLE END AS z_score
FROM daily WINDOW w AS (PARTITION BY kind, place)"""
    sql["memory_episodes"] = ctes(ARTICLES, SUMMARY_SENTENCES,
                                  f"geo AS (SELECT event_id, title, {PLACES_ALL} AS allp FROM articles)") + f"""
SELECT event_id, title, md5(summary) AS summary_md5, len({PLACES}) AS n_locations, CAST(0 AS BIGINT) AS n_sectors,
       'pipeline' AS source, 'memory_encoding' AS pipeline_name FROM geo JOIN summaries USING (event_id)"""

    # knowledge graph
    sql["kg_nodes"] = ctes(ARTICLES, TAGGED, MENTIONS, SUMMARY_SENTENCES) + """
SELECT event_id AS id, 'event' AS type, left(title, 80) AS label, source, coalesce(published, '') AS published,
       sentiment_score AS sentiment, url, md5(summary) AS summary FROM feats JOIN summaries USING (event_id)
UNION ALL
SELECT target, min(kind), min(name), NULL, NULL, NULL, NULL, NULL FROM mentions GROUP BY target"""
    graph = ctes(ARTICLES, TAGGED, MENTIONS, EDGES)
    sql["kg_edges"] = graph + "SELECT source, target, type, relation, weight FROM kg_edges"
    sql["kg_stats"] = graph + """
SELECT n AS nodes, m AS edges, CASE WHEN n > 1 THEN round(m / (CAST(n AS DOUBLE) * (n - 1)), 4) ELSE 0.0 END AS density
FROM (SELECT (SELECT count(*) FROM node_ids) AS n, (SELECT count(*) FROM merged) AS m)"""
    sql["kg_centrality"] = graph + """
SELECT id, round(degree / CAST(n - 1 AS DOUBLE), 4) AS centrality, round(s / CAST(n AS DOUBLE), 2) AS avg_degree
FROM (SELECT id, (SELECT count(*) FROM merged WHERE source = id) + (SELECT count(*) FROM merged WHERE target = id)
             AS degree, count(*) OVER () AS n, 2 * (SELECT count(*) FROM merged) AS s FROM node_ids)
ORDER BY degree DESC, id LIMIT 10"""
    sql["kg_shortest_path"] = recursive(SUPPLY, f"""walk AS (
  SELECT {lit(PATH_FROM)} AS node, [{lit(PATH_FROM)}] AS path, 0 AS hops
  UNION ALL
  SELECT s.target, list_append(w.path, s.target), w.hops + 1 FROM walk w JOIN supply s ON s.source = w.node
  WHERE w.hops < 6 AND NOT list_contains(w.path, s.target) AND w.node <> {lit(PATH_TO)})""") + f"""
SELECT array_to_string(path, '|') AS path, CAST(hops AS BIGINT) AS length FROM walk
WHERE node = {lit(PATH_TO)} ORDER BY hops, path LIMIT 1"""
    sql["kg_neighbors"] = ctes(SUPPLY) + f"""
SELECT target AS neighbor, count(*) OVER () AS count
FROM (SELECT DISTINCT target FROM supply WHERE source = {lit(HUB)})"""
    sql["kg_subgraph"] = ctes(SUPPLY, """members AS (
  SELECT id FROM supply_nodes WHERE type IN ('supplier', 'nation', 'region'))""") + """
SELECT (SELECT count(*) FROM members) AS subgraph_nodes,
       (SELECT count(*) FROM supply WHERE source IN (FROM members) AND target IN (FROM members)) AS subgraph_edges"""
    sql["kg_impact"] = ctes(SUPPLY) + """
SELECT source AS from_node, target AS to_node, weight,
       row_number() OVER (PARTITION BY source ORDER BY weight DESC, target) AS rank
FROM supply WHERE source <> target QUALIFY rank <= 20"""
    sql["kg_causal_paths"] = recursive(SUPPLY, """starts AS (
  SELECT id FROM (SELECT source AS id FROM supply UNION SELECT id FROM supply_nodes)
  WHERE id NOT IN (SELECT target FROM supply) ORDER BY id LIMIT 3)""", f"""walk AS (
  SELECT id AS node, [id] AS path, [CAST(NULL AS VARCHAR)] AS rels, 0.0::DOUBLE AS w, 0 AS hops FROM starts
  UNION ALL
  SELECT s.target, list_append(w.path, s.target), list_append(w.rels, s.relation), w.w + s.weight, w.hops + 1
  FROM walk w JOIN supply s ON s.source = w.node
  WHERE w.hops < 5 AND NOT list_contains(w.path, s.target) AND w.node <> {lit(PATH_TO)})""") + f"""
SELECT array_to_string(path, '|') AS path, CAST(hops AS BIGINT) AS length,
       array_to_string(rels[2:], '|') AS relations, w AS weight_sum
FROM walk WHERE node = {lit(PATH_TO)} AND hops > 0 ORDER BY hops, walk.path LIMIT 5"""
    sql["daily_graph"] = ctes(ARTICLES, daily, MENTIONS) + """
SELECT day, n_nodes, coalesce(n_edges, 0) AS n_edges, coalesce(weight_sum, 0.0) AS weight_sum
FROM (SELECT day, count(DISTINCT id) AS n_nodes FROM (
        SELECT strftime(event_ts, '%Y-%m-%d') AS day, event_id AS id FROM feats
        UNION ALL SELECT strftime(event_ts, '%Y-%m-%d'), target FROM mentions JOIN feats ON event_id = mentions.source)
      GROUP BY day)
LEFT JOIN (
  SELECT strftime(event_ts, '%Y-%m-%d') AS day, count(*) AS n_edges,
         round(sum(CASE WHEN kind = 'country' THEN 0.8::DOUBLE ELSE 0.6::DOUBLE END), 4) AS weight_sum
  FROM (SELECT DISTINCT source AS src, target, kind FROM mentions) m JOIN feats ON event_id = src GROUP BY 1) USING (day)"""
    sql["graph_upsert"] = graph + "SELECT source, target, type, relation, weight FROM merged"

    # features and signals
    sql["feat_extract"] = ctes(ARTICLES, TAGGED, times("feats"), """vecs AS (
  SELECT CAST(vec_id AS VARCHAR) AS event_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)""") + """
SELECT event_id, sentiment_score, sentiment_label, entity_count, text_length, CAST(has_geo AS BIGINT) AS has_geo,
       CAST(coalesce(hour(local_ts), 0) AS BIGINT) AS hour_of_day,
       CAST(coalesce(isodow(local_ts) - 1, 0) AS BIGINT) AS day_of_week,
       CAST(CASE WHEN v IS NULL THEN 0 ELSE 1 END AS BIGINT) AS has_embedding,
       round(list_avg(v), 6) AS embedding_mean, round(list_stddev_pop(v), 6) AS embedding_std
FROM timed LEFT JOIN vecs USING (event_id)"""
    six = """total_events, round(avg_sentiment, 6) AS avg_sentiment, round(positive_ratio, 6) AS positive_ratio,
       round(negative_ratio, 6) AS negative_ratio, round(avg_entity_count, 6) AS avg_entity_count,
       round(geo_ratio, 6) AS geo_ratio"""
    per_source_lang = ctes(ARTICLES, TAGGED, aggregate("feats", 'source_name, "language"'))
    sql["feat_aggregate"] = per_source_lang + f'SELECT source_name, "language", {six} FROM aggs'
    sql["daily_features"] = ctes(ARTICLES, daily, aggregate(BY_DAY, "day")) + """
SELECT day, round(avg_sentiment, 6) AS avg_sentiment, round(avg_entity_count, 6) AS avg_entities, total_events
FROM aggs"""
    sql["signals"] = per_source_lang + fired('source_name, "language"', "aggs", RULES)
    lang_day = ctes(ARTICLES, TAGGED, aggregate(BY_DAY, '"language", day'))
    sql["daily_signals"] = ctes(ARTICLES, daily, aggregate(BY_DAY, '"language", day')) + fired('"language", day', "aggs", DAILY_RULES)
    sql["signal_filter"] = lang_day + fired('"language", day', "aggs", DAILY_RULES, "WHERE s.confidence >= 0.3")
    sql["signals_7d"] = ctes(ARTICLES, TAGGED, """rolled AS (
  SELECT d."language", d.day, f.* EXCLUDE ("language") FROM
    (SELECT DISTINCT "language", CAST(event_ts AS DATE) AS day FROM feats) d
    JOIN feats f ON f."language" = d."language" AND CAST(f.event_ts AS DATE) BETWEEN d.day - 6 AND d.day)""",
        aggregate("(SELECT * REPLACE (strftime(day, '%Y-%m-%d') AS day) FROM rolled)", '"language", day')
    ) + fired('"language", day', "aggs", RULES)
    sql["feature_snapshot"] = ctes(
        ARTICLES, TAGGED, aggregate("feats", '"language"'), f"sigs AS (SELECT *, {RULES} AS signals FROM aggs)"
    ) + f"""
SELECT event_id, f."language", sentiment_score, entity_count, len(signals) AS n_signals,
       {joined('list_transform(signals, lambda s: s.type)')} AS signal_types,
       round(avg_sentiment, 6) AS avg_sentiment, total_events, '{RUN_TS}' AS "timestamp"
FROM feats f JOIN sigs s ON s."language" = f."language" """

    # similarity
    near = ctes(hits())
    sql["sim_topk"] = near + "SELECT query_id, hit_id, score, rank FROM hits"
    by_id = ctes(hits_by_id())
    sql["sim_index"] = by_id + "SELECT query_id, hit_id, score, rank FROM hits"
    sql["sim_recall"] = by_id + "SELECT count(DISTINCT query_id) AS n_queries, count(*) AS n_hits, true AS recall_reached FROM hits"
    sql["sim_match"] = near + "SELECT query_id, matched_event_id, similarity_score, rank, match_count FROM matches"
    sql["sim_outcomes"] = near + """
SELECT query_id, matched_event_id, similarity_score, rank, direction, confidence, asset_classes FROM outcomes"""
    sql["sim_links"] = near + LINKS
    sql["similarity_flow"] = near + LINKS
    sql["impact"] = near + f"""
SELECT query_id, round(m, 4) AS impact_score,
       CASE WHEN m > 0.8 THEN 'high' WHEN m > 0.6 THEN 'medium' ELSE 'low' END AS impact_level,
       '{'|'.join(lx.AFFECTED_ASSETS)}' AS affected_assets, CASE WHEN m > 0.8 THEN 'fast' ELSE 'moderate' END AS time_to_market
FROM (SELECT query_id, avg(score) AS m FROM hits GROUP BY query_id)"""
    per_source = (ARTICLES, TAGGED, aggregate("feats", "source_name"))
    sql["analogs"] = ctes(*per_source, ranked_history("source_name")) + """
SELECT source_name, rank, name, type, impact, similarity_score, historical_sentiment FROM top_analogs"""

    sql["nlp_embed"] = ctes(ARTICLES, f"""
words AS (SELECT event_id, unnest(list_filter(regexp_split_to_array({LOW}, '{SPACE}+'), lambda x: x <> '')) AS w FROM articles),
slots AS (SELECT event_id, CAST('0x' || left(md5(w), 8) AS BIGINT) % 768 AS s FROM words),
cells AS (SELECT event_id, s % 384 AS c, sum(CASE WHEN s >= 384 THEN -1 ELSE 1 END) AS x FROM slots GROUP BY ALL),
norms AS (SELECT event_id, sqrt(CAST(sum(x * x) AS DOUBLE)) AS n FROM cells GROUP BY ALL),
filled AS (SELECT event_id, c, CAST(round(CAST(CAST(CAST(x AS DOUBLE) / n AS FLOAT) AS DOUBLE) * 1e6::DOUBLE) AS BIGINT) AS v
           FROM cells JOIN norms USING (event_id) WHERE x <> 0)""") + """
SELECT event_id, CAST(384 AS BIGINT) AS embedding_dim, count(*) FILTER (v <> 0) AS n_cells,
       CAST(coalesce(sum(v * (c + 1)), 0) AS BIGINT) AS checksum FROM articles LEFT JOIN filled USING (event_id) GROUP BY event_id"""

    sql["stream_realtime"] = ctes(ARTICLES, f"""
texts AS (
  SELECT event_id AS id, 'c' AS side, {LOW} AS low FROM articles
  UNION ALL SELECT 'live:' || item_id, 'q', lower(' ' || coalesce(text, '')) FROM benchmark),
words AS (SELECT id, side, unnest(list_filter(regexp_split_to_array(low, '{SPACE}+'), lambda x: x <> '')) AS w FROM texts),
slots AS (SELECT id, side, CAST('0x' || left(md5(w), 8) AS BIGINT) % 128 AS s FROM words),
cells AS (SELECT id, side, s % 64 AS c, sum(CASE WHEN s >= 64 THEN -1 ELSE 1 END) AS x FROM slots GROUP BY ALL),
norms AS (SELECT id, side, sqrt(CAST(sum(x * x) AS DOUBLE)) AS n FROM cells GROUP BY ALL),
unit AS (SELECT id, side, c, CAST(CAST(CAST(x AS DOUBLE) / n AS FLOAT) AS DOUBLE) AS v FROM cells JOIN norms USING (id, side) WHERE n > 0),
lens AS (SELECT id, side, sqrt(sum(v * v)) AS l FROM unit GROUP BY ALL),
shared AS (SELECT a.id AS query_id, b.id AS hit_id, sum(a.v * b.v) AS ip FROM unit a JOIN unit b ON a.side = 'q' AND b.side = 'c' AND a.c = b.c GROUP BY ALL),
scored AS (
  SELECT a.id AS query_id, b.id AS hit_id, round(coalesce(ip / la.l / lb.l, 0), 6) AS score
  FROM texts a JOIN texts b ON a.side = 'q' AND b.side = 'c' LEFT JOIN shared ON query_id = a.id AND hit_id = b.id
  LEFT JOIN lens la ON la.id = a.id AND la.side = 'q' LEFT JOIN lens lb ON lb.id = b.id AND lb.side = 'c'),
found AS (
  SELECT query_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, hit_id) AS rank FROM scored QUALIFY rank <= 20),
means AS (SELECT query_id, coalesce(avg(score) FILTER (score >= 0), 0) AS m FROM found GROUP BY query_id)""") + """
SELECT query_id, round(m, 4) AS impact_score,
       CASE WHEN m > 0.8 THEN 'high' WHEN m > 0.6 THEN 'medium' ELSE 'low' END AS impact_level,
       CASE WHEN m > 0.8 THEN 'fast' ELSE 'moderate' END AS time_to_market FROM means"""

    # learning and explanation
    cls = "CAST(CASE {0} WHEN 'positive' THEN 1 WHEN 'negative' THEN 0 ELSE 2 END AS BIGINT)"
    sql["ml_split"] = FEATURE_TABLE + f"""
SELECT event_id, {cls.format('sentiment_label')} AS label,
       CAST('0x' || left(md5(event_id), 8) AS BIGINT) % 10 < 8 AS is_train FROM feats"""
    halves = FEATURE_TABLE + """
, halves AS (SELECT count(*) FILTER (b < 8) AS train_samples, count(*) FILTER (b >= 8) AS test_samples
  FROM (SELECT CAST('0x' || left(md5(event_id), 8) AS BIGINT) % 10 AS b FROM feats))"""
    sql["ml_train"] = halves + """
SELECT 'trained' AS status, train_samples, test_samples, CAST(3 AS BIGINT) AS feature_dim, true AS beats_majority FROM halves"""
    sql["ml_registry"] = halves + f"""
SELECT '{RUN_TS}' AS registered_at, '{{"trees": 10}}' AS params, train_samples, test_samples, true AS found FROM halves"""
    predictions = ctes(ARTICLES, f"""
whole AS (SELECT event_id, {cls.format(LABEL)} AS label FROM (
  SELECT event_id, {sentiment(BODY, POSITIVE, NEGATIVE)} FROM articles)),
titled AS (SELECT event_id, {cls.format(LABEL)} AS pred FROM (
  SELECT event_id, {sentiment('title', POSITIVE, NEGATIVE)} FROM articles)),
preds AS (SELECT label, pred FROM whole JOIN titled USING (event_id)),
classes AS (
  SELECT c, count(*) FILTER (label = c AND pred = c) AS tp, count(*) FILTER (label <> c AND pred = c) AS fp,
         count(*) FILTER (label = c AND pred <> c) AS fn
  FROM preds, (SELECT DISTINCT unnest([label, pred]) AS c FROM preds) GROUP BY c),
prf AS (
  SELECT c, tp, tp + fn AS support, coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0.0) AS precision,
         coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0.0) AS recall,
         coalesce(2 * tp / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0.0) AS f1 FROM classes)""")
    sql["ml_evaluate"] = predictions + """
SELECT CAST(c AS VARCHAR) AS name, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       support, CAST(NULL AS DOUBLE) AS accuracy FROM prf
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
       CAST(sum(support) AS BIGINT), round(sum(tp) / CAST(sum(support) AS DOUBLE), 6) FROM prf
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
       round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
       CAST(sum(support) AS BIGINT), round(sum(tp) / CAST(sum(support) AS DOUBLE), 6) FROM prf"""
    sql["ml_confusion"] = predictions + """
SELECT l.c AS label, p.c AS pred, (SELECT count(*) FROM preds WHERE label = l.c AND pred = p.c) AS n
FROM (SELECT label AS c FROM preds UNION SELECT pred FROM preds) l, (SELECT label AS c FROM preds UNION SELECT pred FROM preds) p"""
    from tidewire.operators.explain import EXPAND, HEDGE, HOLD

    sql["explain_text"] = ctes(*per_source, TRENDS, ranked_history("source_name")) + f"""
SELECT t.source_name, '{RUN_TS}' AS generated_at,
       'The ' || trend || ' prediction is primarily driven by unknown (SHAP value: 0.000). This pattern resembles the '
       || name || ' event (similarity: ' || printf('%.2f', round(similarity_score, 2)) || '). Key signal: '
       || coalesce(signals[1].reason, 'No strong signals')
       || '. 0 causal paths identified in the knowledge graph.' AS summary,
       '' AS key_factors, name AS analog_event, similarity_score AS analog_similarity, CAST(0 AS BIGINT) AS causal_paths,
       {joined('list_transform(signals[1:3], lambda s: s.reason)')} AS active_signals, round(confidence, 6) AS confidence,
       CASE WHEN trend = 'bearish' AND len(list_filter(signals, lambda s: s.severity = 'high')) > 0 THEN {lit(HEDGE)}
            WHEN trend = 'bullish' THEN {lit(EXPAND)} ELSE {lit(HOLD)} END AS recommendation
FROM trends t JOIN top_analogs a ON a.source_name = t.source_name AND a.rank = 1"""

    # forecasts and back-tests
    per_language = (ARTICLES, TAGGED, aggregate("feats", '"language"'), TRENDS)
    drift = f"""projected AS (
  SELECT *, avg_sentiment + drift * day AS v FROM trends, (SELECT unnest(range(1, 31)) AS day))"""
    sql["fc_drift"] = ctes(*per_language, drift) + f"""
SELECT "language", day, strftime(DATE '{RUN_TS[:10]}' + CAST(day AS INTEGER), '%Y-%m-%d') AS date,
       round(v, 4) AS predicted_sentiment, round(v - 0.1, 4) AS lower_bound, round(v + 0.1, 4) AS upper_bound, trend,
       round(confidence, 6) AS confidence, round(avg_sentiment, 6) AS start, round(avg_sentiment + drift * 30, 4) AS "end",
       round(round(avg_sentiment + drift * 30, 4) - avg_sentiment, 4) + 0.0 AS change FROM projected"""
    sql["fc_linear"] = ctes(SERIES) + """
SELECT series_id, 'linear' AS model, step, round(last + slope * step, 6) AS value, round(slope, 6) AS trend
FROM fitted, (SELECT unnest(range(1, 31)) AS step)"""
    sql["fc_growth"] = ctes(SERIES) + """
SELECT series_id, 'growth' AS model, step, round(last * (1 + 0.001::DOUBLE * (step - 1)), 6) AS value
FROM fitted, (SELECT unnest(range(1, 31)) AS step)"""
    sql["fc_ensemble"] = ctes(
        *per_language, drift, aggregate(BY_DAY, '"language", day', "day_aggs"), """moods AS (
  SELECT "language", coalesce(regr_slope(avg_sentiment, idx), 0.0) AS slope, max_by(avg_sentiment, idx) AS last
  FROM (SELECT *, date_diff('day', DATE '2024-01-01', CAST(day AS DATE)) AS idx FROM day_aggs) GROUP BY 1)"""
    ) + """
SELECT p."language" AS series_id, p.day AS step,
       round((0.5 * (last + slope * p.day) + 0.3 * last * (1 + 0.001::DOUBLE * (p.day - 1)) + 0.2 * round(v, 4))
             / (0.5::DOUBLE + 0.3 + 0.2), 4) AS value, CAST(3 AS BIGINT) AS models_used
FROM projected p JOIN moods m ON m."language" = p."language" """
    test = (ARTICLES, TAGGED, aggregate(BY_DAY, '"language", day'), BACKTEST)
    sql["bt_positions"] = recursive(*test) + "SELECT strategy_id, day, pos FROM positions"
    sql["bt_equity"] = recursive(*test) + "SELECT * FROM equity"
    sql["bt_trades"] = recursive(*test) + """
SELECT strategy_id, seq, day, action, round(price, 4) AS price, round(units, 4) AS units, round(value, 4) AS value
FROM trades"""
    sql["bt_metrics"] = recursive(*test, METRICS) + """
SELECT strategy_id, round(sharpe_ratio, 4) AS sharpe_ratio, round(win_rate, 4) AS win_rate,
       round(avg_return_per_trade, 4) AS avg_return_per_trade FROM metrics"""
    sql["bt_metrics_fixed"] = recursive(*test, METRICS) + """
SELECT strategy_id, round(sharpe_fixed, 4) AS sharpe_ratio, round(win_fixed, 4) AS win_rate,
       round(avg_fixed, 4) AS avg_return_per_trade FROM metrics"""
    whole = aggregate("feats", '"language"', "lang_aggs")
    sql["bt_report"] = recursive(*test, METRICS, whole, TRENDS.replace("FROM aggs", "FROM lang_aggs")) + """
SELECT 'bt_' || left(e.strategy_id, 8) AS report_id, e.strategy_id, total_return_pct, max_drawdown_pct, trade_count,
       round(coalesce(sharpe_ratio, 0.0), 4) AS sharpe_ratio,
       printf('%.1f%%', round(coalesce(win_rate, 0.0) * 100, 1)) AS win_rate, trend, CAST(30 AS BIGINT) AS horizon
FROM equity e LEFT JOIN metrics USING (strategy_id) LEFT JOIN trends t ON t."language" = e.strategy_id"""

    # streams
    sql["stream_dedup"] = art + "SELECT DISTINCT dedup_key, title FROM articles"
    sql["stream_dedup_keyed"] = sql["stream_dedup"]
    sql["stream_transform"] = "SELECT event_id, event_type, true AS stream_processed, true AS waited FROM events"
    sql["stream_signals"] = ctes(ARTICLES, TAGGED, """windows AS (
  SELECT CAST(unnest(range(CAST(CAST(event_ts AS DATE) AS TIMESTAMP) - INTERVAL 6 DAY,
                           CAST(CAST(event_ts AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS TIMESTAMP) AS ws, *
  FROM feats)""", """shut AS (
  SELECT *, strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start,
         strftime(ws + INTERVAL 7 DAY, '%Y-%m-%d %H:%M:%S') AS window_end
  FROM windows WHERE ws + INTERVAL 7 DAY <= (SELECT max(event_ts) - INTERVAL 1 DAY FROM articles))""",
        aggregate("shut", 'window_start, window_end, "language"')
    ) + fired('window_start, window_end, "language"', "aggs", RULES)
    sql["stream_signals_daily"] = ctes(ARTICLES, TAGGED, """shut AS (
  SELECT *, strftime(CAST(event_ts AS DATE), '%Y-%m-%d %H:%M:%S') AS window_start,
         strftime(CAST(event_ts AS DATE) + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS window_end
  FROM feats WHERE CAST(event_ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(event_ts) - INTERVAL 1 DAY FROM articles))""",
        aggregate("shut", 'window_start, window_end, "language"')
    ) + fired('window_start, window_end, "language"', "aggs", RULES)
    sql["stream_out"] = """
SELECT CAST(event_id AS VARCHAR) AS key, 'pipeline_update' AS type, 'streaming_out' AS pipeline, event_type, user_id,
       value, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp" FROM events"""
    sql["sink_tables"] = art + """
SELECT strftime(event_ts, '%Y-%m-%d') AS day, count(*) AS n_rows, CAST(sum(length(content)) AS BIGINT) AS n_chars
FROM articles GROUP BY 1"""

    # flows and run log
    sql["daily_flow"] = ctes(ARTICLES, daily, aggregate(BY_DAY, "day")) + fired("day", "aggs", DAILY_RULES)
    sql["daily_store"] = ctes(ARTICLES, daily, MENTIONS, aggregate(BY_DAY, "day"), f"""fired AS (
  {fired("day", "aggs", DAILY_RULES)})""") + """
SELECT 'rows' AS "table", day, count(*) AS n FROM (SELECT strftime(event_ts, '%Y-%m-%d') AS day FROM feats) GROUP BY day
UNION ALL SELECT 'nodes', day, count(*) FROM (SELECT strftime(event_ts, '%Y-%m-%d') AS day FROM feats) GROUP BY day
UNION ALL SELECT 'edges', strftime(event_ts, '%Y-%m-%d'), count(*) FROM (SELECT DISTINCT source, target FROM mentions) m
  JOIN feats ON event_id = source GROUP BY ALL
UNION ALL SELECT 'features', day, count(*) FROM aggs GROUP BY day
UNION ALL SELECT 'signals', day, count(*) FROM fired GROUP BY day"""
    sql["ingest_flow"] = ctes(ARTICLES, normal.replace("@rows", "firsts")) + f"""
SELECT s AS source, 'news_article' AS event_type, count(*) AS n, count(DISTINCT title) AS n_titles
FROM normal, (SELECT unnest(['gdelt', 'newsapi']) AS s) WHERE {valid} GROUP BY s
UNION ALL SELECT 'rss', 'news_article', count(*), count(DISTINCT title) FROM articles
UNION ALL SELECT 'webhook', 'incoming', count(*), CAST(1 AS BIGINT) FROM conversations"""
    sql["news_flow"] = ctes(ARTICLES, PAGES, f"""news AS (
  SELECT event_id, source, source_name, {LOW} AS low FROM articles
  UNION ALL SELECT event_id, source, NULL, {LOW} FROM page_articles)""") + f"""
SELECT event_id, source, {joined('cats')} AS categories, len(cats) AS category_count, {weigh} AS source_credibility
FROM (SELECT *, {categories} AS cats FROM (SELECT *, {labels(lx.NEWS_CATEGORIES)} AS c FROM news))"""
    log = """
log AS (
  SELECT CAST(event_id AS VARCHAR) AS run_id, event_type AS pipeline, ts AS started_at,
         CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
         CAST(round(value * 1000) AS BIGINT) AS ms,
         CASE WHEN event_type = 'error' THEN 'user ' || user_id END AS error FROM events)"""
    sql["runs_summary"] = ctes(log) + """
SELECT pipeline, count(*) AS total_runs, count(*) - count(*) FILTER (status = 'failed') AS successful,
       count(*) FILTER (status = 'failed') AS failed,
       round((count(*) - count(*) FILTER (status = 'failed')) / CAST(count(*) AS DOUBLE) * 100, 6) AS success_rate,
       round(avg(ms), 6) AS avg_duration_ms FROM log GROUP BY pipeline"""
    latest = """(SELECT '{0}' AS list, run_id, pipeline, status, strftime(started_at, '%Y-%m-%d %H:%M:%S') AS started_at,
        CAST(ms AS DOUBLE) AS duration_ms, error FROM log {1} ORDER BY log.started_at DESC, run_id LIMIT 10)"""
    sql["runs_recent"] = ctes(log) + latest.format("recent", "") + " UNION ALL " + latest.format(
        "failed", "WHERE status = 'failed'"
    )
    return sql
