"""The same queries as SQL for a second engine, over the same tables."""

from __future__ import annotations

from moodline.plans import adapters
from moodline.plans.queries import CAP_OF_TEST, RATE_WINDOW_OF_TEST_S, SAMPLE_SEED

_TIME = "'%Y-%m-%d %H:%M:%S.%f'"



# -- messages -------------------------------------------------------------------

_MESSAGES = """
messages AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, text,
         strftime(TIMESTAMP '2025-01-01' + doc_id * INTERVAL 1 SECOND, '%Y-%m-%dT%H:%M:%S') AS created,
         TIMESTAMP '2025-01-01' + doc_id * INTERVAL 1 SECOND AS event_time,
         source AS author_id, lang, source AS client, doc_id AS seq, n_chars,
         CASE WHEN doc_id % 25 <> 7 THEN doc_id % 97 END AS like_count,
         CASE WHEN doc_id % 25 <> 7 THEN doc_id % 7 END AS bookmark_count,
         CASE WHEN doc_id % 25 <> 7 THEN doc_id % 11 END AS reply_count,
         CASE WHEN doc_id % 25 <> 7 THEN doc_id % 3 END AS quote_count,
         CASE WHEN doc_id % 25 <> 7 THEN n_chars % 13 END AS retweet_count,
         CASE WHEN doc_id % 25 <> 7 THEN n_chars % 1009 END AS impression_count
  FROM documents)"""

_CLEAN = f"""{_MESSAGES},
clean AS (SELECT * FROM messages WHERE text IS NOT NULL AND lang = 'en' AND length(text) > 20)"""

# -- scores: ``texts`` (k, text) to ``scores`` (k, …) ------------------------------

_LEXICON = "lexicon AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{w}', {v}, {p}, {s})" for w, v, p, s in adapters.LEXICON_ROWS
) + ") t(token, valence, polarity, subjectivity))"


def _scores(level: int = 0) -> str:
    """CTEs from ``texts`` to ``scores``, with window functions over the tokens."""
    reach = range(1, 4)
    plain = "CAST(valence AS BIGINT) * 10000000"
    value = plain
    if level >= 3:
        value = (
            f"({value} + CASE WHEN loud_count > 0 AND loud_count < n AND loud "
            f"THEN sign({plain}) * 73300000 ELSE 0 END)"
        )
    if level >= 2:
        for d in reach:
            step = {1: 29300000, 2: 27835000, 3: 26370000}[d]
            value = (
                f"({value} + sign({plain}) * CASE WHEN before{d} IN ('the') THEN {step} "
                f"WHEN before{d} IN ('and') THEN -{step} ELSE 0 END)"
            )
    if level >= 1:
        negated = " OR ".join(f"coalesce(before{d} IN ('no'), false)" for d in reach)
        value = f"({value} * CASE WHEN {negated} THEN -74 ELSE 100 END // 100)"
    if level >= 3:
        value = (
            f"({value} * CASE WHEN pos < but THEN 50 "
            f"WHEN pos > but THEN 150 ELSE 100 END // 100)"
        )
    marks = "0"
    if level >= 3:
        marks = (
            f"least(length(text) - length(replace(text, '!', '')), 4) * 29200000"
        )
    before = ", ".join(f"lag(token, {d}) OVER w AS before{d}" for d in reach)
    return f"""
{_LEXICON},
lists AS (SELECT k, regexp_extract_all(text, '[A-Za-z'']+') AS list FROM texts),
raw AS (SELECT k, unnest(list) AS word, unnest(range(len(list))) AS pos FROM lists),
lowered AS (SELECT k, pos, lower(word) AS token, upper(word) = word AND lower(word) <> word AS loud FROM raw),
placed AS (
  SELECT k, pos, token, loud, count(*) OVER whole AS n, count(*) FILTER (loud) OVER whole AS loud_count,
         min(pos) FILTER (token = 'but') OVER whole AS but, {before}
  FROM lowered WINDOW w AS (PARTITION BY k ORDER BY pos), whole AS (PARTITION BY k)),
valued AS (
  SELECT k, l.token AS found, l.polarity, l.subjectivity, coalesce(CAST({value} AS BIGINT), 0) AS v
  FROM placed LEFT JOIN lexicon l USING (token)),
sums AS (
  SELECT k, CAST(sum(v) AS BIGINT) AS total,
         CAST(coalesce(sum(v + 100000000) FILTER (v > 0), 0) AS BIGINT) AS up,
         CAST(coalesce(sum(100000000 - v) FILTER (v < 0), 0) AS BIGINT) AS down,
         count(*) FILTER (v = 0) * 100000000 AS flat,
         count(found) AS hits, CAST(sum(polarity) AS BIGINT) AS polarity, CAST(sum(subjectivity) AS BIGINT) AS subjectivity
  FROM valued GROUP BY k),
marked AS (
  SELECT texts.k, text, coalesce(total, 0) AS total, coalesce(up, 0) AS up, coalesce(down, 0) AS down,
         coalesce(flat, 0) AS flat, coalesce(hits, 0) AS hits, polarity, subjectivity,
         CAST({marks} AS BIGINT) AS marks
  FROM texts LEFT JOIN sums ON texts.k = sums.k),
emphasised AS (
  SELECT k, text, (total + sign(total) * marks) / 100000000.0::DOUBLE AS s,
         up + CASE WHEN up > down THEN marks ELSE 0 END AS up,
         down + CASE WHEN down > up THEN marks ELSE 0 END AS down,
         flat, hits, polarity, subjectivity
  FROM marked),
scores AS (
  SELECT k,
         CASE WHEN text IS NULL THEN 0.0::DOUBLE ELSE round(s / sqrt(s * s + 15), 4) END AS compound,
         CASE WHEN text IS NULL THEN 0.0::DOUBLE ELSE coalesce(round(up / nullif(up + down + flat, 0), 3), 0) END AS positive,
         CASE WHEN text IS NULL THEN 0.0::DOUBLE ELSE coalesce(round(down / nullif(up + down + flat, 0), 3), 0) END AS negative,
         CASE WHEN text IS NULL THEN 1.0::DOUBLE ELSE coalesce(round(flat / nullif(up + down + flat, 0), 3), 0) END AS neutral,
         coalesce(polarity / nullif(hits * 1000, 0), 0.0::DOUBLE) AS polarity,
         coalesce(subjectivity / nullif(hits * 1000, 0), 0.0::DOUBLE) AS subjectivity
  FROM emphasised)"""


def _compound_label(value: str) -> str:
    return f"CASE WHEN {value} >= 0.05::DOUBLE THEN 'positive' WHEN {value} <= -0.05::DOUBLE THEN 'negative' ELSE 'neutral' END"


def _strict_label(value: str, otherwise: str = "neutral") -> str:
    return f"CASE WHEN {value} > 0.1::DOUBLE THEN 'positive' WHEN {value} < -0.1::DOUBLE THEN 'negative' ELSE '{otherwise}' END"


def _score_query(level: int, texts: str = "SELECT doc_id AS k, text FROM documents") -> str:
    return f"""
WITH texts AS ({texts}), {_scores(level)}
SELECT CAST(k AS VARCHAR) AS id, compound, positive, negative, neutral, polarity, subjectivity,
       {_compound_label('compound')} AS compound_sentiment, {_strict_label('polarity')} AS polarity_sentiment
FROM scores"""


_RESULTS = f"""{_CLEAN},
texts AS (SELECT seq AS k, text FROM clean), {_scores()},
results AS (
  SELECT client, seq, text, event_time, compound AS compound_score,
         {_compound_label('compound')} AS compound_sentiment, polarity AS polarity_score,
         n_chars / 1000000.0::DOUBLE AS processing_time
  FROM clean JOIN scores ON seq = k)"""

# -- packets ------------------------------------------------------------------------

_RECEIVED = f"""{_MESSAGES},
received AS (
  SELECT *, CASE WHEN seq % 50 = 5 THEN 'best ' || text ELSE text END AS chosen
  FROM messages WHERE seq % 50 NOT IN (0, 1, 2, 3) AND length(text) > 0)"""

_RECEIVED_RESULTS = f"""{_RECEIVED},
texts AS (SELECT seq AS k, chosen AS text FROM received), {_scores()},
results AS (
  SELECT client, seq, id AS tweet_id, CAST(seq % 90000 + 10000 AS INTEGER) AS stream_id, md5(chosen) AS text_md5,
         length(text) AS original_length, created AS timestamp, event_time,
         '2025-01-01T00:00:00.000000' AS processed_at,
         polarity AS polarity_score, subjectivity AS polarity_subjectivity,
         {_strict_label('polarity')} AS polarity_sentiment,
         compound AS compound_score, positive AS compound_positive, negative AS compound_negative,
         neutral AS compound_neutral, {_compound_label('compound')} AS compound_sentiment,
         length(text) / 1000000.0::DOUBLE AS processing_time
  FROM received JOIN scores ON seq = k)"""

_RECEIVED_COLUMNS = """client, seq, tweet_id, stream_id, text_md5, original_length, timestamp, processed_at,
  polarity_score, polarity_subjectivity, polarity_sentiment, compound_score, compound_positive, compound_negative,
  compound_neutral, compound_sentiment, processing_time"""

# -- batches: ``results`` to ``batched`` and ``summary`` ---------------------------------

_BATCHED = """
batched AS (
  SELECT *, arrival, (arrival - 1) // 10 + 1 AS batch_id
  FROM (SELECT *, row_number() OVER (PARTITION BY client ORDER BY seq) AS arrival FROM results))"""

_COUNTS = """count(*) FILTER (compound_sentiment = 'positive') AS positive_count,
  count(*) FILTER (compound_sentiment = 'negative') AS negative_count,
  count(*) FILTER (compound_sentiment = 'neutral') AS neutral_count"""


def _percentages(total: str) -> str:
    return ", ".join(f"{x}_count / {total} * 100 AS {x}_pct" for x in ("positive", "negative", "neutral"))


_STEPS = "CAST(sum(CAST(round(compound_score * 10000) AS BIGINT)) AS BIGINT)"
_MICROS = "CAST(sum(CAST(round(processing_time * 1000000) AS BIGINT)) AS BIGINT)"

_SUMMARY = f"""{_BATCHED},
sums_of_batches AS (
  SELECT client, batch_id, count(*) AS batch_size, {_COUNTS}, {_STEPS} AS steps, {_MICROS} AS micros,
         (epoch_us(max(event_time)) - epoch_us(min(event_time))) / 1000000.0::DOUBLE AS duration_s
  FROM batched GROUP BY client, batch_id),
summary AS (
  SELECT client, batch_id, batch_size, positive_count, negative_count, neutral_count, {_percentages('batch_size')},
         steps / batch_size / 10000.0::DOUBLE AS mean_compound, micros / batch_size / 1000.0::DOUBLE AS mean_processing_ms,
         duration_s, {_strict_label('steps / batch_size / 10000.0::DOUBLE', 'balanced')} AS trend
  FROM sums_of_batches)"""

_RUNNING = f"""
running AS (
  SELECT client, arrival AS total, (arrival - 1) // 10 + 1 AS batch_id,
         count(*) FILTER (compound_sentiment = 'positive') OVER w AS positive_count,
         count(*) FILTER (compound_sentiment = 'negative') OVER w AS negative_count,
         count(*) FILTER (compound_sentiment = 'neutral') OVER w AS neutral_count,
         CAST(sum(CAST(round(processing_time * 1000000) AS BIGINT)) OVER last100 AS BIGINT)
           / least(arrival, 100) / 1000.0::DOUBLE AS recent_mean_processing_ms,
         CAST(sum(CAST(round(compound_score * 10000) AS BIGINT)) OVER last50 AS BIGINT)
           / least(arrival, 50) / 10000.0::DOUBLE AS recent_mean_compound,
         list(compound_sentiment) OVER last5 AS last_labels
  FROM batched
  WINDOW w AS (PARTITION BY client ORDER BY arrival ROWS UNBOUNDED PRECEDING),
         last100 AS (PARTITION BY client ORDER BY arrival ROWS BETWEEN 99 PRECEDING AND CURRENT ROW),
         last50 AS (PARTITION BY client ORDER BY arrival ROWS BETWEEN 49 PRECEDING AND CURRENT ROW),
         last5 AS (PARTITION BY client ORDER BY arrival ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)),
ends AS (SELECT * FROM running WHERE total % 10 = 0)"""


def _symbols(labels: str) -> str:
    symbol = "CASE x WHEN 'positive' THEN '😊' WHEN 'negative' THEN '😞' WHEN 'neutral' THEN '😐' ELSE '🤔' END"
    return f"array_to_string(list_transform({labels}, lambda x: {symbol}), ' → ')"


# -- delivery log -------------------------------------------------------------------------

_LOG = """
log AS (
  SELECT event_id AS seq, ts AS event_time, epoch_us(ts) AS us, CAST(user_id AS VARCHAR) AS client,
         CASE event_type WHEN 'signup' THEN 'client_connected' WHEN 'purchase' THEN 'client_disconnected'
                         WHEN 'error' THEN 'error' ELSE 'tweet_sent' END AS action
  FROM events),
steps AS (
  SELECT *, CASE action WHEN 'client_connected' THEN 1 WHEN 'client_disconnected' THEN -1 ELSE 0 END AS step FROM log)"""

_SESSIONS = f"""{_LOG},
numbered AS (
  SELECT *, count(*) FILTER (action = 'client_connected') OVER w AS session,
         last_value(CASE WHEN step <> 0 THEN step END IGNORE NULLS) OVER w AS latest
  FROM steps WINDOW w AS (PARTITION BY client ORDER BY us, seq ROWS UNBOUNDED PRECEDING)),
sessions AS (
  SELECT client, session, min(event_time) FILTER (step = 1) AS connected_at,
         min(event_time) FILTER (step = -1) AS disconnected_at,
         max(event_time) FILTER (action = 'tweet_sent' AND latest = 1) AS last_sent_at,
         count(*) FILTER (action = 'tweet_sent' AND latest = 1) AS sent
  FROM numbered WHERE session > 0 GROUP BY client, session)"""


def _trailing(seconds: int, keys: str = "") -> str:
    return f"""
SELECT {keys} seq, count(*) OVER ({'PARTITION BY client' if keys else ''} ORDER BY us
         RANGE BETWEEN {seconds * 1_000_000 - 1} PRECEDING AND CURRENT ROW) AS sends
FROM log WHERE action = 'tweet_sent'"""


def _rates(total: str, uptime: str) -> str:
    return f"""{total} / nullif({uptime} / 60, 0) AS average_rate,
  coalesce(least({total}, 60) / nullif(least({uptime}, 60.0::DOUBLE), 0) * 60, 0.0::DOUBLE) AS recent_average_rate"""


_LOG_TOTALS = """
totals AS (
  SELECT count(*) FILTER (action = 'tweet_sent') AS total_sent,
         count(*) FILTER (action = 'client_connected') AS total_connections,
         CAST(sum(step) AS BIGINT) AS active_connections,
         count(*) FILTER (action = 'error') AS errors,
         count(*) FILTER (action = 'tweet_sent' AND us > (SELECT max(us) FROM log) - 60000000) AS recent,
         max(event_time) AS last_activity,
         (max(us) - min(us)) / 1000000.0::DOUBLE AS uptime_s
  FROM steps)"""

# -- draws ---------------------------------------------------------------------------------


def _hash(*parts: str) -> str:
    return f"('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 15))::BIGINT"


_DRAWS = f"""{_CLEAN},
indexed AS (SELECT *, row_number() OVER (ORDER BY seq) - 1 AS idx FROM clean),
clients AS (SELECT DISTINCT CAST(conv_id AS VARCHAR) AS drawn_for FROM conversations),
draws AS (
  SELECT drawn_for, draw, {_hash(f"'{SAMPLE_SEED}'", 'drawn_for', 'draw')} % (SELECT count(*) FROM clean) AS idx,
         CAST({_hash(f"'{SAMPLE_SEED}'", "'stream'", 'drawn_for', 'draw')} % 90000 + 10000 AS INTEGER) AS stream_id
  FROM clients, range(1, 51) r(draw))"""

_METRICS = "like_count, bookmark_count, reply_count, quote_count, retweet_count, impression_count"

ORACLE_SQL: dict[str, str] = {
    "read_messages": f"""WITH {_MESSAGES}
SELECT id, text, created || '+00:00' AS created_at, author_id, lang, {_METRICS}, client AS first_entity FROM messages""",
    "clean_messages": f"""WITH {_CLEAN}
SELECT id, text, created || '+00:00' AS created_at, author_id, {_METRICS} FROM clean""",
    "preview": f"""WITH {_CLEAN}
SELECT id, substring(text, 1, 60) || '...' AS text FROM clean ORDER BY seq LIMIT 3""",
    "build_packets": f"""WITH {_MESSAGES}
SELECT id, text, created || '+00:00' AS original_created_at, author_id, {_METRICS}, created AS stream_timestamp,
       CAST(seq % 90000 + 10000 AS INTEGER) AS stream_id, 'localhost' AS server_host, 9999 AS server_port,
       CAST(seq % 5 AS INTEGER) AS active_clients, seq AS total_tweets_sent, seq / 2 AS server_uptime,
       client AS client_ip, client, seq
FROM messages""",
    "packet_json": f"""WITH {_MESSAGES}
SELECT id, text, like_count, CASE WHEN like_count IS NULL THEN 0::BIGINT ELSE 6::BIGINT END AS metrics,
       client AS client_ip, seq AS total_tweets_sent
FROM messages""",
    "parse_packets": f"""WITH {_MESSAGES}
SELECT seq AS doc_id, seq % 50 IN (0, 1, 3) AS is_control,
       CASE WHEN seq % 50 NOT IN (0, 1) THEN id END AS id, CASE WHEN seq % 50 NOT IN (0, 1) THEN text END AS text,
       CASE WHEN seq % 50 NOT IN (0, 1) THEN CAST(seq % 90000 + 10000 AS INTEGER) END AS stream_id
FROM messages WHERE seq % 50 <> 2""",
    "rejected_lines": "SELECT doc_id FROM documents WHERE doc_id % 50 = 2",
    "drop_control": f"""WITH {_MESSAGES}
SELECT seq AS doc_id, id, client, seq, 9999 AS server_port FROM messages WHERE seq % 50 NOT IN (0, 1, 2, 3)""",
    "control_messages": """
SELECT doc_id, CASE doc_id % 50 WHEN 0 THEN 'welcome' WHEN 1 THEN 'completion' END AS type,
       CASE doc_id % 50 WHEN 0 THEN 'hello ' || doc_id WHEN 1 THEN 'done ' || doc_id END AS message,
       CASE doc_id % 50 WHEN 0 THEN CAST(doc_id AS VARCHAR) ELSE 'unknown' END AS total_tweets_available
FROM documents WHERE doc_id % 50 IN (0, 1, 3)""",
    "reject_report": """
SELECT count(*) AS lines, count(*) FILTER (doc_id % 50 = 2) AS bad_lines,
       count(*) FILTER (doc_id % 50 = 0) AS welcome_messages, count(*) FILTER (doc_id % 50 = 1) AS completion_messages,
       count(*) FILTER (doc_id % 50 = 3) AS other_control_messages, count(*) FILTER (doc_id % 50 > 3) AS packets
FROM documents""",
    "pick_text": f"""WITH {_RECEIVED}
SELECT seq AS doc_id, chosen AS text, text AS original_text, created AS timestamp FROM received""",
    "received_results": f"WITH {_RECEIVED_RESULTS} SELECT {_RECEIVED_COLUMNS} FROM results",
    "tokens": f"""WITH {_CLEAN}, lists AS (SELECT id, regexp_extract_all(text, '[A-Za-z'']+') AS list FROM clean)
SELECT id, pos, lower(token) AS token
FROM (SELECT id, unnest(list) AS token, unnest(range(len(list))) AS pos FROM lists)""",
    "score_documents": _score_query(0),
    "score_negation": _score_query(1),
    "score_boosters": _score_query(2),
    "score_emphasis": _score_query(3),
    "label_boundaries": f"""
SELECT doc_id, {_compound_label('x')} AS compound_sentiment, {_strict_label('x')} AS polarity_sentiment,
       {_strict_label('x', 'balanced')} AS trend
FROM (SELECT doc_id, (doc_id % 401 - 200) / 2000.0::DOUBLE AS x FROM documents)""",
    "sentiment_totals": f"""WITH {_RESULTS}, counted AS (SELECT count(*) AS total, {_COUNTS} FROM results)
SELECT *, {_percentages('total')} FROM counted WHERE total > 0""",
    "assign_batches": f"WITH {_RESULTS}, {_BATCHED} SELECT client, seq, arrival, batch_id FROM batched",
    "batch_summary": f"WITH {_RESULTS}, {_SUMMARY} SELECT * FROM summary",
    "full_batches": f"""WITH {_RESULTS}, {_BATCHED}
SELECT client, batch_id, seq, compound_score, compound_sentiment
FROM (SELECT *, count(*) OVER (PARTITION BY client, batch_id) AS n FROM batched) WHERE n = 10""",
    "running_totals": f"""WITH {_RESULTS}, {_BATCHED}, {_RUNNING}
SELECT client, batch_id, total, positive_count, negative_count, neutral_count, {_percentages('total')},
       recent_mean_processing_ms FROM ends""",
    "final_sentiment": f"""WITH {_RESULTS}, last AS (SELECT * FROM results ORDER BY seq DESC LIMIT 50),
sums_of_last AS (SELECT count(*) AS results, {_STEPS} / count(*) / 10000.0::DOUBLE AS mean_compound FROM last)
SELECT results, mean_compound, {_strict_label('mean_compound', 'balanced')} AS trend FROM sums_of_last WHERE results > 1""",
    "final_sentiment_by_client": f"""WITH {_RESULTS},
ranked AS (SELECT *, row_number() OVER (PARTITION BY client ORDER BY seq DESC) AS r FROM results),
sums_of_last AS (SELECT client, count(*) AS results, {_STEPS} / count(*) / 10000.0::DOUBLE AS mean_compound
                 FROM ranked WHERE r <= 20 GROUP BY client)
SELECT client, results, mean_compound, {_strict_label('mean_compound', 'balanced')} AS trend
FROM sums_of_last WHERE results > 1""",
    "recent_trend": f"""WITH {_RESULTS}, last AS (SELECT * FROM results ORDER BY seq DESC LIMIT 5),
listed AS (SELECT list(compound_sentiment ORDER BY seq) AS l FROM last)
SELECT array_to_string(l, ' → ') AS labels, {_symbols('l')} AS symbols FROM listed WHERE len(l) >= 5""",
    "recent_trend_by_client": f"""WITH {_RESULTS},
ranked AS (SELECT *, row_number() OVER (PARTITION BY client ORDER BY seq DESC) AS r FROM results),
listed AS (SELECT client, list(compound_sentiment ORDER BY seq) AS l FROM ranked WHERE r <= 5 GROUP BY client)
SELECT client, array_to_string(l, ' → ') AS labels, {_symbols('l')} AS symbols FROM listed WHERE len(l) >= 5""",
    "processing_stats": f"""
WITH last AS (SELECT value / 1000 AS processing_time FROM events ORDER BY event_id DESC LIMIT 100)
SELECT count(*) AS results, {_MICROS} / count(*) / 1000.0::DOUBLE AS mean_ms,
       min(processing_time) * 1000 AS min_ms, max(processing_time) * 1000 AS max_ms
FROM last""",
    "processing_stats_by_client": f"""
WITH ranked AS (SELECT CAST(user_id AS VARCHAR) AS client, value / 1000 AS processing_time,
                       row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events)
SELECT client, count(*) AS results, {_MICROS} / count(*) / 1000.0::DOUBLE AS mean_ms,
       min(processing_time) * 1000 AS min_ms, max(processing_time) * 1000 AS max_ms
FROM ranked WHERE r <= 50 GROUP BY client""",
    "report_lines": f"""WITH {_RESULTS}, {_BATCHED}
SELECT client, seq, substring(text, 1, 120) || CASE WHEN length(text) > 120 THEN '...' ELSE '' END AS shown_text,
       CASE compound_sentiment WHEN 'positive' THEN '😊' WHEN 'negative' THEN '😞' ELSE '😐' END
         || ' ' || upper(compound_sentiment) AS shown_label,
       round(compound_score, 3) AS shown_score, round(processing_time * 1000, 3) AS shown_ms,
       repeat('█', (arrival - 1) % 10 + 1) || repeat('░', 9 - (arrival - 1) % 10) AS progress,
       strftime(event_time, '%H:%M:%S') AS shown_time, format('{{:,}}', seq * 1000) AS shown_count
FROM batched""",
    "log_totals": f"""WITH {_LOG}, {_LOG_TOTALS}
SELECT total_sent, total_connections, errors, strftime(last_activity, {_TIME}) AS last_activity FROM totals""",
    "active_connections": f"""WITH {_LOG}
SELECT seq, action, CAST(sum(step) OVER (ORDER BY us, seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS active FROM steps""",
    "packet_counters": f"""WITH {_LOG},
counted AS (
  SELECT *, count(*) FILTER (action = 'tweet_sent') OVER w - 1 AS total_sent_before,
         CAST(sum(step) OVER w AS BIGINT) AS active_clients
  FROM steps WINDOW w AS (ORDER BY us, seq ROWS UNBOUNDED PRECEDING))
SELECT seq, total_sent_before, active_clients FROM counted WHERE action = 'tweet_sent'""",
    "trailing_rate": f"WITH {_LOG} SELECT *, least(sends, 60) AS sends_capped FROM ({_trailing(60)})",
    "trailing_rate_hour": f"""WITH {_LOG}
SELECT *, least(sends, 5) AS sends_capped FROM ({_trailing(RATE_WINDOW_OF_TEST_S)})""",
    "trailing_rate_by_client": f"WITH {_LOG} {_trailing(24 * RATE_WINDOW_OF_TEST_S, 'client,')}",
    "client_stats": f"""WITH {_SESSIONS},
latest AS (SELECT *, row_number() OVER (PARTITION BY client ORDER BY session DESC) AS r FROM sessions)
SELECT client, session, sent, strftime(connected_at, {_TIME}) AS connected_at,
       strftime(last_sent_at, {_TIME}) AS last_sent_at,
       ((SELECT max(us) FROM log) - epoch_us(connected_at)) / 1000000.0::DOUBLE AS connected_s, 'streaming' AS status
FROM latest WHERE r = 1 AND disconnected_at IS NULL""",
    "session_durations": f"""WITH {_SESSIONS}
SELECT client, session, sent, (epoch_us(disconnected_at) - epoch_us(connected_at)) / 1000000.0::DOUBLE AS duration_s
FROM sessions WHERE disconnected_at IS NOT NULL""",
    "connection_history": f"""WITH {_LOG}
SELECT strftime(event_time, '%H:%M:%S') AS at, client AS client_ip,
       CASE WHEN step = 1 THEN 'connect' ELSE 'disconnect' END AS action
FROM steps WHERE step <> 0 ORDER BY us DESC, seq DESC LIMIT 3""",
    "average_rate": f"""WITH {_LOG}, {_LOG_TOTALS}
SELECT uptime_s, total_sent, {_rates('total_sent', 'uptime_s')} FROM totals""",
    "session_cap": f"""WITH {_SESSIONS}
SELECT client, session, seq, delivery
FROM (SELECT *, row_number() OVER (PARTITION BY client, session ORDER BY us, seq) AS delivery
      FROM numbered WHERE action = 'tweet_sent' AND latest = 1)
WHERE delivery <= {CAP_OF_TEST}""",
    "status_snapshot": f"""WITH {_LOG}, {_LOG_TOTALS}, {_CLEAN}
SELECT uptime_s, total_sent, least(recent, 60) AS sends_per_minute, active_connections, total_connections, errors,
       (SELECT count(*) FROM clean) AS available, {_rates('total_sent', 'uptime_s')},
       CASE WHEN active_connections > 0 THEN 'STREAMING' ELSE 'WAITING' END AS status
FROM totals""",
    "draw_with_replacement": f"""WITH {_DRAWS}
SELECT drawn_for AS client, draw, id, stream_id FROM draws JOIN indexed USING (idx)""",
    "serve_and_analyse": f"""WITH {_DRAWS},
drawn AS (
  SELECT drawn_for AS client, draw AS seq, seq AS doc, event_time, text FROM draws JOIN indexed USING (idx)),
texts AS (SELECT seq AS k, text FROM clean), {_scores()},
results AS (
  SELECT client, seq, event_time, compound AS compound_score, {_compound_label('compound')} AS compound_sentiment,
         length(text) / 1000000.0::DOUBLE AS processing_time
  FROM drawn JOIN scores ON doc = k), {_SUMMARY}
SELECT * FROM summary""",
    "stream_scores": f"WITH {_RECEIVED_RESULTS} SELECT {_RECEIVED_COLUMNS} FROM results",
    "stream_batches": f"""WITH {_RECEIVED_RESULTS}, {_SUMMARY}, {_RUNNING}
SELECT s.*, e.total, e.positive_count AS positive_total, e.negative_count AS negative_total,
       e.neutral_count AS neutral_total, recent_mean_processing_ms, recent_mean_compound,
       {_symbols('last_labels')} AS recent_symbols
FROM summary s JOIN ends e ON s.client = e.client AND s.batch_id = e.batch_id""",
    "stream_rejects": "SELECT count(*) AS bad_lines FROM documents WHERE doc_id % 50 = 2",
    "batch_reports": f"""WITH {_RESULTS}, {_SUMMARY}, {_RUNNING}
SELECT s.*, e.total, e.positive_count AS positive_total, e.negative_count AS negative_total,
       e.neutral_count AS neutral_total, recent_mean_processing_ms, recent_mean_compound,
       {_symbols('last_labels')} AS recent_symbols
FROM summary s JOIN ends e ON s.client = e.client AND s.batch_id = e.batch_id""",
    "stream_label_counts": f"""WITH {_RECEIVED_RESULTS}
SELECT compound_sentiment AS label, count(*) AS results FROM results GROUP BY 1""",
    "stream_sends_per_minute": f"""WITH {_LOG},
stepped AS (
  SELECT (ceil(us / 5000000)::BIGINT + i) * 5000000 AS at_us
  FROM log, range(0, 12) r(i) WHERE action = 'tweet_sent')
SELECT strftime(make_timestamp(at_us), {_TIME}) AS at, count(*) AS sends FROM stepped GROUP BY at_us""",
    "stream_status": f"""WITH {_LOG}, {_LOG_TOTALS}
SELECT total_sent, total_connections, active_connections, errors,
       strftime(last_activity, {_TIME}) AS last_activity,
       CASE WHEN active_connections > 0 THEN 'STREAMING' ELSE 'WAITING' END AS status
FROM totals""",
}

ORACLE_SQL["stream_full_batches"] = f"""WITH {_RECEIVED_RESULTS}, {_BATCHED}
SELECT client, batch_id, seq, compound_score, compound_sentiment
FROM (SELECT *, count(*) OVER (PARTITION BY client, batch_id) AS n FROM batched) WHERE n = 10"""
ORACLE_SQL["stream_all_batches"] = f"WITH {_RECEIVED_RESULTS}, {_SUMMARY} SELECT * FROM summary"

ORACLE_SQL["score_spiced"] = _score_query(
    3,
    """SELECT doc_id AS k, CASE doc_id % 5 WHEN 1 THEN text || ' best but IDIOT!!' WHEN 2 THEN 'BEST trash no best BUT ' || text
       WHEN 3 THEN text || ' the best! and vile!!!!!' WHEN 4 THEN text END AS text FROM documents""",
)
ORACLE_SQL["report_values"] = f"""WITH {_RESULTS}
SELECT client, seq, format('{{:+.4f}}', compound_score) AS shown_signed,
       format('{{:.1f}}%', (seq % 8) / 8 * 100) AS shown_percent, format('{{:.3f}}ms', processing_time * 1000) AS shown_ms,
       strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') AS shown_iso, strftime(event_time, '%Y%m%d_%H%M%S') AS shown_stamp
FROM results"""

ORACLE_SQL["shown_history"] = f"""WITH {_LOG},
latest AS (SELECT * FROM steps WHERE step <> 0 ORDER BY us DESC, seq DESC LIMIT 3)
SELECT row_number() OVER (ORDER BY us, seq) AS place, strftime(event_time, '%H:%M:%S') AS at, client AS client_ip,
       CASE WHEN step = 1 THEN 'connect' ELSE 'disconnect' END AS action
FROM latest"""

# The same rows by another way through the library.
_SAME = {
    "score_documents_joined": "score_documents",
    "running_totals_chunked": "running_totals",
    "active_connections_chunked": "active_connections",
    "final_sentiment_interleaved": "final_sentiment",
    "recent_trend_interleaved": "recent_trend",
    "results_json": "received_results",
    "results_csv": "received_results",
    "received_from_files": "received_results",
    "full_batches_file": "full_batches",
    "full_batches_ranges": "full_batches",
    "batch_reports_chunked": "batch_reports",
    "sql_labels": "label_boundaries",
    "sql_batch_summary": "batch_summary",
    "sql_session_durations": "session_durations",
    "stream_batches_shuffled": "stream_batches",
    "stream_sessions": "session_durations",
    "stream_client_stats": "client_stats",
    "stream_trailing_rate": "trailing_rate",
    "stream_trailing_rate_hour": "trailing_rate_hour",
    "stream_connection_history": "shown_history",
    "stream_snapshot": "status_snapshot",
    "stream_compacted": "session_durations",
}
ORACLE_SQL.update({name: ORACLE_SQL[twin] for name, twin in _SAME.items()})
