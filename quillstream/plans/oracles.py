"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

They run on views named after the driver tables. Column names match the Spark
results exactly. Window functions and cross joins are fine here: DuckDB only
checks results at a small scale.
"""

from __future__ import annotations


def _tokens_of(col: str) -> str:
    """The single-space splitter: empty -> one empty token, all spaces -> none,
    else split the right-trimmed text on every space."""
    return (
        f"CASE WHEN {col} = '' THEN [''] "
        f"WHEN rtrim({col}, ' ') = '' THEN []::VARCHAR[] "
        f"ELSE string_split(rtrim({col}, ' '), ' ') END"
    )


def _lines_of(col: str) -> str:
    return (
        f"CASE WHEN {col} = '' THEN []::VARCHAR[] "
        rf"ELSE regexp_split_to_array(regexp_replace({col}, '(\r\n|\r|\n)\z', ''), '\r\n|\r|\n') END"
    )


TOKENS = f"tokens AS (SELECT doc_id, unnest({_tokens_of('text')}) AS word FROM documents)"

LOG = (
    "log AS (SELECT lang AS topic, CAST(doc_id % 3 AS INTEGER) AS \"partition\", "
    "row_number() OVER (PARTITION BY lang, doc_id % 3 ORDER BY doc_id) - 1 AS \"offset\", "
    "text AS value FROM documents)"
)

RANGES = (
    LOG
    + ", ends AS (SELECT topic, \"partition\", max(\"offset\") + 1 AS end_offset FROM log GROUP BY 1, 2)"
    ", last AS (SELECT max((end_offset - 1) // 10) AS last_batch FROM ends)"
    ", b AS (SELECT unnest(range(0, last_batch + 1)) AS batch_id FROM last)"
    ", ranges AS (SELECT b.batch_id, e.topic, e.\"partition\", "
    "least(b.batch_id * 10, e.end_offset) AS from_offset, "
    "least((b.batch_id + 1) * 10, e.end_offset) AS until_offset FROM ends e CROSS JOIN b)"
)

LEDGER = (
    RANGES
    + ", ledger AS (SELECT topic, \"partition\", batch_id, "
    "printf('topic=%s;partition=%d;fromOffset=%d;untilOffset=%d', topic, \"partition\", from_offset, until_offset) AS stats "
    "FROM ranges QUALIFY row_number() OVER (PARTITION BY topic, \"partition\" ORDER BY batch_id DESC) = 1)"
)

STARTS = (
    LEDGER
    + ", starts AS (SELECT topic, \"partition\", "
    "CAST(split_part(split_part(stats, ';', 3), '=', 2) AS BIGINT) AS start_offset FROM ledger)"
    ", resumed AS (SELECT l.topic, l.\"partition\", l.\"offset\", l.value FROM log l "
    "JOIN starts s ON l.topic = s.topic AND l.\"partition\" = s.\"partition\" "
    "WHERE l.\"offset\" >= s.start_offset)"
)

CELLS = (
    "cells AS (SELECT CAST(user_id AS VARCHAR) AS row_key, 'w1' AS family, event_type AS qualifier, "
    "ts, event_id AS seq, CAST(value AS VARCHAR) AS value FROM events)"
)

NEWEST = (
    "newest AS (SELECT row_key, family, qualifier, ts, value FROM cells "
    "QUALIFY row_number() OVER (PARTITION BY row_key, family, qualifier ORDER BY ts DESC, seq DESC) = 1)"
)

CUT = "TIMESTAMP '2024-01-15 00:00:00'"

ORACLES: dict[str, str] = {
    "words": f"WITH {TOKENS} SELECT doc_id, word FROM tokens",
    "word_count": f"WITH {TOKENS} SELECT word, count(*) AS total FROM tokens GROUP BY word",
    "word_count_pairs": f"WITH {TOKENS} SELECT word, CAST(count(*) AS INTEGER) AS total FROM tokens GROUP BY word",
    "word_count_sql": f"WITH {TOKENS} SELECT word, count(*) AS total FROM tokens GROUP BY word",
    "line_word_count": (
        f"WITH lines AS (SELECT unnest({_lines_of('text')}) AS line FROM documents), "
        f"words AS (SELECT unnest({_tokens_of('line')}) AS word FROM lines) "
        "SELECT word, count(*) AS total FROM words GROUP BY word"
    ),
    "top_words": (
        f"WITH {TOKENS} SELECT word, count(*) AS total FROM tokens GROUP BY word "
        "ORDER BY total DESC, word ASC LIMIT 10"
    ),
    "two_topic_word_count": (
        "WITH m AS (SELECT 'documents' AS topic, text AS value FROM documents "
        "UNION ALL SELECT 'conversations' AS topic, text AS value FROM conversations), "
        f"w AS (SELECT topic, unnest({_tokens_of('value')}) AS word FROM m) "
        "SELECT topic, word, count(*) AS total FROM w GROUP BY topic, word"
    ),
    "topic_messages": f"WITH {LOG} SELECT topic, \"partition\", \"offset\", value FROM log WHERE topic IN ('en', 'de')",
    "batch_word_count": (
        f"WITH {LOG}, w AS (SELECT \"offset\" // 10 AS batch_id, unnest({_tokens_of('value')}) AS word FROM log) "
        "SELECT batch_id, word, count(*) AS total FROM w GROUP BY batch_id, word"
    ),
    "offset_ranges": f"WITH {RANGES} SELECT batch_id, topic, \"partition\", from_offset, until_offset FROM ranges",
    "offset_ledger": f"WITH {LEDGER} SELECT topic, \"partition\", batch_id, stats FROM ledger",
    "resume_offsets": f"WITH {STARTS} SELECT topic, \"partition\", start_offset FROM starts",
    "resume_messages": f"WITH {STARTS} SELECT topic, \"partition\", \"offset\", value FROM resumed",
    "resume_word_count": (
        f"WITH {STARTS}, w AS (SELECT unnest({_tokens_of('value')}) AS word FROM resumed) "
        "SELECT word, count(*) AS total FROM w GROUP BY word"
    ),
    "word_cells": (
        f"WITH {TOKENS} SELECT word AS row_key, 'w1' AS family, 'total' AS qualifier, "
        "CAST(count(*) AS VARCHAR) AS value FROM tokens GROUP BY word"
    ),
    "cell_scan": f"WITH {CELLS}, {NEWEST} SELECT row_key, family, qualifier, ts, value FROM newest",
    "cell_key_values": (
        f"WITH {CELLS}, {NEWEST} SELECT concat_ws('/', row_key, family || ':' || qualifier, "
        "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')) AS key, value FROM newest"
    ),
    "cell_rows": (
        f"WITH {CELLS}, {NEWEST} SELECT row_key, string_agg(family || ':' || qualifier || '=' || "
        "coalesce(value, ''), ';' ORDER BY family || ':' || qualifier) AS cells FROM newest GROUP BY row_key"
    ),
    "cell_upsert": (
        f"WITH events_{CELLS}, cells AS ("
        "SELECT * FROM events_cells "
        "UNION ALL "
        f"SELECT row_key, family, qualifier, CASE WHEN seq % 2 = 0 OR ts >= {CUT} THEN ts ELSE {CUT} END AS ts, "
        "CASE WHEN seq % 2 = 0 THEN seq - 1099511627776 ELSE 1099511627776 - seq END AS seq, value || '!' AS value "
        f"FROM events_cells), {NEWEST} SELECT row_key, family, qualifier, ts, value FROM newest"
    ),
    "last_value_per_key": "SELECT user_id, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY user_id",
    # a row is in the window of its own five minutes and in the one before
    "sliding_count": (
        "WITH w AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 5 MINUTE * k AS window_start, event_type "
        "FROM events, (VALUES (0), (1)) AS v(k) WHERE ts IS NOT NULL) "
        "SELECT window_start, event_type, count(*) AS n FROM w GROUP BY window_start, event_type"
    ),
}
