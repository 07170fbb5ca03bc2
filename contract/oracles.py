"""DuckDB SQL giving the same rows as the Spark query of the same name."""

from __future__ import annotations

# Views shared by the statements, in dependency order; each statement takes those it names.
VIEWS = {
    "items": "SELECT p_partkey AS item_id, p_name AS title, p_type AS genres FROM part",
    "timed_ratings": """
        SELECT o_custkey AS user_id, l_partkey AS item_id,
               CAST(ceil(l_quantity / 5) * 0.5 AS DOUBLE) AS rating, o_orderdate AS rated_at
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "ratings": "SELECT user_id, item_id, rating FROM timed_ratings",
    "split": """
        SELECT user_id, item_id, rating,
               CAST('0x' || substr(md5('12345:' || user_id || ':' || item_id), 1, 8) AS BIGINT)
                   % 10 < 8 AS in_train
        FROM ratings""",
    "train": "SELECT user_id, item_id, rating FROM split WHERE in_train",
    "test": "SELECT user_id, item_id, rating FROM split WHERE NOT in_train",
    "popularity": """
        SELECT item_id, title, count(*) AS "count"
        FROM items JOIN ratings USING (item_id) GROUP BY item_id, title""",
    "popular": """SELECT * FROM popularity ORDER BY "count" DESC, item_id LIMIT 200""",
    "user_requests": """
        SELECT c_custkey AS request_id,
               CASE WHEN c_mktsegment <> 'BUILDING' THEN CAST(floor(c_acctbal) AS BIGINT) END
                   AS user_id
        FROM customer""",
    "pair_requests": """
        SELECT event_id AS user_id, CAST(floor("value" * 100) AS BIGINT) AS item_id FROM events""",
    "largest": "SELECT coalesce(max(user_id), 0) AS max_user_id FROM ratings",
    "allocated": """
        SELECT request_id,
               CASE WHEN is_new THEN max_user_id + CAST(sum(CAST(is_new AS INT))
                        OVER (ORDER BY request_id) AS BIGINT)
                    ELSE user_id END AS user_id,
               is_new
        FROM (SELECT r.request_id, r.user_id,
                     r.user_id IS NULL OR r.user_id NOT IN (SELECT user_id FROM ratings) AS is_new
              FROM user_requests r), largest""",
    "form_rows": """
        SELECT c_custkey AS request_id, c_custkey AS item_id, 4.0::DOUBLE AS rating FROM customer
        UNION ALL
        SELECT c_custkey, CAST(c_nationkey AS BIGINT), 2.5::DOUBLE
        FROM customer WHERE c_mktsegment <> 'MACHINERY'
        UNION ALL
        SELECT c_custkey, CAST(c_nationkey AS BIGINT), 1.0::DOUBLE
        FROM customer WHERE c_acctbal >= 0""",
    "pair_status": """
        SELECT user_id, item_id,
               CASE WHEN has_user AND has_item THEN 'ok' WHEN has_item THEN 'unknown_user'
                    WHEN has_user THEN 'unknown_item' ELSE 'unknown_both' END AS status
        FROM (SELECT user_id, item_id, user_id IN (SELECT user_id FROM train) AS has_user,
                     item_id IN (SELECT item_id FROM train) AS has_item
              FROM pair_requests)""",
    "list_size": "SELECT least(10, count(DISTINCT item_id)) AS n_rows FROM train",
    "early": "SELECT * FROM timed_ratings WHERE rated_at < TIMESTAMP '1995-06-01'",
    "late": "SELECT * FROM timed_ratings WHERE rated_at >= TIMESTAMP '1995-06-01'",
    "early_split": """
        SELECT user_id FROM split JOIN
            (SELECT user_id AS u, item_id AS i FROM early GROUP BY ALL)
            ON user_id = u AND item_id = i
        WHERE in_train""",
}


def names_used(sql: str) -> set[str]:
    words = set("".join(c if c.isalnum() or c == "_" else " " for c in sql).split())
    return {name for name in VIEWS if name in words}


def statement(sql: str, recursive: bool = False) -> str:
    """The query preceded by the views it needs, directly or through others."""
    wanted: set[str] = set()
    pending = names_used(sql)
    while pending - wanted:
        wanted |= pending
        pending = set().union(*(names_used(VIEWS[name]) for name in wanted))
    views = ", ".join(f"{name} AS ({VIEWS[name]})" for name in VIEWS if name in wanted)
    if not views:
        return sql
    # A query that brings its own WITH list continues ours.
    body = sql.strip()
    own = body.upper().startswith("WITH ")
    return f"WITH {'RECURSIVE ' if recursive else ''}{views}{', ' + body[5:] if own else ' ' + body}"


_UPLOADED = """
    SELECT o_custkey AS user_id, l_partkey AS item_id, l_quantity AS rating
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    UNION ALL
    SELECT o_custkey, l_suppkey, CAST(l_linenumber AS DOUBLE)
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linestatus = 'F'"""

_UPLOAD_FILES = """
    SELECT CAST(c_nationkey AS BIGINT) AS user_id, c_custkey AS item_id, c_acctbal AS rating
    FROM customer"""

_JSON = """'{"item_id":' || item_id || ',"title":"' || title || '","genres":"' || genres || '"}'"""

_RAW = {
    "read_items": "SELECT item_id, title, genres FROM items",
    "read_items_quoted": """
        SELECT item_id, '"' || title || '", the ' || genres || ' "one"' AS title, genres
        FROM items""",
    "read_ratings": "SELECT user_id, item_id, rating FROM ratings",
    "stage_roundtrip": "SELECT user_id, item_id, rating FROM ratings",
    "export_json": f"SELECT item_id, {_JSON} AS json FROM items",
    "export_json_files": f"SELECT {_JSON} AS json FROM items",
    "parse_uploads": _UPLOADED,
    "parse_uploads_rejects": """
        SELECT reason, count(*) AS n FROM (
            SELECT 'bad_item' AS reason FROM lineitem
            UNION ALL SELECT 'bad_item' FROM lineitem
            UNION ALL SELECT 'bad_rating' FROM lineitem WHERE l_linestatus <> 'F'
            UNION ALL SELECT 'rating_out_of_range' FROM lineitem WHERE l_quantity > 45)
        GROUP BY reason""",
    "read_upload_files": _UPLOAD_FILES,
    "ingest_upload_files": _UPLOAD_FILES,
    "parse_submissions": """
        SELECT l_orderkey AS submission_id, l_partkey AS item_id,
               CAST(l_linenumber AS DOUBLE) AS rating FROM lineitem
        UNION ALL
        SELECT l_orderkey, l_suppkey, l_quantity FROM lineitem WHERE l_returnflag <> 'R'""",
    "validate_requests": """
        SELECT CASE WHEN o_orderstatus <> 'O' THEN 'bad_user'
                    WHEN o_orderpriority = '5-LOW' THEN 'bad_count' ELSE 'ok' END AS status,
               count(*) AS n
        FROM orders GROUP BY 1""",
    "item_lookup": """
        SELECT event_id AS item_id, title,
               CASE WHEN items.item_id IS NULL THEN 'not_found' ELSE 'ok' END AS status
        FROM events LEFT JOIN items ON event_id = items.item_id""",
    "user_ratings": """
        SELECT user_id, item_id, rating FROM ratings
        WHERE user_id IN (SELECT user_id FROM events)""",
    "stored_user_ratings": """
        SELECT 'few' AS asked, user_id, item_id, rating FROM ratings
        WHERE user_id IN (SELECT r_regionkey FROM region)
        UNION ALL
        SELECT 'many', user_id, item_id, rating FROM ratings
        WHERE user_id IN (SELECT user_id FROM events)""",
    "rated_items": """
        SELECT user_id, item_id, title, rating FROM items JOIN ratings USING (item_id)""",
    "item_popularity": "SELECT * FROM popularity",
    "popular_items": "SELECT * FROM popular",
    "dataset_stats": """
        SELECT (SELECT count(*) FROM items) AS n_items, count(*) AS n_ratings,
               count(DISTINCT user_id) AS n_users, coalesce(max(user_id), 0) AS max_user_id
        FROM ratings""",
    "distinct_users": "SELECT DISTINCT user_id FROM ratings",
    "sample_popular": """
        SELECT item_id, title FROM popular ORDER BY md5('42:' || item_id), item_id LIMIT 5""",
    "sample_items": """
        SELECT item_id, title FROM items ORDER BY md5('42:' || item_id), item_id LIMIT 5""",
    "sample_fraction": "SELECT count(*) AS n_pool, true AS from_pool, true AS size_ok FROM items",
    "append_ratings": """
        SELECT user_id, count(*) AS n, sum(rating) AS sum_rating FROM ratings GROUP BY user_id""",
    "append_ratings_latest": """
        SELECT user_id, item_id, rating FROM timed_ratings
        QUALIFY row_number() OVER (PARTITION BY user_id, item_id
                                   ORDER BY rated_at DESC, rating DESC) = 1""",
    "append_versions": """
        SELECT CAST(1 AS BIGINT) AS version, count(*) AS n, sum(rating) AS sum_rating
        FROM timed_ratings WHERE rated_at < TIMESTAMP '2000-01-01'
        UNION ALL
        SELECT CAST(2 AS BIGINT), count(*), sum(rating) FROM timed_ratings""",
    "store_latest": """
        SELECT user_id, item_id, CASE WHEN user_id % 3 = 0 THEN max(rating) / 2 ELSE newest END AS rating
        FROM (SELECT user_id, item_id, rating, first_value(rating) OVER (
                  PARTITION BY user_id, item_id ORDER BY rated_at DESC, rating DESC) AS newest
              FROM timed_ratings)
        GROUP BY user_id, item_id, newest""",
    "popular_after_appends": """
        SELECT item_id, title, CAST(sum(times) AS BIGINT) AS "count"
        FROM items JOIN (SELECT item_id, 1 + CAST(user_id % 3 = 0 AS INT) + CAST(user_id % 5 = 0 AS INT) AS times
                         FROM ratings) USING (item_id)
        GROUP BY item_id, title""",
    "popular_latest_after_appends": """
        SELECT item_id, title, count(DISTINCT user_id) AS "count"
        FROM items JOIN ratings USING (item_id) GROUP BY item_id, title
        ORDER BY "count" DESC, item_id LIMIT 200""",
    "latest_versions": """
        WITH pairs AS (
            SELECT user_id, item_id, max(rating) / 2 AS half, arg_max(rating, (rated_at, rating)) AS newest
            FROM timed_ratings GROUP BY user_id, item_id)
        SELECT CAST(1 AS BIGINT) AS version, count(*) AS n, sum(newest) AS sum_rating FROM pairs
        UNION ALL SELECT 2, count(*), sum(CASE WHEN user_id % 3 = 0 THEN half ELSE newest END) FROM pairs
        UNION ALL SELECT 3, count(*), sum(CASE WHEN user_id % 3 = 0 OR user_id % 5 = 0 THEN half ELSE newest END) FROM pairs""",
    "predict_stored": """
        WITH early_train AS (
            SELECT DISTINCT user_id, item_id FROM early
            WHERE (user_id, item_id) IN (SELECT user_id, item_id FROM train))
        SELECT user_id, item_id, rating, status, status = 'ok' AS has_prediction
        FROM (SELECT test.*, CASE
                  WHEN user_id IN (SELECT user_id FROM early_train) THEN CASE
                      WHEN item_id IN (SELECT item_id FROM early_train) THEN 'ok' ELSE 'unknown_item' END
                  WHEN item_id IN (SELECT item_id FROM early_train) THEN 'unknown_user'
                  ELSE 'unknown_both' END AS status
              FROM test)""",
    "ingest_two_inboxes": f"{_UPLOAD_FILES} UNION ALL {_UPLOAD_FILES}",
    "rejected_rows": f"""
        SELECT reason, count(*) AS n FROM (
            SELECT 'bad_item' AS reason FROM lineitem
            UNION ALL SELECT 'bad_item' FROM lineitem
            UNION ALL SELECT 'bad_rating' FROM lineitem WHERE l_linestatus <> 'F'
            UNION ALL SELECT 'rating_out_of_range' FROM lineitem WHERE l_quantity > 45)
        GROUP BY reason
        UNION ALL SELECT 'accepted', count(*) FROM ({_UPLOADED}) WHERE rating <= 45""",
    "allocate_after_ingest": "SELECT request_id, user_id, is_new FROM allocated",
    "submit_replayed": """
        SELECT request_id, user_id, is_new, n_rows, CASE WHEN is_new THEN n_rows END AS n_stored
        FROM (SELECT request_id, user_id, is_new, count(form_rows.item_id) AS n_rows
              FROM allocated LEFT JOIN form_rows USING (request_id) GROUP BY ALL)""",
    "allocate_twice": """
        WITH top AS (SELECT coalesce(max(user_id), 0) AS m FROM early),
        first_turn AS (
            SELECT count(*) AS n FROM user_requests
            WHERE user_id IS NULL OR user_id NOT IN (SELECT user_id FROM early)),
        second_turn AS (
            SELECT count(*) AS n FROM user_requests, top, first_turn
            WHERE user_id IS NULL OR (user_id NOT IN (SELECT user_id FROM early)
                                      AND NOT (user_id > m AND user_id <= m + first_turn.n)))
        SELECT 0 AS turn, n AS n_new, n AS n_ids, m + 1 AS first_id, m + n AS last_id
        FROM first_turn, top
        UNION ALL
        SELECT turn, s.n, s.n, m + f.n + 1, m + f.n + s.n
        FROM first_turn f, second_turn s, top, (VALUES (1), (2)) AS t(turn)""",
    "known_after_merge": """
        WITH top AS (SELECT coalesce(max(user_id), 0) AS m FROM early),
        first_turn AS (
            SELECT count(*) AS n FROM user_requests
            WHERE user_id IS NULL OR user_id NOT IN (SELECT user_id FROM early)),
        held AS (
            SELECT user_id FROM ratings
            UNION SELECT unnest(range(m + 1, m + n + 1)) FROM top, first_turn),
        second_turn AS (
            SELECT count(*) AS n FROM user_requests
            WHERE user_id IS NULL OR user_id NOT IN (SELECT user_id FROM held)),
        last AS (SELECT max(user_id) AS m FROM held)
        SELECT request_id, user_id,
               user_id IS NOT NULL AND (user_id IN (SELECT user_id FROM held)
                                        OR user_id > last.m AND user_id <= last.m + second_turn.n) AS known
        FROM user_requests, last, second_turn""",
    "model_settings": """
        WITH hashed AS (
            SELECT user_id, item_id,
                   CAST('0x' || substr(md5('12345:' || user_id || ':' || item_id), 1, 8) AS BIGINT)
                       % 10 < 8 AS in_train
            FROM early),
        counted AS (
            SELECT 1 AS version, 'keep' AS on_conflict, count(*) AS n_ratings,
                   count(*) FILTER (WHERE in_train) AS n_train FROM hashed
            UNION ALL
            SELECT 2, 'latest', count(*), count(*) FILTER (WHERE in_train)
            FROM (SELECT DISTINCT * FROM hashed))
        SELECT CAST(version AS BIGINT) AS version, CAST(1 AS BIGINT) AS batch,
               CAST(1 AS BIGINT) AS items_version, n_ratings, n_train, on_conflict,
               'mllib' AS solver, 1 AS max_iter, 10 AS rank, CAST(12345 AS BIGINT) AS seed,
               8 AS user_blocks, 8 AS item_blocks, CAST(12345 AS BIGINT) AS split_seed,
               10 AS buckets, 8 AS train_buckets
        FROM counted""",
    "known_users_range": """
        SELECT request_id, user_id, coalesce(user_id <= max_user_id, false) AS known
        FROM user_requests, largest""",
    "known_users_exists": """
        SELECT request_id, user_id,
               user_id IS NOT NULL AND user_id IN (SELECT user_id FROM ratings) AS known
        FROM user_requests""",
    "allocate_users": "SELECT request_id, user_id, is_new FROM allocated",
    "submit_ratings": """
        SELECT request_id, user_id, is_new, count(form_rows.item_id) AS n_rows
        FROM allocated LEFT JOIN form_rows USING (request_id) GROUP BY ALL""",
    "submitted_rows": """
        SELECT request_id, user_id, item_id, rating
        FROM allocated JOIN form_rows USING (request_id)""",
    "split_train": "SELECT user_id, item_id, rating FROM train",
    "split_test": "SELECT user_id, item_id, rating FROM test",
    "split_stats": """
        SELECT CASE WHEN in_train THEN 'train' ELSE 'test' END AS part, count(*) AS n,
               sum(rating) AS sum_rating
        FROM split GROUP BY 1""",
    "split_random": "SELECT count(*) AS n, true AS share_ok FROM ratings",
    "rmse_constant_model": """
        SELECT count(*) AS n,
               round(sqrt(avg(pow(rating - (SELECT avg(rating) FROM train), 2))), 6) AS rmse
        FROM test""",
    "als_factor_ids": """
        SELECT DISTINCT 'user' AS side, user_id AS id FROM train
        UNION ALL SELECT DISTINCT 'item', item_id FROM train""",
    "als_optimality": "SELECT DISTINCT user_id, true AS ok FROM train",
    "als_optimality_preset_b": "SELECT DISTINCT user_id, true AS ok FROM train",
    "als_optimality_hot_keys": "SELECT DISTINCT user_id, true AS ok FROM train",
    "cold_start_coverage": """
        SELECT count(*) AS n_test,
               count(*) FILTER (WHERE user_id IN (SELECT user_id FROM early)
                                  AND item_id IN (SELECT item_id FROM early)) AS n_scored
        FROM late""",
    "predict_ratings": """
        SELECT user_id, item_id, status, status = 'ok' AS has_prediction FROM pair_status""",
    "prediction_report": """
        SELECT user_id, item_id, title, status, status = 'ok' AS has_rounded_rating
        FROM pair_status LEFT JOIN items USING (item_id)""",
    "predict_parity": """
        SELECT DISTINCT user_id, item_id, true AS same FROM test
        WHERE user_id IN (SELECT user_id FROM train) AND item_id IN (SELECT item_id FROM train)""",
    "evaluate": """
        SELECT count(*) AS n, true AS rmse_matches FROM test
        WHERE user_id IN (SELECT user_id FROM train) AND item_id IN (SELECT item_id FROM train)""",
    "recommend_top_n": """
        SELECT user_id, n_rows, true AS ranks_ok, true AS scores_ok, true AS distinct_ok,
               true AS best_ok
        FROM (SELECT DISTINCT user_id FROM train), list_size""",
    "recommend_titles": """
        SELECT user_id, n_rows, true AS titles_ok
        FROM (SELECT DISTINCT user_id FROM train), list_size""",
    "recommend_subset_users": """
        SELECT user_id, n_rows, true AS same FROM (SELECT DISTINCT user_id FROM train), list_size
        WHERE user_id IN (SELECT user_id FROM events UNION SELECT event_id FROM events)""",
    "recommend_unseen": """
        SELECT user_id, least(10, n_items - n_seen) AS n_rows, true AS best_ok
        FROM (SELECT count(DISTINCT item_id) AS n_items FROM train),
             (SELECT user_id, count(DISTINCT item_id) AS n_seen FROM ratings
              WHERE item_id IN (SELECT item_id FROM train)
                AND user_id IN (SELECT user_id FROM train) GROUP BY user_id)
        WHERE n_items > n_seen""",
    "refit_after_append": """
        SELECT DISTINCT user_id, user_id IN (SELECT user_id FROM early_split) AS in_old_model,
               user_id IN (SELECT user_id FROM train) AS in_new_model
        FROM ratings""",
    "pipeline_summary": """
        SELECT (SELECT count(*) FROM items) AS n_items, (SELECT count(*) FROM ratings) AS n_ratings,
               max_user_id, (SELECT count(*) FROM train) AS n_train,
               (SELECT count(*) FROM test) AS n_test, true AS rmse_is_finite
        FROM largest""",
}

SQL = {name: statement(sql) for name, sql in _RAW.items()}

# The running largest id taken literally, one request after the other.
SQL["allocate_users_range"] = statement("""
    WITH queue AS (
        SELECT row_number() OVER (ORDER BY request_id) AS turn, request_id, user_id
        FROM user_requests),
    walk AS (
        SELECT CAST(0 AS BIGINT) AS turn, CAST(NULL AS BIGINT) AS request_id,
               CAST(NULL AS BIGINT) AS user_id, false AS is_new, max_user_id AS top
        FROM largest
        UNION ALL
        SELECT q.turn, q.request_id, coalesce(q.user_id, w.top + 1),
               q.user_id IS NULL OR q.user_id > w.top,
               CASE WHEN q.user_id IS NULL THEN w.top + 1 ELSE greatest(w.top, q.user_id) END
        FROM walk w JOIN queue q ON q.turn = w.turn + 1)
    SELECT request_id, user_id, is_new FROM walk WHERE turn > 0""", recursive=True)
