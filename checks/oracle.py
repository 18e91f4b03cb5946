"""The same results in SQL."""

from __future__ import annotations

from checks.bindings import AS_OF, MIDDLE

# Common table expressions, each naming the ones it reads.
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "log": (
        (),
        """SELECT event_id, user_id, CAST(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS BIGINT) AS item_id,
  CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 END AS action,
  CAST(floor(epoch(ts)) AS BIGINT) AS created_at, value
FROM events""",
    ),
    "wide": (
        (),
        """SELECT o_custkey AS user_id, l_partkey AS item_id, CAST(p_size AS BIGINT) AS cat_id,
  CAST(split_part(p_brand, '#', 2) AS BIGINT) AS brand_id, l_suppkey AS merchant_id,
  CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 ELSE 2 END AS action,
  CAST(floor(epoch(o_orderdate)) AS BIGINT) AS created_at,
  CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS gender,
  CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS age_range, o_orderpriority AS province
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    ),
    "rules": (
        (),
        """SELECT 'Product' AS object_type, p_partkey AS object_id,
  CASE WHEN max(p_retailprice) >= 1050 THEN 1 ELSE 0 END AS is_available FROM part GROUP BY p_partkey
UNION ALL
SELECT 'Category', CAST(p_size AS BIGINT), CASE WHEN p_size >= 46 THEN 1 ELSE 0 END FROM part GROUP BY p_size
UNION ALL
SELECT 'Brand', b, CASE WHEN b >= 23 THEN 1 ELSE 0 END
FROM (SELECT DISTINCT CAST(split_part(p_brand, '#', 2) AS BIGINT) AS b FROM part)""",
    ),
    "split": (
        ("ratings",),
        """SELECT *, CASE WHEN created_at % 10 < 6 THEN 'train' WHEN created_at % 10 < 8 THEN 'validation'
  ELSE 'test' END AS split FROM ratings""",
    ),
    "item_means": (
        ("split",),
        """SELECT item_id, avg(rating) AS prediction, count(*) AS n FROM split WHERE split <> 'test' GROUP BY item_id""",
    ),
    "scored": (
        ("split", "item_means"),
        """SELECT s.user_id, s.item_id, s.rating, m.prediction
FROM split s JOIN item_means m ON s.item_id = m.item_id WHERE s.split = 'test'""",
    ),
    "base": (
        ("split",),
        """SELECT m AS mean_rating, sqrt(avg((rating - m) * (rating - m))) AS baseline_rmse
FROM split, (SELECT avg(rating) AS m FROM split WHERE split <> 'test') WHERE split = 'test' GROUP BY m""",
    ),
    "items": (
        ("wide",),
        """SELECT item_id, r.cat_id AS cat_id, r.brand_id AS brand_id, r.merchant_id AS merchant_id FROM (
  SELECT item_id, arg_min({'cat_id': cat_id, 'brand_id': brand_id, 'merchant_id': merchant_id},
    {'t': created_at, 'c': cat_id, 'b': brand_id, 'm': merchant_id}) AS r FROM wide GROUP BY item_id)""",
    ),
    "pairs": (
        (),
        """SELECT a.vec_id AS u, b.vec_id AS i,
  list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS score
FROM embeddings a, embeddings b""",
    ),
    "best": (
        ("pairs",),
        """SELECT * FROM (SELECT u, i, score,
  row_number() OVER (PARTITION BY u ORDER BY round(score, 9) DESC, i) AS rank FROM pairs) WHERE rank <= 10""",
    ),
    "allowed": (
        ("ratings", "rules"),
        """SELECT ratings.* FROM ratings JOIN part ON item_id = p_partkey
WHERE item_id NOT IN (SELECT object_id FROM rules WHERE is_available = 1 AND object_type = 'Product')
  AND p_size NOT IN (SELECT object_id FROM rules WHERE is_available = 1 AND object_type = 'Category')
  AND CAST(split_part(p_brand, '#', 2) AS BIGINT) NOT IN (
    SELECT object_id FROM rules WHERE is_available = 1 AND object_type = 'Brand')""",
    ),
    "messages": (
        ("log",),
        """SELECT event_id, CASE WHEN action IS NULL THEN NULL ELSE user_id END AS user_id,
  CASE WHEN action IS NULL THEN NULL ELSE item_id END AS item_id,
  CASE WHEN action IS NULL THEN NULL ELSE value END AS rating, action IS NOT NULL AS is_valid FROM log""",
    ),
}


def _rated(source: str, weight: str, condition: str = "TRUE") -> str:
    return f"""SELECT *, least(CAST(5 AS DOUBLE), (viewed_count * CAST({weight} AS DOUBLE) * 100
  + CAST(added_to_cart_count > 0 AS INTEGER) * CAST(0.35 AS DOUBLE) * 100
  + CAST(bought_count > 0 AS INTEGER) * CAST(0.45 AS DOUBLE) * 100
  + CAST(added_to_favorite_count > 0 AS INTEGER) * CAST(0.15 AS DOUBLE) * 100) / CAST(20 AS DOUBLE)) AS rating
FROM (SELECT user_id, item_id, count(CASE WHEN action = 0 THEN item_id END) AS viewed_count,
  count(CASE WHEN action = 1 THEN item_id END) AS added_to_cart_count,
  count(CASE WHEN action = 2 THEN item_id END) AS bought_count,
  count(CASE WHEN action = 3 THEN item_id END) AS added_to_favorite_count,
  min(created_at) AS created_at, max(created_at) AS updated_at
  FROM {source} WHERE action IN (0, 1, 2, 3) AND {condition} GROUP BY user_id, item_id)"""


CTES["ratings"] = (("log",), _rated("log", "0.05"))
CTES["raw_ratings"] = (("log",), _rated("log", "0.005"))
CTES["wide_ratings"] = (("wide",), _rated("wide", "0.05"))
CTES["timed"] = (
    ("wide_ratings",),
    """SELECT user_id, item_id, rating, created_at + (7 * user_id + item_id) % 10 AS created_at, updated_at
FROM wide_ratings""",
)
CTES["timed_split"] = (("timed",), CTES["split"][1].replace("FROM ratings", "FROM timed"))
CTES["timed_base"] = (("timed_split",), CTES["base"][1].replace("FROM split", "FROM timed_split"))
CTES["timed_allowed"] = (("timed", "rules"), CTES["allowed"][1].replace("ratings", "timed"))
CTES["first_half"] = (("log",), _rated("log", "0.05", f"created_at < {MIDDLE}"))
CTES["last_day"] = (("log",), _rated("log", "0.05", f"created_at >= {AS_OF} - 86400"))


def _with(body: str, *names: str) -> str:
    needed: list[str] = []

    def add(name: str) -> None:
        for before in CTES[name][0]:
            add(before)
        if name not in needed:
            needed.append(name)

    for name in names:
        add(name)
    ctes = ",\n".join(f"{name} AS (\n{CTES[name][1]}\n)" for name in needed)
    return f"WITH {ctes}\n{body}" if needed else body


COUNTS = "viewed_count, added_to_cart_count, bought_count, added_to_favorite_count"
RATED = f"user_id, item_id, {COUNTS}, round(rating, 6) AS rating"
WHOLE = f"{RATED}, created_at, updated_at"
PAIR_RATING = "user_id, item_id, round(rating, 6) AS rating"
MESSAGE = """'[' || string_agg('{"user":' || u || ',"product":' || i || ',"rating":'
  || CAST(round(score, 3) AS VARCHAR) || '}', ',' ORDER BY rank) || ']'"""
PROFILE = """SELECT user_id, coalesce(string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id)
  FILTER (WHERE bought_count > 0), '0') AS bought_item_ids FROM {} GROUP BY user_id"""

ORACLE: dict[str, str] = {
    "csv_log_scan": _with(
        """SELECT CAST(user_id AS INTEGER) AS user_id, CAST(item_id AS INTEGER) AS item_id,
  CAST(cat_id AS INTEGER) AS cat_id, CAST(brand_id AS INTEGER) AS brand_id,
  CAST(merchant_id AS INTEGER) AS merchant_id, action, gender, age_range, province FROM wide""",
        "wide",
    ),
    "csv_log_scan_v2": _with("SELECT user_id, item_id, action, created_at FROM log", "log"),
    "table_scan": _with("SELECT user_id, item_id, action FROM wide", "wide"),
    "log_append_rebuild": _with(f"SELECT {WHOLE} FROM raw_ratings", "raw_ratings"),
    "table_overwrite": _with(
        f"SELECT user_id, item_id, {COUNTS}, round(rating / 5, 6) AS rating FROM ratings", "ratings"
    ),
    "table_append": _with("SELECT * FROM items UNION ALL SELECT * FROM items", "items"),
    "recs_publish": _with(
        f"""SELECT u AS user_id, i AS item_id, round(score, 6) AS rating, CAST(rank AS INTEGER) AS rank,
  CAST({AS_OF} AS BIGINT) AS created_at FROM best""",
        "best",
    ),
    "replace_by_key": _with(
        f"""SELECT {PAIR_RATING} FROM ratings WHERE user_id NOT IN (SELECT user_id FROM last_day)
UNION ALL SELECT {PAIR_RATING} FROM last_day""",
        "ratings",
        "last_day",
    ),
    "upsert_by_key": _with(
        f"""SELECT coalesce(t.user_id, n.user_id) AS user_id, coalesce(t.item_id, n.item_id) AS item_id, t.viewed_count,
  round(CASE WHEN n.user_id IS NOT NULL THEN n.rating ELSE t.rating END, 6) AS rating,
  coalesce(n.updated_at, t.updated_at) AS updated_at
FROM first_half t FULL JOIN (
  SELECT * FROM (SELECT user_id, item_id, CASE WHEN action IS NOT NULL THEN value END AS rating,
    created_at AS updated_at, row_number() OVER (PARTITION BY user_id, item_id
      ORDER BY created_at DESC, CASE WHEN action IS NOT NULL THEN value END DESC NULLS LAST) AS n
  FROM log WHERE created_at >= {MIDDLE}) WHERE n = 1
) n ON t.user_id = n.user_id AND t.item_id = n.item_id""",
        "first_half",
    ),
    "stream_source": _with(
        "SELECT CAST(user_id AS INTEGER) AS user_id, CAST(item_id AS INTEGER) AS item_id, rating, is_valid FROM messages",
        "messages",
    ),
    "micro_batch": "SELECT CAST(3 AS BIGINT) AS n_batches, count(*) AS n_messages FROM events",
    "rating_stream_state": _with(
        """SELECT CAST(user_id AS INTEGER) AS user_id, CAST(item_id AS INTEGER) AS item_id, round(rating, 6) AS rating
FROM (SELECT user_id, item_id, rating FROM ratings UNION ALL
      SELECT user_id, item_id, rating FROM messages WHERE is_valid)""",
        "ratings",
        "messages",
    ),
    "stream_sink": _with(f"SELECT CAST(u AS VARCHAR) AS key, {MESSAGE} AS value FROM best GROUP BY u", "best"),
    "rating_project": _with(
        """SELECT CAST(user_id AS INTEGER) AS user_id, CAST(item_id AS INTEGER) AS item_id, round(rating, 6) AS rating,
  created_at FROM ratings""",
        "ratings",
    ),
    "action_filter": _with("SELECT event_id, user_id, item_id FROM log WHERE action = 2", "log"),
    "exclusion_settings": _with("SELECT object_type, object_id FROM rules WHERE is_available = 1", "rules"),
    "exclusion_filter": _with(
        f"""SELECT {PAIR_RATING} FROM wide_ratings JOIN items USING (item_id)
WHERE item_id NOT IN (SELECT object_id FROM rules WHERE is_available = 1 AND object_type = 'Product')
  AND cat_id NOT IN (SELECT object_id FROM rules WHERE is_available = 1 AND object_type = 'Category')
  AND brand_id NOT IN (SELECT object_id FROM rules WHERE is_available = 1 AND object_type = 'Brand')""",
        "wide_ratings",
        "items",
        "rules",
    ),
    "exclusion_filter_missing_items": _with(
        f"""SELECT {PAIR_RATING} FROM wide_ratings WHERE item_id IN (
  SELECT item_id FROM wide WHERE action = 0 AND cat_id NOT IN (
    SELECT object_id FROM rules WHERE is_available = 1 AND object_type = 'Category'))""",
        "wide_ratings",
        "rules",
    ),
    "recency_filter": _with(
        f"SELECT user_id, item_id, updated_at FROM ratings WHERE updated_at >= {AS_OF} - 86400", "ratings"
    ),
    "active_users": _with(
        f"SELECT DISTINCT user_id FROM ratings WHERE updated_at >= {AS_OF} - 86400", "ratings"
    ),
    "buyer_filter": _with("SELECT user_id, item_id, bought_count > 0 AS bought FROM ratings", "ratings"),
    "match_filter": _with(
        "SELECT event_id, user_id, item_id FROM log WHERE action IS NULL AND item_id = 7", "log"
    ),
    "operator_filter": _with(
        f"""SELECT event_id, user_id, item_id, action FROM log
WHERE action IS DISTINCT FROM 0 AND created_at >= {MIDDLE} AND created_at < {AS_OF}
  AND item_id NOT IN (3, 5, 8) AND item_id > 1 AND user_id <= 100 AND (action IN (1, 2) OR action IS NULL)""",
        "log",
    ),
    "delete_where": _with(
        "SELECT event_id, item_id, action FROM log WHERE action IS DISTINCT FROM 0 OR item_id <> 7", "log"
    ),
    "update_where": _with(
        """SELECT event_id, coalesce(action, 9) AS action,
  round(CASE WHEN action IS NULL THEN 0 ELSE value END, 6) AS value FROM log""",
        "log",
    ),
    "action_counts": _with(f"SELECT user_id, item_id, {COUNTS} FROM ratings", "ratings"),
    "affinity_rating": _with(f"SELECT {RATED} FROM ratings", "ratings"),
    "affinity_rating_orders": _with(f"SELECT {WHOLE} FROM wide_ratings", "wide_ratings"),
    "interaction_times": _with("SELECT user_id, item_id, created_at, updated_at FROM ratings", "ratings"),
    "user_dim": _with(
        """SELECT user_id, r.gender AS gender, r.age_range AS age_range, r.province AS province FROM (
  SELECT user_id, arg_min({'gender': gender, 'age_range': age_range, 'province': province},
    {'t': created_at, 'g': gender, 'a': age_range, 'p': province}) AS r FROM wide GROUP BY user_id)""",
        "wide",
    ),
    "item_dim": _with("SELECT item_id, cat_id, brand_id, merchant_id FROM items", "items"),
    "user_purchase_profile": _with(PROFILE.format("ratings"), "ratings"),
    "user_purchase_profile_orders": _with(PROFILE.format("wide_ratings"), "wide_ratings"),
    "sample_stats": _with(
        """SELECT count(*) AS n_ratings, count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items
FROM ratings""",
        "ratings",
    ),
    "split_counts": _with("SELECT split, count(*) AS n_ratings FROM split GROUP BY split", "split"),
    "mean_rating": _with("SELECT round(avg(rating), 6) AS mean_rating FROM split WHERE split <> 'test'", "split"),
    "baseline_rmse": _with(
        "SELECT round(mean_rating, 6) AS mean_rating, round(baseline_rmse, 6) AS baseline_rmse FROM base", "base"
    ),
    "prediction_join": _with(
        "SELECT user_id, item_id, round(rating, 6) AS rating, round(prediction, 6) AS prediction FROM scored", "scored"
    ),
    "rmse": _with("SELECT round(sqrt(avg((prediction - rating) * (prediction - rating))), 6) AS rmse FROM scored", "scored"),
    "improvement_pct": _with(
        """SELECT round((baseline_rmse - r) / baseline_rmse * 100, 6) AS improvement_pct
FROM base, (SELECT sqrt(avg((prediction - rating) * (prediction - rating))) AS r FROM scored)""",
        "base",
        "scored",
    ),
    "best_params": _with(
        """SELECT damping, rmse FROM (
  SELECT d AS damping, round(sqrt(avg(pow((prediction * n + m * d) / (n + d) - rating, 2))), 6) AS rmse
  FROM split JOIN item_means USING (item_id), (SELECT avg(rating) AS m FROM split WHERE split <> 'test'),
    (SELECT CAST(unnest([0, 1, 2, 5, 10, 50]) AS DOUBLE) AS d)
  WHERE split = 'test' GROUP BY d
) ORDER BY rmse, damping LIMIT 1""",
        "split",
        "item_means",
    ),
    "union_all": _with(
        """SELECT CAST(user_id AS INTEGER) AS user_id, CAST(item_id AS INTEGER) AS item_id, round(rating, 6) AS rating
FROM (SELECT user_id, item_id, rating FROM ratings UNION ALL SELECT user_id, item_id, rating FROM wide_ratings)""",
        "ratings",
        "wide_ratings",
    ),
    "distinct_users": _with("SELECT DISTINCT user_id FROM log", "log"),
    "distinct_items": _with("SELECT DISTINCT item_id FROM log", "log"),
    "split_bucket": _with(
        """SELECT event_id, CAST(created_at % 10 AS INTEGER) AS bucket, CASE WHEN created_at % 10 < 6 THEN 'train'
  WHEN created_at % 10 < 8 THEN 'validation' ELSE 'test' END AS split FROM log""",
        "log",
    ),
    "clamp": _with("SELECT event_id, least(CAST(5 AS DOUBLE), value) AS clamped FROM log", "log"),
    "flag_positive": _with("SELECT user_id, item_id, CAST(bought_count > 0 AS INTEGER) AS bought FROM ratings", "ratings"),
    "join_ids": """SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_partkey) AS ids
FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) GROUP BY l_orderkey""",
    "render_recs_json": _with(f"SELECT u AS user_id, {MESSAGE} AS message FROM best GROUP BY u", "best"),
    "epoch_bounds": _with(
        """SELECT event_id, created_at AS now, created_at - 86400 AS day_ago,
  CAST(created_at - 600 AS VARCHAR) AS ten_minutes_ago,
  CAST(created_at - created_at % 86400 AS VARCHAR) AS midnight FROM log""",
        "log",
    ),
    "topk_items_per_user": _with(
        "SELECT u AS user_id, i AS item_id, round(score, 6) AS rating, CAST(rank AS INTEGER) AS rank FROM best", "best"
    ),
    "topk_users_per_item": _with(
        "SELECT u AS item_id, i AS user_id, round(score, 6) AS rating, CAST(rank AS INTEGER) AS rank FROM best", "best"
    ),
    "topk_for_users": _with(
        """SELECT u AS user_id, i AS item_id, round(score, 6) AS rating, CAST(rank AS INTEGER) AS rank FROM best
WHERE u IN (SELECT user_id FROM log)""",
        "best",
        "log",
    ),
    "score_all_pairs": _with(
        """SELECT u AS left_id, count(*) AS n_pairs, round(min(score), 6) AS min_score,
  round(max(score), 6) AS max_score, round(avg(score), 6) AS mean_score FROM pairs GROUP BY u""",
        "pairs",
    ),
    "job_import": _with(f"SELECT {RATED} FROM wide_ratings", "wide_ratings"),
    "job_import_raw": _with(PROFILE.format("raw_ratings"), "raw_ratings"),
}
ORACLE["als_train_coverage"] = _with(
    "SELECT DISTINCT CAST(item_id AS INTEGER) AS id, 12 AS n_features FROM ratings", "ratings"
)
ORACLE["als_predict_coverage"] = _with(
    """SELECT user_id, item_id, round(rating, 6) AS rating, TRUE AS scored FROM split WHERE split = 'test'
  AND user_id IN (SELECT user_id FROM split WHERE split <> 'test')
  AND item_id IN (SELECT item_id FROM split WHERE split <> 'test')""",
    "split",
)
ORACLE["model_report_coverage"] = _with(
    """SELECT count(*) AS n_ratings, count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items,
  count(CASE WHEN split = 'train' THEN 1 END) AS n_train,
  count(CASE WHEN split = 'validation' THEN 1 END) AS n_validation,
  count(CASE WHEN split = 'test' THEN 1 END) AS n_test, 12 AS rank, 20 AS iterations,
  (SELECT round(mean_rating, 6) FROM base) AS mean_rating, (SELECT round(baseline_rmse, 6) FROM base) AS baseline_rmse
FROM split""",
    "split",
    "base",
)
SIZES = """SELECT user_id, CAST({as_of} AS BIGINT) AS created_at, least(n, {top}) AS n_items,
  CAST(least(n, {top}) AS INTEGER) AS last_rank
FROM (SELECT DISTINCT user_id FROM allowed WHERE {active}), (SELECT count(DISTINCT item_id) AS n FROM allowed)"""
ORACLE["job_offline_coverage"] = _with(SIZES.format(as_of=AS_OF, top=200, active="TRUE"), "allowed")
ORACLE["job_incremental_coverage"] = _with(
    SIZES.format(as_of=AS_OF, top=300, active=f"updated_at >= {AS_OF} - 86400"), "allowed"
)
ORACLE["job_stream_coverage"] = _with(
    """SELECT user_id, least(n, 200) AS n_items FROM (SELECT DISTINCT user_id FROM messages WHERE is_valid),
  (SELECT count(DISTINCT item_id) AS n FROM (
    SELECT item_id FROM ratings UNION ALL SELECT item_id FROM messages WHERE is_valid))""",
    "ratings",
    "messages",
)
ORACLE["als_train"] = _with(
    """SELECT user_id, count(*) AS n_ratings, CAST(12 AS BIGINT) AS n_factors, TRUE AS solved
FROM wide_ratings GROUP BY user_id""",
    "wide_ratings",
)
ORACLE["als_predict"] = _with(
    """SELECT user_id, item_id, round(rating, 6) AS rating, TRUE AS exact FROM timed_split WHERE split = 'test'
  AND user_id IN (SELECT user_id FROM timed_split WHERE split <> 'test')
  AND item_id IN (SELECT item_id FROM timed_split WHERE split <> 'test')""",
    "timed_split",
)
ORACLE["als_grid_search"] = """SELECT CAST(row_number() OVER (ORDER BY rank, reg, iterations) - 1 AS INTEGER) AS trial,
  rank, reg, iterations, TRUE AS error_holds, TRUE AS solved, TRUE AS best_is_lowest
FROM (SELECT unnest([8, 12]) AS rank), (SELECT CAST(unnest([0.01, 0.1]) AS DOUBLE) AS reg),
  (SELECT unnest([10, 20]) AS iterations)"""
ORACLE["model_save"] = _with(
    """SELECT 'user' AS side, CAST(user_id AS INTEGER) AS id, TRUE AS same FROM wide_ratings GROUP BY user_id
UNION ALL SELECT 'item', CAST(item_id AS INTEGER), TRUE FROM wide_ratings GROUP BY item_id""",
    "wide_ratings",
)
ORACLE["model_load"] = _with(
    "SELECT user_id, item_id, round(rating, 6) AS rating, TRUE AS same FROM wide_ratings", "wide_ratings"
)
ORACLE["job_incremental"] = _with(
    """SELECT user_id, CASE WHEN active THEN now ELSE 0 END AS created_at, CASE WHEN active THEN size ELSE 1 END AS n_items,
  CAST(CASE WHEN active THEN size ELSE 1 END AS INTEGER) AS last_rank, TRUE AS allowed, TRUE AS falls
FROM (SELECT user_id, now, max(updated_at) >= now - 86400 AS active
    FROM timed_allowed, (SELECT max(updated_at) AS now FROM timed_allowed) GROUP BY user_id, now),
  (SELECT least(count(DISTINCT item_id), 300) AS size FROM timed_allowed)""",
    "timed_allowed",
)
CTES["faults"] = (
    ("log",),
    """SELECT *, CASE WHEN event_id % 50 IN (0, 1, 6) THEN 'malformed' WHEN event_id % 50 = 2 THEN 'no user'
    WHEN event_id % 50 = 4 THEN 'no item' END AS reason,
  concat(CASE event_id % 50 WHEN 2 THEN '' WHEN 5 THEN '1099511627776' ELSE CAST(user_id AS VARCHAR) END, ',',
    CASE event_id % 50 WHEN 0 THEN 'abc' WHEN 4 THEN '' ELSE CAST(item_id AS VARCHAR) END, ',,,',
    CASE event_id % 50 WHEN 1 THEN '2.0' ELSE coalesce(CAST(action AS VARCHAR), '') END, ',',
    CASE event_id % 50 WHEN 6 THEN 'NaN' ELSE CAST(created_at AS VARCHAR) END) AS line
FROM log""",
)
ORACLE["csv_log_rejects"] = _with("SELECT line, reason FROM faults WHERE reason IS NOT NULL", "faults")
ORACLE["job_import_raw_faults"] = _with(
    """SELECT user_id, item_id, round(least(5.0, (views * 0.005 * 100 + CAST(carts > 0 AS INT) * 0.35 * 100
    + CAST(buys > 0 AS INT) * 0.45 * 100 + CAST(favs > 0 AS INT) * 0.15 * 100) / 20.0), 6)::DOUBLE AS rating,
  malformed AS n_malformed, users AS n_no_user, items AS n_no_item, malformed + users + items AS n_kept
FROM (SELECT user_id, item_id, count(CASE WHEN action = 0 THEN 1 END) AS views, count(CASE WHEN action = 1 THEN 1 END) AS carts,
    count(CASE WHEN action = 2 THEN 1 END) AS buys, count(CASE WHEN action = 3 THEN 1 END) AS favs
  FROM (SELECT CASE WHEN event_id % 50 = 5 THEN 1099511627776 ELSE user_id END AS user_id, item_id, action
    FROM faults WHERE reason IS NULL AND action IS NOT NULL) GROUP BY ALL),
  (SELECT count(CASE WHEN reason = 'malformed' THEN 1 END) AS malformed, count(CASE WHEN reason = 'no user' THEN 1 END) AS users,
    count(CASE WHEN reason = 'no item' THEN 1 END) AS items FROM faults)""",
    "faults",
)
ORACLE["stream_rejects"] = _with(
    """SELECT value, reason FROM (
  SELECT concat('{"customer_id":"', CASE k WHEN 0 THEN 'x' ELSE CAST(user_id AS VARCHAR) END, '","item_id":"',
      CASE k WHEN 1 THEN '1099511627776' ELSE CAST(item_id AS VARCHAR) END, '","rating":',
      CASE k WHEN 2 THEN '"abc"' WHEN 3 THEN 'null' ELSE '3.5' END, CASE k WHEN 4 THEN '' ELSE '}' END) AS value,
    CASE k WHEN 0 THEN 'bad user' WHEN 1 THEN 'bad item' WHEN 2 THEN 'bad rating' WHEN 3 THEN 'bad rating'
      WHEN 4 THEN 'malformed' END AS reason
  FROM (SELECT *, event_id % 20 AS k FROM log)) WHERE reason IS NOT NULL""",
    "log",
)
ORACLE["job_import_users"] = _with(
    """SELECT user_id, p.g AS gender, p.a AS age_range, p.p AS province
FROM (SELECT user_id, min({'g': gender, 'a': age_range, 'p': province}) AS p FROM wide GROUP BY user_id)""",
    "wide",
)
ORACLE["job_import_items"] = _with(
    """SELECT item_id, r.c AS cat_id, r.b AS brand_id, r.m AS merchant_id
FROM (SELECT item_id, min({'c': cat_id, 'b': brand_id, 'm': merchant_id}) AS r FROM wide GROUP BY item_id)""",
    "wide",
)
ORACLE["job_import_raw_items"] = _with(
    """SELECT item_id, r.c AS cat_id, r.b AS brand_id
FROM (SELECT item_id, min({'t': created_at, 'c': cat_id, 'b': brand_id}) AS r FROM wide GROUP BY item_id)""",
    "wide",
)
ORACLE["model_report"] = ORACLE["job_train"] = _with(
    """SELECT count(*) AS n_ratings, count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items,
  count(CASE WHEN split = 'train' THEN 1 END) AS n_train,
  count(CASE WHEN split = 'validation' THEN 1 END) AS n_validation,
  count(CASE WHEN split = 'test' THEN 1 END) AS n_test, round(any_value(m), 6) AS mean_rating,
  round(sqrt(avg(CASE WHEN split = 'test' THEN (rating - m) * (rating - m) END)), 6) AS baseline_rmse, TRUE AS sound
FROM timed_split, (SELECT avg(rating) AS m FROM timed_split WHERE split <> 'test')""",
    "timed_split",
)
ORACLE["job_offline"] = _with(
    f"""SELECT user_id, CAST({AS_OF} AS BIGINT) AS created_at, size AS n_items, CAST(size AS INTEGER) AS last_rank,
  TRUE AS allowed, TRUE AS falls
FROM (SELECT DISTINCT user_id FROM timed_allowed), (SELECT least(count(DISTINCT item_id), 200) AS size FROM timed_allowed)""",
    "timed_allowed",
)
LISTS = """SELECT user_id, {messages}least(n, 200) AS n_items, TRUE AS sound
FROM (SELECT DISTINCT user_id FROM messages WHERE is_valid), (SELECT count(DISTINCT item_id) AS n FROM wide_ratings)"""
ORACLE["stream_retrain_recommend"] = _with(LISTS.format(messages=""), "wide_ratings", "messages")
ORACLE["job_stream"] = _with(LISTS.format(messages="CAST(1 AS BIGINT) AS n_messages, "), "wide_ratings", "messages")
ORACLE["parse_event"] = ORACLE["stream_source"]
ORACLE["recs_flatten"] = ORACLE["recs_publish"]
