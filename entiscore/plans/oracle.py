"""DuckDB oracle SQL, one statement per registered query.

Tables ``region nation customer supplier part orders lineitem events
documents embeddings pages benchmark labels conversations`` are views.  Every
output column is aliased to the Spark query's name; floating results are
rounded to ``ROUND_PLACES`` on both sides.
"""

from __future__ import annotations

from entiscore.plans.fixtures import (
    EVENT_BODIES_SQL,
    CODE_PREFIX,
    CREDIT_SQL,
    ITEMS_SQL,
    LABELS_SQL,
    CUSTOMERS_SQL,
    PLANTED_CUSTOMERS_SQL,
    SCORED_SQL,
    TOP_K,
    behavior_sql,
    with_ctes,
)

ROUND_PLACES = 6

TOP_SQL = f"""top_items AS (
  SELECT '{CODE_PREFIX}' || trim(CAST(item_id AS VARCHAR)) AS item_code, trim(item_name) AS item_name, installs
  FROM items ORDER BY installs DESC, item_code DESC, item_name DESC LIMIT {TOP_K})"""

TOKENS_SQL = """tokens AS (
  SELECT entity_id, token, string_split(rtrim(trim(token), ':'), ':') AS parts
  FROM (SELECT trim(entity_id) AS entity_id, unnest(string_split(trim(text), ' ')) AS token FROM behavior))"""

CLASSIFIED_SQL = """classified AS (
  SELECT entity_id, token, trim(parts[1]) AS item_code, TRY_CAST(trim(parts[2]) AS DOUBLE) AS value,
         CASE WHEN trim(token) = '' THEN 'empty'
              WHEN len(parts) <> 2 THEN 'arity'
              WHEN trim(parts[1]) = '' THEN 'empty_code'
              WHEN TRY_CAST(trim(parts[2]) AS DOUBLE) IS NULL THEN 'bad_number'
              ELSE 'ok' END AS status
  FROM tokens)"""

PAIRS_SQL = """pairs AS (SELECT entity_id, item_code, value FROM classified WHERE status = 'ok')"""

USED_SQL = """used AS (
  SELECT item_code,
         CASE WHEN length(item_code) > 2 THEN substr(item_code, 3) ELSE item_code END AS dim_code,
         item_name,
         CAST(row_number() OVER (ORDER BY installs DESC, item_code DESC, item_name DESC) - 1 AS BIGINT) AS column_index
  FROM top_items WHERE item_code IN (SELECT item_code FROM pairs))"""

FEATURES_SQL = """features AS (
  SELECT entity_id, string_agg(CAST(column_index AS VARCHAR) || ':1', ' ' ORDER BY column_index) AS features
  FROM (SELECT DISTINCT p.entity_id, u.column_index FROM pairs p JOIN used u ON p.item_code = u.item_code)
  GROUP BY entity_id)"""

BEHAVIOR_CHAIN = [ITEMS_SQL, behavior_sql(), TOP_SQL, TOKENS_SQL, CLASSIFIED_SQL, PAIRS_SQL, USED_SQL, FEATURES_SQL]


def _q(*ctes: str, body: str) -> str:
    return with_ctes(*ctes) + body


def half_up_sql(sql: str) -> str:
    """Rewrite every ``round(expr, p)`` as ``floor(expr * 10^p + 0.5) / 10^p``.

    DuckDB and Spark round decimal halves differently; this form performs the
    same IEEE operations as the Spark side's rounding.
    """
    out, i, key = [], 0, "round("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:j])
        k, depth, comma = j + len(key), 1, -1
        while depth:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        expr = half_up_sql(sql[j + len(key):comma])
        places = int(sql[comma + 1:k - 1].strip())
        out.append(f"(floor(({expr}) * 1e{places} + 0.5) / 1e{places})")
        i = k


def oracle_sql() -> dict[str, str]:
    return {name: half_up_sql(sql) for name, sql in _oracle_sql().items()}


def _oracle_sql() -> dict[str, str]:
    r = ROUND_PLACES
    q: dict[str, str] = {}
    q["item_topk"] = _q(ITEMS_SQL, TOP_SQL, body="SELECT item_code, item_name, installs FROM top_items")
    q["parse_pairs"] = _q(behavior_sql(), TOKENS_SQL, CLASSIFIED_SQL, PAIRS_SQL,
                          body="SELECT entity_id, item_code, value FROM pairs")
    q["malformed_pairs"] = _q(behavior_sql(extra_bad_numbers=True), TOKENS_SQL, CLASSIFIED_SQL,
                              body="SELECT entity_id, token, status FROM classified WHERE status <> 'ok'")
    q["used_items"] = _q(*BEHAVIOR_CHAIN[:7], body="SELECT item_code, dim_code, item_name, column_index FROM used")
    q["user_item_features"] = _q(*BEHAVIOR_CHAIN, body="SELECT entity_id, features FROM features")
    q["user_item_features_join"] = q["user_item_features"]
    sums = """sums AS (SELECT p.entity_id, u.column_index, SUM(p.value) AS v
             FROM pairs p JOIN used u ON p.item_code = u.item_code GROUP BY p.entity_id, u.column_index)"""
    q["user_item_features_sum"] = _q(*BEHAVIOR_CHAIN[:7], sums, body="""
SELECT entity_id, string_agg(CAST(column_index AS VARCHAR) || ':' || CAST(v AS VARCHAR), ' ' ORDER BY column_index)
       AS features FROM sums GROUP BY entity_id""")
    q.update(more_sql())
    q.update(io_sql())
    q.update(stream_sql())
    q.update(model_sql())
    return q


# ----------------------------------------------------------------- labels & metrics

HARD_CUT = 0.8
PRUNE_AT = 0.5

CLEAN_SQL = """clean AS (
  SELECT entity_id, MIN(CAST(label AS DOUBLE)) AS label FROM known GROUP BY entity_id
  HAVING MIN(label) = MAX(label))"""

GRID_SQL = """grid AS (SELECT CAST(range AS DOUBLE) / 100 AS threshold FROM range(1, 100))"""

SWEEP_SQL = """sweep AS (
  SELECT threshold, n11, n10, n00, n01,
         CASE WHEN n11 + n01 = 0 THEN 0.0 ELSE n11 / (n11 + n01) END AS pre1,
         CASE WHEN n00 + n10 = 0 THEN 0.0 ELSE n00 / (n00 + n10) END AS pre0,
         CASE WHEN num1 = 0 THEN 0.0 ELSE n11 / num1 END AS cov1,
         CASE WHEN num0 = 0 THEN 0.0 ELSE n00 / num0 END AS cov0,
         sqrt((CASE WHEN num1 = 0 THEN 0.0 ELSE n11 / num1 END) * (CASE WHEN num0 = 0 THEN 0.0 ELSE n00 / num0 END)) AS gmean
  FROM (SELECT g.threshold,
               CAST(COUNT(*) FILTER (WHERE s.label = 1 AND s.score > g.threshold) AS BIGINT) AS n11,
               CAST(COUNT(*) FILTER (WHERE s.label = 1 AND s.score <= g.threshold) AS BIGINT) AS n10,
               CAST(COUNT(*) FILTER (WHERE s.label = 0 AND s.score <= g.threshold) AS BIGINT) AS n00,
               CAST(COUNT(*) FILTER (WHERE s.label = 0 AND s.score > g.threshold) AS BIGINT) AS n01,
               (SELECT COUNT(*) FROM scored WHERE label = 1) AS num1,
               (SELECT COUNT(*) FROM scored WHERE label = 0) AS num0
        FROM grid g CROSS JOIN scored s GROUP BY g.threshold))"""

CURVE_SQL = """curve AS (
  SELECT score AS threshold, pos, neg, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, P, N,
         CASE WHEN tp + fp = 0 THEN 1.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS prec,
         CASE WHEN P = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / P END AS rec,
         CASE WHEN N = 0 THEN 0.0 ELSE CAST(fp AS DOUBLE) / N END AS fpr,
         row_number() OVER (ORDER BY score DESC) AS ord
  FROM (SELECT score, pos, neg,
               SUM(pos) OVER (ORDER BY score DESC) AS tp, SUM(neg) OVER (ORDER BY score DESC) AS fp,
               SUM(pos) OVER () AS P, SUM(neg) OVER () AS N
        FROM (SELECT score, SUM(CASE WHEN label > 0.5 THEN 1 ELSE 0 END) AS pos,
                     SUM(CASE WHEN label > 0.5 THEN 0 ELSE 1 END) AS neg
              FROM scored GROUP BY score)))"""

HARD_SQL = f"""hard AS (SELECT doc_id, label, score, CASE WHEN score > {HARD_CUT} THEN 1.0 ELSE 0.0 END AS prediction FROM scored)"""


def _fm(beta: float) -> str:
    b2 = float(beta) * float(beta)
    return (f"CASE WHEN prec + rec = 0 THEN 0.0 ELSE CAST({1.0 + b2} AS DOUBLE) * "
            f"(prec * rec / (CAST({b2} AS DOUBLE) * prec + rec)) END")


def _roc_points() -> str:
    return """roc AS (
  SELECT 0 AS ord, CAST(0.0 AS DOUBLE) AS x, CAST(0.0 AS DOUBLE) AS y
  UNION ALL SELECT ord, fpr, rec FROM curve
  UNION ALL SELECT (SELECT COUNT(*) FROM curve) + 1, CAST(1.0 AS DOUBLE), CAST(1.0 AS DOUBLE))"""


def _pr_points() -> str:
    return """prp AS (
  SELECT 0 AS ord, CAST(0.0 AS DOUBLE) AS x, (SELECT prec FROM curve WHERE ord = 1) AS y
  UNION ALL SELECT ord, rec, prec FROM curve)"""


def _trapezoid(points: str, name: str) -> str:
    return (f"SELECT round(SUM((x - px) * (y + py) / 2), {ROUND_PLACES}) AS {name} FROM "
            f"(SELECT x, y, lag(x) OVER (ORDER BY ord) AS px, lag(y) OVER (ORDER BY ord) AS py FROM {points}) "
            f"WHERE px IS NOT NULL")


CREDIT_MEASURES = ["nation", "n_orders", "total_price", "mean_price"]


def more_sql() -> dict[str, str]:
    r = ROUND_PLACES
    q: dict[str, str] = {}
    q["labeled_features"] = _q(*BEHAVIOR_CHAIN, LABELS_SQL, body="""
SELECT k.entity_id, k.label, f.features, CAST(k.label AS VARCHAR) || ' ' || f.features AS line
FROM known k JOIN features f ON k.entity_id = f.entity_id WHERE length(f.features) > 0""")
    q["split_train_predict"] = _q(*BEHAVIOR_CHAIN, LABELS_SQL, CLEAN_SQL, body="""
SELECT f.entity_id, c.label, f.features, CASE WHEN c.label IS NULL THEN 'predict' ELSE 'train' END AS role
FROM features f LEFT JOIN clean c ON f.entity_id = c.entity_id WHERE length(f.features) > 0""")
    q["class_counts"] = _q(CUSTOMERS_SQL, body="""
SELECT CAST(COUNT(*) AS BIGINT) AS n, CAST(COUNT(*) FILTER (WHERE label = 1) AS BIGINT) AS n1,
       CAST(COUNT(*) FILTER (WHERE label = 0) AS BIGINT) AS n0 FROM known""")
    q["label_profile"] = _q(CREDIT_SQL, body="""
SELECT label, CAST(COUNT(*) AS BIGINT) AS n, round(AVG(n_orders), 4) AS avg_n_orders,
       round(AVG(total_price), 4) AS avg_total_price, round(AVG(mean_price), 4) AS avg_mean_price
FROM credit GROUP BY label""")
    sweep_cols = (f"round(threshold, {r}) AS threshold, n11, n10, n00, n01, round(pre1, {r}) AS pre1, "
                  f"round(pre0, {r}) AS pre0, round(cov1, {r}) AS cov1, round(cov0, {r}) AS cov0, "
                  f"round(gmean, {r}) AS gmean")
    q["threshold_sweep"] = _q(SCORED_SQL, GRID_SQL, SWEEP_SQL, body=f"SELECT {sweep_cols} FROM sweep")
    q["best_threshold"] = _q(SCORED_SQL, GRID_SQL, SWEEP_SQL, body=f"""
SELECT {sweep_cols} FROM sweep WHERE gmean > 0 ORDER BY gmean DESC, threshold ASC LIMIT 1""")
    q["prune_positives"] = _q(SCORED_SQL, body=f"""
SELECT doc_id, label, round(score, {r}) AS score FROM scored
WHERE (label = 1 AND score >= {PRUNE_AT}) OR label = 0""")
    q["metrics_by_threshold"] = _q(SCORED_SQL, CURVE_SQL, body=f"""
SELECT round(threshold, {r}) AS threshold, tp, fp, round(prec, {r}) AS "precision", round(rec, {r}) AS recall,
       round(fpr, {r}) AS fpr, round({_fm(1.0)}, {r}) AS f_measure FROM curve""")
    q["fmeasure_by_threshold_half"] = _q(SCORED_SQL, CURVE_SQL, body=f"""
SELECT round(threshold, {r}) AS threshold, round({_fm(0.5)}, {r}) AS f_measure FROM curve""")
    q["roc_curve"] = _q(SCORED_SQL, CURVE_SQL, body=f"""
SELECT CAST(NULL AS DOUBLE) AS threshold, CAST(0.0 AS DOUBLE) AS fpr, CAST(0.0 AS DOUBLE) AS tpr
UNION ALL SELECT CAST(NULL AS DOUBLE), CAST(1.0 AS DOUBLE), CAST(1.0 AS DOUBLE)
UNION ALL SELECT round(threshold, {r}), round(fpr, {r}), round(rec, {r}) FROM curve""")
    q["pr_curve"] = _q(SCORED_SQL, CURVE_SQL, body=f"""
SELECT CAST(NULL AS DOUBLE) AS threshold, CAST(0.0 AS DOUBLE) AS recall, round(prec, {r}) AS "precision"
FROM curve WHERE ord = 1
UNION ALL SELECT round(threshold, {r}), round(rec, {r}), round(prec, {r}) FROM curve""")
    q["area_under_roc"] = _q(SCORED_SQL, CURVE_SQL, _roc_points(), body=_trapezoid("roc", "area_under_roc"))
    q["area_under_pr"] = _q(SCORED_SQL, CURVE_SQL, _pr_points(), body=_trapezoid("prp", "area_under_pr"))
    q["accuracy"] = _q(SCORED_SQL, HARD_SQL, body=f"""
SELECT n, correct, round(acc, {r}) AS accuracy, round(1.0 - acc, {r}) AS error FROM (
  SELECT CAST(COUNT(*) AS BIGINT) AS n, CAST(COUNT(*) FILTER (WHERE label = prediction) AS BIGINT) AS correct,
         CASE WHEN COUNT(*) = 0 THEN 0.0 ELSE COUNT(*) FILTER (WHERE label = prediction) / COUNT(*) END AS acc
  FROM hard)""")
    q["class_recall"] = _q(SCORED_SQL, HARD_SQL, body=f"""
SELECT n, correct, round(CASE WHEN n = 0 THEN 0.0 ELSE correct / n END, {r}) AS recall FROM (
  SELECT CAST(COUNT(*) AS BIGINT) AS n, CAST(COUNT(*) FILTER (WHERE prediction = label) AS BIGINT) AS correct
  FROM hard WHERE label = 1)""")
    q["match_counts"] = _q(SCORED_SQL, HARD_SQL, body="""
SELECT CAST(COUNT(*) FILTER (WHERE label - prediction = 0) AS BIGINT) AS matched,
       CAST(COUNT(*) FILTER (WHERE label - prediction <> 0) AS BIGINT) AS unmatched FROM hard""")
    hard_curve = CURVE_SQL.replace("FROM scored GROUP BY score", "FROM (SELECT label, prediction AS score FROM hard) GROUP BY score")
    q["evaluate_binary"] = _q(SCORED_SQL, HARD_SQL, hard_curve, _roc_points(), body=f"""
SELECT (SELECT area_under_roc FROM ({_trapezoid("roc", "area_under_roc")})) AS area_under_roc,
       round((SELECT COUNT(*) FILTER (WHERE label = prediction) / COUNT(*) FROM hard), {r}) AS accuracy""")
    idx_sql = """idx AS (SELECT lab, CAST(row_number() OVER (ORDER BY c DESC, lab ASC) - 1 AS DOUBLE) AS i
          FROM (SELECT CAST(label AS VARCHAR) AS lab, COUNT(*) AS c FROM hard GROUP BY 1))"""
    q["drop_majority_errors_step"] = _q(SCORED_SQL, HARD_SQL, idx_sql, body=f"""
SELECT h.doc_id, h.label, li.i AS indexed_label, pi.i AS prediction
FROM hard h JOIN idx li ON CAST(h.label AS VARCHAR) = li.lab
LEFT JOIN idx pi ON (CASE WHEN h.score > {HARD_CUT} THEN '1' ELSE '0' END) = pi.lab
WHERE (li.i = 0 AND pi.i = li.i) OR li.i = 1""")
    prio_idx = """pidx AS (SELECT lab, CAST(row_number() OVER (ORDER BY c DESC, lab ASC) - 1 AS DOUBLE) AS i
  FROM (SELECT o_orderpriority AS lab, COUNT(*) AS c FROM orders GROUP BY 1))"""
    q["index_labels"] = _q(prio_idx, body="""
SELECT o.o_orderkey, o.o_orderpriority, p.i AS priority_index, p.lab AS decoded
FROM orders o JOIN pidx p ON o.o_orderpriority = p.lab""")
    q["one_hot"] = _q(prio_idx, body="""
SELECT o.o_orderkey, p.i AS priority_index, CAST((SELECT COUNT(*) FROM pidx) - 1 AS BIGINT) AS onehot_size,
       CAST(CASE WHEN p.i < (SELECT COUNT(*) FROM pidx) - 1 THEN p.i ELSE -1 END AS BIGINT) AS onehot_active
FROM orders o JOIN pidx p ON o.o_orderpriority = p.lab""")
    q["assemble"] = _q(CREDIT_SQL, body="SELECT customer_id, " + ", ".join(
        f"round(CAST({c} AS DOUBLE), {r}) AS f{i}" for i, c in enumerate(CREDIT_MEASURES)) + " FROM credit")
    std = ", ".join(
        f"round(CASE WHEN stddev_samp({c}) OVER () = 0 THEN 0.0 ELSE {c} / stddev_samp({c}) OVER () END, {r}) AS {n}"
        for c, n in (("nation", "nation_scaled"), ("n_orders", "orders_scaled"), ("total_price", "price_scaled")))
    q["standardize"] = _q(CREDIT_SQL, body=f"SELECT customer_id, {std} FROM credit")
    q["split_by_key"] = _q(CREDIT_SQL, body="""
SELECT customer_id, label, CASE WHEN customer_id % 100 < 80 THEN 0 ELSE 1 END AS part FROM credit""")
    q["undersample"] = _q(CREDIT_SQL, body="""
SELECT customer_id, label FROM credit
WHERE (label = 0 AND customer_id % 100 < 30) OR (label = 1 AND customer_id % 100 < 100)""")
    q["kmeans_assign"] = f"""
WITH c AS (SELECT vec_id AS cid, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS cv
           FROM embeddings WHERE vec_id < 4),
d AS (SELECT e.vec_id, c.cid,
             list_sum(list_transform(list_zip(list_transform(e.embedding, lambda x: CAST(x AS DOUBLE)), c.cv),
                                     lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS dist
      FROM embeddings e CROSS JOIN c)
SELECT vec_id, CAST(cid AS INTEGER) AS cluster, round(dist, 4) AS distance FROM (
  SELECT vec_id, cid, dist, row_number() OVER (PARTITION BY vec_id ORDER BY dist, cid) AS rn FROM d)
WHERE rn = 1"""
    return q


# ------------------------------------------------------------------ sources, sinks, scoring

EP_SQL = """ep AS (SELECT DISTINCT p.entity_id, u.column_index FROM pairs p JOIN used u ON p.item_code = u.item_code)"""
MARGIN_SQL = """sc AS (SELECT entity_id, SUM(CAST((column_index % 7) - 3 AS DOUBLE)) AS margin FROM ep GROUP BY entity_id)"""


def io_sql() -> dict[str, str]:
    r = ROUND_PLACES
    q: dict[str, str] = {}
    lab = """lab AS (SELECT CAST(k.label AS DOUBLE) AS label, f.features FROM known k
               JOIN features f ON k.entity_id = f.entity_id WHERE length(f.features) > 0)"""
    q["sparse_text_roundtrip"] = _q(*BEHAVIOR_CHAIN, LABELS_SQL, lab, body="""
SELECT label,
       (SELECT MAX(CAST(split_part(string_split(features, ' ')[-1], ':', 1) AS BIGINT)) + 1 FROM lab) AS num_features,
       replace(features, ':1', '') AS indices
FROM lab""")
    q["dense_text_roundtrip"] = """
SELECT vec_id, CAST(len(embedding) AS BIGINT) AS size,
       round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 4) AS total
FROM embeddings"""
    q["csv_typed_roundtrip"] = _q(CREDIT_SQL, body="""
SELECT CAST(customer_id AS INTEGER) AS customer_id, CAST(nation AS INTEGER) AS nation,
       CAST(label AS INTEGER) AS label, CAST(n_orders AS INTEGER) AS n_orders FROM credit""")
    q["csv_raw_roundtrip"] = _q(CUSTOMERS_SQL, body="SELECT entity_id, CAST(label AS VARCHAR) AS label FROM known")
    q["labeled_csv"] = _q(CREDIT_SQL, body="SELECT CAST(CAST(label AS INTEGER) AS DOUBLE) AS label, " + ", ".join(
        f"round(CAST({c} AS DOUBLE), 4) AS f{i}" for i, c in enumerate(CREDIT_MEASURES)) + " FROM credit")
    # Vector index: a slot with ≤ 20 distinct values becomes categorical; 0.0 maps
    # to 0 when present, the other values follow in ascending order.
    cols = []
    for i, c in enumerate(CREDIT_MEASURES):
        cat = (f"CASE WHEN {c} = 0 THEN 0 ELSE DENSE_RANK() OVER (PARTITION BY ({c} = 0) ORDER BY {c}) - 1 "
               f"+ (SELECT MAX(CASE WHEN {c} = 0 THEN 1 ELSE 0 END) FROM credit) END")
        cols.append(f"round(CASE WHEN (SELECT COUNT(DISTINCT {c}) FROM credit) <= 20 "
                    f"THEN CAST({cat} AS DOUBLE) ELSE CAST({c} AS DOUBLE) END, {ROUND_PLACES}) AS f{i}")
    q["index_vector"] = _q(CREDIT_SQL, body="SELECT customer_id, " + ", ".join(cols) + " FROM credit")
    q["model_roundtrip"] = "SELECT c_custkey AS customer_id, TRUE AS same FROM customer"
    q["table_roundtrip"] = _q(CUSTOMERS_SQL, body="SELECT entity_id, CAST(label AS VARCHAR) AS label FROM known")
    q["partition_overwrite"] = _q(CUSTOMERS_SQL, body="""
SELECT entity_id, label, '20240101' AS stat_date FROM known WHERE label = 1
UNION ALL SELECT entity_id, label, '20240102' AS stat_date FROM known""")
    q["partition_table"] = q["partition_overwrite"]
    q["logistic_score_join"] = q["logistic_score"] = _q(*BEHAVIOR_CHAIN, EP_SQL, MARGIN_SQL, body=f"""
SELECT entity_id, round(margin, {r}) AS margin, round(1 / (1 + exp(-margin)), {r}) AS score FROM sc""")
    tagged = """tagged AS (SELECT f.entity_id, c.label FROM features f LEFT JOIN clean c ON f.entity_id = c.entity_id
                 WHERE length(f.features) > 0)"""
    q["logistic_gradient"] = _q(*BEHAVIOR_CHAIN, LABELS_SQL, CLEAN_SQL, tagged, EP_SQL, body="""
SELECT u.column_index, CAST(COUNT(t.entity_id) AS BIGINT) AS n_rows, CAST(0.0 AS DOUBLE) AS slope
FROM used u LEFT JOIN ep e ON e.column_index = u.column_index
LEFT JOIN tagged t ON t.entity_id = e.entity_id AND t.label IS NOT NULL GROUP BY u.column_index""")
    q["assign_classes"] = _q(*BEHAVIOR_CHAIN, LABELS_SQL, CLEAN_SQL, tagged, EP_SQL, MARGIN_SQL, body="""
SELECT entity_id, CASE WHEN label = 1 THEN '1' ELSE '0' END AS class, 'known' AS source
FROM tagged WHERE label IS NOT NULL
UNION ALL
SELECT t.entity_id, CASE WHEN 1 / (1 + exp(-s.margin)) > 0.5 THEN '1' ELSE '0' END AS class, 'model' AS source
FROM tagged t JOIN sc s ON t.entity_id = s.entity_id WHERE t.label IS NULL""")
    return q


def stream_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["stream_tokens"] = _q(EVENT_BODIES_SQL, body="""
SELECT event_id, word FROM (SELECT event_id, unnest(string_split(value, ' ')) AS word FROM bodies)
WHERE word <> ''""")
    r = ROUND_PLACES
    margin = "0.1 * value - 1.0 + CASE WHEN event_type = 'purchase' THEN 0.5 ELSE 0.0 END"
    q["stream_score"] = f"""
SELECT event_id, round(CASE WHEN score > 0.5 THEN 1.0 ELSE 0.0 END, {r}) AS prediction, round(score, {r}) AS score
FROM (SELECT event_id, 1.0 / (1.0 + exp(-(CAST({margin} AS DOUBLE)))) AS score FROM events)"""
    q["stream_score_batches"] = f"SELECT *, CAST(0 AS BIGINT) AS batch_id FROM ({q['stream_score']})"
    q["stream_batch_counts"] = "SELECT CAST(0 AS BIGINT) AS batch_id, CAST(COUNT(*) AS BIGINT) AS n_rows FROM events"
    q["stream_score_model"] = "SELECT event_id, TRUE AS same FROM events"
    return q


# ------------------------------------------------------------------ trained models on planted inputs

PLANTED_SQL = CREDIT_SQL.replace("CASE WHEN c.c_acctbal < 0 THEN 1 ELSE 0 END AS label",
                                 "CASE WHEN c.c_nationkey < 10 THEN 1 ELSE 0 END AS label")
TAGGED_SQL = """tagged AS (SELECT f.entity_id, c.label FROM features f LEFT JOIN clean c ON f.entity_id = c.entity_id
             WHERE length(f.features) > 0)"""
# index 0 is the most frequent label of the training rows, the smaller text on ties
_INDEX = """first_label AS (SELECT CAST(label AS INTEGER) AS l FROM {rows} GROUP BY label ORDER BY COUNT(*) DESC, label LIMIT 1)"""


def model_sql() -> dict[str, str]:
    r = ROUND_PLACES
    q: dict[str, str] = {}
    on_test = "SELECT customer_id, CAST(label AS DOUBLE) AS label, CAST(label AS DOUBLE) AS prediction FROM credit WHERE customer_id % 100 >= 80"
    q["train_tree"] = q["train_cv"] = _q(PLANTED_SQL, body=on_test)
    train = "train AS (SELECT * FROM credit WHERE customer_id % 100 < 70)"
    q["train_forest"] = _q(PLANTED_SQL, train, _INDEX.format(rows="train"), body="""
SELECT customer_id, label, CASE WHEN label = (SELECT l FROM first_label) THEN 0.0 ELSE 1.0 END::DOUBLE AS prediction,
       CAST(label AS VARCHAR) AS predicted_label FROM credit WHERE customer_id % 100 >= 70""")
    q["forest_importances"] = "SELECT CAST(0 AS INTEGER) AS feature, CAST(1.0 AS DOUBLE) AS importance"
    q["labeled_csv_forest"] = _q(PLANTED_SQL, "t AS (SELECT * FROM credit WHERE customer_id % 100 >= 80)",
                                 "c AS (SELECT SUM(label)::BIGINT AS p, (COUNT(*) - SUM(label))::BIGINT AS n FROM t)", body=f"""
SELECT 1.0::DOUBLE AS threshold, p AS tp, 0::BIGINT AS fp, 1.0::DOUBLE AS "precision", 1.0::DOUBLE AS recall,
       0.0::DOUBLE AS fpr, 1.0::DOUBLE AS f_measure FROM c
UNION ALL SELECT 0.0, p, n, round(p / (p + n), {r}), 1.0, 1.0, round(2 * (p / (p + n)) / (p / (p + n) + 1), {r}) FROM c""")
    q["train_logistic"] = _q(*BEHAVIOR_CHAIN, LABELS_SQL, CLEAN_SQL, TAGGED_SQL, body="""
SELECT CASE WHEN label IS NULL THEN 'predict' ELSE 'train' END AS role, CAST(COUNT(*) AS BIGINT) AS n,
       round(AVG(label), 3) AS mean_label, round(AVG(label), 3) AS mean_score FROM tagged GROUP BY 1""")
    q["train_with_pruning"] = _q(*BEHAVIOR_CHAIN, LABELS_SQL, CLEAN_SQL, TAGGED_SQL, GRID_SQL, """c AS (
  SELECT CAST(entity_id AS BIGINT) % 100 >= 80 AS held, label FROM tagged WHERE label IS NOT NULL)""", """n AS (
  SELECT COUNT(*) FILTER (WHERE held AND label = 1) AS held1, COUNT(*) FILTER (WHERE held AND label = 0) AS held0,
         COUNT(*) FILTER (WHERE NOT held AND label = 1) AS train1, COUNT(*) FILTER (WHERE NOT held AND label = 0) AS train0
  FROM c)""", body=f"""
SELECT CAST(i.range AS INTEGER) AS iteration, round(g.threshold, {r}) AS threshold, held1::BIGINT AS held1,
       held0::BIGINT AS held0, CASE WHEN i.range = 0 THEN train1 ELSE -1 END::BIGINT AS train1,
       CASE WHEN i.range = 0 THEN train0 ELSE -1 END::BIGINT AS train0
FROM n, grid g, range(0, 10) i""")
    q["drop_majority_errors"] = _q(PLANTED_SQL, _INDEX.format(rows="credit"), """s AS (
  SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE label = (SELECT l FROM first_label) AND customer_id % 7 = 0) AS gone
  FROM credit)""", body="""
SELECT CAST(i.range AS INTEGER) AS round, CAST(CASE WHEN i.range = 0 THEN n ELSE n - gone END AS BIGINT) AS rows
FROM s, range(0, 3) i""")
    q["undersample_correct"] = _q(PLANTED_SQL, _INDEX.format(rows="credit"), """c AS (
  SELECT label, label = (SELECT l FROM first_label) AS major, COUNT(*) AS n, COUNT(*) FILTER (WHERE customer_id % 7 = 0) AS wrong
  FROM credit GROUP BY label)""", body="""
SELECT CAST(label AS DOUBLE) AS label, CAST(CASE WHEN major THEN (n - wrong) * 3 // 10 ELSE n END AS BIGINT) AS n,
       CAST(CASE WHEN major THEN (n - wrong) * 3 // 10 ELSE n END AS BIGINT) AS n_distinct,
       CAST(CASE WHEN major THEN 0 ELSE wrong END AS BIGINT) AS n_wrong FROM c""")
    q["tree_nodes"] = _q(PLANTED_SQL, "n AS (SELECT label, COUNT(*) AS n FROM credit GROUP BY label)", """major AS (
  SELECT label FROM n ORDER BY n DESC, label LIMIT 1)""", body="""
SELECT 0::INT AS node, NULL::INT AS parent, 0::INT AS feature, TRUE AS in_gap, (SELECT label FROM major)::DOUBLE AS prediction,
       (SELECT SUM(n) FROM n)::BIGINT AS rows, 0::INT AS depth, '' AS rule
UNION ALL SELECT CASE WHEN label = 1 THEN 1 ELSE 2 END, 0, NULL, NULL, label::DOUBLE, n::BIGINT, 1,
                 CASE WHEN label = 1 THEN 'feature 0 <= 9' ELSE 'feature 0 > 9' END FROM n""")
    q["behavior_model_job_planted"] = _q(PLANTED_CUSTOMERS_SQL, body="""
SELECT CAST(id AS VARCHAR) AS entity_id, CASE WHEN CASE WHEN known THEN first ELSE strong END THEN '1' ELSE '0' END AS class,
       '20240101' AS stat_date FROM planted""")
    # part 2 is scored with the share of label 1 among its training rows until the weak ones are pruned, then with about 0
    q["pruning_trajectory"] = _q(PLANTED_CUSTOMERS_SQL, GRID_SQL, """n AS (
  SELECT COUNT(*) FILTER (WHERE NOT held AND first) AS p, COUNT(*) FILTER (WHERE NOT held AND strong) AS s,
         COUNT(*) FILTER (WHERE NOT held AND NOT first) AS m, COUNT(*) FILTER (WHERE held AND first) AS hp,
         COUNT(*) FILTER (WHERE held AND strong) AS hs FROM planted WHERE known)""", body=f"""
SELECT CAST(i.range AS INTEGER) AS iteration, CAST(CASE WHEN i.range = 0 THEN p ELSE s END AS BIGINT) AS train1, CAST(m AS BIGINT) AS train0,
       round(CASE WHEN i.range = 0 THEN (SELECT MIN(threshold) FROM grid WHERE threshold >= (p - s) / (p - s + m)) ELSE 0.01 END, {r}) AS threshold,
       round(sqrt(hs / hp), {r}) AS gmean, i.range = 0 AS kept FROM n, range(0, 10) i""")
    q["tree_refit_job"] = q["tree_refit_job_trees"] = _q(PLANTED_SQL, """f AS (
  SELECT customer_id % 100 >= 80 AS held, label AS rule,
         CASE WHEN customer_id % 50 = 0 THEN 1 - label ELSE label END AS label FROM credit)""",
                             "train AS (SELECT * FROM f WHERE NOT held)", _INDEX.format(rows="train"), """t AS (
  SELECT CASE WHEN rule = l THEN 0 ELSE 1 END AS said, CASE WHEN label = l THEN 0 ELSE 1 END AS lab FROM f, first_label
  WHERE held)""", """c AS (
  SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE said = lab) AS hit, COUNT(*) FILTER (WHERE lab = 1) AS p,
         COUNT(*) FILTER (WHERE lab = 1 AND said = 1) AS tp, COUNT(*) FILTER (WHERE lab = 0) AS m,
         COUNT(*) FILTER (WHERE lab = 0 AND said = 1) AS fp FROM t)""", body=f"""
SELECT round((tp / p + 1 - fp / m) / 2, {r}) AS area_under_roc, round(hit / n, {r}) AS accuracy,
       (SELECT COUNT(*) FROM train)::BIGINT AS rows_first,
       (SELECT COUNT(*) FROM train, first_label WHERE NOT (label = l AND rule <> l))::BIGINT AS rows_last,
       round(tp / p, {r}) AS class1_recall FROM c""")
    groups = """p AS (
  SELECT vec_id, vec_id % 4 AS g, generate_subscripts(embedding, 1) - 1 AS component, unnest(embedding)::DOUBLE AS x FROM embeddings
), g AS (
  SELECT vec_id, g, component, x + CASE WHEN component = g AND g < 3 THEN 10.0 ELSE 0.0 END::DOUBLE AS v FROM p
), m AS (SELECT g, component, AVG(v) AS m FROM g GROUP BY g, component)"""
    q["kmeans_centers"] = _q(groups, body="""
SELECT CAST(g AS INTEGER) AS corner, CAST(component AS INTEGER) AS component, floor(m * 10000 + 0.5) / 10000 AS value FROM m""")
    q["kmeans_cost_sweep"] = _q(groups, """e AS (
  SELECT SUM((v - m) * (v - m)) AS cost FROM g JOIN m ON g.g = m.g AND g.component = m.component)""", body="""
SELECT CAST(i.range AS INTEGER) AS k, CAST(i.range - 1 AS INTEGER) AS position, TRUE AS as_trained,
       round(planted.cost, 2) AS planted_cost FROM e AS planted, range(2, 7) i""")
    q["undersample_random"] = _q(CREDIT_SQL, body="""
SELECT label, CAST(COUNT(*) AS BIGINT) AS n, TRUE AS as_asked FROM credit GROUP BY label""")
    q["behavior_model_job"] = _q(*BEHAVIOR_CHAIN, LABELS_SQL, CLEAN_SQL, TAGGED_SQL, body="""
SELECT entity_id, CASE WHEN label = 1 THEN '1' WHEN label = 0 THEN '0' END AS known_class, TRUE AS has_class,
       '20240101' AS stat_date FROM tagged""")
    return q
