"""SQL text shared by the oracles: splits, neighbours, votes and counts."""

from __future__ import annotations


def split_ctes(source: str, id_col: str, target: str, test: float = 0.2, valid: float = 0.2, seed: int = 42) -> str:
    """CTEs ending in ``split_rows``: all columns of the source, class_rank and split."""
    return f"""
    keyed AS (SELECT *, md5('{seed}|' || {id_col}) AS order_key FROM {source}),
    ranked_rows AS (
      SELECT *, row_number() OVER (PARTITION BY {target} ORDER BY order_key) AS class_rank FROM keyed),
    class_n AS (SELECT {target} AS label_, count(*)::BIGINT AS n FROM keyed GROUP BY ALL),
    total_n AS (
      SELECT sum(n)::BIGINT AS total, ceil(round({test}::DOUBLE * sum(n), 9))::BIGINT AS want FROM class_n),
    test_floor AS (
      SELECT label_, n, (want * n) // total AS base, (want * n) % total AS rem, want FROM class_n, total_n),
    test_quota AS (
      SELECT label_, n, base + CASE WHEN row_number() OVER (ORDER BY rem DESC, label_)
        <= want - sum(base) OVER () THEN 1 ELSE 0 END AS n_test FROM test_floor),
    rest_n AS (
      SELECT sum(n - n_test)::BIGINT AS total,
        ceil(round({valid}::DOUBLE / (1 - {test}::DOUBLE) * sum(n - n_test), 9))::BIGINT AS want FROM test_quota),
    valid_floor AS (
      SELECT label_, n_test, (want * (n - n_test)) // total AS base, (want * (n - n_test)) % total AS rem, want
      FROM test_quota, rest_n),
    quota AS (
      SELECT label_, n_test, n_test + base + CASE WHEN row_number() OVER (ORDER BY rem DESC, label_)
        <= want - sum(base) OVER () THEN 1 ELSE 0 END AS n_valid FROM valid_floor),
    split_rows AS (
      SELECT r.*, CASE WHEN class_rank <= n_test THEN 'test' WHEN class_rank <= n_valid THEN 'valid'
        ELSE 'train' END AS split
      FROM ranked_rows r JOIN quota ON r.{target} = quota.label_)"""


def neighbour_ctes(queries: str, refs: str, k: int, where: str = "TRUE", metric: str = "cosine") -> str:
    """CTEs ending in ``near``; both inputs have id, v (DOUBLE[]) and label."""
    dist = {
        "cosine": "1 - coalesce(list_dot_product(q.v, r.v) / nullif(q.nv * r.nv, 0), 0)",
        "euclidean": "list_distance(q.v, r.v)",
    }[metric]
    return f"""
    q_side AS (SELECT *, sqrt(list_dot_product(v, v)) AS nv FROM {queries}),
    r_side AS (SELECT *, sqrt(list_dot_product(v, v)) AS nv FROM {refs}),
    pairs AS (
      SELECT q.id AS query_id, r.id AS ref_id, r.label AS ref_label,
        CASE WHEN {dist} < 1e-15 THEN 0 ELSE {dist} END AS dist
      FROM q_side q, r_side r WHERE {where}),
    near AS (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY dist, ref_id)::INTEGER AS rank FROM pairs
      QUALIFY rank <= {k})"""


def vote_ctes(weights: str = "uniform") -> str:
    """CTEs ending in ``voted`` (query_id, prediction) and ``shares`` (query_id, label, share)."""
    weight = {
        "uniform": "1.0::DOUBLE",
        "distance": """CASE WHEN min(dist) OVER (PARTITION BY query_id) = 0
          THEN (dist = 0)::INTEGER::DOUBLE ELSE 1 / dist END""",
    }[weights]
    return f"""
    weighted AS (SELECT *, {weight} AS w FROM near),
    votes AS (SELECT query_id, ref_label, sum(w) AS votes FROM weighted GROUP BY ALL),
    voted AS (
      SELECT query_id, ref_label AS prediction FROM votes
      QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY round(votes, 9) DESC, ref_label) = 1),
    shares AS (
      SELECT query_id, ref_label AS label, votes / sum(votes) OVER (PARTITION BY query_id) AS share FROM votes)"""


def vectors(source: str = "embeddings", label: str = "label") -> str:
    return f"SELECT vec_id AS id, vec_id, embedding::DOUBLE[] AS v, {label} AS label FROM {source}"


BINARY = "(CASE WHEN label < 5 THEN 1 ELSE 0 END)"


def scored_ctes(label: str = BINARY, k: int = 5) -> str:
    """CTEs ending in ``preds``: all rows, split, y_true, y_pred, y_proba of the kNN model."""
    return f"""WITH base AS ({vectors(label=label)}),
    {split_ctes("base", "vec_id", "label")},
    train_rows AS (SELECT * FROM split_rows WHERE split = 'train'),
    {neighbour_ctes("split_rows", "train_rows", k)},
    {vote_ctes()},
    preds AS (
      SELECT s.vec_id, s.split, s.label AS y_true, v.prediction AS y_pred,
        coalesce(p.share, 0) AS y_proba
      FROM split_rows s JOIN voted v ON s.id = v.query_id
      LEFT JOIN shares p ON s.id = p.query_id AND p.label = 1)"""


COUNTS = """count(*)::BIGINT AS n,
      count(*) FILTER (y_true = 0 AND y_pred = 0)::BIGINT AS tn,
      count(*) FILTER (y_true = 0 AND y_pred = 1)::BIGINT AS fp,
      count(*) FILTER (y_true = 1 AND y_pred = 0)::BIGINT AS fn,
      count(*) FILTER (y_true = 1 AND y_pred = 1)::BIGINT AS tp"""


def auc_ctes(source: str, by: str) -> str:
    """CTEs ending in ``areas`` (by, roc_auc) by mid-ranks."""
    return f"""
    score_n AS (
      SELECT {by}, y_proba AS score, count(*) FILTER (y_true = 1) AS pos, count(*) FILTER (y_true = 0) AS neg
      FROM {source} GROUP BY ALL),
    score_run AS (
      SELECT *, sum(neg) OVER (PARTITION BY {by} ORDER BY score ROWS UNBOUNDED PRECEDING) - neg AS below
      FROM score_n),
    areas AS (
      SELECT {by}, sum(pos * (below + neg / 2)) / (sum(pos)::DOUBLE * sum(neg)) AS roc_auc
      FROM score_run GROUP BY ALL)"""


def report_ctes(by: str = "split") -> str:
    """CTEs from ``preds`` to ``report``: counts and all metrics per group."""
    return f"""
    {auc_ctes("preds", by)},
    counted AS (SELECT {by}, {COUNTS} FROM preds GROUP BY ALL),
    report AS (
      SELECT c.*, (tp + tn) / n AS accuracy,
        coalesce(tp / nullif(tp + fp, 0), 0)::DOUBLE AS precision,
        coalesce(tp / nullif(tp + fn, 0), 0)::DOUBLE AS recall,
        coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)::DOUBLE AS f1_score,
        coalesce(a.roc_auc, 'nan'::DOUBLE) AS roc_auc,
        coalesce(tn / nullif(tn + fp, 0), 'nan'::DOUBLE) AS specificity,
        coalesce(tn / nullif(tn + fn, 0), 'nan'::DOUBLE) AS npv
      FROM counted c LEFT JOIN areas a USING ({by}))"""
