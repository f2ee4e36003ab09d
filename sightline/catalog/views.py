"""SQL definitions of the input views, and expressions shared by the checking queries."""

from __future__ import annotations

import re

from sightline.catalog.fixtures import LETTERS, PREFIX, TEMPLATES

STRICT_ID = """nullif(CASE WHEN starts_with(image_path, split_part(image_path, '/', 1) || '/' || split_part(image_path, '/', 1) || '_')
  THEN regexp_extract(substr(image_path, 2 * length(split_part(image_path, '/', 1)) + 3), '^(.+)_IM[0-9]+[.][A-Za-z0-9_]+$', 1) END, '')"""

POSITIONAL_ID = """CASE WHEN len(string_split(split_part(image_path, '/', -1), '_')) >= 3
  THEN string_split(split_part(image_path, '/', -1), '_')[2] END"""


def normalized(label: str) -> str:
    return f"replace(trim(lower(coalesce({label}, 'None'))), '_', ' ')"


def letter_counts(text: str) -> str:
    return "[" + ", ".join(f"CAST(length({text}) - length(replace({text}, '{c}', '')) AS DOUBLE)" for c in LETTERS) + "]"


def listed(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


STRICT_HIT = "(mobileclip_top1 IS NOT DISTINCT FROM mobileclip_gt OR mobileclip_top2 IS NOT DISTINCT FROM mobileclip_gt)"
LOOSE_HIT = f"""({STRICT_HIT} OR mobileclip_top1 = {normalized('classifier_gt')} OR mobileclip_top2 = {normalized('classifier_gt')})"""
HEAD_HIT = "(classifier_pred IS NOT DISTINCT FROM classifier_gt)"

VIEWS = {
    "fx_manifest": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_orderkey % 97 = 0 THEN concat('FRS', CAST(l_suppkey AS VARCHAR), '/malformed.png')
       WHEN l_orderkey % 89 = 0 THEN concat('FRS', CAST(l_suppkey AS VARCHAR), '/FRSX_', CAST(l_partkey AS VARCHAR), '-B_IM0001.png')
       WHEN l_orderkey % 83 = 0 THEN concat('FRS', CAST(l_suppkey AS VARCHAR), '/FRS', CAST(l_suppkey AS VARCHAR), '_', CAST(l_partkey AS VARCHAR), '_B_IM0001.png')
       ELSE concat('FRS', CAST(l_suppkey AS VARCHAR), '/FRS', CAST(l_suppkey AS VARCHAR), '_', CAST(l_partkey AS VARCHAR), '-B_IM', lpad(CAST(l_linenumber AS VARCHAR), 4, '0'), '.png')
  END AS image_path FROM lineitem""",
    "fx_database": """SELECT concat(' ', CAST(p_partkey AS VARCHAR), '-B ') AS id, p_name AS name FROM part WHERE p_partkey % 13 <> 0""",
    "fx_names": "SELECT trim(id) AS object_id, trim(name) AS label FROM fx_database",
    "fx_overrides": """SELECT concat(CAST(p_partkey AS VARCHAR), '-B') AS object_id,
  CASE WHEN p_partkey % 70 = 0 THEN NULL ELSE p_type END AS label FROM part WHERE p_partkey % 7 = 0""",
    "fx_synonyms": "SELECT DISTINCT lower(p_name) AS category, split_part(p_name, ' ', 2) AS canonical FROM part WHERE p_name < 'm'",
    "fx_predictions": """SELECT concat('IM_', CAST(l.l_orderkey AS VARCHAR), '_', CAST(l.l_linenumber AS VARCHAR), '_', CAST(l.l_partkey AS VARCHAR), '_', CAST(l.l_suppkey AS VARCHAR)) AS image,
  concat(CAST(l.l_partkey AS VARCHAR), '-B') AS object_id,
  lower(p.p_name) AS mobileclip_gt,
  CASE WHEN l.l_orderkey % 3 = 0 THEN lower(p.p_name) WHEN l.l_orderkey % 3 = 1 THEN lower(p.p_type) ELSE 'rock' END AS mobileclip_top1,
  CASE WHEN l.l_partkey % 5 = 0 THEN lower(p.p_name) ELSE 'twig' END AS mobileclip_top2,
  CASE WHEN l.l_partkey % 11 = 0 THEN 'UNKNOWN' ELSE p.p_type END AS classifier_gt,
  CASE WHEN l.l_suppkey % 4 = 0 THEN 'PROMO' ELSE p.p_type END AS classifier_pred,
  CASE WHEN l.l_linenumber = 7 THEN NULL ELSE l.l_suppkey % 10 <> 0 END AS yolo_detected,
  CASE WHEN l.l_linenumber = 6 THEN NULL ELSE l.l_quantity END AS mobileclip_ms,
  l.l_tax * 100 AS classifier_ms,
  CASE WHEN l.l_linenumber = 5 THEN NULL ELSE l.l_quantity + l.l_tax * 100 END AS pipeline_ms
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""",
    "fx_detections": """SELECT l_orderkey AS image_id, l_linenumber, l_partkey, l_suppkey, l_discount AS confidence,
  CAST(l_partkey % 150 AS DOUBLE) + CAST(0.37 AS DOUBLE) AS xmin, CAST(l_suppkey % 90 AS DOUBLE) + CAST(0.61 AS DOUBLE) AS ymin,
  CAST(l_partkey % 150 AS DOUBLE) + CAST(0.37 AS DOUBLE) + l_quantity AS xmax, CAST(l_suppkey % 90 AS DOUBLE) + CAST(0.61 AS DOUBLE) + l_quantity * 2 AS ymax,
  200 AS img_w, 160 AS img_h
FROM lineitem WHERE l_orderkey % 19 <> 0""",
    "fx_best": """SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY confidence DESC, l_linenumber, l_partkey, l_suppkey) AS r
  FROM fx_detections) t WHERE r = 1""",
    "fx_bank": """SELECT category_idx, template_idx, list(x ORDER BY pos) AS vec FROM
  (SELECT category_idx, template_idx, pos, avg(x) AS x FROM
    (SELECT label AS category_idx, vec_id % 4 AS template_idx, unnest(range(len(embedding))) AS pos, unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings) e
    GROUP BY category_idx, template_idx, pos) m GROUP BY category_idx, template_idx""",
    "fx_vectors": "SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v, sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x))) AS norm FROM embeddings",
    "fx_scores": """SELECT vec_id, label, category_idx, max(list_sum(list_transform(list_zip(v, vec), lambda p: p[1] / norm * p[2]))) AS score
  FROM fx_vectors, fx_bank WHERE norm > 0 GROUP BY vec_id, label, category_idx""",
    "fx_ranked": "SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(score, 9) DESC, category_idx) AS r FROM fx_scores",
    "fx_logits": "SELECT vec_id, label AS label_idx, list_transform(range(10), lambda i: list_sum(list_filter(CAST(embedding AS DOUBLE[]), lambda x, j: (j - 1) % 10 = i)) * 10) AS logits FROM embeddings",
    "fx_logp": """SELECT vec_id, label_idx, list_transform(logits, lambda x: x - list_max(logits) - ln(list_sum(list_transform(logits, lambda y: exp(y - list_max(logits)))))) AS logp
  FROM fx_logits""",
    "fx_history": """SELECT run_id, CAST(row_number() OVER (PARTITION BY run_id ORDER BY d) AS INTEGER) AS epoch, val_accuracy, train_loss FROM
  (SELECT event_type AS run_id, CAST(ts AS DATE) AS d, avg(value) / 100 AS val_accuracy, stddev_pop(value) AS train_loss FROM events GROUP BY event_type, CAST(ts AS DATE)) t""",
    "fx_latency": "SELECT event_id, event_type AS stage, value AS ms FROM events",
    "fx_scored": """SELECT event_type AS run_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS epoch, user_id % 10 AS y,
  CASE WHEN event_id % 3 = 0 THEN event_id % 10 ELSE user_id % 10 END AS y_pred FROM events""",
    "fx_encoder": "SELECT CAST(row_number() OVER (ORDER BY p_type) - 1 AS INTEGER) AS label_idx, p_type AS label FROM (SELECT DISTINCT p_type FROM part) t",
    "fx_ids": f"SELECT DISTINCT object_id FROM (SELECT {STRICT_ID} AS object_id FROM fx_manifest) t WHERE object_id IS NOT NULL",
    "fx_resolved": """SELECT i.object_id, CASE WHEN o.object_id IS NOT NULL THEN o.label ELSE d.label END AS label,
  o.object_id IS NOT NULL OR d.object_id IS NOT NULL AS mapped
  FROM fx_ids i LEFT JOIN fx_overrides o USING (object_id) LEFT JOIN fx_names d ON d.object_id = i.object_id""",
    "fx_flags": f"""SELECT *, mobileclip_top1 IS NOT DISTINCT FROM mobileclip_gt AS top1_correct, {STRICT_HIT} AS strict_hit, {LOOSE_HIT} AS loose_hit,
  {HEAD_HIT} AS head_hit FROM fx_predictions""",
    "fx_pairs": """SELECT classifier_gt AS y, classifier_pred AS y_pred, count(*) AS n FROM fx_predictions
  WHERE classifier_gt IN (SELECT label FROM fx_encoder) GROUP BY 1, 2""",
    "fx_classes": """SELECT label, CAST(sum(support) AS BIGINT) AS support, CAST(sum(predicted) AS BIGINT) AS predicted, CAST(sum(hits) AS BIGINT) AS hits FROM
  (SELECT y AS label, n AS support, 0 AS predicted, CASE WHEN y = y_pred THEN n ELSE 0 END AS hits FROM fx_pairs
   UNION ALL SELECT y_pred, 0, n, 0 FROM fx_pairs) t GROUP BY label""",
    "fx_rates": """SELECT label, support, predicted, hits,
  CASE WHEN predicted > 0 THEN hits / predicted::DOUBLE ELSE 0 END AS p, CASE WHEN support > 0 THEN hits / support::DOUBLE ELSE 0 END AS r,
  CASE WHEN support + predicted > 0 THEN 2 * hits / (support + predicted)::DOUBLE ELSE 0 END AS f
  FROM (SELECT * FROM fx_classes UNION ALL SELECT label, 0, 0, 0 FROM fx_encoder WHERE label NOT IN (SELECT label FROM fx_classes)) t""",
    "fx_counts": "SELECT label, count(*) AS n FROM embeddings GROUP BY label",
    "fx_quotas": """SELECT label, n, base + CASE WHEN place <= val_rows - given THEN 1 ELSE 0 END AS quota FROM
  (SELECT *, row_number() OVER (ORDER BY rest DESC, label) AS place, sum(base) OVER () AS given FROM
   (SELECT label, n, val_rows, (n * val_rows) // total AS base, (n * val_rows) % total AS rest FROM
    (SELECT label, n, CAST(ceil(sum(n) OVER () * 0.1::DOUBLE) AS BIGINT) AS val_rows, CAST(sum(n) OVER () AS BIGINT) AS total FROM fx_counts) a) b) c""",
    "fx_split": """SELECT vec_id, label, embedding, CASE WHEN place <= quota THEN 'val' ELSE 'train' END AS split FROM
  (SELECT e.*, q.quota, row_number() OVER (PARTITION BY e.label ORDER BY md5('42:' || CAST(vec_id AS VARCHAR)), vec_id) AS place
   FROM embeddings e JOIN fx_quotas q ON q.label = e.label) t""",
    "fx_weights": """SELECT label, CAST(CAST(sum(n) OVER () / (count(*) OVER () * n)::DOUBLE AS FLOAT) AS DOUBLE) AS weight, n FROM
  (SELECT label, count(*) AS n FROM fx_split WHERE split = 'train' GROUP BY label) t""",
    "fx_letters": f"""SELECT doc_id, text, {letter_counts('text')} AS v FROM documents""",
    "fx_categories": "SELECT CAST(row_number() OVER (ORDER BY p_name) - 1 AS INTEGER) AS category_idx, p_name AS category FROM (SELECT DISTINCT p_name FROM part) t",
    "fx_prompts": f"""SELECT category_idx, category, CAST(template_idx AS INTEGER) AS template_idx, template, replace(template, '{{}}', lower(category)) AS prompt FROM
  (SELECT category_idx, category, unnest({listed(TEMPLATES)}) AS template, generate_subscripts({listed(TEMPLATES)}, 1) - 1 AS template_idx FROM fx_categories) t""",
    "fx_prompt_counts": f"SELECT category_idx, category, template_idx, {letter_counts('prompt')} AS v FROM fx_prompts",
    "fx_prompt_bank": """SELECT category_idx, category, template_idx,
  CAST(list_transform(v, lambda x: CAST(x / sqrt(list_sum(list_transform(v, lambda y: y * y))) AS FLOAT)) AS DOUBLE[]) AS vec FROM fx_prompt_counts""",
    "fx_doc_paths": """SELECT doc_id, text, CASE WHEN doc_id % 31 = 0 THEN concat('D', CAST(doc_id % 7 AS VARCHAR), '/broken.png')
  ELSE concat('D', CAST(doc_id % 7 AS VARCHAR), '/D', CAST(doc_id % 7 AS VARCHAR), '_', CAST(doc_id % 3000 AS VARCHAR), '-B_IM', CAST(doc_id AS VARCHAR), '.png') END AS image_path FROM documents""",
    "fx_text_boxes": f"""SELECT doc_id, text, n, unnest(range(n)) AS i, x, y, w, h, c FROM (SELECT doc_id, text, CAST(v[2] AS BIGINT) % 4 AS n, CAST(v[3] AS BIGINT) % 90 AS x, CAST(v[4] AS BIGINT) % 60 AS y,
  10 + CAST(v[5] AS BIGINT) % 50 AS w, 20 + CAST(v[6] AS BIGINT) % 40 AS h, CAST(v[7] AS BIGINT) % 7 AS c FROM fx_letters WHERE CAST(v[1] AS BIGINT) % 101 <> 0) t""",
    "fx_crops": """SELECT doc_id, text, b.doc_id IS NOT NULL AS detected,
  coalesce(greatest(0, CAST(trunc((x + i) - (w + i) * 0.2::DOUBLE) AS BIGINT)), 0) AS x0, coalesce(least(200, CAST(trunc((x + i + w + i) + (w + i) * 0.2::DOUBLE) AS BIGINT)), 200) AS x1
  FROM fx_letters l LEFT JOIN (SELECT doc_id, x, y, w, h, i FROM fx_text_boxes WHERE i = n - 1) b USING (doc_id) WHERE CAST(l.v[1] AS BIGINT) % 101 <> 0""",
    "fx_seen": "SELECT doc_id, detected, substr(text, (length(text) * x0) // 200 + 1, (length(text) * x1) // 200 - (length(text) * x0) // 200) AS seen FROM fx_crops",
    "fx_seen_letters": f"SELECT doc_id, detected, {letter_counts('seen')} AS v FROM fx_seen",
    "fx_type_counts": f"SELECT label_idx, label, {letter_counts('lower(label)')} AS v FROM fx_encoder",
    "fx_type_vectors": "SELECT label_idx, label, CAST(list_transform(v, lambda x: CAST(x / sqrt(list_sum(list_transform(v, lambda y: y * y))) AS FLOAT)) AS DOUBLE[]) AS vec FROM fx_type_counts",
    "fx_hybrid": """SELECT z.doc_id AS image_id, mobileclip_top1, mobileclip_top2, classifier_pred, detected AS yolo_detected FROM
 (SELECT doc_id, detected, max(CASE WHEN r = 1 THEN name END) AS mobileclip_top1, max(CASE WHEN r = 2 THEN name END) AS mobileclip_top2 FROM
  (SELECT doc_id, detected, replace(trim(lower(coalesce(canonical, s.category))), '_', ' ') AS name, row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 9) DESC, category_idx) AS r FROM
   (SELECT doc_id, detected, category_idx, category, max(list_sum(list_transform(list_zip(l.v, vec), lambda p: p[1] / norm * p[2]))) AS score
    FROM (SELECT *, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM fx_seen_letters) l, fx_prompt_bank WHERE norm > 0 GROUP BY ALL) s
   LEFT JOIN fx_synonyms y ON y.category = replace(trim(lower(s.category)), '_', ' ')) t GROUP BY doc_id, detected) z JOIN
 (SELECT doc_id, label AS classifier_pred FROM
  (SELECT doc_id, label, row_number() OVER (PARTITION BY doc_id ORDER BY round(list_sum(list_transform(list_zip(l.v, vec), lambda p: p[1] / norm * p[2])), 9) DESC, label_idx) AS r
   FROM (SELECT *, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM fx_seen_letters) l, fx_type_vectors WHERE norm > 0) t WHERE r = 1) c ON c.doc_id = z.doc_id""",
}


def with_views(sql: str) -> str:
    """The query with the definitions of the views it uses, and of those they use, in front."""
    needed: list[str] = []

    def visit(body: str) -> None:
        for name in re.findall(r"\bfx_\w+", body):
            if name in VIEWS and name not in needed:
                visit(VIEWS[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{name} AS ({VIEWS[name]})" for name in needed) + "\n" + sql


__all__ = ["PREFIX", "STRICT_ID", "POSITIONAL_ID", "STRICT_HIT", "LOOSE_HIT", "HEAD_HIT", "normalized", "with_views"]
