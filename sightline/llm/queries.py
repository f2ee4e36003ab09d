"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.catalog.registry import register
from sightline.llm import alignment, bpe, dialogues, fingerprints, language, nearcopies, packing, personal, phrases, search, toxicity, urls, windows

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2
RULES = [urls.Rule("net", "/", "block"), urls.Rule("example.net", "/en/", "allow"), urls.Rule("example.com", "/de/", "block"), urls.Rule("org", "/fr/", "allow")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(key: str, by: int) -> Column:
    """crc32 of the key as text, modulo a number."""
    return F.crc32(F.col(key).cast("string")) % by


@register("op1_fingerprints")
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compared(table(spark, sf_dir, "documents"))


@register("op2_language")
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(remainder("doc_id", 5) != 0))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# rows that share a key are one document: their texts are linked to each other
LINKED_SQL = f"""WITH RECURSIVE w AS (SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT id, doc_id, sh FROM (SELECT id, doc_id, unnest(CASE WHEN len(ws) >= 4 THEN list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))
  WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w) t),
n AS (SELECT id, doc_id, count(*) AS n FROM s GROUP BY id, doc_id),
p AS (SELECT a.id AS u, b.id AS v, count(*) AS i FROM s a JOIN s b ON a.sh = b.sh AND a.id <> b.id WHERE a.doc_id IS NOT NULL AND b.doc_id IS NOT NULL GROUP BY 1, 2),
l AS (SELECT u, v FROM p JOIN n x ON x.id = u JOIN n y ON y.id = v WHERE 100 * i >= 85 * (x.n + y.n - i)),
k AS (SELECT u, v FROM l UNION SELECT a.id, b.id FROM w a JOIN w b ON a.doc_id = b.doc_id AND a.id <> b.id),
r AS (SELECT u AS id, u AS far FROM k UNION SELECT r.id, k.v FROM r JOIN k ON k.u = r.far),
c AS (SELECT r.id, min(w.doc_id) AS component_id FROM r JOIN w ON w.id = r.far GROUP BY r.id)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, w.doc_id) AS component_id
FROM w LEFT JOIN n ON n.id = w.id LEFT JOIN c ON c.id = w.id"""


@register("op3_near_copies", LINKED_SQL)
def op3_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearcopies.linked(table(spark, sf_dir, "documents"), words=4, percent=85)


LINKS_SQL = f"""{LINKED_SQL[: LINKED_SQL.index("k AS (SELECT")]}
k AS (SELECT u, count(*) AS n_links FROM l GROUP BY u),
e AS (SELECT u, min(y.doc_id) AS least FROM p JOIN n x ON x.id = u JOIN n y ON y.id = v WHERE i = x.n AND i = y.n GROUP BY u)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(e.least, w.doc_id)) AS class_id, CASE WHEN w.doc_id IS NOT NULL THEN coalesce(k.n_links, 0) END AS n_links
FROM w LEFT JOIN n ON n.id = w.id LEFT JOIN k ON k.u = w.id LEFT JOIN e ON e.u = w.id"""


@register("op3_near_copy_links", LINKS_SQL)
def op3_near_copy_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearcopies.link_counts(table(spark, sf_dir, "documents"), words=4, percent=85)


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


@register("op4_personal")
def op4_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal.find_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda x: x["kind"].isin(personal.BASE))
    return found.select("doc_id", *[count(k) for k in personal.BASE], F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


# whole dialogues of any length
PERSPECTIVES_SQL = """WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
g AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role NULLS FIRST, md5(text)) AS said FROM t GROUP BY conv_id),
p AS (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role <> 'system'),
e AS (SELECT g.conv_id, said, speaker,
  list_transform(said, lambda s: concat('<|im_start|>', CASE WHEN s.role = speaker THEN 'assistant' WHEN s.role = 'system' THEN 'system' ELSE concat('user', coalesce(' name=' || s.role, '')) END, chr(10))) AS heads,
  list_transform(said, lambda s: concat(s.text, '<|im_end|>')) AS bodies
  FROM g JOIN p ON g.conv_id IS NOT DISTINCT FROM p.conv_id),
f AS (SELECT *, list_transform(range(1, len(said) + 1), lambda i: coalesce(list_sum(list_transform(heads[1:i - 1], lambda h: length(h))), 0) + coalesce(list_sum(list_transform(bodies[1:i - 1], lambda b: length(b))), 0) + i - 1 + length(heads[i])) AS firsts FROM e)
SELECT conv_id, speaker, 0::BIGINT AS part, 0::BIGINT AS start, len(said)::INTEGER AS n_turns, array_to_string(list_transform(list_zip(heads, bodies), lambda x: concat(x[1], x[2], chr(10))), '') AS rendered,
  array_to_string(list_transform(list_filter(range(1, len(said) + 1), lambda i: said[i].role = speaker), lambda i: concat(firsts[i]::BIGINT, ':', (firsts[i] + length(bodies[i]))::BIGINT)), ',') AS masks FROM f"""


@register("op5_perspectives", PERSPECTIVES_SQL)
def op5_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rendered = dialogues.perspectives(table(spark, sf_dir, "conversations"))
    masks = F.array_join(F.transform("masks", lambda x: F.concat_ws(":", x["start"].cast("string"), x["end"].cast("string"))), ",")
    return rendered.withColumn("masks", masks).drop("lead")


TOP_SQL = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""


@register("op6_top_k", TOP_SQL)
def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@register("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(remainder("doc_id", 3) != 1))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        F.size("offending").alias("n_offending"),
    )


@register("op8_packing")
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), TOKENIZER, END_ID)


@register("op9_url_filter")
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), RULES, keep=["page_id"])


@register("op10_bpe")
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).drop("text")


PHRASES_SQL = f"""WITH w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws
  FROM (SELECT coalesce(lang, '{phrases.UNKNOWN}') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents) p),
f AS (SELECT lang, k, phrase, count(*) AS n FROM (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
  FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) ks) t GROUP BY ALL),
c AS (SELECT lang, k AS words, phrase, n AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND n >= {phrases.LEAST}),
x AS (SELECT lang, phrase, a, k, array_to_string(ws[:k], ' ') AS head, array_to_string(ws[k + 1:], ' ') AS rest FROM c, (SELECT unnest([1, 2, 3]) AS k) ks WHERE k < words),
y AS (SELECT x.*, u.n AS l, v.n AS r, ({phrases.SCALE}::HUGEINT * a) // (u.n::HUGEINT + v.n) AS score
  FROM x JOIN f u ON u.lang = x.lang AND u.phrase = head JOIN f v ON v.lang = x.lang AND v.phrase = rest),
z AS (SELECT * FROM y QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
s AS (SELECT DISTINCT lang, a AS longer, array_to_string(ws[i:j], ' ') AS phrase FROM c, (SELECT unnest(range(1, 5)) AS i) i, (SELECT unnest(range(1, 5)) AS j) j WHERE i < j AND j <= words AND j - i + 1 < words),
kept AS (SELECT z.* FROM z WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.lang = z.lang AND s.phrase = z.phrase AND 100 * longer::HUGEINT >= {phrases.SHARE} * z.a)),
t AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang)
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM kept JOIN t ON t.lang = kept.lang QUALIFY rank <= 2000"""


@register("op11_phrases", PHRASES_SQL)
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.best_collocations(table(spark, sf_dir, "documents"))


PIECES = public_tokenizers.path("piece_bpe_32k.model")


@register("op12_alignment")
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), TOKENIZER, PIECES)


LOWER_WORDS = public_tokenizers.path("word_bpe_49k.json")


@register("op13_windows")
def op13_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.pack(table(spark, sf_dir, "documents"), LOWER_WORDS, END_ID)
