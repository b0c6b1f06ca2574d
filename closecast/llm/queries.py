"""Registered queries of the training-data operators and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closecast.llm.ball_codes import vector_codes
from closecast.llm.common import table
from closecast.llm.decontaminate import decontaminate
from closecast.llm.langid import identify
from closecast.llm.langid import train as train_languages
from closecast.llm.licenses import scan_licenses
from closecast.llm.line_dedup import dedup_lines
from closecast.llm.mixing import mix_sources
from closecast.llm.nearest import nearest_vectors
from closecast.llm.norm_topk import top_products
from closecast.llm.order_minhash import near_duplicates
from closecast.llm.quality import score_quality, train
from closecast.llm.spelling import spelling_variants
from closecast.llm.substring_dedup import dedup_substrings
from closecast.llm.warc import archive_pages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


# Words of a text, as the contract names them: A-Z lower-cased only.
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP3_SQL = f"""
WITH iw AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
items AS (SELECT item_id, w, CASE WHEN len(w) < 10 THEN len(w) ELSE 10 END AS k FROM iw WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s
        FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM items)),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
ks AS (SELECT DISTINCT k FROM win),
dwin AS (SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS s
         FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, ks WHERE len(w) >= k)),
hits AS (SELECT DISTINCT d.r, d.i, d.k, win.item_id FROM dwin d JOIN win ON win.k = d.k AND win.s = d.s),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hits) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
        FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hits) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN pos USING (r) LEFT JOIN its USING (r)
"""


@register("op3_decontaminate", OP3_SQL)
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each whole document hit by 10-word windows of the benchmark items."""
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), columns=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@register("op1_order_minhash")
def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of near copies of each whole document."""
    return near_duplicates(table(spark, sf_dir, "documents"))


@register("op8_quality")
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of each whole document by boosted trees learned outside fold 0."""
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, train(docs, table(spark, sf_dir, "labels")), columns=["doc_id"])


@register("op10_line_dedup")
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document without the lines that match an earlier line of the corpus."""
    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"), "text")


OP2_SQL = """
WITH RECURSIVE d AS (SELECT doc_id, coalesce(source, '') AS source, md5(coalesce(doc_id::VARCHAR, '')) AS m FROM documents),
sizes AS (SELECT source, floor(sqrt(count(*)) * 1000) AS root FROM d GROUP BY source),
units AS (SELECT source, greatest(1, floor(root * 1000 / (SELECT sum(root) FROM sizes)))::BIGINT AS units FROM sizes),
tot AS (SELECT sum(units)::BIGINT AS total FROM units),
base AS (SELECT list(source ORDER BY source) AS names, list(units ORDER BY source) AS u, list(0::BIGINT ORDER BY source) AS zero, sum(units)::BIGINT AS total FROM units),
edf(t, pick, done) AS (
  SELECT -1::BIGINT, 0::BIGINT, zero FROM base
  UNION ALL
  SELECT t + 1, p, list_transform(done, lambda x, i: CASE WHEN i = p THEN x + 1 ELSE x END)
  FROM (SELECT e.t, e.done, list_min(list_filter(list_transform(e.done, lambda x, i: CASE WHEN x * b.total // b.u[i] <= e.t + 1
          THEN ((x + 1) * b.total + b.u[i] - 1) // b.u[i] * 1000000 + i ELSE NULL END), lambda c: c IS NOT NULL)) % 1000000 AS p
        FROM edf e, base b WHERE e.t + 1 < b.total)
),
plan AS (SELECT b.names[pick] AS source, t AS slot, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS turn FROM edf, base b WHERE t >= 0),
k AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY m, doc_id NULLS FIRST) - 1 AS k FROM d)
SELECT k.doc_id, k.source, k.k // 16 AS block, k.k % 16 AS in_block, (k.k // 16) // u.units * (SELECT total FROM tot) + p.slot AS slot
FROM k JOIN units u USING (source) JOIN plan p ON p.source = k.source AND p.turn = (k.k // 16) % u.units
"""


@register("op2_mix_sources", OP2_SQL)
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Block and slot of every document in the mix of its sources by square-root weights."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("source", F.lit("")).alias("source"))
    return mix_sources(docs).select("doc_id", "source", "block", "in_block", "slot")


@register("op5_substring_dedup")
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of each whole document covered by a 200-byte string that also starts elsewhere."""
    return dedup_substrings(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


OP7_SQL = """
WITH v AS (SELECT vec_id, max(embedding::DOUBLE[]) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0 GROUP BY vec_id),
s AS (SELECT q.vec_id AS query_id, v.vec_id, list_reduce(list_prepend(0::DOUBLE, list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * v.e[i])), lambda a, b: a + b) AS score
      FROM v q JOIN v ON v.vec_id <> q.vec_id AND len(v.e) = len(q.e) WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
"""


@register("op7_nearest", OP7_SQL)
def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows, by inner product, of every vector whose id is divisible by 20."""
    return nearest_vectors(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


OP4_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS hex FROM p),
b AS (SELECT page_id, payload_bytes, hex, array_to_string(list_transform(range(0, 8), lambda k:
        array_to_string(list_transform(range(0, 4), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
          1 + ((('0x' || substr(hex, 1 + 5 * k::INT, 5))::BIGINT >> (15 - 5 * j)::INT) & 31)::INT, 1)), '')), '') AS payload_digest FROM d),
m AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS top FROM b)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to FROM m
"""


@register("op4_warc", OP4_SQL)
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as deduplicated archives with revisit records, read back."""
    out = archive_pages(table(spark, sf_dir, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def document_path():
    """A path for ``documents``, which have none: source / thousands of the id / lang (but for every tenth id) / id."""
    inner = F.when(F.col("doc_id") % 10 != 0, F.coalesce("lang", F.lit("_")))
    return F.concat_ws("/", F.coalesce("source", F.lit("_")), F.floor(F.col("doc_id") / 1000).cast("string"), inner, F.col("doc_id").cast("string"))


@register("op6_licenses")
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Own or inherited licence of every whole document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", document_path().alias("path"))
    return scan_licenses(docs, columns=["doc_id", "path"]).select("doc_id", "path", "license", "origin", "inherited_from", "score", "n_notices")


@register("op9_language")
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole document, learned outside fold 2 of 4."""
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train_languages(docs), columns=["doc_id"]).select("doc_id", "held_out", "lang_pred", "score")


# Usable vectors as integers, each row by itself.
_INTS = """SELECT row_number() OVER () AS r, *, list_transform(embedding::DOUBLE[], lambda x: floor(1024 * x)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0"""

OP11_SQL = f"""
WITH v AS ({_INTS}),
s AS (SELECT q.r, q.vec_id AS query_id, v.vec_id, coalesce(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * v.e[i])), 0)::BIGINT AS score
      FROM v q JOIN v ON v.r <> q.r AND len(v.e) = len(q.e) WHERE q.vec_id % 100 = 0),
o AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM o WHERE rank <= 10
"""


@register("op11_top_products", OP11_SQL)
def op11_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 largest integer inner products of every vector whose id is divisible by 100."""
    return top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP12_SQL = r"""
WITH bits AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b::BIGINT, range(8)),
         lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (SELECT doc_id, run, count(*) AS k FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents) GROUP BY ALL),
hexed AS (SELECT run, k, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs),
hashed AS (SELECT run, k, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, len(x) // 2), lambda i: ('0x' || substr(x, 1 + 2 * i::INT, 2))::BIGINT)),
         lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) AS h FROM hexed, bits),
cut AS (SELECT k, CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM hashed),
words AS (SELECT word, sum(k)::BIGINT AS n FROM cut WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
gaps AS (SELECT word, n, i, length(word) AS size, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS z FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (SELECT DISTINCT g.word, o.word AS other, o.n FROM gaps g JOIN gaps o ON o.size = g.size AND o.i = g.i AND o.a = g.a AND o.z = g.z AND o.word <> g.word
         UNION SELECT DISTINCT g.word, o.word, o.n FROM gaps g JOIN words o ON o.word = g.a || g.z
         UNION SELECT DISTINCT o.word, g.word, g.n FROM gaps g JOIN words o ON o.word = g.a || g.z),
best AS (SELECT word, count(*) AS n_near, max(n) AS top, arg_min(other, struct_pack(m := -n, w := other)) AS other FROM near GROUP BY word),
tree AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.top >= 2 * w.n THEN b.other END AS form, CASE WHEN b.top >= 2 * w.n THEN b.top END AS form_n
         FROM words w LEFT JOIN best b USING (word)),
walk AS (WITH RECURSIVE up(word, seen, step) AS (SELECT word, form, 1 FROM tree WHERE form IS NOT NULL
         UNION ALL SELECT up.word, tree.form, step + 1 FROM up JOIN tree ON tree.word = up.seen WHERE tree.form IS NOT NULL) SELECT word, arg_max(seen, step) AS root FROM up GROUP BY word)
SELECT word, form, coalesce(root, word) AS root, n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n FROM tree LEFT JOIN walk USING (word)
"""


@register("op12_spelling", OP12_SQL)
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the whole documents with its near words, its form and the root of that."""
    return spelling_variants(table(spark, sf_dir, "documents"))


def _op13_sql(rounds: int = 4) -> str:
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""a{k} AS (SELECT r, p, min(dist * 256 + k) AS best FROM (
  SELECT x.r, x.p, c.k, coalesce(list_sum(list_transform(range(1, len(x.x) + 1), lambda j: (x.x[j] - c.x[j]) * (x.x[j] - c.x[j]))), 0)::BIGINT AS dist
  FROM parts x JOIN c{k} c ON c.p = x.p) GROUP BY r, p)""")
        if k < rounds:
            steps.append(f"""m{k} AS (SELECT p, k, list(v ORDER BY j) AS x FROM (SELECT p, k, j, floor(sum(v)::DOUBLE / count(*))::BIGINT AS v FROM (
  SELECT x.p, a.best % 256 AS k, unnest(x.x) AS v, unnest(range(1, len(x.x) + 1)) AS j FROM parts x JOIN a{k} a ON a.r = x.r AND a.p = x.p) GROUP BY p, k, j) GROUP BY p, k),
c{k + 1} AS (SELECT c.p, c.k, coalesce(m.x, c.x) AS x FROM c{k} c LEFT JOIN m{k} m ON m.p = c.p AND m.k = c.k)""")
    return f"""
WITH v AS MATERIALIZED ({_INTS}),
parts AS MATERIALIZED (SELECT r, p, e[p * (len(e) // 4) + 1:(p + 1) * (len(e) // 4)] AS x FROM v, (SELECT unnest(range(4)) AS p)),
first AS (SELECT r, k FROM (SELECT r, row_number() OVER (ORDER BY vec_id NULLS LAST, e) - 1 AS k FROM v) WHERE k < 256),
c0 AS (SELECT p, k, x FROM parts JOIN first USING (r)),
{", ".join(s.replace(" AS (SELECT", " AS MATERIALIZED (SELECT", 1) for s in steps)},
coded AS (SELECT r, string_agg(format('{{:02x}}', best % 256), '' ORDER BY p) AS code, sum(best // 256)::BIGINT AS error FROM a{rounds} GROUP BY r),
book AS (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY p, k, j)) AS codebooks_sha256 FROM (SELECT p, k, unnest(x) AS v, unnest(range(1, len(x) + 1)) AS j FROM c{rounds}))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded JOIN v USING (r), book
"""


OP13_SQL = _op13_sql()


@register("op13_vector_codes", OP13_SQL)
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of every vector, their errors, the label's sum of errors and the codebooks' digest."""
    return vector_codes(table(spark, sf_dir, "embeddings"))
