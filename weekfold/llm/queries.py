"""One query for each numbered operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekfold.llm import (
    bpe, exact_dedup, fingerprints, html_text, minhash, mixing, quality, secret_scan, spelling, token_counts, topk,
    toxicity, zone_clusters,
)
from weekfold.llm.tables import table

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def _spans_sql(kind: int, name: str, pattern: str, kept: str) -> str:
    """Matches of one kind with their code-point offsets, from the pieces between them."""
    return f"""
    SELECT doc_id, row_, {kind} AS kind, '{name}' AS name, s AS start_, s + length(m) AS end_
    FROM (
      SELECT doc_id, row_, m, g,
        list_sum(list_transform(pieces[1:i], lambda x: length(x)))
          + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS s
      FROM (
        SELECT doc_id, row_, ms, pieces, unnest(ms) AS m, unnest(gs) AS g,
          unnest(range(1, len(ms) + 1)) AS i
        FROM (
          SELECT doc_id, row_, regexp_extract_all(t, '{pattern}', 0) AS ms,
            regexp_extract_all(t, '{pattern}', {2 if name == 'assign' else 0}) AS gs,
            string_split_regex(t, '{pattern}') AS pieces
          FROM texts
        )
      )
    ) WHERE {kept}"""


_ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    "|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    "[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
)
SECRETS_SQL = f"""
WITH texts AS (SELECT doc_id, row_number() OVER () AS row_, coalesce(text, '') AS t FROM documents),
found AS ({' UNION ALL '.join([
    _spans_sql(0, 'assign', _ASSIGN, 'length(g) >= 8'),
    _spans_sql(1, 'access', 'AKIA[A-Z0-9]+', 'length(m) >= 16'),
    _spans_sql(2, 'hex', '[0-9a-f]{32,}', 'true'),
    _spans_sql(3, 'pem', '-----BEGIN [A-Z ]*PRIVATE KEY-----', 'true'),
    _spans_sql(4, 'github', 'gh[oprsu]_[A-Za-z0-9]+', 'length(m) >= 40'),
    _spans_sql(5, 'slack', 'xox[abprs]-[A-Za-z0-9-]+', 'length(m) >= 15'),
    _spans_sql(6, 'jwt', r'eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+', 'true'),
])}),
grouped AS (
  SELECT row_, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
    count(*) FILTER (kind = 2) AS n_hex,
    string_agg(name || ':' || start_::BIGINT || ':' || end_::BIGINT, ',' ORDER BY start_, kind) FILTER (kind < 3) AS base,
    string_agg(name || ':' || start_::BIGINT || ':' || end_::BIGINT, ',' ORDER BY start_, kind) AS spans
  FROM found GROUP BY row_
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN grouped USING (row_)
"""


@query("op1_secret_scan", SECRETS_SQL)
def secrets(spark: SparkSession, root: str) -> DataFrame:
    return secret_scan.secret_report(table(spark, root, "documents"))


DUPLICATES_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""


@query("op2_exact_dedup", DUPLICATES_SQL)
def duplicates(spark: SparkSession, root: str) -> DataFrame:
    return exact_dedup.duplicate_report(table(spark, root, "documents"))


@query("op3_token_counts")
def tokens(spark: SparkSession, root: str) -> DataFrame:
    return token_counts.token_counts(
        table(spark, root, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
    )


@query("op4_bpe_round_trip")
def round_trip(spark: SparkSession, root: str) -> DataFrame:
    return bpe.round_trip(
        table(spark, root, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


@query("op5_toxicity")
def toxic(spark: SparkSession, root: str) -> DataFrame:
    return toxicity.toxicity(table(spark, root, "documents"), table(spark, root, "labels"))


@query("op6_quality")
def graded(spark: SparkSession, root: str) -> DataFrame:
    return quality.quality(table(spark, root, "documents"))


@query("op7_main_text")
def extracted(spark: SparkSession, root: str) -> DataFrame:
    return html_text.main_text(table(spark, root, "pages"))


@query("op8_minhash")
def near(spark: SparkSession, root: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, root, "documents"), words=2)


MIXTURE_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, text, '')), 1, 13))::BIGINT::DOUBLE + 0.5)
      / 4503599627370496.0 AS u
  FROM documents
),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth
  FROM sized GROUP BY source
),
weighed AS (
  SELECT *, [5.0, 2.0, 1.0][nth % 3 + 1]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS cap FROM sources
),
leveled AS (
  SELECT *, cap / weight AS fill,
    (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER before, 0))
      / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighed WINDOW before AS (ORDER BY cap / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
water AS (SELECT arg_min(level, (fill, nth)) AS water FROM leveled WHERE fill > level),
goal AS (
  SELECT source, source_size, coalesce(least(cap, weight * water), cap) AS target FROM leveled, water
),
planned AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole,
    target - whole * source_size AS missing, missing / source_size AS share
  FROM goal
),
tilted AS (
  SELECT *, floor(1000 * size / (size + 256)) AS weight,
    sum(floor(1000 * size / (size + 256)) * size) OVER (PARTITION BY source) / sum(size) OVER (PARTITION BY source) AS mean_weight
  FROM sized
),
chances AS (
  SELECT s.doc_id, s.source, s.size, u, p.source_size, p.target, p.whole, p.missing,
    least(greatest(coalesce(share + least(share, 1 - share) * (s.weight - s.mean_weight) / 1000, 0), 1e-12), 1 - 1e-12) AS p
  FROM tilted s JOIN planned p ON s.source IS NOT DISTINCT FROM p.source
),
ranked AS (SELECT *, u / (1 - u) / (p / (1 - p)) AS q FROM chances),
summed AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY q, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto FROM ranked
)
SELECT doc_id, source, size, source_size, target,
  (size * (whole + (missing > 0 AND upto - size / 2.0 <= missing)::BIGINT))::BIGINT AS taken
FROM summed
"""


@query("op9_mixture", MIXTURE_SQL)
def mixture(spark: SparkSession, root: str) -> DataFrame:
    return mixing.mixture(table(spark, root, "documents"))


TOP_K_SQL = """
WITH whole AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query("op10_top_k", TOP_K_SQL)
def nearest(spark: SparkSession, root: str) -> DataFrame:
    return topk.top_k(table(spark, root, "embeddings"), F.col("vec_id") % 50 == 0, 5)


VARIANTS_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)
),
runs AS (
  SELECT run, doc, count(*) AS c, encode(doc || ':' || run) AS bytes FROM (
    SELECT coalesce(doc_id::VARCHAR, '') AS doc, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]{7,}')) AS run
    FROM documents WHERE text IS NOT NULL
  ) GROUP BY run, doc
),
hashed AS (
  SELECT run, c, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(octet_length(bytes)), lambda j: ('0x' || substr(hex(bytes), 2 * j + 1, 2))::BIGINT)),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) AS h
  FROM runs, crc_table
),
words AS MATERIALIZED (
  SELECT word, sum(c)::BIGINT AS n FROM (
    SELECT c, CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
    FROM hashed
  ) WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2
),
shorter AS MATERIALIZED (
  SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT *, unnest(range(length(word))) AS i FROM words)
),
lost AS (SELECT DISTINCT s.word AS a, w.word AS b FROM shorter s JOIN words w ON w.word = s.rest),
near AS (
  SELECT a, b FROM lost UNION ALL SELECT b, a FROM lost
  UNION ALL SELECT x.word, y.word FROM shorter x JOIN shorter y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word
),
best AS (
  SELECT a AS word, count(*) AS n_near, arg_min(b, (-w.n, b)) AS form, max(w.n) AS form_n
  FROM near JOIN words w ON w.word = b GROUP BY a
),
variants AS MATERIALIZED (
  SELECT w.word, CASE WHEN form_n >= 10 * w.n THEN form END AS form, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN form_n >= 10 * w.n THEN form_n END AS form_n
  FROM words w LEFT JOIN best USING (word)
),
chain AS (
  SELECT word, word AS root FROM variants
  UNION ALL SELECT c.word, v.form FROM chain c JOIN variants v ON v.word = c.root WHERE v.form IS NOT NULL
),
ends AS (SELECT c.word, c.root FROM chain c JOIN variants v ON v.word = c.root WHERE v.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM variants JOIN ends USING (word)
"""


@query("op11_spelling_variants", VARIANTS_SQL)
def variants(spark: SparkSession, root: str) -> DataFrame:
    words = spelling.vocabulary(table(spark, root, "documents"), drop_every=spelling.DROP_EVERY)
    return spelling.spelling_variants(words)


@query("op12_fingerprints")
def printed(spark: SparkSession, root: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, root, "documents"))


def _clusters_sql(rounds: int) -> str:
    """Assignment and mean, once for each round, then the last assignment."""
    def assigned(n: int) -> str:
        return f"""
assigned{n} AS MATERIALIZED (
  SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT k.r, m.c, list_sum(list_transform(range(1, 65), lambda i: (k.v[i] - m.v[i]) * (k.v[i] - m.v[i])))::BIGINT AS d
    FROM kept k, centroids{n} m
  ) GROUP BY r
)"""

    def moved(n: int) -> str:
        return f"""
centroids{n + 1} AS MATERIALIZED (
  SELECT m.c, coalesce(f.v, m.v) AS v FROM centroids{n} m LEFT JOIN (
    SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM (
      SELECT c, i, sum(v[i]) AS s, count(*) AS n
      FROM assigned{n} JOIN kept USING (r), (SELECT unnest(range(1, 65)) AS i) GROUP BY c, i
    ) GROUP BY c
  ) f USING (c)
)"""

    steps = ",".join(assigned(n) + "," + moved(n) for n in range(rounds))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
centroids0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR) NULLS LAST, v) - 1)::INTEGER AS c, v FROM kept QUALIFY c < 16
),{steps},{assigned(rounds)}
SELECT vec_id, c AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM assigned{rounds} JOIN kept USING (r) JOIN centroids{rounds} m USING (c)
"""


@query("op13_centroid_clusters", _clusters_sql(zone_clusters.ROUNDS))
def clustered(spark: SparkSession, root: str) -> DataFrame:
    return zone_clusters.clusters(table(spark, root, "embeddings"))
