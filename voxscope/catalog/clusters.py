"""k-means and principal axes over TF-IDF rows and embeddings, each against the same steps unrolled in DuckDB."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates, clusters
from ..plans import topics
from .base import Registry
from .scalar import FILTERED_SQL, STOPS

registry = Registry()
add = registry.add

K, ROUNDS, SEEDS, AXIS_ROUNDS = 4, 8, 2, 12


def _weights_sql(size: int, min_df: int) -> str:
    """docs(doc), x(doc, term, w) and d(doc, norm)."""
    return f"""t AS MATERIALIZED (SELECT doc_id, unnest({FILTERED_SQL.format('text')}) AS term FROM documents),
 docs AS MATERIALIZED (SELECT DISTINCT doc_id AS doc FROM t), vocab AS (SELECT term, count(*) AS n FROM t GROUP BY term
  HAVING count(DISTINCT doc_id) >= {min_df} ORDER BY n DESC, term LIMIT {size}),
 cnt AS MATERIALIZED (SELECT doc_id AS doc, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM vocab) GROUP BY ALL),
 idf AS (SELECT term, ln(((SELECT count(*) FROM docs) + 1) / (count(*) + 1e0)) AS idf FROM cnt GROUP BY term),
 x AS MATERIALIZED (SELECT doc, term, tf * idf AS w FROM cnt JOIN idf USING (term)),
 d AS MATERIALIZED (SELECT doc, coalesce(norm, 0e0) AS norm FROM docs LEFT JOIN (SELECT doc, sum(w * w) AS norm FROM x GROUP BY doc) USING (doc))"""


def _uniform(salt: str, x: str) -> str:
    return f"(CAST(('0x' || substr(md5('{salt}' || CAST({x} AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296e0)"


def _nearest(name: str, centres: str, norms: str) -> str:
    """name(doc, c, d2) for centres(c, term, w) and norms(c, n)."""
    return f"""{name} AS MATERIALIZED (SELECT doc, c, d2 FROM (SELECT d.doc, n.c,
  greatest(round(d.norm + n.n - 2 * coalesce(p.p, 0), 9), 0) AS d2 FROM d CROSS JOIN {norms} n
  LEFT JOIN (SELECT x.doc, m.c, sum(x.w * m.w) AS p FROM x JOIN {centres} m USING (term) GROUP BY ALL) p ON p.doc = d.doc AND p.c = n.c) AS g
  QUALIFY row_number() OVER (PARTITION BY doc ORDER BY d2, c) = 1)"""


def _of_documents(name: str, picked: str) -> list[str]:
    """Centres and norms of picked(c, doc)."""
    return [f"{name} AS MATERIALIZED (SELECT p.c, x.term, x.w FROM {picked} p JOIN x USING (doc))",
            f"{name}_n AS MATERIALIZED (SELECT p.c, d.norm AS n FROM {picked} p JOIN d USING (doc))"]


def kmeans_sql(last: str, size: int = 1000, min_df: int = 5) -> str:
    parts = [_weights_sql(size, min_df), "s0 AS MATERIALIZED (SELECT 0 AS c, doc FROM docs ORDER BY md5(CAST(doc AS VARCHAR)), doc LIMIT 1)"]
    for r in range(SEEDS):
        parts += _of_documents(f"sc{r}", f"s{r}")
        parts += [_nearest(f"sn{r}", f"sc{r}", f"sc{r}_n"), f"""s{r + 1} AS MATERIALIZED (SELECT c, doc FROM s{r} UNION ALL
  SELECT CAST((SELECT count(*) FROM s{r}) + row_number() OVER (ORDER BY doc) - 1 AS INT), doc FROM sn{r}
  WHERE {_uniform(f'seed{r}', 'doc')} < {2 * K} * d2 / (SELECT sum(d2) FROM sn{r}) AND doc NOT IN (SELECT doc FROM s{r}))"""]
    parts += _of_documents("sc", f"s{SEEDS}")
    parts += [_nearest("sn", "sc", "sc_n"), "wt AS MATERIALIZED (SELECT n.c, n.n AS norm, (SELECT count(*) FROM sn WHERE sn.c = n.c) AS wt FROM sc_n n)",
              """gap AS MATERIALIZED (SELECT a.c AS a, b.c AS b, greatest(round(a.norm + b.norm - 2 * coalesce(p.p, 0), 9), 0) AS g FROM wt a CROSS JOIN wt b
  LEFT JOIN (SELECT l.c AS a, r.c AS b, sum(l.w * r.w) AS p FROM sc l JOIN sc r USING (term) GROUP BY ALL) p ON p.a = a.c AND p.b = b.c)""",
              "k1 AS MATERIALIZED (SELECT 0 AS c, c AS s FROM wt ORDER BY wt DESC, s LIMIT 1)"]
    for j in range(1, K):
        parts.append(f"""k{j + 1} AS MATERIALIZED (SELECT c, s FROM k{j} UNION ALL (SELECT {j}, w.c FROM wt w
  JOIN (SELECT a, min(g) AS g FROM gap WHERE b IN (SELECT s FROM k{j}) GROUP BY a) m ON m.a = w.c WHERE w.c NOT IN (SELECT s FROM k{j})
  ORDER BY round(w.wt * m.g, 6) DESC, w.c LIMIT 1))""")
    parts.append(f"k AS MATERIALIZED (SELECT k.c, s.doc FROM k{K} k JOIN s{SEEDS} s ON s.c = k.s)")
    parts += _of_documents("c0", "k")
    for i in range(ROUNDS + 1):
        parts.append(_nearest(f"a{i}", f"c{i}", f"c{i}_n"))
        parts += [f"""c{i + 1} AS MATERIALIZED (SELECT a.c, x.term, sum(x.w) / any_value(z.n) AS w FROM a{i} a JOIN x USING (doc)
  JOIN (SELECT c, count(*) AS n FROM a{i} GROUP BY c) z ON z.c = a.c GROUP BY a.c, x.term
  UNION ALL SELECT * FROM c{i} WHERE c NOT IN (SELECT c FROM a{i}))""",
                  f"c{i + 1}_n AS MATERIALIZED (SELECT o.c, coalesce(sum(m.w * m.w), 0) AS n FROM c{i}_n o LEFT JOIN c{i + 1} m USING (c) GROUP BY o.c)"]
    return f"WITH {', '.join(parts)} {last.format(a=f'a{ROUNDS}', c=f'c{ROUNDS}')}"


def _rows(t, size: int = 1000, min_df: int = 5):
    return topics.weighted_terms(t.spread_documents, "doc_id", "text", size, min_df, STOPS)


def _fitted(t):
    return clusters.sparse_kmeans(_rows(t), K, ROUNDS, SEEDS)


@add("topic_clusters", kmeans_sql("SELECT doc AS doc_id, CAST(c AS INT) AS cluster_id FROM {a}"))
def _(t):
    return _fitted(t)[0].withColumnRenamed("doc", "doc_id")


@add("top_terms_per_cluster", kmeans_sql("""SELECT CAST(c AS INT) AS cluster_id, CAST(row_number() OVER (PARTITION BY c ORDER BY round(w, 9) DESC, term) AS INT)
 AS position, term, round(w, 6) AS weight FROM {c} QUALIFY position <= 10"""))
def _(t):
    found = clusters.heaviest_terms(_fitted(t)[1])
    return found.select("cluster_id", "position", "term", F.round("weight", 6).alias("weight"))


@add("kmeans_share", kmeans_sql("""SELECT CAST(c AS INT) AS cluster_id, count(*) AS count,
 round(count(*) * 100e0 / (SELECT count(*) FROM {a}), 1) AS percent FROM {a} GROUP BY c"""))
def _(t):
    return aggregates.cluster_share(_fitted(t)[0])


def axes_sql(last: str, size: int = 2000, min_df: int = 2) -> str:
    parts = [_weights_sql(size, min_df), f"""v0 AS MATERIALIZED (SELECT term, sum(w) AS s, 2 * {_uniform('a', 'term')} - 1 AS a,
  2 * {_uniform('b', 'term')} - 1 AS b FROM x GROUP BY term)"""]
    for i in range(AXIS_ROUNDS + 1):
        parts += [f"g{i} AS MATERIALIZED (SELECT sum(a * a) AS aa, sum(a * b) AS ab, sum(b * b) AS bb FROM v{i})",
                  f"u{i} AS MATERIALIZED (SELECT term, s, a / sqrt(aa) AS a, (b - a * (ab / aa)) / sqrt(bb - ab * ab / aa) AS b FROM v{i}, g{i})"]
        if i < AXIS_ROUNDS:
            parts += [f"p{i} AS MATERIALIZED (SELECT x.doc, sum(x.w * u.a) AS pa, sum(x.w * u.b) AS pb FROM x JOIN u{i} u USING (term) GROUP BY x.doc)",
                      f"m{i} AS MATERIALIZED (SELECT sum(s * a) / (SELECT count(*) FROM docs) AS ma, sum(s * b) / (SELECT count(*) FROM docs) AS mb FROM u{i})",
                      f"""v{i + 1} AS MATERIALIZED (SELECT term, any_value(u.s) AS s, sum(x.w * p.pa) - any_value(u.s) * any_value(ma) AS a,
  sum(x.w * p.pb) - any_value(u.s) * any_value(mb) AS b FROM x JOIN p{i} p USING (doc) JOIN u{i} u USING (term), m{i} GROUP BY term)"""]
    parts.append(f"""ax AS MATERIALIZED (SELECT term, a * (SELECT CASE WHEN a < 0 THEN -1 ELSE 1 END FROM u{AXIS_ROUNDS} ORDER BY round(abs(a), 9) DESC, hex(term) DESC LIMIT 1) AS a,
  b * (SELECT CASE WHEN b < 0 THEN -1 ELSE 1 END FROM u{AXIS_ROUNDS} ORDER BY round(abs(b), 9) DESC, hex(term) DESC LIMIT 1) AS b FROM u{AXIS_ROUNDS})""")
    return f"WITH {', '.join(parts)} {last}"


@add("topic_axes", axes_sql("""SELECT d.doc AS doc_id, round(coalesce(sum(x.w * a), 0), 6) AS x, round(coalesce(sum(x.w * b), 0), 6) AS y
 FROM d LEFT JOIN x USING (doc) LEFT JOIN ax USING (term) GROUP BY d.doc"""))
def _(t):
    rows = _rows(t, 2000, 2)
    points = clusters.project(rows, clusters.principal_axes(rows, AXIS_ROUNDS))
    return points.select(F.col("doc").alias("doc_id"), F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


def _squared(name: str, matrix: str, times: int) -> list[str]:
    """name(i, v): the leading eigenvector of matrix(i, j, v) by squaring it again and again; its largest entry is positive."""
    parts = [f"{name}0 AS MATERIALIZED (SELECT i, j, v / (SELECT sum(v) FROM {matrix} WHERE i = j) AS v FROM {matrix})"]
    for k in range(times):
        parts += [f"{name}r{k} AS MATERIALIZED (SELECT a.i, b.j, sum(a.v * b.v) AS v FROM {name}{k} a JOIN {name}{k} b ON a.j = b.i GROUP BY ALL)",
                  f"{name}{k + 1} AS MATERIALIZED (SELECT i, j, v / (SELECT sum(v) FROM {name}r{k} WHERE i = j) AS v FROM {name}r{k})"]
    top = f"(SELECT i FROM {name}{times} WHERE i = j ORDER BY v DESC LIMIT 1)"  # its own entry is the largest, and positive
    return [*parts, f"{name} AS MATERIALIZED (SELECT i, v / sqrt(sum(v * v) OVER ()) AS v FROM {name}{times} WHERE j = {top})"]


_PCA = ", ".join([
    "e AS MATERIALIZED (SELECT vec_id, unnest(CAST(embedding AS DOUBLE[])) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)",
    "o AS MATERIALIZED (SELECT vec_id, i, x - avg(x) OVER (PARTITION BY i) AS x FROM e)",
    "cov AS MATERIALIZED (SELECT a.i, b.i AS j, avg(a.x * b.x) AS v FROM o a JOIN o b USING (vec_id) GROUP BY ALL)",
    *_squared("first_axis", "cov", 14),
    "lam AS (SELECT sum(p.v * cov.v * q.v) AS l FROM cov JOIN first_axis p USING (i) JOIN first_axis q ON q.i = cov.j)",
    """rest AS MATERIALIZED (SELECT cov.i, cov.j, cov.v - (SELECT l FROM lam) * p.v * q.v AS v FROM cov
  JOIN first_axis p USING (i) JOIN first_axis q ON q.i = cov.j)""",
    *_squared("second_axis", "rest", 14)])


@add("pca_points", f"""WITH {_PCA} SELECT vec_id, round(sum(e.x * p.v), 5) AS x, round(sum(e.x * q.v), 5) AS y
 FROM e JOIN first_axis p USING (i) JOIN second_axis q USING (i) GROUP BY vec_id""")
def _(t):
    points = clusters.principal_points(t.embeddings, "embedding")
    return points.select("vec_id", F.round("x", 5).alias("x"), F.round("y", 5).alias("y"))


