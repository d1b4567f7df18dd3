"""Joins, upserts and the reply graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import node_display_size
from ..operators import filters, graph, joins, merge, topk
from ..plans import opinion
from ..session import stage
from .base import Registry, with_comments
from .ranking import EDGES_SQL

registry = Registry()
add = registry.add

# --- joins -----------------------------------------------------------------------------------

_RANKS_SQL = "SELECT concat('user_', CAST(c_custkey AS VARCHAR)) AS user, c_acctbal / 10000 AS pagerank FROM customer"


def _ranks(t):
    return t.customer.select(F.concat(F.lit("user_"), F.col("c_custkey").cast("string")).alias("user"),
                             (F.col("c_acctbal") / 10000).alias("pagerank"))


_ACTIVE_SQL = f"{_RANKS_SQL} WHERE c_custkey IN (SELECT user_id FROM events)"


def _active(t):
    """Scores of the customers who write."""
    writers = t.events.select(F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user"))
    return _ranks(t).join(writers, "user", "left_semi")


def _edges(t):
    return graph.edge_weights(graph.build_reply_edges(t.comments))


@add("edges_touching_top_nodes", with_comments(f""", e AS ({EDGES_SQL}), best AS ({_ACTIVE_SQL}
 ORDER BY pagerank DESC, user LIMIT 50) SELECT src, dst, weight FROM e
 WHERE src IN (SELECT user FROM best) OR dst IN (SELECT user FROM best)
 ORDER BY weight DESC, src, dst LIMIT 100"""))
def _(t):
    return joins.edges_touching_top_nodes(_edges(t), _active(t))


@add("display_network", with_comments(f""", e AS ({EDGES_SQL}), best AS ({_ACTIVE_SQL}
 ORDER BY pagerank DESC, user LIMIT 50) SELECT src, dst, weight FROM e
 WHERE (src IN (SELECT user FROM best) OR dst IN (SELECT user FROM best))
 AND regexp_matches(dst, '[一-龥a-zA-Z0-9]') ORDER BY weight DESC, src, dst LIMIT 100"""))
def _(t):
    return opinion.display_network(_active(t), _edges(t))


@add("node_score_lookup", f"""SELECT u.user, round(coalesce(r.pagerank, 0.001), 6) AS pagerank,
 round(coalesce(r.pagerank, 0.001) * 80000, 2) AS size
 FROM (SELECT DISTINCT concat('user_', CAST(user_id AS VARCHAR)) AS user FROM events) AS u
 LEFT JOIN ({_RANKS_SQL} WHERE c_acctbal > 5000) AS r USING (user)""")
def _(t):
    nodes = t.events.select(F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user")).distinct()
    scores = joins.node_scores(nodes, _ranks(t).filter("pagerank * 10000 > 5000"))
    return scores.select("user", F.round("pagerank", 6).alias("pagerank"),
                         F.round(node_display_size(F.col("pagerank")), 2).alias("size"))


@add("inherit_parent", with_comments("""SELECT c.comment_id, coalesce(p.note_id, c.note_id) AS note_id,
 coalesce(p.source_keyword, c.source_keyword) AS source_keyword
 FROM comments c LEFT JOIN comments p ON p.comment_id = c.parent_comment_id
 AND c.parent_comment_id <> 0"""))
def _(t):
    rows = t.comments.select("comment_id", "parent_comment_id", "note_id", "source_keyword")
    return joins.inherit_parent(rows, ["note_id", "source_keyword"]).select("comment_id", "note_id", "source_keyword")


@add("comment_to_post", with_comments("""SELECT comment_id, quality, toxic FROM comments
 JOIN labels ON labels.doc_id = comments.note_id"""))
def _(t):
    posts = t.labels.withColumnRenamed("doc_id", "note_id")
    return joins.comment_to_post(t.comments, posts).select("comment_id", "quality", "toxic")


@add("orphan_comments", with_comments("""SELECT comment_id FROM comments
 WHERE note_id NOT IN (SELECT doc_id FROM labels)"""))
def _(t):
    posts = t.labels.withColumnRenamed("doc_id", "note_id")
    return joins.comment_to_post(t.comments, posts, "left_anti").select("comment_id")


@add("lookup_join", """SELECT n_nationkey, n_name, r_name FROM nation LEFT JOIN region ON r_regionkey = n_regionkey""")
def _(t):
    names = t.region.withColumnRenamed("r_regionkey", "n_regionkey")
    return joins.label_lookup(t.nation, names, "n_regionkey").select("n_nationkey", "n_name", "r_name")


# --- upserts: stored rows come from the first half of the month, the batch from the second -----

_VERSIONS = """, v AS (SELECT user_id, event_type, lang, nickname AS author, ip_location AS place, like_count,
 sub_comment_count, comment_id AS seq, create_time < TIMESTAMP '2024-01-16 00:00:00' AS early FROM comments),
 old AS (SELECT * EXCLUDE early FROM v WHERE early QUALIFY row_number() OVER
  (PARTITION BY user_id, event_type, lang ORDER BY seq) = 1),
 new AS (SELECT * EXCLUDE early FROM v WHERE NOT early),
 f AS (SELECT * FROM new QUALIFY row_number() OVER (PARTITION BY user_id, event_type, lang ORDER BY seq) = 1),
 l AS (SELECT * FROM new QUALIFY row_number() OVER (PARTITION BY user_id, event_type, lang ORDER BY seq DESC) = 1)"""
KEYS = ["user_id", "event_type", "lang"]


def _versions(t):
    v = t.comments.select("user_id", "event_type", "lang", F.col("nickname").alias("author"),
                          F.col("ip_location").alias("place"), "like_count", "sub_comment_count",
                          F.col("comment_id").alias("seq"),
                          (F.col("create_time") < F.expr("TIMESTAMP_NTZ '2024-01-16 00:00:00'")).alias("early"))
    old = topk.cap_per_group(v.filter("early"), KEYS, ["seq"], 1).drop("early")
    return old, v.filter("NOT early").drop("early")


@add("upsert_partial", with_comments(f"""{_VERSIONS} SELECT user_id, event_type, lang,
 CASE WHEN o.seq IS NOT NULL THEN o.author ELSE f.author END AS author,
 CASE WHEN o.seq IS NOT NULL THEN o.place ELSE f.place END AS place,
 CASE WHEN l.seq IS NOT NULL THEN l.like_count ELSE o.like_count END AS like_count,
 CASE WHEN l.seq IS NOT NULL THEN l.sub_comment_count ELSE o.sub_comment_count END AS sub_comment_count,
 CASE WHEN l.seq IS NOT NULL THEN l.seq ELSE o.seq END AS seq
 FROM old o FULL JOIN f USING (user_id, event_type, lang) FULL JOIN l USING (user_id, event_type, lang)"""))
def _(t):
    return merge.upsert_partial(*_versions(t), KEYS, ["like_count", "sub_comment_count", "seq"], ["seq"])


@add("upsert_all", with_comments(f"""{_VERSIONS} SELECT * FROM (SELECT *, 0 AS b FROM old UNION ALL
 SELECT *, 1 FROM new) AS u QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY b DESC, seq DESC) = 1""")
     .replace("SELECT * FROM (SELECT *, 0 AS b", "SELECT * EXCLUDE b FROM (SELECT *, 0 AS b"))
def _(t):
    return merge.upsert_all(*_versions(t), ["user_id"], ["seq"])


@add("upsert_composite_key", with_comments(f"""{_VERSIONS} SELECT * EXCLUDE b FROM (SELECT *, 0 AS b FROM old
 UNION ALL SELECT *, 1 FROM new) AS u QUALIFY row_number() OVER
 (PARTITION BY user_id, event_type, lang ORDER BY b DESC, seq DESC) = 1"""))
def _(t):
    return merge.upsert_all(*_versions(t), KEYS, ["seq"])


@add("upsert_known_columns", with_comments(f"""{_VERSIONS} SELECT user_id, event_type, lang, o.author, o.place,
 CASE WHEN l.seq IS NOT NULL THEN l.like_count ELSE o.like_count END AS like_count,
 CASE WHEN l.seq IS NOT NULL THEN l.seq ELSE o.seq END AS seq
 FROM old o FULL JOIN l USING (user_id, event_type, lang)"""))
def _(t):
    old, new = _versions(t)
    new = new.select(*KEYS, "like_count", "sub_comment_count", "seq", F.lit("x").alias("unknown"))
    return merge.upsert_known_columns(old.drop("sub_comment_count"), new, KEYS, ["seq"])


_PRESENT = {0: ["like_count"], 1: ["place", "seq"], 2: ["place", "like_count", "sub_comment_count", "seq"]}
_FIELDS = ["author", "place", "like_count", "sub_comment_count", "seq"]


@add("set_merge", with_comments(_VERSIONS + ", p AS (SELECT *, CASE seq % 3 " + " ".join(
    f"WHEN {k} THEN {v!r}" for k, v in _PRESENT.items()) + " END AS present FROM new), b AS (SELECT "
    + ", ".join(KEYS) + ", " + ", ".join(
        f"arg_max({{'v': {c}}}, seq) FILTER (WHERE list_contains(present, '{c}')) AS n_{c}" for c in _FIELDS)
    + " FROM p GROUP BY ALL) SELECT " + ", ".join(KEYS) + ", " + ", ".join(
        f"CASE WHEN b.n_{c} IS NOT NULL THEN b.n_{c}.v ELSE o.{c} END AS {c}" for c in _FIELDS)
    + " FROM old o FULL JOIN b USING (" + ", ".join(KEYS) + ")"))
def _(t):
    old, new = _versions(t)
    lists = [F.when(F.col("seq") % 3 == k, F.array(*[F.lit(c) for c in v])) for k, v in _PRESENT.items()]
    return merge.set_merge(old, new.withColumn("present", F.coalesce(*lists)), KEYS, "present", ["seq"])


@add("insert_guarded", with_comments(_VERSIONS + """, b AS (SELECT user_id, event_type, lang,
 bool_or(coalesce(place <> '', false)) AS ok FROM new GROUP BY ALL)
 SELECT user_id, event_type, lang, CASE WHEN l.seq IS NOT NULL THEN l.author ELSE o.author END AS author,
 CASE WHEN l.seq IS NOT NULL THEN l.place ELSE o.place END AS place,
 CASE WHEN l.seq IS NOT NULL THEN l.like_count ELSE o.like_count END AS like_count,
 CASE WHEN l.seq IS NOT NULL THEN l.sub_comment_count ELSE o.sub_comment_count END AS sub_comment_count,
 CASE WHEN l.seq IS NOT NULL THEN l.seq ELSE o.seq END AS seq
 FROM old o FULL JOIN l USING (user_id, event_type, lang) LEFT JOIN b USING (user_id, event_type, lang)
 WHERE o.seq IS NOT NULL OR b.ok"""))
def _(t):
    return merge.insert_guarded(*_versions(t), KEYS, ["seq"], "place")


# --- graph -----------------------------------------------------------------------------------


@add("build_reply_edges", with_comments(EDGES_SQL))
def _(t):
    return _edges(t)


@add("drop_null_edges", """SELECT src, dst FROM (SELECT CASE WHEN event_id % 4 = 0 THEN NULL ELSE user_id END AS src,
 CASE WHEN event_id % 6 = 0 THEN NULL ELSE event_type END AS dst FROM events) AS e
 WHERE src IS NOT NULL AND dst IS NOT NULL""")
def _(t):
    return filters.drop_null_edges(t.events.selectExpr(
        "CASE WHEN event_id % 4 = 0 THEN NULL ELSE user_id END AS src",
        "CASE WHEN event_id % 6 = 0 THEN NULL ELSE event_type END AS dst"))


@add("top_edges", with_comments(f"{EDGES_SQL} ORDER BY weight DESC, src, dst LIMIT 500"))
def _(t):
    return topk.top_edges(_edges(t))


# Suppliers follow customers: each order line makes its supplier a fan of the customer.
_CONTACTS = """SELECT concat('c', CAST(o_custkey AS VARCHAR)) AS dst, concat('s', CAST(l_suppkey AS VARCHAR)) AS src,
 count(*) AS weight FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2"""


def _contacts(t):
    lines = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey"))
    pairs = lines.select(F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("src"),
                         F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("dst"))
    return graph.edge_weights(pairs)


@add("follower_graph", f"""WITH e AS ({_CONTACTS}) SELECT user, CAST(sum(o) AS BIGINT) AS out_degree,
 CAST(sum(i) AS BIGINT) AS in_degree, CAST(sum(wo) AS BIGINT) AS out_weight, CAST(sum(wi) AS BIGINT) AS in_weight
 FROM (SELECT src AS user, 1 AS o, 0 AS i, weight AS wo, 0 AS wi FROM e
 UNION ALL SELECT dst, 0, 1, 0, weight FROM e) AS x GROUP BY 1""")
def _(t):
    return graph.degrees(_contacts(t))


def pagerank_sql(edges: str, rounds: int, alpha: float = 0.85) -> str:
    """The rank after a fixed number of rounds, one named query per round."""
    parts = [f"e AS MATERIALIZED ({edges})",
             "w AS MATERIALIZED (SELECT src, sum(weight) AS total FROM e GROUP BY src)",
             "s AS MATERIALIZED (SELECT e.src, e.dst, e.weight * 1e0 / w.total AS share FROM e JOIN w USING (src))",
             "n AS MATERIALIZED (SELECT src AS user FROM e UNION SELECT dst FROM e)",
             "c AS MATERIALIZED (SELECT count(*) AS k FROM n)",
             "r0 AS MATERIALIZED (SELECT user, 1e0 / k AS rank FROM n, c)"]
    for i in range(1, rounds + 1):
        before = f"r{i - 1}"
        parts += [f"d{i} AS MATERIALIZED (SELECT coalesce(sum(rank), 0) AS lost FROM {before} "
                  "WHERE user NOT IN (SELECT src FROM w))",
                  f"r{i} AS MATERIALIZED (SELECT n.user, {alpha}e0 * (coalesce(g.gain, 0) + d{i}.lost / c.k) "
                  f"+ (1e0 - {alpha}e0) / c.k AS rank FROM n CROSS JOIN c CROSS JOIN d{i} LEFT JOIN "
                  f"(SELECT s.dst, sum(b.rank * s.share) AS gain FROM s JOIN {before} b ON b.user = s.src "
                  "GROUP BY s.dst) AS g ON g.dst = n.user)"]
    return ", ".join(parts)


@add("pagerank", with_comments(f", {pagerank_sql(EDGES_SQL, 10)} SELECT user, round(rank, 8) AS pagerank FROM r10"))
def _(t):
    ranks = graph.pagerank(_edges(t), rounds=10)
    return ranks.select("user", F.round("pagerank", 8).alias("pagerank"))


@add("follower_rank", f"WITH {pagerank_sql(_CONTACTS, 5)} SELECT user, round(rank, 8) AS pagerank FROM r5")
def _(t):
    ranks = graph.pagerank(_contacts(t), rounds=5)
    return ranks.select("user", F.round("pagerank", 8).alias("pagerank"))


def _until_settled(rounds: int) -> str:
    """The ranks of the first round whose summed change is below nodes * 1e-6."""
    changes = [f"x{i} AS MATERIALIZED (SELECT sum(abs(a.rank - b.rank)) AS change FROM r{i} a JOIN r{i - 1} b USING (user))"
               for i in range(1, rounds + 1)]
    small = " UNION ALL ".join(f"SELECT {i} AS i, change FROM x{i}" for i in range(1, rounds + 1))
    ranks = " UNION ALL ".join(f"SELECT {i} AS i, user, rank FROM r{i}" for i in range(1, rounds + 1))
    return (f"{', '.join(changes)}, stop AS (SELECT min(i) AS i FROM ({small}) AS y WHERE change < (SELECT k FROM c) * 1e-6), "
            f"settled AS (SELECT user, rank FROM ({ranks}) AS z WHERE i = (SELECT i FROM stop))")


@add("opinion_leaders", with_comments(f""", {pagerank_sql(EDGES_SQL, 60)}, {_until_settled(60)} SELECT user,
 round(rank, 5) AS pagerank FROM settled ORDER BY rank DESC, user LIMIT 10"""))
def _(t):
    # Both sides stop at the same round.
    ranks, _edges_kept = opinion.opinion_leaders(t.comments)
    return topk.top_nodes(ranks).select("user", F.round("pagerank", 5).alias("pagerank"))


@add("top_kol", with_comments(f""", {pagerank_sql(EDGES_SQL, 10)} SELECT user, round(rank, 8) AS pagerank FROM r10
 ORDER BY rank DESC, user LIMIT 10"""))
def _(t):
    ranks = stage(graph.pagerank(_edges(t), rounds=10), "ranks")
    return topk.top_nodes(ranks).select("user", F.round("pagerank", 8).alias("pagerank"))
