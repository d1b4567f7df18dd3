"""Frequent patterns and association rules over the features of comments, and over the words of documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.tokens import drop_stop_words, tokenize
from ..operators import patterns
from ..session import stage
from .base import Registry, with_comments
from .scalar import FILTERED_SQL, STOPS

registry = Registry()
add = registry.add

_FEATURES = {"place": "ip_location", "type": "event_type", "lang": "lang", "source": "source_keyword",
             "reply": "parent_comment_id > 0", "picture": "pictures <> ''", "liked": "like_count > 50",
             "hour": "hour(create_time) div 6"}
_DUCK = {**_FEATURES, "hour": "hour(create_time) // 6"}
_BASKETS = "b AS MATERIALIZED (" + " UNION ALL ".join(
    f"SELECT comment_id AS k, '{name}=' || CAST({x} AS VARCHAR) AS i FROM comments WHERE ({x}) IS NOT NULL" for name, x in _DUCK.items()) + ")"
_WORDS = f"b AS MATERIALIZED (SELECT DISTINCT doc_id AS k, unnest({FILTERED_SQL.format('text')}) AS i FROM documents)"


def _levels(share: float) -> str:
    """Sets of up to three items, counted by plain joins."""
    return f"""n AS MATERIALIZED (SELECT count(DISTINCT k) AS n, (count(DISTINCT k) * {round(share * 1_000_000)} + 999999) // 1000000 AS s FROM b),
 f1 AS MATERIALIZED (SELECT i, count(*) AS c FROM b GROUP BY i HAVING count(*) >= (SELECT s FROM n)),
 r AS MATERIALIZED (SELECT k, i FROM b WHERE i IN (SELECT i FROM f1)),
 p AS MATERIALIZED (SELECT x.k, x.i AS i, y.i AS j FROM r x JOIN r y ON x.k = y.k AND x.i < y.i),
 f2 AS MATERIALIZED (SELECT i, j, count(*) AS c FROM p GROUP BY i, j HAVING count(*) >= (SELECT s FROM n)),
 q AS (SELECT p.k, p.i, p.j FROM p JOIN f2 USING (i, j)),
 f3 AS MATERIALIZED (SELECT q.i, q.j, z.i AS l, count(*) AS c FROM q JOIN r z ON z.k = q.k AND z.i > q.j GROUP BY ALL HAVING count(*) >= (SELECT s FROM n)),
 f AS MATERIALIZED (SELECT [i] AS items, c FROM f1 UNION ALL SELECT [i, j], c FROM f2 UNION ALL SELECT [i, j, l], c FROM f3)"""


_SETS = "SELECT array_to_string(items, '|') AS items, CAST(len(items) AS INT) AS size, c AS support, (SELECT n FROM n) AS transactions FROM f"
_RULES = """, x AS (SELECT items, c, unnest(items) AS consequent FROM f WHERE len(items) > 1),
 y AS (SELECT list_filter(items, lambda e: e <> consequent) AS antecedent, consequent, c FROM x)
 SELECT array_to_string(y.antecedent, '|') AS antecedent, y.consequent, y.c AS support, round(y.c / l.c, 9) AS confidence,
 round((y.c / l.c) * (SELECT n FROM n) / g.c, 9) AS lift FROM y JOIN f l ON l.items = y.antecedent JOIN f1 g ON g.i = y.consequent WHERE y.c / l.c >= """


def _comment_baskets(t):
    return patterns.feature_items(t.comments, "comment_id", {name: F.expr(x) for name, x in _FEATURES.items()})


def _word_baskets(t):
    return t.spread_documents.select("doc_id", F.explode(drop_stop_words(tokenize(F.col("text")), STOPS)).alias("item"))


def _sets(found):
    return found.select(F.array_join("items", "|").alias("items"), "size", "support", "transactions")


def _rules(found, least):
    rules = patterns.association_rules(stage(found, "itemsets"), least)
    return rules.select(F.array_join("antecedent", "|").alias("antecedent"), "consequent", "support",
                        F.round("confidence", 9).alias("confidence"), F.round("lift", 9).alias("lift"))


@add("frequent_patterns", with_comments(f", {_BASKETS}, {_levels(0.02)} {_SETS}"))
def _(t):
    return _sets(patterns.frequent_itemsets(_comment_baskets(t), "comment_id", min_share=0.02))


@add("association_rules", with_comments(f", {_BASKETS}, {_levels(0.02)} {_RULES} 0.5"))
def _(t):
    return _rules(patterns.frequent_itemsets(_comment_baskets(t), "comment_id", min_share=0.02), 0.5)


@add("word_patterns", f"WITH {_WORDS}, {_levels(0.28)} {_SETS}")
def _(t):
    return _sets(patterns.frequent_itemsets(_word_baskets(t), "doc_id", min_share=0.28))


@add("word_rules", f"WITH {_WORDS}, {_levels(0.28)} {_RULES} 0.9")
def _(t):
    return _rules(patterns.frequent_itemsets(_word_baskets(t), "doc_id", min_share=0.28), 0.9)
