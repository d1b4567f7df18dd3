"""The registered queries of this subpackage, each next to the DuckDB statement that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..catalog.base import Registry, Tables
from .attention_lm import score_texts
from .decontaminate import find_leaks
from .jaccard_join import similar_documents
from .kneser_ney import classify_quality
from .language_id import identify_languages
from .mixing import mix_sources
from .oracles import JACCARD_JOIN, QUALITY_RULES, RANKED_SEARCH, SUBSTRING_DEDUP, URL_RULES
from .quality_rules import quality_rules
from .ranked_search import search
from .simhash import near_duplicates
from .substring_dedup import remove_repeats
from .token_counts import count_tokens
from .url_rules import judge_urls
from .whitening import by_component, whiten

registry = Registry()


@registry.add("op1_mix_sources")
def _(t: Tables) -> DataFrame:
    return mix_sources(t.documents).select("row.doc_id", "size", "source_size", "target", "taken", "copies", "rate")


@registry.add("op2_token_counts")
def _(t: Tables) -> DataFrame:
    return count_tokens(t.documents).select("row.doc_id", "n_chars", "n_tokens", "n_unknown")


@registry.add("op3_quality_rules", QUALITY_RULES)
def _(t: Tables) -> DataFrame:
    return quality_rules(t.documents).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@registry.add("op4_language_id")
def _(t: Tables) -> DataFrame:
    return identify_languages(t.documents).select("row.doc_id", "held_out", "lang_pred", "score", "ambiguous")


@registry.add("op5_simhash")
def _(t: Tables) -> DataFrame:
    return near_duplicates(t.documents).select("doc_id", "fingerprint", "component_id")


@registry.add("op6_url_rules", URL_RULES)
def _(t: Tables) -> DataFrame:
    return judge_urls(t.pages).select("row.page_id", "host", "path", "rule", "verdict")


@registry.add("op7_quality_classifier")
def _(t: Tables) -> DataFrame:
    return classify_quality(t.documents, t.labels).select("doc_id", "lang", "perplexity", "kept")


@registry.add("op8_substring_dedup", SUBSTRING_DEDUP)
def _(t: Tables) -> DataFrame:
    return remove_repeats(t.documents).select("row.doc_id", "n_words", "n_removed", "kept_sha256")


@registry.add("op9_decontaminate")
def _(t: Tables) -> DataFrame:
    return find_leaks(t.documents, t.benchmark)


@registry.add("op10_attention_lm")
def _(t: Tables) -> DataFrame:
    return score_texts(t.documents).select(
        "row.doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@registry.add("op11_whitening")
def _(t: Tables) -> DataFrame:
    return by_component(whiten(t.embeddings), "vec_id")


@registry.add("op12_jaccard_join", JACCARD_JOIN)
def _(t: Tables) -> DataFrame:
    return similar_documents(t.documents)


@registry.add("op13_ranked_search", RANKED_SEARCH)
def _(t: Tables) -> DataFrame:
    return search(t.documents, t.benchmark)
