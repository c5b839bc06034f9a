"""Ordered keyword rules: categories, source defaults, relevance reasons and quality."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.text import first_hit, lit_array, word_count

UNKNOWN = "uncategorised"


def category_of(token_set: Column, taxonomy: dict[str, list[str]]) -> Column:
    """The first category, in the taxonomy's order, that shares a token with the set."""
    return F.coalesce(*[F.when(F.arrays_overlap(token_set, lit_array([w.lower() for w in words])), name) for name, words in taxonomy.items()], F.lit(UNKNOWN))


def with_source_default(category: Column, source: Column, defaults: dict[str, str]) -> Column:
    """Uncategorised rows take the category of the first needle in their source's name."""
    hits = [F.when(F.contains(F.lower(source), F.lit(n.lower())), c) for n, c in defaults.items() if n]
    return F.when(category == UNKNOWN, F.coalesce(*hits, F.lit(UNKNOWN))).otherwise(category)


def relevance(text: Column, category: Column, rules: dict[str, dict[str, list[str]]]) -> tuple[Column, Column]:
    """Whether a row is on topic for its category's rule, and the reason."""
    on, reason = F.lit(True), F.lit("no-rule")
    for name, rule in rules.items():
        need, bar = rule.get("require_any") or [], rule.get("exclude_any") or []
        if need:
            hit = first_hit(text, need)
            o, r = hit.isNotNull(), F.when(hit.isNotNull(), F.concat(F.lit("kept:"), hit)).otherwise("excluded:no-require-hit")
        elif bar:
            hit = first_hit(text, bar)
            o, r = hit.isNull(), F.when(hit.isNull(), "kept:no-exclude-hit").otherwise(F.concat(F.lit("excluded:"), hit))
        else:
            o, r = F.lit(True), F.lit("kept:no-rule-fields")
        on, reason = F.when(category == name, o).otherwise(on), F.when(category == name, r).otherwise(reason)
    return on, reason


def quality_score(title: Column, body: Column, keywords: list[str], source_weight: Column, weights=(0.4, 0.3, 0.3)) -> Column:
    """Keyword share, length up to 500 characters and source weight, clamped to [0, 1]."""
    hits = F.size(F.filter(lit_array(keywords), lambda k: F.contains(F.lower(title), F.lower(k))))
    long = F.least(word_count(title, F.lit(" "), body), F.lit(500)) / 500.0
    score = F.least(hits / float(len(keywords)), F.lit(1.0)) * weights[0] + long * weights[1] + F.coalesce(source_weight, F.lit(0.5)) * weights[2]
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))
