"""Deletion rules: the first rule that holds gives the reason. One Column expression, evaluated lazily in the JVM.

Terms are grouped by script once on the driver, so that a row tests only the terms of its own script and neutral ones.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewflow.conf import values as V
from reviewflow.functions.text import HAN, bound, fold, script_group, word_count

_ORDER = (("japanese", "぀-ヿ"), ("korean", "가-힯ᄀ-ᇿ"), ("thai", "฀-๿"), ("hindi", "ऀ-ॿ"), ("chinese", "一-鿿"))
GROUPS = ("latin", "chinese", "japanese", "korean", "thai", "hindi", "neutral")


def term_group(term: str) -> str:
    """A term's script group, by the same precedence as a comment's."""
    if term in V.TERM_SCRIPTS:
        return V.TERM_SCRIPTS[term]
    if term.lower() in ("http://", "https://"):
        return "neutral"
    for name, chars in _ORDER:
        if re.search(f"[{chars}]", term):
            return name
    letters = [c for c in term if c.isalpha()]
    return "latin" if letters and all(ord(c) < 0x250 for c in letters) else "neutral"


def _needle(term: str, group: str, any_case: bool) -> str:
    """The pattern of a Latin term, bounded where it ends in a letter or digit; any other term is its own text."""
    if group != "latin":
        return term.casefold() if any_case else term
    head = r"(?<![\p{L}\p{N}\p{M}_])" if term[0].isalnum() else ""
    tail = r"(?![\p{L}\p{N}\p{M}_])" if term[-1].isalnum() else ""
    return ("(?iu)" if any_case else "") + head + re.escape(term) + tail


def fixed_term(c: Column) -> Column:
    """The first fixed term that a comment of the term's script (or a neutral term) contains, else null.

    Script, text and folded text are bound once for a row. The terms of a script are a chain of literals; a Latin term's pattern, a
    literal too, is tried only where the comment contains the term at all.
    """
    terms = [(t, term_group(t), False) for t in V.TERMS_EXACT] + [(t, term_group(t), True) for t in V.TERMS_ANY_CASE]

    def first(s: Column, own: str) -> Column:
        found = []
        for t, group, any_case in (x for x in terms if x[1] in (own, "neutral")):
            has = F.contains(s["f"], F.lit(t.casefold())) if any_case else F.contains(s["c"], F.lit(t))
            if group == "latin":
                has = has & s["c"].rlike(_needle(t, group, any_case))
            found.append(F.when(has, F.lit(t)))
        return F.coalesce(*found, F.lit(None).cast("string"))

    def by_group(s: Column) -> Column:
        return reduce(lambda e, g: e.when(s["g"] == g, first(s, g)), GROUPS[1:-1], F.when(s["g"] == "latin", first(s, "latin"))).otherwise(first(s, "neutral"))

    return bound(c, lambda x: bound(F.struct(x.alias("c"), fold(x).alias("f"), script_group(x).alias("g")), by_group))


def length_reason(c: Column) -> Column:
    words = word_count(c)
    long_enough = f"评论长度小于 {V.MIN_LENGTH}"
    return (
        F.when(script_group(c) == "chinese", F.when(F.length(c) < V.MIN_LENGTH, long_enough))
        .when(c.rlike("^[0-9０-９]+$"), F.when(F.length(c) < V.MIN_LENGTH, long_enough))
        .when(words.isNotNull(), F.when(words <= V.SHORT_WORDS, f"非中文评论词数小于等于 {V.SHORT_WORDS}"))
        .when(F.length(c) <= V.SHORT_UNSPACED, f"非中文无空格短文本长度小于等于 {V.SHORT_UNSPACED}")
    )


def is_random_heap(c: Column) -> Column:
    """Letters and digits heaped at random: a long token of digits, of both, or of hardly pronounceable letters; never with Han."""

    def random(t: Column) -> Column:
        vowels = F.length(F.regexp_replace(t, "(?i)[^aeiou]", ""))
        letters = t.rlike(f"^[A-Za-z]{{{V.RANDOM_LETTERS},}}$") & (
            (vowels / F.length(t) <= V.VOWEL_RATIO) | t.rlike(f"(?i)[b-df-hj-np-tv-z]{{{V.CONSONANT_RUN},}}")
        )
        mixed = t.rlike("[0-9]") & t.rlike("[A-Za-z]") & (F.length(t) >= V.RANDOM_MIXED)
        return t.rlike(f"^[0-9]{{{V.RANDOM_DIGITS},}}$") | mixed | letters

    # No shorter token can be one, so that most texts are never cut into tokens.
    token = f"[A-Za-z0-9]{{{min(V.RANDOM_DIGITS, V.RANDOM_LETTERS, V.RANDOM_MIXED)},}}"
    return F.when(c.rlike(token) & ~c.rlike(HAN), F.exists(F.regexp_extract_all(c, F.lit(token), F.lit(0)), random)).otherwise(F.lit(False))


def placeholder_reason(c: Column) -> Column:
    return F.when(c.isin(*V.PLACEHOLDERS), "评论等于占位文案")


def clean_word_reason(c: Column, words: list[str]) -> Column:
    return F.coalesce(*(F.when(F.contains(c, F.lit(w)), F.lit(f"评论包含清理词: {w}")) for w in words), F.lit(None).cast("string"))


def deletion_reason(c: Column, clean_words: list[str] | None = None) -> Column:
    """The reason to delete a comment (already stripped, null as ''), or null. First match wins."""

    def first(x: Column) -> Column:
        return F.coalesce(
            length_reason(x),
            placeholder_reason(x),
            clean_word_reason(x, clean_words or []),
            F.concat(F.lit("评论包含固定删除词: "), fixed_term(x)),
            F.when(is_random_heap(x), "评论为无中文随机英文/数字堆砌"),
        )

    return bound(c, first)
