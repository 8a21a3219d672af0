"""Text functions: Column -> Column, all evaluated in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode text processing knows it, incl. the four separator controls that ``\\s`` of Java leaves out.
SPACE = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
HAN, KANA, HANGUL = r"[\x{4e00}-\x{9fff}]", r"[\x{3040}-\x{30ff}]", r"[\x{ac00}-\x{d7af}\x{1100}-\x{11ff}]"
THAI, DEVANAGARI = r"[\x{e00}-\x{e7f}]", r"[\x{900}-\x{97f}]"
LATIN_LETTER = r"[A-Za-zÀ-ÖØ-öø-ÿĀ-ž]"
#: The few frequent characters whose case folding is not their lower case.
FOLDS = (("ß", "ss"), ("ſ", "s"), ("µ", "μ"), ("ς", "σ"), ("ŉ", "ʼn"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬀ", "ff"))


def bound(c: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once for a row, however often f uses it; plain nesting would compute it for every use."""
    return F.get(F.transform(F.array(c), f), 0)


def pystrip(c: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def nonblank(c: Column) -> Column:
    """The stripped text, or null where nothing is left."""
    return F.nullif(pystrip(c), F.lit(""))


def bare(c: Column) -> Column:
    """Without any white space: how headers are compared."""
    return F.regexp_replace(c, SPACE, "")


def fold(c: Column) -> Column:
    """Case folding: lower case plus the folds that differ from it."""
    out = F.lower(c)
    for a, b in FOLDS:
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def script_group(c: Column) -> Column:
    """The script group of a comment; the first script in this order that occurs, Latin only if all letters are."""
    return (
        F.when(F.lower(c).isin("http://", "https://"), "neutral")
        .when(c.rlike(KANA), "japanese")
        .when(c.rlike(HANGUL), "korean")
        .when(c.rlike(THAI), "thai")
        .when(c.rlike(DEVANAGARI), "hindi")
        .when(c.rlike(HAN), "chinese")
        .when(c.rlike(r"\p{L}") & ~c.rlike(r"[\p{L}&&[^\p{IsLatin}]]"), "latin")
        .otherwise("neutral")
    )


def word_count(c: Column) -> Column:
    """Words of a text without Han that has Latin letters or white space; null for any other."""
    counted = (c != "") & ~c.rlike(HAN) & (c.rlike(LATIN_LETTER) | c.rlike(SPACE))
    return F.when(counted, F.size(F.regexp_extract_all(c, F.lit(r"[\p{L}\p{N}\p{M}]+"), F.lit(0))))


def strip_reply_prefix(c: Column) -> Column:
    """Without a leading reply mark that names another user; white space after the body stays."""
    lead = r"(?s)^%s*回复%s*@[^:：]+?%s*[:：]%s*" % ((SPACE,) * 4)
    return F.when(c.rlike(lead), F.regexp_replace(c, lead, "")).otherwise(c)


def strip_https(c: Column) -> Column:
    """Without https addresses; stripped only if one was removed."""
    link = r"https://[^\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
    return F.when(c.rlike(link), pystrip(F.regexp_replace(c, link, ""))).otherwise(c)


def link_list(c: Column) -> Column:
    """All web addresses, distinct, in order of first occurrence, joined by '; '."""
    found = F.regexp_extract_all(c, F.lit(r"https?://[^\s)\]<>\"']+"), F.lit(0))
    return F.array_join(F.array_distinct(found), "; ")


def keep_by_keywords(c: Column, keywords: list[str]) -> Column:
    """Whether any keyword occurs, without regard to case; null texts don't pass."""
    keys = normalize_keywords(keywords)
    return F.coalesce(F.exists(F.array(*map(F.lit, keys)), lambda k: F.contains(fold(c), k)), F.lit(False))


def normalize_keywords(keywords: list[str]) -> list[str]:
    """Stripped, folded, without blanks and repetitions; at least one must remain."""
    keys = list(dict.fromkeys(k.strip().casefold() for k in keywords if k and k.strip()))
    if not keys:
        raise ValueError("at least one keyword is needed")
    return keys


def row_hash(cells: list[Column]) -> Column:
    """The first twelve hex digits of the digest of a row's JSON array."""
    return F.substring(F.sha2(F.to_json(F.array(*cells)), 256), 1, 12)
