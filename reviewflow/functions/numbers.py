"""Ratings and like counts: Column -> Column, all evaluated in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewflow.functions.text import SPACE, nonblank, pystrip

WIDE_DIGITS, DIGITS = "０１２３４５６７８９", "0123456789"


def narrow_digits(c: Column) -> Column:
    return F.translate(c, WIDE_DIGITS, DIGITS)


def _compact(c: Column) -> Column:
    """A decimal number's text without trailing zeros and point."""
    return F.regexp_replace(F.regexp_replace(c, r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")


def normalize_rating(c: Column) -> Column:
    """The number of a rating between 1 and 5 in its usual wordings; any other text stays, blank becomes null."""
    t = narrow_digits(pystrip(c))
    form = rf"(?i)^([0-9]+(?:\.[0-9]+)?)(?:{SPACE}+out{SPACE}+of{SPACE}+5{SPACE}+stars?|{SPACE}*颗星，最多{SPACE}*5{SPACE}*颗星)?$"
    number = F.regexp_extract(t, form, 1)
    value = number.try_cast("decimal(38,10)")
    return F.when(t == "", None).when((number != "") & value.between(1, 5), _compact(number)).otherwise(c)


def normalize_likes(c: Column) -> Column:
    """The number of likes in its usual wordings; blank counts as 0, any other text stays."""
    t = narrow_digits(pystrip(c))
    form = rf"(?i)^([0-9]+)(?:{SPACE}+people?{SPACE}+found{SPACE}+this{SPACE}+helpful|{SPACE}*个人发现此评论有用)?$"
    number = F.regexp_extract(t, form, 1)
    one = t.rlike(rf"(?i)^one{SPACE}+person{SPACE}+found{SPACE}+this{SPACE}+helpful$")
    plain = F.regexp_replace(number, "^0+(?=[0-9])", "")
    return F.when(c.isNull() | (t == ""), "0").when(one, "1").when(number != "", plain).otherwise(c)


def likes_for_ranking(c: Column) -> Column:
    """A decimal for comparing; 0 for anything that is no number."""
    t = narrow_digits(pystrip(c))
    return F.coalesce(F.when(t.rlike(r"^[+-]?[0-9]+(\.[0-9]+)?$"), t.try_cast("decimal(38,6)")), F.lit(0).cast("decimal(38,6)"))


def product_or(c: Column, fallback: str) -> Column:
    return F.coalesce(nonblank(c), F.lit(fallback))


def attribute(direct: Column, gender: Column, age: Column) -> Column:
    """The direct value if there is one, else gender and age."""
    return F.coalesce(nonblank(direct), F.nullif(F.concat_ws(" ", nonblank(gender), nonblank(age)), F.lit("")))
