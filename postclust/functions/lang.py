"""Language lookups as column expressions.

The language list is a parameter of at most a few dozen names, so it is folded
into the plan as a literal array; no join and no UDF is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from postclust.functions.arith import int_div
from postclust.params import UNKNOWN_LANG_X


def lang_array(langs: Sequence[str]) -> Column:
    return F.array(*[F.lit(lang) for lang in langs])


def first_lang_index(tags: Column, langs: Sequence[str]) -> Column:
    """0-based position of the tag in the language list (exact,
    case-sensitive, first match), NULL when absent or when the tag is NULL."""
    pos = F.array_position(lang_array(langs), tags)  # 1-based, 0 = absent, NULL for a NULL tag
    return F.when(pos > 0, (pos - 1).cast("int"))


def lang_factor(tags: Column, langs: Sequence[str], spread: int) -> Column:
    """P5: ``index * spread``; an unknown language is -1 (kept, not dropped)."""
    return F.coalesce(first_lang_index(tags, langs) * F.lit(spread), F.lit(UNKNOWN_LANG_X)).cast("int")


def lang_index(x: Column, spread: int) -> Column:
    """Language index of a factor, integer division toward zero (-1 -> 0)."""
    return int_div(x, F.lit(spread)).cast("int")


def lang_label(x: Column, langs: Sequence[str], spread: int) -> Column:
    """Language name of a factor. x = -1 maps to the first language, since
    -1 divided by the spread is 0; an index outside the list gives NULL."""
    return F.get(lang_array(langs), lang_index(x, spread))
