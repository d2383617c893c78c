from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points a Unicode-aware strip removes from both ends.
WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u001c\u001d\u001e\u001f\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(name: str) -> Column:
    """Column `name` without Unicode whitespace at either end; NULL stays NULL.

    A right trim with a character set indexes every character of the text first, so it only runs
    for texts that do end in whitespace: 29 suffix checks cost nothing next to a pass over a long
    body. The left trim stops at the first other character by itself.
    """
    text = F.col(name)
    white = F.lit(WHITESPACE)
    ends_white = reduce(or_, [text.endswith(c) for c in WHITESPACE])
    return F.ltrim(F.when(ends_white, F.rtrim(text, white)).otherwise(text), white)


def text_length(text: Column) -> Column:
    """Length in code points as BIGINT."""
    return F.length(text).cast("bigint")
