"""Region and state derived from free-text place names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OF = " of "

# The characters stripped from both ends of a region name (Unicode white space).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def area_split(place: Column) -> Column:
    """Text after the first `` of ``, stripped; the whole place when there is none."""
    tail = F.substr(place, F.instr(place, OF) + F.lit(len(OF)))
    return F.when(place.contains(OF), F.trim(tail, F.lit(WHITESPACE))).otherwise(place)


def area_regex(place: Column) -> Column:
    """Compatibility form: the pattern also matches `` of`` at the head of a longer word, keeps
    trailing blanks and stops at a line break."""
    return F.when(place.contains(OF), F.regexp_extract(place, r" of\s*(.*)", 1)).otherwise(place)


def state_suffix(area: Column, separator: str = ",") -> Column:
    """Text after the first separator, untrimmed; the whole text when there is none."""
    return F.substr(area, F.instr(area, separator) + F.lit(1))
