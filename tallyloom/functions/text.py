"""Text and number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whole impressions are summed exactly; wide enough for any amount.
AMOUNT = "decimal(30,6)"
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def try_number(text: Column, to: str = "double") -> Column:
    """Text to number; anything that is not one ('5d', 'n/a') becomes null instead of failing the job."""
    return F.when(text.rlike(_NUMBER), text).try_cast(to)


def parse_number(text: Column, to: str = "double") -> Column:
    """Like ``try_number`` after removing thousands commas and dollar signs."""
    return try_number(F.translate(text, ",$", ""), to)


def quoted(name: str) -> str:
    """A column name as it has to be written, whatever is in it."""
    return "`" + name.replace("`", "``") + "`"


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def comma_text(number: Column) -> Column:
    """1234 -> '1,234'."""
    return F.format_number(number, 0)


def contains_word(text: Column, word: str) -> Column:
    """Substring test that is false, not null, on null text."""
    return F.coalesce(text.contains(word), F.lit(False))


def matches(text: Column, pattern: str) -> Column:
    """Regex search on the lower-cased text; false on null."""
    return F.coalesce(F.lower(text).rlike(pattern), F.lit(False))


def split_first(text: Column, sep: str) -> Column:
    """The part before the first separator: 'City, ST' -> 'City'."""
    return F.split(text, _literal(sep)).getItem(0)


def split_into(text: Column, sep: str, parts: int) -> list[Column]:
    """At most ``parts`` pieces, the last one keeping any further separators; missing ones are null."""
    pieces = F.split(text, _literal(sep), parts)
    return [F.get(pieces, F.lit(i)) for i in range(parts)]


def last_n(text: Column, n: int) -> Column:
    """The last n characters, or the whole text when it is shorter."""
    return F.right(text, F.lit(n))


def replace_chain(text: Column, replacements: dict[str, str], anchored: bool = True) -> Column:
    """Ordered replacements.  Anchored (default) replaces only a whole value, so that names which are
    already long stay as they are; unanchored replaces inside longer text as well."""
    for old, new in replacements.items():
        text = F.regexp_replace(text, f"^{old}$" if anchored else old, new)
    return text


def join_items(items: Column, sep: str = ",") -> Column:
    """Array to 'a,b,c'."""
    return F.array_join(items, sep)


def quote_in_list(names: Column) -> Column:
    """'a, b' -> \"('a','b')\"."""
    quoted = F.transform(F.split(names, ","), lambda x: F.concat(F.lit("'"), strip(x), F.lit("'")))
    return F.concat(F.lit("("), F.array_join(quoted, ","), F.lit(")"))


def title_case(text: Column) -> Column:
    """Upper case for each letter that follows a non-letter ('9am-tv' -> '9Am-Tv'), lower case otherwise.

    ``initcap`` only looks at white space, so each character is paired with the one before it.
    """
    chars = F.split(text, "")
    before = F.concat(F.array(F.lit(" ")), chars)  # one longer; the last pair has no character and drops out

    def cased(c: Column, previous: Column) -> Column:
        return F.when(previous.rlike(r"\p{L}"), F.lower(c)).otherwise(F.upper(c))

    return F.array_join(F.zip_with(chars, before, cased), "")


def _literal(sep: str) -> str:
    return "".join(f"\\{c}" if c in r".|\^$*+?()[]{}" else c for c in sep)
