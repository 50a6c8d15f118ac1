"""Column functions on text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that regular expressions give a meaning.
REGEX_METACHARACTERS = r"([\\.^$|()\[\]{}*+?])"

# Characters that count as part of a word next to a term.
WORD = "a-z0-9"
WORD_OR_UNDERSCORE = "a-z0-9_"

# Names of the formatting conditions, in the order they are tested.
FORMAT_CLASSES = (
    "NULL",
    "Empty string",
    "Whitespace only",
    "Leading/trailing whitespace",
    "No formatting issue",
)


def col(name: str | Column) -> Column:
    return name if isinstance(name, Column) else F.col(name)


def trim_spaces(value: str | Column) -> Column:
    """Without spaces (U+0020) at either end; tabs and other blanks stay."""
    return F.trim(col(value))


def trim_blanks(value: str | Column) -> Column:
    """Without any Unicode white space at either end."""
    return F.regexp_replace(col(value), r"(?U)^\s+|\s+$", "")


def strip_characters(value: str | Column, characters: str) -> Column:
    """Without any of `characters` at either end."""
    return F.btrim(col(value), F.lit(characters))


def fold_case(value: str | Column) -> Column:
    return F.lower(col(value))


def last_characters(value: str | Column, n: int) -> Column:
    return F.right(col(value), F.lit(n))


def is_missing(value: str | Column) -> Column:
    """NULL or the empty string; never NULL itself."""
    value = col(value)
    return value.isNull() | (value == "")


def differs(value: str | Column, cleaned: Column) -> Column:
    """Whether cleaning would change the value; NULL, hence not counted, for NULL."""
    return col(value) != cleaned


def format_class(value: str | Column) -> Column:
    """First formatting condition that applies."""
    value = col(value)
    unknown, empty, blank, padded, fine = FORMAT_CLASSES
    return (
        F.when(value.isNull(), unknown)
        .when(value == "", empty)
        .when(F.trim(value) == "", blank)
        .when(differs(value, F.trim(value)), padded)
        .otherwise(fine)
    )


def escape_regex(value: str | Column) -> Column:
    """With every metacharacter taken literally."""
    return F.regexp_replace(col(value), REGEX_METACHARACTERS, r"\\$1")


def word_class(word: str = WORD) -> str:
    """Pattern of one `word` character of lower-cased text.

    A class of three parts is ten times slower than its equal short form.
    """
    return r"\w" if word == WORD_OR_UNDERSCORE else f"[{word}]"


def boundary_class(word: str = WORD) -> str:
    """Pattern of one character of lower-cased text that is none of `word`."""
    return r"\W" if word == WORD_OR_UNDERSCORE else f"[^{word}]"


def boundary_pattern(term: str | Column, word: str = WORD) -> Column:
    """Pattern that finds the lower-cased term, literally, where no `word` character touches it.

    The term comes first and what is around it after, so that the search skips
    from one first character to the next.
    """
    literal, near = escape_regex(F.lower(col(term))), word_class(word)
    return F.concat(literal, F.lit(f"(?<!{near}"), literal, F.lit(f")(?!{near})"))


def contains_ignoring_case(text: str | Column, part: str | Column) -> Column:
    """Substring test, case aside; `%` and `_` in `part` are wildcards, a backslash escapes."""
    part = F.lit(part) if isinstance(part, str) else part
    # A backslash before an ordinary character says nothing, but Spark refuses it.
    part = F.regexp_replace(part, r"(?s)(\\[%_\\])|\\(.)", "$1$2")
    return F.ilike(col(text), F.concat(F.lit("%"), part, F.lit("%")))
