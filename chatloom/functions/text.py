"""Text columns: whitespace-exact stripping, tokens, counts and seeded draws."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character the scoring rules treat as blank.
BLANKS = "".join(
    map(
        chr,
        [*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203),
         8232, 8233, 8239, 8287, 12288],
    )
)
# Character-class bodies that mean the same to Java and RE2.
WORD = r"\p{L}\p{N}_"
BLANK = r"\t-\r\x1c-\x20\x85\p{Z}"
WORD_OR_MARK = rf"[{WORD}]+|[^{WORD}{BLANK}]"


def strip(text: Column) -> Column:
    """Drop blanks at both ends (all Unicode blanks, not only the space)."""
    return F.btrim(text, F.lit(BLANKS))


def count_of(text: Column, needle: str) -> Column:
    """Non-overlapping occurrences of a fixed ASCII string."""
    removed = F.octet_length(text) - F.octet_length(F.replace(text, F.lit(needle), F.lit("")))
    return (removed / len(needle)).cast("int")


def after_first(text: Column, mark: str) -> Column:
    """What follows the first occurrence of ``mark``; the whole text if absent."""
    at = F.locate(mark, text)
    return F.when(at > 0, F.substring(text, at + len(mark), F.length(text))).otherwise(text)


def before_first(text: Column, mark: str) -> Column:
    return F.substring_index(text, mark, 1)


def after_last(text: Column, mark: str) -> Column:
    return F.substring_index(text, mark, -1)


def words(text: Column) -> Column:
    """Lower-cased words and single punctuation marks."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_OR_MARK), F.lit(0))


def uniform(key: Column, seed) -> Column:
    """A draw in [0, 1) fixed by (seed, key), whatever the partitioning."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
