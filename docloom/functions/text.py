"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def words(text: Column) -> Column:
    """Runs of anything but ASCII white space."""
    return F.regexp_extract_all(text, F.lit(r"(\S+)"), F.lit(1))


def spaced_words(text: Column) -> Column:
    """Each word with the white space before it: joined, they are the text up to its last word."""
    return F.regexp_extract_all(text, F.lit(r"\s*+\S++"), F.lit(0))


def tokens(text: Column) -> Column:
    """Lower-case runs of ASCII letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9]+)"), F.lit(1))


def sentences(text: Column) -> Column:
    """Cut after . ! or ? where white space follows."""
    return F.filter(F.split(text, r"(?<=[.!?])\s+"), lambda s: s != "")


def strip_citations(text: Column) -> Column:
    """Without [n] marks."""
    return F.regexp_replace(text, r"\[\d+\]", "")


def word_set(text: Column) -> Column:
    return F.array_distinct(words(F.lower(text)))


def share_of_words(chunk: Column, entry: Column) -> Column:
    """Part of the entry's distinct words that the chunk has; 0 for an entry without words."""
    have, want = F.size(F.array_intersect(word_set(chunk), word_set(entry))), F.size(word_set(entry))
    return F.when(want > 0, have / want).otherwise(F.lit(0.0))


def shared_edge(before: Column, after: Column, least: int = 11) -> Column:
    """Length of the longest suffix of before that after begins with; 0 if shorter than least.

    Such a suffix starts with the first characters of after, so their first
    place in before is tried first: if it fits, it is the longest. Only if it
    does not are all lengths tried.
    """
    n = F.least(F.length(before), F.length(after))
    place = F.position(F.left(after, F.lit(least)), before)
    size = F.length(before) - place + 1
    lengths = F.filter(F.sequence(F.lit(least), F.greatest(n, F.lit(least))), lambda i: (i <= n) & F.startswith(after, F.right(before, i)))
    found = F.when(F.startswith(after, F.right(before, size)), size).otherwise(F.coalesce(F.array_max(lengths), F.lit(0)))
    return F.when((n >= least) & (place > 0), found).otherwise(F.lit(0))


def tagged_chunks(text: Column) -> Column:
    """What stands between <chunk> and </chunk>, trimmed; pieces without an end tag are left out."""
    pieces = F.filter(F.split(text, "<chunk>"), lambda p: F.contains(p, F.lit("</chunk>")))
    return F.transform(pieces, lambda p: F.trim(F.substring_index(p, "</chunk>", 1)))


def without_nul(text: Column) -> Column:
    return F.translate(text, "\0", "")


def header_level(html: Column) -> Column:
    """The least level of the h1 to h6 tags in html; 1 without any."""
    levels = F.regexp_extract_all(F.lower(html), F.lit("<h([1-6])"), F.lit(1))
    return F.coalesce(F.array_min(levels).cast("int"), F.lit(1))
