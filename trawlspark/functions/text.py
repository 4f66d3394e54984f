"""Text cleaning, words, stop words and keyword tests, all as native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What cleaning deletes: square brackets with what is between them on one line, everything outside ASCII, runs of four
# blanks, tabs and line breaks; for the index also tags. Possessive, so that no match is tried twice.
SNIPPET_PATTERN = r"[\t\n\r\P{ASCII}]++|\[[^\n\]]*+\]| {4}"
INDEX_PATTERN = SNIPPET_PATTERN + r"|<[^>]*+>"

# The English stop words.
STOPWORDS = tuple(
    """
    i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves
    he him his himself she she's her hers herself it it's its itself they them their theirs themselves
    what which who whom this that that'll these those am is are was were be been being have has had having
    do does did doing a an the and but if or because as until while of at by for with about against
    between into through during before after above below to from up down in out on off over under again
    further then once here there when where why how all any both each few more most other some such
    no nor not only own same so than too very s t can will just don don't should should've now
    d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't
    haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't
    wasn wasn't weren weren't won won't wouldn wouldn't
    """.split()
)


def clean_text(text) -> Column:
    """Index form of ``title + " " + body``: brackets, non-ASCII, four-blank runs, line breaks and tags are deleted."""
    return F.regexp_replace(F.col(text) if isinstance(text, str) else text, INDEX_PATTERN, "")


def clean_snippet_text(text) -> Column:
    """Snippet form: as the index form but tags stay; lower case."""
    return F.lower(F.regexp_replace(F.col(text) if isinstance(text, str) else text, SNIPPET_PATTERN, ""))


def words(text) -> Column:
    """Non-blank runs, without empty strings."""
    return F.regexp_extract_all(F.col(text) if isinstance(text, str) else text, F.lit(r"(\S+)"), F.lit(1))


def is_stopword(word: Column) -> Column:
    """Exact match on the lower-cased word; punctuation is kept."""
    return F.lower(word).isin(*STOPWORDS)


def remove_stopwords(word_array: Column) -> Column:
    return F.filter(word_array, lambda w: ~is_stopword(w))


def is_keyword(word: Column, query: Column) -> Column:
    """True for a word that is part of the lower-cased query text and no stop word. A substring test."""
    return ~word.isin(*STOPWORDS) & query.contains(word)


def query_text(query: Column, title: Column) -> Column:
    """What keywords are looked up in: query, blank, title."""
    return F.concat_ws(" ", F.coalesce(query, F.lit("")), F.coalesce(title, F.lit("")))


def join_text(parts: Column) -> Column:
    """Text nodes joined by one blank."""
    return F.array_join(parts, " ")
