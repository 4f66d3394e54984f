"""The default tokenizer as native columns: word runs and single punctuation marks of ASCII text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Model input size and how many tokens of the next chunk a chunk may look ahead.
MODEL_INPUT = 512
OVERLAP = 52
SPECIAL_TOKENS = 2  # start and end marker

# ASCII word runs and single marks; Python needs re.ASCII for the same meaning.
TOKEN_PATTERN = r"\w+|[^\w\s]"


def token_array(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({TOKEN_PATTERN})"), F.lit(1))


def token_count(text: Column, add_special: bool = True) -> Column:
    """Number of tokens, with or without the two markers.

    Word runs shrink to one letter and blanks go, so that the length is the count and no token array is built.
    """
    shrunk = F.translate(F.regexp_replace(text, r"\w+", "a"), " \t\n\x0b\f\r", "")
    return F.length(shrunk) + F.lit(SPECIAL_TOKENS if add_special else 0)


def truncate_tokens(tokens: Column, max_tokens: int = MODEL_INPUT, add_special: bool = True) -> Column:
    """The first tokens that fit the model input; the markers take two places."""
    return F.slice(tokens, 1, max_tokens - (SPECIAL_TOKENS if add_special else 0))
