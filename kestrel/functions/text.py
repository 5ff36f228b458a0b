"""Text functions as native array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token separator — anything that is not a letter, digit or
# underscore (Unicode-aware, the meaning of Python's ``\W+``).  Written as an
# explicit class so Java and RE2 engines split identically.
TOKEN_SEPARATOR = r"[^\p{L}\p{N}_]+"

# Default English stop words (a short common list; callers
# pass their own list for other corpora).
STOP_WORDS = [
    "a", "about", "above", "after", "again", "against", "all", "am", "an", "and", "any", "are", "as", "at",
    "be", "because", "been", "before", "being", "below", "between", "both", "but", "by", "can", "did", "do",
    "does", "doing", "down", "during", "each", "few", "for", "from", "further", "had", "has", "have",
    "having", "he", "her", "here", "hers", "herself", "him", "himself", "his", "how", "i", "if", "in",
    "into", "is", "it", "its", "itself", "just", "me", "more", "most", "my", "myself", "no", "nor", "not",
    "now", "of", "off", "on", "once", "only", "or", "other", "our", "ours", "ourselves", "out", "over",
    "own", "s", "same", "she", "should", "so", "some", "such", "t", "than", "that", "the", "their",
    "theirs", "them", "themselves", "then", "there", "these", "they", "this", "those", "through", "to",
    "too", "under", "until", "up", "very", "was", "we", "were", "what", "when", "where", "which", "while",
    "who", "whom", "why", "will", "with", "you", "your", "yours", "yourself", "yourselves",
]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def simple_tokenize(text) -> Column:
    """Lower-case, split on non-word characters, drop empty tokens."""
    return F.filter(F.split(F.lower(_c(text)), TOKEN_SEPARATOR), lambda t: t != "")


def remove_stop_words(tokens, stop_words=None) -> Column:
    """Drop stop words, keeping duplicates of the other tokens (so not
    ``array_except``, which de-duplicates)."""
    stop = list(STOP_WORDS if stop_words is None else stop_words)      # a hashed set in the plan
    return F.filter(_c(tokens), lambda t: ~t.isin(stop)) if stop else _c(tokens)


def tokenize(text, stop_words=None) -> Column:
    """H10 + H11."""
    return remove_stop_words(simple_tokenize(text), stop_words)


def strip_chars(text, chars: str) -> Column:
    """Delete every character of ``chars``."""
    return F.translate(_c(text), chars, "")


def token_set(tokens) -> Column:
    """Distinct tokens of a row."""
    return F.array_distinct(_c(tokens))


def sql_tokens(text_sql: str, stop_words=None, drop_stop: bool = True) -> str:
    """DuckDB/ANSI twin of ``tokenize`` used by oracle queries."""
    base = f"list_filter(regexp_split_to_array(lower({text_sql}), '{TOKEN_SEPARATOR}'), lambda t: t <> '')"
    if not drop_stop:
        return base
    words = ", ".join(f"'{w}'" for w in (STOP_WORDS if stop_words is None else stop_words))
    return f"list_filter({base}, lambda t: NOT list_contains([{words}], t))"
