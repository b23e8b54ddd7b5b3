"""Tokenizers: a text column becomes an array of terms, with native expressions only."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagewright.functions.exprs import blank_if_null

# Token separator, the characters a trim removes, and the length limit.
SEPARATOR = r"[\p{Punct}\s]+"
TRIMMED = "".join(chr(code) for code in range(1, 33))
MAX_TERM_LENGTH = 50

# A short English list. Pass another one (see sources.wordlist) to match an existing index.
STOP_WORDS = list(string.ascii_lowercase) + """
about above after again against all also am an and any are as at be because been before being below
between both but by can cannot could did do does doing down during each few for from further had has
have having he her here hers herself him himself his how if in into is it its itself just me more
most my myself no nor not now of off on once only or other our ours ourselves out over own same she
should so some such than that the their theirs them themselves then there these they this those
through to too under until up very was we were what when where which while who whom why will with
would you your yours yourself yourselves
""".split()


def _non_empty(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: t != "")


def typed_terms(text: Column) -> Column:
    """Pieces between separators as they are written, in order, duplicates kept."""
    return _non_empty(F.split(blank_if_null(text), SEPARATOR))


def raw_terms(text: Column) -> Column:
    """Lower-case pieces between separators, in order, duplicates kept."""
    return _non_empty(F.split(F.lower(blank_if_null(text)), SEPARATOR))


def index_terms(text: Column, stop_words: list[str] | None = STOP_WORDS) -> Column:
    """Index tokenizer: ASCII characters only, no stop words, terms shorter than 50."""
    ascii_only = F.regexp_replace(F.lower(blank_if_null(text)), r"[^\x01-\x7F]+", "")
    tokens = F.split(ascii_only, SEPARATOR)
    trimmed = F.transform(tokens, lambda t: F.btrim(t, F.lit(TRIMMED)))
    left_out = ["", *(stop_words or [])]
    return F.filter(trimmed, lambda t: (F.length(t) < MAX_TERM_LENGTH) & ~t.isin(left_out))


def query_terms(text: Column) -> Column:
    """Query tokenizer: no stop words and no length rule; leading non-alphanumerics are cut."""
    cut = F.transform(raw_terms(text), lambda t: F.regexp_replace(t, "^[^a-z0-9]+", ""))
    return _non_empty(cut)


def legacy_index_terms(text: Column, stop_words: list[str] | None = STOP_WORDS) -> Column:
    """The older index tokenizer: the query tokenizer followed by the stop-word filter."""
    return _without(query_terms(text), stop_words)


def _without(tokens: Column, stop_words: list[str] | None) -> Column:
    return F.filter(tokens, lambda t: ~t.isin(list(stop_words))) if stop_words else tokens
