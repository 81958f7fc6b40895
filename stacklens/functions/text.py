"""Tokens and n-grams as column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import cache
from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F

# Two or more letters, digits or underscores of any script, as long a run as possible.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


@cache
def load_stop_words(path: str | None = None) -> tuple[str, ...]:
    """Stop words from a text file, one per line; ``#`` starts a comment."""
    file = Path(path) if path else Path(__file__).with_name("stop_words_english.txt")
    lines = (line.strip() for line in file.read_text(encoding="utf-8").splitlines())
    return tuple(line for line in lines if line and not line.startswith("#"))


def tokens(text: Column, stop_words: Iterable[str] | None = None) -> Column:
    """Lower-cased tokens of the whole text in order, without stop words."""
    words = load_stop_words() if stop_words is None else tuple(stop_words)
    found = F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))
    return F.filter(found, lambda t: ~t.isin(*words)) if words else found


def bound_once(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ngrams(words: Column, ngram_range: Sequence[int] = (1, 2)) -> Column:
    """All n-grams of the token array for n in the closed range."""
    low, high = ngram_range

    def build(tokens_once: Column) -> Column:
        grams, found = tokens_once, []
        for n in range(1, high + 1):
            if n > 1:
                # Each (n-1)-gram but the last meets the token that follows it.
                count = F.greatest(F.size(tokens_once) - (n - 1), F.lit(0))
                grams = F.zip_with(
                    F.slice(grams, 1, count), F.slice(tokens_once, n, count), lambda a, b: F.concat(a, F.lit(" "), b)
                )
            if n >= low:
                found.append(grams)
        return F.concat(*found)

    return bound_once(words, build)
