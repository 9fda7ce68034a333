"""Text normalisation and tokens, on whole texts, as array expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewlens.functions.measures import as_column

MIN_TEXT_LENGTH = 10
MIN_WORD_LENGTH = 2

def default_stop_words() -> tuple[str, ...]:
    """Spark's English list.

    Its forms with an apostrophe never occur, because normalisation turns an
    apostrophe into a space.
    """
    from pyspark.ml.feature import StopWordsRemover

    return tuple(w for w in StopWordsRemover.loadDefaultStopWords("english") if "'" not in w)


def normalise_text(text: Column | str) -> Column:
    """Lower case; every character that is not a-z or white space becomes a space."""
    return F.regexp_replace(F.lower(as_column(text)), r"[^a-z\s]", " ")


def spaced_text(text: Column | str) -> Column:
    """:func:`normalise_text` with every white space a blank, so the length is the same."""
    return F.regexp_replace(F.lower(as_column(text)), "[^a-z ]", " ")


def stripped_length(text: Column | str) -> Column:
    return F.length(F.regexp_replace(as_column(text), r"^\s+|\s+$", ""))


def is_long_enough(normalised: Column | str, longer_than: int = MIN_TEXT_LENGTH) -> Column:
    return stripped_length(normalised) > longer_than


def words(
    normalised: Column | str, stop_words: Iterable[str] | None = None, spaced: bool = False
) -> Column:
    """Words of two letters or more in text order, without stop words (Spark's English ones).

    With ``spaced`` the text is from :func:`spaced_text`: cut at single blanks, which needs
    no regular expression and leaves empty words that are too short to stay.
    """
    stop = sorted(set(default_stop_words() if stop_words is None else stop_words))

    def keep(word: Column) -> Column:
        long_enough = F.length(word) >= MIN_WORD_LENGTH
        return long_enough & ~word.isin(stop) if stop else long_enough

    return F.filter(F.split(as_column(normalised), " " if spaced else r"\s+"), keep)


def bigrams(tokens: Column | str) -> Column:
    """Neighbouring pairs, formed after stop words are gone."""
    tokens = as_column(tokens)
    pairs = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.zip_with(
        F.slice(tokens, 1, pairs),
        F.slice(tokens, 2, pairs),
        lambda left, right: F.concat_ws(" ", left, right),
    )


def unigrams_and_bigrams(tokens: Column | str) -> Column:
    return F.concat(as_column(tokens), bigrams(tokens))
