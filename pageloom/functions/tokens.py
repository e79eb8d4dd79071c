"""Tokens, stop words, bigrams and terms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token separators and the shortest token kept.
LETTERS_ONLY = r"[^a-z]+"
WORDS = r"\W+"
UNICODE_LETTERS = r"[^\p{L}]+"
MIN_TOKEN_LENGTH = 3

# Spark's default English stop words.
ENGLISH_STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours", "yourself", "yourselves",
    "he", "him", "his", "himself", "she", "her", "hers", "herself", "it", "its", "itself", "they", "them", "their",
    "theirs", "themselves", "what", "which", "who", "whom", "this", "that", "these", "those", "am", "is", "are",
    "was", "were", "be", "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by", "for", "with", "about",
    "against", "between", "into", "through", "during", "before", "after", "above", "below", "to", "from", "up",
    "down", "in", "out", "on", "off", "over", "under", "again", "further", "then", "once", "here", "there", "when",
    "where", "why", "how", "all", "any", "both", "each", "few", "more", "most", "other", "some", "such", "no",
    "nor", "not", "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don",
    "should", "now", "i'll", "you'll", "he'll", "she'll", "we'll", "they'll", "i'd", "you'd", "he'd", "she'd",
    "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's", "we're", "they're", "i've", "we've", "you've",
    "they've", "isn't", "aren't", "wasn't", "weren't", "haven't", "hasn't", "hadn't", "don't", "doesn't", "didn't",
    "won't", "wouldn't", "shan't", "shouldn't", "mustn't", "can't", "couldn't", "cannot", "could", "here's",
    "how's", "let's", "ought", "that's", "there's", "what's", "when's", "where's", "who's", "why's", "would",
]

# Words too common in page corpora to tell topics apart.
CORPUS_STOP_WORDS = [
    "align", "style", "rowspan", "colspan", "nbsp", "bgcolor", "scope", "width", "height", "valign", "class", "px",
    "left", "right", "center", "reflist", "cite", "references", "defaultsort", "image", "thumb", "file", "category",
    "www", "http", "https", "com", "org", "html", "htm", "url", "born", "died", "list", "refer", "stub",
    "alignbars", "gridcolor", "lightgrey", "background", "color", "solid", "text", "near", "start", "end", "till", "bar",
    "also", "may", "used", "new", "one", "two", "first",
    "american", "state", "states", "united", "population", "census", "time", "year", "years",
    "world", "total", "swiss", "apartments", "living", "area", "family", "film", "school", "national", "university",
]


def english_stop_words() -> list[str]:
    return list(ENGLISH_STOP_WORDS)


def extended_stop_words() -> list[str]:
    """English plus corpus words: lower case, each once, sorted."""
    return sorted(set(map(str.lower, english_stop_words() + CORPUS_STOP_WORDS)) - {""})


def tokens(text: Column, separator: str = LETTERS_ONLY, min_length: int = MIN_TOKEN_LENGTH) -> Column:
    return F.filter(F.split(F.lower(text), separator), lambda token: F.length(token) >= min_length)


def without_stop_words(token_array: Column, stop_words: list[str]) -> Column:
    """Drop stop words; what remains keeps its order and its repeats."""
    return F.filter(token_array, lambda token: ~token.isin(stop_words))


def bigrams(token_array: Column) -> Column:
    """Neighbouring tokens joined by a blank. The last token has no partner and pairs to null."""
    shifted = F.slice(token_array, F.lit(2), F.greatest(F.size(token_array), F.lit(0)))
    pairs = F.zip_with(token_array, shifted, lambda first, second: F.concat(first, F.lit(" "), second))
    return F.filter(pairs, F.isnotnull)
