"""Default review scorer: a word-list score over the whole text.

The source calls an external language model; here the scorer is a pluggable
``Column -> Column`` and the default is a lexicon score in [-1, 1] computed
with built-in expressions (tokenise, filter, count), so it stays in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The default lexicon (own choice; the source names no list).
POSITIVE_WORDS = ["good", "great", "excellent", "amazing", "delicious", "fresh", "friendly", "love",
                  "loved", "best", "perfect", "tasty", "fast", "happy", "nice", "wonderful", "fantastic",
                  "hot", "recommend", "clean"]
NEGATIVE_WORDS = ["bad", "terrible", "awful", "cold", "slow", "rude", "worst", "horrible", "disappointing",
                  "disappointed", "late", "wrong", "stale", "dirty", "poor", "burnt", "soggy", "never",
                  "hate", "missing"]
TOKEN_SPLIT = "[^a-z]+"


def tokens(text: Column) -> Column:
    return F.split(F.lower(text), TOKEN_SPLIT)


def lexicon_score(text: Column) -> Column:
    """(positive - negative) / (positive + negative) word hits; 0 with no hits."""
    toks = tokens(text)
    pos = F.size(F.filter(toks, lambda w: w.isin(*POSITIVE_WORDS)))
    neg = F.size(F.filter(toks, lambda w: w.isin(*NEGATIVE_WORDS)))
    return F.when(pos + neg > 0, (pos - neg).cast("double") / (pos + neg).cast("double")).otherwise(F.lit(0.0))
