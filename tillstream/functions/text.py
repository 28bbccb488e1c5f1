"""Keyword matching on whole words, any language.

A word is a run of letters, digits and underscores. Scripts written without blanks have no whole words: a
keyword in one is found wherever its characters stand side by side.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, SparkSession, functions as F

# Scripts written without blanks between words.
SCRIPTS = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
# ASCII first: the script of a character is looked up for others only.
_WORD_CHAR = rf"[a-zA-Z0-9_[\p{{L}}\p{{N}}&&[^{SCRIPTS}]]]"
_UNSPACED_CHAR = rf"[\x{{80}}-\x{{10FFFF}}&&[{SCRIPTS}]]"
_RUN = rf"{_WORD_CHAR}+|{_UNSPACED_CHAR}+"
_UNSPACED = re.compile(
    "^[฀-໿က-႟ក-៿々〇぀-ヿㇰ-ㇿ㐀-䶿"
    "一-鿿豈-﫿ｦ-ﾟ\U00020000-\U0003ffff]+$"
)


def _pattern(words: str) -> str:
    """Any of the words as group 1. The first letter is looked at before the word boundary, which
    is the dearer test and would otherwise be made at every character."""
    parts = words.split()
    letters = "".join(sorted({re.escape(w[0]) for w in parts}))
    alternatives = "|".join(
        re.escape(w) if _UNSPACED.match(w) else rf"(?<!{_WORD_CHAR}){re.escape(w)}(?!{_WORD_CHAR})"
        for w in parts
    )
    return rf"(?iu)(?=[{letters}])({alternatives})"


def matches_any_word(text: Column, words: str) -> Column:
    """True when any of the blank-separated `words` occurs as a whole word, ignoring case."""
    return text.rlike(_pattern(words))


def highlight(text: Column, words: str, before: str = "<em>", after: str = "</em>") -> Column:
    """Wrap each whole-word occurrence of any of `words`."""
    return F.regexp_replace(text, _pattern(words), f"{before}$1{after}")


def runs(text: Column) -> Column:
    """Lower-case runs of word characters, cut where a script without blanks begins or ends."""
    return F.regexp_extract_all(F.lower(text), F.lit(_RUN), F.lit(0))


def run_terms(run: Column) -> Column:
    """Terms of a run: itself, or of a script without blanks every two characters that stand side by
    side, the last one alone."""
    pairs = F.transform(F.sequence(F.lit(1), F.length(run)), lambda i: F.substring(run, i, F.lit(2)))
    unspaced = (F.ascii(run) > 127) & run.rlike(rf"^{_UNSPACED_CHAR}")
    return F.when(unspaced, pairs).otherwise(F.array(run))


def query_terms(spark: SparkSession, word: str) -> list[list[str]]:
    """Terms of each run of a word, found as those of the texts are."""
    found = spark.range(1).select(F.transform(runs(F.lit(word)), run_terms)).first()[0]
    # A longer run is known by its pairs; the last character alone says no more.
    return [terms[:-1] if len(terms) > 1 else terms for terms in found]
