"""Typed tokens: dates, times, percentages, numbers, words, blanks, the rest."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The token classes in order of precedence.
CLASSES = ("DATE", "TIME", "PERCENT", "NUMBER", "WORD", "SPACE", "OTHER")

# The shapes the classes accept.
_MONTH = (
    "(?:January|March|April|May|June|July|August|September|October|November|December"
    "|Jan|Mar|Apr|Jun|Jul|Aug|Sep|Oct|Nov|Dec)"
)
_DAY = r"(?:[0-9]|[1-2][0-9]|3[0-1])"
_FEB = "(?:Feb|February)"
_FEB_DAY = r"(?:[0-9]|1[0-9]|2[0-8])"
DATE = "|".join(
    [
        rf"\b{_MONTH}\s{_DAY},\s\d{{4}}\b",
        rf"\b{_DAY}\s{_MONTH}\s\d{{4}}\b",
        rf"\b{_FEB}{_FEB_DAY}\s,\s\d{{4}}\b",
        rf"\b{_FEB_DAY}\s{_FEB}\s\d{{4}}\b",
    ]
)
TIME = "|".join(
    [
        r"\b(?:[0-9]|1[0-2])\.[0-5][0-9](?:PM|AM)\b",
        r"\b(?:[0-9]|1[0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]\b",
        r"\b(?:0[0-9]|1[0-2])[0-5][0-9](?:a|p)\.m\.",
    ]
)
_PERCENT = r"(?<=\s)\b[0-9]+\b%(?=\s|.|\n|!)"
_DIGITS = r"(?:\+|-)?\b[0-9]+(?:\.\d{3}|,\d{3}|[0-9])*(?:\.\d+)?\b(?!%|percent)(?!,\w|\.\w|[A-Z])"
_NUMBER = rf"^{_DIGITS}|(?<=\s|\(){_DIGITS}"
# The possessive quantifiers cannot change a match: what follows them is no letter, and no boundary lies between letters.
_LETTERS = r"\b(?:[a-z]++-[a-z]+)*[a-z]++(?:'[a-z]++)?\b"
_WORD = rf"^{_LETTERS}|(?<=\s){_LETTERS}'?|(?<=\s)\b[a-z]+\b'"

# (?i) ignore case, (?m) line anchors, (?d) only \n ends a line, (?U) Unicode classes.
# Groups: number, word, blanks, the rest. No other class begins with a blank, so blanks may come first, and
# dates and times are tried only where a letter of theirs or a digit is: both spare the matcher most of its work.
_ANY = rf"(?imdU)(\s+)|((?=[jfmasond0-9])(?:{DATE}|{TIME})|{_PERCENT})|({_NUMBER})|({_WORD})|(.)"

# Control characters between the groups of a match and behind it; texts that hold them are read group by group.
_NEXT, _END = "\x01", "\x02"
_MARKED = _NEXT.join(["$3", "$4", "$1", "$2$5"]) + _END


def extract_dates(text: Column) -> Column:
    """All date strings of a text."""
    return F.regexp_extract_all(text, F.lit(f"(?imdU)(?:{DATE})"), F.lit(0))


def extract_times(text: Column) -> Column:
    """All time-of-day strings of a text."""
    return F.regexp_extract_all(text, F.lit(f"(?imdU)(?:{TIME})"), F.lit(0))


def typed_tokens(text: Column) -> Column:
    """``array<struct<token, cls>>`` covering the text from start to end.

    One pass marks the group of every match: a number has no mark ahead, a word
    one, blanks two, the rest three. Only numbers, words and blanks need to be told apart by group: a lone digit
    or letter may also be OTHER, depending on what stands before it. The other
    classes follow from the look of the token. Only texts that hold a mark take a pass per group.
    """
    marked = F.split(F.regexp_replace(text, F.lit(_ANY), F.lit(_MARKED)), _END, -1)
    one_pass = F.transform(F.slice(marked, F.lit(1), F.size(marked) - 1), _of_marked)
    number, word, blank = (F.regexp_extract_all(text, F.lit(_ANY), F.lit(g)) for g in (3, 4, 1))
    found = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(_ANY), F.lit(0)).alias("token"), number.alias("number"), word.alias("word"), blank.alias("blank")
    )
    by_group = F.transform(found, _of_groups)
    return F.when(F.contains(text, F.lit(_NEXT)) | F.contains(text, F.lit(_END)), by_group).otherwise(one_pass)


def class_counts(found: Column) -> list[Column]:
    """One column per class: how many typed tokens are of it."""
    # The first letters of all classes differ; in a text of them a class is counted without a look at every token.
    letters = F.array_join(F.transform(found, lambda t: F.substring(t["cls"], 1, 1)), "")
    return [_count_of(letters, name).alias(name) for name in CLASSES]


def _count_of(letters: Column, name: str) -> Column:
    others = F.replace(letters, F.lit(name[0]), F.lit(""))
    return (F.length(letters) - F.length(others)).cast("bigint")


def _of_marked(match: Column) -> Column:
    token = F.replace(match, F.lit(_NEXT), F.lit(""))
    return _typed(token, ~match.startswith(_NEXT), ~match.startswith(_NEXT * 2), ~match.startswith(_NEXT * 3))


def _of_groups(match: Column) -> Column:
    return _typed(match["token"], match["number"] != "", match["word"] != "", match["blank"] != "")


def _typed(token: Column, number: Column, word: Column, blank: Column) -> Column:
    cls = (
        F.when(number, "NUMBER")
        .when(word, "WORD")
        .when(blank, "SPACE")
        .when(F.length(token) == 1, "OTHER")
        .when(token.endswith("%"), "PERCENT")
        .when(token.rlike(r"(?U)\s"), "DATE")
        .otherwise("TIME")
    )
    return F.struct(token.alias("token"), cls.alias("cls"))
