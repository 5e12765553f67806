"""Text repair, votes and tokens as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# They decide results and must stay as they are.
UP_PATTERNS = ["overexp", "express", "transgen", "expos", "tg", "induc"]
DOWN_PATTERNS = [
    "knock", "null", "ko", "s[hi]rna", "delet", "reduc", "\\-\\/", "\\/\\-", "\\+\\/", "\\/\\+", "cre", "flox",
    "mut", "defici",
]
SPECIAL_CHARACTERS = "!#$&'()*+,/:;=?@[]"
GREEK = {"α": "alpha", "β": "beta", "γ": "gamma"}
TIME_PATTERN = r"(?i)[0-9]+\s*(d(ays?)?|h((ours?)|(r|rs)?))"
WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"

# Function words left out of the text features. A parameter everywhere; this is the default.
STOP_WORDS = (
    "about above after again against all also am an and any are as at be because been before being below between "
    "both but by can could did do does doing down during each few for from further had has have having he her here "
    "hers herself him himself his how if in into is it its itself just me more most my myself no nor not now of off "
    "on once only or other our ours ourselves out over own same she should so some such than that the their theirs "
    "them themselves then there these they this those through to too under until up very was we were what when "
    "where which while who whom why will with would you your yours yourself yourselves"
).split()


def greek_to_words(text: Column) -> Column:
    """Greek letters by name, and a single blank in front of each name."""
    for letter, word in GREEK.items():
        text = F.replace(text, F.lit(letter), F.lit(word))
    for word in GREEK.values():
        text = F.regexp_replace(text, rf"(?i)\s*({word})", " $1")
    return text


def assemble(first: Column, *others: Column) -> Column:
    """``first`` and every non-empty other text, separated by a blank."""
    return F.concat_ws(" ", F.coalesce(first, F.lit("")), *[F.nullif(c, F.lit("")) for c in others])


def direction(text: Column, up: list[str] = UP_PATTERNS, down: list[str] = DOWN_PATTERNS) -> Column:
    """``+`` when the up patterns match more often than the down patterns, else ``-``."""

    def votes(patterns: list[str]) -> Column:
        return reduce(lambda a, b: a + b, [F.regexp_count(text, F.lit(f"(?i){p}")) for p in patterns])

    return F.when(votes(up) > votes(down), "+").otherwise("-")


def clean_agent(agent: Column) -> Column:
    """Special characters become blanks and the word Superfamily goes."""
    blanked = F.translate(agent, SPECIAL_CHARACTERS, " " * len(SPECIAL_CHARACTERS))
    return F.replace(blanked, F.lit("Superfamily"), F.lit(""))


def time_value(text: Column) -> Column:
    """The number of the first time token, NULL without one. Units are not converted."""
    token = F.regexp_extract(text, TIME_PATTERN, 0)
    return F.nullif(F.regexp_extract(token, "[0-9]+", 0), F.lit("")).cast("bigint")


def words(text: Column, stop: list[str] = STOP_WORDS) -> Column:
    """Lower-case words of two or more characters that are not stop words, in order."""
    found = F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(0))
    return F.filter(found, lambda w: ~w.isin(stop)) if stop else found


def sample_from_path(path: Column) -> Column:
    """The base name up to the first dot, without a ``_part`` suffix."""
    base = F.regexp_extract(path, r"([^/]*)$", 1)
    return F.regexp_replace(F.split_part(base, F.lit("."), F.lit(1)), "_part.*$", "")


def accession_path(accession: Column) -> Column:
    """Archive folder of a run: six characters, then the digits past six. NULL when invalid."""
    digits = F.regexp_replace(accession, "[^0-9]", "")
    count = F.length(digits)
    head = F.substring(accession, 1, 6)
    tail = F.lpad(F.substr(digits, F.lit(7)), 3, "0")
    return F.when(count <= 6, head).when(count <= 9, F.concat(head, F.lit("/"), tail))


def contains_keyword(columns: list[Column], keyword: str) -> Column:
    """Whether any column holds the keyword, ignoring case; NULL columns never do."""
    hits = [F.coalesce(F.contains(F.lower(c), F.lit(keyword.lower())), F.lit(False)) for c in columns]
    return reduce(lambda a, b: a | b, hits)


def keyword_rule(columns: list[Column], and_keywords: list[str], or_keywords: list[str]) -> Column:
    """Every AND keyword and at least one OR keyword; an empty list asks for nothing."""
    rule = F.lit(True)
    for keyword in and_keywords:
        rule = rule & contains_keyword(columns, keyword)
    if or_keywords:
        rule = rule & reduce(lambda a, b: a | b, [contains_keyword(columns, k) for k in or_keywords])
    return rule
