"""Text expressions: tokens, token predicates, templates and signatures.

A row's tokens are its service and level (each one whole token) and the runs of
ASCII word characters in its message, all lower case. The ``has_*`` predicates
answer questions about that set straight from the three columns, with one regular
expression over the message instead of an array per row, so a scan stays inside
generated code.
"""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters stripped from both ends of a field.
BLANK = "".join(chr(c) for c in range(0x21))

_WORD = re.compile(r"[a-z0-9_]+")


def strip_blank(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANK))


def field_token(field: Column) -> Column:
    """Level or service as its single token."""
    return strip_blank(F.lower(field))


def log_tokens(service: Column, level: Column, message: Column) -> Column:
    """Distinct non-empty tokens of a row."""
    empty = F.lit("")
    tokens = F.concat(
        F.array(
            F.coalesce(field_token(service), empty),
            F.coalesce(field_token(level), empty),
        ),
        message_words(message),
    )
    return F.array_remove(F.array_distinct(tokens), "")


def message_words(message: Column) -> Column:
    """Lower-case words of a message in order; may hold empty strings and repeats."""
    return F.split(F.lower(F.coalesce(message, F.lit(""))), r"\W+")


def _cols():
    return F.col("service"), F.col("level"), F.col("message")


def has_token(word: str) -> Column:
    """Does any token of the row equal ``word``?"""
    if not word:
        return F.lit(False)
    word = word.lower()
    service, level, message = _cols()
    hit = (field_token(service) == word) | (field_token(level) == word)
    if _WORD.fullmatch(word):
        hit = hit | _word_match(message, word, rf"(?<!\w){word}(?!\w)")
    return F.coalesce(hit, F.lit(False))


def has_prefix(prefix: str) -> Column:
    """Does any token of the row start with ``prefix``?"""
    if not prefix:
        return F.lit(False)
    prefix = prefix.lower()
    service, level, message = _cols()
    hit = F.startswith(field_token(service), F.lit(prefix)) | F.startswith(
        field_token(level), F.lit(prefix)
    )
    if _WORD.fullmatch(prefix):
        hit = hit | _word_match(message, prefix, rf"(?<!\w){prefix}")
    return F.coalesce(hit, F.lit(False))


def has_glob(pattern: str) -> Column:
    """Does any whole token match ``pattern``, where ``*`` stands for any characters?"""
    if not pattern:
        return F.lit(False)
    pattern = pattern.lower()
    if "*" not in pattern:
        return has_token(pattern)
    if not pattern.strip("*"):
        return has_any_token()
    head = pattern.rstrip("*")
    if "*" not in head:
        return has_prefix(head)
    service, level, message = _cols()
    hit = _like(field_token(service), pattern) | _like(field_token(level), pattern)
    parts = [p for p in pattern.split("*") if p]
    if all(_WORD.fullmatch(p) for p in parts):
        hit = hit | _word_match(message, max(parts, key=len), _glob_in_message(pattern))
    return F.coalesce(hit, F.lit(False))


def has_any_token() -> Column:
    """Does the row have a token at all?"""
    service, level, message = _cols()
    hit = (field_token(service) != "") | (field_token(level) != "") | F.lower(message).rlike(r"\w")
    return F.coalesce(hit, F.lit(False))


def _word_match(message: Column, literal: str, pattern: str) -> Column:
    """``pattern`` over the message, tried only where its literal part occurs."""
    lowered = F.coalesce(F.lower(message), F.lit(""))
    return F.contains(lowered, F.lit(literal)) & lowered.rlike(pattern)


def _glob_in_message(pattern: str) -> str:
    """Regular expression for a glob that matches one word of a text.

    The pieces between stars are each taken at their first place and not tried
    again, which is enough for globs and keeps the match linear in long words.
    """
    pieces = re.split(r"\*+", pattern)
    first, middle, last = pieces[0], pieces[1:-1], pieces[-1]
    regex = r"(?<!\w)" + first
    for piece in middle:
        regex += rf"(?>\w*?{piece})"
    return regex + (rf"\w*{last}(?!\w)" if last else "")


def _like(token: Column, pattern: str) -> Column:
    """Whole-token glob as LIKE; everything but ``*`` is literal."""
    like = re.sub(r"([\\%_])", r"\\\1", pattern).replace("*", "%")
    return F.like(token, F.lit(like), F.lit("\\"))


def token_matches(token: Column, keyword=None, prefix=None, wildcard=None) -> Column:
    """The same three questions asked of a single token column."""
    if keyword:
        return token == keyword.lower()
    if prefix:
        return F.startswith(token, F.lit(prefix.lower()))
    head, star, rest = wildcard.lower().partition("*")
    if not star:
        return token == head
    if not rest.strip("*"):
        return F.startswith(token, F.lit(head))
    # The literal head lets the file reader skip; LIKE decides.
    return F.startswith(token, F.lit(head)) & _like(token, wildcard.lower())


def contains_text(text: str) -> Column:
    """Substring of the message, ignoring case; tokens play no part."""
    return F.contains(F.lower(F.col("message")), F.lit(text.lower()))


def same_text(field: Column, wanted: str | None) -> Column | None:
    """Equality ignoring case; None or ``ALL`` asks for no filter at all."""
    if wanted is None or wanted.upper() == "ALL":
        return None
    return F.upper(field) == wanted.upper()


def template(message: Column) -> Column:
    """Message with punctuation removed and every word holding a digit masked.

    Three passes over the text: white space to single blanks, punctuation out, words
    with a digit to ``<*>``. The last one is skipped where there is no digit; the
    look-behind and the possessive quantifiers keep it linear in long words.
    """
    text = F.regexp_replace(F.coalesce(message, F.lit("")), r"\s+", " ")
    text = F.regexp_replace(text, r"[^\p{Alnum} ]++", "")
    masked = F.regexp_replace(text, r"(?<!\w)[a-zA-Z]*+[0-9]\w*+", "<*>")
    return F.trim(F.when(text.rlike("[0-9]"), masked).otherwise(text))


def signature(service: Column, message: Column) -> Column:
    """What counts as one error: service and message."""
    return F.concat(
        F.coalesce(service, F.lit("")), F.lit(": "), F.coalesce(message, F.lit(""))
    )
