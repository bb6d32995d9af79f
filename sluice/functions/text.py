"""Text columns: strip, defaults, chat templates, estimates and predicates."""

from pyspark.sql import Column, functions as F

# The 29 code points that Python's str.strip removes.
WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u001c\u001d\u001e\u001f\u0020"
    "\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Chat markers and the limits the corpora are defined by.
TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>"
MIN_CHARACTERS = 50
PREVIEW_CHARACTERS = 1000
CHARACTERS_PER_TOKEN = 4


def strip(text: Column) -> Column:
    """Remove Unicode whitespace at both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def chat(user: Column, assistant: Column, separator: str = "\n") -> Column:
    """One user turn and one assistant turn between markers, without an end-of-text token.

    Both columns must be non-null (see ``or_empty``).
    """
    return F.concat(
        F.lit(f"{TURN_START}user{separator}"),
        user,
        F.lit(f"{separator}{TURN_END}{separator}{TURN_START}assistant{separator}"),
        assistant,
        F.lit(f"{separator}{TURN_END}"),
    )


def estimated_tokens(text: Column) -> Column:
    """A quarter of the characters, at least 1."""
    return F.greatest(F.lit(1).cast("long"), F.floor(F.length(text) / CHARACTERS_PER_TOKEN))


def preview(text: Column, characters: int = PREVIEW_CHARACTERS) -> Column:
    return F.substring(text, 1, characters)


def non_empty(*texts: Column) -> Column:
    """Every text present and not empty, as it stands (blanks count as content)."""
    kept = F.lit(True)
    for text in texts:
        kept = kept & (text != "")
    return kept


def non_blank(text: Column) -> Column:
    """Something is left of the text after stripping; trimming one end tells, and ends at the first letter."""
    return F.ltrim(text, F.lit(WHITESPACE)) != ""


def long_enough(text: Column, characters: int = MIN_CHARACTERS) -> Column:
    return F.length(text) >= characters


def language_is(language: Column, code: str = "en") -> Column:
    """The language equals ``code``; rows without a language pass."""
    return language.isNull() | (language == code)
