"""Text clean-up used for link keys and table columns."""

from __future__ import annotations

# Every character that counts as white space at either end of a text
# (Unicode white space plus the four ASCII separators U+001C to U+001F).
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(e: str) -> str:
    """Remove white space of any kind from both ends."""
    return f"btrim({e}, '{WHITE_SPACE}')"


def text(e: str) -> str:
    """Null becomes the empty text."""
    return f"coalesce({e}, '')"


def filled(e: str) -> str:
    """True for a text that is neither null nor empty; never null."""
    return f"({text(e)} <> '')"


def normalize_key(e: str) -> str:
    """Link key of a full name or an address: stripped, lower case, '' for null."""
    return f"lower({strip(text(e))})"


def build_fullname(name: str, last_name: str) -> str:
    """Name and last name with one blank between; inner blanks stay."""
    return f"concat({text(name)}, ' ', {text(last_name)})"


def clean_street(e: str) -> str:
    """Line breaks become blanks, then the ends are stripped."""
    return strip(f"translate({text(e)}, '\n\r', '  ')")
