"""Text cleaning."""

from __future__ import annotations

# Cell texts that the raw feeds' reader takes as missing.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# A letter starts a word when the character before it has no case.
_UNCASED = r"([^\\p{IsLowercase}\\p{IsUppercase}\\p{Lt}])"
_MARK = r"\u0001 "


def literal(text: str) -> str:
    """SQL text of a string value."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def title_case(c: str) -> str:
    """Upper-case the first letter of every run of cased letters.

    ``initcap`` alone only breaks words at blanks, so a marker plus a blank is
    put after every uncased character and taken out again afterwards.
    """
    spaced = f"regexp_replace(lower({c}), '{_UNCASED}', '$1{_MARK}')"
    return f"replace(initcap({spaced}), '{_MARK}', '')"


def capitalize(c: str) -> str:
    """First character upper case, the rest lower case."""
    return f"concat(upper(substr({c}, 1, 1)), lower(substr({c}, 2)))"


def underscores_to_spaces(c: str) -> str:
    return f"translate({c}, '_', ' ')"


def blank_missing(c: str) -> str:
    """NULL for the texts that stand for a missing cell."""
    tokens = ", ".join(literal(t) for t in MISSING_TOKENS)
    return f"CASE WHEN {c} NOT IN ({tokens}) THEN {c} END"
