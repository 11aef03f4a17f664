"""Text clean-up as native columns. ``(?U)`` makes Java's character classes Unicode-aware."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from faultline.fixed_values import DESCRIPTION_NOISE, LEGAL_WORDS, OUTCOME_CODES, RECALL_CLASS

_BLANK = r"(?U)[\s\x1c-\x1f]+"
_BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))


def strip(text: Column) -> Column:
    """Remove leading and trailing white space of any kind, not only spaces."""
    return F.btrim(text, F.lit(_BLANKS))


def squeeze(text: Column) -> Column:
    """Runs of white space become one space; none at the ends."""
    return F.trim(F.regexp_replace(text, _BLANK, " "))


def blank_to_null(text: Column) -> Column:
    return F.when(F.length(text) > 0, text)


def company_key(name: Column) -> Column:
    """Upper-case company name without punctuation and legal-form words; null gives ''.

    Whatever is not an ASCII letter or digit ends up as one space, so words are separated by single
    spaces and a single pass over the legal words already reaches the fixpoint.
    """
    words = F.regexp_replace(F.upper(F.coalesce(name, F.lit(""))), "[^A-Z0-9]+", " ")
    core = F.regexp_replace(words, r"\b(?:" + "|".join(LEGAL_WORDS) + r")\b", " ")
    return F.trim(F.regexp_replace(core, " +", " "))


def applicant_key(name: Column) -> Column:
    """``company_key``, but a missing or empty name stays null."""
    return F.when(F.length(name) > 0, company_key(name))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` refers to it."""
    return F.transform(F.array(value), use)[0]


def denoise_description(text: Column) -> Column:
    """Description without codes, lot and part numbers, dimensions and versions; null gives ''."""
    out = F.coalesce(text, F.lit(""))
    for pattern, ignore_case in DESCRIPTION_NOISE:
        out = F.regexp_replace(out, ("(?iuU)" if ignore_case else "(?U)") + pattern, " ")
    return squeeze(out)


def outcome_code(text: Column) -> Column:
    """One-letter outcome code of a code or a full-text outcome; unknown text is only stripped."""
    bare = strip(text)
    known = F.create_map(*[F.lit(x) for pair in OUTCOME_CODES.items() for x in pair])
    return F.when(F.length(bare) <= 1, F.upper(bare)).otherwise(
        F.coalesce(F.try_element_at(known, F.lower(bare)), bare)
    )


def recall_class(text: Column) -> Column:
    """I, II or III out of classification text, else null. "Class IV" gives I: the pattern has no end."""
    return blank_to_null(F.regexp_extract(text, "(?U)" + RECALL_CLASS, 1))


def without_trailing_dashes(code: Column) -> Column:
    return F.regexp_replace(code, "-+$", "")


def is_junk_code(code: Column) -> Column:
    """True for codes of dashes only; false for null."""
    return F.coalesce(code.rlike("^-+$"), F.lit(False))


def label_or_unknown(text: Column) -> Column:
    return F.coalesce(blank_to_null(strip(text)), F.lit("Unknown"))


def yes_no(flag: Column) -> Column:
    """Y and N as a boolean, anything else null."""
    return F.when(flag == "Y", True).when(flag == "N", False)
