"""Text expressions with the whitespace and title-case rules of Python strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python counts as blanks.
_BLANK = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
# ASCII words, one blank apart, without a letter right after a digit or sign.
_WORD = r"(?:[A-Za-z]++[!-@\[-`{-~]*+|[!-@\[-`{-~]++)"
_TIDY = f"^(?:{_WORD}(?: {_WORD})*+)?$"
# Items of ASCII words, one blank apart and without a comma, with one comma and one blank between them.
_ITEM = r"[!-+\--~]++(?: [!-+\--~]++)*+"
_LISTED = f"^(?:{_ITEM}(?:, {_ITEM})*+)?$"
_CASED = r"\p{IsUppercase}\p{IsLowercase}\p{Lt}"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{_BLANK}+|{_BLANK}+$", "")


def collapse_blanks(text: Column) -> Column:
    return F.regexp_replace(text, f"{_BLANK}+", " ")


def normalize_separator(text: Column) -> Column:
    """One comma and one blank between the items of a list in text."""
    return F.regexp_replace(text, f"{_BLANK}*,{_BLANK}*", ", ")


def title_case(text: Column) -> Column:
    """Capitalise every run of letters: ``semi-d 3rd`` becomes ``Semi-D 3Rd``.

    ``initcap`` starts words after blanks only. It is much cheaper and gives the
    same for tidy text (the usual case); everything else is cut into runs.
    """
    runs = F.regexp_extract_all(F.lower(text), F.lit(f"([{_CASED}]+|[^{_CASED}]+)"), F.lit(1))

    def capitalise(run: Column) -> Column:
        # upper() may give several letters (ß gives SS); only the first stays upper.
        head = F.upper(F.substring(run, 1, 1))
        return F.concat(
            F.substring(head, 1, 1),
            F.lower(F.substring(head, 2, 8)),
            F.substring(run, 2, 2**31 - 1),
        )

    return F.when(text.rlike(_TIDY), F.initcap(text)).otherwise(
        F.array_join(F.transform(runs, capitalise), "")
    )


def standardize(text: Column) -> Column:
    """Stripped, title-cased, with single blanks; tidy text needs one test and ``initcap``."""
    raw = text.cast("string")
    # An array of one: the stripped text is computed once for all uses of it.
    stripped = F.transform(F.array(collapse_blanks(strip(raw))), title_case)
    return F.when(raw.rlike(_TIDY), F.initcap(raw)).otherwise(F.get(stripped, F.lit(0)))


def tokens(text: Column) -> Column:
    """Distinct, non-empty items of a comma-separated cell; NULL gives an empty array."""
    # Plain lists (the usual case) need one test. A split at one plain character compiles no pattern for each row.
    commas = F.when(text.rlike(_LISTED), F.replace(text, F.lit(", "), F.lit(","))).otherwise(F.regexp_replace(text, f"{_BLANK}*+,{_BLANK}*+", ","))
    cut = F.split(commas, ",", -1)
    items = F.array_remove(F.array_distinct(cut), "")
    return F.coalesce(items, F.array().cast("array<string>"))


def trimmed_tokens(text: Column) -> Column:
    """Items cut at every comma and trimmed; NULL stays NULL."""
    return F.transform(F.split(text, ",", -1), strip)
