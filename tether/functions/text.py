"""Normalisation and key functions, each from Column to Column; null counts as empty unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that mark organisations, name suffixes, credentials and unit designators of streets.
ORGANISATION_WORDS = (
    "LLC INC LTD CORP CORPORATION COMPANY CO GROUP ASSOCIATES ASSOC HOSPITAL HEALTH HEALTHCARE CLINIC CENTER CENTRE "
    "MEDICAL MED SYSTEM FOUNDATION UNIVERSITY DEPARTMENT DEPT PRACTICE INSTITUTE LAB LABS"
).split()
SUFFIX_WORDS = "JR SR II III IV V".split()
CREDENTIAL_WORDS = "MD DO DDS DMD NP PA RN PHD MBA MS MPH DPM OD".split()
UNIT_WORDS = "STE SUITE UNIT APT FL FLOOR BLDG BUILDING ROOM RM".split()
# Soundex codes of the letters; all other characters are uncoded.
SOUNDEX_CODES = {"BFPV": "1", "CGJKQSXZ": "2", "DT": "3", "L": "4", "MN": "5", "R": "6"}

_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 "
_SPACES = r"(?U)[\s\x1C-\x1F]+"
_ENDS = r"(?U)^[\s\x1C-\x1F]+|[\s\x1C-\x1F]+$"


def strip(c: Column) -> Column:
    """c without white space, of any script, at its ends."""
    return F.regexp_replace(c, _ENDS, "")


def normalize_text(c: Column) -> Column:
    """Upper case, ends stripped, white space to single blanks, then only A-Z, 0-9 and blanks. Null stays null.

    Blanks around dropped characters stay, so the function is not idempotent.
    """
    return F.regexp_replace(F.regexp_replace(strip(F.upper(c)), _SPACES, " "), "[^A-Z0-9 ]", "")


def norm(c: Column) -> Column:
    """normalize_text with null as empty text."""
    return F.coalesce(normalize_text(c), F.lit(""))


def normalize_zip(c: Column) -> Column:
    """The first five digits in a row, or null."""
    return F.nullif(F.regexp_extract(c, r"(\d{5})", 1), F.lit(""))


def normalize_npi(c: Column) -> Column:
    """The first ten digits in a row, or null."""
    return F.nullif(F.regexp_extract(c, r"(\d{10})", 1), F.lit(""))


def tokens_word(c: Column) -> Column:
    return F.array_remove(F.split(norm(c), " "), "")


def tokens_set(c: Column) -> Column:
    return F.array_distinct(tokens_word(c))


def block_tokens(c: Column) -> Column:
    """Distinct tokens for candidate generation: split on white space, letters and digits of any script kept."""
    parts = F.split(strip(F.upper(F.coalesce(c, F.lit("")))), _SPACES)
    return F.array_distinct(F.array_remove(F.transform(parts, lambda x: F.regexp_replace(x, r"[^\p{L}\p{N}]", "")), ""))


def char_ngrams(c: Column, n: int = 3) -> Column:
    """All runs of n characters of the normalised text without blanks; shorter texts are one gram, empty ones none."""
    text = F.replace(norm(c), F.lit(" "), F.lit(""))
    size = F.length(text)
    grams = F.transform(F.sequence(F.lit(1), F.greatest(size - (n - 1), F.lit(1))), lambda i: F.substring(text, i, F.lit(n)))
    return F.when(size == 0, F.array().cast("array<string>")).otherwise(grams)


def street_simplify(c: Column) -> Column:
    """The normalised street without unit designators."""
    bare = F.regexp_replace(norm(c), rf"\b({'|'.join(UNIT_WORDS)})\b", "")
    return strip(F.regexp_replace(bare, r"\s+", " "))


def first_initial(c: Column) -> Column:
    """First character of the upper-case text if it is a letter A-Z, else empty."""
    return F.regexp_replace(F.substring(F.upper(F.coalesce(c, F.lit(""))), 1, 1), "[^A-Z]", "")


def last_key(c: Column, size: int = 6) -> Column:
    """The first characters of the upper-case text with white space collapsed."""
    return F.substring(strip(F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), _SPACES, " ")), 1, size)


def block_key(*cs: Column) -> Column:
    """Parts joined by a bar, null as empty."""
    return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in cs])


def norm_initial(c: Column) -> Column:
    """First character of the normalised text, digits included."""
    return F.substring(norm(c), 1, 1)


def norm_key(c: Column, size: int = 6) -> Column:
    """The first characters of the normalised text."""
    return F.substring(norm(c), 1, size)


def norm_block_key(*cs: Column) -> Column:
    """Normalised parts joined by a bar."""
    return F.concat_ws("|", *[norm(c) for c in cs])


def zip3(c: Column) -> Column:
    """The first three characters of the normalised text, or empty."""
    return F.when(F.length(norm(c)) >= 3, F.substring(norm(c), 1, 3)).otherwise(F.lit(""))


def soundex(c: Column) -> Column:
    """Phonetic code in which every uncoded letter, H and W too, separates equal codes."""
    code = {letter: digit for letters, digit in SOUNDEX_CODES.items() for letter in letters}
    x = norm(c)
    codes = F.translate(x, _ALPHABET, "".join(code.get(a, "0") for a in _ALPHABET))
    runs = F.substring(F.regexp_replace(codes, r"(.)\1+", "$1"), 2, 1 << 20)
    out = F.rpad(F.replace(F.concat(F.substring(x, 1, 1), runs), F.lit("0"), F.lit("")), 4, "0")
    return F.when(x == "", F.lit("")).otherwise(out)


def _words(ws: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in ws])


def is_org_like(c: Column) -> Column:
    """1 if a token marks an organisation."""
    return F.arrays_overlap(tokens_set(c), _words(ORGANISATION_WORDS)).cast("int")


def suffix_token(c: Column) -> Column:
    """The last token that is a name suffix, or empty."""
    found = F.filter(tokens_word(c), lambda x: x.isin(SUFFIX_WORDS))
    return F.coalesce(F.try_element_at(found, F.lit(-1)), F.lit(""))


def credential_tokens(c: Column) -> Column:
    """Distinct tokens that are known credentials."""
    return F.array_intersect(tokens_set(c), _words(CREDENTIAL_WORDS))
