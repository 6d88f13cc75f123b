"""STR-1 and STR-2: the holiday description parser and the ASCII key, as column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Prefixes of Spanish holiday descriptions, by holiday type.
PREFIXES = {
    "Transfer": r"(?i)^traslado\s+",
    "Bridge": r"(?i)^puente\s+",
    "Work Day": r"(?i)^recupero\s+puente\s+",
}

# Role names of the known holiday types.
ROLES = {
    "Holiday": "holiday",
    "Transfer": "transfer",
    "Bridge": "bridge",
    "Work Day": "work_day",
    "Additional": "additional",
    "Event": "event",
}

# A description that ends in a signed day offset.
OFFSET_SUFFIX = r"([+-][0-9]+)$"

# The white space characters of Unicode.
WHITE_SPACE = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + (
    "\u2028\u2029\u202f\u205f\u3000"
)

#: Latin letters without a canonical decomposition: one ASCII letter, or several.
SINGLE_LETTERS = {"ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "ł": "l", "Ł": "L", "ħ": "h", "ı": "i"}
LETTER_PAIRS = {"ß": "ss", "æ": "ae", "œ": "oe", "þ": "th"}


def _accented_letters() -> tuple[str, str]:
    """Accented Latin letters and their base letters, from the Unicode decompositions of the Latin blocks."""
    accented, base = [], []
    for code in [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)]:
        letter = chr(code)
        plain = "".join(c for c in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(c))
        if len(plain) == 1 and plain.isascii() and plain != letter:
            accented.append(letter)
            base.append(plain)
    accented += SINGLE_LETTERS.keys()
    base += SINGLE_LETTERS.values()
    return "".join(accented), "".join(base)


_ACCENTED, _BASE = _accented_letters()


def strip(text: Column) -> Column:
    """Trim white space of any kind, not only blanks."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def ascii_key(text: Column) -> Column:
    """STR-2: Latin accents off, lower case, trimmed, inner white space collapsed to one blank."""
    plain = F.lower(F.translate(F.regexp_replace(text, r"\p{M}", ""), _ACCENTED, _BASE))
    for letter, letters in LETTER_PAIRS.items():
        plain = F.replace(plain, F.lit(letter), F.lit(letters))
    return strip(F.regexp_replace(plain, f"[{WHITE_SPACE}]+", " "))


def parse_descriptions(df: DataFrame, type_col: str = "type", description: str = "description") -> DataFrame:
    """STR-1 and STR-2: add ``role, anchor_label, offset_days, anchor_key`` to a holiday table.

    The steps are columns of their own, so that every pattern runs once per row.
    """
    kind = F.col(type_col)
    text, suffix = F.col("_text"), F.col("_suffix")
    with_offset = kind.isin("Holiday", "Additional", "Event") & (suffix != "")

    role = F.when((kind == "Holiday") & (suffix != ""), "additional")
    for holiday_type, name in ROLES.items():
        role = role.when(kind == holiday_type, name)
    role = role.otherwise(F.coalesce(F.replace(F.lower(kind), F.lit(" "), F.lit("_")), F.lit("other")))

    anchor = F.when(with_offset, strip(F.left(text, F.char_length(text) - F.char_length(suffix))))
    for holiday_type, prefix in PREFIXES.items():
        anchor = anchor.when(kind == holiday_type, strip(F.regexp_replace(text, prefix, "")))

    return (
        df.withColumn("_text", strip(F.coalesce(F.col(description), F.lit(""))))
        .withColumn("_suffix", F.regexp_extract(text, OFFSET_SUFFIX, 1))
        .withColumns(
            {
                "role": role,
                "anchor_label": anchor.otherwise(text),
                "offset_days": F.when(with_offset, suffix.try_cast("int")).otherwise(F.lit(0)),
            }
        )
        .withColumn("anchor_key", ascii_key(F.col("anchor_label")))
        .drop("_text", "_suffix")
    )
