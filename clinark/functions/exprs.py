"""Column expressions (built-in Spark functions only, so they stay in codegen).

Spark 4 runs with ANSI mode on: out-of-range array indexes and bad casts raise.
Every positional access therefore uses ``get`` and every text→number/date
conversion a ``try_`` variant, which give NULL as the raw data requires.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Age-group boundaries (birth years) and labels, in order.
AGE_GROUP_BOUNDS = ((2000, "0-25"), (1975, "26-50"), (1950, "51-75"))
AGE_GROUP_ELSE = "75+"

# Display rank of age-group labels on the age report; any other
# label ranks after them.
AGE_RANK = (("0-18", 1), ("19-25", 2), ("26-50", 3), ("51-75", 4), ("75+", 5))
AGE_RANK_ELSE = 6

# Condition-type label from the trailing parenthesised word. Trailing
# blanks are those Python's str.strip() removes: Unicode white space and U+001C-U+001F.
CONDITION_TYPE_PATTERN = r"(?U)\(([^)]+)\)[\s\x1c-\x1f]*$"
CONDITION_TYPE_UNKNOWN = "unknown"
CONDITION_TYPE_OTHER = "other"

# Reference prefixes stripped from medication requests.
PATIENT_PREFIX = "Patient/"
ENCOUNTER_PREFIX = "Encounter/"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first(arr: Column | str) -> Column:
    """First element of an array; NULL for an empty or NULL array (never raises)."""
    return F.get(col(arr), 0)


def patient_key(raw_id: Column | str) -> Column:
    """Anonymised patient key: SHA-256 hex of the id (NULL stays NULL)."""
    return F.sha2(col(raw_id), 256)


def id_of_ref(reference: Column | str) -> Column:
    """The id of a ``Type/id`` reference: the part after the first ``/``.

    A reference without ``/`` (e.g. ``urn:uuid:…``) gives NULL.
    """
    ref = col(reference)
    return F.when(F.contains(ref, F.lit("/")), F.substring_index(F.substring_index(ref, "/", 2), "/", -1))


def patient_key_from_ref(reference: Column | str) -> Column:
    """Key from a ``Type/id`` reference: hash of its id (see ``id_of_ref``)."""
    return patient_key(id_of_ref(reference))


def packed_key(key: Column | str) -> Column:
    """A patient key as bytes, for shuffles: 32 for a SHA-256 in hex, else the text after a mark of one byte (two where
    that would give 32). Different keys have different bytes; NULL stays NULL."""
    k = col(key)
    text = F.encode(k, "UTF-8")
    mark = F.when(F.octet_length(text) == 31, F.lit(b"\x01\x00")).otherwise(F.lit(b"\x00"))
    packed = F.when((F.octet_length(k) == 64) & (F.lower(k) == k), F.unhex(k))       # NULL if it is no hex
    return F.coalesce(packed, F.concat(mark, text))


def unpacked_key(packed: Column | str) -> Column:
    """The key that ``packed_key`` gave the bytes of."""
    p = col(packed)
    skip = F.when(F.octet_length(p) == 33, F.when(F.substring(p, 1, 1) == F.lit(b"\x01"), 3).otherwise(2)).otherwise(2)
    return F.when(F.octet_length(p) == 32, F.lower(F.hex(p))).otherwise(
        F.decode(p.substr(skip, F.octet_length(p)), "UTF-8"))


def strip_prefix(c: Column | str, prefix: str) -> Column:
    """Remove ``prefix`` when the text starts with it; other text is unchanged.

    Same result as an anchored ``regexp_replace`` of the escaped prefix, without a
    regex per row.
    """
    c = col(c)
    return F.when(c.startswith(prefix), F.substring(c, len(prefix) + 1, 2**31 - 1)).otherwise(c)


# Folder column of patient-clustered clean tables; its value is the first characters
# of the patient key (256 folders for SHA-256 hex keys).
PATIENT_BUCKET = "patient_bucket"
PATIENT_BUCKET_CHARS = 2


def patient_bucket(key: Column | str) -> Column:
    """Folder value of a patient key (NULL key → NULL folder)."""
    return F.substring(col(key), 1, PATIENT_BUCKET_CHARS)


def birth_year(birth_date: Column | str) -> Column:
    return F.substring(col(birth_date), 1, 4)


def age_group(year_text: Column | str) -> Column:
    """Age band from a 4-character year; a NULL or malformed year falls to ``75+``."""
    year = col(year_text).try_cast("int")
    out = None
    for bound, label in AGE_GROUP_BOUNDS:
        out = (F.when(year >= bound, label) if out is None
               else out.when(year >= bound, label))
    return out.otherwise(AGE_GROUP_ELSE)


def age_rank(label: Column | str) -> Column:
    c = col(label)
    out = None
    for name, rank in AGE_RANK:
        out = F.when(c == name, rank) if out is None else out.when(c == name, rank)
    return out.otherwise(AGE_RANK_ELSE)


def condition_type(name: Column | str) -> Column:
    """Type label of a diagnosis name: the text of the last ``(...)`` at the end,
    lower-cased; ``unknown`` for NULL or empty names; ``other`` when nothing matches.
    ``(?U)`` makes ``\\s`` match Unicode blanks (e.g. NBSP) as well; the four
    information separators are added because Python counts them as white space.
    """
    c = col(name)
    label = F.lower(F.regexp_extract(c, CONDITION_TYPE_PATTERN, 1))
    return (F.when(c.isNull() | (c == ""), CONDITION_TYPE_UNKNOWN)
            .when(label == "", CONDITION_TYPE_OTHER)
            .otherwise(label))


def iso_date_text(text: Column | str) -> Column:
    """ISO date text (``yyyy-MM-dd``) of the date prefix of an ISO timestamp; NULL if bad."""
    return F.try_to_date(col(text)).cast("string")


def month_of(text: Column | str) -> Column:
    """``yyyy-MM`` of an ISO date/timestamp text; NULL if it does not parse."""
    return F.date_format(F.try_to_date(col(text)), "yyyy-MM")


def like_pattern(pattern: str) -> str:
    """A LIKE pattern in the store's rule as Spark reads it: a backslash makes the next
    character literal, whatever it is (Spark only allows one before ``%``, ``_``, ``\\``)."""
    out, chars = [], iter(pattern)
    for c in chars:
        if c == "\\":
            c = next(chars, "\\")
            out.append("\\" + c if c in "%_\\" else c)
        else:
            out.append(c)
    return "".join(out)


def type_suffix_filter(name: Column | str, type_label: str) -> Column:
    """Case-insensitive suffix match ``%(<type>)``; ``%``/``_`` in the type are wildcards."""
    return F.lower(col(name)).like(like_pattern(f"%({type_label.lower()})"))
