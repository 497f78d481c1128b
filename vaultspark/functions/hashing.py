"""Hash keys and hash diffs of the Data Vault recipe (DV-1..3, SC-11..16).

All functions return Column expressions; they stay inside whole-stage codegen
and cost one md5 per call.  Every part is normalised the same way:
``nullif(upper(trim(cast(c as string))), '')`` -- a NULL or blank part is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the hash recipe (must match the reference byte for byte).
PART_SEPARATOR = "||"
EMPTY_PART = "^^"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise(c: Column | str) -> Column:
    """Text form used for hashing: trimmed (spaces only), upper-cased, '' -> NULL."""
    return F.nullif(F.upper(F.trim(_col(c).cast("string"))), F.lit(""))


def _joined(cols) -> Column:
    parts = [F.coalesce(normalise(c), F.lit(EMPTY_PART)) for c in cols]
    return F.concat_ws(PART_SEPARATOR, *parts)


def hash_key(*cols: Column | str) -> Column:
    """Hash key of one or several business-key columns.

    One column: md5 of the normalised text, NULL when the text is NULL or blank.
    Several columns: empty parts become ``^^``, parts are joined by ``||``; if
    every part is empty the key is NULL.
    """
    if not cols:
        raise ValueError("hash_key needs at least one column")
    if len(cols) == 1:
        return F.md5(normalise(cols[0]))
    all_empty = PART_SEPARATOR.join([EMPTY_PART] * len(cols))
    return F.md5(F.nullif(_joined(cols), F.lit(all_empty)))


def hash_diff(*cols: Column | str) -> Column:
    """Change hash over payload columns; never NULL (all-empty still hashes)."""
    if not cols:
        raise ValueError("hash_diff needs at least one column")
    return F.md5(_joined(cols))


def uuid_text(c: Column | str) -> Column:
    """32-hex md5 in the dashed 8-4-4-4-12 text form of a UUID (SC-12)."""
    return F.regexp_replace(
        _col(c), r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"
    )


#: Before the bytes of a text that is no md5: longer than any digest, so both forms stay apart.
_AS_IS = "00" * 17


def packed(c: Column | str) -> Column:
    """A key as bytes: the 16 bytes of an md5 in lower-case hex, any other text behind 17 zero bytes.  Equal
    exactly where the texts are equal; half as long in an exchange."""
    c = _col(c)
    plain = F.concat(F.unhex(F.lit(_AS_IS)), c.cast("binary"))
    # 32 bytes without a capital letter that are hex digits: decoded once, never encoded again for a comparison
    return F.when((F.octet_length(c) == 32) & (F.lower(c) == c), F.coalesce(F.unhex(c), plain)).otherwise(plain)


def unpacked(c: Column | str) -> Column:
    """The text of :func:`packed` bytes."""
    c = _col(c)
    return F.when(F.octet_length(c) == 16, F.lower(F.hex(c))).otherwise(F.substring(c, 18, 2147483647).cast("string"))
