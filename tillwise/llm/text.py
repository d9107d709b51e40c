"""Words and letters as the operators of this package define them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word is a run of anything but the six ASCII white-space characters.  ``bytes.split()`` splits at the same six.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = b" \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(c: Column) -> Column:
    """A-Z in lower case; other letters stay as they are."""
    return F.translate(c, UPPER, LOWER)


def encoded(text: str | None) -> bytes:
    """UTF-8; null is empty, and an unpaired surrogate does not fail."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def unused(name: str, columns: list[str]) -> str:
    """``name``, lengthened until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus
