"""Text out of the binary message bodies of a chat database."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def decode_body(blob: bytes | None) -> str | None:
    """The string after the class name and the next ``+``: one length byte, or two or four little-endian ones after 0x81 or 0x82; null if anything is off."""
    if not blob:
        return None
    at = blob.find(b"NSString")
    at = blob.find(b"+", at + 8) if at >= 0 else -1
    if at < 0 or at + 1 >= len(blob):
        return None
    width = {0x81: 2, 0x82: 4}.get(blob[at + 1])
    head = at + 2 if width is None else at + 2 + width
    size = blob[at + 1] if width is None else int.from_bytes(blob[at + 2 : head], "little")
    if (width is None and blob[at + 1] > 0x7F) or head + size > len(blob):
        return None
    try:
        return bytes(blob[head : head + size]).decode("utf-8")
    except UnicodeDecodeError:
        return None


@F.pandas_udf(T.StringType())
def decode_body_udf(s: pd.Series) -> pd.Series:
    return s.map(lambda b: decode_body(None if b is None else bytes(b)))
