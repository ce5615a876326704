"""Sizes as Spark's settings give them."""

from __future__ import annotations

import re


def byte_size(text: str) -> int:
    """Bytes of a size such as 128MB, 16m or 134217728b."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)i?b?", text.strip().lower()).groups()
    return max(1, int(number) << 10 * " kmgtp".index(unit or " "))
