"""CRC-32 in the SQL of the checks, which has no such function of its own."""

from __future__ import annotations

#: The remainders of the 256 byte values, from the reflected polynomial.
_TABLE = ("list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), "
          "lambda a, k: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end))")


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text; NULL of none."""
    return (f"(select case when x is not null then xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(x, ''), lambda c: ascii(c)::bigint)), "
            f"lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) end from (select {text} as x, {_TABLE} as t))")
