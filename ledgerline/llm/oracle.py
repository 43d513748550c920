"""DuckDB SQL shared by the queries of this subpackage that SQL can express."""

from __future__ import annotations


def crc32_tables() -> str:
    """CTE ``crc``: one row with ``v``, the 256 remainders of the reflected CRC-32 polynomial."""
    step = "lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return f"crc AS (SELECT list_transform(range(256), lambda b: list_reduce(range(8), {step}, b)) AS v)"


def crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII ``text`` expression, where ``crc.v`` is in scope."""
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(list_reduce({codes}, lambda c, b: xor(crc.v[(xor(c, b) & 255) + 1], c >> 8), 4294967295), 4294967295)"
