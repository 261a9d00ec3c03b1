"""CRC-32 of numbers' decimal digits for DuckDB, which has no such function."""

from __future__ import annotations

#: A common table expression with one row: the usual table of 256 entries, worked out from the polynomial.
CRC_TABLE = """crc AS (
    SELECT list(value ORDER BY entry) AS entries FROM (
        SELECT entry, list_reduce([entry, 1, 1, 1, 1, 1, 1, 1, 1],
            lambda c, unused: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS value
        FROM range(256) AS numbers(entry)
    )
)"""


def crc_of(number: str) -> str:
    """The checksum of a number's decimal digits, as a bigint; needs ``crc`` in the FROM clause."""
    codes = f"list_transform(string_split({number}::VARCHAR, ''), lambda d: ascii(d)::BIGINT)"
    step = "lambda c, b: xor(c // 256, entries[1 + xor(c, b) % 256])"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), {step}), 4294967295)"
