"""Pieces of DuckDB SQL that several oracles use."""

from __future__ import annotations


def crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII expression: bytes folded bit by bit with the reflected polynomial."""
    fold = "list_reduce(list_prepend(xor(c, b), range(8)), lambda r, i: case when r & 1 = 1 then xor(r >> 1, 3988292384) else r >> 1 end)"
    codes = f"list_transform(string_split({text}, ''), lambda x: cast(ascii(x) as bigint))"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda c, b: {fold}), 4294967295)"
