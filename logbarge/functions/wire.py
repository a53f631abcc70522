"""Binary wire format of the push message, as SQL expression text.

Message layout (fixed values): request { 1: stream* }, stream { 1: labels, 2: entry* },
entry { 1: time { 1: seconds, 2: nanos }, 2: line, 3: pair { 1: name, 2: value }* }.

Arguments are column names (or lambda variables), not nested expressions: a length prefix needs its
body twice, so the encoder names each level before it builds the next. Text keeps these long
expressions to one call each; ``F.expr`` makes a Column of them.
"""

from __future__ import annotations

EMPTY = "X''"


def _tag(number: int, wire_type: int) -> str:
    return f"X'{number << 3 | wire_type:02X}'"


def varint(n: str, width: int = 5) -> str:
    """Base-128 bytes of an integer: of any one with ``width`` 10, else from 0 to below ``2 ** (7 * width)``.

    Negative numbers take ten bytes, as the format wants for signed fields of either size.
    """
    n = f"cast({n} as bigint)"

    def group(i: int, more: bool) -> str:
        return f"shiftrightunsigned({n}, {7 * i}) & 127{' | 128' if more else ''}"

    def packed(size: int) -> str:
        if size == 1:
            return f"unhex(lpad(hex({n}), 2, '0'))"
        if size > 8:
            # a number holds eight bytes; the rest follows byte by byte
            rest = (f"unhex(lpad(hex({group(i, i < size - 1)}), 2, '0'))" for i in range(8, size))
            return f"concat({packed_first(8, True)}, {', '.join(rest)})"
        return packed_first(size, False)

    def packed_first(size: int, more: bool) -> str:
        groups = (f"shiftleft({group(i, more or i < size - 1)}, {8 * (size - 1 - i)})" for i in range(size))
        # the first byte is never below 128, so the hex text has all its digits
        return f"unhex(hex({' | '.join(groups)}))"

    limits = [f"when {n} < {1 << 7 * size} then {packed(size)}" for size in range(1, min(width, 8) + 1)]
    if width < 10:
        return f"case when {n} is null then null {' '.join(limits)} else raise_error('number too wide for the payload') end"
    return f"case when {n} < 0 then {packed(10)} {' '.join(limits)} else {packed(9)} end"


def bytes_field(number: int, body: str, width: int = 5) -> str:
    """A length-delimited field that is always written."""
    return f"concat({_tag(number, 2)}, {varint(f'octet_length({body})', width)}, {body})"


def text_field(number: int, body: str) -> str:
    """A string field given as binary; an empty string is the default and writes nothing."""
    return f"case when octet_length({body}) = 0 then {EMPTY} else {bytes_field(number, body)} end"


def int_field(number: int, n: str, width: int = 10) -> str:
    return f"case when {n} = 0 then {EMPTY} else concat({_tag(number, 0)}, {varint(n, width)}) end"


def pair_fields(number: int, m: str) -> str:
    """One name-value message per map entry, joined."""
    coded = f"transform(map_entries({m}), e -> struct(encode(e.key, 'UTF-8') as k, encode(e.value, 'UTF-8') as v))"
    pairs = f"transform({coded}, e -> concat({text_field(1, 'e.k')}, {text_field(2, 'e.v')}))"
    return f"aggregate({pairs}, {EMPTY}, (acc, pair) -> concat(acc, {bytes_field(number, 'pair')}))"
