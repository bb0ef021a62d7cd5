"""Murmur3 (x86, 32 bit, seed 0, sign bit cleared) and slot routing as built-in SQL expressions.

Spark's built-in ``hash`` uses another seed and another tail rule, so it cannot route to the same slots. The
expressions are SQL text, which is parsed in one step. The feed evaluates them once per file action, not per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the published MurmurHash3 x86_32 algorithm.
C1, C2 = 0xCC9E2D51, 0x1B873593
BLOCK_ADD = 0xE6546B64
MIX1, MIX2 = 0x85EBCA6B, 0xC2B2AE35
MASK32, MASK16, MASK31 = 0xFFFFFFFF, 0xFFFF, 0x7FFFFFFF


def _times(x: str, c: int) -> str:
    """x * c mod 2^32 in two 16-bit halves; no step leaves the signed 64-bit range."""
    high = f"(shiftrightunsigned({x}, 16) * {c}L) & {MASK16}L"
    return f"((shiftleft({high}, 16) + ({x} & {MASK16}L) * {c}L) & {MASK32}L)"


def _rotl(x: str, r: int) -> str:
    return f"((shiftleft({x}, {r}) & {MASK32}L) | shiftrightunsigned({x}, {32 - r}))"


def _each(words: str, *steps) -> str:
    """Apply steps to every word of an array; a step may use its word twice without copying what led to it."""
    for step in steps:
        words = f"transform({words}, w -> {step('w')})"
    return words


def _scramble(words: str) -> str:
    return _each(words, lambda w: _times(w, C1), lambda w: _rotl(w, 15), lambda w: _times(w, C2))


def _xorshift(r: int):
    return lambda w: f"({w} ^ shiftrightunsigned({w}, {r}))"


def _word(digits: str, i: str) -> str:
    """Four bytes of a hex text, least significant first; a short last word is padded with zeros."""
    block = f"rpad(substr({digits}, {i} * 8 + 1, 8), 8, '0')"
    turned = ", ".join(f"substr({block}, {p}, 2)" for p in (7, 5, 3, 1))
    return f"cast(conv(concat({turned}), 16, 10) as bigint)"


def murmur3_sql(text: str) -> str:
    """SQL for the non-negative 32-bit murmur3 of the UTF-8 bytes of the SQL string expression ``text``."""
    n = "(length(d) div 8)"
    blocks = f"transform(if({n} > 0, sequence(0, int({n}) - 1), array()), i -> {_word('d', 'i')})"
    body = f"aggregate({_scramble(blocks)}, 0L, (h, w) -> ({_rotl('(h ^ w)', 13)} * 5L + {BLOCK_ADD}L) & {MASK32}L)"
    tail = f"if(length(d) % 8 > 0, {_word('d', 'int' + n)}, 0L)"
    mixed = f"{body} ^ {_scramble(f'array({tail})')}[0] ^ bigint(length(d) div 2)"
    final = _each(
        f"transform(array(hex(encode({text}, 'UTF-8'))), d -> {mixed})",
        _xorshift(16), lambda w: _times(w, MIX1), _xorshift(13), lambda w: _times(w, MIX2), _xorshift(16),
    )
    return f"int({final}[0] & {MASK31}L)"


def murmur3(text: str) -> Column:
    """murmur3 of a string column, given by name or SQL expression (null for null)."""
    return F.expr(murmur3_sql(text))


def slot(partition_text: str, n_slots: int) -> Column:
    """Slot of a partition string: null counts as the empty string, and no slots means slot 0."""
    if n_slots == 0:
        return F.lit(0)
    return F.expr(f"int(pmod({murmur3_sql(f'''coalesce({partition_text}, '')''')}, {n_slots}))")


def owned(slot_col: Column, instance: int, instances: int) -> Column:
    """True for slots that instance ``instance`` of ``instances`` owns."""
    return F.pmod(slot_col, F.lit(instances)) == F.lit(instance)
