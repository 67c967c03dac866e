"""Cutting texts by arrays of lengths, in expressions whose work does not grow with the square of the array.

A fold that carries an array copies it at each step, and ``substring`` reads a text from its start.
So arrays are taken in blocks of ``BLOCK`` elements: sums and substrings over blocks, then within
each block. An empty or null array gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 64


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def _running(values: Column) -> Column:
    """Sums of the elements before each one, of a short array."""
    return F.transform(values, lambda x, i: _sum(F.slice(values, 1, i)))


def _blocks(values: Column) -> Column:
    """Slices of ``BLOCK`` elements."""
    n = F.ceil(F.size(values) / BLOCK).cast("int")
    at = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda j: F.slice(values, j * BLOCK + 1, F.lit(BLOCK)))


def offsets(lengths: Column) -> Column:
    """Where each of consecutive pieces starts, from 0: sums of the lengths before it."""

    def whole(blocks: Column) -> Column:
        def placed(starts: Column) -> Column:
            return F.flatten(F.zip_with(blocks, starts, lambda b, s: F.transform(_running(b), lambda x: x + s)))

        return let(_running(F.transform(blocks, _sum)), placed)

    return let(lengths, lambda ls: let(_blocks(ls), whole))


def pieces(text: Column, lengths: Column) -> Column:
    """Consecutive pieces of a text by their lengths in code points; what lies behind them is left out."""

    def whole(v: Column) -> Column:
        def cut(starts: Column) -> Column:
            def block(b: Column, s: Column) -> Column:
                own = F.substring(v["t"], s + 1, _sum(b))
                return let(own, lambda o: F.zip_with(b, _running(b), lambda n, at: F.substring(o, at + 1, n)))

            return F.flatten(F.zip_with(v["b"], starts, block))

        return let(_running(F.transform(v["b"], _sum)), cut)

    return let(lengths, lambda ls: let(F.struct(text.alias("t"), _blocks(ls).alias("b")), whole))
