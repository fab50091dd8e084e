"""Folds over arrays that stay linear in their length."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), where value is evaluated once, however often use names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def folded(items: Column, state: Column, step: Callable[[Column, Column], tuple[Column, Column]], kind: str, block: int = 64) -> Column:
    """What step emits (null: nothing) while it goes through items with a state, as array<kind>.

    step(state, item) gives the next state and what is emitted. An aggregate
    copies all it holds at each step, so items are cut into blocks: a first pass
    finds the state at the start of each block, a second one lets every block
    emit by itself.
    """

    def emitting(acc, x):
        now, emitted = step(acc["s"], x)
        return F.struct(now.alias("s"), let(emitted, lambda e: F.when(e.isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(e)))).alias("out"))

    def per_block(blocks):
        start = F.struct(state.alias("s"), F.filter(F.array(state), lambda _: F.lit(False)).alias("all"))
        after = lambda acc, b: F.struct(F.aggregate(b, acc["s"], lambda s, x: step(s, x)[0]).alias("s"), F.concat(acc["all"], F.array(acc["s"])).alias("all"))
        states = F.aggregate(blocks, start, after, lambda acc: acc["all"])
        none = F.array().cast(f"array<{kind}>")
        return F.transform(F.arrays_zip(blocks.alias("b"), states.alias("s")), lambda z: F.aggregate(z["b"], F.struct(z["s"].alias("s"), none.alias("out")), emitting, lambda acc: acc["out"]))

    def whole(xs):
        last = F.floor((F.size(xs) - 1) / block).cast("int")
        return let(F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(xs, b * block + 1, F.lit(block))), lambda blocks: F.flatten(per_block(blocks)))

    return let(F.transform(items, lambda x: x), lambda xs: F.when(F.size(xs) > 0, whole(xs)).otherwise(F.array().cast(f"array<{kind}>")))


def sums_before(lengths: Column) -> Column:
    """For each element of an array of whole numbers the sum of those before it."""
    return folded(lengths, F.lit(0).cast("bigint"), lambda s, n: (s + n, s), "bigint")


def rows_of(df: DataFrame, kept: list, array: Column, *names: str) -> DataFrame:
    """kept columns and a row for each element of array: (position, element) under two names, or (element) under one.

    As explode, but the array is computed once: for explode the optimizer adds a
    filter on the array's size, which computes it again.
    """
    made = F.posexplode_outer(array).alias(*names) if len(names) == 2 else F.posexplode_outer(array).alias("_at", *names)
    rows = df.select(*kept, made)
    return rows.where(F.col(names[0] if len(names) == 2 else "_at").isNotNull()).drop(*([] if len(names) == 2 else ["_at"]))
