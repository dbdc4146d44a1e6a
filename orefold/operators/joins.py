"""Left joins of aggregated facts with a dimension that is not trusted to be small or unique.

Facts are aggregated by the join key first, which map-side combine does before the
shuffle: a key that holds a third of the facts leaves each map task as one row. How
the two reduced sides meet is left to adaptive execution, which knows their real
sizes when they have been shuffled and broadcasts the smaller one if it is small.

``distinct_with_copies`` reduces a dimension to its distinct rows with a ``copies``
count, because a duplicated key must multiply the facts it meets, and copies of
one row must neither meet in one task nor multiply rows in flight.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.numbers import quoted

#: Tasks that one key is spread over, where a caller asks for more than one.
SALTS = 1
#: Keys that the sketch of frequent ones tells from each other: a key with more than one in
#: this many rows is never missed.
TRACKED = 10_000
COPIES = "_copies"
# Copies of the matched dimension row; an unmatched fact counts once.
TIMES = f"coalesce({COPIES}, 1L)"
_SALT = "_salt"
_SALTS = "_salts"


def distinct_with_copies(dimension: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Distinct ``(key, attributes)`` rows with their number; NULL keys never match."""
    return (
        dimension.filter(F.col(key).isNotNull())
        .groupBy(key, *attributes)
        .agg(F.count(F.lit(1)).alias(COPIES))
    )


def join_dimension(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    attributes: Sequence[str],
    salts: int = SALTS,
) -> DataFrame:
    """``facts``, aggregated by ``key``, left join the distinct rows of ``dimension``.

    The facts have one row per key, so no key of theirs is hot. A dimension key with millions
    of *different* rows would be: with ``salts`` above one these are spread over that many
    tasks, which costs a second look at the dimension. Each fact row is repeated only for
    the salts its key really has, so an unmatched fact still yields exactly one row.
    """
    distinct = distinct_with_copies(dimension, key, attributes)
    if salts <= 1:
        return facts.join(distinct, key, "left")
    salted = distinct.withColumn(_SALT, F.pmod(F.xxhash64(*attributes), F.lit(salts)))
    # At most ``salts`` elements per key, whatever the number of rows.
    present = salted.groupBy(key).agg(F.collect_set(_SALT).alias(_SALTS))
    spread = (
        facts.join(present, key, "left")
        .withColumn(_SALT, F.explode_outer(_SALTS))
        .drop(_SALTS)
    )
    return spread.join(salted, [key, _SALT], "left").drop(_SALT)


def frequent(facts: DataFrame, key: str, parts: int) -> DataFrame:
    """One row with ``keys``: those that hold more than a ``parts``-th of the rows, at most
    as many as that. Found by a sketch that merges, so each task sends a bounded number."""
    sketch = facts.agg(
        F.expr(f"approx_top_k({quoted(key)}, {parts}, {max(TRACKED, parts)}) AS top"),
        F.count(F.lit(1)).alias("rows"),
    )
    return sketch.select(
        F.expr(
            f"transform(filter(top, x -> x.item IS NOT NULL AND x.count * {parts}L > rows), x -> x.item)"
        ).alias("keys")
    )


def join_facts(
    facts: DataFrame, dimension: DataFrame, key: str, attributes: Sequence[str], salts: int = SALTS
) -> DataFrame:
    """Raw ``facts`` left join the distinct rows of ``dimension``, with ``copies``.

    Catalyst broadcasts a small dimension. For a large one ``salts`` above one deals the rows
    of frequent keys, and those without a key, out to that many parts; only the frequent keys
    of the dimension are repeated for them. Which keys are frequent is a subquery of the same
    plan over the key column alone. No row is repeated or left out.
    """
    distinct = distinct_with_copies(dimension, key, attributes)
    if salts <= 1:
        return facts.join(distinct, key, "left")
    hot = frequent(facts.select(key), key, salts)
    # The part of a row follows from the row and from where it was read, so copies part as well.
    part = F.pmod(F.xxhash64(F.spark_partition_id(), *facts.columns), F.lit(salts))
    is_hot = F.coalesce(F.array_contains(hot.scalar(), F.col(key)), F.lit(True))
    dealt = facts.withColumn(_SALT, F.when(is_hot, part).otherwise(F.lit(0)))
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
    present = F.when(F.array_contains(hot.scalar(), F.col(key)), every).otherwise(F.array(F.lit(0).cast("bigint")))
    repeated = distinct.withColumn(_SALT, F.explode(present))
    return dealt.join(repeated, [key, _SALT], "left").drop(_SALT)
