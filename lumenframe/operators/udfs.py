"""User code over values, groups and partitions, always in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Rows a task gathers before it folds them: fewer calls per group, bounded memory.  A key with
# more is spread.
HELD_ROWS = 250_000


def apply_per_value(df: DataFrame, column: str, out: str, kind: str, fn: Callable[[pd.Series], pd.Series]) -> DataFrame:
    """A vectorised scalar function; use it only where no built-in does the job."""
    return df.withColumn(out, F.pandas_udf(fn, kind)(F.col(column)))


def reduce_groups(
    df: DataFrame,
    keys: list[str],
    values: dict[str, str],
    first: Callable[[pd.DataFrame], dict],
    merge: Callable[[pd.DataFrame], dict],
) -> DataFrame:
    """User-defined aggregate in steps; both functions return one value per output name.

    Rows go to tasks by key, so each function is called about once per key, however many
    tasks read the input.  Rows of a key that has more than ``HELD_ROWS`` are spread over
    salts; ``first`` reduces the sorted rows of a (key, salt), in parts of ``HELD_ROWS``,
    and ``merge`` folds those partial rows along the sorted keys.
    """
    schema = T.StructType([*[df.schema[k] for k in keys], *T.StructType.fromDDL(
        ", ".join(f"`{n}` {t}" for n, t in values.items())
    ).fields])
    names = list(values)

    def fold(pdf: pd.DataFrame, fn: Callable[[pd.DataFrame], dict]) -> pd.DataFrame:
        rows = []
        for k, g in pdf.groupby(keys, dropna=False, sort=False):
            found = fn(g)
            rows.append((*k, *[found[n] for n in names]))
        return pd.DataFrame(rows, columns=[*keys, *names])

    def of_last_key(pdf: pd.DataFrame) -> pd.Series:
        last = pdf[keys].iloc[-1]
        return ((pdf[keys] == last) | (pdf[keys].isna() & last.isna())).all(axis=1)

    def reducing(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Rows arrive sorted by key; the last key of what is held may go on in the next batch.
        held: list[pd.DataFrame] = []
        for pdf in it:
            held.append(pdf)
            if sum(map(len, held)) >= HELD_ROWS:
                whole = pd.concat(held, ignore_index=True)
                same = of_last_key(whole)
                held = [] if same.all() else [whole[same]]
                yield fold(whole if same.all() else whole[~same], first)
        if sum(map(len, held)):
            yield fold(pd.concat(held, ignore_index=True), first)

    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    hot = F.broadcast(sizes.where(F.col("_n") > HELD_ROWS).drop("_n").withColumn("_hot", F.lit(True)))  # fewer than rows / HELD_ROWS
    salt = F.when(F.col("_hot"), F.pmod(F.spark_partition_id(), F.lit(64))).otherwise(0)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    salted = df.join(hot, same, "left").select(*df.columns, salt.alias("_salt"))
    dealt = salted.repartition(parts, *keys, "_salt").sortWithinPartitions(*keys).drop("_salt")
    fewer = dealt.mapInPandas(reducing, schema)

    def closing(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Rows arrive sorted by key; the last key of a batch may go on in the next one.
        held = None
        for pdf in it:
            pdf = pdf if held is None else pd.concat([held, pdf])
            if not len(pdf):
                continue
            same = of_last_key(pdf)
            held = fold(pdf[same], merge)
            if not same.all():
                yield fold(pdf[~same], merge)
        if held is not None:
            yield held

    return fewer.repartition(parts, *keys).sortWithinPartitions(*keys).mapInPandas(closing, schema)


def count_words(df: DataFrame, key: str, text: str) -> DataFrame:
    """Words kept by the token rule, counted with one compiled pattern per partition."""
    schema = T.StructType([df.schema[key], T.StructField("n", T.IntegerType())])

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import regex

        letters = regex.compile(r"\p{L}+")
        for pdf in it:
            n = [sum(len(w) > 2 for w in letters.findall(t.lower())) for t in pdf[text]]
            yield pd.DataFrame({key: pdf[key], "n": n})

    return df.mapInPandas(run, schema)
