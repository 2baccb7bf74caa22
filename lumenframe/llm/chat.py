"""Logged conversations: drop those that another one continues, render the rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import cut_lineage

# Turn numbers of one bucket, the unit of ordering, and turns of one rendered part.
BUCKET_TURNS = 1024
PART_TURNS = 256
# Marks around a turn in the rendered text.
OPEN, BREAK, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def _role(role: Column) -> Column:
    return F.coalesce(role, F.lit("unknown"))


def _said(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def numbered_turns(log: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """Distinct turns with their position and the rolling hash of the prefix they end.

    A turn adds the hash of its position, role and text to that of the turns before it
    (two 64-bit words, joined by exclusive or).  Position and prefix are running
    aggregates, first over turns within a bucket of turn numbers, then over bucket totals,
    so the turns of a very long conversation are ordered by many tasks.
    """
    rows = log.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), _role(F.col(role)).alias("role"), _said(F.col(text)).alias("text")
    )
    # Dealt once by bucket, which serves the duplicates and the order alike.
    rows = rows.withColumn("bucket", F.floor(F.col("turn") / BUCKET_TURNS)).repartition("conv_id", "bucket")
    rows = rows.dropDuplicates(["conv_id", "bucket", "turn", "role", "text"])
    inside = Window.partitionBy("conv_id", "bucket").orderBy("turn", "role", "text")
    rows = cut_lineage(rows.withColumn("nth", F.row_number().over(inside).cast("long")))
    upto = Window.partitionBy("conv_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = rows.groupBy("conv_id", "bucket").agg(F.max("nth").alias("n"))
    buckets = buckets.select("conv_id", "bucket", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"), "n")
    buckets = buckets.withColumn("in_all", F.sum("n").over(Window.partitionBy("conv_id")))
    placed = _beside(rows, buckets).withColumn("position", F.col("before") + F.col("nth")).drop("n")
    placed = placed.withColumns({w: F.xxhash64(F.lit(i), "position", "role", "text") for i, w in enumerate(("h1", "h2"))})
    before = placed.groupBy("conv_id", "bucket").agg(*[F.expr(f"bit_xor({w})").alias(w) for w in ("h1", "h2")])
    before = before.select("conv_id", "bucket", *[F.coalesce(F.expr(f"bit_xor({w})").over(upto), F.lit(0).cast("long")).alias(f"{w}_before") for w in ("h1", "h2")])
    within = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rolled = _beside(placed, before)
    for w in ("h1", "h2"):
        rolled = rolled.withColumn(f"{w}_upto", F.expr(f"bit_xor({w})").over(within).bitwiseXOR(F.col(f"{w}_before")))
    return rolled.select("conv_id", "turn", "role", "text", "position", "in_all", F.col("h1_upto").alias("p1"), F.col("h2_upto").alias("p2"))


def _beside(rows: DataFrame, buckets: DataFrame) -> DataFrame:
    """Bucket facts joined to its turns; nulls are a key like any other."""
    right = buckets.select(F.col("conv_id").alias("_c"), F.col("bucket").alias("_b"), *[c for c in buckets.columns if c not in ("conv_id", "bucket")])
    return rows.join(right, F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("bucket").eqNullSafe(F.col("_b"))).drop("_c", "_b")


def collapse(log: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(conversations, turns): every conversation with its fate, and the turns of those kept.

    A conversation is dropped when another one starts with all its turns and goes on
    (``prefix``), or has the same turns and a smaller id (``copy``); the others are
    ``kept``.  Whole-conversation hashes are reduced to one per distinct conversation and
    prefix hashes to one per distinct prefix before an anti-join matches them, so neither
    a very common first turn nor a very common conversation makes a hot key.

    Turns go by turn number (null first), then by content; an exactly repeated turn counts
    once.  A null role is ``unknown``, a null text empty.  Rows with a null conversation id
    are one conversation of that id, which among copies comes last.  An empty log gives
    empty tables.
    """
    turns = cut_lineage(numbered_turns(log, conv_id, turn, role, text))
    whole = turns.where("position = in_all").select("conv_id", F.col("in_all").alias("n_turns"), "p1", "p2")
    classes = whole.groupBy("p1", "p2").agg(F.min("conv_id").alias("first_id"), F.count(F.lit(1)).alias("n_copies"))
    prefixes = turns.where("position < in_all").select("p1", "p2").distinct()
    maximal = classes.join(prefixes, ["p1", "p2"], "left_anti").withColumn("is_maximal", F.lit(True))
    classes = classes.join(maximal.select("p1", "p2", "is_maximal"), ["p1", "p2"], "left")
    named = whole.join(classes, ["p1", "p2"])
    fate = F.when(F.col("is_maximal").isNull(), "prefix").when(F.col("conv_id").eqNullSafe(F.col("first_id")), "kept").otherwise("copy")
    conversations = cut_lineage(named.select("conv_id", "n_turns", "n_copies", fate.alias("fate")))
    kept = conversations.where("fate = 'kept'").select(F.col("conv_id").alias("_c"))
    return conversations, turns.join(kept, F.col("conv_id").eqNullSafe(F.col("_c")), "left_semi")


def render(turns: DataFrame) -> DataFrame:
    """(conv_id, part, n_turns, rendered): chat markup in parts of at most ``PART_TURNS`` turns.

    The parts of a conversation in order, put together, are its text; no conversation is
    gathered beyond a part.
    """
    piece = F.concat(F.lit(OPEN), "role", F.lit(BREAK), "text", F.lit(CLOSE))
    rows = turns.select("conv_id", F.floor((F.col("position") - 1) / PART_TURNS).alias("part"), "position", piece.alias("piece"))
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("position", "piece"))), lambda x: x["piece"])
    return rows.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n_turns"), F.array_join(pieces, "").alias("rendered"))
