"""Repeated and nearly repeated lines: segment-partition edit join, on DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import cut_lineage, lookup
from .common import carried

# Edits that two lines may differ by, and the shortest line that may have such neighbours.
THRESHOLD = 1
SHORTEST = 20
# Lines that may share a segment before what they share is cut finer, and pieces of a cut.
CROWD = 32
PIECES = 16


def occurrences(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(k1, k2, doc_id, version, line_no, line) for every line that is not empty.

    ``version`` tells apart texts that share a doc_id; k1 and k2 hash the line.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(f"`{text}`").alias("version"), F.posexplode(F.split(f"`{text}`", "\n")).alias("line_no", "line"))
    rows = rows.where(F.col("line") != "")
    return rows.withColumns({"k1": F.xxhash64("line"), "k2": F.xxhash64("line", F.lit(1))})


def _segment(length: Column, i: int, threshold: int) -> tuple[Column, Column]:
    """Start (from 0) and size of segment i of a line cut into threshold + 1, later ones longer."""
    parts = threshold + 1
    base, longer = F.floor(length / parts), length % parts
    extra = F.greatest(F.lit(0), longer - (parts - i))
    return (base * i + extra).cast("int"), (base + (longer >= parts - i).cast("int")).cast("int")


def segment_keys(line: Column, threshold: int) -> tuple[Column, Column]:
    """(own, probe): hashed segments of a line, and hashed substrings to look up.

    A line of length l within ``threshold`` edits of a longer or equal one agrees with it
    on a segment.  For every length l it may have, only the starts are probed that leave
    enough edits on either side.  Probes that equal the line's own segments are left out:
    two lines with the same own segment meet on it.
    """
    length = F.char_length(line)
    own, probe = [], []
    for i in range(threshold + 1):
        start, size = _segment(length, i, threshold)
        own.append(F.xxhash64(F.lit(i), length, F.substring(line, start + 1, size)))
    for shorter in range(threshold + 1):
        other = length - shorter
        for i in range(threshold + 1):
            start, size = _segment(other, i, threshold)
            for shift in range(max(-i, shorter - (threshold - i)), min(i, shorter + threshold - i) + 1):
                if shorter or shift:
                    at = start + shift
                    key = F.xxhash64(F.lit(i), other, F.substring(line, at + 1, size))
                    probe.append(F.when((at >= 0) & (at + size <= length), key))
    return F.array(*own), F.array(*probe)


def within(left: Column, right: Column, threshold: int) -> Column:
    """Whether two strings are at most ``threshold`` edits apart, bit-parallel within the band.

    Word e has a bit for each of 2 * threshold + 1 diagonals: set when the characters read
    so far of ``right`` match that far into ``left`` with at most e edits.  Reading a
    character moves all diagonals of a word at once.
    """
    band = 2 * threshold + 1
    full = (1 << band) - 1
    a, b = F.split(left, ""), F.split(right, "")
    # Beside each sign of b those of a that its diagonals meet; lined up before the steps,
    # as an expression inside them would be evaluated at every one.
    none = F.lit(None).cast("string")
    beside = [
        F.concat(F.array_repeat(none, threshold - d), a) if d <= threshold else F.slice(a, d - threshold + 1, F.size(a)) for d in range(band)
    ]
    aligned = F.slice(F.arrays_zip(b, *beside), 1, F.size(b))

    def step(state: Column, x: Column) -> Column:
        match = sum((F.coalesce(x[str(d + 1)] == x["0"], F.lit(False)).cast("int") * (1 << d) for d in range(band)), F.lit(0))
        words = [state["e0"].bitwiseAND(match)]
        for e in range(1, threshold + 1):
            less = state[f"e{e - 1}"]
            words.append(
                state[f"e{e}"].bitwiseAND(match).bitwiseOR(less).bitwiseOR(F.shiftright(less, 1))
                .bitwiseOR(F.shiftleft(words[-1], 1)).bitwiseAND(F.lit(full))
            )
        return F.struct(*[w.alias(f"e{e}") for e, w in enumerate(words)])

    start = F.struct(*[F.lit((((1 << (e + 1)) - 1) << threshold) & full).alias(f"e{e}") for e in range(threshold + 1)])
    gap = F.char_length(left) - F.char_length(right) + threshold
    last = F.aggregate(aligned, start, step, lambda s: s[f"e{threshold}"])
    # The bit of the diagonal on which both strings end.
    bit = F.get(F.array(*[F.lit(1 << d) for d in range(band)]), F.when(gap >= 0, gap))
    return F.coalesce(last.bitwiseAND(bit) != 0, F.lit(False))


def _texts(lines: DataFrame, ids: DataFrame) -> DataFrame:
    """(k1, k2, line) for the wanted ids, once each."""
    rows = lookup(lines.select("k1", "k2", "line"), ids, ["k1", "k2"], "left_semi")
    return rows.dropDuplicates(["k1", "k2", "line"])


def _middles(texts: DataFrame, crowded: DataFrame) -> DataFrame:
    """What is left of a line beside a segment that a crowd shares, for one edit.

    ``key`` stands for all that the lines of a crowd have in common, ``middle`` for the
    rest, and ``room`` for its size in the shorter line of a pair; ``whole`` rows are as
    long as that one, the others a sign longer.
    """
    length = F.char_length("line")
    forms = []
    for shorter in (0, 1):
        for i in (0, 1):
            _, size = _segment(length - shorter, i, 1)
            start, _ = _segment(length, i, 1) if not shorter else (F.lit(0) if i == 0 else length - size, None)
            key = F.xxhash64(F.lit(i), length - shorter, F.substring("line", start + 1, size))
            middle = F.substring("line", size + 1, length) if i == 0 else F.substring("line", F.lit(1), length - size)
            forms.append(F.struct(key.alias("key"), middle.alias("middle"), (length - shorter - size).alias("room"), F.lit(shorter == 0).alias("whole")))
    rows = texts.select("k1", "k2", "first", F.explode(F.array(*forms)).alias("form")).select("k1", "k2", "first", "form.*")
    return lookup(rows, crowded, ["key"], "left_semi")


def _later(pairs: DataFrame) -> DataFrame:
    """(k1, k2) of the line of each pair that first stands later."""
    later = F.col("a_first") > F.col("b_first")
    return pairs.select(F.when(later, F.col("a1")).otherwise(F.col("b1")).alias("k1"), F.when(later, F.col("a2")).otherwise(F.col("b2")).alias("k2"))


def _crowd_neighbours(rows: DataFrame) -> list[DataFrame]:
    """(k1, k2) of lines of crowds with an earlier neighbour at one edit, however large the crowd.

    The one edit lies in one of up to ``PIECES`` pieces of the middle, so two neighbours
    agree on everything but one piece.  That agreement is the next key and the piece the
    next middle.  A key that no crowd shares is joined into pairs; larger ones are cut
    again.  In the end a middle has at most one sign: then all whole rows of a key are
    neighbours, and a longer row is one of the whole row that is left when either of its
    two signs goes.  These are minima per key, so nothing grows with the square of a crowd.
    """
    found = []
    while True:
        rows = cut_lineage(rows)
        if not rows.limit(1).count():
            return found
        pieces = F.least(F.col("room"), F.lit(PIECES))
        cut = rows.withColumn("j", F.explode(F.sequence(F.lit(0), pieces - 1)))
        begin, end = (F.floor(F.col("room") * (F.col("j") + k) / pieces).cast("int") for k in (0, 1))
        cut = cut.withColumn("begin", begin).withColumn("end", end)
        after = F.char_length("middle") - F.col("room") + F.col("end")
        head, tail = F.expr("substring(middle, 1, begin)"), F.substring("middle", after + 1, F.char_length("middle"))
        rows = cut_lineage(cut.select(
            "k1", "k2", "first", "whole", F.xxhash64("key", "j", head, tail).alias("key"),
            F.substring("middle", F.col("begin") + 1, after - F.col("begin")).alias("middle"), (F.col("end") - F.col("begin")).alias("room"),
        ))
        last = rows.where("room <= 1")
        least = last.where("whole").groupBy("key").agg(F.min("first").alias("least"))
        found.append(last.where("whole").join(least, "key").where("least < first").select("k1", "k2"))
        shrunk = F.explode(F.array_distinct(F.array(F.substring("middle", 1, 1), F.substring("middle", 2, 1))))
        longer = last.where("not whole").select("key", "k1", "k2", "first", shrunk.alias("middle"))
        whole = last.where("whole").select("key", "middle", F.col("k1").alias("w1"), F.col("k2").alias("w2"), F.col("first").alias("w_first"))
        met = longer.join(whole, ["key", "middle"])
        found.append(met.where("w_first < first").select("k1", "k2"))
        early = met.groupBy("w1", "w2").agg(F.min("first").alias("least"), F.first("w_first").alias("w_first"))
        found.append(early.where("least < w_first").select(F.col("w1").alias("k1"), F.col("w2").alias("k2")))
        rest = rows.where("room > 1")
        crowded = cut_lineage(rest.groupBy("key").count().where(F.col("count") > CROWD).select("key"))
        few = lookup(rest, crowded, ["key"], "left_anti")
        a = few.where("whole").select("key", F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.col("first").alias("a_first"), F.col("middle").alias("a_middle"))
        b = few.select("key", F.col("k1").alias("b1"), F.col("k2").alias("b2"), F.col("first").alias("b_first"), F.col("middle").alias("b_middle"))
        pairs = a.join(b, "key").where("a1 != b1 or a2 != b2")
        found.append(_later(pairs.where(within(F.col("a_middle"), F.col("b_middle"), 1))))
        rows = lookup(rest, crowded, ["key"], "left_semi")


def repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD, shortest: int = SHORTEST) -> DataFrame:
    """(k1, k2, first, near) of every distinct line that has something to remove.

    ``first`` is the place (doc_id, version, line_no) where the line first stands and ``near``
    whether a line within ``threshold`` edits first stands earlier.  Lines that occur once
    and are not near are left out.

    Equal lines become one before anything else, so a line that is everywhere weighs as
    much as any other.  Only hashes are shuffled; the texts of candidate pairs are fetched
    for verification.  Segments that over ``CROWD`` lines share form no pairs at a threshold
    of one edit: see ``_crowd_neighbours``.  At higher thresholds all lines of a segment
    are compared.
    """
    lines = occurrences(docs, doc_id, text)
    own, probe = segment_keys(F.col("line"), threshold)
    long_enough = F.char_length("line") >= shortest
    here = F.struct("doc_id", "version", "line_no")
    marked = lines.select(
        "k1", "k2", here.alias("here"), F.when(long_enough, own).alias("own"), F.when(long_enough, probe).alias("probe")
    )
    classes = cut_lineage(
        marked.groupBy("k1", "k2").agg(
            F.min("here").alias("first"), F.count(F.lit(1)).alias("copies"), F.first("own").alias("own"), F.first("probe").alias("probe")
        )
    )
    owned = classes.select("k1", "k2", F.explode("own").alias("key"))
    probes = classes.select("k1", "k2", F.explode(F.concat("own", "probe")).alias("key")).where("key is not null")
    near = []
    firsts = classes.select("k1", "k2", "first")
    if threshold == 1:
        # Counted are the own segments; probes that meet a crowd are cut with it.
        crowded = cut_lineage(owned.groupBy("key").count().where(F.col("count") > CROWD).select("key"))
        members = cut_lineage(lookup(probes, crowded, ["key"], "left_semi").select("k1", "k2").distinct())
        near += _crowd_neighbours(_middles(_texts(lines, members).join(firsts, ["k1", "k2"]), crowded))
        owned = lookup(owned, crowded, ["key"], "left_anti")
    a, b = owned.select(F.col("k1").alias("a1"), F.col("k2").alias("a2"), "key"), probes.select(F.col("k1").alias("b1"), F.col("k2").alias("b2"), "key")
    pairs = a.join(b, "key").where("a1 != b1 or a2 != b2").select("a1", "a2", "b1", "b2").distinct()
    pairs = cut_lineage(pairs)
    ids = pairs.select(F.col("a1").alias("k1"), F.col("a2").alias("k2")).union(pairs.select("b1", "b2")).distinct()
    texts = cut_lineage(_texts(lines, ids).join(firsts, ["k1", "k2"]))
    left = texts.select(F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.col("line").alias("a_line"), F.col("first").alias("a_first"))
    right = texts.select(F.col("k1").alias("b1"), F.col("k2").alias("b2"), F.col("line").alias("b_line"), F.col("first").alias("b_first"))
    both = pairs.join(left, ["a1", "a2"]).join(right, ["b1", "b2"])
    links = both.where(within(F.col("a_line"), F.col("b_line"), threshold))
    near.append(_later(links))
    late = near[0]
    for more in near[1:]:
        late = late.union(more)
    late = late.distinct().withColumn("near", F.lit(True))
    out = classes.select("k1", "k2", "first", "copies").join(late, ["k1", "k2"], "left").withColumn("near", F.coalesce("near", F.lit(False)))
    return out.where("copies > 1 or near").select("k1", "k2", "first", "near")


def drop_lists(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD, shortest: int = SHORTEST) -> DataFrame:
    """(doc_id, version, exact, near, gone) for documents that lose lines: how many stood
    before, how many are near, and a flag per line up to the last one to remove."""
    lines = occurrences(docs, doc_id, text).select("k1", "k2", "doc_id", "version", "line_no")
    found = lookup(lines, cut_lineage(repeated_lines(docs, doc_id, text, threshold, shortest)), ["k1", "k2"])
    here = F.struct("doc_id", "version", "line_no")
    again = here != F.col("first")
    rows = found.where(again | F.col("near")).select("doc_id", "version", "line_no", again.alias("again")).distinct()
    lists = rows.groupBy("doc_id", "version").agg(
        F.count_if("again").cast("int").alias("exact"),
        F.count_if(~F.col("again")).cast("int").alias("near"),
        F.sort_array(F.collect_list("line_no")).alias("numbers"),
    )
    # Flags rather than numbers: the text is then filtered in one pass, however many lines go.
    stays = lambda n, k: n - F.coalesce(F.get("numbers", k - 1), F.lit(-1)) - 1
    gone = F.flatten(F.transform("numbers", lambda n, k: F.concat(F.array_repeat(F.lit(False), stays(n, k)), F.array(F.lit(True)))))
    return lists.select("doc_id", "version", "exact", "near", gone.alias("gone"))


def dedup_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD, shortest: int = SHORTEST, counts: bool = False
) -> DataFrame:
    """All columns of ``docs`` with repeated lines taken out of the text.

    Lines stand in the order of (doc_id, text version, line number).  A line is removed when the same
    line stood before, or when its first appearance comes after that of a line within
    ``threshold`` edits, both of at least ``shortest`` characters.  The threshold does not
    grow with the line: longer lines that agree in 95 % stay if they differ by more.  Other lines stay as they are and in order.  ``counts`` adds n_exact and n_near,
    the lines removed either way.

    A null text stays null, empty lines stay, and a text all of whose lines are removed
    becomes empty; no row is dropped.  Rows that agree in id and text are one document
    and get the same result.  Null ids come first in the order.  An empty table stays empty.
    """
    drops = drop_lists(docs, doc_id, text, threshold, shortest)
    taken, back = carried(docs, docs.columns)
    rows = docs.select(*taken, F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("whole"), F.xxhash64(f"`{text}`").alias("of"))
    rows = rows.join(drops, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("of") == F.col("version")), "left")
    kept = F.filter(F.split("whole", "\n"), lambda line, i: ~F.coalesce(F.get("gone", i), F.lit(False)))
    edited = F.when(F.col("gone").isNull(), F.col("whole")).otherwise(F.array_join(kept, "\n")).alias(text)
    more = [F.coalesce("exact", F.lit(0)).alias("n_exact"), F.coalesce("near", F.lit(0)).alias("n_near")] if counts else []
    return rows.select(*[edited if c == text else x for c, x in zip(docs.columns, back)], *more)
