"""Mixing documents to target shares: iterative proportional fitting, then calibrated sampling."""

from __future__ import annotations

import logging
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import cut_lineage, lookup
from .common import carried

LOG = logging.getLogger(__name__)
# Rounds go on until no margin is off by this share, and are given up after so many.
TOLERANCE = 1e-9
MAX_ROUNDS = 200
# Rounds after which a fit is given up whose error falls too slowly to come down in time.
TRIED = 20
# A fit whose error moves by less than this share for three rounds has come to its end.
STALLED = 1e-7


def word_count(text: Column) -> Column:
    """Words between ASCII blanks; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))


def text_form(text: Column, words: Column) -> Column:
    """Topic by form: empty, table (bars), shout (exclamations), long or short prose."""
    def signs(sign: str) -> Column:
        return F.char_length(text) - F.char_length(F.replace(text, F.lit(sign), F.lit("")))

    return (
        F.when(words == 0, "empty").when(10 * signs("|") >= words, "table").when(10 * signs("!") >= words, "shout")
        .when(words >= 400, "long").otherwise("short")
    )


def _key(value: Column) -> Column:
    """A value as text that is never null; null is a value of its own."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("-"))


@dataclass
class Margin:
    """Target of one dimension: shares named by value, the rest of the whole spread over the
    other values in proportion to their tokens to a power (1: as they are, 0: evenly)."""

    column: Column
    power: float = 1.0
    named: dict[str, float] | None = None


@dataclass
class Mix:
    """Sampling rates and how the fit ended: one factor table per dimension, the number of
    rounds, and the largest relative error left on a margin.  Factors of a fit that had to
    settle for a compromise are ``logs``, as single ones may pass the range of a number."""

    factors: dict[str, DataFrame]
    sizes: dict[str, int]
    rounds: int
    error: float
    tokens: int
    logs: bool = False

    def rate(self, names: list[str] | dict[str, Margin], missing: float = 0.0) -> Column:
        """The product of the factors of a row; where one is missing it is ``missing``."""
        if self.logs:
            total = sum((F.col(f"f_{n}") for n in names), F.lit(0.0))
            return F.coalesce(F.exp(total), F.lit(missing))
        rate = F.lit(1.0)
        for n in names:
            rate = rate * F.coalesce(F.col(f"f_{n}"), F.lit(missing))
        return rate

    @property
    def converged(self) -> bool:
        return self.error <= TOLERANCE


def _target(cells: DataFrame, name: str, margin: Margin) -> DataFrame:
    """(value, share) for every value that has tokens; named ones that have none are passed over."""
    sums = cells.groupBy(name).agg(F.sum("tokens").cast("double").alias("tokens")).where("tokens > 0")
    sums = sums.withColumn("wish", F.pow("tokens", F.lit(margin.power)))
    named = margin.named or {}
    rest = 1 - sum(named.values())
    if not named:
        wish = sums.agg(F.sum("wish").alias("all"))
        return sums.crossJoin(F.broadcast(wish)).select(name, (F.col("wish") / F.col("all")).alias("share"))
    if rest < -1e-9:
        raise ValueError(f"shares of {name} sum to more than one")
    fixed = F.coalesce(*[F.when(F.col(name) == "=" + v, F.lit(float(s))) for v, s in named.items()])
    sums = sums.withColumn("fixed", fixed)
    wish = sums.agg(F.sum(F.when(F.col("fixed").isNull(), F.col("wish"))).alias("all"), F.sum("fixed").alias("given"))
    share = F.coalesce("fixed", F.col("wish") / F.col("all") * F.lit(rest))
    shares = sums.crossJoin(F.broadcast(wish)).withColumn("share", share)
    # Values without tokens cannot take their share; what there is is scaled to one.
    total = F.col("given") + F.when(F.col("all").isNull(), 0.0).otherwise(rest)
    return shares.select(name, (F.col("share") / total).alias("share"))


def rake(docs: DataFrame, margins: dict[str, Margin], tokens: Column, tolerance: float = TOLERANCE, max_rounds: int = MAX_ROUNDS) -> Mix:
    """Factors per value of every dimension so that token weights meet all targets.

    Tokens are summed once per combination of values; a row of that table weighs its
    tokens times the factor of each of its values.  A step sets the factors of one
    dimension to target over current sum, which combines before the shuffle and meets
    only factor tables: small ones are broadcast after their rows were counted, larger
    ones joined salted.  Factors are written each step, so plans stay short.

    Combinations without tokens weigh nothing.  Where the rounds end at ``max_rounds``, stand
    still, or after ``TRIED`` of them fall too slowly to meet the targets, as when these
    contradict each other, the compromise of ``_settled`` is taken if less error is left on
    its worst margin.
    """
    rows = docs.select(*[_key(m.column).alias(n) for n, m in margins.items()], tokens.alias("tokens"))
    cells = cut_lineage(rows.groupBy(*margins).agg(F.sum("tokens").alias("tokens")).where("tokens > 0"))
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    targets = {n: cut_lineage(_target(cells, n, m)) for n, m in margins.items()}
    sizes = {n: t.count() for n, t in targets.items()}
    # A factor table carries the target beside the factor: one lookup gives both.
    factors = {n: t.select(n, F.lit(1.0).alias(f"f_{n}"), F.col("share").alias(f"t_{n}")) for n, t in targets.items()}
    error, rounds = (float("inf"), 0) if total else (0.0, 0)
    still = 0
    while error > tolerance and rounds < max_rounds and still < 3:
        rounds += 1
        before, error = error, 0.0
        for name in margins:
            weighed = cells
            for other in margins:
                weighed = lookup(weighed, factors[other], [other], known_rows=sizes[other])
            weight = F.col("tokens") / F.lit(float(total))
            for other in margins:
                weight = weight * F.col(f"f_{other}")
            # Sums of contradicting targets may run out of the range of a number.
            now = F.greatest(F.sum(weight), F.lit(1e-300)).alias("now")
            fitted = weighed.groupBy(name).agg(now, F.first(f"f_{name}").alias("old"), F.first(f"t_{name}").alias("share"))
            fitted = fitted.select(
                name, (F.col("old") * F.col("share") / F.col("now")).alias(f"f_{name}"), F.col("share").alias(f"t_{name}"),
                F.abs(F.col("now") / F.col("share") - 1).alias("off"),
            )
            # Not observed: an observation stays with the session, and Spark cannot send that
            # to tasks of two-class models.
            written = cut_lineage(fitted)
            factors[name], off = written.drop("off"), written.agg(F.max("off")).first()[0]
            error = max(error, off) if math.isfinite(off) else math.inf
        if error == math.inf:
            break
        still = still + 1 if abs(before - error) <= STALLED * error else 0
        # Where the error falls, it falls by a steady share each round; at this share it
        # must come down in the rounds that are left.
        if rounds >= TRIED and error > tolerance and error > before * (tolerance / error) ** (1 / max(1, max_rounds - rounds)):
            break
    factors = {n: f.drop(f"t_{n}") for n, f in factors.items()}
    mix = Mix(factors, sizes, rounds, error, total)
    if mix.error <= tolerance:
        return mix
    other = _settled(cells, targets, sizes, total, max_rounds)
    return other if other.error < mix.error else mix


def _settled(cells: DataFrame, targets: dict[str, DataFrame], sizes: dict[str, int], total: int, max_rounds: int) -> Mix:
    """The compromise between targets that contradict each other.

    All dimensions are moved at once, each by the root of target over current sum.  These
    steps end where the relative entropy between sums and targets, added over the
    dimensions, is least; taking turns would end in a cycle that meets the last dimension
    only.  Weights are scaled to the whole at the end.
    """
    names = list(targets)
    start = {n: t.select(n, F.lit(0.0).alias(f"f_{n}"), F.col("share").alias(f"t_{n}")) for n, t in targets.items()}
    mix = Mix(start, sizes, 0, math.inf, total, logs=True)

    def weighed() -> DataFrame:
        rows = cells
        for n in names:
            rows = lookup(rows, mix.factors[n], [n], known_rows=sizes[n])
        return rows.withColumn("weight", F.col("tokens") / F.lit(float(total)) * mix.rate(names))

    def step(move: float) -> float:
        rows, moved, worst = weighed(), {}, 0.0
        for n in names:
            now = F.greatest(F.sum("weight"), F.lit(1e-300)).alias("now")
            fitted = rows.groupBy(n).agg(now, F.first(f"f_{n}").alias("old"), F.first(f"t_{n}").alias("share"))
            fitted = fitted.select(
                n, (F.col("old") + F.log(F.col("share") / F.col("now")) * move).alias(f"f_{n}"), F.col("share").alias(f"t_{n}"),
                F.abs(F.col("now") / F.col("share") - 1).alias("off"),
            )
            written = cut_lineage(fitted)
            moved[n] = written.drop("off")
            worst = max(worst, written.agg(F.max("off")).first()[0])
        mix.factors = moved
        return worst

    still = 0
    while still < 3 and mix.rounds < max_rounds:
        mix.rounds += 1
        before, mix.error = mix.error, step(1 / len(names))
        still = still + 1 if abs(before - mix.error) <= STALLED * mix.error else 0
    whole = weighed().agg(F.sum("weight")).first()[0]
    first = names[0]
    mix.factors[first] = cut_lineage(mix.factors[first].withColumn(f"f_{first}", F.col(f"f_{first}") - F.lit(math.log(whole))))
    mix.error = step(0.0)
    mix.factors = {n: f.drop(f"t_{n}") for n, f in mix.factors.items()}
    return mix


def sample(docs: DataFrame, mix: Mix, margins: dict[str, Margin], tokens: Column, chosen: Column, share: float = 1.0) -> DataFrame:
    """``docs`` with ``rate`` and ``copies`` per row.

    ``rate`` is the expected number of copies of a document of its combination when
    ``share`` times all tokens are drawn at the target weights.  ``copies`` is the rate
    rounded down or up, up with the probability of its fraction: whether ``chosen``, a
    number from 0 to 1, is below it.  Expected tokens meet every target; rows without
    tokens have rate 0.  Only factor tables are joined, so no document is shuffled while they are small.
    """
    rows = docs.withColumns({n: _key(m.column) for n, m in margins.items()})
    for name in margins:
        rows = lookup(rows, mix.factors[name], [name], "left", known_rows=mix.sizes[name])
    rate = F.lit(float(share)) * mix.rate(margins)
    rows = rows.withColumn("rate", F.when(tokens > 0, rate).otherwise(0.0))
    return rows.withColumn("copies", F.floor("rate") + (chosen < F.col("rate") - F.floor("rate")).cast("long"))


def hashed_chance(value: Column) -> Column:
    """A number from 0 to 1 that only depends on the value; null counts as the text ``null``."""
    digits = F.substring(F.md5(F.coalesce(value.cast("string"), F.lit("null")).cast("binary")), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))


def mixed(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
    margins: dict[str, Margin] | None = None,
    share: float = 1.0,
) -> DataFrame:
    """All columns of ``docs``, then n_words, rate and copies under the standard mix.

    The standard mix damps sources and languages and leaves forms of text as they are;
    ``margins`` on the columns ``source``, ``lang``, ``topic`` and ``text`` replace it.
    Rates depend on nothing but source, language and form, draws on nothing but the id.
    Null sources and languages are values of their own; null and empty texts have no
    tokens, rate 0 and no copies; repeated rows are drawn alike; an empty table gives an empty table.  A column of
    the input named n_words, rate or copies is replaced.  Targets that cannot all be met give the rates that
    come closest, and the log names the error left.
    """
    keep = [c for c in docs.columns if c not in ("n_words", "rate", "copies")]
    taken, back = carried(docs, keep)
    rows = docs.select(
        *taken, F.col(f"`{doc_id}`").alias("id"), F.col(f"`{source}`").alias("source"), F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text")
    )
    rows = rows.withColumn("n_words", word_count(F.col("text")).cast("long"))
    rows = rows.withColumn("topic", text_form(F.col("text"), F.col("n_words")))
    if margins is None:
        margins = {"by_source": Margin(F.col("source"), 0.5), "by_lang": Margin(F.col("lang"), 0.7), "by_topic": Margin(F.col("topic"))}
    mix = rake(rows, margins, F.col("n_words"))
    if not mix.converged:
        LOG.warning("the targets cannot all be met: %.2g is left on a margin after %d rounds", mix.error, mix.rounds)
    return sample(rows, mix, margins, F.col("n_words"), hashed_chance(F.col("id")), share).select(*back, "n_words", "rate", "copies")
