"""Mix sources to target weights by Poisson replication.

Each document of source s is wanted ``rate(s)`` times on average, where

    rate(s) = weight(s) / sum of weights * total / size(s)

with sizes in documents and ``total`` the number of documents wanted (as many as there are, if not
given). A uniform draw from the hash of (seed, id) is put through the inverse of the Poisson
distribution with that mean; the count it gives is how often the document is emitted. A pure
function of the row and the rates: no state, no order, the same result on any partitioning.

The inverse is tabulated per source until the remaining probability is far below the resolution of
a draw, so no count is cut off. There is one table row per weighted source, a number bounded by
the ``weights`` argument and not by the data; the rows are literals of the plan. A mean above
``MAX_RATE`` is split into equal parts of at most that: the count is then the sum of independent
draws, from the hashes of (seed, id) and (seed, part, id), which has the same distribution.

Defined results: all sources without a weight, a null source included, form one group of weight
``other`` (0 unless given); a group of weight 0 gives no row. With ``other=None`` that group keeps its
share of the table (rate 1 for the default total) and the weights share the rest. Rows with equal ids draw alike, so
repeated rows stay equally repeated. A null id draws as the word null. An empty table gives an
empty one. A document may be repeated any number of times: copies are dealt out in two steps, so
those of one document are not one task. If a column is called like an added one, the added one gets a number.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import quoted, unit_draw

MAX_RATE = 600.0  # of one draw; not far beyond it exp(-rate) leaves the range of doubles
#: Copies of a document that one row makes; more of them are dealt out first, so many to a row.
COPIES = 1024


def poisson_steps(rate: float) -> list[float]:
    """P(N <= 0), P(N <= 1), .. until the mass beyond is under 2^-60 (Chernoff bound)."""
    if rate == 0:
        return [1.0]
    term, total, out, k = math.exp(-rate), 0.0, [], 0
    while True:
        total += term
        out.append(total)
        k += 1
        term *= rate / k
        if k > rate and k * math.log(k / (math.e * rate)) + rate > 60 * math.log(2):
            return out


def source_rates(
    docs: DataFrame, weights: dict[str, float], source: str, total: int | None = None, other: float | None = 0.0,
    most: float = MAX_RATE,
) -> dict[str | None, float]:
    """Mean repetitions per weighted source; None stands for all others. A rate above ``most`` is an error.

    One small aggregate over the source column; at most ``len(weights) + 1`` rows reach the driver.
    """
    group = F.when(F.col(source).isin(*weights), F.col(source)) if weights else F.lit(None).cast("string")
    sizes = {r["s"]: r["n"] for r in docs.groupBy(group.alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()}
    wanted = {s: w for s, w in {**weights, None: other or 0.0}.items() if w > 0 and sizes.get(s)}
    rows = sum(sizes.values())
    total = rows if total is None else total
    norm = sum(wanted.values())
    natural = other is None and sizes.get(None)
    shared = total * (rows - sizes[None]) / rows if natural else total
    rates = {s: w / norm * shared / sizes[s] for s, w in wanted.items()}
    if natural:
        rates[None] = total / rows
    if any(r > most for r in rates.values()):
        raise ValueError(f"a source would be repeated more than {most:.0f} times on average: {rates}")
    return rates


def copies_of(seed: str, ident: Column, source: Column, rates: dict[str | None, float], weights: dict[str, float]) -> Column:
    """Number of copies: how many steps of the source's distribution lie at or below the draw, summed over the parts."""

    def count(rate: float) -> Column:
        parts = max(math.ceil(rate / MAX_RATE), 1)
        steps = F.array(*[F.lit(x) for x in poisson_steps(rate / parts)])
        below = lambda draw: F.size(F.filter(steps, lambda x: x <= draw))
        first = below(unit_draw(F.concat(F.lit(f"{seed}|"), ident)))
        if parts == 1:
            return first
        drawn = lambda k: below(unit_draw(F.concat(F.lit(f"{seed}|"), k.cast("string"), F.lit("|"), ident)))
        return F.aggregate(F.sequence(F.lit(1), F.lit(parts - 1)), first, lambda n, k: n + drawn(k))

    chain = F
    for name in weights:
        chain = chain.when(source == name, count(rates[name]) if name in rates else F.lit(0))
    rest = count(rates[None]) if None in rates else F.lit(0)
    return chain.otherwise(rest) if weights else rest


def most_copies(rates: dict[str | None, float]) -> int:
    """More than any draw gives: the steps of the tables, over all their parts."""
    parts = {r: max(math.ceil(r / MAX_RATE), 1) for r in rates.values()}
    return max((n * len(poisson_steps(r / n)) for r, n in parts.items()), default=0)


def free_name(names: list[str], wanted: str) -> str:
    taken = {n.lower() for n in names}
    return next(n for n in (wanted, *(f"{wanted}_{i}" for i in range(1, len(taken) + 2))) if n not in taken)


def exploded(docs: DataFrame, count: Column, copy: str, ident: Column, many: bool) -> DataFrame:
    """Each row ``count`` times, numbered by ``copy`` from 0.

    With ``many`` a row becomes one row per ``COPIES`` copies first. These are dealt out before they become
    the copies, so the copies of a rare source's document are as many tasks as there are.
    """
    if not many:
        return docs.select("*", F.explode(F.when(count > 0, F.sequence(F.lit(0), count - 1))).alias(copy))
    names = [*docs.columns]
    total, begin = (free_name(names, n) for n in ("copies", "first_copy"))
    some = docs.withColumn(total, count).where(F.col(total) > 0)
    few = some.where(F.col(total) <= COPIES).withColumn(begin, F.lit(0))
    begins = F.sequence(F.lit(0), F.col(total) - 1, F.lit(COPIES))
    rest = some.where(F.col(total) > COPIES).withColumn(begin, F.explode(begins))
    rest = rest.repartition(F.col(begin), ident)
    last = F.least(F.col(begin) + COPIES, F.col(total)) - 1
    kept = [F.col(quoted(n)) for n in names]
    return few.unionByName(rest).select(*kept, F.explode(F.sequence(F.col(begin), last)).alias(copy))


def mix_sources(
    docs: DataFrame, weights: dict[str, float], seed: str = "mix-1", source: str = "source",
    id_column: str = "doc_id", total: int | None = None, other: float | None = 0.0, partitions: int | None = None,
) -> DataFrame:
    """The documents' columns plus ``copy`` (from 0) and ``mix_key``; rows in random order.

    Every copy has its own hash key. Rows are dealt to partitions by it and sorted by it within
    them: a uniform shuffle of the whole table in one exchange, whatever the hot source.
    """
    copy, key = free_name(docs.columns, "copy"), free_name(docs.columns, "mix_key")
    rates = source_rates(docs, weights, source, total, other, most=math.inf)
    ident = F.coalesce(F.col(id_column).cast("string"), F.lit("null"))
    count = copies_of(seed, ident, F.col(source), rates, weights)
    counted = exploded(docs, count, copy, ident, most_copies(rates) > COPIES)
    keyed = counted.withColumn(key, F.md5(F.concat_ws("|", F.lit(seed), ident, F.col(copy).cast("string"))))
    dealt = keyed.repartition(partitions, key) if partitions else keyed.repartition(key)
    return dealt.sortWithinPartitions(key)
