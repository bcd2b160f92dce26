"""Mix sources to target weights by Poisson replication, with DataFrame functions only.

A source with n of N rows and target share w gets the mean repetition rate ``w * N * epochs / n``. Every row draws its
number of copies from the Poisson distribution of its source's rate: the distribution function is inverted at a uniform
number that comes from a hash of the seed and the row's id, so a run can be repeated, and a recomputed task gives the same
copies. Rows are exploded by their number, and dealt out by a hash of id and copy, in whose order each partition stands:
that is the global shuffle.

Without given weights, a source's share follows ``n ** power`` (0.5: large sources are damped, small ones repeated).

Defined results: a null source is a source of its own. A source without a given weight has weight zero. A row without
``doc_id`` draws by its text. Repeated rows draw alike. No rows give no rows. All columns are kept; ``copy`` (from 1) and
``shuffle_key`` are added, and replace columns of those names; without ``counted`` the columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.llm.common import shuffle_parts, stored, whole_text

TAIL = 40  # terms of the distribution beyond the rate and twelve deviations; what is left is below 2 ** -52


def uniform(key: Column) -> Column:
    """A number from 0 up to 1, of 52 bits, from the MD5 of a text."""
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def target_rates(docs: DataFrame, weights: dict[str | None, float] | None, power: float, epochs: float) -> DataFrame:
    """One row per source: its number of rows and its mean repetition rate."""
    sizes = docs.groupBy(F.col("source").cast("string").alias("source")).agg(F.count("*").alias("n"))
    weight = F.pow(F.col("n").cast("double"), F.lit(power))
    if weights is not None:
        weight = F.lit(0.0)
        for source, w in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(source)), F.lit(float(w))).otherwise(weight)
    sizes = stored(sizes.withColumn("weight", weight), "mix-sizes")
    sums = sizes.agg(F.sum("n").alias("n"), F.sum("weight").alias("weight")).first()
    scale = F.lit(float(epochs) * (sums["n"] or 0) / sums["weight"]) if sums["weight"] else F.lit(0.0)
    return sizes.select("source", "n", (F.col("weight") * scale / F.col("n")).alias("rate"))


def distributions(rates: DataFrame) -> DataFrame:
    """The distribution function of each source's rate, at 0, 1, 2 and so on, as an array."""
    last = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + TAIL).cast("int")
    terms = rates.withColumn("k", F.explode(F.sequence(F.lit(0), last)))
    upto = Window.partitionBy("source").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    step = F.when((F.col("k") == 0) | (F.col("rate") <= 0), F.lit(0.0)).otherwise(F.ln(F.col("rate") / F.col("k")))
    terms = terms.withColumn("log_term", F.sum(step).over(upto) - F.col("rate"))
    term = F.when((F.col("rate") > 0) | (F.col("k") == 0), F.exp("log_term")).otherwise(F.lit(0.0))
    terms = terms.withColumn("below", F.sum(term).over(upto))
    return terms.groupBy("source").agg(F.array_sort(F.collect_list("below")).alias("cdf"))


def poisson_mix(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    power: float = 0.5,
    epochs: float = 1.0,
    seed: str = "mix",
    counted: bool = True,
) -> DataFrame:
    """Every row as often as it is drawn, in random order; with ``counted``, its copies are numbered."""
    docs = docs.drop("copy", "shuffle_key") if counted else docs
    names = docs.columns
    cdfs = stored(distributions(target_rates(docs, weights, power, epochs)), "mix-rates")
    cdfs = cdfs.select(F.col("source").alias("mix_source"), F.col("cdf").alias("mix_cdf"))
    row = F.coalesce(F.col("doc_id").cast("string"), F.md5(whole_text()))
    keyed = docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("doc"), row.alias("mix_row"), "source")
    keyed = keyed.withColumnRenamed("source", "doc_source")
    joined = keyed.join(cdfs, F.col("doc_source").cast("string").eqNullSafe(F.col("mix_source")))
    draw = uniform(F.concat(F.lit(f"{seed}:"), F.col("mix_row")))
    count = F.size(F.filter(F.col("mix_cdf"), lambda below: below <= F.col("mix_draw")))
    drawn = joined.withColumn("mix_draw", draw).select("doc", "mix_row", count.alias("mix_n"))
    copies = drawn.filter("mix_n > 0").select("doc", "mix_row", F.explode(F.sequence(F.lit(1), "mix_n")).alias("copy"))
    key = F.md5(F.concat_ws(":", F.lit(seed), F.col("mix_row"), F.col("copy").cast("string")))
    dealt = copies.select("doc", "copy", key.alias("shuffle_key"))
    dealt = dealt.repartition(shuffle_parts(docs.sparkSession), "shuffle_key").sortWithinPartitions("shuffle_key")
    return dealt.select("doc.*", "copy", "shuffle_key") if counted else dealt.select("doc.*")
