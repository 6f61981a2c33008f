"""Mixing sources to target weights by Poisson replication.

A source's repetition rate is its target share of the corpus over its
actual share. Each document draws its number of copies by inverting the
Poisson distribution with that mean at a uniform number from a hash of its
id and text, so a rerun or a lost executor draws the same. Copies are exploded and
dealt to partitions, and ordered in them, by a hash. DataFrame functions
only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortgrid.llm.storage import written


#: Values of a block of a distribution function.
BLOCK = 64


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from 52 bits of the parts' digest."""
    digest = F.md5(F.concat_ws(":", *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson_cdfs(rates: DataFrame) -> DataFrame:
    """(source, rate, cdf, marks): the distribution function at 0, 1, ... as
    an array, so far that the rest is under one part in 2**52 (12 deviations
    and 40 terms), and its value at the end of each block of ``BLOCK``. The
    terms of a source are rows, summed up in order; there are some 13 times
    the root of its rate more of them than its rate."""
    last = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 40).cast("long")
    terms = rates.select("source", "rate", F.explode(F.sequence(F.lit(0).cast("long"), F.when(F.col("rate") > 0, last).otherwise(F.lit(0).cast("long")))).alias("k"))
    so_far = W.partitionBy("source").orderBy("k").rowsBetween(W.unboundedPreceding, W.currentRow)
    log_factorial = F.sum(F.log(F.greatest("k", F.lit(1)).cast("double"))).over(so_far)
    log_rate = F.log(F.when(F.col("rate") > 0, F.col("rate")).otherwise(1.0))
    terms = terms.withColumn("p", F.exp(F.col("k") * log_rate - F.col("rate") - log_factorial))
    # Rounding leaves the sum of a large rate's terms a little off 1.
    terms = terms.withColumn("c", F.sum("p").over(so_far))
    terms = terms.withColumn("c", F.col("c") / F.max("c").over(W.partitionBy("source")))
    cdf = F.transform(F.array_sort(F.collect_list(F.struct("k", "c"))), lambda t: t["c"])
    tables = terms.groupBy("source").agg(F.first("rate").alias("rate"), cdf.alias("cdf"))
    ends = F.sequence(F.lit(BLOCK), F.ceil(F.size("cdf") / BLOCK).cast("int") * BLOCK, F.lit(BLOCK))
    return tables.withColumn("marks", F.transform(ends, lambda at: F.element_at("cdf", F.least(at, F.size("cdf")))))


def inverted(cdf: str, marks: str, u: Column) -> Column:
    """How many values of ``cdf`` are at most ``u``: first by blocks, then
    within one."""
    whole = F.size(F.filter(marks, lambda c: c <= u)) * BLOCK
    return F.least(whole + F.size(F.filter(F.slice(cdf, whole + 1, F.lit(BLOCK)), lambda c: c <= u)), F.size(cdf)).cast("long")


def source_sizes(docs: DataFrame, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(source, size): characters of all of a source's texts."""
    return docs.groupBy(F.col(source_col).cast("string").alias("source")).agg(F.sum(F.coalesce(F.length(text_col), F.lit(0))).cast("double").alias("size"))


def repetition_rates(sizes: DataFrame, targets: DataFrame, epochs: float = 1.0) -> DataFrame:
    """(source, rate): the mean number of copies of a source's documents.
    Over the sources that ``targets`` (source, weight) lists, sizes times
    rates are in proportion to the weights and sum up to ``epochs`` times
    their size. A source it does not list, or without text, repeats
    ``epochs`` times."""
    wanted = targets.select(F.col("source").cast("string").alias("target"), F.col("weight").cast("double").alias("weight"))
    both = sizes.join(wanted, F.col("source").eqNullSafe(F.col("target")), "left").withColumn("listed", F.col("weight").isNotNull() & (F.col("size") > 0))
    all_size = both.filter("listed").agg(F.sum("size")).scalar()
    all_weight = both.filter("listed").agg(F.sum("weight")).scalar()
    rate = F.col("weight") / all_weight * all_size / F.col("size") * epochs
    return both.select("source", F.when(F.col("listed") & (all_weight > 0), rate).otherwise(F.lit(float(epochs))).alias("rate"))


def mix_sources(docs: DataFrame, targets: DataFrame, epochs: float = 1.0, seed: int = 0, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The documents' copies in random order: every input column, then
    ``mix_copy`` (1, 2, ... of its document). A row that draws 0 is not in
    the result.

    A row draws by its id and a digest of its text, so rows of one id draw
    apart unless they are the same text; repeated rows draw the same number
    each. A null source is a source of its own; a null text has no characters
    and a null id no name. An input column named ``mix_copy`` is replaced, all
    others stay; an empty table gives no rows.
    """
    sizes = source_sizes(docs, source_col, text_col)
    tables = poisson_cdfs(repetition_rates(sizes, targets, epochs)).select(F.col("source").alias("of"), "cdf", "marks")
    # Written, so that its size is known: small tables are broadcast by Spark's own threshold, and documents are not shuffled by source.
    tables = written(tables, "mix-rates")
    # The input row is one column, so that its names meet no others.
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "mix_copy")).alias("row")
    text = F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = docs.select(row, F.col(source_col).cast("string").alias("source"), F.concat_ws(":", F.col(id_col).cast("string"), text).alias("name"))
    drawn = rows.join(tables, F.col("source").eqNullSafe(F.col("of")))
    counted = drawn.select("row", "name", inverted("cdf", "marks", uniform(F.lit(str(seed)), F.col("name"))).alias("copies"))
    copies = counted.filter("copies > 0").select("row", "name", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("mix_copy"))
    key = F.md5(F.concat_ws(":", F.lit(f"{seed}:order"), F.col("name"), F.col("mix_copy").cast("string")))
    return copies.withColumn("key", key).repartition("key").sortWithinPartitions("key").select("row.*", "mix_copy")
