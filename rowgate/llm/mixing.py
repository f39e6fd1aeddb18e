"""Mixing sources to target weights by Poisson replication.

Every source has a mean repetition rate: its target share of the mixture over
its share of the corpus. Every document draws its number of copies from the
Poisson distribution with that mean by inverting it at a uniform number hashed
from a seed and the document's id, so a rerun draws the same. The copies are then
dealt out by a hash of seed, id and copy number, which mixes them globally.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowgate.llm.frames import joined, read, text_of, with_columns, written

SEED = "mix-1"
# Target share of a source: its bytes to this power, normalised.
TEMPERATURE = 0.7
# Rates above this are drawn as sums of Poisson numbers with smaller means,
# since exp(-rate) would vanish.
LARGEST_RATE = 200.0


def tempered_rates(docs: DataFrame, power: float = TEMPERATURE) -> DataFrame:
    """(source, rate) that give sources weights by ``bytes ** power``.

    The mixture has as many bytes in expectation as the corpus. A null source is
    a source; one without any bytes keeps rate 1.
    """
    sizes = docs.groupBy("source").agg(
        F.sum(F.octet_length(text_of()).cast("double")).alias("bytes")
    )
    weights = sizes.select("source", "bytes", F.pow("bytes", F.lit(power)).alias("weight"))
    return rates_for(sizes, weights.select("source", "weight"))


def rates_for(sizes: DataFrame, weights: DataFrame) -> DataFrame:
    """(source, rate) from (source, bytes) and (source, weight).

    A source without bytes has rate 1, as have all where no weight is above 0. Two
    totals reach the driver.
    """
    both = sizes.alias("s").join(
        weights.alias("w"), F.col("s.source").eqNullSafe(F.col("w.source")), "left"
    ).select("s.source", "s.bytes", F.coalesce("w.weight", F.lit(0.0)).alias("weight"))
    totals = both.agg(F.sum("bytes"), F.sum("weight")).first()
    if not totals[1]:
        return both.select("source", F.lit(1.0).alias("rate"))
    rate = F.col("weight") / F.lit(totals[1]) * F.lit(totals[0]) / F.col("bytes")
    return both.select(
        "source", F.when(F.col("bytes") > 0, rate).otherwise(F.lit(1.0)).alias("rate")
    )


def uniform(seed: str, *parts: Column) -> Column:
    """A number in (0, 1) hashed from the parts: 52 bits of their MD5."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), *parts))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def poisson_quantile(u: Column, rate: Column) -> Column:
    """The number of k from 0 whose cumulative Poisson probability is at most u."""
    tail = F.ceil(rate + 12 * F.sqrt(rate) + 40).cast("int")
    first = F.exp(-rate)
    start = F.struct(F.lit(0).alias("k"), first.alias("term"), first.alias("below"))

    def step(state: Column, k: Column) -> Column:
        term = state["term"] * rate / k
        more = F.struct(k.alias("k"), term.alias("term"), (state["below"] + term).alias("below"))
        return F.when(state["below"] <= u, more).otherwise(state)

    return F.aggregate(F.sequence(F.lit(1), tail), start, step, lambda s: s["k"])


def copies(seed: str, key: Column, rate: Column) -> Column:
    """Poisson number of copies of the document ``key``, drawn from its hash."""
    parts = F.greatest(F.ceil(rate / LARGEST_RATE), F.lit(1)).cast("int")
    draws = F.transform(
        F.sequence(F.lit(0), parts - 1),
        lambda i: poisson_quantile(uniform(seed, key, i.cast("string")), rate / parts),
    )
    return F.aggregate(draws, F.lit(0), lambda total, k: total + k)


def mixed(
    docs: DataFrame, rates: DataFrame, key: str = "doc_id", seed: str = SEED
) -> DataFrame:
    """``docs`` replicated by (source, rate) and shuffled globally.

    Adds ``copy`` (from 0) and ``shuffle_key``; columns of ``docs`` with these
    names give way. A source without a rate is not drawn. The rates are joined by
    broadcast while they are few; the documents are shuffled once, by a key that
    no source or document dominates, and lie in the key's order.
    """
    named = rates.select(F.col("source").alias("of"), "rate")
    taken = {"copy", "shuffle_key"}
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c.lower() not in taken))
    id_text = F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("null"))
    # Packed rows, so that their columns may have any names.
    packed = docs.select(row.alias("row"), F.col("source"), id_text.alias("id"))
    drawn = joined(packed, named, F.col("source").eqNullSafe(F.col("of")))
    number = copies(seed, F.col("id"), F.col("rate"))
    drawn = drawn.select("row", "id", number.alias("copies")).filter("copies > 0")
    out = drawn.select("row", "id", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
    place = F.md5(F.concat_ws(":", F.lit(seed), F.lit("place"), F.col("id"), F.col("copy")))
    out = out.select("row.*", "copy", place.alias("shuffle_key"))
    return out.repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def op5_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, whole, replicated to tempered source weights and shuffled.

    Null texts count no bytes; a null source is a source; a repeated row is drawn
    like its twin; an empty table gives no rows.
    """
    docs = read(spark, sf_dir, "documents")
    rates = written(tempered_rates(docs), "rates")
    return mixed(docs.select("doc_id", "source", "lang", "n_chars", "text"), rates)


OP5_SQL = f"""
WITH sizes AS (
  SELECT source, sum(strlen(coalesce(text, ''))::DOUBLE) AS bytes FROM documents GROUP BY source
), rates AS (
  SELECT source, CASE WHEN bytes > 0 THEN pow(bytes, {TEMPERATURE})
    / (SELECT sum(pow(bytes, {TEMPERATURE})) FROM sizes)
    * (SELECT sum(bytes) FROM sizes) / bytes ELSE 1.0 END AS rate
  FROM sizes
), split AS (
  SELECT source, rate, greatest(ceil(rate / {LARGEST_RATE}), 1)::INT AS parts FROM rates
), terms AS (
  SELECT source, parts, k,
    exp(-rate / parts + CASE WHEN k = 0 THEN 0 ELSE k * ln(rate / parts) END - lgamma(k + 1)) AS term
  FROM split, range(0, 600) AS t(k)
), below AS (
  SELECT source, k, sum(term) OVER (PARTITION BY source ORDER BY k) AS cumulative FROM terms
), draws AS (
  SELECT d.doc_id, d.source, d.lang, d.n_chars, d.text, p.i,
    (('0x' || substr(md5('{SEED}:' || coalesce(d.doc_id::VARCHAR, 'null') || ':' || p.i), 1, 13))
      ::BIGINT::DOUBLE + 0.5) / {float(1 << 52)!r} AS u
  FROM documents d JOIN split s ON d.source IS NOT DISTINCT FROM s.source,
    LATERAL (SELECT unnest(range(0, s.parts)) AS i) p
), counted AS (
  SELECT doc_id, d.source, lang, n_chars, text, count(b.k) AS copies
  FROM draws d LEFT JOIN below b ON d.source IS NOT DISTINCT FROM b.source AND b.cumulative <= d.u
  GROUP BY ALL
)
SELECT doc_id, source, lang, n_chars, text, c::INT AS copy,
  md5('{SEED}:place:' || coalesce(doc_id::VARCHAR, 'null') || ':' || c) AS shuffle_key
FROM counted, LATERAL (SELECT unnest(range(0, copies)) AS c)
"""

QUERIES = {"op5_poisson_mixing": op5_poisson_mixing}
SQL = {"op5_poisson_mixing": OP5_SQL}
