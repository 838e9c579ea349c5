"""Mixing sources to target weights as a time-varying curriculum, in DataFrame functions only.

Targets. Source k (by code point, null last) weighs 3, 1, 2, repeating. All sources share ``share`` times all sizes by
weight; none gets more than ``most`` times its own size. The excess goes to the others by weight until none is above:
target = min(most * size, weight * level), and the level follows from prefix sums over sources in the order of
most * size / weight.

Schedule. A source's rate at training time t in [0, 1] is its target times (1 + slope * (2t - 1)); slopes fall from
``slope`` (first weight class) to -slope (last). Integrated, the cumulative demand is target * (t + slope * (t^2 - t)).
A source's documents stand in the order of a hash (the first 60 bits of an MD5, so that any SQL engine agrees), pass after pass; the word in the middle of a document's first taken
pass has a rank u (its share of the target), and inverting the demand gives the document's training position t. Rows are
range-sorted by position.

Prefix sums over a source's documents are taken in two levels: the hash order is cut into buckets of a bounded expected
number of documents, so that no task holds a whole source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import quoted, written

#: Weights of sources in turn.
WEIGHTS = (3, 1, 2)
SHARE, MOST, SLOPE, BUCKET_ROWS = 1.5, 2.0, 0.5, 4096
#: A word of a text.
WORD = r"[^\x20\x09-\x0D]+"
#: Hexadecimal digits of the MD5 that orders documents.
DIGITS = 15


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row a source (src, source_size, docs) to its target: source_size, docs, turn, target. A source of no words gets 0."""
    alone = Window.orderBy(F.col("src").asc_nulls_last())
    turn = (F.row_number().over(alone) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int") + 1)
    t = sizes.withColumn("turn", turn).withColumn("weight", weight).withColumn("cap", F.lit(most) * F.col("source_size"))
    by = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("src").asc_nulls_last())
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = (
        t.withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", (F.lit(share) * F.sum("source_size").over(every) - F.col("capped")) / F.col("open"))
    )
    # the first source, in this order, that the level leaves below its cap is where the level holds
    holds = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(every)
    level = holds.getField("level")
    return t.withColumn("target", F.coalesce(F.least(F.col("cap"), level * F.col("weight")), F.col("cap"))).select("src", "source_size", "docs", "turn", "target")


def mix(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", share: float = SHARE, most: float = MOST, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, size, source_size, target, taken, position of every row, sorted by position.

    Size: words of the text; null text and a text of white space have 0. taken: the words of the document that the mix
    takes; a source's sum to its target, rounded to a word. A document that the target's end falls into is taken in part. A null
    source is a source of its own; null ids take part; equal rows share what they get in any order; rows of size 0 get
    taken 0 and a null position; an empty table gives no rows. Other columns are not read. Reruns agree: the order is that of
    a hash of id and size, then id, then size.
    """
    docs = written(sized(df, doc_id, text, source))
    out = planned(docs, docs, share, most, bucket_rows).drop("src")
    return out.orderBy(F.col("position").asc_nulls_last(), F.col("doc_id").asc_nulls_last())


def sized(df: DataFrame, doc_id: str, text: str, source: str, *more) -> DataFrame:
    """doc_id, src, size, h (the order's hash) and ``more`` columns."""
    size = F.coalesce(F.regexp_count(F.col(quoted(text)), F.lit(WORD)), F.lit(0)).cast("long")
    docs = df.select(F.col(quoted(doc_id)).alias("doc_id"), F.col(quoted(source)).cast("string").alias("src"), size.alias("size"), *more)
    digest = F.md5(F.concat_ws("|", F.col("doc_id").cast("string"), F.col("size").cast("string")).cast("binary"))
    return docs.withColumn("h", F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("long"))


def planned(docs: DataFrame, narrow: DataFrame, share: float, most: float, bucket_rows: int) -> DataFrame:
    """``docs`` (of sized()) with source_size, target, taken and position, unsorted. ``narrow`` has the same rows, without further columns."""
    sources = narrow.groupBy("src").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    t = source_targets(sources, share=share, most=most).withColumnRenamed("src", "tsrc")

    same = lambda a, b: a.eqNullSafe(b)
    buckets = F.greatest(F.ceil(F.col("docs") / bucket_rows), F.lit(1)).cast("long")
    # the hash's order is kept: equal parts of its range
    bucket = F.floor(F.col("h").cast("double") / F.lit(16.0**DIGITS) * buckets).cast("long")

    def bucketed(rows: DataFrame) -> DataFrame:
        return rows.join(t, same(F.col("src"), F.col("tsrc")), "left").withColumn("bucket", F.least(bucket, buckets - 1)).drop("tsrc")

    sums = bucketed(narrow).groupBy("src", "bucket").agg(F.sum("size").alias("words"))
    prior = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("src").alias("ssrc"), F.col("bucket").alias("sbucket"), F.coalesce(F.sum("words").over(prior), F.lit(0)).alias("prior"))
    own = Window.partitionBy("src", "bucket").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    j = bucketed(docs).withColumn("within", F.coalesce(F.sum("size").over(own), F.lit(0)))
    j = j.join(sums, same(F.col("src"), F.col("ssrc")) & (F.col("bucket") == F.col("sbucket")), "left")

    start, end = F.col("prior") + F.col("within"), F.col("prior") + F.col("within") + F.col("size")
    words = F.round("target").cast("long")  # the mix takes the words [0, words) of the source repeated
    taken = F.lit(0).cast("long")
    for k in range(int(most) + 1):
        a, b = start + F.col("source_size") * k, end + F.col("source_size") * k
        taken = taken + F.greatest(F.least(b, words) - a, F.lit(0))
    j = j.withColumn("taken", F.least(taken, (F.lit(most) * F.col("size")).cast("long")))
    u = F.when((F.col("taken") > 0) & (F.col("target") > 0), F.least((start + F.col("size") / 2) / F.col("target"), F.lit(1.0)))
    a = F.lit(SLOPE) * (1 - F.col("turn"))  # 1, 0, -1 for the three turns
    # a t^2 + (1 - a) t = u
    root = (2 * u) / ((1 - a) + F.sqrt((1 - a) * (1 - a) + 4 * a * u))
    more = [c for c in docs.columns if c not in ("doc_id", "src", "size", "h")]
    return j.select("doc_id", "src", "size", "source_size", "target", "taken", root.alias("position"), *more)


def mixed_rows(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The rows of ``df``, all columns, in training order, each once for each pass that takes words of it; a part counts as a whole.

    Rows that the mix takes nothing of (and rows of size 0) go. Each row has its own decision, rows equal in id, source and size
    too. An empty table gives no rows. The rows travel with their decision, so no join brings the texts back.
    """
    names = df.columns
    narrow = written(sized(df, doc_id, text, source))
    docs = sized(df, doc_id, text, source, F.struct(*[F.col(quoted(c)) for c in names]).alias("row"))
    chosen = planned(docs, narrow, SHARE, MOST, bucket_rows).where("taken > 0")
    copies = F.ceil(F.col("taken") / F.col("size")).cast("int")
    out = chosen.withColumn("turn", F.explode(F.sequence(F.lit(1), copies)))
    return out.orderBy(F.col("turn"), F.col("position"), F.col("doc_id").asc_nulls_last()).select(*[F.col("row")[c].alias(c) for c in names])


#: DuckDB's SQL for the rows of the registered query.
MIX_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS turn FROM docs GROUP BY source),
weighed AS (
  SELECT *, CASE turn WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0 ELSE 2.0 END AS weight, 2.0::DOUBLE * source_size AS cap FROM sources),
levels AS (
  SELECT a.cap / a.weight AS reach,
    (1.5::DOUBLE * (SELECT sum(source_size) FROM weighed) - coalesce(sum(b.cap) FILTER (b.cap / b.weight < a.cap / a.weight), 0))
      / sum(b.weight) FILTER (b.cap / b.weight >= a.cap / a.weight) AS level
  FROM weighed a, weighed b GROUP BY a.source, a.cap, a.weight),
water AS (SELECT arg_min(level, reach) AS level FROM levels WHERE level <= reach),
targets AS (SELECT source, source_size, turn, coalesce(least(cap, weight * (SELECT level FROM water)), cap) AS target FROM weighed),
placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.turn,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY substr(md5(concat_ws('|', d.doc_id::VARCHAR, d.size::VARCHAR)), 1, 15), d.doc_id, d.size ROWS UNBOUNDED PRECEDING)::BIGINT - d.size AS start
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
counted AS (
  SELECT *, least(2 * size, greatest(least(start + size, round(target)::BIGINT) - start, 0)
    + greatest(least(start + size + source_size, round(target)::BIGINT) - start - source_size, 0))::BIGINT AS taken FROM placed),
ranked AS (SELECT *, 0.5 * (1 - turn) AS a, CASE WHEN taken > 0 AND target > 0 THEN least((start + size / 2.0) / target, 1.0) END::DOUBLE AS u FROM counted)
SELECT doc_id, size, source_size, round(target, 6) AS target, taken,
  round((2 * u) / ((1 - a::DOUBLE) + sqrt((1 - a::DOUBLE) * (1 - a::DOUBLE) + 4 * a::DOUBLE * u)), 6) AS position
FROM ranked"""
