"""Mixing sources to target weights by a low-discrepancy source schedule.

Every source is a stream of words: its documents in shuffled order, repeated up to `MAX_REPEATS` times and
cut into blocks of `block_words`. A source is owed as many slots of the schedule as its target has blocks.
The schedule walks the van der Corput sequence: slot i looks at the point whose binary digits are those of
i mirrored, finds the point's source in the cumulative slots owed, and takes that source's next block.
Points are spread evenly, so any stretch of the schedule holds each source in about its share, and each
source gets its slots exactly: the words taken are its target, rounded.

Everything is a join, a window or a grouping. Ranks within a source, however large, are made in two
steps (totals of small buckets, then within a bucket), so no task holds a whole source.

Defined cases: a NULL or empty text has no words and takes 0; a NULL source is a source of its own, after
all others; rows that repeat an id are separate documents; an empty table gives no rows; other columns of
the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfstrata.llm.common import checkpoint, table

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK_WORDS = 64
#: Hex digits of the shuffling key that name a bucket; results do not depend on it.
BUCKET_DIGITS = 3
#: Schedule positions that are laid out and ranked together; results do not depend on it.
RANK_RUN = 16_384

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and the key by which documents are shuffled."""
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.md5(ident.cast("binary")).alias("shuffle"))


def source_targets(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """A row per source: source_no, source_size, weight, target.

    The water level is found in one ordered pass over the sources (a row each): those whose limit is below
    their share at the level of all smaller ones are capped, and the others share the rest by weight.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    by_limit = W.orderBy(F.col("source_size") / F.col("weight"), "source_no").rowsBetween(W.unboundedPreceding, -1)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing).orderBy("source_no")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("source_no") % len(weights) + 1)
    limit = F.col("source_size") * repeats
    sources = documents.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = sources.withColumn("source_no", F.row_number().over(by_name) - 1).withColumn("weight", weight)
    sources = sources.withColumns(
        {
            "words_left": F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(by_limit), F.lit(0)),
            "weight_left": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_limit), F.lit(0)),
        }
    )
    sources = sources.withColumn("capped", limit * F.col("weight_left") <= F.col("weight") * F.col("words_left"))
    open_words = F.max(F.when(~F.col("capped"), F.col("words_left"))).over(everything)
    open_weight = F.max(F.when(~F.col("capped"), F.col("weight_left"))).over(everything)
    share = F.col("weight").cast("double") * open_words.cast("double") / open_weight.cast("double")
    target = F.when(F.col("capped"), limit.cast("double")).otherwise(share)
    return sources.withColumn("target", target).select("source", "source_no", "source_size", "weight", "target")


def placed(documents: DataFrame, targets: DataFrame) -> DataFrame:
    """Documents with the position of their first word in the shuffled stream of their source."""
    bucketed = documents.withColumn("bucket", F.substring("shuffle", 1, BUCKET_DIGITS))
    totals = bucketed.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    before = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select("source", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("bucket_start"))
    totals = totals.join(targets, totals.source.eqNullSafe(targets.source)).drop(targets.source)
    within = W.partitionBy("source_no", "bucket").orderBy("shuffle", "size").rowsBetween(W.unboundedPreceding, -1)
    joined = bucketed.alias("d").join(
        totals.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")) & (F.col("d.bucket") == F.col("t.bucket"))
    )
    joined = joined.select("doc_id", "size", "shuffle", "d.bucket", "bucket_start", "source_no", "source_size", "target")
    start = F.col("bucket_start") + F.coalesce(F.sum("size").over(within), F.lit(0))
    return joined.withColumn("start", start).drop("bucket", "bucket_start", "shuffle")


def schedule(targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """A row per filled slot: slot, source_no, block (the rank of the slot among those of its source)."""
    owed = targets.withColumn("slots", F.ceil(F.round("target") / block_words).cast("long"))
    cumulative = W.orderBy("source_no").rowsBetween(W.unboundedPreceding, -1)
    owed = owed.withColumn("first", F.coalesce(F.sum("slots").over(cumulative), F.lit(0)))
    total = owed.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    digits = max(1, (total - 1).bit_length()) if total else 1
    # Mirroring is its own inverse, so a source's points lead straight to its slots. They are laid out in
    # runs first, or one task would lay out all of a large source.
    owed = owed.where("slots > 0").withColumn("end", F.col("first") + F.col("slots") - 1)
    runs = owed.select("source_no", "end", F.explode(F.sequence("first", "end", F.lit(RANK_RUN))).alias("from"))
    runs = runs.repartition(max(1, min(total // RANK_RUN, 10_000)))
    points = runs.select("source_no", F.explode(F.sequence("from", F.least("end", F.col("from") + RANK_RUN - 1))).alias("point"))
    mirrored = F.conv(F.reverse(F.lpad(F.bin("point"), digits, "0")), 2, 10).cast("long")
    slots = points.select("source_no", mirrored.alias("slot"))
    slots = slots.withColumn("run", F.floor(F.col("slot") / RANK_RUN))
    runs = slots.groupBy("source_no", "run").count()
    earlier = W.partitionBy("source_no").orderBy("run").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.select("source_no", "run", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("ranked"))
    rank = F.row_number().over(W.partitionBy("source_no", "run").orderBy("slot")) - 1
    # Sizes that are estimated from the few sources are far too small here: without the hint, all slots
    # would be broadcast.
    return slots.hint("merge").join(runs, ["source_no", "run"]).select("slot", "source_no", (F.col("ranked") + rank).alias("block"))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    repeats: int = MAX_REPEATS,
    block_words: int = BLOCK_WORDS,
) -> tuple[DataFrame, DataFrame]:
    """The documents with their source's figures, and the mix itself.

    The first holds doc_id, size, source_no, source_size, target, start (of the document in its source's
    stream). The second holds a row per piece of a document in a slot: slot, doc_id, source_no, start,
    size, from_word, words. Reading it by slot yields the mix.
    """
    documents = checkpoint(sized(docs))
    targets = checkpoint(source_targets(documents, weights, repeats))
    stream = checkpoint(placed(documents, targets))
    begin = F.col("start") + F.col("pass") * F.col("source_size")
    end = F.least(begin + F.col("size"), F.round("target").cast("long"))
    passes = stream.where("size > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    pieces = passes.withColumns({"begin": begin, "end": end}).where("begin < end")
    blocks = F.sequence(F.floor(F.col("begin") / block_words), F.floor((F.col("end") - 1) / block_words))
    pieces = pieces.withColumn("block", F.explode(blocks))
    low = F.greatest("begin", F.col("block") * block_words)
    high = F.least("end", (F.col("block") + 1) * block_words)
    pieces = pieces.select(
        "doc_id", "source_no", "start", "size", "block", (low - F.col("begin")).alias("from_word"), (high - low).alias("words")
    )
    slots = schedule(targets, block_words)
    return stream, slots.hint("merge").join(pieces, ["source_no", "block"]).drop("block")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken_per_document(table(spark, sf_dir, "documents"))


def taken_per_document(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, size, source_size, target and the words that the mix takes of it."""
    stream, pieces = mix(docs)
    # A document with words is alone at its place in its source's stream; the empty ones take nothing.
    place = ["source_no", "start"]
    taken = pieces.groupBy(*place).agg(F.sum("words").alias("taken"))
    full = stream.where("size > 0").join(taken, place, "left")
    columns = ["doc_id", "size", "source_size", "target"]
    result = full.select(*columns, F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    return result.unionByName(stream.where("size = 0").select(*columns, F.lit(0).cast("long").alias("taken")))


#: The same figures without a schedule: a source's stream is cut at its target.
OP6_SQL = r"""
with sized as (
  select doc_id, source, md5(coalesce(cast(doc_id as varchar), '')) as shuffle,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size
  from documents),
totals as (select source, sum(size)::bigint as source_size from sized group by source),
ranked as (select *, row_number() over (order by source nulls last) - 1 as source_no from totals),
weighed as (select *, case source_no % 3 when 0 then 5 when 1 then 2 else 1 end as weight from ranked),
levels as (
  select *, sum(source_size) over () - coalesce(sum(3 * source_size) over smaller, 0) as words_left,
         sum(weight) over () - coalesce(sum(weight) over smaller, 0) as weight_left
  from weighed
  window smaller as (order by source_size / weight, source_no rows between unbounded preceding and 1 preceding)),
marked as (select *, 3 * source_size * weight_left <= weight * words_left as capped from levels),
targets as (
  select source, source_size, case when capped then (3 * source_size)::double else
         weight::double * (max(case when not capped then words_left end) over ())::double
         / (max(case when not capped then weight_left end) over ())::double end as target
  from marked),
stream as (
  select d.doc_id, d.size::bigint as size, t.source_size, t.target,
         coalesce(sum(d.size) over (partition by d.source order by d.shuffle, d.size
                  rows between unbounded preceding and 1 preceding), 0) as start
  from sized d join targets t on d.source is not distinct from t.source)
select doc_id, size, source_size, target,
       (greatest(0, least(start + size, round(target)) - start)
        + greatest(0, least(start + source_size + size, round(target)) - start - source_size)
        + greatest(0, least(start + 2 * source_size + size, round(target)) - start - 2 * source_size))::bigint as taken
from stream
"""
