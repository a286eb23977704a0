r"""Benchmark decontamination through a positional inverted index of the training documents.

1. A first pass counts the terms that the benchmark uses over all documents.
2. In every window of a benchmark item the rarest term is its anchor, and the next rarest its partner;
   neighbouring windows mostly share both.
3. The index is cut by document: the postings of all terms of a text lie together, by position. The second pass
   takes the postings of the anchors, and looks up in the partner's list the position minus its offset. Only
   where both lists agree are the terms on either side compared: how far they agree tells whether a whole window
   does, and then the stretch is an exact phrase match.
4. Where an item's rarest term occurs with its next rarest ones within `NEAR` words, in any order, the item is a
   proximity match. This is found in the same pass, as is the number of words.

Only matches leave the second pass, so nothing of the size of the text is shuffled, and the common words of a
window cost nothing but their comparison.

Words: A-Z in lower case, then runs of letters, digits and anything beyond ASCII. A window is `WINDOW`
consecutive words of an item; an item with fewer is one window.

Defined cases: a NULL or empty text has no words and no hits; an item without words is in no document;
items with equal words are each reported; a NULL item_id counts as ''; rows that repeat an id are judged
each by its own text; an empty table gives no rows, an empty benchmark no hits; other columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfstrata.llm.common import attach, broadcast_if_small, checkpoint, table, written

WINDOW = 10
#: Words around an item's rarest term in which its next rarest ones make a proximity match, and how many in all.
NEAR, NEAR_TERMS = 20, 3
#: Stands behind the last word of a text; no word is a space.
END = " "
#: Applied to text in lower case. Written as what a word holds: Java matches the complement of all else many times slower.
WORD = r"[a-z0-9\x80-\x{10FFFF}]+"


def words(text: Column) -> Column:
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    none = F.array().cast("array<string>")
    return F.coalesce(F.regexp_extract_all(lower, F.lit(WORD), F.lit(0)), none)


def doc_key() -> Column:
    """A document is known by its id and the hash of its text: rows that repeat both have the same hits."""
    return F.concat_ws(":", F.col("doc_id").cast("string"), F.xxhash64("text").cast("string"))


def benchmark_items(items: DataFrame) -> DataFrame:
    """item_id as text, the item's words, and a key that items with equal words share."""
    found = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words(F.col("text")).alias("words"))
    key = F.md5(F.array_join("words", " ").cast("binary"))
    return found.where(F.size("words") > 0).distinct().withColumn("item_key", key)


def term_counts(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """How often each term of the benchmark occurs in all documents (0 too)."""
    terms = checkpoint(texts.select(F.explode("words").alias("term")).distinct())
    occurring = docs.select(F.explode(words(F.col("text"))).alias("term"))
    counted = occurring.join(broadcast_if_small(terms), "term", "left_semi").groupBy("term").count()
    return terms.join(counted, "term", "left").select("term", F.coalesce("count", F.lit(0)).alias("n"))


def anchors(texts: DataFrame, counts: DataFrame, window: int = WINDOW) -> DataFrame:
    """For the rarest term of each window: item_key, term, n_words, left (words before, nearest first), right, with
    the next rarest term of the window (`partner`, itself if alone) and how many words further it stands (`offset`).
    """
    placed = texts.select("item_key", F.posexplode("words").alias("at", "term")).join(counts, "term")
    rows = placed.groupBy("item_key").agg(F.array_sort(F.collect_list(F.struct("at", "n", "term"))).alias("terms"))
    size = F.size("terms")
    starts = F.sequence(F.lit(1), F.greatest(size - window + 1, F.lit(1)))
    by_rarity = F.transform("terms", lambda t: F.struct(t["n"].alias("n"), t["at"].alias("at"), t["term"].alias("term")))
    rarest = F.transform(starts, lambda s: F.slice(F.array_sort(F.slice("rarity", s, window)), 1, 2))
    rows = rows.withColumn("rarity", by_rarity).select("item_key", "terms", F.explode(F.array_distinct(rarest)).alias("rarest"))
    first, second = F.get("rarest", F.lit(0)), F.coalesce(F.get("rarest", F.lit(1)), F.get("rarest", F.lit(0)))
    at, text = first["at"], F.transform("terms", lambda t: t["term"])
    before = F.least(at, F.lit(window - 1))
    return rows.where(first["n"] > 0).select(
        "item_key",
        first["term"].alias("term"),
        size.alias("n_words"),
        second["term"].alias("partner"),
        (second["at"] - at).alias("offset"),
        F.reverse(F.slice(text, at - before + 1, before)).alias("item_left"),
        F.slice(text, at + 2, window - 1).alias("item_right"),
    )


def rarest_terms(texts: DataFrame, counts: DataFrame, n_terms: int = NEAR_TERMS) -> DataFrame:
    """item_key, its rarest term, and `others`, the next rarest ones; items whose rarest term occurs nowhere are left out."""
    rarity = texts.select("item_key", F.explode(F.array_distinct("words")).alias("term")).join(counts, "term")
    rows = rarity.groupBy("item_key").agg(F.slice(F.array_sort(F.collect_list(F.struct("n", "term"))), 1, n_terms).alias("terms"))
    others = F.transform(F.slice("terms", 2, n_terms), lambda t: t["term"])
    return rows.where(F.col("terms")[0]["n"] > 0).select("item_key", F.col("terms")[0]["term"].alias("term"), others.alias("others"))


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The positional index at `terms`: doc_id, doc_key, term, pos, with all words of the text, `END` being the last."""
    placed = docs.select("doc_id", doc_key().alias("doc_key"), F.concat(words(F.col("text")), F.array(F.lit(END))).alias("words"))
    occurring = placed.select("doc_id", "doc_key", "words", F.posexplode("words").alias("pos", "term"))
    return occurring.join(broadcast_if_small(terms), "term", "left_semi")


def _agreeing(a: Column, b: Column) -> Column:
    """How many words agree from the start of two arrays."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first_other = F.array_position(same, F.lit(False))
    return F.when(first_other == 0, F.size(same)).otherwise(first_other - 1).cast("int")


def _around(reach: int) -> tuple[Column, Column]:
    """The words before `pos`, nearest first, and those behind it."""
    before = F.least(F.col("pos"), F.lit(reach))
    return F.reverse(F.slice("words", F.col("pos") - before + 1, before)), F.slice("words", F.col("pos") + 2, reach)


def search(docs: DataFrame, wanted: DataFrame, near: DataFrame | None = None, window: int = WINDOW, within: int = NEAR) -> DataFrame:
    """One pass over `docs` for the anchors `wanted` and, with `near`, for `rarest_terms`, too.

    doc_id, doc_key, kind, item_key, first, last. Kind `phrase`: words `first` to `last` hold whole windows of the item.
    With `near` also kind `near`: the item's rarest term is at `first`, the others within `within` words; and kind
    `end`, one for each row of `docs`: `first` is its number of words.
    """
    uses = wanted.withColumns({"kind": F.lit("phrase"), "others": F.lit(None).cast("array<string>")})
    if near is not None:
        end = docs.sparkSession.range(1).select(F.lit(END).alias("term"), F.lit("end").alias("kind"))
        uses = uses.unionByName(near.withColumn("kind", F.lit("near")).unionByName(end, True), True)
    uses = checkpoint(uses)
    met = postings(docs, checkpoint(uses.select("term").distinct())).join(broadcast_if_small(uses), "term")
    met = met.where((F.col("kind") != "phrase") | (F.get("words", F.col("pos") + F.col("offset")) == F.col("partner")))
    left, right = _around(window - 1)
    phrase = F.col("kind") == "phrase"
    before, after = F.when(phrase, _agreeing(left, F.col("item_left"))), F.when(phrase, _agreeing(right, F.col("item_right")))
    lacking = F.when(F.col("kind") == "near", F.size(F.array_except("others", F.concat(*_around(within)))))
    met = met.select("doc_id", "doc_key", "kind", "item_key", "pos", "n_words", before.alias("before"), after.alias("after"), lacking.alias("lacking"))
    whole = F.col("before") + F.col("after") + 1 >= F.least(F.col("n_words"), F.lit(window))
    found = met.where((F.col("kind") == "end") | whole | (F.col("lacking") == 0))
    first, last = F.col("pos") - F.coalesce("before", F.lit(0)), F.col("pos") + F.coalesce("after", F.lit(0))
    return found.select("doc_id", "doc_key", "kind", "item_key", first.alias("first"), last.alias("last"))


def phrase_matches(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Stretches of documents that hold whole windows: doc_key, item_key, first, last."""
    known = checkpoint(benchmark_items(items).select("item_key", "words").distinct())
    found = search(docs, anchors(known, term_counts(docs, known), window), window=window)
    return found.select("doc_key", "item_key", "first", "last")


def proximity_matches(docs: DataFrame, items: DataFrame, n_terms: int = NEAR_TERMS, within: int = NEAR) -> DataFrame:
    """Documents where an item's `n_terms` rarest terms occur within `within` words of the rarest, in any order.

    A row per match: doc_key, item_key, pos (of the rarest term).
    """
    known = checkpoint(benchmark_items(items).select("item_key", "words").distinct())
    counts = checkpoint(term_counts(docs, known))
    found = search(docs, anchors(known, counts).where("false"), rarest_terms(known, counts, n_terms), within=within)
    return found.where("kind = 'near'").select("doc_key", "item_key", F.col("first").alias("pos"))


def _listed(matches: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    """doc_key with the sorted ids of the items that `matches` tell."""
    found = matches.select("doc_key", "item_key").distinct().join(texts.select("item_key", "item_id"), "item_key")
    return found.groupBy("doc_key").agg(F.array_sort(F.collect_set("item_id")).alias(name))


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per row of `docs`: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_proximity, proximity_sha256."""
    texts = checkpoint(benchmark_items(items))
    known = texts.select("item_key", "words").distinct()
    counts = checkpoint(term_counts(docs, known))
    found = written(search(docs, anchors(known, counts), rarest_terms(known, counts)))
    matches = found.where("kind = 'phrase'").select("doc_key", "item_key", "first", "last").distinct()
    # Words in the union of the stretches: each adds what lies beyond all that begin before it.
    earlier = W.partitionBy("doc_key").orderBy("first", "last").rowsBetween(W.unboundedPreceding, -1)
    reached = F.coalesce(F.max("last").over(earlier), F.lit(-1))
    stretches = matches.select("doc_key", "first", "last").distinct().withColumn("reached", reached)
    new = F.greatest(F.col("last") - F.greatest("reached", F.col("first") - 1), F.lit(0))
    hits = stretches.groupBy("doc_key").agg(F.sum(new).alias("n_hit"))
    hits = hits.join(_listed(matches, texts, "items"), "doc_key").join(_listed(found.where("kind = 'near'"), texts, "near"), "doc_key", "full")
    rows = found.where("kind = 'end'").select("doc_id", "doc_key", F.col("first").cast("long").alias("n_words"))
    joined = rows.join(hits, "doc_key", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    size = lambda ids: F.coalesce(F.size(ids), F.lit(0)).cast("long")
    digest = lambda ids: F.sha2(F.coalesce(F.array_join(ids, ","), F.lit("")), 256)
    return joined.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        size("items").alias("n_items"),
        digest("items").alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        size("near").alias("n_proximity"),
        digest("near").alias("proximity_sha256"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """`docs` without the rows whose text holds any window of any item."""
    found = phrase_matches(docs, items).select(F.col("doc_key").alias("_op10_key")).distinct().withColumn("_op10_hit", F.lit(True))
    keyed = docs.withColumn("_op10_key", doc_key())
    kept = attach(keyed, "_op10_key", found, ["_op10_hit"]).where("_op10_hit is null")
    return kept.select(*[F.col(f"row.`{c}`") for c in docs.columns])


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = r"""coalesce(regexp_extract_all(
  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"""

OP10_SQL = rf"""
with docs as (select doc_id, row_number() over () as row_no, {_WORDS} as words from documents),
items as (select coalesce(cast(item_id as varchar), '') as item_id, {_WORDS} as words from benchmark),
grams as (
  select distinct item_id, least(len(words), 10) as n, words[i : i + least(len(words), 10) - 1] as gram
  from (select *, unnest(range(1, greatest(len(words) - 9, 1) + 1)) as i from items where len(words) > 0)),
found as (
  select row_no, i, d.n, item_id
  from (select row_no, n, i, words[i : i + n - 1] as gram
        from (select row_no, words, n, unnest(range(1, len(words) - n + 2)) as i
              from docs, (select distinct n from grams) where len(words) >= n)) d
  join grams g on d.n = g.n and d.gram = g.gram),
hits as (select row_no, count(distinct w) as n_hit
         from (select row_no, unnest(range(i, i + n)) as w from found) group by row_no),
named as (select row_no, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
          from (select distinct row_no, item_id from found) group by row_no),
counts as (select w, count(*) as n from (select unnest(words) as w from docs) group by w),
rarity as (
  select item_id, words, term, coalesce(n, 0) as n
  from (select distinct item_id, words, unnest(list_distinct(words)) as term from items) left join counts on w = term),
rarest as (select item_id, (list(term order by n, term))[1:3] as terms from rarity group by item_id, words),
close as (
  select distinct row_no, item_id
  from (select row_no, words[p] as word, words[greatest(p - 20, 1) : p + 20] as around
        from (select row_no, words, unnest(range(1, len(words) + 1)) as p from docs)) a
  join rarest r on a.word = r.terms[1] and list_has_all(around, terms)),
close_ids as (select row_no, count(*) as n_proximity, string_agg(item_id, ',' order by item_id) as near_ids from close group by row_no)
select doc_id, len(words) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256, n_hit is not null as contaminated,
       coalesce(n_proximity, 0) as n_proximity, sha256(coalesce(near_ids, '')) as proximity_sha256
from docs left join hits using (row_no) left join named using (row_no) left join close_ids using (row_no)
"""
