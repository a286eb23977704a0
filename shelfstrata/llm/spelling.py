r"""Grouping of spelling variants by an index of variable-length grams.

1. Words and their counts come from all texts. A word stands between a start mark and an end mark.
2. The gram dictionary is a trie pruned by frequency: every gram of `SHORTEST` characters is in it, and a longer one, up to
   `LONGEST`, if the gram without its last character is frequent. Frequent means more than a threshold, the smallest power of two
   that leaves at most `GRAMS` longer grams; so the dictionary can be sent to every task. Counts cover all words.
3. A word is decomposed into one gram for each place: the longest gram of the dictionary that starts there. Finding it reads
   some characters from that place on, and no others; an edit elsewhere leaves the gram as it is.
4. This bounds, for each place of an edit, the grams that it can affect. All others must occur in the other word too, those before
   the edit as far from its start, those behind it as far from its end. A word is listed, for each place of an edit, under
   the rarest gram before and the rarest gram behind that the edit cannot affect: two words that differ by an edit
   choose the same, since they agree in all grams to choose from, so they meet in a list. Choosing both merges the two grams' lists.
5. Words of a list are compared exactly. Long lists are dealt out in tiles.

A word has a bounded number of near words (edits are bounded by its length and letters), so links are few. A form has ten times
the count of its word or more, so following forms ends within about 19 steps; each round of joins doubles the steps.

Defined cases: a NULL text has no words; a NULL id counts as an empty one in the checksum; rows that repeat an id or a text count each time;
words of any length are compared whole; ties in counts go to the word that is smallest in code-point order; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfstrata.llm.common import checkpoint, ship_code, table, written
from shelfstrata.llm.ngram_join import pairs_of_runs
from shelfstrata.llm.runs import grouped, whole_runs

MIN_LENGTH, MIN_COUNT = 7, 2
#: A form has at least so many times the count of its word.
RATIO = 10
SHORTEST, LONGEST = 3, 6
#: Grams beyond the shortest that the dictionary holds at most. Any dictionary gives the same result.
GRAMS = 20_000
#: Words of a list that are compared with all others of it in one place.
TILE_ROWS = 2_048
#: Longer words are compared one pair at a time; pairs that are compared at once.
WIDE, PAIRS = 64, 1 << 18
START, END = "^", "$"

LETTERS = "a-z\\u00C0-\\u00FF"


def corpus_words(docs: DataFrame) -> DataFrame:
    """word, n: the runs of letters of all texts, some with a letter deleted by checksum, that are long and frequent enough."""
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    # Shorter runs only get shorter.
    runs = F.regexp_extract_all(lower, F.lit(f"[{LETTERS}]{{{MIN_LENGTH},}}"), F.lit(0))
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    found = docs.select(F.concat(ident, F.lit(":")).alias("ident"), F.explode(runs).alias("run"))
    h = F.crc32(F.concat("ident", "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    rest = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % 31 == 0, rest).otherwise(F.col("run"))
    words = found.select("run", h.alias("h")).select(word.alias("word"))
    return words.where(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_COUNT)


def gram_dictionary(words: DataFrame) -> dict[str, int]:
    """The grams of the pruned trie and in how many places of `words` they start.

    The only table that reaches the driver: every gram of `SHORTEST` characters, bounded by the alphabet, and `GRAMS` longer ones.
    """
    marked = F.concat(F.lit(START), "word", F.lit(END))
    places = F.sequence(F.lit(1), F.length("marked") - SHORTEST + 1)
    longest = F.explode(F.transform(places, lambda p: F.substring("marked", p, F.lit(LONGEST))))
    windows = words.select(marked.alias("marked")).select(longest.alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("places"))
    windows = written(windows)
    # A gram starts where a window begins with it.
    starts = F.transform(F.sequence(F.lit(SHORTEST), F.length("gram")), lambda q: F.substring("gram", F.lit(1), q))
    grams = windows.select(F.explode(starts).alias("gram"), "places").groupBy("gram").agg(F.sum("places").alias("places"))
    grams = written(grams)
    parents = grams.select(F.col("gram").alias("parent"), F.col("places").alias("above"))
    longer = grams.where(F.length("gram") > SHORTEST).withColumn("parent", F.expr("substring(gram, 1, length(gram) - 1)")).join(parents, "parent")
    longer = written(longer.select("gram", "places", "above"))
    # How many grams have a parent as frequent as each power of two: at most 63 rows.
    power = F.floor(F.log2("above")).cast("int").alias("power")
    sizes = {r.power: r.number for r in longer.groupBy(power).agg(F.count(F.lit(1)).alias("number")).collect()}
    power = max(sizes, default=0) + 1
    total = 0
    while power - 1 in range(max(sizes, default=0) + 1) and total + sizes.get(power - 1, 0) <= GRAMS:
        power -= 1
        total += sizes.get(power, 0)
    chosen = grams.where(F.length("gram") == SHORTEST).union(longer.where(F.col("above") >= 2**power).select("gram", "places"))
    return {r.gram: r.places for r in chosen.toLocalIterator()}


def decomposed(word: str, grams: dict[str, int], inner: set[str]) -> list[tuple[int, str, int, int]]:
    """Per place of a word between its marks: the gram, led by its frequency, its place, and the end of what was read to find it."""
    marked, found = START + word + END, []
    size = len(marked)
    for p in range(size - SHORTEST + 1):
        q = p + SHORTEST
        while q < size and q - p < LONGEST and marked[p : q + 1] in grams:
            q += 1
        gram = marked[p:q]
        # The search ended at the first character that no longer gram goes on with, which thus was read, unless none could.
        found.append((grams.get(gram, 0), gram, p, q + (gram in inner)))
    return found


def list_names(word: str, grams: dict[str, int], inner: set[str]) -> set[tuple]:
    """The lists a word is in: per place of an edit the rarest gram before and the rarest behind that it cannot affect."""
    found, size = decomposed(word, grams, inner), len(word) + 2
    behind: list[tuple | None] = [None] * (size + 2)
    for p in range(size - 1, -1, -1):
        behind[p] = behind[p + 1]
        if p < len(found):
            places, gram, _, _ = found[p]
            rarer = (places, gram, size - p)
            behind[p] = rarer if behind[p] is None else min(behind[p], rarer)
    ending: list[tuple | None] = [None] * (size + 2)
    for places, gram, p, end in found:
        rarer = (places, gram, p)
        ending[end] = rarer if ending[end] is None else min(ending[end], rarer)
    names, before = set(), None
    for i in range(size):
        if ending[i] is not None:
            before = ending[i] if before is None else min(before, ending[i])
        if i >= 1:
            # A character comes in before place i, or that of place i is replaced or goes.
            names.add((before, behind[i]))
            if i < size - 1:
                names.add((before, behind[i + 1]))
    return names


def _lister(grams: dict[str, int]):
    inner = {g[:-1] for g in grams if len(g) > SHORTEST}

    def name(of: tuple) -> int:
        text = "|".join("" if x is None else f"{x[1]}{x[2]}" for x in of)
        return xxhash.xxh3_64_intdigest(text) - (1 << 63)

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts = batch.column("word").to_pylist(), batch.column("n")
            names = [{name(x) for x in list_names(w, grams, inner)} for w in words]
            rows = np.repeat(np.arange(len(words)), [len(x) for x in names])
            flat = np.fromiter((x for each in names for x in each), np.int64, len(rows))
            yield pa.RecordBatch.from_arrays([pa.array(flat), batch.column("word").take(pa.array(rows)), counts.take(pa.array(rows))], ["list", "word", "n"])

    return lists


def differ_by_one(a: str, b: str) -> bool:
    """Whether exactly one character is inserted, deleted or replaced."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    shorter, longer = sorted((a, b), key=len)
    k, end = 0, len(shorter)
    while k < end:
        middle = (k + end + 1) // 2
        k, end = (middle, end) if shorter[k:middle] == longer[k:middle] else (k, middle - 1)
    return shorter[k + (len(a) == len(b)) :] == longer[k + 1 :]


def _agreeing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many columns two rows agree in, from the first on."""
    unlike = x != y
    return np.where(unlike.any(axis=1), unlike.argmax(axis=1), x.shape[1])


class _Words:
    """Words as rows of character codes, from the left and from the right."""

    def __init__(self, words: list[str]) -> None:
        self.words = words
        self.size = np.array([len(w) for w in words])
        self.wide = self.size > WIDE
        short = ["" if x else w for w, x in zip(words, self.wide)]
        self.left, self.right = self._codes(short), self._codes([w[::-1] for w in short])

    @staticmethod
    def _codes(words: list[str]) -> np.ndarray:
        codes = np.array(words, dtype=np.str_).view(np.uint32).reshape(len(words), -1)
        return codes.astype(np.uint8) if not codes.size or codes.max() < 256 else codes

    def near(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which of the pairs differ by one edit: what agrees from the left and from the right is all but one character."""
        longer = np.maximum(self.size[i], self.size[j])
        maybe = longer - np.minimum(self.size[i], self.size[j]) <= 1
        wide = maybe & (self.wide[i] | self.wide[j])
        rows = np.flatnonzero(maybe & ~wide)
        a, b = i[rows], j[rows]
        left = np.minimum(_agreeing(self.left[a], self.left[b]), longer[rows])
        right = np.minimum(_agreeing(self.right[a], self.right[b]), longer[rows])
        found = np.zeros(len(i), dtype=bool)
        found[rows] = (left < longer[rows]) & (left + right >= longer[rows] - 1)
        for k in np.flatnonzero(wide):
            found[k] = differ_by_one(self.words[i[k]], self.words[j[k]])
        return found


TILE = ("list", "low", "high")
LINKS = "word string, other string, other_n long"


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, starts in whole_runs(batches, *TILE):
        words = _Words(rows.column("word").to_pylist())
        side, across = rows.column("side").to_numpy(), rows.column("low").to_numpy() != rows.column("high").to_numpy()
        found = []
        for i, j in pairs_of_runs(starts):
            for at in range(0, len(i), PAIRS):
                a, b = i[at : at + PAIRS], j[at : at + PAIRS]
                keep = ~across[a] | (side[a] != side[b])
                a, b = a[keep], b[keep]
                keep = words.near(a, b)
                found += [np.stack([a[keep], b[keep]]), np.stack([b[keep], a[keep]])]
        if found:
            one, other = (pa.array(x) for x in np.concatenate(found, axis=1))
            columns = [rows.column("word").take(one), rows.column("word").take(other), rows.column("n").take(other)]
            yield from pa.table(columns, ["word", "other", "other_n"]).combine_chunks().to_batches()


def near_words(words: DataFrame) -> DataFrame:
    """word, other, other_n: each pair of `words` (word, n; distinct, of `MIN_LENGTH` characters or more) that differ by one edit, both ways."""
    ship_code(words.sparkSession)
    listed = written(words.mapInArrow(_lister(gram_dictionary(words)), "list long, word string, n long"))
    # Grouped in a struct, so that the join shuffles anew and can split a long list.
    sizes = listed.groupBy(F.struct("list").alias("of")).agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    sizes = sizes.select("of.list", F.ceil(F.col("members") / TILE_ROWS).cast("int").alias("sides"))
    placed = listed.join(sizes, "list").withColumn("side", F.pmod(F.xxhash64("word"), "sides").cast("int"))
    tiled = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)))
    tiled = tiled.select("list", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side", "word", "n")
    # Two words may meet in several lists. Their links are gathered by word, which has a bounded number of them.
    return grouped(tiled, *TILE).mapInArrow(_linked, LINKS).repartition("word").dropDuplicates(["word", "other"])


def followed(forms: DataFrame) -> DataFrame:
    """word, root: where following `forms` (word, form) ends. Steps double with each round."""
    steps = checkpoint(forms.select("word", F.col("form").alias("root")))
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = checkpoint(steps.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if steps.where("moved").isEmpty():
            return steps.select("word", "root")
        steps = steps.select("word", "root")


def variants(words: DataFrame) -> DataFrame:
    """Per word of `words` (word, n): word, form, root, n, n_near, form_n."""
    words = written(words)
    best = F.min(F.struct((-F.col("other_n")).alias("fewer"), F.col("other").alias("word"))).alias("best")
    links = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    joined = words.join(links, "word", "left")
    enough = -F.col("best.fewer") >= RATIO * F.col("n")
    judged = written(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, F.col("best")).alias("best")))
    judged = judged.select("word", F.col("best.word").alias("form"), "n", "n_near", (-F.col("best.fewer")).alias("form_n"))
    roots = followed(judged.where("form is not null"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(corpus_words(table(spark, sf_dir, "documents")))


#: Pairs that agree once a character is deleted from the longer word, or at the same place from both.
OP11_SQL = f"""
with recursive crcs as (
  select list_transform(range(256), lambda b: list_reduce(list_prepend(b, [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, x: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
runs as (
  select doc_id, unnest(regexp_extract_all(translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[a-zÀ-ÿ]+')) as run from documents),
counted as (select doc_id, run, count(*) as k, hex(coalesce(doc_id::varchar, '') || ':' || run) as x from runs where length(run) >= {MIN_LENGTH} group by doc_id, run),
hashed as (
  select run, k, xor(list_reduce(list_prepend(4294967295, list_transform(range(len(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::bigint)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) as h from counted, crcs),
changed as (
  select case when h % 31 = 0 then left(run, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word, k from hashed),
words as (select word, sum(k)::bigint as n from changed where length(word) >= {MIN_LENGTH} group by word having sum(k) >= {MIN_COUNT}),
places as (select word, n, unnest(range(length(word))) as i from words),
shortened as (select word, n, i, left(word, i::int) || substr(word, i::int + 2) as rest from places),
links as (
  select a.word, b.word as other, b.n as other_n from shortened a join shortened b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union select a.word, b.word, b.n from shortened a join words b on a.rest = b.word
  union select b.word, a.word, a.n from shortened a join words b on a.rest = b.word),
best as (
  select word, count(*) as n_near, max(other_n) as most, arg_min(other, (-other_n, other)) as other from links group by word),
judged as (
  select word, n, coalesce(n_near, 0) as n_near, case when most >= {RATIO} * n then other end as form, case when most >= {RATIO} * n then most end as form_n
  from words left join best using (word)),
ways as (
  select word, word as root, 0 as step from judged
  union all select w.word, j.form, w.step + 1 from ways w join judged j on j.word = w.root where j.form is not null),
roots as (select word, arg_max(root, step) as root from ways group by word)
select word, form, root, n, n_near, form_n from judged join roots using (word)
"""
