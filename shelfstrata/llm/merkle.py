"""A Merkle manifest of a dataset whose tree levels are kept as concatenated strings.

A leaf is the hash of a row's columns. The nodes of a tree, in their order, are cut into aligned blocks of
`FAN` ** 2. A block keeps its nodes as one string of hex digests; the digests of their parents are hashes of
substrings of fixed width, and once more of those. What flanks a node in the substring of its run are its
siblings. The roots of the blocks are the nodes of the next round, until a tree has one node. The trees of all
sources are built together, then the tree of their roots. On the way back each block learns the siblings above
it, and only then the rows are dealt out again: no row is looked up in a tree.

Ranks in a source of any size come from one sort by ranges and the counts of each range, so that a source with a
third of all rows is spread like the others. Only ids and digests are sorted and gathered, never texts.

Defined cases: NULL in a column is `-`, which differs from the empty text `0:`; rows of a source with equal ids are
ordered by their digest, NULL ids come first; repeated rows are leaves of their own; an empty table gives no rows; other
columns are ignored, also those with names used here.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfstrata.llm.common import broadcast_if_small, table, written

#: Nodes of a run, which have one parent; digits of a digest.
FAN, DIGITS = 16, 64
BLOCK = FAN * FAN
#: What a leaf holds, in its order.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

_SEGMENTS = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """A value as its number of bytes, a colon and itself; `-` if there is none."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


def lowered(text: Column) -> Column:
    """`text` with A-Z in lower case and nothing else changed."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def ranked(nodes: DataFrame, order: list[str]) -> DataFrame:
    """`nodes` with `pos`, the place of a row in its `tree` in the order of some columns, and `n`, the size of the tree.

    Rows are sorted by ranges of tree and order and stored. A row's place is its place in its range, moved by what
    the tree holds in earlier ranges, of which there is one row for each range and tree.
    """
    columns = nodes.columns
    spread = nodes.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    number = F.monotonically_increasing_id()
    stored = written(spread.withColumn("_number", number))
    part, place = F.shiftright("_number", 33).alias("_part"), F.col("_number").bitwiseAND((1 << 33) - 1).alias("_place")
    stored = stored.select(*columns, part, place)
    held = stored.groupBy("tree", "_part").agg(F.count(F.lit(1)).alias("_held"), F.min("_place").alias("_first"))
    held = written(held)
    totals = held.groupBy("tree").agg(F.sum("_held").alias("n"))
    earlier = W.partitionBy("tree").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    before = F.sum("_held").over(earlier)
    shifts = held.withColumn("_shift", F.coalesce(before, F.lit(0)) - F.col("_first")).join(totals, "tree")
    shifts = broadcast_if_small(written(shifts.select("tree", "_part", "_shift", "n")))
    return stored.join(shifts, ["tree", "_part"]).select(*columns, (F.col("_place") + F.col("_shift")).alias("pos"), "n")


def _cut(level: Column, first: Column | int, width: Column | int) -> Column:
    """`width` characters of a string of digits from place `first`, counted from 0. Bytes need no search for characters."""
    begin = first if isinstance(first, Column) else F.lit(first)
    width = width if isinstance(width, Column) else F.lit(width)
    return F.substring(level.cast("binary"), (begin + 1).cast("int"), width.cast("int")).cast("string")


def _runs(level: Column, nodes: Column) -> Column:
    """The strings of the runs of a level of `nodes` nodes."""
    width = FAN * DIGITS
    number = F.ceil(nodes / FAN).cast("int")
    return F.transform(F.sequence(F.lit(0), number - 1), lambda r: _cut(level, r * width, width))


def _hashed(runs: Column) -> Column:
    return F.array_join(F.transform(runs, lambda run: F.sha2(run.cast("binary"), 256)), "")


def _blocks(nodes: DataFrame, kept: list[str]) -> DataFrame:
    """Blocks of the nodes (tree, pos, n, digest): their levels as strings, their root, and `members` in order."""
    member = F.struct("pos", "digest", *kept)
    blocks = nodes.groupBy("tree", F.floor(F.col("pos") / BLOCK).alias("block")).agg(
        F.array_sort(F.collect_list(member)).alias("members"), F.min("n").alias("n")
    )
    blocks = blocks.withColumn("level", F.array_join(F.col("members.digest"), "")).withColumn("runs", _runs(F.col("level"), F.size("members")))
    # A tree of one node is its root; one of one run has one level.
    blocks = blocks.withColumn("parents", F.when(F.col("n") > 1, _hashed(F.col("runs"))))
    top = F.when(F.col("n") == 1, F.col("level")).when(F.col("n") <= FAN, F.col("parents"))
    block_root = F.coalesce(top, F.sha2(F.col("parents").cast("binary"), 256)).alias("block_root")
    return blocks.select("tree", "block", "n", "members", "runs", "parents", block_root)


def _flanks(run: Column, place: Column) -> Column:
    """What stands left and right of a node in the string of its run: its siblings."""
    at = place * DIGITS
    return F.struct(_cut(run, F.lit(0), at).alias("left"), _cut(run, at + DIGITS, F.length(run) - at - DIGITS).alias("right"))


def _dealt(blocks: DataFrame, kept: list[str], carried: list[str]) -> DataFrame:
    """The members of blocks, with the siblings on the way to the root: those in the block, then `path`, those above it.

    Dealt out by runs first, so that a row carries the strings of its run and not of its block.
    """
    runs_of = F.sequence(F.lit(0), F.size("runs") - 1)
    of_run = F.transform(
        runs_of, lambda r: F.struct(r.alias("r"), F.element_at("runs", r + 1).alias("run"), F.slice("members", r * FAN + 1, F.lit(FAN)).alias("nodes"))
    )
    runs = blocks.select("tree", "n", "parents", "path", *carried, F.explode(of_run).alias("of"))
    above = F.when(F.col("n") > FAN, F.array(_flanks(F.col("parents"), F.col("of.r")))).otherwise(F.array().cast(_SEGMENTS))
    runs = runs.select("tree", "n", *carried, "of.run", "of.nodes", F.concat(above, "path").alias("path"))
    rows = runs.select("tree", "n", "run", "path", *carried, F.posexplode("nodes").alias("i", "node"))
    own = F.when(F.col("n") > 1, F.array(_flanks(F.col("run"), F.col("i")))).otherwise(F.array().cast(_SEGMENTS))
    return rows.select("tree", F.concat(own, "path").alias("path"), *carried, "node.pos", "node.digest", *[f"node.{c}" for c in kept])


def _trees(nodes: DataFrame, kept: list[str]) -> tuple[DataFrame, list[DataFrame]]:
    """The root of each tree of ranked nodes, and the blocks of each round, from the leaves up."""
    rounds = [written(_blocks(nodes, kept))]
    while True:
        last = rounds[-1]
        if (last.agg(F.max("n")).first()[0] or 0) <= BLOCK:
            return last.select("tree", F.col("block_root").alias("digest")), rounds
        n = F.ceil(F.col("n") / BLOCK).cast("long").alias("n")
        upper = last.select("tree", F.col("block").alias("pos"), n, F.col("block_root").alias("digest"))
        rounds.append(written(_blocks(upper, [])))


def _placed(rounds: list[DataFrame], top: DataFrame, carried: list[str]) -> DataFrame:
    """The blocks of the leaves with `path`, the siblings above them. `top` has the path above the root of each tree."""
    blocks = rounds[-1].join(broadcast_if_small(written(top)), "tree")
    for lower in reversed(rounds[:-1]):
        above = _dealt(blocks, [], carried).select("tree", F.col("pos").alias("block"), "path", *carried)
        blocks = lower.join(broadcast_if_small(written(above)), ["tree", "block"])
    return blocks


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its way lead to."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]).cast("binary"), 256))


def proof(path: Column) -> Column:
    """The hash of the siblings on a way, from the leaf up and from left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)


def manifest(leaves: DataFrame, group: str, by: str) -> DataFrame:
    """Per row of `leaves` (`group`, `by`, `digest`, others): digest, the columns but `group`, path, subroot, root.

    The leaves of a group, ascending by `by`, form its tree with root `subroot`; the subroots, ascending by group as
    UTF-8 bytes, NULL first, form the last tree. `path` holds the siblings left and right of the way up to `root`.
    """
    kept = [c for c in leaves.columns if c not in (group, "digest")]
    # Text that orders as the groups do, NULL first.
    keyed = leaves.withColumn("tree", F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit(""))).drop(group)
    subroots, rounds = _trees(ranked(keyed, [by, "digest"]), kept)
    groups = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest")
    roots, upper = _trees(ranked(groups, ["of"]), ["of"])
    top = roots.select("tree", F.array().cast(_SEGMENTS).alias("path"), F.col("digest").alias("root"))
    above = _dealt(_placed(upper, top, ["root"]), ["of"], ["root"])
    above = above.select(F.col("of").alias("tree"), "path", F.col("digest").alias("subroot"), "root")
    return _dealt(_placed(rounds, above, ["subroot", "root"]), kept, ["subroot", "root"]).drop("tree", "pos")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of `documents`, checked against rows of which a part has its text in lower case."""
    docs = table(spark, sf_dir, "documents")
    values = [F.col(c) for c in COLUMNS]
    changed = leaf_of([*values[:-1], lowered(F.col("text"))])
    is_changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    leaves = docs.select("doc_id", "source", leaf_of(values).alias("digest"), F.when(is_changed, changed).alias("found"))
    rows = manifest(written(leaves), "source", "doc_id")
    folded = rows.select("*", fold(F.coalesce("found", "digest"), F.col("path")).alias("folded_root"))
    return folded.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        proof(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _levels(name: str, nodes: str, levels: int) -> str:
    """SQL of a tree over `nodes` (tree, i, h): its levels, and `{name}_way` with the siblings and the root of each node."""
    parts = [f"{name}_0 as ({nodes})"]
    for k in range(levels):
        run = f"from {name}_{k} window run as (partition by tree, i // 16 order by i rows between unbounded preceding and unbounded following)"
        parts.append(f"{name}_s{k} as (select tree, i, h, string_agg(h, '') over run as run, count(*) over (partition by tree) as n {run})")
        parts.append(
            f"{name}_{k + 1} as (select tree, i // 16 as i, case when any_value(n) = 1 then any_value(h) else sha256(any_value(run)) end as h "
            f"from {name}_s{k} group by tree, i // 16)"
        )
    left = ", ".join(f"case when s{k}.n > 1 then left(s{k}.run, 64 * (s{k}.i % 16)::int) else '' end as l{k}" for k in range(levels))
    right = ", ".join(f"case when s{k}.n > 1 then substr(s{k}.run, 64 * (s{k}.i % 16)::int + 65) else '' end as r{k}" for k in range(levels))
    joins = " ".join(f"join {name}_s{k} s{k} on s{k}.tree = s0.tree and s{k}.i = s0.i // {16**k}" for k in range(1, levels))
    parts.append(
        f"{name}_way as (select s0.tree, s0.i, s0.h, top.h as top, {left}, {right}, "
        f"{', '.join(f's{k}.n as n{k}' for k in range(levels))} from {name}_s0 s0 {joins} join {name}_{levels} top on top.tree = s0.tree)"
    )
    return ",\n".join(parts)


def _sql(levels: int = 5) -> str:
    """The manifest level by level, for sources of up to 16 ** `levels` documents and as many sources."""
    size = lambda x: f"coalesce(octet_length(encode({x}::varchar))::varchar || ':' || {x}::varchar, '-')"
    leaf = lambda text: "sha256(" + " || ".join(size(x) for x in (*COLUMNS[:-1], text)) + ")"
    lower = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    # The CRC-32 of the decimal id, a byte at a time with the table of all bytes.
    bits = "list_reduce(list_prepend(b, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, x: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)"
    crc = "xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint)), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295)"
    steps, at = [], "start"
    ways = [("d", k) for k in range(levels)] + [("s", k) for k in range(levels)]
    for n, (name, k) in enumerate(ways):
        steps.append(f"f{n} as (select *, case when {name}_n{k} > 1 then sha256({name}_l{k} || {at} || {name}_r{k}) else {at} end as f{n}_ from {'ways' if n == 0 else f'f{n - 1}'})")
        at = f"f{n}_"
    columns = ", ".join(f"{w}.{c}{k} as {w}_{c}{k}" for w in "ds" for c in "nlr" for k in range(levels))
    siblings = " || ".join(f"{name}_l{k} || {name}_r{k}" for name, k in ways)
    last = f"f{len(ways) - 1}"
    docs = "select tree, row_number() over (partition by tree order by doc_id, digest) - 1 as i, digest as h, found, doc_id from leaves"
    sources = "select '' as tree, row_number() over (order by tree) - 1 as i, top as h, tree as of from (select distinct tree, top from d_way)"
    return f"""
with crcs as (select list_transform(range(256), lambda b: {bits}) as t),
leaves as (
  select doc_id, coalesce('1' || source, '') as tree, {leaf('text')} as digest, case when {crc} % 5 = 0 then {leaf(lower)} end as found
  from documents, crcs),
{_levels('d', docs, levels)},
{_levels('s', sources, levels)},
ways as (
  select l.doc_id, l.h as leaf, coalesce(l.found, l.h) as start, d.top as subroot, s.top as root, {columns}
  from d_0 l join d_way d on d.tree = l.tree and d.i = l.i join s_0 o on o.of = l.tree join s_way s on s.i = o.i),
{', '.join(steps)}
select doc_id, leaf, subroot, root, sha256({siblings}) as proof_sha256, {at} as folded_root, {at} = root as verified from {last}
"""


OP12_SQL = _sql()
