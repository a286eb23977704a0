r"""Secret scans through a trigram inverted index.

1. Each rule's regular expression is read as a tree, and a Boolean trigram query is derived from it: what
   text must hold for a match to be possible. `(secret|token)=` gives `(sec & ecr & cre & ret) |
   (tok & oke & ken & en=)`, for instance.
2. The documents are indexed under the trigrams that any query asks for: a posting is (trigram, doc_id).
3. The postings of each alternative's trigrams are intersected, which leaves candidate documents per rule.
4. Only candidates are searched with the expression itself. A rule without mandatory trigrams (`[0-9a-f]+`)
   scans every text in full.

Queries ask about text in lower case, so that one index serves rules that ignore case and rules that don't;
this lets more candidates through, never fewer.

Positions are counted in code points, ends are exclusive, and matches of one kind are those of a search
from the left without overlaps; a match that fails its rule's length still uses up its text.

Defined cases: a NULL text is empty and has no spans; ids may be of any type; rows that repeat an id are scanned each by itself,
and all of them if one is a candidate; all rows with a NULL id are scanned; texts are searched whole, however long; an empty table
gives no rows; other columns are not looked at, and masking leaves them as they are.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from re import _constants as node
from re import _parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfstrata.llm.common import attach, table


@dataclass(frozen=True)
class Rule:
    kind: str
    regex: str
    at_least: int  # characters that `group` of a match must have
    group: int = 0
    base: bool = True
    screen: str = ""  # for a rule without trigrams: an expression that any text with a span matches, tried first as it is cheap


#: The base kinds, in their order, and two public token formats besides.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, group=2),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]+", 32, screen="[0-9a-f]{32}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 1, base=False),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}", 1, base=False),
)

#: Most strings that a stretch of an expression is spelt out as before its trigrams are taken.
SPELT = 64


# --- Boolean trigram queries -------------------------------------------------------------------------------
# A query is a set of alternatives, each a set of trigrams that must all occur; {frozenset()} asks for nothing.

ANY = frozenset({frozenset()})


def _both(a: frozenset, b: frozenset) -> frozenset:
    found = {x | y for x in a for y in b}
    return frozenset(x for x in found if not any(y < x for y in found))


def _of_strings(strings: set[str]) -> frozenset:
    return frozenset(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)


def _spelt(op: int, arg: object) -> set[str] | None:
    """All strings, in lower case, that a piece of an expression matches, if they are few."""
    if op is node.LITERAL:
        return {chr(arg).lower()}
    if op is node.IN and all(x[0] is node.LITERAL for x in arg):
        return {chr(x[1]).lower() for x in arg}
    if op is node.SUBPATTERN:
        return _spelt_all(arg[3])
    if op is node.BRANCH:
        parts = [_spelt_all(x) for x in arg[1]]
        return None if None in parts else set().union(*parts)
    if op is node.MAX_REPEAT and arg[1] <= 8:
        once, least, most = _spelt_all(arg[2]), int(arg[0]), int(arg[1])
        if once is not None and len(once) ** most <= SPELT:
            powers = [{""}]
            for _ in range(most):
                powers.append({x + y for x in powers[-1] for y in once})
            return set().union(*powers[least:])
    return None


def _spelt_all(tree: list) -> set[str] | None:
    strings = {""}
    for op, arg in tree:
        more = _spelt(op, arg)
        if more is None or len(strings) * len(more) > SPELT:
            return None
        strings = {x + y for x in strings for y in more}
    return strings


def _query(tree: list) -> frozenset:
    query, run = ANY, {""}
    for op, arg in [*tree, (None, None)]:
        more = _spelt(op, arg) if op is not None else None
        if more is not None and len(run) * len(more) <= SPELT:
            run = {x + y for x in run for y in more}
            continue
        query, run = _both(query, _of_strings(run)), {""}
        if op is node.SUBPATTERN:
            query = _both(query, _query(arg[3]))
        elif op is node.BRANCH:
            query = _both(query, frozenset().union(*(_query(x) for x in arg[1])))
        elif op is node.MAX_REPEAT and arg[0] > 0:
            query = _both(query, _query(arg[2]))
        elif more is not None:
            run = more
    return ANY if frozenset() in query else query


def trigram_query(regex: str) -> list[list[str]]:
    """Alternatives of trigrams in lower case; a match needs all of at least one. Empty: no condition."""
    query = _query(_parser.parse(regex).data)
    return [] if query == ANY else sorted(sorted(x) for x in query)


# --- index and candidates ----------------------------------------------------------------------------------


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index for `trigrams`: trigram, doc_id."""
    text = docs.select("doc_id", F.lower("text").alias("_text"))
    held = F.array(*[F.when(F.contains("_text", F.lit(g)), F.lit(g)) for g in trigrams])
    return text.select("doc_id", F.explode(F.array_compact(held)).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """doc_id and the kinds whose trigram query the document meets."""
    asked = [(r.kind, n, g, len(alt)) for r in rules for n, alt in enumerate(trigram_query(r.regex)) for g in alt]
    # A few dozen rows, fixed by the rules.
    queries = index.sparkSession.createDataFrame(asked, "kind string, alternative int, trigram string, needed int")
    lists = index.join(F.broadcast(queries), "trigram").groupBy("doc_id", "kind", "alternative", "needed")
    met = lists.agg(F.count_distinct("trigram").alias("held")).where("held = needed")
    return met.groupBy("doc_id").agg(F.collect_set("kind").alias("_kinds"))


# --- verification ------------------------------------------------------------------------------------------


def _matches(text: Column, rule: Rule) -> Column:
    """Array of (start, end) of a rule's matches: text between matches and the matches tell the positions."""
    regex = F.lit(rule.regex)
    whole = F.regexp_extract_all(text, regex, F.lit(0))
    judged = F.regexp_extract_all(text, regex, F.lit(rule.group)) if rule.group else whole
    parts = F.arrays_zip(F.split(text, rule.regex, -1).alias("gap"), whole.alias("hit"), judged.alias("judged"))
    none = F.array().cast("array<struct<start:int,end:int>>")
    begin = F.struct(F.lit(0).alias("at"), none.alias("found"))

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + F.length(part["gap"])
        end = start + F.coalesce(F.length(part["hit"]), F.lit(0))
        span = F.struct(start.alias("start"), end.alias("end"))
        long = F.coalesce(F.length(part["judged"]) >= rule.at_least, F.lit(False))
        return F.struct(end.alias("at"), F.when(long, F.array_append(state["found"], span)).otherwise(state["found"]).alias("found"))

    return F.aggregate(parts, begin, step, lambda state: state["found"])


def _named(rank: int, kind: str) -> Callable[[Column], Column]:
    return lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"))


def _of_kind(kind: str) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == kind


def spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every row of `docs` as the struct `row`, with `spans`: array of (start, rank, end, kind) in order."""
    queries = {r.kind: trigram_query(r.regex) for r in rules}
    trigrams = sorted({g for q in queries.values() for alternative in q for g in alternative})
    found = candidates(postings(docs, trigrams), rules)
    joined = attach(docs, "doc_id", found, ["_kinds"])
    # NULL ids don't join; their rows are all searched.
    kinds = F.coalesce("_kinds", F.when(F.col("row.doc_id").isNull(), F.array(*[F.lit(r.kind) for r in rules])), F.array().cast("array<string>"))
    text, parts = F.coalesce("row.text", F.lit("")), []
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    for rank, rule in enumerate(rules):
        worth = F.array_contains(kinds, rule.kind) if queries[rule.kind] else text.rlike(rule.screen)
        parts.append(F.when(worth, F.transform(_matches(text, rule), _named(rank, rule.kind))).otherwise(none))
    return joined.select("row", F.array_sort(F.concat(*parts)).alias("spans"))


def listed(found: Column) -> Column:
    texts = F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.concat_ws(",", texts)


def mask_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mask: str = "[SECRET]") -> DataFrame:
    """`docs` with every span of its texts replaced by `mask`; spans that touch or overlap share one mask."""
    found = spans(docs, rules)
    text = F.col("row.text")
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("kept"))

    def step(state: Column, span: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, F.greatest(span["start"] - state["at"], F.lit(0)))
        first = (span["start"] > state["at"]) | (state["kept"] == "")
        kept = F.concat(state["kept"], gap, F.when(first, F.lit(mask)).otherwise(F.lit("")))
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), kept.alias("kept"))

    masked = F.aggregate("spans", begin, step, lambda s: F.concat(s["kept"], F.substring(text, s["at"] + 1, 2**31 - 1)))
    new = F.when(F.size("spans") > 0, masked).otherwise(text)
    return found.select(F.col("row").withField("text", new).alias("row")).select("row.*")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(table(spark, sf_dir, "documents"))


def secret_digest(docs: DataFrame) -> DataFrame:
    found = spans(docs.select("doc_id", "text")).select(F.col("row.doc_id").alias("doc_id"), "spans")
    base = [r.kind for r in RULES if r.base]
    counts = [F.size(F.filter("spans", _of_kind(k))).cast("long").alias(f"n_{k}") for k in base]
    digest = F.sha2(listed(F.filter("spans", lambda s: s["rank"] < len(base))), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, listed(F.col("spans")).alias("spans"))


def _sql_spans(rank: int, rule: Rule) -> str:
    """The spans of a rule for DuckDB, whose expressions take no `\x20`."""
    regex = rule.regex.replace("'", "''")
    return f"""
      select doc_id, row_no, {rank} as rank, '{rule.kind}' as kind,
             sum(length(gap) + coalesce(length(lag_hit), 0)) over w as start, hit, judged
      from (select *, lag(hit) over (partition by row_no order by i) as lag_hit from (
        select doc_id, row_no, unnest(string_split_regex(text, '{regex}')) as gap,
               unnest(list_concat(regexp_extract_all(text, '{regex}'), [null])) as hit,
               unnest(list_concat(regexp_extract_all(text, '{regex}', {rule.group}), [null])) as judged,
               unnest(range(len(regexp_extract_all(text, '{regex}')) + 1)) as i
        from texts where regexp_matches(text, '{regex}')))
      window w as (partition by row_no order by i)"""


_LISTED = "string_agg(kind || ':' || start::bigint || ':' || (start + length(hit))::bigint, ',' order by start, rank)"
OP4_SQL = f"""
with texts as (select doc_id, coalesce(text, '') as text, row_number() over () as row_no from documents),
found as ({" union all ".join(f"select * from ({_sql_spans(n, r)}) where length(judged) >= {r.at_least}" for n, r in enumerate(RULES))}),
per_row as (
  select row_no, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
         count(*) filter (kind = 'hex') as n_hex, {_LISTED} filter (rank < 3) as base, {_LISTED} as spans
  from found group by row_no)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from texts left join per_row using (row_no)
"""
