"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Candidates come from patterns: assigned values, access keys, hexadecimal runs, and long mixed tokens. The hash of every
candidate's value is aggregated over the whole corpus by distinct repositories and owners. A value that many owners or
many repositories hold is a widely copied example; one that few owners hold, in few repositories, looks live. Spans of the
three base patterns always stay; a mixed token is reported (kind ``owned``) only if it overlaps no base span and its value is owner-specific.

At scale: the text is read once, into a thin table of matches. Sites come from running sums over the matches of a text,
so a text costs n log n in its matches. Frequencies aggregate (hash, owner, repository) with partial sums in each task, so
one example in a third of all rows is one row per task; the join back by hash is left to the adaptive skew join.

Defined results: a null text counts as empty; null owners or repositories are one owner or repository of their own.
Repeated rows are scanned alike. Extra columns are ignored. An empty table gives no rows. Positions are code points, end
exclusive. Matches are leftmost and do not overlap within a kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrane.llm.common import ROW, stash, with_rows

#: Fixed patterns of the contract.
KEY = "[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
ASSIGN = rf"""({KEY})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
#: Tokens the method may add: long, with digits and letters of both cases.
MIXED = "[A-Za-z0-9_-]{20,}"
KINDS = ("assign", "access", "hex", "owned")
MAX_OWNERS = 2
EXAMPLE_OWNERS = 4
MAX_REPOS = 4
EXAMPLE_REPOS = 12

_SPAN = "struct<start:bigint,kind:int,end:bigint,value:string,owners:bigint,repos:bigint,verdict:string>"


def _matches(text: Column, pattern: str, kind: int, value_group: int = 0) -> Column:
    """All matches of a pattern in order, as structs (kind, i, gap, length, value); ``gap`` is the distance from the match before."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)) if value_group else found
    pieces = F.arrays_zip(F.slice(F.split(text, pattern, -1), 1, F.size(found)).alias("gap"), found.alias("hit"), values.alias("value"))
    each = F.transform(pieces, lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("length"), x["value"].alias("value")))
    return F.when(text.rlike(pattern), each).otherwise(F.array().cast("array<struct<kind:int,i:int,gap:int,length:int,value:string>>"))


def _listed(spans: Column) -> Column:
    """kind:start:end of each span, by start, then kind, joined by commas."""
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string"))), ",")


def matched(docs: DataFrame, owner: str, repository: Column | str) -> DataFrame:
    """One row per row of ``docs``: row key, doc_id, owner, repository and the matches of all patterns."""
    repo = F.col(repository) if isinstance(repository, str) else repository
    d = with_rows(docs, "doc_id", F.col(owner).cast("string").alias("owner"), repo.cast("string").alias("repo"), F.coalesce("text", F.lit("")).alias("text"))
    found = F.concat(_matches(F.col("text"), ASSIGN, 0, 2), _matches(F.col("text"), ACCESS, 1), _matches(F.col("text"), HEX, 2), _matches(F.col("text"), MIXED, 3))
    return d.select(ROW, "doc_id", "owner", "repo", found.alias("found"))


def candidates(rows: DataFrame) -> DataFrame:
    """(row key, owner, repo, kind, start, end, value): the matches in ``rows`` that count, mixed tokens only where no base span lies."""
    each = rows.select(ROW, "owner", "repo", F.inline("found"))
    end = F.sum(F.col("gap").cast("long") + F.col("length")).over(Window.partitionBy(ROW, "kind").orderBy("i"))
    each = each.withColumn("end", end).withColumn("start", F.col("end") - F.col("length")).drop("i", "gap", "length")
    mixed = F.col("value").rlike("[0-9]") & F.col("value").rlike("[a-z]") & F.col("value").rlike("[A-Z]")
    each = each.where(F.when(F.col("kind") == 0, F.length("value") >= 6).when(F.col("kind") == 3, mixed).otherwise(F.lit(True)))
    order = Window.partitionBy(ROW).orderBy("start", "kind")
    base = lambda c: F.when(F.col("kind") < 3, F.col(c))
    before = F.max(base("end")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    after = F.min(base("start")).over(order.rowsBetween(0, Window.unboundedFollowing))
    each = each.withColumn("before", before).withColumn("after", after)
    apart = (F.coalesce("before", F.lit(0)) <= F.col("start")) & (F.coalesce("after", F.col("end")) >= F.col("end"))
    return each.where((F.col("kind") < 3) | apart).drop("before", "after")


def ownership(found: DataFrame) -> DataFrame:
    """For each value hash the number of distinct owners and repositories in the corpus. ``found`` has (hash, owner, repo)."""
    seen = found.groupBy("hash", "owner", "repo").agg(F.count("*").alias("n"))
    by_owner = seen.groupBy("hash", "owner").agg(F.count("*").alias("repos"), F.sum("n").alias("n"))
    return by_owner.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repos").alias("repos"), F.sum("n").alias("n"))


def verdict(max_owners: int, example_owners: int, max_repos: int, example_repos: int) -> Column:
    """What the numbers of owners and repositories that hold a value say about it."""
    example = (F.col("owners") >= example_owners) | (F.col("repos") >= example_repos)
    return F.when(example, "example").when((F.col("owners") <= max_owners) & (F.col("repos") <= max_repos), "live").otherwise("shared")


def scan(docs: DataFrame, owner: str = "source", repository: Column | str = "source", max_owners: int = MAX_OWNERS, example_owners: int = EXAMPLE_OWNERS, max_repos: int = MAX_REPOS, example_repos: int = EXAMPLE_REPOS) -> DataFrame:
    """One row per row of ``docs``: row key, doc_id, ``base`` spans and ``spans`` (base and owner-specific ones), each span with its kind, value, owners, repos and verdict (live, shared or example)."""
    rows = stash(matched(docs, owner, repository), "matches")
    each = stash(candidates(rows).withColumn("hash", F.unhex(F.sha2("value", 256))), "candidates")
    known = ownership(each.select("hash", "owner", "repo"))
    judged = each.join(known, "hash").withColumn("verdict", verdict(max_owners, example_owners, max_repos, example_repos)).where("kind < 3 or verdict = 'live'")
    span = F.struct("start", "kind", "end", "value", "owners", "repos", "verdict")
    kept = judged.groupBy(ROW).agg(F.array_sort(F.collect_list(span)).alias("spans"))
    spans = F.coalesce("spans", F.array().cast(f"array<{_SPAN}>"))
    return rows.select(ROW, "doc_id").join(kept, ROW, "left").withColumn("spans", spans).withColumn("base", F.filter("spans", lambda s: s["kind"] < 3))


def op4(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = scan(docs, "source", F.concat_ws("/", "source", "lang"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    judged = lambda v: F.size(F.filter("spans", lambda s: s["verdict"] == v)).cast("long")
    return rows.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"),
        judged("live").alias("n_live"), judged("example").alias("n_example"),
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["owners"].cast("string"), s["repos"].cast("string"))), ",").alias("held_by"),
    )


def _sql_part(kind: int, pattern: str, group: int, keep: str) -> str:
    """DuckDB SQL: the matches of one pattern as rows (doc_id, source, lang, kind, s, e, v)."""
    p = pattern.replace("'", "''")
    return f"""
  select doc_id, source, lang, {kind} kind, s, s + len(h) e, v from (
    select doc_id, source, lang, hits[i] h, vals[i] v,
           cast(list_sum(list_transform(gaps[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(hits[1:i-1], lambda x: len(x))), 0) as bigint) s
    from (
      select doc_id, source, lang, regexp_extract_all(text, '{p}') hits, regexp_extract_all(text, '{p}', {group}) vals,
             string_split_regex(text, '{p}') gaps, unnest(range(1, len(regexp_extract_all(text, '{p}')) + 1)) i
      from d where regexp_matches(text, '{p}')))
  where {keep}"""


SQL = f"""
with d as (select doc_id, source, lang, coalesce(text, '') as text from documents),
base as ({_sql_part(0, ASSIGN, 2, "len(v) >= 6")} union all {_sql_part(1, ACCESS, 0, "true")} union all {_sql_part(2, HEX, 0, "true")}),
mixed as ({_sql_part(3, MIXED, 0, "regexp_matches(v, '[0-9]') and regexp_matches(v, '[a-z]') and regexp_matches(v, '[A-Z]')")}),
apart as (select * from mixed m where not exists (select 1 from base b where b.doc_id = m.doc_id and b.s < m.e and m.s < b.e)),
every as (select * from base union all select * from apart),
freq as (
  select v, count(distinct coalesce(source, chr(1))) owners,
         count(distinct coalesce(source, chr(1)) || chr(2) || concat_ws('/', source, lang)) repos
  from every group by v),
judged as (
  select e.*, owners, repos, case when owners >= {EXAMPLE_OWNERS} or repos >= {EXAMPLE_REPOS} then 'example'
         when owners <= {MAX_OWNERS} and repos <= {MAX_REPOS} then 'live' else 'shared' end verdict
  from every e join freq f on e.v = f.v),
kept as (
  select *, (case kind when 0 then 'assign' when 1 then 'access' when 2 then 'hex' else 'owned' end) || ':' || s || ':' || e item
  from judged where kind < 3 or verdict = 'live'),
agg as (
  select doc_id, count(*) filter (where kind = 0) n_assign, count(*) filter (where kind = 1) n_access, count(*) filter (where kind = 2) n_hex,
         string_agg(item, ',' order by s, kind) filter (where kind < 3) base, string_agg(item, ',' order by s, kind) spans,
         count(*) filter (where verdict = 'live') n_live, count(*) filter (where verdict = 'example') n_example,
         string_agg(owners || ':' || repos, ',' order by s, kind) held_by
  from kept group by doc_id)
select d.doc_id, coalesce(n_assign, 0) n_assign, coalesce(n_access, 0) n_access, coalesce(n_hex, 0) n_hex,
       sha256(coalesce(base, '')) base_sha256, coalesce(spans, '') spans, coalesce(n_live, 0) n_live, coalesce(n_example, 0) n_example, coalesce(held_by, '') held_by
from d left join agg on d.doc_id = agg.doc_id
"""
