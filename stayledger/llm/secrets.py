"""Secret candidates judged by corpus-wide ownership.

Candidates of a text: assigned values, access keys, hexadecimal runs (the base, always
reported), and mixed tokens of 20 or more characters. Every candidate's hash is aggregated
over the whole corpus by distinct repositories and owners: one that a single owner holds in
few repositories looks live, one that many owners hold is a widely copied example. Mixed
tokens that look live are added to the base spans; examples are not.

A document stands for a repository and its source for the owner; null owners count as one
unnamed owner, null repositories as one. Null or empty text has no spans. Repeated rows are
reported each, but count once as a repository. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, table


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# fixed values: the base patterns and their least lengths
KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
ASSIGN = "(" + "|".join(map(either_case, KEYWORDS)) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LENGTH = 6
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "key")

MIXED = "[A-Za-z0-9+/_-]{20,}"
#: A live candidate has one owner and at most so many repositories; an example so many owners.
LIVE_OWNERS, LIVE_REPOSITORIES, EXAMPLE_OWNERS = 1, 3, 3

SPAN = "struct<s:int,k:int,e:int,v:string>"


def spans_of(text, pattern: str, kind: int, group: int = 0, least: int = 0):
    """(start, kind, end, value) of the pattern's matches, in code points.

    The text between matches and the matches themselves alternate, so their lengths add up
    to the positions.
    """
    between = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    zipped = F.arrays_zip(F.slice(between, F.lit(1), F.size(whole)).alias("g"), whole.alias("m"), value.alias("v"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))

    def step(acc, x):
        begin = acc["at"] + F.length(x["g"])
        end = begin + F.length(x["m"])
        span = F.struct(begin.alias("s"), F.lit(kind).alias("k"), end.alias("e"), x["v"].alias("v"))
        return F.struct(end.alias("at"), F.when(F.length(x["v"]) >= least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(zipped, start, step, lambda acc: acc["out"])


def joined(spans):
    names = F.array(*map(F.lit, KINDS))
    one = lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source") -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example) for every row."""
    work = Workspace(docs.sparkSession, "secrets")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    found = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("owner"),
        spans_of(text, ASSIGN, 0, 2, ASSIGN_LENGTH).alias("assign"),
        spans_of(text, ACCESS, 1).alias("access"),
        spans_of(text, HEX, 2).alias("hex"),
        F.filter(spans_of(text, MIXED, 3), lambda x: x["v"].rlike("[0-9]") & x["v"].rlike("[A-Z]") & x["v"].rlike("[a-z]")).alias("mixed"),
    )
    base = F.sort_array(F.concat("assign", "access", "hex"))
    apart = F.filter("mixed", lambda x: ~F.exists("base", lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"])))
    found = found.withColumn("base", base).withColumn("extra", apart)
    # written without the texts; the row number is fixed from here on
    marked = work.write(
        found.select("id", "owner", F.size("assign").alias("n_assign"), F.size("access").alias("n_access"), F.size("hex").alias("n_hex"), "base", "extra").withColumn("row", F.monotonically_increasing_id()),
        "candidates",
    )
    each = marked.select("row", "id", "owner", F.explode(F.concat("base", "extra")).alias("x"))
    each = each.withColumn("h1", F.xxhash64("x.v")).withColumn("h2", F.xxhash64(F.lit(7), "x.v"))
    holders = each.groupBy("h1", "h2", "owner", F.coalesce(F.col("id").cast("string"), F.lit("")).alias("repo")).agg(F.lit(1).alias("one"))
    owners = holders.groupBy("h1", "h2", "owner").agg(F.count("*").alias("repos"))
    spread = owners.groupBy("h1", "h2").agg(F.count("*").alias("owners"), F.sum("repos").alias("repos"))
    live = (F.col("owners") <= LIVE_OWNERS) & (F.col("repos") <= LIVE_REPOSITORIES)
    judged = each.join(spread, ["h1", "h2"]).groupBy("row").agg(
        F.collect_list(F.when(live & (F.col("x.k") == 3), F.col("x"))).alias("added"),
        F.count_if(live).alias("n_live"),
        F.count_if(F.col("owners") >= EXAMPLE_OWNERS).alias("n_example"),
    )
    none = F.array().cast(f"array<{SPAN}>")
    whole = F.sort_array(F.concat("base", F.coalesce("added", none)))
    return marked.join(judged, "row", "left").select(
        F.col("id").alias(id_col),
        *(F.col(c).cast("long").alias(c) for c in ("n_assign", "n_access", "n_hex")),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(whole).alias("spans"),
        F.coalesce("n_live", F.lit(0)).cast("long").alias("n_live"),
        F.coalesce("n_example", F.lit(0)).cast("long").alias("n_example"),
    )


def op4_secrets(spark, folder: str) -> DataFrame:
    return find_secrets(table(spark, folder, "documents"))


def _sql_spans(pattern: str, kind: int, group: int = 0, condition: str = "true") -> str:
    p = pattern.replace("'", "''")
    return f"""[x for x in [{{'s': coalesce(list_sum([length(y) for y in g[1:i]]), 0) + coalesce(list_sum([length(y) for y in m[1:i - 1]]), 0), 'k': {kind},
        'e': coalesce(list_sum([length(y) for y in g[1:i]]), 0) + coalesce(list_sum([length(y) for y in m[1:i]]), 0), 'v': v[i]}} for i in range(1, len(m) + 1)] if {condition}]
        FROM (SELECT string_split_regex(t, '{p}') AS g, regexp_extract_all(t, '{p}') AS m, regexp_extract_all(t, '{p}', {group}) AS v)"""


SQL = f"""
WITH found AS (
  SELECT doc_id, coalesce(source, '') AS owner, row_number() OVER () AS r,
    (SELECT {_sql_spans(ASSIGN, 0, 2, f"length(x.v) >= {ASSIGN_LENGTH}")}) AS a,
    (SELECT {_sql_spans(ACCESS, 1)}) AS b,
    (SELECT {_sql_spans(HEX, 2)}) AS c,
    (SELECT {_sql_spans(MIXED, 3, 0, "regexp_matches(x.v, '[0-9]') AND regexp_matches(x.v, '[A-Z]') AND regexp_matches(x.v, '[a-z]')")}) AS d
  FROM (SELECT doc_id, source, coalesce(text, '') AS t FROM documents)
), based AS (
  SELECT *, list_sort(list_concat(list_concat(a, b), c)) AS base FROM found
), apart AS (
  SELECT *, [x for x in d if len([y for y in base if y.s < x.e AND x.s < y.e]) = 0] AS extra FROM based
), each_one AS (
  SELECT r, doc_id, owner, unnest(list_concat(base, extra)) AS x FROM apart
), spread AS (
  SELECT x.v AS v, count(DISTINCT owner) AS owners, count(DISTINCT owner || ' ' || coalesce(CAST(doc_id AS VARCHAR), '')) AS repos FROM each_one GROUP BY 1
), judged AS (
  SELECT r, list(x) FILTER (owners <= {LIVE_OWNERS} AND repos <= {LIVE_REPOSITORIES} AND x.k = 3) AS added,
    count(*) FILTER (owners <= {LIVE_OWNERS} AND repos <= {LIVE_REPOSITORIES}) AS n_live, count(*) FILTER (owners >= {EXAMPLE_OWNERS}) AS n_example
  FROM each_one JOIN spread ON each_one.x.v = spread.v GROUP BY r
)
SELECT doc_id, len(a) AS n_assign, len(b) AS n_access, len(c) AS n_hex,
  sha256(array_to_string([['assign', 'access', 'hex', 'key'][x.k + 1] || ':' || x.s || ':' || x.e for x in base], ',')) AS base_sha256,
  array_to_string([['assign', 'access', 'hex', 'key'][x.k + 1] || ':' || x.s || ':' || x.e for x in list_sort(list_concat(base, coalesce(added, [])))], ',') AS spans,
  coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM apart LEFT JOIN judged USING (r)
"""
