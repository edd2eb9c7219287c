"""Cross-site boilerplate lines by distinct-site spread.

Each line's hash gets a HyperLogLog sketch of the sites it stands on; partial sketches
merge by aggregation. Lines clearly above the threshold are boilerplate by the sketch,
lines within the sketch's error of it are counted exactly. Boilerplate lines are removed
from documents that say something else as well; a document of nothing but boilerplate is
a copy, which line removal leaves whole for near-duplicate removal.

Lines are compared without the spaces around them; lines shorter than `least` characters
never count: they are not removed, and a document whose other lines are all boilerplate is
left whole. The SQL states 20 characters; with 1, as in the pipeline, every line counts
that is not blank. Null text stays null, empty text empty. A null site counts as one unnamed
site. Repeated rows are judged alike. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, table, text_key

#: Sites from which a line is boilerplate; least characters of a line; sketch size (log2).
SITES, LEAST, SKETCH = 10, 20, 10
#: Three standard errors of a sketch of that size.
BAND = 3 * 1.04 / 2 ** (SKETCH / 2)


def line_hash(line):
    """128 bits of a line."""
    return F.struct(F.xxhash64(F.trim(line)).alias("h1"), F.xxhash64(F.lit(7), F.trim(line)).alias("h2"))


def hashes(text, least: int):
    """Distinct hashes of the lines of a text that count."""
    counted = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.trim(x)) >= least)
    return F.array_distinct(F.transform(counted, line_hash))


def boilerplate(docs: DataFrame, text_col: str, site_col: str, sites: int, least: int, work: Workspace) -> DataFrame:
    """(h1, h2) of the lines that stand on at least `sites` sites."""
    # sketches leave out empty strings, so a site's name never is one
    site = F.concat(F.lit("="), F.coalesce(F.col(site_col).cast("string"), F.lit("")))
    each = docs.select(site.alias("site"), F.explode(hashes(F.col(text_col), least)).alias("h"))
    # a line's rows of one site meet before the shuffle, so no line is hot
    pairs = work.write(each.groupBy("h.h1", "h.h2", "site").agg(F.count("*").alias("n")).select("h1", "h2", "site"), "pairs")
    spread = pairs.groupBy("h1", "h2").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(SKETCH))).alias("estimate"))
    wide = work.write(spread.where(F.col("estimate") >= sites * (1 - BAND)), "spread")
    near = wide.where(F.col("estimate") <= sites * (1 + BAND)).select("h1", "h2")
    exact = pairs.join(near, ["h1", "h2"]).groupBy("h1", "h2").agg(F.count("*").alias("n")).where(F.col("n") >= sites)
    return wide.where(F.col("estimate") > sites * (1 + BAND)).select("h1", "h2").union(exact.select("h1", "h2"))


def remove_lines(docs: DataFrame, text_col: str = "text", site_col: str = "source", sites: int = SITES, least: int = LEAST, count_col: str = "_lines", removed_col: str = "_removed") -> DataFrame:
    """The rows of docs with boilerplate lines gone from the text, and their counts of lines.

    The two count columns can be named otherwise where docs has columns called like them.
    """
    work = Workspace(docs.sparkSession, "lines")
    common = boilerplate(docs, text_col, site_col, sites, least, work)
    # the row travels as one column, so none of its names can clash
    k1, k2 = text_key(text_col)
    own = docs.select(k1.alias("k1"), k2.alias("k2"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    each = docs.select(k1.alias("k1"), k2.alias("k2"), F.explode(hashes(F.col(text_col), least)).alias("h")).select("k1", "k2", "h.h1", "h.h2")
    met = each.join(common, ["h1", "h2"]).groupBy("k1", "k2").agg(F.collect_set(F.struct("h1", "h2")).alias("bad"))
    old = F.col("row")[text_col]
    lines = F.split(old, "\n", -1)
    stay = F.filter(lines, lambda x: ~(F.length(F.trim(x)) >= least) | ~F.array_contains("bad", line_hash(x)))
    joined = own.join(met, ["k1", "k2"], "left").withColumn("stay", F.when(F.col("bad").isNotNull(), stay))
    # what is left must hold a line of its own
    changes = F.col("bad").isNotNull() & F.exists("stay", lambda x: F.length(F.trim(x)) >= least)
    text = F.when(changes, F.array_join("stay", "\n")).otherwise(old)
    count = F.coalesce(F.when(old.isNotNull(), F.size(lines)), F.lit(0)).cast("long")
    removed = F.when(changes, F.size(lines) - F.size("stay")).otherwise(0).cast("long")
    kept = [F.col("row")[c].alias(c) if c != text_col else text.alias(text_col) for c in docs.columns]
    return joined.select(*kept, count.alias(count_col), removed.alias(removed_col))


def op7_line_dedup(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    done = remove_lines(docs)
    return done.select("doc_id", F.col("_lines").alias("n_lines"), F.col("_removed").alias("n_removed"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


SQL = f"""
WITH split AS (
  SELECT doc_id, source, text, CASE WHEN text IS NULL THEN [] ELSE string_split(text, chr(10)) END AS ls FROM documents
), common AS (
  SELECT l FROM (SELECT coalesce(source, '') AS site, unnest([trim(x) for x in ls if length(trim(x)) >= {LEAST}]) AS l FROM split)
  GROUP BY l HAVING count(DISTINCT site) >= {SITES}
), bad AS (SELECT coalesce(list(l), []) AS bad FROM common
), done AS (
  SELECT *, [x for x in ls if length(trim(x)) < {LEAST} OR NOT list_contains(bad, trim(x))] AS stay FROM split, bad
), judged AS (
  SELECT *, len([x for x in stay if length(trim(x)) >= {LEAST}]) > 0 AS changes FROM done
)
SELECT doc_id, len(ls) AS n_lines, CASE WHEN changes THEN len(ls) - len(stay) ELSE 0 END AS n_removed,
  sha256(CASE WHEN changes THEN array_to_string(stay, chr(10)) ELSE coalesce(text, '') END) AS kept_sha256
FROM judged
"""
