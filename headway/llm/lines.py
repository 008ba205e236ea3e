"""Cross-site boilerplate lines: spread over distinct sites by HyperLogLog sketches per line.

Every line's sites are sketched by line hash; sketches merge by aggregation,
so a line on a third of all documents costs one sketch per task.  Lines whose
estimate is within ``BAND`` of the threshold get an exact distinct count, the
others are decided by their sketch.  Lines on at least ``SITES`` sites go.

Lines are compared without surrounding blanks; blank lines stay.  Defined
results: a null text has no lines and stays null; an empty text has one blank
line; rows without a source count for no site; repeated rows get equal
results; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .store import write_table

SITES = 10
LG_K = 12                                  # 4096 registers: standard error 1.6 %
BAND = 6 * 1.04 / 2 ** (LG_K / 2)          # six standard errors


def line_rows(docs: DataFrame) -> DataFrame:
    """One row per line that is not blank: document key, place, 128-bit line hash, site."""
    return docs.select(
        F.col("doc_id"), F.xxhash64("text").alias("mark"), F.col("source").alias("site"),
        F.posexplode(F.split("text", "\n", -1)).alias("place", "line"),
    ).withColumn("line", F.trim("line", F.lit(" \t\r"))).where("line <> ''").select(
        "doc_id", "mark", "site", "place", F.xxhash64("line").alias("h1"), F.xxhash64("line", F.lit(29)).alias("h2"))


def spread_lines(lines: DataFrame, sites: int = SITES) -> DataFrame:
    """``h1, h2`` of the lines on at least ``sites`` distinct sites."""
    estimate = lines.groupBy("h1", "h2").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_K))).alias("estimate"))
    estimate = write_table(estimate.where(F.col("estimate") >= sites * (1 - BAND)), "lines-estimates")
    sure = F.col("estimate") > sites * (1 + BAND)
    near = estimate.where(~sure).select("h1", "h2")
    exact = (lines.join(near, ["h1", "h2"], "left_semi").groupBy("h1", "h2", "site").agg(F.count("*"))
             .groupBy("h1", "h2").agg(F.count("site").alias("n")).where(F.col("n") >= sites))
    return estimate.where(sure).select("h1", "h2").union(exact.select("h1", "h2"))


def clean(docs: DataFrame, sites: int = SITES) -> DataFrame:
    """``doc_id, n_lines, n_removed, text`` of every document."""
    lines = write_table(line_rows(docs), "lines")
    spread = write_table(spread_lines(lines, sites), "lines-spread")
    hits = write_table(
        lines.join(spread, ["h1", "h2"], "left_semi").groupBy("doc_id", "mark").agg(F.sort_array(F.collect_set("place")).alias("places")),
        "lines-hits").withColumnsRenamed({"doc_id": "hit_id", "mark": "hit_mark"})
    # hits grow with the documents: merged at every size, not broadcast while they happen to be few
    rows = docs.select("doc_id", F.split("text", "\n", -1).alias("parts"), F.xxhash64("text").alias("mark")).join(
        hits.hint("merge"), F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("mark") == F.col("hit_mark")), "left")
    # the runs of lines between removed ones, each cut out once
    first = F.concat(F.array(F.lit(0)), F.transform("places", lambda i: i + 1))
    behind = F.concat(F.col("places"), F.array(F.size("parts")))
    kept = F.flatten(F.zip_with(first, behind, lambda a, b: F.slice("parts", a + 1, b - a)))
    return rows.select(
        "doc_id", F.coalesce(F.size("parts"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_removed"),
        F.array_join(F.when(F.col("places").isNull(), F.col("parts")).otherwise(kept), "\n").alias("text"))


ORACLE_SQL = f"""
WITH l AS (
  SELECT d.r, i, trim(lines[i], ' ' || chr(9) || chr(13)) AS line, source FROM
    (SELECT row_number() OVER () AS r, source, string_split(text, chr(10)) AS lines FROM documents) d,
    unnest(range(1, len(lines) + 1)) AS t(i)),
b AS (SELECT line FROM l WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= {SITES}),
c AS (SELECT r, list(i) AS gone FROM l JOIN b USING (line) GROUP BY r),
d AS (SELECT row_number() OVER () AS r, doc_id, text, string_split(text, chr(10)) AS lines FROM documents)
SELECT doc_id, coalesce(len(lines), 0)::BIGINT AS n_lines, coalesce(len(gone), 0)::BIGINT AS n_removed,
  CASE WHEN gone IS NULL THEN text ELSE array_to_string(
    list_transform(list_filter(range(1, len(lines) + 1), lambda i: NOT list_contains(gone, i)), lambda i: lines[i]), chr(10)) END AS text
FROM d LEFT JOIN c USING (r)
"""
