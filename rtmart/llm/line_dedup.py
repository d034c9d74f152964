"""Cross-site boilerplate removal by how many distinct sites carry a line.

A HyperLogLog sketch of the sites is aggregated per line hash: partial sketches per task are merged by the shuffle, so a line
that a third of all rows carry sends one sketch per task. Lines whose estimate is clear are decided by it; those near the
threshold (within the sketch's error band) get exact distinct counts. A line on ``min_sites`` or more sites keeps its first
place (smallest doc_id, then position) and goes everywhere else.

The lines that the sketches leave and the lines decided on are stored in the shared folder, so each is worked out once and joined by
its known size. A text meets its places as it is and is split only then: no shuffle carries it twice.

Defined results: lines are split at line feeds and compared without blanks at their ends; lines without other characters
are no boilerplate; a null text stays null with 0 lines; a null source is a site of its own; a row with a null ``doc_id`` stays
as it is and counts for nothing; rows that repeat a ``doc_id`` count as one document. Other columns stay, but for ``n_lines`` and
``n_removed``, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rtmart.llm.shared import stored

MIN_SITES = 10
LG_K = 12
ERROR = 0.05  # three standard errors of a sketch of 2**12 registers
BLANKS = " \t\r\x0b\x0c"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _line_rows(docs: DataFrame, *more: Column) -> DataFrame:
    """A row per line with its place and a 128-bit key; keys of blank lines are left out."""
    rows = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").alias("_doc"), *more, F.posexplode(_lines(F.col("text"))).alias("_pos", "_line")
    )
    line = F.btrim("_line", F.lit(BLANKS))
    rows = rows.where(line != "")
    keys = [F.xxhash64(line).alias("_h1"), F.xxhash64(F.lit(1), line).alias("_h2")]
    return rows.select("_doc", "_pos", *[F.col(c) for c in rows.columns if c not in ("_doc", "_pos", "_line")], *keys)


def boilerplate(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(_h1, _h2, _first): line keys on at least ``min_sites`` sites and the place of their first copy."""
    rows = _line_rows(docs, F.coalesce("source", F.lit("")).alias("_site"))
    place = F.struct(F.col("_doc").alias("doc"), F.col("_pos").alias("pos"))
    spread = rows.groupBy("_h1", "_h2").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("_site", F.lit(LG_K))).alias("_sites"), F.min(place).alias("_first")
    )
    low, high = min_sites * (1 - ERROR) - 1, min_sites * (1 + ERROR) + 1
    spread = stored(spread.where(F.col("_sites") >= low), "line-spread")
    clear = spread.where(F.col("_sites") > high).select("_h1", "_h2", "_first")
    near = spread.where(F.col("_sites") <= high).select("_h1", "_h2", "_first")
    exact = rows.select("_h1", "_h2", "_site").join(near.select("_h1", "_h2"), ["_h1", "_h2"], "left_semi")
    exact = exact.groupBy("_h1", "_h2").agg(F.countDistinct("_site").alias("_sites")).where(F.col("_sites") >= min_sites)
    return stored(clear.unionByName(near.join(exact.select("_h1", "_h2"), ["_h1", "_h2"])), "line-common")


def dedup(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """The rows of ``docs`` with the text cut, and n_lines and n_removed."""
    common = boilerplate(docs, min_sites)
    gone = (
        _line_rows(docs)
        .join(common, ["_h1", "_h2"])
        .where((F.col("_doc") != F.col("_first.doc")) | (F.col("_pos") != F.col("_first.pos")))
        .groupBy("_doc")
        .agg(F.collect_set("_pos").alias("_gone"))
    )
    # The row travels as one column, so that no name of it can clash.
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").alias("_id"))
    cut = rows.join(gone, F.col("_id") == F.col("_doc"), "left").withColumn("_lines", _lines(F.col("_row.text")))
    # Places that stay, as a hashed difference; without a hit the text is not touched.
    left = F.array_except(F.sequence(F.lit(0), F.array_size("_lines") - 1), F.col("_gone"))
    cut = cut.withColumn("_left", F.when(F.col("_gone").isNotNull() & F.col("_lines").isNotNull(), left))
    kept = F.transform("_left", lambda i: F.col("_lines")[i])
    text = F.when(F.col("_left").isNull(), F.col("_row.text")).otherwise(F.array_join(kept, "\n"))
    n_lines = F.coalesce(F.array_size("_lines"), F.lit(0)).cast("long")
    return cut.select(
        *[(text if c == "text" else F.col("_row")[c]).alias(c) for c in docs.columns if c not in ("n_lines", "n_removed")],
        n_lines.alias("n_lines"),
        F.coalesce(n_lines - F.array_size("_left"), F.lit(0)).cast("long").alias("n_removed"),
    )


def digest(docs: DataFrame) -> DataFrame:
    out = dedup(docs.select("doc_id", "source", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


ORACLE = f"""
WITH lines AS (
  SELECT doc_id, coalesce(source, '') AS site, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents
), named AS (
  SELECT *, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS word FROM lines
), common AS (
  SELECT word, min(struct_pack(doc := doc_id, pos := pos)) AS first FROM named WHERE word <> ''
  GROUP BY word HAVING count(DISTINCT site) >= {MIN_SITES}
), marked AS (
  SELECT n.doc_id, n.pos, n.line,
         c.word IS NOT NULL AND (n.doc_id <> c.first.doc OR n.pos <> c.first.pos) AS gone
  FROM named n LEFT JOIN common c ON n.word = c.word
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
