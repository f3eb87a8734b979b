"""Line dedup: lines that many documents share stay in one of them.

Lines are exploded with their positions and hashed, once; distinct documents are
counted per hash; positions of lines over the threshold are dropped, and each
text is put together again from those that stay, in time linear in its lines. Only hashes and
positions are shuffled for the counts, map-side combined, so a line that a third
of all documents hold is one row per map task. The shared lines are stored, so their true size
decides whether they travel to the tasks or are joined by a shuffle that splits uneven keys. Texts move once, by document.

Defined cases: a null or empty text is one empty line and stays as an empty text;
rows with the same doc_id are one document for the counts, and each is cut by its
own lines; rows with a null doc_id are no document: they count for no line and keep all of theirs; a line
repeated inside the document that keeps it stays each time; a text may have any number of lines; extra
columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import packed, settle, table

MIN_CHARS = 20
MIN_DOCS = 3

_BLANKS = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    """The line without blanks at its ends and with A-Z (only) in lower case."""
    bare = F.btrim(line, F.lit(_BLANKS))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _UPPER.lower()))


def _lines(docs: DataFrame, text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def _row_hash(text: str) -> Column:
    """Tells rows of one doc_id apart; equal rows need not be."""
    return F.xxhash64(F.lit(2), F.col(text))


def hashed_lines(docs: DataFrame, min_chars: int = MIN_CHARS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, h, pos, h1, h2) of every line whose key has `min_chars` code points: the row's hash, a 128-bit hash of the key."""
    named = docs.where(F.col(doc_id).isNotNull())
    # The hash is taken below the generator: beside it, it would be taken of the whole text for each line.
    split = named.select(F.col(doc_id).alias("doc"), _row_hash(text).alias("h"), _lines(docs, text).alias("lines"))
    exploded = split.select("doc", "h", F.posexplode("lines").alias("pos", "line"))
    keyed = exploded.where(F.char_length("line") >= min_chars).select("doc", "h", "pos", line_key(F.col("line")).alias("key"))
    return keyed.where(F.char_length("key") >= min_chars).select(
        "doc", "h", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")
    )


def shared_lines(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(h1, h2, keeper): hashes found in at least `min_docs` documents, and the largest doc_id holding each."""
    return (
        lines.groupBy("h1", "h2")
        .agg(F.count_distinct("doc").alias("n_docs"), F.max("doc").alias("keeper"))
        .where(F.col("n_docs") >= min_docs)
        .select("h1", "h2", "keeper")
    )


def dedup_lines(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """`docs` with `kept_text`, `n_lines` (before) and `n_dropped` added; their own columns stay as they are.

    Names: a column of `docs` called like an added one is replaced.
    """
    lines = settle(hashed_lines(docs, min_chars, doc_id, text), "lines")
    shared = settle(shared_lines(lines, min_docs), "shared-lines")
    dropped = (
        lines.join(shared, ["h1", "h2"])
        .where(F.col("doc") != F.col("keeper"))
        .groupBy("doc", "h")
        .agg(F.array_sort(F.collect_set("pos")).alias("gone"))
    )
    own = packed(docs.drop("kept_text", "n_lines", "n_dropped"), doc_id, text).withColumn("own_h", _row_hash("text"))
    joined = own.join(dropped, (own["id"] == dropped["doc"]) & (own["own_h"] == dropped["h"]), "left")
    # By a generator, as an expression may be put into the lambdas below and be computed anew for each of their elements.
    opened = joined.select("row", "text", "gone", F.inline(F.array(F.struct(_lines(own, "text").alias("lines")))))
    # Of numbers, array_except is a hash look-up.
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    kept = F.array_join(F.transform(places, lambda i: F.get("lines", i)), "\n")
    return opened.select(
        "row.*",
        F.when(F.col("gone").isNull(), F.coalesce("text", F.lit(""))).otherwise(kept).alias("kept_text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"),
    )


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )


OP1_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT k.doc_id, pos, line, keeper IS NOT NULL AND keeper <> k.doc_id AS gone
  FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
