"""Line dedup: lines that recur across documents stay only in the document with the largest id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwarden.llm.frames import BLANKS, ascii_lower, body, digest, row_struct, with_outputs
from fleetwarden.session import staged

MIN_CHARS = 20
MIN_DOCUMENTS = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def repeated_lines(
    docs: DataFrame, id_col: str, text_col: str, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS
) -> tuple[DataFrame, DataFrame]:
    """(every long line with its place and 128 bits of its key, the keys over the threshold with the id that keeps them).

    Rows are narrow: the text itself is not shuffled. Distinct (key, document) pairs are made first, so a line that
    a third of all documents hold is already spread over its documents before it is counted.
    """
    text = body(text_col)
    lines = docs.select(
        F.col(id_col).alias("doc"), digest(text).alias("body"), F.posexplode(_lines(text)).alias("pos", "line")
    ).withColumn("key", line_key(F.col("line")))
    places = lines.where(F.char_length("key") >= min_chars).select(
        "doc", "body", "pos", digest("key", 1).alias("a"), digest("key", 2).alias("b")
    )
    repeated = (
        places.select("a", "b", "doc")
        .distinct()
        .groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("n"), F.max("doc").alias("keeper"))
        .where(F.col("n") >= min_documents)
        .drop("n")
    )
    return places, repeated


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    """docs with their text thinned, plus n_lines (before) and n_dropped.

    A null or empty text is one empty line and stays empty. A null id is a document of its own that never keeps a
    repeated line. Rows with the same id are one document when documents are counted, and each of them is thinned.
    Repeats of a line inside its keeper stay. Lines shorter than min_chars code points always stay. An input column
    named n_lines or n_dropped is replaced. An empty table gives an empty table.
    """
    places, repeated = repeated_lines(docs, id_col, text_col, min_chars, min_documents)
    # Written once: its true size lets Spark choose the join, and a hot line can be split when it shuffles.
    repeated = staged(repeated)
    dropped = (
        places.join(repeated, ["a", "b"])
        .where(~F.col("doc").eqNullSafe(F.col("keeper")))
        .groupBy("doc", "body")
        .agg(F.collect_set("pos").alias("gone"))
        .select(F.col("doc").alias("gone_doc"), F.col("body").alias("gone_body"), "gone")
    )
    text = body(text_col)
    rows = docs.select(row_struct(docs), F.col(id_col).alias("doc"), digest(text).alias("body"))
    joined = rows.join(
        dropped, F.col("doc").eqNullSafe(F.col("gone_doc")) & (F.col("body") == F.col("gone_body")), "left"
    )
    # Lines are a lambda's argument: they are cut once for a text and not again for each line that stays.
    lines = _lines(body(F.col("_row")[text_col]))
    stays = lambda x: F.array_except(F.sequence(F.lit(0), F.size(x["lines"]) - 1), x["gone"])
    kept = lambda x: F.array_join(F.transform(stays(x), lambda i: F.get(x["lines"], i)), "\n")
    joined_lines = F.get(F.transform(F.array(F.struct(lines.alias("lines"), F.col("gone").alias("gone"))), kept), F.lit(0))
    thinned = F.when(F.col("gone").isNull(), F.col("_row")[text_col]).otherwise(joined_lines)
    return with_outputs(
        joined,
        "_row",
        **{
            text_col: thinned,
            "n_lines": F.size(lines).cast("long"),
            "n_dropped": F.coalesce(F.size("gone"), F.lit(0)).cast("long"),
        },
    )
