"""Line dedup: repeated lines leave all documents but one, told by compressed keep bitmaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from teletide.session import materialize

_WHITE = " \t\n\x0b\f\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Cells that the holders of one line are spread over, so that no task gets all of a frequent line.
SALTS = 64
_RUNS = "array<struct<start:int,end:int>>"


def _text() -> Column:
    return F.coalesce("text", F.lit(""))


def lines_of(docs: DataFrame, min_chars: int) -> DataFrame:
    """Hash (128 bits in two columns), document and position of each line that may be dropped."""
    keys = F.transform(F.split(F.translate(_text(), _UPPER, _UPPER.lower()), "\n"),
                       lambda line, i: F.struct(F.btrim(line, F.lit(_WHITE)).alias("key"), i.alias("pos")))
    long = F.transform(F.filter(keys, lambda k: F.char_length(k["key"]) >= min_chars), lambda k: F.struct(
        F.xxhash64(k["key"]).alias("h1"), F.xxhash64(k["key"], F.lit(1)).alias("h2"), k["pos"].alias("pos")))
    return (docs.where("doc_id is not null")
            .select("doc_id", F.xxhash64(_text()).alias("row"), F.explode(long).alias("line"))
            .select("line.h1", "line.h2", "doc_id", "row", "line.pos"))


def repeated_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """The hashes held by at least ``min_docs`` documents, with the largest doc_id holding each.

    Hashes are range-partitioned and sorted by document (largest first) and position; a pass over each run
    passes on only the first occurrence in a document. The range also covers a salt of the document, so the
    holders of one line spread over cells, whose counts and largest ids are then merged.
    """
    # The plan knows that ranges of (h1, h2, salt) keep a cell together, so the window adds no exchange.
    cells = lines.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).repartitionByRange("h1", "h2", "salt")
    run = Window.partitionBy("h1", "h2", "salt").orderBy(F.desc("doc_id"), "pos")
    first = (cells.select("h1", "h2", "salt", "doc_id", "pos", F.lag("doc_id").over(run).alias("above"))
             .where("above is null or above <> doc_id"))
    return (first.groupBy("h1", "h2").agg(F.count("*").alias("docs"), F.max("doc_id").alias("keeper"))
            .where(F.col("docs") >= min_docs).select("h1", "h2", "keeper"))


def _kept_runs(dropped: Column, n: Column) -> Column:
    """The runs [start, end) of kept lines, given the sorted positions of the dropped ones."""
    first = F.filter(dropped, lambda x, i: (i == 0) | (F.get(dropped, i - 1) != x - 1))
    last = F.filter(dropped, lambda x, i: (i == F.size(dropped) - 1) | (F.get(dropped, i + 1) != x + 1))
    runs = F.zip_with(F.concat(F.array(F.lit(0)), F.transform(last, lambda x: x + 1)), F.concat(first, F.array(n)),
                      lambda a, b: F.struct(a.alias("start"), b.alias("end")))
    return F.filter(runs, lambda r: r["start"] < r["end"]).cast(_RUNS)


def _marked(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """``docs`` as struct ``row_`` with ``dropped_``, the sorted positions of its dropped lines or null."""
    # Written once: the hashes are read by the range sample, the runs and the join.
    lines = materialize(lines_of(docs, min_chars), "lines")
    gone = (lines.join(repeated_lines(lines, min_docs), ["h1", "h2"]).where("doc_id <> keeper")
            .groupBy("doc_id", "row").agg(F.sort_array(F.collect_set("pos")).alias("dropped_")))
    gone = gone.select(F.col("doc_id").alias("id_"), F.col("row").alias("text_"), "dropped_")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row_"))
    return (whole.join(gone, (F.col("row_.doc_id") == F.col("id_"))
                       & (F.xxhash64(F.coalesce("row_.text", F.lit(""))) == F.col("text_")), "left")
            .select("row_", "dropped_"))


def _bitmap() -> list[Column]:
    lines = F.split(F.coalesce("row_.text", F.lit("")), "\n")
    dropped = F.coalesce("dropped_", F.array().cast("array<int>"))
    return [lines.alias("lines_"), _kept_runs(dropped, F.size(lines)).alias("keep"), F.size(dropped).alias("gone_")]


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Which lines of each document stay.

    Texts are split at newlines; a line's key is the line without ASCII white space at its ends and with
    A-Z lower-cased. A key of at least ``min_chars`` code points in at least ``min_docs`` documents stays in
    the document of the largest doc_id that holds it, at every place there, and is dropped elsewhere.
    Returns doc_id, n_lines, n_dropped and ``keep``, the bitmap of kept lines as its runs of ones
    [start, end). A null or empty text is one empty line. Rows of one doc_id count as one document; a row
    without a doc_id counts for no line and keeps all of its own. An empty table gives no rows; other
    columns are not read.
    """
    return (_marked(docs.select("doc_id", "text"), min_chars, min_docs).select("row_.doc_id", *_bitmap())
            .select("doc_id", F.size("lines_").cast("bigint").alias("n_lines"),
                    F.col("gone_").cast("bigint").alias("n_dropped"), "keep"))


def kept_text(lines: Column, keep: Column) -> Column:
    """The lines of the runs, joined by newlines."""
    return F.array_join(F.flatten(F.transform(keep, lambda r: F.slice(lines, r["start"] + 1, r["end"] - r["start"]))), "\n")


def kept_texts(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """All columns of ``docs`` as struct ``row``, with n_lines, n_dropped, ``keep`` and the text it keeps.

    See :func:`keep_bitmaps` for what is kept.
    """
    return (_marked(docs, min_chars, min_docs).select("row_", *_bitmap())
            .select(F.col("row_").alias("row"), F.size("lines_").cast("bigint").alias("n_lines"),
                    F.col("gone_").cast("bigint").alias("n_dropped"), "keep",
                    kept_text(F.col("lines_"), F.col("keep")).alias("kept")))
