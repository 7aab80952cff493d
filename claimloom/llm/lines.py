"""Repeated lines, as DataFrame operations only.

Line hashes are range-partitioned together with their document, so one line that
occurs almost everywhere is spread over many tasks, and each partition streams its
sorted occurrences to one row per line and document. What travels back to the documents is not
text but a compressed bitmap per document: the words of 64 lines in which lines go.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.storage import as_table

SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

BITMAP = "array<struct<word:int,bits:bigint>>"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased."""
    bare = F.btrim(line, F.lit(SPACES))
    # lower() changes only A-Z in a text of single-byte characters, and is faster.
    plain = F.octet_length(bare) == F.length(bare)
    return F.when(plain, F.lower(bare)).otherwise(F.translate(bare, UPPER, UPPER.lower()))


def _version(text_col: str) -> Column:
    """Hash of a row's text, which tells rows with equal ids apart."""
    return F.xxhash64(_text(text_col))


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def drop_bitmaps(
    docs: DataFrame, min_chars: int = 20, min_docs: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``version`` (hash of the text) and ``dropped``, for documents that lose lines.

    ``dropped`` holds, for each run of 64 lines in which lines go, its number and
    a 64-bit mask; runs that stay whole are left out. See :func:`without_repeats`.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), _version(text_col).alias("version"), _text(text_col).alias("text")
    )
    lines = rows.filter("doc_id IS NOT NULL").select(
        "doc_id", "version", F.posexplode(F.split("text", "\n")).alias("pos", "line")
    )
    keyed = lines.select("doc_id", "version", "pos", line_key(F.col("line")).alias("key")).filter(
        F.length("key") >= min_chars
    )
    hashed = keyed.select(
        F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit(1), "key").alias("h2"),
        "doc_id",
        "version",
        "pos",
    )
    found = as_table(hashed, "lines")
    # Partitioned by line and document: the largest document is the last of a line.
    per_doc = (
        found.repartitionByRange("h1", "h2", "doc_id")
        .sortWithinPartitions("h1", "h2", "doc_id", "pos")
        .groupBy("h1", "h2", "doc_id")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    spread = per_doc.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("keeper"))
    # Stored, so that both sides of the join are plain exchanges and a line that is almost
    # everywhere is split among tasks.
    repeated = as_table(spread.filter(F.col("docs") >= min_docs).select("h1", "h2", "keeper"), "repeated-lines")
    gone = found.join(repeated, ["h1", "h2"]).filter("doc_id != keeper")
    words = (
        gone.select("doc_id", "version", F.shiftright("pos", 6).alias("word"), F.expr("shiftleft(1L, pos & 63)").alias("bit"))
        .groupBy("doc_id", "version", "word")
        .agg(F.bit_or("bit").alias("bits"))
    )
    return words.groupBy("doc_id", "version").agg(
        F.collect_list(F.struct("word", "bits")).cast(BITMAP).alias("dropped")
    )


# Names of working columns, kept apart from any column a table may have.
_DROPPED, _LINES, _BY_WORD, _MASKS = "__dropped", "__lines", "__by_word", "__masks"


def without_repeats(
    docs: DataFrame, min_chars: int = 20, min_docs: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` without the lines that many documents hold.

    A line's key is the line without white space at its ends, with A-Z lower-cased. Keys of at
    least ``min_chars`` code points found in at least ``min_docs`` documents lose all
    lines but those of the largest id that holds them. Returns all columns of ``docs``, the
    text being the lines that stay, and ``__n_lines`` (before dropping) and ``__n_dropped`` (long).

    A null text is empty; an empty text has one empty line. Rows with equal ids are one
    document that holds the lines of all of them; a row with a null id loses nothing
    and does not count. Columns other than id and text only pass through, whatever their
    names. An empty table gives an empty result.
    """
    gone = drop_bitmaps(docs, min_chars, min_docs, id_col, text_col).select(
        F.col("doc_id").alias("__id"), F.col("version").alias("__version"), F.col("dropped").alias(_DROPPED)
    )
    same = (F.col(id_col).cast("long") == F.col("__id")) & (_version(text_col) == F.col("__version"))
    marked = docs.join(gone, same, "left").withColumn(_LINES, F.split(_text(text_col), "\n"))
    # The mask of each run of 64 lines, in order; 0 where all stay.
    nothing = F.lit(0).cast("long")
    marked = marked.withColumn(_BY_WORD, F.map_from_entries(_DROPPED))
    runs = F.sequence(F.lit(0), F.shiftright(F.size(_LINES) - 1, 6))
    marked = marked.withColumn(_MASKS, F.transform(runs, lambda w: F.coalesce(F.try_element_at(_BY_WORD, w), nothing)))
    stays = F.expr(
        f"filter({_LINES}, (line, i) -> (shiftright({_MASKS}[shiftright(i, 6)], i & 63) & 1) = 0)"
    )
    dropped = F.aggregate(_DROPPED, nothing, lambda n, w: n + F.bit_count(w["bits"]))
    return marked.select(
        *[c for c in docs.columns if c != text_col],
        F.when(F.col(_DROPPED).isNull(), _text(text_col)).otherwise(F.array_join(stays, "\n")).alias(text_col),
        F.size(_LINES).cast("long").alias("__n_lines"),
        F.coalesce(dropped, nothing).alias("__n_dropped"),
    )
