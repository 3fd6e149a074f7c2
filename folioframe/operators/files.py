"""Source files and their pages: languages by name, batches, pending pages and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioframe.operators.ranking import positions

# Words of a file name and the language they tell, in the order in which they are tried.
NAME_WORDS = (
    ("odia", "odia|oriya|bhougalika|sagyan|prakarana"),
    ("marathi", "marathi|baldarshan"),
    ("telugu", "telugu|adikaara|basha"),
    ("tamil", "tamil|tnla"),
    ("hindi", "hindi"),
    ("bengali", "bengali|bangla"),
    ("gujarati", "gujarati"),
    ("assamese", "assamese|asamiya"),
    ("punjabi", "punjabi|gurmukhi"),
    ("urdu", "urdu"),
    ("malayalam", "malayalam"),
    ("kannada", "kannada"),
)


def name_language(file: Column) -> Column:
    """The language a file's name tells, or unknown. Null names are unknown."""
    lower = F.lower(file)
    out = F.lit("unknown")
    for language, words in reversed(NAME_WORDS):
        out = F.when(lower.rlike(words), language).otherwise(out)
    return out


def language_groups(files: DataFrame) -> DataFrame:
    """(language, n_files, n_pages, first_file) of files with a known language; repeated rows of a file count once, unknown pages as 0."""
    once = files.groupBy("file").agg(F.max("pages").alias("pages"))
    return (
        once.select(name_language(F.col("file")).alias("language"), "file", "pages")
        .where("language <> 'unknown'")
        .groupBy("language")
        .agg(
            F.count(F.lit(1)).cast("bigint").alias("n_files"),
            F.coalesce(F.sum("pages"), F.lit(0)).cast("bigint").alias("n_pages"),
            F.min("file").alias("first_file"),
        )
    )


def pending(pages: DataFrame, annotations: DataFrame) -> DataFrame:
    """(page_id, file, page_no): pages with text that have no annotation yet; each once. Pages with null keys are pending."""
    some = pages.where(F.col("full_text").isNotNull() & F.col("full_text").rlike(r"\S")).select("page_id", "file", "page_no").distinct()
    return some.join(annotations.select("page_id").distinct(), "page_id", "left_anti")


def first_pages(pages: DataFrame, n: int) -> DataFrame:
    """(page_id, file, page_no) of the first ``n`` pages of every file; 0 keeps all."""
    rows = pages.select("page_id", "file", "page_no").distinct()
    return rows.where(F.col("page_no") <= n) if n > 0 else rows


def batches(pages: DataFrame, size: int) -> DataFrame:
    """(page_id, file, page_no, batch_no): pages of every file in consecutive batches of ``size``, the last one shorter."""
    rows = positions(pages.select("page_id", "file", "page_no").distinct(), ["file"], ["page_no", "page_id"])
    return rows.select("page_id", "file", "page_no", F.floor(F.col("position") / size).cast("bigint").alias("batch_no"))


def merged_blocks(blocks: DataFrame) -> DataFrame:
    """(page_id, pos, block_id, is_picture): the blocks of a page in their order, texts first and pictures after them."""
    rows = blocks.select("page_id", "block_id", "idx", F.coalesce("is_picture", F.lit(False)).alias("is_picture")).distinct()
    place = F.row_number().over(Window.partitionBy("page_id").orderBy("is_picture", "idx", "block_id")) - 1
    return rows.select("page_id", place.alias("pos"), "block_id", "is_picture")


def embedded_pictures(blocks: DataFrame, side: int = 40, share: float = 0.5) -> DataFrame:
    """(page_id, block_id, width, height): pictures at least ``side`` wide and high that cover at most ``share`` of their page.

    The page is the box around all its blocks. Boxes without four values are left out.
    """
    at = lambda k: F.get("box", F.lit(k))
    rows = blocks.where("size(box) = 4").select(
        "page_id", "block_id", "is_picture", (at(2) - at(0)).alias("width"), (at(3) - at(1)).alias("height"), at(2).alias("x2"), at(3).alias("y2")
    )
    extent = rows.groupBy("page_id").agg(F.max("x2").alias("w"), F.max("y2").alias("h"))
    found = rows.where("is_picture").select("page_id", "block_id", "width", "height").distinct().join(extent, "page_id")
    big = (F.col("width") >= side) & (F.col("height") >= side)
    return found.where(big & (F.col("width").cast("double") * F.col("height") <= F.lit(share) * F.col("w") * F.col("h"))).select(
        "page_id", "block_id", "width", "height"
    )


def run_summary(pages: DataFrame, annotations: DataFrame) -> DataFrame:
    """(language, pages, annotated, share): by the language of the file's name, how many pages are annotated."""
    once = pages.select("page_id", "file").distinct()
    done = annotations.select("page_id", F.lit(1).alias("done")).distinct()
    return (
        once.join(done, "page_id", "left")
        .groupBy(name_language(F.col("file")).alias("language"))
        .agg(F.count(F.lit(1)).cast("bigint").alias("pages"), F.count("done").cast("bigint").alias("annotated"))
        .withColumn("share", F.round(F.col("annotated") / F.col("pages"), 6))
    )
