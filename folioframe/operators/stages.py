"""Steps between the stages of a run, as DataFrame operators: pictures of pages, fallbacks, prompts, totals and statistics of a run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioframe.functions.text import shortened
from folioframe.operators.files import name_language
from folioframe.operators.layout import CLASSES

# The codes that tell a recogniser the language of a page.
LANGUAGE_HINTS = {
    "hindi": "hi", "bengali": "bn", "gujarati": "gu", "odia": "or", "assamese": "as", "punjabi": "pa", "marathi": "mr", "urdu": "ur",
    "tamil": "ta", "telugu": "te", "malayalam": "ml", "kannada": "kn",
}


def language_hint(language: Column) -> Column:
    """ARRAY<STRING>: the hints for a language, null for an unknown one."""
    codes = F.create_map(*[F.lit(x) for kv in LANGUAGE_HINTS.items() for x in kv])
    code = F.try_element_at(codes, language)
    return F.when(code.isNotNull(), F.array(code))


def without_markup(text: Column) -> Column:
    """``text`` without tags in square brackets such as ``[bold]`` or ``[/bold]``."""
    return F.regexp_replace(text, r"\[/?\w+\]", "")


def clipped(box: Column, width: Column, height: Column) -> Column:
    """``box`` with every coordinate inside a page of ``width`` and ``height``."""
    side = lambda k, most: F.greatest(F.lit(0), F.least(F.get(box, F.lit(k)), most))
    return F.array(side(0, width), side(1, height), side(2, width), side(3, height))


def picture_boxes(infos: DataFrame, dpi: int = 150, side: float = 40.0, share: float = 0.5) -> DataFrame:
    """(page_id, box) of the pictures embedded in pages: ``infos`` (page_id, page_w, page_h, bbox in points) scaled to ``dpi``.

    Pictures below ``side`` in width or height, or above ``share`` of their page, are left out, and so are those without four coordinates.
    Coordinates are rounded half to even.
    """
    zoom = F.lit(dpi / 72)
    scaled = F.transform("bbox", lambda v: v.cast("double") * zoom)
    rows = infos.where("size(bbox) = 4 and forall(bbox, v -> v is not null)").select("page_id", scaled.alias("b"), (F.col("page_w") * zoom * (F.col("page_h") * zoom)).alias("page"))
    at = lambda k: F.get("b", F.lit(k))
    w, h = at(2) - at(0), at(3) - at(1)
    return rows.where((w >= side) & (h >= side) & (w * h <= F.lit(share) * F.col("page"))).select("page_id", F.transform("b", lambda v: F.bround(v).cast("int")).alias("box"))


def first_found(pages: DataFrame, embedded: DataFrame, regions: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, source, box): the ``embedded`` pictures of every page, or its detected ``regions`` where it has none; null where it has neither."""
    have = embedded.select(key).distinct()
    own = embedded.select(key, F.lit("embedded").alias("source"), "box")
    other = regions.join(have, key, "left_anti").select(key, F.lit("region").alias("source"), "box")
    return pages.select(key).distinct().join(own.unionByName(other), key, "left")


def fallback_pages(pages: DataFrame, recognised: DataFrame) -> DataFrame:
    """(id, page_pos, boxes, classes, texts): level-2 pages of the replies that failed (an ``error`` in ``pages``): all recognised blocks, as text."""
    failed = pages.where("error is not null").select("id").distinct()
    return recognised.join(failed, "id", "left_semi").select("id", "page_pos", "boxes", F.transform("texts", lambda t: F.lit("Text")).alias("classes"), "texts")


def prompts(recognised: DataFrame, by: str, order: str, limit: int = 100) -> DataFrame:
    """(``by``, n_pages, prompt): the request for each batch of pages, for models that see no images.

    ``recognised`` has ``by``, ``order``, boxes and texts, one row per page; batches are small. Long texts are shortened to ``limit``.
    """
    blocks = F.zip_with("boxes", "texts", lambda b, t: F.struct(b.alias("box"), shortened(t, limit).alias("text")))
    pages = recognised.select(by, F.struct(F.col(order).alias("at"), blocks.alias("raw_blocks")).alias("p")).groupBy(by).agg(F.array_sort(F.collect_list("p"), lambda a, b: (a["at"] - b["at"]).cast("int")).alias("ps"))
    shown = F.to_json(F.transform("ps", lambda p, i: F.struct(i.alias("page_index"), p["raw_blocks"].alias("raw_blocks"))))
    text = F.concat(F.lit(PROMPT_HEAD), F.size("ps").cast("string"), F.lit(PROMPT_RULES), shown, F.lit(PROMPT_SHAPE))
    return pages.select(by, F.size("ps").alias("n_pages"), text.alias("prompt"))


PROMPT_HEAD = "Label the layout blocks of scanned pages. Number of pages: "
PROMPT_RULES = ".\nGive each block one label out of: " + ", ".join(CLASSES) + ".\nKeep every block; give page_order as block positions in the order of reading.\nBlocks:\n"
PROMPT_SHAPE = '\nAnswer with one JSON object: {"pages": [{"page_order": [], "block_classes": []}]}'


def zipped_rows(left: DataFrame, right: DataFrame, keys: list[str], pos: str = "pos") -> DataFrame:
    """Rows of both sides at the same position of a group; the shorter side decides. ``pos`` must be unique in its group."""
    return left.join(right, [*keys, pos])


def with_total(rollup: DataFrame, name: str, total: str = "total") -> DataFrame:
    """``rollup`` with one more row that sums its numbers, named ``total`` in column ``name``."""
    numbers = [f.name for f in rollup.schema if f.name != name]
    sums = rollup.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast(rollup.schema[c].dataType).alias(c) for c in numbers])
    return rollup.select(name, *numbers).unionByName(sums.withColumn(name, F.lit(total)))


def active(rollup: DataFrame, numbers: list[str]) -> DataFrame:
    """The rows in which one of ``numbers`` is above zero."""
    return rollup.where(reduce(lambda a, b: a | b, [F.coalesce(F.col(c), F.lit(0)) > 0 for c in numbers]))


def estimated_pages(files: DataFrame, most: int) -> DataFrame:
    """(n_pages): the pages a run will read, at most ``most`` of a file (0 for all); files of unknown size count as ``most``. Repeated files count once."""
    once = files.groupBy("file").agg(F.max("pages").alias("pages"))
    pages = F.least(F.coalesce("pages", F.lit(most)), F.lit(most)) if most > 0 else F.coalesce("pages", F.lit(0))
    return once.agg(F.coalesce(F.sum(pages), F.lit(0)).cast("bigint").alias("n_pages"))


def language_menu(groups: DataFrame) -> DataFrame:
    """(place, language, n_files): languages by falling number of files, ties by their first file; one row per language."""
    place = F.row_number().over(Window.orderBy(F.desc("n_files"), "first_file"))
    return groups.select(place.alias("place"), "language", "n_files")


def accepted(files: DataFrame, name: str = "file", level: int = 4, provider: str = "gemini", providers: tuple[str, ...] = ()) -> DataFrame:
    """The files of a request that are PDFs by their name, whatever its case; none where level or provider is unknown."""
    fits = level in (3, 4) and (not providers or provider in providers)
    return files.where(F.lower(name).like("%.pdf") & F.lit(fits))


def language_stats(pages: DataFrame, verdicts: DataFrame, log: DataFrame) -> DataFrame:
    """(language, files, pages, passed, failed, pass_rate, mean_latency): a run per language of the files' names.

    A page passes where one of its annotations (``verdicts``: page_id, valid) is valid; all others fail. The latency of the log (file,
    request_id, latency_ms) is spread over the language's pages. Each page and request counts once.
    """
    once = pages.select("page_id", "file").distinct()
    good = verdicts.where("valid").select("page_id", F.lit(1).alias("good")).distinct()
    per = (
        once.join(good, "page_id", "left")
        .groupBy(name_language(F.col("file")).alias("language"))
        .agg(F.countDistinct("file").alias("files"), F.count(F.lit(1)).alias("pages"), F.count("good").alias("passed"))
    )
    spent = log.dropDuplicates(["request_id"]).groupBy(name_language(F.col("file")).alias("language")).agg(F.sum("latency_ms").alias("spent"))
    return per.join(spent, "language", "left").select(
        "language", "files", "pages", "passed", (F.col("pages") - F.col("passed")).alias("failed"),
        F.round(F.col("passed") / F.col("pages") * 100, 4).alias("pass_rate"), F.round(F.coalesce("spent", F.lit(0.0)) / F.col("pages"), 4).alias("mean_latency"),
    )


def run_totals(stats: DataFrame) -> DataFrame:
    """One row: the sums of ``language_stats``, with the pass rate over all pages (0 for an empty run)."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    rate = F.coalesce(F.round(F.try_divide(F.sum("passed"), F.sum("pages")) * 100, 4), F.lit(0.0))
    return stats.agg(total("files").alias("files"), total("pages").alias("pages"), total("passed").alias("passed"), total("failed").alias("failed"), rate.alias("pass_rate"))


def stage_states(events: DataFrame, steps: int) -> DataFrame:
    """(file_name, step, state): of every log (file_name, line_no, step) the state of each of ``steps`` steps after its last line: done, active or pending."""
    last = events.groupBy("file_name").agg(F.max_by("step", "line_no").alias("now"))
    each = last.select("file_name", "now", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step"))
    state = F.when(F.col("step") < F.col("now"), "done").when(F.col("step") == F.col("now"), "active").otherwise("pending")
    return each.select("file_name", "step", state.alias("state"))
