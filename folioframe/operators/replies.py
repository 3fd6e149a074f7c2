"""Replies of labelling models: from raw text to JSON, and from JSON to pages whose parts fit together."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioframe.functions.jsontext import is_json
from folioframe.functions.text import is_blank, strip
from folioframe.operators.layout import CLASSES, geometry_order, whole, zipped

# The text that marks a picture, a label of old replies with the label used for it, the marks around spoken thoughts.
PICTURE_MARK = "[NO_TEXT_IN_PICTURE]"
OLD_LABELS = {"Page-number": "Page-header"}
THOUGHT = re.compile("\U0001f4ad.*?✨", re.S)
#: A picture with text that is smaller than this, in square pixels, is text.
SMALL_PICTURE = 1000
#: Providers that see the page; replies of others are of lower quality.
VISION = ("gemini", "glm", "iamhc")

_FENCE = re.compile(r"```(?:json)?(.*?)(?:```|\Z)", re.S)
_TOKEN = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*"|[{}]')
PAGE = (
    "struct<block_boxes:array<array<int>>,block_classes:array<string>,block_text:array<string>,page_order:array<int>,reading_order:array<int>,"
    "block_relations:array<struct<source:int,target:int,relation:string>>>"
)


def repaired(text: Column) -> Column:
    """``text`` without commas before closing brackets and, where that does not make it JSON, with commas between neighbouring strings;
    unchanged where neither helps."""
    trimmed = F.regexp_replace(text, r",\n?([\]}])", "$1")
    joined = F.regexp_replace(trimmed, r'"\s+"', '", "')
    return F.when(is_json(text), text).when(is_json(trimmed), trimmed).when(is_json(joined), joined).otherwise(text)


def _balanced(text: str, start: int) -> int:
    """The place after the bracket that closes the one at ``start``, or −1."""
    depth = 0
    for token in _TOKEN.finditer(text, start):
        if token.group() == "{":
            depth += 1
        elif token.group() == "}":
            depth -= 1
            if not depth:
                return token.end()
    return -1


def _body(reply: str) -> str:
    """The part of a reply that should hold the JSON object: thoughts removed, text before a fence or inside it."""
    text = THOUGHT.sub("", reply).strip()
    while "```" in text:
        before = text.split("```", 1)[0]
        if "{" in before:
            return before
        inside = _FENCE.search(text)
        if not inside or "{" not in inside.group(1):
            break
        text = inside.group(1)
    return text


def object_in(reply: str | None) -> tuple[str | None, str | None]:
    """(JSON text, error) of the first object in a reply; the text is repaired where that makes it JSON."""
    if reply is None:
        return None, "null reply"
    text = _body(reply)
    start = text.find("{")
    if start < 0:
        return None, "no object"
    end = _balanced(text, start)
    if end < 0:
        return None, "unmatched brace"
    found = text[start:end]
    trimmed = re.sub(r",\n?([\]}])", r"\1", found)
    for attempt in (found, trimmed, re.sub(r'"\s+"', '", "', trimmed)):
        try:
            json.loads(attempt)
            return attempt, None
        except ValueError:
            continue
    return None, "not JSON"


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = [object_in(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.string())], ["id", "json", "error"]
        )


def _extract_about(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, json, error, provider) from (id, text, provider)."""
    for batch in batches:
        found = next(_extract(iter([batch.select([0, 1])])))
        yield pa.RecordBatch.from_arrays([*found.columns, batch.column(2)], ["id", "json", "error", "provider"])


def extracted(replies: DataFrame, key: str = "result_id", text: str = "raw_text") -> DataFrame:
    """(id, json, error): the JSON object of every reply, or why there is none."""
    return replies.select(F.col(key).cast("bigint").alias("id"), text).mapInArrow(_extract, "id bigint, json string, error string")


def _fitted(items: Column, n: Column, filler: str) -> Column:
    """``items`` cut or filled to ``n``."""
    held = F.coalesce(items, F.array().cast("array<string>"))
    return F.slice(F.concat(held, F.array_repeat(F.lit(filler), n)), F.lit(1), n)


def _places(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))).otherwise(F.array().cast("array<int>"))


def _is_permutation(order: Column, n: Column) -> Column:
    """Whether ``order`` holds each of 0 to n − 1 once; false for null."""
    inside = F.size(F.filter(order, lambda x: (x >= 0) & (x < n))) == n
    return F.coalesce(inside & (F.size(order) == n) & (F.size(F.array_distinct(order)) == n), F.lit(False))


def order_of(order: Column, n: Column, fallback: Column | None = None) -> tuple[Column, Column]:
    """(order, source) of ``n`` blocks.

    A longer order is cut; one that starts at 1 or later and reaches ``n`` is counted from 1 and shifted. What is then no permutation
    gives way to ``fallback`` where that is one, else to the order as delivered; the source is ``given``, ``geometry`` or ``default``.
    """
    cut = F.slice(order, F.lit(1), F.greatest(n, F.lit(0)))
    shifted = F.when((F.get(cut, F.lit(0)) >= 1) & (F.array_max(cut) >= n), F.transform(cut, lambda x: x - 1)).otherwise(cut)
    good = _is_permutation(shifted, n)
    out, source = F.when(good, shifted), F.when(good, "given")
    if fallback is not None:
        # A reply that gives no order at all keeps the order as delivered.
        fits = order.isNotNull() & _is_permutation(fallback, n)
        out, source = out.when(fits, fallback), source.when(fits, "geometry")
    return out.otherwise(_places(n)), source.otherwise("default")


def label(cls: Column, text: Column, area: Column | None = None, was_picture: Column | None = None) -> Column:
    """The label of a block after the fixed rules: old labels renamed, marked pictures, and small pictures with text made text."""
    now = cls
    for old, new in OLD_LABELS.items():
        now = F.when(now == old, new).otherwise(now)
    marked = F.coalesce(text == PICTURE_MARK, F.lit(False))
    now = F.when(marked, "Picture").otherwise(now)
    if area is None or was_picture is None:
        return now
    small = (now == "Picture") & ~is_blank(text) & ~marked & ~F.coalesce(was_picture, F.lit(False)) & (area < SMALL_PICTURE)
    return F.when(small, "Text").otherwise(now)


RELATIONS = "array<struct<source:int,target:int,relation:string>>"
ORIGINALS = "boxes array<array<int>>, texts array<string>, pictures array<boolean>"


def quality(provider: Column) -> Column:
    """How far a reply can be trusted: by whether its provider saw the page."""
    return F.when(provider.isin(*VISION), "full_level4").otherwise("degraded_text_only_fallback")


def provider_text(response: Column, provider: Column) -> Column:
    """The text of a provider's response, by the path of its family; null where there is none."""
    candidates = F.get_json_object(response, "$.candidates[0].content.parts[0].text")
    return F.when(provider == "gemini", candidates).otherwise(F.get_json_object(response, "$.choices[0].message.content"))


def originals(blocks: DataFrame) -> DataFrame:
    """(id, page_pos, boxes, texts, pictures): recognised blocks per page, a page counting as a reply of one page.

    Of blocks at the same place the one with the lowest id counts; null texts are empty, null boxes are of no size.
    """
    one = blocks.groupBy("page_id", "idx").agg(F.min_by(F.struct("box", "text", "is_picture"), "block_id").alias("b"))
    box = F.coalesce("b.box", F.array(*[F.lit(0)] * 4))
    row = F.struct("idx", box.alias("box"), F.coalesce("b.text", F.lit("")).alias("text"), F.coalesce("b.is_picture", F.lit(False)).alias("is_picture"))
    rows = one.select("page_id", row.alias("r")).groupBy("page_id").agg(F.array_sort(F.collect_list("r")).alias("rs"))
    return rows.select(F.col("page_id").cast("bigint").alias("id"), F.lit(0).alias("page_pos"), *[F.col(f"rs.{c}").alias(n) for c, n in (("box", "boxes"), ("text", "texts"), ("is_picture", "pictures"))])


def _apart(rows: DataFrame) -> DataFrame:
    """``rows`` as they are, their columns computed here: expressions that follow find values and don't repeat the computation per element."""
    return rows.select(F.inline(F.array(F.struct(*rows.columns))))


def pages(
    replies: DataFrame, recognised: DataFrame | None = None, expected: int | None = None, level: int = 4, key: str = "result_id", text: str = "raw_text", provider: str = "provider"
) -> DataFrame:
    """(id, page_pos, error, n_blocks, boxes, classes, texts, order, order_source, relations, quality): one row per page of a usable reply, and one row with
    an ``error`` and nothing else for every other: why there is no object, ``page count`` or ``unknown label``.

    A reply must have ``expected`` pages if that is given; an object without ``pages`` that has labels is one page. ``recognised`` are the blocks the
    reply is about (id, page_pos, ``ORIGINALS``). Labels decide the number of blocks, and are fitted to the recognised ones where there are any.
    A blank text gives way to the recognised one. The reply's boxes count if there is one per block and it has texts, else the recognised ones
    or boxes of no size. A bad order gives way to the geometric one of the recognised boxes. Blocks are gathered in the page's order, then
    the fixed rules for labels hold. Below ``level`` 4 order and relations are null. Of a key that repeats, each row gives its pages.
    """
    about = replies.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text"), F.col(provider).alias("provider"))
    read = about.mapInArrow(_extract_about, "id bigint, json string, error string, provider string")
    many, single = F.from_json("json", f"struct<pages:array<{PAGE}>>")["pages"], F.from_json("json", PAGE)
    has_pages = F.array_contains(F.json_object_keys("json"), "pages")
    listed = F.when(has_pages, many).when(single["block_classes"].isNotNull() & F.lit(expected in (None, 1)), F.array(single))
    rows = read.withColumn("ps", F.coalesce(listed, F.array().cast(f"array<{PAGE}>")))
    count = (F.size("ps") == F.lit(expected)) if expected is not None else F.size("ps") > 0
    rows = rows.withColumn("error", F.when(F.col("json").isNull(), F.col("error")).when(~count, "page count")).withColumn("row", F.monotonically_increasing_id())
    listed = F.when(F.col("error").isNull(), F.col("ps"))
    rows = rows.select("id", "row", "provider", "error", F.posexplode_outer(listed).alias("page_pos", "p"))
    if recognised is not None:
        own = recognised.select("id", "page_pos", F.col("boxes").alias("ob"), F.col("texts").alias("ot"), F.col("pictures").alias("op"))
        own = _apart(own.withColumn("og", geometry_order(whole(zipped("ob", "ot", "ot")))))
        rows = rows.join(own, ["id", "page_pos"], "left")
    else:
        kinds = (("ob", "array<array<int>>"), ("ot", "array<string>"), ("op", "array<boolean>"), ("og", "array<int>"))
        rows = rows.withColumns({c: F.lit(None).cast(k) for c, k in kinds})
    known = F.coalesce(F.size("ot"), F.lit(0))
    rows = rows.withColumn("n_blocks", F.when(known > 0, known).otherwise(F.coalesce(F.size("p.block_classes"), F.lit(0))))
    n = F.col("n_blocks")
    texts = F.transform(_places(n), lambda i: F.when(~is_blank(F.get("p.block_text", i)), F.get("p.block_text", i)).otherwise(F.coalesce(F.get("ot", i), F.lit(""))))
    own = F.col("p.block_text").isNotNull() & (F.size("p.block_boxes") == n)
    given = F.when(F.size("p.page_order") > 0, F.col("p.page_order")).otherwise(F.col("p.reading_order"))
    order, source = order_of(given, n, F.col("og"))
    rows = rows.select(
        "id", "row", "page_pos", "provider", "error", "n_blocks", "op", order.alias("order"), source.alias("order_source"),
        _fitted(F.col("p.block_classes"), n, "Text").alias("cs"), texts.alias("ts"),
        F.when(own, F.col("p.block_boxes")).when(known > 0, F.col("ob")).otherwise(F.array_repeat(F.array(*[F.lit(0)] * 4), n)).alias("bs"),
        F.coalesce("p.block_relations", F.array().cast(RELATIONS)).alias("relations"),
    )
    rows = _apart(rows)
    side = lambda b, k: F.get(b, F.lit(k)).cast("double")
    area = lambda b: (side(b, 2) - side(b, 0)) * (side(b, 3) - side(b, 1))
    # Without recognised blocks no label is changed for its size.
    was = lambda i: F.when(F.col("op").isNull(), True).otherwise(F.coalesce(F.get("op", i), F.lit(False)))
    classes = F.transform("order", lambda i: label(F.get("cs", i), F.get("ts", i), area(F.get("bs", i)), was(i)))
    gathered = lambda c: F.transform("order", lambda i: F.get(F.col(c), i))
    rows = rows.select("id", "row", "page_pos", "provider", "error", "n_blocks", gathered("bs").alias("boxes"), classes.alias("classes"), gathered("ts").alias("texts"), "order", "order_source", "relations")
    bad = F.size(F.filter("classes", lambda c: ~F.coalesce(c.isin(*CLASSES), F.lit(False)))) > 0
    # All pages of a reply fall with one of its labels; a reply's pages are few, and only they share a window.
    rows = rows.withColumn("bad", F.max(bad).over(Window.partitionBy("row")))
    # Of a reply that falls with its labels one row stays.
    rows = rows.where("not bad or coalesce(page_pos, 0) = 0").withColumn("error", F.coalesce("error", F.when(F.col("bad"), "unknown label")))
    fine = F.col("error").isNull()
    kept = lambda c, full=True: F.when(fine & F.lit(full), F.col(c) if isinstance(c, str) else c)
    top = level >= 4
    return rows.select(
        "id", kept("page_pos").alias("page_pos"), "error", *[kept(c).alias(c) for c in ("n_blocks", "boxes", "classes", "texts")], kept("order", top).alias("order"),
        kept("order_source").alias("order_source"), kept("relations", top).alias("relations"), kept(quality(F.col("provider")), top).alias("quality"),
    )


def first_success(attempts: DataFrame, batch: str, rank: str, ok: Column, result: str) -> DataFrame:
    """(batch, rank, result): of every batch the successful attempt of the lowest rank; batches without one are left out."""
    return (
        attempts.where(ok)
        .groupBy(batch)
        .agg(F.min_by(F.struct(rank, result), F.struct(rank, result)).alias("best"))
        .select(batch, f"best.{rank}", f"best.{result}")
    )


def ocr_blocks(responses: DataFrame, key: str, payload: str) -> DataFrame:
    """(key, page, block, paragraph, x1, y1, x2, y2, text): the paragraphs of recognition responses with their boxes.

    Words are put together from symbols; the break after a word's last symbol becomes a space or a line break. Missing coordinates are
    0. Blank paragraphs, and responses without text or with an error, give no row.
    """
    symbol = "struct<text:string,property:struct<detectedBreak:struct<type:string>>>"
    paragraph = f"struct<boundingBox:struct<vertices:array<struct<x:int,y:int>>>,words:array<struct<symbols:array<{symbol}>>>>"
    schema = f"struct<responses:array<struct<error:string,fullTextAnnotation:struct<pages:array<struct<blocks:array<struct<paragraphs:array<{paragraph}>>>>>>>>>"
    first = F.get(F.from_json(payload, schema)["responses"], F.lit(0))
    rows = responses.select(key, first.alias("r")).where("r.error is null")
    rows = rows.select(key, F.posexplode("r.fullTextAnnotation.pages").alias("page", "a"))
    rows = rows.select(key, "page", F.posexplode("a.blocks").alias("block", "b"))
    rows = rows.select(key, "page", "block", F.posexplode("b.paragraphs").alias("paragraph", "p"))
    gap = lambda kind: F.when(kind.isin("SPACE", "EOL_SURE_SPACE"), " ").when(kind == "LINE_BREAK", "\n").otherwise("")
    word = lambda w: F.concat(
        F.array_join(F.transform(w["symbols"], lambda s: F.coalesce(s["text"], F.lit(""))), ""),
        gap(F.try_element_at(w["symbols"], F.lit(-1))["property"]["detectedBreak"]["type"]),
    )
    side = lambda axis, f: f(F.transform("p.boundingBox.vertices", lambda v: F.coalesce(v[axis], F.lit(0))))
    return rows.select(
        key, "page", "block", "paragraph",
        side("x", F.array_min).alias("x1"), side("y", F.array_min).alias("y1"), side("x", F.array_max).alias("x2"), side("y", F.array_max).alias("y2"),
        strip(F.array_join(F.transform("p.words", word), "")).alias("text"),
    ).where("text <> ''")
