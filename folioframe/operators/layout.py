"""Geometry of annotated pages: reading order, captions, footnotes, overlaps and overlay primitives.

A page is one row with parallel arrays. All operators here work inside the row with higher-order functions, so none of them shuffles
and each costs what its page costs. Blocks without four coordinates take no part in geometry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.functions.text import strip

# The labels, the relations, and the label a caption belongs to.
CLASSES = (
    "Text", "Title", "Section-header", "List-item", "TOC", "Bibliography", "Footnote", "Page-header", "Page-footer", "Picture",
    "Formula", "Table", "Caption",
)
RELATIONS = ("caption_of_table", "table_has_caption", "caption_of_figure", "figure_has_caption", "footnote_refers_to")
CAPTIONED = {"Table": ("table_has_caption", "caption_of_table"), "Picture": ("figure_has_caption", "caption_of_figure")}
COLORS = {
    "Text": "0,255,0", "Title": "255,0,0", "Section-header": "0,0,255", "List-item": "255,165,0", "TOC": "128,0,128",
    "Bibliography": "139,69,19", "Footnote": "0,128,128", "Page-header": "255,192,203", "Page-footer": "173,216,230",
    "Picture": "0,0,139", "Formula": "255,0,255", "Table": "0,255,255", "Caption": "128,128,0",
}
#: Gap between block centres that parts two columns, in pixels; distance within which a footnote belongs to a block; share of the
#: smaller box from which two boxes overlap too much.
COLUMN_GAP, FOOTNOTE_REACH, OVERLAP_SHARE = 50.0, 200.0, 0.5


def zipped(boxes: str = "block_boxes", classes: str = "block_classes", texts: str = "block_text") -> Column:
    """ARRAY<STRUCT<idx, size, x1, y1, x2, y2, cls, text>> of a page, one per box; coordinates as doubles, null where absent."""
    at = lambda b, k: F.get(b, F.lit(k)).cast("double")
    return F.transform(
        boxes,
        lambda b, i: F.struct(
            i.cast("int").alias("idx"),
            F.size(b).alias("size"),
            at(b, 0).alias("x1"),
            at(b, 1).alias("y1"),
            at(b, 2).alias("x2"),
            at(b, 3).alias("y2"),
            F.get(classes, i).alias("cls"),
            F.get(texts, i).alias("text"),
        ),
    )


def whole(blocks: Column) -> Column:
    """The blocks with four coordinates, none of them null."""
    return F.filter(blocks, lambda b: (b["size"] >= 4) & b["x1"].isNotNull() & b["y1"].isNotNull() & b["x2"].isNotNull() & b["y2"].isNotNull())


def _centre(b: Column) -> Column:
    return (b["x1"] + b["x2"]) / 2


def column_layout(blocks: Column, gap: float = COLUMN_GAP) -> Column:
    """single, double or multi: by the gaps wider than ``gap`` between the sorted centres of the blocks; single below three blocks."""
    centres = F.array_sort(F.transform(blocks, _centre))
    wide = F.filter(F.transform(centres, lambda x, i: F.get(centres, i + 1) - x), lambda g: g > gap)
    return F.when((F.size(blocks) < 3) | (F.size(wide) == 0), "single").when(F.size(wide) == 1, "double").otherwise("multi")


def geometry_order(blocks: Column, gap: float = COLUMN_GAP) -> Column:
    """ARRAY<INT>: block positions from top to bottom.

    In a single column ties go left to right; else the left half of the page comes first. All further ties keep the stored order.
    """
    middle = F.array_max(F.transform(blocks, lambda b: b["x2"])) / 2
    layout = column_layout(blocks, gap)
    tie = lambda b: F.when(layout == "single", b["x1"]).otherwise(F.when(_centre(b) < middle, 0.0).otherwise(1.0))
    keyed = F.transform(blocks, lambda b: F.struct(b["y1"].alias("y"), tie(b).alias("t"), b["idx"].alias("idx")))
    return F.transform(F.array_sort(keyed), lambda s: s["idx"])


def _across(a: Column, b: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"]))


def _down(a: Column, b: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"]))


def _edge(source: Column, target: Column, name: str) -> Column:
    return F.struct(source.alias("source"), target.alias("target"), F.lit(name).alias("relation"))


def caption_edges(blocks: Column, label: str) -> Column:
    """Two edges between every block of ``label`` and the nearest caption that shares a column with it.

    Nearest by the distance of centres, ties to the lower position; a caption may serve several blocks. The edge that starts at the block
    comes first where the caption stands below its top.
    """
    has, of = CAPTIONED[label]
    middle = lambda b: (b["y1"] + b["y2"]) / 2
    captions = F.filter(blocks, lambda b: b["cls"] == "Caption")

    def edges(b: Column) -> Column:
        near = F.transform(
            F.filter(captions, lambda c: _across(b, c) > 0),
            lambda c: F.struct(F.abs(middle(c) - middle(b)).alias("far"), c["idx"].alias("idx"), c["y1"].alias("y1")),
        )
        best = F.array_min(near)
        there, back = _edge(b["idx"], best["idx"], has), _edge(best["idx"], b["idx"], of)
        pair = F.when(best["y1"] > b["y1"], F.array(there, back)).otherwise(F.array(back, there))
        return F.when(F.size(near) > 0, pair).otherwise(F.array().cast("array<struct<source:int,target:int,relation:string>>"))

    return F.flatten(F.transform(F.filter(blocks, lambda b: b["cls"] == label), edges))


def footnote_edges(blocks: Column, reach: float = FOOTNOTE_REACH) -> Column:
    """One edge per footnote, from the first other block above it in its column and within ``reach``, to the footnote.

    The distance measured is that of the block's centre from the footnote's top less the block's bottom.
    """
    body = F.filter(blocks, lambda b: ~F.coalesce(b["cls"] == "Footnote", F.lit(False)))

    def edge(f: Column) -> Column:
        fits = F.filter(
            body,
            lambda b: (b["y1"] < f["y1"]) & (F.abs((b["y1"] + b["y2"]) / 2 - (f["y1"] - b["y2"])) < reach) & (_across(b, f) > 0),
        )
        return F.transform(F.slice(fits, 1, 1), lambda b: _edge(b["idx"], f["idx"], "footnote_refers_to"))

    return F.flatten(F.transform(F.filter(blocks, lambda b: b["cls"] == "Footnote"), edge))


def auto_edges(blocks: Column) -> Column:
    """All edges found by geometry: tables, pictures, footnotes."""
    return F.concat(caption_edges(blocks, "Table"), caption_edges(blocks, "Picture"), footnote_edges(blocks))


def overlaps(blocks: Column, share: float = OVERLAP_SHARE) -> Column:
    """ARRAY<STRUCT<a, b, area>> of pairs a < b of one page whose common area exceeds ``share`` of the smaller box."""
    area = lambda b: (b["x2"] - b["x1"]) * (b["y2"] - b["y1"])

    def with_later(a: Column) -> Column:
        later = F.filter(blocks, lambda b: (b["idx"] > a["idx"]) & (_across(a, b) * _down(a, b) > F.lit(share) * F.least(area(a), area(b))) & (_across(a, b) * _down(a, b) > 0))
        return F.transform(later, lambda b: F.struct(a["idx"].alias("a"), b["idx"].alias("b"), (_across(a, b) * _down(a, b)).alias("area")))

    return F.flatten(F.transform(blocks, with_later))


def _paged(annotations: DataFrame) -> DataFrame:
    """``annotations`` that have boxes, with their whole blocks in ``bs_``."""
    return annotations.where("block_boxes is not null").withColumn("bs_", whole(zipped()))


def reading_orders(annotations: DataFrame, key: str = "ann_id") -> DataFrame:
    """(key, idx, rank): the geometric place of every block. Pages without boxes have no row."""
    rows = _paged(annotations).select(key, F.posexplode(geometry_order(F.col("bs_"))).alias("rank", "idx"))
    return rows.select(key, "idx", "rank")


def layouts(annotations: DataFrame, key: str = "ann_id") -> DataFrame:
    """(key, n_blocks, layout) per page."""
    return _paged(annotations).select(key, F.size("bs_").alias("n_blocks"), column_layout(F.col("bs_")).alias("layout"))


def order_choice(annotations: DataFrame, key: str = "ann_id", agreement: float = 0.8) -> DataFrame:
    """(key, agree, source): the stored order where it has the geometric length and agrees with it in ``agreement`` of its places, else
    the geometric order. A page without stored order or blocks takes geometry."""
    geo = geometry_order(F.col("bs_"))
    stored = F.col("reading_order")
    same = F.size(F.filter(F.zip_with(stored, geo, lambda a, b: a == b), lambda x: F.coalesce(x, F.lit(False))))
    fits = (F.size(geo) > 0) & F.coalesce(F.size(stored) == F.size(geo), F.lit(False))
    agree = F.when(fits, F.round(same / F.size(geo), 6)).otherwise(0.0)
    return _paged(annotations).select(key, agree.alias("agree"), F.when(agree >= agreement, "stored").otherwise("geometry").alias("source"))


def relations(annotations: DataFrame, edges: Column, key: str = "ann_id") -> DataFrame:
    """(key, pos, source, target, relation): ``edges`` of every page, one row per edge in their order."""
    return _paged(annotations).select(key, F.posexplode(edges).alias("pos", "e")).select(key, "pos", "e.*")


def filled_relations(annotations: DataFrame, key: str = "ann_id") -> DataFrame:
    """(key, pos, source, target, relation): the stored relations, or the geometric ones where none are stored."""
    kind = "array<struct<source:int,target:int,relation:string>>"
    held = F.col("block_relations").cast(kind)
    return relations(annotations, F.when(F.coalesce(F.size(held), F.lit(0)) > 0, held).otherwise(auto_edges(F.col("bs_"))), key)


def overlapping(annotations: DataFrame, key: str = "ann_id") -> DataFrame:
    """(key, a, b, area): overlapping pairs of blocks of one page."""
    return _paged(annotations).select(key, F.explode(overlaps(F.col("bs_"))).alias("o")).select(key, "o.*")


def overlay_boxes(annotations: DataFrame, key: str = "ann_id") -> DataFrame:
    """(key, idx, x1, y1, x2, y2, color, label): rectangles and labels to draw.

    ``label`` has the block's position, its class and the value of the reading order at that position. A block without class counts as text;
    unknown classes are grey.
    """
    colors = F.create_map(*[F.lit(x) for kv in COLORS.items() for x in kv])
    rows = _paged(annotations).select(key, "reading_order", F.explode("bs_").alias("b"))
    cls = F.coalesce("b.cls", F.lit("Text"))
    at = F.get("reading_order", F.col("b.idx"))
    place = F.when(F.col("b.idx") < F.size("reading_order"), F.concat(F.lit(" RO:"), F.coalesce(at.cast("string"), F.lit("None")))).otherwise("")
    label = F.concat(F.lit("["), F.col("b.idx"), F.lit("] "), cls, F.coalesce(place, F.lit("")))
    return rows.select(
        key, "b.idx", "b.x1", "b.y1", "b.x2", "b.y2", F.coalesce(F.try_element_at(colors, cls), F.lit("200,200,200")).alias("color"), label.alias("label")
    )


def legend(annotations: DataFrame, key: str = "ann_id") -> DataFrame:
    """(key, pos, class, color): the classes of a page with their colours, in alphabetical order; unknown classes are grey."""
    colors = F.create_map(*[F.lit(x) for kv in COLORS.items() for x in kv])
    classes = F.array_sort(F.array_distinct(F.filter("block_classes", lambda c: c.isNotNull())))
    rows = annotations.where("block_classes is not null").select(key, F.posexplode(classes).alias("pos", "class"))
    return rows.withColumn("color", F.coalesce(F.try_element_at(colors, F.col("class")), F.lit("200,200,200")))


def _point(b: Column) -> Column:
    return F.struct(_centre(b).cast("int").alias("x"), ((b["y1"] + b["y2"]) / 2).cast("int").alias("y"), b["idx"].alias("idx"))


def order_arrows(annotations: DataFrame, key: str = "ann_id") -> DataFrame:
    """(key, pos, from_idx, to_idx, x1, y1, x2, y2): arrows between blocks that follow each other in the stored order; ends that name no
    block are skipped."""
    order = F.coalesce("reading_order", F.array().cast("array<int>"))
    steps = F.transform(F.slice(order, 1, F.greatest(F.size(order) - 1, F.lit(0))), lambda a, i: F.struct(a.alias("a"), F.get(order, i + 1).alias("b")))
    rows = _paged(annotations).select(key, "bs_", F.posexplode(steps).alias("pos", "s"))
    return _arrows(rows, key, F.col("s.a"), F.col("s.b")).select(key, "pos", "from_idx", "to_idx", "x1", "y1", "x2", "y2")


def relation_arrows(annotations: DataFrame, key: str = "ann_id") -> DataFrame:
    """(key, pos, from_idx, to_idx, relation, x1, y1, x2, y2): arrows of the stored relations; ends that name no block are skipped, and
    so are negative ones."""
    rows = _paged(annotations).select(key, "bs_", F.posexplode("block_relations").alias("pos", "r"))
    return _arrows(rows, key, F.col("r.source"), F.col("r.target"), F.col("r.relation").alias("relation")).select(
        key, "pos", "from_idx", "to_idx", "relation", "x1", "y1", "x2", "y2"
    )


def _arrows(rows: DataFrame, key: str, a: Column, b: Column, *more: Column) -> DataFrame:
    at = lambda end: F.get(F.transform(F.filter("bs_", lambda x: x["idx"] == end), _point), F.lit(0))
    return (
        rows.select(key, "pos", at(a).alias("p"), at(b).alias("q"), *more)
        .where("p is not null and q is not null")
        .select("*", F.col("p.idx").alias("from_idx"), F.col("q.idx").alias("to_idx"), F.col("p.x").alias("x1"), F.col("p.y").alias("y1"), F.col("q.x").alias("x2"), F.col("q.y").alias("y2"))
    )


def repeated_texts(annotations: DataFrame, key: str = "ann_id", longer_than: int = 10) -> DataFrame:
    """(key, idx, earlier): blocks whose text, without case and outer white space, is longer than ``longer_than`` and stood before in the
    page; ``earlier`` is the last block before with it."""
    texts = F.transform("block_text", lambda t: F.lower(strip(t)))
    rows = annotations.where("block_text is not null").select(key, texts.alias("ts"))
    found = F.transform(
        "ts",
        lambda t, i: F.struct(
            i.cast("int").alias("idx"),
            F.array_max(F.filter(F.transform("ts", lambda u, j: F.when((j < i) & (u == t), j.cast("int"))), lambda j: j.isNotNull())).alias("earlier"),
            F.char_length(t).alias("n"),
        ),
    )
    return rows.select(key, F.explode(found).alias("f")).where(f"f.earlier is not null and f.n > {longer_than}").select(key, "f.idx", "f.earlier")


def repeated_boxes(annotations: DataFrame, key: str = "ann_id") -> DataFrame:
    """(key, idx): boxes that stood before in the page, compared by whole pixels."""
    boxes = F.transform("block_boxes", lambda b: F.transform(b, lambda v: v.cast("int")))
    rows = annotations.where("block_boxes is not null").select(key, boxes.alias("bb"))
    again = F.transform("bb", lambda b, i: F.when(F.array_position("bb", b) < i + 1, i.cast("int")))
    return rows.select(key, F.explode(F.filter(again, lambda i: i.isNotNull())).alias("idx"))
