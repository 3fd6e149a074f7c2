"""Structure checks and quality scores of annotated pages.

All checks of a page are computed inside its row: ``findings`` is the array of what was found, in the order of the checks and, within a
check, of the blocks. Two conditions end the checking early: a missing required part (nothing else is looked at) and a page without
blocks (only the lengths were looked at). A wrong length of the reading order ends the level-4 checks.

Missing parts are null columns; null elements of an order or a relation are out of range or missing, null texts are empty.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.functions.jsontext import is_json
from folioframe.functions.text import is_blank, percent, strip
from folioframe.operators.layout import CLASSES, RELATIONS, overlaps, whole, zipped

REQUIRED = ("image", "block_boxes", "block_classes", "block_text")
#: Boxes below this area are too small.
SMALL_AREA = 500.0
SCORES = ("ocr", "layout", "reading_order", "boxes", "relations")
FINDING = "array<struct<check:string,severity:string,idx:int>>"


def _none() -> Column:
    return F.array().cast(FINDING)


def _one(check: str, severity: str | Column, idx: Column | None = None) -> Column:
    level = F.lit(severity) if isinstance(severity, str) else severity
    place = F.lit(-1) if idx is None else idx.cast("int")
    return F.struct(F.lit(check).alias("check"), level.alias("severity"), place.alias("idx"))


def _when(condition: Column, check: str, severity: str) -> Column:
    return F.when(condition, F.array(_one(check, severity))).otherwise(_none())


def _indexed(items: Column, check: str, severity) -> Column:
    """One finding per element for which ``severity(x, i)`` is not null."""
    found = F.transform(items, lambda x, i: _one(check, severity(x, i), i))
    return F.filter(found, lambda f: f["severity"].isNotNull())


def missing_parts() -> Column:
    """The required parts that are null, in fixed order."""
    return F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED]), lambda x: x.isNotNull())


def box_state(b: Column) -> Column:
    """Of a box: length, degenerate, normalized, small or valid; the first that holds."""
    values = F.filter(b, lambda v: v.isNotNull())
    at = lambda k: F.get(b, F.lit(k)).cast("double")
    ordered = (at(2) > at(0)) & (at(3) > at(1))
    return (
        F.when((F.size(b) != 4) | (F.size(values) != 4) | b.isNull(), "length")
        .when(~ordered, "degenerate")
        .when(F.array_max(values) <= 1, "normalized")
        .when((at(2) - at(0)) * (at(3) - at(1)) < SMALL_AREA, "small")
        .otherwise("valid")
    )


def relation_state(r: Column, n: Column) -> Column:
    """Of a relation: missing, range, self, type or valid; the first that holds."""
    inside = lambda e: (e >= 0) & (e < n)
    return (
        F.when(r.isNull() | r["source"].isNull() | r["target"].isNull() | r["relation"].isNull(), "missing")
        .when(~(inside(r["source"]) & inside(r["target"])), "range")
        .when(r["source"] == r["target"], "self")
        .when(~r["relation"].isin(*RELATIONS), "type")
        .otherwise("valid")
    )


def _n() -> Column:
    return F.size("block_boxes")


def _level_4() -> Column:
    return F.col("reading_order").isNotNull() & F.col("block_relations").isNotNull()


def _empty_texts() -> Column:
    return F.size(F.filter("block_text", is_blank))


def _order_findings() -> Column:
    order = F.col("reading_order")
    n = _n()

    def severity(v: Column, i: Column) -> Column:
        outside = v.isNull() | (v < 0) | (v >= n)
        again = F.array_position(order, v) < i + 1
        return F.when(outside, "error").when(again, "warning")

    wrong = F.size(order) != n
    return F.when(wrong, F.array(_one("reading_order_length", "error"))).otherwise(_indexed(order, "reading_order", severity))


def _caption_findings() -> Column:
    ends = F.flatten(F.transform("block_relations", lambda r: F.array(r["source"], r["target"])))
    joined = F.filter(ends, lambda e: e.isNotNull())

    def missing(label: str, check: str) -> Column:
        return _indexed(
            F.col("block_classes"), check, lambda c, i: F.when((c == label) & ~F.array_contains(joined, i.cast("int")), "warning")
        )

    return F.concat(missing("Table", "table_captions"), missing("Picture", "figure_captions"))


def findings() -> Column:
    """ARRAY<STRUCT<check, severity, idx>> of a page; idx is −1 where the finding is about the page."""
    n = _n()
    lengths = F.concat(
        _when(F.size("block_classes") != n, "array_lengths", "error"), _when(F.size("block_text") != n, "array_lengths", "error")
    )
    boxes = _indexed(
        F.col("block_boxes"), "boxes", lambda b, i: F.when(box_state(b) == "small", "warning").when(box_state(b) != "valid", "error")
    )
    classes = _indexed(F.col("block_classes"), "classes", lambda c, i: F.when(~F.coalesce(c.isin(*CLASSES), F.lit(False)), "error"))
    pixels = F.transform("block_boxes", lambda b: F.transform(b, lambda v: v.cast("int")))
    same_box = _indexed(pixels, "duplicate_boxes", lambda b, i: F.when(F.array_position(pixels, b) < i + 1, "warning"))
    over = F.transform(overlaps(whole(zipped())), lambda o: _one("overlapping_boxes", "warning", o["a"]))
    keys = F.transform("block_text", lambda t: F.lower(strip(t)))
    same_text = _indexed(keys, "duplicate_text", lambda t, i: F.when((F.char_length(t) > 10) & (F.array_position(keys, t) < i + 1), "warning"))
    empty = F.when(_empty_texts() == n, F.array(_one("empty_text", "error"))).otherwise(_when(_empty_texts() > n * 0.5, "empty_text", "warning"))
    right_length = F.size("reading_order") == n
    relations = _indexed(
        F.col("block_relations"),
        "relations",
        lambda r, i: F.when(relation_state(r, n) == "type", "warning").when(relation_state(r, n) != "valid", "error"),
    )
    level_4 = F.when(
        _level_4(),
        F.concat(_order_findings(), F.when(right_length, F.concat(relations, _caption_findings())).otherwise(_none())),
    ).otherwise(_none())
    full = reduce(lambda a, b: F.concat(a, b), [lengths, boxes, classes, same_box, over, same_text, empty, level_4])
    return (
        F.when(F.size(missing_parts()) > 0, F.array(_one("required_fields", "error")))
        .when(n == 0, F.concat(lengths, F.array(_one("non_empty", "error"))))
        .otherwise(full)
    )


def page_findings(annotations: DataFrame, key: str = "ann_id") -> DataFrame:
    """(key, pos, check, severity, idx): all findings of all pages."""
    return annotations.select(key, F.posexplode(findings()).alias("pos", "f")).select(key, "pos", "f.*")


def _result() -> list[Column]:
    """The columns of ``validate`` over rows with the findings in ``f_`` and their numbers by ``check/severity`` in ``k_``."""
    n = _n()
    f = F.col("f_")
    number = lambda check, severity: F.coalesce(F.try_element_at("k_", F.lit(f"{check}/{severity}")), F.lit(0)).cast("bigint")
    both = lambda check: number(check, "error") + number(check, "warning")
    parts = F.size(missing_parts()) == 0
    looked = parts & (n > 0)
    level_4 = looked & _level_4()
    inner = level_4 & (F.size("reading_order") == n)

    def status(check: str, seen: Column) -> Column:
        worst = F.when(number(check, "error") > 0, "FAIL").when(number(check, "warning") > 0, "WARN").otherwise("PASS")
        return F.when(seen, worst).alias(check)

    last = F.try_element_at(F.filter(f, lambda x: x["check"] == "reading_order"), F.lit(-1))["severity"]
    order = (
        F.when(looked & ~_level_4(), "N/A")
        .when(level_4 & (both("reading_order_length") > 0), "FAIL")
        .when(level_4 & (both("reading_order") == 0), "PASS")
        .when(level_4, F.when(last == "error", "FAIL").otherwise("WARN"))
    )
    counted = lambda check, items, seen: (
        F.when(seen, F.size(items).cast("bigint") - both(check)).alias(f"{check}_valid"),
        F.when(seen, both(check)).alias(f"{check}_invalid"),
    )
    errors = F.coalesce(F.try_element_at("k_", F.lit("error")), F.lit(0)).cast("bigint")
    distinct = F.size(F.array_distinct("block_classes"))
    return [
        (errors == 0).alias("valid"),
        errors.alias("n_errors"),
        (F.size(f).cast("bigint") - errors).alias("n_warnings"),
        F.when(looked, F.when(_level_4(), 4).otherwise(3)).otherwise(0).alias("level"),
        F.when(looked, n).otherwise(0).alias("class_count"),
        F.when(looked, distinct > 1).alias("diverse"),
        F.when(parts, "PASS").otherwise("FAIL").alias("required_fields"),
        status("array_lengths", parts),
        status("non_empty", parts),
        *counted("boxes", F.col("block_boxes"), looked),
        *counted("classes", F.col("block_classes"), looked),
        status("duplicate_boxes", looked),
        status("overlapping_boxes", looked),
        status("duplicate_text", looked),
        status("empty_text", looked),
        order.alias("reading_order"),
        *counted("relations", F.col("block_relations"), inner),
        status("table_captions", inner),
        status("figure_captions", inner),
    ]


def _found(annotations: DataFrame) -> DataFrame:
    """``annotations`` with ``f_`` and, counted in one walk over them, ``k_``."""
    plus = lambda m, key: F.map_concat(F.map_filter(m, lambda k, v: k != key), F.create_map(key, F.coalesce(F.try_element_at(m, key), F.lit(0)) + 1))

    def add(m: Column, x: Column) -> Column:
        once = plus(m, F.concat(x["check"], F.lit("/"), x["severity"]))
        return F.when(x["severity"] == "error", plus(once, F.lit("error"))).otherwise(once)

    counts = F.aggregate("f_", F.create_map().cast("map<string,int>"), add)
    return annotations.withColumn("f_", findings()).withColumn("k_", counts)


def validate(annotations: DataFrame, key: str = "ann_id") -> DataFrame:
    """One row per page: valid, n_errors, n_warnings, level, class_count (of its blocks), diverse, then a status or two counters per check.

    Statuses are PASS, WARN or FAIL, N/A for a page below level 4, and null for what was not looked at.
    """
    return _found(annotations).select(key, *_result())


def _points() -> list[Column]:
    """The five scores over the columns of a page; the overall one is their mean."""
    n = _n()
    least = F.greatest(n, F.lit(1))
    order = F.col("reading_order")
    held = F.coalesce("block_relations", F.array().cast("array<struct<source:int,target:int,relation:string>>"))
    outside = F.size(F.filter(order, lambda v: v.isNull() | (v < 0) | (v >= n)))
    again = F.size(order) - F.size(F.array_distinct(order))
    faults = F.when(F.size(order) != n, 5).otherwise(0) + 2 * outside + again
    bad = F.size(F.filter("block_boxes", lambda b: box_state(b).isin("length", "degenerate", "normalized")))
    inside = lambda e: F.coalesce((e >= 0) & (e < n), F.lit(False))
    good = F.size(F.filter(held, lambda r: inside(r["source"]) & inside(r["target"]) & F.coalesce(r["relation"].isin(*RELATIONS), F.lit(False))))
    distinct = F.size(F.array_distinct("block_classes"))
    zero = F.lit(0)
    scores = {
        "ocr": F.greatest(zero, 100 - percent(_empty_texts(), least)),
        "layout": F.least(F.lit(100), percent(distinct, F.lit(len(CLASSES))) + 50),
        "order": F.when(_level_4(), F.greatest(zero, 100 - 10 * faults)).otherwise(0),
        "boxes": F.greatest(zero, 100 - percent(bad, least)),
        "relations": F.when((n > 0) & (F.size(held) > 0), percent(good, F.greatest(F.size(held), F.lit(1)))).when((n > 0) & _level_4(), 100).otherwise(0),
    }
    parts = F.size(missing_parts()) == 0
    return [F.when(parts, c).cast("int").alias(name) for name, c in scores.items()]


def _overall(names: list[str]) -> Column:
    return (reduce(lambda a, b: a + b, [F.col(c) for c in names]) / F.lit(5)).cast("int").alias("overall")


def score(annotations: DataFrame, key: str = "ann_id") -> DataFrame:
    """(key, ocr, layout, reading_order, boxes, relations, overall): whole points from 0 to 100, all percentages cut toward zero.

    A page that lacks a required part has null scores. Here small boxes are not bad, and a relation of a block to itself is valid.
    """
    rows = annotations.select(key, *_points())
    names = [c for c in rows.columns if c != key]
    return rows.select(key, *[F.col(c).alias(n) for c, n in zip(names, SCORES)], _overall(names))


def judged(annotations: DataFrame, key: str = "ann_id", *more: str) -> DataFrame:
    """(key, ``more``, valid, diverse, class_count, score_*): checks and scores of every page, both from one reading of its row."""
    result = {c: x for c, x in zip(("valid", "n_errors", "n_warnings", "level", "class_count", "diverse"), _result())}
    points = [p.alias(f"score_{c}") for p, c in zip(_points(), SCORES)]
    rows = _found(annotations).select(key, *more, result["valid"], result["diverse"], result["class_count"], *points)
    return rows.select("*", _overall([f"score_{c}" for c in SCORES]).alias("score_overall"))


def report(annotations: DataFrame, key: str = "ann_id") -> DataFrame:
    """One row: pages, passed, and the mean of every score cut toward zero (0 for an empty table)."""
    rows = judged(annotations, key)
    means = [F.coalesce(F.avg(f"score_{c}").cast("int"), F.lit(0)).alias(f"avg_{c}") for c in (*SCORES, "overall")]
    return rows.agg(F.count(F.lit(1)).alias("pages"), F.count_if("valid").alias("passed"), *means)


def check_totals(annotations: DataFrame, key: str = "ann_id") -> DataFrame:
    """(check, n_valid, n_total): counters summed over all pages for the checks that count, PASS against all for those with a status."""
    rows = validate(annotations, key)
    counted = [(c, F.col(f"{c}_valid"), F.col(f"{c}_valid") + F.col(f"{c}_invalid")) for c in ("boxes", "classes", "relations")]
    statuses = ("required_fields", "array_lengths", "non_empty", "duplicate_boxes", "overlapping_boxes", "duplicate_text", "empty_text", "reading_order", "table_captions", "figure_captions")
    stated = [(c, (F.col(c) == "PASS").cast("bigint"), F.when(F.col(c).isin("PASS", "WARN", "FAIL"), F.lit(1))) for c in statuses]
    sums = rows.agg(*[F.coalesce(F.sum(x), F.lit(0)).cast("bigint").alias(f"{c}_{k}") for c, good, every in (*counted, *stated) for k, x in (("v", good), ("t", every))])
    pairs = [F.struct(F.lit(c).alias("check"), F.col(f"{c}_v").alias("n_valid"), F.col(f"{c}_t").alias("n_total")) for c, _, _ in (*counted, *stated)]
    return sums.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


def best_pages(annotations: DataFrame, n: int, key: str = "ann_id", name: str = "image") -> DataFrame:
    """The ``n`` best pages for a sample: diverse ones first, then by the number of blocks, then by name and key. 0 keeps all."""
    rows = judged(annotations, key, name).select(key, F.coalesce("diverse", F.lit(False)).alias("diverse"), "class_count", name)
    return rows.orderBy(F.desc("diverse"), F.desc("class_count"), name, key).limit(n) if n > 0 else rows


def missing_fields(records: DataFrame, key: str, payload: str) -> DataFrame:
    """(key, page_pos, missing): of every page of the object in ``payload`` the required parts whose key is absent, joined by commas in fixed
    order; ``unreadable`` (at page 0) for what is not a JSON object. Null payloads are unreadable; a page that is no object lacks all parts."""
    whole = F.coalesce(is_json(F.col(payload)) & F.json_object_keys(payload).isNotNull(), F.lit(False))
    listed = F.from_json(payload, "struct<pages:array<string>>")["pages"]
    many = F.array_contains(F.json_object_keys(payload), "pages") & listed.isNotNull()
    pages = F.when(whole & many, listed).otherwise(F.array(payload))
    rows = records.select(key, whole.alias("whole"), F.posexplode(pages).alias("page_pos", "page"))
    keys = F.coalesce(F.json_object_keys("page"), F.array().cast("array<string>"))
    absent = F.array_join(F.array_except(F.array(*map(F.lit, REQUIRED)), keys), ",")
    return rows.select(key, "page_pos", F.when(F.col("whole"), absent).otherwise("unreadable").alias("missing"))
