"""Duplicates hidden by formatting: dictionary-encoded records, grouped as compact integer tuples.

Every record is a set of (field, value) pairs. ``encode`` takes the distinct pairs, canonicalises each of them once, gives each
canonical pair one integer, and rewrites every record as the sorted tuple of its integers. Only 16-byte keys and integers are
shuffled after the first pass; the values themselves leave the scan once, deduplicated on the map side.

Values are compared by 128-bit digests (chance of a false match among 10^12 distinct values: below 10^-14).
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.operators.skew import heavy_join
from folioframe.session import stored

PAIR = "array<struct<field:string,value:string,fold:boolean>>"


def folded(text: Column) -> Column:
    """``text`` without case, white space and punctuation: letters, marks and digits remain."""
    return F.lower(F.regexp_replace(text, r"[^\p{L}\p{M}\p{N}]+", ""))


def _digest(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat_ws("\u0001", *parts)))


def collapse(records: DataFrame) -> DataFrame:
    """(src, kept_id, copy_id): one row per id that repeats an earlier record of its ``src``.

    ``records`` has src, id and ``pairs`` (``PAIR``): fields with null values are absent from ``pairs``, so null and empty differ.
    kept_id is the smallest id of the group. A record delivered again under its own id is no copy. An empty table gives none.
    """
    group = grouped(records)
    sizes = group.groupBy("src", "key").agg(F.min("id").alias("kept_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
    total = group.count()
    return (
        heavy_join(group, sizes, ["src", "key"], "n", total)
        .where("id <> kept_id")
        .select("src", "kept_id", F.col("id").alias("copy_id"))
    )


def copies(records: DataFrame) -> DataFrame:
    """(src, kept_id, n_copies): one row per group, single records included."""
    return (
        grouped(records)
        .groupBy("src", "key")
        .agg(F.min("id").cast("bigint").alias("kept_id"), F.count(F.lit(1)).cast("bigint").alias("n_copies"))
        .drop("key")
    )


def grouped(records: DataFrame) -> DataFrame:
    """(src, id, key), each once: ``key`` is equal for records whose integer tuples are equal."""
    tuples = encode(records)
    key = F.unhex(F.md5(F.array_join(F.transform("ids", lambda x: x.cast("string")), ",")))
    return stored(tuples.select("src", "id", key.alias("key")).distinct(), "groups")


def encode(records: DataFrame) -> DataFrame:
    """(src, id, uid, ids): each record as the sorted integers of its field-value pairs."""
    base = F.struct(F.lit("").alias("field"), F.lit("").alias("value"), F.lit(False).alias("fold"))
    long = (
        records.select("src", "id", F.monotonically_increasing_id().alias("uid"), F.concat(F.array(base), "pairs").alias("pairs"))
        .select("src", "id", "uid", F.explode("pairs").alias("p"))
        .select("src", "id", "uid", "p.*")
        .withColumn("raw", _digest(F.col("field"), F.col("fold").cast("string"), F.col("value")))
    )
    # Records as digests; the texts of values are read again for the distinct pairs rather than stored with every record.
    pairs = stored(long.select("src", "id", "uid", "raw"), "pairs")
    distinct = long.groupBy("raw").agg(
        F.first("field").alias("field"), F.first("value").alias("value"), F.first("fold").alias("fold"), F.count(F.lit(1)).alias("n")
    )
    canonical = distinct.select(
        "raw",
        "n",
        _digest(F.col("field"), F.when(F.col("fold"), folded(F.col("value"))).otherwise(F.col("value"))).alias("canon"),
    )
    canonical = stored(canonical, "values")
    numbers = stored(canonical.select("canon").distinct().withColumn("vid", F.monotonically_increasing_id()), "numbers")
    dictionary = stored(canonical.join(numbers, "canon").select("raw", "vid", "n"), "dictionary")
    total = pairs.count()
    return (
        heavy_join(pairs, dictionary, ["raw"], "n", total)
        .groupBy("src", "id", "uid")
        .agg(F.sort_array(F.collect_list("vid")).alias("ids"))
    )


def _pair(field: str, value: Column, fold: bool = False) -> Column:
    return F.struct(F.lit(field).alias("field"), value.cast("string").alias("value"), F.lit(fold).alias("fold"))


def _present(*pairs: Column) -> Column:
    return F.filter(F.array(*pairs), lambda p: p["value"].isNotNull())


def _each(field: str, values: Column) -> Column:
    """One folded pair per element of ``values``; the length is a pair too, so null elements count."""
    elements = F.transform(
        values,
        lambda x, i: F.struct(
            F.concat(F.lit(field + "["), i.cast("string"), F.lit("]")).alias("field"), x.alias("value"), F.lit(True).alias("fold")
        ),
    )
    none = F.array().cast(PAIR)
    size = _present(_pair(field, F.when(values.isNotNull(), F.size(values))))
    return F.concat(size, F.filter(F.coalesce(elements, none), lambda p: p["value"].isNotNull()))


def block_records(blocks: DataFrame) -> DataFrame:
    """Blocks as records: page, place, label and folded text."""
    same = ["page_id", "idx", "class_label", "is_picture", "reading_order_index"]
    return blocks.select(
        F.lit("block").alias("src"),
        F.col("block_id").alias("id"),
        _present(*[_pair(c, F.col(c)) for c in same], _pair("box", F.to_json("box")), _pair("text", F.col("text"), True)).alias("pairs"),
    )


def page_records(annotations: DataFrame) -> DataFrame:
    """Page annotations as records: everything but the id and the time of saving, texts folded one by one."""
    plain = ["page_id", "image", "annotation_quality", "lang"]
    nested = ["block_boxes", "block_classes", "reading_order", "block_relations"]
    return annotations.select(
        F.lit("page").alias("src"),
        F.col("ann_id").alias("id"),
        F.concat(
            _present(
                *[_pair(c, F.col(c)) for c in plain],
                *[_pair(c, F.to_json(c, {"ignoreNullFields": "false"})) for c in nested],
            ),
            _each("block_text", F.col("block_text")),
        ).alias("pairs"),
    )


def _leaves(value: object, path: str, out: list[dict]) -> None:
    if isinstance(value, dict):
        out.append({"field": path + "{}", "value": str(len(value)), "fold": False})
        for name, inner in value.items():
            _leaves(inner, f"{path}.{json.dumps(name)}", out)
    elif isinstance(value, list) and value and not any(isinstance(x, (dict, list, str)) for x in value):
        # A list of numbers, truth values and nulls is one value; only texts are compared on their own.
        plain = [int(x) if isinstance(x, float) and x.is_integer() else x for x in value]
        out.append({"field": path + "[]", "value": json.dumps(plain), "fold": False})
    elif isinstance(value, list):
        out.append({"field": path + "[]", "value": str(len(value)), "fold": False})
        for i, inner in enumerate(value):
            _leaves(inner, f"{path}[{i}]", out)
    elif isinstance(value, str):
        out.append({"field": path + " text", "value": value.encode("utf-8", "replace").decode(), "fold": True})
    else:
        if isinstance(value, float) and value.is_integer():
            value = int(value)
        out.append({"field": path, "value": json.dumps(value), "fold": False})


def _flatten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("field", pa.string()), ("value", pa.string()), ("fold", pa.bool_())]))
    for batch in batches:
        ids, rows = [], []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if text is None:
                continue
            try:
                value = json.loads(text)
            except (ValueError, RecursionError):
                continue
            leaves: list[dict] = []
            _leaves(value, "$", leaves)
            ids.append(key)
            rows.append(leaves)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(rows, kind)], ["id", "pairs"])


def json_records(records: DataFrame, key: str = "rec_id", payload: str = "payload") -> DataFrame:
    """JSON payloads as records of their leaves: field order and layout vanish, texts are folded. Unreadable payloads are left
    out: they are not JSON, so not the same JSON as any other."""
    flat = records.select(F.col(key).cast("bigint").alias("id"), payload).mapInArrow(_flatten, f"id bigint, pairs {PAIR}")
    return flat.select(F.lit("record").alias("src"), "id", "pairs")
