"""Nested JSON records to related flat tables by shared inlining.

1. ``infer_graph`` reads the schema graph off all records with ``schema_of_variant_agg``. Where one place holds values of
   several kinds (a box as a list or as an object, relations as a list or as JSON inside a string) the aggregate only says
   VARIANT; such places are aggregated again, once per kind, until nothing mixed is left. What reaches the driver is schema
   text, whose size depends on the number of distinct fields and not on the number of records.
2. ``plan_tables`` applies the rule: an object with one parent is inlined into its parent's row; an element that is repeated
   (array), shared (its name occurs under several parents), keyed (its field names are data) or recursive gets its own table.
3. ``shred`` builds each table with one scan: all access paths of the element are gathered in one array per record and
   exploded once. Every row keeps the record's key, the name and the position path of its parent row (the foreign key), and
   its own position.

Payloads are parsed once and stored as VARIANT; all later steps read that. Strings are opened only where the graph found JSON in them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.functions.jsontext import whole_json
from folioframe.session import stored

ITEM = "[]"
#: Parts of an annotation that may come as JSON inside a string.
PARTS = ("pages", "block_boxes", "block_relations", "checks", "validation", "validation_results")
ROOT = "record"
_TOKEN = re.compile(r"`(?:[^`]|``)*`|[A-Za-z0-9_.\-]+|[<>,:()]")


@dataclass
class Node:
    """One element of the schema graph. ``kinds`` holds object, array, scalar, text or mixed; ``scalar`` a SQL type."""

    label: str
    kinds: set[str] = field(default_factory=set)
    scalar: str | None = None
    children: dict[str, Node] = field(default_factory=dict)
    item: Node | None = None
    texts: set[tuple[str, ...]] = field(default_factory=set)  # of the root: the places whose strings may hold JSON


@dataclass
class Table:
    """An element with a table of its own. ``paths`` are the ways from the record to it; ``columns`` are its inlined
    scalars as (column name, steps, SQL type)."""

    label: str
    paths: list[tuple[str, ...]]
    columns: list[tuple[str, tuple[str, ...], str]]
    keyed: bool
    parents: dict[tuple[str, ...], str]
    texts: frozenset[tuple[str, ...]] = frozenset()


def _tokens(text: str) -> list[str]:
    return _TOKEN.findall(text)


def _read_type(tokens: list[str], at: int, label: str) -> tuple[Node, int]:
    """The node for the type text that starts at ``at``, and where the text goes on."""
    word = tokens[at].upper()
    node = Node(label)
    if word == "OBJECT":
        node.kinds.add("object")
        at += 1
        if at < len(tokens) and tokens[at] == "<":
            at += 1
            while tokens[at] != ">":
                name = tokens[at].strip("`").replace("``", "`")
                node.children[name], at = _read_type(tokens, at + 2, name)
                at += tokens[at] == ","
            at += 1
        return node, at
    if word == "ARRAY":
        node.kinds.add("array")
        node.item, at = _read_type(tokens, at + 2, label)
        return node, at + 1
    at += 1
    if at < len(tokens) and tokens[at] == "(":
        at = tokens.index(")", at) + 1
    if word == "VARIANT":
        node.kinds.add("mixed")
    elif word not in ("VOID", "NULL"):
        node.kinds.add("scalar")
        node.scalar = "DOUBLE" if word in ("DECIMAL", "FLOAT", "DOUBLE") else word
    return node, at


def read_schema(text: str | None, label: str = ROOT) -> Node:
    """The schema graph of a ``schema_of_variant`` text."""
    return _read_type(_tokens(text), 0, label)[0] if text else Node(label)


def _merge(into: Node, other: Node) -> None:
    into.kinds |= other.kinds
    into.scalar = other.scalar if into.scalar in (None, other.scalar) else into.scalar if other.scalar is None else "STRING"
    for name, child in other.children.items():
        _merge(into.children.setdefault(name, Node(name)), child)
    if other.item:
        into.item = into.item or Node(into.label)
        _merge(into.item, other.item)


def _shallow(value: Column) -> Column:
    """ARRAY or OBJECT by the value's outside alone, null for a scalar."""
    return F.when(_items(value).isNotNull(), "ARRAY").when(F.try_variant_get(value, "$", "map<string,variant>").isNotNull(), "OBJECT")


def opened(value: Column) -> Column:
    """``value``, or the JSON it holds where it is a string with a JSON array or object inside."""
    text = F.when(_shallow(value).isNull(), F.try_variant_get(value, "$", "string"))
    return F.coalesce(F.when(text.rlike(r"^\s*[\[{]"), F.try_parse_json(text)), value)


def _field(value: Column, name: str) -> Column:
    return F.try_variant_get(value, "$['" + name.replace("'", "\\'") + "']", "variant")


def _as_is(value: Column) -> Column:
    return value


def _into(step: str, look):
    return lambda e: F.struct(e["path"].alias("path"), _field(look(e["v"]), step).alias("v"))


def _items(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def entries(value: Column, steps: tuple[str, ...], texts: frozenset[tuple[str, ...]] = frozenset()) -> Column:
    """ARRAY<STRUCT<path ARRAY<INT>, v VARIANT>> of all values under ``value`` that ``steps`` lead to, with the array
    positions passed on the way. Strings at the places ``texts`` are opened."""
    here = F.array(F.struct(F.array().cast("array<int>").alias("path"), value.alias("v")))
    for k, step in enumerate(steps):
        look = opened if steps[:k] in texts else _as_is
        if step == ITEM:
            here = F.flatten(F.transform(here, _each(look)))
        else:
            here = F.filter(F.transform(here, _into(step, look)), lambda e: e["v"].isNotNull())
    return here


def _each(look):
    return lambda e: F.coalesce(
        F.transform(
            _items(look(e["v"])),
            lambda x, i: F.struct(F.concat(e["path"], F.array(i.cast("int"))).alias("path"), x.alias("v")),
        ),
        F.array().cast("array<struct<path:array<int>,v:variant>>"),
    )


def parsed(records: DataFrame, key: str, payload: str) -> DataFrame:
    """(rec, v): key and VARIANT of every record whose payload is valid JSON. Other columns are not read."""
    return records.select(F.col(key).alias("rec"), whole_json(F.col(payload)).alias("v")).where(F.col("v").isNotNull())


def infer_graph(base: DataFrame, embedded: tuple[str, ...] = ()) -> Node:
    """The schema graph of all records of ``parsed``; one aggregation per level of mixed places (two for most data).

    A text is looked into for JSON where its name is that of a list or object elsewhere, or one of ``embedded``. An empty table gives a
    graph with a root only. It ends when nothing mixed is left; every place is looked at once.
    """
    root = Node(ROOT)
    frontier: list[tuple[tuple[str, ...], Node]] = [((), root)]
    root.texts.add(())
    seen: set[tuple[str, ...]] = {()}
    while frontier:
        wanted = [F.transform(entries(F.col("v"), steps, frozenset(root.texts)), _numbered(n)) for n, (steps, _node) in enumerate(frontier)]
        kind = F.coalesce(_shallow(F.col("v")), F.regexp_extract(F.schema_of_variant("v"), r"^\w+", 0))
        rows = (
            base.select(F.explode(F.concat(*wanted)).alias("e"))
            .select("e.n", "e.v")
            .groupBy("n", kind.alias("kind"))
            .agg(F.schema_of_variant_agg("v").alias("ddl"))
            .collect()
        )
        for row in rows:
            steps, node = frontier[row["n"]]
            node.kinds.discard("mixed")
            _merge(node, read_schema(row["ddl"], node.label))
        every = list(_walk(root, ()))
        names = {node.label for _, node in every if node.children or node.item} | set(embedded)
        frontier = [
            (steps, node)
            for steps, node in every
            if steps not in seen and ("mixed" in node.kinds or node.scalar == "STRING" and node.label in names)
        ]
        if any("mixed" in node.kinds for steps, node in every if steps in seen):
            raise ValueError("a place stayed mixed after its kinds were told apart")
        seen |= {steps for steps, _ in frontier}
        root.texts |= {steps for steps, _ in frontier}
    return root


def _numbered(n: int):
    return lambda e: F.struct(F.lit(n).alias("n"), opened(e["v"]).alias("v"))


def _walk(node: Node, steps: tuple[str, ...]):
    """(steps, node) of the graph, the root first."""
    yield steps, node
    for name, child in node.children.items():
        yield from _walk(child, (*steps, name))
    if node.item:
        yield from _walk(node.item, (*steps, ITEM))


def plan_tables(root: Node, keyed: tuple[str, ...] = ()) -> dict[str, Table]:
    """The tables by shared inlining. ``keyed`` names objects whose field names are data; their fields become rows."""
    parents: dict[str, set[str]] = {}

    def look(node: Node, above: tuple[str, ...]) -> None:
        for child in node.children.values():
            parents.setdefault(child.label, set()).add(above[-1])
            if child.children or child.item:
                look(child, (*above, child.label))
        if node.item:
            look(node.item, above)

    look(root, (root.label,))
    tables: dict[str, Table] = {}

    def table(label: str, steps: tuple[str, ...], parent: str) -> Table:
        t = tables.setdefault(label, Table(label, [], [], label in keyed, {}, frozenset(root.texts)))
        if steps not in t.paths:
            t.paths.append(steps)
            t.parents[steps] = parent
        return t

    def visit(node: Node, steps: tuple[str, ...], t: Table, inner: tuple[str, ...]) -> None:
        if t.keyed and not inner:
            return
        if node.kinds & {"scalar"} and not inner:
            _column(t, "value", (), node.scalar or "STRING")
        for name, child in node.children.items():
            here, within = (*steps, name), (*inner, name)
            if child.item is not None or "array" in child.kinds:
                own = table(name, (*here, ITEM), t.label)
                if child.item is not None:
                    visit(child.item, (*here, ITEM), own, ())
            elif child.children and (name in keyed or len(parents[name]) > 1 or name in _labels(steps)):
                visit(child, here, table(name, here, t.label), ())
            elif child.children:
                visit(child, here, t, within)
            elif child.kinds:
                _column(t, ".".join(within), within, child.scalar or "STRING")
        if node.item is not None and steps[-1:] == (ITEM,):
            own = table(f"{t.label}_item", (*steps, ITEM), t.label)
            visit(node.item, (*steps, ITEM), own, ())

    visit(root, (), table(root.label, (), ""), ())
    return tables


def _labels(steps: tuple[str, ...]) -> set[str]:
    return {s for s in steps if s != ITEM}


def _column(t: Table, name: str, steps: tuple[str, ...], kind: str) -> None:
    for k, (n, s, old) in enumerate(t.columns):
        if n == name:
            t.columns[k] = (n, s, old if old == kind else "STRING")
            return
    t.columns.append((name, steps, kind))


def shred_table(base: DataFrame, t: Table) -> DataFrame:
    """One table of the records of ``parsed``: ``rec`` (the record's key), ``parent_table`` and ``parent_path`` (foreign key), ``path`` (with
    ``rec`` the row's key), ``pos``, then the inlined columns, or ``item_key`` and ``value`` for a keyed element.

    A keyed element gives one row per single value, named ``name`` or ``name.inner``; null and empty values give none. Records
    that are null or not valid JSON give no row. Repeated records give repeated rows, told apart by their key only.
    """
    rows = base.select("rec", F.explode(_gathered(t)).alias("e")).select("rec", "e.*")
    base_ = [F.col("rec"), "parent_table", "parent_path", "path", F.coalesce(F.try_element_at("path", F.lit(-1)), F.lit(0)).alias("pos")]
    if t.keyed:
        return rows.select(*base_, F.explode(_leaves(F.col("v"))).alias("leaf")).select(
            "rec", "parent_table", "parent_path", "path", "pos", "leaf.item_key", "leaf.value"
        )
    return rows.select(*base_, *[F.try_variant_get(F.col("v"), _json_path(s), k.lower()).alias(n) for n, s, k in t.columns])


def _gathered(t: Table) -> Column:
    """The rows of a table in one record, by all ways to it."""
    arrays = []
    for steps in t.paths:
        above = sum(s == ITEM for s in steps) - (steps[-1:] == (ITEM,))
        look = opened if steps in t.texts else _as_is
        arrays.append(F.transform(entries(F.col("v"), steps, t.texts), _keyed_row(t.parents[steps], above, look)))
    return F.concat(*arrays)


def _keyed_row(parent: str, above: int, look):
    return lambda e: F.struct(
        F.lit(parent).alias("parent_table"),
        F.slice(e["path"], 1, above).alias("parent_path"),
        e["path"].alias("path"),
        look(e["v"]).alias("v"),
    )


def _json_path(steps: tuple[str, ...]) -> str:
    return "$" + "".join("['" + s.replace("'", "\\'") + "']" for s in steps)


def _text(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def _leaves(v: Column) -> Column:
    """ARRAY<STRUCT<item_key, value>> of the single values of a keyed object, one level of inner objects opened."""
    outer = F.map_entries(F.try_variant_get(v, "$", "map<string,variant>"))

    def of(e: Column) -> Column:
        inner = F.try_variant_get(e["value"], "$", "map<string,variant>")
        return F.when(
            inner.isNotNull(),
            F.transform(
                F.map_entries(inner),
                lambda i: F.struct(F.concat(e["key"], F.lit("."), i["key"]).alias("item_key"), _text(i["value"]).alias("value")),
            ),
        ).otherwise(F.array(F.struct(e["key"].alias("item_key"), _text(e["value"]).alias("value"))))

    every = F.flatten(F.transform(outer, of))
    return F.filter(every, lambda x: x["value"].isNotNull() & ~F.trim(x["value"]).isin("", "[]", "{}"))


def shred(records: DataFrame, key: str, payload: str, keyed: tuple[str, ...] = (), embedded: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """All tables of ``records``, by name. See the module for the method, ``shred_table`` for their columns."""
    base = stored(parsed(records, key, payload), "parsed")
    return {n: shred_table(base, t) for n, t in plan_tables(infer_graph(base, embedded), keyed).items()}


def annotation_tables(records: DataFrame, key: str = "rec_id", payload: str = "payload") -> dict[str, DataFrame]:
    """All tables of annotation payloads; validation checks are keyed."""
    return shred(records, key, payload, ("checks",), PARTS)


def annotation_children(records: DataFrame, key: str = "rec_id", payload: str = "payload") -> DataFrame:
    """Child rows of annotation payloads: box, relation and check with the page they lie on (columns of ``p1_found``).

    Boxes and relations are named by their position; relations carry the two block positions they join, −1 where absent, null or
    not a whole number. Null payloads, payloads that are not JSON, empty tables and pages without children give no row. The three tables
    are emitted together, by one scan of the parsed records.
    """
    base = stored(parsed(records, key, payload), "parsed")
    tables = plan_tables(infer_graph(base, PARTS), keyed=("checks",))
    none = F.lit(-1)

    def row(child: str, r: Column, item: Column, source: Column = none, target: Column = none) -> Column:
        # The position in ``pages``, or 0 where the record itself is the page.
        page = F.coalesce(F.get(r["parent_path"], F.lit(0)), F.lit(0)).cast("int")
        return F.struct(page.alias("page_pos"), F.lit(child).alias("child"), item.alias("item_key"), source.alias("source_idx"), target.alias("target_idx"))

    def place(r: Column) -> Column:
        return F.coalesce(F.try_element_at(r["path"], F.lit(-1)), F.lit(0)).cast("string")

    def end(t: Table, name: str, r: Column) -> Column:
        kinds = [k for n, _, k in t.columns if n == name]
        return F.coalesce(F.try_variant_get(r["v"], _json_path((name,)), kinds[0].lower()).try_cast("int"), none) if kinds else none

    arrays = []
    if t := tables.get("block_boxes"):
        arrays.append(F.transform(_gathered(t), lambda r: row("box", r, place(r))))
    if t := tables.get("block_relations"):
        links = t
        arrays.append(F.transform(_gathered(t), lambda r: row("relation", r, place(r), end(links, "source", r), end(links, "target", r))))
    if t := tables.get("checks"):
        arrays.append(F.flatten(F.transform(_gathered(t), lambda r: F.transform(_leaves(r["v"]), lambda leaf: row("check", r, leaf["item_key"])))))
    if not arrays:
        spark = records.sparkSession
        return spark.createDataFrame([], "rec_id bigint, page_pos int, child string, item_key string, source_idx int, target_idx int")
    return base.select(F.col("rec").cast("bigint").alias("rec_id"), F.explode(F.concat(*arrays)).alias("e")).select("rec_id", "e.*")


def relation_blocks(records: DataFrame, key: str = "rec_id", payload: str = "payload") -> DataFrame:
    """Relations joined to the two boxes they name: the foreign keys of the relation table resolved inside its page.

    ``source_found`` and ``target_found`` tell whether the page has a box at that position. One row per relation.
    """
    kids = annotation_children(records, key, payload)
    boxes = (
        kids.where("child = 'box'").groupBy("rec_id", "page_pos").agg(F.count(F.lit(1)).cast("bigint").alias("n_boxes"))
    )
    inside = lambda c: (F.col(c) >= 0) & (F.col(c) < F.coalesce("n_boxes", F.lit(0)))
    return (
        kids.where("child = 'relation'")
        .join(boxes, ["rec_id", "page_pos"], "left")
        .select(
            "rec_id",
            "page_pos",
            F.col("item_key").cast("int").alias("relation_pos"),
            "source_idx",
            "target_idx",
            inside("source_idx").alias("source_found"),
            inside("target_idx").alias("target_found"),
        )
    )
