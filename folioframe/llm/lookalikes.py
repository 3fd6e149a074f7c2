"""Visually identical text with different characters: one form per text, by SQL run in DuckDB inside Arrow partitions.

The form keeps letter case, punctuation, accents and every ordinary space, tab and line break. It sets aside full-width, narrow,
presentation and mathematical forms, composed or split letters and accents, invisible characters, special spaces (each becomes one
ordinary space) and letters of another script that look like a letter of the text's script. Superscripts, circled and squared
forms look different and stay.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.operators.skew import heavy_join
from folioframe.session import stored

# Letters of other scripts, then the letters they look like, place by place.
CYRILLIC_FROM, CYRILLIC_TO = "АВЕЅІЈКМНОРСТХУЁЇаеѕіјорсухёїһԁԛԝӏ", "ABESIJKMHOPCTXYËÏaesijopcyxëïhdqwl"
GREEK_FROM, GREEK_TO = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονόϲϳ", "ABEZHIKMNOPTYXovócj"
ARABIC_FROM, ARABIC_TO = "يىكهةى٠١٢٣٧٨٩", "ییکہۃی۰۱۲۳۷۸۹"
LATIN_FROM, LATIN_TO = "ɑɡıꞌ", "agı'"
# Sequences that are drawn like one letter.
SEQUENCES = (
    ("ണ്\u200d", "ൺ"), ("ന്\u200d", "ൻ"), ("ര്\u200d", "ർ"), ("ല്\u200d", "ൽ"), ("ള്\u200d", "ൾ"), ("ക്\u200d", "ൿ"),
    ("ত্\u200d", "ৎ"), ("अा", "आ"), ("अो", "ओ"), ("अौ", "औ"), ("एे", "ऐ"), ("অা", "আ"), ("ਅਾ", "ਆ"), ("ਅੈ", "ਐ"), ("ਅੌ", "ਔ"),
    ("અા", "આ"), ("અો", "ઓ"), ("અૌ", "ઔ"), ("અે", "એ"), ("અૈ", "ઐ"), ("ଅା", "ଆ"), ("ഇൗ", "ഈ"), ("ഉൗ", "ഊ"), ("ഒാ", "ഓ"), ("ഒൗ", "ഔ"),
    ("எா", "ஏ"), ("ஒள", "ஔ"), ("ಉಾ", "ಊ"), ("ಒೌ", "ಔ"), ("ఒౌ", "ఔ"),
)
#: Kinds of Unicode compatibility decomposition whose result looks the same.
SAME_LOOK = ("<wide>", "<narrow>", "<isolated>", "<initial>", "<medial>", "<final>", "<font>")
#: Blocks in which compatibility forms are looked for.
FORM_BLOCKS = ((0xFB00, 0xFB06), (0xFB50, 0xFDFF), (0xFE70, 0xFEFC), (0xFF01, 0xFFE6), (0x1D400, 0x1D7FF))
#: White space other than the ordinary space, tab and line breaks.
SPACES = "               　"
INVISIBLE = "[­͏؜᠎​-‏‪-‮⁠-⁤⁦-⁯︀-️﻿]"


def compatibility_forms() -> tuple[str, str, list[tuple[str, str]]]:
    """(single forms, their plain characters, forms that stand for several characters), by rule from the Unicode data."""
    one_from, one_to, several = [], [], []
    for first, last in FORM_BLOCKS:
        for code in range(first, last + 1):
            ch = chr(code)
            tag, *parts = unicodedata.decomposition(ch).split() or [""]
            latin_ligature = tag == "<compat>" and code <= 0xFB06
            if tag not in SAME_LOOK and not latin_ligature:
                continue
            plain = unicodedata.normalize("NFKC", ch)
            if len(plain) == 1:
                one_from.append(ch)
                one_to.append(plain)
            elif latin_ligature or 0xFEF5 <= code <= 0xFEFC:
                several.append((ch, plain))
    return "".join(one_from), "".join(one_to), several


def not_composed() -> str:
    """A pattern, by rule from the Unicode data, that every text matches which NFC would change; others need no normalising.

    It has the characters NFC replaces, marks that may have to move, and neighbours that have a composed form.
    """
    classes: dict[int, set[str]] = {}
    changed, pairs = [], {}
    for code in (*range(0x80, 0xD800), *range(0xF900, 0x11E00), *range(0x1D100, 0x1D200), *range(0x2F800, 0x2FA20)):
        ch = chr(code)
        parts = unicodedata.decomposition(ch).split()
        rank = unicodedata.combining(ch)
        classes.setdefault(rank, set()).add(ch)
        if 0x1161 <= code < 0x11C3 or rank not in (0, 7, 9) or unicodedata.normalize("NFC", ch) != ch:
            changed.append(ch)
        elif len(parts) == 2 and not parts[0].startswith("<"):
            first, second = (chr(int(x, 16)) for x in parts)
            pairs.setdefault(second, set()).add(first)
    some = lambda chars: "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in _stretches(chars)) + "]"
    of_two = [some(firsts) + some({second}) for second, firsts in sorted(pairs.items()) if second not in changed]
    return "|".join([some(changed), some(classes[9]) + some(classes[7]), *of_two])


def _stretches(chars) -> list[tuple[int, int]]:
    """First and last codes of the runs of neighbouring characters."""
    out: list[list[int]] = []
    for code in sorted(map(ord, chars)):
        if out and code == out[-1][1] + 1:
            out[-1][1] = code
        else:
            out.append([code, code])
    return [(a, b) for a, b in out]


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def form_sql(column: str, soft_hyphens: bool = False) -> str:
    """The SQL expression of a text's form; with ``soft_hyphens`` these stay, for readers of broken lines."""
    wide_from, wide_to, several = compatibility_forms()
    source = SPACES + wide_from + CYRILLIC_FROM + GREEK_FROM + ARABIC_FROM + LATIN_FROM
    target = " " * len(SPACES) + wide_to + CYRILLIC_TO + GREEK_TO + ARABIC_TO + LATIN_TO
    unseen = INVISIBLE.replace("\xad", "") if soft_hyphens else INVISIBLE
    inner = column
    sequences = (*SEQUENCES, *several)
    for found, plain in sequences:
        inner = f"replace({inner}, {_quoted(found)}, {_quoted(plain)})"
    any_sequence = _quoted("|".join(found for found, _ in sequences))
    any_other = _quoted("[" + unseen[1:-1] + source + "]")
    # Most texts need none of the steps; one scan for each decides.
    joined = f"CASE WHEN regexp_matches({column}, {any_sequence}) THEN {inner} ELSE {column} END"
    bare = f"nfc_normalize(regexp_replace({joined}, {_quoted(unseen)}, '', 'g'))"
    full = f"nfc_normalize(translate({bare}, {_quoted(source)}, {_quoted(target)}))"
    plain = f"CASE WHEN regexp_matches({joined}, {_quoted(not_composed())}) THEN nfc_normalize({joined}) ELSE {joined} END"
    return f"CASE WHEN regexp_matches({column}, {any_other}) THEN {full} ELSE {plain} END"


def _in_duckdb(select: str):
    """An Arrow function that runs ``select`` over every batch, registered as ``batch``, in one DuckDB connection."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        con = duckdb.connect(config={"threads": 1})
        try:
            for batch in batches:
                con.register("batch", pa.Table.from_batches([batch]))
                yield from con.sql(select).to_arrow_table().to_batches()
                con.unregister("batch")
        finally:
            con.close()

    return run


def forms(texts: DataFrame) -> DataFrame:
    """(src, id, form) of ``texts`` (src, id, text). A null text has a null form, an empty text an empty one."""
    sql = f"SELECT src, id, {form_sql('text')} AS form FROM batch"
    rows = texts.select("src", F.col("id").cast("bigint").alias("id"), "text")
    return rows.mapInArrow(_in_duckdb(sql), "src string, id bigint, form string")


def digests(texts: DataFrame) -> DataFrame:
    """(src, id, form, raw): 128-bit digests of a text's form and of the text as it stands; null texts are left out."""
    sql = f"SELECT src, id, md5({form_sql('text')}) AS form, md5(text) AS raw FROM batch"
    return (
        texts.where(F.col("text").isNotNull())
        .select("src", F.col("id").cast("bigint").alias("id"), "text")
        .mapInArrow(_in_duckdb(sql), "src string, id bigint, form string, raw string")
    )


def groups(texts: DataFrame) -> DataFrame:
    """(src, id, class_id, n_ids, n_spellings, n_alike): every id whose text has a look-alike of another spelling; one row per id and spelling.

    ``class_id`` is the smallest id of the class; ``n_ids`` and ``n_spellings`` are its ids and different texts; ``n_alike`` is the number of
    pairs this text makes with ids of other spellings. Ids are counted per spelling first, so a hot spelling or class costs no task more
    than its spellings; null texts are in no class.
    """
    rows = stored(digests(texts).distinct(), "forms")
    spellings = rows.groupBy("src", "form", "raw").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least"))
    classes = (
        spellings.groupBy("src", "form")
        .agg(F.min("least").alias("class_id"), F.sum("n").alias("n_ids"), F.count(F.lit(1)).alias("n_spellings"))
        .where("n_spellings > 1")
    )
    lookup = stored(spellings.join(classes, ["src", "form"]).drop("least").withColumn("own", F.col("n")), "spellings")
    joined = heavy_join(rows, lookup, ["src", "form", "raw"], "n", rows.count())
    return joined.select("src", "id", "class_id", "n_ids", "n_spellings", (F.col("n_ids") - F.col("own")).alias("n_alike"))


def lookalike_pairs(texts: DataFrame) -> DataFrame:
    """(src, id_a, id_b): pairs of different ids, id_a < id_b, whose texts differ but have the same form; each pair once.

    Only digests are shuffled. Forms under which a single text occurs are dropped before anything is joined. Spellings are paired
    with spellings first, and only such pairs are opened to the ids that have them.
    """
    rows = stored(digests(texts).distinct(), "forms")
    spellings = rows.groupBy("src", "form", "raw").agg(F.count(F.lit(1)).alias("n"))
    several = spellings.groupBy("src", "form").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("src", "form")
    spelt = stored(spellings.join(several, ["src", "form"]), "spellings")
    total = rows.count()
    members = stored(heavy_join(rows, spelt, ["src", "form", "raw"], "n", total), "members")
    a = spelt.select("src", "form", F.col("raw").alias("raw_a"))
    b = spelt.select("src", "form", F.col("raw").alias("raw_b"))
    couples = a.join(b, ["src", "form"]).where("raw_a < raw_b")
    left = members.select("src", "form", F.col("raw").alias("raw_a"), F.col("id").alias("x"))
    right = members.select("src", "form", F.col("raw").alias("raw_b"), F.col("id").alias("y"))
    return (
        couples.join(left, ["src", "form", "raw_a"])
        .join(right, ["src", "form", "raw_b"])
        .where("x <> y")
        .select("src", F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))
        .distinct()
    )
