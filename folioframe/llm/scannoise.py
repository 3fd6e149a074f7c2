"""Noise in the text of scanned pages: where it sits, and pages and blocks as readable paragraphs.

* Misread characters: words are grouped by a skeleton in which glyphs that scanners confuse are one. In each group the frequent form
  that the neighbouring words support is the reading; rare members of the group are misread. Marks inside a word are noise as well.
* Broken words: a line that ends in a hyphen and a word that goes on in the next line, unless the word has that hyphen elsewhere.
* Running titles: digits, case and punctuation are masked; a masked line that stands at the edge of several near pages of a file, or at
  the edge with the number of its page, is a header. Far pages of a file count only for a title that mostly stands on near ones, so
  headings that recur by chance are no headers, however large the file.
* Page numbers: a line at the edge that holds only a number, in digits of any script or Roman, that runs with the pages of the file.

One pass of DuckDB inside Arrow partitions reads the texts: it gives their words, what stands at their edges, broken lines, and the words
counted per batch, so that the tables that follow are small. Later passes over the words look for misread words and for pairs of
neighbours through filters of a fixed number of places; what passes a filter is joined exactly. Windows never span more than one text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioframe.llm.lookalikes import _quoted, form_sql
from folioframe.operators.skew import heavy_join
from folioframe.session import stored

# Glyphs that scanners confuse. Each group is read as its first member.
GLYPHS = (
    "ec", "o0", "tf", "s5", "l1i", "hb8", "g9q",
    "रस", "पष", "बव", "थय", "भम", "घध", "डड़", "ङड",
    "নল", "বৰর", "ষয", "থখ", "ণন", "ৱর", "পগ", "মস", "ঘয",
    "ਸਮ", "ਪਧ", "ਵਬ", "ਖਬ", "ਬਥ", "ਘਧ", "વત", "નત", "પય", "ઘધ", "પଷ", "ପଷ", "ବର", "ଦଧ", "ଘପ",
    "ரற", "பய", "நத", "ணன", "பவ", "పవ", "నస", "మవ", "ధద", "దధ", "ದಧ", "ನಸ", "ವಪ", "ಮವ", "ಪಷ",
    "നത", "മഥ", "പവ", "ധഡ", "വപ", "رز", "تث", "دذ", "بپ", "جچ", "نت", "فق", "حخ",
)
# Letter groups that look like one letter.
GROUPS = (("cl", "d"), ("rn", "m"), ("ii", "u"))
#: Marks that a scan puts inside words.
SPECKS = r"[|^~*]"
#: A reading must occur this often, and this many times as often as the misread form.
MIN_READING, RATIO = 5, 8
#: Words up to this length need a neighbour that supports the reading; longer ones do without where the reading is so many times as frequent.
SHORT, ALONE = 3, 16
#: Places of the filters for misread words and for pairs.
PLACES = 1 << 22
#: Longest running title in words.
TITLE_WORDS = 7
#: Pages by whose numbers a title must recur (longer than an ordinary file); share of its pages from which it holds for far pages too.
NEAR, MOSTLY = 128, 0.5
HYPHENS = "\\-\u2010\u00ad\u00ac"
_CLOSED = r"[.!?\x{0964}\x{06d4}\x{061f};:,]$"
_LETTER = r"[\p{L}\p{M}]"
_WORD = r"[\p{L}\p{M}\p{N}'\x{2019}|^~*\x{200c}\x{200d}]+(?:[\-][\p{L}\p{M}\p{N}'\x{2019}|^~*\x{200c}\x{200d}]+)*"
_ROMAN = r"^[ivxlc]{1,7}$"
#: Stands in the words of a text for a part of a broken word.
_PART = "\ue000"


def _classes() -> tuple[str, str]:
    """``GLYPHS`` as the two sides of a translation: every member of connected groups to one of them."""
    first: dict[str, str] = {}

    def root(ch: str) -> str:
        while first.get(ch, ch) != ch:
            ch = first[ch]
        return ch

    for group in GLYPHS:
        for ch in group[1:]:
            a, b = root(group[0]), root(ch)
            if a != b:
                first[b] = a
    moved = sorted(ch for ch in first if root(ch) != ch)
    return "".join(moved), "".join(root(ch) for ch in moved)


def skeleton(word: Column, groups: bool = True) -> Column:
    """The form of a lower-case word in which confusable glyphs, and with ``groups`` letter groups, are one; specks vanish."""
    moved, root = _classes()
    out = word
    for several, one in GROUPS if groups else ():
        out = F.replace(out, F.lit(several), F.lit(one))
    return F.translate(out, moved + "|^~*", root)


def _bones(word: Column) -> Column:
    """The skeletons of a word: without letter groups, and with them where it has any."""
    held = word.rlike("|".join(several for several, _ in GROUPS))
    plain = skeleton(word, groups=False)
    return F.explode(F.when(held, F.array(plain, skeleton(word))).otherwise(F.array(plain))).alias("bone")


def _roman(text: Column) -> Column:
    """The value of a Roman numeral."""
    worth = F.transform(F.split(text, ""), lambda c: F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in (("i", 1), ("v", 5), ("x", 10), ("l", 50), ("c", 100)) for x in kv]), c), F.lit(0)))
    signed = F.transform(worth, lambda v, i: F.when(v < F.coalesce(F.get(worth, i + 1), F.lit(0)), -v).otherwise(v))
    return F.aggregate(signed, F.lit(0), lambda a, v: a + v)


#: What the pass over the texts gives, in rows of several kinds (``part``): ``text`` (the words of a text), ``word`` (words counted in a
#: batch), ``edge`` (lines at an edge that may be titles or numbers), ``cut`` (lines that end in a hyphen), ``mark`` (lines with marks inside words).
COLUMNS = {
    "part": "string", "src": "string", "row_id": "bigint", "load": "string", "time": "string", "page_id": "bigint", "file": "string", "page_no": "int", "idx": "int",
    "labelled": "boolean", "line_no": "int", "tokens": "string", "form": "string", "word": "string", "n": "bigint", "first": "string", "second": "string",
    "outer": "boolean", "title": "string", "bare": "string", "n_words": "int", "value": "int", "roman": "boolean", "only_number": "boolean",
    "numbered": "boolean", "closed": "boolean", "other": "boolean",
}
_KEYS = ("src", "row_id", "load", "page_id", "file", "page_no", "idx", "labelled")


def _part(name: str, rest: str, keys: tuple[str, ...] = _KEYS, **columns: str) -> str:
    """The SELECT of one kind of rows: every other column is null."""
    given = {"part": _quoted(name)} | {k: k for k in keys} | columns
    kinds = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN"}
    return "SELECT " + ", ".join(f"CAST({given.get(c, 'NULL')} AS {kinds[k]}) AS {c}" for c, k in COLUMNS.items()) + f" FROM {rest}"


def _reading_sql(with_text: bool) -> tuple[list[str], list[str]]:
    """The statements that make tables ``f`` and ``w`` of a batch, and those that read the kinds of rows off them.

    In the words of a text, a line break stands as a word of its own, and both parts of a broken word begin with ``_PART``.
    """
    letter, inside, joiner = _LETTER, _WORD[1 : _WORD.index("]")], r"[^\S\n]*\n[^\S\n]*"
    halves = _quoted(f"([{inside}\\-]*{letter})[{HYPHENS}]{joiner}({letter})")
    marked, closed = _quoted(_LETTER + SPECKS + _LETTER), _quoted(_CLOSED)
    apart = f"CASE WHEN broken THEN regexp_replace(lower(form), {halves}, '{_PART}\\1\n{_PART}\\2', 'g') ELSE lower(form) END"
    # A hyphen stays only where it joins two words of a line.
    between = f"[^{inside}{_PART}{chr(10)}]{{2,}}|[^{inside}{_PART}{chr(10)}-]"
    spaced = f"regexp_replace(replace({apart}, chr(10), ' ' || chr(10) || ' '), {_quoted(between)}, ' ', 'g')"
    tables = [
        f"""CREATE OR REPLACE TEMP TABLE f AS
            SELECT *, string_split(form, chr(10)) AS ls, regexp_matches(form, {_quoted(f"{letter}[{HYPHENS}]{joiner}{letter}")}) AS broken FROM (
                SELECT * EXCLUDE (text), {form_sql("text", soft_hyphens=True)} AS form FROM batch)""",
        f"""CREATE OR REPLACE TEMP TABLE w AS SELECT * EXCLUDE (form, ls), {"form" if with_text else "NULL"} AS form,
            trim({spaced}, ' -') AS tokens FROM f""",
    ]
    moved, root = _classes()
    groups = "bare"
    for several, one in GROUPS:
        groups = f"replace({groups}, {_quoted(several)}, {_quoted(one)})"
    digits = "".join(chr(z + k) for z in (0x0966, 0x09E6, 0x0A66, 0x0AE6, 0x0B66, 0x0BE6, 0x0C66, 0x0CE6, 0x0D66, 0x06F0, 0x0660) for k in range(10))
    near = f"""SELECT {", ".join(_KEYS)}, top, bottom, e.i AS i, e.line AS line FROM (
        SELECT {", ".join(_KEYS)}, fulls[1] AS top, fulls[-1] AS bottom,
            unnest(list_transform(list_distinct(list_concat(fulls[:2], fulls[-2:])), lambda i: {{'i': i, 'line': ls[i]}})) AS e
        FROM (SELECT *, list_filter(range(1, len(ls) + 1), lambda i: regexp_matches(ls[i], '\\S')) AS fulls FROM f)
        WHERE len(fulls) > 0 AND (src = 'page' OR len(fulls) = 1))"""
    # Lines of too many words are left out before anything else is asked of them.
    short = f"""SELECT * FROM (SELECT *, CASE WHEN bare = '' THEN 0 ELSE len(string_split(bare, ' ')) END AS letters
        FROM (SELECT *, trim(regexp_replace(lower(line), '[^\\p{{L}}\\p{{M}}]+', ' ', 'g'), ' ') AS bare FROM ({near})))
        WHERE letters <= {TITLE_WORDS}"""
    edge = f"""(SELECT *, regexp_extract_all(plain, '\\d+') AS numbers,
            regexp_matches(bare, {_quoted(_ROMAN)}) AND NOT regexp_matches(plain, '\\d') AND regexp_matches(plain, '^[\\P{{L}}]*[ivxlc]+[\\P{{L}}]*$') AS is_roman,
            regexp_matches(plain, '^[^\\p{{L}}\\p{{N}}|=]*(?:\\p{{L}}[\\p{{L}}\\p{{M}}.]*[^\\p{{L}}\\p{{N}}|=]*)?\\d+[^\\p{{L}}\\p{{N}}|=]*$') AS is_number,
            regexp_matches(line, {closed}) AS is_closed
        FROM (SELECT *, translate(lower(trim(line, ' ')), '{digits}', '{"0123456789" * 11}') AS plain FROM ({short})))
        WHERE is_roman OR is_number OR NOT is_closed"""
    cut = f"""(SELECT *, replace(regexp_extract(ts[i], ' ?([^ ]*{_PART}[^ ]*) *$', 1), '{_PART}', '') AS a,
            replace(regexp_extract(ts[i + 1], '^ *({_PART}[^ ]*)', 1), '{_PART}', '') AS b
        FROM (SELECT *, unnest(range(1, len(ts))) AS i FROM (SELECT *, string_split(tokens, chr(10)) AS ts FROM w WHERE broken)))
        WHERE a <> '' AND b <> ''"""
    mark = f"(SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM f WHERE regexp_matches(form, {marked})) WHERE regexp_matches(ls[i], {marked})"
    return tables, [
        _part("text", "w", time="time", tokens="tokens", form="form"),
        _part("word", f"(SELECT unnest(string_split(tokens, ' ')) AS word FROM w) GROUP BY word HAVING NOT contains(word, '{_PART}') AND regexp_matches(word, '\\p{{L}}')", (), word="word", n="count(*)"),
        _part("mark", mark, line_no="i - 1"),
        _part("cut", cut, line_no="i - 1", first="ltrim(a, '-')", second="rtrim(b, '-')"),
        _part(
            "edge", edge, line_no="i - 1", outer="i IN (top, bottom)", title=f"translate({groups}, {_quoted(moved + '|^~*')}, {_quoted(root)})",
            bare="CASE WHEN is_roman THEN bare END", n_words="CASE WHEN is_roman THEN 0 ELSE letters END",
            value="CASE WHEN len(numbers) = 1 THEN TRY_CAST(numbers[1] AS INTEGER) END", roman="is_roman", only_number="is_number", closed="is_closed",
            numbered="regexp_matches(plain, '(?:^\\d+\\s{2,}\\D+$)|(?:^\\D+(?:\\s{2,}|\\s*[\\x{2014}\\x{2013}|]\\s*)\\d+$)')",
            other="contains(line, '=') OR regexp_matches(plain, '^\\s*\\p{L}[\\p{L}\\p{M}]*\\s*\\d+\\s*[.:]')",
        ),
    ]


def lines(pages: DataFrame, blocks: DataFrame, with_text: bool = False) -> DataFrame:
    """``COLUMNS`` of all texts, read in one pass; ``with_text`` adds their form. Nothing is shuffled.

    Null texts have no row. A text delivered more than once is read each time, with its time of loading as text (``load``); results are made distinct.
    With ``with_text``, ``load`` is a hash, so that different texts of one time stay apart; the time is in ``time``.
    """

    def column(rows: DataFrame, name: str, kind: str) -> Column:
        return (F.col(name) if name in rows.columns else F.lit(None)).cast(kind)

    def load(rows: DataFrame, text: str) -> list[Column]:
        time = column(rows, "loaded_at", "string")
        return [(F.hex(F.hash(time, F.col(text))) if with_text else time).alias("load"), (time if with_text else F.lit(None).cast("string")).alias("time")]

    own = pages.select(
        F.lit("page").alias("src"), F.col("page_id").cast("bigint").alias("row_id"), *load(pages, "full_text"),
        F.col("page_id").cast("bigint").alias("page_id"), "file", F.col("page_no").cast("int").alias("page_no"), F.lit(None).cast("int").alias("idx"),
        F.lit(False).alias("labelled"), F.col("full_text").alias("text"),
    )
    parts = blocks.select(
        F.lit("block").alias("src"), F.col("block_id").cast("bigint").alias("row_id"), *load(blocks, "text"),
        F.col("page_id").cast("bigint").alias("page_id"), F.lit(None).cast("string").alias("file"), F.lit(None).cast("int").alias("page_no"),
        F.col("idx").cast("int").alias("idx"), F.coalesce(F.col("class_label").isin("Page-header", "Page-footer"), F.lit(False)).alias("labelled"), "text",
    )
    tables, reads = _reading_sql(with_text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        con = duckdb.connect(config={"threads": 1})
        try:
            for batch in batches:
                con.register("batch", pa.Table.from_batches([batch]))
                for statement in tables:
                    con.execute(statement)
                for read in reads:
                    yield from con.sql(read).to_arrow_table().to_batches()
                con.unregister("batch")
        finally:
            con.close()

    return own.unionByName(parts).where("text is not null").mapInArrow(run, ", ".join(f"`{c}` {k}" for c, k in COLUMNS.items()))


def _kind(rows: DataFrame, part: str, *columns: str | Column) -> DataFrame:
    return rows.where(F.col("part") == part).select(*columns)


def vocabulary(rows: DataFrame) -> DataFrame:
    """(word, n) of whole words with a letter; parts of broken words are not words."""
    return _kind(rows, "word", "word", "n").groupBy("word").agg(F.sum("n").alias("n"))


def readings(vocab: DataFrame) -> DataFrame:
    """(word, reading, n, times): the misread words of a vocabulary with the frequent word of the same skeleton and the counts of both.

    A word with specks inside needs no other evidence than that it is a known word without them.
    """
    keyed = stored(vocab.select("word", "n", _bones(F.col("word"))), "skeletons")
    best = (
        keyed.where((F.col("n") >= MIN_READING) & ~F.col("word").rlike(SPECKS))
        .groupBy("bone")
        .agg(F.max_by("word", F.struct("n", "word")).alias("reading"), F.max("n").alias("times"))
    )
    return (
        keyed.join(best, "bone")
        .where((F.col("word") != F.col("reading")) & (F.col("times") >= F.col("n") * RATIO))
        .where(F.length("reading") >= 2)
        .groupBy("word", "n")
        .agg(F.max_by("reading", F.struct("times", "reading")).alias("reading"), F.max("times").alias("times"))
        .select("word", "reading", "n", "times")
    )


def _hashes(con, texts: pa.Array) -> np.ndarray:
    """Hashes of texts, the same in every process."""
    con.register("hashed", pa.table({"t": texts}))
    out = con.sql("SELECT hash(t) AS h FROM hashed").fetchnumpy()["h"]
    con.unregister("hashed")
    return np.asarray(out, np.uint64)


def _pair_places(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of pairs in a filter."""
    return ((a * np.uint64(0x9E3779B97F4A7C15) + b) >> np.uint64(7)) % np.uint64(PLACES)


def _filter(rows: DataFrame, *columns: str) -> np.ndarray:
    """``PLACES`` bits, packed, in which the places of the words (or pairs) of ``rows`` are set: half a megabyte for any number of rows."""
    paired = len(columns) == 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        con = duckdb.connect(config={"threads": 1})
        bits = np.zeros(PLACES // 8, np.uint8)
        for batch in batches:
            h = [_hashes(con, c) for c in batch.columns]
            at = _pair_places(*h) if paired else h[0] % np.uint64(PLACES)
            np.bitwise_or.at(bits, at >> np.uint64(3), np.left_shift(1, at & np.uint64(7)).astype(np.uint8))
        con.close()
        at = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(bits[at].astype(np.int16))], ["at", "bits"])

    set_ = rows.select(*columns).mapInArrow(run, "at int, bits smallint").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(PLACES // 8, np.uint8)
    out[set_["at"].to_numpy()] = set_["bits"].to_numpy()
    return out


class _Words:
    """The words of a batch of texts (column ``tokens``) side by side, with where they stand."""

    def __init__(self, con, tokens: pa.Array):
        split = pc.split_pattern(tokens, " ")
        self.words, self.starts = split.values, split.offsets.to_numpy()
        self.hashes = _hashes(con, self.words)
        self.breaks = self.hashes == _hashes(con, pa.array(["\n"]))[0]
        self.solid = ~(self.breaks | pc.match_substring(self.words, _PART).to_numpy(zero_copy_only=False))
        self.lines = np.cumsum(self.breaks)

    def owner(self, at: np.ndarray) -> np.ndarray:
        """The text that each place is in."""
        return np.searchsorted(self.starts, at, "right") - 1

    def line(self, at: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """The line of each place in its text; texts begin with a word or a break."""
        first = self.starts[owner]
        return self.lines[at] - (self.lines[first] - self.breaks[first])

    def beside(self, at: np.ndarray, owner: np.ndarray, step: int) -> pa.Array:
        """The neighbours on the line, null where there is none."""
        there = at + step
        inside = (there >= self.starts[owner]) & (there < self.starts[owner + 1])
        inside &= self.solid[np.clip(there, 0, len(self.solid) - 1)]
        return self.words.take(pa.array(there, mask=~inside))


def _passed(rows: DataFrame, bits: np.ndarray, schema: str, read: Callable) -> DataFrame:
    """``read(batch, words, filter)`` over the texts of ``rows``; the filter tells of places whether they are set."""
    shared = rows.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        con = duckdb.connect(config={"threads": 1})
        held = shared.value
        known = lambda at: (held[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        for batch in batches:
            if batch.num_rows:
                yield from read(batch, _Words(con, batch.column(batch.num_columns - 1)), known)
        con.close()

    return _kind(rows, "text", "src", "row_id", "load", "tokens").mapInArrow(run, schema)


def _likely(rows: DataFrame, wrong: DataFrame) -> DataFrame:
    """(src, row_id, load, line_no, word, before, after): the words of all texts that may be among ``wrong``, with their neighbours."""

    def read(batch: pa.RecordBatch, w: _Words, known) -> Iterator[pa.RecordBatch]:
        at = np.flatnonzero(known(w.hashes % np.uint64(PLACES)) & w.solid)
        owner = w.owner(at)
        keys = [c.take(pa.array(owner)) for c in batch.columns[:3]]
        line = pa.array(w.line(at, owner).astype(np.int32))
        columns = [*keys, line, w.words.take(pa.array(at)), w.beside(at, owner, -1), w.beside(at, owner, 1)]
        yield pa.RecordBatch.from_arrays(columns, ["src", "row_id", "load", "line_no", "word", "before", "after"])

    schema = "src string, row_id bigint, load string, line_no int, word string, before string, after string"
    return _passed(rows, _filter(wrong, "word"), schema, read)


def _neighbours(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(x, y, k): how often the ``wanted`` pairs (x, y), and by chance others, stand side by side in all texts; counted per batch first."""

    def read(batch: pa.RecordBatch, w: _Words, known) -> Iterator[pa.RecordBatch]:
        at = np.flatnonzero(w.solid[:-1] & w.solid[1:])
        at = at[w.owner(at) == w.owner(at + 1)]
        at = at[known(_pair_places(w.hashes[at], w.hashes[at + 1]))]
        pairs = pa.table({"x": w.words.take(pa.array(at)), "y": w.words.take(pa.array(at + 1))})
        yield from pairs.group_by(["x", "y"]).aggregate([([], "count_all")]).select(["x", "y", "count_all"]).rename_columns(["x", "y", "k"]).to_batches()

    counted = _passed(rows, _filter(wanted, "x", "y"), "x string, y string, k bigint", read)
    return counted.groupBy("x", "y").agg(F.sum("k").alias("k"))


def _spotted(rows: DataFrame, vocab: DataFrame) -> DataFrame:
    """(src, row_id, load, line_no, word, reading): misread words where they stand.

    The reading must be supported by a neighbour, with which it stands elsewhere too. A longer word goes without where its reading is
    ``ALONE`` times as frequent.
    """
    wrong = stored(readings(vocab), "readings")
    total = vocab.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    found = stored(heavy_join(stored(_likely(rows, wrong), "likely_words"), wrong.withColumn("count", F.col("n")), ["word"], "count", total), "misread")
    open_ = found.where((F.length("word") <= SHORT) | (F.col("times") < F.col("n") * ALONE))
    before = open_.select(F.col("before").alias("x"), F.col("reading").alias("y"))
    after = open_.select(F.col("reading").alias("x"), F.col("after").alias("y"))
    wanted = stored(before.unionByName(after).where("x is not null and y is not null").distinct(), "pairs")
    seen = _neighbours(rows, wanted).where("k > 1").select("x", "y")
    seen = stored(seen.join(wanted, ["x", "y"], "left_semi"), "seen")
    by_left = open_.join(seen, (F.col("before") == F.col("x")) & (F.col("reading") == F.col("y")), "left_semi")
    by_right = open_.join(seen, (F.col("reading") == F.col("x")) & (F.col("after") == F.col("y")), "left_semi")
    alone = found.where((F.length("word") > SHORT) & (F.col("times") >= F.col("n") * ALONE))
    return alone.unionByName(by_left).unionByName(by_right).select("src", "row_id", "load", "line_no", "word", "reading")


def _breaks(rows: DataFrame, vocab: DataFrame) -> DataFrame:
    """(src, row_id, load, line_no, joined, compound): lines that end inside a word; ``compound`` where the hyphen belongs to the word."""
    cut = _kind(rows, "cut", "src", "row_id", "load", "line_no", "first", "second")
    cut = cut.select(
        "src", "row_id", "load", "line_no",
        F.concat("first", "second").alias("joined"), F.concat_ws("-", "first", F.regexp_extract("second", "^[^-]+", 0)).alias("dashed"),
    )
    dashed = vocab.where(F.col("word").contains("-")).select(F.col("word").alias("dashed"), F.col("n").alias("n_dashed"))
    known = vocab.select(F.col("word").alias("joined"), F.col("n").alias("n_joined"))
    return (
        cut.join(dashed, "dashed", "left")
        .join(known, "joined", "left")
        .withColumn("compound", F.coalesce("n_dashed", F.lit(0)) > F.coalesce("n_joined", F.lit(0)))
        .drop("n_dashed", "n_joined", "dashed")
    )


def edges(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """The lines at the edges of pages that may be titles or numbers, with their masked title, the number they hold and what else they hold.

    ``edge`` is 1 for the first and the last non-blank line of a page and 2 for the lines next to these; for blocks of one line, it goes
    by the place of the block in its page.
    """
    lines_ = rows.where("part = 'edge'").select(*COLUMNS).drop("part", "time", "tokens", "form", "word", "n", "first", "second")
    place = pages.groupBy("page_id").agg(F.min(F.struct("file", F.col("page_no").cast("int").alias("page_no"))).alias("p"))
    ends = _kind(rows, "text", "src", "page_id", "idx").where("src = 'block'").groupBy("page_id").agg(F.min("idx").alias("top"), F.max("idx").alias("bottom"))
    in_blocks = (
        lines_.where("src = 'block'")
        .drop("file", "page_no")
        .join(ends, "page_id", "left")
        .withColumn("edge", F.least(F.col("idx") - F.col("top"), F.col("bottom") - F.col("idx")) + 1)
        .where("edge <= 2")
        .join(place.select("page_id", "p.file", "p.page_no"), "page_id", "left")
        .drop("top", "bottom")
    )
    both = lines_.where("src = 'page'").withColumn("edge", F.when(F.col("outer"), 1).otherwise(2)).unionByName(in_blocks).drop("idx", "outer")
    value = F.coalesce("value", F.when(F.col("roman"), _roman(F.col("bare"))))
    return both.withColumn("file", F.coalesce("file", F.lit(""))).withColumn("value", value).withColumn("shift", value - F.col("page_no")).drop("bare")


def _recurring(likely: DataFrame) -> DataFrame:
    """(page_id, title): edge lines whose title stands on two pages of a stretch of ``NEAR`` page numbers, or is mostly found so in its
    file.

    Stretches overlap by half, so a page is in two of them. Pages without a number stand by their id. No group is larger than a stretch.
    """
    number = F.coalesce("page_no", "page_id")
    stretches = F.array(F.floor(number / NEAR) * 2, F.floor((number + NEAR // 2) / NEAR) * 2 + 1)
    own = F.when(F.col("src") == "page", F.col("page_id"))
    spots = (
        likely.where("file <> ''")
        .select("file", "title", "page_id", own.alias("own"), F.explode(stretches).alias("stretch"))
        .groupBy("file", "title", "stretch")
        .agg(F.size(F.collect_set("own")).alias("n"), F.collect_set("page_id").alias("ids"))
    )
    spots = stored(spots, "spots")
    near = F.sum(F.when(F.col("n") >= 2, F.col("n")).otherwise(0))
    mostly = spots.groupBy("file", "title").agg(near.alias("near"), F.sum("n").alias("all")).where(f"near > 0 and near >= {MOSTLY} * all")
    known = spots.join(mostly.select("file", "title", F.lit(True).alias("known")), ["file", "title"], "left").where("n >= 2 or known")
    return known.select(F.explode("ids").alias("page_id"), "title")


def running_titles(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """(src, row_id, load, line_no, kind): headers and page numbers."""
    edge = stored(edges(rows, pages), "edges")
    shifts = (
        edge.where("src = 'page' and shift is not null and (only_number or roman)")
        .groupBy("file", "shift")
        .agg(F.countDistinct("page_id").alias("k"))
    )
    usual = shifts.groupBy("file").agg(F.max_by("shift", F.struct("k", -F.abs("shift"))).alias("usual"), F.max("k").alias("support"))
    files = stored(edge.groupBy("file").agg(F.count(F.lit(1)).alias("lines")).join(usual, "file", "left"), "files")
    likely = edge.where(f"n_words between 1 and {TITLE_WORDS} and not (closed or only_number or roman or other) and title <> ''")
    titles = _recurring(likely).unionByName(likely.where("labelled").select("page_id", "title")).distinct()
    total = files.agg(F.coalesce(F.sum("lines"), F.lit(0))).first()[0]
    judged = heavy_join(edge, files, ["file"], "lines", total).join(titles.withColumn("titled", F.lit(True)), ["page_id", "title"], "left")
    in_step = F.coalesce(F.col("shift") == F.col("usual"), F.lit(False))
    free = F.coalesce("support", F.lit(0)) < 2
    number = (F.col("only_number") & (F.col("n_words") <= 1) | F.col("roman")) & (
        # Front matter is counted on its own: in Roman numerals, or from the first page on.
        in_step | free | (F.col("edge") == 1) & (F.col("roman") | (F.col("shift") == 0))
    )
    header = (
        ~F.col("closed")
        & ~F.col("only_number")
        & ~F.col("roman")
        & ~F.col("other")
        & F.col("n_words").between(1, TITLE_WORDS)
        & ((F.col("numbered") & (in_step | free)) | F.coalesce("titled", F.lit(False)))
    )
    judged = judged.withColumns({"number": F.coalesce(number, F.lit(False)), "header": F.coalesce(header, F.lit(False))})
    # The second line from an edge counts where the line outside it is the number of the page, or the running title.
    outside = judged.where("edge = 1 and (number or header)").select("page_id", F.col("number").alias("number_outside")).distinct()
    beside = outside.groupBy("page_id").agg(F.max("number_outside").alias("has_number"), F.max(~F.col("number_outside")).alias("has_title"))
    judged = judged.join(beside, "page_id", "left")
    placed_number = F.col("number") & ((F.col("edge") == 1) | F.coalesce("has_title", F.lit(False)))
    placed_title = F.col("header") & ((F.col("edge") == 1) | F.coalesce("has_number", F.lit(False)))
    kind = F.when(placed_number, "page_number").when(placed_title, "header")
    return judged.select("src", "row_id", "load", "line_no", kind.alias("kind")).where("kind is not null")


def noise(pages: DataFrame, blocks: DataFrame) -> DataFrame:
    """(src, row_id, line_no, kind) of all noise; each row once, a line may have several kinds. Null texts have none."""
    rows = stored(lines(pages, blocks), "lines")
    vocab = stored(vocabulary(rows), "vocabulary")
    of = lambda found, kind: found.select("src", "row_id", "line_no", (F.lit(kind) if kind else F.col("kind")).alias("kind"))
    return (
        of(running_titles(rows, pages), "")
        .unionByName(of(_breaks(rows, vocab).where("not compound"), "hyphen"))
        .unionByName(of(_spotted(rows, vocab), "char"))
        .unionByName(of(rows.where("part = 'mark'"), "char"))
        .distinct()
    )


def _concerned(rows: DataFrame, keys: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` with ``concerned``: true where the key is among ``keys``, and by chance elsewhere. ``PLACES`` bits are broadcast, for any number of keys."""
    where = F.xxhash64(*key)
    at, bit = F.pmod(where, F.lit(PLACES // 64)), F.expr(f"shiftleft(1L, cast(pmod(xxhash64({', '.join(key)}) div {PLACES // 64}, 64) as int))")
    set_ = keys.select(at.alias("at"), bit.alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("bits"))
    marked = rows.withColumn("at", at).join(F.broadcast(set_), "at", "left").drop("at")
    return marked.withColumn("concerned", F.coalesce(F.col("bits").bitwiseAND(bit) != 0, F.lit(False))).drop("bits")


def paragraphs(pages: DataFrame, blocks: DataFrame) -> DataFrame:
    """(src, row_id, page_id, paragraph_no, text): every page and every block as continuous paragraphs; ``row_id`` as in ``noise``.

    A text delivered more than once counts as its latest load. Running titles and page numbers are left out, broken words joined,
    misread words replaced by their reading. A paragraph ends at a blank line, at the end of the text, or after a closed line that is much
    shorter than the lines of its text.
    """
    rows = stored(lines(pages, blocks, with_text=True), "lines")
    vocab = stored(vocabulary(rows), "vocabulary")
    key, nothing = ["src", "row_id"], F.lit(None).cast("string")

    def notes(found: DataFrame, kind: str, word: Column = nothing, reading: Column = nothing) -> DataFrame:
        return found.select(*key, F.struct("load", "line_no", F.lit(kind).alias("kind"), word.alias("word"), reading.alias("reading")).alias("note"))

    every = (
        notes(running_titles(rows, pages), "title")
        .unionByName(notes(_spotted(rows, vocab), "fix", F.col("word"), F.col("reading")))
        .unionByName(notes(_breaks(rows, vocab).where("compound"), "compound"))
    )
    every = stored(every, "notes")
    # Texts of which something is known, or that came more than once, meet it by one join; the others go without. All that follows stays in the row.
    texts = _kind(rows, "text", *key, "page_id", "load", "time", "form")
    again = _kind(rows, "text", *key).groupBy(*key).agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    texts = _concerned(texts, every.select(*key).unionByName(again.select(*key)), key)
    latest = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("time"), "load"))
    some = texts.where("concerned").withColumn("latest", latest).where("latest = 1").drop("latest")
    some = some.join(every.groupBy(*key).agg(F.collect_set("note").alias("notes")), key, "left")
    text = some.unionByName(texts.where("not concerned").withColumn("notes", F.lit(None).cast(some.schema["notes"].dataType)))
    of = lambda kind: F.filter("notes", lambda n: (n["load"] == F.col("load")) & (n["kind"] == kind))
    at = lambda kind: F.transform(of(kind), lambda n: n["line_no"])
    has = lambda places, i: F.coalesce(F.array_contains(places, i), F.lit(False))
    text = text.select(
        "src", "row_id", "page_id", F.split("form", "\n").alias("ls"), of("fix").alias("fixes"),
        at("title").alias("titles"), at("compound").alias("compounds"),
    )
    marked = rf"(?<={_LETTER}){SPECKS}(?={_LETTER})"

    def repaired(line: Column, i: Column) -> Column:
        found = lambda f: F.concat(F.lit(r"(?iU)(?<![\p{L}\p{M}\p{N}])\Q"), F.regexp_replace(f["word"], marked, ""), F.lit(r"\E(?![\p{L}\p{M}\p{N}])"))
        return F.aggregate(F.filter("fixes", lambda f: f["line_no"] == i), line, lambda s, f: F.regexp_replace(s, found(f), f["reading"]))

    # Each step is cheap where it has nothing to do, as in most lines.
    where = lambda needed, pattern, to: lambda line: F.when(line.rlike(needed), F.regexp_replace(line, pattern, to)).otherwise(line)
    text = text.withColumn("ls", F.transform("ls", where(SPECKS, marked, "")))
    text = text.withColumn("ls", F.when(F.size("fixes") > 0, F.transform("ls", repaired)).otherwise(F.col("ls")))
    text = text.withColumn("ls", F.transform("ls", where(r"[^\S ]|  ", r"\s+", " ")))
    text = text.withColumn("ls", F.transform("ls", lambda line, i: F.when(~has("titles", i), F.trim(line))))
    text = text.withColumn("widest", F.array_max(F.transform("ls", F.length)))

    def piece(line: Column, i: Column) -> Column:
        broken = line.rlike(f"{_LETTER}[{HYPHENS}]$") & F.coalesce(F.get("ls", i + 1), F.lit("")).rlike(f"^{_LETTER}")
        return (
            F.when(line == "", "\n")
            .when(has("compounds", i), line)
            .when(broken, F.regexp_replace(line, f"[{HYPHENS}]$", ""))
            .when((F.length(line) < F.col("widest") * 0.6) & line.rlike(_CLOSED), F.concat(line, F.lit("\n")))
            .otherwise(F.concat(line, F.lit(" ")))
        )

    whole = F.split(F.array_join(F.transform("ls", piece), ""), " *\n[ \n]*")
    return text.select("src", "row_id", "page_id", F.posexplode(F.filter(F.transform(whole, lambda t: F.trim(t)), lambda t: t != "")).alias("paragraph_no", "text"))
