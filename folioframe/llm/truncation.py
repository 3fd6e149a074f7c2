"""Texts that lost their end: values whose last word is an unknown proper prefix of known words, with evidence of length and structure.

One pass of DuckDB inside Arrow partitions reads the replies: the words counted per batch, the ends of values that may be cut, and how many
values have which length. Two vocabulary tries, kept as tables with one row per node that some end reaches, judge the ends:

* the words of all values, counted before the last word of their value, so cut words don't enter. An end is a fragment when its last word
  is a node of the trie and rarer as a word than as an end;
* the pieces of the skeletons of whole JSON replies (strings, numbers and spaces set aside). A reply whose brackets or quotes stay open is
  looked up with what follows its last bracket: a proper prefix of known pieces.

The tries' evidence is summed with that of length (a length at which fragments pile up is a limit) and of marks, each with its weight; a
value is cut from ``ENOUGH`` on. Open brackets or a missing full stop alone are never enough.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioframe.llm.lookalikes import _quoted
from folioframe.operators.skew import heavy_join
from folioframe.session import stored

#: A word is known when it occurs this often inside values.
MIN_COUNT = 3
#: Values of fewer words may be titles, which have no closing mark.
MIN_WORDS = 5
#: A length is a limit when this many values that end in a fragment have it, more than all lengths within ``LIMIT_NEAR`` of it together, and
#: this share of all values of that length.
LIMIT_COUNT, LIMIT_NEAR, LIMIT_SHARE = 3, 20, 0.2
#: A known word that stands inside values so many times as often as it ends one unclosed is not where values end.
INNER = 16
#: What each piece of evidence weighs, and the sum from which a value is cut.
WEIGHTS = {"fragment": 3, "piece": 3, "at_limit": 3, "open": 2, "note": 2, "inner": 1, "unclosed": 1, "running": 1, "closes": 1}
ENOUGH = 3

_LITERAL = r'(?s)"[^"\\]*(?:\\.[^"\\]*)*"'
_WORD = r"[\p{L}\p{M}\p{N}'\x{200c}\x{200d}-]+"
# Marks that close a sentence, and notes that say text is missing.
_CLOSED = r"[.!?\x{0964}\x{0965}\x{06d4}\x{061f}][\"'\x{201d}\x{2019})\]]*$"
_CUT_NOTE = r"(?i)(\[cut\]|\[truncated\]|\x{fffd})\s*$"
#: Notes, page numbers and dots after the end of the text proper.
_TRAILER = (
    r"(?:\s*\[[^\]\n]*\]|\s*\([^)\n]*\)|\n\s*[\p{Pd}\[(]*\s*\p{N}+\s*[\p{Pd}\])]*|\s+(?:\.\.\.|\x{2026})|\x{2026}|\x{fffd}+|\s*`{3,})\s*$"
)
#: Stands for a string in the skeleton of a reply.
_TEXT = "\x01"

#: What the pass over the replies gives, in rows of several kinds (``part``): ``end`` (ends of values), ``word``, ``piece`` (known pieces of
#: skeletons) and ``size`` (lengths of replies and values), the last three with their number in the batch.
COLUMNS = {
    "part": "string", "id": "bigint", "kind": "string", "chars": "int", "last": "string", "tail": "string", "word": "string", "n": "bigint",
    "note": "boolean", "unclosed": "boolean", "running": "boolean", "closes": "boolean",
}


def _part(name: str, rest: str, **columns: str) -> str:
    kinds = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN"}
    given = {"part": _quoted(name)} | columns
    return "SELECT " + ", ".join(f"CAST({given.get(c, 'NULL')} AS {kinds[k]}) AS {c}" for c, k in COLUMNS.items()) + f" FROM {rest}"


def _reading_sql() -> tuple[list[str], list[str]]:
    """The statements that make tables ``r`` (replies) and ``v`` (values) of a batch, and those that read the kinds of rows off them."""
    trailer = _quoted(_TRAILER)
    bare = lambda x: f"rtrim(regexp_replace(regexp_replace(rtrim({x}, chr(10) || chr(13) || chr(9) || ' '), {trailer}, ''), {trailer}, ''), chr(10) || chr(13) || chr(9) || ' ')"
    count = lambda c: f"length(bare) - length(translate(bare, '{c}', ''))"
    literal = _quoted(_LITERAL)
    replies = f"""CREATE OR REPLACE TEMP TABLE r AS
        SELECT *, body <> '' AND (contains(bare, '"') OR {count("{[")} > {count("}]")}) AS open,
            regexp_replace(regexp_replace(regexp_replace(regexp_replace(bare, '(?s)".*$', '"'), {trailer}, ''), '\\s+', '', 'g'), '[0-9.]+|true|false|null', '0', 'g') AS skeleton
        FROM (SELECT *, regexp_replace(body, {literal}, '{_TEXT}', 'g') AS bare
            FROM (SELECT *, regexp_extract(text, '(?s)[{{\\[]\\s*["{{\\[\\]}}].*', 0) AS body FROM batch WHERE regexp_matches(text, '\\S')))"""
    decoded = f"""list_transform(regexp_extract_all(body, {literal}), lambda x: CASE WHEN contains(x, '\\')
        THEN CASE WHEN json_valid(x) THEN json_extract_string(x, '$') ELSE x END ELSE substring(x, 2, length(x) - 2) END)"""
    values = f"""CREATE OR REPLACE TEMP TABLE v AS SELECT *, regexp_extract_all(value, '{_WORD.replace("'", "''")}') AS ws,
            NOT regexp_matches(value, {_quoted(_CLOSED)}) AS unclosed FROM (
        SELECT id, 'value' AS kind, length(x) AS chars, rtrim(x) AS value, FALSE AS note, NULL AS tail FROM (SELECT id, unnest({decoded}) AS x FROM r WHERE body <> '')
        UNION ALL SELECT id, 'plain', length(text), {bare("text")}, regexp_matches(text, {_quoted(_CUT_NOTE)}), NULL FROM r WHERE body = ''
        UNION ALL SELECT id, 'open', length(text), CASE WHEN contains(bare, '"') THEN {bare("regexp_extract(bare, '(?s)" + chr(34) + "(.*)$', 1)")} ELSE '' END,
            regexp_matches(text, {_quoted(_CUT_NOTE)}), regexp_extract(skeleton, '[^\\[\\]{{}}]*$', 0) FROM r WHERE open
        UNION ALL SELECT id, 'plain', length(text), {bare("regexp_extract(bare, '[^" + _TEXT + "]*$', 0)")}, TRUE, NULL
            FROM r WHERE body <> '' AND NOT open AND regexp_matches(text, {_quoted(_CUT_NOTE)}))"""
    end = "v WHERE kind <> 'value' OR unclosed AND len(ws) >= " + str(MIN_WORDS)
    last = f"regexp_extract(value, '({_WORD.replace(chr(39), chr(39) * 2)})$', 1)"
    return [replies, values], [
        _part(
            "end", end, id="id", kind="kind", chars="chars", last=last, tail="tail", note="note", unclosed="unclosed OR kind = 'open'",
            running=f"kind = 'plain' AND len(ws) >= {MIN_WORDS}", closes="kind = 'plain' AND regexp_matches(value, '[.!?\\x{0964}\\x{06d4}]\\s')",
        ),
        _part("word", "(SELECT unnest(ws[:-2]) AS word FROM v) GROUP BY word", word="word", n="count(*)"),
        _part("piece", f"(SELECT unnest(regexp_extract_all(skeleton, '[^\\[\\]{{}}]*[\\[\\]{{}}]+')) AS word FROM r WHERE body <> '' AND NOT open) GROUP BY word", word="word", n="count(*)"),
        _part("size", "v WHERE kind = 'value' GROUP BY chars", kind="'value'", chars="chars", n="count(*)"),
        _part("size", "r GROUP BY length(text)", kind="'reply'", chars="length(text)", n="count(*)"),
    ]


def ends(replies: DataFrame, key: str, text: str) -> DataFrame:
    """``COLUMNS`` of all replies, read in one pass. Null and blank replies have no rows."""
    tables, reads = _reading_sql()

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

    rows = replies.where(F.col(text).isNotNull()).select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, ", ".join(f"`{c}` {k}" for c, k in COLUMNS.items()))


def trie(words: DataFrame, longest: int) -> DataFrame:
    """(node, below): every proper prefix, of ``longest`` characters at most, of the words, with the number of words below it."""
    upto = F.least(F.length("word") - 1, F.lit(longest))
    return (
        words.where(F.length("word") > 1)
        .select(F.explode(F.transform(F.sequence(F.lit(1), upto), lambda k: F.substring(F.col("word"), F.lit(1), k))).alias("node"))
        .groupBy("node")
        .agg(F.count(F.lit(1)).alias("below"))
    )


def _looked_up(tokens: DataFrame, words: DataFrame) -> DataFrame:
    """``tokens`` (token, n: how often it is an end) with ``inside`` (how often it is a word) and ``below`` (words it is a proper prefix of)."""
    longest = tokens.agg(F.coalesce(F.max(F.length("token")), F.lit(0))).first()[0]
    # Prefixes of which no token has the length are not made.
    nodes = trie(words, longest).join(tokens.select(F.col("token").alias("node")), "node", "left_semi")
    return (
        tokens.join(words.select(F.col("word").alias("token"), F.col("n").alias("inside")), "token", "left")
        .join(nodes.withColumnRenamed("node", "token"), "token", "left")
        .fillna(0, ["inside", "below"])
    )


def evidence(replies: DataFrame, key: str = "result_id", text: str = "raw_text") -> DataFrame:
    """(id, kind, chars, the names of ``WEIGHTS``, weight): what speaks for a cut, per end that something speaks for.

    kind is ``plain`` (a reply of text), ``open`` (a JSON reply that stays open) or ``value`` (a string inside JSON).
    """
    rows = stored(ends(replies, key, text), "ends")
    end = rows.where("part = 'end'").select("id", "kind", "chars", F.coalesce("last", F.lit("")).alias("last"), "tail", "note", "unclosed", "running", "closes")
    total = rows.where("part = 'word'").groupBy("word").agg(F.sum("n").alias("n"))
    words = stored(total.where(F.col("n") >= MIN_COUNT), "words")
    tokens = stored(end.where("unclosed and last <> ''").groupBy(F.col("last").alias("token")).agg(F.count(F.lit(1)).alias("n")), "last_words")
    looked = _looked_up(tokens, words).select(
        F.col("token").alias("last"),
        F.col("n").alias("times"),
        ((F.col("below") > 0) & (F.col("inside") < F.col("n"))).alias("fragment"),
        (F.col("inside") >= F.col("n") * INNER).alias("inner"),
    )
    count = tokens.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    named = end.where("unclosed and last <> ''")
    judged = heavy_join(named, stored(looked, "tokens"), ["last"], "times", count)
    no = F.lit(False)
    judged = judged.unionByName(end.where("not (unclosed and last <> '')").withColumns({"fragment": no, "inner": no}))
    # The tails of open replies: numbers and strings are one character each, so few differ.
    pieces = rows.where("part = 'piece'").groupBy("word").agg(F.sum("n").alias("n"))
    tails = stored(end.where("kind = 'open'").groupBy(F.col("tail").alias("token")).agg(F.count(F.lit(1)).alias("times")), "tails")
    known = _looked_up(tails.withColumnRenamed("times", "n"), stored(pieces, "pieces"))
    known = stored(known.select(F.col("token").alias("tail"), F.col("n").alias("times"), ((F.col("below") > 0) | (F.col("token") == "")).alias("piece")), "known_tails")
    open_ = heavy_join(judged.where("kind = 'open'"), known, ["tail"], "times", tails.agg(F.coalesce(F.sum("times"), F.lit(0))).first()[0])
    judged = stored(open_.unionByName(judged.where("kind <> 'open'").withColumn("piece", no)).withColumn("open", F.col("kind") == "open"), "judged")
    size = F.when(F.col("kind") == "value", "value").otherwise("reply").alias("kind")
    spikes = judged.where("fragment").groupBy(size, "chars").agg(F.count(F.lit(1)).alias("cut"))
    at = rows.where("part = 'size'").groupBy("kind", "chars").agg(F.sum("n").alias("all"))
    # One row per length, whatever the number of values.
    around = F.sum("cut").over(Window.partitionBy("kind").orderBy("chars").rangeBetween(-LIMIT_NEAR, LIMIT_NEAR))
    limits = (
        spikes.withColumn("around", around)
        .where((F.col("cut") >= LIMIT_COUNT) & (F.col("cut") * 2 > F.col("around")))
        .join(at, ["kind", "chars"])
        .where(F.col("cut") >= F.col("all") * LIMIT_SHARE)
        .select(F.col("kind").alias("size"), "chars", F.lit(True).alias("at_limit"))
    )
    judged = judged.withColumn("size", size).join(limits, ["size", "chars"], "left").withColumn("at_limit", F.coalesce("at_limit", no))
    # A string inside JSON has its closing quote, so the missing full stop says nothing of it.
    judged = judged.withColumn("unclosed", F.col("unclosed") & (F.col("kind") != "value")).withColumn("inner", F.col("inner") & F.col("unclosed"))
    weight = sum((F.coalesce(F.col(c), no).cast("int") * w for c, w in WEIGHTS.items()), F.lit(0))
    return judged.select("id", "kind", "chars", *[F.coalesce(c, no).alias(c) for c in WEIGHTS], weight.alias("weight")).where("weight > 0")


def truncated(replies: DataFrame, key: str = "result_id", text: str = "raw_text") -> DataFrame:
    """(id): every reply that lost its end, or holds a text that did; each once. Null and blank replies are no cases."""
    return evidence(replies, key, text).where(F.col("weight") >= ENOUGH).select("id").distinct()


def rules(replies: DataFrame, key: str = "result_id", text: str = "raw_text") -> DataFrame:
    """(id, rule) of every reply that lost its end, by the first evidence of these that it has: ``words`` (last word a fragment by the trie of
    words), ``pieces`` (by the trie of skeletons), ``length`` or ``marks``."""
    rule = F.when(F.col("fragment"), 1).when(F.col("piece"), 2).when(F.col("at_limit"), 3).otherwise(4)
    best = evidence(replies, key, text).where(F.col("weight") >= ENOUGH).groupBy("id").agg(F.min(rule).alias("rule"))
    return best.select("id", F.element_at(F.array(*map(F.lit, ("words", "pieces", "length", "marks"))), F.col("rule")).alias("rule"))


def rates(replies: DataFrame, key: str, text: str, by: list[str]) -> DataFrame:
    """Share of cut replies per source: ``by``, n_replies, n_truncated, share. Rows delivered again count once; a group of
    null or blank replies has the share 0."""
    cut = truncated(replies, key, text).select(F.col("id").alias(key), F.lit(1).alias("cut"))
    return (
        replies.select(key, *by)
        .distinct()
        .join(cut, key, "left")
        .groupBy(*by)
        .agg(F.count(F.lit(1)).cast("bigint").alias("n_replies"), F.count("cut").cast("bigint").alias("n_truncated"))
        .withColumn("share", F.round(F.col("n_truncated") / F.col("n_replies"), 6))
    )
