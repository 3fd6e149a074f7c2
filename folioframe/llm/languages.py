"""Language of pages and blocks by fusing the evidence of the text with what is declared about it.

* Text: naive Bayes over words hashed into a fixed number of buckets, so the model has the same size for any corpus; a word the corpus
  does not know speaks by its script only. It is counted from the pages' own declared languages; wrong labels are a minority and cancel
  out. A second round counts again with the languages the first round found per line, which frees the counts from foreign paragraphs.
  Hindi in Latin letters is a class of its own in the model and Hindi in the result.
* A page is a mixture: every line has a posterior over languages, and the page's shares are re-estimated from them.
* Declared language, the language word in the file's name, and the file itself (the host) give a prior. The prior of a file is its
  other pages' shares, smoothed by those of files with the same name word, smoothed by all pages: grouped sums only.

The prior counts as much as ``PRIOR_WORDS`` words, so it decides short and garbled texts and leaves long ones alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.operators.skew import heavy_join
from folioframe.session import stored

# Language codes, and the names a label may use.
CODES = ("en", "hi", "mr", "bn", "as", "gu", "or", "pa", "ur", "ta", "te", "kn", "ml")
NAMES = {
    "english": "en", "hindi": "hi", "marathi": "mr", "bengali": "bn", "bangla": "bn", "assamese": "as", "gujarati": "gu",
    "odia": "or", "oriya": "or", "punjabi": "pa", "panjabi": "pa", "urdu": "ur", "tamil": "ta", "telugu": "te",
    "kannada": "kn", "malayalam": "ml",
}
#: Buckets of the hashed features, and the pseudo-count of each in use.
BUCKETS, ALPHA = 1 << 20, 0.05
#: Words the prior is worth, and pages that the wider group is worth in smoothing a file.
PRIOR_WORDS, SMOOTH_PAGES = 2.0, 4.0
#: Weight of the declared label and of the name word against all other languages.
TRUST = 8.0
#: A block in another language has this many words.
MIN_WORDS = 5

_N = len(CODES)
#: Classes of the text model: the languages, then Hindi in Latin letters.
_CLASSES = _N + 1
#: A word bucket counts as known from this count on.
KNOWN = 3.0
_LETTERS = re.compile(r"[^\W\d_]")
SHARES = "array<double>"


def label_code(label: Column) -> Column:
    """The code a label names, or null: a code, an English name in any case, or a code with a region."""
    plain = F.lower(F.trim(label))
    short = F.regexp_extract(plain, r"^([a-z]{2})(?:[-_][a-z0-9]+)*$", 1)
    names = F.create_map(*[F.lit(x) for kv in NAMES.items() for x in kv])
    return F.when(short.isin(*CODES), short).otherwise(F.try_element_at(names, plain))


def _hash(text: str) -> int:
    """A hash that is the same in every process (FNV-1a over code points)."""
    h = 2166136261
    for ch in text:
        h = ((h ^ ord(ch)) * 16777619) & 0xFFFFFFFF
    return h % BUCKETS


class Features:
    """(word bucket, script bucket) of pieces of text; pieces seen before are remembered up to a bound."""

    LIMIT = 300_000

    def __init__(self) -> None:
        self.known: dict[str, tuple[int, int]] = {}

    def _of(self, piece: str) -> tuple[int, int]:
        """The buckets of a lower-case piece, −1 for a piece without a letter."""
        found = self.known.get(piece)
        if found is None:
            if len(self.known) > self.LIMIT:
                self.known.clear()
            word = "".join(ch for ch in piece if ch.isalpha() or 0x900 <= ord(ch) < 0xE00 and not ch.isdigit())
            found = (_hash(word), _hash(f"script {ord(word[0]) >> 7}")) if _LETTERS.search(piece) and word else (-1, -1)
            self.known[piece] = found
        return found

    def __call__(self, text: str) -> list[tuple[int, int]]:
        """One pair of buckets per word with a letter."""
        return [f for f in map(self._of, text.lower().split()) if f[0] >= 0]

    def columns(self, lines: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(words per line, word buckets, script buckets) of many lines; every different piece is looked at once."""
        split = pc.utf8_split_whitespace(pc.utf8_lower(lines))
        coded = split.values.dictionary_encode()
        table = np.array([self._of(x) for x in coded.dictionary.to_pylist()], np.int32).reshape(-1, 2)
        found = table[coded.indices.to_numpy()]
        has = found[:, 0] >= 0
        upto = np.append(0, np.cumsum(has))[split.offsets.to_numpy()]
        return np.diff(upto).astype(np.int32), found[has, 0], found[has, 1]


class Model:
    """log P(bucket | class) of the buckets in use, with one row for all others, and which word buckets are known."""

    def __init__(self, used: np.ndarray, counts: np.ndarray):
        counts = np.vstack([counts, np.zeros((1, _CLASSES))])
        log_p = np.log(counts + ALPHA) - np.log(counts.sum(axis=0) + ALPHA * len(counts))
        self.weights = (log_p - log_p.mean(axis=1, keepdims=True)).astype(np.float32)
        self.known = counts.sum(axis=1) >= KNOWN
        self.row = np.full(BUCKETS, len(used), np.int32)
        self.row[used] = np.arange(len(used))

    def scores(self, words: np.ndarray, scripts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The log likelihood of each class for every line (of ``sizes`` words, each one at least), up to a constant."""
        out = np.empty((len(sizes), _CLASSES))
        ends = np.cumsum(sizes)
        for some in np.array_split(np.arange(len(sizes)), max(1, int(ends[-1] // 200_000) if len(ends) else 1)):
            if len(some):
                low, high = ends[some[0]] - sizes[some[0]], ends[some[-1]]
                word, script = self.row[words[low:high]], self.row[scripts[low:high]]
                each = self.weights[np.where(self.known[word], word, script)]
                out[some] = np.add.reduceat(each, ends[some] - sizes[some] - low, axis=0)
        return out


def _mixtures(scores: np.ndarray, words: np.ndarray, text: np.ndarray, n: int, rounds: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """(shares of each of ``n`` texts, posterior of each line) of the mixtures; ``text`` tells the text of each line, in order.

    A line's prior is the mixture of its text, so a few odd words in a page of one language don't count as another.
    """
    pi = np.full((n, _CLASSES), 1 / _CLASSES)
    total = np.bincount(text, words, n)[:, None]
    starts = np.flatnonzero(np.append(True, text[1:] != text[:-1])) if len(text) else np.empty(0, np.int64)
    post = np.full_like(scores, 1 / _CLASSES)
    for _ in range(rounds):
        z = scores + np.log(pi + 1e-6)[text]
        z -= z.max(axis=1, keepdims=True)
        post = np.exp(z)
        post /= post.sum(axis=1, keepdims=True)
        sums = np.zeros((n, _CLASSES))
        if len(starts):
            sums[text[starts]] = np.add.reduceat(words[:, None] * post, starts, axis=0)
        pi = (PRIOR_WORDS / _CLASSES + sums) / (PRIOR_WORDS + total)
    return pi, post


def _training_class(code: str | None, text: str) -> int:
    """The class a declared language trains, −1 for none: Hindi that is mostly in Latin letters trains the class of its own."""
    if code == "hi":
        latin = sum("a" <= ch <= "z" for ch in text.lower())
        if latin > sum(0x900 <= ord(ch) < 0x980 for ch in text):
            return _N
    return CODES.index(code) if code else -1


_READ = "lines binary, words binary, scripts binary"


def _packed(lists: np.ndarray, values: np.ndarray) -> pa.Array:
    """Slices of ``values`` as bytes, one per pair of neighbouring offsets."""
    return pa.array([values[a:b].tobytes() for a, b in zip(lists[:-1], lists[1:])], pa.binary())


def _read(lines: pa.ListArray, features: Features) -> list[pa.Array]:
    """The columns ``_READ`` of texts given as lists of lines: words per line, and the buckets of all words."""
    sizes, words, scripts = features.columns(pc.fill_null(lines.values, ""))
    offsets = lines.offsets.to_numpy()
    upto = np.append(0, np.cumsum(sizes))[offsets]
    return [_packed(offsets, sizes), _packed(upto, words), _packed(upto, scripts)]


def read_pages(pages: DataFrame) -> DataFrame:
    """(id, file, label, loaded, class, lines, words, scripts) of pages: every text is read once, later passes use its numbers.

    Null texts have no words; rows delivered again are kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            text = pc.fill_null(batch.column(5), "")
            kinds = [_training_class(c, t if c == "hi" else "") for c, t in zip(batch.column(4).to_pylist(), text.to_pylist())]
            columns = [*batch.columns[:4], pa.array(kinds, pa.int32()), *_read(pc.split_pattern(text, "\n"), features)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "file", "label", "loaded", "class", "lines", "words", "scripts"])

    rows = pages.select(
        F.col("page_id").cast("bigint").alias("id"), "file", "lang", F.col("loaded_at").cast("string").alias("loaded"), label_code(F.col("lang")).alias("code"), F.col("full_text").alias("text")
    )
    return rows.mapInArrow(run, f"id bigint, file string, label string, loaded string, class int, {_READ}")


def read_blocks(annotations: DataFrame) -> DataFrame:
    """(id, lines, words, scripts) of annotations, one line per element of ``block_text``; null elements count as empty, null arrays give no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            # Slices of a list array keep their parent's values, so offsets are taken as they are.
            yield pa.RecordBatch.from_arrays([batch.column(0), *_read(batch.column(1), features)], ["id", "lines", "words", "scripts"])

    rows = annotations.where("block_text is not null").select(F.col("ann_id").cast("bigint").alias("id"), "block_text")
    return rows.mapInArrow(run, f"id bigint, {_READ}")


class _Texts:
    """The texts of a batch: their lines with a word, side by side."""

    def __init__(self, batch: pa.RecordBatch):
        unpack = lambda name: [np.frombuffer(x, np.int32) for x in batch.column(name).to_pylist()]
        lines = unpack("lines")
        self.n = batch.num_rows
        sizes = np.concatenate([*lines, np.empty(0, np.int32)])
        text = np.repeat(np.arange(self.n), [len(x) for x in lines])
        place = np.concatenate([*[np.arange(len(x)) for x in lines], np.empty(0, np.int64)])
        full = sizes > 0
        self.sizes, self.text, self.place = sizes[full], text[full], place[full].astype(np.int32)
        self.words = np.concatenate([*unpack("words"), np.empty(0, np.int32)])
        self.scripts = np.concatenate([*unpack("scripts"), np.empty(0, np.int32)])

    def mixtures(self, model: Model) -> tuple[np.ndarray, np.ndarray]:
        return _mixtures(model.scores(self.words, self.scripts, self.sizes), self.sizes.astype(float), self.text, self.n)


def _summed(ids: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different ids and the sums of their rows of ``values``."""
    order = np.argsort(ids, kind="stable")
    first = np.flatnonzero(np.append(True, ids[order][1:] != ids[order][:-1]))
    return ids[order][first], np.add.reduceat(values[order], first, axis=0)


def _counts(model: Model | None):
    """An Arrow function from texts to sparse counts (bucket, code, n): by the training class or, with a model, by each line's posterior."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BUCKETS, _CLASSES))
        for batch in batches:
            t = _Texts(batch)
            if not len(t.words):
                continue
            line = np.repeat(np.arange(len(t.sizes)), t.sizes)
            if model is None:
                kind = batch.column("class").to_numpy()[t.text][line].astype(np.int64)
                for ids in (t.words, t.scripts):
                    both, n = np.unique(ids.astype(np.int64) * _CLASSES + kind, return_counts=True)
                    total[both // _CLASSES, both % _CLASSES] += n
                continue
            _, post = t.mixtures(model)
            for some in np.array_split(np.arange(len(line)), max(1, len(line) // 200_000)):
                for ids in (t.words[some], t.scripts[some]):
                    at, sums = _summed(ids, post[line[some]])
                    total[at] += sums
        at, code = np.nonzero(total > 1e-3)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(code.astype(np.int32)), pa.array(total[at, code])], ["bucket", "code", "n"])

    return run


def _fitted(read: DataFrame, model: Model | None) -> Model:
    """The model of the counts, BUCKETS x classes at most: what is collected is bounded by that for any corpus."""
    summed = read.select("class", "lines", "words", "scripts").mapInArrow(_counts(model), "bucket int, code int, n double")
    table = summed.groupBy("bucket", "code").agg(F.sum("n").alias("n")).toArrow()
    used, at = np.unique(table["bucket"].to_numpy(), return_inverse=True)
    counts = np.zeros((len(used), _CLASSES))
    counts[at, table["code"].to_numpy()] = table["n"].to_numpy()
    return Model(used, counts)


def fit(read: DataFrame) -> Model:
    """The text model of pages (``read_pages``), in two rounds. Pages without a usable label train the second round only."""
    return _fitted(read, _fitted(read.where(F.col("class") >= 0), None))


def _merged(shares: np.ndarray) -> np.ndarray:
    """Shares of languages from those of classes."""
    out = shares[:, :_N].copy()
    out[:, CODES.index("hi")] += shares[:, _N]
    return out


def _judged(model: Model, least: int):
    """An Arrow function from texts (columns of ``_READ`` last) to rows of two kinds: one per text with its shares and number of words, and
    one per line of ``least`` words in another language than most of its text, with its language and posterior."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = np.array(CODES, object)
        for batch in batches:
            t = _Texts(batch)
            pi, post = t.mixtures(model)
            words = np.bincount(t.text, t.sizes, t.n)
            sums = np.zeros((t.n, _N))
            np.add.at(sums, t.text, _merged(post) * t.sizes[:, None])
            shares = np.where(words[:, None] > 0, sums / np.maximum(words, 1)[:, None], 1 / _N)
            top, best = shares.argmax(axis=1), _merged(post)
            lang = best.argmax(axis=1)
            odd = np.flatnonzero((t.sizes >= least) & (lang != top[t.text]))
            about = batch.columns[: batch.num_columns - 3]
            names = [f.name for f in batch.schema][: len(about)]
            n, owner = t.n, t.text[odd]
            empty = lambda k, kind: pa.nulls(k, kind)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * _N, pa.int32()), pa.array(shares.ravel()))
            yield pa.RecordBatch.from_arrays(
                [*about, flat, pa.array(words.astype(np.int32)), empty(n, pa.int32()), pa.array(codes[top], pa.string()), empty(n, pa.string()), empty(n, pa.float64())],
                [*names, "shares", "n_words", "idx", "text_lang", "lang", "confidence"],
            )
            yield pa.RecordBatch.from_arrays(
                [
                    *[c.take(pa.array(owner)) for c in about],
                    pa.nulls(len(odd), pa.list_(pa.float64())),
                    pa.array(t.sizes[odd].astype(np.int32)),
                    pa.array(t.place[odd]),
                    pa.array(codes[top[owner]], pa.string()),
                    pa.array(codes[lang[odd]], pa.string()),
                    pa.array(np.round(best[odd, lang[odd]], 6)),
                ],
                [*names, "shares", "n_words", "idx", "text_lang", "lang", "confidence"],
            )

    return run


def judged(read: DataFrame, model: Model, about: str) -> DataFrame:
    """(columns ``about``, shares, n_words, idx, text_lang, lang, confidence): per text (idx null) its shares by words, and per line in another
    language than its text, with at least ``MIN_WORDS`` words, its language. Texts without words have even shares."""
    names = [c.split()[0] for c in about.split(", ")]
    schema = f"{about}, shares {SHARES}, n_words int, idx int, text_lang string, lang string, confidence double"
    return read.select(*names, "lines", "words", "scripts").mapInArrow(_judged(model, MIN_WORDS), schema)


def _sum_by(shares: DataFrame, by: list[str]) -> DataFrame:
    sums = [F.sum(F.get("shares", F.lit(k))).alias(f"s{k}") for k in range(_N)]
    return shares.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *sums).select(*by, "n", F.array(*[f"s{k}" for k in range(_N)]).alias("sum"))


def priors(found: DataFrame) -> DataFrame:
    """(file, n, host): the smoothed prior of every file, from pages (file, word, shares).

    host = (own sum + SMOOTH_PAGES * prior of the name word) / (own pages + SMOOTH_PAGES), and the name word's likewise from all.
    """
    mix = lambda s, n, wide: F.zip_with(s, wide, lambda a, b: (a + SMOOTH_PAGES * b) / (n + SMOOTH_PAGES))
    every = _sum_by(found.withColumn("all", F.lit(1)), ["all"]).select(F.transform("sum", lambda x: (x + 1) / (F.col("n") + _N)).alias("everywhere"))
    words = _sum_by(found, ["word"]).crossJoin(F.broadcast(every)).select("word", mix("sum", F.col("n"), "everywhere").alias("wide"))
    files = _sum_by(found, ["file", "word"])
    return files.join(words, "word").select("file", F.col("n"), mix("sum", F.col("n"), "wide").alias("host"))


def name_word(file: Column) -> Column:
    """The word of a file's name that may name its language: the first known language name, else the last word."""
    parts = F.split(F.regexp_replace(F.lower(file), r"\.[a-z0-9]+$", ""), r"[_\-. ]+")
    known = F.filter(parts, lambda p: p.isin(*NAMES))
    other = F.filter(parts, lambda p: ~p.rlike(r"\d"))
    return F.coalesce(F.get(known, F.lit(0)), F.try_element_at(other, F.lit(-1)), F.lit(""))


def _fused(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(page_id, label, lang, confidence, n_words) from (page_id, label, named, n_words, shares, host): the text's shares and, worth ``PRIOR_WORDS``
    words, the host's prior, in which the declared language and the one named by the file count ``TRUST`` times."""
    for batch in batches:
        n = batch.column(3).to_numpy()[:, None]
        shares, prior = (c.flatten().to_numpy().reshape(-1, _N) for c in batch.columns[4:])
        prior = prior.copy()
        for c in (1, 2):
            at = np.array([CODES.index(x) if x else -1 for x in batch.column(c).to_pylist()], np.int64)
            has = np.flatnonzero(at >= 0)
            prior[has, at[has]] *= TRUST
        mixed = (shares * n + PRIOR_WORDS * prior / prior.sum(axis=1, keepdims=True)) / (n + PRIOR_WORDS)
        best = mixed.argmax(axis=1)
        lang = pa.array(np.array(CODES, object)[best], pa.string())
        confidence = pa.array(np.round(mixed[np.arange(len(best)), best], 6), pa.float64())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lang, confidence, batch.column(3)], ["page_id", "label", "lang", "confidence", "n_words"])


def page_languages(found: DataFrame) -> DataFrame:
    """(page_id, label, lang, confidence, n_words) per page, from the rows of ``judged`` on ``read_pages``.

    A page delivered more than once counts once, its latest load; it is chosen among the scores, so texts are not shuffled. confidence is
    the fused share of the language. Null or wordless texts get the language of the prior.
    """
    latest = found.where("idx is null").groupBy("id").agg(F.max_by(F.struct("file", "label", "shares", "n_words"), F.struct("loaded", "n_words")).alias("p"))
    seen = latest.select(F.col("id").alias("page_id"), F.coalesce("p.file", F.lit("")).alias("file"), "p.label", "p.shares", "p.n_words")
    found = stored(seen.withColumn("word", name_word(F.col("file"))), "page_shares")
    host = stored(priors(found), "priors")
    joined = heavy_join(found, host, ["file"], "n", found.count())
    named = F.try_element_at(F.create_map(*[F.lit(x) for kv in NAMES.items() for x in kv]), F.col("word"))
    rows = joined.select("page_id", label_code(F.col("label")).alias("label"), named.alias("named"), "n_words", "shares", "host")
    return rows.mapInArrow(_fused, "page_id bigint, label string, lang string, confidence double, n_words int")


def languages(pages: DataFrame, annotations: DataFrame) -> DataFrame:
    """(src, row_id, block_idx, label, lang, confidence, n_words): ``page`` rows of all pages, ``segment`` rows of their lines and ``block`` rows of
    blocks of annotations in another language than most of their text (``label`` is then that language).

    Of pages and blocks with the same id one counts. confidence is a posterior: of the page its fused share, of a line or block its own
    with the shares of its text as prior.
    """
    read = stored(read_pages(pages), "page_words")
    model = fit(read)
    found = stored(judged(read, model, "id bigint, file string, label string, loaded string"), "page_scores")
    whole = page_languages(found).select(F.lit("page").alias("src"), F.col("page_id").alias("row_id"), F.lit(-1).alias("block_idx"), "label", "lang", "confidence", "n_words")
    part = lambda rows, src: rows.select(
        F.lit(src).alias("src"), F.col("id").alias("row_id"), F.col("idx").alias("block_idx"), F.col("text_lang").alias("label"), "lang", "confidence", "n_words"
    ).dropDuplicates(["row_id", "block_idx"])
    latest = found.groupBy("id").agg(F.max("loaded").alias("loaded"))
    lines = found.where("idx is not null").join(latest, ["id", "loaded"], "left_semi")
    blocks = judged(read_blocks(annotations), model, "id bigint").where("idx is not null")
    return whole.unionByName(part(lines, "segment")).unionByName(part(blocks, "block"))


def mislabelled(pages: DataFrame, annotations: DataFrame) -> DataFrame:
    """(src, row_id, block_idx, lang): pages with a missing or wrong label, and blocks in another language than their page."""
    rows = languages(pages, annotations).where("src <> 'segment'")
    return rows.where("(src = 'block') or n_words > 0 and (label is null or label <> lang)").select("src", "row_id", "block_idx", "lang")
