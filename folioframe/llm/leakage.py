"""Held-out passages inside documents: latent semantic retrieval, then word-by-word checks.

1. Passages become TF-IDF vectors over word pairs (neighbours and next neighbours), weighted by how many documents have the pair; the
   pairs of all documents are counted for that.
2. A randomised SVD of the passage matrix, distributed over the pairs: partitions send sums of small matrices only. It gives every pair a
   vector in the latent space of the passages, and every passage its own.
3. Documents are cut into overlapping windows such that every run of ``RUN`` words lies whole in one of them. Each window is projected
   and compared by cosine with all passages: a stated query set against all rows, in blocks, without a shuffle. The least cosine is set
   for every passage and window: what the weakest run of the passage would reach with ``MISREAD`` words misread at the worst places,
   times the share of the passage that the latent space keeps. The space has ``RANK_SHARE`` of the rank of the passages and ``RANK`` at
   most; a passage of which it keeps less than ``KEPT`` gets a direction of its own beside it, so no passage is lost to a low rank.
   Documents are read into word numbers once; both passes over them use these.
4. Candidates are checked: a run of ``RUN`` consecutive passage words, of which ``MISREAD`` at most may be misread, makes a leak.
5. Paraphrases have candidates of their own: stretches as long as the passage with as many of its word pairs as any rewording in place
   keeps that leaves ``PARAPHRASE`` of the words. The longest common subsequence and the presence of the answer tell them.

The held-out set is small and stated (it does not grow with the corpus); its pairs and vectors go to every task.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.session import stored

#: A leak has this many consecutive words, of which so many may be misread.
RUN, MISREAD = 12, 2
#: Words of a window, and from one window's start to the next; WINDOW - STEP >= RUN keeps every run in one window.
WINDOW, STEP = 36, 24
#: Part of the least weight of a run, misread words taken off, that a window must share with the passage to be a candidate.
SHARE = 0.98
#: Rank of the latent space: share of the number of passages, and the most; extra directions of the random sketch, and sketch seed.
RANK_SHARE, RANK, EXTRA, SEED = 0.8, 512, 10, 11
#: Passages of which the latent space keeps less than this share of their squared weight are compared beside it as well; of the others,
#: windows may fall short of the least cosine by ``SLACK``.
KEPT, SLACK = 0.8, 0.1
#: Share of the passage that a paraphrase has in common with a stretch as long as the passage (a window at least), in order.
PARAPHRASE = 0.5

_BREAK = re.compile(r"[-‐\xad¬]\s*\n\s*")


def _plain(piece: str) -> str:
    """The letters, marks and digits of a piece, lower case."""
    return "".join(ch for ch in piece.lower() if ch.isalnum() or unicodedata.category(ch)[0] == "M")


def _joined(text: str) -> str:
    """The text in composed form, with words broken at line ends whole again; vowel signs, viramas and joiners belong to the word."""

    def mend(m: re.Match) -> str:
        ch = m.string[m.start() - 1 : m.start()]
        return "" if ch.isalpha() or ch in ("\u200c", "\u200d") or ch and unicodedata.category(ch)[0] == "M" else m[0]

    return _BREAK.sub(mend, unicodedata.normalize("NFC", text))


def words(text: str | None) -> list[str]:
    """The words of a text without case, punctuation, line breaks and hyphens at line ends."""
    return [w for w in map(_plain, _joined(text or "").split()) if w]


@dataclass
class Passages:
    """The held-out passages in integers: words, and for each passage its word ids; the sorted codes of their word pairs."""

    items: np.ndarray
    tokens: list[list[str]]
    answers: list[list[str]]
    vocabulary: dict[str, int]
    ids: list[np.ndarray]
    codes: np.ndarray

    @classmethod
    def read(cls, rows: list) -> Passages:
        tokens = [words(r["passage"]) for r in rows]
        kept = [k for k, t in enumerate(tokens) if t]
        vocabulary: dict[str, int] = {}
        ids = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in tokens[k]], np.int64) for k in kept]
        codes = np.unique(np.concatenate([pair_codes(i, len(vocabulary))[0] for i in ids] or [np.empty(0, np.int64)]))
        return cls(
            np.array([rows[k]["item_id"] for k in kept], np.int64),
            [tokens[k] for k in kept],
            [words(rows[k]["answer"]) for k in kept],
            vocabulary,
            ids,
            codes,
        )


def pair_codes(ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes, places) of the pairs (word, next) and (word, next but one) of known words."""
    codes, places = [], []
    for gap in (1, 2):
        a, b = ids[:-gap], ids[gap:]
        ok = (a >= 0) & (b >= 0)
        codes.append(((a * size + b) * 2 + gap - 1)[ok])
        places.append(np.flatnonzero(ok))
    return np.concatenate(codes), np.concatenate(places)


class _Reader:
    """Word ids of documents (−1 for words no passage has); pieces seen before are remembered up to a bound."""

    LIMIT = 300_000

    def __init__(self, p: Passages):
        self.p, self.known = p, {}

    def _id(self, piece: str) -> int:
        found = self.known.get(piece)
        if found is None:
            if len(self.known) > self.LIMIT:
                self.known.clear()
            word = _plain(piece)
            found = self.known[piece] = self.p.vocabulary.get(word, -1) if word else -2
        return found

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of every text; each different piece of the texts is looked up once."""
        pieces = [_joined(t or "").split() for t in texts.to_pylist()]
        flat = pa.array([x for some in pieces for x in some], pa.string()).dictionary_encode()
        table = np.array([self._id(x) for x in flat.dictionary.to_pylist()], np.int32)
        ids = table[flat.indices.to_numpy()]
        ends = np.cumsum([len(some) for some in pieces])
        return [x[x > -2] for x in np.split(ids, ends[:-1])] if len(pieces) else []


def least_masses(ids: np.ndarray, weight: np.ndarray, codes: np.ndarray, size: int) -> float:
    """The least sum of squared pair weights that a run of a passage keeps when ``MISREAD`` of its words are misread."""
    n = len(ids)
    if n < RUN:
        return np.inf
    by_gap = []
    for gap in (1, 2):
        at = np.searchsorted(codes, (ids[:-gap] * size + ids[gap:]) * 2 + gap - 1)
        by_gap.append(weight[at] ** 2)
    best = np.inf
    places = np.arange(RUN)
    for a in range(RUN):
        for b in range(a + 1, RUN):
            gone = (places == a) | (places == b)
            kept = np.zeros(n - RUN + 1)
            for gap, w in zip((1, 2), by_gap):
                for k in range(RUN - gap):
                    if not (gone[k] or gone[k + gap]):
                        kept += w[k : k + n - RUN + 1]
            best = min(best, kept.min())
    return float(best)


def _places(codes: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index into ``codes``, which of ``found``) of the codes that occur."""
    if not len(codes) or not len(found):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.minimum(np.searchsorted(codes, found), len(codes) - 1)
    hit = np.flatnonzero(codes[at] == found)
    return at[hit], hit


def read_documents(documents: DataFrame, p: Passages, key: str, text: str) -> DataFrame:
    """(doc_id, text, ids): the documents with their word numbers, as the bytes of 32-bit integers; null texts are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = _Reader(p)
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                ids = [x.tobytes() for x in read(part.column(1))]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ids, pa.binary())], ["doc_id", "text", "ids"])

    rows = documents.where(F.col(text).isNotNull()).select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, text string, ids binary")


def _ids(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, np.int32).astype(np.int64) for x in column.to_pylist()]


def _spots(docs: list[np.ndarray], p: Passages) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, pair, place) of all pairs of the passages that stand in the documents."""
    every = np.concatenate([*docs, np.empty(0, np.int64)])
    owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    starts = np.append(0, np.cumsum([len(d) for d in docs]))
    out = []
    for gap in (1, 2):
        a, b = every[:-gap], every[gap:]
        at = np.flatnonzero((a >= 0) & (b >= 0) & (owner[:-gap] == owner[gap:]))
        pair, hit = _places(p.codes, (a[at] * len(p.vocabulary) + b[at]) * 2 + gap - 1)
        at = at[hit]
        out.append((owner[at], pair, at - starts[owner[at]]))
    return tuple(np.concatenate(x) for x in zip(*out))


def document_counts(read: DataFrame, p: Passages) -> tuple[np.ndarray, int]:
    """(number of documents with each pair, number of documents), counted over all documents (with column ``ids``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(p.codes) + 1, np.int64)
        for batch in batches:
            owner, pair, _ = _spots(_ids(batch.column(0)), p)
            total[:-1] += np.bincount(np.unique(owner * len(p.codes) + pair) % max(1, len(p.codes)), minlength=len(p.codes))
            total[-1] += batch.num_rows
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["pair", "n"])

    summed = read.select("ids").mapInArrow(run, "pair int, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(p.codes) + 1, np.int64)
    out[summed["pair"].to_numpy()] = summed["n"].to_numpy()
    return out[:-1], int(out[-1])


def _summed(rows: DataFrame) -> np.ndarray:
    """The sum of the arrays in column ``m``; added up by place, so no partition's array is kept."""
    table = rows.select(F.posexplode("m")).groupBy("pos").agg(F.sum("col").alias("s")).toArrow()
    out = np.zeros(table.num_rows)
    out[table["pos"].to_numpy()] = table["s"].to_numpy()
    return out


def latent_space(postings: DataFrame, n: int, rank: int = RANK) -> tuple[np.ndarray, np.ndarray, DataFrame]:
    """(U, S, vectors), of ``rank`` directions at most, of the matrix with ``n`` rows whose columns are ``postings`` (pair INT, items ARRAY<INT>, weights ARRAY<DOUBLE>);
    ``vectors`` is (pair, v), one latent vector per pair.

    Y = A Omega is a sum over pairs, with the random row of each pair made from its number. Q = qr(Y) is n x l. B = Q' A is formed pair by
    pair, B B' is again a sum, and its eigenvectors give the singular values and vectors.
    """
    width = min(n, rank + EXTRA)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        y = np.zeros((n, width))
        for batch in batches:
            for pair, items, weights in zip(*(c.to_pylist() for c in batch.columns)):
                y[items] += np.outer(weights, np.random.default_rng((SEED, pair)).standard_normal(width))
        yield pa.RecordBatch.from_arrays([pa.array([y.ravel()], pa.list_(pa.float64()))], ["m"])

    q, _ = np.linalg.qr(_summed(postings.mapInArrow(sketch, "m array<double>")).reshape(n, width))

    def columns(batch: pa.RecordBatch) -> np.ndarray:
        return np.array([np.array(w) @ q[i] for i, w in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]).reshape(-1, q.shape[1])

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = np.zeros((q.shape[1], q.shape[1]))
        for batch in batches:
            b = columns(batch)
            g += b.T @ b
        yield pa.RecordBatch.from_arrays([pa.array([g.ravel()], pa.list_(pa.float64()))], ["m"])

    values, inner = np.linalg.eigh(_summed(postings.mapInArrow(gram, "m array<double>")).reshape(q.shape[1], q.shape[1]))
    order = [k for k in np.argsort(-values) if values[k] > 1e-9 * values.max()][:rank]
    s = np.sqrt(values[order])
    turn = inner[:, order] / s

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = (columns(batch) @ turn).astype(np.float32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(v), pa.list_(pa.float32()))], ["pair", "v"])

    return q @ inner[:, order], s, postings.mapInArrow(project, "pair int, v array<float>")


def _alike(a: str, b: str) -> bool:
    """Whether one word may be a misread form of the other."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 2:
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1] <= max(1, min(len(a), len(b)) // 3) and min(len(a), len(b)) > 1


def has_run(passage: np.ndarray, window: np.ndarray, passage_words: list[str], window_words) -> bool:
    """Whether ``RUN`` consecutive words of the passage stand in the window in order, all but ``MISREAD`` exactly and those misread.

    ``window_words`` is called for the words of the window when the numbers alone don't decide.
    """
    n, m = len(passage), len(window)
    if n < RUN or m < RUN:
        return False
    # Some RUN neighbours of the window must have enough words of the passage at all.
    held = np.append(0, np.cumsum(np.isin(window, passage)))
    if (held[RUN:] - held[:-RUN]).max() < RUN - MISREAD:
        return False
    same = passage[:, None] == window[None, :]
    sums = np.zeros((n + 1, m + 1), np.int16)
    for i in range(n):
        sums[i + 1, 1:] = sums[i, :-1] + same[i]
    runs = sums[RUN:, RUN:] - sums[:-RUN, :-RUN]
    if (runs == RUN).any():
        return True
    spelt = None
    for i, j in zip(*np.nonzero(runs >= RUN - MISREAD)):
        spelt = spelt or window_words()
        off = np.flatnonzero(passage[i : i + RUN] != window[j : j + RUN])
        if all(_alike(passage_words[i + k], spelt[j + k]) for k in off):
            return True
    return False


def common_length(passage: np.ndarray, window: np.ndarray) -> int:
    """Length of the longest common subsequence, by bit-parallel columns."""
    masks: dict[int, int] = {}
    for k, x in enumerate(passage.tolist()):
        masks[x] = masks.get(x, 0) | 1 << k
    full = (1 << len(passage)) - 1
    row = full
    for x in window.tolist():
        matched = row & masks.get(x, 0)
        row = ((row + matched) | (row - matched)) & full
    return len(passage) - row.bit_count()


def least_pairs(n: int) -> int:
    """The fewest places where a passage of ``n`` words keeps a pair of neighbours or next neighbours when words are replaced in place and
    ``PARAPHRASE`` of them stay: of the steps from one word that stays to the next, those of three words or more are limited by ``n``."""
    m = int(np.ceil(PARAPHRASE * n))
    return max(1, -((n + 2 - 3 * m) // 2))


def longest_common(passage: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> int:
    """The longest common subsequence of a passage and the stretches of a document at sorted ``starts``; exact from ``PARAPHRASE`` of the
    passage on. One word further a stretch has at most one word more in common, so starts that can't reach the goal are passed over."""
    size = max(len(passage), WINDOW)
    before = np.append(0, np.cumsum(np.isin(ids, passage)))
    shared = before[np.minimum(starts + size, len(ids))] - before[starts]
    goal, best, after = int(np.ceil(PARAPHRASE * len(passage))), 0, -1
    for q, most in zip(starts.tolist(), shared.tolist()):
        if q < after or most < max(goal, best + 1):
            continue
        common = common_length(passage, ids[q : q + size])
        best = max(best, common)
        after = q + max(goal, best + 1) - common
    return best


def _contains(words_: list[str], part: list[str]) -> bool:
    return bool(part) and any(words_[k : k + len(part)] == part for k in range(len(words_) - len(part) + 1))


def leaks(
    documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", reworded: bool = False, rank_share: float = RANK_SHARE, kept: float = KEPT
) -> DataFrame:
    """(doc_id, item_id, cosine, run, common, answer) of every document and passage with a candidate window.

    ``run``: a run of ``RUN`` passage words was found. With ``reworded``, which adds the candidates of paraphrases, ``common`` is the largest
    share of the passage's words that a stretch as long as the passage has in order (``cosine`` is null where there is no window of its
    own), and ``answer`` tells whether the item's answer (if it has one) stands in the document; else they are 0 and false. Null texts, passages without words, and an empty table on
    either side give no row. Passages shorter than ``RUN`` words have no runs.
    """
    schema = "doc_id bigint, item_id bigint, cosine double, run boolean, common double, answer boolean"
    spark = documents.sparkSession
    p = Passages.read(items.select("item_id", "passage", "answer").orderBy("item_id").collect())
    if not len(p.items):
        return spark.createDataFrame([], schema)
    documents = stored(read_documents(documents, p, key, text), "documents")
    having, n_docs = document_counts(documents, p)
    idf = np.log((1 + n_docs) / (1 + having)) + 1
    weight = np.sqrt(idf)
    rows = []
    for k, ids in enumerate(p.ids):
        at, _ = _places(p.codes, pair_codes(ids, len(p.vocabulary))[0])
        rows += [(int(f), k, float(weight[f] * t)) for f, t in zip(*np.unique(at, return_counts=True))]
    entries = spark.createDataFrame(rows, "pair int, item int, weight double")
    postings = entries.groupBy("pair").agg(F.collect_list("item").alias("items"), F.collect_list("weight").alias("weights"))
    n = len(p.items)
    u, s, vectors = latent_space(postings, n, max(1, min(RANK, int(np.ceil(rank_share * n)))))
    table = vectors.toArrow()
    latent = np.zeros((len(p.codes), len(s)), np.float32)
    latent[table["pair"].to_numpy()] = pc.list_flatten(table["v"].combine_chunks()).to_numpy().reshape(-1, len(s))
    norms = np.zeros(n)
    for _, k, w in rows:
        norms[k] += w * w
    passages = ((u * s) / np.sqrt(norms)[:, None]).astype(np.float32).T
    least = SHARE * np.array([least_masses(i, weight, p.codes, len(p.vocabulary)) for i in p.ids]) / np.sqrt(norms)
    # What a window has in common with a passage shows in the latent space to the share of the passage that lies in it.
    share = (u**2).sum(axis=1)
    beside = np.flatnonzero(share < kept)
    alone = np.zeros((len(p.codes), len(beside)), np.float32)
    place = {int(k): c for c, k in enumerate(beside)}
    for f, k, w in rows:
        if k in place:
            alone[f, place[k]] = w
    latent = np.hstack([latent, alone])
    own = np.zeros((len(beside), n), np.float32)
    own[np.arange(len(beside)), beside] = 1 / np.sqrt(norms[beside])
    passages[:, beside] = 0
    passages = np.vstack([passages, own])
    whole = share > 1 - 1e-6
    whole[beside] = True
    reach = np.where(whole, 1.0, share * (1 - SLACK)) * least
    average = float((weight**2).mean())
    lightest = np.full(len(p.codes), np.inf)
    for f, k, _ in rows:
        lightest[f] = min(lightest[f], least[k] * np.sqrt(norms[k]))
    weighted = latent * weight[:, None].astype(np.float32)
    most_often = max(round(w / weight[f]) for f, _, w in rows)
    by_pair = sorted((f, k) for f, k, _ in rows)
    owned = np.array([k for _, k in by_pair], np.int64)
    heads = np.searchsorted([f for f, _ in by_pair], np.arange(len(p.codes) + 1))
    sizes = np.array([max(len(i), WINDOW) for i in p.ids])
    fewest = np.array([least_pairs(len(i)) for i in p.ids])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, docs = batch.column(1), _ids(batch.column(2))
            found: dict[tuple[int, int], list] = {}
            spots = _spots(docs, p)
            for d, w, k, cosine in _candidates(docs, spots):
                entry = found.setdefault((d, k), [0.0, set()])
                entry[0] = max(entry[0], cosine)
                entry[1].add(w)
            lengths = np.array([len(d) for d in docs], np.int64)
            starts = {(d, k): at for d, k, at in _reworded(spots, lengths)} if reworded and docs else {}
            out = []
            for d, k in dict.fromkeys([*found, *starts]):
                cosine, windows = found.get((d, k), (None, ()))
                checked = _checked(docs[d], texts[d].as_py(), k, windows, starts.get((d, k), ()))
                out.append((batch.column(0)[d].as_py(), int(p.items[k]), cosine, *checked))
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.bool_(), pa.float64(), pa.bool_()]
            names = ["doc_id", "item_id", "cosine", "run", "common", "answer"]
            columns = list(zip(*out)) if out else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    def _candidates(docs: list[np.ndarray], spots: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Iterator[tuple[int, int, int, float]]:
        """(document, window, passage, cosine) of all windows of a batch that reach the passage's least cosine."""
        owner, pair, place = spots
        if not len(pair):
            return
        last = np.maximum(0, -(-(np.array([len(d) for d in docs]) - WINDOW) // STEP))
        ends = last[owner]
        window = np.minimum(place // STEP, ends)
        # A place near the start of its window also lies in the window before.
        again = (window > 0) & (place < (window - 1) * STEP + WINDOW)
        pair, owner = np.append(pair, pair[again]), np.append(owner, owner[again])
        window = np.append(window, window[again] - 1)
        starts = np.append(0, np.cumsum(last + 1))
        at = starts[owner] + window
        order = np.argsort(at, kind="stable")
        at, pair = at[order], pair[order]
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        ids = at[first]
        w2 = weight[pair] ** 2
        mass = np.add.reduceat(w2, first)
        count = np.diff(np.append(first, len(at)))
        in_doc = np.searchsorted(starts, ids, "right") - 1
        size = np.minimum(np.array([len(d) for d in docs])[in_doc] - (ids - starts[in_doc]) * STEP, WINDOW)
        norm = np.sqrt(mass + np.maximum(2 * size - 3 - count, 0) * average)
        # A window whose pairs weigh less than the weakest run of every passage that has one of them can be no candidate. A pair counts as
        # often as the passage has it.
        likely = mass * most_often >= np.minimum.reduceat(lightest[pair], first)
        for chunk in np.array_split(np.flatnonzero(likely), max(1, likely.sum() // 2000)):
            if not len(chunk):
                continue
            # Windows by falling number of pairs: the k-th pairs of those that have so many are added at once.
            chunk = chunk[np.argsort(-count[chunk], kind="stable")]
            held = -count[chunk]
            x = np.zeros((len(chunk), weighted.shape[1]), np.float32)
            for j in range(-int(held[0])):
                m = int(np.searchsorted(held, -j))
                x[:m] += weighted[pair[first[chunk[:m]] + j]]
            cos = (x @ passages) / norm[chunk, None]
            for c, k in zip(*np.nonzero(cos >= reach / norm[chunk, None])):
                i = ids[chunk[c]]
                d = int(np.searchsorted(starts, i, "right") - 1)
                yield d, int(i - starts[d]), int(k), float(cos[c, k])

    def _reworded(spots: tuple[np.ndarray, np.ndarray, np.ndarray], lengths: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(document, passage, starts) of the stretches of documents that have the fewest pairs of a paraphrase."""
        wide = int(lengths.max()) + int(sizes.max())
        order = np.argsort(spots[0], kind="stable")
        owners, pairs, places = (x[order] for x in spots)
        for low_d in range(0, len(lengths), 200):
            part = slice(*np.searchsorted(owners, [low_d, low_d + 200]))
            owner, f, at = owners[part], pairs[part], places[part]
            times = heads[f + 1] - heads[f]
            item = owned[np.repeat(heads[f] - np.append(0, np.cumsum(times))[:-1], times) + np.arange(times.sum())]
            group = np.repeat((owner - low_d) * n, times) + item
            often = np.bincount(group, minlength=200 * n)[group] >= fewest[item]
            both = np.unique(group[often] * wide + np.repeat(at, times)[often])
            group = both // wide
            last = np.arange(len(both)) + fewest[group % n] - 1
            first = np.flatnonzero(last < len(both))
            first = first[both[last[first]] - both[first] < sizes[group[first] % n]]
            if not len(first):
                continue
            for mine in np.split(first, np.flatnonzero(np.diff(group[first])) + 1):
                g = int(group[mine[0]])
                d, k = low_d + g // n, g % n
                low, high = both[last[mine]] - g * wide + 2 - sizes[k], both[mine] - g * wide
                cover = np.zeros(int(lengths[d]) + 1, np.int64)
                np.add.at(cover, np.maximum(low, 0), 1)
                np.add.at(cover, high + 1, -1)
                yield d, k, np.flatnonzero(np.cumsum(cover) > 0)

    def _checked(ids: np.ndarray, text_: str, k: int, windows, starts) -> tuple[bool, float, bool]:
        spelt: list[list[str]] = []

        def all_words() -> list[str]:
            if not spelt:
                spelt.append(words(text_))
            return spelt[0]

        run, common = False, 0
        for w in windows:
            a, b = w * STEP, w * STEP + WINDOW
            part = ids[a:b]
            run = run or has_run(p.ids[k], part, p.tokens[k], lambda a=a, b=b: all_words()[a:b])
        if reworded and not run:
            near = [np.arange(max(0, w * STEP + WINDOW - sizes[k]), w * STEP + 1) for w in windows]
            common = longest_common(p.ids[k], ids, np.unique(np.concatenate([np.asarray(starts, np.int64), *near])))
        share = common / len(p.ids[k])
        answer = reworded and (run or share >= PARAPHRASE) and _contains(all_words(), p.answers[k])
        return run, share, bool(answer)

    return documents.mapInArrow(search, schema)


def leaked(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id): documents with a run of passage words; each pair once."""
    return leaks(documents, items).where("run").select("doc_id", "item_id").distinct()


def reports(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(item_id, suite, n_documents, n_paraphrases): how many documents hold each item's passage in runs, or reworded with its answer."""
    found = leaks(documents, items, reworded=True).where(f"run or (common >= {PARAPHRASE} and answer)").distinct()
    per = found.groupBy("item_id").agg(
        F.countDistinct(F.when(F.col("run"), F.col("doc_id"))).alias("n_documents"),
        F.countDistinct(F.when(~F.col("run"), F.col("doc_id"))).alias("n_paraphrases"),
    )
    zero = F.lit(0).cast("bigint")
    return (
        items.select("item_id", "suite")
        .join(F.broadcast(per), "item_id", "left")
        .select("item_id", "suite", F.coalesce("n_documents", zero).alias("n_documents"), F.coalesce("n_paraphrases", zero).alias("n_paraphrases"))
    )
