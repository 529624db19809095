"""Benchmark decontamination by latent semantic retrieval, with an exact search beside it.

An item is a TF-IDF vector of unit length over hashed words. Texts are cut into overlapping windows. A window is a candidate
for an item by its cosine in the latent space of the item's block (``latent``), which finds paraphrases, or by the cosine of the
item with that part of it whose words stand in the window: 1 for a copy, whatever else stands around it. A candidate is checked
on the words: the longest common subsequence with the item, and whether the item's answer (its last sentence) stands there word
for word.

* Document frequencies: all documents, in hashed buckets, summed by Spark (at most ``BUCKETS`` rows).
* Index: items go by hash into pieces of about ``PIECE_CHARS`` characters; each piece is an index of its own, which bounds what
  the driver holds and what is sent to the executors. All pieces are searched.
* Windows: items are classed by length, ``STRIDE`` words and its doubles; a class has windows of twice that length, half
  overlapping, so that a copy lies in one window as a whole.
* Latent search: every window of every document against all items of the class, block by block.
* Exact search: the same by lists of the items that hold a word. An item's most frequent words are left out of the lists up to
  ``UNLISTED`` of its weight, which is added to every sum as a bound; pairs that can reach the threshold are then scored with all
  words. No copy is lost however many items there are; tests measure the recall of the latent search against it.
* Check: every candidate window, and the best checked match of a document and item is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.llm import latent, store
from riskflow.llm.text import Words, blocks, words

BUCKETS = 1 << 18
WINDOW, STRIDE = 40, 20
MIN_COSINE = 0.45
#: Cosine in a latent space.
MIN_LATENT = 0.5
#: Characters of benchmark text in one index.
PIECE_CHARS = 4_000_000
#: Share of an item's squared weight whose words have no list.
UNLISTED = 0.1
#: Cells (window, item) that are summed at once.
CELLS = 1_000_000
#: Items with fewer words have to stand there word for word.
SHORT_ITEM = 5
#: Percent of an item's words in the common subsequence: enough alone, enough together with the answer, and enough together
#: with the answer and ``MIN_LATENT``.
LCS_ALONE, LCS_WITH_ANSWER, LCS_PARAPHRASE = 70, 50, 30
_U = np.uint64


@dataclass
class Level:
    """The items of one class of length, and for each word of the vocabulary the items that list it."""

    double: int  # windows have WINDOW << double words
    items: np.ndarray
    starts: np.ndarray  # of each word's list, and the end
    listed: np.ndarray  # place in ``items``
    share: np.ndarray  # of the item's squared weight
    rest: np.ndarray  # share of each item that is not listed
    spaces: list[latent.Space]


@dataclass
class Index:
    """What every task needs: the vocabulary and the items of one piece of the benchmark."""

    hashes: np.ndarray  # of the vocabulary, ascending
    first: np.ndarray  # of each item's distinct words, and the end
    place: np.ndarray  # in the vocabulary
    times: np.ndarray  # how often the item has the word
    share: np.ndarray  # of the item's squared weight
    item_ids: np.ndarray
    item_words: list[np.ndarray]
    answers: list[np.ndarray]
    answer_key: np.ndarray  # place of the answer's rarest word, -1 without an answer
    levels: list[Level]


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> _U(64 - 18)).astype(np.int64)


def document_frequencies(docs: DataFrame) -> np.ndarray:
    """Documents that have a word of each bucket, over all documents; the last element is their number."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for part in blocks(batch):
                found = words(part.column("text"), lower=True)
                both = np.sort(found.doc * BUCKETS + _bucket(found.hash))
                if len(both):
                    both = both[np.append(True, both[1:] != both[:-1])]
                    total += np.bincount(both % BUCKETS, minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, BUCKETS)), pa.array(np.append(total[used], n))], names=["bucket", "n"])

    found = docs.select("text").mapInArrow(rows, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS + 1, np.int64)
    for row in found.toLocalIterator():
        out[row.bucket] = row.n
    return out


def _places(hashes: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Place of each word in the vocabulary, -1 for others."""
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    return np.where(vocabulary[at] == hashes, at, -1)


@lru_cache(maxsize=4)
def _table(key: bytes, bits: int) -> np.ndarray:
    vocabulary = np.frombuffer(key, np.uint64)
    known = np.zeros(1 << bits, bool)
    known[(vocabulary >> _U(64 - bits)).astype(np.int64)] = True
    return known


def passages(found: Words, window: int = WINDOW, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, first word and end of every window: every ``stride`` words, the last one at the document's end."""
    n = found.n
    count = np.where(n > window, -(-(n - window) // stride) + 1, (n > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(n)), count)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    first = np.minimum(k * stride, np.maximum(n[doc] - window, 0)) + found.first[:-1][doc]
    return doc, first, np.minimum(first + window, found.first[1:][doc])


def _ranges(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges one after another, and the range of each."""
    size = end - begin
    of = np.repeat(np.arange(len(begin)), size)
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum())), of


def indexes(docs: DataFrame, benchmark: DataFrame) -> list[Index]:
    """The indexes of all pieces of the benchmark; none for a benchmark without words."""
    spark = docs.sparkSession
    store.prepare(spark)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("item_id IS NOT NULL AND text IS NOT NULL")
    n = -(-(items.agg(F.sum(F.length("text"))).first()[0] or 0) // PIECE_CHARS)
    counts = document_frequencies(docs) if n else None
    piece = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(n, 1)))
    found = (build_index(spark, counts, items.filter(piece == k)) for k in range(n))
    return [index for index in found if index]


def build_index(spark: SparkSession, counts: np.ndarray, items: DataFrame) -> Index | None:
    """Weigh the items' words, list them and fit their latent spaces. None without any word."""
    rows = items.orderBy("item_id", "text").collect()
    found = words(pa.array([r.text for r in rows], pa.string()), lower=True)
    long = np.flatnonzero(found.n > 0) if len(rows) else []
    if not len(long):
        return None
    idf = np.log((1 + counts[-1]) / (1 + counts[:-1])) + 1
    own = [found.hash[found.first[k] : found.first[k + 1]] for k in long]
    hashes = np.unique(np.concatenate(own))
    size = np.array([len(x) for x in own])
    key, times = np.unique(np.repeat(np.arange(len(own)), size) * len(hashes) + np.searchsorted(hashes, np.concatenate(own)), return_counts=True)
    item, place = key // len(hashes), key % len(hashes)
    square = ((1 + np.log(times)) * idf[_bucket(hashes[place])]) ** 2
    share = square / np.bincount(item, square)[item]
    first = np.searchsorted(item, np.arange(len(own) + 1))
    # Within an item, the most frequent words first: what they weigh together stays under UNLISTED.
    order = np.lexsort((-counts[_bucket(hashes[place])], item))
    total = np.append(0, np.cumsum(share[order]))
    unlisted = np.zeros(len(key), bool)
    unlisted[order] = total[1:] - total[first[:-1]][item] < UNLISTED
    rest = np.bincount(item[unlisted], share[unlisted], minlength=len(own))
    double = np.ceil(np.log2(np.maximum(size / STRIDE, 1))).astype(np.int64)
    classes = [np.flatnonzero(double == d) for d in np.unique(double)]
    groups = [(c, x) for c, items in enumerate(classes) for x in np.array_split(items, -(-len(items) // latent.BLOCK_ITEMS))]
    spaces = latent.fit(spark, [x for _, x in groups], first, place, np.sqrt(share), idf[_bucket(hashes[place])])
    levels = []
    for c, d in enumerate(np.unique(double).tolist()):
        items = classes[c]
        some = np.flatnonzero((double[item] == d) & ~unlisted)
        some = some[np.argsort(place[some], kind="stable")]
        starts = np.searchsorted(place[some], np.arange(len(hashes) + 1))
        levels.append(Level(d, items, starts, np.searchsorted(items, item[some]), share[some], rest[items], [x for (k, _), x in zip(groups, spaces) if k == c]))
    answers = [_answer(rows[k].text) for k in long]
    key = [min(np.searchsorted(hashes, x).tolist(), key=lambda at: counts[_bucket(hashes[at : at + 1])[0]], default=-1) for x in answers]
    return Index(hashes, first, place, times, share, np.array([rows[k].item_id for k in long]), own, answers, np.array(key, np.int64), levels)


def _answer(text: str) -> np.ndarray:
    """Word hashes of the last sentence of an item; empty if that is the whole item or has fewer than three words."""
    cut = max(text.rstrip().rstrip(".!?").rfind(x) for x in (". ", "? ", "! ", "\n"))
    own = words(pa.array([text[cut + 1 :]]), lower=True).hash if cut >= 0 else np.zeros(0, np.uint64)
    return own if len(own) >= 3 else own[:0]


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence; one bit for each element of ``a``."""
    places: dict[int, int] = {}
    for k, x in enumerate(a.tolist()):
        places[x] = places.get(x, 0) | 1 << k
    full = (1 << len(a)) - 1
    left = full
    for x in b.tolist():
        at = places.get(x)
        if at:
            both = left & at
            left = (left + both | left - both) & full
    return len(a) - left.bit_count()


def _contains(own: np.ndarray, part: np.ndarray) -> bool:
    if not len(part) or len(own) < len(part):
        return False
    return bool((np.lib.stride_tricks.sliding_window_view(own, len(part)) == part).all(axis=1).any())


def _candidates(place: np.ndarray, begin: np.ndarray, end: np.ndarray, level: Level, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Windows and items (places in ``level.items``) whose listed words and bound reach ``least``, some at a time."""
    size = np.diff(level.starts)
    at = np.flatnonzero((place >= 0) & (size[place] > 0))
    own, width, n = place[at], len(size), len(level.items)
    lo, hi = np.searchsorted(at, begin), np.searchsorted(at, end)
    step = max(1, min(CELLS // n, 4096 >> min(level.double, 12)))
    for k in range(0, len(begin), step):
        spots, row = _ranges(lo[k : k + step], hi[k : k + step])
        key = np.unique(row * width + own[spots])
        where, of = _ranges(level.starts[key % width], level.starts[key % width + 1])
        cell = (key // width)[of] * n + level.listed[where]
        if not len(cell):
            continue
        if 16 * len(cell) < step * n:
            cell, back = np.unique(cell, return_inverse=True)
            total = np.bincount(back, level.share[where])
        else:
            total = np.bincount(cell, level.share[where])
            cell = np.flatnonzero(total)
            total = total[cell]
        cell = cell[total + level.rest[cell % n] >= least]
        yield k + cell // n, cell % n


def _inside(spots: np.ndarray, n: int, place: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether a word stands in a range of words; ``spots`` is place * n + position of all words, ascending."""
    at = np.searchsorted(spots, place * n + begin)
    return spots[np.minimum(at, len(spots) - 1)] - place * n < np.where(at < len(spots), end, -1)


def _pairs(place: np.ndarray, begin: np.ndarray, end: np.ndarray, level: Level, least: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(window, item, latent cosine) of both searches; the cosine is 0 for pairs of the exact search."""
    known = np.flatnonzero(place >= 0)
    for space in level.spaces:
        yield from latent.search(space, known, place[known], begin, end, MIN_LATENT)
    for window, item in _candidates(place, begin, end, level, least):
        yield window, level.items[item], np.zeros(len(item), np.float32)


def _hits(found: Words, index: Index, min_cosine: float) -> list[tuple]:
    """(document, item, cosine, common words, answer found, first word, latent cosine) of the best match of each item in a document."""
    known = _table(index.hashes.tobytes(), 20)[(found.hash >> _U(44)).astype(np.int64)]
    place = np.full(len(found.hash), -1, np.int64)
    at = np.flatnonzero(known)
    place[at] = _places(found.hash[at], index.hashes)
    at, n = np.flatnonzero(place >= 0), len(place) + 1
    if not len(at):
        return []
    spots = np.sort(place[at] * n + at)
    least = min_cosine * min_cosine - 1e-9
    words_of = np.array([len(x) for x in index.item_words], np.int64)
    best: dict[tuple[int, int], tuple] = {}
    for level in index.levels:
        doc, begin, end = passages(found, WINDOW << level.double, STRIDE << level.double)
        for window, item, cosine in _pairs(place, begin, end, level, least):
            for k in range(0, len(item), 20_000):
                w, i, near_by = window[k : k + 20_000], item[k : k + 20_000], cosine[k : k + 20_000]
                size = words_of[i]
                each, of = _ranges(index.first[i], index.first[i + 1])
                lo, hi = np.maximum(found.first[doc[w]], begin[w] - size), np.minimum(found.first[doc[w] + 1], end[w] + size)
                share = np.bincount(of, index.share[each] * _inside(spots, n, index.place[each], begin[w][of], end[w][of]), minlength=len(i))
                most = np.bincount(of, index.times[each] * _inside(spots, n, index.place[each], lo[of], hi[of]), minlength=len(i))
                # An answer can only stand where its rarest word does.
                key = index.answer_key[i]
                may = (key >= 0) & _inside(spots, n, np.maximum(key, 0), lo, hi)
                enough = np.where(near_by > 0, LCS_PARAPHRASE, LCS_WITH_ANSWER)
                reach = 100 * most >= np.where(may, enough, LCS_ALONE) * size
                for x in np.flatnonzero(((near_by > 0) | (share >= least)) & reach).tolist():
                    own, near = index.item_words[i[x]], found.hash[lo[x] : hi[x]]
                    answer = bool(may[x]) and _contains(near, index.answers[i[x]])
                    if len(own) < SHORT_ITEM:
                        need = 100 if _contains(near, own) else 101
                    else:
                        need = int(enough[x]) if answer else LCS_ALONE
                    if 100 * most[x] < need * len(own):
                        continue
                    common = common_subsequence(own, near)
                    if 100 * common >= need * len(own):
                        d = int(doc[w[x]])
                        new = (common, answer, min(1.0, float(np.sqrt(share[x]))), -int(begin[w[x]] - found.first[d]), float(near_by[x]))
                        best[d, int(i[x])] = max(new, best.get((d, int(i[x])), new))
    return [(d, item, cosine, common, answer, -at, near_by) for (d, item), (common, answer, cosine, at, near_by) in sorted(best.items())]


_MATCH = "array<struct<item_id:bigint,cosine:double,common_words:bigint,item_words:bigint,answer:boolean,at:bigint,latent:double>>"


def mark(docs: DataFrame, index: Index | None, carry: list[str], min_cosine: float = MIN_COSINE) -> DataFrame:
    """Every document with ``matches``: the benchmark items it contains. Carried columns keep their values.

    A match has a cosine of ``min_cosine`` or more between the item and what a window covers of it, or of ``MIN_LATENT`` in the
    latent space, and around the window (one length of the item to either side) either ``LCS_ALONE`` percent of the item's words as
    a common subsequence, or ``LCS_WITH_ANSWER`` percent (``LCS_PARAPHRASE`` for a latent match) and the item's answer word for word.
    Items with fewer than ``SHORT_ITEM`` words have to stand there word for word. Words are compared with A-Z in lower case. Null and
    empty texts match nothing; repeated rows match alike; items without id, text or words are not searched; an empty benchmark
    matches nothing.
    """
    spark = docs.sparkSession
    store.prepare(spark)
    names, text, out = [*carry], "_text_", "matches"
    while text in names:
        text += "_"
    if out in names:
        raise ValueError("column 'matches' would be written twice")
    schema = T.StructType([*(docs.schema[c] for c in carry), T.StructField(out, T._parse_datatype_string(_MATCH))])
    own = docs.select(*(F.col(c) for c in carry), F.col("text").alias(text))
    shared = spark.sparkContext.broadcast(index)
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("cosine", pa.float64()), ("common_words", pa.int64()), ("item_words", pa.int64()), ("answer", pa.bool_()), ("at", pa.int64()), ("latent", pa.float64())]))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for part in blocks(batch, text):
                matches: list[list[dict]] = [[] for _ in range(part.num_rows)]
                for d, item, cosine, common, answer, at, near in _hits(words(part.column(text), lower=True), index, min_cosine) if index else []:
                    matches[d].append({"item_id": int(index.item_ids[item]), "cosine": cosine, "common_words": common, "item_words": len(index.item_words[item]), "answer": answer, "at": at, "latent": near})
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(matches, kind)], names=[*names, out])

    return own.mapInArrow(rows, schema)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item found in it; ``latent`` is 0 where only the exact search found it."""
    pieces = [mark(docs, index, ["doc_id"]) for index in indexes(docs, benchmark) or [None]]
    found = reduce(DataFrame.unionByName, pieces).select("doc_id", F.explode("matches").alias("m"))
    return found.select("doc_id", "m.item_id", F.round("m.cosine", 4).alias("cosine"), "m.common_words", "m.item_words", "m.answer", "m.at", F.round("m.latent", 4).alias("latent"))


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a match, with the columns they came with."""
    columns = docs.columns
    found = indexes(docs, benchmark)
    if "matches" in columns:
        inner = docs.select(F.struct(*(F.col(c) for c in columns)).alias("row"), "text")
        for index in found:
            inner = mark(inner, index, ["row", "text"]).filter(F.size("matches") == 0).select("row", "text")
        return inner.select("row.*")
    for index in found:
        docs = mark(docs, index, columns).filter(F.size("matches") == 0).select(*columns)
    return docs
