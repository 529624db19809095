"""Removal of long repeated passages by recompression of word sequences.

Recompression shortens a sequence in rounds: first runs of one word, then pairs (a, b) of neighbours get one symbol, where
a random half of all symbols may only stand left and the other half only right. Whether and to what symbol neighbours
combine depends on the neighbours alone, so equal passages turn into equal symbols everywhere but near their ends.

Names are global: the name of a symbol is a 64-bit hash of the names it combines, so every task gives equal content the same
name and no dictionary has to be shuffled between rounds. Which names are shared is decided over the whole corpus by Spark.

Spans are capped (``CAPS``: words in a run, then words in a pair, by round). A round can spoil at most ``cap - 1`` words at
either end of an equal passage (the runs: ``cap``), together ``MARGIN``. So each symbol that lies inside a window but for
``MARGIN`` words at either end is found in every equal window, and since spans are at most the last cap there is one. The
symbol with the least name, taken with the ``MARGIN`` words before and after it, is the window's sign:

1. count in how many documents each sign occurs, and tell every document which of its signs occur elsewhere;
2. for windows with a shared sign only, find the smallest ``doc_id`` among equal windows, compared by sign and by a hash of
   all their words (128 bits together): first for whole runs of windows with one sign, then window by window among runs
   that differ;
3. remove the words under windows that also start in a smaller ``doc_id``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm import store
from riskflow.llm.text import Words, blocks, hash_ranges, mix, windows, words

WINDOW = 50
RUN_CAP = 2
CAPS = (2, 4, 4, 8)
MARGIN = RUN_CAP + sum(c - 1 for c in CAPS)
_U = np.uint64


def recompress(found: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all documents of a block: name, first word and span."""
    name, span = found.hash.copy(), np.ones(len(found.hash), np.int64)
    doc = found.doc
    if not len(name):
        return name, np.zeros(0, np.int64), span
    same = np.zeros(len(name) + 1, bool)
    same[1:-1] = (name[1:] == name[:-1]) & (doc[1:] == doc[:-1])
    heads = np.flatnonzero(~same[:-1])
    length = np.diff(np.append(heads, len(name)))
    whole = (length > 1) & (length <= RUN_CAP)
    keep = np.ones(len(name), bool)
    for k in range(1, RUN_CAP):
        keep[heads[whole & (length > k)] + k] = False
    run = heads[whole]
    name[run] = mix(name[run] * _U(0xC2B2AE3D27D4EB4F) + length[whole].astype(np.uint64))
    span[run] = length[whole]
    name, span, doc = name[keep], span[keep], doc[keep]
    for k, cap in enumerate(CAPS):
        side = (mix(name + _U(0x9E3779B97F4A7C15 * (k + 1) & (1 << 64) - 1)) >> _U(63)).astype(bool)
        left = np.flatnonzero(~side[:-1] & side[1:] & (doc[:-1] == doc[1:]) & (span[:-1] + span[1:] <= cap))
        name[left] = mix(name[left] * _U(0xD6E8FEB86659FD93) + mix(name[left + 1] + _U(k + 1)))
        span[left] += span[left + 1]
        keep = np.ones(len(name), bool)
        keep[left + 1] = False
        name, span, doc = name[keep], span[keep], doc[keep]
    return name, np.cumsum(span) - span, span


def signs(found: Words, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every window within a document: its sign, the hash of its words and its first word."""
    value, at = windows(found, size)
    if not len(at):
        return value, value, at
    name, first, span = recompress(found)
    lo = np.searchsorted(first, at + MARGIN)
    hi = np.searchsorted(first + span, at + size - MARGIN, side="right")  # symbols lo to hi - 1 lie inside
    n = hi - lo
    least, low, chosen = np.arange(len(name)), 1, np.empty(len(at), np.int64)
    while True:  # the least of a range is that of two overlapping ranges whose length is a power of two
        now = np.flatnonzero((n >= low) & (n < 2 * low))
        chosen[now] = _lesser(name, least[lo[now]], least[hi[now] - low])
        if (n < 2 * low).all():
            break
        least, low = _lesser(name, least[:-low], least[low:]), 2 * low
    begin, end = first[chosen] - MARGIN, first[chosen] + span[chosen] + MARGIN
    return mix(name[chosen] ^ hash_ranges(found, begin, end)), value, at


def _lesser(name: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The symbol with the smaller name; of equal names the first."""
    return np.where(name[b] < name[a], b, a)


def _check(size: int) -> None:
    if size < 2 * MARGIN + 2 * CAPS[-1] - 1:
        raise ValueError(f"windows need {2 * MARGIN + 2 * CAPS[-1] - 1} words or more")


def _keyed(docs: DataFrame) -> DataFrame:
    """Id and text, with a key that rows share only if they are equal in both."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "row", F.xxhash64(F.lit(7), F.col("doc_id").isNull(), "doc_id", "text"))


def shared_signs(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per document (by ``row``): its signs that occur in another document too."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch):
                found = words(part.column("text"))
                sign, _, at = signs(found, size)
                new = np.ones(len(sign), bool)
                doc = found.doc[at] if len(at) else at
                new[1:] = (sign[1:] != sign[:-1]) | (doc[1:] != doc[:-1])
                both = np.unique(np.rec.fromarrays([doc[new], sign[new].view(np.int64)]))
                row = part.column("row").to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(row[both.f0]), pa.array(both.f1)], names=["row", "sign"])

    own = _keyed(docs).select("row", "text").mapInArrow(rows, "row bigint, sign bigint")
    own = store.keep(own, "signs")
    twice = own.groupBy("sign").agg(F.min("row").alias("a"), F.max("row").alias("b")).filter("a != b").select("sign")
    return own.join(twice, "sign").groupBy("row").agg(F.collect_set("sign").alias("signs"))


def _runs(docs: DataFrame, shared: DataFrame, size: int) -> DataFrame:
    """Runs of consecutive windows with one shared sign: the sign, a hash of the run's words, place and window hashes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch):
                found = words(part.column("text"))
                sign, value, at = signs(found, size)
                doc = found.doc[at] if len(at) else at
                lists = part.column("signs")
                own = mix(lists.flatten().to_numpy().view(np.uint64) ^ np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy()).astype(np.uint64) * _U(0x9E3779B97F4A7C15))
                head = np.ones(len(sign), bool)
                head[1:] = (sign[1:] != sign[:-1]) | (doc[1:] != doc[:-1])
                head = np.flatnonzero(head)
                n = np.diff(np.append(head, len(sign)))
                place = (np.arange(len(sign)) - np.repeat(head, n)).astype(np.uint64)
                whole = np.add.reduceat(mix(value + place * _U(0xC2B2AE3D27D4EB4F)), head) if len(head) else value
                hit = np.isin(mix(sign[head] ^ doc[head].astype(np.uint64) * _U(0x9E3779B97F4A7C15)), own)
                values = pa.LargeListArray.from_arrays(pa.array(np.append(head, len(sign)), pa.int64()), pa.array(value.view(np.int64))).filter(pa.array(hit)).cast(pa.list_(pa.int64()))
                head, n, whole = head[hit], n[hit], whole[hit]
                yield pa.RecordBatch.from_arrays([
                    pa.array(sign[head].view(np.int64)), pa.array(whole.view(np.int64)), pa.array(n, pa.int32()), pa.array(part.column("row").to_numpy()[doc[head]]),
                    part.column("doc_id").take(pa.array(doc[head])), pa.array(at[head] - found.first[doc[head]], pa.int32()), values,
                ], names=["sign", "whole", "n", "row", "doc_id", "at", "values"])

    own = _keyed(docs).join(shared, "row").select("row", "doc_id", "text", "signs")
    return own.mapInArrow(rows, "sign bigint, whole bigint, n int, row bigint, doc_id bigint, at int, values array<bigint>")


def repeated_windows(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per document (by ``row``) that loses words: its windows that also start in a smaller ``doc_id``, as ranges.

    Consecutive windows with one sign form a run. Of equal runs, those after the smallest ``doc_id`` are repeats as a
    whole. Only the windows of the first of each kind of run are then compared one by one, where a sign has several kinds:
    for every window there, the smallest document that has it is the first of one of these runs.
    """
    shared = store.keep(shared_signs(docs, size), "shared-signs")
    runs = store.keep(_runs(docs, shared, size), "runs")
    store.remove(docs.sparkSession, [shared])
    kinds = runs.groupBy("sign", "whole", "n").agg(F.min("doc_id").alias("first")).filter("first IS NOT NULL")
    kinds = store.keep(kinds, "kinds")
    several = kinds.groupBy("sign").agg(F.count("*").alias("kinds")).filter("kinds > 1").select("sign")
    firsts = runs.join(kinds.withColumnRenamed("first", "doc_id"), ["sign", "whole", "n", "doc_id"]).join(several, "sign")
    firsts = store.keep(firsts.select("sign", "doc_id", "row", "at", F.posexplode("values").alias("k", "value")), "first-windows")
    least = firsts.groupBy("sign", "value").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last").drop("last")
    one = firsts.join(least, ["sign", "value"]).filter(F.col("first") < F.col("doc_id")).select("row", (F.col("at") + F.col("k")).alias("at"), F.lit(1).alias("n"))
    whole = runs.join(kinds, ["sign", "whole", "n"]).filter(F.col("first") < F.col("doc_id")).select("row", "at", "n")
    out = store.keep(whole.unionByName(one).groupBy("row").agg(F.collect_set(F.struct("at", "n")).alias("ranges")), "repeats")
    store.remove(docs.sparkSession, [runs, kinds, firsts])
    return out


def _under(n: int, ranges: pa.StructArray, size: int) -> np.ndarray:
    """Which of ``n`` words lie under the windows of the ranges."""
    edge = np.zeros(n + 1, np.int64)
    at, count = (ranges.field(k).to_numpy().astype(np.int64) for k in ("at", "n"))
    np.add.at(edge, at, 1)
    np.subtract.at(edge, at + count - 1 + size, 1)
    return np.cumsum(edge)[:n] > 0


def remove_repeats(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """Every document with the words that remain: doc_id, text (joined by one space), n_words, n_removed, kept_sha256.

    A word goes when a window of ``size`` consecutive words that covers it has the same words as a window that starts in a
    document with a smaller ``doc_id``. Windows are those of the input. Whole texts are compared, whatever their length; a
    text shorter than the window, empty or null keeps all its words. Repeated rows are treated alike and each is returned; a
    document without an id neither loses words nor takes them from others. Other columns are not read.
    """
    store.prepare(docs.sparkSession)
    _check(size)
    ranges = repeated_windows(docs, size)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, n, gone, sha = [], [], [], []
            for value, lost in zip(batch.column("text"), batch.column("ranges")):
                own = value.as_buffer().to_pybytes().split() if value.is_valid else []
                n.append(len(own))
                if lost.is_valid:
                    out = _under(len(own), lost.values, size)
                    own = [w for w, x in zip(own, out.tolist()) if not x]
                gone.append(n[-1] - len(own))
                text.append(b" ".join(own))
                sha.append(hashlib.sha256(text[-1]).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(text, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha)], names=["doc_id", "text", "n_words", "n_removed", "kept_sha256"])

    joined = _keyed(docs).join(ranges, "row", "left").select("doc_id", "text", "ranges")
    return joined.mapInArrow(rows, "doc_id bigint, text string, n_words bigint, n_removed bigint, kept_sha256 string")
