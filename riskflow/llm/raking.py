"""Mixing sources to target weights: iterative proportional fitting of token counts, then sampling documents.

Documents fall into cells (source, language, topic). Raking finds one factor for every source, language and topic so that
the cells' tokens, times their factors, meet the target totals of all three. Languages and topics are few (declared with
``targets``, or as many as the data has); sources are many and stay in Spark: for given language and topic factors the factor
of a source follows from its own cells, so a round is one pass over the cell table that returns languages times topics sums.
Documents are then kept with a probability in proportion to their cell's weight, by a hash of id and text.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.llm import store
from riskflow.llm.text import blocks, words

TOPICS = 8
FEATURES = 512
ROUNDS = 20
ONE = 1 << 24
NONE = ""
_U = np.uint64


def _units(counts: np.ndarray) -> np.ndarray:
    """Damped counts at unit length."""
    rows = np.sqrt(counts.astype(np.float32))
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


def _counts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed words of each text, and its number of words."""
    found = words(column, lower=True)
    n = len(found.n)
    return np.bincount(found.doc * FEATURES + (found.hash >> _U(55)).astype(np.int64), minlength=n * FEATURES).reshape(n, FEATURES), found.n


def _stored_counts(docs: DataFrame) -> DataFrame:
    """The counts above zero of every document with a word, many documents to a row.

    (docs, ends, slot, n): how many documents, where the counts of each end, and slots and counts as arrays of bytes, which
    pass between Spark and Python whole.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch):
                counts, n = _counts(part.column("text"))
                counts = counts[n > 0]
                doc, slot = np.nonzero(counts)
                ends = np.searchsorted(doc, np.arange(1, len(counts) + 1))
                packed = (ends.astype(np.int32), slot.astype(np.int16), counts[doc, slot].astype(np.int32))
                if len(counts):
                    yield pa.RecordBatch.from_arrays([pa.array([len(counts)], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in packed)], names=["docs", "ends", "slot", "n"])

    return store.keep(docs.select("text").filter("text IS NOT NULL").mapInArrow(rows, "docs int, ends binary, slot binary, n binary"), "profiles")


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Where the counts of each document of a stored row end, their slots and the counts."""
    for batch in batches:
        for packed in zip(*(batch.column(c) for c in ("ends", "slot", "n"))):
            yield tuple(np.frombuffer(x.as_buffer(), t) for x, t in zip(packed, (np.int32, np.int16, np.int32)))


def _stored_units(ends: np.ndarray, slot: np.ndarray, n: np.ndarray) -> np.ndarray:
    rows = np.zeros((len(ends), FEATURES), np.float32)
    rows[np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0)), slot] = n
    return _units(rows)


def _farthest(profiles: DataFrame, centres: np.ndarray) -> np.ndarray | None:
    """The document least like all centres; of equals the one with the smallest slots and counts."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ends, slot, n in _unpacked(batches):
            near = np.round((_stored_units(ends, slot, n) @ centres.T).max(axis=1, initial=0.0), 4).astype(float)
            least = np.flatnonzero(near == near.min())
            own = [slice(ends[k - 1] if k else 0, ends[k]) for k in least]
            lists = [pa.array([x[at] for at in own], pa.list_(t)) for x, t in ((slot, pa.int16()), (n, pa.int32()))]
            yield pa.RecordBatch.from_arrays([pa.array(near[least]), *lists], names=["near", "slot", "n"])

    found = profiles.mapInArrow(rows, "near double, slot array<smallint>, n array<int>").orderBy("near", "slot", "n").limit(1).collect()
    if not found or found[0]["near"] >= 0.9999:  # no document differs from all centres
        return None
    counts = np.zeros((1, FEATURES))
    counts[0, found[0]["slot"]] = found[0]["n"]
    return _units(counts)


def _sums(profiles: DataFrame, centres: np.ndarray) -> np.ndarray:
    """Sums of the profiles nearest to each centre. Whole numbers, so they don't depend on how documents are dealt to tasks."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centres), FEATURES), np.int64)
        for ends, slot, n in _unpacked(batches):
            x = _stored_units(ends, slot, n)
            own = np.round(x @ centres.T, 4).argmax(axis=1)
            x = np.rint(x * np.float32(ONE)).astype(np.int64)
            for k in range(len(centres)):
                total[k] += x[own == k].sum(axis=0)
        k, slot = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(slot.astype(np.int32)), pa.array(total[k, slot])], names=["k", "slot", "total"])

    out = np.zeros((len(centres), FEATURES), np.int64)
    for r in profiles.mapInArrow(rows, "k int, slot int, total bigint").groupBy("k", "slot").agg(F.sum("total").alias("total")).collect():
        out[r["k"], r["slot"]] = r["total"]
    return out


def fit_topics(docs: DataFrame, topics: int = TOPICS, rounds: int = ROUNDS) -> np.ndarray:
    """Topic centres by k-means over all documents with a word.

    Each document's word counts are stored once; every round is one pass over them that returns sums of each topic. Centres
    start as documents far from each other, and stay as they are when no document is nearest to them.
    """
    store.prepare(docs.sparkSession)
    profiles = _stored_counts(docs)
    centres = np.zeros((0, FEATURES), np.float32)
    while len(centres) < topics and (one := _farthest(profiles, centres)) is not None:
        centres = np.vstack([centres, one])
    if not len(centres):
        centres = np.zeros((1, FEATURES), np.float32)
        rounds = 0
    for _ in range(rounds):
        sums = _sums(profiles, centres).astype(np.float64)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        new = np.where(length > 0, sums / np.maximum(length, 1e-9), centres).astype(np.float32)
        if np.array_equal(new, centres):
            break
        centres = new
    store.remove(docs.sparkSession, [profiles])
    return centres


def with_topics(docs: DataFrame, centres: np.ndarray, carry: list[str], tokens: str = "mix_tokens", topic: str = "mix_topic") -> DataFrame:
    """Documents with their number of words and nearest topic, over whole texts."""
    store.prepare(docs.sparkSession)
    names, text = [*carry], "_text_"
    while text in names:
        text += "_"
    schema = T.StructType([*(docs.schema[c] for c in carry), T.StructField(tokens, T.LongType()), T.StructField(topic, T.StringType())])
    shared = docs.sparkSession.sparkContext.broadcast(centres)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, text):
                counts, n = _counts(part.column(text))
                nearest = np.round(_units(counts) @ shared.value.T, 4).argmax(axis=1)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(n, pa.int64()), pa.array([f"topic{k}" for k in nearest])], names=[*names, tokens, topic])

    return docs.select(*(F.col(c) for c in carry), F.col("text").alias(text)).mapInArrow(rows, schema)


def tempered(totals: dict, power: float) -> dict:
    """Target shares in proportion to a power of the totals; categories without tokens get none."""
    raised = {k: float(v) ** power if v else 0.0 for k, v in totals.items()}
    whole = sum(raised.values())
    return {k: v / whole if whole else 0.0 for k, v in raised.items()}


class Rake:
    """Factors of languages and topics, and the constant that scales probabilities to the token budget."""

    def __init__(self, languages: dict[str, float], topics: dict[str, float], scale: float, rounds: int, worst: float):
        self.languages, self.topics, self.scale, self.rounds, self.worst = languages, topics, scale, rounds, worst


def cells(rows: DataFrame, source: str = "source", language: str = "lang", topic: str = "mix_topic", tokens: str = "mix_tokens") -> DataFrame:
    """Tokens and documents of each cell; a null category counts as an empty name."""
    name = lambda c, a: F.coalesce(F.col(c).cast("string"), F.lit(NONE)).alias(a)
    return rows.select(name(source, "source"), name(language, "language"), name(topic, "topic"), F.col(tokens).alias("tokens")).groupBy("source", "language", "topic").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs"))


def _factor(values: dict[str, float], column: str) -> F.Column:
    out = F.lit(0.0)
    for k, v in values.items():
        out = F.when(F.col(column) == F.lit(k), F.lit(float(v))).otherwise(out)
    return out


def rake(table: DataFrame, power: float = 0.5, budget: float = 0.5, rounds: int = 50, tolerance: float = 1e-6) -> tuple[DataFrame, Rake]:
    """The cell table with ``weight`` (factor of the cell) and ``probability``.

    Targets are the tokens of each source, language and topic raised to ``power``, in shares. ``budget`` is the share of all
    tokens to sample; probabilities are ``min(1, scale * weight)`` with the scale that meets it in expectation. Rounds end
    when language and topic totals are within ``tolerance`` of their targets (source totals are exact after each).
    """
    table = store.keep(table.filter("tokens > 0"), "cells")
    whole = float(table.agg(F.sum("tokens")).first()[0] or 0)
    sums = {c: {r[0]: r[1] for r in table.groupBy(c).agg(F.sum("tokens")).toLocalIterator()} for c in ("language", "topic")}
    if not whole:
        return table.withColumns({"weight": F.lit(0.0), "probability": F.lit(0.0)}), Rake({}, {}, 0.0, 0, 0.0)
    goal = {c: tempered(s, power) for c, s in sums.items()}
    by_source = table.groupBy("source").agg(F.sum("tokens").alias("all"))
    by_source = by_source.withColumn("p", F.pow(F.col("all").cast("double"), F.lit(power)))
    total = by_source.agg(F.sum("p")).first()[0]
    by_source = by_source.select("source", (F.col("p") / F.lit(total) * F.lit(whole)).alias("goal"))
    pairs = list(product(sorted(sums["language"]), sorted(sums["topic"])))
    of = lambda a, b: F.sum(F.when((F.col("language") == a) & (F.col("topic") == b), F.col("tokens")).otherwise(0)).cast("double")
    wide = table.groupBy("source").agg(F.array(*(of(a, b) for a, b in pairs)).alias("c"))
    wide = store.keep(wide.join(by_source, "source").select("source", "goal", "c"), "sources")
    lang, top = {a: 1.0 for a in sums["language"]}, {b: 1.0 for b in sums["topic"]}
    goal_l = {a: goal["language"][a] * whole for a in lang}
    goal_t = {b: goal["topic"][b] * whole for b in top}
    done, worst = 0, float("inf")
    while done < rounds and worst > tolerance:
        product_ = F.array(*(F.lit(lang[a] * top[b]) for a, b in pairs))
        own = wide.select("goal", "c", F.zip_with("c", product_, lambda x, y: x * y).alias("w"))
        own = own.withColumn("f", F.col("goal") / F.aggregate("w", F.lit(0.0), lambda x, y: x + y))
        row = own.agg(*(F.sum(F.col("f") * F.col("c")[k]).alias(f"c{k}") for k in range(len(pairs)))).first()
        m = {pair: float(row[k] or 0) for k, pair in enumerate(pairs)}
        worst = max([abs(sum(m[a, b] * lang[a] * top[b] for b in top) - goal_l[a]) / whole for a in lang] + [abs(sum(m[a, b] * lang[a] * top[b] for a in lang) - goal_t[b]) / whole for b in top])
        if worst > tolerance:
            lang = {a: goal_l[a] / s if (s := sum(m[a, b] * top[b] for b in top)) else 0.0 for a in lang}
            top = {b: goal_t[b] / s if (s := sum(m[a, b] * lang[a] for a in lang)) else 0.0 for b in top}
        done += 1
    product_ = F.array(*(F.lit(lang[a] * top[b]) for a, b in pairs))
    sources = wide.withColumn("w", F.zip_with("c", product_, lambda x, y: x * y)).select("source", (F.col("goal") / F.aggregate("w", F.lit(0.0), lambda x, y: x + y)).alias("f"))
    weighted = table.join(sources, "source").withColumn("weight", F.col("f") * _factor(lang, "language") * _factor(top, "topic")).drop("f")
    weighted = store.keep(weighted, "weights")
    wanted = budget * whole

    def got(scales: list[float]) -> list[float]:
        return list(weighted.agg(*(F.sum(F.col("tokens") * F.least(F.lit(1.0), F.col("weight") * s)).alias(f"s{k}") for k, s in enumerate(scales))).first())

    steps = [0.0, *(2.0**k for k in range(31))]
    for _ in range(6):  # each pass tries 32 scales and keeps the interval in which the budget is met
        k = next((k for k, x in enumerate(got(steps)) if k and x >= wanted * (1 - 1e-9)), len(steps) - 1)
        low, high = steps[k - 1], steps[k]
        steps = [low + (high - low) * j / 31 for j in range(32)]
    return weighted.withColumn("probability", F.round(F.least(F.lit(1.0), F.col("weight") * high), 6)), Rake(lang, top, high, done, worst)


def draw() -> F.Column:
    """A number from 0 to 1 that depends on id and text only."""
    return F.pmod(F.xxhash64(F.lit(23), F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)), F.coalesce("text", F.lit(""))), F.lit(1_000_003)) / 1_000_003


def sample(docs: DataFrame, power: float = 0.5, budget: float = 0.5, topics: int = TOPICS) -> DataFrame:
    """All documents with their cell, tokens, probability and whether they are sampled; ``row`` holds what they came with.

    Null source or language is a category of its own; null and empty texts have no tokens, no probability and are not
    sampled. Equal rows are sampled alike. No documents give no rows.
    """
    marked = docs.select(F.struct("*").alias("row"), "text", "source", "lang", draw().alias("mix_draw"))
    marked = with_topics(marked, fit_topics(docs, topics), ["row", "source", "lang", "mix_draw"])
    table, _ = rake(cells(marked), power, budget)
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(NONE))
    keyed = marked.select("row", "mix_tokens", "mix_draw", name("source").alias("source"), name("lang").alias("language"), F.col("mix_topic").alias("topic"))
    joined = keyed.join(table.select("source", "language", "topic", "weight", "probability"), ["source", "language", "topic"], "left")
    probability = F.when(F.col("mix_tokens") > 0, F.coalesce("probability", F.lit(0.0))).otherwise(0.0)
    return joined.select("row", "source", "language", "topic", F.col("mix_tokens").alias("n_tokens"), probability.alias("probability"), (F.col("mix_draw") < probability).alias("sampled"))


def keep_sampled(docs: DataFrame, **settings) -> DataFrame:
    """The sampled documents with the columns they came with."""
    return sample(docs, **settings).filter("sampled").select("row.*")
