"""Line deduplication by pairwise alignment: shared runs of lines find overlapping documents, patience diff aligns them.

1. Lines (cut at newline, compared without white space at the ends; lines without a word are left out) are hashed. From every line
   on, the shortest run of lines with ``min_words`` words or more is a key; every block that can be deleted begins with one.
2. A key leads to the smallest ``doc_id`` that holds the run. All of them that are earlier are a document's partners, however
   many; later documents change nothing.
3. The line hashes of both documents are aligned by patience diff: lines that occur once in both, in the longest increasing
   order, then the equal lines next to them, then the gaps in between in the same way; a gap without a line that occurs once in
   both by the longest common subsequence.
4. Blocks of aligned lines with ``min_words`` words or more are deleted from the later document.

Every deleted line stands in an earlier document, and the earliest holder of a line never loses it.
"""

from __future__ import annotations

import hashlib
from array import array
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm import store
from riskflow.operators.joins import join_unique

MIN_WORDS = 8
#: Bound on the runs that are joined by broadcast: as many can share a 1/FREQUENT part of all shared occurrences each.
FREQUENT = 10_000
#: Partners of one earlier document beyond which the join with its lines is salted.
HOT_PARTNERS = 500
#: Bits of the table of a longest common subsequence; a larger one is cut in halves.
TABLE_BITS = 1 << 30


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned places (in ``a``, in ``b``) of equal items, increasing in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        anchors = _increasing(_once(a, a0, a1, b, b0, b1))
        if not anchors:
            out += [(a0 + x, b0 + y) for x, y in _common(a[a0:a1], b[b0:b1])]
            continue
        ends = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        out += anchors
        todo += [(x + 1, u, y + 1, v) for (x, y), (u, v) in zip(ends, ends[1:])]
    return sorted(out)


def _once(a: list[int], a0: int, a1: int, b: list[int], b0: int, b1: int) -> list[tuple[int, int]]:
    """Places of items that occur once in either range, by place in ``a``."""
    def places(items: list[int], first: int, last: int) -> dict[int, int]:
        seen: dict[int, int] = {}
        for k in range(first, last):
            seen[items[k]] = k if items[k] not in seen else -1
        return seen

    in_b = places(b, b0, b1)
    return sorted((k, in_b[x]) for x, k in places(a, a0, a1).items() if k >= 0 and in_b.get(x, -1) >= 0)


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence that increases in the second place."""
    tops: list[int] = []
    last: list[int] = []
    before: list[int] = []
    for k, (_, y) in enumerate(pairs):
        pile = bisect_left(tops, y)
        before.append(last[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(y)
            last.append(k)
        else:
            tops[pile], last[pile] = y, k
    out, k = [], last[-1] if last else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def _table(a: list[int], b: list[int]) -> Iterator[int]:
    """After each item of ``a``: bit k is 0 where item k of ``b`` lengthens the longest common subsequence."""
    places: dict[int, int] = {}
    for k, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << k
    full = left = (1 << len(b)) - 1
    for x in a:
        both = left & places.get(x, 0)
        left = (left + both | left - both) & full
        yield left


def _common(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Places of a longest common subsequence."""
    in_a, in_b = set(a), set(b)
    at_a, at_b = [k for k, x in enumerate(a) if x in in_b], [k for k, x in enumerate(b) if x in in_a]
    a, b = [a[k] for k in at_a], [b[k] for k in at_b]
    out: list[tuple[int, int]] = []
    if len(a) > 1 and len(a) * len(b) > TABLE_BITS:
        half = len(a) // 2
        head, tail = 0, 0
        for head in _table(a[:half], b):
            pass
        for tail in _table(a[half:][::-1], b[::-1]):
            pass
        # Where to cut b: longest of the first half up to there and of the second half from there.
        best = now = len(b) - tail.bit_count()
        cut = 0
        ahead, behind = f"{head:0{len(b)}b}"[::-1], f"{tail:0{len(b)}b}"
        for k in range(len(b)):
            now += (ahead[k] == "0") - (behind[k] == "0")
            if now > best:
                best, cut = now, k + 1
        out = _common(a[:half], b[:cut]) + [(half + x, cut + y) for x, y in _common(a[half:], b[cut:])]
    elif a:
        table, x, y = list(_table(a, b)), len(a), len(b)
        while x and y:
            if a[x - 1] == b[y - 1]:
                x, y = x - 1, y - 1
                out.append((x, y))
            elif table[x - 1] >> (y - 1) & 1:
                y -= 1
            else:
                x -= 1
        out.reverse()
    return [(at_a[x], at_b[y]) for x, y in out]


def _runs(hashes: list[int], counts: list[int], min_words: int) -> list[int]:
    """Hash of the shortest run of ``min_words`` words or more from each line with a word, without repeats."""
    own = [(x, n) for x, n in zip(hashes, counts) if x >= 0]
    raw = array("q", [x for x, _ in own]).tobytes()
    found, end, total = [], 0, 0
    for k, (_, n) in enumerate(own):
        while end < len(own) and total < min_words:
            total, end = total + own[end][1], end + 1
        if total < min_words:
            break
        found.append(xxhash.xxh64_intdigest(raw[8 * k : 8 * end]) >> 1)
        total -= n
    return list(dict.fromkeys(found))


def _lines(text: bytes) -> list[bytes]:
    return text.split(b"\n")


def _hash(line: bytes) -> int:
    """63 bits of a line without white space at its ends; -1 without a word."""
    bare = line.strip()
    return xxhash.xxh64_intdigest(bare) >> 1 if bare else -1


def _keyed(docs: DataFrame) -> DataFrame:
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return own.withColumn("row", F.xxhash64(F.lit(11), F.col("doc_id").isNull(), "doc_id", "text"))


def _line_table(docs: DataFrame, min_words: int) -> DataFrame:
    """Line hashes, word counts and run hashes of every document with an id."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, counts, runs = [], [], []
            for value in batch.column("text"):
                lines = _lines(value.as_buffer().to_pybytes())
                hashes.append([_hash(x) for x in lines])
                counts.append([len(x.split()) for x in lines])
                runs.append(_runs(hashes[-1], counts[-1], min_words))
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), pa.array(hashes, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int32())), pa.array(runs, pa.list_(pa.int64()))], names=["row", "doc_id", "lines", "words", "runs"])

    return _keyed(docs).filter("doc_id IS NOT NULL").mapInArrow(rows, "row bigint, doc_id bigint, lines array<bigint>, words array<int>, runs array<bigint>")


def overlaps(table: DataFrame) -> DataFrame:
    """Pairs (row, earlier document) such that the document is the first holder of one of the row's runs.

    A run with a 1/``FREQUENT`` part of all shared occurrences or more is frequent. At most ``FREQUENT`` runs can be, so
    they are broadcast, and a run that a third of the documents hold is not gathered in one task.
    """
    run = table.select("row", "doc_id", F.explode("runs").alias("run"))
    held = run.groupBy("run").agg(F.count("*").alias("df"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last").drop("last")
    held = store.keep(held, "shared-runs")
    most = (held.agg(F.sum("df")).first()[0] or 0) / FREQUENT
    often, seldom = held.filter(F.col("df") >= most), held.filter(F.col("df") < most)
    marked = run.join(F.broadcast(often), "run", "left")
    rest = marked.filter("df IS NULL").select("run", "row", "doc_id").join(seldom, "run")
    shared = marked.filter("df IS NOT NULL").unionByName(rest)
    return shared.filter("first < doc_id").select("row", "first").distinct()


def _deletions(table: DataFrame, pairs: DataFrame, min_words: int) -> DataFrame:
    """Per row: places of lines that lie in an aligned block with an earlier document."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone = []
            for mine, counts, other in zip(*(batch.column(c).to_pylist() for c in ("lines", "words", "theirs"))):
                at = [k for k, x in enumerate(mine) if x >= 0]
                found = patience([mine[k] for k in at], [x for x in other if x >= 0])
                out, block, n = [], [], 0
                for k, (x, y) in enumerate(found):
                    block.append(at[x])
                    n += counts[at[x]]
                    if k + 1 == len(found) or found[k + 1] != (x + 1, y + 1):
                        out += block if n >= min_words else []
                        block, n = [], 0
                gone.append(out)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(gone, pa.list_(pa.int32()))], names=["row", "gone"])

    # Of rows with one doc_id and different texts, the one with the greatest line list stands for the document.
    theirs = table.groupBy("doc_id").agg(F.max("lines").alias("theirs")).withColumnRenamed("doc_id", "first")
    both = join_unique(pairs, theirs, "first", F.col("row"), hot_rows=HOT_PARTNERS).join(table.select("row", "lines", "words"), "row")
    found = both.select("row", "lines", "words", "theirs").mapInArrow(rows, "row bigint, gone array<int>").filter(F.size("gone") > 0)
    return found.groupBy("row").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone"))


def remove_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Every document with the lines that remain: doc_id, text, n_lines (with a word), n_removed, kept_sha256.

    Null and empty texts have no lines and come back empty. Repeated rows share their id, so neither is the later one; both
    are returned alike. A document without an id is returned whole and takes no lines from others. Other columns are not read.
    """
    store.prepare(docs.sparkSession)
    table = store.keep(_line_table(docs, min_words).dropDuplicates(["row"]), "lines")
    pairs = store.keep(overlaps(table), "overlaps")
    gone = store.keep(_deletions(table, pairs, min_words), "deletions")
    store.remove(docs.sparkSession, [table, pairs])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, n, removed, sha = [], [], [], []
            for value, lost in zip(batch.column("text"), batch.column("gone")):
                lines = _lines(value.as_buffer().to_pybytes())
                n.append(sum(bool(x.strip()) for x in lines))
                out = set(lost.as_py() or ())
                kept = [x for k, x in enumerate(lines) if k not in out]
                removed.append(len(out))
                text.append(b"\n".join(kept))
                sha.append(hashlib.sha256(text[-1]).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(text, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha)], names=["doc_id", "text", "n_lines", "n_removed", "kept_sha256"])

    # One plan at all sizes: the texts are shuffled whether or not the deletions would fit a broadcast.
    joined = _keyed(docs).join(gone.hint("merge"), "row", "left").select("doc_id", "text", "gone")
    return joined.mapInArrow(rows, "doc_id bigint, text string, n_lines bigint, n_removed bigint, kept_sha256 string")
