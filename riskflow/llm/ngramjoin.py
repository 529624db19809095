"""Groups of near-equal documents: an exact Jaccard join on word shingles by token-combination prefixes.

Two sets that meet the threshold differ in at most ``slack`` shingles of either. Four steps use this:

1. Of the first 2 * slack + 2 shingles of a set by hash, near-equal sets share slack + 2 (of the smaller prefix). Sets with
   fewer shingles there that any other set's prefix has cannot link and are left out. Only this step sees all documents.
2. Equal sets become one node. Whole sets of the remaining nodes are counted; a node with more than ``slack`` shingles of
   its own cannot link either.
3. Shingles are ordered by ascending count. The prefix of a set is cut where its rare shingles, plus its frequent shingles
   beyond the first of each bucket, are more than the slack that is left: then a near-equal set shares a rare shingle or two
   frequent shingles of one bucket, whichever of the two prefixes is shorter. So the index has each single rare shingle of
   the prefix (count of at most ``rare``) and each combination of two frequent shingles of a bucket. The number of buckets
   follows the size class of a set (a power of two), so that combinations grow in proportion to the set; sets near the
   lower end of their class are indexed for the class below too.
4. For each index key, every member is verified against the key's best member, so that a group of near copies costs one
   comparison a member. In the keys whose members are not all in one component yet, members outside the component that the
   key has most of are compared with a member of that one, another for each key, until a round links nothing new. What is
   left are components that meet in a key without a link between them so far; pairs of their members are formed only if
   their parity bits (below) allow a link, and verified. Keys with the same members give the same pairs, so one of them is
   enough. Links between components are thus never missed.

Parity bits: every shingle of a set that other nodes have turns one of 512 bits over. Sets that differ in k of these differ
in at most k bits. More differing bits and shingles that no other node has than the threshold allows rule a link out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm import keybits, store
from riskflow.llm.components import components
from riskflow.llm.text import Words, blocks, mix, windows, words

RARE = 24
#: Parity bits of a set, in words of 64.
BIT_WORDS = 8
IN_BUCKET = 4
#: Rows without an id get one from here on, by a hash of their text; ids of documents are smaller.
NO_ID = 1 << 62
_U = np.uint64


def shingle_sets(found: Words, size: int) -> Iterator[np.ndarray]:
    """Distinct shingle hashes of each document, ascending; all words as one shingle if there are fewer."""
    value, at = windows(found, size)
    cut = np.searchsorted(at, found.first)
    for k, n in enumerate(found.n.tolist()):
        if n >= size:
            yield np.unique(value[cut[k] : cut[k + 1]])
        elif n:
            own = found.hash[found.first[k] : found.first[k + 1]] * np.arange(1, 2 * n, 2, dtype=np.uint64)
            yield mix(np.array([np.bitwise_xor.reduce(mix(own))]) + _U(n))
        else:
            yield np.zeros(0, np.uint64)


def _size_class(n: int) -> int:
    return n.bit_length() - 1


def _slack(n, percent: int):
    return n * (100 - percent) // 100


def _buckets(size_class: int, percent: int) -> int:
    """Buckets of a size class, so that a prefix has about ``IN_BUCKET`` frequent shingles in each."""
    prefix = 1.5 * (1 << size_class) * (100 - percent) / 100 * IN_BUCKET / (IN_BUCKET - 1)
    return max(1, round(prefix / IN_BUCKET))


def _digest(own: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart, as two signed 64-bit values."""
    one, two = mix(own), mix(own ^ _U(0xA5A5A5A5A5A5A5A5))
    return tuple(int(x) for x in np.array([np.add.reduce(one, dtype=np.uint64), np.add.reduce(two, dtype=np.uint64)], np.uint64).view(np.int64))


_BITS = [f"bits_{k}" for k in range(BIT_WORDS)]


def _keyed(docs: DataFrame) -> DataFrame:
    spare = F.xxhash64("text").bitwiseAND(F.lit(NO_ID - 1)) + F.lit(NO_ID)
    own = F.col("doc_id").cast("long")
    return docs.select(own.alias("doc_id"), F.coalesce(own, spare).alias("rid"), F.coalesce("text", F.lit("")).alias("text"))


def _sets(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """One row per document: number of shingles, digest of the set, and its first shingles by hash.

    A shingle that several documents of a block begin with is counted in ``known`` of each, and stands once, in ``carried``
    of one of them; ``prefix`` has the others. So a shingle that all documents have is a row a block, not a document.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch):
                own = list(shingle_sets(words(part.column("text"), lower=True), size))
                d1, d2 = zip(*map(_digest, own))
                known, prefix, carried = _shared_here([x[: 2 * _slack(len(x), percent) + 2] if len(x) > 1 else x[:0] for x in own])
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("rid"), pa.array([len(x) for x in own], pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                    pa.array(known, pa.int64()), *[pa.array([x.view(np.int64) for x in lists], pa.list_(pa.int64())) for lists in (prefix, carried)],
                ], names=["doc_id", "rid", "n", "d1", "d2", "known", "prefix", "carried"])

    return _keyed(docs).mapInArrow(rows, "doc_id bigint, rid bigint, n bigint, d1 bigint, d2 bigint, known bigint, prefix array<bigint>, carried array<bigint>")


def _shared_here(own: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """For each list of a block: how many of its values other lists have, those none has, and the shared ones it has first."""
    values, of = np.concatenate(own), np.repeat(np.arange(len(own)), [len(x) for x in own])
    _, first, at, times = np.unique(values, return_index=True, return_inverse=True, return_counts=True)
    often = times[at] > 1
    leads = np.zeros(len(values), bool)
    leads[first] = True

    def lists(chosen: np.ndarray) -> list[np.ndarray]:
        return np.split(values[chosen], np.searchsorted(of[chosen], np.arange(1, len(own))))

    return np.bincount(of[often], minlength=len(own)), lists(~often), lists(often & leads)


def _parity(own: np.ndarray) -> np.ndarray:
    """The parity bits of a set as signed words."""
    at = own & _U(64 * BIT_WORDS - 1)
    odd = np.bincount(at.astype(np.int64), minlength=64 * BIT_WORDS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _full(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """Whole shingle sets of the nodes. Texts that are surely no node's are not moved."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch):
                own = list(shingle_sets(words(part.column("text"), lower=True), size))
                wanted = zip(part.column("d1").to_pylist(), part.column("d2").to_pylist())
                same = np.array([_digest(x) == d for x, d in zip(own, wanted)])
                yield pa.RecordBatch.from_arrays([
                    *(part.column(x).filter(pa.array(same)) for x in ("node", "n")), pa.array([own[k].view(np.int64) for k in np.flatnonzero(same)], pa.list_(pa.int64())),
                ], names=["node", "n", "shingles"])

    texts = _keyed(docs).select(F.col("rid").alias("node"), "text")
    may = keybits.mark(texts, "node", nodes.select("node"), "may").filter("may").drop("may")
    return may.join(nodes, "node").select("node", "n", "d1", "d2", "text").mapInArrow(rows, "node bigint, n bigint, shingles array<bigint>")


def _with_parity(found: DataFrame) -> DataFrame:
    """The shingles of each node that other nodes have, with their parity bits."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = [x.values.to_numpy().view(np.uint64) for x in batch.column("shingles")]
                bits = np.stack([_parity(x) for x in own]).T
                yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(x) for x in bits]], names=[*batch.schema.names, *_BITS])

    own = found.select("node", "n", "s", F.col("found.token").alias("shingles"))
    return own.mapInArrow(rows, "node bigint, n bigint, s int, shingles array<bigint>, " + ", ".join(f"{b} bigint" for b in _BITS))


def _keys(found: DataFrame, percent: int, rare: int) -> DataFrame:
    """Index keys of each node: rare shingles, and pairs of frequent ones in a bucket for each class."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("found")
            sizes = lists.value_lengths().to_numpy()
            values = lists.flatten()
            token_all, df_all = (values.field(k).to_numpy() for k in ("token", "df"))
            keys, of, stop = [], [], np.cumsum(sizes)
            for k, n in enumerate(batch.column("n").to_pylist()):
                token, df = (x[stop[k] - sizes[k] : stop[k]] for x in (token_all, df_all))
                token = token.view(np.uint64)
                order = np.lexsort((token, df))
                token, often = token[order], df[order] > rare
                need = _slack(n, percent) - (n - len(token)) + 1
                size_class, own = _size_class(n), []
                lower = 100 * ((1 << size_class) - 1) >= percent * n
                for c in (size_class, size_class - 1)[: 1 + lower]:
                    bucket = (token & _U(0xFFFFFFFF)) % _U(_buckets(c, percent))
                    counts = np.ones(len(token), bool)
                    high = np.flatnonzero(often)
                    _, first = np.unique(bucket[high], return_index=True)
                    counts[high[first]] = False
                    enough = np.flatnonzero(counts)
                    cut = int(enough[need - 1]) + 1 if len(enough) >= need else len(token)
                    own.append(token[:cut][~often[:cut]])
                    high = high[high < cut]
                    by = np.lexsort((token[high], bucket[high]))
                    pair_token, pair_bucket = token[high][by], bucket[high][by]
                    step = 1
                    while step < len(by) and (pair := pair_bucket[step:] == pair_bucket[:-step]).any():
                        own.append(mix(mix(pair_token[:-step][pair]) * _U(31) + pair_token[step:][pair] + _U(c)))
                        step += 1
                own = np.unique(np.concatenate(own))
                keys.append(own.view(np.int64))
                of.append(np.full(len(own), k))
            if keys:
                of = pa.array(np.concatenate(of))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), *(batch.column(x).take(of) for x in ("node", "n", "s", "rank"))], names=["key", "node", "n", "s", "rank"])

    return found.select("node", "n", "s", "rank", "found").mapInArrow(rows, "key bigint, node bigint, n bigint, s int, rank int")


def _possible(a: str, b: str, percent: int) -> Column:
    """Whether two nodes can link, by their sizes ``n`` and the number of their shingles that other nodes have, ``s``."""
    most = F.least(f"s{a}", f"s{b}")
    return most * 100 >= (F.col(f"n{a}") + F.col(f"n{b}") - most) * percent


def _alike(a: str, b: str, percent: int) -> Column:
    """Whether the parity bits, sizes and numbers of shingles of their own leave room for a link of two nodes."""
    apart = reduce(Column.__add__, [F.bit_count(F.col(f"{w}{a}").bitwiseXOR(F.col(f"{w}{b}"))) for w in _BITS])
    apart = apart + F.col(f"n{a}") - F.col(f"s{a}") + F.col(f"n{b}") - F.col(f"s{b}")
    return apart * (100 + percent) <= (F.col(f"n{a}") + F.col(f"n{b}")) * (100 - percent)


def _closer(labelled: DataFrame, full: DataFrame, seen: DataFrame, percent: int) -> DataFrame:
    """Links of members of open keys with a member of the component their key has most of, another one for each key."""
    sizes = labelled.groupBy("key", "component").agg(F.count("*").alias("members"), F.min(F.struct(F.xxhash64("key", "node").alias("h"), "node")).alias("p"))
    most = sizes.groupBy("key").agg(F.max(F.struct("members", "component", F.col("p.node").alias("p"))).alias("m")).select("key", F.col("m.component").alias("main"), F.col("m.p").alias("p"))
    pairs = labelled.join(most, "key").filter(F.col("component") != F.col("main")).select("node", "p").distinct()
    own = full.select("node", "n", "s", *_BITS)
    other = full.select(F.col("node").alias("p"), F.col("n").alias("n_p"), F.col("s").alias("s_p"), *[F.col(b).alias(f"{b}_p") for b in _BITS])
    alike = pairs.join(own, "node").join(other, "p").filter(_alike("", "_p", percent))
    alike = alike.select(F.least("node", "p").alias("a"), F.greatest("node", "p").alias("b")).distinct().join(seen, ["a", "b"], "left_anti")
    return _verified(store.keep(alike, "closer"), full, percent)


def _open_keys(keys: DataFrame, label: DataFrame) -> DataFrame:
    """The members of keys that hold several components, each with its component."""
    labelled = keys.join(label, "node", "left").withColumn("component", F.coalesce("component", "node")).select("key", "node", "component")
    mixed = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("key")
    return labelled.join(mixed, "key", "left_semi")


def _one_key_of_each(open_: DataFrame) -> DataFrame:
    """The members of one key of all that have the same ones, told apart by 128 bits: the others would give the same pairs again."""
    salted = lambda k: F.bit_xor(F.xxhash64("node", F.lit(k)))
    members = open_.groupBy("key").agg(F.count("*").alias("members"), salted(1).alias("h1"), salted(2).alias("h2"))
    first = members.groupBy("members", "h1", "h2").agg(F.min("key").alias("key")).select("key")
    return open_.join(first, "key", "left_semi")


def _verified(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets meet the threshold.

    ``shingles`` are those of a set that other nodes have, which are all that two sets can share, and ``n`` is the size of the
    whole set. Only the sets of nodes in pairs are moved.
    """
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    own = full.select("node", "n", "shingles").join(wanted, "node", "left_semi")
    side = lambda x: own.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("shingles").alias(f"of_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    shared = F.size(F.array_intersect("of_a", "of_b"))
    return both.withColumn("shared", shared).filter(F.col("shared") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("shared")) * percent).select("a", "b")


def _counted(tokens: DataFrame) -> DataFrame:
    """Rows whose ``token`` stands in several of them, with their number ``df``. The rows are dealt by token once."""
    df = F.count("*").over(Window.partitionBy("token"))
    return tokens.withColumn("df", df).filter("df > 1")


def near_groups(docs: DataFrame, size: int = 5, percent: int = 80, rare: int = RARE) -> DataFrame:
    """One row per document: doc_id, n_shingles and component_id (smallest doc_id reachable by links, itself included).

    Two documents link when their sets of ``size``-word shingles have 100 * intersection >= ``percent`` * union. Words are
    compared with A-Z in lower case. A text with fewer words is one shingle; an empty or null text has none and links with
    nothing. Repeated rows are returned each. Of rows that share a ``doc_id`` but not the text, the one with the greatest
    digest decides the document's links. A row without an id takes part and gets the smallest id of its group, null if its
    group has none. Other columns are not read. Ids must be smaller than 2**62.
    """
    result = _grouped(docs, size, percent, rare)
    return result.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("component") < NO_ID, F.col("component")).alias("component_id"))


def _grouped(docs: DataFrame, size: int, percent: int, rare: int) -> DataFrame:
    """doc_id, rid, number of shingles n and component (least rid) of every row."""
    spark = docs.sparkSession
    store.prepare(spark)
    prefixes = store.keep(_sets(docs, size, percent), "prefixes")
    sets = store.keep(prefixes.select("doc_id", "rid", "n", "d1", "d2"), "sets")
    one = sets.filter("n > 0").groupBy("rid").agg(F.max(F.struct("n", "d1", "d2")).alias("s")).select("rid", "s.*")
    groups = one.groupBy("n", "d1", "d2").agg(F.min("rid").alias("node"))
    groups = store.keep(groups, "groups")

    tokens = prefixes.select("rid", F.explode("prefix").alias("token"))
    carried = prefixes.select(F.lit(None).cast("bigint").alias("rid"), F.explode("carried").alias("token"))
    known = prefixes.filter("known > 0").select("rid", F.col("known").alias("shared"))
    elsewhere = _counted(tokens.unionByName(carried)).filter("rid IS NOT NULL").select("rid", F.lit(1).cast("bigint").alias("shared"))
    shared = store.keep(known.unionByName(elsewhere).groupBy("rid").agg(F.sum("shared").alias("shared")), "shared")
    store.remove(spark, [prefixes])
    least = F.expr(f"(n * {percent} + 99) div 100 * {100 - percent} div 100 + 2")
    nodes = groups.join(shared.withColumnRenamed("rid", "node"), "node").filter(F.col("shared") >= least)
    nodes = store.keep(nodes.select("node", "n", "d1", "d2"), "nodes")
    whole = store.keep(_full(docs, nodes, size), "shingles")

    tokens = whole.select("node", "n", F.explode("shingles").alias("token"))
    found = _counted(tokens).groupBy("node", "n").agg(F.collect_list(F.struct("token", "df")).alias("found"))
    found = found.withColumn("s", F.size("found")).filter(F.expr(f"n - s <= n * {100 - percent} div 100"))
    found = store.keep(found.withColumn("rank", F.expr("cast((n - s) * 1000 div n AS int)")), "found")
    store.remove(spark, [whole])
    full = store.keep(_with_parity(found), "shared-shingles")
    keys = store.keep(_keys(found, percent, rare), "keys")
    store.remove(spark, [found])

    pivot = keys.groupBy("key").agg(F.count("*").alias("members"), F.min(F.struct("rank", "node", "n", "s")).alias("p"))
    pivot = pivot.filter("members > 1").select("key", F.col("p.node").alias("p"), F.col("p.n").alias("n_p"), F.col("p.s").alias("s_p"))
    star = keys.join(pivot, "key").filter((F.col("node") != F.col("p")) & _possible("", "_p", percent))
    star = store.keep(star.select(F.least("node", "p").alias("a"), F.greatest("node", "p").alias("b")).distinct(), "star")
    links = store.keep(_verified(star, full, percent), "links")
    label = store.keep(components(links), "components")

    open_ = store.keep(_open_keys(keys.select("key", "node"), label), "open")
    store.remove(spark, [keys])
    while True:
        found = store.keep(_closer(open_, full, links, percent), "links")
        if not found.take(1):
            break
        links = store.keep(links.unionByName(found), "links")
        label = store.keep(components(links), "components")
        before, open_ = open_, store.keep(_open_keys(open_.select("key", "node"), label), "open")
        store.remove(spark, [before])

    facts = store.keep(_one_key_of_each(open_), "open").join(full.select("node", "n", "s", *_BITS), "node")
    side = lambda x: facts.select(*(F.col(c).alias(f"{c}_{x}") for c in ("key", "node", "n", "s", "component", *_BITS)))
    may = (F.col("component_a") != F.col("component_b")) & (F.col("node_a") < F.col("node_b")) & _alike("_a", "_b", percent)
    rest = side("a").join(side("b"), (F.col("key_a") == F.col("key_b")) & may)
    rest = rest.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()
    more = store.keep(_verified(store.keep(rest, "rest"), full, percent), "links")
    label = store.keep(components(links.unionByName(more)), "components")

    members = one.join(groups, ["n", "d1", "d2"]).select("rid", "node").join(label, "node", "left")
    members = members.select("rid", F.coalesce("component", "node").alias("component"))
    return sets.select("doc_id", "rid", "n").join(members, "rid", "left").withColumn("component", F.coalesce("component", "rid"))


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80, rare: int = RARE) -> DataFrame:
    """One row of each group, with the columns it came with: that with the smallest id, rows without an id last.

    Rows equal in id and text are one. Rows that share an id but not the text stay together or go together.
    """
    groups = _grouped(docs, size, percent, rare).select("rid", (F.col("component") != F.col("rid")).alias("gone"))
    return _without(docs, groups)


def _without(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not ``gone`` by their rid in ``groups``; rows equal in rid and text are one.

    Most rows stay and are alone with their rid, so only those that may be in the list of the others are moved.
    """
    own = "_rid_"
    while any(c.lower().startswith(own) for c in docs.columns):
        own += "_"
    listed = groups.groupBy("rid").agg(F.max("gone").alias("gone"), F.count("*").alias("n")).filter("gone OR n > 1")
    listed = store.keep(listed.select(F.col("rid").alias(own), F.col("gone").alias(f"{own}gone")), "listed-rows")
    spare = F.xxhash64("text").bitwiseAND(F.lit(NO_ID - 1)) + F.lit(NO_ID)
    rows = keybits.mark(docs.withColumn(own, F.coalesce(F.col("doc_id").cast("long"), spare)), own, listed.select(own), f"{own}may")
    judged = rows.filter(F.col(f"{own}may")).join(listed, own, "left")
    alone = judged.filter(F.col(f"{own}gone").isNull())
    several = judged.filter(~F.col(f"{own}gone")).dropDuplicates([own, "text"])
    return rows.filter(~F.col(f"{own}may")).select(*docs.columns).unionByName(alone.select(*docs.columns)).unionByName(several.select(*docs.columns))
