"""The training-text operators against brute force on small tables, with odd rows in every one."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskflow.llm import decontam, keybits, latent, licenses, linedup, ngramjoin, planes, pseudonyms, raking, repeats, rules, store, viterbi
from riskflow.llm.components import components
from riskflow.llm.queries import TOKENIZER, VOCABULARY
from riskflow.llm.text import words

SCHEMA = "doc_id long, text string, lang string, source string, n_words long"
LONG = " ".join(f"w{k}" for k in range(120))
ROWS = [
    (1, LONG, "en", "a", 9), (2, "new " + LONG + " end", "en", "a", 9), (3, None, None, "b", 9), (4, "", "en", None, 9), (5, " \n\t", "en", "b", 9),
    (6, "one", "de", "b", 9), (7, "x y\n\nx y\nx y", "de", "b", 9), (8, "the the the " * 60, "de", "b", 9), (9, "the the the " * 70, "de", "b", 9),
    (None, LONG, "en", "a", 9), (1, LONG, "en", "a", 9), (10, "long " * 30_000, "en", "a", 9), (11, "É é 日本 ▁ x", "en", "a", 9),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def some_texts(spark, n=150):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(n)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab \n\té日\x1c\xa0", max_size=30), max_size=5))
def test_words(texts):
    found = words(pa.array(texts, pa.string()))
    raw = found.data.tobytes()
    got = [raw[a:b].decode() for a, b in zip(found.start, found.end)]
    assert got == [w for t in texts for w in split(t)]
    assert found.n.tolist() == [len(split(t)) for t in texts]
    assert len(set(found.hash.tolist())) == len(set(got))


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes(kind):
    ids = np.random.default_rng(1).integers(0, 1 << 32, 999).astype(np.uint32)
    assert (planes.from_planes(planes.to_planes(ids, kind), len(ids), kind) == ids).all()


def test_crc_share():
    data = bytes(range(256)) * 9
    assert planes.crc_share(data[:700], len(data) - 700) ^ planes.crc_share(data[700:], 0) == zlib.crc32(data)


def test_token_files(spark, docs, none, tmp_path):
    from tokenizers import Tokenizer

    library, start, want = Tokenizer.from_file(TOKENIZER), 0, []
    for doc_id, text, *_ in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    for kind in ("byte", "bit"):
        path = f"{tmp_path}/{kind}"
        got = planes.encode_documents(docs, TOKENIZER, path, block_ids=100, kind=kind)
        assert Counter(map(tuple, got.collect())) == Counter(want)
        blocks = sorted(map(tuple, planes.read_ids(spark, path).collect()))
        assert sum(len(ids) for _, ids in blocks) == start
    assert planes.encode_documents(none, TOKENIZER).count() == 0


def brute_rules(text):
    w, lines = split(text), [x for x in (text or "").split("\n") if split(x)]
    places = {}
    for k in range(len(w) - 7):
        places.setdefault(tuple(w[k : k + 8]), []).append(k)
    again = {j for v in places.values() if len(v) > 1 for k in v for j in range(k, k + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(again)


def test_rules(docs, none):
    got = rules.apply_policies(rules.ledger(docs.withColumnRenamed("n_words", "n"), ["doc_id", "text", "n"])).collect()
    assert len(got) == len(ROWS)
    for r in got:
        n, *rest = brute_rules(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, *rest)
        assert r.kept_base == (n >= 20 and 100 * r.n_repeat_words <= 30 * n)
    assert rules.ledger(none).count() == 0
    kept = rules.keep_passing(docs)  # a column bears the name of a measurement
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {1, 2, None}


def test_rule_ablations(docs):
    rows = rules.ledger(docs)
    failed, mask = [r.failed for r in rows.collect()], rules.POLICIES["v2"]
    for r in rules.ablations(rows).collect():
        bit = rules.BITS[r.rule]
        assert r.docs_failed == sum(bool(f & bit) for f in failed)
        assert r.docs_kept_without == sum(not f & mask & ~bit for f in failed)


def test_viterbi(spark, docs, none):
    from tokenizers import Tokenizer, models, pre_tokenizers

    library = Tokenizer(models.Unigram(viterbi.load(VOCABULARY), unk_id=0, byte_fallback=True))
    library.pre_tokenizer = pre_tokenizers.Metaspace(replacement=viterbi.MARK, prepend_scheme="always", split=True)
    both = docs.select("doc_id", "text").unionByName(some_texts(spark).select("doc_id", "text"))
    want = Counter((r.doc_id, len(library.encode(r.text or "").ids)) for r in both.collect())
    assert Counter((r.doc_id, r.n_tokens) for r in viterbi.token_counts(both, VOCABULARY).collect()) == want
    assert viterbi.token_counts(none, VOCABULARY).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text("abc", min_size=1, max_size=3), st.integers(1, 4)), min_size=4, max_size=12, unique_by=lambda x: x[0]), st.text("abcd", max_size=9))
def test_viterbi_ties(vocabulary, word):
    """Scores with many equal sums."""
    from tokenizers import Tokenizer, models

    pieces = [("<unk>", 0.0), (viterbi.MARK, -1.0), *((p, -float(s)) for p, s in vocabulary)]
    library = Tokenizer(models.Unigram(pieces, unk_id=0))
    assert viterbi.Counter(tuple(pieces)).count(word) == len(library.encode(word).ids)


def brute_groups(rows, size, percent):
    sets = {}
    for k, (_, text, *_) in enumerate(rows):
        w = (text or "").encode().lower().split()
        sets[k] = {tuple(w[j : j + size]) for j in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} - {()}
    group = {k: {k} for k in sets}
    for a in sets:
        for b in sets:
            same = rows[a][0] is not None and rows[a][0] == rows[b][0]
            if a < b and group[a] is not group[b] and (same or sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])):
                for k in group[b]:
                    group[a].add(k)
                for k in group[a]:
                    group[k] = group[a]
    ids = {k: min((rows[j][0] for j in g if rows[j][0] is not None), default=None) for k, g in group.items()}
    return Counter((rows[k][0], len(sets[k]), ids[k]) for k in sets)


@pytest.mark.parametrize("size,percent", [(4, 85), (5, 80)])
def test_near_groups(spark, docs, size, percent):
    rng = np.random.default_rng(3)
    base, rows = [f"v{k}" for k in range(90)], [tuple(r[:2]) for r in ROWS]
    for k in range(60):  # a group of near copies, and documents that share a passage
        own = list(base)
        for at in rng.integers(0, 90, int(rng.integers(0, 6))):
            own[at] = f"u{rng.integers(5)}"
        rows.append((100 + k, " ".join(own if k % 2 else [*own[:60], *(f"n{k}_{j}" for j in range(30))])))
    got = ngramjoin.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), size, percent, rare=4)
    assert Counter(map(tuple, got.collect())) == brute_groups(rows, size, percent)


def test_one_of_each(docs, none):
    kept = ngramjoin.one_of_each(docs)
    assert kept.columns == docs.columns
    # The row without an id is a copy of document 1, and the repeated row of document 1 is one with it.
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [1, 3, 4, 5, 6, 7, 8, 10, 11]
    rows = [(1, LONG), (1, LONG), (2, LONG), (None, LONG), (None, LONG), (None, LONG + " x"), (None, "alone one two"), (None, "alone one two"), (3, None), (None, None)]
    few = ngramjoin.one_of_each(docs.sparkSession.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, few.collect()), key=str) == sorted([(1, LONG), (None, "alone one two"), (3, None), (None, None)], key=str)
    assert ngramjoin.near_groups(none).count() == 0


def moved_rows(df):
    """The rows of ``df`` and how many rows its plan shuffled, with no table small enough to be broadcast unasked."""
    spark, key = df.sparkSession, "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        rows = df.collect()
        found, plans = 0, [df._jdf.queryExecution().executedPlan()]
        while plans:
            plan = plans.pop()
            name = plan.nodeName()
            if name == "Exchange":
                found += plan.metrics().apply("shuffleRecordsWritten").value()
            inner = plan.finalPhysicalPlan() if name == "AdaptiveSparkPlan" else plan.plan() if "QueryStage" in name else None
            children = plan.children()
            plans += [inner] if inner else [children.apply(k) for k in range(children.size())]
    finally:
        spark.conf.set(key, before)
    return rows, found


def distinct_texts(n):
    return [(k, " ".join(f"d{k}_{j}" for j in range(30))) for k in range(n)]


def test_texts_that_are_no_nodes_are_not_moved(spark):
    docs = spark.createDataFrame([*distinct_texts(500), (7, "the same id another text"), (None, None)], "doc_id long, text string")
    one = ngramjoin._sets(docs, 4, 85).filter("doc_id IN (7, 300) AND n > 20").select(F.col("rid").alias("node"), "n", "d1", "d2")
    got, moved = moved_rows(ngramjoin._full(docs, store.keep(one, "nodes"), 4))
    assert sorted((r.node, r.n, len(r.shingles)) for r in got) == [(7, 27, 27), (300, 27, 27)]
    assert moved < 100


def test_rows_alone_in_their_group_are_not_moved(spark):
    rows = distinct_texts(500)
    docs = store.keep(spark.createDataFrame([*rows, (900, rows[3][1]), (901, rows[3][1]), (4, rows[4][1]), (None, rows[5][1])], "doc_id long, text string"), "docs")
    got, moved = moved_rows(ngramjoin.one_of_each(docs))
    assert sorted(map(tuple, got)) == sorted(rows)
    assert moved < 250


def test_mark_misses_no_key(spark):
    rows = spark.range(40_000).select(F.when(F.col("id") > 0, F.col("id")).alias("k"))
    for n in (0, 1, 6_000):
        keys = spark.range(n).select((F.col("id") * 5 + 5).alias("k"))
        found = {r.k: r.may for r in keybits.mark(rows, "k", keys, "may").collect()}
        assert len(found) == 40_000 and not found[None]
        assert all(found[k] for k in range(5, min(5 * n + 5, 40_000), 5))
        assert sum(found.values()) <= 1.3 * n + 5


def test_a_shingle_of_all_documents_is_a_row_a_block(spark):
    rows = [(k, LONG + f" own{k}") for k in range(200)]
    sets = ngramjoin._sets(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), 5, 80).collect()
    dealt = sum(len(r.prefix) + len(r.carried) for r in sets)
    held = sum(r.known + len(r.prefix) for r in sets)
    assert held == sum(2 * (r.n * 20 // 100) + 2 for r in sets)
    assert dealt < 2 * len(rows) and all(r.known > 40 for r in sets)


def test_keys_with_the_same_members_are_compared_once(spark):
    rows = [(key, node, node % 2) for key in range(50) for node in (1, 2, 3)] + [(90, 1, 1), (90, 2, 0), (91, 3, 1)]
    got = ngramjoin._one_key_of_each(spark.createDataFrame(rows, "key long, node long, component long")).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 1), (0, 2, 0), (0, 3, 1), (90, 1, 1), (90, 2, 0), (91, 3, 1)]


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 200), (200, 150), (7, 7), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 150: 100, 200: 100}


def test_patience():
    a, b = [1, 2, 3, 4, 5, 9], [7, 1, 2, 4, 3, 5]
    found = linedup.patience(a, b)
    assert all(a[x] == b[y] for x, y in found) and found == sorted(found) and len({y for _, y in found}) == len(found) == 4


def test_line_dedup(spark, docs, none):
    lines = [f"line number {k} has eight words in it" for k in range(6)]
    rows = [(1, "\n".join(lines)), (2, "\n".join(["own", *lines[2:5], "other"])), (3, None), (4, ""), (2, "\n".join(["own", *lines[2:5], "other"])), (None, lines[0])]
    got = Counter((r.doc_id, r.text, r.n_removed) for r in linedup.remove_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == Counter([(1, rows[0][1], 0), (2, "own\nother", 3), (2, "own\nother", 3), (3, "", 0), (4, "", 0), (None, lines[0], 0)])
    assert linedup.remove_lines(docs).count() == len(ROWS) and linedup.remove_lines(none).count() == 0


def test_rows_without_an_id_are_not_document_minus_one(spark):
    text = "\n".join(" ".join(f"w{k}x{j}" for j in range(30)) for k in range(4))
    table = spark.createDataFrame([(-2, text), (-1, text), (None, text)], "doc_id long, text string")
    for found in (linedup.remove_lines(table), repeats.remove_repeats(table)):
        assert {r.doc_id: r.n_removed > 0 for r in found.collect()} == {-2: False, -1: True, None: False}


def test_line_dedup_of_frequent_lines_and_documents(spark, monkeypatch):
    lines = [f"line number {k} has eight words in it" for k in range(6)]
    rows = [(k, "\n".join([f"own {k}", *lines[k % 3 :], f"end {k}"])) for k in range(1, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    read = lambda: Counter((r.doc_id, r.text, r.n_removed) for r in linedup.remove_lines(docs).collect())
    plain = read()
    monkeypatch.setattr(linedup, "HOT_PARTNERS", 3)
    monkeypatch.setattr(linedup, "FREQUENT", 5)
    assert read() == plain and sum(n for *_, n in plain) > 0


def brute_lines(rows):
    """Lines that remain when every block of eight words or more that an earlier document has is deleted."""
    out = {}
    for doc, text in rows:
        lines, gone = text.split("\n"), set()
        for first, other in rows:
            theirs = other.split("\n")
            for x in range(len(lines) if first < doc else 0):
                for y in range(len(theirs)):
                    n = 0
                    while x + n < len(lines) and y + n < len(theirs) and lines[x + n] == theirs[y + n]:
                        n += 1
                    if sum(len(v.split()) for v in lines[x : x + n]) >= 8:
                        gone |= set(range(x, x + n))
        out[doc] = "\n".join(v for k, v in enumerate(lines) if k not in gone)
    return out


def test_line_dedup_of_many_sources(spark):
    rng = np.random.default_rng(5)
    block = [[f"block {k} line {j}" + " more" * (k % 3) for j in range(2 + k % 4)] for k in range(60)]
    rows = []
    for doc in range(1, 70):
        chosen = sorted(rng.choice(60, 1 + doc % 9, replace=False).tolist())
        rows.append((doc, "\n".join(v for k in chosen for v in [f"own {doc} {k}", *block[k]])))
    # Document 500 is the first holder of three rarer lines than those of the block it takes from document 3.
    own = [f"rare line {k} of document five hundred has words" for k in range(3)]
    rows += [(500, "\n".join([*own, "x", *rows[2][1].split("\n")[1:]])), (900, "\n".join(own))]
    got = {r.doc_id: r.text for r in linedup.remove_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_lines(rows) and got[500] == "\n".join([*own, "x"])


@pytest.mark.parametrize("bits", [1 << 30, 20])
def test_patience_without_single_lines(monkeypatch, bits):
    assert linedup.patience([1, 2, 1, 2], [5, 1, 2, 1, 2, 6]) == [(0, 1), (1, 2), (2, 3), (3, 4)]
    monkeypatch.setattr(linedup, "TABLE_BITS", bits)
    rng = np.random.default_rng(3)
    for _ in range(200):
        a, b = rng.integers(0, 4, rng.integers(0, 20)).tolist(), rng.integers(0, 5, rng.integers(0, 20)).tolist()
        found = linedup._common(a, b)
        assert all(a[x] == b[y] for x, y in found) and all(x < u and y < v for (x, y), (u, v) in zip(found, found[1:]))
        assert len(found) == decontam.common_subsequence(np.array(a), np.array(b))


def test_samples_take_a_text_once(spark):
    rows = spark.range(3000).selectExpr("IF(id < 1500, 'same text', concat('text ', id)) AS text")
    assert store.sample_texts(rows, 3000, 3000).count() == 1501
    assert store.sample_texts(rows, 300, 3000).count() < 300


def test_licenses(spark, docs, none):
    mit = licenses.TEMPLATES["MIT/grant"][0]
    rows = [(1, "Foo bar.\nReleased under the MIT License."), (2, "x " * 5000 + mit + " y" * 50), (3, None), (4, ""), (5, "released licensed nothing"), (6, "x " + mit.replace("copy", "kopy") + " z " * 20)]
    got = {(r.doc_id, r.template) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, "MIT/notice"), (2, "MIT/grant"), (6, "MIT/grant")}
    assert licenses.scan(docs).count() == 0 and licenses.scan(none).count() == 0


def brute_repeats(rows, size):
    first, out = {}, []
    for doc_id, text, *_ in rows:
        w = split(text)
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            if doc_id is not None:
                first[key] = min(first.get(key, doc_id), doc_id)
    for doc_id, text, *_ in rows:
        w, gone = split(text), set()
        for k in range(len(w) - size + 1):
            if doc_id is not None and first[tuple(w[k : k + size])] < doc_id:
                gone.update(range(k, k + size))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


def test_repeats(spark, docs, none):
    rng = np.random.default_rng(5)
    rows = [tuple(r[:2]) for r in ROWS]
    texts = [rng.choice(["a", "b"], 400).tolist(), rng.choice(["a", "a", "a", "b"], 400).tolist(), rng.choice([f"t{k}" for k in range(9)], 400).tolist()]
    for k in range(40):  # passages of few different words and long runs, cut at any place
        own = []
        for _ in range(3):
            t, at = texts[rng.integers(3)], rng.integers(0, 300)
            own += [*t[at : at + rng.integers(40, 100)], *rng.choice(["a", "b", "z"], 5).tolist()]
        rows.append((100 + k, " ".join(own)))
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = repeats.remove_repeats(table).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert Counter(map(tuple, got.collect())) == brute_repeats(rows, 50)
    assert repeats.remove_repeats(none).count() == 0


def test_leaks(spark, docs, none):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = {r.item_id: r.text for r in bench.collect()}
    table = some_texts(spark, 200).select("doc_id", "text")
    changed = items[6].split()
    changed[3] = changed[9] = "else"
    more = [(9001, "start " + items[0].upper() + " end"), (9002, " ".join(changed)), (9003, None), (9004, ""), (None, items[1])]
    both = table.unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    norm = lambda t: " ".join((t or "").lower().split())
    exact = {(r.doc_id, k) for r in both.collect() for k, v in items.items() if norm(v) in norm(r.text)}
    found = {(r.doc_id, r.item_id) for r in decontam.leaks(both, bench).collect()}
    assert len(exact & found) >= 0.9 * len(exact) and (9001, 0) in found and (9002, 6) in found and (None, 1) in found
    assert found - exact == {(9002, 6)}
    assert decontam.leaks(none, bench).count() == 0
    assert decontam.keep_clean(docs, bench.limit(0)).count() == len(ROWS)


def quotes(spark, sizes, seed):
    """Items cut from the texts of sf0.001, one of each size in turn, each put in lower case (A-Z) into a text of other words."""
    low = lambda text: re.sub("[A-Z]+", lambda m: m[0].lower(), text)
    pool = [w for r in some_texts(spark, 1000).collect() for w in split(r.text)]
    rng = np.random.default_rng(seed)
    items = [" ".join(pool[k : k + n]) for n, k in zip(sizes, rng.integers(0, len(pool) - max(sizes), len(sizes)).tolist())]
    around = lambda: " ".join(pool[int(k)] for k in rng.integers(0, len(pool), 90))
    texts = [f"{around()} rare{k} {low(v)} {around()}" for k, v in enumerate(items)]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), spark.createDataFrame(list(enumerate(items)), "item_id long, text string"), texts, items


def check_quotes(docs, bench, texts, items):
    held = [" " + " ".join(split(t.lower())) + " " for t in texts]
    want = {(d, k) for k, v in enumerate(items) for d, t in enumerate(held) if " " + " ".join(split(v.lower())) + " " in t}
    rows = decontam.leaks(docs, bench).collect()
    assert len(want) >= len(items) and want <= {(r.doc_id, r.item_id) for r in rows}
    assert all(r.common_words == r.item_words for r in rows if (r.doc_id, r.item_id) in want)


@pytest.mark.parametrize("n_docs", [0, 5000])
def test_leaks_of_short_and_long_items(spark, n_docs):
    docs, bench, texts, items = quotes(spark, [5, 7, 10, 20, 21, 41, 100, 300, 500] * 20, 2)
    more = spark.range(n_docs).selectExpr("id + 100000 AS doc_id", "concat('other ', id) AS text")
    check_quotes(docs.unionByName(more), bench, texts, items)


def test_leaks_checks_every_window(spark):
    item = " ".join(f"w{k}" for k in range(38))
    mixed, other = " ".join(reversed(split(item))), " ".join(f"o{k}" for k in range(300))
    texts = [f"{mixed} {other} {item} {other}", f"{other} {mixed}", " ".join(split(item)[:19]) + f" {other} u v w x {item}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = decontam.leaks(docs, spark.createDataFrame([(0, item)], "item_id long, text string")).collect()
    assert {(r.doc_id, r.common_words, r.cosine) for r in rows} == {(0, 38, 1.0), (2, 38, 1.0)}


def test_leaks_of_many_items(spark):
    check_quotes(*quotes(spark, [30] * 1200, 1))


@pytest.mark.parametrize("pieces, times", [(1, 100), (3, 20)])
def test_latent_search_finds_what_the_exact_search_finds(spark, monkeypatch, pieces, times):
    """Up to 1,200 items of 1 to 500 words, in one index or several; the latent search alone reaches a recall of 0.9."""
    docs, bench, texts, items = quotes(spark, [1, 2, 4, 10, 15, 20, 30, 41, 60, 100, 300, 500] * times, 3)
    monkeypatch.setattr(decontam, "PIECE_CHARS", sum(map(len, items)) // pieces + 1)
    assert len(decontam.indexes(docs, bench)) == pieces
    low = lambda text: re.sub("[A-Z]+", lambda m: m[0].lower(), text)
    held = [" " + " ".join(split(low(t))) + " " for t in texts]
    want = {(d, k) for k, v in enumerate(items) for d, t in enumerate(held) if " " + " ".join(split(low(v))) + " " in t}
    rows = decontam.leaks(docs, bench).collect()
    assert want <= {(r.doc_id, r.item_id) for r in rows}
    assert all(r.common_words == r.item_words for r in rows if r.item_words < decontam.SHORT_ITEM)
    near = {(r.doc_id, r.item_id) for r in rows if r.latent > 0}
    by_size = {n: [(d, k) in near for d, k in want if len(split(items[k])) == n] for n in (1, 2, 4, 10, 15, 20, 30, 41, 60, 100, 300, 500)}
    assert np.mean([x for n, own in by_size.items() if n >= 4 for x in own]) >= 0.9


def test_leaks_of_paraphrases_and_short_items(spark):
    items = [
        "Which city became the seat of government of the French republic after the war? The capital of France is the city of Paris.",
        "capital of France? Paris",
        "Name the process by which green plants turn light into sugar. Plants make sugar by photosynthesis in their leaves.",
    ]
    around = " ".join(f"filler{k}" for k in range(60))
    texts = [
        f"{around} where did ministers of that nation settle once peace came? the capital of France is the city of Paris. {around}",
        f"{around} the capital of france? paris {around}",
        f"{around} paris is a capital and france? a country {around}",
        f"{around} how do plants gain energy from light? Plants make sugar by photosynthesis in their leaves. {around}",
        f"{around} green plants and light, sugar and leaves, the war and the city {around}",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = decontam.leaks(docs, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(0, 0), (1, 1), (3, 2)}
    assert all(r.latent >= decontam.MIN_LATENT for r in rows if r.item_id != 1)
    assert decontam.keep_clean(docs, spark.createDataFrame([(None, "x"), (1, ""), (2, None)], "item_id long, text string")).count() == 5


def test_randomised_svd():
    rng = np.random.default_rng(0)
    low = rng.standard_normal((90, 12)) @ rng.standard_normal((12, 400))
    basis = latent.randomised_svd(low, 64)
    assert basis.shape == (400, 12) and np.allclose(basis.T @ basis, np.eye(12)) and np.allclose(low @ basis @ basis.T, low)
    noisy = low + 0.01 * rng.standard_normal(low.shape)
    best = np.linalg.svd(noisy)[1]
    assert np.allclose(np.linalg.norm(noisy @ latent.randomised_svd(noisy, 12), axis=0), best[:12], rtol=1e-3)
    assert latent.randomised_svd(np.ones((1, 3)), 64).shape == (3, 1)


def test_common_subsequence():
    assert decontam.common_subsequence(np.array([1, 2, 3, 4]), np.array([2, 9, 3, 1, 4])) == 3


def test_raking(spark, docs, none):
    table = spark.createDataFrame([(s, a, t, 100 + 7 * k) for k, (s, a, t) in enumerate((s, a, t) for s in "xyz" for a in ("en", "de", "") for t in ("p", "q"))], "source string, language string, topic string, tokens long")
    got, found = raking.rake(table.withColumn("docs", F.lit(1)), power=0.5, budget=0.3)
    rows, whole = got.toPandas(), sum(r.tokens for r in table.collect())
    for c in ("source", "language", "topic"):
        old = rows.groupby(c).tokens.sum()
        want = old**0.5 / (old**0.5).sum() * whole
        assert np.allclose((rows.tokens * rows.weight).groupby(rows[c]).sum(), want, rtol=1e-3)
    assert abs((rows.tokens * rows.probability).sum() - 0.3 * whole) < 0.01 * whole
    out = raking.sample(docs).collect()
    assert len(out) == len(ROWS) and not any(r.sampled for r in out if not r.n_tokens)
    assert raking.keep_sampled(docs).columns == docs.columns and raking.sample(none).count() == 0


def test_topics_are_fitted_on_all_documents(spark, none):
    """Two words make up 6,000 texts, and one text of another kind must have its topic, however rare it is."""
    texts = [(f"alpha a{k % 3000}" if k % 2 else f"beta b{k % 3000}",) for k in range(6000)] + [("omega " * 40,), (None,), (" ",)]
    table = spark.createDataFrame(texts, "text string")
    centres = raking.fit_topics(table, 3)
    assert centres.shape == (3, raking.FEATURES) and np.allclose(np.linalg.norm(centres, axis=1), 1, atol=1e-5)
    other = raking.fit_topics(table.repartition(7), 3)
    assert np.array_equal(centres, other)
    x = raking._units(raking._counts(pa.array([t for (t,) in texts[:6001]]))[0])
    near = (x @ centres.T).argmax(axis=1)
    # A fixed point of k-means over all of them, not over some.
    for k in range(3):
        total = x[near == k].astype(np.float64).sum(axis=0)
        assert np.allclose(total / np.linalg.norm(total), centres[k], atol=1e-3)
    assert raking.fit_topics(none, 3).shape == (1, raking.FEATURES)


def test_pseudonyms(spark, docs, none):
    text = ("card 4785380592391139 or 4785-3805-9239-1139, +1 (743) 555-3824 and +1-743-555-3824, 152.143.123.131, 999.1.1.1, x.19@mail5.example.com, "
            "2024-02-29 2024-13-01 12/31/1999, DE89370400440532013000, 4785380592391130")  # fmt: skip
    table = spark.createDataFrame([(1, text), (2, "also 4785380592391139"), (3, None), (4, ""), (None, "none 1 2")], "doc_id long, text string")
    new = pseudonyms.pseudonymise(table, "k")
    got = {r.doc_id: r for r in new.collect()}
    numbers = re.findall(r"[0-9]{16}|(?:[0-9]{4}-){3}[0-9]{4}", got[1].text)
    assert numbers[0] == numbers[1].replace("-", "") == got[2].text.split()[1] and numbers[0] not in text
    assert "999.1.1.1" in got[1].text and "2024-13-01" in got[1].text and "4785380592391130" in got[1].text
    for gone in ("152.143.123.131", "743) 555-3824", "x.19@", "2024-02-29", "DE89370400440532013000"):
        assert gone not in got[1].text
    assert (got[1].n_card, got[1].n_phone, got[1].n_ip, got[1].n_email, got[1].n_date, got[1].n_iban) == (2, 2, 1, 1, 2, 1)
    back = pseudonyms.pseudonymise(new.select("doc_id", "text"), "k", inverse=True)
    assert {r.doc_id: r.text for r in back.collect()} == {r.doc_id: r.text for r in table.collect()}
    assert pseudonyms.pseudonymise(docs, "k").count() == len(ROWS) and pseudonyms.pseudonymise(none, "k").count() == 0
