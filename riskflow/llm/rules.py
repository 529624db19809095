"""Quality rules as a ledger: every rule is evaluated once, failures are bits, policies and ablations read the bits.

The ledger has one row per document with its measurements (whole numbers) and ``failed``, a bit mask with bit k set when
rule k of ``RULES`` fails. A policy is a version name and a mask: a document stays when none of the mask's bits is set, so a
new policy, or leaving out one rule, needs no second pass over texts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.llm import store
from riskflow.llm.text import SPACE, Words, blocks, covered, mix, per_doc, windows, words

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letter_words", "n_letters", "n_upper"]
REPEAT_WINDOW = 8

#: Rules in the order of their bits; each fails when the condition on the measurements holds. Whole-number arithmetic only,
#: so every engine agrees.
RULES: dict[str, str] = {
    "few_words": "n_words < 20",
    "repeated_words": "100 * n_repeat_words > 30 * n_words",
    "word_length": "10 * word_chars < 20 * n_words OR 10 * word_chars > 150 * n_words",
    "symbols": "100 * n_symbols > 10 * n_words",
    "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
    "few_letters": "100 * n_letter_words < 70 * n_words",
    "shouting": "100 * n_upper > 60 * n_letters",
}
BITS = {name: 1 << k for k, name in enumerate(RULES)}
BASE = BITS["few_words"] | BITS["repeated_words"]
#: Policy versions: name to mask of the rules it applies.
POLICIES: dict[str, int] = {
    "base": BASE,
    "v1": BASE | BITS["symbols"] | BITS["repeated_lines"],
    "v2": sum(BITS.values()),
}
CURRENT = "v2"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_WORDY = _LETTER.copy()
_WORDY[128:] = True


def _within(found: Words, flag: np.ndarray) -> np.ndarray:
    """Number of flagged bytes of each document."""
    sums = np.zeros(len(flag) + 1, np.int64)
    np.cumsum(flag, out=sums[1:])
    return sums[found.at[1:]] - sums[found.at[:-1]]


def _repeat_words(found: Words) -> np.ndarray:
    """Words that lie in a window found twice or more in its document."""
    value, at = windows(found, REPEAT_WINDOW)
    if not len(at):
        return np.zeros(len(found.n), np.int64)
    value = mix(value ^ found.doc[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    ordered = np.sort(value)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(found.n), np.int64)
    hit = twice[np.minimum(np.searchsorted(twice, value), len(twice) - 1)] == value
    return per_doc(found, covered(len(found.hash), at[hit], REPEAT_WINDOW))


def measure(column: pa.Array) -> dict[str, np.ndarray]:
    """The measurements of each text of a block; null counts as empty.

    ``n_lines`` are lines (cut at newline) that hold a word, ``n_dup_lines`` those among them equal to an earlier line.
    ``n_letter_words`` are words with an ASCII letter or a character beyond ASCII, ``n_letters`` and ``n_upper`` count
    ASCII letters.
    """
    found = words(column)
    data, at = found.data, found.at
    wordy = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_WORDY[data], out=wordy[1:])
    n_lines, n_dup = np.zeros(len(at) - 1, np.int64), np.zeros(len(at) - 1, np.int64)
    raw = data.tobytes()
    for k, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
        lines = [x for x in raw[a:b].split(b"\n") if x and not x.isspace()]
        n_lines[k], n_dup[k] = len(lines), len(lines) - len(set(lines))
    return {
        "n_words": found.n, "word_chars": _within(found, ~SPACE[data] & (data & 0xC0 != 0x80)), "n_symbols": _within(found, _SYMBOL[data]),
        "n_dup_lines": n_dup, "n_repeat_words": _repeat_words(found), "n_lines": n_lines,
        "n_letter_words": per_doc(found, wordy[found.end] > wordy[found.start]), "n_letters": _within(found, _LETTER[data]), "n_upper": _within(found, _UPPER[data]),
    }


def ledger(docs: DataFrame, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """One row per document: the columns in ``carry``, the measurements and ``failed``.

    Every rule sees the whole text. A null or empty text has no words and fails ``few_words`` only, as every other rule
    compares shares of nothing. Repeated rows get a row each, null ids stay null, no documents give no rows. Carried columns
    keep their values; one that bears a name of the ledger's raises an error.
    """
    store.prepare(docs.sparkSession)
    if clash := set(carry) & {*MEASURES, "failed"}:
        raise ValueError(f"columns {sorted(clash)} would be written twice")
    schema = T.StructType([*(docs.schema[c] for c in carry), *(T.StructField(m, T.LongType()) for m in MEASURES)])
    names, own = [*carry], "_text_"
    while own in names:
        own += "_"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, own):
                found = measure(part.column(own))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), *(pa.array(found[m], pa.int64()) for m in MEASURES)], names=[*names, *MEASURES])

    measured = docs.select(*(F.col(c) for c in carry), F.col("text").alias(own)).mapInArrow(rows, schema)
    failed = sum((F.when(F.expr(rule), F.lit(BITS[name])).otherwise(F.lit(0)).cast("long") for name, rule in RULES.items()), F.lit(0).cast("long"))
    return measured.withColumn("failed", failed)


def passes(policy: str = CURRENT, failed: Column | str = "failed") -> Column:
    """Whether a document of the ledger stays under a policy version."""
    failed = F.col(failed) if isinstance(failed, str) else failed
    return failed.bitwiseAND(F.lit(POLICIES[policy]).cast("long")) == 0


def apply_policies(rows: DataFrame, policies: Sequence[str] = tuple(POLICIES)) -> DataFrame:
    """The ledger with a column ``kept_<version>`` for each policy."""
    return rows.select("*", *(passes(p).alias(f"kept_{p}") for p in policies))


def patterns(rows: DataFrame) -> DataFrame:
    """Documents and words for each distinct mask; at most 2**rules rows, whatever the number of documents."""
    return rows.groupBy("failed").agg(F.count("*").alias("docs"), F.sum("n_words").alias("words"))


def ablations(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """For each rule of a policy: documents it fails, fails alone, and that stay with and without the rule."""
    mask = POLICIES[policy]
    used = [(name, bit) for name, bit in BITS.items() if bit & mask]
    rule = F.explode(F.array(*(F.struct(F.lit(n).alias("rule"), F.lit(b).cast("long").alias("bit")) for n, b in used))).alias("r")
    each = patterns(rows).select("docs", F.col("failed").bitwiseAND(F.lit(mask).cast("long")).alias("failed"), rule)
    bit, without = F.col("r.bit"), F.col("failed").bitwiseAND(F.bitwise_not(F.col("r.bit")))
    count = lambda condition: F.sum(F.when(condition, F.col("docs")).otherwise(0)).cast("long")
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        count(F.col("failed").bitwiseAND(bit) != 0).alias("docs_failed"), count(F.col("failed") == bit).alias("docs_failed_alone"),
        count(F.col("failed") == 0).alias("docs_kept"), count(without == 0).alias("docs_kept_without"),
    )


def keep_passing(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The documents that pass a policy, with the columns they came with."""
    columns = docs.columns
    inner = docs.select(F.struct(*(F.col(c) for c in columns)).alias("row"), "text") if set(columns) & {*MEASURES, "failed"} else None
    if inner is None:
        return ledger(docs, columns).filter(passes(policy)).select(*columns)
    return ledger(inner, ["row"]).filter(passes(policy)).select("row.*")
