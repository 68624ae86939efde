"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger stores the measurements
and one failure bit per rule.  A policy is a named, versioned set of rules, kept
as a mask, so applying another policy or computing what each rule contributes
is bitwise work over the ledger and never reads a text again.

Defined results: a null or empty text has no words, fails ``few_words`` and
measures 0 everywhere; repeated rows get a ledger row each; a null key stays
null; other columns pass through; an empty table gives an empty ledger.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import map_text, range_hash, prefix_hash, windows, word_spans

MEASURES = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_lines bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, n_letter_words bigint, longest_word bigint"
)
NAMES = [m.split()[0] for m in MEASURES.split(", ")]

#: bit -> (rule, condition under which a document fails), integers only
RULES = [
    ("few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("duplicate_lines", "2 * n_dup_lines > n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
    ("few_letter_words", "10 * n_letter_words < 6 * n_words"),
    ("endless_word", "longest_word > 1000"),
]
BIT = {name: i for i, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << BIT[r] for r in self.rules)


#: the base that every policy includes, and the versions so far
BASE = Policy("base", 1, ("few_words", "repeated_windows"))
POLICIES = [
    BASE,
    Policy("strict", 1, (*BASE.rules, "symbols")),
    Policy("strict", 2, (*BASE.rules, "symbols", "duplicate_lines", "short_words", "long_words", "few_letter_words")),
]
CURRENT = POLICIES[-1]

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def _per_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def measures(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The measurements of a run of texts, in the order of ``MEASURES``."""
    n = len(offsets) - 1
    starts, ends, rows = word_spans(data, offsets)
    prefix = prefix_hash(data, folded=False)
    hashes = range_hash(prefix, starts, ends)
    count = lambda r, **kw: np.bincount(r, minlength=n, **kw).astype(np.int64)
    first_bytes = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=first_bytes[1:])
    chars = first_bytes[ends] - first_bytes[starts]
    letters = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_LETTER[data], out=letters[1:])
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, rows, chars)

    # lines with a word: a line that equals an earlier one of its text
    newline = np.flatnonzero(data == 10)
    begin = np.unique(np.concatenate((offsets[:-1], newline + 1)))
    begin = begin[begin < len(data)]
    row = np.searchsorted(offsets, begin, "right") - 1
    end = np.minimum(np.concatenate((begin[1:], [len(data)])), offsets[row + 1]) if len(begin) else begin
    end = end - (data[np.maximum(end - 1, 0)] == 10) * (end > begin) if len(begin) else begin
    has_word = np.searchsorted(starts, end) > np.searchsorted(starts, begin)
    begin, end, row = begin[has_word], end[has_word], row[has_word]
    lines = count(row)
    line_hash = range_hash(prefix, begin, end)
    order = np.lexsort((line_hash, row))
    dup = count(row[order[1:]][(line_hash[order][1:] == line_hash[order][:-1]) & (row[order][1:] == row[order][:-1])])

    # words in three-word windows that occur twice or more in their text
    win, at = windows(hashes, rows, 3)
    covered = np.zeros(len(hashes) + 3, bool)
    if len(win):
        order = np.lexsort((win, rows[at]))
        same = (win[order][1:] == win[order][:-1]) & (rows[at][order][1:] == rows[at][order][:-1])
        again = np.zeros(len(win), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        for k in range(3):
            covered[at[again] + k] = True
    return [
        count(rows),
        count(rows, weights=chars),
        _per_row(_SYMBOL[data], offsets),
        lines,
        dup,
        count(rows, weights=covered[: len(hashes)]),
        count(rows, weights=letters[ends] > letters[starts]),
        longest,
    ]


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measurements and ``fail_mask``; columns of ``docs`` with
    those names give way."""
    out = map_text(docs.drop(*(c for c in (*NAMES, "fail_mask") if c != text)), text, measures, MEASURES)
    bits = [F.when(F.expr(cond), F.lit(1 << i)).otherwise(F.lit(0)) for i, (_, cond) in enumerate(RULES)]
    return out.withColumn("fail_mask", sum(bits[1:], bits[0]).cast("bigint"))


def apply_policy(led: DataFrame, policy: Policy = CURRENT, out: str = "kept") -> DataFrame:
    """Add the verdict of a policy: kept if none of its bits is set."""
    return led.withColumn(out, F.col("fail_mask").bitwiseAND(F.lit(policy.mask)) == 0)


def ablations(led: DataFrame, policies: list[Policy] | None = None) -> DataFrame:
    """Per policy and rule: documents that fail the rule, that only this rule
    rejects, and that the policy keeps with and without it.  The ledger is
    grouped by mask first, so at most ``2 ** len(RULES)`` rows go further."""
    rows = [
        F.struct(
            F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"), F.lit(r).alias("rule"),
            F.lit(p.mask).alias("mask"), F.lit(1 << BIT[r]).alias("bit"),
        )
        for p in policies or POLICIES
        for r in p.rules
    ]
    masks = led.groupBy("fail_mask").agg(F.count("*").alias("n"))
    hit = F.col("fail_mask").bitwiseAND(F.col("mask"))
    count = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    return (
        masks.select("fail_mask", "n", F.inline(F.array(*rows)))
        .groupBy("policy", "version", "rule")
        .agg(
            count(F.col("fail_mask").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
            count(hit == F.col("bit")).alias("n_only"),
            count(hit == 0).alias("n_kept"),
            count(hit.bitwiseAND(F.bitwise_not("bit")) == 0).alias("n_kept_without"),
        )
    )
