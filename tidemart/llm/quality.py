"""Quality rules kept as a ledger: one bit per failed rule, policies over the bits."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import Words, mixed, text_blocks, windows

# What counts as a symbol.
SYMBOLS = b"#*$%&|<>"
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_BLANKS = " \t\x0b\x0c\r"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _rules() -> dict[str, Column]:
    n, chars = F.col("n_words"), F.col("word_chars")
    return {
        "few_words": n < 50,
        "repetitive": 100 * F.col("n_repeat_words") > 50 * n,
        "symbols": 10 * F.col("n_symbols") > n,
        "repeated_lines": 100 * F.col("n_dup_lines") > 50 * F.col("n_lines"),
        "short_words": chars < 2 * n,
        "long_words": chars > 15 * n,
    }


# A rule's bit is its place here. Rules are only ever added, so that old ledgers stay readable.
RULES = ("few_words", "repetitive", "symbols", "repeated_lines", "short_words", "long_words")
# Versioned policies: the rules whose failure rejects a document.
POLICIES: Mapping[str, tuple[str, ...]] = {
    "base": ("few_words", "repetitive"),
    "v1": RULES,
}


def mask_of(rules) -> int:
    return sum(1 << RULES.index(rule) for rule in rules)


def _dup_lines(text: str) -> tuple[int, int]:
    """Lines with a word, and those of them that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(_BLANKS)]
    return len(lines), len(lines) - len(set(lines))


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    upto = np.concatenate(([0], np.cumsum(flags)))
    return upto[offsets[1:]] - upto[offsets[:-1]]


def _repeat_words(words: Words) -> np.ndarray:
    """Per text, the words in three-word windows that the text has twice or more."""
    runs = windows(words.hashes(), 3)
    counts = np.diff(words.bounds)
    owner = np.repeat(np.arange(len(counts)), counts)
    covered = np.zeros(len(owner), bool)
    if len(runs):
        valid = np.flatnonzero(owner[: len(runs)] == owner[2:])
        keys = mixed(runs[valid] + owner[valid].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        twice = np.zeros(len(valid), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        for j in range(3):
            covered[valid[twice] + j] = True
    return _per_text(covered, words.bounds)


def _measured(batches: Iterator[pa.RecordBatch], keep: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = {name: np.zeros(batch.num_rows, np.int64) for name in MEASURES}
        text = batch.column("text") if "text" in batch.schema.names else batch.column("_row").field("text")
        for first, data, offsets in text_blocks(text):
            here = slice(first, first + len(offsets) - 1)
            words = Words(data, offsets)
            out["n_words"][here] = np.diff(words.bounds)
            leading = (data & 0xC0) != 0x80
            out["word_chars"][here] = _per_text(words.inside & leading, offsets)
            out["n_symbols"][here] = _per_text(_IS_SYMBOL[data], offsets)
            out["n_repeat_words"][here] = _repeat_words(words)
            raw, ends = data.tobytes(), offsets.tolist()
            lines = [_dup_lines(raw[a:b].decode()) for a, b in zip(ends[:-1], ends[1:])]
            out["n_lines"][here], out["n_dup_lines"][here] = np.array(lines).T
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in keep], *[pa.array(a) for a in out.values()]], names=[*keep, *out]
        )


def _with_bits(source: DataFrame, keep: list[str]) -> DataFrame:
    schema = source.select(*keep).schema
    for measure in MEASURES:
        schema = schema.add(measure, T.LongType())
    rules = _rules()
    bits = sum((F.when(rules[r], F.lit(1 << i)).otherwise(0) for i, r in enumerate(RULES)), F.lit(0))
    rows = source.mapInArrow(partial(_measured, keep=keep), schema)
    return rows.withColumn("failed", bits.cast("long"))


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id with every measurement and ``failed``, the bits of the rules a document fails.

    Each rule is evaluated once; policies, verdicts and ablations are read from the bits. A null or
    empty text has no words and fails ``few_words`` only. Words, windows and lines are of the whole text,
    compared as they are. Repeated rows each get a row; other columns are ignored.
    """
    return _with_bits(docs.select("doc_id", "text"), ["doc_id"])


def rejected_by(policy: str) -> Column:
    return F.col("failed").bitwiseAND(F.lit(mask_of(POLICIES[policy]))) != 0


def ablations(book: DataFrame, policy: str) -> DataFrame:
    """Per rule of a policy: documents that fail it, and those that only this rule rejects.

    All from counts per bit pattern, of which there are as many as rules allow, not as documents.
    """
    mask = mask_of(POLICIES[policy])
    patterns = book.groupBy(F.col("failed").bitwiseAND(F.lit(mask)).alias("bits")).agg(
        F.count(F.lit(1)).alias("documents")
    )
    bits = [(rule, 1 << RULES.index(rule)) for rule in POLICIES[policy]]
    per_rule = F.explode(
        F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(bit).alias("bit")) for rule, bit in bits])
    )
    fails = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return (
        patterns.withColumn("r", per_rule)
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.coalesce(F.sum(F.when(fails, F.col("documents"))), F.lit(0)).alias("failed_documents"),
            F.coalesce(F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("documents"))), F.lit(0)).alias(
                "rejected_by_it_alone"
            ),
        )
    )


def judge(docs: DataFrame, policy: str = "v1") -> DataFrame:
    """doc_id, the measurements, ``failed`` bits, ``base_failed`` and ``kept`` under a policy."""
    return ledger(docs).withColumns(
        {"base_failed": rejected_by("base"), "kept": ~rejected_by("base") & ~rejected_by(policy)}
    )


def passing(docs: DataFrame, policy: str = "v1") -> DataFrame:
    """The rows of ``docs``, all columns, that a policy keeps. Columns may have any names."""
    rows = docs.select(F.struct(*docs.columns).alias("_row"))
    book = _with_bits(rows, ["_row"])
    return book.where(~rejected_by("base") & ~rejected_by(policy)).select("_row.*")
