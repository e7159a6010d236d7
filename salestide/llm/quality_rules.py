"""Host-level quality rules.

Each document is tried against plain rules. Failures are counted per host (the column
``source`` of the documents), the failure rate of each rule is shrunk towards the rate of
all hosts by a beta prior fitted to the hosts themselves, and a host whose shrunk rate is
too high takes all its documents with it. A small host with a few bad documents is thus
judged mostly by the others, a large one by its own.

Defined results: a NULL text has no words and fails; NULL is a host of its own; repeated
rows and ids are judged row by row; with no documents there are no hosts and no rows; the
verdict is added under a name that no given column has.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salestide.llm.rows import fresh
from salestide.session import stored

SYMBOLS = b"#*$%&|<>"
BLANKS = b"\t\n\x0b\x0c\r "
FEATURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Limits:
    """``host_rate``: the shrunk failure rate above which a host is turned away."""

    min_words: int = 50
    repeat_percent: int = 50
    symbol_percent: int = 10
    dup_line_percent: int = 30
    host_rate: float = 0.6
    #: Bounds of the prior's weight, in documents.
    prior_least: float = 1.0
    prior_most: float = 1e6


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of three that the text holds at least twice."""
    if len(words) < 4:
        return 0
    code = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    first, second = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
    windows = (code[:-2] * first + code[1:-1]) * second + code[2:]
    _, where, count = np.unique(windows, return_inverse=True, return_counts=True)
    often = count[where] > 1
    inside = np.zeros(len(words), bool)
    for shift in range(3):
        inside[shift : shift + len(often)] |= often
    return int(inside.sum())


def features(text: str | None) -> tuple[int, int, int, int, int, int]:
    """The counts of ``FEATURES``; words are runs of anything but ASCII white space."""
    raw = (text or "").encode()
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    blanks = sum(raw.count(BLANKS[i : i + 1]) for i in range(len(BLANKS)))
    symbols = sum(raw.count(SYMBOLS[i : i + 1]) for i in range(len(SYMBOLS)))
    chars = len(text or "") - blanks
    repeats = repeated_words(words)
    return len(words), chars, symbols, len(lines), len(lines) - len(set(lines)), repeats


@F.pandas_udf(T.StructType([T.StructField(name, T.LongType()) for name in FEATURES]))
def text_features(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        yield pd.DataFrame([features(text) for text in texts], columns=FEATURES)


def failures(seen: Column, limits: Limits) -> dict[str, Column]:
    """Rules by name; true where the document with these features fails."""
    words = seen["n_words"]
    return {
        "short": words < limits.min_words,
        "repeats": 100 * seen["n_repeat_words"] > limits.repeat_percent * words,
        "symbols": 100 * seen["n_symbols"] > limits.symbol_percent * words,
        "dup_lines": 100 * seen["n_dup_lines"] > limits.dup_line_percent * seen["n_lines"],
    }


def base_failed(seen: Column, limits: Limits) -> Column:
    rules = failures(seen, limits)
    return rules["short"] | rules["repeats"]


def host_verdicts(docs: DataFrame, text: str, host: str, limits: Limits) -> DataFrame:
    """One row per host: its documents, failures and shrunk rate per rule, ``rejected``.

    Counts are combined in each task first, so a host with a third of all documents
    is a row per task. The prior of a rule has the mean of all documents and the weight
    that explains how far the hosts' rates lie apart beyond chance.
    """
    rules = failures(F.col("_seen"), limits)
    counts = docs.select(docs[host].alias("host"), text_features(docs[text]).alias("_seen"))
    counts = counts.groupBy("host").agg(
        F.count("*").alias("documents"),
        *[F.sum(rule.cast("long")).alias(f"failed_{name}") for name, rule in rules.items()],
    )
    hosts = stored(counts, "host-counts")
    size = F.col("documents")
    whole = [F.sum(size).alias("documents"), F.count("*").alias("hosts")]
    sums = hosts.agg(*whole, *[F.sum(f"failed_{n}").alias(n) for n in rules]).first()
    total = sums["documents"] or 1
    means = {name: (sums[name] or 0) / total for name in rules}
    spread = hosts.agg(
        *[
            F.sum(size * F.pow(F.col(f"failed_{n}") / size - means[n], 2)).alias(n) for n in rules
        ]
    ).first()
    for name, mean in means.items():
        chance = mean * (1 - mean)
        apart = (spread[name] or 0.0) / total - chance * sums["hosts"] / total
        weight = chance / apart - 1 if apart > 0 else limits.prior_most
        weight = min(max(weight, limits.prior_least), limits.prior_most)
        rate = (F.col(f"failed_{name}") + F.lit(mean * weight)) / (size + F.lit(weight))
        hosts = hosts.withColumn(f"rate_{name}", rate)
    worst = F.greatest(*[F.col(f"rate_{name}") for name in rules])
    return hosts.withColumn("worst_rate", worst).withColumn("rejected", worst > limits.host_rate)


def judge(
    docs: DataFrame, text: str = "text", host: str = "source", limits: Limits | None = None
) -> tuple[DataFrame, str]:
    """Every row with a verdict, and the name of the verdict's column.

    The verdict is a struct of the features, ``base_failed``, ``host_rate`` and ``kept``.
    Features are computed again rather than stored: a second pass over the texts costs
    less than a shuffle of them. The hosts come back by a join on one row per host, which
    Spark broadcasts while it is small; else it splits a hot host.
    """
    limits = limits or Limits()
    verdict, key, seen = (fresh(docs, n) for n in ("verdict", "_host", "_seen"))
    hosts = host_verdicts(docs, text, host, limits).select(
        F.col("host").alias(key), "worst_rate", "rejected"
    )
    rows = docs.withColumn(seen, text_features(docs[text]))
    joined = rows.join(hosts, rows[host].eqNullSafe(hosts[key]), "left")
    failed = base_failed(rows[seen], limits)
    made = F.struct(
        *[rows[seen][name].alias(name) for name in FEATURES],
        failed.alias("base_failed"),
        hosts["worst_rate"].alias("host_rate"),
        (~failed & ~F.coalesce(hosts["rejected"], F.lit(False))).alias("kept"),
    )
    return joined.select(*[rows[c] for c in docs.columns], made.alias(verdict)), verdict


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """Only the documents that pass, with their columns."""
    rows, verdict = judge(docs, **options)
    return rows.filter(F.col(verdict)["kept"]).drop(verdict)
