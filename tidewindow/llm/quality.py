"""Quality rules on documents, and verdicts on their hosts.

Two rules judge a document by itself: too few words, and too many words that lie in
windows of eight words found twice or more in the same text.  Failures are then added up
by host.  A host's failure rate is shrunk towards the rate of all hosts with a beta prior
fitted to the hosts' own rates, so that a host of a few documents is not rejected for one
bad text.  A document stays if it passes itself and its host is not rejected.

Everything is built-in column functions: one pass over the texts yields a row of numbers
for each document, hosts are a partial aggregate of those, and the verdicts are joined back
on the host, null-safe: the hosts are counted and broadcast if they are few, else a shuffle
splits a hot host.

Defined results: a null text is an empty text and fails; a null host is a host of its own;
repeated rows count and return as often as they occur; no documents give no rows.  Only the
named columns are read, so other columns of any name do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewindow.llm.texts import WHITE_SPACE, let, small, total, whole, words
from tidewindow.session import pin

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MAX_HOST_RATE = 0.5
SYMBOLS = "#*$%&|<>"


def repeat_words(tokens: Column, window: int = WINDOW) -> Column:
    """Number of words lying in a window that occurs twice or more in the text."""

    def covered(hashes: Column) -> Column:
        marked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(marked, lambda m: let(
            F.sort_array(F.transform(
                F.filter(
                    F.transform(m, lambda x, k: F.struct(
                        x["i"].alias("i"),
                        F.coalesce(x["h"] == F.get(m, k - 1)["h"], F.lit(False)).alias("before"),
                        F.coalesce(x["h"] == F.get(m, k + 1)["h"], F.lit(False)).alias("after"),
                    )),
                    lambda x: x["before"] | x["after"],
                ),
                lambda x: x["i"],
            )),
            # Each window adds the words up to the next one, the last adds all of its own.
            lambda starts: total(F.transform(starts, lambda p, k: F.least(
                F.lit(window), F.coalesce(F.get(starts, k + 1) - p, F.lit(window))
            ).cast("long"))),
        ))

    def of(ws: Column) -> Column:
        hashes = F.transform(
            F.sequence(F.lit(1), F.size(ws) - (window - 1)),
            lambda i: F.xxhash64(F.slice(ws, i, window)),
        )
        return F.when(F.size(ws) <= window, F.lit(0).cast("long")).otherwise(let(
            hashes,
            lambda h: F.when(
                F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")
            ).otherwise(covered(h)),
        ))

    return let(tokens, of)


def measures(docs: DataFrame, key: list[str], host: str, text: str) -> DataFrame:
    """One row of numbers for each row of ``docs``, with ``key``, the host and ``base_failed``."""
    body, symbols = whole(text), "".join(f"\\{c}" for c in SYMBOLS)
    bare = F.length(F.translate(body, WHITE_SPACE, ""))
    filled = F.filter(
        F.split(body, "\n", -1), lambda line: F.length(F.translate(line, WHITE_SPACE, "")) > 0
    )
    counted = docs.select(
        *key,
        F.col(host).alias("_host"),
        bare.cast("long").alias("word_chars"),
        F.length(F.regexp_replace(body, f"[^{symbols}]+", "")).cast("long").alias("n_symbols"),
        let(filled, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        let(
            words(body), lambda ws: F.struct(F.size(ws).cast("long").alias("n"), repeat_words(ws).alias("r"))
        ).alias("_words"),
    )
    return counted.select(
        *key, "_host",
        F.col("_words.n").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
        F.col("_words.r").alias("n_repeat_words"),
    ).withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
    )


def host_verdicts(judged: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """``_host`` and ``_rejected`` from rows with ``_host`` and ``base_failed``.

    Beta prior by moments: mean ``m`` and variance ``v`` of the hosts' rates give the
    strength ``m (1 - m) / v - 1``.  Where the rates do not vary, or vary as much as they
    can, moments give no strength and the prior weighs as one document.
    """
    hosts = pin(judged.groupBy("_host").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("base_failed").alias("failed")
    ))
    rate = F.col("failed") / F.col("n")
    fit = hosts.agg(F.avg(rate).alias("m"), F.var_pop(rate).alias("v")).first()
    mean, variance = fit["m"] or 0.0, fit["v"] or 0.0
    strength = mean * (1 - mean) / variance - 1 if variance > 0 else 0.0
    if strength <= 0:
        strength = 1.0
    shrunk = (F.col("failed") + mean * strength) / (F.col("n") + strength)
    return small(hosts).select("_host", (shrunk > max_rate).alias("_rejected"))


def with_verdicts(rows: DataFrame, verdicts: DataFrame) -> DataFrame:
    """``rows`` with ``kept``: their own result and that of their host."""
    hosts = verdicts.withColumnRenamed("_host", "_verdict_host")
    return (
        rows.join(hosts, F.col("_host").eqNullSafe(F.col("_verdict_host")))
        .withColumn("kept", ~F.col("base_failed") & ~F.col("_rejected"))
        .drop("_host", "_verdict_host", "_rejected")
    )


def quality_rules(
    docs: DataFrame, doc_id: str = "doc_id", host: str = "source", text: str = "text",
    max_rate: float = MAX_HOST_RATE,
) -> DataFrame:
    """``doc_id``, the five measures, ``base_failed`` and ``kept`` of every document."""
    rows = pin(measures(docs, [doc_id], host, text))
    return with_verdicts(rows, host_verdicts(rows, max_rate))


def passing(
    docs: DataFrame, host: str = "source", text: str = "text", max_rate: float = MAX_HOST_RATE
) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns only."""
    body = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    # Pinned with the rows, since measuring costs more than writing them.
    rows = pin(measures(docs.select(body), ["_row"], f"_row.{host}", f"_row.{text}").select(
        "_row", "_host", "base_failed"
    ))
    return with_verdicts(rows, host_verdicts(rows, max_rate)).filter("kept").select("_row.*")
