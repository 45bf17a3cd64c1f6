"""Quality rules with verdicts per host (native).

Each document is judged by itself; then the failures are added up per host, the hosts' rates are shrunk
towards a common beta prior fitted to all hosts, and the verdict on a host is joined back to its documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import SPACES, pin, same_row, small_side, stored, words

SYMBOLS = "#*$%&|<>"
BROADCAST_HOSTS = 50_000  # names and rates: a few MB


@dataclass(frozen=True)
class QualityRules:
    """``min_words`` and ``max_repeat_percent`` fail a document. A host fails when the lower bound of its
    failure rate, ``z`` posterior deviations under the mean, is above ``max_host_rate``."""

    min_words: int = 20
    window: int = 8
    max_repeat_percent: int = 30
    max_host_rate: float = 0.5
    z: float = 1.645


def repeated_words(hashes: Column, ordered: Column, window: int) -> Column:
    """Words covered by windows that occur at least twice. ``hashes`` has a hash per window, ``ordered`` the
    (hash, position) pairs in order, so that equal windows are neighbours."""
    same = lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
    twice = F.filter(ordered, lambda x, i: same(x, F.get(ordered, i - 1)) | same(x, F.get(ordered, i + 1)))
    starts = F.array_sort(F.transform(twice, lambda x: x["i"]))
    # one-element array: the starts are worked out once, not once for each start
    gaps = F.flatten(
        F.transform(
            F.array(starts),
            lambda s: F.transform(
                s, lambda p, j: F.least(F.lit(window), F.coalesce(F.get(s, j + 1) - p, F.lit(window)))
            ),
        )
    )
    return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + gap)


def measures(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """``docs`` (a ``text`` and other columns) with n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words and base_failed. NULL texts count as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(F.btrim(line, F.lit(SPACES))) > 0)
    width = rules.window
    out = docs.withColumns({"_words": words(text), "_lines": lines})
    out = out.withColumn("n_words", F.size("_words").cast("long"))
    window = lambda i: F.xxhash64(F.slice(F.col("_words"), i, F.lit(width)))
    last = F.size("_words") - (width - 1)
    out = out.withColumn(
        "_hashes",
        F.when(last >= 1, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), window)).otherwise(
            F.array().cast("array<bigint>")
        ),
    )
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    pairs = F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    out = out.withColumn("_ordered", F.when(repeats, F.sort_array(pairs)).otherwise(none))
    out = out.withColumns(
        {
            "word_chars": F.length(F.translate(text, SPACES, "")).cast("long"),
            "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": repeated_words(F.col("_hashes"), F.col("_ordered"), width),
        }
    )
    failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")
    )
    return out.withColumn("base_failed", failed).drop("_words", "_lines", "_hashes", "_ordered")


def failing_hosts(judged: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """Hosts (column ``host``) whose shrunk failure rate is too high, with that rate.

    The prior is a beta distribution fitted by moments: its mean is the rate over all documents, its
    strength comes from how much the hosts differ beyond chance. A host without a name is a host too.
    """
    hosts = judged.groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("bad")
    )
    whole = hosts.agg(F.sum("bad").alias("all_bad"), F.sum("n").alias("all_n"), F.count(F.lit(1)).alias("hosts"))
    mean = (F.col("all_bad") + 1) / (F.col("all_n") + 2)
    spread = hosts.crossJoin(F.broadcast(whole)).agg(  # one row of totals
        F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - mean, 2)).alias("ss"),
        F.first(mean).alias("mean"),
        F.first("all_n").alias("all_n"),
        F.first("hosts").alias("hosts"),
    )
    mean = F.col("mean")
    excess = (F.col("ss") / (mean * (1 - mean)) - F.col("hosts")) / F.greatest(F.col("all_n") - F.col("hosts"), F.lit(1))
    rho = F.least(F.greatest(excess, F.lit(0.0001)), F.lit(0.99))
    prior = spread.select("mean", (1 / rho - 1).alias("strength"))
    shrunk = hosts.crossJoin(F.broadcast(prior)).withColumn("total", F.col("n") + F.col("strength"))
    rate = (F.col("bad") + F.col("mean") * F.col("strength")) / F.col("total")
    shrunk = shrunk.withColumn("rate", rate)
    deviation = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("total") + 1))
    return shrunk.filter(F.col("rate") - rules.z * deviation > rules.max_host_rate).select("host", "rate")


def _meet_hosts(rows: DataFrame, bad: DataFrame, how: str) -> DataFrame:
    """``rows`` (with ``host``) joined to failing hosts (``bad_host``). Few hosts fail, and up to
    ``BROADCAST_HOSTS`` of them go to the rows, so that a host of a third of all rows stays spread; more
    meet them by a shuffle, which Spark splits where a host is large."""
    bad = pin(bad)
    few = bad.count() <= BROADCAST_HOSTS
    return rows.join(F.broadcast(bad) if few else bad, F.col("host").eqNullSafe(F.col("bad_host")), how)


def quality(docs: DataFrame, rules: QualityRules = QualityRules(), host_col: str = "source") -> DataFrame:
    """One row per document: its id, the measures, ``base_failed`` and ``kept``.

    NULL and empty texts have no words and fail. Repeated rows are judged alike and stay repeated. A NULL
    host is one host. An empty table gives an empty result. Further columns of ``docs`` are not looked at.
    """
    rows = docs.select(F.col("doc_id"), F.col(host_col).alias("host"), F.col("text").cast("string").alias("text"))
    judged = pin(measures(rows, rules).drop("text"))
    bad = failing_hosts(judged, rules)
    out = _meet_hosts(judged, bad.withColumnRenamed("host", "bad_host"), "left")
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rate").isNull()).drop("host", "bad_host", "rate")


def keep_good(docs: DataFrame, rules: QualityRules = QualityRules(), host_col: str = "source") -> DataFrame:
    """The documents that pass, with their columns. Works on NULLs and repeated rows as ``quality``.

    The verdicts are written once, by id and hash of the text. Where few documents fail they are looked up where the
    documents lie; documents are shuffled only where more fail than are broadcast.
    """
    text = F.col("text").cast("string")
    key = [F.col("doc_id").alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("h"), F.col(host_col).alias("host")]
    judged = measures(docs.select(*key, text.alias("text")), rules).select("id", "h", "host", "base_failed")
    judged = stored(judged, "judged")
    bad = failing_hosts(judged.select("host", "base_failed"), rules).select(F.col("host").alias("bad_host"))
    failed = small_side(stored(judged.filter("base_failed").select("id", "h").distinct(), "failed"))
    whole = docs.select(F.struct("*").alias("doc"), *key)
    good = whole.join(failed, same_row(whole, failed), "left_anti").select("doc", "host")
    return _meet_hosts(good, bad, "left_anti").select("doc.*")
