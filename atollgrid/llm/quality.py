"""Host-level quality rules: document failures, shrunk failure rates of hosts, verdicts joined back. Built-ins only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, maybe_broadcast, written

#: A host whose shrunk failure rate is over this loses its documents, whatever the others' rates.
MAX_HOST_RATE = 0.5
#: Standard deviations of the fitted prior, over its mean, beyond which a host's shrunk rate is none of the hosts'.
TAIL = 3.0
#: A rate so little over the bound is at it.
ROUNDING = 1e-9
#: Bits of a packed 64-bit value that hold a word's position.
POSITION_BITS = 30


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def base_measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed.

    Null and empty texts have zero of each and fail (under 50 words). Existing columns of these names are replaced.

    Repeated windows: the hash of each three-word window is packed with its position into one long, the longs are
    sorted, and equal neighbours are candidates; their words are then compared themselves, so the count is exact.
    """
    low = (1 << POSITION_BITS) - 1
    t = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    d = docs.withColumn("_w", words_of(F.col(f"`{text_col}`")))
    d = d.withColumn(
        "_l", F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    ).withColumn(
        "_s",
        F.expr(
            f"if(size(_w) < 3, cast(array() as array<bigint>), sort_array(transform(sequence(0, size(_w) - 3), "
            f"i -> (xxhash64(_w[i], _w[i + 1], _w[i + 2]) & ~{low}L) | cast(i as bigint))))"
        ),
    )
    same = "shiftright(_s[j], {b}) = shiftright(_s[j {o}], {b})".replace("{b}", str(POSITION_BITS))
    d = d.withColumn(
        "_c",
        F.expr(
            f"if(size(_s) < 2, cast(array() as array<bigint>), transform(filter(sequence(0, size(_s) - 1), j -> "
            f"(j > 0 and {same.format(o='- 1')}) or (j < size(_s) - 1 and {same.format(o='+ 1')})), j -> _s[j] & {low}L))"
        ),
    )
    d = d.withColumn("_g", F.expr("sort_array(transform(_c, p -> struct(concat_ws(' ', _w[int(p)], _w[int(p) + 1], _w[int(p) + 2]) as g, p as p)))"))
    d = d.withColumn(
        "_p",
        F.expr(
            "if(size(_g) < 2, cast(array() as array<bigint>), transform(filter(sequence(0, size(_g) - 1), j -> "
            "(j > 0 and _g[j].g = _g[j - 1].g) or (j < size(_g) - 1 and _g[j].g = _g[j + 1].g)), j -> _g[j].p))"
        ),
    )
    long = lambda c: c.cast("long")
    d = d.withColumns(
        {
            "n_words": long(F.size("_w")),
            "word_chars": long(F.length(F.array_join("_w", ""))),
            "n_symbols": long(F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", ""))),
            "n_dup_lines": long(F.size("_l") - F.size(F.array_distinct("_l"))),
            "n_repeat_words": long(F.size(F.array_distinct(F.flatten(F.transform("_p", lambda p: F.array(p, p + 1, p + 2)))))),
        }
    ).drop("_w", "_l", "_s", "_c", "_g", "_p")
    return d.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def host_verdicts(measured: DataFrame, host_col: str, max_rate: float = MAX_HOST_RATE, tail: float = TAIL) -> DataFrame:
    """One row per host (null is a host): host, n_docs, n_failed, host_rate, host_kept.

    The beta prior comes from the hosts by moments: with mean m and variance v of the rates, its strength k is
    m(1-m)/v - 1, held between 1 and 1000; with one host, or no variance, it is 1000. host_rate is the posterior mean, so
    a host of few documents stands near m whatever these are. A host is kept up to a rate of m + tail standard
    deviations of the prior, or max_rate, whichever is less.
    """
    host = written(measured.groupBy(F.col(f"`{host_col}`").alias("host")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed")
    ), "hosts")
    r = F.col("n_failed") / F.col("n_docs")
    prior = host.agg(F.avg(r).alias("m"), F.var_pop(r).alias("v")).first()
    m, v = prior["m"] or 0.0, prior["v"] or 0.0
    k = min(1000.0, max(1.0, m * (1 - m) / v - 1)) if v > 0 else 1000.0
    most = min(max_rate, m + tail * math.sqrt(m * (1 - m) / (k + 1)))
    host = host.withColumn("host_rate", (F.col("n_failed") + m * k) / (F.col("n_docs") + k))
    return host.withColumn("host_kept", F.col("host_rate") <= most + ROUNDING)


def host_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", **params) -> DataFrame:
    """One row per row of docs: id, the measures, base_failed, host_rate, kept.

    kept is false if base_failed, else the host's verdict. Null hosts count as one host. The measures are written once
    and read twice (by host, and for the result), so texts are read once. Other columns of docs are left out.
    """
    d = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_t"), F.col(f"`{host_col}`").alias("_host"))
    m = written(base_measures(d, "_t").drop("_t"), "quality")
    v = host_verdicts(m, "_host", **params)
    out = m.join(maybe_broadcast(v.select("host", "host_rate", "host_kept")), F.col("_host").eqNullSafe(F.col("host")), "left")
    return out.select(
        F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(F.col("host_kept"), F.lit(True))).alias("kept"), "host_rate",
    )
