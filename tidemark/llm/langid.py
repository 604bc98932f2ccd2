"""Language identification by Bayesian evidence fusion.

The posterior of a language given a row is proportional to
    P(text | l)^TEMPER  *  P(declared | l)  *  P(suffix | l)  *  P(l | host)
* P(text | l): hashed byte 3-grams of the letters, counted over all rows that declare l, and one
  more class, ``und`` (no known language), under which every 3-gram is equally likely.  Overlapping
  3-grams are not independent; the temper stands for that.
* P(declared | l) and P(suffix | l): how often rows that look like l declare each language and
  carry each address suffix, counted by grouped aggregation and smoothed.
* P(l | host): counts of the host, smoothed towards those of its site (the last two labels),
  those towards the counts of all rows, and those towards equal shares.
What a row "looks like" here is its language by text alone, so no declared value feeds itself.

The languages are a parameter, so every model is small: languages x ``BUCKETS`` counts, and
languages x (languages + 2) for declarations.  Host tables are joined, not collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.scratch import stage, tidy
from tidemark.llm.words import chunks

LANGUAGES = ("de", "en", "es", "fr")
UNKNOWN = "und"
BITS = 14
BUCKETS = 1 << BITS
TEMPER = 0.3
ADD = 0.5          # added to each 3-gram's count
PRIOR_ROWS = 20.0  # rows of the wider level that a host's own counts are mixed with
ACCEPT = 0.6       # posterior from which a language is accepted
UND_ROWS = 1.0     # pseudo rows of ``und`` in the prior of all rows

_LETTER = np.zeros(256, np.uint8)  # lower-cased letters as they are, all else 0
_LETTER[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTER[0x41:0x5B] = np.arange(0x61, 0x7B)
_LETTER[0x80:] = np.arange(0x80, 0x100)


def _grams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the 3-grams that have a letter in the middle, and how many come before each document and at the end."""
    letters = _LETTER[data]
    padded = np.zeros(len(letters) + 2, np.uint32)
    padded[1:-1] = letters
    left, right = padded[:-2].copy(), padded[2:].copy()
    starts, ends = bounds[:-1][bounds[:-1] < bounds[1:]], bounds[1:][bounds[:-1] < bounds[1:]]
    left[starts], right[ends - 1] = 0, 0
    at = np.flatnonzero(letters)
    code = (left[at] * np.uint32(0x9E3779B1) + letters[at]) * np.uint32(0x85EBCA6B) + right[at]
    return (code * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BITS), np.searchsorted(at, bounds)


def _counter(languages: tuple[str, ...]):
    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), BUCKETS), np.int64)
        number = {name: k for k, name in enumerate(languages)}
        for batch in batches:
            declared = np.array([number.get(x, -1) for x in batch.column("declared").to_pylist()])
            for row, end, data, bounds in chunks(batch.column("text")):
                grams, first = _grams(data, bounds)
                of = np.repeat(declared[row:end], np.diff(first))
                total += np.bincount(of[of >= 0] * BUCKETS + grams[of >= 0], minlength=total.size).reshape(total.shape)
        which, bucket = np.nonzero(total)
        yield pa.record_batch([pa.array(which.astype(np.int32)), pa.array(bucket.astype(np.int32)), pa.array(total[which, bucket])], names=["which", "bucket", "n"])

    return count


def _likelihoods(table):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log_p: np.ndarray = table.value
        for batch in batches:
            for row, end, data, bounds in chunks(batch.column("text")):
                grams, first = _grams(data, bounds)
                sums = np.stack([np.diff(np.concatenate([[0.0], np.cumsum(line[grams], dtype=np.float64)])[first]) for line in log_p], axis=1)
                part = batch.slice(row, end - row)
                yield pa.record_batch([*part.columns[:-1], pa.array(np.diff(first).astype(np.int64)), pa.array(list(sums), pa.list_(pa.float64()))], names=[*batch.schema.names[:-1], "n_letters", "log_text"])

    return run


def _text_models(rows: DataFrame, languages: tuple[str, ...]) -> np.ndarray:
    """log P(3-gram | language), a line for each language and one for ``und``."""
    counts = rows.select("declared", "text").filter(F.col("declared").isin(*languages)).mapInArrow(_counter(languages), "which int, bucket int, n long")
    seen = counts.groupBy("which", "bucket").agg(F.sum("n").alias("n")).toArrow()  # at most languages x BUCKETS rows
    total = np.zeros((len(languages), BUCKETS))
    total[seen["which"].to_numpy(), seen["bucket"].to_numpy()] = seen["n"].to_numpy()
    log_p = np.log((total + ADD) / (total.sum(axis=1, keepdims=True) + ADD * BUCKETS))
    log_p[total.sum(axis=1) == 0] = -2 * np.log(BUCKETS)  # nothing is known of a language that no row declares
    return np.vstack([log_p, np.full(BUCKETS, -np.log(BUCKETS))])


def _argmax(values: Column, names: Column) -> Column:
    return F.element_at(names, F.array_position(values, F.array_max(values)).cast("int"))


def _shares(rows: DataFrame, value: str, names: tuple[str, ...]) -> DataFrame:
    """log P(value | language) for each value seen, smoothed by one row: (value, log_value)."""
    per = rows.groupBy(value, "looks").agg(F.count("*").alias("n"))
    wide = per.groupBy(value).agg(*(F.coalesce(F.sum(F.when(F.col("looks") == x, F.col("n"))), F.lit(0)).alias(f"n_{k}") for k, x in enumerate(names)))
    sums = rows.groupBy("looks").agg(F.count("*").alias("n")).collect()  # one row for each language
    total = {r.looks: r.n for r in sums}
    values = max(1, wide.count())
    logs = [F.log((F.col(f"n_{k}") + 1.0) / float(total.get(x, 0) + values)) for k, x in enumerate(names)]
    return wide.select(value, F.array(*logs).alias(f"log_{value}"))


def _host_priors(rows: DataFrame, names: tuple[str, ...]) -> tuple[DataFrame, list[float]]:
    """log P(language | host), smoothed towards the site, all rows and equal shares: (host, log_host), and that of all rows, with those that have no host."""
    tally = [F.coalesce(F.sum(F.when(F.col("looks") == x, F.col("n"))), F.lit(0)).alias(f"n_{k}") for k, x in enumerate(names)]
    every = stage(rows.groupBy("host", "looks").agg(F.count("*").alias("n")), "hosts")
    per = every.filter("host is not null").withColumn("site", F.regexp_extract("host", r"([^.]+\.[^.]+)$|^([^.]*)$", 0))
    everything = every.agg(*tally).collect()[0]
    start = [(UND_ROWS if x == UNKNOWN else 1.0) for x in names]
    whole = [(everything[k] + start[k]) / (sum(everything) + sum(start)) for k in range(len(names))]
    sites = per.groupBy("site").agg(*tally)
    n_site = sum(F.col(f"n_{k}") for k in range(len(names)))
    sites = sites.select("site", *((F.col(f"n_{k}") + PRIOR_ROWS * whole[k]).alias(f"s_{k}") for k in range(len(names))), (n_site + PRIOR_ROWS).alias("s"))
    hosts = per.groupBy("host", "site").agg(*tally)
    n_host = sum(F.col(f"n_{k}") for k in range(len(names)))
    joined = hosts.join(sites, "site")
    priors = [F.log((F.col(f"n_{k}") + PRIOR_ROWS * F.col(f"s_{k}") / F.col("s")) / (n_host + PRIOR_ROWS)) for k in range(len(names))]
    return joined.select("host", F.array(*priors).alias("log_host")), [float(np.log(x)) for x in whole]


def identify(rows: DataFrame, languages: tuple[str, ...] = LANGUAGES) -> DataFrame:
    """Language of every row of (id, text, declared, suffix, host): id, language, posterior, accepted, text_language, declared, n_letters.

    ``declared`` is the markup's language (its part before ``-`` or ``_``, lower-cased, counts);
    declared, suffix and host may be null, which is no evidence (a null host, and one without any
    lettered text, has the prior of all rows).  Null, empty and letter-less texts have no text evidence and ``und`` as text_language;
    their language rests on the rest but they are never accepted.  Ties go to the language first
    in order, ``und`` last.  A row is accepted if a language other than ``und`` has a posterior of
    0.6 or more.  Repeated rows each get a row, and an empty table gives none.
    """
    names = (*languages, UNKNOWN)
    spark = rows.sparkSession
    known = F.regexp_extract(F.lower(F.trim("declared")), "^[a-z]+", 0)
    rows = rows.select(F.col("id").cast("long").alias("id"), F.when(known != "", known).alias("declared"), F.col("suffix").cast("string").alias("suffix"), F.col("host").cast("string").alias("host"), F.col("text").cast("string").alias("text"))
    table = spark.sparkContext.broadcast(_text_models(rows, languages))
    scored = stage(rows.mapInArrow(_likelihoods(table), "id long, declared string, suffix string, host string, n_letters long, log_text array<double>"), "text-evidence")
    labels = F.array(*map(F.lit, names))
    scored = scored.withColumn("looks", F.when(F.col("n_letters") > 0, _argmax(F.col("log_text"), labels)).otherwise(UNKNOWN))
    scored = scored.withColumn("says", F.when(F.col("declared").isNull() | F.col("declared").isin(*languages), F.col("declared")).otherwise("other"))

    flat = F.array(*[F.lit(0.0)] * len(names))
    says = {r.says: r.log_says for r in _shares(scored.filter("says is not null and n_letters > 0"), "says", names).collect()}  # languages + 1 rows
    log_says = flat
    for value, logs in says.items():
        log_says = F.when(F.col("says") == value, F.array(*map(F.lit, logs))).otherwise(log_says)
    suffixes = stage(_shares(scored.filter("suffix is not null and n_letters > 0"), "suffix", names), "suffixes")
    hosts, whole = _host_priors(scored.filter("n_letters > 0"), names)
    joined = scored.join(stage(hosts, "host-priors"), "host", "left").withColumn("log_host", F.coalesce("log_host", F.array(*map(F.lit, whole)))).join(suffixes, "suffix", "left")
    total = F.array(*(TEMPER * F.col("log_text")[k] + log_says[k] + F.coalesce(F.col("log_suffix")[k], F.lit(0.0)) + F.col("log_host")[k] for k in range(len(names))))
    joined = joined.withColumn("__total", total)
    top = F.array_max("__total")
    posterior = 1.0 / F.aggregate("__total", F.lit(0.0), lambda s, x: s + F.exp(x - top))
    out = joined.select("id", _argmax(F.col("__total"), labels).alias("language"), F.round(posterior, 6).alias("posterior"), F.col("looks").alias("text_language"), "declared", "n_letters")
    accepted = (F.col("n_letters") > 0) & (F.col("language") != UNKNOWN) & (F.col("posterior") >= ACCEPT)
    return out.select("id", "language", "posterior", accepted.alias("accepted"), "text_language", "declared", "n_letters")


def of_documents(docs: DataFrame) -> DataFrame:
    """Documents as rows to identify: lang is what they declare, source stands for the host; no address, so no suffix."""
    return docs.select(F.col("doc_id").alias("id"), "text", F.col("lang").cast("string").alias("declared"), F.lit(None).cast("string").alias("suffix"), F.col("source").cast("string").alias("host"))


def of_pages(pages: DataFrame) -> DataFrame:
    """Web pages as rows to identify: the html tag's lang, the host's last label, the host, and the text outside of tags."""
    html = F.col("html").cast("string")
    host = F.lower(F.try_parse_url(F.col("url").cast("string"), F.lit("HOST")))
    text = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " "), "<[^>]*>", " ")
    declared = F.regexp_extract(html, r"""(?i)<html[^>]*?\slang\s*=\s*["']?([A-Za-z-]+)""", 1)
    return pages.select(F.col("page_id").alias("id"), text.alias("text"), F.when(declared != "", declared).alias("declared"), F.regexp_extract(host, r"\.([a-z]+)$", 1).alias("suffix"), host.alias("host"))
