"""Quality rules with an n-gram perplexity.

Base rules count words, symbols, repeated lines and repeated word windows. The method is a modified Kneser-Ney model a
language (atelier.llm.ngrams), counted over all documents that pass the base rules and hold few symbols and capitals. Each
language gets a lower and an upper band of the perplexity: the median over those documents, give or take `lower` or
`upper` median deviations. A deviation is shrunk towards that of all languages where a language has few documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from atelier.llm import ngrams
from atelier.llm import words as W
from atelier.llm.shared import table, written

#: Median deviations below and above the median.
LOWER, UPPER = 10.0, 10.0
BIN = 0.004  # of the natural logarithm of a perplexity
#: Documents that weigh as much as all languages together in a language's deviation.
SHRINK = 50
#: Entries of the model that are broadcast, at most (about 20 bytes each); beyond them documents and model are joined.
BROADCAST = 6_000_000
#: Languages whose bands are broadcast, at most.
LANGUAGES = 100_000

_SYMBOL = ~W.byte_class(b"#*$%&|<>")
_CAPITAL = ~W.byte_class(bytes(range(0x41, 0x5B)))
_LINE = W.byte_class(b"\n")


@dataclass
class Base:
    """Counts by row of a chunk."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    failed: np.ndarray
    #: passes the base rules, with at most a tenth of symbols and three tenths of capitals
    plain: np.ndarray


def _by_row(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.append(0, np.cumsum(mask))[offsets])


def base(c: W.Chunk) -> Base:
    rows = c.hi - c.lo
    n_words = c.n_words
    salt = np.arange(rows, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    chars = _by_row(W.PLAIN[c.data] & ((c.data & 0xC0) != 0x80), c.offsets)
    symbols = _by_row(_SYMBOL[c.data], c.offsets)
    # windows of three words that occur again in their row
    at = np.flatnonzero(c.valid(3))
    _, which, n = np.unique(W.mix(W.grams(c.hashes, 3)[at] ^ salt[c.row[at]]), return_inverse=True, return_counts=True)
    again = at[n[which] > 1]
    covered = np.zeros(len(c.starts), bool)
    for i in range(3):
        covered[again + i] = True
    # lines
    starts, ends = W.bounds(_LINE[c.data], c.offsets) if len(c.data) else (c.starts, c.ends)
    wordy = np.searchsorted(c.starts, ends) > np.searchsorted(c.starts, starts)
    starts, ends = starts[wordy], ends[wordy]
    row = np.searchsorted(c.offsets, starts, "right") - 1
    _, first, n = np.unique(W.mix(W.segment_hash(c.data, starts, ends) ^ salt[row]), return_index=True, return_counts=True)
    dup = np.bincount(row[first], n - 1, minlength=rows).astype(np.int64)
    repeat = _by_row(covered, c.first)
    failed = (n_words < 50) | (100 * repeat > 50 * n_words)
    plain = ~failed & (10 * symbols <= chars) & (10 * _by_row(_CAPITAL[c.data], c.offsets) <= 3 * chars)
    return Base(n_words, chars, symbols, dup, repeat, failed, plain)


def fit(docs: DataFrame) -> DataFrame:
    """The model as a table (kind, key, value) in the shared folder."""
    docs = docs if "lang" in docs.columns else docs.withColumn("lang", F.lit(""))
    return written(ngrams.hashed(ngrams.estimate(ngrams.counts(docs, lambda c: base(c).plain))), "model")


def _free(docs: DataFrame, name: str) -> str:
    """A column name that docs does not have."""
    while name.lower() in (c.lower() for c in docs.columns):
        name += "_"
    return name


_BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, plain boolean"
_RULES = f"struct<{_BASE}, log_perplexity double>".replace(" ", ": ").replace(",: ", ", ")


def scored(docs: DataFrame, model: DataFrame, *, broadcast: int = BROADCAST) -> tuple[DataFrame, str]:
    """docs, all columns kept, with a struct of base counts and log perplexity (null without a symbol or a model), and its name."""
    name = _free(docs, "_rules")
    small = model.count() <= broadcast
    shared = docs.sparkSession.sparkContext.broadcast(ngrams.loaded(model)) if small else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for c in W.chunks(batch.column("text"), W.PLAIN):
                b = base(c)
                logs = np.full(c.hi - c.lo, np.nan)
                if shared:
                    s = ngrams.symbols(c)
                    n = np.bincount(s.row, minlength=len(logs))
                    own = shared.value.logs(s, ngrams.salts(batch.column("lang").slice(c.lo, c.hi - c.lo).to_pylist())[s.row])
                    logs[n > 0] = (np.bincount(s.row, own, minlength=len(logs))[n > 0] / -n[n > 0]) if len(own) else logs[n > 0]
                counts = [pa.array(x.astype(np.int64)) for x in (b.n_words, b.word_chars, b.n_symbols, b.n_dup_lines, b.n_repeat_words)]
                columns = [*counts, pa.array(b.failed), pa.array(b.plain), pa.array(logs, from_pandas=True)]
                parts.append(pa.StructArray.from_arrays(columns, names=[x.split()[0] for x in _BASE.split(", ")] + ["log_perplexity"]))
            made = pa.concat_arrays(parts) if parts else pa.array([], pa.struct([]))
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in kept), made], names=[*kept, name])

    kept = [*docs.columns, *(x for x in ("lang",) if x not in docs.columns)]
    given = docs.withColumn("lang", F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema)
    out = given.mapInArrow(run, f"{schema}, `{name}` {_RULES}")
    if small:
        return out.select(*docs.columns, name), name
    row = _free(docs, "_row")
    out = written(out.withColumn(row, F.monotonically_increasing_id()), "rows")
    logs = ngrams.joined(out.select(row, "lang", "text"), model, row=row).select(F.col("row").alias(row), F.col("log").alias("_log"))
    symbols = F.greatest(F.length("text"), F.lit(1))
    both = out.join(logs, row, "left").withColumn(name, F.col(name).withField("log_perplexity", -F.col("_log") / symbols))
    return both.select(*docs.columns, name), name


def _median(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by, median) of values with n occurrences each; a group has as many rows as there are bins."""
    sums = Window.partitionBy(*by)
    until = F.sum("n").over(sums.orderBy(value)) * 2 >= F.sum("n").over(sums)
    return rows.withColumn("_until", until).where("_until").groupBy(*by).agg(F.min(value).alias("median"))


def bands(rules: DataFrame, *, lower: float = LOWER, upper: float = UPPER) -> DataFrame:
    """(lang, low, high) of the log perplexity, from histograms over all plain documents; rules: (lang, plain, log_perplexity)."""
    language = F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang")
    binned = rules.where(F.col("plain") & F.col("log_perplexity").isNotNull()).groupBy(language, F.floor(F.col("log_perplexity") / BIN).alias("b")).agg(F.count("*").alias("n"))
    binned = written(binned, "histogram")
    middle = _median(binned, ["lang"], "b").withColumnRenamed("median", "middle")
    away = written(binned.join(middle, "lang").groupBy("lang", "middle", F.abs(F.col("b") - F.col("middle")).alias("d")).agg(F.sum("n").alias("n")), "deviations")
    own = _median(away, ["lang", "middle"], "d").join(away.groupBy("lang").agg(F.sum("n").alias("n")), "lang")
    pool = _median(away.groupBy("d").agg(F.sum("n").alias("n")).withColumn("_all", F.lit(1)), ["_all"], "d").select(F.col("median").alias("pool"))
    reach = F.greatest((F.col("n") * F.col("median") + SHRINK * F.col("pool")) / (F.col("n") + SHRINK), F.lit(1.0)) * BIN
    at = (F.col("middle") + 0.5) * BIN
    return own.join(F.broadcast(pool)).select("lang", (at - lower * reach).alias("low"), (at + upper * reach).alias("high"))  # pool is one row


def rules(docs: DataFrame, *, lower: float = LOWER, upper: float = UPPER, broadcast: int = BROADCAST, keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """docs (all columns, or those in keep) with a struct of the base counts, base_failed, log_perplexity, low, high and kept; and its name.

    Null and empty texts fail the base rules, with a null perplexity; a null language is one of its own; repeated rows
    each get their result; an empty table gives an empty table. A language without a plain document has no model and no
    band: what passes the base rules is kept.
    """
    keep = docs.columns if keep is None else keep
    found, name = scored(docs, fit(docs), broadcast=broadcast)
    lang = _free(docs, "_lang")
    language = F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")
    found = written(found.select(*keep, name, language.alias(lang)), "rules")
    limits = written(bands(found.select(F.col(lang).alias("lang"), f"{name}.*"), lower=lower, upper=upper), "bands")
    limits = F.broadcast(limits) if limits.count() <= LANGUAGES else limits
    both = found.join(limits.select(F.col("lang").alias(lang), F.struct("low", "high").alias(f"{name}_band")), lang, "left")
    low, high = F.col(f"{name}_band.low"), F.col(f"{name}_band.high")
    inside = F.coalesce(F.col(f"{name}.log_perplexity").between(low, high), F.lit(True))
    more = F.col(name).withField("low", low).withField("high", high).withField("kept", ~F.col(f"{name}.base_failed") & inside)
    return both.select(*keep, more.alias(name)), name


def filtered(docs: DataFrame, *, lower: float = LOWER, upper: float = UPPER) -> DataFrame:
    """The rows of docs that rules() keeps, with all their columns; no row is shuffled."""
    found, name = rules(docs, lower=lower, upper=upper)
    return found.where(F.col(f"{name}.kept")).select(*docs.columns)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, name = rules(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), keep=["doc_id"])
    counts = [f"{name}.{x}" for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")]
    band = [F.exp(f"{name}.{x}").alias(y) for x, y in (("log_perplexity", "perplexity"), ("low", "lower"), ("high", "upper"))]
    return found.select("doc_id", *counts, *band)


QUERIES = {"op3_quality_rules": op3_quality_rules}
ORACLE: dict[str, str] = {}
