"""Operator 4, language identification by Bayesian evidence fusion.

Four pieces of evidence meet in one posterior per document:

* text: byte trigrams, each counted by itself, under one multinomial per language, learnt from the declared languages of all rows, and
  under a uniform one for "no language" (``und``);
* declared markup language: a smoothed table P(declared | language), estimated
  from the text posteriors by grouped aggregation;
* address suffix and host: P(language | host) is smoothed towards P(language |
  suffix), which is smoothed towards the whole corpus; all three are sums of
  text posteriors by grouped aggregation, a row's own share taken out.

A row is rejected when ``und`` wins or the winner's posterior stays below
``least``.  Every declared value is a language, however many there are.  Group sums
use salted parts, so one host may hold a third of all rows; only the language tables
(the trigrams that each language has, languages x languages) reach the driver.

Defined results: a text without letters, an empty or a null text is ``und`` and
rejected, whatever else is declared.  A null declared language is no evidence
(its own column in the table), a null host the host ''.  Repeated rows are judged
one by one, an exact tie goes to the language that sorts first.  An empty table
gives an empty result; so does a table without any declared language, in which
every row is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careledger.llm.common import columns_of, length_slices, spare_names, stored

GRAMS = 1 << 24             # trigrams of bytes
LEAST_KINDS = 1 << 15       # trigrams that a text in no language draws from at least, however small the corpus
MOST_COLUMNS = 64           # languages up to which sums are columns; beyond, they are rows
MOST_BROADCAST = 1000       # languages up to which P(declared | language) is broadcast
HELD = 1 << 20              # (language, trigram) counts that a task holds before it writes them
UND = "und"

#: Bytes that are no part of words count as blanks.
_BLANK = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def _grams(text: str | None) -> np.ndarray:
    """Every byte trigram of the text in lower case; runs of blanks count once."""
    raw = b" ".join((text or "").lower().encode("utf-8").translate(_BLANK).split())
    if not raw:
        return np.empty(0, np.int64)
    x = np.frombuffer(b" " + raw + b" ", np.uint8).astype(np.int64)
    return (x[:-2] << 16) | (x[1:-1] << 8) | x[2:]


def gram_counts(rows: DataFrame, languages: list[str]) -> DataFrame:
    """(language, gram, n) over all rows (text, declared) with a declared language of the list."""
    number = {x: i for i, x in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def write() -> pa.RecordBatch:
            keys, which = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            n = np.bincount(which, np.concatenate([n for _, n in held])).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(keys // GRAMS), pa.array(keys % GRAMS), pa.array(n)],
                                              names=["language", "gram", "n"])

        for batch in batches:
            for a, b in length_slices(batch.column(0)):
                part = batch.slice(a, b - a)
                keys = [_grams(text) + number[lang] * GRAMS for text, lang in zip(
                    part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True) if lang in number]
                if keys:
                    held.append(np.unique(np.concatenate(keys), return_counts=True))
                    size += len(held[-1][0])
                if size >= HELD:
                    yield write()
                    held, size = [], 0
        if held:
            yield write()

    return (rows.select("text", "declared").mapInArrow(run, "language long, gram long, n long")
            .groupBy("language", "gram").agg(F.sum("n").alias("n")))


class TextModel:
    """Log-probabilities of trigrams by language, the last one ``und`` (all trigrams alike): what a
    trigram without counts has, and what the counted ones have more."""

    def __init__(self, got, n: int, smooth: float):
        gram, language, count = (got[c].to_numpy(np.int64) for c in ("gram", "language", "n"))
        order = np.argsort(gram, kind="stable")
        self.grams, self.many = np.unique(gram, return_counts=True)
        self.first = np.cumsum(self.many) - self.many
        kinds = max(len(self.grams), LEAST_KINDS)
        total = np.bincount(language, count, n) + smooth * kinds
        self.base = np.append(np.log(smooth / total), -np.log(kinds))
        self.language, self.more = language[order].astype(np.int32), np.log((count[order] + smooth) / smooth)

    def likelihood(self, grams: np.ndarray) -> np.ndarray:
        """Log-likelihood of a text under every language."""
        if not len(self.grams):
            return np.zeros(len(self.base))
        spot = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        spot = spot[self.grams[spot] == grams]
        many = self.many[spot]
        at = np.repeat(self.first[spot] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        return np.bincount(self.language[at], self.more[at], len(self.base))


def text_model(rows: DataFrame, languages: list[str], smooth: float = 0.5) -> TextModel:
    """The model of all rows with a declared language (collects the trigrams that each language has)."""
    return TextModel(gram_counts(rows, languages).toPandas(), len(languages), smooth)


def text_evidence(rows: DataFrame, model: TextModel, temper: float = 0.33) -> DataFrame:
    """id, declared, host, suffix, n_grams, the tempered log-likelihoods ``ll`` (neighbouring trigrams
    share bytes, so their likelihoods do not count in full) and the posteriors ``p`` of them alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in length_slices(batch.column(0)):
                part = batch.slice(a, b - a)
                grams = [_grams(t) for t in part.column(0).to_pylist()]
                ll = np.stack([(model.likelihood(g) + len(g) * model.base) * temper for g in grams])
                p = np.exp(ll - ll.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                ends = pa.array(np.arange(len(grams) + 1) * ll.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array([len(g) for g in grams], pa.int64()),
                     *(pa.ListArray.from_arrays(ends, pa.array(x.ravel())) for x in (ll, p))],
                    names=["id", "declared", "host", "suffix", "n_grams", "ll", "p"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("text", "id", "declared", "host", "suffix").mapInArrow(
        run, f"id {kind}, declared string, host string, suffix string, n_grams long, ll array<double>, p array<double>")


def _summed(df: DataFrame, keys: list[str], n: int, of: str) -> DataFrame:
    """(keys..., of): sums of an array column by place."""
    if n <= MOST_COLUMNS:
        return df.groupBy(*keys).agg(*[F.sum(F.col(of)[i]).alias(f"_s{i}") for i in range(n)]).select(
            *keys, F.array(*[F.col(f"_s{i}") for i in range(n)]).alias(of))
    sums = df.select(*keys, F.posexplode(of).alias("_at", "_x")).groupBy(*keys, "_at").agg(F.sum("_x").alias("_x"))
    whole = sums.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_at", "_x"))).alias("_all"))
    return whole.select(*keys, F.transform("_all", lambda x: x["_x"]).alias(of))


def _total(of: str) -> Column:
    return F.aggregate(of, F.lit(0.0), lambda a, x: a + x)


def host_priors(evidence: DataFrame, n: int, strength: float) -> DataFrame:
    """(host, suffix, s, size, prior): a host's posterior sums, their total and the smoothed prior of its suffix."""
    hosts = stored(_summed(evidence, ["host", "suffix"], n, "p").withColumnRenamed("p", "s"), "language-hosts")
    whole = (_summed(hosts, [], n, "s").first() or [None])[0] or [None] * n
    total = sum(x or 0.0 for x in whole)
    # One literal, as a plan with thousands of them takes long.
    corpus = F.split(F.lit(" ".join(repr(float(((x or 0.0) + 1.0) / (total + n))) for x in whole)), " ").cast("array<double>")
    # Suffix sums in parts, as one suffix may own most hosts.
    parts = hosts.withColumn("_part", F.pmod(F.xxhash64("host"), F.lit(64))).withColumn("size", _total("s"))
    heads = _summed(parts, ["suffix", "_part"], n, "s").withColumnRenamed("s", "t")
    suffixes = _summed(heads, ["suffix"], n, "t").withColumn("_size", _total("t"))
    # Sizes are columns below a join, so that no lambda sums them up again for each language.
    heads = heads.select("suffix", "_part").join(suffixes, "suffix")
    prior = F.transform(F.zip_with("t", corpus, lambda t, c: t + strength * c), lambda x: x / (F.col("_size") + strength))
    return parts.join(heads, ["suffix", "_part"]).select("host", "suffix", "s", "size", prior.alias("suffix_prior"))


def identify(rows: DataFrame, languages: list[str] | None = None, least: float = 0.5, strength: float = 20.0,
             salts: int = 64) -> DataFrame:
    """Judge ``rows`` (id, text, declared, host): one row each with declared, host, n_grams, lang, prob, kept."""
    host = F.coalesce("host", F.lit(""))
    rows = rows.select("id", "text", F.lower("declared").alias("declared"), host.alias("host"),
                       F.when(F.contains(host, F.lit(".")), F.substring_index(host, ".", -1)).otherwise("").alias("suffix"))
    if languages is None:
        languages = [r.declared for r in rows.where(F.col("declared").isNotNull()).select("declared").distinct().collect()]
    languages = sorted(x for x in languages if x != UND)
    n = len(languages) + 1
    known = F.when(F.col("declared").isin(languages), F.col("declared")).otherwise("")
    ev = stored(text_evidence(rows, text_model(rows, languages)).withColumn("known", known), "language-evidence")
    # P(declared | language), smoothed; at most languages x (languages + 1) numbers.
    table = np.ones((n, n)) * 0.5
    spot = {x: i for i, x in enumerate([*languages, ""])}
    for r in _summed(ev.where("n_grams > 0"), ["known"], n, "p").collect():
        table[:, spot[r.known]] += r.p
    table = np.log(table / table.sum(1, keepdims=True))
    said = rows.sparkSession.createDataFrame([(d, table[:, j].tolist()) for d, j in spot.items()],
                                             "known string, said array<double>")
    ev = ev.join(F.broadcast(said) if n <= MOST_BROADCAST else said, "known")
    # Host priors, a row's own share taken out; the join is salted against a hot host.
    hosts = host_priors(ev, n, strength)
    parts = ev.withColumn("_part", F.pmod(F.xxhash64("id", "n_grams"), F.lit(salts)))
    heads = parts.select("host", "suffix", "_part").distinct().join(hosts, ["host", "suffix"])
    ev = parts.join(heads, ["host", "suffix", "_part"])
    others = F.zip_with(F.zip_with("s", "p", lambda s, p: F.greatest(s - p, F.lit(0.0))), "suffix_prior",
                        lambda s, t: s + strength * t)
    prior = F.transform(others, lambda x: F.log(x / (F.greatest(F.col("size") - 1, F.lit(0.0)) + strength)))
    logs = F.zip_with(F.zip_with("ll", prior, lambda a, b: a + b), "said", lambda a, b: a + b)
    best = F.array_position("logs", F.array_max("logs")).cast("int")

    def add(s: Column, x: Column) -> Column:
        """The largest so far, and the sum of all in shares of it."""
        top = F.greatest(s["top"], x)
        return F.struct(top.alias("top"), (s["sum"] * F.exp(s["top"] - top) + F.exp(x - top)).alias("sum"))

    shares = F.aggregate("logs", F.struct(F.lit(-1e300).alias("top"), F.lit(0.0).alias("sum")), add, lambda s: 1 / s["sum"])
    names = F.array(*[F.lit(x) for x in [*languages, UND]])
    silent = F.col("n_grams") == 0
    return (ev.withColumn("logs", logs)
            .withColumn("lang", F.when(silent, UND).otherwise(F.element_at(names, best)))
            .withColumn("prob", F.when(silent, 1.0).otherwise(shares))
            .withColumn("kept", (F.col("lang") != UND) & (F.col("prob") >= least))
            .select("id", "declared", "host", "n_grams", "lang", "prob", "kept"))


def document_rows(docs: DataFrame) -> DataFrame:
    """Documents declare ``lang``; their source stands for the host."""
    return docs.select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("declared"), F.col("source").alias("host"))


def page_rows(pages: DataFrame) -> DataFrame:
    """Pages declare the language in their markup; the address gives host and suffix."""
    html = F.coalesce("html", F.lit(""))
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    declared = F.regexp_extract(html, r"""(?i)<html\b[^>]*\blang\s*=\s*["']?([a-z]{2,3})\b""", 1)
    return pages.select(F.col("page_id").alias("id"), text.alias("text"), F.nullif(declared, F.lit("")).alias("declared"),
                        F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)).alias("host"))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents whose language is found, with their columns as they are."""
    # Rows are judged one by one: only those that agree in all that a verdict is made of share a key.
    key, = spare_names(docs, "key")
    own = F.sha2(F.to_json(F.struct("doc_id", "text", "lang", "source")), 256)
    judged = identify(document_rows(docs.select(own.alias("doc_id"), "text", "lang", "source")))
    kept = judged.where("kept").select(F.col("id").alias(key)).distinct()
    return docs.withColumn(key, own).join(kept, key, "left_semi").select(*columns_of(docs))
