"""Language identification by Bayesian fusion of text, markup, address and host evidence.

Posterior of language l for a document, up to its normaliser:

    P(text | l) ^ TEMPER  x  P(declared | l)  x  P(suffix | l)  x  P(l | host)

* text: a multinomial model over hashed byte trigrams of words, beside an
  "undetermined" model that is uniform over the buckets;
* declared: the language that the markup (or a metadata column) names, through
  a confusion table of what documents that read as l declare;
* suffix: the last label of the address's host, by the same kind of table;
* host: the host's own mix, smoothed toward its domain's mix, which is smoothed
  toward the corpus's.

All three tables are grouped aggregations over all documents, of the language
that the text alone gives; only the text model is fitted on a sample, of
``TRAIN_ROWS`` rows for each declared language as expected by a hash. A
declared language with fewer than ``MIN_ROWS`` usable rows, or whose code is no
two-letter code of ISO 639 (``CODES``), has no text model.
Its documents have one class more, of their declared language, that the text
speaks neither for nor against: the other evidence decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.llm.common import fresh, staged

BUCKETS = 1 << 15
TRAIN_ROWS = 20_000     # labelled rows of each language that the text model is fitted on, as expected
MIN_ROWS = 5            # usable labelled rows that a text model takes, whatever the corpus's size and mix
USABLE = r"[A-Za-z]{3}|[^\x00-\x7F]"  # what a text must have to be learnt from
TEMPER = 1 / 3          # trigrams overlap: each letter stands in three
SMOOTH = 0.5            # pseudo-counts of a trigram bucket
HOST_WEIGHT = 20.0      # pseudo-documents that a host takes from its domain, and a domain from the corpus
EVIDENCE_WEIGHT = 1.0   # pseudo-counts in the declared and suffix tables
UNDETERMINED = "und"
MIN_CONFIDENCE = 0.5
MIN_TRIGRAMS = 3        # a text with fewer says too little to count in the tables

# ASCII letters lower-cased, other ASCII turned into spaces, the rest left as it is.
_FOLD = bytes(b if b >= 128 or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))


def trigram_buckets(text: bytes) -> np.ndarray:
    """Buckets of the byte trigrams of the words, each word with one space around it."""
    b = np.frombuffer(b" " + text.translate(_FOLD) + b" ", np.uint8).astype(np.uint32)
    word = b != 32
    keep = (word[:-2].astype(np.int8) + word[1:-1] + word[2:]) >= 2
    codes = (b[:-2] << 16 | b[1:-1] << 8 | b[2:])[keep]
    return ((codes * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64)


# The two-letter language codes of ISO 639. Only these can have a text model, so that its size is bounded.
CODES = frozenset("""
aa ab ae af ak am an ar as av ay az ba be bg bh bi bm bn bo br bs ca ce ch co cr cs cu cv cy da de dv dz ee el en eo es et eu fa ff fi fj fo fr fy
ga gd gl gn gu gv ha he hi ho hr ht hu hy hz ia id ie ig ii ik io is it iu ja jv ka kg ki kj kk kl km kn ko kr ks ku kv kw ky la lb lg li ln lo lt lu lv
mg mh mi mk ml mn mr ms mt my na nb nd ne ng nl nn no nr nv ny oc oj om or os pa pi pl ps pt qu rm rn ro ru rw sa sc sd se sg si sk sl sm sn so sq sr ss
st su sv sw ta te tg th ti tk tl tn to tr ts tt tw ty ug uk ur uz ve vi vo wa wo xh yi yo za zh zu
""".split())


@dataclass
class TextModel:
    """Log-likelihood of each bucket under each language; the last column is the undetermined one."""

    languages: list[str]
    weights: np.ndarray
    others: bool = False  # whether languages without a model are declared too

    def score(self, text: str | None) -> list[float]:
        """Log-likelihoods by language, undetermined, and then the numbers of trigrams and of letters."""
        raw = (text or "").encode("utf-8", "replace")
        got = trigram_buckets(raw)
        total = np.zeros(self.weights.shape[1])
        step = min(1 << 18, max(1, (1 << 24) // len(total)))
        for at in range(0, len(got), step):
            total += self.weights[got[at:at + step]].sum(axis=0, dtype=np.float64)
        return [*total.tolist(), float(len(got)), float(len(raw.translate(_FOLD).replace(b" ", b"")))]


def normal_language(c: Column) -> Column:
    """'EN-us' and 'en_GB' as 'en'; null and blank as null."""
    name = F.lower(F.regexp_extract(c, r"^\s*([A-Za-z]+)", 1))
    return F.when(name != "", name)


def fit_text_model(docs: DataFrame, text: str, declared: Column, key: Column, train_rows: int = TRAIN_ROWS) -> TextModel:
    """Counts trigrams by declared language over a hashed sample; counting itself is a grouped sum."""
    labelled = docs.select(F.col(text).alias("text"), normal_language(declared).alias("lang"), key.alias("key"))
    usable = F.coalesce(F.col("text").rlike(USABLE), F.lit(False))
    each = labelled.filter("lang is not null").groupBy("lang").agg(F.count_if(usable).alias("n"))
    # Languages without a model are one row together.
    rows = each.groupBy(F.when((F.col("n") >= MIN_ROWS) & F.col("lang").isin(sorted(CODES)), F.col("lang")).alias("lang")).agg(F.sum("n").alias("n")).collect()
    sizes = {r["lang"]: r["n"] for r in rows if r["lang"] is not None}
    languages, others = sorted(sizes), len(sizes) < len(rows)
    if not languages:
        return TextModel([], np.full((BUCKETS, 1), -np.log(BUCKETS)), others)
    share = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(1.0, train_rows / n))) for k, n in sizes.items()])
    part = F.pmod(F.xxhash64(F.lit("train"), "key"), F.lit(1_000_000)) / 1_000_000
    sample = labelled.filter(F.col("lang").isin(languages) & usable & (part < share)).select("lang", "text")

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for t in it:
            for k, x in zip(t.column("lang").to_pylist(), t.column("text").to_pylist(), strict=True):
                got = np.bincount(trigram_buckets((x or "").encode("utf-8", "replace")), minlength=BUCKETS)
                total[k] = total[k] + got if k in total else got
        for k, n in total.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(some), pa.string()), pa.array(some, pa.int64()), pa.array(n[some], pa.int64())], ["lang", "bucket", "n"])

    counted = sample.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # Languages x buckets numbers at most, whatever the corpus.
    counts = np.full((BUCKETS, len(languages)), SMOOTH)
    for r in counted.toPandas().itertuples(index=False):
        counts[r.bucket, languages.index(r.lang)] += r.n
    logs = np.log(counts / counts.sum(axis=0))
    return TextModel(languages, np.hstack([logs, np.full((BUCKETS, 1), -np.log(BUCKETS))]).astype(np.float32), others)


def _score_column(model: TextModel, text: str) -> Column:
    shared = model

    def scores(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in it:
            yield pa.array([shared.score(x.as_py()) for x in texts], pa.list_(pa.float64()))

    return F.arrow_udf(scores, T.ArrayType(T.DoubleType()))(F.col(text))


def host_of(address: Column) -> Column:
    """The host of an address, or the whole string where it isn't one; null for null."""
    rest = F.regexp_replace(F.lower(address), r"^[a-z][a-z0-9+.-]*://(?:[^/@]*@)?", "")
    return F.regexp_extract(rest, r"^([^/:?#]*)", 1)


def domain_of(host: Column) -> Column:
    """The last two labels of a host with at least two."""
    return F.when(host.contains("."), F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1))


def suffix_of(host: Column) -> Column:
    return F.when(host.contains("."), F.regexp_extract(host, r"\.([a-z]{2,})$", 1))


def html_language(html: Column) -> Column:
    """The language that a page's html element declares."""
    return F.regexp_extract(html, r"""(?i)<html[^>]*?\slang\s*=\s*["']?([A-Za-z]+)""", 1)


def _mix(rows: DataFrame, by: str, n: int) -> DataFrame:
    """Documents by language that the text alone gives, for each value of ``by``, as an array."""
    return rows.filter(F.col(by).isNotNull()).groupBy(by).agg(
        F.array(*[_docs(i) for i in range(n)]).cast("array<double>").alias("n"))


def _docs(i: int) -> Column:
    """Documents whose text is in the i-th language."""
    return F.sum(F.when(F.col("guess") == i, F.col("docs")).otherwise(0.0))


def _sum(a: str) -> str:
    return f"aggregate({a}, 0D, (s, x) -> s + x)"


def _toward(counts: str, prior: str) -> Column:
    """Counts smoothed by HOST_WEIGHT pseudo-documents spread as the prior."""
    return F.expr(f"transform({counts}, (x, i) -> (x + {HOST_WEIGHT}D * {prior}[i]) / ({_sum(counts)} + {HOST_WEIGHT}D))")


def _other(model: TextModel) -> Column:
    """Whether a row declares a language that has no text model."""
    return F.col("declared").isNotNull() & ~F.col("declared").isin(model.languages) if model.others else F.lit(False)


@dataclass
class Evidence:
    """Log-evidence tables; each has one row for a value and an array by language, those without a model as the last."""

    model: TextModel
    corpus: list[float]
    hosts: DataFrame
    declared: DataFrame
    suffixes: DataFrame


def gather(scored: DataFrame, model: TextModel) -> Evidence:
    """The tables, from rows (declared, host, domain, suffix, ll) of all documents."""
    m = len(model.languages)
    k = m + model.others
    first = F.expr(f"array_position(slice(ll, 1, {m + 1}), array_max(slice(ll, 1, {m + 1})))").cast("int") - 1
    guess = F.when(_other(model), F.lit(m)).when(first < m, first)
    # The scores are read once; all tables are made of these counts.
    rows = scored.filter(F.col("ll")[m + 1] >= MIN_TRIGRAMS).withColumn("guess", guess).filter("guess is not null")
    rows = staged(rows.groupBy("declared", "host", "domain", "suffix", "guess").agg(F.count(F.lit(1)).cast("double").alias("docs")), "counts")
    totals = rows.agg(*[_docs(i).alias(f"n{i}") for i in range(k)]).first() if k else ()
    n = np.array([x or 0.0 for x in totals]) if k else np.zeros(0)
    corpus = ((n + 1) / (n.sum() + k)).tolist() if k else []
    whole = F.array(*[F.lit(x) for x in corpus]).cast("array<double>")
    domains = _mix(rows, "domain", k).withColumn("w", whole).select("domain", _toward("n", "w").alias("p"))
    of_host = rows.groupBy("host").agg(F.first("domain").alias("domain"))
    hosts = staged(_mix(rows, "host", k).join(of_host, "host").join(domains, "domain", "left")
                   .withColumn("w", F.coalesce("p", whole))
                   .select("host", F.transform(_toward("n", "w"), lambda x: F.log(x)).alias("host_log")), "hosts")

    def table(by: str) -> DataFrame:
        got = _mix(rows, by, k)
        values = got.count() or 1
        each = F.array(*[F.lit(float(x)) for x in n]).cast("array<double>")
        smooth = f"transform(n, (x, i) -> ln((x + {EVIDENCE_WEIGHT}D) / (t[i] + {EVIDENCE_WEIGHT * values}D)))"
        return staged(got.withColumn("t", each).select(by, F.expr(smooth).alias(f"{by}_log")), by)

    return Evidence(model, corpus, hosts, table("declared"), table("suffix"))


def _posterior(df: DataFrame, e: Evidence, out: tuple[str, str, str]) -> DataFrame:
    """lang, confidence and keep from ll, host_log, declared_log and suffix_log."""
    langs = [*e.model.languages, UNDETERMINED]
    k = len(e.model.languages)
    # The undetermined model takes no other evidence: its prior is what the corpus's rarest language has.
    rest = " + ".join(f"coalesce({t}[i], 0D)" for t in ("declared_log", "suffix_log", "host_log"))
    rarest = float(np.log(min(e.corpus[:k]))) if k else 0.0
    texts = f"slice(ll, 1, {k + 1})"
    log = f"transform({texts}, (x, i) -> x * {TEMPER}D + if(i < {k}, {rest}, und))"
    und = F.lit(rarest)
    if e.model.others:
        # A language without a model takes what the text says at best, and the undetermined model's place.
        own = f"array_max({texts}) * {TEMPER}D + {rest.replace('[i]', f'[{k}]')}"
        log = f"if(other, concat({log}, array({own})), {log})"
        und = F.when(F.col("other"), F.lit(float("-inf"))).otherwise(und)
    named = F.array(*[F.lit(x) for x in langs], F.col("declared"))
    lang, confidence, keep = out
    return (df.withColumn("other", _other(e.model)).withColumn("und", und).withColumn("log", F.expr(log))
            .withColumn("top", F.array_max("log"))
            .withColumn(confidence, F.when(F.col("ll")[k + 2] > 0,
                                           1 / F.expr("aggregate(log, 0D, (s, x) -> s + exp(x - top))")).otherwise(F.lit(0.0)))
            .withColumn(lang, F.when(F.col("ll")[k + 2] > 0,
                                     named[F.array_position("log", F.col("top")).cast("int") - 1])
                        .otherwise(F.lit(UNDETERMINED)))
            .withColumn(keep, (F.col(lang) != UNDETERMINED) & (F.col(confidence) >= MIN_CONFIDENCE)))


def evidence_columns(text: str, declared: Column | None, address: Column | None) -> dict[str, Column]:
    """The working columns that the tables are made of."""
    null = F.lit(None).cast("string")
    host = host_of(address) if address is not None else null
    host = F.when(host != "", host)
    return {"text": F.col(text), "declared": normal_language(declared) if declared is not None else null,
            "host": host, "domain": domain_of(host), "suffix": suffix_of(host)}


def identify(docs: DataFrame, text: str = "text", declared: Column | None = None, address: Column | None = None,
             key: Column | None = None, train_rows: int = TRAIN_ROWS, prefix: str = "") -> DataFrame:
    """``docs`` with {prefix}detected, {prefix}confidence and {prefix}accepted.

    One row out for each row in. A text without a letter (null and empty texts
    too) has no language: "und", confidence 0, not accepted, whatever else
    speaks for it; of a word or two the other evidence decides. Null or unknown evidence counts as
    none. Equal posteriors go to the first language by name. Nothing declared
    anywhere leaves nothing to learn from: all rows are "und". A language
    without a text model (declared by fewer than ``MIN_ROWS`` usable rows, or not
    in ``CODES``) is found in rows that declare it only. An empty table gives an
    empty one. Result columns that the table has already get a leading
    underscore; other columns pass unchanged.
    """
    key = F.col(text) if key is None else key
    cols = evidence_columns(text, declared, address)
    model = fit_text_model(docs, text, declared if declared is not None else F.lit(None).cast("string"), key, train_rows)
    used = docs.select(*[c.alias(n) for n, c in cols.items()])
    scored = staged(used.select("declared", "host", "domain", "suffix", _score_column(model, "text").alias("ll")), "scores")
    e = gather(scored, model)
    names = fresh(docs, f"{prefix}detected", f"{prefix}confidence", f"{prefix}accepted")
    row = docs.select(F.struct("*").alias("row"), *[c.alias(n) for n, c in cols.items()])
    both = (row.withColumn("ll", _score_column(model, "text"))
            .join(e.hosts, "host", "left").join(e.declared, "declared", "left").join(e.suffixes, "suffix", "left"))
    done = _posterior(both, e, ("lang", "confidence", "keep"))
    return done.select("row.*", F.col("lang").alias(names[0]), F.col("confidence").alias(names[1]), F.col("keep").alias(names[2]))


def keep_identified(docs: DataFrame, text: str = "text", lang: str = "lang", address: str = "source") -> DataFrame:
    """The accepted rows of ``docs``, with ``lang`` set to the language found; columns unchanged."""
    got = identify(docs, text, F.col(lang), F.col(address), prefix="__")
    new = got.columns[-3:]
    return got.filter(F.col(new[2])).withColumn(lang, F.col(new[0])).select(*docs.columns)

