"""Language identification by fusing evidence.

log posterior = text likelihood + likelihood of the declared language + log prior of the host, per language and normalised.

* Text: hashed byte trigrams of the lower-cased letters, one multinomial per language, fitted on a sample of declared texts
  (at most ``SAMPLE`` rows a language expected). Trigrams of one text depend on each other, so their mean counts as at most
  ``WEIGHT`` of them. A flat model competes as "unknown".
* Declared: how often the declaration agrees with the text, per declared value, over all rows.
* Prior: languages per host, smoothed towards those of the address suffix, smoothed towards those of the whole table, all
  counted by grouped aggregation over all rows.

Cases: null and empty texts, and texts without letters, have no text evidence and are rejected; a null or unknown declaration
says nothing; a null host or suffix is a value of its own; repeated rows count each; extra columns are passed on, but columns
named like a result are replaced; an empty table gives no rows, with any model.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airmill.llm.quality_rules import content_key
from airmill.llm.words import lean
from airmill.session import stored

LANGUAGES = ("de", "en", "es", "fr")
BUCKETS, SAMPLE, WEIGHT, SMOOTHING, SLAB = 1 << 16, 2000, 60, 20.0, 1 << 20
#: Log likelihood of a trigram in a text of no language: as if 30,000 were equally likely.
UNKNOWN = float(-np.log(30_000))
LEAST = 0.5
RESULT = ("language", "posterior", "known", "n_trigrams", "likelihoods")
# bytes that count: letters as lower case, all of UTF-8's other bytes as they are, the rest as space
_KEEP = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def trigrams(text: bytes) -> Iterator[np.ndarray]:
    """Buckets of the trigrams around each letter, in slabs."""
    line = b" " + b" ".join(text.translate(_KEEP).split()) + b" "
    for k in range(0, len(line) - 2, SLAB):
        x = np.frombuffer(line[k : k + SLAB + 2], np.uint8).astype(np.uint32)
        code = (x[:-2] << 16) | (x[1:-1] << 8) | x[2:]
        yield ((code[x[1:-1] != 32] * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


def fit(docs: DataFrame, text: str, declared: str, languages: tuple[str, ...] = LANGUAGES, sample: int = SAMPLE) -> np.ndarray:
    """Log probabilities, buckets x languages, from a hash sample of about ``sample`` declared rows per language."""
    rows = docs.where(F.col(declared).isin(*languages) & F.col(text).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(declared).agg(F.count("*")).collect()}
    share = F.lit(0.0)
    for name, n in counts.items():
        share = F.when(F.col(declared) == name, F.lit(min(1.0, sample / n))).otherwise(share)
    drawn = rows.where(F.pmod(F.xxhash64(text), F.lit(1 << 20)) < share * (1 << 20)).select(declared, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((len(languages), BUCKETS), np.int64)
        for b in batches:
            for name, x in zip(b.column(0).to_pylist(), b.column(1).cast(pa.large_binary()), strict=True):
                for at in trigrams(x.as_py()):
                    table[languages.index(name)] += np.bincount(at, minlength=BUCKETS)
        spot = np.nonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(spot[0]), pa.array(spot[1]), pa.array(table[spot])], names=["l", "b", "n"])

    table = np.full((BUCKETS, len(languages)), 0.1)
    summed = drawn.mapInArrow(lean(run), "l long, b long, n long").groupBy("l", "b").agg(F.sum("n").alias("n"))
    for r in summed.toLocalIterator():  # at most buckets x languages rows
        table[r["b"], r["l"]] += r["n"]
    return np.log(table / table.sum(0)).astype(np.float32)


def with_likelihoods(docs: DataFrame, model: np.ndarray, text: str) -> DataFrame:
    """All columns but the text, ``n_trigrams`` and ``likelihoods`` (mean log probability per language)."""
    rest = [c for c in docs.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, means = [], []
            for x in b.column(len(rest)).cast(pa.large_binary()):
                n, total = 0, np.zeros(model.shape[1])
                for at in trigrams(x.as_py() or b""):
                    n, total = n + len(at), total + model[at].sum(0, dtype=np.float64)
                sizes.append(n)
                means.append(total / max(n, 1))
            told = [pa.array(sizes, pa.int64()), pa.array(means, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(rest)], *told], names=[*rest, "n_trigrams", "likelihoods"])

    schema = docs.select(*rest, F.lit(0).cast("long").alias("n_trigrams"), F.array(F.lit(0.0)).alias("likelihoods")).schema
    return docs.select(*rest, F.col(text)).mapInArrow(lean(run), schema)


def _best(scores: Column) -> Column:
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def identify(
    docs: DataFrame, text: str = "text", declared: str = "lang", host: str = "source", suffix: Column | None = None,
    languages: tuple[str, ...] = LANGUAGES, model: np.ndarray | None = None,
) -> DataFrame:
    """Every row without its text, with ``language`` (null: unknown), ``posterior`` and ``known``."""
    docs = docs.drop(*[c for c in RESULT if c not in (text, declared, host)])
    model = fit(docs, text, declared, languages) if model is None else model
    last = F.regexp_extract(F.col(host), r"\.([^.]*)$", 1) if suffix is None else suffix
    keyed = docs.withColumns({"_declared": F.col(declared), "_host": F.col(host), "_suffix": last})
    rows = stored(with_likelihoods(keyed, model, text))
    kinds = range(len(languages))
    votes = rows.where("n_trigrams > 0").withColumn("_l", _best(F.col("likelihoods")))
    each = [F.sum((F.col("_l") == k).cast("long")).alias(f"n{k}") for k in kinds]
    total = votes.agg(*each).first()
    whole = [(n or 0) + 1.0 for n in total]
    whole = [n / sum(whole) for n in whole]

    def smoothed(counts: DataFrame, above: list[Column]) -> list[Column]:
        n = sum((F.col(f"n{k}") for k in kinds), F.lit(0))
        return [((F.col(f"n{k}") + SMOOTHING * above[k]) / (n + SMOOTHING)).alias(f"p{k}") for k in kinds]

    by_host = votes.groupBy("_host", "_suffix").agg(*each)
    by_suffix = by_host.groupBy("_suffix").agg(*[F.sum(f"n{k}").alias(f"n{k}") for k in kinds])
    by_suffix = by_suffix.select(F.col("_suffix").alias("s"), *[p.alias(f"s{k}") for k, p in enumerate(smoothed(by_suffix, [F.lit(p) for p in whole]))])
    priors = by_host.join(by_suffix, F.col("_suffix").eqNullSafe(F.col("s")))
    priors = priors.select(F.col("_host").alias("h"), "s", F.array(*smoothed(priors, [F.col(f"s{k}") for k in kinds])).alias("prior"))
    priors = stored(priors)
    # P(declared | language): counted where both are known, smoothed towards saying nothing
    said = votes.where(F.col("_declared").isin(*languages)).groupBy("_declared").agg(*each).collect()  # a row per language
    table = np.full((len(languages), len(languages)), 1.0)
    for r in said:
        table[languages.index(r["_declared"])] += [r[f"n{k}"] for k in kinds]
    table = np.log(table / table.sum(0))
    told = F.array(*[F.lit(0.0)] * len(languages))
    for i, name in enumerate(languages):
        told = F.when(F.col("_declared") == name, F.array(*[F.lit(float(x)) for x in table[i]])).otherwise(told)

    joined = rows.join(priors, F.col("_host").eqNullSafe(F.col("h")) & F.col("_suffix").eqNullSafe(F.col("s")), "left")
    weight = F.least(F.col("n_trigrams"), F.lit(WEIGHT))
    prior = F.coalesce("prior", F.array(*[F.lit(p) for p in whole]))
    scores = [weight * F.col("likelihoods")[k] + F.col("_told")[k] + F.log(F.col("_prior")[k]) for k in kinds]
    unknown = weight * UNKNOWN + np.log(0.001)
    scored = joined.withColumns({"_told": told, "_prior": prior}).withColumn("_scores", F.array(*scores, unknown))
    spread = F.aggregate("_scores", F.lit(0.0), lambda a, x: a + F.exp(x - F.array_max("_scores")))
    known = (F.col("n_trigrams") > 0) & (F.col("_best") < len(languages)) & (F.col("posterior") >= LEAST)
    return (
        scored.withColumns({"posterior": 1 / spread, "_best": _best(F.col("_scores"))})
        .withColumn("known", known)
        .withColumn("language", F.when(F.col("known"), F.element_at(F.array(*map(F.lit, languages)), F.least(F.col("_best") + 1, F.lit(len(languages))))))
        .drop("_declared", "_host", "_suffix", "h", "s", "prior", "_told", "_prior", "_scores", "_best")
    )


def keep(docs: DataFrame, text: str = "text", declared: str = "lang", host: str = "source", **options) -> DataFrame:
    """The rows of ``docs`` whose language is known, whole; only keys of rejected contents are joined to them."""
    keys = content_key(text, host)
    found = identify(docs.select(text, declared, host, *[k.alias(f"k{i}") for i, k in enumerate(keys[:2])]), text, declared, host, **options)
    bad = found.where(~F.col("known")).select("k0", "k1", F.col(host).alias("k2"), F.col(declared).alias("k3")).distinct()
    bad = stored(bad)
    same = (F.col("_content") == F.col("k0")) & (F.col("_check") == F.col("k1")) & F.col("_host").eqNullSafe(F.col("k2"))
    keyed = docs.select("*", *keys)
    return keyed.join(bad, same & F.col(declared).eqNullSafe(F.col("k3")), "left_anti").drop("_content", "_check", "_host")
