"""Quality rules with cross-document line frequency, in DataFrame functions only.

Base figures are computed inside each row, and in the same reading of the text its lines are normalised (lower case, runs of
white space as one space, digits as 0) and hashed; these narrow facts are stored once and everything else works on them.
Lines are counted per host in distinct documents. A line above its host's limit is boilerplate; a document left with too few
of its words once such lines are gone is depleted and rejected.

A document is a whole text on a host: exact copies count once, for a line and for the host, so a text copied a thousand times is
not a thousand witnesses for its own lines. Different texts count each, however much they share: from the lines alone a group of
near copies looks like documents of one template.

Cases: a null text has no words (all figures 0, rejected), a null host is a host of its own, repeated rows give repeated
results, extra columns are passed on or replaced if a new column has their name, an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airmill.session import stored

#: The white space that separates words.
SPACE = r"[\x20\x09-\x0D]+"
INK = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
CONTENT = ("_content", "_check", "_host")


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def with_repeated_words(docs: DataFrame, w: str, out: str, width: int = 3) -> DataFrame:
    """Adds ``out``: words of the array ``w`` that lie in a window of ``width`` words found twice or more.

    Windows are hashed and sorted with their positions, so equal ones are neighbours: n log n for any text.
    """
    n = F.greatest(F.size(w) - width + 1, F.lit(0))
    docs = docs.withColumn("_hashes", F.transform(w, lambda x: F.xxhash64(x)))
    windows = F.slice("_hashes", 1, n)
    for k in range(1, width):
        windows = F.zip_with(windows, F.slice("_hashes", k + 1, n), lambda a, b: F.xxhash64(a, b))
    docs = docs.withColumn("_windows", windows)
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    ranked = F.when(repeats, F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    docs = docs.withColumn("_ranked", ranked)
    last = F.greatest(F.size("_ranked") - 1, F.lit(0))
    # each with its successor: both are repeats if the hashes agree
    pairs = F.zip_with(
        F.slice("_ranked", 1, last), F.slice("_ranked", 2, last), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"]))
    )
    spots = F.flatten(F.transform(F.flatten(F.filter(pairs, lambda x: x.isNotNull())), lambda i: F.array(*[i + k for k in range(width)])))
    found = F.when(F.col("_ranked").isNotNull(), F.size(F.array_distinct(spots))).otherwise(0)
    return docs.withColumn(out, found.cast("long")).drop("_hashes", "_windows", "_ranked")


def base_figures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the figures and ``base_failed``."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(INK))
    docs = with_repeated_words(docs.withColumn("_words", words(body)), "_words", "n_repeat_words")
    return (
        docs.withColumn("_raw", lines)
        .withColumns(
            {
                "n_words": F.size("_words").cast("long"),
                "word_chars": F.length(F.concat_ws("", "_words")).cast("long"),
                "n_symbols": F.regexp_count(body, F.lit(SYMBOLS)).cast("long"),
                "n_dup_lines": (F.size("_raw") - F.size(F.array_distinct("_raw"))).cast("long"),
            }
        )
        .drop("_words", "_raw")
        .withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    )


def content_key(text: str, host: str) -> list[Column]:
    """Two independent hashes of the whole text, and the host."""
    body = F.coalesce(F.col(text), F.lit(""))
    return [F.xxhash64(body).alias("_content"), F.hash(body).alias("_check"), F.col(host).alias("_host")]


def facts(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """All columns, the figures, the content key and ``_lines``: hash, words and length of each line."""
    body = F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), "[0-9]", "0")
    body = F.regexp_replace(body, r"[\x20\x09\x0B-\x0D]+", " ")
    lines = F.filter(F.transform(F.split(body, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    told = F.transform(
        lines,
        lambda x: F.struct(
            F.xxhash64(x).alias("line"), (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1).alias("words"), F.length(x).alias("size")
        ),
    )
    keyed = docs.select("*", *content_key(text, host), told.alias("_lines"))
    return base_figures(keyed, text)


def depleted(rows: DataFrame, min_docs: int = 30, share: float = 0.003, min_left: float = 0.5) -> DataFrame:
    """Content keys among the stored ``facts`` left with less than ``min_left`` of their words.

    A line is over the limit of its host when more than max(``min_docs``, ``share`` of the host's distinct
    documents) distinct documents hold it. Counts are combined before every shuffle; the join meets only lines over the limit.
    """
    texts = stored(rows.select(*CONTENT, "_lines").dropDuplicates(list(CONTENT)))
    lines = texts.select("_host", F.explode(F.array_distinct(F.transform("_lines", lambda x: x["line"]))).alias("line"))
    held = lines.groupBy("_host", "line").agg(F.count("*").alias("documents")).where(F.col("documents") > min_docs)
    hosts = texts.groupBy(F.col("_host").alias("any_host")).agg(F.count("*").alias("host_documents"))
    common = (
        held.join(hosts, F.col("_host").eqNullSafe(F.col("any_host")))
        .where(F.col("documents") > share * F.col("host_documents"))
        .select(F.col("any_host").alias("over_host"), F.col("line").alias("over_line"))
    )
    total = F.aggregate("_lines", F.lit(0).cast("long"), lambda a, x: a + x["words"])
    each = texts.select(*CONTENT, total.alias("total"), F.explode("_lines").alias("l")).select(*CONTENT, "total", "l.line", "l.words")
    met = each.join(common, (F.col("line") == F.col("over_line")) & F.col("_host").eqNullSafe(F.col("over_host")))
    removed = met.groupBy(*CONTENT).agg(F.sum("words").alias("removed"), F.max("total").alias("total"))
    return removed.where(F.col("total") - F.col("removed") < min_left * F.col("total")).select(*CONTENT, "removed")


def judge(docs: DataFrame, text: str = "text", host: str = "source", **limits: float) -> DataFrame:
    """Every row without its text, with the figures, ``base_failed``, ``depleted`` and ``kept``."""
    docs = docs.drop(*[c for c in (*FIGURES, "base_failed", "depleted", "kept", *CONTENT) if c not in (text, host)])
    rows = stored(facts(docs, text, host).drop(text))
    poor, same = _poor(rows, limits)
    flags = {"depleted": F.col("_c").isNotNull(), "kept": ~F.col("base_failed") & F.col("_c").isNull()}
    return rows.drop("_lines").join(poor, same, "left").withColumns(flags).drop("_c", "_k", "_h", "removed")


def _poor(rows: DataFrame, limits: dict) -> tuple[DataFrame, Column]:
    """The depleted contents, stored, and the condition that joins them to rows with a content key."""
    poor = stored(depleted(rows, **limits)).toDF("_c", "_k", "_h", "removed")
    return poor, (F.col("_content") == F.col("_c")) & (F.col("_check") == F.col("_k")) & F.col("_host").eqNullSafe(F.col("_h"))


def keep(docs: DataFrame, text: str = "text", host: str = "source", **limits: float) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, whole: written once with their facts, then only depleted keys are joined."""
    rows = stored(facts(docs.select(F.struct(*docs.columns).alias("_row")), f"_row.{text}", f"_row.{host}"))
    poor, same = _poor(rows, limits)
    return rows.where(~F.col("base_failed")).join(poor, same, "left_anti").select("_row.*")
