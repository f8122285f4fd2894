"""URL filter by path templates, in DataFrame functions only.

1. Every url gives its host, path and the longest matching rule. Segments that look variable (numbers, dates, hex, ids) become
   wildcards by their form, so a host's urls shrink to few templates, which are counted with their labels (the rules' own
   verdicts, or given ones). All that follows works on templates.
2. Per host, the segments under one prefix are the branches of a tree. A prefix with many rare branches turns them into ``*``;
   a branch that is statistically like all its siblings together (what follows it, its share of labels, and their smoothed purity)
   is merged with them into ``+``. Passes go on until one changes nothing: a branch is judged again when its
   prefix or what follows it has been generalised, so their number grows with the depth of the paths and not with the rows.
3. A template is rejected when its smoothed purity, (blocked + strength * ``PRIOR``) / (labelled + strength), reaches
   ``REJECT``: by labels of its own only, of which it needs 15 at least. The prior is neutral and no share of the table, so no
   host's labels reach another host; a template without labels has the prior's purity and is allowed.

Cases: a null url, or one without ``://``, has an empty host and path and no rule and falls into the empty template; hosts are
compared in lower case; repeated rows count each; paths of any depth keep all segments; extra columns are passed on,
those named like a result are replaced; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airmill.session import stored

MANY, RARE, ALIKE, STRENGTH, PRIOR, REJECT = 50, 0.2, 0.25, 10.0, 0.5, 0.8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RESULT = ("host", "path", "rule", "template", "purity", "verdict")
#: Forms of variable segments, tried in this order: (wildcard, pattern of the whole segment without its extension).
FORMS = (("<n>", r"\d+"), ("<date>", r"\d{4}-\d{1,2}-\d{1,2}"), ("<hex>", r"(?=.*\d)[0-9a-fA-F-]{8,}"), ("<id>", r"(?=.*\d)[A-Za-z0-9_-]{12,}"))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def with_rule(urls: DataFrame, rules: list[tuple[str, str]], url: str) -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` and ``_said`` (what the rule says); the longest matching rule wins, then the first."""
    rule, said = F.lit(None).cast("string"), F.lit(None).cast("string")
    urls = urls.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    for verdict, text in sorted(reversed(rules), key=lambda r: len(r[1])):
        domain, _, rest = text.partition("/")
        fits = ((F.col("host") == domain) | F.col("host").endswith("." + domain)) & F.col("path").startswith("/" + rest)
        rule, said = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(verdict)).otherwise(said)
    return urls.withColumns({"rule": rule, "_said": said})


def segments(path: Column) -> Column:
    """Path segments with variable forms as wildcards."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")

    def form(s: Column) -> Column:
        stem, end = F.regexp_extract(s, r"^(.*?)(\.[A-Za-z]{1,5})?$", 1), F.regexp_extract(s, r"^(.*?)(\.[A-Za-z]{1,5})?$", 2)
        out = s
        for wildcard, pattern in reversed(FORMS):
            out = F.when(stem.rlike(f"^(?:{pattern})$"), F.concat(F.lit(wildcard), end)).otherwise(out)
        return out

    return F.transform(parts, form)


def generalise(templates: DataFrame) -> DataFrame | None:
    """One pass over (id, host, parts, n, labelled, blocked): branches under each prefix become wildcards or are merged.

    None if nothing changes.
    """
    spots = templates.select("*", F.posexplode("parts").alias("at", "segment")).select(
        "id", "host", "at", "segment", F.array_join(F.slice("parts", 1, F.col("at")), "/").alias("prefix"),
        F.coalesce(F.get("parts", F.col("at") + 1), F.lit("")).alias("following"), "n", "labelled", "blocked",
    )
    node = ["host", "at", "prefix"]
    totals = [F.sum(c).alias(c) for c in ("n", "labelled", "blocked")]
    # what follows each branch, then the branches, then the nodes: each from the counts before
    follow = stored(spots.groupBy(*node, "segment", "following").agg(*totals))
    branches = follow.groupBy(*node, "segment").agg(*totals)
    nodes = branches.groupBy(*node).agg(F.count("*").alias("branches"), *[F.sum(c).alias(f"all_{c}") for c in ("n", "labelled", "blocked")])
    pooled = follow.groupBy(*node, "following").agg(F.sum("n").alias("pooled"))

    def purity(blocked: str, labelled: str) -> Column:
        return (F.col(blocked) + STRENGTH * PRIOR) / (F.col(labelled) + STRENGTH)

    # total variation distance between what follows the branch and what follows all its siblings
    shares = follow.select(*node, "segment", "following", "n").join(nodes.select(*node, "all_n"), node).join(pooled, [*node, "following"])
    sizes = branches.select(*node, "segment", F.col("n").alias("branch_n"))
    apart = shares.join(sizes, [*node, "segment"]).groupBy(*node, "segment").agg(
        (1 - F.sum(F.least(F.col("n") / F.col("branch_n"), F.col("pooled") / F.col("all_n")))).alias("apart")
    )
    judged = branches.join(nodes, node).join(apart, [*node, "segment"])
    many = (F.col("branches") >= MANY) & (F.col("branches") >= RARE * F.col("all_n"))
    noise = 1 / F.sqrt(F.col("n"))
    alike = (F.col("branches") > 1) & (F.col("apart") <= ALIKE + noise)
    # a branch without labels is not like labelled ones
    alike &= F.abs(F.col("labelled") / F.col("n") - F.col("all_labelled") / F.col("all_n")) <= ALIKE
    alike &= F.abs(purity("blocked", "labelled") - purity("all_blocked", "all_labelled")) <= ALIKE
    fixed = F.col("segment").startswith("<") | F.col("segment").isin("*", "+")
    became = F.when(fixed, F.col("segment")).when(many, F.lit("*")).when(alike, F.lit("+")).otherwise(F.col("segment"))
    changed = stored(judged.select(*node, "segment", became.alias("became")).where(F.col("became") != F.col("segment")))
    if changed.isEmpty():
        return None
    moved = spots.join(changed, [*node, "segment"], "left").select("id", "at", F.coalesce("became", "segment").alias("segment"))
    parts = moved.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "segment"))), lambda x: x["segment"]).alias("parts"))
    return templates.drop("parts").join(parts, "id", "left").withColumn("parts", F.coalesce("parts", F.array().cast("array<string>")))


def judge(urls: DataFrame, rules: list[tuple[str, str]], url: str = "url", label: str | None = None) -> DataFrame:
    """``urls`` with ``host``, ``path``, ``rule``, ``template``, ``purity`` and ``verdict``.

    ``label`` names a column that is 1 for urls known to be bad and 0 for good ones; without it the rules' verdicts are the labels.
    """
    urls = urls.drop(*[c for c in RESULT if c not in (url, label)])
    told = with_rule(urls, rules, url)
    bad = (F.col("_said") == "block").cast("int") if label is None else F.col(label)
    told = told.withColumns({"_parts": segments(F.col("path")), "_bad": bad})
    counted = told.groupBy("host", F.col("_parts").alias("raw")).agg(
        F.count("*").alias("n"), F.count("_bad").alias("labelled"), F.coalesce(F.sum("_bad"), F.lit(0)).cast("long").alias("blocked")
    )
    templates = stored(counted.select(F.xxhash64("host", F.array_join("raw", "/")).alias("id"), "*", F.col("raw").alias("parts")))
    while (after := generalise(templates)) is not None:
        templates = stored(after)
    named = templates.select("host", "raw", F.concat(F.lit("/"), F.array_join("parts", "/")).alias("template"), "labelled", "blocked")
    purity = (F.sum("blocked") + STRENGTH * PRIOR) / (F.sum("labelled") + STRENGTH)
    pure = named.groupBy(F.col("host").alias("h"), F.col("template").alias("t")).agg(purity.alias("purity"))
    known = named.join(pure, (F.col("host") == F.col("h")) & (F.col("template") == F.col("t")))
    known = stored(known.select(F.col("host").alias("_h"), F.array_join("raw", "/").alias("_raw"), "template", "purity"))
    keyed = told.withColumn("_key", F.array_join("_parts", "/"))
    verdict = F.coalesce("_said", F.when(F.col("purity") >= REJECT, F.lit("block")).otherwise(F.lit("allow")))
    joined = keyed.join(known, (F.col("host") == F.col("_h")) & (F.col("_key") == F.col("_raw")), "left")
    return joined.withColumn("verdict", verdict).drop("_said", "_parts", "_bad", "_key", "_h", "_raw")
