"""URL filters: given host-path rules, and association rules mined from labelled urls by FP-growth.

A url becomes a set of tokens (host suffixes, path segments, query keys). FP-growth over token sets
with their label finds the token combinations that go with a label; those with enough support and
confidence, and no smaller combination that already decides, are the mined rules. An inverted index
from one token of each rule to the rule finds the rules of a url.

Tokens that the same urls have (a site's name and the first folder that all its pages share) would
make every combination of them frequent; such tokens are mined as one, so that support bounds the rules.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .urls import host_of, path_of
from .words import unused

ALLOW, BLOCK = "allow", "block"
MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.8
_LABEL = "label="


def rule_column(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null where none does.

    A rule is ``host/path`` with its verdict; it fits its host and all subdomains if the url's path
    starts with the rule's.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, outcome in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        own, _, rest = text.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + rest)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(outcome)).otherwise(verdict)
    return rule, verdict


def tokens(url: Column) -> Column:
    """Distinct tokens: every host suffix, every path segment by its place, file type, query keys.

    Digits of the path count as ``#``, so that numbered pages share tokens. A null url, or one without
    host, has none.
    """
    none = F.array().cast("array<string>")
    labels = F.split(host_of(url), r"\.")
    n = F.size(labels)
    suffixes = F.transform(
        F.sequence(F.lit(1), n),
        lambda k: F.concat(F.lit("host="), F.array_join(F.slice(labels, n - k + 1, k), ".")),
    )
    path = F.regexp_replace(path_of(url), r"\d+", "#")
    segments = F.filter(F.split(path, "/"), lambda x: x != "")
    segments = F.transform(segments, lambda x, i: F.concat(F.lit("path"), i.cast("string"), F.lit("="), x))
    kind = F.regexp_extract(path, r"\.([A-Za-z]{1,5})$", 1)
    query = F.regexp_extract(url.cast("string"), r"\?([^#]*)", 1)
    keys = F.filter(F.transform(F.split(query, "&"), lambda x: F.split_part(x, F.lit("="), F.lit(1))), lambda x: x != "")
    keys = F.transform(keys, lambda x: F.concat(F.lit("key="), x))
    kinds = F.when(kind != "", F.array(F.concat(F.lit("type="), kind))).otherwise(none)
    found = F.array_distinct(F.concat(suffixes, segments, kinds, keys))
    return F.when(host_of(url) != "", found).otherwise(none)


def same_urls(labelled: DataFrame, min_support: float = MIN_SUPPORT) -> dict[str, str]:
    """Each frequent token of ``labelled`` (tokens, label) to the smallest one that the same urls have.

    At most (tokens of a url on average) / min_support tokens are frequent, whatever the rows. Sets of
    urls are told apart by their number and the sum of their hashes.
    """
    rows = labelled.where("label IS NOT NULL AND size(tokens) > 0")
    least = min_support * rows.count()
    mark = F.xxhash64("tokens").cast("decimal(38,0)")
    found = (
        rows.select(F.explode("tokens").alias("token"), mark.alias("mark"))
        .groupBy("token")
        .agg(F.count("*").alias("n"), F.sum("mark").alias("marks"))
        .where(F.col("n") >= least)
        .collect()
    )
    first: dict[tuple[int, object], str] = {}
    for r in sorted(found, key=lambda r: r["token"]):
        first.setdefault((r["n"], r["marks"]), r["token"])
    return {r["token"]: first[r["n"], r["marks"]] for r in found}


def merged(labelled: DataFrame, names: dict[str, str]) -> DataFrame:
    """``labelled`` with each token replaced by its name; tokens without one, too rare for a rule, go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [sorted({names[t] for t in own if t in names}) for own in batch.column("tokens").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(lists, pa.list_(pa.string())), batch.column("label")], ["tokens", "label"]
            )

    return labelled.select("tokens", "label").mapInArrow(run, "tokens array<string>, label string")


def mine(
    labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE
) -> list[tuple[tuple[str, ...], str, float, float]]:
    """Rules (tokens, label, confidence, support) from ``labelled`` (tokens, label).

    Support bounds the number of frequent combinations, so the rules fit the driver. A rule goes if a
    rule over fewer of its tokens has the same label and at least its confidence.
    """
    baskets = labelled.where("label IS NOT NULL AND size(tokens) > 0").select(
        F.array_append("tokens", F.concat(F.lit(_LABEL), "label")).alias("items")
    )
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    found = (
        model.associationRules.where(F.col("consequent")[0].startswith(_LABEL))
        .select("antecedent", F.col("consequent")[0].alias("label"), "confidence", "support")
        .collect()
    )
    found.sort(key=lambda r: (len(r["antecedent"]), -r["confidence"], sorted(r["antecedent"])))
    kept: list[tuple[tuple[str, ...], str, float, float]] = []
    by_token: dict[str, list[int]] = {}
    for r in found:
        own, label = frozenset(r["antecedent"]), r["label"].removeprefix(_LABEL)
        smaller = {i for t in own for i in by_token.get(t, ())}
        if any(kept[i][1] == label and kept[i][2] >= r["confidence"] and own.issuperset(kept[i][0]) for i in smaller):
            continue
        for t in own:
            by_token.setdefault(t, []).append(len(kept))
        kept.append((tuple(sorted(own)), label, r["confidence"], r["support"]))
    return kept


def inverted(rules: list[tuple[tuple[str, ...], str, float, float]]) -> dict[str, list[int]]:
    """Rules by that token of theirs which the fewest rules contain."""
    uses: dict[str, int] = {}
    for own, *_ in rules:
        for t in own:
            uses[t] = uses.get(t, 0) + 1
    index: dict[str, list[int]] = {}
    for i, (own, *_) in enumerate(rules):
        index.setdefault(min(own, key=lambda t: (uses[t], t)), []).append(i)
    return index


def decide(own: Sequence[str], rules, index: dict[str, list[int]], default: str = ALLOW) -> str:
    """Label of the fitting rule with the highest confidence, then support, then most tokens."""
    have = set(own)
    best = None
    for t in have:
        for i in index.get(t, ()):
            need, label, confidence, support = rules[i]
            if have.issuperset(need):
                rank = (confidence, support, len(need), label, need)
                if best is None or rank > best:
                    best = rank
    return default if best is None else best[3]


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str]], labelled: DataFrame | None = None
) -> DataFrame:
    """``pages`` with host, path, rule and verdict; their old columns of those names are replaced.

    ``labelled`` (url, label) are the urls to mine; without it, the urls that a given rule judges.
    Where no given rule fits, the mined rules decide, and where none of those fits: allow. A null or
    malformed url has empty host and path, no rule, and is allowed; repeated rows are judged alike. Other
    columns pass through under any name. Whole urls count, whatever their length; an empty table gives an
    empty one, and without labelled urls nothing is mined. Among fitting rules the highest confidence
    decides, then support, then the number of tokens, then the names.
    """
    base = pages.drop("host", "path", "rule", "verdict")
    given, own_tokens = unused(base.columns, "given"), unused(base.columns, "tokens")
    rows = base.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    rule, verdict = rule_column(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn(given, verdict)
    if labelled is None:
        known = rows.where(F.col(given).isNotNull()).select(
            tokens(F.col("url")).alias("tokens"), F.col(given).alias("label")
        )
    else:
        known = labelled.select(tokens(F.col("url")).alias("tokens"), F.col("label").cast("string"))
    names = same_urls(known)
    # Few labelled rows, or none, make no token frequent.
    mined = mine(merged(known, names)) if names else []
    index = inverted(mined)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            verdicts = [
                g if g is not None else decide([names[t] for t in own if t in names], mined, index)
                for g, own in zip(batch.column(given).to_pylist(), batch.column(own_tokens).to_pylist())
            ]
            columns = [c for c in batch.schema.names if c not in (given, own_tokens)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(verdicts, pa.string())], [*columns, "verdict"]
            )

    fields = [f for f in rows.schema if f.name != given]
    schema = T.StructType([*fields, T.StructField("verdict", T.StringType())])
    return rows.withColumn(own_tokens, tokens(F.col("url"))).mapInArrow(run, schema)
