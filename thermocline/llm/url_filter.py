"""URL filter: host and path rules, and gradient-boosted trees for all other URLs.

A rule fits its host and all subdomains if the URL's path starts with the rule's path; the
longest fitting rule wins. A URL that no rule fits is judged by trees over lexical features:
lengths, depth, digit ratio, entropy, parameter counts and statistics of its suffix (the
last two labels of the host). They are fitted on labelled URLs, at most MAX_TRAIN of each
label, chosen by hash. Without given labels, a URL is labelled by the words of its host: 1
if one of them is in BAD_WORDS, which is how public host lists are made up; the words
themselves are no feature.

Defined results: a null URL or one without "://" has an empty host and path, fits no rule
and is judged like any other; a null page_id is kept; repeated rows are judged alike; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermocline.llm.common import attach_group
from thermocline.llm.trees import Scorer, boosted_trees, calibrated
from thermocline.session import materialize

#: (verdict, host, path), as the contract of the query gives them.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
MAX_TRAIN = 10_000
THRESHOLD = 0.5
BAD_WORDS = ("casino", "bet", "bets", "poker", "slots", "pills", "pharma", "viagra", "cheap", "spam", "ads", "adserver", "track", "tracker", "banner",
             "adult", "porn", "xxx", "sex", "escort", "malware", "phish", "warez")
FEATURES = [
    "length", "host_length", "path_length", "depth", "labels", "longest_label", "hyphens", "digit_ratio", "host_digit_ratio", "entropy", "host_entropy",
    "vowel_ratio", "distinct_ratio", "parameters", "query_length", "fragment", "encoded", "secure", "suffix_share", "suffix_digits", "suffix_hyphens",
]


def split_url(pages: DataFrame) -> DataFrame:
    """page_id, url, host and path."""
    url = F.coalesce(F.col("url"), F.lit(""))
    part = lambda k: F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", k)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.translate(part(1), upper, upper.lower()).alias("host"), part(2).alias("path"))


def best_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else null."""
    rule = verdict = F.when(F.lit(False), F.lit(""))
    for kind, on, start in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == on) | host.endswith("." + on)) & path.startswith(start)
        rule, verdict = rule.when(fits, on + start), verdict.when(fits, kind)
    return rule, verdict


def _entropy(text: str) -> float:
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values()) if n else 0.0


def _lexical(url: str, host: str, path: str) -> list[float]:
    query = url.partition("?")[2].partition("#")[0]
    labels, digits = host.split("."), sum(c.isdigit() for c in url)
    return [
        len(url), len(host), len(path), path.count("/"), len(labels), max(map(len, labels)), host.count("-"), digits / max(1, len(url)),
        sum(c.isdigit() for c in host) / max(1, len(host)), _entropy(url), _entropy(host), sum(c in "aeiouy" for c in host) / max(1, len(host)),
        len(set(host)) / max(1, len(host)), sum(bool(x) for x in query.split("&")), len(query), float("#" in url), url.count("%"), float(url.startswith("https")),
    ]


def add_features(urls: DataFrame) -> DataFrame:
    """FEATURES of rows (page_id, url, host, path); the suffix statistics are over all rows."""
    suffix = F.regexp_extract("host", r"([^.]*\.)?[^.]*$", 0)
    rows = materialize(urls.withColumn("suffix", suffix), "urls")
    total = rows.count()
    digits = F.length(F.regexp_replace("host", "[^0-9]", ""))
    hyphens = F.length(F.regexp_replace("host", "[^-]", ""))
    rows = attach_group(rows, ["suffix"], {"suffix_urls": F.count(F.lit(1)), "suffix_digits": F.avg(digits), "suffix_hyphens": F.avg(hyphens)})
    rows = rows.withColumn("suffix_share", F.col("suffix_urls") / max(1, total))
    own, carried = FEATURES[:-3], ["page_id", "url", "host", "path", *FEATURES[-3:]]

    def run(batches):
        for batch in batches:
            texts = zip(*[batch.column(c).to_pylist() for c in ("url", "host", "path")], strict=True)
            lexical = np.array([_lexical(u or "", h, p) for u, h, p in texts], float).reshape(-1, len(own))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in carried] + [pa.array(c) for c in lexical.T], names=[*carried, *own])

    schema = "page_id long, url string, host string, path string, suffix_share double, suffix_digits double, suffix_hyphens double, "
    return rows.select(*carried).mapInArrow(run, schema + ", ".join(f"{c} double" for c in own))


def host_word_labels(urls: DataFrame) -> DataFrame:
    """url and label of all URLs, by the words of the host."""
    words = F.split("host", "[.-]")
    return urls.select("url", F.arrays_overlap(words, F.array(*map(F.lit, BAD_WORDS))).cast("int").alias("label"))


def fit(featured: DataFrame, labelled: DataFrame, max_train: int = MAX_TRAIN) -> Scorer:
    """Calibrated scorer from at most ``max_train`` URLs of each label (0 or 1), those of least hash."""
    known = labelled.where(F.col("url").isNotNull() & F.col("label").isin(0, 1)).groupBy("url").agg(F.max("label").alias("label"))
    mixed = [known.where(F.col("label") == x).orderBy(F.xxhash64("url"), "url").limit(max_train) for x in (0, 1)]
    train = featured.dropDuplicates(["url"]).join(F.broadcast(mixed[0].unionByName(mixed[1])), "url")
    train = materialize(train.withColumn("fold", F.pmod(F.xxhash64("url", F.lit(5)), F.lit(4))).coalesce(4), "url-train")
    return calibrated(boosted_trees(train.where("fold > 0"), FEATURES), train.where("fold = 0"))


def judge_urls(pages: DataFrame, labelled: DataFrame | None = None, rules=RULES, max_train: int = MAX_TRAIN) -> DataFrame:
    """page_id, host, path, rule, verdict and score of every row; ``labelled`` has (url, label)."""
    urls = split_url(pages)
    featured = materialize(add_features(urls), "url-features")
    score = fit(featured, host_word_labels(urls) if labelled is None else labelled, max_train)
    rule, verdict = best_rule(F.col("host"), F.col("path"), rules)
    judged = F.when(F.col("score") >= THRESHOLD, "block").otherwise("allow")
    return score(featured).select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, judged).alias("verdict"), "score")
