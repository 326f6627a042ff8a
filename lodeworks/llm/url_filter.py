"""URL filter: rules first, then logistic regression on hashed character n-grams of host and path.

Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, in lower case; path: from there
up to ``?``, ``#`` or the end. A rule fits its host and all subdomains when the path starts with the rule's;
of the rules that fit, the longest wins. What no rule decides, the model does, trained on a small labelled
table of URLs in numpy on the driver. Urls are judged in one pass without a shuffle; only the url and id
columns are read.

Edge cases: a url that is null or has no ``://`` has empty host and path, fits no rule, and is judged by the
model's constant alone; very long urls are read whole; repeated rows get equal verdicts; an empty table
gives an empty result; a labelled table without rows of both kinds makes a model that allows all or blocks
all that no rule decides, as its rows say, and allows all when empty. Other columns may have any name.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.llm.frames import lower_ascii, map_batches

#: (verdict, host, path)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

#: Lengths of n-grams, weights of the model, and its training.
GRAMS, BUCKETS = (3, 4, 5), 1 << 15
STEPS, RATE, DECAY = 300, 2.0, 1e-4


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1))
    host = F.coalesce(lower_ascii(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))
    return host, path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits as ``host/path``, and its verdict; null when none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, on, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == on) | F.endswith(host, F.lit("." + on))) & F.startswith(path, F.lit(start))
        name, verdict = F.when(fits, on + start).otherwise(name), F.when(fits, says).otherwise(verdict)
    return name, verdict


def labelled_urls() -> list[tuple[str, str, int]]:
    """The default table: (host, path, 1 to block), from words that hosts of either kind are named with.

    Paths are the same for both kinds, so that they say nothing unless another table is given.
    """
    # Words of hosts that sell, trick or track, and of ordinary ones.
    block = (
        "ads-track adserver click-track tracker popup-ads banner-ads casino-win casino poker-slots free-bets bets-online "
        "lottery-win spam-farm link-farm content-farm spam cheap-pills pills-online viagra-shop adult-x adult-videos "
        "xxx porn sex-cams escort payday-loans free-money get-rich free-gifts prize-win malware-kit phishing fake-login "
        "warez torrent-free cracked-keys replica-watches buy-followers"
    ).split()
    allow = (
        "library university museum news weather recipes garden history wiki docs science school travel music maps "
        "books forum health nature sports city-council archive photos bakery transport theatre cinema energy water "
        "orchestra astronomy biology chemistry language literature poetry painting mountain river ocean island forest "
        "stationery engineering kitchen hospital insurance hotel restaurant railway airport harbour farming "
        "national thorn there then than reading season tester winter summer standard and other heron tion nation"
    ).split()
    paths = ("/en/12", "/fr/345.html", "/de/678", "/es/90/", "/index.html", "/")
    out = []
    for label, words in ((1, block), (0, allow)):
        for i, (word, before) in enumerate(product(words, ("", "www.", "blog.", "m."))):
            out.append((f"{before}{word}.example.{('com', 'net', 'org')[i % 3]}", paths[i % len(paths)], label))
    return out


def grams(host: str, path: str) -> np.ndarray:
    """Buckets of the n-grams of host and path, each once; the two never share one by meaning."""
    found = set()
    for mark, part in ((b"h", host), (b"p", path)):
        raw = b"^" + part.encode("utf-8", "replace") + b"$"
        if part:
            for n in GRAMS:
                found.update(zlib.crc32(mark + raw[i : i + n]) % BUCKETS for i in range(len(raw) - n + 1))
    return np.fromiter(sorted(found), np.int64, len(found))


class Model:
    """Logistic regression on the presence of n-grams, every url scaled to length one."""

    def __init__(self, rows: list[tuple[str, str, int]]):
        x = [grams(host, path) for host, path, _ in rows]
        y = np.array([label for *_, label in rows], float)
        self.weights, self.constant = np.zeros(BUCKETS), -1.0
        if not 0 < y.sum() < len(y):
            self.constant = 1.0 if len(y) and y[0] else -1.0
            return
        at = np.concatenate(x)
        row = np.repeat(np.arange(len(x)), [len(g) for g in x])
        value = np.repeat([1 / np.sqrt(max(1, len(g))) for g in x], [len(g) for g in x])
        # Both kinds weigh the same, so the constant doesn't follow the table's mix.
        share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
        for _ in range(STEPS):
            margin = self.constant + np.bincount(row, value * self.weights[at], len(x))
            miss = (y - 1 / (1 + np.exp(-margin))) * share * len(y)
            self.weights += RATE * (np.bincount(at, value * miss[row], BUCKETS) / 10 - DECAY * self.weights)
            self.constant += RATE * miss.mean() / 10

    def margin(self, host: str, path: str) -> float:
        found = grams(host, path)
        return self.constant + self.weights[found].sum() / np.sqrt(max(1, len(found)))


def judged(pages: DataFrame, model: Model, rules=RULES, url: str = "url", key: str = "page_id") -> DataFrame:
    """page_id, host, path, rule and verdict of every url, with the model's chance that it is to be blocked."""
    host, path = host_and_path(F.col(url).cast("string"))
    parts = pages.select(F.col(key).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = parts.withColumns({"rule": rule, "verdict": verdict})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            margin = np.array([model.margin(h, p) for h, p in zip(hosts, paths)], float)
            said = [v or ("block" if m > 0 else "allow") for v, m in zip(batch.column(4).to_pylist(), margin.tolist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(said, pa.string()), pa.array(1 / (1 + np.exp(-margin)))],
                ["page_id", "host", "path", "rule", "verdict", "chance"],
            )

    return map_batches(
        ruled, run, "page_id long, host string, path string, rule string, verdict string, chance double"
    )


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of `pages`, by the rules and a model of the default table."""
    return judged(spark.read.parquet(f"{sf_dir}/pages.parquet"), Model(labelled_urls()))
