"""URL filters: host rules, and logistic regression on hashed character
n-grams of host and path for the URLs that no rule fits.

The model is trained on the driver from a small labelled table of URLs (a
parameter) and broadcast: 2**14 numbers whatever the data.  The tests measure
it on URLs whose hosts the table does not have."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 14
GRAMS = (3, 4, 5)

#: (verdict, host, path) of the default rules
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

#: names of the default labelled table, none of them a host of the test tables
BLOCKED_NAMES = """royal-casino casino-online best-casino casino-bonus poker-casino bet-win win-jackpot slots-win lucky-bets
sports-bets live-bets free-spins track-ads adserver popup-ads ad-tracker ads-pixel ads-network click-track banner-ads link-farm
spam-links seo-spam content-farm spam-mail pills-online cheap-meds diet-pills adult-cams xxx-videos porn-tube free-adult
adult-dating payday-loan warez-crack torrent-crack ads-casino spam-pills""".split()
ALLOWED_NAMES = """orchard harbour lantern meadow compass granite station northern weather feather nation threshold news library
university docs forecast recipes museum city garden wiki science travel school health films music forum shop theory method
thunder thistle thorn theme tenth lathe motion action portion notion caution option mention fiction bakery kitchen farmhouse
village mountain river theorem thesis tether hither nether rather gather lather panther anthem ethics athlete author cathedral
winter window address advance clean cheese track-and-field adder farmers betterment""".split()
#: every name takes two of these, so that they tell nothing
FORMS = ("http://{}.example.org/en/101", "https://www.{}.example.net/de/5", "http://m.{}.example.com/fr/77/",
         "https://blog.{}.test/es/9?page=2", "https://{}.example.net/en/4033.html", "http://{}.test/")
#: the default labelled table: 1 is to be blocked
LABELLED = tuple((label, FORMS[(i + k) % len(FORMS)].format(name))
                 for label, names in ((1, BLOCKED_NAMES), (0, ALLOWED_NAMES)) for i, name in enumerate(names) for k in (0, 3)
                 ) + ((0, ""),) * 4        # what tells nothing is no reason to block


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in
    lower case; empty for null and where there is no ``://``."""
    raw = F.regexp_extract(_tail(url), r"(?s)^([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_tail(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def _tail(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule (host, path) that fits, as text, or null."""
    out = F.lit(None).cast("string")
    for _, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        out = F.when(fits, F.lit(h + p)).otherwise(out)
    return out


def grams(host: str, path: str) -> list[int]:
    """Hash buckets of the character n-grams; host and path told apart."""
    out = []
    for tag, s in (("h", f"^{host}$"), ("p", f"^{path}$")):
        out += [zlib.crc32(f"{tag}{s[i:i + n]}".encode("utf-8", "surrogatepass")) % BUCKETS
                for n in GRAMS for i in range(len(s) - n + 1)]
    return out


@dataclass
class Model:
    weight: np.ndarray
    bias: float

    def score(self, host: str, path: str) -> float:
        ids = grams(host, path)
        z = self.bias + (float(self.weight[ids].sum()) / len(ids) ** 0.5 if ids else 0.0)
        return float(1 / (1 + np.exp(-min(50.0, max(-50.0, z)))))


def split(url: str | None) -> tuple[str, str]:
    """Host and path of a URL, as ``host_of`` and ``path_of`` give them."""
    _, found, tail = (url or "").partition("://")
    if not found:
        return "", ""
    tail = tail.split("#")[0].split("?")[0]
    host, slash, path = tail.partition("/")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), slash + path


def train(labelled=LABELLED, steps: int = 400, rate: float = 4.0, reg: float = 3e-4) -> Model:
    """Logistic regression by gradient descent; an empty table gives one half
    for every URL."""
    if not labelled:
        return Model(np.zeros(BUCKETS), 0.0)
    x = np.zeros((len(labelled), BUCKETS))
    for k, (_, url) in enumerate(labelled):
        ids = grams(*split(url))
        np.add.at(x[k], ids, 1 / max(1, len(ids)) ** 0.5)
    y = np.array([label for label, _ in labelled], dtype=float)
    # the weights are a sum of rows at every step, so steps need their products alone
    inner, a, b = x @ x.T, np.zeros(len(y)), 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(inner @ a + b)))
        a -= rate * ((p - y) / len(y) + reg * a)
        b -= rate * float((p - y).mean())
    return Model(x.T @ a, b)


def filter_urls(pages: DataFrame, rules=RULES, labelled=LABELLED, threshold: float = 0.5) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict, score.

    The verdict is the rule's; without a rule it is ``block`` from a score of
    ``threshold`` on.  Null URLs and URLs without ``://`` have empty host and
    path and are judged by the model.  Rows are judged one by one (repeats
    alike); an empty table gives an empty result; other columns are not read."""
    verdicts = {h + p: v for v, h, p in rules}
    model = pages.sparkSession.sparkContext.broadcast(train(labelled))
    url = F.col("url").cast("string")
    split_up = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    ruled = split_up.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = model.value
        for pdf in batches:
            pdf["score"] = np.array([m.score(h, p) for h, p in zip(pdf["host"], pdf["path"])], dtype=float)
            pdf["verdict"] = [verdicts[r] if isinstance(r, str) else "block" if s >= threshold else "allow"
                              for r, s in zip(pdf["rule"], pdf["score"])]
            yield pdf[["page_id", "host", "path", "rule", "verdict", "score"]]

    return ruled.mapInPandas(run, "page_id bigint, host string, path string, rule string, verdict string, score double")
