"""URL filters: rules first, then logistic regression on hashed character n-grams of host and path.

Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, in ASCII lower case.
Path: what follows it up to ``?``, ``#`` or the end. A null url, or one without ``://``, has both
empty. A rule ``host/path`` fits a host and its subdomains if the path starts with the rule's;
the longest rule wins, and of equally long ones the one with the longer host.

Urls that no rule fits are judged by the model. Its features are the n-grams of the host (with
``^`` and ``$`` at its ends, after the top-level domain is cut off) and of the path, hashed into
``Settings.rows`` places. It is fitted in numpy on the small labelled table below on each use,
which takes well under a second. Without a host there is nothing to judge: the url is allowed.
Other columns are left out; repeated rows are judged each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pulsegrid.llm.frames import only

VERDICTS = "page_id long, host string, path string, rule string, verdict string, score double"
ALLOW, BLOCK = "allow", "block"

#: The small labelled url table the model is fitted on.
BLOCKED_URLS = (
    "http://spam-farm.example.org/en/1",
    "https://www.spam-farm.example.net/de/22",
    "https://www.cheap-pills.example.com/en/450",
    "http://blog.cheap-pills.example.net/fr/176/",
    "https://casino-win.example.org/es/9.html",
    "http://m.casino-win.example.com/en/315",
    "https://free-bets.example.net/en/77",
    "http://www.free-bets.example.org/de/4/",
    "https://adult-x.example.com/fr/6",
    "http://m.adult-x.example.org/en/640.html",
    "https://m.ads-track.example.com/en/33",
    "http://ads-track.example.net/es/512/",
    "http://online-casino-bonus.biz/slots/free-spins",
    "https://best-pills-pharmacy.info/viagra/cheap",
    "http://xxx-adult-videos.top/watch/free",
    "https://bet-win-jackpot.site/bonus/code",
    "http://click-ads-tracker.net/redirect/banner",
    "https://link-farm-seo.info/spam/backlinks",
    "http://payday-loans-fast.biz/apply-now",
    "https://replica-watches-cheap.shop/sale",
    "http://poker-bets.club/win/cash",
    "https://porn-tube.xyz/adult/hd",
)
ALLOWED_URLS = (
    "https://www.library.example.org/en/catalogue/12",
    "http://blog.gardening.example.com/en/2021/tomatoes.html",
    "https://news.town.example.net/de/8",
    "http://therin.example.net/en/770",
    "https://blog.theres.example.com/fr/519",
    "http://m.tiontion.example.com/en/853/",
    "https://www.ththen.example.org/es/148.html",
    "http://thering.example.org/en/328",
    "https://blog.thernd.example.net/de/612/",
    "http://thther.example.net/fr/217",
    "https://m.therou.example.org/en/474.html",
    "http://ththble.example.com/es/797",
    "https://tionsh.example.net/en/9",
    "http://tionble.example.org/de/31/",
    "https://university.example.edu/courses/physics/lecture-3",
    "http://museum.example.org/collections/painting/22",
    "https://docs.software.example.com/reference/api.html",
    "http://weather.example.net/forecast/north",
    "https://encyclopedia.example.org/wiki/Mountain",
    "http://recipes.example.com/bread/sourdough",
    "https://www.hospital.example.org/departments/children",
    "http://forum.cycling.example.net/threads/481",
    "https://science-journal.example.com/volume/7/article/3",
    "http://city-council.example.gov/minutes/2020",
    "https://adventure-books.example.org/review/11",
    "http://trackandfield.example.net/results/100m",
)


@dataclass(frozen=True)
class Settings:
    sizes: tuple[int, ...] = (3, 4, 5)
    rows: int = 1 << 14
    steps: int = 300
    rate: float = 0.5
    decay: float = 1e-3
    block_from: float = 0.5


def host_and_path(url: str | None) -> tuple[str, str]:
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    for stop in "?#":
        rest = rest.partition(stop)[0]
    host, slash, path = rest.partition("/")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), slash + path


class Rules:
    """Rules in a table by host; a url looks up its host and every domain above it."""

    def __init__(self, rules: tuple[tuple[str, str], ...]):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for verdict, rule in rules:
            host, slash, path = rule.partition("/")
            self.by_host.setdefault(host, []).append((slash + path, rule, verdict))

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest rule that fits."""
        best, domain = None, host
        while domain:
            for start, rule, verdict in self.by_host.get(domain, ()):
                if path.startswith(start) and (best is None or len(rule) > len(best[0])):
                    best = rule, verdict
            domain = domain.partition(".")[2]
        return best


def features(host: str, path: str, s: Settings) -> np.ndarray:
    """Distinct places of the url's n-grams."""
    name = "^" + host.rpartition(".")[0] + "$"
    grams = {f"{kind}{text[i : i + n]}" for kind, text in (("h", name), ("p", path)) for n in s.sizes for i in range(len(text) - n + 1)}
    return np.unique(np.array([zlib.crc32(g.encode()) % s.rows for g in grams], np.int64))


class Model:
    def __init__(self, s: Settings):
        self.settings, self.weights, self.bias = s, np.zeros(s.rows), 0.0

    def score(self, places: np.ndarray) -> float:
        total = self.bias + self.weights[places].sum() / max(1.0, np.sqrt(len(places)))
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def fit(blocked: tuple[str, ...] = BLOCKED_URLS, allowed: tuple[str, ...] = ALLOWED_URLS, s: Settings = Settings()) -> Model:
    """Full-batch gradient descent; both kinds weigh the same."""
    model = Model(s)
    rows = [(features(*host_and_path(u), s), 1.0) for u in blocked] + [(features(*host_and_path(u), s), 0.0) for u in allowed]
    weight = {1.0: 0.5 / max(1, len(blocked)), 0.0: 0.5 / max(1, len(allowed))}
    for _ in range(s.steps):
        gradient, bias = s.decay * model.weights, 0.0
        for places, y in rows:
            error = (model.score(places) - y) * weight[y]
            gradient[places] += error / max(1.0, np.sqrt(len(places)))
            bias += error
        model.weights -= s.rate * 20 * gradient
        model.bias -= s.rate * bias
    return model


def judge(pages: DataFrame, rules: tuple[tuple[str, str], ...], s: Settings = Settings()) -> DataFrame:
    """``VERDICTS`` of every page; the score is the model's, null where a rule decides."""
    model = fit(s=s)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, known = Rules(rules), {}
        names = [c.split()[0] for c in VERDICTS.split(", ")]
        for batch in batches:
            rows = []
            for url in batch.column("url").to_pylist():
                host, path = host_and_path(url)
                found = table.find(host, path)
                if found:
                    rows.append((host, path, *found, None))
                    continue
                if len(known) > 100_000:
                    known.clear()
                if (host, path) not in known:
                    known[host, path] = model.score(features(host, path, s)) if host else 0.0
                score = known[host, path]
                rows.append((host, path, None, BLOCK if score >= s.block_from else ALLOW, score))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.float64())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id").cast(pa.int64()), *arrays], names)

    return only(pages, ("page_id", "url"), "pages").mapInArrow(run, VERDICTS)
