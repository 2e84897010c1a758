"""Quality rules: base rules per document, and robust multivariate outliers per language and source.

Statistics come from the whole text (null: none). A document that fails the base rules is out.
For the others, a vector of transformed statistics is held against the minimum-covariance-
determinant (MCD) estimate of its group, and a document whose squared Mahalanobis distance
exceeds ``Settings.cutoff`` is rejected.

The vector: log of the words; the mean word length's distance from the group's median, times
the square root of the words (up to a bound), so that short texts may vary more; symbols per
word, on a log scale; square roots of the repeated words' and the capital letters' shares.

MCD by concentration steps over all rows of all groups at once. From two deterministic starts
(medians with quartile spreads alone, and with the correlation of bounded scores), each step
measures all distances, finds for each group the distance that ``Settings.share`` of its rows
stay below, and takes those rows' mean and covariance. Rows are folded by (group, start, rounded
log of the distance) before anything is shuffled, with counts and moments: the quantile and the
covariance come from one pass, and a group of any size is a few thousand rows. The start with
the smaller determinant wins; a last pass reweights by the usual 97.5 % rule.

A group is a language and source with at least ``least_rows`` rows that pass the base rules;
smaller ones form one group for each language, and what is still small one for the rest. A
group below that size has no verdict of the method: its documents are kept. Nulls in lang or
source are values of their own. Rows with the same id are judged each.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pulsegrid.llm.frames import settle_few, tasks_for
from pulsegrid.llm.words import NOT_WHITE, WINDOW, WordReader, text_blocks
from pulsegrid.sources.settle import settle
from pulsegrid.sources.tables import require_columns

KEYS = ("doc_id", "lang", "source")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_chars_all")
RESULT = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_CAPITALS = np.zeros(256, bool)
_CAPITALS[65:91] = True
_WORD = re.compile(r"[^\x20\x09-\x0D]")


@dataclass(frozen=True)
class Settings:
    least_words: int = 10
    most_repeats: int = 20  # per 100 words
    share: float = 0.75
    steps: int = 5
    least_rows: int = 60
    cutoff: float = 45.0
    word_bound: int = 400
    #: Documents for which one task writes the tables of groups.
    docs_per_task: int = 100_000
    #: Spreads that a group's own may not fall below, one for each part of the vector.
    floors: tuple[float, ...] = (0.4, 1.5, 0.25, 0.1, 0.05)


def _dup_lines(text: bytes | None) -> int:
    if not text or b"\n" not in text:
        return 0
    lines = [line for line in text.decode().split("\n") if _WORD.search(line)]
    return len(lines) - len(set(lines))


def _sums(flags: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return np.diff(total[ends], prepend=0)


def _repeated(words) -> np.ndarray:
    """For each text, the words inside windows that the text holds twice or more."""
    at, window = words.windows()
    out = np.zeros(words.n_texts, np.int64)
    if not len(at):
        return out
    order = np.lexsort((window, words.text[at]))
    text, window = words.text[at][order], window[order]
    same = (window[1:] == window[:-1]) & (text[1:] == text[:-1])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    edge = np.zeros(len(words.text) + 1, np.int64)
    first = at[order[twice]]
    edge += np.bincount(first, minlength=len(edge))
    edge -= np.bincount(first + WINDOW, minlength=len(edge))[: len(edge)]
    covered = np.cumsum(edge[:-1]) > 0
    return np.bincount(words.text[covered], minlength=words.n_texts)


def _counts(reader: WordReader, texts: list[bytes | None]) -> list[pa.Array]:
    """The columns of ``COUNTS``."""
    words = reader.read(texts)
    data = np.frombuffer(b"".join(t or b"" for t in texts), np.uint8)
    ends = np.cumsum([len(t or b"") for t in texts])
    heads = (data & 0xC0) != 0x80  # one byte of each code point
    numbers = (
        words.counts(),
        _sums(heads & NOT_WHITE[data], ends),
        _sums(_SYMBOLS[data], ends),
        [_dup_lines(t) for t in texts],
        _repeated(words),
        _sums(_CAPITALS[data], ends),
        _sums(heads, ends),
    )
    return [pa.array(n, pa.int64()) for n in numbers]


def with_statistics(docs: DataFrame, carried: tuple[str, ...]) -> DataFrame:
    """The carried columns and ``COUNTS`` of every row."""
    rows = docs.select(*carried, F.col("text").alias("text_to_count"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = WordReader()
        for batch in batches:
            for at, texts in text_blocks(batch.column("text_to_count")):
                part = batch.slice(at, len(texts))
                columns = [part.column(c) for c in carried] + _counts(reader, texts)
                yield pa.RecordBatch.from_arrays(columns, [*carried, *COUNTS])

    schema = rows.drop("text_to_count").schema
    for name in COUNTS:
        schema = schema.add(name, "long")
    return rows.mapInArrow(run, schema)


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and ``COUNTS`` of every row."""
    return with_statistics(require_columns(docs, (*KEYS, "text"), "documents"), KEYS)


def with_base_rules(stats: DataFrame, s: Settings = Settings()) -> DataFrame:
    failed = (F.col("n_words") < s.least_words) | (100 * F.col("n_repeat_words") > s.most_repeats * F.col("n_words"))
    return stats.withColumn("base_failed", failed)


def _groups(rows: DataFrame, s: Settings, tasks: int) -> DataFrame:
    """lang, source and ``grp``: their own name, or what small ones are pooled into; null where all is small."""
    sizes = rows.groupBy("lang", "source").agg(F.count("*").alias("n"))
    own = F.col("n") >= s.least_rows
    in_lang = F.sum(F.when(own, 0).otherwise(F.col("n"))).over(Window.partitionBy("lang"))
    sizes = sizes.withColumns({"own": own, "pool": in_lang})
    level = F.when(F.col("own"), 2).when(F.col("pool") >= s.least_rows, 1).otherwise(0)
    sizes = settle_few(sizes.select("lang", "source", "n", level.alias("level")), tasks)
    rest = sizes.where("level = 0").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    name = (
        F.when(F.col("level") == 2, F.to_json(F.struct("lang", "source")))
        .when(F.col("level") == 1, F.to_json(F.struct("lang")))
        .when(F.lit(rest >= s.least_rows), F.lit("rest"))
    )
    return sizes.select("lang", "source", name.alias("grp"))


def _by_group(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows with what the table of groups holds for their language and source."""
    groups = groups.withColumnsRenamed({"lang": "group_lang", "source": "group_source"})
    same = F.col("lang").eqNullSafe(F.col("group_lang")) & F.col("source").eqNullSafe(F.col("group_source"))
    return rows.join(groups, same, "left").drop("group_lang", "group_source")


def _with_usual(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """The table of groups with the median of the mean word length."""
    length = F.col("word_chars") / F.col("n_words")
    named = _by_group(rows, groups).where("grp is not null")
    return groups.join(named.groupBy("grp").agg(F.percentile_approx(length, 0.5, 10_000).alias("usual")), "grp", "left")


def _vector(s: Settings) -> dict[str, Column]:
    """x0.. of a row with ``COUNTS`` and its group's usual word length."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    parts = (
        F.log(n),
        (F.col("word_chars") / n - F.col("usual")) * F.sqrt(F.least(n, F.lit(s.word_bound))),
        F.log1p(20 * F.col("n_symbols") / n),
        F.sqrt(F.col("n_repeat_words") / n),
        F.sqrt(F.col("n_capitals") / F.greatest(F.col("n_chars_all"), F.lit(1))),
    )
    return {f"x{k}": x.cast("double") for k, x in enumerate(parts)}


def chi2_cdf(x: float, p: int) -> float:
    """The chi-squared distribution function, by the series of the incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, half = p / 2, x / 2
    term = total = 1 / a
    for k in range(1, 1000):
        term *= half / (a + k)
        total += term
        if term < total * 1e-15:
            break
    return total * math.exp(-half + a * math.log(half) - math.lgamma(a))


def chi2_quantile(q: float, p: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_cdf(middle, p) < q else (low, middle)
    return low


def consistency(share: float, p: int) -> float:
    """What the covariance of the inner share is multiplied with to estimate the whole's."""
    return share / chi2_cdf(chi2_quantile(share, p), p + 2)


def _distance(p: int) -> Column:
    """Squared Mahalanobis distance of x0.. from the columns centre and inverse (row by row)."""
    gap = [F.col(f"x{k}") - F.col("centre")[k] for k in range(p)]
    terms = [gap[i] * gap[j] * F.col("inverse")[i * p + j] * (1 if i == j else 2) for i in range(p) for j in range(i, p)]
    return reduce(lambda a, b: a + b, terms)


def _moments(p: int) -> list[Column]:
    x = [F.col(f"x{k}") for k in range(p)]
    first = [F.sum(x[k]).alias(f"s{k}") for k in range(p)]
    second = [F.sum(x[i] * x[j]).alias(f"s{i}_{j}") for i in range(p) for j in range(i, p)]
    return [F.count("*").alias("n"), *first, *second]


def _estimates(sums: DataFrame, p: int, s: Settings, factor: float) -> DataFrame:
    """grp, start, centre, inverse and log determinant from a row of moments for each group and start."""
    floors = np.array(s.floors)
    out = "grp string, start int, centre array<double>, inverse array<double>, logdet double"

    def run(frames):
        import pandas as pd

        for f in frames:
            n = f["n"].to_numpy(float)
            mean = np.stack([f[f"s{k}"].to_numpy(float) for k in range(p)], 1) / n[:, None]
            cov = np.zeros((len(f), p, p))
            for i in range(p):
                for j in range(i, p):
                    cov[:, i, j] = cov[:, j, i] = f[f"s{i}_{j}"].to_numpy(float) / n - mean[:, i] * mean[:, j]
            cov = cov * factor + np.diag(floors**2)
            yield pd.DataFrame(
                {
                    "grp": f["grp"],
                    "start": f["start"],
                    "centre": list(mean),
                    "inverse": list(np.linalg.inv(cov).reshape(len(f), -1)) if len(f) else [],
                    "logdet": np.linalg.slogdet(cov)[1],
                }
            )

    return sums.mapInPandas(run, out)


def _inner(rows: DataFrame, estimates: DataFrame, p: int, share: float) -> DataFrame:
    """Moments of the share of each group's rows that lie nearest, for each estimate."""
    bin_ = F.floor(F.log(_distance(p) + F.lit(1e-9)) * 50).cast("int")
    folded = rows.join(estimates, "grp").withColumn("bin", bin_).groupBy("grp", "start", "bin").agg(*_moments(p))
    upto = Window.partitionBy("grp", "start").orderBy("bin")
    whole = Window.partitionBy("grp", "start")
    folded = folded.withColumns({"before": F.sum("n").over(upto) - F.col("n"), "all": F.sum("n").over(whole)})
    names = [c for c in folded.columns if re.fullmatch(r"n|s\d(_\d)?", c)]
    inside = folded.where(F.col("before") < share * F.col("all"))
    return inside.groupBy("grp", "start").agg(*[F.sum(c).alias(c) for c in names])


def _starts(rows: DataFrame, p: int, s: Settings, tasks: int) -> DataFrame:
    """Two estimates for each group: quartile spreads without and with the correlation of bounded scores."""
    quartiles = rows.groupBy("grp").agg(
        *[F.percentile_approx(f"x{k}", [0.25, 0.5, 0.75], 10_000).alias(f"q{k}") for k in range(p)]
    )
    middle = [F.col(f"q{k}")[1] for k in range(p)]
    spread = [F.greatest((F.col(f"q{k}")[2] - F.col(f"q{k}")[0]) / 1.349, F.lit(s.floors[k])) for k in range(p)]
    scales = settle_few(quartiles.select("grp", F.array(*middle).alias("centre"), F.array(*spread).alias("scale")), tasks)
    score = [F.tanh((F.col(f"x{k}") - F.col("centre")[k]) / F.col("scale")[k]) for k in range(p)]
    bounded = rows.join(scales, "grp").select("grp", *[score[k].alias(f"x{k}") for k in range(p)])
    sums = bounded.groupBy("grp").agg(*_moments(p)).join(scales, "grp").coalesce(tasks)
    out = "grp string, start int, centre array<double>, inverse array<double>"

    def run(frames):
        import pandas as pd

        for f in frames:
            parts = []
            for _, r in f.iterrows():
                scale = np.array(r["scale"], float)
                mean = np.array([r[f"s{k}"] for k in range(p)]) / r["n"]
                cov = np.zeros((p, p))
                for i in range(p):
                    for j in range(i, p):
                        cov[i, j] = cov[j, i] = r[f"s{i}_{j}"] / r["n"] - mean[i] * mean[j]
                cov += np.eye(p) * 0.05
                deviation = np.sqrt(np.diag(cov))
                correlated = cov / np.outer(deviation, deviation) * np.outer(scale, scale)
                for start, full in enumerate((np.diag(scale**2), correlated)):
                    parts.append((r["grp"], start, r["centre"], np.linalg.inv(full).ravel()))
            yield pd.DataFrame(parts, columns=["grp", "start", "centre", "inverse"])

    return sums.mapInPandas(run, out)


def robust_estimates(rows: DataFrame, s: Settings = Settings()) -> DataFrame:
    """centre and inverse covariance of every group of a stored frame with grp and x0..x4."""
    p = len(s.floors)
    rows = rows.select("grp", *[f"x{k}" for k in range(p)])
    # The tables of groups are small: a few tasks, and not one for each shuffle partition.
    tasks = tasks_for(rows.count(), s.docs_per_task, 4)
    estimates = settle(_starts(rows, p, s, tasks))
    factor = consistency(s.share, p)
    for _ in range(s.steps):
        estimates = settle(_estimates(_inner(rows, estimates, p, s.share).coalesce(tasks), p, s, factor))
    best = estimates.groupBy("grp").agg(F.min_by(F.struct("centre", "inverse"), F.struct("logdet", "start")).alias("b"))
    best = settle_few(best.select("grp", F.lit(0).alias("start"), "b.centre", "b.inverse"), tasks)
    near = rows.join(best, "grp").where(_distance(p) <= chi2_quantile(0.975, p))
    sums = near.groupBy("grp", "start").agg(*_moments(p)).coalesce(tasks)
    return _estimates(sums, p, s, consistency(0.975, p)).select("grp", "centre", "inverse")


def _fitted(stats: DataFrame, s: Settings) -> DataFrame:
    """lang, source, usual, centre and inverse: all that a verdict needs, from stored statistics."""
    passed = stats.where("not base_failed")
    tasks = tasks_for(stats.count(), s.docs_per_task, 4)
    groups = settle_few(_with_usual(passed, _groups(passed, s, tasks)), tasks)
    rows = _by_group(passed, groups).where("grp is not null").withColumns(_vector(s))
    estimates = robust_estimates(settle(rows.select("grp", *_vector(s))), s)
    return settle_few(groups.join(estimates, "grp", "left").drop("grp"), tasks)


def _verdicts(stats: DataFrame, fitted: DataFrame, s: Settings) -> DataFrame:
    """Adds distance and kept."""
    judged = _by_group(stats, fitted).withColumns(_vector(s))
    judged = judged.withColumn("distance", F.when(~F.col("base_failed"), _distance(len(s.floors))))
    return judged.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= s.cutoff, F.lit(True)))


def judge(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``RESULT`` and the squared distance of every row; the distance is null where there is no verdict."""
    stats = settle(with_base_rules(statistics(docs), s))
    return _verdicts(stats, _fitted(stats, s), s).select(*RESULT, "distance")


def accept(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The documents that are kept, with all their columns.

    Texts are counted twice, once for the estimates and once for the verdicts: the verdict needs
    only the small table of groups, so no text is shuffled to meet it.
    """
    stats = settle(with_base_rules(statistics(docs), s))
    fitted = _fitted(stats, s)
    columns = tuple(docs.columns)
    inner = {c: f"own_{k}" for k, c in enumerate(columns) if c not in ("lang", "source")}
    carried = docs.select("*").withColumnsRenamed(inner).withColumn("text", F.col(inner["text"]))
    counted = with_statistics(carried, tuple(c for c in carried.columns if c != "text"))
    kept = _verdicts(with_base_rules(counted, s), fitted, s).where("kept")
    return kept.select(*[F.col(inner.get(c, c)).alias(c) for c in columns])
