"""Toxicity by a convolutional text classifier over hashed word embeddings, trained in numpy.

A word is a run of letters, lower-cased in ASCII. Its embedding is the sum of two hashed rows:
one for the word, one for its first four bytes, which words of one stem share. Filters of
widths 1, 2 and 3 run over the words of the whole text, each filter's largest response is kept
(max pooling), and a logistic layer gives the score. Every word of every text is read. A text
without words, and a null one, has the share of toxic labels as its score.

The classifier is trained on every labelled row outside the held-out fold, however long its text. The rows
are dealt to shards by doc_id. Each shard's task goes through its rows once in the order of a hash, from
one common start, and what the tasks changed is averaged, weighted by their rows. A hashed row that
too few texts of all shards touch is set to zero. A small table is gone through ``Settings.passes`` times. The start is fitted on the driver, on at most
``Settings.toxic`` and ``Settings.clean`` rows with a text of at most ``Settings.longest`` characters, drawn
by a hash of doc_id; there an id gives one row, the least of several. It only tells where the pass over
all rows begins. A fifth of the ids is not trained on; all their rows are scored, and thresholds for each
language are calibrated there, or for all languages together where one has too few rows.
A document labelled toxic by any of its label rows counts as toxic; rows without a label are
left out. Without labelled rows of both kinds, every score is the share of toxic labels.

Every row is scored by its text alone, so repeated rows have the same score, a null doc_id is no
obstacle, and such a row is not held out. A null language has the general threshold. A score equal
to a threshold counts as toxic. An empty table gives an empty result. ``score`` and ``judge`` leave
other columns out, ``accept`` keeps them.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.frames import only, tasks_for, text_fold
from pulsegrid.llm.settings import shuffles_removed, small_batches
from pulsegrid.llm.words import LETTERS, WordReader, Words, text_blocks
from pulsegrid.sources.settle import settle

FOLDS, HELD_OUT = 4, 2
PREDICT_FROM = 0.3
SCORES = "doc_id long, lang string, score double"
#: The thresholds that calibration tries.
CUTS = np.arange(1, 1000) / 1000
#: Pieces in which the shards' changes are shuffled and summed.
PIECES = 16


@dataclass(frozen=True)
class Settings:
    toxic: int = 3000
    clean: int = 5000
    longest: int = 16_000
    word_rows: int = 1 << 15
    prefix_rows: int = 1 << 13
    size: int = 12
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 8
    steps: int = 500
    batch: int = 64
    rate: float = 0.08
    seed: int = 7
    #: Hashed rows that fewer training texts touch stay zero: a word of one text says nothing.
    least_texts: int = 3
    #: Share of words left out of each training step.
    drop: float = 0.3
    most_epochs: int = 40
    #: Labelled ids of a shard, and bytes of text that a training step reads, or one row that holds more.
    shard: int = 8192
    step_bytes: int = 1 << 20
    #: Passes over all rows at most, where ``steps`` batches are more than one.
    passes: int = 3
    #: Calibration rows of each kind that a language needs for a threshold of its own.
    own_threshold: int = 20


def _words(reader: WordReader, texts: list[bytes | None], s: Settings) -> tuple[Words, np.ndarray, np.ndarray]:
    words = reader.read(texts)
    return words, (words.hash % np.uint64(s.word_rows)).astype(np.int32), (words.prefix % np.uint64(s.prefix_rows)).astype(np.int32)


def new_reader() -> WordReader:
    return WordReader(LETTERS, lower=True, prefix=4)


@dataclass
class Model:
    settings: Settings
    word: np.ndarray
    prefix: np.ndarray
    conv: dict[int, np.ndarray]  # width -> (width, size, filters)
    bias: dict[int, np.ndarray]
    top: np.ndarray
    shift: float
    thresholds: dict[str | None, float] = field(default_factory=dict)
    threshold: float = PREDICT_FROM
    #: The share of toxic labels, which is the score of a text without words.
    base_rate: float = 0.0

    @staticmethod
    def fresh(s: Settings) -> Model:
        rng = np.random.default_rng(s.seed)
        normal = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
        return Model(
            s,
            normal(s.word_rows, s.size) * 0.3,
            normal(s.prefix_rows, s.size) * 0.3,
            {w: normal(w, s.size, s.filters) for w in s.widths},
            {w: np.zeros(s.filters, np.float32) for w in s.widths},
            normal(len(s.widths) * s.filters),
            0.0,
        )

    def tables(self) -> list[np.ndarray]:
        """Everything that is trained but the shift, as views."""
        filters = [part for w in self.settings.widths for part in (self.conv[w], self.bias[w])]
        return [self.word, self.prefix, *filters, self.top]

    def flat(self) -> np.ndarray:
        return np.concatenate([*(table.ravel() for table in self.tables()), [self.shift]]).astype(float)

    def add(self, change: np.ndarray) -> None:
        at = 0
        for table in self.tables():
            table += change[at : at + table.size].reshape(table.shape).astype(np.float32)
            at += table.size
        self.shift += float(change[at])

    def responses(self, text: np.ndarray, embedded: np.ndarray) -> dict[int, np.ndarray]:
        """For each width, (words, filters): the filter's response with its first place on the word.

        Places beyond the end of the text count as zero.
        """
        out = {}
        for width in self.settings.widths:
            y = embedded @ self.conv[width][0] + self.bias[width]
            for k in range(1, width):
                inside = (text[k:] == text[:-k])[:, None]
                y[:-k] += inside * (embedded[k:] @ self.conv[width][k])
            out[width] = y
        return out

    def pooled(self, words: Words, word_at: np.ndarray, prefix_at: np.ndarray) -> tuple[np.ndarray, dict, np.ndarray, np.ndarray]:
        embedded = self.word[word_at] + self.prefix[prefix_at]
        pooled = np.zeros((words.n_texts, len(self.top)), np.float32)
        present, first = np.unique(words.text, return_index=True)
        y = {}
        if len(present):
            y = self.responses(words.text, embedded)
            highest = np.concatenate([np.maximum.reduceat(y[w], first, axis=0) for w in self.settings.widths], axis=1)
            pooled[present] = np.maximum(highest, 0)
        return pooled, y, embedded, present

    def scores(self, reader: WordReader, texts: list[bytes | None]) -> np.ndarray:
        words, *places = _words(reader, texts, self.settings)
        pooled = self.pooled(words, *places)[0]
        found = 1 / (1 + np.exp(-np.clip(pooled @ self.top + self.shift, -30, 30).astype(float)))
        return np.where(words.counts() > 0, found, self.base_rate)


class Trainer:
    """Adagrad on the logistic loss. Only the places that won the pooling pass a gradient on."""

    def __init__(self, model: Model):
        self.model = model
        self._seen: dict[str, np.ndarray] = {}
        self._live: dict[str, np.ndarray] = {}

    def _step(self, name: str, values: np.ndarray, gradient: np.ndarray) -> None:
        seen = self._seen.setdefault(name, np.full(values.shape, 1e-3, np.float32))
        seen += gradient**2
        values -= self.model.settings.rate * gradient / np.sqrt(seen)

    def texts_by_row(self, words: Words, word_at: np.ndarray, prefix_at: np.ndarray) -> dict[str, np.ndarray]:
        """For each hashed row, the texts that touch it."""
        s, found = self.model.settings, {}
        for name, place, size in (("word", word_at, s.word_rows), ("prefix", prefix_at, s.prefix_rows)):
            pair = np.unique(words.text.astype(np.int64) << 32 | place)
            found[name] = np.bincount(pair & 0xFFFFFFFF, minlength=size)
        return found

    def keep_frequent(self, reader: WordReader, texts: list[bytes], rows: np.ndarray) -> None:
        m, s = self.model, self.model.settings
        seen = {"word": np.zeros(s.word_rows, int), "prefix": np.zeros(s.prefix_rows, int)}
        for at in range(0, len(rows), 256):
            for name, count in self.texts_by_row(*_words(reader, _take(texts, rows[at : at + 256]), s)).items():
                seen[name] += count
        for name, table in (("word", m.word), ("prefix", m.prefix)):
            self._live[name] = seen[name] >= s.least_texts
            table[~self._live[name]] = 0

    def all_live(self) -> None:
        """Rows that were left at zero begin as new ones."""
        new = Model.fresh(self.model.settings)
        for name, table, fresh in (("word", self.model.word, new.word), ("prefix", self.model.prefix, new.prefix)):
            if name in self._live:
                table[~self._live[name]] = fresh[~self._live[name]]
        self._live = {"word": np.ones(len(new.word), bool), "prefix": np.ones(len(new.prefix), bool)}

    def _row_step(self, name: str, table: np.ndarray, at: np.ndarray, gradient: np.ndarray) -> None:
        live = self._live[name][at]
        rows, back = np.unique(at[live], return_inverse=True)
        total = np.zeros((len(rows), table.shape[1]), np.float32)
        np.add.at(total, back, gradient[live])
        seen = self._seen.setdefault(name, np.full(table.shape, 1e-3, np.float32))
        seen[rows] += total**2
        table[rows] -= self.model.settings.rate * total / np.sqrt(seen[rows])

    def step(self, words: Words, word_at: np.ndarray, prefix_at: np.ndarray, toxic: np.ndarray) -> None:
        m, s = self.model, self.model.settings
        pooled, y, embedded, present = m.pooled(words, word_at, prefix_at)
        p = 1 / (1 + np.exp(-np.clip(pooled @ m.top + m.shift, -30, 30)))
        error = ((p - toxic) / len(toxic)).astype(np.float32)
        below = error[:, None] * m.top * (pooled > 0)
        self._step("top", m.top, pooled.T @ error + 1e-4 * m.top)
        m.shift -= s.rate * float(error.sum())
        if not len(present):
            return
        places, gradients = [], []
        for nth, width in enumerate(s.widths):
            part = slice(nth * s.filters, (nth + 1) * s.filters)
            text, column = np.nonzero(below[:, part])
            if not len(text):
                continue
            won = np.full((words.n_texts, s.filters), -1)
            at, col = np.nonzero(y[width] == pooled[words.text, part])
            won[words.text[at[::-1]], col[::-1]] = at[::-1]  # the first of equals stays
            first, force = won[text, column], below[:, part][text, column]
            d_conv, d_bias = np.zeros_like(m.conv[width]), np.zeros_like(m.bias[width])
            np.add.at(d_bias, column, force)
            for k in range(width):
                place = first + k
                inside = place < len(words.text)
                inside[inside] = words.text[place[inside]] == text[inside]
                here, c, f = place[inside], column[inside], force[inside][:, None]
                np.add.at(d_conv[k].T, c, f * embedded[here])
                places.append(here)
                gradients.append(f * m.conv[width][k].T[c])
            self._step(f"conv{width}", m.conv[width], d_conv)
            self._step(f"bias{width}", m.bias[width], d_bias)
        if places:
            at, gradient = np.concatenate(places), np.concatenate(gradients)
            self._row_step("word", m.word, word_at[at], gradient)
            self._row_step("prefix", m.prefix, prefix_at[at], gradient)


def _take(texts: list[bytes], rows: np.ndarray) -> list[bytes]:
    return [texts[i] for i in rows]


def _thinned(words: Words, places: list[np.ndarray], rng: np.random.Generator, s: Settings) -> tuple:
    stay = rng.random(len(words.text)) >= s.drop
    return Words(words.text[stay], words.hash[stay], words.prefix[stay], words.n_texts), *(place[stay] for place in places)


def _odds(share: float) -> float:
    share = min(max(share, 1e-4), 1 - 1e-4)
    return math.log(share / (1 - share))


def _for_calibration(key) -> bool:
    return hashlib.md5(str(key).encode()).digest()[0] % 5 == 0


def _flat_model(base_rate: float, s: Settings) -> Model:
    """Gives every text the share of toxic labels."""
    model = Model.fresh(s)
    model.top[:], model.shift, model.base_rate = 0, _odds(base_rate), min(max(base_rate, 1e-4), 1 - 1e-4)
    return model


def _start(texts: list[bytes], toxic: np.ndarray, keys: list, base_rate: float, s: Settings) -> Trainer | None:
    """The trainer after its steps on the given rows; None if those that are not for calibration are of one kind."""
    model, reader = Model.fresh(s), new_reader()
    train = np.flatnonzero(~np.array([_for_calibration(k) for k in keys], bool))
    model.base_rate = min(max(base_rate, 1e-4), 1 - 1e-4)
    if not len(train) or len(set(toxic[train])) < 2:
        return None
    trainer, rng = Trainer(model), np.random.default_rng(s.seed)
    order = np.zeros(0, int)
    trainer.keep_frequent(reader, texts, train)
    for _ in range(min(s.steps, s.most_epochs * -(-len(train) // s.batch))):
        if len(order) < s.batch:
            order = np.concatenate([order, rng.permutation(train)])
        rows, order = order[: s.batch], order[s.batch :]
        words, *places = _words(reader, _take(texts, rows), s)
        trainer.step(*_thinned(words, places, rng, s), toxic[rows])
    # The sample holds more toxic rows than the corpus: give the bias the corpus's odds.
    model.shift += _odds(base_rate) - _odds(float(toxic[train].mean()))
    return trainer


def fit(texts: list[bytes], toxic: np.ndarray, langs: list[str | None], keys: list, base_rate: float, s: Settings = Settings()) -> Model:
    """The model for labelled texts that one machine holds. base_rate: the share of toxic rows among all labelled ones."""
    trainer = _start(texts, toxic, keys, base_rate, s)
    if trainer is None:
        return _flat_model(base_rate, s)
    model, reader = trainer.model, new_reader()
    rows = np.flatnonzero(np.array([_for_calibration(k) for k in keys], bool))
    scores = [model.scores(reader, _take(texts, rows[at : at + 64])) for at in range(0, len(rows), 64)]
    bins = np.searchsorted(CUTS, np.concatenate([*scores, []]), side="right")
    _calibrate(model, [(langs[i], at, 1, int(toxic[i])) for i, at in zip(rows, bins.tolist(), strict=True)], base_rate)
    return model


def _calibrate(model: Model, counts: list[tuple], base_rate: float | None = None) -> None:
    """Sets the thresholds from (language, cuts that a score reaches, rows, toxic ones) of the calibration rows.

    base_rate: the share of toxic rows where the given ones hold another.
    """
    by_lang: dict[str | None, np.ndarray] = {}
    for lang, at, rows, toxic in counts:
        by_lang.setdefault(lang or None, np.zeros((2, len(CUTS) + 1)))[:, at] += (rows - toxic, toxic)
    if not by_lang:
        return
    everywhere = sum(by_lang.values())
    clean, bad = everywhere.sum(axis=1)
    share = min(max(bad / (clean + bad), 1e-4), 1 - 1e-4)
    clean_weight, weight = (1, 1) if base_rate is None else ((1 - base_rate) / (1 - share), base_rate / share)

    def best(part: np.ndarray) -> float | None:
        if part.sum(axis=1).min() < model.settings.own_threshold:
            return None
        above = part[:, ::-1].cumsum(axis=1)[:, ::-1][:, 1:]  # rows that reach each cut
        hit = weight * above[1]
        f1 = 2 * hit / (hit + clean_weight * above[0] + weight * part[1].sum())
        top = np.flatnonzero(f1 >= f1.max() - 1e-12)  # of equals, the one nearest to the general threshold
        return float(CUTS[top[np.abs(CUTS[top] - PREDICT_FROM).argmin()]])

    if (found := best(everywhere)) is not None:
        model.threshold = found
    for lang in sorted(set(by_lang) - {None}):
        if (own := best(by_lang[lang])) is not None:
            model.thresholds[str(lang)] = own


def _sample(docs: DataFrame, known: DataFrame, s: Settings) -> DataFrame:
    """At most s.toxic + s.clean rows doc_id, toxic, text, lang, one for each drawn id."""
    texts = only(docs, ("doc_id", "text", "lang"), "documents").where((F.length("text") <= s.longest) & F.col("doc_id").isNotNull())
    fitting = settle(known.join(texts.select("doc_id").distinct(), "doc_id", "left_semi"))
    drawn = [
        fitting.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        for kind, most in ((1, s.toxic), (0, s.clean))
    ]
    # As many rows of two numbers as the sample has. Rows of an id are folded in the tasks that read them.
    ids = F.broadcast(drawn[0].unionByName(drawn[1]))
    least = texts.join(ids, "doc_id").groupBy("doc_id", "toxic").agg(F.min(F.struct("text", "lang")).alias("least"))
    return least.select("doc_id", "toxic", "least.*")


def _labelled(labels: DataFrame) -> DataFrame:
    """doc_id and toxic of the labelled ids outside the held-out fold."""
    known = only(labels, ("doc_id", "toxic"), "labels").where("doc_id is not null and toxic is not null")
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    return known.where(text_fold(F.col("doc_id"), FOLDS) != HELD_OUT)


def _calibrates() -> Column:
    """_for_calibration of doc_id."""
    return F.conv(F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 1, 2), 16, 10).cast("int") % 5 == 0


def _changes(docs: DataFrame, known: DataFrame, trainer: Trainer, shards: int, number: int) -> DataFrame:
    """piece, shard and values of what each shard's pass over its training rows changes.

    values are the change times the shard's rows, the texts by hashed row, the rows and the toxic ones, end to
    end. Both sides are dealt by doc_id, so a text is shuffled once; a task reads it as a stream.
    """
    parts = [known.where(~_calibrates()), only(docs, ("doc_id", "text"), "documents").where(~_calibrates() & (text_fold(F.col("doc_id"), FOLDS) != HELD_OUT))]
    known, texts = [part.repartition(shards, "doc_id") for part in parts]
    rows = texts.join(known, "doc_id").select("text", "toxic", F.xxhash64("doc_id", "text").alias("place"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, s, shard, reader = trainer.model, trainer.model.settings, TaskContext.get().partitionId(), new_reader()
        before, rng = m.flat(), np.random.default_rng((s.seed, number, shard))
        seen, rows, bad = {"word": np.zeros(s.word_rows), "prefix": np.zeros(s.prefix_rows)}, 0, 0.0
        for batch in batches:
            toxic = batch.column("toxic").to_numpy().astype(np.float32)
            for at in range(0, batch.num_rows, s.batch):
                for inner, texts in text_blocks(batch.column("text").slice(at, s.batch), s.step_bytes):
                    here = toxic[at + inner : at + inner + len(texts)]
                    words, *places = _words(reader, texts, s)
                    for name, count in trainer.texts_by_row(words, *places).items():
                        seen[name] += count
                    trainer.step(*_thinned(words, places, rng, s), here)
                    rows, bad = rows + len(texts), bad + float(here.sum())
        if rows:
            values = np.concatenate([(m.flat() - before) * rows, seen["word"], seen["prefix"], [rows, bad]])
            for piece, part in enumerate(np.array_split(values, PIECES)):
                yield pa.RecordBatch.from_pydict({"piece": pa.array([piece], pa.int32()), "shard": pa.array([shard], pa.int32()), "values": [part.astype("<f8").tobytes()]})

    return rows.sortWithinPartitions("place").select("text", "toxic").mapInArrow(run, "piece int, shard int, values binary")


def _summed(changes: DataFrame) -> DataFrame:
    """piece and the sum of the shards' values, added in the order of the shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, total = None, np.zeros(0)
        row = lambda: pa.RecordBatch.from_pydict({"piece": pa.array([current], pa.int32()), "values": [total.tobytes()]})
        for batch in batches:
            for piece, blob in zip(batch.column("piece").to_pylist(), batch.column("values"), strict=True):
                values = np.frombuffer(blob.as_buffer(), "<f8")
                if piece == current:
                    total += values
                    continue
                if current is not None:
                    yield row()
                current, total = piece, values.copy()
        if current is not None:
            yield row()

    dealt = changes.repartition("piece").sortWithinPartitions("piece", "shard").select("piece", "values")
    return dealt.mapInArrow(run, "piece int, values binary")


def _pass(docs: DataFrame, known: DataFrame, trainer: Trainer, shards: int, number: int) -> bool:
    """Takes the trainer's model through all training rows. False if they are of one kind."""
    m, s = trainer.model, trainer.model.settings
    trainer.all_live()
    with small_batches(docs.sparkSession), shuffles_removed(docs.sparkSession):
        found = _summed(_changes(docs, known, trainer, shards, number)).collect()  # as many numbers as the model has
    if not found:
        return False
    values = np.concatenate([np.frombuffer(r["values"]) for r in sorted(found, key=lambda r: r.piece)])
    rows, toxic = values[-2:]
    m.add(values[: -2 - s.word_rows - s.prefix_rows] / rows)
    m.prefix[values[-2 - s.prefix_rows : -2] < s.least_texts] = 0
    m.word[values[-2 - s.word_rows - s.prefix_rows : -2 - s.prefix_rows] < s.least_texts] = 0
    return 0 < toxic < rows


def _calibration_counts(docs: DataFrame, known: DataFrame, model: Model) -> list[tuple]:
    """(language, cuts that a score reaches, rows, toxic ones) of all calibration rows, a thousand for each language at most."""
    chosen = docs.where(_calibrates() & (text_fold(F.col("doc_id"), FOLDS) != HELD_OUT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = pa.array(np.searchsorted(CUTS, batch.column("score").to_numpy(), side="right").astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), cuts], ["doc_id", "lang", "cuts"])

    reached = score(chosen, model).mapInArrow(run, "doc_id long, lang string, cuts int").join(known, "doc_id")
    return [tuple(r) for r in reached.groupBy("lang", "cuts").agg(F.count("*"), F.sum("toxic")).collect()]


def train(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> Model:
    """Trains and calibrates on all labelled rows outside the held-out fold. Only the start's texts reach the driver."""
    known = settle(_labelled(labels))
    total = known.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    base_rate = total[1] / total[0] if total[0] else 0.0
    if not 0 < base_rate < 1:
        return _flat_model(base_rate, s)
    rows = _sample(docs, known, s).collect()
    rows.sort(key=lambda r: (hashlib.md5(str(r.doc_id).encode()).digest(), r.text))
    toxic = np.array([r.toxic for r in rows], np.float32)
    trainer = _start([r.text.encode() for r in rows], toxic, [r.doc_id for r in rows], base_rate, s)
    if trainer is None:
        trainer = Trainer(Model.fresh(s))
        trainer.model.shift, trainer.model.base_rate = _odds(base_rate), min(max(base_rate, 1e-4), 1 - 1e-4)
    for number in range(min(s.passes, -(-s.steps * s.batch // total[0]))):
        if not _pass(docs, known, trainer, tasks_for(total[0], s.shard, 1), number):
            return _flat_model(base_rate, s)
    _calibrate(trainer.model, _calibration_counts(docs, known, trainer.model))
    return trainer.model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang and score of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = new_reader()
        for batch in batches:
            found = [model.scores(reader, texts) for _, texts in text_blocks(batch.column("text"), 1 << 20)]
            scores = pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())
            columns = [batch.column("doc_id").cast(pa.int64()), batch.column("lang").cast(pa.string()), scores]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang", "score"])

    return only(docs, ("doc_id", "lang", "text"), "documents").mapInArrow(run, SCORES)


def accept(docs: DataFrame, model: Model) -> DataFrame:
    """The documents below their language's threshold, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = new_reader()
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for at, texts in text_blocks(batch.column("text"), 1 << 20):
                cuts = [model.thresholds.get(lang, model.threshold) for lang in langs[at : at + len(texts)]]
                stays = model.scores(reader, texts) < np.array(cuts)
                yield batch.slice(at, len(texts)).filter(pa.array(stays, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def limit(model: Model, lang) -> Column:
    """The language's own threshold, else the general one."""
    found = F.lit(model.threshold)
    for name, value in model.thresholds.items():
        found = F.when(lang == name, F.lit(value)).otherwise(found)
    return found


def judge(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, score, predicted (from ``PREDICT_FROM`` on) and toxic (by the language's threshold)."""
    model = train(docs, labels, s)
    scored = score(docs, model)
    return scored.select(
        "doc_id",
        F.coalesce(text_fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= PREDICT_FROM).cast("int").alias("predicted"),
        (F.col("score") >= limit(model, F.col("lang"))).alias("toxic"),
    )
