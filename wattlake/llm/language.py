"""Language of a text: known words first, then ever shorter character n-grams.

The model holds, for each language, the log frequency of the common words and of character n-grams
of words. A word that the model knows is scored by its own log frequencies. An unseen word backs
off: it is scored by its longest n-grams if the model knows one of them, else by the next shorter
ones, down to single letters. The text's score of a language is the sum over its words plus the
log of the language's share of the training texts.

Words and n-grams are counted over all training texts and languages; Spark sums the counts. Only
entries that occur often enough travel to the tasks, as many as MOST_WORDS and MOST_GRAMS say: rare
words are what the n-grams are for.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm.arrow import id_and_text, map_in_arrow, slices
from wattlake.session import work_folder

#: Most counts (entries times languages) of words and of n-grams that a model holds.
MOST_WORDS, MOST_GRAMS = 400_000, 400_000
#: The longest n-grams.
LONGEST = 5
#: Counts are summed in a task up to so many different entries, then handed on.
FLUSH = 200_000
#: Unseen words whose scores a worker keeps, and texts that it scores at once.
CACHED, ROWS = 200_000, 64
#: Added to each count, in words or n-grams.
SMOOTHING = 0.5
#: Letters of a word; a longer one counts as several.
LONGEST_WORD = 40

_WORD = re.compile(rf"[^\W\d_]{{1,{LONGEST_WORD}}}")


def words_of(text: str) -> dict[str, int]:
    """Runs of letters in lower case with their counts; longer ones in parts of LONGEST_WORD letters."""
    counts: dict[str, int] = Counter(text.lower().split())
    for token in [t for t in counts if not t.isalpha() or len(t) > LONGEST_WORD]:
        times = counts.pop(token)
        for word in _WORD.findall(token):
            counts[word] = counts.get(word, 0) + times
    return counts


def grams_of(word: str, n: int) -> list[str]:
    """n-grams of a word between two blanks; single letters without them."""
    marked = f" {word} " if n > 1 else word
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def _counted(table: DataFrame, entries, source: list[str]) -> DataFrame:
    """entry, language, count: entries(batch) gives a language's Counter for each row.

    A task sums what it meets, so that a word as common as one third of all words leaves it as one
    row, and hands the sums on before they outgrow its memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for language, counts in held.items():
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(counts), pa.string()),
                        pa.array([language] * len(counts), pa.string()),
                        pa.array(list(counts.values()), pa.int64()),
                    ],
                    names=["entry", "language", "n"],
                )
            held.clear()

        for batch in batches:
            for language, counts in entries(batch):
                held.setdefault(language, Counter()).update(counts)
                if sum(map(len, held.values())) > FLUSH:
                    yield from flush()
        yield from flush()

    return (
        map_in_arrow(table.select(*source), run, "entry string, language string, n long")
        .groupBy("entry", "language")
        .agg(F.sum("n").alias("n"))
    )


def _words(batch: pa.RecordBatch) -> Iterator[tuple[str, Counter]]:
    for text, language in zip(batch.column("text").to_pylist(), batch.column("language").to_pylist()):
        yield language, words_of(text)


def _grams(batch: pa.RecordBatch) -> Iterator[tuple[str, Counter]]:
    """n-grams of words; words of the same language and count are counted as one list."""
    alike: dict[tuple[str, int], list[str]] = {}
    for word, language, times in zip(*(batch.column(c).to_pylist() for c in ("entry", "language", "n"))):
        own = alike.setdefault((language, times), [])
        for n in range(1, LONGEST + 1):
            own += grams_of(word, n)
    for (language, times), grams in alike.items():
        yield language, Counter({gram: times * n for gram, n in Counter(grams).items()})


def _common(counts: DataFrame, most: int) -> DataFrame:
    """entry, by_language (map of counts) of the entries from the least total on for which at most
    that many are left.

    The least total is found on a histogram of totals, so the entries are not sorted. Only if more
    than ``most`` entries share the largest total, these are cut by name.
    """
    whole = counts.groupBy("entry").agg(
        F.sum("n").alias("total"),
        F.map_from_entries(F.collect_list(F.struct("language", "n"))).alias("by_language"),
    )
    bars = counts.groupBy("entry").agg(F.sum("n").alias("total")).groupBy("total").agg(F.count("*").alias("rows"))
    kept, least = 0, None
    for bar in bars.orderBy(F.col("total").desc()).limit(most + 1).toLocalIterator():
        if kept + bar["rows"] > most:
            break
        kept, least = kept + bar["rows"], bar["total"]
    if least is None:
        return whole.orderBy(F.col("total").desc(), "entry").limit(most)
    return whole.where(F.col("total") >= F.lit(least))


@dataclass
class Model:
    """languages: in order. words and grams: entry to row of scores."""

    languages: list[str]
    prior: np.ndarray
    words: dict[str, int]
    grams: dict[str, int]
    scores: np.ndarray
    # Words and, after them, unseen words met so far: their rows, and scores with room for more.
    _rows: dict[str, int] = field(default_factory=dict, repr=False)
    _all: np.ndarray | None = field(default=None, repr=False)

    def _back_off(self, words: list[str]) -> np.ndarray:
        """For each word the mean score of its longest n-grams of which the model knows one; 0 without any."""
        get, rows, sizes = self.grams.get, [], []
        for word in words:
            own: list[int] = []
            for n in range(min(LONGEST, len(word) + 2), 0, -1):
                own = [r for g in grams_of(word, n) if (r := get(g)) is not None]
                if own:
                    break
            rows += own
            sizes.append(len(own))
        size = np.array(sizes)
        out = np.zeros((len(words), len(self.languages)))
        some = np.flatnonzero(size)
        if len(some):
            begins = np.cumsum(size[some]) - size[some]
            out[some] = np.add.reduceat(self.scores[rows], begins) / size[some, None]
        return out

    def log_odds(self, counts: list[dict[str, int]]) -> np.ndarray:
        """Log of prior and of all words of each text, for each language.

        Words of which not even a letter is known are neutral. Scores of unseen words are kept for
        the texts to come, up to CACHED of them (or those of one call).
        """
        rows = [list(map(self._rows.get, words)) for words in counts]
        unseen = {w for words, own in zip(counts, rows) if None in own for w, r in zip(words, own) if r is None}
        base = len(self.scores)
        if self._all is None or len(self._rows) - len(self.words) + len(unseen) > len(self._all) - base:
            self._rows = dict(self.words)
            rows = [[None]] * len(counts)
            unseen = {w for words in counts for w in words if w not in self._rows}
            room = np.zeros((max(CACHED, len(unseen)), len(self.languages)))
            self._all = np.concatenate([self.scores, room])
        fresh, begin = sorted(unseen), base + len(self._rows) - len(self.words)
        self._all[begin : begin + len(fresh)] = self._back_off(fresh)
        self._rows.update(zip(fresh, range(begin, begin + len(fresh))))
        out = np.tile(self.prior, (len(counts), 1))
        for words, own, odds in zip(counts, rows, out):
            if None in own:
                own = list(map(self._rows.get, words))
            odds += np.array(list(words.values()), float) @ self._all[np.array(own, np.int64)]
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """The likeliest language (the first by name of equal ones) of each text, and its posterior probability."""
        counts = [words_of(t or "") for t in texts]
        if not self.languages:
            return [("und", 0.0)] * len(texts)
        odds = self.log_odds(counts)
        odds = np.exp(odds - odds.max(axis=1, keepdims=True))
        best = odds.argmax(axis=1)
        score = odds.max(axis=1) / odds.sum(axis=1)
        return [
            (self.languages[b], float(p)) if words else ("und", 0.0)
            for b, p, words in zip(best, score, counts)
        ]


def _log_frequencies(rows: pa.Table, languages: list[str], totals: dict[str, int]) -> tuple[list[str], np.ndarray]:
    """Entries, and for each the log frequency in each language less the mean over languages."""
    place = {name: i for i, name in enumerate(languages)}
    counts = np.zeros((rows.num_rows, len(languages)))
    for i, pairs in enumerate(rows["by_language"].to_pylist()):
        for name, n in pairs:
            counts[i, place[name]] = n
    total = np.array([totals.get(name, 0) for name in languages], float)
    logs = np.log((counts + SMOOTHING) / (total + SMOOTHING * max(len(counts), 1)))
    return rows["entry"].to_pylist(), logs - logs.mean(axis=1, keepdims=True)


def fit(
    spark: SparkSession,
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    most_words: int = MOST_WORDS,
    most_grams: int = MOST_GRAMS,
) -> Model:
    """A model of all rows that have a text and a language; without any, one that knows no language."""
    rows = docs.select(
        F.col(f"`{text_col}`").cast("string").alias("text"),
        F.col(f"`{lang_col}`").cast("string").alias("language"),
    ).where("text IS NOT NULL AND language IS NOT NULL")
    tally = {r[0]: r[1] for r in rows.groupBy("language").count().collect()}
    if not tally:
        return Model([], np.zeros(0), {}, {}, np.zeros((0, 0)))
    folder = work_folder(spark, "language")
    _counted(rows, _words, ["text", "language"]).write.parquet(f"{folder}/words")
    words = spark.read.parquet(f"{folder}/words")
    _counted(words, _grams, ["entry", "language", "n"]).write.parquet(f"{folder}/grams")
    grams = spark.read.parquet(f"{folder}/grams")
    languages = sorted(tally)
    prior = np.log([tally[name] / sum(tally.values()) for name in languages])
    word_totals = {r[0]: r[1] for r in words.groupBy("language").agg(F.sum("n")).collect()}
    # Each length of n-grams is a distribution of its own.
    length = F.char_length("entry")
    gram_totals = {
        (r[0], r[1]): r[2] for r in grams.groupBy(length, "language").agg(F.sum("n")).collect()
    }
    entries, scores = _log_frequencies(
        _common(words, most_words // len(languages)).toArrow(), languages, word_totals
    )
    rows_of_words, rows_of_grams, parts = {e: i for i, e in enumerate(entries)}, {}, [scores]
    found = _common(grams, most_grams // len(languages)).toArrow()
    sizes = pc.utf8_length(found["entry"]).to_numpy()
    for n in range(1, LONGEST + 1):
        own = {name: gram_totals.get((n, name), 0) for name in languages}
        entries, scores = _log_frequencies(found.filter(pa.array(sizes == n)), languages, own)
        base = len(rows_of_words) + len(rows_of_grams)
        rows_of_grams.update({e: base + i for i, e in enumerate(entries)})
        parts.append(scores)
    return Model(languages, prior, rows_of_words, rows_of_grams, np.concatenate(parts))


def identify(
    spark: SparkSession,
    docs: DataFrame,
    learn: Column,
    lang_col: str = "lang",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, lang_pred, score for each row, by a model of the rows on which ``learn`` holds.

    lang_pred is a language of the learnt rows, or "und" (score 0) if the text is null or has no
    letter, or if no row has a language. score is the posterior probability of lang_pred; of equal
    languages the first by name is taken. Predictions read the text only. Very long texts are
    scored whole. Repeated rows are counted and answered each; rows with a null id are answered
    alike; an empty table gives no rows; other columns are not read.
    """
    model = spark.sparkContext.broadcast(fit(spark, docs.where(learn), lang_col, text_col))
    source = id_and_text(docs, id_col, text_col)
    kind = source.schema["doc_id"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = model.value.predict
        for batch in (part for whole in batches for part in slices(whole, ROWS)):
            answers = predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([a[0] for a in answers], pa.string()),
                    pa.array([a[1] for a in answers], pa.float64()),
                ],
                names=["doc_id", "lang_pred", "score"],
            )

    return map_in_arrow(source, task, f"doc_id {kind}, lang_pred string, score double")
