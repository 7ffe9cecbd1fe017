"""Language-model scores: a unigram base over words, and a probabilistic suffix tree over words.

Symbols are the words of a text (parted by ASCII white space, A-Z in lower case) and one end. A
context is a sequence of words; its state predicts the next symbol.

The tree grows level by level as Spark tables. A sequence of k words is a candidate context if it
occurs least_context times, the sequence without its last word is a candidate, and the one without
its first word, its suffix, is retained. A candidate is retained if its next-symbol distribution
diverges from that of its suffix by a G-test. Levels are added while contexts are retained: the minima
are absolute, so that the tree grows with the training texts in width and depth.

Distributions are smoothed into those of the suffix (Witten-Bell), and the root's is the base:
P(x|c) = n(c,x) / (n(c) + t(c)) + l(c) P(x|suffix of c) for the t(c) symbols x seen least_pair times
or more after c, and l(c) P(x|suffix) for all others, where l(c) makes the sum one. Each symbol is
scored in the state of the longest retained suffix of what precedes it in its text.

Contexts and pairs of a position are closed under suffixes, so its log10 P is a sum over its levels: the
root's, log10 l of each retained context, and for each counted pair what it has more than these give,
log10 P(x|c) - log10 P(x|suffix of c) - log10 l(c). So each key is looked up for itself.

A sequence is known by a 64-bit polynomial of its words' hashes. Bitmaps of hashes, of a fixed size,
tell tasks which positions may count; joins then part what shares a bit. Of the model the most
frequent keys, a bounded number, go to all tasks as arrays, and bitmaps of the others; keys that
these bitmaps cannot settle are joined with the other keys by a shuffle. Word counts of the base
travel in the same way.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm.arrow import id_and_text, map_in_arrow
from wattlake.llm.text import chunks, words_of
from wattlake.session import shuffles_dropped, work_folder

HEAD_WORDS = 1 << 17
#: The end's hash, and the base of the polynomial of a sequence (odd).
END = np.uint64(0x5851F42D4C957F2D)
BASE = np.uint64(0xD1342543DE82EF95)
#: A count that travels with half a pair stops here; a least count above is taken as this.
MOST_COUNTED = (1 << 12) - 1


@dataclass(frozen=True)
class Settings:
    least_context: int = 32
    least_pair: int = 4
    #: Keys of contexts and of pairs that travel to all tasks: 12 bytes each.
    head_keys: int = 1 << 21
    #: Bits of a bitmap, as a power of two.
    bitmap_bits: int = 27


@dataclass
class Symbols:
    """Words of some texts with an end after each; age is a symbol's place in its text."""

    codes: np.ndarray
    owner: np.ndarray
    age: np.ndarray

    def longer(self, keys: np.ndarray) -> np.ndarray:
        """Keys of sequences of one more symbol, from those that end one symbol earlier."""
        out = self.codes.copy()
        out[1:] += BASE * keys[:-1]
        return out


def symbols_of(texts: list[bytes]) -> Symbols:
    words = words_of(texts, lower=True)
    size = np.diff(words.first)
    owner = np.repeat(np.arange(len(texts)), size + 1)
    opens = words.first[:-1] + np.arange(len(texts))
    codes = np.full(len(owner), END, np.uint64)
    codes[np.arange(len(words.hashes)) + np.repeat(np.arange(len(texts)), size)] = words.hashes
    return Symbols(codes, owner, np.arange(len(owner)) - opens[owner])


class Bitmap:
    """A set of 64-bit keys by their first bits; may say yes to a key it does not hold."""

    def __init__(self, bits: int, places: np.ndarray, words: np.ndarray):
        self.shift = np.uint64(64 - bits)
        self.words = np.zeros(1 << (bits - 6), np.uint64)
        self.words[places] = words.view(np.uint64)

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        place = keys >> self.shift
        return (self.words[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def _bitmap(keys: DataFrame, column: str, bits: int) -> Bitmap:
    """Collected as at most 2 ** (bits - 6) longs, however many keys there are."""
    place = F.shiftrightunsigned(F.col(column), 64 - bits)
    words = keys.groupBy(F.shiftright(place, 6).cast("int").alias("place")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, CAST(shiftrightunsigned({column}, {64 - bits}) & 63 AS INT))")).alias("bits")
    )
    rows = words.toArrow()
    return Bitmap(bits, rows["place"].to_numpy(), rows["bits"].to_numpy())


def _pairs(docs: DataFrame, depth: int, contexts, suffix_pairs) -> DataFrame:
    """context, pair, suffix_pair, n of the positions whose context and suffix's pair may count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            rows = np.concatenate(waiting, axis=1)
            _, where, n = np.unique(rows[1], return_index=True, return_counts=True)
            columns = [pa.array(c[where].view(np.int64)) for c in rows]
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array(n, pa.int64())], names=["context", "pair", "suffix_pair", "n"]
            )

        for batch in batches:
            for _, texts in chunks(batch):
                s = symbols_of(texts)
                shorter = s.codes
                for _ in range(depth - 1):
                    shorter = s.longer(shorter)
                at = np.flatnonzero(s.age >= depth)
                at = at[contexts.value.may_hold(shorter[at - 1])]
                pair = s.codes[at] + BASE * shorter[at - 1]
                if depth > 1:
                    use = suffix_pairs.value.may_hold(shorter[at])
                else:
                    use = suffix_pairs.value.may_hold(pair)
                at, pair = at[use], pair[use]
                waiting.append(np.stack([shorter[at - 1], pair, shorter[at]]))
                size += len(at)
                if size > 2_000_000:
                    yield flush()
                    waiting.clear()
                    size = 0
        if waiting:
            yield flush()

    found = map_in_arrow(docs, run, "context long, pair long, suffix_pair long, n long")
    return found.groupBy("context", "pair", "suffix_pair").agg(F.sum("n").alias("n"))


def _repeated(docs: DataFrame, contexts, least: int) -> DataFrame:
    """First halves of pairs of two words that may occur least times, as keys for a bitmap.

    Halves travel packed: a row holds those of some megabytes that share their first 12 bits, in
    four bytes each, the other 20 bits and a count. A range of 20 bits is counted in an array.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            halves, n = np.unique(np.concatenate(waiting), return_counts=True)
            first, cuts = np.unique(halves >> np.uint32(20), return_index=True)
            data = (halves << np.uint32(12)) | np.minimum(n, MOST_COUNTED).astype(np.uint32)
            parts = [p.astype("<u4").tobytes() for p in np.split(data, cuts[1:])]
            return pa.RecordBatch.from_arrays(
                [pa.array(first.astype(np.int32)), pa.array(parts, pa.binary())], names=["first", "halves"]
            )

        for batch in batches:
            for _, texts in chunks(batch):
                s = symbols_of(texts)
                at = np.flatnonzero(s.age >= 1)
                at = at[contexts.value.may_hold(s.codes[at - 1])]
                pair = s.codes[at] + BASE * s.codes[at - 1]
                waiting.append((pair >> np.uint64(32)).astype(np.uint32))
                size += len(at)
                if size > 4_000_000:
                    yield flush()
                    waiting.clear()
                    size = 0
        if size:
            yield flush()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held = np.zeros(1 << 20, np.int64), None

        def keys() -> pa.RecordBatch:
            often = np.flatnonzero(counts >= min(least, MOST_COUNTED))
            counts[:] = 0
            return pa.RecordBatch.from_arrays([pa.array((held << 52) + (often << 32))], names=["key"])

        for batch in batches:
            for first, data in zip(batch.column("first").to_pylist(), batch.column("halves"), strict=True):
                # Signed keys, as in all tables.
                first = np.int64(first - (first >> 11 << 12))
                if held is not None and first != held:
                    yield keys()
                held = first
                part = np.frombuffer(data.as_buffer(), "<u4")
                counts[part >> np.uint32(12)] += part & np.uint32(MOST_COUNTED)
        if held is not None:
            yield keys()

    halves = map_in_arrow(docs, packed, "first int, halves binary")
    return map_in_arrow(halves.repartition("first").sortWithinPartitions("first"), counted, "key long")


def _sum_counts(docs: DataFrame, each) -> DataFrame:
    """Sum of (code, n) over all texts; each task emits every code once for some megabytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            codes, where = np.unique(np.concatenate([c for c, _ in waiting]), return_inverse=True)
            n = np.bincount(where, np.concatenate([n for _, n in waiting])).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], names=["code", "n"])

        for batch in batches:
            for _, texts in chunks(batch):
                codes, n = each(texts)
                waiting.append((codes, n))
                size += len(codes)
                if size > 4_000_000:
                    yield flush()
                    waiting.clear()
                    size = 0
        if waiting:
            yield flush()

    return map_in_arrow(docs, run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def train(
    spark: SparkSession, docs: DataFrame, vocabulary: DataFrame, ends: int, settings: Settings
) -> tuple[DataFrame, DataFrame, int]:
    """Contexts (key, n, value: log10 of l), pairs (key, n, value: log10 P minus that without it), depth.

    vocabulary: code and n of each word of the texts; docs: their text column.
    """
    folder = work_folder(spark, "suffix-tree-levels")
    sums = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    tokens, kinds = sums[0] + ends, sums[1] + 1
    end = spark.range(1 if ends else 0).select(
        F.lit(int(END.view(np.int64))).alias("code"), F.lit(ends).cast("long").alias("n")
    )
    first = (F.col("n") + 1) / F.lit(float(tokens + kinds + 1))
    upper = vocabulary.unionByName(end).select(
        F.col("code").alias("suffix_pair"),
        (F.col("n") / F.lit(float(max(tokens, 1)))).alias("q_own"),
        first.alias("q"),
    )
    candidates = vocabulary.where(F.col("n") >= settings.least_context).select(
        F.col("code").alias("context"), F.col("n").alias("n_context")
    )
    depth = 0
    while candidates.limit(1).count():
        depth += 1
        share = spark.sparkContext.broadcast
        contexts = share(_bitmap(candidates, "context", settings.bitmap_bits))
        if depth == 1:
            pairs = share(_bitmap(_repeated(docs, contexts, settings.least_pair), "key", settings.bitmap_bits))
        else:
            pairs = share(_bitmap(upper, "suffix_pair", settings.bitmap_bits))
        rows = (
            _pairs(docs, depth, contexts, pairs)
            .where(F.col("n") >= settings.least_pair)
            .join(candidates, "context")
            .join(upper, "suffix_pair")
        )
        rows.write.parquet(f"{folder}/rows{depth}")
        rows = spark.read.parquet(f"{folder}/rows{depth}")
        own = F.col("n") / F.col("n_context")
        rest = F.col("n_context") - F.col("kept")
        rest_g = 2 * rest * F.log(rest / F.col("n_context") / F.greatest(1 - F.col("q_sum"), F.lit(1e-12)))
        retained = (
            rows.groupBy("context", "n_context")
            .agg(
                F.count("*").alias("t"),
                F.sum("n").alias("kept"),
                F.sum(2 * F.col("n") * F.log(own / F.col("q_own"))).alias("g"),
                F.sum("q_own").alias("q_sum"),
            )
            .withColumn("g", F.col("g") + F.when(rest > 0, rest_g).otherwise(0.0))
            # About the 0.1 % level of chi-squared with t degrees of freedom.
            .where(F.col("g") >= F.col("t") + 3.1 * F.sqrt(2.0 * F.col("t")) + 6)
            .select("context", "n_context", "t", ((rest + F.col("t")) / (F.col("n_context") + F.col("t"))).alias("l"))
        )
        retained.write.parquet(f"{folder}/contexts{depth}")
        retained = spark.read.parquet(f"{folder}/contexts{depth}")
        p = F.col("n") / (F.col("n_context") + F.col("t")) + F.col("l") * F.col("q")
        more = F.log10(p) - F.log10("q") - F.log10("l")
        rows.join(retained.drop("n_context"), "context").select(
            "pair", "suffix_pair", "n", own.alias("q_own"), p.alias("q"), more.alias("more")
        ).write.parquet(f"{folder}/pairs{depth}")
        kept = spark.read.parquet(f"{folder}/pairs{depth}")
        upper = kept.select(F.col("pair").alias("suffix_pair"), "q_own", "q")
        candidates = (
            kept.where(F.col("n") >= settings.least_context)
            .join(retained.select(F.col("context").alias("suffix_pair")), "suffix_pair", "left_semi")
            .select(F.col("pair").alias("context"), F.col("n").alias("n_context"))
        )
        # Its bitmap, its test for rows and the next level's join read it.
        candidates.write.parquet(f"{folder}/candidates{depth}")
        candidates = spark.read.parquet(f"{folder}/candidates{depth}")
        contexts.unpersist()
        pairs.unpersist()
    nodes = spark.createDataFrame([], "key long, n long, value double")
    entries = nodes
    for k in range(1, depth + 1):
        nodes = nodes.unionByName(
            spark.read.parquet(f"{folder}/contexts{k}").select(
                F.col("context").alias("key"), F.col("n_context").alias("n"), F.log10("l").alias("value")
            )
        )
        entries = entries.unionByName(
            spark.read.parquet(f"{folder}/pairs{k}").select(
                F.col("pair").alias("key"), "n", F.col("more").alias("value")
            )
        )
    return nodes, entries, depth


def word_counts(docs: DataFrame) -> DataFrame:
    """code (hash of a word, as a signed number), n over all texts."""

    def each(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(words_of(texts, lower=True).hashes.view(np.int64), return_counts=True)

    return _sum_counts(docs, each)


def _head_least(counts: DataFrame, most: int) -> tuple[F.Column, int | None]:
    """A tier of n, and the least tier whose rows, with those of higher ones, are at most that many."""
    tier = F.floor(4 * F.log2(F.col("n").cast("double"))).cast("int")
    tiers = counts.groupBy(tier.alias("tier")).agg(F.count("*").alias("rows")).collect()
    rows, least = 0, None
    for r in sorted(tiers, key=lambda r: -r["tier"]):
        rows += r["rows"]
        if rows > most:
            break
        least = r["tier"]
    return tier, least


def _head(vocabulary: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent words, at most HEAD_WORDS: sorted hashes and their counts."""
    tier, least = _head_least(vocabulary, HEAD_WORDS)
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows = vocabulary.where(tier >= least).toArrow()
    codes, n = rows["code"].to_numpy(), rows["n"].to_numpy()
    order = np.argsort(codes)
    return codes[order], n[order]


class Known:
    """Values of the most frequent keys, and a bitmap of all others."""

    def __init__(self, table: DataFrame, settings: Settings):
        tier, least = _head_least(table, settings.head_keys)
        self.keys, self.values = np.zeros(0, np.uint64), np.zeros(0, np.float32)
        if least is not None:
            rows = table.where(tier >= least).select("key", F.col("value").cast("float")).toArrow()
            keys = rows["key"].to_numpy().view(np.uint64)
            order = np.argsort(keys)
            self.keys, self.values = keys[order], rows["value"].to_numpy()[order]
        others = table if least is None else table.where(tier < least)
        self.others = _bitmap(others, "key", settings.bitmap_bits) if others.limit(1).count() else None
        #: The rows that are not held as arrays; not sent with this object.
        self.rest = others.select("key", F.col("value").cast("float").alias("value"))

    def __getstate__(self) -> dict:
        return {k: v for k, v in vars(self).items() if k != "rest"}

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each key whether it is known, its value (else 0), whether it may be among the others."""
        hit = np.zeros(len(keys), bool)
        value = np.zeros(len(keys))
        if len(self.keys) and len(keys):
            # Keys in order walk through the array in order, which spares the cache.
            order = np.argsort(keys)
            ordered = keys[order]
            at = np.searchsorted(self.keys, ordered)
            at[at == len(self.keys)] = 0
            same = self.keys[at] == ordered
            hit[order] = same
            value[order] = np.where(same, self.values[at], 0)
        late = np.zeros(len(keys), bool)
        if self.others is not None:
            late = ~hit & self.others.may_hold(keys)
        return hit, value, late


@dataclass
class Tree:
    contexts: Known
    pairs: Known
    depth: int

    def gains(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """log10 P minus the root's of each text, without keys that have to be joined; these keys, and
        the text of each, in order. A context's key is inverted there: it may be a pair's as well."""
        s = symbols_of(texts)
        gain = np.zeros(len(texts))
        at = np.flatnonzero(s.age >= 1)
        shorter = s.codes
        owners, late = [], []
        for depth in range(1, self.depth + 1):
            if depth > 1:
                at = at[s.age[at] >= depth]
                shorter = s.longer(shorter)
            context = shorter[at - 1]
            hit, value, maybe = self.contexts.find(context)
            owners.append(s.owner[at[maybe]])
            late.append(~context[maybe])
            use = hit | maybe
            at, value, context = at[use], value[use], context[use]
            pair = s.codes[at] + BASE * context
            _, own, perhaps = self.pairs.find(pair)
            gain += np.bincount(s.owner[at], value + own, minlength=len(texts))
            owners.append(s.owner[at[perhaps]])
            late.append(pair[perhaps])
        owner = np.concatenate([np.zeros(0, np.int64), *owners])
        order = np.argsort(owner, kind="stable")
        return gain, np.concatenate([np.zeros(0, np.uint64), *late])[order], owner[order]


def _late_gains(scored: DataFrame, tree: Tree) -> DataFrame:
    """row, gain by the keys that bitmaps could not settle."""
    inverted = tree.contexts.rest.select(F.bitwise_not("key").alias("key"), "value")
    late = scored.select("row", F.explode("late").alias("key"))
    return (
        late.join(inverted.unionByName(tree.pairs.rest), "key")
        .groupBy("row")
        .agg(F.sum(F.col("value").cast("double")).alias("late_gain"))
    )


def score(
    spark: SparkSession,
    docs: DataFrame,
    folds: int = 7,
    held_out_fold: int = 2,
    settings: Settings | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row.

    A row is held out if crc32 of its id as text, modulo folds, is held_out_fold; all others train.
    A null id counts as the empty text, a null text as empty (only the end). Repeated rows train
    as often as they occur. Without training rows the base is log10(1 / 1) a token and so is the tree's
    score. An empty table gives no rows; other columns are not read.
    """
    settings = settings or Settings()
    folder = work_folder(spark, "suffix-tree")
    source = id_and_text(docs, id_col, text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds
    source = source.withColumn("held_out", fold == held_out_fold)
    training = source.where(~F.col("held_out")).select("text")

    with shuffles_dropped(spark):
        word_counts(training).write.parquet(f"{folder}/words")
        vocabulary = spark.read.parquet(f"{folder}/words")
        sums = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
        ends = training.count()
        tokens, kinds = sums[0] + ends, sums[1] + (ends > 0)
        head_codes, head_n = _head(vocabulary)
        nodes, entries, depth = train(spark, training, vocabulary, ends, settings)
        tree = Tree(Known(nodes, settings), Known(entries, settings), depth)
        model = spark.sparkContext.broadcast((tree, head_codes, head_n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, head, head_n = model.value
        head_logs = np.log10(head_n + 1)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for rows, texts in chunks(batch):
                part = batch.slice(rows.start, len(texts))
                words = words_of(texts, lower=True)
                codes = words.hashes.view(np.int64)
                size = np.diff(words.first)
                owner = np.repeat(np.arange(len(texts)), size)
                at = np.searchsorted(head, codes)
                at[at == len(head)] = 0
                known = head[at] == codes if len(head) else np.zeros(len(codes), bool)
                rare = np.flatnonzero(~known)
                cuts = np.searchsorted(owner[rare], np.arange(len(texts) + 1))
                gains, late, text = tree.gains(texts)
                late_cuts = pa.array(np.searchsorted(text, np.arange(len(texts) + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + len(texts)), pa.int64()),
                        part.column("doc_id"),
                        part.column("held_out"),
                        pa.array(size + 1, pa.int64()),
                        pa.array(np.bincount(owner[known], minlength=len(texts)), pa.int64()),
                        pa.array(np.bincount(owner[known], head_logs[at[known]], minlength=len(texts))),
                        pa.array(gains, pa.float64()),
                        pa.ListArray.from_arrays(
                            pa.array(cuts, pa.int32()), pa.array(codes[rare], pa.int64())
                        ),
                        pa.ListArray.from_arrays(late_cuts, pa.array(late.view(np.int64), pa.int64())),
                    ],
                    names=["row", "doc_id", "held_out", "n_tokens", "n_head", "head_logs", "gain", "rare", "late"],
                )
                row += len(texts)

    map_in_arrow(
        source,
        run,
        f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_head long, head_logs double, "
        "gain double, rare array<long>, late array<long>",
    ).write.parquet(f"{folder}/scored")
    scored = spark.read.parquet(f"{folder}/scored")
    rare = (
        scored.select("row", F.explode("rare").alias("code"))
        .join(vocabulary, "code")
        .groupBy("row")
        .agg(F.count("*").alias("n_rare"), F.sum(F.log10(F.col("n") + 1)).alias("rare_logs"))
    )
    with shuffles_dropped(spark):
        for name, table in (("rare", rare), ("late", _late_gains(scored, tree))):
            table.write.parquet(f"{folder}/{name}")
    rare, late = (spark.read.parquet(f"{folder}/{name}") for name in ("rare", "late"))
    end_log = float(np.log10(ends + 1))
    below = float(np.log10(tokens + kinds + 1))
    base = F.col("head_logs") + F.coalesce("rare_logs", F.lit(0.0)) + end_log - F.col("n_tokens") * below
    return (
        scored.drop("rare", "late")
        .join(rare, "row", "left")
        .join(late, "row", "left")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("n_head") + F.coalesce("n_rare", F.lit(0)) + int(ends > 0)).alias("n_known"),
            F.lit(tokens).cast("long").alias("train_tokens"),
            base.alias("base_score"),
            (base + F.col("gain") + F.coalesce("late_gain", F.lit(0.0))).alias("score"),
        )
    )
