"""Periodic runs of the words of a text, by suffix trees and Lyndon roots.

A run is a maximal stretch of words with a smallest period q. By the runs theorem every run holds
a Lyndon root: a word of length q that is, in the order of symbols or in its reverse, the longest
Lyndon word that starts at its place. So the longest Lyndon words of both orders, two a place, are
all candidates there are. Each is extended to the right by the longest common extension of two
suffixes and to the left by that of two prefixes. Both are the depth of a lowest common ancestor,
in Ukkonen's suffix tree of the words and in that of the reversed words, read in constant time as
a range minimum over the Euler tour.

A word of a run of at least four periods occurs four times in it. Hence a text falls apart at the
words that are rarer, exactly and before any tree is built; most prose leaves nothing.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.arrow import id_and_text, map_in_arrow
from wattlake.llm.text import chunks

#: Rounds in which stretches are cut at rare words; more would only save time in the trees.
CUTS = 4


class SuffixTree:
    """Ukkonen's suffix tree of symbols 0..n-1, closed by a symbol that is smaller than all.

    rank: the place of each suffix among all in their order; reverse_rank: the same with the order
    of symbols reversed (the end stays smallest). lce(i, j): length of the longest common prefix
    of the suffixes at i and j, for whole arrays.
    """

    def __init__(self, symbols: list[int], ranks: bool = True):
        text = [s + 1 for s in symbols]
        text.append(0)
        self._size = len(text)
        start, length, child = self._build(text)
        self._tour(text, start, length, child, ranks)

    @staticmethod
    def _build(text: list[int]) -> tuple[array, array, dict[int, int]]:
        """Edges as (first symbol's place, length) of each node; children by node and symbol."""
        n, base = len(text), max(text) + 1
        # Node 0 is the root. A leaf's edge has no end until the text is known.
        start, length, link = array("l", [0]), array("l", [0]), array("l", [0])
        child: dict[int, int] = {}
        node = edge = matched = pending = 0
        get = child.get
        for i in range(n):
            symbol = text[i]
            pending += 1
            last = 0
            while pending:
                if not matched:
                    edge = i
                key = node * base + text[edge]
                below = get(key)
                if below is None:
                    child[key] = len(start)
                    start.append(i)
                    length.append(n)
                    link.append(0)
                    if last:
                        link[last] = node
                        last = 0
                else:
                    span = min(length[below], i + 1 - start[below])
                    if matched >= span:
                        edge += span
                        matched -= span
                        node = below
                        continue
                    at = start[below]
                    if text[at + matched] == symbol:
                        if last and node:
                            link[last] = node
                        matched += 1
                        break
                    middle = len(start)
                    start.append(at)
                    length.append(matched)
                    link.append(0)
                    child[key] = middle
                    child[middle * base + symbol] = middle + 1
                    start.append(i)
                    length.append(n)
                    link.append(0)
                    start[below] = at + matched
                    if length[below] != n:
                        length[below] -= matched
                    child[middle * base + text[at + matched]] = below
                    if last:
                        link[last] = middle
                    last = middle
                pending -= 1
                if not node and matched:
                    matched -= 1
                    edge = i - pending + 1
                elif node:
                    node = link[node]
        return start, length, child

    def _tour(self, text: list[int], start: array, length: array, child: dict[int, int], ranks: bool) -> None:
        n, base, nodes = len(text), max(text) + 1, len(start)
        keys = np.fromiter(child.keys(), np.int64, len(child))
        to = np.fromiter(child.values(), np.int64, len(child))
        child.clear()
        order = np.argsort(keys)
        keys, to = keys[order], to[order]
        parent = keys // base
        first = np.searchsorted(parent, np.arange(nodes + 1))
        begin, below, lengths = first.tolist(), to.tolist(), list(length)
        # Nodes in the order of the Euler tour's first visits, with the depth of their parent: the
        # least of these between two nodes is the depth of their lowest common ancestor.
        place = np.zeros(n, np.int64)
        above = array("l")
        stack, suffixes = [(0, 0, 0)], []
        while stack:
            node, depth, over = stack.pop()
            above.append(over)
            begins, ends = begin[node], begin[node + 1]
            if begins == ends:
                suffix = start[node] - over
                place[suffix] = len(above) - 1
                suffixes.append(suffix)
                continue
            for below_node in below[begins:ends][::-1]:
                stack.append((below_node, depth + min(lengths[below_node], n), depth))
        if ranks:
            self.rank = np.empty(n, np.int64)
            self.rank[suffixes] = np.arange(n)
            self.reverse_rank = self._reversed(text, start, keys % base, begin, below, lengths, n)
        self._place = place
        # Range minima of all powers of two.
        level = np.frombuffer(above, np.int64).astype(np.int32)
        self._least = [level]
        width = 1
        while len(level) > width:
            level = np.minimum(level[:-width], level[width:])
            self._least.append(level)
            width *= 2

    @staticmethod
    def _reversed(text, start, symbol, begin, below, lengths, n: int) -> np.ndarray:
        """Ranks of the suffixes with symbols from large to small and the end before all."""
        out = np.empty(n, np.int64)
        stack, seen = [(0, 0)], 0
        ends_here = (symbol == 0).tolist()
        while stack:
            node, depth = stack.pop()
            a, b = begin[node], begin[node + 1]
            if a == b:
                out[start[node] - depth] = seen
                seen += 1
                continue
            depth += min(lengths[node], n)
            # The stack gives its last first: the end (if any, it is the first child), then from
            # the largest symbol down.
            own = below[a:b]
            if ends_here[a]:
                own = own[1:] + own[:1]
            stack.extend((x, depth) for x in own)
        return out

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Longest common extensions of the suffixes at i and j, which differ."""
        a, b = self._place[i], self._place[j]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.log2(high - low).astype(np.int64)
        out = np.empty(len(a), np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            least = self._least[k]
            out[at] = np.minimum(least[low[at]], least[high[at] - (1 << int(k))])
        return out


def _longest_lyndon(rank: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word from each place: up to the next smaller suffix."""
    ranks = rank.tolist()
    n = len(ranks)
    out, stack = [0] * n, []
    for i in range(n - 1, -1, -1):
        mine = ranks[i]
        while stack and ranks[stack[-1]] > mine:
            stack.pop()
        out[i] = (stack[-1] if stack else n) - i
        stack.append(i)
    return np.array(out)


def runs_of(symbols: list[int], least: int = 6, periods: int = 4) -> np.ndarray:
    """(start, length, period) of every run of at least that many words and periods, in order."""
    n = len(symbols)
    if n < least:
        return np.empty((0, 3), np.int64)
    tree = SuffixTree(symbols)
    root = np.concatenate([_longest_lyndon(tree.rank[:n]), _longest_lyndon(tree.reverse_rank[:n])])
    at = np.tile(np.arange(n), 2)
    # A root that ends the text has nothing to its right.
    inner = np.flatnonzero(at + root < n)
    end = at + root
    end[inner] += tree.lce(at[inner], (at + root)[inner])
    del tree
    back = SuffixTree(symbols[::-1], ranks=False)
    begin = at.copy()
    # The prefix that ends before place p is the suffix of the reversed text at n - p.
    inner = np.flatnonzero(at > 0)
    begin[inner] -= back.lce(n - at[inner], n - (at + root)[inner])
    length = end - begin
    good = (length >= periods * root) & (length >= least)
    return np.unique(np.stack([begin, length, root], axis=1)[good], axis=0)


def _stretches(words: list, least: int, periods: int) -> Iterator[tuple[int, int]]:
    """(begin, end) of stretches outside of which no word is in a run."""
    often = {w for w, c in Counter(words).items() if c >= periods}
    if not often:
        return
    rough = np.fromiter(map(often.__contains__, words), bool, len(words))
    for begin, end in _spans(rough, least):
        todo = [(begin, end, 1)]
        while todo:
            begin, end, cut = todo.pop()
            part = words[begin:end]
            counts = Counter(part)
            if min(counts.values()) >= periods or cut == CUTS:
                yield begin, end
                continue
            keep = np.fromiter((counts[w] >= periods for w in part), bool, len(part))
            todo += [(begin + a, begin + b, cut + 1) for a, b in _spans(keep, least)]


def _spans(flags: np.ndarray, least: int) -> list[tuple[int, int]]:
    edge = np.diff(np.concatenate([[0], flags.view(np.int8), [0]]))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = end - begin >= least
    return list(zip(begin[long].tolist(), end[long].tolist()))


def runs_of_words(words: list, least: int = 6, periods: int = 4) -> np.ndarray:
    """(start, length, period) of the runs of a list of words, by start, then period."""
    found = []
    for begin, end in _stretches(words, least, periods):
        part = words[begin:end]
        number = {w: i for i, w in enumerate(sorted(set(part)))}
        own = runs_of([number[w] for w in part], least, periods)
        own[:, 0] += begin
        found.append(own)
    if not found:
        return np.empty((0, 3), np.int64)
    out = np.concatenate(found)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def find_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = 6,
    periods: int = 4,
    prepare: Callable[[object, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period in words) and collapsed, for each row.

    Words are maximal runs of characters other than ASCII white space, compared as they stand.
    runs holds every run of at least ``least`` words and ``periods`` periods (four or more), by
    start, then period. collapsed is the text without the words that a run holds after its first
    period, joined by one space. prepare(id, words) may change the words of a text beforehand.

    A null, empty or blank text has no words, no runs and an empty collapsed text. Each row is
    judged by itself, so repeated rows, ties and null ids give a row each; an empty table gives
    none; other columns are not read. A text is worked on whole, in memory that is proportional to
    its longest stretch of words that recur: about 600 bytes a word.
    """
    if periods < 2 or least < 2:
        raise ValueError("a run has two periods at least")
    source = id_and_text(docs, id_col, text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in chunks(batch):
                ids = batch.column("doc_id").slice(rows.start, len(texts))
                n_words, found, collapsed = [], [], []
                for name, text in zip(ids.to_pylist(), texts):
                    words = text.split()
                    if prepare:
                        words = prepare(name, words)
                    runs = runs_of_words(words, least, periods)
                    keep = words
                    if len(runs):
                        # Runs cover [start + period, start + length): edges, then a running sum.
                        edge = np.zeros(len(words) + 1, np.int64)
                        np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
                        np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
                        keep = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
                    n_words.append(len(words))
                    found.append(runs)
                    collapsed.append(b" ".join(keep))
                cuts = np.zeros(len(found) + 1, np.int32)
                np.cumsum([len(r) for r in found], out=cuts[1:])
                flat = np.concatenate(found)
                structs = pa.StructArray.from_arrays(
                    [pa.array(np.ascontiguousarray(flat[:, i])) for i in range(3)], fields=list(run_type)
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(n_words, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(cuts), structs),
                        pa.array(collapsed, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    return map_in_arrow(
        source,
        task,
        f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, "
        "collapsed string",
    )


def digest(found: DataFrame) -> DataFrame:
    """Figures and hashes of find_runs: the longest run (least start, then period, of equal ones)."""
    best = F.array_min(
        F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")))
    )
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.less")).alias("length"),
        F.col("best.period").alias("period"),
        F.floor(-1000 * F.col("best.less") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(
            F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), ""), 256
        ).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
