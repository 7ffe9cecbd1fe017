"""Token counts by byte-pair merging with a heap and a linked list.

A text is cut into segments that no merge can reach over: a run of word marks and the characters
up to the next mark. For each segment the adjacent pair of lowest rank is popped from a heap
until no pair is in the vocabulary; its symbols are then the initial symbols minus the merges. No
token ids are made. Characters outside the vocabulary count as their UTF-8 bytes (byte fallback).
Counts of segments are kept in a dictionary of bounded size for each worker.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from wattlake.llm.arrow import id_and_text, map_batches, slices, texts_of
from wattlake.llm.vocabularies import resolve

MARK = "▁"
MEMORY_ENTRIES = 1_500_000
LONGEST_KEPT = 64
_SEGMENT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class MergeCounter:
    """Counts tokens as a sentencepiece BPE model with identity normalisation gives them."""

    def __init__(self, model_path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=resolve(model_path))
        self.rank = {
            model.id_to_piece(i): int(-model.get_score(i))
            for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        }
        self.known: dict[str, int] = {}

    def segment(self, text: str) -> int:
        """Tokens of one segment: initial symbols minus merges."""
        rank = self.rank
        last = len(text) - 1
        count = len(text)
        for c in text:
            if c not in rank:
                count += len(c.encode()) - 1
        if last < 1:
            return count
        symbol: list[str] = list(text)
        following = list(range(1, last + 2))
        before = list(range(-1, last))
        heap = []
        for i in range(last):
            pair = text[i : i + 2]
            if pair in rank:
                heap.append((rank[pair], i, pair))
        heapq.heapify(heap)
        while heap:
            _, left, pair = heapq.heappop(heap)
            right = following[left]
            # Stale: one of the symbols has been merged with another since.
            if right > last or symbol[left] + symbol[right] != pair or not symbol[left]:
                continue
            symbol[left], symbol[right] = pair, ""
            count -= 1
            after = following[left] = following[right]
            if after <= last:
                before[after] = left
                pair_after = pair + symbol[after]
                if pair_after in rank:
                    heapq.heappush(heap, (rank[pair_after], left, pair_after))
            ahead = before[left]
            if ahead >= 0:
                pair_ahead = symbol[ahead] + pair
                if pair_ahead in rank:
                    heapq.heappush(heap, (rank[pair_ahead], ahead, pair_ahead))
        return count

    def text(self, text: str) -> int:
        """Tokens of a whole text, without begin or end; an empty text has none."""
        if not text:
            return 0
        known = self.known
        if "  " in text or MARK in text or text[0] == " ":
            marked = MARK + text.replace(" ", MARK)
            segments = [s[1:] if s[0] == MARK else s for s in _SEGMENT.findall(marked)]
        else:
            segments = text.split(" ")
        total = 0
        for s in segments:
            try:
                total += known[s]
            except KeyError:
                found = self.segment(MARK + s)
                total += found
                if len(s) <= LONGEST_KEPT:
                    if len(known) >= MEMORY_ENTRIES:
                        known.clear()
                    known[s] = found
        return total


_counters: dict[str, MergeCounter] = {}


def counter(model_path: str) -> MergeCounter:
    if model_path not in _counters:
        _counters[model_path] = MergeCounter(model_path)
    return _counters[model_path]


def count_tokens(
    docs: DataFrame,
    model_path: str = "piece_bpe_32k.model",
    limit: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row; a narrow map without any shuffle.

    A null text counts as empty: 0 bytes, 0 tokens. Repeated rows give repeated results, a null id
    stays null, an empty table gives no rows, other columns are not read.
    """

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        count = counter(model_path).text
        for part in slices(batch, 2000):
            texts = texts_of(part)
            tokens = [count(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    source = id_and_text(docs, id_col, text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    return map_batches(
        source, each, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )
