"""Personal data: patterns with checks, and a character model that finds what the patterns miss.

Patterns (email, ip, card, phone) give the base spans: the leftmost matches that do not overlap,
those that fail their check dropped. Where data of one or two kinds stand side by side, a pattern
runs over both and its match is dropped; the model finds them apart. It is a bidirectional LSTM
over classes of characters with a CRF on top, trained here with numpy from labelled spans: the base
spans of a bounded sample of texts, also spliced side by side into other contexts. Texts are
decoded in overlapping windows; spans cut by the edge of a window are left to its neighbour, and
the spans of all windows are reconciled over the whole text. A span of the model is added if it
passes the check of its kind and overlaps no base span of that kind.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm.arrow import id_and_text, map_in_arrow, slices

KINDS = ("email", "ip", "card", "phone")
#: Most documents whose spans train the model, and most snippets of one document.
TRAIN_DOCS = 3000
TRAIN_SNIPPETS = 4
SNIPPET = 128

WINDOW, OVERLAP = 1024, 96
BATCH_CHARS = 1 << 20
HIDDEN = 6
TAGS = len(KINDS) + 1

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_WHOLE = {"email": _EMAIL, "ip": re.compile(r"[0-9]+(?:\.[0-9]+){3}"), "card": _CARD, "phone": _PHONE}

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def passes(kind: str, match: str) -> bool:
    """The check of a match of a kind."""
    if kind == "ip":
        return all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in match.split("."))
    digits = "".join(_DIGIT.findall(match))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) by kind, then start; positions in code points."""
    out: list[Span] = []
    if "@" in text:
        taken = 0
        for m in _DOMAIN.finditer(text):
            start = m.start()
            while start > taken and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                out.append((0, start, m.end()))
                taken = m.end()
    if _DIGIT.search(text):
        for k, pattern in ((1, _IP), (2, _CARD)):
            out += [(k, *m.span()) for m in pattern.finditer(text) if passes(KINDS[k], m[0])]
        if "+" in text:
            out += [(3, *m.span()) for m in _PHONE.finditer(text) if passes("phone", m[0])]
    return out


# Classes of characters: one for each mark that spans are made of, and for digits, small and
# capital letters, line breaks, other ASCII, and all else.
_MARKS = " .-+()@%_,:"
_CLASSES = len(_MARKS) + 6
_CLASS = np.full(129, len(_MARKS) + 4, np.int64)
for _i, _c in enumerate(_MARKS):
    _CLASS[ord(_c)] = _i
_CLASS[ord("0") : ord("9") + 1] = len(_MARKS)
_CLASS[ord("a") : ord("z") + 1] = len(_MARKS) + 1
_CLASS[ord("A") : ord("Z") + 1] = len(_MARKS) + 2
_CLASS[[9, 10, 11, 12, 13]] = len(_MARKS) + 3
_CLASS[128] = len(_MARKS) + 5


def classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return _CLASS[np.minimum(points, 128)].astype(np.int8)


@dataclass
class Model:
    """Weights of both directions (class table and recurrence, gates in the order input, forget,
    output, new), of the tag scores, and of the CRF. A tag other than O follows only itself or O."""

    table: list[np.ndarray]
    recur: list[np.ndarray]
    tag: list[np.ndarray]
    bias: np.ndarray
    trans: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return [*self.table, *self.recur, *self.tag, self.bias, self.trans]


_FORBIDDEN = np.array(
    [[-1e4 if i and j and i != j else 0.0 for j in range(TAGS)] for i in range(TAGS)], np.float32
)


def new_model(seed: int = 7) -> Model:
    rng = np.random.default_rng(seed)

    def draw(*shape: int) -> np.ndarray:
        return rng.normal(0, 0.3, shape).astype(np.float32)

    table = [draw(_CLASSES, 4 * HIDDEN) for _ in range(2)]
    for t in table:
        t[:, HIDDEN : 2 * HIDDEN] += 1
    return Model(
        table,
        [draw(HIDDEN, 4 * HIDDEN) for _ in range(2)],
        [draw(HIDDEN, TAGS) for _ in range(2)],
        np.zeros(TAGS, np.float32),
        _FORBIDDEN.copy(),
    )


# Piecewise linear gates: they cost a tenth of exponentials, and training uses the same ones.
def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.clip(0.25 * x + 0.5, 0, 1)


def _tanh(x: np.ndarray) -> np.ndarray:
    return np.clip(x, -1, 1)


def _inside(x: np.ndarray, low: float) -> np.ndarray:
    """Where a gate is not at its bounds, so that it passes a gradient."""
    return (x > low) & (x < 1)


def _loss_and_gradients(model: Model, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean negative log likelihood of tags y given classes x, both [time, batch]."""
    steps, batch = x.shape
    h_all, kept = [], []
    for d in range(2):
        order = range(steps) if d == 0 else range(steps - 1, -1, -1)
        h, c = np.zeros((batch, HIDDEN), np.float32), np.zeros((batch, HIDDEN), np.float32)
        hs, cache = np.zeros((steps, batch, HIDDEN), np.float32), {}
        for t in order:
            z = model.table[d][x[t]] + h @ model.recur[d]
            gates = _sigmoid(z[:, : 3 * HIDDEN])
            new = _tanh(z[:, 3 * HIDDEN :])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            before, c_before = h, c
            c = f * c + i * new
            tc = _tanh(c)
            h = o * tc
            hs[t] = h
            cache[t] = (before, c_before, i, f, o, new, tc)
        h_all.append(hs)
        kept.append(cache)
    score = h_all[0] @ model.tag[0] + h_all[1] @ model.tag[1] + model.bias
    # CRF: forward and backward sums in logarithms.
    trans = model.trans

    def total(v: np.ndarray, axis: int) -> np.ndarray:
        top = v.max(axis=axis, keepdims=True)
        return np.log(np.exp(v - top).sum(axis=axis)) + np.squeeze(top, axis)

    alpha, beta = np.zeros_like(score), np.zeros_like(score)
    alpha[0] = score[0]
    for t in range(1, steps):
        alpha[t] = total(alpha[t - 1][:, :, None] + trans[None], 1) + score[t]
    for t in range(steps - 2, -1, -1):
        beta[t] = total(trans[None] + (score[t + 1] + beta[t + 1])[:, None, :], 2)
    norm = total(alpha[-1], 1)
    d_score = np.exp(alpha + beta - norm[None, :, None])
    d_trans = np.zeros_like(trans)
    for t in range(1, steps):
        d_trans += np.exp(
            alpha[t - 1][:, :, None] + trans[None] + (score[t] + beta[t])[:, None, :] - norm[:, None, None]
        ).sum(axis=0)
    np.subtract.at(d_trans, (y[:-1].ravel(), y[1:].ravel()), 1)
    tt, bb = np.meshgrid(np.arange(steps), np.arange(batch), indexing="ij")
    gold = score[tt, bb, y].sum() + trans[y[:-1], y[1:]].sum()
    d_score[tt, bb, y] -= 1
    scale = np.float32(1 / batch)
    d_score *= scale
    d_trans = d_trans * scale * (_FORBIDDEN == 0)

    g_table, g_recur, g_tag = [], [], []
    for d in range(2):
        g_tag.append(np.einsum("tbh,tbk->hk", h_all[d], d_score))
        d_h_all = d_score @ model.tag[d].T
        d_table, d_recur = np.zeros_like(model.table[d]), np.zeros_like(model.recur[d])
        d_h, d_c = np.zeros((batch, HIDDEN), np.float32), np.zeros((batch, HIDDEN), np.float32)
        for t in range(steps - 1, -1, -1) if d == 0 else range(steps):
            before, c_before, i, f, o, new, tc = kept[d][t]
            d_h = d_h + d_h_all[t]
            d_c = d_c + d_h * o * _inside(tc, -1)
            d_z = np.concatenate(
                [
                    d_c * new * 0.25 * _inside(i, 0),
                    d_c * c_before * 0.25 * _inside(f, 0),
                    d_h * tc * 0.25 * _inside(o, 0),
                    d_c * i * _inside(new, -1),
                ],
                axis=1,
            )
            np.add.at(d_table, x[t], d_z)
            d_recur += before.T @ d_z
            d_h = d_z @ model.recur[d].T
            d_c = d_c * f
        g_table.append(d_table)
        g_recur.append(d_recur)
    gradients = [*g_table, *g_recur, *g_tag, d_score.sum(axis=(0, 1)), d_trans]
    return float((norm.sum() - gold) / batch), gradients


def train(snippets: list[tuple[str, list[Span]]], rounds: int = 120, batch: int = 64, seed: int = 7) -> Model:
    """A model from texts with their labelled spans; without any span, a model that finds none."""
    rng = np.random.default_rng(seed)
    model = new_model(seed)
    spans = [(k, text[a:b]) for text, own in snippets for k, a, b in own]
    if not spans:
        model.bias[1:] = -1e3
        return model
    by_kind = [[s for k, s in spans if k == kind] for kind in range(len(KINDS))]
    present = [k for k, own in enumerate(by_kind) if own]
    plain = [text for text, own in snippets if not own] or [" "]

    def sample() -> tuple[np.ndarray, np.ndarray]:
        text, own = snippets[rng.integers(len(snippets))]
        if rng.random() < 0.6:
            # One to three spans, each kind alike, side by side in the context of another text.
            rest = plain[rng.integers(len(plain))]
            cut = int(rng.integers(len(rest) + 1))
            text, own = rest[:cut] + " ", []
            for _ in range(rng.integers(1, 4)):
                kind = present[rng.integers(len(present))]
                piece = by_kind[kind][rng.integers(len(by_kind[kind]))]
                own.append((kind, len(text), len(text) + len(piece)))
                text += piece + (" ", " ", ", ", ". ", "\n")[rng.integers(5)]
            text += rest[cut:]
        begin = 0
        if len(text) > SNIPPET:
            middle = own[rng.integers(len(own))][1] if own else int(rng.integers(len(text)))
            begin = int(np.clip(middle - rng.integers(SNIPPET), 0, len(text) - SNIPPET))
        x = np.full(SNIPPET, 0, np.int64)
        y = np.zeros(SNIPPET, np.int64)
        part = classes(text[begin : begin + SNIPPET])
        x[: len(part)] = part
        for k, a, b in own:
            y[max(0, a - begin) : max(0, b - begin)] = k + 1
        return x, y

    arrays = model.arrays()
    first, second = [np.zeros_like(a) for a in arrays], [np.zeros_like(a) for a in arrays]
    for step in range(1, rounds + 1):
        pairs = [sample() for _ in range(batch)]
        x, y = np.stack([p[0] for p in pairs], 1), np.stack([p[1] for p in pairs], 1)
        _, gradients = _loss_and_gradients(model, x, y)
        norm = np.sqrt(sum(float((g * g).sum()) for g in gradients))
        rate = 0.03 * min(1.0, step / 10) * (0.5 if step > rounds * 0.7 else 1.0)
        for a, g, m, v in zip(arrays, gradients, first, second, strict=True):
            g = g * min(1.0, 5.0 / (norm + 1e-9))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            a -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


class Decoder:
    """Tags of windows by Viterbi, many windows at a time.

    Windows come with falling lengths and end together, in the last step; so at each step the
    windows that have begun are the first ones, in both directions.
    """

    def __init__(self, model: Model) -> None:
        # The slope and the middle of the gates are part of the weights.
        slope = np.full(4 * HIDDEN, 0.25, np.float32)
        slope[3 * HIDDEN :] = 1
        middle = np.full(4 * HIDDEN, 0.5, np.float32)
        middle[3 * HIDDEN :] = 0
        self.table = [(t * slope + middle).astype(np.float32) for t in model.table]
        self.recur = [np.ascontiguousarray((r * slope).astype(np.float32).T) for r in model.recur]
        self.tag = [np.ascontiguousarray(t.T) for t in model.tag]
        self.bias, self.trans = model.bias, model.trans

    def _run(self, d: int, x: np.ndarray, begun: list[int], out: np.ndarray) -> None:
        """Add the tag scores of one direction; x is [step, window], out [step, tag, window]."""
        steps, windows = x.shape
        h_all, c_all = np.zeros((2, HIDDEN, windows), np.float32)
        for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
            n = begun[t]
            h, c = h_all[:, :n], c_all[:, :n]
            z = self.recur[d] @ h
            z += np.take(self.table[d], x[t, :n], axis=0).T
            i, f, o, new = (z[k * HIDDEN : (k + 1) * HIDDEN] for k in range(4))
            gates = z[: 3 * HIDDEN]
            np.clip(gates, 0, 1, out=gates)
            np.clip(new, -1, 1, out=new)
            f *= c
            new *= i
            np.add(f, new, out=c)
            np.clip(c, -1, 1, out=h)
            h *= o
            out[t, :, :n] += self.tag[d] @ h

    def tags(self, data: np.ndarray, start: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each step from the last to the first: the step, the windows with a tag other than O
        there, and their tags."""
        steps = int(lengths[0])
        begun = np.searchsorted(-lengths, np.arange(steps) - steps, side="right").tolist()
        shift = start + lengths - steps
        x = data[np.maximum(shift[None, :] + np.arange(steps)[:, None], 0)]
        out = np.zeros((steps, TAGS, len(start)), np.float32)
        out += self.bias[:, None]
        for d in range(2):
            self._run(d, x, begun, out)
        trans = self.trans
        enter, stay = trans[0, 1:, None], np.diag(trans)[1:, None]
        leave, remain = trans[1:, :1], trans[0, 0]
        best = out[0].copy()
        stayed = np.zeros((steps, TAGS - 1, len(start)), bool)
        closed = np.zeros((steps, len(start)), bool)
        closes = np.zeros((steps, TAGS - 1, len(start)), bool)
        for t in range(1, steps):
            n, fresh = begun[t - 1], begun[t]
            outside, inside = best[0, :n], best[1:, :n]
            into, kept, back = outside + enter, inside + stay, inside + leave
            np.greater(kept, into, out=stayed[t, :, :n])
            np.maximum(into, kept, out=inside)
            outside += remain
            top = back[0]
            for k in range(1, TAGS - 1):
                top = np.maximum(top, back[k])
            np.greater(top, outside, out=closed[t, :n])
            np.equal(back, top, out=closes[t, :, :n])
            np.maximum(outside, top, out=outside)
            best[:, :n] += out[t, :, :n]
            best[:, n:fresh] = out[t, :, n:fresh]
        tag = best.argmax(axis=0)
        for t in range(steps - 1, -1, -1):
            now = tag[: begun[t]]
            some = np.flatnonzero(now)
            if len(some):
                yield t, some, now[some]
            if t:
                n = begun[t - 1]
                ended = np.flatnonzero(closed[t, :n])
                ended = ended[now[ended] == 0]
                some = some[: np.searchsorted(some, n)]
                opened = some[~stayed[t, now[some] - 1, some]]
                tag[opened] = 0
                tag[ended] = closes[t][:, ended].argmax(axis=0) + 1

    def spans(self, texts: list[str]) -> list[list[Span]]:
        """Spans of the model in each text, reconciled over all its windows."""
        data = [classes(t) for t in texts]
        begins = np.cumsum([0, *map(len, data)])
        flat = np.concatenate([*data, np.zeros(1, np.int8)])
        step = WINDOW - OVERLAP
        owner, offset = [], []
        for i, own in enumerate(data):
            for a in range(0, max(1, len(own) - OVERLAP), step) if len(own) else ():
                owner.append(i)
                offset.append(a)
        found: list[set[Span]] = [set() for _ in texts]
        if not owner:
            return [[] for _ in texts]
        owner, offset = np.array(owner), np.array(offset)
        size = np.array([len(d) for d in data])
        lengths = np.minimum(WINDOW, size[owner] - offset)
        order = np.argsort(-lengths, kind="stable")
        owner, offset, lengths = owner[order], offset[order], lengths[order]
        hits = list(self.tags(flat, begins[owner] + offset, lengths))
        if not hits:
            return [[] for _ in texts]
        steps = int(lengths[0])
        t = np.concatenate([np.full(len(w), t) for t, w, _ in hits])
        w = np.concatenate([w for _, w, _ in hits])
        k = np.concatenate([k for _, _, k in hits])
        t = t - (steps - lengths[w])
        order = np.lexsort((t, w))
        t, w, k = t[order], w[order], k[order]
        cut = np.flatnonzero((np.diff(w) != 0) | (np.diff(t) != 1) | (np.diff(k) != 0)) + 1
        first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(t)]]) - 1
        for a, b in zip(first, last, strict=True):
            i, window = owner[w[a]], w[a]
            begin, end = int(offset[window] + t[a]), int(offset[window] + t[b] + 1)
            # Cut by an edge inside the text: the neighbour has it whole.
            if (t[a] == 0 and begin > 0) or (t[b] == lengths[window] - 1 and end < size[i]):
                continue
            found[i].add((int(k[a]) - 1, begin, end))
        return [reconcile(f) for f in found]


class _Taken:
    """Stretches of one kind that do not overlap, in order."""

    def __init__(self, stretches: list[tuple[int, int]] = ()) -> None:
        self.starts = sorted(a for a, _ in stretches)
        self.end = dict(stretches)

    def meets(self, a: int, b: int) -> bool:
        i = bisect.bisect_left(self.starts, b) - 1
        return i >= 0 and self.end[self.starts[i]] > a

    def add(self, a: int, b: int) -> None:
        bisect.insort(self.starts, a)
        self.end[a] = b


def reconcile(spans: set[Span]) -> list[Span]:
    """Spans of one kind that overlap: the longest stays, of equal ones the first."""
    kept: list[Span] = []
    taken = [_Taken() for _ in KINDS]
    for k, a, b in sorted(spans, key=lambda s: (s[1] - s[2], s[1], s[0])):
        if not taken[k].meets(a, b):
            taken[k].add(a, b)
            kept.append((k, a, b))
    return sorted(kept)


def added(text: str, base: list[Span], model: list[Span]) -> list[Span]:
    """Spans of the model that pass their check and overlap no base span of their kind."""
    out = []
    taken = [_Taken([(a, b) for x, a, b in base if x == k]) for k in range(len(KINDS))]
    for k, a, b in model:
        while a < b and not (text[a].isalnum() or (k == 3 and text[a] == "+")):
            a += 1
        while a < b and not text[b - 1].isalnum():
            b -= 1
        match = text[a:b]
        if not _WHOLE[KINDS[k]].fullmatch(match) or not passes(KINDS[k], match):
            continue
        if not taken[k].meets(a, b):
            out.append((k, a, b))
    return out


def _snippets(docs: DataFrame, most_docs: int) -> list[tuple[str, list[Span]]]:
    """Texts around the base spans of a sample, and as many without: the documents that may hold
    spans with the smallest hashes of their ids, so any partitioning gives the same sample."""
    chosen = (
        docs.where(F.col("text").rlike("[@+]|[0-9]{2}"))
        .select(F.xxhash64("doc_id").alias("order"), "doc_id")
        .orderBy("order", "doc_id")
        .limit(most_docs)
    )
    rows = docs.join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text in batch.column("text").to_pylist():
                spans = base_spans(text or "")
                for _, a, b in spans[:TRAIN_SNIPPETS]:
                    middle = (a + b) // 2
                    texts.append(text[max(0, middle - SNIPPET) : middle + SNIPPET])
                texts.append((text or "")[: 2 * SNIPPET])
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["snippet"])

    found = map_in_arrow(rows.select("text"), run, "snippet string").collect()
    texts = sorted({r.snippet for r in found if r.snippet})
    return [(t, base_spans(t)) for t in texts]


def trained(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_docs: int = TRAIN_DOCS) -> Model:
    return train(_snippets(id_and_text(docs, id_col, text_col), most_docs))


def find(
    spark: SparkSession,
    docs: DataFrame,
    model: Model | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    masked: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, base and spans for each row: arrays of (kind, start, end) in code points, end
    exclusive, by kind and start; base without, spans with those of the model. A model that is not
    given is trained from at most TRAIN_DOCS documents.

    ``masked`` names columns of docs to return as well, the text with every span replaced by the
    kind in angle brackets (and n_chars, if named, as the length of that text). A null text has no
    spans and stays null. Repeated rows give repeated results; an empty table gives no rows.
    """
    model = model or trained(docs, id_col, text_col)
    weights = spark.sparkContext.broadcast(model)
    source = docs if masked else id_and_text(docs, id_col, text_col)
    key, text_name = (id_col, text_col) if masked else ("doc_id", "text")
    fields = {f.name: f.dataType.simpleString() for f in source.schema.fields}
    spans_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    spans_sql = "array<struct<kind:string,start:long,end:long>>"
    if masked:
        schema = ", ".join(f"`{c}` {fields[c]}" for c in masked)
    else:
        schema = f"doc_id {fields[key]}, base {spans_sql}, spans {spans_sql}"

    def as_arrow(found: list[list[Span]]) -> pa.Array:
        return pa.array(
            [[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in own] for own in found], spans_type
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(weights.value)
        for batch in batches:
            for part in _by_size(batch, text_name):
                given = part.column(text_name).to_pylist()
                texts = [t or "" for t in given]
                base = [base_spans(t) for t in texts]
                model_spans = decoder.spans(texts)
                every = [
                    sorted([*b, *added(t, b, m)])
                    for t, b, m in zip(texts, base, model_spans, strict=True)
                ]
                if not masked:
                    yield pa.RecordBatch.from_arrays(
                        [part.column(key), as_arrow(base), as_arrow(every)], names=["doc_id", "base", "spans"]
                    )
                    continue
                new = [None if g is None else mask(g, s) for g, s in zip(given, every, strict=True)]
                columns = []
                for c in masked:
                    column = part.column(c)
                    if c == text_name:
                        column = pa.array(new, column.type)
                    elif c == "n_chars":
                        old = column.to_pylist()
                        column = pa.array(
                            [o if t is None or not s else len(t) for o, t, s in zip(old, new, every, strict=True)],
                            column.type,
                        )
                    columns.append(column)
                yield pa.RecordBatch.from_arrays(columns, names=list(masked))

    return map_in_arrow(source, run, schema)


def mask(text: str, spans: list[Span]) -> str:
    """The text with each stretch of overlapping spans replaced by the kind of its first."""
    out, at = [], 0
    stretches: list[list[int]] = []
    for k, a, b in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if stretches and a < stretches[-1][2]:
            stretches[-1][2] = max(b, stretches[-1][2])
        else:
            stretches.append([k, a, b])
    for k, a, b in stretches:
        out += [text[at:a], f"<{KINDS[k]}>"]
        at = b
    return "".join([*out, text[at:]])


def _by_size(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of at most BATCH_CHARS bytes of text, or one row."""
    for part in slices(batch, 4096):
        sizes = [len(t or "") for t in part.column(column).to_pylist()]
        begin = total = 0
        for i, n in enumerate(sizes):
            if total and total + n > BATCH_CHARS:
                yield part.slice(begin, i - begin)
                begin, total = i, 0
            total += n
        yield part.slice(begin)

