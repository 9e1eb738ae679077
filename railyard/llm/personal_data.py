"""Personal data by a character-level bidirectional LSTM with CRF transitions.

Four kinds: e-mail addresses, IPv4 addresses, payment-card numbers and
telephone numbers.  ``base_spans`` finds those that fixed patterns describe.
They also label the training examples: windows of a bounded sample of documents,
where some base spans are rewritten with new digits or in forms the patterns
miss ("name (at) host dot com", a telephone number without its plus).  The
network reads characters both ways (gates min(1, max(0, z + 1/2)), activations
z / (1 + |z|)); a linear chain over begin / inside / outside tags, trained by its
exact likelihood, ties the tags together.  Training and decoding are NumPy.

``find`` runs the network over every character of every text, in windows that
overlap.  Windows where the all-outside path is provably best need no decoding;
the others are decoded by Viterbi.  Per document, pieces of one span that a
window's edge cuts are joined, overlapping candidates of different windows
compete for the largest total score (log odds against outside), and a candidate
is kept when its score reaches ``ODDS``, an exact check of its kind holds
(``plausible``) and it meets no base span.  Base spans always stay.

Defined cases: null and empty texts have no spans; rows with equal ids, null
ids and repeated rows are handled row by row; other columns are ignored; an empty
table gives an empty result; a kind without an example in the sample is not
learned (its base spans remain).  Offsets are code points, ends exclusive.
Examples are drawn from distinct texts, by their hash.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.llm.staging import reach

KINDS = ("email", "ip", "card", "phone")
PATTERNS = (re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
            re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)"),
            re.compile(r"[0-9](?:[\x20-]?[0-9])+"),
            re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"))

#: Bounds of the training sample: documents with marks of personal data, documents of any kind, windows of each.
MARKED_DOCS, PLAIN_DOCS, WINDOWS_PER_DOC = 1000, 700, 5
#: Texts that may hold a base span; the sample draws MARKED_DOCS from these.
MARK = r"[0-9]@|@[A-Za-z0-9-]+\.|\+[0-9]|[0-9]\.[0-9]+\.[0-9]|[0-9]{4}[ -]?[0-9]{4}"
#: Characters of a training window, of a window of ``find`` and of its overlap with the next.
LEARN_CHARS, WINDOW, OVERLAP = 96, 512, 64
HIDDEN, EPOCHS, BATCH, STEP = 8, 16, 160, 0.03
#: Least log odds of an added span.
ODDS = 4.0
#: Characters and windows handled at once.
CHUNK_CHARS, TOGETHER = 1 << 21, 1024

TAGS = 1 + 2 * len(KINDS)  # 0 outside, 1 + 2k begins kind k, 2 + 2k goes on


# --- patterns and exact checks ------------------------------------------------------
def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plausible(kind: int, text: str) -> bool:
    """Exact check of a span: as for base spans on its digits; an e-mail address
    has a name, a sign or word for @ and a domain with a point."""
    digits = "".join(c for c in text if "0" <= c <= "9")
    if kind == 0:
        m = re.fullmatch(r"(.*[^\W_].*?)\s*(?:@|[\[({<]\s*at\s*[\])}>]|\bat\b)\s*(.+)", text, re.I | re.S)
        return bool(m and re.search(r"[^\W_]\s*(?:\.|[\[({<]\s*dot\s*[\])}>]|\bdot\b)\s*[^\W_]", m[2], re.I))
    if kind == 1:
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and all(int(p) <= 255 for p in parts) and not re.search(r"[^\W\d_]", text)
    if re.search(r"[^\W\d_]", text):
        return False
    return 14 <= len(digits) <= 19 and luhn(digits) if kind == 2 else 10 <= len(digits) <= 15


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the pattern matches that hold, in order."""
    out = []
    for kind, (pattern, need) in enumerate(zip(PATTERNS, ("@", ".", "", "+"))):
        if need in text:
            for m in pattern.finditer(text):
                s = m[0]
                if kind == 1 and any(int(p) > 255 for p in s.split(".")):
                    continue
                if kind > 1 and not plausible(kind, s):
                    continue
                out.append((m.start(), kind, m.end()))
    return sorted(out)


# --- characters ---------------------------------------------------------------------
#: 0 padding, 1 a digit, 2 to 27 letters without case, 28 white space, 29 letters beyond
#: ASCII and whatever else there is, 30 and on the signs of ASCII.
def _classes() -> np.ndarray:
    out = np.full(128, 29, np.uint8)
    out[48:58] = 1
    out[97:123] = out[65:91] = np.arange(2, 28)
    out[[9, 10, 11, 12, 13, 32]] = 28
    signs = [c for c in range(33, 127) if not chr(c).isalnum()]
    out[signs] = 30 + np.arange(len(signs))
    return out


_CLASS = _classes()
CLASSES = int(_CLASS.max()) + 1


def classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 128, _CLASS[np.minimum(points, 127)], 29).astype(np.uint8)


# --- network ------------------------------------------------------------------------
class Model(NamedTuple):
    """Input columns (direction, gates, class), recurrence (direction, gates, hidden),
    tag weights (tag, both hidden), tag bias, transitions (from, to)."""
    inputs: np.ndarray
    recurrent: np.ndarray
    tags: np.ndarray
    bias: np.ndarray
    moves: np.ndarray


#: Tags that may follow each other: a kind goes on only after it began.
ALLOWED = np.array([[b % 2 == 1 or b == 0 or (b == a and a > 0) or (a % 2 == 1 and b == a + 1) for b in range(TAGS)]
                    for a in range(TAGS)])


def _start(seed: int, hidden: int) -> Model:
    rnd = np.random.default_rng(seed)
    inputs = rnd.normal(0, 0.3, (2, 4 * hidden, CLASSES)).astype(np.float32)
    inputs[:, hidden:2 * hidden] += 0.3  # remember at first
    return Model(inputs, rnd.normal(0, 0.25, (2, 4 * hidden, hidden)).astype(np.float32),
                 rnd.normal(0, 0.3, (TAGS, 2 * hidden)).astype(np.float32), np.zeros(TAGS, np.float32),
                 np.zeros((TAGS, TAGS), np.float32))


def emissions(model: Model, chars: np.ndarray) -> np.ndarray:
    """Tag scores (time, tag, window) of ``chars`` (time, window)."""
    steps, n = chars.shape
    hidden = model.recurrent.shape[2]
    inputs = model.inputs.copy()
    inputs[:, :3 * hidden] += 0.5
    index = chars.astype(np.intp)
    h, c, a = (np.zeros((2, hidden, n), np.float32) for _ in range(3))
    z, u = np.empty((2, 4 * hidden, n), np.float32), np.empty((2, 4 * hidden, n), np.float32)
    gates, new = z[:, :3 * hidden], z[:, 3 * hidden:]
    remember, forget, give = (z[:, k * hidden:(k + 1) * hidden] for k in range(3))
    zero, one = np.zeros(gates.shape, np.float32), np.ones(gates.shape, np.float32)
    one_c = np.ones_like(c)
    out = np.empty((steps, 2 * hidden, n), np.float32)
    for t in range(steps):
        for d, now in ((0, t), (1, steps - 1 - t)):
            np.take(inputs[d], index[now], axis=1, out=z[d], mode="clip")
            np.dot(model.recurrent[d], h[d], out=u[d])
        np.add(z, u, out=z)
        np.maximum(gates, zero, out=gates)
        np.minimum(gates, one, out=gates)
        np.abs(new, out=a)
        np.add(a, one_c, out=a)
        np.divide(new, a, out=new)
        np.multiply(c, forget, out=c)
        np.multiply(new, remember, out=new)
        np.add(c, new, out=c)
        np.abs(c, out=a)
        np.add(a, one_c, out=a)
        np.divide(c, a, out=h)
        np.multiply(h, give, out=h)
        out[t, :hidden], out[steps - 1 - t, hidden:] = h
    score = np.empty((steps, TAGS, n), np.float32)
    for t in range(steps):
        np.dot(model.tags, out[t], out=score[t])
    score += model.bias[:, None]
    return score


def _learn(model: Model, chars: np.ndarray, gold: np.ndarray) -> tuple[float, Model]:
    """Mean negative log likelihood of ``gold`` tags (time, window) and its gradient."""
    steps, n = chars.shape
    hidden = model.recurrent.shape[2]
    seq = np.stack([chars, chars[::-1]])  # of each direction
    given = np.stack([np.take(model.inputs[d], seq[d], axis=1) for d in (0, 1)])
    keep = []
    h, c = np.zeros((2, hidden, n), np.float32), np.zeros((2, hidden, n), np.float32)
    both = np.empty((steps, 2 * hidden, n), np.float32)
    for t in range(steps):
        z = given[:, :, t] + model.recurrent @ h
        raw = z[:, :3 * hidden] + 0.5
        gate = np.clip(raw, 0, 1)
        wide = 1 + np.abs(z[:, 3 * hidden:])
        new = z[:, 3 * hidden:] / wide
        i, f, o = gate[:, :hidden], gate[:, hidden:2 * hidden], gate[:, 2 * hidden:]
        before, c = c, f * c + i * new
        wide_c = 1 + np.abs(c)
        keep.append((h, before, gate, (raw > -0.05) & (raw < 1.05), new, wide, c, wide_c))
        h = o * (c / wide_c)
        both[t, :hidden], both[steps - 1 - t, hidden:] = h[0], h[1]
    score = np.matmul(model.tags, both) + model.bias[:, None]
    # forward and backward sums over all paths, scaled step by step
    move = np.where(ALLOWED, np.exp(model.moves), 0).astype(np.float32)
    top = score.max(1, keepdims=True)
    e = np.exp(score - top)
    alpha, beta, scale = np.empty_like(e), np.empty_like(e), np.empty((steps, 1, n), np.float32)
    for t in range(steps):
        a = e[t] if t == 0 else (move.T @ alpha[t - 1]) * e[t]
        scale[t] = a.sum(0, keepdims=True)
        alpha[t] = a / scale[t]
    beta[-1] = 1
    for t in range(steps - 2, -1, -1):
        beta[t] = move @ (e[t + 1] * beta[t + 1]) / scale[t + 1]
    log_z = float((np.log(scale) + top).sum())
    cols = np.arange(n)
    row = np.arange(steps)[:, None]
    right = float(score[row, gold, cols].sum() + model.moves[gold[:-1], gold[1:]].sum())
    d_score = alpha * beta
    d_score[row, gold, cols] -= 1
    after = e[1:] * beta[1:] / scale[1:]
    d_move = move * np.einsum("tan,tbn->ab", alpha[:-1], after, optimize=True)
    np.add.at(d_move, (gold[:-1], gold[1:]), -1)
    d_tags = np.einsum("tan,thn->ah", d_score, both, optimize=True)
    d_both = np.matmul(model.tags.T, d_score)
    d_in, d_re = np.zeros_like(model.inputs), np.zeros_like(model.recurrent)
    dh, dc = np.zeros((2, hidden, n), np.float32), np.zeros((2, hidden, n), np.float32)
    dzs = np.empty((2, 4 * hidden, steps, n), np.float32)
    for t in range(steps - 1, -1, -1):
        prev, before, gate, open_, new, wide, c, wide_c = keep[t]
        dh = dh + np.stack([d_both[t, :hidden], d_both[steps - 1 - t, hidden:]])
        i, f, o = gate[:, :hidden], gate[:, hidden:2 * hidden], gate[:, 2 * hidden:]
        dc = dc + dh * o / wide_c ** 2
        dz = np.concatenate([dc * new, dc * before, dh * (c / wide_c)], 1) * open_
        dz = np.concatenate([dz, dc * i / wide ** 2], 1)
        d_re += np.matmul(dz, prev.transpose(0, 2, 1))
        dzs[:, :, t] = dz
        dh, dc = np.matmul(model.recurrent.transpose(0, 2, 1), dz), dc * f
    for d in (0, 1):
        one = np.zeros((steps * n, CLASSES), np.float32)
        one[np.arange(steps * n), seq[d].ravel()] = 1
        d_in[d] = dzs[d].reshape(4 * hidden, -1) @ one
    return (log_z - right) / n, Model(d_in / n, d_re / n, d_tags / n, d_score.sum((0, 2)) / n, d_move / n)


def train(windows: list[tuple[str, list]], hidden: int = HIDDEN, epochs: int = EPOCHS, seed: int = 7) -> Model:
    """Model of labelled windows (text, [(start, kind, end)]), by Adam on mini-batches."""
    model = _start(seed, hidden)
    if not windows:
        return model._replace(bias=np.array([0.0] + [-30.0] * (TAGS - 1), np.float32))
    steps = max(len(t) for t, _ in windows)
    chars, gold = np.zeros((steps, len(windows)), np.uint8), np.zeros((steps, len(windows)), np.int64)
    for w, (text, spans) in enumerate(windows):
        chars[:len(text), w] = classes(text)
        for s, kind, e in spans:
            gold[s:e, w] = 2 + 2 * kind
            gold[s, w] = 1 + 2 * kind
    rnd = np.random.default_rng(seed)
    first, second, turn = [np.zeros_like(x) for x in model], [np.zeros_like(x) for x in model], 0
    for epoch in range(epochs):
        order = rnd.permutation(len(windows))
        rate = STEP * (1 - epoch / epochs) + 0.001
        for at in range(0, len(order), BATCH):
            pick = order[at:at + BATCH]
            _, grad = _learn(model, chars[:, pick], gold[:, pick])
            turn += 1
            size = np.sqrt(sum(float((g ** 2).sum()) for g in grad))
            cut = min(1.0, 5.0 / max(size, 1e-9))
            new = []
            for x, g, m, v in zip(model, grad, first, second):
                g = g * cut
                m *= 0.9
                m += 0.1 * g
                v *= 0.99
                v += 0.01 * g * g
                new.append((x - rate * (m / (1 - 0.9 ** turn)) / (np.sqrt(v / (1 - 0.99 ** turn)) + 1e-6))
                           .astype(np.float32))
            model = Model(*new)
    return model


# --- decoding -----------------------------------------------------------------------
def best_paths(model: Model, score: np.ndarray) -> np.ndarray:
    """Best tags (time, window) by Viterbi."""
    steps, _, n = score.shape
    move = np.where(ALLOWED, model.moves, -1e6).astype(np.float32)
    back = np.empty((steps, TAGS, n), np.uint8)
    total = score[0]
    for t in range(1, steps):
        ways = total[:, None, :] + move[:, :, None]
        back[t] = ways.argmax(0)
        total = ways.max(0) + score[t]
    tags = np.empty((steps, n), np.int64)
    tags[-1] = total.argmax(0)
    cols = np.arange(n)
    for t in range(steps - 1, 0, -1):
        tags[t - 1] = back[t, tags[t], cols]
    return tags


def undecided(model: Model, score: np.ndarray) -> np.ndarray:
    """Windows where some path may beat the all-outside one, by an exact bound:
    what the best single span of each kind can gain, entered by its best move."""
    gain = np.where(ALLOWED, model.moves - model.moves[0, 0], -np.inf)
    begin, go = np.arange(1, TAGS, 2), np.arange(2, TAGS, 2)
    into = np.maximum(gain[:, begin].max(0), 0)[:, None].astype(np.float32)
    on = np.maximum(gain[begin, go], gain[go, go])[:, None].astype(np.float32)
    out = np.maximum(np.maximum(gain[begin, 0], gain[go, 0]), 0)[:, None].astype(np.float32)
    odds = score[:, 1:] - score[:, :1]
    start, more = odds[:, 0::2] + into, odds[:, 1::2] + on
    span = np.maximum(start[0], odds[0, 1::2])  # a window may begin inside a span
    best = span.copy()
    for t in range(1, len(score)):
        np.add(span, more[t], out=span)
        np.maximum(span, start[t], out=span)
        np.maximum(best, span, out=best)
    return np.flatnonzero((best + out).max(0) > 0)


def window_spans(model: Model, chars: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, int, int, int, float]]:
    """(window, start, kind, end, log odds) of all spans of the best paths; ``chars`` (time, window)."""
    score = emissions(model, chars)
    for w, n in enumerate(lengths):
        score[n:, 0, w], score[n:, 1:, w] = 0, -1e4
    look = undecided(model, score)
    if not len(look):
        return
    score = score[:, :, look]
    tags = best_paths(model, score)
    for j in range(len(look)):
        path = tags[:, j]
        begins = np.flatnonzero((path > 0) & ((path % 2 == 1) | (np.append(0, path[:-1]) == 0)))
        for s in begins.tolist():
            e, kind = s + 1, (int(path[s]) - 1) // 2
            while e < len(path) and path[e] == 2 + 2 * kind:
                e += 1
            inside = np.arange(s, e)
            odds = float((score[inside, path[inside], j] - score[inside, 0, j]).sum())
            before = np.append(0, path)[s:e + 1]  # the moves along the span and out of it
            after = np.append(path, 0)[s:e + 1]
            odds += float((model.moves[before, after] - model.moves[0, 0]).sum()) if s else \
                float((model.moves[before[1:], after[1:]] - model.moves[0, 0]).sum())
            yield int(look[j]), s, kind, e, odds


def reconcile(found: list[tuple[int, int, int, float, bool, bool]]) -> list[tuple[int, int, int]]:
    """Candidates (start, kind, end, odds, cut on the left, cut on the right) of
    all windows of a document to spans that do not overlap: cut pieces that meet
    are joined, then the choice of largest total odds is taken."""
    joined: list[list] = []
    for s, kind, e, odds, left, right in sorted(found):
        last = joined[-1] if joined else None
        if last and last[1] == kind and s <= last[2] and (last[5] or left):
            if e > last[2]:
                last[2], last[3], last[5] = e, last[3] + odds * (e - max(s, last[2])) / (e - s), right
        else:
            joined.append([s, kind, e, odds, left, right])
    spans = sorted(((e, s, kind, odds) for s, kind, e, odds, _, _ in joined if odds > 0))
    ends = [x[0] for x in spans]
    best, take = [0.0], []
    for i, (e, s, kind, odds) in enumerate(spans):
        before = bisect_right(ends, s, 0, i)
        take.append(best[before] + odds > best[i])
        best.append(max(best[i], best[before] + odds))
    out, i = [], len(spans)
    while i:
        i -= 1
        e, s, kind, odds = spans[i]
        if take[i]:
            if odds >= ODDS:
                out.append((s, kind, e))
            i = bisect_right(ends, s, 0, i)
    return out[::-1]


def _trim(text: str, s: int, e: int) -> tuple[int, int]:
    """Without white space and closing marks at the edges."""
    while s < e and text[s] in " \t\r\n,;:":
        s += 1
    while s < e and text[e - 1] in " \t\r\n.,;:":
        e -= 1
    return s, e


def added_spans(text: str, base: list, found: list) -> list[tuple[int, int, int]]:
    """Spans of the network that hold and meet no base span."""
    out = []
    for s, kind, e in reconcile(found):
        s, e = _trim(text, s, e)
        if s < e and plausible(kind, text[s:e]) and all(e <= b or s >= end for b, _, end in base):
            out.append((s, kind, e))
    return out


def spans_of(texts: list[str], model: Model) -> list[list[tuple[int, int, int, bool]]]:
    """(start, kind, end, base) of each text."""
    rows, starts, lengths, parts = [], [], [], []
    for r, text in enumerate(texts):
        parts.append(classes(text))
        for s in range(0, max(1, len(text) - OVERLAP), WINDOW - OVERLAP):
            rows.append(r)
            starts.append(s)
            lengths.append(min(WINDOW, len(text) - s))
    rows, starts, lengths = np.array(rows), np.array(starts), np.array(lengths)
    found: list[list] = [[] for _ in texts]
    order = np.argsort(-lengths, kind="stable")
    for at in range(0, len(order), TOGETHER):
        pick = order[at:at + TOGETHER]
        if not lengths[pick[0]]:
            break
        chars = np.zeros((lengths[pick[0]], len(pick)), np.uint8)
        for w, i in enumerate(pick):
            chars[:lengths[i], w] = parts[rows[i]][starts[i]:starts[i] + lengths[i]]
        for w, s, kind, e, odds in window_spans(model, chars, lengths[pick]):
            i = pick[w]
            r, begin = rows[i], int(starts[i])
            left, right = s == 0 and begin > 0, e == lengths[i] and begin + e < len(texts[r])
            found[r].append((begin + s, kind, begin + e, odds, left, right))
    out = []
    for text, mine in zip(texts, found):
        base = base_spans(text)
        out.append(sorted([(s, k, e, True) for s, k, e in base] +
                          [(s, k, e, False) for s, k, e in added_spans(text, base, mine)]))
    return out


# --- examples -----------------------------------------------------------------------
def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of sampled texts around base spans, around other digits and anywhere."""
    kind = pa.list_(pa.int32())
    for b in batches:
        texts, spans = [], []
        for text in b.column(0).to_pylist():
            base = base_spans(text)
            rnd = np.random.default_rng(np.frombuffer(text[:4000].encode() + b"\0", np.uint8).astype(np.uint32))
            centres = [(s + e) // 2 for s, _, e in base]
            rnd.shuffle(centres)
            digits = [m.start() for m in re.finditer(r"[0-9]{2,}|@|\bat\b", text)]
            rnd.shuffle(digits)
            anywhere = rnd.integers(0, max(1, len(text)), 1).tolist()
            for c in (centres[:WINDOWS_PER_DOC // 2] + digits[:1] + anywhere)[:WINDOWS_PER_DOC]:
                s = max(0, c - int(rnd.integers(10, LEARN_CHARS - 10)))
                cut = [x for x in base if x[0] < s + LEARN_CHARS and x[2] > s]
                e = min([s + LEARN_CHARS] + [x[0] for x in cut if x[2] > s + LEARN_CHARS])
                s = max([s] + [x[2] for x in cut if x[0] < s])
                if s < e:
                    texts.append(text[s:e])
                    spans.append([v for a, k, z in base if s <= a and z <= e for v in (a - s, k, z - s)])
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(spans, kind)], ["text", "spans"])


def _digits(rnd, like: str) -> str:
    return "".join(str(rnd.integers(0, 10)) if c.isdigit() else c for c in like)


def _card(rnd, n: int) -> str:
    s = "".join(map(str, rnd.integers(0, 10, n - 1)))
    return next(s + c for c in "0123456789" if luhn(s + c))


def rewritten(rnd, kind: int, text: str) -> str:
    """A base span with other digits, or in a form that the patterns miss."""
    way = int(rnd.integers(0, 6)) or int(rnd.integers(0, 6))  # the plain form less often
    if kind == 0:
        name, host = text.split("@", 1)
        at = [None, " at ", "[at]", " (at) ", " @ ", " [at] "][way]
        dot = [".", " dot ", "[dot]", " (dot) ", ".", " [dot] "][way] if rnd.integers(0, 3) else "."
        return text if at is None else _digits(rnd, name).strip(".") + at + host.replace(".", dot)
    if kind == 1:
        parts = [str(rnd.integers(0, 256)) for _ in range(4)]
        return [".", "[.]", " . ", "(.)", "-", "."][way].join(parts)
    if kind == 2:
        digits = _card(rnd, int(rnd.choice([14, 15, 16, 16, 16, 19])))
        groups = [digits[i:i + 4] for i in range(0, len(digits), 4)]
        return ["", " ", ".", "/", "  ", "_"][way].join(groups)
    d = _digits(rnd, "0" * 10)
    return [_digits(rnd, text), f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}",
            f"1-{d[:3]}-{d[3:6]}-{d[6:]}", f"00 1 {d[:3]} {d[3:6]} {d[6:]}"][way]


def augmented(windows: list[tuple[str, list]], least: int = 360, seed: int = 11) -> list[tuple[str, list]]:
    """The windows, and rewritten ones until each kind that occurs has about
    ``least`` spans; as many windows get a number that is no personal data."""
    rnd = np.random.default_rng(seed)
    out = list(windows)
    plain = [t for t, spans in windows if not spans]
    for kind in range(len(KINDS)):
        own = [(t, x) for t, spans in windows for x in spans if x[1] == kind and len(spans) == 1]
        for k in range(least if own else 0):
            text, (s, _, e) = own[k % len(own)]
            new = rewritten(rnd, kind, text[s:e])
            if plain and rnd.integers(0, 2):  # among other words
                other = plain[int(rnd.integers(0, len(plain)))]
                gaps = [m.end() for m in re.finditer(r"\s", other)] or [0]
                g = gaps[int(rnd.integers(0, len(gaps)))]
                text, s, e = other[:g] + " " + other[g:], g, g
            if s + len(new) <= LEARN_CHARS:
                out.append(((text[:s] + new + text[e:])[:LEARN_CHARS], [(s, kind, s + len(new))]))
    for k in range(min(least, len(plain))):
        gaps = [m.end() for m in re.finditer(r"\s", plain[k])] or [0]
        g = gaps[int(rnd.integers(0, len(gaps)))]
        n = [_digits(rnd, "0" * int(rnd.integers(1, 10))), _digits(rnd, "2000-00-00"), _digits(rnd, "0.0.0"),
             _digits(rnd, "00:00:00"), _digits(rnd, "0,000.00"), _digits(rnd, "000-00")][k % 6]
        text = (plain[k][:g] + n + " " + plain[k][g:])[:LEARN_CHARS]
        if not base_spans(text):
            out.append((text, []))
    return out


def sample(docs: DataFrame, text_col: str = "text") -> list[tuple[str, list]]:
    """Labelled windows of the distinct texts of smallest hash, of those with marks and of all."""
    reach(docs.sparkSession)
    rows = docs.select(F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h")).where("text IS NOT NULL")
    marked = rows.where(F.col("text").rlike(MARK)).select("h").distinct().orderBy("h").limit(MARKED_DOCS)
    anyhow = rows.select("h").distinct().orderBy("h").limit(PLAIN_DOCS)
    picked = F.broadcast(marked.union(anyhow).distinct())  # at most MARKED_DOCS + PLAIN_DOCS hashes
    got = (rows.join(picked, "h", "left_semi").dropDuplicates(["h"]).select("text")
           .mapInArrow(_examples, "text string, spans array<int>").collect())
    return sorted((r["text"], [tuple(r["spans"][i:i + 3]) for i in range(0, len(r["spans"]), 3)]) for r in got)


def fit(docs: DataFrame, text_col: str = "text") -> Model:
    return train(augmented(sample(docs, text_col)))


SPAN = "array<struct<kind: string, start: bigint, end: bigint, base: boolean>>"


def _find(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            at = 0
            while at < len(texts):
                upto, size = at, 0
                while upto < len(texts) and (upto == at or size + len(texts[upto]) <= CHUNK_CHARS):
                    size += len(texts[upto])
                    upto += 1
                found = spans_of(texts[at:upto], model)
                flat = [(KINDS[k], s, e, is_base) for spans in found for s, k, e, is_base in spans]
                cols = list(zip(*flat)) or [(), (), (), ()]
                values = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(cols, item)], fields=list(item))
                off = np.concatenate([[0], np.cumsum([len(x) for x in found])])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, upto - at), pa.ListArray.from_arrays(pa.array(off, pa.int32()), values)],
                    ["id", "spans"])
                at = upto
    return run


def find(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, spans): the spans of every whole text by start, then kind as in ``KINDS``."""
    reach(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(_find(model), f"id {kind}, spans {SPAN}").withColumnRenamed("id", id_col))


def digest(found: DataFrame) -> DataFrame:
    """The spans of ``find`` as counts of base spans by kind, the digest of the
    base spans, all spans as text and the number of added ones."""
    def text(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def of_kind(kind):
        return F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda x: x["base"])
    counts = [of_kind(kind) for kind in KINDS]
    rest = [c for c in found.columns if c != "spans"]
    return found.select(*rest, *counts, F.sha2(text(base).cast("binary"), 256).alias("base_sha256"),
                        text(F.col("spans")).alias("spans"),
                        (F.size("spans") - F.size(base)).cast("bigint").alias("n_added"))
