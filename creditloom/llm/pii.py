"""Personal data: fixed patterns, and a character BiLSTM with CRF transitions that adds what they miss.

The network is trained in numpy from labelled spans: those of the patterns in a bounded sample of documents,
and the same values written in ways that the patterns don't know. It reads windows of ``READ`` characters
that overlap by two edges, all windows of every text. Each position takes its tag from the window in which it lies most central, tags are
joined to spans over the whole text, and a span is kept if its mean marginal reaches ``SURE`` and no fixed span
overlaps it.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from creditloom.llm.common import map_texts, plain_names

KINDS = ("email", "ip", "card", "phone")
#: Characters of a window to learn from and of one to read, and those at its ends that a neighbouring window decides.
WINDOW, READ, EDGE = 128, 768, 32
STRIDE = READ - 2 * EDGE
#: Windows read at once, and blank characters after a text.
AT_ONCE, AFTER = 1536, 16
HIDDEN, TAGS, SURE = 12, 5, 0.95
#: The emission of other tags than 0 where no text is read.
NEVER = -1e4

# The patterns of the contract. Digit runs are entered at their start only and taken
# whole (possessively), which matches the same spans without trying a long run again from each digit.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")
_BRACKETED_AT = re.compile(r"\w\s*[\[(]\s*at\s*[\])]\s*\w", re.I)
_LETTERS = str.maketrans("0123456789", "aeiounrstl")

Span = tuple[str, int, int]


def _emails(text: str) -> list[Span]:
    spans, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            end = domain.end()
            spans.append(("email", start, end))
        at = text.find("@", at + 1)
    return spans


def _is_ip(value: str) -> bool:
    return all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in value.split(".")))


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _is_card(value: str) -> bool:
    digits = value.replace(" ", "").replace("-", "")
    return 16 <= len(digits) <= 19 and _luhn(digits)


def _is_phone(value: str) -> bool:
    return 8 <= sum(map(str.isdigit, value)) <= 15


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns by kind, then start; matches that fail their check are dropped and not tried again."""
    if not _TRIGGER.search(text):
        return []
    found = _emails(text) if "@" in text else []
    for kind, pattern, good in (("ip", _IP, _is_ip), ("card", _CARD, _is_card), ("phone", _PHONE, _is_phone)):
        found += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if good(m[0])]
    return found


# --- the network -------------------------------------------------------------------------------

#: Characters by class: letters and digits as such, marks of addresses and numbers, others by sort.
_MARKS = "@._-+()[]/:,; \n'\"%=#"
_LETTER, _DIGIT, _OTHER_LETTER, _OTHER = 0, 26, 27, 28
CLASSES = 29 + len(_MARKS)


def _class_table() -> np.ndarray:
    table = np.full(256, _OTHER, dtype=np.uint8)
    for i in range(26):
        table[ord("a") + i] = table[ord("A") + i] = i
    table[ord("0"):ord("9") + 1] = _DIGIT
    table[192:] = _OTHER_LETTER
    for i, mark in enumerate(_MARKS):
        table[ord(mark)] = 29 + i
    return table


_CLASS = _class_table()


def char_classes(text: str) -> np.ndarray:
    """The class of every code point; those beyond Latin-1 count as other letters."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return np.where(points < 256, _CLASS[np.minimum(points, 255)], _OTHER_LETTER).astype(np.uint8)


def squash(u: np.ndarray, work: np.ndarray | None = None) -> np.ndarray:
    """The network's own kind of tanh(2u), in place: u (2 - |u|), which reaches 1 at 1 without a bend. ``work``: an array lent for it."""
    np.clip(u, -1.0, 1.0, out=u)
    work = np.abs(u, out=work)
    np.subtract(2.0, work, out=work)
    u *= work
    return u


def slope(u: np.ndarray) -> np.ndarray:
    """The derivative of :func:`squash`."""
    return 2.0 * np.maximum(1.0 - np.abs(u), 0.0)


#: By what inputs are multiplied before :func:`squash`: a gate is a tanh of half, moved to 0 to 1.
_SCALE = np.r_[np.full(3 * HIDDEN, 0.25, np.float32), np.full(HIDDEN, 0.5, np.float32)]
_ROOT = np.float32(0.5 ** 0.5)
_BACK = _SCALE * np.r_[np.full(3 * HIDDEN, 0.5, np.float32), np.ones(HIDDEN, np.float32)]


def _widened(rows: np.ndarray, width: int) -> np.ndarray:
    """The first ``width`` columns, zeros after the last."""
    made = np.zeros((len(rows), width), np.float32)
    kept = min(width, rows.shape[1])
    made[:, :kept] = rows[:, :kept]
    return made


@dataclass
class Tagger:
    """Input rows by class, recurrent weights, output weights and CRF transitions (tag 0: none)."""

    inputs: list[np.ndarray]      # per direction: CLASSES x 4H
    recurrent: list[np.ndarray]   # per direction: H x 4H
    output: np.ndarray            # 2H x TAGS
    bias: np.ndarray
    step: np.ndarray              # TAGS x TAGS

    @staticmethod
    def new(seed: int = 11) -> Tagger:
        rng = np.random.default_rng(seed)
        gates = 4 * HIDDEN
        make = lambda *s, k: (rng.standard_normal(s) * k).astype(np.float32)
        inputs = [make(CLASSES, gates, k=0.3) for _ in range(2)]
        for table in inputs:
            table[:, HIDDEN:2 * HIDDEN] += 1.0  # remember at first
        return Tagger(inputs, [make(HIDDEN, gates, k=0.25) for _ in range(2)], make(2 * HIDDEN, TAGS, k=0.3),
                      np.array([1.5] + [0.0] * (TAGS - 1), np.float32), np.zeros((TAGS, TAGS), np.float32))

    def parameters(self) -> list[np.ndarray]:
        return [*self.inputs, *self.recurrent, self.output, self.bias, self.step]

    def run(self, classes: np.ndarray, keep: bool = False):
        """Hidden states of both directions for windows (time, windows) of classes."""
        states, memory = [], []
        for d in range(2):
            seen = classes if d == 0 else classes[::-1]
            table, weight = self.inputs[d] * _SCALE, self.recurrent[d] * _SCALE
            h = np.zeros((seen.shape[1], HIDDEN), np.float32)
            c, hs, kept = np.zeros_like(h), [], []
            for row in seen:
                z = table.take(row, axis=0)
                z += h @ weight
                turned = slope(z) if keep else None
                squash(z)
                gate = z[:, :3 * HIDDEN]
                gate = gate * 0.5
                gate += 0.5
                i, f, o, g = gate[:, :HIDDEN], gate[:, HIDDEN:2 * HIDDEN], gate[:, 2 * HIDDEN:], z[:, 3 * HIDDEN:]
                before = c
                c = f * c + i * g
                t = squash(0.5 * c)
                if keep:
                    kept.append((h, before, i, f, o, g, t, turned, 0.5 * slope(0.5 * c)))
                h = o * t
                hs.append(h)
            states.append(np.stack(hs if d == 0 else hs[::-1]))
            memory.append(kept)
        return states, memory

    def read(self, classes: np.ndarray, length: np.ndarray | None = None) -> np.ndarray:
        """Emissions (time, tag, windows) of windows (time, windows) of classes: :meth:`run` and :meth:`emissions` without keeping the states.

        ``length``: how much of each window is read, the longest first; what lies past a window's end is surely tag 0. Gates, the
        candidate and the memory are kept as halves (u (2 - |u|) / 2 is v (root 2 - |v|) for v = u / root 2), and the product that
        carries the state to the next position gives the emissions of the last one too.
        """
        times, n = classes.shape
        alive = [n] * times if length is None else np.searchsorted(-length, -np.arange(times)).tolist()
        emit = np.empty((times, TAGS, n), np.float32)
        emit[:] = self.bias[:, None]
        for t, m in enumerate(alive):
            emit[t, 0, m:], emit[t, 1:, m:] = 0.0, NEVER
        room = [np.empty(rows * n, np.float32) for rows in (4 * HIDDEN + TAGS, 4 * HIDDEN, HIDDEN, HIDDEN)]
        for d in range(2):
            table, output = self.inputs[d] * (_SCALE * _ROOT), self.output[d * HIDDEN:(d + 1) * HIDDEN]
            weight = np.ascontiguousarray(np.c_[self.recurrent[d] * (_SCALE * _ROOT), output].T)
            h = c = np.zeros((HIDDEN, 0), np.float32)
            last, before = -1, 0
            for t in range(times) if d == 0 else range(times - 1, -1, -1):
                m = alive[t]
                if m != before:  # some windows end or begin: arrays of the new width, without gaps
                    if before:
                        emit[last, :, :before] += output.T @ h
                    h, c = _widened(h, m), _widened(c, m)
                    both, wide, part, narrow = (r[:len(r) // n * m].reshape(-1, m) for r in room)
                    z, score = both[:4 * HIDDEN], both[4 * HIDDEN:]
                    gates, i, f, o, g = z[:3 * HIDDEN], z[:HIDDEN], z[HIDDEN:2 * HIDDEN], z[2 * HIDDEN:3 * HIDDEN], z[3 * HIDDEN:]
                np.matmul(weight, h, out=both)
                if m == before:
                    emit[last, :, :m] += score
                z += table.take(classes[t, :m], axis=0).T
                z.clip(-_ROOT, _ROOT, out=z)
                np.abs(z, out=wide)
                np.subtract(2 * _ROOT, wide, out=wide)
                z *= wide
                gates += 0.5
                c *= f
                np.multiply(i, g, out=part)
                c += part
                np.copyto(part, c)
                np.multiply(o, squash(part, narrow), out=h)
                last, before = t, m
            emit[last, :, :before] += output.T @ h
        return emit

    def emissions(self, states: list[np.ndarray]) -> np.ndarray:
        return np.concatenate(states, axis=2) @ self.output + self.bias


def viterbi(emit: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Best tags (time, windows)."""
    times, n, kinds = emit.shape
    score = np.empty((times, kinds, n), np.result_type(emit, step))
    score[:] = emit.transpose(0, 2, 1)
    for t in range(1, times):
        score[t] += (score[t - 1][:, None] + step[:, :, None]).max(axis=0)
    tags = np.empty((times, n), np.int8)
    tags[-1] = score[-1].argmax(axis=0)
    for t in range(times - 1, 0, -1):
        tags[t - 1] = (score[t - 1] + step[:, tags[t]]).argmax(axis=0)
    return tags


def idle(emit: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Windows whose best path is surely without any span: no run of other tags, at the best of their scores, gains on tag 0.

    ``emit``: (time, tag, windows).
    """
    gain = emit[:, 1:].max(axis=1) - emit[:, 0]
    enter, leave, stay = (float(part.max() - step[0, 0]) for part in (step[0, 1:], step[1:, 0], step[1:, 1:]))
    run = gain[0].copy()
    best = run + leave if len(gain) > 1 else run
    for t in range(1, len(gain)):
        run = gain[t] + np.maximum(run + stay, enter)
        best = np.maximum(best, run + (leave if t < len(gain) - 1 else 0.0))
    return best < -1e-3


def crf_marginals(emit: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tag chances, summed expected transitions, and log normalisers, by scaled forward-backward."""
    times, n, _ = emit.shape
    top = emit.max(axis=2, keepdims=True)
    e, move = np.exp(emit - top).astype(np.float64), np.exp(step).astype(np.float64)
    ahead, scale = np.empty_like(e), np.empty((times, n))
    for t in range(times):
        a = e[t] if t == 0 else (ahead[t - 1] @ move) * e[t]
        scale[t] = a.sum(axis=1)
        ahead[t] = a / scale[t][:, None]
    back, moved = np.ones((n, step.shape[0])), np.zeros(step.shape)
    chance = np.empty_like(e)
    chance[-1] = ahead[-1]
    for t in range(times - 2, -1, -1):
        onward = e[t + 1] * back / scale[t + 1][:, None]
        moved += np.einsum("na,nb->ab", ahead[t], onward) * move
        back = onward @ move.T
        chance[t] = ahead[t] * back
    return chance, moved, np.log(scale).sum(axis=0) + top[:, :, 0].sum(axis=0)


def _gradients(model: Tagger, classes: np.ndarray, tags: np.ndarray) -> list[np.ndarray]:
    """Gradient of the mean log likelihood of the tags, by back-propagation through time."""
    times, n = classes.shape
    states, memory = model.run(classes, keep=True)
    emit = model.emissions(states)
    chance, moved, _ = crf_marginals(emit, model.step)
    d_emit = (np.eye(TAGS)[tags] - chance).astype(np.float32) / n
    seen = np.zeros((TAGS, TAGS))
    np.add.at(seen, (tags[:-1].ravel(), tags[1:].ravel()), 1)
    both = np.concatenate(states, axis=2)
    d_output = np.einsum("tnh,tnk->hk", both, d_emit)
    d_both = d_emit @ model.output.T
    d_inputs, d_recurrent = [], []
    for d in range(2):
        order = range(times - 1, -1, -1)
        seen_rows = classes if d == 0 else classes[::-1]
        d_h = d_both[:, :, :HIDDEN] if d == 0 else d_both[::-1, :, HIDDEN:]
        table, weight = np.zeros_like(model.inputs[d]), np.zeros_like(model.recurrent[d])
        next_h, next_c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        for t in order:
            h, before, i, f, o, g, squashed, turned, bend = memory[d][t]
            dh = d_h[t] + next_h
            dc = dh * o * bend + next_c
            dz = np.concatenate([dc * g, dc * before, dh * squashed, dc * i], axis=1)
            dz *= turned
            dz *= _BACK
            np.add.at(table, seen_rows[t], dz)
            weight += h.T @ dz
            next_h, next_c = dz @ model.recurrent[d].T, dc * f
        d_inputs.append(table)
        d_recurrent.append(weight)
    return [*d_inputs, *d_recurrent, d_output, d_emit.sum(axis=(0, 1)), ((seen - moved) / n).astype(np.float32)]


def fit(examples: list[tuple[np.ndarray, np.ndarray]], rounds: int = 400, batch: int = 48, seed: int = 11) -> Tagger | None:
    """A tagger from windows of classes and tags (each ``WINDOW`` long); None without any span to learn from."""
    with_span = [k for k, (_, tags) in enumerate(examples) if tags.any()]
    if not with_span:
        return None
    model, rng = Tagger.new(seed), np.random.default_rng(seed)
    mean = [np.zeros_like(p) for p in model.parameters()]
    square = [np.zeros_like(p) for p in model.parameters()]
    for r in range(1, rounds + 1):
        chosen = np.r_[rng.choice(with_span, batch // 2), rng.integers(0, len(examples), batch - batch // 2)]
        classes = np.stack([examples[k][0] for k in chosen], axis=1)
        tags = np.stack([examples[k][1] for k in chosen], axis=1).astype(np.int64)
        rate = 0.03 if r < rounds * 0.6 else 0.008
        for p, g, m, s in zip(model.parameters(), _gradients(model, classes, tags), mean, square):
            g = np.clip(g, -5, 5)
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            p += rate * (m / (1 - 0.9 ** r)) / (np.sqrt(s / (1 - 0.99 ** r)) + 1e-6)
    return model


# --- whole texts -------------------------------------------------------------------------------

def window_starts(length: int) -> np.ndarray:
    """Starts of the windows that cover a text."""
    return np.arange(0, max(0, length - READ) + STRIDE, STRIDE)


def added_spans(model: Tagger | None, texts: list[str], fixed: list[list[Span]]) -> list[list[Span]]:
    """The network's spans of each whole text that overlap none of its ``fixed`` spans."""
    added: list[list[Span]] = [[] for _ in texts]
    if model is None:
        return added
    tags, sure = {}, {}
    owner = [(k, window_starts(len(t))) for k, t in enumerate(texts) if t]
    if not owner:
        return added
    which = np.concatenate([np.full(len(starts), k) for k, starts in owner])
    place = np.concatenate([starts for _, starts in owner])
    base, parts, total = np.zeros(len(texts), np.int64), [], 0
    for k, _ in owner:
        base[k] = total
        parts += [char_classes(texts[k]), np.full(READ + AFTER, _CLASS[10], np.uint8)]
        total += len(texts[k]) + READ + AFTER
    classes = np.concatenate(parts)
    length = np.minimum(READ, np.array([len(t) for t in texts])[which] - place + AFTER)
    order = np.argsort(-length, kind="stable")  # the longest first: no position past a window's end is read
    taken = [sorted((s, e) for _, s, e in one) for one in fixed]
    for at in range(0, len(place), AT_ONCE):
        chosen = order[at:at + AT_ONCE]
        owners, starts = which[chosen], place[chosen]
        emit = model.read(classes[np.arange(length[chosen[0]])[:, None] + (base[owners] + starts)], length[chosen])
        hit = np.flatnonzero(~idle(emit, model.step))
        emit = np.ascontiguousarray(emit[:, :, hit].transpose(0, 2, 1))
        best = viterbi(emit, model.step)
        some = np.flatnonzero(best.any(axis=0))
        open_, ranges = [], []
        for column in some.tolist():
            k, s = int(owners[hit[column]]), int(starts[hit[column]])
            end = len(texts[k])
            if k not in tags:
                tags[k], sure[k] = np.zeros(end, np.int8), np.ones(end, np.float32)
            low = 0 if s == 0 else s + EDGE
            high = end if s + READ >= end else s + READ - EDGE
            own = best[low - s:high - s, column]
            tags[k][low:high] = own
            if may_add(own, low, texts[k], taken[k]):
                open_.append(column)
                ranges.append((k, s, low, high))
        if not open_:
            continue
        chance = crf_marginals(emit[:, open_], model.step)[0]  # of windows with a span that may be added, no others
        sured = np.take_along_axis(chance, best[:, open_, None].astype(np.int64), axis=2)[:, :, 0]
        for column, (k, s, low, high) in enumerate(ranges):
            sure[k][low:high] = sured[low - s:high - s, column]
    for k, found in tags.items():
        for tag, start, end in runs(found):
            if sure[k][start:end].mean() < SURE:
                continue
            kind, (start, end) = KINDS[tag - 1], trimmed(texts[k], start, end)
            if plausible(kind, texts[k][start:end]) and not any(s < end and start < e for s, e in taken[k]):
                added[k].append((kind, start, end))
    return added


def runs(tags: np.ndarray) -> list[tuple[int, int, int]]:
    """(tag, start, end) of the runs of each tag but 0."""
    cuts = np.flatnonzero(np.diff(np.r_[0, tags, 0]))
    firsts = cuts[:-1].tolist()
    return [(tag, s, e) for tag, s, e in zip(tags[firsts].tolist(), firsts, cuts[1:].tolist()) if tag]


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """A span without blanks and marks at its ends."""
    value = text[start:end]
    start += len(value) - len(value.lstrip(" \n\t,;:"))
    return start, start + len(value.strip(" \n\t,;:"))


def may_add(tags: np.ndarray, low: int, text: str, taken: list[tuple[int, int]]) -> bool:
    """Whether a run of these tags, of a text from ``low``, may be or belong to a span that is added, however sure it is.

    A run that overlaps a fixed span can't, nor can the longer one that it may be a part of; one that is no part of a longer one must be plausible.
    """
    for tag, start, end in runs(tags):
        whole = (start > 0 or low == 0) and (end < len(tags) or low + end == len(text))
        a, b = trimmed(text, low + start, low + end)
        if a < b and any(s < b and a < e for s, e in taken) or whole and not plausible(KINDS[tag - 1], text[a:b]):
            continue
        return True
    return False


def plausible(kind: str, value: str) -> bool:
    """Whether a decoded span can be of its kind at all, however it is written."""
    digits = [c for c in value if c.isdecimal() and c.isascii()]
    if kind == "email":
        return "@" in value or _BRACKETED_AT.search(value) is not None or " at " in value.lower() and bool(digits)
    if kind == "ip":
        return 4 <= len(digits) <= 12 and len(re.findall(r"[0-9]+", value)) == 4
    if kind == "card":
        return 16 <= len(digits) <= 19 and _luhn("".join(digits))
    return 8 <= len(digits) <= 15 and len(digits) * 2 >= len(value) - 2


def variants(kind: str, value: str) -> list[str]:
    """Ways to write a value that the fixed patterns don't know."""
    if kind == "email":
        name, _, host = value.partition("@")
        return [f"{name} @ {host}", f"{name}@{host.replace('.', ' . ')}", f"{name} (at) {host}", f"{name} [at] {host.replace('.', ' [dot] ')}"]
    if kind == "ip":
        return [value.replace(".", " . "), value.replace(".", "[.]")]
    digits = "".join(c for c in value if c.isdigit())
    if kind == "card":
        groups = [digits[i:i + 4] for i in range(0, len(digits), 4)]
        return [".".join(groups), " - ".join(groups), "/".join(groups)]
    local = digits[-10:]
    if len(local) < 10:
        return []
    return [f"({local[:3]}) {local[3:6]}-{local[6:]}", f"{local[:3]}-{local[3:6]}-{local[6:]}", f"{local[:3]}.{local[3:6]}.{local[6:]}"]


def plain_address(value: str, text: str, turn: int) -> str:
    """An address without digits, every other time at a host named by a word of the text, with the at sign spelt out."""
    name, _, host = value.translate(_LETTERS).partition("@")
    words = re.findall("[A-Za-z]{3,10}", text) if turn & 1 else []
    if words:
        host = f"{words[turn % len(words)].lower()}.{('org', 'com', 'net', 'de')[turn >> 1 & 3]}"
    if turn >> 3 & 1:
        name = re.split("[._%+-]", name)[0] or name
    return variants("email", f"{name}@{host}")[2 + (turn >> 4 & 1)]


def examples_of(text: str, most: int = 6) -> list[tuple[bytes, bytes]]:
    """Training windows of a labelled text: around spans, with spans rewritten, around other digits, and plain ones."""
    spans, made = base_spans(text), []
    number = {k: i + 1 for i, k in enumerate(KINDS)}
    turn = len(text) * 2654435761 & 0xFFFFFFFF

    def window(body: str, marked: list[Span], centre: int) -> None:
        start = max(0, centre - 16 - turn % 96)
        piece = body[start:start + WINDOW].ljust(WINDOW, "\n")
        tags = np.zeros(WINDOW, np.int8)
        for kind, s, e in marked:
            tags[max(0, s - start):max(0, e - start)] = number[kind]
        made.append((char_classes(piece).tobytes(), tags.tobytes()))

    for n, (kind, s, e) in enumerate(spans[:most]):
        window(text, spans, s)
        ways = variants(kind, text[s:e])
        rewritten = [ways[(turn + n) % len(ways)]] if ways else []
        if kind == "email":
            rewritten += [plain_address(text[s:e], text, (turn >> 5 * k) + n * 7 + k * 16) for k in (1, 2, 3)]
        for value in rewritten:
            shift = len(value) - (e - s)
            moved = [(k, a, b) if b <= s else (k, a + shift, b + shift) for k, a, b in spans if b <= s or a >= e]
            window(text[:s] + value + text[e:], [*moved, (kind, s, s + len(value))], s)
    clear = [m.start() for m in _TRIGGER.finditer(text) if not any(s <= m.start() < e for _, s, e in spans)]
    for at in clear[:: max(1, len(clear) // 3)][:3]:
        window(text, spans, at)
    if text and turn % 4 == 0:
        window(text, spans, turn % len(text))
    return made


def train(docs: DataFrame, text: str = "text", texts: int = 1500) -> Tagger | None:
    """A tagger from at most ``texts`` documents that hold a digit or an at sign, those of the smallest hashes; copies teach once."""
    worth = docs.select(F.col(text).cast("string").alias("text")).where("text rlike '[0-9@]'")
    worth = worth.withColumn("draw", F.pmod(F.xxhash64("text"), F.lit(1 << 60)))
    least = worth.select("draw").distinct().orderBy("draw").limit(texts)
    drawn = worth.join(F.broadcast(least), "draw").groupBy("draw").agg(F.min("text").alias("text"))

    def make(given: list) -> list:
        found = [examples_of(t) for t in given]
        kind = pa.list_(pa.struct([("c", pa.binary()), ("t", pa.binary())]))
        return [pa.array([[{"c": c, "t": t} for c, t in one] for one in found], kind)]

    made = map_texts(drawn, ["draw"], "text", make, "windows array<struct<c: binary, t: binary>>")
    rows = sorted(((r["draw"], r["windows"]) for r in made.collect()), key=lambda r: r[0])
    return fit([(np.frombuffer(w["c"], np.uint8), np.frombuffer(w["t"], np.int8)) for _, ws in rows for w in ws])


def joined(spans: list[Span]) -> str:
    """kind:start:end by kind as listed, then start, comma-joined."""
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1], x[2])))


def detect(model: Tagger | None, texts: list[str | None]) -> tuple[list[list[Span]], list[list[Span]]]:
    """Fixed and added spans of each whole text; a null text is empty."""
    texts = [t or "" for t in texts]
    fixed = [base_spans(t) for t in texts]
    return fixed, added_spans(model, texts, fixed)


def _report(model: Tagger | None, texts: list) -> list:
    fixed, added = detect(model, texts)
    columns = [pa.array([sum(s[0] == k for s in one) for one in fixed], pa.int64()) for k in KINDS]
    base = [hashlib.sha256(joined(one).encode()).hexdigest() for one in fixed]
    return [*columns, pa.array(base, pa.string()), pa.array([joined(f + a) for f, a in zip(fixed, added)], pa.string())]


def find_spans(docs: DataFrame, model: Tagger | None, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` with the counts and digest of the fixed spans and all ``spans``, for every row.

    A null or empty text has none; rows that repeat an id are answered one by one.
    """
    fields = ", ".join(f"n_{k} bigint" for k in KINDS) + ", base_sha256 string, spans string"
    return map_texts(docs, keep, text, partial(_report, model), fields)


def _masked(model: Tagger | None, texts: list) -> list:
    fixed, added = detect(model, texts)
    out = []
    for text, one in zip(texts, (f + a for f, a in zip(fixed, added))):
        if text is None or not one:
            out.append(text)
            continue
        parts, end = [], 0
        for kind, s, e in sorted(one, key=lambda x: (x[1], -x[2])):
            if s >= end:
                parts += [text[end:s], f"<{kind}>"]
            elif e > end:  # overlaps the span before: hidden with it
                pass
            end = max(end, e)
        out.append("".join(parts) + text[end:])
    return [pa.array(out, pa.string())]


def mask(docs: DataFrame, model: Tagger | None, text: str = "text") -> DataFrame:
    """``docs`` with each span of the text replaced by its kind in angle brackets; other columns as they are.

    Of spans that overlap the one that starts first, then the longest, names the kind, and all that they cover is hidden. Null texts stay null,
    empty ones empty; repeated rows are masked one by one; no documents give no rows.
    """
    given, names = plain_names(docs)
    others = [c for c in given.columns if c != names[text]]
    masked = map_texts(given, others, names[text], partial(_masked, model), "masked string")
    return masked.withColumnRenamed("masked", names[text]).select(*given.columns).toDF(*docs.columns)
