"""Personal data in texts: exact patterns, and a character tagger that adds what they miss.

The tagger is a bidirectional LSTM over characters with CRF transitions, trained in numpy from
labelled spans (matches of the exact patterns in a bounded sample of rows). It reads overlapping
windows at fixed places of the whole text; parts of a span that windows cut are joined, and the
sure and plausible spans decoded in all windows of a text are then reconciled together. A span of
any kind holds a digit or an ``@``, so windows without either are read only where a span goes on
into them.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.llm.columns import add_columns, bounded_batches, col

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE = 128, 64
TRAIN_ROWS = 3_000
TRAIN_WINDOWS = 1_600
TEXT_WINDOWS = 8  # of one text, in training
MIN_SCORE = 0.9

TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind
CHARS = 130  # padding is 0; ASCII as it is; other letters; the rest
EMBED, HIDDEN = 12, 20

_TRIGGER = re.compile(r"[0-9@]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match can only begin where a run of digits does, which keeps long runs linear
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")

Span = tuple[str, int, int]


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _is_ip(text: str) -> bool:
    return all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in text.split("."))


def _is_card(text: str) -> bool:
    digits = "".join(_DIGITS.findall(text))
    return 13 <= len(digits) <= 19 and _luhn(digits)


def _is_phone(text: str) -> bool:
    return 9 <= len(_DIGITS.findall(text)) <= 15


def _emails(text: str) -> list[Span]:
    """Found from each ``@`` outwards, so that long runs of letters cost nothing."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append(("email", start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return found


def base_spans(text: str) -> list[Span]:
    """Matches of the exact patterns: by kind, then by place."""
    if not _TRIGGER.search(text):
        return []
    found = _emails(text)
    for kind, pattern, valid in (
        ("ip", _IP, _is_ip),
        ("card", _CARD, _is_card),
        ("phone", _PHONE, _is_phone),
    ):
        found += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if valid(m.group())]
    return found


def _plausible(kind: str, text: str) -> bool:
    """What a span that the tagger adds must have, whatever separates its parts."""
    if kind == "email":
        return bool(re.fullmatch(r"[^@]*[A-Za-z0-9][^@]*@[^@]*[A-Za-z0-9][^@]*", text))
    if kind == "ip":
        parts = re.findall(r"[0-9]+", text)
        return len(parts) == 4 and _is_ip(".".join(parts))
    return _is_card(text) if kind == "card" else _is_phone(text)


# --- the tagger -------------------------------------------------------------------------------


def encode(texts: list[str], width: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Character classes, and whether a place holds a character at all: (width, texts) each."""
    ids = np.zeros((width, len(texts)), np.int64)
    for j, text in enumerate(texts):
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        letters = np.array([c.isalpha() for c in text])
        ids[: len(text), j] = np.where(points < 128, np.maximum(points, 1), 129 - letters)
    mask = np.zeros(ids.shape, bool)
    for j, text in enumerate(texts):
        mask[: len(text), j] = True
    return ids, mask


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Tagger:
    p: dict[str, np.ndarray]

    @staticmethod
    def fresh(seed: int = 7) -> Tagger:
        r = np.random.default_rng(seed)
        p = {"emb": r.normal(0, 0.3, (CHARS, EMBED))}
        for way in "fb":
            p[f"wx{way}"] = r.normal(0, EMBED**-0.5, (EMBED, 4 * HIDDEN))
            p[f"wh{way}"] = r.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN))
            p[f"b{way}"] = np.zeros(4 * HIDDEN)
            p[f"b{way}"][HIDDEN : 2 * HIDDEN] = 1
        p["wo"] = r.normal(0, (2 * HIDDEN) ** -0.5, (2 * HIDDEN, TAGS))
        p["bo"] = np.zeros(TAGS)
        p["trans"] = np.zeros((TAGS, TAGS))
        return Tagger({k: v.astype(np.float32) for k, v in p.items()})

    def _lstm(self, ids: np.ndarray, mask: np.ndarray, way: str, tape: list | None):
        p, (steps, n) = self.p, ids.shape
        table = p["emb"] @ p[f"wx{way}"] + p[f"b{way}"]
        h = np.zeros((n, HIDDEN), np.float32)
        c = np.zeros((n, HIDDEN), np.float32)
        out = np.zeros((steps, n, HIDDEN), np.float32)
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            z = table[ids[t]] + h @ p[f"wh{way}"]
            gates = _sigmoid(z[:, : 3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            on = mask[t][:, None]
            new_c = (f * c + i * g) * on
            tc = np.tanh(new_c)
            new_h = o * tc * on
            if tape is not None:
                tape.append((t, h, c, i, f, o, g, tc, on))
            h, c = new_h, new_c
            out[t] = h
        return out

    def emissions(self, ids: np.ndarray, mask: np.ndarray, tapes: dict | None = None) -> np.ndarray:
        tape = {"f": [], "b": []} if tapes is not None else {"f": None, "b": None}
        both = np.concatenate([self._lstm(ids, mask, w, tape[w]) for w in "fb"], axis=2)
        score = both @ self.p["wo"] + self.p["bo"]
        score[~mask] = -1e4
        score[~mask, 0] = 0
        if tapes is not None:
            tapes |= tape | {"both": both}
        return score

    def transitions(self) -> np.ndarray:
        """An inside tag only follows its own begin or inside tag."""
        t = self.p["trans"].copy()
        for k in range(len(KINDS)):
            inside = 2 + 2 * k
            allowed = np.zeros(TAGS, bool)
            allowed[[inside - 1, inside]] = True
            t[~allowed, inside] = -1e4
        return t

    def decode(self, score: np.ndarray) -> np.ndarray:
        """Best tags, (steps, texts)."""
        trans, (steps, n, _) = self.transitions(), score.shape
        back = np.zeros((steps, n, TAGS), np.int8)
        best = score[0].copy()
        best[:, 2::2] = -1e4
        for t in range(1, steps):
            paths = best[:, :, None] + trans
            back[t] = paths.argmax(1)
            best = paths.max(1) + score[t]
        tags = np.zeros((steps, n), np.int64)
        tags[-1] = best.argmax(1)
        for t in range(steps - 1, 0, -1):
            tags[t - 1] = back[t, np.arange(n), tags[t]]
        return tags

    def marginals(self, score: np.ndarray):
        """Probability of each tag at each place, of each step between tags, and log of the sum."""
        trans, (steps, n, _) = self.transitions().astype(np.float64), score.shape
        score = score.astype(np.float64)
        a = np.zeros((steps, n, TAGS))
        b = np.zeros((steps, n, TAGS))
        a[0] = score[0]
        a[0][:, 2::2] = -1e4
        for t in range(1, steps):
            x = a[t - 1][:, :, None] + trans
            m = x.max(1)
            a[t] = m + np.log(np.exp(x - m[:, None]).sum(1)) + score[t]
        for t in range(steps - 2, -1, -1):
            x = trans + (score[t + 1] + b[t + 1])[:, None]
            m = x.max(2)
            b[t] = m + np.log(np.exp(x - m[:, :, None]).sum(2))
        m = a[-1].max(1)
        log_sum = m + np.log(np.exp(a[-1] - m[:, None]).sum(1))
        tag = np.exp(a + b - log_sum[:, None])
        pair = np.zeros((TAGS, TAGS))
        for t in range(1, steps):
            x = a[t - 1][:, :, None] + trans + (score[t] + b[t])[:, None]
            pair += np.exp(x - log_sum[:, None, None]).sum(0)
        return tag, pair, log_sum

    def gradients(self, ids: np.ndarray, mask: np.ndarray, tags: np.ndarray) -> dict:
        """Of the negative log likelihood per text."""
        tapes: dict = {}
        score = self.emissions(ids, mask, tapes)
        tag, pair, _ = self.marginals(score)
        steps, n = ids.shape
        p, g = self.p, {k: np.zeros_like(v) for k, v in self.p.items()}
        d = tag.astype(np.float32)
        d[np.arange(steps)[:, None], np.arange(n), tags] -= 1
        d[~mask] = 0
        d /= n
        seen = np.zeros((TAGS, TAGS))
        np.add.at(seen, (tags[:-1].ravel(), tags[1:].ravel()), 1)
        g["trans"] = ((pair - seen) / n).astype(np.float32)
        both = tapes["both"]
        g["wo"] = both.reshape(-1, 2 * HIDDEN).T @ d.reshape(-1, TAGS)
        g["bo"] = d.sum((0, 1))
        d_both = d @ p["wo"].T
        for way, part in (("f", d_both[:, :, :HIDDEN]), ("b", d_both[:, :, HIDDEN:])):
            wh = p[f"wh{way}"]
            dh = np.zeros((n, HIDDEN), np.float32)
            dc = np.zeros((n, HIDDEN), np.float32)
            by_char = np.zeros((CHARS, 4 * HIDDEN), np.float32)
            for t, h, c, i, f, o, x, tc, on in reversed(tapes[way]):
                dh = (dh + part[t]) * on
                dc = (dc * on + dh * o * (1 - tc * tc)) * on
                dz = np.concatenate(
                    [
                        dc * x * i * (1 - i),
                        dc * c * f * (1 - f),
                        dh * tc * o * (1 - o),
                        dc * i * (1 - x * x),
                    ],
                    axis=1,
                )
                g[f"wh{way}"] += h.T @ dz
                np.add.at(by_char, ids[t], dz)
                dh, dc = dz @ wh.T, dc * f
            g[f"b{way}"] = by_char.sum(0)
            g[f"wx{way}"] = p["emb"].T @ by_char
            g["emb"] += by_char @ p[f"wx{way}"].T
        return g

    def spans(self, texts: list[str]) -> list[list[tuple[str, int, int, float]]]:
        """Kind, start, end and score (least probability of a tag) of the spans in each text."""
        if not texts:
            return []
        ids, mask = encode(texts)
        score = self.emissions(ids, mask)
        tags = self.decode(score)
        found: list[list] = [[] for _ in texts]
        some = np.flatnonzero((tags != 0).any(0))
        if not len(some):
            return found
        tag, _, _ = self.marginals(score[:, some])
        for k, j in enumerate(some.tolist()):
            t, end = 0, len(texts[j])
            while t < end:
                now = int(tags[t, j])
                if not now:
                    t += 1
                    continue
                inside, stop = now + now % 2, t + 1
                while stop < end and tags[stop, j] == inside:
                    stop += 1
                sure = tag[np.arange(t, stop), k, tags[t:stop, j]].min()
                found[j].append((KINDS[(inside - 2) // 2], t, stop, float(sure)))
                t = stop
        return found


def _labels(spans: list[Span], width: int = WINDOW) -> np.ndarray:
    tags = np.zeros(width, np.int64)
    for kind, start, end in spans:
        if not tags[start:end].any():
            k = 1 + 2 * KINDS.index(kind)
            tags[start] = k
            tags[start + 1 : end] = k + 1
    return tags


def _varied(text: str, spans: list[Span], r: np.random.Generator) -> str:
    """The text with new digits in its numbers and, at times, other separators."""
    chars = list(text)
    for kind, start, end in spans:
        other = str(r.choice(list("./_"))) if kind == "card" and r.random() < 0.3 else None
        for i in range(start, end):
            if chars[i].isdigit() and kind != "ip":
                chars[i] = str(r.integers(10))
            elif other and chars[i] in " -":
                chars[i] = other
    return "".join(chars)


def fit(
    windows: list[tuple[str, list[Span]]], epochs: int = 5, batch: int = 48, seed: int = 7
) -> Tagger | None:
    """A tagger trained (Adam) on windows and their spans; none if there are no spans at all."""
    if not any(spans for _, spans in windows):
        return None
    r = np.random.default_rng(seed)
    tagger = Tagger.fresh(seed)
    m = {k: np.zeros_like(v) for k, v in tagger.p.items()}
    v = {k: np.zeros_like(v) for k, v in tagger.p.items()}
    step = 0
    # few windows are gone over more often, so that a small table gives a trained model too
    epochs = max(epochs, min(60, -(-epochs * 1_200 // len(windows))))
    for epoch in range(epochs):
        order = r.permutation(len(windows))
        for a in range(0, len(order), batch):
            part = [windows[i] for i in order[a : a + batch]]
            texts = [_varied(t, s, r) if epoch % 2 else t for t, s in part]
            ids, mask = encode(texts)
            tags = np.stack([_labels(s) for _, s in part], axis=1)
            grads = tagger.gradients(ids, mask, tags)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            step += 1
            rate = 0.01 * (1 - 0.8 * epoch / epochs) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for k, g in grads.items():
                g = g * min(1.0, 5 / (norm + 1e-6))
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                tagger.p[k] = (tagger.p[k] - rate * m[k] / (np.sqrt(v[k]) + 1e-8)).astype(
                    np.float32
                )
    return tagger


def _window_starts(text: str) -> list[int]:
    """Windows begin at every STRIDE characters; those with a digit or an ``@`` are read."""
    last = max(0, -(-(len(text) - WINDOW) // STRIDE))
    used: set[int] = set()
    for m in _TRIGGER.finditer(text):
        k = m.start() // STRIDE
        used.update(x for x in (k - 1, k) if 0 <= x <= last)
        if k > last:
            used.add(last)
    return [k * STRIDE for k in sorted(used)]


def labelled_windows(text: str) -> list[tuple[str, list[Span]]]:
    """Windows of a text with the spans that lie inside them; none that cut a span in two."""
    spans = base_spans(text)
    out = []
    for at in _window_starts(text):
        end = at + WINDOW
        inside = [(k, a - at, b - at) for k, a, b in spans if a < end and b > at]
        if all(a >= 0 and b <= WINDOW for _, a, b in inside):
            out.append((text[at:end], inside))
    return out


def train(
    docs: DataFrame,
    text: str = "text",
    max_rows: int = TRAIN_ROWS,
    max_windows: int = TRAIN_WINDOWS,
    text_windows: int = TEXT_WINDOWS,
) -> Tagger | None:
    """Fit on windows of a sample of about ``max_rows`` of the rows that hold a digit or ``@``.

    Labels are the matches of the exact patterns. Each sampled text gives ``text_windows``
    windows at most and training takes ``max_windows`` at most, those with spans first.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(col(text).alias("text")).where(F.col("text").rlike("[0-9@]"))
    total = rows.count()
    if total > max_rows:
        part = F.pmod(F.xxhash64("text"), F.lit(1 << 32)) < int((1 << 32) * max_rows / total)
        rows = rows.where(part)

    def start():
        def compute(texts):
            made = [labelled_windows(t) for t in texts.to_pylist()]
            return [
                [
                    [
                        {"w": w, "spans": [{"k": k, "a": a, "b": b} for k, a, b in s]}
                        for w, s in sorted(own, key=lambda x: not x[1])[:text_windows]
                    ]
                    for own in made
                ]
            ]

        return compute

    fields = "windows array<struct<w:string,spans:array<struct<k:string,a:int,b:int>>>>"
    found = (
        add_columns(rows, ["text"], fields, start)
        .select(F.explode("windows").alias("x"))
        .select("x.w", "x.spans")
        .distinct()
        .orderBy(F.size("spans") == 0, F.xxhash64("w"), "w")
        .limit(max_windows)
        .collect()
    )
    return fit([(x["w"], [(s["k"], s["a"], s["b"]) for s in x["spans"]]) for x in found])


def _reconcile(found: list[tuple[str, int, int, float]]) -> list[tuple[str, int, int, float]]:
    """Of the spans of all windows, those apart from each other with the largest sum of scores."""
    best: dict[Span, float] = {}
    for kind, a, b, s in found:
        best[kind, a, b] = max(s, best.get((kind, a, b), 0.0))
    spans = sorted(((k, a, b, s) for (k, a, b), s in best.items()), key=lambda x: (x[2], x[1]))
    ends = [x[2] for x in spans]
    total, take = [0.0], []
    for i, (_, a, _, s) in enumerate(spans):
        before = bisect_right(ends, a, 0, i)
        take.append((total[before] + s > total[-1], before))
        total.append(max(total[-1], total[before] + s))
    chosen, i = [], len(spans)
    while i:
        taken, before = take[i - 1]
        if taken:
            chosen.append(spans[i - 1])
        i = before if taken else i - 1
    return chosen[::-1]


def _joined(parts: list[tuple]) -> list[tuple[str, int, int, float]]:
    """Whole spans out of the parts of them that windows hold.

    A part is a kind, place and score, and whether its window cuts it on the left and right. Parts
    of a kind that meet where they are cut become one span, as sure as the least sure part.
    """
    out, edges = [], []
    for part in parts:
        if part[4] or part[5]:
            edges.append(part)
        else:
            out.append(part[:4])
    held = None
    for part in [*sorted(edges, key=lambda x: x[:3]), None]:
        if part and held and part[0] == held[0] and held[5] and part[4] and part[1] <= held[2]:
            k, a, b, s, left, right = held
            right = part[5] if part[2] >= b else right
            held = (k, a, max(b, part[2]), min(s, part[3]), left, right)
            continue
        if held and not held[4] and not held[5]:
            out.append(held[:4])
        held = part
    return out


def find_spans(texts: list[str], tagger: Tagger | None) -> list[list[tuple[str, int, int, bool]]]:
    """All spans of each text, by kind and place; the flag tells exact matches from added spans."""
    base = [base_spans(t) for t in texts]
    added: list[list] = [[] for _ in texts]
    if tagger is not None:
        places = [(i, at) for i, t in enumerate(texts) for at in _window_starts(t)]
        read = set(places)
        while places:
            further = []
            for a in range(0, len(places), 256):
                part = places[a : a + 256]
                tagged = tagger.spans([texts[i][at : at + WINDOW] for i, at in part])
                for (i, at), spans in zip(part, tagged, strict=True):
                    size = len(texts[i])
                    for k, x, y, s in spans:
                        left, right = x == 0 and at > 0, y == WINDOW and at + y < size
                        added[i].append((k, at + x, at + y, s, left, right))
                        # a cut span goes on in the neighbour window, with a digit or without
                        for cut, to in ((left, at - STRIDE), (right, at + STRIDE)):
                            if cut and (i, to) not in read:
                                read.add((i, to))
                                further.append((i, to))
            places = further
    out = []
    for text, own, more in zip(texts, base, added, strict=True):
        spans = [(k, a, b, True) for k, a, b in own]
        good = [
            (k, a, b, s)
            for k, a, b, s in _joined(more)
            if s >= MIN_SCORE
            and all(b <= x or y <= a for _, x, y in own)
            and _plausible(k, text[a:b])
        ]
        spans += [(k, a, b, False) for k, a, b, _ in _reconcile(good)]
        out.append(sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1])))
    return out


def redacted(text: str, spans: list[tuple[str, int, int, bool]]) -> str:
    """The text with ``[EMAIL]`` and the like in place of its spans; overlapping ones become one."""
    out, at = [], 0
    for kind, start, end, _ in sorted(spans, key=lambda x: (x[1], -x[2])):
        if start >= at:
            out.append(text[at:start] + f"[{kind.upper()}]")
        at = max(at, end)
    return "".join(out) + text[at:]


def find(
    docs: DataFrame, tagger: Tagger | None, text: str = "text", keep=None, redact: bool = False
) -> DataFrame:
    """The kept columns (default: all) with ``pii``: kind, start, end and base flag of each span.

    Offsets are code points, ends exclusive; spans are in the order of KINDS, then of place. With
    ``redact`` the text column comes back with its spans replaced, null where it was null. A null
    or empty text has no spans. Without a tagger (no labelled span anywhere) only exact matches are
    found. A column already called ``pii`` is replaced. Each row is judged by itself, repeated ones
    too, and a text of any length is searched whole, window by window; an empty table gives no row.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tagger)

    def start():
        model = shared.value

        def compute(texts):
            values = texts.to_pylist()
            found = find_spans([t or "" for t in values], model)
            spans = [
                [{"kind": k, "start": a, "end": b, "base": own} for k, a, b, own in x]
                for x in found
            ]
            if not redact:
                return [spans]
            clean = [t if t is None else redacted(t, x) for t, x in zip(values, found, strict=True)]
            return [spans, clean]

        return compute

    fields = "pii array<struct<kind:string,start:int,end:int,base:boolean>>"
    if redact:
        fields += f", `{text}` string"
    kept = list(docs.columns if keep is None else keep)
    out = add_columns(docs, [text], fields, start, kept)
    return out
