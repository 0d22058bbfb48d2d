"""Licences in texts, by a generalised suffix automaton over the words of licence templates.

The automaton knows every run of words of every template. A text is streamed through it once, and at
each word its state tells the longest run of words ending there that some template holds: the
text's matching statistics. Following suffix links from that state gives the same for each single
template. A run that a template cannot continue is a match; matches of a few words on are chained
where they follow each other in text and template alike, and a chain that covers enough of its
template is a span. Phrases are read from the automaton too, as the runs that end with them.

Words that no two neighbours of which stand together in any template cannot be inside a match, so
the automaton only runs between them; the result is the same.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tapewright.llm.columns import add_columns
from tapewright.llm.decontaminate import _WORD_BYTES, words
from tapewright.llm.licence_texts import PHRASES, TEMPLATES

LEAST_MATCH = 4  # words of a match; a shorter template is one match
GAP = 30  # words of the text between two matches of a chain, at most
SHARE = 0.75  # of a template's words, covered by a span
PHRASE_SCORE = 0.5  # where phrases stand but no span
# Words of all templates together. They are sent to every task, hence the bound.
MOST_WORDS = 2_000_000
SEGMENT = 1 << 20  # bytes of a text worked on at a time

FIELDS = (
    "n_words long, n_base long, first_word long, last_word long, base_labels array<string>,"
    " labels array<string>, score double,"
    " licences array<struct<label:string,start:int,end:int,covered:int,share:double>>"
)


class Automaton:
    """All runs of words of some sequences of word numbers, each sequence ending apart."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        # for each state, where its runs end: (sequence, end) of the prefixes it was made for
        self.ends: list[list[tuple[int, int]]] = [[]]
        for number, sequence in enumerate(sequences):
            last = 0
            for at, word in enumerate(sequence):
                last = self._extend(last, word)
                self.ends[last].append((number, at + 1))
        # longer runs first, so that a state's ends reach all its suffixes
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            up = self.link[state]
            if up > 0:
                self.ends[up] = self.ends[up] + self.ends[state]
        self.holders = []
        for ends in self.ends:
            held: dict[int, list[int]] = {}
            for number, end in ends:
                held.setdefault(number, []).append(end)
            self.holders.append({n: sorted(set(e)) for n, e in held.items()})

    def _new(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        self.ends.append([])
        return len(self.next) - 1

    def _split(self, state: int, word: int, into: int) -> int:
        """The state of the runs of ``into`` that are no longer than those of ``state`` plus a word."""
        if self.length[into] == self.length[state] + 1:
            return into
        copy = self._new(self.length[state] + 1, self.link[into], dict(self.next[into]))
        self.link[into] = copy
        while state >= 0 and self.next[state].get(word) == into:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:  # an earlier sequence went here already
            return self._split(last, word, self.next[last][word])
        made = self._new(self.length[last] + 1, 0, {})
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = made
            state = self.link[state]
        if state >= 0:
            self.link[made] = self._split(state, word, self.next[state][word])
        return made

    def step(self, state: int, length: int, word: int) -> tuple[int, int]:
        """State and length of the longest known run that ends with ``word``."""
        while state and word not in self.next[state]:
            state = self.link[state]
            length = self.length[state]
        if word in self.next[state]:
            return self.next[state][word], length + 1
        return 0, 0


@dataclass
class Match:
    """Words ``start`` to ``end`` of the text are words up to ``place`` of a template."""

    start: int
    end: int
    place: int
    score: int = 0
    since: int = 0

    @property
    def first(self) -> int:
        return self.place - (self.end - self.start)


@dataclass
class Span:
    template: int
    start: int
    end: int
    covered: int


def spans_of(template: int, matches: list[Match]) -> list[Span]:
    """Chains of matches, none of them overlapping another: those that cover most first.

    ``matches`` are in order of their end. A chain goes on where text and template both go on, and
    words that two of its matches share count once.
    """
    ends = [m.end for m in matches]
    for i, b in enumerate(matches):
        b.score, b.since = b.end - b.start, b.start
        for a in matches[bisect_left(ends, b.start - GAP) : i]:
            if a.start < b.start and a.end < b.end and a.place < b.place and a.first < b.first:
                new = min(b.end - max(b.start, a.end), b.place - max(b.first, a.place))
                if a.score + new > b.score or (a.score + new == b.score and a.since > b.since):
                    b.score, b.since = a.score + new, a.since
    ranked = sorted(matches, key=lambda m: (-m.score, m.end - m.since, m.since))
    return apart(Span(template, m.since, m.end, m.score) for m in ranked)


def apart(spans: Iterable[Span]) -> list[Span]:
    """The spans that do not overlap an earlier one of those kept."""
    taken: list[tuple[int, int]] = []
    out = []
    for s in spans:
        at = bisect_right(taken, (s.start, s.end))
        if at and taken[at - 1][1] > s.start or at < len(taken) and taken[at][0] < s.end:
            continue
        taken.insert(at, (s.start, s.end))
        out.append(s)
    return out


@dataclass
class Scan:
    """One text on its way through the automaton, in pieces."""

    library: Library
    n_words: int = 0
    n_base: int = 0
    first_word: int | None = None
    last_word: int | None = None
    base: set[int] = field(default_factory=set)
    spans: list[Span] = field(default_factory=list)
    state: int = 0
    length: int = 0
    before: int = -1
    position: int = 0  # words up to the last one that was seen
    running: dict[int, tuple[int, int]] = field(default_factory=dict)
    open: dict[int, list[Match]] = field(default_factory=dict)

    def feed(self, ids: np.ndarray) -> None:
        """The next words, as numbers; -1 for words that no template has."""
        if not len(ids):
            return
        lib = self.library
        ids = np.concatenate(([self.before], ids))
        pairs = np.flatnonzero(lib.meet(ids[:-1], ids[1:])) + 1
        at = 0  # the place in ids that the state stands after
        for i in pairs.tolist():
            if i - 1 != at:
                self.stop()
                word = int(ids[i - 1])
                self.state, self.length = lib.automaton.next[0].get(word, 0), 1
            self.state, self.length = lib.automaton.step(self.state, self.length, int(ids[i]))
            at = i
            self.see(self.n_words + i)
        if at != len(ids) - 1:
            self.stop()
            last = int(ids[-1])
            self.state = lib.automaton.next[0].get(last, 0) if last >= 0 else 0
            self.length = 1 if self.state else 0
        self.before = int(ids[-1])
        self.n_words += len(ids) - 1

    def see(self, end: int) -> None:
        """The state after ``end`` words: phrases that end here, and what each template matches."""
        lib = self.library
        self.position = end
        for phrase, size in lib.marks.get(self.state, ()):
            if self.length >= size:
                self.n_base += 1
                self.base.add(phrase)
                start = end - size
                self.first_word = start if self.first_word is None else min(self.first_word, start)
                self.last_word = start if self.last_word is None else max(self.last_word, start)
        now: dict[int, tuple[int, int]] = {}
        state, length = self.state, self.length
        while length >= lib.least:
            for template in lib.automaton.holders[state]:
                if template not in now and length >= lib.needed[template]:
                    now[template] = (length, state)
            state = lib.automaton.link[state]
            length = lib.automaton.length[state]
        for template, (n, state) in self.running.items():
            if now.get(template, (0, 0))[0] != n + 1:
                self.matched(template, end - 1, n, state)
        self.running = now

    def stop(self) -> None:
        """No run goes on beyond the place of the state."""
        for template, (n, state) in self.running.items():
            self.matched(template, self.position, n, state)
        self.running = {}

    def matched(self, template: int, end: int, n: int, state: int) -> None:
        own = self.open.setdefault(template, [])
        if own and own[-1].end + GAP < end - n:
            self.close(template)
            own = self.open.setdefault(template, [])
        for place in self.library.automaton.holders[state][template]:
            own.append(Match(end - n, end, place))

    def close(self, template: int) -> None:
        least = SHARE * self.library.sizes[template]
        chains = spans_of(template, self.open.pop(template))
        self.spans += [s for s in chains if s.covered >= least]

    def finish(self) -> list[Span]:
        """Spans of the whole text in its order: where templates overlap, the one that covers most."""
        self.stop()
        for template in list(self.open):
            self.close(template)
        sizes = self.library.sizes
        best = sorted(
            self.spans,
            key=lambda s: (-s.covered, -s.covered / sizes[s.template], s.template, s.start),
        )
        return sorted(apart(best), key=lambda s: s.start)


class Library:
    """Templates and phrases as (label, text), ready to scan with."""

    def __init__(
        self,
        templates: Iterable[tuple[str, str]] = TEMPLATES,
        phrases: Iterable[tuple[str, str]] = PHRASES,
    ):
        templates, phrases = list(templates), list(phrases)
        texts = [words(text) for _, text in [*templates, *phrases]]
        if any(len(t) < 2 for t in texts):
            raise ValueError("templates and phrases have two words at least")
        if sum(map(len, texts)) > MOST_WORDS:
            raise ValueError(f"templates have more than {MOST_WORDS} words")
        self.labels = [label for label, _ in templates]
        self.phrase_labels = [label for label, _ in phrases]
        self.sizes = [len(t) for t in texts[: len(templates)]]
        self.needed = [min(LEAST_MATCH, n) for n in self.sizes]
        self.least = min(self.needed, default=1 << 62)
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
        sequences = [[self.vocabulary[w] for w in t] for t in texts]
        width = len(self.vocabulary)
        self.pairs = np.unique(
            np.array([a * width + b for s in sequences for a, b in zip(s, s[1:])], np.int64)
        )
        self.automaton = Automaton(sequences)
        own = range(len(templates))
        self.automaton.holders = [
            {n: e for n, e in held.items() if n in own} for held in self.automaton.holders
        ]
        named: dict[int, list[tuple[int, int]]] = {}
        for phrase, sequence in enumerate(sequences[len(templates) :]):
            state = 0
            for word in sequence:
                state = self.automaton.next[state][word]
            named.setdefault(state, []).append((phrase, len(sequence)))
        self.marks: dict[int, list[tuple[int, int]]] = {}
        for state in range(len(self.automaton.next)):
            up, marks = state, []
            while up > 0:
                marks += named.get(up, [])
                up = self.automaton.link[up]
            if marks:
                self.marks[state] = marks

    def meet(self, before: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Whether the two words stand together in a template."""
        out = np.zeros(len(word), bool)
        both = np.flatnonzero((before >= 0) & (word >= 0))
        if len(both) and len(self.pairs):
            pair = before[both].astype(np.int64) * len(self.vocabulary) + word[both]
            at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            out[both] = self.pairs[at] == pair
        return out

    def scan(self, text: str | None) -> tuple[Scan, list[Span]]:
        found = Scan(self)
        get = self.vocabulary.get
        for piece in pieces(text):
            own = piece.split()
            found.feed(np.fromiter((get(w, -1) for w in own), np.int64, len(own)))
        return found, found.finish()


def pieces(text: str | None) -> Iterator[bytes]:
    """The text with a blank for every byte outside words, cut between words."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES)
    at = 0
    while at < len(raw):
        stop = len(raw)
        if stop - at > SEGMENT:
            stop = raw.rfind(b" ", at, at + SEGMENT)
            if stop <= at:
                stop = raw.find(b" ", at + SEGMENT)
                stop = len(raw) if stop < 0 else stop
        yield raw[at:stop]
        at = stop


def offsets(text: str, spans: list[Span]) -> list[tuple[int, int]]:
    """Code points at which the spans' first words start and their last words end."""
    wanted = sorted({w for s in spans for w in (s.start, s.end - 1)})
    start, end = {}, {}
    n_words = n_points = at = 0
    raw = (text or "").encode("utf-8", "surrogatepass")
    for piece in pieces(text):
        own = np.frombuffer(raw, np.uint8, len(piece), at)
        is_word = np.frombuffer(piece, np.uint8) != 32
        edges = np.diff(np.concatenate(([0], is_word.view(np.int8), [0])))
        firsts, lasts = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        here = wanted[bisect_left(wanted, n_words) : bisect_left(wanted, n_words + len(firsts))]
        points = np.concatenate(([0], np.cumsum((own & 0xC0) != 0x80)))
        for w in here:
            start[w] = n_points + int(points[firsts[w - n_words]])
            end[w] = n_points + int(points[lasts[w - n_words]])
        n_words, n_points, at = n_words + len(firsts), n_points + int(points[-1]), at + len(piece)
    return [(start[s.start], end[s.end - 1]) for s in spans]


def scan(
    docs: DataFrame,
    library: Library | None = None,
    text: str = "text",
    keep: Iterable[str] | None = None,
) -> DataFrame:
    """The kept columns (default: all) and what each text holds of the licences of ``library``.

    ``n_words``; ``n_base`` (places of phrases), ``first_word`` and ``last_word`` (the smallest and
    largest word number, from 0, at which one starts; null without one), ``base_labels``;
    ``licences``: spans that cover ``SHARE`` of a template, in code points, with the words
    covered and their share; ``labels``: those of phrases and spans; ``score``: the greatest share,
    or ``PHRASE_SCORE`` where only phrases stand, or 0. Labels are distinct and sorted. Where spans
    of several templates overlap, the one that covers most words stays; ties go to the greater share,
    then to the earlier template.

    A null text is as an empty one: no words, no labels, score 0. Texts of any length are read
    whole, in pieces that no match notices. Every row stays, repeated ones too; no row gives no
    row. A kept column with the name of a new one is left out.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(library or Library())

    def start():
        lib = shared.value

        def compute(texts: pa.Array) -> list[list]:
            rows = []
            for value in texts:
                value = value.as_py()
                found, spans = lib.scan(value)
                base = {lib.phrase_labels[p] for p in found.base}
                shares = [s.covered / lib.sizes[s.template] for s in spans]
                places = offsets(value, spans) if spans else []
                licences = [
                    {"label": lib.labels[s.template], "start": a, "end": b, "covered": s.covered, "share": share}
                    for s, (a, b), share in zip(spans, places, shares, strict=True)
                ]
                rows.append(
                    (
                        found.n_words,
                        found.n_base,
                        found.first_word,
                        found.last_word,
                        sorted(base),
                        sorted(base | {lib.labels[s.template] for s in spans}),
                        max(shares, default=PHRASE_SCORE if base else 0.0),
                        licences,
                    )
                )
            return [list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in range(8)]

        return compute

    return add_columns(docs, [text], FIELDS, start, docs.columns if keep is None else keep)
