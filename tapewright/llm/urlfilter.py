"""Allow and block rules for URLs, held in a trie of reversed host labels and path segments."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame

from tapewright.llm.columns import add_columns

ALLOW, BLOCK = "allow", "block"
# Rules of one broadcast trie; longer lists are matched in further passes.
TRIE_RULES = 1_000_000


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


class _Path:
    """A place after whole path segments: rules that end inside the next one, by its beginning."""

    __slots__ = ("ends", "next")

    def __init__(self):
        self.ends: dict[str, Rule] = {}
        self.next: dict[str, _Path] = {}


class _Host:
    __slots__ = ("labels", "paths")

    def __init__(self):
        self.labels: dict[str, _Host] = {}
        self.paths: _Path | None = None


def _rank(rule: Rule) -> tuple[int, int, bool]:
    """Longer text first; then the longer host; then block."""
    return len(rule.host) + len(rule.path), len(rule.host), rule.verdict == BLOCK


class Trie:
    def __init__(self, rules: Iterable[Rule]):
        self.root = _Host()
        for rule in rules:
            node = self.root
            for label in reversed(rule.host.split(".")):
                node = node.labels.setdefault(label, _Host())
            node.paths = node.paths or _Path()
            at = node.paths
            *whole, rest = rule.path.split("/")
            for segment in whole:
                at = at.next.setdefault(segment, _Path())
            old = at.ends.get(rest)
            if old is None or _rank(rule) > _rank(old):
                at.ends[rest] = rule

    def match(self, host: str, path: str) -> Rule | None:
        """The longest rule whose host is the url's or a parent of it and whose path begins its."""
        best, segments, node = None, None, self.root
        for label in reversed(host.split(".")):
            node = node.labels.get(label)
            if node is None:
                break
            if node.paths is None:
                continue
            segments = path.split("/") if segments is None else segments
            at = node.paths
            for i, segment in enumerate(segments):
                for rest, rule in at.ends.items() if len(at.ends) < 9 else _ends(at, segment):
                    if segment.startswith(rest) and (best is None or _rank(rule) > _rank(best)):
                        best = rule
                at = at.next.get(segment) if i < len(segments) - 1 else None
                if at is None:
                    break
        return best


def _ends(at: _Path, segment: str):
    """What fits a segment, found by its beginnings where there are many rules."""
    return [(b, at.ends[b]) for i in range(len(segment) + 1) if (b := segment[:i]) in at.ends]


_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty for null or a url without ``://``."""
    if url is None or (at := url.find("://")) < 0:
        return "", ""
    rest = url[at + 3 :]
    end = min((i for i in (rest.find("?"), rest.find("#")) if i >= 0), default=len(rest))
    slash = rest.find("/", 0, end)
    if slash < 0:
        return rest[:end].translate(_LOWER), ""
    return rest[:slash].translate(_LOWER), rest[slash:end]


def judge(
    pages: DataFrame,
    rules: list[Rule],
    url: str = "url",
    default: str = ALLOW,
    keep=None,
    trie_rules: int = TRIE_RULES,
) -> DataFrame:
    """The kept columns (default: all) with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rule`` is the text of the longest rule that fits, null if none does; then the verdict is
    ``default``. Of equally long rules the one with the longer host wins, then block over allow.
    A rule with an empty host fits no url. Equal rules count once. Rules come as a list; each
    trie holds at most ``trie_rules`` of them, and further ones are matched in further passes over
    the rows, without a shuffle. A null url, one without ``://`` and one without a host have an empty
    host, no rule and the default verdict. Urls of any length are read whole. Every row stays,
    repeated ones too; an empty table gives no row. Columns already named like the new ones are
    replaced.
    """
    rules = [r for r in dict.fromkeys(rules) if r.host]
    kept = list(pages.columns if keep is None else keep)
    parts = [rules[i : i + trie_rules] for i in range(0, len(rules), trie_rules)] or [[]]
    fields = "host string, path string, rule string, verdict string"
    out, context = pages, pages.sparkSession.sparkContext
    for i, part in enumerate(parts):
        last = i == len(parts) - 1
        shared = context.broadcast(part)

        def start(shared=shared, first=i == 0):
            trie = Trie(shared.value)

            def compute(urls, hosts=None, old_rules=None, old_verdicts=None):
                if first:
                    split = [split_url(u) for u in urls.to_pylist()]
                    before = [None] * len(split)
                else:
                    split = [split_url(u) for u in urls.to_pylist()]
                    before = [
                        None if r is None else Rule(v, r[: (n := r.index("/"))], r[n:])
                        for r, v in zip(
                            old_rules.to_pylist(), old_verdicts.to_pylist(), strict=True
                        )
                    ]
                texts, verdicts = [], []
                for (host, path), old in zip(split, before, strict=True):
                    new = trie.match(host, path) if host else None
                    if old is not None and (new is None or _rank(old) > _rank(new)):
                        new = old
                    texts.append(None if new is None else new.host + new.path)
                    verdicts.append(default if new is None else new.verdict)
                return [[h for h, _ in split], [p for _, p in split], texts, verdicts]

            return compute

        passed = kept if last else [*dict.fromkeys([*kept, url])]
        inputs = [url] if i == 0 else [url, "host", "rule", "verdict"]
        out = add_columns(out, inputs, fields, start, passed)
    return out
