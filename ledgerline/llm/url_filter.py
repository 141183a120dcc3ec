"""URL rules as one bit-parallel automaton.

Every glob is a row of states, one bit each, packed into 64-bit words. One pass
over the bytes of a batch of URLs moves all states of all globs of all URLs
together: shift, mask by the byte read, and keep the states that a wildcard
lets stand still.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import apply_arrow, as_bytes


@dataclass(frozen=True)
class HostRule:
    """Fits the host and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def globs(self) -> tuple[str, str]:
        literal = "".join("\\" + c if c in "*\\" else c for c in self.name)
        return literal + "**", "*." + literal + "**"


@dataclass(frozen=True)
class Glob:
    """Matches the whole ``host/path``: ``*`` stays within a segment, ``**`` crosses slashes, a backslash quotes."""

    verdict: str
    pattern: str


RULES = (
    HostRule("allow", "com", "/"),
    HostRule("block", "example.com", "/en/"),
    HostRule("allow", "www.example.com", "/en/"),
    HostRule("block", "net", "/es/"),
    HostRule("block", "net", "/fr/"),
)
GLOBS = (
    Glob("block", "*ads-track**"),
    Glob("block", "*tracker.**"),
    Glob("block", "**/cgi-bin/**"),
    Glob("block", "**.exe"),
)


def _states(pattern: str) -> list[tuple[bytes, str]]:
    """(byte that leads into the state, wildcard that lets it stand still); the first is the start."""
    states: list[tuple[bytes, str]] = [(b"", "")]
    i = 0
    while i < len(pattern):
        if pattern[i] == "*":
            wide = pattern.startswith("**", i)
            states[-1] = (states[-1][0], "**" if wide or states[-1][1] == "**" else "*")
            i += 2 if wide else 1
            continue
        i += pattern[i] == "\\"
        states += [(bytes([b]), "") for b in pattern[i : i + 1].encode()]
        i += 1
    return states


class Automaton:
    """Masks of all globs; ``match`` gives the hits of a batch of byte strings."""

    def __init__(self, patterns: Sequence[str]):
        chains = [_states(p) for p in patterns]
        width = (sum(map(len, chains)) + 63) // 64 or 1
        self.step = np.zeros((256, width), np.uint64)
        self.stay = np.zeros((256, width), np.uint64)
        self.start = np.zeros(width, np.uint64)
        self.ends: list[tuple[int, np.uint64]] = []
        bit = 0
        for chain in chains:
            for k, (lead, loop) in enumerate(chain):
                word, mask = bit // 64, np.uint64(1 << bit % 64)
                if k == 0:
                    self.start[word] |= mask
                else:
                    self.step[lead[0], word] |= mask
                if loop:
                    self.stay[:, word] |= mask
                if loop == "*":
                    self.stay[ord("/"), word] &= ~mask
                bit += 1
            self.ends.append((word, mask))

    def match(self, texts: Sequence[bytes]) -> np.ndarray:
        """Boolean matrix, texts by globs."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        order = np.argsort(-lengths, kind="stable")
        flat = np.frombuffer(b"".join(texts), np.uint8)
        offsets = (np.cumsum(lengths) - lengths)[order]
        falling = lengths[order]
        state = np.repeat(self.start[None, :], len(texts), axis=0)
        live = len(texts)
        for t in range(int(falling[0]) if live else 0):
            while live and falling[live - 1] <= t:
                live -= 1
            read = flat[offsets[:live] + t]
            now = state[:live]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:live] = (moved & self.step[read]) | (now & self.stay[read])
        hits = np.empty((len(texts), len(self.ends)), bool)
        for k, (word, mask) in enumerate(self.ends):
            hits[order, k] = (state[:, word] & mask) != 0
        return hits


_HOST_PATH = re.compile(rb"([^/?#]*)([^?#]*)")


def split_url(url: bytes) -> tuple[bytes, bytes]:
    """Host, A-Z lower-cased, and path; both empty without ``://``."""
    _, found, rest = url.partition(b"://")
    host, path = _HOST_PATH.match(rest).groups() if found else (b"", b"")
    return host.lower(), path


def filter_urls(
    pages: DataFrame,
    url: str = "url",
    rules: Sequence[HostRule] = RULES,
    globs: Sequence[Glob] = GLOBS,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add host, path, rule and verdict to every row.

    The longest host rule that fits decides; else the longest glob; else the page
    is allowed. Of equally long ones the first listed wins. A null url, or one
    without ``://``, has an empty host and path, fits no host rule and is
    blocked, since nothing can be fetched from it. Repeated rows stay; columns
    named host, path, rule or verdict are replaced; an empty table gives none.
    """
    patterns = [g for r in rules for g in r.globs()] + [g.pattern for g in globs]
    owner = [k for k in range(len(rules)) for _ in range(2)] + [len(rules) + k for k in range(len(globs))]
    length = [len(r.name) for r in rules] + [len(g.pattern) for g in globs]
    verdicts = [r.verdict for r in rules] + [g.verdict for g in globs]
    labels = [r.name for r in rules] + [None] * len(globs)
    # later ones overwrite: globs below host rules, short below long, late below early
    ranking = sorted(range(len(patterns)), key=lambda k: (owner[k] < len(rules), length[owner[k]], -owner[k]))

    def make():
        automaton = Automaton(patterns)

        def work(urls):
            parts = [split_url(u) for u in as_bytes(urls)]
            hits = automaton.match([h + p for h, p in parts])
            hits &= np.fromiter((bool(h) for h, _ in parts), bool, len(parts))[:, None]
            best = np.full(len(parts), -1)
            for k in ranking:
                best[hits[:, k]] = owner[k]
            found = best.tolist()
            rule = [labels[b] if b >= 0 else None for b in found]
            verdict = [verdicts[b] if b >= 0 else "allow" if h else "block" for b, (h, _) in zip(found, parts)]
            texts = [pa.array([x[i] for x in parts], pa.binary()).cast(pa.string()) for i in (0, 1)]
            return [*texts, pa.array(rule, pa.string()), pa.array(verdict, pa.string())]

        return work

    return apply_arrow(pages, [url], "host string, path string, rule string, verdict string", make, keep=keep)
