"""Where a text may be cut: boundary candidates, safety tests, quality; and a tokenizer that needs no files."""

from __future__ import annotations

import bisect
import itertools
import re
from functools import cached_property

import numpy as np

# What marks a boundary, with its priority, in the order of preference.
HEADER_WORDS = ("Глава", "Параграф", "Часть", "Chapter", "Section", "Раздел", "Урок", "Тема")
ABBREVIATIONS = ("Dr", "Mr", "Mrs", "Ms", "Prof", "St", "vs", "etc", "т.д", "т.п", "и.д", "и.п")
BOUNDARIES = (
    (1, "html_header", re.compile(r"(?:^|\n)(?=<h[1-6][^>]*>)")),
    (1, "markdown_header", re.compile(r"(?:^|\n)(?=#{1,6}\s+)")),
    (1, "text_header", re.compile(rf"(?:^|\n)(?=(?:{'|'.join(HEADER_WORDS)})\s+)", re.IGNORECASE)),
    (2, "subheader", re.compile(r"(?:^|\n)(?=#{2,4}\s+)")),
    (2, "paragraph", re.compile(r"\n\n+")),
    (2, "code_block_end", re.compile(r"```\s*\n")),
    (3, "sentence", re.compile(r"[.!?]\s+")),
    (4, "line", re.compile(r"\n")),
    (5, "phrase", re.compile(r"[,;:]\s+")),
    (6, "word", re.compile(r"\s+")),
)
SOFT = (
    (1, re.compile(r"</h[1-6]>\s*(?=\n|$)", re.IGNORECASE)),
    (1, re.compile(r"(?:^|\n)#{1,6}\s+.*?(?=\n|$)")),
    (1, re.compile(rf"(?:^|\n)(?:{'|'.join(HEADER_WORDS)})\s+.*?(?=\n|$)", re.IGNORECASE | re.MULTILINE)),
    (2, re.compile(r"\n\n+")),
    (2, re.compile(r"(?:^|\n)```\s*(?=\n|$)")),
    (2, re.compile(r"(?:^|\n)\$\$\s*(?=\n|$)")),
    (2, re.compile(r"</a>|\]\([^)]+\)")),
    (3, re.compile(r"[.!?]\s+")),
    (3, re.compile(r";\s+")),
    (4, re.compile(r",\s+")),
    (4, re.compile(r":\s+")),
    (4, re.compile(r"\s+[—–-]\s+")),
    (5, re.compile(r"\s+")),
)
LIST_ITEMS = tuple(
    re.compile(x)
    for x in (
        r"\d+\.\s+",
        r"  \d+\.\s+",
        r"  [a-z]\.\s+",
        r"\t\d+\.\s+",
        r"\t[a-z]\.\s+",
        r"[-*+]\s+",
        r"  [-*+]\s+",
        r"\t[-*+]\s+",
        r"•\s+",
        r"  •\s+",
    )
)
URL = re.compile(r"(https?://)[^\s\)>\]]*")
#: Lines around a cut in which list items and table rows count; characters before it in which HTML tables do.
LIST_LINES, TABLE_LINES, HTML_CHARS = 3, 5, 200
QUALITY = (
    (1.0, re.compile(r"</h[1-6]>\s*$", re.IGNORECASE)),
    (1.0, re.compile(r"\n#{1,6}\s+.*$")),
    (1.0, re.compile(r"\n(?:Глава|Chapter|Раздел)\s+.*$", re.IGNORECASE)),
    (5.0, re.compile(r"\n\n\Z")),
    (10.0, re.compile(r"[.!?]\s*$")),
    (15.0, re.compile(r"\n\Z")),
    (20.0, re.compile(r"[,;]\s*$")),
    (50.0, re.compile(r" \Z")),
)
MOST = 50
TOKEN = re.compile(r"\s?\w{1,6}|\s|[^\w\s]")


def truncated(text: str, limit: int, keep: int | None = None) -> str:
    """A text of more than `limit` tokens cut to its first `keep` (`limit` if not given); others as they are."""
    if len(text) <= limit:  # no token is empty
        return text
    tokens = Tokens(text)
    return text if len(tokens) <= limit else text[: tokens.at[limit if keep is None else keep]]


class Tokens:
    """A text as tokens, by their character offsets: runs of up to six word characters with a white space before, and
    other characters by themselves. Another tokenizer may be put in its place by giving its offsets."""

    def __init__(self, text: str, ends: list[int] | None = None) -> None:
        self.text = text
        # Each character is in a token, so that their lengths add up to their ends.
        self.at = [0, *(itertools.accumulate(map(len, TOKEN.findall(text))) if ends is None else ends)]

    def __len__(self) -> int:
        return len(self.at) - 1

    def nearest(self, char: int) -> int:
        """The token boundary nearest to a character offset, the later of two that are as near."""
        i = bisect.bisect_left(self.at, char)
        if i >= len(self.at):
            return len(self.at) - 1
        if i and self.at[i] - char > char - self.at[i - 1]:
            return i - 1
        return i


class Layout:
    """What is open at each place of a text, for all places (0 to its length) at once: one array of flags a construct.

    Constructs are spans painted into an array, or the sign of a running balance. Lists are looked at place by place,
    since few places are asked for.
    """

    def __init__(self, text: str) -> None:
        self.text, self.n = text, len(text)
        self.code_points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)

    def _painted(self, spans) -> np.ndarray:
        """Flags of the places from the first to before the second of each span."""
        step = np.zeros(self.n + 2, np.int64)
        for a, b in spans:
            step[min(a, self.n + 1)] += 1
            step[min(max(a, b), self.n + 1)] -= 1
        return np.cumsum(step)[: self.n + 1] > 0

    def _passed(self, char: str) -> np.ndarray:
        """How many of a character lie before each place."""
        return np.concatenate([[0], np.cumsum(self.code_points == ord(char))])

    def _found(self, literal: str) -> list[int]:
        return [m.start() for m in re.finditer(re.escape(literal), self.text)]

    @cached_property
    def word(self) -> np.ndarray:
        own = np.fromiter(map(str.isalnum, self.text), bool, self.n)
        return np.concatenate([[False], own[:-1] & own[1:], [False]]) if self.n else np.zeros(1, bool)

    @cached_property
    def url(self) -> np.ndarray:
        """Within an address; after one line break at its end too, if a character of an address follows."""
        found = [m.span() + (m.end(1),) for m in URL.finditer(self.text)]
        wrapped = [b + 1 for _, b, _ in found if re.match(r"\n[^\s\)>\]]", self.text[b : b + 2])]
        return self._painted([(a, b) for _, b, a in found] + [(q, q + 1) for q in wrapped])

    @cached_property
    def link(self) -> np.ndarray:
        """Inside square brackets, between them and the round ones, and up to ten characters from a "](h" on."""
        out = self._passed("[") > self._passed("]")
        turns = np.array(self._found("]("), np.int64)
        out[turns + 1] = True
        out[turns + 2] |= self._passed("(")[turns + 2] > self._passed(")")[turns + 2]
        return out | self._painted((q + 3, q + 11) for q in self._found("](h"))

    @cached_property
    def tag(self) -> np.ndarray:
        """After a < that no > has followed yet."""
        place = np.arange(1, self.n + 1)
        latest = lambda ch: np.concatenate([[0], np.maximum.accumulate(np.where(self.code_points == ord(ch), place, 0))])
        return latest("<") > latest(">")

    @cached_property
    def formula(self) -> np.ndarray:
        return self._passed("$") % 2 == 1

    @cached_property
    def code(self) -> np.ndarray:
        fences = [q + 3 for q in self._found("```")]
        return self._painted(zip(fences[::2], [*fences[1::2], self.n + 1], strict=False))

    @cached_property
    def lines(self) -> list[tuple[int, int]]:
        ends = [*self._found("\n"), self.n]
        return list(zip([0, *[e + 1 for e in ends[:-1]]], ends, strict=True))

    def _item(self, a: int, b: int) -> bool:
        return any(x.match(self.text, a, b) for x in LIST_ITEMS)

    def list_at(self, at: int) -> bool:
        """Whether an item begins at the place and another began in the lines that end there."""
        k = bisect.bisect_right(self.lines, (at, self.n + 1)) - 1
        a, b = self.lines[k]
        if not 0 < at < self.n or not self._item(at, b):
            return False
        return self._item(a, at) or any(self._item(*x) for x in self.lines[max(0, k + 1 - LIST_LINES) : k])

    @cached_property
    def table(self) -> np.ndarray:
        """Between rows (lines that begin with a bar and have another), or after a <table that is not closed."""
        spans = []
        bars = np.flatnonzero(self.code_points == ord("|"))
        if len(bars):
            own = [bars[np.searchsorted(bars, a) : np.searchsorted(bars, b)].tolist() for a, b in self.lines]
            led = [bool(len(x) > 1 and not self.text[a : x[0]].strip()) for x, (a, _) in zip(own, self.lines, strict=True)]
            for k, (a, b) in enumerate(self.lines):
                above, below = any(led[max(0, k + 1 - TABLE_LINES) : k]), any(led[k + 1 : k + TABLE_LINES])
                # From where the line itself is a row above, and where what is left of it is a row below.
                down = a if above else own[k][1] + 1 if led[k] else b + 1
                rests = [(a, b + 1)] if below else [(len(self.text[a:x].rstrip()) + a, x + 1) for x in own[k][:-1]]
                spans += [(max(down, p), q) for p, q in rests if max(down, p) < q]
        opened = np.zeros(self.n + 2 + HTML_CHARS, np.int64)
        for literal, sign in (("<table", 1), ("</table>", -1)):
            for q in self._found(literal):
                opened[q + len(literal)] += sign
                opened[q + HTML_CHARS + 1] -= sign
        out = self._painted(spans) | (np.cumsum(opened)[: self.n + 1] > 0)
        out[[0, self.n]] = False
        return out

    def is_open(self, at: int) -> bool:
        """Whether a cut here would split a word, URL, link, tag, formula, code block, list or table."""
        return bool(self.word[at] or self.url[at] or self.link[at] or self.tag[at] or self.formula[at] or self.code[at] or self.table[at] or self.list_at(at))


def safe(before: str, after: str) -> bool:
    return not Layout(before + after).is_open(len(before))


def quality(before: str) -> float:
    """Lower is better; 100 where nothing ends."""
    tail = before[-50:]
    return next((score for score, pattern in QUALITY if pattern.search(tail)), 100.0)


def candidates(text: str, target: int, shift: int) -> list[tuple[int, str, int]]:
    """(position, kind, priority) of boundaries within shift characters of target, the best 50 by priority and distance."""
    low, high = max(0, target - shift), min(len(text), target + shift)
    found = []
    for priority, kind, pattern in BOUNDARIES:
        for m in pattern.finditer(text):
            if low <= m.end() <= high and not (kind == "sentence" and text[max(0, m.start() - 10) : m.start()].endswith(ABBREVIATIONS)):
                found.append((priority * 1000 + abs(m.end() - target), m.end(), kind, priority))
    return [(at, kind, priority) for _, at, kind, priority in sorted(found)[:MOST]]


def token_boundary(tokens: Tokens, target: int, shift: int) -> tuple[int, str]:
    """The best safe cut within shift tokens of target, and its kind: a boundary's, fallback (any safe place), or none.

    Named boundaries cost their priority times 1000 plus the tokens from target; where none is safe, every place costs
    its quality plus a tenth of them. The cheapest wins, and of equal ones the first.
    """
    n = len(tokens)
    if not n:
        return 0, "empty"
    wanted = min(target, n)
    low, high, centre = max(0, wanted - shift), min(n, wanted + shift), max(0, wanted)
    if high < low:
        return 0, "edge"
    first, stop = max(0, centre - shift), min(n, centre + shift + 1)
    base = tokens.at[first]
    part = tokens.text[base : tokens.at[stop]]
    layout = Layout(part)

    def named():
        for k, (at, kind, priority) in enumerate(candidates(part, tokens.at[centre] - base, 4 * shift)):
            i = min(max(tokens.nearest(base + at), first), stop)
            yield 1000 * priority + abs(i - centre), k, i, kind

    def plain():
        for i in range(low, high + 1):
            end = tokens.at[i] - base
            yield quality(part[max(0, end - 50) : end]) + 0.1 * abs(i - centre), i, i, "fallback"

    for options in (named, plain):
        for _, _, i, kind in sorted(options()):
            if low <= i <= high and not layout.is_open(tokens.at[i] - base):
                return i, kind
    return centre, "none"


def boundary(tokens: Tokens, target: int, shift: int, most: int) -> int:
    """token_boundary(), or else the first safe cut further on, then further back, in steps of 10 tokens up to 30 % of the
    window; or else the end of the normal range."""
    best, kind = token_boundary(tokens, target, shift)
    if kind not in ("none", "empty", "edge"):
        return best
    layout, further = Layout(tokens.text), range(shift + 1, int(most * 0.3), 10)
    places = [i for way in (1, -1) for k in further if 0 < (i := target + way * k) < len(tokens)]
    return next((i for i in places if not layout.is_open(tokens.at[i])), min(len(tokens), target + shift))


def soft_boundary(text: str | None, target: int, shift: int) -> int | None:
    """The boundary of least weight times distance within shift characters (a tenth less after target), if any."""
    if not text or not 0 <= target <= len(text) or shift < 0:
        return None
    best = None
    for weight, pattern in SOFT:
        for m in pattern.finditer(text):
            at = m.end()
            if abs(at - target) > shift:
                continue
            if weight == 3 and text[m.start()] != ";" and (not m.start() or text[max(0, m.start() - 10) : m.start()].strip().endswith(ABBREVIATIONS)):
                continue
            score = weight * abs(at - target) * (0.9 if at > target else 1)
            if best is None or score < best[0]:
                best = (score, at)
    return best and best[1]
