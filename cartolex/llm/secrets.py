"""Secret scans: base patterns, and a linear-chain conditional random field over tokens.

Tokens are tagged O, B or I (secret begin, inside). Plain words (letters alone, but for a capital at the start, none of
CUES before them) and tokens of fewer than 8 characters are O as a rule, so that Viterbi decoding falls into the runs of
the other tokens: those between are O whatever they score. Features are the token's shape and parts, its neighbouring
words, and the file's statistics. The field is trained on a bounded sample whose labels are the base patterns' matches.
In training a run's neighbours or its tokens' shapes are hidden at random, so that either must do without the other: so
the field also finds secrets that no base pattern names or spells. What Viterbi tags beyond the base spans is added under
the kind crf where each token is a secret's with a probability (marginal) of SURE or more.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c

# The base patterns, and the lengths below which a match fails.
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST = 12
KINDS = ("assign", "access", "hex", "crf")

TOKEN = re.compile(r"[A-Za-z0-9+/_.@%=-]+|[^\s]")
DIGIT = re.compile("[0-9]")
#: A token that is no plain word: it has a digit, a sign within, or a capital after a small letter; 8 characters or more.
ODD = re.compile(r"(?<![A-Za-z0-9+/_.@%=-])(?=[A-Za-z.-]*(?:[0-9+/_@%=]|[a-z][A-Z]))[A-Za-z0-9+/_.@%=-]{8,}")
#: Words that announce a secret; tokens of 8 characters or more among the next AHEAD ones are looked at whatever they are.
CUES = re.compile(r"(?<![A-Za-z])(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|(?:api|access|private|auth)[ _-]?key)(?![A-Za-z])", re.IGNORECASE)
AHEAD, SHORT = 4, 8
#: The least marginal of an added token. Of a token's neighbours, so many on each side count, within so many characters.
SURE, NEAR, REACH = 0.9, 2, 40
#: Documents that the field is trained on, about; hashed features; passes; step; share of runs with a part hidden.
SAMPLE, FEATURES, PASSES, STEP, L2, HIDDEN = 6000, 1 << 14, 6, 0.2, 1e-4, 0.35
O, B, I = range(3)
MASK = "[SECRET]"


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, end, kind, where the secret itself starts), leftmost and non-overlapping within a kind."""
    out = [(m.start(), m.end(), 0, m.start(2)) for m in ASSIGN.finditer(text) if m.end() - m.start(2) >= LEAST]
    out += [(m.start(), m.end(), 1, m.start()) for m in ACCESS.finditer(text)]
    out += [(m.start(), m.end(), 2, m.start()) for m in HEX.finditer(text)]
    return sorted(out)


def _shape(t: str) -> str:
    s = re.sub("[A-Z]+", "A", re.sub("[a-z]+", "a", t))
    return re.sub(r"(.)\1+", r"\1", re.sub("[0-9]+", "0", s))[:12]


def _hashed(own: list[str], around: list[str]) -> np.ndarray:
    """Features of the token itself in the lower half, of its neighbours in the upper one."""
    half = FEATURES // 2
    return np.array([zlib.crc32(p.encode("utf-8", "surrogatepass")) % half for p in own] + [half + zlib.crc32(p.encode("utf-8", "surrogatepass")) % half for p in around], np.int64)


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(start, end, tokens since the last cue, 0 if none is near) of the tokens that may be secrets, in order."""
    found = {(m.start(), m.end()): 0 for m in ODD.finditer(text)}
    for cue in CUES.finditer(text):
        at = cue.end()
        for k in range(1, AHEAD + 1):
            m = TOKEN.search(text, at, cue.end() + 200)
            if m is None:
                break
            at = m.end()
            if m.end() - m.start() >= SHORT and not CUES.fullmatch(m.group()):
                found[m.start(), m.end()] = k
    out: list[tuple[int, int, int]] = []
    for (a, b), k in sorted(found.items()):
        if out and a < out[-1][1]:
            continue  # a cue inside a token looks at what is left of it
        out.append((a, b, k))
    return out


def islands(text: str) -> list[tuple[list[tuple[int, int]], list[np.ndarray]]]:
    """Runs of tokens that may be secrets, with white space alone between them: their places and their features."""
    found = candidates(text)
    if not found:
        return []
    out: list[tuple[list, list]] = []
    last = -1
    density = "f:digits%d" % min(9, int(30 * len(DIGIT.findall(text)) / len(text)))
    length = "f:size%d" % len(text).bit_length()
    for a, b, cue in found:
        t = text[a:b]
        # Neighbours are whole tokens: one that the reach cuts is left out.
        before = [m.group() for m in TOKEN.finditer(text, max(0, a - REACH), a)]
        if a > REACH and before and not text[a - REACH - 1].isspace() and not text[a - REACH].isspace():
            before = before[1:]
        after = [m.group() for m in TOKEN.finditer(text, b, b + REACH) if m.end() < b + REACH or b + REACH >= len(text)]
        letters, digits, kinds, n = sum(ch.isalpha() for ch in t), sum(ch.isdigit() for ch in t), len(set(t)), b - a
        turns = sum(x.isdigit() != y.isdigit() for x, y in zip(t, t[1:], strict=False))
        own = ["bias", "s:" + _shape(t), "p:" + t[:4], "n%d" % min(12, n // 4), "mix%d" % (4 * digits // n), "d%d" % (4 * kinds // n), "t%d" % (6 * turns // n), density, length]
        own += [f"case{int(t != t.lower())}{int(t != t.upper())}", f"ld{int(letters > 0)}{int(digits > 0)}", "hex%d" % (not t.strip("0123456789abcdefABCDEF")), "mark" + "".join(sorted(set(t) & set("@./+-_=%")))]
        around = ["cue%d" % (cue > 0), "cue:%d" % cue] + [f"b{k}:{w.lower()}" for k, w in enumerate(reversed(before[-NEAR:]))] + [f"a{k}:{w.lower()}" for k, w in enumerate(after[:NEAR])]
        if out and text[last:a].isspace():
            out[-1][0].append((a, b))
            out[-1][1].append(_hashed(own, around))
        else:
            out.append(([(a, b)], [_hashed(own, around)]))
        last = b
    return out


class Field:
    """Weights of a tag for each feature, of tag pairs, and of the tags at the ends (where O lies before and after)."""

    def __init__(self, unary: np.ndarray | None = None, pair: np.ndarray | None = None) -> None:
        self.unary = np.zeros((FEATURES, 3)) if unary is None else unary
        self.pair = np.zeros((3, 3)) if pair is None else pair
        self.forbidden = np.zeros((3, 3))
        self.forbidden[O, I] = -1e9  # an I needs a B or an I before it

    def _scores(self, x: list[np.ndarray]) -> np.ndarray:
        return np.stack([self.unary[f].sum(0) for f in x])

    def viterbi(self, x: list[np.ndarray]) -> list[int]:
        u, p = self._scores(x), self.pair + self.forbidden
        best, back = p[O] + u[0], []
        for k in range(1, len(u)):
            s = best[:, None] + p
            back.append(s.argmax(0))
            best = s.max(0) + u[k]
        tag = int((best + p[:, O]).argmax())
        tags = [tag]
        for b in reversed(back):
            tag = int(b[tag])
            tags.append(tag)
        return tags[::-1]

    def marginals(self, x: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Expected unary (n, 3) and pair (3, 3) counts, the O before and after included."""
        u, p = self._scores(x), self.pair + self.forbidden
        n = len(u)
        f, b = np.zeros((n, 3)), np.zeros((n, 3))
        lse = lambda v, axis: np.logaddexp.reduce(v, axis=axis)
        f[0] = p[O] + u[0]
        for k in range(1, n):
            f[k] = lse(f[k - 1][:, None] + p, 0) + u[k]
        b[-1] = p[:, O]
        for k in range(n - 2, -1, -1):
            b[k] = lse(p + (u[k + 1] + b[k + 1])[None], 1)
        z = lse(f[-1] + b[-1], 0)
        single = np.exp(f + b - z)
        pairs = np.zeros((3, 3))
        pairs[O] += single[0]
        pairs[:, O] += single[-1]
        for k in range(1, n):
            pairs += np.exp(f[k - 1][:, None] + p + (u[k] + b[k])[None] - z)
        return single, pairs


def train(data: list[tuple[list[np.ndarray], list[int]]], seed: int = 5) -> Field:
    """By stochastic gradients of the likelihood, with steps that shrink by each weight's own history.

    Each time a run is met, its neighbours' features or its tokens' own are hidden with a probability of HIDDEN each.
    """
    field = Field()
    gu, gp = np.full((FEATURES, 3), 1e-6), np.full((3, 3), 1e-6)
    rng = np.random.default_rng(seed)
    for _ in range(PASSES):
        for i in rng.permutation(len(data)):
            x, y = data[i]
            hide = rng.random()
            if hide < 2 * HIDDEN:
                x = [f[(f < FEATURES // 2) == (hide < HIDDEN)] for f in x]
            single, pairs = field.marginals(x)
            for k, f in enumerate(x):
                g = single[k].copy()
                g[y[k]] -= 1
                f = np.unique(f)
                d = g[None] + L2 * field.unary[f]
                gu[f] += d * d
                field.unary[f] -= STEP * d / np.sqrt(gu[f])
            path = [O, *y, O]
            for s, t in zip(path, path[1:], strict=False):
                pairs[s, t] -= 1
            pairs += L2 * field.pair
            gp += pairs * pairs
            field.pair -= STEP * pairs / np.sqrt(gp)
    return field


def weak_labels(text: str) -> list[tuple[list[np.ndarray], list[int]]]:
    """The islands of a text with B and I where base patterns match: B begins a match, I goes on with it."""
    base = [(s, e) for _, e, _, s in base_spans(text)]
    out = []
    for places, x in islands(text):
        y, now = [], None
        for a, b in places:
            own = next((s for s in base if s[0] < b and a < s[1]), None)
            y.append(O if own is None else I if own == now else B)
            now = own
        out.append((x, y))
    return out


def fit(docs: DataFrame, sample: int = SAMPLE) -> Field:
    """A field trained on about sample rows of docs (doc_id, text), chosen by a hash of their ids. Without rows it finds nothing."""
    n = docs.count()
    if not n:
        return Field()
    share = min(1.0, sample / n)
    chosen = docs.where(F.pmod(F.xxhash64(F.lit("secrets"), "doc_id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))) if share < 1 else docs

    @c.task
    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for k, (x, y) in enumerate(weak_labels(t or "")):
                    rows.append((doc, k, [f.astype("<i4").tobytes() for f in x], y))
            if rows:
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.list_(pa.binary())), pa.array(cols[3], pa.list_(pa.int32()))], ["doc_id", "n", "x", "y"])

    def learn(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["doc_id", "n"], kind="stable")
        field = train([([np.frombuffer(f, "<i4").astype(np.int64) for f in x], [int(v) for v in y]) for x, y in zip(g["x"], g["y"], strict=True)])
        return pd.DataFrame({"u": [field.unary.astype("<f4").tobytes()], "p": [field.pair.tobytes()]})

    rows = chosen.mapInArrow(label, "doc_id long, n int, x array<binary>, y array<int>").withColumn("one", F.lit(1)).groupBy("one").applyInPandas(learn, "u binary, p binary").collect()
    if not rows:
        return Field()
    return Field(np.frombuffer(rows[0]["u"], "<f4").astype(float).reshape(-1, 3), np.frombuffer(rows[0]["p"]).reshape(3, 3).copy())


def find(text: str, field: Field, sure: float = SURE) -> list[tuple[int, int, int, int]]:
    """Base spans and, apart from them, the field's: (start, end, kind, where the secret starts), in order."""
    out = base_spans(text)
    base = [(s[0], s[1]) for s in out]
    free = lambda a, b: not any(s < b and a < e for s, e in base)
    for places, x in islands(text):
        if all(not free(a, b) for a, b in places):
            continue
        tags = field.viterbi(x)
        if not any(tags):
            continue
        likely = 1 - field.marginals(x)[0][:, O] >= sure
        now: list[int] | None = None
        for (a, b), tag, ok in zip(places, tags, likely, strict=True):
            if tag == O or not ok or not free(a if tag == B or now is None else now[0], b):
                now = None
            elif tag == B or now is None:
                now = [a, b]
                out.append((a, b, 3, a))
            else:
                now[1] = b
                out[-1] = (now[0], b, 3, now[0])
    return sorted(out)


def redact(text: str, found: list[tuple[int, int, int, int]]) -> str:
    """The text with MASK in place of each secret; what names it (password=) stays."""
    out, at = [], 0
    for s, e in sorted((x[3], x[1]) for x in found):
        if e <= at:
            continue
        out += [text[at : max(at, s)], MASK if s >= at else ""]
        at = e
    return "".join(out) + text[at:]


def _joined(found: list[tuple[int, int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k, _ in sorted(found, key=lambda s: (s[0], s[2])))


def scan(docs: DataFrame, field: Field | None = None, sample: int = SAMPLE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for every row of docs (doc_id, text).

    A null text is empty; an empty table has no rows. Rows are scanned each by itself, so repeated rows and ids give
    equal rows, and texts may be of any length; other columns, whatever their names, are not read. Spans that start
    together go by their kinds; an added span never overlaps a base one.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    field = field or fit(docs, sample)

    @c.task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in c.blocks(batches):
            rows = []
            for t in b.column(1).to_pylist():
                found = find(t or "", field)
                base = [s for s in found if s[2] < 3]
                rows.append((*(sum(s[2] == k for s in base) for k in range(3)), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(found)))
            x = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(v, pa.int64()) for v in x[:3]), pa.array(x[3]), pa.array(x[4])], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact_documents(docs: DataFrame, field: Field | None = None, sample: int = SAMPLE) -> DataFrame:
    """docs with every secret in text masked and n_chars (if there) the new length; null texts and other columns stay."""
    field = field or fit(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), sample)
    names = docs.columns
    text, chars = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    @c.task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in c.blocks(batches):
            old = b.column(text).to_pylist()
            new = [t if t is None else redact(t, found) if (found := find(t, field)) else t for t in old]
            columns = list(b.columns)
            columns[text] = pa.array(new, pa.string())
            if chars is not None:
                was = columns[chars].to_pylist()
                columns[chars] = pa.array([w if a == t else len(t) for w, a, t in zip(was, old, new, strict=True)], columns[chars].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, docs.schema)


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(c.table(spark, sf_dir, "documents"))
