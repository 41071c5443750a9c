"""Language-model scores: unigram base and a smoothed bigram model, with counts over all training documents.

Documents are dealt to chunks of bounded size. Each chunk sends its distinct words and word pairs with their training
counts to shards. A word's shard adds its counts up and answers each chunk with the totals that differ from its own. A
pair's shard is that of its context (of a part of its successors, where there are many shards): it adds the counts up,
builds its part of the model once, as an Elias-Fano trie with quantised logarithms of the counts in one memory map, and
answers the pairs of every chunk by searches among their context's successors. A chunk makes Dirichlet-smoothed
probabilities of the answers and the exact counts of its words. So a table of words or pairs is never in one place, and
frequent ones cost a chunk no more than rare ones.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c
from .ngramtrie import Quantiser, Trie

#: Weight of the unigram distribution in a context, in counts (Dirichlet smoothing).
PRIOR = 5.0
#: Added to each count of the base.
ADD = 0.1
#: The hash that stands for the end of a text, which also comes before its first word.
END = 0x5BD1E995A3C59AC3
#: Chunks at least, and bytes of the table (as Spark estimates it) that a chunk gets.
CHUNKS, CHUNK_BYTES = 12, 8 << 20
#: Shards up to which there is one for each chunk; beyond it they grow with the square root of what a chunk adds.
SHARDS = 1024
#: A context's successors are split among so many shards as one in SPLIT of all.
SPLIT = 16
#: Decimal logarithms of counts that the trie's 16 bits span.
LARGEST = 14.0
_zstd = pa.Codec("zstd", 1)


def _squeeze(x: np.ndarray) -> bytes:
    """Integers as byte planes, compressed."""
    raw = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()
    return len(raw).to_bytes(8, "little") + _zstd.compress(raw, asbytes=True)


def _expand(b: bytes, dtype: str) -> np.ndarray:
    size = int.from_bytes(b[:8], "little")
    raw = np.frombuffer(_zstd.decompress(b[8:], size, asbytes=True) if size else b"", np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


class Grams:
    """A chunk's tokens: distinct words and pairs with their training counts, both sorted by global key."""

    def __init__(self, ids: list, texts: pa.Array, by: int) -> None:
        self.train = np.array([c.id_remainder(i, by) != 0 for i in ids], bool)
        parts, sizes = [], []
        batch = pa.RecordBatch.from_arrays([texts], ["text"])
        for b in c.blocks(iter([batch])):
            data, off = c.raw(c.fill(b.column(0)))
            data = c.LOWER[data]
            start, end, row = c.runs(~c.SPACE[data], off)
            parts.append(c.span_hash(data, start, end))
            sizes.append(np.bincount(row, minlength=b.num_rows))
        words = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        size = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        n = len(ids)
        self.size = size + 1
        stop = np.cumsum(self.size)
        token = np.empty(int(stop[-1]) if n else 0, np.uint64)
        ends = np.zeros(len(token), bool)
        ends[stop - 1] = True
        token[ends] = np.uint64(END)
        token[~ends] = words
        self.row = np.repeat(np.arange(n), self.size)
        known = self.train[self.row]
        self.word, self.at = np.unique(np.append(token, np.uint64(END)), return_inverse=True)
        end = self.at[-1]
        self.at = self.at[:-1]
        before = np.concatenate([[end], self.at[:-1]]) if len(self.at) else self.at
        before[np.concatenate([[0], stop[:-1]])[: n]] = end
        self.count = np.bincount(self.at, known, len(self.word)).astype(np.int64)
        # Words are sorted by their hashes, and so are pairs by the context's hash, then the next word's.
        pair, self.pair_at = np.unique(before * len(self.word) + self.at, return_inverse=True)
        self.context, self.next = pair // len(self.word), pair % len(self.word)
        self.pair_count = np.bincount(self.pair_at, known, len(pair)).astype(np.int64)

    def words_by_shard(self, shards: int) -> np.ndarray:
        """Where each shard's words begin: shards are equal ranges of the hash's first 32 bits."""
        first = (np.arange(shards + 1, dtype=object) << 32) // shards
        at = np.searchsorted(self.word, np.array([min(int(x) << 32, (1 << 64) - 1) for x in first], np.uint64))
        at[-1] = len(self.word)
        return at

    def pairs_by_shard(self, shards: int) -> tuple[np.ndarray, np.ndarray]:
        """The pairs in the order of their shards (within one as they are), and where each shard's begin."""
        parts = max(1, shards // SPLIT)
        part = (self.word[self.next] >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
        with np.errstate(over="ignore"):
            h = c.mix(self.word[self.context] + part * np.uint64(0x9E3779B97F4A7C15))
        shard = ((h >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        return order, np.searchsorted(shard[order], np.arange(shards + 1))


def _runs(context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    head = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
    return head, np.diff(np.append(head, len(context)))


_SENT = "shard int, chunk int, kind int, keys binary, more binary, next binary, counts binary"


def _counts(shards: int, by: int):
    def run(t: pa.Table) -> pa.Table:
        chunk = t["chunk"][0].as_py()
        g = Grams(t["doc_id"].to_pylist(), c.fill(t["text"]), by)
        rows = []
        steps = lambda k: _squeeze(np.diff(k, prepend=np.uint64(0)))
        at = g.words_by_shard(shards)
        for s in np.flatnonzero(at[1:] > at[:-1]).tolist():
            own = slice(at[s], at[s + 1])
            rows.append((s, chunk, 0, steps(g.word[own]), b"", b"", _squeeze(g.count[own].astype(np.uint32))))
        order, at = g.pairs_by_shard(shards)
        for s in np.flatnonzero(at[1:] > at[:-1]).tolist():
            own = order[at[s] : at[s + 1]]
            context = g.context[own]
            head, size = _runs(context)
            # A successor is known by 48 bits, which tell it apart from the context's others.
            rows.append((s, chunk, 1, steps(g.word[context[head]]), _squeeze(size.astype(np.uint32)), _squeeze(g.word[g.next[own]] >> np.uint64(16)), _squeeze(g.pair_count[own].astype(np.uint32))))
        x = list(zip(*rows, strict=True))
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
        return pa.table([pa.array(v, kind) for v, kind in zip(x, kinds, strict=True)], [f.split()[0] for f in _SENT.split(", ")])

    return run


def _word_answers(own: pd.DataFrame, shard: int) -> list[tuple]:
    """For each chunk the places of words whose total is not its own count, and the totals; and how many there are."""
    keys = [np.cumsum(_expand(b, "u8"), dtype=np.uint64) for b in own["keys"]]
    counts = [_expand(b, "u4").astype(np.int64) for b in own["counts"]]
    every, which = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(which, np.concatenate(counts), len(every)).astype(np.int64)
    out = [(-1, shard, 0, b"", b"", int(total.sum()), int((total > 0).sum()))]
    at = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
    for i, chunk in enumerate(own["chunk"]):
        new = total[which[at[i] : at[i + 1]]]
        place = np.flatnonzero(new != counts[i])
        if len(place):
            out.append((int(chunk), shard, 0, _squeeze(np.diff(place, prepend=0).astype(np.uint32)), _squeeze(new[place].astype(np.uint64)), 0, 0))
    return out


def build_trie(context: np.ndarray, word: np.ndarray, counts: np.ndarray) -> Trie:
    """The trie of the pairs that occur in training, with the logarithms of their summed counts; ids from 0, in any order."""
    wide = int(word.max(initial=0)) + 1
    key, which = np.unique(context * wide + word, return_inverse=True)
    total = np.bincount(which, counts, len(key))
    key, total = key[total > 0], total[total > 0]
    return Trie.build(int(context.max(initial=-1)) + 1, key // wide, key % wide, np.log10(total), 0.0, LARGEST).mapped()


def _pair_answers(own: pd.DataFrame, shard: int) -> list[tuple]:
    """For each chunk what the shard's trie says of its pairs, in their order."""
    runs = [_expand(b, "u4").astype(np.int64) for b in own["more"]]
    heads = [np.cumsum(_expand(b, "u8"), dtype=np.uint64) for b in own["keys"]]
    nexts = [_expand(b, "u8") for b in own["next"]]
    size = [len(x) for x in nexts]
    _, head = np.unique(np.concatenate(heads), return_inverse=True)
    context = np.repeat(head, np.concatenate(runs))
    _, word = np.unique(np.concatenate(nexts), return_inverse=True)
    trie = build_trie(context, word, np.concatenate([_expand(b, "u4") for b in own["counts"]]))
    at = np.concatenate([[0], np.cumsum(size)])
    out = []
    for i, chunk in enumerate(own["chunk"]):
        ask = slice(at[i], at[i + 1])
        out.append((int(chunk), shard, 1, b"", _squeeze(trie.lookup(context[ask], word[ask]).astype(np.uint32)), 0, 0))
    return out


def _answers(g: pd.DataFrame) -> pd.DataFrame:
    shard, out = int(g["shard"].iloc[0]), []
    for kind, own in g.groupby("kind"):
        out += (_pair_answers if kind else _word_answers)(own, shard)
    c.tidy()
    return pd.DataFrame(out, columns=["chunk", "shard", "kind", "places", "totals", "tokens", "words"])


_ANSWER = "chunk int, shard int, kind int, places binary, totals binary, tokens long, words long"
_SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(shards: int, by: int, prior: float):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        names = [f.split()[0] for f in _SCORED.split(", ")]
        types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        if not docs.num_rows:
            return pa.table([pa.array([], t) for t in types], names)
        g = Grams(docs["doc_id"].to_pylist(), c.fill(docs["text"]), by)
        n, v = docs["all_tokens"][0].as_py(), docs["all_words"][0].as_py()
        count, code = g.count.copy(), np.zeros(len(g.context), np.int64)
        word_at, (order, pair_at) = g.words_by_shard(shards), g.pairs_by_shard(shards)
        for shard, kind, places, totals in zip(*(answers[k].to_pylist() for k in ("shard", "kind", "places", "totals")), strict=True):
            if kind:
                code[order[pair_at[shard] : pair_at[shard + 1]]] = _expand(totals, "u4")
            else:
                count[word_at[shard] + np.cumsum(_expand(places, "u4"), dtype=np.int64)] = _expand(totals, "u8")
        count = count.astype(float)
        unigram = (count + ADD) / (n + ADD * (v + 1))
        seen = np.where(code > 0, 10.0 ** Quantiser(0.0, LARGEST).value(code - 1), 0.0)
        pair = np.log10((seen + prior * unigram[g.next]) / (count[g.context] + prior))
        rows = len(g.size)
        base = np.bincount(g.row, np.log10(count + ADD)[g.at], rows) - g.size * np.log10(n + ADD * (v + 1))
        known = np.bincount(g.row, (count > 0)[g.at], rows).astype(np.int64)
        score = np.bincount(g.row, pair[g.pair_at], rows)
        columns = [docs["doc_id"], pa.array(~g.train), pa.array(g.size), pa.array(known), pa.array(np.full(rows, n)), pa.array(base), pa.array(score)]
        out = pa.table([x.cast(t) for x, t in zip(columns, types, strict=True)], names)
        del g, pair, count, code, order
        c.tidy()
        return out

    return run


def _numbers(spark: SparkSession, k: int) -> list[int]:
    """k numbers that hash to the k partitions of a shuffle one each (almost: a partition that none of 16 k tries hits
    shares another's)."""
    tried = spark.range(16 * k).select(F.col("id").cast("int").alias("x")).select(F.pmod(F.hash("x"), F.lit(k)).alias("r"), "x")
    found = {r["r"]: r["x"] for r in tried.groupBy("r").agg(F.min("x").alias("x")).collect()}
    return [found.get(r, -1 - r) for r in range(k)]


def score_documents(docs: DataFrame, by: int = 10, prior: float = PRIOR, chunks: int = CHUNKS) -> DataFrame:
    """_SCORED for every row of docs (doc_id, text); rows whose crc32 of the id modulo by is 0 are not learned from.

    A null text is empty: one end token. Repeated rows count and are scored as often as they occur; an empty table has no
    rows; a text of any length is in one chunk. Other columns, whatever their names, are not read.
    """
    spark = docs.sparkSession
    k = max(chunks, c.plan_bytes(docs) // CHUNK_BYTES)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    shards = k if k <= SHARDS else int((SHARDS * k) ** 0.5)
    # By contents, so that both times the same rows meet; rows of one id, or without one, spread by their texts.
    number = F.pmod(F.xxhash64("doc_id", "text"), F.lit(k)).cast("int")
    tasks = max(k, int(spark.conf.get("spark.sql.shuffle.partitions")))
    chunk = F.element_at(F.lit(_numbers(spark, k)), number + 1) if k == tasks and k <= 50_000 else number
    dealt = docs.withColumn("chunk", chunk).repartition(tasks, "chunk")
    counts = dealt.groupBy("chunk").applyInArrow(_counts(shards, by), _SENT)
    answers = c.cut(counts.groupBy("shard").applyInPandas(_answers, _ANSWER), "answers")
    stats = answers.where("chunk < 0 AND words >= 0 AND kind = 0 AND places = X''").agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n"), F.coalesce(F.sum("words"), F.lit(0)).alias("v")).first()
    left = dealt.withColumn("all_tokens", F.lit(stats["n"]).cast("long")).withColumn("all_words", F.lit(stats["v"]).cast("long"))
    right = answers.where("length(totals) > 0").select("chunk", "shard", "kind", "places", "totals")
    return left.groupBy("chunk").cogroup(right.groupBy("chunk")).applyInArrow(_score(shards, by, prior), _SCORED)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(c.table(spark, sf_dir, "documents"))
